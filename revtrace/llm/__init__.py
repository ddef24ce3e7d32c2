"""Training-data operators: deduplication, filtering, tokenising and extraction.

Each module holds one operator with a general interface; ``registry`` adds the
thin ``opN_<name>`` queries over the test tables. Nothing outside this
subpackage imports it.
"""
