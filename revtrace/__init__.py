"""Reverse-logistics traceability analytics on Spark.

Entry points: :mod:`revtrace.operators.reports` (the five reports),
:mod:`revtrace.operators.quality` (constraint checks, delete planning),
:mod:`revtrace.operators.ingest` (registration rules as batch ingest),
:mod:`revtrace.streaming.feed` (the same as a stream) and
:mod:`revtrace.plans.reload` (validate-then-publish reload), all over a
:class:`revtrace.sources.domain.Domain` of the sixteen tables.
"""
