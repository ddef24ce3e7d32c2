"""Helpers that the test modules import (a second conftest cannot shadow them)."""

SMALL_SF = "/root/testdata/sf0.001"


def rows(df):
    return [tuple(r) for r in df.collect()]
