"""A set of the sixteen domain tables as DataFrames.

A :class:`Domain` is what every report, check and ingest job takes. It can
be backed by lazily derived views over the test tables
(:func:`revtrace.sources.testdata.domain_from_testdata`), by seed rows
(:mod:`revtrace.sources.fixtures`) or by stored Parquet tables
(:func:`revtrace.sources.store.read_domain`). Frames are built on first use
so that a query touching three tables never plans the other thirteen.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from revtrace.schema import TABLE_NAMES


class Domain:
    def __init__(
        self,
        spark: SparkSession,
        builders: Mapping[str, Callable[[], DataFrame]],
        version: int | None = None,
    ):
        missing = set(TABLE_NAMES) - set(builders)
        if missing:
            raise ValueError(f"domain lacks tables: {sorted(missing)}")
        self.spark = spark
        self.version = version  # of the publication the tables were read from, if any
        self._builders = dict(builders)
        self._frames: dict[str, DataFrame] = {}

    @classmethod
    def of(cls, spark: SparkSession, frames: Mapping[str, DataFrame]) -> "Domain":
        return cls(spark, {k: (lambda df=df: df) for k, df in frames.items()})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._builders[name]()
        return self._frames[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLE_NAMES:
            raise AttributeError(name)
        return self[name]

    def names(self) -> Iterable[str]:
        return TABLE_NAMES

    def register_views(self, prefix: str = "") -> list[str]:
        """Expose every table as a temporary view for ``spark.sql``.

        Views are named after the catalogue (``ponto_coleta``,
        ``lote_triado``...), optionally prefixed. Returns the view names.
        """
        names = []
        for t in TABLE_NAMES:
            name = f"{prefix}{t}"
            self[t].createOrReplaceTempView(name)
            names.append(name)
        return names

    def replace(self, **frames: DataFrame) -> "Domain":
        """A copy of this domain with some tables swapped out."""
        builders = dict(self._builders)
        for k, df in frames.items():
            if k not in TABLE_NAMES:
                raise KeyError(k)
            builders[k] = lambda df=df: df
        out = Domain(self.spark, builders, self.version)
        out._frames = {k: v for k, v in self._frames.items() if k not in frames}
        return out
