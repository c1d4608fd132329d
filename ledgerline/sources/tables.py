"""Lazy loader for the parquet tables of one data set."""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame, SparkSession

from ledgerline.session import apply_defaults

# Lazy base DataFrames per session and path: building one infers the parquet
# schema on the driver (a footer read), so queries of the same session reuse
# it. Only the plan is cached, never data.
_BASE: "weakref.WeakKeyDictionary[SparkSession, dict[str, DataFrame]]" = weakref.WeakKeyDictionary()

TABLE_NAMES = ("region nation customer supplier part orders lineitem events documents "
               "embeddings pages benchmark labels conversations").split()


class Tables:
    """``Tables(spark, dir).orders`` → DataFrame over ``dir/orders.parquet``.

    Reads are lazy; projections and filters written later reach the parquet
    scan through Catalyst (``ReadSchema`` / ``PushedFilters``).
    """

    def __init__(self, spark: SparkSession, sf_dir: str, filters: dict | None = None):
        apply_defaults(spark)
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.filters = dict(filters or {})
        self._cache: dict[str, DataFrame] = {}

    def restrict(self, **filters) -> "Tables":
        """Same tables with row predicates applied at the scan (e.g. a key for a point lookup).

        The predicates are on raw table columns, so they are pushed into the
        parquet reader (``PushedFilters``) and every derived frame sees only
        the matching rows.
        """
        merged = dict(self.filters)
        merged.update(filters)
        return Tables(self.spark, self.sf_dir, merged)

    def semi(self, keys: DataFrame, **columns: str) -> "Tables":
        """Same tables with only the rows whose named column occurs in ``keys`` (one column); a semi-join at the scan."""
        merged = dict(self.filters)
        merged.update({name: (keys.toDF(column), column) for name, column in columns.items()})
        return Tables(self.spark, self.sf_dir, merged)

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            per_session = _BASE.setdefault(self.spark, {})
            path = self.path(name)
            if path not in per_session:
                per_session[path] = self.spark.read.parquet(path)
            df = per_session[path]
            if name in self.filters:
                rows = self.filters[name]
                df = df.join(rows[0], rows[1], "left_semi") if isinstance(rows, tuple) else df.where(rows)
            self._cache[name] = df
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            return self.table(name)
        raise AttributeError(name)
