"""Driver tables (parquet, one file per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


_TABLES: dict[tuple, DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str, spread_rows: bool = True) -> DataFrame:
    """Read one (read-only) driver table; tables that a scan reads in
    fewer or very unequal tasks than there are cores are spread over all cores.

    The DataFrame is built once per session and path: the given tables
    never change during a run, and re-resolving a parquet source (footers,
    schema, partition count) for every query is pure driver overhead.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark, path, spread_rows)
    if key not in _TABLES:
        df = spark.read.parquet(path)
        if spread_rows:
            from ..session import spread_scan
            df = spread_scan(df)
        _TABLES[key] = df
    return _TABLES[key]
