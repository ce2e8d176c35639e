"""VARIANT columns stored shredded: frequent paths as typed parquet columns of their own.

The writer infers, per file, which paths have one type and gives each a column; what does not
fit stays in the binary rest. A path that is extracted afterwards is pushed into the scan, which
then reads that path's column instead of whole values.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from helixframe.sinks.tables import SITE_ORDER, read_clustered, write_clustered

WRITE = {"spark.sql.variant.writeShredding.enabled": "true", "spark.sql.variant.inferShreddingSchema": "true"}
READ = {"spark.sql.variant.pushVariantIntoScan": "true", "spark.sql.variant.allowReadingShredded": "true"}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the duration of a block."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def write_shredded(df: DataFrame, path: str, order: tuple[str, ...] = SITE_ORDER, **options) -> None:
    """A clustered write that shreds the VARIANT columns of ``df``."""
    with settings(df.sparkSession, WRITE):
        write_clustered(df, path, order, **options)


def read_shredded(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Such a table; from here on the session pushes extracted paths into its scans."""
    for key, value in READ.items():
        spark.conf.set(key, value)
    return read_clustered(spark, path, schema)
