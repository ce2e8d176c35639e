"""Stored spans that tell which of them cover a position from stretches of bounded length.

``pos <= x AND end_pos >= x`` on a table sorted by ``pos`` reads all that begins left of the
position, since any of it may be long. Here spans are partitioned by contig and by magnitude:
a span of level ``l`` is at most ``2 ** l`` long, so it covers ``x`` only if it begins in the
``2 ** l`` positions up to ``x``. Each level is one sorted stretch with both ends known to the
scan, and levels that do not occur have no folder to read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helixframe.operators.extent import LEVELS, span_level
from helixframe.sinks.tables import write_clustered

LEVEL = "span_level"


def write_spans(
    spans: DataFrame, path: str, *, chrom: str = "chrom", start: str = "pos", end: str = "end_pos", **options
) -> None:
    """Store spans by contig, level and start; ``options`` are those of ``write_clustered``."""
    levelled = spans.withColumn(LEVEL, span_level(F.col(start), F.col(end)))
    write_clustered(levelled, path, (chrom, LEVEL, start, end), partition_by=(chrom, LEVEL), **options)


def read_spans(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All stored spans with their level."""
    whole = T.StructType([*schema.fields, T.StructField(LEVEL, T.IntegerType())])
    return spark.read.schema(whole).parquet(path).select(*[f"`{f.name}`" for f in whole.fields])


def spans_covering(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    contig: str,
    first: int,
    last: int | None = None,
    *,
    chrom: str = "chrom",
    start: str = "pos",
    end: str = "end_pos",
) -> DataFrame:
    """Stored spans of a contig that cover ``first``, or meet ``first`` to ``last``."""
    last = first if last is None else last
    spans = read_spans(spark, path, schema)

    def stretch(level: int) -> DataFrame:
        rows = spans.where((F.col(LEVEL) == level) & (F.col(chrom) == contig))
        rows = rows.where((F.col(start) <= last) & (F.col(end) >= first) & (F.col(end) >= F.col(start)))
        # The last level takes spans of any length.
        return rows if level == LEVELS[-1] else rows.where(F.col(start) > first - (1 << level))

    return reduce(DataFrame.unionAll, [stretch(level) for level in LEVELS]).drop(LEVEL)
