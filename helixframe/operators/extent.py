"""Size and locus extent of the looked-up side of a join, measured in one aggregate.

Three decisions follow from it: whether the side may be broadcast, which bin widths its spans
have, and which contigs and positions of the other side can match at all. The latter becomes a
filter that reaches the scan of the other side as partition pruning and row-group skipping; the
optimizer does not derive it from a range join.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.session import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS, row_bytes

MAX_CONTIGS = 4096
MAX_CONTIG_NAMES = 64
MAX_CONTIG_RANGES = 4

WIDTH_BITS = 3
LEVELS = tuple(range(0, 31, WIDTH_BITS))


def span_level(start: Column, end: Column) -> Column:
    """Exponent of the smallest bin width that is at least the span's length."""
    length = end.cast("long") - start.cast("long") + F.lit(1)
    level = F.lit(LEVELS[-1])
    for exponent in reversed(LEVELS[:-1]):
        level = F.when(length <= F.lit(1 << exponent), F.lit(exponent)).otherwise(level)
    return level


@dataclass(frozen=True)
class Extent:
    """Rows, bytes, per-contig bounds and span widths that occur (as exponents).

    ``contigs`` is None where there are too many.
    """

    rows: int
    size: int
    contigs: tuple[tuple[str, int, int], ...] | None
    levels: tuple[int, ...] = LEVELS

    def is_small(self, max_rows: int = BROADCAST_MAX_ROWS, copies: int = 1) -> bool:
        """May be broadcast, with each row up to ``copies`` times."""
        return (
            self.contigs is not None
            and self.rows * copies <= max_rows
            and self.size * copies <= BROADCAST_MAX_BYTES
        )

    def near(self, df: DataFrame, chrom: str, start: str, end: str) -> DataFrame:
        """Rows of ``df`` whose [start, end] can meet this extent; drops no other row.

        Few contigs get a position range each, more of them share one: a test per contig
        and row would cost more than it saves.
        """
        if self.contigs is None:
            return df
        if not self.contigs:
            return df.where(F.lit(False))
        lo, hi = min(c[1] for c in self.contigs), max(c[2] for c in self.contigs)
        df = df.where((F.col(start) <= hi) & (F.col(end) >= lo))
        if len(self.contigs) > MAX_CONTIG_NAMES:
            return df
        df = df.where(F.col(chrom).isin([name for name, _, _ in self.contigs]))
        if not 1 < len(self.contigs) <= MAX_CONTIG_RANGES:
            return df
        return df.where(
            reduce(
                lambda a, b: a | b,
                [
                    (F.col(chrom) == name) & (F.col(start) <= last) & (F.col(end) >= first)
                    for name, first, last in self.contigs
                ],
            )
        )


def measure(df: DataFrame, chrom: str, start: str, end: str) -> Extent:
    """Extent of ``df`` by contig; the driver receives one row per contig name."""
    rows = (
        df.where(F.col(chrom).isNotNull())
        .select(
            F.col(chrom).alias("chrom"),
            F.col(start).alias("start"),
            F.col(end).alias("end"),
            row_bytes(df).alias("size"),
        )
        .groupBy("chrom")
        .agg(
            F.min("start").alias("first"),
            F.max("end").alias("last"),
            F.count(F.lit(1)).alias("rows"),
            F.sum("size").alias("size"),
            F.collect_set(span_level(F.col("start"), F.col("end"))).alias("levels"),
        )
        .where(F.col("first").isNotNull() & F.col("last").isNotNull())
        .limit(MAX_CONTIGS + 1)
        .collect()
    )
    total = sum(r["rows"] for r in rows)
    size = sum(r["size"] for r in rows)
    levels = tuple(sorted({level for r in rows for level in r["levels"]}))
    if len(rows) > MAX_CONTIGS:
        return Extent(total, size, None)
    return Extent(total, size, tuple((r["chrom"], r["first"], r["last"]) for r in rows), levels)
