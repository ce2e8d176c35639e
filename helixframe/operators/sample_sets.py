"""Sets of samples as bitmaps over numbered places.

A panel gives each sample a place. A set is then one word of 64 bits per bucket of places that
has a member, built where the rows are and merged as such, so distinct carriers are counted
exactly without a sample name in any shuffle, and stored sets of sites merge into sets of regions
or genes, which counts do not. A set never takes more words than it has members, so memory
follows the rows, however few of a large panel carry a site.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.session import small

PLACE, BUCKET, SET = "place", "bucket", "samples"
BUCKET_BITS = 64


def sample_places(panel: DataFrame, sample: str = "sample_id") -> DataFrame:
    """(``sample_id``, ``place``) by name order: one row per sample, a dimension table.

    Places follow from the panel alone, so a panel that only grows at its end keeps them; store
    the table beside stored sets.
    """
    names = panel.select(F.col(sample).alias("sample_id")).where(F.col("sample_id").isNotNull()).distinct()
    return names.select("sample_id", (F.row_number().over(Window.orderBy("sample_id")) - 1).cast("long").alias(PLACE))


def more_places(places: DataFrame, panel: DataFrame, sample: str = "sample_id") -> DataFrame:
    """``places`` with samples it lacks numbered behind the ones it has."""
    added = panel.select(F.col(sample).alias("sample_id")).join(small(places), "sample_id", "left_anti")
    taken = places.agg(F.coalesce(F.max(PLACE) + 1, F.lit(0))).first()[0]
    return places.unionByName(sample_places(added).withColumn(PLACE, F.col(PLACE) + taken))


def with_place(rows: DataFrame, places: DataFrame) -> DataFrame:
    """Rows with the place of their sample instead of its name; unknown samples drop out."""
    return rows.join(small(places), "sample_id").drop("sample_id")


def _bucket() -> Column:
    return F.floor(F.col(PLACE) / BUCKET_BITS).alias(BUCKET)


def sample_sets(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per key and bucket the bitmap of the samples at ``place``."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.col(PLACE), F.lit(BUCKET_BITS)).cast("int"))
    marked = rows.select(*[F.col(k) for k in keys], _bucket(), bit.alias("bitmap"))
    return marked.groupBy(*[F.col(k) for k in keys], BUCKET).agg(F.bit_or("bitmap").alias(SET))


def merge_sets(sets: DataFrame, keys: list[str]) -> DataFrame:
    """Unions of sets over coarser keys."""
    return sets.groupBy(*keys, BUCKET).agg(F.bit_or(SET).alias(SET))


def common_sets(sets: DataFrame, keys: list[str]) -> DataFrame:
    """Samples in all of the sets that share a key: intersections over coarser keys.

    A bucket that one of the sets lacks has no common samples.
    """
    wanted = sets.select(*[c for c in sets.columns if c != SET and c != BUCKET]).distinct()
    members = wanted.groupBy(*keys).agg(F.count(F.lit(1)).alias("__members"))
    both = sets.groupBy(*keys, BUCKET).agg(F.bit_and(SET).alias(SET), F.count(F.lit(1)).alias("__n"))
    return both.join(members, keys).where(F.col("__n") == F.col("__members")).drop("__n", "__members")


def count_sets(sets: DataFrame, keys: list[str], name: str = "carriers") -> DataFrame:
    """Samples per set."""
    return sets.groupBy(*keys).agg(F.sum(F.bit_count(SET)).alias(name))


def set_members(sets: DataFrame, places: DataFrame) -> DataFrame:
    """Sets as one row per sample, by name."""
    others = [c for c in sets.columns if c not in (SET, BUCKET)]
    bits = sets.select(*others, BUCKET, SET, F.explode(F.sequence(F.lit(0), F.lit(BUCKET_BITS - 1))).alias("bit"))
    place = F.col(BUCKET) * BUCKET_BITS + F.col("bit")
    held = bits.where(F.getbit(SET, F.col("bit")) == 1).select(*others, place.alias(PLACE))
    return held.join(small(places), PLACE).drop(PLACE)


def carriers_by_key(rows: DataFrame, places: DataFrame, keys: list[str], name: str = "carriers") -> DataFrame:
    """Exact distinct samples per key; only bitmaps are shuffled."""
    return count_sets(sample_sets(with_place(rows, places), keys), keys, name)
