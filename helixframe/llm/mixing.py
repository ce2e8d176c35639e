"""Mixing sources to target weights along a time-varying curriculum.

A source's weight at training time t in [0, 1] is ``base * (1 + slope * (2t - 1))``; its
integral over the run is ``base``, whatever the slope. Water filling turns the base weights
into word targets. The integral up to t, scaled to the target, is the demand of the source
up to t; the words of its documents, laid end to end in a fixed order, meet that demand, so
inverting the demand at the middle of a document gives the document's training position.
A second pass over the source continues behind the first. Passes whose middle lies beyond
the target are not taken, so a source's words differ from its target by half a document at
most.

Running sums are split: a source's documents are dealt into 4096 hash buckets, the bucket
totals are summed up first, and only rows of one bucket are ordered together.

Null text counts as empty, a null source is a source of its own (ordered last), a null id is
ordered by its own hash, repeated rows are separate documents, an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.llm.common import own_columns, text_or_empty, word_array, written

WEIGHTS = (5, 2, 1)
SLOPES = (-0.5, 0.0, 0.5)
SHARE = 1.5
MAX_PASSES = 2
BUCKET_DIGITS = 3


def _cycled(values: tuple, rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (F.pmod(rank, F.lit(len(values))) + 1).cast("int"))


def source_targets(
    totals: DataFrame,
    weights: tuple = WEIGHTS,
    slopes: tuple = SLOPES,
    share: float = SHARE,
    max_passes: int = MAX_PASSES,
) -> DataFrame:
    """Word targets by water filling, from one row per source (``source``, ``source_size``).

    A target stops at ``max_passes`` times the source's words; what it cannot take goes to
    the others by weight. The level at which the weights exhaust ``share`` of all words is
    found from the sources ordered by the level that fills each. Rows here are sources, so
    the windows over all of them hold names and sums only.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rank = F.row_number().over(by_name) - 1
    ranked = totals.select(
        "source", "source_size", _cycled(weights, rank).alias("weight"), _cycled(slopes, rank).alias("slope")
    )
    every = Window.partitionBy()
    level = ranked.withColumn("cap", F.lit(float(max_passes)) * F.col("source_size")).withColumn(
        "full_at", F.col("cap") / F.col("weight")
    )
    up_to = Window.orderBy("full_at", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    level = (
        level.withColumn("goal", F.lit(float(share)) * F.sum("source_size").over(every))
        .withColumn("all_weight", F.sum("weight").over(every))
        .withColumn("filled", F.sum("cap").over(up_to))
        .withColumn("filled_weight", F.sum("weight").over(up_to))
    )
    reached = F.col("filled") + F.col("full_at") * (F.col("all_weight") - F.col("filled_weight"))
    level = level.withColumn("full", reached <= F.col("goal"))
    level = level.withColumn("taken_cap", F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(every)).withColumn(
        "taken_weight", F.sum(F.when(F.col("full"), F.col("weight")).otherwise(0.0)).over(every)
    )
    rest = (F.col("goal") - F.col("taken_cap")) / (F.col("all_weight") - F.col("taken_weight"))
    target = F.when(F.col("all_weight") > F.col("taken_weight"), F.least(F.col("cap"), F.col("weight") * rest)).otherwise(
        F.col("cap")
    )
    return level.select("source", "source_size", "slope", target.alias("target"))


def _time_of(demand: Column, slope: Column) -> Column:
    """t with ``t + slope * (t*t - t) = demand``, for demand in [0, 1] and slope in (-1, 1)."""
    linear = F.lit(1.0) - slope
    return F.lit(2.0) * demand / (linear + F.sqrt(linear * linear + F.lit(4.0) * slope * demand))


def assign_positions(
    sizes: DataFrame,
    weights: tuple = WEIGHTS,
    slopes: tuple = SLOPES,
    share: float = SHARE,
    max_passes: int = MAX_PASSES,
) -> DataFrame:
    """Each row of (``doc_id``, ``source``, ``size``, ...) with its training positions.

    Adds ``source_size``, ``target`` and ``positions``: the time in [0, 1] of every pass of
    the mix that takes the document. ``sizes`` is read three times; pass a stored table.
    """
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    keyed = sizes.withColumns(
        {
            "__order": order,
            "__bucket": F.substring(order, 1, BUCKET_DIGITS),
            "__source": F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")),
        }
    )
    buckets = keyed.groupBy("__source", "__bucket").agg(
        F.min("source").alias("source"), F.sum("size").alias("__bucket_size")
    )
    totals = buckets.groupBy("__source").agg(
        F.min("source").alias("source"), F.sum("__bucket_size").alias("source_size")
    )
    targets = source_targets(totals, weights, slopes, share, max_passes).withColumn(
        "__source", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
    )
    before = Window.partitionBy("__source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        buckets.withColumn("__start", F.coalesce(F.sum("__bucket_size").over(before), F.lit(0)))
        .drop("source", "__bucket_size")
        .join(targets.drop("source"), "__source")
    )
    within = (
        Window.partitionBy("__source", "__bucket")
        .orderBy("__order", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    laid = keyed.join(starts, ["__source", "__bucket"]).withColumn(
        "__middle", F.col("__start") + F.coalesce(F.sum("size").over(within), F.lit(0)) + F.col("size") / F.lit(2.0)
    )
    demands = F.array(*[(F.lit(k) * F.col("source_size") + F.col("__middle")) for k in range(max_passes)])
    met = F.filter(demands, lambda d: d < F.col("target"))
    positions = F.transform(met, lambda d: _time_of(d / F.col("target"), F.col("slope")))
    return laid.withColumn("positions", positions).drop("__order", "__bucket", "__source", "__start", "__middle", "slope")


def document_sizes(docs: DataFrame) -> DataFrame:
    """Words per document and its text's hash: the one pass over the texts."""
    return own_columns(docs, "doc_id", "source", "text").select(
        "doc_id",
        "source",
        F.size(word_array(text_or_empty())).cast("long").alias("size"),
        F.xxhash64(text_or_empty()).alias("text_key"),
    )


def mix_plan(docs: DataFrame, **options) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``text_key``, ``source_size``, ``target``, ``positions``, ``taken``."""
    assigned = assign_positions(written(document_sizes(docs), "mix-sizes"), **options)
    return assigned.withColumn("taken", F.col("size") * F.size("positions"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The documents in training order: every column of ``docs``, once per pass taken.

    Positions come from ids and sizes alone and then meet the texts. Rows that agree in id,
    source and text are interchangeable: one of them stands for the passes of all.
    """
    names = [F.col(f"`{n}`") for n in docs.columns]
    key = ["__id", "__source", "__text"]

    def keyed(df: DataFrame, text_key: Column) -> DataFrame:
        return df.withColumns(
            {
                "__id": F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
                "__source": F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")),
                "__text": text_key,
            }
        )

    plan = keyed(mix_plan(docs, **options), F.col("text_key")).groupBy(*key).agg(
        F.flatten(F.collect_list("positions")).alias("__positions")
    )
    taken = keyed(docs, F.xxhash64(text_or_empty())).join(plan.where(F.size("__positions") > 0), key)
    # The join's partitioning serves the window too.
    number = F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(0)))
    passes = taken.withColumn("__number", number).where("__number = 1").select(*names, F.explode("__positions").alias("__position"))
    return passes.repartitionByRange("__position").sortWithinPartitions("__position", "doc_id").select(*names)
