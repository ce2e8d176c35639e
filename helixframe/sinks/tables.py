"""Clustered writes, second copies, and written or named intermediates."""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helixframe.session import new_scratch_path, shuffles_released

LOCUS_ORDER = ("chrom", "pos", "ref", "gt")
SAMPLE_ORDER = ("sample_id", "chrom", "pos", "ref")
SITE_ORDER = ("chrom", "pos", "ref")
# Folders of the by-sample copy: one of the load, one per refresh.
BATCH_COLUMN, LOAD_BATCH = "batch", "load"

# Size of a file before encoding, the least work that is worth a task, and keys drawn per bound.
FILE_BYTES = 512 * 1024 * 1024
ROWS_PER_TASK = 20_000
# Rows that one pass of a clustered write shuffles at most.
ROWS_PER_PASS = 100_000_000
SAMPLE_PER_FILE, SAMPLE_SEED = 60, 17
# So few keys are all taken: a sample of them cuts unevenly.
LEAST_SAMPLE = 10_000
# Distinct values per row group that a Bloom filter is sized for.
BLOOM_VALUES = 100_000


def behind_shuffle(df: DataFrame) -> bool:
    """Rows of ``df`` come out of a shuffle: dear to compute again, and in another order each time.

    What is broadcast to them may have been shuffled; that moves no row of ``df``.
    """
    plan = df._jdf.queryExecution().executedPlan().toString()
    broadcast_at = None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if broadcast_at is not None and depth > broadcast_at:
            continue
        broadcast_at = depth if "BroadcastExchange" in line else None
        if broadcast_at is None and re.search(r"\bExchange", line):
            return True
    return False


def _width(kind: T.DataType) -> int:
    """Bytes that a value of a type takes, as a rule of thumb."""
    if isinstance(kind, T.StructType):
        return sum(_width(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return 2 * _width(kind.elementType)
    return 8 if isinstance(kind, T.NumericType | T.BooleanType | T.DateType | T.TimestampType) else 20


def file_count(df: DataFrame, rows: int, file_bytes: int = FILE_BYTES) -> int:
    """Files for ``rows`` rows like those of ``df``: by size, and enough to keep all cores busy."""
    by_size = -(-rows * _width(df.schema) // file_bytes)
    by_cores = min(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK))
    return max(1, by_size, by_cores)


def key_bounds(keys: DataFrame, rows: int, files: int) -> str:
    """``files - 1`` key structs, as JSON, that cut a sample of the keys evenly.

    The sample has ``SAMPLE_PER_FILE`` rows per file, or ``LEAST_SAMPLE``; the driver receives
    only the bounds.
    """
    share = min(1.0, max(SAMPLE_PER_FILE * files, LEAST_SAMPLE) / max(rows, 1))
    sample = keys if share == 1.0 else keys.sample(share, seed=SAMPLE_SEED)
    ordered = F.sort_array(F.collect_list(F.struct(*[F.col(f"`{c}`") for c in keys.columns])))
    cut = F.transform(
        F.sequence(F.lit(1), F.lit(files - 1)),
        lambda i: F.get(F.col("k"), F.floor(i * F.size("k") / F.lit(files)).cast("int")),
    )
    bounds = F.filter(cut, lambda x: x.isNotNull())
    options = {"ignoreNullFields": "false"}
    return sample.agg(ordered.alias("k")).select(F.to_json(bounds, options).alias("b")).first()["b"]


def _place(bounds: str, schema: T.StructType, keys: list[str]) -> Column:
    """How many of the sorted bounds are at most the row's key, by halving steps."""
    count = len(json.loads(bounds))
    if not count:
        return F.lit(0)
    table = F.from_json(F.lit(bounds), T.ArrayType(schema))
    own = F.struct(*[F.col(f"`{c}`").cast(schema[c].dataType).alias(c) for c in keys])
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(count.bit_length()))])

    def step(place: Column, size: Column) -> Column:
        above = place + size
        return F.when((above <= count) & (F.get(table, above - 1) <= own), above).otherwise(place)

    return F.aggregate(steps, F.lit(0), step)


def write_clustered(
    df: DataFrame,
    path: str,
    order: tuple[str, ...] = SITE_ORDER,
    *,
    partition_by: str | tuple[str, ...] | None = "chrom",
    partitions: int | None = None,
    mode: str = "overwrite",
    keys_from: DataFrame | None = None,
    rows_per_key: int = 1,
    bloom: tuple[str, ...] = (),
) -> None:
    """Write parquet range-partitioned and sorted by ``order``.

    Row groups then carry narrow min/max ranges, so a locus or sample range reads only its
    own. Bounds come from the key columns alone, so ``df`` is computed in full only once (and
    stored first where even its keys need a shuffle); ``keys_from`` is a smaller table with the same distribution of (some of) the keys, each of
    its rows standing for ``rows_per_key`` rows. The number of files follows from row count and
    width. Rows that agree in all order columns may still be many, so the source partition is
    the last range key: equal keys can spread over several files. ``bloom`` names columns that
    get a Bloom filter per row group, for point lookups that no order serves.

    Beyond ``ROWS_PER_PASS`` rows the files are written in several passes over ``df``, each with
    the shuffle of its own range of files, so the disk never holds a shuffle of all rows.
    """
    keys = [c for c in order if c in df.columns]
    if keys_from is None and behind_shuffle(df):
        df = written(df, "clustered-input")
    tagged = df.withColumn("__source", F.spark_partition_id())
    source = df if keys_from is None else keys_from
    have = [c for c in keys if c in source.columns]
    if keys_from is None:
        have, source = [*have, "__source"], tagged
    known = source.select(*[F.col(f"`{c}`") for c in have])
    count = known.count()
    files = partitions or file_count(df, count * rows_per_key)
    passes = 1 if mode not in ("overwrite", "append") else max(1, min(files, -(-count * rows_per_key // ROWS_PER_PASS)))
    if files > 1:
        bounds = key_bounds(known, count, files)
        tagged = tagged.withColumn("__file", _place(bounds, known.schema, have))
    for turn in range(passes):
        if passes > 1:
            low, high = (files * k // passes for k in (turn, turn + 1))
            own = tagged.where(F.col("__file").between(low, high - 1))
            ranged = own.withColumn("__file", F.col("__file") - low).repartitionById(high - low, "__file")
        else:
            ranged = tagged.repartitionById(files, "__file") if files > 1 else tagged.repartition(1)
        writer = ranged.sortWithinPartitions(*keys).drop("__source", "__file").write.mode(mode if turn == 0 else "append")
        for column in bloom:
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
            writer = writer.option(f"parquet.bloom.filter.expected.ndv#{column}", str(BLOOM_VALUES))
        if partition_by:
            writer = writer.partitionBy(*((partition_by,) if isinstance(partition_by, str) else partition_by))
        with shuffles_released(df.sparkSession):
            writer.parquet(path)


def read_clustered(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Read a clustered table with the columns, types and order of ``schema``.

    The partition column comes from folder names; the schema keeps it text, as chromosome
    names are.
    """
    if schema is None:
        return spark.read.parquet(path)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def find(
    spark: SparkSession, path: str, schema: T.StructType, column: str, values: list[str], max_values: int = 1000
) -> DataFrame:
    """Rows of a stored table with one of a few listed values in ``column``.

    The list is part of the filter that the scan gets, so row groups are skipped by their
    range, dictionary or Bloom filter; longer lists belong in a join.
    """
    if len(values) > max_values:
        raise ValueError(f"{len(values)} values: join a table of them instead")
    return read_clustered(spark, path, schema).where(F.col(f"`{column}`").isin(*values))


def write_by_sample(genotypes: DataFrame, target: str, **options) -> None:
    """The second copy of a genotype table, by sample; replaces what ``target`` holds."""
    rows = genotypes.withColumn(BATCH_COLUMN, F.lit(LOAD_BATCH))
    write_clustered(rows, target, SAMPLE_ORDER, partition_by=BATCH_COLUMN, **options)


def read_by_sample(spark: SparkSession, target: str, schema) -> DataFrame:
    """The by-sample copy with all its batches, in the columns and types of ``schema``."""
    fields = [f for f in schema.fields if f.name != BATCH_COLUMN]
    whole = T.StructType([*fields, T.StructField(BATCH_COLUMN, T.StringType())])
    return spark.read.schema(whole).parquet(target).select(*[f"`{f.name}`" for f in fields])


def write_genotypes(genotypes: DataFrame, by_locus: str, by_sample: str, **options) -> None:
    """Both copies of a genotype table: by locus and by sample; rows out of a shuffle are computed once."""
    if behind_shuffle(genotypes):
        genotypes = written(genotypes, "clustered-input")
    write_clustered(genotypes, by_locus, LOCUS_ORDER, **options)
    write_by_sample(genotypes, by_sample, **options)


def append_all(sources: list[DataFrame]) -> DataFrame:
    """Rows of all sources by column name; columns a source lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write an intermediate to shared storage and read it back.

    What follows starts from files that outlive lost executors, not from a long lineage.
    """
    spark = df.sparkSession
    target = path or new_scratch_path(spark, name)
    with shuffles_released(spark):
        df.write.mode("overwrite").parquet(target, compression="zstd")
    return spark.read.schema(df.schema).parquet(target)


def materialize(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """The same, under a view name for SQL."""
    stored = written(df, name, path)
    stored.createOrReplaceTempView(name)
    return stored


def create_view(df: DataFrame, name: str) -> DataFrame:
    """Name a frame for SQL without computing it."""
    df.createOrReplaceTempView(name)
    return df


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return counts.where(F.col("copies") > 1)
