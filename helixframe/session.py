"""Session-level helpers: shared scratch storage and size-checked broadcasts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 128 * 1024 * 1024

# Since Spark 4.1; what older ones do with it is nothing.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_scratch: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written intermediates, as named by ``spark.checkpoint.dir``.

    Only a ``local`` master may fall back to a temporary folder: on a cluster the
    executors would not share it, so a missing setting is an error there.
    """
    try:
        configured = spark.conf.get("spark.checkpoint.dir", None)
    except PySparkException:
        configured = None
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_scratch:
        folder = tempfile.mkdtemp(prefix="helixframe-")
        _local_scratch[app] = folder
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return _local_scratch[app]


def new_scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared scratch folder."""
    return f"{scratch_root(spark)}/helixframe/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Remove a written intermediate that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the statements inside are removed as each one ends.

    Otherwise they stay until the driver happens to collect its garbage, and the disk holds the
    sum of all steps instead of the largest. For writes, which no later statement shares.
    """
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few literal rows as a plan of literals, without a Python-side data source."""
    fields = T.StructType.fromDDL(schema).fields
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)])
        for row in rows
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


def row_bytes(df: DataFrame):
    """Row width in bytes: fixed-width types by their size, the others by their text."""
    total = F.lit(16)
    for field in df.schema.fields:
        if isinstance(field.dataType, T.NumericType | T.BooleanType):
            total = total + F.lit(8)
            continue
        column = F.col(f"`{field.name}`")
        variant = isinstance(field.dataType, T.VariantType)
        text = F.to_json(column) if variant else column.cast("string")
        total = total + F.coalesce(F.octet_length(text), F.lit(0))
    return total


def broadcast_if_small(
    df: DataFrame,
    max_rows: int = BROADCAST_MAX_ROWS,
    max_bytes: int = BROADCAST_MAX_BYTES,
) -> tuple[DataFrame, bool]:
    """Mark ``df`` for broadcast when a count proves it small; else return it unmarked.

    The check is one distributed aggregate. Beyond the bound the join falls back to
    Spark's shuffle join, whose skewed partitions AQE splits at run time.
    """
    size = df.select(row_bytes(df).alias("b")).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("b"), F.lit(0)).alias("bytes")
    ).first()
    if size["n"] <= max_rows and size["bytes"] <= max_bytes:
        return F.broadcast(df), True
    return df, False


def small(df: DataFrame, **bounds) -> DataFrame:
    """``broadcast_if_small`` for callers that need only the frame."""
    return broadcast_if_small(df, **bounds)[0]
