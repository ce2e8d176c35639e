"""Column expressions and helpers that the corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.session import new_scratch_path, shuffles_released

# White space of the word rule [^\x20\x09-\x0D]+.
SPACE_RUN = r"[\x20\x09-\x0D]+"
VISIBLE = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored once below the shared scratch folder and read back.

    Readers start from files that every executor sees, so a lost executor costs the
    lost task only and no step is computed twice.
    """
    spark = df.sparkSession
    path = new_scratch_path(spark, name)
    with shuffles_released(spark):
        df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def word_array(text: Column) -> Column:
    """Maximal runs of characters other than blank and tab to carriage return."""
    return F.array_remove(F.split(text, SPACE_RUN, -1), "")


def shifted(array: Column, by: int) -> Column:
    """The array without its first ``by`` elements."""
    return F.slice(array, by + 1, F.greatest(F.size(array) - by, F.lit(0)))


def own_columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that extra input columns clash with nothing."""
    return df.select([F.col(f"`{n}`") for n in names])


def map_all_columns(df: DataFrame, function, schema) -> DataFrame:
    """``mapInArrow`` over all columns, whatever their names (it cannot resolve a dot)."""
    names = df.columns

    def renamed(batches):
        return function(batch.rename_columns(names) for batch in batches)

    return df.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(renamed, schema)
