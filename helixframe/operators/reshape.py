"""Array flattening, unpivot of sample columns and pivot back to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.session import small


def flatten_alts(
    df: DataFrame, alt: str = "alt", index: str = "alt_allele_id", value: str = "alt_allele"
) -> DataFrame:
    """One row per ALT allele with its 0-based index; rows without ALT drop out."""
    return df.select("*", F.posexplode(F.col(alt)).alias(index, value))


def unpivot_samples(wide: DataFrame, samples: DataFrame, keep: list[str]) -> DataFrame:
    """Long genotype rows from wide rows whose sample columns sit in the array ``calls``.

    ``samples`` has one row per file: ``filename`` and ``samples``, the names of its
    ``#CHROM`` line in column order. The names join per file before the rows multiply, so
    only wide rows meet them and any number of samples gives the same small plan. Files
    share few column layouts, so a file is linked to its layout by a digest and each
    layout's names are kept once.
    """
    keyed = samples.select(
        "filename", F.sha2(F.array_join("samples", "\t"), 256).alias("__layout"), "samples"
    )
    files = keyed.select("filename", "__layout")
    layouts = keyed.groupBy("__layout").agg(F.first("samples").alias("samples"))
    named = wide.join(small(files), "filename").join(small(layouts), "__layout")
    cells = named.select(
        *keep, F.explode(F.arrays_zip(F.col("samples"), F.col("calls"))).alias("cell")
    )
    long = cells.select(
        *keep, F.col("cell.samples").alias("sample_id"), F.col("cell.calls").alias("call")
    )
    return long.where(F.col("call").isNotNull() & F.col("sample_id").isNotNull())


def unpivot_columns(df: DataFrame, ids: list[str], samples: list[str]) -> DataFrame:
    """Unpivot real sample columns to (``sample_id``, ``gt``); NULL cells are left out."""
    return df.unpivot(ids, samples, "sample_id", "gt").where(F.col("gt").isNotNull())


def pivot_samples(
    df: DataFrame, keys: list[str], samples: list[str], value: Column, sample: str = "sample_id"
) -> DataFrame:
    """One column per listed sample holding its greatest value; absent samples are NULL.

    Keys that only unlisted samples have keep their row, with NULL in every column.
    """
    return df.groupBy(*keys).pivot(sample, samples).agg(F.max(value))


def sample_order(panel: DataFrame, sample: str = "sample_id") -> DataFrame:
    """Distinct sample names with their 0-based place in name order.

    Names alone are ordered together: one short row per sample, whatever the calls.
    """
    names = panel.select(F.col(sample).alias(sample)).where(F.col(sample).isNotNull()).distinct()
    return names.withColumn("place", F.row_number().over(Window.orderBy(sample)) - F.lit(1))


def sample_line(panel: DataFrame, sample: str = "sample_id") -> DataFrame:
    """One row: the tab-joined names, in the order that ``pivot_text`` uses."""
    names = panel.select(sample).where(F.col(sample).isNotNull()).distinct()
    return names.agg(F.array_join(F.sort_array(F.collect_list(sample)), "\t").alias("samples"))


def filled_text(cells: Column, total: Column, absent: str) -> Column:
    """``total`` values, tab-joined, from cells (``place``, ``__value``) in order of their places;
    the places between them hold ``absent``."""
    size = F.size(cells)
    following = F.concat(
        F.transform(F.slice(cells, 2, F.greatest(size - 1, F.lit(0))), lambda c: c["place"]), F.array(total)
    )
    spelled = F.zip_with(
        cells,
        following,
        lambda c, after: F.concat(c["__value"], F.repeat(F.lit(f"\t{absent}"), (after - c["place"] - 1).cast("int"))),
    )
    lead = F.repeat(F.lit(f"{absent}\t"), F.get(cells, F.lit(0))["place"].cast("int"))
    empty = F.when(total > 0, F.concat(F.lit(absent), F.repeat(F.lit(f"\t{absent}"), (total - 1).cast("int")))).otherwise("")
    return F.when(size == 0, empty).otherwise(F.concat(lead, F.array_join(spelled, "\t")))


def pivot_text(
    df: DataFrame,
    keys: list[str],
    panel: DataFrame,
    value: Column,
    sample: str = "sample_id",
    order: tuple[str, ...] = (),
) -> DataFrame:
    """One row per key with every panel sample's greatest value as tab-joined text.

    Samples come in name order, absent ones as ``.``; samples outside the panel are left out,
    keys that only they have keep a row of dots. The plan has the same size for any number of
    samples: present values are gathered with their places, and the gaps between places are
    filled with dots. Rows are shuffled once, and sorted by ``order``, before there is any text:
    what moves grows with the values, not with sites times samples.
    """
    names = sample_order(panel, sample)
    total = names.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    placed = df.select(*keys, F.col(sample), value.alias("__value")).join(small(names), sample, "left").drop(sample)
    single = placed.repartition(*keys).groupBy(*keys, "place").agg(F.max("__value").cast("string").alias("__value"))
    known = F.when(F.col("place").isNotNull() & F.col("__value").isNotNull(), F.struct("place", "__value"))
    sites = single.groupBy(*keys).agg(F.sort_array(F.collect_list(known)).alias("__cells"))
    if order:
        sites = sites.orderBy(*order)
    return sites.select(*keys, filled_text(F.col("__cells"), F.lit(total), ".").alias("values"))
