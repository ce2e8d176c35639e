"""Text to clustered tables: population VCF, annotation VCF, gVCF and single-sample VCF.

Each load of possibly bad files reads its text once, into ``<out>/staging_<table>`` with a flag
for bad lines; bad files, the header dictionary, sample names and the sampling of the range
sort start from there. Files with a bad line are left out whole and their bad lines are kept
in ``<out>/quarantine_<table>``. Both folders are overwritten by the next load into ``out``. The
tables are parquet, range-partitioned and sorted, ready for locus or sample ranges. Header
dictionaries come from the files being loaded unless given or read from ``header_path``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.functions import fields as V
from helixframe.functions.text import split_alts, split_ids
from helixframe.operators.info import InfoKey, info_dictionary, parse_info
from helixframe.operators.joins import normalize_contigs
from helixframe.operators.reshape import unpivot_samples
from helixframe.plans.tables import gvcf_view, with_alleles
from helixframe.sinks import tables as K
from helixframe.sources import vcf as S

Path = str | list[str]


def _dictionary(
    spark: SparkSession, path: Path, header_path: Path | None
) -> DataFrame:
    lines = S.header_lines(S.read_lines(spark, header_path or path))
    return info_dictionary(lines)


def _staged(lines: DataFrame, out: str, table: str, columns: int) -> DataFrame:
    """The one pass over the text, as a stored table of checked lines."""
    return K.written(S.checked_lines(lines, columns), "staging", f"{out}/staging_{table}")


def _without_bad_files(checked: DataFrame, out: str, table: str) -> DataFrame:
    good, bad = S.split_bad_files(checked)
    K.written(bad, "quarantine", f"{out}/quarantine_{table}")
    return good


def quarantine(spark: SparkSession, out: str, table: str) -> DataFrame:
    """The bad lines of the last load of ``table``: ``filename``, ``text``."""
    return spark.read.schema("filename string, text string").parquet(f"{out}/quarantine_{table}")


def load_headers(
    spark: SparkSession, path: Path, out: str, name: Column | None = None
) -> DataFrame:
    """Header lines as the table ``<out>/headers``."""
    headers = S.scan_vcf_headers(spark, path, name=name)
    target = f"{out}/headers"
    headers.write.mode("overwrite").parquet(target)
    return spark.read.schema(headers.schema).parquet(target)


def load_sites(
    spark: SparkSession,
    path: Path,
    out: str,
    *,
    aliases: DataFrame | None = None,
    dictionary: DataFrame | list[InfoKey] | None = None,
    header_path: Path | None = None,
    flat: bool = False,
    pattern: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Sites with parsed INFO as ``<out>/sites``; files with a bad row are left out whole.

    ``aliases`` translates accession contigs; ``flat`` keeps ALT as text and INFO per single
    ALT. Works for sites-only and multi-sample text alike.
    """
    checked = _staged(S.read_lines(spark, path, pattern, partitions), out, "sites", 8)
    raw = S.parse_sites(_without_bad_files(checked, out, "sites")).drop("filename")
    if flat:
        typed = raw.withColumn("qual", V.qual_number(F.col("qual"))).withColumnRenamed(
            "alt", "alt_allele"
        )
    else:
        typed = S.typed_sites(raw)
    if aliases is not None:
        typed = normalize_contigs(typed, aliases)
    if dictionary is not None:
        keys = dictionary
    elif header_path is not None:
        keys = _dictionary(spark, path, header_path)
    else:
        keys = info_dictionary(S.header_lines(checked))
    sites = parse_info(typed, keys, flat=flat)
    target = f"{out}/sites"
    K.write_clustered(sites, target, ("chrom", "pos", "ref", "alt_allele" if flat else "alt"))
    return K.read_clustered(spark, target, sites.schema)


def load_genotypes(
    spark: SparkSession,
    path: Path,
    out: str,
    *,
    samples: DataFrame | None = None,
    pattern: str | None = None,
    partitions: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Long decoded genotypes of multi-sample text, by locus and by sample.

    Files with a bad row, or a row with more or fewer cells than samples, are left out whole.
    """
    checked = _staged(S.read_lines(spark, path, pattern, partitions), out, "genotypes", 10)
    names = samples if samples is not None else S.sample_columns(checked)
    lines = _without_bad_files(S.mark_wrong_cells(checked, names), out, "genotypes")
    long = unpivot_samples(S.parse_wide(lines), names, ["chrom", "pos", "id", "ref", "alt"])
    genotypes = with_alleles(
        long.select(
            "chrom",
            "pos",
            split_ids(F.col("id")).alias("id"),
            "ref",
            split_alts(F.col("alt")).alias("alt"),
            "sample_id",
            V.gt_only(F.col("call")).alias("gt"),
        )
    )
    by_locus, by_sample = f"{out}/genotypes", f"{out}/genotypes_by_sample"
    # Loci come from the lines, so no call is unpivoted to find the bounds of the files.
    loci = S.parse_wide(lines).select("chrom", "pos", "ref")
    widest = names.agg(F.max(F.size("samples"))).first()[0] or 1
    K.write_clustered(genotypes, by_locus, K.LOCUS_ORDER, keys_from=loci, rows_per_key=widest)
    stored = K.read_clustered(spark, by_locus, genotypes.schema)
    # The second copy starts from the first, so text is unpivoted and decoded once.
    K.write_by_sample(stored, by_sample)
    return stored, K.read_by_sample(spark, by_sample, genotypes.schema)


def load_gvcf(
    spark: SparkSession,
    path: Path,
    out: str,
    *,
    sample: Column | None = None,
    pattern: str | None = None,
    partitions: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """gVCF spans as loaded, and by position with their FORMAT keys as columns."""
    checked = _staged(S.read_lines(spark, path, pattern, partitions), out, "gvcf", 10)
    raw = S.parse_gvcf(_without_bad_files(checked, out, "gvcf"), sample)
    by_sample, by_position = f"{out}/genotypes_raw", f"{out}/genotypes_by_position"
    K.write_clustered(raw, by_sample, K.SAMPLE_ORDER, partition_by=None, bloom=("id",))
    stored = K.read_clustered(spark, by_sample, raw.schema)
    view = gvcf_view(stored)
    K.write_clustered(view, by_position, ("chrom", "pos"), bloom=("id", "sample_id"))
    return stored, K.read_clustered(spark, by_position, view.schema)


def load_single_sample(
    spark: SparkSession,
    path: Path,
    out: str,
    *,
    dictionary: DataFrame | list[InfoKey] | None = None,
    header_path: Path | None = None,
    drop_single_key_info: bool = True,
) -> DataFrame:
    """One-sample-per-file text with INFO per single ALT, as ``<out>/genotypes``.

    Files with a bad row are left out whole.
    """
    checked = _staged(S.read_lines(spark, path), out, "single", 10)
    if dictionary is not None:
        keys = dictionary
    elif header_path is not None:
        keys = _dictionary(spark, path, header_path)
    else:
        keys = info_dictionary(S.header_lines(checked))
    rows = S.parse_vcf_body(_without_bad_files(checked, out, "single"), drop_single_key_info)
    rows = rows.withColumn("qual", V.rounded_int(F.col("qual"), "bigint"))
    genotypes = parse_info(rows, keys, flat=True)
    target = f"{out}/genotypes"
    K.write_clustered(genotypes, target, ("chrom", "pos"))
    return K.read_clustered(spark, target, genotypes.schema)
