"""Joins of genotypes, sites, annotations and the sample panel.

Dimension sides are broadcast only behind a size check (``small``); the others are plain
equi joins on locus keys, whose skewed partitions AQE splits. Allele conditions stay in the
join condition as residuals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.functions.genotype import allele_count, count_matches
from helixframe.session import small

SITE_KEYS = ("chrom", "pos", "ref", "alt")
LOCUS_KEYS = ("chrom", "pos", "ref")


def site_match(left: str, right: str, keys) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & (F.col(f"{left}.{key}") == F.col(f"{right}.{key}"))
    return condition


def join_panel(genotypes: DataFrame, panel: DataFrame) -> DataFrame:
    """Genotype rows with the attributes of their sample."""
    return genotypes.join(small(panel), "sample_id")


def join_clinvar(genotypes: DataFrame, clinvar: DataFrame) -> DataFrame:
    """Genotype rows at annotated loci; annotation columns come back as ``c_*``."""
    return join_annotation(genotypes, small(clinvar))


def join_clinvar_allele(genotypes: DataFrame, clinvar: DataFrame) -> DataFrame:
    """Genotype rows that carry an annotated allele."""
    return join_annotation(genotypes, small(clinvar), carriers_only=True)


def join_annotation(
    genotypes: DataFrame, annotation: DataFrame, carriers_only: bool = False
) -> DataFrame:
    """Genotype rows at annotated loci, or those that carry an annotated allele."""
    carries = F.array_contains(F.col("c.alt"), F.col("g.allele1")) | F.array_contains(
        F.col("c.alt"), F.col("g.allele2")
    )
    condition = site_match("g", "c", LOCUS_KEYS)
    if carriers_only:
        condition = condition & carries
    extra = [c for c in annotation.columns if c not in LOCUS_KEYS]
    joined = genotypes.alias("g").join(annotation.alias("c"), condition)
    return joined.select("g.*", *[F.col(f"c.{c}").alias(f"c_{c}") for c in extra])


def join_variant_genotype(alleles: DataFrame, genotypes: DataFrame) -> DataFrame:
    """Allele rows with every genotype that carries that allele at the same site.

    The genotype side is first reduced to calls with any listed ALT, which the join
    condition implies, so homozygous reference rows never reach the exchange.
    """
    listed = F.array_contains(F.col("alt"), F.col("allele1")) | F.array_contains(
        F.col("alt"), F.col("allele2")
    )
    carries = (F.col("v.alt_allele") == F.col("g.allele1")) | (
        F.col("v.alt_allele") == F.col("g.allele2")
    )
    extra = [c for c in genotypes.columns if c not in (*SITE_KEYS, *alleles.columns)]
    joined = genotypes.where(listed).alias("g").join(
        small(alleles).alias("v"), site_match("g", "v", SITE_KEYS) & carries
    )
    return joined.select("v.*", *[F.col(f"g.{c}").alias(c) for c in extra])


def counted(
    rows: DataFrame, keys, lookup_small: bool, weight: Column | None = None
) -> DataFrame:
    """``keys`` with the number ``n`` of rows they stand for, ready to meet a lookup.

    Against a broadcast lookup rows pass as they are with weight 1: the join filters them in
    place and the final aggregate combines on the map side. A lookup that needs a shuffle
    meets rows counted per key instead, so that however many samples share a call, neither
    the exchange nor the join sees more than one row of it.
    """
    each = F.lit(1).cast("long") if weight is None else weight.cast("long")
    if lookup_small:
        return rows.select(*keys, each.alias("n"))
    return rows.groupBy(*keys).agg(F.sum(each).alias("n"))


CALL_KEYS = (*SITE_KEYS, "gt", "allele1", "allele2")


def allele_totals(
    alleles: DataFrame, genotypes: DataFrame, group: list[str], lookup_small: bool
) -> DataFrame:
    """Per allele row: strands that carry it, and strands called at the site."""
    calls = counted(genotypes, CALL_KEYS, lookup_small)
    lookup = F.broadcast(alleles) if lookup_small else alleles
    joined = calls.alias("g").join(lookup.alias("v"), site_match("v", "g", SITE_KEYS))
    strands = count_matches(F.col("v.alt_allele"), F.col("g.allele1"), F.col("g.allele2"))
    weighted = joined.select(
        "v.*",
        (strands * F.col("g.n")).alias("__variant"),
        (allele_count(F.col("g.gt")) * F.col("g.n")).alias("__total"),
    )
    return weighted.groupBy(*group).agg(
        F.sum("__variant").alias("num_variant_alleles"),
        F.sum("__total").alias("total_num_alleles"),
    )


def annotate_snp(rows: DataFrame, snp: DataFrame) -> DataFrame:
    """Left join to SNP rows of the locus that list the row's allele; they come as ``snp_*``."""
    condition = site_match("v", "c", LOCUS_KEYS) & F.array_contains(
        F.col("c.alt"), F.col("v.alt_allele")
    )
    extra = [c for c in snp.columns if c not in LOCUS_KEYS]
    joined = rows.alias("v").join(small(snp).alias("c"), condition, "left")
    return joined.select("v.*", *[F.col(f"c.{c}").alias(f"snp_{c}") for c in extra])


def alt_overlap_join(left: DataFrame, right: DataFrame, prefix: str = "r_") -> DataFrame:
    """Rows of one locus whose ALT arrays share an allele."""
    condition = site_match("a", "b", LOCUS_KEYS) & F.arrays_overlap(F.col("a.alt"), F.col("b.alt"))
    extra = [c for c in right.columns if c not in LOCUS_KEYS]
    joined = left.alias("a").join(small(right).alias("b"), condition)
    return joined.select("a.*", *[F.col(f"b.{c}").alias(prefix + c) for c in extra])


def normalize_contigs(
    sites: DataFrame, aliases: DataFrame, chrom: str = "chrom", alias: str = "genbank_id"
) -> DataFrame:
    """Translate contig accessions to chromosome names; the source name stays as
    ``orig_chrom``."""
    names = small(aliases.select(F.col(alias).alias("__alias"), F.col("chrom").alias("__to")))
    joined = sites.withColumnRenamed(chrom, "orig_chrom").join(
        names, F.col("orig_chrom") == F.col("__alias"), "left"
    )
    named = joined.withColumn(chrom, F.coalesce(F.col("__to"), F.col("orig_chrom")))
    others = [c for c in sites.columns if c != chrom]
    return named.select(chrom, "orig_chrom", *others)


def nested_exists(df: DataFrame, calls: str = "genotype") -> DataFrame:
    """Rows whose nested call has a non-reference strand and no missing one."""
    return df.where(
        F.exists(F.col(calls), lambda g: g > 0) & ~F.exists(F.col(calls), lambda g: g < 0)
    )
