"""Population genotype analyses: alleles, conditions, rare variants, gene regions.

``genotypes`` are decoded long rows (chrom, pos, id, ref, alt, sample_id, gt, allele1,
allele2); ``alleles`` are flattened sites (chrom, pos, id, ref, alt, alt_allele_id,
alt_allele, af).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.functions.genotype import is_homozygous
from helixframe.operators import joins as J
from helixframe.operators import predicates as P
from helixframe.operators.extent import measure
from helixframe.operators.intervals import interval_join
from helixframe.session import broadcast_if_small, small
from helixframe.sinks.tables import written

ALLELE_COLUMNS = ("chrom", "pos", "ref", "alt", "alt_allele_id", "alt_allele", "af")


def alleles_by_population(
    genotypes: DataFrame,
    panel: DataFrame,
    chrom: str,
    start: int,
    end: int,
    pop: str,
    gender: str,
    limit: int | None = None,
) -> DataFrame:
    """Non-reference calls of a range, spelled out, for one population and gender.

    A ``limit`` returns the first rows in locus and sample order.
    """
    ranged = P.non_ref(P.locus_range(genotypes, chrom, start, end), reference=P.REFERENCE_CALLS_PHASED)
    members = P.panel_filter(panel, pop, gender).select("sample_id")
    rows = J.join_panel(ranged, members).select(
        "sample_id", "chrom", "pos", "ref", "alt", "gt", "allele1", "allele2"
    )
    if limit is None:
        return rows
    return rows.orderBy("chrom", "pos", "ref", "alt", "sample_id").limit(limit)


def genotype_distribution(genotypes: DataFrame) -> DataFrame:
    """Samples per call of each site."""
    return genotypes.groupBy("chrom", "pos", "ref", "alt", "gt").agg(
        F.count("sample_id").alias("samples")
    )


def _condition_distribution(genotypes, clinvar, condition, carriers_only) -> DataFrame:
    """Samples per call, summed per matching annotation row."""
    annotated = P.has_condition(clinvar, condition).select("chrom", "pos", "ref", "alt")
    lookup, is_small = broadcast_if_small(annotated)
    has_sample = F.when(F.col("sample_id").isNotNull(), F.lit(1)).otherwise(F.lit(0))
    calls = J.counted(genotypes, J.CALL_KEYS, is_small, has_sample)
    return (
        J.join_annotation(calls, lookup, carriers_only)
        .groupBy("chrom", "pos", "ref", "alt", "gt")
        .agg(F.sum("n").alias("samples"))
        .orderBy("chrom", "pos", "gt")
    )


def condition_genotypes(genotypes: DataFrame, clinvar: DataFrame, condition: str) -> DataFrame:
    """Calls seen at the loci of a clinical condition."""
    return _condition_distribution(genotypes, clinvar, condition, False)


def condition_carriers(genotypes: DataFrame, clinvar: DataFrame, condition: str) -> DataFrame:
    """Calls at those loci that carry an allele annotated for the condition."""
    return _condition_distribution(genotypes, clinvar, condition, True)


def common_alleles(
    alleles: DataFrame, chrom: str, above: float, limit: int | None = None
) -> DataFrame:
    """Alleles of one contig above a frequency, in locus order."""
    rows = P.freq_filter(alleles.where(F.col("chrom") == chrom), above=above).select(
        *ALLELE_COLUMNS[:-1], F.col("af").alias("freq")
    )
    ordered = rows.orderBy("chrom", "pos", "ref", "alt", "alt_allele_id")
    return ordered.limit(limit) if limit else ordered


def rare_alleles(
    alleles: DataFrame,
    below: float,
    chrom: str | None = None,
    start: int | None = None,
    end: int | None = None,
) -> DataFrame:
    """Alleles below a frequency, optionally within a range."""
    if chrom is not None:
        alleles = P.locus_range(alleles, chrom, start, end)
    return P.freq_filter(alleles, below=below).select(*ALLELE_COLUMNS)


def rare_carriers(
    alleles: DataFrame,
    genotypes: DataFrame,
    below: float,
    chrom: str | None = None,
    start: int | None = None,
    end: int | None = None,
) -> DataFrame:
    """Samples that carry a rare allele; the range narrows both inputs at their scans."""
    if chrom is not None:
        genotypes = P.locus_range(genotypes, chrom, start, end)
    rare = rare_alleles(alleles, below, chrom, start, end)
    joined = J.join_variant_genotype(
        rare, genotypes.select(*J.SITE_KEYS, "sample_id", "gt", "allele1", "allele2")
    )
    return joined.withColumnRenamed("af", "freq")


def rare_carrier_count(alleles, genotypes, below, chrom=None, start=None, end=None) -> DataFrame:
    """Number of distinct samples with a rare allele."""
    carriers = rare_carriers(alleles, genotypes, below, chrom, start, end)
    return carriers.agg(F.count_distinct("sample_id").alias("carriers"))


def variants_per_sample(alleles, genotypes, below, chrom=None, start=None, end=None) -> DataFrame:
    """Rare alleles per sample, most first."""
    carriers = rare_carriers(alleles, genotypes, below, chrom, start, end)
    return (
        carriers.groupBy("sample_id")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy(F.desc("cnt"), "sample_id")
    )


def rare_homozygous_sites(
    alleles: DataFrame, genotypes_by_sample: DataFrame, sample_id: str, below: float
) -> DataFrame:
    """Sites where one sample is homozygous for a rare allele.

    Meant for the by-sample copy, where one sample is a contiguous read.
    """
    own = genotypes_by_sample.where(
        (F.col("sample_id") == sample_id) & is_homozygous(F.col("gt"))
    )
    carried = P.freq_filter(alleles, below=below).select(*ALLELE_COLUMNS)
    listed = F.array_contains(F.col("alt"), F.col("allele1")) | F.array_contains(
        F.col("alt"), F.col("allele2")
    )
    own = own.where(listed).select(*J.SITE_KEYS, "sample_id", "gt", "allele1", "allele2")
    # One sample is the small side here, so it is the one considered for broadcast.
    condition = J.site_match("v", "g", J.SITE_KEYS) & (
        (F.col("v.alt_allele") == F.col("g.allele1")) | (F.col("v.alt_allele") == F.col("g.allele2"))
    )
    joined = carried.alias("v").join(small(own).alias("g"), condition)
    return joined.select(
        "v.*", *[F.col(f"g.{c}") for c in ("sample_id", "gt", "allele1", "allele2")]
    ).orderBy("chrom", "pos")


def gene_intervals(branches: list[DataFrame]) -> DataFrame:
    """Regions of several sources as one set."""
    regions = branches[0]
    for branch in branches[1:]:
        regions = regions.union(branch)
    return regions.distinct()


def interval_allele_frequency(
    alleles: DataFrame,
    genotypes: DataFrame,
    intervals: DataFrame,
    snp: DataFrame,
    below: float,
) -> DataFrame:
    """Allele counts of infrequent alleles within gene regions, with SNP annotation.

    The regions first narrow the alleles (a range join that broadcasts the regions), and the
    surviving alleles, written once since two steps read them, are looked up by the
    genotypes within their extent. The SNP table joins the few rows that remain, read only
    within that extent too.
    """
    infrequent = P.freq_filter(alleles, below=below).select(*ALLELE_COLUMNS)
    in_region = interval_join(
        infrequent, intervals.select("gene", "chrom", "region_start", "region_end")
    ).drop("region_start", "region_end")
    in_region = written(in_region, "alleles_in_region")
    extent = measure(in_region, "chrom", "pos", "pos")
    near = extent.near(genotypes, "chrom", "pos", "pos")
    group = ["chrom", "pos", "ref", "alt", "alt_allele", "gene", "af"]
    totals = J.allele_totals(in_region, near, group, extent.is_small())
    annotated = J.annotate_snp(totals, extent.near(snp, "chrom", "pos", "pos"))
    return annotated.orderBy("chrom", "pos", "alt_allele")


def gene_rare_variants(
    alleles: DataFrame, genotypes: DataFrame, snp: DataFrame, gene: str, below: float
) -> DataFrame:
    """Allele counts of a gene's infrequent variants, found by SNP annotation.

    The annotation matches on contig, position and the whole ALT array, not on REF.
    """
    listed = P.gene_prefix(snp, gene).select("chrom", "pos", "alt", "geneinfo")
    infrequent = P.freq_filter(alleles, below=below)
    keys: list[Column] = [F.col(f"a.{c}") == F.col(f"s.{c}") for c in ("chrom", "pos", "alt")]
    chosen = infrequent.alias("a").join(small(listed).alias("s"), keys).select("a.*", "s.geneinfo")
    chosen = written(chosen, "gene_alleles")
    extent = measure(chosen, "chrom", "pos", "pos")
    near = extent.near(genotypes, "chrom", "pos", "pos")
    group = ["chrom", "pos", "ref", "alt", "alt_allele", "af", "geneinfo", "id"]
    return J.allele_totals(chosen, near, group, extent.is_small())


def rsid_variants(
    alleles: DataFrame, genotypes: DataFrame, snp: DataFrame, gene: str, below: float, rsids
) -> DataFrame:
    """The same for listed identifiers; they narrow the alleles before any join."""
    return gene_rare_variants(P.by_rsid(alleles, rsids), genotypes, snp, gene, below)
