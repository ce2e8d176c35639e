"""Call-set quality: transition/transversion ratios, call rates, no-call histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.functions import genotype as G
from helixframe.functions.fields import mutation
from helixframe.operators import predicates as P
from helixframe.operators.joins import nested_exists

# purine/purine and pyrimidine/pyrimidine changes, and all others.
TRANSITIONS = ("A->G", "G->A", "C->T", "T->C")
TRANSVERSIONS = ("A->C", "C->A", "G->T", "T->G", "A->T", "T->A", "C->G", "G->C")

SITE = ("chrom", "pos", "ref", "alt")


def _count_if(condition: Column) -> Column:
    return F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0)))


def titv_counts(snp_calls: DataFrame) -> DataFrame:
    """Transitions, transversions and their ratio per contig and sample."""
    labelled = snp_calls.select(
        F.col("chrom").alias("reference_name"),
        F.col("sample_id").alias("name"),
        mutation(F.col("ref"), F.col("alt")).alias("mutation"),
    )
    counts = labelled.groupBy("reference_name", "name").agg(
        _count_if(F.col("mutation").isin(*TRANSITIONS)).alias("transitions"),
        _count_if(F.col("mutation").isin(*TRANSVERSIONS)).alias("transversions"),
    )
    return (
        counts.where(F.col("transversions") > 0)
        .withColumn("titv", F.col("transitions") / F.col("transversions"))
        .orderBy(F.desc("titv"), "name")
    )


def titv(genotypes: DataFrame) -> DataFrame:
    """Ratio from symbolic calls (autosomes, biallelic substitutions)."""
    calls = P.biallelic_snps(P.autosomes(genotypes))
    return titv_counts(P.is_called(P.carries_alt(calls)))


def titv_materialized(genotypes: DataFrame) -> DataFrame:
    """Ratio from spelled-out alleles; haploid calls do not take part."""
    first, second = F.col("allele1"), F.col("allele2")
    carries = (first != F.col("ref")) | (second != F.col("ref"))
    calls = P.biallelic_snps(P.autosomes(genotypes))
    return titv_counts(calls.where(carries & P.alleles_called(first, second)))


def titv_nested(nested: DataFrame) -> DataFrame:
    """Ratio from sites that hold their calls as an array of (sample_id, genotype).

    ``genotype`` is an integer array with -1 for a missing strand.
    """
    calls = P.biallelic_snps(nested).select("*", F.explode("calls").alias("call"))
    flat = calls.select("chrom", "ref", "alt", "call.sample_id", "call.genotype")
    return titv_counts(nested_exists(flat))


def _site_qc(genotypes: DataFrame, called: Column, not_called: Column) -> DataFrame:
    """Per site: call counters, and the counts of homozygous calls by allele.

    One pass serves both: rows are first counted per call, which the exchange then carries
    instead of samples, and the counters and the (short) list of calls come from that.
    """
    per_call = genotypes.groupBy(*SITE, "gt", "allele1", "allele2").agg(
        F.count(F.lit(1)).alias("n")
    )
    first, second, ref = F.col("allele1"), F.col("allele2"), F.col("ref")

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(F.lit(0)))

    homozygous = F.when(first == second, F.struct(F.col("gt"), first.alias("allele"), F.col("n")))
    return per_call.groupBy(*SITE).agg(
        total(((first != ref) | (second != ref)) & called).alias("n_non_ref"),
        total((first != second) & called).alias("n_het"),
        total(called).alias("n_called"),
        total(not_called).alias("n_not_called"),
        F.sort_array(F.collect_list(homozygous)).alias("homozygotes"),
    )


def homozygote_counts(genotypes: DataFrame) -> DataFrame:
    """Per site the list of (gt, allele, count) of homozygous calls, in call order."""
    calls = (
        genotypes.where(F.col("allele1") == F.col("allele2"))
        .groupBy(*SITE, "gt", F.col("allele1").alias("allele"))
        .agg(F.count("gt").alias("n"))
    )
    return calls.groupBy(*SITE).agg(
        F.sort_array(F.collect_list(F.struct("gt", "allele", "n"))).alias("homozygotes")
    )


def _variant_qc(variants: DataFrame, qc: DataFrame, an: Column) -> DataFrame:
    """Sites with their counters; sites without any homozygous call do not appear."""
    shown = qc.where(F.size("homozygotes") > 0)
    joined = variants.join(shown, list(SITE))
    return joined.withColumn("call_rate", F.try_divide(F.col("n_called"), an) * F.lit(2.0)).orderBy(
        "chrom", "pos", "ref", "alt"
    )


def variant_qc(
    variants: DataFrame, genotypes: DataFrame, an: Column, chrom: str | None = None
) -> DataFrame:
    """Call rate and call counters per site, a call being missing when its text has ``.``.

    The site key includes the contig, so equal positions of other contigs never match.
    """
    missing = F.instr(F.col("gt"), ".") != 0
    return _qc(variants, genotypes, an, chrom, ~missing, missing)


def variant_qc_materialized(
    variants: DataFrame, genotypes: DataFrame, an: Column, chrom: str | None = None
) -> DataFrame:
    """The same from spelled-out alleles, a call being missing when either allele is."""
    known = P.alleles_called(F.col("allele1"), F.col("allele2"))
    return _qc(variants, genotypes, an, chrom, known, ~known)


def _qc(variants, genotypes, an, chrom, called, not_called) -> DataFrame:
    if chrom is not None:
        variants = variants.where(F.col("chrom") == chrom)
        genotypes = genotypes.where(F.col("chrom") == chrom)
    return _variant_qc(variants, _site_qc(genotypes, called, not_called), an)


def not_called_histogram(genotypes: DataFrame) -> DataFrame:
    """Number of sites by how many of their calls are missing in the first strand."""
    first_missing = G.gt_token(F.col("gt"), 1) == "."
    per_site = genotypes.groupBy(*SITE).agg(_count_if(first_missing).alias("not_called_cnt"))
    return per_site.groupBy("not_called_cnt").agg(F.count(F.lit(1)).alias("sites"))
