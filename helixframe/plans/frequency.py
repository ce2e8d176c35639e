"""Frequency annotation against the genotype panel.

``annotation`` holds one ALT per row: chrom, pos, ref, alt_allele, af, af_fin.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.operators import predicates as P
from helixframe.operators.joins import counted, join_panel
from helixframe.session import broadcast_if_small, small

TARGET_COLUMNS = ("af_fin", "af", "chrom", "pos", "alt_allele", "ref")


def population_enriched_sites(
    annotation: DataFrame, population: str = "af_fin", above: float = 0.5, below: float = 0.1
) -> DataFrame:
    """Sites frequent in one population but infrequent overall."""
    return P.freq_filter(P.freq_filter(annotation, population, above=above), "af", below=below)


def _targets(annotation: DataFrame, **thresholds) -> DataFrame:
    return population_enriched_sites(annotation, **thresholds).select(*TARGET_COLUMNS)


def gnomad_compare(
    annotation: DataFrame, alleles: DataFrame, match_ref: bool = False, **thresholds
) -> DataFrame:
    """Those sites next to the panel's own figures for the same allele.

    REF is not part of the match unless asked for; panel columns come back as ``v_*``.
    """
    keys = ["chrom", "pos", "alt_allele", *(["ref"] if match_ref else [])]
    targets = _targets(annotation, **thresholds)
    condition = [F.col(f"t.{c}") == F.col(f"v.{c}") for c in keys]
    joined = alleles.alias("v").join(small(targets).alias("t"), condition)
    extra = [c for c in alleles.columns if c not in ("chrom", "pos", "alt_allele")]
    return joined.select("t.*", *[F.col(f"v.{c}").alias(f"v_{c}") for c in extra]).orderBy(
        "chrom", "pos"
    )


def _carrier_counts(annotation, genotypes, panel, match_ref, thresholds, extra) -> DataFrame:
    """Rows of ``genotypes`` that carry a target's allele, counted by target and ``extra``."""
    targets, is_small = broadcast_if_small(_targets(annotation, **thresholds))
    keys = ["chrom", "pos", "ref", "allele1", "allele2"]
    if panel is not None:
        genotypes = genotypes.select(*keys, "sample_id")
        if is_small:
            # The targets leave few rows; only those meet the panel.
            places = F.broadcast(targets.select("chrom", "pos").distinct())
            genotypes = genotypes.join(places, ["chrom", "pos"], "left_semi")
        genotypes = join_panel(genotypes, panel.select("sample_id", *extra))
    calls = counted(genotypes, [*keys, *extra], is_small)
    condition = (
        (F.col("g.chrom") == F.col("t.chrom"))
        & (F.col("g.pos") == F.col("t.pos"))
        & (
            (F.col("t.alt_allele") == F.col("g.allele1"))
            | (F.col("t.alt_allele") == F.col("g.allele2"))
        )
    )
    if match_ref:
        condition = condition & (F.col("g.ref") == F.col("t.ref"))
    rows = calls.alias("g").join(targets.alias("t"), condition)
    group = [F.col(f"t.{c}") for c in TARGET_COLUMNS] + [F.col(f"g.{c}") for c in extra]
    return rows.groupBy(*group).agg(F.sum("g.n").alias("cnt"))


def gnomad_carriers(
    annotation: DataFrame, genotypes: DataFrame, match_ref: bool = False, **thresholds
) -> DataFrame:
    """Genotype rows that carry the allele, counted per site."""
    counts = _carrier_counts(annotation, genotypes, None, match_ref, thresholds, [])
    return counts.orderBy("chrom", "pos")


def gnomad_carriers_by_pop(
    annotation: DataFrame,
    genotypes: DataFrame,
    panel: DataFrame,
    match_ref: bool = False,
    **thresholds,
) -> DataFrame:
    """The same by population of the carrier, most first."""
    counts = _carrier_counts(annotation, genotypes, panel, match_ref, thresholds, ["pop"])
    return counts.orderBy(F.desc("cnt"), "chrom", "pos", "pop")
