"""Row filters. Each takes and returns a DataFrame and compiles to pushed-down predicates
wherever the condition touches plain columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.functions import genotype as G
from helixframe.session import small

# Symbolic calls without an alternate allele, and the gVCF block marker.
REFERENCE_CALLS = ("0/0", "./.", "0", ".")
REFERENCE_CALLS_PHASED = ("0|0",)
NON_REF_BLOCK = "<NON_REF>"
BASES = ("A", "C", "G", "T")
OVERLAP_ALT = "<*>"
NON_AUTOSOMES = ("X", "Y", "MT")


def locus_range(
    df: DataFrame, chrom: str, start: int | None = None, end: int | None = None, pos: str = "pos"
) -> DataFrame:
    """Rows of one contig between two positions, both included; either may be open."""
    rows = df.where(F.col("chrom") == chrom)
    if start is not None:
        rows = rows.where(F.col(pos) >= start)
    if end is not None:
        rows = rows.where(F.col(pos) <= end)
    return rows


def covering(
    df: DataFrame, chrom: str, loc: int, start: str = "pos", end: str = "end_pos"
) -> DataFrame:
    """Spans of one contig that cover a position."""
    return df.where((F.col("chrom") == chrom) & G.at_location(F.col(start), F.col(end), loc))


def non_ref(df: DataFrame, gt: str = "gt", reference: tuple[str, ...] = REFERENCE_CALLS) -> DataFrame:
    """Calls other than the listed reference and no-call texts (NULL calls drop out)."""
    return df.where(~F.col(gt).isin(*reference))


def non_ref_block(df: DataFrame, alt_string: str = "alt_string") -> DataFrame:
    """Rows that are not pure gVCF reference blocks."""
    return df.where(F.col(alt_string) != NON_REF_BLOCK)


def pass_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("filter") == "PASS")


def single_base(df: DataFrame, start: str = "pos", end: str = "end_pos") -> DataFrame:
    return df.where(F.col(start) == F.col(end))


def autosomes(df: DataFrame) -> DataFrame:
    return df.where(~F.col("chrom").isin(*NON_AUTOSOMES))


def biallelic_snps(df: DataFrame, ref: str = "ref", alt: str = "alt") -> DataFrame:
    """Single-base substitutions with one ALT, or with ``<*>`` as a second one."""
    first, size = F.get(F.col(alt), F.lit(0)), F.size(F.col(alt))
    second_is_overlap = (size == 2) & (F.get(F.col(alt), F.lit(1)) == OVERLAP_ALT)
    return df.where(
        F.col(ref).isin(*BASES) & first.isin(*BASES) & ((size == 1) | second_is_overlap)
    )


def called(gt: Column) -> Column:
    """The symbolic call has no missing strand."""
    return F.instr(gt, ".") == 0


def alleles_called(first: Column, second: Column) -> Column:
    """Both decoded alleles are known."""
    return first.isNotNull() & second.isNotNull()


def is_called(df: DataFrame, gt: str = "gt") -> DataFrame:
    return df.where(called(F.col(gt)))


def carries_alt(df: DataFrame, gt: str = "gt") -> DataFrame:
    """Calls, phased or not, with a strand other than the reference."""
    call = F.col(gt)
    return df.where((G.gt_token(call, 1) != "0") | (G.gt_token(call, 2) != "0"))


def freq_filter(
    df: DataFrame, af: str = "af", below: float | None = None, above: float | None = None
) -> DataFrame:
    """Rows whose allele frequency lies strictly below and/or above the thresholds."""
    if below is not None:
        df = df.where(F.col(af) < below)
    if above is not None:
        df = df.where(F.col(af) > above)
    return df


def panel_filter(panel: DataFrame, pop: str | None = None, gender: str | None = None) -> DataFrame:
    if pop is not None:
        panel = panel.where(F.col("pop") == pop)
    if gender is not None:
        panel = panel.where(F.col("gender") == gender)
    return panel


def has_condition(df: DataFrame, condition: str, conditions: str = "clndn") -> DataFrame:
    """Rows whose condition list names the condition."""
    return df.where(F.array_contains(F.col(conditions), condition))


def by_rsid(df: DataFrame, rsids: DataFrame | Iterable[str], ids: str = "id") -> DataFrame:
    """Rows whose first identifier is listed; the comparison is literal.

    ``rsids`` is a list, or a table with the column ``rsid`` for lists kept as data.
    """
    first = F.get(F.col(ids), F.lit(0))
    if not isinstance(rsids, DataFrame):
        return df.where(first.isin(*rsids))
    wanted = small(rsids.select("rsid").distinct())
    return df.join(wanted, first == F.col("rsid"), "left_semi")


def gene_prefix(df: DataFrame, gene: str, geneinfo: str = "geneinfo") -> DataFrame:
    """Rows whose GENEINFO text begins with the gene."""
    return df.where(F.startswith(F.col(geneinfo), F.lit(gene)))
