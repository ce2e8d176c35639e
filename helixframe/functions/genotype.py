"""Genotype (GT) decoding as native column expressions.

``alt`` is always an array column of alternate alleles, ``gt`` the symbolic call such as
``0|1``, ``1/2``, ``1`` or ``./.``. A phased call is tokenized on ``|``, any other on ``/``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from helixframe.functions.text import tokens

CHROM_X, CHROM_Y, CHROM_MT = 23, 24, 25
GENOKEY_STRIDE = 1_000_000_000


def _is_phased(gt: Column) -> Column:
    return F.contains(gt, F.lit("|"))


def gt_tokens(gt: Column) -> Column:
    """Strand texts of the call; one shared expression, whichever strands are read."""
    return F.when(_is_phased(gt), tokens(gt, "|")).otherwise(tokens(gt, "/"))


def gt_token(gt: Column, which: int) -> Column:
    """Text of one strand of the call, 1-based; NULL where the call has no such strand."""
    return F.get(gt_tokens(gt), F.lit(which - 1))


def token_number(token: Column) -> Column:
    """The number of a strand text; NULL where it is none.

    A failed cast is an exception inside, some 15 microseconds; a no-call never gets that far.
    """
    return F.nullif(token, F.lit(".")).try_cast("int")


def _alt_at(alt: Column, token: Column) -> Column:
    """ALT element a 1-based token points to; NULL for no-calls and out-of-range tokens."""
    return F.get(alt, token_number(token) - F.lit(1))


def token_allele(ref: Column, alt: Column, token: Column) -> Column:
    """Allele a strand text stands for: REF for ``0``, else the ALT it numbers."""
    return F.when(token == "0", ref).otherwise(_alt_at(alt, token))


def allele1(ref: Column, alt: Column, gt: Column) -> Column:
    """Spelled-out first allele."""
    return token_allele(ref, alt, gt_token(gt, 1))


def allele2(ref: Column, alt: Column, gt: Column) -> Column:
    """Spelled-out second allele; NULL for haploid calls."""
    return token_allele(ref, alt, gt_token(gt, 2))


def allele_position(gt: Column, which: int) -> Column:
    """0-based index of the strand's allele in ALT (and per-ALT arrays); NULL for reference."""
    return F.nullif(token_number(gt_token(gt, which)) - F.lit(1), F.lit(-1))


def is_homozygous(gt: Column) -> Column:
    """Both strands equal; an unphased haploid call counts as homozygous."""
    first, second = gt_token(gt, 1), gt_token(gt, 2)
    return F.when(_is_phased(gt), first == second).otherwise(
        (first == second) | second.isNull()
    )


def allele_contained_in(ref: Column, alt: Column, gt: Column, target: Column) -> Column:
    """Either allele is a member of the array ``target``."""
    return F.array_contains(target, allele1(ref, alt, gt)) | F.array_contains(
        target, allele2(ref, alt, gt)
    )


def allele_matches(ref: Column, alt: Column, gt: Column, target: Column) -> Column:
    """Either allele equals ``target``."""
    return (allele1(ref, alt, gt) == target) | (allele2(ref, alt, gt) == target)


def allele_count(gt: Column) -> Column:
    """Number of strands in the call, no-calls included."""
    return F.length(gt) - F.length(F.translate(gt, "/|", "")) + F.lit(1)


def _one_if(condition: Column) -> Column:
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def count_matches(target: Column, first: Column, second: Column) -> Column:
    """How many of two decoded alleles equal ``target`` (NULL alleles never do)."""
    return _one_if(first == target) + _one_if(second == target)


def matching_allele_count(target: Column, ref: Column, alt: Column, gt: Column) -> Column:
    """How many strands carry ``target``: 0, 1 or 2."""
    return count_matches(target, allele1(ref, alt, gt), allele2(ref, alt, gt))


def at_location(pos: Column, end: Column, loc: Column | int) -> Column:
    """The span [pos, end] covers ``loc``, both ends included."""
    at = loc if isinstance(loc, Column) else F.lit(loc)
    return (pos <= at) & (end >= at)


def genokey(chrom: Column, pos: Column) -> Column:
    """Chromosome and position folded into one sortable number; NULL for other contigs."""
    number = (
        F.when(chrom == "X", F.lit(CHROM_X))
        .when(chrom == "Y", F.lit(CHROM_Y))
        .when(chrom.isin("MT", "M"), F.lit(CHROM_MT))
        .otherwise(chrom.try_cast("int"))
    )
    return number.cast("long") * F.lit(GENOKEY_STRIDE).cast("long") + pos


def rebased_index(old_alt: Column, new_alt: Column, token: Column) -> Column:
    """1-based place in ``new_alt`` of the allele a strand text numbers in ``old_alt``.

    NULL for no-calls, 0 for alleles that ``new_alt`` lacks.
    """
    return F.array_position(new_alt, _alt_at(old_alt, token))


def rebased_token(token: Column, index: Column) -> Column:
    """Strand text for a new index: ``0`` stays, unknown alleles become ``.``."""
    return F.when(token == "0", F.lit("0")).otherwise(
        F.coalesce(F.nullif(index, F.lit(0)).cast("string"), F.lit("."))
    )


def join_strands(gt: Column, first: Column, second: Column) -> Column:
    """Two strand texts with the separator of ``gt``; the first alone where it has none."""
    separator = F.when(_is_phased(gt), F.lit("|")).otherwise(F.lit("/"))
    paired = _is_phased(gt) | F.contains(gt, F.lit("/"))
    return F.concat(first, F.when(paired, F.concat(separator, second)).otherwise(F.lit("")))


def rebase_gt(old_alt: Column, new_alt: Column, gt: Column) -> Column:
    """Re-encode a call that indexes ``old_alt`` so that it indexes ``new_alt``.

    Alleles that ``new_alt`` lacks, and no-calls, become ``.``; the separator is kept.
    """
    strands = [
        rebased_token(token, rebased_index(old_alt, new_alt, token))
        for token in (gt_token(gt, 1), gt_token(gt, 2))
    ]
    return join_strands(gt, *strands)


def gt_numbers(gt: Column) -> Column:
    """The call as an integer array, no-call strands as -1 (nested-call layout)."""
    return F.transform(
        gt_tokens(gt), lambda t: F.when(t == ".", F.lit(-1)).otherwise(t.try_cast("int"))
    )
