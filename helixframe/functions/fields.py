"""Projections of single VCF fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from helixframe.functions.text import strtok

MISSING = "."


def norm_chrom(chrom: Column) -> Column:
    """Contig name without a leading ``chr``."""
    return F.regexp_replace(chrom, "^chr", "")


def norm_missing(value: Column) -> Column:
    """The VCF missing marker as NULL."""
    return F.nullif(value, F.lit(MISSING))


def norm_missing_alts(alt: Column) -> Column:
    """An ALT array that holds only the missing marker as NULL."""
    return F.nullif(alt, F.array(F.lit(MISSING)))


def rounded_int(value: Column, type_name: str = "int") -> Column:
    """Numeric text as an integer, fractions rounded half away from zero; else NULL.

    The missing marker is taken out first: as a number it would be a failed parse per row.
    """
    return F.round(norm_missing(value).try_cast("double")).try_cast(type_name)


def qual_number(qual: Column) -> Column:
    """QUAL as a whole number; the missing marker is NULL."""
    return rounded_int(qual, "bigint")


def gvcf_end(info: Column, pos: Column) -> Column:
    """Last position of a gVCF row: the END key of INFO, else its own position."""
    return F.coalesce(
        F.nullif(F.regexp_extract(info, r"(?:^|;)END=(\d+)", 1), F.lit("")).try_cast("int"), pos
    )


def norm_block_info(info: Column) -> Column:
    """INFO of a gVCF row; one that only states the block end carries no more information."""
    return F.when(F.startswith(info, F.lit("END=")), F.lit(MISSING)).otherwise(info)


def norm_single_info(info: Column, drop_single_key: bool = True) -> Column:
    """INFO of a single-sample row.

    The single-sample load keeps only INFO texts with several keys; pass
    ``drop_single_key=False`` to keep one-key texts too.
    """
    if drop_single_key:
        return F.when(F.contains(info, F.lit(";")), info)
    return norm_missing(info)


def split_field(keys: Column, values: Column, key: str) -> Column:
    """Text of the FORMAT key ``key`` among split keys and values; NULL where the row lacks it."""
    at = F.array_position(keys, F.lit(key)).cast("int") - F.lit(1)
    return F.nullif(F.get(values, at), F.lit(""))


def format_field(fmt: Column, values: Column, key: str) -> Column:
    """Text of the FORMAT key ``key`` in a sample column; NULL where the row lacks it."""
    return split_field(F.split(fmt, ":"), F.split(values, ":"), key)


def gt_only(sample_column: Column) -> Column:
    """The leading GT token of a sample column."""
    return strtok(sample_column, ":", 1)


def file_name(path: Column) -> Column:
    """Last part of a path."""
    return F.substring_index(path, "/", -1)


def file_stem(path: Column) -> Column:
    """File name up to its first dot (the sample of a per-sample file)."""
    return strtok(file_name(path), ".", 1)


def path_part(path: Column, pattern: str, group: int = 1) -> Column:
    """A regular-expression group of a path; NULL where the pattern does not match."""
    return F.nullif(F.regexp_extract(path, pattern, group), F.lit(""))


def mutation(ref: Column, alt: Column) -> Column:
    """Substitution label ``ref->first ALT``."""
    return F.concat(ref, F.lit("->"), F.get(alt, F.lit(0)))
