"""Logical tables the analyses share: decoded genotypes, flattened sites, gVCF spans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.functions import fields as V
from helixframe.functions import genotype as G
from helixframe.functions.text import split_alts
from helixframe.operators.reshape import flatten_alts

# INFO keys with one value per ALT that the flattened view shows.
PER_ALT_KEYS = ("AC", "AF", "EAS_AF", "AMR_AF", "AFR_AF", "EUR_AF", "SAS_AF")

# FORMAT keys of the gVCF view and their types.
FORMAT_INTEGERS = ("DP", "GQ", "MIN_DP", "PS", "STR_MAX_LEN", "STR_PERIOD")
FORMAT_TEXTS = ("VAR_TYPE", "VAR_CONTEXT")
FORMAT_DOUBLES = ("STR_TIMES",)


def _with_tokens(calls: DataFrame, gt: str) -> DataFrame:
    """The call's strand texts as columns, so that later expressions do not split it again.

    The optimizer keeps the projections apart because the columns are used repeatedly.
    """
    split = calls.withColumn("__tokens", G.gt_tokens(F.col(gt)))
    return split.withColumns(
        {f"__token{n}": F.get("__tokens", F.lit(n - 1)) for n in (1, 2)}
    ).drop("__tokens")


def decode_calls(
    calls: DataFrame, ref: str = "ref", alt: str = "alt", gt: str = "gt"
) -> DataFrame:
    """Calls with both alleles spelled out as ``allele1`` and ``allele2``."""
    ref_col, alt_col = F.col(ref), F.col(alt)
    return _with_tokens(calls, gt).withColumns(
        {f"allele{n}": G.token_allele(ref_col, alt_col, F.col(f"__token{n}")) for n in (1, 2)}
    ).drop("__token1", "__token2")


def with_alleles(genotypes: DataFrame) -> DataFrame:
    """Genotypes with both alleles spelled out."""
    return decode_calls(genotypes)


def rebase_calls(
    calls: DataFrame, old_alt: str, new_alt: str, gt: str, out: str
) -> DataFrame:
    """Calls with GT re-encoded from one ALT list to another, as the column ``out``."""
    indexed = _with_tokens(calls, gt).withColumns(
        {
            f"__index{n}": G.rebased_index(F.col(old_alt), F.col(new_alt), F.col(f"__token{n}"))
            for n in (1, 2)
        }
    )
    strands = [G.rebased_token(F.col(f"__token{n}"), F.col(f"__index{n}")) for n in (1, 2)]
    return indexed.withColumn(out, G.join_strands(F.col(gt), *strands)).drop(
        "__token1", "__token2", "__index1", "__index2"
    )


def variants_flattened(variants: DataFrame, info: str = "info") -> DataFrame:
    """One row per ALT allele, with its values of the per-ALT INFO keys that are present.

    The arrays leave the struct before the rows multiply, so the scan reads only the keys
    that a query goes on to use.
    """
    present = [f.name for f in variants.schema[info].dataType.fields]
    keys = [key for key in PER_ALT_KEYS if key in present]
    arrays = {f"__{key}": F.col(f"{info}.{key}") for key in keys}
    flat = flatten_alts(variants.withColumns(arrays))
    per_alt = {key.lower(): F.get(f"__{key}", F.col("alt_allele_id")) for key in keys}
    return flat.withColumns(per_alt).drop(*arrays)


def gvcf_view(raw: DataFrame) -> DataFrame:
    """gVCF spans with the ALT array and the FORMAT keys as columns.

    FORMAT and values are split once per row, as columns that all keys are looked up in; the
    optimizer keeps that projection apart because the columns are used repeatedly, and drops
    the keys, or both, that a query does not read.
    """
    split = raw.withColumns({"__keys": F.split("format", ":"), "__values": F.split("vals", ":")})

    def field(key: str) -> Column:
        return V.split_field(F.col("__keys"), F.col("__values"), key)

    columns = {"alt": split_alts(F.col("alt_string"))}
    columns |= {key.lower(): V.rounded_int(field(key)) for key in FORMAT_INTEGERS}
    columns |= {key.lower(): field(key) for key in FORMAT_TEXTS}
    columns |= {key.lower(): field(key).try_cast("double") for key in FORMAT_DOUBLES}
    if "gt" not in raw.columns:
        columns["gt"] = field("GT")
    return split.withColumns(columns).drop("__keys", "__values")
