"""Call-set quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe.fixtures import fixture
from helixframe.functions.genotype import gt_numbers
from helixframe.functions.text import split_alts
from helixframe.operators.info import parse_info
from helixframe.plans import quality as U
from helixframe.registry import inputs as src
from helixframe.registry.inputs import TOKEN1, TOKEN2, check
from helixframe.registry.scalars import dictionary


def _rounded(df):
    return df.withColumn("titv", F.round("titv", 9))


def titv_nested(spark, sf):
    """Calls held in an array column, as nested stores do, a block of samples per row."""
    calls = src.genotypes(spark, sf).withColumn("genotype", gt_numbers(F.col("gt")))
    block = F.pmod(F.xxhash64("sample_id"), F.lit(16)).alias("block")
    nested = calls.groupBy("chrom", "pos", "ref", "alt", block).agg(
        F.collect_list(F.struct("sample_id", "genotype")).alias("calls")
    )
    return _rounded(U.titv_nested(U.P.autosomes(nested)))


def _qc(plan, chrom=None):
    def run(spark, sf):
        raw = fixture(spark, sf, "sites_fx").withColumn("alt", split_alts(F.col("alt_string")))
        variants = parse_info(raw, dictionary(spark)).select("chrom", "pos", "ref", "alt", "info")
        qc = plan(variants, src.genotypes(spark, sf), F.col("info.AN"), chrom)
        shown = F.transform(
            "homozygotes", lambda h: F.concat(h["allele"], F.lit(":"), h["n"].cast("string"))
        )
        return qc.select(
            "chrom", "pos", "ref", F.array_join("alt", ",").alias("alt"),
            F.round("call_rate", 9).alias("call_rate"), "n_called", "n_not_called", "n_het",
            "n_non_ref", F.array_join(shown, ",").alias("homozygotes"),
        )

    return run


_MUTATION = "ref||'->'||alt_string"


def _titv(where: str) -> str:
    return check(
        "select *, round(transitions/transversions, 9) as titv from (select chrom as reference_name, "
        "sample_id as name, "
        f"count(*) filter ({_MUTATION} in ('A->G','G->A','C->T','T->C')) as transitions, "
        f"count(*) filter ({_MUTATION} not in ('A->G','G->A','C->T','T->C')) as transversions "
        "from geno where chrom not in ('X','Y','MT') and alt_string in ('A','C','G','T') "
        f"and {where} group by chrom, sample_id) c where transversions>0"
    )


def _qc_sql(called: str, where: str = "") -> str:
    return check(
        "select v.chrom, v.pos, v.ref, v.alt_string as alt, round(q.n_called/cast(regexp_extract("
        "v.info,'AN=([0-9]+)',1) as double)*2.0, 9) as call_rate, q.n_called, q.n_not_called, "
        "q.n_het, q.n_non_ref, h.homozygotes from sites_fx v join (select chrom, pos, ref, "
        f"alt_string, count(*) filter ({called}) as n_called, count(*) filter (not ({called})) as "
        f"n_not_called, count(*) filter (allele1<>allele2 and {called}) as n_het, "
        f"count(*) filter ((allele1<>ref or allele2<>ref) and {called}) as n_non_ref "
        "from geno group by all) q on q.chrom=v.chrom and q.pos=v.pos and q.ref=v.ref and "
        "q.alt_string=v.alt_string join (select chrom, pos, ref, alt_string, "
        "string_agg(allele1||':'||n, ',' order by gt) as homozygotes from (select chrom, pos, ref, "
        "alt_string, gt, allele1, count(*) as n from geno where allele1=allele2 group by all) x "
        "group by all) h on h.chrom=v.chrom and h.pos=v.pos and h.ref=v.ref and "
        f"h.alt_string=v.alt_string {where}"
    )


QUERIES = {
    "titv": lambda s, sf: _rounded(U.titv(src.genotypes(s, sf))),
    "titv_materialized": lambda s, sf: _rounded(U.titv_materialized(src.genotypes(s, sf))),
    "titv_nested": titv_nested,
    "variant_qc": _qc(U.variant_qc),
    "variant_qc_one_contig": _qc(U.variant_qc, "20"),
    "variant_qc_materialized": _qc(U.variant_qc_materialized),
    "not_called_histogram": lambda s, sf: U.not_called_histogram(src.genotypes(s, sf)),
}

_NOT_MISSING = "not contains(gt,'.')"
_KNOWN = "allele1 is not null and allele2 is not null"

ORACLES = {
    "titv": _titv(
        f"{_NOT_MISSING} and (split_part(gt,'|',1)<>'0' or (contains(gt,'|') and "
        "split_part(gt,'|',2)<>'0'))"
    ),
    "titv_materialized": _titv(f"(allele1<>ref or allele2<>ref) and {_KNOWN}"),
    "titv_nested": _titv(f"{_NOT_MISSING} and ({TOKEN1}<>'0' or coalesce({TOKEN2},'0')<>'0')"),
    "variant_qc": _qc_sql(_NOT_MISSING),
    "variant_qc_one_contig": _qc_sql(_NOT_MISSING, "where v.chrom='20'"),
    "variant_qc_materialized": _qc_sql(_KNOWN),
    "not_called_histogram": check(
        "select not_called_cnt, count(*) as sites from (select chrom, pos, ref, alt_string, "
        f"count(*) filter ({TOKEN1}='.') as not_called_cnt from geno group by all) s group by 1"
    ),
}
