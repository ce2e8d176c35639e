"""The analyses' input tables, derived from the tables below a test-data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helixframe.fixtures import fixture, with_fixtures
from helixframe.functions.text import split_alts, split_ids
from helixframe.plans.tables import gvcf_view, variants_flattened
from helixframe.plans.tables import with_alleles as decode

CONDITION = "Hereditary_nonpolyposis_colon_cancer"
GENE = "CYP2C19"


def variants(spark: SparkSession, sf: str) -> DataFrame:
    """Sites with ID and ALT arrays and an INFO struct holding AF per ALT."""
    raw = fixture(spark, sf, "variants_fx")
    af = F.transform(F.split("af_string", ","), lambda x: x.cast("double"))
    return raw.select(
        "chrom",
        "pos",
        split_ids(F.col("id")).alias("id"),
        "ref",
        split_alts(F.col("alt_string")).alias("alt"),
        "filter",
        F.struct(af.alias("AF")).alias("info"),
    )


def alleles(spark: SparkSession, sf: str) -> DataFrame:
    return variants_flattened(variants(spark, sf)).drop("info")


def genotypes(spark: SparkSession, sf: str) -> DataFrame:
    raw = fixture(spark, sf, "genotypes_fx")
    return decode(
        raw.select(
            "chrom",
            "pos",
            split_ids(F.col("id")).alias("id"),
            "ref",
            split_alts(F.col("alt_string")).alias("alt"),
            "sample_id",
            "gt",
        )
    )


def panel(spark: SparkSession, sf: str) -> DataFrame:
    return fixture(spark, sf, "panel_fx")


def _annotation(spark: SparkSession, sf: str, name: str) -> DataFrame:
    raw = fixture(spark, sf, name)
    return raw.withColumn("alt", split_alts(F.col("alt_string"))).drop("alt_string")


def snp(spark: SparkSession, sf: str) -> DataFrame:
    return _annotation(spark, sf, "snp_fx")


def clinvar(spark: SparkSession, sf: str) -> DataFrame:
    rows = _annotation(spark, sf, "clinvar_fx")
    return rows.withColumn("clndn", F.split("clndn", ","))


def rsid_list(spark: SparkSession, sf: str) -> DataFrame:
    """Identifiers of the clinically annotated sites, as a list kept as data."""
    return fixture(spark, sf, "clinvar_fx").select(F.concat(F.lit("rs"), "id").alias("rsid"))


def gnomad(spark: SparkSession, sf: str) -> DataFrame:
    raw = fixture(spark, sf, "gnomad_fx")
    return raw.withColumns(
        {"af": F.col("af").cast("double"), "af_fin": F.col("af_fin").cast("double")}
    )


def spans(spark: SparkSession, sf: str) -> DataFrame:
    return gvcf_view(fixture(spark, sf, "gvcf_fx"))


def bed(spark: SparkSession, sf: str) -> DataFrame:
    return fixture(spark, sf, "bed_fx")


def intervals(spark: SparkSession, sf: str) -> DataFrame:
    return fixture(spark, sf, "intervals_fx")


def sites(spark: SparkSession, sf: str) -> DataFrame:
    return fixture(spark, sf, "sites_fx")


def pgx_loci(spark: SparkSession, sf: str) -> DataFrame:
    """Single-ALT sites of chromosome 10, in the role of the pharmacogene loci."""
    raw = fixture(spark, sf, "variants_fx")
    return raw.where((F.col("chrom") == "10") & (F.length("alt_string") == 1)).select(
        "chrom", "pos", "ref", F.col("alt_string").alias("alt")
    )


def flat(df: DataFrame) -> DataFrame:
    """Array columns as comma-joined text, so that results compare across engines."""
    return df.select(
        [
            F.array_join(F.col(f"`{f.name}`"), ",").alias(f.name)
            if isinstance(f.dataType, T.ArrayType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


# Shared pieces of the check statements.

def _token(n: int) -> str:
    return (
        f"nullif(case when contains(gt,'|') then split_part(gt,'|',{n}) "
        f"else split_part(gt,'/',{n}) end,'')"
    )


def allele_sql(n: int, ref: str = "ref", alts: str = "alt_string") -> str:
    token = _token(n)
    return (
        f"case when {token}='0' then {ref} "
        f"else string_split({alts},',')[try_cast({token} as int)] end"
    )


TOKEN1, TOKEN2 = _token(1), _token(2)

GENO = (
    f"select chrom, pos, id, ref, alt_string, sample_id, gt, {allele_sql(1)} as allele1, "
    f"{allele_sql(2)} as allele2 from genotypes_fx"
)

FLAT = (
    "select chrom, pos, id, ref, alt_string, filter, cast(i-1 as int) as alt_allele_id, "
    "split_part(alt_string,',',i) as alt_allele, "
    "cast(split_part(af_string,',',i) as double) as af from (select *, "
    "cast(unnest(range(1, 1+len(string_split(alt_string,',')))) as int) as i from variants_fx) e"
)

SPANS = (
    "select *, split_part(vals,':',1) as gt, try_cast(split_part(vals,':',2) as int) as dp, "
    "try_cast(split_part(vals,':',3) as int) as gq, "
    "try_cast(split_part(vals,':',4) as int) as min_dp from gvcf_fx"
)

ALL_CTES = {"geno": GENO, "flat": FLAT, "spans": SPANS}


def check(sql: str, **extra: str) -> str:
    """A check statement with the fixtures and shared pieces it reads in front."""
    text = " ".join([sql, *extra.values()])
    shared = {name: body for name, body in ALL_CTES.items() if f" {name}" in text}
    return with_fixtures(sql, **shared, **extra)
