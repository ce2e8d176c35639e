"""The genotype functions and the cohort's table functions under their SQL names.

They are SQL functions, so Catalyst inlines their bodies into the calling plan; no call
leaves the JVM. Bodies are plain SQL because a Column cannot be turned into SQL text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from helixframe.operators.extent import LEVELS

SQL_FUNCTIONS = {
    "gt_token": (
        "(gt STRING, n INT) RETURNS STRING",
        "get(array_remove(split(gt, CASE WHEN contains(gt, '|') THEN r'\\|' ELSE '/' END), ''), n - 1)",
    ),
    "allele1": (
        "(ref STRING, alt ARRAY<STRING>, gt STRING) RETURNS STRING",
        "CASE WHEN gt_token(gt, 1) = '0' THEN ref "
        "ELSE get(alt, try_cast(gt_token(gt, 1) AS INT) - 1) END",
    ),
    "allele2": (
        "(ref STRING, alt ARRAY<STRING>, gt STRING) RETURNS STRING",
        "CASE WHEN gt_token(gt, 2) = '0' THEN ref "
        "ELSE get(alt, try_cast(gt_token(gt, 2) AS INT) - 1) END",
    ),
    "allele_position": (
        "(gt STRING, which INT) RETURNS INT",
        "nullif(try_cast(gt_token(gt, which) AS INT) - 1, -1)",
    ),
    "is_homozygous": (
        "(gt STRING) RETURNS BOOLEAN",
        "gt_token(gt, 1) = gt_token(gt, 2) "
        "OR (NOT contains(gt, '|') AND gt_token(gt, 2) IS NULL)",
    ),
    "allele_contained_in": (
        "(ref STRING, alt ARRAY<STRING>, gt STRING, target ARRAY<STRING>) RETURNS BOOLEAN",
        # A lambda keeps the calling projection out of one generated method too large to be compiled.
        "exists(array(allele1(ref, alt, gt), allele2(ref, alt, gt)), a -> array_contains(target, a))",
    ),
    "allele_matches": (
        "(ref STRING, alt ARRAY<STRING>, gt STRING, target STRING) RETURNS BOOLEAN",
        "target IN (allele1(ref, alt, gt), allele2(ref, alt, gt))",
    ),
    "allele_count": (
        "(gt STRING) RETURNS INT",
        "length(gt) - length(translate(gt, '/|', '')) + 1",
    ),
    "matching_allele_count": (
        "(target STRING, ref STRING, alt ARRAY<STRING>, gt STRING) RETURNS INT",
        "coalesce(cast(target = allele1(ref, alt, gt) AS INT), 0) "
        "+ coalesce(cast(target = allele2(ref, alt, gt) AS INT), 0)",
    ),
    "at_location": (
        "(pos INT, end_pos INT, loc INT) RETURNS BOOLEAN",
        "loc BETWEEN pos AND end_pos",
    ),
    "genokey": (
        "(chrom STRING, pos INT) RETURNS BIGINT",
        "CASE chrom WHEN 'X' THEN 23 WHEN 'Y' THEN 24 WHEN 'MT' THEN 25 WHEN 'M' THEN 25 "
        "ELSE try_cast(chrom AS INT) END * 1000000000L + pos",
    ),
    "rebase_gt": (
        "(old_alt ARRAY<STRING>, new_alt ARRAY<STRING>, gt STRING) RETURNS STRING",
        "concat(CASE WHEN gt_token(gt, 1) = '0' THEN '0' ELSE coalesce(cast(nullif("
        "array_position(new_alt, get(old_alt, try_cast(gt_token(gt, 1) AS INT) - 1)), 0) "
        "AS STRING), '.') END, CASE WHEN gt RLIKE '[/|]' THEN concat("
        "CASE WHEN contains(gt, '|') THEN '|' ELSE '/' END, "
        "CASE WHEN gt_token(gt, 2) = '0' THEN '0' ELSE coalesce(cast(nullif("
        "array_position(new_alt, get(old_alt, try_cast(gt_token(gt, 2) AS INT) - 1)), 0) "
        "AS STRING), '.') END) ELSE '' END)",
    ),
}

# Table functions over the view ``cohort_spans`` (the gVCF view); a NULL contig means all.
SPANS_VIEW = "cohort_spans"
_OF_CONTIG = "(contig IS NULL OR chrom = contig)"
_LEVEL = (
    "CASE "
    + " ".join(f"WHEN end_pos - pos < {1 << level} THEN {level}" for level in LEVELS[:-1])
    + f" ELSE {LEVELS[-1]} END"
)

TABLE_FUNCTIONS = {
    "spans_at": (
        "(contig STRING, loc INT) RETURNS TABLE (chrom STRING, pos INT, end_pos INT, ref STRING, "
        "alt ARRAY<STRING>, sample_id STRING, gt STRING)",
        f"SELECT chrom, pos, end_pos, ref, alt, sample_id, gt FROM {SPANS_VIEW} "
        "WHERE chrom = contig AND pos <= loc AND end_pos >= loc",
    ),
    "cohort_loci": (
        "(contig STRING) RETURNS TABLE (chrom STRING, pos INT, ref STRING, alt ARRAY<STRING>)",
        "SELECT chrom, pos, ref, array_sort(collect_list(allele)) FROM (SELECT DISTINCT chrom, pos, ref, allele "
        f"FROM {SPANS_VIEW} LATERAL VIEW explode(alt) AS allele "
        f"WHERE alt_string <> '<NON_REF>' AND {_OF_CONTIG}) GROUP BY chrom, pos, ref",
    ),
    # A locus meets the spans that cover it in bins as wide as the spans, as in the range join.
    "cohort_counts": (
        "(contig STRING) RETURNS TABLE (chrom STRING, pos INT, ref STRING, alt_string STRING, gt STRING, cnt BIGINT)",
        "WITH calls AS (SELECT chrom, pos, end_pos, alt, gt, count(*) AS n "
        f"FROM {SPANS_VIEW} WHERE end_pos >= pos AND {_OF_CONTIG} GROUP BY chrom, pos, end_pos, alt, gt), "
        f"levelled AS (SELECT *, {_LEVEL} AS width FROM calls), "
        "binned AS (SELECT *, explode(sequence(shiftright(pos, width), shiftright(end_pos, width))) AS bin FROM levelled), "
        f"widened AS (SELECT *, explode(array{LEVELS}) AS width FROM cohort_loci(contig)), "
        "probes AS (SELECT *, shiftright(pos, width) AS bin FROM widened), "
        "met AS (SELECT p.chrom, p.pos, p.ref, array_join(p.alt, ',') AS alt_string, rebase_gt(b.alt, p.alt, b.gt) AS gt, b.n "
        "FROM probes p JOIN binned b ON p.chrom = b.chrom AND p.width = b.width AND p.bin = b.bin "
        "AND b.pos <= p.pos AND b.end_pos >= p.pos) "
        "SELECT chrom, pos, ref, alt_string, gt, sum(n) FROM met GROUP BY chrom, pos, ref, alt_string, gt",
    ),
}


def register_functions(spark: SparkSession) -> list[str]:
    """Create the functions for this session and return their names."""
    for name, (signature, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{signature} RETURN {body}")
    return list(SQL_FUNCTIONS)


def register_table_functions(spark: SparkSession, spans: DataFrame) -> list[str]:
    """Create the table functions over ``spans``, with the scalar ones they call."""
    register_functions(spark)
    spans.createOrReplaceTempView(SPANS_VIEW)
    for name, (signature, body) in TABLE_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{signature} RETURN {body}")
    return list(TABLE_FUNCTIONS)
