"""Scalar genotype and field functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe.fixtures import SITE_HEADER, fixture
from helixframe.functions import fields as V
from helixframe.functions import genotype as G
from helixframe.functions.sql import register_functions
from helixframe.functions.text import split_alts, split_ids
from helixframe.operators import info as I
from helixframe.registry import inputs as src
from helixframe.session import literal_table
from helixframe.registry.inputs import TOKEN1, TOKEN2, check, flat

KEYS = ("chrom", "pos", "ref", "sample_id", "gt")

def _genotype_columns(**columns):
    """A query that adds expressions to every genotype row."""

    def run(spark, sf):
        rows = src.genotypes(spark, sf)
        ref, alt, gt = F.col("ref"), F.col("alt"), F.col("gt")
        made = [build(ref, alt, gt).alias(name) for name, build in columns.items()]
        return rows.select(*KEYS, *made)

    return run


def _genotype_check(**columns: str) -> str:
    made = ", ".join(f"{text} as {name}" for name, text in columns.items())
    return check(f"select {', '.join(KEYS)}, {made} from geno")


def _target(alt):
    return F.get(alt, F.lit(0))


def dictionary(spark):
    return I.info_dictionary(literal_table(spark, [(x,) for x in SITE_HEADER], "text string"))


def allele_contained_in(spark, sf):
    rows = src.genotypes(spark, sf).alias("g").join(
        src.clinvar(spark, sf).select("chrom", "pos", F.col("alt").alias("target")),
        ["chrom", "pos"],
    )
    hit = G.allele_contained_in(F.col("ref"), F.col("alt"), F.col("gt"), F.col("target"))
    return rows.select(*KEYS, hit.alias("hit"))


def genokey(spark, sf):
    rows = src.variants(spark, sf)
    return rows.select("chrom", "pos", G.genokey(F.col("chrom"), F.col("pos")).alias("genokey"))


def rebase_gt(spark, sf):
    """Calls re-encoded to the alphabetically sorted ALT list of their row."""
    rows = src.spans(spark, sf)
    sorted_alt = F.sort_array("alt")
    return rows.select(
        "chrom", "pos", "sample_id", "gt", "alt_string",
        G.rebase_gt(F.col("alt"), sorted_alt, F.col("gt")).alias("new_gt"),
    )


_SORTED = "list_sort(string_split(alt_string,','))"


def _recode(token: str) -> str:
    return (
        f"case when {token}='0' then '0' else coalesce(cast(nullif(list_position({_SORTED}, "
        f"string_split(alt_string,',')[try_cast({token} as int)]),0) as varchar),'.') end"
    )


def at_location(spark, sf):
    """Spans and whether they cover the position 100 bases into their 1000-base window."""
    rows = src.spans(spark, sf)
    loc = F.floor(F.col("pos") / F.lit(1000)) * F.lit(1000) + F.lit(100)
    return rows.select(
        "chrom", "pos", "end_pos", "sample_id",
        G.at_location(F.col("pos"), F.col("end_pos"), loc).alias("covers"),
    )


def sql_functions(spark, sf):
    """The functions under their SQL names, called from SQL."""
    register_functions(spark)
    src.genotypes(spark, sf).select(*KEYS, "alt").createOrReplaceTempView("genotype_calls")
    return spark.sql(
        "select chrom, pos, ref, sample_id, gt, allele1(ref, alt, gt) as a1, "
        "allele2(ref, alt, gt) as a2, allele_position(gt, 1) as p1, is_homozygous(gt) as hom, "
        "allele_count(gt) as n, matching_allele_count(alt[0], ref, alt, gt) as m, "
        "allele_matches(ref, alt, gt, alt[0]) as hit, genokey(chrom, pos) as k, "
        "allele_contained_in(ref, alt, gt, array(alt[0])) as held, at_location(pos, pos + 9, 3005) as here, "
        "rebase_gt(alt, sort_array(alt), gt) as new_gt from genotype_calls"
    )


def norm_chrom(spark, sf):
    rows = fixture(spark, sf, "gvcf_lines_fx").select(F.split_part("line_text", F.lit("\t"), F.lit(1)).alias("raw"))
    return rows.groupBy(V.norm_chrom(F.col("raw")).alias("chrom"), "raw").agg(F.count("*").alias("n"))


def norm_missing(spark, sf):
    lines = fixture(spark, sf, "gvcf_lines_fx")
    part = F.split("line_text", "\t")
    return lines.select(
        "sample_id", "chrom", "pos",
        V.norm_missing(F.get(part, F.lit(2))).alias("id"),
        V.norm_missing(F.get(part, F.lit(5))).alias("qual"),
        F.coalesce(
            F.array_join(V.norm_missing_alts(split_alts(F.get(part, F.lit(2)))), ","), F.lit("none")
        ).alias("alts"),
    )


def gvcf_end(spark, sf):
    lines = fixture(spark, sf, "gvcf_lines_fx")
    info = F.split_part("line_text", F.lit("\t"), F.lit(8))
    return lines.select("sample_id", "chrom", "pos", V.gvcf_end(info, F.col("pos")).alias("end_pos"))


def norm_info(spark, sf):
    rows = fixture(spark, sf, "gvcf_lines_fx")
    info = F.split_part("line_text", F.lit("\t"), F.lit(8))
    site_info = src.sites(spark, sf).select("chrom", "pos", V.norm_single_info(F.col("info")).alias("info"))
    blocks = rows.select("chrom", "pos", V.norm_block_info(info).alias("info"))
    single = rows.select("chrom", "pos", V.norm_single_info(info).alias("info"))
    return blocks.unionAll(single).unionAll(site_info)


def split_lists(spark, sf):
    rows = src.sites(spark, sf)
    ids, alts = split_ids(F.col("id")), split_alts(F.col("alt_string"))
    return rows.select(
        "chrom", "pos", F.size(ids).alias("n_ids"), F.get(ids, F.lit(1)).alias("second_id"),
        F.size(alts).alias("n_alts"), F.get(alts, F.lit(0)).alias("first_alt"),
    )


def format_field(spark, sf):
    rows = fixture(spark, sf, "gvcf_fx")
    fmt, vals = F.col("format"), F.col("vals")
    return rows.select(
        "chrom", "pos", "sample_id",
        V.rounded_int(V.format_field(fmt, vals, "DP")).alias("dp"),
        V.rounded_int(V.format_field(fmt, vals, "GQ")).alias("gq"),
        V.rounded_int(V.format_field(fmt, vals, "MIN_DP")).alias("min_dp"),
        V.format_field(fmt, vals, "VAR_TYPE").alias("var_type"),
    )


def gt_only(spark, sf):
    rows = fixture(spark, sf, "gvcf_fx")
    return rows.select("chrom", "pos", "sample_id", V.gt_only(F.col("vals")).alias("gt"))


def info_path(spark, sf):
    """Paths into INFO kept as VARIANT."""
    parsed = I.parse_info(src.sites(spark, sf), dictionary(spark))
    rows = I.info_variant(parsed)
    info = F.col("info")
    return rows.select(
        "chrom", "pos",
        I.variant_path(info, "$.AF[0]", "double").alias("af0"),
        I.variant_path(info, "$.AF[1]", "double").alias("af1"),
        I.variant_path(info, "$.AN", "bigint").alias("an"),
        I.variant_path(info, "$.VT[0]", "string").alias("vt0"),
    )


def parse_info(spark, sf):
    rows = I.parse_info(src.sites(spark, sf), dictionary(spark))
    return rows.select(
        "chrom", "pos", "ref",
        F.get("info.AC", F.lit(0)).alias("ac0"), F.get("info.AC", F.lit(1)).alias("ac1"),
        F.get("info.AF", F.lit(0)).alias("af0"), F.get("info.AF", F.lit(1)).alias("af1"),
        F.col("info.AN").alias("an"), F.coalesce("info.DB", F.lit(False)).alias("db"),
        F.array_join("info.VT", "+").alias("vt"), F.col("info.DP").alias("dp"),
    )


def parse_info_flat(spark, sf):
    """One ALT per row: the first values of the per-ALT keys, parsed as scalars."""
    flat_info = F.regexp_replace("info", r"(A[CF]=[^,;]*),[^;]*", "$1")
    rows = I.parse_info_flat(src.sites(spark, sf).withColumn("info", flat_info), dictionary(spark))
    return rows.select(
        "chrom", "pos", "ref", F.col("info.AC").alias("ac"), F.col("info.AF").alias("af"),
        F.col("info.AN").alias("an"), F.coalesce("info.DB", F.lit(False)).alias("db"),
    )


def info_dictionary(spark, sf):
    headers = fixture(spark, sf, "headers_fx").withColumnRenamed("line_text", "text")
    return I.info_dictionary(headers)


def get_info_headers(spark, sf):
    headers = fixture(spark, sf, "headers_fx").select(
        F.col("sample_id").alias("vcfname"), "line", F.col("line_text").alias("text")
    )
    whole = I.get_info_headers(headers).select(F.lit("all").alias("source"), "headers")
    one = I.get_info_headers(headers, "S00003").select(F.lit("S00003").alias("source"), "headers")
    return whole.unionByName(one)


def headers_for(spark, sf):
    headers = fixture(spark, sf, "headers_fx").select(
        F.col("sample_id").alias("vcfname"), "line", F.col("line_text").alias("text")
    )
    return I.headers_for(headers, "S00003")



def _info_key(key: str, at: int | None = None) -> str:
    text = f"nullif(regexp_extract(info,'(^|;){key}=([^;]*)',2),'')"
    return text if at is None else f"nullif(split_part({text},',',{at}),'')"


_HOM = (
    f"case when contains(gt,'|') then {TOKEN1}={TOKEN2} "
    f"else ({TOKEN1}={TOKEN2} or {TOKEN2} is null) end"
)
_FIRST = "split_part(alt_string,',',1)"
_MATCHES = f"case when allele1={_FIRST} then 1 else 0 end + case when allele2={_FIRST} then 1 else 0 end"
_POSITION = "nullif(try_cast({} as int)-1,-1)"
_COUNT = "1+length(gt)-length(replace(replace(gt,'/',''),'|',''))"
_GENOKEY = (
    "cast(case chrom when 'X' then 23 when 'Y' then 24 else try_cast(chrom as int) end as bigint)"
    "*1000000000+pos"
)
_HIT = f"(allele1={_FIRST} or allele2={_FIRST})"

QUERIES = {
    "allele1": _genotype_columns(a=G.allele1),
    "allele2": _genotype_columns(a=G.allele2),
    "with_alleles": lambda spark, sf: flat(src.genotypes(spark, sf)),
    "allele_position": _genotype_columns(
        p1=lambda r, a, g: G.allele_position(g, 1), p2=lambda r, a, g: G.allele_position(g, 2)
    ),
    "is_homozygous": _genotype_columns(hom=lambda r, a, g: G.is_homozygous(g)),
    "allele_contained_in": allele_contained_in,
    "allele_matches": _genotype_columns(hit=lambda r, a, g: G.allele_matches(r, a, g, _target(a))),
    "allele_count": _genotype_columns(n=lambda r, a, g: G.allele_count(g)),
    "matching_allele_count": _genotype_columns(
        n=lambda r, a, g: G.matching_allele_count(_target(a), r, a, g)
    ),
    "at_location": at_location,
    "genokey": genokey,
    "rebase_gt": rebase_gt,
    "sql_functions": sql_functions,
    "norm_chrom": norm_chrom,
    "norm_missing": norm_missing,
    "gvcf_end": gvcf_end,
    "norm_info": norm_info,
    "split_lists": split_lists,
    "format_field": format_field,
    "gt_only": gt_only,
    "info_path": info_path,
    "parse_info": parse_info,
    "parse_info_flat": parse_info_flat,
    "info_dictionary": info_dictionary,
    "get_info_headers": get_info_headers,
    "headers_for": headers_for,
}

_LINE = "select sample_id, chrom, pos, {} from gvcf_lines_fx"

ORACLES = {
    "allele1": _genotype_check(a="allele1"),
    "allele2": _genotype_check(a="allele2"),
    "with_alleles": check(
        "select chrom, pos, replace(id,';',',') as id, ref, alt_string as alt, sample_id, gt, "
        "allele1, allele2 from geno"
    ),
    "allele_position": _genotype_check(
        p1=_POSITION.format(TOKEN1), p2=_POSITION.format(TOKEN2)
    ),
    "is_homozygous": _genotype_check(hom=_HOM),
    "allele_contained_in": check(
        f"select {', '.join('g.' + k for k in KEYS)}, (list_contains(string_split(c.alt_string,','),"
        "g.allele1) or list_contains(string_split(c.alt_string,','),g.allele2)) as hit "
        "from geno g join clinvar_fx c on g.chrom=c.chrom and g.pos=c.pos"
    ),
    "allele_matches": _genotype_check(hit=_HIT),
    "allele_count": _genotype_check(n=f"cast({_COUNT} as int)"),
    "matching_allele_count": _genotype_check(n=f"cast({_MATCHES} as int)"),
    "at_location": check(
        "select chrom, pos, end_pos, sample_id, cast(floor(pos/1000.0) as bigint)*1000+100 "
        "between pos and end_pos as covers from spans"
    ),
    "genokey": check(f"select chrom, pos, {_GENOKEY} as genokey from variants_fx"),
    "rebase_gt": check(
        f"select chrom, pos, sample_id, gt, alt_string, {_recode(TOKEN1)}||case when "
        f"contains(gt,'/') then '/'||{_recode(TOKEN2)} else '' end as new_gt from spans"
    ),
    "sql_functions": _genotype_check(
        a1="allele1", a2="allele2", p1=_POSITION.format(TOKEN1), hom=_HOM,
        n=f"cast({_COUNT} as int)", m=f"cast({_MATCHES} as int)", hit=_HIT, k=_GENOKEY,
        held=_HIT, here="3005 between pos and pos+9",
        new_gt=f"{_recode(TOKEN1)}||case when contains(gt,'|') then '|'||{_recode(TOKEN2)} "
        f"when contains(gt,'/') then '/'||{_recode(TOKEN2)} else '' end",
    ),
    "norm_chrom": check(
        "select chrom, 'chr'||chrom as raw, count(*) as n from gvcf_lines_fx group by chrom"
    ),
    "norm_missing": check(
        _LINE.format(
            "nullif(split_part(line_text,chr(9),3),'.') as id, "
            "nullif(split_part(line_text,chr(9),6),'.') as qual, 'none' as alts"
        )
    ),
    "gvcf_end": check("select sample_id, chrom, pos, end_pos from gvcf_fx"),
    "norm_info": check(
        "select chrom, pos, '.' as info from gvcf_fx union all "
        "select chrom, pos, null from gvcf_fx union all select chrom, pos, info from sites_fx"
    ),
    "split_lists": check(
        "select chrom, pos, cast(len(string_split(id,';')) as int) as n_ids, "
        "string_split(id,';')[2] as second_id, cast(len(string_split(alt_string,',')) as int) "
        "as n_alts, string_split(alt_string,',')[1] as first_alt from sites_fx"
    ),
    "format_field": check(
        "select chrom, pos, sample_id, dp, gq, min_dp, cast(null as varchar) as var_type from spans"
    ),
    "gt_only": check("select chrom, pos, sample_id, gt from spans"),
    "info_path": check(
        f"select chrom, pos, cast({_info_key('AF', 1)} as double) as af0, "
        f"cast({_info_key('AF', 2)} as double) as af1, cast({_info_key('AN')} as bigint) as an, "
        f"{_info_key('VT', 1)} as vt0 from sites_fx"
    ),
    "parse_info": check(
        f"select chrom, pos, ref, cast({_info_key('AC', 1)} as bigint) as ac0, "
        f"cast({_info_key('AC', 2)} as bigint) as ac1, cast({_info_key('AF', 1)} as double) as af0, "
        f"cast({_info_key('AF', 2)} as double) as af1, cast({_info_key('AN')} as bigint) as an, "
        f"contains(info,';DB;') as db, replace({_info_key('VT')},',','+') as vt, "
        f"try_cast({_info_key('DP')} as bigint) as dp from sites_fx"
    ),
    "parse_info_flat": check(
        f"select chrom, pos, ref, cast({_info_key('AC', 1)} as bigint) as ac, "
        f"cast({_info_key('AF', 1)} as double) as af, cast({_info_key('AN')} as bigint) as an, "
        "contains(info,';DB;') as db from sites_fx"
    ),
    "info_dictionary": check(
        "select distinct regexp_extract(line_text,'ID=([^,>]*)',1) as id, "
        "regexp_extract(line_text,'Number=([^,>]*)',1) as number, "
        "regexp_extract(line_text,'Type=([^,>]*)',1) as type, "
        "replace(regexp_extract(line_text,'Description=([^,>]*)',1),'\"','') as description "
        "from headers_fx where line_text like '##INFO%'"
    ),
    "get_info_headers": check(
        "select 'all' as source, string_agg(line_text, chr(10) order by line_text) as headers from "
        "(select distinct line_text from headers_fx where line_text like '##INFO%') d union all "
        "select 'S00003', string_agg(line_text, chr(10) order by line) from headers_fx "
        "where line_text like '##INFO%' and sample_id='S00003'"
    ),
    "headers_for": check(
        "select sample_id as vcfname, line, line_text as text from headers_fx "
        "where sample_id='S00003' order by line"
    ),
}
