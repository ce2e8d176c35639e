"""Cohort analyses over gVCF spans."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe.operators.reshape import pivot_text, sample_line
from helixframe.plans import cohort as C
from helixframe.registry import inputs as src
from helixframe.registry.inputs import TOKEN1, TOKEN2, allele_sql, check, flat
from helixframe.session import new_scratch_path

# A range that holds some positions of every scale factor and leaves others out.
FROM, TO = 3000, 6000


def _spans(plan, *args):
    return lambda spark, sf: flat(plan(src.spans(spark, sf), *args))


def genotypes_at_position(spark, sf):
    rows = C.genotypes_at_position(src.spans(spark, sf), "2", 1925)
    return flat(rows.select("chrom", "pos", "end_pos", "ref", "alt", "sample_id", "gt", "dp"))


def multisample_vcf(spark, sf):
    return C.multisample_vcf(src.spans(spark, sf), src.panel(spark, sf))


def multisample_header(spark, sf):
    return sample_line(src.panel(spark, sf))


def pivot_samples(spark, sf):
    """Depth per site, all panel samples in one text."""
    return pivot_text(src.spans(spark, sf), ["chrom", "pos", "ref"], src.panel(spark, sf), F.col("dp"))


def cohort_loci(spark, sf):
    return flat(C.cohort_loci(C.cohort_variants(src.spans(spark, sf)))).drop("alt")


def cohort_loci_with_id(spark, sf):
    """Loci kept apart by identifier, with summed counts (the range workflow)."""
    spans = src.spans(spark, sf).withColumn("id", F.concat(F.lit("v"), F.col("pos").cast("string")))
    variants = C.cohort_variants(spans, with_id=True)
    return flat(C.cohort_loci(variants)).drop("alt")


def cohort_calls(spark, sf):
    spans = src.spans(spark, sf)
    _, loci = C.cohort_tables(spans)
    return C.cohort_calls(spans, loci)


def compute_variant_counts(spark, sf):
    spans = src.spans(spark, sf)
    _, loci = C.cohort_tables(spans)
    return C.compute_variant_counts(spans, loci)


def cohort_calls_shuffled(spark, sf):
    """The same beyond the broadcast bound, with hot bins split."""
    spans = src.spans(spark, sf)
    _, loci = C.cohort_tables(spans)
    return C.cohort_calls(spans, loci, max_rows=0, hot_rows=200)


def compute_variant_counts_shuffled(spark, sf):
    spans = src.spans(spark, sf)
    _, loci = C.cohort_tables(spans)
    return C.compute_variant_counts(spans, loci, max_rows=0, hot_rows=200)


def store_variant_counts(spark, sf):
    spans = src.spans(spark, sf)
    _, loci = C.cohort_tables(spans)
    return C.store_variant_counts(spans, loci, new_scratch_path(spark, "variant_counts"))


def range_cohort_calls(spark, sf):
    spans = src.spans(spark, sf).withColumn("id", F.concat(F.lit("v"), F.col("pos").cast("string")))
    return C.range_cohort_calls(spans, "range_base", "11", FROM, TO)


def bed_cohort_frequencies(spark, sf):
    return C.bed_cohort_frequencies(src.spans(spark, sf), src.bed(spark, sf))


def pgx_join(spark, sf):
    return C.pgx_calls(src.spans(spark, sf), src.pgx_loci(spark, sf))


def pgx_haplotypes(spark, sf):
    return C.pgx_haplotypes(src.spans(spark, sf), src.pgx_loci(spark, sf))


def alt_refs(spark, sf):
    """Rows of some depths carry an unknown REF, the anomaly this report is after."""
    ref = F.when(F.col("dp") % 25 == 0, F.lit("N")).otherwise(F.col("ref"))
    return C.alt_refs(src.spans(spark, sf).withColumn("ref", ref))


def vcf_record(spark, sf):
    return C.vcf_records(src.spans(spark, sf))


QUERIES = {
    "genotypes_at_position": genotypes_at_position,
    "nonref_sites": _spans(C.nonref_sites),
    "nonref_sites_in_range": _spans(C.nonref_sites, "11", FROM, TO),
    "genotypes_at_nonref_sites": _spans(C.genotypes_at_nonref_sites),
    "genotypes_at_nonref_sites_in_range": _spans(C.genotypes_at_nonref_sites, "11", FROM, TO),
    "genotype_counts_at_sites": _spans(C.genotype_counts_at_sites),
    "alts_per_position": _spans(C.alts_per_position),
    "alt_union": _spans(C.alt_union),
    "vcf_record": vcf_record,
    "multisample_vcf": multisample_vcf,
    "multisample_header": multisample_header,
    "pivot_samples": pivot_samples,
    "cohort_variants": _spans(C.cohort_variants),
    "cohort_loci": cohort_loci,
    "cohort_loci_with_id": cohort_loci_with_id,
    "cohort_calls": cohort_calls,
    "cohort_calls_shuffled": cohort_calls_shuffled,
    "range_cohort_calls": range_cohort_calls,
    "compute_variant_counts": compute_variant_counts,
    "compute_variant_counts_shuffled": compute_variant_counts_shuffled,
    "store_variant_counts": store_variant_counts,
    "alt_variations": _spans(C.alt_variations),
    "alt_refs": alt_refs,
    "variant_calls": _spans(C.variant_calls),
    "depth_histogram": _spans(C.depth_histogram),
    "filter_distribution": _spans(C.filter_distribution),
    "bed_cohort_frequencies": bed_cohort_frequencies,
    "pgx_join": pgx_join,
    "pgx_haplotypes": pgx_haplotypes,
}

_NONREF = (
    "select *, alt_string as alts from spans where filter='PASS' "
    "and gt not in ('0/0','./.','0','.')"
)
_SITES = (
    "select chrom, pos, end_pos, min(ref) as ref, count(sample_id) as samples from nonref_rows "
    "group by chrom, pos, end_pos"
)
_AT_SITES = (
    "select g.sample_id, n.chrom, n.pos, n.ref, g.filter, g.pos as gpos, g.end_pos as gend, g.gt, "
    f"{allele_sql(1, 'n.ref', 'g.alt_string')} as allele1, "
    f"{allele_sql(2, 'n.ref', 'g.alt_string')} as allele2, g.dp, g.gq, g.min_dp "
    "from sites n join spans g on g.chrom=n.chrom and n.pos>=g.pos and n.end_pos<=g.end_pos"
)
_ALTS = (
    "select chrom, pos, end_pos, ref, unnest(string_split(alts,',')) as allele from nonref_rows"
)
_UNION = (
    "select chrom, pos, end_pos, ref, string_agg(distinct allele, ',' order by allele) as alt "
    "from alts group by chrom, pos, end_pos, ref"
)


def _rebased(old: str, new: str) -> str:
    def one(token: str) -> str:
        return (
            f"case when {token}='0' then '0' else coalesce(cast(nullif(list_position("
            f"string_split({new},','), string_split({old},',')[try_cast({token} as int)]),0) "
            "as varchar),'.') end"
        )

    return f"{one(TOKEN1)}||case when contains(gt,'/') then '/'||{one(TOKEN2)} else '' end"


_RECORDS = (
    "select n.chrom, n.pos, cast(null as varchar) as id, n.ref, n.alt, '.' as qual, '.' as filter, "
    "'.' as info, 'GT:DP:GQ:MIN_DP:FT' as format, g.sample_id, "
    f"{_rebased('g.alt_string', 'n.alt')}||':'||coalesce(cast(g.dp as varchar),'.')||':'||"
    "coalesce(cast(g.gq as varchar),'.')||':'||coalesce(cast(g.min_dp as varchar),'.')||':'||"
    "coalesce(g.filter,'.') as value from unions n join spans g on g.chrom=n.chrom and "
    "n.pos>=g.pos and n.end_pos<=g.end_pos"
)


def _pivoted(keys: str, rows: str, value: str) -> str:
    """Every panel sample's greatest value per site, as tab-joined text in name order."""
    same = " and ".join(f"s.{k} is not distinct from v.{k}" for k in keys.split(", "))
    return (
        f"with found as (select {keys}, sample_id, cast(max({value}) as varchar) as value from {rows} group by all), "
        f"sites as (select distinct {keys} from {rows}) "
        f"select {', '.join('s.' + k for k in keys.split(', '))}, "
        "string_agg(coalesce(v.value, '.'), chr(9) order by p.sample_id) as values "
        f"from sites s cross join panel_fx p left join found v on v.sample_id=p.sample_id and {same} group by all"
    )


_SITE_CTES = {"nonref_rows": _NONREF, "sites": _SITES}
_ALT_CTES = {"nonref_rows": _NONREF, "alts": _ALTS, "unions": _UNION}

_LOCI = (
    "select chrom, pos, ref, string_agg(distinct allele, ',' order by allele) as alt_string from "
    "(select chrom, pos, ref, unnest(string_split(alt_string,',')) as allele from gvcf_fx "
    "where alt_string<>'<NON_REF>') e group by chrom, pos, ref"
)
_CALLS = (
    f"select b.chrom, b.pos, b.ref, b.alt_string, {_rebased('g.alt_string', 'b.alt_string')} as gt, "
    "g.sample_id from spans g join loci b on g.chrom=b.chrom and g.pos<=b.pos and g.end_pos>=b.pos"
)
_PGX_LOCI = "select chrom, pos, ref from variants_fx where chrom='10' and length(alt_string)=1"
_PGX = (
    f"select g.sample_id, a.chrom, a.pos, a.ref, {allele_sql(1, 'a.ref', 'g.alt_string')} as allele1, "
    f"{allele_sql(2, 'a.ref', 'g.alt_string')} as allele2 from spans g join pgx_loci a "
    "on g.chrom=a.chrom and a.pos>=g.pos and a.pos<=g.end_pos"
)
_ONE_RANGE = {
    "nonref_rows": _NONREF + f" and chrom='11' and pos between {FROM} and {TO}",
    "sites": _SITES,
}

_COUNTS = "select chrom, pos, ref, alt_string, gt, count(*) as cnt from calls group by all"
_LISTS = (
    "select chrom, pos, ref, alt_string, gt, count(*) as cnt, "
    "string_agg(sample_id, ',' order by sample_id) as samples from calls group by all"
)

ORACLES = {
    "genotypes_at_position": check(
        "select chrom, pos, end_pos, ref, alt_string as alt, sample_id, gt, dp from spans "
        "where chrom='2' and 1925 between pos and end_pos"
    ),
    "nonref_sites": check("select * from sites", **_SITE_CTES),
    "nonref_sites_in_range": check("select * from sites", **_ONE_RANGE),
    "genotypes_at_nonref_sites": check(_AT_SITES, **_SITE_CTES),
    "genotypes_at_nonref_sites_in_range": check(_AT_SITES, **_ONE_RANGE),
    "genotype_counts_at_sites": check(
        f"select chrom, pos, ref, allele1, allele2, gt, count(*) as cnt from ({_AT_SITES}) x "
        "group by all",
        **_SITE_CTES,
    ),
    "alts_per_position": check("select * from alts", nonref_rows=_NONREF, alts=_ALTS),
    "alt_union": check("select * from unions", **_ALT_CTES),
    "vcf_record": check(_RECORDS, **_ALT_CTES),
    "multisample_vcf": check(
        f"select * from ({_pivoted('chrom, pos, id, ref, alt, qual, filter, info, format', 'records', 'value')}) x",
        **_ALT_CTES,
        records=_RECORDS,
    ),
    "multisample_header": check(
        "select string_agg(sample_id, chr(9) order by sample_id) as samples from (select distinct sample_id from panel_fx) p"
    ),
    "pivot_samples": check(
        f"select * from ({_pivoted('chrom, pos, ref', 'spans', 'dp')}) x"
    ),
    "cohort_variants": check(
        "select chrom, pos, ref, alt_string as alt, gt, count(*) as cnt from spans "
        "where alt_string<>'<NON_REF>' group by all"
    ),
    "cohort_loci": check("select * from loci", loci=_LOCI),
    "cohort_loci_with_id": check(
        "select chrom, pos, 'v'||pos as id, ref, string_agg(distinct allele, ',' order by allele) "
        "as alt_string, count(*) as cnt from (select chrom, pos, ref, "
        "unnest(string_split(alt_string,',')) as allele from gvcf_fx "
        "where alt_string<>'<NON_REF>') e group by chrom, pos, ref"
    ),
    "cohort_calls": check(_LISTS, loci=_LOCI, calls=_CALLS),
    "cohort_calls_shuffled": check(_LISTS, loci=_LOCI, calls=_CALLS),
    "range_cohort_calls": check(
        _LISTS,
        base=f"select * from spans where chrom='11' and pos between {FROM} and {TO}",
        loci=_LOCI.replace("from gvcf_fx", "from base"),
        calls=_CALLS.replace("from spans g", "from base g"),
    ),
    "compute_variant_counts": check(_COUNTS, loci=_LOCI, calls=_CALLS),
    "compute_variant_counts_shuffled": check(_COUNTS, loci=_LOCI, calls=_CALLS),
    "store_variant_counts": check(_COUNTS, loci=_LOCI, calls=_CALLS),
    "alt_variations": check(
        "select chrom, pos, ref, count(distinct alt_string) as varcnt from nonref_rows "
        "where pos=end_pos group by chrom, pos, ref having count(distinct alt_string)>1",
        nonref_rows=_NONREF,
    ),
    "alt_refs": check(
        "select chrom, pos, count(distinct r) as refcnt from (select *, case when dp%25=0 then 'N' "
        "else ref end as r from spans) s where pos=end_pos and filter='PASS' "
        "group by chrom, pos having count(distinct r)>1"
    ),
    "variant_calls": check(
        "select chrom, pos, ref, alt_string, gt, count(*) as c from spans "
        "where alt_string<>'<NON_REF>' group by all"
    ),
    "depth_histogram": check(
        "select cast(round(dp/5.0) as int)*5 as depth, count(*) as c from spans "
        "where alt_string<>'<NON_REF>' and filter='PASS' group by 1"
    ),
    "filter_distribution": check(
        "select filter, count(*) as count from gvcf_fx group by filter"
    ),
    "bed_cohort_frequencies": check(
        "select b.chrom, b.pos, g.alt_string, g.gt, count(*) as c from (select chrom, "
        "cast(unnest(range(start_pos, end_plus1)) as int) as pos from bed_fx) b join spans g "
        "on g.chrom=b.chrom and g.pos<=b.pos and g.end_pos>=b.pos group by all"
    ),
    "pgx_join": check("select * from pgx", pgx_loci=_PGX_LOCI, pgx=_PGX),
    "pgx_haplotypes": check(
        "select multi_genotype, altcount, count(*) as cnt from (select sample_id, string_agg("
        "coalesce(allele1,'.')||'-'||coalesce(allele2,'.'), ' , ' order by pos) as multi_genotype, "
        "count(*) filter (coalesce(allele1<>ref,false) or coalesce(allele2<>ref,false)) as altcount "
        "from pgx group by sample_id) s group by all",
        pgx_loci=_PGX_LOCI,
        pgx=_PGX,
    ),
}
