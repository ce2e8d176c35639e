"""Row filters and elementary joins over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe.fixtures import fixture
from helixframe.functions.genotype import gt_numbers
from helixframe.operators import intervals as R
from helixframe.operators import joins as J
from helixframe.operators import predicates as P
from helixframe.operators.reshape import flatten_alts
from helixframe.plans import cohort as C
from helixframe.plans import population as Q
from helixframe.plans import quality as U
from helixframe.registry import inputs as src
from helixframe.registry.inputs import TOKEN1, TOKEN2, CONDITION, GENE, check, flat
from helixframe.sources.dims import contig_alias_dim, contig_aliases

# A range that holds some positions of every scale factor and leaves others out.
FROM, TO = 3000, 6000


def _calls(df):
    return flat(df.select("chrom", "pos", "ref", "alt", "sample_id", "gt"))


_CALLS = "select chrom, pos, ref, alt_string as alt, sample_id, gt from geno"


def locus_range(spark, sf):
    return _calls(P.locus_range(src.genotypes(spark, sf), "10", FROM, TO))


def locus_below(spark, sf):
    """Positions below a bound only, as used for a base table of a range workflow."""
    rows = P.locus_range(src.spans(spark, sf), "1", end=TO)
    return rows.select("chrom", "pos", "end_pos", "sample_id", "gt")


def non_ref(spark, sf):
    return P.non_ref(src.spans(spark, sf)).select("chrom", "pos", "sample_id", "gt")


def non_ref_block(spark, sf):
    return P.non_ref_block(src.spans(spark, sf)).select("chrom", "pos", "sample_id", "alt_string")


def pass_only(spark, sf):
    return P.pass_only(src.spans(spark, sf)).select("chrom", "pos", "sample_id", "filter")


def single_base(spark, sf):
    return P.single_base(src.spans(spark, sf)).select("chrom", "pos", "end_pos", "sample_id")


def freq_filter(spark, sf):
    rare = P.freq_filter(src.alleles(spark, sf), below=0.001)
    common = P.freq_filter(src.alleles(spark, sf), above=0.6)
    return rare.unionByName(common).select("chrom", "pos", "alt_allele", "af")


def panel_filter(spark, sf):
    return P.panel_filter(src.panel(spark, sf), pop="NATION_15", gender="female")


def normalize_contigs(build):
    def run(spark, sf):
        return J.normalize_contigs(fixture(spark, sf, "accession_fx"), contig_alias_dim(spark, build))

    return run


def _normalize_check(build):
    values = ", ".join(f"('{a}','{c}')" for a, c in contig_aliases(build).items())
    return check(
        "select coalesce(a.chrom, s.chrom) as chrom, s.chrom as orig_chrom, pos, id, ref, alt_string "
        f"from accession_fx s left join (values {values}) a(accession, chrom) on s.chrom=a.accession"
    )


def join_clinvar(spark, sf):
    joined = J.join_clinvar(src.genotypes(spark, sf), src.clinvar(spark, sf))
    return flat(joined.select("chrom", "pos", "ref", "alt", "sample_id", "gt", "c_id", "c_alt"))


def join_clinvar_allele(spark, sf):
    joined = J.join_clinvar_allele(src.genotypes(spark, sf), src.clinvar(spark, sf))
    return flat(joined.select("chrom", "pos", "ref", "alt", "sample_id", "gt", "c_id", "c_alt"))


def join_variant_genotype(spark, sf):
    joined = J.join_variant_genotype(src.alleles(spark, sf), src.genotypes(spark, sf))
    return joined.select("chrom", "pos", "ref", "alt_allele", "af", "sample_id", "gt")


def annotate_snp(spark, sf):
    joined = J.annotate_snp(src.alleles(spark, sf), src.snp(spark, sf))
    return flat(joined.select("chrom", "pos", "ref", "alt_allele", "snp_id", "snp_alt", "snp_geneinfo"))


def alt_overlap_join(spark, sf):
    joined = J.alt_overlap_join(src.variants(spark, sf).drop("info"), src.snp(spark, sf))
    return flat(joined.select("chrom", "pos", "ref", "alt", "r_id", "r_alt"))


def interval_join(spark, sf):
    joined = R.interval_join(src.variants(spark, sf).drop("info"), src.intervals(spark, sf))
    return joined.select("chrom", "pos", "ref", "gene", "region_start", "region_end")


def interval_join_shuffled(spark, sf):
    """The same without a broadcast, hot bins split: the path of large interval sets."""
    joined = R.interval_join(
        src.variants(spark, sf).drop("info"), src.intervals(spark, sf), max_rows=0, hot_rows=50
    )
    return joined.select("chrom", "pos", "ref", "gene", "region_start", "region_end")


def span_join(spark, sf):
    """Every variant row with the spans of other rows that contain it."""
    sites = src.variants(spark, sf).select("chrom", "pos", F.col("pos").alias("end_pos"), "ref")
    pairs = R.span_in_span_join(sites, src.spans(spark, sf).select("chrom", "pos", "end_pos", "sample_id"))
    return pairs.select(
        F.col("p_chrom").alias("chrom"), F.col("p_pos").alias("pos"), F.col("p_ref").alias("ref"),
        F.col("s_pos").alias("gpos"), F.col("s_end_pos").alias("gend"),
        F.col("s_sample_id").alias("sample_id"),
    )


def span_join_shuffled(spark, sf):
    sites = src.variants(spark, sf).select("chrom", "pos", F.col("pos").alias("end_pos"), "ref")
    spans = src.spans(spark, sf).select("chrom", "pos", "end_pos", "sample_id")
    pairs = R.span_in_span_join(sites, spans, max_rows=0, hot_rows=10)
    return pairs.select(
        F.col("p_chrom").alias("chrom"), F.col("p_pos").alias("pos"), F.col("p_ref").alias("ref"),
        F.col("s_pos").alias("gpos"), F.col("s_end_pos").alias("gend"),
        F.col("s_sample_id").alias("sample_id"),
    )


def bed_positions(spark, sf):
    return R.bed_positions(src.bed(spark, sf))


def bed_position_join(spark, sf):
    spans = src.spans(spark, sf).select("chrom", "pos", "end_pos", "sample_id", "gt")
    pairs = R.point_in_span_join(R.bed_positions(src.bed(spark, sf)), spans)
    return pairs.select(
        F.col("p_chrom").alias("chrom"), F.col("p_pos").alias("pos"),
        F.col("s_sample_id").alias("sample_id"), F.col("s_gt").alias("gt"),
    )


def locus_span_join(spark, sf):
    """Variant loci in spans over all contigs: the encoded-key range join's result."""
    loci = src.variants(spark, sf).select("chrom", "pos", "ref")
    spans = src.spans(spark, sf).select("chrom", "pos", "end_pos", "sample_id", "gt")
    pairs = R.point_in_span_join(loci, spans)
    return pairs.select(
        F.col("p_chrom").alias("chrom"), F.col("p_pos").alias("pos"), F.col("p_ref").alias("ref"),
        F.col("s_pos").alias("gpos"), F.col("s_sample_id").alias("sample_id"), F.col("s_gt").alias("gt"),
    )


def flatten(spark, sf):
    rows = flatten_alts(src.variants(spark, sf))
    return rows.select("chrom", "pos", "ref", "alt_allele_id", "alt_allele")


def nested_exists(spark, sf):
    rows = src.genotypes(spark, sf).withColumn("genotype", gt_numbers(F.col("gt")))
    return J.nested_exists(rows).select("chrom", "pos", "ref", "sample_id", "gt")


def allele_totals(spark, sf):
    group = ["chrom", "pos", "ref", "alt", "alt_allele", "af"]
    return flat(
        J.allele_totals(src.alleles(spark, sf), src.genotypes(spark, sf), group, lookup_small=False)
    )


def by_rsid(spark, sf):
    rows = P.by_rsid(src.variants(spark, sf).drop("info"), src.rsid_list(spark, sf))
    return flat(rows.select("chrom", "pos", "id", "ref", "alt"))


def has_condition(spark, sf):
    return flat(P.has_condition(src.clinvar(spark, sf), CONDITION))


def gene_prefix(spark, sf):
    return flat(P.gene_prefix(src.snp(spark, sf), GENE))


def gene_intervals(spark, sf):
    """Regions from two sources, overlapping, as one set."""
    regions = src.intervals(spark, sf).select("gene", "chrom", "region_start", "region_end")
    genes = src.snp(spark, sf).groupBy(F.split_part("geneinfo", F.lit(":"), F.lit(1)).alias("gene"), "chrom").agg(
        F.min("pos").alias("region_start"), F.max("pos").alias("region_end")
    )
    return Q.gene_intervals([regions, genes, regions])


_BIALLELIC = "ref in ('A','C','G','T') and alt_string in ('A','C','G','T')"
_IN_SPAN = "g.chrom=v.chrom and g.pos<=v.pos and g.end_pos>=v.pos"
_INTERVALS = check(
    "select v.chrom, v.pos, v.ref, i.gene, i.region_start, i.region_end from variants_fx v join "
    "intervals_fx i on v.chrom=i.chrom and v.pos between i.region_start and i.region_end"
)
_SPAN_JOIN = check(
    "select v.chrom, v.pos, v.ref, g.pos as gpos, g.end_pos as gend, g.sample_id "
    f"from variants_fx v join gvcf_fx g on {_IN_SPAN}"
)
_CLINVAR = (
    "select g.chrom, g.pos, g.ref, g.alt_string as alt, g.sample_id, g.gt, c.id as c_id, "
    "c.alt_string as c_alt from geno g join clinvar_fx c on g.chrom=c.chrom and g.pos=c.pos "
    "and g.ref=c.ref"
)

QUERIES = {
    "locus_range": locus_range,
    "locus_below": locus_below,
    "non_ref": non_ref,
    "non_ref_block": non_ref_block,
    "pass_only": pass_only,
    "single_base": single_base,
    "biallelic_snps": lambda s, sf: _calls(P.biallelic_snps(src.genotypes(s, sf))),
    "is_called": lambda s, sf: _calls(P.is_called(src.genotypes(s, sf))),
    "carries_alt": lambda s, sf: _calls(P.carries_alt(src.genotypes(s, sf))),
    "freq_filter": freq_filter,
    "panel_filter": panel_filter,
    "has_condition": has_condition,
    "gene_prefix": gene_prefix,
    "by_rsid": by_rsid,
    "autosomes": lambda s, sf: _calls(P.autosomes(src.genotypes(s, sf))),
    "join_panel": lambda s, sf: J.join_panel(
        src.genotypes(s, sf).select("chrom", "pos", "sample_id", "gt"), src.panel(s, sf)
    ),
    "join_clinvar": join_clinvar,
    "join_clinvar_allele": join_clinvar_allele,
    "join_variant_genotype": join_variant_genotype,
    "normalize_contigs": normalize_contigs("GRCh38"),
    "normalize_contigs_grch37": normalize_contigs("GRCh37"),
    "annotate_snp": annotate_snp,
    "interval_join": interval_join,
    "interval_join_shuffled": interval_join_shuffled,
    "span_join": span_join,
    "span_join_shuffled": span_join_shuffled,
    "bed_positions": bed_positions,
    "bed_position_join": bed_position_join,
    "locus_span_join": locus_span_join,
    "alt_overlap_join": alt_overlap_join,
    "flatten_alts": flatten,
    "nested_exists": nested_exists,
    "genotype_distribution": lambda s, sf: flat(Q.genotype_distribution(src.genotypes(s, sf))),
    "allele_totals": allele_totals,
    "homozygote_counts": lambda s, sf: U.homozygote_counts(src.genotypes(s, sf)).select(
        "chrom", "pos", "ref", F.array_join("alt", ",").alias("alt"),
        F.array_join(
            F.transform("homozygotes", lambda h: F.concat(h["allele"], F.lit(":"), h["n"].cast("string"))), ","
        ).alias("homozygotes"),
    ),
    "samples_by_genotype": lambda s, sf: C.samples_by_genotype(src.genotypes(s, sf)),
    "gene_intervals": gene_intervals,
}

ORACLES = {
    "locus_range": check(_CALLS + f" where chrom='10' and pos between {FROM} and {TO}"),
    "locus_below": check(
        f"select chrom, pos, end_pos, sample_id, gt from spans where chrom='1' and pos<={TO}"
    ),
    "non_ref": check(
        "select chrom, pos, sample_id, gt from spans where gt not in ('0/0','./.','0','.')"
    ),
    "non_ref_block": check(
        "select chrom, pos, sample_id, alt_string from gvcf_fx where alt_string<>'<NON_REF>'"
    ),
    "pass_only": check("select chrom, pos, sample_id, filter from gvcf_fx where filter='PASS'"),
    "single_base": check("select chrom, pos, end_pos, sample_id from gvcf_fx where pos=end_pos"),
    "biallelic_snps": check(f"{_CALLS} where {_BIALLELIC}"),
    "is_called": check(f"{_CALLS} where not contains(gt,'.')"),
    "carries_alt": check(
        f"{_CALLS} where split_part(gt,'|',1)<>'0' or "
        "(contains(gt,'|') and split_part(gt,'|',2)<>'0')"
    ),
    "freq_filter": check("select chrom, pos, alt_allele, af from flat where af<0.001 or af>0.6"),
    "panel_filter": check("select * from panel_fx where pop='NATION_15' and gender='female'"),
    "has_condition": check(
        "select chrom, pos, id, ref, clndn, alt_string as alt from clinvar_fx "
        f"where list_contains(string_split(clndn,','),'{CONDITION}')"
    ),
    "gene_prefix": check(
        "select chrom, pos, id, ref, geneinfo, alt_string as alt from snp_fx "
        f"where geneinfo like '{GENE}%'"
    ),
    "by_rsid": check(
        "select chrom, pos, replace(id,';',',') as id, ref, alt_string as alt from variants_fx "
        "where split_part(id,';',1) in (select 'rs'||id from clinvar_fx)"
    ),
    "autosomes": check(f"{_CALLS} where chrom not in ('X','Y','MT')"),
    "join_panel": check(
        "select sample_id, chrom, pos, gt, pop, super_pop, gender from genotypes_fx "
        "join panel_fx using (sample_id)"
    ),
    "join_clinvar": check(_CLINVAR),
    "join_clinvar_allele": check(
        _CLINVAR + " and (list_contains(string_split(c.alt_string,','),g.allele1) "
        "or list_contains(string_split(c.alt_string,','),g.allele2))"
    ),
    "join_variant_genotype": check(
        "select v.chrom, v.pos, v.ref, v.alt_allele, v.af, g.sample_id, g.gt from flat v "
        "join geno g on g.chrom=v.chrom and g.pos=v.pos and g.ref=v.ref "
        "and g.alt_string=v.alt_string and v.alt_allele in (g.allele1, g.allele2)"
    ),
    "normalize_contigs": _normalize_check("GRCh38"),
    "normalize_contigs_grch37": _normalize_check("GRCh37"),
    "annotate_snp": check(
        "select v.chrom, v.pos, v.ref, v.alt_allele, s.id as snp_id, s.alt_string as snp_alt, "
        "s.geneinfo as snp_geneinfo from flat v left join snp_fx s on v.chrom=s.chrom "
        "and v.pos=s.pos and v.ref=s.ref and list_contains(string_split(s.alt_string,','),v.alt_allele)"
    ),
    "interval_join": _INTERVALS,
    "interval_join_shuffled": _INTERVALS,
    "span_join": _SPAN_JOIN,
    "span_join_shuffled": _SPAN_JOIN,
    "bed_positions": check(
        "select chrom, cast(unnest(range(start_pos, end_plus1)) as int) as pos from bed_fx"
    ),
    "bed_position_join": check(
        "select b.chrom, b.pos, g.sample_id, g.gt from (select chrom, "
        "cast(unnest(range(start_pos, end_plus1)) as int) as pos from bed_fx) b join spans g "
        "on g.chrom=b.chrom and g.pos<=b.pos and g.end_pos>=b.pos"
    ),
    "locus_span_join": check(
        "select v.chrom, v.pos, v.ref, g.pos as gpos, g.sample_id, g.gt from variants_fx v "
        f"join spans g on {_IN_SPAN}"
    ),
    "alt_overlap_join": check(
        "select v.chrom, v.pos, v.ref, v.alt_string as alt, s.id as r_id, s.alt_string as r_alt "
        "from variants_fx v join snp_fx s on v.chrom=s.chrom and v.pos=s.pos and v.ref=s.ref and "
        "list_has_any(string_split(v.alt_string,','),string_split(s.alt_string,','))"
    ),
    "flatten_alts": check("select chrom, pos, ref, alt_allele_id, alt_allele from flat"),
    "nested_exists": check(
        "select chrom, pos, ref, sample_id, gt from genotypes_fx where not contains(gt,'.') and "
        f"({TOKEN1}<>'0' or coalesce({TOKEN2},'0')<>'0')"
    ),
    "genotype_distribution": check(
        "select chrom, pos, ref, alt_string as alt, gt, count(sample_id) as samples "
        "from genotypes_fx group by all"
    ),
    "allele_totals": check(
        "select v.chrom, v.pos, v.ref, v.alt_string as alt, v.alt_allele, v.af, "
        "cast(sum(case when v.alt_allele=g.allele1 then 1 else 0 end + "
        "case when v.alt_allele=g.allele2 then 1 else 0 end) as bigint) as num_variant_alleles, "
        "cast(sum(case when regexp_matches(g.gt,'[/|]') then 2 else 1 end) as bigint) "
        "as total_num_alleles from flat v join geno g on g.chrom=v.chrom and g.pos=v.pos "
        "and g.ref=v.ref and g.alt_string=v.alt_string group by all"
    ),
    "homozygote_counts": check(
        "select chrom, pos, ref, alt_string as alt, string_agg(allele1||':'||n, ',' order by gt) "
        "as homozygotes from (select chrom, pos, ref, alt_string, gt, allele1, count(*) as n "
        "from geno where allele1=allele2 group by all) h group by all"
    ),
    "samples_by_genotype": check(
        "select chrom, pos, ref, gt, count(*) as cnt, string_agg(sample_id, ',' order by sample_id) "
        "as samples from genotypes_fx group by all"
    ),
    "gene_intervals": check(
        "select gene, chrom, region_start, region_end from intervals_fx union "
        "select split_part(geneinfo,':',1), chrom, min(pos), max(pos) from snp_fx group by 1, 2"
    ),
}
