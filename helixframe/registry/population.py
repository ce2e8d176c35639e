"""Population genotype analyses."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe.operators.reshape import flatten_alts
from helixframe.plans import population as Q
from helixframe.registry import inputs as src
from helixframe.registry.inputs import CONDITION, GENE, TOKEN1, TOKEN2, check, flat

RARE, INFREQUENT, COMMON = 0.001, 0.01, 0.6
# A range that holds some positions of every scale factor and leaves others out.
FROM, TO = 3000, 6000
POP, GENDER = "NATION_15", "female"
SAMPLE = "S00003"
WINDOW = (20_000, 28_000)
TOP = 100


def _rare(plan, *bounds):
    def run(spark, sf):
        return flat(plan(src.alleles(spark, sf), src.genotypes(spark, sf), RARE, *bounds))

    return run


def alleles_by_population(spark, sf):
    return flat(
        Q.alleles_by_population(
            src.genotypes(spark, sf), src.panel(spark, sf), "10", FROM, TO, POP, GENDER
        )
    )


def common_alleles_inline(spark, sf):
    """Frequency looked up by ALT index while flattening, instead of through the view."""
    rows = flatten_alts(src.variants(spark, sf).where(F.col("chrom") == "2"))
    freq = F.get("info.AF", F.col("alt_allele_id"))
    return flat(Q.common_alleles(rows.withColumn("af", freq), "2", COMMON, TOP))


def common_alleles_view(spark, sf):
    src.alleles(spark, sf).createOrReplaceTempView("variants_flattened")
    return flat(Q.common_alleles(spark.table("variants_flattened"), "2", COMMON, TOP))


def rare_homozygous_sites(spark, sf):
    return flat(
        Q.rare_homozygous_sites(src.alleles(spark, sf), src.genotypes(spark, sf), SAMPLE, INFREQUENT)
    )


def interval_allele_frequency(spark, sf):
    return flat(
        Q.interval_allele_frequency(
            src.alleles(spark, sf),
            src.genotypes(spark, sf),
            src.intervals(spark, sf),
            src.snp(spark, sf),
            INFREQUENT,
        )
    )


def gene_rare_variants(spark, sf):
    return flat(
        Q.gene_rare_variants(
            src.alleles(spark, sf), src.genotypes(spark, sf), src.snp(spark, sf), GENE, INFREQUENT
        )
    )


def rsid_variants(spark, sf):
    return flat(
        Q.rsid_variants(
            src.alleles(spark, sf),
            src.genotypes(spark, sf),
            src.snp(spark, sf),
            GENE,
            INFREQUENT,
            src.rsid_list(spark, sf),
        )
    )


QUERIES = {
    "alleles_by_population": alleles_by_population,
    "condition_genotypes": lambda s, sf: flat(
        Q.condition_genotypes(src.genotypes(s, sf), src.clinvar(s, sf), CONDITION)
    ),
    "condition_carriers": lambda s, sf: flat(
        Q.condition_carriers(src.genotypes(s, sf), src.clinvar(s, sf), CONDITION)
    ),
    "common_alleles": common_alleles_inline,
    "common_alleles_view": common_alleles_view,
    "top_alleles": lambda s, sf: flat(Q.common_alleles(src.alleles(s, sf), "9", COMMON, TOP)),
    "rare_carriers": _rare(Q.rare_carriers, "11", FROM, TO),
    "rare_carrier_count": _rare(Q.rare_carrier_count, "11", FROM, TO),
    "carriers_distinct": _rare(Q.rare_carrier_count),
    "variants_per_sample": _rare(Q.variants_per_sample),
    "variants_per_sample_in_range": _rare(Q.variants_per_sample, "11", FROM, TO),
    "rare_carriers_near_locus": _rare(Q.rare_carrier_count, "11", *WINDOW),
    "rare_carrier_list_near_locus": _rare(Q.rare_carriers, "11", *WINDOW),
    "rare_homozygous_sites": rare_homozygous_sites,
    "interval_allele_frequency": interval_allele_frequency,
    "gene_rare_variants": gene_rare_variants,
    "rsid_variants": rsid_variants,
}

_SITE_JOIN = (
    "g.chrom=v.chrom and g.pos=v.pos and g.ref=v.ref and g.alt_string=v.alt_string"
)
_CARRIERS = (
    "from flat v join geno g on " + _SITE_JOIN + " and v.alt_allele in (g.allele1, g.allele2) "
    f"where v.af<{RARE}"
)
_RANGE = f" and v.chrom='11' and v.pos between {FROM} and {TO}"
_NEAR = f" and v.chrom='11' and v.pos between {WINDOW[0]} and {WINDOW[1]}"
_CARRIER_COLUMNS = (
    "select v.chrom, v.pos, v.ref, v.alt_string as alt, v.alt_allele_id, v.alt_allele, "
    "v.af as freq, g.sample_id, g.gt, g.allele1, g.allele2 "
)
_PER_SAMPLE = "select g.sample_id, count(*) as cnt {} group by 1"
_HOM = (
    f"case when contains(gt,'|') then {TOKEN1}={TOKEN2} "
    f"else ({TOKEN1}={TOKEN2} or {TOKEN2} is null) end"
)
_COUNTS = (
    "cast(sum(case when v.alt_allele=g.allele1 then 1 else 0 end + "
    "case when v.alt_allele=g.allele2 then 1 else 0 end) as bigint) as num_variant_alleles, "
    "cast(sum(case when regexp_matches(g.gt,'[/|]') then 2 else 1 end) as bigint) "
    "as total_num_alleles "
)
_CONDITION = (
    "select g.chrom, g.pos, g.ref, g.alt_string as alt, g.gt, count(g.sample_id) as samples "
    "from geno g join clinvar_fx c on g.chrom=c.chrom and g.pos=c.pos and g.ref=c.ref "
    f"and list_contains(string_split(c.clndn,','),'{CONDITION}') {{}} group by all"
)


def _top(chrom: str) -> str:
    return check(
        "select chrom, pos, ref, alt_string as alt, alt_allele_id, alt_allele, af as freq "
        f"from flat where af>{COMMON} and chrom='{chrom}' "
        f"order by chrom, pos, ref, alt, alt_allele_id limit {TOP}"
    )


def _gene(where: str) -> str:
    return check(
        "select v.chrom, v.pos, v.ref, v.alt_string as alt, v.alt_allele, v.af, s.geneinfo, "
        f"replace(v.id,';',',') as id, {_COUNTS} from flat v join snp_fx s on s.chrom=v.chrom and "
        f"s.pos=v.pos and s.alt_string=v.alt_string join geno g on {_SITE_JOIN} "
        f"where v.af<{INFREQUENT} and s.geneinfo like '{GENE}%' {where} "
        "group by v.chrom, v.pos, v.ref, v.alt_string, v.alt_allele, v.af, s.geneinfo, v.id"
    )


ORACLES = {
    "alleles_by_population": check(
        "select sample_id, chrom, pos, ref, alt_string as alt, gt, allele1, allele2 from geno "
        f"join panel_fx using (sample_id) where chrom='10' and pos between {FROM} and {TO} "
        f"and gt<>'0|0' and pop='{POP}' and gender='{GENDER}'"
    ),
    "condition_genotypes": check(_CONDITION.format("")),
    "condition_carriers": check(
        _CONDITION.format(
            "and (list_contains(string_split(c.alt_string,','),g.allele1) "
            "or list_contains(string_split(c.alt_string,','),g.allele2))"
        )
    ),
    "common_alleles": _top("2"),
    "common_alleles_view": _top("2"),
    "top_alleles": _top("9"),
    "rare_carriers": check(_CARRIER_COLUMNS + _CARRIERS + _RANGE),
    "rare_carrier_count": check(f"select count(distinct g.sample_id) as carriers {_CARRIERS}{_RANGE}"),
    "carriers_distinct": check(f"select count(distinct g.sample_id) as carriers {_CARRIERS}"),
    "variants_per_sample": check(_PER_SAMPLE.format(_CARRIERS)),
    "variants_per_sample_in_range": check(_PER_SAMPLE.format(_CARRIERS + _RANGE)),
    "rare_carriers_near_locus": check(
        f"select count(distinct g.sample_id) as carriers {_CARRIERS}{_NEAR}"
    ),
    "rare_carrier_list_near_locus": check(_CARRIER_COLUMNS + _CARRIERS + _NEAR),
    "rare_homozygous_sites": check(
        "select v.chrom, v.pos, v.ref, v.alt_string as alt, v.alt_allele_id, v.alt_allele, v.af, "
        f"g.sample_id, g.gt, g.allele1, g.allele2 from flat v join geno g on {_SITE_JOIN} and "
        f"v.alt_allele in (g.allele1, g.allele2) where v.af<{INFREQUENT} and g.sample_id='{SAMPLE}' "
        f"and {_HOM}"
    ),
    "interval_allele_frequency": check(
        "select a.*, s.id as snp_id, s.alt_string as snp_alt, s.geneinfo as snp_geneinfo from ("
        "select v.chrom, v.pos, v.ref, v.alt_string as alt, v.alt_allele, i.gene, v.af, "
        f"{_COUNTS} from flat v join intervals_fx i on v.chrom=i.chrom and v.pos between "
        f"i.region_start and i.region_end join geno g on {_SITE_JOIN} where v.af<{INFREQUENT} "
        "group by v.chrom, v.pos, v.ref, v.alt_string, v.alt_allele, i.gene, v.af) a "
        "left join snp_fx s on s.chrom=a.chrom and s.pos=a.pos and s.ref=a.ref and "
        "list_contains(string_split(s.alt_string,','),a.alt_allele)"
    ),
    "gene_rare_variants": _gene(""),
    "rsid_variants": _gene("and split_part(v.id,';',1) in (select 'rs'||id from clinvar_fx)"),
}
