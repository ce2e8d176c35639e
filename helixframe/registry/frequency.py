"""Frequency annotation against the genotype panel."""

from __future__ import annotations

from helixframe.plans import frequency as N
from helixframe.registry import inputs as src
from helixframe.registry.inputs import check, flat


def _compare(match_ref):
    def run(spark, sf):
        rows = N.gnomad_compare(src.gnomad(spark, sf), src.alleles(spark, sf), match_ref)
        return flat(rows)

    return run


QUERIES = {
    "population_enriched_sites": lambda s, sf: N.population_enriched_sites(src.gnomad(s, sf)),
    "gnomad_compare": _compare(False),
    "gnomad_compare_by_ref": _compare(True),
    "gnomad_carriers": lambda s, sf: N.gnomad_carriers(src.gnomad(s, sf), src.genotypes(s, sf)),
    "gnomad_carriers_by_pop": lambda s, sf: N.gnomad_carriers_by_pop(
        src.gnomad(s, sf), src.genotypes(s, sf), src.panel(s, sf)
    ),
}

_TARGETS = (
    "select chrom, pos, id, ref, alt_allele, cast(af_fin as double) as af_fin, "
    "cast(af as double) as af from gnomad_fx where cast(af_fin as double)>0.5 "
    "and cast(af as double)<0.1"
)


def _compare_sql(extra: str) -> str:
    return check(
        "select t.af_fin, t.af, t.chrom, t.pos, t.alt_allele, t.ref, replace(v.id,';',',') as v_id, "
        "v.ref as v_ref, v.alt_string as v_alt, v.filter as v_filter, "
        "v.alt_allele_id as v_alt_allele_id, v.af as v_af from flat v join targets t "
        f"on v.chrom=t.chrom and v.pos=t.pos and v.alt_allele=t.alt_allele {extra}",
        targets=_TARGETS,
    )


def _carriers_sql(pop: str, join: str) -> str:
    return check(
        f"select t.af_fin, t.af, t.chrom, t.pos, t.alt_allele, t.ref, {pop} count(*) as cnt "
        f"from geno g join targets t on g.chrom=t.chrom and g.pos=t.pos and "
        f"t.alt_allele in (g.allele1, g.allele2) {join} group by all",
        targets=_TARGETS,
    )


ORACLES = {
    "population_enriched_sites": check("select * from targets", targets=_TARGETS),
    "gnomad_compare": _compare_sql(""),
    "gnomad_compare_by_ref": _compare_sql("and v.ref=t.ref"),
    "gnomad_carriers": _carriers_sql("", ""),
    "gnomad_carriers_by_pop": _carriers_sql(
        "p.pop,", "join panel_fx p on p.sample_id=g.sample_id"
    ),
}
