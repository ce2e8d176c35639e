"""Stored layouts, sample sets, cohort maintenance and table functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe.fixtures import fixture
from helixframe.functions.sql import register_table_functions
from helixframe.operators import info as I
from helixframe.operators import predicates as P
from helixframe.operators import sample_sets as B
from helixframe.plans import maintenance as M
from helixframe.plans import population
from helixframe.registry import inputs as src
from helixframe.registry.cohort import _CALLS, _COUNTS, _LOCI
from helixframe.registry.inputs import check, flat
from helixframe.registry.population import _CARRIERS as RARE_CARRIERS
from helixframe.registry.population import RARE
from helixframe.registry.scalars import dictionary
from helixframe.session import new_scratch_path
from helixframe.sinks import spans as W
from helixframe.sinks import tables as K
from helixframe.sinks import variants as V

RSIDS = tuple(f"rs{n}" for n in (4, 8, 100, 101, 1000, 99999999))


def spans_covering_stored(spark, sf):
    """Genotypes at a position from the layout by span magnitude."""
    spans, path = src.spans(spark, sf), new_scratch_path(spark, "span-levels")
    W.write_spans(spans, path)
    found = W.spans_covering(spark, path, spans.schema, "2", 1925)
    return flat(found.select("chrom", "pos", "end_pos", "ref", "alt", "sample_id", "gt", "dp"))


def spans_meeting_range(spark, sf):
    """Spans that meet a range of positions, from the same layout."""
    spans, path = src.spans(spark, sf), new_scratch_path(spark, "span-levels")
    W.write_spans(spans, path)
    found = W.spans_covering(spark, path, spans.schema, "11", 3000, 6000)
    return flat(found.select("chrom", "pos", "end_pos", "ref", "alt", "sample_id", "gt"))


def find_rsids(spark, sf):
    """A few annotated sites by identifier from a table in locus order with Bloom filters."""
    rows, path = fixture(spark, sf, "snp_fx"), new_scratch_path(spark, "snp-bloom")
    K.write_clustered(rows, path, K.SITE_ORDER, bloom=("id",))
    return K.find(spark, path, rows.schema, "id", list(RSIDS))


def _carrier_rows(spark, sf):
    return P.carries_alt(src.genotypes(spark, sf)).select("chrom", "pos", "ref", "sample_id")


def carrier_sets(spark, sf):
    """Distinct carriers per site, as counted by the sites' sample sets."""
    places = B.sample_places(src.panel(spark, sf))
    return B.carriers_by_key(_carrier_rows(spark, sf), places, ["chrom", "pos", "ref"])


def carrier_sets_merged(spark, sf):
    """Stored sets of sites merged to contigs: who carries anything there, each sample once."""
    places = B.sample_places(src.panel(spark, sf))
    sets = B.sample_sets(B.with_place(_carrier_rows(spark, sf), places), ["chrom", "pos", "ref"])
    stored = K.written(sets, "carrier-sets")
    return B.count_sets(B.merge_sets(stored, ["chrom"]), ["chrom"])


def carrier_set_members(spark, sf):
    """Samples that carry an alternate allele at every site with carriers of a contig."""
    places = B.sample_places(src.panel(spark, sf))
    rows = B.with_place(_carrier_rows(spark, sf).where("chrom = '7'"), places)
    return B.set_members(B.merge_sets(B.sample_sets(rows, ["chrom", "pos"]), ["chrom", "pos"]), places)


def rare_carrier_count_by_sets(spark, sf):
    """The count of distinct samples with a rare allele, without sample names in a shuffle."""
    places = B.sample_places(src.panel(spark, sf))
    rows = population.rare_carriers(src.alleles(spark, sf), src.genotypes(spark, sf), RARE)
    return B.count_sets(B.sample_sets(B.with_place(rows.select("sample_id"), places), []), [])


def _third(n):
    """Samples of one third of the cohort, by their number."""
    return F.substring("sample_id", 2, 9).cast("int") % 3 == n


def update_cohort_counts(spark, sf):
    """Counts of a cohort that grew by two batches of samples."""
    spans = K.written(src.spans(spark, sf), "cohort-spans")
    paths = [new_scratch_path(spark, "cohort-state") for _ in range(3)]
    state = M.start_cohort(spans.where(_third(0)), paths[0])
    state = M.update_cohort(state, spans.where(~_third(2)), paths[1], added=spans.where(_third(1)))
    state = M.update_cohort(state, spans, paths[2], added=spans.where(_third(2)))
    return state.counts


def withdraw_samples(spark, sf):
    """Counts after some samples were withdrawn and others came in one update."""
    spans = K.written(src.spans(spark, sf), "cohort-spans")
    paths = [new_scratch_path(spark, "cohort-state") for _ in range(2)]
    state = M.start_cohort(spans.where(~_third(0)), paths[0])
    state = M.update_cohort(
        state, spans.where(~_third(2)), paths[1], added=spans.where(_third(0)), removed=spans.where(_third(2))
    )
    return state.counts


def sql_cohort_counts(spark, sf):
    """Cohort counts by SQL alone."""
    register_table_functions(spark, src.spans(spark, sf))
    return spark.sql("select * from cohort_counts(cast(null as string))")


def sql_cohort_counts_of_contig(spark, sf):
    register_table_functions(spark, src.spans(spark, sf))
    return spark.sql("select pos, ref, sum(cnt) as calls from cohort_counts('11') group by pos, ref")


def sql_spans_at(spark, sf):
    register_table_functions(spark, src.spans(spark, sf))
    return flat(spark.sql("select * from spans_at('2', 1925)"))


def info_path_shredded(spark, sf):
    """Paths into INFO stored as a shredded VARIANT."""
    rows = I.info_variant(I.parse_info(src.sites(spark, sf), dictionary(spark)))
    path = new_scratch_path(spark, "info-shredded")
    V.write_shredded(rows, path)
    stored = V.read_shredded(spark, path, rows.schema)
    return stored.select(
        "chrom", "pos",
        I.variant_path(F.col("info"), "$.AF[0]", "double").alias("af0"),
        I.variant_path(F.col("info"), "$.AN", "bigint").alias("an"),
    )


QUERIES = {
    "info_path_shredded": info_path_shredded,
    "spans_covering_stored": spans_covering_stored,
    "spans_meeting_range": spans_meeting_range,
    "find_rsids": find_rsids,
    "carrier_sets": carrier_sets,
    "carrier_sets_merged": carrier_sets_merged,
    "carrier_set_members": carrier_set_members,
    "rare_carrier_count_by_sets": rare_carrier_count_by_sets,
    "update_cohort_counts": update_cohort_counts,
    "withdraw_samples": withdraw_samples,
    "sql_cohort_counts": sql_cohort_counts,
    "sql_cohort_counts_of_contig": sql_cohort_counts_of_contig,
    "sql_spans_at": sql_spans_at,
}

_CARRIERS = (
    "select distinct g.chrom, g.pos, g.ref, g.sample_id from geno g join panel_fx p using (sample_id) "
    "where split_part(gt,'|',1)<>'0' or (contains(gt,'|') and split_part(gt,'|',2)<>'0')"
)
_KEPT = "select * from spans where cast(substr(sample_id,2) as int)%3<>2"

ORACLES = {
    "info_path_shredded": check(
        "select chrom, pos, cast(split_part(af_string,',',1) as double) as af0, "
        "cast(regexp_extract(info,'AN=([0-9]+)',1) as bigint) as an from sites_fx"
    ),
    "spans_covering_stored": check(
        "select chrom, pos, end_pos, ref, alt_string as alt, sample_id, gt, dp from spans "
        "where chrom='2' and 1925 between pos and end_pos"
    ),
    "spans_meeting_range": check(
        "select chrom, pos, end_pos, ref, alt_string as alt, sample_id, gt from spans "
        "where chrom='11' and pos<=6000 and end_pos>=3000"
    ),
    "find_rsids": check(f"select * from snp_fx where id in {RSIDS}"),
    "carrier_sets": check(
        "select chrom, pos, ref, count(*) as carriers from carried group by chrom, pos, ref", carried=_CARRIERS
    ),
    "carrier_sets_merged": check(
        "select chrom, count(distinct sample_id) as carriers from carried group by chrom", carried=_CARRIERS
    ),
    "carrier_set_members": check(
        "select distinct chrom, pos, sample_id from carried where chrom='7'", carried=_CARRIERS
    ),
    "rare_carrier_count_by_sets": check(
        f"select cast(count(distinct g.sample_id) as bigint) as carriers {RARE_CARRIERS}"
    ),
    "update_cohort_counts": check(_COUNTS, loci=_LOCI, calls=_CALLS),
    "withdraw_samples": check(
        _COUNTS,
        kept=_KEPT,
        loci=_LOCI.replace("from gvcf_fx", "from kept"),
        calls=_CALLS.replace("from spans g", "from kept g"),
    ),
    "sql_cohort_counts": check(_COUNTS, loci=_LOCI, calls=_CALLS),
    "sql_cohort_counts_of_contig": check(
        "select pos, ref, count(*) as calls from calls where chrom='11' group by pos, ref", loci=_LOCI, calls=_CALLS
    ),
    "sql_spans_at": check(
        "select chrom, pos, end_pos, ref, alt_string as alt, sample_id, gt from spans "
        "where chrom='2' and 1925 between pos and end_pos"
    ),
}
