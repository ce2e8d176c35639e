"""Cohort analyses over per-sample gVCF spans.

``spans`` is the gVCF view: chrom, pos, end_pos, ref, alt_string, alt, filter, sample_id,
gt and the FORMAT columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.operators import predicates as P
from helixframe.operators.extent import Extent, measure
from helixframe.operators.intervals import (
    bed_positions,
    fits_broadcast,
    point_in_span_join,
    span_in_span_join,
)
from helixframe.operators.joins import counted
from helixframe.operators.reshape import flatten_alts, pivot_text
from helixframe.plans.tables import decode_calls, rebase_calls
from helixframe.session import BROADCAST_MAX_ROWS
from helixframe.sinks.tables import materialize, read_clustered, write_clustered, written

SPAN_KEYS = ("chrom", "pos", "end_pos")


def genotypes_at_position(spans: DataFrame, chrom: str, loc: int) -> DataFrame:
    """Every call at a position, reference blocks included."""
    return P.covering(spans, chrom, loc)


def _nonref_calls(spans: DataFrame, chrom, start, end) -> DataFrame:
    if chrom is not None:
        spans = P.locus_range(spans, chrom, start, end)
    return P.non_ref(P.pass_only(spans))


def nonref_sites(
    spans: DataFrame, chrom: str | None = None, start: int | None = None, end: int | None = None
) -> DataFrame:
    """Sites with passing non-reference calls and how many; the least REF text stands in
    where rows disagree."""
    return _site_counts(spans, chrom, start, end).orderBy("chrom", "pos", "end_pos")


def _site_counts(spans: DataFrame, chrom, start, end) -> DataFrame:
    return _nonref_calls(spans, chrom, start, end).groupBy(*SPAN_KEYS).agg(
        F.min("ref").alias("ref"), F.count("sample_id").alias("samples")
    )


def genotypes_at_nonref_sites(
    spans: DataFrame, chrom: str | None = None, start: int | None = None, end: int | None = None
) -> DataFrame:
    """Every sample's call at those sites, from variant rows and blocks that contain them.

    Alleles are spelled out with the site's REF, since a block knows only its first base.
    """
    needed = spans.select(*SPAN_KEYS, "sample_id", "alt", "filter", "gt", "dp", "gq", "min_dp")
    pairs = span_in_span_join(_written_sites(spans, chrom, start, end), needed)
    return decode_calls(pairs, "p_ref", "s_alt", "s_gt").select(
        F.col("s_sample_id").alias("sample_id"),
        F.col("p_chrom").alias("chrom"),
        F.col("p_pos").alias("pos"),
        F.col("p_ref").alias("ref"),
        F.col("s_filter").alias("filter"),
        F.col("s_pos").alias("gpos"),
        F.col("s_end_pos").alias("gend"),
        F.col("s_gt").alias("gt"),
        "allele1",
        "allele2",
        F.col("s_dp").alias("dp"),
        F.col("s_gq").alias("gq"),
        F.col("s_min_dp").alias("min_dp"),
    )


def _counted_once(
    spans: DataFrame, keys: list[str], extent: Extent, max_rows: int = BROADCAST_MAX_ROWS
) -> DataFrame:
    """Counted span calls; stored where the join shuffles them, since it reads them twice."""
    in_place = fits_broadcast(extent, max_rows=max_rows)
    calls = counted(spans, keys, in_place)
    return calls if in_place else written(calls, "counted_calls")


def _written_sites(spans: DataFrame, chrom, start, end) -> DataFrame:
    """The sites as a written table, since they are measured and joined."""
    return written(_site_counts(spans, chrom, start, end).select(*SPAN_KEYS, "ref"), "nonref_sites")


def genotype_counts_at_sites(
    spans: DataFrame, chrom: str | None = None, start: int | None = None, end: int | None = None
) -> DataFrame:
    """Calls per site and spelled-out genotype."""
    sites = _written_sites(spans, chrom, start, end)
    extent = measure(sites, "chrom", "pos", "pos")
    calls = _counted_once(spans, [*SPAN_KEYS, "alt", "gt"], extent)
    pairs = span_in_span_join(sites, calls, extent=extent)
    decoded = decode_calls(pairs, "p_ref", "s_alt", "s_gt").select(
        F.col("p_chrom").alias("chrom"),
        F.col("p_pos").alias("pos"),
        F.col("p_ref").alias("ref"),
        "allele1",
        "allele2",
        F.col("s_gt").alias("gt"),
        F.col("s_n").alias("n"),
    )
    return (
        decoded.groupBy("chrom", "pos", "ref", "allele1", "allele2", "gt")
        .agg(F.sum("n").alias("cnt"))
        .orderBy("chrom", "pos")
    )


def alts_per_position(
    spans: DataFrame, chrom: str | None = None, start: int | None = None, end: int | None = None
) -> DataFrame:
    """Each ALT allele of each passing non-reference row."""
    rows = flatten_alts(_nonref_calls(spans, chrom, start, end))
    return rows.select(*SPAN_KEYS, "ref", F.col("alt_allele").alias("allele"))


def alt_union(
    spans: DataFrame, chrom: str | None = None, start: int | None = None, end: int | None = None
) -> DataFrame:
    """Union of ALT alleles per site, sorted."""
    alleles = alts_per_position(spans, chrom, start, end).distinct()
    return alleles.groupBy(*SPAN_KEYS, "ref").agg(
        F.sort_array(F.collect_list("allele")).alias("alt")
    )


def vcf_value(gt: Column, dp: Column, gq: Column, min_dp: Column, ft: Column) -> Column:
    """A GT:DP:GQ:MIN_DP:FT sample column."""

    def shown(value: Column) -> Column:
        return F.coalesce(value.cast("string"), F.lit("."))

    return F.concat_ws(":", gt, shown(dp), shown(gq), shown(min_dp), shown(ft))


RECORD_COLUMNS = ("chrom", "pos", "id", "ref", "alt", "qual", "filter", "info", "format")


def vcf_records(
    spans: DataFrame, chrom: str | None = None, start: int | None = None, end: int | None = None
) -> DataFrame:
    """Long multi-sample VCF records: the fixed columns, ``sample_id`` and its value."""
    union = alt_union(spans, chrom, start, end)
    if "id" in spans.columns:
        ids = (
            _nonref_calls(spans, chrom, start, end)
            .groupBy(*SPAN_KEYS, "ref")
            .agg(F.min("id").alias("id"))
        )
        keys = [F.col(f"u.{c}").eqNullSafe(F.col(f"i.{c}")) for c in (*SPAN_KEYS, "ref")]
        sites = union.alias("u").join(ids.alias("i"), keys).select("u.*", "i.id")
    else:
        sites = union.withColumn("id", F.lit(None).cast("string"))
    outer = spans.select(*SPAN_KEYS, "sample_id", "alt", "gt", "dp", "gq", "min_dp", "filter")
    pairs = span_in_span_join(written(sites, "record_sites"), outer)
    value = vcf_value(
        F.col("gt"), F.col("s_dp"), F.col("s_gq"), F.col("s_min_dp"), F.col("s_filter")
    )
    return rebase_calls(pairs, "s_alt", "p_alt", "s_gt", "gt").select(
        F.col("p_chrom").alias("chrom"),
        F.col("p_pos").alias("pos"),
        F.col("p_id").alias("id"),
        F.col("p_ref").alias("ref"),
        F.array_join(F.col("p_alt"), ",").alias("alt"),
        F.lit(".").alias("qual"),
        F.lit(".").alias("filter"),
        F.lit(".").alias("info"),
        F.lit("GT:DP:GQ:MIN_DP:FT").alias("format"),
        F.col("s_sample_id").alias("sample_id"),
        value.alias("value"),
    )


def multisample_vcf(
    spans: DataFrame,
    panel: DataFrame,
    chrom: str | None = None,
    start: int | None = None,
    end: int | None = None,
) -> DataFrame:
    """Multi-sample VCF rows: the fixed columns and all panel samples' values, tab-joined.

    ``sample_line(panel)`` gives the names for the ``#CHROM`` line.
    """
    records = vcf_records(spans, chrom, start, end)
    return pivot_text(records, list(RECORD_COLUMNS), panel, F.col("value"), order=("chrom", "pos"))


def cohort_variants(spans: DataFrame, with_id: bool = False) -> DataFrame:
    """Distinct variant calls of the cohort with their counts."""
    counters = [F.count(F.lit(1)).alias("cnt")]
    if with_id:
        counters.insert(0, F.max("id").alias("id"))
    return P.non_ref_block(spans).groupBy("chrom", "pos", "ref", "alt", "gt").agg(*counters)


def variant_calls(spans: DataFrame) -> DataFrame:
    """Variant calls by ALT text, in locus order."""
    return (
        P.non_ref_block(spans)
        .groupBy("chrom", "pos", "ref", "alt_string", "gt")
        .agg(F.count(F.lit(1)).alias("c"))
        .orderBy("chrom", "pos")
    )


def cohort_loci(variants: DataFrame) -> DataFrame:
    """Loci of the cohort with the sorted union of their ALT alleles.

    With an ``id`` column in the input, loci are kept apart by it and ``cnt`` is summed
    over the exploded alleles.
    """
    keys = ["chrom", "pos", *(["id"] if "id" in variants.columns else []), "ref"]
    alleles = flatten_alts(variants).groupBy(*keys, "alt_allele").agg(F.sum("cnt").alias("cnt"))
    loci = alleles.groupBy(*keys).agg(
        F.sort_array(F.collect_list("alt_allele")).alias("alt"), F.sum("cnt").alias("cnt")
    )
    loci = loci.withColumn("alt_string", F.array_join("alt", ","))
    return loci if "id" in variants.columns else loci.drop("cnt")


def cohort_tables(spans: DataFrame, with_id: bool = False) -> tuple[DataFrame, DataFrame]:
    """The cohort's variants and loci as written tables."""
    variants = written(cohort_variants(spans, with_id), "cohort_variants")
    return variants, written(cohort_loci(variants), "cohort_loci")


def _span_calls(spans: DataFrame, loci: DataFrame, extra: str, **options) -> DataFrame:
    """Loci with the calls of the spans that cover them, re-encoded to the locus ALT."""
    pairs = point_in_span_join(
        loci.select("chrom", "pos", "ref", "alt", "alt_string"),
        spans.select(*SPAN_KEYS, "alt", "gt", extra),
        **options,
    )
    return rebase_calls(pairs, "s_alt", "p_alt", "s_gt", "gt").select(
        F.col("p_chrom").alias("chrom"),
        F.col("p_pos").alias("pos"),
        F.col("p_ref").alias("ref"),
        F.col("p_alt_string").alias("alt_string"),
        "gt",
        F.col(f"s_{extra}").alias(extra),
    )


CALL_KEYS = ("chrom", "pos", "ref", "alt_string", "gt")
LIST_PARTS = 32


def sample_lists(calls: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Count and ordered, comma-joined sample list per key.

    Samples are first listed in parts by a hash of the sample, so a frequent call (the
    reference, mostly) is gathered by many tasks, also from a table clustered by locus, and
    only the part lists meet. The list itself is the value of one result row and as long as
    that row's samples.
    """
    parted = calls.withColumn("__part", F.pmod(F.xxhash64("sample_id"), F.lit(LIST_PARTS)))
    parts = parted.groupBy(*keys, "__part").agg(
        F.collect_list("sample_id").alias("__samples"), F.count(F.lit(1)).alias("__n")
    )
    return parts.groupBy(*keys).agg(
        F.sum("__n").alias("cnt"),
        F.array_join(F.sort_array(F.flatten(F.collect_list("__samples"))), ",").alias("samples"),
    )


def cohort_calls(spans: DataFrame, loci: DataFrame, **options) -> DataFrame:
    """Calls at the cohort's loci: count and the ordered list of samples.

    ``options`` are those of the range join.

    A table to be written, so it is left unsorted: ``write_clustered`` orders it.
    ``compute_variant_counts`` gives the counts alone.
    """
    return sample_lists(_span_calls(spans, loci, "sample_id", **options), CALL_KEYS)


def compute_variant_counts(
    spans: DataFrame, loci: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, **options
) -> DataFrame:
    """Calls at the cohort's loci over all contigs in one job."""
    extent = measure(loci, "chrom", "pos", "pos")
    calls = _counted_once(spans, [*SPAN_KEYS, "alt", "gt"], extent, max_rows)
    at_loci = _span_calls(calls, loci, "n", extent=extent, max_rows=max_rows, **options)
    return at_loci.groupBy(*CALL_KEYS).agg(F.sum("n").alias("cnt"))


def store_variant_counts(spans: DataFrame, loci: DataFrame, path: str, **options) -> DataFrame:
    """``compute_variant_counts`` as a named table: clustered by locus below ``path``."""
    counts = compute_variant_counts(spans, loci, **options)
    write_clustered(counts, path, ("chrom", "pos", "ref"))
    return read_clustered(spans.sparkSession, path, counts.schema)


def range_cohort_calls(spans: DataFrame, name: str, chrom: str, start: int, end: int) -> DataFrame:
    """The range workflow: base table, variants with the greatest id, loci by id, call list.

    The base is materialized under ``name``; the other steps read only it.
    """
    base = materialize(P.locus_range(spans, chrom, start, end), name)
    _, loci = cohort_tables(base, with_id=True)
    return cohort_calls(base, loci)


def samples_by_genotype(calls: DataFrame) -> DataFrame:
    """Ordered sample list per site and call."""
    return sample_lists(calls, ("chrom", "pos", "ref", "gt"))


def alt_variations(spans: DataFrame) -> DataFrame:
    """Passing single-base sites whose calls list more than one ALT array."""
    rows = P.non_ref(P.pass_only(P.single_base(spans)))
    counts = rows.groupBy("chrom", "pos", "ref").agg(F.count_distinct("alt").alias("varcnt"))
    return counts.where(F.col("varcnt") > 1)


def alt_refs(spans: DataFrame) -> DataFrame:
    """Passing single-base positions with more than one REF."""
    rows = P.pass_only(P.single_base(spans))
    counts = rows.groupBy("chrom", "pos").agg(F.count_distinct("ref").alias("refcnt"))
    return counts.where(F.col("refcnt") > 1)


def depth_histogram(spans: DataFrame, width: int = 5) -> DataFrame:
    """Passing variant rows by depth, to the nearest multiple of ``width``."""
    rows = P.pass_only(P.non_ref_block(spans))
    depth = (F.round(F.col("dp") / F.lit(width)).cast("int") * F.lit(width)).alias("depth")
    return rows.groupBy(depth).agg(F.count(F.lit(1)).alias("c")).orderBy("depth")


def filter_distribution(spans: DataFrame) -> DataFrame:
    return spans.groupBy("filter").agg(F.count(F.lit(1)).alias("count")).orderBy("filter")


def bed_cohort_frequencies(spans: DataFrame, bed: DataFrame) -> DataFrame:
    """Calls of the cohort at every position of BED intervals.

    Positions repeat where intervals overlap, as they do in the input.
    """
    positions = bed_positions(bed)
    extent = measure(positions, "chrom", "pos", "pos")
    calls = _counted_once(spans, [*SPAN_KEYS, "alt_string", "gt"], extent)
    pairs = point_in_span_join(positions, calls, extent=extent)
    return pairs.groupBy(
        F.col("p_chrom").alias("chrom"),
        F.col("p_pos").alias("pos"),
        F.col("s_alt_string").alias("alt_string"),
        F.col("s_gt").alias("gt"),
    ).agg(F.sum("s_n").alias("c"))


def pgx_calls(spans: DataFrame, loci: DataFrame) -> DataFrame:
    """Each sample's call at pharmacogene loci, spelled out with the locus REF."""
    pairs = point_in_span_join(
        loci.select("chrom", "pos", "ref"), spans.select(*SPAN_KEYS, "alt", "gt", "sample_id")
    )
    return decode_calls(pairs, "p_ref", "s_alt", "s_gt").select(
        F.col("s_sample_id").alias("sample_id"),
        F.col("p_chrom").alias("chrom"),
        F.col("p_pos").alias("pos"),
        F.col("p_ref").alias("ref"),
        "allele1",
        "allele2",
    )


def pgx_haplotypes(spans: DataFrame, loci: DataFrame) -> DataFrame:
    """Distribution of samples' genotype texts over pharmacogene loci.

    ``altcount`` counts loci with a known non-reference allele. A sample's text is as long
    as the list of loci.
    """
    calls = pgx_calls(spans, loci)
    first, second, ref = F.col("allele1"), F.col("allele2"), F.col("ref")
    shown = F.concat_ws("-", F.coalesce(first, F.lit(".")), F.coalesce(second, F.lit(".")))
    other = ((first != ref) & first.isNotNull()) | ((second != ref) & second.isNotNull())
    per_sample = calls.groupBy("sample_id").agg(
        F.sort_array(F.collect_list(F.struct(F.col("pos"), shown.alias("text")))).alias("texts"),
        F.sum(F.when(other, F.lit(1)).otherwise(F.lit(0))).alias("altcount"),
    )
    texts = F.transform(F.col("texts"), lambda t: t["text"])
    return (
        per_sample.select(F.array_join(texts, " , ").alias("multi_genotype"), "altcount")
        .groupBy("multi_genotype", "altcount")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy(F.desc("altcount"), F.desc("cnt"))
    )
