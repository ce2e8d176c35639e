"""Cohort counts kept up as samples come and go.

The state of a cohort is its variants with their counts, its loci, and the calls counted at
them (``compute_variant_counts``). New or withdrawn samples change it by signed deltas: their
spans alone are counted at loci whose ALT union stays as it is, and the whole cohort is counted
only at loci that are new or whose union has changed, since calls there are written otherwise.
The result equals a count of the whole cohort.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.plans.cohort import CALL_KEYS, cohort_loci, cohort_variants, compute_variant_counts
from helixframe.sinks.tables import read_clustered, write_clustered, written

LOCUS = ("chrom", "pos", "ref")
VARIANT_KEYS = ("chrom", "pos", "ref", "alt", "gt")


@dataclass(frozen=True)
class CohortState:
    """``variants`` (with ``cnt``), ``loci`` and ``counts`` of a cohort, as stored tables."""

    variants: DataFrame
    loci: DataFrame
    counts: DataFrame


def _stored(df: DataFrame, path: str) -> DataFrame:
    write_clustered(df, path, LOCUS)
    return read_clustered(df.sparkSession, path, df.schema)


def _state(variants: DataFrame, loci: DataFrame, counts: DataFrame, path: str) -> CohortState:
    return CohortState(*(_stored(df, f"{path}/{name}") for name, df in (("variants", variants), ("loci", loci), ("counts", counts))))


def start_cohort(spans: DataFrame, path: str, **options) -> CohortState:
    """The state of a cohort counted as a whole, stored below ``path``."""
    variants = written(cohort_variants(spans), "cohort-variants")
    loci = written(cohort_loci(variants), "cohort-loci")
    return _state(variants, loci, written(compute_variant_counts(spans, loci, **options), "cohort-counts"), path)


def read_cohort(spark: SparkSession, path: str, schema_of: CohortState) -> CohortState:
    """A stored state, in the columns of another."""
    return CohortState(*(read_clustered(spark, f"{path}/{name}", getattr(schema_of, name).schema) for name in ("variants", "loci", "counts")))


def _signed(parts: list[tuple[int, DataFrame]], keys: tuple[str, ...]) -> DataFrame:
    """Counts added up with their signs; what comes to nothing is gone."""
    signed = [df.select(*keys, (F.col("cnt") * sign).alias("cnt")) for sign, df in parts]
    whole = signed[0]
    for more in signed[1:]:
        whole = whole.unionByName(more)
    return whole.groupBy(*keys).agg(F.sum("cnt").alias("cnt")).where(F.col("cnt") != 0)


def update_cohort(
    state: CohortState,
    current: DataFrame,
    path: str,
    *,
    added: DataFrame | None = None,
    removed: DataFrame | None = None,
    **options,
) -> CohortState:
    """The state after spans of some samples were ``added`` and those of others ``removed``.

    ``current`` are the spans of the whole cohort as it is now; they are read only near loci
    that are new or whose ALT union has changed. ``path`` is a new folder.
    """
    deltas = [(sign, spans) for sign, spans in ((1, added), (-1, removed)) if spans is not None]
    if not deltas:
        return state
    changes = [(sign, cohort_variants(spans)) for sign, spans in deltas]
    variants = written(_signed([(1, state.variants), *changes], VARIANT_KEYS), "cohort-variants")
    loci = written(cohort_loci(variants), "cohort-loci")
    # Only loci that the changed samples vary at can be new, gone or otherwise written.
    touched = changes[0][1].select(*LOCUS)
    for _, more in changes[1:]:
        touched = touched.unionByName(more.select(*LOCUS))
    before = state.loci.select(*LOCUS, F.col("alt_string").alias("__before"))
    now = loci.join(touched.distinct(), list(LOCUS), "left_semi").join(before, list(LOCUS), "left")
    anew = written(now.where(~F.col("alt_string").eqNullSafe(F.col("__before"))).drop("__before"), "cohort-loci-anew")
    keys = [*LOCUS, "alt_string"]
    kept = written(
        loci.join(state.loci.select(*keys), keys, "left_semi"), "cohort-loci-kept"
    )
    stayed = state.counts.join(kept.select(*keys), keys, "left_semi")
    at_kept = [(sign, compute_variant_counts(spans, kept, **options)) for sign, spans in deltas]
    at_anew = compute_variant_counts(current, anew, **options)
    counts = _signed([(1, stayed), *at_kept, (1, at_anew)], CALL_KEYS)
    return _state(variants, loci, written(counts, "cohort-counts"), path)
