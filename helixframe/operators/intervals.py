"""Range joins as equi joins on span-sized bins.

Spark evaluates ``chrom = chrom AND pos BETWEEN start AND end`` as a join on the
chromosome with the range as a residual: about 25 keys, quadratic within each. Here each
span gets a bin width of its own magnitude (a power of 8), so it touches at most two bins,
and each point probes one bin per width that occurs. Candidates per span stay proportional to
the points near it whatever the mix of single bases and long reference blocks, no span is
copied more than twice, and no block length needs a cap. A point meets a span in exactly one
bin, so the result needs no deduplication.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.operators.extent import LEVELS, Extent, measure, span_level
from helixframe.session import BROADCAST_MAX_ROWS, broadcast_if_small
from helixframe.sinks.tables import behind_shuffle, written

HOT_BIN_ROWS = 2_000_000
CHUNK = 1 << 16

_LEVEL, _BIN, _CHROM = "__level", "__bin", "__chrom"
_SALT_SPAN, _SALT_POINT = "__salt_span", "__salt_point"


def _bin(position: Column, level: Column) -> Column:
    return F.call_function("shiftright", position, level)


def _with_span_bins(spans: DataFrame, chrom: str, start: str, end: str) -> DataFrame:
    """One row per bin a span touches; spans with end < start cover nothing and drop out."""
    usable = spans.where(F.col(end) >= F.col(start)).withColumn(
        _LEVEL, span_level(F.col(start), F.col(end))
    )
    first = _bin(F.col(start), F.col(_LEVEL))
    last = _bin(F.col(end), F.col(_LEVEL))
    return usable.withColumn(_BIN, F.explode(F.sequence(first, last))).withColumnRenamed(
        chrom, _CHROM
    )


def _with_point_bins(points: DataFrame, chrom: str, pos: str, levels: tuple[int, ...] | DataFrame = LEVELS) -> DataFrame:
    """One row per bin width; ``levels`` are widths for all contigs, or a table of each contig's."""
    named = points.withColumnRenamed(chrom, _CHROM)
    if isinstance(levels, DataFrame):
        probed = named.join(F.broadcast(levels), _CHROM).withColumn(_LEVEL, F.explode("__levels")).drop("__levels")
    elif len(levels) == 1:
        probed = named.withColumn(_LEVEL, F.lit(levels[0]))
    else:
        probed = named.withColumn(_LEVEL, F.explode(F.array(*[F.lit(x) for x in levels])))
    return probed.withColumn(_BIN, _bin(F.col(pos), F.col(_LEVEL)))


def _levels_of(span_counts: DataFrame) -> DataFrame:
    """Widths that occur per contig: one row per contig, at most 11 entries each."""
    return span_counts.groupBy(_CHROM).agg(F.sort_array(F.collect_set(_LEVEL)).alias("__levels"))


def _bin_counts(binned: DataFrame, name: str) -> DataFrame:
    """Rows per bin, stored: the widths and the hot bins both come from this one count."""
    counts = binned.groupBy(_CHROM, _LEVEL, _BIN).agg(F.count(F.lit(1)).alias("n"))
    return written(counts, name)


def _parts(counts: DataFrame, hot_rows: int, name: str) -> DataFrame:
    """Bins with more than ``hot_rows`` rows and the number of parts to split each into."""
    hot = counts.where(F.col("n") > hot_rows)
    return hot.select(_CHROM, _LEVEL, _BIN, F.ceil(F.col("n") / F.lit(hot_rows)).cast("int").alias(name))


def _numbered_alike(df: DataFrame, name: str) -> DataFrame:
    """``df`` if its tasks read rows in the same order whenever they run again, else stored.

    Rows behind a shuffle arrive in any order, so a task that is run again after a loss would
    number them otherwise than the one whose output was already read.
    """
    return written(df, name) if behind_shuffle(df) else df


def _dealt(side: DataFrame, hot: DataFrame, own: str, other: str, salt: str, copy: str) -> DataFrame:
    """Rows of a hot bin dealt over its own parts and copied to the parts of the other side.

    The part follows from the row's number within its input split, so rows of one bin spread
    evenly however the input is clustered, copies of one row included.
    """
    known = side.withColumn("__row", F.monotonically_increasing_id()).join(hot, [_CHROM, _LEVEL, _BIN], "left")
    dealt = known.withColumn(salt, F.pmod(F.col("__row"), F.coalesce(F.col(own), F.lit(1))).cast("int"))
    copies = F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - F.lit(1))
    return dealt.withColumn(copy, F.explode(copies)).drop("__row", own, other)


def _salted(
    spans: DataFrame, points: DataFrame, span_counts: DataFrame, point_counts: DataFrame, hot_rows: int
) -> tuple[DataFrame, DataFrame]:
    """Split hot bins of either side; a bin with S and P parts becomes S x P join keys.

    Both sides of a match meet in exactly one of them.
    """
    hot = _parts(span_counts, hot_rows, "__s").join(
        _parts(point_counts, hot_rows, "__p"), [_CHROM, _LEVEL, _BIN], "full"
    )
    hot, _ = broadcast_if_small(hot)
    return (
        _dealt(spans, hot, "__s", "__p", _SALT_SPAN, _SALT_POINT),
        _dealt(points, hot, "__p", "__s", _SALT_POINT, _SALT_SPAN),
    )


def fits_broadcast(
    extent: Extent, lookup: str = "points", max_rows: int = BROADCAST_MAX_ROWS
) -> bool:
    """The looked-up side may be broadcast, counting the copies its bins make of each row."""
    return extent.is_small(max_rows, len(LEVELS) if lookup == "points" else 2)


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select([F.col(f"`{c}`").alias(prefix + c) for c in df.columns])


def point_in_span_join(
    points: DataFrame,
    spans: DataFrame,
    *,
    point: tuple[str, str] = ("chrom", "pos"),
    span: tuple[str, str, str] = ("chrom", "pos", "end_pos"),
    **options,
) -> DataFrame:
    """Pairs of a point and a span of the same contig that covers it, ends included.

    Columns come back as ``p_*`` and ``s_*``. ``lookup`` names the side expected to be the
    smaller one (``"points"`` or ``"spans"``). It is measured: its extent narrows the other
    side's scan, and if it is small it is broadcast and nothing is shuffled. Otherwise both
    sides are shuffled on their bins: the bins are counted first, points probe only the widths
    that their contig's spans have, and bins above ``hot_rows`` rows of either side are split.
    Each side is read twice then; pass stored tables.
    """
    return _span_join(points, spans, point, None, span, **options)


def span_in_span_join(
    inner: DataFrame,
    outer: DataFrame,
    *,
    inner_span: tuple[str, str, str] = ("chrom", "pos", "end_pos"),
    outer_span: tuple[str, str, str] = ("chrom", "pos", "end_pos"),
    **options,
) -> DataFrame:
    """Pairs where the outer span contains the inner one, as ``p_*`` and ``s_*`` columns.

    A containing span covers the inner start, so the inner span is probed by its start
    alone and the end is compared afterwards.
    """
    chrom, start, end = inner_span
    return _span_join(inner, outer, (chrom, start), end, outer_span, **options)


def _span_join(
    points: DataFrame,
    spans: DataFrame,
    point: tuple[str, str],
    point_end: str | None,
    span: tuple[str, str, str],
    *,
    lookup: str = "points",
    extent: Extent | None = None,
    hot_rows: int = HOT_BIN_ROWS,
    max_rows: int = BROADCAST_MAX_ROWS,
) -> DataFrame:
    p_chrom, p_pos = (f"p_{c}" for c in point)
    s_chrom, s_start, s_end = (f"s_{c}" for c in span)
    points, spans = _prefixed(points, "p_"), _prefixed(spans, "s_")
    columns = [*points.columns, *spans.columns]

    if lookup == "points":
        extent = extent or measure(points, p_chrom, p_pos, p_pos)
        spans = extent.near(spans, s_chrom, s_start, s_end)
    else:
        extent = extent or measure(spans, s_chrom, s_start, s_end)
        points = extent.near(points, p_chrom, p_pos, p_pos)

    small_lookup = fits_broadcast(extent, lookup, max_rows)
    if not small_lookup:
        points, spans = _numbered_alike(points, "range_points"), _numbered_alike(spans, "range_spans")
    binned_spans = _with_span_bins(spans, s_chrom, s_start, s_end)
    keys = [_CHROM, _LEVEL, _BIN]
    if small_lookup:
        if lookup == "points":
            joined = binned_spans.join(F.broadcast(_with_point_bins(points, p_chrom, p_pos)), keys)
        else:
            # The spans' widths were measured: a point becomes one row per width, mostly one in all.
            joined = _with_point_bins(points, p_chrom, p_pos, extent.levels or LEVELS[:1]).join(
                F.broadcast(binned_spans), keys
            )
    else:
        span_counts = _bin_counts(binned_spans, "span_bins")
        binned_points = _with_point_bins(points, p_chrom, p_pos, _levels_of(span_counts))
        point_counts = _bin_counts(binned_points, "point_bins")
        salted_spans, salted_points = _salted(binned_spans, binned_points, span_counts, point_counts, hot_rows)
        joined = salted_spans.join(salted_points, [*keys, _SALT_SPAN, _SALT_POINT])

    exact = (F.col(p_pos) >= F.col(s_start)) & (F.col(p_pos) <= F.col(s_end))
    if point_end is not None:
        exact = exact & (F.col(f"p_{point_end}") <= F.col(s_end))
    restored = joined.where(exact).withColumns({p_chrom: F.col(_CHROM), s_chrom: F.col(_CHROM)})
    return restored.select(columns)


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    *,
    pos: str = "pos",
    start: str = "region_start",
    end: str = "region_end",
    chrom: str = "chrom",
    **options,
) -> DataFrame:
    """Point rows with the columns of every interval that covers them."""
    extra = [c for c in intervals.columns if c != chrom]
    options.setdefault("lookup", "spans")
    pairs = point_in_span_join(
        points, intervals, point=(chrom, pos), span=(chrom, start, end), **options
    )
    return pairs.select(
        [F.col(f"p_{c}").alias(c) for c in points.columns]
        + [F.col(f"s_{c}").alias(c) for c in extra]
    )


def bed_positions(
    bed: DataFrame, chrom: str = "chrom", start: str = "start_pos", end: str = "end_plus1"
) -> DataFrame:
    """Every position of half-open intervals [start, end); empty intervals give none."""
    usable = bed.where(F.col(end) > F.col(start))
    # First the starts of chunks, then the positions of a chunk: no array grows with an interval.
    chunks = usable.select(
        F.col(chrom).alias("chrom"),
        F.explode(F.sequence(F.col(start), F.col(end) - F.lit(1), F.lit(CHUNK))).alias("first"),
        F.col(end).alias("end"),
    )
    last = F.least(F.col("end") - F.lit(1), F.col("first") + F.lit(CHUNK - 1))
    return chunks.select("chrom", F.explode(F.sequence("first", last)).alias("pos"))
