"""Range joins against brute force, on every path."""

import random

import pytest
from pyspark.sql import functions as F

from helixframe.operators import intervals as R
from helixframe.operators.extent import measure

SPAN = "chrom string, pos int, end_pos int, name int"
POINT = "chrom string, pos int, tag int"

# (lookup side, broadcast bound, hot bin rows)
PATHS = [("points", 10**6, 10**6), ("spans", 10**6, 10**6), ("points", 0, 10**6), ("spans", 0, 10**6),
         ("points", 0, 3), ("spans", 0, 3)]


def _random(seed):
    rng = random.Random(seed)
    spans, points = [], []
    for n in range(400):
        start = rng.randrange(1, 5000)
        length = rng.choice([0, 0, 0, 1, 7, 8, 9, 63, 64, 65, 500, 4000, 10**7, 5 * 10**8])
        spans.append((rng.choice("123X"), start, start + rng.randrange(length + 1), n))
    spans += [("1", 100, 50, 900), ("2", 7, 7, 901), ("9", 1, 9, 902), (None, 1, 9, 903)]
    spans += [("1", 1000, 1200, 1000 + n) for n in range(300)]
    for n in range(300):
        points.append((rng.choice("123Y"), rng.randrange(1, 6000), n))
    points += [("1", 1100, 777)] * 40 + [(None, 5, 778), ("3", None, 779)]
    return spans, points


@pytest.mark.parametrize("lookup,max_rows,hot_rows", PATHS)
def test_points_in_spans(spark, lookup, max_rows, hot_rows):
    spans, points = _random(1)
    got = R.point_in_span_join(
        spark.createDataFrame(points, POINT).repartition(5),
        spark.createDataFrame(spans, SPAN).repartition(7),
        lookup=lookup, max_rows=max_rows, hot_rows=hot_rows,
    )
    assert got.columns == ["p_chrom", "p_pos", "p_tag", "s_chrom", "s_pos", "s_end_pos", "s_name"]
    expected = sorted(
        (*p, *s) for p in points for s in spans
        if p[0] and p[0] == s[0] and p[1] is not None and s[1] <= p[1] <= s[2]
    )
    assert sorted(tuple(r) for r in got.collect()) == expected


@pytest.mark.parametrize("lookup,max_rows,hot_rows", PATHS)
def test_spans_in_spans(spark, lookup, max_rows, hot_rows):
    spans, _ = _random(2)
    inner, outer = spans[:250] + spans[-30:], spans
    got = R.span_in_span_join(
        spark.createDataFrame(inner, SPAN), spark.createDataFrame(outer, SPAN).repartition(6),
        lookup=lookup, max_rows=max_rows, hot_rows=hot_rows,
    )
    expected = sorted(
        (*i, *o) for i in inner for o in outer
        if i[0] and i[0] == o[0] and o[1] <= i[1] <= o[2] and i[2] <= o[2]
    )
    assert sorted(tuple(r) for r in got.collect()) == expected


def _binned_pair(spans, points):
    left = R._with_span_bins(spans, "s_chrom", "s_pos", "s_end_pos")
    span_counts = R._bin_counts(left, "test_span_bins")
    right = R._with_point_bins(points, "p_chrom", "p_pos", R._levels_of(span_counts))
    return left, right, span_counts, R._bin_counts(right, "test_point_bins")


@pytest.mark.parametrize("splits", [1, 12])
def test_hot_bin_is_spread(spark, splits, tmp_path):
    """Also in a table of one file, where all rows of a bin come from one split."""
    spark.range(0, 3000, 1, splits).select(
        F.lit("1").alias("s_chrom"), F.lit(10).alias("s_pos"), F.lit(10).alias("s_end_pos")
    ).coalesce(1 if splits == 1 else splits).write.parquet(str(tmp_path / "spans"))
    spans = spark.read.parquet(str(tmp_path / "spans"))
    points = spark.createDataFrame([("1", 10)], "p_chrom string, p_pos int")
    left, right = R._salted(*_binned_pair(spans, points), 500)
    sizes = [r["count"] for r in left.groupBy("__salt_span").count().collect()]
    assert len(sizes) == 6 and max(sizes) <= 600
    copies = right.select("__salt_span").collect()
    assert sorted(r[0] for r in copies) == list(range(6))


def test_points_probe_only_widths_that_occur(spark):
    """No join key holds all points of a contig unless a span of that width exists."""
    spans = spark.createDataFrame([("1", 5, 5), ("1", 100, 130), ("2", 1, 2**30)], "s_chrom string, s_pos int, s_end_pos int")
    points = spark.range(1, 2001).select(F.lit("1").alias("p_chrom"), F.col("id").cast("int").alias("p_pos"))
    _, right, _, _ = _binned_pair(spans, points)
    assert {r["__level"] for r in right.select("__level").distinct().collect()} == {0, 6}
    most = right.groupBy("__chrom", "__level", "__bin").count().agg(F.max("count")).first()[0]
    assert most <= 64


def test_hot_points_are_split(spark):
    spans = spark.createDataFrame([("1", 1, 2**20)], "s_chrom string, s_pos int, s_end_pos int")
    points = spark.range(1, 1001).select(F.lit("1").alias("p_chrom"), F.col("id").cast("int").alias("p_pos"))
    left, right = R._salted(*_binned_pair(spans, points), 100)
    sizes = [r["count"] for r in right.groupBy("__bin", "__salt_point").count().collect()]
    assert len(sizes) == 10 and max(sizes) <= 150
    assert left.where("__bin = 0").count() == 10


def test_a_span_touches_two_bins_at_most(spark):
    rng = random.Random(5)
    spans = []
    for n in range(2000):
        start = rng.randrange(1, 10**9)
        spans.append(("1", start, min(start + rng.randrange(1 << rng.randrange(30)), 2**31 - 1), n))
    binned = R._with_span_bins(spark.createDataFrame(spans, SPAN), "chrom", "pos", "end_pos")
    assert binned.groupBy("name").count().agg(F.max("count")).first()[0] <= 2


def test_interval_columns(spark, rows):
    points = spark.createDataFrame([("1", 5, 0), ("1", 20, 1), ("2", 5, 2)], POINT)
    regions = spark.createDataFrame(
        [("a", "1", 1, 5), ("b", "1", 5, 30)], "gene string, chrom string, region_start int, region_end int"
    )
    got = R.interval_join(points, regions)
    assert rows(got, "pos", "tag", "gene") == [(20, 1, "b"), (5, 0, "a"), (5, 0, "b")]


def test_empty_lookup_side(spark):
    points = spark.createDataFrame([], POINT)
    spans = spark.createDataFrame([("1", 1, 5, 0)], SPAN)
    assert R.point_in_span_join(points, spans).count() == 0


def test_bed_positions(spark, rows):
    bed = spark.createDataFrame(
        [("1", 3, 5), ("1", 4, 6), ("1", 7, 7), ("1", 9, 8)],
        "chrom string, start_pos int, end_plus1 int",
    )
    assert rows(R.bed_positions(bed)) == [("1", 3), ("1", 4), ("1", 4), ("1", 5)]


def test_bed_positions_of_long_intervals(spark):
    bed = spark.createDataFrame([("1", 10, 10 + 3 * R.CHUNK + 7)], "chrom string, start_pos int, end_plus1 int")
    found = R.bed_positions(bed).agg(F.count("pos"), F.min("pos"), F.max("pos"), F.count_distinct("pos")).first()
    n = 3 * R.CHUNK + 7
    assert tuple(found) == (n, 10, n + 9, n)


@pytest.mark.parametrize("contigs", [1, 3, 10, 100])
def test_extent_keeps_every_possible_match(spark, contigs):
    points = spark.createDataFrame([(f"c{n}", 100 * n + 5, n) for n in range(contigs)], POINT)
    extent = measure(points, "chrom", "pos", "pos")
    assert extent.rows == contigs and extent.is_small()
    spans = spark.createDataFrame(
        [(f"c{n}", 100 * n, 100 * n + 9, n) for n in range(120)], SPAN
    )
    kept = {r["name"] for r in extent.near(spans, "chrom", "pos", "end_pos").collect()}
    assert set(range(contigs)) <= kept


def test_rows_behind_a_shuffle_are_stored_before_they_are_dealt(spark, rows):
    """Salts are row numbers, which a task that is run again must give alike."""
    points = spark.range(200).select(F.lit("1").alias("chrom"), (F.col("id") % 50).cast("int").alias("pos")).distinct()
    spans = spark.createDataFrame([("1", 5, 9), ("1", 7, 30)], "chrom string, pos int, end_pos int")
    joined = R.point_in_span_join(points, spans, max_rows=0, hot_rows=1)
    read = "".join(joined.inputFiles())
    assert "range_points" in read and "range_spans" not in read
    assert len(joined.collect()) == 5 + 24
