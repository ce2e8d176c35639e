"""Clustered writes, the span layout, Bloom filters, sample sets and cohort maintenance."""

import os
import time

import pytest
from pyspark.sql import functions as F

from helixframe import fixtures
from helixframe.operators import sample_sets as B
from helixframe.operators.intervals import interval_join
from helixframe.plans import maintenance as M
from helixframe.plans.tables import gvcf_view
from helixframe.registry import inputs as src
from helixframe.registry import layouts as Q
from helixframe.sinks import spans as W
from helixframe.sinks import tables as K
from helixframe.sinks import variants as V

SF_DIR = "/root/testdata/sf0.001"


def rows_read(df):
    """Rows that the file scans of a plan without exchanges gave."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(
        leaves.apply(i).metrics().apply("numOutputRows").value()
        for i in range(leaves.size())
        if leaves.apply(i).metrics().contains("numOutputRows")
    )


@pytest.fixture
def small_pages(spark):
    """Row groups and pages of a few thousand rows, as a large table has many."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    sizes = {"parquet.block.size": "65536", "parquet.page.size": "8192", "parquet.page.row.count.limit": "1000"}
    for key, value in sizes.items():
        conf.set(key, value)
    yield
    for key in sizes:
        conf.unset(key)


def test_upstream_is_computed_once(spark, tmp_path):
    """Bounds come from the keys alone: the other columns are made once per row."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def costly(x):
        made.add(1)
        return x

    base = spark.range(60_000).select((F.col("id") % 3).cast("string").alias("chrom"), (F.col("id") * 7919 % 60_000).cast("int").alias("pos"))
    base.write.parquet(str(tmp_path / "base"))
    stored = spark.read.parquet(str(tmp_path / "base"))
    K.write_clustered(stored.withColumn("v", costly("pos")), str(tmp_path / "out"), ("chrom", "pos"), partitions=6)
    assert made.value == 60_000
    got = spark.read.schema("pos int, v int, chrom string").parquet(str(tmp_path / "out"))
    assert got.count() == 60_000 and got.where("v <> pos").count() == 0
    files = got.groupBy(F.input_file_name().alias("f"), "chrom").agg(F.min("pos").alias("a"), F.max("pos").alias("b"), F.count("*").alias("n"))
    spread = sorted((r["chrom"], r["a"], r["b"], r["n"]) for r in files.collect())
    assert all(x[0] != y[0] or x[2] <= y[1] for x, y in zip(spread, spread[1:])) and len(spread) >= 6
    assert max(n for *_, n in spread) < 15_000


def test_clustered_write_takes_nulls_ties_and_arrays(spark, tmp_path, rows):
    df = spark.createDataFrame(
        [(None, 1, None), ("1", None, ["A"]), ("1", 2, ["A", "C"]), ("1", 2, ["A", "C"]), ("X", 3, [])] * 40,
        "chrom string, pos int, alt array<string>",
    )
    K.write_clustered(df, str(tmp_path / "t"), ("chrom", "pos", "alt"), partitions=4)
    assert rows(K.read_clustered(spark, str(tmp_path / "t"), df.schema)) == rows(df)
    K.write_clustered(df.where("pos > 100"), str(tmp_path / "none"), ("chrom", "pos"), partition_by=None)
    assert K.read_clustered(spark, str(tmp_path / "none"), df.schema).count() == 0


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {x for x in files.mkString("\n").split("\n") if "shuffle_" in x and x.endswith(".data")}


@pytest.mark.parametrize("partition_by", ["chrom", None])
def test_a_write_in_passes_gives_the_same_files(spark, tmp_path, monkeypatch, partition_by):
    """No pass shuffles all rows, and every range of files is written once."""
    base = spark.range(6000).select((F.col("id") % 3).cast("string").alias("chrom"), (F.col("id") * 7 % 6000).cast("int").alias("pos"))
    base.write.parquet(str(tmp_path / "base"))
    stored, spread = spark.read.parquet(str(tmp_path / "base")), []
    for most in (100_000, 2000):
        monkeypatch.setattr(K, "ROWS_PER_PASS", most)
        K.write_clustered(stored, str(tmp_path / str(most)), ("chrom", "pos"), partitions=5, partition_by=partition_by)
        got = spark.read.schema("pos int, chrom string").parquet(str(tmp_path / str(most)))
        files = got.groupBy(F.input_file_name().alias("f"), "chrom").agg(F.min("pos"), F.max("pos"), F.count("*"))
        spread.append(sorted(tuple(r)[1:] for r in files.collect()))
    assert spread[0] == spread[1] and sum(r[-1] for r in spread[0]) == 6000


def test_writes_leave_no_shuffle_files(spark, tmp_path):
    """The disk holds the shuffle of one step, not of all steps so far."""
    rows = spark.range(200_000).select((F.col("id") % 7).cast("string").alias("chrom"), F.col("id").cast("int").alias("pos"))
    rows.write.parquet(str(tmp_path / "base"))
    before = _shuffle_files(spark)
    counts = K.written(spark.read.parquet(str(tmp_path / "base")).groupBy("pos").count(), "counts", str(tmp_path / "w"))
    K.write_clustered(counts.withColumn("chrom", F.lit("1")), str(tmp_path / "c"), ("chrom", "pos"), partitions=4)
    until = time.time() + 20
    while (left := _shuffle_files(spark) - before) and sum(os.path.getsize(x) for x in left if os.path.exists(x)) > 100_000 and time.time() < until:
        time.sleep(0.2)
    assert sum(os.path.getsize(x) for x in left if os.path.exists(x)) < 100_000
    assert counts.count() == 200_000


def test_bounds_from_a_smaller_table(spark, tmp_path):
    sites = spark.range(1000).select(F.lit("1").alias("chrom"), F.col("id").cast("int").alias("pos"))
    calls = sites.withColumn("sample_id", F.explode(F.array(*[F.lit(f"S{n}") for n in range(50)])))
    K.write_clustered(calls, str(tmp_path / "c"), ("chrom", "pos"), partitions=8, keys_from=sites, rows_per_key=50)
    got = spark.read.parquet(str(tmp_path / "c")).groupBy(F.input_file_name()).count().collect()
    assert len(got) == 8 and all(5000 <= r["count"] <= 7500 for r in got)


def test_file_count_follows_size(spark):
    df = spark.range(1).select("id", F.lit("x").alias("a"))
    cores = spark.sparkContext.defaultParallelism
    assert [K.file_count(df, n) for n in (0, 100, 10**6, 10**9)] == [1, 1, cores, -(-28 * 10**9 // K.FILE_BYTES)]


def test_format_is_split_once(spark):
    raw = spark.createDataFrame([("A,<NON_REF>", "GT:DP:GQ", "0/1:7:9")], "alt_string string, format string, vals string")
    view = gvcf_view(raw)
    plan = view._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(format") == 1 and plan.count("split(vals") == 1
    row = view.first()
    assert (row["dp"], row["gq"], row["gt"], row["ps"], row["alt"]) == (7, 9, "0/1", None, ["A", "<NON_REF>"])
    few = view.select("dp")._jdf.queryExecution().optimizedPlan().toString()
    assert few.count("split(") == 2 and "split(alt_string" not in few


def test_points_probe_only_widths_that_occur(spark, rows):
    points = spark.range(1, 4001).select(F.lit("1").alias("chrom"), F.col("id").cast("int").alias("pos"))
    regions = spark.createDataFrame([("1", 100, 160, "a"), ("1", 150, 200, "b"), ("2", 1, 60, "c")], "chrom string, region_start int, region_end int, gene string")
    joined = interval_join(points, regions)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate explode") == 1  # the regions' bins; points of one width are not copied
    assert [r["gene"] for r in joined.where("pos = 155").orderBy("gene").collect()] == ["a", "b"]
    assert joined.count() == 61 + 51


@pytest.mark.usefixtures("small_pages")
def test_covering_reads_a_bounded_stretch(spark, tmp_path):
    """Ten times the contig, the same rows read."""
    read = []
    for n in (20_000, 200_000):
        pos = (F.col("id") * 10 + 1).cast("int")
        length = F.when(F.col("id") % 1000 == 0, 5000).when(F.col("id") % 3 == 0, 60).otherwise(1)
        spans = spark.range(n).select(F.lit("1").alias("chrom"), pos.alias("pos"), (pos + length - 1).cast("int").alias("end_pos"))
        path = str(tmp_path / f"s{n}")
        W.write_spans(spans, path, partitions=4)
        loc = n * 10 - 4000
        found = W.spans_covering(spark, path, spans.schema, "1", loc)
        expected = spans.where((F.col("pos") <= loc) & (F.col("end_pos") >= loc))
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect())) and expected.count() > 1
        read.append(rows_read(found))
    assert read[1] <= 2 * read[0] + 4000 and read[1] < 20_000


def test_covering_of_odd_spans(spark, tmp_path, rows):
    spans = spark.createDataFrame(
        [("1", 5, 4), ("1", 5, 5), ("1", 1, 2_000_000_000), ("1", 6, 12), (None, 1, 9), ("2", 1, 9), ("1", 2, 9)],
        "chrom string, pos int, end_pos int",
    )
    W.write_spans(spans, str(tmp_path / "o"))
    found = W.spans_covering(spark, str(tmp_path / "o"), spans.schema, "1", 5)
    assert rows(found) == [("1", 1, 2_000_000_000), ("1", 2, 9), ("1", 5, 5)]
    assert rows(W.spans_covering(spark, str(tmp_path / "o"), spans.schema, "1", 7, 12), "pos") == [(1,), (2,), (6,)]


@pytest.mark.usefixtures("small_pages")
def test_bloom_filter_skips_row_groups(spark, tmp_path):
    """Identifiers in no order of the table: found without reading all of it."""
    rows = spark.range(300_000).select(
        F.lit("1").alias("chrom"), F.col("id").cast("int").alias("pos"), F.sha2(F.col("id").cast("string"), 256).alias("id")
    )
    wanted = [r["id"] for r in rows.where("pos in (77, 150000)").collect()]
    for name, bloom in (("plain", ()), ("bloom", ("id",))):
        K.write_clustered(rows, str(tmp_path / name), ("chrom", "pos"), partitions=2, bloom=bloom)
    plain, bloom = (K.find(spark, str(tmp_path / n), rows.schema, "id", wanted) for n in ("plain", "bloom"))
    assert sorted(r["pos"] for r in bloom.collect()) == [77, 150000]
    assert rows_read(bloom) < 0.2 * rows_read(plain)
    with pytest.raises(ValueError):
        K.find(spark, str(tmp_path / "bloom"), rows.schema, "id", ["x"] * 1001)


def test_sample_sets_count_merge_and_list(spark, rows):
    """Over more than one bucket of places, with unknown samples and repeated rows."""
    panel = spark.range(70_000).select(F.format_string("S%06d", "id").alias("sample_id"))
    places = K.written(B.sample_places(panel), "places")
    carried = spark.createDataFrame(
        [(1, "S000000"), (1, "S000000"), (1, "S069999"), (2, "S032768"), (2, "S000000"), (2, "nobody"), (3, None)],
        "pos int, sample_id string",
    )
    sets = B.sample_sets(B.with_place(carried, places), ["pos"])
    assert rows(B.count_sets(sets, ["pos"])) == [(1, 2), (2, 2)]
    whole = B.merge_sets(sets.withColumn("chrom", F.lit("1")), ["chrom"])
    assert rows(B.count_sets(whole, ["chrom"])) == [("1", 3)]
    assert rows(B.set_members(sets, places), "pos", "sample_id") == [
        (1, "S000000"), (1, "S069999"), (2, "S000000"), (2, "S032768")
    ]
    both = B.common_sets(sets.withColumn("chrom", F.lit("1")), ["chrom"])
    assert rows(B.set_members(both, places), "sample_id") == [("S000000",)]
    more = B.more_places(places, spark.createDataFrame([("A",), ("S000001",)], "sample_id string"))
    assert rows(more.where("place >= 70000")) == [("A", 70_000)]


def test_a_set_takes_room_by_its_members(spark, rows):
    """A few carriers of a large panel make small sets; every bit of a word is used."""
    carried = spark.range(0, 70_000, 997).select((F.col("id") % 7).alias("pos"), F.col("id").alias("place"))
    sets = B.sample_sets(carried.unionByName(spark.range(64).select(F.lit(9).alias("pos"), F.col("id").alias("place"))), ["pos"])
    text = F.octet_length(F.col(B.SET).cast("string"))
    assert sets.agg(F.sum(text)).first()[0] < 20 * 72
    assert rows(B.count_sets(sets.where("pos = 9"), [])) == [(64,)]
    places = spark.range(70_000).select(F.col("id").cast("string").alias("sample_id"), F.col("id").alias("place"))
    held = B.set_members(sets.where("pos < 7"), places)
    assert sorted(int(r["sample_id"]) for r in held.collect()) == list(range(0, 70_000, 997))


def test_no_sample_name_is_shuffled(spark):
    places = B.sample_places(src.panel(spark, SF_DIR))
    counted = B.carriers_by_key(src.genotypes(spark, SF_DIR), K.written(places, "places"), ["chrom"])
    counted.collect()
    plan = counted._jdf.queryExecution().executedPlan().toString()
    exchanges = [x for x in plan.split("\n") if "bitmap" in x and "partial" not in x]
    assert exchanges and "count(distinct" not in plan.lower()


def _counts(df):
    return sorted(tuple(r) for r in df.select("chrom", "pos", "ref", "alt_string", "gt", "cnt").collect())


def test_cohort_updates_equal_a_recount(spark, tmp_path):
    """New alleles, new loci, vanished loci, blocks over new loci, and nothing at all."""
    def spans(*rows):
        df = spark.createDataFrame([("1", *r) for r in rows], "chrom string, pos int, end_pos int, ref string, alt_string string, sample_id string, gt string")
        return df.withColumn("alt", F.split("alt_string", ","))

    first = [(10, 10, "A", "C,<NON_REF>", "a", "0/1"), (20, 40, "N", "<NON_REF>", "a", "0/0"), (50, 50, "G", "T,<NON_REF>", "b", "1/1")]
    second = [(10, 10, "A", "G,<NON_REF>", "c", "0/1"), (30, 30, "C", "T,<NON_REF>", "c", "0/1"), (5, 60, "N", "<NON_REF>", "d", "0/0")]
    state = M.start_cohort(spans(*first), str(tmp_path / "s0"))
    grown = M.update_cohort(state, spans(*first, *second), str(tmp_path / "s1"), added=spans(*second))
    assert _counts(grown.counts) == _counts(M.start_cohort(spans(*first, *second), str(tmp_path / "t1")).counts)
    gone = [r for r in first if r[4] == "b"]
    kept = [r for r in first + second if r[4] != "b"]
    shrunk = M.update_cohort(grown, spans(*kept), str(tmp_path / "s2"), removed=spans(*gone))
    assert _counts(shrunk.counts) == _counts(M.start_cohort(spans(*kept), str(tmp_path / "t2")).counts)
    assert shrunk.loci.where("pos = 50").count() == 0
    assert M.update_cohort(shrunk, spans(*kept), "unused") is shrunk
    again = M.read_cohort(spark, str(tmp_path / "s2"), state)
    assert _counts(again.counts) == _counts(shrunk.counts)


@pytest.mark.parametrize("query", [Q.update_cohort_counts, Q.withdraw_samples])
def test_cohort_steps_read_stored_spans(spark, monkeypatch, query):
    """The spans come out of a shuffle; no step of an update computes them again."""
    class Started(Exception):
        pass

    def start(spans, path):
        raise Started(K.behind_shuffle(spans))

    monkeypatch.setattr(M, "start_cohort", start)
    assert K.behind_shuffle(src.spans(spark, SF_DIR))
    with pytest.raises(Started) as started:
        query(spark, SF_DIR)
    assert started.value.args == (False,)


def test_both_copies_start_from_one_stored_input(spark, tmp_path, monkeypatch):
    kept, written = [], K.written
    monkeypatch.setattr(K, "written", lambda df, name, path=None: kept.append(name) or written(df, name, path))
    calls = spark.range(60).select(
        F.lit("1").alias("chrom"), (F.col("id") % 20).cast("int").alias("pos"), F.lit("A").alias("ref"),
        F.concat(F.lit("S"), F.col("id").cast("string")).alias("sample_id"), F.lit("0|1").alias("gt"),
    )
    by_locus, by_sample = str(tmp_path / "l"), str(tmp_path / "s")
    K.write_genotypes(calls.groupBy(*calls.columns).agg(F.count("*").alias("n")), by_locus, by_sample)
    assert kept == ["clustered-input"]
    assert spark.read.parquet(by_locus).count() == spark.read.parquet(by_sample).count() == 60


def test_a_shredded_path_reads_its_own_column(spark, tmp_path):
    text = F.concat(F.lit('{"AN":'), F.col("id").cast("string"), F.lit(',"AF":[0.5],"LONG":"'), F.repeat(F.sha2(F.col("id").cast("string"), 256), 20), F.lit('"}'))
    rows = spark.range(3000).select(F.lit("1").alias("chrom"), F.col("id").cast("int").alias("pos"), F.parse_json(text).alias("info"))
    V.write_shredded(rows, str(tmp_path / "v"), ("chrom", "pos"), partitions=1)
    stored = V.read_shredded(spark, str(tmp_path / "v"), rows.schema)
    an = stored.select("pos", F.try_variant_get("info", "$.AN", "bigint").alias("an"))
    assert an.where("an = pos").count() == 3000
    plan = an._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema" in plan and "variant" not in plan.split("ReadSchema:")[1].split("\n")[0].lower().replace("try_variant", "")
    long = stored.where("pos = 7").select(F.try_variant_get("info", "$.LONG", "string").alias("x"))
    assert len(long.first()["x"]) == 1280


def test_grouping_calls_holds_a_bounded_number_in_a_task(spark, tmp_path, monkeypatch):
    """Tasks that group line items into calls follow from their number, not from merged shuffle partitions."""
    rows = [(n % 300, n // 300, n, float(n % 50), n % 7 + 1) for n in range(6000)]
    rows += [(None, 1, 1, 1.0, 1), (1, None, 1, 1.0, 1), rows[0]]
    columns = "l_partkey long, l_suppkey long, l_orderkey long, l_quantity double, l_linenumber int"
    spark.createDataFrame(rows, columns).write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(fixtures, "CALLS_PER_TASK", 200)
    calls = fixtures.fixture(spark, str(tmp_path), "calls_fx")
    held = calls.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
    assert held[0] <= 400 and held[1] == 6002
