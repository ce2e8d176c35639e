"""Readers and load rules over small text files."""

import gzip

import pytest
from pyspark.sql import functions as F

from helixframe.functions import fields as V
from helixframe.operators.joins import normalize_contigs
from helixframe.operators.reshape import filled_text, pivot_samples, pivot_text, unpivot_columns, unpivot_samples
from helixframe.plans import loading as L
from helixframe.plans.tables import gvcf_view
from helixframe.registry import texts
from helixframe.sinks import tables as K
from helixframe.sources import dims as D
from helixframe.sources import vcf as S


def _write(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(line.replace(" ", "\t") + "\n" for line in lines))
    return str(path)


FIXED = "#CHROM POS ID REF ALT QUAL FILTER INFO"
MULTI = [
    "##fileformat=VCFv4.2",
    f"{FIXED} FORMAT A B C",
    "1 100 rs1;ss1 C T,G 50 PASS AC=1 GT 0|1 1|2 .|.",
    "X 7 . A G . PASS AC=2 GT 0|1 1 0",
]
MULTI_Y = [f"{FIXED} FORMAT A C", "Y 9 . T C . PASS . GT:DP 1:30 0:12"]


@pytest.fixture
def multi(tmp_path):
    _write(tmp_path / "vcf" / "chr1.vcf", *MULTI)
    _write(tmp_path / "vcf" / "chrY.vcf", *MULTI_Y)
    return str(tmp_path / "vcf")


def test_unpivot_by_layout(spark, multi, rows):
    wide, samples = S.scan_vcf_wide(spark, multi)
    assert wide.columns[-1] == "calls"
    long = unpivot_samples(wide, samples, ["chrom", "pos", "alt"])
    got = rows(long.withColumn("gt", V.gt_only(F.col("call"))), "chrom", "pos", "sample_id", "gt")
    assert got == [
        ("1", 100, "A", "0|1"), ("1", 100, "B", "1|2"), ("1", 100, "C", ".|."),
        ("X", 7, "A", "0|1"), ("X", 7, "B", "1"), ("X", 7, "C", "0"),
        ("Y", 9, "A", "1"), ("Y", 9, "C", "0"),
    ]


def test_unpivot_of_columns_drops_nulls(spark, rows):
    df = spark.createDataFrame([(1, "0|0", None), (2, None, "1|1")], "pos int, A string, B string")
    assert rows(unpivot_columns(df, ["pos"], ["A", "B"])) == [(1, "A", "0|0"), (2, "B", "1|1")]


def test_pivot_keeps_keys_of_unlisted_samples(spark, rows):
    df = spark.createDataFrame(
        [(1, "A", "x"), (1, "A", "y"), (1, "B", "z"), (2, "C", "q")], "pos int, sample_id string, v string"
    )
    got = rows(pivot_samples(df, ["pos"], ["A", "B"], F.col("v")))
    assert got == [(1, "y", "z"), (2, None, None)]


def test_gaps_between_places_are_filled(spark):
    df = spark.sql("select explode(array(array(), array(0, 3), array(1), array(0, 1, 2, 3))) as at")
    cells = F.transform("at", lambda p: F.struct(p.cast("int").alias("place"), F.concat(F.lit("v"), p.cast("string")).alias("__value")))
    got = [r[0].split("\t") for r in df.select(filled_text(cells, F.lit(4), "./.")).collect()]
    none = "./."
    assert got == [[none] * 4, ["v0", none, none, "v3"], [none, "v1", none, none], ["v0", "v1", "v2", "v3"]]
    assert df.select(filled_text(cells, F.lit(0), ".")).first()[0] == ""


def test_pivoted_rows_move_once_and_before_their_text(spark):
    """One shuffle by key and one by order, both of present values: no exchange stands above the text."""
    df = spark.sql("select cast(id div 100 as string) as chrom, id as pos, concat('S', id % 3) as sample_id, id as v from range(9)")
    panel = spark.sql("select concat('S', id) as sample_id from range(4)")
    got = pivot_text(df, ["chrom", "pos"], panel, F.col("v"), order=("chrom", "pos"))
    assert [r["values"] for r in got.collect()][:4] == ["0\t.\t.\t.", ".\t1\t.\t.", ".\t.\t2\t.", "3\t.\t.\t."]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = pivot_text(df, ["chrom", "pos"], panel, F.col("v"), order=("chrom", "pos"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(chrom" in line or "Exchange rangepartitioning" in line]
    assert len(moved) == 2 and "repeat(" in plan.split("rangepartitioning")[0]


def test_headers_and_lookup(spark, multi, rows):
    headers = S.scan_vcf_headers(spark, multi)
    assert rows(headers, "vcfname", "line") == [("chr1", 1), ("chr1", 2), ("chrY", 1)]
    named = S.scan_vcf_headers(spark, multi, name=F.lit("panel"), pattern=r"chrY\.vcf")
    assert rows(named, "vcfname", "line") == [("panel", 1)]
    lookup = S.sample_lookup(S.read_lines(spark, multi)).select(V.file_stem(F.col("filename")), "sample_id")
    assert rows(lookup) == [("chr1", "A"), ("chrY", "A")]


def test_line_numbers_over_splits(spark, tmp_path):
    """A file read in many splits still numbers its lines from 1 without a gap."""
    path = _write(tmp_path / "n" / "long.vcf", "##x", *[f"1 {n} . A C . PASS ." for n in range(2, 4000)])
    _write(tmp_path / "n" / "short.vcf", "##y", "1 2 . A C . PASS .")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = S.scan_vcf_lines(spark, str(tmp_path / "n"))
        assert lines.rdd.getNumPartitions() >= 1
        got = lines.where(F.col("filename").endswith("long.vcf")).select(
            "line", F.split_part("text", F.lit("\t"), F.lit(2)).alias("pos")
        ).collect()
        headers = S.scan_vcf_headers(spark, path).select("line", "text").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(r["line"] for r in got) == list(range(1, 4000))
    assert all(r["pos"] in ("", str(r["line"])) for r in got)
    assert [tuple(r) for r in headers] == [(1, "##x")]


def test_single_sample_rows(spark, tmp_path):
    path = _write(
        tmp_path / "one_sample.vcf", "##fileformat=VCFv4.2", f"{FIXED} FORMAT S1",
        "chr1 10 . A . . PASS AN=2;DB GT:DP 0/0:9",
        "chr2 11 rs2 C T,G 31 q10 AN=2 DP:GT 8:1/2",
        "3 12 rs3 C T 30 PASS . DP 8",
    )
    lines = S.read_lines(spark, path)
    got = [tuple(r) for r in S.parse_vcf_body(lines).drop("filename").orderBy("pos").collect()]
    assert got == [
        ("1", 10, None, "A", None, None, "PASS", "AN=2;DB", "GT:DP", "0/0"),
        ("2", 11, "rs2", "C", ["T", "G"], "31", "q10", None, "DP:GT", "1/2"),
        ("3", 12, "rs3", "C", ["T"], "30", "PASS", None, "DP", None),
    ]
    kept = S.parse_vcf_body(lines, drop_single_key_info=False).orderBy("pos").select("info").collect()
    assert [r[0] for r in kept] == ["AN=2;DB", "AN=2", None]


def test_gvcf_rows(spark, tmp_path):
    _write(
        tmp_path / "g" / "sampleA.g.vcf", "##x", f"{FIXED} FORMAT A",
        "chr1 100 . A <NON_REF> . PASS END=150 GT:DP:GQ 0/0:9:20",
        "chr1 151 rs5 C T,<NON_REF> 30.5 PASS BaseQ=1;MQ=2 GT:GQ:DP 0/1:21:.",
    )
    _write(
        tmp_path / "g" / "sampleB.g.vcf", "chr1 151 . C <NON_REF>,T . LowQ DP=3;END=160 DP:GT:STR_TIMES 7:0/2:1.5",
    )
    rows = gvcf_view(S.scan_gvcf(spark, str(tmp_path / "g"))).orderBy("sample_id", "pos").collect()
    shown = [(r.sample_id, r.pos, r.end_pos, r.id, r.qual, r.info, r.gt, r.dp, r.gq, r.str_times) for r in rows]
    assert shown == [
        ("sampleA", 100, 150, None, None, ".", "0/0", 9, 20, None),
        ("sampleA", 151, 151, "rs5", 31, "BaseQ=1;MQ=2", "0/1", None, 21, None),
        ("sampleB", 151, 160, None, None, "DP=3;END=160", "7", 7, None, 1.5),
    ]
    assert rows[1].alt == ["T", "<NON_REF>"]


def test_bad_file_is_left_out_whole(spark, tmp_path, rows):
    _write(tmp_path / "b" / "good.vcf", "##h", "1 5 . A C . PASS .")
    _write(tmp_path / "b" / "bad.vcf", "##h", "1 6 . A C . PASS .", "1 x7 . A C . PASS .")
    _write(tmp_path / "b" / "short.vcf", "1 8 . A C . PASS .", "1 9 .")
    good, bad = S.skip_bad_files(S.read_lines(spark, str(tmp_path / "b")))
    assert rows(S.parse_sites(good), "pos") == [(5,)]
    assert sorted(r["text"].split("\t")[1] for r in bad.collect()) == ["9", "x7"]


def test_gzip_and_file_choice(spark, tmp_path, rows):
    folder = tmp_path / "z"
    folder.mkdir()
    for name in ("part1", "part2", "other"):
        with gzip.open(folder / f"{name}.vcf.gz", "wt") as f:
            f.write(f"##h\n{name}\t1\t.\tA\tC\t.\tPASS\t.\n")
    sites = S.scan_vcf_sites(spark, str(folder), pattern=r"/part\d")
    assert rows(sites, "chrom") == [("part1",), ("part2",)]
    listed = S.scan_vcf_sites(spark, [str(folder / "other.vcf.gz"), str(folder / "part1.vcf.gz")])
    assert rows(listed, "chrom") == [("other",), ("part1",)]
    spread = S.read_lines(spark, str(folder), partitions=5)
    assert spread.count() == 6


def test_panel_and_bed(spark, tmp_path, rows):
    panel = _write(tmp_path / "panel.tsv", "sample pop super_pop gender", "S1 FIN EUR female")
    assert rows(S.scan_panel(spark, panel)) == [("S1", "FIN", "EUR", "female")]
    bed = _write(tmp_path / "regions.bed", "1 0 10", "2 5 7")
    assert rows(S.scan_bed(spark, bed)) == [("1", 0, 10), ("2", 5, 7)]


def test_contig_aliases(spark, rows):
    assert D.contig_alias_dim(spark).count() == 24
    assert D.contig_aliases("GRCh37")["NC_000024.9"] == "Y"
    assert D.cyp2c19_dim(spark).count() == 43 and D.gene_regions_dim(spark).count() == 5
    sites = spark.createDataFrame([("NC_000023.11", 1), ("7", 2)], "chrom string, pos int")
    got = rows(normalize_contigs(sites, D.contig_alias_dim(spark)))
    assert got == [("7", "7", 2), ("X", "NC_000023.11", 1)]


def test_population_load(spark, multi, tmp_path, rows):
    out = str(tmp_path / "out")
    by_locus, by_sample = L.load_genotypes(spark, multi, out)
    assert rows(by_locus) == rows(by_sample)
    assert rows(by_sample.where("sample_id='B'"), "chrom", "gt", "allele1", "allele2") == [
        ("1", "1|2", "T", "G"), ("X", "1", "G", None)
    ]
    sites = L.load_sites(spark, multi, out)
    assert rows(sites, "chrom", "pos") == [("1", 100), ("X", 7), ("Y", 9)]
    assert sites.schema["chrom"].dataType.simpleString() == "string"


def test_wide_load_leaves_bad_files_out(spark, tmp_path, rows):
    columns = "#CHROM POS ID REF ALT QUAL FILTER INFO FORMAT A B"
    _write(tmp_path / "w" / "good.vcf", columns, "1 5 . A C . PASS . GT 0|1 1|1")
    _write(tmp_path / "w" / "short.vcf", columns, "1 6 . A C . PASS . GT 0|1 1|1", "1 7 . A C . PASS . GT 0|1")
    _write(tmp_path / "w" / "long.vcf", columns, "1 8 . A C . PASS . GT 0|1 1|1 0|0")
    _write(tmp_path / "w" / "pos.vcf", columns, "1 x9 . A C . PASS . GT 0|1 1|1")
    out = str(tmp_path / "out")
    by_locus, by_sample = L.load_genotypes(spark, str(tmp_path / "w"), out)
    assert rows(by_locus, "pos", "sample_id", "gt") == [(5, "A", "0|1"), (5, "B", "1|1")]
    assert rows(by_sample) == rows(by_locus)
    bad = [r["text"].split("\t")[1] for r in L.quarantine(spark, out, "genotypes").collect()]
    assert sorted(bad) == ["7", "8", "x9"]


def test_loads_start_from_the_staged_text(spark, multi, tmp_path, monkeypatch):
    """One scan of the text per load: only the staging reads it."""
    reads = []
    plain = S.read_lines
    monkeypatch.setattr(S, "read_lines", lambda *a, **k: reads.append(1) or plain(*a, **k))
    kept = []
    written = L.K.written
    monkeypatch.setattr(L.K, "written", lambda df, name, path=None: kept.append(name) or written(df, name, path))
    L.load_sites(spark, multi, str(tmp_path / "s"))
    L.load_genotypes(spark, multi, str(tmp_path / "g"))
    assert len(reads) == 2 and kept == ["staging", "quarantine"] * 2


def test_annotation_load_flat(spark, tmp_path):
    path = _write(
        tmp_path / "a.vcf",
        '##INFO=<ID=AF,Number=A,Type=Float,Description="f">', FIXED,
        "NC_000001.11 5 rs1 A C 9 PASS AF=0.25",
    )
    sites = L.load_sites(
        spark, path, str(tmp_path / "o"), aliases=D.contig_alias_dim(spark), flat=True
    )
    row = sites.first()
    assert (row["chrom"], row["orig_chrom"], row["alt_allele"], row["info"]["AF"]) == (
        "1", "NC_000001.11", "C", 0.25
    )


def test_clustered_write(spark, tmp_path):
    df = spark.range(0, 5000, 1, 8).select(
        (F.col("id") % 3).cast("string").alias("chrom"), F.pmod(F.hash("id"), F.lit(1000)).alias("pos"),
        F.lit("A").alias("ref"), F.col("id"),
    )
    path = str(tmp_path / "clustered")
    K.write_clustered(df, path, partitions=4)
    stored = K.read_clustered(spark, path, df.schema)
    assert stored.count() == 5000
    files = stored.groupBy(F.col("_metadata.file_path").alias("f"), "chrom").agg(
        F.min("pos").alias("lo"), F.max("pos").alias("hi")
    )
    pairs = sorted((r["chrom"], r["lo"], r["hi"]) for r in files.collect())
    for a, b in zip(pairs, pairs[1:]):
        assert a[0] != b[0] or a[2] <= b[1]
    plan = stored.where("chrom = '1' and pos between 5 and 9")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(chrom" in plan and "GreaterThanOrEqual(pos,5)" in plan


def test_equal_keys_spread_over_files(spark, tmp_path):
    df = spark.range(0, 4000, 1, 8).select(F.lit("1").alias("chrom"), F.lit(5).alias("pos"), "id")
    path = str(tmp_path / "hot")
    K.write_clustered(df, path, ("chrom", "pos"), partitions=4)
    files = spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).count().collect()
    assert len(files) > 1 and sum(r["count"] for r in files) == 4000


def test_append_and_materialize(spark, tmp_path, rows):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(2, "y")], "k int, b string")
    assert rows(K.append_all([a, b, a])) == [(1, "x", None), (1, "x", None), (2, None, "y")]
    K.materialize(a, "kept_table", str(tmp_path / "m"))
    assert spark.sql("select count(*) from kept_table").first()[0] == 1
    assert rows(K.duplicate_keys(K.append_all([a, b, a]), ["k"])) == [(1, 2)]


def _many_files(spark, folder, samples, **options):
    """A file per sample and shard, of a header and two body lines, as the queries write them."""
    keys = spark.range(samples).select(F.concat(F.lit("S"), "id").alias("sample_id")).crossJoin(
        spark.range(2).select(F.col("id").cast("int").alias("shard"))
    )
    head = F.concat(F.lit("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t"), "sample_id")
    body = [F.concat(F.lit(f"chr1\t{n}\t.\tA\tC\t.\tPASS\t.\tGT\t0/"), F.col("shard").cast("string")) for n in (7, 8)]
    lines = keys.select("*", F.posexplode(F.array(head, *body)).alias("line", "value"))
    texts.write_files(lines, ["sample_id", "shard"], ["line"], str(folder), **options)


def test_slices_of_compressed_packs_hold_every_file_once(spark, tmp_path, rows):
    """The text takes less disk than its lines, and slices change no file."""
    _many_files(spark, tmp_path / "whole", 60)
    _many_files(spark, tmp_path / "sliced", 60, slices=3)
    file = F.regexp_extract("filename", r"(sample_id=[^/]+/shard=\d+)/part\.txt$", 1)
    whole, sliced = (S.scan_vcf_lines(spark, str(tmp_path / n)).select(file, "line", "text") for n in ("whole", "sliced"))
    assert rows(whole) == rows(sliced) and whole.count() == 360
    size = sum(p.stat().st_size for p in (tmp_path / "whole").rglob("part-*"))
    assert size < sum(len(r["text"]) for r in whole.collect())


def test_line_items_are_grouped_once_for_text(spark, monkeypatch):
    """Stored lines name the files: no second shuffle of line items for the headers."""
    lines = texts.gvcf_lines(spark, "/root/testdata/sf0.001")
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "gvcf-lines" in plan and "lineitem" not in plan


def test_many_files_lie_in_few_packs(spark, tmp_path, rows):
    """Files to open follow the tasks that wrote them; every member reads as a file of its own."""
    _many_files(spark, tmp_path / "in", 60)
    assert len(list((tmp_path / "in").rglob("part-*.txt"))) <= 8
    file = F.regexp_extract("filename", r"(sample_id=[^/]+/shard=\d+)/part\.txt$", 1)
    lines = S.scan_vcf_lines(spark, str(tmp_path / "in"))
    assert lines.select("filename").distinct().count() == 120
    got = rows(lines.where(file == "sample_id=S7/shard=1").select("line", F.split_part("text", F.lit("\t"), F.lit(2))))
    assert got == [(1, "POS"), (2, "7"), (3, "8")]
    assert rows(S.scan_vcf_headers(spark, str(tmp_path / "in")).groupBy("line").count()) == [(1, 120)]
    lookup = S.sample_lookup(S.read_lines(spark, str(tmp_path / "in")))
    assert lookup.where(~F.contains(file, F.col("sample_id"))).count() == 0 and lookup.count() == 120
    some = S.select_files(spark, str(tmp_path / "in"), r"sample_id=S5\d/shard=0/")
    assert rows(some.select(file.alias("f")).distinct()) == [(f"sample_id=S5{n}/shard=0",) for n in range(10)]


def test_packs_lie_beside_plain_files(spark, multi, tmp_path, rows):
    """A mark in a plain file is text; a file without a value for its folder keeps a name."""
    plain = tmp_path / "vcf" / "odd.vcf"
    plain.write_text("##a\x1fb\n")
    texts.write_files(spark.sql("select cast(null as string) as k, '##c' as value, 1 as n"), ["k"], ["n"], multi)
    got = rows(S.read_lines(spark, multi, r"odd\.vcf$|k=").select(F.substring_index("filename", "/", -2), "text"))
    assert got == [("k=__HIVE_DEFAULT_PARTITION__/part.txt", "##c"), ("vcf/odd.vcf", "##a\x1fb")]


def test_broadcast_side_is_no_shuffle(spark):
    rows, few = spark.range(100), spark.range(9).select(F.col("id") % 5).toDF("id").distinct()
    assert not K.behind_shuffle(rows.join(F.broadcast(few), "id", "left_anti"))
    assert K.behind_shuffle(rows.groupBy((F.col("id") % 7).alias("id")).count().join(F.broadcast(few), "id"))
