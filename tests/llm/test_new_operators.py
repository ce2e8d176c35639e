"""The manifest, the partition search and the fill-in-middle transformation by themselves."""

import hashlib

import brute
import numpy as np
import pytest
from conftest import prose
from helixframe.llm import fim, merkle, partition_search
from pyspark.sql import functions as F


def _documents(spark, sources):
    rows = [(i, f"text {s} {i}", "en", s, i) for s, n in sources.items() for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)


def test_manifest_over_several_stored_levels(spark):
    """Sources of one to 800 rows: roots equal the plain tree, every proof leads to the root."""
    sources = {None: 3, "": 1, "a": 800, "b": 28, "c": 27, "ä": 82, "Z": 2}
    docs = _documents(spark, sources)
    got = merkle.manifest_proofs(docs).withColumn("folded", merkle.folded(F.col("leaf"))).collect()
    assert len(got) == sum(sources.values()) and all(r["folded"] == r["root"] for r in got)

    def text(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    subroots = {}
    for s, n in sources.items():
        leaves = ["".join(map(text, (i, s, "en", i, f"text {s} {i}"))) for i in range(n)]
        subroots[s] = brute.merkle_root([hashlib.sha256(x.encode()).hexdigest() for x in leaves])
    ordered = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    assert {r["root"] for r in got} == {brute.merkle_root([subroots[s] for s in ordered])}
    assert {r["subroot"] for r in got} == set(subroots.values())


def test_manifest_stores_only_every_third_level(spark):
    sources, top = merkle.build_manifest(_documents(spark, {"a": 800, "b": 5}))
    stored = [sorted((r["members"], len(r["nodes"])) for r in level.collect()) for level in sources.levels]
    assert [len(level) for level in stored] == [30 + 1, 2, 1]
    assert sum(n for _, n in stored[1]) == 30 and stored[2] == [(2, 2)]
    assert len(top.levels) == 1 and all(n <= merkle.SUBTREE for level in stored for _, n in level)


def test_a_change_of_one_row_is_found(spark):
    docs = _documents(spark, {"a": 100, "b": 40})
    spoilt = F.when(F.col("doc_id") == 7, merkle.leaf_digest(text=F.lit("other")))
    got = merkle.manifest_proofs(docs, {"claimed": spoilt})
    checked = got.withColumn("good", merkle.folded(F.coalesce("claimed", "leaf")) == F.col("root"))
    assert sorted(r["doc_id"] for r in checked.where(~F.col("good")).collect()) == [7, 7]


def test_ranks_of_a_hot_group_spread_over_tasks(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("grp"), "id")
    placed = merkle.ranked(rows.repartition(7), "test", "id")
    hot = placed.where("grp = 'hot'").select("id", "at", "members").orderBy("id").collect()
    assert [r["at"] for r in hot] == list(range(2000)) and {r["members"] for r in hot} == {2000}


def _clusters(n, groups=40, dimension=16, seed=5):
    random = np.random.default_rng(seed)
    centres = random.standard_normal((groups, dimension)) * 3
    return [(i, [float(x) for x in centres[i % groups] + random.standard_normal(dimension) * 0.7]) for i in range(n)]


def test_search_probes_few_partitions_of_clustered_vectors(spark):
    rows = _clusters(3000)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    vectors, dimension = partition_search.usable_vectors(table, "vec_id", "embedding")
    sample = partition_search.draw_sample(vectors, dimension, 3000, 2000)
    assert len(sample) == 2000
    model = partition_search.fit(spark, sample, 16)
    assert model.probes <= 6
    got = partition_search.nearest_neighbours(table, part_rows=200).collect()
    wanted = {(i, j) for i, found in brute.nearest(rows) for _, j in found}
    assert len(got) == len(wanted) and len({(r["query_id"], r["vec_id"]) for r in got} & wanted) >= 0.9 * len(wanted)


def test_partitions_are_balanced_and_keep_neighbours(spark):
    vectors = np.array([v for _, v in _clusters(1024)])
    near = partition_search.neighbour_graph(spark, partition_search._directions(vectors))
    part = partition_search.balanced_partitions(near, 16)
    sizes = np.bincount(part, minlength=16)
    assert sizes.min() >= 60 and sizes.max() <= 68
    assert (part[near] == part[:, None]).mean() > 0.7


def test_search_in_blocks_and_among_copies(spark, monkeypatch):
    """Small blocks, a third of all rows one vector, and fewer rows than asked for."""
    monkeypatch.setattr(partition_search, "CANDIDATE_ROWS", 50)
    monkeypatch.setattr(partition_search, "QUERY_ROWS", 3)
    rows = _clusters(400, groups=10) + [(i, [1.0] * 16) for i in range(1000, 1200)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = partition_search.nearest_neighbours(table, target=1.0).collect()
    expected = {(i, rank): s for i, found in brute.nearest(rows) for rank, (s, _) in enumerate(found, 1)}
    right = [expected[(r["query_id"], r["rank"])] == r["score"] for r in got]
    assert len(got) == len(expected) and sum(right) >= 0.9 * len(right)
    few = spark.createDataFrame(rows[:5], "vec_id long, embedding array<double>")
    assert [(r["rank"], r["vec_id"]) for r in partition_search.nearest_neighbours(few).collect()] == [
        (k, j) for k, (_, j) in enumerate(brute.nearest(rows[:5])[0][1], 1)
    ]


@pytest.mark.parametrize("text", ["", " ", "a", "é ü", " a", "a ", "  a \n\n b\t", "x" * 70_000, (prose(3, 900) + "\n") * 40, "日本 " * 9000])
def test_counted_text_cuts_like_its_tokens(text):
    tokens = brute.TOKEN.findall(text)
    if not text:
        return
    cache = fim.ChunkCache(5000)
    counted = fim.Counted(text.encode(), cache)
    assert counted.n == len(tokens) and np.diff(counted.ends, prepend=0).max() <= fim.LONGEST_CHUNK
    for units in {0, 1, len(tokens) // 3, len(tokens) - 1, len(tokens)}:
        before = "".join(tokens[:units])
        assert counted.cut(units) == (len(before.encode()), len(before))
    assert fim.Counted(text.encode(), cache).upto.tolist() == counted.upto.tolist()


def test_shared_passages_share_chunks(monkeypatch):
    passage = prose(9, 4000).encode()
    cache, made = fim.ChunkCache(), []
    plain = fim._summaries
    monkeypatch.setattr(fim, "_summaries", lambda chunks: made.append(sum(map(len, chunks))) or plain(chunks))
    fim.Counted(b"one start " + passage, cache)
    fim.Counted(prose(2, 300).encode() + b"\n" + passage + b" tail", cache)
    assert made[1] < 0.25 * made[0]


def test_parts_of_long_texts_change_nothing(monkeypatch):
    text = (prose(4, 3000) + " ".join("ab")).encode()
    whole = fim.chunk_ends(np.frombuffer(text, np.uint8)).tolist()
    monkeypatch.setattr(fim, "PART_BYTES", 777)
    assert fim.chunk_ends(np.frombuffer(text, np.uint8)).tolist() == whole and len(whole) > 10


def test_fill_in_middle_keeps_columns(spark):
    docs = spark.createDataFrame(
        [(1, "a b c d", 1, "x"), (2, None, 2, "y"), (3, "say <M> twice", 3, None)] + [(i, prose(i, 50), i, "z") for i in range(4, 60)],
        "doc_id long, text string, n long, `odd.name` string",
    )
    names = ("tokens", "form", "p", "m", "out")
    got = fim.fill_in_middle(docs, fim_percent=100, spm_percent=50, names=names)
    assert got.columns == ["doc_id", "text", "n", "odd.name", *names]
    rows = got.withColumn("back", fim.restored(F.col("out"), F.col("form"))).collect()
    assert {r["form"] for r in rows} == {"plain", "psm", "spm"} and len(rows) == 59
    assert all(r["back"] == (r["text"] or "") and r["tokens"] == len(brute.TOKEN.findall(r["text"] or "")) for r in rows)
    assert [r["form"] for r in rows[:3]][1:] == ["plain", "plain"]
