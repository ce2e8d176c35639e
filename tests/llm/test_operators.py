"""Operators' own interfaces: extra columns, options, pieces that the queries don't show."""

import random

import brute
import numpy as np
import public_tokenizers
import pytest
from conftest import SCHEMAS, edge_documents, edge_tables, prose
from pyspark.sql import functions as F

from helixframe.llm import (
    chat,
    components,
    decontaminate,
    langid,
    mixing,
    ngram_join,
    phrases,
    pii,
    quality,
    shingles,
    suffix_dedup,
    token_output,
    toxicity,
)

CLASHES = (
    "'x' as score", "1 as n_words", "'y' as position", "'z' as kept", "2 as size", "3 as found", "4 as spans",
    "5 as doc", "6 as `key`", "7 as text_key", "8 as `trigger`", "9 as n", "'q' as lang_pred", "10 as target",
    "11 as component_id", "12 as `odd.name`", "13 as candidates", "14 as toxic", "15 as quality", "16 as good",
    "17 as positions", "18 as pass", "19 as items", "20 as n_shingles", "21 as base", "22 as start",
)


@pytest.fixture(scope="module")
def plain(spark):
    return spark.createDataFrame(edge_documents(), SCHEMAS["documents"]).coalesce(2)


@pytest.fixture(scope="module")
def wide(plain):
    return plain.selectExpr("*", *CLASHES)


@pytest.fixture(scope="module")
def tables(spark):
    return {n: spark.createDataFrame(rows, SCHEMAS[n]) for n, rows in edge_tables().items()}


def _rows(df, *columns):
    return sorted(map(repr, (df.select(*columns) if columns else df).collect()))


@pytest.mark.parametrize(
    "name,operator",
    [
        ("suffix_dedup", lambda d, t: suffix_dedup.remove_repeats(d)),
        ("mixing", lambda d, t: mixing.mix_plan(d)),
        ("decontaminate", lambda d, t: decontaminate.digest(decontaminate.find_spans(d, t["benchmark"]))),
        ("toxicity", lambda d, t: toxicity.score_toxicity(d, t["labels"])),
        ("pii", lambda d, t: pii.find_personal_data(d)),
        ("langid", lambda d, t: langid.detect_languages(d)),
        ("ngram_join", lambda d, t: ngram_join.ngram_components(d)),
    ],
)
def test_clashing_columns_change_nothing(plain, wide, tables, name, operator):
    assert _rows(operator(wide, tables)) == _rows(operator(plain, tables))


@pytest.mark.parametrize(
    "operator",
    [
        lambda d, t: mixing.mix(d),
        lambda d, t: decontaminate.decontaminate(d, t["benchmark"]),
        lambda d, t: ngram_join.group_heads(d),
    ],
)
def test_operators_that_keep_all_columns(plain, wide, tables, operator):
    got, bare = operator(wide, tables), operator(plain, tables)
    assert got.columns == wide.columns
    assert _rows(got, *plain.columns) == _rows(bare)


def test_quality_replaces_clashing_columns(plain, wide, tables):
    got = quality.quality_rules(wide, tables["labels"])
    assert got.columns[-len(quality.RESULTS) :] == list(quality.RESULTS)
    kept = [c for c in wide.columns if c not in quality.RESULTS]
    assert got.columns[: len(kept)] == kept
    assert _rows(got, "doc_id", *quality.RESULTS) == _rows(
        quality.quality_rules(plain, tables["labels"]), "doc_id", *quality.RESULTS
    )


def test_token_round_trip(spark, wide, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    token_output.write_tokens(wide, str(tmp_path / "t"), path)
    got = token_output.read_tokens(spark, str(tmp_path / "t"), with_ids=True).collect()
    texts = sorted((r["text"] or "").replace("<|endoftext|>", "") for r in wide.collect())
    tokenizer = Tokenizer.from_file(path)
    assert sorted(tokenizer.decode(r["ids"][:-1]) for r in got) == texts
    assert all(r["ids"][-1] == token_output.END_ID for r in got)
    segments = spark.read.parquet(str(tmp_path / "t/segments"))
    about = spark.read.parquet(str(tmp_path / "t/dictionary")).collect()
    assert {r["dict_hash"] for r in segments.collect()} == {about[0]["hash"]}


def test_plain_pieces_go_to_the_model_and_keep_their_ids(monkeypatch):
    made = token_output.PieceEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    searched = []
    encode = made._encode
    monkeypatch.setattr(made, "_encode", lambda pieces: (searched.extend(pieces), encode(pieces)))
    plain = [
        "Word qwzx, word.\nNext line\nend: 2024 a1b22c \u00e9t\u00e9; na\u00efve!", "", "7", "a,b.c x", "\u0130stanbul \u01c5ep \u024f \u00df?",
        "12345678901234567890 w" + "aeiou" * 40,
    ]
    odd = [
        "don't can't'll x'S", "a\n\nb a.\n c", "e\u0301te\u0301 \u00b2x \u00d7y \u4e2d\u6587 a\u00a0b", "a.,b a..b ,a", "\nstart end\n", "  two  blanks ",
        "a<|endoftext|>b", "x" * 3000, "\u0251a \u0434\u0430", "-a a- a_b 1.5%", "\u0378q",
    ]
    for texts, direct in ((plain, True), (odd, False), (plain + odd, False)):
        for text, raw in zip(texts, made.encode_many(texts)):
            assert np.frombuffer(raw, made.type).tolist() == made._ids(text).tolist(), text
        assert not direct or searched == []


def test_pieces_give_the_ids_of_the_text():
    import public_tokenizers

    encoder = token_output.PieceEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a  b", "x\n\n y", "a\n \nb", " lead", "trail ", "a b  c", "tab\t x", "", "   ", " \n ", "é ü ñ  'll don't I'm",
             "a   b", "end\n", "a\x1c b \x1cc", "x  y  z", "word, word. word,", "<|endoftext|> x", "don't won't, can't."]
    rng = random.Random(3)
    texts += ["".join(rng.choice("ab., \n\té'1") for _ in range(60)) for _ in range(200)]
    for text, raw in zip(texts, encoder.encode_many(texts)):
        assert encoder.tokenizer.encode(text, add_special_tokens=False).ids == np.frombuffer(raw, encoder.type).tolist()


def test_water_filling(spark):
    totals = spark.createDataFrame(
        [("a", 100), ("b", 1000), ("c", 50), ("d", 0), (None, 400)], "source string, source_size long"
    )
    got = {r["source"]: r["target"] for r in mixing.source_targets(totals).collect()}
    assert got["a"] == 200 and got["d"] == 0 and abs(sum(got.values()) - 1.5 * 1550) < 1e-6
    assert all(got[s] <= 2 * n + 1e-9 for s, n in (("a", 100), ("b", 1000), ("c", 50), (None, 400)))


def test_training_order_follows_the_schedule(spark):
    docs = spark.range(400).select(
        F.col("id").alias("doc_id"), F.lit("w " * 10).alias("text"),
        F.when(F.col("id") % 2 == 0, "early").otherwise("late").alias("source"),
    )
    order = [r["source"] for r in mixing.mix(docs, slopes=(-0.9, 0.9)).collect()]
    half = len(order) // 2
    assert order[:half].count("early") > order[half:].count("early")
    assert _rows(mixing.mix(docs)) == _rows(mixing.mix(docs))


def test_decontaminate_cuts_and_drops(spark):
    item = prose(2, 30)
    docs = [(1, "before it " + item + " after it " + prose(9, 40), "e"), (2, item.upper(), "e"), (3, prose(4, 30), "e"), (4, None, "e")]
    df = spark.createDataFrame(docs, "doc_id long, text string, more string")
    got = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(df, spark.createDataFrame([(7, item)], SCHEMAS["benchmark"])).collect()}
    assert got[1] == "before it  after it " + prose(9, 40) and got[3] == docs[2][1] and got[4] is None and 2 not in got


def test_decontaminate_in_shards(spark, plain, tables):
    whole = decontaminate.digest(decontaminate.find_spans(plain, tables["benchmark"]))
    parts = decontaminate.digest(decontaminate.find_spans(plain, tables["benchmark"], shard_words=5))
    assert _rows(whole) == _rows(parts)


def test_decontaminate_cuts_alike_in_shards(spark, plain, wide, tables):
    """Coverage, overlapping spans and words joined by a cut are judged on all shards at once."""
    word = lambda a, b: " ".join(f"w{n}" for n in range(a, b))
    clean = lambda n: " ".join(f"c{n}x{k}" for k in range(40))
    items = [(1, word(0, 20)), (2, word(100, 120)), (3, word(10, 30)), (4, word(200, 205) + " " + word(205, 210))]
    docs = [
        (1, word(0, 12) + " " + word(100, 112) + " " + " ".join(clean(1).split()[:16])),  # 30% hits in each of two shards
        (2, clean(2) + " " + word(0, 30) + " " + clean(3)),  # spans of two shards overlap
        (3, clean(4) + " " + word(200, 205) + " " + word(0, 20) + " " + word(205, 210) + " " + clean(5)),  # joined by a cut
        (None, clean(6) + " " + word(100, 120) + " tail"),
        (None, clean(7)),
    ]
    df = spark.createDataFrame(docs + docs[1:2], "doc_id long, text string")
    bench = spark.createDataFrame(items, SCHEMAS["benchmark"])
    whole = decontaminate.decontaminate(df, bench)
    kept = [r["text"] for r in whole.where("doc_id is not null").orderBy("doc_id").collect()]
    assert kept == [clean(2) + "  " + clean(3)] * 2 + [docs[2][1].replace(word(0, 20), "")]
    assert _rows(decontaminate.decontaminate(df, bench, shard_words=5)) == _rows(whole)
    for some in (plain, wide):
        parts = decontaminate.decontaminate(some, tables["benchmark"], shard_words=5)
        assert parts.columns == some.columns
        assert _rows(parts) == _rows(decontaminate.decontaminate(some, tables["benchmark"]))


def test_automaton_against_brute_force():
    rng = random.Random(11)
    letters = [c.encode() for c in "abc"]
    for _ in range(200):
        items = [(str(n), rng.choices(letters, k=rng.randrange(0, 12))) for n in range(4)]
        text = rng.choices(letters, k=40)
        spans, met = decontaminate.ItemAutomaton(items, 5).scan(text)
        hit = {p for a, b in spans for p in range(a, b)}
        join = lambda w: b" ".join(w).decode()
        expected = brute.contamination({0: join(text)}, {n: join(w) for n, w in items}, 5)[0]
        assert (len(hit), len(met)) == (expected[1], expected[2])


def test_suffix_dedup_paths_agree(spark):
    """Frequent triggers take the shuffled path; both give the brute-force result."""
    rng = random.Random(5)
    line = "".join(rng.choice("abcdefgh ") for _ in range(150))
    docs = {n: "".join(rng.choice("abcdefgh ") for _ in range(90)) + line[: 100 + n % 50] + "".join(rng.choice("xyz") for _ in range(60)) for n in range(40)}
    docs |= {100 + n: docs[n][:200] + "!" + docs[n][200:] for n in range(0, 40, 3)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(5)
    expected = sorted((i, *r) for i, r in brute.repeats(docs).items())
    for most in (1, 4096):
        assert sorted(map(tuple, suffix_dedup.remove_repeats(df, group_phrases=most).collect())) == expected


@pytest.mark.parametrize("most", [1, 4096])
def test_suffix_dedup_of_repeated_rows(spark, most):
    """A repeated row that holds a passage first keeps it; the passage's edges differ elsewhere."""
    rng = random.Random(6)
    some = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passages = [some(220) for _ in range(6)]
    docs = {n: some(90) + p + some(90) for n, p in enumerate(passages)}
    docs |= {100 + n: some(70) + passages[n % 6] + some(80) for n in range(18)}
    rows = [r for i, t in docs.items() for r in [(i, t)] * (3 if i < 6 or i == 100 else 1)]
    expected = brute.repeats(docs)
    assert not any(expected[n][1] for n in range(6))
    for parts in (1, 4):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        got = suffix_dedup.remove_repeats(df, group_phrases=most).collect()
        assert sorted(map(tuple, got)) == sorted((i, *expected[i]) for i, _ in rows)


@pytest.mark.parametrize("most", [1, 4096])
def test_suffix_dedup_tells_texts_of_one_id_apart(spark, most):
    """Texts without an id, and texts of one id, whose hashes agree in their low 15 bits."""
    rng = random.Random(7)
    some = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    texts = [some(400 if n % 2 else 180) for n in range(1500)]
    keys = spark.createDataFrame([(t,) for t in texts], "text string").select("text", F.expr("pmod(xxhash64(text), 32768)")).collect()
    alike = {}
    for text, key in keys:
        alike.setdefault(key, []).append(text)
    pairs = [sorted(p, key=len, reverse=True)[:2] for p in alike.values() if len({len(t) for t in p}) > 1][:6]
    assert len(pairs) == 6
    rows, expected = [], []
    for n, (copied, clean) in enumerate(pairs):
        late = None if n % 2 else 1000
        first = some(50) + copied[:390] + some(50)
        for i, text, removed in ((n, first, 0), (late, copied, 390), (late, clean, 0)):
            rows.append((i, text))
            expected.append((i, text[removed:]))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = suffix_dedup.remove_repeats(df, with_text=True, group_phrases=most).collect()
    assert sorted(repr((r["doc_id"], r["kept"])) for r in got) == sorted(map(repr, expected))


def test_phrases_are_cut_alike(monkeypatch):
    """Pieces of a long text give the same windows as the whole."""
    rng = random.Random(2)
    text = bytes(rng.choice(b"abcd") for _ in range(5000))
    whole = [int(w) for p in phrases.phrases_of(text) for w in p.windows]
    monkeypatch.setattr(phrases, "PIECE", 700)
    cut = [(int(s), int(w)) for p in phrases.phrases_of(text) for s, w in zip(p.start, p.windows)]
    assert sum(whole) == sum(w for _, w in cut) == len(text) - phrases.WIDTH + 1
    assert all(s + w == t for (s, w), (t, _) in zip(cut, cut[1:]))


@pytest.mark.parametrize("short_list,block", [(64, 512), (2, 3)])
def test_ngram_join_of_large_groups(spark, monkeypatch, short_list, block):
    """Long lists, split clusters and chains of links give the same components."""
    monkeypatch.setattr(ngram_join, "SHORT_LIST", short_list)
    monkeypatch.setattr(ngram_join, "BLOCK_DOCS", block)
    rng = random.Random(8)
    base = prose(3, 80).split()
    docs = {}
    for n in range(60):
        words = list(base)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(80)] = f"edit{rng.randrange(1000)}"
        docs[n] = " ".join(words)
    docs |= {100 + n: prose(20 + n, 30) for n in range(10)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(4)
    expected = sorted((i, *r) for i, r in brute.near_copies(docs).items())
    assert sorted(map(tuple, ngram_join.ngram_components(df).collect())) == expected


def test_counts_of_sets_bound_their_overlap():
    """No linked pair is parted; unlike long sets are, which fixed ranges could not tell apart."""
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (20_000, 20_000, 20_100, 90, 100, 17_000)]
    near = np.unique(np.concatenate([sets[0][:19_000], rng.integers(0, 2**63, 700).astype(np.uint64)]))
    sets = sorted([*sets, near, sets[3]], key=len)
    sizes, packed = np.array([len(x) for x in sets]), [ngram_join._bin_counts(x) for x in sets]
    label = ngram_join.sketch_groups(sizes, packed)
    for i, j in ngram_join.linked_pairs(sets):
        assert label[i] == label[j]
    assert len(set(label[sizes > 1000])) == 4
    wide = np.full(1000, 7, np.uint64)
    assert ngram_join._bins_of(ngram_join._bin_counts(wide)).sum() == 1000


def test_texts_of_a_large_cluster_are_sent_few_times(spark, monkeypatch):
    """Blocks of one near-copy group: text rows that meet grow with the group, not with its square."""
    monkeypatch.setattr(ngram_join, "BLOCK_DOCS", 5)
    met, decided = [], ngram_join._decided_links

    def counting(units, percent):
        met.append(units.count())
        return decided(units, percent)

    monkeypatch.setattr(ngram_join, "_decided_links", counting)
    rng, base = random.Random(4), prose(3, 120).split()
    docs = {n: " ".join(w if rng.random() > 0.01 else f"edit{n}" for w in base) for n in range(80)}
    docs |= {100 + n: " ".join(base[:-30] + [f"tail{n}x{k}" for k in range(30)]) for n in range(3)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    expected = sorted((i, *r) for i, r in brute.near_copies(docs).items())
    assert sorted(map(tuple, ngram_join.ngram_components(df).collect())) == expected
    assert sum(met) < 6 * len(docs)


def test_shingle_sets_of_long_and_joined_texts(monkeypatch):
    texts = [prose(1, 300), "", None, "one", "A b\tC\nd e", prose(2, 50)]
    whole = list(shingles.shingle_sets(texts))
    assert [len(s) for s in whole] == [len(brute.shingles(t)) for t in texts]
    monkeypatch.setattr(shingles, "PIECE_BYTES", 40)
    assert all((a == b).all() for a, b in zip(whole, shingles.shingle_sets(texts)))


def test_components_of_chains_and_stars(spark):
    edges = [(n, n + 1) for n in range(0, 40)] + [(100, n) for n in range(101, 160)] + [(7, 7), (None, 3), (500, 400)]
    got = components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
    expected = {n: 0 for n in range(41)} | {n: 100 for n in range(100, 160)} | {400: 400, 500: 400}
    assert {r["node"]: r["component"] for r in got} == expected and len(got) == len(expected)


def test_language_counts_in_pieces(monkeypatch):
    text = prose(4, 400) + " éà ñ"
    codes, counts = langid.count_grams(text)
    for size in (1, 2, 3, 1000, len(text) + 1, len(text) + 2):
        monkeypatch.setattr(langid, "PIECE_CHARS", size)
        again, n = langid.count_grams(text)
        assert again.tolist() == codes.tolist() and n.tolist() == counts.tolist()


def test_a_text_beyond_one_piece_counts_like_a_short_one():
    text = prose(4, 30) + " "
    times = langid.PIECE_CHARS // len(text) + 2
    codes, counts = langid.count_grams(text * times)
    one, n = langid.count_grams(text)
    assert len(text) * times > langid.PIECE_CHARS and codes.tolist() == one.tolist()
    assert np.abs(counts - n * times).max() <= times  # two edges become one blank


def test_a_language_of_few_repeated_ids_is_learnt(spark):
    """10,000 rows of three ids: counted by ids, each id enters once."""
    texts = {"xx": "zzyx qwvk zzyx vkq ", "en": "the house of the river ", "de": "das haus und der fluss "}
    rows = [(n % 3 if lang == "xx" else 100 * k + n % 97, text * 5, lang) for k, (lang, text) in enumerate(texts.items()) for n in range(10_000 if lang == "xx" else 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles = langid.fit_profiles(docs)
    assert profiles.names == ["de", "en", "xx"] and profiles.nearest(texts["xx"])[0] == "xx"


def test_exceptions_are_not_cut(spark, monkeypatch):
    """Thousands of exception phrases of an early term; a late one keeps its own."""
    monkeypatch.setattr(toxicity, "MIN_WEIGHT", -9.0)
    bad = [(n, f"c{n}x zorgle", 1) for n in range(0, 400)]
    words = ["".join(chr(97 + (n // 26**k) % 26) for k in range(3)) for n in range(2600)]
    good = [(1000 + n, " ".join(f"{w} arble" for w in words[50 * n : 50 * n + 50]), 0) for n in range(52)]
    good += [(2000, "mild zorgle", 0)] + [(3000 + n, f"d{n}x arble", 1) for n in range(6000)]
    sample = spark.createDataFrame([(t, y) for _, t, y in bad + good], "text string, toxic int")
    lexicon, exceptions = toxicity.fit_lexicon(sample)
    assert {"zorgle", "arble"} <= set(lexicon) and len(exceptions) > 2000 and "mild zorgle" in exceptions


def test_contexts_are_shuffled_once(spark, monkeypatch):
    """Totals and choice read stored counts; exceptions meet again for chosen terms alone."""
    monkeypatch.setattr(toxicity, "MIN_WEIGHT", -9.0)
    kept, written = [], toxicity.written
    monkeypatch.setattr(toxicity, "written", lambda df, name: kept.append(name) or written(df, name))
    rows = [(f"c{n}x zorgle", 1) for n in range(60)] + [(f"{w} fine", 0) for w in ("a", "b", "c")] + [("mild zorgle", 0)]
    lexicon, exceptions = toxicity.fit_lexicon(spark.createDataFrame(rows, "text string, toxic int"))
    assert kept == ["toxicity-terms", "toxicity-counts"]
    assert list(lexicon) == ["zorgle"] and exceptions == ["mild zorgle"]


@pytest.mark.parametrize(
    "text,expected",
    [("Sсum", "scum"), ("1di0t!", "idiot "), ("l-o", "l-o"), ("pa$$ed b@d$$$ me", "passed bad  me"), (None, ""), ("a​b", "ab")],
)
def test_folding(text, expected):
    assert toxicity.fold(text) == expected


def test_exception_phrases_spare_matches():
    machine = toxicity.matcher({"clown": 3.0}, ["circus clown"])
    assert toxicity.matches(machine, "a circus clown and a clown, clownish") == [(21, 26, 3.0)]
    assert toxicity.strength(machine, "") == 0 and toxicity.strength(None, "clown") == 0


def test_loose_spans_are_judged(spark):
    texts = [f"please call phone 499-555-{n:04d} today and mail j{n}@corp.example.com" for n in range(40)]
    texts += [f"phone +1 (499) 555-{n:04d} and tel 499 555 {n:04d}" for n in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = pii.find_personal_data(df).collect()
    for r in got:
        assert set(brute.personal_data(texts[r["doc_id"]]).split(",")) <= set(r["spans"].split(","))


def test_chat_parts(spark):
    rows = [
        (1, 0, "user", [("text", "look <|image_1|> | ", None, None, None, None, None), ("image", None, "i.png", 57, 28, None, None)]),
        (1, 1, "assistant", [("text", "a\\p", None, None, None, None, None), ("audio", None, "a.wav", None, None, 2.0, None),
                             ("document", None, "d.pdf", None, None, None, 3), ("odd", "kept", None, None, None, None, None)]),
        (2, 0, "assistant", None),
    ]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART_TYPE}>")
    first, second, empty = chat.format_messages(df).orderBy("conv_id", "turn").collect()
    assert first["segment"] == "<|im_start|>user\nlook <\\pimage_1\\p> \\p <|image_1|><|im_end|>\n"
    assert [tuple(a) for a in first["attachments"]] == [("<|image_1|>", "i.png", 3)]
    assert [tuple(a) for a in second["attachments"]] == [("<|audio_1|>", "a.wav", 25), ("<|document_2|>", "d.pdf", 768)]
    assert chat.read_segment(second["segment"]) == ("assistant", "a\\p<|audio_1|><|document_2|>kept")
    assert empty["loss_length"] == 0 and first["loss_length"] == 0 and second["loss_length"] > 0


@pytest.mark.parametrize("text", ["", "|", "\\", "\\p", "<|im_end|>\n", "\\\\|\\n", "a|b\\|c\n"])
def test_escaping_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text and chat.unescape(chat.escape_role(text)) == text
    assert "|" not in chat.escape(text)


def test_token_files_give_one_document_and_know_their_dictionary(spark, tmp_path, monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = spark.createDataFrame([(i, prose(i, 30)) for i in range(300)] + [(7, "again"), (None, "none")], "doc_id long, text string")
    monkeypatch.setattr(token_output, "SEGMENT_IDS", 2000)
    token_output.write_tokens(docs, str(tmp_path / "a"), path)
    ids = lambda text: [*token_output.encoder(path).tokenizer.encode(text, add_special_tokens=False).ids, 0]
    assert token_output.read_document(spark, str(tmp_path / "a"), 123) == [ids(prose(123, 30))]
    assert sorted(token_output.read_document(spark, str(tmp_path / "a"), 7)) == sorted([ids(prose(7, 30)), ids("again")])
    assert token_output.read_document(spark, str(tmp_path / "a"), 999) == []
    about = spark.read.parquet(str(tmp_path / "a" / "dictionary")).withColumn("content", F.lit(b"other"))
    about.write.parquet(str(tmp_path / "b" / "dictionary"))
    spark.read.parquet(str(tmp_path / "a" / "segments")).write.parquet(str(tmp_path / "b" / "segments"))
    with pytest.raises(Exception, match="another dictionary"):
        token_output.read_tokens(spark, str(tmp_path / "b")).collect()


def test_token_cache_is_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr(token_output, "CACHE_BYTES", 20_000)
    made = token_output.PieceEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [prose(i, 40) + " " + "\u4e2d" * 3000 + "x" * i + "." for i in range(60)]
    assert [np.frombuffer(made.encode_many([t])[0], made.type).tolist() for t in texts] == [made._ids(t).tolist() for t in texts]
    assert made.size < 30_000 and max(map(len, made.known)) <= token_output.LONG_PIECE


def test_rows_of_one_id_spread_over_token_files(spark, tmp_path):
    """No id at all: ranges of the texts' beginnings part them, in their order."""
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")
    docs = spark.createDataFrame([(None, prose(i, 8)) for i in range(400)], "doc_id long, text string")
    token_output.write_tokens(docs, str(tmp_path / "n"), public_tokenizers.path("byte_bpe_50k.json"))
    spark.conf.unset(merging)
    got = token_output.read_tokens(spark, str(tmp_path / "n"), with_ids=True).orderBy("start").collect()
    shards = spark.read.parquet(str(tmp_path / "n" / "segments")).select("shard").distinct().count()
    tokenizer = token_output.encoder(public_tokenizers.path("byte_bpe_50k.json")).tokenizer
    assert shards > 1 and [tokenizer.decode(r["ids"][:-1]) for r in got] == sorted(prose(i, 8) for i in range(400))


def test_word_order_changes_the_quality_score(spark):
    good = [(i, prose(i, 60)) for i in range(60)]
    shuffled = []
    for i, text in good[:20]:
        words = text.split()
        random.Random(i).shuffle(words)
        shuffled.append((1000 + i, " ".join(words)))
    docs = spark.createDataFrame(good + shuffled, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i, _ in good], "doc_id long, quality int")
    sample = quality.labelled_sample(labels)
    ratios = quality.fit_ratios(docs, sample)
    score = {r["doc_id"]: r["score_millionths"] for r in quality.document_scores(docs, ratios).collect()}
    counted = {r["doc_id"] for r in sample.collect() if r["counted"]} & set(range(20))
    assert len(counted) > 3 and all(score[i] > score[1000 + i] for i in counted)


def test_candidates_of_a_text_with_many_hits(spark):
    """Positions, contexts and overlaps over several blocks and stretches, and in an empty text."""
    text = " ".join(f"é10.1.{i % 256}.{i % 99} call 555-{100 + i % 900}-{1000 + i} 1.2.3.4 x" for i in range(700))
    text += " 10.0.0.1-555-123-4567 +1 555-123-4567"
    docs = spark.createDataFrame([(1, text), (2, ""), (3, None)], "doc_id long, text string")
    rows = {r["doc_id"]: r["candidates"] for r in pii.find_candidates(docs).collect()}
    assert rows[2] == [] and rows[3] == []
    base = sorted((c["kind"], c["start"], c["end"]) for c in rows[1] if c["base"])
    names = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in base)
    assert names == brute.personal_data(text) and len(base) > 1400
    loose = [c for c in rows[1] if not c["base"]]
    assert len(loose) >= 700 and not any(c["start"] < e and s < c["end"] for c in loose for _, s, e in base)
    for c in rows[1]:
        assert c["hit"] == text[c["start"] : c["end"]] and c["after"] == text[c["end"] : c["end"] + 1]
        assert c["before"] == text[max(0, c["start"] - pii.CONTEXT) : c["start"]]


def test_quality_takes_every_label(spark):
    labels = spark.range(25_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    assert quality.labelled_sample(labels).count() == 25_000


def test_quality_is_alike_beyond_the_broadcast_bound(spark, monkeypatch):
    good = [(i, prose(i, 30)) for i in range(60)]
    bad = [(100 + i, f"zzz qqq {i} " * 10) for i in range(60)] + [(3, "a second text of one id"), (None, "no id"), (5, None)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _ in good + bad if i is not None], "doc_id long, quality int")
    sample = quality.labelled_sample(labels)
    ratios = quality.fit_ratios(docs, sample)
    threshold = quality.fit_threshold(docs, sample, ratios)
    monkeypatch.setattr(quality, "broadcast_if_small", lambda df: (df, False))
    monkeypatch.setattr(quality, "small", lambda df: df)
    assert any(ratios) and threshold is not None and quality.fit_ratios(docs, sample) == ratios
    assert quality.fit_threshold(docs, sample, ratios) == threshold
