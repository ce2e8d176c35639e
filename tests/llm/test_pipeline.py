"""The pipeline's stages, each judged on its own input, against brute force."""

from collections import Counter

import brute
import corpus_pipeline as pipeline
import pytest

from helixframe.llm.common import written

STAGES = dict(pipeline.STAGES)


@pytest.fixture(scope="module", params=["sf_dir", "edge_dir"])
def steps(spark, request):
    """Folder and, per stage, its input and its stored result."""
    folder = request.getfixturevalue(request.param)
    docs, found = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in pipeline.STAGES:
        result = written(stage(spark, docs, folder), f"test-{name}")
        found[name] = (docs, result)
        docs = result
    return folder, found


def _rows(df):
    return [tuple(r) for r in df.select(*pipeline.COLUMNS).collect()]


def test_stages_keep_the_columns(steps):
    _, found = steps
    for name in list(STAGES)[:-1]:
        assert found[name][1].columns == list(pipeline.COLUMNS)


def test_language_rejects_only_texts_without_letters(steps):
    before, after = steps[1]["language_id"]
    spoken = Counter((r[0], r[1]) for r in _rows(before) if any(c.isalpha() for c in r[1] or ""))
    assert Counter((r[0], r[1]) for r in _rows(after)) == spoken


def test_one_of_each_group_stays(steps):
    before, after = steps[1]["ngram_join"]
    rows = _rows(before)
    groups = brute.near_copies({r[0]: r[1] for r in rows if r[0] is not None})
    heads = {i for i, (n, root) in groups.items() if i == root}
    kept = [r[0] for r in _rows(after)]
    assert Counter(i for i in kept if i is not None) == Counter(heads)
    assert kept.count(None) == sum(r[0] is None for r in rows)


def test_no_benchmark_window_is_left(spark, steps):
    folder, found = steps
    before, after = found["decontamination"]
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    hit = brute.contamination({r[0]: r[1] for r in _rows(before)}, items)
    kept = {r[0]: r[1] for r in _rows(after)}
    for i, text, *_ in _rows(before):
        if not hit[i][1]:
            assert kept[i] == text
        elif 2 * hit[i][1] > hit[i][0]:
            assert i not in kept
        else:
            assert len(kept[i]) < len(text)


def test_mix_takes_each_source_to_its_target(steps):
    before, after = steps[1]["mixing"]
    taken = Counter(r[0] for r in _rows(after))
    assert max(taken.values()) <= 2 and set(taken) <= {r[0] for r in _rows(before)}
    words = lambda rows: sum(len(brute.WORD.findall(r[1] or "")) for r in rows)
    largest = max(len(brute.WORD.findall(r[1] or "")) for r in _rows(before))
    sources = len({r[3] for r in _rows(before)})
    assert abs(words(_rows(after)) - 1.5 * words(_rows(before))) <= sources * largest


def test_token_files_hold_the_mix(steps):
    before, after = steps[1]["token_output"]
    assert Counter(r["doc_id"] for r in after.collect()) == Counter(r[0] for r in _rows(before))


def test_run_gives_the_last_stage(spark, steps):
    folder, found = steps
    got = pipeline.run(spark, folder)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, found["token_output"][1].collect()))


def test_empty_tables(spark, empty_dir):
    assert pipeline.run(spark, empty_dir).count() == 0
