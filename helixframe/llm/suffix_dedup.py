"""Removal of repeated 100-byte strings by prefix-free parsing.

The text is parsed into prefix-free phrases at rolling-hash triggers (``phrases``). Equal
100-byte strings lie at equal places of phrases with one trigger, so the order of the
dictionary's suffixes is needed only within a trigger and only up to 100 bytes, and the parse
orders equal suffixes by where they stand in the corpus:

1. Parse. Each phrase is a row (trigger, content, document, start, text key); rows of one content are
   combined per batch before they are shuffled, so a passage that stands in a third of all
   documents arrives once per batch.
2. Dictionary. Rows sorted by (trigger, content, document, start) are streamed: every phrase
   but the first of a content repeats all its strings. Triggers with one content are done.
3. Suffixes. Contents that share a trigger are ambiguous: their 100-byte suffix prefixes are
   sorted together with their corpus positions, and all but the first of each are repeats.
   Triggers with up to ``GROUP_PHRASES`` contents are sorted in memory, several at a time;
   for more, every suffix prefix is a row of its own (hashed, combined per batch, shuffled).
4. Repeats are collected per document, merged into spans, and cut out of its bytes.

Strings are compared by two 64-bit hashes (trigger and content, or two rolling hashes).

Null text is an empty text. A null id comes last in the corpus; repeated rows (equal id and
text) are one document and each row gets that document's result; rows that share an id (or
have none) but not the text are told apart by a 64-bit hash of the text and are ordered by
start, then by that hash. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import own_columns, written
from helixframe.llm.phrases import WIDTH, phrases_of, window_hashes

GROUP_PHRASES = 4096
LAST_ID = (1 << 63) - 1
# A place packs start, windows and a flag into one ascending long.
_WINDOW_BITS = 16
_MOST_WINDOWS = (1 << _WINDOW_BITS) - 1


def _packed(start: np.ndarray, windows: np.ndarray, repeat: int | np.ndarray) -> np.ndarray:
    return (start.astype(np.int64) << (_WINDOW_BITS + 1)) | (windows << 1) | repeat


def _unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return place >> (_WINDOW_BITS + 1), (place >> 1) & _MOST_WINDOWS, place & 1


def _batch(names: str, *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names.split())


def _repeats_first(keys: tuple, doc: np.ndarray, place: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by keys, document, place and text key, and which rows of that order repeat the keys before."""
    order = np.lexsort((key, place, doc, *reversed(keys)))
    repeat = np.zeros(len(order), bool)
    if len(order):
        repeat[1:] = np.logical_and.reduce([k[order][1:] == k[order][:-1] for k in keys])
    return order, repeat


def _runs(doc: np.ndarray, key: np.ndarray, start: np.ndarray, windows: np.ndarray) -> tuple:
    """Adjoining stretches of windows of one text joined, no longer than a place can hold."""
    order = np.lexsort((start, key, doc))
    doc, key, start, windows = doc[order], key[order], start[order], windows[order]
    end = start + windows
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1]) | (start[1:] != end[:-1]) | (start[1:] // 32768 != start[:-1] // 32768)
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(doc)]]) - 1
    return doc[first], key[first], start[first], end[last] - start[first]


_PHRASE_NAMES = "trigger content doc place key"


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phrases of each text; within a batch only the first of a content goes on as a phrase."""
    for batch in batches:
        triggers, contents, docs, places, text_keys = [], [], [], [], []
        for doc, key, text in zip(batch.column("doc").to_pylist(), batch.column("key").to_pylist(), batch.column("text")):
            for found in phrases_of(text.as_py()):
                triggers.append(found.trigger)
                contents.append(found.content)
                docs.append(np.full(len(found.start), doc, np.int64))
                places.append(_packed(found.start, found.windows, 0))
                text_keys.append(np.full(len(found.start), key, np.int64))
        if not triggers:
            continue
        trigger, content = np.concatenate(triggers).view(np.int64), np.concatenate(contents).view(np.int64)
        doc, place, key = np.concatenate(docs), np.concatenate(places), np.concatenate(text_keys)
        order, repeat = _repeats_first((trigger, content), doc, place, key)
        # Repeated rows of the input give equal places; they are the same phrase, no repeat.
        d, p, k = doc[order], place[order], key[order]
        same = np.zeros(len(order), bool)
        same[1:] = repeat[1:] & (d[1:] == d[:-1]) & (p[1:] == p[:-1]) & (k[1:] == k[:-1])
        first, again = order[~repeat], order[repeat & ~same]
        yield _batch(_PHRASE_NAMES, trigger[first], content[first], doc[first], place[first], key[first])
        if len(again):
            start, windows, _ = _unpacked(place[again])
            d, k, s, w = _runs(doc[again], key[again], start, windows)
            # Settled rows travel along, spread by their document.
            yield _batch(_PHRASE_NAMES, d * np.int64(0x9E3779B97F4A7C1) + s, np.zeros(len(d), np.int64), d, _packed(s, w, 1), k)


_SETTLED = "doc long, key long, start int, windows int, trigger long"


def _settled(doc, key, start, windows, trigger=None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(doc),
            pa.array(key),
            pa.array(start.astype(np.int32)),
            pa.array(windows.astype(np.int32)),
            pa.nulls(len(doc), pa.int64()) if trigger is None else pa.array(trigger),
        ],
        names=["doc", "key", "start", "windows", "trigger"],
    )


def _dictionary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams phrases ordered by (trigger, content, doc, place, key).

    Gives repeats (no trigger) and the first phrases of ambiguous contents (with trigger).
    """
    last = (None, None, None, None, None)  # trigger, content, document, place and text key of the row before
    held, held_known = None, False  # last first phrase, and whether it is known as ambiguous
    for batch in batches:
        trigger, content, doc, place, key = (batch.column(c).to_numpy() for c in _PHRASE_NAMES.split())
        start, windows, settled = _unpacked(place)
        done = settled == 1
        if done.any():
            yield _settled(doc[done], key[done], start[done], windows[done])
        open_ = ~done
        trigger, content, doc, place = trigger[open_], content[open_], doc[open_], place[open_]
        start, windows, key = start[open_], windows[open_], key[open_]
        if not len(trigger):
            continue
        repeat = np.zeros(len(trigger), bool)
        repeat[1:] = (trigger[1:] == trigger[:-1]) & (content[1:] == content[:-1])
        repeat[0] = (trigger[0], content[0]) == last[:2]
        same = np.zeros(len(trigger), bool)
        same[1:] = repeat[1:] & (doc[1:] == doc[:-1]) & (place[1:] == place[:-1]) & (key[1:] == key[:-1])
        same[0] = repeat[0] and (doc[0], place[0], key[0]) == last[2:]
        last = (trigger[-1], content[-1], doc[-1], place[-1], key[-1])
        again = repeat & ~same
        if again.any():
            yield _settled(doc[again], key[again], start[again], windows[again])
        rows = [a[~repeat] for a in (trigger, doc, key, start, windows)]
        if not len(rows[0]):
            continue
        if held is not None:
            rows = [np.concatenate([[h], r]) for h, r in zip(held, rows)]
        t = rows[0]
        ambiguous = np.zeros(len(t), bool)
        ambiguous[1:] |= t[1:] == t[:-1]
        ambiguous[:-1] |= t[1:] == t[:-1]
        ambiguous[0] |= held_known
        held, held_known = [r[-1] for r in rows], bool(ambiguous[-1])
        chosen = ambiguous.copy()
        chosen[-1] = False
        if chosen.any():
            t, d, k, s, w = (r[chosen] for r in rows)
            yield _settled(d, k, s, w, t)
    if held is not None and held_known:
        t, d, k, s, w = (np.array([h], np.int64) for h in held)
        yield _settled(d, k, s, w, t)


_SUFFIXES = "trigger long, other long, doc long, place long, key long, content binary"


def _spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ambiguous phrases with their bytes, or their single windows where the trigger is frequent."""

    def rows(trigger, other, doc, place, key, content=None) -> pa.RecordBatch:
        filled = pa.nulls(len(doc), pa.binary()) if content is None else pa.array(content, pa.binary())
        return pa.RecordBatch.from_arrays(
            [*[pa.array(c, pa.int64()) for c in (trigger, other, doc, place, key)], filled],
            names=["trigger", "other", "doc", "place", "key", "content"],
        )

    for batch in batches:
        short: tuple[list, list, list, list, list] = ([], [], [], [], [])
        long: list[tuple] = []
        docs, keys = batch.column("doc").to_pylist(), batch.column("key").to_pylist()
        for doc, key, text, phrases in zip(docs, keys, batch.column("text"), batch.column("phrases").to_pylist()):
            raw = text.as_py()
            for p in phrases:
                start, windows = p["start"], p["windows"]
                if p["frequent"]:
                    one, two = window_hashes(raw, start, windows)
                    at = np.arange(start, start + windows, dtype=np.int64)
                    long.append((one.view(np.int64), two.view(np.int64), np.full(windows, doc, np.int64), _packed(at, np.ones(windows, np.int64), 0), np.full(windows, key, np.int64)))
                else:
                    short[0].append(p["trigger"])
                    short[1].append(doc)
                    short[2].append(int(_packed(np.array([start]), np.array([windows]), 0)[0]))
                    short[3].append(key)
                    short[4].append(raw[start : start + windows + WIDTH - 1])
        if short[0]:
            yield rows(short[0], [0] * len(short[0]), *short[1:])
        if long:
            one, two, doc, place, key = (np.concatenate(c) for c in zip(*long))
            order, repeat = _repeats_first((one, two), doc, place, key)
            first, again = order[~repeat], order[repeat]
            yield rows(one[first], two[first], doc[first], place[first], key[first])
            if len(again):
                start, windows, _ = _unpacked(place[again])
                d, k, s, w = _runs(doc[again], key[again], start, windows)
                yield rows(d * np.int64(0x9E3779B97F4A7C1) + s, np.zeros(len(d), np.int64), d, _packed(s, w, 1), k)


def _sorted_suffixes(rows: list[tuple]) -> pa.RecordBatch | None:
    """Repeated windows of whole groups of spelled phrases (doc, place, key, content)."""
    ones, twos, docs, starts, keys = [], [], [], [], []
    for doc, place, key, content in rows:
        start, windows, _ = (int(x) for x in _unpacked(np.int64(place)))
        one, two = window_hashes(content, 0, windows)
        ones.append(one)
        twos.append(two)
        docs.append(np.full(windows, doc, np.int64))
        starts.append(np.arange(start, start + windows, dtype=np.int64))
        keys.append(np.full(windows, key, np.int64))
    one, two, doc, start, key = (np.concatenate(c) for c in (ones, twos, docs, starts, keys))
    order, repeat = _repeats_first((one, two), doc, start, key)
    again = order[repeat]
    if not len(again):
        return None
    return _settled(*_runs(doc[again], key[again], start[again], np.ones(len(again), np.int64)))


def _suffix_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams ``_SUFFIXES`` rows ordered by (trigger, other, doc, place, key): the repeated windows."""
    group, ready, trigger_now = [], [], None
    last = (None, None)
    for batch in batches:
        spelled = batch.column("content").is_valid().to_numpy(zero_copy_only=False)
        trigger, other, doc, place, key = (batch.column(c).to_numpy() for c in ("trigger", "other", "doc", "place", "key"))
        start, windows, settled = _unpacked(place)
        done = ~spelled & (settled == 1)
        if done.any():
            yield _settled(doc[done], key[done], start[done], windows[done])
        single = ~spelled & (settled == 0)
        if single.any():
            t, o = trigger[single], other[single]
            repeat = np.zeros(len(t), bool)
            repeat[1:] = (t[1:] == t[:-1]) & (o[1:] == o[:-1])
            repeat[0] = (t[0], o[0]) == last
            last = (t[-1], o[-1])
            if repeat.any():
                yield _settled(doc[single][repeat], key[single][repeat], start[single][repeat], windows[single][repeat])
        contents = batch.column("content")
        for i in np.flatnonzero(spelled):
            if trigger[i] != trigger_now:
                ready += group
                group, trigger_now = [], trigger[i]
                if len(ready) >= GROUP_PHRASES:
                    found = _sorted_suffixes(ready)
                    ready = []
                    if found is not None:
                        yield found
            group.append((doc[i], place[i], key[i], contents[int(i)].as_py()))
    ready += group
    if ready:
        found = _sorted_suffixes(ready)
        if found is not None:
            yield found


def _keyed(docs: DataFrame) -> DataFrame:
    """(``doc_id``, ``doc``, ``key``, ``text`` as bytes): the id that orders, a 64-bit hash of the text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return own_columns(docs, "doc_id", "text").select(
        "doc_id",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc"),
        F.xxhash64(text).alias("key"),
        text.cast("binary").alias("text"),
    )


def repeated_windows(docs: DataFrame, group_phrases: int = GROUP_PHRASES) -> DataFrame:
    """(``doc``, ``key``, ``start``, ``windows``): stretches of windows that stand earlier too."""
    rows = _keyed(docs).where(F.length("text") >= WIDTH).drop("doc_id")
    parsed = rows.mapInArrow(_parse, "trigger long, content long, doc long, place long, key long")
    ordered = parsed.repartition("trigger").sortWithinPartitions("trigger", "content", "doc", "place", "key")
    scanned = written(ordered.mapInArrow(_dictionary, _SETTLED), "suffix-dictionary")
    ambiguous = scanned.where("trigger is not null")
    sizes = ambiguous.groupBy("trigger").count()
    marked = ambiguous.join(sizes, "trigger").groupBy("doc", "key").agg(
        F.collect_list(
            F.struct("trigger", "start", "windows", (F.col("count") > group_phrases).alias("frequent"))
        ).alias("phrases")
    )
    # Repeated rows are one document: spelled twice, each of its windows would repeat itself.
    single = rows.dropDuplicates(["doc", "key"])
    spelled = single.join(marked, ["doc", "key"]).mapInArrow(_spelled, _SUFFIXES)
    suffixes = spelled.repartition("trigger").sortWithinPartitions("trigger", "other", "doc", "place", "key")
    resolved = suffixes.mapInArrow(_suffix_order, _SETTLED)
    settled = scanned.where("trigger is null")
    return settled.unionByName(resolved).drop("trigger")


_RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _cut(with_text: bool, id_name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, list, list, list, list] = ([], [], [], [], [])
            for text, found in zip(batch.column("text"), batch.column("found").to_pylist()):
                raw = text.as_py()
                kept, at, removed, spans = [], 0, 0, 0
                stop = -1
                for start, end in sorted((f["start"], f["start"] + f["windows"] + WIDTH - 1) for f in found or []):
                    if start > stop:  # a gap: bytes between spans stay
                        spans += 1
                        kept.append(raw[max(stop, 0) : start])
                        removed += end - start
                        stop = end
                    elif end > stop:
                        removed += end - stop
                        stop = end
                kept.append(raw[max(stop, 0) :])
                left = b"".join(kept)
                out[0].append(len(raw))
                out[1].append(removed)
                out[2].append(spans)
                out[3].append(hashlib.sha256(left).hexdigest())
                if with_text:
                    out[4].append(left.decode("utf-8", "ignore"))
            columns = [batch.column(id_name), *[pa.array(c, pa.int64()) for c in out[:3]], pa.array(out[3], pa.string())]
            names = [id_name, "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                columns.append(pa.array(out[4], pa.string()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def remove_repeats(docs: DataFrame, with_text: bool = False, group_phrases: int = GROUP_PHRASES) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` per row.

    ``with_text`` adds ``kept``, the remaining text (bytes that a cut through a character
    leaves behind are dropped there, not in the hash).
    """
    found = repeated_windows(docs, group_phrases).groupBy("doc", "key").agg(
        F.collect_list(F.struct("start", "windows")).alias("found")
    )
    rows = _keyed(docs).join(found, ["doc", "key"], "left").select("doc_id", "text", "found")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_cut(with_text, "doc_id"), f"doc_id {id_type}, {_RESULT}" + (", kept string" if with_text else ""))
