r"""Benchmark decontamination with a generalised suffix automaton.

The automaton of all normalised test items is built over words. A document's words stream
through it once; the automaton tracks the longest suffix read so far that occurs in some
item. Where that length reaches the window (10 words), the last 10 words are hit; an item
shorter than the window is hit where the whole item has just been read. Hit words form
spans; spans are removed from the text, and a document whose hit words reach a share of its
words is dropped whole by ``decontaminate``.

The test items are the bounded side. They are split into shards of at most
``SHARD_WORDS`` words by a running total over ids, and each shard's automaton (about two
states a word) is broadcast on its own, so neither the driver nor a task ever holds more
than one shard. Documents are read once per shard; one shard covers 2 million words of
benchmark, which is more than all public benchmarks a corpus is usually held against.

Null texts have no words; an item without words marks nothing; two items with equal words
are both reported; items without an id mark like others, count together as one item and have
no name in ``items_sha256``; repeated document rows are judged alike; an empty benchmark hits nothing
and an empty document table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import map_all_columns, own_columns, written

WINDOW = 10
SHARD_WORDS = 2_000_000
MAX_COVERAGE = 0.5

# Bytes of words: digits, letters (upper case folded) and everything beyond ASCII.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
_WORD_BYTES = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_FOLD).split() if text else []


class ItemAutomaton:
    """Suffix automaton over the word lists of several items.

    ``next`` and ``link`` are the usual transitions and suffix links, ``length`` the longest
    string of a state. ``window_items[state]`` lists items that contain the state's strings
    of window length; ``short_items[state]`` lists short items that end there.
    """

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW) -> None:
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        self.at_window = self._first_of_length(window)
        self.window_items: dict[int, set[str | None]] = {}
        self.short_items: dict[int, list[tuple[int, str | None]]] = {}
        for name, words in items:
            self._mark(name, words)
        self._inherit_short_items()

    def _extend(self, last: int, word: bytes) -> int:
        """Append a word behind state ``last``; known continuations are shared."""
        known = self.next[last].get(word)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._clone(last, word, known)
        state = self._new(self.length[last] + 1, {}, 0)
        node = last
        while node != -1 and word not in self.next[node]:
            self.next[node][word] = state
            node = self.link[node]
        if node != -1:
            target = self.next[node][word]
            if self.length[target] != self.length[node] + 1:
                target = self._clone(node, word, target)
            self.link[state] = target
        return state

    def _new(self, length: int, transitions: dict[bytes, int], link: int) -> int:
        self.next.append(transitions)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _clone(self, node: int, word: bytes, target: int) -> int:
        copy = self._new(self.length[node] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = copy
        while node != -1 and self.next[node].get(word) == target:
            self.next[node][word] = copy
            node = self.link[node]
        return copy

    def _first_of_length(self, length: int) -> list[int]:
        """Per state, the state on its link path that holds its suffix of that length (or -1)."""
        found = [-1] * len(self.next)
        for state in sorted(range(len(self.next)), key=self.length.__getitem__):
            if self.length[state] >= length:
                above = self.link[state]
                found[state] = found[above] if self.length[above] >= length else state
        return found

    def _mark(self, name: str | None, words: list[bytes]) -> None:
        state = 0
        for word in words:
            state = self.next[state][word]
            at = self.at_window[state]
            if at >= 0:
                self.window_items.setdefault(at, set()).add(name)
        if words and len(words) < self.window:
            self.short_items.setdefault(state, []).append((len(words), name))

    def _inherit_short_items(self) -> None:
        """Let every state know the short items that are suffixes of what it has read."""
        own = self.short_items
        if not own:
            return
        full: dict[int, list[tuple[int, str | None]]] = {}
        for state in sorted(range(len(self.next)), key=self.length.__getitem__):
            above = full.get(self.link[state], []) if state else []
            if above or state in own:
                full[state] = own.get(state, []) + above
        self.short_items = full

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str | None]]:
        """Hit spans (word positions, end exclusive, merged) and the items that were met."""
        spans: list[tuple[int, int]] = []
        met: set[str | None] = set()
        transitions, link, lengths = self.next, self.link, self.length
        window, at_window, short = self.window, self.at_window, self.short_items
        root = transitions[0]
        state, matched = 0, 0
        for position, word in enumerate(words):
            if not state:
                state = root.get(word, 0)
                if not state:
                    continue
                matched = 1
            else:
                following = transitions[state].get(word)
                while following is None and state:
                    state = link[state]
                    matched = lengths[state]
                    following = transitions[state].get(word)
                if following is None:
                    matched = 0
                    continue
                state = following
                matched += 1
            if matched >= window:
                met |= self.window_items[at_window[state]]
                _add_span(spans, position + 1 - window, position + 1)
            if short and state in short:
                for length, name in short[state]:
                    if length <= matched:
                        met.add(name)
                        _add_span(spans, position + 1 - length, position + 1)
        return spans, met


def _add_span(spans: list[tuple[int, int]], start: int, end: int) -> None:
    """Add a span that ends last of all, merging it with those it meets or touches."""
    while spans and spans[-1][1] >= start:
        start = min(start, spans.pop()[0])
    spans.append((start, end))


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    raw = text.encode()
    kept, at, wanted, open_at = [], 0, iter(spans), None
    span = next(wanted, None)
    for number, match in enumerate(_WORD_BYTES.finditer(raw)):
        if span is None:
            break
        if number == span[0]:
            open_at = match.start()
        if number == span[1] - 1:
            kept.append(raw[at:open_at])
            at = match.end()
            span = next(wanted, None)
    return b"".join([*kept, raw[at:]]).decode()


def _shards(spark, benchmark: DataFrame, shard_words: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """Bounded lists of (item, words), taken by id in the order of a streamed scan."""
    rows = own_columns(benchmark, "item_id", "text").where("text is not null")
    shard: list[tuple[str | None, list[bytes]]] = []
    total = 0
    for row in rows.toLocalIterator():
        words = words_of(row["text"])
        if shard and total + len(words) > shard_words:
            yield shard
            shard, total = [], 0
        if words:
            name = row["item_id"]
            shard.append((None if name is None else str(name), words))
            total += len(words)
    if shard:
        yield shard


SPAN_SCHEMA = "n_words long, spans array<struct<start:int,end:int>>, items array<string>"


def _scanner(automaton, names: list[str]):
    """Arrow batches in, the same rows with spans and items added."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton.value if automaton is not None else None
        for batch in batches:
            counts, spans, items = [], [], []
            for text in batch.column("text"):
                words = words_of(text.as_py())
                found, met = machine.scan(words) if machine else ([], set())
                counts.append(len(words))
                spans.append([{"start": a, "end": b} for a, b in found])
                items.append(sorted(met, key=lambda name: (name is None, name or "")))
            span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(n) for n in names],
                    pa.array(counts, pa.int64()),
                    pa.array(spans, span_type),
                    pa.array(items, pa.list_(pa.string())),
                ],
                names=[*names, "n_words", "spans", "items"],
            )

    return run


def find_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(``doc_id``, ``text_key``, ``n_words``, ``spans``, ``items``) per document row.

    ``text_key`` is the text's hash; with the id it names a row (repeated rows agree).
    """
    rows = own_columns(docs, "doc_id", "text").withColumn("text_key", F.xxhash64("text"))
    automata = _automata(docs.sparkSession, benchmark, window, shard_words)
    if len(automata) <= 1:
        return _scanned(rows, automata[0] if automata else None)
    # Several shards: the few rows with hits are merged per document, then meet the first scan.
    merged = _merged_hits(rows, automata)
    bare = _scanned(rows, None).drop("spans", "items").alias("d")
    same = F.expr("d.doc_id <=> m.doc_id and d.text_key <=> m.text_key")
    return bare.join(merged.alias("m"), same, "left").select(
        "d.doc_id", "d.text_key", "d.n_words",
        F.coalesce(F.transform("m.spans", lambda s: s), F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
        F.coalesce("m.items", F.array().cast("array<string>")).alias("items"),
    )


def _automata(spark, benchmark: DataFrame, window: int, shard_words: int) -> list:
    """One broadcast automaton per shard; the driver builds them one at a time."""
    return [spark.sparkContext.broadcast(ItemAutomaton(s, window)) for s in _shards(spark, benchmark, shard_words)]


def _merged_hits(rows: DataFrame, automata: list) -> DataFrame:
    """Spans and items of all shards per (``doc_id``, ``text_key``) with hits; each shard is a job of its own."""
    hits = [written(_scanned(rows, a).where(F.size("spans") > 0), "decontaminate-hits") for a in automata]
    every = hits[0]
    for more in hits[1:]:
        every = every.unionByName(more)
    return every.groupBy("doc_id", "text_key").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )


def _scanned(rows: DataFrame, automaton) -> DataFrame:
    return rows.mapInArrow(
        _scanner(automaton, ["doc_id", "text_key"]), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text_key long, {SPAN_SCHEMA}"
    )


def _merged(spans: list) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans or []):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def digest(found: DataFrame) -> DataFrame:
    """Counts and the item digest of ``find_spans`` rows."""
    # Spans of several shards may overlap: count the words of their union.
    covered = F.aggregate(
        F.array_sort("spans"),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("at")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(s["end"] - F.greatest(s["start"], a["at"]), F.lit(0))).alias("n"),
            F.greatest(a["at"], s["end"]).alias("at"),
        ),
        lambda a: a["n"].cast("long"),
    )
    return found.select(
        "doc_id",
        "n_words",
        covered.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
    ).withColumn("contaminated", F.col("n_hit") > 0)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    max_coverage: float = MAX_COVERAGE,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """``docs`` with hit spans cut out of ``text``; rows with more hit than ``max_coverage`` go.

    Rows without hits come back untouched. With one shard nothing is shuffled. With several,
    the spans of all shards in the unshortened text are merged, judged and cut together.
    """
    automata = _automata(docs.sparkSession, benchmark, window, shard_words)
    if not automata:
        return docs
    if len(automata) == 1:
        return map_all_columns(docs, _scan_cleaner(automata[0], max_coverage), docs.schema)
    rows = own_columns(docs, "doc_id", "text").withColumn("text_key", F.xxhash64("text"))
    merged = _merged_hits(rows, automata).select("doc_id", "text_key", "spans")
    at, names = docs.columns.index("text"), [f"c{i}" for i in range(len(docs.columns))]
    doc, text = F.col(f"c{docs.columns.index('doc_id')}"), F.col(f"c{at}")
    same = doc.eqNullSafe(F.col("doc_id")) & F.xxhash64(text).eqNullSafe(F.col("text_key"))
    met = docs.toDF(*names).join(merged, same, "left").select(*names, "spans")
    return met.mapInArrow(_span_cleaner(at, docs.columns, max_coverage), docs.schema)


def _cleaned(batch: pa.RecordBatch, at: int, spans_of, max_coverage: float) -> pa.RecordBatch:
    """The batch with ``spans_of(row, words)`` cut out of column ``at``, without rows hit too much."""
    texts, keep = batch.column(at).to_pylist(), []
    changed = False
    for i, text in enumerate(texts):
        words = words_of(text)
        spans = spans_of(i, words)
        keep.append(sum(b - a for a, b in spans) <= max_coverage * len(words))
        if spans:
            texts[i] = without_spans(text, spans)
            changed = True
    if changed:
        batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
    return batch.filter(pa.array(keep, pa.bool_()))


def _scan_cleaner(automaton, max_coverage: float):
    """Cuts what the one automaton finds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            yield _cleaned(batch, at, lambda _, words: automaton.value.scan(words)[0], max_coverage)

    return run


def _span_cleaner(at: int, names: list[str], max_coverage: float):
    """Cuts the spans of the last column; the columns before it get their names back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(len(names)).to_pylist()
            own = pa.RecordBatch.from_arrays(batch.columns[:-1], names=names)
            yield _cleaned(own, at, lambda i, _, found=found: _merged(found[i]), max_coverage)

    return run


def item_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
