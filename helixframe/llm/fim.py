"""Fill-in-middle rearrangement with memoized content-defined chunks.

A rolling hash of the last ``WINDOW`` bytes cuts each text where its low bits are zero, so
passages that documents share fall into equal chunks wherever they stand. A chunk's summary
(token ends inside, how its edges stand to white space, code points) is computed once per
worker and kept in a cache by content; a hit is verified on the content itself. Summaries
combine: ends inside plus the ends that lie between chunks give a document's token count, and
running counts give the chunk that holds a cut, which alone is searched for its place.

A token is white space followed by other characters, or white space at the end of a text, so a
token ends where a character other than white space is followed by white space, and at the end
of the text. White space is ASCII: all of this holds for bytes, and code points only are
counted, as bytes that continue none.

Null and empty texts, texts that contain one of the markers, and those not chosen stay plain.
A null id has the seed's colon alone hashed. Repeated rows come out alike. Texts of any length
are worked on in parts of ``PART_BYTES``; memory is a text, its output and a few arrays of a
part. The cache is two generations of ``CACHE_BYTES`` of chunk content; it changes no result.
Other columns, of whatever name, stay as they are; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, FIM_PERCENT, SPM_PERCENT = 42, 50, 80
WINDOW = 32
CHUNK_BITS = 9
LONGEST_CHUNK = 1 << 13
PART_BYTES = 1 << 22
CACHE_BYTES = 1 << 25

_RANDOM = np.random.default_rng(7).integers(0, 1 << 32, 256, dtype=np.uint32)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """At each byte the hash of the ``WINDOW`` bytes up to it, by doubling the window."""
    out = _RANDOM[data]
    width = 1
    while width < WINDOW:
        wider = out.copy()
        wider[width:] += out[:-width] << np.uint32(width)
        out, width = wider, 2 * width
    return out


def chunk_ends(data: np.ndarray) -> np.ndarray:
    """Ends of the chunks of a text: where the hash says so, else every ``LONGEST_CHUNK`` bytes."""
    found = []
    for at in range(0, len(data), PART_BYTES):
        low = max(0, at - WINDOW + 1)
        high_bits = rolling_hash(data[low : at + PART_BYTES]) >> np.uint32(32 - CHUNK_BITS)
        places = np.flatnonzero(high_bits == 0) + low + 1
        found.append(places[(places > at) & (places >= WINDOW)])
    ends = np.unique(np.append(np.concatenate(found), len(data)))
    gaps = np.diff(ends, prepend=0)
    if gaps.max() <= LONGEST_CHUNK:
        return ends
    wide = np.flatnonzero(gaps > LONGEST_CHUNK)
    more = [np.arange(ends[k] - gaps[k] + LONGEST_CHUNK, ends[k], LONGEST_CHUNK) for k in wide]
    return np.unique(np.concatenate([ends, *more]))


def _token_ends(data: np.ndarray) -> np.ndarray:
    """True where a byte other than white space is followed by white space inside ``data``."""
    blank = _BLANK[data]
    return ~blank[:-1] & blank[1:]


class ChunkCache:
    """Summaries of chunks by content, in two generations of bounded size.

    A summary is (token ends inside, code points, first byte is blank, last byte is blank).
    """

    def __init__(self, most: int = CACHE_BYTES) -> None:
        self.most, self.size = most, 0
        self.young: dict[bytes, tuple] = {}
        self.old: dict[bytes, tuple] = {}

    def get(self, chunk: bytes) -> tuple | None:
        return self.young.get(chunk) or self.old.get(chunk)

    def put(self, chunk: bytes, summary: tuple) -> None:
        if self.size > self.most:
            self.old, self.young, self.size = self.young, {}, 0
        self.young[chunk] = summary
        self.size += len(chunk) + 150


def _summaries(chunks: list[bytes]) -> list[tuple]:
    """Summaries of new chunks, counted together."""
    data = np.frombuffer(b"".join(chunks), np.uint8)
    ends = np.cumsum([len(c) for c in chunks])
    starts = ends - [len(c) for c in chunks]
    blank = _BLANK[data]
    inside = np.zeros(len(data), np.int64)
    inside[:-1] = ~blank[:-1] & blank[1:]
    inside[ends - 1] = 0
    counts = np.add.reduceat(inside, starts)
    points = np.add.reduceat(((data & 0xC0) != 0x80).astype(np.int64), starts)
    return list(zip(counts.tolist(), points.tolist(), blank[starts].tolist(), blank[ends - 1].tolist()))


class Counted:
    """A text's chunks with their summaries; ``cut(units)`` gives a place in it."""

    def __init__(self, text: bytes, cache: ChunkCache) -> None:
        self.text = text
        self.ends = chunk_ends(np.frombuffer(text, np.uint8))
        chunks, at = [], 0
        for end in self.ends.tolist():
            chunks.append(text[at:end])
            at = end
        known: dict[bytes, tuple] = {}
        missing = []
        for chunk in chunks:
            if chunk not in known:
                summary = cache.get(chunk)
                known[chunk] = summary
                if summary is None:
                    missing.append(chunk)
        if missing:
            for chunk, summary in zip(missing, _summaries(missing)):
                known[chunk] = summary
                cache.put(chunk, summary)
        inside, points, first, last = (np.array(x) for x in zip(*map(known.__getitem__, chunks)))
        # An end between two chunks belongs to the first of them.
        between = np.append(~last[:-1] & first[1:], True)
        self.upto = np.cumsum(inside + between)
        self.points = np.cumsum(points)
        self.n = int(self.upto[-1])

    def cut(self, units: int) -> tuple[int, int]:
        """Bytes and code points before the end of the first ``units`` tokens."""
        if not units:
            return 0, 0
        k = int(np.searchsorted(self.upto, units))
        start, before, points = (int(x[k - 1]) if k else 0 for x in (self.ends, self.upto, self.points))
        chunk = np.frombuffer(self.text, np.uint8)[start : self.ends[k]]
        inside = np.flatnonzero(_token_ends(chunk))
        wanted = units - before - 1
        length = int(inside[wanted]) + 1 if wanted < len(inside) else len(chunk)
        return start + length, points + int(np.count_nonzero((chunk[:length] & 0xC0) != 0x80))


def _arranged(fim_percent: int, spm_percent: int):
    markers = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def one(text: bytes, draws: list[int], cache: ChunkCache) -> tuple:
        if not text:
            return 0, "plain", None, None, b""
        counted = Counted(text, cache)
        n = counted.n
        if any(m in text for m in markers) or draws[2] % 100 >= fim_percent:
            return n, "plain", None, None, text
        low, high = sorted(d % (n + 1) for d in draws[:2])
        (a, a_points), (b, b_points) = counted.cut(low), counted.cut(high)
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        p, s, m = markers
        if draws[3] % 100 < spm_percent:
            return n, "spm", a_points, b_points - a_points, b"".join([s, suffix, p, prefix, m, middle])
        return n, "psm", a_points, b_points - a_points, b"".join([p, prefix, s, suffix, m, middle])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = ChunkCache()
        for batch in batches:
            kept = batch.schema.names[:-2]
            out: list[tuple] = []
            begun = 0

            def flush(to: int) -> pa.RecordBatch:
                rest = batch.slice(begun, to - begun).select(kept)
                columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.string(), pa.int64(), pa.int64()))]
                texts = pa.array([r[4] for r in out], pa.binary()).cast(pa.string())
                return pa.RecordBatch.from_arrays([*rest.columns, *columns, texts], names=[*rest.schema.names, "n", "form", "prefix_chars", "middle_chars", "output"])

            size = 0
            texts, draws = (batch.column(batch.num_columns - k) for k in (2, 1))
            for row in range(batch.num_rows):
                value = texts[row].as_buffer()
                out.append(one(value.to_pybytes() if value is not None else b"", draws[row].as_py(), cache))
                size += len(out[-1][4])
                if size > PART_BYTES:
                    yield flush(row + 1)
                    out, begun, size = [], row + 1, 0
            if out:
                yield flush(batch.num_rows)

    return run


def draws_of(doc_id: Column, seed: int) -> Column:
    """Four unsigned 32-bit draws of a document, from the digest of the seed and its id."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    sha = F.sha2(F.concat(F.lit(f"{seed}:"), text), 256)
    return F.array(*[F.conv(F.substring(sha, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)])


def fill_in_middle(
    docs: DataFrame,
    *,
    keep: tuple[str, ...] | None = None,
    seed: int = SEED,
    fim_percent: int = FIM_PERCENT,
    spm_percent: int = SPM_PERCENT,
    names: tuple[str, str, str, str, str] = ("n", "form", "prefix_chars", "middle_chars", "output"),
) -> DataFrame:
    """Columns ``keep`` (all by default) with token count, form, code points of prefix and
    middle, and the rearranged text, under ``names``.
    """
    fields = [f for f in docs.schema.fields if keep is None or f.name in keep]
    short = [T.StructField(f"k{i}", f.dataType) for i, f in enumerate(fields)]
    given = docs.select(
        *[F.col(f"`{f.name}`").alias(k.name) for f, k in zip(fields, short)],
        F.col("`text`").cast("string").alias("__text"), draws_of(F.col("`doc_id`"), seed).alias("__draws"),
    )
    added = "n long, form string, prefix_chars long, middle_chars long, output string"
    schema = T.StructType([*short, *T.StructType.fromDDL(added).fields])
    arranged = given.mapInArrow(_arranged(fim_percent, spm_percent), schema)
    return arranged.toDF(*[f.name for f in fields], *names)


def restored(output: Column, form: Column) -> Column:
    """The text that an output of a form was made from.

    No text between the markers contains one, so each marker is found where it first stands.
    """

    def after(text: Column, marker: str) -> Column:
        return F.substr(text, F.instr(text, marker) + F.lit(len(marker)))

    def until(text: Column, marker: str) -> Column:
        return F.substr(text, F.lit(1), F.instr(text, marker) - F.lit(1))

    def between(first: str, second: str) -> Column:
        return until(after(output, first), second)

    psm = F.concat(between(PREFIX, SUFFIX), after(output, MIDDLE), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), after(output, MIDDLE), between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
