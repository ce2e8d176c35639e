"""Token ids in binary files: shared zstandard dictionary, one frame per document.

File format (a folder, all parts written by Spark's own committer, so retried tasks leave
nothing behind):

``dictionary``  one row: ``hash`` (sha256, hex), ``content`` (the dictionary), ``width``
                (bytes per id, little endian: 2 for vocabularies below 65,536, else 4).
``segments``    rows of up to ``SEGMENT_IDS`` ids in ascending document order: ``shard``,
                ``segment``, ``dict_hash``, ``first_id`` and ``last_id``, and per document ``doc_ids``, ``counts`` (ids with
                the end id) and ``offsets`` (of its frame in ``payload``).

``read_document`` reads a document by decompressing its own frame, from the segments whose
range of ids may hold it. Readers compare the dictionary with the hash that every segment
carries. The dictionary is trained on the
serialized ids of a bounded sample (``DICTIONARY_DOCS`` documents of at most
``DICTIONARY_DOC_BYTES``, smallest md5 of the id first); every document is written whole.

Encoding works on pieces cut before a blank that follows a visible character. The tokenizer
splits there in any case, so the ids of the pieces joined are the ids of the text; repeated pieces are looked up in a cache bounded in bytes. A text without
blanks is one piece, encoded by itself and not kept. Documents are range-partitioned by id and
the beginning of the text, so one task holds a range of ids, or of the texts of one id or of
none, and streams it: memory is a segment and the texts encoded together.

Null text is an empty document (its end id only), a null id comes last, equal ids are
ordered by text and each row is a document of its own; an empty table gives empty files.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixframe.llm.common import own_columns, text_or_empty

END_ID = 0
SEGMENT_IDS = 1 << 20
CACHE_BYTES, ENTRY_BYTES, LONG_PIECE = 50 << 20, 150, 1 << 10
TOGETHER_CHARS = 1 << 18
MARKS = frozenset(".,;:!?")
DICTIONARY_BYTES = 1 << 15
DICTIONARY_DOCS = 400
DICTIONARY_DOC_BYTES = 1 << 16
LEVEL = 1
RANGE_CHARS = 64

# Blanks beside other white space need the slow cut: only behind a visible character.
_ODD = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_CUT = re.compile(r"(?<=\S)(?= )")
# Letters and digits that every Unicode version has as such, runs of which are a tokenizer's words;
# pieces of them with single marks and line feeds between, and the parts that such a piece falls into.
_LETTERS, _MARK = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", "[.,;:!?]"
_PLAIN = re.compile(f" ?[{_LETTERS}0-9]+(?:(?:{_MARK}|{_MARK}?\n)[{_LETTERS}0-9]+)*{_MARK}?")
_PART = re.compile(f" ?[{_LETTERS}]+| ?[0-9]+|{_MARK}|\n")


def pieces_of(text: str) -> list[str]:
    if "  " in text or " \n" in text or "\n " in text or _ODD.search(text):
        return [p for p in _CUT.split(text) if p]
    first, *rest = text.split(" ")
    pieces = [" " + p for p in rest]
    return [first, *pieces] if first else pieces


def _joins(piece: str) -> bool:
    """May stand between others of its kind: a blank, then visible at both ends."""
    return len(piece) > 1 and piece[0] == " " and not piece[1].isspace() and not piece[-1].isspace()


def _byte_names() -> dict[int, int]:
    """The character by which a byte-level vocabulary names each byte: itself where it is visible."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}


BYTE_NAMES = _byte_names()


def _takes_words(tokenizer) -> bool:
    """Nothing but the byte-level split stands between a plain piece and the tokenizer's model."""
    about = json.loads(tokenizer.to_str())
    split = about["pre_tokenizer"] or {}
    letters = [t for t in about["added_tokens"] if not re.search(f"[^ {_LETTERS}0-9.,;:!?\n]", t["content"])]
    return (
        split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split["add_prefix_space"]
        and about["normalizer"] is None and about["truncation"] is None and about["padding"] is None
        and about["model"]["type"] == "BPE" and not about["model"]["dropout"] and not letters
    )


class PieceEncoder:
    """Tokenizer with a bounded cache of the serialized ids of pieces.

    New plain pieces are parted into words, marks and line feeds, as the tokenizer would, and each new
    part goes to its model. Other new pieces are encoded many at a time as one text, whose ids are parted
    again by the bytes that each id stands for. The cache keeps two generations of ``CACHE_BYTES`` each, by
    the size of pieces and of ids as a rule of thumb; pieces above ``LONG_PIECE`` characters are not kept.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.type = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        special = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        # In a byte-level vocabulary every byte is one character of the token's name.
        self.bytes_of = np.zeros(size, np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.bytes_of[i] = len(special[i].encode()) if i in special else len(token)
        self.model = self.tokenizer.model if _takes_words(self.tokenizer) else None
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.size = 0

    @property
    def width(self) -> int:
        return self.type.itemsize

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.type)

    def _learn(self, pieces: list[str]) -> None:
        if self.model is not None:
            parted = {p: _PART.findall(p) for p in pieces if len(p) <= LONG_PIECE and _PLAIN.fullmatch(p)}
            self._encode_parts(set().union(*parted.values()).difference(self.known), parted)
            pieces = [p for p in pieces if p not in parted]
        # A word and the mark behind it are split by the tokenizer: their ids follow each other.
        marked = [p for p in pieces if p[-1] in MARKS and len(p) <= LONG_PIECE and p[1:-1].isalpha() and p[0] == " "]
        if marked:
            plain = {p[:-1] for p in marked} | {p[-1] for p in marked}
            plain.update(set(pieces).difference(marked))
            self._encode(list(plain.difference(self.known)))
            for p in marked:
                self.known[p] = self.known[p[:-1]] + self.known[p[-1]]
        else:
            self._encode(pieces)

    def _encode_parts(self, new: set[str], parted: dict[str, list[str]]) -> None:
        known, tokenize, ids, ends = self.known, self.model.tokenize, [], []
        for part in new:
            plain = part.isascii() and part != "\n"
            name = part.replace(" ", "\u0120") if plain else part.encode().decode("latin-1").translate(BYTE_NAMES)
            ids += [token.id for token in tokenize(name)]
            ends.append(len(ids))
        raw, width, start = np.array(ids, self.type).tobytes(), self.width, 0
        for part, end in zip(new, ends):
            known[part] = raw[start : end * width]
            start = end * width
        for piece, parts in parted.items():
            if len(parts) > 1:
                known[piece] = b"".join([known[p] for p in parts])
        extra = new.difference(parted)
        self.size += 3 * sum(map(len, extra)) + ENTRY_BYTES * len(extra)

    def _encode(self, pieces: list[str]) -> None:
        joined = [p for p in pieces if _joins(p)]
        for piece in pieces if not joined else set(pieces).difference(joined):
            self.known[piece] = self._ids(piece).tobytes()
        if not joined:
            return
        (encoded,) = self.tokenizer.encode_batch_fast(["".join(joined)], add_special_tokens=False)
        ids = np.array(encoded.ids, self.type)
        ends = np.cumsum([len(p.encode()) for p in joined])
        cuts = np.searchsorted(np.cumsum(self.bytes_of[ids]), ends, side="left") + 1
        raw, width, start = ids.tobytes(), self.width, 0
        for piece, stop in zip(joined, (cuts * width).tolist()):
            self.known[piece] = raw[start:stop]
            start = stop

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Serialized ids of each text."""
        if self.size > CACHE_BYTES:
            self.known, self.older, self.size = {}, self.known, 0
        known = self.known
        cut = [pieces_of(t) for t in texts]
        missing = set().union(*cut).difference(known)
        older = self.older
        found = [p for p in missing if p in older] if older else []
        for piece in found:
            known[piece] = older[piece]
        missing = list(missing.difference(found))
        if missing:
            self._learn(missing)
        encoded = [b"".join([known[p] for p in pieces]) for pieces in cut]
        for piece in [p for p in missing if len(p) > LONG_PIECE]:
            del known[piece]
        kept = [*found, *(p for p in missing if len(p) <= LONG_PIECE)]
        self.size += 3 * sum(map(len, kept)) + ENTRY_BYTES * len(kept)
        return encoded


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One encoder per Python worker and vocabulary file."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def train_dictionary(docs: DataFrame, path: str) -> bytes:
    """Dictionary over the serialized ids of the sample; empty where there is too little to train on."""
    short = docs.where((F.octet_length("text") <= DICTIONARY_DOC_BYTES) & F.col("doc_id").isNotNull())
    # Ids first: a task offers as many candidates as there are places, and texts are long.
    ids = short.select("doc_id").orderBy(F.md5(F.col("doc_id").cast("string"))).limit(DICTIONARY_DOCS).collect()
    chosen = short.where(F.col("doc_id").isin(sorted({r["doc_id"] for r in ids}))) if ids else short.limit(0)
    rows = chosen.select("doc_id", "text").distinct().orderBy("doc_id", "text").limit(DICTIONARY_DOCS).collect()
    samples = encoder(path).encode_many([r["text"] for r in rows])
    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _dictionary(content: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(content) if content else None


SEGMENT_SCHEMA = (
    "shard int, segment int, dict_hash string, first_id {id}, last_id {id}, doc_ids array<{id}>, counts array<long>, offsets array<long>, payload binary"
)


def _writer(path: str, dictionary: bytes, dict_hash: str, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, width = encoder(path).encode_many, encoder(path).width
        end = END_ID.to_bytes(width, "little")
        shared = _dictionary(dictionary)
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared) if shared else zstandard.ZstdCompressor(level=LEVEL)
        shard, segment = TaskContext.get().partitionId(), 0
        ids, counts, offsets, frames, size, held = [], [], [], [], 0, 0

        def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
            for batch in batches:
                names, texts = batch.column("doc_id").to_pylist(), batch.column("text")
                first, together, chars = 0, [], 0
                for at in range(batch.num_rows):
                    together.append(texts[at].as_py())
                    chars += len(together[-1])
                    if chars >= TOGETHER_CHARS or at + 1 == batch.num_rows:
                        yield from zip(names[first : at + 1], encode(together))
                        first, together, chars = at + 1, [], 0

        def packed() -> pa.RecordBatch:
            named = [i for i in ids if i is not None]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int32()),
                    pa.array([segment], pa.int32()),
                    pa.array([dict_hash], pa.string()),
                    pa.array([min(named, default=None)], id_type),
                    pa.array([max(named, default=None)], id_type),
                    pa.array([ids], pa.list_(id_type)),
                    pa.array([counts], pa.list_(pa.int64())),
                    pa.array([offsets], pa.list_(pa.int64())),
                    pa.array([b"".join(frames)], pa.binary()),
                ],
                names=["shard", "segment", "dict_hash", "first_id", "last_id", "doc_ids", "counts", "offsets", "payload"],
            )

        for doc_id, ids_of_doc in encoded(batches):
            raw = ids_of_doc + end
            frame = compressor.compress(raw)
            ids.append(doc_id)
            counts.append(len(raw) // width)
            offsets.append(size)
            frames.append(frame)
            size += len(frame)
            held += counts[-1]
            if held >= SEGMENT_IDS:
                yield packed()
                segment += 1
                ids, counts, offsets, frames, size, held = [], [], [], [], 0, 0
        if ids:
            yield packed()

    return run


def write_tokens(docs: DataFrame, folder: str, vocabulary: str) -> None:
    """Write all documents of (``doc_id``, ``text``) to ``folder`` in ascending id order."""
    spark = docs.sparkSession
    rows = own_columns(docs, "doc_id", "text").withColumn("text", text_or_empty())
    dictionary = train_dictionary(rows, vocabulary)
    dict_hash = hashlib.sha256(dictionary).hexdigest()
    about = spark.createDataFrame(
        [(dict_hash, bytearray(dictionary), encoder(vocabulary).width)], "hash string, content binary, width int"
    )
    about.coalesce(1).write.parquet(f"{folder}/dictionary")
    id_type = rows.schema["doc_id"].dataType
    by_id = F.col("doc_id").asc_nulls_last()
    dealt = rows.repartitionByRange(by_id, F.substring("text", 1, RANGE_CHARS))
    ordered = dealt.sortWithinPartitions(by_id, "text")
    from pyspark.sql.pandas.types import to_arrow_type

    segments = ordered.mapInArrow(
        _writer(vocabulary, dictionary, dict_hash, to_arrow_type(id_type)),
        SEGMENT_SCHEMA.format(id=id_type.simpleString()),
    )
    segments.write.option("compression", "none").parquet(f"{folder}/segments")


def _decompressor(content: bytes) -> zstandard.ZstdDecompressor:
    shared = _dictionary(content)
    return zstandard.ZstdDecompressor(dict_data=shared) if shared else zstandard.ZstdDecompressor()


def _same_dictionary(batch: pa.RecordBatch, content: bytes) -> None:
    wanted = hashlib.sha256(content).hexdigest()
    if any(h != wanted for h in batch.column("dict_hash").to_pylist()):
        raise ValueError("a segment was written with another dictionary")


def _reader(content: bytes, width: int, id_type: pa.DataType, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = _decompressor(content)
        for batch in batches:
            _same_dictionary(batch, content)
            for i in range(batch.num_rows):
                payload = memoryview(batch.column("payload")[i].as_buffer())
                offsets = batch.column("offsets")[i].as_py()
                counts, crcs, lists = batch.column("counts")[i].as_py(), [], []
                for start, stop in zip(offsets, [*offsets[1:], len(payload)]):
                    ids = np.frombuffer(plain.decompress(payload[start:stop]), f"<u{width}")
                    crcs.append(zlib.crc32(ids.astype("<u4").tobytes()))
                    if with_ids:
                        lists.append(ids.astype("int32"))
                n = len(counts)
                columns = [
                    pa.array([batch.column("shard")[i].as_py()] * n, pa.int32()),
                    pa.array([batch.column("segment")[i].as_py()] * n, pa.int32()),
                    pa.array(range(n), pa.int32()),
                    pa.array(batch.column("doc_ids")[i].as_py(), id_type),
                    pa.array(counts, pa.int64()),
                    pa.array(crcs, pa.int64()),
                ]
                names = ["shard", "segment", "place", "doc_id", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(lists, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` (and ``ids``) of every document of the files.

    ``start`` is a running sum in three levels: shards, segments of a shard, documents of a
    segment; only shard totals (one row per written file) are ordered together.
    """
    about = spark.read.parquet(f"{folder}/dictionary").first()
    segments = spark.read.parquet(f"{folder}/segments")
    element = segments.schema["doc_ids"].dataType.elementType
    from pyspark.sql.pandas.types import to_arrow_type

    schema = f"shard int, segment int, place int, doc_id {element.simpleString()}, n_tokens long, ids_crc32 long"
    docs = segments.mapInArrow(
        _reader(bytes(about["content"]), about["width"], to_arrow_type(element), with_ids),
        schema + (", ids array<int>" if with_ids else ""),
    )
    sizes = segments.select("shard", "segment", F.aggregate("counts", F.lit(0).cast("long"), lambda a, c: a + c).alias("n"))
    shards = sizes.groupBy("shard").agg(F.sum("n").alias("n"))
    shard_start = F.coalesce(
        F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    segment_start = F.coalesce(
        F.sum("n").over(Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    starts = sizes.select("shard", "segment", segment_start.alias("__in_shard")).join(
        shards.select("shard", shard_start.alias("__shard")), "shard"
    )
    within = Window.partitionBy("shard", "segment").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = docs.withColumn("__in_segment", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).join(
        starts, ["shard", "segment"]
    )
    start = F.col("__shard") + F.col("__in_shard") + F.col("__in_segment")
    return placed.select("doc_id", start.alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def read_document(spark: SparkSession, folder: str, doc_id) -> list[list[int]]:
    """The ids of every document of an id (as a rule one), end id included; other frames stay closed."""
    about = spark.read.parquet(f"{folder}/dictionary").first()
    content, width = bytes(about["content"]), about["width"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = _decompressor(content)
        for batch in batches:
            _same_dictionary(batch, content)
            for i in range(batch.num_rows):
                payload = memoryview(batch.column("payload")[i].as_buffer())
                offsets = [*batch.column("offsets")[i].as_py(), len(payload)]
                for k, name in enumerate(batch.column("doc_ids")[i].as_py()):
                    if name == doc_id:
                        ids = np.frombuffer(plain.decompress(payload[offsets[k] : offsets[k + 1]]), f"<u{width}")
                        yield pa.RecordBatch.from_arrays([pa.array([ids.astype("int32")], pa.list_(pa.int32()))], names=["ids"])

    segments = spark.read.parquet(f"{folder}/segments").where((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id))
    return [r["ids"] for r in segments.mapInArrow(run, "ids array<int>").collect()]
