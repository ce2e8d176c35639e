"""Language identification by rank-order profiles of character n-grams.

A language's profile is the list of its most frequent n-grams (1 to 3 characters, blanks
marking word edges) in rank order. A document's own list is compared with every profile by
the out-of-place distance: for each n-gram, how far its rank differs, or the profile's length
where the profile lacks it. The nearest profile wins; the score is one minus the distance
relative to the largest possible one.

Profiles are learnt from a bounded sample: at most ``SAMPLE_PER_LANGUAGE`` documents per
language (smallest md5 of the id first) outside the held-out fold, each id once with the least
of its texts. Every document's n-grams are counted over its whole text, in pieces of
``PIECE_CHARS`` starts that give the same counts as one, so arrays do not grow with a text.

Null texts and texts without letters are ``und`` with score 0, and so is everything when
nothing was learnt; ties go to the language that comes first by name; repeated rows agree; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helixframe.llm.common import map_all_columns, own_columns
from helixframe.session import small

FOLDS, HELD_FOLD = 4, 2
SAMPLE_PER_LANGUAGE = 400
MARGIN = 4
PROFILE = 400
PIECE_CHARS = 1 << 20
UNKNOWN = "und"
_BITS = np.uint64(21)
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    """Which code points are letters, made once per worker from the character database."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def _grams(text: str, starts: int) -> np.ndarray:
    """Codes of the n-grams that begin in the first ``starts`` characters; blanks stand for what is no letter."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    letter = _is_letter()[points]
    chars = np.where(letter, points, 32).astype(np.uint64)
    pairs, triples = (max(0, min(starts, len(chars) - k)) for k in (1, 2))
    two = (chars[:pairs] << _BITS) | chars[1 : pairs + 1]
    three = (two[:triples] << _BITS) | chars[2 : triples + 2]
    return np.concatenate(
        [
            chars[:starts][letter[:starts]],
            two[letter[:pairs] | letter[1 : pairs + 1]],
            three[letter[1 : triples + 1]],
        ]
    )


def count_grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram codes in ascending order and their counts, over the whole text."""
    codes, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
    if not text:
        return codes, counts
    padded = f" {text.lower()} "
    # An n-gram is counted in the piece that it begins in, which reaches two characters on.
    for i in range(0, len(padded), PIECE_CHARS):
        more, n = np.unique(_grams(padded[i : i + PIECE_CHARS + 2], PIECE_CHARS), return_counts=True)
        if not i:
            codes, counts = more, n
            continue
        codes, place = np.unique(np.concatenate([codes, more]), return_inverse=True)
        counts = np.bincount(place, np.concatenate([counts, n]), len(codes)).astype(np.int64)
    return codes, counts


def ranked(codes: np.ndarray, counts: np.ndarray, most: int = PROFILE) -> np.ndarray:
    """The most frequent codes, most frequent first, ties by code."""
    if len(codes) > most:
        least = np.partition(counts, len(counts) - most)[len(counts) - most]
        above = counts >= least
        codes, counts = codes[above], counts[above]
    order = np.lexsort((codes, -counts))
    return codes[order][:most]


class Profiles:
    """All profiles as one table of ranks."""

    def __init__(self, grams: dict[str, list[int]]) -> None:
        self.names = sorted(grams)
        self.codes = np.array(sorted({g for p in grams.values() for g in p}), np.uint64)
        self.ranks = np.full((len(self.names), len(self.codes) + 1), -1, np.int64)
        for row, name in enumerate(self.names):
            places = np.searchsorted(self.codes, np.array(grams[name], np.uint64))
            self.ranks[row, places] = np.arange(len(places))

    def nearest(self, text: str | None) -> tuple[str, float]:
        own = ranked(*count_grams(text))
        if not len(own) or not self.names:
            return UNKNOWN, 0.0
        places = np.searchsorted(self.codes, own)
        known = (places < len(self.codes)) & (self.codes[np.minimum(places, len(self.codes) - 1)] == own)
        theirs = self.ranks[:, np.where(known, places, len(self.codes))]
        apart = np.where(theirs < 0, PROFILE, np.abs(theirs - np.arange(len(own))))
        distances = apart.sum(axis=1)
        best = int(distances.argmin())
        return self.names[best], float(1 - distances[best] / (PROFILE * len(own)))


def _count_sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            codes, counts = count_grams(text)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(codes), pa.string()), pa.array(codes.astype(np.int64)), pa.array(counts.astype(np.int64))],
                names=["lang", "gram", "n"],
            )


def fit_profiles(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Profiles:
    """Profiles from the labelled sample outside the held-out fold."""
    known = own_columns(docs, "doc_id", "text", "lang").where(
        (F.crc32(F.col("doc_id").cast("string")) % FOLDS != HELD_FOLD) & F.col("lang").isNotNull()
    )
    # Ids are ranked without their texts. Only those whose hash lies in a share of the hash
    # space that holds about MARGIN times the sample are ranked, so a language of any size
    # sends a bounded number of rows to its ranking. Ids are counted, not rows, within 2%.
    sizes = known.groupBy("lang").agg(F.approx_count_distinct("doc_id", 0.02).alias("ids"))
    place = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 8), 16, 10).cast("double")
    share = F.lit(float(MARGIN * per_language)) / F.col("ids")
    ids = known.join(small(sizes), "lang").where(place < share * float(1 << 32)).select("doc_id", "lang").distinct()
    by_hash = Window.partitionBy("lang").orderBy(F.md5(F.col("doc_id").cast("string")))
    first = ids.withColumn("place", F.row_number().over(by_hash)).where(F.col("place") <= per_language)
    chosen = first.select("doc_id", "lang")
    # One row per sampled id and language: of different texts the least.
    sample = known.join(F.broadcast(chosen), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    counts = (
        sample.select("lang", "text")
        .mapInArrow(_count_sample, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    by_count = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    top = counts.withColumn("rank", F.row_number().over(by_count)).where(F.col("rank") <= PROFILE)
    grams: dict[str, list[tuple[int, int]]] = {}
    for row in top.collect():  # at most PROFILE rows per language
        grams.setdefault(row["lang"], []).append((row["rank"], row["gram"]))
    return Profiles({lang: [g for _, g in sorted(rows)] for lang, rows in grams.items()})


def _labeller(profiles):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [profiles.value.nearest(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                names=[*batch.schema.names, "lang_pred", "score"],
            )

    return run


def identify(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """All columns of ``docs`` and, behind them, ``lang_pred`` and ``score``.

    Columns of those names in ``docs`` are replaced.
    """
    rows = docs.drop("lang_pred", "score")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    shared = docs.sparkSession.sparkContext.broadcast(profiles)
    return map_all_columns(rows, _labeller(shared), f"{fields}, lang_pred string, score double")


def detect_languages(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` per document row."""
    profiles = fit_profiles(docs, per_language)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_FOLD, F.lit(False))
    return identify(own_columns(docs, "doc_id", "text"), profiles).select("doc_id", held.alias("held_out"), "lang_pred", "score")
