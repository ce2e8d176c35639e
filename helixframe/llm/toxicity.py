"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding lower-cases, maps homoglyphs and digit or symbol substitutions to the letter they
imitate, and drops invisible characters. The lexicon is learnt from labelled documents: a
term's weight is the log odds of the distinct contexts (terms before it) in which it stands
in toxic and in other documents. Counting contexts instead of documents keeps the words of
one much-copied document out. Exception phrases (a lexicon term with its neighbour) that
stand in other documents cancel the matches they cover. The sum of the matched weights,
divided by the logarithm of the length, goes through a logistic curve fitted on the same
labelled documents.

Labels are a bounded sample: at most ``MAX_LABELLED`` ids, smallest md5 first, each with one
text. Lexicon and phrases are all that this sample shows, with no bound of their own. Every
document is scored on its whole text.

Null and empty texts score as documents without matches; repeated rows score alike; without
labels of both kinds every score is the prior 0; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import own_columns, text_or_empty, written
from helixframe.session import small

MAX_LABELLED = 20_000
MIN_CONTEXTS = 4
MIN_WEIGHT = 2.5
CONFIDENCE = 1.64
FOLDS = 5
BLANKS = " \t\n\r"

# Characters that stand for a Latin letter, and characters to drop.
_IMITATIONS = {
    "a": "4@аαá",
    "b": "8ЬƄ",
    "c": "сϲ",
    "d": "ԁ",
    "e": "3еεє",
    "g": "9ɡ",
    "h": "һ",
    "i": "1!|іιı",
    "j": "ј",
    "k": "кκ",
    "l": "ӏ",
    "m": "м",
    "n": "пη",
    "o": "0оοσ",
    "p": "рρ",
    "s": "5$ѕ",
    "t": "7+тτ",
    "u": "υ",
    "v": "ѵν",
    "w": "ԝω",
    "x": "хχ",
    "y": "уγ",
    "z": "2",
}
_INVISIBLE = "­​‌‍⁠﻿"
_FOLDED = {ord(c): letter for letter, chars in _IMITATIONS.items() for c in chars} | dict.fromkeys(map(ord, _INVISIBLE))
# Symbols that imitate a letter count as one only inside a word.
_EDGE = re.compile(r"(?<![^\W_])(?<![!|$+@])[!|$+@]+|[!|$+@]+(?![^\W_]|[!|$+@])")
_SYMBOL = re.compile(r"[!|$+@]")
_TERM = re.compile(r"[^\W_]+")


def fold(text: str | None) -> str:
    if not text:
        return ""
    lowered = text.lower()
    if _SYMBOL.search(lowered):
        lowered = _EDGE.sub(" ", lowered)
    return lowered.translate(_FOLDED)


def _terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct (term, term before) pairs of each labelled document."""
    for batch in batches:
        terms, before, toxic = [], [], []
        for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            found = _TERM.findall(fold(text))
            pairs = set(zip(found, ["", *found]))
            terms += [t for t, _ in pairs]
            before += [b for _, b in pairs]
            toxic += [label] * len(pairs)
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string()), pa.array(before, pa.string()), pa.array(toxic, pa.int32())],
            names=["term", "before", "toxic"],
        )


def labelled_documents(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """(``doc_id``, ``text``, ``toxic``) of the training sample; held-out ids never enter it.

    Of different texts of an id, that with the least md5 is taken; rows that repeat it stay, as
    nothing that is learnt counts them twice.
    """
    usable = (
        own_columns(labels, "doc_id", "toxic")
        .where("doc_id is not null and toxic is not null")
        .where(F.crc32(F.col("doc_id").cast("string")) % FOLDS != 0)
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    sample = usable.orderBy(F.md5(F.col("doc_id").cast("string"))).limit(max_labelled)
    known = own_columns(docs, "doc_id", "text").join(F.broadcast(sample), "doc_id").withColumn("key", F.md5(text_or_empty()))
    first = known.groupBy("doc_id").agg(F.min("key").alias("key"))  # at most max_labelled rows
    return known.join(F.broadcast(first), ["doc_id", "key"]).select("doc_id", "text", "toxic")


def fit_lexicon(sample: DataFrame) -> tuple[dict[str, float], list[str]]:
    """Weights of terms and the exception phrases: as many as the bounded sample shows."""
    pairs = written(sample.select("text", "toxic").mapInArrow(_terms_of, "term string, before string, toxic int"), "toxicity-terms")
    contexts = pairs.groupBy("term", "before").agg(F.max("toxic").alias("toxic"), F.min("toxic").alias("all_toxic"))
    # Contexts are shuffled once: what follows reads one stored row per term.
    counted = written(
        contexts.groupBy("term").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("all_toxic")).alias("other")),
        "toxicity-counts",
    )
    totals = counted.agg(F.sum("bad").alias("bad"), F.sum("other").alias("other")).first()
    if not totals["bad"] or not totals["other"]:
        return {}, []
    weight = F.log((F.col("bad") + 0.5) / (totals["bad"] + 1.0)) - F.log((F.col("other") + 0.5) / (totals["other"] + 1.0))
    # Lower end of the weight's confidence interval: chance alone puts few terms above it.
    surely = F.col("weight") - CONFIDENCE * F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("other") + 0.5))
    chosen = (
        counted.where((F.col("bad") >= MIN_CONTEXTS) & (F.length("term") >= 3))
        .select("term", "bad", "other", weight.alias("weight"))
        .where((surely >= MIN_WEIGHT) & (F.col("bad") >= 2 * F.col("other")))
        .collect()
    )
    lexicon = {r["term"]: round(r["weight"], 6) for r in chosen}
    if not lexicon:
        return {}, []
    terms = small(pairs.sparkSession.createDataFrame([(t,) for t in sorted(lexicon)], "term string"))
    # Only the contexts of chosen terms meet again.
    again = pairs.join(terms, "term", "left_semi").where(F.col("before") != "").groupBy("term", "before")
    spared = again.agg(F.max("toxic").alias("toxic")).where("toxic = 0").collect()
    return lexicon, [f"{r['before']} {r['term']}" for r in spared]


def matcher(lexicon: dict[str, float], exceptions: list[str]) -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for phrase in exceptions:
        machine.add_word(phrase, (len(phrase), None))
    for term, weight in lexicon.items():
        machine.add_word(term, (len(term), weight))
    machine.make_automaton()
    return machine


def _whole(text: str, start: int, end: int) -> bool:
    return not (start and text[start - 1].isalnum()) and not (end < len(text) and text[end].isalnum())


def matches(machine: ahocorasick.Automaton, folded: str) -> list[tuple[int, int, float]]:
    """Whole-word matches (start, end, weight) that no exception phrase covers."""
    found, spared = [], []
    for last, (length, weight) in machine.iter(folded):
        start, end = last + 1 - length, last + 1
        if _whole(folded, start, end):
            (spared if weight is None else found).append((start, end, weight))
    if not spared:
        return found
    # Both lists ascend by their end; a phrase that covers a match ends at it or later.
    left, i = [], 0
    for start, end, weight in found:
        while i < len(spared) and spared[i][1] < end:
            i += 1
        if not any(s <= start for s, e, _ in spared[i : i + 2] if e >= end):
            left.append((start, end, weight))
    return left


def strength(machine: ahocorasick.Automaton | None, text: str | None) -> float:
    if machine is None or not text:
        return 0.0
    found = matches(machine, fold(text))
    return math.fsum(w for _, _, w in found) / math.log(math.e + sum(map(text.count, BLANKS))) if found else 0.0


def fit_curve(rows: list[tuple[float, int]], rounds: int = 50) -> tuple[float, float]:
    """Logistic intercept and slope by damped Newton steps on (strength, label) rows."""
    intercept, slope = 0.0, 1.0
    for _ in range(rounds):
        g0 = g1 = 0.0
        h00 = h11 = 1e-3
        h01 = 0.0
        for x, y in rows:
            p = _logistic(intercept + slope * x)
            d, v = p - y, p * (1 - p)
            g0, g1 = g0 + d, g1 + d * x
            h00, h01, h11 = h00 + v, h01 + v * x, h11 + v * x * x
        g1 += 1e-3 * slope
        det = h00 * h11 - h01 * h01
        if det <= 0:
            break
        step0, step1 = (h11 * g0 - h01 * g1) / det, (h00 * g1 - h01 * g0) / det
        intercept -= max(-2.0, min(2.0, step0))
        slope -= max(-2.0, min(2.0, step1))
        if abs(step0) + abs(step1) < 1e-9:
            break
    return round(intercept, 9), round(slope, 9)


def _logistic(z: float) -> float:
    return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


def _scorer(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, exceptions, intercept, slope = model.value
        machine = matcher(lexicon, exceptions) if lexicon else None
        for batch in batches:
            strengths = [strength(machine, t.as_py()) for t in batch.column("text")]
            scores = [_logistic(intercept + slope * x) if lexicon else 0.0 for x in strengths]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(n) for n in batch.schema.names if n != "text"],
                    pa.array(strengths, pa.float64()),
                    pa.array(scores, pa.float64()),
                ],
                names=[*[n for n in batch.schema.names if n != "text"], "strength", "score"],
            )

    return run


def _scored(rows: DataFrame, model: tuple) -> DataFrame:
    spark = rows.sparkSession
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text")
    return rows.mapInArrow(_scorer(spark.sparkContext.broadcast(model)), f"{fields}, strength double, score double")


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> tuple:
    """(lexicon, exceptions, intercept, slope): everything a score needs."""
    sample = written(labelled_documents(docs, labels, max_labelled), "toxicity-sample")
    lexicon, exceptions = fit_lexicon(sample)
    if not lexicon:
        return {}, [], 0.0, 0.0
    rows = _scored(sample, (lexicon, exceptions, 0.0, 1.0)).select("doc_id", "strength", "toxic").distinct().collect()
    intercept, slope = fit_curve(sorted((r["strength"], r["toxic"]) for r in rows))
    return lexicon, exceptions, intercept, slope


def score_toxicity(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted``, ``strength`` per document row."""
    scored = _scored(own_columns(docs, "doc_id", "text"), fit(docs, labels, max_labelled))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0, F.lit(False))
    return scored.select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "strength"
    )
