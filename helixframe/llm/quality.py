r"""Quality rules: a hashed n-gram log-likelihood ratio over plain text statistics.

Two multinomials over hashed features are counted: one over the documents that trusted
labels mark as good, one over the whole raw corpus. A document's score is the mean log ratio
of its features. Features of a place in the text are its word, the word's last three characters
and the pair of the word and the next one (the last word of a text is paired with its end),
hashed into ``BINS`` bins: word order counts. Ratios are kept as whole millionths, so sums do not depend on an order of
addition and every run decides alike. A document is kept if its score reaches a threshold
that is fitted on labelled documents, unless the base rules reject it.

Everything here is a native column expression. Within a document, repeated windows are found
by sorting their hashes, never by comparing pairs.

Every labelled id takes part, and corpus counts cover every word of every document. Labels are
broadcast to the texts within the session's bound; beyond it the texts of labelled documents,
and only those, are shuffled to meet them.

Null and empty texts have zero counts, no score (null) and are not kept. Without labels the ratio is zero
everywhere and the base rules decide alone. Repeated rows are scored one by one; an empty
table gives no rows.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import VISIBLE, own_columns, shifted, text_or_empty, word_array, written
from helixframe.session import broadcast_if_small, small

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
BINS = 1 << 16
FEATURES = ("bin", "suffix_bin", "pair_bin")
SUFFIX = 3
SMOOTHING = 1.0
TRUSTED_KEPT = 0.995
SCALE = 1_000_000
STEP = 10_000
RESULTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score_millionths", "base_failed", "kept",
)


def _with_repeats(df: DataFrame) -> DataFrame:
    """``n_repeat_words`` from the column of word hashes ``__hashes``."""
    # One projection per level: each level reads the one below twice. A repeated window of
    # eight needs a repeated window of four, which most documents do not have.
    def doubled(name: str, reach: int) -> Column:
        return F.zip_with(F.col(name), shifted(F.col(name), reach), lambda a, b: F.xxhash64(a, b))

    def counted(name: str, width: int) -> Column:
        return F.slice(name, 1, F.greatest(F.size(name) - (width - 1), F.lit(0)))

    level = df.withColumn("__w2", doubled("__hashes", 1)).withColumn("__w4", doubled("__w2", 2)).drop("__w2")
    level = level.withColumn("__own4", counted("__w4", 4))
    possible = F.size(F.array_distinct("__own4")) < F.size("__own4")
    none = F.array().cast("array<bigint>")
    level = level.withColumn("__w8", F.when(possible, doubled("__w4", 4)).otherwise(none)).drop("__own4", "__w4")
    level = level.withColumn("__w", counted("__w8", WINDOW)).drop("__w8")
    repeated = F.size(F.array_distinct("__w")) < F.size("__w")
    placed = F.zip_with("__w", F.sequence(F.lit(0), F.size("__w") - 1), lambda h, p: F.struct(h.alias("h"), p.alias("p")))
    empty = F.array().cast("array<struct<h:bigint,p:int>>")
    level = level.withColumn("__sorted", F.when(repeated, F.sort_array(placed)).otherwise(empty)).drop("__w")
    edge = F.array(F.lit(None).cast("struct<h:bigint,p:int>"))
    previous = F.concat(edge, F.slice("__sorted", 1, F.greatest(F.size("__sorted") - 1, F.lit(0))))
    around = F.arrays_zip(
        F.col("__sorted").alias("own"), previous.alias("before"), shifted(F.col("__sorted"), 1).alias("after")
    )
    twice = F.filter(
        around,
        lambda x: (x["own"]["h"] == x["before"]["h"]) | F.coalesce(x["own"]["h"] == x["after"]["h"], F.lit(False)),
    )
    level = level.withColumn("__starts", F.sort_array(F.transform(twice, lambda x: x["own"]["p"]))).drop("__sorted")
    widths = F.zip_with("__starts", shifted(F.col("__starts"), 1), lambda a, b: F.coalesce(F.least(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    total = F.aggregate(widths, F.lit(0), lambda a, b: a + b)
    return level.withColumn("n_repeat_words", total.cast("long")).drop("__starts")


def _words_exploded(docs: DataFrame, bins: int, *keep: str) -> DataFrame:
    """One row per word with the bins of its features (``FEATURES``).

    Exploding keeps the work in generated code; what is summed per document or bin is
    combined in the task that read the text, so no word is shuffled.
    """
    split = docs.select(*keep, word_array(text_or_empty()).alias("__words"))
    pairs = F.arrays_zip(F.col("__words").alias("word"), shifted(F.col("__words"), 1).alias("next"))
    words = split.select(*keep, F.explode(pairs).alias("__at")).select(*keep, "__at.word", F.coalesce("__at.next", F.lit("")).alias("next"))

    def binned(*parts: Column) -> Column:
        return F.pmod(F.xxhash64(*parts), F.lit(bins)).cast("int")

    return words.select(
        *keep,
        binned(F.col("word")).alias("bin"),
        binned(F.substring("word", -SUFFIX, SUFFIX), F.lit(1)).alias("suffix_bin"),
        binned(F.col("word"), F.col("next"), F.lit(2)).alias("pair_bin"),
    )


def labelled_sample(labels: DataFrame) -> DataFrame:
    """One (``doc_id``, ``good``, ``counted``) row for every labelled id.

    Half of them (by checksum) are counted into the trusted multinomial; the threshold is
    fitted on the other half, whose own words did not raise their scores.
    """
    rows = own_columns(labels, "doc_id", "quality").where("doc_id is not null and quality is not null")
    single = rows.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    return single.select(
        "doc_id",
        (F.col("quality") == 1).alias("good"),
        (F.crc32(F.col("doc_id").cast("string")) % 2 == 0).alias("counted"),
    )


def fit_ratios(docs: DataFrame, sample: DataFrame, bins: int = BINS) -> list[int]:
    """Log ratio per bin, in millionths, from one pass over all documents, and a second over the
    trusted ones where their ids are too many to broadcast.

    The result of the counting is one row per bin, so at most ``bins`` rows come back.
    """
    texts = own_columns(docs, "doc_id", "text")
    trusted, in_place = broadcast_if_small(sample.where("good and counted").select("doc_id", F.lit(1).alias("good")))
    if in_place:
        marked = texts.join(trusted, "doc_id", "left").select("text", F.lit(1).alias("raw"), F.coalesce("good", F.lit(0)).alias("good"))
    else:
        again = texts.join(trusted, "doc_id").select("text", F.lit(0).alias("raw"), "good")
        marked = texts.select("text", F.lit(1).alias("raw"), F.lit(0).alias("good")).unionByName(again)
    counted = (
        _words_exploded(marked, bins, "raw", "good")
        .select("raw", "good", F.explode(F.array(*FEATURES)).alias("bin"))
        .groupBy("bin")
        .agg(F.sum("raw").alias("raw"), F.sum("good").alias("trusted"))
        .collect()
    )
    raw, trusted = [0] * bins, [0] * bins
    for row in counted:
        raw[row["bin"]], trusted[row["bin"]] = row["raw"], row["trusted"]
    all_raw, all_trusted = sum(raw) + SMOOTHING * bins, sum(trusted) + SMOOTHING * bins
    if not sum(trusted):
        return [0] * bins
    # Unseen trusted features fall back on the raw distribution, weighed as SMOOTHING counts.
    ratios = []
    for r, t in zip(raw, trusted):
        share = (r + SMOOTHING) / all_raw
        ratios.append(round(SCALE * math.log((t + SMOOTHING * bins * share) / all_trusted / share)))
    return ratios


def document_scores(docs: DataFrame, ratios: list[int], *keep: str) -> DataFrame:
    """Mean log ratio (``score_millionths``) per id and text hash of texts with words."""
    # A folded constant: one array for the whole task, looked up by position.
    model = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<int>")
    keys = ["doc_id", "text_key", *keep]
    words = _words_exploded(docs.withColumn("text_key", F.xxhash64(text_or_empty())), len(ratios), *keys)
    ratio = reduce(Column.__add__, [F.element_at(model, F.col(name) + 1) for name in FEATURES])
    # Repeated rows add up alike in both sums.
    total = words.select(*keys, ratio.cast("long").alias("ratio")).groupBy(*keys).agg(
        F.sum("ratio").alias("ratio"), F.count(F.lit(1)).alias("n")
    )
    return total.select(*keys, F.floor(F.col("ratio") / (len(FEATURES) * F.col("n"))).cast("long").alias("score_millionths"))


def fit_threshold(docs: DataFrame, sample: DataFrame, ratios: list[int], trusted_kept: float = TRUSTED_KEPT) -> int | None:
    """Score in millionths that best parts good from bad labelled documents.

    The best difference of rates decides, but never so high that fewer than ``trusted_kept``
    of the good documents pass. Without documents of both kinds there is no threshold (None).
    """
    held = small(sample.where("not counted"))
    scored = document_scores(own_columns(docs, "doc_id", "text").join(held, "doc_id"), ratios, "good")
    # A mean log ratio lies within +-20, hence at most 4,000 steps of a hundredth for each kind.
    steps = (
        scored.groupBy(F.floor(F.col("score_millionths") / STEP).alias("step"), "good")
        .count()
        .collect()
    )
    good = {r["step"]: r["count"] for r in steps if r["good"]}
    bad = {r["step"]: r["count"] for r in steps if not r["good"]}
    if not good or not bad:
        return None
    n_good, n_bad = sum(good.values()), sum(bad.values())
    best, lost, caught, found = (0.0, None), 0, 0, None
    for step in sorted(good.keys() | bad.keys()):
        gain = caught / n_bad - lost / n_good
        if gain > best[0] and lost <= (1 - trusted_kept) * n_good:
            best = (gain, step)
        lost += good.get(step, 0)
        caught += bad.get(step, 0)
    found = best[1]
    return None if found is None else found * STEP


def quality_rules(docs: DataFrame, labels: DataFrame, bins: int = BINS) -> DataFrame:
    """Statistics, score and verdict of every document; all columns of ``docs`` stay in front.

    Result columns that clash with a column of ``docs`` replace it.
    """
    sample = written(labelled_sample(labels), "quality-labels")
    ratios = fit_ratios(docs, sample, bins)
    threshold = fit_threshold(docs, sample, ratios)
    return apply_rules(docs, ratios, threshold)


def apply_rules(docs: DataFrame, ratios: list[int], threshold: int | None) -> DataFrame:
    """Statistics in the row, score from the words; the two meet as one short row per document."""
    names = [c for c in docs.columns if c not in RESULTS]
    plain = docs.select(*[F.col(f"`{c}`") for c in names])
    text, words = F.col("__text"), F.col("__words")
    lines = F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(VISIBLE)))
    symbols = F.when(F.rlike(text, F.lit(f"[{SYMBOLS}]")), F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).otherwise(0)
    base = (
        plain.withColumn("__text", text_or_empty())
        .withColumn("__words", word_array(text))
        .withColumn("__hashes", F.transform("__words", lambda w: F.xxhash64(w)))
    )
    base = _with_repeats(base).withColumns(
        {
            "n_words": F.size(words).cast("long"),
            "word_chars": F.length(F.concat_ws("", words)).cast("long"),
            "n_symbols": symbols.cast("long"),
            "__lines": lines,
            "__key": F.xxhash64(text),
        }
    )
    base = base.withColumn("n_dup_lines", (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"))
    base = base.drop("__text", "__words", "__hashes", "__lines")
    scores = document_scores(own_columns(docs, "doc_id", "text"), ratios).select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "score_millionths"
    )
    met = base.join(scores, base["doc_id"].eqNullSafe(scores["__id"]) & (base["__key"] == scores["__key"]), "left")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    verdict = F.lit(True) if threshold is None else F.coalesce(F.col("score_millionths") >= F.lit(threshold), F.lit(False))
    judged = met.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & verdict)
    return judged.select(*[F.col(f"`{c}`") for c in names], *RESULTS)
