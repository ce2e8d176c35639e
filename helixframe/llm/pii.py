r"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

Candidates of four kinds (email, ip, card, phone) come from strict rules (the base spans,
which always stay) and from looser rules. Four labelers vote -1, 0 or 1 on each candidate:
the strict grammar, gazetteers (top-level domains, calling codes, issuer digits, routable
addresses), words before the span, and the characters around it. Expectation-maximisation
over the counted vote patterns estimates how reliable each labeler is; the patterns'
posteriors are the soft labels of a naive Bayes span classifier over the kind, the votes, the
word before and the number of digits. Candidates it accepts join the base spans unless they
overlap one.

Everything is column expressions. The texts are searched once; the candidates are stored,
and the statistics that come back to the driver are counts per vote pattern (at most 4 * 81)
and per feature (a few hundred), whatever the size of the corpus. Patterns are possessive or
anchored at the start of a run, positions are running sums in blocks and contexts come from
short stretches, so the time is in proportion to a text's length and hits; a search behind a
cheap test (an ``@``, enough digits) is skipped where the test fails.

Null text has no spans; repeated rows are searched alike; an empty table gives no rows.
Positions count code points, ends are exclusive.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import own_columns, text_or_empty, written

KINDS = ("email", "ip", "card", "phone")
CONTEXT = 24
ROUNDS = 50
WORD_BINS = 64
BLOCK, STRETCH, FAR = 256, 512, 2**31 - 1

# Starting inside a run of the first class cannot match where its start does not, except
# right behind the match before (\G).
_LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Separators that do not stand between two digits are replaced first; then a card is one run.
LONE_SEPARATOR = r"[\x20-](?![0-9])|(?<![0-9])[\x20-]"
CARD = r"[0-9][\x200-9-]*+"

LOOSE_EMAIL = (
    rf"(?<!{_LOCAL}){_LOCAL}++\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|[(\[]dot[)\]])\x20?[A-Za-z0-9-]++)+"
)
LOOSE_IP = r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"
LOOSE_CARD = r"(?<![0-9./])[0-9]{4}[./][0-9]{4}[./][0-9]{4}[./][0-9]{4}(?![0-9./])"
LOOSE_PHONE = r"(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z.-])"

# Common top-level domains, calling codes, words that announce or deny a span.
DOMAINS = "com org net edu gov mil int info biz io dev app co me eu uk de fr es it nl at ch pl pt se no dk fi ru cn jp in br au ca us".split()
CALLING_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 92 98".split()
ANNOUNCING = r"(?i)\b(?:e-?mail|mail|contact|phone|tel|telephone|call|mobile|fax|card|visa|mastercard|credit|ip|address|host|server)\b"
DENYING = r"(?i)\b(?:version|release|isbn|issn|order|invoice|section|chapter|figure|serial|build)\b"

_SPAN = "array<struct<start:int,end:int,hit:string>>"
_CANDIDATE = "array<struct<kind:int,start:int,end:int,hit:string,base:boolean,before:string,after:string>>"


def _digits(text: Column) -> Column:
    return F.length(text) - F.length(F.translate(text, "0123456789", ""))


def _with_running(df: DataFrame, name: str, values: str, op, zero: int) -> DataFrame:
    """Adds array column ``name``: ``op`` over each prefix of the integer array ``values``.

    A prefix is the blocks before and a part of its own block, so the work per element is
    bounded by ``BLOCK`` (and by a 65,536th of the elements); appending to a growing array would
    copy all of it each time. Every step is a column, so lambdas read it and don't repeat it.
    """
    none = F.array().cast("array<int>")
    blocks = F.sequence(F.lit(0), ((F.size(values) - 1) / BLOCK).cast("int"))
    fold = lambda x: F.aggregate(x, F.lit(zero), op)
    out = df.withColumn("__blocks", F.when(F.size(values) > 0, blocks).otherwise(none))
    out = out.withColumn("__cut", F.transform("__blocks", lambda b: F.slice(values, b * BLOCK + 1, F.lit(BLOCK))))
    out = out.withColumn("__totals", F.transform("__cut", fold))
    out = out.withColumn("__starts", F.transform("__blocks", lambda b: fold(F.slice("__totals", F.lit(1), b))))
    inside = F.zip_with(
        "__cut", "__starts",
        lambda x, start: F.transform(x, lambda _, j: op(start, fold(F.slice(x, F.lit(1), j + 1)))),
    )
    return out.withColumn(name, F.flatten(inside)).drop("__blocks", "__cut", "__totals", "__starts")


def _with_spans(df: DataFrame, name: str) -> DataFrame:
    """Adds array column ``name``: positions of ``__hits``, from what stands between them."""
    steps = F.zip_with(F.slice("__pieces", F.lit(1), F.size("__hits")), "__hits", lambda p, h: F.length(p) + F.length(h))
    ends = _with_running(df.withColumn("__steps", steps), "__ends", "__steps", lambda a, b: a + b, 0)
    spans = F.zip_with(
        "__hits", "__ends", lambda h, e: F.struct((e - F.length(h)).alias("start"), e.alias("end"), h.alias("hit"))
    )
    return ends.withColumn(name, spans.cast(_SPAN)).drop("__steps", "__ends")


def _valid_ip(hit: Column) -> Column:
    value = lambda p: F.regexp_replace(p, "^0+", "")
    return F.forall(
        F.split(hit, r"\."), lambda p: (F.length(value(p)) < 3) | ((F.length(value(p)) == 3) & (value(p) <= F.lit("255")))
    )


def _valid_card(hit: Column) -> Column:
    digits = F.translate(hit, " -./", "")
    doubled = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            2 * d.cast("int") - F.when(d.cast("int") > 4, 9).otherwise(0)
        ),
    )
    luhn = F.aggregate(doubled, F.lit(0), lambda a, b: a + b) % 10 == 0
    return F.when(F.length(digits).between(16, 19), luhn).otherwise(F.lit(False))


def _valid_phone(hit: Column) -> Column:
    return _digits(hit).between(8, 15)


def _found(df: DataFrame, name: str, source: Column, pattern: str, guard: Column, valid) -> DataFrame:
    """Adds array column ``name`` with the valid matches of a pattern."""
    none = F.array().cast("array<string>")
    split = df.withColumns(
        {
            "__pieces": F.when(guard, F.split(source, pattern, -1)).otherwise(none),
            "__hits": F.when(guard, F.regexp_extract_all(source, F.lit(pattern), F.lit(0))).otherwise(none),
        }
    )
    placed = _with_spans(split, "__placed").drop("__pieces", "__hits")
    kept = F.filter("__placed", lambda s: valid(s["hit"])) if valid else F.col("__placed")
    return placed.withColumn(name, kept).drop("__placed")


def find_candidates(docs: DataFrame) -> DataFrame:
    """(``doc_id``, ``candidates``) per document row."""
    df = own_columns(docs, "doc_id", "text").select("doc_id", text_or_empty().alias("__text"))
    text = F.col("__text")
    df = df.withColumn("__digits", _digits(text))
    digits = F.col("__digits")
    cleaned = F.when(digits >= 16, F.regexp_replace(text, LONE_SEPARATOR, "x")).otherwise(F.lit(""))
    df = df.withColumn("__cleaned", cleaned)
    df = _found(df, "__b0", text, EMAIL, F.contains(text, F.lit("@")), None)
    df = _found(df, "__b1", text, IP, digits >= 4, _valid_ip)
    df = _found(df, "__b2", F.col("__cleaned"), CARD, digits >= 16, _valid_card)
    df = _found(df, "__b3", text, PHONE, (digits >= 8) & F.contains(text, F.lit("+")), _valid_phone)
    at = F.contains(text, F.lit("(at)")) | F.contains(text, F.lit("[at]"))
    df = _found(df, "__l0", text, LOOSE_EMAIL, at, None)
    df = _found(df, "__l1", text, LOOSE_IP, F.length(text) - F.length(F.translate(text, ":", "")) >= 3, None)
    df = _found(df, "__l2", text, LOOSE_CARD, digits >= 16, _valid_card)
    df = _found(df, "__l3", text, LOOSE_PHONE, digits >= 10, None)

    # Contexts are taken from short stretches: a place far on in a text costs no more than one
    # at its beginning.
    df = df.withColumn("__stretches", F.regexp_extract_all(text, F.lit(f"(?s).{{1,{STRETCH}}}"), F.lit(0)))

    def cut(first: Column, length: Column) -> Column:
        at = (first / STRETCH).cast("int")
        two = F.concat(F.coalesce(F.get("__stretches", at), F.lit("")), F.coalesce(F.get("__stretches", at + 1), F.lit("")))
        return F.substring(two, first - at * STRETCH + 1, length)

    def described(column: str, kind: int, base: bool) -> Column:
        def row(s: Column) -> Column:
            first = F.greatest(s["start"] - CONTEXT, F.lit(0))
            return F.struct(
                F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["hit"].alias("hit"),
                F.lit(base).alias("base"), cut(first, s["start"] - first).alias("before"),
                cut(s["end"], F.lit(1)).alias("after"),
            )

        return F.transform(column, row).cast(_CANDIDATE)

    df = df.withColumn("__base", F.concat(*[described(f"__b{k}", k, True) for k in range(4)])).withColumn(
        "__loose", F.concat(*[described(f"__l{k}", k, False) for k in range(4)])
    )
    df = _without_overlaps(df.select("doc_id", "__base", "__loose"))
    return df.select("doc_id", F.concat("__base", "__loose").alias("candidates"))


def _without_overlaps(df: DataFrame) -> DataFrame:
    """Drops loose candidates that overlap a base span.

    Along all candidates in order of their start, one overlaps if a base span before it ends
    behind its start, or the next base span begins before its end.
    """
    both = F.when(F.size("__loose") > 0, F.concat("__base", "__loose")).otherwise(F.array().cast(_CANDIDATE))
    placed = F.transform(both, lambda c: F.struct(c["start"].alias("start"), c["base"].alias("base"), c["end"].alias("end"), c.alias("c")))
    df = df.withColumn("__order", F.sort_array(placed))
    df = df.withColumn("__base_ends", F.transform("__order", lambda x: F.when(x["base"], x["end"]).otherwise(-1)))
    starts = F.transform("__order", lambda x: F.when(x["base"], x["start"]).otherwise(FAR))
    df = df.withColumn("__base_starts", F.reverse(starts))
    df = _with_running(df, "__reached", "__base_ends", lambda a, b: F.greatest(a, b), -1)
    df = _with_running(df, "__next", "__base_starts", lambda a, b: F.least(a, b), FAR)
    judged = F.arrays_zip(F.col("__order").alias("x"), F.col("__reached").alias("reached"), F.reverse("__next").alias("next"))
    apart = F.filter(
        judged, lambda j: ~j["x"]["base"] & (j["reached"] <= j["x"]["start"]) & (j["next"] >= j["x"]["end"])
    )
    kept = F.transform(apart, lambda j: j["x"]["c"])
    # In the order they were found in: by kind, then place.
    return df.withColumn("__loose", F.sort_array(kept)).select("doc_id", "__base", "__loose")


def _sign(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def votes(c: Column) -> Column:
    """The four votes on a candidate, as one text such as ``1|0|0|-1``."""
    hit, kind = c["hit"], c["kind"]
    domain = F.lower(F.regexp_extract(hit, r"([A-Za-z]+)$", 1))
    code = F.regexp_extract(hit, r"^\+([0-9]{1,2})", 1)
    octet = F.regexp_extract(hit, r"^0*([0-9]{1,3})\.", 1).cast("int")
    gazetteer = (
        F.when(kind == 0, _sign(domain.isin(DOMAINS), F.lit(True)))
        .when(kind == 1, _sign(octet.between(1, 223) & (octet != 127), octet.isNotNull()))
        .when(kind == 2, _sign(F.substring(hit, 1, 1).isin("3", "4", "5", "6"), F.lit(True)))
        .otherwise(_sign(code.isin(CALLING_CODES) | F.substring(code, 1, 1).isin("1", "7"), F.length(code) > 0))
    )
    context = _sign(F.rlike(c["before"], F.lit(ANNOUNCING)), F.rlike(c["before"], F.lit(DENYING)))
    touching = F.rlike(c["before"], F.lit(r"[\p{L}\p{N}_]$")) | F.rlike(c["after"], F.lit(r"^[\p{L}\p{N}_]"))
    return F.concat_ws(
        "|", F.when(c["base"], "1").otherwise("-1"), gazetteer.cast("string"), context.cast("string"),
        F.when(touching, "-1").otherwise("1"),
    )


def features(c: Column) -> Column:
    """Names of the classifier's features of a candidate."""
    word = F.lower(F.regexp_extract(c["before"], r"(\p{L}+)\P{L}*$", 1))
    return F.array(
        F.concat(F.lit("kind="), c["kind"].cast("string")),
        F.concat(F.lit("votes="), votes(c)),
        F.concat(F.lit("word="), F.pmod(F.xxhash64(word), F.lit(WORD_BINS)).cast("string")),
        F.concat(F.lit("digits="), F.least(_digits(c["hit"]), F.lit(20)).cast("string")),
    )


def estimate(patterns: dict[str, int], rounds: int = ROUNDS) -> tuple[dict[str, float], list[dict[str, tuple[float, float]]]]:
    """Posteriors of the vote patterns and each labeler's vote rates on true and false spans.

    Starts from the majority vote. Rates are smoothed by one count per vote.
    """
    split = {p: p.split("|") for p in patterns}
    posterior = {p: 1 / (1 + math.exp(-sum(map(int, v)))) for p, v in split.items()}
    rates: list[dict[str, tuple[float, float]]] = []
    for _ in range(rounds):
        true = sum(posterior[p] * n for p, n in patterns.items())
        total = sum(patterns.values())
        rates = []
        for labeler in range(4):
            given = {vote: [1.0, 1.0] for vote in ("-1", "0", "1")}
            for p, n in patterns.items():
                given[split[p][labeler]][0] += posterior[p] * n
                given[split[p][labeler]][1] += (1 - posterior[p]) * n
            rates.append({v: (a / (true + 3), b / (total - true + 3)) for v, (a, b) in given.items()})
        prior = (true + 1) / (total + 2)
        for p, v in split.items():
            odds = math.log(prior / (1 - prior)) + sum(math.log(r[x][0] / r[x][1]) for r, x in zip(rates, v))
            posterior[p] = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
    return posterior, rates


def fit_classifier(candidates: DataFrame) -> dict[str, float]:
    """Log odds per feature, ``prior`` included, from all stored candidates."""
    each = candidates.select(F.explode("candidates").alias("c"))
    counted = each.select(votes(F.col("c")).alias("pattern")).groupBy("pattern").count().collect()
    patterns = {r["pattern"]: r["count"] for r in counted}
    if not patterns:
        return {}
    posterior, _ = estimate(patterns)
    soft = F.from_json(F.lit(json.dumps(posterior)), "map<string,double>")
    # Whole millionths: the sums do not depend on the order of addition.
    rows = (
        each.select(
            F.explode(features(F.col("c"))).alias("feature"),
            F.round(F.element_at(soft, votes(F.col("c"))) * 1_000_000).cast("long").alias("true"),
        )
        .groupBy("feature")
        .agg(F.sum("true").alias("true"), F.count(F.lit(1)).alias("n"))
        .collect()
    )
    true = sum(posterior[p] * n for p, n in patterns.items())
    false = sum(patterns.values()) - true
    model = {"prior": math.log((true + 1) / (false + 1))}
    for r in rows:
        t = r["true"] / 1_000_000
        model[r["feature"]] = math.log((t + 0.5) / (true + 1)) - math.log((r["n"] - t + 0.5) / (false + 1))
    return {k: round(v, 9) for k, v in sorted(model.items())}


def _named(spans: Column) -> Column:
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["kind"].alias("k"), s["start"].alias("s"), s["end"].alias("e"))))
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(
        ",",
        F.transform(
            ordered,
            lambda s: F.concat_ws(":", F.element_at(names, s["k"] + 1), s["s"].cast("string"), s["e"].cast("string")),
        ),
    )


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Counts and digest of the base spans and the names of all spans, per document row."""
    stored = written(find_candidates(docs), "pii-candidates")
    model = fit_classifier(stored)
    weight = F.from_json(F.lit(json.dumps(model)), "map<string,double>")
    logit = lambda c: F.aggregate(
        F.transform(features(c), lambda f: F.coalesce(F.element_at(weight, f), F.lit(0.0))),
        F.lit(float(model.get("prior", 0.0))),
        lambda a, b: a + b,
    )
    split = stored.withColumn("base", F.filter("candidates", lambda c: c["base"])).withColumn(
        "spans", F.filter("candidates", lambda c: F.when(c["base"], F.lit(True)).otherwise(logit(c) > 0))
    )
    count = lambda k: F.size(F.filter("base", lambda c: c["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return split.select(
        "doc_id", *[count(k) for k in range(4)], F.sha2(_named(F.col("base")), 256).alias("base_sha256"),
        _named(F.col("spans")).alias("spans"),
    )
