"""Plain Python versions of the contracts, for small tables."""

import collections
import hashlib
import math
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def repeats(docs: dict, width: int = 100) -> dict:
    seen, out = set(), {}
    for i in sorted(docs):
        raw = (docs[i] or "").encode()
        marks = bytearray(len(raw))
        for p in range(len(raw) - width + 1):
            window = raw[p : p + width]
            if window in seen:
                marks[p : p + width] = b"\1" * width
            seen.add(window)
        spans = sum(1 for k in range(len(marks)) if marks[k] and (k == 0 or not marks[k - 1]))
        kept = bytes(x for x, y in zip(raw, marks) if not y)
        out[i] = (len(raw), sum(marks), spans, hashlib.sha256(kept).hexdigest())
    return out


def quality_base(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    counts = collections.Counter(tuple(words[i : i + 8]) for i in range(n - 7))
    marks = [0] * n
    for i in range(n - 7):
        if counts[tuple(words[i : i + 8])] > 1:
            marks[i : i + 8] = [1] * 8
    lines = [line for line in text.split("\n") if WORD.search(line)]
    repeated = sum(marks)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), repeated, n < 20 or 100 * repeated > 30 * n


def conversations(rows: list) -> dict:
    """Rows are (conv_id, turn, role, text)."""
    found = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        found[conv].append((turn, role or "", text or ""))
    out = {}
    for conv, turns in found.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        out[conv] = (len(turns), _sha(said), len(loss), _sha(loss))
    return out


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def contamination(docs: dict, items: dict, window: int = 10) -> dict:
    words = lambda t: BENCH_WORD.findall((t or "").translate(UPPER))
    windows = collections.defaultdict(set)
    for name, text in items.items():
        w = words(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows[tuple(w[i : i + size])].add(str(name))
    sizes = {len(k) for k in windows}
    out = {}
    for i, text in docs.items():
        w = words(text)
        hit, met = set(), set()
        for size in sizes:
            for p in range(len(w) - size + 1):
                found = windows.get(tuple(w[p : p + size]))
                if found:
                    hit.update(range(p, p + size))
                    met |= found
        out[i] = (len(w), len(hit), len(met), _sha(",".join(sorted(met))), bool(hit))
    return out


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def personal_data(text: str | None) -> str:
    out = []
    for order, (kind, pattern) in enumerate(PII.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and _luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((order, m.start(), f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x for _, _, x in sorted(out))


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def shingles(text: str | None) -> set:
    w = WORD.findall((text or "").translate(UPPER))
    if len(w) < 4:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 4]) for i in range(len(w) - 3)}


def near_copies(docs: dict, percent: int = 85) -> dict:
    sets = {i: shingles(t) for i, t in docs.items()}
    parent = {i: i for i in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(docs)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if common and 100 * common >= percent * len(sets[a] | sets[b]):
                    x, y = root(a), root(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def nearest(rows: list, top: int = 20, every: int = 20) -> list:
    """Per query row its id and the exact (score, vec_id) list; rows are (vec_id, vector)."""
    sizes = collections.Counter()
    sound = []
    for i, v in rows:
        if v and all(x is not None and x - x == 0 for x in v) and any(v):
            sound.append((i, v))
            sizes[len(v)] += 1
    if not sound:
        return []
    size = max(sizes, key=lambda n: (sizes[n], n))
    sound = [(i, v) for i, v in sound if len(v) == size]
    out = []
    for at, (i, v) in enumerate(sound):
        if i is None or i % every:
            continue
        scored = []
        for other, (j, w) in enumerate(sound):
            if other != at:
                score = 0.0
                for x, y in zip(v, w):
                    score += x * y
                scored.append((score, j))
        scored.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        out.append((i, scored[:top]))
    return out


def merkle_root(nodes: list) -> str:
    while len(nodes) > 1:
        nodes = [_sha("".join(nodes[i : i + 3])) for i in range(0, len(nodes), 3)]
    return nodes[0]


TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def fill_in_middle(i, text: str | None) -> tuple:
    """(n, form, prefix_chars, middle_chars, output)."""
    text = text or ""
    sha = _sha("42:" + ("" if i is None else str(i)))
    h1, h2, h3, h4 = (int(sha[8 * k : 8 * k + 8], 16) for k in range(4))
    w = TOKEN.findall(text)
    n = len(w)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(w[:a]), "".join(w[a:b]), "".join(w[b:])
    if h4 % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def _crc(i) -> int:
    return zlib.crc32(str(i).encode())


def _md5(i) -> str:
    return hashlib.md5(str(i).encode()).hexdigest()


def languages(docs: list, most: int = 400, sample: int = 400) -> list:
    """(doc_id, language, score) per (doc_id, text, lang)."""

    def ranks(texts) -> list:
        counts = collections.Counter()
        for text in texts:
            if text:
                chars = [c if c.isalpha() else " " for c in f" {text.lower()} "]
                for k in range(len(chars)):
                    counts.update(["".join(chars[k : k + 1])] if chars[k] != " " else [])
                    two, three = chars[k : k + 2], chars[k : k + 3]
                    counts.update(["".join(two)] if len(two) == 2 and two != [" ", " "] else [])
                    counts.update(["".join(three)] if len(three) == 3 and three[1] != " " else [])
        # Ties by code points, the n-gram read as a number.
        number = lambda g: sum(ord(c) << 21 * (len(g) - 1 - k) for k, c in enumerate(g))
        return sorted(counts, key=lambda g: (-counts[g], number(g)))[:most]

    known = collections.defaultdict(dict)
    for i, text, lang in docs:
        if i is not None and lang is not None and _crc(i) % 4 != 2:
            texts = known[lang].setdefault(i, [])
            texts += [text] if text is not None else []
    profiles = {}
    for lang, ids in known.items():
        chosen = sorted(ids, key=_md5)[:sample]
        profiles[lang] = {g: r for r, g in enumerate(ranks(min(ids[i]) if ids[i] else None for i in chosen))}
    profiles = {lang: p for lang, p in profiles.items() if p}
    out = []
    for i, text, _ in docs:
        own = ranks([text])
        if not own or not profiles:
            out.append((i, "und", 0.0))
            continue
        far = {lang: sum(abs(p[g] - r) if g in p else most for r, g in enumerate(own)) for lang, p in profiles.items()}
        best = min(sorted(far), key=far.get)
        out.append((i, best, 1 - far[best] / (most * len(own))))
    return out


def toxicity(docs: list, labels: dict, fold, least: int = 4, weight: float = 2.5, confidence: float = 1.64) -> list:
    """(doc_id, score) per (doc_id, text); ``fold`` is the folding of characters under test elsewhere."""
    term = re.compile(r"[^\W_]+")
    texts = collections.defaultdict(list)
    for i, text in docs:
        if i in labels and _crc(i) % 5:
            texts[i].append(text)
    sample = [(min((t or "" for t in ts), key=_md5), labels[i]) for i, ts in texts.items()]
    contexts = collections.defaultdict(set)
    for text, toxic in sample:
        found = term.findall(fold(text))
        for pair in zip(found, ["", *found]):
            contexts[pair].add(toxic)
    bad, other = collections.Counter(), collections.Counter()
    for (t, _), seen in contexts.items():
        bad[t] += max(seen)
        other[t] += 1 - min(seen)
    all_bad, all_other = sum(bad.values()), sum(other.values())
    lexicon = {}
    for t in bad if all_bad and all_other else ():
        w = math.log((bad[t] + 0.5) / (all_bad + 1)) - math.log((other[t] + 0.5) / (all_other + 1))
        sure = w - confidence * math.sqrt(1 / (bad[t] + 0.5) + 1 / (other[t] + 0.5))
        if bad[t] >= least and len(t) >= 3 and sure >= weight and bad[t] >= 2 * other[t]:
            lexicon[t] = w
    spared = {f"{b} {t}" for (t, b), seen in contexts.items() if t in lexicon and b and seen == {0}}

    def strength(text) -> float:
        folded = fold(text)
        covered = []
        for phrase in spared:
            at = folded.find(phrase)
            while at >= 0:
                whole = not folded[at - 1 : at].isalnum() if at else True
                if whole and not folded[at + len(phrase) : at + len(phrase) + 1].isalnum():
                    covered.append((at, at + len(phrase)))
                at = folded.find(phrase, at + 1)
        total = 0.0
        for m in re.finditer(r"(?:(?!_)\w)+", folded):
            if m[0] in lexicon and not any(s <= m.start() and m.end() <= e for s, e in covered):
                total += lexicon[m[0]]
        return total / math.log(math.e + len(re.findall("[ \t\n\r]", text or "")))

    if not lexicon:
        return [(i, 0.0) for i, _ in docs]
    points = [(strength(t), y) for t, y in sample]
    a, b = 0.0, 1.0
    for _ in range(400):
        p = [1 / (1 + math.exp(-(a + b * x))) for x, _ in points]
        ga = sum(q - y for q, (_, y) in zip(p, points))
        gb = sum((q - y) * x for q, (x, y) in zip(p, points)) + 1e-3 * b
        aa = sum(q * (1 - q) for q in p) + 1e-3
        bb = sum(q * (1 - q) * x * x for q, (x, _) in zip(p, points)) + 1e-3
        ab = sum(q * (1 - q) * x for q, (x, _) in zip(p, points))
        det = aa * bb - ab * ab
        a -= max(-2.0, min(2.0, (bb * ga - ab * gb) / det))
        b -= max(-2.0, min(2.0, (aa * gb - ab * ga) / det))
    return [(i, 1 / (1 + math.exp(-(a + b * strength(t))))) for i, t in docs]
