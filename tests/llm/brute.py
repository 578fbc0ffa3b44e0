"""Plain versions of the operators, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def decontaminate(docs, items):
    windows = defaultdict(set)
    for i, t in items:
        w = ALNUM.findall(lower(t or ""))
        for k in range(max(1, len(w) - 9)):
            if w:
                windows[tuple(w[k : k + 10])].add("null" if i is None else str(i))
    out = []
    for d, t in docs:
        w = ALNUM.findall(lower(t or ""))
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[x]
        out.append((d, len(w), len(hit), sorted(found)))
    return out


def dedup(docs):
    words = [(d, SPACE.findall(t or "")) for d, t in docs]
    first = {}
    for d, w in words:
        for i in range(len(w) - 12):
            if d is not None:
                k = tuple(w[i : i + 13])
                first[k] = min(d, first.get(k, d))
    out = []
    for d, w in words:
        gone = {j for i in range(len(w) - 12) for j in range(i, i + 13) if d is not None and first[tuple(w[i : i + 13])] < d}
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def shingles(text):
    w = SPACE.findall(lower(text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def jaccard(docs, threshold=75):
    sets = {}
    for d, t in docs:
        if d is not None:
            sets.setdefault(d, []).append(shingles(t))
    by = defaultdict(set)
    for d, many in sets.items():
        for s in many:
            for x in s:
                by[x].add(d)
    up = {d: d for d in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for d, many in sets.items():
        for s in many:
            near = Counter(e for x in s for e in by[x] if e < d)
            for e in near:
                for o in sets[e]:
                    both = len(s & o)
                    if both and 100 * both >= threshold * len(s | o):
                        a, b = sorted((top(d), top(e)))
                        up[b] = a
    return [(d, len(shingles(t)), None if d is None and shingles(t) else d if d is None else top(d) if shingles(t) else d) for d, t in docs]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def html_scores(blocks, threshold=0.25):
    """blocks: (path as a tuple of names, text, linked characters) in page order; the texts that the path ratios choose, headings aside."""
    mark = re.compile(r"[.,;:!?…。，、；：！？؟،]")
    paths = sorted({p for p, _, _ in blocks})
    counted = {p: [(t, k) for q, t, k in blocks if q == p] for p in paths}
    full = {p: [(max(0, len(t) - k), len(mark.findall(t))) for t, k in own if k < 0.7 * len(t)] for p, own in counted.items()}
    size = {p: len(own) for p, own in counted.items()}
    chars = {p: sum(c for c, _ in own) for p, own in full.items()}
    ratio = {p: chars[p] / size[p] * (1 + sum(k for _, k in full[p]) / size[p]) ** 0.5 for p in paths}

    def above(path):
        return path[:-1] if path else None

    def below(parent):
        own = [p for p in paths if above(p) == parent]
        return sum(ratio[p] * size[p] for p in own), sum(size[p] for p in own), sum(chars[p] for p in own)

    most = max((below(above(p))[2] for p in paths), default=0)
    score = {}
    for p in paths:
        parts, beside = [(0.6, ratio[p])], 0
        for up, weight, share in ((above(p), 0.3, 1), (above(p[:-1]) if p else None, 0.1, 0.3))[: 2 if p else 1]:
            total, n, text = below(up)
            if n:
                parts.append((weight, total / n))
                beside = max(beside, share * text)
        score[p] = sum(w * x for w, x in parts) / sum(w for w, _ in parts) * (beside / most) ** 1.5 if ratio[p] else 0
    top = max(score.values(), default=0)
    return [t for p, t, _ in blocks if top > 0 and score[p] >= threshold * top]
