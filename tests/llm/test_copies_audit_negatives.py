"""Counting quotient filters, exact dedup, the filter audit and hard negatives, against plain versions."""

import re
from collections import Counter, defaultdict
from fractions import Fraction
from hashlib import sha256
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from metapep.llm import exact_dedup, filter_audit, hard_negatives
from metapep.llm import quotient_filter as Q


def counted(keys):
    c = Counter(keys)
    return np.array(sorted(c), np.uint64), np.array([c[k] for k in sorted(c)], np.int64)


@settings(max_examples=150, deadline=None)
@given(st.integers(2, 56).flatmap(lambda b: st.tuples(st.just(b), st.lists(st.tuples(st.integers(0, 2**b - 1), st.integers(1, 3 * 10**9)), max_size=60))))
def test_filter_keeps_everything(case):
    bits, pairs = case
    c = dict(pairs)
    keys, counts = np.array(sorted(c), np.uint64), np.array([c[k] for k in sorted(c)], np.int64)
    got, n = Q.entries(Q.build(keys, counts, bits))
    assert got.tolist() == keys.tolist() and n.tolist() == counts.tolist()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 200), max_size=80), max_size=6))
def test_filters_merge_without_loss(parts):
    merged = Q.merge([Q.build(*counted(p), 8) for p in parts], 8)
    keys, counts = counted([k for p in parts for k in p])
    assert [x.tolist() for x in Q.entries(merged)] == [keys.tolist(), counts.tolist()]
    assert merged == Q.build(keys, counts, 8)


def test_filter_is_small():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 48, 100_000).astype(np.uint64))
    assert len(Q.build(keys, np.ones(len(keys), np.int64), 48)) < 6 * len(keys)


def plain_dedup(rows):
    groups = defaultdict(list)
    for r, (doc_id, text) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc_id is None, doc_id or 0, r, doc_id))
    out = []
    for t, own in groups.items():
        first = min(own)
        out += [(x[4], first[4], len(own), x == first, sha256(t.encode()).hexdigest()) for x in own]
    return sorted(out, key=repr)


COPIES = [(1, "a b"), (2, "ab"), (3, " a\tb\r\n"), (4, None), (5, ""), (6, " \x0b\x0c"), (7, "a b"), (8, "äöü € 𝄞"), (9, "äöü€𝄞 "), (None, "ab "), (None, "lone"), (12, "ab"), (12, "ab"), (13, "x " * 200_000), (14, "x" * 200_000), (15, "A b"), (-5, " a\tb\r\n"), (None, "q"), (None, "q")]


@pytest.mark.parametrize("bits", [4, 48])
def test_exact_dedup(spark, bits):
    rows = COPIES + [(100 + k, f"copy {k % 7}") for k in range(200)] + [(1000 + k, "hot") for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"mark": F.lit(1), "digest": F.lit("x"), "keep_id": F.lit(0)}).repartition(5)
    got = exact_dedup.dedup_exact(df, bits)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_dedup(rows)
    assert exact_dedup.dedup_exact(df.limit(0)).count() == 0


def test_unique_texts_are_not_compared(spark):
    rows = [(k, f"text {k}") for k in range(500)] + [(1000, "text 3"), (1001, "text 4")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    own = df.mapInArrow(lambda it: exact_dedup._hashed(it, 48, False), exact_dedup._ROW)
    again = exact_dedup.repeated_marks(own, len(rows), 48)
    wanted = {int.from_bytes(sha256(t).digest()[:6], "big") for t in (b"text3", b"text4")}
    assert {r.mark for r in again.collect()} == wanted


def plain_audit(docs, labels):
    first, good, toxic = {}, set(), set()
    for d, t, _ in docs:
        if d is not None:
            first[t or ""] = min(first.get(t or "", d), d)
    for d, q, x in labels:
        good |= {d} if q == 1 else set()
        toxic |= {d} if x == 1 else set()
    fails, parts = [], defaultdict(list)
    for k, (d, t, lang) in enumerate(docs):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        own = "A" * (len(w) < 100) + "B" * (100 * len(set(w)) < 80 * len(w)) + "C" * (100 * len(re.findall("[A-Z]", t)) > 10 * len(t)) + "D" * bool(re.search(r"[#$%&*|]", t)) + "E" * (d is not None and first[t] < d)
        fails.append(own)
        parts[lang or ""].append(k)
    out = []
    for part, own in parts.items():
        mine, total = [], Counter()
        for order in permutations("ABCDE"):
            left = list(own)
            for step, f in enumerate(order, 1):
                gone = [k for k in left if f in fails[k]]
                left = [k for k in left if f not in fails[k]]
                total[f] += len(gone)
                redundant = sum(f in fails[k] for k in own) - len(gone)
                known = [docs[k][0] for k in gone if docs[k][0] is not None]
                mine.append((part, "".join(order), step, len(left), len(gone), redundant, sum(fails[k] == f for k in own), sum(d in good for d in known), sum(d in toxic for d in known)))
        out += [(*m, total[m[1][m[2] - 1]]) for m in mine]
    return sorted(out)


def test_audit(spark):
    many = " ".join(f"w{i}" for i in range(120))
    docs = [(1, many, "en"), (2, many, "en"), (3, many, None), (4, None, "en"), (5, "", "de"), (6, "x " * 150, "de"), (7, many + " #", "de"), (8, "UPPER " * 3, "en"), (None, many, "en"), (None, None, ""), (9, "a b", "en"), (9, "a b", "en"), (2, many, "de"), (10, "Ä " + many.upper(), "fr"), (11, "long\x0bword " * 30_000 + "&", "fr")]
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (4, None, 1), (6, 1, 1), (None, 1, 1), (99, 1, 1), (9, 1, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumns({"mask": F.lit(1), "good": F.lit(1), "part": F.lit("x")}).repartition(3)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filter_audit.audit_filters(df, known)
    assert sorted(map(tuple, got.collect())) == plain_audit(docs, labels)
    assert filter_audit.audit_filters(df.limit(0), known).count() == 0
    assert filter_audit.audit_filters(df, known.limit(0)).agg(F.sum("good_lost")).first()[0] == 0


def test_words_in_pieces(monkeypatch):
    rng = np.random.default_rng(5)
    text = b"".join(rng.choice([b"a", b"bb", b"\xc3\xa4", b" ", b"\n", b"\x0b", b"\xc2\xa0"], 5000))
    whole = re.findall(rb"[^\x20\x09-\x0D]+", text)
    for piece in (1, 7, 100, 10**6):
        monkeypatch.setattr(filter_audit, "PIECE", piece)
        assert filter_audit.words_of(text) == (len(whole), len(set(whole)))


def test_shapley_is_the_integral(spark):
    counts = np.random.default_rng(2).integers(0, 50, 8).tolist()
    row = spark.range(1).select(F.array(*[F.lit(c).cast("long") for c in counts]).alias("c"))
    p = filter_audit.removal_polynomial(F.col("c"), 3)
    r = row.select(filter_audit.corners(p, 3).alias("at"), filter_audit.scaled_shapley(p, 3).alias("s")).first()
    assert r["at"] == [sum(c for m, c in enumerate(counts) if m & s) for s in range(8)]
    assert r["s"] == [6 * sum(Fraction(c, m.bit_count()) for m, c in enumerate(counts) if m >> i & 1) for i in range(3)]


def plain_mining(rows, every=100):
    own = []
    for vec_id, label, v in rows:
        if vec_id is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        own.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, [int(np.floor(256 * x)) for x in v]))
    dims = Counter(len(v) for _, _, v in own)
    d = min(dims, key=lambda k: (-dims[k], k)) if dims else 0
    own = [x for x in own if len(x[2]) == d]
    out, clip = [], lambda s: max(-hard_negatives.MOST, min(hard_negatives.MOST, s))
    for a in {(i, lab, tuple(v)) for i, lab, v in own if i % every == 0}:
        score = [(-clip(sum(x * y for x, y in zip(a[2], v))), i, lab) for i, lab, v in own]
        for s, p, _ in sorted(x for x in score if x[2] == a[1] and x[1] != a[0])[:5]:
            fit = sorted(x for x in score if x[2] != a[1] and 30 * -s <= 100 * -x[0] <= 90 * -s)[:10]
            out += [(a[0], p, k, n, -s, -t) for k, (t, n, _) in enumerate(fit, 1)]
    return sorted(out)


def vectors(n, d, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(10, d))
    rows = [(k, int(rng.integers(10)), (centres[rng.integers(10)] + 0.3 * rng.normal(size=d)).round(2).tolist()) for k in range(n)]
    rows = [(i, lab, rows[0][2] if i % 3 == 0 else v) for i, lab, v in rows]  # one vector that a third shares
    return rows


def mined(spark, rows, **k):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumns({"id": F.lit(1), "ask": F.lit(2), "v": F.lit(3)}).repartition(4)
    return sorted(map(tuple, hard_negatives.mine(df, **k).collect()))


@pytest.mark.parametrize("block", [3, 2048])
def test_hard_negatives(spark, monkeypatch, block):
    rows = vectors(900, 6)
    inf, nan = float("inf"), float("nan")
    odd = [(None, 1, [1.0] * 6), (1100, None, [1.0] * 6), (1200, 1, None), (1300, 1, [nan] + [0.0] * 5), (1400, 1, [inf] * 6), (1500, 1, [None] + [0.0] * 5), (1600, 1, [1.0, 2.0]), (1700, 1, []), (1800, 2, [0.0] * 6), (100, 3, rows[100][2]), (100, rows[100][1], rows[100][2]), (-700, 4, [-0.5] * 6), (1901, 9, rows[5][2]), (1901, 9, rows[5][2])]
    got = mined(spark, rows + odd, block=block)
    assert got == plain_mining(rows + odd) and len(got) > 200


def test_hard_negatives_huge_and_few(spark):
    big = [(k, k % 3, [10.0 ** (k % 40), -1.5, 0.001 * k]) for k in range(0, 300, 5)]
    assert mined(spark, big) == plain_mining(big)
    assert mined(spark, [(100, 1, [1.0])]) == [] and mined(spark, [(101, 1, [1.0])]) == []
    few = [(100, 1, [1.0]), (1, 1, [1.0]), (2, 2, [0.5])]
    assert mined(spark, few) == plain_mining(few) == [(100, 1, 1, 2, 65536, 32768)]
    df = spark.createDataFrame(few, "vec_id long, label int, embedding array<double>")
    assert hard_negatives.mine(df.limit(0)).count() == 0


def test_tree_prunes_and_bounds():
    x = np.floor(256 * np.array([v for _, _, v in vectors(5000, 8, 4)]))
    tree, q = hard_negatives.BallTree(x), x[::500]
    low, high = tree.bounds(q)
    for node, (a, b) in enumerate(tree.range):
        s = q @ x[tree.order[a:b]].T
        assert (s >= low[:, [node]]).all() and (s <= high[:, [node]]).all()
    leaves = [k for k, v in enumerate(tree.below) if v is None]
    assert sorted(tree.order) == list(range(5000)) and all(tree.range[k][1] - tree.range[k][0] <= hard_negatives.LEAF for k in leaves)
    # a narrow window opens few leaves
    top = np.sort(q @ x.T, 1)[:, -5]
    assert (high[:, leaves] >= top[:, None]).mean() < 0.6
