"""Decontamination, substring dedup, Jaccard join and license scans against plain versions, with odd rows."""

import random

import pytest
from pyspark.sql import functions as F

from metapep.llm import license_scan
from metapep.llm.components import components
from metapep.llm.decontamination import decontaminate
from metapep.llm.jaccard_join import _least_difference, _parity, jaccard_join, overlaps
from metapep.llm.substring_dedup import dedup_substrings

from .brute import ALNUM, decontaminate as plain_decontaminate, dedup as plain_dedup, jaccard as plain_jaccard, lower


def corpus(seed: int = 4, n: int = 60) -> list[tuple]:
    rng = random.Random(seed)
    word = lambda: rng.choice("alpha Beta gamma, délta ε 7 the THE of x-y z.".split())
    base = [[word() + str(rng.randrange(30)) for _ in range(rng.randrange(5, 90))] for _ in range(n // 3)]
    rows: list[tuple] = []
    for w in base:
        rows.append((len(rows), " ".join(w)))
        near = list(w)
        for _ in range(rng.randrange(4)):
            near[rng.randrange(len(near))] = word()
        rows.append((len(rows), "\n".join(near)))
        rows.append((len(rows), "\t ".join(rng.choice(base)[5:40] + [word() for _ in range(rng.randrange(30))])))
    k = len(rows)
    rows += [(k, None), (k + 1, ""), (k + 2, " \n\t "), (k + 3, rows[0][1]), (k + 4, rows[0][1]), (k + 5, "one"), (k + 6, "ONE"), (k + 7, "a b " * 4000), (None, rows[0][1]), (None, None), (k + 8, "x" * 100_000), (3, rows[3][1])]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"n_words": F.lit(1), "n": F.lit("clash"), "items": F.lit(2), "kept": F.lit(3), "base": F.lit(4), "component_id": F.lit(5)})
    return rows, df.repartition(5).cache()


def test_decontamination(spark, docs, monkeypatch):
    rows, df = docs
    items = [(i, " ".join(rows[i][1].split()[2:30])) for i in range(0, 12)] + [(50, "alpha7"), (51, "the of"), (52, None), (53, ""), (None, rows[1][1]), (54, "ONE"), (0, rows[0][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(plain_decontaminate(rows, items), key=repr)
    spans = []
    for block, bits in ((1000, 1 << 28), (40, 1 << 28), (40, 1 << 15)):  # sent whole; by shuffle; with a filter that lets more pass
        monkeypatch.setattr("metapep.llm.decontamination.FILTER_BITS", bits)
        got = decontaminate(df, bench, keep=("doc_id", "text"), block=block).collect()
        assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got), key=repr) == want
        assert all(sum(s["last"] - s["first"] + 1 for s in r.spans) == r.n_hit for r in got)
        spans.append(sorted(((r.doc_id, r.text, r.spans) for r in got), key=repr))
    assert spans[0] == spans[1] == spans[2]
    assert decontaminate(df.limit(0), bench, block=40).count() == 0
    assert decontaminate(df, bench.limit(0)).filter("n_hit > 0").count() == 0
    assert decontaminate(df.limit(0), bench).count() == 0
    with pytest.raises(ValueError):
        decontaminate(df, bench, keep=("items",))


def test_substring_dedup(docs):
    rows, df = docs
    got = sorted(map(tuple, dedup_substrings(df).collect()), key=repr)
    assert got == sorted(plain_dedup(rows), key=repr)
    assert sum(r[2] for r in got) > 100
    assert dedup_substrings(df.limit(0)).count() == 0
    assert all(len(r.kept) == 64 for r in dedup_substrings(df, digest=True).collect())


def test_jaccard_join(docs):
    rows, df = docs
    got = sorted(map(tuple, jaccard_join(df).collect()), key=repr)
    assert got == sorted(plain_jaccard(rows), key=repr)
    assert len({r[2] for r in got}) < len(rows) - 10
    assert jaccard_join(df.limit(0)).count() == 0


def test_near_copies_in_many_parts(spark, monkeypatch):
    """A group that is many parts, with members on either side of the threshold."""
    import metapep.llm.jaccard_join as j

    monkeypatch.setattr(j, "PART", 8)
    rng = random.Random(8)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for i in range(70):
        w = list(base)
        for _ in range(rng.randrange(7)):
            w[rng.randrange(60)] = f"v{rng.randrange(10_000)}"
        rows.append((i, " ".join(w)))
    got = sorted(map(tuple, jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == sorted(plain_jaccard(rows))
    assert 1 < len({r[2] for r in got}) < 70


@pytest.mark.parametrize("sent", [0, 2_000_000])
def test_copies_before_the_least_of_their_class(spark, monkeypatch, sent):
    import metapep.llm.jaccard_join as j

    monkeypatch.setattr(j, "SENT_IDS", sent)
    words = [f"w{i}" for i in range(100)]
    text, near = " ".join(words), " ".join([*words[:-3], "x", "y", "z"])
    rows = [(10, text), (11, text), (1, text), (2, near), (12, near), (3, "other " + text[::-1])]
    got = jaccard_join(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    assert sorted(map(tuple, got.collect())) == sorted(plain_jaccard(rows))
    assert {r.doc_id for r in got.filter("component_id = 1").collect()} == {1, 2, 10, 11, 12}


def test_ids_that_repeat_with_other_texts(spark):
    """Each text of an id has its own links; copies, near copies and texts of the same id in any order."""
    words = [f"w{i}" for i in range(100)]
    text, near = " ".join(words), " ".join([*words[:-3], "x", "y", "z"])
    one, two = (" ".join(f"{k}{i}" for i in range(60)) for k in "ab")
    rows = [(5, text), (5, one), (7, near), (8, one + " end"), (3, two), (4, two), (4, "q " + near), (9, one), (9, "alone " + text[::-1]), (11, two + " x"), (12, None), (12, one), (6, "nothing else"), (6, "NOTHING else")]
    got = jaccard_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    # all rows of an id are one document
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain_jaccard(rows), key=repr)
    assert {r.component_id for r in got.filter("n_shingles > 10").collect()} == {3}


@pytest.mark.parametrize("sent", [0, 1 << 24])
def test_every_join_by_shuffle(spark, monkeypatch, docs, sent):
    """With broadcasts shut off and ids in descending order."""
    import metapep.llm.jaccard_join as j
    from metapep import storage

    monkeypatch.setattr(j, "SENT_IDS", sent)
    monkeypatch.setattr(storage, "BROADCAST_BYTES", sent)
    rows = docs[0]
    df = spark.createDataFrame(sorted(rows, key=lambda r: -(r[0] or 0)), "doc_id long, text string").coalesce(2)
    assert sorted(map(tuple, jaccard_join(df).collect()), key=repr) == sorted(plain_jaccard(rows), key=repr)


def test_texts_of_one_template(spark, monkeypatch):
    """The rows of the join before the bounds grow with the documents, not with their square."""
    import metapep.llm.jaccard_join as j

    monkeypatch.setattr(j, "FREQUENT", 5)
    counted = []
    ask_pairs = j.ask_pairs

    def counting(*x):
        counted.append(ask_pairs(*x).count())
        return ask_pairs(*x)

    monkeypatch.setattr(j, "ask_pairs", counting)
    shared = " ".join(f"w{i}" for i in range(84))
    sizes = (400, 800)
    for n in sizes:
        rows = [(i, f"{shared} " + " ".join(f"v{i}_{k}" for k in range(24 + i % 5))) for i in range(n)]
        got = jaccard_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
        assert got.filter("doc_id = component_id").count() == n
    assert counted[1] <= 2.5 * max(counted[0], sizes[0])


def test_parities_never_exceed_the_difference():
    import numpy as np

    rng = np.random.default_rng(1)
    for _ in range(200):
        pool = rng.integers(0, 1 << 63, 300).astype(np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 200))) for _ in range(2))
        assert _least_difference(_parity(a), _parity(b)) <= len(np.setxor1d(a, b))
        assert overlaps([a, b])[0, 1] == len(np.intersect1d(a, b))


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (200, 200), (5, 60)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(41)}, 60: 0, 100: 100, 101: 100, 103: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_license_scan(spark, docs):
    rows, odd = docs
    more = [(1000, "x MIT\nLicense. Released under the MIT License"), (1001, "general public LICENSE, apache license mit license"), (1002, "Licensed under CC BY-NC 4.0."), (1003, "licensed under cc by"), (1004, "filler " * 40 + "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated files"), (1005, "apache"), (1006, "mit license" + " y" * 5000 + " mit license")]
    bodies = [(t, label) for t, label in license_scan.TEMPLATES if len(set(t.split())) > 71]
    assert len(bodies) >= 2
    more += [(1100 + k, "filler " * (37 * k + 50) + t.replace(" the ", " The, ", 3).replace(" software ", " program ", 2) + " more" * 90) for k, (t, _) in enumerate(bodies)]
    df = spark.createDataFrame(rows + more, "doc_id long, text string").withColumn("base", F.lit(1))
    got = {}
    for r in license_scan.license_scan(df, keep=("doc_id", "text")).collect():
        w = ALNUM.findall(lower(r.text or ""))
        assert r.n_words == len(w)
        base = sorted((i, label) for p, label in license_scan.PHRASES for i in range(len(w)) if w[i : i + len(p.split())] == p.split())
        assert [(x.first, x.label) for x in r.base] == base
        met = set()
        for t, label in license_scan.TEMPLATES:
            size, words = max(64, 2 * len(t.split())), set(t.split())
            for i in range(0, max(1, len(w) - size // 2), size // 2):
                have = set(w[i : i + size])
                if len(have & words) >= 0.9 * len(words) - 1e-9:
                    met.add((i, label, len(have & words) / len(words)))
        assert {(x.first, x.label, x.containment) for x in r.blocks} == met
        got[r.doc_id] = {x.label for x in r.blocks}
    assert got[1000] == {"mit"} and got[1002] == {"cc-by-nc", "cc-by"} and got[1003] == set() and got[1004] == {"mit"} and not got[1005]
    assert all(label in got[1100 + k] for k, (_, label) in enumerate(bodies))
    assert license_scan.license_scan(odd.limit(0)).count() == 0
