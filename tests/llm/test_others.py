"""Surrogates, scoring, HTML text, language, neighbours, mixing and the pipeline."""

import json
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from metapep.llm import html_text, language, neighbours, pseudo_likelihood, surrogates
from metapep.llm import words as W
from metapep.llm.mixing import mix

from . import brute_surrogates
from .brute import SPACE, decontaminate, html_scores, jaccard


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


PII = "Write a.b34@mail7.example.com or +1 (017) 555-7713, host 10.1.2.3, card 4111111111111111 or 4111 1111 1111 1111, v 2.0. token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\""


def test_surrogates(spark):
    rows = [(1, PII), (2, None), (3, ""), (4, "4.0. at 1.2.3.4.5 on 2020-01-01, 12,5 and 4111111111111112, nothing"), (5, PII), (6, "Frau Anna Schmidt, г-жа Анна Петрова, A.B34@MAIL7.EXAMPLE.COM and Anna Schmidt"), (7, "10.1.2.3"), (8, "x " * 60_000 + "10.1.2.3"), (None, "ssn 123-45-6789 iban DE89370400440532013000, GB82 WEST 1234 5698 7654 32"), (9, "\u0001 10.1.2.3 \u0001"), (10, "192.168.3.4 172.20.1.1 127.0.0.1 239.1.1.1 8.8.8.8 Dr. Žu Kovač, Mr O'Neill-Smith, sk-abcdefghijklmnopqrstuv")]
    df = frame(spark, rows).withColumn("n_entities", F.lit(9)).repartition(3)
    got = defaultdict(list)
    for r in surrogates.pseudonymise(df, "key").collect():
        got[r.doc_id].append((r.text, r.n_entities))
    assert all(got[d] == [brute_surrogates.pseudonymise(t, "key")] for d, t in rows)
    text, n = got[1][0]
    assert n == 6 and not re.search(r"a\.b34|017|10\.1\.2\.3|4111|04dbe", text) and "555-" in text and "v 2.0." in text
    one, four = re.search(r"card (\d{16}) or ([\d ]{19})", text).groups()
    assert one == four.replace(" ", "") and brute_surrogates.luhn(one)
    assert got[4] == [(rows[3][1], 0)] and got[7][0][0] in text and got[8][0][0].endswith(got[7][0][0])
    lady, other, mail = got[6][0][0].split(", ")
    assert mail.split(" and ")[0].lower() in text and lady == "Frau " + mail.split(" and ")[1] and lady.split()[1] in surrogates.GIVEN[0] and other.split()[1] in surrogates.GIVEN[2]
    for iban in re.search("iban (.*), (.*)$", got[None][0][0]).groups():
        bare = iban.replace(" ", "")
        assert int("".join(str(int(x, 36)) for x in bare[4:] + bare[:4])) % 97 == 1
    assert re.match(r"192\.168\.\d+\.\d+ 172\.(1[6-9]|2\d|3[01])\.\d+\.\d+ 127\.\S+ 2[23]\d\.", got[10][0][0])
    assert surrogates.pseudonymise(df.limit(0), "key").count() == 0
    with pytest.raises(ValueError):
        surrogates.pseudonymise(df, "")


def test_surrogate_key(spark):
    key = surrogates.secret_key(spark)
    assert len(key) == 64 and surrogates.secret_key(spark) == key
    spark.conf.set(surrogates.KEY_SETTING, "mine")
    assert surrogates.secret_key(spark) == "mine"
    spark.conf.unset(surrogates.KEY_SETTING)
    df = frame(spark, [(1, PII)])
    assert surrogates.pseudonymise(df, "mine").first().text != surrogates.pseudonymise(df, key).first().text


def test_surrogates_are_distinct(spark):
    """Forms of few members collide and are tried again, up to forms that are used up."""
    rows = [(i, f"+1 (000) 555-{i:04d}; 10.0.{i % 256}.{i // 256}; u.{i % 100:02d}@mail{i // 100 % 10}.example.com") for i in range(3000)]
    rows += [(3000 + i, f"{a}@example.com") for i, a in enumerate("abcdefghijklmnopqrstuvwxyz0123456789")] + [(4000 + i, f"+1 {i // 100:02d} {i % 100:02d}") for i in range(600)]
    fixed = ["%@example.com", "_@example.com", "-@example.org", "张伟@example.com", "محمد@example.net", "Dr Šu", "Dr Žu Ša", "Dr Su", "Dr Tu"]
    rows += [(9000, "; ".join(fixed)), (9001, "none"), (9002, None), (9003, "to %@example.com."), (9003, "to %@example.com."), (None, "Dr Šu and %@example.com")]
    got = defaultdict(list)
    for r in surrogates.pseudonymise(frame(spark, rows).repartition(3), "some key").collect():
        got[r.doc_id].append(r.text)
    of = {}
    for d, t in rows:
        if d is not None and d < 9000:
            for a, b in zip(t.split("; "), got[d][0].split("; "), strict=True):
                assert of.setdefault(a, b) == b and a != b
    assert len(of) > 7000 and len(set(of.values())) == len(of)
    first = got[9000][0].split("; ")
    assert len(first) == len(fixed) == len(set(first)) and all(a != b for a, b in zip(first, fixed))
    assert got[9003] == [f"to {first[0]}."] * 2 and got[None] == [f"{first[5]} and {first[0]}"] and got[9001] == ["none"] and got[9002] == [None]


def test_form_that_is_used_up(spark):
    """All members of a form without a wide one: each has a surrogate, and none of another's."""
    rows = [(i, f"169.254.{i}.{j}") for i in range(1) for j in range(256)] + [(5, "169.254.0.2 169.254.7.7")]
    own = spark.createDataFrame(rows, "doc_id long, text string")
    one = surrogates.surrogate(F.lit("078-05-1120"), "k", surrogates.LAST)
    assert re.fullmatch("ssn-[a-z]{24}", own.select(one).first()[0])
    got = [r.text for r in surrogates.pseudonymise(own, "k").collect()]
    assert len(set(got)) == len(got) == len(rows)


def test_no_entity_is_left_behind(spark, tmp_path):
    """Neither the entities of the texts nor those that needed another try are on the shared folder after the query."""
    from pathlib import Path

    from metapep.storage import shared_dir

    rows = [(i, f"u.{i:05d}@example.com") for i in range(150)] + [(700 + i, f"{a}@example.com") for i, a in enumerate("abcdefghijklmnopqrstuvwxyz")]
    top = Path(shared_dir(spark).removeprefix("file:"))
    before = {f for f in top.rglob("*") if f.is_file()}
    got = surrogates.pseudonymise(frame(spark, rows), "k").collect()
    assert len({r.text for r in got}) == len(rows)
    left = [f for f in top.rglob("*") if f.is_file() and f not in before]
    assert left and not any(f.name.endswith(".parquet") for f in left)  # digests and surrogates of second tries
    data = b"".join(f.read_bytes() for f in left)
    assert not [t for d, t in rows if d < 700 and t.encode() in data]


def test_pseudo_likelihood(spark):
    rng = np.random.default_rng(0)
    rows = [(i, " ".join(f"{a} {a}x {a}y" for a in rng.choice(list("abcdef"), 40))) for i in range(200)] + [(900, None), (901, ""), (902, "."), (903, "a"), (904, "x " * 30_000), (None, "a ax ay"), (0, "a ax ay")]
    df = frame(spark, rows).withColumn("n_tokens", F.lit("clash")).repartition(3)
    fitted = pseudo_likelihood.fit(df)
    got = defaultdict(list)
    for r in pseudo_likelihood.score(df, fitted).collect():
        got[r.doc_id].append(tuple(r)[1:])
    assert got[900] == got[901] == got[902] == [(0, 0.0, None)] and got[903][0][0] == 1 and got[904][0][0] == 30_000 and len(got[0]) == 2
    vocabulary, model = fitted
    first = rows[5][1]
    ids = vocabulary.ids(word_hashes(first))
    p = {name: pseudo_likelihood.part(model, name).astype(float) for name in pseudo_likelihood._PARTS}
    soft = lambda x: x - np.log(np.exp(x).sum())
    total = 0.0
    for i, t in enumerate(map(int, ids)):
        x = p["bias"][0] + sum(p["scale"][k] * p["table"][ids[i + d] if 0 <= i + d < len(ids) else pseudo_likelihood.PAD] for k, d in enumerate(pseudo_likelihood.SIDES))
        h = np.tanh(x)
        n = pseudo_likelihood.WIDTH
        c, g = t // n**2, t // n
        total += soft(h @ p["w1"] + p["b1"][0])[c] + soft((h + p["s2"][c]) @ p["w2"] + p["b2"][c])[g % n] + soft((h + p["s3"][g]) @ p["w3"] + p["b3"][g])[t % n]
    assert got[5][0][1] == pytest.approx(total, rel=1e-3)
    mixed_up = frame(spark, [(1, " ".join(rng.permutation(first.split())))])
    assert pseudo_likelihood.score(mixed_up, fitted).first().log_likelihood < total
    assert pseudo_likelihood.score(df.limit(0), pseudo_likelihood.fit(df.limit(0))).count() == 0


def word_hashes(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    starts, ends, _ = W.spans(raw, np.array([0, len(raw)]), "alnum")
    return W.hashes(raw, starts, ends, True)


def test_gradient_is_that_of_the_score():
    rng = np.random.default_rng(2)
    m = pseudo_likelihood
    model = m.initial().astype(np.float64) + rng.standard_normal((m.ROWS, m.WIDTH)) * 0.1
    ids = rng.integers(0, m.PAD, 20)
    around = m._around(ids, np.array([0, 12, 20]))
    rows, values = m.gradient(model, around, ids)
    assert len(np.unique(rows)) == len(rows)
    for name in m._PARTS:
        own = np.flatnonzero((rows >= m._AT[name]) & (rows < m._AT[name] + m._PARTS[name]))
        for k in rng.choice(own, min(3, len(own)), replace=False):
            value = []
            for e in (1e-5, -1e-5):
                other = model.copy()
                other[rows[k], 7] += e
                value.append(m._forward(other, around, ids)[0].mean())
            assert (value[0] - value[1]) / 2e-5 == pytest.approx(values[k, 7], rel=1e-2, abs=1e-7)


def test_held_out_texts_are_likelier_than_by_frequency(spark):
    """Against a smoothed unigram model, on rows that taught nothing; and the partitions of the input hardly matter."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").dropDuplicates(["text"]).orderBy("doc_id").cache()
    taught, held = docs.filter("doc_id % 5 <> 0"), docs.filter("doc_id % 5 = 0")
    fits = [pseudo_likelihood.fit(taught.repartition(n, "doc_id")) for n in (2, 6)]
    scored = [sorted(map(tuple, pseudo_likelihood.score(held, f).collect())) for f in fits]
    tokens = sum(r[1] for r in scored[0])
    counts = Counter(w for r in taught.collect() for w in word_hashes(r.text or " ").tolist())
    n, kinds = sum(counts.values()), len(counts)
    plain = sum(np.log((counts.get(w, 0) + 0.1) / (n + 0.1 * (kinds + 1))) for r in held.collect() for w in word_hashes(r.text or " ").tolist())
    one, two = (sum(r[2] for r in s) for s in scored)
    print(one / tokens, two / tokens, plain / tokens)
    assert one > plain and two > plain
    assert abs(one - two) < 0.1 * tokens and sum(abs(a[2] - b[2]) for a, b in zip(*scored)) < 0.1 * tokens


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no</p>";</script></head><body class="has-sidebar"><header><h1>Site</h1></header>
<nav><ul><li><a href="/a">Home, sweet home.</a></li></ul></nav><div class="cookie-notice">We use cookies, as you know. Accept them.</div><!-- <p>no</p> -->
<article><h1>Title &amp; more</h1><p>First  paragraph,\nwith <b>bold</b>&nbsp;text &lt;tag&gt;.<br>Next line.<p>Second one &eacute;&#233;, unclosed; and long enough to count. <ul><li>An item</li></ul></article>
<aside>Related things, many of them. Read on.</aside><section id="comments"><p>I, a reader, disagree. Strongly. Yes.</p></section><form><p>Subscribe now, please.</p></form><footer>&copy; us</footer></body></html>"""


def test_html_text(spark):
    want = "Title & more\n\nFirst paragraph, with bold text <tag>. Next line.\n\nSecond one éé, unclosed; and long enough to count.\n\nAn item"
    plain = "<body><div class=menu><a>x</a></div><div><p>A sentence, with words. And another one, longer.</p><p>More of the same, of course. Good.</p></div><div><a href=x>Link one</a> <a href=y>Link two</a></div></body>"
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "<nav>only</nav>"), (5, "u", plain), (6, "u", "<p>" + "word, " * 50_000), (7, "u", "a < b & c"), (1, "u", PAGE), (8, "u", "<script>x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = defaultdict(list)
    for r in html_text.extract(df).collect():
        assert r.n_chars == len(r.text)
        got[r.page_id].append(r.text)
    assert got[1] == [want, want]
    assert got[2] == got[3] == got[4] == got[8] == [""]
    assert got[5] == ["A sentence, with words. And another one, longer.\n\nMore of the same, of course. Good."]
    assert len(got[6][0]) == 6 * 50_000 - 1 and got[7] == ["a < b & c"]
    assert html_text.extract(df.limit(0)).count() == 0


SENTENCE = "A sentence, with words. And another one, longer than that, of course."
DEPARTURES = {
    '<div class="content has-sidebar"><p>{0}<p>{0}</div><div class="sidebar"><p>{0}</div>': "{0}\n\n{0}",
    '<form id=aspnetForm><nav>x</nav><div><p>{0}<p>{0}</div></form>': "{0}\n\n{0}",
    "<header><h1>Site</h1></header><article><header><h1>Ti</h1></header><p>{0}<p>{0}</article>": "Ti\n\n{0}\n\n{0}",
    '<article><div class="article-header"><h1>Ti</h1></div><p>{0}<p>{0}</article>': "Ti\n\n{0}\n\n{0}",
    "<article><p>{0}<pre>code x</pre><p>{0}</article>": "{0}\n\ncode x\n\n{0}",
    "<div class=header-fixed><div class=nav-open><div class='social-science'><p>{0}</div></div></div>": "{0}",
    '<article><p>{0}</article><div class="reader-comments"><p>{0}<p>{0}<p>{0}<p>{0}<p>{0}</div>': "{0}",
    '<article><p>{0}<ul><li>An item<li>Other</ul></article><div class="site-footer">{0}</div><div class=comment-list>{0}</div>': "{0}\n\nAn item\n\nOther",
    "<a href=x>Link<div><p>{0}<p>{0}</div>": "{0}\n\n{0}",
}


@pytest.mark.parametrize("page", DEPARTURES)
def test_html_of_other_makes(page):
    assert html_text.main_text(page.format(SENTENCE)) == DEPARTURES[page].format(SENTENCE)


def _paths(page):
    names, out = {0: ()}, []
    for e in range(1, len(page.parents)):
        names[e] = (*names[page.parents[e]], page.names[e])
    for b in page.blocks:
        out.append((names[b.element], b.text, b.linked))
    return out


def test_path_ratios_decide():
    import pyarrow.parquet as pq

    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet")["html"].to_pylist()
    right = 0
    for html in pages:
        page = html_text.read_page(html)
        ones = [1.0] * len(page.blocks)
        chosen = html_scores(_paths(page))
        score = html_text.path_scores(page, ones)
        assert chosen == [b.text for b in page.blocks if score[b.path] >= html_text.THRESHOLD * max(score.values()) > 0]
        article = "\n\n".join(t for p, t, _ in _paths(page) if "article" in p)
        assert html_text.main_text(html) == article
        right += html_text.main_text(html, hints=False) == article
    assert right >= 0.95 * len(pages)


@pytest.mark.parametrize("piece", ["<a ", "<div>", "<svg>", "<!", "</p><div>", '<a "', "<p>", "<li><a href=x>y"])
def test_html_in_linear_time(piece):
    import time

    began = time.process_time()
    html_text.main_text(piece * 100_000)
    assert time.process_time() - began < 2  # a quadratic way takes minutes


def test_language(spark):
    sample = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.train(language.labelled(sample))
    # rows that it did not learn from
    got = language.identify(sample.filter(language.held_out(F.col("doc_id"))), model, keep=("doc_id", "lang")).collect()
    assert len(got) > 250 and sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got) and all(0 <= r.score <= 1 for r in got)
    odd = frame(spark, [(1, None), (2, ""), (3, "12 .,!"), (4, "é"), (None, "the and of the"), (5, "THE AND OF THE " * 20_000)]).withColumn("score", F.lit(1))
    by = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(odd, model).collect()}
    assert by[1] == by[2] == by[3] == ("und", 0.0) and by[4][0] != "und" and by[5][0] in ("en", "de", "fr", "es")
    none = language.train(language.labelled(sample.limit(0)))
    assert {r.lang_pred for r in language.identify(odd, none).collect()} == {"und"}
    one = language.train(language.labelled(sample.filter("lang = 'en'")))
    assert {r.lang_pred for r in language.identify(odd, one).collect()} == {"und", "en"}


def test_neighbours(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.standard_normal((1200, 24)), np.tile(rng.standard_normal(24), (300, 1))])
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x.astype(np.float32))]
    odd = [(5000, None), (5050, [0.0] * 24), (5100, [float("nan")] * 24), (5150, [None] * 24), (5200, [1.0]), (None, rows[0][1]), (5250, [float("inf")] * 24), (5300, [])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("rank", F.lit("clash"))
    got = defaultdict(list)
    for r in neighbours.nearest(df).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert sorted(got) == list(range(0, 1500, 50))
    y = x.astype(np.float32).astype(float)
    met = 0
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5] and all(v != q for _, v, _ in found)
        exact = (y * y[q]).sum(1) / (np.sqrt((y * y).sum(1)) * np.sqrt((y[q] ** 2).sum()))
        assert all(s == pytest.approx(exact[v], abs=1e-12) for _, v, s in found)
        best = [i for i in np.lexsort((np.arange(1500), -exact)) if i != q][:5]
        met += len(set(best) & {v for _, v, _ in found})
        if q >= 1200:
            assert [v for _, v, _ in found] == [i for i in range(1200, 1207) if i != q][:5]
    assert met >= 0.9 * 5 * len(got)
    few = spark.createDataFrame(rows[:3] + [(50, rows[5][1])], "vec_id long, embedding array<float>")
    assert Counter(r.query_id for r in neighbours.nearest(few).collect()) == {0: 3, 50: 3}
    assert neighbours.nearest(df.limit(0)).count() == 0


def test_neighbours_of_outliers(spark):
    """Queries that are nearly alone in their lists still have k neighbours."""
    rng = np.random.default_rng(6)
    centre = rng.standard_normal((3, 16)) * 5
    x = np.concatenate([centre[rng.integers(0, 3, 2000)] + rng.standard_normal((2000, 16)) * 0.01, rng.standard_normal((4, 16)) * 5])
    ids = [*range(1, 2001), 5000, 5050, 5100, 5150]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    got = Counter(r.query_id for r in neighbours.nearest(df).collect())
    assert set(got.values()) == {5} and len(got) == 40 + 4


def test_rows_that_neighbours_send():
    """A list with a third of all rows and a vector that a third share are sent about once; what is left out cannot be among the nearest."""
    import pyarrow as pa

    rng = np.random.default_rng(2)
    x = rng.standard_normal((9000, 8))
    x[:3000] = x[0]
    x[3000:6000] = x[3000] + 0.001 * rng.standard_normal((3000, 8))
    ids = rng.permutation(9000)
    batch = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(list(x))], ["vec_id", "v"])
    c = neighbours.centres(x[8000:], 30)
    one = np.ones(30, np.int64)
    sent = list(neighbours._sent(iter([batch]), c, 1, one, one, False, 5))
    assert 6000 < sum(b.num_rows for b in sent) <= 6006 and {b["vec_id"][i].as_py() for b in sent for i in range(b.num_rows)} >= set(ids[3000:].tolist())
    asked = batch.filter(pa.array(ids % 50 == 0))
    assert sum(b.num_rows for b in neighbours._sent(iter([asked]), c, 4, one, one, True, 5)) == 4 * 180
    y = np.array([[0.0, 1], [1, 0], [-0.0, 1], [0, 1], [0, 1], [1, 0], [0, 1]])
    assert neighbours.few_of_equal(y, np.array([9, 1, 4, 4, 4, 2, 7]), 1).tolist() == [1, 2, 5, 6]
    assert neighbours.few_of_equal(y, np.array([9, 1, 4, 4, 4, 2, 7]), 2).tolist() == [0, 1, 2, 3, 5, 6]


def test_neighbours_in_parts(spark, monkeypatch):
    """Lists and queries cut in small parts find the same."""
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.standard_normal((900, 8)), np.tile(rng.standard_normal(8), (300, 1))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(50, x[3].tolist())] * 9, "vec_id long, embedding array<double>").repartition(3)
    want = sorted(map(tuple, neighbours.nearest(df, query_every=2, coverage=1.0).collect()))
    monkeypatch.setattr(neighbours, "PART", 40)
    monkeypatch.setattr(neighbours, "ASK_BYTES", 1)
    got = sorted(map(tuple, neighbours.nearest(df, query_every=2, coverage=1.0).collect()))
    assert len(want) == 5 * 600 and [r[:3] for r in got] == [r[:3] for r in want]


@pytest.mark.parametrize("kind", ["sf0.1", "skewed"])
def test_recall_of_neighbours(spark, kind):
    import pyarrow.parquet as pq

    if kind == "skewed":  # a third is one tight cluster, a tenth one vector
        rng = np.random.default_rng(8)
        x = rng.standard_normal((40, 32))[rng.integers(0, 40, 6000)] + 0.4 * rng.standard_normal((6000, 32))
        x[::3] = x[0] + 0.01 * rng.standard_normal((2000, 32))
        x[::10] = x[1]
        ids = np.arange(6000)
        df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    else:
        where = f"/root/testdata/{kind}/embeddings.parquet"
        t = pq.read_table(where)
        ids = t["vec_id"].to_numpy()
        x = np.array(t["embedding"].to_pylist(), np.float64)
        df = spark.read.parquet(where)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    found = defaultdict(list)
    for r in neighbours.nearest(df).collect():
        found[r.query_id].append(r.score)
    met = total = 0
    for i in np.flatnonzero(ids % 50 == 0):
        s = x @ x[i]
        s[i] = -2
        want = np.sort(s)[-5:]
        met += sum(v >= want[0] - 1e-12 for v in found[int(ids[i])])  # of a tie any is right
        total += 5
    assert met >= 0.95 * total


LONG = "Some long sentence, with words and a comma. " * 4
P, LINE = f"<p>{LONG}</p>", LONG.strip()
CASES = {
    "list and table": (f"<div><ul><li><a href=x>Home</a></li><li><a href=y>About</a></li></ul></div><div>{P * 4}<table><tr><td>one</td><td>two</td></tr></table><ul><li>first</li><li>second</li></ul><ul><li><a href=z>Related</a></li></ul></div>", [LINE] * 4 + ["one", "two", "first", "second"]),
    "formula": (f"<main>{P}<p>Energy is <math><mi>E</mi><mo>=</mo><msup><mi>mc</mi><mn>2</mn></msup></math> here.</p></main>", [LINE, "Energy is E=mc2 here."]),
    "alert": (f"<main>{P}<div class='alert alert-warning'>Watch out, please do.</div>{P}</main>", [LINE] * 2),
    "discussion": (f"<article>{P * 3}</article><div class=qq><h3>Voices</h3><div><span>Ann</span><p>10:30 reply</p>{P}</div><div><p>Bob, 3 days ago</p>{P}</div></div>", [LINE] * 3),
    "feedback": (f"<main>{P * 3}</main><article class=feedback>{P}</article>", [LINE] * 3),
    "in main": (f"<main>{P * 3}<section id=zz><div><p>Ann says:</p>{P}</div><div><p>Bob says:</p>{P}</div></section></main>", [LINE] * 3),
    "list of dates": (f"<main>{P * 3}<ul><li>10:30 Opening, by the mayor</li><li>11:00 Talk</li></ul></main>", [LINE] * 3 + ["10:30 Opening, by the mayor", "11:00 Talk"]),
    "posts": ("".join(f"<article><h2>Post</h2><p>12:0{k}</p>{P}</article>" for k in range(3)), ["Post", "12:00", LINE, "Post", "12:01", LINE, "Post", "12:02", LINE]),
}


@pytest.mark.parametrize("case", CASES)
def test_structure_of_pages(case):
    html, want = CASES[case]
    got = html_text.main_text(f"<html><body>{html}</body></html>").split("\n\n")
    assert [x for x in got if x != "12:00" and x != "12:01" and x != "12:02"] == [x for x in want if not x.startswith("12:0")]


def test_language_of_long_texts_in_bounded_memory(spark, monkeypatch):
    """Pieces give what the whole text gives, and memory follows neither languages nor a text's length."""
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(1)
    text = "".join(rng.choice(list("aÄé ß\nЖz. xΩ€"), 40_000)).encode()
    raw = np.frombuffer(text, np.uint8)
    whole = language._counts(raw, np.array([0, len(raw)]))[0]
    for piece in (97, 1000, 1 << 20):
        monkeypatch.setattr(language, "PIECE", piece)
        assert (language._long_counts(raw) == whole).all()
    monkeypatch.setattr(language, "PIECE", 1 << 20)
    names = [f"l{k}" for k in range(20)]
    x = rng.random((60, language.DIM)).astype(np.float16)
    model = language.Model(x, np.array([names[k % 20] for k in range(60)]))
    assert len(model.pairs) >= 190
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3, 4], "text": ["many words of text " * 2_700_000, "short", None, ""], "has_letter": [True, True, False, False]})
    assert len(batch["text"][0].as_py()) > 50_000_000
    tracemalloc.start()
    (out,) = language._apply([batch], model, ["doc_id"])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300 << 20 and out["lang_pred"].to_pylist()[0] in names and out["lang_pred"].to_pylist()[2:] == ["und", "und"]


def test_mixing(spark):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(["w"] * int(rng.integers(1, 60))), ["a", "a", "a", "b", "c", None][i % 6]) for i in range(3000)] + [(1, None, "a"), (2, "", "d"), (None, "x y", "b"), (None, "x y", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))
    out = mix(df, keep=("doc_id", "source")).collect()
    assert sorted(map(tuple, out), key=repr) == sorted(map(tuple, mix(df.repartition(7), keep=("doc_id", "source")).collect()), key=repr)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(SPACE.findall(t or ""))
    order = sorted(s for s in sizes if s is not None) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    goal, capped = 1.5 * sum(sizes.values()), set()
    while True:
        level = (goal - sum(2 * sizes[s] for s in capped)) / sum(weight[s] for s in order if s not in capped)
        if not (new := {s for s in order if s not in capped and weight[s] * level > 2 * sizes[s]}):
            break
        capped |= new
    target = {s: 2.0 * sizes[s] if s in capped else weight[s] * level for s in order}
    taken = Counter()
    for r in out:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source]) and r.taken <= 2 * r.size and r.taken % max(1, r.size) == 0
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 60 for s in order)
    assert mix(df.limit(0)).count() == 0
    assert mix(df.filter("doc_id = 2 and text = ''")).first().taken == 0
    with pytest.raises(ValueError):
        mix(df, keep=("size",))


def test_pipeline(spark, tmp_path):
    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = [(None, "the and of then", "en", "src0", 15), (9001, None, "en", "src0", 0), (9002, "", None, None, 0), (9003, "12 34", "en", "src1", 5), (9004, PII + " " + "the and of " * 9, "en", None, 99), (9005, "wqx zzk " * 40, "en", "src1", 5), (9006, "the of and there, " * 30_000, None, "src1", 5)]
    odd = [(*r[:4], len(r[1] or "")) for r in odd]
    docs = source.union(spark.createDataFrame(odd, source.schema)).union(source.limit(1)).withColumn("taken", F.lit(1))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    model = language.train(language.labelled(docs))
    every = language.identify(docs, model, keep=("doc_id", "text", "lang")).distinct().collect()
    stay = [r for r in every if r.text and re.search(r"[^\W\d_]", r.text) and r.score >= corpus_pipeline.MIN_SCORE]
    labels = {r.doc_id: r.lang_pred if r.lang is None or r.score >= corpus_pipeline.SURE else r.lang for r in stay}
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    rows = [(r.doc_id, r.text) for r in stay]
    kept = [(d, t) for (d, t), (_, _, c) in zip(rows, jaccard(rows)) if d is None or d == c]
    kept = [(d, t) for (d, t), (_, _, hit, _) in zip(kept, decontaminate(kept, [tuple(r) for r in bench.collect()])) if not hit]
    key = surrogates.secret_key(spark)
    want = {d: brute_surrogates.pseudonymise(t, key)[0] for d, t in kept}
    assert set(out) <= set(want) and len(out) > 0.5 * len(want)
    assert all(r.text == want[r.doc_id] and r.lang == labels[r.doc_id] for r in out.values())
    for r in out.values():
        assert 0 < r.taken <= 2 * r.size and r.n_chars == len(r.text)
    assert not {9001, 9002, 9003} & set(out)
    sums = Counter()
    for r in out.values():
        sums[r.source] += r.taken
    for r in out.values():
        assert abs(sums[r.source] - r.target) <= max(x.size for x in out.values())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "personal_data", "mixing"]


def test_pipeline_of_empty_tables_and_repeated_ids(spark, tmp_path):
    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    (tmp_path / "a").mkdir()
    source.limit(0).write.parquet(str(tmp_path / "a/documents.parquet"))
    bench.limit(0).write.parquet(str(tmp_path / "a/benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "a")).count() == 0
    one, two = (" ".join(f"{k}{i}" for i in range(50)) for k in ("word", "text"))
    rows = [(1, one, None, "s", 1), (1, two, None, "s", 1), (1, two, None, "s", 1), (2, one, None, "s", 1), (3, two + " x", None, "s", 1), (None, one, None, None, 1), (None, one, None, None, 1), (4, None, None, "s", 0), (5, "", None, "s", 0), (6, "other", None, "s", 1)]
    docs = spark.createDataFrame(rows, source.schema).withColumn("component_id", F.lit(1))
    same = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)
    assert same(corpus_pipeline.one_of_each_group(spark, docs, "")) == sorted([(1, one), (1, two), (None, one), (None, one), (4, None), (5, ""), (6, "other")], key=repr)
    # no label teaches a language
    assert same(corpus_pipeline.known_language(spark, docs, "")) == sorted([r[:2] for r in rows if r[1]], key=repr)
    assert same(corpus_pipeline.without_benchmark(spark, docs, str(tmp_path / "a"))) == same(docs)
    assert same(corpus_pipeline.pseudonymous(spark, docs, "")) == same(docs)
    assert {r.doc_id for r in corpus_pipeline.mixed(spark, docs, "").collect()} <= {1, 2, 3, 6, None}
