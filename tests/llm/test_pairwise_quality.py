import math
import random
import re
import unicodedata
import zlib

import numpy as np
import pytest
from test_host_rules import TEXTS, brute

from partflow.llm import pairwise_quality as pq
from partflow.llm import queries
from partflow.llm.common import ship


def test_fit_ranks_and_threshold():
    g = np.random.default_rng(0)
    good = g.random(2000) < 0.8
    x = g.standard_normal((2000, 3)) + np.outer(good, [2.0, 0, -1.5])
    w = pq.fit(x, good)
    s = x @ w
    assert w[0] > 0.5 and w[2] < -0.5 and abs(w[1]) < 0.3
    assert (s[good][:, None] > s[~good][None]).mean() > 0.93
    c = pq.threshold(s, good)
    assert ((s >= c) == good).mean() > 0.85 and (s == s[np.argmin(np.abs(s - c))]).any()
    # the slope of the loss is nought at the fit
    rng = np.random.default_rng(5)
    a, b = np.flatnonzero(good), np.flatnonzero(~good)
    d = x[rng.choice(a, 100_000)] - x[rng.choice(b, 100_000)]
    assert np.abs(-(d / (1 + np.exp(d @ w))[:, None]).mean(0) + 1e-3 * w).max() < 1e-6


def test_one_class_or_none(spark):
    ship(spark)
    assert (pq.fit(np.ones((3, 2)), np.array([True] * 3)) == 0).all()
    docs = spark.createDataFrame([(1, "text", 1)], "doc_id long, text string, quality int")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    rows, score = pq.score(docs, pq.train(docs, labels), ["doc_id"])
    assert math.isclose(rows.select(score).first()[0], 0.7)
    assert pq.score(docs.where("false"), pq.train(docs, labels), ["doc_id"])[0].count() == 0


def test_scores_of_odd_rows_and_held_out_rows(spark):
    ship(spark)
    rnd = random.Random(2)
    clean = lambda: " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 8))) for _ in range(rnd.randint(60, 400))) + "."
    junk = [lambda: "buy now " * rnd.randint(30, 90), lambda: clean().replace(" ", "### "), lambda: clean().upper().replace(" ", "!! ")]
    texts = [(clean(), 1) if i % 4 else (rnd.choice(junk)(), 0) for i in range(600)]
    rows = [(i, t, "en") for i, (t, _) in enumerate(texts)] + [(None, clean(), "en"), (9000, None, "en"), (9001, "", None), (9002, "x " * 60_000, "en"),
                                                              (5, texts[5][0], "en"), (5, texts[5][0], "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, f_size string")
    labels = spark.createDataFrame([(i, q) for i, (_, q) in enumerate(texts) if i % 3] + [(None, 1), (3, None)], "doc_id long, quality int")
    df, score = pq.score(docs.drop("f_size"), pq.train(docs, labels), ["doc_id"])
    got = df.select("doc_id", score.alias("score")).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r.score >= pq.CUT for r in got}
    held = [i for i in range(600) if i % 3 == 0]
    assert sum(by_id[i] == (texts[i][1] == 1) for i in held) > 0.95 * len(held)
    assert not by_id[9002]


def measures(text):
    """The measures of a text, counted in Python."""
    t = text or ""
    m, n, sat = brute(t), max(1, brute(t)["n_words"]), lambda x, s: x / (x + s)
    same = 1 - len(set(re.findall(r"[^\x20\x09-\x0D]+", t))) / n
    upper = sum(unicodedata.category(c) == "Lu" for c in t)
    return dict(f_size=math.log1p(m["n_words"]), f_few=math.exp(-m["n_words"] / 10), f_symbols=sat(m["n_symbols"] / n, 0.05),
                f_upper=sat(upper / max(1, m["word_chars"]), 0.1), f_marks=sat(t.count("!") / n, 0.05), f_same=same,
                f_same_long=same / math.log(n + 9), f_repeats=sat(m["n_repeat_words"] / n, 0.1),
                f_lines=m["n_dup_lines"] / max(1, m["n_lines"]), f_word=m["word_chars"] / n / 10, f_short_lines=sat(m["n_lines"] / n, 0.1))


def test_measures_equal_brute_force(spark):
    ship(spark)
    texts = [*TEXTS, "WOW!! É ß Ǆ !", "A" * 50 + "! b"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, f_size string")
    df, names = pq.features(docs, ["doc_id"])
    for r in df.collect():
        want = measures(texts[r.doc_id])
        assert {k: r[k] for k in names} == pytest.approx(want, rel=1e-12, abs=1e-12), texts[r.doc_id]
    with pytest.raises(ValueError):
        pq.score(docs, {"names": names, "w": [0.0] * len(names), "at": 0.0, "scale": 1.0}, ["doc_id", "f_size"])


def test_query_equals_brute_force(spark, tmp_path):
    """The whole query against scores counted in Python: weights by the fit, threshold and scale over all labelled rows."""
    ship(spark)
    rnd = random.Random(4)
    clean = lambda: " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 8))) for _ in range(rnd.randint(30, 90))) + "."
    junk = [lambda: "buy now " * rnd.randint(9, 30), lambda: clean().replace(" ", "### "), lambda: clean().upper()]
    rows = [(i, clean(), 1) if i % 3 else (i, rnd.choice(junk)(), 0) for i in range(300)] + [(300, None, 0), (301, "", 0), (None, "no id", 1)]
    spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, q) for i, _, q in rows if i is None or i % 7], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 4 == 2             # noqa: E731
    got = {r.doc_id: r for r in queries.QUERIES["op9_pairwise_quality"](spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    names = list(measures(""))
    x = {i: np.array([measures(t)[k] for k in names]) for i, t, _ in rows}
    fitted = [(i, q) for i, _, q in rows if i is not None and i % 7 and not held(i)]
    good = np.array([q == 1 for _, q in fitted])
    # the fit draws its pairs by place: the sample's order is that of the ids' hashes
    order = [r.doc_id for r in spark.createDataFrame([(i,) for i, _ in fitted], "doc_id long").selectExpr("doc_id", "xxhash64(doc_id) h").orderBy("h").collect()]
    labels = dict(fitted)
    w = pq.fit(np.array([x[i] for i in order]), np.array([labels[i] == 1 for i in order]))
    s = np.array([x[i] @ w for i, _ in fitted])
    step = (s.max() - s.min()) / pq.BINS
    right = lambda c: ((s[good] >= c).mean() + (s[~good] < c).mean()) / 2               # noqa: E731
    logit = {i: math.log(r.score / (1 - r.score)) for i, r in got.items()}
    # the cut is where the score is CUT: solved from any document's score, the same for all, and as good as the best quantile
    cuts = [x[i] @ w - (logit[i] - math.log(pq.CUT / (1 - pq.CUT))) * s.std() / 3 for i in got if abs(logit[i]) < 30]
    assert np.ptp(cuts) < 1e-6
    assert right(cuts[0]) >= max(right(c) for c in np.quantile(s, np.linspace(0.005, 0.995, 199))) - 1 / min(good.sum(), (~good).sum())
    assert s.min() - step <= cuts[0] <= s.max()
    for i, r in got.items():
        assert r.held_out == held(i) and r.predicted == int(r.score >= 0.7)


def test_the_sample_is_that_of_the_least_hashes(spark, monkeypatch):
    ship(spark)
    names, seen = ["f_a"], []
    rows = spark.range(20_000).selectExpr("id as doc_id", "cast(id as double) as f_a")
    labels = spark.range(20_000).selectExpr("id as doc_id", "cast(id % 2 as int) as quality")
    monkeypatch.setattr(pq, "fit", lambda x, good: seen.append(x[:, 0]) or np.zeros(1))
    for most in (1_000, 20_000):
        pq.train_on(rows, names, labels, most=most)
        want = [r[0] for r in rows.selectExpr("f_a", "xxhash64(doc_id) h").orderBy("h").limit(most).collect()]
        assert seen[-1].tolist() == want
