"""k-means over text: against plain numpy, and at its edges (the oracle replays it on the given documents)."""

import math
import random
import re
from collections import Counter

import numpy as np

from partflow.operators import clustering as cl


def _texts(rnd, n):
    topics = [[f"{t}{i}" for i in range(30)] for t in ("ab", "cd", "ef")]
    return [(k, " ".join(rnd.choices(topics[k % 3], k=rnd.randint(5, 40)))) for k in range(n)]


def _rows(texts, terms):
    df = Counter(t for _, x in texts for t in set(re.findall(r"\w{2,}", (x or "").lower())))
    out = np.zeros((len(texts), len(terms)))
    for k, (_, x) in enumerate(texts):
        for t, n in Counter(re.findall(r"\w{2,}", (x or "").lower())).items():
            if t in terms:
                out[k, terms.index(t)] = n * (math.log((1 + len(texts)) / (1 + df[t])) + 1)
    return out / np.maximum(np.sqrt((out * out).sum(1, keepdims=True)), 1e-300), df


def _near(x, c):
    return np.round((x * x).sum(1)[:, None] + (c * c).sum(1) - 2 * x @ c.T, 9).argmin(1)


def test_rounds_against_numpy(spark, monkeypatch):
    monkeypatch.setattr(cl, "CELLS", 64)            # products in small parts
    texts = _texts(random.Random(4), 90) + [(900, None), (901, ""), (902, "x ?")]
    v = cl.vectors(spark.createDataFrame(texts, "doc_id long, text string").repartition(5), features=70)
    x, df = _rows(texts, v.terms)
    assert v.terms == sorted(df, key=lambda t: (-df[t], t))[:70]
    got = {r["doc"]: r for r in v.rows.collect()}
    for k, (d, _) in enumerate(texts):
        dense = np.zeros(len(v.terms))
        dense[got[d]["ids"]] = got[d]["weights"]
        assert np.allclose(dense, x[k])
    c = cl.start(v, 3)
    assert len(c) == 3
    want = c.copy()
    for _ in range(3):
        near = _near(x, want)
        want = np.array([x[near == k].mean(0) if (near == k).any() else want[k] for k in range(3)])
    done = cl.lloyd(v, c, 3)
    assert np.allclose(done, want)
    label = {r["doc_id"]: r["cluster"] for r in cl.clusters(v, done).collect()}
    assert [label[d] for d, _ in texts] == _near(x, want).tolist()
    assert all(len({label[k] for k in range(t, 90, 3)}) == 1 for t in range(3)) and len({label[k] for k in range(3)}) == 3
    means = {(r["cluster"], r["term"]): r["mean"] for r in cl.cluster_means(v, done).collect()}
    near = _near(x, done)
    assert all(math.isclose(m, x[near == c][:, v.terms.index(t)].mean(), abs_tol=1e-9) for (c, t), m in means.items())


def test_fewer_documents_than_clusters_and_none(spark):
    docs = spark.createDataFrame([(1, "same words"), (2, "same words"), (3, "other text")], "doc_id long, text string")
    v = cl.vectors(docs)
    label = {r["doc_id"]: r["cluster"] for r in cl.clusters(v, cl.kmeans(v, 8)).collect()}
    assert label[1] == label[2] != label[3]
    v = cl.vectors(docs.where("false"))
    c = cl.kmeans(v, 8)
    assert cl.clusters(v, c).count() == 0 and cl.cluster_means(v, c).count() == 0


def test_few_documents_at_a_time_become_numbers(monkeypatch):
    terms = cl.pa.array(["aa", "bb", "cc"], cl.pa.string())
    sent = type("Sent", (), {"value": (terms, np.array([1.0, 2.0, 3.0]))})
    lists = [["aa", "bb", "aa", "zz"], [], None, ["cc"], ["bb", "cc"]] * 30
    batch = cl.pa.RecordBatch.from_arrays([cl.pa.array(range(150)), cl.pa.array(lists, cl.pa.list_(cl.pa.string()))], ["doc", "t"])
    whole = [r for b in cl._to_rows(iter([batch]), sent) for r in b.to_pylist()]
    monkeypatch.setattr(cl, "SLICE", 7)
    parts = list(cl._to_rows(iter([batch]), sent))
    assert len(parts) == 22 and max(b.num_rows for b in parts) == 7
    assert [r for b in parts for r in b.to_pylist()] == whole
    centres = type("Sent", (), {"value": np.eye(3)[:, :2].copy()})
    near = [r for b in cl._nearest(iter(parts), centres) for r in b.to_pylist()]
    assert [r["doc"] for r in near] == list(range(150)) and [r["cluster"] for r in near[:5]] == [0, 0, 0, 0, 1]
