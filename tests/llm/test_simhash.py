import random
import re

import numpy as np
import pytest
import xxhash

from partflow.llm import simhash
from partflow.llm.common import components, ship


def brute_fp(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    sh = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_groups(fps, radius):
    left, label = set(range(len(fps))), {}
    while left:
        todo = [start := min(left)]
        left.discard(start)
        while todo:
            i = todo.pop()
            label[i] = start
            near = [j for j in left if (fps[i] ^ fps[j]).bit_count() <= radius]
            left.difference_update(near)
            todo += near
    return label


@pytest.mark.parametrize("text", ["", " \t\n", "A", "a b c", "A b C d", "a b c d e", "É È a\x0bb\x0cc\rd\x1ce f g h i j", "x y " * 40000])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == brute_fp(text)


def test_forest_connects_as_all_pairs_do(monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 16)
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2 ** 63, 150, dtype=np.uint64)
    noise = [b ^ np.uint64(sum(1 << int(k) for k in rng.choice(64, rng.integers(1, 6), replace=False))) for b in base for _ in range(2)]
    x = np.unique(np.concatenate((base, np.array(noise, np.uint64))))
    x = x[np.argsort(np.bitwise_count(x), kind="stable")]
    want = brute_groups([int(v) for v in x], 4)
    child, label, both = simhash.compare(x, x, 4)
    same = lambda l: {frozenset(i for i in range(len(x)) if l[i] == v) for v in set(l[i] for i in range(len(x)))}
    assert same(label) == same(want) and 50 < len(child) < len(x)
    # two tiles: across links only
    a, b = x[:200], x[200:]
    child, label, both = simhash.compare(a, b, 4)
    assert all((int(both[c]) ^ int(both[label[c]])) for c in child) and len(child) < len(x)


@pytest.mark.parametrize("tile", [16_384, 20])
def test_groups_equal_brute_force(spark, tile):
    ship(spark)
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rnd.choice(words) for _ in range(60)) for _ in range(60)]
    near = [t.rsplit(" ", 1)[0] + " " + rnd.choice(words) for t in texts[:40] for _ in range(3)]
    texts += near + texts[:5] * 3 + ["", " ", None, "one", "one two", "ONE", "long text " * 30000]
    rows = [(1000 - 3 * i, t, "x") for i, t in enumerate(texts)] + [(None, texts[0], "x"), (None, "alone without id", "x"), (1000, texts[0], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = simhash.near_duplicates(df, rows_per_tile=tile).collect()
    fps = [brute_fp(t) for _, t, _ in rows]
    label = brute_groups(fps, 4)
    least = {g: min((rows[i][0] for i in label if label[i] == g and rows[i][0] is not None), default=None) for g in set(label.values())}
    want = sorted(((rows[i][0], fps[i], least[label[i]]) for i in range(len(rows))), key=str)
    assert sorted(((r.doc_id, r.fp % 2 ** 64, r.component_id) for r in got), key=str) == want
    assert len(set(label.values())) < len(set(fps)) - 5


def test_empty_table_and_chain(spark):
    ship(spark)
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    chain = [(i, i + 1) for i in range(0, 300)] + [(i, 1000) for i in range(900, 1000)] + [(5000, 5000)]
    random.Random(1).shuffle(chain)
    got = dict(map(tuple, components(spark.createDataFrame(chain, "a long, b long"), "a", "b").collect()))
    assert got == {i: 0 for i in range(301)} | {i: 900 for i in range(900, 1001)}
