import hashlib
import random
import re
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from partflow.llm import order_minhash as om
from partflow.llm.common import ship


def chain(*values):
    """Spark's xxhash64 of several values."""
    h = 42
    for v in values:
        raw = v.encode() if isinstance(v, str) else struct.pack("<q", v) if not isinstance(v, bool) else b""
        h = xxhash.xxh64_intdigest(raw, seed=h)
    return h


def with_int(h, t):
    return xxhash.xxh64_intdigest(struct.pack("<i", t), seed=xxhash.xxh64_intdigest(struct.pack("<q", h), seed=42))


def signed(h):
    return h - (h >> 63 << 64)


def brute(text, k=om.K, l=om.L, m=om.ORDERS):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if not words:
        return []
    kmers = [signed(chain(*words[i:i + k])) for i in range(max(1, len(words) - k + 1))]
    seen, pairs = {}, []
    for i, h in enumerate(kmers):
        t = seen.get(h, 0)
        seen[h] = t + 1
        g = h % 2 ** 64 if t == 0 else with_int(h, t)
        pairs.append(((g >> 32) << 31 | i, i))
    pairs.sort()
    out = []
    step = 2 ** 63 // m
    for b in range(m):                        # each order's own selection, by looking at all pairs
        turned = sorted(pairs, key=lambda p: ((p[0] - b * step) % 2 ** 63))
        places = sorted(turned[t % len(turned)][1] for t in range(l))
        out.append(chain(*[kmers[p] for p in places]) & 0xFFFF)
    return out


TEXTS = ["", None, " \n", "one", "one two", "one two three", "one two three four", "a b " * 30, "same " * 50, "é 日本 😀 x y z",
         "long words " * 2_000]


@pytest.fixture
def docs(spark):
    ship(spark)
    rnd = random.Random(8)
    texts = TEXTS + [" ".join(rnd.choice(["the", "of", "and", "in"] + [f"w{i}" for i in range(40)]) for _ in range(rnd.randint(3, 400)))
                     for _ in range(40)]
    rows = [(i * 3 - 20, t, "x") for i, t in enumerate(texts)] + [(None, "no id here at all", "y"), (1, "twice in it", "z"), (1, "twice in it", "z"),
                                                                  (1, "other text", "z")]
    return spark.createDataFrame(rows, "doc_id long, text string, _w string").drop("_w").withColumn("fingerprint", F.lit(1))


@pytest.mark.parametrize("l,m", [(2, 64), (3, 16), (1, 4)])
def test_signature_equals_brute_force(docs, l, m):
    rows = om.signature(docs.select("text"), "text", "sig", l=l, m=m).collect()
    for r in rows:
        assert r.sig == brute(r.text if r.text is not None else "", l=l, m=m), r.text and r.text[:50]


def test_query_equals_brute_force(docs, monkeypatch):
    rows = docs.collect()
    # xxhash64 of a null text is never asked for: it is an empty one
    order = sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0, signed(chain(r.text or ""))))
    want = []
    for k, r in enumerate(order):
        text, nxt = r.text or "", order[k - 1].text or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + nxt[:half]
        f, e, g = brute(text), brute(edited), brute(nxt)
        near = lambda a, b: 1.0 if not a and not b else sum(x == y for x, y in zip(a, b)) / max(len(a), len(b))
        want.append((r.doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), "".join(f"{x:04x}" for x in f),
                     "".join(f"{x:04x}" for x in e), near(f, e), near(f, g)))
    whole = om.with_next
    for per in (500, 4):
        monkeypatch.setattr(om, "with_next", lambda *a, per=per: whole(*a, rows_per_range=per))
        got = [tuple(r) for r in om.compare_edited(docs).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)


def test_order_counts(spark):
    ship(spark)
    rnd = random.Random(1)
    words = [f"w{i}" for i in range(400)]
    moved = words[200:] + words[:200]
    shuffled = rnd.sample(words, 400)
    f = [brute(" ".join(x), k=1) for x in (words, moved, shuffled)]
    share = [sum(a == b for a, b in zip(f[0], x)) / len(x) for x in f]
    assert share[0] == 1 and 0.3 < share[1] < 0.8 and share[2] < share[1] + 0.2


def test_one_row_and_none(spark):
    ship(spark)
    one = spark.createDataFrame([(7, "alone in the table")], "doc_id long, text string")
    r = om.compare_edited(one).first()
    assert r.near_next == 1.0 and r.n_chars == 18
    assert om.compare_edited(one.where("false")).count() == 0
