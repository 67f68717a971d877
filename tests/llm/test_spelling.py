import random
import zlib
from collections import Counter

import re

from partflow.llm import spelling
from partflow.llm.common import ship


def near(a, b):
    """One inserted, deleted or replaced letter, by trying all."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    s, t = sorted((a, b), key=len)
    return any(t[:k] + t[k + 1:] == s for k in range(len(t)))


def brute(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if h % 199 == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1:]
            n[w] += 1
    n = {w: c for w, c in n.items() if c >= 5 and len(w) >= 6}
    out, form = {}, {}
    for w in n:
        around = [x for x in n if near(w, x)]
        best = min(around, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
        out[w] = (n[w], len(around))
    res = set()
    for w in n:
        r = w
        while form[r]:
            r = form[r]
        res.add((w, form[w], r, *out[w], n[form[w]] if form[w] else None))
    return res


def got(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_one_edit_against_trying_all():
    rnd = random.Random(1)
    words = ["".join(rnd.choice("ab\xe9") for _ in range(rnd.randint(3, 8))).encode("latin-1") for _ in range(160)]
    pairs = [(a, b) for a in words for b in words]
    ok = spelling.one_edit(*map(list, zip(*pairs)))
    assert ok.tolist() == [near(a, b) for a, b in pairs]


def test_pairs_of_blocks_against_trying_all(monkeypatch):
    rnd = random.Random(2)
    words = sorted({"".join(rnd.choice("abcd\xff") for _ in range(rnd.randint(6, 9))).encode("latin-1") for _ in range(700)}, key=lambda w: (len(w), w))
    monkeypatch.setattr(spelling, "TILE", 64)
    i, j = spelling.near_pairs(words, words, True)
    want = {(a, b) for a in range(len(words)) for b in range(a + 1, len(words)) if near(words[a], words[b])}
    assert set(zip(i.tolist(), j.tolist())) == want and len(i) == len(want)
    i, j = spelling.near_pairs(words[:300], words[300:], False)
    assert set(zip(i.tolist(), (j + 300).tolist())) == {(a, b) for a, b in want if a < 300 <= b}


def test_variants_against_brute_force(spark, monkeypatch):
    ship(spark)
    rnd = random.Random(3)
    stems = ["".join(rnd.choice("aeiouklmnt\xe9\xdf") for _ in range(rnd.randint(6, 9))) for _ in range(60)]
    slip = lambda w: w[:(k := rnd.randrange(len(w)))] + rnd.choice(["", "x", w[k] + "q"]) + w[k + 1:]
    rows = [(d, " ".join(rnd.choice([w, w, w.title(), slip(w)]) + rnd.choice(["", ",", "1", "ł"]) for w in rnd.choices(stems, k=200)))
            for d in range(120)]
    rows += [(None, "wordsix " * 5), (7, None), (8, ""), (9, "longest" * 30_000 + " longest"), (10, "中\U0001f600abcdef abcdef"), rows[0], rows[0]]
    rows += [(500 + k, "chainsroot " * 25 + "chainsroo " * 5 * (k == 0) + "chainsro " * (k == 0)) for k in range(6)]
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, n int, word string")
    want = brute(rows)
    assert sum(r[1] is not None for r in want) > 20
    assert got(spelling.variants(docs)) == want


def test_chain_of_forms(spark):
    ship(spark)
    text = "rootword " * 650 + "rootwor " * 130 + "rootwo " * 26 + "rootwoz " * 5
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    rows = got(spelling.variants(docs, slip=1 << 40))
    assert rows == {("rootword", None, "rootword", 650, 1, None), ("rootwor", "rootword", "rootword", 130, 3, 650),
                    ("rootwo", "rootwor", "rootword", 26, 2, 130), ("rootwoz", "rootwor", "rootword", 5, 2, 130)}


def test_no_rows(spark):
    ship(spark)
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(docs).collect() == []
