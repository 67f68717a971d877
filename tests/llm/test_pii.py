import itertools
import random
import re

import numpy as np
import pytest

from partflow.llm import pii
from partflow.llm.common import ship

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def brute(text):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            if k == 1 and any(int(x) > 255 for x in m[0].split(".")) or k == 2 and not (16 <= len(d) <= 19 and pii.luhn(d)) \
                    or k == 3 and not 8 <= len(d) <= 15:
                continue
            out.append((k, m.start(), m.end()))
    return out


TEXTS = ["", "a@b.c", "a@b", "x a@b.c.d@e.f_g@h.i", "@@a@@b.c", "a@b.c_d@e.f", "é@b.cé a.b@c-d.e-f.", "1.2.3.4.5.6.7.8", "256.1.1.1 0255.001.0.0",
         "1.2.3.4.", "4111 1111 1111 1111", "4111-1111-1111-1111 1", "+1 (499) 555-6503", "+1 2 3 4 5 6 7 8 ( (", "+12+3456789012", "1" * 5000, "a" * 50_000 + "@",
         "@" * 20_000, "1 " * 9000, "+1" + " (" * 9000, "x" * 9000 + "@y.z " + "1.1.1.1 " * 3000, "日本 4111111111111111 😀 a@b.cd"]


@pytest.mark.parametrize("k", range(len(TEXTS)))
def test_patterns(k):
    slow = len(set(TEXTS[k])) <= 2 and len(TEXTS[k]) > 10_000       # the plain patterns take the square of its length
    assert pii.base_spans(TEXTS[k]) == ([] if slow else brute(TEXTS[k]))


def test_patterns_on_random_texts():
    rnd = random.Random(1)
    for _ in range(4000):
        t = "".join(rnd.choice("aZ@@..+-_%019 5() é") for _ in range(rnd.randint(0, 60)))
        assert pii.base_spans(t) == brute(t), t


def test_gradients_are_right():
    rng = np.random.default_rng(0)
    t = pii.Tagger(hidden=3)
    for k in t.w:
        t.w[k] = t.w[k].astype(np.float64) * 3
    x, mask = rng.integers(1, pii.CLASSES, (6, 3)), np.ones((6, 3), bool)
    mask[4:, 1] = False
    x[~mask] = 0
    y = np.array([[0, 1, 0], [3, 2, 0], [4, 2, 7], [4, 0, 8], [0, 0, 8], [1, 0, 0]])
    f32, np.float32 = np.float32, np.float64
    try:
        _, g = t.step(x, y, mask)
        for name in t.w:
            flat = t.w[name].reshape(-1)
            used = np.flatnonzero(np.abs(g[name].reshape(-1)) > 1e-7)
            for i in used[:: max(1, len(used) // 7)]:
                old, got = flat[i], []
                for e in (1e-4, -1e-4):
                    flat[i] = old + e
                    got.append(t.step(x, y, mask)[0])
                flat[i] = old
                assert abs((got[0] - got[1]) / 2e-4 - g[name].reshape(-1)[i]) < 2e-3, name
    finally:
        np.float32 = f32


def test_decoding_equals_all_paths():
    t = pii.Tagger(hidden=2)
    t.w["e"] *= 40
    text = "a@1"
    x = np.zeros((pii.WINDOW, 1), int)
    x[:3, 0] = pii.codes(text)
    em = t.emissions(x)[0][:, 0]
    tr = t.w["t"] + t.ban
    paths = {p: t.w["s"][p[0]] + t.ban0[p[0]] + sum(em[i, k] for i, k in enumerate(p)) + sum(tr[a, b] for a, b in zip(p, p[1:]))
             for p in itertools.product(range(len(pii.TAGS)), repeat=3)}
    best = max(paths, key=paths.get)
    found = t.decode([text, "longer text 1"])[0]
    tags = [0] * 3
    for k, s, e, _ in found:
        tags[s:e] = [2 * k + 1] + [2 * k + 2] * (e - s - 1)
    assert tuple(tags) == best
    z = np.log(sum(np.exp(float(v)) for v in paths.values()))
    al, _ = t._sums(t.emissions(x)[0], np.arange(pii.WINDOW)[:, None] < 3)
    assert abs(pii._lse(al[-1], 1)[0] - z) < 1e-3


def test_reconcile():
    base = [(0, 10, 20)]
    got = pii.reconcile(base, [(1, 15, 25, 0.9), (2, 30, 40, 0.6), (2, 30, 40, 0.8), (3, 38, 41, 0.99), (1, 0, 10, 0.7), (1, 41, 44, 0.5)])
    assert got == [(0, 10, 20), (1, 0, 10), (1, 41, 44), (2, 30, 40)]


def test_windows_cover_every_seed():
    rnd = random.Random(3)
    for _ in range(300):
        t = "".join(rnd.choice("a" * 60 + "1@") for _ in range(rnd.randint(0, 900)))
        w = pii.windows_of(t)
        assert all(0 <= a < b <= len(t) and b - a <= pii.WINDOW for a, b in w)
        for m in re.finditer("[0-9@]", t):
            a, b = max(0, m.start() - 15), min(len(t), m.end() + 15)
            assert any(x <= a and b <= y for x, y in w)


def test_query_columns_and_held_out_forms(spark):
    ship(spark)
    rnd = random.Random(4)
    words = ["lorem", "ipsum", "dolor", "amet", "Sit", "elit"]
    prose = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    rows = [(i, f"{prose(20)} mail{i}@host{i}.org {prose(5)} +1 ({500 + i}) 555-{1000 + i} {prose(4)} 10.0.{i % 250}.7 {prose(9)}", "x") for i in range(120)]
    rows += [(None, "null id a@b.cd", "x"), (900, None, "x"), (901, "", "x"), (7, "twice 4111111111111111", "x"), (7, "twice 4111111111111111", "x"),
             (902, prose(40), "x"), (903, f"{prose(12)} order 12 4111 1111 1111 1111 {prose(9)}", "x"), (904, f"{prose(9)} 1999 and 3.5 on 2020-01-02 {prose(9)}", "x"),
             (905, "1 " * 40_000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    tagger = pii.train(df)
    got = sorted(map(tuple, pii.find(df, tagger).collect()), key=str)
    assert [(g[0], g[1]) for g in got] == sorted([(i, pii.joined(brute(t or ""))) for i, t, _ in rows], key=str)
    for _, base, spans in got:
        assert set(filter(None, base.split(","))) <= set(filter(None, spans.split(",")))
    by_id = {g[0]: g[2] for g in got}
    assert by_id[902] == by_id[904] == by_id[905] == by_id[901] == by_id[900] == ""
    masked = {r.doc_id: r.text for r in pii.mask(df, tagger).collect()}
    assert masked[7] == "twice [card]" and masked[900] is None and masked[901] == "" and "[email]" in masked[0] and "@" not in masked[0]
    # on generated spans that it has not seen
    made = pii.examples(np.random.default_rng(99), [prose(12) for _ in range(50)], 600)
    found = tagger.decode([t for t, _ in made])
    hit = sum(bool(s) and any(f[:3] == s[0] for f in fs) for (_, s), fs in zip(made, found))
    clean = sum(not s and not fs for (_, s), fs in zip(made, found))
    assert hit > 0.85 * sum(bool(s) for _, s in made) and clean > 0.8 * sum(not s for _, s in made)
    assert pii.find(df.where("false"), pii.train(df.where("false"), steps=2)).count() == 0


def test_adjacent_spans_are_added(spark):
    ship(spark)
    rnd = random.Random(8)
    prose = lambda: " ".join("".join(rnd.choice("abdeghilmnorst") for _ in range(rnd.randint(2, 8))) for _ in range(12))
    tagger = pii.train(spark.createDataFrame([(k, f"{prose()} {rnd.randrange(10 ** 5)} {prose()}") for k in range(300)], "doc_id long, text string"))
    parts = [["7536784127813050", "4845168114407329"], ["53820953013749", "4550997810720808"], ["+1 (826) 555-4081", "190.137.223.20"],
             ["+1 (843) 555-7672", "170.106.47.218"]]
    wanted = [["card", "card"], [None, "card"], ["phone", "ip"], ["phone", "ip"]]
    texts = [f"{prose()} {' '.join(p)} {prose()}" for p in parts]
    found = pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), tagger).collect()
    for r in found:
        at = texts[r.doc_id].index(parts[r.doc_id][0])
        want = {f"{w}:{at + o}:{at + o + len(p)}" for p, w, o in zip(parts[r.doc_id], wanted[r.doc_id], [0, len(parts[r.doc_id][0]) + 1]) if w}
        assert want == set(r.spans.split(",")) and want != set(r.base.split(","))
