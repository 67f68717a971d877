import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from partflow.llm import language
from partflow.llm.common import ship


def brute_bits(train, text, order):
    """PPM, method C with exclusion, by the book: counts in dictionaries, one byte at a time."""
    counts = {}
    for t in train:
        b = bytes([language.START]) * order + t.encode()
        for i in range(order, len(b)):
            for j in range(order + 1):
                counts.setdefault((j, b[i - j:i]), Counter())[b[i]] += 1
    total, b = 0.0, bytes([language.START]) * order + text.encode()
    for i in range(order, len(b)):
        off = set()
        for j in range(order, -1, -1):
            seen = {s: n for s, n in counts.get((j, b[i - j:i]), {}).items() if s not in off}
            if not seen:
                continue
            whole = sum(seen.values()) + len(seen)
            if b[i] in seen:
                total -= math.log2(seen[b[i]] / whole)
                break
            total -= math.log2(len(seen) / whole)
            off |= set(seen)
        else:
            total += math.log2(256 - len(off))
    return total


def model_of(trains, order):
    out = {"names": [], "grams": [], "order": order}
    for k, texts in sorted(trains.items()):
        data, at = language._bytes_of(pa.array(texts))
        keys, n = np.unique(language.grams(data, at, 0, len(data), order), return_counts=True)
        out["names"].append(k)
        out["grams"].append((keys, n.astype(float)))
    return out


@pytest.mark.parametrize("order", [0, 2, 4])
def test_code_lengths_against_the_book(order, monkeypatch):
    rnd = random.Random(order)
    word = lambda a: "".join(rnd.choice(a) for _ in range(rnd.randint(1, 7)))      # noqa: E731
    trains = {"aa": [" ".join(word("abcdé") for _ in range(60)) for _ in range(4)], "bb": ["", " ".join(word("cdefß中") for _ in range(80))]}
    texts = ["", "abc", "é", "zzz \U0001f600", *[" ".join(word("abcdefß") for _ in range(30)) for _ in range(6)], None, "a"]
    want = np.array([[brute_bits(t, x or "", order) for x in texts] for _, t in sorted(trains.items())])
    for piece, known in ((1 << 20, 1 << 20), (7, 5)):
        monkeypatch.setattr(language, "PIECE", piece)
        monkeypatch.setattr(language, "KNOWN", known)
        coder = language.Coder(model_of(trains, order))
        assert np.allclose(coder.lengths(pa.array(texts)), want)
        assert np.allclose(coder.lengths(pa.array(["x", *texts, "y"])[1:-1]), want)       # an array that starts inside its buffers


def test_chances_of_all_bytes_sum_to_one():
    rnd = random.Random(5)
    texts = [" ".join("".join(rnd.choice("abcdeé") for _ in range(4)) for _ in range(200))]
    tree = language.Coder(model_of({"x": texts}, 4)).trees[0]
    for _ in range(50):
        ctx = int.from_bytes(bytes(rnd.choice(b"abcde \n\xc3\xa9z") for _ in range(4)))
        assert math.isclose(np.exp2(-tree.bits((ctx << 8) + np.arange(256))).sum(), 1, rel_tol=1e-9)


def test_training_counts_and_odd_rows(spark):
    ship(spark)
    rnd = random.Random(6)
    word = lambda a: "".join(rnd.choice(a) for _ in range(rnd.randint(2, 7)))      # noqa: E731
    text = lambda a: " ".join(word(a) for _ in range(rnd.randint(3, 60)))          # noqa: E731
    rows = [(k, text("abcdeo") if k % 2 else text("eoxyzü"), "one" if k % 2 else "two", "s") for k in range(300)]
    odd = [(None, "abc doc bad", "one", "s"), (900, None, "one", "s"), (901, "", "two", "s"), (902, " 12 .\n", None, "s"), (903, "xyz " * 60_000, None, "s"),
           (5, rows[5][1], "one", "s"), (5, rows[5][1], "one", "s")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, score string")
    model = language.train(docs.where("doc_id % 5 <> 0 or doc_id is null"))
    trains = {"one": [t for k, t, la, _ in rows + odd if la == "one" and t is not None and (k is None or k % 5)],
              "two": [t for k, t, la, _ in rows + odd if la == "two" and t is not None and (k is None or k % 5)]}
    want = model_of(trains, 4)
    for (k, n), (k2, n2) in zip(model["grams"], want["grams"]):
        assert dict(zip(k.tolist(), n)) == dict(zip(k2.tolist(), n2))
    out = language.predict(docs, model).collect()
    assert len(out) == len(rows) + len(odd)
    by = {r.doc_id: r for r in out}
    assert all(by[k].lang_pred == la and 0.5 <= by[k].score <= 1 for k, t, la, _ in rows)
    assert all((by[k].lang_pred, by[k].score) == ("und", 0) for k in (900, 901, 902)) and by[903].lang_pred == "two" and by[None].lang_pred == "one"
    bits = language.Coder(model).lengths(pa.array([rows[7][1]]))[:, 0]
    assert math.isclose(by[7].score, 1 / (1 + 2 ** -abs(bits[0] - bits[1])))
    few = language.train(docs, most=20)
    assert all(n.sum() < w.sum() / 3 for (_, n), (_, w) in zip(few["grams"], want["grams"]))
    with pytest.raises(ValueError):
        language.predict(docs, model, ["score"])


def test_nothing_learned_and_no_rows(spark):
    ship(spark)
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    model = language.train(docs)
    assert [tuple(r) for r in language.predict(docs, model).collect()] == [(1, "und", 0.0)]
    assert language.predict(docs.where("false"), model).collect() == []
