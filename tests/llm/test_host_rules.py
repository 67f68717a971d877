import re

import pytest

from partflow.llm import host_rules
from partflow.llm.common import ship

CLEAN = " ".join(f"word{i}" for i in range(40))
TEXTS = [CLEAN, CLEAN + "\n" + CLEAN, "", None, " \n\t", "few words", "x" * 100_000, "a b c d e f g h " * 20_000, "# $ % & " + CLEAN,
         "a b c d e f g h\n" * 3 + CLEAN, "\nline one\n\nline one\n \nline one\x0b", "é ñ 日本 😀 " * 9, "\x0ba b\x0cc\r\n", CLEAN.replace(" ", "  ")]


def brute(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    at = {}
    for i in range(len(words) - 7):
        at.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {p for ps in at.values() if len(ps) > 1 for i in ps for p in range(i, i + 8)}
    m = dict(n_words=len(words), word_chars=sum(map(len, words)), n_symbols=len(re.findall(r"[#*$%&|<>]", t)),
             n_dup_lines=len(lines) - len(set(lines)), n_repeat_words=len(covered), n_lines=len(lines))
    m["base_failed"] = m["n_words"] < 20 or 100 * m["n_repeat_words"] > 30 * m["n_words"]
    m["own"] = (m["base_failed"] or 10 * m["n_symbols"] > m["n_words"] or 10 * m["n_dup_lines"] > 4 * m["n_lines"]
                or not 2 * m["n_words"] <= m["word_chars"] <= 15 * m["n_words"])
    return m


@pytest.fixture
def docs(spark):
    ship(spark)
    rows = [(i, t, "mixed", 1) for i, t in enumerate(TEXTS)] + [(None, CLEAN, None, 2), (1, CLEAN, "mixed", 3), (1, CLEAN, "mixed", 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_words int")


def test_measures_equal_brute_force(docs):
    got = host_rules.measure(docs, keep=["doc_id"]).collect()
    want = [(r.doc_id, *(brute(r.text)[k] for k in host_rules.MEASURES)) for r in docs.collect()]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_a_bad_host_falls_and_a_small_one_does_not(spark):
    ship(spark)
    rows = [(i, CLEAN if i % 10 else "junk", f"good{i % 30}") for i in range(600)]
    rows += [(1000 + i, "junk" if i % 10 else CLEAN, "bad") for i in range(200)] + [(2000, CLEAN, "small"), (2001, "junk", "small")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.kept for r in host_rules.judge(df).collect()}
    assert got == {i: t == CLEAN and s != "bad" for i, t, s in rows}


def test_judge_keeps_rows(docs):
    got = host_rules.judge(docs, keep=["doc_id"]).collect()
    assert len(got) == docs.count()
    for r in got:
        assert not (r.kept and r.base_failed)
    want = sorted((str(r.doc_id), brute(r.text)["base_failed"]) for r in docs.collect())
    assert sorted((str(r.doc_id), r.base_failed) for r in got) == want
    assert host_rules.judge(docs.where("false")).count() == 0
