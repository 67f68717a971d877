import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as cp
from partflow.llm import pii
from partflow.llm.common import ship, tokenizer_path
from test_fuzzy_lines import brute as brute_lines
from test_host_rules import brute as brute_rules
from test_simhash import brute_fp, brute_groups


@pytest.fixture
def docs(spark):
    ship(spark)
    rnd = random.Random(12)
    words = [f"{a}{b}" for a in ("th", "on", "er", "ha", "sch", "qu") for b in ("in", "ea", "our", "es", "ung", "é", "la", "st")]
    line = lambda: " ".join(rnd.choice(words) for _ in range(rnd.randint(12, 40))) + "."
    texts = ["\n".join(line() for _ in range(rnd.randint(2, 6))) for _ in range(60)]
    texts += [t.replace("thin", "thea", 1) for t in texts[:12]] + texts[:4]                       # near and exact copies
    texts += ["### ".join(line().split(" ")) for _ in range(4)] + ["so what " * 40, "few words", "", None]
    texts += [f"{line()}\nmail me@host{i}.example.org or +1 (499) 555-65{10 + i} now\n{line()}" for i in range(6)] + [line() * 300]
    rows = [(i * 5, t, "en", f"src{i % 7}" if i % 11 else None, len(t or ""), 1, None) for i, t in enumerate(texts)]
    rows += [(None, texts[1], "en", "src1", 3, 1, None), (5, texts[1], "en", "src1", 3, 1, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_lines int, component_id string")


def rows_of(df):
    return sorted(map(tuple, df.select("doc_id", "text").collect()), key=str)


def test_each_stage_equals_brute_force(spark, docs, tmp_path):
    kept, at = docs, {}
    for k, (name, stage) in enumerate(cp.STAGES):
        stage(spark, kept, "").write.parquet(f"{tmp_path}/{name}")
        at[name] = (rows_of(kept), spark.read.parquet(f"{tmp_path}/{name}"))
        kept = at[name][1]
        if k < 4:
            assert kept.columns == docs.columns
            assert kept.where("text is not null and n_chars <> length(text)").count() == 0 or name == "quality_rules"
    before, got = at["quality_rules"]
    # every host has more good documents than not, so none falls
    assert rows_of(got) == sorted(((i, t) for i, t in before if not brute_rules(t)["own"]), key=str)
    before, got = at["line_dedup"]
    assert rows_of(got) == sorted(((i, t) for i, t, _, _ in brute_lines(before, wide=True, every=True)[0]), key=str)
    assert rows_of(got) != before
    before, got = at["near_duplicates"]
    label = brute_groups([brute_fp(t) for _, t in before], 4)
    signed = lambda t: __import__("test_fuzzy_lines").signed(__import__("test_fuzzy_lines").xx(t or ""))
    groups = {}
    for k, g in label.items():
        groups.setdefault(g, []).append(before[k])
    assert rows_of(got) == sorted((min(g, key=lambda r: (r[0] is None, r[0] or 0, signed(r[1]))) for g in groups.values()), key=str)
    assert got.count() < len(before)
    before, got = at["personal_data"]
    by_id = dict(rows_of(got))
    for i, t in before:
        spans = pii.base_spans(t or "")
        assert by_id[i] == t if not spans else not pii.base_spans(by_id[i]) and by_id[i].count("[") >= len(spans)
    assert any(pii.base_spans(t or "") for _, t in before)
    before, got = at["packing"]
    tok = Tokenizer.from_file(tokenizer_path(cp.WORD_FILE))
    n = {i: len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in before}
    assert {r.doc_id: r.n for r in got.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()} == n


def test_empty_table(spark, docs):
    kept = docs.where("false")
    for _, stage in cp.STAGES:
        kept = stage(spark, kept, "")
    assert kept.count() == 0


def test_run_over_the_given_table(spark):
    got = cp.run(spark, "/root/testdata/sf0.001")
    assert got.count() > 100 and got.where("offset + length > 2048").count() == 0
