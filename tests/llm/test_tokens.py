import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from partflow.llm import token_file
from partflow.llm.common import dealt, range_cuts, range_of, shared_folder, ship, tokenizer_path
from partflow.llm.words import WordEncoder

PATH = tokenizer_path("word_bpe_49k.json")
ODD = ["", " ", "a", "A.,b ..c., d.-e f). it's IT'S don't,we'll. 123,456.78", "<|endoftext|> x", "<|ENDOFTEXT|>y <| z",
       "é, ñ. é, Σας ΟΔΟΣ. İstanbul,  x　y", "tab\tand\x0bfeed\r\nline\n\nlast.", "日本語,テスト。 😀👍🏽 ok.", "x" * 5000,
       "word " * 3000, ".", ",", ".a", "a.", "a.b", "a.́ b"]


@pytest.fixture
def docs(spark):
    ship(spark)
    rows = [(i * 7 - 20, t, 1) for i, t in enumerate(ODD)] + [(None, "no id", 2), (5000, None, 3), (1, "same id", 4),
                                                             (1, "same id", 4), (1, "other", 5)]
    return spark.createDataFrame(rows, "doc_id long, text string, start int")


def ids(text):
    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 1]


def crc(x):
    return zlib.crc32(np.array(x, "<u4").tobytes())


def test_words_equal_whole_texts():
    enc = WordEncoder(PATH)
    for _ in range(2):
        got = [np.frombuffer(b, "<u4").tolist() + [1] for b in enc.many([t.encode() for t in ODD])]
        assert got == [ids(t) for t in ODD]


def test_words_beyond_the_memory(monkeypatch):
    monkeypatch.setattr("partflow.llm.words.MEMORY", 3)
    test_words_equal_whole_texts()


@pytest.mark.parametrize("width", [2, 4])
def test_files_round_trip(spark, docs, width):
    out = shared_folder(spark, "t")
    token_file.write_tokens(docs, out, PATH, width=width, docs_per_shard=4, docs_per_call=2)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_file.read_tokens(spark, out, width).collect())
    rows = docs.collect()
    assert [d for _, d, _, _ in got] == sorted((r.doc_id for r in rows), key=lambda x: (x is not None, x))
    at = 0
    for start, _, n, _ in got:
        assert start == at
        at += n
    assert sorted((str(d), n, c) for _, d, n, c in got) == sorted(
        (str(r.doc_id), len(ids(r.text)), crc(ids(r.text))) for r in rows)


def test_empty_table(spark, docs):
    out = shared_folder(spark, "t")
    assert token_file.write_tokens(docs.where("false"), out, PATH).count() == 0
    assert token_file.read_tokens(spark, out).count() == 0


def test_ranges_are_even_and_stable(spark):
    df = spark.range(10000).select((F.col("id") * F.col("id")).alias("k"))
    cuts = range_cuts(df, "k", 10)
    assert cuts == range_cuts(df.repartition(7), "k", 10) and len(cuts) == 9
    per = {r[0]: r[1] for r in df.groupBy(range_of(F.col("k"), cuts)).count().collect()}
    assert set(per) == set(range(10)) and max(per.values()) < 2000
    brute = [sum(c <= k for c in cuts) for k in (None, -5, 0, cuts[0], cuts[0] - 1, cuts[-1], 10 ** 12) if k is not None]
    got = spark.createDataFrame([(-5,), (0,), (cuts[0],), (cuts[0] - 1,), (cuts[-1],), (10 ** 12,)], "k long").select(
        range_of(F.col("k"), cuts)).collect()
    assert [r[0] for r in got] == brute
    assert dealt(df, "k", cuts).rdd.getNumPartitions() == 10
