import random

import numpy as np
import pytest
import sentencepiece

from partflow.llm import piece
from partflow.llm.common import ship, tokenizer_path

PATH = tokenizer_path("piece_bpe_32k.model")
ODD = ["", " ", "  ", " a", "a ", "  a  b ", "\n", "a\n\n b \n", " \n x", "▁a▁▁b", " ▁x", "日本語 テキスト。", "😀👍🏽 ok",
       "<0x0A> <s> </s> <unk>", "x" * 3000, "a" * 900, " " * 40, "\t\ttab", "İ Σ", "a\x00b", "\r\n", "word. word, Word!? no;",
       "https://example.com/?q=1&b=2", "def f(x):\n        return x**2\n", "the end. " * 2000]


@pytest.fixture(scope="module")
def lib():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.mark.parametrize("memory", [250_000, 20])
def test_same_as_the_library(lib, memory, monkeypatch):
    monkeypatch.setattr(piece, "MEMORY", memory)
    monkeypatch.setattr(piece, "LATEST", 7)
    table, rnd = piece.PieceTable(PATH), random.Random(2)
    texts = ODD + ["".join(rnd.choice("aeionrst ▁\n.,é語😀0123 ") for _ in range(rnd.randint(1, 60))) for _ in range(1500)]
    # marks after letters, digits, other marks and brackets: where the text may be cut and where it may not
    texts += [" ".join("".join(rnd.choice("abé1日)\"'") for _ in range(rnd.randint(1, 4))) + rnd.choice(",.;:!?") * rnd.randint(0, 2)
                       for _ in range(rnd.randint(1, 6))) for _ in range(1500)]
    for t in texts:
        got = np.frombuffer(table.encode(t), "<u4").tolist()
        assert got == lib.encode(t), t
        assert table.decode([1, *got, 2]) == lib.decode([1, *got, 2]), t


def test_decodes_any_ids_as_the_library(lib):
    table, rnd = piece.piece_table(PATH), random.Random(3)
    for _ in range(3000):
        ids = [rnd.choice([0, 1, 2, rnd.randint(3, 258), rnd.randint(0, 31999), 259, 198, 132, 230]) for _ in range(rnd.randint(0, 12))]
        assert table.decode(ids) == lib.decode(ids), ids


def test_columns_nulls_and_repeats(spark, lib):
    ship(spark)
    rows = [(1, "a b", 9), (1, "a b", 9), (None, None, None), (3, "", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = piece.decode(piece.encode(df, PATH), PATH).collect()
    assert [(r.doc_id, r.n_tokens) for r in got] == [(r[0], r[2]) for r in rows]
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in got] == [[1, *lib.encode(t or ""), 2] for _, t, _ in rows]
    assert [r.decoded for r in got] == ["a b", "a b", "", ""]
    assert piece.encode(df.where("false"), PATH).count() == 0
    with pytest.raises(ValueError):
        piece.encode(df.withColumnRenamed("n_tokens", "ids"), PATH)


def test_texts_of_ids_are_taken_out_of_one_pool():
    t = piece.piece_table(PATH)
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 50, 3000):
        ids = rng.integers(0, len(t.pieces), n)
        assert t._bytes(ids) == b"".join(t.texts[i] for i in ids)
        assert t.decode(ids) == t.decode(ids.tolist())
