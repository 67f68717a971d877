import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from partflow.llm import packing
from partflow.llm.common import ship, tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")


def test_windows_take_the_tightest():
    rnd = random.Random(1)
    w, room = packing.Windows(64), []
    for _ in range(3000):
        n = rnd.randint(1, 64)
        fit = [r for r in room if r >= n]
        assert w.tightest(n) == (min(fit) if fit else None)
        k, offset = w.put(n)
        if k == len(room):
            assert not fit and offset == 0
            room.append(64)
        else:
            assert room[k] == min(fit) and offset == 64 - room[k]
        room[k] -= n


@pytest.fixture
def docs(spark):
    ship(spark)
    rnd = random.Random(4)
    rows = [(i, " ".join(rnd.choice(["alpha", "be", "c", "delta,"]) for _ in range(rnd.randint(0, 150))), 0) for i in range(200)]
    rows += [(None, "no id", 1), (500, None, 1), (3, "again", 1), (3, "again", 1), (501, "long " * 5000, 1), (502, "", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, length int")


@pytest.mark.parametrize("capacity,per", [(2048, 40_000), (64, 50), (1, 40_000)])
def test_pieces_cover_every_id_once(docs, capacity, per):
    if capacity == 1:
        docs = docs.where("length = 1 and doc_id <> 501")
    out = packing.pack(packing.pieces(docs, PATH, capacity, with_ids=True), capacity, per).collect()
    tok = Tokenizer.from_file(PATH)
    whole = defaultdict(list)
    for r in docs.collect():
        whole[r.doc_id].append([*tok.encode(r.text or "", add_special_tokens=False).ids, 1])
    for r in out:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert len(ids) == r.length <= capacity and zlib.crc32(bytes(r.ids)) == r.ids_crc32
        assert any(x[r.start:r.start + r.length] == ids and len(x) == r.doc_tokens for x in whole[r.doc_id])
    assert sum(r.length for r in out) == sum(len(x) for w in whole.values() for x in w)
    seqs = defaultdict(list)
    for r in out:
        seqs[r.sequence_id].append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= capacity
    if capacity > 1:
        open_ = sum(sum(n for _, n in s) for s in seqs.values()) / capacity
        assert len(seqs) <= open_ * 1.1 + 2 * -(-len(out) // per)


def test_sequences_are_padded(docs):
    got = packing.sequences(packing.pack(packing.pieces(docs, PATH, 64, with_ids=True), 64), 64, pad_id=7).collect()
    for r in got:
        ids = np.frombuffer(bytes(r.ids), "<u4")
        assert len(ids) == (r.n_tokens if bin(r.n_tokens).count("1") == 1 else 64) and (ids[r.n_tokens:] == 7).all()


def test_empty_table(docs):
    assert packing.pack(packing.pieces(docs.where(F.lit(False)), PATH)).count() == 0
