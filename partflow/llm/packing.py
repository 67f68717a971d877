"""Packing token sequences into windows of a fixed size, best fit decreasing.

A document that is longer than the window is first cut into full windows and a rest. The rests
(and shorter documents) are taken by falling length; a segment tree over the
remaining capacities of the open windows finds the tightest one that takes a piece.
Pieces are dealt by hash into groups of bounded size, each packed by one task; a group leaves at
most its last few windows loosely filled.
"""

from __future__ import annotations

import struct
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.session import materialize

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, row long"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text",
           end_id: int = 1, with_ids: bool = False, docs_per_call: int = 200) -> DataFrame:
    """One row per piece of each whole text's ids: full windows, then the rest. No shuffle.

    ``ids_crc32`` is taken over the piece's ids as little-endian unsigned 32-bit integers,
    which come along as ``ids`` (binary) if asked for. ``row`` numbers a task's rows, so that repeated
    rows stay apart. Null text: empty, so its only id is ``end_id``. Null id: kept as null.
    """
    schema = PIECES + (", ids binary" if with_ids else "")

    def cut(batches):
        import pyarrow as pa

        from partflow.llm.token_file import _arrow
        from partflow.llm.words import encoder

        enc, last, row, names = encoder(tokenizer), struct.pack("<I", end_id), 0, _arrow(schema)
        for batch in batches:
            for i in range(0, batch.num_rows, docs_per_call):
                part, out = batch.slice(i, docs_per_call), []
                for doc, raw in zip(part.column(0).to_pylist(), enc.many([x.as_py() for x in part.column(1)])):
                    raw, row = raw + last, row + 1
                    n = len(raw) // 4
                    for at in range(0, n, capacity):
                        ids = raw[4 * at:4 * (at + capacity)]
                        out.append((doc, at, len(ids) // 4, zlib.crc32(ids), n, row, ids)[:len(names)])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), names.types)], schema=names)

    return docs.select(F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit("")).cast("binary")).mapInArrow(cut, schema)


class Windows:
    """Open windows by remaining capacity; a segment tree over the capacities holds which are there."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.leaves = 1 << capacity.bit_length()
        self.there = [0] * (2 * self.leaves)
        self.at: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.n = 0

    def _mark(self, room: int, there: int) -> None:
        k = self.leaves + room
        self.there[k] = there
        k >>= 1
        while k:
            now = self.there[2 * k] | self.there[2 * k + 1]
            if self.there[k] == now:
                break
            self.there[k] = now
            k >>= 1

    def tightest(self, need: int) -> int | None:
        """The least remaining capacity of at least ``need`` among the open windows."""
        k = self.leaves + need
        if not self.there[k]:
            while k > 1 and (k & 1 or not self.there[k + 1]):
                k >>= 1
            if k <= 1:
                return None
            k += 1
            while k < self.leaves:
                k = 2 * k if self.there[2 * k] else 2 * k + 1
        return k - self.leaves

    def put(self, length: int) -> tuple[int, int]:
        """(window, offset) of a piece; opens a window if none takes it."""
        room = self.tightest(length)
        if room is None:
            room, window = self.capacity, self.n
            self.n += 1
        else:
            window = self.at[room].pop()
            if not self.at[room]:
                self._mark(room, 0)
        left = room - length
        if left:
            self.at[left].append(window)
            if len(self.at[left]) == 1:
                self._mark(left, 1)
        return window, self.capacity - room


def pack(cut: DataFrame, capacity: int = 2048, pieces_per_group: int = 40_000) -> DataFrame:
    """The pieces with their ``sequence_id`` and ``offset`` in it.

    A window's pieces follow each other without a gap. Ids: the group's number times 2^32
    plus the window's number there. Equal lengths are taken by (doc_id, start, row). ``cut`` is written
    once to the shared folder, which also gives the number of groups. Empty input: empty.
    """
    cut = materialize(cut, "pieces")
    groups = max(1, -(-cut.count() // pieces_per_group))
    out = cut.drop("row").schema.add("sequence_id", "long").add("offset", "long")

    def fit(key, t):
        import pyarrow as pa

        t = t.drop_columns(["_group"]).sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"),
                                                ("row", "ascending")])
        open_, base = Windows(capacity), key[0].as_py() << 32
        placed = [open_.put(n) for n in t.column("length").to_pylist()]
        return (t.drop_columns(["row"]).append_column("sequence_id", pa.array([base + w for w, _ in placed], pa.int64()))
                .append_column("offset", pa.array([o for _, o in placed], pa.int64())))

    return (cut.withColumn("_group", F.pmod(F.xxhash64("doc_id", "start", "row"), F.lit(groups)).cast("int"))
            .groupBy("_group").applyInArrow(fit, out))


def sequences(packed: DataFrame, capacity: int = 2048, pad_id: int = 0) -> DataFrame:
    """(sequence_id, n_tokens, ids): each window's ids, padded to ``capacity`` unless their number is a power of two.

    ``packed`` must carry ``ids``. A window holds at most ``capacity`` ids, so a group of rows is bounded.
    """
    pad = struct.pack("<I", pad_id).hex()
    rows = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"),
                                             F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    ids = F.aggregate("p", F.unhex(F.lit("")), lambda a, x: F.concat(a, x["ids"]))
    short = F.when(F.bit_count("n_tokens") == 1, 0).otherwise(capacity - F.col("n_tokens")).cast("int")
    return rows.select("sequence_id", "n_tokens", F.concat(ids, F.unhex(F.repeat(F.lit(pad), short))).alias("ids"))
