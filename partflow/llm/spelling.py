"""Spelling variants: words of the corpus that differ by one letter, and the form that a rare one stands for.

Words are counted where the texts are, summed by word, and laid out in blocks of words of about equal length
and letters. Two blocks are compared by the Gram matrix of their letter counts: it gives all squared distances
of the counts, and one inserted, deleted or replaced letter moves them by at most two. Only blocks of adjacent
lengths whose letter counts come that near are multiplied, and each pair within distance two is verified letter by letter.

Letters are A-Z, a-z and the code points U+00C0 to U+00FF, so that a word is a byte string with one byte a letter.

Defined results: a null text has no words; a null id counts as an empty one; repeated rows count each; an empty table
gives an empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.session import materialize, materialize_observed

LEAST_LETTERS = 6      # of a word
LEAST_COUNT = 5        # occurrences of a word
FACTOR = 5             # a form is at least so many times as frequent
SLIP = 199             # every so manieth hash drops a letter
BLOCK = 16_384         # words of a block at most: what one comparison holds in memory, twice
TILE = 1_024           # words of a tile: rows and columns of one matrix product
HELD = 400_000         # words that a task counts before it passes the counts on

_LETTERS = bytes(range(97, 123)) + bytes(range(0xC0, 0x100))
# letters stay (A-Z in lower case), all else becomes a space
_TABLE = bytes((c + 32 if 65 <= c <= 90 else c if c in _LETTERS else 32) for c in range(256))
_COLUMN = np.zeros(256, np.int64)
_COLUMN[list(_LETTERS)] = np.arange(len(_LETTERS))
GROUPS = 6             # letter groups whose counts order the words of a length
_GROUP = np.array([i % GROUPS for i in range(len(_LETTERS))])


def slipped(word: bytes, doc: bytes, slip: int = SLIP) -> bytes:
    """The word as the document has it: a letter is dropped if ``slip`` divides the hash of document and word."""
    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), zlib.crc32(doc + b":"))
    if h % slip:
        return word
    k = h % len(word)
    return word[:k] + word[k + 1:]


def _count(batches: Iterator[pa.RecordBatch], least: int, slip: int) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held], pa.string()),
                                           pa.array(list(held.values()), pa.int64())], ["word", "n"])

    for b in batches:
        for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
            text = text.as_py()
            if not text:
                continue
            doc = str(doc if doc is not None else "").encode()
            for w, n in Counter(text.encode("latin-1", "replace").translate(_TABLE).split()).items():
                if len(w) >= least:
                    w = slipped(w, doc, slip)
                    if len(w) >= least:
                        held[w] += n
            if len(held) >= HELD:
                yield out()
                held.clear()
    if held:
        yield out()


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_LETTERS,
               count: int = LEAST_COUNT, slip: int = SLIP) -> DataFrame:
    """(word, n): the words of at least ``least`` letters and ``count`` occurrences in all texts, after slips."""
    rows = docs.select(F.col(id_col).alias("d"), F.col(text_col).cast("string").alias("t"))
    got = rows.mapInArrow(lambda it: _count(it, least, slip), "word string, n long")
    return got.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= count)


def letter_counts(words: list[bytes]) -> np.ndarray:
    """A row of letter counts per word."""
    at = np.repeat(np.arange(len(words)), [len(w) for w in words])
    out = np.zeros((len(words), len(_LETTERS)), np.float32)
    np.add.at(out, (at, _COLUMN[np.frombuffer(b"".join(words), np.uint8)]), 1)
    return out


def group_counts(counts: np.ndarray) -> np.ndarray:
    return np.stack([counts[:, _GROUP == g].sum(1) for g in range(GROUPS)], 1).astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the words of one task, in order: words and counts as bytes, the range of lengths and group counts."""
    words, ns, k = [], [], 0

    def out(k: int) -> pa.RecordBatch:
        w, n = words[:BLOCK], ns[:BLOCK]
        del words[:BLOCK], ns[:BLOCK]
        g = np.concatenate([np.array([[len(x)] for x in w]), group_counts(letter_counts(w))], 1)
        return pa.RecordBatch.from_pydict({"k": pa.array([k], pa.int64()), "words": pa.array([b" ".join(w)], pa.binary()),
                                           "ns": pa.array([np.array(n, np.int64).tobytes()], pa.binary()),
                                           "low": pa.array([g.min(0).tolist()], pa.list_(pa.int32())),
                                           "high": pa.array([g.max(0).tolist()], pa.list_(pa.int32()))})

    for b in batches:
        words += [w.encode("latin-1") for w in b.column(0).to_pylist()]
        ns += b.column(1).to_pylist()
        while len(words) >= BLOCK:
            yield out(k)
            k += 1
    if words:
        yield out(k)


def _near_boxes(low: np.ndarray, high: np.ndarray, low2: np.ndarray, high2: np.ndarray) -> np.ndarray:
    """Whether two ranges of (length, group counts) can hold words one edit apart: lengths by one, group counts by two in all."""
    gap = np.maximum(0, np.maximum(low[:, None] - high2[None], low2[None] - high[:, None]))
    return (gap[..., 0] <= 1) & (gap[..., 1:].sum(-1) <= 2)


def one_edit(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Of each pair of words whether one letter inserted, deleted or replaced makes them equal."""
    la, lb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    out = np.zeros(len(a), bool)
    if not len(a):
        return out
    swap = la > lb
    short, long = [y if s else x for x, y, s in zip(a, b, swap)], [x if s else y for x, y, s in zip(a, b, swap)]
    n, m = np.minimum(la, lb), np.maximum(la, lb)
    width = int(m.max())
    s = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in short), np.uint8).reshape(-1, width)
    t = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in long), np.uint8).reshape(-1, width)
    differ = (s != t) & (np.arange(width) < n[:, None])
    out[la == lb] = differ.sum(1)[la == lb] == 1
    by_one = m - n == 1
    if by_one.any():
        # equal up to the first difference, and from there with the longer word moved by one
        moved = np.zeros_like(differ)
        moved[:, :-1] = s[:, :-1] != t[:, 1:]
        moved &= np.arange(width) < n[:, None]
        first = np.where(differ.any(1), differ.argmax(1), n)
        last = np.where(moved.any(1), width - 1 - moved[:, ::-1].argmax(1), -1)
        out[by_one] = (last < first)[by_one]
    return out


def _tiles(words: list[bytes]) -> list[tuple]:
    """The words of a block in tiles: (start, letter counts, squares, low, high)."""
    out = []
    for k in range(0, len(words), TILE):
        c = letter_counts(words[k:k + TILE])
        g = np.concatenate([np.array([[len(x)] for x in words[k:k + TILE]]), group_counts(c)], 1)
        out.append((k, c, (c * c).sum(1), g.min(0), g.max(0)))
    return out


def near_pairs(a: list[bytes], b: list[bytes], same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of all pairs of words of two blocks that are one edit apart; of one block with i < j."""
    left, right = _tiles(a), _tiles(b)
    near = _near_boxes(*(np.array([t[k] for t in side]) for side in (left, right) for k in (3, 4)))
    found = [], []
    for x, y in zip(*np.nonzero(near)):
        if same and y < x:
            continue
        (i0, c, cc, *_), (j0, d, dd, *_) = left[x], right[y]
        # |c|^2 + |d|^2 - 2 c.d as one matrix product
        far = np.concatenate([c * -2, cc[:, None], np.ones((len(c), 1), np.float32)], 1) @ \
            np.concatenate([d, np.ones((len(d), 1), np.float32), dd[:, None]], 1).T
        i, j = np.divmod(np.flatnonzero(far < 2.5), far.shape[1])
        if same and x == y:
            i, j = i[i < j], j[i < j]
        for s in range(0, len(i), 200_000):
            p, q = i[s:s + 200_000] + i0, j[s:s + 200_000] + j0
            ok = one_edit([a[k] for k in p], [b[k] for k in q])
            found[0].append(p[ok])
            found[1].append(q[ok])
    none = np.zeros(0, np.int64)
    return np.concatenate(found[0] or [none]), np.concatenate(found[1] or [none])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per pair of blocks and word: how many near words the other block has, and the most frequent of them."""
    for batch in batches:
        for r in range(batch.num_rows):
            row = {k: batch.column(k)[r].as_py() for k in batch.schema.names}
            same = row["a"] == row["b"]
            a, b = row["a_words"].split(b" "), row["b_words"].split(b" ")
            na, nb = np.frombuffer(row["a_ns"], np.int64), np.frombuffer(row["b_ns"], np.int64)
            i, j = near_pairs(a, b, same)
            for at, other, n, words, near in ((i, j, nb, a, b), (j, i, na, b, a)):
                if not len(at):
                    continue
                rank = np.empty(len(near), np.int64)     # words in order of letters, for ties
                rank[sorted(range(len(near)), key=near.__getitem__)] = np.arange(len(near))
                o = np.lexsort((rank[other], -n[other], at))
                at, other = at[o], other[o]
                first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
                yield pa.RecordBatch.from_arrays([
                    pa.array([words[k].decode("latin-1") for k in at[first]], pa.string()),
                    pa.array(np.diff(np.r_[first, len(at)])), pa.array(n[other[first]]),
                    pa.array([near[k].decode("latin-1") for k in other[first]], pa.string())], ["word", "n_near", "best_n", "best"])


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best): for each word that has any, its words at one edit, counted, and the most frequent
    of them (the first in code-point order of equals). ``words`` is a written (word, n) table of distinct words.

    The comparisons grow with the square of the words of a length by the method; tiles and blocks that cannot
    hold a pair are passed over. Blocks, not single pairs of words, are shuffled.
    """
    spark = words.sparkSession
    n_blocks = max(1, -(-words.count() // (BLOCK * 3 // 4)))
    groups = [F.length(F.regexp_replace("word", "[^" + "".join(chr(c) for c, g in zip(_LETTERS, _GROUP) if g == k) + "]", ""))
              for k in range(GROUPS - 1)]
    keys = words.select(F.length("word").alias("_0"), *[g.alias(f"_{k + 1}") for k, g in enumerate(groups)], "word", "n")
    order = [f"_{k}" for k in range(GROUPS)] + ["word"]
    dealt = keys.repartitionByRange(n_blocks, *order).sortWithinPartitions(*order).select("word", "n")
    blocks = materialize(dealt.mapInArrow(_blocks, "k long, words binary, ns binary, low array<int>, high array<int>")
                         .withColumn("id", F.spark_partition_id().cast("long") * (1 << 33) + F.col("k")), "word-blocks")
    # blocks meet on a length, the left one's or one more; the ranges of group counts say which of them are compared
    side = lambda p: blocks.select(F.col("id").alias(p), F.col("low").alias(p + "_low"), F.col("high").alias(p + "_high"))
    left = side("a").withColumn("at", F.explode(F.expr("sequence(a_low[0] - 1, a_high[0] + 1)")))
    right = side("b").withColumn("at", F.explode(F.expr("sequence(b_low[0], b_high[0])")))
    gap = " + ".join(f"greatest(0, a_low[{k}] - b_high[{k}], b_low[{k}] - a_high[{k}])" for k in range(1, GROUPS + 1))
    pairs = materialize(left.join(right, "at").where("a <= b").where(f"{gap} <= 2").select("a", "b").distinct(), "block-pairs")
    for p in ("a", "b"):
        pairs = pairs.join(blocks.select(F.col("id").alias(p), F.col("words").alias(p + "_words"), F.col("ns").alias(p + "_ns")), p)
    work = pairs.repartition(max(n_blocks, int(spark.conf.get("spark.sql.shuffle.partitions")) * 2), "a", "b")
    found = work.mapInArrow(_compare, "word string, n_near long, best_n long, best string")
    best = F.min_by(F.struct("best_n", "best"), F.struct(-F.col("best_n"), F.col("best")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_b")).select("word", "n_near", "_b.best_n", "_b.best")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of a (word, form) table without loops: the last word when forms are followed. Links double per round.

    A form is at least ``FACTOR`` times as frequent as its word, so the rounds are few.
    """
    at = materialize(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        nxt = at.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        at, seen = materialize_observed(at.join(nxt, "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")),
            "forms", moved=F.sum(F.col("moved").cast("long")))
        at = at.drop("moved")
        if not seen["moved"]:
            return at


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_LETTERS,
             count: int = LEAST_COUNT, factor: int = FACTOR, slip: int = SLIP) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of all words: its form is the most frequent word at one edit, if that is
    at least ``factor`` times as frequent; the root is the last form of forms. See the module for odd rows."""
    words = materialize(vocabulary(docs, id_col, text_col, least, count, slip), "words")
    near = neighbours(words)
    enough = F.col("best_n") >= factor * F.col("n")
    rows = materialize(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best")).alias("form"), F.when(enough, F.col("best_n")).alias("form_n")), "variants")
    last = roots(rows.where(F.col("form").isNotNull()))
    return rows.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
