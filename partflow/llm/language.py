"""Language of a text by prediction by partial matching (PPM).

Each language has a variable-order tree of byte contexts, counted once and then frozen. A text's code length under a
language is the sum over all its bytes of the bits that the tree needs: the longest known context codes the byte, or
an escape (method C: as likely as the context has different followers) and then the next shorter context, without
the bytes that the longer one would have coded; below the empty context all other bytes are alike. The chances of all
256 bytes sum to one in every context, so the lengths are exact. The language with the shortest code is predicted; its
score is its share of the likelihood, all languages being equally likely before.

Trees are counted over a sample of about ``most`` documents a language and at most ``languages`` languages, whole
texts; their size is bounded by it and doesn't grow with the table. Every text is scored, whole.

Defined results: ``und`` and score 0 for a text that is null, empty or without a letter, and for all texts if nothing
was learned; equal code lengths: the first language by name; repeated rows count each; a null id makes no difference; an
empty table gives an empty one. Columns are used by the names given, others don't matter; a kept column that is
called like an output raises ValueError.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDER = 4              # bytes of the longest context
MOST = 1_000           # documents a language that the trees are counted on, about
LANGUAGES = 512        # languages that are learned, the most frequent ones
PIECE = 1 << 20        # bytes that are looked up at once
KNOWN = 1 << 20        # grams whose code lengths a worker remembers
START = 10             # the byte before a text's first

UNKNOWN = "und"


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column of texts and the n + 1 places where a text starts or the last one ends (null: empty)."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[at[0]:at[-1]], at - at[0]


def grams(data: np.ndarray, at: np.ndarray, lo: int, hi: int, order: int = ORDER) -> np.ndarray:
    """A number per byte lo..hi: the byte and, above it, the ``order`` bytes before it in its own text."""
    before = data[max(0, lo - order):hi]
    if lo < order:
        before = np.concatenate([np.full(order - lo, START, np.uint8), before])
    near = at[np.searchsorted(at, lo - order):np.searchsorted(at, hi)] - lo
    out = before[order:].astype(np.int64)
    for j in range(1, order + 1):
        lag = before[order - j:len(before) - j].astype(np.int64)
        for d in range(j):              # the byte is so far from the start that it has fewer than j before it
            p = near + d
            lag[p[(p >= 0) & (p < hi - lo)]] = START
        out |= lag << (8 * j)
    return out


class Tree:
    """Context tree of one language from its grams and their counts."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, order: int = ORDER):
        self.levels = []
        above = None
        for j in range(order + 1):
            g, inverse = np.unique(keys & ((1 << 8 * (j + 1)) - 1), return_inverse=True)
            c = np.bincount(inverse, counts, len(g))
            ctx, first = np.unique(g >> 8, return_index=True)
            total = np.add.reduceat(c, first) if len(g) else c
            kinds = np.diff(np.r_[first, len(g)]).astype(float)
            # what the shorter context has counted of the bytes that this one knows
            shared = np.add.reduceat(above[1][np.searchsorted(above[0], g & ((1 << 8 * j) - 1))], first) if j and len(g) else np.zeros(len(ctx))
            self.levels.append((g, c, ctx, total, kinds, shared))
            above = g, c

    def bits(self, keys: np.ndarray) -> np.ndarray:
        """Code length of the last byte of each gram after the bytes before it."""
        out, done = np.zeros(len(keys)), np.zeros(len(keys), bool)
        off_n, off_sum = np.zeros(len(keys)), np.zeros(len(keys))        # what the escape has ruled out
        for j in range(len(self.levels) - 1, -1, -1):
            g, c, ctx, total, kinds, shared = self.levels[j]
            if not len(g):
                continue
            key = keys & ((1 << 8 * (j + 1)) - 1)
            at = np.minimum(np.searchsorted(ctx, key >> 8), len(ctx) - 1)
            here = ~done & (ctx[at] == key >> 8)
            k = np.minimum(np.searchsorted(g, key), len(g) - 1)
            n = np.where(g[k] == key, c[k], 0)
            rest = kinds[at] - off_n
            whole = total[at] - off_sum + rest
            hit, miss = here & (n > 0), here & (n == 0) & (rest > 0)
            out[hit] += np.log2(whole[hit]) - np.log2(n[hit])
            out[miss] += np.log2(whole[miss]) - np.log2(rest[miss])
            done |= hit
            off_n, off_sum = np.where(here, kinds[at], off_n), np.where(here, shared[at], off_sum)
        return np.where(done, out, out + np.log2(np.maximum(256 - off_n, 1)))


class Coder:
    """Code lengths under all languages; remembers those of the grams that it met."""

    def __init__(self, model: dict):
        self.names = model["names"]
        self.trees = [Tree(*t, order=model["order"]) for t in model["grams"]]
        self.order = model["order"]
        self.keys, self.cost = np.zeros(0, np.int64), np.zeros((len(self.trees), 0))

    def of(self, keys: np.ndarray) -> np.ndarray:
        """(language, gram) -> bits, for different grams."""
        at = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        inside = at < len(self.keys)
        new[inside] = self.keys[at[inside]] != keys[inside]
        out = np.empty((len(self.trees), len(keys)))
        out[:, ~new] = self.cost[:, at[~new]]
        if new.any():
            out[:, new] = [t.bits(keys[new]) for t in self.trees]
            if len(self.keys) + new.sum() > KNOWN:       # full: begin anew with what is in use
                both, cost = keys, out
            else:
                both, cost = np.concatenate([self.keys, keys[new]]), np.concatenate([self.cost, out[:, new]], 1)
            o = np.argsort(both)
            self.keys, self.cost = both[o], cost[:, o]
        return out

    def lengths(self, texts: pa.Array) -> np.ndarray:
        """(language, text) -> bits of the whole text."""
        data, at = _bytes_of(texts)
        out = np.zeros((len(self.trees), len(texts)))
        for lo in range(0, len(data), PIECE):
            hi = min(lo + PIECE, len(data))
            codes, kinds = pd.factorize(grams(data, at, lo, hi, self.order))
            cost = self.of(kinds)
            held = np.flatnonzero((at[:-1] < hi) & (at[1:] > lo) & (at[1:] > at[:-1]))     # texts with bytes here
            starts = np.maximum(at[held], lo) - lo
            for k, c in enumerate(cost):
                out[k, held] += np.add.reduceat(c[codes], starts)
        return out


def _counted(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        names = b.column(0).dictionary_encode()
        lang = np.asarray(names.indices, np.int64)
        data, at = _bytes_of(b.column(1))
        for lo in range(0, len(data), PIECE):
            hi = min(lo + PIECE, len(data))
            of = np.repeat(lang, np.clip(at[1:], lo, hi) - np.clip(at[:-1], lo, hi))
            codes, kinds = pd.factorize(grams(data, at, lo, hi, order) | of << 8 * (order + 1))
            yield pa.RecordBatch.from_arrays([
                names.dictionary.take(pa.array(kinds >> 8 * (order + 1))).cast(pa.string()),
                pa.array(kinds & ((1 << 8 * (order + 1)) - 1)), pa.array(np.bincount(codes, minlength=len(kinds)))], ["lang", "gram", "n"])


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", most: int = MOST,
          languages: int = LANGUAGES, order: int = ORDER) -> dict:
    """Frozen counts of each language, from rows with a text and a language.

    The sample takes a row by the hash of its id and text, at a rate that leaves about ``most`` of each language (all
    rows of a rarer one); grams are counted in the tasks and summed by Spark, and the sums come to the driver.
    ``order`` is 6 at most: a gram is one whole number.
    """
    if not 0 <= order <= 6:
        raise ValueError("order must be 0 to 6")
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"), F.col(id_col).alias("id")).dropna(subset=["lang", "text"])
    sizes = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()
    part = 1 << 30
    rates = docs.sparkSession.createDataFrame([(r["lang"], min(part, part * most // r["count"])) for r in sizes], "lang string, rate long")
    some = rows.join(F.broadcast(rates), "lang").where(F.pmod(F.xxhash64("id", "text"), F.lit(part)) < F.col("rate"))   # at most `languages` rows
    sums = (some.select("lang", "text").mapInArrow(partial(_counted, order=order), "lang string, gram long, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow())
    df = pd.DataFrame({"lang": sums["lang"].to_pandas(), "gram": sums["gram"].to_numpy(), "n": sums["n"].to_numpy()})
    by = {k: (g["gram"].to_numpy(np.int64), g["n"].to_numpy(float)) for k, g in df.groupby("lang")}
    return {"names": sorted(by), "grams": [by[k] for k in sorted(by)], "order": order}


def _predicted(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    coder = Coder(sent.value)
    names = pa.array([*coder.names, UNKNOWN], pa.string())
    for b in batches:
        texts = b.column(b.num_columns - 1)
        known = np.asarray(texts.is_valid())
        best, score = np.full(b.num_rows, len(coder.names)), np.zeros(b.num_rows)
        if coder.names and known.any():
            bits = coder.lengths(texts)
            least = bits.argmin(0)
            share = 1 / np.exp2(np.maximum(bits.min(0) - bits, -1000)).sum(0)
            best, score = np.where(known, least, best), np.where(known, share, score)
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], names.take(pa.array(best)), pa.array(score)],
                                         [*b.schema.names[:-1], "lang_pred", "score"])


def predict(docs: DataFrame, model: dict, keep: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """The columns ``keep`` with ``lang_pred`` and ``score`` of every row; only the text is looked at. No shuffle.

    The trees go to the workers as one broadcast, whose size the sample of :func:`train` bounds.
    """
    keep = keep if keep is not None else ["doc_id"]
    if {"lang_pred", "score"} & set(keep):
        raise ValueError("a kept column is called like an output")
    text = F.col(text_col).cast("string")
    rows = docs.select(*[F.col(c) for c in keep], F.when(has_letter(text), text).alias("_text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(lambda it: _predicted(it, sent), f"{types}, lang_pred string, score double")


def has_letter(text: Column) -> Column:
    return text.rlike(r"\p{L}")
