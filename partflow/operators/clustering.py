"""Text clusters: k-means over the sparse TF-IDF rows of documents.

Documents are turned into rows of (feature number, weight) once, without a shuffle of their tokens, and written. The
features are the terms of the most documents (at most ``features`` of them, ties by term), as a vectoriser with a limit
on its features has them; idf and norm are those of :func:`partflow.operators.text.tfidf` over the kept terms.

The start is k-means||: from one document on, each round takes every document with a chance that grows with its
distance from the candidates so far, by a seeded hash of its id, so that rounds, not single draws, pass over the data. The
candidates, weighted by the documents nearest to them, are then thinned out to k. A Lloyd round is one pass: tasks assign their
documents and sum them per cluster and feature, and Spark adds the sums of the tasks.

What a task, the driver and a broadcast hold is bounded by (centres x features) numbers: k = 8 and 32,768 features take 2 MB,
the candidates of a start (about 1 + 3 x 16) 13 MB. Documents never leave the tasks but for those that are candidates.

Defined results: a document without a kept term (null or empty text) has the zero vector and belongs to the centre of least length;
distances are rounded to 9 digits and ties go to the smaller cluster; a cluster that loses all documents keeps its
centre; fewer distinct documents than k give fewer clusters; an empty table gives no rows; a null id is never a candidate.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partflow.operators.text import TOKEN_PATTERN
from partflow.session import materialize, ship

FEATURES = 1 << 15
DIGITS = 9             # of a distance
CELLS = 1 << 20        # numbers of one product in a task
SLICE = 256            # documents that a task turns into numbers at a time


@dataclass
class Vectors:
    """Documents as sparse rows: ``rows`` (doc, ids, weights), written; ``terms`` by feature number."""
    rows: DataFrame
    terms: list[str]
    id_col: str


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """At most ``SLICE`` documents at a time: a batch of 10,000 takes several times its tokens in numbers."""
    for b in batches:
        for k in range(0, b.num_rows, SLICE):
            yield b.slice(k, SLICE)


def _to_rows(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    terms, idf = sent.value
    for b in _sliced(batches):
        lists = b.column(1)
        n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        found = pc.fill_null(pc.index_in(lists.flatten(), value_set=terms), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        key = (np.repeat(np.arange(len(n)), n) * (len(terms) + 1) + found)[found >= 0]
        key, times = np.unique(key, return_counts=True)
        doc, term = np.divmod(key, len(terms) + 1)
        w = times * idf[term]
        w /= np.sqrt(np.bincount(doc, w * w, len(n)))[doc]
        at = pa.array(np.searchsorted(doc, np.arange(len(n) + 1)).astype(np.int32))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(at, pa.array(term.astype(np.int32))), pa.ListArray.from_arrays(at, pa.array(w))],
                                         ["doc", "ids", "weights"])


def vectors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", features: int = FEATURES) -> Vectors:
    """Sparse TF-IDF rows over the ``features`` terms of the most documents. Texts are read whole, twice."""
    tokens = F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(TOKEN_PATTERN), 0)
    seen = materialize(docs.select(F.explode(F.array_distinct(tokens)).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")), "document-counts")
    # the count from which on there are enough terms: else every task would send its first `features` to the driver
    sizes = seen.groupBy("df").agg(F.count(F.lit(1)).alias("n"))
    enough = sizes.select("df", F.sum("n").over(Window.orderBy(F.desc("df"))).alias("n")).where(F.col("n") >= features)
    least = enough.agg(F.max("df")).first()[0] or 0
    kept = seen.where(F.col("df") >= least).orderBy(F.desc("df"), "term").limit(features).collect()
    idf = np.log((docs.count() + 1) / (np.array([r["df"] for r in kept], float) + 1)) + 1
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast((pa.array([r["term"] for r in kept], pa.string()), idf))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc"), tokens.alias("t")).mapInArrow(
        lambda it: _to_rows(it, sent), f"doc {kind}, ids array<int>, weights array<double>")
    return Vectors(materialize(rows, "vectors"), [r["term"] for r in kept], id_col)


def _batch(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts and end, feature numbers, weights) of the documents of a batch."""
    ids = b.column(1)
    at = ids.offsets.to_numpy().astype(np.int64)
    return at - at[0], ids.flatten().to_numpy(), b.column(2).flatten().to_numpy()


def _distances(at: np.ndarray, ids: np.ndarray, w: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """(document, centre) squared distances; ``centres`` has a row per feature."""
    dots, k = np.zeros((len(at) - 1, centres.shape[1])), centres.shape[1]
    full = np.flatnonzero(at[1:] > at[:-1])
    step = max(1, CELLS // k)
    lo = 0
    while lo < len(full):
        hi = max(lo + 1, int(np.searchsorted(at[full + 1], at[full[lo]] + step, "right")))
        a, z = at[full[lo]], at[full[hi - 1] + 1]
        dots[full[lo:hi]] = np.add.reduceat(centres[ids[a:z]] * w[a:z, None], at[full[lo:hi]] - a, axis=0)
        lo = hi
    own = (at[1:] > at[:-1]).astype(float)
    return np.maximum(np.round(own[:, None] + (centres * centres).sum(0) - 2 * dots, DIGITS), 0)


def _nearest(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    for b in _sliced(batches):
        d = _distances(*_batch(b), sent.value)
        near = d.argmin(1)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(d)), near])], ["doc", "cluster", "d2"])


def _summed(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    """Of the documents of a task, the sum of weights per cluster and feature; feature -1 counts the documents."""
    centres = sent.value
    sums, n = np.zeros(centres.shape[::-1]), np.zeros(centres.shape[1])
    for b in _sliced(batches):
        at, ids, w = _batch(b)
        near = _distances(at, ids, w, centres).argmin(1)
        n += np.bincount(near, minlength=len(n))
        cell = np.repeat(near, np.diff(at)) * centres.shape[0] + ids
        if len(cell):
            some, inverse = np.unique(cell, return_inverse=True)
            sums.reshape(-1)[some] += np.bincount(inverse, w)
    c, t = np.nonzero(sums)
    some = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(np.r_[c, some].astype(np.int32)), pa.array(np.r_[t, np.full(len(some), -1)].astype(np.int32)),
                                      pa.array(np.r_[sums[c, t], n[some]])], ["cluster", "feature", "s"])


def _sent(v: Vectors, centres: np.ndarray):
    return v.rows.sparkSession.sparkContext.broadcast(np.ascontiguousarray(centres.T))


def nearest(v: Vectors, centres: np.ndarray) -> DataFrame:
    """(doc, cluster, d2) of every document; one pass, no shuffle."""
    sent, kind = _sent(v, centres), v.rows.schema["doc"].dataType.simpleString()
    return v.rows.mapInArrow(lambda it: _nearest(it, sent), f"doc {kind}, cluster int, d2 double")


def cluster_sums(v: Vectors, centres: np.ndarray) -> DataFrame:
    """(cluster, feature, s): weights of the nearest documents, summed; feature -1 has their number."""
    sent = _sent(v, centres)
    parts = v.rows.mapInArrow(lambda it: _summed(it, sent), "cluster int, feature int, s double")
    return parts.groupBy("cluster", "feature").agg(F.sum("s").alias("s"))


def chance(doc: Column, seed: int, turn: int) -> Column:
    """A number from 0 to 1 by the md5 of seed, round and document: 48 bits."""
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(str(turn)), doc.cast("string"))), 1, 12)
    return F.conv(digits, 16, 10).cast("double") / float(1 << 48)


def _dense(rows: list, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width))
    for k, r in enumerate(rows):
        out[k, r["ids"]] = r["weights"]
    return out


def start(v: Vectors, k: int, seed: int = 1, rounds: int = 3, each: int | None = None) -> np.ndarray:
    """Centres (at most k rows) by k-means||: ``each`` documents (default 2 k) are expected to be taken a round.

    Of the candidates the one with the most documents comes first, then always the one whose documents times squared
    distance to the centres so far is largest (equal: the earlier candidate).
    """
    each = 2 * k if each is None else each
    rows = v.rows.where(F.col("doc").isNotNull())
    first = rows.orderBy(chance(F.col("doc"), seed, 0), "doc").limit(1).collect()
    if not first:
        return np.zeros((0, len(v.terms)))
    centres = _dense(first, len(v.terms))
    for turn in range(1, rounds + 1):
        d = materialize(nearest(v, centres).select("doc", "d2"), "distances")
        whole = d.agg(F.sum("d2")).first()[0]
        if not whole:
            break
        # about `each` documents; looked up by a filter, so that no rows are shuffled for them
        taken = [r["doc"] for r in d.where(chance(F.col("doc"), seed, turn) * whole < each * F.col("d2")).select("doc").collect()]
        centres = np.vstack([centres, _dense(sorted(rows.where(F.col("doc").isin(taken)).collect(), key=lambda r: r["doc"]), len(v.terms))])
    weight = np.zeros(len(centres))
    for r in nearest(v, centres).groupBy("cluster").count().collect():
        weight[r["cluster"]] = r["count"]
    square = (centres * centres).sum(1)
    d2 = np.maximum(np.round(square[:, None] + square - 2 * centres @ centres.T, DIGITS), 0)
    chosen, far = [int(weight.argmax())], d2[int(weight.argmax())]
    while len(chosen) < k:
        value = np.round(weight * far, 6)
        if value.max() <= 0:
            break
        chosen.append(int(value.argmax()))
        far = np.minimum(far, d2[chosen[-1]])
    return centres[chosen]


def lloyd(v: Vectors, centres: np.ndarray, rounds: int) -> np.ndarray:
    """The centres after ``rounds`` rounds, or fewer if they stand still."""
    for _ in range(rounds):
        got = cluster_sums(v, centres).toArrow()
        cluster, feature, s = (got[c].to_numpy() for c in ("cluster", "feature", "s"))
        n, new = np.zeros(len(centres)), np.zeros_like(centres)
        n[cluster[feature < 0]] = s[feature < 0]
        new[cluster[feature >= 0], feature[feature >= 0]] = s[feature >= 0]
        new = np.where(n[:, None] > 0, new / np.maximum(n, 1)[:, None], centres)
        still, centres = np.abs(new - centres).max(initial=0) < 1e-12, new
        if still:
            break
    return centres


def kmeans(v: Vectors, k: int, seed: int = 1, start_rounds: int = 3, rounds: int = 4) -> np.ndarray:
    """Centres of at most k clusters: :func:`start`, then Lloyd rounds. :func:`nearest` assigns documents to them."""
    if k < 1:
        raise ValueError("k must be at least 1")
    centres = start(v, k, seed, start_rounds)
    return lloyd(v, centres, rounds) if len(centres) else centres


def clusters(v: Vectors, centres: np.ndarray) -> DataFrame:
    """(doc, cluster) under the documents' own id column."""
    if not len(centres):
        return v.rows.select(F.col("doc").alias(v.id_col), F.lit(None).cast("int").alias("cluster"))
    return nearest(v, centres).select(F.col("doc").alias(v.id_col), "cluster")


def cluster_means(v: Vectors, centres: np.ndarray, digits: int = 10) -> DataFrame:
    """(cluster, term, mean): mean weight over all documents nearest to each centre; terms that occur there only."""
    spark = v.rows.sparkSession
    if not len(centres):
        return spark.createDataFrame([], "cluster int, term string, mean double")
    sums = materialize(cluster_sums(v, centres), "cluster-sums")
    names = spark.createDataFrame(list(enumerate(v.terms)), "feature int, term string")
    sizes = sums.where("feature < 0").select("cluster", F.col("s").alias("docs"))
    return (sums.where("feature >= 0").join(names, "feature").join(sizes, "cluster")
            .select("cluster", "term", F.round(F.col("s") / F.col("docs"), digits).alias("mean")))
