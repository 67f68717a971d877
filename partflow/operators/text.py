"""TF-IDF weights and the top terms of each cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partflow.operators.topk import top_n_per_group
from partflow.session import materialize

# Fixed value: a token is a run of two or more letters, digits or underscores
# (the default token rule of the usual TF-IDF vectoriser, in Unicode classes).
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"
COMMON = 200_000        # most terms whose document frequency is sent to all


def tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per token occurrence of the lower-cased text (whole texts, no truncation)."""
    toks = F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(TOKEN_PATTERN), 0)
    return docs.select(id_col, *keep, F.explode(toks).alias("term"))


def tfidf(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (),
          common: int = COMMON) -> DataFrame:
    """(doc, term, weight): raw count x smooth idf (ln((1+n)/(1+df)) + 1), L2-normalised per document.

    The texts, not their terms, are dealt by document, so that counts and norms need no shuffle of their own. Of the document
    frequencies, which are written, the ``common`` greatest at most are sent to all; rows of other terms get theirs by a join
    and come back to their document. The norm is a window over one document.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = docs.select(id_col, *keep, text_col).repartition(parts, id_col)
    tf = tokens(dealt, id_col, text_col, keep).groupBy(id_col, *keep, "term").agg(F.count(F.lit(1)).alias("tf"))
    dfreq = materialize(tf.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "document-counts")
    n = docs.select(F.count(F.lit(1))).scalar()
    # the frequency from which on there are at most ``common`` terms
    sizes = dfreq.groupBy("df").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.select("df", F.sum("n").over(Window.orderBy(F.desc("df"))).alias("n"))
    least, every = sizes.agg(F.min(F.when(F.col("n") <= common, F.col("df"))), F.min("df")).first()
    if least == every:
        w = tf.join(F.broadcast(dfreq), "term")
    else:
        often = F.col("df") >= F.lit(least) if least is not None else F.lit(False)
        w = tf.join(F.broadcast(dfreq.where(often)), "term", "left")
        rare = w.where(F.col("df").isNull()).drop("df").join(dfreq.where(~often), "term")
        w = w.where(F.col("df").isNotNull()).unionByName(rare.repartition(parts, id_col))
    raw = F.col("tf") * (F.log((n + 1) / (F.col("df") + 1)) + 1)
    w = w.select(id_col, *keep, "term", raw.alias("__w"))
    norm = F.sqrt(F.sum(F.col("__w") * F.col("__w")).over(Window.partitionBy(id_col)))
    return w.select(id_col, *keep, "term", (F.col("__w") / norm).alias("weight"))


def top_terms_per_cluster(weights: DataFrame, clusters: DataFrame, n: int = 3, id_col: str = "doc_id",
                          cluster_col: str = "cluster", digits: int = 10) -> DataFrame:
    """(cluster, top_terms): the n terms of highest mean weight, joined by a space.

    The mean divides by every document of the cluster (a missing term counts
    as 0). Means are rounded to ``digits`` before ranking so that float
    summation order cannot reorder ties; ties go to the smaller term. A
    cluster with fewer than n terms is not padded. Weights that carry the cluster (``keep`` of
    :func:`tfidf`) aren't joined to the clusters again.
    """
    sizes = clusters.groupBy(cluster_col).agg(F.count(F.lit(1)).alias("__docs"))
    w = weights if cluster_col in weights.columns else weights.join(clusters.select(id_col, cluster_col), id_col)
    sums = w.groupBy(cluster_col, "term").agg(F.sum("weight").alias("__s"))
    means = sums.join(sizes, cluster_col) \
        .select(cluster_col, "term", F.round(F.col("__s") / F.col("__docs"), digits).alias("mean"))
    return top_terms(means, n, cluster_col)


def top_terms(means: DataFrame, n: int = 3, cluster_col: str = "cluster") -> DataFrame:
    """(cluster, top_terms) of a (cluster, term, mean) table: the n largest means, ties to the smaller term."""
    top = top_n_per_group(means, [cluster_col], [F.col("mean").desc(), F.col("term").asc()], n, salt_col="term")
    ordered = F.array_sort(F.collect_list(F.struct("rank", "term")))
    return top.groupBy(cluster_col).agg(F.array_join(F.transform(ordered, lambda x: x["term"]), " ").alias("top_terms"))
