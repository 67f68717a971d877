"""Quality rules of documents and of the hosts that they come from; DataFrame functions only.

Each document is measured where it is and tried by the rules. Rule failures are summed per
host; a host's rate of each rule is shrunk towards all hosts by a beta prior that is fitted to
the hosts' own rates (method of moments), so that a host with few documents is not condemned
by chance. A host is rejected if any shrunk rate passes the limit, and the verdict is joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow.llm.expr import text_of, words_of
from partflow.session import materialize

WINDOW = 8             # words of a window that may repeat
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
# rule -> whether a document fails it; the first two are the base rules
RULES = {
    "few_words": "n_words < 20",
    "repeats": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "same_lines": "10 * n_dup_lines > 4 * n_lines",
    "word_length": "word_chars < 2 * n_words OR word_chars > 15 * n_words",
}
BASE = ["few_words", "repeats"]
HOST_LIMIT = 0.5


def measure(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` with the measures of each whole text (null: no words). No shuffle."""
    keep = keep or []
    text = text_of(text_col)
    df = docs.select(*[F.col(c) for c in keep], text.alias("_t"), words_of(text).alias("_w"),
                     F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \x09-\x0D]")).alias("_l"))
    n = F.size("_w")
    df = df.select(*keep, n.cast("long").alias("n_words"), F.length(F.concat_ws("", "_w")).cast("long").alias("word_chars"),
                   F.regexp_count("_t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
                   (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
                   F.size("_l").cast("long").alias("n_lines"),
                   F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)),
                                                   lambda i: F.xxhash64(F.slice("_w", i, WINDOW))))
                   .otherwise(F.array().cast("array<bigint>")).alias("_h"))
    # windows in order of hash, then place; only where some window comes twice
    by_hash = F.array_sort(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("_s", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), by_hash)
                       .otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))).drop("_h")
    twice = F.filter("_s", lambda x, k: F.get("_s", k - 1)["h"].eqNullSafe(x["h"]) | F.get("_s", k + 1)["h"].eqNullSafe(x["h"]))
    df = df.withColumn("_p", F.sort_array(F.transform(twice, lambda x: x["i"]))).drop("_s")
    covered = F.aggregate(F.transform("_p", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_p", k + 1) - p, F.lit(WINDOW)))),
                          F.lit(0), lambda a, x: a + x)
    return df.withColumn("n_repeat_words", covered.cast("long")).select(*keep, *MEASURES)


def _shrunk(fails: Column, n: Column, a: Column, b: Column) -> Column:
    return (fails + a) / (n + a + b)


def host_verdicts(measured: DataFrame, host_col: str, limit: float = HOST_LIMIT) -> DataFrame:
    """(host, n, rate of each rule, rejected) per host; a null host is a host of its own.

    The prior of a rule has the mean m of the hosts' rates and, from their variance v, the weight m (1 - m) / v - 1,
    held between 1 and 1,000,000 documents. Rows are summed per host before the shuffle.
    """
    hosts = materialize(measured.groupBy(F.col(host_col).alias("host")).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.expr(f"CASE WHEN {r} THEN 1 ELSE 0 END")).alias(k) for k, r in RULES.items()]), "hosts")
    stats = hosts.agg(*[f(F.col(k) / F.col("n")).alias(f"{x}_{k}") for k in RULES for x, f in (("m", F.avg), ("v", F.var_pop))])
    rates = []
    for k in RULES:
        m, v = F.col(f"m_{k}"), F.col(f"v_{k}")
        weight = F.least(F.lit(1e6), F.greatest(F.lit(1.0), F.when(v > 0, m * (1 - m) / v - 1).otherwise(1e6)))
        rates.append(_shrunk(F.col(k), F.col("n"), m * weight, (1 - m) * weight).alias(f"rate_{k}"))
    # one row of statistics, the only thing that is sent to all
    out = hosts.join(F.broadcast(stats)).select("host", "n", *rates)
    return out.withColumn("rejected", F.greatest(*[F.col(f"rate_{k}") for k in RULES]) > limit)


def judge(docs: DataFrame, host_col: str = "source", text_col: str = "text", keep: list[str] | None = None,
          limit: float = HOST_LIMIT) -> DataFrame:
    """The columns ``keep`` with the measures, ``base_failed`` and ``kept`` of every row.

    ``kept``: the document fails no rule and its host is not rejected. Null text: no words, so it fails. Null host: a
    host of its own. Repeated rows: each counts. Empty table: empty. The measures are written once; the join moves
    them, not the texts, and only looks for rejected hosts.
    """
    keep = keep or ["doc_id"]
    rows = docs.select(*[F.col(c) for c in keep], F.col(host_col).alias("_host"), F.col(text_col).alias("_text"))
    measured = materialize(measure(rows, "_text", [*keep, "_host"]), "measured")
    bad = materialize(host_verdicts(measured, "_host", limit).where("rejected").select("host"), "badhosts")
    own = measured.join(bad.withColumn("_bad", F.lit(True)), measured["_host"].eqNullSafe(bad["host"]), "left")
    any_of = lambda names: F.coalesce(F.expr(" OR ".join(f"({RULES[k]})" for k in names)), F.lit(False))
    return own.select(*keep, *MEASURES[:5], any_of(BASE).alias("base_failed"),
                      (~any_of(RULES) & F.col("_bad").isNull()).alias("kept"))
