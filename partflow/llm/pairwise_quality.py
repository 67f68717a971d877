"""Document quality by pairwise ranking (Bradley-Terry).

Each document has a score that is linear in a few measures of its whole text. The chance that one document is
preferred to another is the logistic function of the difference of their scores; the weights
are fitted by logistic loss on the differences of measures over pairs of a good and a bad document, from a bounded
sample of the labelled ones. The threshold is a quantile of the scores of all labelled documents.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow.llm import host_rules
from partflow.llm.expr import text_of, words_of
from partflow.session import materialize

SAMPLE = 20_000          # most labelled documents that the weights are fitted on
PAIRS = 100_000          # most pairs
CUT = 0.7                # score at the threshold
BINS = 1 << 14           # equal steps from the least score to the greatest, in which labelled documents are counted


def features(docs: DataFrame, keep: list[str], text_col: str = "text") -> tuple[DataFrame, list[str]]:
    """The columns ``keep`` with the measures of each whole text as doubles, all from the text alone; null text: empty. No shuffle."""
    text = text_of(text_col)
    rows = docs.select(*keep, text.alias("_text"), (F.length(text) - F.length(F.replace(text, F.lit("!"), F.lit("")))).alias("_marks"),
                       F.regexp_count(text, F.lit(r"\p{Lu}")).alias("_upper"), F.size(F.array_distinct(words_of(text))).alias("_distinct"))
    m = host_rules.measure(rows, "_text", [*keep, "_marks", "_upper", "_distinct"])
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    sat = lambda x, s: x / (x + s)                                              # noqa: E731
    cols = {
        "f_size": F.log1p(F.col("n_words").cast("double")),
        "f_few": F.exp(-F.col("n_words") / 10.0),
        "f_symbols": sat(F.col("n_symbols") / n, 0.05),
        "f_upper": sat(F.col("_upper") / F.greatest(F.col("word_chars"), F.lit(1)), 0.1),
        "f_marks": sat(F.col("_marks") / n, 0.05),
        "f_same": 1 - F.col("_distinct") / n,
        "f_same_long": (1 - F.col("_distinct") / n) / F.log(n + 9),
        "f_repeats": sat(F.col("n_repeat_words") / n, 0.1),
        "f_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "f_word": F.col("word_chars") / n / 10,
        "f_short_lines": sat(F.col("n_lines") / n, 0.1),
    }
    return m.select(*keep, *[c.cast("double").alias(k) for k, c in cols.items()]), list(cols)


def fit(x: np.ndarray, good: np.ndarray, pairs: int = PAIRS, ridge: float = 1e-3, rounds: int = 30) -> np.ndarray:
    """Weights of the measures: Newton steps on the logistic loss of pair differences."""
    w = np.zeros(x.shape[1])
    a, b = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(a) or not len(b):
        return w
    rng = np.random.default_rng(5)
    n = min(pairs, len(a) * len(b))
    d = x[rng.choice(a, n)] - x[rng.choice(b, n)]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(np.clip(d @ w, -40, 40)))
        grad = -(d * p[:, None]).mean(0) + ridge * w
        hess = (d * (p * (1 - p))[:, None]).T @ d / n + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w - step * min(1, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w


def threshold(scores: np.ndarray, good: np.ndarray, n: np.ndarray | None = None) -> float:
    """The score quantile that tells labelled documents apart best (mean of both classes' shares that are right); ``n`` documents a score."""
    n = np.ones(len(scores)) if n is None else n
    if not good.any() or good.all():
        return float(np.quantile(scores, 0.5, weights=n, method="inverted_cdf")) if len(scores) else 0.0
    cuts = np.quantile(scores, np.linspace(0.005, 0.995, 199), weights=n, method="inverted_cdf")
    right = [(n[good & (scores >= c)].sum() / n[good].sum() + n[~good & (scores < c)].sum() / n[~good].sum()) / 2 for c in cuts]
    best = np.flatnonzero(np.isclose(right, max(right)))
    return float(cuts[best[len(best) // 2]])


def raw_score(names: list[str], w: list[float]) -> Column:
    return sum((F.col(c) * F.lit(x) for c, x in zip(names, w)), F.lit(0.0))


def train_on(measures: DataFrame, names: list[str], labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
             most: int = SAMPLE) -> dict:
    """Weights from at most ``most`` labelled documents, chosen by the hash of the id; threshold and scale from all labelled ones.

    Rows without id or label are not used; a document that came twice counts once, with the mean of its measures. The
    driver gets the sample and, for the threshold, at most ``BINS`` counts a class. Fewer than two classes: weights 0.
    Other columns: not read. Empty tables: weights, threshold 0 and scale 1.
    """
    known = (labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("double").alias("_y")).dropna()
             .groupBy("_id").agg(F.max("_y").alias("_y")))
    own = measures.select(F.col(id_col).cast("long").alias("_id"), *names).join(known, "_id")
    own = materialize(own.groupBy("_id", "_y").agg(*[F.avg(c).alias(c) for c in names]), "labelled")
    # a tenth more than the sample has hashes below this bound, so no more than that reaches the driver from all tasks together
    below = min(2 ** 63 - 1, -2 ** 63 + int(2 ** 64 * min(1.0, 1.1 * most / max(1, own.count()))))
    got = own.where(F.xxhash64("_id") <= below).orderBy(F.xxhash64("_id"), "_id").limit(most).collect()
    x, y = np.array([[r[c] for c in names] for r in got]).reshape(-1, len(names)), np.array([r["_y"] for r in got]) > 0.5
    w = fit(x, y).tolist()
    s = own.select((F.col("_y") > 0.5).alias("y"), raw_score(names, w).alias("s"))
    low, high, spread = s.agg(F.min("s"), F.max("s"), F.stddev_pop("s")).first()
    if low is None:
        return {"names": names, "w": w, "at": 0.0, "scale": 1.0}
    step = (high - low) / BINS or 1.0
    bins = s.groupBy("y", F.least(F.floor((F.col("s") - low) / step), F.lit(BINS - 1)).alias("b")).count().orderBy("b", "y").collect()
    at = threshold(np.array([low + r["b"] * step for r in bins]), np.array([r["y"] for r in bins]), np.array([r["count"] for r in bins], float))
    return {"names": names, "w": w, "at": at, "scale": spread or 1.0}


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", text_col: str = "text",
          most: int = SAMPLE) -> dict:
    """:func:`train_on` the measures of ``docs``."""
    rows, names = features(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")), ["_id"], "_t")
    return train_on(rows.withColumnRenamed("_id", id_col), names, labels, id_col, label_col, most)


def score_of(model: dict) -> Column:
    """The score as a column over the measures: 0 to 1, ``CUT`` at the threshold."""
    z = (raw_score(model["names"], model["w"]) - model["at"]) / model["scale"] * 3 + math.log(CUT / (1 - CUT))
    return 1 / (1 + F.exp(F.greatest(F.lit(-40.0), F.least(F.lit(40.0), -z))))


def score(docs: DataFrame, model: dict, keep: list[str], text_col: str = "text") -> tuple[DataFrame, Column]:
    """The documents' measures with the columns ``keep``, and :func:`score_of` the model.

    Null and empty texts are scored as texts without words; null ids and repeated rows are rows like any other. Extra
    columns: only ``keep``, of which none may have the name of a measure (raises). Empty table: empty.
    """
    if clash := set(keep) & set(model["names"]):
        raise ValueError(f"the input has a column {sorted(clash)[0]}")
    df, _ = features(docs, keep, text_col)
    return df, score_of(model)
