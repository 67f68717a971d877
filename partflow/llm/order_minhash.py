"""Order MinHash fingerprints of documents; DataFrame functions only.

The k-mers of a text (here of words) are numbered by occurrence, so that each is one of its kind. A
random order of all (k-mer, occurrence) pairs is given by a 64-bit hash; ``m`` orders come of
turning that one by m equal steps around the circle of hash values. In each, the
``l`` smallest pairs of a text are selected, put back in the order in which they stand in the
text, and hashed as a tuple. Two texts agree in an order's tuple only if the selected k-mers
are the same and in the same sequence: unlike a plain MinHash, the share of equal tuples
falls when parts of a text change places, as the edit distance does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partflow.llm.common import range_cuts, range_of
from partflow.llm.expr import text_of, words_of

K = 3                  # words of a k-mer
L = 2                  # k-mers of a tuple
ORDERS = 64            # tuples of a fingerprint (a power of two)
_PLACE = 31            # bits of a packed pair that hold its place in the text


def signature(df: DataFrame, text: str, to: str, k: int = K, l: int = L, m: int = ORDERS) -> DataFrame:
    """``df`` with column ``to``: the m tuple hashes (16 bits each) of each whole text; empty for a text without words.

    Each step is a column of its own, so that what a later step looks up inside a loop is computed once. Fewer
    words than k: all of them are the one k-mer. Fewer pairs than l: a tuple holds some of them again.
    """
    bits, keep = m.bit_length() - 1, df.columns
    none = F.array().cast("array<bigint>")
    bucket = lambda x: F.shiftright(x, 63 - bits)                              # noqa: E731
    place = lambda x: x.bitwiseAND(F.lit((1 << _PLACE) - 1)).cast("int")       # noqa: E731
    pair = lambda g, i: F.shiftleft(F.shiftrightunsigned(g, 32), _PLACE).bitwiseOR(i.cast("long"))

    df = df.withColumn("_w", words_of(text_of(text)))
    df = df.withColumn("_k", F.when(F.size("_w") == 0, none).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("_w") - (k - 1))),
                    lambda i: F.xxhash64(F.slice("_w", i, k))))).drop("_w")
    # occurrence numbers where a k-mer comes twice: runs of equal k-mers, in order of place
    by_kmer = F.array_sort(F.transform("_k", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("_s", F.when(F.size(F.array_distinct("_k")) < F.size("_k"), by_kmer)
                       .otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    df = df.withColumn("_r", F.when(F.size("_s") > 0, F.filter(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("_s") - 1)), lambda j: (j == 0) | (F.get("_s", j)["h"] != F.get("_s", j - 1)["h"])))
        .otherwise(F.array().cast("array<int>")))
    numbered = F.flatten(F.transform("_r", lambda a, r: F.transform(
        F.slice("_s", a + 1, F.coalesce(F.get("_r", r + 1), F.size("_s")) - a),
        lambda x, t: pair(F.when(t == 0, x["h"]).otherwise(F.xxhash64(x["h"], t)), x["i"]))))
    df = df.withColumn("_o", F.sort_array(F.when(F.size("_s") > 0, numbered).otherwise(F.transform("_k", pair)))).drop("_s", "_r")
    # places in the order where further steps of the circle have been passed
    n = F.size("_o")
    df = df.withColumn("_c", F.when(n > 1, F.filter(F.sequence(F.lit(1), F.greatest(F.lit(1), n - 1)),
                                                   lambda j: bucket(F.get("_o", j)) > bucket(F.get("_o", j - 1))))
                       .otherwise(F.array().cast("array<int>")))

    def hashed(j):
        places = F.sort_array(F.array(*[place(F.get("_o", (j + t) % F.greatest(n, F.lit(1)))) for t in range(l)]))
        return F.xxhash64(*[F.get("_k", F.get(places, t)) for t in range(l)]).bitwiseAND(F.lit(0xFFFF)).cast("int")

    df = df.withColumn("_f", hashed(F.lit(0)))
    inner = F.flatten(F.transform("_c", lambda j: F.array_repeat(
        hashed(j), (bucket(F.get("_o", j)) - bucket(F.get("_o", j - 1))).cast("int"))))
    whole = F.concat(F.array_repeat("_f", (bucket(F.get("_o", 0)) + 1).cast("int")), inner,
                     F.array_repeat("_f", (m - 1 - bucket(F.get("_o", n - 1))).cast("int")))
    return df.withColumn(to, F.when(n == 0, F.array().cast("array<int>")).otherwise(whole)).select(*keep, to)


def hex_string(sig: Column) -> Column:
    """The tuple hashes as four hex digits each; empty for a text without words."""
    return F.array_join(F.transform(sig, lambda x: F.lower(F.lpad(F.hex(x), 4, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal tuples, 0 to 1; texts without words are like each other (1) and unlike any other (0)."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda s, x: s + x)
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(same / F.greatest(F.size(a), F.size(b)))


def with_next(df: DataFrame, columns: list[str], id_col: str, tie: str, rows_per_range: int = 500, most_ranges: int = 100_000) -> DataFrame:
    """``df`` with ``next_<column>``: the values of the next row by falling id, after the last those of the first.

    Null ids come last; equal ids in order of ``tie``. Rows are dealt by key range (a shuffle, the only one), and
    the last row of each range also goes to the range that follows, so no window spans the table. The table of those
    last rows has a row per range, at most ``most_ranges``, and is sent to all.
    """
    spark = df.sparkSession
    ids = df.select(F.col(id_col).cast("long").alias("_id"))
    cuts = range_cuts(ids, "_id", min(most_ranges, -(-ids.count() // rows_per_range)))
    df = df.withColumn("_id", F.col(id_col).cast("long")).withColumn("_tie", F.col(tie)).withColumn("_range", range_of(F.col("_id"), cuts))
    ends = df.groupBy("_range").agg(F.max(F.struct(F.col("_id").isNotNull(), "_id", "_tie")).alias("x")).select("_range", "x._id", "x._tie")
    ends = sorted(tuple(r) for r in ends.collect())
    to = [(i, t, ends[(k + 1) % len(ends)][0]) for k, (_, i, t) in enumerate(ends)]
    ghosts = F.broadcast(spark.createDataFrame(to, "_gid long, _gtie long, _to int"))
    df = (df.join(ghosts, df["_id"].eqNullSafe(ghosts["_gid"]) & (df["_tie"] == ghosts["_gtie"]), "left").drop("_gid", "_gtie")
          .withColumn("_at", F.explode(F.when(F.col("_to").isNull(), F.array(F.struct(F.col("_range").alias("r"), F.lit(False).alias("ghost"))))
                                       .otherwise(F.array(F.struct(F.col("_range").alias("r"), F.lit(False).alias("ghost")),
                                                          F.struct(F.col("_to").alias("r"), F.lit(True).alias("ghost"))))))
          .withColumn("_range", F.col("_at.r")).withColumn("_ghost", F.col("_at.ghost")).drop("_at", "_to"))
    before = Window.partitionBy("_range").orderBy(F.desc("_ghost"), F.col("_id").asc_nulls_first(), "_tie")
    for c in columns:
        df = df.withColumn(f"next_{c}", F.lag(c).over(before))
    return df.where(~F.col("_ghost")).drop("_range", "_ghost", "_id", "_tie")


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, l: int = L, m: int = ORDERS) -> DataFrame:
    """Fingerprints of each whole text and of its edited text, with their likeness and that to the next document's.

    The edited text has its last floor(n / 2) code points replaced by the first as many (or all) of the next document by
    falling id. Null text: empty. Null id: after all others; repeated rows: next to each other. One row alone: it is
    its own next. Empty table: empty.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("_text"))
    rows = signature(rows.withColumn("_h", F.xxhash64("_text")), "_text", "_sig", k, l, m)
    rows = with_next(rows, ["_text", "_sig"], "doc_id", "_h")
    n = F.length("_text")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("_edited", F.concat(F.substring("_text", F.lit(1), n - half), F.substring("next__text", F.lit(1), half)))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), F.sha2("_edited", 256).alias("edited_sha256"), "_edited", "_sig", "next__sig")
    rows = signature(rows, "_edited", "_esig", k, l, m)
    return rows.select("doc_id", "n_chars", "edited_sha256", hex_string(F.col("_sig")).alias("fingerprint"),
                       hex_string(F.col("_esig")).alias("edited_fingerprint"), likeness(F.col("_sig"), F.col("_esig")).alias("near_edited"),
                       likeness(F.col("_sig"), F.col("next__sig")).alias("near_next"))
