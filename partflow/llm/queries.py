"""The registered queries of the training-data operators; each reads its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.llm import conversation, fuzzy_lines, host_rules, language, order_minhash, packing, pairwise_quality, piece, pii, simhash, spelling, token_file, warc
from partflow.llm.common import shared_folder, ship, table, tokenizer_path
from partflow.session import materialize

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

WORD_FILE = "word_bpe_49k.json"
PIECE_FILE = "piece_bpe_32k.model"


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return run


@query
def op1_token_files(spark, sf_dir):
    """Encode ``documents``, write the token files in the shared folder, read them back."""
    out = shared_folder(spark, "tokens")
    token_file.write_tokens(table(spark, sf_dir, "documents"), out, tokenizer_path(WORD_FILE))
    return token_file.read_tokens(spark, out)


@query
def op2_sentencepiece(spark, sf_dir):
    """Encode ``documents`` with begin and end ids and decode the ids again."""
    model = tokenizer_path(PIECE_FILE)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = piece.decode(piece.encode(docs, model).drop("text"), model)
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


@query
def op3_warc(spark, sf_dir):
    """Write ``pages`` as WARC files in the shared folder and read the records back."""
    out = shared_folder(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), out)
    return warc.read_archives(spark, out).drop("url")


@query
def op10_packing(spark, sf_dir):
    """Pack the ids of ``documents`` into windows of 2048."""
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), tokenizer_path(WORD_FILE)))


@query
def op5_simhash(spark, sf_dir):
    """Near-duplicate groups of ``documents``: 4-word shingles, at most 4 differing bits."""
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op7_host_rules(spark, sf_dir):
    """Rules of ``documents`` and of their hosts; a document's host is its source."""
    return host_rules.judge(table(spark, sf_dir, "documents"))


@query
def op6_order_minhash(spark, sf_dir):
    """Fingerprints of ``documents`` and of their edited texts."""
    return order_minhash.compare_edited(table(spark, sf_dir, "documents"))


@query
def op8_fuzzy_lines(spark, sf_dir):
    """``documents`` without repeated and nearly repeated lines: per document the counts and a digest of what is left."""
    out = fuzzy_lines.dedup_lines(table(spark, sf_dir, "documents"), wide=True, every=True)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def find_personal_data(docs: DataFrame) -> DataFrame:
    return pii.find(docs, pii.train(docs))


@query
def op4_pii(spark, sf_dir):
    """Personal data in ``documents``: the patterns' matches and what the trained tagger adds."""
    out = find_personal_data(table(spark, sf_dir, "documents"))
    count = lambda k: F.regexp_count("base", F.lit(f"{k}:")).cast("long").alias(f"n_{k}")
    return out.select("doc_id", *[count(k) for k in pii.KINDS], F.sha2("base", 256).alias("base_sha256"), "spans")


@query
def op9_pairwise_quality(spark, sf_dir):
    """Quality scores of ``documents``; fitted on labels whose document's crc32 leaves no remainder of 2 by 4."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = lambda c: F.crc32(F.col(c).cast("string").cast("binary")) % 4 == 2            # noqa: E731
    rows, names = pairwise_quality.features(docs, ["doc_id"])
    rows = materialize(rows, "measures")
    score = pairwise_quality.score_of(pairwise_quality.train_on(rows, names, labels.where(~held_out("doc_id"))))
    return rows.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), score.alias("score"),
                       F.when(score >= pairwise_quality.CUT, 1).otherwise(0).alias("predicted"))


@query
def op13_spelling_variants(spark, sf_dir):
    """Words of ``documents`` with the more frequent words that they are slips of."""
    return spelling.variants(table(spark, sf_dir, "documents"))


@query
def op12_language_ppm(spark, sf_dir):
    """Language of each of ``documents``; learned from those whose crc32 leaves a remainder by 5."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    out = language.predict(docs, language.train(docs.where(~held_out)))
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op11_conversation_repair(spark, sf_dir):
    """Damaged ``conversations``: their faults, the least of the cheapest repairs and a digest of what it leaves."""
    convs = table(spark, sf_dir, "conversations")
    repaired = conversation.repair(conversation.damage(convs))
    out = convs.select(F.col("conv_id").alias("_c")).distinct()
    for part in (conversation.report(repaired), conversation.audits(repaired)):
        out = out.join(part, F.col("_c").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(F.col("_c").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
