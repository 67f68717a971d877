"""SimHash near duplicates by a tiled exact comparison.

Fingerprints are made where the rows are. Each distinct fingerprint is compared once: the
distinct ones are put in order of their population count (then those of their four 16-bit
parts), cut into tiles of bounded size, and each pair of tiles is compared by
exclusive-or and bit counts. Two fingerprints within the radius can't differ by more in
population count, in total or summed over the parts, so pairs of tiles, and of blocks inside them,
that are further apart are skipped. A pair of tiles returns a spanning forest of the links it finds,
never all pairs, so a dense group of near copies costs a row per member.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow.llm.common import components, range_cuts, range_of
from partflow.session import materialize

BLOCK = 512            # rows of a block inside a tile


def fingerprint(raw: bytes, shingle: int = 4, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash of UTF-8 text: A-Z lower-cased, words between white space, word shingles with repeats.

    A bit is set if it is set in over half of the shingles' XXH64. Fewer words than a shingle: the whole
    sequence is the one shingle; no words: 0.
    """
    import numpy as np
    import xxhash

    words = raw.lower().split()
    if not words:
        return 0
    text, h = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return h(text, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    starts, ends = starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist()
    n, ones, step = len(starts), np.zeros(64, np.int64), 1 << 15
    for i in range(0, n, step):
        hs = np.array([h(text[a:b], seed) for a, b in zip(starts[i:i + step], ends[i:i + step])], "<u8")
        ones += np.unpackbits(hs.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, th, fp) of each whole text: its hash, and its SimHash as a signed 64-bit number. Null text: as empty. No shuffle."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            fps = np.fromiter((fingerprint(x.as_py(), shingle, seed) for x in batch.column(1)), "<u8", batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(fps.view("<i8"))], names=["doc_id", "th", "fp"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.cast("binary").alias("text"),
                       F.xxhash64(text).alias("th")).mapInArrow(run, "doc_id long, th long, fp long")


def _part(fp: Column, k: int) -> Column:
    return F.bit_count(F.shiftrightunsigned(fp, 16 * k).bitwiseAND(F.lit(0xFFFF)))


def order_key(fp: Column) -> Column:
    """Population count, those of three 16-bit parts (the fourth follows), then the leading bits: ascending, not negative."""
    key = F.bit_count(fp).cast("long")
    for k in range(3):
        key = F.shiftleft(key, 5) + _part(fp, k)
    return F.shiftleft(key, 40) + F.shiftrightunsigned(fp, 24)


def compare(a, b, radius: int):
    """Spanning forest, as pairs (i, root), of the links within ``radius`` between two sorted arrays of fingerprints.

    Positions in ``b`` follow those in ``a``; ``b is a``: links inside one array.
    """
    import numpy as np

    same = b is a
    both = a if same else np.concatenate((a, b))
    label = np.arange(len(both))

    def blocks(x):
        parts = np.bitwise_count(x[:, None] >> np.array([0, 16, 32, 48], np.uint64) & np.uint64(0xFFFF)).astype(np.int16)
        cuts = list(range(0, len(x), BLOCK))
        return cuts, np.array([parts[i:i + BLOCK].min(0) for i in cuts]), np.array([parts[i:i + BLOCK].max(0) for i in cuts])

    cuts_a, low_a, high_a = blocks(a)
    cuts_b, low_b, high_b = (cuts_a, low_a, high_a) if same else blocks(b)

    def root(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    for ia, at in enumerate(cuts_a):
        # the least that any two fingerprints of the blocks can differ by
        gap = np.maximum(0, np.maximum(low_b - high_a[ia], low_a[ia] - high_b)).sum(1)
        x = a[at:at + BLOCK, None]
        for ib in np.flatnonzero(gap <= radius):
            if same and ib < ia:
                continue
            u, v = np.nonzero(np.bitwise_count(x ^ b[None, cuts_b[ib]:cuts_b[ib] + BLOCK]) <= radius)
            u, v = u + at, v + cuts_b[ib] + (0 if same else len(a))
            if same and ib == ia:
                u, v = u[u < v], v[u < v]
            while len(u):      # only links between what is still apart; one per pair of groups at a time
                while (label[label] != label).any():
                    label = label[label]
                apart = label[u] != label[v]
                u, v = u[apart], v[apart]
                if len(u):
                    pairs = np.unique(np.stack((np.minimum(label[u], label[v]), np.maximum(label[u], label[v])), 1), axis=0)
                    for p, q in pairs.tolist():
                        p, q = root(p), root(q)
                        if p != q:
                            label[max(p, q)] = min(p, q)
    while (label[label] != label).any():
        label = label[label]
    return np.flatnonzero(label != np.arange(len(both))), label, both


def links(distinct: DataFrame, radius: int = 4, rows_per_tile: int = 16_384) -> DataFrame:
    """(a, b): links that connect the distinct fingerprints of column ``fp`` just as all pairs within ``radius`` do."""
    spark = distinct.sparkSession
    keyed = distinct.select("fp", order_key(F.col("fp")).alias("key"), F.bit_count("fp").alias("ones"))
    cuts = range_cuts(keyed, "key", -(-distinct.count() // rows_per_tile), per_range=200)
    tiles = materialize(keyed.withColumn("tile", range_of(F.col("key"), cuts)).groupBy("tile").agg(
        F.min("ones").alias("low"), F.max("ones").alias("high"),
        F.array_sort(F.collect_list(F.struct("key", "fp")))["fp"].alias("fps")), "tiles")
    # the tiles follow the population count, so a tile's partners are a range of tiles
    bounds = sorted(tuple(r) for r in tiles.select("tile", "low", "high").collect())
    last, partner = 0, []
    for tile, _, high in bounds:
        while last < len(bounds) and bounds[last][1] <= high + radius:
            last += 1
        partner.append((tile, bounds[last - 1][0]))
    if not partner:
        return spark.createDataFrame([], "a long, b long")
    pairs = (spark.createDataFrame(partner, "i int, last int").select("i", F.explode(F.sequence("i", "last")).alias("j")))
    # the tile whose arrays go along is the pair's own: dealt by the pair, not by the tile
    first = pairs.join(tiles.select(F.col("tile").alias("i"), F.col("fps").alias("x")), "i")
    second = first.join(tiles.select(F.col("tile").alias("j"), F.col("fps").alias("y")), "j")
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    dealt = second.repartition(max(n, 1), F.xxhash64("i", "j"))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            at = {k: batch.schema.get_field_index(k) for k in "ijxy"}
            for k in range(batch.num_rows):
                x, y = (np.asarray(batch.column(at[c])[k].values).astype("<i8").view("<u8") for c in "xy")
                if batch.column(at["i"])[k].as_py() == batch.column(at["j"])[k].as_py():
                    y = x
                child, label, both = compare(x, y, radius)
                both = both.view("<i8")
                yield pa.RecordBatch.from_arrays([pa.array(both[child]), pa.array(both[label[child]])], names=["a", "b"])

    return dealt.select("i", "j", "x", "y").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4,
                    seed: int = 42, rows_per_tile: int = 16_384) -> DataFrame:
    """(doc_id, th, fp, group, component_id) of each row; ``group`` names its group, ``component_id`` is the smallest id reachable over links, its own included.

    Texts without words have fingerprint 0 and link like any other. Null text: as empty. Null ids: kept;
    null component where no row of the group has an id. Repeated rows: each a row, in one group. Empty table: empty.
    Other columns: not read.
    """
    fps = materialize(fingerprints(docs, id_col, text_col, shingle, seed), "fps")
    distinct = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    group = components(links(distinct, radius, rows_per_tile), "a", "b")
    grouped = materialize(distinct.join(group, distinct["fp"] == group["node"], "left")
                          .select("fp", "least", F.coalesce("component", "fp").alias("group")), "grouped")
    least = materialize(grouped.groupBy("group").agg(F.min("least").alias("component_id")), "least")
    by_fp = materialize(grouped.join(least, "group").select("fp", "group", "component_id"), "byfp")
    return fps.join(by_fp, "fp").select("doc_id", "th", "fp", "group", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows without all but one of each near-duplicate group: the one with the smallest id (null last), then text hash.

    Rows with equal id and text: one stays. All columns are kept, whatever their names. Null text: as empty. Empty table: empty.
    """
    # under names of their own the input's columns clash with nothing in here
    names = docs.columns
    docs = docs.toDF(*[f"_c{k}" for k in range(len(names))])
    id_own, text_own = f"_c{names.index(id_col)}", f"_c{names.index(text_col)}"
    rows = materialize(near_duplicates(docs, id_own, text_own, **how).select("doc_id", "th", "group"), "members")
    stays = rows.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("s")).select(
        F.col("s.doc_id").alias("_sid"), F.col("s.th").alias("_sth"))
    own = docs.withColumn("_th", F.xxhash64(F.coalesce(F.col(text_own), F.lit(""))))
    out = own.join(stays, own[id_own].cast("long").eqNullSafe(F.col("_sid")) & (F.col("_th") == F.col("_sth")), "left_semi")
    again = rows.groupBy("doc_id", "th").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count()
    return (out.dropDuplicates([id_own, "_th"]) if again else out).drop("_th").toDF(*names)


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
