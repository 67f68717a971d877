"""Token-ID output: flat unsigned-integer files with 64-bit document offsets, memory-mapped on reading.

A written collection is a folder with, per shard, ``ids`` (flat little-endian unsigned
integers, 16 or 32 bits), ``offsets`` (n + 1 unsigned 64-bit positions in the shard) and
``docs`` (n signed 64-bit document ids), and one table ``manifest`` that names the
shards in ascending document order with their counts. A shard's base, the number of ids before
it, is the prefix sum of the counts. Every attempt of a task writes files of its
own name; the manifest, which Spark commits once, names those that count.
"""

from __future__ import annotations

import itertools
import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.llm.common import dealt, open_fs, partitions, range_cuts

# Document id written for a null one.
NULL_DOC = -(1 << 63)

MANIFEST = "shard int, prefix string, n_docs long, n_ids long, ids_crc32 long"


def write_tokens(docs: DataFrame, out: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = 1, width: int = 2, docs_per_shard: int = 50_000, docs_per_call: int = 200) -> DataFrame:
    """Encode every whole text and write the ids in ascending document order; returns the manifest.

    ``width`` is the size of an id in bytes (2 or 4); an id that doesn't fit raises. Null
    text: empty (its ids are ``end_id`` alone). Null document id: first, written as
    ``NULL_DOC``. Rows with one id: all kept, ordered by the text's hash. Empty table: an empty
    manifest. Other columns: not read.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                      F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    n = docs.count()
    ranges = max(1, min(n, partitions(spark)), -(-n // docs_per_shard))
    cuts = range_cuts(src, "doc_id", ranges)
    rows = dealt(src, "doc_id", cuts, F.xxhash64("text"))

    def write(batches):
        import numpy as np
        import pyarrow as pa

        from partflow.llm.words import encoder

        enc, (fs, top) = encoder(tokenizer), open_fs(out)
        kind, most = ("<u2", 0xFFFF) if width == 2 else ("<u4", 0xFFFFFFFF)
        prefix, shard, files = "", 0, []
        offsets, ids_of, at, crc = [0], [], 0, 0
        for batch in batches:
            if not files:
                shard = batch.column(2)[0].as_py()
                prefix = f"shards/{shard:06d}-{uuid.uuid4().hex}"
                fs.create_dir(f"{top}/shards", recursive=True)
                files = [fs.open_output_stream(f"{top}/{prefix}.{x}.tmp") for x in ("ids", "offsets", "docs")]
            for i in range(0, batch.num_rows, docs_per_call):
                part = batch.slice(i, docs_per_call)
                for raw in enc.many([x.as_py() for x in part.column(1)]):
                    ids = np.append(np.frombuffer(raw, "<u4"), np.uint32(end_id))
                    if ids.max() > most:
                        raise ValueError(f"id {ids.max()} does not fit {width} bytes")
                    data = ids.astype(kind).tobytes()
                    files[0].write(data)
                    crc, at = zlib.crc32(data, crc), at + len(ids)
                    offsets.append(at)
                ids_of += [NULL_DOC if v is None else v for v in part.column(0).to_pylist()]
        if files:
            files[1].write(np.array(offsets, "<u8").tobytes())
            files[2].write(np.array(ids_of, "<i8").tobytes())
            for f, x in zip(files, ("ids", "offsets", "docs")):
                f.close()
                fs.move(f"{top}/{prefix}.{x}.tmp", f"{top}/{prefix}.{x}")
            yield pa.RecordBatch.from_pylist([{"shard": shard, "prefix": prefix, "n_docs": len(ids_of), "n_ids": at,
                                               "ids_crc32": crc}], schema=_arrow(MANIFEST))

    rows.select("doc_id", "text", "_range").mapInArrow(write, MANIFEST).write.parquet(f"{out}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{out}/manifest")


def read_tokens(spark: SparkSession, out: str, width: int = 2) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the memory-mapped files.

    ``start`` is the number of ids before the document in the collection; the crc32 is
    taken over its ids as little-endian unsigned 32-bit integers. One task a shard.
    """
    shards = spark.read.schema(MANIFEST).parquet(f"{out}/manifest").orderBy("shard").collect()
    bases = [0, *itertools.accumulate(r.n_ids for r in shards)]
    todo = spark.createDataFrame([(i, r.prefix, bases[i], r.n_ids) for i, r in enumerate(shards)],
                                 "i int, prefix string, base long, n_ids long")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"

    def read(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for r in batch.to_pylist():
                ids, offsets, ids_of = (mapped(out, f"{r['prefix']}.{x}", kind) for x, kind in (
                    ("ids", "<u2" if width == 2 else "<u4"), ("offsets", "<u8"), ("docs", "<i8")))
                if len(ids) != r["n_ids"]:
                    raise OSError(f"{r['prefix']}: {len(ids)} ids, the manifest has {r['n_ids']}")
                starts = offsets.astype(np.int64)
                crcs = [zlib.crc32(ids[a:b].astype("<u4")) for a, b in itertools.pairwise(starts.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids_of, mask=np.asarray(ids_of) == NULL_DOC), pa.array(starts[:-1] + r["base"]),
                     pa.array(np.diff(starts)), pa.array(crcs, pa.int64())], schema=_arrow(schema))

    return todo.repartitionById(max(1, len(shards)), F.col("i")).mapInArrow(read, schema)


def mapped(folder: str, name: str, kind: str):
    """A file of the collection as an array: memory-mapped where the folder is mounted, else read whole."""
    import numpy as np
    from pyarrow.fs import LocalFileSystem

    fs, top = open_fs(folder)
    path = f"{top}/{name}"
    if fs.get_file_info(path).size == 0:
        return np.zeros(0, kind)
    if isinstance(fs, LocalFileSystem):
        return np.memmap(path, kind, "r")
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), kind)


def _arrow(ddl: str):
    import pyarrow as pa

    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "double": pa.float64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[t]) for n, t in (x.split() for x in ddl.split(", "))])
