"""A deterministic sharded WARC writer, and its reader.

Records are sorted by page id over key ranges; a shard is one range. A task writes
gzip members, one a record, and rolls to a further file once the compressed size is reached.
HTTP and WARC headers and digests are made anew from the payload. Files get temporary
names of the attempt's own; Spark commits the table that lists them, a second
job gives the listed ones their final names, and only the files of the final
manifest count. The same table gives the same bytes.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.llm.common import dealt, open_fs, partitions, range_cuts
from partflow.session import materialize

LISTED = "shard int, part int, temporary string, name string, n_records long, n_bytes long"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def write_archives(pages: DataFrame, out: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
                   least_revisit: int = 0, roll_bytes: int = 64 << 20, rows_per_shard: int = 50_000,
                   date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write one record per row; returns the manifest.

    Of rows with equal payloads of at least ``least_revisit`` bytes, those with the
    largest id are responses and the others revisit it; smaller payloads are all responses. Null body: an empty
    payload. Null url: no target header. Null id: written first, never the one that is referred to. Repeated rows: a record
    each. Empty table: an empty manifest.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.encode(F.coalesce(F.col(body_col), F.lit("")), "UTF-8").alias("body"))
    facts = rows.select("id", F.sha2("body", 256).alias("key"), F.octet_length("body").alias("size"))
    # a row per payload that came twice: summed before the shuffle, then written, so that the join below can split a hot one
    twice = materialize(facts.where(F.col("size") >= least_revisit).groupBy("key")
                        .agg(F.max("id").alias("response"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "payloads")
    revisits = facts.join(twice, "key").where(~F.col("id").eqNullSafe(F.col("response"))).select(
        "id", F.col("response"), "key", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("body")).distinct()
    n = pages.count()
    cuts = range_cuts(rows, "id", max(1, min(n, partitions(spark)), -(-n // rows_per_shard)))
    both = revisits.unionByName(rows.select("id", F.lit(None).cast("long").alias("response"), F.sha2("body", 256).alias("key"),
                                            "url", "body"))
    # a row's verdict, if there is one, comes right before it
    merged = dealt(both, "id", cuts, F.col("key"), F.col("body").isNotNull(), F.col("url"))

    def write(batches):
        w, seen = None, None
        for batch in batches:
            ids, refers, keys, urls, bodies, shards = batch.columns
            for i in range(batch.num_rows):
                page, key, body = ids[i].as_py(), keys[i].as_py(), bodies[i].as_py()
                if body is None:
                    seen = (page, key, refers[i].as_py())
                    continue
                if w is None:
                    w = Shard(out, shards[i].as_py(), roll_bytes, date)
                w.add(page, urls[i].as_py(), body, seen[2] if seen and seen[:2] == (page, key) else None)
        if w:
            yield w.close()

    merged.select("id", "response", "key", "url", "body", "_range").mapInArrow(write, LISTED).write.parquet(f"{out}/listed")
    listed = spark.read.schema(LISTED).parquet(f"{out}/listed")

    def rename(batches):
        for batch in batches:
            fs, top = open_fs(out)
            fs.create_dir(f"{top}/archives", recursive=True)
            for r in batch.to_pylist():
                name, tmp = f"{top}/{r['name']}", f"{top}/{r['temporary']}"
                if fs.get_file_info(tmp).is_file:      # else an earlier attempt has renamed it
                    if fs.get_file_info(name).is_file:
                        fs.delete_file(name)
                    fs.move(tmp, name)
                if fs.get_file_info(name).size != r["n_bytes"]:
                    raise OSError(f"{r['name']}: not the {r['n_bytes']} bytes that were written")
            yield batch

    listed.repartition(partitions(spark)).mapInArrow(rename, LISTED).write.parquet(f"{out}/manifest")
    return spark.read.schema(LISTED).parquet(f"{out}/manifest")


def b32sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page: int | None, digest: str) -> str:
    return f"<urn:x-page:{'' if page is None else page}:{digest}>"


class Shard:
    """The files of one shard, one attempt."""

    def __init__(self, out: str, shard: int, roll_bytes: int, date: str):
        self.fs, self.top = open_fs(out)
        self.shard, self.roll, self.date = shard, roll_bytes, date
        self.folder = f"temporary/{shard:06d}-{uuid.uuid4().hex}"
        self.fs.create_dir(f"{self.top}/{self.folder}", recursive=True)
        self.file, self.done = None, []

    def _open(self) -> None:
        self.part, self.size, self.n = len(self.done), 0, 0
        self.file = self.fs.open_output_stream(f"{self.top}/{self.folder}/{self.part:05d}.warc.gz", compression=None)
        info = b"software: partflow\r\nformat: WARC File Format 1.1\r\n"
        self._write([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:x-shard:{self.shard}:{self.part}>"),
                     ("WARC-Date", self.date), ("Content-Type", "application/warc-fields")], info)

    def _write(self, headers: list[tuple[str, str]], block: bytes) -> None:
        headers = [*headers, ("WARC-Block-Digest", f"sha1:{b32sha1(block)}"), ("Content-Length", str(len(block)))]
        head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
        z = zlib.compressobj(6, zlib.DEFLATED, 31)
        data = z.compress(head.encode()) + z.compress(block + b"\r\n\r\n") + z.flush()
        self.file.write(data)
        self.size += len(data)

    def add(self, page: int | None, url: str | None, body: bytes, refers: int | None) -> None:
        if self.file is None:
            self._open()
        digest = b32sha1(body)
        http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n").encode()
        headers = [("WARC-Type", "response" if refers is None else "revisit"), ("WARC-Record-ID", record_id(page, digest)),
                   ("WARC-Date", self.date), ("WARC-Payload-Digest", f"sha1:{digest}"),
                   ("Content-Type", "application/http;msgtype=response")]
        if url is not None:
            headers.append(("WARC-Target-URI", "".join(c if c > " " else f"%{ord(c):02X}" for c in url)))
        if refers is not None:
            headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers, digest))]
        self._write(headers, http if refers is not None else http + body)
        self.n += 1
        if self.size >= self.roll:
            self._finish()

    def _finish(self) -> None:
        self.file.close()
        self.file = None
        self.done.append((self.shard, self.part, f"{self.folder}/{self.part:05d}.warc.gz",
                          f"archives/{self.shard:06d}-{self.part:05d}.warc.gz", self.n, self.size))

    def close(self):
        import pyarrow as pa

        from partflow.llm.token_file import _arrow

        if self.file is not None:
            self._finish()
        names = _arrow(LISTED)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*self.done), names.types)], schema=names)


def records(stream, chunk: int = 1 << 20):
    """(headers, block) of each record of a file with a gzip member per record."""
    z, parts, rest = zlib.decompressobj(31), [], b""
    while data := rest or stream.read(chunk):
        parts.append(z.decompress(data))
        rest = z.unused_data
        if z.eof:
            head, _, tail = b"".join(parts).partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            headers = dict(x.split(": ", 1) for x in lines[1:])
            yield headers, tail[:int(headers["Content-Length"])]
            z, parts = zlib.decompressobj(31), []
    if parts:
        raise OSError("the file ends within a record")


def read_archives(spark: SparkSession, out: str, with_payload: bool = False) -> DataFrame:
    """One row per response or revisit record of the manifest's files; one task a file.

    Digests and lengths are checked against the payload where it is there. ``refers_to``
    is the page id that a revisit names. ``payload`` (binary, null for revisits) on request.
    """
    files = spark.read.schema(LISTED).parquet(f"{out}/manifest")
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"
    schema += ", payload binary" if with_payload else ""

    def read(batches):
        import pyarrow as pa

        from partflow.llm.token_file import _arrow

        names, (fs, top) = _arrow(schema), open_fs(out)
        for batch in batches:
            for r in batch.to_pylist():
                rows, n, held = [], 0, 0
                with fs.open_input_stream(f"{top}/{r['name']}", compression=None) as f:
                    for h, block in records(f):
                        if f"sha1:{b32sha1(block)}" != h["WARC-Block-Digest"]:
                            raise OSError(f"{r['name']}: a block differs from its digest")
                        if h["WARC-Type"] == "warcinfo":
                            continue
                        n, digest = n + 1, h["WARC-Payload-Digest"].removeprefix("sha1:")
                        head, _, body = block.partition(b"\r\n\r\n")
                        size = int(dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])["Content-Length"])
                        kind = h["WARC-Type"]
                        if kind == "response" and (len(body) != size or b32sha1(body) != digest):
                            raise OSError(f"{r['name']}: a payload differs from its headers")
                        page, refers = (None if not (x := h.get(k, "::").split(":")[2]) else int(x)
                                        for k in ("WARC-Record-ID", "WARC-Refers-To"))
                        rows.append((page, size, digest, kind, refers, h.get("WARC-Target-URI"),
                                     body if kind == "response" else None)[:len(names)])
                        held += len(body) if with_payload else 0
                        if len(rows) >= 5000 or held > 32 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), names.types)], schema=names)
                            rows, held = [], 0
                if n != r["n_records"]:
                    raise OSError(f"{r['name']}: {n} records, the manifest has {r['n_records']}")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), names.types)], schema=names)

    return files.repartition(partitions(spark)).mapInArrow(read, schema)
