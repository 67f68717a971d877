import base64
import gzip
import hashlib
from pathlib import Path

import pytest

from partflow.llm import warc
from partflow.llm.common import shared_folder, ship

ROWS = [(i, f"http://x.example/{i}", body, 7) for i, body in enumerate(["a", "b", "a", "", None, "c\r\n\r\nd", "é" * 50000, "a", "", "b"])]
ROWS += [(None, None, "a", 1), (None, "u", "lone", 1), (9, "http://x.example/9", "b", 7), (20, "line\nbreak ", "z", None), (9, "other", "a", 0)]


def brute(rows, least):
    most, out = {}, []
    for page, _, body, _ in rows:
        b = (body or "").encode()
        if page is not None:
            most[b] = max(most.get(b, page), page)
    for page, url, body, _ in rows:
        b = (body or "").encode()
        twice = sum((r[2] or "").encode() == b for r in rows) > 1
        refers = most.get(b) if twice and len(b) >= least and most.get(b) != page else None
        out.append((page, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(),
                    "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


@pytest.fixture
def pages(spark):
    ship(spark)
    return spark.createDataFrame(ROWS, "page_id long, url string, html string, payload int")


@pytest.mark.parametrize("least", [0, 1, 3])
def test_round_trip(spark, pages, least):
    out = shared_folder(spark, "w")
    listed = warc.write_archives(pages, out, least_revisit=least, roll_bytes=600, rows_per_shard=4)
    assert listed.groupBy().sum("n_records").first()[0] == len(ROWS)
    got = warc.read_archives(spark, out, with_payload=True).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == brute(ROWS, least)
    assert all((r.payload is None) == (r.record_type == "revisit") for r in got)
    assert {bytes(r.payload).decode() for r in got if r.payload is not None} == {r[2] or "" for r in ROWS}


def test_same_bytes_again_whatever_the_order(spark, pages):
    def files(df):
        out = shared_folder(spark, "w")
        warc.write_archives(df, out, roll_bytes=600, rows_per_shard=4)
        return {p.name: p.read_bytes() for p in Path("/" + out.split(":")[-1].lstrip("/")).glob("archives/*.warc.gz")}

    one = files(pages)
    assert len(one) > 3 and one == files(pages.repartition(5))
    text = gzip.decompress(next(iter(one.values())))
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")


def test_empty_table_and_damage(spark, pages):
    out = shared_folder(spark, "w")
    assert warc.write_archives(pages.where("false"), out).count() == 0
    assert warc.read_archives(spark, out).count() == 0
    import io

    member = gzip.compress(b"WARC/1.1\r\nContent-Length: 1\r\n\r\nx\r\n\r\n")
    assert len(list(warc.records(io.BytesIO(member * 3), chunk=7))) == 3
    with pytest.raises(OSError):
        list(warc.records(io.BytesIO(member + member[:20])))
