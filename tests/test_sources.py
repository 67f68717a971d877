"""Entity scans, filter grammar, lookups, JSON pages, caching, sheets."""

import datetime
import tempfile

import pytest
from pyspark.sql import functions as F

from frames import rows
from partflow.functions.semantics import union_missing
from partflow.operators import reports
from partflow.sources import entity, sinks


def _lines(spark):
    return spark.createDataFrame(
        [(1, "a", "Open", "2020-01-02T00:00:00"), (2, "b", "Closed", "2019-01-01T00:00:00"),
         (3, "c|d", "Open", "2018-05-01T00:00:00")],
        "orderNumber bigint, partNumber string, status string, dateFinished string")


def test_filter_grammar(spark):
    df = _lines(spark)
    assert rows(entity.entity_filter(df, "status=Open"), "orderNumber") == [(1,), (3,)]
    assert rows(entity.entity_filter(df, "dateFinished[gt]=2019-01-01"), "orderNumber") == [(1,)]
    assert rows(entity.entity_filter(df, "orderNumber[in]=1|2"), "orderNumber") == [(1,), (2,)]
    assert rows(entity.entity_filter(df, "status=Open&orderNumber[gt]=1"), "orderNumber") == [(3,)]


def test_read_entity_fields_and_lookup_wins(spark, dict_source):
    src = dict_source({"lines": _lines(spark)})
    out = entity.read_entity(src, "lines", " orderNumber , status", search={"orderNumber": [2, 3]},
                             filter_string="status=Open")
    assert out.columns == ["orderNumber", "status"]
    assert rows(out) == [(2, "Closed"), (3, "Open")]


def test_lookup_empty_list_gives_no_rows(spark):
    assert entity.lookup_in(_lines(spark), "partNumber", []).count() == 0


def test_page_is_ordered_slice(spark):
    out = entity.page(_lines(spark), ["orderNumber"], skip=1, take=1)
    assert rows(out, "orderNumber") == [(2,)]


def test_json_pages_and_collection(spark):
    doc = spark.createDataFrame([('{"Data": [{"a": 1, "b": "x"}, {"a": 2}]}',), ('{"Data": []}',)], "t string")
    assert rows(entity.json_pages(doc, "t", "a bigint, b string")) == [(1, "x"), (2, None)]
    ev = spark.createDataFrame([(1, '{"k": 5}'), (2, '{"j": 1}')], "id bigint, props string")
    assert rows(entity.json_collection(ev, "props", "k bigint", keep=["id"])) == [(1, 5), (2, None)]


def test_materialize_once_is_keyed(spark):
    root = tempfile.mkdtemp(prefix="cache-")
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(2,)], "x int")
    assert rows(entity.materialize_once(a, "t", key="f1", root=root)) == [(1,)]
    assert rows(entity.materialize_once(b, "t", key="f1", root=root)) == [(1,)]   # hit: written once
    assert rows(entity.materialize_once(b, "t", key="f2", root=root)) == [(2,)]   # other predicate


def test_size_sheets_round_trip(spark):
    f = spark.createDataFrame([("p1", "d", 3.0, "4.75", "Nut"), ("p2", "d", 1.0, None, "Nut")],
                              "partNumber string, partDescription string, q double, MotorSize string, Category string")
    folder = sinks.write_size_sheets(f, None, tempfile.mkdtemp(prefix="sheets-"))
    back = sinks.read_size_sheets(spark, folder, f.drop("Category").schema)
    assert rows(back) == [("p1", "d", 3.0, "4.75")]


def test_to_wide_and_union_missing(spark):
    long_df = spark.createDataFrame([("1", "A", 1.0), ("2", "B", 2.0)], "MotorSize string, Category string, v double")
    wide = reports.to_wide(long_df, "MotorSize", "v")
    assert rows(wide) == [("1", 1.0, 0.0), ("2", 0.0, 2.0)]
    u = union_missing(spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(2, "x")], "a int, b string"))
    assert rows(u) == [(1, None), (2, "x")]



def test_keyset_paging_walks_every_row_once(spark):
    df = spark.createDataFrame([(i // 3, i % 3, f"r{i}") for i in range(20)], "a int, b int, v string")
    seen, after = [], None
    while True:
        pg = entity.page_after(df, ["a", "b"], after, take=7).collect()
        if not pg:
            break
        seen += [r["v"] for r in pg]
        after = (pg[-1]["a"], pg[-1]["b"])
    assert seen == [f"r{i}" for i in range(20)]
    assert [r["v"] for r in entity.page(df, ["a", "b"], skip=7, take=7).collect()] == seen[7:14]


def test_sheets_and_materials_are_seen_together_or_not(spark):
    day = datetime.date(2024, 5, 6)
    f = spark.createDataFrame([("p1", 3.0, "4.75", "Nut")], "partNumber string, q double, MotorSize string, Category string")
    m = spark.createDataFrame([("m1", 2.0)], "partNumber string, q double")
    broken = m.withColumn("q", F.when(F.col("q") > 0, F.raise_error(F.lit("lost"))).cast("double"))
    root = tempfile.mkdtemp(prefix="sheets-")
    with pytest.raises(Exception, match="lost"):
        sinks.write_size_sheets(f, broken, root, day)
    folder = f"{root}/sizeForecasts_24-05-06"
    for read, df in ((sinks.read_size_sheets, f.drop("Category")), (sinks.read_materials_sheet, m)):
        with pytest.raises(FileNotFoundError):
            read(spark, folder, df.schema)
    assert sinks.write_size_sheets(f, m, root, day) == folder
    assert rows(sinks.read_size_sheets(spark, folder, f.drop("Category").schema)) == [("p1", 3.0, "4.75")]
    assert rows(sinks.read_materials_sheet(spark, folder, m.schema)) == [("m1", 2.0)]
    # a second version that fails leaves the first one; one that succeeds takes its place
    with pytest.raises(Exception, match="lost"):
        sinks.write_size_sheets(f.withColumn("q", F.lit(9.0)), broken, root, day)
    assert rows(sinks.read_size_sheets(spark, folder, f.drop("Category").schema)) == [("p1", 3.0, "4.75")]
    sinks.write_size_sheets(f.withColumn("q", F.lit(9.0)), m.withColumn("q", F.lit(8.0)), root, day)
    assert rows(sinks.read_size_sheets(spark, folder, f.drop("Category").schema)) == [("p1", 9.0, "4.75")]
    assert rows(sinks.read_materials_sheet(spark, folder, m.schema)) == [("m1", 8.0)]
