"""Report tables whose work must not grow with texts squared, values or scans."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from frames import rows
from partflow.operators import reports
from partflow.plans.breakdown import breakdown, long_form


def _pairs(codes):
    return sorted((a, b) for a in codes for b in codes if a in b)


def test_substring_pairs_of_long_codes_and_a_hot_short_one(spark, monkeypatch):
    rnd = random.Random(1)
    long = ["".join(rnd.choice("ab") for _ in range(200)) for _ in range(12)]
    codes = {*long, "a", "ab", "", "zz", "z", "c-d", "a.b", "AB", *(c[50:50 + k] for k, c in zip(range(3, 15), long)), *(f"HOT{i}" for i in range(60)), "HOT", "HO"}
    made = []
    plain = reports.materialize
    monkeypatch.setattr(reports, "materialize", lambda df, tag: made.append((tag, plain(df, tag))) or made[-1][1])
    got = rows(reports.substring_pairs(spark.createDataFrame([(c,) for c in [*codes, "HOT", None]], "customerCode string")))
    assert sorted(got) == _pairs(codes)
    (tag, index), = made
    most = index.groupBy("__r").count().where("count > 3 * length(__r) + 1").count()
    assert tag == "pieces" and most == 0


@pytest.mark.parametrize("size", [1, 2, 4])
def test_substring_pairs_for_any_size_of_pieces(spark, size):
    rnd = random.Random(size)
    codes = {"".join(rnd.choice("xyz") for _ in range(rnd.randint(0, 7))) for _ in range(80)}
    got = rows(reports.substring_pairs(spark.createDataFrame([(c,) for c in codes], "customerCode string"), size=size))
    assert sorted(got) == _pairs(codes)


@pytest.mark.parametrize("values", [
    [random.Random(3).gauss(0, 1) for _ in range(3000)] + [60.0],          # an outlier: points that no cell is near
    [1.0, 1.0, 1.0, 2.0], [0.0, 1e-9, 5e8], [-3.5, -3.5, 4.0, 4.25, 4.5]])
def test_binned_curve_is_the_exact_one(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double")
    got, want = ({r["point"]: (r["x"], r["density"]) for r in reports.kde_curve(df, "v", exact=e).collect()} for e in (False, True))
    assert got.keys() == want.keys() == set(range(200))
    height = max(d for _, d in want.values())
    assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) <= 1e-10 * height for k in want)


def test_bundle_reads_the_sales_once(spark):
    sales = [(f"{i % 3}", c, f"{g}C{i % 7}", float(i % 11)) for i in range(400) for c, g in
             (("Mandrels", "ALPHA "), ("Inner Race", "ALPHA "), ("Mandrels", "DELTA "), ("Inner Race", ""), ("Mandrels", ""), ("None", ""))]
    sales += [(None, "Nut", None, 1.0), ("1", None, "x", 2.0)]
    path = tempfile.mkdtemp(prefix="sales-") + "/salesonce.parquet"
    spark.createDataFrame(sales, "MotorSize string, Category string, customerCode string, qTotal double").write.parquet(path)
    df = spark.read.parquet(path)
    out = breakdown(df, "qTotal")
    assert "share_of_total" in out
    for name, table in out.items():
        assert "salesonce" not in table._jdf.queryExecution().executedPlan().toString(), name
    plain = {"size_category_pivot": reports.size_category_pivot(df, "qTotal"), "mandrel_ratio": reports.mandrel_ratio(df, "qTotal"),
             "customer_ratio": reports.customer_ratio(df, "qTotal"), "share_of_total": reports.share_of_total(df, "qTotal")}
    for name, table in plain.items():
        assert rows(out[name], *table.columns) == rows(table)
    long = long_form(out, "qTotal")
    counts = {k: t.count() for k, t in out.items()}
    assert all(counts.values()) and {r["report"]: r["count"] for r in long.groupBy("report").count().collect()} == counts
    assert long.where((F.col("report") == "histogram") & F.col("low").isNull()).count() == 0
