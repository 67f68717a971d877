"""Hand fixtures for the pandas-compatible helpers and report operators (FIXTURES.md §3)."""

import math

from pyspark.sql import functions as F

from frames import rows
from partflow.functions.scalar import exclude_pattern, parse_currency, to_hours
from partflow.functions.semantics import merge
from partflow.operators import reports


def test_h1_aggregate_by_part_first_non_null(spark):
    df = spark.createDataFrame(
        [("b", None, 1.0, 0), ("a", "x", None, 1), ("a", "y", None, 2), (None, "z", 4.0, 3), ("b", "w", 5.0, 4)],
        "partNumber string, d string, s double, o int")
    out = reports.aggregate_by_part(df, "s", ["o"]).select("partNumber", "d", "s")
    assert rows(out) == [("a", "x", 0.0), ("b", "w", 6.0)]
    assert reports.aggregate_by_part(df, "s", ["o"]).columns[-1] == "s"


def test_h2_merge_matches_null_keys(spark):
    left = spark.createDataFrame([("a", 1), (None, 2)], "k string, l int")
    right = spark.createDataFrame([(None, 3), ("a", 4)], "k string, r int")
    assert rows(merge(left, right, "k")) == [("a", 1, 4), (None, 2, 3)]


def test_merge_suffixes_clashing_columns(spark):
    left = spark.createDataFrame([("a", "open")], "k string, status string")
    right = spark.createDataFrame([("a", "closed")], "k string, status string")
    out = merge(left, right, "k", "left")
    assert out.columns == ["k", "status_x", "status_y"]


def _ratio_input(spark):
    return spark.createDataFrame(
        [("AB", "Mandrels", 2.0), ("AB", "Inner Race", 4.0), ("ABC", "Mandrels", 10.0), ("ABC", "Nut", 5.0)],
        "customerCode string, Category string, q double")


def test_h3_customer_ratio_substring(spark):
    out = reports.customer_ratio(_ratio_input(spark), "q")
    assert rows(out, "customer", "customerCode", "Category", "ratio") == [
        ("AB", "AB", "Inner Race", 2.0), ("AB", "AB", "Nut", 0.0),
        ("AB", "ABC", "Inner Race", 0.0), ("AB", "ABC", "Nut", 2.5), ("ABC", "ABC", "Nut", 0.5)]


def test_h3_customer_ratio_exact(spark):
    out = reports.customer_ratio(_ratio_input(spark), "q", match="exact")
    assert rows(out, "customer", "customerCode", "Category", "ratio") == [
        ("AB", "AB", "Inner Race", 2.0), ("ABC", "ABC", "Nut", 0.5)]


def test_substring_pairs_include_longer_codes(spark):
    codes = spark.createDataFrame([("C1",), ("C10",), ("X C1",), ("C2",)], "customerCode string")
    pairs = rows(reports.substring_pairs(codes))
    assert ("C1", "C10") in pairs and ("C1", "X C1") in pairs and ("C1", "C1") in pairs
    assert ("C2", "C10") not in pairs and ("C10", "C1") not in pairs


def test_h9_parse_currency(spark):
    df = spark.createDataFrame([("$1,234.50",), ("12%",), ("-3",)], "t string")
    assert [r[0] for r in df.select(parse_currency(F.col("t"))).collect()] == [1234.5, 12.0, -3.0]


def test_h12_with_margins(spark):
    cells = spark.createDataFrame([("1", "A", 1.0), ("1", "B", 2.0), ("2", "A", 3.0)], "MotorSize string, Category string, v double")
    got = {(r[0], r[1]): r[2] for r in reports.with_margins(cells, "v").collect()}
    assert got[("Category Sum", "A")] == 4 and got[("Category Sum", "B")] == 2
    assert got[("1", "Size Sum")] == 3 and got[("2", "Size Sum")] == 3
    assert got[("Category Sum", "Size Sum")] == 6
    color = {(r[0], r[1]): r["color_value"] for r in reports.with_margins(cells, "v").collect()}
    assert color[("1", "A")] == 1 and color[("Category Sum", "A")] == 0 and color[("2", "Size Sum")] == 0


def test_with_margins_all_zero_gives_nothing(spark):
    cells = spark.createDataFrame([("1", "A", 0.0)], "MotorSize string, Category string, v double")
    assert reports.with_margins(cells, "v").count() == 0


def test_h13_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(0.0,), (1.0,)], "v double")
    got = {r["bin"]: r["count"] for r in reports.histogram(df, "v").collect()}
    assert len(got) == 20 and got[0] == 1 and got[19] == 1 and sum(got.values()) == 2


def test_histogram_single_value_range(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    out = reports.histogram(df, "v").orderBy("bin").collect()
    assert out[0]["lower"] == 2.5 and out[-1]["upper"] == 3.5 and sum(r["count"] for r in out) == 2


def test_h14_mandrel_ratio(spark):
    df = spark.createDataFrame(
        [("c", "1", "Mandrels", 0.0), ("c", "1", "Nut", 5.0), ("c", "2", "Mandrels", 2.0), ("c", "2", "Nut", 5.0)],
        "customerCode string, MotorSize string, Category string, q double")
    assert rows(reports.mandrel_ratio(df, "q")) == [("1", "Nut", 0.0), ("2", "Nut", 2.5)]


def test_h15_relative_to_baseline_ieee(spark):
    avgs = spark.createDataFrame(
        [("ALPHA", None, "IR", 0.0), ("ALPHA", None, "Nut", 2.0), ("r1", "x", "IR", 3.0), ("r1", "x", "Nut", 1.0),
         ("r2", "x", "IR", 0.0)], "label string, customer string, Category string, ratio double")
    got = {(r["label"], r["Category"]): r["relative"] for r in reports.relative_to_baseline(avgs).collect()}
    assert got[("r1", "IR")] == math.inf and got[("r1", "Nut")] == 0.5
    assert math.isnan(got[("r2", "IR")]) and ("r2", "Nut") not in got


def test_group_averages_replace_members(spark):
    ratios = spark.createDataFrame(
        [("x", "ALPHA C1", "IR", 1.0), ("x", "alpha C2", "IR", 3.0), ("x", "C3", "IR", 5.0)],
        "customer string, customerCode string, Category string, ratio double")
    got = rows(reports.group_averages(ratios), "label", "Category", "ratio")
    assert got == [("ALPHA", "IR", 2.0), ("C3", "IR", 5.0)]


def test_h16_exclude_pattern_matches_substrings(spark):
    df = spark.createDataFrame([("offset ring",), ("orbit pin",), ("plain ring",)], "d string")
    assert rows(exclude_pattern(df, "d", "bit|set", case=False)) == [("plain ring",)]


def test_h17_to_hours(spark):
    df = spark.createDataFrame([(120.0, "M"), (7200.0, "S"), (2.0, "H")], "t double, u string")
    assert [r[0] for r in df.select(to_hours(F.col("t"), F.col("u"))).collect()] == [2.0, 2.0, 2.0]


def test_h19_full_outer_merge_with_estimate_suffix(spark):
    left = spark.createDataFrame([("b", 1), ("a", 2)], "key string, d int")
    right = spark.createDataFrame([("c", 3), ("a", 4)], "key string, d int")
    out = merge(left, right, "key", "full_outer", suffixes=("", "_estimate"))
    assert rows(out, "key", "d", "d_estimate") == [("a", 2, 4), ("b", 1, None), ("c", None, 3)]


def test_top_parts_tie_break(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 3.0)], "partNumber string, q double")
    assert [r[0] for r in reports.top_parts(df, "q", 2).collect()] == ["c", "a"]


def test_breakdown_bundle(spark):
    from partflow.plans.breakdown import breakdown

    df = spark.createDataFrame(
        [("ALPHA C1", "1", "Mandrels", 2.0), ("ALPHA C1", "1", "Inner Race", 4.0), ("C2", "2", "Mandrels", 1.0),
         ("C2", "2", "Inner Race", 3.0), ("DELTA C3", "1", "None", 7.0)],
        "customerCode string, MotorSize string, Category string, q double")
    out = breakdown(df, "q")
    assert "share_of_total" not in out and "histogram" in out
    assert rows(out["size_category_pivot"]) == [("1", "Inner Race", 4.0), ("1", "Mandrels", 2.0),
                                                ("2", "Inner Race", 3.0), ("2", "Mandrels", 1.0)]
    assert sum(r["count"] for r in out["histogram"].collect()) == 2   # C2 row + ALPHA mean row
