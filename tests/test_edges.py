"""Inputs at the edge of each operator: deep and odd bills, odd text, nulls, ties."""

import tempfile

import pytest
from pyspark.sql import functions as F

from frames import rows
from partflow.functions.semantics import ieee_ratio
from partflow.operators import bom, orders, reports
from partflow.session import get_session
from partflow.sources import entity, sinks

EDGE = "partNumber string, subPartNumber string, quantity double, description string, ord bigint"


def bill(spark, lines, roots=("A0",)):
    return (bom.bom_edges(spark.createDataFrame(lines, EDGE)),
            spark.createDataFrame([(r, f"root {r}") for r in roots], "part string, description string"))


def test_sibling_order_of_large_negative_and_null_lines(spark):
    ords = [10 ** 12, 999_999_999_999, -5, 0, None, 2 ** 63 - 1, -2 ** 63, 7]
    edges, roots = bill(spark, [("A0", f"p{k}", 1.0, "", o) for k, o in enumerate(ords)])
    nodes = bom.explode_bom(edges, roots).where("depth = 2").orderBy("ord").select("Node").collect()
    want = sorted(range(len(ords)), key=lambda k: (ords[k] is not None, ords[k] or 0))
    assert [n[0] for n in nodes] == [f"p{k}" for k in want]


def test_a_deep_chain_has_no_depth_limit(spark, monkeypatch):
    monkeypatch.setattr(bom, "CHECK_AFTER", 2)           # the check for cycles comes, and the loop goes on
    n = 5
    edges, roots = bill(spark, [(f"A{i}", f"A{i + 1}", 1.0, "", 0) for i in range(n)])
    demand = spark.createDataFrame([("A0", 3.0)], "partNumber string, q double")
    assert bom.bom_materials(edges, bom.dag_first_anchors(edges, roots), demand, "q", form="dag").first()["q"] == 3.0
    assert bom.dag_smallest_anchors(edges, roots).count() == n + 1


def test_a_cycle_raises_on_the_dag(spark):
    edges, roots = bill(spark, [("A0", "A1", 1.0, "", 0), ("A1", "A2", 1.0, "", 0), ("A2", "A1", 1.0, "", 0)])
    with pytest.raises(ValueError, match="cycle"):
        bom.part_heights(edges)
    with pytest.raises(ValueError, match="cycle"):
        bom.require_acyclic(edges, roots)
    bom.require_acyclic(edges.where("assembly = 'A0'"), roots)
    assert bom.reachable(edges, roots).count() == 3


def test_diamond_chain_is_pruned_without_its_paths(spark):
    lines = []
    for i in range(4):
        lines += [(f"A{i}", f"L{i}", 1.0, "", 0), (f"A{i}", f"R{i}", 1.0, "", 1), (f"L{i}", f"A{i + 1}", 1.0, "", 0), (f"R{i}", f"A{i + 1}", 1.0, "", 0)]
    edges, roots = bill(spark, lines)
    got = {r.Node: r for r in bom.prune_dag(edges, roots).collect()}
    assert len(got) == 4 * 3 + 1 and got["A4"].depth == 9 and got["A4"].Parent == "L3"
    small, roots = bill(spark, lines[:8], ("A0", "R1"))
    cols = ["root", "Node", "Parent", "depth", "quantity", "description", "ord"]
    assert rows(bom.prune_dag(small, roots), *cols) == rows(bom.prune_tree(bom.explode_bom(small, roots)), *cols)
    h = {r.part: r.height for r in bom.part_heights(small).collect()}
    assert h == {"A2": 0, "L1": 1, "R1": 1, "A1": 2, "L0": 3, "R0": 3, "A0": 4}


def test_null_quantity_comes_last_in_both_forms(spark):
    edges, roots = bill(spark, [("A0", "B", None, "", 0), ("A0", "C", 1.0, "", 1), ("C", "B", 2.0, "", 0)])
    nodes = bom.explode_bom(edges, roots)
    paths = dict(rows(bom.smallest_anchors(nodes), "part", "a_quantity"))
    assert paths == dict(rows(bom.dag_smallest_anchors(edges, roots), "part", "a_quantity")) and paths["B"] == 2.0


def test_tree_csv_gives_back_odd_text(spark):
    text = ['line one\nline two"', "  pad ", 'a "quoted", b', "", None, "back\\slash", "tab\t", "é 日本"]
    edges, roots = bill(spark, [("A0", f"p{k}", 1.5, t, k) for k, t in enumerate(text)])
    tree = bom.tree_rows(bom.explode_bom(edges, roots))
    back = sinks.load_tree(spark, sinks.save_tree(tree, tempfile.mkdtemp(prefix="tree-")))
    assert rows(back, "Node", "Parent", "Description", "Quantity") == rows(tree, "Node", "Parent", "Description", "Quantity")


def test_cache_needs_a_key_and_a_committed_folder(spark):
    df, root = spark.createDataFrame([(1, "a\nb", None)], "x int, s string, n string"), tempfile.mkdtemp(prefix="cache-")
    with pytest.raises(ValueError):
        entity.materialize_once(df, "t", key="", root=root)
    for fmt in ("parquet", "csv"):
        path = entity.materialize_once(df, "t", key="k" + fmt, root=root, fmt=fmt).inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        other = spark.createDataFrame([(2, "c", "d")], df.schema)
        assert rows(entity.materialize_once(other, "t", key="k" + fmt, root=root, fmt=fmt)) == [(1, "a\nb", None)]
        import os
        os.remove(f"{path}/_SUCCESS")                            # as an interrupted writer leaves it
        assert rows(entity.materialize_once(other, "t", key="k" + fmt, root=root, fmt=fmt)) == [(2, "c", "d")]


def test_filters_and_keys(spark):
    df = spark.createDataFrame([("2020-01-15-A", "2020-01-15T10:00:00", 5), ("x", "no date", 6), (None, None, 7)], "p string, d string, k long")
    assert rows(entity.entity_filter(df, "p=2020-01-15-A"), "k") == [(5,)]
    assert rows(entity.entity_filter(df, "d[gt]=2020-01-15"), "k") == [(5,)]
    assert rows(entity.entity_filter(df, "d[gt]=2020-01-15T10:00:00"), "k") == []
    keyed = spark.createDataFrame([("12",), ("12.5",), ("a",)], "p string")
    assert rows(entity.lookup_in(keyed, "p", [12.0, 12.5])) == [("12",), ("12.5",)]
    assert rows(entity.lookup_in(df, "k", [5.0, 6]), "k") == [(5,), (6,)]


def test_keyset_paging_with_null_keys(spark):
    data = [(None, 1), (None, None), (1, None), (1, 2), (2, 1)]
    df, seen, after = spark.createDataFrame(data, "a int, b int"), [], None
    while page := entity.page_after(df, ["a", "b"], after, take=2).collect():
        seen += [tuple(r) for r in page]
        after = seen[-1]
    assert seen == [(None, None), (None, 1), (1, None), (1, 2), (2, 1)]


def test_date_bound_reaches_the_scan(spark):
    path = tempfile.mkdtemp(prefix="dates-") + "/t"
    spark.createDataFrame([("2020-01-15T10:00:00",), ("bad",)], "d string").write.parquet(path)
    plan = spark.read.parquet(path).where(entity.after_time("d", "2020-01-15"))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(d,2020-01-15)" in plan


@pytest.mark.parametrize("values", [[], [1.0], [2.0, 2.0, 2.0], [None, float("nan")]])
def test_no_curve_without_a_bandwidth(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert reports.kde_curve(df, "v").count() == 0


def test_ieee_ratio(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(nan, 0.0), (0.0, 0.0), (1.0, nan), (1.0, 0.0), (-1.0, 0.0), (1.0, 2.0), (None, 1.0)], "a double, b double")
    got = [r[0] for r in df.select(ieee_ratio(F.col("a"), F.col("b"))).collect()]
    assert str(got) == str([nan, nan, nan, inf, -inf, 0.5, None])


def test_lead_times_by_text_and_by_date(spark):
    day = lambda d: f"{d}T00:00:00"
    df = spark.createDataFrame([(day(a), day(b), p, "v") for p, a, b in [
        ("p", "1998-12-01", "1999-01-05"), ("p", "2024-02-20", "2024-02-29"), ("q", "2024-01-09", "2024-01-02"), ("q", "2023-12-30", "2024-01-02")]],
        "dateEntered string, dateFinished string, partNumber string, vendorCode string")
    assert rows(orders.lead_times(df)) == [("p", 35, "99-01-05"), ("q", 3, "24-01-02")]
    assert rows(orders.lead_times(df, order="date")) == [("p", 9, "24-02-29"), ("q", 3, "24-01-02")]
    assert "SortAggregate" not in orders.lead_times(df)._jdf.queryExecution().executedPlan().toString()


def test_cluster_sessions_keep_their_driver_host(monkeypatch):
    seen = {}

    class Builder:
        def appName(self, _):
            return self

        def master(self, _):
            return self

        def config(self, k, v):
            seen[k] = v
            return self

        def getOrCreate(self):
            raise StopIteration

    monkeypatch.setattr("partflow.session.SparkSession", type("S", (), {"builder": Builder()}))
    with pytest.raises(StopIteration):
        get_session(master=None)
    assert "spark.driver.host" not in seen and "spark.driver.memory" not in seen
    with pytest.raises(StopIteration):
        get_session("local[2]")
    assert seen["spark.driver.host"] == "127.0.0.1"
