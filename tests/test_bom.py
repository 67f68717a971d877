"""Bill-of-material operators: hand fixtures and path form vs DAG form on random DAGs."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from frames import rows
from partflow.functions.patterns import MOLD_BLANK_MARKERS, X_RACE_MARKERS
from partflow.operators import bom
from partflow.sources import sinks

EDGE_SCHEMA = "assembly string, part string, quantity double, description string, ord bigint"


def _edges(spark, triples):
    data = [(a, p, float(q), f"d{p}", i) for i, (a, p, q) in enumerate(triples)]
    return bom.bom_edges(spark.createDataFrame(data, EDGE_SCHEMA), "assembly", "part")


def _roots(spark, parts):
    return spark.createDataFrame([(p, f"d{p}") for p in parts], "part string, description string")


def _demand(spark, pairs):
    return spark.createDataFrame([(p, float(q)) for p, q in pairs], "partNumber string, q double")


def _sums(df):
    out = {}
    for r in df.collect():
        out[r["partNumber"]] = out.get(r["partNumber"], 0.0) + r["q"]
    return out


def _path_values(df):
    return sorted((r["partNumber"], r["q"]) for r in df.collect())


DIAMOND = [("A", "B", 2), ("A", "C", 3), ("B", "D", 4), ("C", "D", 5), ("D", "E", 1)]


def _walk(triples, root_parts, demand):
    """Materials and components as (part, value) rows, by walking every path of plain dictionaries."""
    kids = {}
    for a, p, q in triples:
        if all(p != x for x, _ in kids.setdefault(a, [])):
            kids[a].append((p, float(q)))
    mark = lambda p: any(m in p for m in MOLD_BLANK_MARKERS)             # noqa: E731
    xrace = lambda p: any(m in p for m in X_RACE_MARKERS)                # noqa: E731
    height = lambda p: max((1 + height(c) for c, _ in kids.get(p, [])), default=0)
    visits = {}

    def visit(p, q):
        visits.setdefault(p, []).append(q)
        for c, cq in kids.get(p, []):
            visit(c, cq)
    for r in sorted(root_parts):
        visit(r, 1.0)
    mats, comps = [], []

    def materials(p, v):
        if p not in kids or mark(p):
            mats.append((p, v))
        for c, q in kids.get(p, []):
            materials(c, v * q)

    def components(p, v):
        if (mark(p) or height(p) < 1) and not xrace(p):
            return
        if height(p) == 1 or any(mark(c) for c, _ in kids.get(p, [])) or xrace(p):
            comps.append((p, v))
        for c, q in kids.get(p, []):
            components(c, v * q)
    for p, v in demand:
        if p in visits:
            materials(p, v * visits[p][0])
            components(p, v * min(visits[p]))
    return sorted(mats), sorted(comps)


def _both_forms(spark, triples, root_parts, demand):
    """Materials and components by the anchors of the exploded tree and by those of the DAG; must agree."""
    e, roots = _edges(spark, triples), _roots(spark, root_parts)
    nodes = bom.explode_bom(e, roots)
    d = _demand(spark, demand)
    m1 = _path_values(bom.bom_materials(e, bom.first_anchors(nodes), d, "q"))
    m2 = _path_values(bom.bom_materials(e, bom.dag_first_anchors(e, roots), d, "q"))
    c1 = _path_values(bom.bom_components(e, bom.smallest_anchors(nodes), d, "q"))
    ladder = []
    c2 = _path_values(bom.bom_components(e, bom.dag_smallest_anchors(e, roots, ladder), d, "q", bom.ladder_heights(ladder)))
    assert m1 == m2 and c1 == c2
    return m1, c1


FIXTURES = [
    (DIAMOND, ["A"], [("A", 10)], [("E", 80.0), ("E", 150.0)], [("D", 80.0), ("D", 150.0)]),
    ([("A", "BK1", 2), ("BK1", "Z", 3)], ["A"], [("A", 1)], [("BK1", 2.0), ("Z", 6.0)], [("A", 1.0)]),
    ([("A", "15X9", 2)], ["A"], [("A", 1)], [("15X9", 2.0)], [("15X9", 2.0), ("A", 1.0)]),
    ([("P", "Q", 3), ("Q", "Z", 2)], ["P", "Q"], [("Q", 1)], [("Z", 6.0)], [("Q", 1.0)]),
]


def _one_bill(bills):
    """Several bills side by side: the names of bill k begin with k."""
    name = lambda k, p: f"{k}.{p}"                                       # noqa: E731
    return ([(name(k, a), name(k, p), q) for k, b in enumerate(bills) for a, p, q in b[0]],
            [name(k, r) for k, b in enumerate(bills) for r in b[1]], [(name(k, p), v) for k, b in enumerate(bills) for p, v in b[2]])


def test_fixture_forms_agree(spark):
    mats, comps = _both_forms(spark, *_one_bill(FIXTURES))
    assert mats == sorted((f"{k}.{p}", v) for k, f in enumerate(FIXTURES) for p, v in f[3])
    assert comps == sorted((f"{k}.{p}", v) for k, f in enumerate(FIXTURES) for p, v in f[4])


def test_h5_diamond_paths_materials_components(spark):
    e = _edges(spark, DIAMOND)
    nodes = bom.explode_bom(e, _roots(spark, ["A"]))
    order = [r["Node"] for r in nodes.orderBy("ord").collect()]
    assert order == ["A", "B", "D", "E", "C", "D", "E"]
    d = _demand(spark, [("A", 10)])
    mats = bom.bom_materials(e, bom.first_anchors(nodes), d, "q")
    assert _path_values(mats) == [("E", 80.0), ("E", 150.0)]
    comps = bom.bom_components(e, bom.smallest_anchors(nodes), d, "q")
    assert _path_values(comps) == [("D", 80.0), ("D", 150.0)]


def test_h5p_prune_tree(spark):
    e = _edges(spark, DIAMOND)
    nodes = bom.explode_bom(e, _roots(spark, ["A"]))
    pruned = bom.prune_tree(nodes)
    assert rows(pruned, "Node", "Parent") == [("A", "Root"), ("B", "A"), ("C", "A"), ("D", "B"), ("E", "D")]
    pe = bom.tree_edges(pruned)
    pnodes = bom.explode_bom(pe, bom.tree_roots(pruned))
    d = _demand(spark, [("A", 10)])
    assert _path_values(bom.bom_materials(pe, bom.first_anchors(pnodes), d, "q")) == [("C", 30.0), ("E", 80.0)]
    assert _path_values(bom.bom_components(pe, bom.smallest_anchors(pnodes), d, "q")) == [("D", 80.0)]


def test_h5r_save_load_last_row_wins(spark):
    e = _edges(spark, DIAMOND)
    nodes = bom.explode_bom(e, _roots(spark, ["A"]))
    path = sinks.save_tree(bom.tree_rows(nodes), tempfile.mkdtemp(prefix="tree-") + "/t")
    loaded = sinks.load_tree(spark, path)
    d_row = [r for r in loaded.collect() if r["Node"] == "D"][0]
    assert d_row["Parent"] == "C" and d_row["Quantity"] == 5.0
    le, lr = bom.loaded_tree_edges(loaded)
    le = bom.bom_edges(le, "assembly", "part")
    lnodes = bom.explode_bom(le, lr)
    d = _demand(spark, [("A", 10)])
    assert _path_values(bom.bom_materials(le, bom.first_anchors(lnodes), d, "q")) == [("B", 20.0), ("E", 150.0)]
    assert _path_values(bom.bom_components(le, bom.smallest_anchors(lnodes), d, "q")) == [("D", 150.0)]


def test_h6_mold_blank_marker(spark):
    e = _edges(spark, [("A", "BK1", 2), ("BK1", "Z", 3)])
    nodes = bom.explode_bom(e, _roots(spark, ["A"]))
    d = _demand(spark, [("A", 1)])
    assert _path_values(bom.bom_materials(e, bom.first_anchors(nodes), d, "q")) == [("BK1", 2.0), ("Z", 6.0)]
    assert _path_values(bom.bom_components(e, bom.smallest_anchors(nodes), d, "q")) == [("A", 1.0)]


def test_h6x_x_race(spark):
    e = _edges(spark, [("A", "15X9", 2)])
    nodes = bom.explode_bom(e, _roots(spark, ["A"]))
    d = _demand(spark, [("A", 1)])
    assert _path_values(bom.bom_materials(e, bom.first_anchors(nodes), d, "q")) == [("15X9", 2.0)]
    assert _path_values(bom.bom_components(e, bom.smallest_anchors(nodes), d, "q")) == [("15X9", 2.0), ("A", 1.0)]


def test_h7_anchors(spark):
    e = _edges(spark, [("P", "Q", 3), ("Q", "Z", 2)])
    roots = _roots(spark, ["P", "Q"])
    nodes = bom.explode_bom(e, roots)
    d = _demand(spark, [("Q", 1)])
    assert _path_values(bom.bom_materials(e, bom.first_anchors(nodes), d, "q")) == [("Z", 6.0)]
    assert _path_values(bom.bom_components(e, bom.smallest_anchors(nodes), d, "q")) == [("Q", 1.0)]
    assert rows(bom.dag_first_anchors(e, roots), "part", "a_quantity") == [("P", 1.0), ("Q", 3.0), ("Z", 2.0)]


def test_h8_dedupe_first(spark):
    raw = spark.createDataFrame([("A", "B", 2.0, "x", 0), ("A", "B", 7.0, "y", 1)], EDGE_SCHEMA)
    assert rows(bom.bom_edges(raw, "assembly", "part"), "quantity") == [(2.0,)]


def test_cycle_raises(spark):
    e = _edges(spark, [("A", "B", 1), ("B", "A", 1)])
    with pytest.raises(ValueError):
        bom.explode_bom(e, _roots(spark, ["A"]))


def test_part_heights(spark):
    e = _edges(spark, DIAMOND)
    assert dict(rows(bom.part_heights(e))) == {"A": 3, "B": 2, "C": 2, "D": 1, "E": 0}


def _random_dag(rng, n):
    names = [rng.choice(["PN", "BK", "15X", "KM"]) + str(i) for i in range(n)]
    triples = []
    for i in range(n):
        for j in range(i + 1, n):
            if rng.random() < 0.25:
                triples.append((names[i], names[j], rng.randint(1, 4)))
    roots = [names[i] for i in range(n) if rng.random() < 0.4] or [names[0]]
    demand = [(p, rng.randint(1, 9)) for p in roots]
    return triples, roots, demand


def test_dag_form_equals_path_form(spark):
    triples, root_parts, demand = _one_bill([_random_dag(random.Random(seed), 9) for seed in (1, 2, 3)])
    e = _edges(spark, triples)
    roots = _roots(spark, root_parts)
    nodes = bom.explode_bom(e, roots)
    d = _demand(spark, demand)
    paths = _sums(bom.bom_materials(e, bom.first_anchors(nodes), d, "q"))
    dag = _sums(bom.bom_materials(e, bom.dag_first_anchors(e, roots), d, "q", form="dag"))
    assert paths == pytest.approx(dag)
    cpaths = _sums(bom.bom_components(e, bom.smallest_anchors(nodes), d, "q"))
    cdag = _sums(bom.bom_components(e, bom.dag_smallest_anchors(e, roots), d, "q", form="dag"))
    assert cpaths == pytest.approx(cdag)
    assert _both_forms(spark, triples, root_parts, demand) == _walk(triples, root_parts, demand)
    # what the tree has of a part, without the tree
    for last, by in ((False, "min"), (True, "max")):
        want = {r["Node"]: tuple(r)[1:] for r in nodes.groupBy("Node").agg(F.expr(f"{by}_by(struct(ord, Parent, depth, quantity, description), ord) AS x"))
                .select("Node", "x.*").collect()}
        for growth in (4, 0):                 # 0: segments are not doubled after the first round
            assert {r["part"]: tuple(r)[1:] for r in bom.dag_visits(e, roots, last, growth=growth).collect()} == want
    heights = dict(rows(bom.part_heights(e)))
    longest = {r["part"]: r["h"] for r in nodes.select(F.posexplode("names").alias("k", "part"), F.size("names").alias("n"))
               .groupBy("part").agg(F.max(F.col("n") - 1 - F.col("k")).alias("h")).collect()}
    assert {p: h for p, h in heights.items() if p in longest} == {p: h for p, h in longest.items() if p in heights}
    # prune rule: one node per part, deepest
    pruned = {r["Node"]: r["depth"] for r in bom.prune_tree(nodes).collect()}
    deepest = nodes.groupBy("Node").agg(F.max("depth").alias("d")).collect()
    assert pruned == {r["Node"]: r["d"] for r in deepest}


def test_heights_of_a_long_chain_take_the_digits_of_its_length(spark):
    n = 1000
    chain = spark.range(n).selectExpr("concat('A', id) AS assembly", "concat('A', id + 1) AS part")
    rounds = []
    h = bom.part_heights(chain, rounds)
    assert h.agg(F.count("*"), F.sum("height"), F.max("height")).first() == (n + 1, n * (n + 1) // 2, n)
    assert h.where("height <> 1000 - CAST(substr(part, 2) AS int)").count() == 0
    assert len(rounds) <= 11 and rounds[-1] == 0


def test_rounds_of_an_explosion_are_the_digits_of_the_depth(spark, monkeypatch):
    written = []
    plain = bom.materialize_observed
    monkeypatch.setattr(bom, "materialize_observed", lambda *a, **m: written.append(a[1]) or plain(*a, **m))
    e = _edges(spark, [(f"A{i:02}", f"A{i + 1:02}", 1) for i in range(20)])
    assert bom.explode_bom(e, _roots(spark, ["A00", "A07"])).count() == 21 + 14
    assert len(written) <= 6


def test_a_cycle_beside_the_tree_is_left_out(spark):
    e = _edges(spark, [("A", "B", 2), ("B", "C", 3), ("C", "D", 1), ("D", "E", 1), ("X", "Y", 1), ("Y", "Z", 1), ("Z", "X", 1)])
    nodes = bom.explode_bom(e, _roots(spark, ["A"]))
    assert [r["Node"] for r in nodes.orderBy("ord").collect()] == list("ABCDE")
    with pytest.raises(ValueError, match="cycle"):
        bom.explode_bom(e, _roots(spark, ["A", "Y"]))


def test_many_equal_paths_are_rows_but_not_before(spark):
    lines = []
    for i in range(5):
        lines += [(f"N{i}", f"L{i}", 1), (f"N{i}", f"R{i}", 1), (f"L{i}", f"N{i + 1}", 2), (f"R{i}", f"N{i + 1}", 2)]
    e = _edges(spark, lines)
    leaf = spark.createDataFrame([("N5",)], "part string")
    table = bom.recorded_paths(e, leaf).where("start = 'N0'").collect()
    assert [(r["part"], r["factor"], r["n"]) for r in table] == [("N5", 32.0, 32)]
    out = bom.bom_materials(e, bom.dag_first_anchors(e, _roots(spark, ["N0"])), _demand(spark, [("N0", 3)]), "q")
    assert _path_values(out) == [("N5", 96.0)] * 32
    many = spark.createDataFrame([(1, 25), (2, 10), (3, 1)], "a int, n bigint")
    assert sorted(r["a"] for r in bom._repeated(many, "n", 10).collect()) == [1] * 25 + [2] * 10 + [3]


def test_intervals_hold_the_nodes_below(spark):
    rng = random.Random(8)
    triples, root_parts, _ = _random_dag(rng, 9)
    nodes = bom.explode_bom(_edges(spark, triples), _roots(spark, root_parts))
    labelled = bom.interval_labels(nodes.select("Node", "depth", "ord"))
    got = sorted((r["a_ord"], r["ord"]) for r in bom.descendants(labelled).collect())
    keys = sorted(r["ord"] for r in nodes.collect())
    assert got == sorted((a, b) for a in keys for b in keys if a != b and b.startswith(a)) and got
    assert sorted(r["left"] for r in labelled.collect()) == sorted(r["left"] for r in labelled.orderBy("ord").collect())
    assert {r["ord"]: r["size"] for r in labelled.collect()} == {a: sum(b.startswith(a) for b in keys) - 1 for a in keys}
    counts = {r["ord"]: (r["nodes"], r["leaves"]) for r in bom.descendant_counts(labelled, labelled.where("depth <= 2")).collect()}
    leaf = {k for k in keys if not any(b != k and b.startswith(k) for b in keys)}
    assert all(counts[a] == (sum(b.startswith(a) for b in keys) - 1, sum(b.startswith(a) and b != a for b in leaf)) for a in counts)
    assert bom.descendants(labelled, labelled.where("false")).count() == 0


def test_descendants_send_a_node_to_few_blocks(spark, monkeypatch):
    # a path of 70 nodes, each with a leaf: intervals of 3 to 279 numbers, of 8 powers of two
    rows = [(f"n{k}", k + 1, "a" * (k + 1)) for k in range(70)] + [(f"l{k}", k + 2, "a" * (k + 1) + "b") for k in range(70)]
    visits = sorted((o + t, o) for _, _, o in rows for t in ("", "~"))
    at = {o: [i for i, (_, x) in enumerate(visits) if x == o] for _, _, o in rows}
    labelled = spark.createDataFrame([(n, d, o, at[o][0], at[o][1]) for n, d, o in rows], "Node string, depth int, ord string, left bigint, right bigint")
    want = {(a, b) for a in at for b in at if at[a][0] < at[b][0] < at[a][1]}
    widths, shift = [], F.shiftright
    monkeypatch.setattr(bom.F, "shiftright", lambda c, n: widths.append(n) or shift(c, n))
    below = bom.descendants(labelled)
    monkeypatch.undo()
    assert {(r["a_ord"], r["ord"]) for r in below.collect()} == want and below.count() == len(want)
    # without numbers inside, a leaf asks for no block
    leaves = bom.descendants(labelled, labelled.where("right - left = 1"))
    assert leaves.count() == 0
    assert sorted(widths) == [3, 6, 9]
