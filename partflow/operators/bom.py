"""Bill-of-material operators on edge tables.

A BOM is an edge table ``(assembly, part, quantity, description, ord)`` plus a
root table ``(part, description)``. The reference builds one tree node per
*path*; here a path is a row. Paths are put together by doubling: segments of 1, 2, 4 ... lines are joined
to each other and to the paths so far, so the joins grow with the logarithm of the depth.
Each step is written to the session's shared checkpoint folder
(:func:`partflow.session.materialize`), so lineage stays one step deep and a
lost executor recomputes at most one step.

Preorder: siblings are ordered by the BOM line order ``ord``, depth-1 nodes
by part number. The column ``ord`` of a node is a string key whose
byte order is the preorder: each path element is encoded as
20 digits of ``ord`` (shifted to be positive; dashes for null, which come first), then ``hex(part) || '!'``
(the root element without the ord part), which is prefix-free and order preserving.

Two evaluation forms:

* **paths** - one row per path, as the reference's tree walk produces. Rows of materials and components are equal for
  paths of equal ends and product, so they are kept once with their number until the result is made
  (:func:`recorded_paths`); only :func:`explode_bom` holds every path by name;
* **dag** - rows aggregated per part after every level. Recording and stopping
  rules depend only on the part, and quantities multiply along a path, so the
  per-part sums are exact while the data per level stays bounded by the
  number of parts.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partflow.functions.patterns import BOM_ROOT, MOLD_BLANK_MARKERS, X_RACE_MARKERS
from partflow.functions.scalar import contains_any
from partflow.session import materialize, materialize_observed

# Rounds of a level loop after which the bill is checked for cycles, once; a deep one without any goes on.
CHECK_AFTER = 32


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def root_key(part: Column) -> Column:
    return F.concat(F.hex(part), F.lit("!"))


def child_key(ord_: Column, part: Column) -> Column:
    shifted = ord_.cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")
    digits = F.coalesce(F.lpad(shifted.cast("string"), 20, "0"), F.lit("-" * 20))
    return F.concat(digits, F.hex(part), F.lit("!"))


# --- inputs -----------------------------------------------------------------------------------------

def bom_edges(materials: DataFrame, assembly: str = "partNumber", part: str = "subPartNumber",
              quantity: str = "quantity", description: str = "description", order: str = "ord") -> DataFrame:
    """Deduplicated BOM lines: the first line (by ``ord``) of every (assembly, part) pair.

    Repeated lines are dropped, not summed. Lines with a null assembly or part
    are dropped. ``min_by`` combines map-side, so a hot assembly is not a
    single-task problem.
    """
    e = materials.select(F.col(assembly).alias("assembly"), F.col(part).alias("part"),
                         F.col(quantity).cast("double").alias("quantity"),
                         F.col(description).alias("description"), F.col(order).cast("bigint").alias("ord"))
    e = e.where(F.col("assembly").isNotNull() & F.col("part").isNotNull())
    first = F.min_by(F.struct("quantity", "description", "ord"), F.struct("ord", "quantity", "description"))
    return (e.groupBy("assembly", "part").agg(first.alias("__f"))
            .select("assembly", "part", "__f.quantity", "__f.description", "__f.ord"))


def bom_roots(demand: DataFrame, part: str = "partNumber", description: str = "partDescription",
              order: Column | None = None) -> DataFrame:
    """Distinct demand parts with their first description: the depth-1 nodes."""
    o = order if order is not None else F.col(description)
    return (demand.where(F.col(part).isNotNull()).groupBy(F.col(part).alias("part"))
            .agg(F.min_by(F.col(description), o).alias("description")))


def bom_step(frontier: DataFrame, materials: DataFrame, part: str = "partNumber") -> DataFrame:
    """One BOM layer: the lines of every frontier part, renamed as the reference's layer table."""
    keys = frontier.select(F.col(part).alias("__k")).where(F.col("__k").isNotNull()).distinct()
    m = materials.join(keys, materials["partNumber"] == keys["__k"], "left_semi")
    return m.select(F.col("partNumber").alias("Assembly"), F.col("subPartNumber").alias("partNumber"),
                    F.col("description").alias("partDescription"), "quantity")


def _edge_cols(edges: DataFrame) -> DataFrame:
    return edges.select(*[F.col(c).alias("e_" + c) for c in ("assembly", "part", "quantity", "description", "ord")])


# --- path explosion ---------------------------------------------------------------------------------

def explode_bom(edges: DataFrame, roots: DataFrame, ladder: list | None = None) -> DataFrame:
    """Every path from every root: (root, Node, Parent, depth, quantity, description, ord, names,
    line, cum) with ``cum`` the product of the quantities below the root.

    Depth-1 nodes have parent ``Root`` and quantity 1. Round k joins the paths of fewer than 2^k lines to the segments
    of exactly 2^k lines, and the segments to themselves; a segment ends some path of the result if its first part is below a
    root, so there are no more of them than of nodes. A part that comes again below itself is a cycle and raises,
    if a root reaches it. ``ladder`` gets the segments' ends (:func:`ladder_heights`).
    """
    paths = [materialize(roots.select(
        F.col("part").alias("root"), F.col("part").alias("Node"), F.lit(BOM_ROOT).alias("Parent"),
        F.lit(1).alias("depth"), F.lit(1.0).alias("quantity"), F.col("description"),
        root_key(F.col("part")).alias("ord"), F.array(F.col("part")).alias("names"),
        F.lit(0).cast("bigint").alias("line"), F.lit(1.0).alias("cum")), "bom-paths")]
    cols = paths[0].columns
    # a segment's first part stands in the place of a path's root
    segments = edges.select(
        F.col("assembly").alias("root"), F.col("part").alias("Node"), F.col("assembly").alias("Parent"), F.lit(1).alias("depth"),
        "quantity", "description", child_key(F.col("ord"), F.col("part")).alias("ord"), F.array("part").alias("names"),
        F.col("ord").alias("line"), F.col("quantity").alias("cum"))
    while True:
        if ladder is not None:
            ladder.append(segments.select(F.col("root").alias("start"), F.col("Node").alias("part")))
        left = _union([x.withColumn("__path", F.lit(True)) for x in paths] + [segments.withColumn("__path", F.lit(False))])
        right = segments.select(*[F.col(c).alias("r_" + c) for c in cols])
        twice = F.arrays_overlap("names", "r_names") | F.array_contains("r_names", F.col("root"))
        both = left.join(right, left["Node"] == right["r_root"]).select(
            "root", *[F.col("r_" + c).alias(c) for c in ("Node", "Parent", "quantity", "description", "line")],
            (F.col("depth") + F.col("r_depth")).alias("depth"), *[F.concat(c, "r_" + c).alias(c) for c in ("ord", "names")],
            (F.col("cum") * F.col("r_cum")).alias("cum"), "__path", twice.alias("__twice"))
        both, seen = materialize_observed(both, "bom-paths", new=F.count_if("__path"), cycles=F.count_if("__twice"),
                                          below=F.count_if(F.col("__path") & F.col("__twice")))
        if seen["below"]:
            raise ValueError("the bill of materials has a cycle")
        if not seen["new"]:
            return _union(paths)
        if seen["cycles"]:
            require_acyclic(edges, roots)
            # the cycle is not below a root: begin again with what is
            below = materialize(reachable(edges, roots), "bom-reach").withColumnRenamed("part", "assembly")
            if ladder is not None:
                ladder.clear()
            return explode_bom(edges.join(below, "assembly", "left_semi"), roots, ladder)
        paths.append(both.where("__path").select(*cols))
        segments = both.where("not __path").select(*cols)


def tree_edges(nodes: DataFrame) -> DataFrame:
    """Edges of a node table (e.g. a pruned tree), in the edge-table layout."""
    e = nodes.where(F.col("Parent") != BOM_ROOT).select(
        F.col("Parent").alias("assembly"), F.col("Node").alias("part"), "quantity", "description",
        F.col("line").alias("ord"))
    return bom_edges(e, "assembly", "part")


def tree_roots(nodes: DataFrame) -> DataFrame:
    return nodes.where(F.col("Parent") == BOM_ROOT).select(F.col("Node").alias("part"), "description").distinct()


def loaded_tree_edges(loaded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges, roots) of a tree reloaded from CSV (one node per name, last row wins).

    Siblings keep the order of their last rows; ranking inside one parent is
    a window over that parent's children only.
    """
    body = loaded.where(~F.col("Parent").isin(BOM_ROOT, "ROOT"))
    rank = F.dense_rank().over(Window.partitionBy("Parent").orderBy("ord")).cast("bigint")
    edges = body.select(F.col("Parent").alias("assembly"), F.col("Node").alias("part"),
                        F.col("Quantity").alias("quantity"), F.col("Description").alias("description"),
                        rank.alias("ord"))
    roots = loaded.where(F.col("Parent") == BOM_ROOT).select(F.col("Node").alias("part"),
                                                              F.col("Description").alias("description"))
    return edges, roots


def tree_rows(nodes: DataFrame) -> DataFrame:
    """Node table as saved to CSV: Node, Parent, Depth, Description, Quantity, plus the
    synthetic root row (Parent ROOT, depth 0, description N/A, quantity 0) and the
    preorder key ``ord`` and readable ``path``."""
    spark = nodes.sparkSession
    body = nodes.select("Node", "Parent", F.col("depth").alias("Depth"), F.col("description").alias("Description"),
                        F.col("quantity").alias("Quantity"), "ord",
                        F.concat_ws("/", F.lit(BOM_ROOT), F.array_join("names", "/")).alias("path"))
    # "!" sorts before every key (keys start with hex digits): the root row comes first.
    root = spark.createDataFrame([(BOM_ROOT, "ROOT", 0, "N/A", 0.0, "!", BOM_ROOT)], body.schema)
    return body.unionByName(root)


def interval_labels(nodes: DataFrame) -> DataFrame:
    """The nodes with nested-set labels: ``left`` and ``right`` number the first and the last visit of a node in one walk of
    the tree, ``size`` counts the nodes below it.

    Both visits are sorted by range in one table (the last visit's key is the node's with a sign that sorts after all
    children); a visit's number is its place in its partition after those of the partitions before.
    """
    spark = nodes.sparkSession
    visits = nodes.select("ord", F.explode(F.array(F.col("ord"), F.concat("ord", F.lit("~")))).alias("__at"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    visits = visits.repartitionByRange(n, "__at").sortWithinPartitions("__at").withColumn("__id", F.monotonically_increasing_id())
    visits = materialize(visits.select("ord", "__id", F.shiftright("__id", 33).alias("__part")), "tree-visits")
    # a row per partition
    sizes = visits.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    place = F.col("__before") + F.col("__id").bitwiseAND((1 << 33) - 1)
    labels = visits.join(F.broadcast(before), "__part").groupBy("ord").agg(F.min(place).alias("left"), F.max(place).alias("right"))
    return nodes.join(labels, "ord").withColumn("size", ((F.col("right") - F.col("left") - 1) / 2).cast("bigint"))


def descendants(labelled: DataFrame, asked: DataFrame | None = None, prefix: str = "a_") -> DataFrame:
    """A row per pair of an asked node (its columns with ``prefix``) and a node below it; all nodes are asked for by default.

    A range join on the labels of :func:`interval_labels` as an equi-join: an interval is met in the one or two blocks
    of numbers, as wide as the next power of eight, that it touches. A node is sent to its block of each width that is asked for (21 at
    most; an interval without numbers inside asks for none), and the rows compared are at most 16 times the pairs and asked nodes.
    """
    asked = labelled if asked is None else asked
    a = asked.select(*[F.col(c).alias(prefix + c) for c in asked.columns])
    left, right = prefix + "left", prefix + "right"
    a = a.where(F.col(right) - F.col(left) > 1)
    a = a.withColumn("__width", (F.ceil(F.length(F.bin(F.col(right) - F.col(left))) / 3) * 3).cast("int"))
    blocks = F.array_distinct(F.array(F.expr(f"shiftright({left}, __width)"), F.expr(f"shiftright({right}, __width)")))
    widths = sorted(r[0] for r in a.select("__width").distinct().collect())
    if not widths:
        return labelled.join(a.drop("__width"), F.lit(False))
    spots = F.explode(F.array(*[F.struct(F.lit(w).alias("__width"), F.shiftright("left", w).alias("__block")) for w in widths]))
    n = labelled.select("*", spots.alias("__s")).select(*labelled.columns, "__s.*")
    pairs = a.withColumn("__block", F.explode(blocks)).join(n, ["__width", "__block"])
    return pairs.where((F.col("left") > F.col(left)) & (F.col("left") < F.col(right))).drop("__width", "__block")


def descendant_counts(labelled: DataFrame, asked: DataFrame) -> DataFrame:
    """Per asked node (Node, ord, depth): nodes, distinct parts and leaves below it, and the greatest depth among them.

    An asked node without any below has zeros and its own depth.
    """
    # the label stands for the long key: a number goes along with the pairs
    below = descendants(labelled, asked.select("left", "right")).groupBy("a_left").agg(
        F.count(F.lit(1)).alias("nodes"), F.count_distinct("Node").alias("parts"),
        F.count_if(F.col("size") == 0).alias("leaves"), F.max("depth").alias("deepest"))
    out = asked.join(below, asked["left"] == below["a_left"], "left")
    return out.select("Node", "ord", "depth", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("nodes", "parts", "leaves")],
                      F.coalesce("deepest", "depth").alias("deepest"))


def prune_tree(nodes: DataFrame) -> DataFrame:
    """Keep one node per part: the deepest, first in preorder on ties.

    On a fully exploded tree the survivors' parents are survivors too, so
    this is a per-part pick (an aggregation, safe for hot parts) plus a
    semi join; no recursive detaching is needed.
    """
    pick = (nodes.groupBy("Node").agg(F.min_by(F.col("ord"), F.struct(-F.col("depth"), F.col("ord"))).alias("__k")))
    return nodes.join(pick, nodes["ord"] == pick["__k"], "left_semi")


def prune_dag(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """:func:`prune_tree` of the fully exploded tree without exploding it: a row per part.

    Level by level, each part keeps its preorder-first path of that length: the paths to one part
    aren't prefixes of each other, so the first path of a part goes on from first paths. A
    level has at most a row per part, however many paths there are.
    """
    level = materialize(roots.select(
        F.col("part").alias("root"), F.col("part").alias("Node"), F.lit(BOM_ROOT).alias("Parent"), F.lit(1).alias("depth"),
        F.lit(1.0).alias("quantity"), "description", root_key(F.col("part")).alias("ord"), F.lit(0).cast("bigint").alias("line")), "bom-prune")
    levels, cols, e = [level], level.columns, _edge_cols(edges)
    while True:
        nxt = level.join(e, level["Node"] == e["e_assembly"]).select(
            "root", F.col("e_part").alias("Node"), F.col("Node").alias("Parent"), (F.col("depth") + 1).alias("depth"),
            F.col("e_quantity").alias("quantity"), F.col("e_description").alias("description"),
            F.concat(F.col("ord"), child_key(F.col("e_ord"), F.col("e_part"))).alias("ord"), F.col("e_ord").alias("line"))
        rest = [c for c in cols if c != "Node"]
        nxt = nxt.groupBy("Node").agg(F.min_by(F.struct(*rest), F.col("ord")).alias("__r")).select("Node", "__r.*").select(*cols)
        level, seen = materialize_observed(nxt, "bom-prune")
        if not seen["rows"]:
            break
        levels.append(level)
        if len(levels) == CHECK_AFTER:
            require_acyclic(edges, level.select(F.col("Node").alias("part")))
    every = _union(levels)
    deepest = every.groupBy("Node").agg(F.max("depth").alias("depth"))
    return every.join(deepest, ["Node", "depth"], "left_semi").select(*cols)


# --- per-part properties -------------------------------------------------------------------------------

def part_heights(edges: DataFrame, rounds: list | None = None) -> DataFrame:
    """(part, height): longest way down to a leaf (leaf = 0), for every part in the edges.

    Each open edge (u, w, b) says that u is at least b above w; what is known of u is its ``least`` height. A round takes off
    the edges to parts without open edges, and lets every edge to a part that has only one open edge jump over that part
    to its target, so that a chain's edges double in length. Edges only get fewer; chains take as many rounds as
    their length has binary digits, other bills at most one a level. ``rounds`` gets the number of edges left after each
    round. Raises when edges are left but none of them leads to a part without: all are on, or above, a cycle.
    """
    open_ = edges.select(F.col("assembly").alias("u"), F.col("part").alias("w"), F.lit(1).alias("b")).distinct()
    found: list[DataFrame] = []
    while True:
        # of a part with one open edge: where it leads (the maxima are the only values)
        ways = open_.groupBy(F.col("u").alias("w")).agg(F.count(F.lit(1)).alias("n"), F.max("w").alias("to"), F.max("b").alias("more"))
        step, known = open_.join(ways, "w", "left"), F.lit(0)
        if found:
            least = _union(found).groupBy(F.col("u").alias("w")).agg(F.max("least").alias("least"))
            step, known = step.join(least, "w", "left"), F.coalesce("least", F.lit(0))
        leaf, single = F.col("n").isNull(), F.col("n") == 1
        step = step.select("u", F.when(leaf | single, F.col("b") + known).alias("least"), leaf.alias("leaf"),
                           F.when(single, F.col("to")).when(~leaf, F.col("w")).alias("w"),
                           F.when(single, F.col("b") + F.col("more")).when(~leaf, F.col("b")).alias("b"))
        step, seen = materialize_observed(step, "bom-height", leaves=F.count_if("leaf"))
        if seen["rows"] and not seen["leaves"]:
            raise ValueError("the bill of materials has a cycle")
        found.append(step.where("least is not null").select("u", "least"))
        if len(found) == 8:
            found = [materialize(_union(found).groupBy("u").agg(F.max("least").alias("least")), "bom-height")]
        left = seen["rows"] - (seen["leaves"] or 0)
        if rounds is not None:
            rounds.append(left)
        if not left:
            every = _union([x.select(F.col("u").alias("part"), "least") for x in found]
                           + [edges.select(c, F.lit(0).alias("least")).toDF("part", "least") for c in ("assembly", "part")])
            return every.groupBy("part").agg(F.max("least").alias("height"))
        open_ = step.where("w is not null").groupBy("u", "w").agg(F.max("b").alias("b"))


def ladder_heights(ladder: Sequence[DataFrame]) -> DataFrame:
    """(part, height) from the ends (start, part) of all segments of exactly 1, 2, 4 ... lines, as far as those below the roots go.

    Exact for every part that the roots reach.

    With heights known up to 2^k - 1, a part has 2^k more than the highest of those at the end of its segments of 2^k lines.
    """
    every = ladder[0].select("start").union(ladder[0].select("part")).distinct()
    known = every.select(F.col("start").alias("part"), F.lit(0).alias("height"))
    for k, ends in enumerate(ladder):
        more = ends.distinct().join(known, "part").select(F.col("start").alias("part"), (F.col("height") + (1 << k)).alias("height"))
        known = known.union(more).groupBy("part").agg(F.max("height").alias("height"))
    return materialize(known, "bom-height")


def reachable(edges: DataFrame, parts: DataFrame) -> DataFrame:
    """(part): the given parts and all below them; a part is visited once, so cycles don't matter."""
    level = materialize(parts.select("part").distinct(), "bom-reach")
    seen = [level]
    while True:
        nxt = (level.join(edges, level["part"] == edges["assembly"], "inner").select(edges["part"]).distinct()
               .join(_union(seen), "part", "left_anti"))
        level, stats = materialize_observed(nxt, "bom-reach")
        if not stats["rows"]:
            return _union(seen)
        seen.append(level)


def require_acyclic(edges: DataFrame, parts: DataFrame) -> None:
    """Raise ValueError if a cycle can be reached from the parts."""
    below = reachable(edges, parts).withColumnRenamed("part", "assembly")
    part_heights(edges.select("assembly", "part").join(below, "assembly", "left_semi"))


def part_info(edges: DataFrame, heights: DataFrame | None = None) -> DataFrame:
    """Per assembly: has children, any child with a mold/blank marker (and height if given)."""
    info = edges.groupBy(F.col("assembly").alias("part")).agg(
        F.lit(True).alias("has_children"),
        F.max(contains_any(F.col("part"), MOLD_BLANK_MARKERS)).alias("marker_child"))
    if heights is not None:
        info = heights.join(info, "part", "left")
    return info


def node_height(nodes: DataFrame, heights: DataFrame) -> DataFrame:
    """Height of every node of the exploded tree: that of its part (:func:`part_heights`)."""
    return (nodes.join(heights, nodes["Node"] == heights["part"], "left")
            .select("Node", "depth", "ord", F.coalesce(F.col("height"), F.lit(0)).alias("height")))


# --- anchors ---------------------------------------------------------------------------------------

def first_anchors(nodes: DataFrame) -> DataFrame:
    """Preorder-first node of each part: (part, a_quantity, a_description)."""
    a = nodes.groupBy(F.col("Node").alias("part")).agg(
        F.min_by(F.struct("quantity", "description"), F.col("ord")).alias("__a"))
    return a.select("part", F.col("__a.quantity").alias("a_quantity"), F.col("__a.description").alias("a_description"))


def smallest_anchors(nodes: DataFrame) -> DataFrame:
    """Node with the smallest quantity of each part (first in preorder on ties; a null quantity comes last)."""
    a = nodes.groupBy(F.col("Node").alias("part")).agg(
        F.min_by(F.struct("quantity", "description"), F.struct(F.col("quantity").isNull(), "quantity", "ord")).alias("__a"))
    return a.select("part", F.col("__a.quantity").alias("a_quantity"), F.col("__a.description").alias("a_description"))


def dag_visits(edges: DataFrame, roots: DataFrame, last: bool = False, ladder: list | None = None, growth: int = 4) -> DataFrame:
    """The first (or last) node in preorder of each part, without exploding paths:
    (part, key, Parent, depth, a_quantity, a_description).

    On a DAG the smallest path key to a part is the smallest over its ancestors
    of (their smallest key + the smallest key of a segment from there), because no path to a node is
    a prefix of another path to the same node; likewise the greatest. Segments of exactly 1, 2, 4 ... lines keep one key
    for each pair of ends, and each doubling takes keys of twice as many lines; the rounds are the digits of the longest path.
    Once the pairs are more than ``growth`` times the edges, the segments stay as they are, and keys that changed
    are followed over them until none does. ``ladder`` gets the pairs of ends of each doubling, unless it was broken off.
    """
    pick = F.max_by if last else F.min_by
    cols = ["key", "Parent", "depth", "a_quantity", "a_description"]

    def picked(rows: DataFrame, *keys: str) -> DataFrame:
        flags = [F.max("__moved").alias("__moved")] if "__moved" in rows.columns else []
        out = rows.groupBy(*keys).agg(pick(F.struct(*cols), F.col("key")).alias("__b"), *flags)
        return out.select(*keys, "__b.*", *(["__moved"] if flags else []))

    def longer(left: DataFrame, segments: DataFrame, *keep: str) -> DataFrame:
        r = segments.select(*[F.col(c).alias("r_" + c) for c in ("start", "part", *cols)])
        return left.join(r, left["part"] == r["r_start"]).select(
            *keep, F.col("r_part").alias("part"), F.concat("key", "r_key").alias("key"), F.col("r_Parent").alias("Parent"),
            (F.col("depth") + F.col("r_depth")).alias("depth"), *[F.col("r_" + c).alias(c) for c in cols[3:]])

    best = materialize(picked(roots.select("part", root_key(F.col("part")).alias("key"), F.lit(BOM_ROOT).alias("Parent"), F.lit(1).alias("depth"),
                                           F.lit(1.0).alias("a_quantity"), F.col("description").alias("a_description")), "part"), "bom-anchor")
    segments = edges.select(F.col("assembly").alias("start"), "part", child_key(F.col("ord"), F.col("part")).alias("key"),
                            F.col("assembly").alias("Parent"), F.lit(1).alias("depth"), F.col("quantity").alias("a_quantity"),
                            F.col("description").alias("a_description"))
    n, most, rounds = 0, None, 0
    while most is None or n <= most:
        if ladder is not None:
            ladder.append(segments.select("start", "part"))
        none = F.lit(None).cast("string").alias("start")
        own = best.select(none, "part", *cols)
        # what is known goes along, so that one aggregation picks the best of old and new
        rows = longer(own.unionByName(segments), segments, "start").withColumn("__moved", F.col("start").isNull()).unionByName(
            own.withColumn("__moved", F.lit(False)))
        both, seen = materialize_observed(picked(rows, "start", "part"), "bom-anchor", moved=F.count_if("__moved"),
                                          pairs=F.count_if(F.col("start").isNotNull()))
        best = both.where("start is null").select("part", *cols)
        if not seen["moved"]:
            return best
        rounds += 1
        if 1 << rounds == CHECK_AFTER:
            require_acyclic(edges, roots)
        segments, n = both.where("start is not null").select("start", "part", *cols), seen["pairs"]
        most = edges.count() * growth if most is None else most
    if ladder is not None:
        ladder.clear()
    known, delta = [best], best
    while True:
        both = longer(delta, segments).withColumn("__moved", F.lit(True)).unionByName(_union(known).withColumn("__moved", F.lit(False)))
        both = both.groupBy("part").agg(pick(F.struct(*cols, "__moved"), F.col("key")).alias("__b")).select("part", "__b.*")
        delta, seen = materialize_observed(both.where("__moved").drop("__moved"), "bom-anchor")
        if not seen["rows"]:
            return picked(_union(known), "part")
        known.append(delta)
        if len(known) == 8:
            known = [materialize(picked(_union(known), "part"), "bom-anchor")]
        rounds += 1
        if rounds == CHECK_AFTER:
            require_acyclic(edges, delta)


def dag_first_anchors(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Preorder-first node of each part: (part, a_quantity, a_description)."""
    return dag_visits(edges, roots).select("part", "a_quantity", "a_description")


def dag_smallest_anchors(edges: DataFrame, roots: DataFrame, ladder: list | None = None) -> DataFrame:
    """Node with the smallest quantity of each reachable part, as :func:`smallest_anchors` picks it: (part, a_quantity, a_description).

    Of the nodes that an edge makes, the first one in preorder lies below its assembly's first node.
    """
    first = dag_visits(edges, roots, ladder=ladder).select("part", "key")
    e = _edge_cols(edges)
    rows = first.join(e, first["part"] == e["e_assembly"]).select(
        F.col("e_part").alias("part"), F.col("e_quantity").alias("quantity"), F.col("e_description").alias("description"),
        F.concat(F.col("key"), child_key(F.col("e_ord"), F.col("e_part"))).alias("ord"))
    own = roots.select("part", F.lit(1.0).alias("quantity"), "description", root_key(F.col("part")).alias("ord"))
    return smallest_anchors(rows.unionByName(own).withColumnRenamed("part", "Node"))


def dag_last_rows(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Of the rows of :func:`tree_rows`, for each name the last one in preorder: what :func:`sinks.load_tree` keeps of them.

    (Node, Parent, Depth, Description, Quantity, ord), the root row included.
    """
    body = dag_visits(edges, roots, last=True).select(
        F.col("part").alias("Node"), "Parent", F.col("depth").alias("Depth"), F.col("a_description").alias("Description"),
        F.col("a_quantity").alias("Quantity"), F.col("key").alias("ord"))
    root = edges.sparkSession.createDataFrame([(BOM_ROOT, "ROOT", 0, "N/A", 0.0, "!")], body.schema)
    return body.unionByName(root)


# --- demand roll-down ---------------------------------------------------------------------------------

def recorded_paths(edges: DataFrame, recorded: DataFrame, demand: DataFrame | None = None) -> DataFrame:
    """(start, part, description, factor, n): from each part, the paths of at least one line down to recorded parts.

    ``factor`` is the product of a path's quantities and ``description`` that of its last line; ``n`` paths of the same ends, factor
    and description are one row. The table solves X = R + E X for the edges E and the last lines R, by doubling: with
    A the edges' paths of exactly 2^k lines, X of up to 2^(k+1) lines is X + A X. It has a row per part and recorded part
    below at least, whatever the number of paths between them. ``demand`` (part): where paths are wanted from;
    a cycle below it raises, others are left out.
    """
    keys = ["start", "part", "description", "ends", "factor"]

    def summed(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(F.sum("n").alias("n"))

    # ends: rows of X; else of A, which need no description
    lines = edges.select(F.col("assembly").alias("start"), "part", "description", F.col("quantity").alias("factor"), F.lit(1).cast("bigint").alias("n"))
    both = summed(lines.join(recorded, "part", "left_semi").withColumn("ends", F.lit(True)).unionByName(
        lines.withColumn("description", F.lit(None).cast("string")).withColumn("ends", F.lit(False))))
    both = materialize(both, "bom-recorded")
    x = [both.where("ends")]
    while True:
        step = both.where("not ends")
        left = step.select("start", F.col("part").alias("__mid"), F.col("factor").alias("__f"), F.col("n").alias("__n"))
        right = _union([*x, step]).withColumnRenamed("start", "__mid")
        new = left.join(right, "__mid").select("start", "part", "description", "ends", (F.col("__f") * F.col("factor")).alias("factor"),
                                               (F.col("__n") * F.col("n")).alias("n"))
        both, seen = materialize_observed(summed(new), "bom-recorded", ending=F.count_if("ends"))
        if not seen["ending"]:
            return _union(x).drop("ends")
        x.append(both.where("ends"))
        if 1 << len(x) > CHECK_AFTER and demand is not None:
            require_acyclic(edges, demand)
            below = materialize(reachable(edges, demand), "bom-reach").withColumnRenamed("part", "assembly")
            return recorded_paths(edges.join(below, "assembly", "left_semi").select(*edges.columns), recorded)


def _repeated(rows: DataFrame, n: str, chunk: int = 10_000) -> DataFrame:
    """Each row ``n`` times, without an array of more than ``chunk`` numbers or chunks of so many."""
    lots = rows.select("*", F.explode(F.sequence(F.lit(0), F.floor((F.col(n) - 1) / chunk))).alias("__lot"))
    size = F.least(F.lit(chunk), F.col(n) - F.col("__lot") * chunk)
    return lots.select(*[F.col(c) for c in rows.columns if c != n], F.explode(F.sequence(F.lit(1).cast("bigint"), size.cast("bigint")))
                       .alias("__k")).drop("__k")


def _path_rows(start: DataFrame, edges: DataFrame, recorded: DataFrame) -> DataFrame:
    """(part, value, description) of every path from the (part, value, description) of ``start`` to a recorded part, itself included."""
    own = start.join(recorded, "part", "left_semi")
    paths = recorded_paths(edges, recorded, start.select("part").distinct()).withColumnRenamed("part", "end")
    rows = start.select(F.col("part").alias("start"), "value").join(paths, "start").select(
        F.col("end").alias("part"), (F.col("value") * F.col("factor")).alias("value"), "description", "n")
    return own.select("part", "value", "description").unionByName(_repeated(rows, "n"))


def _rolldown(start: DataFrame, edges: DataFrame, props: DataFrame, record: Column, stop: Column) -> DataFrame:
    """Push (part, value) down the BOM, recording rows that match ``record``, summed per part after every level.

    ``stop`` rows are neither recorded nor expanded. One
    written table per level, with what to record and where to stop; the recorded rows are read from those tables.
    """
    e = _edge_cols(edges)

    def flagged(rows: DataFrame) -> DataFrame:
        rows = rows.groupBy("part").agg(F.sum("value").alias("value"))
        return (rows.join(props, "part", "left").where(~F.coalesce(stop, F.lit(False)))
                .select("part", "value", F.coalesce(record, F.lit(False)).alias("__record")))

    level = materialize(flagged(start), "bom-roll")
    out = [level]
    while True:
        nxt = level.join(e, level["part"] == e["e_assembly"]).select(
            F.col("e_part").alias("part"), (F.col("value") * F.col("e_quantity")).alias("value"))
        level, seen = materialize_observed(flagged(nxt), "bom-roll")
        if not seen["rows"]:
            recorded = _union([x.where("__record").select("part", "value") for x in out])
            return recorded.groupBy("part").agg(F.sum("value").alias("value")).withColumn("description", F.lit(None).cast("string"))
        out.append(level)
        if len(out) == CHECK_AFTER:
            require_acyclic(edges, level)


def _start(anchors: DataFrame, demand: DataFrame, statistic: str) -> DataFrame:
    """(part, value, description) of the demand parts' anchors: value = demand x the anchor node's own quantity."""
    a = anchors if "a_description" in anchors.columns else anchors.withColumn("a_description", F.lit(None).cast("string"))
    return demand.join(a, demand["partNumber"] == a["part"]).select(
        "part", (F.col(statistic) * F.col("a_quantity")).alias("value"), F.col("a_description").alias("description"))


def _named(rows: DataFrame, statistic: str) -> DataFrame:
    return rows.select(F.col("part").alias("partNumber"), F.col("value").alias(statistic), F.col("description").alias("partDescription"))


def _all_parts(edges: DataFrame, start: DataFrame) -> DataFrame:
    return edges.select("part").union(edges.select("assembly")).union(start.select("part")).distinct()


def bom_materials(edges: DataFrame, anchors: DataFrame, demand: DataFrame, statistic: str,
                  form: str = "paths") -> DataFrame:
    """Demand rolled down to materials: leaves and mold/blank parts (recursion continues
    through the latter). Start value = demand x the anchor node's own quantity.

    ``anchors`` is :func:`dag_first_anchors` (or :func:`first_anchors` of an exploded tree).
    Output (partNumber, <statistic>, partDescription): one row per path, or one
    per part with ``form='dag'``.
    """
    start = _start(anchors, demand, statistic)
    props = part_info(edges)
    record = ~F.coalesce(F.col("has_children"), F.lit(False)) | contains_any(F.col("part"), MOLD_BLANK_MARKERS)
    if form == "dag":
        return _named(_rolldown(start, edges, props, record, F.lit(False)), statistic)
    start = materialize(start, "bom-start")
    recorded = materialize(_all_parts(edges, start).join(props, "part", "left").where(record).select("part"), "bom-record")
    return _named(_path_rows(start, edges, recorded), statistic)


def bom_components(edges: DataFrame, anchors: DataFrame, demand: DataFrame, statistic: str,
                   heights: DataFrame | None = None, form: str = "paths") -> DataFrame:
    """Demand rolled down to components one level above the leaves.

    Stop at (mold/blank or leaf) unless an X-race; record at height 1, when a
    child is a mold/blank, or for an X-race. ``anchors`` is
    :func:`dag_smallest_anchors` (or :func:`smallest_anchors` of an exploded tree).
    """
    heights = heights if heights is not None else part_heights(edges)
    start = _start(anchors, demand, statistic)
    props = part_info(edges, heights)
    h = F.coalesce(F.col("height"), F.lit(0))
    mark = contains_any(F.col("part"), MOLD_BLANK_MARKERS)
    xrace = contains_any(F.col("part"), X_RACE_MARKERS)
    stop = (mark | (h < 1)) & ~xrace
    record = (h == 1) | F.coalesce(F.col("marker_child"), F.lit(False)) | xrace
    if form == "dag":
        return _named(_rolldown(start, edges, props, record, stop), statistic)
    start = materialize(start, "bom-start")
    going = materialize(_all_parts(edges, start).join(props, "part", "left").where(~F.coalesce(stop, F.lit(False)))
                        .select("part", F.coalesce(record, F.lit(False)).alias("__record")), "bom-record")
    # a path ends before a part where it stops, so those parts' lines and the lines to them are left out
    open_edges = edges.join(going.select(F.col("part").alias("assembly")), "assembly", "left_semi").join(going.select("part"), "part", "left_semi")
    recorded = going.where("__record").select("part")
    return _named(_path_rows(start.join(going.select("part"), "part", "left_semi"), open_edges.select(*edges.columns), recorded), statistic)


def material_requirements(demand: DataFrame, edges: DataFrame, roots: DataFrame, inventory: DataFrame,
                          statistic: str, in_process: str = "add", form: str = "dag") -> DataFrame:
    """Net demand -> positive only -> materials -> per-part sums -> inventory.

    net = statistic - (quantityOnHand - quantityToMake) (the reference's sign:
    in-process quantity raises demand; ``in_process='subtract'`` lowers it).
    Output: partNumber, <statistic>_12mo, quantityOnHand, quantityOrdered.
    """
    from partflow.functions.semantics import merge

    sign = 1.0 if in_process == "add" else -1.0
    net = F.col(statistic) - (F.col("quantityOnHand") - sign * F.col("quantityToMake"))
    d = demand.select("partNumber", net.alias(statistic)).where(F.col(statistic) > 0)
    if form == "dag":
        anchors = dag_first_anchors(edges, roots)
    else:
        anchors = first_anchors(explode_bom(edges, roots))
    mats = bom_materials(edges, anchors, d, statistic, form=form)
    per_part = mats.where(F.col("partNumber").isNotNull()).groupBy("partNumber").agg(
        F.coalesce(F.sum(statistic), F.lit(0.0)).alias(statistic))
    out = merge(per_part, inventory, "partNumber", "left")
    return out.select("partNumber", F.col(statistic).alias(f"{statistic}_12mo"), "quantityOnHand", "quantityOrdered")
