"""Structure repair of conversations: the cheapest edits that make the roles alternate, and of those the least audit.

A repaired conversation is empty or has an optional system row and then pairs of user and assistant rows. Edits:
Keep (0), Rerole to user or assistant (2), Delete (3; blank and repeated rows must go), Insert an empty user or
assistant row (2); a row that stays though its text is cut off costs 1 more. The audit is the edits' initials in order.

Costs are a dynamic programme over (row, what came last) with four states; a stretch of rows is a 4 x 4 matrix of
least costs, so stretches are worked on apart and joined by their matrices. Of the arcs that a cheapest repair may
take, nodes are ranked by their least audit: ranks of 2, 4, 8 ... letters come from pairs of ranks of half as many, the
second one at the node that a doubled pointer leads to. The ranks choose each node's arc, and the
path is read off the doubled pointers of the chosen arcs, all its places at once.

Rows are laid out in order over the partitions, whatever conversation they belong to, so one that has a third of all
rows is spread over many tasks. What crosses a partition border are the matrices, exits and last roles of the at
most two conversations that are cut by its ends. Only the digest of a repaired text must read a conversation from
its first row to its last; it streams blocks of rows and holds one of them.

Defined results: null role or text: one space; rows in order of turn, nulls first, ties by role, then by the first 64
characters and the md5 of the text (equal rows are alike); repeated rows are repetitions; a null conversation is one of
its own; an empty table gives an empty one; other columns are not read, whatever their names. A role that begins
with none of s, u, a fits nowhere without Rerole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow.llm.common import SPACE, partitions
from partflow.session import materialize, materialize_observed

# What came last: nothing, a system row, a user row, an assistant row. The roles' classes have the same numbers.
NONE, S, U, A = range(4)
NEXT = np.array([U, U, A, U])                     # the state that an inserted or reroled row leads to
END = np.array([0, 4, 2, 0])                      # cost of the inserts that finish a conversation ...
TAIL = ["", "ua", "a", ""]                        # ... and those inserts
KEPT = np.full((4, 4), -1)                        # class of a kept row, state before -> state after
KEPT[S, NONE], KEPT[U, [NONE, S, A]], KEPT[A, U] = S, U, A
DELETE, INSERT, KEEP, REROLE = range(1, 5)        # in the order of their initials
NEVER = 1 << 40

STRETCH = 256          # rows of a stretch
CELLS = 1 << 15        # rows that are ranked at once
BLOCK_BITS = 8         # 2^8 rows are one block of a repaired text

# A row's code: class of its role, 4 if it must go, 8 if its text is cut off. Edits of a row, one letter each:
# u, a: insert user, assistant; K keep; D delete; U, A: rerole to user, assistant.
MUST, CUT = 4, 8


def _before(code: np.ndarray, f: np.ndarray) -> np.ndarray:
    """Costs to go (row, state, case) before each row of ``code`` from those after it; inserts before the row included."""
    cls, must, cut = code & 3, (code & MUST) > 0, (code & CUT) // CUT
    to_u = np.where(must, NEVER, cut + 2 * (cls != U))[:, None] + f[:, U]
    to_a = np.where(must, NEVER, cut + 2 * (cls != A))[:, None] + f[:, A]
    to_s = np.where(must | (cls != S), NEVER, cut)[:, None] + f[:, S]
    gone = f + 3
    g0, g1, g3 = np.minimum(np.minimum(gone[:, NONE], to_u), to_s), np.minimum(gone[:, S], to_u), np.minimum(gone[:, A], to_u)
    g2 = np.minimum(gone[:, U], to_a)
    u = np.minimum(g2, 2 + g3)
    return np.minimum(np.stack([np.minimum(g0, 2 + u), np.minimum(g1, 2 + u), u, np.minimum(g3, 2 + g2)], 1), NEVER)


def matrices(codes: np.ndarray) -> np.ndarray:
    """(stretch, state before, state after) -> least cost, of stretches of equal length: one row of codes each."""
    f = np.broadcast_to(np.where(np.eye(4, dtype=bool), 0, NEVER), (len(codes), 4, 4))
    for i in range(codes.shape[1] - 1, -1, -1):
        f = _before(codes[:, i], f)
    return f


def times(m: np.ndarray, f: np.ndarray) -> np.ndarray:
    """Costs to go before stretches with the matrices ``m`` from those after them."""
    return np.minimum((m + f[..., None, :]).min(-1), NEVER)


def _rank(letter: np.ndarray, arc: np.ndarray, goal: np.ndarray) -> np.ndarray:
    """Ranks of nodes by their whole least audits; ``arc`` is the target of the arc with the least letter."""
    rank, jump = letter, arc
    while not goal[jump].all():
        _, rank = np.unique(rank * (rank.max() + 1) + rank[jump], return_inverse=True)
        jump = jump[jump]
    return rank


def walks(codes: np.ndarray, length: np.ndarray, after: np.ndarray, first: np.ndarray, state: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The edits of each row and the state after the stretch, for walks that enter stretch ``first[k]`` in ``state[k]``.

    ``codes`` has a stretch per row, at its right end; ``after`` its costs to go. The rows of all walks are one list.
    """
    n, width = codes.shape
    f = np.empty((n, width + 1, 4), np.int64)
    f[:, width] = after
    for i in range(width - 1, -1, -1):
        f[:, i] = _before(codes[:, i], f[:, i + 1, :, None])[..., 0]
    node = np.arange(f.size).reshape(f.shape)
    cls, must, cut = codes & 3, ((codes & MUST) > 0)[..., None], ((codes & CUT) // CUT)[..., None]
    now, then = f[:, :width], f[:, 1:]
    kept = KEPT[cls]
    # per node and letter: where the arc leads, and whether a cheapest repair may take it
    to = np.stack([node[:, 1:], node[:, :width, NEXT], np.take_along_axis(node[:, 1:], np.maximum(kept, 0), 2), node[:, 1:, NEXT]], -1)
    may = np.stack([then + 3 == now, now[..., NEXT] + 2 == now,
                    (kept >= 0) & ~must & (np.take_along_axis(then, np.maximum(kept, 0), 2) + cut == now),
                    ~must & (then[..., NEXT] + 2 + cut == now)], -1)
    goal = np.zeros(f.shape, bool)
    goal[:, width] = True
    may[now >= NEVER] = [True, False, False, False]       # nodes that no repair comes through
    # a node's arcs have different letters, so its least audit begins with the least of them
    letter, arc = np.zeros(f.shape, np.int64), node.copy()
    least = may.argmax(-1)
    letter[:, :width] = least + 1
    arc[:, :width] = np.take_along_axis(to, least[..., None], -1)[..., 0]
    rank = _rank(letter.ravel(), arc.ravel(), goal.ravel())
    pick = np.where(may, np.arange(1, 5) * (f.size + 1) + rank[to], NEVER * 4).argmin(-1)
    arc[:, :width] = np.take_along_axis(to, pick[..., None], -1)[..., 0]
    # doubled pointers, and the length of the way to the end
    jumps, steps = [arc.ravel()], (~goal).ravel().astype(np.int64)
    while not goal.ravel()[jumps[-1]].all():
        steps = steps + steps[jumps[-1]]
        jumps.append(jumps[-1][jumps[-1]])
    steps = steps + steps[jumps[-1]]
    edit = np.zeros(f.shape, np.uint8)
    is_u = np.broadcast_to(NEXT == U, pick.shape)
    edit[:, :width] = np.select([pick == 0, pick == 1, pick == 2], [ord("D"), np.where(is_u, ord("u"), ord("a")), ord("K")], np.where(is_u, ord("U"), ord("A")))
    start = node[first, width - length[first], state]
    far = steps[start]
    step = np.arange(far.sum()) - np.repeat(np.cumsum(far) - far, far)
    at = np.repeat(start, far)
    for b, jump in enumerate(jumps):
        at = np.where(step >> b & 1, jump[at], at)
    return re.findall("[ua]*[DKUA]", edit.ravel()[at].tobytes().decode()), jumps[-1][start] % 4


def _stretches(n: int, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, run) of the stretches of all runs; ``runs`` has the starts of the runs, and n."""
    size = np.diff(runs)
    k = -(-size // STRETCH)
    run = np.repeat(np.arange(len(size)), k)
    start = runs[run] + (np.arange(len(run)) - np.repeat(np.cumsum(k) - k, k)) * STRETCH
    return start, np.minimum(STRETCH, runs[run + 1] - start), run


def _laid(codes: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    width = int(length.max())
    at = start[:, None] + np.arange(width) - (width - length[:, None])
    return codes[np.maximum(at, 0)]


def _matrix_of(codes: np.ndarray) -> np.ndarray:
    """The matrix of one run of rows."""
    start, length, _ = _stretches(len(codes), np.array([0, len(codes)]))
    full = length == STRETCH
    m = list(matrices(_laid(codes, start[full], length[full]))) if full.any() else []
    if not full.all():
        m += list(matrices(codes[None, start[-1]:]))
    out = m[-1]
    for x in m[-2::-1]:
        out = np.minimum((x[:, :, None] + out[None]).min(1), NEVER)
    return out


def solve(codes: np.ndarray, runs: np.ndarray, last_after: np.ndarray | None, opened: bool) -> tuple[list[list[str]], dict]:
    """Edits of each row of a partition; ``last_after``: costs to go where the last run goes on beyond it, ``opened``: the
    first run began before it. A row of such a run has four strings, one for each state before the run. Also the
    states after the first and the last run by the state before."""
    start, length, run = _stretches(len(codes), runs)
    ends = np.r_[run[1:] != run[:-1], True]
    begins = np.r_[True, ends[:-1]]
    after = np.broadcast_to(END, (len(run), 4)).copy()
    if last_after is not None:
        after[-1] = last_after
    # costs to go between the stretches of long runs, from their ends backwards
    long = np.flatnonzero(~begins)
    if len(long):
        m = np.empty((len(long), 4, 4), np.int64)
        for width in np.unique(length[long]):
            of = length[long] == width
            m[of] = matrices(_laid(codes, start[long[of]], length[long[of]]))
        for k, s in zip(range(len(long) - 1, -1, -1), long[::-1]):
            after[s - 1] = times(m[k], after[s])
    free = ~begins | ((run == 0) & opened)               # stretches whose state before isn't known yet
    edits: list = [None] * len(run)
    leave = np.zeros((len(run), 4), np.int64)
    order = np.argsort(length, kind="stable")
    at = 0
    while at < len(order):
        ahead = length[order[at:at + CELLS]]
        some = order[at:at + max(1, int((ahead * np.arange(1, len(ahead) + 1) <= CELLS).sum()))]
        at += len(some)
        of = np.repeat(np.arange(len(some)), np.where(free[some], 4, 1))
        state = np.concatenate([np.arange(4) if x else [0] for x in free[some]])
        rows, out = walks(_laid(codes, start[some], length[some]), length[some], after[some], of, state)
        leave[some[of], state] = out
        k = 0
        for x, q in zip(some[of], state):
            if q == 0:
                edits[x] = []
            edits[x].append(rows[k:k + length[x]])
            k += length[x]
    result: list[list[str]] = []
    around = {}
    enter = None
    for x in range(len(run)):
        if begins[x]:
            enter = list(range(4)) if run[x] == 0 and opened else [0]
        own = [edits[x][q] for q in enter]
        enter = [int(leave[x, q]) for q in enter]
        if ends[x]:
            if run[x] < run[-1] or last_after is None:
                own = [[*e[:-1], e[-1] + TAIL[q]] for e, q in zip(own, enter)]
            around[int(run[x])] = enter
        result += [list(r) for r in zip(*own)]
    return result, around


def _partition(batches: Iterator[pa.RecordBatch]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, list[dict]]:
    """One partition in order: keys of its runs, their starts, codes and places of the rows, and the notes on its ends."""
    keys, runs, codes, at, notes, n = [], [], [], [], [], 0
    for b in batches:
        key, c = b.column(0), b.column(2).to_numpy(zero_copy_only=False)
        for k in np.flatnonzero(c < 0):
            notes.append({"key": key[int(k)].as_py(), "after": b.column(3)[int(k)].as_py(), "last": b.column(4)[int(k)].as_py()})
        key, c, places = key.filter(pa.array(c >= 0)), c[c >= 0], b.column(1).to_numpy()[c >= 0]
        if not len(c):
            continue
        e = key.dictionary_encode()
        ids = np.asarray(e.indices)
        new = np.flatnonzero(np.r_[not keys or keys[-1] != key[0].as_py(), ids[1:] != ids[:-1]])
        keys += key.take(pa.array(new)).to_pylist()
        runs += (new + n).tolist()
        codes.append(c.astype(np.int64))
        at.append(places)
        n += len(c)
    return keys, np.array([*runs, n]), np.concatenate(codes or [np.zeros(0, np.int64)]), np.concatenate(at or [np.zeros(0, np.int64)]), notes


_CUT_SCHEMA = "key string, part long, m array<long>, first int, last int"


def _borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a partition's first and last conversation: the matrix of its rows here, the classes of their first and last role."""
    keys, runs, codes, at, _ = _partition(batches)
    if keys:
        some = [0, len(keys) - 1] if len(keys) > 1 else [0]
        own = [codes[runs[k]:runs[k + 1]] for k in some]
        yield pa.RecordBatch.from_pydict({
            "key": [keys[k] for k in some], "part": pa.array([int(at[0]) >> 33] * len(some), pa.int64()),
            "m": pa.array([_matrix_of(c).ravel().tolist() for c in own], pa.list_(pa.int64())),
            "first": pa.array([int(c[0] & 3) for c in own], pa.int32()), "last": pa.array([int(c[-1] & 3) for c in own], pa.int32())})


def _across(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of a conversation in several partitions: the costs to go after each (null: it ends there) and the class before (-1: none)."""
    pdf = pdf.sort_values("part")
    f, after = END, []
    for m in reversed(pdf["m"].tolist()):
        after.append([int(x) for x in f])
        f = times(np.asarray(m, np.int64).reshape(4, 4), f)
    after[0] = None
    out = pdf[["key", "part"]].assign(after=after[::-1], last=[-1, *pdf["last"].tolist()[:-1]])
    return out if len(out) > 1 else out.iloc[:0]


def _states(pdf: pd.DataFrame) -> pd.DataFrame:
    """(part, state): what came last before each later partition of a conversation."""
    pdf, state, rows = pdf.sort_values("part"), 0, []
    for part, leave in zip(pdf["part"], pdf["leave"]):
        rows.append((part, state))
        state = int(leave[state if len(leave) == 4 else 0])
    return pd.DataFrame(rows[1:], columns=["part", "state"])


_WALK_SCHEMA = "at long, edits array<string>, illegal boolean, key string, part long, leave array<int>"


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys, runs, codes, at, notes = _partition(batches)
    if not keys:
        return
    # a conversation that is cut by both ends of the partition is its only one
    on = next((x for x in notes if x["key"] == keys[-1] and x["after"] is not None), None)
    back = next((x for x in notes if x["key"] == keys[0] and x["last"] >= 0), None)
    edits, leave = solve(codes, runs, np.array(on["after"]) if on else None, back is not None)
    cls = codes & 3
    legal = np.zeros((4, 4), bool)
    legal[[S, U, A], [U, A, U]] = True
    bad = np.r_[False, ~legal[cls[:-1], cls[1:]]]
    bad[runs[:-1]] = False
    if back:
        bad[0] = not legal[back["last"], cls[0]]
    names = [f.split()[0] for f in _WALK_SCHEMA.split(", ")]
    for lo in range(0, len(codes), 8192):
        own = edits[lo:lo + 8192]
        none = pa.nulls(len(own))
        yield pa.RecordBatch.from_arrays([pa.array(at[lo:lo + 8192]), pa.array(own, pa.list_(pa.string())), pa.array(bad[lo:lo + 8192]),
                                          none.cast(pa.string()), none.cast(pa.int64()), none.cast(pa.list_(pa.int32()))], names)
    cut = sorted({0} if back else set()) + ([len(keys) - 1] if on and not (back and len(keys) == 1) else [])
    if cut:
        none = pa.nulls(len(cut))
        yield pa.RecordBatch.from_arrays([none.cast(pa.int64()), none.cast(pa.list_(pa.string())), none.cast(pa.bool_()),
                                          pa.array([keys[k] for k in cut], pa.string()), pa.array([int(at[0]) >> 33] * len(cut), pa.int64()),
                                          pa.array([leave[k] for k in cut], pa.list_(pa.int32()))], names)


def damage(convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The rows with faults by the crc32 of ``conversation:turn`` by 20: 0 drops the row, 1 empties the text, 2 takes its
    final marks, 3 repeats the row, 4 makes the role user. Nulls in role, text and the hashed key: one space."""
    text_or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))       # noqa: E731
    h = F.crc32(F.concat_ws(":", text_or_space(conv_col), text_or_space(turn_col)).cast("binary")) % 20
    rows = convs.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), text_or_space(role_col).alias("role"),
                        text_or_space(text_col).alias("text"), h.alias("_h")).where("_h <> 0")
    text = F.when(F.col("_h") == 1, "").when(F.col("_h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("_h") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.explode(F.when(F.col("_h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_k")).drop("_k")


def _class(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first == "s", S).when(first == "u", U).when(first == "a", A).otherwise(NONE)


def repair(convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Every row with its faults and edits: (conv_id, turn, role, text, at, blank, duplicate, truncated, illegal, edits, cost).

    ``at`` orders the rows; ``illegal``: the row doesn't follow the role before it; ``edits`` has a letter per edit, the
    row's own and those of rows inserted before it (after the last row: behind it). See the module for odd rows.
    """
    spark = convs.sparkSession
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))               # noqa: E731
    rows = convs.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), space(role_col).alias("role"), space(text_col).alias("text"))
    rows = rows.withColumn("_head", F.substring("text", 1, 64)).withColumn("_sum", F.md5("text")).withColumn("_id", F.monotonically_increasing_id())
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "_head", "_sum", "_id"]
    rows = rows.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    # partition and row number in one: rows in order, a partition the numbers of one 2^33
    rows, seen = materialize_observed(rows.withColumn("at", F.monotonically_increasing_id()).drop("_head", "_id"), "turns",
                                      parts=F.max(F.shiftright("at", 33)))
    n = int(seen["parts"] or 0) + 1
    ends = F.rtrim(F.col("text"), F.lit(SPACE))
    firsts = rows.groupBy("conv_id", "role", "_sum").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    marks = rows.select("conv_id", "at", _class(F.col("role")).alias("cls"), (ends == "").alias("blank"),
                        (~F.right(ends, F.lit(1)).isin(".", "!", "?")).alias("open")).join(firsts, "at", "left")
    blank, again = F.col("blank"), F.col("first").isNull()
    code = F.col("cls") + F.when(blank | again, MUST).when(F.col("open"), CUT).otherwise(0)
    key = F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit(""))
    marks = materialize(marks.select(key.alias("key"), "at", code.cast("int").alias("code"), "blank", (~blank & again).alias("duplicate"),
                                     (~blank & ~again & F.col("open")).alias("truncated")), "turn-marks")
    none = [F.lit(None).cast("array<long>").alias("after"), F.lit(None).cast("int").alias("last")]
    slim = marks.select("key", "at", "code", *none)

    def laid(df: DataFrame) -> DataFrame:
        part = F.shiftright("at", 33).cast("int")
        return df.repartitionById(n, part).sortWithinPartitions("at", "code")

    # conversations that are cut by a partition's ends: two rows a partition
    cut = laid(slim).mapInArrow(_borders, _CUT_SCHEMA)
    cut = cut.groupBy("key").applyInPandas(_across, "key string, part long, after array<long>, last int")
    notes = materialize(cut, "turn-borders").select("key", F.shiftleft("part", 33).alias("at"), F.lit(-1).alias("code"), "after", "last")
    walked = materialize(laid(slim.union(notes)).mapInArrow(_walked, _WALK_SCHEMA), "turn-walks")
    states = walked.where("key is not null").select("key", "part", "leave").groupBy("key").applyInPandas(_states, "part long, state int")
    chosen = walked.where("at is not null").select("at", "edits", "illegal", F.shiftright("at", 33).alias("part"))
    chosen = chosen.join(F.broadcast(states), "part", "left")       # a row per partition at most
    edits = F.when(F.size("edits") == 4, F.get("edits", F.col("state"))).otherwise(F.get("edits", F.lit(0)))
    chosen = chosen.select("at", "illegal", edits.alias("edits"))
    out = rows.drop("_sum").join(marks.drop("key", "code"), "at").join(chosen, "at")
    gone = F.contains("edits", F.lit("D"))
    cost = F.when(gone, 3).otherwise(2 * F.col("edits").rlike("[UA]").cast("int") + F.col("truncated").cast("int")) + 2 * (F.length("edits") - 1)
    return materialize(out.select("conv_id", "turn", "role", "text", "at", "blank", "duplicate", "truncated", "illegal", "edits", cost.cast("long").alias("cost")), "repaired")


def edit_rows(repaired: DataFrame) -> DataFrame:
    """A row per edit: (conv_id, at, k, edit, role, text) in order of at and k; role and text are null where a row is deleted."""
    e = repaired.select("*", F.posexplode(F.regexp_extract_all("edits", F.lit("."), F.lit(0))).alias("k", "_e"))
    own, c = F.col("_e").isin("K", "U", "A"), F.col("_e")
    return e.select("conv_id", "at", "k", F.when(c.isin("u", "a"), "I").when(c.isin("U", "A"), "R").otherwise(c).alias("edit"),
                    F.when(c.isin("u", "U"), "user").when(c.isin("a", "A"), "assistant").when(c == "K", F.col("role")).alias("role"),
                    F.when(own, F.col("text")).when(c.isin("u", "a"), "").alias("text"))


def report(repaired: DataFrame) -> DataFrame:
    """Per conversation: gaps in the turns, rows of each fault, adjacent roles that don't fit, cost of the repair."""
    gaps = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    return repaired.groupBy("conv_id").agg(F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"), *[
        F.sum(F.col(c).cast("long")).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")], F.sum("cost").alias("cost"))


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, digest, any_line, audit, rows = None, None, False, [], []

    def close() -> None:
        rows.append((held[0], "".join(audit), digest.hexdigest()))

    def out() -> pa.RecordBatch:
        ids, audits, sums = zip(*rows)
        rows.clear()
        return pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(audits, pa.string()), pa.array(sums, pa.string())], ["conv_id", "audit", "sha256"])

    for b in batches:
        kind = b.schema.field(0).type
        for r in range(b.num_rows):
            conv = b.column(0)[r].as_py()
            if held is None or held[0] != conv:
                if held is not None:
                    close()
                held, digest, any_line, audit = (conv,), hashlib.sha256(), False, []
            audit.append(b.column(2)[r].as_py())
            block = b.column(3)[r].as_py()
            if block is not None:
                digest.update(("\n" if any_line else "").encode() + block.encode())
                any_line = True
        if len(rows) >= 10_000:
            yield out()
    if held is not None:
        close()
        yield out()


def audits(repaired: DataFrame) -> DataFrame:
    """(conv_id, audit, sha256): the edits' initials and the digest of the repaired ``role:text`` lines.

    Blocks of 256 rows are put together anywhere; a conversation's blocks then pass through one task in order, one
    at a time, since a digest can't be taken in parts.
    """
    e = edit_rows(repaired).select("conv_id", F.shiftright("at", BLOCK_BITS).alias("block"), F.struct(
        "at", "k", "edit", F.concat_ws(":", "role", "text").alias("line"), F.col("role").isNotNull().alias("stays")).alias("e"))
    b = e.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list("e")).alias("es"))
    lines = F.transform(F.filter("es", lambda x: x["stays"]), lambda x: x["line"])
    b = b.select("conv_id", "block", F.array_join(F.transform("es", lambda x: x["edit"]), "").alias("audit"),
                 F.when(F.size(lines) > 0, F.array_join(lines, "\n")).alias("lines"))
    b = b.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "block")
    kind = repaired.schema["conv_id"].dataType.simpleString()
    return b.mapInArrow(_folded, f"conv_id {kind}, audit string, sha256 string")
