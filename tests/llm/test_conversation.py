import hashlib
import random
import re
import sys
import zlib
from functools import lru_cache

import numpy as np
import pytest

from partflow.llm import conversation as cv
from partflow.llm import queries
from partflow.llm.common import ship

sys.setrecursionlimit(20_000)
FITS = re.compile("(s?(ua)+)?")


def brute_repair(rows):
    """(cost, audit, lines) of the least repair of (role, text, must go, cut off) rows, by trying every edit."""
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def least(i, last, room):
        best = (0, "", ()) if i == len(rows) and last in ("", "a") else None

        def offer(cost, letter, line, rest):
            nonlocal best
            if rest is not None:
                c = (cost + rest[0], letter + rest[1], ((line,) if line is not None else ()) + rest[2])
                if best is None or c[:2] < best[:2]:
                    best = c

        def after(initial):
            return initial if initial and initial in follows[last] else None

        if room:
            for role in ("user", "assistant"):
                to = after(role[0])
                if to:
                    offer(2, "I", (role, ""), least(i, to, room - 1))
        if i < len(rows):
            role, text, must, cut = rows[i]
            offer(3, "D", None, least(i + 1, last, 3))
            if not must:
                to = after(role[:1])
                if to:
                    offer(cut, "K", (role, text), least(i + 1, to, 3))
                for new in ("user", "assistant"):
                    to = after(new[0])
                    if to:
                        offer(2 + cut, "R", (new, text), least(i + 1, to, 3))
        return best

    return least(0, "", 3)


def expected(convs):
    """What the query returns, by plain loops."""
    by = {}
    for conv, turn, role, text in convs:
        by.setdefault(conv, [])
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        by[conv] += [(turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    out = {}
    for conv, rows in by.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64], hashlib.md5(r[2].encode()).hexdigest()))
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, marked, n = set(), [], {"b": 0, "d": 0, "t": 0}
        for _, role, text in rows:
            chars = re.sub("[\x20\x09-\x0d]", "", text)
            fault = "b" if not chars else "d" if (role, text) in seen else "t" if chars[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                n[fault] += 1
            marked.append((role, text, fault in ("b", "d") and fault != "", fault == "t"))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, lines = brute_repair(marked)
        assert FITS.fullmatch("".join(r[0] for r, _ in lines))
        out[conv] = (gaps, n["b"], n["d"], n["t"], illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest())
    return out


def result(rows):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in rows}


def some_rows(rnd, conv, n, null=0.0):
    roles = ["system", "user", "assistant", "tool", "", "usher"]
    out = []
    for t in range(n):
        role = rnd.choice(roles[:3] if rnd.random() < 0.9 else roles) if rnd.random() > null else None
        text = rnd.choice(["Yes.", "no", "a b!", " \t", "so? ", "x.\n", "", " "]) + (str(rnd.randint(0, 5)) + "." if rnd.random() < 0.6 else "")
        out.append((conv, None if rnd.random() < null else t + 3 * (rnd.random() < 0.1), role, None if rnd.random() < null else text))
    return out


@pytest.mark.parametrize("stretch, cells", [(256, 1 << 15), (3, 8), (1, 1)])
def test_solve_against_trying_all(monkeypatch, stretch, cells):
    monkeypatch.setattr(cv, "STRETCH", stretch)
    monkeypatch.setattr(cv, "CELLS", cells)
    rnd = random.Random(stretch)
    classes = {"s": cv.S, "u": cv.U, "a": cv.A, "x": 0}
    convs = [[(rnd.choice("suax"), "t", rnd.random() < 0.2, rnd.random() < 0.3) for _ in range(rnd.randint(1, 12))] for _ in range(150)]
    codes = np.array([classes[r] + (cv.MUST if m else cv.CUT if c else 0) for x in convs for r, _, m, c in x])
    runs = np.r_[0, np.cumsum([len(x) for x in convs])]
    edits, _ = cv.solve(codes, runs, None, False)
    letters = str.maketrans("uaUA", "IIRR")
    for k, x in enumerate(convs):
        cost, audit, _ = brute_repair([(r, t, m, c and not m) for r, t, m, c in x])
        got = "".join(e[0] for e in edits[runs[k]:runs[k + 1]])
        assert got.translate(letters) == audit
        assert cost == sum({"D": 3, "K": 0, "u": 2, "a": 2, "U": 2, "A": 2}[e] for e in got) + sum(
            c and not m and "D" not in e[0] for (_, _, m, c), e in zip(x, edits[runs[k]:runs[k + 1]]))


def test_query_against_brute_force(spark, tmp_path):
    ship(spark)
    rnd = random.Random(4)
    rows = [r for conv in range(150) for r in some_rows(rnd, conv, rnd.randint(1, 9))]
    rows += [r for conv in range(150, 170) for r in some_rows(rnd, conv, 6, 0.3)] + some_rows(rnd, None, 7) + rows[:9]
    rows += [(900, None, "user", "Same.")] * 9 + [(901, 5, "assistant", "long " * 50_000 + "!")]
    # one with a third of all rows: it spans partitions
    rows += some_rows(rnd, 950, 400)
    rnd.shuffle(rows)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, key string, code int")
    df.repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.QUERIES["op11_conversation_repair"](spark, str(tmp_path)).collect()
    assert len(got) == len({r[0] for r in rows})
    assert result(got) == expected(rows)


def test_dropped_rows_and_empty_table(spark, tmp_path):
    ship(spark)
    gone = next(c for c in range(10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    schema = "conv_id long, turn long, role string, text string"
    spark.createDataFrame([(gone, 0, "user", "Hi.")], schema).write.parquet(f"{tmp_path}/a/conversations.parquet")
    got = queries.QUERIES["op11_conversation_repair"](spark, f"{tmp_path}/a").collect()
    assert result(got) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/b/conversations.parquet")
    assert queries.QUERIES["op11_conversation_repair"](spark, f"{tmp_path}/b").collect() == []


def test_edit_rows_are_the_repaired_conversation(spark):
    ship(spark)
    rows = [(1, 0, "user", "One."), (1, 1, "user", "Two."), (1, 2, "assistant", "Three"), (1, 3, "system", "Four.")]
    out = cv.edit_rows(cv.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    got = [(r.edit, r.role, r.text) for r in out.orderBy("at", "k").collect()]
    assert got == [("K", "user", "One."), ("I", "assistant", ""), ("K", "user", "Two."), ("K", "assistant", "Three"), ("D", None, None)]
