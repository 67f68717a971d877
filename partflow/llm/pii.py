"""Personal data: fixed patterns, and a character tagger trained from labelled spans.

The tagger is a bidirectional LSTM over characters with a linear-chain CRF on top, written and trained
in numpy. Its labelled spans are the pattern matches of a bounded sample of the corpus and generated
ones put into corpus text. It reads overlapping windows around each digit and at sign: a
span of any kind holds one, so text without them can have no span. Each window is decoded by
itself; the spans of all windows of a text are then reconciled over the whole text: pattern matches stay, and of the others the
best-scored set without overlaps is added, if they also pass the checks of their kind.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ["email", "ip", "card", "phone"]
TAGS = ["O", *(f"{x}-{k}" for k in KINDS for x in "BI")]
WINDOW, STRIDE, REACH = 64, 32, 24      # characters of a window, between windows, and read around a digit or at sign
HIDDEN = 16
SAMPLE = 3000                           # most windows of the corpus that the tagger is fitted on
LEAST = 0.5                             # least probability of each character's tag in an added span

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SEED = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def digits_of(s: str) -> str:
    return re.sub("[^0-9]", "", s)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the pattern matches, in that order; time linear in the text."""
    out = []
    if "@" in text:
        done, before, at = 0, 0, text.find("@")
        while at >= 0:
            low = max(done, before)
            start = low + len(text[low:at].rstrip(_LOCAL))
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                out.append((0, start, m.end()))
                done = m.end()
            before = at + 1
            at = text.find("@", max(before, done))
    if re.search("[0-9]", text):
        out += [(1, m.start(), m.end()) for m in _IP.finditer(text)
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[:3] or 0) <= 255 for p in m[0].split("."))]
        out += [(2, m.start(), m.end()) for m in _CARD.finditer(text) if 16 <= len(d := digits_of(m[0])) <= 19 and luhn(d)]
        out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(digits_of(m[0])) <= 15]
    return out


def allowed(kind: int, s: str) -> bool:
    """Whether text that the tagger proposes can be of the kind."""
    d = digits_of(s)
    if kind == 0:
        return bool(re.fullmatch(r"[^\s@]+@[^\s@.]+(\.[^\s@.]+)+", s))
    if kind == 1:
        return bool(re.fullmatch(r"[0-9]{1,3}(\.[0-9]{1,3}){3}", s)) and all(int(p) <= 255 for p in s.split("."))
    if kind == 2:
        return bool(re.fullmatch(r"[0-9](?:[ .-]?[0-9])+", s)) and 16 <= len(d) <= 19 and luhn(d)
    return bool(re.fullmatch(r"[+(]?[0-9][0-9 ().-]*[0-9]", s)) and 8 <= len(d) <= 15 and len(re.findall(r"[ ().-]+", s)) >= 2 \
        and bool(re.search(r"[(+]|[0-9]-[0-9]", s))


def codes(text: str) -> np.ndarray:
    """Class of each character: 0 is none, ASCII its own, then other letters, other digits, other signs."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    far = np.flatnonzero(c >= 128)
    out = c + 1
    for k in far:
        ch = chr(c[k])
        out[k] = 129 if ch.isalpha() else 130 if ch.isdigit() else 131
    return out


CLASSES = 132


def windows_of(text: str) -> list[tuple[int, int]]:
    """Overlapping windows over the stretches around digits and at signs."""
    out, low, high = [], None, 0
    for m in _SEED.finditer(text):
        a, b = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if low is None or a > high:
            if low is not None:
                out += _cut(low, high)
            low = a
        high = b
    return out + _cut(low, high) if low is not None else out


def _cut(low: int, high: int) -> list[tuple[int, int]]:
    starts = list(range(low, max(low, high - WINDOW) + 1, STRIDE))
    if starts[-1] + WINDOW < high:
        starts.append(high - WINDOW)
    return [(s, min(s + WINDOW, high)) for s in starts]


class Tagger:
    """Bidirectional LSTM with a CRF; all arrays in ``self.w``."""

    def __init__(self, seed: int = 7, hidden: int = HIDDEN):
        g, n = np.random.default_rng(seed), len(TAGS)
        f = lambda *s: (g.standard_normal(s) * 0.1).astype(np.float32)         # noqa: E731
        self.w = {k + d: v for d in "fb" for k, v in (("x", f(CLASSES, 4 * hidden)), ("u", f(hidden, 4 * hidden)))}
        for d in "fb":
            self.w["x" + d][:, hidden:2 * hidden] += 0.5                        # forget gates begin open
        self.w |= {"e": f(2 * hidden, n), "eb": f(n), "t": f(n, n), "s": f(n)}
        self.h = hidden
        # an inside tag only follows a begin or inside tag of its kind
        self.ban = np.zeros((n, n), np.float32)
        for j, tag in enumerate(TAGS):
            if tag[0] == "I":
                for i, b in enumerate(TAGS):
                    if b == "O" or b[2:] != tag[2:]:
                        self.ban[i, j] = -1e4
        self.ban0 = np.array([-1e4 if t[0] == "I" else 0 for t in TAGS], np.float32)

    def _lstm(self, x, d):
        """x (T, N) -> hidden states (T, N, h) and what the way back needs."""
        t, n, h = len(x), x.shape[1], self.h
        hs, cs, gs = np.zeros((t + 1, n, h), np.float32), np.zeros((t + 1, n, h), np.float32), np.zeros((t, n, 4 * h), np.float32)
        for k in range(t):
            z = self.w["x" + d][x[k]] + hs[k] @ self.w["u" + d]
            z[:, :3 * h] = 1 / (1 + np.exp(-np.clip(z[:, :3 * h], -30, 30)))
            z[:, 3 * h:] = np.tanh(z[:, 3 * h:])
            i, f, o, c = z[:, :h], z[:, h:2 * h], z[:, 2 * h:3 * h], z[:, 3 * h:]
            cs[k + 1] = f * cs[k] + i * c
            hs[k + 1] = o * np.tanh(cs[k + 1])
            gs[k] = z
        return hs, cs, gs

    def emissions(self, x):
        f, b = self._lstm(x, "f"), self._lstm(x[::-1], "b")
        both = np.concatenate((f[0][1:], b[0][1:][::-1]), 2)
        return both @ self.w["e"] + self.w["eb"], both, f, b

    def _sums(self, em, mask):
        """Log forward and backward sums (T, N, tags)."""
        t = self.w["t"] + self.ban
        a, b = np.zeros_like(em), np.zeros_like(em)
        a[0] = self.w["s"] + self.ban0 + em[0]
        for k in range(1, len(em)):
            nxt = _lse(a[k - 1][:, :, None] + t[None], 1) + em[k]
            a[k] = np.where(mask[k][:, None], nxt, a[k - 1])
        for k in range(len(em) - 2, -1, -1):
            nxt = _lse(t[None] + (em[k + 1] + b[k + 1])[:, None, :], 2)
            b[k] = np.where(mask[k + 1][:, None], nxt, b[k + 1])
        return a, b

    def step(self, x, y, mask):
        """Loss and gradients of a batch; x, y, mask (T, N)."""
        t, n = x.shape
        em, both, f, b = self.emissions(x)
        al, be = self._sums(em, mask)
        z = _lse(al[-1], 1)
        tr = self.w["t"] + self.ban
        p = np.exp(al + be - z[None, :, None]) * mask[:, :, None]
        gold = np.eye(len(TAGS), dtype=np.float32)[y] * mask[:, :, None]
        de = (p - gold) / n
        g = {"s": (p[0] - gold[0]).sum(0) / n, "t": np.zeros_like(tr)}
        loss = z.sum() - (em * gold).sum() - (self.w["s"] * gold[0]).sum()
        for k in range(1, t):
            pair = np.exp(al[k - 1][:, :, None] + tr[None] + (em[k] + be[k])[:, None, :] - z[:, None, None]) * mask[k][:, None, None]
            g["t"] += (pair.sum(0) - gold[k - 1].T @ gold[k]) / n
            loss -= (tr[y[k - 1], y[k]] * mask[k]).sum()
        g["eb"], g["e"] = de.sum((0, 1)), np.einsum("tnh,tnk->hk", both, de, optimize=True)
        dh = de @ self.w["e"].T
        for d, (hs, cs, gs), grad, xs in (("f", f, dh[:, :, :self.h], x), ("b", b, dh[::-1, :, self.h:], x[::-1])):
            g["x" + d], g["u" + d] = self._back(d, hs, cs, gs, grad, xs)
        return loss / n, g

    def _back(self, d, hs, cs, gs, grad, x):
        h, u = self.h, self.w["u" + d]
        gx, gu = np.zeros_like(self.w["x" + d]), np.zeros_like(u)
        dh, dc = np.zeros_like(hs[0]), np.zeros_like(hs[0])
        for k in range(len(gs) - 1, -1, -1):
            z = gs[k]
            i, f, o, c = z[:, :h], z[:, h:2 * h], z[:, 2 * h:3 * h], z[:, 3 * h:]
            dh = dh + grad[k]
            tc = np.tanh(cs[k + 1])
            dc = dc + dh * o * (1 - tc * tc)
            dz = np.concatenate((dc * c * i * (1 - i), dc * cs[k] * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - c * c)), 1)
            gu += hs[k].T @ dz
            np.add.at(gx, x[k], dz)
            dh, dc = dz @ u.T, dc * f
        return gx, gu

    def fit(self, texts: list[tuple[str, list[tuple[int, int, int]]]], steps: int = 400, batch: int = 48, seed: int = 7):
        """Adam on random batches of (text of at most a window, spans); the same examples give the same weights."""
        rng = np.random.default_rng(seed)
        x = np.zeros((WINDOW, len(texts)), np.int64)
        y, mask = np.zeros_like(x), np.zeros(x.shape, bool)
        for k, (text, spans) in enumerate(texts):
            c = codes(text)
            x[:len(c), k], mask[:len(c), k] = c, True
            for kind, a, b in spans:
                y[a:b, k] = 2 * kind + 2
                y[a, k] = 2 * kind + 1
        m1, m2 = ({k: np.zeros_like(v) for k, v in self.w.items()} for _ in range(2))
        for i in range(1, steps + 1):
            at = rng.integers(0, len(texts), batch)
            self.loss, g = self.step(x[:, at], y[:, at], mask[:, at])
            norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
            rate = 0.02 * min(1, 3 * (1 - i / (steps + 1)))
            for k, v in g.items():
                v = v * min(1, 5 / (norm + 1e-9))
                m1[k] = 0.9 * m1[k] + 0.1 * v
                m2[k] = 0.99 * m2[k] + 0.01 * v * v
                self.w[k] = (self.w[k] - rate * (m1[k] / (1 - 0.9 ** i)) / (np.sqrt(m2[k] / (1 - 0.99 ** i)) + 1e-7)).astype(np.float32)
        return self

    def decode(self, texts: list[str]) -> list[list[tuple[int, int, int, float]]]:
        """(kind, start, end, least tag probability) of the best tag sequence of each window."""
        t, n = max(WINDOW, *map(len, texts)), len(texts)       # as in fitting: what a window gives doesn't depend on its batch
        x, mask = np.zeros((t, n), np.int64), np.zeros((t, n), bool)
        for k, s in enumerate(texts):
            c = codes(s)
            x[:len(c), k], mask[:len(c), k] = c, True
        em = self.emissions(x)[0]
        al, be = self._sums(em, mask)
        p = np.exp(al + be - _lse(al[-1], 1)[None, :, None])
        tr = self.w["t"] + self.ban
        score, back = self.w["s"] + self.ban0 + em[0], np.zeros((t, n, len(TAGS)), np.int8)
        for k in range(1, t):
            cand = score[:, :, None] + tr[None]
            back[k] = np.where(mask[k][:, None], cand.argmax(1), np.arange(len(TAGS)))
            score = np.where(mask[k][:, None], cand.max(1) + em[k], score)
        tags = np.zeros((t, n), np.int64)
        tags[-1] = score.argmax(1)
        for k in range(t - 1, 0, -1):
            tags[k - 1] = back[k][np.arange(n), tags[k]]
        out = []
        for k, s in enumerate(texts):
            own, found, i = tags[:len(s), k], [], 0
            while i < len(s):
                if own[i] % 2:
                    e = i + 1
                    while e < len(s) and own[e] == own[i] + 1:
                        e += 1
                    found.append((int(own[i]) // 2, i, e, float(p[np.arange(i, e), k, own[i:e]].min())))
                    i = e
                else:
                    i += 1
            out.append(found)
        return out


def _lse(a, axis):
    m = a.max(axis, keepdims=True)
    return (m + np.log(np.exp(a - m).sum(axis, keepdims=True))).squeeze(axis)


def examples(rng, texts: list[str], n: int) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Generated labelled spans of each kind, in more forms than the patterns know, put into texts; digits that are none of them too."""
    d = lambda k: "".join(map(str, rng.integers(0, 10, k)))                      # noqa: E731
    pick = lambda *a: a[rng.integers(0, len(a))]                                 # noqa: E731

    def name():
        return "".join(pick(*"abcdefghilmnoprstuvz") for _ in range(rng.integers(3, 9)))

    def card():
        first = pick("37", d(1), d(1)) + d(14)
        body = first[:15]
        body += next(c for c in "0123456789" if luhn(body + c))
        return pick(body, " ".join(re.findall("....", body)), "-".join(re.findall("....", body)), ".".join(re.findall("....", body)))

    def phone():
        c, a, e, f = d(pick(1, 2)), d(3), d(3), d(4)
        return pick(f"+{c} ({a}) {e}-{f}", f"+{c} {a} {e} {f}", f"({a}) {e}-{f}", f"+{c}-{a}-{e}-{f}", f"{a}-{e}-{f}", f"+{c}{a}{e}{f}")

    make = [lambda: f"{name()}{pick('', '.', '_', '-', d(2))}{pick('', name(), d(2))}@{name()}{pick('', d(1), '.' + name())}.{pick('com', 'org', 'net', 'de', 'fr')}",
            lambda: ".".join(str(v) for v in rng.integers(0, 256, 4)), card, phone]
    none = [lambda: d(rng.integers(1, 8)), lambda: f"{d(1)}.{d(1)}", lambda: f"{d(4)}-{d(2)}-{d(2)}", lambda: f"{name()}@ {name()}", lambda: "@" + name(),
            lambda: f"{d(1)},{d(3)}.{d(2)}", lambda: f"{d(2)}:{d(2)}", lambda: f"{d(3)}.{d(3)}.{d(1)}"]
    out = []
    for _ in range(n):
        t = texts[rng.integers(0, len(texts))] if texts else " ".join(name() for _ in range(9))
        t = re.sub("[0-9@]", "", t)
        kind = int(rng.integers(0, 5))
        s = make[kind]() if kind < 4 else pick(*none)()
        own = [(kind, 0, len(s))] if kind < 4 else []
        if kind in (1, 2, 3) and rng.integers(0, 2):
            # a span or number right beside it: a pattern that reads on over both finds neither
            k = int(pick(1, 2, 2, 3, 4))
            o = make[k]() if k < 4 else d(rng.integers(1, 8))
            if len(s) + len(o) + 1 <= WINDOW - 8:
                first, second = pick(((kind, s), (k, o)), ((k, o), (kind, s)))
                s = f"{first[1]} {second[1]}"
                own = [x for x in ((first[0], 0, len(first[1])), (second[0], len(first[1]) + 1, len(s))) if x[0] < 4]
        at = int(rng.integers(0, max(1, min(len(t), WINDOW - len(s)))))
        at = t.rfind(" ", 0, at) + 1
        text = (t[:at] + s + pick(" ", ", ", ". ", "\n", "%% ", "!! ") + t[at:])[:WINDOW]
        out.append((text, [(k, at + a, at + b) for k, a, b in own if at + b <= len(text)]))
    return out


def unmatched(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Runs as long as a card or phone that are no match of theirs: two spans side by side may be in one."""
    known = {(s, e) for _, s, e in spans}
    return [m.span() for p, n in ((_CARD, 16), (_PHONE, 8)) for m in p.finditer(text) if m.span() not in known and len(digits_of(m[0])) >= n]


def sample(docs: DataFrame, text_col: str = "text", most: int = SAMPLE) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """At most ``most`` windows of the corpus with their pattern matches, chosen by hash: up to two of all windows of a text, and its beginning."""
    def cut(batches):
        for batch in batches:
            out = []
            for x in batch.column(0):
                text = x.as_py()
                spans = base_spans(text)
                runs = unmatched(text, spans)
                some = sorted(windows_of(text), key=lambda w: hashlib.md5(text[w[0]:w[1]].encode("utf-8", "replace")).digest())[:2] + [(0, min(len(text), WINDOW))]
                for a, b in some:
                    own = [(k, s - a, e - a) for k, s, e in spans if a <= s and e <= b]
                    # a window that cuts a match would teach half of it
                    # and one with a run that may hide spans would teach that it has none
                    if b > a and not any(s < b and e > a for s, e in runs) and not any(s < b and e > a and not (a <= s and e <= b) for _, s, e in spans):
                        w = text[a:b]
                        out.append((hashlib.md5(w.encode("utf-8", "replace")).hexdigest(), w, ",".join(f"{k}:{s}:{e}" for k, s, e in _apart(own))))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.string()) for i in range(3)], names=["h", "w", "spans"])

    rows = (docs.select(F.col(text_col).alias("t")).where(F.col("t").isNotNull()).mapInArrow(cut, "h string, w string, spans string")
            .distinct().orderBy("h").limit(most).collect())
    return [(r.w, [tuple(map(int, s.split(":"))) for s in r.spans.split(",") if s]) for r in rows]


def _apart(spans):
    """Spans without those that overlap an earlier kind's."""
    out = []
    for k, s, e in spans:
        if all(e <= a or s >= b for _, a, b in out):
            out.append((k, s, e))
    return out


def train(docs: DataFrame, text_col: str = "text", most: int = SAMPLE, steps: int = 400) -> Tagger:
    """A tagger for a corpus; needs no labelled text besides. The same table gives the same tagger."""
    real = sample(docs, text_col, most)
    made = examples(np.random.default_rng(11), [w for w, _ in real], 3000)
    return Tagger().fit([x for x in real if x[1]] * 2 + real + made, steps)


def reconcile(base: list[tuple[int, int, int]], proposed: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int]]:
    """The pattern matches and the best-scored set of proposed spans that overlap neither them nor each other."""
    taken = sorted((s, e) for _, s, e in base)
    best: dict[tuple[int, int, int], float] = {}
    for k, s, e, p in proposed:
        if not any(a < e and b > s for a, b in taken):
            best[k, s, e] = max(p, best.get((k, s, e), 0))
    spans = sorted(best, key=lambda x: (x[2], x[1], x[0]))
    ends, total, choice = [x[2] for x in spans], [0.0], []
    for i, (k, s, e) in enumerate(spans):
        j = bisect_right(ends, s, 0, i)
        # a longer span counts for more
        with_it = total[j] + best[k, s, e] * (e - s)
        choice.append(j if with_it > total[i] else None)
        total.append(max(with_it, total[i]))
    out, i = [], len(spans)
    while i:
        if choice[i - 1] is None:
            i -= 1
        else:
            out.append(spans[i - 1])
            i = choice[i - 1]
    return sorted([*base, *out])


def find_all(tagger: Tagger, texts: list[str], least: float = LEAST, per_call: int = 512) -> list[tuple[list, list]]:
    """(pattern matches, all spans) of each whole text."""
    base = [base_spans(t) for t in texts]
    todo = [(i, a, b) for i, t in enumerate(texts) for a, b in windows_of(t)]
    proposed: list[list] = [[] for _ in texts]
    for k in range(0, len(todo), per_call):
        some = todo[k:k + per_call]
        for (i, a, b), found in zip(some, tagger.decode([texts[i][a:b] for i, a, b in some])):
            t = texts[i]
            for kind, s, e, p in found:
                # a span at a window's edge goes on in the next one
                if p >= least and (s > 0 or a == 0) and (e < b - a or b == len(t)) and allowed(kind, t[a + s:a + e]) and \
                        not (a + s and t[a + s - 1].isalnum()) and not (a + e < len(t) and t[a + e].isalnum()):
                    proposed[i].append((kind, a + s, a + e, p))
    return [(b, reconcile(b, p) if p else b) for b, p in zip(base, proposed)]


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def find(docs: DataFrame, tagger: Tagger, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, spans) of each whole text: the pattern matches and all spans, as kind:start:end by kind, then start.

    Places are code points, the end exclusive. Null text: empty. Null id and repeated rows: kept. No shuffle.
    """
    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                found = find_all(tagger, [x.as_py() or "" for x in part.column(1)])
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array([joined(f[k]) for f in found], pa.string()) for k in (0, 1))],
                                                 names=["doc_id", "base", "spans"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t")).mapInArrow(run, "doc_id long, base string, spans string")


def mask(docs: DataFrame, tagger: Tagger, text_col: str = "text") -> DataFrame:
    """The rows with each span replaced by its kind in brackets, as [email]; spans of two kinds that overlap are one. Null text: null."""
    import pandas as pd

    def cover(text: str, spans) -> str:
        out, done = [], 0
        for k, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
            if s >= done:
                out += [text[done:s], f"[{KINDS[k]}]"]
            done = max(done, e)
        return "".join([*out, text[done:]])

    def run(texts: pd.Series) -> pd.Series:
        own = [x or "" for x in texts]
        out = [cover(t, f[1]) for i in range(0, len(own), 512) for t, f in zip(own[i:i + 512], find_all(tagger, own[i:i + 512]))]
        return pd.Series([None if x is None else o for x, o in zip(texts, out)], dtype=object)

    run.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return docs.withColumn(text_col, F.pandas_udf(run, "string")(F.col(text_col)))
