"""SentencePiece encoding and decoding with a merge-type (BPE) vocabulary.

Encoding keeps, for each prefix of a segment, the one token that the encoding of that
prefix ends with. A token may end at a position when it matches there (found by an
automaton over all pieces) and either begins the segment or is compatible with the
token that the shorter prefix ends with: merging the two texts joined gives exactly these
two tokens. Exactly one match passes, so the ids follow backwards from the end.
"""

from __future__ import annotations

import codecs
import re
import struct

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"          # stands for a space in the pieces
UNKNOWN = " ⁇ "     # what an unknown id is decoded to
MEMORY = 750_000         # segments that a worker remembers
PAIRS = 450_000          # pairs of tokens that it remembers
LATEST = 50_000          # further segments that it remembers for a while

_tables: dict = {}


def _each_byte(e: UnicodeDecodeError):
    return "�" * (e.end - e.start), e.end


codecs.register_error("partflow-each-byte", _each_byte)


class PieceTable:
    """The vocabulary of a model file with its prefix-table encoder and its decoder.

    Only pieces, their scores and kinds are taken from the file. Raises ValueError for a
    model that rewrites text, has no byte pieces, or has pieces with a space mark after another character
    (segments could not be cut before a mark).
    """

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.begin, self.end = sp.bos_id(), sp.eos_id()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i) for i in range(n)]
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.scores = [sp.get_score(i) for i in range(n)]
        self.ids = {self.pieces[i]: i for i in range(n) if not special[i]}
        self.bytes = {int(self.pieces[i][1:-1], 16): i for i in range(n) if sp.is_byte(i)}
        if len(self.bytes) != 256 or sp.normalize(" ﬁ  a\t") != MARK * 2 + "ﬁ" + MARK * 2 + "a\t":
            raise ValueError(f"{path}: needs byte pieces, a leading mark and text that is left as it is")
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in self.ids):
            raise ValueError(f"{path}: has pieces across words or lines")
        self.controls = {i for i in range(n) if sp.is_control(i)}
        self.sizes = [len(p) for p in self.pieces]
        self.matches = ahocorasick.Automaton()
        for p, i in self.ids.items():
            if len(self.merged(p)) == 1:       # else merging never makes this piece
                self.matches.add_word(p, i)
        self.matches.make_automaton()
        self.texts = [b"" if sp.is_control(i) else UNKNOWN.encode() if sp.is_unknown(i) else
                      bytes([int(p[1:-1], 16)]) if sp.is_byte(i) else p.replace(MARK, " ").encode()
                      for i, p in enumerate(self.pieces)]
        self.lengths = np.array([len(b) for b in self.texts])
        self.places = np.cumsum(self.lengths) - self.lengths
        self.pool = np.frombuffer(b"".join(self.texts), np.uint8)
        # marks that no piece has right after a letter: a text is cut before them, so a word is one segment with or without
        # them, unless it has one of the other characters there that a piece goes on from
        after = [(x, y) for p in self.ids for x, y in zip(p, p[1:]) if y in ",.;:!?"]
        self.marks = [c for c in ",.;:!?" if not any(x.isalpha() and y == c for x, y in after)]
        before, marks = (re.escape("".join(sorted(x))) for x in ({x for x, y in after if y in self.marks}, self.marks))
        self.joined = re.compile(f"[{marks}](?<=[{before}].)") if before else None
        self.pairs: dict[int, bool] = {}
        self.known = _Memory(self._one)

    def merged(self, text: str) -> list[str]:
        """Merge from single characters, the best-scored neighbours first, the leftmost of equals (short texts only)."""
        s, ids, scores = list(text), self.ids, self.scores
        while len(s) > 1:
            best, at = None, -1
            for k in range(len(s) - 1):
                i = ids.get(s[k] + s[k + 1])
                if i is not None and (best is None or scores[i] > best):
                    best, at = scores[i], k
            if best is None:
                break
            s[at:at + 2] = [s[at] + s[at + 1]]
        return s

    def compatible(self, a: int, b: int) -> bool:
        """Whether token b may follow token a."""
        key = a * len(self.sizes) + b
        if (ok := self.pairs.get(key)) is None:
            x, y = self.pieces[a], self.pieces[b]
            ok = self.merged(x + y) == [x, y]
            if len(self.pairs) < PAIRS:
                self.pairs[key] = ok
        return ok

    def segment(self, text: str) -> list[int]:
        """Ids of one segment, from its prefix table."""
        last = [-1] * (len(text) + 1)      # id of the last token of each prefix; -1: a character outside the vocabulary
        sizes, pairs, done, n = self.sizes, self.pairs, 0, len(self.sizes)
        for end, i in self.matches.iter(text):     # at each end, the longest first
            end += 1
            if end == done:
                continue
            begin = end - sizes[i]
            if begin:
                before = last[begin]
                if before >= 0 and not ((ok := pairs.get(before * n + i)) or ok is None and self.compatible(before, i)):
                    continue
            last[end], done = i, end
        out: list[int] = []
        at = len(text)
        while at:
            if (i := last[at]) < 0:
                at -= 1
                out += [self.bytes[b] for b in reversed(text[at].encode())]
            else:
                out.append(i)
                at -= sizes[i]
        return out[::-1]

    def cut(self, text: str) -> list[str]:
        """Segments of a text with its space marks: no piece goes from one into the next."""
        if not text:
            return []
        if text[0] == " " or "  " in text or MARK in text:
            return re.findall(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n", MARK + text.replace(" ", MARK))
        text = (MARK + text.replace(" ", " " + MARK)).replace("\n", " \n ")
        if self.joined is None or not self.joined.search(text):
            for c in self.marks:
                text = text.replace(c, " " + c)
        return text.split(" ")

    def many(self, texts: list[str]) -> list[bytes]:
        """Ids of each text without begin and end, as little-endian unsigned 32-bit bytes; a remembered segment isn't encoded again."""
        find = self.known.__getitem__
        return [b"".join(map(find, self.cut(t))) for t in texts]

    def encode(self, text: str) -> bytes:
        return self.many([text])[0]

    def _one(self, segment: str) -> bytes:
        ids = self.segment(segment)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _bytes(self, ids: np.ndarray) -> bytes:
        """The texts of ids, joined: taken out of ``pool``, where all texts lie one behind the other."""
        n = self.lengths[ids]
        # how far the place in the pool of each byte is ahead of its place in the result
        ahead = np.repeat(self.places[ids] - (np.cumsum(n) - n), n)
        return self.pool[ahead + np.arange(len(ahead))].tobytes()

    def decode(self, ids) -> str:
        """Text of ids: pieces joined, marks to spaces but for the one that encoding put before the text."""
        ids = np.asarray(ids, dtype=np.int64)
        runs = [ids]
        if any((ids[1:-1] == i).any() for i in self.controls):   # a character's byte pieces don't join across these
            cuts = [-1, *np.flatnonzero(np.isin(ids, list(self.controls))).tolist(), len(ids)]
            runs = [ids[a + 1:b] for a, b in zip(cuts, cuts[1:])]
        out = "".join(self._bytes(r).decode("utf-8", "partflow-each-byte") for r in runs)
        if out[:1] == " ":
            first = next(i for i in ids.tolist() if self.texts[i])
            if self.pieces[first][:1] == MARK:
                return out[1:]
        return out


class _Memory(dict):
    """Remembered segments, the first ``MEMORY`` of them for good; behind them the last ones met, up to ``LATEST``."""

    def __init__(self, encode):
        super().__init__({"": b""})
        self.encode, self.latest = encode, {}

    def __missing__(self, p: str) -> bytes:
        if (b := self.latest.get(p)) is None:
            b = self.encode(p)
            if len(self) < MEMORY:
                self[p] = b
            else:
                if len(self.latest) >= LATEST:
                    self.latest.clear()
                self.latest[p] = b
        return b


def piece_table(path: str) -> PieceTable:
    """The worker's table of that model file."""
    if path not in _tables:
        _tables[path] = PieceTable(path)
    return _tables[path]


def encode(docs: DataFrame, model: str, text_col: str = "text", begin: bool = True, end: bool = True,
           docs_per_call: int = 256) -> DataFrame:
    """The rows with ``ids`` (binary: little-endian unsigned 32-bit) of each whole text; no shuffle.

    Null text: empty. Empty text: the begin and end ids alone. An existing column ``ids`` raises. Other columns,
    repeated rows and their order are kept.
    """
    if "ids" in docs.columns:
        raise ValueError("the input has a column ids")
    @F.pandas_udf("binary")
    def ids(texts: pd.Series) -> pd.Series:
        t = piece_table(model)
        a, b = (struct.pack("<I", t.begin) if begin else b""), (struct.pack("<I", t.end) if end else b"")
        texts = texts.tolist()
        return pd.Series([a + x + b for i in range(0, len(texts), docs_per_call) for x in t.many(texts[i:i + docs_per_call])], dtype=object)

    return docs.withColumn("ids", ids(F.coalesce(F.col(text_col), F.lit(""))))


def decode(docs: DataFrame, model: str, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """The rows with the text of their ids in column ``to``; null ids: null. An existing column of that name raises."""
    if to in docs.columns:
        raise ValueError(f"the input has a column {to}")

    @F.pandas_udf("string")
    def text(raw: pd.Series) -> pd.Series:
        t = piece_table(model)
        return pd.Series([None if x is None else t.decode(np.frombuffer(x, "<u4")) for x in raw], dtype=object)

    return docs.withColumn(to, text(F.col(ids_col)))
