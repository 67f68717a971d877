"""Ids of whole texts by the tokenizers library, word by word with a bounded memory of words."""

from __future__ import annotations

import struct

import numpy as np

# Words whose ids a Python worker remembers; further words are encoded whenever they come.
MEMORY = 1_500_000

_encoders: dict = {}


class WordEncoder:
    """Encodes texts with one tokenizer file; the ids come as little-endian unsigned 32-bit bytes.

    The tokenizer drops white space between words, lower-cases A-Z, and ends a piece
    where a letter meets a comma or full stop, so a text's ids are the ids of its words in
    order, and a word that ends in a letter and one such mark has the ids of both. Equal
    words are encoded once. A text that could hold a special token's name ("<|") is
    encoded in one piece.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        fences = {t.content: i for i, t in self.lib.get_added_tokens_decoder().items()
                  if t.special and t.content.startswith("<|") and not (t.lstrip or t.rstrip or t.single_word or t.normalized)}
        self.fence = next(iter(fences.items()), None)
        self.known: dict[bytes, bytes] = {b"": b""}

    def whole(self, text: str) -> bytes:
        ids = self.lib.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def many(self, texts: list[bytes]) -> list[bytes]:
        """Ids of many UTF-8 texts."""
        parts = [None if b"<|" in t else t.lower().replace(b"\n", b" ").split(b" ") for t in texts]
        known = self.known
        new: dict[bytes, bytes] = {}
        missing = set().union(*filter(None, parts)).difference(known)
        marked = [w for w in missing if w[-1] in b",." and w[-2:-1].isalpha()]
        missing.difference_update(marked)
        missing.update(w for w in {x for m in marked for x in (m[:-1], m[-1:])} if w not in known)
        todo = list(missing)
        for i in range(0, len(todo), 4096):
            some = todo[i:i + 4096]
            if self.fence is None:
                enc = self.lib.encode_batch_fast([w.decode("utf-8", "replace") for w in some], add_special_tokens=False)
                new.update((w, struct.pack(f"<{len(e.ids)}I", *e.ids)) for w, e in zip(some, enc))
                continue
            # one call for all: a special token, which these words don't hold, stands between them
            text = self.fence[0].join([w.decode("utf-8", "replace") for w in some])
            ids = np.array(self.lib.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            ends = [*np.flatnonzero(ids == self.fence[1]).tolist(), len(ids)]
            raw = ids.tobytes()
            new.update((w, raw[4 * (b + 1):4 * e]) for w, b, e in zip(some, [-1, *ends], ends))
        find = _Two(known, new).__getitem__
        new.update([(m, find(m[:-1]) + find(m[-1:])) for m in marked])
        room = MEMORY - len(known)
        if room >= len(new):
            known.update(new)
            get = known.__getitem__
        else:
            known.update(list(new.items())[:max(0, room)])
            get = _Two(known, new).__getitem__
        return [self.whole(t.decode("utf-8", "replace")) if p is None else b"".join(map(get, p))
                for t, p in zip(texts, parts)]


class _Two(dict):
    """The remembered words with this call's further words behind them."""

    def __init__(self, first: dict, rest: dict):
        super().__init__(rest)
        self.first = first

    def __missing__(self, w: bytes) -> bytes:
        return self.first[w]


def encoder(path: str) -> WordEncoder:
    """The worker's encoder of that file."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]
