"""Encoding of texts with a given public tokenizer file, for use inside Spark tasks.

Texts are cut where the tokenizer itself always cuts (before white space that follows
non-white space, and between a letter and a following ``.`` or ``,``), so the ids of a text are
the ids of its pieces one after another. Pieces repeat, so each worker process keeps the ids of
about ``CACHE_LIMIT`` pieces and gives only new ones to the library. Tokenizers whose file does not
guarantee those cuts are called on whole texts.
"""
from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np

#: Pieces that one worker process remembers (about 200 bytes each).
CACHE_LIMIT = 1_500_000
#: Longer pieces are encoded each time instead of being remembered.
LONG_PIECE = 64
#: Characters of one text that are cut into pieces at a time.
WINDOW = 1 << 20

_LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]"
_WITH_SPACE = re.compile(rf"\s*{_LETTERS}+(?=[\s.,]|\Z)|\s*\S+|\s+")
_NO_SPACE = re.compile(rf"{_LETTERS}+(?=[\s.,]|\Z)|\S+")
#: White space on which Python and the tokenizer may differ: such texts are encoded whole.
_ODD = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]")
_encoders: dict[str, "Encoder"] = {}


def encoder(path: str) -> "Encoder":
    """The encoder of this worker process for the tokenizer file at ``path``."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)


def _cuts(config: dict) -> re.Pattern | None:
    if any(t.get("lstrip") or t.get("rstrip") or re.search(r"\s", t["content"]) for t in config.get("added_tokens", [])):
        return None
    if config.get("post_processor") or config.get("truncation") or config.get("padding"):
        return None
    norm, pre = config.get("normalizer"), config.get("pre_tokenizer") or {}
    if norm is None and pre.get("type") == "ByteLevel" and not pre["add_prefix_space"] and pre["use_regex"]:
        return _WITH_SPACE
    steps = (norm or {}).get("normalizers", [])
    if [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"] and steps[1]["pattern"] == {"Regex": "\\s+"}:
        first = (pre.get("pretokenizers") or [{}])[0]
        if first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert"):
            return _NO_SPACE
    return None


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes; no special tokens are added."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.cuts = _cuts(json.load(f))
        self.lower = self.cuts is _NO_SPACE
        self.cache = _Pieces(self.tokenizer)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as bytes; null texts are empty."""
        if self.cuts is None:
            return [np.array(e.ids, dtype="<u4").tobytes()
                    for e in self.tokenizer.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]
        out: list[bytes] = []
        find, group, size = self.cuts.findall, [], 0
        for t in texts:
            t = t or ""
            if _ODD.search(t):
                out += self._join(group, find)
                group, size = [], 0
                out.append(np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes())
                continue
            if len(t) > WINDOW:
                out += self._join(group, find)
                group, size = [], 0
                out.append(b"".join(b"".join(self._join([w], find)) for w in self._windows(t)))
                continue
            group.append(t)
            size += len(t)
            if size > WINDOW:
                out += self._join(group, find)
                group, size = [], 0
        return out + self._join(group, find)

    def _windows(self, text: str):
        """Cut a very long text before white space that follows non-white space."""
        i = 0
        cut = re.compile(r"(?<=\S)(?=[ \n])")
        while len(text) - i > WINDOW:
            m = cut.search(text, i + WINDOW)
            if m is None:
                break
            yield text[i:m.start()]
            i = m.start()
        yield text[i:]

    def _join(self, texts: list[str], find) -> list[bytes]:
        if not texts:
            return []
        get = self.cache.__getitem__
        out = [b"".join(map(get, find(t.lower() if self.lower and t.isascii() and "<|" not in t else t))) for t in texts]
        if len(self.cache) > CACHE_LIMIT:
            self.cache.clear()
        return out


class _Pieces(dict):
    """Ids of pieces; a piece that is not there is encoded, and remembered unless it is long."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer = tokenizer

    def __missing__(self, piece: str) -> bytes:
        ids = array("I", self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()
        if len(piece) <= LONG_PIECE:
            self[piece] = ids
        return ids
