"""Whole-text encoding with a ``tokenizers`` file, remembering the ids of words.

A text is cut where the tokenizer's own pre-tokenisation always cuts: before
each run of white space, and between a letter and a sign. Each such piece goes through the tokenizers library once per worker;
its ids are remembered as bytes, and a text's ids are the joined bytes. The
result is the same as encoding the whole text (tests compare the two)."""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np

from riskframe.llm.common import WHITE, WordCache, pieces

# letters that stay one letter in lower case
_LETTERS = "".join(c for c in map(chr, range(0x41, 0x250))
                   if c.isalpha() and len(c.lower()) == 1 and c.lower().isalpha())


# white space and signs: after letters, all of them start a new pre-token
_STOP = WHITE + r"!-/:-@\[-`{-~"


def _kept_white() -> re.Pattern:
    return re.compile(rf"[{WHITE}]*[{_LETTERS}]+(?=[{_STOP}]|\Z)|[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")


def _dropped_white() -> re.Pattern:
    return re.compile(rf"[{_LETTERS}]+(?=[{_STOP}]|\Z)|[^{WHITE}]+")


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others
    follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(256 + i) for i, b in enumerate(rest)}


_BYTES = _byte_letters()
_BLANK, _BREAK = _BYTES[ord(" ")], _BYTES[ord("\n")]


class Encoder:
    """``ids(text)``: little-endian ids of ``dtype``, without added special ids."""

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.pattern = self._cuts(json.loads(tokenizer_json))
        self.lowers = bool(self.pattern) and self.pattern.pattern == _dropped_white().pattern
        self.cache = WordCache(self._encode)

    @staticmethod
    def _cuts(spec: dict) -> re.Pattern | None:
        """None for a tokenizer whose cuts are not known: whole texts are encoded."""
        pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer") or {}
        plain = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"])
                        for t in spec.get("added_tokens", []))
        if not plain:
            return None
        if not norm and pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]:
            return _kept_white()
        steps = [x["type"] for x in norm.get("normalizers", [])]
        splits = [x for x in pre.get("pretokenizers", []) if x["type"] == "Split"]
        if (steps == ["NFC", "Replace", "Lowercase"] and len(splits) == 1 and splits[0]["invert"]
                and splits[0]["behavior"] == "Removed" and r"[^\s\p{L}\p{N}]+" in splits[0]["pattern"]["Regex"]):
            return _dropped_white()
        return None

    def _encode(self, words: list[str]) -> list[bytes]:
        if self.pattern is None:
            return self._through(words)
        # a word of letters, after one blank if white space is kept, is one
        # pre-token: its bytes, written as letters, go to the merges directly
        merge, kind = self.tokenizer.model.tokenize, self.dtype.char
        done = {}
        for w in words:
            core = w if self.lowers or w[0] != " " else w[1:]
            if core.isalpha() and (not self.lowers or core.islower()):
                if core.isascii():  # letters stand for themselves
                    raw = core if core is w else _BLANK + core
                elif _latin(core):
                    raw = w.encode().decode("latin-1").translate(_BYTES)
                else:
                    continue
                done[w] = array(kind, [t.id for t in merge(raw)]).tobytes()
            elif not self.lowers and w[0] == "\n" and (core := w[1:]).isalpha() and core.isascii():
                # a line break before letters is a pre-token of its own
                done[w] = array(kind, [t.id for part in (_BREAK, core) for t in merge(part)]).tobytes()
        other = [w for w in words if w not in done]
        if other:
            done.update(zip(other, self._through(other)))
        return [done[w] for w in words]

    def _through(self, words: list[str]) -> list[bytes]:
        out, kind = [], self.dtype.char
        for i in range(0, len(words), 20_000):
            found = self.tokenizer.encode_batch(words[i:i + 20_000], add_special_tokens=False)
            out += [array(kind, e.ids).tobytes() for e in found]
        return out

    def ids(self, text: str) -> bytes:
        if self.pattern is None:
            return self._encode([text])[0]
        if self.lowers and "<|" not in text and _latin(text):
            text = text.lower()  # as the tokenizer does; fewer different words
        return b"".join(b"".join(self.cache.values(part)) for part in pieces(self.pattern, text))


def _latin(text: str) -> bool:
    """Whether lower case and composition work letter by letter."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


_ENCODERS: dict[int, Encoder] = {}


def encoder(tokenizer_json: str) -> Encoder:
    """The worker's encoder for this file; one at a time is kept."""
    key = hash(tokenizer_json)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(tokenizer_json)
    return _ENCODERS[key]
