"""Token ids of a public tokenizer file, with a cache by word where the file's rules allow it."""

from __future__ import annotations

import json
import os
import unicodedata

import numpy as np

#: Entries that each of the two caches of a Python worker keeps, some 200 bytes each; later words are encoded anew each
#: time.
CACHE = 150_000

# The pre-tokenizer pattern and normalizers of a tokenizer whose pieces never cross white space.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_MARKS = '.,!?;:|*%$#&()[]{}"-_/+=~^@'


def _byte_letters() -> list[str]:
    """The printable letter of each byte in byte-level BPE: printable ones are themselves, the others follow 255."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = [], 256
    for b in range(256):
        out.append(chr(b if b in plain else extra))
        extra += b not in plain
    return out


class _Words(dict):
    """Word bytes -> ids as little-endian uint32 bytes."""

    def __init__(self, slow):
        self.slow = slow

    def __missing__(self, word):
        out = self.slow(word.decode("utf-8", "replace"))
        if len(self) < CACHE:
            self[word] = out
        return out


class Encoder:
    """encode(text bytes) -> the ids that tokenizers gives for the text (add_special_tokens=False), as uint32 bytes."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.by_word = self._splits_at_space(spec)
        self.letters = _byte_letters()
        self.cores: dict[str, bytes] = {}
        self.words = _Words(self._word)

    @staticmethod
    def _splits_at_space(spec: dict) -> bool:
        parts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        norms = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        return (
            norms == _NORMALIZERS and len(parts) == 2 and parts[0].get("pattern") == {"Regex": _PATTERN}
            and parts[0].get("behavior") == "Removed" and parts[0].get("invert") is True and spec.get("post_processor") is None
            and not any(x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"] for x in spec["added_tokens"])
            and not any(c.isspace() for x in spec["added_tokens"] for c in x["content"])
        )

    def _full(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _core(self, low: str) -> bytes:
        out = self.cores.get(low)
        if out is None:
            mapped = low if low.isascii() else "".join(map(self.letters.__getitem__, low.encode()))
            out = np.asarray([t.id for t in self.tokenizer.model.tokenize(mapped)], "<u4").tobytes()
            if len(self.cores) < CACHE:
                self.cores[low] = out
        return out

    def _word(self, word: str) -> bytes:
        core = word.rstrip(_MARKS)
        low = core.lower()
        # Latin letters with marks behind them: the marks are one piece, the letters another.
        if low.isalpha() and core.isalpha() and max(low) < "ɐ" and (word.isascii() or unicodedata.is_normalized("NFC", word)):
            marks = word[len(core) :]
            return self._core(low) + (self.words[marks.encode()] if marks else b"")
        return self._full(word)

    def encode(self, text: bytes) -> bytes:
        if self.by_word:
            return b"".join(map(self.words.__getitem__, text.split()))
        return self._full(text.decode("utf-8", "replace"))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this Python worker for that file; workers are used again, and so is their encoder with its caches."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
