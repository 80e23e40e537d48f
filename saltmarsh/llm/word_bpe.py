"""Exact encoding with a word-end BPE vocabulary, cached by pre-token.

The vocabulary's normaliser folds white space and lower-cases, and its pre-tokeniser never matches white space, so a
text's ids are the concatenation of its pre-tokens' ids. Texts of plain Latin letters, digits, ASCII signs and white space
are split and merged here; in other texts any word with something else in it (combining marks, other scripts,
special-token strings) is a unit that goes to the tokenizers library whole.
"""

from __future__ import annotations

import json
import re
from array import array

from .common import worker_state

_SIMPLE = re.compile(r"[\x21-\x7eÀ-ÖØ-öø-ÿ]+")
_SIMPLE_TEXT = re.compile(r"[\t-\r\x20-\x7eÀ-ÖØ-öø-ÿ]*")
_PRETOKEN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
#: str.split() takes these four for white space; the vocabulary's pattern does not.
_NOT_SPACE = re.compile("[\x1c-\x1f]")
_SAFE_SPACE = re.compile(r"[ \t\n\r]+")
#: What marks a unit that is a whole word for the library; no pre-token begins so.
_WHOLE = " "
#: Longer units are encoded but not kept; longer pre-tokens are left to the library (the merge loop here is quadratic).
MAX_CACHED, MAX_MERGED = 64, 256
#: What a worker's cache may take in all, in bytes.
CACHE_BYTES = 96 << 20
#: What an entry takes besides its characters and ids: two objects' headers and a place in the table.
ENTRY_BYTES = 160


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the rest follow from U+0100."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(keep)]
    return {b: chr(b) for b in keep} | {b: chr(256 + i) for i, b in enumerate(rest)}


def words(text: str) -> list[str]:
    """White-space-delimited words; only white space that the vocabulary drops delimits."""
    if _NOT_SPACE.search(text):
        return [w for w in _SAFE_SPACE.split(text) if w]
    return text.split()


class WordEncoder:
    """ids(word) of a BPE vocabulary in the tokenizers JSON format, merges and all."""

    def __init__(self, vocabulary_json: bytes):
        from tokenizers import Tokenizer

        spec = json.loads(vocabulary_json)
        self.library = Tokenizer.from_str(vocabulary_json.decode())
        self.library.no_truncation()
        self.library.no_padding()
        self.vocab = spec["model"]["vocab"]
        self.end = spec["model"]["end_of_word_suffix"]
        #: Merge table on ids: left << 16 | right -> rank; the merged id by rank.
        self.rank, self.merged = {}, []
        for i, m in enumerate(spec["model"]["merges"]):
            left, right = m.split(" ") if isinstance(m, str) else m
            self.rank.setdefault(self.vocab[left] << 16 | self.vocab[right], i)
            self.merged.append(self.vocab[left + right])
        letters = byte_letters()
        self.inner = [self.vocab[letters[b]] for b in range(256)]
        self.final = [self.vocab[letters[b] + self.end] for b in range(256)]
        self.specials = [t["content"] for t in spec["added_tokens"]]

    def units(self, text: str) -> list[str]:
        """The parts of a text that are encoded apart: its pre-tokens, or whole words for the library."""
        special = any(s in text for s in self.specials)
        if not special and _SIMPLE_TEXT.fullmatch(text):
            return _PRETOKEN.findall(text.lower())
        out: list[str] = []
        for word in words(text):
            if _SIMPLE.fullmatch(word) and not (special and any(s in word for s in self.specials)):
                out += _PRETOKEN.findall(word.lower())
            else:
                out.append(_WHOLE + word)
        return out

    def unit(self, unit: str) -> list[int] | tuple[int, ...]:
        """Ids of one such part."""
        if unit[0] == _WHOLE or len(unit) > MAX_MERGED:
            return self.library.encode(unit.removeprefix(_WHOLE), add_special_tokens=False).ids
        return self._merge(unit)

    def _merge(self, piece: str) -> tuple[int, ...]:
        """Lowest rank first, leftmost among equals; only the two ranks beside a merge are looked up again."""
        get, merged, none = self.rank.get, self.merged, len(self.merged)
        raw = piece.encode()
        parts = [self.inner[b] for b in raw]
        parts[-1] = self.final[raw[-1]]
        ranks = [get(a << 16 | b, none) for a, b in zip(parts, parts[1:])]
        ranks.append(none)
        while (best := min(ranks)) != none:
            i = ranks.index(best)
            parts[i] = left = merged[best]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get(parts[i - 1] << 16 | left, none)
            if i + 1 < len(parts):
                ranks[i] = get(left << 16 | parts[i + 1], none)
        return tuple(parts)


class _Cache(dict):
    """Unit -> value with misses computed once. The fixed tier stays; of the rest, two generations are kept within a number of bytes.

    A unit met again moves from the old generation to the new one; when the new one is full it becomes the old one.
    """

    def __init__(self, encoder: WordEncoder, fixed: dict, max_bytes: int):
        super().__init__(fixed)
        self.encoder, self.fixed, self.max_bytes, self.bytes = encoder, fixed, max_bytes, 0
        self.old: dict = {}

    def __missing__(self, unit: str):
        value = self.old.get(unit)
        if value is None:
            value = self.value(self.encoder.unit(unit))
        if len(unit) <= MAX_CACHED:
            self.bytes += ENTRY_BYTES + len(unit) + (len(value) if isinstance(value, bytes) else 0)
            if self.bytes > self.max_bytes // 2:
                self.old, self.bytes = dict(self), 0
                self.clear()
                self.update(self.fixed)
            self[unit] = value
        return value


class LengthCache(_Cache):
    """Number of ids of each unit."""

    value = staticmethod(len)

    def count(self, text: str) -> int:
        return sum(map(self.__getitem__, self.encoder.units(text)))


class IdCache(_Cache):
    """Ids of each unit as little-endian unsigned 32-bit bytes."""

    @staticmethod
    def value(ids) -> bytes:
        return array("I", ids).tobytes()

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.encoder.units(text)))


def worker_cache(kind: type[_Cache], vocabulary_json: bytes, fixed: dict[str, int] | None = None, key: str = "", max_bytes: int = CACHE_BYTES) -> _Cache:
    """The cache of this Python worker; it outlives single tasks because Spark reuses its workers."""
    return worker_state((kind.__name__, hash(vocabulary_json), key), lambda: kind(WordEncoder(vocabulary_json), fixed or {}, max_bytes))
