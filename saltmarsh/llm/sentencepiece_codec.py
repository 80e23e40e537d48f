"""SentencePiece encoding that keeps offsets, and decoding.

The normaliser replaces the longest prefix that the model's compiled character map knows, one after another, and records
for every normalised byte where its source begins; every piece is projected through that record to its byte span in the
original text. Segmentation is byte-pair merging by piece score with byte fallback. No piece of such a model spans a
place where a space follows something else, so texts are cut there, and each worker keeps the pieces of the units it has
met.

Defined cases: null text is empty: no ids, no spans, empty decoding; repeated rows are encoded each; an empty table gives
no rows; other columns of the input are not read.
"""

from __future__ import annotations

import codecs
import re
import struct
from array import array
from collections.abc import Callable, Iterator
from hashlib import sha256
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package, vocabulary, worker_state

SPACE = "▁"
_SPACE_BYTE = np.array([0x20], np.uint8)
_PLAIN = re.compile("[A-Za-z0-9À-ÖØ-öø-ÿ]")
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Units of more characters are encoded but not kept.
MAX_CACHED_UNIT = 64
#: What a worker's cache may take, in bytes, and what an entry takes besides its content.
UNIT_BYTES, ENTRY_BYTES = 112 << 20, 200
#: Texts whose new units are segmented in one call.
TEXTS = 1_000


def _one_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("saltmarsh.bytewise", _one_byte)


class CharacterMap:
    """The compiled character map: a double-array trie over source bytes, and the pool of replacements it points into."""

    def __init__(self, blob: bytes):
        self.units, self.pool = array("I"), b""
        if blob:
            (size,) = struct.unpack_from("<I", blob)
            self.units = array("I", struct.unpack_from(f"<{size // 4}I", blob, 4))
            self.pool = blob[4 + size :]

    def longest(self, raw: bytes, at: int) -> tuple[int, bytes]:
        """Bytes of the longest known prefix at a place (0: none) and what replaces them."""
        units, length, value = self.units, 0, -1
        if not units:
            return 0, b""
        node = _offset(units[0])
        for i in range(at, len(raw)):
            node ^= raw[i]
            if node >= len(units):
                break
            unit = units[node]
            if (unit & 0x800000FF) != raw[i]:
                break
            node ^= _offset(unit)
            if unit >> 8 & 1:
                length, value = i + 1 - at, units[node] & 0x7FFFFFFF
        if value < 0:
            return 0, b""
        return length, self.pool[value : self.pool.index(b"\0", value)]

    def begins(self, byte: int) -> bool:
        """Whether some entry begins with this byte."""
        at = _offset(self.units[0]) ^ byte if self.units else 0
        return bool(self.units) and at < len(self.units) and (self.units[at] & 0x800000FF) == byte


def _offset(unit: int) -> int:
    return (unit >> 10) << ((unit & 1 << 9) >> 6)


class Normalizer:
    """Normalised text and, for each of its bytes and its end, the source byte where that begins: the alignment record."""

    def __init__(self, spec):
        self.map = CharacterMap(spec.precompiled_charsmap)
        #: First bytes of the map's entries; the longest known prefix is looked for at these places only.
        self.starts = np.array([self.map.begins(b) for b in range(256)])
        self.prefix, self.trim, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        #: Without a map and trimming, only spaces change, so a unit's ids do not depend on where it stands.
        self.plain = not self.map.units and not self.trim and self.escape

    def replaced(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, source) after the longest known prefixes, one after another, are replaced.

        source is where the step of each byte begins in raw; every other character is a step of its own and stays.
        """
        one = np.frombuffer(raw, np.uint8)
        begin = np.maximum.accumulate(np.where((one & 0xC0) != 0x80, np.arange(len(one)), 0))
        parts, at = [], 0

        def stay(a: int, b: int) -> None:
            if b > a:
                parts.append((one[a:b], begin[a:b]))

        for i in np.flatnonzero(self.starts[one] & (begin == np.arange(len(one)))).tolist():
            if i >= at:
                size, new = self.map.longest(raw, i)
                if size:
                    stay(at, i)
                    parts.append((np.frombuffer(new, np.uint8), np.full(len(new), i)))
                    at = i + size
        stay(at, len(one))
        if not parts:
            return np.empty(0, np.uint8), np.empty(0, np.int64)
        return parts[0] if len(parts) == 1 else tuple(np.concatenate(column) for column in zip(*parts))

    def normalize(self, text: str) -> tuple[bytes, np.ndarray]:
        raw = text.encode()
        out, source = self.replaced(raw)
        end = len(raw)
        if self.trim and len(out):  # spaces that begin a step go after a space, and at the ends
            step = np.cumsum(np.r_[False, source[1:] != source[:-1]])
            space = out == 0x20
            first = np.flatnonzero(np.r_[True, step[1:] != step[:-1]])
            after = np.r_[True, space[:-1]][first][step]  # the text before this byte's step ends in a space, or is empty
            others = np.cumsum(~space)
            leads = others == (others - ~space)[first][step]  # all of the step up to here are spaces
            kept = ~(space & leads & after)
            out, source = out[kept], source[kept]
            last = len(out) - len(out.tobytes().rstrip(b" "))
            if last:
                end = int(source[len(out) - last])
                out, source = out[: len(out) - last], source[: len(out) - last]
        if not len(out):
            return b"", np.array([end])
        if self.prefix:
            out, source = np.concatenate([_SPACE_BYTE, out]), np.concatenate([source[:1], source])
        if self.escape:
            wide = np.where(out == 0x20, 3, 1)
            source = np.repeat(source, wide)
            out = out.tobytes().replace(b" ", SPACE.encode())
        return bytes(out), np.append(source, end)


class _Units(dict):
    """Unit -> its ids as unsigned 32-bit bytes, computed once; two generations are kept within a number of bytes, so that common units stay."""

    def __init__(self, codec: Codec, max_bytes: int):
        super().__init__()
        self.codec, self.max_bytes, self.bytes, self.old = codec, max_bytes, 0, {}

    def put(self, unit: str, ids: bytes) -> None:
        self.bytes += ENTRY_BYTES + 2 * len(unit) + len(ids)
        if self.bytes > self.max_bytes // 2:
            self.old, self.bytes = dict(self), 0
            self.clear()
        self[unit] = ids

    def __missing__(self, unit: str) -> bytes:
        ids = self.old.get(unit) or self.codec.encode_unit(unit)
        if len(unit) <= MAX_CACHED_UNIT:
            self.put(unit, ids)
        return ids


class Codec:
    """Encoder and decoder of one BPE model given as its serialised bytes."""

    def __init__(self, model: bytes, max_bytes: int = UNIT_BYTES, by_library: bool = True):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        proto.ParseFromString(model)
        if proto.trainer_spec.model_type != 2 or any(p.type == USER_DEFINED for p in proto.pieces):
            raise ValueError("a BPE model without user-defined pieces is expected")
        self.normalizer = Normalizer(proto.normalizer_spec)
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.rank = {p.piece: -p.score for p in proto.pieces if p.type == NORMAL}
        #: Neighbouring characters inside some piece; no merge crosses any other place.
        self.inside = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.scores = [p.score for p in proto.pieces]
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == UNKNOWN)
        self.controls = {i for i, p in enumerate(proto.pieces) if p.type == CONTROL}
        self.prefix = proto.normalizer_spec.add_dummy_prefix
        #: What an id stands for in a decoded text.
        self.surface = [self._surface(p, proto.trainer_spec) for p in proto.pieces]
        self.joined_space = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        #: Control characters of no piece part units, too: no merge crosses them.
        self.barriers = "".join(c for c in "\n\t\r" if not any(c in p for p in self.ids))
        #: Signs that no piece joins to a letter or digit before them: a word ends there, so that it is one unit with any sign after it.
        joined = {p[1] for p in self.inside if _PLAIN.match(p[0])}
        ends = re.escape("".join(c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum() and c not in joined))
        no = re.escape(self.barriers)
        word = rf"{SPACE}+{_PLAIN.pattern}++(?=[{ends}])|" if ends else ""
        self.unit = re.compile(rf"{word}{SPACE}+[^{SPACE}{no}]*|[^{SPACE}{no}]+" + (f"|[{no}]+" if no else "")) if not self.joined_space else re.compile(r"(?s).+")
        self.cache = _Units(self, max_bytes)
        #: Units new to a worker are segmented by the library where it would normalise them to themselves; else by ``merge``.
        self.library = SentencePieceProcessor(model_proto=model)
        self.by_library = by_library and self.normalizer.plain and self.prefix and not self.joined_space
        #: Normalised bytes of each piece, the byte that it stands for (-1: none), and its id as text.
        self.sizes = np.array([1 if p.type == BYTE else len(p.piece.encode()) for p in proto.pieces], np.int64)
        self.byte_of = np.array([int(p.piece[1:-1], 16) if p.type == BYTE else -1 for p in proto.pieces], np.int16)
        self.said = [str(i) for i in range(len(proto.pieces))]

    def _surface(self, piece, trainer) -> bytes:
        if piece.type == BYTE:
            return bytes([int(piece.piece[1:-1], 16)])
        if piece.type == CONTROL:
            return b""
        if piece.type == UNKNOWN:
            return trainer.unk_surface.encode()
        return piece.piece.replace(SPACE, " ").encode()

    def merge(self, text: str) -> list[str]:
        """Pieces of a normalised unit: the best-scored neighbouring pair first, the leftmost among equals."""
        parts = list(text)
        ids, scores = self.ids, self.scores
        if len(parts) <= 48:
            get, none = self.rank.get, 1e30
            ranks = [get(a + b, none) for a, b in zip(parts, parts[1:])]
            ranks.append(none)
            while (best := min(ranks)) != none:
                i = ranks.index(best)
                parts[i] = whole = parts[i] + parts[i + 1]
                del parts[i + 1], ranks[i]
                if i:
                    ranks[i - 1] = get(parts[i - 1] + whole, none)
                if i + 1 < len(parts):
                    ranks[i] = get(whole + parts[i + 1], none)
            return parts
        right = list(range(1, len(parts))) + [-1]
        left = list(range(-1, len(parts) - 1))
        heap = [(-scores[k], i, parts[i] + parts[i + 1]) for i in range(len(parts) - 1) if (k := ids.get(parts[i] + parts[i + 1])) is not None]
        heapify(heap)
        while heap:
            _, i, whole = heappop(heap)
            j = right[i]
            if j < 0 or not parts[i] or parts[i] + parts[j] != whole:
                continue
            parts[i], parts[j] = whole, ""
            right[i] = right[j]
            if right[j] >= 0:
                left[right[j]] = i
            for a, b in ((left[i], i), (i, right[i])):
                if a >= 0 and b >= 0 and (k := ids.get(parts[a] + parts[b])) is not None:
                    heappush(heap, (-scores[k], a, parts[a] + parts[b]))
        return [p for p in parts if p]

    def pieces(self, unit: str) -> list[str]:
        """Pieces of a unit, and characters that are no piece."""
        cuts = [i for i in range(1, len(unit)) if unit[i - 1 : i + 1] not in self.inside]
        return [p for a, b in zip([0, *cuts], [*cuts, len(unit)]) for p in self.merge(unit[a:b])]

    def encode_unit(self, unit: str) -> bytes:
        """Ids of a unit; a character without a piece becomes its bytes, or is unknown."""
        ids = array("I")
        for p in self.pieces(unit):
            k = self.ids.get(p)
            if k is not None:
                ids.append(k)
            elif self.bytes:
                ids.extend(self.bytes[b] for b in p.encode())
            else:
                ids.append(self.unknown)
        return ids.tobytes()

    def warm(self, texts: list[list[str]]) -> None:
        """Take the new units of many texts into the cache at once: one library call, far cheaper than one a unit.

        Units that do not begin with a space are left to ``encode_unit``.
        """
        if not self.by_library:
            return
        cache, old = self.cache, self.cache.old
        new = [u for u in set().union(*texts).difference(cache) if u[0] == SPACE and 1 < len(u) <= MAX_CACHED_UNIT and u not in old]
        # the library's own dummy prefix stands for a unit's first space
        for u, ids in zip(new, self.library.encode([u[1:].replace(SPACE, " ") for u in new], num_threads=1)):
            if self.bytes or self.unknown not in ids:  # the library joins unknown neighbours
                cache.put(u, array("I", ids).tobytes())

    def piece_sizes(self, ids: np.ndarray, units: list[str]) -> np.ndarray:
        """Normalised bytes of each piece; of a character's several byte pieces the last has them all, as in the library."""
        if not self.bytes and (ids == self.unknown).any():  # an unknown character's size is not in its id
            return np.array([len(p.encode()) for u in units for p in self.pieces(u)], np.int64)
        sizes, byte = self.sizes[ids], self.byte_of[ids]
        if (byte >= 0x80).any():
            sizes[byte >= 0x80] = 0
            lead = np.flatnonzero(byte >= 0xC0)
            width = 2 + (byte[lead] >= 0xE0) + (byte[lead] >= 0xF0)
            sizes[lead + width - 1] = width
        return sizes

    def encode(self, text: str) -> list[int]:
        return self.project(*self.segmented(text))[0]

    def segmented(self, text: str) -> tuple[list[str], np.ndarray]:
        """The units of the normalised text, and its alignment record."""
        raw, source = self.normalizer.normalize(text)
        return self.unit.findall(raw.decode()), source

    def project(self, units: list[str], source: np.ndarray) -> tuple[list[int], np.ndarray, str]:
        """Ids, the places in the source that part them (one more than ids: a piece lies between two), and ids as text."""
        ids = np.frombuffer(b"".join(map(self.cache.__getitem__, units)), np.uint32)
        bounds = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(self.piece_sizes(ids, units), out=bounds[1:])
        listed = ids.tolist()
        return listed, source[bounds], ",".join(map(self.said.__getitem__, listed))

    def encode_spans(self, text: str) -> tuple[list[int], list[tuple[int, int]]]:
        """Ids and the byte span in the original text of each; spans follow one another without gaps."""
        ids, bounds, _ = self.project(*self.segmented(text))
        return ids, list(zip(bounds[:-1].tolist(), bounds[1:].tolist()))

    def decode(self, ids: list[int]) -> str:
        """Surfaces joined; bytes of no valid character become U+FFFD each; the dummy prefix goes."""
        surface = self.surface
        runs = [ids]
        if self.controls.intersection(ids):  # an invisible id still ends a run of bytes
            runs = [[]]
            for i in ids:
                runs.append([]) if i in self.controls else runs[-1].append(i)
        text = "".join([b"".join(map(surface.__getitem__, run)).decode("utf-8", "saltmarsh.bytewise") for run in runs])
        return text[1:] if self.prefix and text.startswith(" ") and self._leads_with_space(ids) else text

    def _leads_with_space(self, ids: list[int]) -> bool:
        """Whether the first visible id is a piece that begins with a space (a space from byte fallback stays)."""
        for i in ids:
            if self.surface[i]:
                return self.surface[i].startswith(b" ") and i not in self._byte_ids()
        return False

    def _byte_ids(self) -> set[int]:
        return set(self.bytes.values()) | {self.unknown}


def _encoded(docs: DataFrame, model: bytes | None, id_column: str, text: str, schema: str, made: Callable[[Codec, list[tuple]], list[pa.Array]]) -> DataFrame:
    """Documents encoded a few hundred at a time: made takes (ids, bounds, ids as text) of each and gives the columns beside the id."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model or vocabulary("piece_bpe_32k.model"))
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_state(("codec", hash(shared.value)), lambda: Codec(shared.value))
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                found = [codec.segmented(t or "") for t in part.column(1).to_pylist()]
                codec.warm([units for units, _ in found])
                yield pa.RecordBatch.from_arrays([part.column(0), *made(codec, [codec.project(*f) for f in found])], names=names)

    return docs.select(F.col(id_column).cast("long"), F.col(text)).mapInArrow(run, schema)


def _lists(values: list[np.ndarray], inner: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, values)]), pa.int32()), inner)


def encode_documents(docs: DataFrame, model: bytes | None = None, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, spans, decoded): spans as array of struct(begin, end), in bytes of the original text."""

    def made(codec: Codec, rows: list[tuple]) -> list[pa.Array]:
        begin, end = (np.concatenate([r[1][cut] for r in rows] or [[]]).astype(np.int32) for cut in (slice(None, -1), slice(1, None)))
        spans = pa.StructArray.from_arrays([pa.array(begin), pa.array(end)], names=["begin", "end"])
        ids = [r[0] for r in rows]
        return [pa.array(ids, pa.list_(pa.int32())), _lists(ids, spans), pa.array([codec.decode(i) for i in ids], pa.string())]

    return _encoded(docs, model, id_column, text, "doc_id long, ids array<int>, spans array<struct<begin:int,end:int>>, decoded string", made)


def digest_documents(docs: DataFrame, model: bytes | None = None, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The same encoding, its ids and decoded text reduced to digests where they are made.

    bounds are the places in the original bytes that part the pieces: the span of piece i is bounds[i] to bounds[i + 1].
    """

    def made(codec: Codec, rows: list[tuple]) -> list[pa.Array]:
        hexes = [[sha256(x.encode()).hexdigest() for x in column] for column in ([r[2] for r in rows], [codec.decode(r[0]) for r in rows])]
        bounds = [r[1] for r in rows]
        flat = pa.array(np.concatenate(bounds or [[]]).astype(np.int32))
        return [pa.array([len(r[0]) for r in rows], pa.int64()), *[pa.array(h, pa.string()) for h in hexes], _lists(bounds, flat)]

    return _encoded(docs, model, id_column, text, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, bounds array<int>", made)
