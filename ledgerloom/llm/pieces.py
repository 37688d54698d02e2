"""SentencePiece BPE with the place of every piece in the source.

The text is normalised by longest prefixes through the model's compiled character map,
which records for each normalised byte the source byte it comes from. Pieces are merged
on the normalised text and their ends taken back through that record, so that the pieces
of a text tile its UTF-8 bytes.

No merge can cross a place that no piece of the vocabulary holds inside, as before a
space or beside a line feed. There the text falls into units, which repeat a lot: a task
merges each different unit once, all new ones of a slice of texts in step, and keeps what
they gave.
"""

from __future__ import annotations

import codecs
import heapq
import re
import struct
from collections.abc import Iterator
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from ledgerloom.llm.common import beside, over_slices

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)
#: Units of a generation: those of this and the last are kept. Only speed depends on it.
KEPT_UNITS = 100_000
#: Characters up to which units are merged in step, and how many at a time.
SHORT_UNIT, UNITS_IN_STEP = 60, 4_096

#: Characters of text taken at a time: each word of them is a string of its own meanwhile.
ENCODED_CHARS = 500_000

#: The rank of a pair that doesn't merge.
NEVER = np.iinfo(np.int64).max

codecs.register_error("each", lambda e: ("�" * (e.end - e.start), e.end))


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a serialised protocol buffer."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, data[at : at + size]
        at += size


class CharacterMap:
    """The compiled map: a double-array trie over UTF-8 keys, and the texts they become."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if size else []
        self.texts = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """What the longest key at ``at`` becomes, and the key's length."""
        if not self.units:
            return None
        best, unit = None, self.units[0]
        node = _below(unit)
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= _below(unit)
            if unit >> 8 & 1:
                best = self.units[node] & 0x7FFFFFFF, i + 1 - at
        if best is None:
            return None
        start = best[0]
        return self.texts[start : self.texts.index(b"\0", start)], best[1]


def _below(unit: int) -> int:
    return (unit >> 10) << ((unit & 512) >> 6)


class PieceModel:
    """A BPE model file: pieces, their order of merging, and the normaliser's rules."""

    def __init__(self, data: bytes):
        self.pieces: list[str] = []
        self.kinds: list[int] = []
        scores: list[float] = []
        norm, trainer = {}, {}
        for field, value in _fields(data):
            if field == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0])
                self.kinds.append(piece.get(3, NORMAL))
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                norm = dict(_fields(value))
        if trainer.get(3, 1) != 2 or trainer.get(24, 0) or USER_DEFINED in self.kinds:
            raise ValueError("only BPE models without own symbols and with spaces in front")
        self.map = CharacterMap(norm.get(2, b""))
        self.dummy_prefix, self.squeeze = bool(norm.get(3, 1)), bool(norm.get(4, 1))
        self.escape = bool(norm.get(5, 1))
        self.byte_fallback = bool(trainer.get(35, 0))
        self.unk, self.bos, self.eos = trainer.get(40, 0), trainer.get(41, 1), trainer.get(42, 2)
        mergeable = [i for i, k in enumerate(self.kinds) if k in (NORMAL, UNUSED)]
        self.ids = {self.pieces[i]: i for i in mergeable}
        self.order = {self.pieces[i]: -scores[i] for i in mergeable}
        self.byte_ids = {
            int(self.pieces[i][3:5], 16): i for i, k in enumerate(self.kinds) if k == BYTE
        }
        inner = {p for p in self.ids if len(p) > 1}
        lines = "\n" if not any("\n" in p for p in inner) else ""
        words = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in inner)
        self.unit = re.compile(
            (f"{lines}|" if lines else "")
            + (f"{SPACE}*[^{SPACE}{lines}]+|{SPACE}+" if words else f"[^{lines}]+" if lines else ".+"),
            re.DOTALL,
        )
        self.parts: dict[str, tuple[bytes, bytes, bytes]] = {}
        self._number_symbols()
        self.surface = [self._surface(i) for i in range(len(self.pieces))]

    def _number_symbols(self) -> None:
        """Numbers for pieces and for the characters in them, and a table of the pairs that merge.

        A pair is two symbols whose texts together are a piece; its rank is that of the piece.
        """
        self.symbols = list(dict.fromkeys([*self.ids, *(c for p in self.ids for c in p)]))
        self.number = number = {p: i for i, p in enumerate(self.symbols)}
        pairs = sorted(
            (number[p[:k]] * len(number) + number[p[k:]], number[p])
            for p in self.ids
            for k in range(1, len(p))
            if p[:k] in number and p[k:] in number
        )
        self.pairs, self.joined = np.array(pairs, np.int64).reshape(-1, 2).T.copy()
        self.symbol_ids = np.array([self.ids.get(p, -1) for p in self.symbols], "<i4")
        sizes = [(len(p.encode()), 2 * p.count(SPACE)) for p in self.symbols]
        self.symbol_wide = np.array([n for n, _ in sizes], "<u4")
        self.symbol_source = np.array([n - less for n, less in sizes], "<u4")
        self.ranks = np.unique([self.order[p] for p in self.ids], return_inverse=True)[1]

    def _rank_of(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ranks of pairs of symbols and what they become; NEVER for those that don't merge."""
        if not len(self.pairs):
            return np.full(left.shape, NEVER), np.zeros(left.shape, np.int64)
        wanted = left * len(self.symbols) + right
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        real = (self.pairs[at] == wanted) & (left >= 0) & (right >= 0)
        piece = self.joined[at]
        return np.where(real, self.ranks[piece], NEVER), piece

    def merge_in_step(self, units: list[str]) -> Iterator[tuple[list[str], list[str], np.ndarray, np.ndarray]]:
        """The pieces of all units, as ``merge`` finds them, some thousand units at a time.

        Gives units, the texts of symbols by number, the symbols of these units one after
        the other, and how many each unit has. One merge of every unit is done at a time: a
        unit is a row of symbols; of each row the pair of the least rank, the leftmost of
        equals, becomes one symbol and what follows moves up.
        """
        units = sorted(units, key=len)
        n = len(units)
        while n and len(units[n - 1]) > SHORT_UNIT:
            n -= 1
            parts = self._merge_long(units[n])
            names = list(dict.fromkeys(parts))
            number = {p: i for i, p in enumerate(names)}
            flat = np.array([number[p] for p in parts])
            # Numbers of its own: none of them is taken for a symbol of the model.
            yield [units[n]], [""] * len(self.symbols) + names, flat + len(self.symbols), np.array([len(parts)])
        for start in range(0, n, UNITS_IN_STEP):
            some = units[start : min(n, start + UNITS_IN_STEP)]
            yield some, *self._merge_rows(some)

    def _merge_rows(self, units: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        sizes = np.array([len(u) for u in units])
        width = int(sizes.max())
        joined = "".join(units)
        # Characters that no piece has are numbered behind the symbols; they merge with nothing.
        strange = list(dict.fromkeys(c for c in set(joined) if c not in self.number))
        names = self.symbols + strange if strange else self.symbols
        number = self.number | {c: len(self.symbols) + i for i, c in enumerate(strange)} if strange else self.number
        codes = np.fromiter(map(number.__getitem__, joined), np.int64, len(joined))
        live = np.arange(width) < sizes[:, None]
        rows = np.full(live.shape, -1, np.int64)
        rows[live] = codes
        known = np.where(rows < len(self.symbols), rows, -1)
        rank, piece = self._rank_of(known[:, :-1], known[:, 1:])
        done = np.full_like(rows, -1)
        index = np.arange(len(units))
        while len(index):
            best = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(index), np.int64)
            at = np.arange(len(index))
            going = rank[at, best] < NEVER if rank.shape[1] else np.zeros(len(index), bool)
            if not going.all():
                done[index[~going], : rows.shape[1]] = rows[~going]
                index, rows, rank, piece, best = (x[going] for x in (index, rows, rank, piece, best))
                at = np.arange(len(index))
                if not len(index):
                    break
            new = piece[at, best]
            # A merged pair takes a place less: what lies behind it moves up by one.
            behind = np.arange(rank.shape[1]) > best[:, None]
            rows = np.where(behind, rows[:, 1:], rows[:, :-1])
            rows[at, best] = new
            # The pair at a place is now the one that was behind it.
            rank = np.where(behind[:, 1:], rank[:, 1:], rank[:, :-1])
            piece = np.where(behind[:, 1:], piece[:, 1:], piece[:, :-1])
            for place, ok in ((best - 1, best > 0), (best, best < rank.shape[1])):
                own, col = at[ok], place[ok]
                left, right = rows[own, col], rows[own, col + 1]
                left = np.where(left < len(self.symbols), left, -1)
                right = np.where(right < len(self.symbols), right, -1)
                rank[own, col], piece[own, col] = self._rank_of(left, right)
        return names, done[done >= 0], (done >= 0).sum(axis=1)

    def _surface(self, i: int) -> bytes:
        if self.kinds[i] == CONTROL:
            return b""
        if self.kinds[i] == UNKNOWN:
            return " ⁇ ".encode()
        if self.kinds[i] == BYTE:
            return bytes([int(self.pieces[i][3:5], 16)])
        return self.pieces[i].replace(SPACE, " ").encode()

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text; for each of its bytes and its end, the source byte.

        By longest prefixes of the map, else character by character.
        """
        source = text.encode()
        out, back = bytearray(), []
        mark = SPACE.encode() if self.escape else b" "

        def put(piece: bytes, start: int) -> None:
            piece = piece.replace(b" ", mark)
            out.extend(piece)
            back.extend([start] * len(piece))

        steps, at = [], 0
        while at < len(source):
            found = self.map.longest(source, at)
            if found is None:
                lead = source[at]
                size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                found = source[at : at + size], size
            steps.append((found[0], at))
            at += found[1]
        end = len(source)
        if self.squeeze:
            while steps and not steps[0][0].strip(b" "):
                steps.pop(0)
            start = steps[0][1] if steps else end
        else:
            start = 0
        if source and self.dummy_prefix and (steps or not self.squeeze):
            put(b" ", start)
        after_space = self.squeeze
        for piece, start in steps:
            if after_space:
                piece = piece.lstrip(b" ")
            put(piece, start)
            if piece:
                after_space = self.squeeze and piece.endswith(b" ")
        if self.squeeze:
            while out.endswith(mark):
                end = back[len(out) - len(mark)]
                del out[len(out) - len(mark) :], back[len(out) :]
        return out.decode(), np.array([*back, end], np.int64)

    def merge(self, unit: str) -> list[str]:
        """The pieces of a unit: best pair first, the leftmost of equals."""
        if len(unit) > SHORT_UNIT:
            return self._merge_long(unit)
        order, never = self.order.get, float("inf")
        parts = list(unit)
        rank = [order(a + b, never) for a, b in zip(parts, parts[1:], strict=False)]
        while rank and (best := min(rank)) < never:
            i = rank.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del rank[i]
            if i < len(rank):
                rank[i] = order(parts[i] + parts[i + 1], never)
            if i:
                rank[i - 1] = order(parts[i - 1] + parts[i], never)
        return parts

    def _merge_long(self, unit: str) -> list[str]:
        """The same with a heap, in n log n steps."""
        order = self.order
        parts: list[str | None] = list(unit)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        pairs = [
            (order[a + b], i, a + b)
            for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))
            if a + b in order
        ]
        heapq.heapify(pairs)
        while pairs:
            _, i, joined = heapq.heappop(pairs)
            j = after[i]
            if parts[i] is None or j >= len(parts) or parts[i] + parts[j] != joined:
                continue
            parts[i], parts[j] = joined, None
            after[i] = k = after[j]
            if k < len(parts):
                before[k] = i
                if (pair := joined + parts[k]) in order:
                    heapq.heappush(pairs, (order[pair], i, pair))
            if (h := before[i]) >= 0 and (pair := parts[h] + joined) in order:
                heapq.heappush(pairs, (order[pair], h, pair))
        return [p for p in parts if p is not None]

    def packed(self, piece: str) -> tuple[bytes, bytes, bytes]:
        """Ids of a piece; source bytes of each if only spaces were escaped; normalised bytes."""
        if piece not in self.parts:
            data = piece.encode()
            if piece in self.ids:
                ids, wide = [self.ids[piece]], [len(data)]
            elif self.byte_fallback:
                ids, wide = [self.byte_ids[b] for b in data], [1] * len(data)
            else:
                ids, wide = [self.unk], [len(data)]
            pack = struct.Struct(f"<{len(ids)}I").pack
            source = [len(data) - 2 * piece.count(SPACE)] if len(ids) == 1 else wide
            self.parts[piece] = pack(*ids), pack(*source), pack(*wide)
        return self.parts[piece]

    def decode(self, ids: list[int]) -> str:
        """The text of the ids; the space put in front is taken off again."""
        surface = self.surface
        data = b"".join([surface[i] for i in ids])
        first = next((i for i in ids if self.kinds[i] != CONTROL), None)
        if first is not None and self.kinds[first] in (NORMAL, UNUSED):
            if self.dummy_prefix and self.pieces[first].startswith(SPACE):
                data = data[1:]
        return data.decode("utf-8", "each")


class Encoder:
    """A model with the units it has merged lately. A Python worker keeps it between a job's tasks."""

    def __init__(self, data: bytes):
        self.model = m = PieceModel(data)
        self.new: dict[str, tuple[bytes, bytes]] = {}
        self.old: dict[str, tuple[bytes, bytes]] = {}
        self.head, self.tail = struct.pack("<I", m.bos), struct.pack("<I", m.eos)
        self.plain = not m.map.units and not m.squeeze and m.escape and m.dummy_prefix

    def learn(self, units: set[str]) -> None:
        """Merges the units that aren't kept, all in step."""
        model, new = self.model, self.new
        missing = []
        for unit in units.difference(new):
            found = self.old.get(unit)
            if found is None:
                missing.append(unit)
            else:
                new[unit] = found
        sizes = model.symbol_source if self.plain else model.symbol_wide
        at = 1 if self.plain else 2
        for some, names, flat, counts in model.merge_in_step(missing):
            ends = np.cumsum(counts)
            # Symbols that are no pieces: their ids are those of bytes, or the unknown one.
            known = np.minimum(flat, len(sizes) - 1)
            odd = (flat >= len(sizes)) | (model.symbol_ids[known] < 0)
            if odd.any():
                strange = np.add.reduceat(odd, ends - counts) > 0
            else:
                strange = np.zeros(len(some), bool)
            ids, wide = model.symbol_ids[known].tobytes(), sizes[known].tobytes()
            low, high = (4 * (ends - counts)).tolist(), (4 * ends).tolist()
            for unit, a, b in zip(some, low, high, strict=True):
                new[unit] = ids[a:b], wide[a:b]
            for i in np.flatnonzero(strange).tolist():
                packed = [model.packed(names[s]) for s in flat[ends[i] - counts[i] : ends[i]].tolist()]
                new[some[i]] = b"".join([p[0] for p in packed]), b"".join([p[at] for p in packed])

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Of each text the packed ids, and the packed source ends of their pieces."""
        model, split = self.model, self.model.unit.findall
        normals, backs, units = [], [], []
        for text in texts:
            if not text:
                normal, back = "", None
            elif self.plain and SPACE not in text:
                normal, back = SPACE + text.replace(" ", SPACE), None
            else:
                normal, back = model.normalise(text)
            normals.append(normal)
            backs.append(back)
            units.append(split(normal))
        self.learn(set().union(*units))
        kept, told = self.new, []
        for text, back, own in zip(texts, backs, units, strict=True):
            found = [kept[unit] for unit in own]
            if back is None:
                ends = np.cumsum(np.frombuffer(b"".join([u[1] for u in found]), "<u4")) - 1
                # less 1: the space put in front is in no source
            else:
                wide = [u[1] for u in found]
                if self.plain:  # what is kept are source bytes of texts that weren't normalised
                    wide = [model.packed(p)[2] for u in own for p in model.merge(u)]
                ends = back[np.cumsum(np.frombuffer(b"".join(wide), "<u4"), dtype=np.int64)]
            ids = b"".join([self.head, *[u[0] for u in found], self.tail])
            size = len(text.encode())
            told.append((ids, np.concatenate(([0], ends, [size])).astype("<u4").tobytes()))
        if len(kept) > KEPT_UNITS:
            self.old, self.new = kept, {}
        return told


#: By the broadcast of their model: a worker lets go of a broadcast, and so of the encoder, when it
#: is given a task that doesn't need it. Workers outlive jobs, and their memory is what others lack.
_ENCODERS: WeakKeyDictionary[Broadcast, Encoder] = WeakKeyDictionary()


def _encoder(data: Broadcast):
    if data not in _ENCODERS:
        _ENCODERS[data] = Encoder(data.value)
    encode, model = _ENCODERS[data].encode, _ENCODERS[data].model

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        told = encode([text or "" for text in batch.column("text").to_pylist()])
        ids, ends = [t[0] for t in told], [t[1] for t in told]
        back = [model.decode(np.frombuffer(packed, "<u4").tolist()) for packed in ids]
        kept = {name: batch.column(name) for name in batch.schema.names if name != "text"}
        new = {
            "ids": pa.array(ids, pa.binary()),
            "ends": pa.array(ends, pa.binary()),
            "decoded": pa.array(back, pa.string()),
        }
        return pa.RecordBatch.from_pydict(kept | new)

    return work


def encode_pieces(docs: DataFrame, model: str, key: str = "doc_id") -> DataFrame:
    """Ids, source places and the text decoded again, for the whole text of every row.

    ``model`` is the path of a SentencePiece BPE model, read by the driver; the file's
    size is fixed, so it is broadcast.

    Returns ``key``, ``ids`` (begin and end ids included, packed as unsigned 32-bit
    little-endian numbers), ``ends`` (packed alike: the source byte at which each id's
    piece ends; it starts where the one before ends) and ``decoded``. A null text is
    empty: two ids. Rows are taken one by one, so repeated rows and ties change nothing;
    an empty table gives an empty result; other columns are not read.
    """
    with open(model, "rb") as file:
        data = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(key, "text")
    return rows.mapInArrow(
        over_slices(lambda: _encoder(data), chars=ENCODED_CHARS),
        beside(rows, "text", "ids binary, ends binary, decoded string"),
    )
