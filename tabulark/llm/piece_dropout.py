"""SentencePiece BPE encoding with seeded merge-dropout, and its lossless decoding.

A text is cut where no piece of the model can reach across: before a run of blanks and
around line breaks. Each part then runs the merge agenda: of all neighbouring symbols
whose concatenation is a piece, the one with the best score (leftmost on ties) is taken
next. Dropout skips a candidate when the keyed hash of (seed, document, position, part,
start, middle, end) falls below the rate; the key does not depend on when the candidate
comes up, so reruns agree. Each occurrence of a part decides for itself, however often the
part occurs. Which of its possible candidates an occurrence skips settles its segments, so
occurrences of a batch that skip the same ones are segmented once, all of them in step.
Characters without a piece become byte pieces.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulark.llm.batches import released, slices

PARTS = re.compile(r" *[^ \n]+| +|\n")
MODEL, RATE, SEED, STREAMS = "piece_bpe_32k.model", 0.1, 20_240_601, 0
LONG_PART = 48
BITS, DRAWS = 64, 1 << 18  # candidates of a part that shares work; those looked at together
SHARED = 4  # occurrences in a slice from which a part's segments are shared
MOST_PARTS = 1 << 18  # whose candidates a worker keeps, some 300 bytes each
SLICE_BYTES = 1 << 20  # of texts at a time; a task needs about a hundred times as much
NONE = np.int32((1 << 31) - 1)
U = np.uint64


def mix(x):
    """Finaliser of a 64-bit hash (numpy, wraps around)."""
    x = np.atleast_1d(np.asarray(x, np.uint64))
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Pieces:
    """Vocabulary of one model file: symbols, merges and their order."""

    def __init__(self, name: str = MODEL):
        import public_tokenizers
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(
            model_file=public_tokenizers.path(name)
        )
        size = model.get_piece_size()
        special = [
            model.is_control(i) or model.is_unused(i) or model.is_unknown(i) or model.is_byte(i)
            for i in range(size)
        ]
        names = [model.id_to_piece(i) for i in range(size)]
        self.size = size
        self.ids = {p.replace("▁", " "): i for i, p in enumerate(names) if not special[i]}
        self.byte = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.bytes = [b""] * size
        for p, i in self.ids.items():
            self.bytes[i] = p.encode()
        for b, i in enumerate(self.byte):
            self.bytes[i] = bytes([b])
        # their bytes, one after the other
        self.widths = np.array([len(b) for b in self.bytes], np.int64)
        self.starts = np.cumsum(self.widths) - self.widths
        self.flat = np.frombuffer(b"".join(self.bytes), np.uint8)
        # symbols: pieces, then characters that only occur inside pieces
        self.longest = max(map(len, self.ids), default=0)
        symbols = dict(self.ids)
        for p in self.ids:
            for c in p:
                symbols.setdefault(c, len(symbols) + size)
        self.symbols = symbols
        scores = {i: model.get_score(i) for i in self.ids.values()}
        place = {s: k for k, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for p, i in self.ids.items():
            for cut in range(1, len(p)):
                a, b = symbols.get(p[:cut]), symbols.get(p[cut:])
                if a is not None and b is not None:
                    self.merges[a, b] = (place[scores[i]], i)
        # open addressing: slot of a pair's key, or one of the few after it
        self.table_bits = 19
        self.table = np.full((1 << self.table_bits) + 64, -1, np.int64)
        self.ranks = np.full(len(self.table), NONE, np.int32)
        self.merged = np.full(len(self.table), -1, np.int32)
        keys = np.array([a << 32 | b for a, b in self.merges], np.int64)
        for key, slot, (rank, merged) in zip(
            keys.tolist(), self._slot(keys).tolist(), self.merges.values()
        ):
            while self.table[slot] >= 0:
                slot += 1
            self.table[slot], self.ranks[slot], self.merged[slot] = key, rank, merged
        self.unknown = max([*symbols.values(), size]) + 1

    def _slot(self, key: np.ndarray) -> np.ndarray:
        spread = key.astype(np.uint64) * U(0x9E3779B97F4A7C15)
        return (spread >> U(64 - self.table_bits)).astype(np.int64)

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Table slot of neighbours; where they do not merge, a slot of rank NONE."""
        key = a.astype(np.int64) << 32 | b
        at = self._slot(key)
        found = self.table[at]
        going = np.flatnonzero((found != key) & (found >= 0))
        while len(going):
            at[going] += 1
            found = self.table[at[going]]
            going = going[(found != key[going]) & (found >= 0)]
        return at

    def symbol(self, c: str) -> int:
        """Symbol of a character; a literal lower-block sign is text, not a blank."""
        return self.symbols.get(c, self.unknown) if c != "▁" else self.unknown

    def pieces_of(self, symbol: int, text: str) -> list[int]:
        return [symbol] if symbol < self.size else [self.byte[b] for b in text.encode()]


def part_key(part: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(part)


def candidate_hash(start, middle, end) -> np.ndarray:
    place = np.asarray(start, np.uint64) << U(42) ^ np.asarray(middle, np.uint64) << U(21)
    return mix(place ^ np.asarray(end, np.uint64) ^ U(0x5BD1E995))


def dropped(key, start, middle, end, rate: float):
    """Whether the candidate (start, middle, end) of a part under ``key`` is skipped."""
    h = mix(np.asarray(key, np.uint64) ^ candidate_hash(start, middle, end))
    return (h >> U(11)).astype(np.float64) < rate * float(1 << 53)


def agenda(p: Pieces, part: str, key: int, rate: float) -> list[int]:
    """Segment one part with a heap: for parts too long to run in step with others."""
    n = len(part)
    symbol = [p.symbol(c) for c in part]
    end = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    heap: list[tuple[int, int, int, int, int]] = []

    def push(pairs: list[tuple[int, int]]) -> None:
        found = [(a, b, p.merges[symbol[a], symbol[b]]) for a, b in pairs
                 if (symbol[a], symbol[b]) in p.merges]
        if not found:
            return
        if rate > 0:
            skip = dropped(
                U(key), [a for a, _, _ in found], [b for _, b, _ in found],
                [end[b] for _, b, _ in found], rate,
            )
        else:
            skip = [False] * len(found)
        for (a, b, (rank, merged)), s in zip(found, skip):
            if not s:
                heapq.heappush(heap, (rank, a, b, end[b], merged))

    live = [True] * n
    push([(i, i + 1) for i in range(n - 1)])
    while heap:
        _, a, b, stop, merged = heapq.heappop(heap)
        if not (live[a] and end[a] == b and b < n and live[b] and end[b] == stop):
            continue
        symbol[a], end[a], live[b] = merged, stop, False
        if stop < n:
            before[stop] = a
        pairs = []
        if before[a] >= 0:
            pairs.append((before[a], a))
        if stop < n:
            pairs.append((a, stop))
        push(pairs)
    out: list[int] = []
    at = 0
    while at < n:
        out += p.pieces_of(symbol[at], part[at : end[at]])
        at = end[at]
    return out


def segment(p: Pieces, parts: list[str], keys: np.ndarray, rate: float):
    """Segment many parts in step, one merge of each part's agenda per round.

    Returns (ids, offsets): the pieces of part i are ids[offsets[i]:offsets[i + 1]].
    """
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    # symbols by character position over all parts; -1: inside a longer symbol
    text = "".join(parts)
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    final = np.full(len(points), -1, np.int32)
    long_ = np.flatnonzero(lengths > LONG_PART)
    by_heap = {int(i): agenda(p, parts[i], int(keys[i]), rate) for i in long_}
    counts = np.zeros(len(parts), np.int64)
    short = lengths <= LONG_PART

    known = np.zeros(int(points.max()) + 1 if len(points) else 1, bool)
    known[points] = True
    symbols = np.zeros(len(known), np.int32)
    for c in np.flatnonzero(known).tolist():
        symbols[c] = p.symbol(chr(c))
    owner = np.repeat(np.arange(len(parts), dtype=np.int32), lengths)
    pos = np.flatnonzero(short[owner]).astype(np.int32)
    owner = owner[pos]
    sym = symbols[points[pos]]
    rank = np.full(len(sym), NONE, np.int32)
    todo = np.flatnonzero(owner[1:] == owner[:-1])

    def look(todo: np.ndarray) -> None:
        """Rank of merging each of these symbols with its right neighbour."""
        slot = p.pair(sym[todo], sym[todo + 1])
        r = p.ranks[slot]
        if rate > 0:
            live = np.flatnonzero(r != NONE)
            at = todo[live]
            own = owner[at]
            after = np.append(pos, -1)[at + 2]
            last = (at + 2 >= len(owner)) | (np.append(owner, -1)[at + 2] != own)
            stop = np.where(last, ends[own], after)
            base = starts[own]
            skip = dropped(keys[own], pos[at] - base, pos[at + 1] - base, stop - base, rate)
            r[live[skip]] = NONE
        rank[todo] = r

    if len(todo):
        look(todo)
    while len(sym):
        n = len(sym)
        change = np.empty(n, bool)
        change[0] = True
        np.not_equal(owner[1:], owner[:-1], out=change[1:])
        first = np.flatnonzero(change)
        best = np.minimum.reduceat(rank, first)
        sizes = np.diff(np.append(first, n))
        over = best == NONE
        rows = np.repeat(over, sizes)
        hit = np.flatnonzero((rank == np.repeat(best, sizes)) & ~rows)
        final[pos[rows]] = sym[rows]
        if not len(hit):
            break
        lead = np.empty(len(hit), bool)
        lead[0] = True
        np.not_equal(owner[hit[1:]], owner[hit[:-1]], out=lead[1:])
        a = hit[lead]  # leftmost best candidate of each part
        sym[a] = p.merged[p.pair(sym[a], sym[a + 1])]
        keep = ~rows
        keep[a + 1] = False
        rank[a] = NONE
        a = (np.cumsum(keep) - 1)[a]
        owner, pos, sym, rank = owner[keep], pos[keep], sym[keep], rank[keep]
        left = a[(a > 0) & (owner[a - 1] == owner[a])] - 1
        inside = a[a + 1 < len(owner)]
        right = inside[owner[inside + 1] == owner[inside]]
        rank[left] = NONE
        look(np.concatenate((left, right)))

    at = np.flatnonzero(final >= 0)
    sym = final[at]
    owner = np.repeat(np.arange(len(parts), dtype=np.int32), lengths)[at]
    width = np.ones(len(sym), np.int64)
    odd = np.flatnonzero(sym >= p.size)
    fallback: list[int] = []
    for i in odd.tolist():  # a symbol without a piece is a single character
        found = [p.byte[b] for b in text[at[i]].encode()]
        width[i] = len(found)
        fallback += found
    flat = np.repeat(sym, width)
    flat[np.repeat(sym >= p.size, width)] = fallback
    counts += np.bincount(owner, weights=width, minlength=len(parts)).astype(np.int64)
    for i, found in by_heap.items():
        counts[i] = len(found)
    offsets = np.concatenate(([0], np.cumsum(counts)))
    if not by_heap:
        return flat, offsets
    ids = np.empty(offsets[-1], np.int32)
    rest = np.flatnonzero(short)
    ids[ragged(offsets[:-1][rest], counts[rest])] = flat
    for i, found in by_heap.items():
        ids[offsets[i] : offsets[i + 1]] = found
    return ids, offsets


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions starts[i] .. starts[i] + counts[i] - 1, one run after the other."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)


def candidates(p: Pieces, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets) of all candidates that any merges of each part can bring up; parts
    of more than ``LONG_PART`` characters are left out."""
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    lengths[lengths > LONG_PART] = 0
    text = "".join([x for x in parts if len(x) <= LONG_PART])
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    n = len(points)
    known = np.unique(points)
    names = np.array([p.symbol(chr(c)) for c in known.tolist()], np.int32)
    owner = np.repeat(np.arange(len(parts)), lengths)
    first = (np.cumsum(lengths) - lengths)[owner]
    # symbol of the stretch of each length at each place, -1: none; and where there is one
    symbol = [None, names[np.searchsorted(known, points)]]
    places = [None, np.arange(n)]
    found: list[tuple[np.ndarray, np.ndarray, int]] = []
    for size in range(2, min(p.longest, int(lengths.max(initial=0))) + 1):
        merged = np.full(n, -1, np.int32)
        for k in range(1, size):
            at = places[k]
            at = at[at + size <= n]
            right = symbol[size - k][at + k]
            ok = (right >= 0) & (owner[at] == owner[at + k])
            at, right = at[ok], right[ok]
            slot = p.pair(symbol[k][at], right)
            hit = p.ranks[slot] != NONE
            at = at[hit]
            merged[at] = p.merged[slot[hit]]
            found.append((at, at + k, size))
        symbol.append(merged)
        places.append(np.flatnonzero(merged >= 0))
    at = np.concatenate([np.zeros(0, np.int64), *[f[0] for f in found]])
    middle = np.concatenate([np.zeros(0, np.int64), *[f[1] for f in found]])
    end = at + np.repeat([f[2] for f in found], [len(f[0]) for f in found]).astype(np.int64)
    base = first[at]
    hashes = candidate_hash(at - base, middle - base, end - base)
    order = np.argsort(owner[at], kind="stable")
    counts = np.bincount(owner[at], minlength=len(parts))
    return hashes[order], np.concatenate(([0], np.cumsum(counts)))


def skipped(keys: np.ndarray, code: np.ndarray, hashes, offsets, rate: float) -> np.ndarray:
    """Which of the at most ``BITS`` candidates of part ``code`` each occurrence skips."""
    counts = np.diff(offsets)[code]
    bits = np.zeros(len(code), np.uint64)
    some = np.flatnonzero(counts > 0)
    ends = np.cumsum(counts[some])
    limit = U(int(np.ceil(rate * float(1 << 53))))
    at = 0
    while at < len(some):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + DRAWS, "right")))
        rows = some[at:stop]
        wide = counts[rows]
        place = ragged(offsets[:-1][code[rows]], wide)
        h = mix(np.repeat(keys[rows], wide) ^ hashes[place]) >> U(11)
        start = np.cumsum(wide) - wide
        bit = (np.arange(len(place)) - np.repeat(start, wide)).astype(np.uint64)
        bits[rows] = np.add.reduceat((h < limit).astype(np.uint64) << bit, start)
        at = stop
    return bits


class Parts:
    """Hashes of the possible candidates of parts met before in this worker; starts anew beyond ``MOST_PARTS`` parts. Of a part with more than ``BITS`` candidates
    only that is kept (``wide``)."""

    def __init__(self, p: Pieces):
        self.p = p
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.start, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.wide = np.zeros(0, bool)
        self.hashes = np.zeros(1 << 16, np.uint64)
        self.used = 0

    def look_up(self, names: list[str]):
        """(candidate hashes, how many of each, wide) of distinct parts."""
        if len(self.number) + len(names) > MOST_PARTS:
            self.forget()
        new = [x for x in names if x not in self.number]
        if new:
            self._add(new)
        at = np.fromiter(map(self.number.__getitem__, names), np.int64, len(names))
        counts = self.count[at]
        hashes = self.hashes[ragged(self.start[at], counts)]
        return hashes, counts, self.wide[at]

    def _add(self, new: list[str]) -> None:
        hashes, offsets = candidates(self.p, new)
        counts = np.diff(offsets)
        wide = counts > BITS
        kept = np.where(wide, 0, counts)
        some = hashes[ragged(offsets[:-1], kept)]
        while self.used + len(some) > len(self.hashes):
            self.hashes = np.concatenate((self.hashes, np.zeros_like(self.hashes)))
        self.hashes[self.used:self.used + len(some)] = some
        self.start = np.concatenate((self.start, self.used + np.cumsum(kept) - kept))
        self.count = np.concatenate((self.count, kept))
        self.wide = np.concatenate((self.wide, wide))
        self.used += len(some)
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))


def place_keys(hashes, docs, position, seed: int, streams: int = STREAMS) -> np.ndarray:
    """Key of each occurrence: of a part (its hash) at a position of a document (its number)."""
    doc = mix(np.asarray(docs, np.uint64) ^ mix(U(seed)))
    place = mix(doc + np.asarray(position).astype(np.uint64))
    if streams:
        place %= U(streams)
    return mix(hashes ^ mix(U(seed) + place))


def encode_texts(
    p: Pieces, texts: list[str], docs: list[int], rate: float, seed: int, streams: int = STREAMS,
    known: Parts | None = None,
):
    """(ids, offsets) of the texts; docs: one number per text that seeds its draws; ``known``:
    the parts of earlier calls."""
    found = [PARTS.findall(" " + t) if t else [] for t in texts]
    widths = np.array([len(x) for x in found], np.int64)
    flat = [x for row in found for x in row]
    if not flat:
        return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    names = list(dict.fromkeys(flat))
    numbers = dict(zip(names, range(len(names))))
    code = np.fromiter(map(numbers.__getitem__, flat), np.int64, len(flat))
    # occurrences whose segments are worked out, and for each occurrence which of them it has
    if rate > 0:
        start = np.concatenate(([0], np.cumsum(widths)[:-1]))
        position = np.arange(len(flat)) - np.repeat(start, widths)
        part_keys = np.fromiter(map(part_key, names), np.uint64, len(names))
        keys = place_keys(part_keys[code], np.repeat(np.array(docs, np.uint64), widths), position, seed, streams)
        # a part that comes seldom here has nothing to share: its candidates are not needed
        alone = np.bincount(code, minlength=len(names)) < SHARED
        often = np.flatnonzero(~alone)
        hashes, counts, wide = (known or Parts(p)).look_up([names[i] for i in often.tolist()])
        sizes = np.zeros(len(names), np.int64)
        sizes[often] = counts
        bits = skipped(keys, code, hashes, np.concatenate(([0], np.cumsum(sizes))), rate)
        alone[often] = wide
        alone |= np.fromiter(map(len, names), np.int64, len(names)) > LONG_PART
        alone = alone[code]
        # equal (part, skipped) are one; the others are told apart by their keys
        bits[alone] = keys[alone]
        order = np.lexsort((bits, code))
        new = np.ones(len(order), bool)
        new[1:] = (code[order[1:]] != code[order[:-1]]) | (bits[order[1:]] != bits[order[:-1]])
        worked = order[new]
        inverse = np.empty(len(order), np.int64)
        inverse[order] = np.cumsum(new) - 1
        parts, keys = [flat[i] for i in worked.tolist()], keys[worked]
    else:
        parts, inverse, keys = names, code, np.zeros(len(names), np.uint64)
    ids, offsets = segment(p, parts, keys, rate)
    counts = np.diff(offsets)[inverse]
    out = ids[ragged(offsets[:-1][inverse], counts)]
    per_text = np.zeros(len(texts), np.int64)
    edges = np.concatenate(([0], np.cumsum(counts)))[np.concatenate(([0], np.cumsum(widths)))]
    per_text += np.diff(edges)
    return out, np.concatenate(([0], np.cumsum(per_text)))


def decode_ids(p: Pieces, ids) -> str:
    """Text of a piece list made here: pieces joined, without the blank put in front."""
    data = b"".join([p.bytes[i] for i in ids])
    return data[1:].decode() if data else ""


def lossless(p: Pieces, texts: list[str], ids: np.ndarray, offsets: np.ndarray) -> list[bool]:
    """Whether the pieces of each text, joined, are the text behind a blank."""
    if not len(ids):
        return [not t for t in texts]
    flat = p.flat[ragged(p.starts[ids], p.widths[ids])].tobytes()
    ends = np.concatenate(([0], np.cumsum(p.widths[ids])))[offsets].tolist()
    return [
        flat[a:b] == (b" " + t.encode() if t else b"") for t, a, b in zip(texts, ends, ends[1:])
    ]


_pieces: dict[str, Pieces] = {}
_parts: dict[str, Parts] = {}


def pieces(name: str) -> Pieces:
    if name not in _pieces:
        _pieces[name] = Pieces(name)
        _parts[name] = Parts(_pieces[name])
    return _pieces[name]


def known_parts(name: str) -> Parts:
    """The parts that this worker has met, of one model."""
    pieces(name)
    return _parts[name]


def encode_pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL,
    rate: float = RATE, seed: int = SEED, streams: int = STREAMS,
) -> DataFrame:
    """``id, ids, n_pieces, lossless`` of every row, in one pass without a shuffle.

    A null or empty text has an empty list. ``lossless`` tells whether decoding the list
    gives the text back (a null counts as empty). With ``rate`` 0 the pieces are those of
    the library, but for a literal U+2581, which becomes byte pieces and so survives
    decoding. Equal ids with equal texts are segmented alike; ``streams`` other than 0 lets the
    occurrences of a part share so many draws. Other columns are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    number = F.xxhash64(F.col(id_col))
    rows = docs.select(F.col(id_col).alias("id"), number.alias("n"), F.col(text_col).alias("text"))

    @released
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model)
        for part in slices(batches, "text", SLICE_BYTES):
            texts = [t or "" for t in part.column("text").to_pylist()]
            docs = part.column("n").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            ids, offsets = encode_texts(p, texts, docs, rate, seed, streams, known_parts(model))
            same = lossless(p, texts, ids, offsets)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), lists, pa.array(np.diff(offsets), pa.int64()), pa.array(same)],
                ["id", "ids", "n_pieces", "lossless"],
            )

    found = rows.mapInArrow(
        encode, f"id {id_type}, ids array<int>, n_pieces long, lossless boolean"
    )
    return found.withColumnRenamed("id", id_col)


def decode_pieces(
    encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model: str = MODEL
) -> DataFrame:
    """``id, text`` of every row; a null list gives a null text, an empty one none."""

    @F.pandas_udf("string")
    def decode(ids: pd.Series) -> pd.Series:
        p = pieces(model)
        return ids.map(lambda x: None if x is None else decode_ids(p, x))

    return encoded.select(F.col(id_col), decode(F.col(ids_col)).alias("text"))
