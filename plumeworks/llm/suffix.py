"""Removal of repeated 50-byte strings by a hash-compared suffix sort.

Every byte of a text that lies in a ``WIDTH``-byte string which also starts in a text with a smaller id is removed. The
work goes to where repeats can be:

1. Equal texts form one *unit*, named by its SHA-256, with the smallest id of its rows. A later row of a unit is removed
   whole (if it has ``WIDTH`` bytes at all), so only units are compared.
2. Each string of ``WIDTH`` bytes has an *anchor*: the leftmost of its ``GRAM``-byte pieces with the smallest hash. Equal
   strings have equal anchors at equal places. Anchor hashes are dealt out by ranges; those found in one unit only end
   here. No string is missed: this is a bound on where suffixes can agree, not a sample.
3. For the others, the bytes around the anchor travel to the anchor's partition. There the suffixes that start a string
   with this anchor at the same place are sorted by mergesort. Two suffixes are compared by their common extension, found
   by binary search over prefix polynomial hashes; neighbours with an extension of ``WIDTH`` are equal, which is then
   verified on the bytes. The smallest id of a run of equal suffixes owns the string.
4. Equal stretches around an anchor are collapsed before they are dealt out and again before the sort: all but the
   one with the smallest id are removed for certain. A passage in a third of all texts is sent once per batch.

Defined results: see :func:`remove_repeats`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .texts import PIECE, mix, piece_hash, prefix_sums

WIDTH, GRAM = 50, 26
_SPAN = WIDTH - GRAM + 1
#: Anchors of a part, of which a task holds one at a time; texts, and stretches around anchors, that a task works on at a time.
PART, TEXTS, STEP = 200_000, 512, 4_000
#: Rows that leave a task at a time.
ROWS = 50_000
_LOW = np.uint64((1 << 24) - 1)


# ---- anchors ---------------------------------------------------------------------------------------------------------


@dataclass
class Anchors:
    """Stretches of neighbouring string starts with one anchor: text number, first start, how many, distance from the first
    start to the anchor, and the anchor's hash."""

    text: np.ndarray
    start: np.ndarray
    count: np.ndarray
    lead: np.ndarray
    hash: np.ndarray

    def take(self, which: np.ndarray) -> Anchors:
        return Anchors(self.text[which], self.start[which], self.count[which], self.lead[which], self.hash[which])


def _anchors_of(data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    n = len(data)
    prefix = prefix_sums(data)
    at = np.arange(n - GRAM + 1)
    grams = mix(piece_hash(prefix, at, at + GRAM))
    best = (grams & ~_LOW) | at.astype(np.uint64)
    reach = 1
    while reach * 2 <= _SPAN:
        best = np.minimum(best[: len(best) - reach], best[reach:])
        reach *= 2
    rest = _SPAN - reach
    if rest:
        best = np.minimum(best[: len(best) - rest], best[rest:])
    ends = np.cumsum(sizes)
    fits = np.ones(len(best), dtype=bool)
    for end in ends[:-1]:
        fits[max(0, end - WIDTH + 1) : end] = False
    starts = np.flatnonzero(fits)
    if not len(starts):
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4)) + (np.zeros(0, np.uint64),)
    where = (best[starts] & _LOW).astype(np.int64)
    fresh = np.ones(len(starts), dtype=bool)
    fresh[1:] = (where[1:] != where[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(fresh)
    counts = np.diff(np.append(first, len(starts)))
    begin = starts[first]
    text = np.searchsorted(ends, begin, "right")
    return text, begin - (ends - sizes)[text], counts, where[first] - begin, grams[where[first]]


def anchors(texts: list[bytes]) -> Anchors:
    """The anchors of all strings of all texts. Small texts go together, long ones in overlapping pieces."""
    parts: list[tuple[np.ndarray, ...]] = []
    group: list[tuple[int, bytes, int]] = []
    held = 0

    def flush() -> None:
        nonlocal held
        if group:
            text, start, *rest = _anchors_of(np.frombuffer(b"".join(b for _, b, _ in group), dtype=np.uint8), np.array([len(b) for _, b, _ in group]))
            numbers, shifts = np.array([i for i, _, _ in group]), np.array([s for _, _, s in group])
            parts.append((numbers[text], start + shifts[text], *rest))
        group.clear()
        held = 0

    for i, raw in enumerate(texts):
        for at in range(0, max(0, len(raw) - WIDTH + 1), PIECE):
            piece = raw[at : at + PIECE + WIDTH - 1]
            group.append((i, piece, at))
            held += len(piece)
            if held >= PIECE:
                flush()
    flush()
    if not parts:
        return Anchors(*(np.zeros(0, dtype=np.int64) for _ in range(4)), np.zeros(0, np.uint64))
    return Anchors(*(np.concatenate(x) for x in zip(*parts)))


def _part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return (((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def _short(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _bundle(*arrays: np.ndarray) -> bytes:
    return np.array([len(a) for a in arrays], dtype=np.int64).tobytes() + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def _unbundle(data: bytes, *kinds: str) -> list[np.ndarray]:
    sizes = np.frombuffer(data, dtype=np.int64, count=len(kinds))
    out, at = [], 8 * len(kinds)
    for n, kind in zip(sizes, kinds):
        out.append(np.frombuffer(data, dtype=kind, count=int(n), offset=at))
        at += int(n) * np.dtype(kind).itemsize
    return out


def _groups(keys: np.ndarray) -> np.ndarray:
    """Starts of runs of equal values in a sorted array."""
    if not len(keys):
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))


# ---- hash-compared suffix sort ---------------------------------------------------------------------------------------


def common_extension(prefix: np.ndarray, a: np.ndarray, b: np.ndarray, limit: int = WIDTH) -> np.ndarray:
    """How many bytes (at most ``limit``) the suffixes at a and b share: binary search over equal prefix hashes."""
    low, high = np.zeros(len(a), dtype=np.int64), np.full(len(a), limit, dtype=np.int64)
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high + 1) // 2
        same = piece_hash(prefix, a, a + middle) == piece_hash(prefix, b, b + middle)
        low, high = np.where(open_ & same, middle, low), np.where(open_ & ~same, middle - 1, high)


def suffix_sort(data: np.ndarray, prefix: np.ndarray, start: np.ndarray, group: np.ndarray, limit: int = WIDTH) -> np.ndarray:
    """Order of the suffixes by their first ``limit`` bytes within each group (``group`` ascending): a mergesort of all
    groups side by side. ``limit`` bytes must exist after every start."""
    n = len(start)
    order = np.arange(n)
    if not n:
        return order
    whole = piece_hash(prefix, start, start + limit)
    first = _groups(group)
    sizes = np.diff(np.append(first, n))
    low_of, high_of = np.repeat(first, sizes), np.repeat(first + sizes, sizes)
    size_of = np.repeat(sizes, sizes)
    width = 1
    while True:
        p = np.flatnonzero(size_of > width)
        if not len(p):
            return order
        low, end = low_of[p], high_of[p]
        run = (p - low) // width
        other = low + (run ^ 1) * width
        stop = np.minimum(other + width, end)
        a, b = np.minimum(other, stop), stop
        mine, right = order[p], (run & 1) == 1
        while True:
            live = np.flatnonzero(a < b)
            if not len(live):
                break
            middle = (a[live] + b[live]) // 2
            theirs, own = order[middle], mine[live]
            equal = whole[theirs] == whole[own]
            before = equal & right[live]
            d = np.flatnonzero(~equal)
            if len(d):
                x, y = start[theirs[d]], start[own[d]]
                shared = np.minimum(common_extension(prefix, x, y, limit), limit - 1)
                before[d] = data[x + shared] < data[y + shared]
            a[live] = np.where(before, middle + 1, a[live])
            b[live] = np.where(before, b[live], middle)
        fresh = order.copy()
        fresh[low + (run // 2) * 2 * width + (p - low - run * width) + (a - np.minimum(other, stop))] = mine
        order = fresh
        width *= 2


def _same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether size bytes at a and b are equal, looked at byte by byte."""
    out = np.ones(len(a), dtype=bool)
    widest = int(size.max()) if len(size) else 0
    step = np.arange(widest, dtype=np.int32)
    for at in range(0, len(a), 8_192):
        s = slice(at, at + 8_192)
        on = step[None, :] < size[s, None]
        x, y = (np.where(on, v[s, None].astype(np.int32) + step, 0) for v in (a, b))
        out[s] = ((data[x] == data[y]) | ~on).all(1)
    return out


@dataclass
class Stretches:
    """Bytes around anchors: number of the unit, first start in its text, count of starts, lead, anchor hash, id, and where
    the bytes (count + WIDTH - 1 of them) stand in ``data``."""

    unit: np.ndarray
    start: np.ndarray
    count: np.ndarray
    lead: np.ndarray
    hash: np.ndarray
    doc: np.ndarray
    at: np.ndarray
    data: np.ndarray

    def take(self, which: np.ndarray) -> Stretches:
        return Stretches(self.unit[which], self.start[which], self.count[which], self.lead[which], self.hash[which], self.doc[which], self.at[which], self.data)


def collapse(s: Stretches, prefix: np.ndarray) -> np.ndarray:
    """Which stretches equal, byte for byte, one with a smaller id: all their strings are repeats."""
    size = s.count + WIDTH - 1
    key = mix(piece_hash(prefix, s.at, s.at + size) + mix(s.hash + (s.count * 64 + s.lead).astype(np.uint64)))
    order = np.lexsort((s.doc, key))
    first = _groups(key[order])
    head = order[np.repeat(first, np.diff(np.append(first, len(order))))]
    later = np.flatnonzero((s.doc[order] > s.doc[head]) & (s.count[order] == s.count[head]))
    same = _same_bytes(s.data, s.at[order[later]], s.at[head[later]], size[order[later]])
    out = np.zeros(len(order), dtype=bool)
    out[order[later[same]]] = True
    return out


def repeated_strings(s: Stretches, prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(stretch, offset) of every string that also starts at a smaller id, by the suffix sort."""
    none = np.zeros(0, dtype=np.int64)
    owner = np.repeat(np.arange(len(s.unit)), s.count)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(s.count) - s.count, s.count)
    key = mix(s.hash[owner] + mix((s.lead[owner] - step).astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    first = _groups(key[order])
    sizes = np.diff(np.append(first, len(order)))
    order = order[np.repeat(sizes > 1, sizes)]
    if not len(order):
        return none, none
    owner, step, key = owner[order], step[order], key[order]
    start = s.at[owner] + step
    rank = suffix_sort(s.data, prefix, start, key)
    start, owner, step, key = start[rank], owner[rank], step[rank], key[rank]
    whole = piece_hash(prefix, start, start + WIDTH)
    joined = np.zeros(len(start), dtype=bool)  # equal to the one before
    joined[1:] = (key[1:] == key[:-1]) & (whole[1:] == whole[:-1])
    claimed = np.flatnonzero(joined)
    wrong = claimed[~_same_bytes(s.data, start[claimed - 1], start[claimed], np.full(len(claimed), WIDTH))]
    if len(wrong):  # a hash collision: these groups are put in order by their bytes
        for k in np.unique(key[wrong]):
            at = np.flatnonzero(key == k)
            texts = [s.data[x : x + WIDTH].tobytes() for x in start[at]]
            turn = sorted(range(len(at)), key=texts.__getitem__)
            start[at], owner[at], step[at] = start[at][turn], owner[at][turn], step[at][turn]
            joined[at] = [i > 0 and texts[turn[i]] == texts[turn[i - 1]] for i in range(len(at))]
    runs = np.flatnonzero(~joined)
    doc = s.doc[owner]
    least = np.repeat(np.minimum.reduceat(doc, runs), np.diff(np.append(runs, len(doc))))
    hit = doc > least
    return owner[hit], step[hit]


def _ranges(unit: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit, first byte and end of the runs of strings that touch."""
    order = np.lexsort((start, unit))
    unit, start = unit[order], start[order]
    fresh = np.ones(len(unit), dtype=bool)
    fresh[1:] = (unit[1:] != unit[:-1]) | (start[1:] > start[:-1] + WIDTH)
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(unit)) - 1
    return unit[first], start[first], (start[last] + WIDTH) if len(first) else start[:0]


def _expand(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    return np.repeat(start, count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)


# ---- Spark ------------------------------------------------------------------------------------------------------------

_ROW = ["part", "k1", "k2", "data"]
_ROW_SCHEMA = "part int, k1 long, k2 long, data binary"


def _by_part(rows: DataFrame, parts: int) -> DataFrame:
    """Rows of a part stand together, part after part, in as many tasks as the session shuffles to."""
    tasks = min(parts, max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return rows.repartitionById(tasks, F.pmod("part", F.lit(tasks)).cast("int")).sortWithinPartitions("part")


def _parts(rows: Iterator[tuple[int, bytes]]) -> Iterator[tuple[int, list[bytes]]]:
    """(part, data of its rows), holding one part."""
    part, held = -1, []
    for p, data in rows:
        if p != part and held:
            yield part, held
            held = []
        part = p
        held.append(data)
    if held:
        yield part, held


def _range_rows(k1: np.ndarray, k2: np.ndarray, parts: int, unit: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows that carry finished ranges; they pass by the sort."""
    first = _groups(unit)
    ends = np.append(first[1:], len(unit))
    some = unit[first]
    if len(first):
        data = [_bundle(low[a:b].astype(np.int32), high[a:b].astype(np.int32)) for a, b in zip(first, ends)]
        yield pa.RecordBatch.from_arrays([pa.array((np.abs(k1[some] % parts)).astype(np.int32)), pa.array(k1[some]), pa.array(k2[some]), pa.array(data, pa.binary())], _ROW)


def _row_batches(names: list[str], *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(columns[0]), ROWS):
        yield pa.RecordBatch.from_arrays([pa.array(c[at : at + ROWS]) for c in columns], names)


def _span(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """A range as one number."""
    return (low.astype(np.int64) << 32) | high.astype(np.int64)


def _shared_anchors(units: DataFrame, parts: int) -> DataFrame:
    """k1, k2, found: for each unit the names of the anchors that other units have too.

    A task gives a row for each anchor of a unit, not for each unit and part: there are more parts in a larger table, and rows for
    each would grow with units times parts.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, TEXTS) for whole in batches for at in range(0, whole.num_rows, TEXTS)):
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            _, keep = np.unique(np.stack([k1, k2], 1), axis=0, return_index=True)
            keep = np.sort(keep)
            texts = [t.encode("utf-8", "surrogatepass") for t in batch.column(2).take(pa.array(keep)).to_pylist()]
            found = anchors(texts)
            part = _part_of(found.hash, parts)
            short = _short(found.hash)
            order = np.lexsort((short, found.text, part))
            part, text, short = part[order], found.text[order], short[order]
            fresh = np.ones(len(part), dtype=bool)
            fresh[1:] = (part[1:] != part[:-1]) | (text[1:] != text[:-1]) | (short[1:] != short[:-1])
            part, text, short = part[fresh], text[fresh], short[fresh]
            rows = []
            for a, b in zip(first := _groups(part), np.append(first[1:], len(part))):
                heads = a + _groups(text[a:b])
                who = keep[text[heads]]
                rows.append((int(part[a]), _bundle(k1[who], k2[who], np.diff(np.append(heads, b)).astype(np.int32), short[a:b])))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["part", "data"])

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((p.as_py(), d.as_py()) for batch in batches for p, d in zip(batch.column(0), batch.column(1)))
        for p, held in _parts(rows):
            k1, k2, counts, short = (np.concatenate(x) for x in zip(*(_unbundle(d, "<i8", "<i8", "<i4", "<u4") for d in held)))
            unit = np.repeat(np.arange(len(k1), dtype=np.int32), counts)
            order = np.argsort(short, kind="stable").astype(np.int32)
            first = _groups(short[order])
            name = k1[unit[order]]
            live = np.repeat(np.minimum.reduceat(name, first) != np.maximum.reduceat(name, first), np.diff(np.append(first, len(order)))) if len(first) else np.zeros(0, bool)
            hit = order[live]
            turn = np.lexsort((short[hit], k2[unit[hit]], k1[unit[hit]]))
            hit = hit[turn]
            a, b, h = k1[unit[hit]], k2[unit[hit]], short[hit]
            fresh = np.ones(len(h), dtype=bool)  # copies of a text in several batches are one unit
            fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (h[1:] != h[:-1])
            yield from _row_batches(["k1", "k2", "name"], a[fresh], b[fresh], (p << 32) | h[fresh].astype(np.int64))

    dealt = units.select("k1", "k2", "text").mapInArrow(emit, "part int, data binary")
    rows = _by_part(dealt, parts).mapInArrow(shared, "k1 long, k2 long, name long")
    return rows.groupBy("k1", "k2").agg(F.collect_list("name").alias("found"))


def _stretch_rows(units: DataFrame, parts: int) -> DataFrame:
    """The bytes around shared anchors, dealt by anchor; stretches that repeat within a batch are settled here."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, TEXTS):
                batch = whole.slice(low, TEXTS)
                k1, k2, doc = (batch.column(i).to_numpy() for i in range(3))
                texts = [t.encode("utf-8", "surrogatepass") for t in batch.column(3).to_pylist()]
                known = [row.values.to_numpy() for row in batch.column(4)]
                found = anchors(texts)
                names = (_part_of(found.hash, parts) << 32) | _short(found.hash).astype(np.int64)
                shared = np.zeros(len(names), dtype=bool)
                for i, (a, b) in enumerate(zip(np.searchsorted(found.text, np.arange(len(texts))), np.searchsorted(found.text, np.arange(len(texts)), "right"))):
                    shared[a:b] = np.isin(names[a:b], known[i])
                found = found.take(np.flatnonzero(shared))
                sizes = np.array([len(t) for t in texts])
                offsets = np.cumsum(sizes) - sizes
                data = np.frombuffer(b"".join(texts), dtype=np.uint8)
                # only the bytes of the stretches, one after the other
                need = found.count + WIDTH - 1
                packed = data[_expand(offsets[found.text] + found.start, need)] if len(need) else data[:0]
                s = Stretches(found.text, found.start, found.count, found.lead, found.hash, doc[found.text], np.cumsum(need) - need, packed)
                gone = collapse(s, prefix_sums(packed))
                yield from _range_rows(k1, k2, parts, *_ranges(np.repeat(s.unit[gone], s.count[gone]), _expand(s.start[gone], s.count[gone])))
                s = s.take(np.flatnonzero(~gone))
                part = _part_of(s.hash, parts)
                order = np.lexsort((s.unit, part))
                s, part = s.take(order), part[order]
                rows = []
                for a, b in zip(first := _groups(part), np.append(first[1:], len(part))):
                    units_here, index = np.unique(s.unit[a:b], return_inverse=True)
                    bytes_here = packed[_expand(s.at[a:b], s.count[a:b] + WIDTH - 1)]
                    rows.append((int(part[a]), _bundle(k1[units_here], k2[units_here], doc[units_here], index.astype(np.int32), s.start[a:b].astype(np.int32), s.count[a:b].astype(np.uint8), s.lead[a:b].astype(np.uint8), s.hash[a:b], bytes_here)))
                if rows:
                    none = pa.nulls(len(rows), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), none, none, pa.array([r[1] for r in rows], pa.binary())], _ROW)

    return units.select("k1", "k2", "doc_id", "text", "found").mapInArrow(emit, _ROW_SCHEMA)


_KINDS = ("<i8", "<i8", "<i8", "<i4", "<i4", "u1", "u1", "<u8", "u1")


def _sorted_ranges(dealt: DataFrame, parts: int) -> DataFrame:
    """k1, k2, span: a row for each range of removed bytes. Each partition sorts the suffixes of its anchors."""
    names = ["k1", "k2", "span"]

    def single(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """The ranges of finished rows."""
        held = [_unbundle(d.as_py(), "<i4", "<i4") for d in rows.column(3)]
        if held:
            sizes = np.array([len(low) for low, _ in held])
            k1, k2 = (np.repeat(rows.column(i).to_numpy(), sizes) for i in (1, 2))
            yield from _row_batches(names, k1, k2, _span(*(np.concatenate(x) for x in zip(*held))))

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finished: list[pa.RecordBatch] = []

        def open_rows() -> Iterator[tuple[int, bytes]]:
            for batch in batches:
                done = batch.column(1).is_valid()
                finished.append(batch.filter(done))
                for p, data, d in zip(batch.column(0), batch.column(3), done.to_pylist()):
                    if not d:
                        yield p.as_py(), data.as_py()

        for p, held in _parts(open_rows()):
            while finished:
                yield from single(finished.pop())
            pieces = [_unbundle(d, *_KINDS) for d in held]
            shift = np.cumsum([0, *(len(x[0]) for x in pieces)])
            k1, k2, doc = (np.concatenate([x[i] for x in pieces]) for i in range(3))
            unit = np.concatenate([x[3].astype(np.int64) + d for x, d in zip(pieces, shift)])
            start, count, lead = (np.concatenate([x[i].astype(np.int64) for x in pieces]) for i in (4, 5, 6))
            hashes, data = np.concatenate([x[7] for x in pieces]), np.concatenate([x[8] for x in pieces])
            del pieces
            need = count + WIDTH - 1
            s = Stretches(unit, start, count, lead, hashes, doc[unit], np.cumsum(need) - need, data)
            # some anchors at a time, so that strings and hashes of a step stay small
            order = np.argsort(hashes, kind="stable")
            cuts = [0]
            for edge in np.append(_groups(hashes[order])[1:], len(order)):
                if edge - cuts[-1] >= STEP or edge == len(order):
                    cuts.append(int(edge))
            for a, b in zip(cuts, cuts[1:]):
                part = s.take(order[a:b])
                size = part.count + WIDTH - 1
                small = Stretches(part.unit, part.start, part.count, part.lead, part.hash, part.doc, np.cumsum(size) - size, data[_expand(part.at, size)])
                prefix = prefix_sums(small.data)
                gone = collapse(small, prefix)
                rest = small.take(np.flatnonzero(~gone))
                owner, step = repeated_strings(rest, prefix)
                units = np.concatenate([np.repeat(small.unit[gone], small.count[gone]), rest.unit[owner]])
                starts = np.concatenate([_expand(small.start[gone], small.count[gone]), rest.start[owner] + step])
                found, low, high = _ranges(units, starts)
                yield from _row_batches(names, k1[found], k2[found], _span(low, high))
        while finished:
            yield from single(finished.pop())

    return _by_part(dealt, parts).mapInArrow(sort, "k1 long, k2 long, span long")


def _cut(units: DataFrame) -> DataFrame:
    """k1, k2, removed, spans, kept: the outcome of each unit with removed ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, TEXTS) for whole in batches for at in range(0, whole.num_rows, TEXTS)):
            rows = []
            for text, ranges in zip(batch.column(3).to_pylist(), batch.column(4)):
                raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
                step = np.zeros(len(raw) + 1, dtype=np.int32)
                spans = ranges.values.to_numpy()
                np.add.at(step, spans >> 32, 1)
                np.add.at(step, spans & 0xFFFFFFFF, -1)
                gone = np.cumsum(step[:-1]) > 0
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                rows.append((int(gone.sum()), spans, hashlib.sha256(raw[~gone].tobytes()).hexdigest()))
            if rows:
                removed, spans, kept = zip(*rows)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept)], ["k1", "k2", "removed", "spans", "kept"])

    # the same columns of the units as before, so that their shuffle is used again
    return units.select("k1", "k2", "doc_id", "text", "ranges").mapInArrow(run, "k1 long, k2 long, removed long, spans long, kept string")


def remove_repeats(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of ``documents``.

    Strings are judged on the texts as they came. A null text is empty. Rows with one id don't remove from each other,
    whether their texts are equal or not. A row with a null id keeps all its bytes and removes none elsewhere. An empty
    table gives an empty result; other columns are not read.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    sha = F.sha2(text.cast("binary"), 256)
    named = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"), sha.alias("sha"))
    named = named.withColumn("k1", F.xxhash64("sha")).withColumn("k2", F.xxhash64(F.lit(1), "sha"))
    long_ones = named.where((F.col("n_bytes") >= WIDTH) & F.col("doc_id").isNotNull())
    total = long_ones.agg(F.sum("n_bytes")).first()[0] or 0
    parts = max(1, -(-2 * total // ((_SPAN + 1) * PART)))  # a text has about 2 anchors in _SPAN + 1 bytes
    found = _shared_anchors(long_ones, parts)
    # one text a unit; copies meet in the map tasks before they travel
    units = long_ones.groupBy("k1", "k2").agg(F.min("doc_id").alias("doc_id"), F.any_value("text").alias("text"))
    ranges = _sorted_ranges(_stretch_rows(units.join(found, ["k1", "k2"]), parts), parts)
    cut = _cut(units.join(ranges.groupBy("k1", "k2").agg(F.collect_list("span").alias("ranges")), ["k1", "k2"]))
    outcome = materialise(cut, "repeats")
    firsts = named.where("doc_id IS NOT NULL").groupBy("k1", "k2").agg(F.min("doc_id").alias("first"))
    rows = named.select("doc_id", "n_bytes", "sha", "k1", "k2").join(firsts, ["k1", "k2"], "left").join(outcome, ["k1", "k2"], "left")
    later = F.coalesce((F.col("doc_id") > F.col("first")) & (F.col("n_bytes") >= WIDTH), F.lit(False))
    mine = F.col("removed").isNotNull() & F.col("doc_id").isNotNull()
    return rows.select(
        "doc_id", "n_bytes",
        F.when(later, F.col("n_bytes")).when(mine, F.col("removed")).otherwise(F.lit(0)).cast("long").alias("n_removed"),
        F.when(later, F.lit(1)).when(mine, F.col("spans")).otherwise(F.lit(0)).cast("long").alias("n_spans"),
        F.when(later, F.lit(hashlib.sha256(b"").hexdigest())).when(mine, F.col("kept")).otherwise(F.col("sha")).alias("kept_sha256"),
    )


ORACLE = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
g AS (SELECT doc_id, i, substr(h, 2 * i + 1, {2 * WIDTH}) AS s FROM (SELECT doc_id, h, unnest(range(greatest(length(h) // 2 - {WIDTH - 1}, 0))) AS i FROM d)),
f AS (SELECT s, min(doc_id) AS least FROM g GROUP BY s),
r AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM g JOIN f USING (s) WHERE least < doc_id),
n AS (SELECT *, sum(CASE WHEN before IS NULL OR i > before + {WIDTH} THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM r),
spans AS (SELECT doc_id, run, min(i) AS low, max(i) + {WIDTH} AS high FROM n GROUP BY doc_id, run),
gaps AS (SELECT doc_id, low, high, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS after FROM spans),
cut AS (SELECT doc_id, sum(high - low) AS n_removed, count(*) AS n_spans, string_agg(substr(h, 2 * after + 1, 2 * (low - after)), '' ORDER BY low) || substr(any_value(h), 2 * max(high) + 1) AS kept
  FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""
