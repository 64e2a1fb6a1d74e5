"""Texts in Arrow batches: a row mapper, and hashes of words and word shingles computed over whole byte buffers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Rows given to a mapper at a time, so that what a batch holds in Python stays small.
SLICE = 512


def per_text(documents: DataFrame, rows: Callable[[list[str | None]], list[tuple]], made: str, key: str = "doc_id", text: str = "text", also: tuple[str, ...] = ()) -> DataFrame:
    """One output row per input row: the key as long, ``also`` as they are, then the columns ``made`` of the texts.

    ``also`` may name the text itself, if it is a string; it is then sent once.
    """
    given = documents.select(F.col(key).cast("long").alias(key), *also, *([] if text in also else [F.col(text).cast("string").alias(text)]))
    kept = len(also) + 1
    schema = StructType(given.schema.fields[:kept] + StructType.fromDDL(made).fields)
    arrow = to_arrow_schema(schema)
    own = given.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                found = rows(batch.column(own).to_pylist())
                columns = [batch.column(k) for k in range(kept)]
                columns += [pa.array([r[k] for r in found], arrow.field(kept + k).type) for k in range(len(arrow) - kept)]
                yield pa.RecordBatch.from_arrays(columns, names=arrow.names)

    return given.mapInArrow(run, schema)


# Hashes below are the sum of table[byte] * BASE**position modulo 2**64, so that any piece follows from two prefix sums.
BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_INVERSE = pow(BASE, -1, 1 << 64)
#: Bytes hashed at a time.
PIECE = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit words (a bijection)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(32))


_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


def powers(n: int, base: int) -> np.ndarray:
    steps = np.full(n, base & _MASK, dtype=np.uint64)
    steps[0] = 1
    return np.cumprod(steps)


_UP: dict[str, np.ndarray] = {}


def _ladder(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _UP or len(_UP["up"]) < n:
        _UP["up"], _UP["down"] = powers(max(n, PIECE + 1), BASE), powers(max(n, PIECE + 1), _INVERSE)
    return _UP["up"], _UP["down"]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """prefix[i]: hash of the first i bytes."""
    up, _ = _ladder(len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_TABLE[data] * up[: len(data)], out=out[1:])
    return out


def piece_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of bytes start to end, independent of where they stand."""
    _, down = _ladder(len(prefix))
    return (prefix[end] - prefix[start]) * down[start]


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(text: bytes) -> np.ndarray:
    """A hash of each word, in order. Words are runs of other bytes than space and 0x09 to 0x0D; A-Z are lower-cased."""
    data = np.frombuffer(text, dtype=np.uint8)
    out = []
    at = 0
    while at < len(data):
        end = min(len(data), at + PIECE)
        if end < len(data):
            gaps = np.flatnonzero(_SPACE[data[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
            else:  # a word longer than a piece
                while end < len(data) and not _SPACE[data[end]]:
                    end += 1
        part = _LOWER[data[at:end]]
        gap = np.ones(len(part) + 2, dtype=bool)
        gap[1:-1] = _SPACE[part]
        turns = np.flatnonzero(gap[1:] != gap[:-1])
        start, stop = turns[::2], turns[1::2]
        if len(start):
            out.append(mix(piece_hash(prefix_sums(part), start, stop) + (stop - start).astype(np.uint64)))
        at = end
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


_ODD = [np.uint64(int(mix(np.array([k], dtype=np.uint64))[0]) | 1) for k in (11, 22, 33, 44, 55)]


def shingle_hashes(words: np.ndarray, size: int = 5) -> np.ndarray:
    """A hash of each run of ``size`` words; with fewer words, one hash of the whole sequence; with none, nothing."""
    if len(words) == 0:
        return words
    width = min(size, len(words))
    total = np.full(len(words) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        total = total * _ODD[k % len(_ODD)] + words[k : len(words) - width + 1 + k]
        total ^= total >> np.uint64(31)
    return mix(total)


def many_shingles(texts: list[str | None], size: int = 5) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, ascending. Small texts are hashed together."""
    out: list[np.ndarray] = [np.zeros(0, dtype=np.uint64)] * len(texts)
    group: list[tuple[int, bytes]] = []
    held = 0

    def flush() -> None:
        nonlocal held
        if not group:
            return
        joint = b"\n".join(b for _, b in group)
        words = word_hashes(joint)
        data = np.frombuffer(joint, dtype=np.uint8)
        space = _SPACE[data]
        begins = ~space
        begins[1:] &= space[:-1]
        ends = np.cumsum([len(b) + 1 for _, b in group])
        counts = np.add.reduceat(begins, np.concatenate(([0], ends[:-1])), dtype=np.int64) if len(data) else np.zeros(len(group), np.int64)
        at = 0
        long_ones = shingle_hashes(words, size) if len(words) >= size else words
        for (i, _), n in zip(group, counts):
            if n >= size:
                own = np.sort(long_ones[at : at + n - size + 1])
                fresh = np.ones(len(own), dtype=bool)
                np.not_equal(own[1:], own[:-1], out=fresh[1:])
                out[i] = own[fresh]
            elif n:
                out[i] = shingle_hashes(words[at : at + n], size)
            at += n
        group.clear()
        held = 0

    for i, text in enumerate(texts):
        if text:
            raw = text.encode("utf-8", "surrogatepass")
            group.append((i, raw))
            held += len(raw)
            if held >= PIECE:
                flush()
    flush()
    return out
