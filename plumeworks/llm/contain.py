"""Benchmark decontamination: size-partitioned MinHash search for short test items inside long documents.

An item is the set of its five-word shingles. Items are partitioned by set size; each keeps the smallest hashes of its
shingles (a bottom-k MinHash sketch), with k from the size class: a document that holds at least the share
``threshold`` of an item's n shingles misses at most n - ceil(threshold * n) of them, so it holds one of any
n - ceil(threshold * n) + 1. With k at least that for every size of the class, no contained item is missed, however long
the document. A document's hashes are looked up in the sketches, and each candidate is verified on the words themselves:
the share of the item's shingles that the document has.

Items are read in blocks whose total number of shingles is at most ``room``; a block goes to every task, and each block
is one pass over the documents.

Defined results: words are runs of other characters than space and 0x09 to 0x0D, with A-Z lower-cased; an item with fewer
words than a shingle is one shingle, found where a document's whole text is that sequence; null or empty items and
documents match nothing; of repeated rows of one id the largest overlap counts; rows with a null id take no part; an
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .texts import SLICE, many_shingles

SHINGLE, THRESHOLD = 5, 0.75
_GAP = re.compile(r"[\x20\x09-\x0D]+")
_UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text: str | None, size: int = SHINGLE) -> set[tuple[str, ...]]:
    words = [w for w in _GAP.split((text or "").translate(_UPPER)) if w]
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def needed(n: int, threshold: float) -> int:
    """The fewest of n shingles that reach the threshold (percent arithmetic, so that 0.75 of 4 is 3)."""
    return max(1, -(-round(threshold * 100) * n // 100))


def sketch_width(n: int, threshold: float) -> int:
    """Sketch size of the class of set size n: enough for every size up to the next power of two."""
    top = 1 << (n - 1).bit_length() if n > 1 else 1
    return max(m - needed(m, threshold) + 1 for m in range(max(1, top // 2), top + 1))


class Index:
    """The sketches and shingles of a block of items."""

    def __init__(self, items: list[tuple[int, str]], size: int, threshold: float):
        self.size, self.threshold = size, threshold
        self.ids = [i for i, _ in items]
        self.sets = [shingles(t, size) for _, t in items]
        rows: list[tuple[np.ndarray, int]] = []
        for k, hashes in enumerate(many_shingles([t for _, t in items], size)):
            if len(hashes):
                rows.append((hashes[: sketch_width(len(hashes), threshold)], k))
        keys = np.concatenate([h for h, _ in rows]) if rows else np.zeros(0, np.uint64)
        owner = np.concatenate([np.full(len(h), k) for h, k in rows]) if rows else np.zeros(0, np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.owner = keys[order], owner[order]
        self.sieve = np.zeros(1 << 20, dtype=bool)
        self.sieve[(self.keys >> np.uint64(44)).astype(np.int64)] = True

    def find(self, texts: list[str | None]) -> list[list[tuple[int, int, int]]]:
        """(item id, shingles shared, shingles of the item) for each text."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        own = many_shingles(texts, self.size)
        flat = np.concatenate(own) if own else np.zeros(0, np.uint64)
        if not len(flat) or not len(self.keys):
            return out
        at = np.flatnonzero(self.sieve[(flat >> np.uint64(44)).astype(np.int64)])
        low, high = np.searchsorted(self.keys, flat[at], "left"), np.searchsorted(self.keys, flat[at], "right")
        at, low, high = at[high > low], low[high > low], high[high > low]
        text_of = np.searchsorted(np.cumsum([len(x) for x in own]), at, "right")
        pairs = {(int(d), int(k)) for d, a, b in zip(text_of, low, high) for k in self.owner[a:b]}
        cached: dict[int, set] = {}
        for d, k in sorted(pairs):
            if d not in cached:
                cached = {d: shingles(texts[d], self.size)}
            shared, n = len(self.sets[k] & cached[d]), len(self.sets[k])
            if shared >= needed(n, self.threshold):
                out[d].append((self.ids[k], shared, n))
        return out


def _blocks(items: DataFrame, size: int, room: int) -> Iterator[list[tuple[int, str]]]:
    """Items in blocks of at most ``room`` shingles together (or one item), near sizes side by side."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL")
    block: list[tuple[int, str]] = []
    held = 0
    for r in rows.distinct().orderBy(F.length("text"), "item_id", "text").toLocalIterator():
        n = len(shingles(r["text"], size))
        if block and held + n > room:
            yield block
            block, held = [], 0
        block.append((r["item_id"], r["text"]))
        held += n
    if block:
        yield block


def find_items(documents: DataFrame, items: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE, room: int = 500_000) -> DataFrame:
    """doc_id, item_id, n_shared, n_item: every document that holds at least ``threshold`` of an item's shingles."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id IS NOT NULL AND text IS NOT NULL")
    schema = "doc_id long, item_id long, n_shared long, n_item long"
    found = None
    for block in _blocks(items, size, room):
        index = documents.sparkSession.sparkContext.broadcast(Index(block, size, threshold))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at in range(0, whole.num_rows, SLICE):
                    batch = whole.slice(at, SLICE)
                    ids = batch.column(0).to_pylist()
                    rows = [(d, *hit) for d, hits in zip(ids, index.value.find(batch.column(1).to_pylist())) for hit in hits]
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["doc_id", "item_id", "n_shared", "n_item"])

        part = texts.mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return documents.sparkSession.createDataFrame([], schema)
    # an id given to several items or rows: its best match
    best = F.max(F.struct((F.col("n_shared") / F.col("n_item")).alias("share"), "n_shared", "n_item")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.n_shared", "best.n_item")


_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shingle_sql(table: str, key: str) -> str:
    """DuckDB: the distinct shingles (s, a list of words) of each row of a table."""
    return f"""(SELECT DISTINCT {key}, CASE WHEN len(w) < {SHINGLE} THEN w ELSE w[i:i + {SHINGLE - 1}] END AS s
  FROM (SELECT {key}, w, unnest(range(1, greatest(len(w) - {SHINGLE - 2}, 2))) AS i
    FROM (SELECT {key}, list_filter(string_split_regex(translate(text, '{_LETTERS}', '{_LETTERS.lower()}'), '[\\x09-\\x0D ]+'), lambda x: x <> '') AS w FROM {table} WHERE text IS NOT NULL)
    WHERE len(w) > 0))"""


ORACLE = f"""
WITH i AS {shingle_sql("benchmark", "item_id")}, d AS {shingle_sql("documents", "doc_id")},
n AS (SELECT item_id, count(*) AS n_item FROM i GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS n_shared, n_item FROM i JOIN d USING (s) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_item HAVING 100 * count(*) >= 75 * n_item
"""
