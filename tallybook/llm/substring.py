"""Exact substring dedup by anchored relative Lempel-Ziv parsing.

The reference is the corpus itself, cut into blocks: every window of ``span`` words belongs to the anchor
with the smallest hash among its ``anchor`` -word grams, and the windows in a row that share an anchor form
one block. The choice of an anchor depends on the words of the window alone, so equal stretches of two
documents are cut alike, wherever they stand. All blocks are indexed by anchor. A document is parsed
against all of them in its word order: blocks that recur whole are taken whole, and at the boundaries of
a factor, where a block's anchor recurs but its words differ, window after window is looked up. A factor
runs on greedily while one window after the other is found; each is at least ``span`` words long.

Nothing is paired: both look-ups are counts by a key, combined before the shuffle, so a passage shared by
every document costs as much as any other. Two bitmaps of fixed size tell the second reading of the texts
which blocks can matter; they only save work, every decision is made by exact joins.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.bits import Bits, bitmap
from tallybook.llm.scratch import bytes_of, row_key, slices, stored
from tallybook.llm.words import Stretches, words

SPAN, ANCHOR = 35, 8


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours."""
    have, out = 1, values
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def _blocks(w, span: int, anchor: int):
    """(first word, windows, anchor hash, hash of all words, holds its anchor twice) of every block of a slice."""
    reach = span - anchor + 1
    n = len(w.doc)
    none = np.zeros(0, np.int64)
    if n < span:
        return none, none, none.astype(np.uint64), none.astype(np.uint64), none.astype(bool)
    whole = Stretches(w.hashes)
    at = np.arange(n - anchor + 1)
    grams = whole(at, at + anchor, 1)
    least = _smallest(grams, reach)
    inside = w.doc[: n - span + 1] == w.doc[span - 1 :]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | (least[1:] != least[:-1]) | (w.doc[1 : n - span + 1] != w.doc[: n - span])
    first = np.flatnonzero(begin)
    change = np.append(first, len(inside))
    inner = np.zeros(len(inside) + 1, np.int64)
    np.cumsum(inside, out=inner[1:])
    count = inner[change[1:]] - inner[change[:-1]]
    last = first + count - 1
    seed = least[first]
    seen = [np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)]
    place = [np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)]
    for k, base in enumerate((first, last)):
        for d in range(reach):
            hit = grams[base + d] == seed
            seen[k] += hit
            place[k] += hit * (base + d)
    twice = (count > reach) | (seen[0] > 1) | (seen[1] > 1) | (place[0] != place[1])
    return first, count, seed, whole(first, last + span, 2), twice


def _anchors(span: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in slices(batch.column("text")):
                _, _, seed, content, twice = _blocks(words(data, offsets), span, anchor)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seed.view(np.int64)), pa.array(content.view(np.int64)), pa.array(twice)],
                    names=["seed", "content", "twice"],
                )

    return run


def _lookups(span: int, anchor: int, again: Bits, mixed: Bits):
    """Blocks whose anchor may recur; those that may have to be looked up by window carry their windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy()
            for low, _, data, offsets in slices(batch.column("text")):
                w = words(data, offsets)
                first, count, seed, _, _ = _blocks(w, span, anchor)
                held = again.has(seed)
                first, count, seed = first[held], count[held], seed[held]
                part = mixed.has(seed)
                each = np.where(part, count, 0)
                ends = np.cumsum(each)
                at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - each, each) + np.repeat(first, each)
                hashes = Stretches(w.hashes)(at, at + span, 3).view(np.int64)
                windows = pa.ListArray.from_arrays(np.append(0, ends).astype(np.int32), pa.array(hashes))
                doc = w.doc[first]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[low + doc]),
                        pa.array((first - w.first[doc]).astype(np.int32)),
                        pa.array(count.astype(np.int32)),
                        pa.array(seed.view(np.int64)),
                        windows,
                    ],
                    names=["key", "first", "windows", "seed", "hashes"],
                )

    return run


def _cut(span: int):
    """Removes the factors from each text; the words left stand with one space between them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = bytes_of(batch.column("text"))
            begins, runs = batch.column("begins").to_pylist(), batch.column("runs").to_pylist()
            out: dict[str, list] = {"n_words": [], "n_removed": [], "kept_text": [], "kept_sha256": [], "factors": []}
            for i, (some, many) in enumerate(zip(begins, runs, strict=True)):
                own = data[offsets[i] : offsets[i + 1]].tobytes().split()
                factors: list[list[int]] = []
                for first, count in sorted(zip(some or (), many or (), strict=True)):
                    if factors and first <= factors[-1][1] - span + 1:
                        factors[-1][1] = max(factors[-1][1], first + count + span - 1)
                    else:
                        factors.append([first, first + count + span - 1])
                kept, done = [], 0
                for first, end in factors:
                    kept += own[done:first]
                    done = max(done, end)
                kept += own[done:]
                text = b" ".join(kept)
                out["n_words"].append(len(own))
                out["n_removed"].append(len(own) - len(kept))
                out["kept_text"].append(text.decode("utf-8", "replace"))
                out["kept_sha256"].append(hashlib.sha256(text).hexdigest())
                out["factors"].append(factors)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(out["n_words"], pa.int64()),
                    pa.array(out["n_removed"], pa.int64()),
                    pa.array(out["kept_text"], pa.string()),
                    pa.array(out["kept_sha256"], pa.string()),
                    pa.array(out["factors"], pa.list_(pa.list_(pa.int64()))),
                ],
                names=["id", "n_words", "n_removed", "kept_text", "kept_sha256", "factors"],
            )

    return run


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN, anchor: int = ANCHOR) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_removed, kept_text, kept_sha256, factors.

    Removed is every word that lies in a window of ``span`` words whose sequence also begins anywhere else,
    in another document or in the same one, overlaps included. ``factors`` are the duplicate spans as
    [first word, end] in word positions of the input. A null or empty text has no words and an empty rest.
    A row that repeats another one (same id, same text) counts as a document of its own, so both lose what
    they share. Other columns are left alone; an empty table gives no rows.
    """
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    base = base.withColumn("key", row_key("id", "text"))
    blocks = base.select("text").mapInArrow(_anchors(span, anchor), "seed long, content long, twice boolean")
    index = (
        blocks.groupBy("seed")
        .agg(
            F.sum(F.when(F.col("twice"), 2).otherwise(1)).alias("n"),
            F.min("content").alias("a"),
            F.max("content").alias("b"),
            F.max("twice").alias("twice"),
        )
        .where("n > 1")
        .select("seed", (F.col("twice") | (F.col("a") != F.col("b"))).alias("mixed"))
    )
    index = stored(index)
    again, mixed = bitmap(index, "seed"), bitmap(index.where("mixed"), "seed")
    found = base.select("key", "text").mapInArrow(
        _lookups(span, anchor, again, mixed), "key long, first int, windows int, seed long, hashes array<long>"
    )
    found = stored(found.join(index, "seed"))
    taken = found.where("not mixed").select("key", "first", "windows")
    single = found.where("mixed").select("key", "first", "seed", F.posexplode("hashes").alias("k", "h"))
    repeated = single.groupBy("seed", "h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("seed", "h")
    edges = single.join(repeated, ["seed", "h"]).select("key", (F.col("first") + F.col("k")).alias("first"), F.lit(1).alias("windows"))
    spans = (
        taken.union(edges)
        .groupBy("key")
        .agg(F.collect_set(F.struct("first", "windows")).alias("spans"))
        .select("key", F.col("spans.first").alias("begins"), F.col("spans.windows").alias("runs"))
    )
    joined = base.join(spans, "key", "left").select("id", "text", "begins", "runs")
    kind = base.schema["id"].dataType.simpleString()
    return joined.mapInArrow(
        _cut(span),
        f"id {kind}, n_words long, n_removed long, kept_text string, kept_sha256 string, factors array<array<long>>",
    ).withColumnRenamed("id", id_col)
