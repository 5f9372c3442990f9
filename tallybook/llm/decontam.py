"""Benchmark decontamination by spaced-seed hashing with substitution-tolerant verification."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.scratch import slices
from tallybook.llm.words import PUNCTUATION, mix, words

_U = np.uint64
#: A seed looks at the tokens marked 1 and ignores those marked 0.
MASKS = ("11111", "1101011", "11001101", "101100101", "1100010011")
#: A stretch of an item leaks when this share of its tokens agrees and it is this long, or the whole item.
AGREE, LEAST = 0.8, 20
#: Bytes of benchmark text that are indexed and broadcast at once; a larger benchmark is taken in blocks.
BLOCK_BYTES = 8 << 20


def _seeds(hashes: np.ndarray, doc: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of a mask, inside documents only."""
    span = len(mask)
    n = len(hashes) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k, used in enumerate(mask):
        if used == "1":
            total += hashes[k : k + n] * _U(2 * (k + 1) * 0x9E3779B97F4A7C15 + 1 & 2**64 - 1)
    at = np.flatnonzero(doc[:n] == doc[span - 1 :])
    return at, mix(total[at], span * 31 + int(mask, 2))


@dataclass
class Index:
    """Seeds of a block of benchmark items: sorted hashes with the token each begins at."""

    item: list
    first: np.ndarray
    hashes: np.ndarray
    doc: np.ndarray
    seed: np.ndarray
    at: np.ndarray
    flags: np.ndarray

    @staticmethod
    def of(rows: list[tuple]) -> Index:
        texts = pa.array([text or "" for _, text in rows], pa.large_string())
        data, offsets = next((d, o) for _, _, d, o in slices(texts, 1 << 62)) if rows else (np.zeros(0, np.uint8), np.zeros(1, np.int64))
        w = words(data, offsets, gaps=PUNCTUATION)
        found = [_seeds(w.hashes, w.doc, m) for m in MASKS]
        at, seed = (np.concatenate([x[k] for x in found]) for k in (0, 1))
        order = np.argsort(seed, kind="stable")
        flags = np.zeros(1 << 22, bool)
        flags[seed >> _U(42)] = True
        return Index([i for i, _ in rows], w.first, w.hashes, w.doc, seed[order], at[order], flags)

    def hits(self, hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(token of the document, token of the benchmark) of every seed that both have."""
        out = []
        for mask in MASKS:
            at, seed = _seeds(hashes, doc, mask)
            some = np.flatnonzero(self.flags[seed >> _U(42)])
            at, seed = at[some], seed[some]
            low, high = (np.searchsorted(self.seed, seed, side) for side in ("left", "right"))
            n = high - low
            ends = np.cumsum(n)
            k = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n, n) + np.repeat(low, n)
            out.append(np.stack([np.repeat(at, n), self.at[k]]))
        return tuple(np.concatenate(out, axis=1))


def _best(same: np.ndarray, agree: float) -> tuple[int, int]:
    """(length, agreeing tokens) of the longest stretch of which the share ``agree`` agrees."""
    score = np.concatenate([[0.0], np.cumsum(same - agree)])
    low = np.minimum.accumulate(score)
    best = (0, 0)
    for end in np.flatnonzero(same) + 1:
        start = int(np.searchsorted(-low, -(score[end] + 1e-9), "left"))
        if end - start > best[0]:
            best = (int(end - start), int(same[start:end].sum()))
    return best


def _verify(index: Index, w, agree: float, least: int) -> dict[int, dict]:
    """For each document of a slice with a leak: its items and the most tokens that agree in a stretch."""
    mine, theirs = index.hits(w.hashes, w.doc)
    doc, item = w.doc[mine], index.doc[theirs]
    shift = (mine - w.first[doc]) - (theirs - index.first[item])
    lines = np.unique(np.stack([doc, item, shift], axis=1), axis=0) if len(doc) else np.zeros((0, 3), np.int64)
    out: dict[int, dict] = {}
    for d, i, by in lines.tolist():
        n, size = int(index.first[i + 1] - index.first[i]), int(w.first[d + 1] - w.first[d])
        low, high = max(0, -by), min(n, size - by)
        wanted = min(n, least)
        if high - low < wanted:
            continue
        a = w.hashes[w.first[d] + by + low : w.first[d] + by + high]
        b = index.hashes[index.first[i] + low : index.first[i] + high]
        same = a == b
        if same.sum() < agree * wanted:
            continue
        length, agreed = _best(same, agree)
        if length >= wanted:
            held = out.setdefault(d, {"items": set(), "agreed": 0})
            held["items"].add(index.item[i])
            held["agreed"] = max(held["agreed"], agreed)
    return out


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    agree: float = AGREE,
    least: int = LEAST,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: id, leaked, item_ids (sorted), n_items, n_agreeing.

    Tokens are runs of letters, digits and non-ASCII characters, in lower case. A document leaks an item if a
    stretch of the item, of ``least`` tokens or the whole of a shorter item, stands in it with at least the
    share ``agree`` of the tokens equal, place by place. Stretches are looked for along every alignment that
    a seed proposes; each mask needs five equal tokens at its marked places, so a short stretch whose
    substitutions break every mask is missed. How often was not measured. Items of fewer than five tokens
    have no seed and never match. Null and empty texts leak nothing; items with null text are skipped, items
    that repeat are reported once per id; an empty benchmark marks nothing.

    The benchmark is indexed in blocks of bounded size that are broadcast, one pass of the documents each;
    nothing is shuffled and no document is paired with an item it shares no seed with.
    """
    items = benchmark.select(F.col(item_col).alias("i"), F.lower(F.col(item_text_col)).alias("t")).where("t is not null and i is not null")
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    kind, of = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.lower(F.col(text_col)).alias("text"))
    out = out.withColumns({"item_ids": F.array().cast(f"array<{of}>"), "n_agreeing": F.lit(0)})
    schema = f"id {kind}, text string, item_ids array<{of}>, n_agreeing int"
    context = docs.sparkSession.sparkContext
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("t"), F.lit(blocks)) == k).collect()
        index = context.broadcast(Index.of([tuple(r) for r in rows]))
        last = k == blocks - 1

        def run(batches: Iterator[pa.RecordBatch], index=index, last=last) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                known = batch.column("item_ids").to_pylist()
                most = batch.column("n_agreeing").to_pylist()
                texts = batch.column("text")
                for low, _, data, offsets in slices(texts):
                    for d, held in _verify(index.value, words(data, offsets, gaps=PUNCTUATION), agree, least).items():
                        known[low + d] = sorted({*known[low + d], *held["items"]})
                        most[low + d] = max(most[low + d], held["agreed"])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id"),
                        pa.nulls(len(texts), texts.type) if last else texts,
                        pa.array(known, batch.schema.field("item_ids").type),
                        pa.array(most, pa.int32()),
                    ],
                    names=["id", "text", "item_ids", "n_agreeing"],
                )

        out = out.mapInArrow(run, schema)
    return out.select(
        F.col("id").alias(id_col),
        (F.size("item_ids") > 0).alias("leaked"),
        "item_ids",
        F.size("item_ids").alias("n_items"),
        "n_agreeing",
    )
