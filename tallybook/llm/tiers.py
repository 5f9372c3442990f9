"""Packing documents into sequences of several context sizes, without padding."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm import subword

#: Document ends a task gathers before it packs them; and output rows a batch.
HELD, ROWS = 4096, 16384


class Pool:
    """Items by length, each a (document, start, length), with the longest of at most a given length at hand."""

    def __init__(self, most: int):
        self._of: list[list[tuple[int, int, int]]] = [[] for _ in range(most + 1)]
        self._mask = self.count = 0

    def add(self, item: tuple[int, int, int]) -> None:
        self._of[item[2]].append(item)
        self._mask |= 1 << item[2]
        self.count += 1

    def take(self, most: int, over: int = 0) -> tuple[int, int, int] | None:
        """Removes and returns an item of the greatest length in (over, most]."""
        length = (self._mask & ((1 << (most + 1)) - 1)).bit_length() - 1
        if length <= over:
            return None
        found = self._of[length].pop()
        self.count -= 1
        if not self._of[length]:
            self._mask ^= 1 << length
        return found


def fill(pool: Pool, tiers: tuple[int, ...]) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
    """Full windows (size, items) from the pool; what is left in it is under one window of the first tier.

    ``tiers`` are powers of two, descending. An item belongs to the smallest tier that holds it. Tier by tier,
    its longest item opens a window and the gap takes the longest whole items of shorter tiers that fit; a gap
    that none fits is closed by the front of the longest shorter item, whose rest goes back to its tier.
    Where shorter tiers have run out, the opened items are laid end to end and cut at the window's size.
    """
    top, open_items = tiers[0], []
    for size, lower in zip(tiers, (*tiers[1:], 0), strict=True):
        while first := pool.take(size, lower):
            window, gap = [first], size - first[2]
            while gap and (item := pool.take(gap)):
                window.append(item)
                gap -= item[2]
            if gap and (item := pool.take(lower or size)):
                doc, start, length = item
                window.append((doc, start, gap))
                pool.add((doc, start + gap, length - gap))
                gap = 0
            if gap:
                open_items += window
            else:
                yield size, window
    window, room = [], top
    for doc, start, length in open_items:
        while length >= room:
            yield top, [*window, (doc, start, room)]
            start, length, window, room = start + room, length - room, [], top
        if length:
            window.append((doc, start, length))
            room -= length
    for item in window:
        pool.add(item)


def tail(items: list[tuple[int, int, int]], top: int) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
    """Items of under ``top`` tokens in all as full windows: one of each power of two that their sum is made of."""
    left = sum(x[2] for x in items)
    size, items = top, items[::-1]
    while left:
        size >>= 1
        if size > left:
            continue
        window, room = [], size
        while room:
            doc, start, length = items.pop()
            window.append((doc, start, min(length, room)))
            if length > room:
                items.append((doc, start + room, length - room))
            room -= min(length, room)
        left -= size
        yield size, window


class Packer:
    """The pieces of one task's documents, a batch at a time."""

    def __init__(self, tiers: tuple[int, ...], step_tokens: int, part: int):
        self._tiers, self._step, self._part = tiers, step_tokens, part << 32
        self._docs: dict[int, tuple[object, np.ndarray]] = {}
        self._pool, self._whole = Pool(tiers[0]), []
        self._sequences = self._steps = self._tokens = 0

    def add(self, number: int, name: object, ids: np.ndarray) -> bool:
        """Takes a document; whether it is time to pack."""
        self._docs[number] = (name, ids)
        top = self._tiers[0]
        full = len(ids) // top * top
        self._whole += [(top, [(number, start, top)]) for start in range(0, full, top)]
        if len(ids) > full:
            self._pool.add((number, full, len(ids) - full))
        self._tokens += len(ids)
        return self._pool.count >= HELD or self._tokens >= HELD * top

    def pack(self, last: bool = False) -> Iterator[tuple]:
        """The pieces of all full windows, of every window if ``last``; the rest waits for the next call."""
        windows = [*self._whole, *fill(self._pool, self._tiers)]
        rest = []
        while item := self._pool.take(self._tiers[0]):
            rest.append(item)
        if last:
            windows += tail(rest, self._tiers[0])
            rest = []
        # every step group gets its share of each tier, dealt on from where the tier before ended
        windows.sort(key=lambda x: -x[0])
        groups = max(1, round(sum(size for size, _ in windows) / self._step))
        for k, (size, items) in enumerate(windows):
            sequence, step, offset = self._part + self._sequences + k, self._part + self._steps + k % groups, 0
            for number, start, length in items:
                name, ids = self._docs[number]
                piece = ids[start : start + length]
                yield name, start, length, zlib.crc32(piece), len(ids), sequence, offset, size, step, piece
                offset += length
        self._sequences += len(windows)
        self._steps += groups
        self._whole, self._docs = [], {n: self._docs[n] for n, _, _ in rest}
        self._tokens = 0
        for item in rest:
            self._pool.add(item)


def pack(
    docs: DataFrame,
    tokenizer: str,
    tiers: tuple[int, ...] = (1024, 512, 256, 128, 64),
    end: int = 0,
    step_tokens: int = 1 << 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    ids: bool = False,
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step_group, and with ``ids`` the ids.

    A document is its text's ids, special tokens that stand in the text among them, and the id ``end``; a null
    or empty text has that one alone. Windows of the first tier are cut off a document's front, its end is
    routed to the smallest tier that holds it and packed as ``fill`` says. Every sequence is as long as its
    tier and full, so nothing is padded; the last tokens of a task's share, under one window, make sequences
    of lower powers of two. A task packs its own share of the documents, in their order, so nothing is
    shuffled, a lost task is made again alike, and a task holds the ends of 4,096 documents or four million
    tokens besides its longest document. sequence_id and step_group are unique, not gapless. The windows of
    one packing are dealt to step groups of about ``step_tokens`` tokens; the groups have equal numbers of
    each tier, but for one. Rows that repeat, also with one id, are documents of their own; null ids are kept;
    extra columns are left alone; an empty table gives no rows.
    """
    if list(tiers) != sorted(set(tiers), reverse=True) or any(t < 1 or t & (t - 1) for t in tiers):
        raise ValueError("tiers are powers of two in descending order")
    with open(tokenizer, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, _ = subword.byte_level(spec.value)
        packer = Packer(tiers, step_tokens, TaskContext.get().partitionId())
        id_type, number = None, 0

        def rows(pieces: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
            held = []
            for piece in pieces:
                held.append(piece)
                if len(held) == ROWS:
                    yield batch_of(held)
                    held = []
            if held:
                yield batch_of(held)

        def batch_of(held: list[tuple]) -> pa.RecordBatch:
            columns = dict(zip(names, zip(*held, strict=True), strict=True))
            arrays = {c: pa.array(columns[c], id_type if c == "id" else pa.int32() if c == "tier" else pa.int64()) for c in names[:-1]}
            if ids:
                arrays["ids"] = pa.array([x.astype(np.int32) for x in columns["ids"]], pa.list_(pa.int32()))
            return pa.RecordBatch.from_pydict(arrays)

        for batch in batches:
            id_type = batch.column("id").type
            for row in range(batch.num_rows):
                name, text = batch.column("id")[row].as_py(), batch.column("text")[row].as_py() or ""
                parts = [coder.encode_to_numpy(x, allowed_special="all") for x in subword.chunks(text)] if text else []
                if packer.add(number, name, np.concatenate([*parts, np.array([end])]).astype("<u4")):
                    yield from rows(packer.pack())
                number += 1
        yield from rows(packer.pack(last=True))

    schema = (
        f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_group long"
        + ", ids array<int>" * ids
    )
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return base.mapInArrow(run, schema).withColumnRenamed("id", id_col)
