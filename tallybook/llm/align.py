"""Alignment of two tokenizers over a corpus: which ids stand for the same text, and in how many documents.

An inverted index holds, for each pair of linked ids, a compressed bitmap of the documents that link it and
bit planes of how often each does. It is kept in blocks of documents. Pairs are counted by adding the
popcounts of their bitmaps; the postings of a block then carry the counts back to its documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm import subword
from tallybook.llm.scratch import stored

#: Documents of a block, as a power of two; postings that end a block; tokens aligned at once; links of a
#: group that are listed one by one.
LOG_DOCS, POSTINGS, TOKENS, SMALL = 13, 4 << 20, 1 << 19, 64
#: A bitmap with more documents than this is kept as bits, else as a list: the smaller of the two.
DENSE = (1 << LOG_DOCS) // 16
#: Bits of an id of the second tokenizer within a pair.
LOG_B = 20


def starts(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)


def summed(keys: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order and the sums of their times, one each if not given."""
    if times is None:
        keys = np.sort(keys)
        first = starts(keys)
        return keys[first], np.diff(np.r_[first, len(keys)])
    order = np.argsort(keys)
    keys, times = keys[order], times[order]
    first = starts(keys)
    return keys[first], np.add.reduceat(times, first) if len(first) else times


class Aligned:
    """Groups and links of the tokens of some documents, given in one row."""

    def __init__(self, a: np.ndarray, b: np.ndarray, a_bytes: np.ndarray, b_bytes: np.ndarray):
        a_end, b_end = np.cumsum(a_bytes[a]), np.cumsum(b_bytes[b])
        a_shared, b_shared = self._shared(a_end, b_end), self._shared(b_end, a_end)
        self.a, self.b = a, b
        self.a_group, self.b_group = np.cumsum(a_shared) - a_shared, np.cumsum(b_shared) - b_shared
        #: tokens before each group, and behind the last
        self.a_first = np.r_[0, np.flatnonzero(a_shared) + 1]
        self.b_first = np.r_[0, np.flatnonzero(b_shared) + 1]
        self.links = np.diff(self.a_first) * np.diff(self.b_first)

    @staticmethod
    def _shared(own: np.ndarray, other: np.ndarray) -> np.ndarray:
        at = np.searchsorted(other, own)
        return other[np.minimum(at, len(other) - 1)] == own

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
        """(groups, pairs, times) that add up to every link, None for once; of large groups distinct ids are multiplied."""
        times = np.diff(self.b_first)[self.a_group]
        times[self.links[self.a_group] > SMALL] = 0
        which = np.repeat(np.arange(len(self.a)), times)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
        group = self.a_group[which]
        other = self.b[self.b_first[group] + nth]
        yield group, self.a[which].astype(np.int64) << LOG_B | other, None
        for g in np.flatnonzero(self.links > SMALL).tolist():
            a, n = np.unique(self.a[self.a_first[g] : self.a_first[g + 1]], return_counts=True)
            b, m = np.unique(self.b[self.b_first[g] : self.b_first[g + 1]], return_counts=True)
            step = max(1, TOKENS // len(b))
            for low in range(0, len(a), step):
                part = a[low : low + step].astype(np.int64)[:, None] << LOG_B | b
                yield np.full(part.size, g), part.ravel(), (n[low : low + step, None] * m).ravel()

    def written(self, n_a: int, table: list[bytes]) -> tuple[list[bytes], np.ndarray]:
        """The tokens of both as text in the order of groups, with what parts them, and the groups' ends there.

        ``table`` has each id's text for A (the first ``n_a``) and B within a group, then at their last in it.
        """
        a_at = np.arange(len(self.a)) + self.b_first[self.a_group]
        b_at = np.arange(len(self.b)) + self.a_first[self.b_group + 1]
        code = np.empty(len(self.a) + len(self.b), np.int64)
        code[a_at], code[b_at] = self.a, self.b + n_a
        a_last, b_last = self.a_first[1:] - 1, self.b_first[1:] - 1
        code[a_at[a_last]] += len(table) // 2
        code[b_at[b_last]] += len(table) // 2
        return list(map(table.__getitem__, code.tolist())), b_at[b_last] + 1


class Block:
    """Documents, their figures and the postings of their links."""

    def __init__(self, a_bytes: list[bytes], b_bytes: list[bytes]):
        self._a_bytes = np.array([len(x) for x in a_bytes], np.int64)
        self._b_bytes = np.array([len(x) for x in b_bytes], np.int64)
        a, b = ([str(i).encode() for i in range(len(x))] for x in (a_bytes, b_bytes))
        self._table = [*(x + b"," for x in a + b), *(x + b"|" for x in a), *(x + b";" for x in b)]
        self.clear()

    def clear(self) -> None:
        self.names: list = []
        self.figures: list[list[int]] = []
        self._hashes: list = []
        self._waiting: list[tuple[int, np.ndarray, np.ndarray]] = []
        self._keys, self._times, self._tokens, self._held = [], [], 0, 0

    def add(self, name: object, parts: list[tuple[np.ndarray, np.ndarray]]) -> bool:
        """Takes a document as the ids of its parts, none for one without tokens; whether the block is full."""
        at = len(self.names)
        self.names.append(name)
        self.figures.append([sum(len(a) for a, _ in parts), sum(len(b) for _, b in parts), 0, 0])
        self._hashes.append(hashlib.sha256() if parts else None)
        for a, b in parts:
            self._waiting.append((at, a, b))
            self._tokens += len(a) + len(b)
            if self._tokens >= TOKENS:
                self._align()
        return len(self.names) == 1 << LOG_DOCS or self._held >= POSTINGS

    def _align(self) -> None:
        if not self._waiting:
            return
        joined = Aligned(
            np.concatenate([a for _, a, _ in self._waiting]),
            np.concatenate([b for _, _, b in self._waiting]),
            self._a_bytes,
            self._b_bytes,
        )
        owner = np.repeat([at for at, _, _ in self._waiting], [len(a) for _, a, _ in self._waiting])[joined.a_first[:-1]]
        text, ends = joined.written(len(self._a_bytes), self._table)
        # parts in a row belong to documents in order, and a part ends with a group
        low = done = 0
        for at, a, _ in self._waiting:
            low += len(a)
            groups = int(np.searchsorted(joined.a_first, low))
            before = int(np.searchsorted(joined.a_first, low - len(a)))
            out = b"".join(text[done : ends[groups - 1]])[:-1]
            self._hashes[at].update(b";" + out if self.figures[at][2] else out)
            self.figures[at][2] += groups - before
            self.figures[at][3] += int(joined.links[before:groups].sum())
            done = ends[groups - 1]
        for group, pair, times in joined.pairs():
            keys, times = summed(pair << LOG_DOCS | owner[group], times)
            self._keys.append(keys)
            self._times.append(times)
            self._held += len(keys)
        self._waiting, self._tokens = [], 0
        if self._held >= POSTINGS:
            self._merge()

    def _merge(self) -> None:
        """Postings of one pair and document, from several parts of a text, become one."""
        keys, times = summed(np.concatenate([np.zeros(0, np.int64), *self._keys]), np.concatenate([np.zeros(0, np.int64), *self._times]))
        self._keys, self._times, self._held = [keys], [times], len(keys)

    def finish(self, number: int) -> dict:
        """The block as one row; it is empty afterwards."""
        self._align()
        self._merge()
        keys, times = self._keys[0], self._times[0]
        pair, doc = keys >> LOG_DOCS, (keys & ((1 << LOG_DOCS) - 1)).astype("<u2")
        first = starts(pair)
        size = np.diff(np.r_[first, len(pair)])
        dense = size > DENSE
        bits = []
        for low, n in zip(first[dense].tolist(), size[dense].tolist(), strict=True):
            held = np.zeros(1 << LOG_DOCS, bool)
            held[doc[low : low + n]] = True
            bits.append(np.packbits(held).tobytes())
        more, planes = times - 1, []
        while more.any():
            planes.append(np.packbits((more & 1).astype(bool)).tobytes())
            more >>= 1
        row = {
            "block": number,
            "id": self.names,
            **{c: [x[i] for x in self.figures] for i, c in enumerate(("n_a", "n_b", "n_groups", "n_links"))},
            "groups_sha256": [h.hexdigest() if h else "" for h in self._hashes],
            "pair": pair[first],
            "n_docs": size,
            "n_times": np.add.reduceat(times, first) if len(first) else times,
            "lists": doc[~np.repeat(dense, size)].tobytes(),
            "bitmaps": b"".join(bits),
            "planes": planes,
        }
        self.clear()
        return row


def opened(size: np.ndarray, lists: bytes, bitmaps: bytes, planes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The document of every posting of a block, pair after pair, and how often it links the pair."""
    doc, dense = np.empty(int(size.sum()), np.int64), size > DENSE
    doc[~np.repeat(dense, size)] = np.frombuffer(lists, "<u2")
    ends, width = np.cumsum(size), (1 << LOG_DOCS) // 8
    for k, i in enumerate(np.flatnonzero(dense).tolist()):
        bits = np.unpackbits(np.frombuffer(bitmaps, np.uint8, width, k * width))
        doc[ends[i] - size[i] : ends[i]] = np.flatnonzero(bits)
    times = np.ones(len(doc), np.int64)
    for k, plane in enumerate(planes):
        times += np.unpackbits(np.frombuffer(plane, np.uint8), count=len(doc)).astype(np.int64) << k
    return doc, times


def index(docs: DataFrame, byte_file: str, piece_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The inverted index, one row per block of up to 8,192 documents or about four million postings.

    Columns: block; of its documents id, n_a, n_b, n_groups, n_links, groups_sha256; of its pairs (first id
    << 20 | second id) in order pair, n_docs, n_times; lists, bitmaps and planes as ``opened`` reads them.
    The files' contents, a few megabytes whatever the corpus, are broadcast. A text is encoded in parts that
    end between two words; a document without tokens by the contract of ``align`` has figures of zero.
    """
    with open(byte_file, encoding="utf-8") as file:
        first = docs.sparkSession.sparkContext.broadcast(file.read())
    with open(piece_file, "rb") as file:
        second = docs.sparkSession.sparkContext.broadcast(file.read())
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_coder, a_bytes = subword.byte_level(first.value)
        b_coder, b_bytes = subword.pieces(second.value)
        block = Block([a_bytes.get(i, b"") for i in range(max(a_bytes) + 1)], b_bytes)
        number, types = TaskContext.get().partitionId() << 32, None

        def both(text: str) -> list[tuple[np.ndarray, np.ndarray]]:
            parts = []
            for k, part in enumerate(subword.chunks(" " + text) if text else ()):
                a = a_coder.encode_to_numpy(part, disallowed_special=())
                b = b_coder.encode(part[1:])
                if b"".join([b_bytes[i] for i in b]) != part.encode():
                    return []
                parts.append((a, np.array(b, np.int64)))
            return parts

        def finished() -> pa.RecordBatch:
            row = block.finish(number)
            return pa.RecordBatch.from_pydict({c: pa.array([v], types[c]) for c, v in row.items()})

        for batch in batches:
            long, text = pa.list_(pa.int64()), pa.list_(pa.string())
            types = {"block": pa.int64(), "id": pa.list_(batch.column("id").type), **dict.fromkeys(("n_a", "n_b", "n_groups", "n_links"), long)}
            types |= {"groups_sha256": text, **dict.fromkeys(("pair", "n_docs", "n_times"), long)}
            types |= {"lists": pa.binary(), "bitmaps": pa.binary(), "planes": pa.list_(pa.binary())}
            for row in range(batch.num_rows):
                if block.add(batch.column("id")[row].as_py(), both(batch.column("text")[row].as_py() or "")):
                    yield finished()
                    number += 1
        if block.names:
            yield finished()

    schema = (
        f"block long, id array<{kind.simpleString()}>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
        "groups_sha256 array<string>, pair array<long>, n_docs array<long>, n_times array<long>, lists binary, bitmaps binary, planes array<binary>"
    )
    return stored(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema))


def pair_counts(blocks: DataFrame) -> DataFrame:
    """One row per linked pair of an index: a, b, pair, n_docs (documents that link it), n_links, best.

    ``best`` says that no pair of the same first id has more documents.
    """
    held = blocks.select(F.explode(F.arrays_zip("pair", "n_docs", "n_times")).alias("x")).select("x.*")
    counts = held.groupBy("pair").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_times").alias("n_links"))
    counts = counts.withColumn("a", F.shiftright("pair", LOG_B))
    most = counts.groupBy("a").agg(F.max("n_docs").alias("most"))
    both = counts.join(most, "a")
    return both.select("a", F.col("pair").bitwiseAND((1 << LOG_B) - 1).alias("b"), "pair", "n_docs", "n_links", (F.col("n_docs") == F.col("most")).alias("best"))


def align(docs: DataFrame, byte_file: str, piece_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``byte_file`` is a byte-level BPE file (A), ``piece_file`` a piece model with byte fallback (B). A space and
    the text are encoded by A, the text by B, which adds the space; strings of special tokens are plain text.
    Offsets where tokens of both end cut them into groups; within a group every A token is linked with every B
    token. n_best counts the links whose pair is in as many documents as any of its A id, count_sum adds up
    the documents of all links' pairs. A text that is null or empty, or that B doesn't give back byte by byte,
    has no tokens: zeros and ''. Every row is a document of its own, also where rows or ids repeat or the id is
    null; extra columns are left alone; an empty table gives no rows. A very long text is encoded and aligned
    in parts; a task holds one block, and the ids of its longest text. Only a text without any offset at which
    both end for tens of thousands of distinct tokens would make more pairs than that.

    Shuffled are one row per block and pair, twice, and the blocks once; a frequent pair has one row in each block.
    """
    blocks = index(docs, byte_file, piece_file, id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    counts = stored(pair_counts(blocks).select("pair", "n_docs", "best"))
    mine = blocks.select(F.col("block").alias("of"), F.explode("pair").alias("pair")).join(counts, "pair")
    names = ("n_a", "n_b", "n_groups", "n_links")

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        row = {c: left.column(c)[0] for c in left.column_names}
        size = row["n_docs"].values.to_numpy()
        doc, times = opened(size, row["lists"].as_py(), row["bitmaps"].as_py(), row["planes"].as_py())
        pair = right.column("pair").to_numpy()
        order = np.argsort(pair)
        if not np.array_equal(pair[order], row["pair"].values.to_numpy()):
            raise ValueError("counts and pairs of a block differ")
        which = np.repeat(np.arange(len(size)), size)
        best = right.column("best").to_numpy().astype(np.int64)[order]
        count = right.column("n_docs").to_numpy()[order]
        n_best, total = np.zeros(len(row["id"]), np.int64), np.zeros(len(row["id"]), np.int64)
        np.add.at(n_best, doc, times * best[which])
        np.add.at(total, doc, times * count[which])
        columns = {"id": row["id"].values, **{c: row[c].values for c in names}, "n_best": n_best, "count_sum": total}
        return pa.table(columns | {"groups_sha256": row["groups_sha256"].values})

    schema = f"id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    kept = blocks.drop("n_times")
    return kept.groupBy("block").cogroup(mine.groupBy("of")).applyInArrow(score, schema).withColumnRenamed("id", id_col)
