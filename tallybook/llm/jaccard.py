"""N-gram Jaccard join as a blocked, masked sparse matrix product.

Rows of the incidence matrix are distinct shingle sets (documents with equal sets are one class), columns are
shingles. Two sets link when their Jaccard similarity reaches ``PERCENT``. That bounds their sizes and, with
the columns in one common order, makes them share a column among the first fifth of each: only these columns
are multiplied. A fixed-size sketch of column weights puts heavy columns last in the order, so that what many
documents quote is multiplied only where a set consists of little else.

1. Columns of one row drop out while rows are streamed in column order; a column that the sketch calls heavy
   goes another way, through a combining aggregate, so no task gets a heavy column whole.
2. Long columns are joined with one row, the hub: of those the one with the fewest columns of its own. Sets
   that link with it are one component already, so their mutual products need not be looked at.
3. Entries of the product between different components are accumulated from the columns that may be the first
   of enough shared ones, and pairs go whose count and what follows can't reach the overlap their sizes ask for.
4. What is left is checked, first by parity bitmaps that bound the symmetric difference, then by the exact
   product of the full rows.

Every step is exact: no pair of different components with enough overlap is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.bits import Bits, bitmap
from tallybook.llm.graph import components
from tallybook.llm.scratch import bytes_of, slices, stored
from tallybook.llm.words import Stretches, mix, words

N, PERCENT = 5, 80
#: Buckets of the sketch of column weights: 8 MB on the driver, whatever the input.
LOG_SKETCH, LOG_PART = 20, 12
#: Rows from which a column is joined with its hub first.
LONG = 16
#: Classes a task remembers so as not to send them again; only speed depends on it.
REMEMBERED = 500_000


def need(a, b):
    """The least overlap with which sets of a and b shingles link; for numbers, arrays and columns."""
    return -((-PERCENT * (a + b)) // (100 + PERCENT))


def _need(a: str, b: str) -> str:
    return f"ceil({PERCENT} * ({a} + {b}) / {100 + PERCENT}.0D - 1e-9)"


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each document of a slice; fewer than n words are one shingle."""
    w = words(data, offsets, lower=True)
    whole = Stretches(w.hashes)
    many = np.diff(w.first)
    for first, count in zip(w.first.tolist(), many.tolist()):
        at = np.arange(first, first + max(count - n + 1, min(count, 1)))
        yield np.unique(whole(at, at + min(n, count)))


def class_of(tokens: np.ndarray) -> int:
    """A 64-bit name of a set."""
    return int(Stretches(tokens)(np.array([0]), np.array([len(tokens)]), 9).view(np.int64)[0])


def _bucket(tokens: np.ndarray) -> np.ndarray:
    return (mix(tokens, 5) >> np.uint64(64 - LOG_SKETCH)).astype(np.int64)


def _parity(tokens: np.ndarray) -> bytes:
    """One bit for each of about as many buckets as there are tokens: whether an odd number fell into it."""
    log = min(16, max(6, int(len(tokens) - 1).bit_length()))
    counts = np.bincount((mix(tokens, 6) >> np.uint64(64 - log)).astype(np.int64), minlength=1 << log)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def _summaries(n: int):
    """A row for each document, and at the end of a task the parts of its sketch (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, kind = np.zeros(1 << LOG_SKETCH, np.uint32), None
        for batch in batches:
            kind = batch.column("id").type
            names, sizes, bits = [], [], []
            for _, _, data, offsets in slices(batch.column("text")):
                held = list(shingle_sets(data, offsets, n))
                for tokens in held:
                    names.append(class_of(tokens) if len(tokens) else 0)
                    sizes.append(len(tokens))
                    bits.append(_parity(tokens) if len(tokens) else b"")
                at = _bucket(np.concatenate(held))
                sketch += np.bincount(at, minlength=1 << LOG_SKETCH).astype(np.uint32)
            rows = len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array([0] * rows, pa.int32()), batch.column("id"), pa.array(names, pa.int64()), pa.array(sizes, pa.int64()), pa.array(bits, pa.binary())],
                names=["kind", "id", "c", "n", "bits"],
            )
        if kind is not None:
            parts = sketch.reshape(-1, 1 << LOG_PART)
            salt = TaskContext.get().partitionId() % 64
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([1] * len(parts), pa.int32()),
                    pa.nulls(len(parts), kind),
                    pa.array(range(len(parts)), pa.int64()),
                    pa.array([salt] * len(parts), pa.int64()),
                    pa.array([x.astype("<i8").tobytes() for x in parts], pa.binary()),
                ],
                names=["kind", "id", "c", "n", "bits"],
            )

    return run


def _added(frame: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(x, "<i8") for x in frame["bits"])
    return frame[:1].assign(bits=[total.tobytes()])


def _levels(sketch: DataFrame) -> np.ndarray:
    """0 for light buckets; from 1 on, by powers of two, for those far above the mean."""
    once = sketch.groupBy("c", "n").applyInPandas(_added, "c long, n long, bits binary")
    twice = once.groupBy("c").applyInPandas(_added, "c long, n long, bits binary")
    counts = np.zeros((1 << (LOG_SKETCH - LOG_PART), 1 << LOG_PART), np.int64)
    for part, _, held in twice.collect():
        counts[part] = np.frombuffer(held, "<i8")
    counts = counts.reshape(-1)
    light = counts.mean() + 6 * np.sqrt(counts.mean()) + 30
    return np.where(counts > light, 1 + np.log2(np.maximum(counts, 1) / light), 0).astype(np.uint8)


def _prefixes(n: int, levels):
    """The first columns of each set in the common order; a task sends copies of a set once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, seen = levels.value, set()
        for batch in batches:
            for _, _, data, offsets in slices(batch.column("text")):
                t, c, size, place, heavy = [], [], [], [], []
                for tokens in shingle_sets(data, offsets, n):
                    count = len(tokens)
                    name = class_of(tokens) if count else 0
                    if not count or name in seen:
                        continue
                    if len(seen) > REMEMBERED:
                        seen.clear()
                    seen.add(name)
                    grade = level[_bucket(tokens)]
                    order = np.argsort(grade, kind="stable")[: count + (-PERCENT * count) // 100 + 1]
                    t.append(tokens[order])
                    heavy.append(grade[order] > 0)
                    place.append(np.arange(len(order)))
                    c.append(np.full(len(order), name))
                    size.append(np.full(len(order), count))
                if t:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(t).view(np.int64)), *(pa.array(np.concatenate(x).astype(np.int64)) for x in (c, size, place)), pa.array(np.concatenate(heavy))],
                        names=["t", "c", "n", "i", "heavy"],
                    )

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in the order of (t, c): one of each, and only where another row has the same t."""
    held = np.zeros((4, 0), np.int64)
    last = None
    for batch in batches:
        rows = np.stack([batch.column(k).to_numpy() for k in ("t", "c", "n", "i")])
        new = np.ones(rows.shape[1], bool)
        new[1:] = (rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1])
        if last is not None and rows.shape[1]:
            new[0] = (rows[0, 0], rows[1, 0]) != last
        rows = rows[:, new]
        if not rows.shape[1]:
            continue
        before = np.empty(rows.shape[1], bool)
        before[1:] = rows[0, 1:] == rows[0, :-1]
        before[0] = last is not None and rows[0, 0] == last[0]
        after = np.zeros(rows.shape[1], bool)
        after[:-1] = before[1:]
        keep = before | after
        out = rows[:, keep]
        if before[0] and held.shape[1]:
            out = np.concatenate([held, out], axis=1)
        held = rows[:, -1:] if not keep[-1] else rows[:, :0]
        last = (rows[0, -1], rows[1, -1])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["t", "c", "n", "i"])


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose parity bitmaps leave room for enough overlap."""
    for batch in batches:
        a, b = ([np.unpackbits(np.frombuffer(x, np.uint8)) for x in batch.column(k).to_pylist()] for k in ("pa", "pb"))
        sizes = batch.column("na").to_numpy() + batch.column("nb").to_numpy()
        room = sizes - 2 * need(sizes, 0)
        keep = np.zeros(len(sizes), bool)
        for k, (x, y) in enumerate(zip(a, b, strict=True)):
            short = min(len(x), len(y))
            x, y = (np.bitwise_xor.reduce(z.reshape(short, -1), axis=1) for z in (x, y))
            keep[k] = int((x ^ y).sum()) <= room[k]
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _rows_of(n: int, wanted: Bits):
    """(class, shingles) of the sets that the bitmap may hold; a task gives each one once as long as it remembers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for _, _, data, offsets in slices(batch.column("text")):
                names, rows = [], []
                for tokens in shingle_sets(data, offsets, n):
                    name = class_of(tokens) if len(tokens) else 0
                    if len(tokens) and name not in seen and wanted.has(np.array([name]).view(np.uint64))[0]:
                        if len(seen) > REMEMBERED:
                            seen.clear()
                        seen.add(name)
                        names.append(name)
                        rows.append(tokens.tobytes())
                if names:
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(rows, pa.binary())], names=["c", "tokens"])

    return run


def _product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose rows have enough shingles in common."""
    for batch in batches:
        left, right = (bytes_of(batch.column(k)) for k in ("ta", "tb"))
        keep = np.zeros(batch.num_rows, bool)
        for k in range(batch.num_rows):
            x, y = (np.frombuffer(d[o[k] : o[k + 1]].tobytes(), np.uint64) for d, o in (left, right))
            both = np.sort(np.concatenate([x, y]))
            keep[k] = int((both[1:] == both[:-1]).sum()) >= need(len(x), len(y))
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _linked(pairs: DataFrame, classes: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """Those of the pairs (a, b) of classes that link."""
    kept = pairs.join(classes.selectExpr("c as a", "n as na", "bits as pa"), "a")
    kept = kept.join(classes.selectExpr("c as b", "n as nb", "bits as pb"), "b")
    kept = stored(kept.select("a", "b", "na", "nb", "pa", "pb").mapInArrow(_close, "a long, b long"))
    sides = kept.select(F.col("a").alias("c")).union(kept.select("b")).distinct()
    rows = texts.mapInArrow(_rows_of(n, bitmap(sides, "c")), "c long, tokens binary")
    rows = stored(rows.join(sides, "c").groupBy("c").agg(F.first("tokens").alias("tokens")))
    full = kept.join(rows.selectExpr("c as a", "tokens as ta"), "a").join(rows.selectExpr("c as b", "tokens as tb"), "b")
    return stored(full.select("a", "b", "ta", "tb").mapInArrow(_product, "a long, b long"))


def link(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id, class_id.

    A set is the distinct n-word shingles of the text, A-Z in lower case; fewer words are one shingle. Two
    rows link when 100 * intersection >= 80 * union; ``component_id`` is the smallest id reachable by links,
    itself included, ``class_id`` names equal sets. Null, empty and blank texts have no shingles, no class
    and their own id. Rows that repeat link with each other. An empty table gives no rows. Sets are named by
    64 bits, so two among ten billion may be taken for one.
    """
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = base.schema["id"].dataType.simpleString()
    texts = base.select("text")
    all_rows = stored(base.mapInArrow(_summaries(n), f"kind int, id {kind}, c long, n long, bits binary"))
    members = all_rows.where("kind = 0 and n > 0").select("id", "c", "n")
    levels = docs.sparkSession.sparkContext.broadcast(_levels(all_rows.where("kind = 1").select("c", "n", "bits")))
    classes = all_rows.where("kind = 0 and n > 0").groupBy("c").agg(F.first("n").alias("n"), F.first("bits").alias("bits"))
    classes = stored(classes)

    cells = texts.mapInArrow(_prefixes(n, levels), "t long, c long, n long, i long, heavy boolean")
    # one reading of the texts for both ways: heavy columns are dealt by row as well, so that none meets in one task
    sent = cells.withColumn("by", F.when(F.col("heavy"), F.xxhash64("t", "c")).otherwise(F.col("t")))
    sent = sent.repartition("by").sortWithinPartitions("heavy", "t", "c")
    cells = stored(sent.mapInArrow(_both_ways, "t long, c long, n long, i long"))
    known = cells.groupBy("c").agg(F.count(F.lit(1)).alias("known"))
    cells = cells.join(known, "c").withColumn("novel", F.expr(f"n - ceil({PERCENT} * n / 100.0D - 1e-9) + 1 - known"))
    # linked sets differ in size by a quarter at most, so they lie in the same or in neighbouring steps of 1.26
    cells = cells.withColumn("s", F.floor(F.log("n") / F.log(F.lit(1.26))).cast("int"))
    cells = stored(cells.select("t", "c", "n", "i", "novel", "s"))
    lists = cells.withColumn("q", F.explode(F.array("s", F.col("s") + 1)))

    hubs = lists.groupBy("t", "q").agg(F.min(F.struct("novel", "c", "n", "i")).alias("h"), F.count(F.lit(1)).alias("rows"))
    hubs = hubs.where(f"rows >= {LONG}").select("t", "q", F.col("h.c").alias("b"), F.col("h.n").alias("m"), F.col("h.i").alias("j"))
    near = lists.join(hubs, ["t", "q"]).where(
        f"c <> b and least(n - i, m - j) >= {_need('n', 'm')}"
    )
    first = _linked(near.select(F.col("c").alias("a"), "b").distinct(), classes, texts, n)
    roots = components(first.toDF("u", "v"), "c")

    placed = cells.join(roots, "c", "left").withColumn("root", F.coalesce("root", "c"))
    lists = stored(placed.drop("novel")).withColumn("q", F.explode(F.array("s", F.col("s") + 1)))
    mixed = lists.groupBy("t", "q", "root").agg(F.count(F.lit(1)).alias("rows"))
    mixed = mixed.groupBy("t", "q").agg(F.max_by("root", F.struct("rows", "root")).alias("main"), F.count(F.lit(1)).alias("roots"))
    mixed = stored(mixed.where("roots > 1").select("t", "q", "main"))
    rest = stored(lists.join(mixed, ["t", "q"]).select("t", "q", "c", "n", "i", "s", "root", (F.col("root") == F.col("main")).alias("major")))
    left, right = rest.where("not major").alias("x"), rest.alias("y")
    pairs = left.join(
        right,
        F.expr(
            "x.t = y.t and x.q = y.q and x.root <> y.root and (y.major or x.c < y.c) and greatest(x.s, y.s) = x.q"
            f" and least(x.n - x.i, y.n - y.i) >= {_need('x.n', 'y.n')}"
        ),
    )
    pairs = pairs.selectExpr(
        "least(x.c, y.c) as a", "greatest(x.c, y.c) as b", "if(x.c < y.c, x.n, y.n) as na", "if(x.c < y.c, y.n, x.n) as nb",
        "if(x.c < y.c, x.i, y.i) as ia", "if(x.c < y.c, y.i, x.i) as ib",
    )
    pairs = pairs.groupBy("a", "b", "na", "nb").agg(F.count(F.lit(1)).alias("shared"), F.max("ia").alias("ia"), F.max("ib").alias("ib"))
    pairs = pairs.where(f"shared + least(na - ia - 1, nb - ib - 1) >= {_need('na', 'nb')}").select("a", "b")
    second = _linked(pairs, classes, texts, n)
    edges = second.toDF("u", "v").union(first.toDF("u", "v"))
    roots = components(edges, "c")

    members = members.join(roots, "c", "left").withColumn("root", F.coalesce("root", "c"))
    least = members.groupBy("root").agg(F.min("id").alias("component_id"))
    linked = members.join(least, "root").select("id", F.col("n").alias("n_shingles"), "component_id", F.col("c").alias("class_id"))
    alone = all_rows.where("kind = 0 and n = 0").select("id", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"), F.lit(None).cast("long").alias("class_id"))
    return linked.union(alone).withColumnRenamed("id", id_col)


def _both_ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Light columns through ``_shared``; of heavy ones every row once, they come after the light ones."""
    last = None
    tail: list[pa.RecordBatch] = []

    def light() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = batch.num_rows - int(np.count_nonzero(batch.column("heavy").to_numpy(zero_copy_only=False)))
            if split:
                yield batch.slice(0, split)
            if split < batch.num_rows:
                tail.append(batch.slice(split))
                return

    yield from _shared(light())
    for part in (group for source in (tail, batches) for group in source):
        rows = np.stack([part.column(k).to_numpy() for k in ("t", "c", "n", "i")])
        new = np.ones(rows.shape[1], bool)
        new[1:] = (rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1])
        new[0] = (rows[0, 0], rows[1, 0]) != last
        last = (rows[0, -1], rows[1, -1])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in rows[:, new]], names=["t", "c", "n", "i"])
