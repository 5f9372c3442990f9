"""Fuzzy line dedup: MinHash signatures of character shingles, banding, exact check, union-find."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.lineage import drop
from tallybook.llm.bits import Bits, bitmap
from tallybook.llm.graph import components
from tallybook.llm.jaccard import LOG_PART, LOG_SKETCH, _bucket, _levels
from tallybook.llm.scratch import bytes_of, row_key, slices, stored
from tallybook.llm.words import _BYTE, Stretches, mix, words

#: Characters of a shingle, Jaccard similarity of fuzzy lines, and bytes from which a line is compared unless the caller says so.
SHINGLE, SIMILAR, LEAST = 8, 0.8, 10
#: Bins of a signature: BANDS bands of ROWS. At similarity 0.8 a pair shares a band with probability 0.998.
BANDS, ROWS = 12, 4
#: Lines from which a band gets another hub, and hubs that a band gets at most before the rest is joined exactly.
LONG, HUBS = 16, 4
#: The least and the largest parity bitmap of a line, as powers of two; between them it has as many bits as shingles.
LOG_PARITY = (8, 14)
#: Lines a task remembers so as not to send them again; only speed depends on it.
REMEMBERED = 400_000

NEWLINE = np.zeros(256, bool)
NEWLINE[0x0A] = True
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_PROBES = np.stack([np.random.default_rng(k).permutation(BANDS * ROWS) for k in range(BANDS * ROWS)])


def _hashed_shingles(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the line, hash) of every character shingle of each line; a shorter line is one shingle."""
    at = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    low, high = np.searchsorted(at, start), np.searchsorted(at, end)
    many = np.maximum(high - low - SHINGLE + 1, 1)
    ends = np.cumsum(many)
    line = np.repeat(np.arange(len(start)), many)
    first = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - many, many) + low[line]
    last = np.minimum(first + SHINGLE, high[line])
    base = int(start[0]) if len(start) else 0
    return line, Stretches(_BYTE[data[base : int(end[-1]) if len(end) else 0]])(at[first] - base, at[last] - base)


def signatures(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """One-permutation MinHash of the character shingles of each line; empty bins borrow from others in a fixed order."""
    bins = BANDS * ROWS
    line, values = _hashed_shingles(data, start, end)
    out = np.full(len(start) * bins, np.uint32(0xFFFFFFFF))
    where = line * bins + ((values >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    np.minimum.at(out, where, values.astype(np.uint32))
    out = out.reshape(-1, bins)
    full = out != 0xFFFFFFFF
    row, col = np.nonzero(~full)
    for k in range(bins):
        if not len(row):
            break
        lender = _PROBES[col, k]
        lent = full[row, lender]
        out[row[lent], col[lent]] = out[row[lent], lender[lent]]
        row, col = row[~lent], col[~lent]
    return out


def _band_hashes(signature: np.ndarray) -> np.ndarray:
    parts = signature.reshape(len(signature), BANDS, ROWS).astype(np.uint64)
    total = np.zeros(parts.shape[:2], np.uint64)
    for k in range(ROWS):
        total = mix(total + parts[:, :, k], k + 1)
    return mix(total + np.arange(BANDS, dtype=np.uint64)[None, :], 77)


def _new_lines(batches: Iterator[pa.RecordBatch]):
    """Slices with the lines that this task has not yet seen: (bytes, start, end, hashes)."""
    seen: set[int] = set()
    for batch in batches:
        for _, _, data, offsets in slices(batch.column("text"), 1 << 20):
            w = words(data, offsets, gaps=NEWLINE)
            # a shorter line is one shingle that only equal lines have, so its hash is enough
            fit = np.flatnonzero(w.end - w.start >= SHINGLE)
            _, one = np.unique(w.hashes[fit], return_index=True)
            fit = fit[np.sort(one)]
            fit = fit[[h not in seen for h in w.hashes[fit].tolist()]] if len(fit) else fit
            if len(seen) > REMEMBERED:
                seen.clear()
            seen.update(w.hashes[fit].tolist())
            yield data, w.start[fit], w.end[fit], w.hashes[fit]


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(line, its band hashes) of every line that this task has not yet seen."""
    for data, start, end, hashes in _new_lines(batches):
        bands = _band_hashes(signatures(data, start, end)).reshape(-1)
        cuts = pa.array(np.arange(len(hashes) + 1, dtype=np.int32) * np.int32(BANDS))
        lists = pa.ListArray.from_arrays(cuts, pa.array(bands.view(np.int64)))
        yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), lists], names=["h", "bands"])


def _bands(wanted: Bits):
    """(band, line) of the bands that the bitmap may hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bands = batch.column("bands").flatten().to_numpy()
            held = np.flatnonzero(wanted.has(bands.view(np.uint64)))
            line = batch.column("h").to_numpy()[held // BANDS]
            yield pa.RecordBatch.from_arrays([pa.array(bands[held]), pa.array(line)], names=["b", "h"])

    return run


def _texts(wanted: Bits):
    """(hash, line, shingles, parity bitmap) of the lines that the bitmap may hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for data, start, end, hashes in _new_lines(batches):
            held = np.flatnonzero(wanted.has(hashes))
            texts = pa.array([data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(start[held].tolist(), end[held].tolist())], pa.string())
            sizes, bits = np.zeros(len(held), np.int64), []
            for _, line, values in _sets(texts):
                n = np.bincount(line)
                sizes[len(bits) : len(bits) + len(n)] = n
                bits.extend(_parities(line, values, n))
            columns = [pa.array(hashes[held].view(np.int64)), texts, pa.array(sizes), pa.array(bits, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["h", "line", "n", "bits"])

    return run


def _shingles(line: str) -> frozenset[str]:
    return frozenset(line[i : i + SHINGLE] for i in range(max(1, len(line) - SHINGLE + 1)))


def similarity(a: str, b: str) -> float:
    """Jaccard similarity of the character shingles of two lines; a shorter line is one shingle."""
    x, y = _shingles(a), _shingles(b)
    return len(x & y) / len(x | y)


def _need(a: str, b: str, similar: float) -> str:
    """SQL for the least number of common shingles with which lines of a and b shingles are similar."""
    return f"ceil({similar}D * ({a} + {b}) / {1 + similar}D - 1e-9)"


def _parities(line: np.ndarray, values: np.ndarray, n: np.ndarray) -> list[bytes]:
    """For each line one bit per bucket of its shingles: whether an odd number fell into it."""
    wide = np.uint64(1) << np.clip(np.ceil(np.log2(np.maximum(n, 1))), *LOG_PARITY).astype(np.uint64)
    ends = np.cumsum((wide >> np.uint64(6)).astype(np.int64))
    flat = np.zeros(ends[-1], np.uint64)
    bit = mix(values, 6) & (wide[line] - np.uint64(1))
    first = ends - (wide >> np.uint64(6)).astype(np.int64)
    np.bitwise_xor.at(flat, first[line] + (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    return [flat[a:b].tobytes() for a, b in zip(first.tolist(), ends.tolist())]


def _differing(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Bits in which two parity bitmaps differ, the wider folded to the other's width: at most the shingles that only one line has."""
    widths = np.array([(len(x), len(y)) for x, y in zip(left, right, strict=True)], np.int64).reshape(-1, 2)
    out = np.zeros(len(left), np.int64)
    for pair in np.unique(widths, axis=0):
        at = np.flatnonzero((widths == pair).all(axis=1))
        folded = [
            np.bitwise_xor.reduce(np.frombuffer(b"".join(side[k] for k in at.tolist()), np.uint64).reshape(len(at), -1, pair.min() // 8), axis=1)
            for side in (left, right)
        ]
        out[at] = np.bitwise_count(folded[0] ^ folded[1]).sum(axis=1, dtype=np.int64)
    return out


def _close(similar: float):
    """Pairs whose parity bitmaps leave room for similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = batch.column("na").to_numpy() + batch.column("nb").to_numpy()
            room = both - 2 * np.ceil(similar * both / (1 + similar) - 1e-9)
            differing = _differing(batch.column("pa").to_pylist(), batch.column("pb").to_pylist())
            yield batch.select(["a", "b"]).filter(pa.array(differing <= room))

    return run


def _jaccard(left: pa.Array, right: pa.Array) -> np.ndarray:
    """The similarity of each pair of lines, a few megabytes of them."""
    sizes, keys, owners = np.zeros(len(left), np.int64), [], []
    for column in (left, right):
        for low, line, values in _sets(column):
            sizes += np.bincount(low + line, minlength=len(left))
            owners.append(low + line)
            # a shingle that both lines of a pair have is one value twice
            keys.append(mix(values + (low + line).astype(np.uint64) * _SPREAD, 8))
    keys, owners = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(keys)
    twice = order[1:][keys[order[1:]] == keys[order[:-1]]]
    common = np.bincount(owners[twice], minlength=len(left))
    return common / (sizes - common)


def _alike(similar: float):
    """Pairs of lines whose sets of shingles have the similarity asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            ends = np.cumsum(sum(np.diff(bytes_of(whole.column(c))[1]) for c in ("la", "lb")))
            low = 0
            while low < whole.num_rows:
                high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + (1 << 20), "right")))
                batch = whole.slice(low, high - low)
                yield batch.select(["a", "b"]).filter(pa.array(_jaccard(batch.column("la"), batch.column("lb")) >= similar))
                low = high

    return run


def _places(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column("id"), batch.column("key").to_numpy()
            for low, _, data, offsets in slices(batch.column("text")):
                w = words(data, offsets, gaps=NEWLINE)
                fit = np.flatnonzero(w.end - w.start >= least)
                doc = w.doc[fit]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(w.hashes[fit].view(np.int64)),
                        ids.take(pa.array(low + doc)),
                        pa.array(keys[low + doc]),
                        pa.array((fit - w.first[doc]).astype(np.int32)),
                    ],
                    names=["h", "id", "key", "at"],
                )

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = bytes_of(batch.column("text"))
        there = batch.column("there").to_pylist()
        lines, gone, texts, sums = [], [], [], []
        for i, drop in enumerate(batch.column("drop").to_pylist()):
            drop, at, kept = set(drop or ()), 0, []
            for line in data[offsets[i] : offsets[i + 1]].tobytes().split(b"\n"):
                if line:
                    if at not in drop:
                        kept.append(line)
                    at += 1
                else:
                    kept.append(line)
            text = b"\n".join(kept)
            lines.append(at)
            gone.append(len(drop))
            texts.append(text.decode("utf-8", "replace") if there[i] else None)
            sums.append(hashlib.sha256(text).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(lines, pa.int64()), pa.array(gone, pa.int64()), pa.array(texts, pa.string()), pa.array(sums, pa.string())],
            names=["id", "n_lines", "n_removed", "kept_text", "kept_sha256"],
        )


def _sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, place of the line, hash) of the distinct shingles of runs of lines, line by line."""
    for low, _, data, offsets in slices(column, 1 << 20):
        line, values = _hashed_shingles(data, offsets[:-1], offsets[1:])
        order = np.lexsort((values, line))
        line, values = line[order], values[order]
        new = np.ones(len(line), bool)
        new[1:] = (line[1:] != line[:-1]) | (values[1:] != values[:-1])
        yield low, line[new], values[new]


def _weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The parts of a task's sketch of how many lines hold a shingle."""
    sketch, some = np.zeros(1 << LOG_SKETCH, np.int64), False
    for batch in batches:
        for _, _, values in _sets(batch.column("line")):
            sketch += np.bincount(_bucket(values), minlength=1 << LOG_SKETCH)
            some = True
    if some:
        parts = sketch.astype("<i8").reshape(-1, 1 << LOG_PART)
        salt = [TaskContext.get().partitionId() % 64] * len(parts)
        columns = [pa.array(range(len(parts)), pa.int64()), pa.array(salt, pa.int64()), pa.array([x.tobytes() for x in parts], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["c", "n", "bits"])


def _prefixes(levels, similar: float):
    """(shingle, line, root, shingles of the line, place) of the first shingles of each line, those of few lines before others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, root = (batch.column(k).to_numpy() for k in ("h", "root"))
            for low, line, values in _sets(batch.column("line")):
                order = np.lexsort((values, levels.value[_bucket(values)], line))
                values = values[order]
                n = np.bincount(line)
                size = n[line]
                place = np.arange(len(line)) - (np.cumsum(n) - n)[line]
                held = np.flatnonzero(place <= size - np.ceil(similar * size - 1e-9))
                row = low + line[held]
                columns = [values[held].view(np.int64), h[row], root[row], size[held], place[held]]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["t", "h", "root", "n", "i"])

    return run


def _rest(texts: DataFrame, similar: float) -> DataFrame:
    """Pairs (a, b) of lines of different roots: all that can be similar; stored. ``texts`` has h, root and line.

    In a common order of the shingles, the first one that two similar lines share leaves both with enough
    shingles from there on; other places are not joined. What many lines quote stands last in the order, so a
    long template is joined only where a line consists of little else. Of two lines of one root none is sent:
    one of a pair is always outside the root that most lines of the shingle have. The joined places of a pair are
    the first that it shares, so their number and what follows the last of them bound what it has in common.
    """
    levels = texts.sparkSession.sparkContext.broadcast(_levels(texts.select("line").mapInArrow(_weights, "c long, n long, bits binary")))
    sent = stored(texts.mapInArrow(_prefixes(levels, similar), "t long, h long, root long, n long, i long"))
    mixed = sent.groupBy("t", "root").agg(F.count(F.lit(1)).alias("rows"))
    mixed = mixed.groupBy("t").agg(F.max_by("root", F.struct("rows", "root")).alias("main"), F.count(F.lit(1)).alias("roots")).where("roots > 1")
    need = lambda a, b: _need(a, b, similar)
    cells = stored(sent.join(mixed.select("t", "main"), "t").withColumn("early", F.expr(f"n - i >= {need('n', 'n')}")))
    drop(sent)
    pairs = []
    for left, right in (("root <> main", "true"), ("root = main", "root <> main")):
        x, y = cells.where("early").where(left).alias("x"), cells.where(right).alias("y")
        both = x.join(y, F.expr(f"x.t = y.t and x.root <> y.root and x.n <= y.n and least(x.n - x.i, y.n - y.i) >= {need('x.n', 'y.n')}"))
        # of two lines of one length each may be x
        pairs.append(both.where("x.n < y.n or x.h < y.h").selectExpr("x.h as a", "y.h as b", "x.n as na", "y.n as nb", "x.i as ia", "y.i as ib"))
    counted = pairs[0].union(pairs[1]).groupBy("a", "b", "na", "nb").agg(F.count(F.lit(1)).alias("common"), F.max("ia").alias("ia"), F.max("ib").alias("ib"))
    found = stored(counted.where(f"common + least(na - ia - 1, nb - ib - 1) >= {need('na', 'nb')}").select("a", "b"))
    drop(cells)
    return found


def similar_lines(texts: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """(line hash, root) of the lines that are like another one. ``texts`` has one column, text.

    Signatures are made once and stored. Bands are counted first; only lines of bands that hold two different
    lines are sent again. In each band all lines are compared with one of them, the hub, which is then done
    with; long bands get a few hubs, one after the other. Bands whose lines are not all together then give
    their lines to an exact join, so every similar pair that shares a band ends under one root. Tables go as soon as
    the next ones are made; the result is stored.
    """
    signed = stored(texts.mapInArrow(_signed, "h long, bands array<long>"))
    once = signed.select("h", F.explode("bands").alias("b")).groupBy("b").agg(F.min("h").alias("low"), F.max("h").alias("high"))
    once = stored(once.where("low <> high").select("b"))
    rows = signed.mapInArrow(_bands(bitmap(once, "b")), "b long, h long").join(once, "b")
    rows = stored(rows.distinct())
    drop(signed, once)
    lines = texts.mapInArrow(_texts(bitmap(rows, "h")), "h long, line string, n long, bits binary")
    lines = stored(lines.groupBy("h").agg(*[F.first(c).alias(c) for c in ("line", "n", "bits")]))

    def alike(pairs: DataFrame) -> DataFrame:
        """Those of the pairs that are similar; texts are sent only of pairs that sizes and bitmaps leave."""
        sides = [lines.selectExpr(f"h as {k}", f"n as n{k}", f"bits as p{k}") for k in "ab"]
        sized = pairs.join(sides[0], "a").join(sides[1], "b").where(f"{_need('na', 'nb', similar)} <= least(na, nb)")
        close = stored(sized.select("a", "b", "na", "nb", "pa", "pb").mapInArrow(_close(similar), "a long, b long"))
        full = close.join(lines.selectExpr("h as a", "line as la"), "a").join(lines.selectExpr("h as b", "line as lb"), "b")
        found = stored(full.select("a", "b", "la", "lb").mapInArrow(_alike(similar), "a long, b long"))
        drop(close)
        return found

    def rooted() -> DataFrame:
        return components(reduce(DataFrame.union, links).toDF("u", "v"), "h")

    placed = rows.withColumn("root", F.col("h"))
    links: list[DataFrame] = []
    roots: DataFrame | None = None
    for k in range(HUBS):
        hub = placed.groupBy("b").agg(F.min(F.struct(F.xxhash64("h", F.lit(k)).alias("o"), "h", "root")).alias("m"))
        hub = hub.select("b", F.col("m.h").alias("to"), F.col("m.root").alias("toroot"))
        pairs = placed.join(hub, "b").where("root <> toroot")
        links.append(alike(pairs.select(F.least("h", "to").alias("a"), F.greatest("h", "to").alias("b")).distinct()))
        if roots is not None:
            drop(roots)
        roots = rooted()
        # a hub has met all lines of its band; what is left is mixed while two of its lines have different roots
        left = rows.select("b", "h").join(hub.selectExpr("b", "to as h"), ["b", "h"], "left_anti").join(roots, "h", "left")
        left = left.withColumn("root", F.coalesce("root", "h"))
        mixed = left.groupBy("b").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("lines"))
        further = stored(left.join(mixed.where("low <> high").select("b", "lines"), "b").select("b", "h", "root", "lines"))
        drop(rows)
        rows = further
        placed = rows.where(F.col("lines") >= LONG)
        if placed.isEmpty():
            break
    rest = stored(rows.select("h", "root").distinct())
    drop(rows)
    if not rest.isEmpty():
        pairs = _rest(lines.join(rest, "h").select("h", "root", "line"), similar)
        links.append(alike(pairs))
        drop(roots, pairs)
        roots = rooted()
    drop(lines, rest, *links)
    return roots


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: float = SIMILAR, keep: str | None = None, least: int = LEAST) -> DataFrame:
    """One row per row of ``docs``: id, n_lines, n_removed, kept_text, kept_sha256, and the column ``keep`` if named.

    Lines are parted by line feeds; empty ones are not counted and stay. Lines of at least
    ``least`` bytes are compared by their 8-character shingles, shorter ones stay; 1 takes every line. Of each component of equal or similar lines one line is kept, the
    first by id (null ids last), then by place; the others go. A null text stays null and has no lines, an
    empty one stays empty. A row that repeats an id with another text is told apart by the text; of a row
    that repeats another one wholly both copies are cut alike, so they keep what the first of them keeps. An
    empty table gives no rows. A pair at similarity 0.8 shares a band with probability 0.998, and every similar
    pair that shares one is found, whatever the size of the band. Every removal is backed by a chain of exactly checked pairs.
    """
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("key", row_key("id", "text"))
    kind = base.schema["id"].dataType.simpleString()
    roots = similar_lines(base.select("text"), similar)
    places = stored(base.mapInArrow(_places(least), f"h long, id {kind}, key long, at int"))
    first = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("key"), F.col("at"))
    lines = places.groupBy("h").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("n"))
    lines = lines.join(roots, "h", "left").withColumn("root", F.coalesce("root", "h"))
    firsts = stored(lines.select("h", "root", "first", "n"))
    drop(roots)
    groups = firsts.groupBy("root").agg(F.min("first").alias("first"), F.sum("n").alias("n")).where("n > 1")
    lines = stored(firsts.join(groups.select("root", F.col("first").alias("kept")), "root").select("h", "kept.key", "kept.at").toDF("h", "kept_key", "kept_at"))
    gone = places.join(lines, "h").where("not (key = kept_key and at = kept_at)")
    gone = stored(gone.groupBy("key").agg(F.collect_set("at").alias("drop")))
    drop(firsts, places, lines)
    whole = docs.select(F.struct(F.col(id_col), *([F.col(keep)] if keep else [])).alias("id"), F.col(text_col).alias("text"), row_key(id_col, text_col).alias("key"))
    joined = whole.join(gone, "key", "left").select("id", "text", "drop", F.col("text").isNotNull().alias("there"))
    kind = joined.schema["id"].dataType.simpleString()
    out = joined.mapInArrow(_cut, f"id {kind}, n_lines long, n_removed long, kept_text string, kept_sha256 string")
    return out.select("id.*", "n_lines", "n_removed", "kept_text", "kept_sha256")
