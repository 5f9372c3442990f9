"""Quality scores by a generalised additive model with pairwise interactions.

Training visits the features in turn, again and again; each visit fits a shallow tree to the gradient of one
binned feature (or of a pair of coarsely binned ones) and adds a small step of it to that feature's table.
Scoring adds one entry of each table per row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.scratch import slices
from tallybook.llm.words import words

#: Labelled rows the model is fitted on at most (the first in a hash order), all others are only scored.
FIT_ROWS = 20_000
BINS, COARSE, PAIRS, ROUNDS, RATE, LEAVES = 48, 8, 10, 250, 0.08, 3
THRESHOLD = 0.3

FEATURES = (
    "log_bytes log_words word_length long_words upper digits punctuation ends_well wide_bytes spaces distinct_words"
    " top_word twin_words lines line_length distinct_lines markup symbols short_words digit_words capital_words rare_letters"
).split()

_KIND = np.zeros((256, 7), np.float32)
for _b in range(256):
    _c = chr(_b)
    _KIND[_b] = [
        _b < 128 and _c.isupper(),
        _b < 128 and _c.isdigit(),
        _c in ".,;:!?'\"()-",
        _b >= 128,
        _c in " \t\r\n",
        _c in "<>{}[]/\\=_|@#$%^&*~`+",
        _c in "qxzjkwyQXZJKWY",
    ]


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of FEATURES for each document of a slice; shares of nothing are 0."""
    n = len(offsets) - 1
    out = np.zeros((n, len(FEATURES)))
    put = {name: k for k, name in enumerate(FEATURES)}
    size = np.diff(offsets).astype(float)

    def per_doc(values: np.ndarray, cuts: np.ndarray = offsets) -> np.ndarray:
        sums = np.zeros(len(values) + 1)
        np.cumsum(values, out=sums[1:])
        return sums[cuts[1:]] - sums[cuts[:-1]]

    share = lambda a, b: a / np.maximum(b, 1)
    kinds = [share(per_doc(_KIND[:, k][data]), size) for k in range(7)]
    for name, k in (("upper", 0), ("digits", 1), ("punctuation", 2), ("wide_bytes", 3), ("spaces", 4), ("symbols", 5), ("rare_letters", 6)):
        out[:, put[name]] = kinds[k]
    w = words(data, offsets)
    many = np.diff(w.first).astype(float)
    length = (w.end - w.start).astype(float)
    out[:, put["log_bytes"]], out[:, put["log_words"]] = np.log1p(size), np.log1p(many)
    out[:, put["word_length"]] = share(per_doc(length, w.first), many)
    out[:, put["long_words"]] = share(per_doc(length > 12, w.first), many)
    out[:, put["short_words"]] = share(per_doc(length <= 3, w.first), many)
    first = data[w.start] if len(w.start) else np.zeros(0, np.uint8)
    out[:, put["digit_words"]] = share(per_doc((first >= 48) & (first < 58), w.first), many)
    out[:, put["capital_words"]] = share(per_doc((first >= 65) & (first < 91), w.first), many)
    twin = np.zeros(len(w.doc))
    twin[1:] = (w.hashes[1:] == w.hashes[:-1]) & (w.doc[1:] == w.doc[:-1])
    out[:, put["twin_words"]] = share(per_doc(twin, w.first), many)
    feed = data == 10
    lines = words(data, offsets, gaps=np.arange(256) == 10)
    rows = np.diff(lines.first).astype(float)
    out[:, put["lines"]] = np.log1p(per_doc(feed))
    out[:, put["line_length"]] = np.log1p(share(size, rows))
    last = data[lines.end - 1] if len(lines.end) else np.zeros(0, np.uint8)
    out[:, put["ends_well"]] = share(per_doc(np.isin(last, list(b".!?\"")), lines.first), rows)
    mark = np.zeros(len(data))
    mark[:-1] = (data[:-1] == 60) & (data[1:] != 32) if len(data) else mark[:-1]
    out[:, put["markup"]] = share(per_doc(mark), many)
    for d in range(n):
        own = w.hashes[w.first[d] : w.first[d + 1]]
        if len(own):
            _, counts = np.unique(own, return_counts=True)
            out[d, put["distinct_words"]] = len(counts) / len(own) ** 0.75
            out[d, put["top_word"]] = counts.max() / len(own)
        held = lines.hashes[lines.first[d] : lines.first[d + 1]]
        if len(held):
            out[d, put["distinct_lines"]] = len(np.unique(held)) / len(held)
    return out


def _tree(gain: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Newton steps of the best tree with LEAVES leaves over consecutive bins."""
    cuts = [0, len(gain)]
    g, h = np.append(0, np.cumsum(gain)), np.append(0, np.cumsum(weight)) + 0.0
    value = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + 1.0)
    for _ in range(LEAVES - 1):
        best = (1e-9, -1)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            mid = np.arange(a + 1, b)
            if len(mid):
                better = value(a, mid) + value(mid, b) - value(a, b)
                k = int(better.argmax())
                best = max(best, (float(better[k]), int(mid[k])))
        if best[1] < 0:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(len(gain))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + 1.0)
    return out


def _square(gain: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Newton steps of the best tree that cuts one axis, then the other on either side; and its gain."""
    best, out = 0.0, np.zeros_like(gain)
    for turn in (False, True):
        g, h = (gain.T, weight.T) if turn else (gain, weight)
        G, H = (np.pad(np.cumsum(np.cumsum(x, axis=0), axis=1), ((1, 0), (1, 0))) for x in (g, h))
        n, m = g.shape
        score = lambda a, b, c, d: (G[b, d] - G[a, d] - G[b, c] + G[a, c]) ** 2 / (H[b, d] - H[a, d] - H[b, c] + H[a, c] + 1.0)
        mid = np.arange(1, m)
        for cut in range(1, n):
            parts = [(0, cut), (cut, n)]
            found = [score(a, b, 0, mid) + score(a, b, mid, m) for a, b in parts]
            total = sum(x.max() for x in found) - score(0, n, 0, m)
            if total > best:
                best, out = float(total), np.zeros((n, m))
                for (a, b), x in zip(parts, found, strict=True):
                    k = int(mid[x.argmax()])
                    for c, d in ((0, k), (k, m)):
                        out[a:b, c:d] = g[a:b, c:d].sum() / (h[a:b, c:d].sum() + 1.0)
                out = out.T if turn else out
    return out, best


@dataclass
class Model:
    """Bin edges and lookup tables; the score is the logistic of their sum."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for k, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[k], x[:, k], "right")]
        bins = {k: np.searchsorted(self.coarse[k], x[:, k], "right") for a, b, _ in self.pairs for k in (a, b)}
        for a, b, table in self.pairs:
            total += table[bins[a], bins[b]]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) if len(column) else np.zeros(0)


def boost(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting of the single tables, then of the pairs that lower the loss most."""
    rate = (y.sum() + 0.5) / (len(y) + 1.0)
    model = Model(float(np.log(rate / (1 - rate))), [], [], [], [])
    for k in range(x.shape[1]):
        model.edges.append(_edges(x[:, k], BINS))
        model.coarse.append(_edges(x[:, k], COARSE))
        model.tables.append(np.zeros(len(model.edges[k]) + 1))
    if len(np.unique(y)) < 2:
        return model
    bins = [np.searchsorted(e, x[:, k], "right") for k, e in enumerate(model.edges)]
    rough = [np.searchsorted(e, x[:, k], "right") for k, e in enumerate(model.coarse)]
    margin = np.full(len(y), model.base)

    def slope() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-margin))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(ROUNDS):
        for k, own in enumerate(bins):
            g, h = slope()
            size = len(model.tables[k])
            step = RATE * _tree(np.bincount(own, g, size), np.bincount(own, h, size))
            model.tables[k] += step
            margin += step[own]
    g, h = slope()
    shape = [len(e) + 1 for e in model.coarse]
    table = lambda a, b, v: np.bincount(rough[a] * shape[b] + rough[b], v, shape[a] * shape[b]).reshape(shape[a], shape[b])
    gains = [(_square(table(a, b, g), table(a, b, h))[1], a, b) for a in range(x.shape[1]) for b in range(a)]
    model.pairs = [(a, b, np.zeros((shape[a], shape[b]))) for gain, a, b in sorted(gains, reverse=True)[:PAIRS] if gain > 0]
    for _ in range(ROUNDS // 5):
        for a, b, held in model.pairs:
            g, h = slope()
            step = RATE * _square(table(a, b, g), table(a, b, h))[0]
            held += step
            margin += step[rough[a], rough[b]]
    return model


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high, data, offsets in slices(batch.column("text")):
            x = features(data, offsets)
            flat = pa.array(x.reshape(-1))
            cuts = pa.array((np.arange(high - low + 1) * len(FEATURES)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("label").slice(low, high - low), pa.ListArray.from_arrays(cuts, flat)], names=["label", "x"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = FIT_ROWS) -> Model:
    """A model from at most ``rows`` labelled documents, the first by a hash of the id.

    Null labels are left out; an id that is labelled twice counts with its smallest label. Only features,
    ``rows`` times 22 numbers, reach the driver. Without labelled rows every score is one half.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("label is not null and id is not null")
    known = known.groupBy("id").agg(F.min("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(rows)
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(known, "id")
    got = base.select("label", "text").mapInArrow(_featured, "label int, x array<double>")
    got = got.orderBy(F.xxhash64("x"), "x").limit(rows).toPandas()
    x = np.array(got["x"].tolist(), float).reshape(-1, len(FEATURES))
    return boost(x, got["label"].to_numpy(float))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: id, score (0 to 1, higher is better), predicted (1 from the threshold on).

    Only the text is looked at; null counts as empty, and empty texts are scored like others. Rows are
    independent: nothing is shuffled, rows that repeat get equal scores. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores = [model.score(features(data, offsets)) for _, _, data, offsets in slices(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(np.concatenate([np.zeros(0), *scores]))], names=["id", "score"])

    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = base.mapInArrow(run, f"id {kind}, score double")
    return out.select(F.col("id").alias(id_col), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
