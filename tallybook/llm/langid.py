"""Language identification with error-correcting output codes over binary n-gram classifiers."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.scratch import slices

_U = np.uint32
LOG_BUCKETS = 15
UNKNOWN = "und"
#: Below this score the nearest codeword is not much nearer than the second.
AMBIGUOUS = 0.6
#: Languages are the rows of a table that the driver holds; more distinct labels than this are refused.
LANGUAGES = 256

_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
for _b in range(128):
    if not chr(_b).isalpha():
        _PLAIN[_b] = 0x20


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the three bytes that begin at each place, and whether they lie in one document and word run."""
    d = _PLAIN[data].astype(np.uint32)
    n = max(0, len(d) - 2)
    key = d[:n] | d[1 : n + 1] << _U(8) | d[2 : n + 2] << _U(16)
    valid = ~((d[1 : n + 1] == 32) & ((d[:n] == 32) | (d[2 : n + 2] == 32)))
    for back in (1, 2):
        cut = offsets[1:] - back
        valid[cut[(cut >= 0) & (cut < n)]] = False
    return (key * _U(0x9E3779B1)) >> _U(32 - LOG_BUCKETS), valid


def codewords(n: int) -> np.ndarray:
    """A row of +1 and -1 for each of n languages: every split in two for up to six, else random distinct ones.

    Six languages have ten splits into equal halves, fewer than are wanted; from seven on there are enough.
    """
    if n < 2:
        return np.ones((n, 1))
    if n <= 6:
        splits = np.arange(1, 1 << (n - 1))
        bits = (splits[None, :] >> np.arange(n)[:, None]) & 1
        return np.where(bits == 1, 1.0, -1.0)
    rng, columns = np.random.default_rng(n), set()
    wanted = int(10 * np.ceil(np.log2(n)))
    while len(columns) < wanted:
        half = np.full(n, -1)
        half[rng.permutation(n)[: n // 2]] = 1
        columns.add(tuple(half * half[0]))
    return np.array(sorted(columns), float).T


@dataclass
class Model:
    """Weights of the bit classifiers by bucket, and what decoding needs."""

    langs: list[str]
    code: np.ndarray
    weights: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    trust: np.ndarray

    @staticmethod
    def of(langs: list[str], counts: np.ndarray) -> Model:
        """From the counts of each language (row) and bucket. A classifier's output is the mean over a text's
        n-grams of log(share in the languages with bit 1 / share in those with bit 0)."""
        shares = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True) if len(langs) else counts
        code = codewords(len(langs))
        weights = np.zeros((code.shape[1], counts.shape[1]), np.float32)
        centre, scale, trust = (np.zeros(code.shape[1]) for _ in range(3))
        for b in range(code.shape[1] if len(langs) > 1 else 0):
            on = code[:, b] > 0
            weights[b] = np.log(shares[on].mean(axis=0) / shares[~on].mean(axis=0))
            mean = shares @ weights[b]
            low, high = mean[~on].max(), mean[on].min()
            centre[b] = (low + high) / 2
            scale[b] = max(1e-6, np.abs(mean - centre[b]).mean())
            trust[b] = max(0.05, (high - low) / 2)
        return Model(langs, code, weights, centre, scale, trust / max(trust.sum(), 1e-9))

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(language number, score) of the documents of a slice, by loss-weighted decoding."""
        n = len(offsets) - 1
        if len(self.langs) < 2:
            return np.zeros(n, np.int64), np.ones(n)
        at, valid = _grams(data, offsets)
        sums = np.zeros(len(at) + 1)
        first, end = (np.minimum(x, len(at)) for x in (offsets[:-1], offsets[1:]))
        np.cumsum(valid, out=sums[1:])
        many = sums[end] - sums[first]
        outputs = np.zeros((n, len(self.weights)))
        for b, weights in enumerate(self.weights):
            np.cumsum(np.where(valid, weights[at], 0.0), out=sums[1:])
            outputs[:, b] = ((sums[end] - sums[first]) / np.maximum(many, 1) - self.centre[b]) / self.scale[b]
        margin = outputs[:, None, :] * self.code[None, :, :]
        loss = (np.logaddexp(0, -3 * margin) * self.trust).sum(axis=2)
        best = loss.argmin(axis=1)
        near = np.exp((loss.min(axis=1, keepdims=True) - loss) * 3)
        return best, 1 / near.sum(axis=1)


def fit(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Model:
    """A model from all rows with a label and a text: n-gram counts are summed by the executors.

    The driver receives at most 2**15 sums per language. Null labels and null texts are left out; no labelled
    row gives a model without languages.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for low, high, data, offsets in slices(batch.column("text")):
                at, valid = _grams(data, offsets)
                for lang in set(langs[low:high]):
                    chosen = np.repeat(langs[low:high] == lang, np.diff(offsets))[: len(at)] & valid
                    total = held.setdefault(lang, np.zeros(1 << LOG_BUCKETS, np.int64))
                    total += np.bincount(at[chosen], minlength=1 << LOG_BUCKETS)
        for lang, total in held.items():
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(total[some])],
                names=["lang", "bucket", "n"],
            )

    base = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    base = base.where("lang is not null and text is not null")
    sums = base.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = sums.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("x")).limit(LANGUAGES + 1).collect()
    if len(table) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    table = sorted(table, key=lambda r: r["lang"])
    counts = np.zeros((len(table), 1 << LOG_BUCKETS))
    for k, row in enumerate(table):
        for bucket, n in row["x"]:
            counts[k, bucket] = n
    return Model.of([r["lang"] for r in table], counts)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, lang_pred, score, ambiguous.

    ``und`` with score 0 and ambiguous are texts that are null or hold no letter, and all texts if the model
    knows no language. The score, from 0 to 1, compares the nearest codeword with all others; under 0.6 the
    answer counts as ambiguous. Only the text is looked at. Rows are independent: nothing is shuffled, rows
    that repeat get equal answers, ties go to the language that sorts first.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            known = batch.column("known").to_numpy(zero_copy_only=False).astype(bool)
            langs, scores = np.full(len(known), UNKNOWN, object), np.zeros(len(known))
            if model.langs:
                for low, high, data, offsets in slices(batch.column("text")):
                    best, score = model.predict(data, offsets)
                    langs[low:high] = np.array(model.langs, object)[best]
                    scores[low:high] = score
                langs[~known], scores[~known] = UNKNOWN, 0.0
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(langs, pa.string()), pa.array(scores)], names=["id", "lang_pred", "score"]
            )

    text = F.col(text_col)
    base = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("known"))
    out = base.mapInArrow(run, f"id {kind}, lang_pred string, score double")
    return out.withColumn("ambiguous", F.col("score") < AMBIGUOUS).withColumnRenamed("id", id_col)
