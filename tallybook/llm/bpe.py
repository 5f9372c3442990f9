"""Byte-level BPE with word ends, encoded by a queue of merge ranks over a linked list of symbols."""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Distinct words a worker remembers; when full it starts anew. Only speed depends on it.
REMEMBERED = 300_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class Remembered(dict):
    """Results of a function by argument, forgotten all at once when there are too many."""

    def __init__(self, make):
        super().__init__()
        self._make = make

    def __missing__(self, key):
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[key] = self._make(key)
        return value


class Bpe:
    """The vocabulary, merges, splitting pattern and special tokens of a tokenizer file's text."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        steps = [x["type"] for x in spec["normalizer"]["normalizers"]]
        splits = [x["type"] for x in spec["pre_tokenizer"]["pretokenizers"]]
        if model["type"] != "BPE" or steps != ["NFC", "Replace", "Lowercase"] or splits != ["Split", "ByteLevel"]:
            raise ValueError("not a lower-casing byte-level BPE file with word ends")
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = dict(model["vocab"])
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges.setdefault((self.vocab[a], self.vocab[b]), (rank, self.vocab[a + b]))
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.strings = {i: s for s, i in [*self.vocab.items(), *self.special.items()]}
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        longest = sorted(self.special, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if longest else None
        symbols = byte_symbols()
        self.inner = [self.vocab[s] for s in symbols]
        self.final = [self.vocab[s + self.suffix] for s in symbols]
        self._words = Remembered(lambda word: np.array(self.merge(word), "<u4").tobytes())

    def merge(self, word: str) -> list[int]:
        """The ids of one word. Stale queue entries are those whose pair of symbols has changed since."""
        data = word.encode()
        ids = [*(self.inner[b] for b in data[:-1]), self.final[data[-1]]]
        n = len(ids)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        queue = [(*self.merges[pair], i) for i in range(n - 1) if (pair := (ids[i], ids[i + 1])) in self.merges]
        queue = [(rank, i, new) for rank, new, i in queue]
        heapq.heapify(queue)
        while queue:
            rank, i, new = heapq.heappop(queue)
            j = after[i]
            if ids[i] < 0 or j < 0 or self.merges.get((ids[i], ids[j])) != (rank, new):
                continue
            ids[i], ids[j] = new, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right >= 0 and (found := self.merges.get((ids[left], ids[right]))):
                    heapq.heappush(queue, (found[0], left, found[1]))
        return [x for x in ids if x >= 0]

    def _plain(self, text: str) -> bytes:
        if not text.isascii():
            # lower case is taken character by character, so a final sigma is an ordinary one
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        known = self._words
        return b"".join([known[w] for w in self.pattern.findall(text.lower())])

    def encode(self, text: str) -> bytes:
        """The ids of a text, four bytes each, low byte first."""
        if self.marks is None or "<" not in text:
            return self._plain(text)
        parts = self.marks.split(text)
        return b"".join(self.special[x].to_bytes(4, "little") if x in self.special else self._plain(x) for x in parts)

    def decode(self, ids: bytes) -> str:
        """The vocabulary strings of the ids, in order, with one space between them."""
        strings = self.strings
        return " ".join([strings[i] for i in np.frombuffer(ids, "<u4").tolist()])


def encode_decode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, n_tokens, ids_sha256, decoded_sha256, and with ``ids`` also ids and decoded.

    ``tokenizer`` is the path of the file on the driver; its text, a few megabytes, is broadcast. A null text
    counts as empty and has no tokens. Special tokens that stand in a text are taken as such. Rows are
    independent of each other, so nothing is shuffled; extra columns are left alone.
    """
    with open(tokenizer, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(spec.value)
        for batch in batches:
            texts = batch.column("text")
            for low in range(0, len(texts), 256):
                part = texts.slice(low, 256)
                coded = [bpe.encode(x or "") for x in part.to_pylist()]
                plain = [bpe.decode(x) for x in coded]
                columns = {
                    "id": batch.column("id").slice(low, 256),
                    "n_tokens": pa.array([len(x) // 4 for x in coded], pa.int64()),
                    "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in coded], pa.string()),
                    "decoded_sha256": pa.array([hashlib.sha256(x.encode()).hexdigest() for x in plain], pa.string()),
                }
                if ids:
                    columns["ids"] = pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in coded], pa.list_(pa.int32()))
                    columns["decoded"] = pa.array(plain, pa.string())
                yield pa.RecordBatch.from_pydict(columns)

    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * ids
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return base.mapInArrow(run, schema).withColumnRenamed("id", id_col)
