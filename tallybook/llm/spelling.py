"""Spelling variants of a corpus: words one edit apart, and the form each stands for."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.scratch import stored

#: Letters of a word (A-Z are lower-cased first), the divisor that picks a deletion, the least
#: code points and occurrences of a word, and how many times a form outnumbers the words that stand for it.
LETTERS, DIVISOR, LEAST_LETTERS, LEAST_OCCURRENCES, TIMES = "a-zÀ-ÿ", 199, 6, 5, 5
#: Words one edit apart differ in at most two places of their multisets. Places are dealt to two parts, of
#: which one differs in at most one place; that one's three sub-parts agree but for one.
DISTANCE, PARTS, SUB_PARTS = 2, 2, 3
#: Distinct words a task counts before it passes them on; characters of a text looked through at once.
COUNTED, CHUNK = 200_000, 1 << 20


def runs(text: str) -> Iterator[str]:
    """The lower-cased runs of letters that are long enough, a part of a long text at a time."""
    word, low = re.compile(f"[{LETTERS}]{{{LEAST_LETTERS},}}"), 0
    other = re.compile(f"[^A-Z{LETTERS}]")
    while low < len(text):
        found = other.search(text, low + CHUNK) if len(text) - low > CHUNK else None
        high = found.start() if found else len(text)
        # bytes are lower-cased in ASCII only
        yield from word.findall(text[low:high].encode().lower().decode())
        low = high


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the corpus's words of enough letters after the deletions, counted over all texts.

    A run of letters of a document is changed by the CRC-32 of ``<id>:<run>``: where 199 divides it, the code
    point at that number modulo the run's length goes. A null id is written as nothing.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def passed() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_pydict({"word": pa.array(total.keys(), pa.string()), "n": pa.array(total.values(), pa.int64())})
            total.clear()
            return batch

        for batch in batches:
            for row in range(batch.num_rows):
                text = batch.column("text")[row].as_py()
                if not text:
                    continue
                start = zlib.crc32(f"{batch.column('id')[row].as_py() or ''}:".encode())
                for run, n in Counter(runs(text)).items():
                    h = zlib.crc32(run.encode(), start)
                    if h % DIVISOR == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                        if len(run) < LEAST_LETTERS:
                            continue
                    total[run] += n
                if len(total) >= COUNTED:
                    yield passed()
        if total:
            yield passed()

    base = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return base.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def signatures(word: str) -> Iterator[str]:
    """The PartEnum signatures of a word's letters, each with a half of the word that an edit leaves alone.

    The multiset of letters is the set of (letter, how many before it), a binary vector; places are dealt by
    hash to parts and sub-parts. Of each part every choice of sub-parts but one is a signature. Of two words
    one edit apart, the shorter of m letters, either the first m // 2 letters are equal or the last (m - 1) // 2;
    a word serves as the shorter or the longer one, so it is listed for its own length and for one less.
    """
    seen: dict[str, int] = {}
    dealt: list[list[list[str]]] = [[[] for _ in range(SUB_PARTS)] for _ in range(PARTS)]
    for letter in sorted(word):
        place = f"{letter}{seen.setdefault(letter, 0)}"
        seen[letter] += 1
        h = xxhash.xxh64_intdigest(place)
        dealt[h % PARTS][h // PARTS % SUB_PARTS].append(place)
    differ = (DISTANCE + 1 + PARTS - 1) // PARTS - 1
    halves = [f"{m}<{word[: m // 2]}" for m in (len(word), len(word) - 1)]
    halves += [f"{m}>{word[len(word) - (m - 1) // 2 :]}" for m in (len(word), len(word) - 1)]
    for part, subs in enumerate(dealt):
        for chosen in combinations(range(SUB_PARTS), SUB_PARTS - differ):
            letters = f"{part}{chosen}" + ",".join(x for k in chosen for x in subs[k])
            yield from (f"{half}|{letters}" for half in halves)


def near_words(words: DataFrame) -> DataFrame:
    """(word, other), both ways, of the words of a (word, ...) table that are exactly one edit apart.

    An equi-join on signatures finds the candidates, the edit distance over code points decides. Words that
    share a signature agree in half their letters, in order, and in most of the others.
    """

    def sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for low in range(0, len(frame), 2000):
                part = frame["word"].iloc[low : low + 2000]
                found = [(w, k) for w in part for k in {xxhash.xxh64_intdigest(s) - (1 << 63) for s in signatures(w)}]
                yield pd.DataFrame(found, columns=["word", "key"])

    signed = stored(words.select("word").mapInPandas(sign, "word string, key long"))
    other = signed.select(F.col("word").alias("other"), F.col("key").alias("k"))
    both = signed.join(other, (F.col("key") == F.col("k")) & (F.col("word") < F.col("other")))
    one = both.where(F.levenshtein("word", "other", 1) == 1).select("word", "other").distinct()
    one = stored(one)
    return one.union(one.select("other", "word"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of a (word, form) table whose forms lead to no circle; a null form ends the way.

    Every round doubles the steps that are taken, so there are as many rounds as the length of the longest
    way has binary digits.
    """
    way = stored(forms.select("word", F.coalesce("form", "word").alias("root")))
    while True:
        on = way.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = stored(way.join(on, "root").select("word", F.col("next").alias("root"), (F.col("root") != F.col("next")).alias("moved")))
        if further.where("moved").isEmpty():
            return further.select("word", "root")
        way = further.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word of at least 6 code points and 5 occurrences: word, form, root, n, n_near, form_n.

    A word's form is the word one edit away with most occurrences, the first in code-point order of those with
    equally many, if it occurs at least five times as often; its root is the last of the forms. n_near counts
    the words one edit away. Null and empty texts have no words, rows that repeat count again, extra columns
    are left alone, an empty table gives no rows, long texts are taken in parts that end between words. Counts
    are combined in the task before the shuffle, so a frequent word is one row a task; everything after that
    works on the distinct words.
    """
    words = stored(occurrences(docs, id_col, text_col).where(F.col("n") >= LEAST_OCCURRENCES))
    near = near_words(words).join(words.toDF("other", "m"), "other")
    # min of (-m, other) is the most frequent, then the first
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("minus"), F.col("other").alias("other"))).alias("best"))
    held = words.join(best, "word", "left")
    more = F.coalesce(-F.col("best.minus") >= TIMES * F.col("n"), F.lit(False))
    found = stored(
        held.select(
            "word",
            F.when(more, F.col("best.other")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(more, -F.col("best.minus")).alias("form_n"),
        )
    )
    return found.join(roots(found), "word").select("word", "form", "root", "n", "n_near", "form_n")
