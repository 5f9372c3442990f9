"""Sharding by best-fit-decreasing bin packing of indivisible groups."""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallybook.llm.scratch import stored

#: A group of over 1/BIG of a shard is an item of its own; smaller ones enter as cells of many groups.
BIG = 256
#: Cells for each shard, and shards that one task packs: a task sees (BIG + CELLS) * SHARDS_A_TASK items at most.
CELLS, SHARDS_A_TASK = 512, 256
#: Parts of a shard that are numbered side by side.
PARTS = 256


class Bins:
    """Open bins in a balanced order by remaining capacity: B-tree leaves of at most 512 entries."""

    def __init__(self):
        self._leaves: list[list[tuple[int, int]]] = [[]]

    def add(self, left: int, bin_no: int) -> None:
        k = self._leaf((left, bin_no))
        insort(self._leaves[k], (left, bin_no))
        if len(self._leaves[k]) > 512:
            full = self._leaves[k]
            self._leaves[k : k + 1] = [full[:256], full[256:]]

    def _leaf(self, key: tuple[int, int]) -> int:
        ends = [leaf[-1] if leaf else (-1, -1) for leaf in self._leaves]
        return min(bisect_left(ends, key), len(self._leaves) - 1)

    def take(self, size: int) -> tuple[int, int] | None:
        """Removes and returns the bin with the least remaining capacity that holds ``size``."""
        k = self._leaf((size, -1))
        at = bisect_left(self._leaves[k], (size, -1))
        if at == len(self._leaves[k]):
            return None
        found = self._leaves[k].pop(at)
        if not self._leaves[k] and len(self._leaves) > 1:
            del self._leaves[k]
        return found


def best_fit(sizes: list[int], capacity: int) -> tuple[list[int], int]:
    """The bin of each size, in descending order of size, and the number of bins.

    A size over the capacity gets a bin of its own. Ties go to the first of the list and the oldest bin.
    """
    bins, out, used = Bins(), [0] * len(sizes), 0
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = bins.take(sizes[i])
        left, number = found if found else (max(capacity, sizes[i]), used)
        used += not found
        out[i] = number
        bins.add(left - sizes[i], number)
    return out, used


def fewest(sizes: list[int], shards: int) -> list[int]:
    """Best fit at the smallest capacity, to a thousandth, with which it needs no more than ``shards`` bins."""
    low = max([-(-sum(sizes) // shards), *sizes, 1])
    high, step = low, max(1, low // 1000)
    while best_fit(sizes, high)[1] > shards:
        low, high = high, high + step
        step *= 2
    while high - low > max(1, high // 100_000):
        middle = (low + high) // 2
        low, high = (low, middle) if best_fit(sizes, middle)[1] <= shards else (middle, high)
    return best_fit(sizes, high)[0]


def assign(docs: DataFrame, shards: int | None = None, capacity: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, size, text_crc32, shard, slot.

    Give either the number of shards (their sizes come out near equal) or a capacity (few shards of it).
    Size is the UTF-8 bytes of the text plus 1; null counts as empty. Rows of equal texts are one group and
    stay together. Groups over 1/256 of a shard are packed one by one; the others are many, so they are first
    gathered by hash into cells, which are packed after the same rule. The items a task packs are bounded by
    constants, whatever the number of rows; beyond 256 shards several tasks pack their own shares of the
    items. Slots run from 0 without gaps in each shard: parts of a shard are counted, then numbered side by
    side, so no task holds a whole shard. An empty table gives no rows. Rows that repeat get slots of their own.
    """
    if (shards is None) == (capacity is None):
        raise ValueError("give shards or capacity")
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("content"),
    )
    base = stored(base)
    total = base.agg(F.sum("size")).first()[0] or 0
    room = capacity if capacity is not None else max(1, -(-total // shards))
    count = shards if shards is not None else max(1, -(-total // max(1, capacity)))
    lanes = 1 if shards is not None else -(-count // SHARDS_A_TASK)
    cell = F.pmod(F.xxhash64("content"), F.lit(CELLS * count))
    groups = base.groupBy("content").agg(F.sum("size").alias("bytes"))
    item = F.when(F.col("bytes") * BIG > room, F.hex("content")).otherwise(cell.cast("string"))
    groups = stored(groups.select("content", "bytes", item.alias("item")))
    items = groups.groupBy("item").agg(F.sum("bytes").alias("bytes"))
    items = items.withColumn("lane", F.pmod(F.xxhash64("item"), F.lit(lanes)))

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("item")
        sizes = frame["bytes"].tolist()
        bins = fewest(sizes, shards) if shards is not None else best_fit(sizes, capacity)[0]
        return pd.DataFrame({"item": frame["item"], "lane": frame["lane"], "bin": bins})

    packed = stored(items.groupBy("lane").applyInPandas(pack, "item string, lane long, bin long"))
    lane = packed.groupBy("lane").agg((F.max("bin") + 1).alias("bins"))
    before = Window.orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    lane = lane.select("lane", F.coalesce(F.sum("bins").over(before), F.lit(0)).alias("offset"))
    placed = packed.join(lane, "lane").select("item", (F.col("bin") + F.col("offset")).cast("int").alias("shard"))
    homes = groups.join(placed, "item").select("content", "shard")
    rows = base.join(homes, "content").withColumn("part", F.pmod(F.xxhash64("id", "content"), F.lit(PARTS)))
    rows = stored(rows.select("id", "size", "text_crc32", "shard", "part"))
    counts = rows.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("shard", "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    own = F.row_number().over(Window.partitionBy("shard", "part").orderBy("id", "text_crc32", "size"))
    numbered = rows.withColumn("k", own).join(counts, ["shard", "part"])
    return numbered.select(
        F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("ahead") + F.col("k") - 1).alias("slot")
    )
