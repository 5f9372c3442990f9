"""Near-dedup of vectors by exact products within overlapping cluster shards.

Equal vectors of a label are one node with a count. Nodes are split into cluster shards until each has a
bounded number of residents. Where a vector within the link distance could reside in another shard (the
distance to the boundary between the two centroids is at most that distance), a node may have to visit it;
of two shards one side visits the other, so a link across a boundary is looked for once and counted for
both ends. Each shard multiplies its residents and visitors with its residents, block by block. Only residents
are found, so a pair is counted once however many shards both visit. No step is approximate.

Exact boundaries hardly part vectors of many dimensions, so shards are as large as a task's memory allows:
every split adds visits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.graph import components
from tallybook.llm.scratch import stored

LINK = 0.98
#: Residents a shard aims at and may have; children of a split; rows that a split's centroids are fitted on.
AIM, MOST, FAN, FIT = 4096, 8192, 32, 8192
#: Visitors that one task takes; with more, the residents are searched in several tasks.
VISITORS = MOST
#: Rows that are multiplied at once.
BLOCK = 256


def _unit(column: pd.Series) -> np.ndarray:
    x = np.array(column.tolist(), np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _centroids(frame: pd.DataFrame) -> pd.DataFrame:
    """A few rounds of spherical k-means on the sampled rows of one shard."""
    frame = frame.sort_values("c")
    x, k = _unit(frame["v"]), int(frame["fan"].iloc[0])
    x = np.unique(x, axis=0)
    rng = np.random.default_rng(1)
    middle = x[rng.permutation(len(x))[:k]]
    for _ in range(8):
        nearest = (x @ middle.T).argmax(axis=1)
        sums = np.stack([x[nearest == j].sum(axis=0) if (nearest == j).any() else middle[j] for j in range(len(middle))])
        middle = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return pd.DataFrame({"shard": frame["shard"][:1], "centroids": [middle.tolist()]})


def _goes(own, other):
    """Whether residents of ``own`` visit ``other``; of two different shards exactly one goes to the other."""
    return (own < other) == ((own + other) % 2 == 0)


def _routes(link: float):
    """Each row's new home (residents only), and the shards it visits."""
    reach = np.sqrt(2 - 2 * link)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for shard, own in frame.groupby("shard"):
                x, middle = _unit(own["v"]), np.array([list(m) for m in own["centroids"].iloc[0]], float)
                far = 2 - 2 * x @ middle.T
                home = far.argmin(axis=1)
                apart = np.sqrt(np.maximum(0, 2 - 2 * middle @ middle.T))
                near = far - far.min(axis=1, keepdims=True) <= 2 * reach * apart[home] + 1e-9
                here, to = home[:, None], np.arange(len(middle))
                near &= ~own["home"].to_numpy(bool)[:, None] | (here == to) | _goes(here, to)
                row, child = np.nonzero(near)
                out = own.iloc[row][["c", "m", "v"]].copy()
                out["home"] = own["home"].to_numpy()[row] & (child == home[row])
                out["shard"] = [f"{shard}.{j}" for j in child]
                yield out[["shard", "c", "m", "v", "home"]]

    return run


def _found(link: float):
    """Per node of a task: links counted with copies, those with visitors at both ends; and edges that connect what was found."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["c", "home"], ascending=[True, False])
        names, copies, home = frame["c"].to_numpy(), frame["m"].to_numpy(), frame["home"].to_numpy(bool)
        asks, x = frame["asks"].to_numpy(bool), _unit(frame["v"])
        residents = np.flatnonzero(home)
        asking, to = np.flatnonzero(asks), x[residents]
        label = np.arange(len(names))
        count, joined = np.zeros(len(names), np.int64), []
        for low in range(0, len(asking), BLOCK):
            q = asking[low : low + BLOCK]
            near = x[q] @ to.T >= link
            near &= q[:, None] != residents[None, :]
            count[q] += near @ copies[residents]
            visits = ~home[q]
            count[residents] += copies[q[visits]] @ near[visits]
            for k in np.flatnonzero(near.any(axis=1)):
                hits = residents[near[k]]
                held = label[hits]
                if (held == label[q[k]]).all():
                    continue
                others, one = np.unique(held, return_index=True)
                joined += [(names[q[k]], names[j]) for j, other in zip(hits[one], others, strict=True) if other != label[q[k]]]
                label[np.isin(label, others)] = label[q[k]]
        told = asks | (count > 0)
        own = names[told].tolist()
        pairs = [*zip(*joined)] or [(), ()]
        none = [None] * len(joined)
        return pd.DataFrame(
            {
                "c": pd.array(own + none, "Int64"),
                "links": np.concatenate([count[told], np.zeros(len(joined), np.int64)]),
                "u": pd.array([None] * len(own) + [int(x) for x in pairs[0]], "Int64"),
                "v": pd.array([None] * len(own) + [int(x) for x in pairs[1]], "Int64"),
            }
        )

    return run


def _nodes(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, DataFrame]:
    """All rows with the name of their node (null where a row links with nothing), and the nodes with counts."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.col(label_col).cast("string").alias("label"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.col("label").isNotNull() & F.col("v").isNotNull() & ~bad & F.exists("v", lambda x: x != 0)
    # scaled by a power of two to about 1, so that squares neither overflow nor vanish, and -0 is 0
    most = F.aggregate("v", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x)))
    scale = F.pow(F.lit(2.0), -F.floor(F.log2(most)))
    even = F.transform("v", lambda x: x * scale + F.lit(0.0))
    rows = rows.withColumn("ok", F.coalesce(usable, F.lit(False)))
    rows = stored(rows.withColumn("v", F.when(F.col("ok"), even)).withColumn("c", F.when(F.col("ok"), F.xxhash64("label", "v"))))
    nodes = rows.where("ok").groupBy("c").agg(F.first("label").alias("label"), F.first("v").alias("v"), F.count(F.lit(1)).alias("m"))
    return rows.select("id", "c"), stored(nodes)


def _shards(nodes: DataFrame, link: float) -> DataFrame:
    """(shard, c, m, v, home): every node once as a resident and as a visitor wherever it may find links."""
    label = F.concat(F.col("label"), F.lit("/"), F.size("v").cast("string"))
    open_ = nodes.select(label.alias("shard"), "c", "m", "v", F.lit(True).alias("home"))
    ready: list[DataFrame] = []
    shape = "shard string, c long, m long, v array<double>, home boolean"
    for _ in range(8):
        sizes = stored(open_.where("home").groupBy("shard").agg(F.count(F.lit(1)).alias("rows")))
        large = sizes.where(F.col("rows") > MOST)
        if large.isEmpty():
            break
        ready.append(open_.join(sizes.where(F.col("rows") <= MOST).select("shard"), "shard", "left_semi"))
        split = open_.join(large, "shard")
        fan = F.least(F.lit(FAN), F.ceil(F.col("rows") / AIM)).cast("int").alias("fan")
        share = F.pmod(F.xxhash64("c", F.lit("fit")), F.col("rows")) < FIT
        sample = split.where(F.col("home") & share).select("shard", "c", "v", fan)
        centroids = stored(sample.groupBy("shard").applyInPandas(_centroids, "shard string, centroids array<array<double>>"))
        routed = split.join(centroids, "shard").select("shard", "c", "m", "v", "home", "centroids")
        open_ = stored(routed.mapInPandas(_routes(link), shape))
    # what no centroids could part is parted by hash; its visitors go to all parts
    sizes = open_.where("home").groupBy("shard").agg(F.count(F.lit(1)).alias("rows"))
    parted = open_.join(sizes, "shard").withColumn("parts", F.ceil(F.col("rows") / MOST).cast("int"))
    parted = parted.withColumn("own", F.pmod(F.xxhash64("c"), F.col("parts")))
    parted = parted.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    parted = parted.where(~F.col("home") | (F.col("own") == F.col("part")) | _goes(F.col("own"), F.col("part")))
    parted = parted.select(
        F.concat("shard", F.lit(":"), F.col("part").cast("string")).alias("shard"), "c", "m", "v", (F.col("home") & (F.col("own") == F.col("part"))).alias("home")
    )
    for more in ready:
        parted = parted.union(more)
    return stored(parted)


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", link: float = LINK) -> DataFrame:
    """One row per row of ``vectors``: id, n_links, component_id, kept.

    Two rows link when labels are equal and not null and their cosine, in doubles, is at least ``link``.
    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, nor do
    vectors of different lengths. ``n_links`` counts the other rows found, copies included; ``component_id``
    is the smallest id reachable by links, itself included. All links are found, ``audit`` checks a sample of
    them. Rows that repeat link with each other. An empty table gives no rows.
    """
    rows, nodes = _nodes(vectors, id_col, vector_col, label_col)
    shards = _shards(nodes, link)
    # a task: the residents of a shard and a bounded share of its visitors; residents ask in the first one only
    visits = shards.groupBy("shard").agg(F.ceil(F.sum(F.when(F.col("home"), 0).otherwise(1)) / VISITORS).cast("int").alias("tasks"))
    tasks = shards.join(visits, "shard").withColumn("tasks", F.greatest("tasks", F.lit(1)))
    own = F.pmod(F.xxhash64("c"), F.col("tasks")).cast("int")
    tasks = tasks.withColumn("task", F.explode(F.when(F.col("home"), F.sequence(F.lit(0), F.col("tasks") - 1)).otherwise(F.array(own))))
    tasks = stored(tasks.select("shard", "task", "c", "m", "v", "home", (~F.col("home") | (F.col("task") == 0)).alias("asks")))
    found = tasks.groupBy("shard", "task").applyInPandas(_found(link), "c long, links long, u long, v long")
    found = stored(found)
    links = found.where("c is not null").groupBy("c").agg(F.sum("links").alias("links"))
    roots = components(found.where("u is not null").select("u", "v"), "c")
    per_node = links.join(nodes.select("c", "m"), "c").join(roots, "c", "left")
    per_node = per_node.select("c", (F.col("links") + F.col("m") - 1).alias("n"), F.coalesce("root", "c").alias("root"))
    linked = rows.where("c is not null").join(per_node, "c")
    least = linked.groupBy("root").agg(F.min("id").alias("component_id"))
    linked = linked.join(least, "root").select("id", F.col("n").alias("n_links"), "component_id")
    alone = rows.where("c is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.union(alone)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def audit(result: DataFrame, vectors: DataFrame, every: int = 50, link: float = LINK, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> float:
    """Recall of ``n_links``: the rows whose id is divisible by ``every`` are compared with all rows, block by block."""
    rows, nodes = _nodes(vectors, id_col, vector_col, label_col)
    asked = rows.where(F.col("id") % every == 0).join(nodes, "c").select("id", "c", "v", "label")
    total, hit = 0, 0
    blocks = max(1, -(-asked.count() // 2000))
    for k in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == k).toPandas()
        if not len(block):
            continue
        groups = {key: (own["id"].to_numpy(), own["c"].to_numpy(), _unit(own["v"])) for key, own in block.assign(d=block["v"].map(len)).groupby(["label", "d"])}

        def count(frames: Iterator[pd.DataFrame], groups=groups) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for key, own in frame.assign(d=frame["v"].map(len)).groupby(["label", "d"]):
                    if key in groups:
                        ids, names, x = groups[key]
                        near = (x @ _unit(own["v"]).T >= link) * own["m"].to_numpy()
                        same = names[:, None] == own["c"].to_numpy()
                        n = np.where(same, own["m"].to_numpy() - 1, near).sum(axis=1)
                        yield pd.DataFrame({"id": ids, "n": n})

        truth = nodes.mapInPandas(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
        both = truth.join(result.select(F.col(id_col).alias("id"), "n_links"), "id")
        got = both.agg(F.sum("n"), F.sum(F.least("n", "n_links"))).first()
        total, hit = total + (got[0] or 0), hit + (got[1] or 0)
    return hit / total if total else 1.0
