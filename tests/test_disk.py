"""What computations leave on disk."""

import os
import time
import uuid
from datetime import datetime

from conftest import table
from pyspark.sql import functions as F

from tallybook import lineage
from tallybook.functions.periods import ReportWindow
from tallybook.lineage import CLEANUP, compute_once, drop
from tallybook.llm import graph, lines, scratch
from tallybook.plans import finance
from tallybook.sources.catalog import Catalog
from tallybook.sources.schemas import SCHEMAS


def _shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for k in range(files.size()) if (name := files.apply(k).getName()).startswith("shuffle_")}


def _left_by(spark, work) -> set[str]:
    """Shuffle files that ``work`` made and that are still there after a while; Spark deletes them in the background."""
    before = _shuffle_files(spark)
    kept = work()
    for _ in range(50):
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert kept is not None
    return left


def _dealt(spark):
    return spark.range(1000, numPartitions=3).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("s"))


def test_a_stored_copy_leaves_no_shuffle_files(spark):
    before = spark.conf.get(CLEANUP, None)
    for store in (compute_once, scratch.stored):
        frames = [_dealt(spark)]
        assert _left_by(spark, lambda: frames.append(store(frames[0])) or frames) == set()
        assert sorted(map(tuple, frames[1].collect())) == sorted(map(tuple, frames[0].collect()))
        assert spark.conf.get(CLEANUP, None) == before


def test_tables_of_steps_that_are_done_are_deleted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "folder", lambda spark: f"{tmp_path}/scratch-{uuid.uuid4().hex}")
    base = "the quick brown fox jumps over the lazy dog and runs far away from here"
    docs = [(1, base + "\nanother line of some length\nx"), (2, base + " now\nx"), (3, None), (4, "a line that stands alone\nx")]
    out = lines.dedup(spark.createDataFrame(docs, "doc_id long, text string"), least=1)
    assert len(os.listdir(tmp_path)) == 1
    got = {r.doc_id: (r.n_lines, r.n_removed, r.kept_text) for r in out.collect()}
    assert got == {1: (3, 0, docs[0][1]), 2: (2, 2, ""), 3: (0, 0, None), 4: (2, 1, "a line that stands alone")}


def test_the_tables_of_the_rounds_of_components_are_deleted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "folder", lambda spark: f"{tmp_path}/scratch-{uuid.uuid4().hex}")
    # a path takes several rounds
    edges = spark.createDataFrame([(k, k + 1) for k in range(1, 40)] + [(99, 98)], "u long, v long")
    roots = graph.components(edges, "c")
    assert len(os.listdir(tmp_path)) == 1
    found = dict(map(tuple, roots.select("c", "root").collect()))
    assert len({found[k] for k in range(1, 41)}) == 1 and found[98] == found[99] != found[1]
    drop(roots)
    assert os.listdir(tmp_path) == []


def test_reports_delete_their_copy_of_the_window(spark, tmp_path, monkeypatch):
    ledger = table(spark, "accounting", [{"t_changed_at": datetime(1997, 3, k), "p_bet_id": str(k), "debit_cents": k} for k in range(2, 9)])
    monkeypatch.setattr(lineage, "shared_folder", lambda spark: str(tmp_path))
    names = {"bets", "bet_states", "legs", "users", "casino_payouts", "casino_wagers", "casino_wager_rollbacks", "patron_transactions", "wager_and_game_info"}
    t = Catalog.of(accounting=ledger, **{n: spark.createDataFrame([], SCHEMAS[n]) for n in names})
    finance.results_detail_without_jackpots(t, ReportWindow.month(1997, 3))
    left = [set(spark.read.parquet(f"{tmp_path}/{name}").columns) for name in os.listdir(tmp_path)]
    assert left and not any("debit_cents" in columns for columns in left)
