"""How the domain tables are stored for the queries that share them."""

from tallybook.lineage import compute_once
from testbed import tables


def test_stored_rows_keep_the_order_they_are_made_in(spark, tmp_path):
    made = [("withdrawal", 3), ("deposit", 1), ("withdrawal", 2), (None, 4), ("deposit", 1)]
    frame = spark.createDataFrame(made, "p_type string, t_changed_at bigint").coalesce(1)
    stored = tables._store(spark, str(tmp_path), "accounting", frame)
    assert [tuple(row) for row in stored.collect()] == made


def test_stored_copies_are_written_small(spark, tmp_path):
    frame = spark.range(100).selectExpr("cast(id as string) AS p_type", "id AS t_changed_at")
    for stored in (tables._store(spark, str(tmp_path), "accounting", frame), compute_once(frame)):
        assert stored.count() == 100
        assert all(name.endswith(".zstd.parquet") for name in stored.inputFiles())
