"""Batches of rows with their ledger: broken, repeated and superseded ones."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.sinks import ledger

ROWS = "path string, member string, corrupt_record string, value int, batch string, _batch2 int"
MEMBERS = "path string, member string, expected_rows bigint, note string"


def rows(spark, *counts):
    made = [(p, m, "bad" if i == 0 and bad else None, i, "own", i) for p, m, n, bad in counts for i in range(n)]
    return spark.createDataFrame(made, ROWS)


def state(spark, root):
    return {(r.path, r.member): (r.rows, r.corrupt_rows, r.batch) for r in ledger.latest(ledger.ledger(spark, root)).collect()}


def test_nothing_committed(spark, tmp_path):
    root = str(tmp_path / "none")
    members = spark.createDataFrame([("a", None, 3, "n")], MEMBERS)
    assert ledger.ledger(spark, root).count() == 0 and ledger.committed_rows(spark, root) is None
    assert [tuple(r) for r in ledger.pending_by_ledger(members, ledger.ledger(spark, root)).collect()] == [("a", None, 3, "n", None)]


def test_short_members_are_pending_until_they_are_whole(spark, tmp_path):
    root = str(tmp_path / "r")
    members = spark.createDataFrame([("z", "a", 3, "1"), ("z", "b", 2, "2"), ("f", None, 4, "3"), ("z", "c", 1, "4"), ("g", None, None, "5")], MEMBERS)
    assert ledger.commit(rows(spark, ("z", "a", 2, True), ("z", "b", 2, False), ("f", None, 4, False), ("g", None, 1, False)), root, 0)
    assert state(spark, root) == {("z", "a"): (2, 1, 0), ("z", "b"): (2, 0, 0), ("f", None): (4, 0, 0), ("g", None): (1, 0, 0)}
    pending = ledger.pending_by_ledger(members, ledger.ledger(spark, root))
    assert {(r.path, r.member, r.committed_rows) for r in pending.collect()} == {("z", "a", 2), ("z", "c", None)}
    assert ledger.commit(rows(spark, ("z", "a", 3, False), ("z", "c", 1, False)), root, 1)
    assert ledger.pending_by_ledger(members, ledger.ledger(spark, root)).count() == 0
    kept = ledger.committed_rows(spark, root)
    assert kept.columns == ["path", "member", "corrupt_record", "value", "batch", "_batch2"]
    counts = {(r.path, r.member): r["count"] for r in kept.groupBy("path", "member").count().collect()}
    assert counts == {("z", "a"): 3, ("z", "b"): 2, ("f", None): 4, ("z", "c"): 1, ("g", None): 1}


def test_a_committed_batch_is_not_written_again(spark, tmp_path):
    root = str(tmp_path / "r")
    assert ledger.commit(rows(spark, ("z", "a", 2, False)), root, 7)
    assert not ledger.commit(rows(spark, ("z", "a", 9, False)), root, 7)
    assert state(spark, root) == {("z", "a"): (2, 0, 7)}


def test_a_batch_that_broke_off_never_happened(spark, tmp_path):
    root = str(tmp_path / "r")
    ledger.commit(rows(spark, ("z", "a", 2, False)), root, 0)
    broken = rows(spark, ("z", "a", 5, False), ("z", "b", 5, False)).withColumn("value", F.when(F.col("member") == "b", F.raise_error(F.lit("lost")).cast("int")).otherwise(1))
    with pytest.raises(Exception, match="lost"):
        ledger.commit(broken, root, 1)
    rows(spark, ("z", "q", 3, False)).withColumn("_ledger_batch", F.lit(2).cast("bigint")).write.parquet(f"{root}/rows/{2:012d}")
    assert state(spark, root) == {("z", "a"): (2, 0, 0)} and ledger.committed_rows(spark, root).count() == 2
    assert ledger.commit(rows(spark, ("z", "b", 5, False)), root, 1)
    assert ledger.committed_rows(spark, root).count() == 7
