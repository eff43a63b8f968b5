from __future__ import annotations

from types import SimpleNamespace

import pytest

from anemos import session


def cluster(folder=None, set_in_code=None, master="yarn"):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default: folder if name == "spark.checkpoint.dir" else default),
        sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: set_in_code),
    )


def test_the_named_folder_is_used():
    assert session.shared_folder(cluster("hdfs://shared/work/")) == "hdfs://shared/work"
    assert session.shared_folder(cluster(set_in_code="hdfs://other")) == "hdfs://other"
    first, second = (session.scratch_path(cluster("hdfs://shared"), "rows") for _ in range(2))
    assert first.startswith("hdfs://shared/rows-") and first != second


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(cluster())


def test_written_once_and_read_back(spark):
    calls = spark.sparkContext.accumulator(0)

    def count(batches):
        calls.add(1)
        yield from batches

    df = spark.range(10).coalesce(1).mapInArrow(count, "id long")
    table = session.materialize(df, "test")
    assert table.count() == 10 and table.where("id > 4").count() == 5
    assert calls.value == 1 and table.schema == df.schema


def test_small_tables_have_a_known_size(spark):
    table = session.small_table(spark, [("a", 1), (None, 2)], "name string, n int")
    assert table.collect() == [("a", 1), (None, 2)]
    assert "LocalTableScan" in table._jdf.queryExecution().executedPlan().toString()
    assert session.small_table(spark, [], "name string").count() == 0
