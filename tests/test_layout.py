"""Tables laid out by turbine and time."""

from __future__ import annotations

import datetime as dt

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from anemos import sinks
from anemos.sinks import layout, snapshots
from anemos.sources import scan_telemetry

START = dt.datetime(2024, 5, 1)
SMALL_GROUPS = {"parquet.block.size": str(1 << 15), "parquet.page.size": str(1 << 12)}


@pytest.mark.parametrize("bits, second_bits", [(4, 4), (5, 2), (3, 0), (1, 3)])
def test_curve_key(spark, bits, second_bits):
    df = spark.range(1 << (bits + second_bits)).select(
        (F.col("id") % (1 << bits)).alias("a"), F.expr(f"id div {1 << bits}").alias("b"))
    found = df.select("a", "b", layout.curve_key(F.col("a"), F.col("b"), bits, second_bits).alias("k")).collect()

    def plain(a, b):
        out = ""
        one, two = (format(n, f"0{length}b") if length else "" for n, length in ((a, bits), (b, second_bits)))
        for at in range(max(bits, second_bits)):
            out += one[at:at + 1] + two[at:at + 1]
        return int(out, 2)

    assert all(row["k"] == plain(row["a"], row["b"]) for row in found)
    assert len({row["k"] for row in found}) == len(found)


@pytest.fixture(scope="module")
def fleet(spark):
    """40 turbines, a sample each half minute over three days."""
    return spark.range(40 * 3 * 2880).select(
        F.expr("timestampadd(SECOND, CAST(id div 40 AS INT) * 30, timestamp_ntz'2024-05-01')").alias("time"),
        F.format_string("T%03d", F.col("id") % 40).alias("turbine"), F.rand(1).alias("value"))


def groups_that_may_hold(spark, path, turbine, low, high):
    """Row groups whose footers do not rule a turbine and a time range out, and all of them."""
    state, held, every = snapshots.snapshot(spark, path), 0, 0
    for file in [file for files in state.files.values() for file in files]:
        meta = pq.ParquetFile(f"{path}/_data/{file.path}").metadata
        names = meta.schema.to_arrow_schema().names
        for at in range(meta.num_row_groups):
            every += 1
            names_in, times_in = (meta.row_group(at).column(names.index(name)).statistics for name in ("turbine", "time"))
            held += names_in.min <= turbine <= names_in.max and times_in.min <= high and low <= times_in.max
    return held, every


def test_one_turbine_opens_few_row_groups(spark, fleet, tmp_path):
    plain, laid = str(tmp_path / "plain"), str(tmp_path / "laid")
    snapshots.commit(fleet.withColumn("dt", F.to_date("time")).repartition(3, "dt").sortWithinPartitions("time"), plain, "time", ["dt"],
                     options=SMALL_GROUPS)
    layout.commit_clustered(fleet, laid, files=3, options=SMALL_GROUPS)
    whole = (START, START + dt.timedelta(days=3))
    by_time, all_by_time = groups_that_may_hold(spark, plain, "T017", *whole)
    by_curve, all_by_curve = groups_that_may_hold(spark, laid, "T017", *whole)
    assert all_by_curve > 60
    # Rows in order of time say nothing about the turbine; on the curve a turbine's month is an eighth of the groups at most.
    assert by_time >= 0.9 * all_by_time and by_curve <= all_by_curve / 8
    # An hour of all turbines is not much dearer than the part of the day that holds it.
    hour = (START + dt.timedelta(hours=30), START + dt.timedelta(hours=31))
    assert sum(groups_that_may_hold(spark, laid, f"T{n:03d}", *hour)[0] > 0 for n in range(40)) == 40
    assert groups_that_may_hold(spark, laid, "T017", *hour)[0] <= max(1, by_curve / 3)
    assert sinks.read_table(spark, laid).drop("dt").exceptAll(fleet).count() == 0


def test_the_filters_reach_the_scan(spark, fleet, tmp_path):
    path = str(tmp_path / "t")
    layout.commit_clustered(fleet, path, files=3)
    found = scan_telemetry(spark, path, start=START, end=START + dt.timedelta(days=1, hours=2), devices=["T003"])
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "= T003" in text and "PushedFilters: [IsNotNull(time), IsNotNull(turbine)" in text and "PartitionFilters: [isnotnull(dt" in text
    assert {path.rsplit("/", 2)[1] for path in found.inputFiles()} == {"dt=2024-05-01", "dt=2024-05-02"}


def test_recluster_puts_small_commits_together(spark, fleet, tmp_path):
    path = str(tmp_path / "t")
    for n in range(4):
        snapshots.commit(fleet.where(F.col("turbine").endswith(str(n))).withColumn("dt", F.to_date("time")), path, "time", ["dt"], "nothing")
    before = snapshots.snapshot(spark, path)
    state = layout.recluster(spark, path, dt.date(2024, 5, 2), dt.date(2024, 5, 3), files=2)
    assert state.files["dt=2024-05-01"] == before.files["dt=2024-05-01"]
    assert len(state.files["dt=2024-05-02"]) <= 2 < len(before.files["dt=2024-05-02"])
    assert sinks.read_table(spark, path).drop("dt").exceptAll(fleet.where("substr(turbine, 4) < '4'")).count() == 0
    assert sinks.read_table(spark, path).count() == 4 * 4 * 3 * 2880
    assert layout.recluster(spark, path, dt.date(2020, 1, 1), dt.date(2020, 1, 2)).version == state.version


def test_null_turbines_and_empty_tables(spark, tmp_path):
    rows = spark.createDataFrame([(START, None, 1), (START, "A", 2), (None, "B", 3)], "time timestamp_ntz, turbine string, value int")
    layout.commit_clustered(rows, str(tmp_path / "t"))
    assert sorted(r["value"] for r in sinks.read_table(spark, str(tmp_path / "t")).collect()) == [1, 2, 3]
    layout.commit_clustered(rows.limit(0), str(tmp_path / "e"))
    assert sinks.read_table(spark, str(tmp_path / "e")).count() == 0
    assert layout.recluster(spark, str(tmp_path / "none"), START.date(), START.date()) is None
