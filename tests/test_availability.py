from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from anemos.operators import availability, conditions, curves, energy, peers
from anemos.plans import jobs
from anemos.sources import standard_curves

T0 = dt.datetime(2024, 5, 1)
SAMPLE = "time timestamp_ntz, turbine string, MC531 int, MC004 double, MC209 double, MC132 int"
INFO = "turbine string, turbine_type string, cut_in double, cut_out double"


def samples(spark, rows):
    """Rows of (second, turbine, label, wind, power, brake)."""
    return spark.createDataFrame([(T0 + dt.timedelta(seconds=s), *rest) for s, *rest in rows], SAMPLE)


def test_mode_takes_the_largest_on_ties(spark):
    df = samples(spark, [
        (0, "A", 40, 1.0, 1.0, 1), (1, "A", 120, 1.0, 1.0, 1), (2, "A", 0, 1.0, 1.0, 1), (3, "A", 0, 1.0, 1.0, 1),
        (300, "A", 40, 1.0, 1.0, 1), (301, "A", 40, 1.0, 1.0, 1), (302, "A", 120, 1.0, 1.0, 1),
        (600, "A", None, 1.0, 1.0, 1), (601, "A", 50, 1.0, 1.0, 1), (602, "A", None, 1.0, 1.0, 1),
    ])
    sums = conditions.valid(conditions.condition_sums(df))
    assert [r.label for r in conditions.label_mode(sums).orderBy("w").collect()] == [120, 40, 50]
    assert [r.label for r in energy.five_minute_rows(conditions.condition_sums(df)).orderBy("w").collect()] == [120, 40, 50]


def minutes_of(df, every="5 MINUTE"):
    rows = availability.daily_minutes(conditions.condition_sums(df, every)).collect()
    return {(r.turbine, r.record_date.day, r.label): r.duration for r in rows}


@pytest.mark.parametrize("every", ["5 MINUTE", "1 DAY"])
def test_minutes(spark, every):
    df = samples(spark, [(s, "A", 120 if s < 90 else 40, 1.0, 1.0, 1) for s in range(120)]
                 + [(86400, "A", 0, 1.0, 1.0, 1), (86401, "B", None, 1.0, 1.0, 1)])
    assert minutes_of(df, every) == {
        ("A", 1, 120): 1.5, ("A", 1, 40): 0.5, ("A", 1, 1000): 1438.0,
        ("A", 2, 1000): 1440.0, ("B", 2, 1000): 1440.0,
    }


def test_a_day_has_1440_minutes(telemetry):
    minutes = availability.daily_minutes(conditions.condition_sums(telemetry))
    days = minutes.groupBy("turbine", "record_date").agg(F.sum("duration").alias("d"))
    assert days.where(F.abs(F.col("d") - 1440) > 1e-6).count() == 0 < days.count()


def test_calendar(spark):
    df = samples(spark, [(86400, "A", 120, 1.0, 1.0, 1), (0, "B", 0, 1.0, 1.0, 1), (86400 * 3, "B", 50, 1.0, 1.0, 1)])
    made = jobs.tba(df, dt.date(2024, 4, 29), dt.date(2024, 5, 5), "north").collect()
    got = {(r.turbine, r.record_date.isoformat(), r.label): (round(r.duration, 6), r.record_month) for r in made}
    month, second = "2024-05", round(1 / 60, 6)
    # 1 May has only an invalid sample: the first measured day is the 2nd
    assert got["A", "2024-05-02", 120] == (second, month)
    assert got["A", "2024-05-02", 1000] == (round(1440 - 1 / 60, 6), month)
    assert got["A", "2024-05-03", 1000] == (1440.0, None)
    assert got["B", "2024-05-02", 1000] == (1440.0, None)
    assert got["B", "2024-05-04", 50] == (second, month)
    assert min(key[1] for key in got) == "2024-05-02" and max(key[1] for key in got) == "2024-05-05"
    assert {r.farm for r in made} == {"north"}


def test_window_rows(spark):
    df = samples(spark, [
        (0, "A", 120, 6.0, 100.0, 1), (1, "A", 120, 8.0, 200.0, None), (2, "A", 0, 99.0, 999.0, 1),
        (301, "A", 50, None, 10.0, 1), (400, "A", 120, 4.0, 300.0, 1),
    ])
    sums = conditions.condition_sums(df)
    five = energy.five_minute_rows(sums).orderBy("w").collect()
    assert [(r.label, r.wind_speed, r.power, r.seconds) for r in five] == [(120, 7.0, 150.0, 1), (120, 4.0, 155.0, 2)]
    assert five[0].actual == pytest.approx(150 / 3600)
    # a label without any wind is left out of the ten-minute rows
    ten = energy.ten_minute_rows(sums).collect()
    assert [(r.label, r.wind_speed, r.power, r.seconds) for r in ten] == [(120, 6.0, 200.0, 2)]


def test_curve(spark):
    points = spark.createDataFrame([("t", 3.0, 100.0), ("t", 3.5, 200.0), ("t", 5.0, 500.0)], curves.CURVE_SCHEMA)
    winds = [(-1.0,), (2.4,), (2.5,), (3.0,), (3.25,), (4.25,), (5.0,), (9.0,), (24.9,), (25.0,), (None,)]
    rows = spark.createDataFrame(winds, "wind double").select(
        "*", F.lit("t").alias("turbine_type"), F.lit(3.0).alias("cut_in"), F.lit(25.0).alias("cut_out")
    )
    made = {r.wind: r.power for r in curves.expected_power(rows, points, "wind", "power").collect()}
    assert made == {-1.0: 0.0, 2.4: 0.0, 2.5: 100.0, 3.0: 100.0, 3.25: 150.0, 4.25: 350.0, 5.0: 500.0, 9.0: 500.0,
                    24.9: 500.0, 25.0: 0.0, None: None}
    other = rows.withColumn("turbine_type", F.lit("unknown"))
    assert curves.expected_power(other, points, "wind", "power").where("power is not null").count() == 0


def test_bootstrap_draws():
    """The first draws for seed 45, from the generator's definition."""
    import numpy as np

    drawn = curves.bootstrap_samples(45, 50, 45)
    seeds = np.random.RandomState(45).randint(np.iinfo(np.int32).max, size=50)
    for tree in (0, 1, 49):
        assert set(np.flatnonzero(drawn[tree])) == set(np.random.RandomState(seeds[tree]).randint(0, 45, 45, dtype=np.int32))
    assert drawn.shape == (50, 45) and 0.58 < drawn.mean() < 0.69


def grown_tree(points, wind):
    """A regression tree grown to the end, split by split, for one wind speed."""
    powers = {power for _, power in points}
    if len(powers) == 1:
        return powers.pop()
    best = None
    for (a, _), (b, _) in zip(points, points[1:]):
        cut = (a + b) / 2
        sides = [p for x, p in points if x <= cut], [p for x, p in points if x > cut]
        error = sum(sum((p - sum(side) / len(side)) ** 2 for p in side) for side in sides)
        if best is None or error < best[0]:
            best = (error, cut)
    cut = best[1]
    return grown_tree([q for q in points if (q[0] <= cut) == (wind <= cut)], wind)


def test_forest_against_grown_trees(spark):
    points = [(r.wind, r.power) for r in standard_curves(spark).where("turbine_type = '10MW'").collect()]
    drawn = curves.bootstrap_samples(45, 7, 3)
    pick = random.Random(0)
    winds = sorted({round(pick.uniform(0, 26), 3) for _ in range(60)} | {3.0, 3.25, 7.0, 7.25, 7.5, 24.75, 25.0})
    want = {w: sum(grown_tree([q for q, d in zip(points, row) if d], w) for row in drawn) / 7 for w in winds}
    made = curves.forest_pieces(standard_curves(spark), 7, 3).where("turbine_type = '10MW'").collect()
    for wind in winds:
        inside = min(max(wind, 3.0), 25.0)
        (piece,) = [p for p in made if p.x0 < inside <= p.x1]
        assert piece.y0 == piece.y1 == pytest.approx(want[wind]), wind


def test_forest_fit_of_rows(spark):
    rows = spark.createDataFrame([(2.0,), (2.5,), (7.1,), (7.2,), (24.9,), (25.0,)], "wind double").select(
        "*", F.lit("8MW").alias("turbine_type"), F.lit(3.0).alias("cut_in"), F.lit(25.0).alias("cut_out"))
    made = {r.wind: r.p for r in curves.expected_power(rows, standard_curves(spark), "wind", "p", "forest").collect()}
    assert made[2.0] == made[25.0] == 0.0 and made[24.9] == 8000.0
    assert made[7.1] == made[7.2] == pytest.approx(2339.4, rel=0.15)
    assert 105.0 < made[2.5] < 200.0
    with pytest.raises(ValueError):
        curves.expected_power(rows, standard_curves(spark), "wind", "p", "spline")


def brute_force_peers(winds):
    result = {}
    for kind, name, wind in winds:
        others = sorted((abs(w - wind), n) for k, n, w in winds if k == kind and n != name)
        names = [n for _, n in others] if len(others) > 1 else []
        result[name] = tuple((names + [None, None])[:2])
    return result


@pytest.mark.parametrize("seed", range(6))
def test_nearest_peers_against_brute_force(spark, seed):
    """Few distinct winds, so that ties are the rule."""
    pick = random.Random(seed)
    winds = [(pick.choice("xyz"), f"T{n:02d}", float(pick.randint(0, 2 + 3 * seed))) for n in range(25)]
    winds += [("lone", "L1", 1.0), ("two", "P1", 1.0), ("two", "P2", 2.0)]
    df = spark.createDataFrame(winds, "turbine_type string, turbine string, wind double").withColumn("method", F.lit("m"))
    got = {r.turbine: (r.nearest, r.second) for r in peers.nearest_peers(df).collect()}
    assert got == brute_force_peers(winds)


def window(n):
    return T0 + dt.timedelta(minutes=5 * n)


ROW = ("method string, turbine string, turbine_type string, w timestamp_ntz, label int, wind_speed double, "
       "seconds bigint, actual double, expected double, intl_expected double")


def potentials(spark, rows):
    made = energy.with_potential(spark.createDataFrame(rows, ROW)).collect()
    return {(r.turbine, r.w, r.label): (r.potential, r.intl_potential) for r in made}


def five(turbine, n, label, wind, seconds, actual):
    return ("five_minute", turbine, "t", window(n), label, wind, seconds, actual, 50.0, 5.0)


def test_potential_fallbacks(spark):
    """A's nearest is B, then C; D is farther off."""
    rows = [five("A", n, 40, 10.0, 100, 1.0) for n in range(6)]
    rows += [five("B", 0, 120, 10.1, 200, 8.0), five("C", 0, 120, 10.3, 100, 99.0)]
    rows += [five("B", 1, 40, 10.1, 200, 8.0), five("C", 1, 120, 10.3, 50, 3.0)]
    rows += [five("D", 2, 120, 14.0, 300, 30.0)]
    rows += [five("B", 4, 120, 10.1, 0, 7.0), five("C", 4, 120, 10.3, 0, 7.0), five("D", 4, 120, 14.0, 50, 3.0)]
    rows += [five("B", 5, 120, 10.1, 0, 7.0)]
    got = potentials(spark, rows)
    assert got["A", window(0), 40] == (4.0, 4.0)      # nearest, scaled to 100 of 200 seconds
    assert got["A", window(1), 40] == (6.0, 6.0)      # nearest not normal: second
    assert got["A", window(2), 40] == (10.0, 10.0)    # mean of the type
    assert got["A", window(3), 40] == (50.0, 5.0)     # nobody: expected
    assert got["A", window(4), 40] == pytest.approx(((7 + 7 + 3) / 3 * 100 / (50 / 3),) * 2)  # peers without seconds
    assert got["A", window(5), 40] == (50.0, 5.0)     # nothing to scale by
    assert got["B", window(0), 120] == (50.0, 5.0)    # normal rows: expected


def test_potential_with_one_peer_uses_the_type_mean(spark):
    rows = [five("A", 0, 40, 10.0, 100, 1.0), five("B", 0, 120, 10.1, 200, 8.0)]
    assert potentials(spark, rows)["A", window(0), 40] == (4.0, 4.0)


def test_ten_minute_rows_leave_out_their_own_normal_row(spark):
    def ten(turbine, label, seconds, actual):
        return ("ten_minute", turbine, "t", window(0), label, 10.0, seconds, actual, 50.0, 5.0)

    rows = [ten("A", 40, 100, 1.0), ten("A", 120, 100, 70.0), ten("B", 120, 200, 8.0), ten("C", 120, 100, 4.0),
            ten("C", 50, 300, 2.0)]
    got = potentials(spark, rows)
    assert got["A", window(0), 40][0] == pytest.approx((8 + 4) / 2 * 100 / 150)
    assert got["C", window(0), 50][0] == pytest.approx((70 + 8) / 2 * 300 / 150)


def test_daily_energy(spark):
    rows = energy.with_potential(spark.createDataFrame(
        [five("A", 0, 40, 10.0, 100, 80.0), five("A", 1, 40, 12.0, 100, 20.0), five("A", 2, 40, 14.0, 100, None)], ROW))
    row = energy.daily_energy(rows, "north").first()
    assert (row.record_month, row.record_date, row.record_type, row.standard_abbr) == (
        "2024-05", dt.date(2024, 5, 1), "PBA", "five_minute")
    assert (row.wind_speed, row.seconds, row.actual_generation, row.loss_amount, row.farm) == (
        12.0, 300, 100.0, 30.0, "north")


def test_both_tables_in_one_job(spark, telemetry):
    from anemos.catalog import fixtures

    first, last = dt.date(2024, 1, 1), dt.date(2024, 1, 30)
    tba, pba = jobs.tba_and_pba(telemetry, fixtures.turbine_info(spark), standard_curves(spark), first, last)
    assert tba.exceptAll(jobs.tba(telemetry, first, last)).count() == 0
    assert pba.where("loss_amount < 0 or intl_loss_amount < 0").count() == 0
    assert {r.standard_abbr for r in pba.select("standard_abbr").distinct().collect()} == {"five_minute", "ten_minute"}


def test_two_farms_are_two_runs(spark, telemetry):
    """Turbines of one type and of the same names in two farms share nothing."""
    from anemos.catalog import fixtures

    first, last = dt.date(2024, 1, 9), dt.date(2024, 1, 11)
    info, curve_points = fixtures.turbine_info(spark), standard_curves(spark)
    other = telemetry.withColumns({"MC004": F.col("MC004") * 0.8 + 1, "time": F.expr("time + INTERVAL '3' HOUR")}).where("turbine <> 'WF01_001'")
    both = telemetry.withColumn("farm", F.lit("north")).unionByName(other.withColumn("farm", F.lit("south")))
    together = jobs.tba_and_pba(both, info, curve_points, first, last)
    parts = [jobs.tba_and_pba(df, info, curve_points, first, last, name) for df, name in ((telemetry, "north"), (other, "south"))]

    def rows(df):
        names = sorted(df.columns)
        return sorted(tuple(f"{v:.9g}" if isinstance(v, float) else str(v) for v in row) for row in df.select(names).collect())

    for place, joint in enumerate(together):
        apart = [part[place] for part in parts]
        assert sorted(joint.columns) == sorted(apart[0].columns)
        assert rows(joint) == sorted(rows(apart[0]) + rows(apart[1])) != []


def test_a_request_reads_and_returns_its_days(spark, stored_telemetry):
    from anemos.catalog import fixtures

    stored = spark.read.parquet(stored_telemetry)
    day = stored.select(F.min("dt")).first()[0] + dt.timedelta(days=2)
    _, energies = jobs.tba_and_pba(stored, fixtures.turbine_info(spark), standard_curves(spark), day, day)
    assert {r.record_date for r in energies.select("record_date").distinct().collect()} == {day}
    filters = jobs._of_days(stored, day, day)._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]
    assert "dt" in filters.split("PushedFilters")[0] and str(day) in filters.split("PushedFilters")[0]
