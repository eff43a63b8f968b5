"""For each query the same result in DuckDB SQL, written without the library's shortcuts."""

from __future__ import annotations

from ..operators import metrics
from ..operators.curves import SEED, TREES, bootstrap_samples
from ..sources.lookups import CURVE_10MW, CURVE_8MW, CURVE_FIRST_WIND, CURVE_STEP
from . import fixtures as fx
from .queries import (
    BLOCK_RANGE, BUCKETS, FIRST_DAY, FROM, LAST_DAY, NOISE, REQUEST_DAYS, ROLLUP_COLUMNS, STORED_COLUMNS, STREAM_CUT, UNTIL,
)

# Fixed values, stated here once more so that an error in the library shows.
MEASURED = {
    "Met1sWSpd": "MC004", "Met30sWSpd": "MC082", "Met600sWSpd": "MC083", "GriActivePowerTotal": "MC061",
    "GriReactivePowerTotal": "MD002", "CnvGenPower30s": "MC085", "CnvGenPower600s": "MC086",
    "MetTmp": "MC015", "NacTmp": "MC014", "TowCbtTmp": "MC091",
}
STATES = {
    "FaultShutdown": 40, "Overhaul": 50, "Maintenance": 60, "GridShutdown": 70, "LocalShutdown": 81, "RemoteShutdown": 80,
    "WeatherShutdown": 90, "LimitPower": 110, "LimitShutdown": 111, "Standby": 100, "NormalGeneration": 120,
}
COUNTERS = (
    "FaultShutdownTimes", "OverhaulTimes", "MaintenanceTimes", "GridShutdownTimes", "LocalShutdownTimes",
    "RemoteShutdownTimes", "WeatherShutdownTimes", "LimitPowerTimes", "LimitShutdownTimes", "StandbyTimes",
    "NormalGenerationTimes", "InterruptionTimes",
)
LOSSES = (
    "FaultLossGeneration", "OverhaulLossGeneration", "MaintainLossGeneration", "GridLossGeneration",
    "LocalLossGeneration", "RemoteLossGeneration", "WeatherLossGeneration", "LimitLossGeneration",
)
LEVEL_TEXT = {1: "提示", 2: "告警", 3: "预警", 4: "故障"}
FIRST_TEXT = {True: "是", False: "否"}
CONFIRMED_TEXT = {True: "已确认", False: "未确认"}
SUMMED = (
    "YawCwTimesSum", "GenReactQLimitStateTimesSum", "GriActiveEnergyDelTotal", "YawHoursTotal",
    "PreTotalGenerationFirst", "PreTotalEleConsumptionFirst",
)

TELEMETRY = fx.TELEMETRY_SQL.format(events="events")
MESSAGES = fx.MESSAGES_SQL.format(events="events", millis=fx.DUCKDB_MILLIS)


def _names(devices):
    return ", ".join(f"'{name}'" for name in devices)


def _r(expression, alias):
    value = f"CAST({expression} AS DOUBLE)"
    return f"CASE WHEN abs({value}) < {NOISE} THEN 0e0 ELSE CAST(CAST({value} AS FLOAT) AS DOUBLE) END AS {alias}"


def _with(*ctes, select):
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in ctes) + "\n" + select


T = ("telemetry", TELEMETRY)
TEN = "time_bucket(INTERVAL '10 minutes', time, TIMESTAMP '1970-01-01')"


# --- reports -------------------------------------------------------------


def _totals(bucket=TEN, where="TRUE"):
    parts = [
        "count(MC082) AS n_wind", "count(*) AS n", "count(MC006) AS n_meter", "avg(MC093) AS a_MC093",
        "min(RatedPower) AS rated", "min(MC006) AS lo_meter", "max(MC006) AS hi_meter",
        "min(MC062) AS lo_used", "max(MC062) AS hi_used",
        "count(*) FILTER (WHERE MD001 >= RatedPower) AS n_full",
        "count(*) FILTER (WHERE MA022 = 1) AS n_acw", "count(*) FILTER (WHERE MA021 = 1) AS n_cw",
        "count(*) FILTER (WHERE YawCcwTimes = 1) AS n_ccw_times", "count(*) FILTER (WHERE MA2353 = 1) AS n_limit",
        "arg_max_null(MC006, time) AS meter_last", "arg_min_null(preTotalGeneration, time) AS meter_before",
    ]
    parts += [f"sum({x}) AS s_{x}" for x in (
        "IsEffectWind", "Generation", "Consumption", "YawCwTimes", "GenReactQLimitStateTimes",
        "TheoreticalGeneration", *COUNTERS, *LOSSES)]
    for signal in MEASURED.values():
        parts += [f"{f}({signal}) AS {f}_{signal}" for f in ("avg", "max", "min")]
    parts += [f"count(*) FILTER (WHERE MC143 = {code}) AS n_{code}" for code in STATES.values()]
    return (
        "totals",
        f"SELECT {bucket} AS w, turbine AS d, {', '.join(parts)} FROM telemetry WHERE {where} GROUP BY 1, 2",
    )


def _formulas():
    loss = " + ".join(f"s_{x}" for x in LOSSES if x != "LimitLossGeneration")
    made = "(meter_last - meter_before)"
    up = " + ".join(f"n_{code}" for code in STATES.values() if code not in (40, 50))
    result = {
        "EffectWindHours": "s_IsEffectWind", "MetAirDensityAvg": "a_MC093", "RatedPowerData": "rated",
        "PreTotalGenerationFirst": "lo_meter", "GriActiveEnergyDelLast": "hi_meter",
        "GriActiveEnergyDelTotal": "hi_meter - lo_meter", "TheoreticalGeneration": "s_TheoreticalGeneration",
        "PreTotalEleConsumptionFirst": "lo_used", "GriActiveEnergyRcvLast": "hi_used",
        "GriActiveEnergyRcvSection": "hi_used - lo_used",
        "EquivalentHours": "(hi_meter - lo_meter) / nullif(rated, 0) * 3600",
        "FullLoadDurationDay": "n_full", "GriActiveEnergyDelUnit": "s_Generation / 1e4",
        "GriActiveEnergyRcvUnit": "s_Consumption / 1e4", "YawAcwHours": "n_acw", "YawAcwTimes": "n_ccw_times",
        "YawCwHours": "n_cw", "YawCwTimesSum": "s_YawCwTimes", "YawHours": "n_acw + n_cw",
        "GenReactQLimitStateDuration": "n_limit", "GenReactQLimitStateTimesSum": "s_GenReactQLimitStateTimes",
        "AvailableTime": up, "UnAvailableTime": "n_40 + n_50",
        "Availability": "1.0e0 - CAST(n_40 + n_50 AS DOUBLE) / nullif(n, 0)",
        "InterruptionDurationCalculated": "600 - n",
        "MTBFDuration": "CAST(n - n_40 AS DOUBLE) / nullif(s_FaultShutdownTimes, 0)",
        "MTTRDuration": "CAST(n_40 AS DOUBLE) / nullif(s_FaultShutdownTimes, 0)",
        "EnergyAvailability": f"{made} / nullif(s_TheoreticalGeneration, 0) * 3600e0 * 100e0",
        "Discrepancy": f"(1.0e0 - {made} / nullif({made} + ({loss}) / 3600e0, 0)) * 100e0",
    }
    for stem, signal in MEASURED.items():
        result |= {f"{stem}Avg": f"avg_{signal}", f"{stem}Max": f"max_{signal}", f"{stem}Min": f"min_{signal}"}
    for stem, code in STATES.items():
        result[f"{stem}Duration"] = f"n_{code}"
    result |= {x: f"s_{x}" for x in COUNTERS}
    result |= {x: f"s_{x} / 3600e0 / 10000e0" for x in LOSSES}
    return result


def _report(columns, count="n_wind", rounded=True, rename=None):
    formulas = _formulas()
    rename = rename or {}

    def column(name):
        if name == "Time":
            return "w AS Time"
        if name == "DeviceName":
            return "d AS DeviceName"
        if name == "Count":
            return f"{count} AS Count"
        value = f"CAST({formulas[name]} AS DOUBLE)"
        return _r(value, name) if rounded else f"{value} AS {rename.get(name, name)}"

    return f"SELECT {', '.join(column(name) for name in columns)} FROM totals"


def _groups():
    rows = [(i, name, device) for i, item in enumerate(fx.GROUPS) for name, devices in item.items()
            for device in dict.fromkeys(devices)]
    values = ", ".join(f"({i}, '{name}', '{device}')" for i, name, device in rows)
    return "groups", f"SELECT * FROM (VALUES {values}) AS g(group_ord, group_name, device)"


_GRID = {
    "10min": ("minute", "INTERVAL 10 MINUTE"), "hour": ("hour", "INTERVAL 1 HOUR"), "day": ("day", "INTERVAL 1 DAY"),
    "month": ("month", "INTERVAL 1 MONTH"), "year": ("month", "INTERVAL 1 YEAR"),
}


def _merged(name, of):
    """How a column merges: by the end of its name, or as a sum where it is listed, else as a mean."""
    for ending, function in (("Max", "max"), ("Min", "min"), ("Avg", "avg")):
        if name.endswith(ending):
            return f"{function}({of})"
    return f"sum({of})" if name in SUMMED else f"avg({of})"


def _grid(period):
    unit, step = _GRID[period]
    return "grid", f"""
        SELECT p AS ps, p + {step} AS pe
        FROM generate_series(date_trunc('{unit}', TIMESTAMP '{FROM}'), TIMESTAMP '{UNTIL}', {step}) AS s(p)
        WHERE p < TIMESTAMP '{UNTIL}'"""


def _rollup_cte(period):
    merged = ", ".join(f"{_merged(x, f'r.{x}')} AS {x}" for x in ROLLUP_COLUMNS)
    return [
        T, _totals(), ("r", _report(("Time", "DeviceName", *ROLLUP_COLUMNS), rounded=False)), _groups(), _grid(period),
        ("rolled", f"""
            SELECT g.group_ord, p.ps AS Time, g.group_name AS DeviceName, {merged}
            FROM (SELECT DISTINCT group_ord, group_name FROM groups) AS g CROSS JOIN grid AS p
            LEFT JOIN (SELECT group_ord AS o, r.* FROM r JOIN groups ON DeviceName = device) AS r
              ON r.o = g.group_ord AND r.Time >= p.ps AND r.Time < p.pe
            GROUP BY 1, 2, 3"""),
    ]


def _rollup(period):
    columns = ", ".join(_r(x, x) for x in ROLLUP_COLUMNS)
    return _with(*_rollup_cte(period), select=f"SELECT group_ord, Time, DeviceName, {columns} FROM rolled")


def _added():
    """Totals of ten minutes added up per group and day, and ratios of the sums."""
    up = " + ".join(f"n_{code}" for code in STATES.values() if code not in (40, 50))
    lost = " + ".join(f"s_{x}" for x in LOSSES if x != "LimitLossGeneration")
    known = "FILTER (WHERE s_TheoreticalGeneration <> 0 AND made IS NOT NULL)"
    columns = {
        "Count": "sum(n_wind)", "Met1sWSpdAvg": "sum(avg_MC004 * n_wind) / nullif(sum(n_wind) FILTER (WHERE avg_MC004 IS NOT NULL), 0)", "Met1sWSpdMax": "max(max_MC004)",
        "FaultShutdownDuration": "sum(n_40)", "FaultShutdownTimes": "sum(s_FaultShutdownTimes)",
        "AvailableTime": f"sum({up})", "YawHours": "sum(n_acw + n_cw)",
        "GriActiveEnergyDelTotal": "sum(hi_meter - lo_meter)", "GriActiveEnergyDelLast": "max(hi_meter)",
        "PreTotalGenerationFirst": "min(lo_meter)", "TheoreticalGeneration": "sum(s_TheoreticalGeneration)",
        "FaultLossGeneration": "sum(s_FaultLossGeneration) / 3600e0 / 10000e0",
        "EquivalentHours": "sum((hi_meter - lo_meter) / nullif(rated, 0) * 3600e0)",
        "Availability": "1e0 - CAST(sum(n_40 + n_50) AS DOUBLE) / nullif(sum(n), 0)",
        "MTBFDuration": "CAST(sum(n - n_40) AS DOUBLE) / nullif(sum(s_FaultShutdownTimes), 0)",
        "MTTRDuration": "CAST(sum(n_40) AS DOUBLE) / nullif(sum(s_FaultShutdownTimes), 0)",
        "EnergyAvailability": f"sum(made) {known} / nullif(sum(s_TheoreticalGeneration) {known}, 0) * 3600e0 * 100e0",
        "Discrepancy": f"(1e0 - sum(made) {known} / nullif(sum(made) {known} + sum({lost}) {known} / 3600e0, 0)) * 100e0",
    }
    values = ", ".join(_r(f"CAST({x} AS DOUBLE)", name) for name, x in columns.items())
    return _with(
        T, _totals(), _groups(), _grid("day"),
        select=f"""
        SELECT g.group_ord, p.ps AS Time, g.group_name AS DeviceName, {values}
        FROM (SELECT DISTINCT group_ord, group_name FROM groups) AS g CROSS JOIN grid AS p
        LEFT JOIN (SELECT group_ord AS o, meter_last - meter_before AS made, totals.* FROM totals JOIN groups ON d = device) AS r
          ON r.o = g.group_ord AND r.w >= p.ps AND r.w < p.pe
        GROUP BY 1, 2, 3""")


_LEVEL_STARTS = {level: f"CAST(date_trunc('{level}', time) AS TIMESTAMP)" for level in ("hour", "day", "month")}


def _of_levels(levels, columns):
    """Reports straight from the samples of each hour, day or month; what is missing counts for each ten minutes with samples."""
    parts = []
    for level in levels:
        name, totals = _totals(_LEVEL_STARTS[level])
        totals = totals.replace("turbine AS d, ", f"turbine AS d, count(DISTINCT {TEN}) AS n_ten, ", 1)
        report = _report(("Time", "DeviceName", *columns)).replace("600 - n AS", "600 * n_ten - n AS").replace("(600 - n ", "(600 * n_ten - n ")
        parts.append(f"SELECT '{level}' AS level, * FROM ({_with((name, totals), select=report)})")
    return _with(T, select="\nUNION ALL\n".join(parts))


def _exact_groups(bucket, where, grid):
    """Per turbine and period straight from the samples, then added up over the turbines of a group."""
    up = " + ".join(f"n_{code}" for code in STATES.values() if code not in (40, 50))
    lost = " + ".join(f"s_{x}" for x in LOSSES if x != "LimitLossGeneration")
    known = "FILTER (WHERE made IS NOT NULL)"
    columns = {
        "Count": "CAST(sum(n_wind) AS BIGINT)", "Met1sWSpdAvg": "sum(sum_MC004) / nullif(sum(n_MC004), 0)", "Met1sWSpdMax": "max(max_MC004)",
        "FaultShutdownDuration": "sum(n_40)", "FaultShutdownTimes": "sum(s_FaultShutdownTimes)",
        "AvailableTime": f"sum({up})", "YawHours": "sum(n_acw + n_cw)", "GriActiveEnergyDelTotal": "sum(hi_meter - lo_meter)",
        "GriActiveEnergyDelLast": "max(hi_meter)", "PreTotalGenerationFirst": "min(lo_meter)",
        "TheoreticalGeneration": "sum(s_TheoreticalGeneration)",
        "FaultLossGeneration": "sum(s_FaultLossGeneration) / 3600e0 / 10000e0",
        "EquivalentHours": "sum((hi_meter - lo_meter) / nullif(rated, 0) * 3600e0)",
        "Availability": "1e0 - CAST(sum(n_40 + n_50) AS DOUBLE) / nullif(sum(n), 0)",
        "MTBFDuration": "CAST(sum(n) - sum(n_40) AS DOUBLE) / nullif(sum(s_FaultShutdownTimes), 0)",
        "MTTRDuration": "CAST(sum(n_40) AS DOUBLE) / nullif(sum(s_FaultShutdownTimes), 0)",
        "EnergyAvailability": f"sum(made) / nullif(sum(s_TheoreticalGeneration) {known}, 0) * 3600e0 * 100e0",
        "Discrepancy": f"(1e0 - sum(made) / nullif(sum(made) + sum({lost}) {known} / 3600e0, 0)) * 100e0",
    }
    values = ", ".join(f"{x} AS Count" if name == "Count" else _r(f"CAST({x} AS DOUBLE)", name) for name, x in columns.items())
    name, totals = _totals(bucket, where)
    totals = totals.replace("turbine AS d, ", "turbine AS d, sum(MC004) AS sum_MC004, count(MC004) AS n_MC004, ", 1)
    return _with(
        T, (name, totals), _groups(), grid,
        select=f"""
        SELECT g.group_ord, p.ps AS Time, g.group_name AS DeviceName, {values}
        FROM (SELECT DISTINCT group_ord, group_name FROM groups) AS g CROSS JOIN grid AS p
        LEFT JOIN (SELECT group_ord AS o, meter_last - meter_before AS made, totals.* FROM totals JOIN groups ON d = device) AS r
          ON r.o = g.group_ord AND r.w >= p.ps AND r.w < p.pe
        GROUP BY 1, 2, 3""")


def _ad_hoc(kind, count):
    rename = {"YawHours": "YawHoursTotal"}
    columns = metrics.REPORT_COLUMNS[kind]
    values = [rename.get(x, x) for x in columns[2:]]
    merged = ", ".join(_r(_merged(x, f"CAST(r.{x} AS DOUBLE)"), x) for x in values)
    where = f"time >= TIMESTAMP '{FROM}' AND time < TIMESTAMP '{UNTIL}'"
    return _with(
        T, _totals("date_trunc('day', time)", where), ("r", _report(columns, count, False, rename)), _groups(),
        select=f"""
        SELECT g.group_ord, TIMESTAMP '{FROM}' AS Time, g.group_name AS DeviceName, {merged}
        FROM groups AS g LEFT JOIN r ON r.DeviceName = g.device GROUP BY 1, 2, 3""",
    )


# --- availability --------------------------------------------------------

VALID = "(MC531 <> 0 OR MC531 IS NULL)"
W5 = "time_bucket(INTERVAL '5 minutes', time, TIMESTAMP '1970-01-01')"
MODE = ("mode5", f"""
    SELECT turbine, w, label FROM (
      SELECT turbine, w, label, row_number() OVER (PARTITION BY turbine, w ORDER BY n DESC, label DESC) AS rn
      FROM (SELECT turbine, {W5} AS w, MC531 AS label, count(*) AS n FROM telemetry WHERE {VALID} GROUP BY 1, 2, 3)
    ) WHERE rn = 1""")
FIVE_ROWS = ("five", f"""
    SELECT 'five_minute' AS method, t.turbine, t.w, m.label, wind_speed, power, seconds,
      power * seconds / 3600e0 AS actual
    FROM (SELECT turbine, {W5} AS w, avg(MC004) AS wind_speed, avg(MC209) AS power, count(MC132) AS seconds
          FROM telemetry WHERE {VALID} GROUP BY 1, 2) AS t
    JOIN mode5 AS m ON m.turbine = t.turbine AND m.w = t.w
    WHERE wind_speed IS NOT NULL""")
TEN_ROWS = ("ten", f"""
    SELECT 'ten_minute' AS method, turbine, {TEN} AS w, MC531 AS label, avg(MC004) AS wind_speed,
      avg(MC209) AS power, count(MC132) AS seconds, avg(MC209) * count(MC132) / 3600e0 AS actual
    FROM telemetry WHERE MC531 <> 0 GROUP BY 2, 3, 4 HAVING avg(MC004) IS NOT NULL""")
MINUTES = ("minutes", """
    WITH per AS (
      SELECT turbine, CAST(time AS DATE) AS record_date, MC531 AS label, count(*) FILTER (WHERE MC531 <> 0) AS n
      FROM telemetry GROUP BY 1, 2, 3)
    SELECT turbine, record_date, label, n / 60e0 AS duration FROM per WHERE label <> 0
    UNION ALL
    SELECT turbine, record_date, 1000, (86400 - sum(n)) / 60e0 FROM per GROUP BY 1, 2""")


def _row_columns(*more):
    doubles = {"wind_speed", "power", "actual", "expected", "intl_expected", "potential", "intl_potential"}
    names = ("method", "turbine", "w", "label", "wind_speed", "power", "seconds", "actual", *more)
    return ", ".join(_r(name, name) if name in doubles else name for name in names)


def _curves():
    rows = []
    for kind, powers in (("8MW", CURVE_8MW), ("10MW", CURVE_10MW)):
        points = [(CURVE_FIRST_WIND + CURVE_STEP * i, power) for i, power in enumerate(powers)]
        rows += [(kind, x0, x1, y0, y1) for (x0, y0), (x1, y1) in zip(points, points[1:])]
    values = ", ".join(f"('{kind}', {x0}e0, {x1}e0, {y0}e0, {y1}e0)" for kind, x0, x1, y0, y1 in rows)
    return "curve", f"SELECT * FROM (VALUES {values}) AS c(kind, x0, x1, y0, y1)"


def _info():
    rows = []
    for at, device in enumerate(fx.DEVICES):
        cut_in = 3.0 if at == 0 else 3.0 + at % 2
        rows.append(f"('{device}', '{'10MW' if at >= 4 else '8MW'}', {cut_in}e0, 25.0e0)")
    return "info", f"SELECT * FROM (VALUES {', '.join(rows)}) AS i(turbine, turbine_type, cut_in, cut_out)"


_LINE = """CASE WHEN wind_speed <= 3e0 THEN (SELECT min(y0) FROM curve WHERE kind = turbine_type)
    ELSE (SELECT max(y0 + (wind_speed - x0) * (y1 - y0) / (x1 - x0)) FROM curve
          WHERE kind = turbine_type AND wind_speed >= x0 AND wind_speed < x1) END"""


def _expected(source, power=_LINE):
    """Rows with energy by their own curve and, for 10MW turbines, by a second one (the same curve)."""
    return [
        _curves(), _info(),
        ("placed", f"""
            SELECT r.*, i.turbine_type, cut_in, cut_out,
              CASE WHEN greatest(wind_speed, 0e0) <= 8e-1 * cut_in OR wind_speed >= cut_out THEN 0e0
                   ELSE {power} END AS curve_power
            FROM ({source}) AS r JOIN info AS i ON i.turbine = r.turbine"""),
        ("expected", """
            SELECT *, curve_power * seconds / 3600e0 AS expected,
              CASE WHEN turbine_type = '10MW' THEN curve_power * seconds / 3600e0 ELSE 0e0 END AS intl_expected
            FROM placed"""),
    ]


def _forest():
    """The nearest sampled point per tree, found for every wind speed by comparing all points."""
    drawn = bootstrap_samples(len(CURVE_8MW), TREES, SEED)
    values = ", ".join(f"({tree}, {CURVE_FIRST_WIND + CURVE_STEP * i}e0, {i})"
                       for tree, row in enumerate(drawn) for i, taken in enumerate(row) if taken)
    powers = ", ".join(f"('{kind}', {i}, {power}e0)" for kind, curve in (("8MW", CURVE_8MW), ("10MW", CURVE_10MW))
                       for i, power in enumerate(curve))
    return [
        ("taken", f"SELECT * FROM (VALUES {values}) AS t(tree, x, i)"),
        ("points", f"SELECT * FROM (VALUES {powers}) AS p(kind, i, y)"),
        ("winds", """SELECT DISTINCT CAST(CAST(wind_speed AS FLOAT) AS DOUBLE) AS wind FROM five"""),
        ("nearest", """
            SELECT wind, tree, i FROM (
              SELECT wind, tree, i, row_number() OVER (
                PARTITION BY wind, tree ORDER BY abs(x - least(greatest(wind, 3e0), 25e0)), x) AS rn
              FROM winds CROSS JOIN taken) WHERE rn = 1"""),
        ("fitted", "SELECT kind, wind, avg(y) AS power FROM nearest JOIN points USING (i) GROUP BY 1, 2"),
    ]


_FOREST = """(SELECT max(power) FROM fitted
              WHERE kind = turbine_type AND wind = CAST(CAST(wind_speed AS FLOAT) AS DOUBLE))"""
BOTH = "SELECT * FROM five UNION ALL SELECT * FROM ten"
PEERS = ("peers", """
    WITH winds AS (SELECT turbine_type, turbine, avg(wind_speed) AS wind FROM expected
                   WHERE method = 'five_minute' GROUP BY 1, 2),
    pairs AS (
      SELECT a.turbine_type, a.turbine, a.wind, b.turbine AS peer, count(b.turbine) OVER (PARTITION BY a.turbine) AS others,
        row_number() OVER (PARTITION BY a.turbine ORDER BY abs(a.wind - b.wind), b.turbine) AS rn
      FROM winds AS a LEFT JOIN winds AS b ON a.turbine_type = b.turbine_type AND a.turbine <> b.turbine)
    SELECT 'five_minute' AS method, turbine_type, turbine, wind,
      max(CASE WHEN rn = 1 AND others > 1 THEN peer END) AS nearest,
      max(CASE WHEN rn = 2 AND others > 1 THEN peer END) AS second
    FROM pairs GROUP BY 1, 2, 3, 4""")
POTENTIAL = ("potential", """
    WITH normal AS (SELECT * FROM expected WHERE label = 120),
    means AS (
      SELECT r.method, r.turbine, r.w, r.label, avg(n.actual) AS actual, avg(n.seconds) AS seconds
      FROM expected AS r JOIN normal AS n
        ON n.method = r.method AND n.w = r.w AND n.turbine_type = r.turbine_type AND n.turbine <> r.turbine
      WHERE r.label <> 120 GROUP BY 1, 2, 3, 4),
    made AS (
      SELECT r.*, CASE WHEN r.label <> 120 THEN coalesce(
          a.actual * r.seconds / nullif(a.seconds, 0), b.actual * r.seconds / nullif(b.seconds, 0),
          m.actual * r.seconds / nullif(m.seconds, 0)) END AS by_peer
      FROM expected AS r
      LEFT JOIN peers AS p ON p.method = r.method AND p.turbine = r.turbine
      LEFT JOIN normal AS a ON a.method = r.method AND a.w = r.w AND a.turbine = p.nearest
      LEFT JOIN normal AS b ON b.method = r.method AND b.w = r.w AND b.turbine = p.second
      LEFT JOIN means AS m ON m.method = r.method AND m.w = r.w AND m.turbine = r.turbine AND m.label = r.label)
    SELECT *, coalesce(by_peer, expected) AS potential, coalesce(by_peer, intl_expected) AS intl_potential FROM made""")
_ENERGY = [T, MODE, FIVE_ROWS, TEN_ROWS, *_expected(BOTH), PEERS, POTENTIAL]
_INFO_COLUMNS = ("turbine_type", "cut_in", "cut_out", "expected", "intl_expected")


def _potential(method):
    columns = _row_columns(*_INFO_COLUMNS, "potential", "intl_potential")
    return _with(*_ENERGY, select=f"SELECT {columns} FROM potential WHERE method = '{method}'")


def _daily(farm):
    return f"""
        SELECT strftime(w, '%Y-%m') AS record_month, CAST(w AS DATE) AS record_date, 'PBA' AS record_type,
        method AS standard_abbr, turbine, label, {_r('avg(wind_speed)', 'wind_speed')},
        {_r('coalesce(sum(actual), 0)', 'actual_generation')},
        {_r('coalesce(sum(expected), 0)', 'theoretical_generation')}, CAST(sum(seconds) AS BIGINT) AS seconds,
        {_r('coalesce(sum(intl_expected), 0)', 'intl_theoretical_generation')},
        {_r('coalesce(sum(potential), 0)', 'potential_generation')},
        {_r('coalesce(sum(intl_potential), 0)', 'intl_potential_generation')},
        {_r('coalesce(sum(greatest(potential - actual, 0e0)), 0)', 'loss_amount')},
        {_r('coalesce(sum(greatest(intl_potential - actual, 0e0)), 0)', 'intl_loss_amount')}, '{farm}' AS farm
        FROM potential GROUP BY 1, 2, 3, 4, 5, 6"""


def _of_two_farms(select):
    """``select`` (farm → a query with its CTEs' text) of the days of a request, once per farm."""
    days = "CAST(time AS DATE) BETWEEN DATE '{}' AND DATE '{}'".format(*REQUEST_DAYS)
    parts = []
    for farm, kept in (("north", "TRUE"), ("south", "MC006 % 3 = 0")):
        own = ("telemetry", f"SELECT * FROM ({TELEMETRY}) WHERE {days} AND {kept}")
        parts.append(f"SELECT * FROM ({select(own, farm)})")
    return "\nUNION ALL\n".join(parts)


def _tba_of(farm):
    first, last = REQUEST_DAYS
    return f"""
        SELECT '{farm}' AS farm, d.turbine, d.record_date, coalesce(m.label, 1000) AS label,
          coalesce(m.duration, 1440e0) AS duration
        FROM (SELECT DISTINCT turbine, CAST(unnest(generate_series(DATE '{first}', DATE '{last}', INTERVAL 1 DAY)) AS DATE)
                AS record_date FROM minutes) AS d
        LEFT JOIN minutes AS m ON m.turbine = d.turbine AND m.record_date = d.record_date
        WHERE d.record_date >= (SELECT min(record_date) FROM minutes WHERE label <> 1000)"""


# --- events --------------------------------------------------------------

M = ("messages", MESSAGES)


def _case(value, texts, other="''"):
    whens = " ".join(f"WHEN {key} THEN '{text}'" for key, text in texts.items())
    return f"CASE {value} {whens} ELSE {other} END"


def _flag(value, texts):
    return f"CASE WHEN {value} = 1 THEN '{texts[True]}' ELSE '{texts[False]}' END"


def _time(value):
    return f"make_timestamp({value} * 1000)"


_RFC = "%Y-%m-%dT%H:%M:%SZ"
D = ("decoded", f"""
    SELECT * REPLACE ({_time('StartTime')} AS StartTime, {_time('EndTime')} AS EndTime,
                      {_time('ConfirmedTime')} AS ConfirmedTime),
      StartTime AS StartMillis,
      {_case('EventLevel', LEVEL_TEXT)} AS EventLevelStr,
      {_flag('FirstEvent', FIRST_TEXT)} AS FirstEventStr, {_flag('Confirmed', CONFIRMED_TEXT)} AS ConfirmedStr,
      CASE WHEN Confirmed = 1 THEN strftime({_time('ConfirmedTime')}, '{_RFC}') ELSE '' END AS ConfirmedTimeStr
    FROM messages""")
_WANTED = """System = 'turbine' AND Category = 'event' AND EventLevel IN (0, 1, 2, 4)
    AND (FarmCode IN ('farm0', 'farm3') OR FarmCode = 'farm1' AND Device IN ('d1', 'd5', 'd13'))
    AND StartTime >= TIMESTAMP '{a}' AND StartTime < TIMESTAMP '{b}'""".format(a=FROM, b=UNTIL)
_LEVEL_CODE = "CASE WHEN EventLevel BETWEEN 1 AND 4 THEN EventLevel ELSE 0 END"


def oracle_sql() -> dict[str, str]:
    between = f"time >= TIMESTAMP '{FROM}' AND time <= TIMESTAMP '{UNTIL}'"
    origin = "TIMESTAMP '1970-01-01'"
    minute, hours, days, weeks, months, quarters, years = BUCKETS
    summary = _report(metrics.SUMMARY_COLUMNS)
    number = "regexp_replace(CAST({} AS VARCHAR), '\\.0$', '')"
    return {
        "scan_filtered": _with(T, select=f"""
            SELECT time, turbine, MC004, MC006, MC143 FROM telemetry
            WHERE {between} AND turbine IN ({_names(fx.DEVICES[:4])})"""),
        "scan_device_day": _with(T, select=f"""
            SELECT time, turbine, MC004, MC531 FROM telemetry
            WHERE turbine = '{fx.DEVICES[1]}' AND CAST(time AS DATE) = DATE '2024-01-09'"""),
        "report_scan": _with(T, _totals(), ("r", summary), select=f"""
            SELECT Time, DeviceName, Met1sWSpdAvg, YawHours FROM r
            WHERE Time >= TIMESTAMP '{FROM}' AND Time < TIMESTAMP '{UNTIL}'
              AND DeviceName IN ({_names(fx.DEVICES[2:])})"""),
        "file_report_time": _with(T, select=f"""
            SELECT concat(turbine, '_', strftime(time, '%Y%m%d%H%M'), '_samples.parquet') AS file,
              turbine AS device, date_trunc('minute', time) AS sample_time, {TEN} AS report_time FROM telemetry"""),
        "time_bucket": _with(T, select=f"""
            SELECT {TEN} AS b0, count(*) AS samples,
              time_bucket(INTERVAL '5 hours', {TEN}, {origin}) AS b1,
              time_bucket(INTERVAL '2 days', {TEN}, {origin}) AS b2,
              time_bucket(INTERVAL '14 days', {TEN}, TIMESTAMP '1970-01-05') AS b3,
              CAST(time_bucket(INTERVAL '5 months', {TEN}, {origin}) AS TIMESTAMP) AS b4,
              CAST(date_trunc('quarter', {TEN}) AS TIMESTAMP) AS b5,
              CAST(time_bucket(INTERVAL '24 months', {TEN}, {origin}) AS TIMESTAMP) AS b6
            FROM telemetry GROUP BY {TEN}"""),
        "resample": _with(T, select=f"""
            SELECT date_trunc('hour', time) AS interval, {_r('avg(MC004)', 'wind_avg')}, {_r('max(MC004)', 'wind_max')},
              arg_max(MC006, time) AS meter_last, arg_min(MC006, time) AS meter_first, count(MC132) AS MC132count,
              {_r('sum(Generation)', 'made_sum')}, {_r('min(Generation)', 'made_min')}, turbine
            FROM telemetry WHERE {between} GROUP BY 1, turbine ORDER BY 1, turbine"""),
        "resample_csv": _with(T, select=f"""
            SELECT date_trunc('hour', time) AS interval, {_r('avg(MC004)', 'wind_avg')}, {_r('max(MC004)', 'wind_max')},
              arg_max(MC006, time) AS meter_last, arg_min(MC006, time) AS meter_first, count(MC132) AS MC132count,
              {_r('sum(Generation)', 'made_sum')}, {_r('min(Generation)', 'made_min')}, turbine
            FROM telemetry WHERE {between} GROUP BY 1, turbine ORDER BY 1, turbine"""),
        "arriving_files": _with(T, select="""
            SELECT turbine AS file_device, CAST(date_trunc('day', time) AS TIMESTAMP) AS file_time, time, MC004 FROM telemetry"""),
        "resample_weeks": _with(T, select=f"""
            SELECT time_bucket(INTERVAL '14 days', time, TIMESTAMP '1970-01-05') AS interval,
              {_r('avg(MC004)', 'MC004avg')}, {_r('max(MC004)', 'MC004max')}, count(MC132) AS MC132count, turbine
            FROM telemetry GROUP BY 1, turbine ORDER BY 1, turbine"""),
        "period_grid": _with(T, ("spans", _SPANS), select="\nUNION ALL\n".join(
            f"""SELECT turbine, label, "start", "end", '{p}' AS period, p AS period_start, p + {_GRID[p][1]} AS period_end
            FROM (SELECT *, unnest(generate_series(date_trunc('{_GRID[p][0]}', "start"), "end", {_GRID[p][1]})) AS p
                  FROM spans) WHERE p < "end" """ for p in ("hour", "day", "month", "year"))),
        "period_grid_days": _with(T, ("spans", _SPANS), ("cuts", """
            SELECT turbine, label, "start", "end", "start" AS c FROM spans
            UNION SELECT turbine, label, "start", "end", "end" FROM spans
            UNION SELECT * FROM (
              SELECT turbine, label, "start", "end",
                unnest(generate_series(date_trunc('day', "start") + INTERVAL 1 DAY, "end", INTERVAL 1 DAY)) AS c FROM spans)
              WHERE c < "end" """), select="""
            SELECT turbine, label, "start", "end", c AS period_start, n AS period_end FROM (
              SELECT *, lead(c) OVER (PARTITION BY turbine, label ORDER BY c) AS n FROM cuts) WHERE n IS NOT NULL"""),
        "merge_same_schema": "SELECT * FROM orders",
        "merge_by_name": """
            SELECT o_orderkey, o_custkey, o_orderstatus,
              CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS o_totalprice, o_orderdate,
              CASE WHEN o_orderkey % 2 <> 0 THEN o_orderpriority END AS o_orderpriority FROM orders""",
        "duplicate_keys": """
            SELECT * FROM (SELECT l_orderkey, l_returnflag, count(*) OVER (PARTITION BY l_orderkey, l_returnflag) AS copies
                           FROM lineitem) WHERE copies > 1""",
        "distinct_rows": "SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem",
        "report_summary": _with(T, _totals(), select=summary),
        "report_availability": _with(T, _totals(), select=_report(metrics.AVAILABILITY_COLUMNS)),
        "report_efficiency": _with(T, _totals(), select=_report(metrics.EFFICIENCY_COLUMNS)),
        "report_combined": _with(T, _totals(), select=_report(metrics.COMBINED_COLUMNS)),
        "report_rollup_10min": _rollup("10min"),
        "report_rollup_hour": _rollup("hour"),
        "report_rollup": _rollup("day"),
        "report_rollup_month": _rollup("month"),
        "report_rollup_additive": _added(),
        "schema_conflicts": f"""
            SELECT column_name AS "column", count(*) AS files, string_agg(DISTINCT kind, ', ' ORDER BY kind) AS types,
              min(kind) <> max(kind) AS conflict
            FROM (SELECT column_name, CASE data_type
                    WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
                    WHEN 'FLOAT[]' THEN 'array<float>' ELSE lower(data_type) END AS kind
                  FROM information_schema.columns WHERE table_name IN ({_names(fx.TABLES)}))
            GROUP BY 1""",
        "report_rollup_year": _rollup("year"),
        "report_expressions": _with(*_rollup_cte("day"), select=f"""
            SELECT Time, DeviceName,
              {_r('FaultLossGeneration / nullif(GriActiveEnergyDelTotal + FaultLossGeneration, 0) * 100', 'LossShare')},
              CASE WHEN Count > 1 AND FaultShutdownDuration < 1 THEN 1.0e0 ELSE 0.0e0 END AS Busy,
              {_r('GriActiveEnergyDelLast - PreTotalGenerationFirst', 'MeterRange')},
              CAST(NULL AS DOUBLE) AS PerZero, {_r('coalesce(MTTRDuration, -1)', 'Repair')},
              CASE WHEN YawCwTimesSum IN (0, 1) OR YawCwTimesSum = GriActiveEnergyDelTotal - GriActiveEnergyDelTotal
                THEN 1e0 ELSE 0e0 END AS Rare,
              DeviceName = 'pair' AS OfTwo, DeviceName || ': ' || coalesce({number.format('YawCwTimesSum')}, '') AS Title,
              CAST(xor((CAST(YawCwTimesSum AS BIGINT) & 6) | 1, 4) AS DOUBLE) AS Bits,
              CASE WHEN Time >= TIMESTAMP '2024-01-10' THEN 'new' ELSE 'old' END AS Since, CAST(2 AS DOUBLE) AS Climb
            FROM rolled"""),
        "report_csv_layout": _with(T, _totals(), ("r", _report(
            ("Time", "DeviceName", "Count", "YawHours", "Met1sWSpdAvg", "EquivalentHours"), rounded=False)), select=f"""
            SELECT strftime(Time, '{_RFC}') AS "时间", DeviceName AS Turbine, '' AS Absent, CAST(Count AS VARCHAR) AS Rows,
              coalesce({number.format('round(EquivalentHours, 6)')}, '') AS Hours,
              coalesce({number.format('round(Met1sWSpdAvg, 6)')}, '') AS Wind,
              coalesce({number.format('YawHours')}, '') AS Yaw FROM r"""),
        "ad_hoc_summary": _ad_hoc("SummaryReport", "n_wind"),
        "ad_hoc_availability": _ad_hoc("TurbineAvailabilityMetrics", "n"),
        "ad_hoc_efficiency": _ad_hoc("EfficiencyMetrics", "n_meter"),
        "label_mode": _with(T, MODE, select="SELECT turbine, w, label FROM mode5"),
        "tba_minutes": _with(T, MINUTES, select=f"SELECT turbine, record_date, label, duration FROM minutes"),
        "tba_calendar": _with(T, MINUTES, select=f"""
            SELECT d.record_date, coalesce(m.label, 1000) AS label, coalesce(m.duration, 1440e0) AS duration,
              strftime(m.record_date, '%Y-%m') AS record_month, d.turbine, 'farm' AS farm
            FROM (SELECT DISTINCT turbine, CAST(unnest(generate_series(DATE '{FIRST_DAY}', DATE '{LAST_DAY}', INTERVAL 1 DAY)) AS DATE)
                    AS record_date FROM minutes) AS d
            LEFT JOIN minutes AS m ON m.turbine = d.turbine AND m.record_date = d.record_date
            WHERE d.record_date >= (SELECT min(record_date) FROM minutes WHERE label <> 1000
                                    AND record_date BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}')"""),
        "pba_five_minute": _with(T, MODE, FIVE_ROWS, select=f"SELECT {_row_columns()} FROM five"),
        "pba_ten_minute": _with(T, TEN_ROWS, select=f"SELECT {_row_columns()} FROM ten"),
        "pba_expected": _with(T, MODE, FIVE_ROWS, *_expected("SELECT * FROM five"),
                              select=f"SELECT {_row_columns(*_INFO_COLUMNS)} FROM expected"),
        "pba_expected_forest": _with(
            T, MODE, FIVE_ROWS, *_forest(), *_expected("SELECT * FROM five", _FOREST),
            select=f"SELECT {_row_columns(*_INFO_COLUMNS)} FROM expected"),
        "pba_nearest_peers": _with(T, MODE, FIVE_ROWS, *_expected("SELECT * FROM five"), PEERS, select=f"""
            SELECT method, turbine_type, turbine, {_r('wind', 'wind')}, nearest, second FROM peers"""),
        "pba_potential": _potential("five_minute"),
        "pba_potential_ten": _potential("ten_minute"),
        "pba_daily": _with(*_ENERGY, select=_daily("farm")),
        "events_decoded": _with(M, D, select=f"""
            SELECT MessageId, FarmCode, System, Category, Device, DeviceType, Part, StartTime, EndTime, EventLevel,
              EventLevelStr, EventCode, EventDesc, FirstEvent, FirstEventStr, RelevantId, Confirmed, ConfirmedStr,
              Confirmer, ConfirmedTime, ConfirmedTimeStr, Remark, Attachment,
              {_LEVEL_CODE} AS level_of_text, {_LEVEL_CODE} AS level_of_number,
              EventLevelStr AS text_of_level, StartMillis FROM decoded"""),
        "events_history": _with(M, D, select=f"SELECT MessageId, StartTime, Device FROM decoded WHERE {_WANTED}"),
        "events_history_total": _with(M, D, select=f"SELECT count(*) AS total FROM decoded WHERE {_WANTED}"),
        "events_page": _with(M, D, select="""
            SELECT MessageId, StartTime FROM decoded ORDER BY StartTime DESC, MessageId DESC LIMIT 25 OFFSET 50"""),
        "events_page_late": _with(M, D, select="""
            SELECT MessageId, StartTime FROM decoded ORDER BY StartTime, MessageId LIMIT 2500 OFFSET 7500"""),
        "events_page_stored": _with(M, D, select=f"""
            SELECT MessageId, StartTime FROM decoded WHERE {_WANTED} ORDER BY StartTime DESC, MessageId DESC LIMIT 50 OFFSET 150"""),
        "events_open": _with(M, D, select=f"""
            SELECT MessageId, FarmCode, Device, EventLevel FROM decoded WHERE {_WANTED} AND EndTime IS NULL"""),
        "events_flattened": _with(M, select="""
            SELECT MessageId, RelevantId, CAST(id - id % 5 AS VARCHAR) AS root_id, CAST(id % 5 AS INTEGER) AS depth,
              array_to_string([CAST(x AS VARCHAR) for x in range(id - id % 5, id + 1)], '/') AS path
            FROM (SELECT *, CAST(MessageId AS BIGINT) AS id FROM messages)"""),
        "events_flattened_nested": _with(M, ("shape", """
            SELECT * FROM (VALUES (0, ''), (1, '.a'), (2, '.a.x'), (2, '.a.y'), (1, '.b')) AS s(depth, suffix)"""), select="""
            SELECT MessageId AS root_id,
              CAST(row_number() OVER (PARTITION BY MessageId ORDER BY suffix) - 1 AS INTEGER) AS position, depth,
              MessageId || suffix AS MessageId, CASE WHEN depth = 0 THEN RelevantId ELSE MessageId END AS RelevantId,
              EventLevel, StartTime
            FROM messages JOIN shape ON depth = 0 OR (Confirmed = 1 AND (depth = 1 OR EventLevel > 2))"""),
        "event_csv_layout": _with(M, D, select=f"""
            SELECT MessageId AS "﻿编号", strftime(StartTime, '%Y-%m-%d %H:%M:%S') AS "开始时间",
              coalesce(strftime(EndTime, '{_RFC}'), '') AS "End", EventLevelStr AS Level,
              ConfirmedTimeStr AS "Confirmed at", CAST(FirstEvent AS VARCHAR) AS First, '' AS Missing FROM decoded"""),
        "stream_ten_minute": _with(T, _totals(), ("r", _report(metrics.COMBINED_COLUMNS)), select="""
            SELECT * FROM r WHERE Time + INTERVAL 10 MINUTE
              <= (SELECT date_trunc('millisecond', max(time)) FROM telemetry) - INTERVAL 10 MINUTE"""),
        "events_open_stream": _with(M, select=_OPEN_NOW),
        "events_open_now": _with(M, select=_OPEN_NOW),
        "replayed_files": _with(T, select="SELECT time, turbine, MC004 FROM telemetry"),
        "files_named": "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag FROM lineitem",
        "merge_files": """
            SELECT o_orderkey, o_custkey, o_orderstatus,
              CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS o_totalprice, o_orderdate,
              CASE WHEN o_orderkey % 2 <> 0 THEN o_orderpriority END AS o_orderpriority FROM orders""",
        "merge_arrivals_by_name": _with(T, ("one", _arrived(2, "MC143")), ("two", _arrived(0, "MC006")), select=f"""
            SELECT * FROM (
              SELECT time, turbine, MC004, NULL AS MC143, MC006 FROM two
              UNION ALL SELECT time, turbine, MC004, MC143, NULL FROM one ANTI JOIN two USING (time, turbine))
            WHERE {between}"""),
        "device_month": _with(T, select=f"""
            SELECT time, turbine, MC004, MC143 FROM telemetry WHERE {between} AND turbine IN ({_names(fx.DEVICES[1:3])})"""),
        "late_samples": _with(T, select=f"""
            SELECT time, turbine, max(MC143) AS MC143 FROM telemetry
            WHERE time < TIMESTAMP '{STREAM_CUT}' AND time < (
              SELECT max(time) FROM telemetry WHERE time >= TIMESTAMP '{STREAM_CUT}') - INTERVAL 10 MINUTE
            GROUP BY 1, 2"""),
        "late_windows": _stored_reports(),
        "file_reports": _stored_reports(),
        "late_blocks": _of_levels(("day", "month"), STORED_COLUMNS),
        "report_blocks": _of_levels(("hour", "day", "month"), metrics.COMBINED_COLUMNS[2:]),
        "report_rollup_exact": _exact_groups(
            "CAST(date_trunc('day', time) AS TIMESTAMP)",
            f"time >= date_trunc('day', TIMESTAMP '{FROM}') AND time < date_trunc('day', TIMESTAMP '{UNTIL}') + INTERVAL 1 DAY",
            _grid("day")),
        "report_range_exact": _exact_groups(
            f"TIMESTAMP '{BLOCK_RANGE[0]}'", f"time >= TIMESTAMP '{BLOCK_RANGE[0]}' AND time < TIMESTAMP '{BLOCK_RANGE[1]}'",
            ("grid", f"SELECT TIMESTAMP '{BLOCK_RANGE[0]}' AS ps, TIMESTAMP '{BLOCK_RANGE[1]}' AS pe")),
        "report_store": _with(T, _totals(), ("r", _report(
            ("Time", "DeviceName", "Count", "YawHours", "Met1sWSpdMax"), rounded=False)), select=f"""
            SELECT Time, DeviceName, Count, YawHours, {_r('round(Met1sWSpdMax, 6)', 'Met1sWSpdMax')} FROM r
            WHERE Time >= TIMESTAMP '{FROM}' AND Time < TIMESTAMP '{UNTIL}' AND DeviceName IN ({_names(fx.DEVICES[1:])})"""),
        "report_json_lines": _with(T, _totals(), select=_report(("Time", "DeviceName", "Count", "Met1sWSpdAvg"))),
        "events_exported": _with(M, D, select=f"""
            SELECT MessageId, strftime(StartTime, '%Y-%m-%d %H:%M:%S') AS StartTime,
              coalesce(strftime(EndTime, '{_RFC}'), '') AS EndTime, EventLevelStr, ConfirmedTimeStr,
              CAST(FirstEvent AS VARCHAR) AS FirstEvent, '' AS Missing FROM decoded WHERE {_WANTED}"""),
        "turbine_info_file": """
            SELECT s_name AS turbine, CASE WHEN s_suppkey % 2 = 0 THEN '8MW' ELSE '10MW' END AS turbine_type,
              CAST(s_suppkey % 4 AS DOUBLE) AS cut_in, CASE WHEN s_suppkey % 5 <> 0 THEN 25e0 END AS cut_out
            FROM supplier WHERE s_nationkey % 3 = 1""",
        "grid_dates_file": """
            SELECT 't' || event_id AS turbine, date_trunc('second', ts) AS on_grid,
              CAST(date_trunc('day', ts) AS TIMESTAMP) AS trial_end FROM events WHERE event_id % 3 <> 0""",
        "pba_two_farms": _of_two_farms(lambda own, farm: _with(own, *_ENERGY[1:], select=_daily(farm))),
        "tba_two_farms": _of_two_farms(lambda own, farm: _with(own, MINUTES, select=_tba_of(farm))),
    }


def _arrived(left_out, column):
    """A batch of samples: of copies of a turbine and time the greatest."""
    return f"""
        SELECT time, turbine, MC004, {column} FROM (
          SELECT *, row_number() OVER (PARTITION BY time, turbine ORDER BY MC004 DESC, {column} DESC) AS rn
          FROM telemetry WHERE MC006 % 3 <> {left_out}) WHERE rn = 1"""


_OPEN_NOW = """
            SELECT MessageId, FarmCode, Device, EventLevel, StartTime, EndTime, ConfirmedTime FROM messages
            WHERE EndTime IS NULL AND NOT (CAST(MessageId AS BIGINT) % 10 = 2 AND CAST(MessageId AS BIGINT) % 3 <> 0)"""


def _stored_reports():
    """What the report store holds of all windows: six decimals."""
    columns = ("Time", "DeviceName", *STORED_COLUMNS)
    values = ", ".join("Count" if name == "Count" else _r(f"round({name}, 6)", name) for name in STORED_COLUMNS)
    return _with(T, _totals(), ("r", _report(columns, rounded=False)), select=f"SELECT Time, DeviceName, {values} FROM r")


_SPANS = """SELECT turbine, MC531 AS label, min(time) AS "start", max(time) AS "end" FROM telemetry GROUP BY 1, 2"""
