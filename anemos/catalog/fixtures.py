"""Views over the given tables that stand in for wind-farm data.

Each text runs unchanged in Spark and in DuckDB, where ``{events}`` is the
events table. They make up six turbines in two types, all operating states, an
invalid label, missing values and event messages with chains of related events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import small_table

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
FARM = "WF01"
DEVICES = [f"{FARM}_{number:03d}" for number in range(1, 7)]
GROUPS = [{"all": DEVICES}, {"pair": [DEVICES[0], DEVICES[1], DEVICES[1]]}, {"none": [f"{FARM}_099"]}]

_ENTRY = {
    "FaultShutdownTimes": 40, "OverhaulTimes": 50, "MaintenanceTimes": 60, "GridShutdownTimes": 70,
    "LocalShutdownTimes": 81, "RemoteShutdownTimes": 80, "WeatherShutdownTimes": 90, "LimitPowerTimes": 110,
    "LimitShutdownTimes": 111, "StandbyTimes": 100, "NormalGenerationTimes": 120,
}
_LOSS = {
    "FaultLossGeneration": "40", "OverhaulLossGeneration": "50", "MaintainLossGeneration": "60",
    "GridLossGeneration": "70", "RemoteLossGeneration": "80", "LocalLossGeneration": "81",
    "WeatherLossGeneration": "90", "LimitLossGeneration": "110, 111",
}
_FLAGS = {
    "MA021": "k % 4 = 0", "MA022": "k % 4 = 1", "MA2353": "k % 9 = 0", "YawCwTimes": "k % 8 = 0",
    "YawCcwTimes": "k % 8 = 1", "GenReactQLimitStateTimes": "k % 18 = 0",
    "IsEffectWind": "value % 30 >= 3", "InterruptionTimes": "k = 99",
    **{name: f"label = {code} AND k % 3 = 0" for name, code in _ENTRY.items()},
}

TELEMETRY_SQL = f"""
SELECT
  ts AS time,
  concat('{FARM}_00', CAST(slot + 1 AS VARCHAR(10))) AS turbine,
  CASE WHEN slot >= 4 THEN '10MW' ELSE '8MW' END AS turbine_type,
  value % 30 AS MC004, value % 28 AS MC082, value % 26 AS MC083,
  1.0e0 + k / 1.0e3 AS MC093,
  CASE WHEN slot >= 4 THEN 1.0e4 ELSE 8.0e3 END AS RatedPower,
  CAST(event_id AS DOUBLE) AS MC006,
  CAST(event_id AS DOUBLE) / 2 AS MC062,
  CAST(event_id AS DOUBLE) - 1 AS preTotalGeneration,
  CAST(event_id AS DOUBLE) / 2 - 1 AS preTotalEleConsumption,
  k * 8.0e1 AS MC061, k * 8.0e0 AS MD002, k * 7.9e1 AS MC085, k * 7.8e1 AS MC086, k * 1.2e2 AS MD001,
  value AS Generation, value / 1.0e1 AS Consumption,
  k / 4.0e0 AS MC015, k / 3.0e0 AS MC014, k / 2.0e0 AS MC091,
  label AS MC143,
  value * 2 AS TheoreticalGeneration,
  label AS MC531,
  k * 8.0e1 AS MC209,
  CASE WHEN k % 10 = 0 THEN NULL ELSE k END AS MC132,
  {", ".join(f"CASE WHEN {test} THEN 1 ELSE 0 END AS {name}" for name, test in _FLAGS.items())},
  {", ".join(f"CASE WHEN label IN ({codes}) THEN value ELSE 0.0e0 END AS {name}" for name, codes in _LOSS.items())}
FROM (
  SELECT *,
    CASE event_type
      WHEN 'click' THEN 120
      WHEN 'view' THEN 120
      WHEN 'error' THEN 40
      WHEN 'purchase' THEN CASE WHEN k % 2 = 0 THEN 0 ELSE 100 END
      ELSE CASE k % 8 WHEN 0 THEN 50 WHEN 1 THEN 60 WHEN 2 THEN 70 WHEN 3 THEN 80
                      WHEN 4 THEN 81 WHEN 5 THEN 90 WHEN 6 THEN 110 ELSE 111 END
    END AS label
  FROM (
    SELECT *, user_id % 6 AS slot, CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS k
    FROM {{events}}
  ) AS keyed
) AS labelled
"""

MESSAGES_SQL = """
SELECT
  CAST(event_id AS VARCHAR(20)) AS MessageId,
  concat('farm', CAST(user_id % 4 AS VARCHAR(10))) AS FarmCode,
  CASE WHEN event_id % 7 = 0 THEN 'station' ELSE 'turbine' END AS System,
  CASE WHEN event_type IN ('error', 'signup') THEN 'event' ELSE 'status' END AS Category,
  concat('d', CAST(user_id AS VARCHAR(10))) AS Device,
  'WT' AS DeviceType,
  concat('part', CAST(user_id % 3 AS VARCHAR(10))) AS Part,
  {millis} AS StartTime,
  CASE WHEN event_id % 5 = 2 THEN NULL ELSE {millis} + 60000 END AS EndTime,
  CAST(event_id % 5 AS INT) AS EventLevel,
  event_type AS EventCode,
  props AS EventDesc,
  CAST(event_id % 2 AS INT) AS FirstEvent,
  CASE WHEN event_id % 5 = 0 THEN '' ELSE CAST(event_id - 1 AS VARCHAR(20)) END AS RelevantId,
  CASE WHEN event_id % 3 = 1 THEN 1 ELSE 0 END AS Confirmed,
  CASE WHEN event_id % 3 = 1 THEN 'operator' END AS Confirmer,
  {millis} + 120000 AS ConfirmedTime,
  '' AS Remark,
  '' AS Attachment
FROM {events}
"""
SPARK_MILLIS = "unix_millis(CAST(ts AS TIMESTAMP))"
DUCKDB_MILLIS = "epoch_us(ts) // 1000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The samples of six turbines."""
    return spark.sql(TELEMETRY_SQL, events=table(spark, sf_dir, "events"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event messages; four of five name the one before them as related."""
    return spark.sql(MESSAGES_SQL.replace("{millis}", SPARK_MILLIS), events=table(spark, sf_dir, "events"))


def turbine_info(spark: SparkSession) -> DataFrame:
    """Types of the six turbines; the speeds of one are unknown."""
    rows = [(device, "10MW" if at >= 4 else "8MW", None if at == 0 else 3.0 + at % 2, 25.0 if at else None)
            for at, device in enumerate(DEVICES)]
    return small_table(spark, rows, "turbine string, turbine_type string, cut_in double, cut_out double")
