"""Pages and totals from stored counts."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from anemos.catalog import fixtures
from anemos.operators import events
from anemos.operators.events import EventQuery
from anemos.plans import event_store
from anemos.sinks import snapshot


@pytest.fixture(scope="module")
def decoded(spark, sf_dir):
    found = events.decode(fixtures.messages(spark, sf_dir))
    none = found.limit(3).withColumn("StartTime", F.lit(None).cast("timestamp_ntz")).withColumn("MessageId", F.concat(F.lit("x"), "MessageId"))
    return found.unionByName(none).cache()


@pytest.fixture(scope="module")
def store(spark, decoded, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("events"))
    number = F.pmod(F.xxhash64("MessageId"), F.lit(3))
    for n in (0, 1, 2, 1):  # one batch comes twice
        event_store.add_events(decoded.where(number == n), path, n)
    return path


QUERIES = [
    EventQuery(page_size=40), EventQuery(system="turbine", levels=[1, 2], page_size=40), EventQuery(devices=[("farm1", []), ("farm2", ["d2", "d6"])], page_size=40),
    EventQuery(start=dt.datetime(2024, 1, 4, 7, 31), end=dt.datetime(2024, 1, 19, 3, 2), page_size=40),
    EventQuery(start=dt.datetime(2024, 1, 4), end=dt.datetime(2024, 1, 5), first=1, page_size=40),
    EventQuery(start=dt.datetime(2024, 1, 4, 7, 31, 20), page_size=40, confirmed=1),
    EventQuery(start=dt.datetime(2024, 1, 9, 1), end=dt.datetime(2024, 1, 9, 20), page_size=40),
]


@pytest.mark.parametrize("query", QUERIES)
@pytest.mark.parametrize("order", ["asc", "desc"])
def test_pages_and_totals(spark, decoded, store, query, order):
    wanted = events.filter_events(decoded, query)
    n = wanted.count()
    assert event_store.total(spark, store, query) == n > 0
    keys = [events.ORDERS[order](key) for key in ("StartTime", "MessageId")]
    for page in sorted({1, 2, max(1, n // 80), n // 40 + 1, n // 40 + 5}):
        plain = wanted.orderBy(*keys).offset((page - 1) * 40).limit(40).select("MessageId").collect()
        found = event_store.page(spark, store, replace(query, page=page, order=order)).select("MessageId").collect()
        assert [r[0] for r in found] == [r[0] for r in plain]


def test_a_late_page_opens_only_its_days(spark, store):
    found = event_store.page(spark, store, EventQuery(page=12, page_size=40))
    days = {path.rsplit("/", 2)[1] for path in found.inputFiles()}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(StartTime" in plan
    # the counts were read from the index alone: only the page itself opens events
    spark.sparkContext.setJobGroup("page", "page")
    try:
        event_store.total(spark, store, EventQuery())
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(days) >= 1


def test_counts_are_added_once(spark, decoded, store):
    minutes = spark.createDataFrame([], "n long")
    state = snapshot(spark, f"{store}/minute")
    assert state.version == 2 and state.marks == {"events": 2}
    from anemos.sinks import read_table

    for name in ("minute", "day"):
        assert read_table(spark, f"{store}/{name}").agg(F.sum("n")).first()[0] == decoded.count()
    assert read_table(spark, f"{store}/day").count() < read_table(spark, f"{store}/minute").count()
    assert minutes.count() == 0
