from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from anemos.catalog import fixtures
from anemos.operators import events
from anemos.operators.events import EventQuery
from anemos.plans import jobs
from anemos.sources import message_schema, read_messages


@pytest.fixture(scope="module")
def decoded(spark, sf_dir):
    return events.decode(fixtures.messages(spark, sf_dir)).cache()


def message(name, level=1, children=(), **more):
    return {"MessageId": name, "FarmCode": "f1", "System": "turbine", "Category": "event", "Device": "d1",
            "StartTime": 1714521600000, "EventLevel": level, "FirstEvent": 1, "Confirmed": 0,
            "Relevant": list(children), **more}


def test_flatten_nested_in_order(spark):
    tree = message("a", children=[message("b", 2, [message("c", 4)]), message("d", 3)])
    rows = spark.createDataFrame([tree, message("z")], message_schema(2))
    flat = events.flatten_nested(rows).orderBy("root_id", "position").collect()
    assert [(r.root_id, r.position, r.depth, r.MessageId, r.EventLevel) for r in flat] == [
        ("a", 0, 0, "a", 1), ("a", 1, 1, "b", 2), ("a", 2, 2, "c", 4), ("a", 3, 1, "d", 3), ("z", 0, 0, "z", 1),
    ]


def random_forest(pick, size):
    parents = {f"m{n:03d}": (f"m{pick.randrange(n):03d}" if n and pick.random() < 0.9 else "") for n in range(size)}
    parents["m999"] = "unknown"
    return parents


@pytest.mark.parametrize("size, seed", [(1, 0), (40, 1), (120, 2)])
def test_flatten_by_parent_against_a_walk(spark, size, seed):
    parents = random_forest(random.Random(seed), size)
    df = spark.createDataFrame(list(parents.items()), "MessageId string, RelevantId string")
    got = {r.MessageId: (r.root_id, r.depth, r.path) for r in events.flatten_by_parent(df).collect()}
    for name in parents:
        path, at = [name], name
        while parents.get(at) in parents:
            at = parents[at]
            path.insert(0, at)
        assert got[name] == (path[0], len(path) - 1, path)
    assert len(got) == len(parents)


def test_a_long_chain(spark):
    rows = [(str(n), str(n - 1) if n else None) for n in range(40)]
    got = events.flatten_by_parent(spark.createDataFrame(rows, "MessageId string, RelevantId string"))
    assert {r.MessageId: r.depth for r in got.collect()} == {str(n): n for n in range(40)}


def test_events_in_a_circle(spark):
    rows = spark.createDataFrame([("a", "b"), ("b", "a")], "MessageId string, RelevantId string")
    with pytest.raises(ValueError, match="circle"):
        events.flatten_by_parent(rows)


def test_a_very_long_chain_and_a_second_delivery(spark):
    rows = [(str(n), str(n - 1) if n else None) for n in range(1_000)] + [("5", "4"), ("0", None)]
    got = events.flatten_by_parent(spark.createDataFrame(rows, "MessageId string, RelevantId string"))
    assert {r.MessageId: r.depth for r in got.collect()} == {str(n): n for n in range(1_000)} and got.count() == 1_000


def test_messages_of_any_depth(spark, tmp_path):
    """Fifty levels give fifty rows; side branches keep their places."""
    deep = message("0.49", 1)
    for n in reversed(range(49)):
        deep = message(f"0.{n}", 1, [deep, message(f"0.{n}.side", 2)] if n % 10 == 0 else [deep])
    (tmp_path / "m.json").write_text("\n".join(json.dumps(m) for m in (deep, message("z", 9), message("y", 1, []))), encoding="utf-8")
    flat = events.flatten_nested(read_messages(spark, str(tmp_path / "m.json")))
    rows = [r for r in flat.orderBy("position").collect() if r.root_id == "0.0"]
    trunk = [f"0.{n}" for n in range(50)]
    sides = [f"0.{n}.side" for n in (40, 30, 20, 10, 0)]
    assert [r.MessageId for r in rows] == trunk + sides
    assert [r.depth for r in rows] == [*range(50), 41, 31, 21, 11, 1]
    assert sorted(r.MessageId for r in flat.collect() if r.depth == 0) == ["0.0", "y", "z"]


def test_variant_and_typed_messages_agree(spark, tmp_path):
    trees = [message(f"r{n}", n, [message(f"r{n}.a", 1, [message(f"r{n}.b", 2), message(f"r{n}.c", 3)]), message(f"r{n}.d", 4)]) for n in range(5)]
    (tmp_path / "m.json").write_text("\n".join(json.dumps(m) for m in trees), encoding="utf-8")
    typed = events.flatten_nested(spark.createDataFrame(trees, message_schema(3)))
    free = events.flatten_nested(read_messages(spark, str(tmp_path / "m.json")))
    assert free.columns == typed.columns and free.dtypes == typed.dtypes
    assert sorted(map(str, free.collect())) == sorted(map(str, typed.collect()))


def test_what_is_no_message(spark, tmp_path):
    lines = ['{"MessageId": "a", "EventLevel": "high", "Relevant": "none"}', "no json", '{"MessageId": "b", "Relevant": [1, {"MessageId": "c"}]}',
             '{"MessageId": "d", "Relevant": null}', "{}"]
    (tmp_path / "m.json").write_text("\n".join(lines), encoding="utf-8")
    flat = events.flatten_nested(read_messages(spark, str(tmp_path / "m.json"))).collect()
    assert sorted((str(r.root_id), r.position, r.depth, str(r.MessageId)) for r in flat) == sorted([
        ("a", 0, 0, "a"), ("None", 0, 0, "None"), ("b", 0, 0, "b"), ("b", 1, 1, "None"), ("b", 2, 1, "c"), ("d", 0, 0, "d"), ("None", 0, 0, "None")])
    assert all(r.EventLevel is None for r in flat)


def test_deep_text_is_refused(spark, tmp_path):
    """Messages typed by hand, with a schema that is too shallow."""
    deep = message("6")
    for n in reversed(range(6)):
        deep = message(str(n), 1, [deep])
    (tmp_path / "m.json").write_text(json.dumps(deep), encoding="utf-8")
    with pytest.raises(Exception, match="nested deeper"):
        events.flatten_nested(spark.read.schema(message_schema(3)).json(str(tmp_path / "m.json"))).collect()


def test_empty_conditions_keep_everything(decoded):
    assert events.filter_events(decoded, EventQuery()).count() == decoded.count()


def test_whole_farm_and_single_devices(decoded):
    query = EventQuery(devices=[("farm0", []), ("farm1", ["d1"])])
    wanted = (F.col("FarmCode") == "farm0") | ((F.col("FarmCode") == "farm1") & (F.col("Device") == "d1"))
    got = events.filter_events(decoded, query)
    assert got.exceptAll(decoded.where(wanted)).count() == 0
    assert got.count() == decoded.where(wanted).count() > 0


def test_range_holds_start_but_not_end(decoded):
    times = [r.StartTime for r in decoded.orderBy("StartTime").limit(3).collect()]
    got = events.filter_events(decoded, EventQuery(start=times[0], end=times[2])).collect()
    assert sorted(r.StartTime for r in got) == times[:2]


@pytest.mark.parametrize("order", ["asc", "desc"])
@pytest.mark.parametrize("page, size", [(1, 7), (3, 40), (1, 2000), (26, 40), (99, 40)])
def test_late_pages_agree_with_early_ones(decoded, order, page, size):
    keys = [events.ORDERS[order](key) for key in ("StartTime", "MessageId")]
    plain = decoded.orderBy(*keys).offset((page - 1) * size).limit(size).select("MessageId").collect()
    found = events.page_of(decoded, page, size, order).select("MessageId")
    assert "SinglePartition" not in found._jdf.queryExecution().executedPlan().toString().replace("TakeOrdered", "")
    assert [r.MessageId for r in plain] == [r.MessageId for r in found.collect()]


def test_late_pages_with_many_events_at_one_time(spark):
    rows = [(f"m{n:03d}", dt.datetime(2024, 5, 1, 0, n % 3)) for n in range(90)] + [("none", None)]
    df = spark.createDataFrame(rows, "MessageId string, StartTime timestamp_ntz")
    for page in range(1, 8):
        plain = df.orderBy("StartTime", "MessageId").offset((page - 1) * 15).limit(15).collect()
        assert plain == events.page_of(df, page, 15).collect()


@pytest.mark.parametrize("page, size, order", [(0, 10, "asc"), (1, 0, "asc"), (1, 10, "sideways")])
def test_bad_pages(decoded, page, size, order):
    with pytest.raises(ValueError):
        events.page_of(decoded, page, size, order)


def test_confirmation_text(spark):
    rows = [message("a", Confirmed=1, ConfirmedTime=1714521600000), message("b", Confirmed=0, ConfirmedTime=0)]
    made = events.decode(spark.createDataFrame(rows, message_schema(0))).orderBy("MessageId").collect()
    assert [(r.ConfirmedStr, r.ConfirmedTimeStr) for r in made] == [
        ("已确认", "2024-05-01T00:00:00Z"), ("未确认", "")]
    assert made[0].StartTime == dt.datetime(2024, 5, 1) and made[0].FirstEventStr == "是"


def test_export_from_json_messages(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    tree = message("a", 4, [message("b", 2, [message("c", 1)])])
    (source / "m.json").write_text("\n".join(json.dumps(m) for m in (tree, message("z", 9))), encoding="utf-8")
    columns = [{"field": "MessageId", "title": "Id"}, {"field": "EventLevelStr", "title": "级别"},
               {"field": "StartTime", "title": "Start", "time_format": "2006-01-02"}]
    jobs.export_events(read_messages(spark, str(source)), EventQuery(), columns, str(tmp_path / "out"))
    text = [p.read_text(encoding="utf-8") for p in (tmp_path / "out").glob("*.csv")]
    lines = [line for part in text for line in part.splitlines()]
    assert lines[0] == "﻿Id,级别,Start"
    assert sorted(line for line in lines if not line.startswith("﻿")) == [
        "a,故障,2024-05-01", "b,告警,2024-05-01", "c,提示,2024-05-01", "z,,2024-05-01"]


@pytest.mark.parametrize("column", [{"title": "x"}, {"field": "x"}, {"field": "", "title": "x"}])
def test_columns_need_field_and_title(column):
    with pytest.raises(ValueError):
        events.check_columns([column])


def test_select_fields(decoded):
    assert events.select_fields(decoded).columns == list(events.EVENT_FIELDS)
    assert events.select_fields(decoded, ["Device", "Nothing"]).columns == ["Device"]


def test_open_events_follow_the_messages(spark, tmp_path):
    """After each batch the table is what one query over all messages so far gives; messages come in any order, some twice."""
    from anemos import streaming
    from anemos.sinks import read_table, snapshot

    rng = random.Random(4)
    schema = "MessageId string, Device string, EventLevel int, StartTime long, EndTime long, ConfirmedTime long"
    rows = []
    for n in range(60):
        versions = [(f"m{n}", f"d{n % 3}", v, 1000 * n, None, v or None) for v in range(rng.randrange(1, 4))]
        if n % 3 == 0:
            versions.append((f"m{n}", f"d{n % 3}", 9, 1000 * n, 1000 * n + 5, 7))
        rows += versions + versions[:1]
    rows += [(None, "d0", 1, 1, None, None), ("zero", "d0", 1, 5, 0, None)]
    rng.shuffle(rows)
    session = streaming.open_event_session(spark, 2)
    source, table, state = (str(tmp_path / name) for name in ("in", "table", "state"))
    typed = spark.createDataFrame([], schema).schema
    seen = []
    for n in range(3):
        part = rows[n::3]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        seen += part
        streaming.keep_open_events(streaming.read_arrivals(session, source, typed), table, state).awaitTermination()
        want = events.open_now(spark.createDataFrame(seen, schema))
        got = read_table(spark, table)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        assert got.where("MessageId = 'm3'").count() == int(not any(r[0] == "m3" and r[4] for r in seen) and any(r[0] == "m3" for r in seen))
    assert snapshot(spark, table).version == 2


OPEN_SCHEMA = "MessageId string, Device string, StartTime long, EndTime long, ConfirmedTime long"


def test_open_events_need_no_state_of_their_own_per_id(spark, tmp_path):
    """Ids are matched by joins; no function runs and no state store is asked once per id. A batch may have many files."""
    from anemos import streaming
    from anemos.sinks import read_table

    session = streaming.open_event_session(spark, 2)
    source, table, state = (str(tmp_path / name) for name in ("in", "table", "state"))
    first = spark.range(2000).selectExpr(
        "CAST(id AS STRING) AS MessageId", "'d' AS Device", "id AS StartTime", "IF(id % 2 = 0, id + 1, NULL) AS EndTime", "CAST(NULL AS BIGINT) AS ConfirmedTime")
    ends = first.where("StartTime % 3 = 0").withColumn("EndTime", F.col("StartTime") + 2)
    older = first.where("StartTime % 3 = 0").withColumn("EndTime", F.lit(None).cast("long"))
    for part in (first, ends, older):
        part.repartition(3).write.mode("append").parquet(source)
        query = streaming.keep_open_events(streaming.read_arrivals(session, source, part.schema), table, state)
        query.awaitTermination()
        assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [part.count()]
        assert not any(p["stateOperators"] for p in query.recentProgress)
    got = {int(row["MessageId"]) for row in read_table(spark, table).collect()}
    assert got == {n for n in range(2000) if n % 2 and n % 3}


def test_open_event_changes_are_found_without_python(spark):
    from anemos.streaming.open_events import open_event_changes

    rows = spark.createDataFrame([("a", "d", 1, None, None), ("b", "d", 1, None, None), ("c", "d", 2, 0, None), ("d", "d", 1, 9, None),
                                  ("e", "d", 1, 9, None), ("f", "d", 1, None, None), (None, "d", 1, None, None)], OPEN_SCHEMA)
    held = spark.createDataFrame([("a", "d", 1, None, None), ("b", "d", 1, None, 5), ("c", "d", 1, None, 7), ("d", "d", 1, None, None)], OPEN_SCHEMA)
    changes = open_event_changes(rows, held, spark.createDataFrame([("f",)], "MessageId string"))
    assert sorted((row["MessageId"], row["_ended"]) for row in changes.collect()) == [("c", False), ("d", True), ("e", True)]
    assert not any(word in changes._jdf.queryExecution().toString() for word in ("Python", "Pandas"))


def test_ended_events_are_forgotten(spark, tmp_path):
    """An end is known until a batch has come ``forget`` later; then an older message opens the event again."""
    from anemos.sinks import read_table
    from anemos.streaming.open_events import merge_messages

    table, ended = str(tmp_path / "table"), str(tmp_path / "ended")
    start = dt.datetime(2024, 1, 9, 22, 30)

    def come(number, hours, *rows):
        batch = spark.createDataFrame([(name, "d", 1, end, None) for name, end in rows], OPEN_SCHEMA)
        merge_messages(batch, table, ended, ("stream", number), start + dt.timedelta(hours=hours), 2 * 3_600_000)
        known = read_table(spark, ended)
        return ({row["MessageId"] for row in read_table(spark, table).collect()},
                sorted((row["MessageId"], (row["arrived"] - start) / dt.timedelta(hours=1)) for row in known.collect()))

    assert come(0, 0, ("a", None), ("b", 5)) == ({"a"}, [("b", 0)])
    assert come(1, 0.25, ("b", None), ("c", 5)) == ({"a"}, [("b", 0), ("c", 0.25)])
    assert come(2, 1, ("a", 5), ("b", 6)) == (set(), [("a", 1), ("b", 0), ("c", 0.25)])
    # What is due goes after the batch, and only that.
    assert come(3, 2, ("a", None), ("b", None)) == (set(), [("a", 1), ("c", 0.25)])
    assert come(4, 2.1, ("a", None), ("b", None), ("c", None)) == ({"b"}, [("a", 1), ("c", 0.25)])
    assert come(5, 9, ("c", None)) == ({"b"}, [])
    assert come(6, 9.1, ("a", None)) == ({"a", "b"}, [])
    assert come(7, 9.2, ("a", 7)) == ({"b"}, [("a", 9.2)])
    files = [path for path in (tmp_path / "ended").rglob("*.parquet")]
    assert len(files) == 1, "files that no entry names are deleted"


def test_batch_of_open_events_may_run_again(spark, tmp_path, monkeypatch):
    """A batch that failed between its two commits, and one that ran whole, leave the same when they run again."""
    from anemos.sinks import read_table, snapshot
    from anemos.streaming import open_events

    table, ended = str(tmp_path / "table"), str(tmp_path / "ended")
    now = dt.datetime(2024, 1, 9, 12)
    first = spark.createDataFrame([("a", "d", 1, None, None), ("b", "d", 1, None, None)], OPEN_SCHEMA)
    second = spark.createDataFrame([("a", "d", 1, 5, None), ("c", "d", 1, None, None)], OPEN_SCHEMA)
    open_events.merge_messages(first, table, ended, ("s", 0), now)
    with monkeypatch.context() as failing:
        failing.setattr(open_events, "_note_ended", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            open_events.merge_messages(second, table, ended, ("s", 1), now)
    for _ in range(2):
        open_events.merge_messages(second, table, ended, ("s", 1), now)
        assert [row["MessageId"] for row in read_table(spark, ended).collect()] == ["a"]
    open_events.merge_messages(first, table, ended, ("s", 2), now)
    assert sorted(row["MessageId"] for row in read_table(spark, table).collect()) == ["b", "c"]
    assert snapshot(spark, table).version == 1
