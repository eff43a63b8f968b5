"""Events that have not ended, kept current as messages arrive.

State is kept per message id: of an open event its newest message, which is its row in the table of open events, or, of an ended
one, only that it has ended, for as long as older messages of it may still come (``forget``). Ended ids are a table with a log in
the folder of the stream's checkpoint, by hour of arrival. What a batch changes is found by joins with both and goes into each
in one commit, which a batch that runs again does not repeat.
After each batch the table holds what :func:`anemos.operators.events.open_now` makes of all messages so far.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.buckets import naive
from ..operators.events import newest_messages, version
from ..session import materialize, scratch_scope
from ..sinks.snapshots import Snapshot, commit, open_files, remove_old_files, snapshot

HOUR = 3_600_000


def open_event_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session of its own for a stream of open events. Its state lies in tables, not in a store per partition,
    so it has as many partitions as batch jobs have."""
    from .arrivals import stream_session

    return stream_session(spark, state_partitions or int(spark.conf.get("spark.sql.shuffle.partitions")))


def open_event_changes(messages: DataFrame, opened: DataFrame | None, ended: DataFrame | None) -> DataFrame:
    """What messages change (MessageId, _ended, _row) in the events known to be open (rows of the table) and to have ended (MessageId).

    An event that has not been known to have ended changes if it has now, or if its newest message is newer than the known one.
    Messages without an id are left out.
    """
    changes = newest_messages(messages)
    if ended is not None:
        changes = changes.join(ended.select("MessageId"), "MessageId", "left_anti")
    if opened is not None:
        opened = opened.select(*messages.columns)
        before = opened.select("MessageId", version(opened).alias("_before"))
        changes = changes.join(before, "MessageId", "left").where("_ended OR _before IS NULL OR _version > _before")
    return changes.select("MessageId", "_ended", "_row")


def keep_open_events(messages: DataFrame, table: str, checkpoint: str, forget: int = 24 * HOUR) -> StreamingQuery:
    """Keep the table of open events current with a stream of messages (in :func:`open_event_session`), until the input present now is used up.

    ``forget`` is the time in milliseconds after which an ended event is no longer known, so that a still older message would open it again.
    """
    def merge(batch: DataFrame, number: int) -> None:
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        merge_messages(batch, table, f"{checkpoint}/ended", (checkpoint, number), now, forget)

    return (
        messages.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(merge).trigger(availableNow=True).start()
    )


def merge_messages(messages: DataFrame, table: str, ended: str, mark: tuple[str, int], now: dt.datetime, forget: int = 24 * HOUR) -> None:
    """Put one batch, arrived ``now``, into the table of open events and into that of ended ids.

    The open events are committed first: if the batch runs again after that, ends that were not yet noted are found once more.
    """
    spark = messages.sparkSession
    with scratch_scope(spark):
        state, past = snapshot(spark, table) or Snapshot(-1, messages.schema, (), None, {}, {}), snapshot(spark, ended)
        held = _rows(spark, table, state)
        changes = materialize(open_event_changes(messages, held, _rows(spark, ended, past)), "event-changes")
        if state.version < 0 or not changes.isEmpty():
            rows = changes.where("NOT _ended").select("_row.*")
            if held is not None:
                rows = held.join(changes.select("MessageId"), "MessageId", "left_anti").select(*messages.columns).unionByName(rows)
            commit(rows, table, replace="all", base=state, mark=mark)
        _note_ended(changes.where("_ended").select("MessageId"), ended, past, mark, now, forget)


def _rows(spark: SparkSession, path: str, state: Snapshot | None) -> DataFrame | None:
    """Rows of a state, or None if it has no files."""
    files = [file for part in state.files.values() for file in part] if state else []
    return open_files(spark, path, state, files) if files else None


def _note_ended(fresh: DataFrame, path: str, state: Snapshot | None, mark: tuple[str, int], now: dt.datetime, forget: int) -> None:
    """Add ids that ended ``now`` and forget those that arrived ``forget`` milliseconds ago or more.

    Only the hour that is added to and those with something to forget are written anew.
    """
    spark, bound = fresh.sparkSession, now - dt.timedelta(milliseconds=forget)
    files = state.files if state else {}
    oldest = bound.isoformat(sep=" ", timespec="microseconds")
    touched = [name for name, part in files.items() if any(file.low <= oldest for file in part)]
    if fresh.isEmpty():
        if not touched:
            return
    else:
        touched = sorted({*touched, f"dt={now:%Y-%m-%d}/hr={now.hour}"})
    rows = fresh.select("MessageId", naive(now).alias("arrived"))
    kept = [file for name in touched for file in files.get(name, [])]
    if kept:
        rows = open_files(spark, path, state, kept).select(*rows.columns).unionByName(rows)
    rows = rows.where(F.col("arrived") > naive(bound)).withColumns({"dt": F.to_date("arrived"), "hr": F.hour("arrived")})
    commit(rows.hint("rebalance", "dt", "hr"), path, "arrived", ["dt", "hr"], touched, state, mark)
    remove_old_files(spark, path)
