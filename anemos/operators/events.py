"""Event messages: filter, page, flatten, decode."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.buckets import naive
from ..functions.levels import confirmed_text, first_text, level_text
from ..functions.text import time_text
from ..session import materialize, small_table

# The scalar fields of an event, in export order.
EVENT_FIELDS = (
    "MessageId", "FarmCode", "System", "Category", "Device", "DeviceType", "Part",
    "StartTime", "EndTime", "EventLevel", "EventLevelStr", "EventCode", "EventDesc",
    "FirstEvent", "FirstEventStr", "RelevantId", "Confirmed", "ConfirmedStr", "Confirmer",
    "ConfirmedTime", "ConfirmedTimeStr", "Remark", "Attachment",
)
_TIMES = ("StartTime", "EndTime", "ConfirmedTime")
ORDERS = {"asc": F.asc, "desc": F.desc}

@dataclass(frozen=True)
class EventQuery:
    """What to export. Empty lists and ``None`` ask for everything.

    ``devices`` lists (farm, device names) entries; an empty list of names stands
    for the whole farm. The range holds ``start`` but not ``end``.
    """

    system: str | None = None
    category: str | None = None
    devices: Sequence[tuple[str, Sequence[str]]] = field(default_factory=tuple)
    levels: Sequence[int] = field(default_factory=tuple)
    first: int | None = None
    confirmed: int | None = None
    start: dt.datetime | None = None
    end: dt.datetime | None = None
    page: int = 1
    page_size: int | None = None
    order: str = "asc"


def _moment(events: DataFrame, name: str) -> Column:
    """A time of an event, which messages hold in milliseconds since 1970."""
    column = F.col(name)
    if isinstance(events.schema[name].dataType, T.IntegralType):
        column = F.timestamp_millis(column)
    return column.cast("timestamp_ntz")


def _bound(events: DataFrame, moment: dt.datetime) -> Column:
    """A range bound in the unit of ``StartTime``, so that it reaches the scan."""
    if isinstance(events.schema["StartTime"].dataType, T.IntegralType):
        return F.lit(int(moment.replace(tzinfo=dt.timezone.utc).timestamp() * 1000))
    return naive(moment)


def filter_events(events: DataFrame, query: EventQuery) -> DataFrame:
    """Events that meet all conditions of the query; the page is not applied."""
    wanted = F.lit(True)
    for name, value in (("System", query.system), ("Category", query.category),
                        ("FirstEvent", query.first), ("Confirmed", query.confirmed)):
        if value is not None:
            wanted = wanted & (F.col(name) == value)
    if query.devices:
        wanted = wanted & F.col("FarmCode").isin(*dict.fromkeys(farm for farm, _ in query.devices))
    if query.levels:
        wanted = wanted & F.col("EventLevel").isin(*query.levels)
    if query.start is not None:
        wanted = wanted & (F.col("StartTime") >= _bound(events, query.start))
    if query.end is not None:
        wanted = wanted & (F.col("StartTime") < _bound(events, query.end))
    events = events.where(wanted)
    if not query.devices:
        return events
    rows = [(farm, device) for farm, names in query.devices for device in (names or [None])]
    entries = small_table(events.sparkSession, rows, "farm string, device string")
    same = (events["FarmCode"] == entries["farm"]) & (
        entries["device"].isNull() | (events["Device"] == entries["device"])
    )
    return events.join(entries, same, "left_semi")


def open_events(events: DataFrame, query: EventQuery) -> DataFrame:
    """Events that have not ended, of all farms of the query in one scan."""
    never = naive(dt.datetime(1970, 1, 1))
    return filter_events(events, query).where(F.coalesce(_moment(events, "EndTime"), never) == never)


def ended(events: DataFrame) -> Column:
    """Whether a message says that its event has ended."""
    return F.coalesce(_moment(events, "EndTime") != naive(dt.datetime(1970, 1, 1)), F.lit(False))


def version(events: DataFrame) -> Column:
    """A text that is greater for a newer message of an event: by start, by confirmation, then by all that it says."""
    times = [F.lpad(F.coalesce(F.unix_millis(_moment(events, name).cast("timestamp")), F.lit(0)).cast("string"), 20, "0")
             for name in ("StartTime", "ConfirmedTime")]
    return F.concat(*times, F.to_json(F.struct(*events.columns)))


def newest_messages(messages: DataFrame) -> DataFrame:
    """Per event whether a message says that it has ended (``_ended``), and of its other messages the newest (``_row``) with its
    version. Messages without an id are left out."""
    over = ended(messages)
    rows = messages.where("MessageId IS NOT NULL").select(
        "MessageId", over.alias("_ended"), F.when(~over, version(messages)).alias("_version"), F.when(~over, F.struct(*messages.columns)).alias("_row"))
    return rows.groupBy("MessageId").agg(
        F.max("_ended").alias("_ended"), F.max("_version").alias("_version"), F.max_by("_row", "_version").alias("_row"))


def open_now(messages: DataFrame) -> DataFrame:
    """The newest message of each event of which no message says that it has ended. Messages without an id are left out."""
    return newest_messages(messages).where("NOT _ended").select("_row.*")


Counts = Callable[[str, "list[dt.datetime | None] | None"], list[tuple["dt.datetime | None", int]]]


def page_of(events: DataFrame, page: int, size: int, order: str = "asc", counts_of: Counts | None = None) -> DataFrame:
    """One page in order of start time and message id.

    Events are counted per day and then, in the days that the page touches, per
    minute. The page is then a top-k among the minutes it lies in, however late it
    is; no task holds the events before it. The counts are run when the page is asked for, over the events, or are
    those that ``counts_of`` has, given the unit (DAY or MINUTE) and the days to count in (None for all).
    """
    if order not in ORDERS:
        raise ValueError(f"order must be one of {', '.join(ORDERS)}")
    if page < 1 or size < 1:
        raise ValueError("page and page size start at 1")
    direction = ORDERS[order]
    skipped = (page - 1) * size
    keys = [direction("StartTime"), direction("MessageId")]
    found, touched = events, None
    for unit in ("DAY", "MINUTE"):
        at = F.date_trunc(unit, _moment(events, "StartTime")).cast("timestamp_ntz")
        if counts_of is not None:
            counts = counts_of(unit, touched)
        else:
            counts = [(row["at"], row["n"]) for row in found.groupBy(at.alias("at")).agg(F.count(F.lit(1)).alias("n")).collect()]
        # Spark puts null times first in ascending order and last in descending order.
        counts.sort(key=lambda row: (row[0] is not None, row[0] or dt.datetime.min), reverse=order == "desc")
        touched, before = [], 0
        for moment, n in counts:
            if before < skipped + size and before + n > skipped:
                if not touched:
                    first = before
                touched.append(moment)
            before += n
        if not touched:
            return events.where(F.lit(False))
        skipped -= first
        within = F.lit(False)
        times = [moment for moment in touched if moment is not None]
        if times:
            step = dt.timedelta(days=1) if unit == "DAY" else dt.timedelta(minutes=1)
            within = (F.col("StartTime") >= _bound(events, min(times))) & (F.col("StartTime") < _bound(events, max(times) + step))
        if len(times) < len(touched):
            within = within | F.col("StartTime").isNull()
        found = found.where(within)
    return found.orderBy(*keys).offset(skipped).limit(size)


def filtered(query: EventQuery) -> EventQuery:
    """The conditions of a query without its page."""
    return replace(query, page=1, page_size=None)


def history(events: DataFrame, query: EventQuery) -> DataFrame:
    """Filtered events in order, one page of them if a page size is given."""
    found = filter_events(events, query)
    if query.page_size is not None:
        return page_of(found, query.page, query.page_size, query.order)
    if query.order not in ORDERS:
        raise ValueError(f"order must be one of {', '.join(ORDERS)}")
    direction = ORDERS[query.order]
    return found.orderBy(direction("StartTime"), direction("MessageId"))


def history_total(events: DataFrame, query: EventQuery) -> DataFrame:
    """The number of events the pages of a query are cut from."""
    return filter_events(events, query).agg(F.count(F.lit(1)).alias("total"))


def decode(events: DataFrame) -> DataFrame:
    """Messages as events: millisecond times as timestamps, level and flags as text.

    The confirmation time as text is empty unless the event is confirmed.
    """
    events = events.withColumns({name: _moment(events, name) for name in _TIMES if name in events.columns})
    confirmed = F.when(F.col("Confirmed") == 1, time_text(F.col("ConfirmedTime"))).otherwise("")
    return events.withColumns({
        "EventLevelStr": level_text(F.col("EventLevel")),
        "FirstEventStr": first_text(F.col("FirstEvent")),
        "ConfirmedStr": confirmed_text(F.col("Confirmed")),
        "ConfirmedTimeStr": confirmed,
    })


def flatten_nested(messages: DataFrame, children: str = "Relevant") -> DataFrame:
    """Nested messages as rows, each parent before its related events.

    Adds ``root_id``, ``depth`` and ``position`` (place within the message). Related events that are a
    Variant are unfolded to any depth (:func:`flatten_variant`). Otherwise the nesting is as deep as the schema: one
    generator per row and no shuffle; where the schema keeps the related events of its last level as text, text there is an error.
    """
    if isinstance(messages.schema[children].dataType, T.VariantType):
        return flatten_variant(messages, children)

    def related(data_type: T.StructType) -> T.StructType | None:
        if children not in data_type.fieldNames() or isinstance(data_type[children].dataType, T.StringType):
            return None
        return data_type[children].dataType.elementType

    names = [name for name in messages.columns if name != children]

    def unfold(message, data_type: T.StructType, depth: int) -> Column:
        values = [
            (message[name] if name in data_type.fieldNames() else F.lit(None))
            .cast(messages.schema[name].dataType).alias(name)
            for name in names
        ]
        own = F.array(F.struct(F.lit(depth).alias("depth"), *values))
        below = related(data_type)
        if below is None:
            if children not in data_type.fieldNames():
                return own
            nothing = F.coalesce(message[children], F.lit("[]")).isin("[]", "null", "")
            deeper = F.raise_error(F.lit("messages are nested deeper than the schema; read them with a larger depth"))
            return F.when(nothing, own).otherwise(deeper)
        rows = F.flatten(F.transform(message[children], lambda child: unfold(child, below, depth + 1)))
        return F.concat(own, F.coalesce(rows, F.slice(own, 1, 0)))

    whole = F.struct(*messages.columns)
    listed = messages.select(
        F.col("MessageId").alias("root_id"), F.posexplode(unfold(whole, messages.schema, 0)).alias("position", "_event")
    )
    return listed.select("root_id", "position", "_event.*")


# Levels of related events that one round of :func:`flatten_variant` unfolds.
LEVELS_A_ROUND = 4


def flatten_variant(messages: DataFrame, children: str = "Relevant") -> DataFrame:
    """Messages whose related events are a Variant (an array of messages) as rows, however deep, as :func:`flatten_nested` does.

    Rounds unfold some levels each, within a row and without a shuffle, and write what they found, so a lost executor repeats one
    round; only messages that go deeper take part in the next. ``position`` follows from the places
    on the way down, and is numbered within each message at the end. What is no array of messages is no related event.
    """
    names = [name for name in messages.columns if name != children]
    types = {name: messages.schema[name].dataType.simpleString() for name in names}

    def below(message: Column) -> Column:
        return F.coalesce(F.try_variant_get(message, "$", "array<variant>"), F.array().cast("array<variant>"))

    def unfold(related: Column, path: Column, levels: int) -> Column:
        def one(message: Column, at: Column) -> Column:
            here = F.concat(path, F.array(at))
            inner = F.try_variant_get(message, f"$.{children}", "variant")
            last = levels == 1
            own = F.array(F.struct(
                here.alias("path"), message.alias("message"), (inner if last else F.lit(None).cast("variant")).alias("deeper")))
            return own if last else F.concat(own, unfold(inner, here, levels - 1))

        return F.flatten(F.transform(below(related), one))

    keyed = materialize(messages.withColumn("_row", F.monotonically_increasing_id()), "event-messages")
    top = keyed.select("_row", F.array().cast("array<int>").alias("path"), *names)
    parts = [top]
    # Messages at the top have their fields as columns, those below are Variants.
    left = keyed.where(F.col(children).isNotNull()).select("_row", F.array().cast("array<int>").alias("path"), F.col(children).alias("deeper"))
    while True:
        found = left.select("_row", F.explode(unfold(F.col("deeper"), F.col("path"), LEVELS_A_ROUND)).alias("_found"))
        fields = [F.try_variant_get("_found.message", f"$.{name}", types[name]).alias(name) for name in names]
        found = materialize(found.select("_row", "_found.path", *fields, "_found.deeper"), "event-levels")
        if found.isEmpty():
            break
        parts.append(found.drop("deeper"))
        left = found.where(F.col("deeper").isNotNull() & (F.size(below(F.col("deeper"))) > 0)).select("_row", "path", "deeper")
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    # A parent's path begins those of its related events, so it sorts before them.
    order = Window.partitionBy("_row").orderBy("path")
    first = F.first("MessageId").over(order)
    return rows.select(
        first.alias("root_id"), (F.row_number().over(order) - 1).alias("position"), F.size("path").alias("depth"), *names)


def flatten_by_parent(events: DataFrame) -> DataFrame:
    """Events that name their parent in ``RelevantId``, with root, depth and path.

    ``path`` lists the ids from the root down; sorting by it puts each parent
    before its related events. An event whose parent is unknown is a root.

    Every event keeps the path up to its farthest known ancestor. In each round
    it is joined to that ancestor and takes over its path, which doubles the
    reach, so a few equi-joins do for any depth. Only events still on their way
    take part; each round is written out, so a lost executor repeats one round.
    Events related in a circle are an error: an id returns in its own path. An
    event delivered more than once counts once.
    """
    events = events.dropDuplicates(["MessageId"])
    ancestor = F.nullif(F.col("RelevantId"), F.lit(""))
    climbing = materialize(
        events.select("MessageId", ancestor.alias("ancestor"), F.array("MessageId").alias("path")), "event-paths"
    )
    arrived = [climbing.where(F.col("ancestor").isNull())]
    climbing = climbing.where(F.col("ancestor").isNotNull())
    while not climbing.isEmpty():
        if not climbing.where(F.size(F.array_distinct("path")) < F.size("path")).isEmpty():
            raise ValueError("events are related in a circle")
        known = climbing
        for part in arrived:
            known = known.unionByName(part)
        known = known.select(
            F.col("MessageId").alias("_id"), F.col("ancestor").alias("_next"), F.col("path").alias("_path")
        )
        moved = materialize(
            climbing.join(known, F.col("ancestor") == F.col("_id"), "left").select(
                "MessageId", F.col("_next").alias("ancestor"),
                F.concat(F.coalesce("_path", F.slice("path", 1, 0)), "path").alias("path"),
            ),
            "event-paths",
        )
        arrived.append(moved.where(F.col("ancestor").isNull()))
        climbing = moved.where(F.col("ancestor").isNotNull())
    paths = arrived[0]
    for part in arrived[1:]:
        paths = paths.unionByName(part)
    return events.join(paths.select(
        "MessageId", F.get("path", F.lit(0)).alias("root_id"), (F.size("path") - 1).alias("depth"), "path"
    ), "MessageId")


def select_fields(events: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """The scalar fields of events, or those asked for, in export order."""
    wanted = EVENT_FIELDS if fields is None else fields
    return events.select(*[name for name in wanted if name in events.columns])


def check_columns(columns: Sequence[Mapping[str, str]]) -> None:
    """Export columns need a field and a title."""
    for column in columns:
        if not column.get("field"):
            raise ValueError("an export column needs a 'field'")
        if not column.get("title"):
            raise ValueError(f"the export column for {column['field']!r} needs a 'title'")
