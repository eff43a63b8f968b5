"""Reader of event messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TEXT = ("MessageId", "FarmCode", "System", "Category", "Device", "DeviceType", "Part",
         "EventCode", "EventDesc", "RelevantId", "Confirmer", "Remark", "Attachment")
_MILLISECONDS = ("StartTime", "EndTime", "ConfirmedTime")
_NUMBERS = ("EventLevel", "FirstEvent", "Confirmed")
# The scalar fields of a message and their types.
FIELDS = {**dict.fromkeys(_TEXT, "string"), **dict.fromkeys(_MILLISECONDS, "bigint"), **dict.fromkeys(_NUMBERS, "int")}


def message_schema(depth: int) -> T.StructType:
    """An event message with related messages nested ``depth`` levels deep, for messages that are made by hand; what lies
    deeper is kept as text, which :func:`flatten_nested` refuses to drop."""
    fields = [T.StructField(name, T.StringType()) for name in _TEXT]
    fields += [T.StructField(name, T.LongType()) for name in _MILLISECONDS]
    fields += [T.StructField(name, T.IntegerType()) for name in _NUMBERS]
    below = T.ArrayType(message_schema(depth - 1)) if depth > 0 else T.StringType()
    fields.append(T.StructField("Relevant", below))
    return T.StructType(fields)


def read_messages(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Event messages from JSON lines or Parquet, with related messages nested to any depth.

    Of JSON the fields of a message are columns, and its related messages stay a Variant, which
    :func:`flatten_nested` unfolds as deep as it goes. A line that is no message has nulls throughout. Parquet has the depth of its schema.
    """
    if fmt != "json":
        return spark.read.format(fmt).load(path)
    lines = spark.read.text(path).select(F.try_parse_json("value").alias("_message"))
    return lines.select(*message_fields(F.col("_message")), related_messages(F.col("_message")).alias("Relevant"))


def message_fields(message: Column) -> list[Column]:
    """The scalar fields of a message that is a Variant; one of another type is null."""
    return [F.try_variant_get(message, f"$.{name}", kind).alias(name) for name, kind in FIELDS.items()]


def related_messages(message: Column) -> Column:
    """The related messages of a message that is a Variant, as one, null if it has none."""
    return F.try_variant_get(message, "$.Relevant", "variant")
