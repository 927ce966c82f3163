"""Event messages: parse, enrich, and split off what cannot be used."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewinds import schemas
from tradewinds.functions import labels
from tradewinds.functions.dates import iso_utc

# An ISO-8601 date, with or without time, fraction and zone.
_ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:\d{2})?)?$"


def read_events(messages: DataFrame) -> DataFrame:
    """Enriched events of the messages in `value` (text or UTF-8 bytes).

    `reason` is null for a usable event and says otherwise why it is not.
    """
    text = F.col("value").cast("string")
    # Generated as a row, the message is parsed once; as plain columns, the parsing
    # would be repeated in every filter and column that uses a field.
    parsed = messages.select(
        text.alias("value"),
        F.inline(F.array(F.struct(
            F.from_json(text, schemas.EVENT).alias("e"),
            # Tells a missing field from one that is null or of a wrong type.
            F.from_json(text, "map<string,string>").alias("given"),
        ))),
    ).select("value", "given", "e.*")

    def has(name: str) -> Column:
        return F.coalesce(F.map_contains_key("given", F.lit(name)), F.lit(False))

    stamp = F.when(F.col("event_timestamp").rlike(_ISO), F.col("event_timestamp"))
    event_ts = F.try_to_timestamp(stamp)
    reason = (
        F.when(F.col("given").isNull() | (F.size(F.coalesce("given", F.create_map())) == 0), "not a JSON object")
        .when(has("payment_value") & F.col("payment_value").isNull(), "bad payment_value")
        .when(event_ts.isNull(), "bad event_timestamp")
        .when(F.col("event_type").isNull(), "no event_type")
    )
    def metadata(name: str) -> Column:
        return (
            F.when(~has("metadata"), F.lit(""))
            .when(F.col("metadata").isNull(), F.lit(None).cast("string"))
            .when(F.map_contains_key("metadata", F.lit(name)), F.try_element_at("metadata", F.lit(name)))
            .otherwise(F.lit(""))
        )

    # The hour as the sender wrote it, not as it is in UTC.
    hour = F.coalesce(F.substring(stamp, 12, 2).try_cast("int"), F.lit(0))
    return parsed.select(
        "value",
        "event_id",
        "event_type",
        "order_id",
        "customer_id",
        "product_id",
        "order_status",
        "payment_value",
        "event_timestamp",
        event_ts.alias("event_ts"),
        F.current_timestamp().alias("processing_ts"),
        labels.event_value(F.col("payment_value")).alias("value_category"),
        labels.part_of_day(hour).alias("time_of_day"),
        metadata("source").alias("metadata_source"),
        metadata("version").alias("metadata_version"),
        reason.alias("reason"),
    )


def usable(events: DataFrame) -> DataFrame:
    return events.where(F.col("reason").isNull()).drop("reason", "value")


def rejected(events: DataFrame) -> DataFrame:
    """Messages that cannot be used, with the reason."""
    return events.where(F.col("reason").isNotNull()).select("value", "reason")


def once(events: DataFrame, redelivery: str) -> DataFrame:
    """Events without repeats of a message that came within `redelivery` of its first arrival.

    A bus that delivers at least once may repeat messages. A usable event is told by its id (by its text
    where it has none), another message by its text, so that a damaged message hides no whole one. On a
    stream the state holds the keys of that span of arrivals.
    """
    same = F.concat_ws(":", F.col("reason").isNull().cast("string"), F.when(F.col("reason").isNull(), F.col("event_id")))
    keyed = events.withColumn("message_key", F.sha2(F.concat(same, F.lit("|"), F.when(
        F.col("reason").isNull() & F.col("event_id").isNotNull(), F.lit("")).otherwise(F.coalesce("value", F.lit("")))), 256))
    if events.isStreaming:
        kept = keyed.withWatermark("processing_ts", redelivery).dropDuplicatesWithinWatermark(["message_key"])
    else:
        kept = keyed.dropDuplicates(["message_key"])
    return kept.drop("message_key")


def event_rows(events: DataFrame) -> DataFrame:
    """The flat event table; times are ISO text, as its readers expect."""
    return events.select(
        "event_id",
        "event_type",
        "order_id",
        "customer_id",
        "product_id",
        "order_status",
        "payment_value",
        "event_timestamp",
        iso_utc(F.col("processing_ts")).alias("processing_timestamp"),
        "value_category",
        "time_of_day",
        "metadata_source",
        "metadata_version",
    )
