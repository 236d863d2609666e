"""From message bodies to typed, timed and enriched events. Works on streams and on tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions.events import event_time
from tidelake.operators.dimensions import kinds_of
from tidelake.operators.sizing import is_small

INVALID = "_invalid"

TEXT_FIELDS = {
    "event_id": "",
    "event_type": INVALID,
    "stop_id": "",
    "line": "",
    "vehicle_id": "",
    "timestamp": "",
}
NUMBER_FIELDS = ["passenger_count", "delay_seconds"]


# What JSON allows before the opening brace.
JSON_SPACE = " \t\n\r"


def _field(name: str, kind: str, default: str | int) -> Column:
    """A field of the body as ``kind``; the default where it is absent, NULL where it does not convert."""
    path = f"$.{name}"
    absent = F.try_variant_get("_body", path, "variant").isNull()
    return F.coalesce(F.try_variant_get("_body", path, kind), F.when(absent, F.lit(default)))


def parse_events(raw: DataFrame) -> DataFrame:
    """``value, timestamp`` records to events.

    Absent fields take their default. A body that is not a JSON object, or a
    number that cannot be read as one (a JSON null included), makes the whole
    record invalid. ``source_ts`` keeps the time of the record.

    The fields pass through a one-element ``inline``: the optimizer copies plain
    column expressions into every later filter and use, which would parse each
    body many times over and outgrow the code generator. A generator's output it
    leaves alone.
    """
    is_object = F.ltrim("value", F.lit(JSON_SPACE)).startswith("{")
    bodies = raw.select(F.when(is_object, F.try_parse_json("value")).alias("_body"), F.col("timestamp").alias("source_ts"))
    text = {name: _field(name, "string", default) for name, default in TEXT_FIELDS.items()}
    numbers = {name: _field(name, "int", 0) for name in NUMBER_FIELDS}
    record = F.struct(F.col("_body").isNotNull().alias("_object"), *[c.alias(n) for n, c in {**text, **numbers}.items()])
    fields = bodies.select("source_ts", F.inline(F.array(record)))

    readable = F.col("_object")
    for name in NUMBER_FIELDS:
        readable = readable & F.col(name).isNotNull()
    order = ["event_id", "event_type", "stop_id", "line", "vehicle_id", *NUMBER_FIELDS, "timestamp"]
    blank = {**TEXT_FIELDS, **dict.fromkeys(NUMBER_FIELDS, 0)}
    return fields.select(
        *[F.when(readable, F.col(n)).otherwise(F.lit(blank[n])).alias(n) for n in order],
        "source_ts",
    )


def valid_events(events: DataFrame) -> DataFrame:
    """Drop invalid records; an explicit NULL event type is not one of them."""
    return events.filter(F.col("event_type").isNull() | (F.col("event_type") != INVALID))


def timed_events(raw: DataFrame, delay: str | None = None) -> DataFrame:
    """Valid events with ``event_time``, and on streams a watermark ``delay`` behind the newest."""
    events = valid_events(parse_events(raw))
    timed = events.withColumn("event_time", event_time(F.col("timestamp"), F.col("source_ts"))).drop("source_ts")
    return timed.withWatermark("event_time", delay) if delay else timed


def enrich_events(events: DataFrame, stops: DataFrame, stations: DataFrame, salts: int = 16) -> DataFrame:
    """Add ``station_id`` and ``stop_name``; an unknown stop stands for itself, and one that the catalog has twice is an error.

    A catalog measured small, as it is joined, is broadcast. Beyond that events get the hash of their stop's station and name, which
    follow from a broadcast, as many stops share them. If stops and hashes are not small either, the join must shuffle, and
    streaming joins get no adaptive skew handling: ``salts`` then spreads each
    stop's events over that many tasks and repeats the catalog as often.
    """
    names = stations.select("station_id", "nombre")
    catalog = stops.select("stop_id", "station_id").join(names, "station_id", "left")
    view = catalog.select(
        F.col("stop_id").alias("_stop"),
        F.col("station_id").alias("_station"),
        F.coalesce("nombre", "station_id").alias("_name"),
    )
    match = F.col("stop_id") == F.col("_stop")
    small = is_small(view, key="_stop")
    found = None if small else kinds_of(view, "_stop", ["_station", "_name"])
    if found:
        view = found[0]
        small = is_small(view)
    if small:
        view = F.broadcast(view)
    elif salts > 1:
        events = events.withColumn("_salt", F.pmod(F.xxhash64("event_id", "vehicle_id", "event_time"), F.lit(salts)))
        copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))
        view = view.withColumn("_copy", copies)
        match = match & (F.col("_salt") == F.col("_copy"))
    joined = events.join(view, match, "left")
    if found:
        kinds = found[1].withColumnRenamed("_kind", "_known")
        joined = joined.join(F.broadcast(kinds), F.col("_kind") == F.col("_known"), "left").drop("_kind", "_known")
    return joined.withColumns(
        {"station_id": F.coalesce("_station", "stop_id"), "stop_name": F.coalesce("_name", "stop_id")}
    ).drop("_stop", "_station", "_name", "_salt", "_copy")
