"""Clean layer: validated trips with both stops looked up and six derived columns."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidelake import schemas
from tidelake.functions import calendar, trips
from tidelake.operators.dimensions import enrich_trips
from tidelake.operators.sizing import broadcast_if_small
from tidelake.operators.rules import Rule, accounting, keep_clean, observe_discards
from tidelake.sources import refreshed

# Accepted ranges.
PASSENGERS = (1, 400)
DELAY_SECONDS = (0, 1200)

KEYS = ["trip_id", "stop_id_origen", "stop_id_destino", "line"]


def _outside(column: str, bounds: tuple[int, int]) -> Column:
    return ~F.col(column).between(*bounds)


def trip_rules() -> list[Rule]:
    """Rules on the trip alone, in order. A NULL measure is discarded, but under its own reason."""
    no_key = reduce(or_, [F.col(key).isNull() for key in KEYS])
    return [
        Rule("null_key", no_key, 0),
        Rule("passenger_range", _outside("passenger_count", PASSENGERS), 1),
        Rule("delay_range", _outside("delay_seconds", DELAY_SECONDS), 2),
        Rule("circular", F.col("stop_id_origen") == F.col("stop_id_destino"), 3, upstream=True),
    ]


def catalog_rules(origin: str = "nombre_origen", destination: str = "nombre_destino") -> list[Rule]:
    """Rules on the looked-up stops; a trip unknown at both ends counts under both."""
    return [
        Rule("orphan_origin", F.col(origin).isNull(), 4, upstream=True),
        Rule("orphan_dest", F.col(destination).isNull(), 4, upstream=True),
    ]


def derive(joined: DataFrame) -> DataFrame:
    origin, destination = F.col("orden_origen"), F.col("orden_destino")
    return joined.withColumns(
        {
            "n_stops": trips.n_stops(origin, destination),
            "trip_direction": trips.trip_direction(origin, destination),
            "time_of_day": calendar.time_of_day(F.col("hour_block")),
            "is_peak_hour": calendar.is_peak(F.col("hour_block")),
            "is_transfer_trip": trips.is_transfer(F.col("es_transbordo_origen"), F.col("es_transbordo_destino")),
            "delay_category": trips.delay_category(F.col("delay_seconds")),
        }
    )


def build_silver(
    bronze: DataFrame,
    dim: DataFrame,
    as_of: Column | str | None = None,
    observed: tuple[Observation, Observation] | None = None,
) -> DataFrame:
    """Trips that pass all rules. Bad trips leave before the joins, so they are never shuffled.

    With ``observed`` the discards before and after the joins are counted on the
    way, which costs no second pass.
    """
    if observed:
        clean = observe_discards(bronze, trip_rules(), observed[0])
        known = observe_discards(enrich_trips(clean, dim), catalog_rules(), observed[1])
    else:
        known = keep_clean(enrich_trips(keep_clean(bronze, trip_rules()), dim), catalog_rules())
    stamped = derive(known).withColumn("silver_ingestion_ts", trips.audit_ts(as_of))
    return stamped.select(*schemas.SILVER_COLUMNS)


def discard_accounting(bronze: DataFrame, dim: DataFrame) -> DataFrame:
    """Exact discards per reason, read from one pass over the trips.

    Only the known stop ids take part in the joins, not their attributes.
    """
    known = broadcast_if_small(dim.select("stop_id", "nombre"), key="stop_id")
    joined = bronze
    for role in ("origen", "destino"):
        view = known.select(F.col("stop_id").alias(f"_stop_{role}"), F.col("nombre").alias(f"nombre_{role}"))
        joined = joined.join(view, F.col(f"stop_id_{role}") == F.col(f"_stop_{role}"), "left")
    return accounting(joined, [*trip_rules(), *catalog_rules()])


def refresh_silver(path: str, bronze: DataFrame, dim: DataFrame, as_of: Column | str | None = None) -> dict:
    """Full refresh of the clean table; returns the discards seen on the way. A refresh that dies leaves the rows before it."""
    before, after = Observation(), Observation()
    refreshed.replace(build_silver(bronze, dim, as_of, (before, after)), path)
    unmatched = {k: v for k, v in after.get.items() if k in ("orphan_origin", "orphan_dest")}
    return {**before.get, **unmatched}
