"""The stop catalog and its joins.

The catalog may be 57 rows or billions. It is broadcast after it was measured and
found small; otherwise trips get the number of their stop's attributes, and those follow from a
broadcast, as many stops share them. If stops and numbers are small, they are broadcast too; otherwise
the joins sort and merge narrow rows, and adaptive execution splits a dominant stop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.operators.sizing import RepeatedKeyError, is_small
from tidelake.schemas import ROLE_ATTRIBUTES


def build_stop_dim(stops: DataFrame, stations: DataFrame) -> DataFrame:
    """Stops with the attributes of their station; a stop without a station is left out."""
    return stops.join(stations, "station_id")


def as_role(dim: DataFrame, role: str, *shared: str) -> DataFrame:
    """The catalog seen in one role: every attribute gets the role as suffix, ``shared`` ones do not."""
    renamed = [F.col(a).alias(f"{a}_{role}") for a in ROLE_ATTRIBUTES]
    return dim.select(F.col("stop_id").alias(f"_stop_{role}"), *renamed, *shared)


def join_role(trips: DataFrame, dim: DataFrame, role: str, *shared: str, small: bool = False) -> DataFrame:
    view = as_role(dim, role, *shared)
    view = F.broadcast(view) if small else view
    return trips.join(view, F.col(f"stop_id_{role}") == F.col(f"_stop_{role}"), "left").drop(f"_stop_{role}")


def kinds_of(dim: DataFrame, key: str, attributes: list[str]) -> tuple[DataFrame, DataFrame] | None:
    """Keys with the hash of their attributes, and the attributes of each hash; None if those are not few, or two share a hash."""
    kind = F.xxhash64(*attributes, *[F.col(a).isNull() for a in attributes]).alias("_kind")
    kinds = dim.select(kind, *attributes).distinct()
    try:
        return (dim.select(key, kind), kinds) if is_small(kinds, key="_kind") else None
    except RepeatedKeyError:
        return None


def _join_place(trips: DataFrame, view: DataFrame, role: str, small: bool) -> DataFrame:
    """The view of a role by its stop id. Where trips are shuffled for that, those without a stop do not meet in one task."""
    stop, known = F.col(f"stop_id_{role}"), F.col(f"_stop_{role}")
    if small:
        return trips.join(F.broadcast(view), stop == known, "left").drop(f"_stop_{role}")
    nobody = F.concat(F.lit("-"), F.xxhash64("trip_id", "stop_id_origen", "stop_id_destino", "passenger_count").cast("string"))
    left = F.when(stop.isNotNull(), F.concat(F.lit("+"), stop)).otherwise(nobody)
    return trips.join(view, left == F.concat(F.lit("+"), known), "left").drop(f"_stop_{role}")


def enrich_trips(trips: DataFrame, dim: DataFrame) -> DataFrame:
    """Origin and destination attributes from the same catalog; unknown stops stay, with NULLs.

    The service type comes from the origin stop only: both ends lie on one line. A stop that the catalog has twice is an error.
    """
    shared = ["tipo_servicio"]
    used = dim.select("stop_id", *ROLE_ATTRIBUTES, *shared)
    if is_small(used, key="stop_id"):
        return join_role(join_role(trips, used, "origen", *shared, small=True), used, "destino", small=True)
    found = kinds_of(used, "stop_id", [*ROLE_ATTRIBUTES, *shared])
    if found is None:
        joined = _join_place(trips, as_role(used, "origen", *shared), "origen", False)
        return _join_place(joined, as_role(used, "destino"), "destino", False)
    places, kinds = found
    small = is_small(places)
    joined = trips
    for role in ("origen", "destino"):
        view = places.select(F.col("stop_id").alias(f"_stop_{role}"), F.col("_kind").alias(f"_kind_{role}"))
        joined = _join_place(joined, view, role, small)
    for role, also in (("origen", shared), ("destino", [])):
        view = kinds.select(F.col("_kind").alias("_known"), *[F.col(a).alias(f"{a}_{role}") for a in ROLE_ATTRIBUTES], *also)
        joined = joined.join(F.broadcast(view), F.col(f"_kind_{role}") == F.col("_known"), "left").drop("_known", f"_kind_{role}")
    return joined


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of ``child`` whose key is missing in ``parent`` (a NULL key is missing too).

    Either side may be facts, so neither is measured: distinct parent keys are combined inside their tasks, and the
    join is left to adaptive execution, which broadcasts what turns out small.
    """
    return child.join(parent.select(key).distinct(), key, "left_anti")


def transfer_stations(stations: DataFrame) -> DataFrame:
    return stations.filter("es_transbordo").orderBy("station_id")


def lines_per_station(stops: DataFrame, stations: DataFrame | None = None) -> DataFrame:
    """Sorted lines of every station, in one join and one aggregate."""
    if stations is not None:
        stops = stops.join(stations.select("station_id", "nombre"), "station_id")
    keys = ["station_id"] + (["nombre"] if stations is not None else [])
    return stops.groupBy(*keys).agg(F.array_sort(F.collect_set("linea")).alias("lines"))


def terminal_stops(stops: DataFrame) -> DataFrame:
    """Stops that are first or last on their line.

    A line's limits are one row; adaptive execution broadcasts them or splits a dominant line.
    """
    ends = stops.groupBy(F.col("linea").alias("_line")).agg(
        F.min("orden").alias("_first"), F.max("orden").alias("_last")
    )
    return (
        stops.join(ends, F.col("linea") == F.col("_line"))
        .filter((F.col("orden") == F.col("_first")) | (F.col("orden") == F.col("_last")))
        .select("stop_id", "linea", "orden")
    )


def sample_rows(df: DataFrame, n: int, *order_by: str | Column) -> DataFrame:
    """The first ``n`` rows in an order, so that the sample is the same every time."""
    return df.orderBy(*order_by).limit(n)


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()
