"""Input schemas and the column order of every derived table."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "binary": T.BinaryType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
    "map<string,string>": T.MapType(T.StringType(), T.StringType()),
}


def struct(spec: str) -> T.StructType:
    """``"name type, name type"`` as a schema; unlike the DDL parser it needs no session."""
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in (part.split() for part in spec.split(", "))])


# Fixed values from here on: names, types and order of the columns of all files and tables.
STOPS = struct("stop_id string, station_id string, linea string, orden int, tipo_servicio string")

STATIONS = struct(
    "station_id string, nombre string, latitud double, longitud double, municipio string, es_transbordo boolean"
)

TRIPS_CSV = struct(
    "trip_id string, stop_id_origen string, stop_id_destino string, line string, passenger_count int, "
    "delay_seconds int, trip_date date, hour_block string, is_holiday boolean, source_file string, "
    "ingestion_ts timestamp"
)

# The raw table: the CSV columns with their descriptions, plus the load time.
TRIP_COMMENTS = {
    "trip_id": "trip identifier (not unique by contract)",
    "stop_id_origen": "boarding stop",
    "stop_id_destino": "alighting stop",
    "line": "line code",
    "passenger_count": "passengers on the trip",
    "delay_seconds": "reported delay in seconds",
    "trip_date": "service date",
    "hour_block": "service hour block, e.g. 06-09",
    "is_holiday": "service date is a public holiday",
    "source_file": "batch the row came from",
    "ingestion_ts": "when the batch was produced",
    "bronze_ingestion_ts": "when the row was loaded",
}
BRONZE_TRIPS = T.StructType(
    [
        T.StructField(f.name, f.dataType, True, {"comment": TRIP_COMMENTS[f.name]})
        for f in [*TRIPS_CSV.fields, T.StructField("bronze_ingestion_ts", T.TimestampType())]
    ]
)

# Attributes a stop contributes to a trip, once per role (origin, destination).
ROLE_ATTRIBUTES = ["station_id", "nombre", "municipio", "latitud", "longitud", "orden", "es_transbordo"]

SILVER_COLUMNS = [
    *BRONZE_TRIPS.names,
    *[f"{a}_origen" for a in ROLE_ATTRIBUTES],
    *[f"{a}_destino" for a in ROLE_ATTRIBUTES],
    "tipo_servicio",
    "n_stops",
    "trip_direction",
    "time_of_day",
    "is_peak_hour",
    "is_transfer_trip",
    "delay_category",
    "silver_ingestion_ts",
]

STATION_VOLUME_COLUMNS = [
    "station_id",
    "nombre_estacion",
    "municipio",
    "hour_block",
    "time_of_day",
    "day_of_week_num",
    "day_name",
    "is_weekend",
    "total_trips",
    "total_passengers",
    "avg_passengers",
    "max_passengers",
    "avg_delay_seconds",
    "gold_ingestion_ts",
]

LINE_MONTH_DELAY_COLUMNS = [
    "line",
    "tipo_servicio",
    "year",
    "month",
    "month_name",
    "is_rainy_month",
    "total_trips",
    "total_holiday_trips",
    "avg_delay_seconds",
    "avg_delay_peak",
    "avg_delay_offpeak",
    "avg_delay_holiday",
    "avg_delay_nonholiday",
    "gold_ingestion_ts",
]

HIGH_DEMAND_COLUMNS = [
    "line",
    "tipo_servicio",
    "hour_block",
    "time_of_day",
    "total_trips",
    "high_demand_trips",
    "pct_high_demand",
    "avg_passengers",
    "p90_line_threshold",
    "max_passengers",
    "gold_ingestion_ts",
]

# Stream records: the message body and the time the source received it.
RAW_STREAM = struct("value string, timestamp timestamp")

EVENTS = struct(
    "event_id string, event_type string, stop_id string, line string, vehicle_id string, "
    "passenger_count int, delay_seconds int, timestamp string, event_time timestamp"
)

STATION_OCCUPANCY = struct(
    "station_id string, stop_name string, lines_serving array<string>, window_start timestamp, "
    "window_end timestamp, max_vehicle_occupancy int, avg_vehicle_occupancy double, event_count bigint, "
    "last_updated timestamp"
)

LINE_DELAYS = struct(
    "line string, tipo_servicio string, window_start timestamp, window_end timestamp, "
    "avg_delay_seconds double, max_delay_seconds int, vehicles_seen bigint, vehicles_delayed bigint, "
    "high_delay boolean, last_updated timestamp"
)

STATION_ALERTS = struct(
    "station_id string, stop_name string, line string, window_start timestamp, window_end timestamp, "
    "delay_alerts bigint, capacity_alerts bigint, total_alerts bigint"
)

# Document rules of the operational tables: fields that must be filled and the
# type families each field may have.
_NUMBER = ("int", "double")
_COUNT = ("int", "bigint")
DOCUMENT_RULES = {
    "station_occupancy": {
        "required": ["station_id", "window_end", "last_updated"],
        "types": {
            "station_id": ("string",),
            "stop_name": ("string",),
            "lines_serving": ("array<string>",),
            "window_start": ("timestamp",),
            "window_end": ("timestamp",),
            "max_vehicle_occupancy": _NUMBER,
            "avg_vehicle_occupancy": _NUMBER,
            "event_count": _COUNT,
            "last_updated": ("timestamp",),
        },
    },
    "line_delays": {
        "required": ["line", "window_end", "last_updated"],
        "types": {
            "line": ("string",),
            "tipo_servicio": ("string",),
            "window_start": ("timestamp",),
            "window_end": ("timestamp",),
            "avg_delay_seconds": _NUMBER,
            "max_delay_seconds": _NUMBER,
            "vehicles_seen": _COUNT,
            "vehicles_delayed": _COUNT,
            "high_delay": ("boolean",),
            "last_updated": ("timestamp",),
        },
    },
    "station_alerts": {
        "required": ["station_id", "window_end"],
        "types": {
            "station_id": ("string",),
            "stop_name": ("string",),
            "line": ("string",),
            "window_start": ("timestamp",),
            "window_end": ("timestamp",),
            "delay_alerts": _COUNT,
            "capacity_alerts": _COUNT,
            "total_alerts": _COUNT,
        },
    },
}

# Seconds a row of an operational table stays valid, and the column that ages.
RETENTION = {
    "station_occupancy": ("last_updated", 600),
    "line_delays": ("last_updated", 900),
    "station_alerts": ("window_end", 3600),
}
