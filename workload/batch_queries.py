"""Batch queries: raw, clean and aggregate layers, catalog checks, versioned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions import calendar
from tidelake.functions.trips import audit_ts, by_code, tagged
from tidelake.operators import checks, dimensions, inspect
from tidelake.operators.ordering import number_rows, rank_all
from tidelake.operators.rules import reject_reason
from tidelake.plans import bronze as bronze_plan
from tidelake.plans import gold, incremental, silver
from tidelake.session import scratch, settle
from tidelake.sources import files, loads, namespaces, refreshed, tables
from workload import adapters


def wall_clock(df: DataFrame) -> DataFrame:
    """Times without zone, load times left out: what both engines can compare."""
    clocks = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    drop = [c for c in df.columns if c in ("silver_ingestion_ts", "gold_ingestion_ts", "last_updated")]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in clocks}).drop(*drop)


def stop_dim(spark: SparkSession, sf: str) -> DataFrame:
    return dimensions.build_stop_dim(adapters.stops(spark, sf), adapters.stations(spark, sf))


def clean_trips(spark: SparkSession, sf: str) -> DataFrame:
    return silver.build_silver(adapters.bronze(spark, sf), stop_dim(spark, sf))


def volume(spark: SparkSession, sf: str) -> DataFrame:
    return gold.station_volume(clean_trips(spark, sf))


def delays(spark: SparkSession, sf: str) -> DataFrame:
    return gold.line_month_delay(clean_trips(spark, sf))


def shares(spark: SparkSession, sf: str) -> DataFrame:
    return gold.high_demand_share(clean_trips(spark, sf))


# -- clean layer ------------------------------------------------------------


def silver_clean(spark: SparkSession, sf: str) -> DataFrame:
    return wall_clock(clean_trips(spark, sf))


def discard_accounting(spark: SparkSession, sf: str) -> DataFrame:
    return silver.discard_accounting(adapters.bronze(spark, sf), stop_dim(spark, sf))


def reject_reasons(spark: SparkSession, sf: str) -> DataFrame:
    """First failing rule on the trip itself, by batch."""
    marked = adapters.bronze(spark, sf).withColumn("reason", reject_reason(silver.trip_rules()))
    return marked.groupBy("source_file", "reason").agg(F.count(F.lit(1)).alias("trips"))


def role_playing_join(spark: SparkSession, sf: str) -> DataFrame:
    """Trips with both ends looked up, unknown ends kept."""
    joined = dimensions.enrich_trips(adapters.trips(spark, sf), stop_dim(spark, sf))
    return joined.groupBy("nombre_origen", "nombre_destino", "tipo_servicio").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("passenger_count").alias("passengers")
    )


def dim_build(spark: SparkSession, sf: str) -> DataFrame:
    return stop_dim(spark, sf)


def batch_summary(spark: SparkSession, sf: str) -> DataFrame:
    return wall_clock(
        bronze_plan.batch_summary(adapters.bronze(spark, sf), distinct="line", first_seen="bronze_ingestion_ts")
    )


def missing_keys(spark: SparkSession, sf: str) -> DataFrame:
    return bronze_plan.missing_trip_ids(adapters.trips(spark, sf))


def sample_trips(spark: SparkSession, sf: str) -> DataFrame:
    trips = clean_trips(spark, sf).select(
        "trip_id", "line", "tipo_servicio", "nombre_origen", "nombre_destino", "n_stops", "trip_direction",
        "time_of_day", "is_peak_hour", "is_transfer_trip", "delay_category", "passenger_count", "delay_seconds",
    )
    return dimensions.sample_rows(trips, 10, *trips.columns)


# -- aggregate layer --------------------------------------------------------


def station_volume(spark: SparkSession, sf: str) -> DataFrame:
    return wall_clock(volume(spark, sf))


def line_month_delay(spark: SparkSession, sf: str) -> DataFrame:
    return wall_clock(delays(spark, sf))


def line_p90(spark: SparkSession, sf: str) -> DataFrame:
    return gold.line_thresholds(clean_trips(spark, sf))


def high_demand_share(spark: SparkSession, sf: str) -> DataFrame:
    return wall_clock(shares(spark, sf))


def service_season_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return gold.season_rollup(delays(spark, sf))


def line_threshold_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return gold.threshold_rollup(shares(spark, sf))


def station_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return gold.station_rollup(volume(spark, sf))


def top_station_slots(spark: SparkSession, sf: str) -> DataFrame:
    return gold.top_slots(volume(spark, sf))


def top_demand_slots(spark: SparkSession, sf: str) -> DataFrame:
    return gold.top_demand(shares(spark, sf))


def line_evolution(spark: SparkSession, sf: str) -> DataFrame:
    return gold.line_evolution(delays(spark, sf), "AF")


# -- calendar ---------------------------------------------------------------


def calendar_enrich(spark: SparkSession, sf: str) -> DataFrame:
    """Every calendar expression on the event times, with the 2024 holiday list."""
    events = adapters.table(spark, sf, "events").withColumn("trip_date", F.col("ts").cast("date"))
    marked = calendar.with_holiday(events, calendar.holiday_calendar(spark))
    dow, block = F.dayofweek("trip_date"), calendar.hour_block(F.col("ts"))
    return marked.select(
        "event_id",
        block.alias("hour_block"),
        calendar.time_of_day(block).alias("time_of_day"),
        calendar.is_peak(block).alias("is_peak_hour"),
        F.year("trip_date").alias("year"),
        F.month("trip_date").alias("month"),
        calendar.month_name(F.month("trip_date")).alias("month_name"),
        calendar.is_rainy(F.month("trip_date")).alias("is_rainy_month"),
        calendar.iso_dow(F.col("trip_date")).alias("day_of_week_num"),
        calendar.day_name(dow).alias("day_name"),
        calendar.is_weekend(dow).alias("is_weekend"),
        "is_holiday",
    )


# -- catalog checks ---------------------------------------------------------


def orphan_stops(spark: SparkSession, sf: str) -> DataFrame:
    """Trips ending at a stop the catalog does not have, per stop."""
    trips = adapters.trips(spark, sf).filter(F.col("stop_id_destino").isNotNull())
    lost = dimensions.orphans(
        trips.withColumnRenamed("stop_id_destino", "stop_id"), adapters.stops(spark, sf), "stop_id"
    )
    return lost.groupBy("stop_id").agg(F.count(F.lit(1)).alias("trips"))


def childless_parents(spark: SparkSession, sf: str) -> DataFrame:
    """Customers without any event."""
    customers = adapters.table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), "c_name")
    return dimensions.orphans(customers, adapters.table(spark, sf, "events"), "user_id")


def lines_per_station(spark: SparkSession, sf: str) -> DataFrame:
    lines = dimensions.lines_per_station(adapters.stops(spark, sf), adapters.stations(spark, sf))
    return lines.select(
        "station_id",
        "nombre",
        F.array_join("lines", ",").alias("lines"),
        (F.size("lines") > 1).alias("multimodal"),
    )


def terminal_stops(spark: SparkSession, sf: str) -> DataFrame:
    return dimensions.terminal_stops(adapters.stops(spark, sf))


def transfer_stations(spark: SparkSession, sf: str) -> DataFrame:
    return dimensions.transfer_stations(adapters.stations(spark, sf))


def distinct_lines(spark: SparkSession, sf: str) -> DataFrame:
    return dimensions.distinct_values(adapters.trips(spark, sf), "line", "hour_block")


def sequence_check(spark: SparkSession, sf: str) -> DataFrame:
    """Do an order's line numbers run 1..n?"""
    items = adapters.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return checks.check_sequence(items, "l_orderkey", "l_linenumber")


def sequence_offenders(spark: SparkSession, sf: str) -> DataFrame:
    items = adapters.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return checks.sequence_offenders(items, "l_orderkey", "l_linenumber")


def catalog_checks(spark: SparkSession, sf: str) -> DataFrame:
    stops, stations = adapters.stops(spark, sf), adapters.stations(spark, sf)
    orders, customers = adapters.table(spark, sf, "orders"), adapters.table(spark, sf, "customer")
    order_keys = orders.select(F.col("o_custkey").alias("key"))
    return checks.report(
        [
            checks.check_types(stations, {"latitud": ("double",), "es_transbordo": ("boolean",)}, "stations"),
            checks.check_types(stops, {"orden": ("int", "bigint")}, "stops"),
            checks.check_count(stations, 25, "stations:count"),
            checks.check_count(stations.filter("es_transbordo"), 10, "stations:transfer"),
            checks.check_fk(stops, stations, "station_id", "stops:station"),
            checks.check_fk(stations, stops, "station_id", "stations:stop"),
            checks.check_fk(
                order_keys, customers.filter("c_acctbal >= 0").select(F.col("c_custkey").alias("key")), "key",
                "orders:customer",
            ),
            checks.check_values(stations, "nombre", ["NATION_0", "NATION_24", "NATION_25"], "stations:nombre"),
            checks.check_nonempty({"orders": orders, "customer": customers}),
        ]
    )


def table_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    return checks.row_counts({n: adapters.table(spark, sf, n) for n in adapters.TABLES})


def catalog_files(spark: SparkSession, sf: str) -> DataFrame:
    """The catalog exported as CSV and read back, with its schema and with inferred types."""
    root = scratch(spark, "catalog")
    adapters.stops(spark, sf).write.option("header", "true").csv(f"{root}/paradas.csv")
    adapters.stations(spark, sf).write.option("header", "true").csv(f"{root}/estaciones.csv")
    stops, stations = files.read_stops(spark, f"{root}/paradas.csv"), files.read_stations(spark, f"{root}/estaciones.csv")
    inferred = files.read_csv(spark, f"{root}/estaciones.csv")
    typed = checks.check_types(
        inferred, {"station_id": ("string",), "latitud": ("double",), "es_transbordo": ("boolean",), "nombre": ("int",)}, "inferred"
    )
    per_station = stops.join(stations, "station_id").groupBy("station_id", "nombre").agg(
        F.count(F.lit(1)).alias("n"), F.sum("orden").alias("orden"), F.max("latitud").alias("latitud")
    )
    rows = per_station.select(
        F.concat("station_id", F.lit(" "), "nombre").alias("check"), F.lit("read").alias("status"),
        F.concat_ws(" ", F.col("n").cast("string"), F.col("orden").cast("string")).alias("observed"), F.col("latitud").cast("string").alias("expected"),
    )
    return checks.report([typed, rows])


def freshness_states(spark: SparkSession, sf: str) -> DataFrame:
    """Every state that a table can be in."""
    orders = adapters.table(spark, sf, "orders").select(F.col("o_orderdate").cast("timestamp").alias("at"), "o_orderstatus")
    newest = orders.agg(F.max("at")).scalar()
    absent = scratch(spark, "absent")
    found = tables.read(spark, absent) if tables.exists(spark, absent) else None
    blank = orders.withColumn("at", F.lit(None).cast("timestamp"))
    reports = checks.report(
        [
            checks.check_fresh(orders, "at", 60, newest, "fresh"),
            checks.check_fresh(orders, "at", 60, newest + F.expr("INTERVAL 1 HOUR"), "stale"),
            checks.check_fresh(orders.filter("o_orderstatus = '-'"), "at", 60, newest, "empty"),
            checks.check_fresh(blank, "at", 60, newest, "no_time"),
            checks.check_fresh(found, "at", 60, newest, "missing", spark),
            checks.check_exists(orders, "at", "present").drop("n"),
            checks.check_exists(orders.filter("o_orderstatus = '-'"), "at", "vacant").drop("n"),
            checks.check_exists(found, "at", "gone", spark).drop("n"),
        ]
    )
    return wall_clock(reports)


def busiest_in_order(spark: SparkSession, sf: str) -> DataFrame:
    """The busiest slots with the place at which each came out."""
    top = gold.top_slots(volume(spark, sf))
    return top.select((F.monotonically_increasing_id() + 1).alias("place"), "*")


# -- stored tables ----------------------------------------------------------

#: Times of the loads of ``_orders_by_status``.
LOADED_AT = [f"2024-01-01 00:00:00.00{n}" for n in range(1, 10)]


def _orders_by_status(spark: SparkSession, sf: str) -> DataFrame:
    """All orders as a growing table: a load per status in order, a millisecond apart."""
    orders, path = adapters.table(spark, sf, "orders"), scratch(spark, "orders")
    status = F.coalesce("o_orderstatus", F.lit("none"))
    statuses = sorted(r[0] for r in orders.select(status).distinct().collect())
    for name, at in zip(statuses, LOADED_AT[: len(statuses)], strict=True):
        tables.put_batch(orders.filter(status == name).withColumn("loaded_at", audit_ts(at)), path, f"orders_{name}")
    return tables.read(spark, path)


def _by_priority(orders: DataFrame) -> DataFrame:
    return orders.groupBy("o_orderpriority", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_orders"), F.max("o_orderdate").alias("last_order")
    )


def as_of_version(spark: SparkSession, sf: str) -> DataFrame:
    """The table as its first two loads left it."""
    return _by_priority(loads.as_of_load(_orders_by_status(spark, sf), 2, "loaded_at"))


def as_of_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    """The table as it stood at an instant."""
    return _by_priority(loads.as_of_time(_orders_by_status(spark, sf), LOADED_AT[0], "loaded_at"))


def as_of_daily_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per date after the first load."""
    first = loads.as_of_load(_orders_by_status(spark, sf), 1, "loaded_at")
    return loads.counts_by(first, F.col("o_orderdate").cast("date"))


def version_delta(spark: SparkSession, sf: str) -> DataFrame:
    """Rows after the first and after the third load."""
    return loads.delta(_orders_by_status(spark, sf), 1, 3, "loaded_at")


def snapshot_history(spark: SparkSession, sf: str) -> DataFrame:
    """What each load added, and the total after it."""
    return wall_clock(loads.history(_orders_by_status(spark, sf), "loaded_at"))


def _evolving(spark: SparkSession, sf: str) -> str:
    """A table whose second batch has one column more."""
    orders, path = adapters.table(spark, sf, "orders"), scratch(spark, "evolving")
    first = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    tables.put_batch(orders.filter(first), path, "before")
    weather = by_code(
        F.col("o_orderpriority"), {"1-URGENT": "Lluvioso", "2-HIGH": "Tormenta", "3-MEDIUM": "Nublado"}, "Soleado"
    )
    later = orders.filter(~first).withColumns(
        {"o_orderpriority": tagged("WX-", F.col("o_orderpriority")), "weather_condition": weather}
    )
    tables.put_batch(later, path, "after")
    return path


def schema_evolution(spark: SparkSession, sf: str) -> DataFrame:
    """A column added between two batches: NULL before, filled after, nothing rewritten."""
    rows = tables.read(spark, _evolving(spark, sf), merge=True)
    return rows.groupBy("o_orderpriority", "weather_condition").agg(F.count(F.lit(1)).alias("n"))


def column_diff(spark: SparkSession, sf: str) -> DataFrame:
    """What the later schema has and the earlier one has not."""
    path = _evolving(spark, sf)
    older = tables.read(spark, f"{path}/{tables.BATCH}=before").withColumn("o_orderkey", F.col("o_orderkey").cast("string"))
    return tables.schema_diff(older, tables.read(spark, f"{path}/{tables.BATCH}=after"))


def full_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Replaced content, beside a copy of what it replaced."""
    orders, path, copy = adapters.table(spark, sf, "orders"), scratch(spark, "refreshed"), scratch(spark, "copy")
    first = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    refreshed.replace(orders.filter(first), path)
    refreshed.replace(refreshed.read(spark, path), copy)
    refreshed.replace(orders.filter(~first), path)
    now = refreshed.read(spark, path).select(F.lit("now").alias("version"), "o_orderstatus")
    then = refreshed.read(spark, copy).select(F.lit("before").alias("version"), "o_orderstatus")
    return now.unionByName(then).groupBy("version", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


def idempotent_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Trips exported as two CSV batches and loaded, one of them twice."""
    root = scratch(spark, "ingest")
    trips = adapters.trips(spark, sf)
    closed = F.coalesce(F.col("line").endswith("F"), F.lit(False))
    for name, part in (("closed", closed), ("open", ~closed)):
        trips.filter(part).write.option("header", "true").csv(f"{root}/in/trips_{name}.csv")
    for name in ("closed", "open", "closed"):
        bronze_plan.ingest_trips(spark, f"{root}/bronze", f"{root}/in/trips_{name}.csv", landing=f"{root}/in")
    return bronze_plan.read_bronze(spark, f"{root}/bronze").groupBy("line", "source_file").agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum("passenger_count").alias("passengers"),
        F.sum("delay_seconds").alias("delay_seconds"),
        F.count_if("is_holiday").alias("holiday_trips"),
        F.max("trip_date").alias("last_date"),
    )


def _loaded_trips(spark: SparkSession, sf: str) -> DataFrame:
    """Raw trips as the ingest of three CSV batches left them, with batch and load time."""
    root, trips = scratch(spark, "loaded"), adapters.trips(spark, sf)
    line = F.coalesce("line", F.lit(""))
    parts = {"closed": line.endswith("F"), "returned": line == "RO", "open": ~line.endswith("F") & (line != "RO")}
    for (name, part), at in zip(parts.items(), LOADED_AT, strict=False):
        trips.filter(part).write.option("header", "true").csv(f"{root}/in/{name}.csv")
        bronze_plan.ingest_trips(spark, f"{root}/bronze", f"{root}/in/{name}.csv", as_of=at, landing=f"{root}/in")
    return tables.read(spark, f"{root}/bronze")


def namespace_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Two tables of a namespace as the catalog lists and describes them, with their rows; both are dropped again."""
    name = f"lake_{scratch(spark, 'ns')[-12:]}"
    namespaces.ensure_namespace(spark, name)
    for table in ("nation", "region"):
        path = scratch(spark, table)
        adapters.table(spark, sf, table).write.parquet(path)
        spark.sql(f"CREATE TABLE {name}.{table} USING parquet LOCATION '{path}'")
    found = []
    for row in namespaces.list_tables(spark, name).collect():
        full = f"{name}.{row.tableName}"
        counted = spark.table(full).agg(F.count(F.lit(1)).alias("n"))
        columns = namespaces.describe(spark, full).select(F.lit(row.tableName).alias("table"), "col_name", "data_type")
        found.append(settle(columns.withColumn("n", F.lit(counted.first()["n"]).cast("bigint"))))
        namespaces.drop_table(spark, full)
    namespaces.drop_namespace(spark, name)
    return checks.report(found)


def access_paths(spark: SparkSession, sf: str) -> DataFrame:
    """What a read of one batch, one status and two columns touches: the plan's filters and columns, and the rows it finds."""
    path = scratch(spark, "access")
    orders = adapters.table(spark, sf, "orders")
    for status in ("F", "O"):
        tables.put_batch(orders.filter(F.col("o_orderstatus") == status), path, status)
    found = incremental.one_batch(spark, path, "F").filter("o_orderpriority = '2-HIGH'").groupBy("o_orderpriority").agg(F.sum("o_custkey").alias("keys"))
    plan = inspect.plan_summary(found)
    pushed = any("EqualTo(o_orderpriority,2-HIGH)" in f for f in plan["pushed_filters"])
    partition = any("= F" in f for f in plan["partition_filters"])
    return found.select("keys", F.lit(pushed).alias("pushed"), F.lit(partition).alias("one_partition"), F.lit(plan["read_schema"][0]).alias("columns"))


def load_history(spark: SparkSession, sf: str) -> DataFrame:
    """What each ingested file added."""
    return wall_clock(loads.history(_loaded_trips(spark, sf), "bronze_ingestion_ts"))


def load_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """Trips per day as the raw table stood before its last load."""
    before = loads.as_of_time(_loaded_trips(spark, sf), LOADED_AT[1], "bronze_ingestion_ts")
    return loads.counts_by(before, F.col("trip_date"))


def _updated_states(spark: SparkSession, sf: str) -> str:
    """Folder of the clean trips and the aggregate states of two batches, one of which was loaded before with other trips and is loaded again."""
    root, trips, dim = scratch(spark, "states"), adapters.bronze(spark, sf), stop_dim(spark, sf)
    first = F.coalesce(F.col("source_file").endswith("S1"), F.lit(False))
    for key, part in (("late", first), ("early", first), ("late", ~first)):
        tables.put_batch(trips.filter(part), f"{root}/bronze", key)
        batch = bronze_plan.read_batch(spark, f"{root}/bronze", key)
        incremental.update_batch(batch, dim, key, f"{root}/clean", f"{root}/states")
    return root


def _merged(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return wall_clock(incremental.merged_table(spark, f"{_updated_states(spark, sf)}/states", name))


def merged_volume(spark: SparkSession, sf: str) -> DataFrame:
    """``station_volume`` from states per batch."""
    return _merged(spark, sf, "estaciones_volumen")


def merged_delays(spark: SparkSession, sf: str) -> DataFrame:
    """``line_month_delay`` from states per batch."""
    return _merged(spark, sf, "retraso_por_linea_mes")


def merged_demand(spark: SparkSession, sf: str) -> DataFrame:
    """``high_demand_share`` from states per batch."""
    return _merged(spark, sf, "demanda_rutas")


def merged_sketches(spark: SparkSession, sf: str) -> DataFrame:
    """Per line: is the sketched threshold within the ranks that its error allows, are the distinct counts within 3 %?"""
    root = _updated_states(spark, sf)
    about = incremental.merged_table(spark, f"{root}/states", "lineas_aproximado")
    trips = tables.read(spark, f"{root}/clean")
    counts = gold.value_counts(trips, ["line"], "passenger_count").withColumnRenamed("line", "_line")
    low, high = (gold.HIGH_DEMAND_QUANTILE + d for d in (-0.02, 0.02))
    ranks = gold.with_percentile(gold.with_percentile(counts, "_line", "passenger_count", low, "low"), "_line", "passenger_count", high, "high")
    bounds = ranks.groupBy("_line").agg(F.max("low").alias("low"), F.max("high").alias("high"))
    exact = trips.groupBy(F.col("line").alias("_exact")).agg(F.count_distinct("stop_id_origen").alias("o"), F.count_distinct("trip_id").alias("t"))
    joined = about.join(bounds, F.col("line") == F.col("_line")).join(exact, F.col("line") == F.col("_exact"))
    return joined.select(
        "line", "trips", F.col("p90_about").between(F.col("low"), F.col("high")).alias("threshold_within"),
        (F.abs(F.col("origins_about") - F.col("o")) <= F.col("o") * 0.03).alias("origins_within"),
        (F.abs(F.col("trip_ids_about") - F.col("t")) <= F.col("t") * 0.03).alias("trip_ids_within"),
    )


def slot_ranking(spark: SparkSession, sf: str) -> DataFrame:
    """Every station slot with its place in the whole network and its rank among the slots of its block, by load."""
    loads_first = volume(spark, sf).select("station_id", "hour_block", "day_of_week_num", (-F.col("avg_passengers")).alias("_load"))
    placed = number_rows(loads_first, [], ["_load", "station_id", "hour_block", "day_of_week_num"], "place")
    ranked = rank_all(placed, ["hour_block"], ["_load"], "rank_in_block")
    return ranked.select("station_id", "hour_block", "day_of_week_num", (-F.col("_load")).alias("avg_passengers"), (F.col("place") + 1).alias("place"), "rank_in_block")


def lakehouse_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Raw to clean to aggregate through stored tables."""
    root = scratch(spark, "lakehouse")
    tables.put_batch(adapters.bronze(spark, sf), f"{root}/bronze", "all")
    silver.refresh_silver(f"{root}/silver", bronze_plan.read_bronze(spark, f"{root}/bronze"), stop_dim(spark, sf))
    gold.write_gold(f"{root}/gold", gold.line_month_delay(refreshed.read(spark, f"{root}/silver")))
    return wall_clock(refreshed.read(spark, f"{root}/gold"))


QUERIES = {
    f.__name__: f
    for f in [
        silver_clean, discard_accounting, reject_reasons, role_playing_join, dim_build, batch_summary, missing_keys,
        sample_trips, station_volume, line_month_delay, line_p90, high_demand_share, service_season_rollup,
        line_threshold_rollup, station_rollup, top_station_slots, top_demand_slots, line_evolution, calendar_enrich,
        orphan_stops, childless_parents, lines_per_station, terminal_stops, transfer_stations, distinct_lines,
        sequence_check, sequence_offenders, catalog_checks, table_row_counts, catalog_files, freshness_states,
        busiest_in_order, column_diff, as_of_version, as_of_timestamp,
        as_of_daily_counts, version_delta, snapshot_history, schema_evolution, full_refresh, idempotent_ingest,
        lakehouse_refresh, namespace_tables, access_paths, load_history, load_as_of, merged_volume, merged_delays, merged_demand, merged_sketches, slot_ranking,
    ]
}
