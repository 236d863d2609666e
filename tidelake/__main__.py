"""Jobs for ``spark-submit``:

    python -m tidelake --root <lake> --catalog <folder> ingest <batch.csv>
    python -m tidelake --root <lake> --catalog <folder> silver | gold | update | history | validate | compare | serve | health | clean
    python -m tidelake --root <lake> --catalog <folder> stream | vehicles --format kafka --source <servers>
"""

from __future__ import annotations

import argparse

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.operators import checks
from tidelake.plans import gold, integration, serving
from tidelake.plans.bronze import batch_summary
from tidelake.plans.lake import GOLD, Lake
from tidelake.session import build_session
from tidelake.sources import streams
from tidelake.streaming import alerts, jobs, store


def show(title: str, df: DataFrame, args: argparse.Namespace) -> None:
    """Write a report in full below ``--out``, and print its first ``--rows`` rows with the total."""
    if args.out:
        df.write.mode("overwrite").json(f"{args.out.rstrip('/')}/{title.replace(' ', '_')}")
    total = df.count()
    print(f"\n{title}: {min(total, args.rows)} of {total} rows")
    df.show(args.rows, truncate=False)


def now(args: argparse.Namespace) -> Column:
    return F.lit(args.as_of).cast("timestamp") if args.as_of else F.current_timestamp()


def ingest(lake: Lake, args: argparse.Namespace) -> None:
    key = lake.ingest(args.csv, landing=args.landing)
    print("skipped, already loaded" if key is None else f"loaded {key}")
    show("batches", batch_summary(lake.bronze(), first_seen="bronze_ingestion_ts"), args)


def history(lake: Lake, args: argparse.Namespace) -> None:
    """Loads, newest first."""
    loads = batch_summary(lake.bronze(), first_seen="bronze_ingestion_ts")
    show("loads", loads.orderBy(F.desc("first_ingested"), "source_file"), args)


def refresh_silver(lake: Lake, args: argparse.Namespace) -> None:
    print(lake.refresh_silver())
    show("batches", batch_summary(lake.silver(), distinct="line"), args)


def refresh_gold(lake: Lake, args: argparse.Namespace) -> None:
    print(lake.refresh_gold())
    volume, delays, shares = (lake.gold(n) for n in GOLD)
    show("busiest slots", gold.top_slots(volume), args)
    show("busiest stations", gold.station_rollup(volume), args)
    show("line A by month", gold.line_evolution(delays, "A"), args)
    show("services and rain", gold.season_rollup(delays), args)
    show("high demand", gold.top_demand(shares), args)
    show("thresholds", gold.threshold_rollup(shares), args)


def update_gold(lake: Lake, args: argparse.Namespace) -> None:
    """Aggregate states of new batches only; the merged tables."""
    print("updated", lake.update_gold(args.batch))
    show("busiest slots", gold.top_slots(lake.merged_gold(GOLD[0])), args)
    show("high demand", gold.top_demand(lake.merged_gold(GOLD[2])), args)
    show("lines, by sketches", lake.merged_gold("lineas_aproximado"), args)


def validate(lake: Lake, args: argparse.Namespace) -> None:
    """The catalog of the rail network: 49 stations, 57 stops, 6 transfer stations."""
    stops, stations = lake.stops(), lake.stations()
    # Accented names that a wrong encoding would break.
    names = [
        "Niquía", "Itagüí", "Alejandro Echavarría", "Trece de Noviembre", "Sena (Picacho)", "Sena (Ayacucho)",
        "Doce de Octubre",
    ]
    lines = checks.check_sequence(stops, "linea", "orden").select(
        F.concat(F.lit("orden:"), "linea").alias("check"),
        F.when(F.col("problem") == "none", "OK").otherwise("FAIL").alias("status"),
        F.col("problem").alias("observed"),
        F.lit("none").alias("expected"),
    )
    results = checks.report(
        [
            checks.check_count(stations, 49, "stations:count"),
            checks.check_count(stops, 57, "stops:count"),
            checks.check_count(stations.filter("es_transbordo"), 6, "stations:transfer"),
            checks.check_unique(stops, "stop_id", "stops:unique"),
            checks.check_unique(stations, "station_id", "stations:unique"),
            checks.check_fk(stops, stations, "station_id", "stops:station"),
            checks.check_fk(stations, stops, "station_id", "stations:stop"),
            checks.check_values(stations, "nombre", names, "stations:nombre"),
            lines,
        ]
    )
    show("catalog", results, args)
    show("totals", checks.report_totals(results), args)


def source(lake: Lake, args: argparse.Namespace) -> DataFrame:
    if args.format == "kafka":
        return streams.kafka_stream(lake.spark, args.source, args.topic, args.group, max_per_trigger=args.max_per_trigger)
    return streams.file_stream(lake.spark, args.source, args.format, files_per_trigger=args.max_per_trigger)


def stream(lake: Lake, args: argparse.Namespace) -> None:
    settings = jobs.StreamSettings(
        window=args.window, delay=args.delay, trigger={"availableNow": True} if args.once else None, log=True,
        merge_every=args.merge_every,
    )
    late = jobs.LateRows(lake.spark, f"{lake.ops}/late_rows")
    lake.spark.streams.addListener(late)
    queries = []
    try:
        queries = jobs.start_all(source(lake, args), lake.stops(), lake.stations(), lake.ops, settings)
        jobs.await_all(queries)
    finally:
        try:
            late.await_ended(queries)
        finally:
            lake.spark.streams.removeListener(late)


def vehicles(lake: Lake, args: argparse.Namespace) -> None:
    """Alerts of vehicles whose delay adds up, carried from micro-batch to micro-batch."""
    trigger = {"availableNow": True} if args.once else None
    query = alerts.start_edge_alerts(source(lake, args), lake.stops(), lake.ops, trigger, ttl=args.ttl, merge_every=args.merge_every)
    jobs.await_all([query])
    show("vehicle alerts", alerts.vehicle_alerts(lake.spark, lake.ops), args)


def clean(lake: Lake, args: argparse.Namespace) -> None:
    """Merge the micro-batches of the operational tables and leave expired rows behind; it may run beside the stream."""
    jobs.purge_all(lake.spark, lake.ops, now(args))
    show("rows", checks.row_counts(lake.operational()), args)


def compare(lake: Lake, args: argparse.Namespace) -> None:
    current = integration.current_readings(lake.operational(now(args))["station_occupancy"], now(args))
    past = integration.history_slot(lake.gold("estaciones_volumen"), now(args), zone=args.zone)
    ranking = integration.zscore_ranking(current, past)
    show("network", integration.zscore_context(current, past), args)
    show("moved most", integration.rank_delta(ranking), args)
    show("totals", integration.delta_counts(ranking), args)


def serve(lake: Lake, args: argparse.Namespace) -> None:
    found = lake.operational(now(args))
    rollup = serving.alert_rollup(found["station_alerts"], now(args))
    show("one station", jobs.station_state(lake.spark, lake.ops, args.station, now(args)), args)
    show("fullest stations", serving.top_occupancy(found["station_occupancy"]), args)
    show("critical lines", serving.critical_lines(found["line_delays"]), args)
    show("alerts of one station", serving.alert_rollup(found["station_alerts"], now(args), args.station), args)
    show("most alerts", serving.top_alerts(rollup), args)
    show("rows", checks.row_counts(found), args)
    show("late rows", jobs.late_rows(lake.spark, f"{lake.ops}/late_rows"), args)


def health(lake: Lake, args: argparse.Namespace) -> None:
    """State of every table; one that was never written is MISSING, and stays so."""
    spark, found = lake.spark, lake.operational(now(args))
    there = {name: found[name] if store.exists(spark, f"{lake.ops}/{name}") else None for name in found}
    fresh = [checks.check_fresh(there[name], "last_updated", 300, now(args), name, spark) for name in ("station_occupancy", "line_delays")]
    alerts = checks.check_exists(there["station_alerts"], "window_end", "station_alerts", spark).drop("n")
    show("freshness", checks.report([*fresh, alerts]), args)
    built = {n: lake.gold(n) for n in GOLD}
    results = [checks.check_nonempty({n: df for n, df in built.items() if df is not None})] if any(df is not None for df in built.values()) else []
    absent = [(f"nonempty:{n}", "MISSING", None, ">0") for n, df in built.items() if df is None]
    show("aggregates", checks.report([*results, spark.createDataFrame(absent, checks.CHECK_COLUMNS)]), args)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tidelake")
    top.add_argument("--root", required=True, help="shared folder of the lake")
    top.add_argument("--catalog", required=True, help="folder with the stop and station files")
    top.add_argument("--namespace", help="namespace of the catalog with a view of every refreshed table")
    top.add_argument("--as-of", help="instant to use as now, UTC")
    top.add_argument("--out", help="folder to which every report is written in full")
    top.add_argument("--rows", type=int, default=50, help="rows of a report that are printed, with the total")
    commands = top.add_subparsers(dest="command", required=True)
    load = commands.add_parser("ingest")
    load.add_argument("csv")
    load.add_argument("--landing", help="folder below which a file's path is its batch key")
    for name in ("history", "silver", "gold", "validate", "health", "clean"):
        commands.add_parser(name)
    commands.add_parser("serve").add_argument("--station", default="EST-015")
    commands.add_parser("compare").add_argument("--zone", help="local time zone of the service blocks")
    commands.add_parser("update").add_argument("--batch", help="key of one batch, e.g. one loaded again; else all without states")
    for name in ("stream", "vehicles"):
        live = commands.add_parser(name)
        live.add_argument("--format", default="kafka", choices=["kafka", "json", "parquet"])
        live.add_argument("--source", required=True, help="broker list or folder")
        live.add_argument("--topic", default=streams.TOPIC)
        live.add_argument("--group")
        live.add_argument("--max-per-trigger", type=int, help="messages (kafka) or files of a micro-batch at most")
        live.add_argument("--merge-every", type=int, default=100, help="micro-batches between merges of the tables; 0 leaves them to clean")
        live.add_argument("--once", action="store_true", help="stop when the source is read to its end")
        if name == "vehicles":
            live.add_argument("--ttl", default="24 hours", help="after this time without a move a vehicle starts from nothing")
        else:
            live.add_argument("--window", default="1 minute")
            live.add_argument("--delay", default="120 seconds")
    return top


JOBS = {
    "ingest": ingest, "history": history, "silver": refresh_silver, "gold": refresh_gold, "validate": validate,
    "update": update_gold, "stream": stream, "vehicles": vehicles, "compare": compare, "serve": serve, "health": health, "clean": clean,
}


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"tidelake-{args.command}")
    JOBS[args.command](Lake(spark, args.root.rstrip("/"), args.catalog.rstrip("/"), args.namespace), args)


if __name__ == "__main__":
    main()
