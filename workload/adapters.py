"""The driver's tables seen as transport data.

A stop is a customer in good standing (non-negative balance) on the line of its
market segment, a station is a nation, a municipality a region. A trip is a
line item with its order: from the stop numbered like the supplier to the
ordering customer's. Orders of unspecified priority have no destination, and a
discount of zero stands for a delay that was not reported. An event's JSON
message is built from the ``events`` row; customers with a negative balance are
stops missing in the catalog.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions.calendar import HOUR_BLOCKS
from tidelake.session import prepare

TRANSFER_REGIONS = ["ASIA", "EUROPE"]
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark",
    "labels", "conversations",
]
EVENT_LINES = ["A", "B", "TA", "K", "J", "P", "H", "M", "L"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _numbered(prefix: str, key: str) -> Column:
    return F.concat(F.lit(prefix), F.col(key).cast("string"))


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        _numbered("EST-", "n_nationkey").alias("station_id"),
        F.col("n_name").alias("nombre"),
        (F.col("n_nationkey") / 4).alias("latitud"),
        (F.col("n_regionkey") / 4).alias("longitud"),
        F.col("r_name").alias("municipio"),
        F.col("r_name").isin(TRANSFER_REGIONS).alias("es_transbordo"),
    )


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    service = F.when(segment.isin("AUTOMOBILE", "BUILDING"), "metro").when(segment == "FURNITURE", "tranvia")
    return (
        table(spark, sf_dir, "customer")
        .filter("c_acctbal >= 0")
        .select(
            _numbered("P-", "c_custkey").alias("stop_id"),
            _numbered("EST-", "c_nationkey").alias("station_id"),
            segment.alias("linea"),
            (F.col("c_nationkey") + 1).alias("orden"),
            service.otherwise("cable").alias("tipo_servicio"),
        )
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    item, order = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    day = F.col("l_shipdate").cast("date")
    half = F.when(F.month(day) <= 6, "S1").otherwise("S2")
    blocks = F.array(*[F.lit(b) for b in HOUR_BLOCKS])
    return item.join(order, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("trip_id"),
        _numbered("P-", "l_suppkey").alias("stop_id_origen"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", _numbered("P-", "o_custkey")).alias("stop_id_destino"),
        F.concat("l_returnflag", "l_linestatus").alias("line"),
        (F.col("l_quantity") * 9).cast("int").alias("passenger_count"),
        F.when(F.col("l_discount") > 0, F.floor(F.col("l_extendedprice") / 80).cast("int")).alias("delay_seconds"),
        day.alias("trip_date"),
        F.get(blocks, F.col("l_linenumber") - 1).alias("hour_block"),
        F.date_format(day, "MM-dd").isin("01-01", "05-01", "07-20", "08-07", "12-08", "12-25").alias("is_holiday"),
        F.concat(F.lit("trips_"), F.year(day).cast("string"), F.lit("_"), half).alias("source_file"),
        F.col("l_shipdate").cast("timestamp").alias("ingestion_ts"),
    )


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips(spark, sf_dir).withColumn("bronze_ingestion_ts", F.col("ingestion_ts"))


def to_messages(events: DataFrame) -> DataFrame:
    """``events`` rows as JSON messages with the time the source got them.

    Sign-ups have no event type, so they test the default for an absent field.
    """
    kind = F.col("event_type")
    mapped = F.when(kind == "click", "arrival").when(kind == "view", "departure")
    mapped = mapped.when(kind == "error", "delay_alert").when(kind == "purchase", "capacity_alert")
    number = F.get_json_object("props", "$.k").cast("int")
    lines = F.array(*[F.lit(line) for line in EVENT_LINES])
    ts = F.col("ts").cast("timestamp")
    body = F.struct(
        F.col("event_id").cast("string").alias("event_id"),
        mapped.alias("event_type"),
        _numbered("P-", "user_id").alias("stop_id"),
        F.get(lines, F.pmod(number, F.lit(len(EVENT_LINES)))).alias("line"),
        F.concat(F.lit("V-"), number.cast("string")).alias("vehicle_id"),
        F.floor(F.col("value") * 3).cast("int").alias("passenger_count"),
        F.floor(F.col("value") * 2).cast("int").alias("delay_seconds"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
    )
    return events.select(F.to_json(body).alias("value"), ts.alias("timestamp"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_messages(table(spark, sf_dir, "events"))


def message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return to_messages(rows)
