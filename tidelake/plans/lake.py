"""Where the tables of one lake lie, and the batch steps between them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from tidelake.operators.dimensions import build_stop_dim
from tidelake.plans import bronze, gold, incremental, silver
from tidelake.sources import refreshed
from tidelake.sources.files import read_stations, read_stops
from tidelake.streaming.jobs import operational_tables

GOLD = ("estaciones_volumen", "retraso_por_linea_mes", "demanda_rutas")


@dataclass(frozen=True)
class Lake:
    """``root`` holds the tables, ``catalog`` the two dimension files. With a ``namespace`` of the session's catalog, a view in
    it follows every refreshed table."""

    spark: SparkSession
    root: str
    catalog: str
    namespace: str | None = None

    def stops(self) -> DataFrame:
        return read_stops(self.spark, f"{self.catalog}/paradas.csv")

    def stations(self) -> DataFrame:
        return read_stations(self.spark, f"{self.catalog}/estaciones.csv")

    def dim(self) -> DataFrame:
        return build_stop_dim(self.stops(), self.stations())

    def path(self, layer: str, name: str = "trips") -> str:
        return f"{self.root}/{layer}/{name}"

    def bronze(self) -> DataFrame:
        return bronze.read_bronze(self.spark, self.path("bronze"))

    def silver(self) -> DataFrame:
        return refreshed.read(self.spark, self.path("silver"))

    def gold(self, name: str) -> DataFrame | None:
        """An aggregate table, or None if it was never built."""
        path = self.path("gold", name)
        return refreshed.read(self.spark, path) if refreshed.exists(self.spark, path) else None

    @property
    def ops(self) -> str:
        return f"{self.root}/ops"

    def operational(self, as_of: Column | str | None = None) -> dict[str, DataFrame]:
        return operational_tables(self.spark, self.ops, as_of)

    def ingest(self, csv_path: str, as_of: Column | str | None = None, landing: str | None = None) -> str | None:
        return bronze.ingest_trips(self.spark, self.path("bronze"), csv_path, as_of, landing)

    def refresh_silver(self, as_of: Column | str | None = None) -> dict:
        seen = silver.refresh_silver(self.path("silver"), self.bronze(), self.dim(), as_of)
        self._publish("silver", "trips")
        return seen

    def _publish(self, layer: str, name: str) -> None:
        if self.namespace:
            refreshed.publish(self.spark, f"{self.namespace}.{layer}_{name}", self.path(layer, name))

    def refresh_gold(self, as_of: Column | str | None = None) -> dict[str, int]:
        """The three aggregate tables and their row counts."""
        clean = self.silver()
        built = (gold.station_volume(clean, as_of), gold.line_month_delay(clean, as_of), gold.high_demand_share(clean, as_of=as_of))
        rows = {}
        for name, df in zip(GOLD, built, strict=True):
            rows[name] = gold.write_gold(self.path("gold", name), df)
            self._publish("gold", name)
        return rows

    @property
    def states(self) -> str:
        return f"{self.root}/gold_states"

    def update_gold(self, key: str | None = None, as_of: Column | str | None = None) -> list[str]:
        """Bring the aggregate states up to date with one batch, e.g. one that was loaded again, or with all that have none."""
        raw, keys = self.path("bronze"), [key] if key else incremental.behind(self.spark, self.path("bronze"), self.states)
        for k in keys:
            loaded = bronze.read_batch(self.spark, raw, k)
            incremental.update_batch(loaded, self.dim(), k, self.path("silver_batches"), self.states, as_of)
        return keys

    def merged_gold(self, name: str, as_of: Column | str | None = None) -> DataFrame:
        """An aggregate table merged from the states of all batches."""
        return incremental.merged_table(self.spark, self.states, name, as_of)
