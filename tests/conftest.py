import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidelake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        {
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "2",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def catalog(spark):
    """Two stations shared by lines A (metro) and K (cable), one of them a transfer."""
    stops = spark.createDataFrame(
        [("A1", "S1", "A", 1, "metro"), ("A2", "S2", "A", 2, "metro"), ("A3", "S3", "A", 3, "metro"),
         ("K1", "S2", "K", 1, "cable"), ("K2", "S4", "K", 2, "cable")],
        "stop_id string, station_id string, linea string, orden int, tipo_servicio string",
    )
    stations = spark.createDataFrame(
        [("S1", "Niquía", 6.33, -75.54, "Bello", False), ("S2", "Acevedo", 6.3, -75.55, "Envigado", True),
         ("S3", "Itagüí", 6.16, -75.6, "Itagüí", False), ("S4", "Popular", 6.29, -75.54, "Envigado", False)],
        "station_id string, nombre string, latitud double, longitud double, municipio string, es_transbordo boolean",
    )
    return stops, stations
