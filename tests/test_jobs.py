import datetime as dt
import random
import time

from tests.test_streaming import message, write_files
from tidelake import __main__ as cli
from tidelake import schemas
from tidelake.streaming import jobs

STOPS = "stop_id,station_id,linea,orden,tipo_servicio\nA1,S1,A,1,metro\nA2,S2,A,2,metro\nK1,S2,K,1,cable\n"
STATIONS = (
    "station_id,nombre,latitud,longitud,municipio,es_transbordo\n"
    "S1,Niquía,6.33,-75.54,Bello,false\nS2,Acevedo,6.3,-75.55,Envigado,true\n"
)


def cli_out(job, *argv):
    return job(*argv)


def trips(n, seed, name):
    rng = random.Random(seed)
    lines = [",".join(schemas.TRIPS_CSV.names)]
    for i in range(n):
        a, b = rng.sample(["A1", "A2"], 2)
        day = dt.date(2026, 5, 4) + dt.timedelta(days=7 * rng.randrange(2))
        lines.append(f"T{i},{a},{b},A,{rng.randint(1, 450)},{rng.randint(0, 1300)},{day},12-15,false,{name},2026-05-01T00:00:00Z")
    return "\n".join(lines) + "\n"


def test_all_jobs(spark, tmp_path, capsys):
    catalog, root = tmp_path / "catalog", str(tmp_path / "lake")
    catalog.mkdir()
    (catalog / "paradas.csv").write_text(STOPS, encoding="utf-8")
    (catalog / "estaciones.csv").write_text(STATIONS, encoding="utf-8")
    for n in (1, 2):
        (tmp_path / f"batch_{n}.csv").write_text(trips(60, n, f"batch_{n}.csv"), encoding="utf-8")
    write_files(tmp_path / "in", [message(0, pax=30), message(5, "delay_alert", delay=400), message(9, stop="K1", line="K", pax=9)],
                [message(400)], [message(401)])

    def job(*argv):
        cli.main(["--root", root, "--catalog", str(catalog), "--as-of", "2026-05-18 14:03:00", *argv])
        return capsys.readouterr().out

    assert "MISSING" in job("health") and not (tmp_path / "lake" / "ops").exists()
    assert "loaded batch_1.csv" in job("ingest", str(tmp_path / "batch_1.csv"), "--landing", str(tmp_path))
    assert "loaded batch_2.csv" in job("ingest", str(tmp_path / "batch_2.csv"), "--landing", str(tmp_path))
    assert "already loaded" in job("ingest", str(tmp_path / "batch_1.csv"), "--landing", str(tmp_path))
    assert "2 of 2 rows" in job("history")
    assert "'_read': 120" in job("silver")
    out = job("gold")
    assert "'estaciones_volumen': 2" in out and "Niquía" in out
    assert "stops:count" in job("validate")
    reports = str(tmp_path / "reports")
    assert "1 of 2 rows" in cli_out(job, "--rows", "1", "--out", reports, "history")
    assert spark.read.json(f"{reports}/loads").count() == 2
    job("stream", "--format", "json", "--source", str(tmp_path / "in"), "--once")
    out = job("compare")
    assert "Acevedo" in out and "Niquía" in out
    out = job("serve", "--station", "S1")
    assert "400" in out and "most alerts" in out
    assert "OK_EXISTS" in job("health")
    assert "station_alerts" in job("clean")


def test_stream_counts_late_rows_of_its_last_batches(spark, tmp_path, monkeypatch):
    """Progress reaches the listener late; the command ends only when all of it is counted."""

    class Slow(jobs.LateRows):
        def onQueryProgress(self, event):
            time.sleep(0.5)
            super().onQueryProgress(event)

    monkeypatch.setattr(jobs, "LateRows", Slow)
    catalog, root = tmp_path / "catalog", str(tmp_path / "lake")
    catalog.mkdir()
    (catalog / "paradas.csv").write_text(STOPS, encoding="utf-8")
    (catalog / "estaciones.csv").write_text(STATIONS, encoding="utf-8")
    write_files(tmp_path / "in", *([message(100_000 + n)] if n % 2 else [message(n)] for n in range(1, 7)))
    cli.main(["--root", root, "--catalog", str(catalog), "stream", "--format", "json", "--source", str(tmp_path / "in"), "--once", "--max-per-trigger", "1"])
    late = {r["query"]: r.dropped for r in jobs.late_rows(spark, f"{root}/ops/late_rows").collect()}
    assert late[jobs.JOB] == 4  # each late event in two tables
