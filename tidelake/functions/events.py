"""Expressions for transport events, their times and their reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Line codes served by cable cars and by tram; all others are metro.
CABLE_LINES = ["K", "J", "L", "H", "M", "P"]
TRAM_LINES = ["TA"]

# Fixed value: seconds of delay beyond which a line or vehicle is badly late.
HIGH_DELAY_SECONDS = 300

# Places per vehicle, and the share that counts as full.
CAPACITY = {"metro": 1200, "tranvia": 300, "cable": 50}
FULL_SHARE = 0.9

# Fixed value: the time format of messages.
EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def service_type(line: Column) -> Column:
    return F.when(line.isin(CABLE_LINES), "cable").when(line.isin(TRAM_LINES), "tranvia").otherwise("metro")


def capacity_of(service: Column) -> Column:
    """Places of a vehicle of the service; NULL for an unknown service."""
    chain = F.when(service == "metro", CAPACITY["metro"])
    return chain.when(service == "tranvia", CAPACITY["tranvia"]).when(service == "cable", CAPACITY["cable"])


def high_delay(max_delay: Column, threshold: int = HIGH_DELAY_SECONDS) -> Column:
    """The worst delay decides, not the average, which would hide a single bad vehicle."""
    return max_delay > threshold


def event_time(text: Column, source_ts: Column) -> Column:
    """Event time at millisecond precision; text that is not ``...ss.fZ`` falls back to the source time."""
    return F.date_trunc("MILLISECOND", F.coalesce(F.try_to_timestamp(text, F.lit(EVENT_TIME_FORMAT)), source_ts))


def iso_format(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def iso_parse(text: Column) -> Column:
    return F.to_timestamp(text, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def iso_ms(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def instant(as_of: Column | str) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def before(as_of: Column | str, seconds: int) -> Column:
    """The instant ``seconds`` before ``as_of``."""
    return instant(as_of) - F.make_dt_interval(secs=F.lit(seconds))


def joined_lines(lines: Column) -> Column:
    return F.array_join(lines, ",")


def is_multimodal(lines: Column) -> Column:
    return F.size(F.array_distinct(lines)) > 1


def delta_flag(delta: Column) -> Column:
    """Fixed marks: double above 1, single above 0.5, mirrored below, empty between."""
    return (
        F.when(delta > 1.0, "▲▲")
        .when(delta > 0.5, "▲")
        .when(delta < -1.0, "▼▼")
        .when(delta < -0.5, "▼")
        .otherwise("")
    )
