"""Dates: many spellings to UTC, and the daily windows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "Asia/Shanghai"
RFC3339 = "yyyy-MM-dd'T'HH:mm:ss'+00:00'"
# The accepted spellings, first those with a zone, then local ones.
ZONED = ("d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm Z")
LOCAL = ("yyyy/MM/dd HH:mm", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy/MM/dd", "yyyy.MM.dd HH:mm")


def epoch(value: Column) -> Column:
    """Seconds, milliseconds or microseconds by magnitude; outside 9e8 to 4e9 seconds null."""
    s = F.when(value > 1e14, value / 1e6).when(value > 1e11, value / 1e3).otherwise(value)
    return F.when((s >= 9e8) & (s <= 4e9), F.timestamp_seconds(F.floor(s)))


def parse_date(text: Column) -> Column:
    """A text to a timestamp, whatever its spelling; without a zone it is local to ZONE. The session zone is UTC."""
    s = F.trim(text)
    digits = F.when(s.rlike(r"^\d{10,13}$"), epoch(s.try_cast("double")))
    undated = F.regexp_replace(F.regexp_replace(s, r"^[A-Za-z]{3,9},\s*", ""), r"\b(GMT|UTC?)$", "+0000")
    zoned = [F.try_to_timestamp(undated, F.lit(f)) for f in ZONED]
    has_zone = s.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}.*(Z|[+-]\d{2}:?\d{2})$")
    iso_text = s.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.,]\d+)?)?)?(Z|[+-]\d{2}:?\d{2})?$")
    naive = F.try_to_timestamp(s)
    iso = F.when(iso_text & has_zone, naive).when(iso_text, F.to_utc_timestamp(naive, ZONE))
    local = [F.to_utc_timestamp(F.try_to_timestamp(s, F.lit(f)), ZONE) for f in LOCAL]
    damaged = F.regexp_extract(s, r"^(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2})", 0)
    rescued = F.to_utc_timestamp(F.try_to_timestamp(F.replace(damaged, F.lit("T"), F.lit(" ")), F.lit("yyyy-MM-dd HH:mm")), ZONE)
    return F.when(s.rlike(r"^\d{10,13}$"), digits).otherwise(F.coalesce(*zoned, iso, *local, rescued))


def rfc3339(ts: Column) -> Column:
    return F.date_format(ts, RFC3339)


def window_start(day: Column) -> Column:
    """06:30 in ZONE of the day before an episode, in UTC."""
    return F.to_utc_timestamp(F.date_add(day, -1).cast("timestamp") + F.expr("INTERVAL '6:30' HOUR TO MINUTE"), ZONE)


def window_end(day: Column) -> Column:
    return F.to_utc_timestamp(day.cast("timestamp") + F.expr("INTERVAL '6:30' HOUR TO MINUTE"), ZONE)


def episode_of(ts: Column) -> Column:
    """The episode whose window holds an instant."""
    return F.to_date(F.from_utc_timestamp(ts, ZONE) - F.expr("INTERVAL '6:30' HOUR TO MINUTE")) + 1


def render_dates(url: Column, end: Column) -> Column:
    """{T}, {T+Nd} and {T-Nd} of a URL, also with _ts for epoch seconds, by any number of days from the window's end."""
    marks = F.array_distinct(F.regexp_extract_all(url, F.lit(r"\{T(?:[+-]\d+d)?(?:_ts)?\}"), 0))

    def rendered(mark: Column) -> Column:
        days = F.coalesce(F.regexp_extract(mark, r"([+-]\d+)d", 1).try_cast("int"), F.lit(0))
        day = F.date_format(F.date_add(F.to_date(F.from_utc_timestamp(end, ZONE)), days), "yyyy-MM-dd")
        return F.when(F.endswith(mark, F.lit("_ts}")), (F.unix_timestamp(end) + days * 86400).cast("string")).otherwise(day)

    return F.aggregate(marks, url, lambda acc, mark: F.replace(acc, mark, rendered(mark)))


def checked_day(day: Column) -> Column:
    """A day, written in full and on the calendar; anything else stops the query before a row is written."""
    good = day.rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_date(day, "yyyy-MM-dd").isNotNull()
    return F.when(good, F.to_date(day, "yyyy-MM-dd")).otherwise(F.raise_error(F.concat(F.lit("not a day: "), F.coalesce(day, F.lit("null")))).cast("date"))
