"""Time expressions. All results are zone-less UTC wall-clock times
(``timestamp_ntz``), whatever the session time zone is."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelake import vocab
from hirelake.functions.text import clean_text

_ZONE = r"\d:\d{2}(:\d{2}(\.\d+)?)?\s*(Z|UTC|GMT|[+-]\d{1,2}(:?\d{2})?)$"


def _ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def to_utc_naive(ts: Column) -> Column:
    """An instant as its UTC wall-clock time."""
    seconds = F.unix_micros(ts).cast("decimal(20,0)") / F.lit(1000000).cast("decimal(7,0)")
    return _ntz("1970-01-01 00:00:00") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def parse_time_lenient(c: Column) -> Column:
    """ISO date or date-time text; null where it does not parse. Text with a zone
    is moved to UTC."""
    text = clean_text(c)
    return F.when(text.rlike(_ZONE), to_utc_naive(text.try_cast("timestamp"))).when(
        text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), text.try_cast("timestamp_ntz")
    )


def parse_time(c: Column, default: str | None = None) -> Column:
    """Strict parse of ``yyyy-MM-dd HH:mm:ss``: other text is an error, null
    becomes ``default``."""
    parsed = F.to_timestamp_ntz(clean_text(c), F.lit(vocab.TIME_FORMAT))
    return parsed if default is None else F.coalesce(parsed, _ntz(default))


def render_time(ts: Column) -> Column:
    """As ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.date_format(ts, vocab.TIME_FORMAT)


def minus_age(now: Column, amount: Column, unit: str) -> Column:
    """``now`` minus ``amount`` minutes, hours or days; null out of range."""
    parts = {"minutes": "mins", "hours": "hours", "days": "days"}
    then = F.try_subtract(now, F.make_interval(**{parts[unit]: amount}))
    return F.when(then >= _ntz("0001-01-01 00:00:00"), then)


def publish_time(age: Column, scraped_at: Column) -> Column:
    """Relative age ("5m ago", "3h ago", "30d+ ago") to a time.

    All digits of the text form the number. The unit is decided by the first of
    the letters m, h, d that occurs anywhere, so "2 jam" (hours) counts as
    minutes and "5 hari" (days) as hours. Without number or unit: ``scraped_at``.
    """
    amount = F.regexp_replace(age, "[^0-9]", "").try_cast("int")
    instant = F.typeof(scraped_at) == "timestamp"  # folded: a column has one type
    now = F.when(instant, to_utc_naive(scraped_at.cast("timestamp"))).otherwise(
        scraped_at.cast("timestamp_ntz")
    )
    then = (
        F.when(age.contains("m"), minus_age(now, amount, "minutes"))
        .when(age.contains("h"), minus_age(now, amount, "hours"))
        .when(age.contains("d"), minus_age(now, amount, "days"))
    )
    return F.coalesce(then, now)
