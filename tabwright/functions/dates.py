"""Date functions. Parsing never raises: what doesn't fit is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

COMPACT, SLASHED, DASHED, ISO, MONTH = "ddMMMyyyy", "dd/MM/yyyy", "dd-MM-yyyy", "yyyy-MM-dd", "MMMyyyy"


def parse(text: Column, pattern: str) -> Column:
    return F.try_to_timestamp(text, F.lit(pattern)).cast("date")


def show(day: Column, pattern: str) -> Column:
    return F.date_format(day, pattern)


def reformat(text: Column, old: str, new: str) -> Column:
    return show(parse(text, old), new)


def inception(day: Column) -> Column:
    """The literal ``+yyyy-MM-ddT00:00:00Z/11``."""
    return F.date_format(day, "'+'yyyy-MM-dd'T00:00:00Z/11'")


def from_millis(millis: Column) -> Column:
    """Epoch milliseconds as text in the session's time zone."""
    return F.date_format(F.timestamp_millis(millis.cast("long")), "yyyy-MM-dd HH:mm:ss")


def document_date(text: Column) -> Column:
    """``D:yyyyMMddHHmmss`` with an optional ``+hh'mm'``, ``-hh'mm'`` or ``Z`` offset, as a timestamp. Parts that are
    missing are their least value."""
    pattern = r"^(?:D:)?(\d{4})(\d{2})?(\d{2})?(\d{2})?(\d{2})?(\d{2})?(?:([+\-Zz])(?:(\d{2})'?(\d{2})?'?)?)?$"

    def part(k: int, spare: str) -> Column:
        found = F.regexp_extract(text, pattern, k)
        return F.when(found == "", F.lit(spare)).otherwise(found)

    sign = F.when(part(7, "Z") == "-", F.lit(-1)).otherwise(F.lit(1))
    plain = F.concat(part(1, ""), part(2, "01"), part(3, "01"), part(4, "00"), part(5, "00"), part(6, "00"))
    moment = F.try_to_timestamp(plain, F.lit("yyyyMMddHHmmss"))
    minutes = sign * (part(8, "0").try_cast("int") * 60 + part(9, "0").try_cast("int"))
    return moment - F.make_dt_interval(F.lit(0), F.lit(0), minutes, F.lit(0))


def last_days(day: Column, n: int) -> Column:
    """The last ``n`` dates up to ``day``, ascending."""
    return F.sequence(F.date_sub(day, n - 1), day)


def months_back(day: Column, n: int) -> Column:
    """``MMMyyyy`` of ``n`` months before."""
    return F.date_format(F.add_months(F.trunc(day, "MM"), -n), MONTH)


def listed(date: Column) -> Column:
    """``ddMMMyyyy`` to ``yyyy-MM-dd`` and ``MMMyyyy`` to ``yyyy-MM``."""
    day = reformat(date, COMPACT, ISO)
    return F.coalesce(day, show(F.try_to_timestamp(F.concat(F.lit("01"), date), F.lit(COMPACT)), "yyyy-MM"))


def run_day(today: Column, days_before: int = 0) -> Column:
    """The day that a run is for, some days before today if it is set so."""
    return F.date_sub(today, days_before)
