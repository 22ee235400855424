"""Calendar expressions: company age, cache expiry, load ids and durations."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

BUSINESS_ZONE = "America/Sao_Paulo"
EXPIRY_DAY = 15
DAYS_PER_YEAR = 365.25


def start_date(text: Column) -> Column:
    """Strict ``yyyy-MM-dd``; malformed text raises under ANSI mode."""
    return F.to_date(text, "yyyy-MM-dd")


def company_age(text: Column, as_of: Column) -> Column:
    """Age in years with one decimal, single precision."""
    days = F.datediff(as_of, start_date(text)).cast("double")
    return F.round(days / F.lit(DAYS_PER_YEAR), 1).cast("float")


def cache_expiry(now: Column) -> Column:
    """Next 15th at midnight business time; from the 15th on, the one of next month.

    At least one second ahead of ``now``. Goes through wall-clock timestamps, so the
    result does not depend on the session time zone.
    """
    wall = F.convert_timezone(None, F.lit(BUSINESS_ZONE), now.cast("timestamp_ntz"))
    first = F.trunc(wall.cast("date"), "month")
    month = F.when(F.dayofmonth(wall) < EXPIRY_DAY, first).otherwise(F.add_months(first, 1))
    expiry_wall = F.date_add(month, EXPIRY_DAY - 1).cast("timestamp_ntz")
    expiry = F.convert_timezone(
        F.lit(BUSINESS_ZONE), F.current_timezone(), expiry_wall
    ).cast("timestamp")
    return F.greatest(expiry, now + F.expr("INTERVAL 1 SECOND"))


def seconds_to_expiry(now: Column) -> Column:
    """Whole seconds until :func:`cache_expiry`, at least one."""
    micros = F.unix_micros(cache_expiry(now)) - F.unix_micros(now)
    return F.greatest(F.floor(micros / 1_000_000).cast("long"), F.lit(1).cast("long"))


def time_ordered_id(started: Column, entropy: Column) -> Column:
    """UUID version 7 text: 48 bits of unix milliseconds, then bits of ``entropy``.

    ``entropy`` is at least 19 hex digits, e.g. an md5.
    """
    millis = F.lower(F.lpad(F.hex(F.unix_millis(started)), 12, "0"))
    nibble = F.conv(F.substring(entropy, 4, 1), 16, 10).cast("int") % 4
    return F.concat(
        F.substring(millis, 1, 8), F.lit("-"), F.substring(millis, 9, 4),
        F.lit("-7"), F.substring(entropy, 1, 3),
        F.lit("-"), F.substr(F.lit("89ab"), nibble + 1, F.lit(1)), F.substring(entropy, 5, 3),
        F.lit("-"), F.substring(entropy, 8, 12),
    )


def elapsed_seconds(started: Column, finished: Column) -> Column:
    """Seconds between two instants, two decimals, wide enough for any load."""
    millis = F.unix_millis(finished) - F.unix_millis(started)
    return F.round(millis.cast("decimal(18,0)") / 1000, 2).cast("decimal(14,2)")
