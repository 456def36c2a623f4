"""Calendar columns and seasonal encodings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_day(text: Column | str, fmt: str = "yyyyMMdd") -> Column:
    """Date from text; anything that is not a date becomes null."""
    return F.try_to_date(F.col(text) if isinstance(text, str) else text, fmt)


def utc_day(ts: Column | str) -> Column:
    """Calendar day in UTC of an instant, whatever the session time zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(ts) / 86400).cast("int"))


def season_name(month: Column) -> Column:
    return F.when(month.isin(12, 1, 2), "winter").when(month.isin(3, 4, 5), "summer").otherwise("rainy")


def season_number(month: Column) -> Column:
    return F.when(month.isin(12, 1, 2), 0).when(month.isin(3, 4, 5), 1).otherwise(2)


def calendar_columns(day: Column | str) -> dict[str, Column]:
    """year, month, day, ISO week, weekday (Monday = 0) and season of a date."""
    month = F.month(day)
    return {
        "year": F.year(day),
        "month": month,
        "day": F.dayofmonth(day),
        "week": F.weekofyear(day),
        "weekday": F.weekday(day),
        "season_num": season_number(month),
    }


def cyclic(value: Column, period: float) -> tuple[Column, Column]:
    """Sine and cosine of a value that repeats after ``period``."""
    angle = F.lit(2.0) * F.pi() * value / F.lit(period)
    return F.sin(angle), F.cos(angle)


def seasonal_encodings(month: Column, dayofyear: Column) -> dict[str, Column]:
    month_sin, month_cos = cyclic(month, 12.0)
    doy_sin, doy_cos = cyclic(dayofyear, 365.0)
    return {"month_sin": month_sin, "month_cos": month_cos, "doy_sin": doy_sin, "doy_cos": doy_cos}


def frequency_encodings(month: Column, dayofyear: Column) -> dict[str, Column]:
    """Weekly, quarterly and half-yearly cycles, and the progress through a 30-day month."""
    named = {
        "week": cyclic(dayofyear, 7.0),
        "quarter": cyclic(month - 1, 3.0),
        "half_year": cyclic(month - 1, 6.0),
    }
    out: dict[str, Column] = {}
    for name, (sine, cosine) in named.items():
        out[f"{name}_sin"] = sine
        out[f"{name}_cos"] = cosine
    out["month_progress"] = (dayofyear % 30) / F.lit(30.0)
    return out


def days_ahead(day: Column | str, days: Column | int) -> Column:
    return F.date_add(day, days)


def day_name(day: Column | str) -> Column:
    return F.date_format(day, "EEEE")
