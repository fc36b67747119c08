"""Date parsing and calendar features (F1-F10) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from responsekit.catalog import DATE_COL, DATE_FORMATS


def min_parsed_date(df: DataFrame, col: str = DATE_COL) -> str | None:
    """earliest parsable date of a table."""
    d = df.agg(F.min(parse_mixed_date(F.col(col))).alias("d")).first()["d"]
    return str(d) if d is not None else None


def parse_mixed_date(c: Column, formats=DATE_FORMATS) -> Column:
    """first format that parses wins; unparsable text becomes null."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats]).cast("date")


def days_since(d: Column, min_date) -> Column:
    """F2 ``Dates``: days since the fitted minimum date; null -> 0."""
    if min_date is None:
        return F.lit(0).cast("long")
    return F.coalesce(F.datediff(d, F.lit(str(min_date)).cast("date")), F.lit(0)).cast("long")


def _flag(pred: Column) -> Column:
    return F.coalesce(pred, F.lit(False)).cast("long")


def calendar_parts(d: Column) -> dict[str, Column]:
    """Calendar parts (null when the date is null) and 0/1 flags (null -> 0)."""
    dow = F.weekday(d)  # Monday = 0
    return {
        "Dt_Year": F.year(d).cast("long"),
        "Dt_Month": F.month(d).cast("long"),
        "Dt_Day": F.dayofmonth(d).cast("long"),
        "Dt_DayOfWeek": dow.cast("long"),
        "Dt_DayOfYear": F.dayofyear(d).cast("long"),
        "Dt_Quarter": F.quarter(d).cast("long"),
        "Dt_Is_Weekend": _flag(dow >= 5),
        "Dt_Is_Month_Start": _flag(F.dayofmonth(d) == 1),
        "Dt_Is_Month_End": _flag(d == F.last_day(d)),
    }


def tenure_season(dt_year: Column, dt_month: Column, as_of_year: int) -> dict[str, Column]:
    """Tenure in years, recent flag and two season flags."""
    since = F.lit(as_of_year) - dt_year
    return {
        "Customer_Since_Years": since.cast("long"),
        "Is_Recent_Customer": _flag(since <= 1),
        "Is_Season_Winter": _flag(dt_month.isin(12, 1, 2)),
        "Is_Season_Summer": _flag(dt_month.between(6, 8)),
    }
