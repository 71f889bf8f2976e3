"""Day windows and the refresh plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pressmill.session import written


def in_exact_window(key: Column, days: int, today: Column, key_format: str) -> Column:
    """Day key is one of the last ``days`` days, in the source's own notation.

    The key must be written exactly as the format writes it.
    """
    day = F.try_to_date(key, key_format)
    as_written = F.date_format(day, key_format) == key
    return F.coalesce(as_written & day.between(F.date_sub(today, days - 1), today), F.lit(False))


def in_cutoff_window(key: Column, days: int, today: Column) -> Column:
    """Day key is ``today - days`` or later; later than today counts too."""
    day = F.try_to_date(F.regexp_extract(key, r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$", 0), "y-M-d")
    return F.coalesce(day >= F.date_sub(today, days), F.lit(False))


def in_source_window(key: Column, key_format: Column | str, days: int, today: Column) -> Column:
    """Exact window for sources with a key format, cutoff window for the rest."""
    if isinstance(key_format, str):
        return (
            in_exact_window(key, days, today, key_format)
            if key_format
            else in_cutoff_window(key, days, today)
        )
    out = in_cutoff_window(key, days, today)
    for known in ("yyyy/MM/dd", "yyyy-MM-dd"):
        out = F.when(key_format == known, in_exact_window(key, days, today, known)).otherwise(out)
    return out


MIN_REFRESH_DAYS = 2


def refresh_plan(
    spark_range: DataFrame, cached_days: DataFrame, refresh_days: int
) -> DataFrame:
    """``(source, day, cached, process)`` for each day of the window.

    ``spark_range`` is ``(source, day, age)`` with age 0 for today. A day is
    processed when it is not cached or is among the last ``refresh_days``.
    """
    recent = max(MIN_REFRESH_DAYS, refresh_days)
    held = cached_days.select("source", "day").distinct().withColumn("cached", F.lit(True))
    return spark_range.join(held, ["source", "day"], "left").select(
        "source",
        "day",
        F.coalesce("cached", F.lit(False)).alias("cached"),
        (F.col("cached").isNull() | (F.col("age") < recent)).alias("process"),
    )


def day_range(sources: DataFrame, days: int, today: Column) -> DataFrame:
    """``(source, day, age)`` of the last ``days`` days per source."""
    ages = F.sequence(F.lit(0), F.lit(days - 1))
    return sources.select("source", F.explode(ages).alias("age")).withColumn(
        "day", F.date_sub(today, F.col("age"))
    )


def in_window_table(days: DataFrame, windows: DataFrame, today: Column) -> DataFrame:
    """The rows of a day table that lie in their source's window.

    ``days`` is partitioned by ``source`` and ``day``; ``windows`` is ``(source, days)``, a
    row per source. The windows are unfolded to their days and joined, so the scan opens
    the partitions of these days only (dynamic partition pruning). They are written first,
    which gives the planner their size: it broadcasts them where they are small, as pruning
    needs. Sources without a window have no rows.
    """
    span = F.sequence(F.date_sub(today, F.col("days").cast("int") - 1), today)
    wanted = windows.filter("days > 0").select("source", F.explode(span).alias("day"))
    wanted = written(wanted.distinct(), "window_days").filter(F.col("day") <= today)
    return days.join(wanted, ["source", "day"])


def group_by_day(articles: DataFrame, day: Column, order: Column) -> DataFrame:
    """Articles and their span per day; the rows stay in the day-partitioned table."""
    return articles.groupBy(day.alias("day")).agg(
        F.count(F.lit(1)).alias("n_articles"),
        F.min(order).alias("first_ord"),
        F.max(order).alias("last_ord"),
    )
