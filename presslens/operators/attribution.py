"""Attributing dated mentions to dated events of the same entity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

BUCKET_WINDOWS = 4  # windows that a bucket of the outer join is wide


def event_gaps(df: DataFrame, entity: str, date: str) -> DataFrame:
    """Days since the previous distinct event date of the same entity."""
    window = Window.partitionBy(entity).orderBy(date)
    previous = F.lag(date).over(window)
    return (
        df.select(entity, date)
        .na.drop()
        .distinct()
        .withColumn("gap_days", F.date_diff(F.col(date), previous))
    )


def min_event_gap(df: DataFrame, entity: str, date: str) -> DataFrame:
    """Smallest gap in days between two events of one entity (neighbours suffice)."""
    return event_gaps(df, entity, date).agg(F.min("gap_days").alias("min_gap_days"))


def _window_buckets(date: Column, max_days: int) -> Column:
    """Buckets of width max_days that dates in (date, date + max_days) can fall in."""
    first = F.floor((F.unix_date(date) + 1) / max_days)
    last = F.floor((F.unix_date(date) + max_days - 1) / max_days)
    return F.explode(F.array_distinct(F.array(first, last)))


def _event_buckets(day: Column, max_days: int, width: int) -> Column:
    """Buckets of width days of the events that lie less than max_days before a day."""
    return F.array_distinct(F.array(F.floor((day - max_days + 1) / width), F.floor((day - 1) / width)))


def _in_window(event_date: Column, mention_date: Column, max_days: int) -> Column:
    gap = F.date_diff(mention_date, event_date)
    return (gap > 0) & (gap < max_days)


def _keys_equal(left: DataFrame, right: DataFrame, on: list[tuple[str, str]], null_safe: bool):
    return reduce(
        Column.__and__,
        (left[a].eqNullSafe(right[b]) if null_safe else left[a] == right[b] for a, b in on),
    )


def attribute_in_window(
    events: DataFrame,
    mentions: DataFrame,
    on: list[tuple[str, str]],
    event_date: str,
    mention_date: str,
    max_days: int | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Pairs with equal keys and 0 < mention - event < max_days.

    Time is cut into buckets of max_days and the bucket is part of the join key, so an
    entity with many events and mentions is spread over its time line. Without max_days
    the smallest gap minus one day of single-key events is used.
    """
    if max_days is None:
        smallest = min_event_gap(events, on[0][0], event_date).first()[0]
        if smallest is None:
            raise ValueError("no entity has two event dates; give max_days")
        max_days = smallest - 1
    if max_days < 1:
        return events.join(mentions, F.lit(False))
    left = events.withColumn("_bucket", _window_buckets(F.col(event_date), max_days))
    right = mentions.withColumn(
        "_mention_bucket", F.floor(F.unix_date(F.col(mention_date)) / max_days)
    )
    condition = (
        _keys_equal(left, right, on, null_safe)
        & (left["_bucket"] == right["_mention_bucket"])
        & _in_window(left[event_date], right[mention_date], max_days)
    )
    return left.join(right, condition).drop("_bucket", "_mention_bucket")


def attribute_in_window_left(
    events: DataFrame,
    mentions: DataFrame,
    on: list[tuple[str, str]],
    event_id: str,
    event_date: str,
    mention_date: str,
    max_days: int,
    keep_uncovered: bool = True,
    null_safe: bool = False,
) -> DataFrame:
    """attribute_in_window plus the events without a mention, mention columns null.

    With null_safe, events and mentions without an entity belong together.

    keep_uncovered=False drops an event that has mentions, but none inside the window.
    """
    if max_days < 1:
        joined = events.join(mentions.withColumn("_hit", F.lit(True)), F.lit(False), "left")
    else:
        # An event lies in one bucket and its mentions in that or the next one, so every pair meets
        # once and one outer join gives pairs and uncovered events alike. Buckets are some windows
        # wide, so few mentions lie behind events of two buckets and travel twice.
        width = max_days * BUCKET_WINDOWS
        left = events.withColumn("_bucket", F.floor(F.unix_date(F.col(event_date)) / width))
        starts = _event_buckets(F.unix_date(F.col(mention_date)), max_days, width)
        right = mentions.withColumns({"_mention_bucket": F.explode(starts), "_hit": F.lit(True)})
        condition = (
            _keys_equal(left, right, on, null_safe)
            & (left["_bucket"] == right["_mention_bucket"])
            & _in_window(left[event_date], right[mention_date], max_days)
        )
        joined = left.join(right, condition, "left").drop("_bucket", "_mention_bucket")
    if keep_uncovered:
        return joined.drop("_hit")
    known = mentions.select(*(F.col(b).alias(f"_m_{b}") for _, b in on)).distinct()
    known = known.withColumn("_known", F.lit(True))
    renamed = [(a, f"_m_{b}") for a, b in on]
    marked = joined.join(known, _keys_equal(events, known, renamed, null_safe), "left")
    kept = marked.filter(F.col("_hit").isNotNull() | F.col("_known").isNull())
    return kept.drop("_hit", "_known", *(b for _, b in renamed))


def _covered(days: DataFrame, daily: DataFrame, names: list[str], max_days: int) -> DataFrame:
    """(names, _event, _n): sum of the daily counts `_n` on days in (_event, _event + max_days).

    An event puts two markers on its entity's time line, one on its own day and one on the last day
    of its window, each behind that day's count. The counts up to the markers, one running sum per
    entity, differ by the coverage, so no event meets a day. The daily counts of a busy entity were
    added up in the tasks; its time line has a row a day and two per distinct event date, so
    the calendar bounds what one running sum goes over. Events without mentions in the window are
    left out.
    """
    none = F.lit(0).cast("bigint")
    event = F.unix_date(F.col("_event"))
    marker = lambda day, sign: F.struct(day.cast("bigint").alias("d"), F.lit(sign).alias("s"))
    marks = days.select(*names, "_event", F.explode(F.array(marker(event, -1), marker(event + max_days - 1, 1))).alias("m"))
    marks = marks.select(*names, "_event", F.col("m.d").alias("_d"), none.alias("_n"), F.col("m.s").alias("_sign"))
    counted = daily.filter(F.col("_day").isNotNull()).na.drop(subset=names).select(
        *names, F.lit(None).cast(days.schema["_event"].dataType).alias("_event"),
        F.unix_date("_day").cast("bigint").alias("_d"), "_n", F.lit(0).alias("_sign"),
    )
    upto = Window.partitionBy(*names).orderBy("_d", F.abs("_sign")).rowsBetween(Window.unboundedPreceding, 0)
    summed = counted.unionByName(marks).withColumn("_sum", F.sum("_n").over(upto)).filter("_sign != 0")
    covered = summed.groupBy(*names, "_event").agg(F.sum(F.col("_sign") * F.col("_sum")).alias("_n"))
    return covered.filter("_n > 0")


def coverage_per_event(
    events: DataFrame,
    mentions: DataFrame,
    on: list[tuple[str, str]],
    event_date: str,
    mention_date: str,
    max_days: int,
    out: str = "n_articles",
    keep_uncovered: bool = True,
    drop_null_in: list[str] | None = None,
) -> DataFrame:
    """Number of mentions inside the window of each event, zero included.

    Mentions are counted per entity and day first and events are reduced to entity and
    date, so neither a busy day nor a repeated event multiplies rows; running sums over the
    days then give the windows.
    keep_uncovered=False drops events that have mentions only outside the window;
    drop_null_in drops events with a null in one of these columns.
    """
    if drop_null_in:
        events = events.na.drop(subset=drop_null_in)
    names = [f"_k{i}" for i in range(len(on))]
    daily = mentions.groupBy(
        *(F.col(b).alias(n) for n, (_, b) in zip(names, on)), F.col(mention_date).alias("_day")
    ).agg(F.count("*").alias("_n"))
    days = events.select(
        *(F.col(a).alias(n) for n, (a, _) in zip(names, on)), F.col(event_date).alias("_event")
    ).na.drop().distinct()
    covered = _covered(days, daily, names, max_days).withColumnRenamed("_n", out)
    counts = covered.alias("c")
    match = [F.col(a) == F.col(n) for n, (a, _) in zip(names, on)]
    joined = events.join(
        counts, reduce(Column.__and__, match) & (F.col(event_date) == F.col("_event")), "left"
    ).drop(*names, "_event")
    if not keep_uncovered:
        known = daily.select(*(F.col(n).alias(f"_m{n}") for n in names)).distinct()
        known = known.withColumn("_known", F.lit(True))
        condition = reduce(
            Column.__and__, (F.col(a) == F.col(f"_m{n}") for n, (a, _) in zip(names, on))
        )
        joined = joined.join(known, condition, "left").filter(
            F.col("_known").isNull() | F.col(out).isNotNull()
        )
        joined = joined.drop("_known", *(f"_m{n}" for n in names))
    return joined.withColumn(out, F.coalesce(out, F.lit(0)).cast("bigint"))
