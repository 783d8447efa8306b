"""Ride metrics over time windows, for tables.

All kinds end in one layout, told apart by ``metric_type``. Before anything is spread over
overlapping windows or compared in order, rides are summed into buckets with a plain hash
aggregation: no window size, hot location or hot moment sends raw rides to one task.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridelake.operators.ordered import carry_last
from ridelake.operators.sizing import computed_once

SLIDE = "5 minutes"
SPAN = "15 minutes"
GAP_SECONDS = 30 * 60

# Columns of a metric row, in order.
METRIC_COLUMNS = (
    "metric_type",
    "window_start",
    "window_end",
    "ride_count",
    "avg_fare",
    "total_revenue",
    "avg_distance",
    "pickup_location_id",
)

# How many gap-wide buckets one step of the session scan covers.
BUCKETS_PER_CHUNK = 1024


def ride_sums() -> list[Column]:
    """Sums that merge by addition and from which every metric follows."""
    return [
        F.count(F.lit(1)).alias("rides"),
        F.sum("fare_amount").alias("fares"),
        F.count("fare_amount").alias("fare_n"),
        F.sum("trip_distance").alias("miles"),
        F.count("trip_distance").alias("mile_n"),
    ]


def merged_sums() -> list[Column]:
    return [F.sum(name).alias(name) for name in ("rides", "fares", "fare_n", "miles", "mile_n")]


def metric_rows(
    sums: DataFrame, kind: str, start: Column, end: Column, distance: bool = True, location: bool = False
) -> DataFrame:
    """Metric layout from sums; columns a kind does not fill are typed nulls."""
    no_distance, no_location = F.lit(None).cast("double"), F.lit(None).cast("string")
    return sums.select(
        F.lit(kind).alias("metric_type"),
        start.alias("window_start"),
        end.alias("window_end"),
        F.col("rides").alias("ride_count"),
        F.try_divide("fares", "fare_n").alias("avg_fare"),
        F.col("fares").alias("total_revenue"),
        (F.try_divide("miles", "mile_n") if distance else no_distance).alias("avg_distance"),
        (F.col("pickup_location_id").cast("string") if location else no_location).alias("pickup_location_id"),
    )


def _five_minute_sums(rides: DataFrame) -> DataFrame:
    return rides.groupBy(F.window("pickup_ts", SLIDE).alias("w")).agg(*ride_sums())


def tumbling_5m(rides: DataFrame) -> DataFrame:
    return metric_rows(
        _five_minute_sums(rides), "tumbling_5m", F.col("w.start"), F.col("w.end"), distance=False
    )


def sliding_15m_5m(rides: DataFrame) -> DataFrame:
    """Fifteen minutes every five: sums per five minutes, each then counted in three windows."""
    slides = _five_minute_sums(rides).withColumn("pickup_ts", F.col("w.start")).drop("w")
    spread = slides.groupBy(F.window("pickup_ts", SPAN, SLIDE).alias("w")).agg(*merged_sums())
    return metric_rows(spread, "sliding_15m_5m", F.col("w.start"), F.col("w.end"))


def _gap_buckets(rides: DataFrame, keys: list[str], gap_seconds: int) -> DataFrame:
    """Sums per key and gap-wide bucket. Two rides of one bucket are always in one session.

    The rides are read once: all further steps use the buckets.
    """
    bucket = F.floor(F.unix_timestamp("pickup_ts") / F.lit(gap_seconds)).alias("bucket")
    return computed_once(
        rides.filter("pickup_ts IS NOT NULL")
        .groupBy(*keys, bucket)
        .agg(F.min("pickup_ts").alias("first_ts"), F.max("pickup_ts").alias("last_ts"), *ride_sums())
    )


def _session_starts(buckets: DataFrame, keys: list[str], gap_seconds: int) -> DataFrame:
    """Add the first bucket of the session each bucket belongs to.

    Buckets are as wide as the gap, so only the directly preceding one can be close enough,
    and a bucket starts a session unless that one ends within the gap before its first ride.
    The last start is then carried along. At most one row per key and bucket takes part.
    """
    gap = F.make_dt_interval(secs=F.lit(gap_seconds))
    chunk = F.floor(F.col("bucket") / F.lit(BUCKETS_PER_CHUNK))
    earlier = buckets.select(
        *keys, (F.col("bucket") + 1).alias("bucket"), F.col("last_ts").alias("_earlier_ts")
    )
    linked = buckets.join(earlier, [*keys, "bucket"], "left")
    joined_on = F.col("_earlier_ts") + gap >= F.col("first_ts")
    marked = linked.withColumn("_start", F.when(~F.coalesce(joined_on, F.lit(False)), F.col("bucket")))
    return carry_last(marked, keys, ["bucket"], chunk, "_start", "session").drop("_start", "_earlier_ts")


def session_30m(rides: DataFrame, gap_seconds: int = GAP_SECONDS) -> DataFrame:
    """Sessions per pickup location: a pause longer than the gap ends one.

    Rides of no location form sessions of their own, under a null location.
    """
    keys = ["location_known", "location"]
    located = rides.withColumns(
        {
            "location_known": F.col("pickup_location_id").isNotNull(),
            "location": F.coalesce(F.col("pickup_location_id").cast("string"), F.lit("")),
        }
    )
    sessions = (
        _session_starts(_gap_buckets(located, keys, gap_seconds), keys, gap_seconds)
        .groupBy(*keys, "session")
        .agg(F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), *merged_sums())
        .withColumn("pickup_location_id", F.when(F.col("location_known"), F.col("location")))
    )
    end = F.col("last_ts") + F.make_dt_interval(secs=F.lit(gap_seconds))
    return metric_rows(sessions, "session_30m_gap", F.col("first_ts"), end, location=True)


def session_global(rides: DataFrame, gap_seconds: int = GAP_SECONDS) -> DataFrame:
    """Sessions over all rides, split by pickup location afterwards.

    A bucket lies in exactly one session, so sums per location and bucket meet the session's
    bounds by an equi-join on the bucket; no range join takes place.
    """
    return global_metrics(global_sessions(_gap_buckets(rides, ["pickup_location_id"], gap_seconds), gap_seconds), gap_seconds)


def global_sessions(by_location: DataFrame, gap_seconds: int = GAP_SECONDS) -> DataFrame:
    """Sums per location and gap-wide bucket with the first and last ride of the session over all locations the bucket is in."""
    overall = by_location.groupBy("bucket").agg(F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))
    members = _session_starts(overall, [], gap_seconds)
    bounds = members.groupBy("session").agg(F.min("first_ts").alias("window_start"), F.max("last_ts").alias("window_last"))
    return by_location.join(members.select("bucket", "session").join(bounds, "session"), "bucket")


def global_metrics(placed: DataFrame, gap_seconds: int = GAP_SECONDS) -> DataFrame:
    """Metric rows of ``global_sessions``, one for each session and location."""
    split = placed.groupBy("window_start", "window_last", "pickup_location_id").agg(*merged_sums())
    end = F.col("window_last") + F.make_dt_interval(secs=F.lit(gap_seconds))
    return metric_rows(split, "session_30m_gap", F.col("window_start"), end, location=True)


def unified_window_metrics(rides: DataFrame) -> DataFrame:
    return (
        tumbling_5m(rides).unionByName(sliding_15m_5m(rides)).unionByName(session_30m(rides))
    )


def tumbling_gap_fill(rides: DataFrame, value: str = "fare_amount", width: str = SLIDE) -> DataFrame:
    """Count, mean and sum per bucket, also for the empty buckets between first and last ride.

    An empty bucket has count 0, sum 0 and no mean.
    """
    filled = computed_once(
        rides.groupBy(F.window("pickup_ts", width).start.alias("window_start")).agg(F.count(value).alias("n"), F.sum(value).alias("total"))
    )
    ends = filled.agg(F.min("window_start").alias("lo"), F.max("window_start").alias("hi"))
    first, step = F.unix_timestamp("lo"), F.unix_timestamp(F.col("lo") + F.expr(f"INTERVAL {width}")) - F.unix_timestamp("lo")
    span = ends.select(((F.unix_timestamp("hi") - first) / step).cast("bigint").alias("n"), step.alias("step")).first()
    # A range of numbers is spread over the cluster, however far apart the first ride and the last.
    number = rides.sparkSession.range(0 if span.n is None else span.n + 1)
    later = F.make_dt_interval(secs=F.col("id") * F.lit(span.step or 0))
    calendar = number.select((ends.select("lo").scalar() + later).alias("window_start"))
    return calendar.join(filled, "window_start", "left").select(
        "window_start",
        F.coalesce("n", F.lit(0)).alias("ride_count"),
        F.try_divide("total", "n").alias("avg_value"),
        F.coalesce("total", F.lit(0.0)).alias("total_value"),
    )


def rolling_mean(
    rides: DataFrame,
    value: str,
    keys: tuple[str, ...] = (),
    ts: str = "pickup_ts",
    span_seconds: int = 15 * 60,
    chunk_seconds: int = 3600,
) -> DataFrame:
    """Mean of the values in (t - span, t] at each row.

    A frame walked through anew for each row costs the product of both, which grows with the square of a denser table. So time is
    cut into spans: what a frame covers is the end of one span and the beginning of the next. Every row also joins the span
    after its own as a guest, one span later. Two running sums give the rest: of a span's own rows up to the moment, and of its
    guests after it. Nothing is subtracted, so an infinite value stays within its frames. So one long series, without any key,
    still splits over the cluster. ``chunk_seconds``, once the length of a task's time, must be at least a span and changes nothing.
    """
    if chunk_seconds < span_seconds:
        raise ValueError("a chunk must be at least as long as the span")
    if span_seconds % 60:
        raise ValueError("the span must be whole minutes")
    number = F.floor(F.unix_timestamp(ts) / F.lit(span_seconds))
    later = F.col(ts) + F.make_dt_interval(secs=F.lit(span_seconds))
    places = F.array(
        F.struct(number.alias("span"), F.col(ts).alias("at"), F.lit(False).alias("guest")),
        F.struct((number + 1).alias("span"), later.alias("at"), F.lit(True).alias("guest")),
    )
    placed = rides.filter(F.col(ts).isNotNull()).withColumn("_amount", F.col(value).cast("double")).withColumn("_place", F.explode(places))
    guest, own = F.col("_place.guest"), ~F.col("_place.guest")
    # Of a guest only its amount travels.
    bare = {c: F.when(own, F.col(f"`{c}`")) for c in rides.columns if c not in keys}
    spans = Window.partitionBy(*keys, "_place.span")
    until = spans.orderBy("_place.at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    # At equal times a row comes before the guests, which lie just outside its frame.
    after = spans.orderBy(F.desc("_place.at"), "_place.guest").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = [F.when(own, F.col("_amount")), F.when(guest, F.col("_amount"))]
    total = reduce(add, [F.coalesce(F.sum(p).over(w), F.lit(0.0)) for p, w in zip(parts, (until, after))])
    count = reduce(add, [F.count(p).over(w) for p, w in zip(parts, (until, after))])
    summed = placed.withColumns(bare).withColumn("_total", total).withColumn("_n", count).filter(own)
    return summed.select(*[F.col(f"`{c}`") for c in rides.columns], F.try_divide("_total", "_n").alias("rolling_mean"))
