"""Ride anomalies over a table: rules against the vendor's earlier rides.

Statistics are those before the ride, over every earlier ride of the vendor, flagged or not,
in the order (pickup_ts, ride_id).
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.operators.ordered import CHUNK_ROWS, data_cut, running_totals

# Limits of the rules.
MAX_MILES = 100.0
MEAN_FACTOR = 3.0
STD_FACTOR = 3.0
MIN_STD = 1e-9
MAX_MPH = 100.0

Z_LIMIT = 2.5

PRIOR = ("prior_count", "prior_sum", "prior_sumsq")


def null_key(df: DataFrame, key: str = "vendor_id") -> DataFrame:
    """Rides of no vendor belong to 'unknown'."""
    return df.withColumn(key, F.coalesce(F.nullif(F.col(key), F.lit("")), F.lit("unknown")))


def fare_totals() -> dict[str, Column]:
    """Count, sum and sum of squares of the fare: sufficient, and mergeable by addition."""
    fare = F.col("fare_amount")
    return {"prior_count": F.lit(1), "prior_sum": fare, "prior_sumsq": fare * fare}


def prior_statistics(df: DataFrame) -> DataFrame:
    """Mean and population standard deviation from the three totals; both 0 without rides."""
    count, total, squares = map(F.col, PRIOR)
    mean = F.coalesce(F.try_divide(total, count), F.lit(0.0))
    variance = F.greatest(F.lit(0.0), F.try_divide(squares, count) - mean * mean)
    return df.withColumns(
        {
            "prior_mean": mean,
            "prior_std": F.when(count >= 2, F.sqrt(variance)).otherwise(F.lit(0.0)),
        }
    )


def running_vendor_stats(rides: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Count, mean and population standard deviation of the vendor's earlier fares.

    Rides count in the order of pickup time and id, nulls first; further ties are settled by a hash of the row. The chunks
    they are summed in are cut along that order: a vendor's rides of one minute, or without a time, may be several.
    """
    keyed = null_key(rides).withColumn("_tie", F.xxhash64(*[F.col(f"`{c}`") for c in rides.columns]))
    order = ["pickup_ts", "ride_id", "_tie"]
    chunk = data_cut(keyed, ["vendor_id"], order, chunk_rows)
    within = [F.col(c).asc_nulls_first() for c in order]
    return running_totals(keyed, ["vendor_id"], within, chunk, fare_totals()).drop("_tie").transform(prior_statistics)


def elapsed_seconds() -> Column:
    """Seconds from pickup to dropoff with their fraction, for either timestamp type."""
    span = (F.col("dropoff_ts") - F.col("pickup_ts")).cast("interval second")
    return span.cast("decimal(20,6)").cast("double")


def rule_conditions(elapsed: Column | None = None) -> dict[str, Column]:
    """Each rule's name with its condition over a ride and its prior statistics."""
    fare, distance, count = F.col("fare_amount"), F.col("trip_distance"), F.col("prior_count")
    mean, std = F.col("prior_mean"), F.col("prior_std")
    seconds = elapsed_seconds() if elapsed is None else elapsed
    hours = F.when(seconds > 0, seconds) / F.lit(3600.0)
    return {
        "invalid_fare_or_passengers": (fare < 0) | (F.col("passenger_count") <= 0),
        "distance_over_100_miles": distance > MAX_MILES,
        "fare_gt_3x_rolling_mean": (count > 0) & (fare > MEAN_FACTOR * mean),
        "fare_gt_mean_plus_3std": (count >= 2) & (std > MIN_STD) & (fare > mean + STD_FACTOR * std),
        "speed_over_100_mph": distance / hours > MAX_MPH,
    }


def any_of(conditions: Iterable[Column]) -> Column:
    """Whether at least one holds; an unknown one does not."""
    return reduce(Column.__or__, [F.coalesce(held, F.lit(False)) for held in conditions])


def with_reasons(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """Rows for which a condition holds, with the names of those that do.

    The plain filter runs first: names are put together for the few rows it leaves.
    """
    names = F.array(*[F.when(held, F.lit(name)) for name, held in conditions.items()])
    return df.filter(any_of(conditions.values())).withColumn("reasons", F.array_compact(names))


def ride_anomalies(rides: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Flagged rides only, each with its list of reasons."""
    return (
        running_vendor_stats(rides, chunk_rows)
        .transform(with_reasons, rule_conditions())
        .drop(*PRIOR, "prior_mean", "prior_std")
    )


def rule_hits(rides: DataFrame, rule: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Rides that one rule flags. Rules that look at the ride alone need no statistics."""
    if rule.startswith("fare_gt"):
        rides = running_vendor_stats(rides, chunk_rows)
        return rides.filter(rule_conditions()[rule]).drop(*PRIOR, "prior_mean", "prior_std")
    blank = {"prior_count": F.lit(0), "prior_mean": F.lit(0.0), "prior_std": F.lit(0.0)}
    return null_key(rides).withColumns(blank).filter(rule_conditions()[rule]).drop(*blank)


def zscore_flag(df: DataFrame, value: str, limit: float = Z_LIMIT) -> DataFrame:
    """Distance from the overall mean in population standard deviations (0 counts as 1).

    Mean and deviation come from one aggregate that the plan holds as a scalar subquery.
    """
    spread = F.stddev_pop(value)
    moments = df.agg(
        F.struct(F.avg(value).alias("mu"), F.when(spread == 0, 1.0).otherwise(spread).alias("sigma"))
    )
    return (
        df.withColumn("_moments", moments.scalar())
        .withColumn("z", (F.col(value) - F.col("_moments.mu")) / F.col("_moments.sigma"))
        .drop("_moments")
        .withColumn("is_anomaly", F.coalesce(F.abs("z") > limit, F.lit(False)))
    )


def anomaly_rate(flagged: DataFrame, value: str) -> DataFrame:
    """Share of flagged rows, and count, mean and spread of the flagged values."""
    hit = F.when(F.col("is_anomaly"), F.col(value))
    return flagged.agg(
        F.avg(F.col("is_anomaly").cast("int")).alias("anomaly_rate"),
        F.count_if("is_anomaly").alias("flagged"),
        F.avg(hit).alias("flagged_mean"),
        F.stddev_samp(hit).alias("flagged_std"),
        F.min(hit).alias("flagged_min"),
        F.max(hit).alias("flagged_max"),
    )


def anomalies_per_minute(
    flagged: DataFrame, ts: str = "pickup_ts", over: str = "5 minutes", every: str = "1 minute"
) -> DataFrame:
    """Flagged rides per minute over the last five, for every minute that has any.

    Rides are counted per minute first; only those counts are spread over the windows.
    """
    minutes = flagged.groupBy(F.window(ts, every).start.alias("minute")).agg(F.count(F.lit(1)).alias("n"))
    return (
        minutes.groupBy(F.window("minute", over, every).alias("w"))
        .agg((F.sum("n") / F.lit(5.0)).alias("anomalies_per_minute"))
        .select(
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "anomalies_per_minute"
        )
    )
