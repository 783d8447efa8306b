"""Row-level expressions on trips and ride events."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.functions.clock import as_column

# The columns of the fallback merge key, in order.
FALLBACK_KEY = (
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "total_amount",
)

# The columns of the merge key where both location ids are known, in order.
LOCATED_KEY = (
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "PULocationID",
    "DOLocationID",
)

# First hour and first hour after each part of the day; the rest is night.
JOB_BANDS = {"morning": (5, 12), "afternoon": (12, 17), "evening": (17, 21)}
NOTEBOOK_BANDS = {"morning": (6, 12), "afternoon": (12, 17), "evening": (17, 22)}


def merge_key(columns: Iterable[str], null_safe: bool = False) -> Column:
    """SHA-256 that identifies a trip.

    ``concat_ws`` leaves nulls out, so two different null patterns of the located key can
    collide. That is the established key; ``null_safe=True`` marks nulls instead.
    """
    present = set(columns)
    located = {"PULocationID", "DOLocationID"} <= present
    parts = LOCATED_KEY if located else [c for c in FALLBACK_KEY if c in present]
    texts = [F.col(c).cast("string") for c in parts]
    if null_safe:
        texts = [F.coalesce(t, F.lit("\\N")) for t in texts]
    elif not located:
        texts = [F.coalesce(t, F.lit("")) for t in texts]
    return F.sha2(F.concat_ws("|", *texts), 256)


def positive(value: str | Column) -> Column:
    """The value where it is above zero, else null."""
    value = as_column(value)
    return F.when(value > 0, value)


def capped(value: Column, cap: float | None) -> Column:
    """The value, not above ``cap``; null stays null (``least`` would turn it into the cap)."""
    return value if cap is None else F.when(value > cap, F.lit(float(cap))).otherwise(value)


def part_of_day(hour: Column, bands: Mapping[str, tuple[int, int]] = JOB_BANDS) -> Column:
    named = [F.when((hour >= first) & (hour < after), F.lit(name)) for name, (first, after) in bands.items()]
    return F.coalesce(*named, F.lit("night"))


def weekend(day_of_week: Column) -> Column:
    """Sunday is 1 and Saturday 7; an unknown day is not a weekend."""
    return F.coalesce(day_of_week.isin(1, 7), F.lit(False))


def grid_id(lat: str, lon: str, digits: int = 2) -> Column:
    return F.concat_ws("_", *[F.round(F.col(c), digits).cast("string") for c in (lat, lon)])


# The names each trip column goes by, by preference.
NAME_VARIANTS = {
    "VendorID": ("vendor_id", "VendorID"),
    "tpep_pickup_datetime": ("tpep_pickup_datetime", "lpep_pickup_datetime", "pickup_datetime"),
    "tpep_dropoff_datetime": ("tpep_dropoff_datetime", "lpep_dropoff_datetime", "dropoff_datetime"),
    "PULocationID": ("PULocationID", "pickup_location_id"),
    "DOLocationID": ("DOLocationID", "dropoff_location_id"),
}


def resolve_columns(
    df: DataFrame, variants: Mapping[str, Sequence[str]] = NAME_VARIANTS, optional: Sequence[str] = ()
) -> DataFrame:
    """Give every column its canonical name, whichever variant the file came with.

    Names in ``optional`` may be missing; any other raises.
    """
    found = {canonical: [n for n in names if n in df.columns] for canonical, names in variants.items()}
    lacking = [c for c, names in found.items() if not names and c not in optional]
    if lacking:
        raise KeyError(f"no column for {lacking}; there are {df.columns}")
    renames = {names[0]: canonical for canonical, names in found.items() if names}
    # A less preferred variant that bears a canonical name makes way.
    df = df.drop(*[c for c in set(renames.values()) - set(renames) if c in df.columns])
    return df.withColumnsRenamed(renames)


def map_labels(code: str | Column, names: Mapping[int, str]) -> Column:
    """Name of a code; null for a code without one."""
    return F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[as_column(code)]


def ratio_features(df: DataFrame, sepal: tuple[str, str], petal: tuple[str, str]) -> DataFrame:
    """Two areas and their ratio; 1e-8 in the divisor keeps a zero area finite."""
    return df.withColumns(
        {
            "petal_area": F.col(petal[0]) * F.col(petal[1]),
            "sepal_area": F.col(sepal[0]) * F.col(sepal[1]),
        }
    ).withColumn("petal_sepal_ratio", F.col("petal_area") / (F.col("sepal_area") + F.lit(1e-8)))
