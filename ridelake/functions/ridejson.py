"""Ride events as JSON text: reading and writing.

Reading goes through VARIANT: the text is parsed once, a field that cannot be cast becomes
null on its own, and a missing field can be told from a JSON null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.functions.clock import as_column

# Fields of a ride event, in order, with the type each is declared to have.
RIDE_FIELDS = {
    "ride_id": "string",
    "vendor_id": "string",
    "pickup_datetime": "string",
    "dropoff_datetime": "string",
    "passenger_count": "int",
    "trip_distance": "double",
    "fare_amount": "double",
    "pickup_location_id": "string",
    "dropoff_location_id": "string",
}

# Timestamps in JSON keep their microseconds.
JSON_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"}

# What a missing field stands for, by type.
MISSING = {"string": "", "int": 0, "double": 0.0}


def _once(value: Column) -> Column:
    """A value that filters on it do not compute a second time, as they are not moved before a generator."""
    return F.explode(F.array(value))


def _objects(df: DataFrame, raw: str | Column) -> DataFrame:
    """Texts whose JSON is an object: they begin with a brace behind JSON's white space."""
    text = as_column(raw)
    begun = df.filter(F.ltrim(text, F.lit(" \t\n\r")).startswith("{"))
    return begun.select(_once(F.try_parse_json(text)).alias("_ride")).filter(F.col("_ride").isNotNull())


def read_ride_fields(df: DataFrame, raw: str | Column = "value") -> DataFrame:
    """Declared fields of each event: missing or uncastable gives null, broken JSON no row."""
    fields = [F.try_variant_get("_ride", f"$.{name}", kind).alias(name) for name, kind in RIDE_FIELDS.items()]
    return _objects(df, raw).select(*fields)


def parse_ride_json(df: DataFrame, raw: str | Column = "value") -> DataFrame:
    """Strict reading for anomaly detection.

    A missing field takes the stand-in of its type; an event with a JSON null or a value
    that cannot be cast in any field is dropped, as is broken or non-object JSON.
    """
    checked = []
    for name, kind in RIDE_FIELDS.items():
        present = F.try_variant_get("_ride", f"$.{name}", "variant").isNotNull()
        value = F.try_variant_get("_ride", f"$.{name}", kind)
        checked.append(F.when(present, value).otherwise(F.lit(MISSING[kind]).cast(kind)).alias(name))
    return _objects(df, raw).select(_once(F.struct(*checked)).alias("_ride")).select("_ride.*").na.drop("any")


def to_payload(*columns: str, alias: str = "payload") -> Column:
    """The named columns (all, if none is named) as one JSON object."""
    return F.to_json(F.struct(*(columns or ("*",))), JSON_TIMES).alias(alias)
