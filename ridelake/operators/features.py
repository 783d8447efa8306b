"""Feature views, point-in-time retrieval and materialisation."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.functions.scoring import expected_fare_ratio
from ridelake.operators.ordered import CHUNK_ROWS, carry_each, data_cut
from ridelake.operators.sizing import computed_once

TIMESTAMP = "event_timestamp"


@dataclass(frozen=True)
class Entity:
    name: str
    join_key: str
    dtype: str = "bigint"
    description: str = ""


@dataclass(frozen=True)
class FeatureView:
    """Features of an entity, their types, how long they hold, and where rows come from."""

    name: str
    entity: Entity
    ttl: timedelta
    fields: Mapping[str, str]
    loader: Callable[[], DataFrame] | None = None
    timestamp: str = TIMESTAMP
    tags: Mapping[str, str] = field(default_factory=dict)

    def load(self) -> DataFrame:
        """Source rows, checked for key, timestamp and features and cast to declared types."""
        if self.loader is None:
            raise ValueError(f"view {self.name} has no source")
        rows = self.loader()
        wanted = [self.entity.join_key, self.timestamp, *self.fields]
        absent = [c for c in wanted if c not in rows.columns]
        if absent:
            raise ValueError(f"view {self.name}: source lacks {absent}")
        key = self.entity.join_key
        return rows.select(
            F.col(key).cast(self.entity.dtype).alias(key),
            F.col(self.timestamp).alias(TIMESTAMP),
            *[F.col(c).cast(kind).alias(c) for c, kind in self.fields.items()],
        )

    def bind(self, loader: Callable[[], DataFrame]) -> "FeatureView":
        return FeatureView(self.name, self.entity, self.ttl, self.fields, loader, self.timestamp, self.tags)


# The entities and views served.
TAXI_ZONE = Entity("taxi_zone", "location_id", description="Pickup or dropoff zone.")
VENDOR = Entity("vendor", "vendor_id", description="Vendor of the ride.")
TIME_BUCKET = Entity("time_bucket", "hour_of_day", description="Hour of day, 0 to 23.")

HOURLY_TRIP_FEATURES = FeatureView(
    "hourly_trip_features",
    TIME_BUCKET,
    timedelta(days=1),
    {
        "avg_fare": "double",
        "avg_distance": "double",
        "avg_duration": "double",
        "trip_count": "bigint",
        "avg_speed": "double",
        "total_revenue": "double",
    },
    tags={"layer": "gold", "granularity": "hourly"},
)
ZONE_FEATURES = FeatureView(
    "zone_features",
    TAXI_ZONE,
    timedelta(days=7),
    {"zone_avg_fare": "double", "zone_trip_count": "bigint", "zone_avg_distance": "double"},
    tags={"layer": "gold", "granularity": "zone"},
)
# Daily rows are served by hour of day: the key is the day's peak hour.
DAILY_TRIP_FEATURES = FeatureView(
    "daily_trip_features",
    TIME_BUCKET,
    timedelta(days=30),
    {
        "daily_avg_fare": "double",
        "daily_trip_count": "bigint",
        "peak_hour": "bigint",
        "daily_total_revenue": "double",
    },
    tags={"layer": "gold", "granularity": "daily"},
)
VIEWS = (HOURLY_TRIP_FEATURES, ZONE_FEATURES, DAILY_TRIP_FEATURES)


@dataclass(frozen=True)
class OnDemandView:
    """Features computed from request columns and another view's features at query time."""

    name: str
    entity: Entity
    source: FeatureView
    request: Mapping[str, str]
    fields: Mapping[str, str]
    transform: Callable[[DataFrame], DataFrame]


def fare_ratio(joined: DataFrame) -> DataFrame:
    return joined.withColumn("expected_fare_ratio", expected_fare_ratio("fare_amount", "zone_avg_fare"))


FARE_PREDICTION_FEATURES = OnDemandView(
    "fare_prediction_features",
    TAXI_ZONE,
    ZONE_FEATURES,
    {"fare_amount": "double", "location_id": "bigint"},
    {"location_id": "bigint", "expected_fare_ratio": "double"},
    fare_ratio,
)


def list_views(
    spark: SparkSession, views: Sequence[FeatureView] = VIEWS, on_demand: Sequence[OnDemandView] = (FARE_PREDICTION_FEATURES,)
) -> DataFrame:
    """One row per view: name, type, entities, time to live in seconds, declared schema."""
    rows = [
        (v.name, "feature_view", [v.entity.name], v.ttl.total_seconds(), list(v.fields.items())) for v in views
    ]
    rows += [(v.name, "on_demand_feature_view", [v.entity.name], None, list(v.fields.items())) for v in on_demand]
    schema = (
        "name string, type string, entities array<string>, ttl_seconds double, "
        "schema array<struct<name: string, dtype: string>>"
    )
    return spark.createDataFrame(rows, schema)


def _wanted(refs: Sequence[str], views: Sequence[FeatureView]) -> list[tuple[FeatureView, list[str]]]:
    """Features asked for as ``view:feature``, by view; an unknown name raises."""
    known = {view.name: view for view in views}
    by_view: dict[str, list[str]] = {}
    for ref in refs:
        name, _, feature = ref.partition(":")
        if name not in known or feature not in known[name].fields:
            raise KeyError(f"no feature {ref}")
        by_view.setdefault(name, []).append(feature)
    return [(known[name], features) for name, features in by_view.items()]


def _served_as(view: FeatureView, feature: str, full_names: bool) -> str:
    return f"{view.name}__{feature}" if full_names else feature


def newest_rows(rows: DataFrame, key: str, features: Sequence[str], timestamp: str = TIMESTAMP) -> DataFrame:
    """The newest row of each key; equally new ones are settled by the features themselves.

    Per-key maxima are merged in the map tasks, so a hot key shuffles one row per task.
    """
    position = F.struct(timestamp, *features)
    return (
        rows.filter(F.col(key).isNotNull() & F.col(timestamp).isNotNull())
        .groupBy(key)
        .agg(F.max(position).alias("_row"))
        .select(key, "_row.*")
    )


def lookup_latest(
    entities: DataFrame,
    refs: Sequence[str],
    views: Sequence[FeatureView],
    full_names: bool = True,
    timestamps: bool = False,
) -> DataFrame:
    """Newest features of each entity row, whatever their age; null where none exist.

    ``timestamps`` adds the time of each view's row. The newest rows are one per key; whether
    they are broadcast is left to adaptive execution, which knows their size.
    """
    result = entities
    for view, features in _wanted(refs, views):
        key = view.entity.join_key
        served = newest_rows(view.load().select(key, TIMESTAMP, *features), key, features).select(
            key,
            *([F.col(TIMESTAMP).alias(f"{view.name}__{TIMESTAMP}")] if timestamps else []),
            *[F.col(f).alias(_served_as(view, f, full_names)) for f in features],
        )
        result = result.join(served, key, "left")
    return result


@dataclass(frozen=True)
class Served:
    """Feature rows with the columns wanted of them, the time each row is from, and how long it holds."""

    rows: DataFrame
    columns: Sequence[str]
    ttl: timedelta | None = None
    timestamp: str = TIMESTAMP


def asof_join(
    entities: DataFrame,
    features: DataFrame,
    key: str,
    columns: Sequence[str],
    ttl: timedelta | None = None,
    timestamp: str = TIMESTAMP,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """The newest feature row at or before each entity row's time, unless older than ``ttl``.

    Entity rows of no key or no time get nulls. Of feature rows of one time the greatest counts.
    """
    return asof_merge(entities, key, [Served(features, columns, ttl, timestamp)], timestamp, chunk_rows)


def asof_merge(
    entities: DataFrame, key: str, served: Sequence[Served], timestamp: str = TIMESTAMP, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """``asof_join`` with several tables of features of one entity, by one pass over their times.

    What is asked and what is offered is one row for each key and time, however many rows share it: a narrow time line, on
    which the last row of every table is carried forward. It is cut into chunks by its own rows, so neither a hot key nor a
    hot instant is one task. What was found joins the entity rows by key and time.
    """
    key_kind, time_kind = entities.schema[key].dataType, entities.schema[timestamp].dataType
    names = [f"_offer_{i}" for i in range(len(served))]

    def known(rows: DataFrame, at: str) -> DataFrame:
        return rows.filter(F.col(key).isNotNull() & F.col(at).isNotNull())

    # On equal times what is offered comes first.
    line = known(entities, timestamp).select(F.col(key).alias("_key"), F.col(timestamp).alias("_at"), F.lit(True).alias("_asked")).distinct()
    for name, table in zip(names, served):
        offered = (
            known(table.rows, table.timestamp)
            .groupBy(F.col(key).cast(key_kind).alias("_key"), F.col(table.timestamp).cast(time_kind).alias("_at"))
            .agg(F.max(F.struct(F.col(table.timestamp).alias("_ts"), *table.columns)).alias(name))
            .withColumn("_asked", F.lit(False))
        )
        line = line.unionByName(offered, allowMissingColumns=True)
    line = computed_once(line)
    order = ["_at", "_asked"]
    found = {f"_found_{i}": name for i, name in enumerate(names)}
    carried = carry_each(line, ["_key"], order, data_cut(line, ["_key"], order, chunk_rows), found).filter("_asked")
    fresh = []
    for name, table in zip(found, served):
        row = F.col(name)
        if table.ttl is not None:
            oldest = F.col("_at") - F.make_dt_interval(secs=F.lit(table.ttl.total_seconds()))
            row = F.when(F.col(f"{name}._ts").cast(time_kind) >= oldest, row)
        fresh += [row[c].alias(c) for c in table.columns]
    answers = carried.select("_key", "_at", *fresh)
    matched = (F.col(key) == F.col("_key")) & (F.col(timestamp) == F.col("_at"))
    return entities.join(answers, matched, "left").drop("_key", "_at")


def get_historical(
    entities: DataFrame,
    refs: Sequence[str],
    views: Sequence[FeatureView],
    full_names: bool = True,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Point-in-time features of several views on one entity table; views of one entity are merged in one pass.

    Entity rows without a time column are asked as of now. No entity rows is an error.
    """
    if entities.isEmpty():
        raise ValueError("entity rows must not be empty")
    if TIMESTAMP not in entities.columns:
        # One moment for all steps that follow.
        now = entities.sparkSession.range(1).select(F.unix_micros(F.current_timestamp()).alias("n")).first().n
        entities = entities.withColumn(TIMESTAMP, F.timestamp_micros(F.lit(now)))
    by_key: dict[str, list[Served]] = {}
    for view, features in _wanted(refs, views):
        names = [_served_as(view, f, full_names) for f in features]
        key = view.entity.join_key
        rows = view.load().select(key, TIMESTAMP, *[F.col(f).alias(n) for f, n in zip(features, names)])
        by_key.setdefault(key, []).append(Served(rows, names, view.ttl))
    result = entities
    for key, served in by_key.items():
        result = asof_merge(result, key, served, chunk_rows=chunk_rows)
    return result


def on_demand(
    entities: DataFrame, view: OnDemandView, source: FeatureView | None = None, transform: Callable | None = None
) -> DataFrame:
    """Request rows with the newest features of the view's source, then its transformation.

    ``transform`` may be any function from DataFrame to DataFrame, a pandas UDF inside included.
    """
    source = source or view.source
    joined = lookup_latest(
        entities, [f"{source.name}:{f}" for f in source.fields], [source], full_names=False
    )
    return (transform or view.transform)(joined)


def materialize(view: FeatureView, start: datetime | Column, end: datetime | Column) -> DataFrame:
    """The newest row of each key with ``start <= time <= end``."""
    rows = view.load()
    kind = rows.schema[TIMESTAMP].dataType
    low, high = (F.lit(bound).cast(kind) for bound in (start, end))
    within = rows.filter((F.col(TIMESTAMP) >= low) & (F.col(TIMESTAMP) <= high))
    return newest_rows(within, view.entity.join_key, list(view.fields))
