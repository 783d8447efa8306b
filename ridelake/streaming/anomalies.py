"""Ride anomalies on a stream, micro-batch by micro-batch or in the order of the rides' own time.

Two forms give the same rules:

* ``ride_anomalies_stream`` keeps count, sum and sum of squares per vendor in the state store
  and sees each ride once. Files split over tasks and the shuffle to the vendors leave no order of arrival within a micro-batch:
  there rides count in the order of pickup time and id. A vendor's rides of one micro-batch are put in order in one task,
  as Arrow columns; ``files_per_trigger`` of the source bounds them.
* ``anomaly_batches`` computes each micro-batch with the table operator, which cuts the rides of a vendor,
  however close in time, into chunks by their number, and keeps the totals of all vendors as a small table per batch.
  It is the one to use when few vendors carry most of the rides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ridelake.functions.clock import epoch_seconds
from ridelake.functions.ridejson import RIDE_FIELDS, parse_ride_json, to_payload
from ridelake.operators.anomalies import (
    MEAN_FACTOR,
    MIN_STD,
    PRIOR,
    STD_FACTOR,
    any_of,
    fare_totals,
    null_key,
    prior_statistics,
    rule_conditions,
    with_reasons,
)
from ridelake.operators.ordered import CHUNK_ROWS, data_cut, running_totals
from ridelake.operators.sizing import broadcast_if_small
from ridelake.sources.sinks import table_exists
from ridelake.streaming.sinks import _triggered

# Fields of an anomaly record, in order.
ANOMALY_FIELDS = (
    "ride_id",
    "vendor_id",
    "pickup_location_id",
    "fare_amount",
    "trip_distance",
    "passenger_count",
    "reasons",
    "pickup_datetime",
    "dropoff_datetime",
)

_RIDE_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in RIDE_FIELDS.items())
_STATE_SCHEMA = "prior_count bigint, prior_sum double, prior_sumsq double"

_ARROW_TYPES = {"string": pa.string(), "int": pa.int32(), "double": pa.float64()}
# Rides of a vendor as they are held to be put in order: no column has nulls.
_HELD = pa.schema([*[(name, _ARROW_TYPES[kind]) for name, kind in RIDE_FIELDS.items()], ("alone", pa.bool_()), ("moment", pa.int64())])
_ORDER = [(name, "ascending") for name in ("moment", "ride_id", "fare_amount")]
_SCORED_ROWS = 10_000


def _moment() -> Column:
    """Pickup time in microseconds; null if it cannot be read."""
    return F.round(epoch_seconds("pickup_datetime") * 1_000_000).cast("bigint")


def _elapsed() -> Column:
    return epoch_seconds("dropoff_datetime") - epoch_seconds("pickup_datetime")


def _conditions() -> dict[str, Column]:
    return rule_conditions(_elapsed())


def _alone(conditions: dict[str, Column]) -> Column:
    """Whether a rule that looks at the ride alone holds."""
    return any_of(condition for name, condition in conditions.items() if not name.startswith("fare_gt"))


class VendorTotals(StatefulProcessor):
    """Gives rides the totals of the vendor's earlier rides; only suspects are returned."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._totals = handle.getValueState("totals", _STATE_SCHEMA)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        count, total, squares = self._totals.get() if self._totals.exists() else (0, 0.0, 0.0)
        held = pa.concat_tables([pa.Table.from_pandas(batch, _HELD, preserve_index=False) for batch in rows]).combine_chunks()
        places = pc.sort_indices(held, sort_keys=_ORDER)
        for start in range(0, len(places), _SCORED_ROWS):
            batch = held.take(places[start : start + _SCORED_ROWS]).drop_columns("moment").to_pandas()
            fare = batch["fare_amount"].to_numpy()
            counts = count + np.arange(len(fare), dtype=np.int64)
            sums = np.concatenate(([total], fare)).cumsum()
            squared = np.concatenate(([squares], fare * fare)).cumsum()
            divisor = np.maximum(counts, 1)
            mean = np.where(counts > 0, sums[:-1] / divisor, 0.0)
            variance = np.maximum(0.0, squared[:-1] / divisor - mean * mean)
            std = np.where(counts >= 2, np.sqrt(variance), 0.0)
            high = (counts > 0) & (fare > MEAN_FACTOR * mean)
            far = (counts >= 2) & (std > MIN_STD) & (fare > mean + STD_FACTOR * std)
            known = batch.assign(prior_count=counts, prior_sum=sums[:-1], prior_sumsq=squared[:-1])
            suspects = known[high | far | batch["alone"].to_numpy()]
            if len(suspects):
                yield suspects
            count, total, squares = int(count + len(fare)), float(sums[-1]), float(squared[-1])
        self._totals.update((count, total, squares))

    def close(self) -> None:
        pass


def _records(suspects: DataFrame) -> DataFrame:
    return suspects.transform(prior_statistics).transform(with_reasons, _conditions()).select(*ANOMALY_FIELDS)


def anomaly_rides(raw: DataFrame) -> DataFrame:
    """Valid rides of a stream of JSON texts, with vendor key, the rules that need no state and the moment that orders them."""
    rides = null_key(parse_ride_json(raw))
    first = F.coalesce(_moment(), F.lit(-(2**63)))
    blank = {"prior_count": F.lit(0), "prior_mean": F.lit(0.0), "prior_std": F.lit(0.0)}
    return rides.withColumns(blank).withColumn("alone", _alone(_conditions())).drop(*blank).withColumn("moment", first)


def ride_anomalies_stream(raw: DataFrame) -> DataFrame:
    """Anomaly records of a stream of JSON texts; needs a session from ``stream_session``."""
    schema = f"{_RIDE_SCHEMA}, alone boolean, {_STATE_SCHEMA}"
    suspects = anomaly_rides(raw).groupBy("vendor_id").transformWithStateInPandas(
        statefulProcessor=VendorTotals(), outputStructType=schema, outputMode="Append", timeMode="None"
    )
    return _records(suspects)


def anomaly_payloads(records: DataFrame) -> DataFrame:
    return records.select(to_payload(*ANOMALY_FIELDS))


def score_batch(rides: DataFrame, before: DataFrame | None, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Anomaly records of one micro-batch, given each vendor's totals before it.

    Within the batch rides count in the order of pickup time and id.
    """
    timed = rides if "_moment" in rides.columns else rides.withColumn("_moment", _moment())
    order = ["_moment", "ride_id"]
    chunk = data_cut(timed, ["vendor_id"], order, chunk_rows)
    within = [F.col(c).asc_nulls_first() for c in order]
    running = running_totals(timed, ["vendor_id"], within, chunk, fare_totals()).drop("_moment")
    if before is not None:
        known = before.withColumnsRenamed({name: f"_{name}" for name in PRIOR})
        running = running.join(broadcast_if_small(known), "vendor_id", "left").withColumns(
            {name: F.col(name) + F.coalesce(F.col(f"_{name}"), F.lit(0)) for name in PRIOR}
        )
    return _records(running)


def totals_after(rides: DataFrame, before: DataFrame | None) -> DataFrame:
    """Each vendor's totals after a micro-batch."""
    own = rides.groupBy("vendor_id").agg(*[F.sum(expr).alias(name) for name, expr in fare_totals().items()])
    if before is None:
        return own
    return own.unionByName(before).groupBy("vendor_id").agg(*[F.sum(name).alias(name) for name in PRIOR])


def anomaly_batches(
    raw: DataFrame, target: str, state: str, checkpoint: str, interval: str | None = "60 seconds", lateness_seconds: int | None = None
) -> StreamingQuery:
    """Start the micro-batch form: records to ``target``, vendor totals to ``state``.

    Both are kept per batch: a batch that is repeated after a failure starts from the totals
    of the one before and replaces its own output.

    With ``lateness_seconds`` rides count in the order of their own time and not of arrival: a ride waits until one that much
    later has been seen, then all rides due are scored in order. One that comes later still counts when it comes.
    """
    base = state.rstrip("/")

    def handle(batch: DataFrame, batch_id: int) -> None:
        before = _of_batch(batch, base, batch_id - 1)
        batch.persist()
        due = None
        try:
            due = batch if lateness_seconds is None else _due(batch, f"{base}/waiting", batch_id, lateness_seconds)
            # Read four times: by the totals, the borders of chunks, their sums and the rows themselves.
            due = due.withColumn("_moment", _moment()).persist()
            totals_after(due, before).write.mode("overwrite").parquet(f"{base}/batch={batch_id}")
            score_batch(due, before).write.mode("overwrite").parquet(f"{target.rstrip('/')}/batch={batch_id}")
        finally:
            if due is not None:
                due.unpersist()
            batch.unpersist()

    rides = null_key(parse_ride_json(raw))
    writer = rides.writeStream.option("checkpointLocation", checkpoint).foreachBatch(handle)
    return _triggered(writer, interval).start()


def _of_batch(batch: DataFrame, base: str, batch_id: int) -> DataFrame | None:
    """What an earlier batch left; None before the first."""
    path = f"{base}/batch={batch_id}"
    if table_exists(batch.sparkSession, path):
        return batch.sparkSession.read.parquet(path)
    if batch_id >= 0:
        raise RuntimeError(f"nothing left by batch {batch_id} at {path}")
    return None


def _due(batch: DataFrame, base: str, batch_id: int, lateness_seconds: int) -> DataFrame:
    """Rides of this batch and those waiting whose time has come; the others wait on, below ``base``."""
    now = batch.withColumn("_moment", epoch_seconds("pickup_datetime"))
    before = _of_batch(batch, base, batch_id - 1)
    if before is not None:
        now = now.unionByName(before.filter("NOT _newest").drop("_newest"))
    # The newest time seen stays as a row of its own, so that it is not lost with a batch that has none.
    seen = now.select("_moment") if before is None else now.select("_moment").unionByName(before.filter("_newest").select("_moment"))
    newest = seen.agg(F.max("_moment").alias("t")).first().t
    waits = F.lit(False) if newest is None else F.coalesce(F.col("_moment") > newest - lateness_seconds, F.lit(False))
    mark = batch.sparkSession.createDataFrame([(newest, True)], "_moment double, _newest boolean")
    left = now.filter(waits).withColumn("_newest", F.lit(False)).unionByName(mark, allowMissingColumns=True)
    left.write.mode("overwrite").parquet(f"{base}/batch={batch_id}")
    return now.filter(~waits).drop("_moment")
