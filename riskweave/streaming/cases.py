"""Alerts and review actions as streams."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType

from riskweave.operators.cases import TRANSITIONS, action_problem, new_cases
from riskweave.session import materialise
from riskweave.sources import key_index


def stored_cases(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """Cases written so far, with the batch that brought them."""
    return spark.read.schema(StructType([*schema.fields, StructField("batch", LongType())])).parquet(root)


def case_writer(root: str, schema: StructType):
    """Batch function that adds alerts without a case; safe to repeat for the same batch.

    It reads the filters of all batches, and of the cases only the batches that may hold an alert.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        alerts = materialise(batch.dropDuplicates(["alert_id"]))
        known = key_index.filters(spark, f"{root}-keys").where(F.col("batch") != str(batch_id))
        fresh = alerts
        for held in key_index.batches_with(alerts, "alert_id", known):
            # A filter is written before its batch, which may be missing after a break.
            fresh = new_cases(fresh, stored_cases(spark, root, schema).where(F.col("batch") == int(held)))
        fresh = materialise(fresh)
        key_index.add(fresh, "alert_id", f"{root}-keys", str(batch_id))
        fresh.write.mode("overwrite").parquet(f"{root}/batch={batch_id}")

    return write


def seed_cases_from(alerts: DataFrame, root: str, checkpoint: str) -> None:
    """Drain a stream of alerts into the case table, which is made if it is not there yet."""
    empty = alerts.sparkSession.createDataFrame([], alerts.schema)
    empty.write.mode("ignore").parquet(f"{root}/batch=-1")
    (
        alerts.writeStream.foreachBatch(case_writer(root, alerts.schema))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    )


VERDICT = "action_id bigint, alert_id string, status_before string, status_after string, problem string"
COLUMNS = ["action_id", "alert_id", "status_before", "status_after", "problem"]
#: Alerts are dealt out by hash to so many shards; a shard is one call and one state a micro-batch, as a
#: call for every alert costs milliseconds. Fixed for the life of a checkpoint.
SHARDS = 1024
STATE = "alerts array<string>, status array<string>, last array<bigint>"
HELD = STATE.replace(", last array<bigint>", "") + (
    ", held_alert array<string>, held_action array<bigint>, held_at array<bigint>, held_status array<string>,"
    " held_before array<string>, held_after array<string>"
)


def _plain(frames: Iterator[pd.DataFrame], columns: list[str]) -> list[tuple]:
    """Rows of frames as tuples with None for what is missing."""
    out = []
    for frame in frames:
        frame = frame[columns].astype(object)
        out += frame.where(frame.notna(), None).itertuples(index=False, name=None)
    return out


def _verdicts(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=COLUMNS)


def _sharded(actions: DataFrame, shards: int) -> DataFrame:
    """Actions with what is wrong with them whatever the state, and their alert's shard."""
    before, after = action_problem()
    return (
        actions.withColumn("case_status", F.lit("OPEN"))
        .withColumn("before_problem", before)
        .withColumn("after_problem", after)
        .withColumn("shard", F.pmod(F.xxhash64("alert_id"), F.lit(shards)))
    )


def _fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Fold a shard's actions of one micro-batch, in action order, onto its alerts' kept statuses.

    The rows of a shard are at most those of a micro-batch, whose size the reader bounds.
    An action older than one already applied to its alert is refused, never slotted in afterwards.
    """
    alerts, statuses, lasts = state.get if state.exists else ([], [], [])
    kept = dict(zip(alerts, zip(statuses, lasts, strict=True), strict=True))
    rows = _plain(batches, ["action_id", "alert_id", "status", "before_problem", "after_problem"])
    out = []
    for action, alert, target, before, after in sorted(rows, key=lambda r: r[0]):
        status, last = kept.get(alert, ("OPEN", -1))
        problem = before
        if problem is None and action <= last:
            problem = "OUT_OF_ORDER"
        if problem is None and target not in TRANSITIONS[status]:
            problem = "INVALID_TRANSITION"
        problem = problem or after
        out.append((action, alert, status, status if problem else target, problem))
        kept[alert] = (status, last) if problem else (target, action)
    state.update((list(kept), [s for s, _ in kept.values()], [n for _, n in kept.values()]))
    yield _verdicts(out)


def fold_actions(actions: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Verdict on every action of a stream; an alert's status is kept between micro-batches.

    Every alert starts as OPEN; actions on alerts that do not exist belong to an earlier check.
    """
    checked = _sharded(actions, shards).select("shard", "alert_id", "action_id", "status", "before_problem", "after_problem")
    return checked.groupBy("shard").applyInPandasWithState(_fold, VERDICT, STATE, "append", GroupStateTimeout.NoTimeout)


def _fold_in_time(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Hold a shard's actions until the watermark has passed them, then fold them in action order.

    The shard's timer goes off when the watermark passes its earliest held action. What it has passed
    is folded and leaves the state, what is later stays held; alerts' statuses are kept.
    """
    passed = state.getCurrentWatermarkMs()
    alerts, statuses, *held = state.get if state.exists else [[] for _ in range(8)]
    kept, held = dict(zip(alerts, statuses, strict=True)), list(zip(*held, strict=True))
    out = []
    if not state.hasTimedOut:
        for row in _plain(batches, ["alert_id", "action_id", "at", "status", "before_problem", "after_problem"]):
            if row[2] <= passed:
                now = kept.get(row[0], "OPEN")
                out.append((row[1], row[0], now, now, row[4] or "OUT_OF_ORDER"))
            else:
                held.append(row)
    for alert, action, _, target, before, after in sorted((r for r in held if r[2] <= passed), key=lambda r: r[1]):
        status = kept.get(alert, "OPEN")
        problem = before or (None if target in TRANSITIONS[status] else "INVALID_TRANSITION") or after
        out.append((action, alert, status, status if problem else target, problem))
        kept[alert] = out[-1][3]
    rest = [r for r in held if r[2] > passed]
    state.update((list(kept), list(kept.values()), *([list(c) for c in zip(*rest, strict=True)] or [[] for _ in range(6)])))
    if rest:
        # A timer goes off once the watermark is above it, not when it is there.
        state.setTimeoutTimestamp(min(r[2] for r in rest) - 1)
    yield _verdicts(out)


def fold_actions_in_time(actions: DataFrame, delay: str, shards: int = SHARDS) -> DataFrame:
    """The verdicts of the batch fold on a stream whose actions may come in any order within ``delay``.

    Ids of an alert's actions grow with their time. An action's verdict comes once the watermark, the
    latest time seen less the delay, has passed it; later ones than that are refused as ``OUT_OF_ORDER``
    or dropped by the watermark. Held actions and timers lie in the state store, so a restart from the
    checkpoint goes on where it was.
    """
    checked = _sharded(actions.withWatermark("acted_at", delay), shards).withColumn("at", F.unix_millis("acted_at"))
    checked = checked.select("shard", "alert_id", "action_id", "acted_at", "at", "status", "before_problem", "after_problem")
    return checked.groupBy("shard").applyInPandasWithState(
        _fold_in_time, VERDICT, HELD, "append", GroupStateTimeout.EventTimeTimeout
    )
