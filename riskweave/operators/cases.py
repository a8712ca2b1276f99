"""Case workflow: idempotent creation, review actions folded into state, audit trail.

Actions are applied in the order of their unique ``action_id``. An alert with a bounded number of
actions is folded in one aggregate. For busier ones, an action maps a status to a status, so any run of actions is summed up by where it takes each of the four statuses, and runs
of runs likewise. Actions are laid out by alert and id, summed up over groups of a bounded number,
these again, until every alert is one group; then every group's start is handed down to what it
holds. So an alert with very many actions is folded in parallel, and no array is longer than a
group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.session import materialise

# Allowed moves and closing dispositions.
TRANSITIONS = {
    "OPEN": ("IN_REVIEW",),
    "IN_REVIEW": ("ESCALATED", "CLOSED"),
    "ESCALATED": ("IN_REVIEW", "CLOSED"),
    "CLOSED": (),
}
DISPOSITIONS = ("FALSE_POSITIVE", "FURTHER_REVIEW", "CLEARED")
STATUSES = tuple(TRANSITIONS)

# Actions, or groups of them, that are summed up together.
RUN_ROWS = 256
# Actions laid out in one partition.
PART_ROWS = 1_000_000
STATE = ("status", "investigator_notes", "disposition", "reason_code", "reviewed_at")
REVIEW_ACTION = "HUMAN_REVIEW"


def new_cases(alerts: DataFrame, existing: DataFrame) -> DataFrame:
    """Alerts that have no case yet; those that have one keep it untouched."""
    return alerts.join(existing.select("alert_id"), "alert_id", "left_anti")


def seed_cases(alerts: DataFrame, existing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(all cases, CREATE audit rows of the new ones only)."""
    fresh = new_cases(alerts, existing)
    audit = fresh.select(
        "alert_id",
        F.lit("pipeline").alias("actor"),
        F.lit("CREATE").alias("action"),
        F.col("created_at").alias("timestamp"),
        F.lit(None).cast(_state_type(fresh)).alias("before_state"),
        F.struct(*STATE).alias("after_state"),
    )
    return existing.unionByName(fresh), audit


def _state_type(frame: DataFrame):
    return frame.select(F.struct(*STATE).alias("s")).schema["s"].dataType


def get_cases(cases: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cases of the requested ids, requested ids without a case)."""
    wanted = requests.select("alert_id").distinct()
    return (
        cases.join(wanted, "alert_id", "left_semi"),
        wanted.join(cases.select("alert_id"), "alert_id", "left_anti"),
    )


def list_cases(cases: DataFrame, limit: int = 100, offset: int = 0, status: str | None = None) -> DataFrame:
    chosen = cases if status is None else cases.where(F.col("status") == status)
    return chosen.orderBy("alert_id").offset(offset).limit(limit)


def _blank(column: str) -> Column:
    """Null, empty, or nothing but white space of any kind."""
    return ~F.coalesce(F.col(column), F.lit("")).rlike(r"(?U)\S")


def action_problem() -> tuple[Column, Column]:
    """What is wrong with an action whatever the state: checked before and after the move itself."""
    before = F.when(_blank("actor") | _blank("notes"), "ACTOR_AND_NOTES_REQUIRED").when(
        F.col("case_status").isNull(), "UNKNOWN_ALERT"
    )
    closes = F.col("status") == "CLOSED"
    valid_close = F.coalesce(F.col("disposition").isin(*DISPOSITIONS), F.lit(False)) & (
        F.coalesce(F.col("reason_code"), F.lit("")) != ""
    )
    after = F.when(closes & ~valid_close, "CLOSE_NEEDS_DISPOSITION_AND_REASON").when(
        ~closes & F.col("disposition").isNotNull(), "DISPOSITION_ONLY_ON_CLOSE"
    )
    return before, after


def _maps() -> Column:
    """An action as a map: for each status, the status after it, and its id if it is accepted there."""
    sound = F.col("before_problem").isNull() & F.col("after_problem").isNull()

    def image(status: str) -> Column:
        moved = sound & F.coalesce(F.col("status").isin(*TRANSITIONS[status]), F.lit(False))
        return F.struct(
            F.when(moved, F.col("status")).otherwise(F.lit(status)).alias("status"),
            F.when(moved, F.col("action_id")).alias("last"),
        )

    return F.array(*map(image, STATUSES))


def _through(state: Column, image: Column) -> Column:
    """A state (status, last accepted action) after a map."""
    place = F.array_position(F.array(*map(F.lit, STATUSES)), state["status"]).cast("int")
    reached = F.get(image, place - 1)
    return F.struct(reached["status"].alias("status"), F.coalesce(reached["last"], state["last"]).alias("last"))


def _summed(items: DataFrame) -> DataFrame:
    """Groups of items: (alert_id, at, image, items), an image being where a group takes each status."""
    none = F.lit(None).cast("bigint")
    same = F.array(*[F.struct(F.lit(s).alias("status"), none.alias("last")) for s in STATUSES])
    groups = items.groupBy("alert_id", F.col("group").alias("at")).agg(
        F.sort_array(F.collect_list(F.struct("at", "image"))).alias("items")
    )
    whole = F.aggregate("items", same, lambda state, item: F.transform(state, lambda x: _through(x, item["image"])))
    return groups.withColumn("image", whole)


def _started(groups: DataFrame, starts: DataFrame) -> DataFrame:
    """(alert_id, at, start) of the items of groups whose starts are known."""

    def step(state: Column, item: Column) -> Column:
        here = F.struct(item["at"].alias("at"), state["now"].alias("start"))
        return F.struct(
            _through(state["now"], item["image"]).alias("now"), F.concat(state["seen"], F.array(here)).alias("seen")
        )

    state = "struct<status:string,last:bigint>"
    kind = f"struct<now:{state},seen:array<struct<at:bigint,start:{state}>>>"
    begin = F.struct(F.col("start").alias("now"), F.array().alias("seen")).cast(kind)
    rows = groups.join(starts, ["alert_id", "at"])
    rows = rows.select("alert_id", F.explode(F.aggregate("items", begin, lambda s, i: step(s, i).cast(kind))["seen"]).alias("x"))
    return rows.select("alert_id", "x.at", "x.start")


def _verdict(status: Column, action: Column) -> Column:
    """Why an action is refused in a status, or null."""
    allowed = F.lit(False)
    for name, targets in TRANSITIONS.items():
        allowed = allowed | ((status == name) & action["status"].isin(*targets))
    moved = F.when(~F.coalesce(allowed, F.lit(False)), "INVALID_TRANSITION")
    return F.coalesce(action["before_problem"], moved, action["after_problem"])


def _folded_whole(known: DataFrame) -> DataFrame:
    """(action_id, status_before, action_before, problem), an alert's actions in one aggregate."""
    action = F.struct("action_id", "status", "before_problem", "after_problem")
    alerts = known.groupBy("alert_id").agg(F.sort_array(F.collect_list(action)).alias("items"), F.first("case_status").alias("status"))
    row = "struct<action_id:bigint,status_before:string,action_before:bigint,problem:string>"
    kind = f"struct<status:string,last:bigint,seen:array<{row}>>"
    begin = F.struct(F.col("status"), F.lit(None).alias("last"), F.array().alias("seen")).cast(kind)

    def step(state: Column, item: Column) -> Column:
        problem = _verdict(state["status"], item)
        here = F.struct(
            item["action_id"].alias("action_id"), state["status"].alias("status_before"),
            state["last"].alias("action_before"), problem.alias("problem"),
        )
        return F.struct(
            F.when(problem.isNull(), item["status"]).otherwise(state["status"]).alias("status"),
            F.when(problem.isNull(), item["action_id"]).otherwise(state["last"]).alias("last"),
            F.concat(state["seen"], F.array(here)).alias("seen"),
        ).cast(kind)

    return alerts.select(F.explode(F.aggregate("items", begin, step)["seen"]).alias("x")).select("x.*")


def _folded(known: DataFrame, run_rows: int) -> DataFrame:
    """(action_id, status_before, action_before, problem) of actions on known alerts."""
    known = materialise(known)
    busy = materialise(known.groupBy("alert_id").count().where(F.col("count") > run_rows).select("alert_id"))
    if busy.isEmpty():
        return _folded_whole(known)
    short = known.join(busy, "alert_id", "left_anti").select(known.columns)
    long = known.join(busy, "alert_id", "left_semi").select(known.columns)
    return _folded_whole(short).unionByName(_folded_in_levels(long, run_rows))


def _folded_in_levels(known: DataFrame, run_rows: int) -> DataFrame:
    """The same for alerts with any number of actions: runs summed up, then runs of runs."""
    parts = max(1, -(-known.count() // PART_ROWS))
    laid = known.repartitionByRange(parts, "alert_id", "action_id").sortWithinPartitions("alert_id", "action_id")
    laid = materialise(laid.withColumn("at", F.monotonically_increasing_id()))
    levels, items = [], laid.select("alert_id", "at", _maps().alias("image"))
    while True:
        groups = materialise(_summed(items.withColumn("group", F.floor(F.col("at") / run_rows))))
        levels.append(groups)
        if groups.groupBy("alert_id").count().where("count > 1").isEmpty():
            break
        items = groups.drop("items")
    first = F.struct(F.col("case_status").alias("status"), F.lit(None).cast("bigint").alias("last")).alias("start")
    alerts = laid.select("alert_id", "case_status").distinct()
    starts = levels[-1].select("alert_id", "at").join(alerts, "alert_id").select("alert_id", "at", first)
    for groups in reversed(levels):
        starts = _started(groups, starts)
    rows = laid.join(starts, ["alert_id", "at"])
    action = F.struct("status", "before_problem", "after_problem")
    return rows.select(
        "action_id", F.col("start.status").alias("status_before"), F.col("start.last").alias("action_before"),
        _verdict(F.col("start.status"), action).alias("problem"),
    )


def apply_actions(cases: DataFrame, actions: DataFrame, run_rows: int = RUN_ROWS) -> tuple[DataFrame, DataFrame]:
    """(audit rows of accepted actions, refused actions with the reason).

    Actions that share an ``action_id`` have no order among them: all are refused.
    """
    before, after = action_problem()
    repeated = materialise(actions.groupBy("action_id").count().where("count > 1").select("action_id"))
    single = actions.join(repeated, "action_id", "left_anti").select(actions.columns)
    checked = (
        single.join(
            cases.select("alert_id", F.col("status").alias("case_status")), "alert_id", "left"
        )
        .withColumn("before_problem", before)
        .withColumn("after_problem", after)
    )
    known = checked.where("case_status is not null").select(
        "alert_id", "action_id", "status", "before_problem", "after_problem", "case_status"
    )
    judged = single.join(_folded(known, run_rows), "action_id")
    unknown = (
        checked.where("case_status is null")
        .select(*actions.columns, F.col("before_problem").alias("problem"))
    )
    again = actions.join(repeated, "action_id", "left_semi").select(
        *actions.columns, F.lit("REPEATED_ACTION_ID").alias("problem")
    )
    refused = judged.where("problem is not null").select(*actions.columns, "problem")
    return _audit(cases, judged.where("problem is null")), refused.unionByName(unknown).unionByName(again)


def _state_after() -> Column:
    return F.struct(
        F.col("status"),
        F.col("notes").alias("investigator_notes"),
        F.col("disposition"),
        F.col("reason_code"),
        F.col("acted_at").alias("reviewed_at"),
    )


def _audit(cases: DataFrame, accepted: DataFrame) -> DataFrame:
    """Before and after of each accepted action; before is the last accepted one, or the case."""
    earlier = accepted.select(F.col("action_id").alias("action_before"), _state_after().alias("earlier"))
    initial = cases.select("alert_id", F.struct(*STATE).alias("initial"))
    return (
        accepted.join(earlier, "action_before", "left")
        .join(initial, "alert_id")
        .select(
            "action_id", "alert_id", "actor",
            F.lit(REVIEW_ACTION).alias("action"),
            F.col("acted_at").alias("timestamp"),
            F.coalesce("earlier", "initial").alias("before_state"),
            _state_after().alias("after_state"),
        )
    )


def case_snapshot(cases: DataFrame, audit: DataFrame) -> DataFrame:
    """Cases with the state of their last accepted action."""
    latest = audit.groupBy("alert_id").agg(F.max_by("after_state", "action_id").alias("latest"))
    rest = [c for c in cases.columns if c not in STATE]
    state = [F.coalesce(F.col(f"latest.{c}"), F.col(c)).alias(c) if c == "status"
             else F.when(F.col("latest").isNotNull(), F.col(f"latest.{c}")).otherwise(F.col(c)).alias(c)
             for c in STATE]
    return cases.join(latest, "alert_id", "left").select(*rest, *state).select(*cases.columns)
