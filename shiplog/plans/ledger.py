"""Run and import ledgers, both append-only.

An import is a sequence of events; its current state is a fold over them:

  created    names the scope and the watermark
  advanced   sets the cursor (which may be NULL) and adds to the number of processed units
  reset      failed -> in progress, clears the message
  completed  keeps any message
  failed     sets the message, keeps the cursor
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplog import schemas
from shiplog.functions.temporal import days_before

IN_PROGRESS, COMPLETED, FAILED = "in_progress", "completed", "failed"

# Fixed values stored in the ledger.
MERGE_REQUEST_IMPORT = "merge_requests"
USAGE_IMPORT = "copilot_users_1_day"
_ORG_PREFIX = "github_org:"


def org_key(org: Column) -> Column:
    return F.concat(F.lit(_ORG_PREFIX), org)


def import_status(text: Column) -> Column:
    """A stored status; anything unknown counts as failed."""
    return F.when(text.isin(IN_PROGRESS, COMPLETED), text).otherwise(FAILED)


def import_states(events: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """What a fold has to keep of every import, from events and the states `before` them.

    States of events and of later events make the states of all: the latest event of each kind, the
    first `created` and a sum. An event that lies there twice counts once.
    """
    event = F.col("event")
    seq = F.struct(*[f for f in schemas.EVENT_ORDER.fieldNames()])
    scope = F.struct("group_full_path", "import_type", "updated_after")
    of = {
        "created": F.when(event == "created", F.struct(seq.alias("event"), scope.alias("scope"))),
        "advanced": F.when(event == "advanced", seq),
        "completed": F.when(event == "completed", seq),
        "turned": F.when(event.isin("created", "reset", "completed", "failed"), seq),
        "told": F.when(event.isin("reset", "failed"), seq),
        "last": seq,
        "total": F.when(event == "advanced", F.col("n")),
    }
    single = events.distinct().select("import_id", *[c.alias(name) for name, c in of.items()])
    if before is not None:
        single = single.unionByName(before)
    return single.groupBy("import_id").agg(
        F.min("created").alias("created"),
        *[F.max(c).alias(c) for c in ("advanced", "completed", "turned", "told", "last")],
        F.sum("total").alias("total"),
    )


def fold_imports(events: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """Current state of every created import. Events of unknown imports have no effect.

    An event that lies there twice counts once. Events of one number, as two jobs that run at
    once may write, go by time, kind and content. With `before`, states of earlier events, only
    the later ones are folded.
    """
    turn = F.col("turned.event")
    status = F.when(turn.isin("created", "reset"), IN_PROGRESS).when(
        turn == "completed", COMPLETED
    )
    failed = F.col("told.event") == "failed"
    return (
        import_states(events, before)
        .filter(F.col("created").isNotNull())
        .select(
            "import_id",
            "created.scope.*",
            F.col("advanced.cursor").alias("last_cursor"),
            F.coalesce("total", F.lit(0)).cast("int").alias("total_processed"),
            import_status(F.coalesce(status, F.lit(FAILED))).alias("status"),
            F.col("created.event.at").alias("started_at"),
            F.col("last.at").alias("last_activity_at"),
            F.col("completed.at").alias("completed_at"),
            F.when(failed, F.col("told.message")).alias("error_message"),
            F.col("last.seq").alias("last_seq"),
        )
    )


def latest_resumable(imports: DataFrame) -> DataFrame:
    """The latest import of every (group, type) that is in progress or failed."""
    rest = [c for c in imports.columns if c not in ("group_full_path", "import_type")]
    return (
        imports.filter(F.col("status").isin(IN_PROGRESS, FAILED))
        .groupBy("group_full_path", "import_type")
        .agg(F.max_by(F.struct(*rest), F.struct("started_at", "import_id")).alias("_l"))
        .select("group_full_path", "import_type", "_l.*")
    )


def import_id(group: Column, import_type: Column, started_at: Column, number: Column) -> Column:
    """The same on every attempt of a task, unlike a random id.

    `number` counts the earlier imports of the scope: a scheduler may start several with the
    same time.
    """
    micros = F.unix_micros(started_at).cast("string")
    return F.sha2(F.concat_ws("|", group, import_type, micros, number.cast("string")), 256)


def resume_or_create(scopes: DataFrame, imports: DataFrame, as_of: Column) -> DataFrame:
    """The import to run for every scope (group_full_path, import_type, updated_after).

    A resumable import goes on with its own watermark and cursor, whatever the scope asks for.
    `action` is resume, reset (it had failed) or create.
    """
    open_imports = latest_resumable(imports).select(
        "group_full_path",
        "import_type",
        F.struct(
            "import_id", "updated_after", "last_cursor", "total_processed", "status",
            "last_seq",
        ).alias("_open"),
    )
    scope = ["group_full_path", "import_type"]
    earlier = imports.groupBy(*scope).agg(F.count(F.lit(1)).alias("_earlier"))
    found = F.col("_open").isNotNull()
    number = F.coalesce("_earlier", F.lit(0))
    new_id = import_id(F.col("group_full_path"), F.col("import_type"), as_of, number)
    known = scopes.join(open_imports, scope, "left").join(earlier, scope, "left")
    return known.select(
        "group_full_path",
        "import_type",
        F.coalesce("_open.import_id", new_id).alias("import_id"),
        F.coalesce("_open.updated_after", "updated_after").alias("updated_after"),
        F.col("_open.last_cursor").alias("last_cursor"),
        F.coalesce("_open.total_processed", F.lit(0)).alias("total_processed"),
        F.when(~found, "create")
        .when(F.col("_open.status") == FAILED, "reset")
        .otherwise("resume")
        .alias("action"),
        F.coalesce("_open.last_seq", F.lit(0)).cast("bigint").alias("last_seq"),
    )


def event_rows(
    rows: DataFrame,
    event: Column | str,
    at: Column,
    *,
    step: int,
    cursor: Column | None = None,
    n: Column | None = None,
    message: Column | None = None,
) -> DataFrame:
    """Ledger events for rows that carry import_id and last_seq; `step` orders them in a run.

    Rows that are to create an import also carry its scope and watermark.
    """
    event = F.lit(event) if isinstance(event, str) else event
    nothing = F.lit(None)
    scope = {"group_full_path": "string", "import_type": "string", "updated_after": "timestamp"}
    return rows.select(
        "import_id",
        *[
            (F.when(event == "created", F.col(c)) if c in rows.columns else nothing)
            .cast(t)
            .alias(c)
            for c, t in scope.items()
        ],
        (F.col("last_seq") + step).cast("bigint").alias("seq"),
        event.alias("event"),
        (nothing if cursor is None else cursor).cast("string").alias("cursor"),
        (nothing if n is None else n).cast("bigint").alias("n"),
        (nothing if message is None else message).cast("string").alias("message"),
        at.cast("timestamp").alias("at"),
    ).select(*schemas.IMPORT_EVENTS.fieldNames())


def expired_imports(imports: DataFrame, as_of: Column, days: int) -> DataFrame:
    """Finished imports whose last activity is more than `days` days ago; exactly `days` stays."""
    return imports.filter(
        F.col("status").isin(COMPLETED, FAILED)
        & (F.col("last_activity_at") < days_before(as_of, days))
    )


def retained(rows: DataFrame, expired: DataFrame) -> DataFrame:
    """Events, or states, of imports that have not expired."""
    return rows.join(expired.select("import_id"), "import_id", "left_anti")


def latest_run(runs: DataFrame) -> DataFrame:
    """The run that started last, or no row."""
    return runs.orderBy(F.col("started_at").desc(), F.col("completed_at").desc()).limit(1)


def latest_run_per_org(runs: DataFrame) -> DataFrame:
    rest = [c for c in runs.columns if c != "org_slug"]
    return (
        runs.groupBy("org_slug")
        .agg(F.max(F.struct("started_at", *[c for c in rest if c != "started_at"])).alias("_l"))
        .select("org_slug", "_l.*")
    )


def elapsed_seconds(runs: DataFrame) -> DataFrame:
    return runs.withColumn(
        "elapsed_seconds", F.timestamp_diff("SECOND", F.col("started_at"), F.col("completed_at"))
    )


def all_succeeded(results: DataFrame, ok: str = "ok", by: Sequence[str] = ()) -> DataFrame:
    """Whether every scope succeeded: one row, or one per run named by the columns `by`."""
    return results.groupBy(*by).agg(F.coalesce(F.bool_and(ok), F.lit(True)).alias("succeeded"))
