"""Continuous import of landed usage answers."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shiplog import schemas
from shiplog.plans.jobs import import_usage
from shiplog.plans.store import Store
from shiplog.sources import landing as landed
from shiplog.streaming.day_progress import complete_days


def stream_usage(
    spark: SparkSession,
    landing_path: str,
    store: Store,
    orgs: list[str],
    checkpoint: str,
    *,
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
    max_files_per_trigger: int = 1000,
    **options,
) -> StreamingQuery:
    """Import whatever has landed since the last trigger and stop (`availableNow`).

    The stream's state tells which days are complete (see `day_progress`); their list is kept
    beside the checkpoint, a folder per trigger. An import reads the answers of complete days only:
    parts that have landed of other days are not decoded before the last one has come, so each
    part is decoded once, however many triggers its day takes. A day behind one that is not
    complete waits undecoded too. A trigger that is repeated after a failure finds the ledger as it
    was left and repeats at most one merge.
    """
    answers = (
        spark.readStream.schema(schemas.LANDING)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(landing_path)
        .filter(F.col("feed").isin(landed.USAGE_INDEX, landed.USAGE_PART))
        .filter(F.col("group_key").isin(orgs))
    )
    listed = f"{checkpoint.rstrip('/')}-complete-days"

    def on_trigger(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{listed}/trigger={number}")
        new = spark.read.schema(batch.schema).parquet(f"{listed}/trigger={number}")
        # At most the orgs that were configured.
        present = {r.org_slug for r in new.select("org_slug").distinct().collect()}
        if present:
            complete = spark.read.schema(batch.schema).parquet(listed).select(
                F.col("org_slug").alias("group_key"),
                F.col("report_day").cast("string").alias("request_key"),
            )
            everything = landed.read_landing(spark, landing_path)
            import_usage(
                store,
                everything.join(complete.distinct(), ["group_key", "request_key"], "left_semi"),
                [o for o in orgs if o in present],
                as_of=clock(),
                **options,
            )

    return (
        complete_days(answers)
        .writeStream.foreachBatch(on_trigger)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
