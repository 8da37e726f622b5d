"""Model calls in waves: a queue of prompts, read as a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from shiplog.operators.enrich import PARALLEL_CALLS, ask_model

#: Prompts of one task between two writes.
CALLS_PER_TASK = 50


def ask_in_waves(
    prompts: DataFrame,
    complete: Callable[[str], str],
    keep: Callable[[DataFrame], None],
    folder: str,
    *,
    parallel: int = PARALLEL_CALLS,
    calls_per_task: int = CALLS_PER_TASK,
) -> None:
    """Ask the model for (mr_id, prompt_hash, prompt); `keep` gets the replies of every wave.

    The prompts are written to `folder` in files of `calls_per_task` at most, and a stream takes
    `parallel` files at a time. Whatever happens later, the replies of earlier waves have been
    kept: a caller that is started again asks for those it does not find. One wave's calls are
    lost at most. A queue without prompts makes no call.
    """
    spark = prompts.sparkSession
    queue = prompts.select("mr_id", "prompt_hash", "prompt")
    dealt = queue.repartition(parallel).write.option("maxRecordsPerFile", calls_per_task)
    dealt.parquet(f"{folder}/queue")
    waves = (
        spark.readStream.schema(queue.schema)
        .option("maxFilesPerTrigger", parallel)
        .parquet(f"{folder}/queue")
    )

    def on_wave(wave: DataFrame, _: int) -> None:
        keep(ask_model(wave, complete, parallel))

    (
        waves.writeStream.foreachBatch(on_wave)
        .option("checkpointLocation", f"{folder}/progress")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
