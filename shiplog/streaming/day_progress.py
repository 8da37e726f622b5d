"""What has landed of each usage day, as keyed streaming state."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from shiplog import schemas
from shiplog.functions.strict_json import with_decoded
from shiplog.sources import landing as landed

STORE_SETTING = "spark.sql.streaming.stateStore.providerClass"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def day_news(answers: DataFrame) -> DataFrame:
    """(org_slug, report_day, landed_at, n_parts, part_no) of landed indexes and parts.

    An index has `n_parts`, 0 where there is no report or the answer is an error; a part has
    `part_no`. Bodies of parts are not read.
    """
    day = F.col("request_key").try_cast("date")
    place = [F.col("group_key").alias("org_slug"), day.alias("report_day"), "landed_at"]
    index = with_decoded(
        answers.filter(F.col("feed") == landed.USAGE_INDEX), "body", schemas.USAGE_INDEX, "_index"
    )
    links = F.when(landed.status_kind(F.col("status")) == "ok", F.size("_index.download_links"))
    none = F.lit(None).cast("int")
    part = answers.filter(F.col("feed") == landed.USAGE_PART)
    return (
        index.select(*place, F.coalesce(links, F.lit(0)).alias("n_parts"), none.alias("part_no"))
        .unionAll(part.select(*place, none.alias("n_parts"), F.col("page_no").alias("part_no")))
        .filter(F.col("org_slug").isNotNull() & F.col("report_day").isNotNull())
    )


class DayProgress(StatefulProcessor):
    """Remembers of a day the latest index and the numbers of the parts that have landed; tells of
    the day whenever something lands and nothing is missing."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.index = handle.getValueState("index", "landed_at timestamp, n_parts int")
        self.parts = handle.getMapState("parts", "part_no int", "landed boolean")

    def handleInputRows(
        self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any
    ) -> Iterator[pd.DataFrame]:
        best = self.index.get() if self.index.exists() else None
        for batch in rows:
            for part in batch["part_no"].dropna().astype(int).unique().tolist():
                self.parts.updateValue((part,), (True,))
            for row in batch[batch["n_parts"].notna()].itertuples():
                if best is None or row.landed_at >= pd.Timestamp(best[0]):
                    best = (row.landed_at.to_pydatetime(), int(row.n_parts))
        if best is None:
            return
        self.index.update(tuple(best))
        missing = any(not self.parts.containsKey((n,)) for n in range(best[1]))
        if not missing:
            yield pd.DataFrame({"org_slug": [key[0]], "report_day": [key[1]]})

    def close(self) -> None:
        pass


def complete_days(answers: DataFrame) -> DataFrame:
    """(org_slug, report_day) of a stream's days that are complete, at every change of one."""
    answers.sparkSession.conf.set(STORE_SETTING, STORE)
    keyed = day_news(answers).groupBy("org_slug", "report_day")
    return keyed.transformWithStateInPandas(
        DayProgress(), "org_slug string, report_day date", "Update", "None"
    )
