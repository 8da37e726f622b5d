"""Usage lines to checked records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplog import schemas
from shiplog.functions.strict_json import REPEATS_SETTING, with_decoded, with_unknown_repeats
from shiplog.functions.temporal import strict_day
from shiplog.functions.text import has_content
from shiplog.session import staged, staged_under

# A day fails in this order: its index, then its parts, then its records.
INDEX_STAGE, PART_STAGE, RECORD_STAGE = 0, 1, 2


def decode_lines(lines: DataFrame) -> DataFrame:
    """Drop blank lines; add `record`, NULL where a line breaks the specification.

    A generator hands the lines on: the filter would else be pushed below whatever makes them, down
    to the scan, and make every line a second time there.
    """
    others = [c for c in lines.columns if c != "line"]
    made = lines.select(*others, F.explode_outer(F.array("line")).alias("line"))
    written = made.select(*lines.columns).filter(has_content(F.col("line")))
    return with_decoded(written, "line", schemas.USAGE_RECORD, "record")


def decode_again(refused: DataFrame) -> DataFrame:
    """Lines that `decode_lines` has refused, with another `record`: lines that only repeat keys
    unknown to the specification are read. Written out, as it takes a session of its own."""
    return staged_under(
        REPEATS_SETTING,
        refused,
        lambda lines: with_unknown_repeats(lines, "line", schemas.USAGE_RECORD, "record"),
        "refused-lines",
    )


def checked_lines(lines: DataFrame) -> DataFrame:
    """The checked records of all lines, without their texts, written out.

    The texts of refused lines, normally none, are kept until they have got their second look.
    """
    checked = check_records(decode_lines(lines))
    refused = F.when(F.col("record").isNull(), F.col("line"))
    checked = staged(checked.withColumn("line", refused), "usage-records")
    doubtful = checked.filter(F.col("line").isNotNull())
    good = checked.filter(F.col("line").isNull()).drop("line")
    if doubtful.isEmpty():
        return good
    again = decode_again(doubtful.select(*lines.columns))
    return good.unionByName(check_records(again).select(*good.columns))


def repeats_key(breakdown: Column, keys: tuple[str, ...]) -> Column:
    names = F.transform(breakdown, lambda e: F.struct(*[e[k] for k in keys]))
    return F.size(F.array_distinct(names)) != F.size(names)


def check_records(decoded: DataFrame) -> DataFrame:
    """Add `stage`, `check_no` and `error` of the first check a line fails; NULL if none.

    Within a record the day comes first, then the breakdowns in their fixed order.
    """
    record, day = F.col("record"), F.col("report_day")
    checks = [
        (PART_STAGE, record.isNull(), F.lit("unreadable record")),
        (RECORD_STAGE, strict_day(record["day"]).isNull(), F.lit("unreadable day")),
        (
            RECORD_STAGE,
            strict_day(record["day"]) != day,
            F.concat(F.lit("record of day "), record["day"]),
        ),
    ]
    for name in schemas.BREAKDOWN_ORDER:
        keys, _ = schemas.BREAKDOWNS[name]
        repeated = F.lit(f"repeated key in {name}")
        checks.append((RECORD_STAGE, repeats_key(record[name], keys), repeated))

    first = None
    for number, (stage, failed, message) in enumerate(checks):
        found = F.struct(
            F.lit(stage).alias("stage"), F.lit(number).alias("check_no"), message.alias("error")
        )
        first = F.when(failed, found) if first is None else first.when(failed, found)
    return (
        decoded.withColumn("_first", first)
        .withColumn("stage", F.col("_first.stage"))
        .withColumn("check_no", F.col("_first.check_no"))
        .withColumn("error", F.col("_first.error"))
        .drop("_first")
    )
