import json
import os
import sys
from datetime import datetime, timezone

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shiplog import schemas, session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield session.configure(spark)
    spark.stop()


def utc(*parts):
    return datetime(*parts, tzinfo=timezone.utc)


def landing(spark, rows):
    """rows: (feed, group_key, request_key, page_no, after_cursor, status, body[, minute])."""
    full = [
        (*r[:7], datetime(2024, 6, 1, 0, r[7] if len(r) > 7 else 0)) for r in rows
    ]
    full = [
        tuple(json.dumps(v) if isinstance(v, (dict, list)) else v for v in r) for r in full
    ]
    return spark.createDataFrame(full, schemas.LANDING)


def usage_record(user_id, day, **more):
    return {
        "user_id": user_id,
        "user_login": f"user-{user_id}",
        "day": day,
        "organization_id": "7",
        **more,
    }


def lines(*records):
    return "\n".join(r if isinstance(r, str) else json.dumps(r) for r in records) + "\n"


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


__all__ = ["F", "landing", "lines", "rows", "usage_record", "utc"]
