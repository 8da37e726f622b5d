"""Specifications of the landed answers and schemas of the tables built from them.

Field names and presence rules are fixed values of the feeds.
"""

from __future__ import annotations

from pyspark.sql import types as T

from shiplog.functions.strict_json import (
    BIGINT,
    BOOLEAN,
    DEFAULT,
    DOUBLE,
    OPTIONAL,
    STRING,
    Arr,
    Field,
    obj,
)

# ---------------------------------------------------------------- usage feed

ACTIVITY = (
    "user_initiated_interaction_count",
    "code_generation_activity_count",
    "code_acceptance_activity_count",
)
LINES_OF_CODE = (
    "loc_suggested_to_add_sum",
    "loc_suggested_to_delete_sum",
    "loc_added_sum",
    "loc_deleted_sum",
)
MEASURES = ACTIVITY + LINES_OF_CODE
# Language breakdowns carry no interaction count.
LANGUAGE_MEASURES = MEASURES[1:]
FLAGS = (
    "used_agent",
    "used_chat",
    "used_cli",
    "used_copilot_coding_agent",
    "used_copilot_cloud_agent",
)

BREAKDOWNS = {
    "totals_by_feature": (("feature",), MEASURES),
    "totals_by_ide": (("ide",), MEASURES),
    "totals_by_language_feature": (("language", "feature"), LANGUAGE_MEASURES),
    "totals_by_language_model": (("language", "model"), LANGUAGE_MEASURES),
    "totals_by_model_feature": (("model", "feature"), MEASURES),
}
# The order in which a record's breakdowns are checked for repeated keys.
BREAKDOWN_ORDER = tuple(BREAKDOWNS)


def _strings(*names: str) -> tuple[Field, ...]:
    return tuple(Field(n, STRING) for n in names)


def _counts(names: tuple[str, ...]) -> tuple[Field, ...]:
    return tuple(Field(n, BIGINT, DEFAULT) for n in names)


PLUGIN_VERSION = obj(*_strings("sampled_at", "plugin", "plugin_version"))
IDE_VERSION = obj(*_strings("sampled_at", "ide_version"))
CLI_VERSION = obj(*_strings("sampled_at", "cli_version"))


def _breakdown(name: str) -> Field:
    keys, measures = BREAKDOWNS[name]
    extra = ()
    if name == "totals_by_ide":
        extra = (
            Field("last_known_plugin_version", PLUGIN_VERSION, OPTIONAL),
            Field("last_known_ide_version", IDE_VERSION, OPTIONAL),
        )
    return Field(name, Arr(obj(*_strings(*keys), *_counts(measures), *extra)), DEFAULT)


CLI_TOTALS = obj(
    *_counts(("session_count", "request_count", "prompt_count")),
    Field(
        "token_usage",
        obj(
            *_counts(("output_tokens_sum", "prompt_tokens_sum")),
            Field("avg_tokens_per_request", DOUBLE, DEFAULT),
        ),
        OPTIONAL,
    ),
    Field("last_known_cli_version", CLI_VERSION, OPTIONAL),
)

USAGE_RECORD = obj(
    Field("user_id", BIGINT),
    *_strings("user_login", "day", "organization_id"),
    Field("enterprise_id", STRING, OPTIONAL),
    *_counts(MEASURES),
    *(Field(n, BOOLEAN, DEFAULT) for n in FLAGS),
    *(_breakdown(n) for n in BREAKDOWN_ORDER),
    Field("totals_by_cli", CLI_TOTALS, OPTIONAL),
)

USAGE_INDEX = obj(Field("download_links", Arr(STRING)), Field("report_day", STRING))

# ---------------------------------------------------------------- change-request and project feeds

PAGE_INFO = obj(Field("endCursor", STRING, OPTIONAL), Field("hasNextPage", BOOLEAN))


def _connection(entry_field: str) -> object:
    entry = obj(Field(entry_field, STRING))
    return obj(Field("nodes", Arr(entry, null_elements=True), OPTIONAL))


MR_NODE = obj(
    *_strings("id", "iid", "title"),
    Field("description", STRING, OPTIONAL),
    Field("webUrl", STRING),
    Field("labels", _connection("title"), OPTIONAL),
    Field("approved", BOOLEAN),
    Field("approvedBy", _connection("username"), OPTIONAL),
    Field("author", obj(Field("username", STRING))),
    Field(
        "diffStatsSummary",
        obj(*(Field(n, BIGINT) for n in ("additions", "deletions", "changes", "fileCount"))),
        OPTIONAL,
    ),
    Field("mergeUser", obj(Field("username", STRING)), OPTIONAL),
    *_strings("createdAt", "updatedAt"),
    Field("mergedAt", STRING, OPTIONAL),
    Field("projectId", BIGINT),
    Field("project", obj(*_strings("name", "path"))),
)

PROJECT_NODE = obj(
    *_strings("id", "name", "path", "fullPath", "webUrl"),
    Field("topics", Arr(STRING), OPTIONAL),
)


def _page(connection: str, node: object, counted: bool) -> object:
    count = (Field("count", BIGINT),) if counted else ()
    body = obj(
        *count,
        Field("nodes", Arr(node, null_elements=True), OPTIONAL),
        Field("pageInfo", PAGE_INFO),
    )
    group = obj(Field(connection, body))
    return obj(
        Field("errors", Arr(obj(Field("message", STRING))), OPTIONAL),
        Field("data", obj(Field("group", group, OPTIONAL)), OPTIONAL),
    )


MR_PAGE = _page("mergeRequests", MR_NODE, counted=True)
PROJECT_PAGE = _page("projects", PROJECT_NODE, counted=False)

MR_CHANGES = obj(
    Field("changes", Arr(obj(*_strings("diff", "new_path", "old_path"))), OPTIONAL),
)

MODEL_REPLY = obj(*_strings("category", "title", "summary"))

# ---------------------------------------------------------------- landing

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "strings": T.ArrayType(T.StringType()),
}


def _table(**columns: str | T.DataType) -> T.StructType:
    """A schema without a session; types by name or as they are."""
    return T.StructType(
        [T.StructField(n, _TYPES[t] if isinstance(t, str) else t) for n, t in columns.items()]
    )


LANDING = _table(
    feed="string",
    group_key="string",
    request_key="string",
    page_no="int",
    after_cursor="string",
    status="int",
    body="string",
    landed_at="timestamp",
)

# ---------------------------------------------------------------- tables

PROJECTS = _table(
    p_id="string",
    p_name="string",
    p_path="string",
    p_full_path="string",
    p_web_url="string",
    topics="strings",
)

MERGE_REQUESTS = _table(
    mr_id="string",
    mr_iid="string",
    mr_title="string",
    mr_web_url="string",
    project_id="string",
    project_name="string",
    project_path="string",
    created_at="timestamp",
    updated_at="timestamp",
    merged_at="timestamp",
    created_by="string",
    merged_by="string",
    approved="boolean",
    approved_by="strings",
    diff_stats_summary=_table(additions="int", deletions="int", changes="int", file_count="int"),
    labels="strings",
    mr_ai_title="string",
    mr_ai_summary="string",
    mr_ai_model="string",
    mr_ai_category="string",
)

_RECORD = USAGE_RECORD.spark_type

USAGE_FACTS = T.StructType(
    [
        *_table(
            org_slug="string",
            report_day="date",
            user_id="bigint",
            user_login="string",
            organization_id="string",
            enterprise_id="string",
            # As sent: '' and NULL differ here; enterprise_id holds NULL for both.
            enterprise_id_sent="string",
        ),
        *[_RECORD[n] for n in MEASURES + FLAGS + BREAKDOWN_ORDER + ("totals_by_cli",)],
        *_table(created_at="timestamp", updated_at="timestamp"),
    ]
)

COLLECTOR_RUNS = _table(started_at="timestamp", completed_at="timestamp")

USAGE_RUNS = _table(
    org_slug="string",
    started_at="timestamp",
    completed_at="timestamp",
    last_completed_report_day="date",
)

USAGE_DAY_PRINTS = _table(
    org_slug="string", report_day="date", fingerprint="string", imported_at="timestamp"
)

IMPORT_EVENTS = _table(
    import_id="string",
    group_full_path="string",
    import_type="string",
    updated_after="timestamp",
    seq="bigint",
    event="string",
    cursor="string",
    n="bigint",
    message="string",
    at="timestamp",
)

#: What orders the events of an import, and what its latest events say.
EVENT_ORDER = T.StructType(
    [IMPORT_EVENTS[c] for c in ("seq", "at", "event", "cursor", "n", "message")]
)

IMPORT_STATES = _table(
    import_id="string",
    created=_table(
        event=EVENT_ORDER,
        scope=_table(group_full_path="string", import_type="string", updated_after="timestamp"),
    ),
    advanced=EVENT_ORDER,
    completed=EVENT_ORDER,
    turned=EVENT_ORDER,
    told=EVENT_ORDER,
    last=EVENT_ORDER,
    total="bigint",
)

MODEL_REPLIES = _table(
    mr_id="string",
    prompt_hash="string",
    model="string",
    reply="string",
    stored_at="timestamp",
)

# Run recorded by a fresh installation, so that the first collection has a watermark.
SEED_RUN = ("2023-01-01T00:00:00Z", "2023-01-01T00:05:00Z")
