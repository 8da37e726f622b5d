"""The collection jobs. Each handles all its groups or orgs at once.

Order of writes: data, then the import's `advanced` event, then the run. A job that dies in between
is run again and repeats work; it never skips any.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import suppress
from dataclasses import dataclass
from datetime import date, datetime
from functools import wraps

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplog import schemas
from shiplog.functions.temporal import format_rfc3339, report_end_day
from shiplog.functions.text import scope_names
from shiplog.operators import enrich, late_days, merge, pages, usage_days, usage_facts, usage_records
from shiplog.operators.budget import diff_text_of_changes
from shiplog.operators.flatten import flatten_merge_requests, flatten_projects, merged_since
from shiplog.operators.prefix import committed_prefix, first_failures
from shiplog.plans import day_plan, ledger
from shiplog.plans.store import EVENT_FILES, ClaimHeld, Store
from shiplog.session import job, scratch_folder, scratch_root, staged
from shiplog.sources import landing as landed
from shiplog.sources import usage_parts
from shiplog.streaming.model_waves import CALLS_PER_TASK, ask_in_waves


PartLines = DataFrame | Callable[[Sequence[str], date, date], DataFrame]


class CollectionFailed(Exception):
    """Raised after the ledgers were written."""


def exclusive(kind: str) -> Callable:
    """Lets a job run only while no other one of its kind works on any of its scopes."""

    def wrap(function: Callable) -> Callable:
        @wraps(function)
        def run(store: Store, landing: DataFrame, names: Sequence[str], *args, **options):
            with store.claim([f"{kind}/{name}" for name in names]):
                return function(store, landing, names, *args, **options)

        return run

    return wrap


@dataclass(frozen=True)
class Summarizer:
    """A model call that returns the reply to a prompt, how much of a diff it is given, how many
    tasks call it at once, and after how many calls of a task the replies are stored."""

    complete: Callable[[str], str]
    model: str
    max_bytes: int = 8000
    parallel: int = enrich.PARALLEL_CALLS
    calls_per_task: int = CALLS_PER_TASK


def parse_scopes(text: str, spark) -> list[str]:
    """Names in a comma-separated setting, in order; an empty list is an error."""
    row = spark.range(1).select(scope_names(F.lit(text)).alias("names")).first()
    if not row["names"]:
        raise ValueError("the list of scopes is empty")
    return row["names"]


def _scopes(store: Store, names: Sequence[str], column: str) -> DataFrame:
    rows = [(name, place) for place, name in enumerate(names)]
    return store.spark.createDataFrame(rows, f"{column} string, place int")


def _fold_on(states: DataFrame, events: DataFrame) -> DataFrame:
    return ledger.import_states(events, states)


def current_imports(store: Store) -> DataFrame:
    """The state of every import: the ledger's snapshot and the events after it, folded."""
    states, events = store.states_and_events("import_events", schemas.IMPORT_STATES)
    return ledger.fold_imports(events, states)


def _start_imports(store: Store, scopes: DataFrame, as_of) -> DataFrame:
    """Resume or create the import of every scope and record it."""
    with suppress(ClaimHeld):  # another job takes the snapshot
        store.take_snapshot("import_events", schemas.IMPORT_STATES, _fold_on, EVENT_FILES)
    imports = staged(ledger.resume_or_create(scopes, current_imports(store), as_of), "imports")
    events = ledger.event_rows(
        imports.filter(F.col("action") != "resume"),
        F.when(F.col("action") == "create", "created").otherwise("reset"),
        as_of,
        step=1,
    )
    store.append("import_events", events.coalesce(1))
    return imports


def _latest(answers: DataFrame) -> DataFrame:
    return landed.latest_answers(
        answers, staged(landed.repeated_requests(answers), "repeated-requests")
    )


def _between(landing: DataFrame, wanted: DataFrame) -> DataFrame:
    """Answers within the least and greatest request key of `wanted`, as literals in the scan."""
    first, last = wanted.agg(F.min("request_key"), F.max("request_key")).first()
    return landing.filter(F.col("request_key").between(first or "", last or ""))


def _lines_in_files(
    part_lines: PartLines, orgs: Sequence[str], first: date | None, last: date | None
) -> DataFrame:
    """Lines of the parts in files; a reader is told which orgs and days are wanted."""
    if isinstance(part_lines, DataFrame):
        return part_lines
    return part_lines(orgs, first or date.min, last or date.min)


def _within(landing: DataFrame, spans: DataFrame) -> DataFrame:
    """Answers whose request key is a day in the span of their org.

    The outer bounds go into the scan as literals, so that files of other days are skipped.
    """
    bounds = spans.agg(F.min("first_day"), F.max("last_day")).first()
    first, last = (str(b) if b else "" for b in bounds)
    day = F.col("request_key")
    return (
        landing.filter(day.between(first, last))
        .join(spans.withColumnRenamed("org_slug", "group_key"), "group_key")
        .filter(day.between(F.col("first_day").cast("string"), F.col("last_day").cast("string")))
        .drop("first_day", "last_day")
    )


# ---------------------------------------------------------------- usage


@exclusive(ledger.USAGE_IMPORT)
@job
def import_usage(
    store: Store,
    landing: DataFrame,
    orgs: Sequence[str],
    *,
    as_of: datetime,
    lag_days: int = 2,
    initial: datetime | None = None,
    part_lines: PartLines | None = None,
    watermark: str = "completed_at",
) -> DataFrame:
    """Import the usage days that have become available, for all orgs.

    `part_lines` gives the lines of the parts where they lie in files: a table of them or, so
    that only the planned orgs and days are read, a function of orgs, first and last day (see
    `part_files`); otherwise the landed bodies are split. Returns one summary row per org.
    """
    now = F.lit(as_of).cast("timestamp")
    scopes = _scopes(store, orgs, "org_slug")
    last_runs = ledger.latest_run_per_org(store.read("usage_runs"))
    marks = day_plan.org_watermarks(scopes, last_runs, F.lit(initial), now, watermark)
    imports = _start_imports(
        store,
        marks.select(
            ledger.org_key(F.col("org_slug")).alias("group_full_path"),
            F.lit(ledger.USAGE_IMPORT).alias("import_type"),
            "updated_after",
        ),
        now,
    )
    points = day_plan.resume_points(scopes, imports, last_runs)
    end_day = report_end_day(now, F.lit(lag_days))
    plan = staged(day_plan.plan_days(points, end_day), "day-plan")

    # Report texts are only ever joined with lists of one row per org, or with short lists of
    # exceptions. Both are written out, so Spark knows their size when it picks the join.
    spans = staged(
        plan.groupBy("org_slug").agg(
            F.min("report_day").alias("first_day"), F.max("report_day").alias("last_day")
        ),
        "org-spans",
    )
    answers = _latest(
        _within(landing, spans).filter(
            F.col("feed").isin(landed.USAGE_INDEX, landed.USAGE_PART)
        )
    )
    index = staged(landed.usage_index(answers), "usage-index")

    # Days behind an index that holds the org up cannot commit; their parts are not read.
    by_index = plan.join(index, usage_days.DAY, "left").withColumn(
        "holds",
        F.col("kind").isNull()
        | (F.col("kind") == "error")
        | ((F.col("kind") == "none") & (F.col("report_day") == F.col("end_day"))),
    )
    readable = staged(
        committed_prefix(by_index, ["org_slug"], "report_day", F.col("holds"))
        .groupBy("org_slug")
        .agg(F.max("report_day").alias("last_readable")),
        "readable-spans",
    )
    part_rows = (
        landed.usage_part_answers(answers)
        .join(readable, "org_slug")
        .filter(F.col("report_day") <= F.col("last_readable"))
        .drop("last_readable")
    )
    listed = staged(
        part_rows.drop("body")
        .join(index.select(*usage_days.DAY, "n_parts"), usage_days.DAY, "left")
        .withColumn("listed", F.coalesce(F.col("part_no") < F.col("n_parts"), F.lit(False))),
        "usage-parts",
    )
    parts = listed.filter("listed")
    part_key = [*usage_days.DAY, "part_no"]
    if part_lines is None:
        strays = staged(listed.filter("not listed").select(*part_key), "stray-parts")
        lines = usage_parts.lines_of_bodies(
            part_rows.filter(F.col("error").isNull()).join(strays, part_key, "left_anti")
        )
    else:
        good = staged(parts.filter(F.col("error").isNull()).select(*part_key), "good-parts")
        first, last = good.agg(F.min("report_day"), F.max("report_day")).first()
        lines = _lines_in_files(part_lines, orgs, first, last).join(good, part_key, "left_semi")
    # The one pass over the report text.
    checked = usage_records.checked_lines(lines)

    judged = staged(usage_days.judge_days(plan, index, parts, checked), "judged-days")
    committed = staged(
        usage_days.committed_days(judged).select(*usage_days.DAY, "verdict"), "committed-days"
    )
    # Up to an org's last committed day, every day with records has committed.
    last = committed.groupBy("org_slug").agg(F.max("report_day").alias("last_committed"))
    good_records = checked.join(staged(last, "committed-spans"), "org_slug").filter(
        F.col("report_day") <= F.col("last_committed")
    )
    facts = usage_facts.facts_of_records(good_records, now)
    days = committed.filter(F.col("verdict") == "commit").select(*usage_days.DAY)
    store.merge("usage_facts", usage_facts.last_facts(facts), touched=days)
    _keep_prints(store, answers, committed.select(*usage_days.DAY), now)

    summary = (
        scopes.select("org_slug")
        .join(usage_days.import_summary(judged), "org_slug", "left")
        .fillna({"days_advanced": 0, "records_persisted": 0})
        .withColumn("succeeded", ~F.col("halted_by").eqNullSafe(F.lit("fail")))
        .withColumn("group_full_path", ledger.org_key(F.col("org_slug")))
    )
    outcome = staged(
        summary.join(
            imports.select("group_full_path", "import_id", "last_seq"), "group_full_path"
        ),
        "usage-outcome",
        keep=True,
    )
    advanced = outcome.filter(F.col("days_advanced") > 0)
    store.append(
        "import_events",
        ledger.event_rows(
            advanced,
            "advanced",
            now,
            step=2,
            cursor=F.date_format("last_completed_report_day", "yyyy-MM-dd"),
            n=F.col("days_advanced"),
        )
        .unionByName(
            ledger.event_rows(
                # An import that waits for a day to land stays in progress, with its cursor.
                outcome.filter(~F.col("halted_by").eqNullSafe(F.lit("wait"))),
                F.when(F.col("succeeded"), "completed").otherwise("failed"),
                now,
                step=3,
                message=F.when(~F.col("succeeded"), F.col("error")),
            )
        )
        .coalesce(1),
    )
    store.append(
        "usage_runs",
        advanced.filter("succeeded")
        .select(
            "org_slug",
            now.alias("started_at"),
            F.greatest(F.current_timestamp(), now).alias("completed_at"),
            "last_completed_report_day",
        )
        .coalesce(1),
    )
    return outcome.drop("group_full_path", "import_id", "last_seq")


@job
def reimport_days(
    store: Store,
    landing: DataFrame,
    days: DataFrame,
    *,
    as_of: datetime,
    part_lines: PartLines | None = None,
) -> DataFrame:
    """Import given (org_slug, report_day) again, whatever the cursor says.

    For reports that came or were corrected after the cursor had passed their day; `part_lines`
    as for `import_usage`. Ledgers and cursors are left alone. Returns the judged days; each
    good one is merged.
    """
    now = F.lit(as_of).cast("timestamp")
    plan = staged(
        days.select(*usage_days.DAY, F.lit(None).cast("date").alias("end_day")), "day-plan"
    )
    wanted = plan.select(
        F.col("org_slug").alias("group_key"), F.col("report_day").cast("string").alias("request_key")
    )
    answers = landing.filter(F.col("feed").isin(landed.USAGE_INDEX, landed.USAGE_PART))
    answers = _latest(_between(answers, wanted).join(wanted, ["group_key", "request_key"], "left_semi"))
    index = staged(landed.usage_index(answers), "usage-index")
    part_rows = landed.usage_part_answers(answers)
    listed = index.select(*usage_days.DAY, "n_parts")
    part_rows = part_rows.join(listed, usage_days.DAY).filter(F.col("part_no") < F.col("n_parts"))
    parts = staged(part_rows.drop("body"), "usage-parts")
    if part_lines is None:
        lines = usage_parts.lines_of_bodies(part_rows.filter(F.col("error").isNull()))
    else:
        good = parts.filter(F.col("error").isNull()).select(*usage_days.DAY, "part_no")
        first, last = plan.agg(F.min("report_day"), F.max("report_day")).first()
        # The orgs that the caller lists to be imported again.
        orgs = [r.org_slug for r in plan.select("org_slug").distinct().collect()]
        lines = _lines_in_files(part_lines, orgs, first, last)
        lines = lines.join(good, [*usage_days.DAY, "part_no"], "left_semi")
    checked = usage_records.checked_lines(lines)
    judged = staged(usage_days.judge_days(plan, index, parts, checked), "judged-days", keep=True)
    good = staged(
        judged.filter(F.col("verdict") == "commit").select(*usage_days.DAY), "committed-days"
    )
    facts = usage_facts.facts_of_records(checked.join(good, usage_days.DAY, "left_semi"), now)
    store.merge("usage_facts", usage_facts.last_facts(facts), touched=good)
    _keep_prints(store, answers, good, now)
    return judged


def _keep_prints(store: Store, answers: DataFrame, days: DataFrame, now) -> None:
    """Remember what was imported of these days; empty ones count, their report may come yet."""
    prints = late_days.day_prints(answers).join(days, usage_days.DAY, "left_semi")
    store.append("usage_day_prints", prints.withColumn("imported_at", now).coalesce(1))


@job
def find_late_days(store: Store, landing: DataFrame, orgs: Sequence[str]) -> DataFrame:
    """(org_slug, report_day) of imported days whose reports came or changed since, for
    `reimport_days`.

    Landing times tell which days have news; only their answers are read. Answers that were
    landed again with the same content are no change. Reports in files are told apart by their
    landed answers only.
    """
    imported = late_days.latest_prints(store.read("usage_day_prints"))
    imported = staged(imported.filter(F.col("org_slug").isin(*orgs)), "imported-days")
    days = imported.select(
        F.col("org_slug").alias("group_key"),
        F.col("report_day").cast("string").alias("request_key"),
        "imported_at",
    )
    key = ["group_key", "request_key"]
    first = imported.agg(F.min("imported_at")).first()[0]
    answers = landing.filter(F.col("feed").isin(landed.USAGE_INDEX, landed.USAGE_PART))
    news = answers.filter(F.col("landed_at") > F.lit(first)).select(*key, "landed_at")
    news = news.join(days, key).filter(F.col("landed_at") > F.col("imported_at"))
    news = staged(news.select(*key).distinct(), "days-with-news")
    prints = late_days.day_prints(_latest(answers.join(news, key, "left_semi")))
    return staged(late_days.changed_days(imported, prints), "late-days", keep=True)


# ---------------------------------------------------------------- pages


def _committed_pages(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(committed pages, one row per chain with its last page and what ended it).

    `judged` is written out, so the chain is worked out from its narrow columns. The list of
    bounds has one row per chain; the nodes are read once, filtered by it.
    """
    keys = ["group_key", "request_key"]
    sized = judged.withColumn("batch_count", F.coalesce(F.size("nodes"), F.lit(0)))
    narrow = pages.chain_breaks(sized.drop("nodes"))
    bad = F.col("error").isNotNull() | F.col("broken")
    links = staged(narrow.withColumn("bad", bad), "page-links")
    failures = first_failures(links, keys, "page_no", F.col("bad"))
    halts = (
        links.join(failures, keys)
        .filter(F.col("page_no") == F.col("first_bad"))
        .select(*keys, F.when(~F.col("broken"), F.col("error")).alias("error"))
    )
    good = committed_prefix(links, keys, "page_no", F.col("bad"))
    last = good.groupBy(*keys).agg(
        F.max("page_no").alias("last_page"),
        F.count(F.lit(1)).alias("pages"),
        F.max_by(F.struct("end_cursor", "has_next_page", "total_count"), "page_no").alias("_end"),
        F.sum("batch_count").alias("batch_count"),
    )
    bounds = staged(
        links.select(*keys)
        .distinct()
        .join(last, keys, "left")
        .join(halts, keys, "left")
        .select(
            *keys,
            "last_page",
            "pages",
            "batch_count",
            "_end.end_cursor",
            "_end.has_next_page",
            "_end.total_count",
            "error",
        ),
        "chain-bounds",
        keep=True,
    )
    committed = judged.join(bounds.select(*keys, "last_page"), keys).filter(
        F.col("page_no") <= F.col("last_page")
    )
    return committed, bounds


def _place_of(scopes: DataFrame) -> DataFrame:
    return scopes.select(F.col("group_full_path").alias("group_key"), "place")


@exclusive("projects")
@job
def import_projects(
    store: Store, landing: DataFrame, groups: Sequence[str], run: str
) -> DataFrame:
    """Merge the landed project pages of all groups; `run` is the chains' request key.

    Returns (group_full_path, pages, error). Pages before a bad one are merged all the same.
    """
    scopes = _scopes(store, groups, "group_full_path")
    answers = landing.filter(
        (F.col("feed") == landed.PROJECT_PAGE) & (F.col("request_key") == run)
    )
    answers = _latest(answers.join(_place_of(scopes), "group_key").drop("place"))
    judged = staged(pages.judge_pages(answers, "projects"), "project-pages")
    committed, bounds = _committed_pages(judged)
    rows = flatten_projects(committed).join(_place_of(scopes), "group_key")
    order = ("place", *pages.PAGE_ORDER)
    store.merge("projects", merge.fold_batch(rows, merge.PROJECT_POLICY, order))
    return scopes.select("group_full_path").join(
        bounds.select(F.col("group_key").alias("group_full_path"), "pages", "error"),
        "group_full_path",
        "left",
    )


def _answers_for(store: Store, mrs: DataFrame, summarizer: Summarizer, now) -> DataFrame:
    """Valid model answers for change requests, as (mr_id, prompt_hash, model, answer).

    Replies are stored wave by wave before they are used, keyed by the prompt: a repeated task or
    run neither changes committed text nor asks again for what was answered.
    """
    key = ["mr_id", "prompt_hash"]
    asked = mrs.select(*key, "prompt").dropDuplicates(key)

    def valid() -> DataFrame:
        """Usable stored replies to these prompts; only those are parsed."""
        stored = store.read("model_replies").filter(F.col("model") == summarizer.model)
        stored = stored.join(asked.select(*key), key, "left_semi")
        return enrich.parse_replies(stored).filter(F.col("answer").isNotNull())

    def keep(replies: DataFrame) -> None:
        store.append(
            "model_replies",
            replies.filter(F.col("reply").isNotNull()).select(
                *key, F.lit(summarizer.model).alias("model"), "reply", now.alias("stored_at")
            ),
        )

    # A stored reply that does not parse is asked for again.
    ask_in_waves(
        asked.join(valid().select(*key), key, "left_anti"),
        summarizer.complete,
        keep,
        scratch_folder(scratch_root(store.spark), "prompt-waves"),
        parallel=summarizer.parallel,
        calls_per_task=summarizer.calls_per_task,
    )
    # Two attempts of one job may both have stored a reply; the first one counts.
    return (
        valid()
        .groupBy(*key, "model")
        .agg(F.min_by("answer", F.struct("stored_at", "reply")).alias("answer"))
    )


def _summarized(
    store: Store, landing: DataFrame, mrs: DataFrame, summarizer: Summarizer | None, now
) -> DataFrame:
    if summarizer is None:
        empty = F.lit(None).cast("string")
        return mrs.withColumns({c: empty for c in merge.MERGE_REQUEST_POLICY.keep_known})
    # Only the change lists that are needed are decoded.
    wanted = mrs.select(F.concat_ws("/", "project_id", "mr_iid").alias("request_key"))
    answers = landed.in_files_of(landing.filter(F.col("feed") == landed.MR_CHANGES), wanted)
    changes = landed.mr_changes(_latest(answers.join(wanted, "request_key", "left_semi")))
    # Without readable changes there is no prompt and the model columns stay NULL.
    text = diff_text_of_changes(F.col("changes"), summarizer.max_bytes)
    prompted = (
        mrs.join(changes, ["project_id", "mr_iid"], "left")
        .withColumn(
            "prompt", enrich.prompt(F.col("mr_title"), F.col("mr_description"), text)
        )
        .withColumn("prompt_hash", F.sha2("prompt", 256))
        .drop("changes")
    )
    prompted = staged(prompted, "prompts")
    answers = _answers_for(store, prompted.filter(F.col("prompt").isNotNull()), summarizer, now)
    return enrich.attach_answers(prompted, answers, ["mr_id", "prompt_hash"]).drop(
        "prompt", "prompt_hash"
    )


@exclusive(ledger.MERGE_REQUEST_IMPORT)
@job
def import_merge_requests(
    store: Store,
    landing: DataFrame,
    groups: Sequence[str],
    *,
    as_of: datetime,
    initial: datetime | None = None,
    upsert: bool = False,
    summarizer: Summarizer | None = None,
    watermark: str = "completed_at",
) -> DataFrame:
    """Import landed change-request pages of all groups.

    A chain's request key is the watermark of its import as RFC 3339 text. Returns one row per
    group: processed, pages, batch_count (nodes of the pages), total_count (what the API says
    there are), succeeded, finished, error. An import whose next page has not been
    landed stays in progress.
    """
    now = F.lit(as_of).cast("timestamp")
    scopes = _scopes(store, groups, "group_full_path")
    mark = day_plan.run_watermark(
        ledger.latest_run(store.read("collector_runs")), F.lit(initial), now, watermark
    )
    # One value, as text: it comes back as the same instant in any zone of the driver.
    mark = mark.select(format_rfc3339(F.col("updated_after"))).first()[0]
    imports = _start_imports(
        store,
        scopes.select(
            "group_full_path",
            F.lit(ledger.MERGE_REQUEST_IMPORT).alias("import_type"),
            F.lit(mark).cast("timestamp").alias("updated_after"),
        ),
        now,
    )
    chains = imports.select(
        F.col("group_full_path").alias("group_key"),
        format_rfc3339(F.col("updated_after")).alias("request_key"),
        "updated_after",
        "last_cursor",
    )
    # One row per configured group.
    chains = staged(chains.join(_place_of(scopes), "group_key"), "chains")
    keys = ["group_key", "request_key"]
    answers = landing.filter(F.col("feed") == landed.MR_PAGE)
    answers = landed.in_files_of(answers, chains.select(*keys))
    answers = _latest(answers.join(chains.select(*keys), keys)).join(
        chains.select(*keys, "last_cursor"), keys
    )
    # A resumed chain starts at the page that was asked with the cursor, a new one without.
    starts = staged(
        answers.filter(F.col("after_cursor").eqNullSafe(F.col("last_cursor")))
        .groupBy(*keys)
        .agg(F.min("page_no").alias("start_page")),
        "chain-starts",
    )
    answers = answers.join(starts, keys).filter(F.col("page_no") >= F.col("start_page"))
    judged = staged(pages.judge_pages(answers, "mergeRequests"), "mr-pages")
    committed, bounds = _committed_pages(judged)

    order = ("place", *pages.PAGE_ORDER)
    rows = flatten_merge_requests(committed).join(
        chains.select("group_key", "updated_after", "place"), "group_key"
    )
    rows = merged_since(rows, F.col("updated_after")).drop("updated_after")
    if not upsert:
        firsts = merge.first_arrivals(
            rows.withColumns({f"_{c}": F.col(c) for c in order}), ["mr_id"], [f"_{c}" for c in order]
        )
        firsts = staged(firsts, "first-arrivals")
        known = store.holding("merge_requests", firsts)
        rows = merge.new_only(firsts, known, ["mr_id"])
    rows = staged(rows, "merge-requests")
    batch = _summarized(store, landing, rows, summarizer, now)
    folded = merge.fold_batch(batch, merge.MERGE_REQUEST_POLICY, order)
    if upsert:
        store.merge("merge_requests", folded)
    else:
        store.insert("merge_requests", folded)

    processed = rows.groupBy("group_key").agg(F.count(F.lit(1)).alias("processed"))
    summary = (
        chains.select(*keys)
        .join(bounds, keys, "left")
        .join(processed, "group_key", "left")
        .select(
            F.col("group_key").alias("group_full_path"),
            F.coalesce("processed", F.lit(0)).cast("bigint").alias("processed"),
            F.coalesce("pages", F.lit(0)).cast("bigint").alias("pages"),
            F.coalesce("batch_count", F.lit(0)).cast("bigint").alias("batch_count"),
            "total_count",
            "end_cursor",
            F.col("error").isNull().alias("succeeded"),
            (F.col("error").isNull() & ~F.coalesce("has_next_page", F.lit(True))).alias(
                "finished"
            ),
            "error",
        )
    )
    outcome = staged(
        summary.join(
            imports.select("group_full_path", "import_id", "last_seq"), "group_full_path"
        ),
        "mr-outcome",
        keep=True,
    )
    store.append(
        "import_events",
        ledger.event_rows(
            outcome.filter(F.col("pages") > 0),
            "advanced",
            now,
            step=2,
            cursor=F.col("end_cursor"),
            n=F.col("processed"),
        )
        .unionByName(
            ledger.event_rows(
                outcome.filter(F.col("finished") | ~F.col("succeeded")),
                F.when(F.col("finished"), "completed").otherwise("failed"),
                now,
                step=3,
                message=F.col("error"),
            )
        )
        .coalesce(1),
    )
    return outcome.drop("import_id", "last_seq")


@job
def collect(
    store: Store,
    landing: DataFrame,
    groups: Sequence[str],
    *,
    project_run: str,
    as_of: datetime,
    projects_gate: bool = True,
    **options,
) -> DataFrame:
    """Projects and change requests of all groups; records the run if everything succeeded.

    With `projects_gate` off, failed project pages do not keep the run from being recorded.
    """
    project_results = import_projects(store, landing, groups, project_run)
    results = import_merge_requests(store, landing, groups, as_of=as_of, **options)
    outcomes = results.select("group_full_path", F.col("finished").alias("ok"), "error")
    if projects_gate:
        outcomes = outcomes.unionByName(
            project_results.select(
                "group_full_path", F.col("error").isNull().alias("ok"), "error"
            )
        )
    # The parts' own results go with this job.
    outcomes = staged(outcomes, "outcomes", keep=True)
    gate = ledger.all_succeeded(outcomes).filter("succeeded")
    now = F.lit(as_of).cast("timestamp")
    store.append(
        "collector_runs",
        gate.select(
            now.alias("started_at"),
            F.greatest(F.current_timestamp(), now).alias("completed_at"),
        ).coalesce(1),
    )
    return outcomes


def require_success(results: DataFrame, ok: str = "succeeded") -> None:
    """Raise if any scope failed, for schedulers that watch the exit code.

    The message counts all of them and shows the first twenty.
    """
    failed = results.filter(~F.col(ok))
    total = failed.count()
    if total:
        shown = "; ".join(str(r.asDict()) for r in failed.limit(20).collect())
        raise CollectionFailed(f"{total} scopes failed: {shown}")


@job
def clean_imports(store: Store, *, as_of: datetime, days: int) -> int:
    """Delete finished imports older than `days` days; returns how many.

    They are left out of a new snapshot of the ledger; events that other jobs append meanwhile stay.
    """
    expired = staged(
        ledger.expired_imports(
            current_imports(store), F.lit(as_of).cast("timestamp"), days
        ).select("import_id"),
        "expired-imports",
    )
    removed = expired.count()
    if removed:
        store.take_snapshot(
            "import_events",
            schemas.IMPORT_STATES,
            lambda states, events: ledger.retained(_fold_on(states, events), expired),
            least=-1,
        )
    return removed


__all__ = [
    "CollectionFailed",
    "Summarizer",
    "clean_imports",
    "collect",
    "current_imports",
    "find_late_days",
    "import_merge_requests",
    "import_projects",
    "import_usage",
    "parse_scopes",
    "reimport_days",
    "require_success",
]
