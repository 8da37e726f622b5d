"""Projects and change requests from landed pages to tables, with resume and summaries."""

import json

import pytest
from conftest import landing, rows, utc
from pyspark.sql import functions as F

from shiplog import schemas
from shiplog.functions.text import FENCE
from shiplog.plans import jobs, ledger
from shiplog.plans.store import BrokenTable, Store
from shiplog.sources.landing import in_files_of, land, read_landing

GROUP, OTHER = "acme/web", "acme/ops"
SINCE = "2020-03-01T00:00:00Z"
START, NOW = utc(2020, 3, 1), utc(2020, 3, 10)


def node(iid, merged=None, **more):
    base = {
        "id": f"mr-{iid}",
        "iid": str(iid),
        "title": f"Change {iid}",
        "webUrl": f"https://forge.example/{iid}",
        "approved": merged is not None,
        "author": {"username": "dev1"},
        "createdAt": "2020-02-01T10:00:00Z",
        "updatedAt": "2020-03-02T10:00:00Z",
        "mergedAt": merged,
        "projectId": 52,
        "project": {"name": "web", "path": "web"},
        "state": "merged" if merged else "opened",
        "draft": False,
    }
    return {**base, **more}


def page(no, nodes, *, more=False, group=GROUP, since=SINCE, after=None, total=2, minute=0, **extra):
    body = {
        "data": {
            "group": {
                "id": "g",
                "mergeRequests": {
                    "count": total,
                    "nodes": nodes,
                    "pageInfo": {"endCursor": f"c{no}", "hasNextPage": more},
                },
            }
        },
        **extra,
    }
    if after is None and no > 0:
        after = f"c{no - 1}"
    return ("mr_page", group, since, no, after, 200, body, minute)


def changes(iid, files, status=200):
    body = {"changes": [{"diff": d, "new_path": p, "old_path": p} for p, d in files]}
    return ("mr_changes", "52", f"52/{iid}", None, None, status, body)


def project_page(no, nodes, more=False, group=GROUP, **extra):
    body = {
        "data": {
            "group": {
                "projects": {
                    "nodes": nodes,
                    "pageInfo": {"endCursor": f"c{no}", "hasNextPage": more},
                }
            }
        },
        **extra,
    }
    return ("project_page", group, "run-1", no, f"c{no - 1}" if no else None, 200, body)


def project(number, **more):
    return {
        "id": f"p-{number}", "name": "n", "path": "n", "fullPath": f"g/{number}", "webUrl": "u", **more,
    }


@pytest.fixture
def store(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"), part_rows=40)
    store.create(seed=False)
    return store


def collect(store, answers, **options):
    options = {"as_of": NOW, "initial": START, **options}
    return jobs.import_merge_requests(
        store, landing(store.spark, answers), options.pop("groups", [GROUP]), **options
    )


def imports(store):
    return jobs.current_imports(store)


def test_two_nodes_one_merged(store):
    full = node(
        777,
        "2020-03-02T09:20:00Z",
        approvedBy={"nodes": [{"username": "dev2"}, None]},
        labels={"nodes": [{"title": "engineering"}]},
        diffStatsSummary={"additions": 2, "deletions": 2, "changes": 4, "fileCount": 1},
        mergeUser={"username": "dev3"},
    )
    result = collect(store, [page(0, [full, node(888)])])
    assert rows(result, "processed", "pages", "finished") == [(1, 1, True)]
    row = store.read("merge_requests").first()
    assert (row.mr_id, row.mr_iid, row.project_id, row.created_by, row.merged_by) == (
        "mr-777", "777", "52", "dev1", "dev3",
    )
    assert (row.approved_by, row.labels, tuple(row.diff_stats_summary)) == (
        ["dev2"], ["engineering"], (2, 2, 4, 1),
    )
    assert row.mr_ai_title is None
    assert rows(imports(store), "status", "last_cursor", "total_processed") == [("completed", "c0", 1)]


def test_watermark_is_inclusive_and_missing_parts_stay_null(store):
    nodes = [
        node(1, "2020-03-01T00:00:00Z"),
        node(2, "2020-02-29T23:59:59Z"),
        node(3, "2020-03-01T01:30:00+02:00"),
        node(4, "2020-03-05T00:00:00Z", labels={"nodes": None}),
    ]
    collect(store, [page(0, nodes)])
    assert rows(store.read("merge_requests"), "mr_id", "approved_by", "labels") == [
        ("mr-1", None, None),
        ("mr-4", None, []),
    ]


def test_failed_page_keeps_the_prefix_and_resumes(store):
    answers = [
        page(0, [node(1, "2020-03-02T00:00:00Z")], more=True),
        page(1, [node(2, "2020-03-02T00:00:00Z")], more=True),
        page(2, [None], more=True),
        page(3, [node(4, "2020-03-02T00:00:00Z")]),
    ]
    first = collect(store, answers)
    assert rows(first, "processed", "pages", "succeeded") == [(2, 2, False)]
    assert rows(imports(store), "status", "last_cursor", "error_message") == [("failed", "c1", "null node")]
    answers.append(page(2, [node(3, "2020-03-02T00:00:00Z")], more=True, minute=5))
    # The import goes on with its own watermark, not with the one it is asked with now.
    second = collect(store, answers, initial=utc(2021, 1, 1), as_of=utc(2020, 3, 11))
    assert rows(second, "processed", "pages", "finished") == [(2, 2, True)]
    assert rows(store.read("merge_requests"), "mr_id") == [(f"mr-{i}",) for i in (1, 2, 3, 4)]
    assert rows(imports(store), "status", "last_cursor", "total_processed") == [("completed", "c3", 4)]


def test_missing_page_leaves_the_import_in_progress(store):
    answers = [
        page(0, [node(1, "2020-03-02T00:00:00Z")], more=True),
        page(2, [node(3, "2020-03-02T00:00:00Z")]),
    ]
    result = collect(store, answers)
    assert rows(result, "pages", "succeeded", "finished") == [(1, True, False)]
    assert rows(imports(store), "status", "last_cursor") == [("in_progress", "c0")]
    answers.append(page(1, [node(2, "2020-03-02T00:00:00Z")], more=True))
    assert rows(collect(store, answers), "pages", "finished") == [(2, True)]
    assert store.read("merge_requests").count() == 3


def test_errors_beside_data_fail_the_page(store):
    answers = [page(0, [node(1, "2020-03-02T00:00:00Z")], errors=[{"message": "too deep"}])]
    assert rows(collect(store, answers), "succeeded", "error") == [(False, "errors: too deep")]
    assert store.read("merge_requests").count() == 0


def test_policies_of_a_second_import(store):
    def answers(since, title, author, description):
        return [
            page(
                0,
                [
                    node(1, "2020-04-02T00:00:00Z", title=title, author={"username": author}, description=description),
                    node(2 if since == SINCE else 3, "2020-04-02T00:00:00Z"),
                ],
                since=since,
            ),
            changes(1, [("a.py", "+1")]),
        ]

    calls = []
    asked = jobs.Summarizer(
        lambda p: FENCE + "json\n" + json.dumps({"category": "Feature", "title": "feat(a): b", "summary": "s"}),
        "stub",
    )
    collect(store, answers(SINCE, "One", "dev1", "why"), summarizer=asked)
    kept = store.read("merge_requests").filter("mr_id = 'mr-1'").first()
    assert (kept.mr_ai_title, kept.mr_ai_category, kept.mr_ai_model) == ("feat(a): b", "Feature", "stub")
    # mr-2 has no landed changes, so there was nothing to ask.
    assert store.read("model_replies").count() == 1

    later = "2020-04-01T00:00:00Z"
    options = {"initial": utc(2020, 4, 1), "as_of": utc(2020, 4, 9)}
    collect(store, answers(later, "Two", "dev9", None), **options)
    table = store.read("merge_requests")
    assert rows(table, "mr_id", "mr_title") == [("mr-1", "One"), ("mr-2", "Change 2"), ("mr-3", "Change 3")]

    again = "2020-05-01T00:00:00Z"
    collect(
        store,
        [page(0, [node(1, "2020-05-02T00:00:00Z", title="Three", author={"username": "dev9"})], since=again)],
        initial=utc(2020, 5, 1),
        as_of=utc(2020, 5, 9),
        upsert=True,
    )
    row = store.read("merge_requests").filter("mr_id = 'mr-1'").first()
    # Overwritten, kept from the first insert, kept because the new value is NULL.
    assert (row.mr_title, row.created_by, row.mr_ai_title) == ("Three", "dev1", "feat(a): b")
    assert calls == []


def test_stored_replies_are_not_asked_for_again(store, tmp_path):
    log = tmp_path / "asked"
    log.mkdir()

    def complete(prompt):
        (log / str(len(list(log.iterdir())))).touch()
        assert "File: a.py\nDiff:\n+1\n\n" in prompt
        return json.dumps({"category": "Chore", "title": "chore(a): b", "summary": "s"})

    asked = jobs.Summarizer(complete, "stub")
    answers = [page(0, [node(1, "2020-03-02T00:00:00Z")]), changes(1, [("a.py", "+1")], status=404)]
    collect(store, answers, summarizer=asked)
    collect(store, answers, summarizer=asked, upsert=True, as_of=utc(2020, 3, 11))
    assert len(list(log.iterdir())) == 1
    assert rows(store.read("merge_requests"), "mr_ai_category") == [("Chore",)]


def test_after_a_kill_only_the_waves_that_are_left_are_asked(store, tmp_path, monkeypatch):
    log = tmp_path / "asked"
    log.mkdir()

    def complete(prompt):
        title = next(l for l in prompt.splitlines() if l.startswith("Title: "))
        with open(log / title.rpartition(" ")[2], "a") as f:
            f.write("x")
        return json.dumps({"category": "Chore", "title": "chore(a): b", "summary": title})

    asked = jobs.Summarizer(complete, "stub", parallel=2, calls_per_task=2)
    nodes = [node(i, "2020-03-02T00:00:00Z") for i in range(16)]
    answers = [page(0, nodes, total=16), *(changes(i, [("a.py", "+1")]) for i in range(16))]
    append, waves = store.append, []

    def until_killed(name, new):
        if name == "model_replies":
            if len(waves) == 2:
                raise RuntimeError("killed")
            waves.append(name)
        append(name, new)

    store.append = until_killed
    with pytest.raises(Exception, match="killed"):
        collect(store, answers, summarizer=asked)
    first = {f.name for f in log.iterdir()}
    assert len(first) == 8 == store.read("model_replies").count()
    assert store.read("merge_requests").count() == 0
    store.append = append
    collect(store, answers, summarizer=asked, as_of=utc(2020, 3, 11))
    assert {f.name: f.read_text() for f in log.iterdir()} == {str(i): "x" for i in range(16)}
    told = rows(store.read("merge_requests"), "mr_ai_summary")
    assert told == sorted([(f"Title: Change {i}",) for i in range(16)], key=repr)


def test_only_files_that_hold_a_wanted_request_are_read(spark, tmp_path):
    path = str(tmp_path / "landing")
    for no in range(4):
        one = [changes(i, [("a.py", "+1")]) for i in range(no, 40, 4)]
        land(landing(spark, one).coalesce(1), path)
    feed = read_landing(spark, path).filter("feed = 'mr_changes'")
    wanted = spark.createDataFrame([("52/3",), ("52/39",), ("9/9",)], "request_key string")
    found = in_files_of(feed, wanted)
    assert found.count() == 10
    found.collect()
    scan = found._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numFiles").value() == 1
    assert in_files_of(feed, wanted.limit(0)).count() == 0
    # Rows that do not lie in files are taken as they are.
    assert in_files_of(landing(spark, [changes(1, [])]), wanted).count() == 1


def test_collect_records_the_run_only_if_all_groups_succeed(store):
    spark = store.spark
    good = [
        page(0, [node(1, "2020-03-02T00:00:00Z")]),
        project_page(0, [project(1, topics=["foo", "bar"]), project(2, topics=[]), project(3)]),
        project_page(0, [project(2, name="later")], group=OTHER),
    ]
    failing = [*good, page(0, [None], group=OTHER)]
    groups = [GROUP, OTHER]
    options = {"project_run": "run-1", "as_of": NOW, "initial": START}
    jobs.collect(store, landing(spark, failing), groups, **options)
    assert store.read("collector_runs").count() == 0
    assert rows(store.read("projects"), "p_id", "p_name", "topics") == [
        ("p-1", "n", ["foo", "bar"]),
        ("p-2", "later", None),
        ("p-3", "n", None),
    ]
    fixed = [*failing, page(0, [node(9, "2020-03-02T00:00:00Z")], group=OTHER, minute=3)]
    # The first group's import had completed; its next one starts at the same watermark.
    outcomes = jobs.collect(store, landing(spark, fixed), groups, **options)
    jobs.require_success(outcomes, "ok")
    assert store.read("collector_runs").count() == 1
    # Each MR group counts on its own; the shared table has both.
    assert rows(store.read("merge_requests"), "mr_id") == [("mr-1",), ("mr-9",)]


def test_failure_is_raised_after_the_ledger_was_written(store):
    result = collect(store, [page(0, None)])
    with pytest.raises(jobs.CollectionFailed, match="no nodes"):
        jobs.require_success(result)
    assert rows(imports(store), "status") == [("failed",)]


def test_scopes(spark):
    assert jobs.parse_scopes(" a/b , ,c,", spark) == ["a/b", "c"]
    with pytest.raises(ValueError):
        jobs.parse_scopes(" , ", spark)


def test_seed_run_is_the_first_watermark(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.create()
    store.create()
    latest = ledger.latest_run(store.read("collector_runs"))
    assert rows(latest, F.col("completed_at").cast("string")) == [("2023-01-01 00:05:00",)]
    store.append(
        "collector_runs",
        spark.createDataFrame([(utc(2024, 1, 1), utc(2024, 1, 2))], "started_at timestamp, completed_at timestamp"),
    )
    assert rows(ledger.latest_run(store.read("collector_runs")), F.year("started_at")) == [(2024,)]
    assert ledger.latest_run_per_org(store.read("usage_runs")).count() == 0


def test_retention_keeps_what_is_exactly_as_old(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.create()
    history = []
    for name, last, day in (
        ("old", "completed", 1), ("edge", "failed", 2), ("open", "advanced", 1), ("new", "completed", 9),
    ):
        history.append((name, "g", "t", utc(2024, 1, 1), 1, "created", None, None, None, utc(2024, 1, 1)))
        history.append((name, None, None, None, 2, last, "c", 1, "m", utc(2024, 1, day)))
    schema = store.read("import_events").schema
    store.append("import_events", spark.createDataFrame(history, schema))
    assert jobs.clean_imports(store, as_of=utc(2024, 1, 12), days=10) == 1
    assert rows(imports(store), "import_id") == [("edge",), ("new",), ("open",)]
    assert jobs.clean_imports(store, as_of=utc(2024, 1, 12), days=10) == 0


def test_a_snapshot_stands_for_the_events_before_it(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.create()
    schema = store.read("import_events").schema

    def add(name, seq, event, cursor=None, n=None, message=None):
        scope = ("g", "t", utc(2024, 1, 1)) if event == "created" else (None, None, None)
        row = (name, *scope, seq, event, cursor, n, message, utc(2024, 1, seq))
        store.append("import_events", spark.createDataFrame([row], schema))
        every.append(row)

    def take(least=0):
        return store.take_snapshot("import_events", schemas.IMPORT_STATES, jobs._fold_on, least)

    def check():
        whole = ledger.fold_imports(spark.createDataFrame(every, schema))
        assert rows(jobs.current_imports(store)) == rows(whole)

    def files():
        return {f.name for f in (tmp_path / "import_events").glob("part-*")}

    every = []
    add("a", 1, "created")
    add("a", 2, "advanced", "c1", 5)
    add("b", 1, "created")
    add("a", 3, "failed", message="no")
    check()
    assert not take(least=99) and take()
    check()
    first = files()
    add("a", 4, "reset")
    add("a", 5, "advanced", None, 2)
    add("b", 2, "advanced", "c9", 1)
    check()
    # Only what came after the snapshot is folded.
    states, later = store.states_and_events("import_events", schemas.IMPORT_STATES)
    assert (states.count(), later.count()) == (2, 3)
    assert take()
    check()
    # The files of the snapshot before are gone, those of this one wait for the next.
    assert not first & files()
    add("a", 6, "completed")
    # One that died before it was complete counts for nothing.
    (tmp_path / "_snapshots" / "import_events" / "000000000009-dead" / "states").mkdir(parents=True)
    check()
    assert take() and take(least=-1)
    check()
    assert len(list((tmp_path / "_snapshots" / "import_events").iterdir())) == 2
    assert rows(jobs.current_imports(store), "import_id", "status", "total_processed", "last_cursor") == [
        ("a", "completed", 7, None), ("b", "in_progress", 1, "c9"),
    ]


def test_imports_take_a_snapshot_of_a_long_ledger(store, monkeypatch):
    monkeypatch.setattr(jobs, "EVENT_FILES", 2)
    for day in range(2, 6):
        collect(store, [page(0, [node(1, "2020-03-02T00:00:00Z")])], as_of=utc(2020, 3, day))
    states, later = store.states_and_events("import_events", schemas.IMPORT_STATES)
    assert states.count() >= 2 and len(later.inputFiles()) <= 4
    assert rows(imports(store), "status", "total_processed") == [
        ("completed", 0), ("completed", 0), ("completed", 0), ("completed", 1),
    ]


def test_rewriting_leaves_later_appends_alone(store):
    def run_at(day):
        at = F.lit(utc(2024, 1, day)).cast("timestamp")
        return store.spark.range(1).select(at.alias("started_at"), at.alias("completed_at"))

    def only_late(rows_now):
        store.append("collector_runs", run_at(3))
        return rows_now.filter("day(started_at) > 1")

    store.append("collector_runs", run_at(1))
    store.append("collector_runs", run_at(2))
    store.rewrite("collector_runs", only_late)
    assert rows(store.read("collector_runs"), F.day("started_at")) == [(2,), (3,)]


def test_interrupted_publishing_is_finished_by_recovery(spark, tmp_path):
    store = Store(spark, str(tmp_path), part_rows=4)
    store.create()
    columns = "p_id string, p_name string, p_path string, p_full_path string, p_web_url string, topics array<string>"
    old = spark.createDataFrame([(f"p{i}", "old", "", "", "", []) for i in range(6)], columns)
    new = spark.createDataFrame([("p1", "new", "", "", "", [])], columns)
    store.merge("projects", old)

    def die(*_):
        raise KeyboardInterrupt

    swap_in, store._swap_in = store._swap_in, die
    with pytest.raises(KeyboardInterrupt):
        store.merge("projects", new)
    assert store.read("projects").filter("p_name = 'new'").count() == 0
    reopened = Store(spark, str(tmp_path), part_rows=4)
    # Opening touches nothing: the other job may still be running.
    assert rows(reopened.read("projects"), "p_name") == [("old",)] * 6
    assert list((tmp_path / "_publish" / "projects").iterdir())
    reopened.recover()
    names = rows(reopened.read("projects"), "p_id", "p_name")
    assert names == [("p0", "old"), ("p1", "new"), *[(f"p{i}", "old") for i in range(2, 6)]]
    assert not list((tmp_path / "_publish" / "projects").iterdir())
    assert swap_in


def test_page_landed_twice_counts_once_and_totals_are_told(store):
    answers = 2 * [page(0, [node(1, "2020-03-02T00:00:00Z"), node(2)], total=7)]
    result = collect(store, answers)
    assert rows(result, "processed", "pages", "batch_count", "total_count") == [(1, 1, 2, 7)]


def test_new_ids_leave_files_alone(store, tmp_path):
    def files():
        folder = tmp_path / "store" / "merge_requests"
        return {p: p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}

    collect(store, [page(0, [node(i, "2020-03-02T00:00:00Z") for i in range(9)])])
    before = files()
    later = "2020-03-10T00:00:00Z"
    more = [page(0, [node(i, "2020-03-12T00:00:00Z") for i in range(5, 15)], since=later)]
    result = collect(store, more, as_of=utc(2020, 3, 20), initial=utc(2020, 3, 10))
    assert rows(result, "processed") == [(6,)]
    assert before.items() <= files().items()
    assert store.read("merge_requests").count() == 15


def test_useless_stored_reply_is_asked_again(store):
    answers = [page(0, [node(1, "2020-03-02T00:00:00Z")]), changes(1, [("a.py", "+x")])]
    reply = '{"category":"Other","title":"t","summary":"s"}'

    first = jobs.Summarizer(lambda _: reply.replace('"t"', '"old"'), "m", parallel=2)
    collect(store, answers, summarizer=first, upsert=True)
    useless = F.lit('{"category":"Other","title":"t","summary":"s","x":1,"x":2}')
    store.replace("model_replies", store.read("model_replies").withColumn("reply", useless))
    again = [page(0, [node(1, "2020-03-12T00:00:00Z")], since="2020-03-10T00:00:00Z"), answers[1]]
    options = {"as_of": utc(2020, 3, 20), "initial": utc(2020, 3, 10), "upsert": True}
    collect(store, again, summarizer=jobs.Summarizer(lambda _: reply, "m", parallel=2), **options)
    assert rows(store.read("merge_requests"), "mr_id", "mr_ai_title") == [("mr-1", "t")]


def test_broken_rows_do_not_reach_a_table(store):
    columns = "p_id string, p_name string, p_path string, p_full_path string, p_web_url string, topics array<string>"
    store.merge("projects", store.spark.createDataFrame([("p1", "n", "", "", "", [])], columns))
    with pytest.raises(BrokenTable, match="p_name"):
        store.merge("projects", store.spark.createDataFrame([("p1", None, "", "", "", [])], columns))
    assert rows(store.read("projects"), "p_id", "p_name") == [("p1", "n")]


PROJECT_COLUMNS = "p_id string, p_name string, p_path string, p_full_path string, p_web_url string, topics array<string>"


def projects(spark, ids, name="n"):
    return spark.createDataFrame([(f"p{i:05}", name, "", "", "", []) for i in ids], PROJECT_COLUMNS)


def test_nothing_of_a_broken_batch_in_new_partitions_is_readable(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.create()
    with pytest.raises(BrokenTable, match="p_name"):
        store.merge("projects", projects(spark, range(4)).unionByName(projects(spark, [9], None)))
    assert store.read("projects").count() == 0
    assert not list((tmp_path / "_publish" / "projects").iterdir())
    # Its keys are entered, but only rows count.
    assert store.holding("projects", projects(spark, range(4))).count() == 0
    store.merge("projects", projects(spark, range(9)))
    assert rows(store.read("projects"), "p_id") == [(f"p{i:05}",) for i in range(9)]


def test_a_job_that_dies_while_renaming_is_finished_by_recovery(spark, tmp_path):
    store = Store(spark, str(tmp_path), part_rows=10)
    store.create()
    move, moved = store._move, []

    def die_later(folder, place):
        if len(moved) == 2:
            raise KeyboardInterrupt
        move(folder, place)
        moved.append(place)

    store._move = die_later
    with pytest.raises(KeyboardInterrupt):
        store.merge("projects", projects(spark, range(60)))
    seen = store.read("projects").count()
    assert 0 < seen < 60
    reopened = Store(spark, str(tmp_path), part_rows=10)
    reopened.recover()
    assert rows(reopened.read("projects"), "p_id") == [(f"p{i:05}",) for i in range(60)]
    reopened.merge("projects", projects(spark, range(60), "new"))
    assert rows(reopened.read("projects"), "p_name") == [("new",)] * 60


def test_an_upsert_rewrites_only_the_partitions_that_hold_its_keys(spark, tmp_path):
    store = Store(spark, str(tmp_path), part_rows=500)
    store.create()
    for start in range(0, 2000, 500):
        store.merge("projects", projects(spark, range(start, start + 500)))
    folder = tmp_path / "projects"
    assert sorted(p.name for p in folder.glob("arrival=*")) == [f"arrival={i}" for i in range(4)]

    def files():
        return {p: p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}

    before = files()
    # Opened with another size: keys stay where they are, new ones go to new partitions.
    store = Store(spark, str(tmp_path), part_rows=100)
    store.merge("projects", projects(spark, [*range(500, 700), *range(5000, 5050)], "new"))
    gone = before.keys() - files().keys()
    assert {p.parent.name for p in gone} == {"arrival=1"}
    assert {p.parent.name for p in files().keys() - before.keys()} == {"arrival=1", "arrival=4"}
    table = store.read("projects")
    assert (table.count(), table.select("p_id").distinct().count()) == (2050, 2050)
    assert table.filter("p_name = 'new'").count() == 250


def test_a_directory_of_many_files_is_sorted_into_few(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("shiplog.plans.store.DIRECTORY_FILES", 3)
    store = Store(spark, str(tmp_path))
    store.create()
    for i in range(5):
        store.merge("projects", projects(spark, [i, i + 1]))
    keys = store.read("projects_keys")
    assert keys.count() == keys.select("p_id").distinct().count() == 6
    assert len(list((tmp_path / "projects_keys").glob("part-*"))) <= 4
    assert store.read("projects").count() == 6


def test_another_layout_is_refused(spark, tmp_path):
    (tmp_path / "collector_runs").mkdir()
    with pytest.raises(ValueError, match="laid out"):
        Store(spark, str(tmp_path))
