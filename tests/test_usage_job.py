import json
import threading
import time
from concurrent.futures import ThreadPoolExecutor
from datetime import date

import pytest
from conftest import landing, lines, rows, usage_record, utc
from pyspark.sql import functions as F

from shiplog.operators.usage_facts import breakdown, raw_payload
from shiplog.plans import jobs, ledger
from shiplog.plans.store import ClaimHeld, Store
from shiplog.sources.usage_parts import part_files, read_part_files

ORG = "acme"
NOW = utc(2024, 3, 4, 9)
FIRST = utc(2024, 3, 1)


def index(day, n, status=200, minute=0, org=ORG):
    links = [f"https://reports.example/{day}/{i}" for i in range(n)]
    body = {"download_links": links, "report_day": day} if status == 200 else "oops"
    return ("usage_index", org, day, None, None, status, body, minute)


def part(day, no, body, status=200, minute=0, org=ORG):
    return ("usage_part", org, day, no, None, status, body, minute)


def feature(name, **counts):
    return {"feature": name, **counts}


def state(store):
    return jobs.current_imports(store)


def run(spark, store, answers, **options):
    options = {"as_of": NOW, "initial": FIRST, "lag_days": 2, **options}
    return jobs.import_usage(store, landing(spark, answers), [ORG], **options)


def test_two_parts_make_one_day(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.create()
    cli = {
        "session_count": 3,
        "token_usage": {"output_tokens_sum": 10, "avg_tokens_per_request": 2.5},
        "last_known_cli_version": {"sampled_at": "2024-03-01T10:00:00Z", "cli_version": "1.0"},
    }
    ide = {
        "ide": "editor",
        "last_known_ide_version": {"sampled_at": "2024-03-01T10:00:00Z", "ide_version": "9"},
    }
    one = usage_record(
        101,
        "2024-03-01",
        enterprise_id="",
        totals_by_feature=[feature("chat", loc_added_sum=4), feature("completion")],
        totals_by_ide=[ide],
    )
    two = usage_record(
        202,
        "2024-03-01",
        totals_by_feature=[feature("chat"), feature("agent")],
        totals_by_ide=[{"ide": "other"}],
        totals_by_cli=cli,
    )
    summary = run(
        spark,
        store,
        [index("2024-03-01", 2), part("2024-03-01", 0, lines(one)), part("2024-03-01", 1, lines("", two))],
        as_of=utc(2024, 3, 3),
    )
    assert rows(
        summary.select("days_advanced", "records_persisted", F.col("last_completed_report_day").cast("string"))
    ) == [(1, 2, "2024-03-01")]
    facts = store.read("usage_facts")
    assert rows(facts, "user_id", "enterprise_id", "totals_by_cli.session_count") == [
        (101, None, None),
        (202, None, 3),
    ]
    assert breakdown(facts, "totals_by_feature").count() == 4
    assert rows(breakdown(facts, "totals_by_ide"), "user_id", "ide", "last_known_ide_version.ide_version") == [
        (101, "editor", "9"),
        (202, "other", None),
    ]
    payload = json.loads(raw_payload(facts).filter("user_id = 101").first().raw_payload)
    assert payload["enterprise_id"] == "" and payload["totals_by_cli"] is None
    assert payload["totals_by_feature"][0]["loc_added_sum"] == 4
    assert payload["used_chat"] is False and payload["day"] == "2024-03-01"
    assert rows(store.read("usage_runs"), "org_slug", F.col("last_completed_report_day").cast("string")) == [
        (ORG, "2024-03-01")
    ]


def test_resume_after_a_failed_day(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.create()
    answers = [
        index("2024-03-01", 1),
        part("2024-03-01", 0, lines(usage_record(1, "2024-03-01"))),
        index("2024-03-02", 1),
        part("2024-03-02", 0, "down", status=500),
    ]
    first = run(spark, store, answers)
    assert rows(first, "days_advanced", "succeeded") == [(1, False)]
    now = state(store)
    assert rows(now, "status", "last_cursor", "total_processed") == [("failed", "2024-03-01", 1)]
    assert "500" in now.first().error_message
    assert store.read("usage_runs").count() == 0
    assert store.read("usage_facts").count() == 1

    answers += [
        index("2024-03-02", 1, minute=5),
        part("2024-03-02", 0, lines(usage_record(2, "2024-03-02")), minute=5),
    ]
    second = run(spark, store, answers)
    assert rows(second, "days_advanced", "records_persisted", "succeeded") == [(1, 1, True)]
    assert rows(state(store), "status", "last_cursor", "total_processed", "error_message") == [
        ("completed", "2024-03-02", 2, None)
    ]
    assert rows(store.read("usage_facts"), "user_id") == [(1,), (2,)]
    # Nothing left to do: the plan is empty and the import completes at once.
    third = run(spark, store, answers)
    assert rows(third, "days_advanced", "succeeded") == [(0, True)]


def test_no_report_on_the_end_day_stops_and_earlier_advances(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.create()
    answers = [
        index("2024-03-01", 0, status=204),
        index("2024-03-02", 0, status=204),
    ]
    summary = run(spark, store, answers)
    assert rows(summary, "days_advanced", "records_persisted", "halted_by", "succeeded") == [
        (1, 0, "stop", True)
    ]
    assert rows(state(store), "status", "last_cursor") == [("completed", "2024-03-01")]


def test_day_not_landed_waits(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.create()
    answers = [index("2024-03-01", 2), part("2024-03-01", 0, lines(usage_record(1, "2024-03-01")))]
    summary = run(spark, store, answers)
    assert rows(summary, "days_advanced", "halted_by", "succeeded") == [(0, "wait", True)]
    assert store.read("usage_facts").count() == 0


def test_bad_days_commit_nothing(spark, tmp_path):
    repeated = usage_record(1, "2024-03-01", totals_by_feature=[feature("x"), feature("x")])
    bad = {
        "unreadable": lines(usage_record(1, "2024-03-01"), '{"user_id": 1'),
        "record of day": lines(usage_record(1, "2024-03-02")),
        "repeated key": lines(usage_record(2, "2024-03-01"), repeated),
        "unreadable day": lines(usage_record(1, "2024-3-1")),
    }
    store = Store(spark, str(tmp_path))
    store.create()
    answers = []
    for org, body in enumerate(bad.values()):
        answers += [
            index("2024-03-01", 1, org=str(org)),
            part("2024-03-01", 0, body, org=str(org)),
        ]
    summary = jobs.import_usage(
        store,
        landing(spark, answers),
        [str(org) for org in range(len(bad))],
        as_of=NOW,
        initial=FIRST,
    ).orderBy("org_slug")
    for row, message in zip(summary.collect(), bad, strict=True):
        assert (row.days_advanced, row.succeeded) == (0, False)
        assert message in row.error
    assert store.read("usage_facts").count() == 0


def test_reimport_keeps_missing_users_and_replaces_children(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.create()
    day = "2024-03-01"
    answers = [
        index(day, 1),
        part(
            day,
            0,
            lines(
                usage_record(1, day, totals_by_feature=[feature("a"), feature("b")]),
                usage_record(2, day, totals_by_feature=[feature("a")]),
            ),
        ),
    ]
    run(spark, store, answers, as_of=utc(2024, 3, 3))
    answers += [
        index(day, 1, minute=9),
        part(
            day,
            0,
            lines(
                usage_record(1, day, loc_added_sum=5),
                usage_record(1, day, loc_added_sum=6, totals_by_feature=[feature("c")]),
                usage_record(3, day),
            ),
            minute=9,
        ),
    ]
    for _ in range(2):  # the second time changes nothing
        jobs.reimport_days(
            store,
            landing(spark, answers),
            spark.sql(f"select '{ORG}' org_slug, date'{day}' report_day"),
            as_of=utc(2024, 3, 9),
        )
        facts = store.read("usage_facts")
        assert rows(facts, "user_id", "loc_added_sum", F.day("created_at"), F.day("updated_at")) == [
            (1, 6, 3, 9),
            (2, 0, 3, 3),
            (3, 0, 9, 9),
        ]
        assert rows(breakdown(facts, "totals_by_feature"), "user_id", "feature") == [
            (1, "c"),
            (2, "a"),
        ]


def test_part_files_are_read_in_line_order_across_splits(spark, tmp_path):
    folder = tmp_path / "parts" / f"org_slug={ORG}" / "report_day=2024-03-01"
    folder.mkdir(parents=True)
    many = [usage_record(i % 7, "2024-03-01", loc_added_sum=i) for i in range(4000)]
    (folder / "0.jsonl").write_text(lines(*many).replace("\n", "\r\n"))
    (folder / "1.jsonl").write_text(lines(usage_record(3, "2024-03-01", loc_added_sum=-1)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        found = read_part_files(spark, str(tmp_path / "parts"))
        assert found.select("block_start").distinct().count() > 3
        store = Store(spark, str(tmp_path / "store"))
        store.create()
        answers = [index("2024-03-01", 2), part("2024-03-01", 0, None), part("2024-03-01", 1, None)]
        summary = run(spark, store, answers, as_of=utc(2024, 3, 3), part_lines=found)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert rows(summary, "records_persisted") == [(4001,)]
    last = {u: max(i for i in range(4000) if i % 7 == u) for u in range(7)}
    last[3] = -1
    assert rows(store.read("usage_facts"), "user_id", "loc_added_sum") == sorted(last.items(), key=repr)


def good_day(day, user=1, minute=0):
    return [index(day, 1, minute=minute), part(day, 0, lines(usage_record(user, day)), minute=minute)]


def test_answers_landed_twice_count_once(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.create()
    summary = run(spark, store, 2 * good_day("2024-03-01"), as_of=utc(2024, 3, 3))
    assert rows(summary, "days_advanced", "records_persisted") == [(1, 1)]
    assert rows(state(store), "total_processed") == [(1,)]


def test_waiting_import_stays_open_with_its_cursor(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.create()
    answers = good_day("2024-03-01") + [index("2024-03-02", 1), part("2024-03-02", 0, "down", status=500)]
    assert rows(run(spark, store, answers), "days_advanced", "succeeded") == [(1, False)]
    waiting = good_day("2024-03-01") + [index("2024-03-02", 1, minute=5)]
    assert rows(run(spark, store, waiting), "days_advanced", "halted_by") == [(0, "wait")]
    assert rows(state(store), "status", "last_cursor") == [("in_progress", "2024-03-01")]
    third = run(spark, store, good_day("2024-03-01") + good_day("2024-03-02", 2, minute=5), initial=None)
    assert rows(third, "days_advanced", "records_persisted", "halted_by") == [(1, 1, None)]
    assert rows(state(store), "status", "last_cursor") == [("completed", "2024-03-02")]


def test_two_imports_of_one_time_have_two_ids(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.create()
    run(spark, store, good_day("2024-03-01"), lag_days=3)
    run(spark, store, good_day("2024-03-01") + good_day("2024-03-02"), lag_days=2)
    found = state(store)
    assert rows(found, "last_cursor", "status") == [
        ("2024-03-01", "completed"),
        ("2024-03-02", "completed"),
    ]
    assert found.select("import_id").distinct().count() == 2


def test_part_files_of_other_orgs_and_days_are_not_listed(spark, tmp_path):
    for org in (ORG, "other"):
        for day in ("2024-03-01", "2024-03-02", "2024-04-01"):
            folder = tmp_path / f"org_slug={org}" / f"report_day={day}"
            folder.mkdir(parents=True)
            (folder / "0.jsonl").write_text(lines(usage_record(1, day)))
    read = part_files(spark, str(tmp_path))([ORG], date(2024, 3, 1), date(2024, 3, 2))
    assert read.count() == 2
    plan = read._jdf.queryExecution().executedPlan().toString()
    filters = plan.partition("PartitionFilters: [")[2].partition("]")[0]
    assert "org_slug" in filters and "report_day" in filters
    # The file index holds the planned folders only, whether they were asked for or listed.
    assert len(read.inputFiles()) == 2
    for first, last, n in ((1, 1, 1), (2, 28, 1), (3, 9, 0), (20, 30, 0)):
        days = date(2024, 3, first), date(2024, 3, last)
        found = part_files(spark, str(tmp_path))([ORG, "absent", ORG], *days)
        assert (len(found.inputFiles()), found.count()) == (n, n)


def test_lines_that_repeat_unknown_keys_do_not_fail_a_day(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.create()
    record = json.dumps(usage_record(1, "2024-03-01"))
    twice = '{"zzz":1,"zzz":2,' + record[1:]
    answers = [index("2024-03-01", 1), part("2024-03-01", 0, twice + "\n" + lines(usage_record(2, "2024-03-01")))]
    summary = run(spark, store, answers, as_of=utc(2024, 3, 3))
    assert rows(summary, "days_advanced", "records_persisted") == [(1, 2)]
    known = '{"user_id":9,' + record[1:]
    answers += [index("2024-03-02", 1), part("2024-03-02", 0, known)]
    assert rows(run(spark, store, answers), "days_advanced", "halted_by") == [(0, "fail")]


def test_reimport_from_files(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    store.create()
    folder = tmp_path / "parts" / f"org_slug={ORG}" / "report_day=2024-03-01"
    folder.mkdir(parents=True)
    (folder / "0.jsonl").write_text(lines(usage_record(4, "2024-03-01")))
    days = spark.sql(f"select '{ORG}' org_slug, date'2024-03-01' report_day")
    judged = jobs.reimport_days(
        store,
        landing(spark, [index("2024-03-01", 1), part("2024-03-01", 0, None)]),
        days,
        as_of=NOW,
        part_lines=part_files(spark, str(tmp_path / "parts")),
    )
    assert rows(judged, "verdict") == [("commit",)]
    assert rows(store.read("usage_facts"), "user_id") == [(4,)]


def test_late_and_corrected_days_are_found_and_imported_again(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.create()
    answers = good_day("2024-03-01") + [index("2024-03-02", 0, status=204)]
    run(spark, store, answers, as_of=utc(2024, 3, 5))
    assert jobs.find_late_days(store, landing(spark, answers), [ORG]).count() == 0
    answers += good_day("2024-03-01") + good_day("2024-03-02", 2)
    answers += good_day("2024-03-09")  # not imported yet
    landed = landing(spark, answers)
    landed = landed.withColumn("landed_at", F.lit("2024-07-01").cast("timestamp"))
    old = landing(spark, answers[:3]).withColumn("landed_at", F.lit("2024-03-04").cast("timestamp"))
    landed = old.unionByName(landed.filter("status = 200"))
    late = jobs.find_late_days(store, landed, [ORG])
    assert rows(late, F.day("report_day")) == [(2,)]
    jobs.reimport_days(store, landed, late, as_of=utc(2024, 8, 1))
    assert rows(store.read("usage_facts"), "user_id", F.day("report_day")) == [(1, 1), (2, 2)]
    assert jobs.find_late_days(store, landed, [ORG]).count() == 0


def test_two_imports_of_a_scope_exclude_each_other(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.create()
    other = Store(spark, str(tmp_path))
    with store.claim([f"{ledger.USAGE_IMPORT}/{ORG}", "projects/a/b"]):
        with pytest.raises(ClaimHeld, match=ORG):
            run(spark, other, good_day("2024-03-01"))
        with other.claim([f"{ledger.USAGE_IMPORT}/idle"]):
            pass
    assert store.read("import_events").count() == 0
    assert rows(run(spark, other, good_day("2024-03-01"), as_of=utc(2024, 3, 3)), "days_advanced") == [(1,)]
    # A job that died keeps its claim until the store is recovered.
    died = store.claim([f"{ledger.USAGE_IMPORT}/{ORG}"])
    died.__enter__()
    with pytest.raises(ClaimHeld):
        run(spark, other, good_day("2024-03-01"))
    other.recover()
    run(spark, other, good_day("2024-03-01"), as_of=utc(2024, 3, 3))


def test_of_many_claims_at_once_one_is_granted(spark, tmp_path):
    store, granted, ready = Store(spark, str(tmp_path)), [], threading.Barrier(6)

    def attempt(_):
        ready.wait()
        try:
            with store.claim(["usage/acme"]):
                granted.append(1)
                time.sleep(8)
        except ClaimHeld:
            pass

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(attempt, range(6)))
    assert granted == [1]
