import json

from conftest import landing, lines, rows, usage_record, utc
from pyspark.sql import functions as F

from shiplog.plans import jobs, ledger
from shiplog.plans.store import Store
from shiplog.sources.landing import land
from shiplog.streaming.usage_stream import stream_usage


def test_a_day_that_arrives_in_two_triggers_commits_once_complete(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    store.create()
    path = str(tmp_path / "landing")
    day = "2024-03-01"
    index = {"download_links": ["a", "b"], "report_day": day}

    def run():
        stream_usage(
            spark,
            path,
            store,
            ["acme", "idle"],
            str(tmp_path / "checkpoint"),
            clock=lambda: utc(2024, 3, 3),
            initial=utc(2024, 3, 1),
        ).awaitTermination()

    first = [
        ("usage_index", "acme", day, None, None, 200, index),
        ("usage_part", "acme", day, 0, None, 200, lines(usage_record(1, day))),
        ("usage_index", "stranger", day, None, None, 200, index),
    ]
    land(landing(spark, first), path)
    run()
    assert store.read("usage_facts").count() == 0
    land(landing(spark, [("usage_part", "acme", day, 1, None, 200, lines(usage_record(2, day)))]), path)
    run()
    assert rows(store.read("usage_facts"), "org_slug", "user_id") == [("acme", 1), ("acme", 2)]
    before = store.read("import_events").count()
    run()  # no news
    assert store.read("import_events").count() == before
    runs = ledger.latest_run_per_org(store.read("usage_runs"))
    assert rows(runs, "org_slug", F.col("last_completed_report_day").cast("string")) == [("acme", day)]


def test_every_part_is_decoded_once_over_three_triggers(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"))
    store.create()
    path, decoded = str(tmp_path / "landing"), []

    def counted(lines_):
        decoded.extend((r.org_slug, str(r.report_day), r.part_no) for r in lines_.collect())
        return decode(lines_)

    decode = jobs.usage_records.decode_lines
    monkeypatch.setattr(jobs.usage_records, "decode_lines", counted)

    def run(*answers):
        land(landing(spark, list(answers)), path)
        stream_usage(
            spark, path, store, ["acme"], str(tmp_path / "checkpoint"),
            clock=lambda: utc(2024, 3, 4), initial=utc(2024, 3, 1),
        ).awaitTermination()

    def index(day, *links):
        body = {"download_links": list(links), "report_day": day}
        return ("usage_index", "acme", day, None, None, 200, body)

    def part(day, no, user):
        return ("usage_part", "acme", day, no, None, 200, json.dumps(usage_record(user, day)))

    one, two = "2024-03-01", "2024-03-02"
    # The second day is complete first; a part may come before its index.
    run(index(two, "a"), part(two, 0, 5), part(one, 1, 2))
    assert decoded == [] and store.read("usage_facts").count() == 0
    run(index(one, "a", "b", "c"), part(one, 2, 3))
    assert decoded == []
    run(part(one, 0, 1))
    assert sorted(decoded) == [("acme", one, 0), ("acme", one, 1), ("acme", one, 2), ("acme", two, 0)]
    assert rows(store.read("usage_facts"), "user_id") == [(1,), (2,), (3,), (5,)]
