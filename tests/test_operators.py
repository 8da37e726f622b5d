"""Operators on small fixtures: merges, budgets, chains, replies, texts."""

import random

import pytest
from conftest import rows, utc
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shiplog.functions.temporal import format_rfc3339, report_end_day, rfc3339, strict_day
from shiplog.functions.text import BLOCK_OVERHEAD, FENCE, byte_prefix, file_block, strip_fences
from shiplog.operators import enrich, merge, pages
from shiplog.operators.budget import diff_text, diff_text_of_changes, within_budget
from shiplog.operators.prefix import committed_prefix
from shiplog.plans import day_plan, ledger

POLICY = merge.MergePolicy(("k",), ("a",), ("b",), ("c",))


def by_hand(target, batch):
    """Row-at-a-time upserts."""
    table = {r[0]: list(r) for r in target}
    for k, a, b, c, _ in sorted(batch, key=lambda r: r[4]):
        if k not in table:
            table[k] = [k, a, b, c]
        else:
            row = table[k]
            row[1] = a
            row[3] = c if c is not None else row[3]
    return sorted(map(tuple, table.values()), key=repr)


def test_merge_equals_row_by_row_upserts_in_any_input_order(spark):
    rng = random.Random(3)
    pick = lambda: rng.choice([None, "x", "y", "z"])
    target = [(k, pick(), pick(), pick()) for k in range(20)]
    # Key 5 holds a third of the batch.
    batch = [
        (5 if i % 3 == 0 else rng.randrange(40), pick(), pick(), pick(), i) for i in range(300)
    ]
    shuffled = batch[:]
    rng.shuffle(shuffled)
    t = spark.createDataFrame(target, "k int, a string, b string, c string")
    b = spark.createDataFrame(shuffled, "k int, a string, b string, c string, o int")
    folded = merge.fold_batch(b, POLICY, ["o"])
    merged = merge.merge_by_key(t, folded, POLICY)
    assert rows(merged) == by_hand(target, batch)
    # Merging in two parts gives the same as merging at once.
    first = merge.merge_by_key(t, merge.fold_batch(b.filter("o < 150"), POLICY, ["o"]), POLICY)
    second = merge.merge_by_key(first, merge.fold_batch(b.filter("o >= 150"), POLICY, ["o"]), POLICY)
    assert rows(second) == rows(merged)


def test_last_arrivals_are_whole_rows_also_for_null_keys_hot_keys_and_ties(spark, tmp_path):
    rng = random.Random(4)
    key = lambda i: 5 if i % 3 == 0 else rng.choice([None, *range(60)])
    data = [(key(i), rng.randrange(3), i // 2 if i % 7 else None, f"row {i}") for i in range(300)]
    # The same row twice, at the same place, as the last of its key.
    data += [(99, 1, 1000, "twice"), (99, 1, 1000, "twice"), (98, 0, 0, "once")]
    batch = spark.createDataFrame(data, "k int, p int, o int, v string")
    batch.write.parquet(f"{tmp_path}/batch")
    batch = spark.read.parquet(f"{tmp_path}/batch")
    best = {}
    for k, p, o, v in data:
        place = (p, -1 if o is None else o)
        if k not in best or place > best[k][0]:
            best[k] = place, set()
        if place == best[k][0]:
            best[k][1].add((k, p, o, v))
    for limit in ("10MB", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            found = [tuple(r) for r in merge.last_arrivals(batch, ["k"], ["p", "o"]).collect()]
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert len(found) == len(best)
        assert all(r in best[r[0]][1] for r in found)
    assert merge.last_arrivals(batch.limit(0), ["k"], ["p"]).count() == 0


def test_insert_absent_takes_the_first_arrival(spark):
    t = spark.createDataFrame([(1, "old")], "k int, a string")
    b = spark.createDataFrame([(1, "n", 0), (2, "second", 2), (2, None, 1)], "k int, a string, o int")
    assert rows(merge.insert_absent(t, b, ["k"], ["o"])) == [(1, "old"), (2, None)]


def cut_by_hand(text, n):
    return text.encode()[: max(n, 0)].decode(errors="ignore")


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="aé€😀�\n", max_size=12), min_size=1, max_size=8))
def test_byte_prefix_never_splits_a_character(spark, texts):
    data = [(t, n) for t in texts for n in range(-1, len(t.encode()) + 2)]
    df = spark.createDataFrame(data, "t string, n int")
    got = df.select(byte_prefix(F.col("t"), F.col("n"))).collect()
    assert [r[0] for r in got] == [cut_by_hand(t, n) for t, n in data]


def text_by_hand(files, budget):
    text = b""
    for path, diff in files:
        block = f"File: {path}\nDiff:\n{diff}\n\n".encode()
        if len(text) + len(block) > budget:
            left = budget - len(text)
            return text.decode() + (block[:left].decode(errors="ignore") if left > 0 else "")
        text += block
    return text.decode()


def test_diff_text_in_both_forms(spark):
    rng = random.Random(5)
    files = [
        (f"p{i}", "".join(rng.choice("aé€😀") for _ in range(rng.randrange(9)))) for i in range(12)
    ]
    whole = len(text_by_hand(files, 10**6).encode())
    first = len(text_by_hand(files[:1], 10**6).encode())
    exact_two = len(text_by_hand(files[:2], 10**6).encode())
    data = [(i, p, d) for i, (p, d) in enumerate(files)]
    df = spark.createDataFrame(data, "pos int, path string, diff string")
    blocks = df.select(F.lit(1).alias("mr"), "pos", file_block(F.col("path"), F.col("diff")).alias("block"))
    changes = df.agg(
        F.array_sort(F.collect_list(F.struct("pos", F.col("path").alias("new_path"), "diff"))).alias("changes")
    ).cache()
    for budget in (0, 1, 14, 15, first - 1, first, first + 1, exact_two, 97, 98, 99, 100, whole, whole + 5):
        want = text_by_hand(files, budget)
        assert changes.select(diff_text_of_changes(F.col("changes"), budget)).first()[0] == want
        for slices in (None, F.expr("pos div 5"), F.lit(0)):
            got = diff_text(blocks, ["mr"], ["pos"], budget, slices).collect()
            assert [r.diff_text for r in got] == ([want] if budget > 0 else [])


def test_short_blocks_reach_the_budget(spark):
    blocks = spark.range(50).selectExpr("1 mr", "id pos", "repeat('x', 4) block")
    got = within_budget(blocks, ["mr"], ["pos"], 100, F.expr("pos div 7"))
    assert rows(got, "pos", "bytes_before", "bytes_used") == sorted(
        ((i, 4 * i, 4) for i in range(25)), key=repr
    )


@pytest.mark.parametrize("budget", [0, 3, 4_000, 10**9])
def test_sums_are_taken_level_by_level(spark, monkeypatch, budget):
    monkeypatch.setattr("shiplog.operators.budget.FAN", 10)
    blocks = spark.range(5000).selectExpr(
        "case when id % 5 < 3 then 'hot' when id % 5 < 4 then 'b' end mr",
        "case when id % 997 > 0 then id * 3 - 700 end pos",
        "repeat('é', cast(id % 4 as int)) block",
    )
    want = within_budget(blocks, ["mr"], ["pos", "block"], budget, span=10)
    got = within_budget(blocks, ["mr"], ["pos", "block"], budget, span=10**5)
    assert rows(got) == rows(want)
    # No window but the uppermost holds more than one cell of sums.
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("_cell") and plan.count("Window") == 6 if budget else True


def test_block_overhead_is_the_fixed_text(spark):
    assert spark.range(1).select(F.octet_length(file_block(F.lit(""), F.lit("")))).first()[0] == BLOCK_OVERHEAD


def test_prefix_stops_before_the_first_bad_unit(spark):
    df = spark.createDataFrame(
        [("a", 1, False), ("a", 2, True), ("a", 3, False), ("b", 1, False), ("c", 1, True)],
        "u string, n int, bad boolean",
    )
    assert rows(committed_prefix(df, ["u"], "n", F.col("bad")), "u", "n") == [("a", 1), ("b", 1)]


def test_chain_breaks(spark):
    chain = [
        ("g", "r", 0, None, "c0", True),
        ("g", "r", 1, "c0", "c1", True),
        ("g", "r", 3, "c2", "c3", False),  # page 2 is missing
        ("h", "r", 0, None, "x", True),
        ("h", "r", 1, "y", "z", False),  # asked with another cursor
        ("i", "r", 0, None, "x", False),
        ("i", "r", 1, "x", "z", False),  # the chain had ended
        ("j", "r", 4, "k", "l", False),  # a resumed chain starts anywhere
    ]
    df = spark.createDataFrame(
        chain,
        "group_key string, request_key string, page_no int, after_cursor string, "
        "end_cursor string, has_next_page boolean",
    )
    assert rows(pages.chain_breaks(df), "group_key", "page_no", "broken") == [
        ("g", 0, False), ("g", 1, False), ("g", 3, True), ("h", 0, False), ("h", 1, True),
        ("i", 0, False), ("i", 1, True), ("j", 4, False),
    ]


@pytest.mark.parametrize(
    ("reply", "clean"),
    [
        ('{"a":1}', '{"a":1}'),
        (f'{FENCE}json\n{{"a":1}}\n{FENCE}', '{"a":1}'),
        (f' {FENCE}json{FENCE}json{FENCE}{{"a":1}}{FENCE}{FENCE} \n', '{"a":1}'),
        (f"{FENCE}{FENCE}json x", "json x"),
        ("", ""),
    ],
)
def test_strip_fences(spark, reply, clean):
    assert spark.range(1).select(strip_fences(F.lit(reply))).first()[0] == clean


def test_model_is_asked_three_times_at_most(spark, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()

    def complete(prompt):
        calls = len(list(log.glob(f"{prompt}-*")))
        (log / f"{prompt}-{calls}").touch()
        if prompt == "late" and calls < 2 or prompt == "never":
            raise RuntimeError("busy")
        if prompt == "vague" and calls < 1:
            return "not JSON"
        return FENCE + '{"category":"Other","title":"t","summary":"s","x":1}'

    prompts = spark.createDataFrame(
        [(p, "h", p) for p in ("plain", "late", "vague", "never")],
        "mr_id string, prompt_hash string, prompt string",
    ).coalesce(1)
    answers = enrich.parse_replies(enrich.ask_model(prompts, complete)).select("mr_id", "answer.title")
    assert rows(answers) == [("late", "t"), ("never", None), ("plain", "t"), ("vague", "t")]
    calls = sorted(p.name.split("-")[0] for p in log.iterdir())
    assert {p: calls.count(p) for p in set(calls)} == {"plain": 1, "late": 3, "vague": 2, "never": 3}


def test_model_calls_are_dealt_over_all_tasks(spark):
    prompts = spark.range(1000).selectExpr("cast(id as string) mr_id", "'h' prompt_hash", "'p' prompt")
    asked = enrich.ask_model(prompts.dropDuplicates(["mr_id"]), lambda _: "no", parallel=8)
    counts = [r["count"] for r in asked.groupBy(F.spark_partition_id()).count().collect()]
    assert len(counts) == 8 and max(counts) < 200


def test_one_rule_for_replies(spark):
    good = '"category":"Other","title":"t","summary":"s"'
    replies = {
        f"{{{good}}}": True,
        f'{{{good},"x":1,"y":{{"z":null}}}}': True,
        f'{{{good},"x":1,"x":2}}': False,
        f'{{{good},"title":"u"}}': False,
        f'{{{good},"x":NaN}}': False,
        f"{{{good}}} done": False,
        '{"category":"Other","title":"t"}': False,
    }
    df = spark.createDataFrame([(r,) for r in replies], "reply string")
    parsed = {r.reply: r.answer is not None for r in enrich.parse_replies(df).collect()}
    assert parsed == replies
    assert {r: enrich.readable(r) for r in replies} == replies


def test_times(spark):
    texts = {
        "2024-02-29T10:00:00Z": "2024-02-29T10:00:00Z",
        "2024-02-29t10:00:00.25+02:00": "2024-02-29T08:00:00.25Z",
        "2023-02-29T10:00:00Z": None,
        "2024-02-29T10:00:00": None,
        "2024-02-29 10:00:00Z": None,
        "2024-02-29T10:00Z": None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(format_rfc3339(rfc3339(F.col("t")))).collect()] == list(texts.values())
    days = spark.createDataFrame([("2024-01-01",), ("2024-1-1",), ("2024-02-30",), ("2024-01-01T00",)], "t string")
    got = [str(r[0]) for r in days.select(strict_day(F.col("t"))).collect()]
    assert got == ["2024-01-01", "None", "None", "None"]
    ends = spark.createDataFrame([(2,), (0,), (-3,)], "lag int").select(
        report_end_day(F.lit(utc(2024, 3, 4, 1)), F.col("lag")).cast("string")
    )
    assert [r[0] for r in ends.collect()] == ["2024-03-02", "2024-03-04", "2024-03-04"]


def test_watermark_order(spark):
    orgs = spark.createDataFrame([("a",), ("b",)], "org_slug string")
    runs = spark.createDataFrame(
        [("a", utc(2024, 1, 1), utc(2024, 1, 2)), ("a", utc(2024, 1, 5), utc(2024, 1, 6))],
        "org_slug string, started_at timestamp, completed_at timestamp",
    )
    last = ledger.latest_run_per_org(runs)
    none = F.lit(None)
    now = F.lit(utc(2024, 2, 1))
    at = F.day("updated_after")
    assert rows(day_plan.org_watermarks(orgs, last, none, now), "org_slug", at) == [("a", 6), ("b", 1)]
    assert rows(
        day_plan.org_watermarks(orgs, last, F.lit(utc(2023, 12, 9)), now, "started_at"), "org_slug", at
    ) == [("a", 5), ("b", 9)]
    empty = runs.limit(0)
    assert day_plan.run_watermark(ledger.latest_run(empty), none, now).count() == 1


def test_empty_day_plan(spark):
    points = spark.sql("select 'a' org_slug, date'2024-01-05' start_day")
    assert day_plan.plan_days(points, F.lit("2024-01-04")).count() == 0
    assert day_plan.plan_days(points, F.lit("2024-01-05")).count() == 1


def test_lines_that_are_made_are_made_once(spark):
    """The filter on blank lines does not go below what makes them."""
    from shiplog.operators.usage_records import decode_lines

    rows_ = spark.createDataFrame([(1, "a"), (2, " ")], "k int, t string")
    lines_ = rows_.repartition(2, "k").withColumn("line", F.expr("regexp_replace(t, 'a', '{}')"))
    decoded = decode_lines(lines_)
    assert decoded._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 1
    assert [r.k for r in decoded.collect()] == [1]


def test_last_arrivals_meet_the_batch_once_without_ties(spark):
    from shiplog.operators.merge import last_arrivals

    batch = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, n int, v string")
    last = last_arrivals(batch, ["k"], ["n"])
    assert last._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    assert sorted(r.v for r in last.collect()) == ["b", "c"]
    tied = last_arrivals(batch.unionByName(batch), ["k"], ["n"])
    assert sorted(r.v for r in tied.collect()) == ["b", "c"]
