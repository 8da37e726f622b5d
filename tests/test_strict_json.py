"""Strict decoding: what is refused, what is filled in, and quick acceptance against the exact check."""

import itertools
import json

from conftest import usage_record
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiplog import schemas
from shiplog.functions.strict_json import (
    BIGINT,
    BOOLEAN,
    DEFAULT,
    DOUBLE,
    OPTIONAL,
    REPEATS_SETTING,
    STRING,
    Arr,
    Field,
    _is_plain,
    obj,
    repeats_known_key,
    with_decoded,
    with_unknown_repeats,
)
from shiplog.session import staged_under

SPEC = obj(
    Field("id", BIGINT),
    Field("name", STRING),
    Field("note", STRING, OPTIONAL),
    Field("n", BIGINT, DEFAULT),
    Field("on", BOOLEAN, DEFAULT),
    Field("avg", DOUBLE, DEFAULT),
    Field("kids", Arr(obj(Field("key", STRING), Field("n", BIGINT, DEFAULT))), DEFAULT),
    Field("box", obj(Field("tag", STRING)), OPTIONAL),
)

GOOD = {
    '{"id":1,"name":"a"}': (1, "a", None, 0, False, 0.0, [], None),
    ' {"name":"7","id":-0,"zzz":{"id":[]},"avg":3,"note":null} \t': (0, "7", None, 0, False, 3.0, [], None),
    '{"id":9223372036854775807,"name":"null","kids":[{"key":"k"},{"n":2,"key":"5"}],"box":null}': (
        9223372036854775807, "null", None, 0, False, 0.0, [("k", 0), ("5", 2)], None,
    ),
    '{"id":1,"\\u006eame":"\\u00e9","box":{"tag":"t"},"on":true,"avg":1.5e0}': (
        1, "é", None, 0, True, 1.5, [], ("t",),
    ),
}
BAD = [
    "", "7", "[]", "null", '"x"', "{}", "{", '{"id":1,"name":"a"} x', '{"id":1,"name":"a"}}',
    '{"id":1,"name":"a"},{"id":1,"name":"a"}', '{"id":1,"name":"a"}],[{"id":1,"name":"a"}',
    '[{"id":1,"name":"a"}]', '{"id":1,"name":"a","id":1}', "{'id':1,'name':'a'}",
    '{"id":1,"name":"a"},"x":{"id":1,"name":"a"}',
]
WRONG_VALUES = {
    "id": ["null", '"1"', "1.0", "1e0", "true", "12345678901234567890", "[]", "{}"],
    "name": ["null", "7", "1.5", "true", "[]", "{}", '["a"]'],
    "note": ["7", "false", "{}"],
    "n": ["null", '"1"', "0.5", "[1]"],
    "on": ["null", '"true"', "1", "0"],
    "avg": ["null", '"1.0"', '"NaN"', "NaN", "true"],
    "kids": ["null", "{}", "7", "[null]", "[7]", "[{}]", '[{"key":null}]', '[{"key":7}]',
             '[{"key":"a","n":null}]', '[{"key":"a","n":"1"}]', '[{"key":"a"},{"key":true}]'],
    "box": ["{}", "[]", "7", '{"tag":null}', '{"tag":7}', '{"tag":{}}'],
}


def wrong_texts():
    for name, values in WRONG_VALUES.items():
        for value in values:
            parts = {"id": "1", "name": '"a"', name: value}
            yield "{" + ",".join(f'"{k}" : {v}' for k, v in parts.items()) + "}"


def decode(spark, texts, spec, quick=True):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    rows = with_decoded(df, "text", spec, "record", quick=quick).orderBy("i").collect()
    return [r.record for r in rows]


def plain(value):
    if isinstance(value, list):
        return [plain(v) for v in value]
    return tuple(plain(v) for v in value) if isinstance(value, tuple) else value


def test_good_texts_are_typed_and_filled(spark):
    for quick in (True, False):
        assert [plain(r) for r in decode(spark, GOOD, SPEC, quick)] == list(GOOD.values())


def test_bad_texts_are_refused(spark):
    texts = BAD + list(wrong_texts())
    for quick in (True, False):
        found = decode(spark, texts, SPEC, quick)
        assert [t for t, r in zip(texts, found, strict=True) if r is not None] == []


def test_null_text_is_refused(spark):
    assert decode(spark, [None], SPEC) == [None]


def test_quick_acceptance_agrees_with_the_exact_check_on_usage_records(spark):
    """Every field of a full record given every kind of value, or removed."""
    counts = dict.fromkeys(schemas.MEASURES, 1)
    full = usage_record(
        1,
        "2024-01-01",
        enterprise_id=None,
        **counts,
        **dict.fromkeys(schemas.FLAGS, True),
        totals_by_feature=[{"feature": "12", **counts}, {"feature": "x"}],
        totals_by_ide=[
            {"ide": "e", **counts, "last_known_ide_version": {"sampled_at": "s", "ide_version": "1.0"}}
        ],
        totals_by_cli={"session_count": 1, "token_usage": {"avg_tokens_per_request": 1.5}},
    )
    values = [None, 1, 1.5, "1", "text", True, [], {}, [None], [{"feature": None}], float("nan")]
    texts = [json.dumps(full)]
    for name in full:
        texts.append(json.dumps({k: v for k, v in full.items() if k != name}))
        texts += [json.dumps({**full, name: v}) for v in values]
    for inner, key in itertools.product(("totals_by_feature", "totals_by_ide"), ("feature", "ide", *counts)):
        texts += [json.dumps({**full, inner: [{**full[inner][0], key: v}]}) for v in values]
    quick = decode(spark, texts, schemas.USAGE_RECORD, True)
    exact = decode(spark, texts, schemas.USAGE_RECORD, False)
    assert quick == exact
    assert quick[0] is not None and 20 < sum(r is None for r in quick) < len(texts)


def test_decoding_is_not_repeated_by_a_later_filter(spark):
    df = spark.createDataFrame([("{}",)], "text string")
    plan = (
        with_decoded(df, "text", SPEC, "record")
        .filter(F.col("record").isNotNull())
        .select("record.*")
        ._jdf.queryExecution()
        .optimizedPlan()
        .toString()
    )
    assert plan.count("parseJson") == 1 and plan.count("from_json") == 1


REPEATS = {
    '{"zzz":1,"zzz":2,"id":1,"name":"5"}': True,
    '{"id":1,"name":"a","kids":[{"key":"k","x":1,"x":2},{"key":"l"}]}': True,
    '{"id":1,"name":"a","zzz":{"id":1,"id":2}}': True,
    '{"id":1,"name":"a","box":{"tag":"t","u":[{"v":1,"v":1}]}}': True,
    '{"zzz":1,"zzz":2,"id":1,"name":5}': False,
    '{"zzz":1,"zzz":2,"id":1}': False,
    '{"zzz":1,"zzz":2,"id":1,"name":"a"} x': False,
    '{"zzz":1,"zzz":2,"id":1,"name":"a","id":1}': False,
    '{"zzz":1,"zzz":2,"id":1,"name":"a","\\u0069d":1}': False,
    '{"id":1,"name":"a","kids":[{"key":"l"},{"key":"k","key":"k"}]}': False,
    '{"id":1,"name":"a","box":{"tag":"t","tag":"t"}}': False,
    '{"zzz":1,"zzz":2': False,
}


def test_only_repeats_of_known_keys_are_refused(spark):
    df = spark.createDataFrame([(t,) for t in REPEATS], "text string")
    first = with_decoded(df, "text", SPEC, "record")
    assert {r.text for r in first.collect() if r.record} == set()
    again = staged_under(
        REPEATS_SETTING, df, lambda d: with_unknown_repeats(d, "text", SPEC, "record"), "again"
    )
    assert {r.text: r.record is not None for r in again.collect()} == REPEATS
    # The caller's session still refuses them.
    assert spark.sql("""select try_parse_json('{"a":1,"a":2}') v""").first().v is None


def test_repeated_keys_are_found_with_one_parse_per_level():
    """Not one scan of the whole text for each of its objects."""
    assert "get_json_object" not in repeats_known_key("line", schemas.USAGE_RECORD)
    assert repeats_known_key("line", schemas.USAGE_RECORD).count("(line") == 2


LOOKALIKES = {
    '{"id":1,"name":"7","kids":[{"key":"5"},{"key":"true"}],"box":{"tag":"[]"}}': True,
    '{"id":1,"name":"7","note" : "1","kids":[{"key" :\n"5"}]}': True,
    '{"id":1,"name":7}': False,
    '{"id":1,"name":"a","kids":[{"key":"5"},{"key" : 5}]}': False,
    '{"id":1,"name":"a","kids":[{"key":"5"},{"\\u006bey":5}]}': False,
    '{"id":1,"name":"a","box":{"tag":{\n"x":1}}}': False,
    '{"id":1,"name":"a","box":{"tag":[\n1]}}': False,
}


def test_strings_that_read_like_numbers_need_no_exact_check(spark):
    """What follows their keys tells them from numbers."""
    typed = T.StructType([*SPEC.spark_type, T.StructField("_corrupt", T.StringType())])
    df = spark.createDataFrame([(t,) for t in LOOKALIKES], "text string").withColumns(
        {
            "_typed": F.from_json("text", typed, {"columnNameOfCorruptRecord": "_corrupt"}),
            "_holds_null": F.contains("text", F.lit("null")),
        }
    )
    plain = df.select("text", F.expr(_is_plain("text", SPEC)).alias("plain")).collect()
    assert {r.text: r.plain for r in plain} == LOOKALIKES
    for quick in (True, False):
        found = decode(spark, LOOKALIKES, SPEC, quick)
        assert [r is not None for r in found] == list(LOOKALIKES.values())
