"""Strict decoding of JSON text against a fixed specification, as Spark columns.

`from_json` is lenient: it turns numbers into strings, cannot tell a missing field from an
explicit null, and ignores text after the document and repeated keys. So the text is also parsed
into a VARIANT, which settles what `from_json` lets through.

VARIANT refuses a text in which any object repeats a key. Only keys of the specification must not
repeat; `with_unknown_repeats` takes a second look at refused texts.

Rules per field:
  required   must be there, of the right type, not null
  default    may be missing (then 0 / false / []), must not be null
  optional   may be missing or null

The expressions are built as SQL text: a specification has some hundred fields, and one parse of a
text is far quicker than as many calls into the JVM.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REQUIRED, DEFAULT, OPTIONAL = "required", "default", "optional"


@dataclass(frozen=True)
class Scalar:
    spark_type: T.DataType
    zero: str
    accepts: Callable[[str], str]


STRING = Scalar(T.StringType(), "''", lambda kind: f"{kind} = 'STRING'")
BIGINT = Scalar(T.LongType(), "0L", lambda kind: f"{kind} = 'BIGINT'")
BOOLEAN = Scalar(T.BooleanType(), "false", lambda kind: f"{kind} = 'BOOLEAN'")
DOUBLE = Scalar(
    T.DoubleType(), "0D", lambda kind: f"regexp_like({kind}, '^(BIGINT|DOUBLE|DECIMAL.*)$')"
)


@dataclass(frozen=True)
class Field:
    name: str
    type: Scalar | Obj | Arr
    presence: str = REQUIRED


@dataclass(frozen=True)
class Obj:
    fields: tuple[Field, ...]

    @property
    def spark_type(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.type.spark_type) for f in self.fields])

    @property
    def unpacked_type(self) -> str:
        """One level unpacked, the values left as VARIANT."""
        return "struct<" + ",".join(f"{f.name}:variant" for f in self.fields) + ">"


@dataclass(frozen=True)
class Arr:
    element: Scalar | Obj
    null_elements: bool = False

    @property
    def spark_type(self) -> T.ArrayType:
        return T.ArrayType(self.element.spark_type)


def obj(*fields: Field) -> Obj:
    return Obj(fields)


# ---------------------------------------------------------------- exact check on a VARIANT


def _inner(variable: str) -> str:
    return f"{variable}_"


def _is_wrong(value: str, type_: Scalar | Obj | Arr, presence: str, var: str) -> str:
    """SQL condition, never NULL: a VARIANT value breaks the specification."""
    if isinstance(type_, Scalar):
        wrong = f"not coalesce({type_.accepts(f'schema_of_variant({value})')}, false)"
    elif isinstance(type_, Obj):
        # exists() over a one-element array evaluates the unpacking once for all fields.
        unpacked = f"try_cast({value} as {type_.unpacked_type})"
        wrong = f"exists(array({unpacked}), {var} -> {_object_is_wrong(var, type_)})"
    else:
        element = type_.element
        elements = f"try_cast({value} as array<variant>)"
        each = OPTIONAL if type_.null_elements else REQUIRED
        fails = _is_wrong(var, element, each, _inner(var))
        wrong = f"coalesce(exists({elements}, {var} -> {fails}), true)"
    if presence == REQUIRED:
        return f"({value} is null or {wrong})"
    if presence == DEFAULT:
        return f"({value} is not null and {wrong})"
    return f"({value} is not null and not is_variant_null({value}) and {wrong})"


def _object_is_wrong(unpacked: str, spec: Obj) -> str:
    fields = [
        _is_wrong(f"{unpacked}.`{f.name}`", f.type, f.presence, _inner(unpacked))
        for f in spec.fields
    ]
    return f"({unpacked} is null or {' or '.join(fields)})"


# ---------------------------------------------------------------- quick acceptance
#
# Most texts are accepted without the exact check, which unpacks every object. Where `from_json`
# reports no error, numbers, booleans and nesting have the right types. It leaves open:
#   a string field given something else   the typed text reads like a JSON number, boolean, list or
#                                         object, and one of the keys of string fields is followed
#                                         by something else than a string or a null
#   a null where none is allowed          the text holds the word null and the value is NULL
#   a required field that is missing      the value is NULL
#   "NaN" and the like for a number       the value is not finite
# Any of these signs, also one that is there by chance, hands the text to the exact check.

_LITERAL = r"^((-?[0-9]+([.][0-9]+)?([eE][+-]?[0-9]+)?|true|false)$|[\[{])"


def _is_doubtful(
    value: str, type_: Scalar | Obj | Arr, presence: str, var: str, keyed: bool = True
) -> str:
    """SQL condition on the typed value, never NULL; without `keyed`, the texts of string fields
    are taken for strings. Those of lists have no key and are always looked at."""
    signs = []
    if presence == REQUIRED:
        signs.append(f"{value} is null")
    elif presence == DEFAULT:
        signs.append(f"(_holds_null and {value} is null)")
    if type_ is STRING and keyed:
        signs.append(f"coalesce(regexp_like({value}, r'{_LITERAL}'), false)")
    elif type_ is DOUBLE:
        signs.append(f"not coalesce(abs({value}) < double('Infinity'), true)")
    elif isinstance(type_, Arr):
        each = OPTIONAL if type_.null_elements else REQUIRED
        listed = keyed or type_.element is STRING
        inner = _is_doubtful(var, type_.element, each, _inner(var), listed)
        if inner != "false":
            signs.append(f"coalesce(exists({value}, {var} -> {inner}), false)")
    elif isinstance(type_, Obj):
        inner = _any_doubtful(value, type_, var, keyed)
        if inner != "false":
            signs.append(f"({value} is not null and {inner})")
    return f"({' or '.join(signs)})" if signs else "false"


def _any_doubtful(value: str, spec: Obj, var: str, keyed: bool) -> str:
    signs = [
        _is_doubtful(f"{value}.`{f.name}`", f.type, f.presence, var, keyed) for f in spec.fields
    ]
    signs = [s for s in signs if s != "false"]
    return f"({' or '.join(signs)})" if signs else "false"


def _string_keys(type_: Scalar | Obj | Arr) -> set[str]:
    if isinstance(type_, Arr):
        return _string_keys(type_.element)
    if not isinstance(type_, Obj):
        return set()
    inner = set().union(*[_string_keys(f.type) for f in type_.fields])
    return inner | {f.name for f in type_.fields if f.type is STRING}


def _holds_strings_only(text: str, spec: Obj) -> str:
    """SQL condition: what follows a key of a string field, wherever it stands in the text, is a
    string or a null. Keys with escaped letters would not be seen, so none may be there.

    Values are looked at first, at every quotation mark that may close a key; few go on to the keys.
    """
    keys = "|".join(re.escape(k) for k in sorted(_string_keys(spec)))
    other = rf'"(?=[ \t\r\n]*:[ \t\r\n]*[^"n \t\r\n])(?<="(?:{keys})")'
    return rf"(not contains({text}, r'\u') and not regexp_like({text}, r'{other}'))"


def _is_plain(text: str, spec: Obj) -> str:
    """SQL condition, never NULL: the text needs no exact check."""
    sure = f"not {_any_doubtful('_typed', spec, 'e', True)}"
    if _string_keys(spec):
        without = f"not {_any_doubtful('_typed', spec, 'e', False)}"
        sure = f"({sure} or ({without} and {_holds_strings_only(text, spec)}))"
    return f"_typed._corrupt is null and {sure}"


# ---------------------------------------------------------------- typed value


def _filled(value: str, type_: Scalar | Obj | Arr, presence: str, var: str) -> str:
    """SQL of the typed value with defaults in place of missing fields."""
    if isinstance(type_, Scalar):
        return f"coalesce({value}, {type_.zero})" if presence == DEFAULT else value
    if isinstance(type_, Obj):
        parts = [
            f"'{f.name}', {_filled(f'{value}.`{f.name}`', f.type, f.presence, var)}"
            for f in type_.fields
        ]
        filled = f"named_struct({', '.join(parts)})"
        return filled if presence == REQUIRED else f"if({value} is null, null, {filled})"
    source = value
    if _has_defaults(type_.element):
        each = OPTIONAL if type_.null_elements else REQUIRED
        value = f"transform({value}, {var} -> {_filled(var, type_.element, each, _inner(var))})"
    if presence == DEFAULT:
        empty = f"cast(array() as {type_.spark_type.simpleString()})"
        return f"if({source} is null, {empty}, {value})"
    return value


def _has_defaults(type_: Scalar | Obj | Arr) -> bool:
    if isinstance(type_, Obj):
        return any(f.presence == DEFAULT or _has_defaults(f.type) for f in type_.fields)
    return isinstance(type_, Arr) and _has_defaults(type_.element)


# ---------------------------------------------------------------- decoding

_DOCUMENT = "variant_get(_parsed, '$[0]', 'variant')"


def with_decoded(
    df: DataFrame, text: str, spec: Obj, out: str, *, quick: bool = True
) -> DataFrame:
    """Add column `out`: the decoded record, NULL where the text does not meet `spec`.

    The record is the single output of a generator. As a plain column, a later filter on it would
    be pushed below the projections and would parse the text again for every use of the parse.
    It is computed in a projection below the generator, for which Spark generates code.

    The parser stops at the end of the first document. So the text is put into an array before a
    mark made from it: a text that closes the array, adds elements or trails after the document
    is not followed by the mark as the second and last element. A text that holds its own mark is
    refused; only escaped letters could then stand for it, so only with these a third element is
    looked for. Repeated keys make the parse fail.
    """
    mark = f"hex(xxhash64({text}))"
    typed_schema = T.StructType([*spec.spark_type, T.StructField("_corrupt", T.StringType())])
    typed = F.from_json(text, typed_schema, {"columnNameOfCorruptRecord": "_corrupt"})
    one_object = (
        f"coalesce(try_variant_get(_parsed, '$[1]', 'string') = {mark}"
        f" and not contains({text}, {mark})"
        rf" and (not contains({text}, r'\u')"
        f" or variant_get(_parsed, '$[2]', 'variant') is null)"
        rf" and (startswith({text}, '{{') or regexp_like({text}, r'^\s*\{{')), false)"
    )
    fits = f"not {_is_wrong(_DOCUMENT, spec, REQUIRED, 'o')}"
    if quick:
        fits = f"if({_is_plain(text, spec)}, true, {fits})"
    parsed = df.withColumns(
        {
            "_parsed": F.expr(f"try_parse_json(concat('[', {text}, ',\"', {mark}, '\"]'))"),
            "_typed": typed,
            "_holds_null": F.contains(F.col(text), F.lit("null")),
        }
    )
    value = _filled("_typed", spec, REQUIRED, "e")
    record = F.expr(f"if({one_object} and {fits}, {value}, null)").alias("_record")
    decoded = parsed.select(*df.columns, record)
    return decoded.select(*df.columns, F.explode_outer(F.array("_record")).alias(out))


# ---------------------------------------------------------------- repeated keys

#: Lets VARIANT keep the last of repeated keys; holds for whole plans.
REPEATS_SETTING = {"spark.sql.variant.allowDuplicateKeys": "true"}


def repeats_known_key(text: str, spec: Obj, var: str = "k") -> str:
    """SQL condition, never NULL: an object of the text that `spec` describes has one of its keys
    more than once.

    The keys are listed along the specification; what lies under other keys is not looked into.
    exists() over a one-element array evaluates a parse once for all that is asked of it.
    """
    names = ", ".join(f"'{f.name}'" for f in spec.fields)
    known = f"filter({var}, {var}_k -> {var}_k in ({names}))"
    repeated = (
        f"size({var}) > size(array_distinct({var}))"
        f" and size({known}) > size(array_intersect({var}, array({names})))"
    )
    found = [f"coalesce(exists(array(json_object_keys({text})), {var} -> {repeated}), false)"]
    types, deeper = [], []
    for f in spec.fields:
        value = f"{var}.`{f.name}`"
        if isinstance(f.type, Obj):
            types.append(f"`{f.name}` string")
            deeper.append(repeats_known_key(value, f.type, _inner(var)))
        elif isinstance(f.type, Arr) and isinstance(f.type.element, Obj):
            types.append(f"`{f.name}` array<string>")
            element = _inner(var)
            each = repeats_known_key(element, f.type.element, _inner(element))
            deeper.append(f"coalesce(exists({value}, {element} -> {each}), false)")
    if deeper:
        parts = f"from_json({text}, '{', '.join(types)}')"
        found.append(f"coalesce(exists(array({parts}), {var} -> {' or '.join(deeper)}), false)")
    return f"({' or '.join(found)})"


def with_unknown_repeats(df: DataFrame, text: str, spec: Obj, out: str) -> DataFrame:
    """Like `with_decoded`, for a session under REPEATS_SETTING: repeated keys that `spec` does not
    have are let through, repeated ones that it has are refused."""
    decoded = with_decoded(df, text, spec, out)
    repeats = F.expr(repeats_known_key(f"`{text}`", spec))
    return decoded.withColumn(out, F.when(F.col(out).isNotNull() & ~repeats, F.col(out)))
