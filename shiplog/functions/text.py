"""Text helpers for scopes, diffs and model replies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FENCE = "`" * 3


def scope_names(text: Column) -> Column:
    """'a, b,,c' -> ['a','b','c']: split on commas, trim, drop what is empty."""
    return F.filter(
        F.transform(F.split(text, ","), lambda s: F.trim(s)), lambda s: s != F.lit("")
    )


def file_block(path: Column, diff: Column) -> Column:
    return F.concat(F.lit("File: "), path, F.lit("\nDiff:\n"), diff, F.lit("\n\n"))


# UTF-8 length of a block around its path and diff: "File: " + "\nDiff:\n" + "\n\n".
BLOCK_OVERHEAD = 15


def byte_prefix(text: Column, n: Column) -> Column:
    """The longest prefix of `text` of at most `n` bytes that splits no character.

    A UTF-8 character has at most three continuation bytes (0x80-0xBF), so stepping back from the
    cut while the next byte is a continuation byte needs at most three steps.
    """
    raw = text.cast("binary")
    n = n.cast("int")

    def continues(at: Column) -> Column:
        byte = F.hex(F.substring(raw, at + 1, F.lit(1)))
        return byte.between("80", "BF")

    cut = (
        F.when(n <= 0, F.lit(0))
        .when(n >= F.octet_length(text), F.octet_length(text))
        .when(~continues(n), n)
        .when(~continues(n - 1), n - 1)
        .when(~continues(n - 2), n - 2)
        .otherwise(n - 3)
    )
    return F.substring(raw, F.lit(1), cut).cast("string")


def strip_fences(reply: Column) -> Column:
    """A model reply without surrounding blanks and code fences."""
    blanks = r"(?U)^\s+|\s+$"
    text = F.regexp_replace(reply, blanks, "")
    text = F.regexp_replace(text, f"^({FENCE}json)*({FENCE})*", "")
    text = F.regexp_replace(text, f"({FENCE})+$", "")
    return F.regexp_replace(text, blanks, "")


def has_content(line: Column) -> Column:
    """True unless the line is empty or white space only."""
    return line.rlike(r"(?U)\S")
