"""Summaries of change requests by a model that the caller supplies."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplog import schemas
from shiplog.functions.strict_json import with_decoded
from shiplog.functions.text import FENCE, strip_fences

ATTEMPTS = 3
#: Tasks that call the model at once.
PARALLEL_CALLS = 64

# The categories asked for.
CATEGORIES = ("Feature", "Bugfix", "Refactor", "Platform", "Chore")
TITLE_FORM = r"^[a-z]+\([^)]+\): .+[^.]$"

INSTRUCTIONS = f"""Read the change described below and answer with one JSON object and nothing else.
Keys:
  category  one of {", ".join(CATEGORIES)}
  title     type(scope): text - imperative, at most 100 characters, no full stop at the end
  summary   two or three sentences: what changed and why
"""


def prompt(title: Column, description: Column, diff_text: Column) -> Column:
    return F.concat(
        F.lit(INSTRUCTIONS + "\nTitle: "),
        title,
        F.lit("\nDescription: "),
        F.coalesce(description, F.lit("")),
        F.lit("\nChanges:\n"),
        diff_text,
    )


def parse_replies(replies: DataFrame, reply: str = "reply") -> DataFrame:
    """Add `answer` (category, title, summary), NULL if the reply is not valid.

    The category is not checked against the list.
    """
    cleaned = replies.withColumn("_reply", strip_fences(F.col(reply)))
    return with_decoded(cleaned, "_reply", schemas.MODEL_REPLY, "answer").drop("_reply")


def audit_replies(answers: DataFrame) -> DataFrame:
    """Whether valid answers keep to the list of categories and the form of the title."""
    return answers.filter(F.col("answer").isNotNull()).select(
        "*",
        F.col("answer.category").isin(*CATEGORIES).alias("known_category"),
        F.col("answer.title").rlike(TITLE_FORM).alias("formed_title"),
    )


def _no_constant(name: str) -> None:
    raise ValueError(name)


def _no_repeats(pairs: list[tuple]) -> dict:
    if len({k for k, _ in pairs}) < len(pairs):
        raise ValueError("repeated key")
    return dict(pairs)


def readable(reply: str) -> bool:
    """Whether a reply is worth keeping, decided in the task so that it can ask again.

    By the rules of the strict decoder: no repeated key, no number that is none.
    """
    text = reply.strip()
    while text.startswith(FENCE + "json"):
        text = text[len(FENCE) + 4 :]
    while text.startswith(FENCE):
        text = text[len(FENCE) :]
    while text.endswith(FENCE):
        text = text[: -len(FENCE)]
    try:
        answer = json.loads(text, object_pairs_hook=_no_repeats, parse_constant=_no_constant)
    except ValueError:
        return False
    keys = ("category", "title", "summary")
    return isinstance(answer, dict) and all(isinstance(answer.get(k), str) for k in keys)


def ask_model(
    prompts: DataFrame, complete: Callable[[str], str], parallel: int = PARALLEL_CALLS
) -> DataFrame:
    """(mr_id, prompt_hash, reply) for (mr_id, prompt_hash, prompt).

    Up to three attempts per prompt; an exception or an unreadable reply is tried again. `reply` is
    NULL when all attempts failed. The prompts are dealt over `parallel` tasks, a number that
    adaptive execution leaves alone: calls cost time, however short the texts are.
    """

    def attempt(text: str) -> str | None:
        for _ in range(ATTEMPTS):
            try:
                reply = complete(text)
            except Exception:
                continue
            if readable(reply):
                return reply
        return None

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(
                {
                    "mr_id": batch["mr_id"],
                    "prompt_hash": batch["prompt_hash"],
                    "reply": [attempt(p) for p in batch["prompt"]],
                }
            )

    dealt = prompts.select("mr_id", "prompt_hash", "prompt").repartition(parallel)
    return dealt.mapInPandas(
        ask, "mr_id string, prompt_hash string, reply string"
    )


def attach_answers(mrs: DataFrame, answers: DataFrame, on: list[str]) -> DataFrame:
    """Add the four model columns; NULL where there is no valid answer."""
    found = answers.filter(F.col("answer").isNotNull()).select(
        *on,
        F.col("answer.title").alias("mr_ai_title"),
        F.col("answer.summary").alias("mr_ai_summary"),
        F.col("model").alias("mr_ai_model"),
        F.col("answer.category").alias("mr_ai_category"),
    )
    return mrs.join(found, on, "left")
