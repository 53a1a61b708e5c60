"""Chat completion through a pluggable provider."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import text as tx

# A provider maps (system, user) to {"content": str, "usage": {"prompt_tokens": ...}}.
Chat = Callable[[str, str], dict[str, Any]]

# Prompts that a worker holds as Python texts at once.
_AT_ONCE = 64

_USAGE = ["prompt_tokens", "completion_tokens", "total_tokens"]


def complete(prompts: DataFrame, make_provider: Callable[[], Chat], batch: str = "batch") -> DataFrame:
    """One call per prompt: ``batch``, ``content``, token counts, ``error``.

    The provider is built once per task. An exception becomes the ``error`` of
    its row, other rows go on. Calls cost money and may answer differently the
    next time: write the result before using it twice.
    """
    result = "struct<content:string,prompt_tokens:int,completion_tokens:int,total_tokens:int,error:string>"

    @F.arrow_udf(result)
    def call(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        provider = make_provider()
        for systems, users in batches:
            for first in range(0, max(1, len(systems)), _AT_ONCE):
                yield _answers(provider, systems.slice(first, _AT_ONCE), users.slice(first, _AT_ONCE))

    # Marked so that Catalyst never copies the call into a pushed-down filter.
    once = call.asNondeterministic()
    return prompts.select(batch, once("system_message", "user_message").alias("answer")).select(batch, "answer.*")


def _answers(provider: Chat, systems: pa.Array, users: pa.Array) -> pa.Array:
    """One call per prompt and its row."""
    rows = []
    for system, user in zip(systems.to_pylist(), users.to_pylist()):
        try:
            rows.append(_checked(provider(system, user)))
        except Exception as problem:
            rows.append({"error": tx.storable(str(problem)) or type(problem).__name__})
    ints = [(name, pa.int32()) for name in _USAGE]
    return pa.array(rows, pa.struct([("content", pa.string()), *ints, ("error", pa.string())]))


def _checked(answer: dict[str, Any]) -> dict[str, Any]:
    """Row of an answer. Content that is no text fails; counts that are no numbers are unknown."""
    content, usage = answer["content"], answer.get("usage")
    if not isinstance(content, str):
        raise TypeError("the content of an answer is not text")
    counts = {name: usage.get(name) if isinstance(usage, dict) else None for name in _USAGE}
    whole = {n: c if type(c) is int and abs(c) < 2**31 else None for n, c in counts.items()}
    return {"content": tx.storable(content), **whole, "error": None}


def first_option_provider(letter: str = "A") -> Callable[[], Chat]:
    """Offline provider: answers ``letter`` for every product of the prompt.

    Tokens are counted as one per four characters, rounded down.
    """

    def make() -> Chat:
        def call(system: str, user: str) -> dict[str, Any]:
            ids = re.findall(r"^--- Product (.*) ---$", user, re.MULTILINE)
            chosen = [
                {"product_id": int(i) if re.fullmatch(r"-?\d+", i) else i, "choice": letter} for i in ids
            ]
            content = json.dumps({"results": chosen})
            prompt, completion = (len(system) + len(user)) // 4, len(content) // 4
            usage = {"prompt_tokens": prompt, "completion_tokens": completion, "total_tokens": prompt + completion}
            return {"content": content, "usage": usage}

        return call

    return make


def token_usage(responses: DataFrame) -> DataFrame:
    """Calls and token sums over a response table, as one row."""
    sums = [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in _USAGE]
    return responses.agg(F.count("*").alias("calls"), *sums)
