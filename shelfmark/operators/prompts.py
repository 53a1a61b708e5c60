"""Prompt texts: one block per product, one message per batch."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark import fixed


def product_block(product_id: Column, context: Column, candidates: Column) -> Column:
    """Text of one product: heading, non-empty context values, candidates."""
    filled = F.filter(context, lambda e: e["value"] != "")
    values = F.transform(filled, lambda e: F.concat(e["key"], F.lit(": "), e["value"], F.lit("\n")))
    options = F.transform(
        candidates,
        lambda c: F.concat(
            F.lit("["), c["letter"], F.lit("] "), c["hierarchy_string"],
            F.when(
                F.size(c["attributes"]) > 0,
                F.concat(F.lit(" | "), F.array_join(F.transform(c["attributes"], _title), ", ")),
            ).otherwise(""),
            F.lit("\n"),
        ),
    )
    return F.concat(
        F.lit("\n--- Product "), product_id, F.lit(" ---\n"),
        F.array_join(values, ""), F.lit("\nCandidate categories:\n"), F.array_join(options, ""), F.lit("\n"),
    )


def _title(attribute: Column) -> Column:
    return F.coalesce(attribute["title"], F.lit("None"))


def plain_product_block(product_id: Column, context: Column, candidates: Column) -> Column:
    """Text of one product for the plain prompt, with the context as JSON."""
    options = F.transform(
        candidates,
        lambda c: F.concat(F.lit("["), c["letter"], F.lit("] "), c["hierarchy_string"], F.lit("\n")),
    )
    return F.concat(
        F.lit("--- Product "), product_id, F.lit(" ---\n"), context_json(context),
        F.lit("\n\nCandidates:\n"), F.array_join(options, ""), F.lit("\n"),
    )


def context_json(context: Column) -> Column:
    """Context as JSON with sorted keys, ASCII only and safe inside HTML."""

    @F.arrow_udf("string")
    def dump(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for entries in batches:
            texts = [json.dumps({e["key"]: e["value"] for e in row}, sort_keys=True) for row in entries.to_pylist()]
            for mark in "<>&'":
                texts = [t.replace(mark, f"\\u{ord(mark):04x}") for t in texts]
            yield pa.array(texts, pa.string())

    return dump(context)


@dataclass(frozen=True)
class PromptTexts:
    """Texts of a prompt: ``{n}`` in ``head`` becomes the number of products, ``block`` makes the text of one."""

    system: str
    head: str
    tail: str
    block: Callable[[Column, Column, Column], Column] = product_block


STANDARD = PromptTexts(fixed.SYSTEM_PROMPT, fixed.USER_PROMPT_HEAD, fixed.USER_PROMPT_TAIL)
PLAIN = PromptTexts(fixed.PLAIN_SYSTEM_PROMPT, fixed.PLAIN_PROMPT_HEAD, fixed.PLAIN_PROMPT_TAIL, plain_product_block)


def batch_prompts(products: DataFrame, key: str, batch: str = "batch", block: str = "block",
                  plain: bool = False, texts: PromptTexts | None = None) -> DataFrame:
    """One row per batch: ``batch``, ``products``, ``system_message``, ``user_message``.

    ``products`` has one row per product; a NULL ``block`` holds a place in its
    batch but gives no text. Batches without any text are left out. A group is
    one batch, so it never exceeds the batch size.
    """
    blocks = F.array_sort(F.collect_list(F.when(F.col(block).isNotNull(), F.struct(key, block))))
    grouped = products.groupBy(batch).agg(blocks.alias("__blocks")).where(F.size("__blocks") > 0)
    return block_prompts(grouped, F.transform("__blocks", lambda b: b[block]), batch, texts or (PLAIN if plain else STANDARD))


def block_prompts(batches: DataFrame, blocks: Column, batch: str = "batch", texts: PromptTexts = STANDARD) -> DataFrame:
    """Prompts of batches that hold the texts of their products as an array, without a shuffle."""
    count = F.size("__texts")
    message = F.concat(F.replace(F.lit(texts.head), F.lit("{n}"), count.cast("string")), F.array_join("__texts", ""),
                       F.lit(texts.tail))
    return batches.select(batch, blocks.alias("__texts")).select(
        batch, count.alias("products"), F.lit(texts.system).alias("system_message"), message.alias("user_message")
    )
