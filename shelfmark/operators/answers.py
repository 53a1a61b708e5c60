"""Model answers: parsing, matching with candidates, results."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark import fixed
from shelfmark.functions import text as tx
from shelfmark.operators.candidates import level_columns

_ANSWER = pa.struct([("id_key", pa.string()), ("id_text", pa.string()), ("choice", pa.string())])
_PARSED = pa.struct([("answers", pa.list_(_ANSWER)), ("error", pa.string())])


def parse_responses(responses: DataFrame, content: str = "content", error: str = "error") -> DataFrame:
    """Add ``answers`` (in order) and complete ``error`` of each response.

    The content is JSON: a list, or an object whose first list counts; failing
    that, the stretch from the first ``[`` to the last ``]``. One answer that
    is no object, or whose choice is no text, fails the whole response. JSON is
    read in Python, because Spark's JSON functions accept trailing text and
    reject repeated keys.
    """

    @F.arrow_udf("struct<answers:array<struct<id_key:string,id_text:string,choice:string>>,error:string>")
    def parse(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([_read_answers(text) for text in texts.to_pylist()], _PARSED)

    had_error = F.col(error) if error in responses.columns else F.lit(None).cast("string")
    # Marked so that each response is parsed once, whatever is read of the result.
    once = parse.asNondeterministic()
    parsed = responses.withColumn("__parsed", once(F.col(content)))
    return (
        parsed.withColumn("answers", F.when(had_error.isNull(), F.col("__parsed.answers")))
        .withColumn(error, F.coalesce(had_error, F.col("__parsed.error")))
        .drop("__parsed")
    )


def _read_answers(text: str | None) -> dict:
    """Answers of one response, or the error that fails it."""
    try:
        return _checked_answers(_answer_list(text))
    except (TypeError, ValueError, OverflowError, RecursionError) as problem:
        return {"answers": None, "error": tx.storable(str(problem)) or type(problem).__name__}


def _checked_answers(items: list | None) -> dict:
    if items is None:
        return {"answers": None, "error": fixed.UNPARSEABLE}
    answers = []
    for item in items:
        problem = _answer_problem(item)
        if problem:
            return {"answers": None, "error": problem}
        key, shown = _typed_key(item.get("product_id"))
        choice = tx.storable(item.get("choice", "").strip().upper())
        answers.append({"id_key": tx.storable(key), "id_text": tx.storable(shown), "choice": choice})
    return {"answers": answers, "error": None}


def _answer_problem(item) -> str | None:
    if not isinstance(item, dict):
        return "an answer is not an object"
    if not isinstance(item.get("choice", ""), str):
        return "the choice of an answer is not text"
    if isinstance(item.get("product_id"), (list, dict)):
        return "the product_id of an answer is not a scalar"
    return None


def _answer_list(text: str | None) -> list | None:
    try:
        value = json.loads(text)
    except (ValueError, TypeError):  # a number of too many digits is a plain ValueError
        value = None
    if isinstance(value, dict):
        value = next((v for v in value.values() if isinstance(v, list)), None)
    if isinstance(value, list):
        return value
    stretch = re.search(r"\[.*\]", text, re.DOTALL)
    try:
        return json.loads(stretch.group()) if stretch else None
    except ValueError:
        return None


def _typed_key(product) -> tuple[str | None, str | None]:
    """Key and text of an answer's id; equal numbers share a key, text stays text."""
    if product is None:
        return None, None
    if isinstance(product, str):
        return f"s:{product}", product
    number = int(product) if product == product and abs(product) != float("inf") and product == int(product) else product
    return f"n:{number}", str(number)


def answer_rows(parsed: DataFrame, batch: str = "batch") -> DataFrame:
    """One row per answer: ``batch``, ``ordinal``, ``id_key``, ``id_text``, ``choice``."""
    exploded = parsed.where(F.col("error").isNull()).select(batch, F.posexplode("answers").alias("ordinal", "answer"))
    return exploded.select(batch, "ordinal", "answer.*")


def match_answers(answers: DataFrame, products: DataFrame, key: str, batch: str = "batch",
                  coerce_ids: bool = False) -> DataFrame:
    """Answers with ``key`` and the ``candidate`` they choose; NULL where nothing fits.

    An answer counts for a product of its own batch whose id is equal in type
    and value (``coerce_ids``: equal as text) and for the candidate with its
    letter. One row per product enters the join; the letter is found in the
    product's candidate array.
    """
    options = products.select(
        F.col(batch).alias("__batch"), F.col(key), tx.answer_key(products, key, coerce_ids).alias("__key"), "candidates"
    )
    wanted = F.col("id_text" if coerce_ids else "id_key")
    joined = answers.join(options, (F.col(batch) == F.col("__batch")) & (wanted == F.col("__key")), "left")
    chosen = F.get(F.filter("candidates", lambda c: F.upper(c["letter"]) == F.col("choice")), F.lit(0))
    return joined.select(batch, "ordinal", key, "id_text", "choice", chosen.alias("candidate"))


def matched_results(matches: DataFrame, key: str, batch: str = "batch",
                    targets: Sequence[str] = fixed.TARGET_COLUMNS) -> DataFrame:
    """Answers that chose a candidate, with the target columns."""
    return matches.where(F.col("candidate").isNotNull()).select(
        batch, "ordinal", key, *level_columns(F.col("candidate"), list(targets))
    )


def unmatched_answers(matches: DataFrame, batch: str = "batch") -> DataFrame:
    """Answers that chose nothing known; they change no row."""
    return matches.where(F.col("candidate").isNull()).select(batch, "ordinal", "id_text", "choice")
