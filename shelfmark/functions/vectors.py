"""Vector columns: norm, distance, JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def l2_norm(vector: Column) -> Column:
    total = F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    return F.sqrt(total)


def l2_normalize(vector: Column) -> Column:
    """Vector over its length as ``array<double>``; a zero vector stays zero."""
    # The one-element array evaluates the norm once per row, not per component.
    divisor = F.transform(F.array(l2_norm(vector)), lambda norm: F.when(norm > 0, norm).otherwise(1.0))
    scaled = F.transform(divisor, lambda norm: F.transform(vector, lambda x: x.cast("double") / norm))
    return F.get(scaled, F.lit(0))


def squared_l2(left: Column, right: Column) -> Column:
    """Sum of squared differences, in double precision."""
    squares = F.zip_with(
        left, right,
        lambda a, b: (a.cast("double") - b.cast("double")) * (a.cast("double") - b.cast("double")),
    )
    return F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x)


def vector_json(vector: Column) -> Column:
    """Vector as JSON text; single precision keeps its short decimal forms."""
    return F.to_json(vector)


def with_vector(df: DataFrame, name: str, dimension: int | None = None,
                out: str = "vector", status: str = "vector_status") -> DataFrame:
    """Read column ``name`` as ``array<float>`` and say how that went.

    ``status`` is ``ok``; ``skipped`` for NULL and for types that hold no
    vector; ``failed`` for JSON text that is no list of numbers and for a wrong
    number of components.
    """
    dtype = df.schema[name].dataType
    source = F.col(name)
    if isinstance(dtype, T.StringType):
        # from_json stops after the closing bracket; text behind it is an error.
        parsed = F.when(
            source.rlike(r"^\s*\[[^\[\]]*\]\s*$"), F.from_json(source, "array<double>").cast("array<float>")
        )
    elif isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.NumericType):
        parsed = source.cast("array<float>")
    else:
        return df.withColumn(out, F.lit(None).cast("array<float>")).withColumn(status, F.lit("skipped"))
    df = df.withColumn(out, parsed)
    usable = F.col(out).isNotNull() & ~F.exists(F.col(out), lambda x: x.isNull())
    if dimension is not None:
        usable = usable & (F.size(out) == dimension)
    return df.withColumn(
        status, F.when(source.isNull(), "skipped").when(usable, "ok").otherwise("failed")
    ).withColumn(out, F.when(F.col(status) == "ok", F.col(out)))
