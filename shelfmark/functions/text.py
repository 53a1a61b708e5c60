"""Text columns: stripping, value coercion, row and node texts, labels."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark import fixed


def strip(text: Column) -> Column:
    """Remove white space of any kind, not only blanks, from both ends."""
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def float_text(value: Column) -> Column:
    """Shortest decimal text of a double: positional from 1e-4 up to 1e16.

    Spark's cast turns to scientific notation at 1e7 already, has no sign or
    padding in the exponent, and may print a digit more than is needed.
    Subnormal numbers keep the digits of Spark's cast.
    """
    return let(_shortest(value.cast("double")), _positional)


def _positional(raw: Column) -> Column:
    parts = F.struct(
        F.regexp_extract(raw, r"^(-?)", 1).alias("sign"),
        F.regexp_extract(raw, r"^-?(\d)\.\d+E", 1).alias("whole"),
        F.regexp_replace(F.regexp_extract(raw, r"^-?\d\.(\d+)E", 1), r"0+$", "").alias("rest"),
        F.regexp_extract(raw, r"E(-?\d+)$", 1).cast("int").alias("exponent"),
    )
    return F.when(~F.contains(raw, F.lit("E")), raw).otherwise(let(parts, _from_parts))


def _from_parts(parts: Column) -> Column:
    sign, exponent = parts["sign"], parts["exponent"]
    digits, point = F.concat(parts["whole"], parts["rest"]), exponent + 1
    large = F.concat(
        sign,
        F.rpad(F.substring(digits, F.lit(1), point), point, "0"),
        F.lit("."),
        F.when(F.length(digits) > point, F.substring(digits, point + 1, F.lit(32))).otherwise("0"),
    )
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -point), digits)
    power = F.abs(exponent).cast("string")
    scientific = F.concat(
        sign,
        parts["whole"],
        F.when(parts["rest"] != "", F.concat(F.lit("."), parts["rest"])).otherwise(""),
        F.lit("e"),
        F.when(exponent < 0, "-").otherwise("+"),
        F.lpad(power, F.greatest(F.length(power), F.lit(2)), "0"),
    )
    return F.when(exponent.between(0, 15), large).when(exponent.between(-4, -1), small).otherwise(scientific)


def _shortest(value: Column) -> Column:
    """Spark's text of a double, or a shorter one that reads back as the same."""

    def choose(raw: Column) -> Column:
        many = F.length(F.regexp_replace(F.regexp_replace(raw, "E.*", ""), r"\D", "")) > 15
        shorter = F.array(*[
            F.regexp_replace(F.format_string(pattern, value), r"e\+?(-?)0*(\d)", "E$1$2")
            for pattern in ("%.14e", "%.15e", "%.16e")
        ])
        same = F.get(F.filter(shorter, lambda s: s.cast("double") == value), F.lit(0))
        return F.when(many & ~F.isnan(value), F.coalesce(same, raw)).otherwise(raw)

    return let(value.cast("string"), choose)


def storable(text: str | None) -> str | None:
    """A Python text with what UTF-8 cannot hold (halves of surrogate pairs) replaced."""
    return None if text is None else text.encode("utf-8", "replace").decode("utf-8")


def filled_text(df: DataFrame, name: str) -> Column:
    """Column ``name`` as text where NULL, NaN, '', 0 and false become ''."""
    value = F.col(name)
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.StringType):
        return F.coalesce(value, F.lit(""))
    if isinstance(dtype, T.BooleanType):
        return F.when(value, "True").otherwise("")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(value.isNull() | F.isnan(value) | (value == 0), "").otherwise(float_text(value))
    if isinstance(dtype, T.NumericType):
        return F.when(value.isNull() | (value == 0), "").otherwise(value.cast("string"))
    return F.coalesce(value.cast("string"), F.lit(""))


def row_text(df: DataFrame, columns: Sequence[str], separator: str = fixed.ROW_TEXT_SEPARATOR) -> Column:
    """Columns in order, joined; empty values stay, so separators repeat."""
    return F.concat_ws(separator, *[filled_text(df, c) for c in columns])


def context_entries(df: DataFrame, columns: Sequence[str]) -> Column:
    """Ordered ``array<struct<key,value>>`` of the columns shown in a prompt."""
    return F.array(
        *[F.struct(F.lit(c).alias("key"), filled_text(df, c).alias("value")) for c in columns]
    )


def node_text(hierarchy: Column, definition: Column, excludes: Column) -> Column:
    """``path | definition | Excludes: ...`` without the empty parts."""
    return F.concat_ws(
        fixed.PART_JOINER,
        hierarchy,
        F.nullif(definition, F.lit("")),
        F.concat(F.lit(fixed.EXCLUDES_PREFIX), F.nullif(excludes, F.lit(""))),
    )


def level_name(level: Column) -> Column:
    """Name of a taxonomy level; NULL outside 1 to 6."""
    names = F.array(*[F.lit(n) for n in fixed.LEVEL_NAMES])
    return F.get(names, level - 1)


def option_letter(index: Column) -> Column:
    """Label of the zero-based option: A to Z, then Z26, Z27 and so on."""
    return F.when(index < 26, F.char(index + 65)).otherwise(F.concat(F.lit("Z"), index.cast("string")))


def short_label(label: Column) -> Column:
    """Display form of a category label."""
    for full, short in fixed.LABEL_SHORT_FORMS:
        label = F.replace(label, F.lit(full), F.lit(short))
    return label


def lookup_key(identifier: Column) -> Column:
    """Key under which ids that denote the same whole number meet.

    '007', '+7' and ' 7 ' give '7'; anything that is not a whole number keeps
    its text. Digits stay text, so their number is not limited.
    """
    trimmed = strip(identifier)
    digits = F.regexp_replace(F.regexp_replace(trimmed, r"[+_-]", ""), r"^0+(?=\d)", "")
    minus = F.when(F.startswith(trimmed, F.lit("-")) & (digits != "0"), "-").otherwise("")
    return F.when(is_whole_number(identifier), F.concat(minus, digits)).otherwise(identifier)


def is_whole_number(identifier: Column) -> Column:
    return F.rlike(strip(identifier), F.lit(r"^[+-]?[0-9]+(_[0-9]+)*$"))


def answer_key(df: DataFrame, name: str, coerce: bool = False) -> Column:
    """Column ``name`` as the typed key that model answers are compared with.

    Numbers of any type that are equal share a key, text never equals a number.
    ``coerce`` compares the plain texts instead.
    """
    value = F.col(name)
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        number = F.regexp_replace(
            F.when(value == F.floor(value), value.cast("decimal(38,0)").cast("string")).otherwise(float_text(value)),
            r"^-0$", "0",
        )
    elif isinstance(dtype, T.DecimalType):
        number = F.regexp_replace(F.regexp_replace(value.cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    elif isinstance(dtype, T.BooleanType):
        number = value.cast("int").cast("string")
    elif isinstance(dtype, T.NumericType):
        number = value.cast("string")
    else:
        text = value.cast("string")
        return text if coerce else F.concat(F.lit("s:"), text)
    return number if coerce else F.concat(F.lit("n:"), number)
