"""Texts to typed values, and which texts a type cannot hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Digits that the widest decimal has room for.
MOST_DIGITS = 38

# Significant digits that survive a float or double in any case, and the least normal value.
SURE_DIGITS = {T.FloatType: (6, 1.17549435e-38), T.DoubleType: (15, 2.2250738585072014e-308)}

# How many digits an integer of the type has room for, whichever they are.
WHOLE_DIGITS = {T.ByteType: 2, T.ShortType: 4, T.IntegerType: 9, T.LongType: 18}


def typed_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema`` in its types; a text that does not fit becomes null."""
    unknown = sorted(set(schema.names) - set(df.columns))
    if unknown:
        raise ValueError(f"the file has no column {', '.join(unknown)}")
    return df.withColumns({field.name: typed(F.col(field.name), field.dataType) for field in schema})


def typed(text: Column, kind: T.DataType) -> Column:
    """The value of a text; null where there is none, and where it is no number that can be counted with."""
    value = text.try_cast(kind)
    if type(kind) not in SURE_DIGITS:
        return value
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def _significant(text: Column) -> Column:
    """Digits of a number as written, without sign, point, exponent and outer zeros."""
    digits = F.regexp_replace(F.regexp_replace(text, "[eE].*$", ""), "[^0-9]", "")
    return F.regexp_replace(digits, "^0+|0+$", "")


def _plain(text: Column, kind: T.DataType) -> Column:
    """Whether a text is a number of so few digits that ``kind`` keeps all of them, by one pattern."""
    if isinstance(kind, T.DecimalType):
        whole, places = kind.precision - kind.scale, kind.scale
    elif type(kind) in SURE_DIGITS:
        places = SURE_DIGITS[type(kind)][0] // 2
        whole = SURE_DIGITS[type(kind)][0] - places
    else:
        whole, places = WHOLE_DIGITS.get(type(kind), 0), 0
    if not whole:
        return F.lit(False)
    fraction = rf"(\.[0-9]{{1,{places}}})?" if places else ""
    return text.rlike(rf"\A-?[0-9]{{1,{whole}}}{fraction}\z")


def unfit(text: Column, kind: T.DataType) -> Column:
    """Whether a text says something that a cast to ``kind`` would lose, digits included.

    A null, or a text of white space only, says nothing. A float or double keeps up to 6 or 15
    digits; of longer texts it loses those that it would not be written with itself. Plain short numbers,
    which most texts are, are settled by one pattern before anything is cast, longer ones that are
    written as the type writes them by that text. Other types lose nothing of a text that they take.
    """
    value = typed(text, kind)
    lost = value.isNull()
    blank = ~F.coalesce(text.rlike(r"\S"), F.lit(False))
    if type(kind) not in SURE_DIGITS and not isinstance(kind, T.DecimalType):
        return F.when(~lost, False).otherwise(~blank)
    if type(kind) in SURE_DIGITS:
        sure, normal = SURE_DIGITS[type(kind)]
        written, kept = _significant(text), _significant(value.cast("string"))
        rounded = (F.length(written) > sure) | ((F.abs(value) < normal) & (written != ""))
        lost = lost | (rounded & (written != kept))
    if isinstance(kind, T.DecimalType):
        finer = T.DecimalType(MOST_DIGITS, kind.scale + MOST_DIGITS - kind.precision)
        more_digits = text.rlike(rf"\.[0-9]{{{kind.scale}}}[0-9]*[1-9]")
        power = text.rlike("[eE]") & (text.try_cast("double") != value.cast("double"))
        lost = lost | more_digits | power | (text.try_cast(finer) != value)
    settled = F.when(_plain(text, kind), False)
    if type(kind) in SURE_DIGITS:
        settled = settled.when(value.cast("string") == text, False)
    return settled.otherwise(~blank & F.coalesce(lost, F.lit(False)))
