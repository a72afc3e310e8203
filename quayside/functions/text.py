"""Text: blanks, normalisation, everything-to-text and loose typing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What counts as a number when text is typed loosely. A cast alone would also
# take Java spellings such as "5f" or "0x1p3".
_INT = r"^\s*[+-]?\d+(_\d+)*\s*$"
_FLOAT = (
    r"(?i)^\s*[+-]?((\d+(_\d+)*)(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)(e[+-]?\d+(_\d+)*)?\s*$"
    r"|^\s*[+-]?(inf|infinity|nan)\s*$"
)


def is_blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def normalized(c: Column) -> Column:
    return F.upper(F.trim(c))


def as_text(c: Column, data_type: T.DataType) -> Column:
    """Raw storage keeps all measures as text; booleans read ``True`` / ``False``."""
    text = c.cast("string")
    return F.initcap(text) if isinstance(data_type, T.BooleanType) else text


def _number(c: Column) -> Column:
    return F.trim(F.replace(c, F.lit("_"), F.lit("")))


def _flag(c: Column) -> Column:
    lowered = F.lower(F.trim(c))
    return F.when(lowered == "true", True).when(lowered == "false", False)


def typed(c: Column, data_type: T.DataType) -> Column:
    """Text to the catalogue's type; NULL when it does not fit."""
    if isinstance(data_type, T.StringType):
        return c
    if isinstance(data_type, T.BooleanType):
        return _flag(c)
    return F.when(c.rlike(_FLOAT), _number(c).try_cast(data_type))


def loose_type(c: Column) -> Column:
    """Name of the first type that accepts the text: bool, int, float, text."""
    return (
        F.when(_flag(c).isNotNull(), "bool")
        .when(c.rlike(_INT) & _number(c).try_cast("decimal(38,0)").isNotNull(), "int")
        .when(c.rlike(_FLOAT), "float")
        .when(c.isNotNull(), "text")
    )


def loose_json(c: Column) -> Column:
    """The text as a JSON literal of its loose type."""
    kind = loose_type(c)
    wrapped = F.to_json(F.array(c))
    return (
        F.when(kind == "bool", F.lower(F.trim(c)))
        .when(kind == "int", _number(c).try_cast("decimal(38,0)").cast("string"))
        .when(kind == "float", _number(c).try_cast("double").cast("string"))
        .when(kind == "text", wrapped.substr(F.lit(2), F.length(wrapped) - 2))
    )
