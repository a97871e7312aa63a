"""Column helpers shared by sources and operators.  All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_TOKENS = ("NULL", "null", "")


def pick(values: list, index: Column) -> Column:
    """``values[index]`` for a zero-based index column; the list folds to one literal."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def pad_key(key: Column, width: int) -> Column:
    """Zero-pad a key, but never cut one that is already longer than ``width``."""
    text = key.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def null_if_token(col: Column, tokens: tuple[str, ...] = NULL_TOKENS) -> Column:
    """NULL where the text is one of the file format's NULL tokens."""
    return F.when(~col.isin(*tokens), col)


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den``; NULL, not an error and not 0, when the denominator is zero."""
    return num / F.nullif(den, F.lit(0))


def won_ratio(won: Column, lost: Column) -> Column:
    """Share of closed deals that were won; NULL while no deal is closed."""
    return safe_ratio(won, won + lost)


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """``100 * part / whole`` in decimals, rounded half up; NULL when ``whole`` is zero."""
    exact = "decimal(20,0)"
    return F.round(
        part.cast(exact) * 100 / F.nullif(whole.cast(exact), F.lit(0).cast(exact)), digits
    )


def money_text(amount: Column, width: int = 15) -> Column:
    """Whole-number money with thousands separators, right-aligned to ``width``.

    Equals ``to_char(round(x, 0), '999,999,999,999')`` while the amount fits; larger
    amounts keep all their digits instead of turning into ``###``.
    """
    text = F.format_number(F.round(amount, 0), 0)
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit(" "))


def percent_text(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.concat(percent(part, whole, digits).cast(f"decimal(20,{digits})").cast("string"), F.lit("%"))


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def base_name(path: Column) -> Column:
    """File name of a path as Spark reports it, which is URL-encoded."""
    name = F.split_part(path, F.lit("/"), F.lit(-1))
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def try_typed(text: Column, type_name: str) -> Column:
    """Cast text to a column type, NULL where it does not fit.

    Whole numbers go through ``decimal(38,0)`` so that ``1.7`` rounds to 2.
    """
    if type_name in ("bigint", "int"):
        return text.try_cast("decimal(38,0)").try_cast(type_name)
    return text.try_cast(type_name)
