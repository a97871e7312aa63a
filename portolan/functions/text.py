"""Tokens."""

from __future__ import annotations

import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

# Signs of scripts that come without spaces (Chinese, kana, Hangul) are tokens one by one;
# elsewhere a token is a run of letters, digits and combining marks.  ``[^\P{L}..]`` is a
# letter outside the listed signs, written so that all engines read it alike.
SIGNS = "々-〇ぁ-ヿ㐀-䶿一-鿿가-힣"
TOKEN = rf"[{SIGNS}]|(?:[^\P{{L}}{SIGNS}]|[\p{{N}}\p{{M}}])+"

# All signs lie between the first and the last; a text with none in that span is cut between tokens.
_NEAR_SIGNS = f"[{SIGNS[0]}-{SIGNS[-1]}]"
_BETWEEN = r"[^a-z0-9\p{L}\p{N}\p{M}]+"


def tokens(text: Column) -> Column:
    """Tokens of the lower-cased text, in order.

    Cutting costs a third of matching every token; both give the same tokens.
    """
    lowered = F.lower(text)
    matched = F.regexp_extract_all(lowered, F.lit(TOKEN), F.lit(0))
    return F.when(lowered.rlike(_NEAR_SIGNS), matched).otherwise(F.array_remove(F.split(lowered, _BETWEEN, -1), ""))


def token_list(text: str) -> list[str]:
    """The same for a short query string on the driver, without repeats."""
    return list(dict.fromkeys(regex.findall(TOKEN, text.lower())))
