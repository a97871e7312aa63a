"""Phrases in text: whole words, read outside of negations, all rules in one pass.

A phrase that begins or ends in a letter of a spaced script needs a word bound there (``vip``
is not in "VIPER"); Chinese, kana and Hangul have no such bounds.  All phrases together are one
regular expression shaped like their prefix tree, so its cost per sign follows the depth of the
tree and the plan does not grow with the number of rules.
"""

from __future__ import annotations

from collections.abc import Iterable

import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from portolan.functions.text import SIGNS

#: One sign of a word; written so that all engines read it alike.
WORD = rf"(?:[^\P{{L}}{SIGNS}]|[\p{{N}}\p{{M}}])"

# What a note says without its denials, as (pattern, replacement), applied in this order to the lower-cased text:
# a contrast ends the reach of a denial; a denial reaches three words, within its clause; a
# Japanese denial reaches back over the run of kanji and katakana before it.
HEARD = [
    (r"[ \t](?:but|however|although|though|except)[ \t]", ", "),
    (r"(?:^|[^\p{L}\p{N}\p{M}])(?:not|no|never|neither|nor|without|cannot|[a-z]+n't)(?:[ \t]+[^\s.,;:!?()。、]+){1,3}", " "),
    (r"[々-〇ァ-ヿ㐀-䶿一-鿿]+(?:の|は|では|が)?(?:なし|ない|ありません)", " "),
]

_WORD = regex.compile(WORD)


def heard(text: Column) -> Column:
    """The lower-cased text without what it denies."""
    said = F.lower(text)
    for pattern, instead in HEARD[:-1]:
        said = F.regexp_replace(said, pattern, instead)
    # the ends of Japanese denials are looked for first, since runs of kanji are costly to try
    ends = text.contains("なし") | text.contains("ない") | text.contains("ありません")
    return F.when(ends, F.regexp_replace(said, *HEARD[-1])).otherwise(said)


def bounds(phrase: str) -> tuple[bool, bool]:
    """Whether a word bound is needed before and after the phrase."""
    return bool(_WORD.fullmatch(phrase[0])), bool(_WORD.fullmatch(phrase[-1]))


def _branch(node: dict) -> str:
    """The prefix tree below a node; longer phrases are tried first."""
    ways = [regex.escape(sign, special_only=True) + _branch(below) for sign, below in node.items() if sign]
    if "" in node:
        ways.append(node[""])
    return ways[0] if len(ways) == 1 else f"(?:{'|'.join(ways)})"


def pattern(phrases: Iterable[str]) -> str:
    """A pattern of no width whose first group is the longest phrase that starts at a place."""
    trees: dict[bool, dict] = {}
    for phrase in phrases:
        before, after = bounds(phrase)
        node = trees.setdefault(before, {})
        for sign in phrase:
            node = node.setdefault(sign, {})
        node[""] = f"(?!{WORD})" if after else ""
    ways = [(f"(?<!{WORD})" if before else "") + _branch(tree) for before, tree in trees.items()]
    first = "".join(sorted({"\\" + c if c in r"\[]^-&~" else c for tree in trees.values() for c in tree}))
    return f"(?=[{first}])(?=({'|'.join(ways)}))"


def begun(phrases: Iterable[str]) -> dict[str, list[str]]:
    """For each phrase the phrases it begins with, itself included."""
    known = set(phrases)
    return {
        p: [p[:n] for n in range(1, len(p) + 1) if p[:n] in known
            and (n == len(p) or not bounds(p[:n])[1] or not _WORD.match(p[n]))]
        for p in known
    }


def table(entries: dict[str, Column]) -> Column:
    """A constant map; the optimizer folds it into one literal."""
    return F.create_map(*[c for key, value in entries.items() for c in (F.lit(key), value)])


def phrases_in(text: Column, phrases: Iterable[str]) -> Column:
    """The distinct phrases (lower case, not empty) that a text says and does not deny; NULL for a NULL text."""
    phrases = list(dict.fromkeys(phrases))
    if not phrases:
        return F.when(text.isNotNull(), F.array().cast("array<string>"))
    found = F.regexp_extract_all(heard(text), F.lit(pattern(phrases)), F.lit(1))
    longer = {p: F.array(*map(F.lit, own)) for p, own in begun(phrases).items() if len(own) > 1}
    if longer:
        also = table(longer)
        found = F.flatten(F.transform(found, lambda p: F.coalesce(also[p], F.array(p))))
    return F.array_distinct(found)
