"""Text functions with Unicode-aware classes, independent of the JVM's regex defaults."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]"
DIGIT = r"\p{Nd}"
SPACE = r"[\t-\r\x1c-\x20\x85\p{Z}]"
_BOUNDARY = rf"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"

WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "    　"
)


def spark_regex(pattern: str, ignore_case: bool = False) -> str:
    r"""Render a pattern so that ``\b \d \s \w`` and their opposites are Unicode-aware in Spark.

    Inside ``[...]`` the classes stand for their members; a boundary or an opposite class there is
    refused.

    A boundary in front of a literal or a digit that must be there is checked after that character
    has been seen. The scan then fails on one comparison almost everywhere and looks behind only on
    a hit, which takes half the time, or less, of a leading boundary.
    """
    head = re.match(r"\\b([A-Za-z0-9])(?![?*+{|])", pattern)
    digit = re.match(r"\\b\\d(?![?*|])(?!\{(?:0|,))", pattern)
    whole = not _has_top_level_choice(pattern)
    if head and whole:
        literal = head.group(1)
        start, rest = f"{literal}(?<!{WORD}{literal})", pattern[head.end():]
    elif digit and whole:
        start, rest = f"(?={DIGIT})(?<!{WORD})", pattern[2:]
    else:
        start, rest = "", pattern
    return ("(?iu)" if ignore_case else "") + start + _with_classes(rest)


_OUTSIDE = {
    r"\b": _BOUNDARY, r"\B": f"(?!{_BOUNDARY})", r"\d": DIGIT, r"\s": SPACE, r"\w": WORD,
    r"\D": r"\P{Nd}", r"\S": "[^" + SPACE[1:], r"\W": "[^" + WORD[1:],
}
_INSIDE = {r"\d": DIGIT, r"\s": SPACE[1:-1], r"\w": WORD[1:-1]}
_TOKEN = re.compile(r"\\.|\[\^?\]?|\]|[^\\\[\]]+", re.S)


def _with_classes(pattern: str) -> str:
    out, inside = [], False
    for token in _TOKEN.findall(pattern):
        if token.startswith("["):
            if inside:  # a plain character there, but special in Java
                token = token.replace("[", r"\[")
            else:
                inside, token = True, token.replace("]", r"\]")
        elif token == "]":
            inside = False
        elif token in _OUTSIDE:
            if inside and token not in _INSIDE:
                raise ValueError(f"{token} inside [...] has no counterpart: {pattern}")
            token = _INSIDE[token] if inside else _OUTSIDE[token]
        elif inside:  # intersections are Java's alone
            token = token.replace("&&", r"&\&")
        out.append(token)
    return "".join(out)


def _has_top_level_choice(pattern: str) -> bool:
    depth, inside = 0, False
    for token in re.findall(r"\\.|.", pattern, re.S):
        if token == "[":
            inside = True
        elif token == "]":
            inside = False
        elif not inside and token in "()":
            depth += 1 if token == "(" else -1
        elif not inside and token == "|" and depth == 0:
            return True
    return False


def quote_replacement(token: str) -> str:
    """Escape a literal replacement, in which ``\\`` and ``$`` are special."""
    return token.replace("\\", "\\\\").replace("$", "\\$")


def without_nulls(items: Column, element_type: str) -> Column:
    """The distinct non-null members, in order. Unlike a filter with a lambda, it leaves the
    projection it stands in within whole-stage code generation."""
    return F.array_except(items, F.array(F.lit(None).cast(element_type)))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def null_if_empty(c: Column) -> Column:
    return F.when(c != "", c)


def folded(c: Column) -> Column:
    """Upper-case text for :func:`may_match`, in which every letter that matches an ASCII letter
    when case is ignored is that letter: upper case leaves the Kelvin sign and the dotted I. A text
    of as many bytes as characters is ASCII and holds neither."""
    upper = F.upper(c)
    plain = F.replace(F.replace(upper, F.lit("\u212a"), F.lit("K")), F.lit("\u0130"), F.lit("I"))
    return F.when(F.octet_length(c) == F.length(c), upper).otherwise(plain)


def may_match(text: Column, folded_text: Column | None, literal: str | None, ignore_case: bool) -> Column:
    """Whether a pattern that needs ``literal`` can match; never false for a real match.

    A byte search is far cheaper than a regular expression, and most patterns hit few rows. Where no
    folded text is at hand, the text is folded only if it does not hold the literal as it is.
    """
    if literal is None:
        return F.lit(True)
    if not ignore_case:
        return text.contains(literal)
    if folded_text is not None:
        return folded_text.contains(literal.upper())
    return text.contains(literal) | folded(text).contains(literal.upper())
