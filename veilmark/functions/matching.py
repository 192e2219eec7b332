"""How a pattern is run: an expression with the same matches that costs time in
proportion to the text, and cheap facts about a text that rule patterns out.

Borders. ``\\b`` before something that is surely a word character only asks whether the
character before is one, too; after such a thing only the one behind counts. One
look-around then says what four say in general.

E-mail addresses. Whether an address stands at an ``@`` depends on what follows it alone,
so of the run of characters before it only the first border has to be tried: the search
starts where such a run (or the text behind the last match) starts and goes over what
stands before that border. No run is read twice, however many borders it has.

Facts. The patterns that are lists of words can only match where one of these words
stands between borders. One pass gathers the listed words a text has.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from veilmark import catalog

#: Patterns that may begin, or end, with something other than a word character.
_ODD_START = {"FULLNAME", "FIRSTNAME", "NAME", "EMAIL", "PHONE", "USERNAME", "GPS_COORDINATES"}
_ODD_END = {"EMAIL", "STREET_ADDRESS", "PASSWORD", "COUNTY", "DEVICE_INFO", "URL"}
_CLOSING = re.compile(r"\\b(?=$|\||\(\?[=!])")
_LOCAL = r"[A-Za-z0-9._%+-]"
_DIGIT = "0"
# Letters other than ASCII that a pattern takes for an ASCII letter when it ignores case.
_FOLD = ("ſKıİ", "skii")


def with_borders(pattern: catalog.Pattern) -> str:
    """The expression with each border written as shortly as it allows."""
    out = pattern.regex
    if pattern.name not in _ODD_END:
        out = _CLOSING.sub(lambda _: r"(?![\w])", out)
    if pattern.name not in _ODD_START:
        out = re.sub(r"\\b(?!$|\||\(\?[=!])", lambda _: r"(?<![\w])", out)
    return out


def expression(pattern: catalog.Pattern) -> tuple[str, bool]:
    """The expression for the JVM, and whether the match is its second group (the first
    one is what the search goes over) or all of it."""
    flags = f"(?{'iu' if pattern.ignore_case else ''}d)"
    if pattern.regex != catalog.EMAIL:
        return flags + catalog.spelled_out(with_borders(pattern)), False
    lead = rf"(?:(?<!{_LOCAL})|\G)(?:(?=\b)|[.%+-]++(?=[A-Za-z0-9_])|[A-Za-z0-9_]++(?=[.%+-]))"
    address = catalog.EMAIL.removeprefix(r"\b").replace(f"{_LOCAL}+@", f"{_LOCAL}++@", 1)
    return f"{flags}({catalog.spelled_out(lead)})({catalog.spelled_out(address)})", True


def words_of(pattern: catalog.Pattern) -> frozenset[str]:
    """Words in lower case of which every match has one, between borders; none if unknown."""
    listed = re.match(r"\\b\(\?:([^()]*)\)(?=\\b|\\s\+|\[:=\])", pattern.regex)
    if not listed:
        return frozenset()
    return frozenset(re.match(r"[A-Za-z]+", x)[0].lower() for x in listed[1].split("|"))


def facts(text: Column, patterns: Iterable[catalog.Pattern]) -> Column:
    """The listed words that a text has, and ``0`` if it has a digit."""
    listed = sorted(frozenset().union(*map(words_of, patterns)))
    digit = F.when(text.rlike(f"[{catalog.DIGIT_CLASS}]"), F.array(F.lit(_DIGIT))).otherwise(F.array().cast("array<string>"))
    if not listed:
        return digit
    words = F.split(F.lower(F.translate(text, *_FOLD)), f"[^{catalog.WORD_CLASS}]+")
    return F.concat(F.array_intersect(words, F.array(*map(F.lit, listed))), digit)


def possible(text: Column, pattern: catalog.Pattern, found: Column) -> Column:
    """Whether the facts ``found`` leave room for a match."""
    guard = F.lit(True)
    if pattern.needs:
        guard = guard & F.contains(text, F.lit(pattern.needs))
    if pattern.needs_digit:
        guard = guard & F.array_contains(found, _DIGIT)
    if words := words_of(pattern):
        guard = guard & F.arrays_overlap(found, F.array(*map(F.lit, sorted(words))))
    return guard
