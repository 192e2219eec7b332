"""Scalar text functions with the word and character rules of the data model.

The regular expressions avoid engine-specific shorthands (explicit classes
instead of ``\\s``), so the SQL used in checks can reuse the same text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veilmark import catalog

_WS = r"\t-\r\x1c-\x20\x85\p{Z}"
WS = f"[{_WS}]"
DIGIT = r"[\p{Nd}²³¹⁰⁴-⁹₀-₉]"
_CASED = r"\p{Lu}\p{Ll}\p{Lt}"
_N = f"[^{_CASED}{_WS}]"  # any non-space character without case
_U = r"[\p{Lu}\p{Lt}]"
_L = r"\p{Ll}"
_REST = f"(?:{_N}+{_U}{_L}*)*{_N}*"

#: a whole string in title case
TITLE_CASE = f"^{_N}*{_U}{_L}*{_REST}$"
#: some whitespace-delimited word of the text is in title case
HAS_TITLE_WORD = f"(?:^|{WS}){_N}*{_U}{_L}*{_REST}(?:{WS}|$)"
#: same, words of one character not counted
HAS_LONG_TITLE_WORD = (
    f"(?:^|{WS})(?:{_N}+{_U}{_L}*{_REST}|{_U}{_L}+{_REST}|{_U}{_N}+(?:{_U}{_L}*{_REST})?)(?:{WS}|$)"
)
#: a whole string with capitals and no small letters
ALL_CAPS = r"^[^\p{Ll}\p{Lt}]*\p{Lu}[^\p{Ll}\p{Lt}]*$"
#: some word of the text is all capitals
HAS_CAPS_WORD = (
    rf"(?:^|{WS})[^\p{{Ll}}\p{{Lt}}\p{{Lu}}{_WS}]*\p{{Lu}}[^\p{{Ll}}\p{{Lt}}{_WS}]*(?:{WS}|$)"
)


def has_word(words: tuple[str, ...]) -> str:
    """Regex: some whitespace-delimited word equals one of ``words`` in any case."""
    return f"(?i)(?:^|{WS})(?:{'|'.join(words)})(?:{WS}|$)"


def clean(text: Column) -> Column:
    """NULL becomes '', outer whitespace goes."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), f"^{WS}+|{WS}+$", "")


def ws_tokens(text: Column) -> Column:
    return F.array_remove(F.split(text, f"{WS}+"), "")


def word_tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(catalog.WORD.java), F.lit(0))


def plain(text: Column) -> Column:
    """The text with one ASCII character of its kind for each other character of a word:
    0 for a digit, A for a capital, a for the rest. Its length stays."""
    ascii_only = F.octet_length(text) == F.length(text)
    out = F.regexp_replace(text, DIGIT, "0")
    out = F.regexp_replace(out, r"\p{Lu}", "A")
    out = F.regexp_replace(out, r"[\p{L}\p{N}&&[^\x00-\x7F]]", "a")
    return F.when(ascii_only, text).otherwise(out)


def plain_with_cases(text: Column) -> Column:
    """The text with a blank, 0, A or a for each space, digit, capital (title case, too) and
    small letter that is not ASCII. Its length stays."""
    ascii_only = F.octet_length(text) == F.length(text)
    out = F.regexp_replace(text, WS, " ")
    out = F.regexp_replace(out, DIGIT, "0")
    out = F.regexp_replace(out, r"[\p{Lu}\p{Lt}]", "A")
    return F.when(ascii_only, text).otherwise(F.regexp_replace(out, r"\p{Ll}", "a"))


def class_tokens(text: Column, pattern: catalog.Pattern) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern.java), F.lit(0))


def template_markers(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(catalog.TEMPLATE_MARKER.java), F.lit(1))


def n_tokens(text: Column) -> Column:
    return F.size(ws_tokens(text))


def digit_count(text: Column) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, DIGIT, ""))


def digit_ratio(text: Column) -> Column:
    return digit_count(text) / F.greatest(F.length(text), F.lit(1))


def is_title(word: Column) -> Column:
    return word.rlike(TITLE_CASE)


def is_all_caps(word: Column) -> Column:
    return word.rlike(ALL_CAPS)


def starts_upper(word: Column) -> Column:
    return word.rlike(r"^\p{Lu}")


def has_at(text: Column) -> Column:
    return F.contains(text, F.lit("@"))


def dot_after_last_at(text: Column) -> Column:
    return has_at(text) & F.contains(F.substring_index(text, "@", -1), F.lit("."))


def uniform(*parts: Column) -> Column:
    """Reproducible number in [0, 1) from the values of ``parts``."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def pick(pool: list[str] | tuple[str, ...], *parts: Column) -> Column:
    """Reproducible element of a constant pool."""
    at = F.floor(uniform(*parts) * len(pool)).cast("int")
    return F.get(F.array(*[F.lit(v) for v in pool]), at)


def pick_int(low: int, high: int, *parts: Column) -> Column:
    """Reproducible integer in [low, high]."""
    return F.floor(uniform(*parts) * (high - low + 1)).cast("long") + low
