"""Pattern catalogs and lookup tables.

Everything in this module is a FIXED VALUE: the patterns, labels and word lists
must equal the documented ones for results to match, so they are stated here as
plain text in their natural order.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Pattern:
    """One named expression; ``needs`` is a substring every match must contain,
    ``needs_digit`` says that every match holds a digit (cheap prefilters)."""

    name: str
    regex: str
    ignore_case: bool = False
    needs: str | None = None
    needs_digit: bool = False

    @property
    def java(self) -> str:
        # i, u: ignore case by Unicode's rules; d: only \n ends a line.
        return f"(?{'iu' if self.ignore_case else ''}d){spelled_out(self.regex)}"


# What \w, \d and \s stand for: letters, all numbers and the underscore; decimal digits;
# white space with the four separators U+001C-U+001F. Engines differ on marks, joiners
# and superscripts, so the classes are always written out.
WORD_CLASS = r"\p{L}\p{N}_"
DIGIT_CLASS = r"\p{Nd}"
SPACE_CLASS = r"\t-\r\x1c-\x20\x85\p{Z}"
_SHORT = {"w": WORD_CLASS, "d": DIGIT_CLASS, "s": SPACE_CLASS}
_BORDER = f"(?:(?<=[{WORD_CLASS}])(?![{WORD_CLASS}])|(?<![{WORD_CLASS}])(?=[{WORD_CLASS}]))"


def spelled_out(regex: str) -> str:
    """``regex`` with its shorthands and word borders written as classes."""
    out, inside, at = [], False, 0
    while at < len(regex):
        c = regex[at : at + 2] if regex[at] == "\\" else regex[at]
        at += len(c)
        if c == "[" and not inside:
            inside = True
        elif c == "]":
            inside = False
        if c == "\\b" and not inside:
            out.append(_BORDER)
        elif c[0] == "\\" and c[1:].lower() in _SHORT and (c[1].islower() or not inside):
            own = _SHORT[c[1].lower()]
            out.append(own if inside else f"[{'^' if c[1].isupper() else ''}{own}]")
        else:
            out.append(c)
    return "".join(out)


# -- fixed values: the e-mail pattern of all catalogs --------------------------
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"

# -- fixed values: six core patterns -----------------------------------------
CORE = (
    Pattern("EMAIL", EMAIL, True, needs="@"),
    Pattern("PHONE", r"\b(\+\d{1,3}[-.]?)?\(?\d{3}\)?[-.]?\d{3}[-.]?\d{4}\b", needs_digit=True),
    Pattern("SSN", r"\b\d{3}[-]?\d{2}[-]?\d{4}\b", needs_digit=True),
    Pattern("CREDIT_CARD", r"\b\d{4}[- ]?\d{4}[- ]?\d{4}[- ]?\d{4}\b", needs_digit=True),
    Pattern("IP_ADDRESS", r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b", needs_digit=True),
    Pattern("DATE", r"\b\d{1,2}[/-]\d{1,2}[/-]\d{2,4}\b|\b\d{4}[-/]\d{1,2}[-/]\d{1,2}\b", needs_digit=True),
)

# -- fixed values: 29 extended patterns, in priority order ---------------------
_EXTENDED = (
    ("FULLNAME", r"\b(?:Mr\.|Ms\.|Mrs\.|Dr\.|Prof\.)?\s*[A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,3}\b"),
    ("FIRSTNAME", r"\b(?:Mr\.|Ms\.|Mrs\.|Dr\.|Prof\.)?\s*([A-Z][a-z]+)\b(?!\s+(?:Street|St\.|Ave\.|Avenue|Road|Rd\.))"),
    ("LASTNAME", r"\b[A-Z][a-z]+(?:-[A-Z][a-z]+)?\b(?=\s*(?:,|\.|\s|$))"),
    ("EMAIL", EMAIL),
    ("PHONE", r"\b(?:\+\d{1,3}[-.\s]?)?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}\b"),
    ("STREET_ADDRESS", r"\b\d{1,5}\s+[A-Za-z0-9\s]+(?:Street|St\.|Avenue|Ave\.|Road|Rd\.|Boulevard|Blvd\.|Drive|Dr\.|Lane|Ln\.)\b"),
    ("CITY", r"\b(?:New\s+York|Los\s+Angeles|Chicago|Houston|Phoenix|Philadelphia|San\s+Antonio|San\s+Diego|Dallas|San\s+Jose|Austin|Jacksonville|Fort\s+Worth|Columbus|Charlotte|San\s+Francisco|Indianapolis|Seattle|Denver|Washington)\b"),
    ("STATE", r"\b(?:AL|AK|AZ|AR|CA|CO|CT|DE|FL|GA|HI|ID|IL|IN|IA|KS|KY|LA|ME|MD|MA|MI|MN|MS|MO|MT|NE|NV|NH|NJ|NM|NY|NC|ND|OH|OK|OR|PA|RI|SC|SD|TN|TX|UT|VT|VA|WA|WV|WI|WY)\b"),
    ("ZIP_CODE", r"\b\d{5}(?:-\d{4})?\b"),
    ("ACCOUNT_NUMBER", r"\b\d{8,12}\b"),
    ("CREDIT_CARD", r"\b(?:\d{4}[- ]?){3}\d{4}\b"),
    ("BITCOIN_ADDRESS", r"\b[13][a-km-zA-HJ-NP-Z1-9]{25,34}\b"),
    ("ETHEREUM_ADDRESS", r"\b0x[a-fA-F0-9]{40}\b"),
    ("IBAN", r"\b[A-Z]{2}\d{2}[A-Z0-9]{4,}\d{7,}(?:[A-Z0-9]?){0,16}\b"),
    ("BIC", r"\b[A-Z]{6}[A-Z0-9]{2}(?:[A-Z0-9]{3})?\b"),
    ("IPV4", r"\b(?:\d{1,3}\.){3}\d{1,3}\b"),
    ("IPV6", r"\b(?:[A-Fa-f0-9]{1,4}:){7}[A-Fa-f0-9]{1,4}\b"),
    ("MAC_ADDRESS", r"\b(?:[A-Fa-f0-9]{2}:){5}[A-Fa-f0-9]{2}\b"),
    ("USERNAME", r"\b@[A-Za-z0-9_]{3,15}\b"),
    ("PASSWORD", r"\b(?:password|pwd|pass)[:=]\s*[\w@#$%^&*]{6,}\b"),
    ("GENDER", r"\b(?:Male|Female|Non-binary|M|F|NB)\b"),
    ("JOB_TITLE", r"\b(?:CEO|CTO|CFO|Director|Manager|Engineer|Analyst|Specialist|Consultant|Assistant)\b"),
    ("AREA", r"\b(?:Urban|Suburban|Rural|Metropolitan|Downtown|Uptown)\b"),
    ("GPS_COORDINATES", r"\b-?\d{1,3}\.\d{1,6},\s*-?\d{1,3}\.\d{1,6}\b"),
    ("ORDINAL_DIRECTION", r"\b(?:North|South|East|West|Northeast|Northwest|Southeast|Southwest|N|S|E|W|NE|NW|SE|SW)\b"),
    ("COUNTY", r"\b(?:County|Parish|Borough)\s+[A-Z][A-Za-z\s]+\b"),
    ("USER_AGENT", r"\bMozilla/\d\.\d.*?AppleWebKit/\d+\.\d+.*?Chrome/\d+\.\d+\.\d+\.\d+\b"),
    ("URL", r"\bhttps?://(?:www\.)?[A-Za-z0-9-]+\.[A-Za-z]{2,}(?:/\S*)?\b"),
    ("DEVICE_INFO", r"\b(?:iPhone|iPad|Android|Windows|Mac|Linux|Samsung|Google|Pixel|Dell|HP|Lenovo)\s+[A-Za-z0-9\s]+\b"),
)

# Literal text or a digit that every match must contain (used as prefilters).
_NEEDS = {"EMAIL": "@", "USERNAME": "@", "IPV6": ":", "MAC_ADDRESS": ":", "URL": "://", "USER_AGENT": "/"}
_NEEDS_DIGIT = {
    "PHONE", "STREET_ADDRESS", "ZIP_CODE", "ACCOUNT_NUMBER", "CREDIT_CARD", "BITCOIN_ADDRESS",
    "ETHEREUM_ADDRESS", "IBAN", "IPV4", "GPS_COORDINATES", "USER_AGENT",
}


def extended(ignore_case: bool = True) -> tuple[Pattern, ...]:
    """The 29-pattern catalog; case-insensitive unless told otherwise."""
    return tuple(
        Pattern(n, r, ignore_case, needs=_NEEDS.get(n), needs_digit=n in _NEEDS_DIGIT) for n, r in _EXTENDED
    )


# -- fixed values: 4 fallback patterns (case-insensitive, confidence 0.7) ------
FALLBACK_CONFIDENCE = 0.7
FALLBACK = (
    Pattern("EMAIL", EMAIL, True, needs="@"),
    Pattern("PHONE", r"\b(?:\+\d{1,3}[-.\s]?)?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}\b", True, needs_digit=True),
    Pattern("CREDIT_CARD", r"\b(?:\d{4}[- ]?){3}\d{4}\b", True, needs_digit=True),
    Pattern("NAME", r"\b(?:Mr\.|Ms\.|Mrs\.|Dr\.|Prof\.)?\s*[A-Z][a-z]+(?:\s+[A-Z][a-z]+)?\b", True),
)

# -- fixed values: 6 truth patterns (overlaps kept) ----------------------------
TRUTH = (
    Pattern("EMAIL", EMAIL, True, needs="@"),
    Pattern("PHONE", r"\(?\d{3}\)?[-.]?\d{3}[-.]?\d{4}\b", needs_digit=True),
    Pattern("SSN", r"\b\d{3}[-]?\d{2}[-]?\d{4}\b", needs_digit=True),
    Pattern("CREDIT_CARD", r"\b\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{4}\b", needs_digit=True),
    Pattern("IP_ADDRESS", r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b", needs_digit=True),
    Pattern("BITCOIN_ADDRESS", r"\b1[a-km-zA-HJ-NP-Z1-9]{25,34}\b", needs_digit=True),
)

# -- fixed values: segmentation and corpus expressions -------------------------
WORD = Pattern("WORD", r"\b\w+\b")
PUNCTUATION = Pattern("PUNCTUATION", r"[^\w\s]")
WHITESPACE = Pattern("WHITESPACE", r"\s+")
TEMPLATE_MARKER = Pattern("TEMPLATE_MARKER", r"\[([A-Z]+_\d+)\]", needs="[")
SEARCH_EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
SEARCH_PHONE = r"(\+\d{1,3}[-.]?)?\(?\d{3}\)?[-.]?\d{3}[-.]?\d{4}"
TAGGER_PHONE = r"\d{3}[-.]?\d{3}[-.]?\d{4}"
TAGGER_SSN = r"\d{3}-\d{2}-\d{4}"

# -- fixed values: categories, labels, groups ----------------------------------
CATEGORIES = ("EMAIL", "PHONE", "NAME", "ADDRESS", "SSN", "CREDIT_CARD", "DATE", "IP_ADDRESS", "GENERIC_PII")
GENERIC = "GENERIC_PII"
CATEGORY_LABELS = {c: f"[{c}]" for c in CATEGORIES if c != GENERIC}
DEFAULT_LABEL = "[PII]"
MASK = "[REDACTED]"
HASH = "####"
BLOCK = "█"

BASIC_TYPES = (
    "FULLNAME", "FIRSTNAME", "LASTNAME",
    "EMAIL", "PHONE", "STREET_ADDRESS", "CITY", "STATE", "ZIP_CODE",
    "ACCOUNT_NUMBER", "CREDIT_CARD", "BITCOIN_ADDRESS", "ETHEREUM_ADDRESS", "IBAN", "BIC",
)

TYPE_GROUPS = {
    "PERSONAL": ("NAME", "FIRSTNAME", "LASTNAME", "FULLNAME"),
    "CONTACT": ("EMAIL", "PHONE", "ADDRESS", "CITY", "STATE", "ZIP_CODE"),
    "FINANCIAL": (
        "ACCOUNT_NUMBER", "CREDIT_CARD", "BITCOIN_ADDRESS", "ETHEREUM_ADDRESS", "IBAN", "BIC", "NUMERIC_ID",
    ),
    "GENERAL": ("USERNAME", "GENERAL_PII"),
}
DEFAULT_GROUP = "GENERAL"

# -- fixed values: word lists of the feature sets and the chunk classifier ------
HONORIFICS = ("mr", "mrs", "ms", "dr", "prof")
STREET_WORDS = ("street", "st", "avenue", "ave", "road", "rd")
STREET_WORDS_LONG = STREET_WORDS + ("lane", "ln")

# -- fixed values: privacy budgets and what they are called ---------------------
EPSILONS = (0.5, 1.0, 2.0, 3.0, 5.0, 8.0)
PRIVACY_LEVELS = (
    # epsilon, redactor wording, explorer wording, report wording
    (0.5, "MAXIMUM PRIVACY (may miss some PII)", "STRONG privacy redaction", "Very High"),
    (1.0, "HIGH PRIVACY", "HIGH privacy redaction", "High"),
    (2.0, "MODERATE-HIGH PRIVACY", "MODERATE-HIGH privacy redaction", "Medium-High"),
    (3.0, "MODERATE PRIVACY", "MODERATE privacy redaction", "Medium"),
    (5.0, "MODERATE-LOW PRIVACY", "MODERATE-LOW privacy redaction", "Medium-Low"),
    (8.0, "MAXIMUM ACCURACY (weakest privacy)", "LIGHT privacy redaction", "Low"),
)
