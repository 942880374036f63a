"""Text cleaning as column expressions.

Only entity decoding and Unicode normalisation need Python; they share one Arrow-batched function that
sees just the rows they can change. Every pattern runs in linear time on long runs: quantifiers that can
not profit from backtracking are possessive, and a match may not start inside a run already rejected.
"""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Callable
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tagloom.functions.binding import bind

# What \w and \s mean for Unicode text, spelt out as character classes.
WORD = r"\p{L}\p{N}_"
# The inner class tests one range first, so that letters are told apart by two checks.
OTHER_SPACE = (
    r"\t\n\x0b\f\r\x1c-\x1f\x85\xa0"
    r"[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]"
)
SPACE = " " + OTHER_SPACE
SEPARATOR = SPACE + r"\-()"

# Placeholder tokens.
URL_TOKEN = "<URL>"
USER_TOKEN = "<USER>"
EMAIL_TOKEN = "<EMAIL>"
PHONE_TOKEN = "<NUM>"

# Quotes to a plain double or single quote, dashes to a hyphen, yo to ye.
DOUBLE_QUOTES = "«»„“”‟"
SINGLE_QUOTES = "‘’"
DASHES = "–—−‒―"
YO, YE = "ёЁ", "еЕ"

# Cells a CSV reader takes for a missing text.
MISSING_CELLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

_URL = rf"(?iu)(?:https?://|www\.)[^{SPACE}]++"
_USER = rf"@[{WORD}]++"
_EMAIL_LOCAL = r"a-zA-Z0-9_.+\-"
_EMAIL = rf"(?:\G|(?<![{_EMAIL_LOCAL}]))[{_EMAIL_LOCAL}]++@[a-zA-Z0-9\-]++\.[a-zA-Z0-9.\-]++"
_DIGIT = r"\p{Nd}"
_RU_PHONE = rf"(?:\+7|8)[{SEPARATOR}]*+" + rf"[{SEPARATOR}]*+".join(
    [_DIGIT + "{3}", _DIGIT + "{3}", _DIGIT + "{2}", _DIGIT + "{2}"]
)
_DIGIT_RUN = rf"(?:{_DIGIT}[{SEPARATOR}]*+)"
_PHONE = (
    rf"{_DIGIT_RUN}{{6,}}+|\+{_DIGIT_RUN}{{7,}}+"
    rf"|[{SEPARATOR}](?<![{SEPARATOR}]{{2}})[{SEPARATOR}]*+{_DIGIT_RUN}{{6,}}+"
)
_TAG = r"<[^>\n]++>"


@cache
def _control() -> str:
    """Control, format, private and unassigned characters, but no line break or tab.

    Left out are ranges that this Python's Unicode tables know as characters and its oldest ones don't: the JVM's
    tables may be older than Python's and count new characters, emoji among them, as unassigned.
    """
    old, ranges = unicodedata.ucd_3_2_0, []
    for point in range(0x80, 0x110000):
        if old.category(chr(point)) == "Cn" and unicodedata.category(chr(point))[0] != "C":
            if ranges and ranges[-1][1] == point - 1:
                ranges[-1][1] = point
            else:
                ranges.append([point, point])
    # plain text is told apart by few comparisons, new characters by a search, and a run goes in one piece
    return rf"[\x00-\x08\x0b-\x1f\x7f-\x{{10FFFF}}&&[^\xae-\u02ff]&&\p{{C}}&&[^{_search_class(ranges)}]]++"


def _search_class(ranges: list[tuple[int, int]], fan: int = 6) -> str:
    """Class of many ranges of characters, nested so that a character is told apart by few comparisons.

    The regular expressions of the JVM test the members of a class one after another, and the right side of ``&&``
    only where the left one holds; so each group of ranges stands behind the one range that spans it.
    """
    members = [(a, b, rf"\x{{{a:X}}}-\x{{{b:X}}}") for a, b in ranges]
    while len(members) > 1:
        groups = [members[i : i + fan] for i in range(0, len(members), fan)]
        members = [
            (g[0][0], g[-1][1], rf"[\x{{{g[0][0]:X}}}-\x{{{g[-1][1]:X}}}&&[{''.join(m[2] for m in g)}]]") for g in groups
        ]
    return members[0][2]


@cache
def _composable() -> str:
    """Class of all characters that normalisation may change: those it rewrites, and those that join the one before."""
    ranges = []
    for point in range(0x80, 0x110000):
        if 0xD800 <= point <= 0xDFFF:  # surrogates are no characters of a text
            continue
        c = chr(point)
        joins = unicodedata.combining(c) or 0x1161 <= point <= 0x11FF or unicodedata.category(c) in ("Mc", "Mn")
        if joins or not unicodedata.is_normalized("NFKC", c):
            if ranges and ranges[-1][1] == point - 1:
                ranges[-1] = (ranges[-1][0], point)
            else:
                ranges.append((point, point))
    return _search_class(ranges)


# A lone plain space is left alone, so that ordinary text gives no matches.
_WHITESPACE = rf"(?: [{SPACE}]|[{OTHER_SPACE}])[{SPACE}]*+"


def _replace(c: Column, pattern: str, token: str) -> Column:
    quoted = token.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(c, F.lit(pattern), F.lit(quoted))


def mask_urls(c: Column, token: str = URL_TOKEN) -> Column:
    return _replace(c, _URL, token)


def mask_users(c: Column, token: str = USER_TOKEN) -> Column:
    return _replace(c, _USER, token)


def mask_emails(c: Column, token: str = EMAIL_TOKEN) -> Column:
    return bind(c, lambda x: F.when(F.contains(x, F.lit("@")), _replace(x, _EMAIL, token)).otherwise(x))


def mask_ru_phones(c: Column, token: str = PHONE_TOKEN) -> Column:
    """``+7`` or ``8`` and ten digits in groups of 3-3-2-2."""
    return _replace(c, _RU_PHONE, token)


def mask_digit_runs(c: Column, token: str = PHONE_TOKEN) -> Column:
    """Six or more digits with spaces, dashes or brackets between and around them."""
    return _replace(c, _PHONE, token)


def mask_phones(c: Column, token: str = PHONE_TOKEN) -> Column:
    return mask_digit_runs(mask_ru_phones(c, token), token)


def plain_punctuation(c: Column, quotes: bool = True, dashes: bool = True, yo: bool = True) -> Column:
    """Curly quotes, long dashes and yo to their plain forms, in one pass."""
    source = target = ""
    if quotes:
        source += DOUBLE_QUOTES + SINGLE_QUOTES
        target += '"' * len(DOUBLE_QUOTES) + "'" * len(SINGLE_QUOTES)
    if dashes:
        source += DASHES
        target += "-" * len(DASHES)
    if yo:
        source += YO
        target += YE
    return F.translate(c, source, target) if source else c


def strip_control(c: Column) -> Column:
    """Drop control, format and unassigned characters except newline and tab."""
    return _replace(c, _control(), "")


def strip_tags(c: Column) -> Column:
    return _replace(c, _TAG, " ")


def collapse_whitespace(c: Column) -> Column:
    return F.trim(_replace(c, _WHITESPACE, " "))


def decode_and_compose(c: Column, entities: bool = True, nfkc: bool = True) -> Column:
    """HTML entities to characters, then Unicode NFKC; rows neither step can change stay in the JVM."""
    triggers = [("&", entities), (_composable(), nfkc)]
    wanted = "|".join(pattern for pattern, on in triggers if on)
    if not wanted:
        return c

    @F.pandas_udf("string")
    def rewrite(texts: pd.Series) -> pd.Series:
        def one(text):
            if text is None:
                return None
            if entities:
                text = html.unescape(text)
            return unicodedata.normalize("NFKC", text) if nfkc else text

        return texts.map(one)

    return F.coalesce(rewrite(bind(c, lambda x: F.when(x.rlike(wanted), x))), c)


def missing_as_nan_text(c: Column, markers: list[str] | None = None) -> Column:
    """A missing text becomes the literal ``nan``; ``markers`` lists further cells read as missing."""
    text = c.cast("string")
    if markers:
        text = F.when(~text.isin(markers), text)
    return F.coalesce(text, F.lit("nan"))


def is_blank(c: Column) -> Column:
    return F.coalesce(F.length(collapse_whitespace(c)) == 0, F.lit(True))


def clean_text(
    c: Column,
    *,
    repair: Callable[[Column], Column] | None = None,
    entities: bool = True,
    nfkc: bool = True,
    control: bool = True,
    tags: bool = True,
    urls: bool = True,
    users: bool = True,
    emails: bool = True,
    phones: bool = True,
    quotes: bool = True,
    dashes: bool = True,
    yo: bool = True,
    whitespace: bool = True,
    url_token: str = URL_TOKEN,
    user_token: str = USER_TOKEN,
    email_token: str = EMAIL_TOKEN,
    phone_token: str = PHONE_TOKEN,
    email_first: bool = False,
    keep_null: bool = False,
) -> Column:
    """The whole cleaner; the order of the steps is part of its meaning.

    ``repair`` plugs in a repair step for wrongly decoded text. Mentions are masked before e-mails, so that
    ``a@b.com`` reads ``a<USER>.com``; ``email_first`` turns the two around. A missing text becomes
    ``'None'`` unless ``keep_null`` is set.
    """
    out = c.cast("string") if keep_null else F.coalesce(c.cast("string"), F.lit("None"))
    if repair is not None:
        out = repair(out)
    out = decode_and_compose(out, entities, nfkc)
    if control:
        out = strip_control(out)
    if tags:
        out = strip_tags(out)
    if urls:
        out = mask_urls(out, url_token)
    if emails and email_first:
        out = mask_emails(out, email_token)
    if users:
        out = mask_users(out, user_token)
    if emails and not email_first:
        out = mask_emails(out, email_token)
    if phones:
        out = mask_phones(out, phone_token)
    out = plain_punctuation(out, quotes, dashes, yo)
    return collapse_whitespace(out) if whitespace else out
