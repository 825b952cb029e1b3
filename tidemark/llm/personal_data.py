"""Personal data by anchor expansion.

An Aho-Corasick automaton finds the cues (at-signs, ``://``, a dot or plus before a
digit, digits, identifier words); at each cue a local parser expands to the left and
right, validates, and reports a span.  Within a kind, spans never overlap: a cue inside
the last match is passed over, whether that match was valid or not.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, text_or_empty

#: In the order that breaks ties of equal starts; the first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "account", "url")
BASE = KINDS[:4]

# Words after which an identifier or a secret is expected, in any case.
IDENTIFIER_CUES = (
    "access_key", "account", "acct", "api_key", "apikey", "auth_key", "iban", "passport", "passwd", "password",
    "private_key", "secret", "secret_key", "ssn", "token",
)

#: Those of them that name a secret, whose value may have no digits after a sign of assignment.
SECRET_CUES = ("access_key", "api_key", "apikey", "auth_key", "passwd", "password", "private_key", "secret", "secret_key", "token")

# Public forms of access tokens, by the letters they begin with.
TOKEN_FORMS = {
    "akia": re.compile(r"AKIA[0-9A-Z]{16}(?![0-9A-Za-z])"),
    "ghp_": re.compile(r"ghp_[0-9A-Za-z]{36}(?![0-9A-Za-z])"),
    "gho_": re.compile(r"gho_[0-9A-Za-z]{36}(?![0-9A-Za-z])"),
    "github_pat_": re.compile(r"github_pat_[0-9A-Za-z_]{22,}"),
    "xoxb-": re.compile(r"xoxb-[0-9A-Za-z-]{20,}"),
    "xoxp-": re.compile(r"xoxp-[0-9A-Za-z-]{20,}"),
}

_DIGITS = "0123456789"
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_OCTETS = re.compile(r"(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# What may stand between a cue and its value: "number", "no." and their like, white space and a sign of assignment.
_BRIDGE = re.compile(r"\.?(?:[\x20\t_-]{0,3}(?:number|num|no|nr|id|key|code)(?![A-Za-z0-9])\.?){0,2}[\"']?[\x20\t]{0,3}(?:[:=#]{1,2}>?[\x20\t]{0,3})?[\"']?", re.IGNORECASE)
_VALUE = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9]|[_-](?=[A-Za-z0-9]))*")
_GROUPS = re.compile(r"[0-9]{2,6}(?:[\x20-][0-9]{2,6})+(?![A-Za-z0-9])")
_DATE = re.compile(r"(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}")
_IBAN = re.compile(r"[A-Za-z]{2}[0-9]{2}(?:[\x20-]?[A-Za-z0-9]){11,30}")
_AUTHORITY = re.compile(r"[^\s/?#\"'<>@]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*[^\s\"'<>]*")


def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for cue in ("@", "://", *_DIGITS, *("." + d for d in _DIGITS), *("+" + d for d in _DIGITS)):
        found.add_word(cue, (len(cue), cue[0], None))
    for word in IDENTIFIER_CUES:
        found.add_word(word, (len(word), "w", word))
    for start in TOKEN_FORMS:
        found.add_word(start, (len(start), "t", start))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])) % 10 == 0


def iban_end(text: str, at: int) -> int | None:
    """Where an IBAN at ``at`` ends: the longest run of 15 to 34 letters and digits, perhaps spaced, whose check digits hold."""
    m = _IBAN.match(text, at)
    if not m:
        return None
    marks = [i for i in range(at, m.end()) if text[i].isalnum()]
    for n in range(len(marks), 14, -1):
        end = marks[n - 1] + 1
        if end == len(text) or not text[end].isalnum():
            compact = "".join(text[i] for i in marks[:n])
            if int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1:
                return end
    return None


def identifier(text: str, after: int, cue: str) -> tuple[int, int] | None:
    """The span of the identifier or secret whose cue ends at ``after``.

    An IBAN is valid by its check digits.  Other values have eight characters or more, four
    of them digits, without an upper bound; digits may stand in groups if a sign or word
    joins them to the cue.  A secret needs no digit after ``=``, and after ``:`` one digit or 16
    characters.  A date is no identifier.
    """
    m = _BRIDGE.match(text, after)
    at = m.end()
    if cue == "iban":
        end = iban_end(text, at)
        return (at, end) if end else None
    if m[0].strip(" \t") and (g := _GROUPS.match(text, at)) and 8 <= sum(map(g[0].count, _DIGITS)) <= 24:
        return None if _DATE.fullmatch(g[0]) else (at, g.end())
    v = _VALUE.match(text, at)
    if not v or at == after or len(v[0]) < 8 or _DATE.fullmatch(v[0]):
        return None
    digits = sum(map(v[0].count, _DIGITS))
    if digits >= 4 or cue in SECRET_CUES and ("=" in m[0] or ":" in m[0] and (digits or len(v[0]) >= 16)):
        return at, v.end()
    return None


def _lowered(text: str) -> str:
    """The text in lower case, each character in its place."""
    low = text.lower()
    return low if len(low) == len(text) else text.translate({c: c + 32 for c in range(65, 91)})


def find_spans(text: str, cues) -> list[tuple[int, int, int]]:
    """(start, place of the kind in KINDS, end) of every span, in that order."""
    spans: list[tuple[int, int, int]] = []
    end_email = end_ip = end_card = end_account = end_url = 0
    for last, (length, cue, word) in cues.iter(_lowered(text)):
        at = last - length + 1
        if cue == "@":
            start = at
            while start > end_email and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                end_email = m.end()
                spans.append((start, 0, end_email))
        elif cue == ".":
            start = at
            while start > end_ip and text[start - 1] in _DIGITS:
                start -= 1
            if start < at and at >= end_ip and (m := _OCTETS.match(text, at)):
                end_ip = m.end()
                parts = text[start:end_ip].split(".")
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts):
                    spans.append((start, 1, end_ip))
        elif cue in _DIGITS:
            if at >= end_card:  # the first digit of a run
                if m := _CARD.match(text, at):
                    end_card = m.end()
                    if 12 <= end_card - at:
                        digits = m[0].replace(" ", "").replace("-", "")
                        if 12 <= len(digits) <= 19 and luhn(digits):
                            spans.append((at, 2, end_card))
        elif cue == "+":
            if (m := _PHONE.match(text, at)) and 9 <= sum(map(m[0].count, _DIGITS)) <= 15:
                spans.append((at, 3, m.end()))
        elif cue == "t":
            if at >= end_account and not (at and text[at - 1].isalnum()) and (m := TOKEN_FORMS[word].match(text, at)):
                end_account = m.end()
                spans.append((at, 4, end_account))
        elif cue == "w":
            # A cue begins a word, or a part of one that an underscore or a capital sets off.
            inside = at and text[at - 1].isalnum() and not (text[at].isupper() and text[at - 1].islower())
            if at >= end_account and not inside and (found := identifier(text, last + 1, word)):
                spans.append((found[0], 4, found[1]))
                end_account = found[1]
        elif at >= end_url:
            start = at
            while start > end_url and text[start - 1].isascii() and text[start - 1].isalpha():
                start -= 1
            if start < at and (m := _AUTHORITY.match(text, at + 3)):  # only addresses with user information
                end_url = m.end()
                spans.append((start, 5, end_url))
    spans.sort()
    return spans


def shown(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{start}:{end}" for start, k, end in spans)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind in angle brackets; overlapping spans become one, named by the first."""
    parts, end = [], 0
    for start, kind, stop in spans:
        if start >= end:
            parts += [text[end:start], f"<{KINDS[kind].upper()}>"]
        end = max(end, stop)
    return "".join(parts) + text[end:]


_CUES: list = []


def _cues():
    if not _CUES:
        _CUES.append(automaton())
    return _CUES[0]


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_email, n_ip, n_card, n_phone, base (text of the base spans), spans (of all), masked.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and then kind.
    Null and empty texts have none; repeated rows and null ids are answered row by row;
    further columns of ``docs`` are not read.  A scan without shuffle.
    """

    ship(docs.sparkSession)

    @F.pandas_udf("n_email long, n_ip long, n_card long, n_phone long, base string, spans string, masked string")
    def found(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        cues = _cues()
        for texts in parts:
            rows = []
            for text in texts:
                spans = find_spans(text, cues) if text else []
                kinds = [k for _, k, _ in spans]
                base = [s for s in spans if s[1] < len(BASE)]
                rows.append((*map(kinds.count, range(len(BASE))), shown(base), shown(spans), masked(text, spans) if spans else text))
            yield pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base", "spans", "masked"])

    return docs.select(F.col(id_col), found(text_or_empty(text_col)).alias("f")).select(id_col, "f.*")


def redact(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The same rows and columns with every span of ``text_col`` masked and ``length_col``, if there, counted anew.

    A null text stays null.
    """

    ship(docs.sparkSession)

    @F.pandas_udf("string")
    def clean(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cues = _cues()
        for texts in parts:
            yield pd.Series([t if not t else masked(t, find_spans(t, cues)) for t in texts], dtype="object")

    out = docs.withColumn(text_col, clean(F.col(text_col)))
    if length_col in docs.columns:
        out = out.withColumn(length_col, F.char_length(text_col).cast(docs.schema[length_col].dataType))
    return out.select(docs.columns)
