"""Personal data (operator 7): anchors found by an Aho-Corasick automaton, expanded by local parsers.

The automaton finds at-signs, digits and plus signs, schemes and identifier cues. Each anchor is handed to
its parser, which expands it to the left and right as far as its kind's characters reach and checks
what it has: e-mail addresses around at-signs, IP addresses and card numbers around digits, phone
numbers behind plus signs (the base kinds, leftmost and not overlapping per kind), and two more
kinds: ``url`` behind a scheme, ``secret`` (passwords, tokens, keys, account numbers) behind a cue. Between
a cue and its code there may be ``number`` or ``no.`` and a few separators; an IBAN ends at its country's length.
A match that fails its check (parts of an address over 255, a wrong check digit, too few digits) is
dropped and its characters are not tried again. Time is linear in the text, long runs of digits included.

Rows: a null text is empty and has no spans; repeated rows and null ids each give their row; other
columns are kept by :func:`masked` and ignored by :func:`found`. Empty table: no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from hashlib import sha256

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.shared import mapped

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "secret")
Span = tuple[str, int, int]

# What the base kinds are made of.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")  # runs of digits with single dots between them
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_URL = re.compile(r"(?:https?|ftp)://[^\s<>\"'`{}|\\^]+|mailto:[^\s<>\"'`]+|www\.[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+[^\s<>\"'`]*", re.I)
_NAMED = r"(?:\s{0,2}(?:(?:numbers?|num|no|nr)\b\.?|#))?"  # as in "account number"
_SECRET = re.compile(_NAMED + r"[\"']?\s{0,2}(?:=|:|\bis\b)\s{0,2}[\"']?([A-Za-z0-9+/_.-]{6,})", re.I)
_ACCOUNT = re.compile(_NAMED + r"[\s:=#\"']{1,4}([0-9](?:-?[0-9]){5,})(?![A-Za-z0-9])", re.I)
_LEAD = re.compile(r"s?" + _NAMED + r"\W{1,4}(?:is\b\W{1,4})?", re.I)  # between a cue and an IBAN
_KEY = re.compile(r"AKIA[A-Z0-9]{16}(?![A-Za-z0-9])")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
#: Length of an IBAN by country.
_BY_LENGTH = ("15 NO", "16 BE", "18 DK FI FO GL NL SD FK", "19 MK SI", "20 AT BA EE KZ LT LU XK MN", "21 CH CR HR LI LV", "22 BG BH DE GB GE IE ME RS VA", "23 AE GI IL IQ OM TL SO", "24 AD CZ ES MD PK RO SA SE SK TN VG", "25 LY PT ST", "26 IS TR", "27 BI DJ FR GR IT MC MR SM", "28 AL AZ BY CY DO GT HU LB NI PL SV", "29 BR EG PS QA UA", "30 JO KW MU YE", "31 MT SC", "32 LC", "33 RU")
_LENGTHS = {c: int(n) for n, *cs in map(str.split, _BY_LENGTH) for c in cs}
ACCOUNTS = ("account", "acct", "iban")
CUES = ("password", "passwd", "token", "secret", "api_key", "apikey", "api key", "account", "acct", "iban", "ssn", "passport")
SCHEMES = ("http://", "https://", "ftp://", "mailto:", "www.")


@cache
def _automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for kind, words in (("@", "@"), ("+", "+"), ("0", "0123456789"), ("url", SCHEMES), ("cue", CUES), ("akia", ("akia",))):
        for w in words:
            a.add_word(w, (kind, len(w)))
    a.make_automaton()
    return a


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _iban_ok(code: str) -> bool:
    code = code.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _iban_end(text: str, start: int) -> int:
    """Where the IBAN at ``start`` ends: at its country's length, else the longest that passes the check; -1 without one."""
    m = _IBAN.match(text, start)
    if not m:
        return -1
    places = [i for i in range(m.start(), m.end()) if text[i] != " "]
    ends = [i + 1 for i in places[14:] if not text[i + 1 : i + 2].isalnum()]
    n = _LENGTHS.get(text[start : start + 2], 0)
    own = places[n - 1] + 1 if 0 < n <= len(places) else -1
    return next((e for e in sorted(ends, key=lambda e: (e != own, -e)) if _iban_ok(text[start:e])), -1)


def spans(text: str) -> list[Span]:
    """All spans as (kind, start, end) by kind, then start; characters counted as code points, end exclusive."""
    out: dict[str, list[Span]] = {k: [] for k in KINDS}
    low = text.lower()
    if len(low) != len(text):  # few capitals have longer lower-case forms
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    upto = dict.fromkeys((*KINDS, "dotted"), 0)  # what each kind has already read
    for end, (anchor, size) in _automaton().iter(low):
        at = end - size + 1
        if anchor == "0":
            if at >= upto["dotted"]:
                chain = _CHAIN.match(text, at)
                upto["dotted"] = chain.end()
                parts, start = chain.group().split("."), at
                for i in range(0, len(parts) - 3, 4):  # four runs are a match, the next begins behind them
                    stop = start + sum(map(len, parts[i : i + 4])) + 3
                    if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts[i : i + 4]):
                        out["ip"].append(("ip", start, stop))
                    start = stop + 1
            if at >= upto["card"]:
                m = _CARD.match(text, at)
                upto["card"] = m.end() if m else at + 1
                if m:
                    digits = m.group().replace(" ", "").replace("-", "")
                    if 16 <= len(digits) <= 19 and luhn(digits):
                        out["card"].append(("card", m.start(), m.end()))
        elif anchor == "@":
            start = at
            while start > upto["email"] and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _HOST.match(text, at + 1)):
                out["email"].append(("email", start, m.end()))
                upto["email"] = m.end()
        elif anchor == "+":
            if at >= upto["phone"] and (m := _PHONE.match(text, at)):
                upto["phone"] = m.end()
                if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
                    out["phone"].append(("phone", m.start(), m.end()))
        elif anchor == "url":
            if at >= upto["url"] and (at == 0 or not text[at - 1].isalnum()) and (m := _URL.match(text, at)):
                stop = m.start() + len(m.group().rstrip(".,;:!?)]"))
                out["url"].append(("url", at, stop))
                upto["url"] = stop
        else:
            m, start = None, -1
            if anchor == "akia":
                if m := _KEY.match(text, at):
                    start, stop = m.span()
            elif at == 0 or not text[at - 1].isalnum():
                if m := _SECRET.match(text, end + 1):
                    start, stop = m.span(1)
                    stop = start + len(m.group(1).rstrip("."))
                    if not any(c.isdigit() for c in m.group(1)):
                        m = None
                if not m and low[at : end + 1] in ACCOUNTS and (m := _ACCOUNT.match(text, end + 1)):
                    start, stop = m.span(1)
                lead = _LEAD.match(text, end + 1)
                for begin in (lead.end() if lead else end + 2, end + 2):
                    if (to := _iban_end(text, begin)) > 0:
                        m, start, stop = True, begin, to
                        break
            if m and start >= upto["secret"]:
                out["secret"].append(("secret", start, stop))
                upto["secret"] = stop
    return [s for k in KINDS for s in out[k]]


def joined(found: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in found)


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: list[list[int]] = [[] for _ in BASE_KINDS]
        digest, every = [], []
        for text in batch.column("text"):
            found = spans(text.as_py() or "")
            base = [s for s in found if s[0] in BASE_KINDS]
            for column, kind in zip(counts, BASE_KINDS):
                column.append(sum(s[0] == kind for s in base))
            digest.append(sha256(joined(base).encode()).hexdigest())
            every.append(joined(found))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(digest, pa.string()), pa.array(every, pa.string())],
            names=["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans"],
        )


def found(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, counts of the base kinds, a digest of their spans, and all spans."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return mapped(docs.select("doc_id", "text"), _find, schema)


def mask(text: str | None) -> str | None:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first (then the longest) counts."""
    if not text:
        return text
    out, at = [], 0
    for kind, start, end in sorted(spans(text), key=lambda s: (s[1], -s[2])):
        if end > at:
            if start >= at:
                out += [text[at:start], f"[{kind.upper()}]"]
            at = end
    return "".join([*out, text[at:]])


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data masked in ``text``; ``n_chars``, where there is such a column, follows the text."""
    place = docs.columns.index("text")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([mask(t.as_py()) for t in batch.column("text")], pa.string())
            yield batch.set_column(place, "text", texts)

    out = mapped(docs, step, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def op7_anchor_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return found(spark.read.parquet(f"{sf_dir}/documents.parquet"))
