"""Secrets in texts, and credentials that are spread over several parts.

Base patterns are reported wherever they stand. Weaker parts (account names, short or bare secrets, endpoints) are
reported only if a complementary part lies in the same scope: an interval join of the parts' neighbourhoods within
blocks of text between blank lines. Neighbours within reach link, so a credential is a chain of parts of any length; long
encoded values, as the lines of a private key, are links too. Both sides of the join come from one row, so it is a merge of
sorted intervals inside the row and needs no shuffle; it asks whether a partner exists and never lists pairs.

Texts are scanned whole; NULL and empty texts have no spans; rows are scanned one by one, and other columns
are carried along whatever their names.
"""

from __future__ import annotations

import re
from bisect import bisect_right

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartflow.llm.common import table
from cartflow.llm.spans import Span, base_only, count_kind, joined, ordered, span_column

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "identifier", "key", "endpoint")
#: Code points between two neighbouring parts of one credential, at most.
REACH = 400

_FLAGS = re.IGNORECASE | re.ASCII
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", _FLAGS
)
_ASSIGN_HINTS = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")  # the maximal runs of at least 16

# Values have no upper bound, so that spans cover them whole; possessive quantifiers look at no character twice.
_SET = r"""["']?+[\x20\t]*+[:=][\x20\t]*+["']?+"""
_NAMES = re.compile(
    rf"(?<![A-Za-z0-9])(?:user_?name|user|login|account|client_?id|access_?key_?id){_SET}([A-Za-z0-9._@+-]{{3,}}+)", _FLAGS
)
_NAME_HINTS = ("user", "login", "account", "client", "access")
_OTHER_ACCESS = re.compile(r"(?<![A-Za-z0-9])(?:AKIA|ASIA|AROA|AIDA)[A-Z0-9]{12,16}(?![A-Za-z0-9])")
_SHORT = re.compile(
    rf"(?<![A-Za-z0-9])(?:[a-z0-9]++_)?(?:password|passwd|pwd|pass|secret|token|api_?key|secret_?key){_SET}"
    r"""([^\s"',;]{6,}+)""",
    _FLAGS,
)
_SHORT_HINTS = (*_ASSIGN_HINTS, "pwd", "pass")
#: A bare secret: 40 characters of base64 with small and capital letters and digits.
_BARE = re.compile(r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])")
_ENDPOINT = re.compile(
    r"""(?:https?|s3|ftps?|sftp|ssh|redis|amqps?|mysql|postgres(?:ql)?|mongodb(?:\+srv)?|jdbc:[a-z0-9]++)://[^\s"'<>]{3,}+""",
    _FLAGS,
)
_HOST = re.compile(rf"(?<![A-Za-z0-9])(?:host|hostname|endpoint|server){_SET}([A-Za-z0-9.-]{{3,}}+(?::[0-9]++)?)", _FLAGS)
#: Long encoded values: no parts, but links between them. A backslash may stand for a line break inside quotes.
_ENCODED = re.compile(r"(?<![A-Za-z0-9+/=_.\\-])[A-Za-z0-9+/][A-Za-z0-9+/=_.\\-]{39,}+")
_BLANK_LINE = re.compile(r"\n[\x20\t\r]*\n")


def found(text: str, lowered: str) -> list[tuple[str, int, int]]:
    """Base spans: whole matches; an assignment counts by the length of its value."""
    spans = []
    if any(hint in lowered for hint in _ASSIGN_HINTS):
        spans += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    spans += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    spans += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return spans


def _mixed(value: str) -> bool:
    return any(c.isupper() for c in value) and any(c.islower() for c in value) and any(c.isdigit() for c in value)


def parts(text: str, lowered: str) -> dict[str, list[tuple[int, int]]]:
    """Weak candidates by what they would be in a credential."""
    out: dict[str, list[tuple[int, int]]] = {"identifier": [], "key": [], "endpoint": []}
    out["identifier"] += [m.span() for m in _OTHER_ACCESS.finditer(text)]
    if any(hint in lowered for hint in _NAME_HINTS):
        out["identifier"] += [m.span() for m in _NAMES.finditer(text)]
    if any(hint in lowered for hint in _SHORT_HINTS):
        out["key"] += [m.span() for m in _SHORT.finditer(text)]
    out["key"] += [m.span() for m in _BARE.finditer(text) if _mixed(m[0])]
    if "://" in text:
        out["endpoint"] += [m.span() for m in _ENDPOINT.finditer(text)]
    if "host" in lowered or "endpoint" in lowered or "server" in lowered:
        out["endpoint"] += [m.span() for m in _HOST.finditer(text)]
    return out


def find(text: str, reach: int = REACH) -> list[Span]:
    """Base spans, and weak parts with a complement in scope.

    Identifiers need a secret, keys an identifier or endpoint, endpoints both.
    """
    lowered = text.lower()
    base = found(text, lowered)
    spans: list[Span] = [(*s, True) for s in base]
    weak = parts(text, lowered)
    if not any(weak.values()):
        return ordered(spans, KINDS)
    known = [(a, b, "identifier" if k == "access" else "key") for k, a, b in base]
    known += [(a, b, k) for k, candidates in weak.items() for a, b in candidates]
    known += [(*m.span(), "") for m in _ENCODED.finditer(text)]
    known.sort()
    begins = [m.end() for m in _BLANK_LINE.finditer(text)]
    strong = {(a, b) for _, a, b in base}
    needs = {"identifier": ({"key"},), "key": ({"identifier"}, {"endpoint"}), "endpoint": ({"identifier", "key"},), "": ()}
    chain: list[tuple[int, int, str]] = []
    block, last = 0, 0

    def complete(chain: list[tuple[int, int, str]]) -> list[Span]:
        met = {kind for _, _, kind in chain}
        reported = {kind for kind, ways in needs.items() if any(way <= met for way in ways)}
        return [(k, a, b, False) for a, b, k in chain if k in reported and (a, b) not in strong]

    for start, end, kind in known:
        own = bisect_right(begins, start)
        if own != block or start > last + reach:
            spans += complete(chain)
            chain, block, last = [], own, end
        chain.append((start, end, kind))
        last = max(last, end)
    spans += complete(chain)
    return ordered(spans, KINDS)


def credential_spans(text: Column, reach: int = REACH) -> Column:
    return span_column(text, lambda t: find(t, reach))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and spans of secrets of every document."""
    docs = table(spark, sf_dir, "documents")
    found_in = docs.select("doc_id", credential_spans(F.col("text")).alias("s"))
    return found_in.select(
        "doc_id",
        *[count_kind(F.col("s"), kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(joined(base_only(F.col("s"))), 256).alias("base_sha256"),
        joined(F.col("s")).alias("spans"),
    )
