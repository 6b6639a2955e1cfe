"""Personal identifiers in texts, also disguised ones, with offsets of the original text.

Base patterns run on the text as it is. Then a chain of transducers rewrites lookalike characters and digits of other
scripts, zero-width characters, bracketed signs, bare at/dot words and spelled digits, each on the result of the one
before and keeping for each rewritten stretch where it came from, so mixed disguises are seen through; the same
patterns run on the last result and their spans are mapped back step by step. Spans inside one base span of their kind add nothing; wider
ones stand beside the base spans, which may be only a fragment of a partly disguised identifier.

A bare " at " alone is prose ("sold at example.com"): it makes an address only with a second sign of disguise, which is
a bare or bracketed dot or a rewritten character in the same address, or after a word of contact ("mail jane at example.com").
Words of prose, such as "us" or "available", and hosts that start with "www." are never made addresses by a bare " at ".

Texts are scanned whole, in one pass each and without backtracking over long runs; NULL and empty texts
have no spans; rows are scanned one by one, and other columns are carried along whatever their names.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartflow.llm.common import table
from cartflow.llm.spans import Intervals, Span, base_only, count_kind, joined, ordered, span_column

KINDS = ("email", "ip", "card", "phone")

# --- base patterns: leftmost, non-overlapping for each kind, failing matches dropped ---

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match starts where its run of digits starts: the look-behind skips the rest of a run that failed.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Every match holds one @, so the name is the run before it and the host what follows."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        host = _DOMAIN.match(text, at + 1) if start < at else None
        if host:
            yield start, host.end()
        # Names end before the next @, so no character is looked at twice.
        done = host.end() if host else at + 1
        at = text.find("@", done)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = ord(c) - 48
        total += value if i % 2 == 0 else value * 2 - 9 * (value > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _small(part: str) -> bool:
    part = part.lstrip("0") or "0"
    return len(part) <= 3 and int(part) <= 255


def found(text: str) -> list[tuple[str, int, int]]:
    """Base spans of a text."""
    spans = [("email", a, b) for a, b in emails(text)]
    spans += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(digits := _digits(m[0])) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    spans += [("phone", *m.span()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return spans


# --- transducers ---

#: Letters of other scripts that look like Latin ones (fixed values).
LOOKALIKES = dict(
    zip(
        "аеорсухіјѕԁһԛԝьАВЕКМНОРСТУХІЈЅ" "οαινρτυκΑΒΕΖΗΙΚΜΝΟΡΤΥΧ" "ɑɡıɩʏʀʟɴᴄᴏᴠᴢ",
        "aeopcyxijsdhqwbABEKMHOPCTYXIJS" "oaivptukABEZHIKMNOPTYX" "agiiyrlncovz",
        strict=True,
    )
)
_NOTHING = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
_DOTS = "\u2024\u3002\uff0e\uff61"
_DASHES = "\u2010\u2011\u2012\u2013\u2014\u2212"
_NOTHINGS = re.compile(f"[{_NOTHING}]+")
_BLANKS = "\u00a0\u2002\u2003\u2007\u2009\u202f\u3000"
_SPELLED = {
    word: str(digit)
    for digit, names in enumerate(
        ("zero oh null cero", "one un eins uno", "two deux zwei dos", "three trois drei tres", "four quatre vier cuatro",
         "five cinq fünf cinco", "six sechs seis", "seven sept sieben siete", "eight huit acht ocho",
         "nine neuf neun nueve")
    )
    for word in names.split()
}


class _Plain(dict):
    """Translation of single characters, filled as characters turn up; one character stays one character."""

    def __missing__(self, code: int) -> str:
        char = chr(code)
        plain = LOOKALIKES.get(char, char)
        if code > 127:
            if 0xFF01 <= code <= 0xFF5E:
                plain = chr(code - 0xFEE0)
            elif (digit := unicodedata.decimal(char, None)) is not None:
                plain = str(digit)
            elif char in _DOTS:
                plain = "."
            elif char in _DASHES:
                plain = "-"
            elif char in _BLANKS:
                plain = " "
            elif unicodedata.category(char) in ("Lu", "Ll", "So"):
                # Mathematical, circled and other letters that stand for a plain one.
                folded = unicodedata.normalize("NFKC", char)
                if len(folded) == 1 and folded.isascii():
                    plain = folded
        self[code] = plain
        return plain


def _word_of(words: list[str]) -> str:
    return "|".join(sorted(words, key=len, reverse=True))


_DIGIT = rf"(?:{_word_of(list(_SPELLED))}|[0-9])"
_GAP = r"[\x20.,-]{0,2}"
_EDGE = r"(?<![^\W_])(?:plus[\x20-]{1,2}|\+\x20?)?"
#: Ten digits or more in a row, at least one of them spelled; words must end at word ends.
_SPELLED_RUN = re.compile(
    rf"{_EDGE}(?:{_DIGIT}(?![^\W\d_]){_GAP}){{9,}}{_DIGIT}(?![^\W\d_])", re.IGNORECASE
)
_SPELLED_HINT = re.compile(rf"\b(?:{_word_of(list(_SPELLED))})\b{_GAP}{_DIGIT}", re.IGNORECASE)
_SPELLED_PART = re.compile(rf"plus[\x20-]{{1,2}}|{_word_of(list(_SPELLED))}|[\x20.,-]+", re.IGNORECASE)
#: Bracketed signs, as "(at)" or "[.]", with the blanks around them.
_BRACKETED = re.compile(r"\x20?[(\[{<]\x20?(at|dot|@|\.)\x20?[)\]}>]\x20?", re.IGNORECASE)
_LABEL = r"[A-Za-z0-9-]+"
_TOP = r"(?!dot\b)[A-Za-z]{2,24}(?![A-Za-z0-9])"
#: Bare words count only as a whole address: name at label dot label (not the word dot itself), or number dot number three
#: times. Signs made by the steps before, or plain ones, may stand for any of the words. A sign with a blank on one side
#: only, as before the name of an account, needs a bare dot behind it. Names start where their run of words and dots starts.
_BARE = re.compile(
    rf"(?<![A-Za-z0-9._%+-])(?<![A-Za-z0-9._%+-]\x20dot\x20)[A-Za-z0-9._%+-]++(?:\x20dot\x20[A-Za-z0-9._%+-]++)*+"
    rf"(?:(?:\x20at\x20|\x20@\x20|@){_LABEL}(?:(?:\x20dot\x20|\.){_LABEL})*(?:\x20dot\x20|\.){_TOP}"
    rf"|\x20?@\x20?{_LABEL}(?:(?:\x20dot\x20|\.){_LABEL})*\x20dot\x20{_TOP})"
    r"|(?<![0-9])[0-9]{1,3}(?:(?:\x20dot\x20|\.)[0-9]{1,3}){3}(?![0-9])",
    re.IGNORECASE,
)
_BARE_PART = re.compile(r"\x20?@\x20?|\x20(?:at|dot)\x20", re.IGNORECASE)
_AT_HOST = re.compile(r" at [a-z0-9-]+(?:\.| dot )[a-z0-9]")

Rewrite = tuple[int, int, str]


def _without_nothing(text: str) -> list[Rewrite]:
    return [(m.start(), m.end(), "") for m in _NOTHINGS.finditer(text)]


def _bracketed(text: str) -> list[Rewrite]:
    if not any(sign in text for sign in "([{<"):
        return []
    return [(*m.span(), "@" if m[1].lower() in ("at", "@") else ".") for m in _BRACKETED.finditer(text)]


def _bare(text: str) -> list[Rewrite]:
    lowered = text.lower()
    if " dot " not in lowered and " @ " not in lowered and not _AT_HOST.search(lowered):
        return []
    return [
        (*part.span(), "." if "dot" in part[0].lower() else "@")
        for m in _BARE.finditer(text)
        for part in _BARE_PART.finditer(text, *m.span())
        if part[0] != "@"
    ]


def _spelled(text: str) -> list[Rewrite]:
    if not _SPELLED_HINT.search(text):
        return []
    made = []
    for m in _SPELLED_RUN.finditer(text):
        if not any(c.isalpha() for c in m[0]):
            continue
        for part in _SPELLED_PART.finditer(text, *m.span()):
            word = part[0].lower()
            made.append((*part.span(), _SPELLED.get(word, "+" if word.startswith("plus") else " ")))
    return made


#: Steps after the lookalikes, each on the text that the one before made; the rewrites of a step are in order and apart.
_STEPS = (_without_nothing, _bracketed, _bare, _spelled)
#: Rewritten stretches of a step: start and end in its result, start and end in its source.
Stretches = list[tuple[int, int, int, int]]


def _rewritten(text: str, rewrites: list[Rewrite]) -> tuple[str, Stretches]:
    pieces, stretches, source, length = [], [], 0, 0
    for start, end, new in rewrites:
        pieces += [text[source:start], new]
        length += start - source
        stretches.append((length, length + len(new), start, end))
        length += len(new)
        source = end
    pieces.append(text[source:])
    return "".join(pieces), stretches


def normalised(text: str, plain: dict[int, str]) -> tuple[str, list[Stretches]]:
    """The text after all steps, and the stretches of each step that changed it."""
    steps = []
    text = text.translate(plain)
    for step in _STEPS:
        if rewrites := step(text):
            text, stretches = _rewritten(text, rewrites)
            steps.append(stretches)
    return text, steps


def source_span(start: int, end: int, stretches: Stretches, firsts: list[int]) -> tuple[int, int]:
    """Where a span of a step's result lies in the step's source; a touched stretch counts whole."""

    def at(place: int) -> tuple[int, int]:
        i = bisect_right(firsts, place) - 1
        if i < 0:
            return place, place + 1
        _, b, c, d = stretches[i]
        return (c, d) if place < b else (d + place - b, d + place - b + 1)

    return at(start)[0], at(end - 1)[1]


#: Words that stand before " at " in prose and are no names (fixed values).
PROSE = frozenset(
    "a about again all also and any anyone are around arrive arrived as available back be been bought but buy buying call called "
    "check checked click come day directly down download downloaded eat everyone find for found free from get go going good had hand "
    "has have he help her here hers him his home hosted i information is it items join just last listed live lived living look "
    "looked looking looks me meet meeting met more most my new not now of offered on once one online only open or order ordered our "
    "ours out over page people play price prices published read register registered said sale saw school see seen sell selling she "
    "shop shopping shown sign site sold stay store stored store's that the them then there these they this those time to today "
    "up us visit was we website week went were what when which while who with work worked working works you your yours".split()
)
#: Words that say that an address follows (fixed values).
_CONTACT = re.compile(r"(?:\be-?mails?|\bmail(?:\x20me|\x20us)?|\bcontact|\bwrite\x20to|\bwrites?|\breach|\baddress)(?:\x20to)?:?\x20$", re.IGNORECASE)
_BARE_AT = re.compile(r"([^\s@]+(?:\x20dot\x20[^\s@]+)*)\x20at\x20(.*)", re.IGNORECASE | re.DOTALL)
_PLAIN_HOST = re.compile(rf"{_LABEL}(?:\.{_LABEL})+")


def _prose(text: str, start: int, end: int) -> bool:
    """Whether what was taken for an address is a bare " at " of prose."""
    parts = _BARE_AT.fullmatch(text, start, end)
    if parts is None:
        return False
    name, host = parts[1], parts[2]
    if name.lower() in PROSE or host.lower().startswith("www."):
        return True
    plain = name.isascii() and _PLAIN_HOST.fullmatch(host) is not None and " " not in name
    return plain and _CONTACT.search(text, max(0, start - 20), start) is None


def find(text: str, plain: dict[int, str] | None = None) -> list[Span]:
    """Base spans and those found behind disguises."""
    base = found(text)
    spans: list[Span] = [(*s, True) for s in base]
    rewritten, steps = normalised(text, _Plain() if plain is None else plain)
    if rewritten != text:
        ways = [(stretches, [s[0] for s in stretches]) for stretches in reversed(steps)]
        known = {kind: Intervals([(a, b) for k, a, b in base if k == kind]) for kind in KINDS}
        for kind, start, end in found(rewritten):
            for way in ways:
                start, end = source_span(start, end, *way)
            if not known[kind].cover(start, end) and not (kind == "email" and _prose(text, start, end)):
                spans.append((kind, start, end, False))
    return ordered(spans, KINDS)


def identifier_spans(text: Column) -> Column:
    plain = _Plain()
    return span_column(text, lambda t: find(t, plain))


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with its spans replaced by the names of their kinds; overlapping spans become one."""
    pieces, done = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= done:
            pieces += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*pieces, text[done:]])


def redacted_text(text: Column) -> Column:
    """The text without personal identifiers; NULL stays NULL."""
    plain = _Plain()

    @F.arrow_udf("string")
    def of_batch(texts):
        import pyarrow as pa

        return pa.array(
            [t and redacted(t, [s[:3] for s in find(t, plain)]) for t in texts.to_pylist()], pa.string()
        )

    return of_batch(text)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and spans of personal identifiers of every document."""
    docs = table(spark, sf_dir, "documents")
    found_in = docs.select("doc_id", identifier_spans(F.col("text")).alias("s"))
    return found_in.select(
        "doc_id",
        *[count_kind(F.col("s"), kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(joined(base_only(F.col("s"))), 256).alias("base_sha256"),
        joined(F.col("s")).alias("spans"),
    )
