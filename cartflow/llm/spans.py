"""Spans found in texts: their column type and the digests made of them."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Code points, end exclusive; ``base`` spans are those of the fixed patterns, the others are the method's.
SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"
Span = tuple[str, int, int, bool]


class Intervals:
    """Sorted intervals that answer whether any of them contains a range."""

    def __init__(self, spans: list[tuple[int, int]]) -> None:
        self.spans = sorted(set(spans))
        self.starts = [s for s, _ in self.spans]
        self.ends: list[int] = []  # the greatest end so far
        for _, end in self.spans:
            self.ends.append(max(end, self.ends[-1]) if self.ends else end)

    def cover(self, start: int, end: int) -> bool:
        i = bisect_right(self.starts, start)
        return i > 0 and self.ends[i - 1] >= end


def ordered(spans: Iterable[Span], kinds: tuple[str, ...]) -> list[Span]:
    """Distinct spans by start, then kind in the order of ``kinds``, then end."""
    place = {kind: i for i, kind in enumerate(kinds)}
    return sorted(set(spans), key=lambda s: (s[1], place[s[0]], s[2]))


def span_column(text: Column, find: Callable[[str], list[Span]]) -> Column:
    """``find`` over every text of a column, NULL as the empty text, in Arrow batches."""

    @F.arrow_udf(SPANS)
    def of_batch(texts):
        import pyarrow as pa

        kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])
        names = ("kind", "start", "end", "base")
        rows = [[dict(zip(names, span, strict=True)) for span in find(text or "")] for text in texts.to_pylist()]
        return pa.array(rows, pa.list_(kind))

    return of_batch(text)


def base_only(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["base"])


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["base"] & (s["kind"] == kind))).cast("bigint")


def joined(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
