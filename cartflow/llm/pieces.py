"""What tokenizing operators share: splitting texts, remembering pieces, working through texts in small batches."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Characters below this one are never changed by normal form C, whatever stands beside them.
LATIN_END = 0x300
#: Text of a batch within a worker, in bytes; one longer text is a batch of its own.
BATCH_BYTES = 4 << 20


def latin_class(kind: str) -> str:
    """The members below LATIN_END of ``\\p{L}``, ``\\p{N}`` or white space, as ranges of a character class."""
    import unicodedata

    def belongs(code: int) -> bool:
        if kind == "s":
            return chr(code) in "\t\n\x0b\x0c\r \x85\xa0"
        return unicodedata.category(chr(code))[0] == kind

    members, ranges = [code for code in range(LATIN_END) if belongs(code)], []
    for code in members:
        if ranges and ranges[-1][1] == code - 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in ranges)


def latin_pattern(pattern: str) -> str | None:
    """``pattern`` for texts of characters below LATIN_END, in the faster ``re``; None if it has other classes."""
    found, inside = [], False
    for part in re.findall(r"\\p\{\w+\}|\\.|.", pattern, re.DOTALL):
        if part in (r"\p{L}", r"\p{N}", r"\s"):
            members = latin_class(part.strip("\\p{}"))
            found.append(members if inside else f"[{members}]")
        elif part == r"\S" and not inside:
            found.append(f"[^{latin_class('s')}]")
        elif len(part) > 1 and part[1].isalnum():
            return None
        else:
            inside = part == "[" or inside and part != "]"
            found.append(part)
    return "".join(found)


class Splitter:
    """All matches of a pattern in a text."""

    def __init__(self, pattern: str) -> None:
        import regex

        self.any = regex.compile(pattern).findall
        latin = latin_pattern(pattern)
        self.latin = re.compile(latin).findall if latin else self.any

    def __call__(self, text: str) -> list[str]:
        return self.latin(text) if is_latin(text) else self.any(text)


_beyond_latin = re.compile(f"[{chr(LATIN_END)}-\U0010ffff]").search


def is_latin(text: str) -> bool:
    return text.isascii() or _beyond_latin(text) is None


class Memory(dict):
    """Made values by piece. Two generations of ``room`` bytes each: what the older one is asked for moves on."""

    def __init__(self, make: Callable[[str], object], room: int, weight: Callable[[object], int] = len) -> None:
        super().__init__()
        self.make = make
        self.weight = weight  # bytes of a value
        self.room = self.left = room
        self.older: dict[str, object] = {}

    def __missing__(self, piece: str) -> object:
        value = self.older.pop(piece, None)
        if value is None:
            value = self.make(piece)
        # Some 200 bytes for two objects and their place; four for a character at most.
        size = 200 + 4 * len(piece) + self.weight(value)
        if size * 8 > self.room:
            return value  # a single piece may not fill the memory
        self.left -= size
        if self.left < 0:
            self.older = dict(self)
            self.clear()
            self.left = self.room - size
        self[piece] = value
        return value


_kept: dict[str, tuple[object, object]] = {}


def once_a_worker(kind: str, key: object, make: Callable[[], object]) -> object:
    """``make()``, kept for the later tasks of this Python worker; one value of each kind."""
    found = _kept.get(kind)
    if found is None or found[0] != key:
        found = _kept[kind] = (key, make())
    return found[1]


def slices(texts, limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of an Arrow column of texts, of ``limit`` bytes or a single row each."""
    import numpy as np
    import pyarrow.compute as pc

    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        before = int(ends[at - 1]) if at else 0
        until = max(int(np.searchsorted(ends, before + limit, "right")), at + 1)
        yield at, until
        at = until


def map_texts(
    docs: DataFrame, keep: tuple[str, ...], text: str, made: str, worker: Callable[[], Callable], limit: int = BATCH_BYTES
) -> DataFrame:
    """Columns ``keep`` with the columns ``made`` (DDL) that ``worker()`` returns, as Arrow arrays, for a list of texts.

    ``worker`` gets one argument, the list, NULL texts as None. Rows are taken in small batches, so that what a
    worker holds is bounded by one batch or one text.
    """
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("text"))
    schema = StructType([*rows.schema.fields[:-1], *StructType.fromDDL(made).fields])
    names = schema.names

    def run(batches):
        import pyarrow as pa

        work = worker()
        for batch in batches:
            for a, b in slices(batch.column(len(keep)), limit):
                part = batch.slice(a, b - a)
                columns = work(part.column(len(keep)).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *columns], names=names)

    return rows.mapInArrow(run, schema)


def number_lists(arrays: list):
    """Arrow column of lists of 32-bit numbers from one array for each row."""
    import numpy as np
    import pyarrow as pa

    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *arrays])))
