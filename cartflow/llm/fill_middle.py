"""Fill-in-middle transformation over a sparse exception index.

A text's bytes are searched for the places of its units; cuts are places between units. Only characters of more
than one byte are recorded: their position and the excess bytes up to them. A binary search in that short index
turns a byte cut into a code-point cut and back; text without such characters needs arithmetic only.

The cuts and the form of a text depend on its id alone, by four numbers of a digest, so a repeated run or a lost
executor changes nothing. Units are tokens (runs of ASCII letters and single other characters) or code points.

NULL texts count as empty and stay plain, as does a text that holds a sentinel: otherwise it could not be rebuilt.
A NULL id counts as the empty id. Repeated rows come out alike. Columns other than those asked for are not
carried, so their names can't clash. Texts are cut whole; memory is a few bytes for each byte of the text.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartflow.llm.common import table
from cartflow.llm.pieces import slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MADE = "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
#: Bytes whose unit starts are counted at once.
BLOCK = 1 << 20


class ExceptionIndex:
    """Places of the characters of more than one byte, and the excess bytes up to each."""

    def __init__(self, data) -> None:
        import numpy as np

        self.at = np.flatnonzero(data >= 0xC0)  # bytes that start such a character
        lead = data[self.at]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.excess = np.concatenate([[0], np.cumsum(excess)])  # of the characters before each, and of all
        self.character = self.at - self.excess[:-1]

    def to_character(self, byte: int) -> int:
        """The code point that starts at a byte."""
        return byte - int(self.excess[self.at.searchsorted(byte)]) if len(self.at) else byte

    def to_byte(self, character: int) -> int:
        """The byte at which a code point starts."""
        return character + int(self.excess[self.character.searchsorted(character)]) if len(self.at) else character


class Units:
    """Where the units of a text start."""

    def __init__(self, data) -> None:
        self.data = data
        self.counts = []
        for at in range(0, len(data), BLOCK):
            self.counts.append(int(self._starts(at).sum()))
        self.n = sum(self.counts)

    def _starts(self, at: int):
        """For each byte of a block, whether a unit starts there."""
        import numpy as np

        block = self.data[max(at - 1, 0) : at + BLOCK]
        letter = ((block | 0x20) - ord("a")) < 26  # unsigned, so what lies before "a" is large
        first = (block & 0xC0) != 0x80
        first[1:] &= ~(letter[1:] & letter[:-1])
        return first[1:] if at else first if len(block) else np.zeros(0, bool)

    def byte(self, k: int) -> int:
        """The byte where unit ``k`` starts, or the text ends."""
        import numpy as np

        for block, count in enumerate(self.counts):
            if k < count:
                return block * BLOCK + int(np.flatnonzero(self._starts(block * BLOCK))[k])
            k -= count
        return len(self.data)


def numbers(seed: str, key: object) -> list[int]:
    """Four unsigned 32-bit numbers of a digest of seed and key."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(digest[at : at + 8], 16) for at in range(0, 32, 8)]


class Transformer:
    """How texts are cut and put together again."""

    def __init__(self, seed: str = "1", rate: int = 90, spm_rate: int = 20, unit: str = "token") -> None:
        if unit not in ("token", "character"):
            raise ValueError(f"units are tokens or characters, not {unit!r}")
        self.seed, self.rate, self.spm_rate, self.unit = seed, rate, spm_rate, unit

    def apply(self, text: str, key: object) -> tuple[int, str, int | None, int | None, str]:
        """Number of units, form, code points of prefix and middle, output."""
        import numpy as np

        whole = text.encode()
        data = np.frombuffer(whole, np.uint8)
        h1, h2, h3, h4 = numbers(self.seed, key)
        index = None
        if self.unit == "token":
            units = Units(data)
            n = units.n
        else:
            n = len(text)
        if not text or h3 % 100 >= self.rate or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
            return n, "plain", None, None, text
        first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
        index = ExceptionIndex(data)
        if self.unit == "token":
            a, b = units.byte(first), units.byte(second)
            until_a, until_b = index.to_character(a), index.to_character(b)
        else:
            until_a, until_b = first, second
            a, b = index.to_byte(first), index.to_byte(second)
        prefix, middle, suffix = whole[:a].decode(), whole[a:b].decode(), whole[b:].decode()
        if h4 % 100 < self.spm_rate:
            form, output = "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
        else:
            form, output = "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
        return n, form, until_a, until_b - until_a, output


def transformed(docs: DataFrame, key: str = "doc_id", text: str = "text", how: Transformer | None = None) -> DataFrame:
    """Column ``key`` with ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output`` of every row."""
    how = Transformer() if how is None else how
    rows = docs.select(F.col(f"`{key}`"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema[key].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
        for batch in batches:
            for a, b in slices(batch.column(1)):
                keys, texts = batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a).to_pylist()
                found = [how.apply(t or "", k) for t, k in zip(texts, keys.to_pylist(), strict=True)]
                columns = [pa.array([row[i] for row in found], types[i]) for i in range(5)]
                names = ["key", "n", "form", "prefix_chars", "middle_chars", "output"]
                yield pa.RecordBatch.from_arrays([keys, *columns], names=names)

    return rows.mapInArrow(run, f"key {kind}, {MADE}").withColumnRenamed("key", key)


def restored(output: Column, form: Column) -> Column:
    """The text from which an output of this form was made."""
    parts = F.split(output, "<[PSM]>", -1)
    prefix_first = F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2)))
    suffix_first = F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1)))
    return F.when(form == "psm", prefix_first).when(form == "spm", suffix_first).otherwise(output)


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's form and cuts, with digests of its output and of the text rebuilt from it."""
    rows = transformed(table(spark, sf_dir, "documents"))
    back = restored(F.col("output"), F.col("form"))
    return rows.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(back.cast("binary"), 256).alias("restored_sha256"),
    )


def oracle_sql() -> str:
    return """
        WITH split AS (
            SELECT doc_id, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
                   sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
            FROM documents
        ), drawn AS (
            SELECT doc_id, text, units, len(units) AS n,
                   CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
                   CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
            FROM split
        ), cuts AS (
            SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                             OR h3 % 100 >= 90 THEN 'plain'
                        WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
            FROM drawn
        ), parts AS (
            SELECT doc_id, text, n, form, array_to_string(units[1:a], '') AS prefix,
                   array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:], '') AS suffix
            FROM cuts
        ), outputs AS (
            SELECT *, CASE form WHEN 'plain' THEN text
                                WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                                ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END AS output
            FROM parts
        )
        SELECT doc_id, CAST(n AS BIGINT) AS n, form,
               CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
               sha256(output) AS output_sha256, sha256(text) AS restored_sha256
        FROM outputs
    """
