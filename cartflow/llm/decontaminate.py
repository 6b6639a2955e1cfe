"""Benchmark decontamination: one Aho-Corasick automaton over the word windows of all test items.

Texts and items are lower-cased (A-Z) and cut into words of ASCII letters, digits and any non-ASCII
characters. The automaton's symbols are words, so a text is scanned once, word by word, and hits
are mapped back to code points of the original text. NULL and blank texts have no words and no hits; items
without words are left out; the windows of items without an id hit like all others, but there is no id to list;
repeated items count once; repeated documents are judged one by one. Columns of the documents are carried along whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartflow.llm.common import materialize, table

WINDOW = 10
#: Words of items in one automaton: a window of ten words has at most ten nodes of some 60 bytes, so about 150 MB.
#: A larger benchmark or item is scanned in several blocks, one pass over the texts for each.
BLOCK_WORDS = 250_000

_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
_WORD = "[0-9A-Za-z\x80-\U0010ffff]+"
FIELDS = ("n_words", "n_hit", "runs", "items", "spans")
FOUND = (
    "struct<n_words:bigint,n_hit:bigint,runs:array<int>,items:array<string>,spans:array<struct<start:int,end:int>>>"
)


def item_words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_WORD_BYTES).split()


def item_blocks(
    items: DataFrame, id_col: str, text_col: str, limit: int, window: int = WINDOW
) -> Iterator[list[tuple[str | None, bytes]]]:
    """Items as (id, normalised words), in blocks of at most ``limit`` words (or one window); one block is held at a time.

    Items that do not fit are cut into pieces that overlap by all but one word of a window, so each of their windows lies
    in one piece.
    """
    limit = max(limit, window)
    rows = items.filter(F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("binary").alias("text")
    )
    block: list[tuple[str | None, bytes]] = []
    size = 0
    for row in rows.toLocalIterator():
        words = item_words(bytes(row["text"]))
        if block and size + len(words) > limit:
            yield block
            block, size = [], 0
        first = 0
        while len(words) - first > limit:
            yield [(row["id"], b" ".join(words[first : first + limit]))]
            first += limit - window + 1
        block.append((row["id"], b" ".join(words[first:])))
        size += len(words) - first
    if block:
        yield block


def build_automaton(block: list[tuple[str | None, bytes]], window: int) -> tuple[object, dict[bytes, int]]:
    """The automaton over word numbers, with ``(length, item ids)`` at each window, and the numbers of the words."""
    import ahocorasick

    numbers: dict[bytes, int] = {}
    owners: dict[tuple[int, ...], set[str]] = {}
    for item, text in block:
        words = [numbers.setdefault(w, len(numbers) + 1) for w in text.split()]
        for i in range(max(1, len(words) - window + 1)) if words else ():
            owners.setdefault(tuple(words[i : i + window]), set()).update([] if item is None else [item])
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for key, ids in owners.items():
        automaton.add_word(key, (len(key), sorted(ids)))
    if owners:
        automaton.make_automaton()
    return (automaton if owners else None), numbers


def scan(text: bytes | None, automaton, numbers: dict[bytes, int], runs: list[int], items: list[str]) -> dict:
    """Hits of one text joined with those of earlier blocks.

    ``runs`` holds first and last-plus-one word of each stretch of hit words, one after the other.
    """
    import re

    words = item_words(text)
    spans = list(zip(runs[::2], runs[1::2], strict=True))
    names = set(items)
    if automaton is not None and words:
        for last, (length, ids) in automaton.iter(tuple([numbers.get(w, 0) for w in words])):
            spans.append((last - length + 1, last + 1))
            names.update(ids)
    merged: list[list[int]] = []
    for first, end in sorted(spans):
        if merged and first <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([first, end])
    places = []
    if merged:
        at = [m.span() for m in re.finditer(_WORD, text.decode("utf-8", "replace"))]
        places = [{"start": at[first][0], "end": at[end - 1][1]} for first, end in merged]
    return {
        "n_words": len(words),
        "n_hit": sum(end - first for first, end in merged),
        "runs": [x for m in merged for x in m],
        "items": sorted(names),
        "spans": places,
    }


def _scanned_once(text: Column, found: Column, block) -> Column:
    """One block's scan; ``block`` is a broadcast dictionary, whose automaton is built once in each Python worker."""

    @F.arrow_udf(FOUND)
    def of_batch(texts, earlier):
        import pyarrow as pa

        held = block.value
        if "automaton" not in held:
            held["automaton"], held["numbers"] = build_automaton(held["items"], held["window"])
        rows = [
            scan(text, held["automaton"], held["numbers"], *((old["runs"], old["items"]) if old else ([], [])))
            for text, old in zip(texts.to_pylist(), earlier.to_pylist(), strict=True)
        ]
        span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(span)]
        return pa.array(rows, pa.struct(list(zip(FIELDS, kinds, strict=True))))

    return of_batch(text.cast("binary"), found)


def scanned(
    spark: SparkSession,
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``row`` (all columns of a document as a struct) and ``found`` for every document.

    ``found`` has ``n_words``, ``n_hit``, ``runs`` (first and end word of each hit stretch), ``items`` (ids of
    occurring items, sorted) and ``spans`` (code points of the hit stretches in the original text).
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.lit(None).cast(FOUND).alias("found")
    )
    passes = 0
    for items in item_blocks(benchmark, item_col, item_text_col, block_words, window):
        if passes:
            rows = materialize(spark, rows, "decontaminate")
        block = spark.sparkContext.broadcast({"items": items, "window": window})
        rows = rows.select("row", _scanned_once(F.col(f"row.`{text_col}`"), F.col("found"), block).alias("found"))
        passes += 1
    if not passes:
        block = spark.sparkContext.broadcast({"items": [], "window": window})
        rows = rows.select("row", _scanned_once(F.col(f"row.`{text_col}`"), F.col("found"), block).alias("found"))
    return rows


def clean_rows(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without any hit, with the columns they came with."""
    return scanned(spark, docs, benchmark).filter("found.n_hit = 0").select("row.*")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of all benchmark items in every document."""
    found = scanned(spark, table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "row.doc_id",
        "found.n_words",
        "found.n_hit",
        F.size("found.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
        (F.col("found.n_hit") > 0).alias("contaminated"),
    )


def oracle_sql() -> str:
    words = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
    return f"""
WITH item AS (SELECT item_id, {words} AS w FROM benchmark),
pattern AS (
  SELECT DISTINCT item_id, m, array_to_string(w[g:g + m - 1], ' ') AS k
  FROM (SELECT item_id, w, least({WINDOW}, len(w)) AS m, unnest(range(1, len(w) - least({WINDOW}, len(w)) + 2)) AS g
        FROM item WHERE len(w) > 0)),
doc AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
hit AS (
  SELECT r, g, p.m, p.item_id
  FROM (SELECT r, m, g, array_to_string(w[g:g + m - 1], ' ') AS k
        FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS g
              FROM doc, (SELECT DISTINCT m FROM pattern) WHERE len(w) >= m)) AS d
  JOIN pattern AS p ON p.m = d.m AND p.k = d.k),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(g, g + m)) AS p FROM hit) GROUP BY r),
named AS (
  SELECT r, count(*) AS n, string_agg(i, ',' ORDER BY encode(i)) AS ids
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS i FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(c.n, 0) AS n_hit, coalesce(i.n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered AS c USING (r) LEFT JOIN named AS i USING (r)
"""
