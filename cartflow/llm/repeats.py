"""Substring dedup: words in 13-word windows that also start in an earlier document are removed.

1. *Sketch.* The anchor of a window is the smallest hash of its 8-word parts: equal windows have equal anchors, and
   neighbours mostly share one, so a text has about two anchors for seven windows. Every task counts the anchors of its
   texts (once for each document) in the cells of a count-min sketch and sends only the touched cells, as gaps. The parts
   are merged by cell range. Counts are only ever too high, so the anchor of every window of two documents has an
   estimate of two or more.
2. *Exact groups.* Windows whose anchor is estimated repeated are grouped by their anchor and a 64-bit hash of their word sequence. A
   chunk of texts groups its own windows first and sends each of them once, with the smallest id;
   so a window in a third of all documents costs one row for each chunk, not for each document; so do rows equal in id
   and text. Windows are dealt out by their anchors: equal windows meet, and neighbours mostly travel together in one row.
   They are sorted by anchor and id, so the first row with a window has the smallest id, and a task holds the windows of one
   batch and those seen of one anchor. Rows whose anchor turns out to be in one document only are not taken apart into windows.
3. *Removal.* Runs of places to remove are gathered by document, which is an id and a 64-bit hash of the text, and cut out
   of the whole text.

The merged sketch is broadcast. Its cells grow with the text up to ``MAX_CELLS`` a row (a bit each, so
64 MB a row at most); beyond, estimates get too high and more anchors are compared exactly, but none is lost.

Windows are judged on the input. NULL and blank texts have no words; texts of fewer words than a
window keep them all. Documents with equal ids are not smaller than each other; a NULL id is greater
than every other id. Repeated rows are each judged and returned.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartflow.llm.common import materialize, table

WINDOW = 13
#: Words of the parts whose smallest hash is the anchor of a window. Longer parts are rarer, but anchors are then more.
ANCHOR = 8
ROWS = 2
#: Cells of a row for each byte of text, about four for each anchor, and their bound.
CELLS_PER_BYTE = 3 / 16
MAX_CELLS = 1 << 29
#: Cells of one part of the sketch: the unit that is sent and merged.
PART = 1 << 20
#: Anchors held by a task before it counts them, and windows estimated repeated before it groups them.
CHUNK = 1 << 20
CANDIDATE_CHUNK = 1 << 20
#: Windows of a batch of candidates that a task sends on.
SENT = 1 << 16
#: Runs to remove held by a task, at least, before it sends them on in a row for each document. Few, as a task holds few runs of
#: one document: with many, rows would grow with documents times tasks.
RUNS = 1 << 12
#: Words hashed at once.
SLICE_WORDS = 1 << 18
LAST_ID = (1 << 63) - 1
#: Odd multipliers, fixed values: a set each for the window hash, the rows of the sketch and the anchors.
_SEED = 0x9E3779B97F4A7C15


def _multipliers(count: int, salt: int):
    import numpy as np

    return np.array([(_SEED * (2 * (i + 64 * salt) + 1) ** 3 + 2 * i) % (1 << 64) | 1 for i in range(count)], np.uint64)


def _mixed(values):
    """Well mixed 64-bit values; changes its argument."""
    import numpy as np

    values ^= values >> np.uint64(32)
    values *= np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    return values


def anchored(texts: Iterable[bytes | None], window: int) -> Iterator[tuple]:
    """For slices of ``texts``: text number, first word and anchor of each window, and a function to hash chosen windows."""
    import numpy as np
    import xxhash

    def of_slice(words: list[bytes], counts: list[int], first_text: int) -> tuple:
        h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        n = max(0, len(words) - window + 1)
        ends = np.cumsum(counts)
        starts = ends - counts
        numbers = np.repeat(np.arange(len(counts)), counts)
        place = np.arange(n)
        whole = place + window <= ends[numbers[:n]]
        numbers, place = numbers[:n][whole], place[whole]
        size = min(ANCHOR, window)
        parts = np.zeros(max(0, len(words) - size + 1), np.uint64)
        for j, factor in enumerate(_multipliers(size, 3)):
            parts += h[j : j + len(parts)] * factor
        _mixed(parts)
        least = parts[:n].copy()
        for j in range(1, window - size + 1):
            np.minimum(least, parts[j : j + n], out=least)

        first_word = place

        def hashes(chosen):
            at = first_word[chosen]
            total = np.zeros(len(at), np.uint64)
            for j, factor in enumerate(_multipliers(window, 0)):
                total += h[j:][at] * factor
            return _mixed(total)

        return numbers + first_text, (place - starts[numbers]).astype(np.int32), least[whole], hashes

    words: list[bytes] = []
    counts: list[int] = []
    first = 0
    for i, text in enumerate(texts):
        own = (text or b"").split()  # for bytes: ASCII white space only
        words += own
        counts.append(len(own))
        if len(words) >= SLICE_WORDS:
            yield of_slice(words, counts, first)
            words, counts, first = [], [], i + 1
    if words:
        yield of_slice(words, counts, first)


def _runs(number, anchor):
    """Where a stretch of windows of one text with one anchor begins, as a mask."""
    import numpy as np

    begins = np.ones(len(anchor), bool)
    begins[1:] = (anchor[1:] != anchor[:-1]) | (number[1:] != number[:-1])
    return begins


def sketch_cells(hashes, cells: int) -> list:
    """The cell of each hash in each row of a sketch with ``cells`` (fewer than 2**32) in a row."""
    import numpy as np

    half = np.uint64(32)
    return [((_mixed(hashes * m) >> half) * np.uint64(cells) >> half).astype(np.int64) for m in _multipliers(ROWS, 2)]


def _columns(held: list[tuple]) -> list:
    """Parts joined column by column; empties ``held``, so that little is held twice."""
    import numpy as np

    columns = [list(parts) for parts in zip(*held, strict=True)]
    held.clear()
    for i, parts in enumerate(columns):
        columns[i] = np.concatenate(parts)
        parts.clear()
    return columns


def _reordered(columns: list, order) -> list:
    """The columns by ``order`` (places or a mask), changed one after the other."""
    for i in range(len(columns)):
        columns[i] = columns[i][order]
    return columns


def encode_gaps(places) -> bytes:
    """Ascending places as gaps in bytes; 255 adds to the next byte."""
    import numpy as np

    gaps = np.diff(places, prepend=0)
    ends = np.cumsum(gaps // 255 + 1) - 1
    out = np.full(ends[-1] + 1, 255, np.uint8)
    out[ends] = gaps % 255
    return out.tobytes()


def decode_gaps(data: bytes):
    import numpy as np

    gaps = np.frombuffer(data, np.uint8)
    return np.cumsum(gaps, dtype=np.int64)[gaps != 255]


def _lists(batches, *columns: str) -> Iterator[list[list]]:
    for batch in batches:
        yield [batch.column(c).to_pylist() for c in columns]


def _texts(batch) -> Iterator[bytes | None]:
    """Texts one by one, so that a batch is not held twice."""
    return (text.as_py() for text in batch.column("text"))


def _sketch_parts(cells: int, window: int):
    def parts(batches):
        import numpy as np
        import pyarrow as pa

        def counted(held: list[tuple]):
            columns = _columns(held)
            number, value = _reordered(columns, np.lexsort(columns))
            once = np.ones(len(value), bool)
            once[1:] = (value[1:] != value[:-1]) | (number[1:] != number[:-1])
            value = value[once]
            columns.clear()
            del number, once
            ids, data = [], []
            for row, places in enumerate(sketch_cells(value, cells)):
                places.sort()
                thrice = np.zeros(len(places), bool)
                thrice[2:] = places[2:] == places[:-2]
                places = places[~thrice]  # counts over two tell nothing more
                part = places // PART
                cuts = np.flatnonzero(np.diff(part)) + 1
                for chunk in np.split(places, cuts):
                    ids.append(row * (cells // PART or 1) + int(chunk[0] // PART))
                    data.append(encode_gaps(chunk % PART))
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(data, pa.binary())], ["part", "gaps"])

        held, size, seen = [], 0, 0
        for batch in batches:
            for number, _, anchor, _ in anchored(_texts(batch), window):
                begins = _runs(number, anchor)
                held.append((number[begins] + seen, anchor[begins]))
                size += len(held[-1][1])
                if size >= CHUNK:
                    yield counted(held)  # which empties it
                    size = 0
            seen += batch.num_rows
        if size:
            yield counted(held)

    return parts


def _merge_parts(batches):
    """Of each part, in order, the bits of cells counted twice or more."""
    import numpy as np
    import pyarrow as pa

    def row(part, twice):
        bits = np.packbits(twice, bitorder="little").tobytes()
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([bits], pa.binary())], ["part", "bits"])

    current, once, twice = None, np.zeros(PART, bool), np.zeros(PART, bool)
    for parts, gaps in _lists(batches, "part", "gaps"):
        for part, data in zip(parts, gaps, strict=True):
            if part != current:
                if current is not None:
                    yield row(current, twice)
                current = part
                once[:] = False
                twice[:] = False
            places = decode_gaps(data)
            twice[places[1:][places[1:] == places[:-1]]] = True
            twice[places[once[places]]] = True
            once[places] = True
    if current is not None:
        yield row(current, twice)


def sketch_size(text_bytes: int, max_cells: int = MAX_CELLS) -> int:
    """Cells of a row, in proportion to the text: whole parts, at least one and at most ``max_cells``."""
    return min(max_cells // PART, int(text_bytes * CELLS_PER_BYTE) // PART + 1) * PART


def repeated_cells(spark: SparkSession, docs: DataFrame, cells: int, window: int):
    """Bits of the merged sketch, row after row; ``ROWS * cells / 8`` bytes at most."""
    import numpy as np

    parts = docs.select("text").mapInArrow(_sketch_parts(cells, window), "part bigint, gaps binary")
    merged = parts.repartition("part").sortWithinPartitions("part").mapInArrow(_merge_parts, "part bigint, bits binary")
    bits = np.zeros(ROWS * cells // 8, np.uint8)
    for row in materialize(spark, merged, "repeats-sketch").toLocalIterator():
        at = row["part"] * PART // 8
        bits[at : at + PART // 8] = np.frombuffer(row["bits"], np.uint8)
    return bits


_CANDIDATES = "deal bigint, own boolean, id bigint, tag bigint, place int, highs binary, places binary"


def _candidates(bits, cells: int, window: int):
    """Windows whose anchor is estimated repeated, each of a chunk once, with the smallest id it has there.

    A row holds neighbouring windows of a document that are dealt out alike, from ``place`` on. Places in documents
    with greater ids are removed for certain and are sent as one ``own`` row for each document.
    """

    def candidates(batches):
        import numpy as np
        import pyarrow as pa

        sketch = np.frombuffer(bits.value, np.uint8)

        def repeated(value):
            found = np.ones(len(value), bool)
            for row, cell in enumerate(sketch_cells(value, cells)):
                cell += row * cells
                found &= (sketch[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1
            return found

        def grouped(held: list[tuple], documents: list[tuple]):
            ids, tags = (np.concatenate(parts) for parts in zip(*documents, strict=True))
            order = np.lexsort((tags, ids))
            ids, tags = ids[order], tags[order]
            differs = np.ones(len(ids), bool)
            differs[1:] = (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1])
            rank = np.empty(len(ids), np.int32)  # of a document by id and text; rows equal in both share it
            rank[order] = np.cumsum(differs) - 1
            ids, tags = ids[differs], tags[differs]

            columns = _columns(held)
            columns[2] = rank[columns[2]]
            high, deal, document, place = _reordered(columns, np.lexsort([columns[i] for i in (3, 2, 1, 0)]))
            once = np.ones(len(high), bool)  # rows equal in id and text have the same windows
            once[1:] = (high[1:] != high[:-1]) | (deal[1:] != deal[:-1])
            once[1:] |= (document[1:] != document[:-1]) | (place[1:] != place[:-1])
            del high, deal, document, place
            high, deal, document, place = _reordered(columns, once)
            columns.clear()
            starts = np.ones(len(high), bool)
            starts[1:] = (high[1:] != high[:-1]) | (deal[1:] != deal[:-1])
            group = np.cumsum(starts, dtype=np.int32) - 1
            later = ids[document] > ids[document[starts]][group]
            del starts, group
            own = document[later], place[later]
            first = np.flatnonzero(~later)
            del later
            first = first[np.lexsort((place[first], document[first]))]
            columns = [high, deal, document, place]
            del high, deal, document, place
            high, deal, document, place = _reordered(columns, first)
            columns.clear()
            del first
            run = np.ones(len(high), bool)
            run[1:] = (np.diff(place) != 1) | (document[1:] != document[:-1]) | (deal[1:] != deal[:-1])
            heads = np.append(np.flatnonzero(run), len(high))
            del run
            at = 0
            while at < len(heads) - 1:  # whole rows, so that neither side holds all of a chunk once more
                until = max(at + 1, int(np.searchsorted(heads, heads[at] + SENT, "right")) - 1)
                of, sent = heads[at:until], slice(heads[at], heads[until])
                ends = pa.array((heads[at : until + 1] - heads[at]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(deal[of].view(np.int64)),
                        pa.array(np.zeros(len(of), bool)),
                        pa.array(ids[document[of]]),
                        pa.array(tags[document[of]]),
                        pa.array(place[of]),
                        pa.ListArray.from_arrays(ends, pa.array(high[sent].view(np.int64))),
                        pa.nulls(len(of), pa.binary()),
                    ],
                    names,
                )
                at = until
            del high, deal, document, place, heads
            document, place = own
            if len(document):
                order = np.lexsort((place, document))
                document, place = document[order], place[order]
                firsts = np.concatenate(([0], np.flatnonzero(np.diff(document)) + 1))
                data = [x.astype("<i4").tobytes() for x in np.split(place, firsts[1:])]
                ids, tags = ids[document[firsts]], tags[document[firsts]]
                n = len(firsts)
                none = pa.array(np.zeros(n + 1, np.int32))
                columns = [
                    pa.array(ids ^ tags),  # documents without an id are many
                    pa.array(np.ones(n, bool)),
                    pa.array(ids),
                    pa.array(tags),
                    pa.nulls(n, pa.int32()),
                    pa.ListArray.from_arrays(none, pa.array([], pa.int64())),
                    pa.array(data, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

        names = ["deal", "own", "id", "tag", "place", "highs", "places"]
        held, size, documents, known = [], 0, [], 0
        for batch in batches:
            if not held:
                documents, known = [], 0
            documents.append((batch.column("id").to_numpy(), batch.column("tag").to_numpy()))
            for number, place, anchor, hashes in anchored(_texts(batch), window):
                begins = _runs(number, anchor)
                keep = np.flatnonzero(repeated(anchor[begins])[np.cumsum(begins) - 1])
                number = (number[keep] + known).astype(np.int32)
                held.append((hashes(keep), anchor[keep], number, place[keep]))
                size += len(number)
                if size >= CANDIDATE_CHUNK:
                    yield from grouped(held, documents)  # which empties the windows
                    size, documents, known = 0, documents[-1:], 0
            known += batch.num_rows
        if size:
            yield from grouped(held, documents)

    return candidates


def _sent(candidates):
    """``candidates`` with each list of hashes as bytes, which Spark moves in one piece."""

    def sent(batches):
        import numpy as np
        import pyarrow as pa

        for batch in candidates(batches):
            highs = batch.column("highs")
            ends = np.ascontiguousarray(highs.offsets.to_numpy() * 8)
            data = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(highs.values.to_numpy())]
            packed = pa.BinaryArray.from_buffers(pa.binary(), len(highs), data)
            yield batch.set_column(batch.schema.get_field_index("highs"), "highs", packed)

    return sent


def _unpacked(column, kind):
    """All values of a column of bytes, and how many each row has; NULL has none."""
    import numpy as np
    import pyarrow as pa

    column = column.cast(pa.binary())
    data, ends = column.buffers()[2], np.frombuffer(column.buffers()[1], np.int32)
    ends = ends[column.offset : column.offset + len(column) + 1]
    values = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data else np.zeros(0, np.uint8)
    return values.view(kind), np.diff(ends) // np.dtype(kind).itemsize


_RUNS = "id bigint, tag bigint, runs binary"


def _later(batches):
    """Of candidates sorted by ``deal`` and id, the runs of windows (first place and length) that an earlier document has."""
    import numpy as np
    import pyarrow as pa

    held = []
    at_end = None  # the last deal with its windows and their smallest ids, as its rows may go on in the next batch

    def sent():
        ids, tags, starts, lengths = _columns(held)
        order = np.lexsort((starts, tags, ids))
        ids, tags, runs = ids[order], tags[order], np.stack((starts[order], lengths[order]), axis=1).astype("<i4")
        firsts = np.flatnonzero(np.concatenate(([True], (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1]))))
        ends = (np.append(firsts, len(ids)) * 8).astype(np.int32)
        data = pa.BinaryArray.from_buffers(pa.binary(), len(firsts), [None, pa.py_buffer(ends), pa.py_buffer(runs.tobytes())])
        return pa.RecordBatch.from_arrays([pa.array(ids[firsts]), pa.array(tags[firsts]), data], ["id", "tag", "runs"])

    def hold(rows, places):
        """Places of rows, ascending in each, as runs."""
        if len(places):
            begins = np.ones(len(places), bool)
            begins[1:] = (rows[1:] != rows[:-1]) | (places[1:] != places[:-1] + 1)
            at = np.flatnonzero(begins)
            held.append((ids[rows[at]], tags[rows[at]], places[at], np.diff(np.append(at, len(places)))))

    for batch in batches:
        deals, ids, tags = (batch.column(c).to_numpy() for c in ("deal", "id", "tag"))
        own, counts = _unpacked(batch.column("places"), "<i4")
        hold(np.repeat(np.arange(len(counts)), counts), own)
        highs, counts = _unpacked(batch.column("highs"), np.uint64)
        rows = np.flatnonzero(counts)
        if len(rows):
            of, last = deals[rows], deals[rows[-1]]
            starts = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
            ends = np.append(starts[1:], len(of))
            shared = ids[rows[starts]] < ids[rows[ends - 1]]
            shared[-1] = True  # it may go on
            goes_on = at_end is not None and at_end[0] == of[0]
            shared[0] |= goes_on
            keep = np.zeros(len(counts), bool)
            keep[rows[np.repeat(shared, ends - starts)]] = True
            row = np.repeat(np.arange(len(counts)), counts)
            place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            place += batch.column("place").fill_null(0).to_numpy()[row]
            keep = keep[row]
            row, place, high = row[keep], place[keep], highs[keep]
            deal, least = deals[row], ids[row]
            seen = len(at_end[1]) if goes_on else 0
            if seen:
                deal = np.concatenate((np.full(seen, of[0]), deal))
                high, least = np.concatenate((at_end[1], high)), np.concatenate((at_end[2], least))
            order = np.lexsort((least, high, deal))
            deal, high, least = deal[order], high[order], least[order]
            begins = np.ones(len(order), bool)
            begins[1:] = (deal[1:] != deal[:-1]) | (high[1:] != high[:-1])
            later = order[least > least[begins][np.cumsum(begins) - 1]]
            later = np.sort(later[later >= seen]) - seen
            hold(row[later], place[later])
            begins &= deal == last
            at_end = last, high[begins], least[begins]
        if sum(len(part[0]) for part in held) >= RUNS:
            yield sent()  # which empties it
    if held:
        yield sent()


def _cut(window: int):
    @F.arrow_udf("struct<n_words:bigint,n_removed:bigint,kept_text:string>")
    def of_batch(texts, found):
        import numpy as np
        import pyarrow as pa
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        counts, removed, kept = [], [], []
        for text, runs in zip(texts.to_pylist(), found.to_pylist(), strict=True):
            words = unpack(text, max_output_size=1 << 31).split() if text else []
            starts, lengths = np.frombuffer(b"".join(runs or ()), "<i4").reshape(-1, 2).T
            edge = np.zeros(len(words) + 1, np.int64)
            np.add.at(edge, starts, 1)
            np.add.at(edge, starts + lengths + (window - 1), -1)
            gone = np.cumsum(edge)[: len(words)] > 0
            if gone.any():
                words = [words[i] for i in np.flatnonzero(~gone)]
            counts.append(len(gone))
            removed.append(int(gone.sum()))
            kept.append(b" ".join(words).decode("utf-8", "replace"))
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
            ["n_words", "n_removed", "kept_text"],
        )

    return of_batch


def _packed():
    """Compresses texts, which halves the bytes of their shuffle."""

    @F.arrow_udf("binary")
    def of_batch(texts):
        import pyarrow as pa
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        return pa.array([pack(t) if (t := text.as_py()) else None for text in texts], pa.binary())

    return of_batch


def without_repeats(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    max_cells: int = MAX_CELLS,
) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_text)`` of every row; kept words are joined by single blanks."""
    text = F.col(text_col).cast("binary")
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST_ID)).alias("id"),
        # Rows of one id may have different texts, and all rows without an id share one.
        F.xxhash64(text).alias("tag"),
        text.alias("text"),
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cells = sketch_size(size, max_cells)
    # As bytes, which a worker reads once and uses in place; an array would be held twice while it is unpacked.
    bits = spark.sparkContext.broadcast(repeated_cells(spark, rows, cells, window).tobytes())
    windows = rows.select("id", "tag", "text").mapInArrow(_sent(_candidates(bits, cells, window)), _CANDIDATES)
    # Equal windows are dealt out alike. A group has a row for each chunk at most.
    dealt = windows.repartition("deal").sortWithinPartitions("deal", "id")
    places = dealt.mapInArrow(_later, _RUNS).groupBy("id", "tag").agg(F.collect_list("runs").alias("runs"))
    texts = rows.select("doc_id", "id", "tag", _packed()("text").alias("text"))
    found = texts.join(places, ["id", "tag"], "left").select("doc_id", _cut(window)("text", "runs").alias("f"))
    return found.select("doc_id", "f.n_words", "f.n_removed", "f.kept_text")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removed words and what is left of every document."""
    found = without_repeats(spark, table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def oracle_sql() -> str:
    return rf"""
WITH doc AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
windows AS (
  SELECT r, doc_id, g, array_to_string(w[g:g + {WINDOW - 1}], ' ') AS k
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS g FROM doc)),
later AS (
  SELECT r, g FROM (SELECT r, g, doc_id, min(doc_id) OVER (PARTITION BY k) AS first FROM windows)
  WHERE first < coalesce(doc_id, {LAST_ID})),
gone AS (SELECT r, list(DISTINCT p) AS ps FROM (SELECT r, unnest(range(g, g + {WINDOW})) AS p FROM later) GROUP BY r),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY p) AS t
  FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM doc) AS x
  WHERE NOT EXISTS (SELECT 1 FROM (SELECT r, unnest(ps) AS p FROM gone) AS y WHERE y.r = x.r AND y.p = x.p)
  GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(len(ps), 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM doc LEFT JOIN gone USING (r) LEFT JOIN kept USING (r)
"""
