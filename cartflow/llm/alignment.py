"""Cross-tokenizer alignment: two tokenizations of a text meet where tokens of both end at the same byte.

For each text the cumulative byte ends of both id lists become dictionaries from end to index. The intersection of
their keys, sorted, cuts both lists into slices, the groups. In each slice the links are expanded: all pairs of
occurrences that end at the slice's end. No token is empty, so these are the two last tokens of the slice.

Of two tokens that end together in one text the shorter is a suffix of the longer. So the id pairs that can be linked are known
from the vocabularies alone (some 10^5 pairs): links are kept as places in that list, and the corpus-wide counts
are at most one number for each place. They are summed with a map-side step and broadcast, whatever the input's size.

Neither tokenizer has a token that goes on over white space behind another character, or over a mark of punctuation behind a
letter or digit. So tokens of both lists end there, texts are cut there, and equal stretches are aligned once: a worker
keeps those it has met, up to a bound in bytes, and aligns those that are new in a batch of texts together. If a vocabulary has
such a token, or a text has characters beyond U+0300, the text is aligned whole.

Three passes, so that no text is encoded twice: encode and slice, written to the shared folder with one small number
for each link; count the pairs; look the counts up.

A text that is NULL or empty, or whose joined bytes of either side differ from its own (the piece tokenizer folds
some characters), has no tokens: all its numbers are zero and its groups are empty. Repeated rows count once each.
Empty tables have no rows and no counts. Columns other than those asked for are not carried, so their names can't clash.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable
from itertools import accumulate, chain
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartflow.llm.byte_bpe import byte_table
from cartflow.llm.common import materialize, table
from cartflow.llm.pieces import Splitter, is_latin, latin_class, map_texts, once_a_worker

LEFT = "byte_bpe_50k.json"
RIGHT = "piece_bpe_32k.model"
#: Bytes of stretches a worker remembers, in each of two generations.
ROOM = 40 << 20
#: Bytes of texts that are aligned together.
TEXT_BYTES = 2 << 20
#: Merged into a piece model, this turns off the blank that it puts before each text: the normalizer's settings
#: (field 3) with only their third field. Blanks are then put by whoever encodes.
NO_BLANK = bytes([3 << 3 | 2, 2, 3 << 3, 0])
MADE = "n_a bigint, n_b bigint, n_groups bigint, groups string, links binary"


class ByteLevel:
    """A byte-level BPE tokenizer file at work."""

    def __init__(self, settings: str, pattern: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(settings)
        self.library.encode_special_tokens = True  # their strings in a text are plain text
        self.merge = self.library.model.tokenize
        self.characters = dict(enumerate(byte_table()))
        self.split = Splitter(pattern).latin

    def encode(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def encode_latin(self, text: str) -> list[int]:
        """The same for a short Latin text: its pieces merged one by one."""
        merge, characters = self.merge, self.characters
        return [
            token.id for piece in self.split(text) for token in merge(piece.encode().decode("latin-1").translate(characters))
        ]


def byte_level_tokens(settings: str) -> list[bytes]:
    """The bytes of each token of a byte-level tokenizer file, by id."""
    import json

    stated = json.loads(settings)
    back = {c: b for b, c in enumerate(byte_table())}
    names = {token["id"]: token["content"].encode() for token in stated["added_tokens"]}
    names |= {i: bytes(map(back.__getitem__, name)) for name, i in stated["model"]["vocab"].items()}
    return [names.get(i, b"") for i in range(max(names) + 1)]


def piece_tokens(model: bytes) -> list[bytes]:
    """The bytes of each piece of a sentence-piece model, by id; control pieces, which no text makes, have none."""
    import sentencepiece

    known = sentencepiece.SentencePieceProcessor(model_proto=model)
    found = []
    for i in range(known.get_piece_size()):
        piece = known.id_to_piece(i)
        if known.is_byte(i):
            found.append(bytes([int(piece[1:-1], 16)]))
        else:
            found.append(b"" if known.is_control(i) or known.is_unknown(i) else piece.replace("▁", " ").encode())
    return found


def linkable_pairs(left: list[bytes], right: list[bytes]):
    """Sorted codes ``a * len(right) + b`` of all id pairs of which one token is a suffix of the other."""
    import numpy as np

    def by_bytes(tokens):
        found: dict[bytes, list[int]] = {}
        for i, token in enumerate(tokens):
            if token:
                found.setdefault(token, []).append(i)
        return found

    codes, size = set(), len(right)
    of_left, of_right = by_bytes(left), by_bytes(right)
    for token, ids in of_left.items():
        for at in range(len(token)):
            codes.update(a * size + b for b in of_right.get(token[at:], ()) for a in ids)
    for token, ids in of_right.items():
        for at in range(len(token)):
            codes.update(a * size + b for a in of_left.get(token[at:], ()) for b in ids)
    return np.array(sorted(codes), np.int64)


def ends(ids: list[int], sizes) -> dict[int, int]:
    """From the byte where a token ends to its index, counted from one."""
    return dict(zip(accumulate(map(sizes.__getitem__, ids)), range(1, len(ids) + 1), strict=True))


def sliced(left: dict[int, int], right: dict[int, int]) -> tuple[list[int], list[int]]:
    """Indices, end exclusive, up to which the two lists are cut: one of each for every common end, in order."""
    common = sorted(left.keys() & right.keys())
    return list(map(left.__getitem__, common)), list(map(right.__getitem__, common))


#: A Latin text, cut before each blank, line end or tab that stands behind a character that is no white space, and before
#: each mark that stands behind a letter or digit.
stretches = re.compile(
    rf"(?s).(?:[^ \t\n.,;:!?]++|(?<=[{latin_class('s')}])[ \t\n]|(?<![{latin_class('L')}0-9])[.,;:!?])*+"
).findall


class Vocabularies:
    """What is broadcast: both tokenizers and the pairs of their ids that can be linked."""

    def __init__(self, left: str, pattern: str, right: bytes) -> None:
        self.left, self.pattern, self.right = left, pattern, right
        self.left_tokens, self.right_tokens = byte_level_tokens(left), piece_tokens(right)
        self.pairs = linkable_pairs(self.left_tokens, self.right_tokens)
        # The left one splits texts by a pattern that begins a new piece at each cut; its tokens show that.
        tokens = [t.decode("utf-8", "replace") for t in (*self.left_tokens, *self.right_tokens)]
        self.local = not any(len(stretches(t)) > 1 for t in tokens)

    def right_of_pairs(self):
        return self.pairs % len(self.right_tokens)


def default_vocabularies() -> Vocabularies:
    import public_tokenizers

    with open(public_tokenizers.path(LEFT), encoding="utf-8") as left, open(public_tokenizers.path(RIGHT), "rb") as right:
        return Vocabularies(left.read(), public_tokenizers.PATTERN, right.read())


class Aligned(NamedTuple):
    """Token counts, number of groups, the groups as text, links as 32-bit places in the list of pairs."""

    n_a: int
    n_b: int
    n_groups: int
    groups: str
    links: bytes


NOTHING = Aligned(0, 0, 0, "", b"")
#: What is remembered of a stretch: both token counts in one number, groups, links (one for each group).
Part = tuple[int, str, bytes]
_HALF = 32


def _unpacked(part: Part) -> Aligned:
    counts, groups, links = part
    return Aligned(counts & ((1 << _HALF) - 1), counts >> _HALF, len(links) // 4, groups, links)


class Aligner:
    """Aligns texts in one process."""

    def __init__(self, known: Vocabularies, room: int = ROOM) -> None:
        import numpy as np
        import sentencepiece

        self.left = ByteLevel(known.left, known.pattern)
        self.right = sentencepiece.SentencePieceProcessor(model_proto=known.right + NO_BLANK)
        self.tokens = known.left_tokens, known.right_tokens
        self.sizes = tuple(array("i", map(len, tokens)) for tokens in self.tokens)
        self.names = tuple(list(map(str, range(len(tokens)))) for tokens in self.tokens)
        # Names with what follows them: within their half of a group, and at the end of the half.
        self.within = tuple(np.array([f"{n}," for n in names], object) for names in self.names)
        self.last = tuple(np.array([n + end for n in names], object) for names, end in zip(self.names, "|;", strict=True))
        self.pairs = known.pairs
        self.local = known.local
        # Two generations of ``room`` bytes each: what the older one is asked for moves on.
        self.newer: dict[str, Part | None] = {}
        self.older: dict[str, Part | None] = {}
        self.room = self.free = room

    def whole(self, spaced: str) -> Aligned | None:
        """A stretch, or a text behind a blank; None if its bytes are not those of both id lists."""
        return self.together([spaced], [self.left.encode(spaced)], [self.right.encode(spaced, num_threads=1)])[0]

    def together(self, stretches: list[str], a_lists: list[list[int]], b_lists: list[list[int]]) -> list[Aligned | None]:
        """Stretches aligned as one text: wherever one ends, tokens of both sides do."""
        return [None if part is None else _unpacked(part) for part in self._parts(stretches, a_lists, b_lists)]

    def _parts(self, stretches: list[str], a_lists: list[list[int]], b_lists: list[list[int]]) -> list[Part | None]:
        import numpy as np

        a, b = list(chain.from_iterable(a_lists)), list(chain.from_iterable(b_lists))
        data = "".join(stretches).encode()
        if any(b"".join(map(tokens.__getitem__, ids)) != data for tokens, ids in zip(self.tokens, (a, b), strict=True)):
            # Some stretch differs from one of its lists.
            if len(stretches) == 1:
                return [None]
            return [x for one in zip(stretches, a_lists, b_lists, strict=True) for x in self._parts(*([part] for part in one))]
        a_ends, b_ends = ends(a, self.sizes[0]), ends(b, self.sizes[1])
        a_cuts, b_cuts = (np.array(cuts, np.int64) for cuts in sliced(a_ends, b_ends))
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        # Only the last tokens of a slice end at its end.
        links = np.searchsorted(self.pairs, a[a_cuts - 1] * len(self.tokens[1]) + b[b_cuts - 1]).astype("<i4")
        names = np.empty(len(a) + len(b), object)
        a_names, b_names = self.within[0][a], self.within[1][b]
        a_names[a_cuts - 1], b_names[b_cuts - 1] = self.last[0][a[a_cuts - 1]], self.last[1][b[b_cuts - 1]]
        # A name stands behind those of all earlier slices, and one of the right behind those of the left.
        names[np.arange(len(a)) + np.repeat(b_cuts - np.diff(b_cuts, prepend=0), np.diff(a_cuts, prepend=0))] = a_names
        names[np.arange(len(b)) + np.repeat(a_cuts, np.diff(b_cuts, prepend=0))] = b_names
        names, links = names.tolist(), links.tobytes()
        # Where each stretch ends: in both lists, and in the slices.
        a_sizes, b_sizes = list(map(len, a_lists)), list(map(len, b_lists))
        slices = np.searchsorted(a_cuts, np.cumsum(a_sizes), "right").tolist()
        made, at, first = [], 0, 0
        for n_a, n_b, end in zip(a_sizes, b_sizes, slices, strict=True):
            text = "".join(names[at : at + n_a + n_b])[:-1]
            made.append((n_a | n_b << _HALF, text, links[4 * first : 4 * end]))
            at, first = at + n_a + n_b, end
        return made

    def align(self, texts: list[str]) -> list[Aligned]:
        """A batch of texts."""
        cut = [stretches(" " + text) if text and self.local and is_latin(text) else None for text in texts]
        learned = self._learn(set(chain.from_iterable(filter(None, cut))))
        found = [self._joined(text, own) for text, own in zip(texts, cut, strict=True)]
        for stretch in learned:
            if len(stretch) * 100 > self.room:
                del self.newer[stretch]  # a single one, with some 12 bytes for a character, may not fill the memory
        if self.free < 0:
            self.newer, self.older, self.free = {}, self.newer, self.room
        return found

    def _learn(self, wanted: set[str]) -> list[str]:
        """Sees that the newer generation has these stretches, which may take it over its room; those it had not."""
        missing = wanted.difference(self.newer)
        unknown = missing.difference(self.older)
        again, new = list(missing - unknown), list(unknown)
        values = list(map(self.older.pop, again))
        if new:
            values += self._parts(new, list(map(self.left.encode_latin, new)), self.right.encode(new, num_threads=1))
        again += new
        self.newer.update(zip(again, values, strict=True))
        # Some 340 bytes for the objects and their place; two for a character at most.
        held = [value for value in values if value is not None]
        self.free -= 340 * len(again) + 2 * sum(map(len, again)) + sum(len(groups) + len(links) for _, groups, links in held)
        return again

    def _joined(self, text: str, own: list[str] | None) -> Aligned:
        if not text:
            return NOTHING
        if own is not None:
            found = list(map(self.newer.__getitem__, own))
            if None not in found:
                counts, groups, links = zip(*found, strict=True)
                return _unpacked((sum(counts), ";".join(groups), b"".join(links)))
        return self.whole(" " + text) or NOTHING


def aligned(docs: DataFrame, made, *keep: str, text: str = "text") -> DataFrame:
    """Columns ``keep`` with token counts, ``groups`` (``a1,a2|b1;a3|b2,b3``) and ``links`` (32-bit places in the pairs' list).

    ``made`` is the broadcast :class:`Vocabularies`.
    """

    def worker() -> Callable:
        import pyarrow as pa

        known = made.value
        aligner = once_a_worker("aligner", (hash(known.left), hash(known.right)), lambda: Aligner(known))

        def of_texts(texts):
            n_a, n_b, n_groups, groups, links = zip(*aligner.align([text or "" for text in texts]), strict=True)
            numbers = [pa.array(n, pa.int64()) for n in (n_a, n_b, n_groups)]
            return *numbers, pa.array(groups, pa.string()), pa.array(links, pa.binary())

        return of_texts

    return map_texts(docs, keep, text, MADE, worker, TEXT_BYTES)


def pair_counts(rows: DataFrame, made) -> DataFrame:
    """How many links hold each pair (its place in the list): each task adds up its own links first."""

    def counted(batches):
        import numpy as np
        import pyarrow as pa

        total = np.zeros(len(made.value.pairs), np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i4"), minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["pair", "n"])

    partial = rows.select("links").mapInArrow(counted, "pair bigint, n bigint")
    return partial.groupBy("pair").agg(F.sum("n").alias("n"))


def link_scores(rows: DataFrame, made, counts, *keep: str) -> DataFrame:
    """Columns ``keep`` with ``n_links``, ``n_best`` and ``count_sum`` of each row.

    A link is best if its pair's count is the highest of its right id; ``counts`` is the broadcast list of counts.
    """

    @F.arrow_udf("struct<n_best:bigint,count_sum:bigint>", F.ArrowUDFType.SCALAR_ITER)
    def scores(batches):
        import numpy as np
        import pyarrow as pa

        right = made.value.right_of_pairs()
        highest = np.zeros(len(made.value.right_tokens), np.int64)
        np.maximum.at(highest, right, counts.value)
        best = counts.value == highest[right]
        for packed in batches:
            n_best, sums = [], []
            for links in packed:
                places = np.frombuffer(links.as_py(), "<i4")
                n_best.append(int(best[places].sum()))
                sums.append(int(counts.value[places].sum()))
            yield pa.StructArray.from_arrays([pa.array(n_best, pa.int64()), pa.array(sums, pa.int64())], ["n_best", "count_sum"])

    n_links = (F.length("links") / 4).cast("bigint").alias("n_links")
    scored = rows.select(*keep, n_links, scores("links").alias("s"))
    return scored.select(*keep, "n_links", "s.*")


def collected_counts(counts: DataFrame, size: int):
    """The counts as one list; it is as long as the list of pairs, which the vocabularies bound."""
    import numpy as np

    total = np.zeros(size, np.int64)
    found = counts.toArrow()
    total[found["pair"].to_numpy()] = found["n"].to_numpy()
    return total


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's groups and links between the tokens of the two public tokenizers."""
    made = spark.sparkContext.broadcast(default_vocabularies())
    rows = aligned(table(spark, sf_dir, "documents"), made, "doc_id")
    digest = F.when(F.col("n_groups") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise(F.lit(""))
    kept = materialize(
        spark, rows.select("doc_id", "n_a", "n_b", "n_groups", "links", digest.alias("groups_sha256")), "op12-links"
    )
    counts = spark.sparkContext.broadcast(collected_counts(pair_counts(kept, made), len(made.value.pairs)))
    return link_scores(kept, made, counts, "doc_id", "n_a", "n_b", "n_groups", "groups_sha256")
