"""Byte-level BPE encoding and decoding with the ``tokenizers`` library over Arrow batches.

A rank file lists byte strings; the library works on characters. So ranks are loaded through the byte
table (each byte is a printable character), pieces are mapped to characters by the library's byte-level
step, offsets come back in characters of the piece, and decoding reverses the table.

Texts are encoded whole: every match of the split pattern on its own, without special tokens. A worker keeps the
pieces it has met over all its tasks, up to a bound in bytes; beyond it those not asked for lately go. NULL and empty texts have no
tokens. Rows are encoded one by one, repeated ones alike; other columns are carried along only if asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartflow.llm.common import table
from cartflow.llm.pieces import Memory, Splitter, map_texts, number_lists, once_a_worker

RANKS = "byte_bpe_50k.tiktoken"
#: Bytes of pieces a worker remembers, in each of two generations.
ROOM = 80 << 20
MADE = "ids array<int>, starts array<int>, ends array<int>, n_split bigint, decoded binary"


def byte_table() -> list[str]:
    """The character that stands for each byte: itself if printable Latin-1, else one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    import base64

    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merge_pair(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The two tokens whose merge makes ``token``: its bytes merged in rank order up to its own rank."""
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        joined = [ranks.get(a + b, len(ranks)) for a, b in zip(parts, parts[1:], strict=False)]
        i = min(range(len(joined)), key=joined.__getitem__)
        if joined[i] >= ranks[token]:
            raise ValueError(f"{token!r} can't be made by merges of lower rank")
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts[0], parts[1]


def tokenizer_from_ranks(ranks: dict[bytes, int]) -> str:
    """A tokenizer for single pieces, as the library's JSON text."""
    from tokenizers import Tokenizer, models, pre_tokenizers

    letters = byte_table()
    named = {token: "".join(letters[b] for b in token) for token in ranks}
    merges = [
        tuple(named[part] for part in merge_pair(token, ranks)) for token in sorted(ranks, key=ranks.get) if len(token) > 1
    ]
    made = Tokenizer(models.BPE(vocab={named[t]: r for t, r in ranks.items()}, merges=merges))
    made.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return made.to_str()


def default_ranks() -> dict[bytes, int]:
    import public_tokenizers

    return read_ranks(public_tokenizers.path(RANKS))


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


class PieceEncoder:
    """Token ids and character offsets of texts."""

    def __init__(self, tokenizer: str, pattern: str, room: int = ROOM) -> None:
        import os
        from array import array

        import numpy as np

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        from tokenizers import Tokenizer

        made = Tokenizer.from_str(tokenizer)
        # A token has a character for each of its bytes.
        names = made.get_vocab()
        self.lengths = np.zeros(max(names.values(), default=0) + 1, np.int64)
        self.lengths[list(names.values())] = [len(name) for name in names]
        self.split = Splitter(pattern)
        characters, merge = dict(enumerate(byte_table())), made.model.tokenize

        def encode(piece: str) -> bytes:
            spelled = piece.encode().decode("latin-1").translate(characters)
            return array("i", [token.id for token in merge(spelled)]).tobytes()

        self.pieces = Memory(encode, room)

    def encode(self, text: str):
        """Array of token ids."""
        import numpy as np

        return np.frombuffer(b"".join(map(self.pieces.__getitem__, self.split(text))), np.int32)

    def n_split(self, text: str, ids) -> int:
        """How many tokens end inside a character: the next byte goes on with it."""
        import numpy as np

        if text.isascii():
            return 0
        data = np.frombuffer(text.encode(), np.uint8)
        return int(((data[np.cumsum(self.lengths[ids])[:-1]] & 0xC0) == 0x80).sum())

    def offsets(self, text: str, ids):
        """Code points where tokens start and end; tokens that share a split character all cover it."""
        import numpy as np

        data = np.frombuffer(text.encode(), np.uint8)
        character = np.cumsum((data & 0xC0) != 0x80) - 1  # of each byte
        ends = np.cumsum(self.lengths[ids])
        starts = character[ends - self.lengths[ids]]
        return starts.astype(np.int32), (character[ends - 1] + 1).astype(np.int32)


class TokenBytes:
    """The bytes of tokens, from their characters; parts of a split character meet again in the joined bytes."""

    def __init__(self, names: list[str]) -> None:
        back = {c: b for b, c in enumerate(byte_table())}
        self.tokens = [bytes(map(back.__getitem__, name)) for name in names]

    def joined(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


def _names(ranks: dict[bytes, int]) -> list[str]:
    letters = byte_table()
    names = [""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        names[rank] = "".join(letters[b] for b in token)
    return names


def decoded(spark: SparkSession, ids: Column, ranks: dict[bytes, int]) -> Column:
    """The bytes of a list of token ids; NULL has none."""
    known = spark.sparkContext.broadcast(_names(ranks))

    @F.arrow_udf("binary", F.ArrowUDFType.SCALAR_ITER)
    def of_batches(batches):
        import pyarrow as pa

        tokens = TokenBytes(known.value)
        for lists in batches:
            values, at = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            yield pa.array([tokens.joined(values[a:b]) for a, b in zip(at, at[1:], strict=False)], pa.binary())

    return of_batches(ids)


def tokenized(
    spark: SparkSession,
    docs: DataFrame,
    *keep: str,
    text: str = "text",
    ranks: dict[bytes, int] | None = None,
    pattern: str | None = None,
    offsets: bool = True,
) -> DataFrame:
    """Columns ``keep`` with ``ids``, the code points ``starts`` to ``ends`` they cover, ``n_split`` and ``decoded`` of every row.

    ``n_split`` counts the tokens that end inside a character; ``decoded`` are the bytes of the ids, decoded again at once
    in the same worker. Without ``offsets`` the two lists of code points are NULL. The tokenizer is broadcast; its size
    is that of the vocabulary, whatever the input.
    """
    ranks = default_ranks() if ranks is None else ranks
    pattern = default_pattern() if pattern is None else pattern
    made = spark.sparkContext.broadcast((tokenizer_from_ranks(ranks), pattern, _names(ranks)))

    def worker():
        import numpy as np
        import pyarrow as pa

        tokenizer, pattern, names = made.value
        encoder, tokens = once_a_worker(
            "byte_bpe", (hash(tokenizer), pattern), lambda: (PieceEncoder(tokenizer, pattern), TokenBytes(names))
        )
        nothing = np.zeros(0, np.int32)

        def of_texts(texts):
            ids, starts, ends, split, back = [], [], [], [], []
            for text in texts:
                text = text or ""
                own = encoder.encode(text)
                ids.append(own)
                split.append(encoder.n_split(text, own))
                back.append(tokens.joined(own))
                if offsets:
                    a, b = encoder.offsets(text, own) if len(own) else (nothing, nothing)
                    starts.append(a)
                    ends.append(b)
            places = [number_lists(starts), number_lists(ends)] if offsets else [pa.nulls(len(ids), pa.list_(pa.int32()))] * 2
            return number_lists(ids), *places, pa.array(split, pa.int64()), pa.array(back, pa.binary())

        return of_texts

    return map_texts(docs, keep, text, MADE, worker)


def digests(rows: DataFrame, *keep: str) -> DataFrame:
    """Token count and digests of tokenized rows."""
    return rows.select(
        *keep,
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
        "n_split",
    )


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of the bytes decoded from them."""
    return digests(tokenized(spark, table(spark, sf_dir, "documents"), "doc_id", offsets=False), "doc_id")
