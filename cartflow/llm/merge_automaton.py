"""BPE by a deterministic automaton over tokens, built by one merge gadget after the other.

The automaton starts as one state with an arc for each base symbol, so every spelling is accepted. The gadget of a
merge ``u v -> t`` takes the arc ``v`` away after ``u`` and lays an arc ``t`` in place of the two: ``u`` leads to a
copy of its state without ``v``, and ``t`` leads where ``v`` led. After all gadgets, in the order of the merges, a
word has exactly one accepted spelling, its encoding, and so has each prefix of its symbols.

Where an arc leads depends on its token only, so a state is what is closed after a token. If a gadget closes ``v``
after ``u``, no arc is laid there later for tokens that start with ``v``. Tokens are numbered so that each of them
follows those made by extending it, in the order they were made; what a gadget closes is then one interval of
numbers, and a state is a short sorted list of closed intervals. This keeps the whole table at a few megabytes.

Encoding walks a word by tables: from each place that is reached, symbol arcs find the tokens that start there, and the state of
the token that ends there says which of them are open. The longest is followed first; as each prefix has one accepted spelling,
no place is reached twice, so a word of n bytes takes at most n times the longest token in steps. Decoding emits the labels of the arcs.

The merges must be proper: every part is a base symbol or made by an earlier merge, and no token is made twice. All
bytes must be base symbols. Else ``compile_merges`` raises an error.

Words are split as the tokenizer file says: special tokens are taken out of the raw text first, the rest is brought
to normal form C, white space and case are folded, and each match of the split pattern is a word. Texts of characters
below U+0300, which normal form C leaves as they are, are folded here, others by the library's own normalizer and pre-tokenizer.

NULL and empty texts have no tokens. Rows are encoded one by one, repeated ones alike; other columns are carried
along only if asked for, so their names can't clash.
"""

from __future__ import annotations

import json
import re
from array import array
from bisect import bisect_left

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartflow.llm.byte_bpe import byte_table
from cartflow.llm.common import table
from cartflow.llm.pieces import Memory, Splitter, is_latin, map_texts, number_lists, once_a_worker

TOKENIZER = "word_bpe_49k.json"
#: Bytes of words a worker remembers, in each of two generations.
ROOM = 64 << 20
MADE = "ids array<int>, packed binary, decoded string"


class MergeAutomaton:
    """Tables of the automaton: symbol arcs, numbers of tokens, closed intervals after each token."""

    def __init__(self, arcs, token_at, number, length, first, starts, ends, ending: bool) -> None:
        self.arcs = arcs  # node * 512 + symbol -> node
        self.token_at = token_at  # token that ends at a node, or -1
        self.number = number
        self.length = length  # in symbols
        self.first, self.starts, self.ends = first, starts, ends  # closed intervals, by token
        self.ending = ending

    def open_after(self, before: int, token: int) -> bool:
        """Whether ``token`` may follow ``before``."""
        hi = self.first[before + 1]
        at = bisect_left(self.ends, self.number[token], self.first[before], hi)
        return at == hi or self.starts[at] > self.number[token]

    def accepts(self, ids: list[int]) -> bool:
        """Whether a word is spelled by ``ids``: the automaton's language."""
        return all(self.open_after(a, b) for a, b in zip(ids, ids[1:], strict=False))

    def encode(self, word: bytes) -> list[int]:
        """The one accepted spelling of a word."""
        size = len(word)
        symbols = list(word)
        if self.ending and size:
            symbols[-1] += 256
        arcs, token_at, number = self.arcs, self.token_at, self.number
        starts, ends, first = self.starts, self.ends, self.first
        last = array("i", [-1]) * (size + 1)  # the token that ends at each place
        waiting = [0]  # places that are reached, the farthest of those found together on top
        while waiting:
            i = waiting.pop()
            if i == size:
                break
            lo, hi = (first[last[i]], first[last[i] + 1]) if i else (0, 0)
            node = 0
            for j in range(i, size):
                node = arcs.get(node << 9 | symbols[j])
                if node is None:
                    break
                token = token_at[node]
                if token >= 0:
                    place = number[token]
                    at = bisect_left(ends, place, lo, hi)
                    if at == hi or starts[at] > place:
                        last[j + 1] = token
                        waiting.append(j + 1)
        ids, at = [], size
        while at:
            ids.append(last[at])
            at -= self.length[last[at]]
        return ids[::-1]


def _closed(row: tuple, place: int) -> bool:
    at = bisect_left(row, place, key=lambda interval: interval[1])
    return at < len(row) and row[at][0] <= place


def _with_interval(row: tuple, start: int, end: int) -> tuple:
    """A sorted list of separate intervals with one more."""
    lo = bisect_left(row, start - 1, key=lambda interval: interval[1])
    hi = lo
    while hi < len(row) and row[hi][0] <= end + 1:
        start, end = min(start, row[hi][0]), max(end, row[hi][1])
        hi += 1
    return (*row[:lo], (start, end), *row[hi:])


def compile_merges(vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str | None) -> MergeAutomaton:
    """The automaton of a vocabulary in byte characters and its merges in order; ``suffix`` marks a word's last symbol."""
    back = {c: b for b, c in enumerate(byte_table())}
    size = max(vocab.values(), default=-1) + 1
    spelled: list[tuple[int, ...] | None] = [None] * size
    for c, b in back.items():
        for name, symbol in ((c, b), (c + suffix, b + 256)) if suffix else ((c, b),):
            if name not in vocab:
                raise ValueError(f"{name!r} is not in the vocabulary")
            spelled[vocab[name]] = (symbol,)

    steps, extended = [], [[] for _ in range(size)]  # tokens made by extending a token, and by which merge
    for rank, (left, right) in enumerate(merges):
        u, v, t = vocab[left], vocab[right], vocab[left + right]
        if spelled[u] is None or spelled[v] is None or spelled[t] is not None:
            raise ValueError(f"merge {rank} of {left!r} and {right!r} is not proper")
        spelled[t] = spelled[u] + spelled[v]
        steps.append((u, v, t))
        extended[u].append((rank, t))

    # Each token is numbered after all tokens that extend it, these in the order of their merges.
    number, lowest, count = [0] * size, [0] * size, 0
    made = {t for _, _, t in steps}
    for root in (t for t in range(size) if spelled[t] is not None and t not in made):
        waiting = [(root, False)]
        while waiting:
            token, done = waiting.pop()
            if done:
                number[token] = count
                count += 1
                continue
            lowest[token] = count
            waiting.append((token, True))
            waiting.extend((t, False) for _, t in reversed(extended[token]))

    def closes_from(token: int, rank: int) -> int:
        """The first number of those that extend ``token`` by this merge or a later one, or its own."""
        at = bisect_left(extended[token], rank, key=lambda pair: pair[0])
        return lowest[extended[token][at][1]] if at < len(extended[token]) else number[token]

    state: list[tuple] = [()] * size  # closed intervals after each token
    laid = [spelled[t] is not None and t not in made for t in range(size)]
    for rank, (u, v, t) in enumerate(steps):
        before = state[u]
        if not laid[u] or not laid[v] or _closed(before, number[v]):
            continue  # no path of two such arcs is left: the merge never happens
        laid[t] = True
        state[t] = state[v]
        state[u] = _with_interval(before, closes_from(v, rank), number[v])

    arcs: dict[int, int] = {}
    token_at = [-1]
    for token in range(size):
        if not laid[token]:
            continue
        node = 0
        for symbol in spelled[token]:
            following = arcs.get(node << 9 | symbol)
            if following is None:
                following = arcs[node << 9 | symbol] = len(token_at)
                token_at.append(-1)
            node = following
        token_at[node] = token
    first = [0]
    for row in state:
        first.append(first[-1] + len(row))
    starts = array("i", [a for row in state for a, _ in row])
    ends = array("i", [b for row in state for _, b in row])
    return MergeAutomaton(arcs, token_at, number, [len(s or ()) for s in spelled], first, starts, ends, suffix is not None)


class WordTokenizer:
    """Encodes and decodes texts as a tokenizer file says, its merges compiled into an automaton."""

    def __init__(self, settings: str) -> None:
        stated = json.loads(settings)
        model = stated["model"]
        self.pattern = _checked_pattern(stated)
        self.specials = {t["content"]: t["id"] for t in stated["added_tokens"]}
        self.automaton = compile_merges(
            model["vocab"], [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]], model["end_of_word_suffix"]
        )
        names = {**model["vocab"], **self.specials}
        self.labels = [""] * (max(names.values(), default=-1) + 1)
        for name, token in names.items():
            self.labels[token] = name
        # The library's part is only to normalize and split what is not folded here.
        stated["model"] = {"type": "WordLevel", "vocab": {}, "unk_token": ""}
        stated["added_tokens"] = []
        self.library = json.dumps(stated)


def _checked_pattern(stated: dict) -> str:
    """The split pattern, if words are made in the one way that is covered here."""
    steps = [step["type"] for step in (stated["normalizer"] or {}).get("normalizers", [])]
    splits = (stated["pre_tokenizer"] or {}).get("pretokenizers", [])
    model = stated["model"]
    plain = not any(t[flag] for t in stated["added_tokens"] for flag in ("single_word", "lstrip", "rstrip", "normalized"))
    unused = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
    if (
        steps != ["NFC", "Replace", "Lowercase"]
        or [s["type"] for s in splits] != ["Split", "ByteLevel"]
        or (splits[0]["behavior"], splits[0]["invert"]) != ("Removed", True)
        or splits[1]["add_prefix_space"]
        or splits[1]["use_regex"]
        or stated["decoder"] is not None
        or not (plain and unused)
    ):
        raise ValueError("a tokenizer file of another kind")
    return splits[0]["pattern"]["Regex"]


class Words:
    """A word tokenizer at work in one process, with its memory of words."""

    def __init__(self, known: WordTokenizer, room: int = ROOM) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        from tokenizers import Tokenizer

        library = Tokenizer.from_str(known.library)
        self.normalize = library.normalizer.normalize_str
        self.pre_tokenize = library.pre_tokenizer.pre_tokenize_str
        self.back = {c: b for b, c in enumerate(byte_table())}
        self.split = Splitter(known.pattern)
        self.labels = known.labels
        self.specials = {text: array("i", [token]).tobytes() for text, token in known.specials.items()}
        names = sorted(known.specials, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        encode = known.automaton.encode
        self.memory = Memory(lambda word: array("i", encode(word.encode())).tobytes(), room)

    def words(self, text: str) -> list[str]:
        if is_latin(text):
            lower = text.lower()
            if is_latin(lower):
                return self.split.latin(lower)
        pieces = self.pre_tokenize(self.normalize(text))
        return [bytes(map(self.back.__getitem__, piece)).decode() for piece, _ in pieces]

    def encode(self, text: str) -> bytes:
        """Token ids as 32-bit numbers."""
        known = self.memory.__getitem__
        if self.special is None or self.special.search(text) is None:
            return b"".join(map(known, self.words(text)))
        found = []
        for at, part in enumerate(self.special.split(text)):
            if at % 2:
                found.append(self.specials[part])
            elif part:
                found.extend(map(known, self.words(part)))
        return b"".join(found)

    def decode(self, ids) -> str:
        """The labels of the arcs, one blank between them, as the library joins tokens without a decoder."""
        return " ".join(map(self.labels.__getitem__, ids))


def default_tokenizer() -> WordTokenizer:
    import public_tokenizers

    with open(public_tokenizers.path(TOKENIZER), encoding="utf-8") as file:
        return WordTokenizer(file.read())


def tokenized(
    spark: SparkSession, docs: DataFrame, *keep: str, text: str = "text", tokenizer: WordTokenizer | None = None, lists: bool = True
) -> DataFrame:
    """Columns ``keep`` with ``ids``, ``packed`` (the same as little-endian 32-bit numbers) and ``decoded`` of every row.

    Without ``lists``, ``ids`` is NULL. The automaton is broadcast; its size is that of the vocabulary, whatever the input.
    """
    made = spark.sparkContext.broadcast(default_tokenizer() if tokenizer is None else tokenizer)

    def worker():
        import numpy as np
        import pyarrow as pa

        words = once_a_worker("words", made.value.library, lambda: Words(made.value))

        def of_texts(texts):
            ids, packed, back = [], [], []
            for text in texts:
                own = np.frombuffer(words.encode(text or ""), np.int32)
                if lists:
                    ids.append(own)
                packed.append(own.astype("<i4").tobytes())
                back.append(words.decode(own.tolist()))
            listed = number_lists(ids) if lists else pa.nulls(len(texts), pa.list_(pa.int32()))
            return listed, pa.array(packed, pa.binary()), pa.array(back, pa.string())

        return of_texts

    return map_texts(docs, keep, text, MADE, worker)


def decoded(spark: SparkSession, ids: Column, tokenizer: WordTokenizer | None = None) -> Column:
    """The text of a list of token ids: the labels of the arcs; NULL has none."""
    labels = (default_tokenizer() if tokenizer is None else tokenizer).labels
    known = spark.sparkContext.broadcast(labels)

    @F.arrow_udf("string")
    def of_batch(lists):
        import pyarrow as pa

        name = known.value.__getitem__
        return pa.array([" ".join(map(name, own or ())) for own in lists.to_pylist()], pa.string())

    return of_batch(ids)


def op11_merge_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of the text decoded from them."""
    rows = tokenized(spark, table(spark, sf_dir, "documents"), "doc_id", lists=False)
    return rows.select(
        "doc_id",
        (F.length("packed") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("packed", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
