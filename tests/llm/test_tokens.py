"""The token operators against the libraries, naive merging, all pairs and plain slicing."""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from fixtures import SCHEMAS, document_rows, odd_dir  # noqa: F401
from tokenizers import Tokenizer

from cartflow.llm import alignment, byte_bpe, fill_middle, merge_automaton
from cartflow.llm.pieces import LATIN_END, Memory, Splitter, latin_pattern, slices
from cartflow.llm.queries import ORACLE_SQL, QUERIES

TEXTS = [
    "x<|endoftext|>y <|startoftext|>  <|endoftext|",
    "ΑΣ ΟΔΟΣ İstanbul Ⱥ ǅ Å é ﬁ ̈́ 한글 𝔘 \U0001f600!!!???",
    "\x1c\x1d \x85\xa0 a\x00b   ​ z",
    "it's we're I'LL they'd 'S 1234½Ⅷ²",
    "▁piece ▁ x",
    "<0x41> <unk><s> </s>",
    " leading  double   \n\n\ttabs ",
    "a <P> b",
    "<<S",
    "é" * 5000 + "lol" * 9000,
    "aAbB zZ@[`{",
    "日本語 text " * 50,
    "the the the of of",
    "the of",
]


@pytest.fixture(scope="module")
def token_dir(tmp_path_factory):
    folder = tmp_path_factory.mktemp("tokens")
    rows = document_rows() + [{"doc_id": 100 + i, "text": t, "lang": "en", "source": "s", "n_chars": len(t)} for i, t in enumerate(TEXTS)]
    rows += [{"doc_id": 200 + i, "text": f"{t} {i}"} for i, t in enumerate(TEXTS * 4)]
    pq.write_table(pa.Table.from_pylist(rows, SCHEMAS["documents"]), f"{folder}/documents.parquet")
    return str(folder)


def rows_in(folder: str) -> list[dict]:
    return pq.read_table(f"{folder}/documents.parquet").to_pylist()


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def found_rows(spark, folder, name, *columns):
    return sorted((tuple(r) for r in QUERIES[name](spark, folder).select(*columns).collect()), key=repr)


# --- helpers ---


def test_latin_patterns_match_as_the_full_ones():
    characters = "".join(map(chr, range(LATIN_END)))
    rng = random.Random(3)
    for pattern in (public_tokenizers.PATTERN, merge_automaton.default_tokenizer().pattern):
        split = Splitter(pattern)
        assert latin_pattern(pattern) is not None
        assert split.latin(characters) == split.any(characters)
        for _ in range(300):
            text = "".join(rng.choice(characters + " \n'sd" * 40) for _ in range(60))
            assert split.latin(text) == split.any(text)
    assert latin_pattern(r"\w+") is None and latin_pattern(r"\p{Lu}") is None


def test_memory_keeps_what_is_asked_for():
    made = []
    memory = Memory(lambda piece: made.append(piece) or piece.encode(), room=5000)
    for i in range(1000):
        assert memory["often"] == b"often" and memory[f"p{i}"] == f"p{i}".encode()
    assert made.count("often") == 1
    assert len(memory) + len(memory.older) <= 2 * 5000 // 200
    assert memory["x" * 9000] == b"x" * 9000 and "x" * 9000 not in memory


def test_slices_cover_all_rows_within_the_limit():
    texts = pa.array([None, "", "aaaa", "b" * 50, "cc", None, "d"])
    found = list(slices(texts, 10))
    assert [a for a, _ in found[1:]] == [b for _, b in found[:-1]] and found[0][0] == 0 and found[-1][1] == len(texts)
    assert all(b - a == 1 or sum(len(t or "") for t in texts[a:b].to_pylist()) <= 10 for a, b in found)
    assert list(slices(texts.slice(3, 2), 10)) == [(0, 1), (1, 2)]
    assert list(slices(texts.slice(0, 0), 10)) == []


# --- 11 ---


def naive_merges(word: str, merges, suffix: str | None) -> list[str]:
    parts = list(word)
    if suffix and parts:
        parts[-1] += suffix
    for left, right in merges:
        at, joined = 0, []
        while at < len(parts):
            if parts[at : at + 2] == [left, right]:
                joined.append(left + right)
                at += 2
            else:
                joined.append(parts[at])
                at += 1
        parts = joined
    return parts


def random_merges(rng, letters: str, suffix: str | None):
    vocab: dict[str, int] = {}
    for c in byte_bpe.byte_table():
        for name in (c, c + suffix) if suffix else (c,):
            vocab[name] = len(vocab)
    known, merges = [*letters, *([c + suffix for c in letters] if suffix else [])], []
    for _ in range(rng.randint(0, 40)):
        left, right = rng.choice(known), rng.choice(known)
        if left + right in vocab or len(left + right) > 12 or (suffix and left.endswith(suffix)):
            continue
        merges.append((left, right))
        vocab[left + right] = len(vocab)
        known.append(left + right)
    return vocab, merges


def spellings(word: bytes, automaton) -> list[list[int]]:
    """All accepted spellings of a word, by trying every token at every place."""
    symbols = list(word)
    if automaton.ending and symbols:
        symbols[-1] += 256
    by_symbols = {}
    for packed, node in automaton.arcs.items():
        by_symbols.setdefault(packed >> 9, []).append((packed & 511, node))
    found = []

    def walk(at: int, ids: list[int]) -> None:
        if at == len(symbols):
            found.append(ids)
            return
        node = 0
        for j in range(at, len(symbols)):
            node = dict(by_symbols.get(node, ())).get(symbols[j])
            if node is None:
                return
            token = automaton.token_at[node]
            if token >= 0 and (not ids or automaton.open_after(ids[-1], token)):
                walk(j + 1, [*ids, token])

    walk(0, [])
    return found


@pytest.mark.parametrize("suffix", [None, "</w>"])
@pytest.mark.parametrize("letters", ["a", "ab", "abc"])
def test_automaton_spells_as_merging_does(letters, suffix):
    rng = random.Random(f"{letters}{suffix}")
    for _ in range(40):
        vocab, merges = random_merges(rng, letters, suffix)
        automaton = merge_automaton.compile_merges(vocab, merges, suffix)
        for size in [*range(9), 13, 20]:
            word = "".join(rng.choice(letters) for _ in range(size))
            expected = [vocab[part] for part in naive_merges(word, merges, suffix)]
            assert automaton.encode(word.encode()) == expected
            if size < 9:
                assert spellings(word.encode(), automaton) == [expected]


def test_automaton_refuses_what_it_cannot_compile():
    vocab = {c: i for i, c in enumerate(byte_bpe.byte_table())}
    with pytest.raises(ValueError, match="not proper"):
        merge_automaton.compile_merges({**vocab, "ab": 256, "abc": 257}, [("ab", "c"), ("a", "b")], None)
    with pytest.raises(ValueError, match="not proper"):
        merge_automaton.compile_merges({**vocab, "ab": 256, "abc": 257, "bc": 258}, [("a", "b"), ("b", "c"), ("ab", "c"), ("a", "bc")], None)
    with pytest.raises(ValueError, match="not in the vocabulary"):
        merge_automaton.compile_merges({"a": 0}, [], None)


def test_long_words_take_linear_time():
    words = merge_automaton.Words(merge_automaton.default_tokenizer())
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for text in ("a" * 200_000, "ab" * 100_000, "é" * 50_000):
        ids = np.frombuffer(words.encode(text), np.int32).tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids


def test_automaton_query(spark, token_dir):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = []
    for row in rows_in(token_dir):
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        expected.append((row["doc_id"], len(ids), sha(np.array(ids, "<u4").tobytes()), sha(back)))
    columns = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert found_rows(spark, token_dir, "op11_merge_automaton", *columns) == sorted(expected, key=repr)


def test_automaton_lists_and_decoding(spark, token_dir):
    known = merge_automaton.default_tokenizer()
    rows = merge_automaton.tokenized(spark, spark.read.parquet(f"{token_dir}/documents.parquet"), "doc_id", "kept", tokenizer=known)
    rows = rows.withColumn("again", merge_automaton.decoded(spark, rows["ids"], known)).collect()
    for row in rows:
        assert np.array(row["ids"], "<u4").tobytes() == bytes(row["packed"])
        assert row["again"] == row["decoded"]


# --- 12 ---


def plain_alignment(rows: list[dict]) -> list[tuple]:
    """Groups by sorting every token under the first common end that reaches it."""
    left = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    left.encode_special_tokens = True
    right = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    back = {c: b for b, c in enumerate(byte_bpe.byte_table())}

    def right_bytes(i: int) -> bytes:
        piece = right.id_to_piece(i)
        byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()

    def spans(ids, data):
        at, out = 0, []
        for i, d in zip(ids, data, strict=True):
            out.append((i, at, at := at + len(d)))
        return out

    made, counts = [], Counter()
    for row in rows:
        text, a, b = row["text"] or "", [], []
        if text:
            whole = " " + text
            encoded = left.encode(whole, add_special_tokens=False)
            a_data = [bytes(back[c] for c in token) for token in encoded.tokens]
            ids = right.encode(text, num_threads=1)
            b_data = [right_bytes(i) for i in ids]
            if b"".join(a_data) == whole.encode() == b"".join(b_data):
                a, b = spans(encoded.ids, a_data), spans(ids, b_data)
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        cuts: dict[int, tuple[list, list]] = {end: ([], []) for end in ends}
        for k, side in enumerate((a, b)):
            for i, _, e in side:
                cuts[ends[bisect_left(ends, e)]][k].append(str(i))
        groups = ["|".join(",".join(side) for side in cuts[end]) for end in ends]
        b_at = {e: i for i, _, e in b}
        links = [(i, b_at[e]) for i, _, e in a if e in b_at]
        counts.update(links)
        made.append((row["doc_id"], len(a), len(b), len(groups), links, sha(";".join(groups)) if a else ""))
    highest: dict[int, int] = {}
    for (_, b), n in counts.items():
        highest[b] = max(n, highest.get(b, 0))
    return [
        (i, n_a, n_b, n, len(links), sum(counts[k] == highest[k[1]] for k in links), sum(counts[k] for k in links), digest)
        for i, n_a, n_b, n, links, digest in made
    ]


def test_alignment_query(spark, token_dir):
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert found_rows(spark, token_dir, "op12_alignment", *columns) == sorted(plain_alignment(rows_in(token_dir)), key=repr)


def test_linkable_pairs_are_suffixes():
    left, right = [b"a", b"ba", b"", b"c"], [b"cba", b"a", b"a", b"x"]
    pairs = {(int(p) // 4, int(p) % 4) for p in alignment.linkable_pairs(left, right)}
    expected = {(i, j) for i, a in enumerate(left) for j, b in enumerate(right) if a and b and (a.endswith(b) or b.endswith(a))}
    assert pairs == expected


def test_slices_end_together():
    sizes = [1, 2, 3]
    assert alignment.ends([0, 1, 2], sizes) == {1: 1, 3: 2, 6: 3}
    assert alignment.sliced({1: 1, 3: 2, 6: 3}, {3: 1, 4: 2, 6: 3}) == ([2, 3], [1, 3])
    assert alignment.sliced({2: 1}, {1: 1, 2: 2}) == ([1], [2])
    assert alignment.sliced({}, alignment.ends([], sizes)) == ([], [])


def test_stretches_are_aligned_as_the_whole_text():
    known = alignment.default_vocabularies()
    assert known.local
    aligner = alignment.Aligner(known, room=40_000)
    rng = random.Random(12)
    parts = ["the", "Of", "naïve", "x1", "...", "it's", "42", "—", "<s>", "\x1c", "\x85", "\xa0", "'", "a.b", "▁", "ß", "\x00", "I'LL", "(("]
    blanks = [" ", " ", " ", "  ", "   ", "\n", " \n", "\n ", "\n  ", "\t", " \t ", "", "\r\n", "\xa0", " \xa0 ", "\x0b "]
    for _ in range(60):
        texts = []
        for _ in range(50):
            text = "".join(rng.choice(parts) + rng.choice(blanks) for _ in range(rng.randint(0, 9)))
            texts.append(rng.choice(["", "", " ", "\n"]) + text)
        for text, found in zip(texts, aligner.align(texts), strict=True):
            assert found == ((aligner.whole(" " + text) or alignment.NOTHING) if text else alignment.NOTHING), repr(text)


def test_known_stretches_are_not_encoded_again(monkeypatch):
    aligner = alignment.Aligner(alignment.default_vocabularies(), room=1000)
    texts = ["the cat sat", "on the mat", "x" * 500]
    once = aligner.align(texts)
    assert all(len(found.links) == 4 * found.n_groups for found in once)  # places, found once for each stretch
    assert max(map(len, [*aligner.newer, *aligner.older])) < 10  # the long one is not kept
    assert aligner.older and not aligner.newer  # all others moved on when they outgrew their room
    monkeypatch.setattr(aligner, "_parts", lambda *_: 1 / 0)
    assert aligner.align(texts[:2]) == once[:2]


def test_a_stretch_that_differs_is_told_from_the_others():
    aligner = alignment.Aligner(alignment.default_vocabularies())
    words = [" the", " cat", " sat"]
    lists = [aligner.left.encode(w) for w in words], [aligner.right.encode(w, num_threads=1) for w in words]
    alone = [aligner.whole(w) for w in words]
    assert aligner.together(words, *lists) == alone
    lists[1][1] = lists[1][2]
    assert aligner.together(words, *lists) == [alone[0], None, alone[2]]


# --- 13 ---


def test_exception_index_goes_both_ways():
    rng = random.Random(8)
    for _ in range(300):
        text = "".join(rng.choice("ab é€\U0001f600\n") for _ in range(rng.randint(0, 30)))
        index = fill_middle.ExceptionIndex(np.frombuffer(text.encode(), np.uint8))
        assert len(index.at) == sum(ord(c) > 127 for c in text)
        for k in range(len(text) + 1):
            byte = len(text[:k].encode())
            assert index.to_byte(k) == byte and index.to_character(byte) == k


def test_units_over_blocks(monkeypatch):
    rng = random.Random(9)
    for block in (1, 2, 3, 7, 1 << 20):
        monkeypatch.setattr(fill_middle, "BLOCK", block)
        for _ in range(60):
            text = "".join(rng.choice("abZ é€1@`{[") for _ in range(rng.randint(0, 25)))
            parts = re.findall("[A-Za-z]+|[^A-Za-z]", text, re.DOTALL)
            units = fill_middle.Units(np.frombuffer(text.encode(), np.uint8))
            assert units.n == len(parts)
            assert [units.byte(k) for k in range(len(parts) + 1)] == [len("".join(parts[:k]).encode()) for k in range(len(parts) + 1)]


def plain_fill(row: dict) -> tuple:
    text = row["text"] or ""
    h = hashlib.sha256(f"1:{'' if row['doc_id'] is None else row['doc_id']}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text, re.DOTALL)
    n = len(units)
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return row["doc_id"], n, "plain", None, None, sha(text), sha(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return row["doc_id"], n, "spm", len(prefix), len(middle), sha(f"<S>{suffix}<P>{prefix}<M>{middle}"), sha(text)
    return row["doc_id"], n, "psm", len(prefix), len(middle), sha(f"<P>{prefix}<S>{suffix}<M>{middle}"), sha(text)


def test_fill_query(spark, token_dir):
    columns = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")
    found = found_rows(spark, token_dir, "op13_fill_middle", *columns)
    assert found == sorted(map(plain_fill, rows_in(token_dir)), key=repr)
    assert {row[2] for row in found} == {"plain", "psm", "spm"}


def test_fill_query_is_that_of_sql(spark, token_dir):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{token_dir}/documents.parquet')")
    cursor = connection.execute(ORACLE_SQL["op13_fill_middle"])
    names = [d[0] for d in cursor.description]
    assert found_rows(spark, token_dir, "op13_fill_middle", *names) == sorted(cursor.fetchall(), key=repr)


def test_fill_by_characters(spark):
    rows = spark.createDataFrame([("k1", "é€ab\U0001f600 c" * 9), ("k2", ""), (None, "<"), ("k4", "<S")], "k string, t string")
    how = fill_middle.Transformer(seed="s", rate=100, spm_rate=50, unit="character")
    made = fill_middle.transformed(rows, "k", "t", how)
    made = made.withColumn("back", fill_middle.restored(made["output"], made["form"])).collect()
    texts = {"k1": "é€ab\U0001f600 c" * 9, "k2": "", None: "<", "k4": "<S"}
    for row in made:
        text = texts[row["k"]]
        assert row["back"] == text and row["n"] == len(text)
        if text:
            h1, h2, *_ = fill_middle.numbers("s", row["k"])
            a, b = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
            assert (row["prefix_chars"], row["middle_chars"]) == (a, b - a)
            assert text[:a] in row["output"]
