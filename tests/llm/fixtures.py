"""Small tables with nulls, blanks, long texts, ties, repeated rows and columns of clashing names."""

from __future__ import annotations

import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

WORDS = "the of and le la der die und el que Alpha beta Gamma delta 42 a1 b2 über naïve x".split()
PASSAGE = " ".join(f"passage{i}" for i in range(70))
QUESTION = "What is the boiling point of water at sea level in degrees Celsius, please answer"
CLASHING = ("n_words", "kept", "row", "found", "id", "tag", "fp", "label", "key", "print", "slot", "tokens", "place")


def texts(seed: int = 1) -> list[str | None]:
    rng = random.Random(seed)

    def prose(n: int) -> str:
        return "".join(rng.choice(WORDS) + rng.choice((" ", " ", " ", "  ", "\n", "\t", ". ")) for _ in range(n))

    base = prose(80)
    out: list[str | None] = [None, "", " \n\t ", "one", "one two", "a b c", " ", "é", "a\u0085b c d"]
    out += [prose(n) for n in (3, 4, 12, 13, 14, 49, 50, 60, 300)]
    out += [base, base, base.replace("Alpha", "omega", 1), base + " end", "Head " + base]
    out += [f"{prose(20)} {PASSAGE} {prose(20)}", f"{PASSAGE} {prose(30)}", f"{prose(9)}\n{PASSAGE}"]
    out += [f"{prose(30)} {QUESTION.upper()} {prose(30)}", QUESTION, "boiling point short item", "x" * 30_000, prose(20_000)]
    out += ["same line\nsame line\nother\n\nsame line", "w w w w w w", "# % & | <> $ *", "- a\n- b\n• c", "so ...\nand …"]
    return out


def document_rows() -> list[dict]:
    rows = [{"doc_id": i * 3 % 41, "text": t} for i, t in enumerate(texts())]
    rows.append(dict(rows[20]))  # a repeated row
    rows.append({"doc_id": rows[20]["doc_id"], "text": "another text of the same id " * 9})
    rows.append({"doc_id": None, "text": rows[20]["text"]})
    rows.append({"doc_id": None, "text": None})
    return [
        {**row, "lang": None if i % 3 else "en", "source": "s", "n_chars": len(row["text"] or "")} | dict.fromkeys(CLASHING, "z")
        for i, row in enumerate(rows)
    ]


def page_rows() -> list[dict]:
    html = [None, "", "<p>é</p>", "a" * 999, "a" * 1000, "b" * 5000, "b" * 5000, "b" * 5000, "c" * 1000, "c" * 1000, "x\r\n\r\ny"]
    urls = [None, "", "no url", "http://Sub.Example.com:80/en/1", "https://u:p@www.example.com./fr?x=1", "ftp://a.b.c.d.example.org"]
    rows = [{"page_id": i * 7 % 30, "url": urls[i % len(urls)], "html": h} for i, h in enumerate(html)]
    rows += [dict(rows[5]), {"page_id": None, "url": "http://x.y/\r\nz", "html": "d" * 2000}, {"page_id": 99, "url": None, "html": "d" * 2000}]
    return [row | {"key": "z", "shard": "z", "day": "z", "payload": "z"} for row in rows]


SCHEMAS = {
    "documents": pa.schema(
        [("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())]
        + [(c, pa.string()) for c in CLASHING]
    ),
    "benchmark": pa.schema([("item_id", pa.int64()), ("text", pa.string()), ("n_words", pa.string())]),
    "pages": pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string())]
        + [(c, pa.string()) for c in ("key", "shard", "day", "payload")]
    ),
}


def item_rows() -> list[dict]:
    items = [(1, QUESTION), (10, "boiling point"), (2, QUESTION), (2, QUESTION), (3, None), (4, " .,; "), (None, "one two")]
    items += [(5, PASSAGE), (6, "one"), (7, "a\u0085b c d")]
    return [{"item_id": i, "text": t, "n_words": "z"} for i, t in items]


def write_tables(folder, empty: bool = False) -> str:
    rows = {"documents": document_rows(), "benchmark": item_rows(), "pages": page_rows()}
    for name, schema in SCHEMAS.items():
        pq.write_table(pa.Table.from_pylist([] if empty else rows[name], schema), f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def odd_dir(tmp_path_factory):
    return write_tables(tmp_path_factory.mktemp("odd"))


@pytest.fixture(scope="module")
def empty_dir(tmp_path_factory):
    return write_tables(tmp_path_factory.mktemp("empty"), empty=True)
