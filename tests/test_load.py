from __future__ import annotations

import csv
import io
import random
from contextlib import contextmanager
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cartflow import jobs
from cartflow.schemas import RAW_TABLES
from cartflow.sources import raw_tables
from cartflow.sources.csv_files import read_rows
from cartflow.sources.raw_tables import load_table

REVIEW_HEADER = "review_id,order_id,review_score,review_comment_title,review_comment_message"


def load(spark, tmp_path, table, text, encoding="utf-8"):
    path = tmp_path / "data.csv"
    path.write_bytes(text.encode(encoding))
    return load_table(spark, RAW_TABLES[table], str(path))



@pytest.fixture(params=["as declared", "all put together"])
def reading(request, monkeypatch):
    """Tables read as they declare, and with all records put together from lines."""
    if request.param == "all put together":
        monkeypatch.setattr(raw_tables, "read_rows", lambda spark, location, breaks: read_rows(spark, location, True))


@pytest.mark.usefixtures("reading")
def test_bom_is_not_part_of_the_first_column(spark, tmp_path):
    text = "﻿product_category_name,product_category_name_english\nbeleza,beauty\n"
    rows = load(spark, tmp_path, "category_translation", text).collect()
    assert [(r[0], r[1]) for r in rows] == [("beleza", "beauty")]


@pytest.mark.usefixtures("reading")
def test_quoted_newline_and_doubled_quote(spark, tmp_path):
    text = f'{REVIEW_HEADER}\nr1,o1,5,"a, b","line 1\nline ""2"""\nr2,o2,4,,\n'
    rows = load(spark, tmp_path, "order_reviews", text).orderBy("review_id").collect()
    assert rows[0]["review_comment_title"] == "a, b"
    assert rows[0]["review_comment_message"] == 'line 1\nline "2"'
    assert rows[1]["review_score"] == 4
    assert len(rows) == 2


@pytest.mark.usefixtures("reading")
def test_empty_and_quoted_empty_are_null(spark, tmp_path):
    rows = load(spark, tmp_path, "order_reviews", f'{REVIEW_HEADER}\nr1,o1,5,,""\n').collect()
    assert rows[0]["review_comment_title"] is None
    assert rows[0]["review_comment_message"] is None


@pytest.mark.usefixtures("reading")
def test_columns_are_taken_by_name(spark, tmp_path):
    text = "seller_state,unknown,seller_id\nSP,x,s1\n"
    row = load(spark, tmp_path, "sellers", text).first()
    assert (row["seller_id"], row["seller_state"], row["seller_city"]) == ("s1", "SP", None)
    assert "unknown" not in row.asDict()


@pytest.mark.usefixtures("reading")
def test_ragged_and_blank_lines(spark, tmp_path):
    text = "seller_id,seller_zip_code_prefix,seller_city,seller_state\na\n\nb,1,c,SP,extra\n\n"
    rows = load(spark, tmp_path, "sellers", text).orderBy("seller_id").collect()
    assert [tuple(r)[:4] for r in rows] == [("a", None, None, None), ("b", "1", "c", "SP")]


@pytest.mark.usefixtures("reading")
def test_windows_line_ends(spark, tmp_path):
    text = f'{REVIEW_HEADER}\r\nr1,o1,5,t,"x\r\ny"\r\nr2,o2,4,t,z\r\n'
    rows = load(spark, tmp_path, "order_reviews", text).orderBy("review_id").collect()
    assert [r["review_comment_message"] for r in rows] == ["x\r\ny", "z"]


@pytest.mark.usefixtures("reading")
def test_first_row_of_a_key_wins_and_copies_are_counted(spark, tmp_path):
    text = "seller_id,seller_city\na,first\nb,only\na,second\na,third\n"
    rows = load(spark, tmp_path, "sellers", text).orderBy("seller_id").collect()
    assert [(r["seller_id"], r["seller_city"], r["load_copies"]) for r in rows] == [("a", "first", 3), ("b", "only", 1)]


def test_first_row_wins_over_files_by_name(spark, tmp_path):
    for name, city in (("b.csv", "second"), ("a.csv", "first"), ("c.csv", "third")):
        (tmp_path / name).write_text(f"seller_id,seller_city\nx,{city}\n")
    row = load_table(spark, RAW_TABLES["sellers"], str(tmp_path)).first()
    assert (row["seller_city"], row["load_copies"]) == ("first", 3)


def test_table_without_key_keeps_copies(spark, tmp_path):
    text = "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng\n1,1.2345678,-2.5\n1,1.2345678,-2.5\n"
    rows = load(spark, tmp_path, "geolocation", text).collect()
    assert len(rows) == 2
    assert rows[0]["geolocation_lat"] == Decimal("1.234568")


def test_translation_without_key_is_dropped(spark, tmp_path):
    text = "product_category_name,product_category_name_english\n,none\na,b\n"
    assert load(spark, tmp_path, "category_translation", text).count() == 1


def test_types(spark, tmp_path):
    text = (
        "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
        "o,1,p,s,2017-09-19 09:45:35,58.905,-0.005\n"
    )
    row = load(spark, tmp_path, "order_items", text).first()
    assert row["shipping_limit_date"] == datetime(2017, 9, 19, 9, 45, 35)
    assert (row["price"], row["freight_value"]) == (Decimal("58.91"), Decimal("-0.01"))


@pytest.mark.parametrize(
    ("table", "text", "message"),
    [
        ("order_items", "order_id,order_item_id\no,12.0\n", "order_item_id is not a valid int"),
        ("order_items", "order_id,order_item_id,price\no,1,abc\n", "price is not a valid decimal"),
        ("order_items", "order_id,order_item_id,price\no,1,123456789.00\n", "price is not a valid decimal"),
        ("order_items", "order_id,order_item_id\no,\n", "order_item_id must not be empty"),
        ("order_reviews", "review_id,order_id,review_score\nr,o,40000\n", "review_score is not a valid smallint"),
        ("orders", "order_id,order_approved_at\no,soon\n", "order_approved_at is not a valid timestamp_ntz"),
        ("sellers", "seller_id,seller_state\ns,SPX\n", "seller_state longer than 2"),
        ("sellers", "seller_id\n\"\"\n", "seller_id must not be empty"),
    ],
)
def test_value_that_does_not_fit_fails_the_load(spark, tmp_path, table, text, message):
    with pytest.raises(Exception, match=message):
        load(spark, tmp_path, table, text).collect()


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strictness_does_not_depend_on_the_session(spark, tmp_path, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="not a valid int"):
            load(spark, tmp_path, "order_items", "order_id,order_item_id\no,x\n").collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_blanks_beyond_the_length_are_cut(spark, tmp_path):
    row = load(spark, tmp_path, "sellers", "seller_id,seller_state\ns,SP   \n").first()
    assert row["seller_state"] == "SP"


def test_missing_file_gives_an_empty_table(spark, tmp_path, caplog):
    rows = load_table(spark, RAW_TABLES["orders"], str(tmp_path / "*_orders_dataset.csv"))
    assert rows.count() == 0
    assert set(RAW_TABLES["orders"].columns) < set(rows.columns)
    assert "is empty" in caplog.text


def test_missing_column_is_reported(spark, tmp_path, caplog):
    load(spark, tmp_path, "sellers", "seller_id\ns\n")
    assert "no column seller_zip_code_prefix" in caplog.text


def test_files_with_other_headers_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("seller_id,seller_city\na,x\n")
    (tmp_path / "b.csv").write_text("seller_city,seller_id\nx,a\n")
    with pytest.raises(Exception):
        load_table(spark, RAW_TABLES["sellers"], str(tmp_path)).collect()


def random_records(rng, count):
    alphabet = ["a", "b", " ", ",", '"', "\n", "é", ";", "\n\n", '""']
    return [[str(n), "".join(rng.choice(alphabet) for _ in range(rng.randrange(12)))] for n in range(count)]


@pytest.mark.parametrize("seed", range(4))
def test_split_files_equal_the_csv_module(spark, tmp_path, seed):
    """Records over many blocks, with line breaks inside quotes, against the csv module."""
    rng = random.Random(seed)
    records = random_records(rng, 400)
    expected = {}
    for number in range(2):
        out = io.StringIO()
        writer = csv.writer(out, lineterminator="\n")
        writer.writerow(["review_id", "text"])
        writer.writerows(records)
        (tmp_path / f"part{number}.csv").write_text(out.getvalue(), encoding="utf-8")
        for key, text in csv.reader(io.StringIO(out.getvalue())):
            expected[key] = text
    del expected["review_id"]
    with splits(spark, 257):
        rows = read_rows(spark, str(tmp_path))
        assert rows.select("_seq_block").distinct().count() > 5
        found = rows.groupBy("review_id").agg(
            F.collect_set(F.coalesce("text", F.lit(""))).alias("texts"), F.count("*").alias("n")
        )
        found = {r["review_id"]: (r["texts"], r["n"]) for r in found.collect()}
        order = [r["review_id"] for r in rows.orderBy("_seq_file", "_seq_block", "_seq_row").collect()]
    assert found == {key: ([text], 2) for key, text in expected.items()}
    assert order == [key for key, _ in records] * 2


@contextmanager
def splits(spark, size):
    """Files cut into blocks of ``size`` bytes."""
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "16")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def by_csv_module(text):
    """Rows of a file by the csv module, as dictionaries; empty fields are None."""
    return [
        {k: v or None for k, v in row.items() if k is not None}
        for row in csv.DictReader(io.StringIO(text, newline=""))
    ]


def spoiled_file(rng, line_end):
    """Lines of fields with stray, doubled and closing quotes; the last field closes whatever is open."""
    pieces = ['"', '""', ",", "a", "b c", " ", '5" x', '"q"', '"x""y"', '"m\nn"', '"\n\n, z"', '"c"d', "é", '"r\r\ns"', "   "]
    lines = ["k,v,w"]
    for n in range(300):
        value = "".join(rng.choice(pieces) for _ in range(rng.randrange(5)))
        lines.append(f"{n},{value}" if rng.random() < 0.9 else rng.choice(["", "  ", ",,"]))
    text = line_end.join(lines) + line_end
    for tail in ("", '"' + line_end):
        rows = by_csv_module(text + tail)
        # A file that ends inside quotes has its last record run to the end.
        if not ends_open(text + tail):
            return text + tail, rows
    raise AssertionError


def ends_open(text):
    """Character by character: whether the file ends inside a quoted field."""
    state = "start"
    for i, c in enumerate(text):
        if state == "quoted":
            state = "quote" if c == '"' else state
        elif state == "quote" and c == '"':
            state = "quoted"
        elif c in ",\n" or (c == "\r" and text[i + 1 : i + 2] == "\n"):
            state = "start"
        elif state == "start" and c == '"':
            state = "quoted"
        else:
            state = "field"
    return state == "quoted"


@pytest.mark.parametrize("seed", range(3))
def test_stray_quotes_equal_the_csv_module(spark, tmp_path, seed):
    rng = random.Random(seed)
    text, expected = spoiled_file(rng, "\r\n" if seed % 3 == 2 else "\n")
    (tmp_path / "a.csv").write_text(text, encoding="utf-8", newline="")
    with splits(spark, rng.choice([97, 313, 1000, 1 << 20])):
        rows = read_rows(spark, str(tmp_path)).orderBy("_seq_file", "_seq_block", "_seq_row").collect()
    found = [{c: r[c] or None for c in ("k", "v", "w")} for r in rows]
    assert found == [{c: row.get(c) for c in ("k", "v", "w")} for row in expected]


def test_literal_quotes_lose_no_rows(spark, tmp_path):
    text = f'{REVIEW_HEADER}\nr1,o1,5,tv 5" wide,ok\nr2,o2,4,plain,fine\nr3,o3,3,x,y 7"\nr4,o4,2,"a ""b""\n",z\n'
    rows = load(spark, tmp_path, "order_reviews", text).orderBy("review_id").collect()
    assert [r["review_comment_title"] for r in rows] == ['tv 5" wide', "plain", "x", 'a "b"\n']
    assert [r["review_comment_message"] for r in rows] == ["ok", "fine", 'y 7"', "z"]


def test_last_of_equal_headers_counts(spark, tmp_path):
    text = "review_id,order_id,review_score,review_score\nr,o,1,2\n"
    assert load(spark, tmp_path, "order_reviews", text).first()["review_score"] == 2


def test_blank_lines_within_texts_and_between_records(spark, tmp_path):
    text = f'{REVIEW_HEADER}\n\nr1,o1,5,t,"a\n\n  \nb"\n\n'
    rows = load(spark, tmp_path, "order_reviews", text).collect()
    assert [r["review_comment_message"] for r in rows] == ["a\n\n  \nb"]
    with pytest.raises(Exception, match="must not be empty"):  # a record with one blank field
        load(spark, tmp_path, "order_reviews", f"{REVIEW_HEADER}\n  \n").collect()


@pytest.mark.parametrize("size", [8 << 20, 128 << 20])
def test_long_texts_load_at_any_split_size(spark, tmp_path, size):
    body = "some words, and more\n" * 1_000_000  # 21 MB in one field
    text = f'{REVIEW_HEADER}\nr1,o1,5,t,"{body}"\nr2,o2,4,t,x\n'
    with splits(spark, size):
        rows = load(spark, tmp_path, "order_reviews", text)
        lengths = rows.select("review_id", F.length("review_comment_message").alias("n")).orderBy("review_id")
        assert [tuple(r) for r in lengths.collect()] == [("r1", len(body)), ("r2", 1)]


@pytest.mark.parametrize("size", [300, 1 << 20])
def test_unclosed_quote_fails_at_any_size(spark, tmp_path, size):
    (tmp_path / "a.csv").write_text('review_id,text\n1,"open\n' + "x\n" * 100)
    with splits(spark, size), pytest.raises(Exception, match="unclosed quote"):
        read_rows(spark, str(tmp_path)).collect()


def test_line_breaks_that_are_not_declared_fail(spark, tmp_path):
    with pytest.raises(Exception, match="line break in quotes"):
        load(spark, tmp_path, "sellers", 'seller_id,seller_city\na,"x\ny"\n').collect()


@pytest.mark.parametrize("breaks", [True, False])
def test_other_headers_fail(spark, tmp_path, breaks):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    (tmp_path / "b.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception):
        read_rows(spark, str(tmp_path), breaks).collect()


@pytest.mark.parametrize("breaks", [True, False])
def test_jobs_do_not_grow_with_files(spark, tmp_path, breaks):
    def jobs_for(files):
        folder = tmp_path / f"{files}"
        folder.mkdir()
        for i in range(files):
            (folder / f"{i:03}.csv").write_text(f'k,v\n{i},"x{chr(10) if breaks else " "}y"\n')
        tracker, group = spark.sparkContext.statusTracker(), f"{breaks}-{files}"
        spark.sparkContext.setJobGroup(group, "")
        try:
            assert read_rows(spark, str(folder), breaks).count() == files
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(tracker.getJobIdsForGroup(group))

    assert jobs_for(20) <= jobs_for(3) + 2  # tasks are put together in other ways


def test_only_the_exact_file_is_loaded(spark, settings):
    for name in ("shop_orders_dataset.csv", "old_orders_dataset.csv"):
        with open(f"{settings.csv_dir}/{name}", "w") as out:
            out.write(f"order_id\n{name}\n")
    jobs.load(spark, settings)
    assert [r["order_id"] for r in jobs.raw_tables(spark, settings)["orders"].collect()] == ["shop_orders_dataset.csv"]
