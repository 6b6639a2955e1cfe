"""Operators beyond their queries: files, parameters, sketches, plans."""

from __future__ import annotations

import gzip
import io
import os

import numpy as np
import pytest
from fixtures import odd_dir, page_rows  # noqa: F401
from pyspark.sql import functions as F

from cartflow.llm import decontaminate, jump_shards, quality, repeats, url_lists, warc


def files_of(root):
    return {f: open(os.path.join(root, f), "rb").read() for f in sorted(os.listdir(root)) if f.endswith(".gz")}


def test_archives_are_the_same_however_pages_lie(spark, odd_dir, tmp_path):
    pages = spark.read.parquet(f"{odd_dir}/pages.parquet")
    made = []
    for i, rows in enumerate((pages, pages.orderBy("html").repartition(5))):
        root = f"{tmp_path}/{i}"
        manifest = warc.write_archive(spark, rows, root, shard_bytes=6000, roll_bytes=700)
        files = files_of(root)
        assert {r["name"]: r["bytes"] for r in manifest.collect()} == {f: len(d) for f, d in files.items()}
        made.append(files)
    assert made[0] == made[1]
    assert len({f.split("-")[1] for f in made[0]}) > 1 and any("-00001." in f for f in made[0])
    whole = b"".join(gzip.decompress(d) for d in made[0].values())
    assert whole.count(b"WARC/1.1\r\n") == len(page_rows()) + len(made[0])


def test_shards_files_and_reads_have_tasks_of_their_own(spark, tmp_path):
    rows = spark.range(400).select(
        F.col("id").alias("page_id"), F.lit("http://a.b/").alias("url"), F.repeat(F.sha2(F.col("id").cast("string"), 512), 20).alias("html")
    )
    root = f"{tmp_path}/a"
    manifest = warc.write_archive(spark, rows, root, shard_bytes=64_000, roll_bytes=5_000)
    shards = {r["shard"] for r in manifest.collect()}
    assert len(shards) > 10 and manifest.count() > len(shards)
    read = warc.read_archive(spark, root)
    counts = read.groupBy(F.spark_partition_id()).count().collect()
    assert len(counts) > manifest.count() // 2 and sum(r["count"] for r in counts) == 400
    assert "_temporary" not in os.listdir(root)


def test_default_files_roll(spark, tmp_path):
    # Payloads that don't compress: a shard of them is several files, as the roll size is a share of the shard.
    rows = spark.createDataFrame([(i, "http://a.b/", os.urandom(9000)) for i in range(60)], "page_id int, url string, html binary")
    manifest = warc.write_archive(spark, rows, f"{tmp_path}/a", shard_bytes=200_000)
    assert max(r["number"] for r in manifest.collect()) >= 4
    assert warc.read_archive(spark, f"{tmp_path}/a").count() == 60


def test_archives_keep_payloads(spark, odd_dir, tmp_path):
    warc.write_archive(spark, spark.read.parquet(f"{odd_dir}/pages.parquet"), f"{tmp_path}/a")
    read = warc.read_archive(spark, f"{tmp_path}/a").collect()
    found = sorted((r["page_id"] is None, r["page_id"], bytes(r["payload"])) for r in read if r["payload"] is not None)
    pages = {(r["page_id"], (r["html"] or "").encode()) for r in page_rows()}
    assert {(i, p) for _, i, p in found} <= pages
    assert {p for _, _, p in found} == {p for _, p in pages}  # no payload is lost to revisits


def test_damaged_archives_are_noticed(spark, odd_dir, tmp_path):
    root = f"{tmp_path}/a"
    warc.write_archive(spark, spark.read.parquet(f"{odd_dir}/pages.parquet"), root)
    name, data = next(iter(files_of(root).items()))
    with open(os.path.join(root, name), "wb") as out:
        out.write(data[:-30])
    with pytest.raises(Exception, match="inside a record"):
        warc.read_archive(spark, root).collect()


def test_members_across_reads():
    data = b"".join(warc._member([("WARC-Record-ID", str(i))], b"x" * i, 1) for i in range(50))
    for size in (1, 7, 1000):
        stream = io.BytesIO(data)
        blocks = [warc.parse_record(m)[1] for m in warc.members(lambda _, n=size, s=stream: s.read(n))]
        assert blocks == [b"x" * i for i in range(50)]


def test_gaps():
    for places in ([0], [0, 0, 5], [254, 255, 256, 511, 512, 513], [1000000], sorted(np.random.default_rng(1).integers(0, 1 << 20, 5000))):
        assert list(repeats.decode_gaps(repeats.encode_gaps(np.array(places)))) == list(places)


def test_small_sketch_loses_nothing(spark, odd_dir, monkeypatch):
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    key = ["doc_id", "n_words", "n_removed", "kept_text"]
    whole = sorted(map(tuple, repeats.without_repeats(spark, docs).select(key).collect()), key=repr)
    for name, value in (("CHUNK", 40), ("CANDIDATE_CHUNK", 30), ("SLICE_WORDS", 30), ("PART", 1 << 8)):
        monkeypatch.setattr(repeats, name, value)
    small = repeats.without_repeats(spark, docs.repartition(3), max_cells=1 << 8).select(key).collect()
    assert sorted(map(tuple, small), key=repr) == whole
    assert any(row[2] for row in whole)


def test_texts_without_an_id_keep_their_own_places(spark):
    one, other = (" ".join(f"w{j}x{n}" for j in range(14)) for n in (18031, 176266))  # equal in their 32-bit hash
    docs = spark.createDataFrame([(1, one + " end"), (None, one), (None, other), (None, one)], "doc_id bigint, text string")
    found = repeats.without_repeats(spark, docs).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    expected = [(1, 15, 0, one + " end"), (None, 14, 14, ""), (None, 14, 0, other), (None, 14, 14, "")]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_rows_equal_in_id_and_text_are_candidates_once():
    import pyarrow as pa

    class Sketch:
        value = np.full(repeats.ROWS * repeats.PART // 8, 255, np.uint8)

    text = " ".join(f"w{i}" for i in range(30)).encode()
    for ids in ([7] * 50, [1] + [7] * 49):
        rows = {"id": ids, "tag": [5] * 50, "text": [text] * 50}
        made = pa.Table.from_batches(repeats._candidates(Sketch, repeats.PART, 13)([pa.RecordBatch.from_pydict(rows)])).to_pylist()
        assert sum(len(r["highs"]) for r in made if not r["own"]) == 18
        assert [len(r["places"]) // 4 for r in made if r["own"]] == [18] * (len(set(ids)) - 1)


def test_candidates_are_sent_in_small_batches(monkeypatch):
    import pyarrow as pa

    class Sketch:
        value = np.full(repeats.ROWS * repeats.PART // 8, 255, np.uint8).tobytes()

    rows = {"id": [3, 1, 2] * 20, "tag": list(range(60)), "text": [" ".join(f"w{i % 41}" for i in range(n, n + 60)).encode() for n in range(60)]}

    def batches():
        return list(repeats._candidates(Sketch, repeats.PART, 13)([pa.RecordBatch.from_pydict(rows)]))

    def sent(found):
        return sorted(map(repr, pa.Table.from_batches(found).to_pylist()))

    whole = batches()
    monkeypatch.setattr(repeats, "SENT", 8)
    small = batches()
    assert len(small) > len(whole) and sent(small) == sent(whole)
    windows = [sum(map(len, b.column("highs").to_pylist())) for b in small if not b.column("own")[0].as_py()]
    assert all(n <= 8 or b.num_rows == 1 for n, b in zip(windows, small, strict=False))


def test_sketch_counts_fewer_anchors_than_windows():
    import pyarrow as pa

    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 1 << 40, 3000)).encode() for _ in range(4)]
    made = list(repeats._sketch_parts(repeats.PART, 13)([pa.RecordBatch.from_pydict({"text": texts})]))
    cells = sum(len(repeats.decode_gaps(g.as_py())) for b in made for g in b.column("gaps"))
    assert 0 < cells < 0.4 * repeats.ROWS * 4 * (3000 - 12)


def test_equal_windows_have_equal_anchors():
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(w).encode() for w in (["a", "b", *words, "c"], words, ["x"] * 300 + words)]
    found = {}
    for number, place, anchor, hashes in repeats.anchored(texts, 13):
        for n, at, value, high in zip(number, place, anchor, hashes(np.arange(len(number))), strict=True):
            found[n, at - (2, 0, 300)[n]] = value, high
    for at in range(28):
        assert found[0, at] == found[1, at] == found[2, at]
    assert len({v for _, v in (found[1, at] for at in range(28))}) == 28


@pytest.mark.parametrize("size", [1, 3, 7, 1000])
@pytest.mark.parametrize("runs", [5, 1 << 19])
def test_later_windows_however_batches_are_cut(monkeypatch, size, runs):
    """Few anchors and hashes, so that groups go over batches; against all rows at once."""
    import pyarrow as pa

    monkeypatch.setattr(repeats, "RUNS", runs)
    rng = np.random.default_rng(size)
    rows, expected = [], set()
    for n in range(150):
        deal, own, at = int(rng.choice([-9, -9, 4, *range(10, 60)])), bool(rng.random() < 0.1), int(rng.integers(0, 50))
        doc = {"id": int(rng.integers(0, 20)), "tag": int(rng.integers(0, 3))}
        if own:
            places = sorted({int(x) for x in rng.integers(0, 30, 6)})
            rows.append({"deal": deal, "highs": b"", "place": None, "places": np.array(places, "<i4").tobytes(), **doc})
            expected |= {(doc["id"], doc["tag"], p) for p in places}
        else:
            highs = rng.integers(0, 4, rng.integers(1, 5)).astype(np.uint64)
            rows.append({"deal": deal, "highs": highs.tobytes(), "place": at, "places": None, **doc})
    windows = [
        (r["deal"], h, r["id"], r["tag"], r["place"] + j)
        for r in rows for j, h in enumerate(np.frombuffer(r["highs"], np.uint64))
    ]
    first = {}
    for deal, high, doc_id, _, _ in windows:
        first[deal, high] = min(first.get((deal, high), doc_id), doc_id)
    expected |= {(i, tag, p) for deal, high, i, tag, p in windows if i > first[deal, high]}
    kinds = {"deal": pa.int64(), "id": pa.int64(), "tag": pa.int64(), "place": pa.int32(), "highs": pa.binary(), "places": pa.binary()}
    rows.sort(key=lambda r: (r["deal"], r["id"]))
    table = pa.Table.from_pylist(rows, pa.schema(list(kinds.items())))
    found = [r for b in repeats._later(iter(table.to_batches(max_chunksize=size))) for r in b.to_pylist()]
    places = set()
    for r in found:
        for start, length in np.frombuffer(r["runs"], "<i4").reshape(-1, 2):
            places |= {(r["id"], r["tag"], int(start) + k) for k in range(length)}
    assert places == expected and len(expected) > 100
    assert list(repeats._later(iter([]))) == []


def test_benchmark_in_blocks(spark, odd_dir):
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    items = spark.read.parquet(f"{odd_dir}/benchmark.parquet")

    def found(**limits):
        rows = decontaminate.scanned(spark, docs, items, **limits).select("row.doc_id", "found").collect()
        return sorted(map(tuple, rows), key=repr)

    assert found(block_words=5) == found()
    text = {r["doc_id"]: r["text"] for r in docs.filter("doc_id IS NOT NULL").collect()}
    spans = [(text[i], s) for i, f in found() if i is not None for s in f["spans"]]
    assert any("BOILING POINT" in t[s["start"] : s["end"]] for t, s in spans)


def test_blocks_keep_to_their_limit(spark):
    text = [f"w{i}" for i in range(95)]
    items = spark.createDataFrame([(1, "a b"), (2, " ".join(text)), (3, "c d"), (4, "")], "item_id int, text string")
    for limit, window in ((20, 10), (10, 10), (3, 10), (94, 10), (95, 10), (1000, 10), (7, 1)):
        blocks = list(decontaminate.item_blocks(items, "item_id", "text", limit, window))
        assert all(sum(len(t.split()) for _, t in b) <= max(limit, window) for b in blocks)
        made = [tuple(w[i : i + window]) for b in blocks for k, t in b if k == "2" for w in [t.decode().split()]
                for i in range(len(w) - window + 1)]
        assert made == [tuple(text[i : i + window]) for i in range(len(text) - window + 1)]
        assert [k for b in blocks for k, _ in b if k != "2"] == ["1", "3", "4"]


def test_items_without_an_id_hit_but_are_not_listed(spark):
    docs = spark.createDataFrame([(1, "say one two now"), (2, "one three")], "doc_id int, text string")
    items = spark.createDataFrame([(None, "one two"), (7, "say one")], "item_id int, text string")
    rows = {r["row"]["doc_id"]: r["found"] for r in decontaminate.scanned(spark, docs, items).collect()}
    assert (rows[1]["n_hit"], rows[1]["items"], rows[1]["runs"]) == (3, ["7"], [0, 3])
    assert rows[2]["n_hit"] == 0
    assert [r["doc_id"] for r in decontaminate.clean_rows(spark, docs, items).collect()] == [2]


def test_stop_words_are_asked_of_listed_languages_only(spark):
    polish = " ".join(f"zażółć gęślą{i} jaźń numer{i} bardzo" for i in range(20))
    english = " ".join(f"the word{i} of sentence{i}" for i in range(20))
    texts = [(1, polish, "pl"), (2, polish, None), (3, polish, "en"), (4, polish, "EN-gb"), (5, english.upper(), "en"), (6, english, "de")]
    docs = spark.createDataFrame(texts, "doc_id int, text string, lang string")
    failed = {r["doc_id"]: r["failed_rules"] for r in quality.judged(docs, "doc_id").collect()}
    assert failed == {1: "", 2: "", 3: "stop_words", 4: "stop_words", 5: "", 6: ""}
    assert sorted(r["doc_id"] for r in quality.kept_rows(docs).collect()) == [1, 2, 5, 6]
    assert quality.kept_rows(docs.drop("lang")).count() == 6


def test_rule_table_is_one_projection(spark, odd_dir):
    rows = quality.judged(spark.read.parquet(f"{odd_dir}/documents.parquet"), "doc_id")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
    strict = quality.judged(
        spark.read.parquet(f"{odd_dir}/documents.parquet"), "doc_id", base=(quality.Rule("long", "n_words", low=10**6),), method=()
    )
    assert {r["failed_rules"] for r in strict.collect()} == {"long"}


@pytest.mark.parametrize("query", [jump_shards.op4_sharding, url_lists.op2_url_filters])
def test_native_operators_run_no_python(spark, odd_dir, query):
    plan = query(spark, odd_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_list_entries_hold_from_day_to_day(spark):
    events = spark.createDataFrame(
        [
            ("l", "example.com", False, True, 5), ("l", "example.com", False, False, 10), ("l", "example.com", False, True, 10),
            ("l", "example.com", False, False, 20), ("l", "example.com", False, False, 20), ("a", "www.example.com", True, True, 7),
            ("a", "www.example.com", True, False, 9), ("b", "www.example.com/x", False, True, 0), ("b", None, False, True, 0),
            ("b", "other.org", False, True, None),
        ],
        "list string, key string, allows boolean, adds boolean, day int",
    )
    days = [(d,) for d in (None, 4, 5, 8, 9, 10, 19, 20)]
    captures = spark.createDataFrame(days, "day int").selectExpr("'www.example.com' host", "'' segment", "day")
    for block_days in (1, 7, 64):
        found = url_lists.judged(captures, url_lists.validity(events), block_days).collect()
        verdicts = {r["day"]: r["verdict"] for r in found}
        assert verdicts == {
            None: "unlisted", 4: "unlisted", 5: "block", 8: "allow", 9: "block", 10: "block", 19: "block", 20: "unlisted"
        }
    path = spark.createDataFrame([("www.example.com", "x", 8)], "host string, segment string, day int")
    assert url_lists.judged(path, url_lists.validity(events)).first()["verdict"] == "block"
