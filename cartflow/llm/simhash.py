"""SimHash near-duplicates: block keys find close fingerprints, components group them.

Every row takes part, each with a fingerprint of its whole text. NULL and blank texts have the
fingerprint zero and are linked like any other. Repeated rows share a fingerprint and so a
component. Rows without an id take part too, but a component is named by the smallest id that
is not NULL (NULL if it has none). Only the id and text columns are read.
"""

from __future__ import annotations

from itertools import combinations, repeat

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartflow.llm.common import materialize, table, unsized
from cartflow.llm.components import components

BITS = 64
SHINGLE = 4
DISTANCE = 4
#: Blocks the bits are split into. Fingerprints at most DISTANCE bits apart share BLOCKS - DISTANCE blocks, so each
#: choice of that many blocks is a key: 35 keys of 27 or 28 bits here. More blocks make longer, rarer keys.
BLOCKS = 7


def simhash(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint: bits set in over half of the hashes of the word shingles, repeats included."""
    import numpy as np
    import xxhash

    words = (text or b"").lower().split()  # for bytes both mean ASCII only
    if not words:
        return 0
    if len(words) <= shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    n = max(1, len(words) - shingle + 1)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(42)), dtype="<u8", count=n)
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, 1 << 14):  # bounded: 64 bytes for each hash
        part = hashes[at : at + (1 << 14)]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint of a text column as a bigint, over Arrow batches."""

    @F.arrow_udf("bigint")
    def of_batch(texts):
        import pyarrow as pa

        return pa.array([simhash(t.as_py(), shingle) for t in texts], pa.int64())

    return of_batch(text.cast("binary"))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def block_masks(blocks: int = BLOCKS, distance: int = DISTANCE) -> list[int]:
    """A mask for each choice of the blocks that close fingerprints must share."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:], strict=False)]
    return [_signed(sum(chosen)) for chosen in combinations(parts, blocks - distance)]


def _blocked(rows: DataFrame, masks: list[int]) -> DataFrame:
    """A row for each block key of a fingerprint."""
    fp = F.col("fp")
    keys = [F.struct(F.lit(i).alias("k"), fp.bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(masks)]
    return rows.select("*", F.inline(F.array(*keys)))


def _close(a: Column, b: Column, distance: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= distance


def _labelled(classes: DataFrame, roots: DataFrame, label: str) -> DataFrame:
    """``classes`` with ``label`` replaced by its root."""
    return (
        classes.join(roots.select(F.col("node").alias(label), "root"), label, "left")
        .withColumn(label, F.coalesce("root", label))
        .drop("root")
    )


def link_components(
    spark: SparkSession, classes: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS
) -> DataFrame:
    """``(fp, label)`` for distinct fingerprints: equal labels mean connected by links.

    Two steps avoid the pairs of dense groups, losing no link:

    1. Stars: in each block key one member is the centre, another one for each mask, and members
       close to it are linked with it. That is one row for each member and merges dense groups.
    2. The rest: only keys whose members have several labels still matter, and there only pairs of
       different labels. Members outside the key's most frequent label are compared with all
       members; what remains is one row for each pair of labels.
    """
    masks = block_masks(blocks, distance)
    keyed = _blocked(classes.select("fp"), masks)
    salts = F.array(*[F.lit(_signed((0x9E3779B97F4A7C15 * (2 * i + 1)) % (1 << 64))) for i in range(len(masks))])
    salted = F.col("fp").bitwiseXOR(F.get(salts, F.col("k")))
    centres = (
        keyed.groupBy("k", "bits")
        .agg(F.min(salted).alias("low"), F.max(salted).alias("high"))
        .filter("low < high")
        .select("k", "bits", F.col("low").bitwiseXOR(F.get(salts, F.col("k"))).alias("centre"))
    )
    stars = (
        keyed.join(unsized(centres), ["k", "bits"])
        .filter((F.col("fp") != F.col("centre")) & _close(F.col("fp"), F.col("centre"), distance))
        .select(F.col("fp").alias("a"), F.col("centre").alias("b"))
    )
    labels = _labelled(
        classes.select("fp", F.col("fp").alias("label")), components(spark, stars, "simhash-stars"), "label"
    )
    labels = materialize(spark, labels, "simhash-labels")

    keyed = _blocked(labels, masks)
    mixed = keyed.groupBy("k", "bits").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    members = materialize(
        spark, keyed.join(unsized(mixed.filter("low < high").select("k", "bits")), ["k", "bits"]), "simhash-mixed"
    )
    frequent = (
        members.groupBy("k", "bits", "label")
        .count()
        .groupBy("k", "bits")
        .agg(F.max(F.struct("count", "label"))["label"].alias("most"))
    )
    few = members.join(unsized(frequent), ["k", "bits"]).filter("label <> most")
    few = few.select("k", "bits", F.col("fp").alias("fp_b"), F.col("label").alias("b"))
    pairs = members.join(unsized(few), ["k", "bits"]).filter(
        (F.col("label") != F.col("b")) & _close(F.col("fp"), F.col("fp_b"), distance)
    )
    links = pairs.select(F.least("label", "b").alias("a"), F.greatest("label", "b").alias("b")).distinct()
    return _labelled(labels, components(spark, links, "simhash-rest"), "label")


def _grouped(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    blocks: int = BLOCKS,
) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, fp)`` of every row, and ``(fp, least_id, label)`` of every distinct fingerprint."""
    rows = docs.select(F.col(id_col).alias("doc_id"), fingerprint(F.col(text_col), shingle).alias("fp"))
    rows = materialize(spark, rows, "simhash-rows")
    classes = materialize(spark, rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-classes")
    return rows, classes.join(unsized(link_components(spark, classes, distance, blocks)), "fp")


def near_duplicates(spark: SparkSession, docs: DataFrame, **how) -> DataFrame:
    """``(doc_id, fp, component_id, label)``, a row for each row of ``docs``; ``how`` as in ``_grouped``.

    Components of repeated ids may have the same ``component_id``; their ``label``, a fingerprint, tells them apart.
    """
    rows, labels = _grouped(spark, docs, **how)
    names = labels.groupBy("label").agg(F.min("least_id").alias("component_id"))
    named = labels.select("fp", "label").join(names, "label").select("fp", "component_id", "label")
    return rows.join(unsized(named), "fp").select("doc_id", "fp", "component_id", "label")


def one_of_each(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row of each component, whole and with the columns it came with: that of the smallest id, NULL last.

    Of several texts of that id in the component the smallest fingerprint stays, of equal fingerprints any row.
    Rows are reduced to one for each fingerprint, map side first, before they meet the labels, so many equal texts
    make no hot key. Only the keys of survivors are joined with the texts.
    """
    found, labels = _grouped(spark, docs)
    counted = found.groupBy("fp", "doc_id").agg(F.count(F.lit(1)).alias("copies"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp", "copies")).alias("least")
    classes = counted.groupBy("fp").agg(least).join(unsized(labels.select("fp", "label")), "fp")
    stay = materialize(
        spark,
        classes.groupBy("label").agg(F.min("least").alias("least")).select("least.doc_id", "least.fp", "least.copies"),
        "simhash-stay",
    )
    kept = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("kept")
    rows = docs.select(kept, F.col("doc_id").alias("id"), fingerprint(F.col("text")).alias("print"))
    on = rows["id"].eqNullSafe(stay["doc_id"]) & (rows["print"] == stay["fp"])
    rows = rows.join(unsized(stay), on).select("kept", "id", "print", "copies")
    if stay.filter("copies > 1").isEmpty():
        return rows.select("kept.*")
    single = rows.filter("copies = 1").select("kept.*")
    many = rows.filter("copies > 1").groupBy("id", "print").agg(F.first("kept").alias("kept")).select("kept.*")
    return single.unionByName(many)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(spark, table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
