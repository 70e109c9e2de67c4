"""SimHash near-duplicates: fingerprints, and links between those that differ in few bits."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vouch.llm.components import connected_components
from vouch.llm.frames import releasing
from vouch.sources.staging import settle

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: Shingles that are hashed before their bits are counted.
CHUNK = 1 << 16

#: The segments are two bits wide: 32 of them, whose counts of set bits are 0, 1 or 2.
SEGMENTS = 32
_LOW = 0x5555555555555555
_BIT_OF_BYTE = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a text: a bit is set if over half of the shingles set it."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    size = min(shingle, len(words))
    first, last = starts[: len(words) - size + 1], ends[size - 1 :]
    counts = np.zeros(64, np.int64)
    for k in range(0, len(first), CHUNK):
        pairs = zip(first[k : k + CHUNK].tolist(), last[k : k + CHUNK].tolist(), strict=True)
        hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in pairs), "<u8")
        octets = hashes.view(np.uint8).reshape(-1, 8)
        for o in range(8):
            counts[8 * o : 8 * o + 8] += np.bincount(octets[:, o], minlength=256) @ _BIT_OF_BYTE
    return sum(1 << bit for bit in np.flatnonzero(2 * counts > len(first)).tolist())


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint as a signed number), a row per row; a text is read once, whole."""

    @releasing
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.fromiter((fingerprint(t, shingle) for t in batch.column(1).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], names=["doc_id", "fingerprint"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(each, f"doc_id {kind}, fingerprint bigint")


def embed(value: Column) -> Column:
    """The counts of set bits of all segments, each written in unary (0, 1 or 11).

    Two embeddings differ in as many bits as the Manhattan distance of their counts, which is
    at most the number of bits in which the fingerprints differ.
    """
    low = F.lit(_LOW)
    other = F.shiftrightunsigned(value, 1)
    both = value.bitwiseAND(other).bitwiseAND(low)
    either = value.bitwiseOR(other).bitwiseAND(low)
    return F.shiftleft(both, 1).bitwiseOR(either)


def cells(embedded: Column, max_bits: int = MAX_BITS) -> Column:
    """The grid cells of an embedding: its projections on half of the axes.

    The axes form twice as many groups as differences are allowed. Counts at Manhattan
    distance of ``max_bits`` or less differ in that many groups at most, so they agree in all
    axes of the other half: near points share the cell of at least one projection.
    """
    groups = 2 * max(1, max_bits)
    axes = [[s for s in range(SEGMENTS) if s * groups // SEGMENTS == g] for g in range(groups)]
    masks = []
    for chosen in combinations(range(groups), groups // 2):
        mask = sum(3 << (2 * s) for g in chosen for s in axes[g])
        masks.append(mask - (1 << 64) if mask >= 1 << 63 else mask)
    return F.array(*[F.struct(F.lit(k).alias("k"), embedded.bitwiseAND(F.lit(m)).alias("at")) for k, m in enumerate(masks)])


def near_links(points: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) between representatives of different fingerprints that are near.

    ``points``: fingerprint and rep, a row per fingerprint. The cells are an equi-join; what
    shares one must pass the Manhattan bound, then the exact count of differing bits.
    """
    placed = points.withColumn("embedded", embed(F.col("fingerprint")))
    each = placed.select("rep", "fingerprint", "embedded", F.explode(cells(F.col("embedded"), max_bits)).alias("cell"))
    each = each.select("cell.k", "cell.at", "rep", "fingerprint", "embedded")
    left, right = each.alias("l"), each.alias("r")
    same_cell = (F.col("l.k") == F.col("r.k")) & (F.col("l.at") == F.col("r.at"))
    bound = F.bit_count(F.col("l.embedded").bitwiseXOR(F.col("r.embedded"))) <= max_bits
    exact = F.bit_count(F.col("l.fingerprint").bitwiseXOR(F.col("r.fingerprint"))) <= max_bits
    once = F.col("l.fingerprint") < F.col("r.fingerprint")
    joined = left.join(right, same_cell & once & bound & exact)
    return joined.select(F.col("l.rep").alias("a"), F.col("r.rep").alias("b")).distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document, a row per row.

    Equal fingerprints form one class, whose smallest doc_id stands for it, so a group of
    copies costs one row per task before the shuffle. Null and empty texts have the
    fingerprint zero and form a class like any other. Rows with a null doc_id get the component
    of their fingerprint, null if no other row has it. Fingerprints are kept in the shared
    folder: texts are hashed once.
    """
    found = settle(fingerprints(docs, shingle))
    classes = settle(found.groupBy("fingerprint").agg(F.min("doc_id").alias("rep")))
    named = connected_components(near_links(classes.where(F.col("rep").isNotNull()), max_bits))
    component = F.coalesce("component", "rep").alias("component_id")
    roots = classes.join(named, F.col("rep") == F.col("id"), "left").select("fingerprint", component)
    text = F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint")
    return found.join(roots, "fingerprint").select("doc_id", text, "component_id")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each group of near texts, that of the smallest doc_id, with its columns as they were.

    Groups are formed by fingerprints alone, so every group keeps a row, whatever its doc_ids:
    one with a null doc_id where all are null, and a doc_id of unrelated texts once for each
    group in which it is the smallest. Of rows alike in doc_id and fingerprint one stays. All columns
    are carried as they are, whatever their names and types. A text is hashed into its fingerprint
    once; survivors are then found by the MD5 of their text, and only rows that repeat one are
    compared with each other again. ``docs`` is read twice.
    """

    @F.pandas_udf("bigint")
    def hashed(texts: pd.Series) -> pd.Series:
        values = np.fromiter((fingerprint(t, shingle) for t in texts), np.uint64, len(texts))
        return pd.Series(values.view(np.int64))

    key = F.md5(F.coalesce("text", F.lit(""))).alias("key")
    texts = docs.select("doc_id", key, hashed("text").alias("fingerprint")).groupBy("fingerprint", "doc_id", "key")
    found = settle(texts.agg(F.count("*").alias("copies")))
    # null doc_ids come last, and the smallest fingerprint decides between classes of one doc_id
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fingerprint", "key", "copies")
    classes = settle(found.groupBy("fingerprint").agg(F.min(order).alias("first")))
    points = classes.select("fingerprint", F.col("fingerprint").alias("rep"))
    named = connected_components(near_links(points, max_bits))
    grouped = classes.join(named, F.col("fingerprint") == F.col("id"), "left")
    firsts = settle(grouped.groupBy(F.coalesce("component", "fingerprint")).agg(F.min("first").alias("first")))
    kept = firsts.select(F.col("first.doc_id").alias("id"), F.col("first.key").alias("kept"), "first.copies")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "doc_id", key)
    joined = whole.join(kept, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("kept")))
    if kept.where("copies > 1").isEmpty():
        return joined.select("doc.*")
    repeated = joined.where("copies > 1").groupBy("doc_id", "key").agg(F.first("doc").alias("doc"))
    return joined.where("copies = 1").select("doc").unionAll(repeated.select("doc")).select("doc.*")
