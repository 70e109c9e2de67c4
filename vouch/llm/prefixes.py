"""Prefix trie of conversations: which openings are shared, by whom, and what sharing saves."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vouch.llm.frames import partitions, releasing
from vouch.llm.skew import in_segments, lookup, running
from vouch.sources.staging import settle

#: The rebuilt conversations: turns come from a conversation of each ``FAMILY``, fewer than ``OPENINGS``.
FAMILY, OPENINGS = 5, 9
#: Rows of the sketch, and the bounds of its width. A cell is a byte: 48 MB at most, whatever the input.
ROWS, NARROW, WIDE = 3, 1 << 12, 1 << 24
#: Cells that travel together, and characters of the joined ids that do.
BLOCK, PIECE = 1 << 16, 1 << 20
#: A prefix digest is the sum of its turns' digests, four numbers below this.
LANE = 1 << 31
_LANES = ("l0", "l1", "l2", "l3")


def turn_digests(turns: DataFrame) -> DataFrame:
    """conv_id, turn, digest, bytes of every turn that has a conversation; no text goes on."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    return turns.where("conv_id is not null").select("conv_id", "turn", digest.alias("digest"), F.octet_length(text).cast("bigint").alias("bytes"))


def _ordered(digests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns numbered from 1 as ``pos``, and a row per conversation with its number of turns."""
    order = [F.col("turn").asc_nulls_first(), F.col("digest")]
    numbered = running(in_segments(digests, "conv_id", *order), "conv_id", order, {"pos": F.lit(1)})
    return numbered, numbered.groupBy("conv_id").agg(F.count("*").alias("n"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv_id, seg, depth, digest, bytes, last: the turns of every rebuilt conversation, with a root at depth 0.

    A conversation takes its first h turns from the one its family starts with, all of them if
    it has fewer, and goes on with its own turns after the first h; h is a checksum of its id.
    """
    numbered, sizes = _ordered(turn_digests(turns))
    numbered, sizes = settle(numbered), settle(sizes)
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % OPENINGS
    plan = sizes.select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"))
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    taken = F.least("h", F.coalesce("base_n", F.lit(0)))
    plan = plan.join(bases, "base", "left").withColumn("taken", taken)
    plan = settle(plan.withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).drop("base_n"))

    roots = plan.select("conv_id", F.lit(-2).alias("seg"), F.lit(0).cast("bigint").alias("depth"), F.lit("").alias("digest"), F.lit(0).cast("bigint").alias("bytes"), (F.col("length") == 0).alias("last"))
    openings = numbered.where(F.col("pos") < OPENINGS).select(F.col("conv_id").alias("base"), "pos", "digest", "bytes")
    heads = openings.join(plan, "base").where("pos <= h")
    heads = heads.select("conv_id", F.lit(-1).alias("seg"), F.col("pos").cast("bigint").alias("depth"), "digest", "bytes", (F.col("pos") == F.col("length")).alias("last"))
    # A long conversation meets its plan once a segment, not once a turn in one task.
    places = numbered.select("conv_id", "seg").distinct().join(plan.select("conv_id", "h", "taken", "length"), "conv_id")
    depth = (F.col("taken") + F.col("pos") - F.col("h")).cast("bigint")
    tails = numbered.join(places, ["conv_id", "seg"]).where("pos > h")
    tails = tails.select("conv_id", "seg", depth.alias("depth"), "digest", "bytes", (depth == F.col("length")).alias("last"))
    return roots.unionByName(heads).unionByName(tails)


def prefix_digests(rows: DataFrame) -> DataFrame:
    """``rows`` of ``rebuilt`` with (k1, k2), 124 bits that name the prefix up to a turn, and (p1, p2), its parent's.

    A turn's digest is taken with its depth and the digests are summed, so a prefix is
    a running sum: long conversations need no task that reads them whole.
    """
    placed = F.md5(F.concat(F.col("depth").cast("string"), F.lit(":"), "digest"))
    own = [F.conv(F.substring("placed", 8 * i + 1, 8), 16, 10).cast("bigint") % LANE for i in range(4)]
    own = [F.when(F.col("depth") > 0, lane).otherwise(F.lit(0)) for lane in own]
    rows = rows.withColumn("placed", placed).withColumns(dict(zip(_LANES, own, strict=True))).drop("placed", "digest")
    rows = running(rows, "conv_id", [F.col("depth")], {f"sum_{lane}": F.col(lane) for lane in _LANES})

    def half(a: str, b: str, less: bool) -> Column:
        one, two = (F.col(f"sum_{x}") - (F.col(x) if less else F.lit(0)) for x in (a, b))
        return (one % LANE) * LANE + two % LANE

    return rows.select(
        "conv_id", "seg", "depth", "bytes", "last",
        half("l0", "l1", False).alias("k1"), half("l2", "l3", False).alias("k2"),
        half("l0", "l1", True).alias("p1"), half("l2", "l3", True).alias("p2"),
    )


class Sketch:
    """Count-min sketch of prefix names: never below the true count, so an estimate of one is one."""

    def __init__(self, width: int = NARROW, cells: np.ndarray | None = None):
        self.cells = np.zeros((ROWS, width), np.uint8) if cells is None else cells

    def at(self, k1: np.ndarray, k2: np.ndarray) -> list[np.ndarray]:
        mask = self.cells.shape[1] - 1
        return [k1 & mask, (k1 >> 31) & mask, k2 & mask]

    def add(self, k1: np.ndarray, k2: np.ndarray) -> None:
        for row, at in zip(self.cells, self.at(k1, k2), strict=True):
            cells, counts = np.unique(at, return_counts=True)
            row[cells] = np.minimum(row[cells] + counts.clip(max=255).astype(np.int64), 255)

    def blocks(self) -> Iterator[tuple[int, bytes]]:
        """The cells in blocks, those without a count left out."""
        for number, block in enumerate(self.cells.reshape(-1, min(BLOCK, self.cells.shape[1]))):
            if block.any():
                yield number, zlib.compress(block.tobytes(), 1)

    def merge(self, number: int, packed: bytes) -> None:
        block = self.cells.reshape(-1, min(BLOCK, self.cells.shape[1]))[number]
        block[:] = np.minimum(block.astype(np.int64) + np.frombuffer(zlib.decompress(packed), np.uint8), 255)

    def estimate(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        return np.minimum.reduce([row[at] for row, at in zip(self.cells, self.at(k1, k2), strict=True)])


def sketch_of(prefixes: DataFrame, width: int) -> Sketch:
    """The sketch of all names: one per task, added up block by block, of bounded size in the driver."""
    kinds = "number int, cells binary"

    @releasing
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Sketch(width)
        for batch in batches:
            own.add(batch.column(0).to_numpy(), batch.column(1).to_numpy())
        for number, cells in own.blocks():
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([cells], pa.binary())], names=["number", "cells"])

    @releasing
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                more = np.frombuffer(zlib.decompress(cells), np.uint8)
                known[number] = np.minimum(known.get(number, np.int64(0)) + more.astype(np.int64), 255).astype(np.uint8)
        for number, cells in known.items():
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([zlib.compress(cells.tobytes(), 1)], pa.binary())], names=["number", "cells"])

    counted = prefixes.select("k1", "k2").mapInArrow(count, kinds)
    whole = Sketch(width)
    for row in counted.repartition(partitions(prefixes.sparkSession), "number").mapInArrow(merge, kinds).toLocalIterator():
        whole.merge(row["number"], bytes(row["cells"]))
    return whole


def _screened(prefixes: DataFrame, width: int | None) -> DataFrame:
    """``prefixes`` with ``shared`` and ``parent_shared``: false only for prefixes of one conversation."""
    if width is None:
        width = min(WIDE, max(NARROW, 1 << (4 * prefixes.count()).bit_length()))
    cells = prefixes.sparkSession.sparkContext.broadcast(sketch_of(prefixes, width).cells)

    @F.pandas_udf("boolean")
    def possibly_shared(k1: pd.Series, k2: pd.Series) -> pd.Series:
        return pd.Series(Sketch(cells=cells.value).estimate(k1.to_numpy(), k2.to_numpy()) > 1)

    return prefixes.withColumns({"shared": possibly_shared("k1", "k2"), "parent_shared": possibly_shared("p1", "p2")})


def _end_hashes(ends: DataFrame) -> DataFrame:
    """k1, k2, ends_sha256: SHA-256 of the ids of every node's conversations, ascending and joined by commas.

    Ids are sorted and joined by ranges, so a node of very many conversations is spread over
    tasks; only the hash itself, which has to read a node's text from start to end, runs over
    the joined pieces in one task, and holds one of them at a time.
    """

    @releasing
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, parts, size = None, None, [], 0

        def piece() -> pa.RecordBatch:
            columns = [pa.array([v], pa.int64()) for v in (*key, first)]
            return pa.RecordBatch.from_arrays([*columns, pa.array([",".join(parts)])], names=["k1", "k2", "first", "ids"])

        for batch in batches:
            for k1, k2, conv in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if (k1, k2) != key or size > PIECE:
                    if parts:
                        yield piece()
                    key, first, parts, size = (k1, k2), conv, [], 0
                parts.append(str(conv))
                size += len(parts[-1]) + 1
        if parts:
            yield piece()

    @releasing
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None

        def hashed(rows: list[tuple]) -> pa.RecordBatch:
            k1, k2, text = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(text)], names=["k1", "k2", "ends_sha256"])

        for batch in batches:
            done = []
            for k1, k2, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
                if (k1, k2) == key:
                    state.update(b",")
                else:
                    if key:
                        done.append((*key, state.hexdigest()))
                    key, state = (k1, k2), hashlib.sha256()
                state.update(ids.encode())
            if done:
                yield hashed(done)
        if key:
            yield hashed([(*key, state.hexdigest())])

    n = partitions(ends.sparkSession)
    ranged = ends.select("k1", "k2", "conv_id").repartitionByRange(n, "k1", "k2", "conv_id").sortWithinPartitions("k1", "k2", "conv_id")
    pieces = ranged.mapInArrow(join, "k1 bigint, k2 bigint, first bigint, ids string")
    return pieces.repartition(n, "k1", "k2").sortWithinPartitions("k1", "k2", "first").mapInArrow(digest, "k1 bigint, k2 bigint, ends_sha256 string")


def prefix_trie(turns: DataFrame, width: int | None = None) -> DataFrame:
    """A row per node of the trie of rebuilt conversations: conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Every prefix is counted in a sketch. Where the estimate is one the prefix belongs to
    a single conversation, and its node is written where the prefix is, as nothing else can
    know of it; only the others are shuffled and counted exactly, so an estimate that is too
    high costs work, not results. ``width`` is that of the sketch.

    ``turns`` has conv_id (a whole number), turn, role, text; other columns are ignored. Null
    role and text are empty, a null turn comes first. Turns without a conv_id are in no
    conversation and left out. Turns equal in conv_id and turn are ordered by the MD5 of their
    role and text, repeated rows are repeated turns. A conversation left without turns is
    a member of the root. No rows: no node.
    """
    rows = settle(_screened(settle(prefix_digests(rebuilt(turns))), width))
    shared, single = rows.where("shared"), rows.where("not shared")
    exact = shared.groupBy("depth", "k1", "k2").agg(
        F.count("*").alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.max("bytes").alias("bytes"),
        F.max("p1").alias("p1"),
        F.max("p2").alias("p2"),
    )
    exact = settle(exact)
    firsts = single.where("parent_shared and depth > 0")
    kids = exact.where("depth > 0").select("p1", "p2").unionAll(firsts.select("p1", "p2")).groupBy("p1", "p2").agg(F.count("*").alias("n_children"))
    kids = kids.select(F.col("p1").alias("k1"), F.col("p2").alias("k2"), "n_children")
    exact = settle(exact.join(kids, ["k1", "k2"], "left").fillna(0, ["n_children"]))

    # What a node gives to itself and the nodes above it is put on the path of its smallest member.
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(0)
    gains = exact.select("conv_id", "depth", ((F.col("n_convs") - 1) * F.col("bytes")).alias("gain"), leaf.alias("leaf"))
    path = shared.select("conv_id", "seg", "depth", "k1", "k2").join(gains.where("gain > 0 or leaf > 0"), ["conv_id", "depth"], "left")
    none = F.lit(None).cast("bigint")
    tips = single.where("last").select("conv_id", "depth", "seg", none.alias("k1"), none.alias("k2"), F.lit(0).cast("bigint").alias("gain"), F.lit(1).alias("leaf"))
    path = path.unionByName(tips).fillna(0, ["gain", "leaf"])
    above = running(path, "conv_id", [F.col("depth").desc()], {"saved": F.col("gain"), "leaves": F.col("leaf")}, backwards=True)
    above = above.where("k1 is not null and (saved > 0 or leaves > 0)")
    sums = above.groupBy("k1", "k2").agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))

    hashes = _end_hashes(shared.where("last"))
    found = exact.join(sums, ["k1", "k2"], "left").join(hashes, ["k1", "k2"], "left")
    nobody = F.sha2(F.lit(""), 256)
    found = found.select(
        "conv_id", "depth", "p1", "p2", "n_convs", "n_children",
        F.coalesce("n_leaves", F.lit(0)).alias("n_leaves"), F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"),
        F.coalesce("ends_sha256", nobody).alias("ends_sha256"),
    )
    alone = single.select(
        "conv_id", "depth", "p1", "p2", "parent_shared", F.lit(1).cast("bigint").alias("n_convs"),
        F.when(F.col("last"), 0).otherwise(1).cast("bigint").alias("n_children"), F.lit(1).cast("bigint").alias("n_leaves"),
        F.lit(0).cast("bigint").alias("saved_tokens"),
        F.when(F.col("last"), F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(nobody).alias("ends_sha256"),
    )
    firsts, inner = alone.where("parent_shared").drop("parent_shared"), alone.where("not parent_shared").drop("parent_shared")
    parents = exact.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent"), "n_children")
    total = exact.agg(F.sum("n_children")).first()[0] or 0
    asking = found.unionByName(firsts).withColumnRenamed("n_children", "own_children")
    asked = lookup(asking, parents, ["p1", "p2"], F.col("n_children"), total)
    asked = asked.drop("n_children").withColumnRenamed("own_children", "n_children")
    nodes = asked.unionByName(inner.withColumn("parent", F.col("conv_id")))
    # A parent that is no exact node has a single member, the node's own.
    parent = F.when(F.col("depth") > 0, F.coalesce("parent", "conv_id"))
    return nodes.select("conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
