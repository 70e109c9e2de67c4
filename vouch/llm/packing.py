"""Best-fit packing of token pieces into sequences, with swaps between underfull ones."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vouch.llm import stretches
from vouch.llm.frames import releasing
from vouch.sources.staging import settle

CAPACITY = 1024
END = 2
#: Pieces that are packed together: blocks grow in number with the input, not in size.
BLOCK = 16_384
#: Passes of the search over the bins of a block.
PASSES = 4


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: whole ones, after what is left over."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *[(s, capacity) for s in range(first, n, capacity)]]


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every piece of every document.

    A null text is empty: its only id is ``end``. Texts are encoded whole; only documents over
    the capacity are cut.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    types = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    last = np.array([end], "<u4").tobytes()

    @releasing
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or stretches.Encoder(vocabulary)
            for start, stop in stretches.slices(batch.column(1)):
                doc_ids, texts = (batch.column(i).slice(start, stop - start) for i in (0, 1))
                distinct, codes, ends = stretches.cut(texts)
                ids = encoder.encode(distinct).take(codes)
                data = ids.values.astype("<u4", copy=False).tobytes()
                bounds = 4 * np.concatenate([[0], np.cumsum(ids.lengths)[ends - 1]])
                rows = []
                for k in range(len(ends)):
                    own = data[bounds[k] : bounds[k + 1]] + last
                    for piece, (at, length) in enumerate(cut(len(own) // 4, capacity)):
                        part = own[4 * at : 4 * (at + length)]
                        rows.append((k, piece, at, length, zlib.crc32(part), *[part] * with_ids))
                which, numbers, starts, lengths, sums, *parts = zip(*rows, strict=True)
                arrays = [doc_ids.take(pa.array(which)), pa.array(numbers, pa.int32()), *[pa.array(v, pa.int64()) for v in (starts, lengths, sums)]]
                yield pa.RecordBatch.from_arrays([*arrays, *[pa.array(p, pa.binary()) for p in parts]], names=columns)

    return docs.select("doc_id", "text").mapInArrow(pieces, types)


def best_fit(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of item numbers: longest first, each to the fullest bin that has room."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = defaultdict(list)
    rooms = 0  # bit r is set if a bin has room r
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        need = lengths[item]
        if fitting := rooms >> need:
            room = need + (fitting & -fitting).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            at, room = len(bins), capacity
            bins.append([])
        bins[at].append(item)
        if left := room - need:
            by_room[left].append(at)
            rooms |= 1 << left
    return bins


def empty_bins(bins: list[list[int]], lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """The bins after exchanges that each raise the sum of squared fills, without the emptied ones.

    The least filled bin gives: it moves an item to another bin, swaps one for a shorter one,
    one for two that are shorter together, or two for one that is shorter than both. It goes
    on until it is empty or no exchange is left, then the next one gives; a pass over all bins
    is repeated while it changes anything, ``PASSES`` times at most. The search ends when no
    fewer bins could hold the items.
    """
    fill = [sum(lengths[i] for i in b) for b in bins]
    left, least = len(bins), -(-sum(lengths) // capacity)
    holders: dict[int, set[int]] = defaultdict(set)  # length -> open bins that hold an item of it
    for at, items in enumerate(bins):
        if fill[at] < capacity:
            for i in items:
                holders[lengths[i]].add(at)
    open_bins = {at for at in range(len(bins)) if fill[at] < capacity}

    def put(at: int, out: tuple[int, ...], into: tuple[int, ...]) -> None:
        for i in out:
            bins[at].remove(i)
        bins[at].extend(into)
        fill[at] += sum(lengths[i] for i in into) - sum(lengths[i] for i in out)
        for i in out:
            if all(lengths[j] != lengths[i] for j in bins[at]):
                holders[lengths[i]].discard(at)
        for i in into:
            holders[lengths[i]].add(at)
        if fill[at] == capacity:
            open_bins.discard(at)
            for i in bins[at]:
                holders[lengths[i]].discard(at)

    def exchange(giver: int) -> bool:
        others = [b for b in open_bins if b != giver and fill[b] >= fill[giver]]
        if not others:
            return False
        room = capacity - min(fill[b] for b in others)
        for x in sorted(bins[giver], key=lambda i: -lengths[i]):
            need = lengths[x]
            fits = [b for b in others if capacity - fill[b] >= need]
            if fits:
                target = max(fits, key=lambda b: (fill[b], b))
                put(target, (), (x,))
                put(giver, (x,), ())
                return True
        sets = [(i,) for i in bins[giver]] + list(combinations(bins[giver], 2))
        for out in sorted(sets, key=lambda s: -sum(lengths[i] for i in s)):
            total = sum(lengths[i] for i in out)
            for y in range(max(1, total - room), min(total, capacity)):
                for target in sorted(holders.get(y, ())):
                    if target != giver and fill[target] >= fill[giver] and fill[target] + total - y <= capacity:
                        back = next(i for i in bins[target] if lengths[i] == y)
                        put(target, (back,), out)
                        put(giver, out, (back,))
                        return True
        for x in sorted(bins[giver], key=lambda i: -lengths[i]):
            for target in others:
                for pair in combinations(bins[target], 2):
                    gain = lengths[x] - lengths[pair[0]] - lengths[pair[1]]
                    if 0 < gain <= capacity - fill[target]:
                        put(target, pair, (x,))
                        put(giver, (x,), pair)
                        return True
        return False

    for _ in range(PASSES):
        before = list(fill)
        for giver in sorted(open_bins, key=lambda b: (fill[b], b)):
            if left <= least or giver not in open_bins:
                continue
            while bins[giver] and exchange(giver):
                pass
            if not bins[giver]:
                open_bins.discard(giver)
                left -= 1
        if left <= least or fill == before:
            break
    return [b for b in bins if b]


def pack(pieces: DataFrame, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``, their place in it.

    Whole pieces are sequences of their own. The others are dealt by a hash of the row into
    blocks, whose number follows the count of pieces; each is packed in a task of its own and
    leaves one sequence or a few that could be fuller. ``pieces`` is read several times and
    must be stable: a written table or a checkpoint. An empty frame gives an empty one.
    """
    numbered = pieces.withColumn("__row", F.monotonically_increasing_id())
    whole = numbered.where(F.col("length") >= capacity)
    rest = numbered.where(F.col("length") < capacity)
    blocks = max(1, -(-rest.count() // block))
    dealt = rest.select("__row", "length", F.pmod(F.xxhash64("__row"), F.lit(blocks)).alias("__block"))

    def place(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("__row", ignore_index=True)
        lengths = rows["length"].tolist()
        bins = empty_bins(best_fit(lengths, capacity), lengths, capacity)
        sequence, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for number, items in enumerate(bins):
            at = 0
            for i in items:
                sequence[i], offset[i] = key[0] * 2**24 + number, at
                at += lengths[i]
        return pd.DataFrame({"__row": rows["__row"], "sequence_id": sequence, "offset": offset})

    placed = dealt.groupBy("__block").applyInPandas(place, "__row bigint, sequence_id bigint, offset bigint")
    alone = whole.withColumns({"sequence_id": -1 - F.col("__row"), "offset": F.lit(0).cast("bigint")})
    return rest.join(placed, "__row").unionByName(alone).drop("__row")


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = False) -> DataFrame:
    """All documents as token pieces in as few sequences of at most ``capacity`` tokens as found.

    Columns as in ``token_pieces``, with sequence_id and offset. Pieces are kept in the shared
    folder, so texts are encoded once. Repeated rows are packed as often as they occur.
    """
    return pack(settle(token_pieces(docs, vocabulary, capacity, end, with_ids)), capacity)
