"""Byte-level BPE: ranked merges folded over the bytes of distinct words; decoding concatenates pieces.

Spark cuts the texts and joins the pieces again with higher-order functions. The fold itself runs in
tasks on Arrow batches, as a fold in higher-order functions took too long (figures in the README).
"""

from __future__ import annotations

import base64
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of more bytes are folded one by one with a heap, the others together.
LONG = 64
#: Bytes of words of equal length that are folded together.
CELLS = 1 << 20
#: The rank of two parts that no merge joins.
NONE = np.iinfo(np.int32).max


@dataclass(frozen=True)
class Vocabulary:
    """Pieces of bytes by rank, and the pattern that cuts a text into words."""

    pieces: dict[bytes, int]
    pattern: str

    @classmethod
    def read(cls, path: str, pattern: str) -> Vocabulary:
        """From the driver's file of base64 pieces and their ranks; it travels with the job."""
        with open(path, "rb") as file:
            pairs = [line.split() for line in file if line.strip()]
        return cls({base64.b64decode(piece): int(rank) for piece, rank in pairs}, pattern)


class Merges:
    """The literal rank map: which two ids of a vocabulary join to which, in sorted arrays."""

    def __init__(self, pieces: dict[bytes, int]):
        if missing := [b for b in range(256) if bytes([b]) not in pieces]:
            raise ValueError(f"bytes without a piece: {missing}")
        joined = {}
        for piece, rank in pieces.items():
            for k in range(1, len(piece)):
                left, right = pieces.get(piece[:k]), pieces.get(piece[k:])
                if left is not None and right is not None:
                    joined[left << 32 | right] = rank
        self.pairs = np.array([*sorted(joined), np.iinfo(np.int64).max])  # the last one ends the search
        self.ranks = np.array([*(joined[pair] for pair in sorted(joined)), NONE], np.int32)
        self.octets = np.array([pieces[bytes([b])] for b in range(256)], np.int32)
        self.pieces = pa.array(list(pieces), pa.binary())
        self.ids = np.array(list(pieces.values()), np.int32)

    @cached_property
    def joined(self) -> dict[int, int]:
        """The rank map for single lookups, made in the task that first meets a long word."""
        return dict(zip(self.pairs.tolist(), self.ranks.tolist(), strict=True))

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id that two ids join to, which is also the rank of their merge."""
        pair = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.pairs, pair)
        return np.where(self.pairs[at] == pair, self.ranks[at], NONE)

    def fold(self, octets: np.ndarray) -> np.ndarray:
        """The ids of words of equal length, a row each: -1 where a part went into the one before.

        Each step joins, in all words at once, the adjacent pair of lowest rank, the leftmost of
        equal ones, and ranks the two pairs that this makes.
        """
        rows, n = octets.shape
        ids = self.octets[octets]
        after = np.tile(np.arange(1, n + 1, dtype=np.int32), (rows, 1))
        before = after - 2
        ranks = np.full((rows, n), NONE, np.int32)  # of each part with the following one
        ranks[:, :-1] = self.rank(ids[:, :-1], ids[:, 1:])
        live = np.arange(rows)
        while live.size:
            at = ranks[live].argmin(axis=1)
            low = ranks[live, at]
            going = low != NONE
            live, at, low = live[going], at[going], low[going]
            gone = after[live, at]
            beyond = after[live, gone]
            ids[live, at], ids[live, gone] = low, -1
            ranks[live, at] = ranks[live, gone] = NONE
            after[live, at] = beyond
            some = beyond < n
            word, this, other = live[some], at[some], beyond[some]
            before[word, other] = this
            ranks[word, this] = self.rank(low[some], ids[word, other])
            some = before[live, at] >= 0
            word, other = live[some], before[live, at][some]
            ranks[word, other] = self.rank(ids[word, other], low[some])
        return ids

    def fold_long(self, word: bytes) -> list[int]:
        """The ids of one word, by the same merges in the order of a heap: n log n for n bytes."""
        ids = self.octets[np.frombuffer(word, np.uint8)]
        n = len(ids)
        first = self.rank(ids[:-1], ids[1:])
        heap = [(int(first[at]), int(at)) for at in np.flatnonzero(first != NONE)]
        heapify(heap)
        ids, after, before = ids.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        now = first.tolist() + [NONE]
        while heap:
            low, at = heappop(heap)
            if now[at] != low:
                continue  # another merge took one of its parts
            gone = after[at]
            beyond = after[gone]
            ids[at], ids[gone], now[at], now[gone], after[at] = low, -1, NONE, NONE, beyond
            if beyond < n:
                before[beyond] = at
            for left, right in ((before[at], at), (at, beyond)):
                if left >= 0 and right < n:
                    now[left] = self.joined.get(ids[left] << 32 | ids[right], NONE)
                    if now[left] != NONE:
                        heappush(heap, (now[left], left))
        return [i for i in ids if i >= 0]

    def encode(self, words: pa.Array) -> tuple[pa.ListArray, np.ndarray]:
        """Lists of ids, and which of them each of the (distinct, not null) words has.

        A word that is a piece has the piece's id, whether or not merges lead there.
        """
        words = words.cast(pa.binary())
        whole = pc.index_in(words, self.pieces)
        piece = pc.fill_null(whole, -1).to_numpy(zero_copy_only=False)
        offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
        data = np.frombuffer(words.buffers()[2], np.uint8) if len(words) else np.empty(0, np.uint8)
        lengths = np.where(piece < 0, np.diff(offsets), 0)
        sizes, ids, order = [np.ones((piece >= 0).sum(), np.int32)], [self.ids[piece[piece >= 0]]], [np.flatnonzero(piece >= 0)]
        for n in np.unique(lengths[(lengths > 0) & (lengths <= LONG)]).tolist():
            same = np.flatnonzero(lengths == n)
            for k in range(0, len(same), CELLS // n):
                some = same[k : k + CELLS // n]
                parts = self.fold(data[offsets[some][:, None] + np.arange(n)])
                sizes.append((parts >= 0).sum(axis=1, dtype=np.int32))
                ids.append(parts[parts >= 0])
                order.append(some)
        for k in np.flatnonzero(lengths > LONG):
            ids.append(np.array(self.fold_long(words[int(k)].as_py()), np.int32))
            sizes.append(np.array([len(ids[-1])], np.int32))
            order.append(np.array([k]))
        place = np.empty(len(words), np.int32)
        place[np.concatenate(order)] = np.arange(len(words), dtype=np.int32)
        starts = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32)
        return pa.ListArray.from_arrays(starts, np.concatenate(ids)), place


def encoder(vocabulary: Vocabulary) -> Callable[[Column], Column]:
    """The function from the words of a text to its ids. A batch folds each distinct word once."""
    merges = Merges(vocabulary.pieces)

    @F.arrow_udf("array<int>")
    def ids(words: pa.Array) -> pa.Array:
        distinct = words.flatten().dictionary_encode()
        lists, place = merges.encode(distinct.dictionary)
        every = lists.take(pa.array(place[distinct.indices.to_numpy()]))
        ends = words.offsets.to_numpy()
        return pa.ListArray.from_arrays(every.offsets.take(pa.array(ends - ends[0])), every.values)

    return ids


def cut(text: Column, vocabulary: Vocabulary) -> Column:
    """The words of a text by the vocabulary's pattern, with Unicode's white space."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("(?U)" + vocabulary.pattern), F.lit(0))


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The frame with ``ids``, the token ids of the whole text; a null text has none.

    Nothing is shuffled and nothing kept from one Arrow batch to the next, so memory is bounded
    by a batch (``spark.sql.execution.arrow.maxBytesPerBatch``) and the longest text. The added
    column replaces one of its name. Repeated rows stay; a vocabulary must have all 256 bytes.
    """
    return docs.withColumn("ids", encoder(vocabulary)(cut(F.col("text"), vocabulary)))


def decode(ids: Column, vocabulary: Vocabulary) -> Column:
    """The bytes of token ids: their pieces, concatenated; an id without a piece gives null."""
    by_rank = {rank: piece.hex().upper() for piece, rank in vocabulary.pieces.items()}
    pieces = F.split(F.lit(",".join(by_rank.get(k, "?") for k in range(max(by_rank, default=-1) + 1))), ",")
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(pieces, i)), "", "?"))


def digests(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document, a row per row."""
    encoded = encode(docs.select("doc_id", "text"), vocabulary)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(decode(F.col("ids"), vocabulary), 256).alias("decoded_sha256"),
    )
