"""Two tokenizers over the same texts: which of their tokens overlap, end together or share a group."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vouch.llm.csr import Csr
from vouch.llm.frames import releasing
from vouch.llm.stretches import Encoder, Lists, byte_alphabet, cut, slices
from vouch.sources.staging import new_folder

KINDS = ("overlap", "end", "group")
#: Bytes whose incidence matrices are multiplied at once; they are cut where tokens of both sides end.
WINDOW = 1 << 20
#: Distinct stretches that are aligned at once.
STRETCHES = 1 << 15
#: What a blank is called in the pieces of the second tokenizer.
MARK = "▁"


class ByteLevel:
    """Side A: a byte-level tokenizer of the ``tokenizers`` library, special tokens' strings as plain text."""

    def __init__(self, vocabulary: str):
        self.encoder = Encoder(vocabulary).plain()
        letters = byte_alphabet()
        entries = self.encoder.tokenizer.get_vocab(with_added_tokens=True)
        self.pieces = [b""] * (max(entries.values()) + 1)
        for entry, number in entries.items():
            self.pieces[number] = bytes(letters[c] for c in entry if c in letters)

    def encode(self, stretches: list[str]) -> Lists:
        return self.encoder.encode(stretches)


class Pieces:
    """Side B: a ``sentencepiece`` model that puts a blank before the text and marks blanks as U+2581.

    ``apart`` says whether stretches can be encoded one by one: no piece has a blank after another letter.
    """

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.pieces = [
            bytes([int(name[3:5], 16)]) if self.model.is_byte(i) else name.replace(MARK, " ").encode() for i, name in enumerate(names)
        ]
        self.apart = not any(MARK in name.lstrip(MARK) for name in names)
        self.blank = [self.model.piece_to_id(MARK)]

    def encode(self, stretches: list[str]) -> Lists:
        """Ids of stretches that all start with the blank which the model adds itself; a blank alone is its own piece."""
        found = [ids or self.blank for ids in self.model.encode([s[1:] for s in stretches], num_threads=1)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return Lists(np.fromiter((i for ids in found for i in ids), np.uint32, int(lengths.sum())), lengths)


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, shared bytes) of all token pairs that share bytes, by the product A·Bᵀ of token-byte incidences.

    Both sides cover the same bytes without a gap and say where their tokens end. Long inputs
    are multiplied window by window, cut where both sides end, as no pair reaches over that.
    """
    found, at_a, at_b, start = [], 0, 0, 0
    both = np.intersect1d(ends_a, ends_b, assume_unique=True)
    while start < (both[-1] if len(both) else 0):
        stop = both[max(int(np.searchsorted(both, start, "right")), int(np.searchsorted(both, start + window, "right")) - 1)]
        to_a, to_b = int(np.searchsorted(ends_a, stop, "right")), int(np.searchsorted(ends_b, stop, "right"))
        sides = []
        for ends in (ends_a[at_a:to_a] - start, ends_b[at_b:to_b] - start):
            sides.append(Csr.incidence(np.concatenate([[0], ends[:-1]]), ends, int(stop - start)))
        product = sides[0].times(sides[1].transposed())
        found.append((product.rows() + at_a, product.columns + at_b, product.data))
        at_a, at_b, start = to_a, to_b, stop
    if not found:
        return (np.zeros(0, np.int64),) * 3
    a, b, shared = (np.concatenate(x) for x in zip(*found, strict=True))
    return a, b, shared


def groups(ends_a: np.ndarray, ends_b: np.ndarray, links: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The group of each token of both sides, and where the groups end: the bytes at which linked tokens end together."""
    a, b, _ = links
    common = ends_a[a[ends_a[a] == ends_b[b]]]
    return np.searchsorted(common, ends_a), np.searchsorted(common, ends_b), common


def links_of(kind: str, ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, shared bytes) of all links of a kind between the tokens of one text.

    ``overlap``: the two share bytes. ``end``: they overlap and end at the same byte.
    ``group``: they lie between the same two neighbouring ends of both sides, by the product
    of the token-group incidences; shared bytes may be none.
    """
    found = overlaps(ends_a, ends_b)
    if kind == "overlap":
        return found
    a, b, shared = found
    if kind == "end":
        same = ends_a[a] == ends_b[b]
        return a[same], b[same], shared[same]
    if kind != "group":
        raise ValueError(f"kind is one of {KINDS}")
    of_a, of_b, common = groups(ends_a, ends_b, found)
    sides = [Csr.incidence(of, of + 1, len(common)) for of in (of_a, of_b)]
    product = sides[0].times(sides[1].transposed())
    rows = product.rows()
    known = dict(zip(zip(a.tolist(), b.tolist(), strict=True), shared.tolist(), strict=True))
    both = [known.get(pair, 0) for pair in zip(rows.tolist(), product.columns.tolist(), strict=True)]
    return rows, product.columns, np.array(both, np.int64)


@dataclass
class Aligned:
    """The stretches of some texts aligned: per distinct stretch its counts, its groups as text and its links as numbers."""

    valid: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    texts: list[bytes]
    pairs: Lists


class Aligner:
    """Both tokenizers, and the alignment of stretches that both of them cut apart."""

    def __init__(self, vocabulary: str, model: bytes):
        self.a, self.b = ByteLevel(vocabulary), Pieces(model)
        self.sizes = [np.array([len(p) for p in side.pieces], np.int64) for side in (self.a, self.b)]
        self.width = len(self.b.pieces)
        # A token's number and what may follow it: nothing, its own side, the other side, the next group.
        self.printed = [[b"%d%s" % (i, sep) for i in range(len(side.pieces)) for sep in (b"", b",", b"|", b";")] for side in (self.a, self.b)]

    def cut(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Stretches as of ``stretches.cut``, with a blank before every text; whole texts where a model needs them."""
        if self.b.apart:
            return cut(texts, lead=True)
        whole = pc.fill_null(texts, "").dictionary_encode()
        return [" " + t for t in whole.dictionary.to_pylist()], whole.indices.to_numpy().astype(np.int64), np.arange(1, len(texts) + 1)

    def encode(self, stretches: list[str]) -> tuple[Lists, Lists, np.ndarray]:
        """Ids of both sides, and whether the tokens' bytes are those of the stretch."""
        a, b = self.a.encode(stretches), self.b.encode(stretches)
        encoded = [s.encode() for s in stretches]
        want = np.fromiter(map(len, encoded), np.int64, len(encoded))
        valid = np.ones(len(stretches), bool)
        for ids, side, sizes in ((a, self.a, self.sizes[0]), (b, self.b, self.sizes[1])):
            spans = Lists(sizes[ids.values], ids.lengths)
            total = np.add.reduceat(np.append(spans.values, 0), np.minimum(spans.starts, len(spans.values))) * (ids.lengths > 0)
            pieces = [side.pieces[i] for i in ids.values.tolist()]
            if np.array_equal(total, want) and b"".join(pieces) == b"".join(encoded):
                continue
            stops = spans.starts + ids.lengths
            valid &= [b"".join(pieces[x:y]) == e for x, y, e in zip(spans.starts.tolist(), stops.tolist(), encoded, strict=True)]
        return a, b, valid

    def align(self, stretches: list[str], at_once: int = STRETCHES) -> Aligned:
        """The stretches aligned, a bounded number of them at a time."""
        parts = [self._align(stretches[i : i + at_once]) for i in range(0, len(stretches), at_once)]
        if len(parts) == 1:
            return parts[0]
        columns = [np.concatenate([getattr(p, n) for p in parts]) for n in ("valid", "n_a", "n_b", "n_groups")]
        pairs = Lists(*(np.concatenate([getattr(p.pairs, n) for p in parts]) for n in ("values", "lengths")))
        return Aligned(*columns, [text for p in parts for text in p.texts], pairs)

    def _align(self, stretches: list[str]) -> Aligned:
        a, b, valid = self.encode(stretches)
        keep = np.flatnonzero(valid)
        a, b = a.take(keep), b.take(keep)
        ends_a, ends_b = np.cumsum(self.sizes[0][a.values]), np.cumsum(self.sizes[1][b.values])
        found = overlaps(ends_a, ends_b)
        of_a, of_b, common = groups(ends_a, ends_b, found)
        at_a, at_b, _ = found
        linked = ends_a[at_a] == ends_b[at_b]
        at_a, at_b = at_a[linked], at_b[linked]
        pairs = a.values[at_a].astype(np.uint64) * np.uint64(self.width) + b.values[at_b]

        owner_a, owner_b = (np.repeat(np.arange(len(keep)), side.lengths) for side in (a, b))
        n_links = np.bincount(owner_a[at_a], minlength=len(keep))
        n_groups = np.bincount(owner_a[np.searchsorted(ends_a, common)], minlength=len(keep))

        # Tokens in the order they are printed in: by group, those of A before those of B.
        place = np.concatenate([2 * of_a, 2 * of_b + 1])
        order = np.argsort(place, kind="stable")
        place, owner = place[order], np.concatenate([owner_a, owner_b])[order]
        next_place = np.append(place[1:], -2)
        follows = np.where(next_place == place, 1, np.where(next_place == place + 1, 2, 3))
        follows = np.where((place & 1) & (follows == 2), 3, follows)
        follows[np.append(owner[1:] != owner[:-1], True)[: len(owner)]] = 0
        codes = np.concatenate([a.values, b.values]).astype(np.int64)[order] * 4 + follows
        on_a = order < len(a.values)
        table_a, table_b = self.printed
        printed = [table_a[c] if first else table_b[c] for c, first in zip(codes.tolist(), on_a.tolist(), strict=True)]
        bounds = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(keep)))]).tolist()

        n = len(stretches)
        texts = [b""] * n
        for i, k in enumerate(keep.tolist()):
            texts[k] = b"".join(printed[bounds[i] : bounds[i + 1]])

        def spread(counts: np.ndarray) -> np.ndarray:
            whole = np.zeros(n, np.int64)
            whole[keep] = counts
            return whole

        return Aligned(valid, spread(a.lengths), spread(b.lengths), spread(n_groups), texts, Lists(pairs, spread(n_links)))


def aligned_documents(docs: DataFrame, vocabulary: str, model: bytes) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs: every document under both tokenizers.

    ``pairs`` holds a number per link of kind ``end``, in order: id of A times the size of B's
    vocabulary, plus id of B, as little-endian 64-bit numbers. Texts null, empty, or whose tokens do not spell
    them have no tokens, zeros and an empty text. ``docs`` has doc_id, of any type, and text;
    other columns are ignored, repeated rows are rows of their own.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["n_a", "n_b", "n_groups", "n_links"]

    @releasing
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = None
        for batch in batches:
            aligner = aligner or Aligner(vocabulary, model)
            for start, stop in slices(batch.column(1)):
                ids, texts = (batch.column(i).slice(start, stop - start) for i in (0, 1))
                empty = (pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False) == 0).tolist()
                distinct, codes, ends = aligner.cut(texts)
                done = aligner.align(distinct)
                starts = np.concatenate([[0], ends[:-1]])
                whole = np.logical_and.reduceat(done.valid[codes], starts) & ~np.array(empty)
                counts = {n: np.add.reduceat(x[codes], starts) * whole for n, x in zip(names, (done.n_a, done.n_b, done.n_groups, done.pairs.lengths), strict=True)}
                digests, pairs = [], []
                for k, (x, y) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
                    if not whole[k]:
                        digests.append("")
                        pairs.append(b"")
                        continue
                    own = codes[x:y]
                    digests.append(hashlib.sha256(b";".join([done.texts[c] for c in own.tolist()])).hexdigest())
                    pairs.append(done.pairs.take(own).values.astype("<u8").tobytes())
                columns = [ids, *[pa.array(counts[n], pa.int64()) for n in names], pa.array(digests, pa.string()), pa.array(pairs, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *names, "groups_sha256", "pairs"])

    types = f"doc_id {kind}, " + ", ".join(f"{n} bigint" for n in names) + ", groups_sha256 string, pairs binary"
    return docs.select("doc_id", "text").mapInArrow(align, types)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, n: how many links of all documents hold a pair of ids. Counted per batch before the shuffle."""

    @releasing
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, n = np.unique(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u8"), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pairs.astype(np.int64)), pa.array(n.astype(np.int64))], names=["pair", "n"])

    return aligned.select("pairs").mapInArrow(count, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))


def most_pairs(vocabulary: str, model: bytes) -> int:
    """A bound on the pairs of ids that can end together: one token's bytes must end the other's, whatever the corpus."""
    a, b = ByteLevel(vocabulary).pieces, Pieces(model).pieces
    ends: dict[bytes, list[int]] = {}
    for side, tokens in enumerate((a, b)):
        for token in tokens:
            ends.setdefault(token, [0, 0])[side] += 1
    total = 0
    for side, tokens in enumerate((a, b)):
        for token in tokens:
            shorter = (ends.get(token[i:], (0, 0)) for i in range(side, len(token)))
            total += sum(count[1 - side] for count in shorter)
    return total


def link_scores(docs: DataFrame, vocabulary: str, model: bytes) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document.

    ``count_sum`` adds up, over a document's links, how many links of the corpus hold the same
    pair of ids; ``n_best`` counts the links whose pair is the most frequent of its id of B.
    The aligned documents are kept in the shared folder, so texts are encoded once. The counts are broadcast: there
    are at most ``most_pairs`` of them, a number that only the vocabularies set.
    """
    spark = docs.sparkSession
    path = new_folder(spark)
    aligned_documents(docs, vocabulary, model).write.option("compression", "zstd").parquet(path)
    aligned = spark.read.parquet(path)
    counted = pair_counts(aligned).toArrow()
    pair, n = (counted.column(i).to_numpy() for i in (0, 1))
    if len(pair) > most_pairs(vocabulary, model):
        raise ValueError("more pairs of ids end together than the vocabularies allow")
    order = np.argsort(pair)
    pair, n = pair[order], n[order]
    of_b = pair % Pieces(model).model.get_piece_size()
    most = np.zeros(int(of_b.max()) + 1 if len(of_b) else 0, np.int64)
    np.maximum.at(most, of_b, n)
    table = spark.sparkContext.broadcast((pair, n, n == most[of_b]))

    @releasing
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = table.value
        for batch in batches:
            # A batch's links are scored a few documents at a time, by their size.
            held = batch.column("pairs")
            for start, stop in slices(held):
                part = batch.slice(start, stop - start)
                links = np.frombuffer(b"".join(part.column("pairs").to_pylist()), "<u8").astype(np.int64)
                at = np.searchsorted(pair, links)
                ends = np.cumsum(part.column("n_links").to_numpy())
                running = [np.concatenate([[0], np.cumsum(x, dtype=np.int64)]) for x in (n[at], best[at])]
                count_sum, n_best = (r[ends] - r[np.concatenate([[0], ends[:-1]])] for r in running)
                columns = [*[part.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")], pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), part.column("groups_sha256")]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    types = ", ".join([f"doc_id {kind}", *[f"{c} bigint" for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")], "groups_sha256 string"])
    return aligned.mapInArrow(score, types)


def token_links(docs: DataFrame, vocabulary: str, model: bytes, kind: str = "overlap") -> DataFrame:
    """A row per link: doc_id, a_place, b_place (numbers of the tokens in the text), a_id, b_id, shared bytes.

    ``kind`` is one of ``KINDS``. Documents without tokens have no rows.
    """
    if kind not in KINDS:
        raise ValueError(f"kind is one of {KINDS}")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["a_place", "b_place", "a_id", "b_id", "shared"]

    @releasing
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = None
        for batch in batches:
            aligner = aligner or Aligner(vocabulary, model)
            for k, text in enumerate(batch.column(1).to_pylist()):
                if not text:
                    continue
                distinct, codes, _ = aligner.cut(pa.array([text]))
                a, b, valid = aligner.encode(distinct)
                if not valid[codes].all():
                    continue
                a, b = a.take(codes).values, b.take(codes).values
                found = links_of(kind, np.cumsum(aligner.sizes[0][a]), np.cumsum(aligner.sizes[1][b]))
                for x in range(0, len(found[0]), 1 << 16):
                    at_a, at_b, shared = (column[x : x + (1 << 16)] for column in found)
                    columns = [at_a, at_b, a[at_a].astype(np.int64), b[at_b].astype(np.int64), shared]
                    owner = batch.column(0).take(pa.array(np.full(len(at_a), k)))
                    yield pa.RecordBatch.from_arrays([owner, *[pa.array(c, pa.int64()) for c in columns]], names=["doc_id", *names])

    return docs.select("doc_id", "text").mapInArrow(link, f"doc_id {id_type}, " + ", ".join(f"{n} bigint" for n in names))
