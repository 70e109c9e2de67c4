"""Removal of byte strings that start in an earlier document, by prefix doubling on sampled suffixes.

Prefix doubling names the prefix of length 2h at a position by the pair of names of length h
at the position and h further on, until names are unique or long enough. Here:

* Names are 64-bit numbers that depend on the bytes alone, so the pairs of a document need no
  sort across documents: 1, 2, 4, 8, 16 and ``GRAM`` bytes are named where the text lies.
* Only some positions go on. Every string of ``LEAST`` bytes is represented by the smallest
  name of ``GRAM`` bytes within it; neighbouring strings mostly share it, so a position in
  about sixteen is sent, with a name for the whole stretch of strings that it represents.
* Spark deals the positions by name, each part sorts them, and those with a name that no
  other document has are dropped. Where all stretches of a name are equal, the smallest
  doc_id is known. Only stretches that differ around an equal name are ranked again, by the
  smallest of longer names (``GRAMS``), which ever fewer strings share by chance, and at last by
  the names of ``LEAST`` bytes themselves, past which no longer prefix is asked for. A name with
  many surroundings in a task goes on without being ranked first, so however many it has they
  never meet in one task.
* A ranking's result is written to the shared folder and its shuffle files go, so the disk holds one
  ranking at a time, of positions or of the strings still open, but never of every string.

Bytes are never compared, only names. Of m different surroundings of one string of ``GRAM`` bytes
about m * m / 2^65 pairs have the same 64-bit name of the whole stretch and count as equal:
3e-6 at ten million. Strings that are ranked again have two names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vouch.llm.frames import even_keys, partitions, releasing
from vouch.llm.skew import lookup
from vouch.sources.staging import passed, remove, settle

LEAST = 50
GRAM = 20
#: Bytes of the names that the strings are ranked by, one ranking after the other.
GRAMS = (GRAM, 35, 43, LEAST)
#: Strings of a stretch: two names of LEAST bytes, of its first and last one, cover it.
STRETCH = 32
#: Positions that a task sorts and sends at once.
FLUSH = 1 << 19
#: A name with more different surroundings than this in what a task sends at once is ranked by its strings.
HOT = 16
#: Texts whose places a task lists at once.
TEXTS = 10_000
#: Places of a repeated doc_id: the number of the text above, the byte in it below this many bits.
TEXT_BITS = 32
#: Added to the places of texts whose doc_id is null; no text is so long.
MISSING = 1 << 31
#: Stands for a null doc_id, which comes after all others.
LAST = (1 << 63) - 1

_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_FIRST = (np.arange(1, 257, dtype=np.uint64) * _K1) ^ ((np.arange(1, 257, dtype=np.uint64) * _K2) >> np.uint64(31))


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The names of pairs of names."""
    x = a * _K1 + (b ^ (b >> np.uint64(29))) * _K2
    return x ^ (x >> np.uint64(32))


def names(octets: np.ndarray, length: int) -> np.ndarray:
    """The name of the ``length`` bytes at each position, by doubling."""
    x, h = _FIRST[octets], 1
    while 2 * h <= length:
        x, h = pair(x[:-h], x[h:]), 2 * h
    return pair(x[: len(x) - (length - h)], x[length - h :]) if h < length else x


def whole(short: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The name of the LEAST bytes at some positions, by the names of GRAM bytes."""
    half = LEAST - 2 * GRAM
    return pair(pair(short[at], short[at + GRAM]), pair(short[at + half], short[at + LEAST - GRAM]))


def stretches(octets: np.ndarray, gram: int = GRAM, pieces: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Name, name of the whole, first string and number of strings of each stretch of a text.

    ``pieces``: the bytes of each of several texts that ``octets`` holds one after the other. No stretch
    goes on into the next one.
    """
    short = names(octets, GRAM)
    count, span = len(octets) - LEAST + 1, LEAST - gram + 1
    least, h = short if gram == GRAM else names(octets, gram), 1
    while 2 * h <= span:
        least, h = np.minimum(least[:-h], least[h:]), 2 * h
    least = np.minimum(least[:count], least[span - h : span - h + count])
    # strings ranked by all their bytes go one by one: of those in a row with one name some may be repeats, others not
    new = np.concatenate(([True], (least[1:] != least[:-1]) | (gram == LEAST)))
    if pieces is None:
        first = np.flatnonzero(new)
        lengths = np.diff(np.append(first, count))
    else:
        # strings that begin in one piece and end in the next one are none: a stretch may end, but not begin with them
        stops = np.cumsum(pieces)
        new[stops[:-1]] = True
        new[stops[:-1] - LEAST + 1] = True
        first = np.flatnonzero(new)
        lengths = np.diff(np.append(first, count))
        own = np.searchsorted(stops, first, "right")
        real = first + LEAST <= stops[own]
        first, lengths = first[real], lengths[real]
    if lengths.max() > STRETCH:
        parts = -(-lengths // STRETCH)
        number = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        ends = np.repeat(first + lengths, parts)
        first = np.repeat(first, parts) + number * STRETCH
        lengths = np.minimum(ends - first, STRETCH)
    last = first + lengths - 1
    context = pair(whole(short, first), whole(short, last)) + lengths.astype(np.uint64) * _K2
    return least[first], context, first, lengths


def merged(docs: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> pd.DataFrame:
    """Spans (doc, start, stop), those of a document that touch joined to one."""
    if not len(docs):
        return pd.DataFrame({"doc": docs, "start": starts, "stop": stops})
    order = np.lexsort((starts, docs))
    docs, starts, stops = docs[order], starts[order], stops[order]
    text = starts >> TEXT_BITS
    new = np.concatenate(([True], (docs[1:] != docs[:-1]) | (text[1:] != text[:-1])))
    # the furthest stop so far within a text, by way of ranks that grow with the text
    group = np.cumsum(new) - 1
    inside, ranks = stops - (text << TEXT_BITS), group << TEXT_BITS
    reach = np.maximum.accumulate(inside + ranks) - ranks
    new[1:] |= starts[1:] > (reach + (text << TEXT_BITS))[:-1]
    at = np.flatnonzero(new)
    return pd.DataFrame({"doc": docs[at], "start": starts[at], "stop": np.maximum.reduceat(stops, at)})


def _packed(values: np.ndarray, kind: str) -> bytes:
    """The numbers as bytes, all first bytes, then all second ones: the high ones are mostly zero and compress."""
    return values.astype(kind).view(np.uint8).reshape(len(values), -1).T.tobytes()


def _unpacked(octets: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(octets, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def rank(name: np.ndarray, context: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by name, context and document; for each, the smallest document of its context and of its name."""
    order = np.lexsort((doc, context, name))
    n, c, d = name[order], context[order], doc[order]
    new_name = np.concatenate(([True], n[1:] != n[:-1]))
    new_context = new_name | np.concatenate(([True], c[1:] != c[:-1]))
    of_context = d[new_context][np.cumsum(new_context) - 1]
    at = np.flatnonzero(new_name)
    of_name = np.minimum.reduceat(d, at)[np.cumsum(new_name) - 1]
    return order, of_context, of_name


_SENT = "part int, base bigint, wide boolean, names binary, contexts binary, docs binary, starts binary, lengths binary"
_PLACES = [["docs", "starts", "lengths"], ["open_docs", "open_starts", "open_lengths"]]
_RANKED = ", ".join(["bucket int", *[f"{c} binary" for columns in _PLACES for c in columns]])
_LISTED = "doc bigint, of bigint, starts binary, stops binary"


def _send(found: list[tuple], parts: np.ndarray, opens: bool = True) -> pd.DataFrame:
    """The stretches of some texts, a row per part; as spans, those that repeat among them and those of hot names.

    Without ``opens`` no name is hot: strings that are ranked again have but one surrounding each.
    """
    name, context, start, length, doc = (np.concatenate(x) for x in zip(*found, strict=True))
    order, of_context, _ = rank(name, context, doc)
    name, context, start, length, doc = (x[order] for x in (name, context, start, length, doc))
    again = doc > of_context
    spans = merged(doc[again], start[again], start[again] + length[again] + LEAST - 1)
    name, context, start, length, doc = (x[~again] for x in (name, context, start, length, doc))
    # the stretches of hot names are open at once; a row without length says so to the part of the name
    at = np.flatnonzero(np.concatenate(([True], name[1:] != name[:-1])))
    new = np.concatenate(([True], (name[1:] != name[:-1]) | (context[1:] != context[:-1])))
    many = (np.add.reduceat(new.astype(np.int64), at) > HOT) & opens
    hot = np.repeat(many, np.diff(np.append(at, len(name))))
    opened, marks = [x[hot] for x in (doc, start, start + length)], at[many]
    name, context, start, length, doc = (
        np.concatenate((x[~hot], y)) for x, y in zip((name, context, start, length, doc), (name[marks], context[marks], start[marks], 0 * length[marks], doc[marks]), strict=True)
    )
    base = int(doc.min())
    wide = max(int(doc.max()) - base, int(start.max())) >= 1 << 32
    kinds = ("<u8", "<u8", *["<u8" if wide else "<u4"] * 2, "u1")
    part = (name % np.uint64(len(parts))).astype(np.int64)
    order = np.argsort(part, kind="stable")
    edges = np.searchsorted(part[order], np.arange(len(parts) + 1))
    columns = [(x[order], k) for x, k in zip((name, context, doc - base, start, length), kinds, strict=True)]
    rows = [
        (p, base, wide, *[_packed(x[a:b], k) for x, k in columns])
        for p, a, b in zip(parts.tolist(), edges[:-1].tolist(), edges[1:].tolist(), strict=True)
        if b > a
    ]
    # known spans go without names, open ones without contexts; what the part's task gets it passes on
    if len(spans):
        known = [_packed(spans[c].to_numpy(), "<i8") for c in ("doc", "start", "stop")]
        rows.append((int(parts[int(start.sum()) % len(parts)]), 0, True, None, b"", *known))
    if len(opened[0]):
        rows.append((int(parts[int(opened[1].sum()) % len(parts)]), 0, True, None, None, *[_packed(x, "<i8") for x in opened]))
    return pd.DataFrame(rows, columns=["part", "base", "wide", "names", "contexts", "docs", "starts", "lengths"])


def _positions(parts: np.ndarray):
    @releasing
    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, size = [], 0
        for batch in batches:
            for doc, base, octets in zip(batch["doc"], batch["base"], batch["octets"], strict=True):
                if octets is None or len(octets) < LEAST:
                    continue
                name, context, first, lengths = stretches(np.frombuffer(octets, np.uint8))
                found.append((name, context, first + base, lengths, np.full(len(name), doc)))
                size += len(name)
                if size >= FLUSH:
                    yield _send(found, parts)
                    found, size = [], 0
        if found:
            yield _send(found, parts)

    return send


def _dealt(found: list[list[tuple]], parts: np.ndarray) -> pd.DataFrame:
    """Known and open places of texts, those that touch joined to one, a row for each bucket of texts."""
    dealt = {}
    for columns, listed in zip(_PLACES, found, strict=True):
        if not listed:
            continue
        spans = merged(*(np.concatenate(x) for x in zip(*listed, strict=True)))
        doc, start, stop = (spans[c].to_numpy(np.int64) for c in ("doc", "start", "stop"))
        bucket = (pair(doc.view(np.uint64), (start >> TEXT_BITS).view(np.uint64)) % np.uint64(len(parts))).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        doc, start, length = doc[order], start[order], (stop - start)[order]
        edges = np.searchsorted(bucket[order], np.arange(len(parts) + 1))
        for p, a, b in zip(parts.tolist(), edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if b > a:
                packed = _packed(np.diff(doc[a:b], prepend=0), "<i8"), _packed(start[a:b], "<i8"), _packed(length[a:b], "<u4")
                dealt.setdefault(p, {"bucket": p}).update(zip(columns, packed, strict=True))
    return pd.DataFrame(list(dealt.values()), columns=["bucket", *_PLACES[0], *_PLACES[1]], dtype=object).astype({"bucket": np.int32})


def _ranked(parts: np.ndarray, opens: bool = True):
    """Spans of strings known from an earlier document, and ranges of strings that are still open, by bucket."""

    @releasing
    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fields: list[list[np.ndarray]] = [[], [], [], [], []]
        places: list[list[tuple]] = [[], []]
        size = 0
        for batch in batches:
            for row in batch.itertuples(index=False):
                if row.names is None:
                    listed = places[row.contexts is None]
                    listed.append(tuple(_unpacked(x, "<i8") for x in (row.docs, row.starts, row.lengths)))
                    size += len(listed[-1][0])
                    if size >= FLUSH:
                        yield _dealt(places, parts)
                        places, size = [[], []], 0
                    continue
                kinds = ("<u8", "<u8", *["<u8" if row.wide else "<u4"] * 2, "u1")
                sent = (row.names, row.contexts, row.docs, row.starts, row.lengths)
                values = [_unpacked(x, k) for x, k in zip(sent, kinds, strict=True)]
                values[2] = values[2].astype(np.int64) + row.base
                for store, x in zip(fields, values, strict=True):
                    store.append(x)
        if fields[0]:
            name, context, doc, start, length = (np.concatenate(x) for x in fields)
            fields.clear()
            hot, real = np.unique(name[length == 0]), length > 0
            name, context, doc, start, length = (x[real] for x in (name, context, doc, start, length))
            if len(name):
                order, of_context, of_name = rank(name, context, doc)
                name, doc, start, length = name[order], doc[order], start[order].astype(np.int64), length[order].astype(np.int64)
                again = doc > of_context
                places[0].append((doc[again], start[again], (start + length)[again] + LEAST - 1))
                # where an earlier document has the name too, but in other surroundings, all surroundings are compared
                at = np.flatnonzero(np.concatenate(([True], name[1:] != name[:-1])))
                latest = np.maximum.reduceat(of_context, at)
                mixed = np.repeat(latest, np.diff(np.append(at, len(name)))) > of_name
                is_open = (mixed | np.isin(name, hot)) & ~again & opens
                places[1].append((doc[is_open], start[is_open], (start + length)[is_open]))
        yield _dealt(places, parts)

    return each


@releasing
def _listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The places of each text, those that touch joined to one, a row per text."""
    found = [
        (np.cumsum(_unpacked(d, "<i8")), _unpacked(s, "<i8"), _unpacked(n, "<u4").astype(np.int64))
        for batch in batches
        for d, s, n in zip(batch["docs"], batch["starts"], batch["lengths"], strict=True)
    ]
    if not found:
        return
    doc, start, length = (np.concatenate(x) for x in zip(*found, strict=True))
    spans = merged(doc, start, start + length)
    doc, start, stop = (spans[c].to_numpy(np.int64) for c in ("doc", "start", "stop"))
    of = start >> TEXT_BITS
    first = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (of[1:] != of[:-1]))))
    edges = np.append(first, len(doc)).tolist()
    for a in range(0, len(first), TEXTS):
        b = min(a + TEXTS, len(first))
        cuts = list(zip(edges[a:b], edges[a + 1 : b + 1], strict=True))
        starts, stops = ([x[i:j].tobytes() for i, j in cuts] for x in (start, stop))
        yield pd.DataFrame({"doc": doc[first[a:b]], "of": of[first[a:b]], "starts": starts, "stops": stops})


def _strings(parts: np.ndarray, gram: int):
    """The stretches, by the smallest name of ``gram`` bytes, of the strings that are open in each text."""

    @releasing
    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces, docs, starts, found, size = [], [], [], [], 0

        def cut() -> tuple:
            sizes = np.array([len(x) for x in pieces], np.int64)
            name, context, first, lengths = stretches(np.frombuffer(b"".join(pieces), np.uint8), gram, sizes)
            own = np.searchsorted(np.cumsum(sizes), first, "right")
            place = first - (np.cumsum(sizes) - sizes)[own] + np.array(starts, np.int64)[own]
            return name, context, place, lengths, np.array(docs, np.int64)[own]

        def sent(found: list[tuple]) -> pd.DataFrame:
            return _send(found, parts, opens=gram < LEAST)

        octets = 0
        for batch in batches:
            for doc, base, text, first, stop in zip(*(batch[c] for c in ("doc", "base", "octets", "starts", "stops")), strict=True):
                for a, b in zip(np.frombuffer(first, "<i8").tolist(), np.frombuffer(stop, "<i8").tolist(), strict=True):
                    pieces.append(text[a - base : b - base + LEAST - 1])
                    docs.append(doc)
                    starts.append(a)
                    octets += b - a + LEAST - 1
                if octets >= FLUSH:
                    found.append(cut())
                    size += len(found[-1][0])
                    pieces, docs, starts, octets = [], [], [], 0
                    if size >= FLUSH:
                        yield sent(found)
                        found, size = [], 0
        if pieces:
            found.append(cut())
        if found:
            yield sent(found)

    return send


def _based(docs: DataFrame) -> tuple[DataFrame, bool]:
    """The documents with ``doc`` and ``base``, and whether a doc_id repeats.

    ``base`` is where places in a text begin. A text is 0 but for those of a repeated doc_id, whose distinct
    texts get numbers of their own, as do places in them: however many texts a doc_id has, null
    included, each is handled as a text, and the doc_id serves for comparison alone. The
    strings of rows of one doc_id are no reason to remove each other.
    """
    marked = docs.withColumns(
        {
            "doc": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)),
            "octets": F.coalesce(F.col("text").cast("binary"), F.lit(b"")),
        }
    )
    repeated = marked.groupBy("doc").count().where("count > 1").select("doc")
    missing = F.when(F.col("doc_id").isNull(), MISSING).otherwise(0).cast("bigint")
    if repeated.isEmpty():
        return marked.withColumn("base", missing), False
    marked = marked.withColumn("digest", F.sha2("octets", 256))
    texts = marked.select("doc", "digest").join(repeated, "doc", "left_semi").groupBy("doc", "digest").agg(F.count("*").alias("copies"))
    texts = settle(texts.withColumn("row", F.monotonically_increasing_id()))
    task, inside = F.shiftright("row", 33), F.col("row").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # over a row per task
    tasks = texts.groupBy(task.alias("task")).agg(F.count("*").alias("n"))
    first = tasks.select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    numbered = texts.withColumn("task", task).join(F.broadcast(first), "task")
    base = F.shiftleft(F.col("first") + inside + 1, TEXT_BITS)
    bases = settle(numbered.select("doc", "digest", "copies", base.alias("base")))
    total = bases.agg(F.sum("copies")).first()[0]
    joined = lookup(marked, bases, ["doc", "digest"], F.col("copies"), total).drop("digest", "copies")
    return joined.withColumn("base", F.coalesce("base", F.lit(0).cast("bigint")) + missing), True


def repeated_spans(based: DataFrame, repeats: bool) -> DataFrame:
    """(doc, of, starts, stops): all bytes of strings that also start in a document of smaller doc_id, a row per text.

    Positions go to the parts by name; copies within a task are settled there and only the
    first goes on, so a passage that many documents share costs a row per task. What a ranking
    finds goes to the shared folder, which cuts the lineage and lets its shuffle files go.
    """
    spark = based.sparkSession
    texts = based.select("doc", "octets", "base")
    if repeats:
        numbered = _text_of("base") > 0
        alike = texts.where(numbered).groupBy("doc", "base").agg(F.first("octets").alias("octets"))
        texts = texts.where(~numbered).unionByName(alike)
    parts, folders = even_keys(partitions(spark)), []
    for gram in GRAMS:
        if not folders:
            sent = texts.mapInPandas(_positions(parts), _SENT)
        else:
            still = _places(spark, folders[-1:], True)
            if still.isEmpty():
                break
            places = still.repartition(partitions(spark), "bucket").mapInPandas(_listed, _LISTED)
            within = texts.withColumn("of", _text_of("base")).join(places, ["doc", "of"])
            sent = within.select("doc", "base", "octets", "starts", "stops").mapInPandas(_strings(parts, gram), _SENT)
        ranked = sent.repartition(partitions(spark), "part").mapInPandas(_ranked(parts, gram < LEAST), _RANKED)
        folders.append(passed(ranked))
    known = _places(spark, folders, False).repartition(partitions(spark), "bucket")
    listed = passed(known.mapInPandas(_listed, _LISTED))
    for folder in folders:
        remove(spark, folder)
    return spark.read.schema(_LISTED).parquet(listed)


def _places(spark: SparkSession, folders: list[str], is_open: bool) -> DataFrame:
    """The known or the open places that rankings wrote."""
    columns = [F.col(c).alias(name) for c, name in zip(_PLACES[is_open], _PLACES[0], strict=True)]
    return spark.read.schema(_RANKED).parquet(*folders).where(F.col(_PLACES[is_open][0]).isNotNull()).select("bucket", *columns)


def _text_of(place: str) -> Column:
    """The number of the text that a place is in: 0 unless its doc_id has several."""
    return F.shiftright(place, TEXT_BITS)


def _with_spans(docs: DataFrame) -> DataFrame:
    """The documents with the spans of their text, which are no more than its bytes allow."""
    based, repeats = _based(docs)
    spans = repeated_spans(based, repeats)
    return based.withColumn("of", _text_of("base")).join(spans, ["doc", "of"], "left")


def _kept(octets: bytes, base: int, starts: bytes | None, stops: bytes | None) -> tuple[bytes, int, int]:
    """What is left of a text, the number of removed bytes and of removed runs."""
    if starts is None:
        return octets, 0, 0
    ends = [(np.frombuffer(x, "<i8") - base).tolist() for x in (starts, stops)]
    left = b"".join(octets[a:b] for a, b in zip([0, *ends[1]], [*ends[0], len(octets)], strict=True))
    return left, len(octets) - len(left), len(ends[0])


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document, a row per row.

    A null text is empty; an empty table gives an empty one. Null doc_ids come after all others
    and, like rows that repeat a doc_id, do not remove each other's strings.
    """

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, base, octets, starts, stops in zip(*(batch[c] for c in ("doc", "base", "octets", "starts", "stops")), strict=True):
                left, removed, runs = _kept(octets, base, starts, stops)
                rows.append((doc, bool(base & MISSING), len(octets), removed, runs, hashlib.sha256(left).hexdigest()))
            yield pd.DataFrame(rows, columns=["doc", "missing", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    joined = _with_spans(docs.select("doc_id", "text")).select("doc", "octets", "base", "starts", "stops")
    found = joined.mapInPandas(each, "doc bigint, missing boolean, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    doc_id = F.when(~F.col("missing"), F.col("doc")).cast(docs.schema["doc_id"].dataType).alias("doc_id")
    return found.select(doc_id, "n_bytes", "n_removed", "n_spans", "kept_sha256")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """The documents without the strings that an earlier one has; all other columns as they were.

    Where a removed run cuts through a character, its other bytes go too. A null text stays null.
    """

    @F.pandas_udf("string")
    def clean(octets: pd.Series, base: pd.Series, starts: pd.Series, stops: pd.Series) -> pd.Series:
        rows = zip(octets, base, starts, stops, strict=True)
        return pd.Series([None if o is None else _kept(o, *x)[0].decode("utf-8", "ignore") for o, *x in rows], dtype=object)

    narrow = docs.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns)], "doc_id", "text")
    joined = _with_spans(narrow)
    text = clean(F.col("text").cast("binary"), "base", "starts", "stops")
    columns = [(text if c == "text" else F.col(f"c{k}")).alias(c) for k, c in enumerate(docs.columns)]
    return joined.select(*columns)
