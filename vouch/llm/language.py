"""Language identification with hyperdimensional profiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vouch.llm.frames import releasing

DIMENSIONS = 1024
#: Texts that are counted together, and the letters of a text that are read at once.
TEXTS, LETTERS = 256, 1 << 20
#: n-grams whose vectors are made at once.
GRAMS = 2048
#: Smallest cosine at which a filter takes a prediction for known language.
MIN_SCORE = 0.1
HOLD_OUT = 5
UNKNOWN = "und"

_SYMBOLS: list[np.ndarray] = []


def symbol_table() -> np.ndarray:
    """The lower-case letter of each code point, 0 for all that is no letter."""
    if not _SYMBOLS:
        points = np.zeros(0x110000, np.int32)
        for p in range(0x110000):
            c = chr(p)
            if c.isalpha():
                points[p] = ord(c.lower()[0])
        _SYMBOLS.append(points)
    return _SYMBOLS[0]


def letter_vectors(points: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """A random vector of ones and minus ones for each code point, the same on every machine."""
    lanes = np.arange(dimensions // 64, dtype=np.uint64)
    x = points.astype(np.uint64)[:, None] * np.uint64(0x100000001B3) + lanes * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    bits = np.unpackbits((x ^ (x >> np.uint64(31))).astype("<u8").view(np.uint8), axis=1)
    return bits.astype(np.int8) * 2 - 1


def symbols(text: str) -> Iterator[np.ndarray]:
    """The letters of a text with single gaps around words, in parts that overlap by two."""
    table, carry = symbol_table(), np.zeros(1, np.int32)
    for k in range(0, len(text), LETTERS):
        part = text[k : k + LETTERS].encode("utf-32-le", "surrogatepass")
        line = np.concatenate((carry, table[np.frombuffer(part, "<u4")]))
        line = line[np.concatenate(([True], (line[1:] != 0) | (line[:-1] != 0)))]
        yield line
        carry = line[-2:]
    if carry[-1]:
        yield np.append(carry, np.int32(0))


def bundle(texts: list[str], owners: np.ndarray, n: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    """The sums of the trigram vectors of all texts of each owner, a row per owner.

    The vector of a trigram binds those of its letters, the first shifted twice and the second
    once. Counts are whole numbers, so the sums are exact.
    """
    grams, whose = [np.zeros((0, 3), np.int32)], [np.zeros(0, np.int64)]
    for text, owner in zip(texts, owners.tolist(), strict=True):
        for line in symbols(text):
            if len(line) > 2:
                grams.append(np.lib.stride_tricks.sliding_window_view(line, 3))
                whose.append(np.full(len(line) - 2, owner))
    triples, whose = np.concatenate(grams), np.concatenate(whose)
    total = np.zeros((n, dimensions))
    if not len(triples):
        return total
    seen = np.zeros(0x110000, bool)
    seen[triples.ravel()] = True
    points = np.flatnonzero(seen)
    place = np.zeros(0x110000, np.int64)
    place[points] = np.arange(len(points))
    size = len(points)
    code = (place[triples[:, 0]] * size + place[triples[:, 1]]) * size + place[triples[:, 2]]
    if size**3 <= 1 << 24:
        present = np.zeros(size**3, bool)
        present[code] = True
        distinct = np.flatnonzero(present)
        index = np.zeros(size**3, np.int32)
        index[distinct] = np.arange(len(distinct), dtype=np.int32)
        at = index[code]
    else:
        distinct, at = np.unique(code, return_inverse=True)
    vectors = letter_vectors(points, dimensions)
    once, again = np.roll(vectors, 1, axis=1), np.roll(vectors, 2, axis=1)
    kind = np.float32 if len(code) < 1 << 23 else np.float64
    for k in range(0, len(distinct), GRAMS):
        some = distinct[k : k + GRAMS]
        bound = again[some // size**2] * once[some // size % size] * vectors[some % size]
        inside = (at >= k) & (at < k + len(some))
        counts = np.bincount(whose[inside] * len(some) + at[inside] - k, minlength=n * len(some))
        total += counts.reshape(n, len(some)).astype(kind) @ bound.astype(kind)
    return total


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept out of the training: one in five by checksum; never for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HOLD_OUT == 0, F.lit(False))


def learn(docs: DataFrame, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """The prototype of each language: the bundle of all its training documents.

    Every task sums what it reads to one vector per language; only those sums are shuffled, and
    a vector per language reaches the driver.
    """
    training = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())

    @releasing
    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            for k in range(0, len(batch), TEXTS):
                some = batch.iloc[k : k + TEXTS]
                owners, names = pd.factorize(some["lang"])
                for name, row in zip(names, bundle(some["text"].tolist(), owners, len(names), dimensions), strict=True):
                    found[name] = found.get(name, 0) + row.astype(np.int64)
        if found:
            yield pd.DataFrame({"lang": list(found), "sums": [v.tolist() for v in found.values()]})

    parts = training.select("lang", "text").mapInPandas(sums, "lang string, sums array<bigint>")
    each = parts.select("lang", F.posexplode("sums").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    rows = each.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "x")))["x"].alias("sums")).collect()
    prototypes = {r.lang: np.array(r.sums, float) for r in rows}
    return {name: v / np.linalg.norm(v) for name, v in sorted(prototypes.items()) if v.any()}


def classify(texts: pd.Series, prototypes: dict[str, np.ndarray], dimensions: int = DIMENSIONS) -> tuple[list, list]:
    """The nearest language of each text and its cosine, rounded and not below 0."""
    names, matrix = list(prototypes), np.array([*prototypes.values()]).reshape(-1, dimensions).T
    langs, scores = [], []
    for k in range(0, len(texts), TEXTS):
        some = [t or "" for t in texts.iloc[k : k + TEXTS]]
        vectors = bundle(some, np.arange(len(some)), len(some), dimensions)
        norms = np.linalg.norm(vectors, axis=1)
        cosines = vectors @ matrix / np.where(norms, norms, 1)[:, None] if names else np.zeros((len(some), 1))
        best = cosines.argmax(axis=1)
        known = [bool(names) and any(map(str.isalpha, t)) for t in some]
        langs += [names[b] if ok else UNKNOWN for b, ok in zip(best, known, strict=True)]
        scores += [round(min(1.0, max(0.0, c)), 9) if ok else 0.0 for c, ok in zip(cosines.max(axis=1).tolist(), known, strict=True)]
    return langs, scores


def identify(docs: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document, a row per row.

    Prototypes are learned from text and non-null lang of the documents that are not held out;
    prediction reads the text alone. Null texts and texts without a letter are ``und`` with
    score 0, as is every text if nothing could be learned. Equal cosines go to the first
    language by name.
    """
    prototypes = learn(docs, dimensions)

    @releasing
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = classify(batch.column(2).to_pandas(), prototypes, dimensions)
            found = [batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(found, names=["doc_id", "held_out", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    marked = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return marked.mapInArrow(predict, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def keep_known(docs: DataFrame, min_score: float = MIN_SCORE, dimensions: int = DIMENSIONS) -> DataFrame:
    """The documents of a known language, with their columns as they were.

    ``und`` goes, and what is less like any prototype than ``min_score``.
    """
    prototypes = learn(docs, dimensions)

    at = docs.columns.index("text")

    @releasing
    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = classify(batch.column(at).to_pandas(), prototypes, dimensions)
            good = (np.array(langs, object) != UNKNOWN) & (np.array(scores, float) >= min_score)
            yield batch.filter(pa.array(good))

    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return numbered.mapInArrow(known, numbered.schema).toDF(*docs.columns)
