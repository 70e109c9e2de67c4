"""Values that must come through unchanged, names that must not clash, and tables of odd shapes."""

from __future__ import annotations

import hashlib
import random
from datetime import datetime
from decimal import Decimal

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from vouch.llm import embeddings, language, packing, quality, simhash, suffixes, tool_calls
from vouch.llm.queries import vocabulary

BIG = 2**60 + 1
PROSE = "the quick brown fox jumps over the lazy dog near the river bank while many birds sing "


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(8)
    words = PROSE.split()
    rows = []
    for i in range(40):
        text = " ".join(rng.choice(words) + str(rng.randint(0, 9)) for _ in range(80))
        rows.append((None if i % 4 == 3 else BIG + 2 * i, text, "en", BIG + i if i % 2 else None, datetime(2020, 1, 1, 0, 0, i), Decimal("12345678901234567.89"), [i, None]))
    rows.append((BIG + 900, None, None, None, None, None, None))
    kinds = "doc_id bigint, text string, lang string, big bigint, at timestamp, exact decimal(20,2), listed array<bigint>"
    frame = spark.createDataFrame(rows, kinds).withColumns({"words": F.lit("own words"), "__fingerprint": F.lit(1), "a.b": F.lit("dot"), "row": F.lit(5), "base": F.lit(9)})
    return frame.coalesce(1)


def ids(df):
    return sorted(str(r.doc_id) for r in df.select("doc_id").collect())


def test_whole_numbers_beside_nulls_stay_as_they_are(odd):
    given = ids(odd)
    assert ids(simhash.near_duplicates(odd)) == given
    assert ids(language.identify(odd)) == given
    assert ids(suffixes.digests(odd)) == given
    labels = odd.select("doc_id", F.lit(1).alias("quality"))
    assert ids(quality.judge(odd, labels)) == given
    pieces = packing.pack_documents(odd, vocabulary())
    assert ids(pieces.select("doc_id", "ids_crc32", "start").where("start = 0")) == given


def test_filters_keep_every_column(odd):
    labels = odd.select("doc_id", F.lit(1).alias("quality"))
    whole = {str(tuple(r)) for r in odd.collect()}
    kept = [
        quality.keep(odd, labels, threshold=-(10**9)), language.keep_known(odd, min_score=0.0),
        simhash.keep_first(odd), suffixes.remove_repeats(odd),
    ]
    for result in kept:
        assert result.columns == odd.columns and [f.dataType for f in result.schema] == [f.dataType for f in odd.schema]
        rows = {str(tuple(r)) for r in result.collect()}
        assert len(rows) >= 38 and rows <= whole


def test_added_columns_replace_those_of_the_same_name(odd):
    labels = odd.select("doc_id", F.lit(1).alias("quality"))
    judged = quality.judge(odd.withColumn("kept", F.lit("old")), labels)
    assert dict(judged.dtypes)["kept"] == "boolean" and judged.columns.count("kept") == 1
    assert {r.words for r in judged.collect()} == {"own words"}


def test_a_stage_after_the_other_on_odd_rows(spark, odd):
    docs = odd
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, "unused"))
        assert docs.columns == odd.columns, name
    assert set(ids(docs)) <= set(ids(odd)) and docs.count() >= 38


# --- vectors


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")


@pytest.mark.parametrize("rows", [
    [(1, [1.0, 2.0])],
    [(1, [1.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0, 1.0])],
    [(1, None)],
    [(1, [0.0, 0.0]), (2, [float("nan"), 1.0])],
    [],
])
def test_vectors_that_stand_alone(spark, rows):
    found = embeddings.near_duplicates(vectors(spark, rows)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in found) == [(i, 0, i, True) for i, _ in sorted(rows)]


def test_block_pairs_with_one_vector(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=8) * 0.01 + np.eye(8)[0]).tolist()) for i in range(7)] + [(BIG, [0.0] * 7 + [1.0]), (None, [0.0] * 6 + [1.0, 0.0])]
    graph = embeddings.Graph(block=1)
    found = {r.vec_id: r for r in embeddings.near_duplicates(vectors(spark, rows), graph).collect()}
    assert all(found[i].n_links == 6 and found[i].component_id == 0 for i in range(7))
    assert found[BIG].n_links == 0 and found[BIG].component_id == BIG


# --- a doc_id of many texts


def brute(rows):
    order = lambda i: float("inf") if i is None else i
    first: dict[bytes, float] = {}
    for i, text in rows:
        octets = (text or "").encode()
        for k in range(len(octets) - 49):
            first[octets[k : k + 50]] = min(first.get(octets[k : k + 50], order(i)), order(i))
    for i, text in rows:
        octets = (text or "").encode()
        gone = np.zeros(len(octets), bool)
        for k in range(len(octets) - 49):
            if first[octets[k : k + 50]] < order(i):
                gone[k : k + 50] = True
        left = bytes(np.frombuffer(octets, np.uint8)[~gone])
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        yield i, len(octets), int(gone.sum()), runs, hashlib.sha256(left).hexdigest()


@pytest.mark.parametrize("hot", [None, 5, 2**63 - 1])
def test_a_doc_id_of_many_texts(spark, hot, monkeypatch):
    monkeypatch.setattr(suffixes, "FLUSH", 2000)
    rng = random.Random(9)
    passages = ["".join(rng.choice("abcdefgh ") for _ in range(120)) for _ in range(12)]
    rows = [(i, "".join(rng.choice(passages)[: rng.randint(40, 120)] + str(rng.random()) for _ in range(3))) for i in range(60)]
    rows += [(hot, "".join(rng.choice(passages)[: rng.randint(40, 120)] + str(rng.random()) for _ in range(3))) for _ in range(300)]
    rows += [(hot, rows[-1][1])] * 20 + [(hot, None), (hot, "")]
    found = suffixes.digests(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4))
    if hot == 2**63 - 1:  # equals the place of null in the order, which has no row here
        assert found.where(F.col("doc_id") == hot).count() == 322
    assert sorted(repr(tuple(r)) for r in found.collect()) == sorted(map(repr, brute(rows)))


# --- chats


def test_every_turn_has_a_row(spark):
    kinds = "conv_id bigint, turn bigint, role string, text string"
    turns = [(1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "ho"), (1, 3, None, None), (None, 0, "user", "lost"), (2, None, "assistant", "x"), (2, 0, "tool", 'a "b"\n')]
    found = tool_calls.format_chats(spark.createDataFrame(turns, kinds)).collect()
    notes = {(r.conv_id, r.turn): r.json for r in found if r.status == "message"}
    assert notes == {
        (1, 0): '{"content":"be kind","role":"system"}', (1, 3): '{"content":null,"role":null}', (None, 0): '{"content":"lost","role":"user"}',
        (2, None): '{"content":"x","role":"assistant"}', (2, 0): '{"content":"a \\"b\\"\\n","role":"tool"}',
    }
    assert {r.status for r in found} == {"message", "linked"} and len(found) == 6
    assert tool_calls.format_chats(spark.createDataFrame([], kinds)).count() == 0


def test_arguments_by_the_rules_of_json(spark):
    schema = {"f": {"type": "object", "properties": {"n": {"type": "integer", "enum": [1]}}}}
    deep = "[" * 100_000 + "]" * 100_000
    rows = [(1, 0, "a", "f", '{"n":1.0}', []), (1, 1, "b", "f", '{"n":true}', []), (1, 2, "c", "f", deep, []), (1, 3, "d", "f", '{"n":1}', [])]
    calls = spark.createDataFrame(rows, "conv_id int, turn int, call_id string, name string, arguments string, after array<string>")
    results = spark.createDataFrame([], "conv_id int, turn int, call_id string, content string")
    found = {r.call_id: r.faults for r in tool_calls.link(calls, results, schema).collect()}
    assert found == {"a": [], "b": ["/n: not integer"], "c": ["/: not JSON"], "d": []}
    assert tool_calls.same(True, True) and not tool_calls.same(True, 1) and tool_calls.same([1, {"a": 1}], [1.0, {"a": 1}])


def test_vectors_without_an_id_link_with_each_other(spark):
    rows = [(None, [1.0, 0.0]), (None, [1.0, 0.0]), (4, [0.0, 1.0])]
    found = embeddings.near_duplicates(vectors(spark, rows)).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in found), key=str) == [(4, 0, 4, True), (None, 1, None, True), (None, 1, None, True)]
