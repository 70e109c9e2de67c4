"""Prefix trie, archives and alignment against brute force."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vouch.llm import alignment, prefixes, stretches, warc
from vouch.llm.csr import Csr
from vouch.llm.queries import piece_model, vocabulary

TURNS = "conv_id bigint, turn bigint, role string, text string"
BIG = 2**60 + 1


def rows_of(df, *names):
    return sorted(repr(tuple(r)) for r in df.select(*names).collect())


# --- op11


def trie(rows):
    turns: dict[int, list] = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns.setdefault(conv, []).append(((turn is not None, turn or 0), tie, (role, text)))
    turns = {c: [t for _, _, t in sorted(x)] for c, x in turns.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = (*turns.get(c - c % 5, [])[:h], *own[h:])
    members: dict[tuple, list] = {}
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members.setdefault(built[c][:d], []).append(c)
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        ends = ",".join(str(c) for c in convs if len(built[c]) == len(node))
        yield (
            convs[0], len(node), members[node[:-1]][0] if node else None, len(convs),
            sum(len(n) == len(node) + 1 for n in below), sum(not any(m[: len(n)] == n and m != n for m in below) for n in below),
            sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n), hashlib.sha256(ends.encode()).hexdigest(),
        )


NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def chats():
    rng = random.Random(4)
    rows = []
    for c in [*range(40), 1000, 1001]:
        for t in range(rng.choice([0, 1, 2, 5, 9, 12])):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["hi", "é", "", None, f"own {c} {t}"])))
    rows += [(50, None, "user", "no turn"), (50, 0, "user", "b"), (50, 0, "user", "a"), (50, 0, "user", "a"), (None, 0, "user", "lost")]
    copies = [(c, t, "user", f"same {t}") for c in range(60, 90) for t in range(4)]
    return rows + copies + [(100, t, "user", f"long {t % 7}") for t in range(120)] + [(105, t, "user", f"long {t % 7}") for t in range(119)]


@pytest.mark.parametrize("width", [None, 1 << 12, 64])
def test_trie_matches_brute_force(spark, width):
    rows = chats()
    frame = spark.createDataFrame(rows, TURNS).withColumn("seg", F.lit("own")).withColumn("a.b", F.lit(1))
    got = rows_of(prefixes.prefix_trie(frame.repartition(5), width), *NODE)
    assert got == sorted(map(repr, trie(rows)))


def test_trie_of_nothing_and_of_one(spark):
    frame = spark.createDataFrame(chats(), TURNS)
    assert prefixes.prefix_trie(frame.where("false")).count() == 0
    assert prefixes.prefix_trie(frame.where("conv_id is null")).count() == 0
    one = [(7, 0, "user", "x")]
    assert rows_of(prefixes.prefix_trie(spark.createDataFrame(one, TURNS)), *NODE) == sorted(map(repr, trie(one)))


def test_sketch_never_counts_too_few():
    rng = np.random.default_rng(1)
    k1, k2 = (rng.integers(0, 2**62, 3000) for _ in range(2))
    k1[:600], k2[:600] = k1[0], k2[0]
    parts = [prefixes.Sketch(256), prefixes.Sketch(256)]
    for part, half in zip(parts, (slice(None, 1500), slice(1500, None)), strict=True):
        part.add(k1[half], k2[half])
    whole = prefixes.Sketch(256)
    for part in parts:
        for number, cells in part.blocks():
            whole.merge(number, cells)
    true = Counter(zip(k1.tolist(), k2.tolist(), strict=True))
    estimates = whole.estimate(k1, k2)
    assert all(e >= min(true[key], 255) for e, key in zip(estimates.tolist(), zip(k1.tolist(), k2.tolist(), strict=True), strict=True))


def test_ends_over_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "PIECE", 20)
    ids = spark.range(0, 4000, 1, 7).select((F.col("id") % 3).alias("k1"), F.lit(0).cast("bigint").alias("k2"), F.col("id").alias("conv_id"))
    got = {r.k1: r.ends_sha256 for r in prefixes._end_hashes(ids).collect()}
    assert got == {k: hashlib.sha256(",".join(map(str, range(k, 4000, 3))).encode()).hexdigest() for k in range(3)}


# --- op12

PAGES = "page_id bigint, url string, html string"


def pages():
    rows = [(i, f"http://h/{i % 40}", f"<p>é {i % 60}</p>\r\n\r\n" * (i % 9 + 1)) for i in range(200)]
    odd = [(300, "u", None), (301, None, ""), (None, "u", "x"), (None, "v", "x"), (None, "v", "x"), (BIG, "a b\r\nX: é%", "big"), (302, "", "y" * 300_000)]
    return rows + odd + [(7, "http://h/7", rows[7][2])] * 3 + [(400 + i, "hot", "hot") for i in range(150)]


def archived(rows, least=0):
    order = lambda row: ((row[0] is not None, row[0] or 0), (row[1] is not None, row[1] or ""))
    groups: dict[str, list] = {}
    for row in rows:
        groups.setdefault(row[2] or "", []).append(row)
    for html, group in groups.items():
        octets = html.encode()
        digest = base64.b32encode(hashlib.sha1(octets).digest()).decode()
        top, *rest = sorted(group, key=order, reverse=True)
        yield top[0], len(octets), digest, "response", None
        for row in rest:
            again = len(octets) >= least
            yield row[0], len(octets), digest, "revisit" if again else "response", top[0] if again else None


FOUND = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@pytest.mark.parametrize("least", [0, 4])
def test_archives_match_brute_force(spark, least):
    frame = spark.createDataFrame(pages(), PAGES).withColumn("key", F.lit("own")).withColumn("a.b", F.lit(1)).repartition(5)
    assert rows_of(warc.archive_digests(frame, min_bytes=least), *FOUND) == sorted(map(repr, archived(pages(), least)))


def test_archives_are_read_by_their_index(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 4000)
    monkeypatch.setattr(warc, "HELD", 100)
    index = warc.write_archives(spark.createDataFrame(pages(), PAGES).repartition(3), str(tmp_path / "w"))
    entries = index.collect()
    assert len(entries) == len(pages())
    # read from start to end, member by member, the files hold the records of the index and no others
    found = set()
    for path in (tmp_path / "w").glob("*.warc.gz"):
        data, at = path.read_bytes(), 0
        while at < len(data):
            member = zlib.decompressobj(31)
            text = member.decompress(data[at:])
            length = len(data) - at - len(member.unused_data)
            assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")
            found.add((path.name, at, length))
            at += length
    assert found == {(r.file, r.offset, r.length) for r in entries} and len({f for f, _, _ in found}) > 3
    # some records alone; revisits come with the payload of their response
    chosen = index.where("page_id % 7 = 0 or page_id is null")
    html = Counter((i, u, (h or "").encode()) for i, u, h in pages() if i is None or i % 7 == 0)
    assert Counter((r.page_id, r.url, bytes(r.html)) for r in warc.read_pages(chosen, index, str(tmp_path / "w")).collect()) == html
    assert warc.read_records(index.where("false"), str(tmp_path / "w")).count() == 0


def test_no_pages(spark):
    assert warc.archive_digests(spark.createDataFrame([], PAGES)).count() == 0


def test_ranges_merge_neighbours():
    places = [("a", 0, 10), ("a", 10, 5), ("a", 15 + warc.GAP, 5), ("a", 21 + 2 * warc.GAP + 1, 5), ("b", 0, warc.READ), ("b", warc.READ, 1)]
    assert [(f, s, e, m) for f, s, e, m in warc.ranges(places)] == [
        ("a", 0, 20 + warc.GAP, [0, 1, 2]), ("a", 22 + 2 * warc.GAP, 27 + 2 * warc.GAP, [3]), ("b", 0, warc.READ, [4]), ("b", warc.READ, warc.READ + 1, [5]),
    ]


def test_broken_records_are_refused():
    fields = {"WARC-Type": "response", "WARC-Record-ID": "<x>", "WARC-Payload-Digest": "sha1:" + warc.base32_sha1(b"other")}
    with pytest.raises(ValueError, match="changed payload"):
        warc.parse(warc.record(fields, b"payload"))


# --- op13


TEXTS = [
    "plain words, and more", " x", "x ", "a  b", "a\n b", "a \n  b  ", "\t x  y", "▁x y", "<|endoftext|> <s> é漢\U0001f600 z", "", None, " ", "  ", "a\x00b c",
    "x　 y  ", "don't  we'll go", "word" * 3000, "hot hot hot " * 200, "plain words, and more", "  z   z", "tail <|endoftext|>",
]


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(vocabulary(), piece_model())


def tokens(aligner, text):
    """Ids and pieces of both sides of a whole text by the two libraries; nothing where they do not spell it."""
    if not text:
        return [], [], [], []
    a = aligner.a.encoder.tokenizer.encode(" " + text, add_special_tokens=False).ids
    b = aligner.b.model.encode(text)
    pieces = [aligner.a.pieces[i] for i in a], [aligner.b.pieces[i] for i in b]
    good = all(b"".join(p) == (" " + text).encode() for p in pieces)
    return (a, b, *(np.cumsum([len(x) for x in p]).tolist() for p in pieces)) if good else ([], [], [], [])


def brute(aligner, rows):
    count: Counter = Counter()
    docs = []
    for i, text in rows:
        a, b, ends_a, ends_b = tokens(aligner, text)
        common = sorted({*ends_a} & {*ends_b})
        links = [(a[ends_a.index(c)], b[ends_b.index(c)]) for c in common]
        groups, low = [], 0
        for c in common:
            sides = [",".join(str(t) for t, e in zip(ids, ends, strict=True) if low < e <= c) for ids, ends in ((a, ends_a), (b, ends_b))]
            groups.append("|".join(sides))
            low = c
        count.update(links)
        docs.append((i, a, b, groups, links))
    most: Counter = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    for i, a, b, groups, links in docs:
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        yield i, len(a), len(b), len(groups), len(links), sum(count[p] == most[p[1]] for p in links), sum(count[p] for p in links), digest


SCORES = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_alignment_matches_brute_force(spark, aligner):
    rows = [(BIG + i if i % 2 else None, t) for i, t in enumerate(TEXTS)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("pairs", F.lit("own")).repartition(3)
    found = alignment.link_scores(frame, vocabulary(), piece_model())
    assert rows_of(found, *SCORES) == sorted(map(repr, brute(aligner, rows)))
    assert alignment.link_scores(frame.where("false"), vocabulary(), piece_model()).count() == 0


def test_alignment_in_small_steps(aligner):
    distinct, _, _ = aligner.cut(pa.array(TEXTS))
    whole, steps = aligner.align(distinct), aligner.align(distinct, 3)
    assert whole.texts == steps.texts and whole.pairs.values.tolist() == steps.pairs.values.tolist()
    assert whole.n_groups.tolist() == steps.n_groups.tolist()


@pytest.mark.parametrize("kind", alignment.KINDS)
def test_links_of_every_kind(spark, aligner, kind):
    rows = [(i, t) for i, t in enumerate(TEXTS) if t is None or len(t) < 200]
    found = alignment.token_links(spark.createDataFrame(rows, "doc_id int, text string"), vocabulary(), piece_model(), kind)
    expected = []
    for i, text in rows:
        a, b, ends_a, ends_b = tokens(aligner, text)
        common = sorted({*ends_a} & {*ends_b})
        for x, end_a in enumerate(ends_a):
            for y, end_b in enumerate(ends_b):
                shared = min(end_a, end_b) - max(([0] + ends_a)[x], ([0] + ends_b)[y])
                group = sum(c < end_a for c in common) == sum(c < end_b for c in common)
                if {"overlap": shared > 0, "end": end_a == end_b, "group": group}[kind]:
                    expected.append((i, x, y, a[x], b[y], max(0, shared)))
    assert rows_of(found, "doc_id", "a_place", "b_place", "a_id", "b_id", "shared") == sorted(map(repr, expected))


def test_windows_give_the_same_overlaps():
    rng = np.random.default_rng(2)
    ends = [np.unique(np.append(rng.integers(1, 5000, 900), 5000)) for _ in range(2)]
    whole = alignment.overlaps(*ends)
    for window in (1, 10, 1000):
        for x, y in zip(whole, alignment.overlaps(*ends, window), strict=True):
            assert x.tolist() == y.tolist()


def test_product_of_sparse_matrices():
    rng = np.random.default_rng(3)
    dense = [rng.integers(0, 3, size) * (rng.random(size) < 0.3) for size in ((17, 23), (23, 11), (0, 23), (23, 0))]

    def sparse(m):
        rows, columns = np.nonzero(m)
        return Csr(np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=m.shape[0]))]), columns, m[rows, columns], m.shape[1])

    for x, y in ((0, 1), (2, 1), (0, 3)):
        product = sparse(dense[x]).times(sparse(dense[y]))
        back = np.zeros((dense[x].shape[0], dense[y].shape[1]), int)
        back[product.rows(), product.columns] = product.data
        assert (back == dense[x] @ dense[y]).all()
    turned = sparse(dense[0]).transposed()
    assert turned.width == 17 and (np.diff(turned.ends) == (dense[0] > 0).sum(axis=0)).all()


def test_pairs_stay_within_the_bound(aligner):
    assert 50_000 < alignment.most_pairs(vocabulary(), piece_model()) < 1_000_000


# --- stretches


def test_stretches_are_encoded_as_whole_texts_are():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(vocabulary())
    rng = random.Random(6)
    parts = ["a", "é", " ", "  ", "\n", "\t", "word", "'s", "1", ".", " ", " ", "\x1c", "漢", "<|endoftext|>", "​"]
    texts = TEXTS + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(1500)]
    encoder = stretches.Encoder(vocabulary())
    assert encoder.ranked is not None
    array = pa.array(texts)
    for start, stop in stretches.slices(array, 2000):
        distinct, codes, ends = stretches.cut(array.slice(start, stop - start))
        ids = encoder.encode(distinct).take(codes)
        bounds = np.concatenate([[0], np.cumsum(ids.lengths)[ends - 1]]).tolist()
        for k, text in enumerate(texts[start:stop]):
            assert ids.values[bounds[k] : bounds[k + 1]].tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids, repr(text)


def test_other_vocabularies_go_through_the_tokenizer():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        encoder = stretches.Encoder(file.read())
    assert encoder.ranked is None
    assert encoder.encode(["one two", ""]).lengths.tolist() == [2, 0]
