"""The operators against brute force, on small rows with nulls, empty and long texts, ties and repeats."""

from __future__ import annotations

import hashlib
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from vouch.llm import bpe, embeddings, frames, language, packing, quality, sharding, simhash, suffixes, tool_calls, urls
from vouch.llm.components import connected_components
from vouch.llm.queries import URL_RULES, vocabulary

DOCS = "doc_id bigint, text string, lang string"
WORDS = ["alpha", "beta", "gamma", "the", "of", "ößt", "x", "delta.", "Éa"]


def texts() -> list[tuple]:
    """Random texts and copies of parts of them, then the odd cases."""
    rng = random.Random(5)
    rows: list[tuple] = []
    for i in range(150):
        text = " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 150)))
        if rows and rng.random() < 0.4:
            other = rng.choice(rows)[1]
            a = rng.randint(0, len(other))
            text = text[:30] + other[a : a + rng.randint(0, 300)] + text[30:]
        rows.append((i, text, "en"))
    copy = rows[3][1]
    odd = [(200, copy, "en"), (200, copy, "en"), (200, "a" * 400, None), (None, copy, "en"), (None, None, None)]
    odd += [(201, None, "en"), (202, "", "en"), (203, " \t\n", "en"), (204, "a" * 49, None), (205, "one", None)]
    return rows + odd + [(206, "long words " * 20_000, "en"), (207, "\n".join(["same line"] * 40), "en")]


@pytest.fixture(scope="module")
def rows():
    return texts()


@pytest.fixture(scope="module")
def docs(spark, rows):
    # a column named like those the operators add
    return spark.createDataFrame(rows, DOCS).withColumn("n_words", F.lit("own")).withColumn("base", F.lit(1))


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def same(got, expected):
    assert sorted((repr(tuple(r)) for r in got)) == sorted(map(repr, expected))


def split(text):
    return (text or "").encode().split()


def test_components(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 102), (102, 101), (7, 7), (None, 3), (100, 102)]
    found = {r.id: r.component for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {**{k: 0 for k in range(41)}, 100: 100, 101: 100, 102: 100}


# --- op1


def test_embeddings_match_brute_force(spark):
    rng = np.random.default_rng(1)
    points = rng.normal(size=(400, 8))
    near = np.repeat(points[:6], 12, axis=0) + rng.normal(size=(72, 8)) * 0.1
    vectors = [x.tolist() for x in np.concatenate((points, near, points[:3], points[:2] * 5))]
    vectors += [None, [], [0.0] * 8, [float("nan")] * 8, [float("inf")] + [0.0] * 7, [None] + [1.0] * 7, [1.0, 2.0], [2.0, 4.0]]
    given = [*enumerate(vectors), (None, vectors[0])]
    frame = spark.createDataFrame(given, "vec_id bigint, embedding array<double>").withColumn("key", F.lit(1))
    good = [(i, np.array(v)) for i, v in given if v and None not in v and np.isfinite(v).all() and np.any(v)]
    cosine = lambda a, b: len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.9
    linked = {k: [m for m in range(len(good)) if m != k and cosine(good[k][1], good[m][1])] for k in range(len(good))}
    component = {}
    for start in range(len(good)):
        reached, todo = {start}, [start]
        while todo:
            new = set(linked[todo.pop()]) - reached
            reached |= new
            todo += new
        component[good[start][0]] = min(good[m][0] for m in reached if good[m][0] is not None)
    links = {i: len(linked[k]) for k, (i, _) in enumerate(good)}
    for graph in (embeddings.DEFAULT, embeddings.Graph(shard=60, block=40)):
        result = embeddings.near_duplicates(frame, graph)
        found = {r.vec_id: r for r in result.collect()}
        right = sum(found[i].n_links == links.get(i, 0) for i, _ in given)
        assert right >= 0.99 * len(given)
        assert sum(r.n_links for r in found.values()) <= sum(links.values())
        assert sum(found[i].component_id == component.get(i, i) for i, _ in given) >= 0.99 * len(given)
        assert found[None].component_id == 0
    checked = embeddings.audit(frame, result).agg(F.sum("expected"), F.sum("found")).first()
    assert checked[1] >= 0.9 * checked[0]
    assert embeddings.near_duplicates(frame.where("false")).count() == 0


# --- op2


def test_hosts_and_rules(spark):
    cases = [
        ("http://A.Net/x", "a.net", "/x", "net/", "block"),
        ("https://b.EXAMPLE.net/en/1?q#f", "b.example.net", "/en/1", "example.net/en/", "allow"),
        ("x://example.com/de/", "example.com", "/de/", "example.com/de/", "block"),
        ("x://notexample.com/de/", "notexample.com", "/de/", None, "allow"),
        ("x://c.org/fr/a", "c.org", "/fr/a", "org/fr/", "allow"),
        ("x://net", "net", "", None, "block"),  # host of a seed
        ("x://net/", "net", "/", "net/", "block"),
        ("no scheme", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("", "", "", None, "allow"),
    ]
    html = '<a href="https://net/a">x</a> <A HREF=//Evil.info/b> <a href="/own">'
    pages = spark.createDataFrame([(k, c[0], html if k == 3 else None) for k, c in enumerate(cases)], "page_id int, url string, html string")
    found = urls.judge_pages(pages, URL_RULES).orderBy("page_id").collect()
    # the page that links to a blocked host is distrusted
    expected = [(k, *c[1:4], "block" if k == 3 else c[4]) for k, c in enumerate(cases)]
    assert [tuple(r)[:5] for r in found] == expected
    assert urls.judge_pages(pages.where("false"), URL_RULES).count() == 0


def test_verdicts_do_not_depend_on_the_number_of_seeds(spark):
    kind = "page_id bigint, url string, html string"
    graph = [(0, "x://b.net/", None), (1, "x://g.org/fr/", '<a href="//both.info/">'), (2, "x://both.info/", '<a href="//b.net/">')]
    graph += [(k, f"x://h{k}.info/", '<a href="//b.net/">') for k in range(3, 2001)]
    small = spark.createDataFrame(graph, kind)
    # as many seeds of both kinds as 200,000 copies of the seeds above have, apart from the graph
    other = spark.range(4000, 404_000).selectExpr("id", "if(id % 2 = 0, 'x://o.net/', 'x://o.org/fr/')", "string(null)")
    for pages in (small, small.unionAll(other)):
        found = {r.page_id: r.verdict for r in urls.judge_pages(pages, URL_RULES).where("page_id < 4000").collect()}
        # distrusted hosts without trust, and one with more trust than distrust
        assert found == {0: "block", 1: "allow", 2: "allow", **dict.fromkeys(range(3, 2001), "block")}


# --- op3


def fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    size = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[k : k + size]), 42) for k in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_matches_brute_force(docs, rows, empty):
    prints = [fingerprint(t) for _, t, _ in rows]
    component = {}
    for start in set(prints):
        reached, todo = {start}, [start]
        while todo:
            p = todo.pop()
            new = {q for q in prints if (p ^ q).bit_count() <= 3} - reached
            reached |= new
            todo += new
        component[start] = min((i for (i, _, _), q in zip(rows, prints, strict=True) if q in reached and i is not None), default=None)
    expected = [(i, f"{p:016x}", component[p]) for (i, _, _), p in zip(rows, prints, strict=True)]
    same(simhash.near_duplicates(docs).collect(), expected)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for c in component.values()})
    assert simhash.near_duplicates(empty).count() == 0


def test_every_group_keeps_a_row(spark):
    a, b, c, d = ("alpha beta gamma", "the of delta", "one two three four", "five six seven")
    given = [(None, a, "x"), (None, a, "y"), (None, b, None), (1, b, None), (7, c, None), (7, d, None), (2, c, None)]
    kept = simhash.keep_first(spark.createDataFrame(given, DOCS)).collect()
    same([(r.doc_id, r.text) for r in kept], [(None, a), (1, b), (2, c), (7, d)])
    near = "alpha beta gamma the of " * 40
    given = [(None, near + "x"), (None, near + "y"), (None, near + "y")]
    assert (fingerprint(given[0][1]) ^ fingerprint(given[1][1])).bit_count() <= 3
    assert simhash.keep_first(spark.createDataFrame(given, DOCS.rsplit(",", 1)[0])).count() == 1


def test_near_links_are_complete(spark):
    rng = random.Random(2)
    points = [rng.getrandbits(64) for _ in range(300)]
    points += [p ^ sum(1 << b for b in rng.sample(range(64), k)) for p in points[:100] for k in (1, 2, 3, 4)]
    points = list(dict.fromkeys(points))
    signed = [(p - (1 << 64) if p >> 63 else p, k) for k, p in enumerate(points)]
    found = simhash.near_links(spark.createDataFrame(signed, "fingerprint bigint, rep bigint")).collect()
    expected = {(a, b) for b in range(len(points)) for a in range(b) if (points[a] ^ points[b]).bit_count() <= 3}
    assert {tuple(sorted(r)) for r in found} == expected


# --- op4


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert found.where("lang = lang_pred").count() >= 0.95 * found.count()


def test_language_of_odd_texts(docs, rows, empty):
    found = language.identify(docs).collect()
    assert len(found) == len(rows)
    for row, (_, text, _) in zip(found, rows, strict=True):
        letters = any(map(str.isalpha, text or ""))
        assert (row.lang_pred == "und") == (not letters) and 0 <= row.score <= 1
        crc = zlib.crc32(str(row.doc_id).encode()) % 5 == 0 if row.doc_id is not None else False
        assert row.held_out == crc
    assert language.identify(empty).count() == 0
    assert {r.lang_pred for r in language.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    kept = language.keep_known(docs, 0.0)
    assert kept.columns == docs.columns and kept.count() == sum(any(map(str.isalpha, t or "")) for _, t, _ in rows)


def test_bundles_are_sums_of_trigrams(monkeypatch):
    texts = ["Ab, ba!", "x", "abc " * 500, "", "日本語テキスト"]
    whole = language.bundle(texts, np.arange(5), 5)

    def vector(c):
        return language.letter_vectors(np.array([c]))[0].astype(int)

    for text, row in zip(texts, whole, strict=True):
        line = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
        points = [0 if c == " " else ord(c) for c in line] if line.strip() else []
        total = np.zeros(language.DIMENSIONS)
        for a, b, c in zip(points, points[1:], points[2:]):  # noqa: B905
            total += np.roll(vector(a), 2) * np.roll(vector(b), 1) * vector(c)
        assert (row == total).all()
    monkeypatch.setattr(language, "LETTERS", 7)
    assert (language.bundle(texts, np.arange(5), 5) == whole).all()


# --- op5


def repeats(rows):
    order = lambda i: float("inf") if i is None else i
    first: dict[bytes, float] = {}
    for i, text, _ in rows:
        octets = (text or "").encode()
        for k in range(len(octets) - 49):
            key = octets[k : k + 50]
            first[key] = min(first.get(key, order(i)), order(i))
    for i, text, _ in rows:
        octets = (text or "").encode()
        gone = np.zeros(len(octets), bool)
        for k in range(len(octets) - 49):
            if first[octets[k : k + 50]] < order(i):
                gone[k : k + 50] = True
        left = bytes(np.frombuffer(octets, np.uint8)[~gone])
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        yield i, len(octets), int(gone.sum()), runs, hashlib.sha256(left).hexdigest()


def test_repeated_strings_match_brute_force(docs, rows, empty):
    same(suffixes.digests(docs).collect(), repeats(rows))
    cleaned = suffixes.remove_repeats(docs)
    assert cleaned.columns == docs.columns and cleaned.count() == len(rows)
    assert {r.n_words for r in cleaned.collect()} == {"own"}
    assert suffixes.digests(empty).count() == 0


def test_positions_over_many_batches(docs, rows, monkeypatch):
    monkeypatch.setattr(suffixes, "FLUSH", 50)
    same(suffixes.digests(docs).collect(), repeats(rows))


def test_surroundings_that_agree_in_forty_bits(spark):
    # a common string of 20 bytes; the names of both whole strings differ in the last 24 bits alone
    texts = ["tsukvwbwfdzcfvknxuyerolwsvxitldblszzyjgdetjkcusjxc", "eyuxzggqqtcwzaqnxuyerolwsvxitldblszbowqltcbkedqbdr"]
    a, b = (suffixes.stretches(np.frombuffer(t.encode(), np.uint8)) for t in texts)
    assert a[0] == b[0] and a[1] != b[1] and a[1] >> np.uint64(24) == b[1] >> np.uint64(24)
    given = [(k, t, None) for k, t in enumerate(texts)]
    for parts in (1, 2):  # both in one task, and in two
        frame = spark.createDataFrame(given, DOCS).repartitionByRange(parts, "doc_id")
        same(suffixes.digests(frame).collect(), repeats(given))


def test_a_hot_string_does_not_meet_in_one_task(spark, monkeypatch):
    rng, rank = random.Random(3), suffixes.rank
    letters = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    # the string in the middle has the smallest name of all 20-byte strings of these texts
    found = [letters(15) + "nxuyerolwsvxitldblsz" + letters(15) for _ in range(600)]
    given = [(k, rng.choice(found[:k]) if k % 5 == 4 else t, None) for k, t in enumerate(found)]

    def limited(name, context, doc):
        assert len(name) <= 200
        return rank(name, context, doc)

    monkeypatch.setattr(suffixes, "FLUSH", 50)
    monkeypatch.setattr(suffixes, "HOT", 4, raising=False)
    monkeypatch.setattr(suffixes, "rank", limited)
    frame = spark.createDataFrame(given, DOCS)
    same(suffixes.digests(frame).collect(), repeats(given))


@pytest.mark.parametrize("hot", [0, 1, 3])
def test_hot_names_match_brute_force(docs, rows, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "HOT", hot)
    monkeypatch.setattr(suffixes, "FLUSH", 3000)
    same(suffixes.digests(docs).collect(), repeats(rows))


def left_by_shuffles(spark, wait=0):
    """Bytes that shuffles still hold on disk; files go a moment after the query that wrote them."""
    context = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    for _ in range(wait + 1):
        files = context.blockManager().diskBlockManager().getAllFiles()
        held = {f.getPath(): f.length() for f in (files.apply(k) for k in range(files.size())) if f.getName().startswith("shuffle_")}
        yield held
        time.sleep(0.5)


@pytest.mark.parametrize("query", [suffixes.digests, suffixes.remove_repeats])
def test_a_ranking_leaves_no_shuffle_files(spark, query):
    rng = random.Random(5)
    passages = ["".join(rng.choice("abcdefghijklmnop") for _ in range(90)) for _ in range(40)]
    given = [(k, rng.choice(passages) + "".join(rng.choice("abcdefghijklmnop") for _ in range(2000)) + rng.choice(passages), "") for k in range(300)]
    before = next(left_by_shuffles(spark))
    query(spark.createDataFrame(given, "doc_id bigint, text string, lang string"))  # all rankings; what reads their result has yet to run
    assert any(sum(n for f, n in held.items() if f not in before) < 100_000 for held in left_by_shuffles(spark, 10))


def test_strings_around_a_shared_one_are_not_all_sent(spark, monkeypatch, tmp_path):
    rng, send, sizes = random.Random(4), suffixes._send, str(tmp_path / "sizes")
    letters = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    # the string in the middle has the smallest name of all 20-byte strings of these texts
    found = [letters(30) + "nxuyerolwsvxitldblsz" + letters(30) for _ in range(300)]
    given = [(k, found[k - 7][:k % 80] + t[k % 80 :] if k % 5 == 4 and k > 7 else t, None) for k, t in enumerate(found)]

    def counted(found, *args, **kwargs):
        with open(sizes, "a") as file:
            file.write(f"{sum(len(x[0]) for x in found)}\n")
        return send(found, *args, **kwargs)

    monkeypatch.setattr(suffixes, "_send", counted)
    same(suffixes.digests(spark.createDataFrame(given, DOCS)).collect(), repeats(given))
    # 31 strings of each text have the shared one; hardly any of them repeats
    with open(sizes) as file:
        assert sum(map(int, file)) < 15 * len(given)


@pytest.mark.parametrize("count", [1, 12, 51, 211])
def test_even_keys_meet_in_no_partition(spark, count):
    keys = spark.createDataFrame([(k,) for k in frames.even_keys(count).tolist()], "part int").repartition(count, "part")
    found = keys.select("part", F.spark_partition_id().alias("at")).orderBy("at").collect()
    assert [(r.part, r.at) for r in found] == list(zip(frames.even_keys(count).tolist(), range(count), strict=True))


def test_places_of_strings_in_several_pieces():
    rng = random.Random(6)
    pieces = ["".join(rng.choice("ab") for _ in range(n)).encode() for n in (50, 51, 120, 50, 300)]
    pieces.append(b"a" * 200)
    for gram in suffixes.GRAMS:
        alone = []
        for k, piece in enumerate(pieces):
            at = sum(map(len, pieces[:k]))
            alone += [(n, c, at + f, m) for n, c, f, m in zip(*suffixes.stretches(np.frombuffer(piece, np.uint8), gram), strict=True)]
        sizes = np.array([len(x) for x in pieces])
        assert list(zip(*suffixes.stretches(np.frombuffer(b"".join(pieces), np.uint8), gram, sizes), strict=True)) == alone
        assert sum(x[3] for x in alone) == sum(len(x) - 49 for x in pieces)


# --- op6


def base(text):
    words = [w.decode() for w in split(text)]
    text = text or ""
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    counts = {w: windows.count(w) for w in set(windows)} if len(words) < 5_000 else {w: 2 for w in windows}
    covered = {k + j for k, w in enumerate(windows) if counts[w] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_quality_counts(spark, docs, rows, empty):
    labels = spark.createDataFrame([(i, 1) for i in range(0, 100, 3)] + [(None, 1), (5, None), (6, 0)], "doc_id bigint, quality int")
    found = quality.judge(docs, labels).collect()
    for row, (_, text, _) in zip(found, rows, strict=True):
        n_words, word_chars, symbols, lines, repeat = base(text)
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == (n_words, word_chars, symbols, lines, repeat)
        assert row.base_failed == (n_words < 50 or 100 * repeat > 50 * n_words)
        assert row.kept == (not row.base_failed and row.llr >= quality.THRESHOLD)
    kept = quality.keep(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in found)
    assert quality.judge(empty, labels).count() == 0
    assert quality.judge(docs, labels.where("false")).where("llr <> 0").count() == 0


def test_likelihood_ratio_matches_brute_force(spark, docs, rows):
    trusted = set(range(0, 100, 3))
    labels = spark.createDataFrame([(i, 1) for i in trusted], "doc_id bigint, quality int")

    def grams(text):
        words = split(text)
        hashes = [xxhash.xxh64_intdigest(w, 42) for w in words]
        pairs = [xxhash.xxh64_intdigest(b, a) for a, b in zip(hashes, words[1:])]  # noqa: B905
        # the last word has no pair and counts again
        return [h % quality.BUCKETS for h in hashes + pairs + hashes[-1:]]

    raw, target = np.ones(quality.BUCKETS), np.ones(quality.BUCKETS)
    for i, text, _ in rows:
        found = grams(text)
        np.add.at(raw, found, 1)
        if i in trusted:
            np.add.at(target, found, 1)
    weights = 1e6 * (np.log(target / target.sum()) - np.log(raw / raw.sum()))
    judged = quality.judge(docs, labels).collect()
    for row, (_, text, _) in zip(judged, rows, strict=True):
        found = grams(text)
        if found:
            assert abs(row.llr - weights[found].sum() / len(found)) < 2


def test_long_texts_take_the_other_sort(spark, monkeypatch):
    text = "a b c d a b c e f g a b c"
    frame = spark.createDataFrame([(1, text)], "doc_id int, text string")
    monkeypatch.setattr(quality, "PLACE_BITS", 2)
    assert quality.base_counts(frame).first().n_repeat_words == base(text)[4]


# --- op7


@pytest.fixture(scope="module")
def ranked():
    return bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def test_bpe_matches_the_library(spark, docs, rows, ranked, empty):
    import tiktoken

    encoding = tiktoken.Encoding("own", pat_str=ranked.pattern, mergeable_ranks=ranked.pieces, special_tokens={})
    rng = random.Random(1)
    odd = ["foo   bar", "a\n b", "x \n\n  y", "<|endoftext|> x", "it's we'll\t\tx I'M", "\x1c a \x1d b", "🙂 👍🏽 a  ", "½²³٣", "a" * 150, "中文 テスト"]
    odd += ["".join(rng.choice(" \n\ta b'slé1½中🙂.\u00a0\u2003\x85x TH%") for _ in range(rng.randint(0, 40))) for _ in range(150)]
    given = rows + [(300 + k, t, None) for k, t in enumerate(odd)]

    def expected():
        for i, text, _ in given:
            ids = encoding.encode_ordinary(text or "")
            joined = " ".join(map(str, ids)).encode()
            yield i, len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()

    given_docs = spark.createDataFrame(given, DOCS)
    same(bpe.digests(given_docs, ranked).collect(), expected())
    clash = bpe.encode(given_docs.withColumn("ids", F.lit("x")), ranked)
    assert clash.columns == ["doc_id", "text", "lang", "ids"] and clash.count() == len(given)
    assert bpe.digests(empty, ranked).count() == 0


def test_bpe_folds_alike_at_any_length(ranked):
    import tiktoken

    encoding = tiktoken.Encoding("own", pat_str=r"(?s).+", mergeable_ranks=ranked.pieces, special_tokens={})
    rng, merges = random.Random(2), bpe.Merges(ranked.pieces)
    words = {"".join(rng.choice("abcdet =-é中🙂 ing") for _ in range(rng.randint(1, 90))) for _ in range(400)} | {"=" * 70, "a" * 3000}
    lists, place = merges.encode(pa.array(sorted(words)))
    for word, k in zip(sorted(words), place, strict=True):
        expected = encoding.encode_ordinary(word)
        assert lists[int(k)].as_py() == expected
        assert [merges.fold_long(word.encode())] * (word.encode() not in ranked.pieces) == [expected] * (word.encode() not in ranked.pieces)
    with pytest.raises(ValueError, match="bytes without a piece"):
        bpe.Merges({b"a": 0})


# --- op8


def jump(key, shards):
    at, following = -1, 0
    while following < shards:
        at = following
        key = (key * sharding.MULTIPLIER + 1) % 2**64
        following = int((at + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return at


def test_shards(docs, rows, empty):
    found = sharding.shard_documents(docs, 7).collect()
    key = lambda i: int(hashlib.md5(b"null" if i is None else str(i).encode()).hexdigest()[:15], 16)
    expected = [
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), "key", jump(key(i), 7), jump(key(i), 8)) for i, t, _ in rows
    ]
    same([(r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard) for r in found], expected)
    for shard in {r.shard for r in found}:
        slots = sorted(r.slot for r in found if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert all(r.grown_shard in (r.shard, 7) for r in found)
    assert sharding.shard_documents(empty, 7).count() == 0


def test_slots_over_several_runs(docs, rows, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_RUN", 3)
    found = sharding.shard_documents(docs, 3).collect()
    for shard in range(3):
        slots = sorted(r.slot for r in found if r.shard == shard)
        assert slots == list(range(len(slots)))


def test_texts_of_one_doc_id_are_numbered_in_several_runs(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_RUN", 3)
    found = sharding.shard_documents(spark.createDataFrame([(None, f"text {k}", None) for k in range(100)], DOCS), 3).orderBy("slot").collect()
    assert [r.slot for r in found] == list(range(100))
    # a single run has its rows in the order of their checksums
    sums = [r.text_crc32 for r in found]
    assert sums != sorted(sums)


def test_shards_can_be_written(spark, docs, tmp_path):
    sharding.write_shards(docs, str(tmp_path / "s"), 3)
    assert spark.read.parquet(str(tmp_path / "s")).count() == docs.count()


# --- op9


def test_packing(docs, rows, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(vocabulary())
    capacity = 64
    found = packing.pack_documents(docs, vocabulary(), capacity, with_ids=True).collect()
    expected = []
    for i, text, _ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) % capacity or capacity
        edges = [0, len(ids)] if len(ids) <= capacity else [0, *range(first, len(ids) + 1, capacity)]
        for piece, (a, b) in enumerate(zip(edges, edges[1:])):  # noqa: B905
            expected.append((i, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    same([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found], expected)
    bins: dict[int, list] = {}
    for r in found:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert zlib.crc32(r.ids) == r.ids_crc32
    for pieces in bins.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:k]) for k in range(len(pieces))]
        assert sum(n for _, n in pieces) <= capacity
    total = sum(r.length for r in found)
    assert len(bins) <= 1.02 * -(-total // capacity) + 1
    assert packing.pack_documents(empty, vocabulary()).count() == 0


@pytest.mark.parametrize("low,high,n", [(1, 1023, 800), (300, 700, 500), (340, 345, 100), (513, 600, 50), (1, 3, 500)])
def test_exchanges_never_lose_items(low, high, n):
    rng = random.Random(n)
    lengths = [rng.randint(low, high) for _ in range(n)]
    start = packing.best_fit(lengths)
    before = len(start)
    bins = packing.empty_bins(start, lengths)
    assert sorted(i for b in bins for i in b) == list(range(n))
    assert all(0 < sum(lengths[i] for i in b) <= 1024 for b in bins) and len(bins) <= before


def test_exchanges_empty_a_bin():
    # longest first leaves three bins of ten where two are enough
    lengths = [4, 4, 3, 3, 3, 3]
    assert len(packing.empty_bins([[0, 1], [2, 3, 4], [5]], lengths, 10)) == 2


# --- op10


def test_tool_calls(spark):
    schema = {"type": "object", "properties": {"n": {"type": "integer", "maximum": 5}, "s": {"type": "array", "items": {"type": "string"}}}, "required": ["n"], "additionalProperties": False}
    calls = [
        (1, 0, "a", "f", '{"s": ["é"], "n": 1}', None),
        (1, 1, "b", "f", '{"n": 9, "x": 1}', ["a"]),
        (1, 2, "c", "g", "{}", ["b", "lost"]),
        (1, 3, "a", "f", '{"n": 2}', []),
        (2, 0, "x", "f", '{"n": 1}', ["y"]),
        (2, 1, "y", "f", '{"n": 1}', ["z"]),
        (2, 2, "z", "f", "no json", []),
        (3, 0, "p", "f", '{"n": 1}', ["q"]),
        (3, 1, "q", "f", None, ["p"]),
        (None, 0, "p", "f", "{}", []),
    ]
    results = [(1, 5, "a", "second"), (1, 4, "a", "first"), (2, 9, "lost", None), (3, 1, None, "x")]
    frame = spark.createDataFrame(calls, "conv_id int, turn int, call_id string, name string, arguments string, after array<string>")
    linked = tool_calls.link(frame, spark.createDataFrame(results, "conv_id int, turn int, call_id string, content string"), {"f": schema})
    found = {(r.conv_id, r.call_id): r for r in linked.collect()}
    assert {k: (r.status, r.level, r.valid) for k, r in found.items()} == {
        (1, "a"): ("linked", 0, True),
        (1, "b"): ("unanswered", 0, False),
        (1, "c"): ("unanswered", 0, False),
        (2, "x"): ("unanswered", 2, True),
        (2, "y"): ("unanswered", 1, True),
        (2, "z"): ("unanswered", 0, False),
        (2, "lost"): ("orphan", None, True),
        (3, "p"): ("circular", None, True),
        (3, "q"): ("circular", None, False),
    }
    assert found[1, "a"].json == '{"after":[],"arguments":{"n":1,"s":["é"]},"id":"a","name":"f","result":"first"}'
    assert found[1, "b"].faults == ["/n: out of bounds", "/x: unknown"]
    assert found[1, "c"].faults == ["/: unknown dependency", "/: no schema"]
    assert tool_calls.link(frame.where("false"), spark.createDataFrame([], "conv_id int, turn int, call_id string, content string"), {}).count() == 0


def test_plain_chats(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "ho"), (1, 2, "user", ""), (1, 2, "user", None), (2, 1, "assistant", "x"), (None, 0, "user", "y"), (3, None, "user", "z")]
    found = tool_calls.format_chats(spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")).collect()
    linked = {(r.call_id, r.status, r.valid) for r in found if r.status != "message"}
    assert linked == {("1:0", "linked", True), ("1:2", "unanswered", False), ("2:0", "orphan", True)}
    assert {(r.conv_id, r.turn) for r in found if r.status == "message"} == {(None, 0), (3, None)}
