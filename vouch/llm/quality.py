"""Quality rules: base counts of a text, and a hashed n-gram likelihood ratio (words and pairs of words)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vouch.llm.frames import let, words

#: Buckets of hashed words and word pairs: the size of the model, whatever the corpus.
BUCKETS = 1 << 15
#: Trusted documents that the target counts are fitted on, the first in the order of a hash.
MAX_TRUSTED = 20_000
#: Smallest mean log-likelihood ratio of a kept document, in micro-nats per n-gram.
THRESHOLD = -70_000
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

SYMBOLS = r"[#*$%&|<>]"

#: Bits for a place within a text, beside the upper bits of a hash.
PLACE_BITS = 24


def base_counts(docs: DataFrame) -> DataFrame:
    """The frame with its ``words`` and the base counts; a null text has none of anything."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return with_repeated_words(docs.withColumn("words", words(F.col("text")))).withColumns(
        {
            "n_words": F.size("words").cast("bigint"),
            "word_chars": F.length(F.array_join("words", "")).cast("bigint"),
            "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("bigint"),
            "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint"),
        }
    )


def with_repeated_words(df: DataFrame) -> DataFrame:
    """The frame with ``n_repeat_words``: words in windows of three that occur twice or more.

    Texts whose windows all differ are done after a count of distinct ones. In the others,
    sorting puts equal windows side by side, so a text of n words takes n log n steps however
    often it repeats itself. The first sort is of numbers that hold the upper bits of a
    window's hash and its place; what has a neighbour with the same upper bits is sorted again
    by the whole hash, as is every window of a text whose places need more bits. The steps are
    columns of their own, so that Spark compiles the sorts and works nothing out twice.
    """
    mask = (1 << PLACE_BITS) - 1
    upper = lambda x: F.shiftright(x, PLACE_BITS)
    window = lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))
    no_place = F.array().cast("array<int>")
    hashes, packed, found = F.col("__hashes"), F.col("__packed"), F.col("__found")
    pairs = F.zip_with(
        packed, F.slice(packed, 2, F.size(packed)), lambda a, b: F.when(upper(a) == upper(b), F.array(a, b))
    )
    near = F.array_distinct(F.flatten(F.array_compact(pairs)))
    alike = F.filter(found, lambda x, k: (x["h"] == F.get(found, k + 1)["h"]) | (x["h"] == F.get(found, k - 1)["h"]))
    pack = F.transform(hashes, lambda h, i: h.bitwiseAND(F.lit(~mask)).bitwiseOR(i.cast("bigint")))
    some = F.size(F.array_distinct(hashes)) < F.size(hashes)
    few = F.size(hashes) <= mask
    gaps = F.transform("__places", lambda x, k: F.least(F.lit(3), F.coalesce(F.get("__places", k + 1) - x, F.lit(3))))
    return (
        df.withColumn(
            "__hashes",
            F.when(F.size("words") >= 4, F.transform(F.sequence(F.lit(0), F.size("words") - 3), window)).otherwise(
                F.array().cast("array<bigint>")
            ),
        )
        .withColumn("__packed", F.when(some & few, F.sort_array(pack)))
        .withColumn(
            "__near",
            F.when(packed.isNotNull(), F.transform(near, lambda x: x.bitwiseAND(F.lit(mask)).cast("int")))
            .when(some, F.sequence(F.lit(0), F.size(hashes) - 1))
            .otherwise(no_place),
        )
        .withColumn(
            "__found", F.sort_array(F.transform("__near", lambda i: F.struct(F.get(hashes, i).alias("h"), i.alias("i"))))
        )
        .withColumn("__places", F.sort_array(F.transform(alike, lambda x: x["i"])))
        .withColumn("n_repeat_words", F.aggregate(gaps, F.lit(0).cast("bigint"), lambda a, b: a + b))
        .drop("__hashes", "__packed", "__near", "__found", "__places")
    )


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def bucket(*parts: Column, buckets: int = BUCKETS) -> Column:
    """The bucket of a word, or of a pair of words."""
    return F.pmod(F.xxhash64(*parts), F.lit(buckets)).cast("int")


def fit(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, max_trusted: int = MAX_TRUSTED) -> Column:
    """The weight of each bucket, as an array of micro-nats.

    Two multinomials with one added to each count: the raw one counts every document; the
    target one counts those whose doc_id is among the ``max_trusted`` first of ``trusted``,
    which bounds what is broadcast. The counts combine in each task before the shuffle, so it
    carries a row per bucket and task; the model that reaches the driver has ``buckets`` numbers.
    Repeated doc_ids count as often as they occur. Without trusted documents every weight is 0.
    """
    ids = trusted.select(F.col("doc_id").alias("trusted_id")).dropna().distinct()
    ids = ids.orderBy(F.xxhash64("trusted_id"), "trusted_id").limit(max_trusted)
    marked = docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("trusted_id"), "left")
    listed = marked.select(F.col("trusted_id").isNotNull().alias("target"), words(F.col("text")).alias("words"))
    pairs = F.arrays_zip("words", F.slice("words", 2, F.size("words")).alias("next"))
    each = listed.select("target", F.explode(pairs).alias("pair")).select("target", "pair.words", "pair.next")
    both = F.array(bucket(F.col("words"), buckets=buckets), bucket(F.col("words"), F.col("next"), buckets=buckets))
    each = each.select("target", F.explode(both).alias("bucket"))
    counts = each.groupBy("bucket").agg(F.count("*").alias("raw"), F.count_if("target").alias("target"))
    found = {r.bucket: (r.raw, r.target) for r in counts.collect()}  # at most a row per bucket
    raw, target = (sum(v[k] for v in found.values()) for k in (0, 1))
    if not target:
        return F.expr(f"array_repeat(cast(0 as bigint), {buckets})")
    session = docs.sparkSession
    rows = [(b, *found.get(b, (0, 0))) for b in range(buckets)]
    frame = session.createDataFrame(rows, "bucket int, raw bigint, target bigint").withColumn(
        "weight",
        F.round(
            1_000_000
            * (F.log((F.col("target") + 1) / F.lit(float(target + buckets))) - F.log((F.col("raw") + 1) / F.lit(float(raw + buckets))))
        ).cast("bigint"),
    )
    weights = [r.weight for r in frame.orderBy("bucket").collect()]
    return F.split(F.lit(",".join(map(str, weights))), ",").cast("array<bigint>")


def likelihood_ratio(listed: Column, weights: Column, buckets: int = BUCKETS) -> Column:
    """The mean weight of a text's n-grams in micro-nats, rounded down; 0 for a text without words."""

    def total(w: Column) -> Column:
        weight = lambda *parts: F.get(weights, bucket(*parts, buckets=buckets))
        return F.aggregate(
            F.sequence(F.lit(0), F.size(w) - 1),
            F.lit(0).cast("bigint"),
            lambda a, i: a + weight(F.get(w, i)) + weight(F.get(w, i), F.get(w, i + 1)),
        )

    ratio = lambda w: F.floor(total(w) / (2 * F.size(w))).cast("bigint")
    return F.when(F.size(listed) == 0, F.lit(0).cast("bigint")).otherwise(let(listed, ratio))


def judge(docs: DataFrame, labels: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Base counts, ratio and verdict of every document, beside all columns of ``docs``.

    ``labels`` (doc_id, quality) names the trusted documents: quality 1. A document is kept
    unless it breaks a base rule or its ratio is below the threshold. A null or empty text has
    no words and fails. Rows are judged one by one, so repeated rows get equal verdicts and an
    empty table gives an empty one. Added columns replace those of the same name, all others
    stay as they are, whatever they are called.
    """
    weights = fit(docs, labels.where(F.col("quality") == 1))
    judged = (
        base_counts(_packed(docs))
        .withColumn("llr", likelihood_ratio(F.col("words"), weights))
        .drop("words")
        .withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words")))
        .withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))
    )
    added = [c for c in judged.columns if c not in ("text", "__rest")]
    return judged.select(*_unpacked(docs, [c for c in docs.columns if c not in added]), *added)


def _packed(docs: DataFrame) -> DataFrame:
    """The text, and all other columns in one, where their names meet none of ours."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.select("text", F.struct(*rest, F.lit(None).cast("int").alias("__none")).alias("__rest"))


def _unpacked(docs: DataFrame, names: list[str]) -> list[Column]:
    return [F.col("text") if c == "text" else F.col("__rest").getField(c).alias(c) for c in names]


def keep(docs: DataFrame, labels: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The documents that pass, with their columns as they were, whatever these are called."""
    weights = fit(docs, labels.where(F.col("quality") == 1))
    listed = with_repeated_words(_packed(docs).withColumn("words", words(F.col("text"))))
    good = ~base_failed(F.size("words"), F.col("n_repeat_words")) & (likelihood_ratio(F.col("words"), weights) >= threshold)
    # always true, but not for Spark to know: else it moves the filter below the steps and repeats them
    steps_first = F.monotonically_increasing_id() >= 0
    return listed.withColumn("__kept", good & steps_first).where("__kept").select(*_unpacked(docs, docs.columns))
