"""URL filters: list rules, and trust and distrust propagated over the links between hosts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vouch.llm.frames import ascii_lower
from vouch.sources.staging import settle

DAMPING = 0.85
ITERATIONS = 10
#: Iterations between checkpoints, so that plans stay short.
CUT = 5
#: A host is blocked if its distrust is over this many times its trust.
THRESHOLD = 1.0
#: Significant digits to which a host's two scores are compared, so that sums in another order tie.
DIGITS = 9

AFTER_SCHEME = r"^(?s:.*?)://([^/?#]*)([^?#]*)"
LINK = r"""(?i)href\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


@dataclass(frozen=True)
class UrlRule:
    """``host`` with all its subdomains, for paths that start with ``path``."""

    allow: bool
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both are empty for null and for text without ``://``."""
    known = F.coalesce(url, F.lit(""))
    return ascii_lower(F.regexp_extract(known, AFTER_SCHEME, 1)), F.regexp_extract(known, AFTER_SCHEME, 2)


def matching_rule(host: Column, path: Column, rules: list[UrlRule]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none fits.

    Of rules equally long the one with the longer host wins, then the first by text.
    """
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), len(r.host), [-ord(c) for c in r.text])):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        text = F.when(fits, rule.text).otherwise(text)
        verdict = F.when(fits, "allow" if rule.allow else "block").otherwise(verdict)
    return text, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, weight): links of a host's pages to other hosts, and links between a host and its parent domain.

    ``pages``: host, html. A host's name ties it to its parent domain, both ways with weight
    one, so subdomains without links share their domain's standing. Links are counted before
    the shuffle.
    """
    hosts = pages.where("host <> ''")
    targets = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1))
    links = hosts.select(F.col("host").alias("src"), F.explode(targets).alias("target"))
    links = links.select("src", ascii_lower(F.col("target")).alias("dst"))
    links = links.where("src <> dst").groupBy("src", "dst").agg(F.count("*").alias("weight"))
    names = hosts.select("host").unionAll(links.select(F.col("dst").alias("host"))).distinct()
    labels = names.select(F.split("host", r"\.", -1).alias("labels"))
    parts = labels.select("labels", F.explode(F.sequence(F.lit(1), F.size("labels"))).alias("i")).where("i < size(labels) - 1")
    rest = lambda i: F.array_join(F.slice("labels", i, F.size("labels")), ".")
    child = parts.select(rest(F.col("i")).alias("src"), rest(F.col("i") + 1).alias("dst")).distinct()
    parent = child.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    one = F.lit(1).cast("bigint").alias("weight")
    tied = child.unionAll(parent).select("src", "dst", one)
    return links.unionAll(tied).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def propagate(edges: DataFrame, seeds: DataFrame, iterations: int = ITERATIONS, damping: float = DAMPING) -> DataFrame:
    """(host, trust, distrust): personalised PageRank from ``seeds`` (side, host, seed).

    Trust follows the links, distrust goes against them: who links to blocked hosts is
    distrusted. Both sides run in the same joins. Scores without a link to follow fade.
    """
    sides = edges.select(F.lit("trust").alias("side"), "src", "dst", "weight").unionAll(
        edges.select(F.lit("distrust").alias("side"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    )
    out = sides.groupBy("side", "src").agg(F.sum("weight").alias("out"))
    shares = sides.join(out, ["side", "src"]).select("side", F.col("src").alias("host"), "dst", (F.col("weight") / F.col("out")).alias("share"))
    shares = settle(shares)
    start = settle(seeds)
    base = start.select("side", "host", (F.col("seed") * (1 - damping)).alias("score"))
    scores = start.select("side", "host", F.col("seed").alias("score"))
    for k in range(1, iterations + 1):
        passed = scores.join(shares, ["side", "host"]).groupBy("side", "dst").agg(F.sum(F.col("score") * F.col("share")).alias("score"))
        passed = passed.select("side", F.col("dst").alias("host"), (F.col("score") * damping).alias("score"))
        scores = passed.unionAll(base).groupBy("side", "host").agg(F.sum("score").alias("score"))
        if k % CUT == 0 and k < iterations:
            scores = settle(scores)
    side = lambda s: F.sum(F.when(F.col("side") == s, F.col("score")).otherwise(0.0))
    return scores.groupBy("host").agg(side("trust").alias("trust"), side("distrust").alias("distrust"))


def judge_pages(pages: DataFrame, rules: list[UrlRule], threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule, verdict, trust and distrust of every page, a row per row.

    A page that a rule fits gets its verdict. Each host with such pages is a seed, with the
    share of them that fall to it; a seed of both kinds counts for both. Any other page is
    blocked if its host's distrust is over ``threshold`` times its trust. Scores shrink as seeds
    grow in number, so they are compared with each other and not rounded. Pages without a host
    (null url, no ``://``) and hosts that no seed reaches are allowed. Null html has no links.
    """
    host, path = host_and_path(F.col("url"))
    named = pages.select("page_id", host.alias("host"), path.alias("path"), "html")
    rule, ruled = matching_rule(F.col("host"), F.col("path"), rules)
    marked = named.select("page_id", "host", "path", rule.alias("rule"), ruled.alias("ruled"))
    edges = host_edges(named)
    per_host = marked.where("host <> ''").groupBy("host").agg(F.count_if(F.col("ruled") == "allow").alias("trust"), F.count_if(F.col("ruled") == "block").alias("distrust"))
    kinds = per_host.select("host", F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("n")) for s in ("trust", "distrust")])).alias("x"))
    kinds = settle(kinds.select("x.side", "host", "x.n").where("n > 0"))
    totals = kinds.groupBy("side").agg(F.sum("n").alias("total"))
    seeds = kinds.join(totals, "side").select("side", "host", (F.col("n") / F.col("total")).alias("seed"))
    scores = settle(propagate(edges, seeds))
    score = lambda c: F.coalesce(c, F.lit(0.0)).alias(c)
    least = threshold * (1 + 10.0**-DIGITS) * F.coalesce("trust", F.lit(0.0))
    by_method = F.when(F.coalesce("distrust", F.lit(0.0)) > least, "block").otherwise("allow")
    verdict = F.coalesce("ruled", by_method).alias("verdict")
    return marked.join(scores, "host", "left").select("page_id", "host", "path", "rule", verdict, score("trust"), score("distrust"))
