"""URL rules, and trust and distrust spread over the links between hosts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdin.llm.frames import lower_ascii, pinned

#: (host and path prefix, verdict)
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
DAMPING = 0.85
ROUNDS = 30
TOLERANCE = 1e-6
BLOCK_ABOVE = 0.5


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without one."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without a host part."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule that fits, or null; of equally long ones the first in text order.

    A rule fits its host and all hosts below it if the path starts with the
    rule's. The list is configuration and becomes part of the expression.
    """
    found = F.lit(None).cast("string")
    for text, _ in sorted(rules, key=lambda rule: (-len(rule[0]), rule[0]))[::-1]:
        name, slash, start = text.partition("/")
        fits = (host == name) | host.endswith("." + name)
        found = F.when(fits & path.startswith(slash + start), F.lit(text)).otherwise(found)
    return found


def verdict_of(rule: Column, rules: Sequence[tuple[str, str]]) -> Column:
    verdict = F.lit(None).cast("string")
    for text, said in rules:
        verdict = F.when(rule == text, F.lit(said)).otherwise(verdict)
    return verdict


def host_links(pages: DataFrame) -> DataFrame:
    """Weighted edges between hosts: ``source``, ``target``, ``share`` of the source's outgoing links.

    Links are the absolute addresses (``http://``, ``https://`` or ``//``) in
    ``href`` attributes of ``html``. Addresses without a host lie on the page's
    own host and carry nothing to others.
    """
    links = F.regexp_extract_all("html", F.lit(r"""(?i)href\s*=\s*["']?(?:https?:)?(//[^"'\s>]+)"""), F.lit(1))
    edges = (
        pages.select(F.col("host").alias("source"), F.explode(F.transform(links, lambda x: host_of(F.concat(F.lit("http:"), x)))).alias("target"))
        .where("source <> '' and target <> '' and source <> target")
        .groupBy("source", "target")
        .agg(F.count("*").alias("n"))
    )
    totals = edges.groupBy("source").agg(F.sum("n").alias("all"))
    return edges.join(totals, "source").select("source", "target", (F.col("n") / F.col("all")).alias("share"))


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """Personalised PageRank: ``host``, ``score`` from ``seeds`` (``host``, ``mass``) along ``edges``.

    A round gives each host ``1 - damping`` times its seed mass and ``damping``
    times what its links bring. Mass of hosts without outgoing links ends there.
    Rounds are written to the shared folder, each holding one row per reached
    host, until no more than ``tolerance`` of the seed mass moves in a round.
    """
    start = pinned(seeds.select("host", ((1 - damping) * F.col("mass")).alias("score")))
    total = start.agg(F.sum("score")).first()[0] or 0.0
    score = moving = start
    for _ in range(rounds):
        # what moved last round moves on; every round adds one step of the walk
        moving = pinned(
            moving.join(edges, moving.host == edges.source)
            .groupBy(F.col("target").alias("host"))
            .agg(F.sum(damping * F.col("score") * F.col("share")).alias("score"))
        )
        moved = moving.agg(F.sum("score")).first()[0] or 0.0
        if moved == 0.0:
            break
        score = pinned(score.unionByName(moving).groupBy("host").agg(F.sum("score").alias("score")))
        if moved <= tolerance * total:
            break
    return score


def judged(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, block_above: float = BLOCK_ABOVE) -> DataFrame:
    """One row per page: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``trust``, ``distrust``.

    Pages that rules allow make their hosts trusted seeds, pages that rules
    block make them distrusted ones, by number of pages. Trust flows along links
    and distrust against them. A page without a rule is blocked if distrust is
    more than ``block_above`` of both together at its host, else allowed; a host
    that neither reaches is allowed. Null addresses, and those without ``://``,
    have an empty host and path, no rule, and are allowed. A null ``html`` has
    no links. Repeated pages count as often as they come; extra columns are
    ignored.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    pages = pages.select(F.col("page_id").cast("long"), host.alias("host"), path.alias("path"), "html")
    pages = pages.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules))
    said = verdict_of(F.col("rule"), rules)
    pages = pages.withColumn("said", said)
    edges = pinned(host_links(pages))
    hosts = pages.where("host <> ''").groupBy("host").agg(F.count_if(F.col("said") == "allow").alias("a"), F.count_if(F.col("said") == "block").alias("b"))
    hosts = pinned(hosts)
    trust = propagate(hosts.where("a > 0").select("host", F.col("a").cast("double").alias("mass")), edges)
    backward = edges.select(F.col("source").alias("t"), F.col("target").alias("s"), "share")
    inward = backward.groupBy(F.col("s").alias("source")).agg(F.sum("share").alias("all"))
    backward = backward.join(inward, backward.s == inward.source).select("source", F.col("t").alias("target"), (F.col("share") / F.col("all")).alias("share"))
    distrust = propagate(hosts.where("b > 0").select("host", F.col("b").cast("double").alias("mass")), pinned(backward))
    scores = hosts.select("host").join(trust.withColumnRenamed("score", "trust"), "host", "left")
    scores = scores.join(distrust.withColumnRenamed("score", "distrust"), "host", "left").na.fill(0.0, ["trust", "distrust"])
    judged = pages.drop("html").join(scores, "host", "left").na.fill(0.0, ["trust", "distrust"])
    bad = (F.col("distrust") > 0) & (F.col("distrust") > block_above * (F.col("trust") + F.col("distrust")))
    verdict = F.coalesce("said", F.when(bad, "block").otherwise("allow"))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.round("trust", 9).alias("trust"), F.round("distrust", 9).alias("distrust"))
