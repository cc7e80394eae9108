"""URL verdicts: rules first, trust and distrust spread over the links between hosts for the rest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shelfmark.session import stored

#: Part of a host's score that follows links, and the share of distrust over which a host is blocked.
DAMPING, LIMIT = 0.85, 0.5
#: Rankings end when what is still moving is less than this part of all scores; shares this close to the limit
#: count as the limit.
TOLERANCE, CLOSE = 1e-6, 1e-9
_LINK = r"""(?i)href\s*=\s*["']?(?:https?:)?//([^/?#"'>\s]+)"""


@dataclass(frozen=True)
class Rule:
    """``host/path``: fits the host and its subdomains where the url's path starts with ``/path``."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


#: Fixed rules.
RULES = (
    Rule("net/", "block"),
    Rule("example.net/en/", "allow"),
    Rule("example.com/de/", "block"),
    Rule("org/fr/", "allow"),
)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands after the first ``://`` up to ``/``, ``?`` or ``#``, and then up to ``?`` or ``#``.

    A-Z of the host in lower case. Both are empty without ``://`` or for a null url.
    """
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return lower_ascii(host), path


def _fitting(rules: tuple[Rule, ...]) -> Column:
    """The longest rule that fits (the first of the rules as given, if some are equally long)."""
    found = F.lit(None).cast("string")
    for rule in reversed(sorted(rules, key=lambda r: -len(r.text))):
        host = (F.col("host") == rule.host) | F.endswith("host", F.lit("." + rule.host))
        found = F.when(host & F.startswith("path", F.lit(rule.path)), F.lit(rule.text)).otherwise(found)
    return found


def host_links(pages: DataFrame) -> DataFrame:
    """(source, target, n): links from one host to another, of (host, html) rows."""
    links = pages.where("host <> '' and html is not null").select(
        F.col("host").alias("source"), F.explode(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1))).alias("to")
    )
    links = links.select("source", lower_ascii(F.col("to")).alias("target")).where("target <> '' and source <> target")
    return links.groupBy("source", "target").agg(F.count("*").alias("n"))


def _directed(links: DataFrame) -> DataFrame:
    """(kind, host, to, part): where scores go, trust (kind 0) along links and distrust (1) against them."""
    ways = links.select(F.lit(0).alias("kind"), F.col("source").alias("host"), F.col("target").alias("to"), "n").union(
        links.select(F.lit(1), F.col("target"), F.col("source"), "n")
    )
    out = ways.groupBy("kind", "host").agg(F.sum("n").alias("total"))
    return stored(ways.join(out, ["kind", "host"]).select("kind", "host", "to", (F.col("n") / F.col("total")).alias("part")), "host-links")


def spread(links: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE, limit: float | None = None) -> DataFrame:
    """(host, trust, distrust): personalised PageRank from the seeds, trust along links, distrust against.

    ``seeds`` is (kind, host, share): kind 0 trusted, 1 blocked; shares of a kind add up to 1. A host passes
    on ``damping`` of its score in proportion to its links; what a host without links has goes back to
    the seeds, as does the rest, and that only scales all scores of a kind alike. So scores are summed
    residuals: each round, hosts that were reached in the one before push theirs along their links, and
    hosts without news stay out of the shuffle. Each kind's scores are divided by their sum at the end.

    Rounds go on until nothing moves; or until no new host is reached, and what can still come moves
    no host across ``limit`` (if given), or is less than ``tolerance`` of all scores of both kinds. State, a row a
    host, is written to the shared folder each round, and each round is one job: the sums that decide
    on the next are observed on that write. Links are stored once; a hub's are split by the adaptive
    skew join, as every host has one row on the other side.
    """
    names = ["trust", "distrust"]

    def of(kind: int, score: str) -> Column:
        return F.sum(F.when(F.col("kind") == kind, F.col(score)).otherwise(0.0))

    start = seeds.groupBy("host").agg(*(of(k, "share").alias(c) for k, c in enumerate(names)))
    start = start.select("host", *names, F.col("trust").alias("new_trust"), F.col("distrust").alias("new_distrust"))
    ways = _directed(links)
    linked = not ways.isEmpty()
    total, moving = [1.0, 1.0], [1.0, 1.0]  # of all scores so far, of the last residuals
    state = start
    while linked and max(moving) > 0:
        ahead = F.expr("stack(2, 0, new_trust, 1, new_distrust) AS (kind, score)")
        pushed = state.where("new_trust > 0 or new_distrust > 0").select("host", ahead).where("score > 0")
        pushed = pushed.join(ways, ["kind", "host"]).select("kind", F.col("to").alias("host"), (damping * F.col("score") * F.col("part")).alias("score"))
        none = F.lit(0.0)
        pushed = pushed.select("host", *(F.when(F.col("kind") == k, F.col("score")).otherwise(none).alias(c) for k, c in enumerate(names)))
        both = state.select("host", *names, none.alias("a"), none.alias("b")).union(pushed.select("host", none, none, *names))
        new = both.groupBy("host").agg(
            *((F.sum(c) + F.sum(x)).alias(c) for c, x in zip(names, "ab", strict=True)),
            F.sum("a").alias("new_trust"), F.sum("b").alias("new_distrust"), *((F.sum(c) == 0).alias(f"un{c}") for c in names),
        )
        reached = [F.coalesce(F.sum((F.col(f"un{c}") & (F.col(c) > 0)).cast("long")), F.lit(0)) for c in names]
        # all that can still come, from the sums before this round
        rest = [m * damping * damping / (1 - damping) for m in moving]
        most = [t + m * damping / (1 - damping) or 1.0 for t, m in zip(total, moving, strict=True)]
        low = [F.col(c) / m for c, m in zip(names, most, strict=True)]
        high = [(F.col(c) + r) / F.lit(t + r if t + r else 1.0) for c, r, t in zip(names, rest, total, strict=True)]
        open_ = F.lit(True) if limit is None else (high[1] * (1 - limit) > limit * low[0]) & (low[1] * (1 - limit) <= limit * high[0])
        seen = Observation()
        told = [F.coalesce(F.sum(c), none).alias(c) for c in (*names, "new_trust", "new_distrust")]
        new = new.observe(seen, *told, (reached[0] + reached[1]).alias("reached"), F.coalesce(F.sum(open_.cast("long")), F.lit(0)).alias("open"))
        state = stored(new.drop(*(f"un{c}" for c in names)), "host-scores")
        got = seen.get
        total, moving = [got[c] for c in names], [got["new_trust"], got["new_distrust"]]
        small = all(m * damping / (1 - damping) <= tolerance * t for m, t in zip(moving, total, strict=True))
        if not got["reached"] and (small or not got["open"]):
            break
    return state.select("host", *((F.col(c) / F.lit(t or 1.0)).alias(c) for c, t in zip(names, total, strict=True)))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, limit: float = LIMIT, id_col: str = "page_id") -> DataFrame:
    """(id, host, path, rule, verdict, distrust): every page judged by its rule or else its host.

    Pages that a rule allows or blocks make their hosts seeds, in proportion to those pages; a host may
    be both. ``distrust`` is the host's share of distrust in its trust and distrust, null if no
    score reaches it; rankings go on until it is on its final side of ``limit`` (`spread`). Without a rule a page is blocked if that share is over ``limit``, else
    allowed. Null urls, and null pages' html, are no trouble; rows may repeat and ids may be null.
    Only DataFrame functions are used.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select(pages[id_col].alias("i"), pages["url"].alias("url"), pages["html"].alias("html"))
    rows = rows.select("i", host.alias("host"), path.alias("path"), "html").withColumn("rule", _fitting(rules))
    verdict = F.lit(None).cast("string")
    for rule in rules:
        verdict = F.when(F.col("rule") == rule.text, F.lit(rule.verdict)).otherwise(verdict)
    rows = rows.withColumn("ruled", verdict)
    marked = rows.where("ruled is not null and host <> ''").groupBy(F.when(F.col("ruled") == "block", 1).otherwise(0).alias("kind"), "host").agg(F.count("*").alias("n"))
    totals = marked.groupBy("kind").agg(F.sum("n").alias("total"))  # a row a kind
    seeds = stored(marked.join(totals, "kind").select("kind", "host", (F.col("n") / F.col("total")).alias("share")), "host-seeds")
    scores = spread(host_links(rows.select("host", "html")), seeds, limit=limit)
    hosts = scores.select("host", F.try_divide("distrust", F.col("trust") + F.col("distrust")).alias("distrust"))
    by_host = F.when(F.col("distrust") > limit + CLOSE, "block").otherwise("allow")
    return rows.drop("html").join(hosts, "host", "left").select(
        F.col("i").alias(id_col), "host", "path", "rule", F.coalesce("ruled", by_host).alias("verdict"), "distrust"
    )
