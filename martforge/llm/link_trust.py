"""URL filters: rules by host and path, and for the rest trust and distrust that spread over links between hosts.

A url's host stands after its first ``://`` up to ``/``, ``?``, ``#`` or the
end, A-Z lower-cased; its path follows up to ``?``, ``#`` or the end. A rule
(host, path, verdict) fits urls of its host and of all subdomains whose path
starts with the rule's; of several the longest decides.

Urls that no rule fits take their host's verdict, found in the graph of hosts.
An edge leads from a page's host to every other host that its links (``<a
href>``, absolute or without a scheme) name; pairs of hosts count once. Hosts
of which rules allow more than half of the pages are trusted seeds, those of
which they block more than half are blocked seeds. Trust is the personalised
PageRank of the trusted seeds; distrust is that of the blocked seeds over the
reversed edges, so it goes to hosts that link to them. Both take ``ROUNDS``
rounds; what is still moving then is below ``DAMPING ** ROUNDS``, 4 %. A host
is blocked if its distrust, in shares of what one seed gives out, is at least
``MIN_DISTRUST`` and above its trust; all others are allowed.

Ranks are integers (each direction gives out ``MASS`` units, halves are
rounded down), so reruns and any order of summation agree to the unit.

Defined results: a url that is null or has no ``://`` has the empty host and
path and is allowed unless a rule fits; a null html has no links; rows are
judged one by one, also with equal ids; an empty table gives an empty result;
extra columns have no part in it.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import written

ALLOW, BLOCK = "allow", "block"
RULES = (("com", "/", ALLOW), ("example.com", "/en/", BLOCK), ("www.example.com", "/en/", ALLOW),
         ("net", "/es/", BLOCK), ("net", "/fr/", BLOCK))
MAX_RULES = 1000  # rules are part of the plan
DAMPING = 85  # percent
ROUNDS = 20
MIN_DISTRUST = 1  # percent of what one seed gives out
MASS = 10 ** 15
_WRITTEN_ROUNDS = 5  # rounds between two written tables
_HREF = r"""(?i)<a[\x20\x09-\x0D][^>]*?href[\x20\x09-\x0D]*=[\x20\x09-\x0D]*["']?[\x20\x09-\x0D]*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'<>\x20\x09-\x0D]*)"""


def _lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    return F.coalesce(_lower(F.regexp_extract(url, "://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def decide(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """The longest rule that fits (its text, its verdict), or null."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules: at most {MAX_RULES}")
    # equal in length: the longer host, then block
    order = sorted(rules, key=lambda r: (-len(r[0] + r[1]), -len(r[0]), r[2] != BLOCK))
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    for name, start, verdict in reversed(order):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        out = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def linked_hosts(html: Column) -> Column:
    """The hosts that a page's links name, once each."""
    return F.array_distinct(F.transform(F.regexp_extract_all(html, F.lit(_HREF), F.lit(1)), _lower))


def host_edges(pages: DataFrame, host_col: str = "host", html_col: str = "html") -> DataFrame:
    """src, dst: a host and another one that its pages link to, each pair once."""
    links = pages.select(F.col(host_col).alias("src"), F.explode(linked_hosts(F.col(html_col))).alias("dst"))
    return links.filter("src <> dst and src <> '' and dst <> ''").distinct()


def spread(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """direction, host, mass: personalised PageRank of each direction's seeds.

    ``edges`` has (direction, src, dst), ``seeds`` (direction, host, mass).
    A host's mass is dealt evenly to the hosts it points to; what reaches a
    host without edges leaves the graph there.
    """
    degree = edges.groupBy("direction", "src").agg(F.count(F.lit(1)).alias("degree"))
    edges = written(edges.join(degree, ["direction", "src"]), "host_edges")
    kept = seeds.withColumn("mass", F.expr(f"mass * {100 - DAMPING} div 100"))
    now = seeds
    for done in range(1, rounds + 1):
        moved = edges.join(now.withColumnRenamed("host", "src"), ["direction", "src"]).select(
            "direction", F.col("dst").alias("host"), F.expr(f"mass * {DAMPING} div (100 * degree)").alias("mass"))
        now = moved.unionByName(kept).groupBy("direction", "host").agg(F.sum("mass").alias("mass")).filter("mass > 0")
        if done % _WRITTEN_ROUNDS == 0 or done == rounds:
            now = written(now, "ranks")
    return now


def host_verdicts(judged: DataFrame, edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """host, trust, distrust (units of MASS), trusted_seeds, blocked_seeds, host_verdict of every host with a mass.

    ``judged`` has (host, verdict) of every page, the verdict null without a rule.
    """
    pages = judged.filter("host <> ''").groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("verdict") == ALLOW, 1)).alias("allowed"),
        F.count(F.when(F.col("verdict") == BLOCK, 1)).alias("blocked"))
    direction = F.when(2 * F.col("allowed") > F.col("n"), ALLOW).when(2 * F.col("blocked") > F.col("n"), BLOCK)
    seeds = written(pages.select(direction.alias("direction"), "host").filter("direction is not null"), "seeds")
    many = {r["direction"]: r["n"] for r in seeds.groupBy("direction").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    trusted, blocked = many.get(ALLOW, 0), many.get(BLOCK, 0)
    mass = F.when(F.col("direction") == ALLOW, MASS // max(trusted, 1)).otherwise(MASS // max(blocked, 1)).cast("long")
    both = edges.select(F.lit(ALLOW).alias("direction"), "src", "dst").union(
        edges.select(F.lit(BLOCK), F.col("dst"), F.col("src")))
    ranks = spread(both, seeds.withColumn("mass", mass), rounds)
    of_host = ranks.groupBy("host").agg(
        F.coalesce(F.sum(F.when(F.col("direction") == ALLOW, F.col("mass"))), F.lit(0)).alias("trust"),
        F.coalesce(F.sum(F.when(F.col("direction") == BLOCK, F.col("mass"))), F.lit(0)).alias("distrust"))
    # in shares of one seed's mass; decimals, as the products pass 64 bits
    trust, distrust = F.col("trust").cast("decimal(38,0)") * trusted, F.col("distrust").cast("decimal(38,0)") * blocked
    bad = (distrust * 100 >= F.lit(MASS * MIN_DISTRUST)) & (distrust > trust)
    return of_host.select("host", "trust", "distrust", F.lit(trusted).alias("trusted_seeds"), F.lit(blocked).alias("blocked_seeds"),
                          F.when(bad, BLOCK).otherwise(ALLOW).alias("host_verdict"))


def judge_pages(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, id_col: str = "page_id",
                url_col: str = "url", html_col: str = "html", rounds: int = ROUNDS) -> DataFrame:
    """page_id, host, path, rule and verdict of every page."""
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"),
                        F.col(html_col).alias("html")).withColumn("found", decide(F.col("host"), F.col("path"), rules))
    judged = written(rows.select("page_id", "host", "path", "found.rule", "found.verdict"), "judged")
    edges = written(host_edges(rows), "links")
    hosts = host_verdicts(judged, edges, rounds).select(F.col("host").alias("of"), "host_verdict")
    return judged.join(hosts, judged["host"] == hosts["of"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", "host_verdict", F.lit(ALLOW)).alias("verdict"))
