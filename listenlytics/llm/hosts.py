"""URL filter: fixed rules first, then the reputation of the host.

A host's share of good pages is shrunk towards its registered domain's, that towards its
suffix's, that towards the share of all labelled pages. How far, each level's own spread
tells: the beta-binomial prior of a level has the within-group correlation estimated by
moments over its groups. A host is blocked when even the upper bound of its posterior share
lies below the threshold.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import new_work_folder
from ..staging import written

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# The rules of the query, as (rule, verdict).
RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)
MIN_CORRELATION, MAX_CORRELATION, NO_SPREAD = 0.001, 0.999, 0.1


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    place = F.coalesce(F.locate("://", url), F.lit(0))
    return F.when(place > 0, F.substring(url, place + 3, F.length(url))).otherwise("")


def domain_of(host: Column) -> Column:
    """The last two labels of a host without its port."""
    return F.substring_index(F.regexp_replace(host, ":[0-9]*$", ""), ".", -2)


def suffix_of(host: Column) -> Column:
    return F.substring_index(F.regexp_replace(host, ":[0-9]*$", ""), ".", -1)


def match_rules(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null where none fits.

    A rule is a host and a path; it fits the host and its subdomains on paths that start
    with its own.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):  # the longest ends outermost
        own, _, rest = text.partition("/")
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(f"/{rest}")
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


@dataclass(frozen=True)
class Level:
    name: str
    parent: str | None


LEVELS = (Level("suffix", None), Level("domain", "suffix"), Level("host", "domain"))


def _strength(groups: DataFrame) -> float:
    """The prior's weight in pages, from groups with ``n``, ``good`` and the prior mean ``prior``.

    With v = prior * (1 - prior), the sum of n * (share - prior)^2 is expected to be the sum
    of v * (1 + (n - 1) * correlation). One row comes to the driver.
    """
    v = F.col("prior") * (1 - F.col("prior"))
    found = groups.where("n > 0").agg(
        F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - F.col("prior"), F.lit(2))).alias("seen"),
        F.sum(v).alias("least"),
        F.sum(v * (F.col("n") - 1)).alias("more"),
    ).first()
    if not found["more"]:
        correlation = NO_SPREAD
    else:
        correlation = (found["seen"] - found["least"]) / found["more"]
    correlation = min(max(correlation, MIN_CORRELATION), MAX_CORRELATION)
    return (1 - correlation) / correlation


def host_reputation(
    pages: DataFrame,
    outcomes: DataFrame,
    page_col: str = "page_id",
    url_col: str = "url",
    outcome_page_col: str = "page_id",
    good_col: str = "good",
    z: float = 1.645,
) -> DataFrame:
    """(host, n, good, mean, lower, upper) of every host: the posterior share of good pages.

    ``outcomes`` has page ids and booleans; pages without an outcome only make their host
    known. Null outcomes and ids are left out; an id with several outcomes counts each; a
    page that stands several times counts each time. Without outcomes every share is 1/2.
    """
    spark = pages.sparkSession
    seen = pages.select(F.col(page_col).alias("_page"), host_of(F.col(url_col)).alias("host"))
    known = outcomes.select(
        F.col(outcome_page_col).alias("_page"), F.col(good_col).cast("int").alias("_good")
    ).where(F.col("_page").isNotNull() & F.col("_good").isNotNull())
    hosts = (
        seen.join(known, "_page", "left")
        .groupBy("host")
        .agg(F.count("_good").alias("n"), F.coalesce(F.sum("_good"), F.lit(0)).alias("good"))
        .select("host", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"), "n", "good")
    )
    hosts = written(hosts, new_work_folder(spark, "hosts"))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    overall = ((total["good"] or 0) + 1) / ((total["n"] or 0) + 2)
    above = None
    for level in LEVELS:
        keys = [level.name] + ([level.parent] if level.parent else [])
        groups = hosts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
        if above is None:
            groups = groups.withColumn("prior", F.lit(overall))
        else:
            groups = groups.join(above, level.parent)
        weight = _strength(groups)
        posterior = (weight * F.col("prior") + F.col("good")) / (weight + F.col("n"))
        above = groups.select(level.name, posterior.alias("prior"))
    spread = z * F.sqrt(posterior * (1 - posterior) / (weight + F.col("n") + 1))
    return groups.select(
        "host", "n", "good", posterior.alias("mean"),
        (posterior - spread).alias("lower"), (posterior + spread).alias("upper"),
    )


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    page_col: str = "page_id",
    url_col: str = "url",
    outcome_page_col: str = "page_id",
    good_col: str = "good",
    threshold: float = 0.5,
) -> DataFrame:
    """(``page_col``, host, path, rule, verdict) of every page.

    Null urls and urls without ``://`` have empty host and path and share one reputation. One
    row for each input row, repeated rows and null ids included.
    """
    hosts = host_reputation(pages, outcomes, page_col, url_col, outcome_page_col, good_col)
    blocked = hosts.select("host", (F.col("upper") < threshold).alias("_blocked"))
    url = F.col(url_col).cast("string")
    judged = pages.select(F.col(page_col).alias("_page"), host_of(url).alias("host"), path_of(url).alias("path"))
    rule, verdict = match_rules(F.col("host"), F.col("path"), rules)
    by_host = F.when(F.col("_blocked"), "block").otherwise("allow")
    return judged.join(blocked, "host", "left").select(
        F.col("_page").alias(page_col), "host", "path", rule.alias("rule"),
        F.coalesce(verdict, by_host).alias("verdict"),
    )


_HOST_SQL = f"""
  SELECT page_id, url,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages"""

JUDGE_SQL = f"""
WITH cut AS ({_HOST_SQL}),
named AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{UPPER.lower()}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
outcomes AS (SELECT doc_id AS page_id, (quality = 1 AND toxic = 0)::INT AS good FROM labels),
hosts AS (
  SELECT host, regexp_extract(host, '([^.]*[.])?[^.]*$') AS domain, regexp_extract(host, '[^.]*$') AS suffix,
    count(good) AS n, coalesce(sum(good), 0) AS good
  FROM named LEFT JOIN outcomes USING (page_id) GROUP BY ALL),
overall AS (SELECT (sum(good) + 1) / (sum(n) + 2) AS prior FROM hosts),
s0 AS (SELECT suffix, sum(n) AS n, sum(good) AS good, any_value(prior) AS prior FROM hosts, overall GROUP BY suffix),
s1 AS (SELECT greatest(0.001, least(0.999, (sum(n * pow(good / n - prior, 2)) - sum(prior * (1 - prior)))
    / sum(prior * (1 - prior) * (n - 1)))) AS c FROM s0 WHERE n > 0),
s2 AS (SELECT suffix, ((1 - c) / c * prior + good) / ((1 - c) / c + n) AS prior FROM s0, s1),
d0 AS (SELECT domain, suffix, sum(n) AS n, sum(good) AS good, any_value(prior) AS prior
  FROM hosts JOIN s2 USING (suffix) GROUP BY domain, suffix),
d1 AS (SELECT greatest(0.001, least(0.999, (sum(n * pow(good / n - prior, 2)) - sum(prior * (1 - prior)))
    / sum(prior * (1 - prior) * (n - 1)))) AS c FROM d0 WHERE n > 0),
d2 AS (SELECT domain, ((1 - c) / c * prior + good) / ((1 - c) / c + n) AS prior FROM d0, d1),
h0 AS (SELECT host, n, good, prior FROM hosts JOIN d2 USING (domain)),
h1 AS (SELECT greatest(0.001, least(0.999, (sum(n * pow(good / n - prior, 2)) - sum(prior * (1 - prior)))
    / sum(prior * (1 - prior) * (n - 1)))) AS c FROM h0 WHERE n > 0),
h2 AS (SELECT host, (1 - c) / c + n AS pages, ((1 - c) / c * prior + good) / ((1 - c) / c + n) AS mean FROM h0, h1),
judged AS (
  SELECT page_id, host, path, mean + 1.645 * sqrt(mean * (1 - mean) / (pages + 1)) < 0.5 AS blocked,
    CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM named JOIN h2 USING (host))
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
    WHEN rule IS NULL AND blocked THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""
