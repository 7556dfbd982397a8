"""URL filter: fixed rules first, then empirical-Bayes reputation of the host.

Every host's share of bad pages is estimated from labelled page outcomes by a chain of beta-binomial
shrinkages: the suffix towards all pages, the registered domain towards its suffix, the host towards
its domain. The strength of each prior, in pages, is estimated from the data by moments: as much as
the groups of that level differ more than chance explains. A page is blocked if the lower posterior
bound of its host's bad share, mean - ``Z`` standard deviations, lies above ``LIMIT``. So a host
needs evidence of its own, or a domain or suffix with much of it, to be blocked.

Counts are partial sums per host, so a hot host is one row per task; pages meet the hosts in a join
whose hot side can be split. Nothing is collected.

Edge cases. Null url, or one without ``://``: host and path are empty; such pages are judged together
as the empty host. Outcomes that are null count for nothing; a host without outcomes has its domain's
estimate, which then has less weight than its prior's. No outcomes at all: a bad share of one half
with a flat bound, so nothing is blocked. Repeated rows get equal verdicts and each outcome counts.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (verdict, host/path): fits the host and its subdomains if the url's path starts with the path.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Suffixes of two labels, below which a registered domain has three.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp",
                      "ne.jp", "or.jp", "com.br", "com.cn", "com.mx", "com.tr", "co.in", "co.kr", "co.za")
LIMIT = 0.2
Z = 1.645
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with ``host`` and ``path``, and the host's ``domain`` and ``suffix``."""
    at = F.locate("://", F.col(url))
    rest = F.coalesce(F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))), F.lit(""))
    two = F.substring_index("host", ".", -2)
    deep = two.isin(*TWO_LABEL_SUFFIXES)
    return pages.withColumns({
        "host": F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER),
        "path": F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1),
    }).withColumns({
        "domain": F.when(deep, F.substring_index("host", ".", -3)).otherwise(two),
        "suffix": F.when(deep, two).otherwise(F.substring_index("host", ".", -1)),
    })


def rule_of(rules=RULES) -> Column:
    """The longest fitting rule as struct (verdict, rule); null if none fits. The list is a parameter
    that becomes part of the expression."""
    fits = []
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        host, slash, path = rule.partition("/")
        own = (F.col("host") == host) | F.endswith("host", F.lit("." + host))
        fits.append(F.when(own & F.startswith("path", F.lit(slash + path)),
                           F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))))
    return F.coalesce(*fits)


def _strength(groups: DataFrame, name: str) -> DataFrame:
    """One row: the prior's weight in pages, from groups with pages n, bad ones x and prior mean m.

    With p = x / n, the expected n (p - m)^2 of a beta-binomial is m (1 - m) (1 + (n - 1) r), where
    r = 1 / (weight + 1); r is solved from the sums and held within 1e-4 and 0.99.
    """
    seen = groups.where("n > 0")
    spread, chance = F.col("m") * (1 - F.col("m")), F.sum(F.col("m") * (1 - F.col("m")))
    found = F.sum(F.pow(F.col("x") - F.col("n") * F.col("m"), F.lit(2.0)) / F.col("n"))
    r = (found - chance) / F.nullif(F.sum(F.col("n") * spread) - chance, F.lit(0.0))
    held = F.greatest(F.lit(1e-4), F.least(F.lit(0.99), F.coalesce(r, F.lit(0.99))))
    return seen.agg((1 / held - 1).alias(name))


def host_reputation(outcomes: DataFrame) -> DataFrame:
    """(host, n, x, mean, bound) for every host, from rows (host, domain, suffix, bad boolean)."""
    bad, known = F.col("bad").cast("long"), F.col("bad").isNotNull().cast("long")
    hosts = outcomes.groupBy("host", "domain", "suffix").agg(
        F.sum(known).alias("n"), F.coalesce(F.sum(bad), F.lit(0)).alias("x"))
    sums = [F.sum("n").alias("n"), F.sum("x").alias("x")]
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums)
    overall = suffixes.agg(
        ((F.coalesce(F.sum("x"), F.lit(0)) + 0.5) / (F.coalesce(F.sum("n"), F.lit(0)) + 1.0)).alias("m"))

    def shrunk(groups: DataFrame, name: str) -> DataFrame:
        weight = _strength(groups, "w")
        mean = (F.col("w") * F.col("m") + F.col("x")) / (F.col("w") + F.col("n"))
        return groups.crossJoin(weight).withColumn(name, mean)  # one row

    by_suffix = shrunk(suffixes.crossJoin(overall), "up").select("suffix", F.col("up").alias("m"))
    by_domain = shrunk(domains.join(by_suffix, "suffix"), "up").select("domain", "suffix", F.col("up").alias("m"))
    by_host = shrunk(hosts.join(by_domain, ["domain", "suffix"]), "mean")
    total = F.col("w") + F.col("n")
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (total + 1))
    return by_host.select("host", "n", "x", "mean", (F.col("mean") - Z * deviation).alias("bound"))


def judge(pages: DataFrame, outcomes: DataFrame, rules=RULES) -> DataFrame:
    """``pages`` (with a ``url``) and their ``host``, ``path``, ``rule``, ``bound`` and ``verdict``;
    ``outcomes`` holds a ``url`` and a boolean ``bad``. Columns of these names are replaced."""
    rated = host_reputation(with_parts(outcomes.select("url", "bad"))).select(
        F.col("host").alias("__host"), "bound")
    parts = with_parts(pages.drop("rule", "bound", "verdict")).withColumn("__rule", rule_of(rules))
    joined = parts.join(rated, F.col("host") == F.col("__host"), "left")
    own = F.when(F.col("bound") > LIMIT, F.lit("block")).otherwise(F.lit("allow"))
    return joined.withColumns({
        "rule": F.col("__rule.rule"), "verdict": F.coalesce("__rule.verdict", own),
    }).drop("__rule", "__host", "domain", "suffix")


def junk_page(html: Column) -> Column:
    """An outcome measured on the page itself: its visible text has fewer than 10 words, or more than
    one character of ``#*$%&|`` for every 10 words. Null html: no outcome."""
    visible = F.regexp_replace(
        F.regexp_replace(html, r"(?s)<(script|style)[^>]*>.*?</(script|style)>", " "), "<[^>]*>", " ")
    text = F.regexp_replace(visible, "&[a-z]+;", " ")
    n = F.length(F.regexp_replace(F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "w"), r"[\x20\x09-\x0D]+", ""))
    signs = F.length(F.regexp_replace(text, "[^#*$%&|]+", ""))
    return (n < 10) | (10 * signs > n)
