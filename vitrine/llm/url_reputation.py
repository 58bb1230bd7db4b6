"""URL filter: rules, and for the rest the reputation of the host by empirical Bayes.

Labelled pages are outcomes (bad or not) of their host.  Few hosts have enough of them, so a host's
rate is shrunk towards that of its registered domain, the domain's towards its suffix, and the
suffix's towards all pages.  On each level the units are beta-binomial around the rate above them: the
prior is worth as many pages as their spread around it says, by the method of moments,

    rho = sum((x - n m)^2 - n m (1 - m)) / sum(n (n - 1) m (1 - m)),   worth = 1 / rho - 1

for units with x bad of n pages below a rate m.  A host's posterior is then
Beta(worth m + x, worth (1 - m) + n - x), and the host is blocked when its rate is above `limit` with
the confidence that `sigmas` stands for: posterior mean less so many posterior standard deviations.

Outcomes are counted per host before anything is joined; what moves per page is its id, host and
path.  The three estimates of the prior's worth are single rows.  Pages of a host that holds many of
them are cut into pieces for the join with the verdicts.

A rule (host, path) fits its host and all subdomains where the page's path starts with its path; the
longest rule decides.  Rules are a list of the caller, evaluated as one expression.

Defined cases: a null url, or one without `://`, has an empty host and path; an empty host, an
address of numbers and a one-label host are their own domain and suffix.  User names and ports stay
in `host`, so that rules do not fit it, and are left out of the domain.  Pages without a label are no outcome; pages with
one id are judged each, and an outcome counts for each of them.  Labels without a page and null labels
count nothing, several labels of a page count bad if one is.  Without labels every rate is 0.5, worth
two pages, and nothing is blocked.  Other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vitrine.llm.common import ascii_lower, stored
from vitrine.operators.skew import heavy_from_counts, join_in_pieces

# (host, path, verdict)
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]
# Second-level names that registries of two-letter suffixes hand out below.
SECOND_LEVEL = ["ac", "co", "com", "edu", "gov", "net", "or", "org"]
LEAST_WORTH, MOST_WORTH = 0.5, 1000.0


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + F.lit(3)))
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    return (F.coalesce(ascii_lower(host), F.lit("")),
            F.coalesce(F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1), F.lit("")))


def bare_host(host: Column) -> Column:
    """A host without user name and port."""
    return F.regexp_replace(F.regexp_replace(host, r"\A.*@", ""), r":[0-9]*\z", "")


def registered_domain(bare: Column) -> Column:
    """The last two labels, or three where the suffix has two."""
    second = "|".join(SECOND_LEVEL)
    three = F.regexp_extract(bare, rf"([^.]+\.(?:{second})\.[^.]{{2}})\z", 1)
    two = F.regexp_extract(bare, r"([^.]+\.[^.]+)\z", 1)
    return F.when(bare.rlike(r"\A[0-9.]*\z|\]\z"), bare).when(three != "", three).when(two != "", two).otherwise(bare)


def suffix_of(domain: Column) -> Column:
    """What a registered domain hangs under."""
    return F.when(domain.rlike(r"\A[0-9.]*\z|\]\z"), domain).otherwise(F.regexp_extract(domain, r"\A(?:[^.]*\.)?(.*)\z", 1))


def rule_of(site: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule, as host and path in one text, and its verdict; null where none fits.
    Of rules of one length that with the longer host decides, then the one that blocks."""
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), -len(r[0]), r[2] == "allow", r))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, start, decision in reversed(ordered):
        fits = ((site == host) | F.endswith(site, F.lit("." + host))) & F.startswith(path, F.lit(start))
        rule = F.when(fits, F.lit(host + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """page_id, bad (0 or 1) of the pages that `labels` (doc_id, quality, toxic) tells something about: low
    quality or toxic is bad."""
    bad = F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1).when(
        F.col("toxic").isNotNull() | F.col("quality").isNotNull(), 0)
    told = (labels.select(F.col("doc_id").cast("long").alias("page_id"), bad.alias("bad"))
            .groupBy("page_id").agg(F.max("bad").alias("bad")).where(F.col("bad").isNotNull()))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "host").join(told, "page_id")


def _rate(bad: str, n: str, worth: Column, prior: Column) -> Column:
    return (F.col(bad) + worth * prior) / (F.col(n) + worth)


def _worth(units: DataFrame, prior: str) -> Column:
    """How many pages the rate above is worth for units (x, n) around it."""
    x, n, m = F.col("x").cast("double"), F.col("n").cast("double"), F.col(prior)
    spread = F.sum((x - n * m) * (x - n * m) - n * m * (1 - m))
    pairs = F.sum(n * (n - 1) * m * (1 - m))
    rho = F.greatest(F.lit(1 / (1 + MOST_WORTH)), F.least(F.lit(1 / (1 + LEAST_WORTH)), spread / pairs))
    return units.agg(F.when(pairs > 0, 1 / rho - 1).otherwise(2.0)).scalar()


def host_reputations(hosts: DataFrame, told: DataFrame, limit: float = 0.5, sigmas: float = 1.645) -> DataFrame:
    """host, n (labelled pages), bad_rate (posterior mean), lower (its bound) and blocked of all `hosts`;
    `told` (host, bad)."""
    counts = told.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("x"))
    bare = bare_host(F.col("host"))
    known = stored(
        hosts.select("host").distinct().join(counts, "host", "left")
        .select("host", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("x", F.lit(0)).alias("x"),
                registered_domain(bare).alias("domain"))
        .withColumn("suffix", suffix_of(F.col("domain"))), "reputation")
    domains = known.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    everywhere = suffixes.agg((F.coalesce(F.sum("x"), F.lit(0)) + 1.0) / (F.coalesce(F.sum("n"), F.lit(0)) + 2.0)).scalar()
    # Each level is stored with its prior: its own moments and its rates read it.
    suffixes = stored(suffixes.withColumn("prior", everywhere), "reputation")
    top = suffixes.select("suffix", _rate("x", "n", _worth(suffixes, "prior"), F.col("prior")).alias("prior"))
    domains = stored(domains.join(top, "suffix"), "reputation")
    middle = domains.select("domain", _rate("x", "n", _worth(domains, "prior"), F.col("prior")).alias("prior"))
    known = stored(known.select("host", "domain", "n", "x").join(middle, "domain"), "reputation")
    worth = _worth(known, "prior")
    known = known.withColumn("worth", worth).withColumn("rate", _rate("x", "n", F.col("worth"), F.col("prior")))
    width = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("n") + F.col("worth") + 1))
    lower = F.greatest(F.lit(0.0), F.col("rate") - sigmas * width)
    return known.select("host", "n", F.col("rate").alias("bad_rate"), lower.alias("lower"),
                        (lower > limit).alias("blocked"))


def judge(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]] | None = None,
          limit: float = 0.5, sigmas: float = 1.645) -> DataFrame:
    """page_id, host, path, rule and verdict of every page; `lower` is the bound of its host's bad rate."""
    host, path = url_parts(F.col("url"))
    parts = stored(pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path")),
                   "urls")
    rule, decided = rule_of(F.col("host"), F.col("path"), RULES if rules is None else rules)
    sizes = stored(parts.groupBy("host").agg(F.count(F.lit(1)).alias("pages")), "urls")
    reputations = host_reputations(sizes, outcomes(parts, labels).select("host", "bad"), limit, sigmas)
    ruled = parts.withColumns({"rule": rule, "decided": decided})
    judged = join_in_pieces(ruled, stored(reputations.select("host", "lower", "blocked"), "urls"), "host",
                            heavy_from_counts(sizes, "host", "pages"), ["page_id", "path"])
    verdict = F.coalesce("decided", F.when(F.col("blocked"), "block").otherwise("allow"))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "lower")
