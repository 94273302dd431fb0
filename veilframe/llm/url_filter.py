"""URL filtering by rules first, then by empirical-Bayes host reputation.

Labelled page outcomes (good or bad) are counted per host. Each host's rate is shrunk towards its
registered domain, that towards its suffix, that towards all pages, with beta-binomial priors. What a group is shrunk towards
is made of the others under the same parent: a host's own pages are in no prior of its own. Strengths are fitted by moments at each
level, about the parents' means; a level no parent of which has two children takes that of the level above. A host is blocked if its mean is below ``min_good`` and its posterior leaves less than
``doubt`` = 2.5 % for a good rate of ``min_good`` or more, so if the 97.5 % quantile of the posterior, a beta distribution, is
below it. The tail is summed as a series of positive terms, which is exact to double precision for posteriors of up to ``EXACT_WEIGHT``
pages; beyond, where the beta distribution is normal to more digits than matter, by its mean and deviation.

Only counts move: one row a labelled page to count outcomes, then one row a host, stored once for all levels. A host with a third
of all pages is pre-aggregated before the shuffle, and the join that gives each page its host's
verdict has its hosts broadcast up to a counted bound, and is beyond that a plain equi-join whose page side can be split. The rules are a short policy list given as a parameter, as are the
suffixes below which strangers share a domain. An address (IPv4, or IPv6 in brackets) is a domain of its own.

Defined results: a null url or one without ``://`` has empty host and path and the global verdict;
outcomes with null label are not counted; repeated rows count each, and repeated or null page ids are judged each; with no outcome at all the prior
is even and nothing is blocked by reputation; equally long rules are taken in text order; empty tables give empty results; other
columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Cut, held

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Second-level labels that belong to the public suffix, as in co.uk.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))
#: Suffixes of hosting services, whose subdomains belong to strangers.
HOSTING_SUFFIXES = (
    "github.io", "gitlab.io", "blogspot.com", "wordpress.com", "tumblr.com", "herokuapp.com", "netlify.app", "vercel.app", "pages.dev",
    "web.app", "appspot.com", "azurewebsites.net", "cloudfront.net", "s3.amazonaws.com", "weebly.com", "wixsite.com", "fandom.com",
)
DOUBT, EXACT_WEIGHT, TERMS = 0.025, 5000, 600
#: Hosts whose verdicts are broadcast at most; a row takes some hundred bytes.
MAX_BROADCAST = 200_000
Z = 1.959963984540054


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_after_scheme(F.coalesce(url, F.lit(""))), r"^[^/?#]*", 0)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(F.coalesce(url, F.lit(""))), r"^[^/?#]*(/[^?#]*)", 1)


def bare(host: Column) -> Column:
    return F.regexp_replace(host, r":[0-9]*$", "")


def is_address(host: Column) -> Column:
    return bare(host).rlike(r"^(?:[0-9]{1,3}(?:\.[0-9]{1,3}){3}|\[[0-9a-f:.%]*\])$")


def suffix_of(host: Column, hosting=HOSTING_SUFFIXES) -> Column:
    """The last label, or the last two where the one before is a common second level (co.uk), or a hosting suffix; empty for
    an address."""
    name = bare(host)
    parts = F.split(name, r"\.")
    two = (F.size(parts) >= 3) & (F.length(F.element_at(parts, -1)) == 2) & F.get(parts, F.size(parts) - 2).isin(*SECOND_LEVEL)
    out = F.when(two, F.array_join(F.slice(parts, -2, 2), ".")).otherwise(F.element_at(parts, -1))
    for suffix in sorted(hosting, key=len):
        out = F.when(F.endswith(name, F.lit("." + suffix)), F.lit(suffix)).otherwise(out)
    return F.when(is_address(host), F.lit("")).otherwise(out)


def domain_of(host: Column, suffix: Column) -> Column:
    name = bare(host)
    n = F.size(F.split(suffix, r"\.")) + 1
    parts = F.split(name, r"\.")
    return F.when((suffix != "") & (F.size(parts) > n), F.array_join(F.slice(parts, F.size(parts) - n + 1, n), ".")).otherwise(name)


def rule_column(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0]), reverse=False):
        at = rule.index("/")
        name, prefix = rule[:at].lower(), rule[at:]
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(prefix))
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def children(n: str, good: str) -> list[Column]:
    """Aggregates of a parent over its children: count and good of all, and what the moments need."""
    n, good = F.col(n).cast("double"), F.col(good).cast("double")
    seen = F.when(n > 0, good * good / n)
    return [F.sum(n).alias("n"), F.sum(good).alias("g"), F.coalesce(F.sum(seen), F.lit(0.0)).alias("gg"), F.sum(n * n).alias("n2"), F.count_if(n > 0).alias("m")]


def strength(parents: DataFrame) -> float | None:
    """parents(``children``), a row each -> prior strength of their children: the moment estimate of beta-binomials that share it, each about its
    parent's mean; None where no parent has children that could differ. One row is read."""
    mu = F.col("g") / F.col("n")
    base, less = mu * (1 - mu), F.col("m") - 1
    free = F.col("n") - F.col("n2") / F.col("n") - less
    sums = parents.filter("n > 0").agg(F.sum(F.col("gg") - mu * F.col("g")).alias("spread"), F.sum(base * less).alias("base"), F.sum(base * free).alias("free")).first()
    if not sums["free"] or sums["free"] <= 1e-9:
        return None
    return 1 / min(0.5, max(0.001, (sums["spread"] - sums["base"]) / sums["free"])) - 1


def log_gamma(x: Column) -> Column:
    """Stirling's series, eight steps up, for x > 0."""
    z = x + 8
    series = (z - 0.5) * F.log(z) - z + 0.9189385332046727 + 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
    down = F.lit(0.0)
    for i in range(8):
        down = down + F.log(x + i)
    return series - down


def lower_tail(a: Column, b: Column, x: float) -> Column:
    """P(X <= x) for X ~ Beta(a, b), for x below or at the mean's neighbour (a + 1) / (a + b + 2), where the terms only fall:
    x^a (1 - x)^b / (a B(a, b)) * (1 + sum of products of (a + b + i) / (a + 1 + i) * x)."""
    start = F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s"))

    def add(acc, i):
        t = acc["t"] * (a + b + i) / (a + 1 + i) * x
        return F.struct(t.alias("t"), (acc["s"] + t).alias("s"))

    total = F.aggregate(F.sequence(F.lit(0), F.lit(TERMS - 1)), start, add)["s"]
    return F.exp(a * F.log(F.lit(x)) + b * F.log(F.lit(1 - x)) - F.log(a) - log_gamma(a) - log_gamma(b) + log_gamma(a + b)) * total


def surely_below(a: Column, b: Column, x: float, doubt: float = DOUBT) -> Column:
    """Whether Beta(a, b) has its mean below x and less than ``doubt`` of its mass at or above x."""
    mean = a / (a + b)
    upper = lower_tail(b, a, 1 - x)  # P(X >= x), by symmetry
    normal = mean + Z * F.sqrt(mean * (1 - mean) / (a + b + 1)) < x
    exact = F.when((1 - x) * (a + b + 2) > b + 1, F.lit(False)).otherwise(upper < doubt)
    return F.when(mean >= x, F.lit(False)).when(a + b > EXACT_WEIGHT, normal).otherwise(exact)


def host_reputation(outcomes: DataFrame, hosts: DataFrame, min_good: float = 0.5, doubt: float = DOUBT, hosting=HOSTING_SUFFIXES) -> DataFrame:
    """outcomes(host, good 0/1), hosts(host) -> one row a host with its posterior and verdict."""
    seen = outcomes.filter(F.col("good").isNotNull()).select("host", F.lit(1).alias("n"), F.col("good").cast("long").alias("g"))
    known = hosts.select("host", F.lit(0).alias("n"), F.lit(0).cast("long").alias("g")).unionByName(seen)
    known = known.groupBy("host").agg(F.sum("n").alias("n"), F.sum("g").alias("g"))
    known = known.withColumn("suffix", suffix_of(F.col("host"), hosting))
    known = Cut(known.withColumn("domain", domain_of(F.col("host"), F.col("suffix")))).df
    domains = Cut(known.groupBy("suffix", "domain").agg(*children("n", "g"))).df
    suffixes = Cut(domains.groupBy("suffix").agg(*children("n", "g"))).df
    whole = suffixes.agg(*children("n", "g"))
    everything = whole.first()
    n_all, g_all = everything["n"] or 0.0, everything["g"] or 0.0
    c_suffix = strength(whole) or 2.0
    c_domain = strength(suffixes) or c_suffix
    c_host = strength(domains) or c_domain
    # each mean leaves out the child that it is for
    top = (F.lit(g_all) - F.col("sg") + 1.0) / (F.lit(n_all) - F.col("sn") + 2.0)
    tops = suffixes.select("suffix", F.col("n").alias("sn"), F.col("g").alias("sg")).withColumn("top", top)
    s_mean = (F.col("sg") - F.col("dg") + c_suffix * F.col("top")) / (F.col("sn") - F.col("dn") + c_suffix)
    domains = domains.select("suffix", "domain", F.col("n").alias("dn"), F.col("g").alias("dg")).join(tops, "suffix").withColumn("s_mean", s_mean)
    d_mean = (F.col("dg") - F.col("g") + c_domain * F.col("s_mean")) / (F.col("dn") - F.col("n") + c_domain)
    a = F.col("g") + c_host * F.col("d_mean")
    b = F.col("n") - F.col("g") + c_host * (1 - F.col("d_mean"))
    out = known.join(domains.select("suffix", "domain", "dn", "dg", "s_mean"), ["suffix", "domain"]).withColumn("d_mean", held(d_mean))
    out = out.select("host", "domain", "suffix", F.col("n").alias("host_n"), F.col("g").alias("host_good"), held(a).alias("a"), held(b).alias("b"))
    return out.withColumn("good_mean", F.col("a") / (F.col("a") + F.col("b"))).withColumn(
        "reputation", F.when(held(surely_below(F.col("a"), F.col("b"), min_good, doubt)), "block").otherwise("allow")
    )


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules=RULES, min_good: float = 0.5, hosting=HOSTING_SUFFIXES) -> DataFrame:
    """pages(page_id, url), outcomes(url, good) -> page_id, host, path, rule, verdict and the posterior."""
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    marks = outcomes.select(host_of(F.col("url")).alias("host"), F.col("good"))
    fame = Cut(host_reputation(marks, urls.select("host"), min_good, hosting=hosting).select("host", "host_n", "good_mean", "reputation")).df
    if fame.count() <= MAX_BROADCAST:
        fame = F.broadcast(fame)
    rule = rule_column(F.col("host"), F.col("path"), rules)
    verdicts = F.lit(None).cast("string")
    for name, verdict in rules:
        verdicts = F.when(F.col("rule") == name, verdict).otherwise(verdicts)
    return (
        urls.join(fame, "host", "left")
        .withColumn("rule", rule)
        .select("page_id", "host", "path", "rule", F.coalesce(verdicts, F.col("reputation"), F.lit("allow")).alias("verdict"), "host_n", "good_mean")
    )


def page_verdicts(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """The query: the outcome of a page is the quality label of the document with its id."""
    outcomes = pages.select("page_id", "url").join(labels.select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good")), "page_id")
    return judge_urls(pages, outcomes.select("url", "good")).select("page_id", "host", "path", "rule", "verdict")


_HOSTING_SQL = ", ".join(f"'{s}'" for s in HOSTING_SUFFIXES)
#: The tail of the posterior is the integral of its density, by Simpson's rule over the logit of the rate, so it isn't the series above once more.
ORACLE = f"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path FROM u),
r AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule FROM p),
known AS (
  SELECT host, regexp_replace(host, ':[0-9]*$', '') AS bare, coalesce(n, 0) AS n, coalesce(g, 0) AS g
  FROM (SELECT DISTINCT host FROM p) h LEFT JOIN (
    SELECT host, count(*) AS n, sum(quality) AS g FROM p JOIN labels l ON l.doc_id = p.page_id WHERE quality IS NOT NULL GROUP BY host) o USING (host)),
parts AS (SELECT host, n, g, bare, string_split(bare, '.') AS l, regexp_matches(bare, '^([0-9]{{1,3}}([.][0-9]{{1,3}}){{3}}|\\[[0-9a-f:.%]*\\])$') AS address,
  list_max(list_filter([{_HOSTING_SQL}], lambda s: ends_with(bare, '.' || s))) AS service FROM known),
sfx AS (SELECT *, CASE WHEN address THEN 0 WHEN service IS NOT NULL THEN len(string_split(service, '.')) WHEN len(l) >= 3 AND length(l[-1]) = 2 AND l[-2] IN ('ac','co','com','edu','gov','net','org') THEN 2 ELSE 1 END AS k FROM parts),
h AS MATERIALIZED (SELECT host, n, g, CASE WHEN k = 0 THEN '' ELSE array_to_string(l[len(l) - k + 1 : len(l)], '.') END AS suffix,
  CASE WHEN k > 0 AND len(l) > k + 1 THEN array_to_string(l[len(l) - k : len(l)], '.') ELSE bare END AS domain FROM sfx),
d AS (SELECT suffix, domain, sum(n) AS n, sum(g) AS g FROM h GROUP BY suffix, domain),
s AS (SELECT suffix, sum(n) AS n, sum(g) AS g FROM d GROUP BY suffix),
lev AS (SELECT 'h' AS lv, suffix || ' ' || domain AS up, n, g FROM h UNION ALL SELECT 'd', suffix, n, g FROM d UNION ALL SELECT 's', '', n, g FROM s),
par AS (SELECT lv, up, CAST(sum(n) AS DOUBLE) AS nn, sum(g) / CAST(sum(n) AS DOUBLE) AS mu, sum(CAST(n AS DOUBLE) * n) AS n2, count(*) AS m FROM lev WHERE n > 0 GROUP BY lv, up),
mom AS (SELECT lv, any_value(ss) AS ss, sum(mu * (1 - mu) * (m - 1)) AS base, sum(mu * (1 - mu) * (nn - n2 / nn - (m - 1))) AS free
  FROM par JOIN (SELECT lv, sum(n * pow(g / CAST(n AS DOUBLE) - mu, 2)) AS ss FROM lev JOIN par USING (lv, up) WHERE n > 0 GROUP BY lv) q USING (lv) GROUP BY lv),
fit AS (SELECT max(c) FILTER (lv = 'h') AS h, max(c) FILTER (lv = 'd') AS d, max(c) FILTER (lv = 's') AS s FROM (SELECT lv, 1 / least(0.5, greatest(0.001, (ss - base) / free)) - 1 AS c FROM mom WHERE free > 1e-9) q),
c AS (SELECT coalesce(h, d, s, 2.0) AS h, coalesce(d, s, 2.0) AS d, coalesce(s, 2.0) AS s FROM fit),
own AS (SELECT h.host, h.suffix, h.domain, h.n, h.g, d.n - h.n AS dn, d.g - h.g AS dg, s.n - d.n AS sn, s.g - d.g AS sg, (SELECT sum(n) FROM s) - s.n AS tn, (SELECT sum(g) FROM s) - s.g AS tg
  FROM h JOIN d USING (suffix, domain) JOIN s ON s.suffix = h.suffix),
ab AS MATERIALIZED (SELECT host, g + c.h * p AS a, n - g + c.h * (1 - p) AS b FROM (SELECT own.*, (dg + c.d * (sg + c.s * (tg + 1.0e0) / (tn + 2.0e0)) / (sn + c.s)) / (dn + c.d) AS p FROM own, c) q, c),
bad AS (SELECT host, a, b FROM ab WHERE a / (a + b) < 0.5),
mass AS (SELECT host, sum(CASE WHEN k = 0 OR k = 2000 THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END * exp(lgamma(a + b) - lgamma(a) - lgamma(b) - a * ln(1 + exp(-k * 0.02)) - b * ln(1 + exp(k * 0.02)))) * 0.02 / 3 AS p
  FROM (SELECT *, unnest(range(0, 2001)) AS k FROM bad) GROUP BY host),
rep AS (SELECT ab.host, CASE WHEN p < 0.025 THEN 'block' ELSE 'allow' END AS reputation FROM ab LEFT JOIN mass USING (host))
SELECT page_id, host, path, rule,
  coalesce(CASE rule WHEN 'com/' THEN 'allow' WHEN 'www.example.com/en/' THEN 'allow' WHEN 'example.com/en/' THEN 'block' WHEN 'net/es/' THEN 'block' WHEN 'net/fr/' THEN 'block' END, reputation, 'allow') AS verdict
FROM r LEFT JOIN rep USING (host)
"""
