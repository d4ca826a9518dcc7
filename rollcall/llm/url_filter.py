"""URL filter: host rules, and empirical-Bayes reputation where no rule fits.

Labelled page outcomes (good or not) are counted per host.  Host, registered domain (one
label before the suffix) and suffix (last label, or one of ``SUFFIXES``) form a hierarchy;
a numeric address is a domain of its own, below one suffix of all addresses.  A group's good rate has a beta prior
whose mean is its parent's posterior mean and whose strength is estimated per level from
the spread of its groups (moments of the beta-binomial).  A page is blocked if the upper
posterior bound of its host's good rate is below ``GOOD_RATE``.

Everything works on counts per host, which are aggregated before any shuffle; the pages
meet their host's verdict in one join without a hint, whose hot hosts AQE splits.

DataFrame functions only.  Defined results: a null url, or one without ``://``, has empty
host and path and no rule; an empty host is a group of its own; equal rows are judged
alike and each keeps its row; pages without an outcome count as none; with no outcome at
all nothing is blocked by the method.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import pin

# Fixed values: (rule, verdict); host before the first slash, path from it.
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
#: Hosts whose good rate is below this with a posterior probability of about 95 % are blocked.
GOOD_RATE = 0.5
DEVIATIONS = 1.645
#: Bounds of the correlation of outcomes within a group, 1 / (1 + prior strength).
LEAST, USUAL, MOST = 0.01, 0.1, 0.5

# Suffixes of two labels below which domains are registered.
SUFFIXES = (
    "ac.jp", "ac.nz", "ac.uk", "ac.za", "co.id", "co.il", "co.in", "co.jp", "co.ke", "co.kr", "co.nz", "co.th", "co.uk", "co.za",
    "com.ar", "com.au", "com.br", "com.cn", "com.co", "com.hk", "com.mx", "com.my", "com.ph", "com.sg", "com.tr", "com.tw", "com.ua",
    "com.vn", "edu.au", "edu.cn", "go.jp", "gov.au", "gov.br", "gov.cn", "gov.in", "gov.uk", "me.uk", "ne.jp", "net.au", "net.br",
    "net.cn", "net.nz", "net.uk", "or.jp", "or.kr", "org.au", "org.br", "org.cn", "org.mx", "org.nz", "org.tw", "org.uk", "org.za",
)
#: Stands for the suffix of numeric addresses; no host name can hold brackets.
ADDRESS = "[address]"

_BARE = r"\.*(:[0-9]*)?$"
_NUMERIC = r"^([0-9]+(\.[0-9]+){3}|\[.*)$"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; nulls where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, what in sorted(rules, key=lambda r: len(r[0])):  # a longer one overrides
        at, slash, start = text.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(slash + start)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def bare_of(host: Column) -> Column:
    """``host`` without user, port and last dots."""
    return F.regexp_replace(F.substring_index(host, "@", -1), _BARE, "")


def domain_of(bare: Column) -> Column:
    """Registered domain: the suffix and the label before it, or the whole of a numeric address."""
    last = F.substring_index(bare, ".", -2)
    return F.when(bare.rlike(_NUMERIC), bare).when(last.isin(*SUFFIXES), F.substring_index(bare, ".", -3)).otherwise(last)


def suffix_of(domain: Column) -> Column:
    last = F.substring_index(domain, ".", -2)
    return F.when(domain.rlike(_NUMERIC), ADDRESS).when(last.isin(*SUFFIXES), last).otherwise(F.substring_index(domain, ".", -1))


def _posterior(groups: DataFrame, prior: str) -> DataFrame:
    """``groups`` (good, n and the column ``prior``) with posterior beta parameters a and b."""
    m, n, good = F.col(prior), F.col("n"), F.col("good")
    spread = m * (1 - m)
    row = groups.agg(
        F.sum((good - n * m) * (good - n * m)), F.sum(n * spread), F.sum(n * (n - 1) * spread)
    ).first()
    squares, alone, pairs = row
    rho = min(MOST, max(LEAST, (squares - alone) / pairs)) if pairs else USUAL
    strength = 1 / rho - 1
    return groups.withColumn("a", m * strength + good).withColumn("b", (1 - m) * strength + n - good)


def reputation(pages: DataFrame) -> DataFrame:
    """host, a, b: the beta posterior of each host's good rate; ``pages``: host, good (0, 1 or null)."""
    hosts = pages.groupBy("host").agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"))
    hosts = pin(hosts.withColumn("domain", domain_of(bare_of(F.col("host")))).withColumn("suffix", suffix_of(F.col("domain"))), "hosts")
    counts = [F.sum("n").alias("n"), F.sum("good").alias("good")]
    total = hosts.agg(*counts).first()
    overall = ((total["good"] or 0) + 1) / ((total["n"] or 0) + 2)
    domains = pin(hosts.groupBy("suffix", "domain").agg(*counts), "domains")
    suffixes = domains.groupBy("suffix").agg(*counts).withColumn("prior", F.lit(overall))
    mean = (F.col("a") / (F.col("a") + F.col("b"))).alias("prior")
    suffixes = pin(_posterior(suffixes, "prior").select("suffix", mean), "suffix_prior")
    domains = pin(_posterior(domains.join(suffixes, "suffix"), "prior").select("domain", mean), "domain_prior")
    return pin(_posterior(hosts.join(domains, "domain"), "prior").select("host", "a", "b"), "reputation")


def upper_bound(a: Column, b: Column, deviations: float = DEVIATIONS) -> Column:
    total = a + b
    return a / total + deviations * F.sqrt(a * b / (total * total * (total + 1)))


def judge(pages: DataFrame, outcomes: DataFrame, rules: tuple = RULES, good_rate: float = GOOD_RATE) -> DataFrame:
    """page_id, host, path, rule, verdict; ``outcomes``: page_id, good."""
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    known = outcomes.filter("page_id is not null").groupBy("page_id").agg(F.max("good").cast("long").alias("good"))
    judged = reputation(parts.select("page_id", "host").join(known, "page_id", "left"))
    bad = judged.select("host", (upper_bound(F.col("a"), F.col("b")) < good_rate).alias("bad"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("bad"), "block").otherwise("allow")
    return parts.join(bad, "host", "left").select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"))


def outcomes(labels: DataFrame) -> DataFrame:
    """Outcome of the page whose id a label carries: good if of quality 1 and not toxic."""
    good = (F.coalesce(F.col("quality"), F.lit(0)) == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    return labels.select(F.col("doc_id").alias("page_id"), good.cast("int").alias("good"))


def _level(name: str, groups: str) -> str:
    spread = "prior * (1 - prior)"
    return f"""
{name}_rho as (
  select coalesce(least({MOST}, greatest({LEAST},
    (sum(pow(good - n * prior, 2)) - sum(n * {spread})) / nullif(sum(n * (n - 1) * {spread}), 0))), {USUAL}) as rho from ({groups})),
{name}_post as (
  select g.*, prior * (1 / rho - 1) + good as a, (1 - prior) * (1 / rho - 1) + n - good as b from ({groups}) g, {name}_rho)"""


_RULE = "\n".join(
    f"      when (host = '{t.split('/')[0]}' or ends_with(host, '.{t.split('/')[0]}')) and starts_with(path, '{t[t.index('/'):]}') then '{t}'"
    for t, _ in sorted(RULES, key=lambda r: -len(r[0]))
)

_SUFFIXES = ", ".join(f"'{s}'" for s in SUFFIXES)

ORACLE_SQL = f"""
with parts as (
  select page_id,
    translate(regexp_extract(coalesce(url, ''), '{_PARTS}', 1), '{_UPPER}', '{_LOWER}') as host,
    regexp_extract(coalesce(url, ''), '{_PARTS}', 2) as path
  from pages),
known as (
  select doc_id as page_id, max(case when quality = 1 and coalesce(toxic, 0) = 0 then 1 else 0 end) as good
  from labels where doc_id is not null group by 1),
counted as (
  select host, count(good) as n, coalesce(sum(good), 0) as good, regexp_replace(string_split(host, '@')[-1], '{_BARE}', '') as bare
  from parts left join known using (page_id) group by 1),
hosts as (
  select host, n, good, case when regexp_matches(bare, '{_NUMERIC}') then bare
    when array_to_string(string_split(bare, '.')[-2:], '.') in ({_SUFFIXES}) then array_to_string(string_split(bare, '.')[-3:], '.')
    else array_to_string(string_split(bare, '.')[-2:], '.') end as domain
  from counted),
domains as (
  select domain, case when regexp_matches(domain, '{_NUMERIC}') then '{ADDRESS}'
    when array_to_string(string_split(domain, '.')[-2:], '.') in ({_SUFFIXES}) then array_to_string(string_split(domain, '.')[-2:], '.')
    else string_split(domain, '.')[-1] end as suffix, sum(n) as n, sum(good) as good
  from hosts group by 1, 2),
suffixes as (
  select suffix, sum(n) as n, sum(good) as good, (select (coalesce(sum(good), 0) + 1) / (coalesce(sum(n), 0) + 2) from hosts) as prior
  from domains group by 1),{_level("s", "select * from suffixes")},{_level("d", "select x.*, a / (a + b) as prior from domains x join s_post using (suffix)".replace("x.*", "x.domain, x.suffix, x.n, x.good"))},
{_level("h", "select x.host, x.n, x.good, a / (a + b) as prior from hosts x join d_post using (domain)")},
judged as (
  select host, a / (a + b) + {DEVIATIONS} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) < {GOOD_RATE} as bad from h_post),
ruled as (
  select *, case
{_RULE}
    end as rule from parts)
select page_id, host, path, rule,
  case when rule in ({", ".join(f"'{t}'" for t, v in RULES if v == "allow")}) then 'allow' when rule is not null then 'block'
    when bad then 'block' else 'allow' end as verdict
from ruled left join judged using (host)
"""
