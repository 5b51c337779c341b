"""URL filter by rules and an empirical-Bayes host reputation.

Labelled page outcomes (bad or good) are counted per host.  A beta-binomial
prior is passed down from the suffix to the registered domain to the host: each
level's posterior mean is the next level's prior mean, and its strength is the
moment estimate of the spread between the level's groups.  A host is blocked if
a lower bound of its posterior bad rate exceeds the limit.

Defined cases: a null url, or one without ``://``, has an empty host and path,
no rule, and is judged by the empty host's outcomes; pages without html carry no
outcome; a host without outcomes gets its domain's, suffix's or the overall
rate; repeated page ids are rows like any other; an empty table gives an empty
result.  The registered domain is the last two labels, the suffix the last one.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.llm.common import LOWER, UPPER, DataFrame, SparkSession, cut_lineage, table

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
BAD_LIMIT = 0.5     # blocked if the bound of the bad rate exceeds this
Z = 1.645           # the bound is mean - Z * standard deviation
LEVELS = ("suffix", "domain", "host")


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url, both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls."""
    rule = verdict = F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def outcome(html: Column) -> Column:
    """1 for a page whose html is largely junk symbols, 0 otherwise, null without html."""
    junk = F.length(html) - F.length(F.translate(html, "#*$%|", ""))
    return F.when(junk * 50 > F.length(html), 1).when(html.isNotNull(), 0)


def reputation(outcomes: DataFrame) -> DataFrame:
    """Posterior of every host: host, bad_mean, bad_bound.  ``outcomes`` has
    host and bad (1, 0 or null).  All counts are sums combined before shuffling."""
    host = (outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("x"))
            .withColumn("suffix", F.element_at(F.split("host", r"\."), -1))
            .withColumn("domain", F.regexp_extract("host", r"([^.]*\.)?[^.]*$", 0)))
    host = cut_lineage(host)
    total = host.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("x"), F.lit(0)).alias("x")).first()
    above, parent = None, None
    for level in LEVELS:
        keys = {"suffix": ["suffix"], "domain": ["suffix", "domain"], "host": ["domain", "host"]}[level]
        df = host.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
        s = strength(df)
        if above is None:
            df = df.withColumn("mean", F.lit((total["x"] + 0.5) / (total["n"] + 1.0)))
        else:
            df = df.join(above, parent)
        size = F.col("n") + s
        df = df.withColumn("mean", (F.col("x") + F.col("mean") * s) / size)
        spread = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (size + 1))
        df = df.withColumn("bad_bound", F.col("mean") - F.lit(Z) * spread)
        parent, above = level, df.select(level, "mean")
    return df.select("host", F.col("mean").alias("bad_mean"), "bad_bound")


def strength(groups: DataFrame) -> float:
    """Beta prior strength from the spread of the groups' rates (one row of
    sums; between 1 and 99)."""
    n, x = F.col("n"), F.col("x")
    t = groups.filter("n > 0").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum(n * n).alias("nn"),
                                   F.sum("x").alias("x"), F.sum(x * x / n).alias("xx")).first()
    rho = 0.01
    if t["k"] > 1:
        msb = (t["xx"] - t["x"] * (t["x"] / t["n"])) / (t["k"] - 1)
        msw = (t["x"] - t["xx"]) / max(t["n"] - t["k"], 1)
        n0 = (t["n"] - t["nn"] / t["n"]) / (t["k"] - 1)
        if msb + (n0 - 1) * msw:
            rho = (msb - msw) / (msb + (n0 - 1) * msw)
    return 1 / min(0.5, max(0.01, rho)) - 1


def judge(pages: DataFrame, rules=RULES, limit: float = BAD_LIMIT) -> DataFrame:
    """page_id, host, path, rule, verdict, bad_bound of every page.  ``pages``
    needs page_id, url and bad (the labelled outcome, or null)."""
    host, path = url_parts(F.col("url"))
    row = pages.select("page_id", host.alias("host"), path.alias("path"), F.col("bad").cast("long").alias("bad"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    seen = reputation(row.select("host", "bad"))
    row = row.join(seen, "host", "left")    # a hot host is split by the skew join: its other side has one row
    own = F.when(F.col("bad_bound") > limit, F.lit("block")).otherwise(F.lit("allow"))
    return row.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "bad_bound")


def op7_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    pages = pages.select("page_id", "url", outcome(F.col("html")).alias("bad"))
    return judge(pages).select("page_id", "host", "path", "rule", "verdict")


def _level_sql(level: str, group: str, parent: str) -> str:
    return f"""
{level}_s as (
  select case when k > 1 then coalesce((msb - msw) / nullif(msb + (n0 - 1) * msw, 0), 0.01) else 0.01 end as rho from (
    select count(*) as k, (sum(x * x / n::double) - sum(x) * (sum(x) / sum(n)::double)) / nullif(count(*) - 1, 0) as msb,
      (sum(x) - sum(x * x / n::double)) / greatest(sum(n) - count(*), 1) as msw,
      (sum(n) - sum(n * n) / sum(n)::double) / nullif(count(*) - 1, 0) as n0
    from {group} where n > 0)),
{level}_p as (
  select g.*, p.mean * z.s as a0, z.s as s from {group} g join {parent},
    (select 1 / least(0.5, greatest(0.01, rho)) - 1 as s from {level}_s) z),
{level}_m as (select *, (x + a0) / (n + s) as mean from {level}_p)"""


SQL = ("""
with parsed as (
  select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest,
    case when (length(html) - length(translate(html, '#*$%|', ''))) * 50 > length(html) then 1
      when html is not null then 0 end as bad
  from pages),
row as (
  select page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(coalesce(rest, ''), '(?s)^[^/?#]*([^?#]*)', 1) as path, bad from parsed),
hosts as (
  select host, count(bad) as n, coalesce(sum(bad), 0)::bigint as x, split_part(host, '.', -1) as suffix,
    regexp_extract(host, '([^.]*\\.)?[^.]*$') as domain from row group by host),
suffixes as (select suffix, sum(n)::bigint as n, sum(x)::bigint as x from hosts group by suffix),
domains as (select suffix, domain, sum(n)::bigint as n, sum(x)::bigint as x from hosts group by suffix, domain),
top as (select (coalesce(sum(x), 0) + 0.5::double) / (coalesce(sum(n), 0) + 1.0::double) as mean from hosts),"""
       + _level_sql("suffix", "suffixes", "top p on true") + ","
       + _level_sql("domain", "domains", "suffix_m p on p.suffix = g.suffix") + ","
       + _level_sql("host", "hosts", "domain_m p on p.domain = g.domain") + """,
judged as (
  select r.page_id, r.host, r.path, h.mean - 1.645 * sqrt(h.mean * (1 - h.mean) / (h.n + h.s + 1)) as bound,
    case when (r.host = 'example.com' or ends_with(r.host, '.example.com')) and starts_with(path, '/de/') then 'example.com/de/'
      when (r.host = 'example.net' or ends_with(r.host, '.example.net')) and starts_with(path, '/en/') then 'example.net/en/'
      when (r.host = 'org' or ends_with(r.host, '.org')) and starts_with(path, '/fr/') then 'org/fr/'
      when (r.host = 'net' or ends_with(r.host, '.net')) and starts_with(path, '/') then 'net/' end as rule
  from row r left join host_m h on h.host = r.host)
select page_id, host, path, rule,
  case when rule in ('example.com/de/', 'net/') then 'block' when rule is not null then 'allow'
    when bound > 0.5 then 'block' else 'allow' end as verdict
from judged
""")
