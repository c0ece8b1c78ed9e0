"""URL filters: rules on hosts and paths, found by hash prefixes.

A URL is expanded into the expressions a rule on it could have: its host or a domain above it, with
the beginning of its path. Expressions meet rules in an equi-join on a short prefix of their digest;
the full digest then confirms, and the longest rule decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayblotter.llm.common import stored, table, without

BROADCAST_RULES = 10_000
_PREFIX_DIGITS = 8  # hexadecimal digits of the digest that are joined on, 32 bits
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ADDED = ["host", "path", "rule", "verdict"]


def host_of(url: Column) -> Column:
    """From behind the first `://` up to `/`, `?`, `#` or the end; A-Z lower-cased; else empty."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From behind the host up to `?`, `#` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def filter_urls(
    pages: DataFrame, url: str, rules: DataFrame, default: str = "allow", salts: int = 32
) -> DataFrame:
    """Pages with `host`, `path`, `rule` and `verdict`.

    `rules` has host, path and verdict (allow or block). A rule fits its host and all subdomains when
    the path begins with the rule's; the longest (host and path together, then host) wins, and block
    wins over allow in a rule given twice. Without a fitting rule `rule` is null and `verdict` is
    `default`. A null url, or one without `://`, has an empty host and path and so no rule. Rules
    with a null are left out. Repeated rows are kept. Input columns named like added ones give way to
    them.

    Only as many labels and path beginnings are expanded as the longest rule has, so a very long url
    costs no more than its length. Decisions are made once per host and path. At most
    `BROADCAST_RULES` rules are broadcast; more are joined with `salts` copies of each, so that
    expressions all pages share spread over that many tasks.
    """
    parsed = without(pages, [*_ADDED, "_best"]).withColumn("host", host_of(F.col(f"`{url}`")))
    parsed = parsed.withColumn("path", path_of(F.col(f"`{url}`")))
    known = _prepared(rules)
    shape = known.agg(
        F.count(F.lit(1)).alias("rules"),
        F.max(F.size(F.split("_rule_host", r"\."))).alias("labels"),
        F.max(F.length(F.regexp_replace("_rule_path", "[^/]", ""))).alias("slashes"),
    ).first()
    # Lengths of rule paths that end within a path segment: one number for each length there is.
    odd = sorted(
        row[0]
        for row in known.where("_rule_path <> '' and not endswith(_rule_path, '/')")
        .select(F.length("_rule_path"))
        .distinct()
        .collect()
    )
    places = parsed.select("host", "path").distinct().where("host <> ''")
    asked = _expanded(places, shape["labels"] or 0, shape["slashes"] or 0, odd)
    if shape["rules"] <= BROADCAST_RULES:
        met = asked.join(F.broadcast(known), "_short")
    else:
        salted = known.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        met = asked.withColumn("_salt", F.pmod(F.xxhash64("host", "path"), F.lit(salts)).cast("int")).join(
            salted, ["_short", "_salt"]
        )
    best = stored(
        met.where("_digest = _rule_digest")
        .groupBy("host", "path")
        .agg(
            F.max(
                F.struct(
                    (F.length("_rule_host") + F.length("_rule_path")).alias("all"),
                    F.length("_rule_host").alias("of_host"),
                    F.concat("_rule_host", "_rule_path").alias("rule"),
                    F.col("_rule_verdict").alias("verdict"),
                )
            ).alias("_best")
        ),
        "urls",
    )
    # Decisions grow with the pages and compress well: Spark must not take their files for a few rows.
    return parsed.join(best.hint("merge"), ["host", "path"], "left").select(
        *[f"`{name}`" for name in parsed.columns],
        F.col("_best.rule").alias("rule"),
        F.coalesce("_best.verdict", F.lit(default)).alias("verdict"),
    )


def _prepared(rules: DataFrame) -> DataFrame:
    host = F.translate("host", _UPPER, _LOWER)
    return (
        rules.where("host is not null and path is not null and verdict is not null and host <> ''")
        .select(host.alias("_rule_host"), F.col("path").alias("_rule_path"), F.col("verdict"))
        .groupBy("_rule_host", "_rule_path")
        .agg(F.max("verdict").alias("_rule_verdict"))
        .withColumn("_rule_digest", _digest(F.col("_rule_host"), F.col("_rule_path")))
        .withColumn("_short", F.substring("_rule_digest", 1, _PREFIX_DIGITS))
    )


def _expanded(places: DataFrame, labels: int, slashes: int, odd: list[int]) -> DataFrame:
    """A row for each expression: up to `labels` last labels of the host, with each path beginning."""
    hosts = F.expr(
        f"transform(sequence(1, least({max(labels, 1)}, size(split(host, '[.]')))), "
        "n -> substring_index(host, '.', -n))"
    )
    beginnings = F.expr(
        "concat(array(''), "
        f"transform(sequence(1, least({max(slashes, 1)}, greatest(1, size(split(path, '/')) - 1))), "
        "n -> concat(substring_index(path, '/', n), '/'))"
        + "".join(f", array(substring(path, 1, {length}))" for length in odd)
        + ")"
    )
    begun = F.filter(F.array_distinct(beginnings), lambda part: F.col("path").startswith(part))
    return (
        places.select("host", "path", F.explode(F.array_distinct(hosts)).alias("_host"), begun.alias("_parts"))
        .select("host", "path", "_host", F.explode("_parts").alias("_part"))
        .select("host", "path", _digest(F.col("_host"), F.col("_part")).alias("_digest"))
        .withColumn("_short", F.substring("_digest", 1, _PREFIX_DIGITS))
    )


# The rules of the query.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def rules_frame(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def op3_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, "url", rules_frame(spark, RULES)).drop("url")


ORACLE = f"""
with places as (
  select page_id,
    translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') as host,
    regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) as path
  from pages
), rules(rhost, rpath, verdict) as (values {", ".join(map(str, RULES))})
select p.page_id, p.host, p.path, max_by(r.rhost || r.rpath, length(r.rhost || r.rpath)) as rule,
  coalesce(max_by(r.verdict, length(r.rhost || r.rpath)), 'allow') as verdict
from places p left join rules r
  on (p.host = r.rhost or ends_with(p.host, '.' || r.rhost)) and starts_with(p.path, r.rpath)
group by p.page_id, p.host, p.path
"""
