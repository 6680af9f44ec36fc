"""URL rules: host-suffix and path-prefix expressions joined on short hash prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULE_SCHEMA = "rule_host string, rule_path string, action string"
SALTS = 8


def host_of(url: Column) -> Column:
    """Lower-cased (A-Z) text between the first ``://`` and the next ``/ ? #``; empty without one."""
    after = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    raw = F.regexp_extract(after, r"(?s)\A([^/?#]*)", 1)
    return F.coalesce(
        F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit("")
    )


def path_of(url: Column) -> Column:
    """Text from the end of the host to the next ``? #``; empty without ``://``."""
    after = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(after, r"(?s)\A[^/?#]*([^?#]*)", 1), F.lit(""))


def short_hash(digest: Column) -> Column:
    """First four bytes of a hex digest."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def expressions(host: Column, path: Column, host_lengths: Column, path_lengths: Column) -> Column:
    """All (host suffix, path prefix) pairs that a rule of these lengths could name.

    A suffix is the host itself or what follows one of its dots. Lengths that no
    rule has are left out, so a URL gets at most as many expressions as the
    rules have length pairs, however long it is.
    """
    n = F.length(host)
    suffixes = F.transform(
        F.filter(
            host_lengths,
            lambda k: (k == n) | ((k < n) & (F.substring(host, n - k, F.lit(1)) == ".")),
        ),
        lambda k: F.right(host, k),
    )
    prefixes = F.transform(
        F.filter(path_lengths, lambda k: k <= F.length(path)), lambda k: F.left(path, k)
    )
    return F.flatten(
        F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, F.lit("\n"), p)))
    )


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to pages; one output row per input row.

    A rule fits its host, all subdomains, and the paths that start with its
    path. The longest rule (host and path together) wins; between equally long
    ones the longer host, then ``block`` before ``allow``, then the smaller
    text. Without a rule the verdict is ``default``. Null or malformed URLs have
    an empty host and path. Rows with a null or empty rule host are ignored.
    Columns of the pages with these names are replaced.

    The result of each *distinct* URL (host, path) is found once, so one URL
    that fills a third of the table is one row after the map-side combine.
    """
    made = ("host", "path", "rule", "verdict", "_key")
    own = [c for c in pages.columns if c not in made]
    parsed = pages.select(
        *own, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")
    )
    rules = (
        rules.select("rule_host", "rule_path", "action")
        .filter("rule_host <> ''")
        .withColumn("rule_path", F.coalesce("rule_path", F.lit("")))
        .distinct()
    )
    table = rules.withColumn(
        "digest", F.sha2(F.concat("rule_host", F.lit("\n"), "rule_path").cast("binary"), 256)
    ).select(
        short_hash(F.col("digest")).alias("short"),
        "digest",
        F.concat("rule_host", "rule_path").alias("_rule"),
        F.length("rule_host").alias("host_len"),
        (F.length("rule_host") + F.length("rule_path")).alias("rule_len"),
        "action",
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"),
    )
    # One row: the distinct lengths, of which there are no more than a name or path can have.
    lengths = rules.agg(
        F.collect_set(F.length("rule_host")).alias("_hosts"),
        F.collect_set(F.length("rule_path")).alias("_paths"),
    )
    sought = (
        parsed.select("host", "path").distinct()
        .join(F.broadcast(lengths))
        .select(
            "host",
            "path",
            F.explode(expressions(F.col("host"), F.col("path"), F.col("_hosts"), F.col("_paths"))).alias("_e"),
        )
        .select("host", "path", F.sha2(F.col("_e").cast("binary"), 256).alias("digest"))
        .withColumn("short", short_hash(F.col("digest")))
        .withColumn("salt", F.pmod(F.xxhash64("host", "path"), F.lit(SALTS)).cast("int"))
    )
    confirmed = sought.join(table, ["short", "salt"]).filter(sought["digest"] == table["digest"])
    best = confirmed.groupBy("host", "path").agg(
        F.min(
            F.struct(
                -F.col("rule_len"), -F.col("host_len"), (F.col("action") != "block"), "_rule", "action"
            )
        ).alias("_best")
    )
    return parsed.join(best, ["host", "path"], "left").select(
        *own,
        "host",
        "path",
        F.col("_best._rule").alias("rule"),
        F.coalesce(F.col("_best.action"), F.lit(default)).alias("verdict"),
    )


RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def op10_url_rules(spark, sf_dir: str) -> DataFrame:
    """Every page's URL judged by the four fixed rules."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    judged = judge_urls(pages, spark.createDataFrame(list(RULES), RULE_SCHEMA))
    return judged.select("page_id", "host", "path", "rule", "verdict")


OP10_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages
), parsed AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM cut
), rules(rh, rp, action) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
         ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), best AS (
  SELECT p.*, r.rh || r.rp AS rule, r.action,
    row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC NULLS LAST) AS k
  FROM parsed p LEFT JOIN rules r
    ON (p.host = r.rh OR ends_with(p.host, '.' || r.rh)) AND starts_with(p.path, r.rp)
)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM best WHERE k = 1
"""
