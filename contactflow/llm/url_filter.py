"""URL filters with redirect equivalence, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize
from .components import connected_components

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
CANONICAL = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
REFRESH = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
HREF = r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
REFRESH_URL = r"(?is)\burl\s*=\s*[\"']?([^\"'\s>;]+)"


def after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(rest: Column) -> Column:
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)


def path_of(rest: Column) -> Column:
    return F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def node_of(rest: Column) -> Column:
    """Key of a resource: host, path and query; scheme and fragment do not name another one."""
    return F.concat(host_of(rest), F.regexp_extract(rest, "^[^/?#]*([^#]*)", 1))


def _resolve(link: Column) -> Column:
    """What follows the scheme of a link found on the page with columns host and path."""
    return (
        F.when(F.instr(link, "://") > 0, after_scheme(link))
        .when(link.startswith("//"), F.substring(link, F.lit(3), F.length(link)))
        .when(link.startswith("/"), F.concat("host", link))
        .otherwise(F.concat("host", F.regexp_replace(F.concat(F.lit("/"), F.col("path")), "^/(.*?)[^/]*$", "$1"), link))
    )


def link_edges(pages: DataFrame) -> DataFrame:
    """(a, b) node keys: page to its canonical link, page to its refresh target."""
    rest = after_scheme(F.col("url"))
    tags = pages.where(F.col("html").rlike("(?i)canonical|http-equiv")).select(
        host_of(rest).alias("host"),
        path_of(rest).alias("path"),
        node_of(rest).alias("a"),
        F.regexp_extract(F.regexp_extract("html", CANONICAL, 0), HREF, 1).alias("canonical"),
        F.regexp_extract(F.regexp_extract("html", REFRESH, 0), REFRESH_URL, 1).alias("refresh"),
    )
    links = tags.select("a", "host", "path", F.explode(F.array("canonical", "refresh")).alias("link"))
    found = links.where("host != '' and link != ''").select("a", _resolve(F.col("link")).alias("rest"))
    return found.select("a", node_of(F.col("rest")).alias("b"))


def _suffixes(host: Column, labels: int) -> Column:
    """The host's endings of at most that many labels, which are all that a rule can name."""
    parts = F.split(host, r"\.")
    first = F.greatest(F.lit(1), F.size(parts) - labels + 1)
    return F.transform(F.sequence(first, F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def _with_rule(df: DataFrame, rules: DataFrame, labels: int) -> DataFrame:
    """df(host, path, ...) with rule and action of the longest rule that fits, else null."""
    hosts = df.select("host").distinct().select("host", F.explode(_suffixes(F.col("host"), labels)).alias("rule_host"))
    fitting = (
        hosts.join(rules, "rule_host")
        .groupBy("host")
        .agg(
            F.array_agg(
                F.struct(F.length("rule").alias("size"), F.col("rule"), F.col("rule_path"), F.col("action"))
            ).alias("rules")
        )
    )
    best = F.array_max(F.filter("rules", lambda r: F.startswith(F.col("path"), r["rule_path"])))
    joined = df.join(fitting, "host", "left").withColumn("best", best)
    return joined.withColumns({"rule": F.col("best.rule"), "action": F.col("best.action")}).drop("best", "rules")


def judge(spark: SparkSession, pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, inherited) for each row of pages(page_id, url, html, ...).

    rules(host, path, action): a rule fits its host and all subdomains where the url's path starts
    with the rule's; of those that fit, the longest text wins, of equal texts the larger action
    name. redirects(source, target) adds logged redirects to the links that pages declare.
    Pages, canonical links and redirect targets that are linked form one class. A page with a rule
    keeps that rule's verdict, so an explicit allow stands against its aliases; a page without one
    is blocked if any url of its class is blocked by a rule, else allowed.

    A null url or one without "://" has an empty host and path, joins no class and is allowed. Null
    html declares no link. Null or repeated page ids are judged row by row; other columns are not
    read. An empty table gives an empty table. A host's rules are gathered per host, which the size
    of the rule table bounds; pages are never gathered. Urls may be of any length: of a host only the
    endings that a rule could name are compared.
    """
    pages = pages.select("page_id", "url", "html")
    rules = rules.select(
        F.col("host").alias("rule_host"),
        F.col("path").alias("rule_path"),
        F.col("action"),
        F.concat("host", "path").alias("rule"),
    )
    labels = rules.agg(F.max(F.size(F.split("rule_host", r"\.")))).first()[0] or 1
    edges = link_edges(pages)
    if redirects is not None:
        edges = edges.union(
            redirects.select(node_of(after_scheme(F.col("source"))), node_of(after_scheme(F.col("target"))))
        )
    classes = connected_components(spark, edges.where("a != '' and b != ''"))
    node_parts = classes.select(
        "node", "component", host_of(F.col("node")).alias("host"), path_of(F.col("node")).alias("path")
    )
    blocked = (
        _with_rule(node_parts, rules, labels).where("action = 'block'").select("component").distinct()
    )
    inherited = materialize(
        spark, classes.join(blocked, "component", "left_semi").select("node", F.lit(True).alias("inherited")), "blocked"
    )
    rest = after_scheme(F.col("url"))
    parts = pages.select(
        "page_id", host_of(rest).alias("host"), path_of(rest).alias("path"), node_of(rest).alias("node")
    ).fillna("", ["host", "path", "node"])
    judged = _with_rule(parts, rules, labels).join(inherited, "node", "left")
    return judged.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("action", F.when(F.col("inherited"), "block"), F.lit("allow")).alias("verdict"),
        (F.col("action").isNull() & F.coalesce("inherited", F.lit(False))).alias("inherited"),
    )
