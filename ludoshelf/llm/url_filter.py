"""URL rules with redirect equivalence.

A rule blocks or allows a host with its subdomains below a path. Redirects, canonical links and trivially different
spellings of an address (scheme, www. and m. labels, fragment, tracking parameters, trailing slash) are edges between
addresses; their connected components are aliases. A block decision of one alias holds for all that have no rule of their own,
unless some alias is explicitly allowed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludoshelf.llm.common import components, stage
from ludoshelf.sources.staging import Staging

#: (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """From the first :// up to /, ?, # or the end, A-Z lower-cased; empty for null or without ://."""
    return F.coalesce(F.translate(F.regexp_extract(url, "(?s)://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """Behind the host up to ? or #."""
    return F.coalesce(F.regexp_extract(url, "(?s)://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest fitting rule as a struct (rule, verdict), or null."""
    out: Column | None = None
    for verdict, of, below in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1], r[2])):
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(below)
        value = F.struct(F.lit(of + below).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule: string, verdict: string>")


def spelling(url: Column) -> Column:
    """One spelling for trivially different addresses: host without www. and m., path without a trailing slash, query without tracking."""
    host = F.regexp_replace(host_of(url), r"^(?:www\.|m\.)+(?=[^.]+\.)", "")
    path = F.regexp_replace(path_of(url), "/+$", "")
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    query = F.array_join(F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike(r"^(?:utm_\w+|ref|fbclid|gclid)(?:=|$)")), "&")
    whole = F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))
    return F.replace(whole, F.lit("://"), F.lit(":%2F/"))  # a spelling never looks like an address


def targets(url: Column, html: Column) -> Column:
    """Addresses that the page's canonical links and refresh redirects name, made absolute."""
    tags = F.regexp_extract_all(html, F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0))
    link = r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
    refresh = r"(?is)\bcontent\s*=\s*[\"']?\s*[0-9.]*\s*[;,]\s*url\s*=\s*[\"']?([^\"'\s>]+)"

    def named(tag: Column) -> Column:
        canonical = tag.rlike(r"(?is)^<link\b.*\brel\s*=\s*[\"']?canonical\b")
        redirect = tag.rlike(r"(?is)^<meta\b.*\bhttp-equiv\s*=\s*[\"']?refresh\b")
        return F.when(canonical, F.regexp_extract(tag, link, 1)).when(redirect, F.regexp_extract(tag, refresh, 1)).otherwise(F.lit(""))

    scheme, site = F.regexp_extract(url, "(?s)^(.*?)://", 1), F.regexp_extract(url, "(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_replace(path_of(url), "[^/]*$", "")
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)

    def absolute(to: Column) -> Column:
        return (
            F.when(to.contains("://"), to)
            .when(to.startswith("//"), F.concat(scheme, F.lit(":"), to))
            .when(to.startswith("/"), F.concat(site, to))
            .when(to.startswith("#") | to.startswith("?"), F.concat(site, path_of(url), to))
            .otherwise(F.concat(site, folder, to))
        )

    return F.transform(F.filter(F.transform(tags, named), lambda x: x != ""), absolute)


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, staged: Staging | None = None) -> DataFrame:
    """page_id, host, path, rule and verdict for every row of ``pages`` (page_id, url, html), and n_aliases, the pages' addresses in its component.

    A page with a rule has the rule's verdict. Else, if its address is in a component: allow if a rule allows any address of it, block
    if a rule blocks one, else allow. Targets that are no pages count as addresses. Null and unparsable urls have empty host and path, no
    rule, no aliases, and are allowed. Repeated rows are judged alike; a null html has no links; other columns are ignored.
    """
    staged = staged or stage(pages.sparkSession)
    url = F.col("url").cast("string")
    html = F.col("html").cast("string") if "html" in pages.columns else F.lit(None).cast("string")
    read = pages.select(F.col("page_id"), url.alias("url"), F.filter(F.coalesce(targets(url, html), F.array().cast("array<string>")), lambda x: x.contains("://")).alias("to"))
    read = staged(read, "url_pages")
    usable = read.where("url like '%://%'")
    linked = usable.select(F.col("url").alias("a"), F.explode("to").alias("b"))
    addresses = usable.select("url").union(linked.select(F.col("b").alias("url"))).distinct()
    # A spelling is a node too; it has no ://, so it is no address and has no rule.
    spelled = addresses.select(F.col("url").alias("a"), spelling(F.col("url")).alias("b"))
    grouped = staged(components(linked.union(spelled), staged, "url_aliases"), "url_components")

    ruled = matched_rule(host_of(F.col("node")), path_of(F.col("node")), rules)
    known = grouped.where("node like '%://%'").groupBy("root").agg(
        F.max((ruled["verdict"] == "allow").cast("int")).alias("allowed"), F.max((ruled["verdict"] == "block").cast("int")).alias("blocked"), F.count("*").alias("n_aliases")
    )
    decided = grouped.join(known.hint("merge"), "root").select(F.col("node").alias("url"), "allowed", "blocked", "n_aliases")
    own = matched_rule(F.col("host"), F.col("path"), rules)
    inherited = F.when(F.col("allowed") == 1, "allow").when(F.col("blocked") == 1, "block").otherwise("allow")
    return (
        read.join(decided.hint("merge"), "url", "left")
        .withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
        .withColumn("own", own)
        .select("page_id", "host", "path", F.col("own.rule").alias("rule"), F.coalesce(F.col("own.verdict"), inherited).alias("verdict"), F.coalesce("n_aliases", F.lit(0)).alias("n_aliases"))
    )


def _sql_host(url: str) -> str:
    return f"coalesce(translate(regexp_extract({url}, '://([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '')"


def _sql_path(url: str) -> str:
    return f"coalesce(regexp_extract({url}, '://[^/?#]*([^?#]*)', 1), '')"


def _sql_rule(host: str, path: str, rule: bool) -> str:
    cases = [
        f"WHEN ({host} = '{of}' OR {host} LIKE '%.{of}') AND starts_with({path}, '{below}') THEN '{of + below if rule else verdict}'"
        for verdict, of, below in sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r[1], r[2]))
    ]
    return f"CASE {' '.join(cases)} END"


#: The same over ``pages`` with the default rules, in DuckDB's SQL.
SQL = rf"""
WITH RECURSIVE usable AS (SELECT * FROM pages WHERE url LIKE '%://%'),
tags AS (SELECT url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) AS tag FROM usable),
named AS (
    SELECT url, CASE WHEN regexp_matches(tag, '(?is)^<link\b.*\brel\s*=\s*["'']?canonical\b') THEN regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)
        WHEN regexp_matches(tag, '(?is)^<meta\b.*\bhttp-equiv\s*=\s*["'']?refresh\b') THEN regexp_extract(tag, '(?is)\bcontent\s*=\s*["'']?\s*[0-9.]*\s*[;,]\s*url\s*=\s*["'']?([^"''\s>]+)', 1)
        ELSE '' END AS t FROM tags
), links AS (
    SELECT url AS a, CASE WHEN contains(t, '://') THEN t WHEN starts_with(t, '//') THEN regexp_extract(url, '(?s)^(.*?)://', 1) || ':' || t
        WHEN starts_with(t, '/') THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || t
        WHEN starts_with(t, '#') OR starts_with(t, '?') THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || {_sql_path('url')} || t
        ELSE regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || CASE WHEN {_sql_path('url')} LIKE '%/%' THEN regexp_replace({_sql_path('url')}, '[^/]*$', '') ELSE '/' END || t END AS b
    FROM named WHERE t <> ''
), addresses AS (SELECT url AS u FROM usable UNION SELECT b FROM links),
spelled AS (
    SELECT u AS a, replace(regexp_replace({_sql_host('u')}, '^(?:www\.|m\.)+([^.]+\.)', '\1') || regexp_replace({_sql_path('u')}, '/+$', '')
        || CASE WHEN q <> '' THEN '?' || q ELSE '' END, '://', ':%2F/') AS b
    FROM (SELECT u, array_to_string(list_filter(string_split(regexp_extract(u, '^[^?#]*\?([^#]*)', 1), '&'),
        lambda x: x <> '' AND NOT regexp_matches(x, '^(?:utm_\w+|ref|fbclid|gclid)(?:=|$)')), '&') AS q FROM addresses)
), edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links UNION SELECT a, b FROM spelled UNION SELECT b, a FROM spelled),
reach AS (SELECT u AS node, u AS other FROM addresses UNION SELECT r.node, e.b FROM reach r JOIN edges e ON e.a = r.other),
ruled AS (SELECT u, {_sql_rule(_sql_host('u'), _sql_path('u'), False)} AS verdict FROM addresses),
decided AS (SELECT r.node, count(*) AS n_aliases, bool_or(d.verdict = 'allow') AS allowed, bool_or(d.verdict = 'block') AS blocked FROM reach r JOIN ruled d ON d.u = r.other GROUP BY r.node)
SELECT page_id, {_sql_host('p.url')} AS host, {_sql_path('p.url')} AS path, {_sql_rule(_sql_host('p.url'), _sql_path('p.url'), True)} AS rule,
    coalesce({_sql_rule(_sql_host('p.url'), _sql_path('p.url'), False)}, CASE WHEN allowed THEN 'allow' WHEN blocked THEN 'block' ELSE 'allow' END) AS verdict,
    coalesce(n_aliases, 0) AS n_aliases
FROM pages p LEFT JOIN decided d ON d.node = p.url
"""
