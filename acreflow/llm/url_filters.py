"""URL filters with redirect equivalence.

A url is judged by the longest rule that fits its host and path.  Rules are a table: the ends of each host are
joined with the hosts of rules, then the beginnings of each path, in the lengths that rules of such a host have, with
the rules themselves.  So any number of rules does, and none is compared with every url.

Urls that redirect to one another, or name one another as canonical, are aliases: connected components over these
edges carry a block to every alias that no rule speaks about.  An explicit allow of an alias stands against a block
that comes from others.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acreflow.operators.components import connected_components
from acreflow.plans.storage import forget, stored

#: The production rules, as (verdict, host and path).
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A tag ends where the next one begins, so a tag that is never closed costs no more than its own characters.
_LINK, _META = r"(?is)<link\b[^<>]*>", r"(?is)<meta\b[^<>]*>"
_CANONICAL = r"(?is)\brel\s*=\s*[\"']?canonical\b"
_REFRESH = r"(?is)\bhttp-equiv\s*=\s*[\"']?refresh\b"
_HREF = r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
_CONTENT = r"(?is)\bcontent\s*=\s*(\"[^\">]*|'[^'>]*|[^\"'>]*)"
_TARGET = r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty without one."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ? # or the end; empty without ://."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def node_of(url: Column) -> Column:
    """What tells aliases apart: host, path and query, without scheme and fragment; null without ://."""
    query = F.regexp_extract(_rest(url), r"^[^?#]*(\?[^#]*)", 1)
    return F.when(F.instr(url, "://") > 0, F.concat(host_of(url), path_of(url), query))


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str]] | DataFrame) -> DataFrame:
    """(r_host, r_path, rule, verdict) of pairs (verdict, rule), or of a table with these columns; rules that are null
    or have another verdict than allow or block are left out.  A rule without / fits all paths."""
    table = rules if isinstance(rules, DataFrame) else spark.createDataFrame(list(rules), "verdict string, rule string")
    known = table.select("verdict", "rule").filter("rule is not null and verdict in ('allow', 'block')").distinct()
    return known.select(F.regexp_extract("rule", r"^[^/]*", 0).alias("r_host"), F.regexp_extract("rule", r"(?s)^[^/]*(.*)$", 1).alias("r_path"), "rule", "verdict")


def with_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict): for each distinct (host, path) that a rule of ``rule_table`` fits, the longest one;
    of equally long ones one that allows, then the last by its text."""
    labels = lambda h: F.size(F.split(h, r"\."))
    most = rules.agg(F.max(labels(F.col("r_host"))).alias("most"))
    own = urls.select("host", "path").distinct()
    parts, n = F.split("host", r"\."), labels(F.col("host"))
    ends = F.transform(F.sequence(F.lit(1), F.least(n, F.coalesce("most", F.lit(1)))), lambda k: F.array_join(F.slice(parts, n - k + 1, k), "."))
    lengths = rules.groupBy("r_host").agg(F.collect_set(F.length("r_path")).alias("lengths"))
    hosts = own.select("host").distinct().withColumn("most", most.scalar()).select("host", F.explode(ends).alias("r_host")).join(lengths, "r_host")
    begun = own.join(hosts, "host").select("host", "path", "r_host", F.explode(F.filter("lengths", lambda k: k <= F.length("path"))).alias("k"))
    begun = begun.select("host", "path", "r_host", F.substring(F.col("path"), F.lit(1), F.col("k")).alias("r_path"))
    best = F.max(F.struct(F.length("rule").alias("n"), (F.col("verdict") == "allow").alias("allows"), "rule")).alias("best")
    found = begun.join(rules, ["r_host", "r_path"]).groupBy("host", "path").agg(best)
    return found.select("host", "path", F.col("best.rule").alias("rule"), F.when(F.col("best.allows"), "allow").otherwise("block").alias("verdict"))


def _resolved(target: Column, url: Column) -> Column:
    """A link target as an absolute url: as it is, or relative to its page's scheme, host or folder."""
    target = F.replace(target, F.lit("&amp;"), F.lit("&"))
    scheme, host = F.regexp_extract(url, r"^(.*?)://", 1), F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    root = F.concat(scheme, F.lit("://"), host)
    folder = F.coalesce(F.nullif(F.regexp_extract(path_of(url), r"^(.*/)", 1), F.lit("")), F.lit("/"))
    return (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(root, target))
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .otherwise(F.concat(root, folder, target))
    )


def alias_edges(pages: DataFrame) -> DataFrame:
    """(a, b) urls: each page's url with what its canonical links and refresh redirects name."""
    html = F.col("html")
    some = pages.filter(html.rlike(r"(?i)canonical|refresh") & F.col("url").isNotNull())
    tags = lambda tag, kind: F.filter(F.regexp_extract_all(html, F.lit(tag), F.lit(0)), lambda x: x.rlike(kind))
    links = F.transform(tags(_LINK, _CANONICAL), lambda x: F.regexp_extract(x, _HREF, 1))
    targets = F.transform(tags(_META, _REFRESH), lambda x: F.regexp_extract(F.regexp_extract(x, _CONTENT, 1), _TARGET, 1))
    found = some.select("url", F.explode(F.concat(links, targets)).alias("to")).filter("to != ''")
    return found.select(F.col("url").alias("a"), _resolved(F.col("to"), F.col("url")).alias("b")).filter("b is not null")


def judge(pages: DataFrame, rules: Iterable[tuple[str, str]] | DataFrame = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict for each row of ``pages`` (page_id, url, html, more).

    ``rules``: pairs (verdict, rule) or a table of them, of any number.  ``redirects``: more edges, as columns a and
    b of urls.  The verdict is that of the url's own rule; without one it is block if any alias is blocked by a rule
    (whether the alias has a page or not), else allow.  Null url, or one without ://: empty host and path, no
    rule (but one of an empty host), allow.  Null, empty and very long html is searched like any other.  Repeated rows
    are judged each.  Other columns are ignored.
    """
    table = rule_table(pages.sparkSession, rules)
    edges = alias_edges(pages)
    if redirects is not None:
        edges = edges.unionByName(redirects.select("a", "b"))
    edges = stored(edges.select(node_of(F.col("a")).alias("a"), node_of(F.col("b")).alias("b"), F.col("a").alias("url_a"), F.col("b").alias("url_b")).filter("a is not null and b is not null").distinct(), "edges")
    own = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"))
    own = own.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), node_of(F.col("url")).alias("__key"))
    own = own.join(with_rules(own, table), ["host", "path"], "left")
    if edges.isEmpty():  # no aliases: each url is judged alone
        forget(edges)
        return own.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"))
    group = connected_components(edges, "a", "b")
    end = lambda x: edges.select(F.col(x).alias("node"), host_of(F.col(f"url_{x}")).alias("host"), path_of(F.col(f"url_{x}")).alias("path"))
    named = end("a").unionByName(end("b")).distinct()
    ruled = named.join(with_rules(named, table).filter("verdict = 'block'"), ["host", "path"]).select("node").distinct()
    blocked = group.join(ruled, "node").select("component").distinct()
    tainted = group.join(blocked, "component").select(F.col("node").alias("__node"), F.lit(True).alias("blocked"))
    own = own.join(tainted, F.col("__key") == F.col("__node"), "left")
    verdict = F.coalesce("verdict", F.when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow")))
    return own.select("page_id", "host", "path", "rule", verdict.alias("verdict"))


_SQL_RULES = ", ".join(f"('{v}', '{r}')" for v, r in RULES)
_SQL_PARTS = lambda url: f"""CASE WHEN instr({url}, '://') > 0 THEN substr({url}, instr({url}, '://') + 3) ELSE '' END"""
_SQL_LOWER = lambda x: f"translate({x}, '{_UPPER}', '{_LOWER}')"
_SQL_TEXT = lambda x: "'" + x.replace("'", "''") + "'"
#: The same by DuckDB, for the production rules and no further redirects.
ORACLE_SQL = rf"""
WITH RECURSIVE rules(verdict, rule) AS (VALUES {_SQL_RULES}),
own AS (SELECT row_number() OVER () AS r, page_id, coalesce(url, '') AS url, html FROM pages),
tags AS (
  SELECT url, unnest(list_concat(
    list_transform(list_filter(regexp_extract_all(html, {_SQL_TEXT(_LINK)}), lambda x: regexp_matches(x, {_SQL_TEXT(_CANONICAL)})), lambda x: regexp_extract(x, {_SQL_TEXT(_HREF)}, 1)),
    list_transform(list_filter(regexp_extract_all(html, {_SQL_TEXT(_META)}), lambda x: regexp_matches(x, {_SQL_TEXT(_REFRESH)})), lambda x: regexp_extract(regexp_extract(x, {_SQL_TEXT(_CONTENT)}, 1), {_SQL_TEXT(_TARGET)}, 1)))) AS raw
  FROM own WHERE url <> '' AND regexp_matches(html, '(?i)canonical|refresh')
),
targets AS (SELECT url, replace(raw, '&amp;', '&') AS t, regexp_extract(url, '^(.*?)://', 1) AS scheme, {_SQL_PARTS('url')} AS rest FROM tags WHERE raw <> ''),
resolved AS (
  SELECT url AS a, CASE WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t WHEN starts_with(t, '//') THEN scheme || ':' || t
    WHEN starts_with(t, '/') THEN scheme || '://' || regexp_extract(rest, '^[^/?#]*') || t WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
    ELSE scheme || '://' || regexp_extract(rest, '^[^/?#]*') || coalesce(nullif(regexp_extract(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '^(.*/)', 1), ''), '/') || t END AS b FROM targets
),
urls AS (SELECT url FROM own UNION SELECT a FROM resolved UNION SELECT b FROM resolved WHERE b IS NOT NULL),
cut AS (SELECT url, {_SQL_PARTS('url')} AS rest FROM urls),
known AS (SELECT url, {_SQL_LOWER("regexp_extract(rest, '^[^/?#]*')")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*([?][^#]*)', 1) AS query FROM cut),
judged AS (
  SELECT url, host, path, CASE WHEN instr(url, '://') > 0 THEN host || path || query END AS node, max(struct_pack(n := length(rule), allows := verdict = 'allow', rule := rule)) FILTER (WHERE rule IS NOT NULL) AS best
  FROM known LEFT JOIN rules ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1))) AND starts_with(path, substr(rule, instr(rule, '/'))) GROUP BY ALL
),
edges AS (SELECT x.node AS a, y.node AS b FROM resolved r JOIN judged x ON x.url = r.a JOIN judged y ON y.url = r.b WHERE x.node IS NOT NULL AND y.node IS NOT NULL),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reached AS (SELECT DISTINCT node AS n, node AS of FROM judged WHERE NOT best.allows AND node IN (SELECT a FROM both_ways) UNION SELECT e.b, r.of FROM reached r JOIN both_ways e ON e.a = r.n),
tainted AS (SELECT DISTINCT n FROM reached)
SELECT o.page_id, j.host, j.path, j.best.rule AS rule, CASE WHEN j.best IS NOT NULL THEN CASE WHEN j.best.allows THEN 'allow' ELSE 'block' END WHEN t.n IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM own o JOIN judged j ON j.url = o.url LEFT JOIN tainted t ON t.n = j.node
"""
