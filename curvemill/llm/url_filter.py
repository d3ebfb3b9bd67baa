"""URL filters with redirect equivalence.

Pages that redirect to each other or name the same canonical page are aliases. Aliases are the connected
components over redirect edges (meta refresh) and canonical-link edges between URL keys; the key of a URL is
its host, path and query, so the scheme and the fragment make no difference. A rule is a host, a path prefix
and a verdict; it fits its host and all subdomains, and the longest rule that fits wins. A block passes to all
aliases of a blocked URL, crawled or only linked to; an allow rule on any alias takes precedence over it.

Defined results: a null URL, or one without '://', has an empty host and path, fits no rule, has no aliases
and is allowed; null HTML gives no edges; equal rows give equal results; an empty table gives an empty one.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvemill.llm.graph import components
from curvemill.llm.scratch import written

RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_path(url: Column) -> tuple[Column, Column, Column]:
    """Host (A-Z lower-cased), path, and what follows the path up to '#'; empty where there is no '://'."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^[^/?#]*", 0), _UPPER, _LOWER)
    tail = F.regexp_extract(rest, r"(?s)^[^/?#]*(.*)$", 1)
    path = F.regexp_extract(tail, r"(?s)^[^?#]*", 0)
    query = F.regexp_extract(tail, r"(?s)^[^?#]*(\?[^#]*)?", 1)
    return host, path, query


def _node(url: Column) -> Column:
    host, path, query = host_path(url)
    return F.when(host != "", F.concat(host, F.when(path == "", F.lit("/")).otherwise(path), query))


def suffixes(host: Column) -> Column:
    """The host and what follows each of its dots."""
    labels = F.split(host, r"\.", -1)
    at = F.sequence(F.lit(1), F.size(labels))
    return F.transform(at, lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def rule_verdicts(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(node_host, node_path, rule, verdict) of each distinct host and path that a rule fits.

    ``urls`` has host and path, ``rules`` has host, path and verdict. Every host suffix looks up its rules by
    an equi-join, so the rules may be a list of any size; Spark broadcasts it only below its own threshold.
    """
    spread = urls.select("host", "path").distinct().select("host", "path", F.explode(suffixes(F.col("host"))).alias("rule_host"))
    named = rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict"))
    fit = spread.join(named, "rule_host").where(F.col("path").startswith(F.col("rule_path")))
    rule = F.concat("rule_host", "rule_path")
    best = F.max(F.struct(F.length(rule).alias("n"), F.length("rule_host").alias("h"), (F.col("rule_verdict") == "allow").alias("allow"), rule.alias("rule")))
    found = fit.groupBy("host", "path").agg(best.alias("b"))
    return found.select("host", "path", F.col("b.rule").alias("rule"), F.when(F.col("b.allow"), "allow").otherwise("block").alias("verdict"))


def _attribute(tag: Column, name: str) -> Column:
    quoted = F.regexp_extract(tag, rf"""(?is)[\s"']{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", 0)
    return F.regexp_replace(F.regexp_extract(quoted, r"(?s)=\s*(.*)$", 1), r"""^["']|["']$""", "")


def _absolute(base: Column, target: Column) -> Column:
    """A link's target as an absolute URL; other schemes than http give null."""
    target = F.replace(F.btrim(target), F.lit("&amp;"), F.lit("&"))
    host = F.regexp_extract(base, r"(?s)^.*?://[^/?#]*", 0)
    folder = F.regexp_extract(base, r"(?s)^.*?://[^/?#]*(?:/(?:[^?#]*/)?)?", 0)
    folder = F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/")))
    return (
        F.when(target == "", None)
        .when(target.rlike(r"(?i)^https?://"), target)
        .when(target.startswith("//"), F.concat(F.lit("http:"), target))
        .when(target.startswith("/"), F.concat(host, target))
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:") | target.startswith("#"), None)
        .otherwise(F.concat(folder, target))
    )


def link_edges(pages: DataFrame) -> DataFrame:
    """(url, target): canonical links and meta refreshes of the pages' HTML, as absolute URLs."""
    tags = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(r"(?is)<(?:link|meta)\s[^>]*>"), F.lit(0))
    each = pages.where("url is not null").select("url", F.explode(tags).alias("tag"))
    rel, equiv = F.lower(_attribute(F.col("tag"), "rel")), F.lower(_attribute(F.col("tag"), "http-equiv"))
    refresh = F.regexp_replace(F.regexp_extract(_attribute(F.col("tag"), "content"), r"(?is)url\s*=\s*(.*)$", 1), r"""^["']|["']$""", "")
    target = F.when(rel == "canonical", _attribute(F.col("tag"), "href")).when(equiv == "refresh", refresh)
    return each.select("url", _absolute(F.col("url"), target).alias("target")).where("target is not null")


def judge(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict and alias_of (the least URL key of its aliases, else null) of every page.

    ``redirects`` (url, target) adds redirects known from elsewhere, such as a crawl log. The HTML is read once,
    for the edges; what is shuffled is URLs.
    """
    host, path, _ = host_path(F.col("url"))
    urls = written(pages.select("page_id", host.alias("host"), path.alias("path"), _node(F.col("url")).alias("node")), "url-pages")
    edges = link_edges(pages)
    if redirects is not None:
        edges = edges.unionByName(redirects.select("url", "target"))
    th, tp, _ = host_path(F.col("target"))
    edges = written(edges.select(_node(F.col("url")).alias("u"), _node(F.col("target")).alias("v"), th.alias("host"), tp.alias("path")), "url-edges")
    groups = written(components(edges.select("u", "v")), "url-aliases")
    verdicts = written(rule_verdicts(urls.select("host", "path").unionByName(edges.select("host", "path")), rules), "url-rules")

    named = urls.select("node", "host", "path").unionByName(edges.select(F.col("v").alias("node"), "host", "path"))
    said = named.where("node is not null").join(verdicts, ["host", "path"]).select("node", "verdict").distinct()
    by_group = said.join(groups, "node").groupBy("component").agg(F.min("verdict").alias("group_verdict"))  # 'allow' < 'block'
    inherited = groups.join(by_group, "component", "left").select("node", F.col("component").alias("alias_of"), "group_verdict")
    # Rules tell by path, the aliases by path and query: pages of one path share its rule.
    out = urls.join(verdicts, ["host", "path"], "left").join(inherited, "node", "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("verdict", "group_verdict", F.lit("allow")).alias("verdict"), "alias_of")


def rules_frame(spark, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def op7_redirect_equivalence(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return judge(pages, rules_frame(spark)).select("page_id", "host", "path", "rule", "verdict", "alias_of")


OP7_SQL = r"""
with recursive rules(host, path, verdict) as (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
tags as (select url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\s[^>]*>')) as tag from pages where url is not null),
said as (
    select url, tag, lower(regexp_extract(tag, '(?is)[\s"'']rel\s*=\s*["'']?([^"''\s>]*)', 1)) as rel, lower(regexp_extract(tag, '(?is)[\s"'']http-equiv\s*=\s*["'']?([^"''\s>]*)', 1)) as equiv,
    regexp_replace(regexp_extract(tag, '(?is)[\s"'']href\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)', 1), '^["'']|["'']$', '', 'g') as href,
    regexp_replace(regexp_extract(tag, '(?is)[\s"'']content\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)', 1), '^["'']|["'']$', '', 'g') as content from tags
),
raw as (select url, replace(trim(case when rel = 'canonical' then href when equiv = 'refresh' then regexp_replace(regexp_extract(content, '(?is)url\s*=\s*(.*)$', 1), '^["'']|["'']$', '', 'g') end), '&amp;', '&') as t from said),
based as (select url, t, regexp_extract(url, '(?s)^.*?://[^/?#]*') as host_part, regexp_extract(url, '(?s)^.*?://[^/?#]*(?:/(?:[^?#]*/)?)?') as folder from raw where t <> ''),
links as (
    select url, case when regexp_matches(t, '(?i)^https?://') then t when starts_with(t, '//') then 'http:' || t when starts_with(t, '/') then host_part || t
    when regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:') or starts_with(t, '#') then null else folder || case when ends_with(folder, '/') then '' else '/' end || t end as target from based
),
urls as (select distinct u from (select url as u from pages union all select url from links union all select target from links) where u is not null),
cut as (select u, case when contains(u, '://') then substr(u, strpos(u, '://') + 3) else '' end as rest from urls),
split as (select u, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1) as tail from cut),
known as (select u, host, regexp_extract(tail, '^[^?#]*') as path, case when host <> '' then host || case when regexp_extract(tail, '^[^?#]*') = '' then '/' else regexp_extract(tail, '^[^?#]*') end || regexp_extract(tail, '^[^?#]*(\?[^#]*)?', 1) end as node from split),
ruled as (select k.*, (select arg_max(struct_pack(rule := r.host || r.path, verdict := r.verdict), length(r.host || r.path)) from rules r where (k.host = r.host or ends_with(k.host, '.' || r.host)) and starts_with(k.path, r.path)) as hit from known k),
edges as (select a.node as a, b.node as b from links l join known a on a.u = l.url join known b on b.u = l.target where a.node <> b.node),
both_ways as (select a, b from edges union select b, a from edges),
reach as (select a as node, a as root from both_ways union select e.b, r.root from reach r join both_ways e on e.a = r.node),
groups as (select node, min(root) as alias_of from reach group by node),
verdicts as (select g.alias_of, min(r.hit.verdict) as v from ruled r join groups g using (node) where r.hit is not null group by g.alias_of)
select p.page_id, coalesce(r.host, '') as host, coalesce(r.path, '') as path, r.hit.rule as rule, coalesce(r.hit.verdict, v.v, 'allow') as verdict, g.alias_of
from pages p left join ruled r on r.u = p.url left join groups g on g.node = r.node left join verdicts v using (alias_of)
"""
