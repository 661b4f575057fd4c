"""URL rules with redirect equivalence, in DataFrame functions only.

A rule allows or blocks a host with its subdomains, from a path prefix on; of the rules that fit a URL the longest (host and path
together) wins, allow before block at equal length. URLs that no rule fits are judged by their aliases: a page's canonical link, its
refresh redirect and any redirects given (source, target) are edges between URLs; connected components of these edges are
classes of one resource, and a class with a blocked URL is blocked. An allow rule that fits a URL holds for that URL whatever
its aliases are. A URL that is only the target of an edge counts too, so a page that redirects to a blocked URL is blocked.

URLs are compared as nodes without scheme, fragment, default port and click-tracking parameters, with the host in lower case and
an empty path as ``/``. Links are resolved against the page's URL (relative paths, dot segments, ``//host``); links of
other schemes are no edges. Comments, scripts, styles and templates hold no links.

Scale: rules are a short list of literals in the plan. Only pages with a link enter the components (large-star and small-star
rounds on written edge tables, nodes as 128-bit digests), so nothing of the corpus reaches the driver. Pages are joined by
node with the blocked nodes only; rows that need no look-up get a key of their own and spread evenly, and one URL
repeated in a third of the rows is a skewed probe side, which adaptive execution splits.

Defined results: null URLs and those without ``://`` have an empty host and path, fit no rule and are allowed; null html has no
links; repeated rows each give a row; without rules everything is allowed; columns that clash with the results are replaced.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelrank.llm.arrays import fresh_name
from panelrank.llm.components import components
from panelrank.llm.store import Store


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# the contract's rules (fixed values)
RULES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]

# query parameters that only track clicks (fixed values)
TRACKING = "utm_[a-z]+|gclid|fbclid|msclkid"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# parts of a page that hold no links; an unclosed one reaches to the end
HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<(script|style|template|textarea|title)\b.*?(?:</\1|\z)"
TAG = r"(?i)<(?:link|meta)\b[^<>]*+>"
ATTRIBUTE = r"""(?is)[\s"'/]{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


def host_of(url: Column) -> Column:
    after = F.substr(url, F.locate("://", url) + 3)
    return F.when(F.locate("://", url) > 0, F.translate(F.regexp_extract(after, r"(?s)\A[^/?#]*", 0), UPPER, LOWER)).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    after = F.substr(url, F.locate("://", url) + 3)
    return F.when(F.locate("://", url) > 0, F.regexp_extract(after, r"(?s)\A[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as struct (name, verdict); null if none does."""
    out = F.lit(None).cast("struct<name:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.name), r.verdict == "allow")):  # the last one that fits wins
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        out = F.when(fits, F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def node_of(url: Column) -> Column:
    """The node a URL stands for, as a digest; null for null and URLs without ``://``."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"\A[^@]*@", ""), r":(80|443)?\z", "")
    query = F.regexp_extract(url, r"(?s)\A[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.filter(F.split(query, "&", -1), lambda p: (p != "") & ~p.rlike(rf"(?i)\A({TRACKING})(=|\z)")), "&")
    path = path_of(url)
    return F.when(F.locate("://", url) > 0, F.md5(F.concat(host, F.when(path == "", "/").otherwise(path), F.when(kept == "", "").otherwise(F.concat(F.lit("?"), kept))).cast("binary")))


def _attribute(tag: Column, name: str) -> Column:
    raw = F.regexp_extract(tag, ATTRIBUTE.format(name=name), 1)
    bare = F.when(raw.rlike(r"""(?s)\A["']"""), F.substr(raw, F.lit(2), F.length(raw) - 2)).otherwise(raw)
    return F.trim(F.regexp_replace(bare, r"(?i)&amp;|&#0*38;|&#x0*26;", "&"))


def _without_dots(path: Column) -> Column:
    """A path with its ``.`` and ``..`` segments resolved."""
    parts = F.split(path, "/", -1)
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda out, p: F.when(p == "..", F.when(F.size(out) > 1, F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0)))).otherwise(out))
                       .when(p == ".", out).otherwise(F.concat(out, F.array(p))))
    last = F.element_at(parts, -1)
    return F.concat(F.array_join(kept, "/"), F.when(last.isin(".", ".."), "/").otherwise(""))


def resolve(link: Column, base: Column) -> Column:
    """A link as an absolute URL; null if it has another scheme than http or https, or nothing to be resolved against."""
    root = F.regexp_extract(base, r"(?s)\A.*?://[^/?#]*", 0)
    place = path_of(base)
    folder = F.when(place == "", "/").otherwise(F.regexp_extract(place, r"(?s)\A(.*/)", 1))
    bare, rest = F.regexp_extract(link, r"(?s)\A[^?#]*", 0), F.regexp_extract(link, r"(?s)\A[^?#]*(.*)\z", 1)
    return (F.when(link.rlike(r"(?i)\Ahttps?://"), link)
            .when(link.rlike(r"\A[A-Za-z][A-Za-z0-9+.-]*:") | (root == "") | base.isNull(), F.lit(None).cast("string"))
            .when(F.startswith(link, F.lit("//")), F.concat(F.lit("http:"), link))
            .when(F.startswith(link, F.lit("/")), F.concat(root, _without_dots(bare), rest))
            .when(bare == "", F.concat(root, place, rest))
            .otherwise(F.concat(root, _without_dots(F.concat(folder, bare)), rest)))


def declared_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(source, target) of every canonical link and refresh redirect that the pages declare."""
    seen = pages.select(F.col(url_col).alias("source"), F.col(html_col).alias("html")).where((F.locate("://", "source") > 0) & F.col("html").rlike(r"(?i)canonical|refresh"))
    tags = seen.select("source", F.explode(F.expr(f"regexp_extract_all(regexp_replace(html, r'{HIDDEN}', ' '), r'{TAG}', 0)")).alias("tag"))
    canonical = F.when(F.array_contains(F.split(F.lower(_attribute(F.col("tag"), "rel")), r"\s+"), "canonical") & F.col("tag").rlike(r"(?i)\A<link"), _attribute(F.col("tag"), "href"))
    content = F.when((F.lower(_attribute(F.col("tag"), "http-equiv")) == "refresh") & F.col("tag").rlike(r"(?i)\A<meta"), _attribute(F.col("tag"), "content"))
    refresh = F.regexp_extract(content, r"""(?is)\A[\s\d.]*[;,\s]\s*url\s*=\s*["']?([^"']*)""", 1)
    links = tags.select("source", F.coalesce(canonical, refresh).alias("link")).where("link <> ''")
    return links.select("source", resolve(F.col("link"), F.col("source")).alias("target")).where("target is not null")


def blocked_nodes(links: DataFrame, rules: list[Rule], store: Store) -> DataFrame:
    """(node) of every URL that is linked, over any number of links, with a URL that a rule blocks."""
    ends = links.select(*(f(F.col(c)).alias(n) for c, n, f in (("source", "a", node_of), ("target", "b", node_of))), *(
        (F.coalesce(rule_of(host_of(F.col(c)), path_of(F.col(c)), rules)["verdict"], F.lit("")) == "block").alias(n) for c, n in (("source", "a_bad"), ("target", "b_bad"))))
    ends = store.write(ends.where("a is not null and b is not null").groupBy("a", "b").agg(F.max("a_bad").alias("a_bad"), F.max("b_bad").alias("b_bad")), "links")
    both = ends.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("a_bad").alias("bad")), F.struct(F.col("b").alias("node"), F.col("b_bad").alias("bad")))).alias("n")).select("n.*")
    bad = both.groupBy("node").agg(F.max("bad").alias("bad"))
    classes = store.write(components(ends.select("a", "b"), store), "classes")
    # a node linked with nothing but itself is its own class
    known = bad.join(classes, "node", "left").withColumn("component", F.coalesce("component", "node"))
    hit = known.where("bad").select("component").distinct()
    return store.write(known.join(hit, "component").select("node").distinct(), "blocked")


def judge(pages: DataFrame, rules: list[Rule], redirects: DataFrame | None = None, url_col: str = "url", html_col: str | None = "html",
          keep: list[str] | None = None) -> DataFrame:
    """``pages`` (or its columns ``keep``) plus host, path, rule, verdict and ``why``: rule, alias or default."""
    spark = pages.sparkSession
    store = Store(spark, "url-filters")
    links = [declared_links(pages, url_col, html_col)] if html_col else []
    if redirects is not None:
        links.append(redirects.select(F.col("source").cast("string"), F.col("target").cast("string")))
    results = ("host", "path", "rule", "verdict", "why")
    url = F.col("`" + url_col + "`")
    own, node, known = (fresh_name(pages, n) for n in ("_rule", "_node", "_known"))
    held = [c for c in (keep if keep is not None else pages.columns) if c.lower() not in results or c == url_col]
    host, path = F.coalesce(host_of(url), F.lit("")), F.coalesce(path_of(url), F.lit(""))
    rows = pages.select(*(F.col(f"`{c}`") for c in held), host.alias("host"), path.alias("path"), rule_of(host, path, rules).alias(own), node_of(url).alias(node))
    out = rows
    if links:
        every = links[0] if len(links) == 1 else links[0].unionByName(links[1])
        bad = blocked_nodes(store.write(every, "declared"), rules, store).select(F.col("node").alias(node), F.lit(True).alias(known))
        # rows that need no look-up are spread by keys that no digest equals
        lone = F.concat(F.lit("-"), F.monotonically_increasing_id().cast("string"))
        out = rows.withColumn(node, F.when(F.col(own).isNull() & F.col(node).isNotNull(), F.col(node)).otherwise(lone)).join(bad, node, "left")
    else:
        out = rows.withColumn(known, F.lit(None).cast("boolean"))
    ruled, alias = F.col(own).isNotNull(), F.coalesce(F.col(known), F.lit(False))
    return out.select(*(F.col(f"`{c}`") for c in held), "host", "path", F.col(f"{own}.name").alias("rule"),
                      F.when(ruled, F.col(f"{own}.verdict")).when(alias, "block").otherwise("allow").alias("verdict"),
                      F.when(ruled, "rule").when(alias, "alias").otherwise("default").alias("why"))


def op13_url_filters(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), RULES, keep=["page_id"])


# rules by their literals; blocks spread over declared links (absolute, //host, /path and plain relative ones) to a fixpoint
ORACLE_SQL = r"""
WITH RECURSIVE
rules(verdict, host, path) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
tags AS (
    SELECT url, unnest(regexp_extract_all(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?(-->|\z)', ' ', 'g'), '(?is)<script\b.*?(</script|\z)', ' ', 'g'),
        '(?is)<style\b.*?(</style|\z)', ' ', 'g'), '(?i)<(?:link|meta)\b[^<>]*>')) AS tag
    FROM pages WHERE regexp_matches(html, '(?i)canonical|refresh') AND strpos(url, '://') > 0),
links AS (
    SELECT url, replace(trim(CASE WHEN regexp_matches(tag, '(?i)^<link') AND regexp_matches(tag, '(?i)\srel\s*=\s*["'']?([^"''>]* )?canonical') THEN regexp_extract(tag, '(?i)\shref\s*=\s*["'']?([^\s"''>]+)', 1)
        WHEN regexp_matches(tag, '(?i)^<meta') AND regexp_matches(tag, '(?i)http-equiv\s*=\s*["'']?refresh') THEN regexp_extract(tag, '(?i)url\s*=\s*[''"]?([^\s"''>]+)', 1) END), '&amp;', '&') AS link
    FROM tags),
edges AS (
    SELECT url AS source, CASE WHEN regexp_matches(link, '(?i)^https?://') THEN link WHEN link LIKE '//%' THEN 'http:' || link
        WHEN link LIKE '/%' THEN regexp_extract(url, '^.*?://[^/?#]*') || link ELSE regexp_extract(url, '^.*?://[^?#]*/') || link END AS target
    FROM links WHERE link <> '' AND (regexp_matches(link, '(?i)^https?://') OR NOT regexp_matches(link, '(?i)^[a-z][a-z0-9+.-]*:'))),
urls AS (SELECT url FROM pages UNION SELECT source FROM edges UNION SELECT target FROM edges),
parts AS (
    SELECT url, CASE WHEN strpos(url, '://') > 0 THEN translate(regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
        CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
    FROM urls),
judged AS (
    SELECT p.url, p.host, p.path, regexp_replace(regexp_replace(p.host, '^[^@]*@', ''), ':(80|443)?$', '') || CASE WHEN p.path = '' THEN '/' ELSE p.path END
            || '?' || array_to_string(list_filter(string_split(regexp_extract(coalesce(p.url, ''), '^[^?#]*\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(x, '(?i)^(utm_[a-z]+|gclid|fbclid|msclkid)(=|$)')), '&') AS node,
        max_by(r.host || r.path, length(r.host || r.path)) AS rule, max_by(r.verdict, length(r.host || r.path)) AS verdict
    FROM parts p LEFT JOIN rules r ON (p.host = r.host OR p.host LIKE '%.' || r.host) AND starts_with(p.path, r.path) GROUP BY ALL),
pairs AS (SELECT a.node AS a, b.node AS b FROM edges e JOIN judged a ON a.url = e.source JOIN judged b ON b.url = e.target),
bad(node) AS (
    SELECT node FROM judged WHERE verdict = 'block'
    UNION
    SELECT CASE WHEN p.a = bad.node THEN p.b ELSE p.a END FROM bad JOIN pairs p ON p.a = bad.node OR p.b = bad.node)
SELECT page_id, coalesce(j.host, '') AS host, coalesce(j.path, '') AS path, j.rule AS rule,
    coalesce(j.verdict, CASE WHEN EXISTS (SELECT 1 FROM pairs p WHERE p.a = j.node OR p.b = j.node) AND j.node IN (SELECT node FROM bad) THEN 'block' ELSE 'allow' END) AS verdict,
    CASE WHEN j.verdict IS NOT NULL THEN 'rule' WHEN EXISTS (SELECT 1 FROM pairs p WHERE p.a = j.node OR p.b = j.node) AND j.node IN (SELECT node FROM bad) THEN 'alias' ELSE 'default' END AS why
FROM pages LEFT JOIN judged j ON pages.url IS NOT DISTINCT FROM j.url
"""
