"""URL filters with redirect equivalence, in DataFrame functions alone.

Rules have a host, a path and a verdict. A rule fits a url if the url's host is the rule's or a subdomain of it and the
url's path starts with the rule's; of several the one with the longest host and path together wins. A url that a rule fits
has the rule's verdict: an explicit allow is never overruled. Other urls take the decision of their aliases: urls linked by
redirects (given as a table, or as meta refresh of a page) and canonical links are one component; if a member of it is
allowed by a rule the url is allowed, else if a member is blocked by a rule it is blocked, else it is allowed.

Links: every canonical link and every meta refresh of a page counts, outside of comments, scripts and styles. A target has
its character references for ASCII punctuation decoded and is resolved against the page's url as RFC 3986 says (with or
without scheme, host, leading slash, dot segments). A tag ends at its first `>`.

Aliases are told apart by host, path and query; scheme and fragment don't count. Rules are fitted to distinct pairs of host
and path: up to INLINE rules as literals of the expression, longer lists by a join on host suffixes, which gives the same.

Defined cases: null urls, and urls without `://`, have empty host and path, no rule, no alias and are allowed; repeated
urls get equal verdicts, and rows with equal or null page_id are judged by their own urls; null html has no links; empty
tables give no rows; targets of other schemes, without a host, or equal to the page are no links; other columns of pages
aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower_column
from .components import connected_components

ALLOW, BLOCK, INLINE = "allow", "block", 256
#: Parts into which the urls of a host suffix are dealt when a long list of rules is joined.
SALT = 32
#: Host, path and verdict of the rules of the query.
RULES = [("com", "/", ALLOW), ("example.com", "/en/", BLOCK), ("www.example.com", "/en/", ALLOW), ("net", "/es/", BLOCK), ("net", "/fr/", BLOCK)]

HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script|\z)|<style\b.*?(?:</style|\z)"
#: Tags that may be links, and the one value of each that is wanted (in one of the groups: quoted twice, once or not at all).
TAG = r"(?is)<(?:link|meta)\b[^>]*>"
IS_CANONICAL = r"""(?is)^<link\b[^>]*[\s"'/]rel\s*=\s*["']?(?:[^"'>]*\s)?canonical["'\s/>]"""
IS_REFRESH = r"""(?is)^<meta\b[^>]*[\s"'/]http-equiv\s*=\s*["']?refresh["'\s/>]"""
HREF = r"""(?is)[\s"'/]href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
CONTENT = r"""(?is)[\s"'/]content\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
TARGET = r"""(?is)^[^;,]*[;,]\s*url\s*=\s*(?:"([^"]*)"?|'([^']*)'?|([^\s"'].*))$"""
#: Characters whose references are decoded, with their names; the ampersand comes last, so that nothing is decoded twice.
REFERENCES = [(c, "") for c in "!#$%()*+,-./:;=?@[]_~"] + [("<", "lt"), (">", "gt"), ('"', "quot"), ("'", "apos"), ("&", "amp")]


def reference(char: str, name: str) -> str:
    """A pattern of the character's references."""
    return f"(?i)&(?:#0*{ord(char)}|#x0*{ord(char):x}{'|' + name if name else ''});"


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower_column(F.regexp_extract(url, r"://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """Host, path and query, null for what is no url."""
    query = F.regexp_extract(url, r"://[^?#]*(\?[^#]*)", 1)
    return F.when(host_of(url) != "", F.concat(host_of(url), path_of(url), query))


def inline_fit(pairs: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    every = F.array(*(F.struct(F.lit(len(h) + len(p)).alias("n"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"), F.lit(h).alias("h"), F.lit(p).alias("p")) for h, p, v in rules)) if rules else F.array().cast("array<struct<n:int,rule:string,verdict:string,h:string,p:string>>")
    host, path = F.col("host"), F.col("path")
    fits = F.filter(every, lambda r: ((host == r["h"]) | host.endswith(F.concat(F.lit("."), r["h"]))) & path.startswith(r["p"]))
    best = F.array_max(fits)
    return pairs.withColumns({"rule": best["rule"], "rule_verdict": best["verdict"]})


def joined_fit(pairs: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """As inline_fit, for distinct pairs. A suffix that very many hosts have is dealt into SALT parts."""
    table = pairs.sparkSession.createDataFrame(rules, "h string, p string, verdict string").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    every = pairs.select("host", "path", F.explode(suffixes).alias("h"), F.pmod(F.xxhash64("host", "path"), F.lit(SALT)).cast("int").alias("salt"))
    fits = every.join(table, ["h", "salt"]).where(F.col("path").startswith(F.col("p")))
    best = fits.groupBy("host", "path").agg(F.max(F.struct((F.length("h") + F.length("p")).alias("n"), F.concat("h", "p").alias("rule"), "verdict", "h", "p")).alias("best"))
    return pairs.join(best, ["host", "path"], "left").withColumns({"rule": F.col("best.rule"), "rule_verdict": F.col("best.verdict")}).drop("best")


def fitting_rule(urls: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """urls, which have host and path, with rule and rule_verdict."""
    if len(rules) <= INLINE:
        return inline_fit(urls, rules)
    pairs = joined_fit(urls.select("host", "path").distinct(), rules)
    return urls.join(pairs.where("rule is not null"), ["host", "path"], "left")


def resolved(page: Column, target: Column) -> Column:
    """The target as an absolute url; null if it has another scheme or is a mere fragment."""
    scheme, authority = F.regexp_extract(page, r"^(.*?)://", 1), F.regexp_extract(page, r"://([^/?#]*)", 1)
    path, tail = F.regexp_extract(target, r"^([^?#]*)", 1), F.regexp_extract(target, r"^[^?#]*(\?[^#]*)", 1)
    folder = F.regexp_extract(path_of(page), r"^(.*/)", 1)
    whole = F.when(path.startswith("/"), path).otherwise(F.concat(F.when(folder == "", "/").otherwise(folder), path))
    # repeated slashes within a relative path are one, then dot segments go
    steps = F.split(F.regexp_replace(F.regexp_replace(whole, "^/", ""), r"/{2,}", "/"), "/")
    walked = F.aggregate(steps, F.lit(""), lambda at, s: F.when(s == "..", F.regexp_replace(at, r"/[^/]*$", "")).when(s == ".", at).otherwise(F.concat(at, F.lit("/"), s)))
    plain = F.concat(walked, F.when(F.element_at(steps, -1).isin(".", ".."), "/").otherwise(""))
    own = F.concat(scheme, F.lit("://"), authority)
    return (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), None)
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when((target == "") | target.startswith("#"), None)
        .when(target.startswith("?"), F.concat(own, path_of(page), tail))
        .otherwise(F.concat(own, F.when(plain == "", "/").otherwise(plain), tail))
    )


def value_of(tag: Column, pattern: str) -> Column:
    """The one of three groups that matched."""
    return F.concat(*(F.regexp_extract(tag, pattern, k) for k in (1, 2, 3)))


def decoded(text: Column) -> Column:
    """The text with its character references decoded."""
    out = text
    for char, name in REFERENCES:
        out = F.regexp_replace(out, reference(char, name), "\\$" if char == "$" else char)
    return F.when(text.contains("&"), out).otherwise(text)


def links(pages: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """Edges a, b between nodes: canonical links and meta refreshes of the pages, and rows from_url, to_url of redirects."""
    # what holds neither isn't searched any further
    held = pages.where(F.col("html").rlike("(?i)canonical|refresh"))
    tags = held.select("url", F.explode(F.regexp_extract_all(F.regexp_replace("html", HIDDEN, " "), F.lit(TAG), F.lit(0))).alias("tag"))
    tag = F.col("tag")
    found = tags.select("url", F.when(tag.rlike(IS_CANONICAL), decoded(value_of(tag, HREF))).when(tag.rlike(IS_REFRESH), value_of(F.trim(decoded(value_of(tag, CONTENT))), TARGET)).alias("to")).where("to != ''")
    if redirects is not None:
        found = found.unionByName(redirects.select(F.col("from_url").alias("url"), F.col("to_url").alias("to")))
    to = F.regexp_replace("to", r"^\s+|\s+$", "")
    return found.select(node_of(F.col("url")).alias("a"), node_of(resolved(F.col("url"), to)).alias("b")).where("a is not null and b is not null and a != b")


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule and verdict of every page."""
    found = connected_components(links(pages, redirects))
    members = fitting_rule(found.select("node", "component", F.regexp_extract("node", r"^([^/?]*)", 1).alias("host"), F.regexp_extract("node", r"^[^/?]*([^?]*)", 1).alias("path")), rules)
    decided = members.groupBy("component").agg(F.max((F.col("rule_verdict") == ALLOW).cast("int")).alias("__allow"), F.max((F.col("rule_verdict") == BLOCK).cast("int")).alias("__block"))
    aliases = found.join(decided, "component").where("__allow = 1 or __block = 1").select("node", F.when(F.col("__allow") == 1, ALLOW).otherwise(BLOCK).alias("__alias"))
    url = F.col("url")
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), node_of(url).alias("node"))
    return fitting_rule(rows, rules).join(aliases, "node", "left").select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", "__alias", F.lit(ALLOW)).alias("verdict"))


def verdicts_of_pages(pages: DataFrame) -> DataFrame:
    return judge(pages.select("page_id", "url", "html"))


def oracle() -> str:
    """DuckDB SQL for verdicts_of_pages."""
    text = lambda s: "'" + s.replace("'", "''") + "'"
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
    low = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    host = lambda u: "coalesce(" + low.format(f"regexp_extract({u}, '://([^/?#]*)', 1)") + ", '')"
    path = lambda u: f"coalesce(regexp_extract({u}, '://[^/?#]*([^?#]*)', 1), '')"
    node = lambda u: f"CASE WHEN {host(u)} <> '' THEN {host(u)} || {path(u)} || regexp_extract({u}, '://[^?#]*(\\?[^#]*)', 1) END"
    value = lambda tag, pattern: " || ".join(f"regexp_extract({tag}, {text(pattern)}, {k})" for k in (1, 2, 3))

    def plain(x: str) -> str:
        for char, name in REFERENCES:
            x = f"regexp_replace({x}, {text(reference(char, name))}, {text(char)}, 'g')"
        return x

    walk = "list_reduce(list_prepend('', steps), lambda acc, s: CASE WHEN s = '..' THEN regexp_replace(acc, '/[^/]*$', '') WHEN s = '.' THEN acc ELSE acc || '/' || s END)"
    return f"""
WITH RECURSIVE rules(h, p, v) AS (VALUES {rules}),
tags AS (SELECT url, unnest(regexp_extract_all(regexp_replace(html, {text(HIDDEN)}, ' ', 'g'), {text(TAG)})) AS tag FROM pages),
named AS (
  SELECT url, {value('tag', HREF)} AS raw, true AS canonical FROM tags WHERE regexp_matches(tag, {text(IS_CANONICAL)})
  UNION ALL SELECT url, {value('tag', CONTENT)}, false FROM tags WHERE regexp_matches(tag, {text(IS_REFRESH)}) AND NOT regexp_matches(tag, {text(IS_CANONICAL)})),
plain AS (SELECT url, canonical, trim({plain('raw')}) AS raw FROM named),
found AS (SELECT url, trim(CASE WHEN canonical THEN raw ELSE {value('raw', TARGET)} END, chr(9) || chr(10) || chr(13) || ' ') AS target FROM plain),
parts AS (
  SELECT url, target, regexp_extract(url, '^(.*?)://', 1) AS scheme, regexp_extract(url, '://([^/?#]*)', 1) AS authority, regexp_extract(target, '^([^?#]*)', 1) AS tpath,
    regexp_extract(target, '^[^?#]*(\\?[^#]*)', 1) AS tail, regexp_extract({path('url')}, '^(.*/)', 1) AS folder FROM found WHERE target <> '' AND NOT starts_with(target, '#')),
stepped AS (SELECT *, string_split(regexp_replace(regexp_replace(CASE WHEN starts_with(tpath, '/') THEN tpath ELSE CASE WHEN folder = '' THEN '/' ELSE folder END || tpath END, '^/', ''), '/{{2,}}', '/', 'g'), '/') AS steps FROM parts),
full_found AS (
  SELECT url, CASE WHEN regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN target WHEN regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
    WHEN starts_with(target, '//') THEN scheme || ':' || target WHEN starts_with(target, '?') THEN scheme || '://' || authority || {path('url')} || tail
    ELSE scheme || '://' || authority || coalesce(nullif({walk} || CASE WHEN steps[-1] IN ('.', '..') THEN '/' ELSE '' END, ''), '/') || tail END AS target FROM stepped),
one_way AS (SELECT {node('url')} AS a, {node('target')} AS b FROM full_found),
edges AS (SELECT a, b FROM one_way WHERE a <> b UNION SELECT b, a FROM one_way WHERE a <> b),
reach AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
nodes AS (SELECT a, b, regexp_extract(b, '^([^/?]*)', 1) AS host, regexp_extract(b, '^[^/?]*([^?]*)', 1) AS path FROM reach),
ruled AS (SELECT a, arg_max(v, length(h) + length(p)) AS v FROM nodes, rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY a, b),
aliases AS (SELECT a, CASE WHEN bool_or(v = '{ALLOW}') THEN '{ALLOW}' ELSE '{BLOCK}' END AS v FROM ruled GROUP BY a),
judged AS (SELECT page_id, {host('url')} AS host, {path('url')} AS path, {node('url')} AS node FROM pages),
best AS (
  SELECT host, path, arg_max(h || p, length(h) + length(p)) AS rule, arg_max(v, length(h) + length(p)) AS v FROM
    (SELECT DISTINCT host, path FROM judged), rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY host, path)
SELECT j.page_id, j.host, j.path, b.rule, coalesce(b.v, a.v, '{ALLOW}') AS verdict
FROM judged j LEFT JOIN best b ON j.host = b.host AND j.path = b.path LEFT JOIN aliases a ON j.node = a.a"""
