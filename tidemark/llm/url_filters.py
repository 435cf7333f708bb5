"""URL filters whose decisions follow redirects and canonical links, in DataFrame operations.

A page's own rule always holds.  A page without one takes the decision of its aliases, the
addresses that redirects and canonical links connect it with: blocked if a rule blocks one of
them and none is explicitly allowed, else allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.store import Scratch

from .components import components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, rule): a host, which stands for its subdomains too, and the start of a path.
RULES = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
    ("allow", "com/fr/"), ("block", "com/de/"),
)
# Tags are cut out first, each up to the next ``<`` or ``>``, so a page is read once however many
# tags it leaves open.  Then their attributes are looked at, in whatever order they come.
TAG = r"(?is)<(?:link|meta)\b[^<>]*>"
CANONICAL = r"(?is)^<link\b.*\brel\s*=\s*[\"']?canonical\b"
REFRESH = r"(?is)^<meta\b.*\bhttp-equiv\s*=\s*[\"']?refresh\b"
HREF = r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
CONTENT = r"(?is)\bcontent\s*=\s*[\"'][^\"'>]*\burl\s*=\s*([^\"'\s>]+)"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def address(url: Column) -> Column:
    """A url as a node of the graph: scheme and fragment do not tell pages apart."""
    rest = F.regexp_replace(_rest(url), r"(?s)#.*$", "")
    query = F.regexp_extract(rest, r"(?s)(\?.*)$", 1)
    return F.concat(host(url), F.when(path(url) == "", "/").otherwise(path(url)), query)


def matching_rule(rules: tuple[tuple[str, str], ...], at_host: Column, at_path: Column) -> Column:
    """The longest rule that fits, as a struct (verdict, rule); null without one."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, _, start = rule.partition("/")
        fits = ((at_host == name) | at_host.endswith(f".{name}")) & at_path.startswith(f"/{start}")
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


def _without_dots(at_path: Column) -> Column:
    """A path that starts with ``/`` with its ``.`` and ``..`` parts resolved."""
    parts = F.split(at_path, "/", -1)
    dot = lambda x: x.isin(".", "..")
    left = F.aggregate(F.slice(parts, 2, F.size(parts)), F.array().cast("array<string>"), lambda held, x: (
        F.when(x == "..", F.slice(held, 1, F.greatest(F.size(held) - 1, F.lit(0))))
        .when(x == ".", held).otherwise(F.concat(held, F.array(x)))))
    last = F.when(dot(F.element_at(parts, -1)), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    return F.concat(F.lit("/"), F.array_join(F.concat(left, last), "/"))


def resolved(url: Column, to: Column) -> Column:
    """The url that ``to`` means on the page ``url``; null if it names no page (``mailto:x``)."""
    here = F.when(path(url) == "", "/").otherwise(path(url))
    to_path, rest = F.regexp_extract(to, r"(?s)^([^?#]*)", 1), F.regexp_extract(to, r"(?s)^[^?#]*(.*)$", 1)
    base = F.when(to_path.startswith("/"), "").otherwise(F.regexp_extract(here, r"(?s)^(.*/)", 1))
    there = F.when(to_path == "", here).otherwise(_without_dots(F.concat(base, to_path)))
    scheme = F.substring_index(url, "://", 1)
    return (F.when(to.startswith("//"), F.concat(scheme, F.lit(":"), to))
            .when(to.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), to)
            .when(~to.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:") & ~to.startswith("#"),
                  F.concat(scheme, F.lit("://"), host(url), there, rest)))


def links_in(pages: DataFrame) -> DataFrame:
    """(source, target) addresses of canonical links and refresh redirects in ``html``.

    Targets are resolved against the page's url, and ``&amp;`` in them is read as ``&``.
    """
    def last(pattern: str) -> Column:
        return F.try_element_at(F.regexp_extract_all("tag", F.lit(pattern), 1), F.lit(-1))

    html = F.lower("html")
    each = (pages.where(_rest(F.col("url")).isNotNull() & (html.contains("canonical") | html.contains("refresh")))
            .select("url", F.explode(F.regexp_extract_all("html", F.lit(TAG), 0)).alias("tag"))
            .select("url", F.when(F.col("tag").rlike(CANONICAL), last(HREF))
                    .when(F.col("tag").rlike(REFRESH), last(CONTENT)).alias("to")).where("to IS NOT NULL"))
    whole = resolved(F.col("url"), F.replace(F.col("to"), F.lit("&amp;"), F.lit("&")))
    return each.select(address(F.col("url")).alias("source"), address(whole).alias("target")).dropna()


def judge_urls(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES,
               links: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict) for each row of ``pages`` (page_id, url, html).

    ``links`` (source, target) are further redirects, as urls.  Host and path are empty for a
    null url or one without ``://``; such a page has no aliases, no rule and is allowed.
    ``rule`` is the longest of ``rules`` that fits, null without one, and decides alone; other
    pages follow their aliases.  Repeated rows are judged alike, an empty table gives an empty
    one.  Rules are part of the plan, so this is for lists of up to some hundred.
    """
    scratch = Scratch(pages.sparkSession, "urls")
    url = F.col("url")
    found = matching_rule(rules, host(url), path(url))
    judged = pages.select("page_id", host(url).alias("host"), path(url).alias("path"),
                          address(url).alias("address"), found.alias("found"))
    edges = links_in(pages)
    if links is not None:
        edges = edges.unionByName(links.select(address(F.col("source")).alias("source"),
                                               address(F.col("target")).alias("target")).dropna())
    edges = scratch(edges.where("source <> target").distinct(), "edges")
    verdict = F.col("found.verdict")
    if edges.isEmpty():
        decided = judged.withColumn("follows", F.lit(None).cast("string"))
    else:
        groups = scratch(components(edges.withColumnsRenamed({"source": "a", "target": "b"})), "groups")
        # Rules hold for addresses that links name, whether or not they are among the pages.
        node = F.col("node")
        said = matching_rule(rules, F.substring_index(node, "/", 1), F.regexp_extract(node, r"^[^/]*([^?]*)", 1))
        by_group = (groups.select("component", said["verdict"].alias("said")).where("said is not null")
                    .groupBy("component").agg(F.bool_or(F.col("said") == "block").alias("blocked"),
                                              F.bool_or(F.col("said") == "allow").alias("allowed")))
        follows = scratch(groups.join(by_group, "component").select(
            F.col("node").alias("address"),
            F.when(F.col("blocked") & ~F.col("allowed"), "block").otherwise("allow").alias("follows")), "follows")
        decided = judged.join(follows, "address", "left")
    return decided.select("page_id", "host", "path", F.col("found.rule").alias("rule"),
                          F.coalesce(verdict, F.col("follows"), F.lit("allow")).alias("verdict"))


# The same for DuckDB: components are reached from decided pages over links, both ways.
_PARSED = """
parsed AS (
  SELECT page_id, url, html,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest
  FROM pages
), placed AS (
  SELECT page_id, html, rest, CASE WHEN rest IS NOT NULL THEN substr(url, 1, strpos(url, '://') - 1) END AS scheme,
    coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM parsed
)"""


def _rule_sql(rules: tuple[tuple[str, str], ...], what: int) -> str:
    cases = []
    for r in sorted(rules, key=lambda r: -len(r[1])):
        name, _, start = r[1].partition("/")
        cases.append(f"WHEN (host = '{name}' OR ends_with(host, '.{name}')) "
                     f"AND starts_with(path, '/{start}') THEN '{r[what]}'")
    return "CASE " + " ".join(cases) + " END"


def judge_sql(rules: tuple[tuple[str, str], ...] = RULES) -> str:
    def node(h: str, p: str, rest: str) -> str:
        return (f"{h} || CASE WHEN {p} = '' THEN '/' ELSE {p} END || "
                f"regexp_extract(regexp_replace({rest}, '(?s)#.*$', ''), '(?s)(\\?.*)$', 1)")

    # This dialect's patterns have no lookahead: both orders of the attributes are written out.
    canonical = (r"(?is)<link\b[^>]*\brel\s*=\s*[\x22\x27]?canonical\b[^>]*\bhref\s*=\s*[\x22\x27]?([^\x22\x27\s>]+)",
                 r"(?is)<link\b[^>]*\bhref\s*=\s*[\x22\x27]?([^\x22\x27\s>]+)[^>]*\brel\s*=\s*[\x22\x27]?canonical\b")
    refresh = (r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\x22\x27]?refresh\b[^>]*\bcontent\s*=\s*[\x22\x27][^\x22\x27>]*\burl\s*=\s*([^\x22\x27\s>]+)",
               r"(?is)<meta\b[^>]*\bcontent\s*=\s*[\x22\x27][^\x22\x27>]*\burl\s*=\s*([^\x22\x27\s>]+)[\x22\x27][^>]*\bhttp-equiv\s*=\s*[\x22\x27]?refresh\b")
    found = " UNION ALL ".join(
        f"SELECT page_id, scheme, host, path, rest, unnest(regexp_extract_all(html, '{p}', 1)) AS t "
        f"FROM placed WHERE rest IS NOT NULL AND html IS NOT NULL" for p in (*canonical, *refresh))
    return f"""
WITH RECURSIVE {_PARSED}, ruled AS (
  SELECT page_id, host, path, {node("host", "path", "rest")} AS address,
    {_rule_sql(rules, 1)} AS rule, {_rule_sql(rules, 0)} AS said
  FROM placed
), found AS ({found}), pointed AS (
  SELECT {node("host", "path", "rest")} AS source,
    CASE WHEN strpos(t, '://') > 0 THEN substr(t, strpos(t, '://') + 3)
         WHEN starts_with(t, '//') THEN substr(t, 3)
         WHEN starts_with(t, '/') THEN host || t END AS trest
  FROM found
), links AS (
  SELECT source, {node("translate(regexp_extract(trest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')",
                       "regexp_extract(trest, '^[^/?#]*([^?#]*)', 1)", "trest")} AS target
  FROM pointed WHERE trest IS NOT NULL
), edges AS (
  SELECT source AS a, target AS b FROM links UNION SELECT target, source FROM links
), nodes AS (
  SELECT DISTINCT a AS address, regexp_extract(a, '^([^/]*)', 1) AS host,
    regexp_extract(a, '^[^/]*([^?]*)', 1) AS path FROM edges
), judged AS (
  SELECT address, {_rule_sql(rules, 0)} AS said FROM nodes
), reached AS (
  SELECT said, address FROM judged WHERE said IS NOT NULL
  UNION
  SELECT r.said, e.b FROM reached r JOIN edges e ON e.a = r.address
), follows AS (
  SELECT address, CASE WHEN bool_or(said = 'allow') THEN 'allow' ELSE 'block' END AS follows
  FROM reached GROUP BY address
)
SELECT page_id, host, path, rule, coalesce(said, follows, 'allow') AS verdict
FROM ruled LEFT JOIN follows USING (address)"""
