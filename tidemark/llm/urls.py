"""URL filter with redirect equivalence, in DataFrame operations only.

A url's own verdict is that of the longest rule that fits it. Pages name other
addresses of themselves: a canonical link, or a refresh to another url; a table of
redirects may add more. These are edges between urls (without fragments, dot segments
and default ports); connected components over them are groups of aliases. A page
without a rule takes its group's decision: allow if a rule allows any alias (explicit
allow goes first), else block if a rule blocks any alias, else allow.

How a page is read: comments go first (an open one reaches to the end). A tag runs to its
first ``>``, so an attribute value that holds one cuts it short. Attributes are told by
their whole names; of a repeated one the first counts. Targets are seen from the
first ``<base href>``, itself seen from the page's url. Empty targets, fragments alone and
other schemes (``mailto:``) name no alias.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.components import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (action, rule): a rule is a host and a path.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))

_URL = r"(?s)^(.*?)://([^/?#]*)([^?#]*)(\?[^#]*)?"
_COMMENT = r"(?s)<!--.*?(?:-->|\z)"
_LINK, _META, _BASE = (rf"(?is)<{name}[\s/][^>]*>" for name in ("link", "meta", "base"))
#: An attribute with the sign before it, without the closing quote (the next one may need it).
_ATTRIBUTES = r"""(?is)[\s"'/][^\s=>"'/<]+\s*=\s*(?:"[^"]*|'[^']*|[^\s>"']+)"""
_VALUE = r"""(?s)^[^=]*=\s*["']?(.*)$"""
_CANONICAL, _REFRESH = r"(?is)(?:^|\s)canonical(?:\s|$)", r"(?is)^\s*refresh\s*$"
_TARGET = r"""(?is)\burl\s*=\s*["']?([^"'\s>]+)"""
_PORT = r"(?s)^(?:(http://.*):(?:80)?|(https://.*):(?:443)?)\z"


def _part(url: Column, k: int) -> Column:
    """Scheme, host, path or query (1 to 4) of a url; empty without ``://``."""
    return F.regexp_extract(url, _URL, k)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
    empty for a null url or one without ``://``."""
    return F.coalesce(F.translate(_part(url, 2), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(_part(url, 3), F.lit(""))


def without_dots(path: Column) -> Column:
    """A path, empty or from ``/`` on, without its ``.`` and ``..`` segments (RFC 3986, 5.2.4)."""
    parts = F.split(F.substr(path, F.lit(2)), "/", -1)
    popped = lambda kept: F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))
    step = lambda kept, x: F.when(x == ".", kept).when(x == "..", popped(kept)).otherwise(F.concat(kept, F.array(x)))
    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    last = F.when(F.element_at(parts, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    return F.when(path.contains("/."), F.concat(F.lit("/"), F.array_join(F.concat(kept, last), "/"))).otherwise(path)


def address_of(url: Column) -> Column:
    """A url as a node: scheme and host lower-cased, no default port, at least ``/`` as path,
    no dot segments, the query kept, no fragment; null without ``://``."""
    start = F.translate(F.concat(_part(url, 1), F.lit("://"), _part(url, 2)), UPPER, LOWER)
    path = F.regexp_replace(without_dots(path_of(url)), "^$", "/")
    return F.when(url.contains("://"), F.concat(F.regexp_replace(start, _PORT, "$1$2"), path, _part(url, 4)))


def resolve(base: Column, target: Column) -> Column:
    """``target`` as an absolute url, seen from a page at ``base`` (dot segments stay;
    ``address_of`` removes them); null where it names no other page."""
    scheme = _part(base, 1)
    root = F.concat(scheme, F.lit("://"), host_of(base))
    path = path_of(base)
    folder = F.regexp_replace(path, r"[^/]*$", "")
    return (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), target)
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when((target == "") | target.startswith("#") | target.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), F.lit(None))
        .when(target.startswith("/"), F.concat(root, target))
        .when(target.startswith("?"), F.concat(root, path, target))
        .otherwise(F.concat(root, F.regexp_replace(folder, "^$", "/"), target))
    )


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule that fits, as ``struct<.., rule, action>``; null if none does.

    A rule fits its host and all subdomains if the path starts with the rule's path. Of
    equally long rules the one with the longer host wins, then allow. ``rules`` is a
    short list; it becomes one expression, no join.
    """
    found = []
    for action, rule in rules:
        at = rule.find("/") if "/" in rule else len(rule)
        rule_host, rule_path = rule[:at].translate(str.maketrans(UPPER, LOWER)), rule[at:]
        fits = (host == rule_host) | host.endswith("." + rule_host) if rule_host else F.lit(True)
        fields = (len(rule), "length"), (at, "host_length"), (action == "allow", "allows"), (rule, "rule"), (action, "action")
        found.append(F.when(fits & path.startswith(rule_path), F.struct(*[F.lit(v).alias(n) for v, n in fields])))
    return F.array_max(F.array(*found)) if found else F.lit(None).cast("struct<length:int,host_length:int,allows:boolean,rule:string,action:string>")


def attribute_of(tag: Column, name: str) -> Column:
    """The value of a tag's first attribute of this name; null if it has none."""
    given = F.filter(F.regexp_extract_all(tag, F.lit(_ATTRIBUTES), F.lit(0)), lambda a: a.rlike(rf"(?is)^.{name}\s*="))
    return F.regexp_extract(F.get(given, F.lit(0)), _VALUE, 1)


def alias_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(a, b)``: addresses that a page's canonical links and refreshes make aliases."""
    rows = pages.select(F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    rows = rows.where(F.col("html").rlike(r"(?i)\bcanonical\b|\brefresh\b") & F.col("url").contains("://"))
    rows = rows.withColumn("html", F.regexp_replace("html", _COMMENT, " "))
    tags = lambda pattern: F.regexp_extract_all("html", F.lit(pattern), F.lit(0))
    links = F.filter(tags(_LINK), lambda t: attribute_of(t, "rel").rlike(_CANONICAL))
    metas = F.filter(tags(_META), lambda t: attribute_of(t, "http-equiv").rlike(_REFRESH))
    hrefs = F.transform(links, lambda t: attribute_of(t, "href"))
    moves = F.transform(metas, lambda t: F.regexp_extract(attribute_of(t, "content"), _TARGET, 1))
    bases = F.filter(F.transform(tags(_BASE), lambda t: attribute_of(t, "href")), lambda h: h.isNotNull())
    clean = lambda c: F.trim(F.replace(c, F.lit("&amp;"), F.lit("&")))
    named = rows.select("url", clean(F.get(bases, F.lit(0))).alias("base"), F.explode(F.concat(hrefs, moves)).alias("target"))
    base = F.coalesce(resolve(F.col("url"), F.col("base")), F.col("url"))
    seen = named.select("url", resolve(base, clean(F.col("target"))).alias("target"))
    return seen.select(address_of(F.col("url")).alias("a"), address_of(F.col("target")).alias("b"))


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, redirects: DataFrame | None = None,
    id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """One row per input row: ``page_id, host, path, rule, verdict``.

    ``rule`` is null and ``verdict`` the alias group's where no rule fits. ``redirects``
    may hold ``(src, dst)`` urls. Null urls and urls without ``://`` have empty host and
    path, fit no rule with a host and have no aliases: allow. Null html names no alias.
    Repeated rows and null ids are kept; other columns are not read; an empty table
    gives an empty table. ``host`` keeps its port, default or not, and rules are held
    against it as it stands; only aliases leave default ports out.
    """
    node = lambda c: address_of(F.col(c))
    edges = alias_edges(pages, url_col, html_col)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(node("src").alias("a"), node("dst").alias("b")))
    groups = connected_components(edges)
    own = groups.withColumn("r", rule_of(host_of(F.col("node")), path_of(F.col("node")), rules))
    decided = stored(
        own.groupBy("root").agg(F.bool_or(F.col("r.allows")).alias("allowed"), F.bool_or(~F.col("r.allows")).alias("blocked")), "url-groups"
    )
    blocked = decided.where(F.col("blocked") & ~F.col("allowed")).select("root")
    aliases = stored(groups.join(blocked, "root").select(F.col("node").alias("_alias"), F.lit(True).alias("_blocked")), "url-aliases")
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), address_of(url).alias("_address"))
    rows = rows.withColumn("_r", rule_of(F.col("host"), F.col("path"), rules))
    rows = rows.join(aliases, F.col("_address") == F.col("_alias"), "left")
    verdict = F.coalesce(F.col("_r.action"), F.when(F.col("_blocked"), F.lit("block")).otherwise(F.lit("allow")))
    return rows.select("page_id", "host", "path", F.col("_r.rule").alias("rule"), verdict.alias("verdict"))


def op2_url_filter(spark, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    from tidemark.sources.tables import table

    return judge(table(spark, sf_dir, "pages"))


def _sql() -> str:
    values = ", ".join(f"('{a}', '{r[: r.find('/')]}', '{r[r.find('/') :]}')" for a, r in RULES)

    def part(u: str, k: int) -> str:
        return f"regexp_extract({u}, '{_URL}', {k})"

    def host(u: str) -> str:
        return f"translate({part(u, 2)}, '{UPPER}', '{LOWER}')"

    def path(u: str) -> str:
        return part(u, 3)

    def dotless(u: str) -> str:
        parts = f"string_split(substr({path(u)}, 2), '/')"
        step = "CASE x WHEN '.' THEN kept WHEN '..' THEN regexp_replace(kept, '/[^/]*$', '') ELSE kept || '/' || x END"
        kept = f"list_reduce({parts}, lambda kept, x: {step}, '') || CASE WHEN {parts}[-1] IN ('.', '..') THEN '/' ELSE '' END"
        return f"CASE WHEN contains({path(u)}, '/.') THEN {kept} ELSE {path(u)} END"

    def address(u: str) -> str:
        start = f"translate({part(u, 1)} || '://' || {part(u, 2)}, '{UPPER}', '{LOWER}')"
        start = f"regexp_replace({start}, '{_PORT}', '\\1\\2')"
        return f"CASE WHEN strpos({u}, '://') > 0 THEN {start} || regexp_replace({dotless(u)}, '^$', '/') || {part(u, 4)} END"

    def attribute(t: str, name: str) -> str:
        given = f"list_filter(regexp_extract_all({t}, '{q(_ATTRIBUTES)}'), lambda a: regexp_matches(a, '(?is)^.{name}\\s*='))"
        return f"regexp_extract({given}[1], '{q(_VALUE)}', 1)"

    def resolved(b: str, t: str) -> str:
        root = f"{part(b, 1)} || '://' || {host(b)}"
        folder = f"regexp_replace({path(b)}, '[^/]*$', '')"
        return f"""CASE
    WHEN regexp_matches({t}, '^[A-Za-z][A-Za-z0-9+.\\-]*://') THEN {t}
    WHEN starts_with({t}, '//') THEN {part(b, 1)} || ':' || {t}
    WHEN {t} = '' OR starts_with({t}, '#') OR regexp_matches({t}, '^[A-Za-z][A-Za-z0-9+.\\-]*:') THEN NULL
    WHEN starts_with({t}, '/') THEN {root} || {t}
    WHEN starts_with({t}, '?') THEN {root} || {path(b)} || {t}
    ELSE {root} || regexp_replace({folder}, '^$', '/') || {t} END"""

    q = lambda s: s.replace("'", "''")
    clean = lambda c: f"trim(replace({c}, '&amp;', '&'))"
    named = lambda tag, name, kind: f"list_filter(regexp_extract_all(html, '{tag}'), lambda t: regexp_matches({attribute('t', name)}, '{kind}'))"
    bases = f"list_filter(list_transform(regexp_extract_all(html, '{_BASE}'), lambda t: {attribute('t', 'href')}), lambda h: h IS NOT NULL)"
    best = "row_number() OVER (PARTITION BY k ORDER BY length(rh || rp) DESC, length(rh) DESC, action) = 1"
    fits = "(host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)"
    return f"""
WITH RECURSIVE rules(action, rh, rp) AS (VALUES {values}),
p AS (SELECT row_number() OVER () AS k, page_id, coalesce(url, '') AS url, html FROM pages),
j AS (SELECT k, page_id, {host('url')} AS host, {path('url')} AS path, {address('url')} AS address FROM p),
r AS (SELECT k, action, rh || rp AS rule FROM j JOIN rules ON {fits} QUALIFY {best}),
h AS (SELECT url, regexp_replace(html, '{_COMMENT}', ' ', 'g') AS html FROM p WHERE strpos(url, '://') > 0 AND html IS NOT NULL),
tag AS (
  SELECT url, {clean(bases + '[1]')} AS base, unnest(list_concat(
    list_transform({named(_LINK, 'rel', _CANONICAL)}, lambda t: {attribute('t', 'href')}),
    list_transform({named(_META, 'http-equiv', _REFRESH)}, lambda t: regexp_extract({attribute('t', 'content')}, '{q(_TARGET)}', 1)))) AS target
  FROM h),
t AS (SELECT url, coalesce({resolved('url', 'base')}, url) AS base, {clean('target')} AS target FROM tag),
u AS (SELECT url, {resolved('base', 'target')} AS target FROM t),
e AS (SELECT {address('url')} AS a, {address('target')} AS b FROM u),
s AS (SELECT a, b FROM e WHERE a <> b UNION SELECT b, a FROM e WHERE a <> b),
reach(a, b) AS (SELECT a, b FROM s UNION SELECT reach.a, s.b FROM reach JOIN s ON reach.b = s.a),
n AS (SELECT DISTINCT b AS k, {host('b')} AS host, {path('b')} AS path FROM reach),
nr AS (SELECT k, action FROM n JOIN rules ON {fits} QUALIFY {best}),
g AS (SELECT a, bool_or(action = 'allow') AS allowed, bool_or(action = 'block') AS blocked
      FROM (SELECT a, b FROM reach UNION SELECT a, a FROM s) x JOIN nr ON x.b = nr.k GROUP BY a)
SELECT page_id, host, path, rule,
  coalesce(r.action, CASE WHEN g.blocked AND NOT g.allowed THEN 'block' ELSE 'allow' END) AS verdict
FROM j LEFT JOIN r USING (k) LEFT JOIN g ON g.a = j.address"""


SQL = _sql()
