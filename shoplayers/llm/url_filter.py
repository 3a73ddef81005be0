"""URL filter with redirect equivalence.

Rules are (host, path) pairs that allow or block. A rule fits its host and all subdomains of it if the
url's path starts with the rule's path; the longest rule wins, and of two equally long ones the one that
allows. Rules are a table. A url is looked up by its parent hosts, which say what lengths of path their rules
have, and then by (parent host, path prefix): both are joins by key, so more rules cost a url no more, and keys that
many urls share are cut into pieces. Equal (host, path) pairs are looked up once.

Pages that redirect to each other, or name each other as canonical, are one page under several
addresses. Addresses (host, path and query without fragment, without dot segments and default port) are nodes of a
graph, redirect and canonical links its edges, and its connected components are found in a distributed way. A url that
no rule fits takes its decision from its component: blocked if a member is blocked by a rule, unless a
member is explicitly allowed. Without either it is allowed. A url that a rule fits keeps that decision.

Links come from the page itself (`<link rel=canonical>`, `<meta http-equiv=refresh>`, both resolved against `<base
href>` if there is one and ignored inside comments) and, if given, from a table of redirects seen by the crawler.

Defined results: host and path of a NULL url or one without `://` are empty; no rule fits it and it has
no links, so it is allowed. Repeated rows are judged alike; equally long rules tie in favour of the one that allows.
Very long urls and pages take time in proportion to their length. Extra columns are not read, whatever their names. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shoplayers.functions.skew import join_counted_lookup
from shoplayers.llm.common import LOWER, UPPER
from shoplayers.llm.components import connected_components
from shoplayers.session import durable

ALLOW, BLOCK = "allow", "block"

# --- Fixed values: the rules of the registered query, as (verdict, host and path) -----------------
RULES = (
    (ALLOW, "org/"),
    (BLOCK, "example.org/es/"),
    (BLOCK, "example.org/en/1"),
    (ALLOW, "com/fr/"),
    (BLOCK, "com/de/"),
)


def host_of(url: Column) -> Column:
    """What follows the first `://` up to `/`, `?`, `#` or the end, with A-Z lower-cased."""
    host = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def _without_dots(path: Column) -> Column:
    """The path after its `.` and `..` segments have been followed."""
    segments = F.split(path, "/", -1)
    last = F.element_at(segments, -1)
    none = F.array().cast("array<string>")

    def walk(kept: Column, segment: Column) -> Column:
        up = F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(1)))  # the root stays
        return F.when(segment == ".", kept).when(segment == "..", up).otherwise(F.concat(kept, F.array(segment)))

    walked = F.array_join(F.aggregate(segments, none, walk), "/")
    walked = F.when(last.isin(".", "..") & ~walked.endswith("/"), F.concat(walked, F.lit("/"))).otherwise(walked)
    return F.when(path.contains("/."), walked).otherwise(path)


def address_of(url: Column) -> Column:
    """Host, path and query: the node of a url. NULL where there is no host."""
    host = host_of(url)
    host = F.when(url.rlike("(?i)^http://"), F.regexp_replace(host, ":80$", "")).otherwise(host)
    host = F.when(url.rlike("(?i)^https://"), F.regexp_replace(host, ":443$", "")).otherwise(host)
    query = F.regexp_extract(url, r"^(?s:.*?)://[^?#]*(\?[^#]*)", 1)
    path = F.when(path_of(url) == "", F.lit("/")).otherwise(_without_dots(path_of(url)))
    return F.when(host_of(url) != "", F.concat(host, path, query))


def _absolute(base: Column, link: Column) -> Column:
    """A link as it is read on the page at `base`."""
    link = F.regexp_replace(F.trim(link), "&amp;", "&")
    scheme = F.regexp_extract(base, r"^((?s:.*?)://)", 1)
    root = F.regexp_extract(base, r"^((?s:.*?)://[^/?#]*)", 1)
    page = F.regexp_extract(base, r"^((?s:.*?)://[^/?#]*[^?#]*)", 1)
    folder = F.when(path_of(base).contains("/"), F.regexp_extract(page, r"^((?s:.*)/)", 1)).otherwise(
        F.concat(root, F.lit("/"))
    )
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat(F.regexp_replace(scheme, "//$", ""), link))
        .when(link.startswith("/"), F.concat(root, link))
        .when(link.startswith("?"), F.concat(page, link))
        .when(link.startswith("#") | (link == ""), F.lit(None))
        .otherwise(F.concat(folder, link))
    )


def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(from_url, to_url) of every canonical link and every refresh in the pages' heads."""
    html = F.regexp_replace(F.col(html_col), r"(?s)<!--.*?(?:-->|\z)", "")
    tags = F.regexp_extract_all("html", F.lit(r"(?is)(<(?:link|meta|base)\b[^>]*>)"), F.lit(1))
    rows = pages.filter(F.col(html_col).rlike("(?i)canonical|refresh"))
    rows = rows.select(F.col(url_col).alias("from_url"), html.alias("html")).select("from_url", tags.alias("tags"))
    value = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""

    def attribute(tag: Column, name: str) -> Column:
        pattern = rf"(?is)\b{name}{value}"
        return F.concat(*[F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)])

    based = F.filter("tags", lambda tag: tag.rlike("(?i)^<base") & (attribute(tag, "href") != ""))
    base = _absolute(F.col("from_url"), F.when(F.size(based) > 0, attribute(F.get(based, F.lit(0)), "href")))
    rows = rows.select("from_url", F.coalesce(base, F.col("from_url")).alias("base"), F.explode("tags").alias("tag"))
    tag = F.col("tag")
    canonical = tag.rlike("(?i)^<link") & F.lower(attribute(tag, "rel")).rlike(r"(^|\s)canonical(\s|$)")
    refresh = tag.rlike("(?i)^<meta") & (F.lower(F.trim(attribute(tag, "http-equiv"))) == "refresh")
    refreshed = F.regexp_extract(attribute(tag, "content"), r"(?is)url\s*=\s*['\"]?([^'\"]*)", 1)
    link = F.when(canonical, attribute(tag, "href")).when(refresh, refreshed)
    return rows.select("from_url", _absolute(F.col("base"), link).alias("to_url")).filter("to_url IS NOT NULL")


# --- rules -----------------------------------------------------------------------------------------


def rules_table(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """(rule_host, rule_path, verdict) from (verdict, host and path) pairs; a rule ends its host at the first `/`."""
    parts = [(rule.partition("/"), verdict) for verdict, rule in rules]
    rows = [(host, slash + path, verdict) for (host, slash, path), verdict in parts]
    return spark.createDataFrame(rows, "rule_host string, rule_path string, verdict string")


def _parents(host: Column) -> Column:
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )


def winning_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(place, rows, verdict, rule) of the (host, path) pairs of `urls` that a rule fits; `place` is host and path
    together, `rows` says how many urls have it."""
    place = F.concat("host", "path").alias("place")
    pairs = durable(urls.filter("host <> ''").groupBy("host", "path").agg(F.count(F.lit(1)).alias("rows")))
    allows = F.max(F.when(F.col("verdict") == ALLOW, 1).otherwise(0)).alias("allows")
    rules = durable(rules.groupBy("rule_host", "rule_path").agg(allows))
    lengths = rules.groupBy("rule_host").agg(F.collect_set(F.length("rule_path")).alias("lengths"))
    under = pairs.select("path", place, "rows", F.explode(_parents(F.col("host"))).alias("rule_host"))
    seen = under.groupBy("rule_host").agg(F.count(F.lit(1)).alias("urls"))
    tried = join_counted_lookup(under, seen.join(lengths, "rule_host"), "rule_host", "urls", "place", how="inner")
    length = F.explode(F.filter("lengths", lambda n: n <= F.length("path"))).alias("n")
    tried = tried.select("place", "rows", "path", "rule_host", length)
    # A host holds no slash and a path begins with one, so both together name the rule.
    rule = F.concat("rule_host", F.expr("substring(path, 1, n)")).alias("rule")
    tried = tried.select("place", "rows", rule)
    named = rules.select(F.concat("rule_host", "rule_path").alias("rule"), "allows")
    asked = tried.groupBy("rule").agg(F.count(F.lit(1)).alias("urls")).join(named, "rule")
    hits = join_counted_lookup(tried, asked, "rule", "urls", "place", how="inner")
    best = F.max(F.struct(F.length("rule").alias("length"), "allows", "rule")).alias("best")
    return hits.groupBy("place").agg(F.max("rows").alias("rows"), best).select(
        "place",
        "rows",
        F.when(F.col("best.allows") == 1, F.lit(ALLOW)).otherwise(F.lit(BLOCK)).alias("verdict"),
        F.col("best.rule").alias("rule"),
    )


def with_rule(urls: DataFrame, rules: DataFrame, spread: str) -> DataFrame:
    """Add the verdict and the rule that wins, NULL where none fits, to rows with host and path."""
    placed = urls.withColumn("place", F.when(F.col("host") != "", F.concat("host", "path")))
    return join_counted_lookup(placed, winning_rules(urls, rules), "place", "rows", spread).drop("place", "rows")


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] | DataFrame = RULES,
    redirects: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """One row per input row: id, host, path, rule, verdict and component (root address or NULL).

    `rules` is a table of rule_host, rule_path and verdict, or pairs as `rules_table` takes them; `redirects` has the
    columns from_url and to_url.
    """
    if not isinstance(rules, DataFrame):
        rules = rules_table(pages.sparkSession, rules)
    links = page_links(pages, url_col, html_col)
    if redirects is not None:
        links = links.unionByName(redirects.select("from_url", "to_url"))
    edges = durable(
        links.select(address_of(F.col("from_url")).alias("a"), address_of(F.col("to_url")).alias("b")).distinct()
    )
    roots = durable(connected_components(edges, "a", "b"))

    # Decisions of all addresses that have links, pages or not, by rule; then of their components.
    node_url = F.concat(F.lit("//:"), F.lit("//"), F.col("node"))
    nodes = roots.select("node", "root", host_of(node_url).alias("host"), path_of(node_url).alias("path"))
    nodes = durable(with_rule(nodes, rules, "node").select("node", "root", "verdict"))
    own = F.col("verdict")
    decided = nodes.groupBy("root").agg(
        F.max(F.when(own == ALLOW, 1).otherwise(0)).alias("allowed"),
        F.max(F.when(own == BLOCK, 1).otherwise(0)).alias("blocked"),
        F.count(F.lit(1)).alias("members"),
    )
    passed = F.when((F.col("blocked") == 1) & (F.col("allowed") == 0), F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    members = join_counted_lookup(
        nodes.select("node", "root"), decided.select("root", "members", passed.alias("passed")), "root", "members", "node", how="inner"
    ).select("node", "root", "passed")

    urls = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")).select(
        "id", address_of(F.col("url")).alias("node"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    seen = urls.filter("node IS NOT NULL").groupBy("node").agg(F.count(F.lit(1)).alias("pages"))
    judged = join_counted_lookup(with_rule(urls, rules, "id"), members.join(seen, "node"), "node", "pages", "id")
    return judged.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        "rule",
        F.coalesce("verdict", "passed", F.lit(ALLOW)).alias("verdict"),
        F.col("root").alias("component"),
    )
