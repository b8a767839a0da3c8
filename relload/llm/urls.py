"""URL filters: rules by host and path, and redirect equivalence.

A redirect (meta refresh) or canonical link makes two addresses aliases.  Aliases form
connected components, found on the edge table alone; a component that holds an address
which some rule blocks passes the block on to every address that no rule judges.  An
explicit rule always comes first: an allowed address stays allowed beside blocked
aliases.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relload.llm.common import ascii_lower, write_table
from relload.llm.components import connected_components

# Fixed patterns: where host and path of an address lie, and the tags that redirect.
HOST = r"(?s)^.*?://([^/?#]*)"
PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"
# One piece of markup from left to right: a comment, an element whose content is no markup, a tag up to its ``>`` outside quotes.
RAW = ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes")
MARKUP = "|".join([r"(?is)<!--(?:-?>|.*?(?:--!?>|\z))", *(rf"<{x}[\s/>].*?(?:</{x}[\s/>]|\z)" for x in RAW)])
MARKUP += r"""|</?[a-z](?:[^>"']++|"[^"]*+(?:"|\z)|'[^']*+(?:'|\z))*+(?:>|\z)"""
ATTRIBUTE = r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?"""
REFRESH_URL = r"""(?is)^\s*[0-9.]+\s*[;,\s]\s*url\s*=\s*["']?\s*([^"'\s]+)"""
REFRESH_BARE = r"""(?is)^\s*[0-9.]+\s*[;,\s]\s*["']?([^"'\s]+)"""
# A character reference (named ones without a semicolon only where HTML reads them in an attribute), or text between them.
REFERENCE = r"(?s)(&#[xX][0-9a-fA-F]+;?|&#[0-9]+;?|&[A-Za-z][A-Za-z0-9]*(?:;|(?![=A-Za-z0-9;]))|[^&]+|&)"
SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"
DOT, DOTS = r"(?i)^(\.|%2e)$", r"(?i)^(\.|%2e){2}$"


def host_of(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty if there is no ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), PATH, 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest fitting rule, null if none fits.

    ``rules`` are (verdict, host, path) and belong to the job's configuration, so
    their number is fixed and small.  Ties in length go to the longer host.
    """
    longest = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1])))
    pick = F.lit(None)
    for verdict, h, p in reversed(longest):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        pick = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(pick)
    return pick


def node_of(url: Column) -> Column:
    """The address an edge joins: host and path and query, without scheme and fragment; null if it has no host."""
    host = host_of(url)
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(host != "", F.concat(host, rest))


def decoded(text: Column) -> Column:
    """``text`` with its HTML character references read once; unknown names stay as they are."""
    names = F.from_json(F.lit(json.dumps({"&" + k: v for k, v in html5.items()})), "map<string,string>")

    def read(x: Column) -> Column:
        digits = F.regexp_extract(x, r"^&#[xX]?0*([0-9a-fA-F]*);?$", 1)
        short = F.when(F.length(digits).between(1, 7), digits).otherwise("0")
        code = F.when(x.rlike("^&#[xX]"), F.conv(short, 16, 10)).otherwise(F.conv(short, 10, 10)).cast("bigint")
        valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code).otherwise(0xFFFD)), 8, "0")), "UTF-32")
        return F.when(x.startswith("&#") & (F.length(x) > 2), char).when(x.startswith("&"), F.coalesce(F.element_at(names, x), x)).otherwise(x)

    return F.when(text.contains("&"), F.array_join(F.transform(F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(1)), read), "")).otherwise(text)


def without_dots(url: Column) -> Column:
    """An absolute address whose path has no ``.`` and ``..`` segments left."""
    steps = F.split(path_of(url), "/", -1)
    last = F.element_at(steps, -1)
    kept = F.aggregate(
        steps, F.array().cast("array<string>"),
        lambda done, s: F.when(s.rlike(DOT), done)
        .when(s.rlike(DOTS), F.when(F.size(done) > 1, F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))).otherwise(done))
        .otherwise(F.concat(done, F.array(s))),
    )
    kept = F.when(last.rlike(DOT) | last.rlike(DOTS), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    before, after = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1), F.regexp_extract(url, r"(?s)^.*?://[^?#]*(.*)$", 1)
    return F.when(path_of(url).rlike(r"(?i)/(\.|%2e){1,2}(/|$)"), F.concat(before, F.array_join(kept, "/"), after)).otherwise(url)


def tag_targets(html: Column) -> Column:
    """Addresses that the page's canonical links and refresh tags name, in their order; null html has none.

    Markup is read from left to right, so what comments, scripts and quoted attributes hold
    is no tag.  Of an attribute given twice the first counts, and a name is the whole name
    (``data-href`` is no ``href``).
    """

    def value(tag: Column, name: str) -> Column:
        inside = F.regexp_replace(tag, "^<[A-Za-z]+", "")
        names = F.transform(F.regexp_extract_all(inside, F.lit(ATTRIBUTE), F.lit(1)), ascii_lower)
        found = F.get(F.regexp_extract_all(inside, F.lit(ATTRIBUTE), F.lit(2)), (F.array_position(names, name) - 1).cast("int"))
        return F.when(found.rlike("^[\"']"), F.substring(found, F.lit(2), F.length(found) - 2)).otherwise(found)

    def target(tag: Column) -> Column:
        canonical = tag.rlike("(?i)^<link") & F.array_contains(F.split(ascii_lower(value(tag, "rel")), r"\s+"), "canonical")
        refresh = tag.rlike("(?i)^<meta") & (ascii_lower(F.trim(value(tag, "http-equiv"))) == "refresh")
        content = decoded(value(tag, "content"))
        named, bare = F.regexp_extract(content, REFRESH_URL, 1), F.regexp_extract(content, REFRESH_BARE, 1)
        later = F.when(named != "", named).when(~bare.rlike("(?i)^url"), bare)
        return F.when(canonical, decoded(value(tag, "href"))).when(refresh, later)

    tags = F.filter(F.regexp_extract_all(html, F.lit(MARKUP), F.lit(0)), lambda x: x.rlike(r"(?i)^<(link|meta)[\s/]") & x.endswith(">"))
    clean = lambda x: F.trim(F.regexp_replace(x, r"[\t\r\n]", ""))
    return F.filter(F.transform(tags, lambda x: clean(target(x))), lambda x: x != "")


def alias_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(a, b): node of a page and node of an address it redirects to or names as canonical, for every such tag.

    References to characters are read and relative addresses resolved against the
    page's.  An address with dot segments is joined to its resolved form too, since a
    page may bear it either way.  Addresses that cannot name a page (``mailto:`` and the
    like) give no edge.
    """
    url, html = F.col(url_col), F.col(html_col)
    tags = pages.where(html.isNotNull()).select(url.alias("url"), F.explode(tag_targets(html)).alias("to"))
    to, url = F.col("to"), F.col("url")
    site = F.concat(F.lit("http://"), host_of(url))
    folder = F.regexp_replace(path_of(url), r"[^/]*$", "")
    full = (
        F.when(to.rlike(SCHEME + "//"), to)
        .when(to.startswith("//"), F.concat(F.lit("http:"), to))
        .when(to.startswith("/"), F.concat(site, to))
        .when(to.startswith("?"), F.concat(site, path_of(url), to))
        .when(to.startswith("#") | to.rlike(SCHEME), None)
        .otherwise(F.concat(site, F.when(folder == "", "/").otherwise(folder), to))
    )
    links = tags.where(host_of(url) != "").select(node_of(url).alias("a"), node_of(full).alias("raw"), node_of(without_dots(full)).alias("b"))
    return links.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("raw").alias("a"), "b"))).alias("e")).select("e.*").where("a <> b")


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, host, path, rule, verdict, alias_block) for every row of ``pages``.

    ``verdict`` is the rule's; where no rule fits it is ``block`` if some alias is
    blocked by a rule (``alias_block``), else ``allow``.  Null urls and urls without
    ``://`` have empty host and path and are allowed; null html has no edges.
    Repeated rows are judged each; an empty table gives an empty result; other
    columns are not read.
    """
    linked = connected_components(write_table(alias_edges(pages, url_col, html_col), "alias-edges"))
    cut = r"^([^/?#]*)([^?#]*)"
    decided = linked.withColumn("hit", rule_of(F.regexp_extract("node", cut, 1), F.regexp_extract("node", cut, 2), rules))
    blocked = decided.where("hit.verdict = 'block'").select("root").distinct()
    tainted = decided.join(blocked, "root", "left_semi").select(F.col("node").alias("tainted")).distinct()
    rows = pages.select(
        F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"),
        node_of(F.col(url_col)).alias("node"),
    ).withColumn("hit", rule_of(F.col("host"), F.col("path"), rules))
    return rows.join(tainted, rows["node"] == tainted["tainted"], "left").select(
        "page_id", "host", "path", F.col("hit.rule").alias("rule"),
        F.coalesce("hit.verdict", F.when(F.col("tainted").isNotNull(), "block").otherwise("allow")).alias("verdict"),
        (F.col("hit").isNull() & F.col("tainted").isNotNull()).alias("alias_block"),
    )
