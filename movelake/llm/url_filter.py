"""URL filter with redirect equivalence; only DataFrame functions.

Rules name a host (with its subdomains) and a path prefix; the longest rule
that fits decides. Pages that redirect (meta refresh) or name a canonical URL
link two URLs; connected components of these links are aliases. A URL without
a rule of its own takes the decision of its aliases: allowed if any of them is
explicitly allowed, else blocked if any is blocked, else allowed.

Components run distributed (alternating stars); URLs are judged once each,
whatever number of pages share them; rules are broadcast only up to
``most_rules`` of them, else shuffled.

Defined cases: a null URL, or one without ``://``, has empty host and path, no
rule and no aliases. Targets may be absolute, ``//host``, ``/path`` or relative
to the page's directory, with character references; aliases meet whatever the
case of scheme and host and the fragment; other schemes and empty targets link nothing. Of rules
of equal length, allow precedes block, then the smaller text. Repeated rows are
each returned; an empty table gives none.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame, functions as F

from movelake.llm.common import ascii_lower, written
from movelake.llm.components import components

_PARTS = r"(?s)^(.*?)://([^/?#]*)([^?#]*)"
_REL = "|".join(rf"{q}(?:[^{q}>]*\s)?canonical(?:\s[^{q}>]*)?{q}" for q in "\"'") + r"|canonical(?=[\s/>])"
_CANONICAL = rf"(?is)<link\b(?=[^>]*\brel\s*=\s*(?:{_REL}))[^>]*?\bhref\s*=\s*[\"']?([^\"'\s>]+)"
_REFRESH = r"(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b)[^>]*?\burl\s*=\s*[\"']?([^\"'\s>]+)"


def host(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit("")))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 3), F.lit(""))


def resolve(base: Column, target: Column) -> Column:
    """target as an absolute URL; null if it is none."""
    scheme = F.regexp_extract(base, _PARTS, 1)
    site = F.concat(scheme, F.lit("://"), F.regexp_extract(base, _PARTS, 2))
    folder = F.coalesce(F.nullif(F.regexp_extract(F.regexp_extract(base, _PARTS, 3), r"(?s)^(.*/)", 1), F.lit("")), F.lit("/"))
    return (F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), target)
            .when(~base.contains("://") | target.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:|^[#?]|^$"), F.lit(None))
            .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
            .when(target.startswith("/"), F.concat(site, target)).otherwise(F.concat(site, folder, target)))


def unescaped(text: Column) -> Column:
    """text with html's character references decoded."""
    names = F.from_json(F.lit(json.dumps({k[:-1]: v for k, v in html5.items() if k.endswith(";")})), "map<string,string>")

    def decoded(x: Column) -> Column:
        figures, hexed = F.regexp_extract(x, "^&#([0-9]{1,7});$", 1), F.regexp_extract(x, "^&#[xX]([0-9A-Fa-f]{1,6});$", 1)
        code = F.when(figures != "", figures.cast("int")).when(hexed != "", F.conv(hexed, 16, 10).cast("int"))
        code = F.when((code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF), code)
        sign = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.coalesce(sign, F.element_at(names, F.regexp_extract(x, "^&([A-Za-z][A-Za-z0-9]*);$", 1)), x)

    parts = F.regexp_extract_all(text, F.lit(r"(?s)(&#?[A-Za-z0-9]+;|&|[^&]+)"), F.lit(1))
    return F.when(text.contains("&"), F.array_join(F.transform(parts, decoded), "")).otherwise(text)


def node(url: Column) -> Column:
    """The URL as aliases meet: scheme and host lower-cased, fragment cut; others unchanged."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(url.contains("://"), F.concat(ascii_lower(F.regexp_extract(url, _PARTS, 1)), F.lit("://"), host(url), rest)).otherwise(url)


def alias_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(a, b): a page's URL and each redirect or canonical target in its html."""
    found = F.concat(F.regexp_extract_all(html_col, F.lit(_CANONICAL), F.lit(1)), F.regexp_extract_all(html_col, F.lit(_REFRESH), F.lit(1)))
    targets = pages.where(F.col(html_col).rlike("(?i)canonical|refresh")).select(F.col(url_col).alias("a"), F.explode(F.transform(found, unescaped)).alias("t"))
    return targets.select("a", resolve(F.col("a"), F.col("t")).alias("b")).where("b is not null")


def judge(urls: DataFrame, rules: DataFrame, most_rules: int = 100_000) -> DataFrame:
    """Distinct url with rule and its verdict (null where none fits)."""
    listed = rules.select(F.lower(F.substring_index("rule", "/", 1)).alias("rule_host"),
                          F.expr("substring(rule, instr(rule, '/'))").alias("rule_path"), "rule", F.col("verdict").alias("rule_verdict"))
    listed = F.broadcast(listed) if rules.limit(most_rules + 1).count() <= most_rules else listed
    labels = F.split("h", r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    tried = (urls.distinct().select("url", host(F.col("url")).alias("h"), path(F.col("url")).alias("p"))
             .select("url", "p", F.explode(above).alias("rule_host")))
    fits = tried.join(listed, "rule_host").where(F.col("p").startswith(F.col("rule_path")))
    best = F.max(F.struct(F.length("rule").alias("n"), (F.col("rule_verdict") == "allow").alias("allow"), "rule", "rule_verdict"))
    return fits.groupBy("url").agg(best.alias("best")).select("url", "best.rule", F.col("best.rule_verdict").alias("own"))


def filter_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                links: DataFrame | None = None) -> DataFrame:
    """id, url, host, path, rule, verdict per page. ``links`` (a, b) adds known
    redirects, such as a crawl log's, to those in the pages."""
    edges = alias_links(pages, url_col, html_col)
    if links is not None:
        edges = edges.unionByName(links.select("a", "b"))
    edges = edges.select(node(F.col("a")).alias("a"), node(F.col("b")).alias("b"))
    roots = components(written(edges, "url-links"))  # else each use of a and b repeats the whole expression
    given = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("given"), node(F.col(url_col)).alias("url"))  # rules see no case of hosts and no fragment
    own = written(judge(given.select("url").where("url is not null").unionByName(roots.select(F.col("node").alias("url")))
                        .unionByName(roots.select(F.col("root").alias("url"))), rules), "url-rules")
    members = roots.unionByName(roots.select(F.col("root").alias("node"), "root")).distinct()
    groups = (members.join(own, members["node"] == own["url"]).groupBy("root")
              .agg(F.max(F.col("own") == "allow").alias("any_allow")))  # members without a rule decide nothing
    passed = members.join(groups, "root").select(F.col("node").alias("url"), "any_allow")
    out = given.join(own, "url", "left").join(passed, "url", "left")
    verdict = F.coalesce("own", F.when(~F.col("any_allow"), "block").otherwise("allow"))
    return out.select("id", F.col("given").alias("url"), host(F.col("given")).alias("host"), path(F.col("given")).alias("path"), "rule", verdict.alias("verdict"))
