"""Allow and block rules for URLs, carried over redirects and canonical links.

A rule names a host and a path start; it fits the host, all its subdomains and
all paths that begin so, and the longest fitting rule decides. Pages and the
targets of their canonical links and refresh redirects form a graph; inside a
connected component an allowed URL allows, else a blocked URL blocks, the URLs
that no rule fits. Everything else is allowed.

Defined cases: a null URL, or one without ``://``, has empty host and path, is
fitted by no rule and linked with nothing; of two equally long rules that fit,
allow wins; repeated pages get the same verdict each; an empty table gives no
rows; columns other than the id, url and html are not read.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import ascii_lower, let
from basketlens.llm.components import components
from basketlens.sources.staging import Workspace

AFTER_SCHEME = r"://([^/?#]*)([^?#]*)"
#: A name and a value of a tag; a name without a value is passed over.
ATTRIBUTE = r"""([^\s"'<>/=]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
#: References to characters as attributes have them, and the text between them.
REFERENCE = r"&#[xX][0-9a-fA-F]+;?|&#[0-9]+;?|&[A-Za-z][A-Za-z0-9]*;|&[A-Za-z][A-Za-z0-9]*(?![A-Za-z0-9=])|&|[^&]+"
DOTS = r"\.|%2[eE]"


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str = ""


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), AFTER_SCHEME, 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), AFTER_SCHEME, 2)


def node_of(url: Column) -> Column:
    """What identifies a URL in the graph: no scheme, no fragment, host in lower case, path without dots, at least ``/``."""
    return F.when(host_of(url) != "", F.concat(host_of(url), without_dots(path_of(url)), query_of(url)))


def query_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^?#]*://[^?#]*(\?[^#]*)", 1)


def without_dots(path: Column) -> Column:
    """``/a/./b/../c`` as ``/a/c``, an empty path as ``/``."""

    def walked(steps: Column) -> Column:
        back = F.aggregate(
            steps,
            F.array().cast("array<string>"),
            lambda kept, step: F.when(step.rlike(f"^(?:{DOTS}){{2}}$"), F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0))))
            .when(step.rlike(f"^(?:{DOTS})$"), kept)
            .otherwise(F.concat(kept, F.array(step))),
        )
        ends_in_dots = F.element_at(steps, -1).rlike(f"^(?:{DOTS}){{1,2}}$")
        return F.concat(F.lit("/"), F.array_join(F.when(ends_in_dots, F.concat(back, F.array(F.lit("")))).otherwise(back), "/"))

    dotted = path.rlike(f"/(?:{DOTS}){{1,2}}(?:/|$)")
    return F.when(path == "", "/").when(dotted, let(F.split(F.substr(path, F.lit(2)), "/", -1), walked)).otherwise(path)


def rule_table(documents: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    rows = [(r.host.lower(), r.path, r.verdict) for r in rules]
    schema = "rule_host string, rule_path string, rule_verdict string"
    return documents.sparkSession.createDataFrame(rows, schema)


def ruled(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, ruling) for the distinct hosts and paths that a rule fits."""
    places = urls.select("host", "path").where(F.col("host") != "").distinct()
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."),
    )
    fitting = (
        places.select("host", "path", F.explode(suffixes).alias("rule_host"))
        .join(rules, "rule_host")
        .where(F.startswith("path", "rule_path"))
    )
    text = F.concat("rule_host", "rule_path")
    best = F.max(F.struct(
        F.length(text).alias("length"), (F.col("rule_verdict") == "allow").alias("allow"),
        text.alias("rule"), F.col("rule_verdict").alias("ruling"),
    ))
    return fitting.groupBy("host", "path").agg(best.alias("best")).select(
        "host", "path", "best.rule", "best.ruling"
    )


def _character(reference: Column) -> Column:
    """The character that a numeric reference stands for."""
    hexadecimal = reference.rlike("^&#[xX]")
    digits = F.regexp_replace(F.regexp_replace(reference, "^&#[xX]?0*", ""), ";$", "")
    code = F.when(F.length(digits) > 7, "0").when(digits == "", "0").when(
        hexadecimal, F.conv(digits, 16, 10)
    ).otherwise(digits).cast("int")
    known = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    # 128 to 159 are read as Windows-1252, in which five are unused.
    windows = "".join(bytes([c]).decode("cp1252", "ignore") or chr(c) for c in range(128, 160))
    return F.when(code.between(128, 159), F.substring(F.lit(windows), code - 127, F.lit(1))).otherwise(
        F.decode(F.unhex(F.lpad(F.hex(F.when(known, code).otherwise(0xFFFD)), 8, "0")), "UTF-32")
    )


def unescaped(value: Column) -> Column:
    """An attribute's value with its references to characters read."""
    names = F.from_json(F.lit(json.dumps(html5)), "map<string,string>")
    pieces = F.regexp_extract_all(value, F.lit(REFERENCE), F.lit(0))
    read = F.transform(
        pieces,
        lambda p: F.when(p.rlike("^&#."), _character(p))
        .when(F.startswith(p, F.lit("&")), F.coalesce(F.element_at(names, F.substr(p, F.lit(2))), p))
        .otherwise(p),
    )
    return F.when(F.contains(value, F.lit("&")), F.array_join(read, "")).otherwise(value)


def _attribute(tag: Column, name: str) -> Column:
    """The first value of that name, empty if there is none."""
    names = F.transform(F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(1)), ascii_lower)
    values = F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(2))
    value = F.coalesce(F.get(values, F.array_position(names, name).cast("int") - 1), F.lit(""))
    inner = F.regexp_replace(value, r"""(?s)^(["'])(.*)\1$""", "$2")
    return F.btrim(unescaped(inner), F.lit(" \t\n\r\f"))


def resolved(link: Column, base: Column) -> Column:
    """A link found under the URL ``base`` as a whole URL; null if it names no host."""
    site = F.concat(F.lit("x://"), host_of(base))
    path = F.when(path_of(base) == "", "/").otherwise(path_of(base))
    return (
        F.when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None).cast("string"))
        .when(F.startswith(link, F.lit("//")), F.concat(F.lit("x:"), link))
        .when(F.startswith(link, F.lit("/")), F.concat(site, link))
        .when(F.startswith(link, F.lit("?")), F.concat(site, path, link))
        .when(link.rlike("^(?:#|$)"), F.concat(site, path, query_of(base)))
        .otherwise(F.concat(site, F.regexp_replace(path, "[^/]*$", ""), link))
    )


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Canonical links and refresh redirects of pages as edges (a, b) between graph nodes."""
    tags = F.regexp_extract_all(F.col(html), F.lit(r"(?is)<(?:link|meta|base)\b[^>]*>"), F.lit(0))
    bases = F.filter("tags", lambda t: t.rlike("(?i)^<base") & (_attribute(t, "href") != ""))
    linked = (
        pages.where(F.col(html).rlike("(?i)canonical|http-equiv"))
        .select(F.col(url).alias("url"), tags.alias("tags"))
        .select("url", "tags", _attribute(F.coalesce(F.get(bases, F.lit(0)), F.lit("")), "href").alias("start"))
        .select("url", "start", F.explode("tags").alias("tag"))
    )
    relations = F.split(ascii_lower(_attribute(F.col("tag"), "rel")), r"\s+")
    canonical = linked.where(F.col("tag").rlike("(?i)^<link") & F.array_contains(relations, "canonical")).select(
        "url", "start", _attribute(F.col("tag"), "href").alias("to")
    )
    seconds_and_url = r"(?is)^[\d.\s]*[;,]\s*url\s*=\s*['\"]?(.*?)['\"]?\s*$"
    refreshing = F.col("tag").rlike("(?i)^<meta") & (ascii_lower(_attribute(F.col("tag"), "http-equiv")) == "refresh")
    refresh = linked.where(refreshing).select(
        "url", "start", F.regexp_extract(_attribute(F.col("tag"), "content"), seconds_and_url, 1).alias("to")
    )
    links = canonical.union(refresh).where(F.col("to") != "").distinct()
    base = F.coalesce(F.when(F.col("start") != "", resolved(F.col("start"), F.col("url"))), F.col("url"))
    based = links.select("url", "to", base.alias("base"))
    whole = based.select("url", resolved(F.col("to"), F.col("base")).alias("to")).distinct()
    return whole.select(node_of(F.col("url")).alias("a"), node_of(F.col("to")).alias("b"))


def url_verdicts(
    pages: DataFrame, rules: Sequence[Rule], key: str = "page_id", url: str = "url",
    html: str = "html", links: DataFrame | None = None,
) -> DataFrame:
    """Key, host, path, rule and verdict of every page.

    ``links`` may bring a table of redirects (a, b: URLs) beside those in the pages.
    """
    space = Workspace(pages.sparkSession, "url-rules")
    rows = pages.select(
        F.col(key), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"),
        node_of(F.col(url)).alias("node"),
    )
    # Written, as the filters of the rounds would else repeat all that reads a link.
    edges = space.save(page_links(pages, url, html), "links")
    if links is not None:
        edges = edges.union(links.select(node_of(F.col("a")), node_of(F.col("b"))))
    parts = components(edges, space)
    by_rule = space.save(ruled(rows, rule_table(pages, rules)), "ruled")

    places = F.concat(F.lit("x://"), F.col("node"))
    members = parts.select("node", "component", host_of(places).alias("host"), path_of(places).alias("path"))
    decided = (
        members.join(ruled(members, rule_table(pages, rules)), ["host", "path"])
        .groupBy("component")
        .agg(F.max((F.col("ruling") == "allow").cast("int")).alias("allowed"))
    )
    aliases = parts.join(decided, "component").select(
        "node", F.when(F.col("allowed") == 1, "allow").otherwise("block").alias("inherited")
    )
    return (
        rows.join(by_rule, ["host", "path"], "left")
        .join(aliases, "node", "left")
        .select(
            key, "host", "path", "rule",
            F.coalesce("ruling", "inherited", F.lit("allow")).alias("verdict"),
        )
    )
