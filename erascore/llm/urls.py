"""URL filtering with redirect equivalence.

A url is judged by the longest rule that fits its host (or a parent domain) and begins its path. Decisions spread along
aliases: redirect and canonical-link edges join urls into components (distributed connected components); a url without
a rule of its own takes its component's decision. Allow has precedence: a component in which any url is allowed
explicitly allows its undecided urls, else one in which any is blocked blocks them, else the default holds. A url's
own rule always stands.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there up to ``?``, ``#``
or the end. A url's node is scheme, host and the rest without its fragment, which names no other resource. Targets of links and redirects may be relative: they are resolved against the page's ``<base>`` or url.

Defined cases: a null url, or one without ``://``, has empty host and path, fits no rule, is no node and gets the default;
repeated rows are judged each; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import connected_components, staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)
_AFTER = r"(?s)^.*?://"


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once, however often ``f`` names it: a column that is put into an expression several times is
    copied there each time, and copies of copies make plans and generated code too large for the driver."""
    return F.element_at(F.transform(F.array(value), f), 1)


def after_scheme(url: Column) -> Column:
    return F.when(F.contains(url, F.lit("://")), F.regexp_replace(url, _AFTER, "")).otherwise(F.lit(""))


def _host(rest: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def _path(rest: Column) -> Column:
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def host_of(url: Column) -> Column:
    return _host(after_scheme(url))


def path_of(url: Column) -> Column:
    return _path(after_scheme(url))


def node_of(url: Column) -> Column:
    """The url without its fragment, scheme and host lower-cased; null where it has no host."""

    def node(u: Column) -> Column:
        scheme = F.translate(F.regexp_extract(u, r"(?s)^(.*?)://", 1), UPPER, LOWER)
        return bound(after_scheme(u), lambda rest: bound(_host(rest), lambda host: F.when(host != "", F.concat(
            scheme, F.lit("://"), host, bound(F.regexp_extract(rest, r"^[^/?#]*([^#]*)", 1), lambda tail: F.when(tail == "", "/").otherwise(tail))))))

    return bound(url, node)


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The longest rule that fits, as a struct of rule and verdict; null where none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):  # the last that fits is the longest
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        out = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def resolved(target: Column, base: Column) -> Column:
    """The url that ``target`` names on a page at ``base``; null where it is empty or of a scheme without ``://``."""
    return bound(target, lambda t: bound(base, lambda b: _resolved(t, b)))


def _resolved(target: Column, base: Column) -> Column:
    scheme, host = F.regexp_extract(base, r"(?s)^(.*?)://", 1), F.regexp_extract(after_scheme(base), r"^[^/?#]*", 0)
    origin = F.concat(scheme, F.lit("://"), host)
    tail = F.regexp_extract(target, r"^[^?#]*(.*)$", 1)

    def on_path(path: Column) -> Column:
        full = F.when(F.startswith(path, F.lit("/")), path).otherwise(F.concat(F.regexp_extract(F.concat(F.lit("/"), F.regexp_replace(path_of(base), "^/", "")), "^.*/", 0), path))
        # a last . or .. stands for a folder
        parts = F.split(F.regexp_replace(F.substr(full, F.lit(2)), r"(^|/)(\.\.?)$", "$1$2/"), "/")
        kept = F.aggregate(parts, F.array().cast("array<string>"), lambda acc, x: F.when(x == ".", acc).when(
            x == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.concat(acc, F.array(x))))
        return F.when(path == "", F.concat(origin, path_of(base), tail)).otherwise(F.concat(origin, F.lit("/"), F.array_join(kept, "/"), tail))

    return (F.when((target == "") | (host_of(base) == "") & ~F.rlike(target, F.lit("^[A-Za-z][A-Za-z0-9+.-]*://")), F.lit(None).cast("string"))
            .when(F.rlike(target, F.lit("^[A-Za-z][A-Za-z0-9+.-]*://")), target)
            .when(F.rlike(target, F.lit("^[A-Za-z][A-Za-z0-9+.-]*:")), F.lit(None).cast("string"))
            .when(F.startswith(target, F.lit("//")), F.concat(scheme, F.lit(":"), target))
            .when(F.startswith(target, F.lit("#")), base)
            .otherwise(bound(F.regexp_extract(target, r"^[^?#]*", 0), on_path)))


def link_edges(pages: DataFrame) -> DataFrame:
    """(a, b): the node of each page and the nodes that its canonical links and refresh redirects name."""
    quoted = r"\"(?:[^\">]*\s)?canonical(?:\s[^\">]*)?\"|'(?:[^'>]*\s)?canonical(?:\s[^'>]*)?'"
    tag = rf"(?is)<(?:link\b[^>]*\brel\s*=\s*(?:{quoted}|canonical(?=[\s/>]))[^>]*|meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*)>"
    # a refresh may leave out url=
    delay = r"\bcontent\s*=\s*[\"']?\s*[\d.]+\s*[;,]\s*[\"']?\s*(?!url\s*=|[\"'\s])"
    html, url = F.col("html").cast("string"), F.col("url")
    low = F.lower(html)
    tags = F.when(F.contains(low, F.lit("canonical")) | F.contains(low, F.lit("http-equiv")), F.regexp_extract_all(html, F.lit(tag), F.lit(0)))
    based = F.when(F.contains(low, F.lit("<base")), F.regexp_extract(html, r"(?is)<base\b[^>]*\bhref\s*=\s*[\"']?\s*([^\"'\s>]+)", 1)).otherwise("")

    def named(found: Column) -> Column:
        refresh = F.regexp_extract(found, rf"(?is)(?:\burl\s*=\s*[\"']?\s*|{delay})([^\"'\s>]+)", 1)
        href = F.regexp_extract(found, r"(?is)\bhref\s*=\s*[\"']?\s*([^\"'\s>]+)", 1)
        return F.when(F.rlike(found, F.lit("(?i)^<link")), href).otherwise(refresh)

    def ends(found: Column) -> Column:
        base = F.coalesce(resolved(based, url), url)
        targets = bound(base, lambda b: F.transform(found, lambda t: node_of(resolved(named(t), b))))
        return bound(node_of(url), lambda a: F.transform(F.filter(targets, lambda b: a.isNotNull() & b.isNotNull() & (a != b)), lambda b: F.struct(a.alias("a"), b.alias("b"))))

    # outer: a filter on the rows generated stays above them, where one on the array would compute it once more
    return pages.select(F.inline_outer(bound(tags, lambda found: F.when(F.size(found) > 0, ends(found))))).where("a IS NOT NULL")


def judge(urls: DataFrame, edges: DataFrame, rules: tuple[Rule, ...] = RULES, default: str = "allow") -> DataFrame:
    """``urls`` (page_id, url) with host, path, rule and verdict; ``edges`` (a, b) join nodes of ``node_of``."""
    parts = urls.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), node_of(F.col("url")).alias("node"))
    own = staged(parts.withColumn("own", rule_of(F.col("host"), F.col("path"), rules)), "url-rules")
    classes = staged(connected_components(edges), "url-classes")
    # urls outside of any class need no join partner; the class's nodes that are no page of ours count by their own rules
    named = classes.select("node", "label", rule_of(host_of(F.col("node")), path_of(F.col("node")), rules)["verdict"].alias("verdict"))
    decided = named.groupBy("label").agg(
        F.max(F.when(F.col("verdict") == "allow", 1).otherwise(0)).alias("allowed"),
        F.max(F.when(F.col("verdict") == "block", 1).otherwise(0)).alias("blocked"))
    spread = F.when(F.col("allowed") == 1, "allow").when(F.col("blocked") == 1, "block").otherwise(default)
    taken = classes.join(decided, "label").select(F.col("node").alias("alias"), spread.alias("spread"))
    return own.join(taken, F.col("node") == F.col("alias"), "left").select(
        "page_id", "host", "path", F.col("own.rule").alias("rule"),
        F.coalesce("own.verdict", "spread", F.lit(default)).alias("verdict"))


def url_report(pages: DataFrame) -> DataFrame:
    rows = pages.select(F.col("page_id"), F.col("url").cast("string").alias("url"), F.col("html"))
    # written, as components read their edges more than once
    return judge(rows.select("page_id", "url"), staged(link_edges(rows).distinct(), "url-links"))
