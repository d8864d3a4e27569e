"""URL filter: rules by host and path, carried over redirects and canonical links."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelayers.llm.common import ascii_lower, stored
from lakelayers.llm.components import components


@dataclass(frozen=True)
class UrlRule:
    """Fits the host and all its subdomains if the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"


# The rules of the contract.
RULES = (
    UrlRule("block", "net", "/"),
    UrlRule("allow", "example.net", "/en/"),
    UrlRule("block", "example.com", "/de/"),
    UrlRule("allow", "org", "/fr/"),
)


# Any word of a link's rel.
CANONICAL = r"""(?:"(?:[^">]*\s)?canonical(?:\s[^">]*)?"|'(?:[^'>]*\s)?canonical(?:\s[^'>]*)?'|canonical(?=[\s/>]))"""


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null if there is none."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3))


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[UrlRule, ...] = RULES) -> Column:
    """The longest rule that fits, as ``struct(rule, verdict)``; null if none does."""

    ordered = sorted(rules, key=lambda r: (-len(r.name), r.name))

    def choose(place: Column) -> Column:
        def fits(rule: UrlRule) -> Column:
            inside = (place["host"] == rule.host) | F.endswith(place["host"], F.lit(f".{rule.host}"))
            return inside & F.startswith(place["path"], F.lit(rule.path))

        choices = [F.when(fits(r), F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))) for r in ordered]
        return F.coalesce(*choices, F.lit(None).cast("struct<rule:string,verdict:string>"))

    # The lambda binds host and path once; in line they would be spelt out again for every rule.
    return F.get(F.transform(F.array(F.struct(host.alias("host"), path.alias("path"))), choose), 0)


def _resolved(url: Column) -> Column:
    """The address without the segments ``.`` and ``..`` in its path, which take the one before with them."""

    def walked(whole: Column) -> Column:
        head = F.regexp_extract(whole, r"(?s)^.*?://[^/?#]*", 0)
        path = F.regexp_extract(F.substr(whole, F.length(head) + 1), r"^[^?#]*", 0)
        tail = F.substr(whole, F.length(head) + F.length(path) + 1)
        parts = F.split(path, "/", -1)
        plain = lambda part: F.replace(F.lower(part), F.lit("%2e"), F.lit("."))

        def step(kept: Column, part: Column) -> Column:
            up = F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))
            return F.when(plain(part) == ".", kept).when(plain(part) == "..", up).otherwise(F.array_append(kept, part))

        kept = F.aggregate(F.slice(parts, F.lit(2), F.size(parts)), F.array().cast("array<string>"), step)
        folder = plain(F.element_at(parts, -1)).isin(".", "..") & (F.size(kept) > 0)
        return F.concat(head, F.lit("/"), F.array_join(kept, "/"), F.when(folder, F.lit("/")).otherwise(F.lit("")), tail)

    # The lambda binds the address once.
    dots = url.rlike(r"(?i)/(?:\.|%2e){1,2}(?:[/?#]|$)")
    return F.when(dots, F.get(F.transform(F.array(url), walked), 0)).otherwise(url)


def _place(url: Column) -> Column:
    """What two addresses of one document share: host, path and query, without scheme, fragment and dot segments."""

    def place(whole: Column) -> Column:
        rest = F.regexp_replace(_rest(whole), "#.*$", "")
        host = F.regexp_extract(rest, r"^[^/?]*", 0)
        tail = F.substr(rest, F.length(host) + 1)
        return F.concat(ascii_lower(host), F.when(F.startswith(tail, F.lit("/")), tail).otherwise(F.concat(F.lit("/"), tail)))

    return F.get(F.transform(F.array(_resolved(url)), place), 0)


def _absolute(target: Column, base: Column) -> Column:
    """A link's address, seen from the page ``base``; null if it is empty or has a scheme without ``://``."""
    scheme = F.regexp_extract(base, r"^[^:]*", 0)
    root = F.regexp_extract(base, r"^[^:]*://[^/?#]*", 0)
    folder = F.regexp_extract(base, r"^[^:]*://[^/?#]*(/(?:[^?#]*/)?)?", 0)
    folder = F.when(F.endswith(folder, F.lit("/")), folder).otherwise(F.concat(folder, F.lit("/")))
    document = F.regexp_extract(base, r"^[^:]*://[^?#]*", 0)
    found = (
        F.when(target == "", None)
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(F.startswith(target, F.lit("//")), F.concat(scheme, F.lit(":"), target))
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), None)
        .when(F.startswith(target, F.lit("/")), F.concat(root, target))
        .when(F.startswith(target, F.lit("?")), F.concat(document, target))
        .when(F.startswith(target, F.lit("#")), base)
        .otherwise(F.concat(folder, target))
    )
    return _resolved(found)


def alias_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``url, target``: canonical links and refresh redirects in the whole html of the pages."""
    html = F.col(html_col)
    canonical = F.regexp_extract_all(html, F.lit(rf"(?is)<link\b[^>]*\brel\s*=\s*{CANONICAL}[^>]*>"), F.lit(0))
    refresh = F.regexp_extract_all(html, F.lit(r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"), F.lit(0))
    href = r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
    to = r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)"
    targets = F.concat(
        F.transform(canonical, lambda tag: F.regexp_extract(tag, href, 1)),
        F.transform(refresh, lambda tag: F.regexp_extract(tag, to, 1)),
    )
    whole = F.transform(targets, lambda t: _absolute(F.replace(t, F.lit("&amp;"), F.lit("&")), F.col(url_col)))
    found = pages.filter(html.rlike(r"(?i)canonical|refresh") & F.col(url_col).isNotNull())
    return found.select(F.col(url_col), F.explode(whole)).toDF("url", "target").filter("target IS NOT NULL")


def judge_urls(
    pages: DataFrame,
    redirects: DataFrame | None = None,
    rules: tuple[UrlRule, ...] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page.

    The rule's verdict holds where a rule fits. Another page takes the decision of its aliases: pages and link
    targets that canonical links, refresh redirects or ``redirects(url, target)`` join are one component; it is
    blocked if a member is blocked by a rule and no member is allowed by one, else allowed. Every page is one
    row, repeated rows too. A url that is null or has no ``://`` has empty host and path and no aliases. An empty table
    gives an empty table. Places are told apart by a hash of 64 bits.
    """
    links = alias_links(pages, url_col, html_col)
    if redirects is not None:
        given = redirects.filter("url IS NOT NULL AND target IS NOT NULL")
        links = links.unionByName(given.select("url", _resolved(F.col("target")).alias("target")))
    node = lambda url: F.xxhash64(_place(F.col(url)))
    links = links.filter((F.locate("://", F.col("url")) > 0) & (F.locate("://", F.col("target")) > 0))
    ends = stored(links.select(node("url").alias("a"), node("target").alias("b"), "url", "target"), "aliases")
    joined = components(ends.select("a", "b"))

    judged = pages.select(
        F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"),
        F.when(F.locate("://", F.col(url_col)) > 0, node(url_col)).alias("node"),
    )
    judged = judged.withColumn("own", rule_of(F.col("host"), F.col("path"), rules))
    members = reduce(
        DataFrame.unionByName,
        [
            ends.select(node(c).alias("node"), rule_of(host_of(F.col(c)), path_of(F.col(c)), rules).alias("own"))
            for c in ("url", "target")
        ],
    ).filter("own IS NOT NULL")
    blocked = (
        members.join(joined, "node")
        .groupBy("component")
        .agg(
            F.max((F.col("own.verdict") == "block").cast("int")).alias("block"),
            F.max((F.col("own.verdict") == "allow").cast("int")).alias("allow"),
        )
        .filter("block = 1 AND allow = 0")
        .select("component")
    )
    spread = joined.join(blocked, "component").select("node", F.lit("block").alias("spread"))
    # Only pages without a rule of their own ask their aliases; urls without host, who have none, would meet in one task.
    asks = F.col("own").isNull() & F.col("node").isNotNull()
    asking = judged.filter(asks).join(spread, "node", "left")
    others = judged.filter(~asks).withColumn("spread", F.lit(None).cast("string"))
    verdict = F.coalesce("own.verdict", "spread", F.lit("allow"))
    return asking.unionByName(others).select(
        "page_id", "host", "path", F.col("own.rule").alias("rule"), verdict.alias("verdict")
    )
