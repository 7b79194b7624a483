"""Block and allow rules for URLs, carried over redirects and canonical links."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import components, settle

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Query parts that name where a visitor came from, and no other page.
_TRACKING = r"(?:utm_[a-z]+|ref|fbclid|gclid)=[^&]*"


@dataclass(frozen=True)
class Rule:
    """``verdict`` for the urls of ``host`` and its subdomains whose path starts with ``path``."""

    verdict: str
    host: str
    path: str


def _part(url: Column, group: int) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", group), F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to a slash, ``?`` or ``#``; A-Z in lower case, else empty."""
    return F.translate(_part(url, 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``."""
    return _part(url, 2)


def canonical(url: Column) -> Column:
    """Another spelling of the same page: no scheme, fragment, tracking or last slash."""
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(query, rf"(?:^|&){_TRACKING}(?=&|$)", "")
    query = F.regexp_replace(query, "^&", "")
    path = F.regexp_replace(path_of(url), "/$", "")
    return F.concat(F.lit("page://"), host_of(url), path,
                    F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))


def _absolute(link: Column, url: Column) -> Column:
    """A link as it stands in the page of ``url``, with scheme and host."""
    scheme = F.regexp_extract(url, r"(?s)^(.*?)://", 1)
    site = F.concat(scheme, F.lit("://"), _part(url, 1))
    folder = F.regexp_replace(path_of(url), "[^/]*$", "")
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(site, link))
        .when(link.rlike("^[?#]"), F.concat(site, path_of(url), link))
        .when(link != "", F.concat(site, F.when(folder == "", "/").otherwise(folder), link))
    )


def page_targets(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with ``link`` and ``refresh``: where a page's canonical link and its refresh go.

    The tags are cut out once, in one walk over the page that never turns back; each is then
    looked at by itself. Null where there is none.
    """
    tags = F.regexp_extract_all(F.col(html), F.lit(r"(?is)<(?:link|meta)\b[^>]*+"), F.lit(0))

    def target(tag: str, mark: str, place: str) -> Column:
        fits = F.filter("_tags", lambda t: (
            F.lower(F.substr(t, F.lit(2), F.lit(4))) == tag) & t.rlike(mark) & t.rlike(place))
        return F.regexp_extract(F.get(fits, F.lit(0)), place, 1)

    return pages.withColumn("_tags", tags).select(
        *pages.columns,
        target("link", r"""(?is)\brel\s*+=\s*+["']?canonical\b""",
               r"""(?is)\bhref\s*+=\s*+["']?([^"'\s>]+)""").alias("link"),
        target("meta", r"""(?is)\bhttp-equiv\s*+=\s*+["']?refresh\b""",
               r"""(?is)\burl\s*+=\s*+["']?([^"'\s>]+)""").alias("refresh"),
    )


def fitting_rules(urls: DataFrame, rules: list[Rule]) -> DataFrame:
    """``urls`` (``url``) with ``host``, ``path``, and the longest rule that fits, or null.

    Each distinct host is joined to the rules of its own name and of the domains
    above it; the url then takes the longest of them that its path fits. So the
    work follows the hosts' depth and not the number of rules.
    """
    spark = urls.sparkSession
    table = spark.createDataFrame(
        [(r.host, r.path, r.verdict) for r in rules], "domain string, start string, verdict string"
    ).distinct()
    parsed = urls.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    labels = F.split("host", r"\.")
    above = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    of_host = settle(
        parsed.select("host").distinct()
        .select("host", F.explode(above).alias("domain"))
        .join(table, "domain")
        .groupBy("host")
        .agg(F.collect_list(F.struct(
            F.length(F.concat("domain", "start")).alias("size"),
            F.concat("domain", "start").alias("rule"), "start", "verdict",
        )).alias("rules")),
        "host-rules",
    )
    fitting = F.filter("rules", lambda r: F.startswith(F.col("path"), r["start"]))
    best = F.array_max(fitting)
    return parsed.join(of_host, "host", "left").select(
        *urls.columns, "host", "path", best["rule"].alias("rule"),
        best["verdict"].alias("rule_verdict"),
    )


def judge(pages: DataFrame, rules: list[Rule], redirects: DataFrame | None = None,
          page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` of every page.

    A fitting rule decides. Any other url takes the verdict of its equivalents:
    urls joined by redirects (``redirects`` with ``from_url`` and ``to_url``, and
    refreshes in pages), by canonical links, and by spelling (see ``canonical``),
    whether they have a page or not. One allow rule among them allows it, else one
    block rule blocks it, else it is allowed. A null url has neither host nor
    equivalents and is allowed. Repeated pages stay repeated.
    """
    plain = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
                         F.col(f"`{html}`").cast("string").alias("html"))
    own = settle(page_targets(plain).select("page_id", "url", F.array_compact(F.array(
        *[_absolute(F.col(c), F.col("url")) for c in ("link", "refresh")])).alias("targets")), "page-links")
    hops = own.select(F.col("url").alias("a"), F.explode("targets").alias("b"))
    if redirects is not None:
        hops = hops.union(redirects.select("from_url", "to_url"))
    hops = hops.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    named = own.select("url").union(hops.select("a")).union(hops.select("b"))
    named = settle(named.where(F.col("url").isNotNull()).distinct(), "urls")
    judged = settle(
        fitting_rules(named, rules).withColumn("node", F.unhex(F.md5("url"))), "judged-urls"
    )
    digest = lambda c: F.unhex(F.md5(c))
    edges = judged.select(
        F.col("node").alias("a"), digest(canonical(F.col("url"))).alias("b")
    ).union(hops.select(digest(F.col("a")), digest(F.col("b"))))
    roots = settle(components(edges, "equivalents"), "url-roots")
    voiced = judged.where(F.col("rule_verdict").isNotNull()).select(
        "node", (F.col("rule_verdict") == "allow").alias("allows")
    )
    votes = voiced.join(roots, "node").groupBy("root").agg(F.max("allows").alias("allows"))
    inherited = settle(
        roots.join(votes.hint("rebalance"), "root").select("node", "allows"), "inherited"
    )
    open_urls = judged.where(F.col("rule_verdict").isNull()).select("url", "node").join(
        inherited, "node").select("url", "allows")
    verdicts = settle(
        judged.join(open_urls.hint("rebalance"), "url", "left").select(
            "url", "rule",
            F.coalesce("rule_verdict", F.when(~F.col("allows"), "block"), F.lit("allow"))
            .alias("verdict"),
        ), "url-verdicts",
    )
    return own.join(verdicts, "url", "left").select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
        "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"),
    )
