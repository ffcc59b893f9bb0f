"""URL filters with redirect equivalence.

A rule is a host and a path; it fits a url whose host is that host or below it and whose
path starts with that path. The longest fitting rule decides (allow before block among
equally long ones). A url without a rule shares the decision of its aliases: redirects
(meta refresh), canonical links and the url's own canonical spelling are edges, their
connected components are aliases of each other, and a component with a blocked member is
blocked unless a member is explicitly allowed. Urls that only edges name take part too.

Defined cases: a null url, or one without ``://``, has empty host and path, no rule, no
aliases and the default verdict; repeated rows are judged each; an empty table gives no
rows; null or empty html has no links; other columns are ignored. Long pages are searched
as a whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eddy.llm.components import components
from eddy.llm.scratch import Scratch


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    allow: bool

    @property
    def name(self) -> str:
        return self.host + self.path


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to / ? # or the end, A-Z lower-cased. Path: from
    there up to ? # or the end. Both are empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return _ascii_lower(host), F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)


def rule_for(host: Column, path: Column, rules: list[Rule]) -> Column:
    """(name, allow) of the longest fitting rule, null if none fits."""
    out = F.lit(None).cast("struct<name:string,allow:boolean>")
    for r in sorted(rules, key=lambda r: (len(r.name), r.allow, r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.name).alias("name"), F.lit(r.allow).alias("allow"))).otherwise(out)
    return out


def canonical(url: Column) -> Column:
    """The url's canonical spelling: https, host without ``www.`` or ``m.``, no fragment,
    no tracking parameters (utm_*, ref), no slash at the end."""
    host, path = host_and_path(url)
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike("^(utm_|ref=|ref$)"))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit(""))
    bare = F.regexp_replace(host, r"^(www|m)\.", "")
    return F.when(host != "", F.concat(F.lit("https://"), bare, F.regexp_replace(path, "/+$", ""), tail))


def linked(url: Column, html: Column) -> Column:
    """Targets of the page's canonical links and meta refreshes, as absolute urls."""
    tags = F.regexp_extract_all(html, F.lit(r"(?is)<(?:link|meta)\s[^>]*>"), F.lit(0))
    canon = F.filter(tags, lambda t: t.rlike(r"""(?is)^<link\s.*\brel\s*=\s*["']?canonical\b"""))
    moved = F.filter(tags, lambda t: t.rlike(r"""(?is)^<meta\s.*\bhttp-equiv\s*=\s*["']?refresh\b"""))
    href = F.concat(
        F.transform(canon, lambda t: F.regexp_extract(t, r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)""", 1)),
        F.transform(moved, lambda t: F.regexp_extract(t, r"""(?is)\burl\s*=\s*["']?([^"'\s>;]+)""", 1)))
    scheme = F.regexp_extract(url, r"^[^:]*:", 0)
    site = F.regexp_extract(url, r"^[^:]*://[^/?#]*", 0)
    folder = F.regexp_replace(F.regexp_extract(url, r"^[^:]*://[^?#]*", 0), r"(?<![/:])/[^/]*$", "")

    def absolute(h: Column) -> Column:
        return (F.when(h.contains("://"), h).when(h.startswith("//"), F.concat(scheme, h))
                .when(h.startswith("/"), F.concat(site, h)).otherwise(F.concat(folder, F.lit("/"), h)))

    return F.transform(F.filter(href, lambda h: h != ""), absolute)


def judge(pages: DataFrame, rules: list[Rule], spark: SparkSession, id_col: str = "page_id", url_col: str = "url",
          html_col: str | None = "html", more_edges: DataFrame | None = None, default: str = "allow") -> DataFrame:
    """One row per page: id, host, path, rule, verdict, inherited (whether the verdict is
    the aliases'). ``more_edges`` (src, dst: urls) adds known redirects."""
    scratch = Scratch(spark, "urls")
    url = F.col(url_col)
    targets = F.array(canonical(url))
    if html_col is not None:
        targets = F.concat(targets, F.coalesce(linked(url, F.col(html_col)), F.array().cast("array<string>")))
    edges = (pages.where(F.instr(url, "://") > 0)
             .select(url.alias("src"), F.explode(targets).alias("dst")))
    if more_edges is not None:
        edges = edges.unionAll(more_edges.select("src", "dst"))
    edges = edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull() & (F.col("src") != F.col("dst")))
    edges = edges.unionAll(edges.select(F.col("dst").alias("src"), canonical(F.col("dst")).alias("dst"))
                           .where(F.col("dst").isNotNull() & (F.col("src") != F.col("dst"))))

    def side(c: str) -> Column:
        rule = rule_for(*host_and_path(F.col(c)), rules)
        return F.struct(F.xxhash64(c).alias("node"), rule["allow"].alias("allow"))

    known = scratch.table(edges.select(side("src").alias("a"), side("dst").alias("b")).distinct(), "known")
    labels = components(known.select(F.col("a.node").alias("u"), F.col("b.node").alias("v")), scratch)
    ruled = (known.select("a.*").unionAll(known.select("b.*")).where(F.col("allow").isNotNull()).distinct())
    decided = scratch.table(
        labels.join(ruled, "node").groupBy("root").agg(F.max("allow").alias("allow")), "decided")
    shared = scratch.table(labels.join(decided, "root").select("node", "allow"), "shared")
    host, path = host_and_path(url)
    own = pages.select(F.col(id_col).alias("_id"), host.alias("host"), path.alias("path"),
                       F.when(F.instr(url, "://") > 0, F.xxhash64(url_col)).alias("node"))
    own = own.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules))
    word = lambda c: F.when(c, F.lit("allow")).when(~c, F.lit("block"))
    return (own.join(shared.withColumnRenamed("allow", "shared"), "node", "left")
            .select(F.col("_id").alias(id_col), "host", "path", F.col("rule.name").alias("rule"),
                    F.coalesce(word(F.col("rule.allow")), word(F.col("shared")), F.lit(default)).alias("verdict"),
                    (F.col("rule").isNull() & F.col("shared").isNotNull()).alias("inherited")))
