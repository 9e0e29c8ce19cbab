"""URL filters with redirect equivalence (operator 10, DataFrame functions only).

Rules name a host (with all its subdomains) and a path prefix; the longest that fits decides.  Pages that no
rule fits take the decision of their aliases: URLs joined by redirects (given edges and meta refresh) or by
canonical links are one component, a blocked URL anywhere in it blocks the rest, and a URL that a rule
explicitly allows keeps the whole component's undecided pages allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import connected_components, materialise, table

RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
MAX_RULES = 1000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.contains(url, F.lit("://")), F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as struct(size, rule, action); null where none does."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules belong in a table joined on host suffixes")
    fits = [
        F.when(
            ((host == h) | host.endswith("." + h)) & path.startswith(p),
            F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(a).alias("action")),
        )
        for a, h, p in rules
    ]
    return F.array_max(F.array_compact(F.array(*fits))) if fits else F.lit(None).cast("struct<size:int,rule:string,action:string>")


def _key(url: Column) -> Column:
    """What makes two spellings one URL: scheme and fragment dropped, host folded."""
    host, path = host_and_path(url)
    query = F.regexp_extract(url, r"^[^?#]*(\?[^#]*)", 1)
    return F.when(host != "", F.concat(host, path, query))


def _without_dots(path: Column) -> Column:
    """A path without its `.` and `..` segments."""
    parts = F.split(path, "/")
    up = lambda found: F.slice(found, 1, F.greatest(F.size(found) - 1, F.lit(1)))
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda found, x: F.when(x == ".", found).when(x == "..", up(found)).otherwise(F.array_append(found, x)))
    whole = F.concat(F.array_join(kept, "/"), F.when(F.element_at(parts, -1).isin(".", ".."), "/").otherwise(""))
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), whole).otherwise(path)


def resolved(target: Column, base: Column) -> Column:
    """The URL that a link `target` names on a page of URL `base`; null where it names none of a host."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*)://", 1)
    host, path = host_and_path(base)
    query = F.regexp_extract(base, r"^[^?#]*(\?[^#]*)", 1)
    root = F.concat(scheme, F.lit("://"), host)
    own = F.regexp_extract(target, r"^[^?#]*", 0)
    rest = F.substr(target, F.length(own) + 1)
    folder = F.when(path == "", "/").otherwise(F.regexp_extract(path, r"^.*/", 0))
    return (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), target)
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), F.lit(None).cast("string"))
        .when((scheme == "") | (host == ""), F.lit(None).cast("string"))
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(root, _without_dots(own), rest))
        .when((target == "") | target.startswith("#"), F.concat(root, path, query))
        .when(target.startswith("?"), F.concat(root, path, target))
        .otherwise(F.concat(root, _without_dots(F.concat(folder, own)), rest))
    )


def link_edges(pages: DataFrame) -> DataFrame:
    """(src_url, dst_url): each page's canonical link and meta refresh, resolved against its `<base>` or its URL."""
    tags = F.regexp_extract_all("html", F.lit(r"(?is)(<(?:link|meta)\b[^>]*>)"), 1)
    canonical = F.filter(tags, lambda t: t.rlike(r"(?is)^<link\b[^>]*\brel\s*=\s*[\"']?canonical\b"))
    refresh = F.filter(tags, lambda t: t.rlike(r"(?is)^<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b"))
    targets = F.concat(
        F.transform(canonical, lambda t: F.regexp_extract(t, r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1)),
        F.transform(refresh, lambda t: F.regexp_extract(t, r"(?is)\burl\s*=\s*[\"']?([^\"'\s>;]+)", 1)),
    )
    based = F.regexp_extract("html", r"(?is)<base\b[^>]*\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1)
    found = pages.where(F.col("html").rlike(r"(?i)canonical|http-equiv")).select(
        F.col("url").alias("src_url"), F.coalesce(resolved(based, F.col("url")), "url").alias("base"), F.explode(targets).alias("target")
    )
    return found.where("target != ''").select("src_url", resolved(F.col("target"), F.col("base")).alias("dst_url"))


def judge_urls(pages: DataFrame, redirects: DataFrame | None = None, rules=RULES) -> DataFrame:
    """One row per row of `pages` (page_id, url, html): host, path, rule and verdict.

    `redirects` (src_url, dst_url) adds hops to the links found in the pages.  A url that is null or has no
    `://` has an empty host and path, no rule and no alias, and is allowed; a null html has no links; repeated
    pages are judged alike; an empty table gives an empty one; other columns are ignored.
    """
    host, path = host_and_path(F.col("url"))
    judged = (
        pages.select("page_id", "url", host.alias("host"), path.alias("path"))
        .withColumn("fit", rule_for(F.col("host"), F.col("path"), rules))
        .withColumn("node", F.xxhash64(_key(F.col("url"))))
    )
    # Written before they become keys: a filter on the keys would else repeat the whole resolution in its plan.
    edges = materialise(link_edges(pages), "page-links")
    if redirects is not None:
        edges = edges.union(redirects.select("src_url", "dst_url"))
    edges = edges.select("src_url", "dst_url", _key(F.col("src_url")).alias("s"), _key(F.col("dst_url")).alias("d"))
    edges = materialise(edges.where("s != d").select("src_url", "dst_url", F.xxhash64("s").alias("src"), F.xxhash64("d").alias("dst")), "links")
    component = connected_components(edges)
    urls = edges.select(F.col("src").alias("node"), F.col("src_url").alias("url")).union(edges.select("dst", "dst_url")).distinct()
    host, path = host_and_path(F.col("url"))
    decided = (
        urls.select("node", rule_for(host, path, rules)["action"].alias("action"))
        .join(component, "node")
        .groupBy("component")
        .agg(
            (F.max(F.when(F.col("action") == "block", 1)).isNotNull() & F.max(F.when(F.col("action") == "allow", 1)).isNull()).alias("blocked")
        )
    )
    aliases = component.join(decided.where("blocked"), "component").select("node", F.lit(True).alias("alias_blocked"))
    return judged.join(aliases, "node", "left").select(
        "page_id",
        "host",
        "path",
        F.col("fit.rule").alias("rule"),
        F.coalesce(F.col("fit.action"), F.when(F.col("alias_blocked"), "block").otherwise("allow")).alias("verdict"),
    )


def op10_url_filters(spark, sf_dir):
    return judge_urls(table(spark, sf_dir, "pages"))


OP10_SQL = """
with recursive split as (
  select page_id, url, html,
         case when contains(url, '://') then substring(url, instr(url, '://') + 3) else '' end as rest
  from pages),
parts as (
  select page_id, url, html, coalesce(regexp_extract(rest, '^[^/?#]*'), '') as raw_host, coalesce(rest, '') as rest from split),
judged as (
  select page_id, url, html, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(substring(rest, length(raw_host) + 1), '^[^?#]*') as path
  from parts),
rules(action, rhost, rpath) as (values ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
ruled as (
  select j.page_id, j.url, j.host, j.path, j.html, r.rhost || r.rpath as rule, r.action,
         row_number() over (partition by j.page_id order by length(r.rhost || r.rpath) desc nulls last) as place
  from judged j left join rules r
    on (j.host = r.rhost or ends_with(j.host, '.' || r.rhost)) and starts_with(j.path, r.rpath))
select page_id, host, path, rule, coalesce(action, 'allow') as verdict
from ruled where place = 1
"""
