"""URL rules with decisions that spread over redirects and canonical links.

A rule names a host, with all its subdomains, and the start of a path; the longest that fits a URL
decides. URLs that are one page, by redirect, canonical link or the rewriting that web servers do, form
a component. A URL without a rule takes the decision of its component: allow if a rule allows any URL of it,
else block if a rule blocks any, else allow. Pages that carry the same article have one canonical URL too, whether
or not they name it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewsieve.llm.common import join_unique, join_written
from reviewsieve.llm.components import connected_components
from reviewsieve.session import WrittenTable, write_once

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPLIT = "(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the registered query.
RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _SPLIT, 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _SPLIT, 2)


def rewritten(url: Column) -> Column:
    """The form to which servers commonly redirect: https, no www. or m., no fragment, tracking, final slash or .html.

    URLs without a host stay as they are.
    """
    host = F.regexp_replace(host_of(url), "^(www|m)\\.", "")
    path = F.regexp_replace(F.regexp_replace(path_of(url), "(/index)?\\.html?$", ""), "/+$", "")
    query = F.regexp_extract(url, "^[^?#]*\\?([^#]*)", 1)
    query = F.regexp_replace(query, "(^|&)(utm_[^=&]*|ref)(=[^&]*)?(?=&|$)", "")
    query = F.regexp_replace(query, "^&+", "")
    return F.when(host == "", url).otherwise(F.concat(F.lit("https://"), host, path, F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query))))


def _without_dots(path: Column) -> Column:
    """A path from the root without its "." and ".." steps."""
    steps = F.split(path, "/")
    # The first step is the empty one before the root's slash; ".." does not go above it.
    up = lambda done: F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))
    taken = F.aggregate(steps, F.array().cast("array<string>"), lambda done, s: F.when(s == "..", up(done)).when(s == ".", done).otherwise(F.concat(done, F.array(s))))
    # A path that ends in such a step is a folder.
    folder = F.element_at(steps, -1).isin(".", "..")
    return F.concat(F.array_join(taken, "/"), F.when(folder, F.lit("/")).otherwise(F.lit("")))


def _resolved(link: Column, base: Column) -> Column:
    """An absolute URL without a fragment, from a link on the page `base`; null if there is none."""
    link = F.regexp_replace(F.regexp_replace(F.trim(link), "&amp;", "&"), "(?s)#.*$", "")
    scheme = F.regexp_extract(base, "(?s)^(.*?)://", 1)
    root = F.concat(scheme, F.lit("://"), host_of(base))
    here = F.when(path_of(base) == "", F.lit("/")).otherwise(path_of(base))
    path, query = F.regexp_extract(link, "(?s)^([^?]*)", 1), F.regexp_extract(link, "(?s)^[^?]*(.*)$", 1)
    folder = F.regexp_extract(here, "(?s)^(.*/)", 1)
    return (
        F.when((link == "") | (host_of(base) == "") & ~link.contains("://"), F.lit(None))
        .when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(path == "", F.concat(root, here, query))
        .otherwise(F.concat(root, _without_dots(F.when(path.startswith("/"), path).otherwise(F.concat(folder, path))), query))
    )


def _attribute(tag: Column, name: str) -> Column:
    return F.coalesce(*[F.nullif(F.regexp_extract(tag, f"(?is)\\b{name}\\s*=\\s*{value}", 1), F.lit("")) for value in ('"([^"]*)"', "'([^']*)'", "([^\\s\"'>]+)")])


def link_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Edges (src, dst) from pages to their canonical URLs and to where they redirect at once."""
    canonical = F.regexp_extract(html_col, "(?is)<link\\b[^>]*\\brel\\s*=\\s*[\"']?canonical\\b[^>]*>", 0)
    refresh = F.regexp_extract(html_col, "(?is)<meta\\b[^>]*\\bhttp-equiv\\s*=\\s*[\"']?refresh\\b[^>]*>", 0)
    target = F.regexp_extract(_attribute(refresh, "content"), "(?is)\\burl\\s*=\\s*['\"]?([^'\"]+)", 1)
    links = pages.select(F.col(url_col).alias("src"), F.explode(F.array(_attribute(canonical, "href"), target)).alias("link"))
    return links.where("link <> '' AND src IS NOT NULL").select("src", _resolved(F.col("link"), F.col("src")).alias("dst")).where("dst IS NOT NULL")


def rewrite_edges(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """Edges (src, dst) from URLs to the form to which servers commonly redirect them."""
    return urls.select(F.col(url_col).alias("src"), rewritten(F.col(url_col)).alias("dst")).where("src <> dst")


def copy_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Edges (src, dst) from each URL to the canonical one of its article: the smallest whose article is the same byte for byte.

    A page's article is what its first <article> holds; pages with none, or an empty one, have no edge. An article that many
    pages carry is one row of a partial aggregation, and one edge for each of its URLs.
    """
    article = F.regexp_extract(F.col(html_col), "(?is)<article\\b[^>]*>(.*?)</article>", 1)
    named = pages.select(F.col(url_col).cast("string").alias("src"), article.alias("article")).where("src IS NOT NULL AND article <> ''")
    homes = write_once(named.select("src", F.unhex(F.sha2("article", 256)).alias("article")), "articles")
    canonical = homes.data.groupBy("article").agg(F.min("src").alias("dst"), F.count("*").alias("n_pages")).where("n_pages > 1")
    canonical = write_once(canonical, "canonical")
    return join_written(homes.data, canonical, "article", "n_pages", homes.rows).where("src <> dst").select("src", "dst")


def alias_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Edges of all kinds between the URLs of `pages` and those that they lead to."""
    leads = link_edges(pages, url_col, html_col).union(copy_edges(pages, url_col, html_col))
    leads = write_once(leads.distinct(), "leads").data
    urls = pages.select(F.col(url_col).cast("string").alias("url")).union(leads.select("dst"))
    return leads.union(rewrite_edges(urls))


def match_rules(urls: DataFrame, rules: Sequence[Rule], url_col: str = "url") -> DataFrame:
    """Host, path, and the longest rule that fits (rule, rule_verdict; null without) of each of the distinct `urls`.

    Each URL looks up its host and the hosts above it among the rules' hosts; a URL has as many lookups as its host
    has labels, whatever the number of rules.
    """
    spark = urls.sparkSession
    known = {r: len(r.name) for r in rules}
    hosts: dict[str, list] = {}
    for rule in known:
        hosts.setdefault(rule.host, []).append((rule.path, rule.name, rule.verdict))
    table = spark.createDataFrame([(h, r) for h, r in hosts.items()], "rule_host string, fitting array<struct<path:string,name:string,verdict:string>>")
    table = WrittenTable(table, len(hosts), "")
    parts = urls.select(F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    labels = F.split("host", "\\.")
    above = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    tried = parts.select("url", "path", F.explode(above).alias("rule_host")).join(table.sized_for_join(), "rule_host")
    fits = tried.select("url", "path", F.explode("fitting").alias("rule")).where(F.expr("startswith(path, rule.path)"))
    # The longest wins; of equal ones, one that allows.
    rank = F.struct(F.length("rule.name").alias("n"), (F.col("rule.verdict") == "allow").alias("allow"), F.col("rule.name").alias("name"))
    best = fits.groupBy("url").agg(F.max_by("rule", rank).alias("rule"))
    return parts.join(best, "url", "left").select("url", "host", "path", F.col("rule.name").alias("rule"), F.col("rule.verdict").alias("rule_verdict"))


def judge_pages(pages: DataFrame, edges: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Verdict on the URL of each page, with decisions spread over `edges` (src, dst) between URLs.

    Returns one row per row: page_id, host, path, rule (the longest that fits; else null), verdict (allow or block).

    A URL's own rule always decides for it. A null URL, or one without a host, has an empty host and path and fits no rule;
    null URLs are in no component and allowed. Edges with a null, repeated ones and loops add nothing. Repeated URLs are
    judged once, so a URL that many pages share is one row until the end. Empty tables give no rows; other columns are not read.
    """
    rows = write_once(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url")), "urls")
    links = write_once(edges.select(F.col(edges.columns[0]).alias("src"), F.col(edges.columns[1]).alias("dst")).where("src IS NOT NULL AND dst IS NOT NULL AND src <> dst").distinct(), "edges")
    counts = rows.data.where("url IS NOT NULL").groupBy("url").agg(F.count("*").alias("n_pages"))
    ends = links.data.select(F.explode(F.array("src", "dst")).alias("url"), F.lit(0).cast("long").alias("n_pages"))
    urls = write_once(counts.union(ends).groupBy("url").agg(F.sum("n_pages").alias("n_pages")), "nodes")
    components = connected_components(links.data)
    matched = match_rules(urls.data, rules).join(components.data.withColumnRenamed("node", "url"), "url", "left").withColumn("component", F.coalesce("component", "url"))
    matched = write_once(matched, "matched")
    spread = matched.data.where("rule IS NOT NULL").groupBy("component").agg(F.max_by("rule_verdict", F.when(F.col("rule_verdict") == "allow", 2).otherwise(1)).alias("spread"))
    judged = matched.data.join(spread, "component", "left").select("url", "host", "path", "rule", F.coalesce("rule_verdict", "spread", F.lit("allow")).alias("verdict"))
    judged = judged.join(urls.data.where("n_pages > 0"), "url")
    judged = write_once(judged, "judged").data
    known = join_unique(rows.data.where("url IS NOT NULL"), judged, "url", "n_pages", rows.rows).select("page_id", "host", "path", "rule", "verdict")
    nothing = rows.data.where("url IS NULL").select("page_id", F.lit("").alias("host"), F.lit("").alias("path"), F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict"))
    return known.unionByName(nothing).withColumnRenamed("page_id", id_col)
