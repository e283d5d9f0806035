"""URL filters with redirect equivalence.

Block and allow rules name a host, which covers its subdomains, and the
beginning of a path; the longest rule that fits decides. Addresses that
redirects or canonical links join are aliases: connected components over those
edges carry a block from any address to all others that no rule fits. A rule of
an address's own always holds, so an explicit allow stands against its aliases'
block.
"""

from __future__ import annotations

from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.llm.components import connected_components
from quillmill.llm.support import session, settle

ALLOW, BLOCK = "allow", "block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Tags that may name another address of the page, and attributes in them: quoted either way or bare.
_TAG = r"(?i)<(?:link|meta|base)\s[^<>]*>"
_ATTRIBUTE = r"""(?is)\s%s\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
#: Parts of a page that only show text.
_HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)"


def lowered(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def host_and_path(url: str | Column) -> tuple[Column, Column]:
    """What follows the first `://` up to /, ?, # or the end, A-Z lowered, and then up to ?, # or the end; both empty for null and without `://`."""
    url = F.col(url) if isinstance(url, str) else url
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return lowered(host), F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)


def address(url: str | Column) -> Column:
    """The form by which a URL is one address: scheme and host lowered, no fragment, "/" for an empty path; null without `://`."""
    url = F.col(url) if isinstance(url, str) else url
    whole = F.regexp_extract(F.trim(url.cast("string")), r"^[^#]*", 0)
    at = F.instr(whole, "://")
    rest = F.substring(whole, at + 3, F.length(whole))
    host = F.regexp_extract(rest, r"^[^/?]*", 0)
    after = F.substring(rest, F.length(host) + 1, F.length(rest))
    return F.when((at > 0) & (host != ""), F.concat(lowered(F.left(whole, at + 2)), lowered(host), F.when(after.startswith("/"), after).otherwise(F.concat(F.lit("/"), after))))


def attribute(tag: Column, name: str) -> Column:
    """An attribute's value in a tag's text, empty without one."""
    pattern = _ATTRIBUTE % name
    return F.trim(F.concat(*[F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)]))


def link_edges(pages: DataFrame, url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(a, b) of addresses: a page and what its canonical link or its refresh names.

    Tags in comments and scripts do not count. A relative target is resolved
    against the page's base tag or its own address; one that is no web address
    is left out. Null pages and pages without such tags give nothing.
    """
    session()
    tags = F.regexp_extract_all(F.regexp_replace(F.coalesce(F.col(html_column), F.lit("")), _HIDDEN, " "), F.lit(_TAG), 0)
    rows = pages.where(F.col(html_column).rlike("(?i)canonical|http-equiv")).select(F.trim(F.col(url_column).cast("string")).alias("url"), tags.alias("tags"))
    base = F.get(F.filter("tags", lambda t: F.lower(t).startswith("<base")), 0)
    named = F.transform("tags", lambda t: F.when(F.lower(t).startswith("<link") & F.array_contains(F.split(F.lower(attribute(t, "rel")), r"\s+"), "canonical"), attribute(t, "href")).when(
        F.lower(t).startswith("<meta") & (F.lower(attribute(t, "http-equiv")) == "refresh"), F.regexp_extract(attribute(t, "content"), r"""(?is)^[\d.\s]*[;,]\s*(?:url\s*=\s*)?['"]?([^'"]+)""", 1)))
    targets = rows.select("url", F.coalesce(attribute(base, "href"), F.lit("")).alias("base"), F.explode(F.filter(named, lambda x: x.isNotNull() & (x != ""))).alias("target"))

    @F.arrow_udf("string")
    def resolved(urls: pa.Array, bases: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for url, base, target in zip(urls.to_pylist(), bases.to_pylist(), found.to_pylist()):
            try:
                out.append(urljoin(urljoin(url or "", base), target.strip()))
            except ValueError:  # no address at all
                out.append(None)
        return pa.array(out, type=pa.string())

    return edges_of(targets.select("url", resolved("url", "base", F.regexp_replace("target", "&amp;", "&")).alias("target")), "url", "target")


def edges_of(redirects: DataFrame, source: str = "source", target: str = "target") -> DataFrame:
    """(a, b) of a table of redirects; rows with an address missing are left out."""
    return redirects.select(address(source).alias("a"), address(target).alias("b")).where("a is not null and b is not null")


def longest_rules(addresses: DataFrame, rules: DataFrame, key: str = "url") -> DataFrame:
    """(key, rule, decision) of the addresses that a rule fits: distinct ones, by the longest rule; of equal ones allow.

    rules (host, path, verdict). An address asks for each ending of its host at
    a dot with the beginning of its path of every length that a rule has: an
    equi-join, so that many rules of a host and many addresses of it make no
    pairs. An empty path fits every path; rules with a null part, an empty host or
    another verdict fit nothing.
    """
    known = rules.select(lowered(F.col("host")).alias("_host"), F.col("path").alias("_path"), F.col("verdict").alias("_verdict"))
    known = known.where((F.col("_host") != "") & F.col("_path").isNotNull() & F.col("_verdict").isin(ALLOW, BLOCK))
    known = known.groupBy("_host", "_path").agg(F.min("_verdict").alias("_verdict"))
    lengths = [r[0] for r in known.select(F.length("_path")).distinct().orderBy(F.length("_path")).collect()]  # as many as lengths of paths
    host, path = host_and_path(key)
    own = addresses.select(key).where(F.col(key).isNotNull()).distinct().select(key, host.alias("_h"), path.alias("_p")).where("_h <> ''")
    labels = F.split("_h", r"\.")
    endings = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    starts = F.transform(F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("_p")), lambda n: F.left("_p", n))
    asked = own.select(key, F.explode(endings).alias("_host"), starts.alias("_s")).select(key, "_host", F.explode("_s").alias("_path"))
    rule = F.concat("_host", "_path")
    found = asked.join(known, ["_host", "_path"]).select(key, rule.alias("rule"), "_verdict")
    best = found.groupBy(key).agg(F.max(F.struct(F.length("rule"), (F.col("_verdict") == ALLOW).alias("allow"), "rule")).alias("_best"))
    return best.select(key, F.col("_best.rule").alias("rule"), F.when(F.col("_best.allow"), ALLOW).otherwise(BLOCK).alias("decision"))


def judge(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None, key: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(page_id, host, path, rule, verdict, root) of every row.

    rule and verdict are those of the longest rule that fits the page's own URL.
    Where none does, the verdict is block if a rule blocks any address that
    redirects (source, target) or links of the pages join to it, by any number
    of steps, else allow; root is the smallest address of such a group, null
    without one. Null URLs and those without `://` have an empty host and path
    and are allowed; repeated rows repeat; extra columns are dropped; an empty
    table gives an empty one.
    """
    rows = pages.select(F.col(key).alias("page_id"), F.col(url_column).cast("string").alias("url"), address(url_column).alias("node"))
    edges = link_edges(pages, url_column, html_column)
    if redirects is not None:
        edges = edges.unionByName(edges_of(redirects))
    joined = connected_components(edges)  # of a group, all but the root
    groups = settle(joined.union(joined.select(F.col("root").alias("node"), "root").distinct()))
    inner = longest_rules(groups.select("node"), rules, "node").where(F.col("decision") == BLOCK)
    blocked = settle(groups.join(inner.select("node"), "node").select("root").distinct()).withColumn("_blocked", F.lit(True))
    known = groups.join(blocked, "root", "left").select("node", "root", "_blocked")
    host, path = host_and_path("url")
    # Both sides grow with the pages, and what is settled is smaller on disk than in memory: not to be broadcast.
    out = rows.join(settle(longest_rules(rows, rules, "url")).hint("merge"), "url", "left").join(known.hint("merge"), "node", "left")
    verdict = F.coalesce("decision", F.when(F.col("_blocked"), BLOCK), F.lit(ALLOW))
    return out.select("page_id", host.alias("host"), path.alias("path"), "rule", verdict.alias("verdict"), "root")
