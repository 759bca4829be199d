"""Links: addresses brought to one form, what a policy forbids, and the choice among sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bare_host(url: Column) -> Column:
    """Host in lower case without www; null for anything that is no web address."""
    host = F.lower(F.try_parse_url(url, F.lit("HOST")))
    return F.when(F.lower(F.try_parse_url(url, F.lit("PROTOCOL"))).isin("http", "https"), F.regexp_replace(host, r"^www\.", ""))


def problems(url: Column, aggregators: list[str]) -> Column:
    """Why a policy forbids a link: no address, no https, a latest-release link, a file, an aggregator; empty if nothing does."""
    path = F.lower(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")))
    host = bare_host(url)
    found = F.array(
        F.when(F.lower(F.try_parse_url(url, F.lit("PROTOCOL"))) != "https", "not https"),
        F.when(path.rlike(r"/releases/latest(/|$)"), "a latest link"),
        F.when(path.rlike(r"/releases/download/|\.(zip|ttf|otf|woff2?|tar\.(gz|xz)|7z)$"), "a file"),
        F.when(host.isin(aggregators), "an aggregator"),
    )
    return F.when(host.isNull(), F.array(F.lit("not a web address"))).otherwise(F.array_compact(found))


def target(url: Column, forges: list[str]) -> Column:
    """What a link stands for: a forge's repository whatever the path, else the page over https without a final slash; null if nothing."""
    host, path = bare_host(url), F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit(""))
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    repo = F.lower(F.concat_ws("/", host, F.get(parts, F.lit(0)), F.regexp_replace(F.get(parts, F.lit(1)), r"\.git$", "")))
    query = F.try_parse_url(url, F.lit("QUERY"))
    page = F.concat(host, F.regexp_replace(path, "/+$", ""), F.when(F.length(query) > 0, F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(host.isin(forges) & (F.size(parts) >= 2), repo).otherwise(page)


def choice(links: DataFrame, family: str, source: str, key: str, kind: str, trusted: list[str], agree: int = 2) -> DataFrame:
    """By family its best link: most sources, then homepages, then by key; accepted if `agree` sources give it or a trusted one does."""
    by = links.groupBy(family, key).agg(F.count_distinct(source).alias("n"), F.max(F.col(source).isin(trusted)).alias("_t"), F.min(kind).alias("kind"))
    rank = F.struct(-F.col("n"), F.col("kind") != "homepage", F.col(key))
    best = by.groupBy(family).agg(F.min_by(F.struct(F.col(key).alias("link"), "n", "kind", (F.col("_t") | (F.col("n") >= agree)).alias("accepted")), rank).alias("_b"))
    return best.select(family, "_b.*")


def sorted_query(url: Column) -> Column:
    """An address with its query's parameters in order."""
    query = F.try_parse_url(url, F.lit("QUERY"))
    head = F.regexp_replace(url, r"[?#].*$", "")
    return F.when(F.length(query) > 0, F.concat(head, F.lit("?"), F.array_join(F.array_sort(F.split(query, "&")), "&"))).otherwise(head)
