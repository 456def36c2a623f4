"""Not-modified revisit records of web archives, resolved to the responses they stand for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# fixed values: header fields that a not-modified answer updates, and query parameters that name no resource
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
TRACKING = r"^(utm_[a-z]+|fbclid|gclid)(=|$)"


def canonical_url(url: Column) -> Column:
    """Host in lower case without user, www. and default port; path without a last slash; sorted query; no fragment.

    The scheme is left out, as are empty and tracking parameters.  Null stays null.
    """
    bare = F.regexp_replace(F.trim(url), "#.*$", "")
    bare = F.regexp_replace(bare, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    place, query = F.regexp_extract(bare, r"^([^?]*)", 1), F.regexp_extract(bare, r"\?(.*)$", 1)
    host = F.regexp_replace(F.lower(F.regexp_extract(place, "^([^/]*)", 1)), r"^[^@]*@|:(80|443)$", "")
    host = F.regexp_replace(host, r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(place, "^[^/]*(.*)$", 1), "/+$", "")
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit("")))


def _tag(column: Column) -> Column:
    """An entity tag for weak comparison."""
    return F.regexp_replace(F.trim(column), "^W/", "")


def resolved(records: DataFrame, span: int) -> DataFrame:
    """Each revisit of ``records`` with the latest earlier full response of its canonical URL.

    ``records`` has record_id, url, at (a number), kind (``response`` or ``revisit``), and headers (a map with names
    in lower case).  Returns record_id, canonical_url, at, response_id, response_at, state and headers:

    *   ``resolved``: the revisit's entity tag equals the response's in weak comparison, or, without one on the
        revisit, its last-modified does; headers are the response's, with the permitted ones of the revisit put in.
    *   ``changed``: neither validator agrees, or the revisit has none; headers are null.
    *   ``missing``: there is no earlier full response.

    The as-of join is a window over (URL, block of ``span`` time units), and the last response of earlier blocks from
    a table with one row a block, so a hot URL is spread over its blocks; ``span`` bounds a block's rows.  A response
    at the revisit's own time counts as earlier; of several at one time the greatest record_id counts.  Defined results:
    a null url or time makes a revisit ``missing`` and a response unused; null headers are empty; repeated records are
    records of their own; payloads and other columns are not read; an empty table gives no rows.
    """
    rows = records.select(
        "record_id", canonical_url(F.col("url")).alias("canonical_url"), "at", "kind",
        F.coalesce("headers", F.expr("cast(map() as map<string, string>)")).alias("headers"),
    ).withColumn("block", F.floor(F.col("at") / span))
    full = F.when(
        (F.col("kind") == "response") & F.col("canonical_url").isNotNull() & F.col("at").isNotNull(),
        F.struct("at", "record_id", "headers"),
    )
    key = ["canonical_url", "block"]
    rows = rows.withColumn("full", full)
    # maps have no order: the last response is found by time and id, its headers come along
    last = rows.where("full IS NOT NULL").groupBy(*key).agg(F.max_by("full", F.struct("full.at", "full.record_id")).alias("own"))
    asked = rows.select(*key).where("canonical_url IS NOT NULL AND block IS NOT NULL").distinct().join(last, key, "left")
    earlier = Window.partitionBy("canonical_url").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = asked.select(*key, F.last("own", ignorenulls=True).over(earlier).alias("carried"))
    order = Window.partitionBy(*key).orderBy("at", F.when(F.col("kind") == "response", 0).otherwise(1), "record_id")
    within = F.last("full", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = rows.withColumn("within", within).where("kind = 'revisit'").join(carried, key, "left")
    found = found.withColumn("response", F.when(F.col("at").isNotNull(), F.coalesce("within", "carried")))
    own, theirs = F.col("headers"), F.col("response.headers")
    same = F.when(own["etag"].isNotNull(), _tag(own["etag"]) == _tag(theirs["etag"])).otherwise(
        own["last-modified"] == theirs["last-modified"]
    )
    state = F.when(F.col("response").isNull(), "missing").when(F.coalesce(same, F.lit(False)), "resolved").otherwise("changed")
    permitted = F.map_filter(own, lambda k, v: k.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter(theirs, lambda k, v: ~F.map_contains_key(permitted, k)), permitted)
    return found.withColumn("state", state).select(
        "record_id", "canonical_url", "at", F.col("response.record_id").alias("response_id"),
        F.col("response.at").alias("response_at"), "state", F.when(F.col("state") == "resolved", merged).alias("headers"),
    )


def second_crawl(pages: DataFrame, lag: int) -> DataFrame:
    """Records of a crawl of ``pages`` (page_id, url, html) and of a second one, ``lag`` time units later.

    Each page is a full response at time page_id, tagged with the hash of its html.  The second crawl asks for the same
    resource under another spelling of its URL, sends the tag it knows, and is told that nothing changed.
    """
    tag = F.concat(F.lit('"'), F.md5(F.coalesce(F.col("html"), F.lit(""))), F.lit('"'))
    size = F.octet_length(F.coalesce(F.col("html"), F.lit(""))).cast("string")
    header = lambda *pairs: F.create_map(*[x for name, value in pairs for x in (F.lit(name), value)])
    day = lambda at: F.concat(F.lit("day "), F.floor(at / 100).cast("string"))
    first = pages.select(
        F.concat(F.lit("a"), F.col("page_id")).alias("record_id"), "url", F.col("page_id").alias("at"), F.lit("response").alias("kind"),
        header(("etag", tag), ("content-length", size), ("date", day(F.col("page_id")))).alias("headers"),
    )
    at = F.col("page_id") + lag
    again = pages.select(
        F.concat(F.lit("b"), F.col("page_id")).alias("record_id"),
        F.concat(F.regexp_replace("url", "#.*$", ""), F.lit("#again")).alias("url"), at.alias("at"), F.lit("revisit").alias("kind"),
        header(("etag", F.concat(F.lit("W/"), tag)), ("content-length", F.lit("0")), ("date", day(at))).alias("headers"),
    )
    return first.unionByName(again)
