"""URL filters whose lists change over time: an as-of join of captures with dated entries, in DataFrame functions.

List events (domain, day, add or remove) become validity intervals: an entry holds from the day it is added until the
next day on which it is removed. A capture is blocked if, on its day of fetch, its host or a parent
domain of it is on the list; the most specific such entry is reported.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.columns import table

# User information, up to the last @ before the path, is not part of the host.
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?([^/?#:@]+)"


def host(url: str) -> str:
    """SQL for the lower-case host of a URL, null if there is none."""
    return rf"nullif(lower(regexp_extract({url}, r'{_HOST}', 1)), '')"


def intervals(events: DataFrame) -> DataFrame:
    """(domain, since, until) from ``events`` (domain, day, added): days since <= d < until; until is null while it lasts.

    Several events of one domain and day count as one, an addition if there is one among them. Events with a
    null in any of the columns are ignored. Days are reduced before the window, so a domain with very
    many events brings one row per day to it.
    """
    days = events.where("domain IS NOT NULL AND day IS NOT NULL AND added IS NOT NULL").groupBy("domain", "day").agg(F.max("added").alias("added"))
    changes = days.selectExpr("*", "lag(added) OVER (PARTITION BY domain ORDER BY day) AS was").where("was IS NULL OR was <> added")
    return changes.selectExpr("domain", "day AS since", "added", "lead(day) OVER (PARTITION BY domain ORDER BY day) AS until").where("added").drop("added")


def blocked_captures(captures: DataFrame, events: DataFrame) -> DataFrame:
    """The captures (any columns; url and fetched among them) with host, blocked, entry, entry_since.

    A URL without a host, or a null fetch day, is not blocked. Repeated captures are kept. Hosts and days
    are joined once per pair, so a host with very many captures costs the join no more than its days;
    the verdicts then meet the captures in a plain join, whose hot keys AQE may split.
    """
    # Columns of the captures that bear a name of the result would be ambiguous: theirs give way.
    named = captures.drop("host", "blocked", "entry", "entry_since").withColumn("host", F.expr(host("url")))
    pairs = named.where("host IS NOT NULL AND fetched IS NOT NULL").select(F.col("host").alias("of"), F.col("fetched").alias("on")).distinct()
    # The host itself and all parents with at least one dot, most specific first.
    parts = pairs.withColumn("p", F.split("of", r"\."))
    chain = "transform(sequence(1, greatest(size(p) - 1, 1)), i -> struct(i AS depth, array_join(slice(p, i, size(p)), '.') AS name))"
    levels = parts.select("of", "on", F.explode(F.expr(chain)).alias("level")).select("of", "on", "level.*")
    valid = intervals(events)
    hit = levels.join(valid, (F.col("name") == F.col("domain")) & (F.col("since") <= F.col("on")) & (F.col("until").isNull() | (F.col("on") < F.col("until"))))
    best = hit.groupBy("of", "on").agg(F.min(F.struct("depth", "domain", "since")).alias("b"))
    found = best.select("of", "on", F.col("b.domain").alias("entry"), F.col("b.since").alias("entry_since"))
    # Both sides meet as structs, so that no column of the captures can be mistaken for one of the verdicts.
    left, right = named.select(F.struct("*").alias("capture")), found.select(F.struct("*").alias("verdict"))
    same = (F.col("capture.host") == F.col("verdict.of")) & (F.col("capture.fetched") == F.col("verdict.on"))
    blocked = F.col("verdict.entry").isNotNull().alias("blocked")
    return left.join(right, same, "left").select("capture.*", blocked, "verdict.entry", "verdict.entry_since")


# The tables have neither fetch days nor lists; both are derived from all pages: page n is fetched on day n of a
# leap year, in turn, and its host (or the host's parent) changes on the list on another day.
_FETCHED = "date_add(DATE '2024-01-01', CAST(pmod(page_id, 366) AS INT))"
_DAY = "date_add(DATE '2024-01-01', CAST(pmod(page_id * 31 + 7, 366) AS INT))"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    captures = pages.selectExpr("page_id", "url", f"{_FETCHED} AS fetched")
    events = pages.selectExpr(
        f"CASE WHEN page_id % 2 = 0 THEN {host('url')} ELSE nullif(regexp_replace({host('url')}, '^[^.]*[.]', ''), '') END AS domain",
        f"{_DAY} AS day", "page_id % 3 <> 0 AS added",
    )
    return blocked_captures(captures, events).select("page_id", "host", "fetched", "blocked", "entry", "entry_since")


ORACLE_SQL = r"""
WITH p AS (SELECT page_id, nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:@]+)', 1)), '') AS host,
    DATE '2024-01-01' + CAST(page_id % 366 AS INT) AS fetched, DATE '2024-01-01' + CAST((page_id * 31 + 7) % 366 AS INT) AS day FROM pages),
e AS (SELECT CASE WHEN page_id % 2 = 0 THEN host ELSE nullif(regexp_replace(host, '^[^.]*[.]', ''), '') END AS domain, day, bool_or(page_id % 3 <> 0) AS added
    FROM p GROUP BY ALL HAVING domain IS NOT NULL),
pairs AS (SELECT DISTINCT host, fetched FROM p WHERE host IS NOT NULL),
levels AS (SELECT host, fetched, i AS depth, array_to_string(string_split(host, '.')[i:], '.') AS domain
    FROM pairs, (SELECT unnest(range(1, 40)) AS i) WHERE i <= greatest(len(string_split(host, '.')) - 1, 1)),
last AS (SELECT l.host, l.fetched, l.depth, l.domain, max(e.day) AS day FROM levels l JOIN e ON e.domain = l.domain AND e.day <= l.fetched GROUP BY ALL),
act AS (SELECT last.* FROM last JOIN e ON e.domain = last.domain AND e.day = last.day WHERE e.added),
best AS (SELECT host, fetched, min(depth) AS depth FROM act GROUP BY ALL),
won AS (SELECT act.* FROM act JOIN best USING (host, fetched, depth)),
since AS (SELECT w.host, w.fetched, w.domain,
    (SELECT min(a.day) FROM e a WHERE a.domain = w.domain AND a.added AND a.day <= w.fetched
        AND a.day > coalesce((SELECT max(r.day) FROM e r WHERE r.domain = w.domain AND NOT r.added AND r.day <= w.fetched), DATE '1900-01-01')) AS entry_since FROM won w)
SELECT p.page_id, p.host, p.fetched, since.domain IS NOT NULL AS blocked, since.domain AS entry, since.entry_since
FROM p LEFT JOIN since ON since.host = p.host AND since.fetched = p.fetched
"""
