"""Site-relative line dedup, in DataFrame functions only.

Pages are grouped by host.  A line's frequency is the number of the host's
pages that hold it (each page counts once) over the host's pages; lines above
``ratio`` are boilerplate and leave every page of that host, if they are on
``least_pages`` pages: on a host of few pages one or two are above any ratio.  Lines are compared trimmed; blank lines always stay.

Only 16-byte line digests are shuffled, already summed per task.  A host has at
most (its mean number of distinct lines per page) / ratio boilerplate lines, so
they fit one array per host, which is joined to the pages by host: as a
broadcast if all arrays together are under ``most_broadcast`` lines, else as a
shuffle join that adaptive execution can split on a hot host.

Defined results: a null text stays null with 0 lines, an empty text stays
empty; a null host is a host of its own, apart from the empty one; repeated rows
are pages each; an empty table gives an empty result; other columns are carried
along, whatever their names (one called like the result is replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm._scratch import Scratch

RATIO = 0.1
LEAST_PAGES = 3
MOST_BROADCAST = 50_000


def url_host(url: Column) -> Column:
    """Lower-cased host of a URL without user and port; '' if there is none, null of a null."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def html_lines(html: Column) -> Column:
    """Visible text of a page, a line for each run between tags.

    A script, style or comment that is never closed goes on to the end of the page, so that every byte is looked at once.
    """
    quiet = F.regexp_replace(html, r"(?is)<(script|style)\b.*?(</(script|style)\s*>|\z)|<!--.*?(-->|\z)", "\n")
    inline = F.regexp_replace(quiet, r"(?i)</?(b|i|em|strong|a|span|u|code)\b[^<>]*>", "")
    return F.regexp_replace(F.regexp_replace(inline, r"<[^<>]*>", "\n"), r"\n\s*\n", "\n")


def _digest(host: Column, line: Column) -> Column:
    return F.unhex(F.md5(F.concat(host, F.lit("\u0000"), line)))


def _lines(text: Column) -> Column:
    return F.transform(F.split(text, "\n"), lambda x: F.trim(x))


def _key(host: Column) -> Column:
    """A host's key; null has one of its own."""
    return F.coalesce(F.concat(F.lit("="), host), F.lit(""))


def boilerplate(pages: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(key, digest, n, total) of the lines above the ratio; ``pages`` has key and text."""
    each = pages.select("key", F.explode(F.array_distinct(F.filter(_lines(F.col("text")), lambda x: x != ""))).alias("line"))
    counts = each.select("key", _digest(F.col("key"), F.col("line")).alias("digest")).groupBy("key", "digest").agg(F.count("*").alias("n")).where(F.col("n") >= least_pages)
    totals = pages.groupBy("key").agg(F.count("*").alias("total"))
    return counts.join(totals, "key").where(F.col("n") > F.col("total") * F.lit(ratio))


def _without(lines: Column, key: Column, drop: Column) -> Column:
    """The lines whose digest is not in ``drop``; each is digested once, and met with those only that this page holds."""
    marked = F.transform(lines, lambda x: F.struct(x.alias("line"), F.when(F.trim(x) != "", _digest(key, F.trim(x))).alias("digest")))
    # one-element arrays bind a value to a name
    kept = lambda m: F.transform(F.array(F.array_intersect(m["digest"], drop)), lambda own: F.filter(m, lambda x: x["digest"].isNull() | ~F.array_contains(own, x["digest"])))[0]["line"]
    return F.transform(F.array(marked), kept)[0]


def line_dedup(pages: DataFrame, host: Column, text: Column, ratio: float = RATIO, least_pages: int = LEAST_PAGES, most_broadcast: int = MOST_BROADCAST, out_col: str = "__line_dedup") -> DataFrame:
    """Each row of ``pages`` and a struct ``out_col`` (host, text, n_lines, n_dropped, clean)."""
    columns = [c for c in pages.columns if c != out_col]
    # the input's columns travel in one struct, so that no name of theirs meets one of ours
    work = pages.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("r"), host.alias("host"), _key(host).alias("key"), text.alias("text"))
    found = boilerplate(work.select("key", "text"), ratio, least_pages)
    arrays = found.groupBy("key").agg(F.array_sort(F.collect_list("digest")).alias("drop"))
    arrays = Scratch(pages.sparkSession, "lines").keep(arrays, "boilerplate")
    size = arrays.agg(F.sum(F.size("drop"))).first()[0] or 0
    if size <= most_broadcast:
        arrays = F.broadcast(arrays)
    lines = F.split("text", "\n")
    joined = work.join(arrays, "key", "left").withColumn("kept", F.when(F.col("drop").isNull(), lines).otherwise(_without(lines, F.col("key"), F.col("drop"))))
    n_all = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines))
    n_kept = F.when(F.col("text").isNull(), 0).otherwise(F.size("kept"))
    page = F.struct("host", "text", n_all.alias("n_lines"), (n_all - n_kept).alias("n_dropped"), F.array_join("kept", "\n").alias("clean"))
    return joined.select(*(F.col(f"r.`{c}`") for c in columns), page.alias(out_col))
