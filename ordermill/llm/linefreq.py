"""Line dedup by site-relative frequency.

Per site, the pages that contain a line are divided by the site's pages; lines
above ``ratio`` that stand on ``min_pages`` pages or more are boilerplate and
are dropped from every page of the site. The rest of a page stays as it was,
in its order.

A line is what stands between line feeds, compared without outer blanks; blank
lines are neither counted nor dropped. Nulls: a null text stays null, and a page
without a site stays whole, as nothing can be said about its site. Repeated
rows are pages of their own. A page of boilerplate only keeps its row with an
empty text. Columns beside these stay as they are.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import size_checked, stored, unused

RATIO = 0.1
MIN_PAGES = 5


def _key(line: Column) -> Column:
    """MD5 of the line, so that long lines aren't shuffled."""
    return F.md5(F.trim(line))


def boilerplate(pages: DataFrame, site: str, text: str, ratio: float = RATIO,
                min_pages: int = MIN_PAGES) -> DataFrame:
    """Per site with boilerplate, the array ``_lines`` of its lines' keys.

    A page's repeats are removed within its row, and counts are combined before
    the shuffle, so a site of any size sends each line once per task. A site's
    array is bounded: lines on more than ``ratio`` of the pages are fewer than
    the lines of its average page divided by ``ratio``.
    """
    known = pages.filter(F.col(site).isNotNull())
    lines = F.filter(F.split(F.col(text), "\n"), lambda x: F.trim(x) != "")
    totals = known.groupBy(site).agg(F.count(F.lit(1)).alias("_pages"))
    return (known.select(site, F.explode(F.array_distinct(F.transform(lines, _key)))
                         .alias("_line"))
            .groupBy(site, "_line").agg(F.count(F.lit(1)).alias("_on"))
            .filter(F.col("_on") >= min_pages)
            .join(totals, site)
            .filter(F.col("_on") > F.lit(ratio) * F.col("_pages"))
            .groupBy(site).agg(F.collect_list("_line").alias("_lines")))


def drop_boilerplate(pages: DataFrame, site: str, text: str, ratio: float = RATIO,
                     min_pages: int = MIN_PAGES, dropped: str = "n_dropped") -> DataFrame:
    """``pages`` with the shortened ``text`` and the number of lines ``dropped``, which
    takes the place of a column of that name."""
    found, path = stored(boilerplate(pages, site, text, ratio, min_pages), "boilerplate")
    of, listed, rest = (unused([*pages.columns, dropped], c) for c in ("_site", "_lines", "_kept"))
    found = size_checked(found, path).toDF(of, listed)
    lines = F.split(F.col(text), "\n")
    kept = F.filter(lines, lambda x: ~F.array_contains(F.col(listed), _key(x))
                    | (F.trim(x) == ""))
    return (pages.join(found, F.col(site) == F.col(of), "left")
            .withColumn(rest, F.when(F.col(listed).isNotNull(), kept))
            .withColumn(dropped, F.when(F.col(rest).isNotNull(),
                                        F.size(lines) - F.size(rest)).otherwise(0))
            .withColumn(text, F.when(F.col(dropped) > 0, F.array_join(rest, "\n"))
                        .otherwise(F.col(text)))
            .select(*[c for c in pages.columns if c.lower() != dropped.lower()], dropped))
