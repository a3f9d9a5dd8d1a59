"""Site-relative line removal: drop lines that a large share of a host's pages contain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_PAGES = 5
MAX_RATIO = 0.01


def normalised(line: Column) -> Column:
    """Spaces trimmed, A-Z (and other letters) in lower case."""
    return F.lower(F.trim(line))


def _line_keys(text: Column) -> Column:
    """Hash of each ``\\n``-separated line; blank lines get NULL and are never dropped."""
    return F.transform(
        F.split(text, "\n", -1),
        lambda line: F.when(normalised(line) != "", F.xxhash64(normalised(line))),
    )


def line_pages(
    docs: DataFrame, host: str = "source", text: str = "text", once_per_text: bool = False
) -> DataFrame:
    """(host, line_key, n_pages, host_pages): pages with a line and all pages of its host.

    A page counts once for a line however often it repeats it. Rows are pre-aggregated before
    the shuffle, so a host or line with a third of the rows costs one row a task. With
    ``once_per_text`` pages of a host whose lines are equal count as one.
    """
    rows = docs.select(F.col(host).alias("host"), _line_keys(F.col(text)).alias("line_keys"))
    if once_per_text:
        same = F.xxhash64("line_keys").alias("same")
        rows = rows.groupBy("host", same).agg(F.first("line_keys").alias("line_keys"))
    pages = rows.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    lines = rows.select(
        "host", F.explode(F.array_distinct("line_keys")).alias("line_key")
    ).where("line_key is not null")
    counted = lines.groupBy("host", "line_key").agg(F.count(F.lit(1)).alias("n_pages"))
    # Two pages with a line are the least that a rule can ask for: single lines stop here.
    return counted.where("n_pages > 1").alias("c").join(
        pages.alias("p"), F.col("c.host").eqNullSafe(F.col("p.host"))
    ).select("c.host", "line_key", "n_pages", "host_pages")


def boilerplate(
    docs: DataFrame,
    host: str = "source",
    text: str = "text",
    min_pages: int = MIN_PAGES,
    max_ratio: float = MAX_RATIO,
    once_per_text: bool = False,
) -> DataFrame:
    """(host, line_key) of lines on at least ``min_pages`` pages and above the ratio."""
    if min_pages < 2:
        raise ValueError("min_pages must be 2 or more")
    return line_pages(docs, host, text, once_per_text).where(
        (F.col("n_pages") >= min_pages)
        & (F.col("n_pages") > F.lit(max_ratio) * F.col("host_pages"))
    ).select("host", "line_key")


def dedup_lines(
    docs: DataFrame,
    key: str = "doc_id",
    host: str = "source",
    text: str = "text",
    min_pages: int = MIN_PAGES,
    max_ratio: float = MAX_RATIO,
    once_per_text: bool = False,
) -> DataFrame:
    """Every row of ``docs`` with the lines that remain.

    Adds ``clean_text``, ``n_lines`` and ``n_dropped``; remaining lines keep their text and
    order. A NULL text stays NULL with zero lines; an empty text has one (blank) line. A NULL
    host is a host of its own. Rows that repeat a key each keep their own text. Names that
    ``docs`` already uses for the added columns are replaced. With ``once_per_text`` copies of a
    text in a host count as one page, so a group of copies does not lose its lines by itself.
    Texts of any length are read whole, and an empty table gives an empty one.
    """
    bad = boilerplate(docs, host, text, min_pages, max_ratio, once_per_text)
    rows = docs.select(
        F.col(key).alias("k"),
        F.col(host).alias("host"),
        F.explode(F.array_distinct(_line_keys(F.col(text)))).alias("line_key"),
    ).where("line_key is not null")
    hits = (
        rows.alias("r")
        .join(
            bad.alias("b"),
            (F.col("r.line_key") == F.col("b.line_key"))
            & F.col("r.host").eqNullSafe(F.col("b.host")),
            "left_semi",
        )
        # A page has a bounded number of lines, so its set of dropped ones is bounded too.
        .groupBy("k", "host")
        .agg(F.collect_set("line_key").alias("_dropped"))
    )
    kept = docs.drop("clean_text", "n_lines", "n_dropped", "_dropped")
    joined = kept.join(
        hits,
        kept[key].eqNullSafe(hits["k"]) & kept[host].eqNullSafe(hits["host"]),
        "left",
    )
    # One row of a key and host can be dropped lines of another: the rule is per host, so equal.
    lines = F.split(F.col(text), "\n", -1)
    left = F.when(F.col("_dropped").isNull(), lines).otherwise(
        F.filter(
            lines,
            lambda line: ~F.coalesce(
                F.array_contains(F.col("_dropped"), F.xxhash64(normalised(line)))
                & (normalised(line) != ""),
                F.lit(False),
            ),
        )
    )
    return joined.select(
        *(kept[c] for c in kept.columns),
        F.array_join(left, "\n").alias("clean_text"),
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size(lines) - F.size(left), F.lit(0)).cast("long").alias("n_dropped"),
    )
