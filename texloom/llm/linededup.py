"""Line dedup: lines that a large share of a host's pages carry are boilerplate and go.

For each host, the pages that contain a line are divided by the pages of the
host; a line above the ratio, on enough pages, is dropped from all of them.

Defined results: rows are pages; a line that a page repeats counts once for
it; lines are compared as they stand and blank ones are never dropped; rows
without a host are returned as they are; a null text stays null; a text that
loses all its lines becomes empty; whole texts of any length are read; a line
exactly at the ratio stays; an empty table gives an empty one. All columns of
the input are kept; the operator's own are named _tl_* inside, and with
`counted` its n_lines and n_dropped replace columns of those names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .shared import table_bytes, written

#: A line goes if it is on more than this share of the host's pages, and on this many at least.
RATIO, LEAST_PAGES = 0.1, 3
#: Files of boilerplate hashes up to this size are sent to every task; beyond it the pages are joined on the host, those of a host dealt out to SALTS tasks.
BROADCAST_BYTES, SALTS = 16 << 20, 16


def _lines(text):
    return F.split(text, "\n", -1)


def boilerplate(docs: DataFrame, host: str = "source", ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """_tl_host and _tl_drop, the 64-bit hashes of the host's boilerplate lines.

    A host has at most (lines of a page / ratio) of them on average, however many pages it has.
    """
    # Two lines of 64 bits are taken as equal: among 1e13 lines against 1e3 dropped ones a host that is wrong for one line in 2e3 runs.
    pages = docs.where(F.col(host).isNotNull()).select(F.col(host).alias("_tl_host"), F.array_distinct(F.transform(F.filter(_lines(F.coalesce("text", F.lit(""))), lambda x: F.trim(x) != ""), lambda x: F.xxhash64(x))).alias("_tl_hashes"))
    totals = pages.groupBy("_tl_host").agg(F.count("*").alias("_tl_pages"))
    # counted before it is dealt out, so that a line on a third of all pages is one row for each task
    counts = pages.select("_tl_host", F.explode("_tl_hashes").alias("_tl_line")).groupBy("_tl_host", "_tl_line").agg(F.count("*").alias("_tl_with")).where(F.col("_tl_with") >= least_pages)
    over = counts.join(totals, "_tl_host").where(F.col("_tl_with") > ratio * F.col("_tl_pages"))
    return over.groupBy("_tl_host").agg(F.collect_list("_tl_line").alias("_tl_drop"))


def drop_boilerplate(docs: DataFrame, host: str = "source", ratio: float = RATIO, least_pages: int = LEAST_PAGES, broadcast_bytes: int = BROADCAST_BYTES, counted: bool = False) -> DataFrame:
    """docs with boilerplate lines cut from text; counted: also n_lines and n_dropped."""
    hosts = written(boilerplate(docs, host, ratio, least_pages), "boilerplate", compact=True)
    if table_bytes(hosts) <= broadcast_bytes:
        joined = docs.join(F.broadcast(hosts), F.col(host) == F.col("_tl_host"), "left")
    else:
        salted = hosts.withColumn("_tl_salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
        dealt = docs.withColumn("_tl_mine", F.pmod(F.xxhash64("text", host), F.lit(SALTS)).cast("int"))  # rows without a host too
        joined = dealt.join(salted, (F.col(host) == F.col("_tl_host")) & (F.col("_tl_mine") == F.col("_tl_salt")), "left")
    kept = F.filter(_lines(F.col("text")), lambda x: (F.trim(x) == "") | ~F.array_contains("_tl_drop", F.xxhash64(x)))
    joined = joined.withColumn("_tl_kept", F.when(F.col("_tl_drop").isNotNull(), kept))
    text = F.when(F.col("_tl_kept").isNull(), F.col("text")).otherwise(F.array_join("_tl_kept", "\n"))
    columns = [text.alias("text") if c == "text" else F.col(c) for c in docs.columns if not (counted and c in ("n_lines", "n_dropped"))]
    if counted:
        n = F.when(F.col("text").isNull(), 0).otherwise(F.size(_lines(F.col("text"))))
        columns += [n.cast("long").alias("n_lines"), F.when(F.col("_tl_kept").isNull(), 0).otherwise(n - F.size("_tl_kept")).cast("long").alias("n_dropped")]
    return joined.select(*columns)
