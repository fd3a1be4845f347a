"""Ranking, top-k, samples and batch slices; every order ends in a key, so reruns agree."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import first_rows, stage


def latest(rows: DataFrame, key: str, by: str, pos: str) -> DataFrame:
    """The latest row of each key; ties keep the first by pos."""
    return first_rows(rows, [key], F.col(by).desc_nulls_last(), F.col(pos).asc())


def last_line(rows: DataFrame, key: str, pos: str) -> DataFrame:
    """The last row of each key in line order."""
    return first_rows(rows, [key], F.col(pos).desc())


def init_ledger(rows: DataFrame, index: DataFrame, key: str = "pid", by: str = "extracted_at", pos: str = "pos") -> tuple[DataFrame, DataFrame]:
    """(ledger, quarantine): old ids mapped by alias, the latest row a document; unmapped rows are quarantined."""
    i = index.select(F.col("key").alias("_key"), F.col("doc_id").alias("current_id"))
    j = rows.join(i, F.col(key) == F.col("_key"), "left").drop("_key")
    return latest(j.where(F.col("current_id").isNotNull()), "current_id", by, pos), j.where(F.col("current_id").isNull()).withColumn("reason", F.lit("unmapped_id"))


def round_robin(rows: DataFrame, source: str, key: str, n: int, stride: int = 1) -> DataFrame:
    """n rows, one of each source in turn (E5); with a stride, every stride-th row of a source first."""
    w = Window.partitionBy(source).orderBy(key)
    turn = F.row_number().over(w) - 1
    d = rows.withColumn("_turn", turn).withColumn("_turn", F.pmod(F.col("_turn"), F.lit(stride)) * F.lit(1 << 40) + F.floor(F.col("_turn") / stride))
    return d.orderBy("_turn", source, key).limit(n).drop("_turn")


def quota_sample(rows: DataFrame, cells: Iterable[str], key: str, quota: int) -> DataFrame:
    """Up to quota rows of every cell of every column, each row once (E6): per-cell ranks joined; greedy_cover() takes fewer rows."""
    picked = None
    for c in cells:
        one = rows.withColumn("_rn", F.row_number().over(Window.partitionBy(c).orderBy(key))).where(F.col("_rn") <= quota).select(key)
        picked = one if picked is None else picked.union(one)
    return rows.join(picked.distinct(), key, "left_semi")


def greedy_cover(rows: DataFrame, key: str, cells: str, quota: dict[str, int], target: int) -> DataFrame:
    """At most `target` rows, with `pick` from 1, that fill the quotas of cells (E6): each pick is the row with the most cells that are still short (ties: the
    smallest key); once all are full, the row whose cells have been picked least, by the sum of 1 / (1 + times picked). Cells without a quota count in the second part alone.

    cells: a column of distinct strings. Rows of equal cells differ in their keys alone, so the `target` smallest keys of each set of cells are all that can
    be picked; these are written, and each pick is one combining aggregate over them, of which one row reaches the driver.
    """
    w = Window.partitionBy("_cells").orderBy(key)
    sets = rows.select(F.col(key), F.array_sort(F.coalesce(cells, F.array().cast("array<string>"))).alias("_cells"))
    pool = stage(sets.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= target).drop("_rn"))
    left, seen, picked = dict(quota), {}, []
    filling = False
    while len(picked) < target:
        if not filling:
            open_ = F.array(*[F.lit(c) for c, n in left.items() if n > 0]).cast("array<string>")
            gain = F.size(F.array_intersect("_cells", open_)).cast("double")
        else:
            times = F.create_map(*[F.lit(x) for kv in seen.items() for x in kv]) if seen else F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<int>"))
            gain = F.aggregate("_cells", F.lit(0.0), lambda total, c: total + 1.0 / (1 + F.coalesce(F.try_element_at(times, c), F.lit(0))))
        best = pool.where(~F.col(key).isin(picked)) if picked else pool
        best = best.agg(F.min_by(F.struct(key, "_cells"), F.struct(-gain, key)).alias("b"), F.max(gain).alias("gain")).first()
        if best.gain is None or not filling and best.gain == 0:
            if filling or best.gain is None:
                break
            filling = True
            continue
        picked.append(best.b[0])
        for c in best.b[1]:
            seen[c] = seen.get(c, 0) + 1
            left[c] = left.get(c, 0) - 1
    order = F.array_position(F.array(*map(F.lit, picked)).cast(f"array<{dict(rows.dtypes)[key]}>"), F.col(key)).cast("int")
    return rows.where(F.col(key).isin(picked)).withColumn("pick", order) if picked else rows.limit(0).withColumn("pick", F.lit(0))


def seeded_sample(rows: DataFrame, by: str, key: str, n: int, seed: int = 7) -> DataFrame:
    """n rows of each class, reproducible: the smallest hashes of (key, seed)."""
    w = Window.partitionBy(by).orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f"#{seed}"))), key)
    return rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def sample_with_titles(edges: DataFrame, index: DataFrame, by: str, key: str, n: int, seed: int = 7) -> DataFrame:
    """A sample of each class with titles of both ends ('not found' for unresolved ones), the class's size beside it (C30). index: (key, title)."""
    size = edges.groupBy(by).agg(F.count("*").alias("class_size")).withColumnRenamed(by, "_by")
    s = seeded_sample(edges, by, key, n, seed).join(size, F.col(by).eqNullSafe(F.col("_by"))).drop("_by")
    for end in ("from", "to"):
        t = index.select(F.col("key").alias("_k"), F.col("title").alias("_t"))
        s = s.join(t, F.col(f"{end}_id") == F.col("_k"), "left").withColumn(f"{end}_title", F.coalesce("_t", F.lit("not found"))).drop("_k", "_t")
    return s


def batch_slice(rows: DataFrame, key: str, batch: int, size: int) -> DataFrame:
    """The batch-th block (from 0) of size rows in order of key (E8). Range-partitioned ranks: counts per partition of key ranges, then a rank inside."""
    d = rows.repartitionByRange(key).withColumn("_part", F.spark_partition_id())
    d = stage(d)
    start = d.groupBy("_part").agg(F.count("*").alias("n"))
    start = start.select(F.col("_part").alias("_p"), (F.sum("n").over(Window.orderBy("_part")) - F.col("n")).alias("before"))
    ranked = d.join(start, F.col("_part") == F.col("_p")).withColumn("_rank", F.col("before") + F.row_number().over(Window.partitionBy("_part").orderBy(key)))
    return ranked.where((F.col("_rank") > batch * size) & (F.col("_rank") <= (batch + 1) * size)).drop("_part", "_p", "before", "_rank")


def plan_sweep(dead: DataFrame, history: DataFrame, max_retries: int = 2, cap: int = 50) -> DataFrame:
    """(pid, pos, tries, outcome): of dead letters the first row of each pid counts; tried max_retries times: given_up; the first cap others: requeued; the rest: left."""
    first = first_rows(dead.where(F.coalesce("pid", F.lit("")) != ""), ["pid"], F.col("pos")).select("pid", "pos")
    h = history.select(F.col("pid").alias("_p"), F.col("tries").alias("_t"))
    d = first.join(h, F.col("pid") == F.col("_p"), "left").select("pid", "pos", F.coalesce("_t", F.lit(0)).alias("tries"))
    d = d.withColumn("_open", F.col("tries") < max_retries)
    # only the first `cap` open rows are requeued, so their last position is all that must be known
    bound = d.where("_open").orderBy("pos").limit(cap).agg(F.max("pos").alias("_last"))
    d = d.join(bound, F.lit(True), "left")
    outcome = F.when(~F.col("_open"), "given_up").when(F.col("pos") <= F.col("_last"), "requeued").otherwise("left")
    return d.select("pid", "pos", "tries", outcome.alias("outcome"))


def new_history(plan: DataFrame, history: DataFrame) -> DataFrame:
    """History after a sweep: one try more for what is requeued."""
    up = plan.where("outcome = 'requeued'").select("pid", (F.col("tries") + 1).cast("long").alias("tries"))
    return up.unionByName(history.join(up.select("pid"), "pid", "left_anti").select("pid", F.col("tries").cast("long").alias("tries")))


PRIORITY = ("high", "normal", "low")


def queue_order(queue: DataFrame, ranks: Iterable[str] = PRIORITY) -> DataFrame:
    """One row per pid: the highest priority with its trigger and time, at the first position; in order of rank and position."""
    rank = F.coalesce(*[F.when(F.col("priority") == p, F.lit(k)) for k, p in enumerate(ranks)], F.lit(99))
    d = queue.withColumn("_rank", rank)
    best = d.groupBy("pid").agg(F.min("pos").alias("pos"), F.min_by(F.struct("trigger", "priority", "requested_at"), F.struct("_rank", "pos")).alias("b"), F.min("_rank").alias("rank"))
    return best.select("pid", "b.trigger", "b.priority", "b.requested_at", "pos", "rank").orderBy("rank", "pos", "pid")


def spot_checks(rows: DataFrame, by: str, *order: str) -> DataFrame:
    """Row 1 of each class, and row n/2 + 1 where a class has four or more."""
    w = Window.partitionBy(by)
    d = rows.withColumn("_rn", F.row_number().over(w.orderBy(*order))).withColumn("_n", F.count("*").over(w))
    return d.where((F.col("_rn") == 1) | ((F.col("_n") >= 4) & (F.col("_rn") == F.floor(F.col("_n") / 2) + 1))).drop("_rn", "_n")


def page_yield(items: DataFrame, channel: str = "channel", page: str = "page", url: str = "url", threshold: float = 0.1) -> DataFrame:
    """Rows that a page-by-page scan keeps (E13): each url at its first page; the scan of a channel ends at the first empty page, or after the first page
    whose share of new urls is below the threshold (that page's new rows stay). items: one row per (channel, page, url), empty pages with a null url."""
    w = Window.partitionBy(channel, url)
    d = items.withColumn("_new", F.col(url).isNotNull() & (F.col(page) == F.min(page).over(w)))
    d = d.dropDuplicates([channel, page, url])
    p = d.groupBy(channel, page).agg(F.count(url).alias("_all"), F.count_if("_new").alias("_fresh"))
    back = Window.partitionBy(channel).orderBy(page)
    # stops before an empty page, and behind a page of low yield
    p = p.withColumn("_empty", F.col("_all") == 0).withColumn("_low", (F.col("_all") > 0) & (F.col("_fresh") / F.col("_all") < threshold))
    p = p.withColumn("_stop", F.max(F.col("_empty")).over(back.rowsBetween(Window.unboundedPreceding, 0)) | F.coalesce(F.max("_low").over(back.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False)))
    keep = p.where("NOT _stop").select(channel, page)
    return d.where("_new").join(keep, [channel, page], "left_semi").drop("_new")


def top_n(rows: DataFrame, by: str, n: int) -> DataFrame:
    """(by, n): the most common values."""
    return rows.groupBy(by).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc(by)).limit(n)
