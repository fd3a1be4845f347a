"""Mixing sources to target weights, in DataFrame functions only.

Method: systematic sampling. All documents of a source have the same expected number of copies, target / source size;
these are prefix-summed within the source, one random offset is added, and a document is taken once for each integer
that its interval crosses. One half of the documents (by hash) comes by rising size, then the other half by falling size:
neighbours are alike and both ends are short, so neither the offset nor the large documents pull the words taken from the
target. The prefix sum goes in levels (places in a block, blocks in runs of about a thousand, runs, size bands, halves), so a source
with a third of all rows is spread over as many tasks as its rows need, and no window grows with a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, n_words, row_hash

#: Documents that one block of a source holds, about, and runs of blocks that are summed together (a power of two; three levels of them).
BLOCK_ROWS, FAN = 4_000, 1_024


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, size) rows -> (source, n_docs, source_size, target): one row per source.

    Sources in code-point order, null last, weigh `weights` over and over, and share `share` times all sizes; no target is
    above `most` times its source's size, the excess goes to the others by weight until none is above. That end state is
    min(weight * level, cap) at one common level, which sorted prefix sums give at once. The windows here run over one row
    per source.
    """
    per = sizes.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    one = Window.partitionBy(F.lit(0))
    in_order = one.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(in_order) - 1) % len(weights) + 1).cast("int")))
    per = per.withColumn("_cap", F.col("source_size") * F.lit(float(most))).withColumn("_all", F.sum("source_size").over(one) * F.lit(float(share)))
    by_level = one.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("_all") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_w").over(by_level.rowsBetween(0, Window.unboundedFollowing))
    # the level of the first source, in order of cap / weight, that stays under its cap
    per = per.withColumn("_level", level).withColumn("_free", F.col("_level") < F.col("_cap") / F.col("_w"))
    common = F.min_by(F.when(F.col("_free"), F.col("_level")), F.when(F.col("_free"), F.col("_cap") / F.col("_w"))).over(one)
    target = F.when(common.isNull(), F.col("_cap")).otherwise(F.least(F.col("_cap"), F.col("_w") * common))
    return per.select("source", "n_docs", "source_size", target.alias("target"))


def block_starts(blocks: DataFrame, keys: list[str], fan: int = FAN) -> DataFrame:
    """keys and _before: how many rows stand before each block in its group of keys[0], blocks (keys, _n) in order of the other keys, the last a number from 0.

    Prefix sums in levels: blocks are summed in runs of `fan` of the last key, these again, and so up to the group, so no window holds more
    rows than fan, or than there are values of a key between.
    """
    runs = [F.shiftright(keys[-1], (fan.bit_length() - 1) * k).alias(f"_run{k}") for k in (2, 1, 0)]
    levels = [*keys[:-1], "_run2", "_run1", "_run0"]
    sums = blocks.select(*keys[:-1], *runs, "_n")
    out, names = sums.drop("_n"), []
    for k in range(len(levels) - 1, 0, -1):
        group, last = levels[:k], levels[k]
        names.append(f"_sum{k}")
        before = F.coalesce(F.sum("_n").over(Window.partitionBy(*group).orderBy(last).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        out = out.join(sums.withColumn(names[-1], before).drop("_n"), levels[: k + 1])
        sums = sums.groupBy(*group).agg(F.sum("_n").alias("_n"))
    return out.select(*keys[:-1], F.col("_run0").alias(keys[-1]), sum(map(F.col, names[1:]), F.col(names[0])).alias("_before"))


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 17, size: Column | None = None, keep: list[str] | None = None, block_rows: int | None = None) -> DataFrame:
    """(doc_id, source, size) of docs and the columns `keep` plus source_size, target, copies and taken (= copies * size).

    Reruns agree: order and offsets come from hashes of ids, sources and the seed. A null text has size 0, a null source is
    a source of its own (last); documents of size 0 may be drawn but take no words; a source of size 0 has target 0. Rows
    that repeat an id are told apart by a hash of the text, then by `keep`; rows that are equal in these too by place, at will: each is a document.
    """
    told = row_hash("text") if "text" in docs.columns else F.lit(0).cast("long")  # spreads rows that have no id, or one and the same
    sizes = materialize(docs.select("doc_id", "source", (n_words(F.col("text")) if size is None else size).alias("size"), told.alias("_told"), *(keep or [])))
    targets = source_targets(sizes, weights, share, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    known = sizes.join(targets, sizes["source"].eqNullSafe(targets["source"]), "inner").drop(targets["source"]).withColumn("_rate", rate)
    # a block: documents of about one size, of the larger sources a part by hash
    parts = F.greatest(F.lit(1), F.ceil(F.col("n_docs") / (block_rows or BLOCK_ROWS)))
    half = F.pmod(F.xxhash64("doc_id", F.lit(seed), F.lit("half")), F.lit(2)).cast("int")
    sign = F.when(F.col("_half") == 0, 1).otherwise(-1)
    known = known.withColumn("_half", half).withColumn("_band", (F.floor(F.log2(F.col("size") + 1) * 4) * sign).cast("int")).withColumn("_part", F.pmod(F.xxhash64("doc_id", "_told", F.lit(seed)), parts).cast("long"))
    known = known.withColumn("_src", F.coalesce(F.concat(F.lit("1"), "source"), F.lit("0")))
    block = ["_src", "_half", "_band", "_part"]
    starts = block_starts(materialize(known.groupBy(*block).agg(F.count("*").alias("_n"))), block)
    place = F.row_number().over(Window.partitionBy(*block).orderBy(F.col("size") * sign, F.xxhash64("doc_id", "_told", F.lit(seed)), "doc_id", *(keep or []))) - 1
    placed = known.withColumn("_in", place).join(starts, block)
    rank = F.col("_before") + F.col("_in")
    offset = F.pmod(F.xxhash64(F.coalesce("source", F.lit("")), F.lit(seed), F.col("source").isNull()), F.lit(1 << 40)) / F.lit(float(1 << 40))
    copies = (F.floor((rank + 1) * F.col("_rate") + offset) - F.floor(rank * F.col("_rate") + offset)).cast("int")
    return placed.select("doc_id", "source", "size", *(keep or []), "source_size", "target", copies.alias("copies")).withColumn("taken", F.col("copies") * F.col("size"))


def op2_source_mix(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")
