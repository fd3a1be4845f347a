"""Quality rules with thresholds that follow the corpus.

Method: each whole text is measured once; the measures go into mergeable quantile sketches per language and source
(log-spaced counts with a relative error of 1 %: DDSketch, Masson et al., 2019), merged up to languages and to the whole
corpus; a threshold is a robust upper fence read from the sketch, and the rows are filtered by a join with the
thresholds. The counts merge exactly, in any order, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, slices

#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
WINDOW = 8
#: Log base of the sketch: a bucket holds values within 2 % of each other.
GAMMA = 1.02
#: Sketches of fewer documents lend from the language's, then from the corpus's.
MIN_DOCS = 200
#: Measure -> (upper, lower, spread, least): a document goes when it lies above the upper quantile of its sketch by more than
#: `spread` times the distance between both quantiles, and than the least distance. The quantiles lie high where clean texts
#: have a long tail, and lower where junk is more than the 1 % that it takes to reach the 99 % quantile.
FENCES = {
    "symbols": (0.75, 0.5, 8.0, 0.05),
    "repeats": (0.99, 0.9, 2.0, 0.02),
    "dup_lines": (0.99, 0.9, 2.0, 0.05),
    "shout": (0.99, 0.9, 4.0, 0.005),
    "word_length": (0.75, 0.5, 6.0, 0.5),
}
#: Measures that most texts don't have at all get a two-part sketch: the share of zeros, and the quantiles of the rest. Where more than SPARSE of the texts
#: measure 0, the fence comes from the rest alone. If even a low one of these (first level) is no chance find, but as much as DENSE symbols are in a text of median
#: length, having any is what sets them apart, and the fence is that quantile over MARGIN. Otherwise it is the upper one of the other two levels and twice their distance.
TWO_PART = {"symbols": (0.05, 0.5, 0.95)}
SPARSE, DENSE, MARGIN = 0.5, 10, 2.0
ZERO = -(1 << 20)

_MULT = np.array([0x9E3779B97F4A7C15 * (2 * k + 1) & 0xFFFFFFFFFFFFFFFF | 1 for k in range(WINDOW)], np.uint64)


def repeat_words(words: list[bytes]) -> int:
    """How many words lie in WINDOW-word windows that the text holds twice or more, the first included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    w = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        x = h[k : k + n] * _MULT[k]
        w = (w ^ (x >> np.uint64(29))) + x * np.uint64(0xBF58476D1CE4E5B9)
    order = np.argsort(w)
    s = w[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(words) + 1, np.int32)
    at = np.flatnonzero(twice)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + WINDOW, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def measure(text: str) -> tuple[int, int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines (with a word), n_shout (upper-case words of two letters or more)."""
    words = text.encode().split()  # bytes.split() cuts at the ASCII blanks
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    shout = sum(1 for w in words if len(w) > 1 and w.isupper())
    return (len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeat_words(words), len(lines), shout)


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_shout"]


def with_measures(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of docs and the measures of the text (null: all 0)."""
    keep = docs.columns if keep is None else keep
    keep = [c for c in keep if c not in MEASURES]

    at = keep.index(text_col) if text_col in keep else len(keep)  # a text that is kept goes to the workers once

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [measure(t or "") for t in batch.column(at).to_pylist()]
            out = np.array(rows, np.int64).reshape(-1, len(MEASURES))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *(pa.array(out[:, k]) for k in range(len(MEASURES)))], [*keep, *MEASURES])

    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep] + [f"{c} long" for c in MEASURES])
    return docs.select(*keep, *([] if text_col in keep else [F.col(text_col).alias("__text")])).mapInArrow(run, schema)


def ratios() -> dict:
    """The measures that have thresholds, as columns."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "symbols": F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1)),
        "repeats": F.col("n_repeat_words") / n,
        "dup_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "shout": F.col("n_shout") / n,
        "word_length": F.col("word_chars") / n,
    }


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, level, measure, bucket, n): one sketch per language and source (level 2), language (1) and corpus (0)."""
    buckets = [F.struct(F.lit(m).alias("measure"), F.when(c > 1e-6, F.ceil(F.log(c) / float(np.log(GAMMA)))).otherwise(F.lit(ZERO)).cast("int").alias("bucket")) for m, c in {**ratios(), "word_chars": F.col("word_chars").cast("double")}.items()]
    fine = measured.select("lang", "source", F.explode(F.array(*buckets)).alias("b")).groupBy("lang", "source", "b.measure", "b.bucket").agg(F.count("*").alias("n"))
    return fine.groupingSets(
        [[F.col("lang"), F.col("source"), F.col("measure"), F.col("bucket")], [F.col("lang"), F.col("measure"), F.col("bucket")], [F.col("measure"), F.col("bucket")]],
        "lang", "source", "measure", "bucket",
    ).agg((F.lit(2) - F.when(F.grouping("source") == 1, 1).otherwise(0) - F.when(F.grouping("lang") == 1, 1).otherwise(0)).alias("level"), F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, at: tuple[float, ...] = (0.1, 0.5), rest: tuple[float, ...] = ()) -> DataFrame:
    """(lang, source, level, measure, n_docs, n_zero, q0, q1, …, r0, …): quantiles read from the sketches, q of all values, r of those that aren't 0 (levels `rest`; null if there are none)."""
    key = ["lang", "source", "level", "measure"]
    w = Window.partitionBy(*key)
    run = F.sum("n").over(w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    cum = sketch.withColumn("_run", run).withColumn("_all", F.sum("n").over(w))
    zero = F.col("bucket") == ZERO
    cum = cum.withColumn("_zero", F.coalesce(F.sum(F.when(zero, F.col("n"))).over(w), F.lit(0)))
    value = F.when(zero, 0.0).otherwise(F.pow(F.lit(GAMMA), F.col("bucket")) * 2 / (1 + GAMMA))
    reached = lambda q: ~zero & (F.col("_run") - F.col("_zero") >= (F.col("_all") - F.col("_zero")) * q)
    of_all = [F.min(F.when(F.col("_run") >= F.col("_all") * q, value)).alias(f"q{i}") for i, q in enumerate(at)]
    return cum.groupBy(*key).agg(F.first("_all").alias("n_docs"), F.first("_zero").alias("n_zero"), *of_all, *[F.min(F.when(reached(q), value)).alias(f"r{i}") for i, q in enumerate(rest)])


def thresholds(measured: DataFrame, min_docs: int = MIN_DOCS, fences: dict | None = None) -> DataFrame:
    """(lang, source, max_<measure>…): an upper fence for each language and source that occurs; groups of fewer than min_docs take their language's, or the corpus's."""
    fences = FENCES if fences is None else fences
    at = sorted({x for upper, lower, _, _ in fences.values() for x in (upper, lower)} | {0.5})
    two_part = {m: x for m, x in TWO_PART.items() if m in fences}
    rest = sorted({x for levels in two_part.values() for x in levels})
    q = materialize(quantiles(sketches(measured), tuple(at), tuple(rest)))
    typical = q.where("measure = 'word_chars'").select(*[F.col(c).alias(f"_{c}") for c in ("lang", "source", "level")], F.col(f"q{at.index(0.5)}").alias("_chars"))
    q = q.join(typical, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")) & (F.col("level") == F.col("_level")))
    rules = []
    for m, (upper, lower, spread, least) in fences.items():
        high, low = F.col(f"q{at.index(upper)}"), F.col(f"q{at.index(lower)}")
        rule = high + F.greatest(F.lit(spread) * (high - low), F.lit(least))
        if m in two_part:
            some, middle, most = (F.col(f"r{rest.index(x)}") for x in two_part[m])
            sparse = F.when(some * F.col("_chars") >= DENSE, some / MARGIN).otherwise(most + 2 * (most - middle))
            rule = F.when(F.col("n_zero") > SPARSE * F.col("n_docs"), sparse).otherwise(rule)
        rules.append(F.when(F.col("measure") == m, rule))
    fence = q.withColumn("fence", F.coalesce(*rules))
    wide = fence.groupBy("lang", "source", "level").agg(F.max("n_docs").alias("n"), *[F.max(F.when(F.col("measure") == m, F.col("fence"))).alias(m) for m in fences])
    own = wide.where("level = 2").select("lang", "source", F.col("n").alias("own_n"), *[F.col(m).alias(f"own_{m}") for m in fences])
    lang = wide.where("level = 1").select(F.col("lang").alias("_l"), F.col("n").alias("lang_n"), *[F.col(m).alias(f"lang_{m}") for m in fences])
    every = wide.where("level = 0").select(*[F.col(m).alias(f"all_{m}") for m in fences])
    both = own.join(lang, F.col("lang").eqNullSafe(F.col("_l"))).join(every, F.lit(True))
    pick = lambda m: F.when(F.col("own_n") >= min_docs, F.col(f"own_{m}")).when(F.col("lang_n") >= min_docs, F.col(f"lang_{m}")).otherwise(F.col(f"all_{m}"))
    return both.select("lang", "source", *[pick(m).alias(f"max_{m}") for m in fences])


def judge_quality(docs: DataFrame, min_words: int = 20, max_repeat: int = 30, min_docs: int = MIN_DOCS, fences: dict | None = None, keep: list[str] | None = None, write: bool = True) -> DataFrame:
    """The columns `keep` of docs (doc_id, lang and source at least) with the measures, base_failed and kept.

    base_failed: fewer than min_words words, or more than max_repeat % of the words in repeated windows. kept is false for
    these and for a text that lies above a fence of its language and source. Texts that failed the base don't enter the
    sketches. Null or empty texts measure 0 and fail; null languages and sources are groups like others; each row counts.
    write: the measured rows are written once; if not (for `keep` with texts), docs are read and measured again for the filter.
    """
    fences = FENCES if fences is None else fences
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    names = [c for c in (["doc_id"] if keep is None else keep) if c not in ("base_failed", "kept")]
    groups = ["lang", "source"]
    measured = with_measures(docs, keep=list(dict.fromkeys([*names, *groups]))).withColumn("base_failed", failed)
    if write:
        measured = materialize(measured)
        limits = thresholds(measured.where(~F.col("base_failed")), min_docs, fences)
    else:
        limits = materialize(thresholds(with_measures(docs, keep=groups).withColumn("base_failed", failed).where(~F.col("base_failed")), min_docs, fences))
    t = limits.select(F.col("lang").alias("__lang"), F.col("source").alias("__source"), *[f"max_{m}" for m in fences])
    joined = measured.join(t, measured["lang"].eqNullSafe(t["__lang"]) & measured["source"].eqNullSafe(t["__source"]), "left").drop("__lang", "__source")
    over = F.lit(False)
    for m, c in ratios().items():
        if m in fences:
            over = over | F.coalesce(c > F.col(f"max_{m}"), F.lit(False))
    return joined.withColumn("kept", ~F.col("base_failed") & ~over)


def op4_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = judge_quality(docs, keep=["doc_id", "lang", "source"])
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
