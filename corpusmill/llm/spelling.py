"""Grouping of spelling variants: words that differ by one inserted, deleted or replaced character, the rarer one a form of the much more frequent one.

Method: search schemes over a bidirectional FM-index of the delimited vocabulary. Of two words that are one edit apart, l the length of the
shorter, either the first l // 2 characters are equal or the last l - l // 2 are. So a query of length l matches
  scheme 0: its left half exactly, from its last character to the delimiter before it, then extends to the right and allows one error,
  scheme 1: its right half exactly, from its first character to the delimiter behind it, then extends to the left and allows one error.
Both ranges of suffix ranks, of the text and of the reversed text, are kept in step, so the direction may change at the half. An error is a replaced
or an inserted character; deletions are the insertions of the other word.

On Spark a word is dealt out by scheme, l and half (as the shorter and as the longer word), so a pair meets under one key, and keys are put together into shards of bounded size, with an
index each. A key of more words than a shard holds is cut into parts; each part's queries meet each part's index. A shard sends one row a word: how many are near and the most
frequent of them, never the pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_groups, materialize
from .merkle_manifest import CRC_SQL, crc_sql
from .oracles import AZ

#: Words of one index.
SHARD_WORDS = 12_000
MIN_LENGTH, MIN_COUNT, RATIO = 7, 2, 10
#: Letters of a run: fixed by the contract.
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def damaged(doc_id: Column, run: Column, every: int = 31) -> Column:
    """The run with one code point deleted where `every` divides the crc32 of "<doc_id>:<run>" (the point's place is that crc modulo the length). A null id damages nothing."""
    h = F.crc32(F.concat(doc_id.cast("string"), F.lit(":"), run))
    at = F.pmod(h, F.char_length(run)).cast("int")
    less = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(F.pmod(h, F.lit(every)) == 0, less).otherwise(run)


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, every: int = 31) -> DataFrame:
    """(word, n): maximal runs of letters with only A-Z lower-cased, damaged() as their documents' ids have it, of min_length code points and min_count occurrences at least. Built-in functions; counts combine before the shuffle."""
    runs = F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))  # shorter ones can't become words
    run = docs.select("doc_id", F.explode(runs).alias("run")).select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))
    words = run.select(damaged(F.col("doc_id"), F.col("run"), every).alias("word")).where(F.char_length("word") >= min_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def suffix_order(x: np.ndarray) -> np.ndarray:
    """The suffix array of x (small symbols, the last one smaller than all others and unique): eight symbols at once, then ranks of twice the length."""
    n = len(x)
    pad = np.concatenate([x.astype(np.int64), np.zeros(8, np.int64)])
    key = np.zeros(n, np.int64)
    for k in range(8):
        key = key * 128 + pad[k : n + k]
    width = 8
    while True:
        order = np.argsort(key, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], key[order][1:] != key[order][:-1]]))
        if rank[order[-1]] == n - 1:
            return order
        key = rank * (n + 1) + np.concatenate([rank[width:] + 1, np.zeros(min(width, n), np.int64)])[:n]
        width *= 2


class Side:
    """One direction of the index: suffix array and occurrence counts of the symbols before the suffixes."""

    def __init__(self, x: np.ndarray, symbols: int):
        self.suffixes = suffix_order(x)
        before = x[self.suffixes - 1]
        self.occ = np.zeros((len(x) + 1, symbols), np.int32)
        self.occ[np.arange(1, len(x) + 1), before] = 1
        np.cumsum(self.occ, axis=0, out=self.occ)
        self.start = np.concatenate([[0], np.cumsum(np.bincount(x, minlength=symbols))])[:-1].astype(np.int64)

    def counts(self, lo: np.ndarray, size: np.ndarray) -> np.ndarray:
        """How often each symbol stands before the suffixes of each range."""
        return self.occ[lo + size] - self.occ[lo]


class BidirectionalIndex:
    """FM-index of |word|word|...| and of its reverse; a match is (lo, reversed lo, size): ranges of suffix ranks in both."""

    def __init__(self, words: list[str]):
        """words: distinct, in code-point order."""
        self.words = words
        text = "|".join(["", *words, ""])
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        letters = np.unique(points[points != ord("|")])
        self.letters = letters
        self.symbols = len(letters) + 2
        # an end symbol, unique and least, closes each text; then the delimiter, then the letters
        x = np.where(points == ord("|"), 1, np.searchsorted(letters, points) + 2)
        self.back = Side(np.concatenate([x, [0]]), self.symbols)
        self.forth = Side(np.concatenate([x[::-1], [0]]), self.symbols)
        self.size = len(x) + 1
        self.word_of = np.cumsum(x == 1) - 1  # at a delimiter: the word behind it

    def codes(self, words: list[str]) -> np.ndarray:
        """Words of one length as rows of symbols; letters that the index lacks get -1."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)
        at = np.minimum(np.searchsorted(self.letters, points), max(0, len(self.letters) - 1))
        return np.where(self.letters[at] == points, at + 2, -1) if len(self.letters) else np.full(points.shape, -1)

    def extend(self, side: Side, near: np.ndarray, far: np.ndarray, size: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, ...]:
        """Ranges with one more symbol on a side: `near` is the range there, `far` the one of the other direction, kept in step."""
        known = symbol >= 0
        c = np.where(known, symbol, 0)
        count = side.counts(near, size)
        below = np.where(np.arange(self.symbols) < c[:, None], count, 0).sum(axis=1)
        return side.start[c] + side.occ[near, c], far + below, np.where(known, count[np.arange(len(c)), c], 0).astype(np.int64)

    def step(self, side: Side, near: np.ndarray, size: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """extend() for searches that won't turn again."""
        known = symbol >= 0
        c = np.where(known, symbol, 0)
        a = side.occ[near, c].astype(np.int64)
        return side.start[c] + a, np.where(known, side.occ[near + size, c] - a, 0)

    def one_error(self, codes: np.ndarray, scheme: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, word, whether it is longer) of all words with exactly one error (a replaced or an inserted symbol) in the half that the scheme doesn't match exactly. Words may come more than once."""
        length = codes.shape[1]
        cut = length // 2
        half = codes[:, :cut][:, ::-1] if scheme == 0 else codes[:, cut:]
        rest = codes[:, cut:] if scheme == 0 else codes[:, :cut][:, ::-1]
        first, second = (self.back, self.forth) if scheme == 0 else (self.forth, self.back)
        # the exact half, once for all queries that share it, outward up to the delimiter
        halves, whose = np.unique(half, axis=0, return_inverse=True)
        whose = whose.reshape(-1)
        near, far, size = (np.full(len(halves), k, np.int64) for k in (0, 0, self.size))
        for k in range(halves.shape[1] + 1):
            symbol = halves[:, k] if k < halves.shape[1] else np.ones(len(halves), np.int64)
            near, far, size = self.extend(first, near, far, size, symbol)
        # turned round: the rest with one error
        q = np.flatnonzero(size[whose] > 0)
        exact = (q, far[whose[q]], size[whose[q]])
        wrong = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, bool)]
        for k in range(rest.shape[1] + 1):
            q, lo, n = exact
            at, c = np.nonzero(self.forks(second, lo, n))
            sq, slo, sn = q[at], *self.step(second, lo[at], n[at], c)
            if k == rest.shape[1]:  # behind the last symbol only an insertion is left
                wrong = [np.concatenate(x) for x in zip(wrong, (sq, slo, sn, np.ones(len(sq), bool)))]
                break
            symbol = rest[:, k]
            replaced = c != symbol[sq]
            lo2, n2 = self.step(second, slo, sn, symbol[sq])  # inserted, then the query goes on
            wlo, wn = self.step(second, wrong[1], wrong[2], symbol[wrong[0]])
            parts = [(wrong[0], wlo, wn, wrong[3]), (sq[replaced], slo[replaced], sn[replaced], np.zeros(int(replaced.sum()), bool)), (sq, lo2, n2, np.ones(len(sq), bool))]
            wrong = [np.concatenate(x) for x in zip(*parts)]
            wrong = [x[wrong[2] > 0] for x in wrong]
            lo, n = self.step(second, lo, n, symbol[q])
            exact = tuple(x[n > 0] for x in (q, lo, n))
        q, lo, n, longer = wrong
        lo, n = self.step(second, lo, n, np.ones(len(q), np.int64))
        q, lo, longer = q[n > 0], lo[n > 0], longer[n > 0]
        # a whole word between two delimiters stands in one place; its number is that of the delimiter before it
        at = second.suffixes[lo]
        if scheme == 0:  # in the reversed text the match begins at the delimiter behind the word
            return q, self.word_of[self.size - 2 - at] - 1, longer
        return q, self.word_of[at], longer

    def forks(self, side: Side, lo: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Which letters can follow each range."""
        found = side.counts(lo, n) > 0
        found[:, :2] = False  # neither the end nor the delimiter is a letter
        return found


def near_in_shard(members: list[str], counts: np.ndarray, queries: list[tuple[int, str, int]]) -> tuple[list[str], np.ndarray, list[str], np.ndarray]:
    """(word, number of near words, the most frequent of them (ties: the least), its count) of what meets in a shard.

    members: distinct words in code-point order, with counts. queries: (scheme, word, count); a query finds words of its length or one more,
    and each longer one finds the query.
    """
    index = BidirectionalIndex(members)
    names = sorted({w for _, w, _ in queries} | set(members))
    number = {w: k for k, w in enumerate(names)}
    own = np.array([number[w] for w in members], np.int64)
    n_of = np.zeros(len(names), np.int64)
    n_of[own] = counts
    for _, w, n in queries:
        n_of[number[w]] = n
    pairs = []
    for scheme, length in sorted({(s, len(w)) for s, w, _ in queries}):
        asked = sorted({w for s, w, _ in queries if s == scheme and len(w) == length})
        q, u, longer = index.one_error(index.codes(asked), scheme)
        a, b = np.array([number[w] for w in asked], np.int64)[q], own[u]
        keep = a != b  # an error that restores the word itself
        if scheme == 1:  # equal left halves are found by scheme 0
            cut = length // 2
            keep &= np.fromiter((names[x][:cut] != names[y][:cut] for x, y in zip(a.tolist(), b.tolist())), bool, len(a))
        a, b, longer = a[keep], b[keep], longer[keep]
        pairs += [np.stack([a, b], axis=1), np.stack([b[longer], a[longer]], axis=1)]
    pairs = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)
    a, b = pairs[:, 0], pairs[:, 1]
    order = np.lexsort((b, -n_of[b], a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(a)))
    return [names[k] for k in a[first]], size, [names[k] for k in b[first]], n_of[b[first]]


def near_words(words: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(word, n_near, best, best_n) of (word, n), words of four code points or more: how many are one edit apart, and the most frequent of them (ties: the smallest). Words without any don't come."""
    length = F.char_length("word")
    shorter = F.explode(F.array(length, length - 1)).alias("l")
    keyed = words.select("word", "n", shorter).withColumn("scheme", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("asks", length == F.col("l"))
    cut = F.floor(F.col("l") / 2).cast("int")
    half = F.when(F.col("scheme") == 0, F.substring("word", F.lit(1), cut)).otherwise(F.substring("word", length - F.col("l") + cut + 1, F.col("l") - cut))
    keyed = keyed.withColumn("key", F.xxhash64("scheme", "l", half))
    sizes = materialize(keyed.groupBy("key").agg(F.count("*").alias("_n"), F.count_if("asks").alias("_asks")).where("_n > 1 AND _asks > 0"))
    total = sizes.agg(F.sum("_n")).first()[0] or 0
    n_shards = max(1, -(-total // shard_words))
    parts = F.ceil(F.col("_n") / shard_words).cast("int")
    known = keyed.join(sizes.select("key", parts.alias("parts")), "key").withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    cols = ["word", "n", "scheme"]
    small = known.where("parts = 1").select(F.pmod("key", F.lit(n_shards)).alias("shard"), F.lit(0).cast("long").alias("slot"), F.lit(True).alias("held"), "asks", *cols)
    large = known.where("parts > 1").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    slot = lambda a, b: (F.col(a) * F.col("parts") + F.col(b) + 1).cast("long").alias("slot")
    as_members = large.select(F.col("key").alias("shard"), slot("part", "other"), F.lit(True).alias("held"), (F.col("asks") & (F.col("part") == F.col("other"))).alias("asks"), *cols)
    as_queries = large.where("asks AND part <> other").select(F.col("key").alias("shard"), slot("other", "part"), F.lit(False).alias("held"), F.lit(True).alias("asks"), *cols)

    def solve(t: pa.Table) -> pa.RecordBatch | None:
        rows = list(zip(*(t[k].to_pylist() for k in ("held", "asks", "scheme", "word", "n"))))
        held = {w: n for h, _, _, w, n in rows if h}
        queries = [(s, w, n) for _, asks, s, w, n in rows if asks]
        if not held or not queries:
            return None
        members = sorted(held)
        word, near, best, best_n = near_in_shard(members, np.array([held[w] for w in members], np.int64), queries)
        return pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(near.astype(np.int64)), pa.array(best, pa.string()), pa.array(best_n)], ["word", "n_near", "best", "best_n"])

    # a number of tasks that follows the work: these rows are small but take long, so they mustn't be gathered by size
    tasks = min(n_shards, max(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_shards // 4))
    found = map_groups(small.unionByName(as_members).unionByName(as_queries), ["shard", "slot"], solve, "word string, n_near long, best string, best_n long", partitions=tasks)
    best = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w"))).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", F.col("b.w").alias("best"), (-F.col("b.m")).alias("best_n"))


def spelling_variants(words: DataFrame, ratio: int = RATIO, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of distinct (word, n): a word's form is its most frequent near word (ties: the smallest) where that is `ratio` times as frequent
    at least; root follows forms to the last. Chains are short, for each step is `ratio` times as frequent; pointers are doubled over written tables."""
    words = materialize(words)
    near = materialize(near_words(words, shard_words))
    own = materialize(words.join(near, "word", "left").withColumn("_is", F.coalesce(F.col("best_n") >= F.lit(ratio) * F.col("n"), F.lit(False))))
    forms = own.where("_is").select("word", F.col("best").alias("to"))
    now = materialize(forms)
    while True:
        ahead = now.select(F.col("word").alias("_w"), F.col("to").alias("_t"))
        now = materialize(now.select("word", "to").join(ahead, F.col("to") == F.col("_w"), "left").select("word", F.coalesce("_t", "to").alias("to"), F.col("_t").isNotNull().alias("moved")))
        if not now.where("moved").limit(1).count():
            break
    form = F.when(F.col("_is"), F.col("best")).alias("form")
    out = own.join(now.select("word", F.col("to").alias("_root")), "word", "left")
    return out.select("word", form, F.coalesce("_root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("_is"), F.col("best_n")).alias("form_n"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return spelling_variants(vocabulary(docs))


_BYTES = "flatten(list_transform(string_split(CAST(doc_id AS VARCHAR) || ':' || r, ''), lambda x: CASE WHEN ord(x) < 128 THEN [CAST(ord(x) AS BIGINT)] ELSE [CAST(192 + (ord(x) >> 6) AS BIGINT), CAST(128 + (ord(x) & 63) AS BIGINT)] END))"

OP13_SQL = rf"""
WITH RECURSIVE {CRC_SQL.strip()}, t AS (
  SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS r FROM documents
), c AS (
  SELECT doc_id, translate(r, {AZ}) AS r, count(*) AS k FROM t WHERE length(r) >= 7 GROUP BY ALL
), h AS (
  SELECT r, k, {crc_sql(_BYTES)} AS h FROM c, crc_table
), w AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word, k FROM h
), v AS (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM w WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2
), p AS (
  SELECT word, n, u.i, substr(word, 1, u.i - 1) AS a, substr(word, u.i + 1) AS b FROM v, unnest(range(1, length(word) + 1)) AS u(i)
), pairs AS (
  SELECT x.word, y.word AS other, y.n AS m FROM p x JOIN p y ON x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION
  SELECT x.word, v.word, v.n FROM p x JOIN v ON x.a || x.b = v.word
  UNION
  SELECT v.word, x.word, x.n FROM p x JOIN v ON x.a || x.b = v.word
), best AS (
  SELECT word, count(*) AS n_near, max(m) AS m, arg_min(other, (-m, other)) AS other FROM pairs GROUP BY word
), f AS (
  SELECT v.word, CASE WHEN m >= 10 * n THEN other END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * n THEN m END AS form_n FROM v LEFT JOIN best ON v.word = best.word
), chain(word, pos, k) AS (
  SELECT word, word, 0 FROM f UNION ALL SELECT c.word, f.form, k + 1 FROM chain c JOIN f ON c.pos = f.word WHERE f.form IS NOT NULL
), roots AS (
  SELECT word, arg_max(pos, k) AS root FROM chain GROUP BY word
)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN roots ON f.word = roots.word
"""
