"""N-gram Jaccard join, exact, with signature trees.

1. Deal out. Two sets that link have at most H = (1 - t) / (1 + t) * (|A| + |B|) elements that only one of them holds. For each
   class of sizes, cut the hash space into H + 1 + s parts: at least s + 1 parts are the same in both (PartEnum, Arasu et al., 2006).
   Every set sends a hash of each part, for its own class and the next. Texts that quote one passage have a part or two in common by
   chance, so one equal hash is no loose link yet: a pair needs as many as its sizes demand (see needed), counted for all
   pairs under hashes of few sets. Hashes of many sets are only counted by set; sets with so many of those that they alone may
   be enough are linked to the first one of the hash. So the number of loose links is linear however large a group of copies
   is, and none is lost. Light parts, of one
   element or none, would tie strangers together; they are sent only by sets with more than s of them: a pair that links
   has s + 1 equal parts, and if one side has at most s light ones, a heavier one is among them, and is as heavy on the
   other side. (At thresholds where light parts are the rule, only empty ones count as light.)
2. Loose components, of each class by itself, are dealt into blocks of some hundreds of sets (a component stays whole: few chance
   members, and groups near each other); very large ones are cut into pairs of blocks.
3. In a block, a signature tree: leaves hold a bitmap of a set's hashed elements, nodes the OR of their leaves' bitmaps and the
   range of their sizes; the sets stand in order of their components, so that a node's leaves are alike and its bitmap stays
   thin. Two trees (or one with itself) are walked together; a pair of nodes is dropped when its greatest
   possible overlap can't reach the threshold, or when its documents are in one component already. What is left is
   compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_groups, materialize, mix64, row_hash, slices
from .graph import connected_components

#: Sets of one block of the join; larger loose components are joined in pairs of blocks. Sets that smaller components bring into a block, about.
BLOCK_DOCS, SHARED_DOCS = 1_000, 400
#: Elements up to which a set counts as one; larger ones count as so many more, so that a block is bounded in elements too (160 MB of hashes).
SET_ELEMENTS = 20_000
#: Least and most bits of a signature (powers of two; a tree takes about eight for an element of its largest set).
MIN_BITS, MAX_BITS = 512, 1 << 16
FAN = 16
#: Sets that a task remembers to have sent.
SENT_SETS = 200_000
#: Sets of one part's hash up to which all their pairs are counted; pairs that a task counts before it hands them on.
BUCKET_SETS, COUNTED_PAIRS = 16, 1_000_000

_MULT = np.array([0x9E3779B97F4A7C15 * (2 * k + 3) & 0xFFFFFFFFFFFFFFFF | 1 for k in range(16)], np.uint64)


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word n-grams (A-Z lower-cased); fewer words: one hash of the whole sequence."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b"\x00".join([b"short", *words]))], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - width + 1
    s = np.zeros(n, np.uint64)
    for k in range(width):
        x = h[k : k + n] * _MULT[k]
        s = (s ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93) + x
    return np.unique(mix64(s))


def class_ends(threshold: int, top: int) -> list[int]:
    """Upper ends of the classes of set sizes up to `top` and two beyond."""
    ends, low = [], 1
    while len(ends) < 3 or ends[-3] < top:
        ends.append(max(low, low * 100 // threshold))
        low = ends[-1] + 1
    return ends


def differing(sizes: int, threshold: int) -> int:
    """Most elements that only one of two sets of so many elements together holds, if they link."""
    return sizes * (100 - threshold) // (100 + threshold)


def spare(differ: int) -> int:
    """Parts of a class beyond those that its slack needs: so many equal ones more than one has every pair that links."""
    return max(2, differ // 12) if differ else 0


class SizeClasses:
    """Classes of set sizes up to `top` and two beyond: upper ends, parts, slack s, and up to how many elements a part is light."""

    def __init__(self, threshold: int, top: int):
        ends = class_ends(threshold, top)
        lows = [1, *(e + 1 for e in ends[:-1])]
        self.ends = np.array(ends, np.int64)
        self.parts, self.slack, self.light = [], [], []
        for c, r in enumerate(ends):
            differ = differing(2 * r, threshold)
            more = spare(differ)
            least = lows[max(0, c - 1)]  # the smallest sets that are sent to this class
            # the smallest slack that lets most sets keep their light parts to themselves (any slack loses no pair)
            slack, light = (differ + 1) // 10 + 4, 0
            for s in range(2, (differ + 1) // 5 + 6):
                each = least / (differ + 1 + s + more)
                expected = (differ + 1 + s + more) * np.exp(-each) * (1 + each)
                if expected + 2 * np.sqrt(expected) <= s:
                    slack, light = s, 1
                    break
            if differ == 0:
                slack, light = 0, 0
            self.parts.append(differ + 1 + slack + more)
            self.slack.append(slack)
            self.light.append(light)


#: The class stands in the upper bits of a key.
CLASS_SHIFT = 54


def part_keys(h: np.ndarray, classes: SizeClasses) -> np.ndarray:
    """Keys of the parts of a set (class and a hash of the part's number and elements), for its own size class and the next one."""
    own = int(np.searchsorted(classes.ends, len(h)))
    out = []
    for c in (own, own + 1):
        n, slack = classes.parts[c], classes.slack[c]
        part = ((h >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)  # h is sorted, so part is too
        filled, start, size = np.unique(part, return_index=True, return_counts=True)
        total = np.add.reduceat(mix64(h + np.uint64(0x5851F42D4C957F2D)), start)
        keys = mix64(total ^ mix64(filled.astype(np.uint64) + np.uint64(1)))
        heavy = size > classes.light[c]
        if n - int(heavy.sum()) > slack:
            empty = np.setdiff1d(np.arange(n), filled)
            keys = np.concatenate([keys, mix64(mix64(empty.astype(np.uint64) + np.uint64(1)))])
        else:
            keys = keys[heavy]
        out.append((keys >> np.uint64(64 - CLASS_SHIFT)) | np.uint64(c << CLASS_SHIFT))
    return np.concatenate(out)


def set_sizes(rows: DataFrame, width: int) -> DataFrame:
    """(doc_id, row, n_shingles, node) of (doc_id, row, text): the size of each row's set and a 64-bit hash of the set, null for the empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n, node = [], []
            for t in batch.column(2).to_pylist():
                h = shingle_hashes(t, width)
                n.append(len(h))
                node.append(set_node(h) if len(h) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(node, pa.int64())], ["doc_id", "row", "n_shingles", "node"])

    return rows.mapInArrow(run, "doc_id long, row long, n_shingles long, node long")


def set_node(h: np.ndarray) -> int:
    """The node that stands for a set in the graph: equal sets are one."""
    return xxhash.xxh3_64_intdigest(h.tobytes()) - (1 << 63)


def needed(cls: Column, sizes: Column, threshold: int) -> Column:
    """Least number of equal keys of a class that two sets of so many elements together have, if they link and the larger is of that class.

    Of the class's parts, at most as many differ as elements do, and at most `slack` equal ones are light and kept back by one side.
    """
    differ = [differing(2 * r, threshold) for r in class_ends(threshold, 1 << 31)]  # no text has more shingles
    most = F.get(F.array(*[F.lit(d + 1 + spare(d)).cast("long") for d in differ]), cls.cast("int"))
    return most - F.floor(sizes * (100 - threshold) / (100 + threshold))


def loose_links(texts: DataFrame, sizes: DataFrame, width: int, threshold: int) -> DataFrame:
    """(cls, src, dst) links between the nodes of sets with enough equal parts, in each class a superset of the connectivity of the true links whose larger set is of that class.

    sizes: (node, n_shingles), a row for each set.
    """
    keys = texts.mapInArrow(_keys_of(width, threshold), "key long, node long")
    met = materialize(keys.repartition("key").sortWithinPartitions("key", "node").mapInArrow(_meetings, "cls long, a long, b long, key long, n long"))
    pairs = met.where("b IS NOT NULL").groupBy("cls", "a", "b").agg(F.sum("n").alias("x"))
    many = met.where("b IS NULL").select("cls", "key", F.col("a").alias("node")).distinct()
    size = lambda end: sizes.select(F.col("node").alias(end), F.col("n_shingles").alias(f"n_{end}"))
    # hashes of many sets, by set; where they alone may be enough for some other set, the set is hot
    largest = F.least(F.floor(F.col("n_node") * 100 / threshold), F.get(F.array(*[F.lit(e).cast("long") for e in class_ends(threshold, 1 << 31)]), F.col("cls").cast("int")))
    held = many.groupBy("cls", "node").agg(F.count("*").alias("y")).join(size("node"), "node")
    held = materialize(held.select("cls", "node", "y", (F.col("y") >= needed(F.col("cls"), F.col("n_node") + largest, threshold)).alias("hot")))
    y = lambda end: held.select("cls", F.col("node").alias(end), F.col("y").alias(f"y_{end}"))
    pairs = pairs.join(size("a"), "a").join(size("b"), "b").join(y("a"), ["cls", "a"], "left").join(y("b"), ["cls", "b"], "left")
    both = F.least(F.coalesce("y_a", F.lit(0)), F.coalesce("y_b", F.lit(0)))
    near = pairs.where(F.col("x") + both >= needed(F.col("cls"), F.col("n_a") + F.col("n_b"), threshold)).select("cls", F.col("a").alias("src"), F.col("b").alias("dst"))
    hot = many.join(held.where("hot").select("cls", "node"), ["cls", "node"]).select("key", "node")
    stars = hot.repartition("key").sortWithinPartitions("key", "node").mapInArrow(_stars, "cls long, src long, dst long")
    return near.unionByName(stars).distinct()


def _class_of(key: np.ndarray) -> np.ndarray:
    return (key.view(np.uint64) >> np.uint64(CLASS_SHIFT)).astype(np.int64)


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, node) in order -> (cls, a, b, null, n): pairs of sets and how many keys of few sets both have; (cls, a, null, key, null): the sets of keys of many."""
    names = ["cls", "a", "b", "key", "n"]
    nothing = lambda n: pa.nulls(n, pa.int64())
    counted: list[np.ndarray] = []
    waiting = 0

    def pairs() -> Iterator[pa.RecordBatch]:
        if counted:
            found = np.concatenate(counted, axis=1)
            counted.clear()
            c, a, b = found.view(np.uint64)
            found = found[:, np.argsort(mix64(mix64(a + c) + b))]  # equal pairs together; where strangers share a hash, a pair may come in two rows
            start = np.flatnonzero(np.concatenate([[True], (found[:, 1:] != found[:, :-1]).any(axis=0)]))
            n = np.diff(np.append(start, found.shape[1]))
            yield pa.RecordBatch.from_arrays([*map(pa.array, found[:, start]), nothing(len(n)), pa.array(n)], names)

    def of_many(key: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(_class_of(key)), pa.array(node), nothing(len(key)), pa.array(key), nothing(len(key))], names)

    none = np.zeros(0, np.int64)
    held = (none, none)  # the last run, which the next batch may go on with
    last = None  # the key of that run, if it is one of many sets that have been handed on
    for batch in _and_end(batches):
        if batch is not None:
            if not batch.num_rows:
                continue
            k, d = (np.concatenate([h, batch.column(c).to_numpy()]) for c, h in enumerate(held))
        else:
            k, d = held
        if not len(k):
            continue
        if last is not None:
            more = int(np.searchsorted(k, last, "right"))  # keys ascend
            if more:
                yield of_many(k[:more], d[:more])
            k, d = k[more:], d[more:]
            if not len(k):
                held = (none, none)
                continue
            last = None
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
        k, d = k[new], d[new]  # copies of a set that several tasks sent
        end = len(k)
        if batch is not None:
            end = int(np.searchsorted(k, k[-1], "left"))
            if len(k) - end > BUCKET_SETS:
                last, held = k[-1], (none, none)
                yield of_many(k[end:], d[end:])
            else:
                held = (k[end:], d[end:])
        k, d = k[:end], d[:end]
        start = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if end else none
        size = np.diff(np.append(start, end))
        each = np.repeat(size, size)
        if (each > BUCKET_SETS).any():
            yield of_many(k[each > BUCKET_SETS], d[each > BUCKET_SETS])
        few = (each > 1) & (each <= BUCKET_SETS)
        k, d = k[few], d[few]
        for far in range(1, min(BUCKET_SETS, len(k))):
            same = np.flatnonzero(k[far:] == k[:-far])
            if not len(same):
                break
            counted.append(np.stack([_class_of(k[same]), d[same], d[same + far]]))
            waiting += len(same)
        if waiting > COUNTED_PAIRS:
            yield from pairs()
            waiting = 0
    yield from pairs()


def _and_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    """The batches, then None."""
    yield from batches
    yield None


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, node) in order -> (cls, src, dst): each set with the first one of its key."""
    key, first = None, None  # of the run that the last batch ended with
    for batch in batches:
        if not batch.num_rows:
            continue
        k, d = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        new = np.ones(len(k), bool)
        new[1:] = k[1:] != k[:-1]
        new[0] = key is None or k[0] != key
        at = np.maximum.accumulate(np.where(new, np.arange(len(k)), -1))
        head = np.where(at >= 0, d[np.maximum(at, 0)], first if first is not None else 0)
        far = ~new & (d != head)
        key, first = k[-1], head[-1]
        if far.any():
            pairs = np.unique(np.stack([_class_of(k[far]), d[far], head[far]]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in pairs], ["cls", "src", "dst"])


def _keys_of(width: int, threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = SizeClasses(threshold, 1 << 16)
        sent: set[int] = set()  # copies of a set send nothing new; forgotten from time to time, which only repeats rows
        for batch in batches:
            for at in range(0, batch.num_rows, 500):  # many rows come from one document
                ids, keys = [], []
                for t in batch.column(0)[at : at + 500].to_pylist():
                    h = shingle_hashes(t, width)
                    if not len(h) or (node := set_node(h)) in sent:
                        continue
                    sent.add(node)
                    if len(h) > classes.ends[-2]:
                        classes = SizeClasses(threshold, 2 * len(h))
                    p = part_keys(h, classes)
                    keys.append(p)
                    ids.append(np.full(len(p), node, np.int64))
                if keys:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(ids))], ["key", "node"])
                if len(sent) > SENT_SETS:
                    sent.clear()

    return run


class Forest:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, a: int) -> int:
        up = self.up
        while up[a] != a:
            up[a] = up[up[a]]
            a = up[a]
        return a

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


class SignatureTree:
    """Sets in order of likeness and size; level 0 holds each set's bitmap, the levels above the OR of FAN nodes below."""

    def __init__(self, sets: list[np.ndarray], ids: list[int], width: int = MIN_BITS):
        self.sets, self.ids = sets, ids  # ids: places in the forest; width: bits of a signature
        n = len(sets)
        bits = np.zeros((n, width // 64), np.uint64)
        for k, s in enumerate(sets):
            b = (s & np.uint64(width - 1)).astype(np.int64)
            np.bitwise_or.at(bits[k], b >> 6, np.uint64(1) << (b & 63).astype(np.uint64))
        size = np.array([len(s) for s in sets], np.int64)
        extra = size - np.bitwise_count(bits).sum(axis=1).astype(np.int64)  # elements beyond one a bit
        self.levels = [(bits, size, size, extra)]
        while len(self.levels[-1][1]) > FAN:
            bits, low, high, extra = self.levels[-1]
            cut = np.arange(0, len(low), FAN)
            self.levels.append((np.bitwise_or.reduceat(bits, cut, axis=0), np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut), np.maximum.reduceat(extra, cut)))


def possible(x: tuple, y: tuple, threshold: int) -> np.ndarray:
    """Which pairs of nodes (rows of x by rows of y) may hold a pair of sets that reaches the threshold."""
    (xb, xl, xh, xe), (yb, yl, yh, ye) = x, y
    most = np.bitwise_count(xb[:, None, :] & yb[None, :, :]).sum(axis=2).astype(np.int64) + np.minimum(xe[:, None], ye[None, :])
    most = np.minimum(most, np.minimum(xh[:, None], yh[None, :]))
    least = threshold * (xl[:, None] + yl[None, :])  # |A & B| * (100 + t) >= t * (|A| + |B|)
    return ((100 + threshold) * most >= least) & (100 * xh[:, None] >= threshold * yl[None, :]) & (100 * yh[None, :] >= threshold * xl[:, None])


def similar(a: np.ndarray, b: np.ndarray, threshold: int) -> bool:
    if 100 * min(len(a), len(b)) < threshold * max(len(a), len(b)):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return 100 * both >= threshold * (len(a) + len(b) - both)


def tree_join(left: SignatureTree, right: SignatureTree, threshold: int, forest: Forest) -> list[tuple[int, int]]:
    """Links that join components, found by walking both trees together (left may be right)."""
    found: list[tuple[int, int]] = []
    same = left is right
    top = min(len(left.levels), len(right.levels)) - 1

    def part(tree: SignatureTree, level: int, k: int) -> tuple[slice, tuple]:
        s = slice(k * FAN, min((k + 1) * FAN, len(tree.levels[level][1])))
        return s, tuple(x[s] for x in tree.levels[level])

    def roots(tree: SignatureTree, level: int, k: int) -> set[int]:
        return {forest.root(i) for i in tree.ids[k * FAN ** level : (k + 1) * FAN ** level]}

    stack = []
    full_l, full_r = left.levels[top], right.levels[top]
    ok = possible(full_l, full_r, threshold)
    stack = [(top, int(i), int(j)) for i, j in zip(*np.nonzero(ok)) if not same or i <= j][::-1]
    stack.sort(key=lambda x: -(x[2] - x[1]) if same else 0)  # nodes with themselves first
    while stack:
        level, i, j = stack.pop()
        if level == 0:
            if same and i == j:
                continue
            a, b = left.ids[i], right.ids[j]
            if forest.root(a) != forest.root(b) and similar(left.sets[i], right.sets[j], threshold):
                forest.join(a, b)
                found.append((a, b))
            continue
        if len(own := roots(left, level, i) | roots(right, level, j)) == 1 and own:
            continue
        (si, x), (sj, y) = part(left, level - 1, i), part(right, level - 1, j)
        ok = possible(x, y, threshold)
        below = [(level - 1, si.start + int(p), sj.start + int(q)) for p, q in zip(*np.nonzero(ok)) if not same or si.start + p <= sj.start + q]
        below.sort(key=lambda t: t[1] != t[2])
        stack.extend(below[::-1])
    return found


def block_links(table: pa.Table, threshold: int) -> pa.RecordBatch | None:
    """Links of one block, or of one pair of blocks: rows (node, component, side, hashes), sides 0 and 1 in pairs of blocks."""
    once = np.unique(table["node"].to_numpy(), return_index=True)[1]  # rows that are equal in everything come several times
    ids, side = table["node"].to_numpy()[once], table["side"].to_numpy()[once]
    sets = [np.frombuffer(table["hashes"][int(k)].as_py(), np.uint64) for k in once]
    part = table["component"].to_numpy()[once]
    order = np.lexsort((ids, [len(x) for x in sets], part)).tolist()
    forest = Forest(len(ids))
    width = MIN_BITS
    while width < MAX_BITS and width < 8 * max(map(len, sets)):
        width *= 2
    tree = [SignatureTree([sets[k] for k in order if side[k] == s], [k for k in order if side[k] == s], width) for s in (0, 1) if (side == s).any()]
    links = tree_join(tree[0], tree[-1], threshold, forest) if len(tree) == 2 or (side == 0).all() else []
    if not links:
        return None
    a, b = np.array(links).T
    return pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b])], ["src", "dst"])


def jaccard_rows(docs: DataFrame, width: int = 4, threshold: int = 85, block_docs: int = BLOCK_DOCS, row: Column | None = None) -> DataFrame:
    """(doc_id, row, n_shingles, component_id, first) of (doc_id, text): two rows link when 100 * |A & B| >= threshold * |A | B|.

    Each row counts by itself, whether its id is null or repeated. component_id is the smallest doc_id reachable by links, the own one
    included; a null id is larger than all others (null where no row has one). row: a hash that tells rows of one id apart (of the text, if
    not given); first: the row has the smallest (id, row) of its component. Null and empty texts have an empty set and link with
    nothing: their own component, first. Equal sets are one node of the graph, however many rows have them.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (row_hash("text") if row is None else row).alias("row"), "text")
    sizes = materialize(set_sizes(texts, width))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("rep")
    found = materialize(sizes.where("node IS NOT NULL").groupBy("node").agg(least, F.max("n_shingles").alias("n_shingles")).select("node", "rep.*", "n_shingles"))
    nodes, reps = found.select("node", "n_shingles"), found.select("node", "none", "doc_id", "row", F.ceil(F.col("n_shingles") / SET_ELEMENTS).alias("weight"))
    # loose components of each class: their nodes are (class, set), told by a hash (a collision would only widen a block)
    links = materialize(loose_links(texts.select("text"), nodes, width, threshold))
    node = lambda c: F.xxhash64("cls", c)
    loose = connected_components(links.select(node("src").alias("src"), node("dst").alias("dst"))).withColumnRenamed("node", "_n")
    held = links.select("cls", F.explode(F.array("src", "dst")).alias("node")).distinct()
    single = materialize(held.join(loose, node("node") == F.col("_n")).select("node", "component"))
    weighed = single.join(reps.select("node", "weight"), "node")
    count = materialize(weighed.groupBy("component").agg(F.sum("weight").alias("n")).withColumn("blocks", F.ceil(F.col("n") / block_docs).cast("int")))
    shared = max(1, (count.where("blocks = 1").agg(F.sum("n")).first()[0] or 0) // SHARED_DOCS)
    block = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("component"), F.lit(shared))).otherwise(F.xxhash64("component"))
    members = single.join(count.select("component", "blocks", block.alias("block")), "component").withColumn("own", F.pmod(F.xxhash64("node", F.lit(5)), "blocks").cast("int"))
    pairs = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(o, "own").alias("a"), F.greatest(o, "own").alias("b"))))
    dealt = members.select("node", "component", "block", "own", pairs.alias("p")).select("node", "component", "block", "p.a", "p.b", F.when((F.col("own") == F.col("p.a")), 0).otherwise(1).alias("side"))
    # the text of a set is that of its smallest row
    wanted = dealt.join(reps.drop("weight"), "node").select("node", "component", "block", "a", "b", "side", F.coalesce("doc_id", F.lit(0)).alias("_at"), F.col("row").alias("_row"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 200):
            text, last = batch.column(6).to_pylist(), (None, b"")
            h = [(last := last if t == last[0] else (t, shingle_hashes(t, width).tobytes()))[1] for t in text]
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(h, pa.binary())], ["block", "component", "a", "b", "side", "node", "hashes"])

    # both sides grow with the corpus, so neither is broadcast
    placed = texts.join(wanted.hint("merge"), (F.coalesce("doc_id", F.lit(0)) == F.col("_at")) & (F.col("row") == F.col("_row"))).select("block", "component", "a", "b", "side", "node", "text")
    rows = placed.mapInArrow(hashed, "block long, component long, a int, b int, side int, node long, hashes binary")
    found = materialize(connected_components(map_groups(rows, ["block", "a", "b"], lambda t: block_links(t, threshold), "src long, dst long")))
    # the smallest row of each component, by set
    linked = found.join(reps, "node")
    smallest = materialize(linked.groupBy("component").agg(F.min(F.struct("none", "doc_id", "row")).alias("rep")))
    of_set = reps.join(found.join(smallest, "component").select("node", F.col("rep").alias("top")), "node", "left")
    of_set = materialize(of_set.select("node", F.coalesce("top", F.struct("none", "doc_id", "row")).alias("rep")).select("node", F.col("rep.doc_id").alias("component_id"), F.col("rep.row").alias("_top")))
    some = sizes.where("node IS NOT NULL").join(of_set, "node")
    first = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("row") == F.col("_top"))
    none = sizes.where("node IS NULL").select("doc_id", "row", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("first"))
    return some.select("doc_id", "row", "n_shingles", "component_id", first.alias("first")).unionByName(none)


def jaccard_components(docs: DataFrame, width: int = 4, threshold: int = 85, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(doc_id, n_shingles, component_id) of (doc_id, text), a row for each of docs (see jaccard_rows)."""
    return jaccard_rows(docs, width, threshold, block_docs).select("doc_id", "n_shingles", "component_id")


def op10_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return jaccard_components(docs, width=4, threshold=85)
