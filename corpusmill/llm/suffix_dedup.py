"""Removal of long repeats: each byte that a SPAN-byte string covers which also starts earlier in the corpus.

Suffixes of a whole corpus don't fit a task, so they are dealt out by content first:

1. Anchors (winnowing, Schleimer et al., 2003). Of the GRAM-byte strings inside a SPAN-byte string the one of the least hash is its
   anchor, so equal SPAN-byte strings have equal anchors at equal places. A run of starts with one anchor is a segment: a row of hashes
   and places. Segments are dealt out by the anchor's hash; anchors that occur once are done. Equal segments but the first
   are repeats as a whole; no text is needed for them, however many there are. Those that repeat inside a buffer of documents are
   found where they are read, so a passage in many copies costs a row per buffer.
2. What is left are different segments around the same anchor (ends of copied passages, edited copies). Their texts meet in blocks, where
   a suffix array decides, made in two stages (Itoh and Tanaka, 1999): suffixes smaller than their successors are sorted
   directly, all others are induced by a scan over the buckets of first bytes. Then the common prefixes of neighbours are
   taken; a run of SPAN or more holds the equal strings, of which the first start stays.
   Anchors with very many different segments go another way: a hash per start, whose first occurrence a combining
   aggregation finds.
3. Places go back to their documents, and the bytes are cut out there.

A place is (doc_id, row, start); row is a 64-bit hash of the text, so rows that repeat an id with other texts are texts of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BYTE_HASH, group_starts, materialize, mix64, powers, row_hash

SPAN, GRAM = 100, 32
#: Bytes of one block of suffixes, of the buffer in which documents are hashed, and different segments from which an anchor goes by hashes.
BLOCK_BYTES, BUFFER_BYTES, HOT_SEGMENTS = 4_000_000, 1_000_000, 5_000
#: Repeated kinds of segments that a task remembers.
COMMON_KINDS = 100_000
KIND = np.dtype([("anchor", np.int64), ("whole", np.int64)])
PLACE = np.dtype([("doc", np.int64), ("row", np.int64), ("start", np.int32)])


def segments(texts: list[bytes], span: int = SPAN, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text number, start, length in starts, anchor hash, segment hash) of all segments of the texts."""
    sizes = np.array([len(t) for t in texts], np.int64)
    raw = np.frombuffer(b"".join(texts), np.uint8)
    n = len(raw)
    if n < span or not (sizes >= span).any():
        z = np.zeros(0, np.int64)
        return z, z, z, z, z
    value = BYTE_HASH[raw]
    forward, back = powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(value * forward[:n], dtype=np.uint64, out=total[1:])
    h = mix64((total[gram:] - total[:-gram]) * back[: n - gram + 1])
    low = np.uint64((1 << 32) - 1)  # the same width at every size, so that equal strings choose equal anchors in all buffers
    m = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    width, window = 1, span - gram + 1
    while 2 * width <= window:
        m = np.minimum(m[:-width], m[width:])
        width *= 2
    if width < window:
        m = np.minimum(m[: len(m) - (window - width)], m[window - width :])
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(texts)), sizes)[: len(m)]
    valid = np.arange(len(m)) + span <= ends[owner]
    new = np.ones(len(m), bool)
    new[1:] = (m[1:] != m[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new & valid)
    stop = np.flatnonzero(new | ~valid)
    nxt = np.append(stop, len(m))[np.searchsorted(stop, first, side="right")]
    count = nxt - first
    anchor = h[(m[first] & low).astype(np.int64)]
    whole = mix64((total[nxt + span - 1] - total[first]) * back[first]) + count.astype(np.uint64)
    who = owner[first]
    return who, first - (ends - sizes)[who], count, anchor.view(np.int64), mix64(whole).view(np.int64)


def _buffers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list[bytes]]]:
    for batch in batches:
        ids, rows, texts, held = [], [], [], 0
        for i, r, t in zip(*(batch.column(k).to_pylist() for k in range(3))):
            b = t.encode("utf-8", "surrogatepass") if t else b""
            if held and held + len(b) > BUFFER_BYTES:
                yield ids, rows, texts
                ids, rows, texts, held = [], [], [], 0
            ids.append(i)
            rows.append(r)
            texts.append(b)
            held += len(b)
        if ids:
            yield ids, rows, texts


class Common:
    """The kinds of segments that repeated inside a buffer, with their first places: later buffers of the task needn't send them again. Bounded: the latest ones."""

    def __init__(self):
        self.names, self.places = np.zeros(0, KIND), np.zeros(0, PLACE)

    def later(self, names: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Which rows have an earlier place known for their kind."""
        if not len(self.names):
            return np.zeros(len(names), bool)
        at = np.minimum(np.searchsorted(self.names["whole"], names["whole"]), len(self.names) - 1)
        hit = self.names[at] == names
        out = np.zeros(len(names), bool)
        out[hit] = _before(self.places[at[hit]], places[hit])
        return out

    def add(self, names: np.ndarray, places: np.ndarray) -> None:
        names, places = np.concatenate([names, self.names])[:COMMON_KINDS], np.concatenate([places, self.places])[:COMMON_KINDS]
        _, first = np.unique(names["whole"], return_index=True)  # sorted; of two with one hash the newer stays
        self.names, self.places = names[first], places[first]


def _before(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a["doc"] < b["doc"]) | (a["doc"] == b["doc"]) & ((a["row"] < b["row"]) | (a["row"] == b["row"]) & (a["start"] < b["start"]))


def segment_rows(docs: DataFrame, span: int, gram: int) -> DataFrame:
    """(anchor, whole, doc_id, row, start, n, again) of (doc_id, row, text): a row per segment; again: the task has seen an equal one that is earlier (such rows get a key of their own)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = Common()
        for ids, rows, texts in _buffers(batches):
            who, start, count, anchor, whole = segments(texts, span, gram)
            if len(who):
                place, name = np.zeros(len(who), PLACE), np.zeros(len(who), KIND)
                place["doc"], place["row"], place["start"] = np.array(ids, np.int64)[who], np.array(rows, np.int64)[who], start
                name["anchor"], name["whole"] = anchor, whole
                order = np.lexsort((place["start"], place["row"], place["doc"], whole, anchor))
                a, w = anchor[order], whole[order]
                same = (a[1:] == a[:-1]) & (w[1:] == w[:-1])
                twice = same & (place[order[1:]] == place[order[:-1]])  # rows that are equal in id and text: one text
                if twice.any():
                    stay = np.ones(len(who), bool)
                    stay[order[1:][twice]] = False
                    name, place, count, anchor, whole, start = (x[stay] for x in (name, place, count, anchor, whole, start))
                    order = np.lexsort((place["start"], place["row"], place["doc"], whole, anchor))
                    same = (anchor[order][1:] == anchor[order][:-1]) & (whole[order][1:] == whole[order][:-1])
                again = common.later(name, place)
                heads = order[:-1][same & np.concatenate([[True], ~same[:-1]])]  # first places of the kinds that repeat here
                again[order[1:][same]] = True
                common.add(name[heads], place[heads])
                own = mix64(place["doc"].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + start.astype(np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.where(again, own, anchor)), pa.array(whole), pa.array(place["doc"]), pa.array(place["row"]), pa.array(place["start"]), pa.array(count.astype(np.int16)), pa.array(again)], ["anchor", "whole", "doc_id", "row", "start", "n", "again"])

    return docs.mapInArrow(run, "anchor long, whole long, doc_id long, row long, start int, n short, again boolean")


def repeated_segments(rows: DataFrame) -> DataFrame:
    """(anchor, doc_id, row, start, n, first): segments whose anchor occurs again. first: the first of its kind, where kinds differ
    (these are compared); otherwise a repeat of an earlier equal segment. Streams over sorted rows and holds no group."""
    ordered = rows.repartition("anchor").sortWithinPartitions("anchor", "whole", "doc_id", "row", "start")
    names = ["anchor", "whole", "doc_id", "row", "start", "n"]
    kept = ["anchor", "doc_id", "row", "start", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry: dict | None = None  # the last kind's first row; of an anchor with one kind so far it may still be needed
        many = False  # the carried anchor has had several kinds, its firsts are out
        last: dict | None = None  # the last row
        for batch in batches:
            if not batch.num_rows:
                continue
            done = batch.column("again").to_numpy(zero_copy_only=False)
            if done.any():
                part = batch.filter(pa.array(done))
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in kept), pa.array(np.zeros(part.num_rows, bool))], [*kept, "first"])
                batch = batch.filter(pa.array(~done))
                if not batch.num_rows:
                    continue
            c = {k: batch.column(k).to_numpy() for k in names}
            twice = np.zeros(len(c["anchor"]), bool)  # the place of the row before: equal rows, one text
            twice[1:] = np.logical_and.reduce([c[k][1:] == c[k][:-1] for k in names])
            twice[0] = last is not None and all(c[k][0] == last[k] for k in names)
            last = {k: c[k][-1] for k in names}
            if twice.any():
                c = {k: x[~twice] for k, x in c.items()}
                if not len(c["anchor"]):
                    continue
            ahead = 0
            if carry is not None:
                c = {k: np.concatenate([[carry[k]], c[k]]).astype(c[k].dtype) for k in names}
                ahead = 1
            new_anchor = np.concatenate([[True], c["anchor"][1:] != c["anchor"][:-1]])
            new_kind = new_anchor | np.concatenate([[True], c["whole"][1:] != c["whole"][:-1]])
            at = np.flatnonzero(new_anchor)
            kinds = np.add.reduceat(new_kind.astype(np.int64), at)
            group = np.cumsum(new_anchor) - 1
            several = kinds > 1
            if ahead and many:
                several[0] = True
            first = new_kind & several[group]
            again = ~new_kind
            if ahead:
                first[0] = first[0] and not many
            out = first | again
            if out.any():
                yield pa.RecordBatch.from_arrays([pa.array(c[k][out]) for k in kept] + [pa.array(first[out])], [*kept, "first"])
            newest = np.flatnonzero(new_kind)[-1]
            carry, many = {k: c[k][newest] for k in names}, bool(several[-1])

    return ordered.mapInArrow(run, "anchor long, doc_id long, row long, start int, n short, first boolean")


def smaller_than_next(x: np.ndarray) -> np.ndarray:
    """Which suffixes of x are smaller than their successors (the last one, before the end, is not)."""
    n = len(x)
    out = np.zeros(n, bool)
    if n > 1:
        step = np.sign(x[1:].astype(np.int64) - x[:-1])
        # equal bytes take the answer of the next unequal pair
        at = np.where(step != 0, np.arange(n - 1), n)
        nxt = np.minimum.accumulate(at[::-1])[::-1]
        out[:-1] = (nxt < n) & (step[np.minimum(nxt, n - 2)] > 0)
    return out


def two_stage_suffixes(x: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of x by their first `depth` symbols at least (ties in any order); x: small non-negative integers, the least one at the end."""
    n = len(x)
    small = smaller_than_next(x)
    direct = np.flatnonzero(small)
    # stage 1: sort these directly, eight symbols at a time; only ties go on
    pad = np.concatenate([x.astype(np.uint64), np.zeros(depth + 8, np.uint64)])
    word = np.zeros(len(pad) - 7, np.uint64)
    for k in range(8):
        word = (word << np.uint64(8)) | np.minimum(pad[k : len(pad) - 7 + k], np.uint64(255))
    order = direct[np.argsort(word[direct], kind="stable")]
    rank_key = word[order]
    lead = np.concatenate([[True], rank_key[1:] != rank_key[:-1]]) if len(order) else np.zeros(0, bool)
    at = 8
    while at < depth and len(order):
        group = np.cumsum(lead) - 1
        tied = np.flatnonzero(np.bincount(group)[group] > 1)
        if not len(tied):
            break
        key = word[np.minimum(order[tied] + at, len(word) - 1)]
        s = np.lexsort((key, group[tied]))
        order[tied] = order[tied][s]
        key, g = key[s], group[tied]
        lead[tied[1:]] |= (g[1:] == g[:-1]) & (key[1:] != key[:-1])
        at += 8
    # stage 2: scan the buckets of first symbols upwards; what stands before a placed suffix and is larger than it is induced
    size = np.bincount(x, minlength=257)
    start = np.concatenate([[0], np.cumsum(size)])[:-1]
    suffixes = np.full(n, -1, np.int64)
    head = start.copy()
    end = start + size
    n_small = np.bincount(x[order], minlength=257) if len(order) else np.zeros(257, np.int64)
    at = 0
    symbols = np.flatnonzero(size)
    for c in symbols:  # the directly sorted ones close their bucket
        k = int(n_small[c])
        suffixes[end[c] - k : end[c]] = order[at : at + k]
        at += k
    suffixes[head[x[n - 1]]] = n - 1  # the end itself
    head[x[n - 1]] += 1
    for c in symbols:
        lo = int(start[c])
        done = lo
        while True:
            hi = int(head[c])
            if done >= hi:
                break
            _induce(x, small, suffixes[done:hi], suffixes, head)
            done = hi  # more of the same bucket may have come
        _induce(x, small, suffixes[end[c] - n_small[c] : end[c]], suffixes, head)
    return suffixes


def _induce(x: np.ndarray, small: np.ndarray, placed: np.ndarray, suffixes: np.ndarray, head: np.ndarray) -> None:
    before = placed[placed > 0] - 1
    before = before[~small[before]]
    if not len(before):
        return
    c = x[before]
    order = np.argsort(c, kind="stable")
    before, c = before[order], c[order]
    symbols, first, count = np.unique(c, return_index=True, return_counts=True)
    suffixes[np.repeat(head[symbols] - first, count) + np.arange(len(before))] = before
    head[symbols] += count


def common_with_previous(x: np.ndarray, suffixes: np.ndarray, depth: int) -> np.ndarray:
    """Whether each suffix in the array shares `depth` symbols with the one before it (the first: no)."""
    pad = np.concatenate([x.astype(np.uint64), np.zeros(depth + 8, np.uint64)])
    word = np.zeros(len(pad) - 7, np.uint64)
    for k in range(8):
        word = (word << np.uint64(8)) | np.minimum(pad[k : len(pad) - 7 + k], np.uint64(255))
    a, b = suffixes[:-1], suffixes[1:]
    live = np.arange(len(a))
    live = live[(a[live] + depth <= len(x)) & (b[live] + depth <= len(x))]
    for at in [*range(0, depth - 8, 8), depth - 8]:
        live = live[word[a[live] + at] == word[b[live] + at]]
    out = np.zeros(len(suffixes), bool)
    out[live + 1] = True
    return out


def later_starts(texts: list[bytes], docs: np.ndarray, starts: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Of texts (pieces of documents from `starts` on): the (doc, start) of each span-byte string that also starts earlier."""
    sizes = np.array([len(t) for t in texts], np.int64)
    # a zero byte ends each piece; texts may hold zero bytes too, so ends are told by place, not by value
    raw = np.frombuffer(b"\x00".join(texts) + b"\x00", np.uint8)
    begin = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    x = raw.astype(np.int64)
    suffixes = two_stage_suffixes(x, span)
    same = common_with_previous(x, suffixes, span)
    owner = np.repeat(np.arange(len(texts)), sizes + 1)
    inside = np.arange(len(x)) + span <= (begin + sizes)[owner]  # no string over the end of its piece
    at = suffixes
    run = np.cumsum(~same) - 1
    keep = inside[at]
    at, run = at[keep], run[keep]
    who = owner[at]
    doc, pos = docs[who], starts[who] + at - begin[who]
    order = np.lexsort((pos, doc, run))
    doc, pos, run = doc[order], pos[order], run[order]
    later = np.concatenate([[False], (run[1:] == run[:-1])]) if len(run) else np.zeros(0, bool)
    # the same place may come from two pieces: it is no repeat of itself
    if len(run):
        head = np.flatnonzero(~later)
        h = head[np.cumsum(~later) - 1]
        later &= (doc != doc[h]) | (pos != pos[h])
    return doc[later], pos[later]


def compare_segments(rows: DataFrame, span: int) -> DataFrame:
    """(anchor, doc_id, row, start, body) -> (doc_id, row, start, n): starts of strings that also start earlier, as runs."""
    ordered = rows.repartition("anchor").sortWithinPartitions("anchor")

    def solve(held: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        t = pa.Table.from_batches(held)
        whose = np.zeros(t.num_rows, [("doc", np.int64), ("row", np.int64)])
        whose["doc"], whose["row"] = t["doc_id"].to_numpy(), t["row"].to_numpy()
        texts, number = np.unique(whose, return_inverse=True)  # in order of their ids
        which, pos = later_starts(t["body"].to_pylist(), number.astype(np.int64), t["start"].to_numpy().astype(np.int64), span)
        return _runs(texts, which, pos)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            cuts = group_starts([pa.chunked_array([batch.column(0)])])
            for a, b in zip(cuts, [*cuts[1:], batch.num_rows]):
                part = batch.slice(a, b - a)
                if held and size > BLOCK_BYTES and held[-1].column(0)[-1].as_py() != part.column(0)[0].as_py():
                    if (out := solve(held)) is not None:
                        yield out
                    held, size = [], 0
                held.append(part)
                size += sum(len(x) for x in part.column(4).to_pylist())
        if held and (out := solve(held)) is not None:
            yield out

    return ordered.mapInArrow(run, "doc_id long, row long, start int, n int")


def _runs(texts: np.ndarray, which: np.ndarray, pos: np.ndarray) -> pa.RecordBatch | None:
    if not len(which):
        return None
    order = np.lexsort((pos, which))
    which, pos = which[order], pos[order]
    new = np.concatenate([[True], (which[1:] != which[:-1]) | (pos[1:] > pos[:-1] + 1)])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(which)) - 1
    whose = texts[which[first]]
    columns = [whose["doc"], whose["row"], pos[first].astype(np.int32), (pos[last] - pos[first] + 1).astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc_id", "row", "start", "n"])


def repeat_spans(docs: DataFrame, span: int = SPAN, gram: int = GRAM, hot: int = HOT_SEGMENTS) -> DataFrame:
    """(doc_id, row, start, n): starts of span-byte strings (n of them on end) that also start earlier, of (doc_id, row, text)."""
    rows = materialize(repeated_segments(segment_rows(docs, span, gram)))
    open_ = rows.where("first")
    busy = materialize(open_.groupBy("anchor").agg(F.count("*").alias("kinds")).where(F.col("kinds") > hot))
    wanted = open_.join(busy, "anchor", "left").select("doc_id", "row", F.struct("start", "n", "anchor", F.col("kinds").isNotNull().alias("hot")).alias("s")).groupBy("doc_id", "row").agg(F.collect_list("s").alias("s")).withColumnsRenamed({"doc_id": "_id", "row": "_row"})

    def bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                doc, row, raw, s = (batch.column(c)[k].as_py() for c in range(4))
                raw = raw.encode("utf-8", "surrogatepass")
                anchor, start, body, high, low = [], [], [], [], []
                for x in s:
                    if not x["hot"]:
                        anchor.append(x["anchor"])
                        start.append(x["start"])
                        body.append(raw[x["start"] : x["start"] + x["n"] + span - 1])
                        high.append(None)
                        low.append(None)
                    else:
                        for p in range(x["start"], x["start"] + x["n"]):
                            h = xxhash.xxh3_128_intdigest(raw[p : p + span])
                            anchor.append(None)
                            start.append(p)
                            body.append(None)
                            high.append((h >> 64) - (1 << 63))
                            low.append((h & 0xFFFFFFFFFFFFFFFF) - (1 << 63))
                types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(([doc] * len(start), [row] * len(start), anchor, start, body, high, low), types)], ["doc_id", "row", "anchor", "start", "body", "high", "low"])

    texts = docs.join(wanted.hint("merge"), (docs["doc_id"] == wanted["_id"]) & (docs["row"] == wanted["_row"])).select("doc_id", "row", "text", "s")
    pieces = materialize(texts.mapInArrow(bodies, "doc_id long, row long, anchor long, start int, body binary, high long, low long"))
    compared = compare_segments(pieces.where("body IS NOT NULL").select("anchor", "doc_id", "row", "start", "body"), span)
    grams = pieces.where("body IS NULL").select("doc_id", "row", "start", "high", "low")
    # written by itself, so that a string with very many starts is split in the join
    first = materialize(grams.groupBy("high", "low").agg(F.min(F.struct("doc_id", "row", "start")).alias("f")))
    by_hash = grams.join(first, ["high", "low"]).where(F.struct("doc_id", "row", "start") != F.col("f")).select("doc_id", "row", "start", F.lit(1).alias("n"))
    whole = rows.where("NOT first").select("doc_id", "row", "start", F.col("n").cast("int").alias("n"))
    return whole.unionByName(compared).unionByName(by_hash)


def remove_repeats(docs: DataFrame, span: int = SPAN, gram: int = GRAM, hot: int = HOT_SEGMENTS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept binary) of (doc_id, text): kept holds the bytes that are left, n_spans the maximal removed runs.

    Null texts are empty; null ids come back untouched. Rows that repeat an id with other texts are texts of their own, in order of a
    hash of the text; rows that are equal in both are one text, and nothing of them is removed for each other.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_hash("text").alias("row"), "text")
    spans = materialize(repeat_spans(texts.where("doc_id IS NOT NULL AND text IS NOT NULL"), span, gram, hot))
    per = spans.groupBy("doc_id", "row").agg(F.collect_list(F.struct("start", "n")).alias("s")).withColumnsRenamed({"doc_id": "_id", "row": "_row"})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_bytes, n_removed, n_spans, kept = [], [], [], []
            for t, s in zip(batch.column(1).to_pylist(), batch.column(2)):
                raw = np.frombuffer(t.encode("utf-8", "surrogatepass") if t else b"", np.uint8)
                n_bytes.append(len(raw))
                if not s.is_valid:
                    n_removed.append(0)
                    n_spans.append(0)
                    kept.append(raw.tobytes())
                    continue
                start, n = (s.values.field(k).to_numpy().astype(np.int64) for k in ("start", "n"))
                if (start + n + span - 1 > len(raw)).any():
                    raise ValueError("a span lies outside its text")
                edge = np.zeros(len(raw) + 1, np.int64)
                np.add.at(edge, start, 1)
                np.add.at(edge, start + n + span - 1, -1)
                gone = np.cumsum(edge[:-1]) > 0
                n_removed.append(int(gone.sum()))
                n_spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
                kept.append(raw[~gone].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in (n_bytes, n_removed, n_spans)), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    joined = texts.join(per.hint("merge"), (texts["doc_id"] == per["_id"]) & (texts["row"] == per["_row"]), "left").select("doc_id", "text", "s")
    return joined.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
