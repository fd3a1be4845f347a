"""Removal of passages that an earlier document holds: each word under a window of WINDOW words that also starts in a document with a smaller doc_id.

Method: suffix automata of reference shards, through which segments of the documents are streamed for their matching statistics.

1. Reference. Of the GRAM-word strings inside a window the one of the least hash is its anchor (winnowing, Schleimer et al., 2003), so equal
   windows have equal anchors at equal places; a run of windows with one anchor is a segment. Anchors that one document alone
   holds can't repeat; a combining aggregate over (anchor, least id, greatest id) finds the others. Equal segments of these are one kind, however many
   documents share them: (anchor, kind, least id) is the reference, a few words a kind.
2. Shards. Kinds are dealt by anchor into shards of bounded size. A task holds one shard's automaton at a time: a generalised suffix automaton
   over its kinds, each state with the least id of the documents that its strings come from. An anchor with more kinds than a shard holds is
   cut into several shards, and each of its blocks of segments is streamed through each of them; the least id of all counts.
3. Streaming. At each word of a kind the automaton gives the longest suffix that the shard holds, and where it has WINDOW words or more the state of
   the last WINDOW words names the least id that holds this window.
4. The ids go back to the documents by (anchor, kind): a window goes where its id is smaller than the document's.

Words are compared by 64-bit hashes, kinds by two of them. Only segments of repeated anchors travel with words, one copy a kind.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, map_groups, materialize, mix64, powers, row_hash

WINDOW, GRAM = 13, 7
#: Kinds of one reference shard (some 16 words each), and words of the buffer in which documents are hashed.
SHARD_KINDS, BUFFER_WORDS = 8_000, 400_000
_MULT = np.array([0x9E3779B97F4A7C15 * (2 * k + 3) & 0xFFFFFFFFFFFFFFFF | 1 for k in range(32)], np.uint64)


def words_of(column: pa.Array) -> list[list[bytes]]:
    """The words of each text as bytes; null: none. bytes.split() parts at exactly [\\x20\\x09-\\x0D]."""
    return [t.split() if t else [] for t in column.cast(pa.binary()).to_pylist()]


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def segments(h: np.ndarray, sizes: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text number, first window's place, number of windows, anchor hash, kind hash) of all segments of texts whose word hashes stand in h one after the other."""
    n = len(h)
    if n < window or not (sizes >= window).any():
        z = np.zeros(0, np.int64)
        return z, z, z, z, z
    g = np.zeros(n - gram + 1, np.uint64)
    for k in range(gram):
        g += h[k : k + len(g)] * _MULT[k]
    g = mix64(g)
    low = np.uint64((1 << 32) - 1)  # the same width at every size, so that equal windows choose equal anchors in all buffers
    m = (g & ~low) | np.arange(len(g), dtype=np.uint64)
    width, reach = 1, window - gram + 1
    while 2 * width <= reach:
        m = np.minimum(m[:-width], m[width:])
        width *= 2
    if width < reach:
        m = np.minimum(m[: len(m) - (reach - width)], m[reach - width :])
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(sizes)), sizes)[: len(m)]
    valid = np.arange(len(m)) + window <= ends[owner]
    new = np.ones(len(m), bool)
    new[1:] = (m[1:] != m[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new & valid)
    stop = np.flatnonzero(new | ~valid)
    nxt = np.append(stop, len(m))[np.searchsorted(stop, first, side="right")]
    count = nxt - first
    anchor = g[(m[first] & low).astype(np.int64)]
    forward, back = powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(h * forward[:n], dtype=np.uint64, out=total[1:])
    kind = mix64(mix64((total[nxt + window - 1] - total[first]) * back[first]) + count.astype(np.uint64))
    who = owner[first]
    return who, first - (ends - sizes)[who], count, anchor.view(np.int64), kind.view(np.int64)


def _buffers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list[list[bytes]]]]:
    for batch in batches:
        ids, rows, texts, held = [], [], [], 0
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            for i, r, w in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), words_of(part.column(2))):
                if held and held + len(w) > BUFFER_WORDS:
                    yield ids, rows, texts
                    ids, rows, texts, held = [], [], [], 0
                ids.append(i)
                rows.append(r)
                texts.append(w)
                held += len(w)
        if ids:
            yield ids, rows, texts


def segment_rows(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(anchor, kind, doc_id, row, start, n) of (doc_id, row, text): a row per segment; start counts words, n windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, rows, texts in _buffers(batches):
            sizes = np.array([len(w) for w in texts], np.int64)
            who, start, count, anchor, kind = segments(word_hashes([x for w in texts for x in w]), sizes, window, gram)
            if len(who):
                doc, row = np.array(ids, np.int64)[who], np.array(rows, np.int64)[who]
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(kind), pa.array(doc), pa.array(row), pa.array(start.astype(np.int32)), pa.array(count.astype(np.int16))], ["anchor", "kind", "doc_id", "row", "start", "n"])

    return docs.mapInArrow(run, "anchor long, kind long, doc_id long, row long, start int, n short")


class SuffixAutomaton:
    """A generalised suffix automaton over integer strings; each state knows the least id of the strings that hold its factors."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.least = [-1], [0], [1 << 62]

    def add(self, string: list[int], owner: int) -> None:
        """Add a string that stands in document `owner`."""
        nxt, link, length, least = self.next, self.link, self.length, self.least
        last = 0
        for c in string:
            q = nxt[last].get(c)
            if q is not None and length[q] == length[last] + 1:
                last = q
            elif q is not None:
                last = self._split(last, q, c)
            else:
                p, last = last, len(nxt)
                nxt.append({})
                link.append(0)
                length.append(length[p] + 1)
                least.append(1 << 62)
                while p >= 0 and c not in nxt[p]:
                    nxt[p][c] = last
                    p = link[p]
                if p >= 0:
                    q = nxt[p][c]
                    link[last] = q if length[q] == length[p] + 1 else self._split(p, q, c)
            if owner < least[last]:
                least[last] = owner

    def _split(self, p: int, q: int, c: int) -> int:
        """A state of its own for the factors of q that end the strings of p and c."""
        nxt, link = self.next, self.link
        own = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        self.length.append(self.length[p] + 1)
        self.least.append(1 << 62)
        link[q] = own
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = own
            p = link[p]
        return own

    def close(self, window: int) -> None:
        """Hand the least ids down to all suffixes; for each state find the state of its last `window` symbols."""
        link, least, length = self.link, self.least, self.length
        order = np.argsort(np.array(length), kind="stable").tolist()
        for v in reversed(order[1:]):
            if least[v] < least[link[v]]:
                least[link[v]] = least[v]
        self.last_window = top = [0] * len(link)
        for v in order[1:]:
            top[v] = v if length[link[v]] < window else top[link[v]]

    def matching_statistics(self, string: list[int]) -> Iterator[tuple[int, int]]:
        """(length, state) of the longest suffix that the automaton holds, after each symbol."""
        nxt, link, length = self.next, self.link, self.length
        v = n = 0
        for c in string:
            while v and c not in nxt[v]:
                v = link[v]
                n = length[v]
            if c in nxt[v]:
                v = nxt[v][c]
                n += 1
            yield n, v

    def least_of_windows(self, string: list[int], window: int) -> list[int]:
        """Of each window of the string the least id of a document that holds it (1 << 62: none here)."""
        least, top = self.least, self.last_window
        return [least[top[v]] if n >= window else 1 << 62 for n, v in self.matching_statistics(string)][window - 1 :]


def kind_words(docs: DataFrame, kinds: DataFrame, window: int) -> DataFrame:
    """(anchor, kind, least, words) of kinds (anchor, kind, first: doc_id, row, start, n): 64-bit hashes of the words, cut out of the first holder's text."""
    places = kinds.groupBy(F.col("first.doc_id").alias("_id"), F.col("first.row").alias("_row")).agg(F.collect_list(F.struct("anchor", "kind", "first.start", "first.n")).alias("s"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            for k in range(batch.num_rows):
                this = batch.column(0)[k].as_py(), batch.column(3)[k].as_py()
                if this == last:
                    continue  # a row that is equal in id and text: the merge join puts them next to each other
                last = this
                h = word_hashes(words_of(batch.column(1).slice(k, 1))[0])
                s = batch.column(2)[k].values
                start, n = (s.field(f).to_numpy().astype(np.int64) for f in ("start", "n"))
                if (start + n + window - 1 > len(h)).any():
                    raise ValueError("a segment lies outside its text")
                words = [h[a : a + m + window - 1].tobytes() for a, m in zip(start.tolist(), n.tolist())]
                yield pa.RecordBatch.from_arrays([s.field("anchor"), s.field("kind"), pa.array(np.full(len(n), batch.column(0)[k].as_py(), np.int64)), pa.array(words, pa.binary())], ["anchor", "kind", "least", "words"])

    texts = docs.join(places.hint("merge"), (docs["doc_id"] == places["_id"]) & (docs["row"] == places["_row"])).select("doc_id", "text", "s", "row")
    return texts.mapInArrow(cut, "anchor long, kind long, least long, words binary")


def least_ids(kinds: DataFrame, window: int, shard_kinds: int = SHARD_KINDS) -> DataFrame:
    """A written table (anchor, kind, ids array<long>) of (anchor, kind, least, words): of each window of a kind the least id of a document that holds it."""
    per_anchor = materialize(kinds.groupBy("anchor").agg(F.count("*").alias("_n")))
    total = per_anchor.agg(F.sum("_n")).first()[0] or 0
    n_shards = max(1, -(-total // shard_kinds))
    # an anchor of more kinds than a shard holds: parts of its own, each of which is reference in one shard and streamed through all
    parts = F.ceil(F.col("_n") / shard_kinds).cast("int")
    many = per_anchor.where(F.col("_n") > shard_kinds).select("anchor", parts.alias("_parts"))
    known = kinds.join(many, "anchor", "left").withColumn("_parts", F.coalesce("_parts", F.lit(1))).withColumn("_part", F.pmod(F.xxhash64("kind"), F.col("_parts")).cast("int"))
    shard = F.pmod(F.xxhash64("anchor"), F.lit(n_shards))
    # slot: (reference part, streamed part); those with equal parts hold the reference itself, the others need both sides
    small = known.where("_parts = 1").select(shard.alias("shard"), F.lit(0).alias("slot"), F.lit(True).alias("held"), F.lit(True).alias("asked"), "anchor", "kind", "least", "words")
    slots = F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
    large = known.where("_parts > 1").withColumn("_other", slots)
    as_reference = large.select(F.xxhash64("anchor").alias("shard"), (F.col("_part") * F.col("_parts") + F.col("_other") + 1).alias("slot"), F.lit(True).alias("held"), (F.col("_part") == F.col("_other")).alias("asked"), "anchor", "kind", "least", "words")
    as_stream = large.where("_part <> _other").select(F.xxhash64("anchor").alias("shard"), (F.col("_other") * F.col("_parts") + F.col("_part") + 1).alias("slot"), F.lit(False).alias("held"), F.lit(True).alias("asked"), "anchor", "kind", "least", "words")
    dealt = small.unionByName(as_reference).unionByName(as_stream)

    def solve(t: pa.Table) -> pa.RecordBatch | None:
        # equal rows in several tasks may have given a kind more than once
        names = np.stack([t["anchor"].to_numpy(), t["kind"].to_numpy()], axis=1)
        _, once = np.unique(names, axis=0, return_index=True)
        t = t.take(pa.array(once)) if len(once) < t.num_rows else t
        held, asked = (t[k].to_numpy(zero_copy_only=False) for k in ("held", "asked"))
        least = t["least"].to_pylist()
        sizes = np.array([len(w) // 8 for w in t["words"].to_pylist()])
        _, ids = np.unique(np.frombuffer(b"".join(t["words"].to_pylist()), np.uint64), return_inverse=True)
        ids = ids.tolist()
        ends = np.cumsum(sizes).tolist()
        strings = [ids[e - n : e] for e, n in zip(ends, sizes.tolist())]
        automaton = SuffixAutomaton()
        for k in np.flatnonzero(held).tolist():
            automaton.add(strings[k], least[k])
        automaton.close(window)
        rows = np.flatnonzero(asked)
        found = [automaton.least_of_windows(strings[k], window) for k in rows.tolist()]
        if not found:
            return None
        take = pa.array(rows)
        return pa.RecordBatch.from_arrays([t["anchor"].combine_chunks().take(take), t["kind"].combine_chunks().take(take), pa.array(found, pa.list_(pa.int64()))], ["anchor", "kind", "ids"])

    # written: parts of a split anchor are put together from it, and no shard is solved twice
    found = materialize(map_groups(dealt, ["shard", "slot"], solve, "anchor long, kind long, ids array<long>"))
    if not many.limit(1).count():
        return found
    split = found.join(many.select("anchor"), "anchor", "left_semi").groupBy("anchor", "kind").agg(F.collect_list("ids").alias("_all"))
    lowest = F.aggregate(F.slice("_all", 2, F.size("_all")), F.element_at("_all", 1), lambda a, b: F.zip_with(a, b, lambda x, y: F.least(x, y)))
    return materialize(found.join(many.select("anchor"), "anchor", "left_anti").unionByName(split.select("anchor", "kind", lowest.alias("ids"))))


def earlier_windows(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_kinds: int = SHARD_KINDS) -> DataFrame:
    """A written table (doc_id, row, start, ids) of (doc_id, row, text): segments with a window whose least id in `ids` (one a window, from word `start` on) is smaller than doc_id."""
    rows = materialize(segment_rows(docs, window, gram))
    shared = materialize(rows.groupBy("anchor").agg(F.min("doc_id").alias("_a"), F.max("doc_id").alias("_z")).where("_a < _z").select("anchor"))
    again = materialize(rows.join(shared, "anchor"))
    discard(rows, shared)
    first = F.min(F.struct("doc_id", "row", "start", "n")).alias("first")
    kinds = materialize(kind_words(docs, again.groupBy("anchor", "kind").agg(first), window))
    # a written table, so that a kind with very many holders is split in the join
    least = least_ids(kinds, window, shard_kinds)
    discard(kinds)
    later = materialize(again.join(least, ["anchor", "kind"]).where(F.exists("ids", lambda x: x < F.col("doc_id"))).select("doc_id", "row", "start", "ids"))
    discard(again, least)
    return later


def remove_earlier(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_kinds: int = SHARD_KINDS) -> DataFrame:
    """(doc_id, n_words, n_removed, n_spans, kept string) of (doc_id, text): kept joins the words that are left by one space, n_spans counts maximal removed runs.

    A null text has no words. A row without an id comes back whole and takes nothing from others, for it is smaller than none. Rows that repeat an id
    are documents of their own, told apart by a 64-bit hash of the text, and take nothing from each other, for neither id is smaller. Texts of fewer words than a window lose
    nothing. Extra columns are not looked at.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_hash("text").alias("row"), "text")
    spans = earlier_windows(texts.where("doc_id IS NOT NULL AND text IS NOT NULL"), window, gram, shard_kinds)
    per = spans.groupBy(F.col("doc_id").alias("_id"), F.col("row").alias("_row")).agg(F.collect_set(F.struct("start", "ids")).alias("s"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                n_words, n_removed, n_spans, kept = [], [], [], []
                for doc, words, s in zip(part.column(0).to_pylist(), words_of(part.column(1)), part.column(2)):
                    gone = np.zeros(len(words), bool)
                    if s.is_valid:
                        edge = np.zeros(len(words) + 1, np.int64)
                        start, ids = s.values.field("start").to_numpy().astype(np.int64), s.values.field("ids")
                        size = np.diff(ids.offsets.to_numpy())
                        hit = ids.flatten().to_numpy() < doc
                        place = (np.repeat(start - np.cumsum(size) + size, size) + np.arange(len(hit)))[hit]
                        if len(place) and place.max() + window > len(words):
                            raise ValueError("a window lies outside its text")
                        np.add.at(edge, place, 1)
                        np.add.at(edge, place + window, -1)
                        gone = np.cumsum(edge[:-1]) > 0
                    n_words.append(len(words))
                    n_removed.append(int(gone.sum()))
                    n_spans.append(int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum()))
                    kept.append(b" ".join([w for w, g in zip(words, gone.tolist()) if not g] if n_removed[-1] else words))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, pa.int64()) for c in (n_words, n_removed, n_spans)), pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "n_spans", "kept"])

    joined = texts.join(per.hint("merge"), (texts["doc_id"] == per["_id"]) & (texts["row"] == per["_row"]), "left").select("doc_id", "text", "s")
    return joined.mapInArrow(cut, "doc_id long, n_words long, n_removed long, n_spans long, kept string")


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_earlier(docs).select("doc_id", "n_words", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), s AS (
  SELECT doc_id, p, array_to_string(w[p : p + 12], ' ') AS g FROM d, unnest(range(1, len(w) - 11)) AS u(p)
), f AS (
  SELECT g, min(doc_id) AS m FROM s GROUP BY g HAVING min(doc_id) < max(doc_id)
), gone AS (
  SELECT DISTINCT s.doc_id, p + k AS p FROM s JOIN f ON s.g = f.g AND m < s.doc_id, unnest(range(13)) AS u(k)
), x AS (
  SELECT d.doc_id, u.p, w[u.p] AS t FROM d, unnest(range(1, len(w) + 1)) AS u(p)
), k AS (
  SELECT x.doc_id, string_agg(t, ' ' ORDER BY x.p) FILTER (g.p IS NULL) AS kept, count(g.p) AS n_removed,
    count(*) FILTER (g.p IS NOT NULL AND b.p IS NULL) AS n_spans
  FROM x LEFT JOIN gone g ON x.doc_id = g.doc_id AND x.p = g.p LEFT JOIN gone b ON x.doc_id = b.doc_id AND x.p = b.p + 1 GROUP BY x.doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""
