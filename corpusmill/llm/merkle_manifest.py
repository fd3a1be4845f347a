"""Merkle manifest of a dataset: a digest a row, a tree a language, a tree over the languages, and for each row the proof of its place.

Method: time-forward processing (Chiang et al., 1995). Nodes are labelled (level, index), children before parents. A node's digest is a message to its
parent; an external priority queue, ordered by label, holds the messages, so each node finds its children's digests at its front when its time
comes. Then the sweep is run backwards: from the root down, each node hands its children the rest of their proofs, the proof suffixes.

On Spark the queue is external in two parts. 2**BLOCK_LEVELS consecutive nodes of a tree are a block: a task takes its messages, sorted by label by the
shuffle, through a heap and sends one message on, the digest of the block's root, into a written table; the next round's shuffle sorts that table by
label. A round takes BLOCK_LEVELS levels, so 10**10 rows need three. Backwards, each block gets one suffix from the round above. No task holds
more than a block, and what moves of a document is its digest.

Where leaves stand in their tree comes from one range sort and sums per (partition, tree); no window runs over the rows of a tree.
"""

from __future__ import annotations

import heapq
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_groups, materialize

#: A block holds 2**BLOCK_LEVELS nodes.
BLOCK_LEVELS = 12
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Bytes of a proof's step: a side and a digest.
STEP = 33
RIGHT, LEFT, ALONE = 0, 1, 2
_POSITION = (1 << 33) - 1


def field(value: Column) -> Column:
    """A field as the leaf hashes it: its bytes' number, a colon and the value; - for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    """The leaf's digest, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


def numbered(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """rows with _at (place in its tree, from 0, by `order`) and _n (rows of the tree): a written range sort, then sums per tree and partition.

    The window runs over one row for each partition of a tree. tree: a column without nulls.
    """
    placed = materialize(rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order).withColumn("_mid", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_mid", 33)).withColumn("_in", F.col("_mid").bitwiseAND(F.lit(_POSITION))).drop("_mid")
    counts = materialize(placed.groupBy(F.col(tree).alias("_tree"), F.col("_part").alias("_p")).agg(F.min("_in").alias("_first"), F.count("*").alias("_rows")))
    before = F.coalesce(F.sum("_rows").over(Window.partitionBy("_tree").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = counts.withColumn("_n", F.sum("_rows").over(Window.partitionBy("_tree"))).withColumn("_base", before)
    joined = placed.join(base, (placed[tree] == base["_tree"]) & (placed["_part"] == base["_p"]))
    return joined.withColumn("_at", F.col("_base") + F.col("_in") - F.col("_first")).drop("_tree", "_p", "_part", "_in", "_first", "_rows", "_base")


def digest(children: list[bytes]) -> bytes:
    """H of the children's digests, which it takes as lowercase hex text."""
    return sha256("".join(c.hex() for c in children).encode()).digest()


def height(n: int, most: int) -> int:
    """Levels until n nodes are one, `most` at most."""
    return min(most, (n - 1).bit_length())


def sweep_up(leaves: list[bytes], levels: int) -> dict[tuple[int, int], bytes]:
    """Digests of all nodes of a block by label (level, index), forward in time: the heap hands each node its children's messages."""
    done = {(0, i): d for i, d in enumerate(leaves)}
    queue = [(1, i >> 1, i, d) for i, d in enumerate(leaves)] if levels else []
    while queue:
        level, index = queue[0][:2]
        children = []
        while queue and queue[0][:2] == (level, index):
            children.append(heapq.heappop(queue)[3])
        done[level, index] = d = digest(children)
        if level < levels:
            heapq.heappush(queue, (level + 1, index >> 1, index, d))
    return done


def sweep_down(nodes: dict[tuple[int, int], bytes], n: int, levels: int, suffix: bytes) -> list[bytes]:
    """Proofs of a block's n leaves, backward in time: the root's suffix goes down, each child's sibling before it."""
    at = {0: suffix}
    for level in range(levels - 1, -1, -1):
        at = {i: _step(nodes, level, i) + at[i >> 1] for i in range(((n - 1) >> level) + 1)}
    return [at[i] for i in range(n)]


def _step(nodes: dict[tuple[int, int], bytes], level: int, i: int) -> bytes:
    sibling = nodes.get((level, i ^ 1))
    return bytes([ALONE]) + bytes(32) if sibling is None else bytes([LEFT if i & 1 else RIGHT]) + sibling


def siblings(proof: bytes) -> str:
    """The proof's digests in order, as hex text."""
    return "".join(proof[k + 1 : k + STEP].hex() for k in range(0, len(proof), STEP) if proof[k] != ALONE)


def fold(own: bytes, proof: bytes) -> bytes:
    """The root that a leaf and its proof give."""
    for k in range(0, len(proof), STEP):
        side, other = proof[k], proof[k + 1 : k + STEP]
        own = digest([own] if side == ALONE else [other, own] if side == LEFT else [own, other])
    return own


def rounds(nodes: DataFrame, levels: int = BLOCK_LEVELS) -> list[DataFrame]:
    """From nodes (tree, n, at, digest; n: nodes of the tree) the written tables of all rounds; the last holds one row a tree, its root."""

    def solve(t: pa.Table) -> pa.RecordBatch:
        tree, n, block = (t[k][0].as_py() for k in ("tree", "n", "block"))
        up = height(n, levels)
        top = sweep_up(t["digest"].to_pylist(), up)[up, 0]
        return pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (tree, ((n - 1) >> levels) + 1, block)] + [pa.array([top], pa.binary())], ["tree", "n", "at", "digest"])

    out = [nodes]
    while out[-1].where("n > 1").limit(1).count():
        blocks = out[-1].withColumn("block", F.shiftright("at", levels))
        out.append(materialize(map_groups(blocks, ["tree", "block"], solve, "tree long, n long, at long, digest binary", order=["at"])))
    return out


def suffixes(steps: list[DataFrame], seeds: DataFrame, levels: int = BLOCK_LEVELS) -> DataFrame:
    """(tree, at, suffix) of the first of `steps`, which rounds() made, from the seeds (tree, at, suffix) of the roots."""

    def solve(t: pa.Table) -> pa.RecordBatch:
        # the block's own message comes first
        tree, n, block = t["tree"][0].as_py(), t["n"][-1].as_py(), t["block"][0].as_py()
        leaves = t["value"].to_pylist()[1:]
        up = height(n, levels)
        found = sweep_down(sweep_up(leaves, up), len(leaves), up, t["value"][0].as_py())
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(leaves), tree)), pa.array((block << levels) + np.arange(len(leaves))), pa.array(found, pa.binary())], ["tree", "at", "suffix"])

    for nodes in reversed(steps[:-1]):
        own = nodes.select("tree", F.shiftright("at", levels).alias("block"), "at", "n", F.col("digest").alias("value"))
        sent = seeds.select("tree", F.col("at").alias("block"), F.lit(-1).cast("long").alias("at"), F.lit(0).cast("long").alias("n"), F.col("suffix").alias("value"))
        seeds = materialize(map_groups(own.unionByName(sent), ["tree", "block"], solve, "tree long, at long, suffix binary", order=["at"]))
    return seeds


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, tree: str = "lang", order: str = "doc_id", tampered: list[Column] | None = None, levels: int = BLOCK_LEVELS) -> DataFrame:
    """(<order>, leaf, subroot, root, proof, proof_sha256, folded_root, verified) of each row: digests as lowercase hex, proof as steps of a side and a digest.

    A row's leaf is the hash of its fields, each by length and value, so null and empty differ. Trees are the values of column `tree`, null first, then bytewise; leaves
    ascend by `order` (null first), ties by their digests, so rows that are equal in all fields have equal leaves and proofs of places next to each other. tampered: the fields
    from which folded_root is recomputed (as they are, if not given). An empty table gives no rows. Other columns are not looked at.
    """
    values = [F.col(f) for f in fields]
    name = F.when(F.col(tree).isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), tree))  # in the order of the trees
    own = leaf(values)
    claimed = leaf(tampered) if tampered else F.lit(None).cast("binary")
    leaves = materialize(docs.select(name.alias("_name"), F.col(order).alias("_id"), own.alias("_leaf"), claimed.alias("_claimed")))
    placed = materialize(numbered(leaves, "_name", ["_id", "_leaf"]))
    trees = materialize(numbered(placed.groupBy("_name").agg(F.lit(0).alias("_all")), "_all", ["_name"]).select(F.col("_name").alias("_t"), F.col("_at").alias("tree"), F.col("_n").alias("_trees")))
    rows = materialize(placed.join(trees, F.col("_name") == F.col("_t")).select("tree", F.col("_n").alias("n"), F.col("_at").alias("at"), "_id", "_leaf", "_claimed"))
    below = rounds(rows.select("tree", "n", "at", F.col("_leaf").alias("digest")), levels)
    roots = below[-1].select("tree", F.col("digest").alias("subroot"))
    above = rounds(materialize(roots.join(trees, "tree").select(F.lit(0).cast("long").alias("tree"), F.col("_trees").alias("n"), F.col("tree").alias("at"), F.col("subroot").alias("digest"))), levels)
    top = above[-1].select(F.col("digest").alias("root"))
    ends = suffixes(above, above[-1].select("tree", "at", F.lit(b"").alias("suffix")), levels)
    ends = ends.select(F.col("at").alias("tree"), F.lit(0).cast("long").alias("at"), "suffix")
    # every block of leaves gets one message: the rest of its proof, its subroot and the root (one row, from the top of the upper tree)
    sent = suffixes(below[1:], ends, levels) if len(below) > 1 else ends
    sent = sent.join(roots, "tree").join(F.broadcast(top), F.lit(True)).select("tree", F.col("at").alias("block"), F.lit(-1).cast("long").alias("at"), F.lit(0).cast("long").alias("n"), F.lit(None).cast(rows.schema["_id"].dataType).alias("_id"), F.col("suffix").alias("_leaf"), F.lit(None).cast("binary").alias("_claimed"), "subroot", "root")
    none = F.lit(None).cast("binary")
    own = rows.select("tree", F.shiftright("at", levels).alias("block"), "at", "n", "_id", "_leaf", "_claimed", none.alias("subroot"), none.alias("root"))

    def prove(t: pa.Table) -> pa.RecordBatch:
        n = t["n"][-1].as_py()
        subroot, root = t["subroot"][0].as_py(), t["root"][0].as_py()
        suffix, *digests = t["_leaf"].to_pylist()
        up = height(n, levels)
        proofs = sweep_down(sweep_up(digests, up), len(digests), up, suffix)
        shown = [c or d for c, d in zip(t["_claimed"].to_pylist()[1:], digests)]
        folded = [fold(d, p) for d, p in zip(shown, proofs)]
        k = len(digests)
        columns = [pa.array([d.hex() for d in digests]), pa.array([subroot.hex()] * k), pa.array([root.hex()] * k), pa.array(proofs, pa.binary()), pa.array([sha256(siblings(p).encode()).hexdigest() for p in proofs]), pa.array([d.hex() for d in folded]), pa.array([d == root for d in folded])]
        return pa.RecordBatch.from_arrays([t["_id"].combine_chunks().slice(1), *columns], [order, "leaf", "subroot", "root", "proof", "proof_sha256", "folded_root", "verified"])

    schema = f"`{order}` {rows.schema['_id'].dataType.simpleString()}, leaf string, subroot string, root string, proof binary, proof_sha256 string, folded_root string, verified boolean"
    return map_groups(own.unionByName(sent), ["tree", "block"], prove, schema, order=["at"])


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*FIELDS)
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0
    more = F.when(hit, F.col("n_chars").cast("decimal(20,0)") + 1).otherwise(F.col("n_chars").cast("decimal(20,0)"))
    tampered = [more if f == "n_chars" else F.col(f) for f in FIELDS]
    return manifest(docs, tampered=tampered).drop("proof")


#: crc32 of ASCII texts: the table of the reflected polynomial 0xEDB88320 (a fixed value) is made in SQL.
CRC_SQL = """
crc_table AS (
  SELECT list(list_reduce(list_concat([b], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t FROM range(256) AS r(b)
)"""


def crc_sql(array: str) -> str:
    """The unsigned crc32 of an expression that gives a list of bytes as BIGINT, with crc_table in the FROM clause."""
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {array}), lambda c, b: xor(c >> 8, crc_table.t[(xor(c, b) & 255) + 1])), 4294967295)"


def _field_sql(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '-' ELSE concat(strlen(CAST({x} AS VARCHAR)), ':', CAST({x} AS VARCHAR)) END"


def _leaf_sql(n_chars: str = "n_chars") -> str:
    return "sha256(concat(" + ", ".join(_field_sql(n_chars if f == "n_chars" else f) for f in FIELDS) + "))"


OP12_SQL = f"""
WITH RECURSIVE {CRC_SQL.strip()}, raw AS (
  SELECT doc_id, lang, {_leaf_sql()} AS leaf,
    CASE WHEN {crc_sql("list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))")} % 7 = 0 THEN {_leaf_sql("(n_chars + 1)")} END AS claimed
  FROM documents, crc_table
), d AS (
  SELECT *, coalesce('1' || lang, '0') AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM raw
), nodes(tree, level, pos, n, h) AS (
  SELECT tree, 0, pos, n, leaf FROM d
  UNION ALL
  SELECT tree, any_value(level) + 1, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY tree, pos // 2
), subroots AS (
  SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n, level AS height FROM nodes WHERE n = 1
), upper_nodes(level, pos, n, h) AS (
  SELECT 0, pos, n, h FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM upper_nodes WHERE n > 1 GROUP BY pos // 2
), steps AS (
  SELECT d.tree, d.pos, x.level, CASE WHEN (d.pos >> x.level) % 2 = 1 THEN 1 ELSE 0 END AS side, s.h FROM d
  JOIN (SELECT DISTINCT tree, level FROM nodes WHERE n > 1) x ON x.tree = d.tree
  LEFT JOIN nodes s ON s.tree = d.tree AND s.level = x.level AND s.pos = xor(d.pos >> x.level, 1)
  UNION ALL
  SELECT d.tree, d.pos, r.height + x.level, CASE WHEN (r.pos >> x.level) % 2 = 1 THEN 1 ELSE 0 END, s.h FROM d JOIN subroots r ON r.tree = d.tree
  JOIN (SELECT DISTINCT level FROM upper_nodes WHERE n > 1) x ON true
  LEFT JOIN upper_nodes s ON s.level = x.level AND s.pos = xor(r.pos >> x.level, 1)
), proofs AS (
  SELECT tree, pos, sha256(coalesce(string_agg(h, '' ORDER BY level), '')) AS proof_sha256, list(struct_pack(side := side, h := h) ORDER BY level) AS path FROM steps GROUP BY tree, pos
), folds(tree, pos, k, own) AS (
  SELECT tree, pos, 0, coalesce(claimed, leaf) FROM d
  UNION ALL
  SELECT f.tree, f.pos, k + 1, sha256(CASE WHEN p.path[k + 1].h IS NULL THEN own WHEN p.path[k + 1].side = 1 THEN p.path[k + 1].h || own ELSE own || p.path[k + 1].h END)
  FROM folds f JOIN proofs p ON f.tree = p.tree AND f.pos = p.pos WHERE k < len(p.path)
), last AS (
  SELECT tree, pos, max_by(own, k) AS folded_root FROM folds GROUP BY tree, pos
)
SELECT d.doc_id, d.leaf, r.h AS subroot, u.h AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256, l.folded_root, l.folded_root = u.h AS verified
FROM d JOIN subroots r ON r.tree = d.tree JOIN last l ON l.tree = d.tree AND l.pos = d.pos JOIN (SELECT h FROM upper_nodes WHERE n = 1) u ON true LEFT JOIN proofs p ON p.tree = d.tree AND p.pos = d.pos
"""
