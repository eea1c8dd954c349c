"""Merkle manifest of a dataset, with subtrees in van Emde Boas layout.

Every row is a leaf, the SHA-256 of its length-prefixed columns.  The leaves of
a source ascend by ``doc_id``; three consecutive nodes (the last run: fewer,
even one) hash to their parent until one is left, the source's subroot.  The
subroots, ordered by source (null first, then by UTF-8 bytes), make a tree of
the same kind, whose root stands for the dataset.

*Blocks.*  A tree is cut into aligned subtrees of ``HEIGHT`` levels (3^HEIGHT
leaves).  A block is one binary with its nodes in van Emde Boas order: the top
half of its levels first, then each bottom subtree, both laid out alike.  A
node's address is arithmetic on its level and index (``addresses``), the same
for building a block and for fetching siblings, and both touch O(log_B n)
lines of any cache.  Roots of blocks are the leaves of the next round of
blocks, so a tree of n leaves takes log(n) / (HEIGHT log 3) rounds, three at
2 * 10^11 leaves; the tree of subroots goes the same way.

*Proofs.*  From the top down every block appends its own siblings to the path
that its parent block gave it; leaves get theirs from their block, which holds
them.  One task works on one block (6,561 leaves at most) at a time, however
large a source is.

Defined cases: nulls and empty texts are distinct leaves (``-`` and ``0:``);
rows without ``doc_id`` are leaves before the others of their source and are
never tampered with; rows that share a ``doc_id`` ascend by their leaf, so
repeated rows each have a place and tie only with themselves; extra columns are
not part of a leaf; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_rows, running, stage

FANOUT = 3
HEIGHT = 8  # levels of a block above its leaves
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
DIGEST = 32


# -- layout -----------------------------------------------------------------

def nodes_of(levels: int) -> int:
    return (FANOUT ** levels - 1) // (FANOUT - 1)


@lru_cache(maxsize=32)
def addresses(levels: int) -> tuple[np.ndarray, ...]:
    """Van Emde Boas addresses of a full subtree of ``levels`` levels of nodes:
    one array per depth from its root, indexed by the place in that depth."""
    if levels == 1:
        return (np.zeros(1, np.int64),)
    top = levels // 2
    bottom = levels - top
    out = list(addresses(top))
    base = nodes_of(top)
    trees = np.arange(FANOUT ** top, dtype=np.int64)[:, None] * nodes_of(bottom)
    out += [(base + trees + a[None, :]).reshape(-1) for a in addresses(bottom)]
    return tuple(out)


def height_of(n: int) -> int:
    """Rounds of hashing until one of ``n`` nodes is left."""
    h, width = 0, 1
    while width < n:
        h, width = h + 1, width * FANOUT
    return h


def parent(children: list[bytes]) -> bytes:
    """Digests are concatenated as hex text."""
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def build(leaves: list[bytes], height: int) -> tuple[bytes, bytes]:
    """The nodes of one block in van Emde Boas order, and its root.  A block
    with few leaves is hashed up all the same: other blocks stand beside it."""
    at = addresses(height + 1)
    nodes = bytearray(DIGEST * nodes_of(height + 1))
    row = leaves
    for depth in range(height, -1, -1):
        for a, node in zip((at[depth][:len(row)] * DIGEST).tolist(), row, strict=True):
            nodes[a:a + DIGEST] = node
        if depth:
            row = [parent(row[i:i + FANOUT]) for i in range(0, len(row), FANOUT)]
    return bytes(nodes), row[0]


def siblings(nodes: bytes, height: int, n: int) -> Iterator[bytes]:
    """For each of a block's ``n`` leaves its part of a path: level by level one
    byte (place in the run * 4 + size of the run) and the other nodes of the run."""
    at = addresses(height + 1)
    widths = [n]
    for _ in range(height):
        widths.append(-(-widths[-1] // FANOUT))
    above: dict[int, bytes] = {0: b""}
    for depth in range(1, height + 1):  # downwards: a node's path ends with its parent's
        width = widths[height - depth]
        place = (at[depth][:width] * DIGEST).tolist()
        here = {}
        for first in range(0, width, FANOUT):
            run = [nodes[a:a + DIGEST] for a in place[first:first + FANOUT]]
            rest = above[first // FANOUT]
            for k in range(len(run)):
                here[first + k] = (bytes([4 * k + len(run)]) + b"".join(run[:k] + run[k + 1:])
                                   + rest)
        above = here
    for i in range(n):
        yield above[i]


def steps(path: bytes) -> Iterator[tuple[int, list[bytes]]]:
    """``(place in the run, other nodes of the run)``, from the leaf up."""
    i = 0
    while i < len(path):
        k, size = divmod(path[i], 4)
        i += 1
        others = [path[i + DIGEST * j:i + DIGEST * (j + 1)] for j in range(size - 1)]
        i += DIGEST * (size - 1)
        yield k, others


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that ``leaf`` and the siblings of ``path`` lead to."""
    node = leaf
    for k, others in steps(path):
        node = parent([*others[:k], node, *others[k:]])
    return node


def proof_digest(path: bytes) -> str:
    """SHA-256 of all siblings as hex text, from the leaf up, left to right."""
    return hashlib.sha256("".join(s.hex() for _, others in steps(path)
                                  for s in others).encode()).hexdigest()


# -- Spark ------------------------------------------------------------------

def leaf_digest(text: Column | None = None) -> Column:
    """SHA-256 (hex) of the row's columns, each ``-`` or byte count, ``:``, value."""
    parts = []
    for name in COLUMNS:
        value = text if name == "text" and text is not None else F.col(name).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value),
                                F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _blocks(items: DataFrame, height: int, name: str) -> DataFrame:
    """Blocks of ``items`` (``tree``, ``i``, ``n`` nodes of the tree's level,
    ``node``, and ``more`` to keep beside a node)."""
    size = FANOUT ** height

    def run(tree, block, n, members):
        members = sorted(members, key=lambda m: m["i"])
        h = min(height, height_of(n))
        nodes, root = build([bytes(m["node"]) for m in members], h)
        return [(tree, block, n, h, len(members), nodes, root, [m["more"] for m in members])]

    more = dict(items.dtypes)["more"]
    grouped = (items.groupBy("tree", F.expr(f"i div {size}").alias("block"))
               .agg(F.max("n").alias("n"), F.collect_list(F.struct("i", "node", "more"))))
    return stage(map_rows(grouped, run, "tree string, block long, n long, h int, size int, "
                          f"nodes binary, root binary, more array<{more}>", chunk=16), name)


def _forest(items: DataFrame, most: int, height: int, name: str) -> list[DataFrame]:
    """All rounds of blocks; ``most`` is the largest tree's number of leaves."""
    size = FANOUT ** height
    rounds = [_blocks(items, height, f"{name}-0")]
    while most > size:
        most = -(-most // size)
        roots = rounds[-1].where(f"n > {size}").select(
            "tree", F.col("block").alias("i"), F.expr(f"(n + {size - 1}) div {size}").alias("n"),
            F.col("root").alias("node"), F.lit(0).alias("more"))
        rounds.append(_blocks(roots, height, f"{name}-{len(rounds)}"))
    return rounds


def _paths(rounds: list[DataFrame], tops: DataFrame, height: int) -> DataFrame:
    """The path of every block of the first round: ``tree``, ``block``, ``above``.
    ``tops`` has the path of every tree's root: ``tree``, ``above``."""
    size = FANOUT ** height
    above = None
    for level in reversed(rounds):
        # blocks that hold their tree's root begin here, others go on from their parent's path
        ends = level.where(f"n <= {size}").select("tree", "block").join(tops, "tree")
        if above is not None:
            ends = ends.unionByName(above)
        if level is rounds[0]:
            return ends

        def run(tree, block, h, n, nodes, path):
            first = block * size
            return [(tree, first + i, part + bytes(path))
                    for i, part in enumerate(siblings(bytes(nodes), h, n))]

        joined = level.select("tree", "block", "h", "size", "nodes").join(ends, ["tree", "block"])
        above = stage(map_rows(joined, run, "tree string, block long, above binary"), "paths")


def manifest(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``leaf``, ``changed_leaf`` (null
    where the row isn't tampered with), ``subroot``, ``root`` (all binary) and
    ``path`` (see ``siblings``), from the leaf to the root."""
    doc_id = F.col("doc_id")
    changed = leaf_digest(F.replace("text", F.lit("\n"), F.lit("")))
    chosen = F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(2)) == 0
    # sorts like the source with null first; AQE can split a hot one in the join below
    tree = F.coalesce(F.concat(F.lit("+"), "source"), F.lit(""))
    leaves = stage(docs.select(
        tree.alias("tree"), doc_id.cast("long").alias("doc_id"),
        F.unhex(leaf_digest()).alias("leaf"),
        F.when(chosen, F.unhex(changed)).alias("changed"), F.lit(1).cast("long").alias("one")),
        "leaves")
    placed = running(leaves, ["tree", "doc_id", "leaf"], "one", "places")
    counts = stage(leaves.groupBy("tree").agg(F.sum("one").alias("n"))
                   .withColumn("one", F.lit(1).cast("long")), "sources")
    most, trees = counts.agg(F.max("n"), F.count("*")).first()
    if not trees:
        return docs.select(doc_id.cast("long").alias("doc_id"), *(
            F.lit(None).cast("binary").alias(c)
            for c in ("leaf", "changed_leaf", "subroot", "root", "path"))).limit(0)
    starts = running(counts, ["tree"], "n", "starts").withColumnRenamed("before", "start")

    items = placed.join(starts.select("tree", "n", "start"), "tree").select(
        "tree", (F.col("before") - F.col("start")).alias("i"), "n", F.col("leaf").alias("node"),
        F.struct("doc_id", "leaf", "changed").alias("more"))
    rounds = _forest(items, most, height, "blocks")
    size = FANOUT ** height
    roots = None
    for level in rounds:
        found = level.where(f"n <= {size}").select("tree", F.col("root").alias("subroot"))
        roots = found if roots is None else roots.unionByName(found)

    # the tree of subroots
    ranks = running(counts, ["tree"], "one", "ranks").select("tree", F.col("before").alias("i"))
    top_items = roots.join(ranks, "tree").select(
        F.lit("").alias("tree"), "i", F.lit(trees).cast("long").alias("n"),
        F.col("subroot").alias("node"), F.struct("tree").alias("more"))
    top_rounds = _forest(top_items, trees, height, "subroots")
    [(root,)] = top_rounds[-1].select("root").collect()  # one block is left
    root = bytes(root)

    no_path = docs.sparkSession.createDataFrame([("", b"")], "tree string, above binary")
    top_paths = top_rounds[0].join(_paths(top_rounds, no_path, height), ["tree", "block"])

    def top(size_, h, nodes, above, more):
        return [(m["tree"], part + bytes(above))
                for part, m in zip(siblings(bytes(nodes), h, size_), more, strict=True)]

    tops = stage(map_rows(top_paths.select("size", "h", "nodes", "above", "more"), top,
                          "tree string, above binary"), "tops")

    def emit(subroot, h, size_, nodes, above, more):
        return [(m["doc_id"], m["leaf"], m["changed"], subroot, root, part + bytes(above))
                for part, m in zip(siblings(bytes(nodes), h, size_), more, strict=True)]

    blocks = (rounds[0].join(_paths(rounds, tops, height), ["tree", "block"])
              .join(roots, "tree").select("subroot", "h", "size", "nodes", "above", "more"))
    return map_rows(blocks, emit, "doc_id long, leaf binary, changed_leaf binary, "
                    "subroot binary, root binary, path binary", chunk=1024)


def verify(rows: DataFrame) -> DataFrame:
    """Digest of every proof, and whether the row as it is now (``changed_leaf``,
    else ``leaf``) leads to the root."""
    def run(doc_id, leaf, changed, subroot, root, path):
        leaf, root, path = bytes(leaf), bytes(root), bytes(path)
        folded = fold(leaf if changed is None else bytes(changed), path)
        return [(doc_id, leaf.hex(), bytes(subroot).hex(), root.hex(), proof_digest(path),
                 folded.hex(), folded == root)]
    return map_rows(rows.select("doc_id", "leaf", "changed_leaf", "subroot", "root", "path"), run,
                    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
                    "folded_root string, verified boolean")
