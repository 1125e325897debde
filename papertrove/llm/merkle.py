"""Merkle manifest of a table: one digest per row, a tree of threes per source, and a tree over the sources.

Digests are SHA-256 of concatenated inputs, where digests count as lowercase hex text. A tree is cut into aligned blocks
of ``3 ** HEIGHT`` neighbouring nodes. Every block is built by one task, its top is a node of the next level, and levels
follow until one node is left, so no task ever holds more than one block.

A changed row makes a new version of its block's tree by path copying: the leaf and its ancestors inside the block are
copied, every other node is shared with the first version. Above the block the version goes on from the nodes that it
shares with the blocks beside it: they come down the levels as one path per block, are copied into nobody's tree, and
only the digests between the block and the root are made anew.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from papertrove.llm.words import table
from papertrove.sources import stage

RUN = 3
#: Levels of one block; a block has ``RUN ** HEIGHT`` nodes at most.
HEIGHT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_DIGEST = 32


def hashed(parts: list[bytes]) -> bytes:
    """The digest of some digests, taken as hex text."""
    return hashlib.sha256(b"".join(parts).hex().encode()).digest()


class Versions:
    """A tree over some nodes, and the versions that come of changing one leaf at a time.

    ``digests[i]`` and ``children[i]`` describe node ``i`` and never change; a version is the number of its top node.
    ``height`` levels are built, or as many as it takes to come to one node.
    """

    def __init__(self, leaves: list[bytes], height: int | None = None):
        self.digests = list(leaves)
        self.children: list[tuple[int, ...]] = [()] * len(leaves)
        self.levels = [range(len(leaves))]
        while len(self.levels) <= height if height is not None else len(self.levels[-1]) > 1:
            nodes = self.levels[-1]
            start = len(self.digests)
            for at in range(0, len(nodes), RUN):
                self._add(tuple(nodes[at : at + RUN]))
            self.levels.append(range(start, len(self.digests)))
        self.first = self.levels[-1][0]

    def _add(self, children: tuple[int, ...]) -> int:
        self.digests.append(hashed([self.digests[child] for child in children]))
        self.children.append(children)
        return len(self.digests) - 1

    def siblings(self, leaf: int) -> list[tuple[list[bytes], list[bytes]]]:
        """Digests left and right of the way from a leaf to the top of the first version, by level."""
        found = []
        for nodes in self.levels[:-1]:
            start = leaf // RUN * RUN
            run = [self.digests[node] for node in nodes[start : start + RUN]]
            found.append((run[: leaf - start], run[leaf - start + 1 :]))
            leaf //= RUN
        return found

    def changed(self, leaf: int, digest: bytes) -> int:
        """A version of the first one with another leaf: copies of its ancestors, all other nodes shared."""
        self.digests.append(digest)
        self.children.append(())
        copy = len(self.digests) - 1
        for parents in self.levels[1:]:
            run = list(self.children[parents[leaf // RUN]])
            run[leaf % RUN] = copy
            copy = self._add(tuple(run))
            leaf //= RUN
        return copy


def to_path(siblings: list[tuple[list[bytes], list[bytes]]]) -> bytes:
    """Siblings by level as bytes: how many there are left and right, and their digests."""
    return b"".join(bytes([len(left), len(right)]) + b"".join([*left, *right]) for left, right in siblings)


def from_path(path: bytes) -> list[tuple[list[bytes], list[bytes]]]:
    found, at = [], 0
    while at < len(path):
        left, right = path[at], path[at + 1]
        at += 2
        digests = [path[at + _DIGEST * i : at + _DIGEST * (i + 1)] for i in range(left + right)]
        found.append((digests[:left], digests[left:]))
        at += _DIGEST * (left + right)
    return found


def folded(digest: bytes, siblings: list[tuple[list[bytes], list[bytes]]]) -> bytes:
    """The top that a node and its siblings come to."""
    for left, right in siblings:
        digest = hashed([*left, digest, *right])
    return digest


def row_digest(text: Column, fields: tuple[str, ...] = FIELDS) -> Column:
    """The digest of a row with ``text`` in place of its own: per field ``-`` for null, else bytes, colon and value."""
    parts = []
    for field in fields:
        value = (text if field == "text" else F.col(field)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _with_places(nodes: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """``pos`` of every node in its ``tree`` by ``order``, and the ``size`` of the tree.

    Rows are dealt by ranges, counted per task and tree, and placed by the sums of these counts, so a tree may be spread
    over any number of tasks. Wholly equal rows are dealt by where they were read.
    """

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, tree, place = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            places = []
            for name in batch.column("tree").to_pylist():
                place = place + 1 if name == tree else 0
                tree = name
                places.append(place)
            parts = pa.array([part] * len(places), pa.int32())
            columns = [*batch.columns, parts, pa.array(places, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "part", "place"])

    keys = ("tree", *order)
    dealt = nodes.withColumn("read_at", F.monotonically_increasing_id()).repartitionByRange(*keys, "read_at")
    dealt = dealt.sortWithinPartitions(*keys).drop("read_at")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema.fields)
    rows = stage(dealt.mapInArrow(numbered, f"{schema}, part int, place long"), "merkle-rows")
    counts = rows.groupBy("tree", "part").agg(F.count("*").alias("n"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "tree", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"), F.sum("n").over(tree).alias("size")
    )
    placed = rows.join(offsets, ["tree", "part"])
    return placed.withColumn("pos", F.col("offset") + F.col("place")).drop("part", "place", "offset")


_NODE = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("size", pa.int64()), ("digest", pa.binary())])
_NODE_SQL = "tree string, pos long, size long, digest binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of one block after the other, out of rows sorted by tree and block."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and (row["tree"], row["block"]) != (held[0]["tree"], held[0]["block"]):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _tree_of(rows: list[dict], width: int, height: int) -> Versions:
    """The tree of a block; where its tree has more blocks, all of its levels are built, even over a single node."""
    return Versions([row["digest"] for row in rows], height if rows[0]["size"] > width else None)


def _by_block(nodes: DataFrame, width: int) -> DataFrame:
    block = F.floor(F.col("pos") / F.lit(width)).cast("long")
    dealt = nodes.withColumn("block", block).repartition("tree", "block")
    return dealt.sortWithinPartitions("tree", "block", "pos")


def _in_batches(schema: pa.Schema, rows: Iterator[dict], size: int = 8192) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield table(schema, **{name: [r[name] for r in held] for name in schema.names})
            held = []
    yield table(schema, **{name: [r[name] for r in held] for name in schema.names})


def _raised(nodes: DataFrame, height: int) -> list[DataFrame]:
    """All levels of blocks above some placed nodes; the last one has the top of every tree and nothing else."""
    width = RUN**height

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for block in _blocks(batches):
                built = _tree_of(block, width, height)
                yield {
                    "tree": block[0]["tree"],
                    "pos": block[0]["block"],
                    "size": -(-block[0]["size"] // width),
                    "digest": built.digests[built.first],
                }

        return _in_batches(_NODE, rows())

    levels = [nodes.select("tree", "pos", "size", "digest")]
    while True:
        levels.append(stage(_by_block(levels[-1], width).mapInArrow(tops, _NODE_SQL), "merkle-level"))
        if not (levels[-1].agg(F.max("size")).first()[0] or 0) > 1:
            return levels


_PATH_SQL = "tree string, block long, path binary, subroot binary, root binary"


def _with_paths(nodes: DataFrame, paths: DataFrame, width: int) -> DataFrame:
    """Nodes by block, each block led by the row with its own path to the root (position -1)."""
    led = paths.select("tree", "block", F.lit(-1).cast("long").alias("pos"), "path", "subroot", "root")
    block = F.floor(F.col("pos") / F.lit(width)).cast("long")
    both = nodes.withColumn("block", block).unionByName(led, allowMissingColumns=True)
    return both.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")


def _child_paths(nodes: DataFrame, paths: DataFrame, height: int, of_sources: bool = False) -> DataFrame:
    """The path of every node, from those of the blocks they lie in, as the path of the block that the node stands for.

    A node over sources (``of_sources``) stands for the top of that source's own tree.
    """
    schema = pa.schema([("tree", pa.string()), ("block", pa.int64()), *[(n, pa.binary()) for n in ("path", "subroot", "root")]])
    width = RUN**height

    def lowered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for lead, *block in _blocks(batches):
                built = _tree_of(block, width, height)
                for i, row in enumerate(block):
                    found = {"path": to_path(built.siblings(i)) + lead["path"], "root": lead["root"]}
                    if of_sources:
                        yield found | {"tree": row["source"], "block": 0, "subroot": row["digest"]}
                    else:
                        yield found | {"tree": row["tree"], "block": row["pos"], "subroot": lead["subroot"]}

        return _in_batches(schema, rows(), 1024)

    return stage(_with_paths(nodes, paths, width).mapInArrow(lowered, _PATH_SQL), "merkle-paths")


def _lowered(levels: list[DataFrame], tops: DataFrame, height: int) -> DataFrame:
    """Paths to the root of all blocks of the lowest level, from the paths of the trees' tops.

    ``tops`` has ``tree, block`` (0), ``path, subroot, root``.
    """
    paths = tops
    for nodes in reversed(levels[1:-1]):
        paths = _child_paths(nodes, paths, height)
    return paths


_PROOF = pa.schema(
    [
        ("doc_id", pa.int64()),
        *[(name, pa.string()) for name in ("leaf", "subroot", "root", "proof_sha256", "folded_root")],
        ("verified", pa.bool_()),
        ("n_copied", pa.int64()),
    ]
)
_PROOF_SQL = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, "
    "n_copied long"
)


def manifest(documents: DataFrame, changed_text: Column | None = None, height: int = HEIGHT) -> DataFrame:
    """One row per row of ``documents``: its leaf, its source's root, the table's root, its proof and what that proves.

    ``documents`` has ``doc_id, source, lang, n_chars, text``; other columns do not matter. ``changed_text`` is the text
    to be checked against the manifest (null: the row is untouched). ``folded_root`` is the root of the version with
    the changed leaf, ``n_copied`` how many nodes that version copied inside its block. Leaves ascend by ``doc_id`` (null
    first; ties by digest), sources by their bytes (null first). Any column may be null; an empty text is not null. An
    empty table gives no rows; a table of one row is its own root and has an empty proof.
    """
    width = RUN**height
    touched = F.lit(None).cast("string") if changed_text is None else changed_text
    leaves = documents.select(
        F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        row_digest(F.col("text")).alias("digest"),
        F.when(touched.isNotNull(), row_digest(touched)).alias("changed"),
    )
    # Two levels read these rows; the join that places them is done once.
    leaves = stage(_with_places(leaves, ("doc_id", "digest")), "merkle-leaves")
    levels = _raised(leaves, height)
    sources = levels[-1].select(F.lit("").alias("tree"), F.col("tree").alias("source"), "digest")
    sources = stage(_with_places(sources, ("source",)), "merkle-sources")
    over = _raised(sources, height)
    none = F.lit(b"")
    root = over[-1].select("tree", F.col("pos").alias("block"), none.alias("path"), none.alias("subroot"), F.col("digest").alias("root"))
    tops = _child_paths(sources, _lowered(over, root, height), height, of_sources=True)
    led = _with_paths(leaves, _lowered(levels, tops, height), width)

    def proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for lead, *block in _blocks(batches):
                built = _tree_of(block, width, height)
                above, root = from_path(lead["path"]), lead["root"]
                beyond = b"".join(digest for pair in above for side in pair for digest in side)
                untouched = folded(built.digests[built.first], above).hex()
                for i, row in enumerate(block):
                    inside = b"".join(digest for pair in built.siblings(i) for side in pair for digest in side)
                    proven, copied = untouched, 0
                    if row["changed"] is not None and row["changed"] != row["digest"]:
                        size = len(built.digests)
                        version = built.changed(i, row["changed"])
                        copied = len(built.digests) - size
                        proven = folded(built.digests[version], above).hex()
                    yield {
                        "doc_id": row["doc_id"],
                        "leaf": row["digest"].hex(),
                        "subroot": lead["subroot"].hex(),
                        "root": root.hex(),
                        "proof_sha256": hashlib.sha256((inside + beyond).hex().encode()).hexdigest(),
                        "folded_root": proven,
                        "verified": proven == root.hex(),
                        "n_copied": copied,
                    }

        return _in_batches(_PROOF, rows(), 2048)

    return led.mapInArrow(proofs, _PROOF_SQL)


def tampered_text() -> Column:
    """The text without its line breaks where the checksum of the decimal ``doc_id`` is even; null elsewhere."""
    even = F.crc32(F.encode(F.col("doc_id").cast("long").cast("string"), "UTF-8")) % 2 == 0
    return F.when(even, F.replace(F.col("text").cast("string"), F.lit("\n"), F.lit("")))
