"""A Merkle manifest of a table, kept in blocks of van Emde Boas layout.

Rows are leaves of one tree for each group (a source, for one), 16 children a node; the roots of the
groups are the leaves of a last tree, whose root names the whole table. A tree is cut into aligned
subtrees of three levels of edges, at most 4,096 leaves each. A block holds its nodes in one byte
string in van Emde Boas order: the tree is split at half its height, the upper half comes first, then
each lower tree, and every part is laid out in the same way. A node's place follows by arithmetic from
its level and index, also in blocks that the last leaves do not fill, so no index is stored. The same
arithmetic serves the construction, which hashes a block from below, and the reading of siblings.

Block roots are the leaves of the next tier, in which the same is done again. A proof is read from
above: each block's path to the root is found once and handed to the blocks below it, so a row only
adds the siblings inside its own block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import saved

FANOUT = 16
#: Levels of edges in a block.
HEIGHT = 3
BLOCK_LEAVES = FANOUT**HEIGHT
BLOCKS_AT_ONCE = 32
DIGEST = 32

PATH = "at array<int>, siblings array<binary>, subroot binary, root binary"
BLOCK = "tree long, block long, n long, ids array<long>, claimed array<binary>, digests binary"
VERDICTS = "id long, leaf binary, subroot binary, root binary, proof binary, folded binary"


def _up(n: int, by: int) -> int:
    return -(-n // by)


def nodes(levels: int, leaves: int) -> int:
    """Nodes of a tree of so many levels whose lowest one holds ``leaves``, packed to the left."""
    return sum(_up(leaves, FANOUT**k) for k in range(levels))


def address(levels: int, leaves: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places, in van Emde Boas order, of the nodes ``index`` of level ``depth`` (the root's level is 0)."""
    if levels == 1:
        return np.zeros_like(index)
    top = levels // 2
    low = levels - top
    if depth < top:
        return address(top, _up(leaves, FANOUT**low), depth, index)
    full = FANOUT ** (low - 1)
    tree, inside = np.divmod(index, FANOUT ** (depth - top))
    place = address(low, full, depth - top, inside)
    last = _up(leaves, full) - 1
    if leaves < (last + 1) * full:  # the last lower tree is not full
        place = np.where(tree == last, address(low, leaves - last * full, depth - top, inside), place)
    return nodes(top, _up(leaves, FANOUT**low)) + tree * nodes(low, full) + place


@lru_cache(maxsize=64)
def places(height: int, leaves: int) -> list[np.ndarray]:
    """The places of all nodes by level."""
    return [address(height + 1, leaves, d, np.arange(_up(leaves, FANOUT ** (height - d)))) for d in range(height + 1)]


def height_of(n: int) -> int:
    """Levels of edges of a block in a tier of ``n`` leaves: as few as ``n`` need, ``HEIGHT`` at most."""
    height = 0
    while FANOUT**height < min(n, BLOCK_LEAVES):
        height += 1
    return height


def combine(hexes: str) -> bytes:
    """The hash of concatenated digests, as hex text."""
    return hashlib.sha256(hexes.encode("ascii")).digest()


def build(leaves: list[bytes], height: int) -> bytes:
    """The digests of a block in van Emde Boas order."""
    at = places(height, len(leaves))
    store = np.zeros((nodes(height + 1, len(leaves)), DIGEST), np.uint8)
    store[at[height]] = np.frombuffer(b"".join(leaves), np.uint8).reshape(-1, DIGEST)
    for depth in range(height - 1, -1, -1):
        below = at[depth + 1]
        for i, place in enumerate(at[depth]):
            run = store[below[FANOUT * i : FANOUT * (i + 1)]]
            store[place] = np.frombuffer(combine(run.tobytes().hex()), np.uint8)
    return store.tobytes()


class Block:
    """A block as stored; siblings are read by address."""

    def __init__(self, digests: bytes, leaves: int, n: int):
        self.height, self.leaves = height_of(n), leaves
        self.at = places(self.height, leaves)
        self.store = np.frombuffer(digests, np.uint8).reshape(-1, DIGEST)

    def leaf(self, i: int) -> bytes:
        return self.store[self.at[self.height][i]].tobytes()

    def siblings(self, depth: int, i: int) -> tuple[int, bytes]:
        """The place of node ``i`` of a level in its run, and the digests of the others, left to right."""
        run = self.at[depth][FANOUT * (i // FANOUT) : FANOUT * (i // FANOUT + 1)]
        own = i % FANOUT
        return own, self.store[np.delete(run, own)].tobytes()

    def path(self, i: int) -> list[tuple[int, bytes]]:
        """From leaf ``i`` up to the block's root."""
        out = []
        for depth in range(self.height, 0, -1):
            out.append(self.siblings(depth, i))
            i //= FANOUT
        return out


def fold(digest: bytes, path: list[tuple[int, bytes]]) -> bytes:
    """The root that a digest and its siblings lead to."""
    for own, others in path:
        digest = combine((others[: own * DIGEST] + digest + others[own * DIGEST :]).hex())
    return digest


def _builder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), BLOCKS_AT_ONCE):
            part = batch.slice(at, BLOCKS_AT_ONCE)
            digests = [build(leaves, height_of(n)) for n, leaves in zip(part.column(2).to_pylist(), part.column(5).to_pylist(), strict=True)]
            yield pa.record_batch([*part.columns[:5], pa.array(digests, pa.binary())], names=["tree", "block", "n", "ids", "claimed", "digests"])


def _tier(leaves: DataFrame, name: str, keep: bool) -> DataFrame:
    """The blocks of one tier from its leaves: ``tree``, ``pos``, ``n`` (leaves of the tree), ``id``, ``leaf``, ``claimed``."""
    block = F.floor(F.col("pos") / BLOCK_LEAVES).cast("long").alias("block")
    rows = leaves.groupBy("tree", block).agg(F.min("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", "id", "claimed", "leaf"))).alias("rows"))
    lists = rows.select("tree", "block", "n", *(F.col(f"rows.{c}").alias(t) for c, t in (("id", "ids"), ("claimed", "claimed"), ("leaf", "leaves"))))
    return saved(lists.mapInArrow(_builder, BLOCK), name, keep)


def _forest(leaves: DataFrame, name: str, keep: bool) -> list[DataFrame]:
    """All tiers, from the leaves up. A tree goes on to the next tier while it has more than one block."""
    tiers = [_tier(leaves, f"{name}0", keep)]
    while not (rest := tiers[-1].where(F.col("n") > BLOCK_LEAVES)).isEmpty():
        up = rest.select("tree", F.col("block").alias("pos"), F.ceil(F.col("n") / BLOCK_LEAVES).alias("n"), F.col("block").alias("id"), _root("digests").alias("leaf"), F.lit(None).cast("binary").alias("claimed"))
        tiers.append(_tier(up, f"{name}{len(tiers)}", keep))
    return tiers


def _root(digests: str) -> Column:
    return F.substring(F.col(digests), 1, DIGEST)


def ranked(rows: DataFrame, by: list[str], name: str) -> DataFrame:
    """A written table of ``rows`` with ``place``, their number in the order of ``by``, from 0.

    Ranges of the order are sorted apart and shifted by the sizes of the ranges before them; one number
    a range reaches the driver. Rows that tie are told apart by where they were read, so that they
    spread over ranges too.
    """
    told = rows.withColumn("_read", F.monotonically_increasing_id())
    order = told.repartitionByRange(*by, "_read").sortWithinPartitions(*by, "_read").drop("_read")
    table = saved(order.withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftright("_at", 33).cast("int")
    sizes = {r[0]: r[1] for r in table.groupBy(part.alias("part")).count().collect()}
    before = np.cumsum([0, *(sizes.get(p, 0) for p in range(max(sizes, default=0)))]).tolist()
    shift = F.element_at(F.array(*(F.lit(x).cast("long") for x in before)), part + 1)
    return table.select(*rows.columns, part.alias("part"), (shift + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).alias("place"))


@dataclass(frozen=True)
class Manifest:
    """Tiers of the groups' trees and of the tree over their roots, each from the leaves up."""

    groups: list[DataFrame]
    over: list[DataFrame]


def digest(fields: dict[str, Column]) -> Column:
    """Hash (hex) of values in order: ``-`` for null, else the count of UTF-8 bytes, ``:``, and the value."""
    shown = [v.cast("string") for v in fields.values()]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")) for s in shown)).cast("binary"), 256)


def manifest(docs: DataFrame, fields: tuple[str, ...], tree: str, order: str, claimed: dict[str, Column] | None = None, claims: Column | None = None) -> Manifest:
    """Write the manifest of ``docs``; a leaf is the ``digest`` of ``fields``.

    Trees are the values of ``tree`` (null first, then by UTF-8 bytes); inside, leaves ascend by
    ``order`` (an integer, null first), ties by digest, so repeated rows are repeated leaves. ``claimed``
    replaces fields by what a later copy of the table holds, in rows where ``claims`` is true; the digest
    of that goes next to the leaf, for ``verify``. Other columns are not read. An empty table has no
    blocks. Texts are read once and never shuffled; what is sorted and grouped is about 100 bytes a row.
    """
    fresh = {c: F.col(f"`{c}`") for c in fields}
    other = F.unhex(F.when(claims, digest(fresh | claimed))) if claimed else F.lit(None).cast("binary")
    rows = docs.select(F.col(f"`{tree}`").cast("string").alias("group"), F.col(f"`{order}`").cast("long").alias("id"), F.unhex(digest(fresh)).alias("leaf"), other.alias("claimed"))
    rows = ranked(saved(rows, "digests"), ["group", "id", "leaf"], "rows")  # ranges are drawn from the digests, not from the texts
    # a range holds few groups or one group's part, so these are about as many as groups and ranges
    runs = saved(rows.groupBy("part", "group").agg(F.min("place").alias("first"), F.count("*").alias("size")), "runs")
    whole = runs.groupBy("group").agg(F.min("first").alias("tree"), F.sum("size").alias("n")).withColumnRenamed("group", "g")
    starts = runs.join(whole, F.col("group").eqNullSafe(F.col("g"))).select(F.col("part").alias("p"), "g", "tree", "n")
    met = rows.join(starts, (F.col("part") == F.col("p")) & F.col("group").eqNullSafe(F.col("g")))
    groups = _forest(met.select("tree", (F.col("place") - F.col("tree")).alias("pos"), "n", "id", "leaf", "claimed"), "groups", keep=True)
    roots = ranked(subroots(groups).select(F.col("tree").alias("id"), F.col("subroot").alias("leaf")), ["id"], "roots")
    n = roots.count()
    over = roots.select(F.lit(0).cast("long").alias("tree"), F.col("place").alias("pos"), F.lit(n).cast("long").alias("n"), "id", "leaf", F.lit(None).cast("binary").alias("claimed"))
    return Manifest(groups, _forest(over, "over", keep=True))


def subroots(tiers: list[DataFrame]) -> DataFrame:
    """``tree``, ``tier`` of its last block, ``subroot``."""
    tops = [t.where(F.col("n") <= BLOCK_LEAVES).select("tree", F.lit(i).alias("tier"), _root("digests").alias("subroot")) for i, t in enumerate(tiers)]
    out = tops[0]
    for t in tops[1:]:
        out = out.union(t)
    return out


def _met(tier: DataFrame, paths: DataFrame) -> DataFrame:
    return tier.join(paths.select(F.col("tree").alias("t"), F.col("block").alias("b"), "at", "siblings", "subroot", "root"), (F.col("tree") == F.col("t")) & (F.col("block") == F.col("b"))).drop("t", "b")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Block, list[tuple[int, bytes]]]]:
    for batch in batches:
        for i in range(len(batch)):
            row = batch.slice(i, 1).to_pylist()[0]
            yield row, Block(row["digests"], len(row["ids"]), row["n"]), list(zip(row["at"], row["siblings"], strict=True))


def _descend(into_trees: bool):
    """Hands a block's path on to its leaves: blocks of the tier below, or trees of which it holds the roots."""
    schema = pa.schema([("tree", pa.int64()), ("block", pa.int64()), ("at", pa.list_(pa.int32())), ("siblings", pa.list_(pa.binary())), ("subroot", pa.binary()), ("root", pa.binary())])

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, block, above in _blocks(batches):
            for lo in range(0, block.leaves, 1024):
                rows = range(lo, min(lo + 1024, block.leaves))
                paths = [block.path(i) + above for i in rows]
                ids = [row["ids"][i] for i in rows]
                trees, blocks = (ids, [0] * len(ids)) if into_trees else ([row["tree"]] * len(ids), ids)
                subroot = [block.leaf(i) for i in rows] if into_trees else [row["subroot"]] * len(ids)
                yield pa.record_batch([trees, blocks, [[a for a, _ in p] for p in paths], [[s for _, s in p] for p in paths], subroot, [row["root"]] * len(ids)], schema=schema)

    return descend


def block_paths(made: Manifest) -> DataFrame:
    """``tree``, ``block``, the path from the block's root to the root of all, ``subroot`` and ``root``.

    A row for each block of leaves, found from the root down, one tier at a time.
    """
    fields = f"tree long, block long, {PATH}"
    top = made.over[-1]
    empty = "cast(array() as array<int>) at", "cast(array() as array<binary>) siblings", "cast(null as binary) subroot"
    paths = top.selectExpr("tree", "block", *empty, f"substring(digests, 1, {DIGEST}) root")
    for tier in made.over[:0:-1]:
        paths = saved(_met(tier, paths).mapInArrow(_descend(False), fields), "paths")
    starts = saved(_met(made.over[0], paths).mapInArrow(_descend(True), fields), "starts").join(subroots(made.groups).select("tree", "tier"), "tree")
    paths = None
    for i in range(len(made.groups) - 1, -1, -1):
        here = starts.where(F.col("tier") == i).drop("tier")
        paths = here if paths is None else here.union(_met(made.groups[i + 1], paths).mapInArrow(_descend(False), fields))
        paths = saved(paths, "paths")
    return paths


def proofs(made: Manifest) -> DataFrame:
    """For each row: ``id``, ``leaf``, its places ``at`` in the runs on its way up, and the ``siblings`` there."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, block, above in _blocks(batches):
            for lo in range(0, block.leaves, 256):
                paths = [block.path(i) + above for i in range(lo, min(lo + 256, block.leaves))]
                ids, leaves = row["ids"][lo : lo + 256], [block.leaf(i) for i in range(lo, lo + len(paths))]
                yield pa.record_batch(
                    [pa.array(ids, pa.int64()), pa.array(leaves, pa.binary()), pa.array([[a for a, _ in p] for p in paths], pa.list_(pa.int32())), pa.array([[s for _, s in p] for p in paths], pa.list_(pa.binary()))],
                    names=["id", "leaf", "at", "siblings"],
                )

    return _met(made.groups[0], block_paths(made)).mapInArrow(each, "id long, leaf binary, at array<int>, siblings array<binary>")


def _judge(row: dict, block: Block, above: list[tuple[int, bytes]]) -> Iterator[tuple[bytes, bytes, bytes]]:
    """Leaf, hash of the proof and folded root of each leaf of a block; what leaves share on the way up is hashed once."""
    rest = "".join(s.hex() for _, s in above)
    tails = {(0, 0): rest}  # siblings from a node up
    for depth in range(1, block.height):
        for i in range(len(block.at[depth])):
            tails[depth, i] = block.siblings(depth, i)[1].hex() + tails[depth - 1, i // FANOUT]
    known: dict[tuple[int, int, bytes], bytes] = {}

    def up(depth: int, i: int, digest: bytes) -> bytes:
        key = (depth, i, digest)
        if key not in known:
            known[key] = fold(digest, above) if not depth else up(depth - 1, i // FANOUT, fold(digest, [block.siblings(depth, i)]))
        return known[key]

    for i, claimed in enumerate(row["claimed"]):
        leaf = block.leaf(i)
        if not block.height:
            yield leaf, combine(rest), fold(claimed or leaf, above)
            continue
        own, others = block.siblings(block.height, i)
        folded = fold(claimed or leaf, [(own, others)])
        yield leaf, combine(others.hex() + tails[block.height - 1, i // FANOUT]), up(block.height - 1, i // FANOUT, folded)


def _verifier(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["id", "leaf", "subroot", "root", "proof", "folded"]
    for row, block, above in _blocks(batches):
        found = list(_judge(row, block, above))
        same = [pa.array([row[c]] * len(found), pa.binary()) for c in ("subroot", "root")]
        yield pa.record_batch([pa.array(row["ids"], pa.int64()), pa.array([f[0] for f in found], pa.binary()), *same, pa.array([f[1] for f in found], pa.binary()), pa.array([f[2] for f in found], pa.binary())], names=names)


def verify(made: Manifest) -> DataFrame:
    """For each row: ``id``, ``leaf``, ``subroot``, ``root``, ``proof`` (hash of its siblings), ``folded``.

    ``folded`` is the root recomputed from the claimed digest, or the leaf where none is claimed, and the
    stored siblings. It equals ``root`` if and only if the row is as it was.
    """
    return _met(made.groups[0], block_paths(made)).mapInArrow(_verifier, VERDICTS)


def lower_ascii(text: Column) -> Column:
    """A-Z in small letters, all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
