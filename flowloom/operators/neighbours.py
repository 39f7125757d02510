"""Exact nearest neighbours by a tree of median cuts over all coordinates."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import col
from ..plans.bounded import LOOKUP_BYTES, LOOKUP_ROWS, lookup_join
from ..plans.checkpoints import durable, spread

# Rows of a leaf and of a block of donors, and rows of a pack of queries.
LEAF = 2_000
# Queries compared with a block at a time, which bounds a task's memory.
CHUNK = 500
# Results of so many comparisons leave a task together.
PARTS = 64
# Cuts below a node: 2 ** DEPTH children. They are drawn from so many of its rows.
DEPTH, SAMPLE = 6, 4_096
# Leaves that each query visits before its bound is taken again.
FIRST_VISITS = 4
# Tasks over which the queries of one leaf are dealt.
SPREAD = 16
# Groups of donors whose least distances bound the k-th one, for each of the k.
GROUPS = 12
# Distances of queries to leaf boxes that a task holds at a time.
BOX_CELLS = 2_000_000
# Box distances are compared with distances that are rounded in another order.
ROUNDING = 1 - 1e-12


@dataclass(frozen=True)
class Tree:
    """``levels``: the nodes of each level with their boxes; ``cuts``: those below each level but the last;
    ``blocks``: the rows of the leaves, packed."""

    levels: list[DataFrame]
    cuts: list[DataFrame]
    blocks: DataFrame
    width: int


def _cutter(xs: list[str]):
    """Median cuts of a node from some of its rows, as a heap: the left child takes values up to the cut.

    The coordinate of largest spread is cut; where none varies, values are parted from missing ones. A
    cut always parts the rows it was drawn from. An axis of -1 cuts nothing.
    """

    def cut(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf[xs].to_numpy(float)
        axes, cuts = np.full(2**DEPTH - 1, -1), np.zeros(2**DEPTH - 1)
        open_ = {0: np.arange(len(x))}
        for node in range(2**DEPTH - 1):
            rows = open_.pop(node, None)
            if rows is None or len(rows) < 2:
                continue
            part, known = x[rows], ~np.isnan(x[rows])
            some = known.any(axis=0)
            high, low = np.where(known, part, -np.inf).max(axis=0), np.where(known, part, np.inf).min(axis=0)
            spread = np.where(some, high - low, 0.0)
            mixed = np.flatnonzero(some & ~known.all(axis=0))
            if spread.max(initial=0) > 0:
                axis = int(spread.argmax())
                values = np.sort(part[known[:, axis], axis])
                at = values[(len(values) - 1) // 2]
                at = at if at < values[-1] else values[values < at][-1]
            elif len(mixed):
                axis, at = int(mixed[0]), -np.inf
            else:
                continue
            axes[node], cuts[node] = axis, at
            right = part[:, axis] > at
            open_[2 * node + 1], open_[2 * node + 2] = rows[~right], rows[right]
        return pd.DataFrame({"node": pdf["node"].iloc[:1], "axes": [axes.tolist()], "cuts": [cuts.tolist()]})

    return cut


def _child(xs: list[str]) -> Column:
    """The place below its node to which a row's cuts lead."""
    point = F.array(*[F.col(x) for x in xs])

    def step(at: Column, _: Column) -> Column:
        axis = F.element_at("axes", at + 1)
        right = F.when(axis < 0, 0).when(F.element_at(point, F.greatest(axis, F.lit(0)) + 1) > F.element_at("cuts", at + 1), 1).otherwise(0)
        return 2 * at + 1 + right

    return F.aggregate(F.sequence(F.lit(1), F.lit(DEPTH)), F.lit(0), step) - (2**DEPTH - 1)


def _next(xs: list[str]) -> Column:
    """The node of the next level to which a row's cuts lead."""
    return F.col("node") * 2**DEPTH + 1 + _child(xs)


def _boxes(rows: DataFrame, xs: list[str]) -> DataFrame:
    """``n`` and, per coordinate, the ends of the known values and whether all are known."""
    ends = [a for i, x in enumerate(xs) for a in (F.min(x).alias(f"l{i}"), F.max(x).alias(f"h{i}"), (F.count(x) == F.count("*")).alias(f"f{i}"))]
    return durable(rows.groupBy("parent", "node").agg(F.count("*").alias("n"), *ends))


def build_tree(donors: DataFrame, xs: list[str], k: int, leaf: int = LEAF) -> Tree:
    """A tree over ``donors`` (``t`` and the coordinates ``xs``; missing ones are null).

    Of equal points only the ``k`` smallest values stay, as no query needs more. Each round cuts all nodes
    above ``leaf`` rows into up to 2 ** DEPTH children; the cuts come from a bounded sample of each node,
    boxes and counts from all its rows. Nodes, cuts and rows are tables; a round is a few joins and
    aggregates, and rounds grow with the logarithm of the number of rows.
    """
    best = Window.partitionBy(*xs).orderBy("t")
    rows = donors.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k).drop("_n")
    rows = durable(rows.withColumns({"parent": F.lit(-1).cast("long"), "node": F.lit(0).cast("long")}))
    levels, all_cuts, done = [_boxes(rows, xs)], [], []
    while True:
        sizes = levels[-1].join(levels[-2].select(F.col("node").alias("parent"), F.col("n").alias("above")), "parent") if len(levels) > 1 else levels[-1].withColumn("above", F.lit(None).cast("long"))
        # a node that its cuts did not part stays a leaf
        open_ = durable(sizes.where((F.col("n") > leaf) & (F.col("above").isNull() | (F.col("n") < F.col("above")))).select("node", "n"))
        done.append(lookup_join(rows, open_, ["node"], "left_anti").select("node", "t", *xs))
        levels[-1] = durable(lookup_join(levels[-1], open_.select("node", F.lit(True).alias("cut")), ["node"]).withColumn("is_leaf", F.col("cut").isNull()).drop("cut"))
        if open_.isEmpty():
            break
        rows = lookup_join(rows, open_, ["node"], "inner")
        sample = _drawn(rows, xs)
        cuts = durable(sample.groupBy("node").applyInPandas(_cutter(xs), "node long, axes array<int>, cuts array<double>"))
        all_cuts.append(cuts)
        met = lookup_join(rows, cuts, ["node"], "inner")
        rows = durable(met.select(F.col("node").alias("parent"), _next(xs).alias("node"), "t", *xs))
        levels.append(_boxes(rows, xs))
    leaves = done[0]
    for part in done[1:]:
        leaves = leaves.union(part)
    # a leaf is bounded, so it is one block; parts of it would each be met by every pack of queries
    packed = leaves.repartition("node").mapInPandas(_packer(leaf, ["t", *xs]), "node long, n int, keys string, rows binary")
    return Tree(levels, all_cuts, durable(packed.select("node", "n", "rows")), len(xs))


def _drawn(rows: DataFrame, xs: list[str]) -> DataFrame:
    """The ``SAMPLE`` rows of smallest hash of each node of ``n`` rows.

    Rows whose hash cannot be among them, by a wide margin, are left out before nodes are gathered, so
    a node of any size reaches one task as a few thousand rows.
    """
    at = F.xxhash64(*xs, "t")
    upto = (2 * SAMPLE / F.col("n") - 0.5) * 2.0**64
    some = rows.withColumn("_h", at).where((F.col("n") <= 2 * SAMPLE) | (F.col("_h").cast("double") <= upto))
    place = F.row_number().over(Window.partitionBy("node").orderBy("_h"))
    return some.withColumn("_n", place).where(F.col("_n") <= SAMPLE).select("node", *xs)


def _packer(most: int, names: list[str], in_order: bool = False):
    """Packs the rows of a node: one row for at most ``most`` of them, with their values as a matrix.

    ``in_order``: the rows come by node, so a node is packed when the next one begins.
    """

    def pack(batches):
        waiting: dict[int, list] = {}

        def flush(node: int) -> dict:
            parts = waiting.pop(node)
            rows, keys = np.concatenate([r for r, _ in parts]), np.concatenate([k for _, k in parts])
            return {"node": node, "n": len(rows), "keys": "\x00".join(keys), "rows": np.ascontiguousarray(rows).tobytes()}

        for pdf in batches:
            values, nodes = pdf[names].to_numpy(float), pdf["node"].to_numpy()
            keys = pdf["key"].fillna("None").to_numpy(object) if "key" in pdf else np.full(len(pdf), "", object)
            order = np.argsort(nodes, kind="stable")
            out = []
            for rows in np.split(order, np.flatnonzero(np.diff(nodes[order])) + 1):
                node = int(nodes[rows[0]])
                for start in range(0, len(rows), most):
                    part = rows[start : start + most]
                    held = waiting.setdefault(node, [])
                    if held and sum(len(r) for r, _ in held) + len(part) > most:
                        out.append(flush(node))
                        held = waiting.setdefault(node, [])
                    held.append((values[part], keys[part]))
            if in_order:
                out += [flush(n) for n in list(waiting)[:-1]]
            if out:
                yield pd.DataFrame(out)
        if waiting:
            yield pd.DataFrame([flush(n) for n in list(waiting)])

    return pack


def distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Distances that skip missing coordinates and scale by the share that is present."""
    return _scaled(*_squares(q, x), q.shape[1])


def _squares(q: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray | float]:
    """Sums of the squared differences of the coordinates that both have, and how many those are."""
    total = np.zeros((len(q), len(x)))
    if not (np.isnan(q).any() or np.isnan(x).any()):
        for j in range(q.shape[1]):  # differences are formed directly: exact for equal points
            gap = q[:, j : j + 1] - x[None, :, j]
            gap *= gap
            total += gap
        return total, float(q.shape[1])
    q_seen, seen = ~np.isnan(q), ~np.isnan(x)
    q0, x0 = np.where(q_seen, q, 0.0), np.where(seen, x, 0.0)
    for j in range(q.shape[1]):
        gap = q0[:, j : j + 1] - x0[None, :, j]
        total += np.where(q_seen[:, j : j + 1] & seen[None, :, j], gap * gap, 0.0)
    return total, q_seen.astype(float) @ seen.T.astype(float)


def _scaled(total: np.ndarray, common: np.ndarray | float, width: int) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(common > 0, np.sqrt(total * width / common), np.inf)


def _kth_at_most(total: np.ndarray, k: int) -> np.ndarray:
    """An upper bound of the k-th smallest value of each row: the k-th smallest of the least ones of its groups."""
    n, groups = total.shape[1], GROUPS * k
    if n >= 2 * groups:
        total = total[:, : n // groups * groups].reshape(len(total), -1, groups).min(axis=1)
    return np.partition(total, k - 1, axis=1)[:, k - 1]


def _near(points: np.ndarray, limit: np.ndarray, donors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, distance and value of the k best ``donors`` of each query within its limit, by (distance, value)."""
    width = points.shape[1]
    total, common = _squares(points, donors[:, 1:])
    if isinstance(common, float) and width:
        # roots are taken only of what a bound on the squares leaves; it is a little wide, as those are rounded
        edge = np.where(np.isfinite(limit), limit * limit, np.inf)
        if total.shape[1] > k and np.count_nonzero(total <= edge[:, None]) > 4 * k * len(total):
            edge = np.minimum(edge, _kth_at_most(total, k))
        q, at = np.nonzero(total <= (edge / ROUNDING**2)[:, None])
        dist = _scaled(total[q, at], common, width)
    else:
        d = _scaled(total, common, width)
        kth = np.partition(d, k - 1, axis=1)[:, k - 1] if d.shape[1] > k else np.full(len(d), np.inf)
        q, at = np.nonzero(d <= np.minimum(limit, kth)[:, None])
        dist = d[q, at]
    inside = np.flatnonzero((dist <= limit[q]) & np.isfinite(dist))
    q, at, dist = q[inside], at[inside], dist[inside]
    value = donors[at, 0]
    order = np.lexsort((value, dist, q))
    q = q[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    best = place < k
    return q[best], dist[order][best], value[order][best]


def _searcher(width: int, k: int):
    """The k best donors of a block for each query of a pack, none farther than the query's bound."""

    def search(batches):
        for pdf in batches:
            out = []
            for row in pdf.itertuples():
                keys = np.array(row.q_keys.split("\x00"), dtype=object)
                queries = np.frombuffer(row.q_rows).reshape(row.q_n, -1)
                donors = np.frombuffer(row.rows).reshape(row.n, -1)
                points, limit = queries[:, :width], queries[:, width]
                for start in range(0, len(points), CHUNK):
                    part = slice(start, start + CHUNK)
                    q, dist, value = _near(points[part], limit[part], donors, k)
                    out.append((keys[part][q], dist, value))
                    if len(out) >= PARTS:
                        yield _joined(out)
                        out = []
            if out:
                yield _joined(out)

    return search


def _joined(parts: list) -> pd.DataFrame:
    key, dist, value = (np.concatenate(p) for p in zip(*parts))
    return pd.DataFrame({"key": key, "dist": dist, "value": value})


def _packs(visits: DataFrame, names: list[str], leaf: int) -> DataFrame:
    """The queries that visit a leaf (``node``), dealt over some tasks and packed there."""
    dealt = visits.repartition("node", F.floor(F.rand(13) * SPREAD))
    packs = dealt.sortWithinPartitions("node").mapInPandas(_packer(leaf, names, True), "node long, n int, keys string, rows binary")
    return packs.select("node", F.col("n").alias("q_n"), F.col("keys").alias("q_keys"), F.col("rows").alias("q_rows"))


def _search(tree: Tree, visits: DataFrame, xs: list[str], k: int, leaf: int) -> DataFrame:
    """(key, dist, value) from the leaves (``node``) that the queries visit; packs of queries meet blocks."""
    packs = _packs(visits, [*xs, "limit"], leaf)
    return durable(packs.join(tree.blocks, "node").mapInPandas(_searcher(tree.width, k), "key string, dist double, value double"))


def _below(frontier: DataFrame, level: DataFrame, xs: list[str]) -> DataFrame:
    """The children of the nodes a query has reached, with the least distance ``box`` that they can hold.

    A coordinate counts where the query has it and no row of the node lacks it; the rest can only add.
    """
    seen = sum((F.col(x).isNotNull().cast("int") for x in xs), F.lit(0))
    gaps = F.lit(0.0)
    for i, x in enumerate(xs):
        gap = F.greatest(F.col(f"l{i}") - F.col(x), F.col(x) - F.col(f"h{i}"), F.lit(0.0))
        gaps = gaps + F.when(F.col(x).isNotNull() & F.col(f"f{i}"), gap * gap).otherwise(0.0)
    box = F.sqrt(gaps * len(xs) / F.greatest(seen, F.lit(1))) * ROUNDING
    return frontier.withColumnRenamed("node", "parent").join(level, "parent").withColumn("box", box).select("key", *xs, "limit", "node", "box", "is_leaf")


def home_leaves(tree: Tree, asked: DataFrame, xs: list[str]) -> DataFrame:
    """The leaf to which the tree's cuts lead each query (``key``, ``xs``, ``limit``).

    Both sides of a cut hold rows, so there is one for any query. A query is one row on every level, and no
    row meets more than the cuts of its own node. Of rows that repeat a key the one nearest to all boxes is led.
    """
    top = _below(spread(asked).withColumn("node", F.lit(-1).cast("long")), tree.levels[0], xs)
    one = top.groupBy("key").agg(F.min(F.struct("box", "limit", *xs)).alias("s"))
    at, found = durable(one.select("key", *[f"s.{c}" for c in [*xs, "limit"]])).withColumn("node", F.lit(0).cast("long")), []
    for depth, level in enumerate(tree.levels):
        here = lookup_join(at, level.select("node", "is_leaf"), ["node"], "inner")
        found.append(here.where("is_leaf").drop("is_leaf"))
        if depth < len(tree.cuts):
            met = lookup_join(here.where("not is_leaf"), tree.cuts[depth], ["node"], "inner")
            at = durable(met.select("key", *xs, "limit", _next(xs).alias("node")))
    out = found[0]
    for part in found[1:]:
        out = out.union(part)
    return out


def leaf_visits(tree: Tree, asked: DataFrame, xs: list[str], home_only: bool) -> DataFrame:
    """The leaves that each query (``key``, ``xs``, ``limit``) has to visit, with their box distances.

    ``home_only``: one leaf a query, without its distance.
    """
    if home_only:
        return home_leaves(tree, asked, xs)
    frontier, found = asked.withColumn("node", F.lit(-1).cast("long")), []
    for level in tree.levels:
        below = durable(_below(spread(frontier), level, xs).where("box <= limit"))
        found.append(below.where("is_leaf").drop("is_leaf"))
        frontier = below.where("not is_leaf").select("key", *xs, "limit", "node")
    out = found[0]
    for part in found[1:]:
        out = out.union(part)
    return out


@dataclass(frozen=True)
class Router:
    """A tree small enough for one process: ``nodes`` and ``cuts`` (heaps of axes and values) of each level
    but the last, and the leaves with their boxes."""

    cuts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    leaves: np.ndarray
    low: np.ndarray
    high: np.ndarray
    full: np.ndarray

    def home(self, points: np.ndarray) -> np.ndarray:
        """The leaf to which the cuts lead each point, as ``home_leaves`` finds it."""
        at, rows = np.zeros(len(points), np.int64), np.arange(len(points))
        for nodes, axes, cuts in self.cuts:
            place = np.minimum(np.searchsorted(nodes, at[rows]), len(nodes) - 1)
            rows, place = rows[nodes[place] == at[rows]], place[nodes[place] == at[rows]]
            step = np.zeros(len(rows), np.int64)
            for _ in range(DEPTH):
                axis = axes[place, step]
                right = (axis >= 0) & (points[rows, np.maximum(axis, 0)] > cuts[place, step])
                step = 2 * step + 1 + right
            at[rows] = at[rows] * 2**DEPTH + 1 + step - (2**DEPTH - 1)
        return at

    def reached(self, points: np.ndarray, limit: np.ndarray, own: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, leaf and box distance of the leaves within each query's limit, but the leaf ``own``.

        The distance is that of ``_below``; leaves that none of the queries can reach are left out first.
        """
        known = ~np.isnan(points)
        seen, width = known.sum(axis=1), points.shape[1]
        some = np.flatnonzero(seen)  # a query without coordinates is at no distance from anything
        if not len(some):
            return (np.empty(0, np.int64),) * 2 + (np.empty(0),)
        q0, last = np.where(known, points, 0.0), np.zeros(len(self.leaves))
        for j in np.flatnonzero(known[some].all(axis=0)):
            gap = np.maximum(np.maximum(self.low[:, j] - points[some, j].max(), points[some, j].min() - self.high[:, j]), 0.0)
            last += np.where(self.full[:, j], gap * gap, 0.0)
        near = np.flatnonzero((np.sqrt(last) * ROUNDING**2 <= limit[some].max()) & (self.leaves != own))
        out = []
        for start in range(0, len(some), max(1, BOX_CELLS // max(1, len(near)))):
            part = some[start : start + max(1, BOX_CELLS // max(1, len(near)))]
            gaps = np.zeros((len(part), len(near)))
            for j in range(width):
                gap = np.maximum(np.maximum(self.low[near, j] - q0[part, j, None], q0[part, j, None] - self.high[near, j]), 0.0)
                gaps += np.where(known[part, j, None] & self.full[near, j], gap * gap, 0.0)
            box = np.sqrt(gaps * width / seen[part, None]) * ROUNDING
            q, at = np.nonzero(box <= limit[part, None])
            out.append((part[q], self.leaves[near[at]], box[q, at]))
        return tuple(np.concatenate(x) for x in zip(*out))


def _router(tree: Tree) -> Router | None:
    """The tree's cuts and leaf boxes, unless they are too large to be sent to every task."""
    found, left, room = [], LOOKUP_ROWS, LOOKUP_BYTES
    for table in [*tree.cuts, *[level.where("is_leaf") for level in tree.levels]]:
        part = table.limit(left + 1).toArrow()
        left, room = left - part.num_rows, room - part.nbytes
        if left < 0 or room < 0:
            return None
        found.append(part)
    cuts = []
    for part in found[: len(tree.cuts)]:
        nodes = part["node"].to_numpy()
        order = np.argsort(nodes)
        heaps = [np.array(part[c].to_pylist()).reshape(len(nodes), 2**DEPTH - 1)[order] for c in ("axes", "cuts")]
        cuts.append((nodes[order], *heaps))
    leaves = pa.concat_tables(found[len(tree.cuts) :])
    side = lambda c: np.column_stack([leaves[f"{c}{i}"].to_numpy() for i in range(tree.width)]) if tree.width else np.empty((len(leaves), 0))
    full = side("f").astype(bool)
    low, high = (np.where(full, side(c).astype(float), 0.0) for c in "lh")
    return Router(cuts, leaves["node"].to_numpy(), low, high, full)


def _routed(sent, xs: list[str]):
    """Adds its home leaf to each query."""

    def route(batches):
        for batch in batches:
            points = np.column_stack([batch.column(x).to_numpy(zero_copy_only=False).astype(float) for x in xs])
            yield pa.record_batch([*batch.columns, pa.array(sent.value.home(points))], [*batch.schema.names, "node"])

    return route


STATE = "key string, {}, dist array<double>, value array<double>, more array<struct<box: double, node: long>>"


def _at_home(sent, xs: list[str], k: int):
    """The k best of its home leaf for each query of a pack, and the other leaves that can hold better ones."""
    schema = pa.schema([("key", pa.string()), *[(x, pa.float64()) for x in xs], ("dist", pa.list_(pa.float64())), ("value", pa.list_(pa.float64())), ("more", pa.list_(pa.struct([("box", pa.float64()), ("node", pa.int64())])))])

    def lists(q: np.ndarray, n: int, values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.bincount(q, minlength=n))).astype(np.int32)), values)

    def search(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                keys, points = row["q_keys"].split("\x00"), np.frombuffer(row["q_rows"]).reshape(row["q_n"], -1)
                donors = np.frombuffer(row["rows"]).reshape(row["n"], -1)
                for start in range(0, len(points), CHUNK):
                    part = points[start : start + CHUNK]
                    n = len(part)
                    q, dist, value = _near(part, np.full(n, np.inf), donors, k)
                    limit = np.full(n, np.inf)
                    full = np.flatnonzero(np.bincount(q, minlength=n) >= k)
                    limit[full] = dist[np.searchsorted(q, full, side="right") - 1]
                    asks, leaf, box = sent.value.reached(part, limit, row["node"])
                    order = np.lexsort((leaf, box, asks))
                    more = pa.StructArray.from_arrays([pa.array(box[order]), pa.array(leaf[order])], ["box", "node"])
                    known = [pa.array(part[:, j], mask=np.isnan(part[:, j])) for j in range(part.shape[1])]
                    yield pa.record_batch([pa.array(keys[start : start + CHUNK]), *known, lists(q, n, pa.array(dist)), lists(q, n, pa.array(value)), lists(asks, n, more)], schema=schema)

    return search


def _repeated(asked: DataFrame) -> DataFrame | None:
    """Hashes of the keys that repeat or are null, with some that share a hash; ``None`` if there are none."""
    counted = asked.groupBy(F.xxhash64("key").alias("_h")).agg(F.count("*").alias("_n"), F.bool_or(F.col("key").isNull()).alias("_null"))
    found = durable(counted.where("_n > 1 or _null").select("_h"))
    return None if found.isEmpty() else found


def nearest_lists(reference: DataFrame, query: DataFrame, key: str, target: str, cols: list[str], k: int = 5, leaf: int = LEAF) -> DataFrame:
    """(key, dist, value) of ``nearest`` with a row for each key: its k best in order, as arrays.

    Where the tree's cuts and leaf boxes can be sent to the tasks, the task that compares a query with its
    first leaf also finds the other leaves within its bound. Queries without any are done; the rest,
    and rows whose keys repeat, are carried on as rows.
    """
    xs = [f"_x{i}" for i in range(len(cols))]
    points = [F.nanvl(col(c).cast("double"), F.lit(None).cast("double")).alias(x) for c, x in zip(cols, xs)]
    donors = reference.filter(col(target).isNotNull()).select(col(target).cast("double").alias("t"), *points)
    tree = build_tree(donors, xs, k, leaf)
    asked = durable(query.select(col(key).cast("string").alias("key"), *points, F.lit(float("inf")).alias("limit")))
    router = _router(tree) if xs else None
    if router is None or not len(router.leaves):
        return _listed(_by_rows(tree, asked, xs, k, leaf))
    repeated, parts = _repeated(asked), []
    if repeated is not None:
        hashed = asked.withColumn("_h", F.xxhash64("key"))
        parts.append(_listed(_by_rows(tree, durable(lookup_join(hashed, repeated, ["_h"], "left_semi").drop("_h")), xs, k, leaf)))
        asked = durable(lookup_join(hashed, repeated, ["_h"], "left_anti").drop("_h"))
    sent = asked.sparkSession.sparkContext.broadcast(router)
    kinds = ", ".join(f"{x} double" for x in xs)
    routed = spread(asked.select("key", *xs)).mapInArrow(_routed(sent, xs), f"key string, {kinds}, node long")
    met = _packs(routed, xs, leaf).join(tree.blocks, "node")
    state = durable(met.mapInArrow(_at_home(sent, xs, k), STATE.format(kinds)))
    sent.unpersist()
    parts.append(state.where(F.size("more") == 0).where(F.size("dist") > 0).select("key", "dist", "value"))
    open_ = state.where(F.size("more") > 0)
    near = open_.select("key", F.explode(F.arrays_zip("dist", "value")).alias("s")).select("key", "s.dist", "s.value")
    limit = F.when(F.size("dist") >= k, F.element_at("dist", -1)).otherwise(float("inf"))
    rest = open_.select("key", *xs, limit.alias("limit"), F.posexplode("more").alias("visit", "s"))
    rest = durable(rest.select("key", *xs, "limit", "s.node", "s.box", (F.col("visit") + 1).alias("visit")))
    if not rest.isEmpty():
        parts.append(_listed(_visited(tree, rest, near, xs, k, leaf)))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def _listed(found: DataFrame) -> DataFrame:
    each = found.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("rank", "dist", "value"))).alias("s"))
    return each.select("key", F.col("s.dist").alias("dist"), F.col("s.value").alias("value"))


def nearest(reference: DataFrame, query: DataFrame, key: str, target: str, cols: list[str], k: int = 5, leaf: int = LEAF) -> DataFrame:
    """(key, dist, value, rank) of the k nearest reference rows with a known target.

    The distance skips missing coordinates and scales by the share that is present. A query is first
    compared with the leaf its cuts lead to, which bounds its k-th distance, then with the ``FIRST_VISITS`` nearest
    of the leaves within the bound, and with those that the tighter bound still reaches. Ties go to the
    smaller value. Keys name one query each; a query without coordinates has no neighbours.
    """
    lists = nearest_lists(reference, query, key, target, cols, k, leaf)
    return lists.select("key", F.posexplode(F.arrays_zip("dist", "value")).alias("rank", "s")).select("key", "s.dist", "s.value", (F.col("rank") + 1).alias("rank"))


def _best(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("key").orderBy("dist", "value"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def _limited(queries: DataFrame, found: DataFrame, k: int) -> DataFrame:
    bound = _best(found, k).groupBy("key").agg(F.max("dist").alias("_r"), F.count("*").alias("_n")).filter(F.col("_n") >= k)
    return queries.drop("limit").join(bound.select("key", "_r"), "key", "left").withColumn("limit", F.coalesce("_r", F.lit(float("inf")))).drop("_r")


def _by_rows(tree: Tree, asked: DataFrame, xs: list[str], k: int, leaf: int) -> DataFrame:
    """(key, dist, value, rank) for trees of any size and keys that repeat: every step is a join of rows."""
    own = durable(leaf_visits(tree, asked, xs, True))
    near = _search(tree, own, xs, k, leaf)
    reached = leaf_visits(tree, durable(_limited(asked, near, k)), xs, False)
    rest = reached.join(own.select("key", "node"), ["key", "node"], "left_anti")
    order = F.row_number().over(Window.partitionBy("key").orderBy("box", "node"))
    return _visited(tree, durable(rest.withColumn("visit", order)), near, xs, k, leaf)


def _visited(tree: Tree, rest: DataFrame, near: DataFrame, xs: list[str], k: int, leaf: int) -> DataFrame:
    """(key, dist, value, rank) of ``near`` and of the leaves (``node``, ``box``) that ``rest`` still has to visit."""
    names = ["key", *xs, "limit", "node"]
    near = near.union(_search(tree, rest.where(F.col("visit") <= FIRST_VISITS).select(*names), xs, k, leaf))
    later = _limited(rest.where(F.col("visit") > FIRST_VISITS), near, k).where("box <= limit")
    return _best(near.union(_search(tree, later.select(*names), xs, k, leaf)), k)
