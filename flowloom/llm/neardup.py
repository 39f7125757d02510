"""Near-duplicates from bottom-k sketches of one hash function.

A document's set is its distinct word shingles. Documents with equal sets form a class and go on as
one. Each class keeps the ``k`` smallest hashes of its set. Inverted lists of the retained values give
the classes that overlap, the union of two sketches estimates their similarity, and the pairs that
pass are compared on their full sets. The links' connected components are the groups.

No list is expanded into all of its pairs at once. First every list links its members to its centre,
the member that shares the most with others, so that a group of copies, however large, costs one pair a
copy. Afterwards only pairs between different components are left. Lists of up to ``hot`` members give
theirs. Longer ones are needed only by classes that consist of such values for the most part, as all
others share a rarer value with whatever they resemble or fall below the estimate; these few are compared
by prefixes of their full sets, rarest element first, which is exact. Where a prefix list is long as well, its
members are told apart by what each has differently from a common centre: two sets differ by as much as their
differences from the centre do, and copies that were edited in different places share few of those.

What can be missed: two sets of similarity 0.8 share no retained value with a chance of 0.2 to the power
k, and not at all while the sets have up to 5 (k - 1) shingles (a prefix of a fifth of the set, in the
order of the hash, holds a common value). The estimate errs beyond its slack with a chance below 1e-6.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .idfilter import GOLDEN, id_filter, mix
from .store import saved, small_batches, temporaries

SKETCH = 48
HOT_LIST = 64
SLACK = 0.35
CACHED_WORDS = 40_000
ROWS_AT_ONCE = 256


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound; frequent words come back soon after each clearing."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(raw: bytes | None, width: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 63-bit hashes of the shingles of ``width`` words; a shorter text is one shingle.

    Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. A null or blank text gives none.
    """
    words = raw.lower().split() if raw else []
    if not words:
        return np.empty(0, np.int64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(width, len(words))
    n = len(words) - size + 1
    with np.errstate(over="ignore"):
        total = np.full(n, np.uint64(size) * GOLDEN, np.uint64)
        for i in range(size):
            total = mix(total + h[i : i + n])
    return np.unique((total >> np.uint64(1)).astype(np.int64))


def _digester(width: int, k: int):
    schema = pa.schema([("doc_id", pa.int64()), ("print", pa.binary()), ("n", pa.int64()), ("fp", pa.binary()), ("sketch", pa.list_(pa.int64()))])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in _sliced(batches):
            n, fp, flat, ends = [], [], [], [0]
            for raw in batch.column(1):
                s = shingles(raw.as_py(), width, hashes)
                n.append(len(s))
                fp.append(xxhash.xxh3_128_digest(s))
                flat.append(s[:k].copy())  # a view would keep the whole set
                ends.append(ends[-1] + min(k, len(s)))
            values = pa.array(np.concatenate(flat) if flat else np.empty(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(fp, pa.binary()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)], schema=schema)

    return digest


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def _setter(width: int, sent):
    """Fingerprints and full sets of the documents that pass the filter of ids."""
    schema = pa.schema([("fp", pa.binary()), ("elements", pa.binary())])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in _sliced(batches):
            batch = batch.filter(sent.value.maybe(batch.column(0)))
            found = [shingles(raw.as_py(), width, hashes) for raw in batch.column(1)]
            yield pa.record_batch([pa.array([xxhash.xxh3_128_digest(s) for s in found], pa.binary()), pa.array([s.tobytes() for s in found], pa.binary())], schema=schema)

    return sets


def _verifier(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                u, v = np.frombuffer(x.as_buffer(), np.int64), np.frombuffer(y.as_buffer(), np.int64)
                both = int(np.count_nonzero(u[np.minimum(np.searchsorted(u, v), len(u) - 1)] == v)) if len(u) else 0
                keep.append(100 * both >= percent * (len(u) + len(v) - both))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:2]], schema=schema)

    return verify


def _lister(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in _sliced(batches):
        found = [np.frombuffer(x.as_buffer(), np.int64) for x in part.column(1)]
        yield pa.record_batch([np.repeat(part.column(0).to_numpy(), [len(x) for x in found]), np.concatenate(found)], names=["id", "key"])


class Linker:
    """Candidate pairs of one corpus, estimated on sketches and compared on full sets."""

    def __init__(self, docs: DataFrame, reps: DataFrame, width: int, k: int, percent: int):
        self.docs, self.reps, self.width, self.k, self.percent = docs, reps, width, k, percent

    def links(self, pairs: DataFrame, full: DataFrame | None = None) -> DataFrame:
        """The pairs (``a``, ``b``) whose similarity reaches the limit; ``full``: their sets, where they are at hand."""
        sketches = self.reps.select("id", "n", "sketch")
        a, b = (sketches.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}")) for x in "ab")
        sized = F.expr(f"100 * least(n_a, n_b) >= {self.percent} * greatest(n_a, n_b)")
        union = F.slice(F.array_sort(F.array_union("s_a", "s_b")), 1, self.k)
        shared = F.size(F.array_intersect(F.array_intersect("s_a", "s_b"), F.col("union")))
        likely = pairs.join(a, "a").join(b, "b").where(sized).withColumn("union", union).where(shared >= F.lit(self.percent / 100 - SLACK) * F.size("union"))
        likely = saved(likely.select("a", "b"), "likely")
        if likely.isEmpty():
            return likely
        if full is None:
            full = saved(self.sets(likely.select(F.col("a").alias("id")).union(likely.select("b")).distinct()), "sets")
        x = full.select(F.col("id").alias("a"), F.col("elements").alias("x"))
        y = full.select(F.col("id").alias("b"), F.col("elements").alias("y"))
        return saved(likely.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_verifier(self.percent), "a long, b long"), "verified")

    def sets(self, ids: DataFrame) -> DataFrame:
        """Full sets of the classes ``ids`` and of some others, one row a class however often its text
        occurs; a filter of bounded size on the documents spares most others the work."""
        names = ids.join(self.reps.select("id", "rep"), "id").select("rep")
        sent = ids.sparkSession.sparkContext.broadcast(id_filter(names))
        found = self.docs.mapInArrow(_setter(self.width, sent), "fp binary, elements binary")
        return found.dropDuplicates(["fp"]).join(self.reps.select("fp", "id"), "fp").select("id", "elements")


def fits(percent: int, n_a: str, n_b: str, before_a: str, before_b: str) -> Column:
    """Whether two sets can still reach the limit: by their sizes, and by what is left after their first
    common element when ``before`` elements of each come earlier and are not shared."""
    return F.expr(
        f"100 * least({n_a}, {n_b}) >= {percent} * greatest({n_a}, {n_b})"
        f" and {100 + percent} * least({n_a} - {before_a}, {n_b} - {before_b}) >= {percent} * ({n_a} + {n_b})"
    )


def _apart(rows: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Pairs of ids in different components that share a ``key`` and can reach the limit.

    ``rows``: ``key``, ``id``, ``n``, ``rare``. Keys whose members are all in one component go first.
    """
    rows = saved(rows.join(roots, "id", "left").select("key", "id", "n", "rare", F.coalesce("root", "id").alias("root")), "rest")
    split = rows.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least < most").select("key")
    open_ = saved(rows.join(split, "key"), "open")
    a, b = (open_.select("key", F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("root").alias(f"r_{x}"), F.col("rare").alias(f"p_{x}")) for x in "ab")
    pairs = a.join(b, (a["key"] == b["key"]) & (F.col("a") < F.col("b")) & (F.col("r_a") != F.col("r_b")) & fits(percent, "n_a", "n_b", "p_a", "p_b"))
    return pairs.select("a", "b").distinct()


def _rarest_first(elements: DataFrame, scope: list[str], carried: list[str]) -> DataFrame:
    """``carried`` and an array ``e`` of (df, key) of each id in a scope, sorted; df counts the ids in the
    scope that have the key."""
    counts = elements.groupBy(*scope, "key").agg(F.count(F.lit(1)).alias("df"))
    both = elements.join(counts, [*scope, "key"])
    return both.groupBy(*carried).agg(F.sort_array(F.collect_list(F.struct("df", "key"))).alias("e"))


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """``key``, ``id``, ``n``, ``rare`` of the elements in the prefix of each set, with the rarest first.

    Two sets that reach the limit share an element of both prefixes, whatever the order; in this one,
    elements that no other set has come first, and a set with enough of them is compared with nothing.
    """
    elements = saved(sets.mapInArrow(_lister, "id long, key long"), "elements")
    lists = _rarest_first(elements, [], ["id"]).withColumn("n", F.size("e").cast("long"))
    prefix = F.slice("e", 1, (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).cast("int"))
    rows = lists.select("id", "n", F.posexplode(prefix).alias("rare", "x"))
    return rows.where("x.df > 1").select(F.col("x.key").alias("key"), "id", "n", "rare")


def _differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is in one of the sets only, of each id and its centre."""
    for part in _sliced(batches):
        d, n, n_c, found = [], [], [], []
        for x, y in zip(part.column(2), part.column(3), strict=True):
            u, v = np.frombuffer(x.as_buffer(), np.int64), np.frombuffer(y.as_buffer(), np.int64)
            only = np.setxor1d(u, v, assume_unique=True)
            d.append(len(only))
            n.append(len(u))
            n_c.append(len(v))
            found.append(only.tobytes())
        arrays = [part.column(0), part.column(1), *(pa.array(z, pa.int64()) for z in (n, n_c, d)), pa.array(found, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, names=["c", "id", "n", "n_c", "d", "elements"])


def _difference_lister(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in _sliced(batches):
        found = [np.frombuffer(x.as_buffer(), np.int64) for x in part.column(5)]
        times = [len(x) for x in found]
        yield pa.RecordBatch.from_arrays([*(pa.array(np.repeat(part.column(i).to_numpy(), times)) for i in range(5)), pa.array(np.concatenate(found))], names=["c", "id", "n", "n_c", "d", "key"])


def _differences(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """``c``, ``id``, ``n``, ``n_c``, ``d``, ``elements``: for each list (``key``, ``id``, ``m``), what its members
    have differently from its centre, the member in the longest lists; ``d`` counts that."""
    weights = rows.groupBy("id").agg(F.sum(F.log("m")).alias("weight"))
    weighted = rows.join(weights, "id").select("key", "id", F.struct(F.round("weight", 6).alias("weight"), (-F.col("id")).alias("minus")).alias("by"))
    centres = weighted.groupBy("key").agg((-F.max("by")["minus"]).alias("c"))
    led = saved(rows.join(centres, "key").where("id <> c").select("c", "id").distinct(), "led")
    whole = sets.join(led.select(F.col("c").alias("id")).distinct(), "id").select(F.col("id").alias("c"), F.col("elements").alias("y"))
    both = led.join(sets.select("id", F.col("elements").alias("x")), "id").join(whole, "c").select("c", "id", "x", "y")
    return saved(both.mapInArrow(_differ, "c long, id long, n long, n_c long, d long, elements binary"), "differences")


def _near_centre(percent: int) -> Column:
    """Whether a set reaches the limit with its centre: a size of the difference against the sum of both sizes."""
    return F.expr(f"{100 + percent} * d <= {100 - percent} * (n + n_c)")


def _apart_by_differences(differences: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Pairs in different components that share a centre and can reach the limit.

    Two sets differ by their differences' difference. If those share nothing, either both sets reach the
    limit with the centre, and are in its component, or they miss it with each other. So a pair that is left
    shares an element of the differences, and one of the two is far from the centre; against such a one the
    other needs an overlap of about half its difference, and that much of it, rarest first, need not be listed.
    """
    far = ~_near_centre(percent)
    rows = differences.join(roots, "id", "left").withColumns({"root": F.coalesce("root", "id"), "far": far})
    split = rows.groupBy("c").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.max("far").alias("any")).where("least < most and any").select("c")
    left = saved(rows.join(split, "c"), "far")
    elements = saved(left.select("c", "id", "n", "n_c", "d", "elements").mapInArrow(_difference_lister, "c long, id long, n long, n_c long, d long, key long"), "differing")
    lists = _rarest_first(elements, ["c"], ["c", "id", "n", "n_c", "d"])
    placed = lists.select("c", "id", "n", "n_c", "d", F.posexplode("e").alias("at", "x")).where("x.df > 1")
    half = F.expr(f"{100 + percent} * (d - 2 * at) > {100 - percent} * (n_c - n)")
    reach = F.expr(f"{percent} * at <= {100 - percent} * n")
    placed = placed.where(reach).select("c", F.col("x.key").alias("key"), "id", "n", "d", "at", half.alias("half"), far.alias("far"))
    placed = saved(placed.where("half or far").join(left.select("c", "id", "root"), ["c", "id"]), "placed")
    a, b = (placed.where(w).select("c", "key", *(F.col(x).alias(f"{x}_{s}") for x in ("id", "n", "d", "at", "root"))) for w, s in (("far", "a"), ("half", "b")))
    can = F.expr(
        f"root_a <> root_b and 100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)"
        f" and {100 + percent} * (d_a + d_b - 2 * least(d_a - at_a, d_b - at_b)) <= {100 - percent} * (n_a + n_b)"
    )
    pairs = a.join(b, (a["c"] == b["c"]) & (a["key"] == b["key"]) & can)
    return pairs.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).distinct()


def _dense_links(linker: Linker, ids: DataFrame, roots: DataFrame, found: DataFrame, percent: int, hot: int) -> DataFrame:
    """Links among the classes ``ids`` that are in different components by ``roots``, by prefixes of their full
    sets. ``found``: all links so far."""
    sets = saved(linker.sets(ids).join(ids, "id"), "dense_sets")
    rows = _prefixes(sets, percent)
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    rows = saved(rows.join(sizes, "key"), "prefixes")
    links = linker.links(_apart(rows.where(f"m <= {hot}").drop("m"), roots, percent), sets)
    long = rows.where(f"m > {hot}")
    if long.isEmpty():
        return links
    differences = _differences(long, sets)
    ends = differences.where(_near_centre(percent))
    links = links.union(ends.select(F.least("c", "id").alias("a"), F.greatest("c", "id").alias("b")))
    return links.union(linker.links(_apart_by_differences(differences, components(found.union(links)), percent), sets))


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, k: int = SKETCH, hot: int = HOT_LIST, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept``: one row for each row of ``docs``.

    Documents are linked where 100 * |A and B| >= ``percent`` * |A or B| on their full sets, and
    ``component_id`` is the smallest id reachable. Documents without words are linked with nothing.
    Rows that repeat id and text get the same answer; a row of an id that stands for several texts gets
    that of its own text. A row with a null id takes part in no group: its component is null, and it is
    kept.
    """
    with temporaries(docs.sparkSession), small_batches(docs.sparkSession):
        return saved(_grouped(docs, doc_id, text, width, percent, k, hot).drop("print", "root"), "groups", keep=True)


def _print(text: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit("").cast("binary"))))


def _grouped(docs: DataFrame, doc_id: str, text: str, width: int, percent: int, k: int, hot: int) -> DataFrame:
    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("text"))
    printed = texts.withColumn("print", _print("text"))
    rows = saved(printed.mapInArrow(_digester(width, k), "doc_id long, print binary, n long, fp binary, sketch array<long>"), "digests")
    full = rows.where("doc_id is not null and n > 0")
    # a class has a number of its own, as one id may stand for several texts
    reps = full.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    reps = saved(reps.withColumn("id", F.monotonically_increasing_id()), "classes")
    linker = Linker(texts, reps, width, k, percent)

    # Inverted lists of the retained values. ``rare`` counts the values of a sketch before this one that
    # are in no hot list; if this is the first rare value that two sets share, they share n - rare at most.
    postings = reps.select(F.posexplode("sketch").alias("at", "value"), "id", "n", F.size("sketch").alias("kept"))
    lists = postings.groupBy("value").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    shared = saved(postings.join(lists, "value"), "postings")
    is_hot = F.col("m") > hot
    by_id = shared.groupBy("id").agg(F.sum(F.log("m")).alias("weight"), F.array_sort(F.collect_list(F.when(is_hot, F.col("at")))).alias("hots"), F.first("kept").alias("kept"))
    by_id = by_id.select("id", "weight", "hots", (F.size("hots") >= F.lit(percent / 100 - SLACK) * F.col("kept")).alias("dense"))
    rare = F.col("at") - F.size(F.filter("hots", lambda h: h < F.col("at")))
    members = saved(shared.join(by_id, "id").select("value", "id", "n", "m", "weight", "dense", rare.alias("rare")), "members")

    # Every list links its members to its centre.
    top = F.max(F.struct("weight", (-F.col("id")).alias("minus"), "n", "rare")).alias("c")
    centres = members.groupBy("value").agg(top).select("value", (-F.col("c.minus")).alias("centre"), F.col("c.n").alias("c_n"), F.col("c.rare").alias("c_rare"))
    members = saved(members.join(centres, "value"), "centred")
    stars = members.where("id <> centre").where(fits(percent, "n", "c_n", "rare", "c_rare"))
    links = linker.links(stars.select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct())
    roots = components(links)

    # What is left: pairs of other members in different components, first of the lists that are not hot.
    rest = members.where(F.expr(f"m > 2 and m <= {hot} and id <> centre")).select(F.col("value").alias("key"), "id", "n", "rare")
    more = linker.links(_apart(rest, roots, percent))
    # Classes with mostly hot values: prefixes of their full sets, rarest element first.
    dense = saved(members.where("dense").select("id").distinct(), "dense")
    if not dense.isEmpty():
        more = more.union(_dense_links(linker, dense, roots, links.union(more), percent, hot))
    roots = components(links.union(more))

    classes = saved(reps.join(roots, "id", "left").select("fp", "rep", F.coalesce("root", "id").alias("root")), "rooted")
    names = classes.groupBy("root").agg(F.min("rep").alias("component_id"))
    classes = classes.join(names, "root").select("fp", "root", "component_id")
    out = rows.select("doc_id", "print", F.col("n").alias("n_shingles"), "fp").join(classes, "fp", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return out.select("doc_id", "print", "root", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, as they are, with one document of each group: the one of the smallest id.

    Rows are told apart by id and text: where an id stands for several texts, each is judged by its own,
    and of those in the group that the id leads one text stays. Of rows that repeat both, the smallest
    by all columns stays. Rows without words and rows without an id all stay. What goes is a slim table
    of ids and hashes of texts; where it is small, Spark sends it around and no text moves.
    """
    with temporaries(docs.sparkSession), small_batches(docs.sparkSession):
        told = saved(_grouped(docs, doc_id, text, width, percent, SKETCH, HOT_LIST).where("doc_id is not null and n_shingles > 0"), "told")
        heads = told.where("kept").groupBy("root").agg(F.min("print").alias("head"))
        by_row = told.groupBy("doc_id", "print", "root").agg(F.bool_or("kept").alias("leads"), F.count(F.lit(1)).alias("n")).join(heads, "root")
        stays = F.col("leads") & (F.col("print") == F.col("head"))
        marked = by_row.select(F.col("doc_id").alias("marked_id"), F.col("print").alias("marked_print"), stays.alias("stays"), "n")
        marked = saved(marked.where("not stays or n > 1"), "marked", keep=True)
    own, key = docs[doc_id].cast("long"), _print(text)
    same = (own == F.col("marked_id")) & (key == F.col("marked_print"))
    once = docs.join(marked.select("marked_id", "marked_print"), same, "left_anti")
    again = marked.where("stays").select("marked_id", "marked_print")
    if again.isEmpty():
        return once
    repeated = docs.join(again, same, "left_semi").select(own.alias("_id"), key.alias("_print"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))
    return once.unionByName(repeated.groupBy("_id", "_print").agg(F.min("_row").alias("_row")).select("_row.*"))
