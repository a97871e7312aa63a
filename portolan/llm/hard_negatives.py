"""Hard negatives from a GNAT-style multiway tree whose leaves are scanned exactly.

Scores are inner products of integer vectors.  With ``M`` the greatest length of any row, a
coordinate ``sqrt(M^2 - |x|^2)`` added to every row and a zero added to an anchor make the score
a distance: ``d^2 = |a|^2 + M^2 - 2 * score``.  A window of scores is then an annulus around the
anchor, and the first rows by score are the nearest ones.

*Tree.*  Split points are chosen far apart on a bounded sample; every row goes to the nearest one,
level by level, so siblings are parted by hyperplanes.  For each pair of siblings ``i, j`` the node
stores the range of distances from split point ``i`` to all rows below ``j``, taken over the
whole table.  A subtree is eliminated if for any ``i`` no point at such a distance can lie in the
annulus, by the triangle inequality.

*Search.*  Every anchor first scans its own leaf, which bounds what the rest must offer; only
subtrees that survive the bound are scanned.  Leaves are cut into chunks and the anchors that
visit a leaf into blocks, so one task meets a chunk and a block, however many copies of one vector a
leaf holds.  What a block finds is at most ``k`` rows per anchor and window, ranked once more by
Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portolan.llm.links import groups
from portolan.llm.scratch import kept
from portolan.operators.reports import sample_rows

LARGEST = 1 << 25  # components beyond it could overflow a 64-bit score
UNITS = 256


@dataclass(frozen=True)
class Plan:
    """Sizes of the tree and of the blocks, and what is asked for."""

    positives: int = 5
    negatives: int = 10
    low: int = 30  # per cent of the positive's score
    high: int = 90
    fanout: int = 8
    sample: int = 8192  # rows that choose the split points
    leaf_rows: int = 2048
    chunk_rows: int = 4096
    block_anchors: int = 512
    depth: int = 10
    seed: int = 5


@dataclass
class Node:
    points: np.ndarray  # split points, one row each
    children: list[int]  # number of a node, or minus one minus the number of a leaf
    lo: np.ndarray  # lo[i, j]: least distance from point i to a row below child j
    hi: np.ndarray


@dataclass
class Tree:
    """The nodes for vectors of one length; without nodes the table is one leaf."""

    longest: float  # M^2
    nodes: list[Node] = field(default_factory=list)
    n_leaves: int = 1

    def lifted(self, rows: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.longest - (rows * rows).sum(axis=1), 0))
        return np.concatenate([rows, rest[:, None]], axis=1)


def distances(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    squares = (rows * rows).sum(axis=1)[:, None] + (points * points).sum(axis=1)[None, :] - 2 * rows @ points.T
    return np.sqrt(np.maximum(squares, 0))


def planted(sample: np.ndarray, rows: int, plan: Plan) -> Tree:
    """A tree from sampled rows that stand for ``rows``; the ranges are still empty."""
    tree = Tree(0.0)
    draw = np.random.default_rng([plan.seed, sample.shape[1]])
    share = rows / max(len(sample), 1)

    def grow(own: np.ndarray, depth: int) -> int:
        spread = len(own) * share > plan.leaf_rows and depth < plan.depth
        points = _far_apart(own, plan.fanout, draw) if spread else own[:1]
        if len(points) < 2:
            tree.n_leaves += 1
            return -tree.n_leaves
        k = len(points)
        tree.nodes.append(Node(points, [], np.full((k, k), np.inf), np.full((k, k), -np.inf)))
        number = len(tree.nodes) - 1
        nearest = distances(own, points).argmin(axis=1)
        tree.nodes[number].children = [grow(own[nearest == j], depth + 1) for j in range(k)]
        return number

    tree.n_leaves = 0
    grow(sample, 0)
    return tree


def _far_apart(rows: np.ndarray, k: int, draw: np.random.Generator) -> np.ndarray:
    """Of some drawn rows, ``k`` of which each is the farthest from those before it."""
    some = rows[draw.choice(len(rows), min(len(rows), 8 * k), replace=False)]
    chosen = [0]
    near = distances(some, some[:1])[:, 0]
    while len(chosen) < k and near.max() > 1e-6:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, distances(some, some[chosen[-1:]])[:, 0])
    return some[chosen]


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()


def _by_dim(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    values, bounds = _vectors(column)
    sizes = np.diff(bounds)
    for dim in np.unique(sizes):
        own = np.flatnonzero(sizes == dim)
        yield int(dim), own, values[(bounds[own][:, None] + np.arange(dim)).ravel()].reshape(-1, dim)


def _planted_rows(trees: dict[int, Tree]):
    """Rows to leaves, and the ranges of the task's rows."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, done = TaskContext.get().partitionId() << 33, 0
        ranges = {dim: [(n.lo.copy(), n.hi.copy()) for n in tree.nodes] for dim, tree in trees.items()}
        for batch in batches:
            leaf = np.zeros(batch.num_rows, np.int64)
            for dim, own, rows in _by_dim(batch.column("q")):
                tree = trees.get(dim)
                if tree is None or not tree.nodes:
                    continue
                at = tree.lifted(rows.astype(float))
                waiting = [(0, np.arange(len(own)))]
                while waiting:
                    number, some = waiting.pop()
                    node, (lo, hi) = tree.nodes[number], ranges[dim][number]
                    far = distances(at[some], node.points)
                    nearest = far.argmin(axis=1)
                    for j, child in enumerate(node.children):
                        below = nearest == j
                        if not below.any():
                            continue
                        lo[:, j] = np.minimum(lo[:, j], far[below].min(axis=0))
                        hi[:, j] = np.maximum(hi[:, j], far[below].max(axis=0))
                        if child < 0:
                            leaf[own[some[below]]] = -1 - child
                        else:
                            waiting.append((child, some[below]))
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(first + done + np.arange(n)), batch.column("id"), batch.column("label"), batch.column("q"),
                 pa.array(leaf), *[pa.nulls(n, pa.int32())] * 3, *[pa.nulls(n, pa.float64())] * 2], names=ROW_NAMES)
            done += n
        for dim, nodes in ranges.items():
            for number, (lo, hi) in enumerate(nodes):
                i, j = np.nonzero(hi >= lo)
                k = len(i)
                yield pa.RecordBatch.from_arrays(
                    [*[pa.nulls(k, pa.int64())] * 3, pa.nulls(k, pa.list_(pa.int64())),
                     pa.array(np.full(k, dim, np.int64)), pa.array(np.full(k, number, np.int32)),
                     pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(lo[i, j]),
                     pa.array(hi[i, j])], names=ROW_NAMES)

    return deal


#: A row has all but the last five; a range has its vectors' length in ``leaf`` and the last five.
ROWS = "n long, id long, label long, q array<long>, leaf long, node int, i int, j int, lo double, hi double"
ROW_NAMES = [f.split()[0] for f in ROWS.split(", ")]


def integers(vectors: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """Usable rows as ``id, label, q`` with integer components."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    usable = (label.isNotNull() & v.isNotNull() & (F.size(v) > 0)
              & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST / UNITS)))
    return vectors.filter(usable).select(
        F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("long").alias("label"),
        F.transform(v, lambda x: F.floor(x * UNITS).cast("long")).alias("q"))


def grown(rows: DataFrame, plan: Plan) -> tuple[DataFrame, dict[int, Tree]]:
    """Every row with its leaf and a number ``n`` of its own, and the tree per length of vectors.

    The sample has ``plan.sample`` rows; lengths that it misses are one leaf each.  The ranges
    are the tree's: at most ``fanout`` squared per node, and no more nodes than sampled rows.
    """
    square = F.aggregate("q", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    sizes = {r.dim: (r.rows, r.longest) for r in rows.groupBy(F.size("q").alias("dim")).agg(
        F.count("*").alias("rows"), F.max(square).alias("longest")).orderBy(F.desc("rows")).limit(64).collect()}
    picked = sample_rows(rows.withColumn("key", F.xxhash64("q", "id")), "key", plan.sample, plan.seed)
    sampled: dict[int, list] = {}
    for r in picked.select("q").collect():
        sampled.setdefault(len(r.q), []).append(r.q)
    trees = {}
    for dim, own in sampled.items():
        if dim in sizes:
            lift = Tree(sizes[dim][1])
            trees[dim] = planted(lift.lifted(np.array(own, float)), sizes[dim][0], plan)
            trees[dim].longest = sizes[dim][1]
    # a task's own numbers and leaves go into one written table, so they hold for all that follows
    dealt = kept(rows.mapInArrow(_planted_rows(trees), ROWS), "gnat")
    ranges = dealt.filter("n is null").groupBy("leaf", "node", "i", "j").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    for r in ranges.collect():
        node = trees[r.leaf].nodes[r.node]
        node.lo[r.i, r.j], node.hi[r.i, r.j] = r.lo, r.hi
    return dealt.filter("n is not null").select("n", "id", "label", "q", "leaf"), trees


def visited(tree: Tree, at: np.ndarray, inner: np.ndarray, outer: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Leaves with the anchors whose annuli they may touch.

    ``inner`` and ``outer`` have one row per anchor and one column per annulus; an annulus whose
    outer radius is below its inner one is empty.  Bounds are widened by what rounding can take.
    """
    if not tree.nodes:
        some = np.flatnonzero((outer >= inner).any(axis=1))
        yield 0, some
        return
    slack = 1e-6 * (1 + np.sqrt(tree.longest))
    waiting = [(0, np.arange(len(at)))]
    while waiting:
        number, some = waiting.pop()
        node = tree.nodes[number]
        far = distances(at[some], node.points)
        for j, child in enumerate(node.children):
            lo, hi = node.lo[:, j], node.hi[:, j]
            if not np.isfinite(lo[0]):
                continue  # no row below
            least = np.maximum(far - hi, lo - far).max(axis=1) - slack
            most = (far + hi).min(axis=1) + slack
            live = ((outer[some] >= inner[some]) & (outer[some] >= least[:, None])
                    & (inner[some] <= most[:, None])).any(axis=1)
            if not live.any():
                continue
            if child < 0:
                yield -1 - child, some[live]
            else:
                waiting.append((child, some[live]))


def _routed(trees: dict[int, Tree], home: bool):
    """Anchors to the leaves that they scan: their own, or all others that survive."""
    names = ["dim", "leaf", "n", "id", "label", "q", "low", "high"]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own_leaf = batch.column("leaf").to_numpy()
            if home:
                dims = np.diff(batch.column("q").offsets.to_numpy()).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(dims), *[batch.column(c) for c in names[1:]]], names=names)
                continue
            low, _ = _vectors(batch.column("low"))
            high, _ = _vectors(batch.column("high"))
            width = len(low) // max(batch.num_rows, 1)
            low, high = low.reshape(-1, width).astype(float), high.reshape(-1, width).astype(float)
            for dim, own, rows in _by_dim(batch.column("q")):
                tree = trees.get(dim) or Tree(0.0)
                rows = rows.astype(float)
                at = np.concatenate([rows, np.zeros((len(rows), 1))], axis=1)
                base = (rows * rows).sum(axis=1)[:, None] + tree.longest
                # the highest score is the inner radius; scores beyond any distance give an empty annulus
                inner = np.sqrt(np.maximum(base - 2 * high[own], 0))
                outer = np.where((low[own] > high[own]) | (base - 2 * low[own] < 0), -1.0,
                                 np.sqrt(np.maximum(base - 2 * low[own], 0)))
                slack = 1e-6 * (1 + np.sqrt(tree.longest))
                outer = np.where((outer < 0) & (low[own] <= high[own]) & (base - 2 * low[own] > -slack), 0.0, outer)
                for leaf, some in visited(tree, at, inner, outer):
                    some = own[some]
                    some = some[own_leaf[some] != leaf]
                    if len(some):
                        rows_ = pa.array(some)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(some), dim, np.int64)), pa.array(np.full(len(some), leaf, np.int64)),
                             *[batch.column(c).take(rows_) for c in names[2:]]], names=names)

    return route


ROUTED = ("dim long, leaf long, n long, id long, label long, q array<long>, low array<long>, high array<long>")
FOUND = "anchor long, slot int, score long, id long, n long"


def _scanned(same_label: bool, k: int):
    """Exact scores of a chunk of a leaf with a block of anchors: the first ``k`` per anchor and window."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in groups(batches, ["dim", "leaf", "chunk", "part"]):
            anchor = block["anchor"].to_numpy()
            rows, asked = block.filter(pa.array(~anchor)), block.filter(pa.array(anchor))
            if not len(rows) or not len(asked):
                continue
            ident = rows["id"].combine_chunks()
            none = ident.is_null().to_numpy(zero_copy_only=False)
            number = rows["n"].to_numpy()
            order = np.lexsort((number, ident.fill_null(0).to_numpy(), none))
            values, bounds = _vectors(rows["q"])
            dim = int(bounds[1] - bounds[0])
            at = values[bounds[0]:bounds[-1]].reshape(-1, dim)[order]
            number, label = number[order], rows["label"].to_numpy()[order]
            values, bounds = _vectors(asked["q"])
            of = values[bounds[0]:bounds[-1]].reshape(-1, dim)
            if float(np.abs(at).max()) * float(np.abs(of).max()) * dim < 1 << 53:
                scores = (of.astype(float) @ at.astype(float).T).astype(np.int64)  # exact: below 2^53
            else:
                scores = of @ at.T
            low, _ = _vectors(asked["low"])
            high, _ = _vectors(asked["high"])
            width = len(low) // len(asked)
            low, high = low.reshape(-1, width), high.reshape(-1, width)
            own, own_label = asked["n"].to_numpy(), asked["label"].to_numpy()
            out: list[tuple] = []
            for r in range(len(asked)):
                fit = (label == own_label[r]) & (number != own[r]) if same_label else label != own_label[r]
                for slot in range(width):
                    if low[r, slot] > high[r, slot]:
                        continue
                    at_ = np.flatnonzero(fit & (scores[r] >= low[r, slot]) & (scores[r] <= high[r, slot]))
                    got = scores[r, at_]
                    if len(at_) > k:
                        least = np.partition(got, len(got) - k)[len(got) - k]
                        at_ = at_[got >= least]
                        got = scores[r, at_]
                    first = np.argsort(-got, kind="stable")[:k]
                    out.append((np.full(len(first), own[r]), np.full(len(first), slot), got[first], order[at_[first]],
                                number[at_[first]]))
            if out:
                a, s, got, at_, n = (np.concatenate(c) for c in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a), pa.array(s.astype(np.int32)), pa.array(got), ident.take(pa.array(at_)), pa.array(n)],
                    names=["anchor", "slot", "score", "id", "n"])

    return scan


def _first(found: DataFrame, k: int) -> DataFrame:
    ranked = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc_nulls_last("id"), "n")
    return found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)


class Search:
    """Scans of the leaves of one written table of rows."""

    def __init__(self, rows: DataFrame, trees: dict[int, Tree], plan: Plan):
        self.plan, self.trees = plan, trees
        self.rows = rows.withColumn("dim", F.size("q").cast("long"))
        counted = self.rows.groupBy("dim", "leaf").agg(F.count("*").alias("rows"))
        self.chunks = kept(counted.select(
            "dim", "leaf", F.ceil(F.col("rows") / plan.chunk_rows).cast("long").alias("n_chunks")), "gnat-leaves")
        self.tasks = max(24, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def scan(self, anchors: DataFrame, same_label: bool, k: int, home: bool) -> DataFrame:
        """The first ``k`` per window of ``anchors`` in their own leaves, or in all others that survive."""
        routed = anchors.select("leaf", "n", "id", "label", "q", "low", "high").mapInArrow(
            _routed(self.trees, home), ROUTED)
        if not home:
            routed = kept(routed, "gnat-routes")
        blocks = routed.groupBy("dim", "leaf").agg(
            F.ceil(F.count("*") / self.plan.block_anchors).cast("long").alias("n_parts"))
        # one row per leaf: no more than sampled rows, so these two are small whatever the table
        leaves = F.broadcast(self.chunks.join(blocks, ["dim", "leaf"]))
        chunk = F.pmod(F.xxhash64("n"), F.col("n_chunks"))
        part = F.pmod(F.xxhash64("n", F.lit(3)), F.col("n_parts"))
        every = lambda upto: F.explode(F.sequence(F.lit(0).cast("long"), F.col(upto) - 1))
        names = ["dim", "leaf", "chunk", "part", "anchor", "n", "id", "label", "q", "low", "high"]
        none = F.lit(None).cast("array<long>")
        rows = (self.rows.join(leaves, ["dim", "leaf"]).withColumn("chunk", chunk).withColumn("part", every("n_parts"))
                .withColumns({"anchor": F.lit(False), "low": none, "high": none}).select(*names))
        asked = (routed.join(leaves, ["dim", "leaf"]).withColumn("part", part).withColumn("chunk", every("n_chunks"))
                 .withColumn("anchor", F.lit(True)).select(*names))
        keys = ["dim", "leaf", "chunk", "part"]
        return (rows.unionByName(asked).repartition(self.tasks, *keys).sortWithinPartitions(*keys)
                .mapInArrow(_scanned(same_label, k), FOUND))

    def first(self, anchors: DataFrame, same_label: bool, k: int, name: str) -> DataFrame:
        """``anchor, slot, rank, score, id, n``: the first ``k`` rows of each window of each anchor.

        What the own leaf offers raises the lower end of a window that it fills.
        """
        near = kept(_first(self.scan(anchors, same_label, k, True), k), f"gnat-{name}-near")
        full = near.filter(F.col("rank") == k).groupBy("anchor").agg(
            F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("full"))
        raised = (anchors.join(full.withColumnRenamed("anchor", "n"), "n", "left")
                  .withColumn("low", F.transform("low", lambda x, i: F.greatest(
                      x, F.coalesce(F.try_element_at(F.col("full"), i), x)))).drop("full"))
        rest = self.scan(raised, same_label, k, False)
        columns = ["anchor", "slot", "score", "id", "n"]
        return kept(_first(near.select(*columns).unionByName(rest.select(*columns)), k), f"gnat-{name}")


def hard_negatives(vectors: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                   label: Column | None = None, plan: Plan | None = None) -> DataFrame:
    """For each anchor and each of its positives, the first rows of another label in the score window.

    ``anchor`` says of a row of ``vectors`` (its ``id``, a long, and ``label``) whether it is an
    anchor; ``label`` defaults to the column of that name.  Components count in 256ths, rounded
    down.  Positives are the first ``plan.positives`` other rows of the anchor's label, negatives the
    first ``plan.negatives`` rows of another label with ``low <= 100 * score / positive score <=
    high``; higher scores come first, then smaller ids (null last), then rows as they were read.

    Returns ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.  An
    anchor without positives, or a positive without rows in its window, has no rows.  Rows with a null
    label or vector, an empty vector, or a component that is null, not finite or 2^17 or more in size
    take no part.  Vectors of different length are not compared.  Repeated rows, also those that share
    the anchor's id, count as rows of their own.  Further columns are left out.
    """
    plan = plan or Plan()
    rows, trees = grown(integers(vectors, id_col, vector_col, F.col("label") if label is None else label), plan)
    search = Search(rows, trees, plan)
    limit = 1 << 62
    asked = rows.filter(anchor).withColumns(
        {"low": F.array(F.lit(-limit)), "high": F.array(F.lit(limit))})
    positives = search.first(asked, True, plan.positives, "positives").select(
        "anchor", F.col("rank").alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    s = F.col("positive_score").cast("decimal(38,0)")
    windows = positives.select(
        "anchor", "slot", F.ceil(s * plan.low / 100).cast("long").alias("low"),
        F.floor(s * plan.high / 100).cast("long").alias("high"))
    held = windows.groupBy(F.col("anchor").alias("n")).agg(
        F.map_from_entries(F.collect_list(F.struct("slot", F.struct("low", "high")))).alias("windows"))
    slots = F.sequence(F.lit(1), F.lit(plan.positives))
    end = lambda name, empty: F.transform(slots, lambda i: F.coalesce(
        F.try_element_at("windows", i)[name], F.lit(empty).cast("long")))
    framed = rows.filter(anchor).join(held, "n").withColumns({"low": end("low", 1), "high": end("high", 0)}).drop("windows")
    negatives = search.first(framed, False, plan.negatives, "negatives").select(
        "anchor", (F.col("slot") + 1).alias("slot"), "rank", F.col("id").alias("negative_id"),
        F.col("score").alias("negative_score"))
    anchors = rows.filter(anchor).select(F.col("n").alias("anchor"), F.col("id").alias("anchor_id"))
    return (negatives.join(positives, ["anchor", "slot"]).join(anchors, "anchor")
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
                    "positive_score", "negative_score"))
