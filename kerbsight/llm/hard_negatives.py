"""Hard negatives by a vantage-point tree over norm-augmented vectors.

1. A row x becomes the point (x, sqrt(M - |x|^2)), M the largest squared norm; an anchor q becomes (q, 0). Then the squared
   distance is |q|^2 + M - 2 q.x: nearest first is highest score first, and a window of scores is an annulus around q.
2. A tree whose vantage points and radii come from a bounded sample sends every row to a leaf. Leaves are cut into blocks
   of about ``BLOCK_ROWS`` rows by a hash, so that copies of one vector, which no radius parts, don't fill one task. Each
   block has a small tree of its own with buckets of ``BUCKET_ROWS``. Nodes keep the least and largest distance of their
   rows to the vantage points above them.
3. By the triangle inequality these bound the distances from an anchor to the rows of a node. A search goes through the
   nodes that can meet its annulus, nearest first, until the next one is farther than its k-th best: first the leaf with
   the least bound, then, with what that gave, all others that still can hold something better.
4. Scores are exact integers and decide; distances only say where to look, with a margin for rounding. So the result is
   that of comparing all rows, whatever the sample.

Anchors of a leaf come in portions, so a task holds one block and one portion. How much is skipped depends on the data:
vectors without structure in many dimensions are about equally far from each other, and then most blocks are visited.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbsight.llm.runtime import lean, returned
from kerbsight.operators.scratch import written

#: Rows of a block, of a bucket within it, and anchors of a portion, about.
BLOCK_ROWS, BUCKET_ROWS, PORTION = 8192, 256, 4096
#: Deepest tree that is sent to every task (4096 leaves), and sampled rows for each of its leaves.
MOST_LEVELS, SAMPLED = 12, 16
#: Largest whole number below which doubles are exact.
EXACT = float(1 << 53)


@dataclass
class Tree:
    """A complete binary tree: vantage points and radii of its inner nodes, children of node i are 2i + 1 and 2i + 2."""

    vantage: np.ndarray
    radius: np.ndarray
    levels: int
    #: For each leaf and level the least and largest distance of its rows to the vantage point there.
    low: np.ndarray | None = None
    high: np.ndarray | None = None

    @property
    def leaves(self) -> int:
        return 1 << self.levels

    def route(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each point's leaf, and its distances to the vantage points on the way there."""
        node, path = np.zeros(len(points), np.int64), np.empty((len(points), self.levels))
        for level in range(self.levels):
            path[:, level] = np.sqrt(np.maximum(((points - self.vantage[node]) ** 2).sum(1), 0))
            node = 2 * node + 1 + (path[:, level] > self.radius[node])
        return node - (self.leaves - 1), path

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query and leaf bounds of the distance to the leaf's rows; infinite and 0 for empty leaves."""
        near, far = np.zeros((len(queries), self.leaves)), np.full((len(queries), self.leaves), np.inf)
        if self.levels:
            to = distances(queries, self.vantage)
        for level in range(self.levels):
            d = to[:, (1 << level) - 1 + (np.arange(self.leaves) >> (self.levels - level))]
            near = np.maximum(near, np.maximum(d - self.high[:, level], self.low[:, level] - d))
            far = np.minimum(far, d + self.high[:, level])
        return near, far


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squared = (a**2).sum(1)[:, None] + (b**2).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(squared, 0))


def grow(points: np.ndarray, levels: int) -> Tree:
    """A tree whose radii halve the points. Of a few points the one with the most unequal distances becomes vantage."""
    tree = Tree(np.zeros(((1 << levels) - 1, points.shape[1])), np.zeros((1 << levels) - 1), levels)
    rows = {0: np.arange(len(points))}
    for node in range(len(tree.radius)):
        own = rows.pop(node)
        if len(own):
            tried = own[np.linspace(0, len(own) - 1, min(8, len(own))).astype(int)]
            d = distances(points[tried], points[own])
            best = int(np.argmax(d.std(1)))
            tree.vantage[node], tree.radius[node] = points[tried[best]], np.median(d[best])
            own_d = np.sqrt(((points[own] - tree.vantage[node]) ** 2).sum(1))
            inside = own_d <= tree.radius[node]
        else:
            inside = np.zeros(0, bool)
        rows[2 * node + 1], rows[2 * node + 2] = own[inside], own[~inside]
    return tree


def spans_of(tree: Tree, leaf: np.ndarray, path: np.ndarray) -> None:
    """Sets the least and largest distances of each leaf's rows."""
    tree.low, tree.high = np.full((tree.leaves, tree.levels), np.inf), np.full((tree.leaves, tree.levels), -np.inf)
    np.minimum.at(tree.low, leaf, path)
    np.maximum.at(tree.high, leaf, path)


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Vectors as rows, shorter ones with zeros behind; doubles where these are exact, else Python integers."""
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else pc.fill_null(pc.list_value_length(column), 0).to_numpy()
    values = pc.list_flatten(column).to_numpy()
    exact = not len(values) or max(-float(values.min()), float(values.max())) < EXACT
    out = np.zeros((len(size), dim), float if exact else object)
    out[np.arange(dim)[None, :] < size[:, None]] = values if exact else [int(x) for x in values]
    return out


def scores_of(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact inner products, as doubles where these are exact, else as Python integers."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * max(q.shape[1], 1)
    if most < EXACT:
        return q.astype(float) @ v.astype(float).T
    whole = lambda m: np.array([[int(x) for x in row] for row in m], object).reshape(m.shape)
    return whole(q) @ whole(v).T


def augmented(v: np.ndarray, m: float) -> np.ndarray:
    v = v.astype(float)
    return np.column_stack([v, np.sqrt(np.maximum(m - (v**2).sum(1), 0))])


def asking(q: np.ndarray) -> np.ndarray:
    return np.column_stack([q.astype(float), np.zeros(len(q))])


@dataclass
class Wanted:
    """What each query looks for: rows of its label or of others, but not itself, of scores from low to high, the first k."""

    vectors: np.ndarray
    row: np.ndarray
    label: np.ndarray
    same: bool
    low: np.ndarray
    high: np.ndarray
    k: int

    def annulus(self, m: float) -> tuple[np.ndarray, np.ndarray]:
        """Distances between which a row of such a score lies, widened a little."""
        whole = (self.vectors.astype(float) ** 2).sum(1) + m
        slack = 1 + 1e-9 * whole
        reach = lambda s: np.sqrt(np.maximum(s, 0))
        return reach(whole - 2 * self.high - slack), reach(whole - 2 * self.low + slack)


class Block:
    """Rows of one task with a tree of their own; buckets hold rows by id, null ids last."""

    def __init__(self, ids, no_id, rows, labels, vectors: np.ndarray, m: float):
        levels = max(0, math.ceil(math.log2(max(len(vectors), 1) / BUCKET_ROWS)))
        points = augmented(vectors, m)
        self.tree, self.m = grow(points, levels), m
        leaf, path = self.tree.route(points)
        spans_of(self.tree, leaf, path)
        order = np.lexsort((ids, no_id, leaf))
        self.ids, self.no_id, self.rows, self.labels, self.vectors = ids[order], no_id[order], rows[order], labels[order], vectors[order]
        self.edges = np.searchsorted(leaf[order], np.arange(self.tree.leaves + 1))

    def search(self, want: Wanted) -> dict[str, np.ndarray]:
        """The first k rows for each query as (query, score, index of the row)."""
        n = len(want.row)
        near, far = self.tree.bounds(asking(want.vectors))
        inner, outer = want.annulus(self.m)
        order = np.argsort(near, axis=1, kind="stable")
        found = {"q": np.zeros(0, np.int64), "s": np.zeros(0, object if want.vectors.dtype == object else float), "at": np.zeros(0, np.int64)}
        least = want.low.copy()
        active = np.arange(n)
        for turn in range(self.tree.leaves):
            bucket = order[active, turn]
            active, bucket = active[keep := near[active, bucket] <= outer[active]], bucket[keep]
            if not len(active):
                break
            met = far[active, bucket] >= inner[active]
            new = [self._look(want, least, active[met & (bucket == b)], b) for b in np.unique(bucket[met])]
            if any(len(x[0]) for x in new):
                q, s, at = (np.concatenate([old, *(x[i] for x in new)]) for i, old in enumerate((found["q"], found["s"], found["at"])))
                by = np.lexsort((self.ids[at], self.no_id[at], (-s).astype(float), q)) if s.dtype != object else np.array(sorted(range(len(q)), key=lambda i: (q[i], -s[i], self.no_id[at[i]], self.ids[at[i]])), np.int64)
                q, s, at = q[by], s[by], at[by]
                first = np.searchsorted(q, q)
                top = np.arange(len(q)) - first < want.k
                q, s, at = q[top], s[top], at[top]
                found = {"q": q, "s": s, "at": at}
                full, where = np.unique(q[::-1], return_index=True)
                last, count = len(q) - 1 - where, np.bincount(q, minlength=n)
                full, last = full[have := count[full] >= want.k], last[have]
                least[full] = np.maximum(least[full], s[last].astype(float))
                outer = np.minimum(outer, Wanted(want.vectors, want.row, want.label, want.same, least, want.high, want.k).annulus(self.m)[1])
        return found

    def _look(self, want: Wanted, least: np.ndarray, who: np.ndarray, bucket: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b = self.edges[bucket], self.edges[bucket + 1]
        s = scores_of(want.vectors[who], self.vectors[a:b])
        alike = self.labels[a:b][None, :] == want.label[who][:, None]
        good = (alike if want.same else ~alike) & (s >= least[who][:, None]) & (s <= want.high[who][:, None]) & (self.rows[a:b][None, :] != want.row[who][:, None])
        i, j = np.nonzero(good)
        return who[i], s[i, j], a + j


_ROUTED = "_leaf int, _path array<double>, _row long, _id long, _label string, _vec array<long>, _anchor boolean"
_FOUND = "_row long, _rank int, _id long, _score long"


def _codes(labels: pa.ChunkedArray, known: dict) -> np.ndarray:
    return np.array([known.setdefault(x, len(known)) for x in labels.to_pylist()], np.int64)


def _searched(dim: int, m: float, k: int, same: bool):
    """The first k rows of a block for each query of a portion."""

    def search(blocks: pa.Table, visits: pa.Table) -> pa.Table:
        names, known = ["_row", "_rank", "_id", "_score"], {}
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        empty = pa.table([pa.array([], t) for t in types], names)
        if not blocks.num_rows or not visits.num_rows:
            return empty
        no_id = blocks["_id"].is_null().to_numpy()
        block = Block(blocks["_id"].fill_null(0).to_numpy(), no_id, blocks["_row"].to_numpy(), _codes(blocks["_label"], known), matrix(blocks["_vec"], dim), m)
        number = lambda name: visits[name].to_numpy()
        found = block.search(Wanted(matrix(visits["_vec"], dim), number("_row"), _codes(visits["_label"], known), same, number("_low"), number("_high"), k))
        if not len(found["q"]):
            return empty
        whole = np.array([min(max(int(x), -(2**63)), 2**63 - 1) for x in found["s"]], np.int64) if found["s"].dtype == object else found["s"].astype(np.int64)
        q, at = found["q"], found["at"]
        out = pa.table([pa.array(number("_row")[q]), pa.array(number("_rank")[q]), pa.array(block.ids[at], pa.int64(), mask=block.no_id[at]), pa.array(whole)], names)
        returned()
        return out

    return search


class Index:
    """All rows in blocks, and the tree that leads to them."""

    def __init__(self, rows: DataFrame):
        """``rows`` has _row, _id, _label, _vec (integers) and _anchor."""
        self.rows = rows
        squared = F.aggregate("_vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
        n, m, dim, anchors = rows.agg(F.count("*"), F.max(squared), F.max(F.size("_vec")), F.count_if("_anchor")).first()
        self.n, self.m, self.dim, self.n_anchors = n, float(m or 0), dim or 0, anchors
        if not anchors:
            return
        levels = min(MOST_LEVELS, max(0, math.ceil(math.log2(n / BLOCK_ROWS))))
        wanted = SAMPLED << levels
        share = min(1.0, wanted / n)
        drawn = rows.where(F.pmod(F.xxhash64("_row", "_id"), F.lit(1 << 20)) < math.ceil(share * (1 << 20))).select("_vec").limit(2 * wanted) if levels else None
        tree = grow(augmented(matrix(drawn.toArrow()["_vec"], self.dim), self.m), levels) if levels else Tree(np.zeros((0, self.dim + 1)), np.zeros(0), 0)
        dim, m = self.dim, self.m

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a in range(0, batch.num_rows, 4096):
                    part = batch.slice(a, 4096)
                    leaf, path = tree.route(augmented(matrix(part.column("_vec"), dim), m))
                    yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int32()), pa.array(path.tolist(), pa.list_(pa.float64())), *(part.column(c) for c in ("_row", "_id", "_label", "_vec", "_anchor"))], names=["_leaf", "_path", "_row", "_id", "_label", "_vec", "_anchor"])

        routed = written(rows.select("_row", "_id", "_label", "_vec", "_anchor").mapInArrow(lean(route), _ROUTED), "routed")
        place = [F.element_at("_path", i + 1) for i in range(levels)]
        spans = routed.groupBy("_leaf").agg(F.count("*").alias("n"), F.array(*map(F.min, place)).alias("low"), F.array(*map(F.max, place)).alias("high")).collect()
        tree.low, tree.high = np.full((tree.leaves, levels), np.inf), np.full((tree.leaves, levels), -np.inf)
        salts = np.zeros(tree.leaves, np.int64)
        for r in spans:
            tree.low[r["_leaf"]], tree.high[r["_leaf"]] = r["low"], r["high"]
            salts[r["_leaf"]] = math.ceil(r["n"] / BLOCK_ROWS)
        self.tree, self.salts, self.portions = tree, salts, math.ceil(anchors / PORTION)
        self.routed = routed
        number = F.element_at(F.array(*[F.lit(int(x)) for x in salts]), F.col("_leaf") + 1)
        self.blocks = routed.select("_leaf", F.pmod(F.xxhash64("_row"), number).cast("int").alias("_block"), "_row", "_id", "_label", "_vec")

    def anchors(self) -> DataFrame:
        return self.routed.where("_anchor").select("_row", "_id", "_label", "_vec")

    def _visits(self, asked: DataFrame, same: bool, k: int, home: bool) -> DataFrame:
        """Where each query has to look: in the leaf of the least bound, or in the others whose rows can meet its annulus."""
        tree, salts, dim, m = self.tree, self.salts, self.dim, self.m
        columns = asked.columns

        def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a in range(0, batch.num_rows, 256):
                    part = batch.slice(a, 256)
                    q = matrix(part.column("_vec"), dim)
                    none = np.zeros(len(q))
                    inner, outer = Wanted(q, none, none, same, part.column("_low").to_numpy(), part.column("_high").to_numpy(), k).annulus(m)
                    near, far = tree.bounds(asking(q))
                    first = np.zeros(near.shape, bool)
                    first[np.arange(len(q)), np.argmin(near, axis=1)] = True
                    meets = (near <= outer[:, None]) & (far >= inner[:, None]) & (salts > 0)
                    i, leaf = np.nonzero(meets & (first if home else ~first))
                    i, leaf = np.repeat(i, salts[leaf]), np.repeat(leaf, salts[leaf])
                    start = np.flatnonzero(np.concatenate([[True], (i[1:] != i[:-1]) | (leaf[1:] != leaf[:-1])])) if len(i) else np.zeros(0, np.int64)
                    block = np.arange(len(i)) - np.repeat(start, np.diff(np.concatenate([start, [len(i)]])))
                    taken = part.take(pa.array(i))
                    yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(leaf, pa.int32()), pa.array(block, pa.int32())], names=[*columns, "_leaf", "_block"])

        return asked.mapInArrow(visit, ", ".join(f"{c} {t}" for c, t in [*asked.dtypes, ("_leaf", "int"), ("_block", "int")]))

    def _wave(self, asked: DataFrame, same: bool, k: int, home: bool) -> DataFrame:
        visits = self._visits(asked, same, k, home).withColumn("_portion", F.pmod(F.xxhash64("_row"), F.lit(self.portions)).cast("int"))
        key = ["_leaf", "_block", "_portion"]
        blocks = self.blocks.withColumn("_portion", F.explode(F.sequence(F.lit(0), F.lit(self.portions - 1))))
        return blocks.groupBy(*key).cogroup(visits.groupBy(*key)).applyInArrow(_searched(self.dim, self.m, k, same), _FOUND)

    def first(self, asked: DataFrame, same: bool, k: int, name: str) -> DataFrame:
        """``(_row, _rank, _at, _id, _score)``: the first ``k`` rows, numbered by ``_at``, for each query of ``asked``.

        Queries are ``(_row, _rank, _label, _vec, _low, _high)``; _row and _rank name them.
        """
        query = ["_row", "_rank"]
        ranked = lambda df: df.withColumn("_at", F.row_number().over(Window.partitionBy(*query).orderBy(F.desc("_score"), F.col("_id").asc_nulls_last()))).where(F.col("_at") <= k)
        begun = written(ranked(self._wave(asked, same, k, home=True)), f"{name}-home")
        kth = begun.where(F.col("_at") == k).select(*query, F.col("_score").cast("double").alias("_kth"))
        rest = asked.join(kth, query, "left").withColumn("_low", F.greatest("_low", F.coalesce("_kth", "_low"))).select(*asked.columns)
        return written(ranked(begun.drop("_at").unionByName(self._wave(rest, same, k, home=False))), name)


def hard_negatives(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", anchor: Column | None = None, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Components become floor(scale * x), a score is the integer inner product with the anchor, higher ones come first, ties
    by smaller id. An anchor's positives are its first rows of the same label, its negatives for a positive the first rows
    of other labels with low * positive_score <= 100 * negative_score <= high * positive_score. ``anchor`` says which rows
    are anchors: those with ids divisible by 100 if it isn't given.

    Rows with a null label or vector, or any null or non-finite component take no part. Shorter vectors count as having
    zeros behind. Rows that repeat an id are rows of their own, and anchors of their own; a null id is larger than any
    other. Windows are exact for scores below 2**53; scores beyond a long are cut to its range. Other columns are ignored; no anchors, no rows.
    """
    whole = F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * scale).cast("long"))
    finite = F.forall(F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    asks = anchor if anchor is not None else F.col(id_col) % 100 == 0
    plain = rows.where(F.col(label_col).isNotNull() & F.col(vector_col).isNotNull()).where(finite)
    plain = plain.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("string").alias("_label"), whole.alias("_vec"), F.coalesce(asks, F.lit(False)).alias("_anchor"))
    index = Index(written(plain, "vectors"))
    if not index.n_anchors:
        return rows.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    any_score = {"_low": F.lit(-math.inf), "_high": F.lit(math.inf)}
    anchors = index.anchors()
    near = index.first(anchors.select("_row", F.lit(0).alias("_rank"), "_label", "_vec", *[c.alias(n) for n, c in any_score.items()]), True, positives, "positives")
    window = {"_low": F.ceil(F.col("_score") * F.lit(low).cast("decimal(20,0)") / 100).cast("double"), "_high": F.floor(F.col("_score") * F.lit(high).cast("decimal(20,0)") / 100).cast("double")}
    pairs = near.select("_row", F.col("_at").alias("_rank"), F.col("_id").alias("_positive"), "_score")
    asked = pairs.join(anchors, "_row").select("_row", "_rank", "_label", "_vec", *[c.alias(n) for n, c in window.items()]).where("_low <= _high")
    far = index.first(asked, False, negatives, "negatives")
    named = pairs.join(anchors.select("_row", F.col("_id").alias("anchor_id")), "_row").withColumnRenamed("_score", "positive_score")
    return far.withColumnRenamed("_score", "negative_score").join(named, ["_row", "_rank"]).select("anchor_id", F.col("_positive").alias("positive_id"), F.col("_at").alias("rank"), F.col("_id").alias("negative_id"), "positive_score", "negative_score")
