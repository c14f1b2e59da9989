"""Near-duplicate embeddings: exact cosine threshold links by cover trees and dual traversal.

Vectors of one label are compared by the chord between their unit vectors, a metric:
cosine >= t is chord <= sqrt(2 - 2 t), the reach.

1. Equal vectors of a label are one class with a number of copies.
2. Upper levels of the tree, for labels of more than ``CHUNK`` classes: a hashed sample
   of about ``CENTERS`` classes in all is thinned to a net of separation ``reach``; each
   centre moves to the mean of what lies within reach.  Every class goes to its nearest
   centre and to the level of its distance (radii 2, 1, 1/2, .. halving, the last half
   the reach): a node is a centre and a level, with the distances found there as bounds.
3. Nodes of a label are packed into boxes (large nodes: several), and node pairs that
   the covering radii keep further apart than the reach are pruned; members of one large
   node of radius half the reach are all linked and need no comparison.
4. The boxes of each pair left meet in a task.  Each grows a cover tree (nets of halving
   radii; a node keeps the mean of its members as its centre and the true covering
   radius), and pairs of nodes are traversed together: apart by more than radii and
   reach - pruned; within the reach whatever the radii - all linked, only counted; else
   their children meet.  Leaves and all pairs within ``SLACK`` of the reach are decided by
   the cosine itself.  A task returns a number of links for each class and a spanning
   forest, never pairs.
5. Components of the forests by alternating stars.

Work falls as far as covering radii separate the data: clusters and copies cost little;
classes spread evenly over many dimensions are at last all compared, box by box.

Defined results: a null, empty or zero vector, one with null or non-finite entries and
one without label link with nothing and are their own component; vectors of different
length never link; copies and ties count as links; the component is the smallest non-null
vec_id (null where there is none); rows with null or repeated vec_id are vectors of their
own; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardpanel.llm.graph import components
from cardpanel.llm.tables import about, stored
from cardpanel.llm.vectors import finite, matrix

CHUNK, CENTERS = 1024, 1024
#: Distances are good to about 1e-8; cosines this near the threshold are taken again in full.
SLACK, CLOSE = 1e-6, 1e-12
#: Nodes of so few members are leaves; as many compared pairs cost about as much as one visit to a pair of nodes.
LEAF, VISIT = 16, 2000


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b) - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0, out=square), out=square)


def net(d: np.ndarray, radius: float) -> np.ndarray:
    """Places of a greedy net: every row is within ``radius`` of one, none within it of another."""
    left, out = np.ones(len(d), bool), []
    while left.any():
        i = int(left.argmax())
        out.append(i)
        left &= d[i] > radius
        left[i] = False
    return np.array(out)


class Node:
    """A set of points, its centre and covering radius; children are made when first asked for."""

    def __init__(self, x: np.ndarray, members: np.ndarray, centre: np.ndarray, radius: float):
        self.x, self.members, self.centre, self.radius = x, members, centre, radius
        self._below: tuple | None = None
        self._nodes: dict[int, Node] = {}

    @classmethod
    def root(cls, x: np.ndarray) -> Node:
        centre = x.mean(0)
        return cls(x, np.arange(len(x)), centre, float(np.linalg.norm(x - centre, axis=1).max()))

    @property
    def leaf(self) -> bool:
        return len(self.members) <= LEAF or self.radius <= SLACK

    def below(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(centres, radii, child of each member): a net of the next halved radius that splits."""
        if self._below is None:
            x = self.x[self.members]
            d = distances(x, x)
            level = math.ceil(math.log2(self.radius)) - 1
            while len(at := net(d, 2.0**level)) == 1:  # one member covers all
                level -= 1
            child = d[:, at].argmin(1)
            centres = np.zeros((len(at), x.shape[1]))
            np.add.at(centres, child, x)
            centres /= np.bincount(child)[:, None]
            radii = np.zeros(len(at))
            np.maximum.at(radii, child, np.linalg.norm(x - centres[child], axis=1))
            self._below = centres, radii, child
        return self._below

    def child(self, i: int) -> Node:
        if i not in self._nodes:
            centres, radii, child = self.below()
            self._nodes[i] = Node(self.x, self.members[child == i], centres[i], float(radii[i]))
        return self._nodes[i]


class Links:
    """Traverses the trees of points a (and b, which follow a in all arrays; None: a with itself)."""

    def __init__(self, raw: np.ndarray, weight: np.ndarray, n_a: int, threshold: float):
        self.raw, self.x, self.weight = raw, unit(raw), weight.astype(float)
        self.threshold, self.reach = threshold, math.sqrt(max(0.0, 2 - 2 * threshold))
        self.count, self.root = np.zeros(len(raw)), np.arange(len(raw))
        self.n_a = n_a

    def run(self) -> None:
        if self.n_a == len(self.raw):
            self.within(Node.root(self.x))
        else:
            a, b = Node.root(self.x[: self.n_a]), Node.root(self.x[self.n_a :])
            a.x = b.x = self.x
            b.members = b.members + self.n_a
            self.between(a, b)

    def joined(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            a, b = self.root[i], self.root[j]
            apart = a != b
            if not apart.any():
                return
            np.minimum.at(self.root, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
            while (self.root != self.root[self.root]).any():
                self.root = self.root[self.root]

    def linked(self, hit: np.ndarray, rows: np.ndarray, cols: np.ndarray, both: bool) -> None:
        """Counts and joins the pairs that ``hit`` marks (``both``: for the columns, too)."""
        if not hit.any():
            return
        self.count[rows] += hit @ self.weight[cols]
        if both:
            self.count[cols] += self.weight[rows] @ hit
        for lo in range(0, len(rows), 256):
            i, j = np.nonzero(hit[lo : lo + 256])
            self.joined(rows[lo + i], cols[j])

    def compared(self, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
        cos = self.x[rows] @ self.x[cols].T
        hit = cos >= self.threshold
        for i, j in zip(*np.nonzero(np.abs(cos - self.threshold) < CLOSE)):
            hit[i, j] = cosine(self.raw[rows[i]], self.raw[cols[j]]) >= self.threshold
        return hit

    def all_linked(self, members: np.ndarray) -> None:
        self.joined(np.full(len(members) - 1, members[0]), members[1:])

    def within(self, p: Node) -> None:
        m = p.members
        if 2 * p.radius <= self.reach - SLACK:
            self.count[m] += self.weight[m].sum() - self.weight[m]
            self.all_linked(m)
        elif p.leaf:
            hit = self.compared(m, m)
            np.fill_diagonal(hit, False)
            self.linked(hit, m, m, False)
        else:
            self.children(p, p)
            sizes = np.bincount(p.below()[2])
            for i in np.flatnonzero(sizes > 1):
                self.within(p.child(int(i)))

    def between(self, p: Node, q: Node) -> None:
        if p.leaf and q.leaf or len(p.members) * len(q.members) <= VISIT:
            self.linked(self.compared(p.members, q.members), p.members, q.members, True)
        else:
            self.children(p, q)

    def children(self, p: Node, q: Node) -> None:
        """Pairs of children of p and q (of one node: each unordered pair once)."""
        same = p is q
        (pc, pr, pm), (qc, qr, qm) = self.parts(p), self.parts(q)
        d, radii = distances(pc, qc), pr[:, None] + qr
        linked = d + radii <= self.reach - SLACK
        undecided = ~linked & (d - radii <= self.reach + SLACK)
        del d, radii
        if same:
            linked, undecided = np.triu(linked, 1), np.triu(undecided, 1)
        if linked.any():
            self.counted(linked, p, q, pm, qm)
        i, j = np.nonzero(undecided)
        if not len(i):
            return
        rows, cols = np.isin(pm, i), np.isin(qm, j)
        if len(i) * VISIT >= rows.sum() * cols.sum():
            r, c = np.flatnonzero(rows), np.flatnonzero(cols)
            hit = self.compared(p.members[r], q.members[c]) & undecided[np.ix_(pm[r], qm[c])]
            self.linked(hit, p.members[r], q.members[c], True)
            return
        for a, b in zip(i.tolist(), j.tolist()):
            self.between(self.part(p, a), self.part(q, b))

    @staticmethod
    def parts(p: Node) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return (p.centre[None], np.array([p.radius]), np.zeros(len(p.members), int)) if p.leaf else p.below()

    @staticmethod
    def part(p: Node, i: int) -> Node:
        return p if p.leaf else p.child(i)

    def counted(self, linked: np.ndarray, p: Node, q: Node, pm: np.ndarray, qm: np.ndarray) -> None:
        """All members of linked children are linked."""
        wp = np.bincount(pm, self.weight[p.members], len(linked))
        wq = np.bincount(qm, self.weight[q.members], linked.shape[1])
        self.count[p.members] += (linked @ wq)[pm]
        self.count[q.members] += (wp @ linked)[qm]
        firsts = []
        for node, of, there in ((p, pm, linked.any(1)), (q, qm, linked.any(0))):
            head = np.zeros(len(there), int)
            head[of[::-1]] = node.members[::-1]
            mine = there[of]
            self.joined(node.members[mine], head[of[mine]])
            firsts.append(head)
        for lo in range(0, len(linked), 256):
            i, j = np.nonzero(linked[lo : lo + 256])
            self.joined(firsts[0][lo + i], firsts[1][j])


def cosine(a: np.ndarray, b: np.ndarray) -> float:
    a, b = a / np.abs(a).max(), b / np.abs(b).max()
    return math.fsum(a * b) / math.sqrt(math.fsum(a * a) * math.fsum(b * b))


def _classes(rows: DataFrame) -> DataFrame:
    """One row per distinct label and vector: cls, k1, k2, grp, v, copies, first_id."""
    found = rows.filter("k1 is not null").groupBy("k1", "k2").agg(
        F.first("grp").alias("grp"), F.first("v").alias("v"), F.count("*").alias("copies"), F.min("vec_id").alias("first_id"))
    return stored(found.withColumn("cls", F.monotonically_increasing_id()), "cover-classes")


def _centres(classes: DataFrame, reach: float) -> dict[str, np.ndarray]:
    """Centres of the large labels: a net of a bounded sample, moved to local means."""
    large = classes.groupBy("grp").count().filter(F.col("count") > CHUNK).select("grp")
    sample = about(classes.select("cls", "grp", "v").join(large, "grp"), "cls", CENTERS, "cover").select("grp", "v").toArrow().to_pylist()
    by: dict[str, list] = {}
    for r in sample:
        by.setdefault(r["grp"], []).append(r["v"])
    centres = {g: unit(np.array(v)) for g, v in by.items()}
    centres = {g: x[net(distances(x, x), reach)] for g, x in centres.items()}
    shared = classes.sparkSession.sparkContext.broadcast(centres)

    def run(batches):
        total: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for g, at, x, near, d in _nearest(batch, shared):
                for c in np.unique(near[d <= reach]):
                    part = x[(near == c) & (d <= reach)]
                    total[g, c] = total.get((g, c), 0) + np.append(part.sum(0), len(part))
        for (g, c), v in total.items():
            size = len(v)
            yield pa.RecordBatch.from_arrays([pa.array([g] * size), pa.array(np.full(size, c, np.int32)), pa.array(np.arange(size, dtype=np.int32)), pa.array(v)],
                                             ["grp", "center", "i", "v"])

    sums = classes.select("grp", "v").mapInArrow(run, "grp string, center int, i int, v double").groupBy("grp", "center", "i").agg(F.sum("v").alias("v"))
    moved: dict[tuple, dict[int, float]] = {}
    for r in sums.toArrow().to_pylist():
        moved.setdefault((r["grp"], r["center"]), {})[r["i"]] = r["v"]
    for (g, c), v in moved.items():
        centres[g][c] = [v[i] / v[len(v) - 1] for i in range(len(v) - 1)]
    return centres


def _nearest(batch: pa.RecordBatch, centres: Broadcast):
    """(label, rows, unit vectors, nearest centre, distance) for each label of a batch
    (columns grp, v) that has centres."""
    codes = batch.column(0).dictionary_encode()
    which = codes.indices.to_numpy()
    for k, g in enumerate(codes.dictionary.to_pylist()):
        if g in centres.value:
            c = centres.value[g]
            at = np.flatnonzero(which == k)
            x = unit(matrix(batch.column(1).take(pa.array(at)), c.shape[1]))
            d = distances(x, c)
            near = d.argmin(1)
            yield g, at, x, near, d[np.arange(len(at)), near]


def _placed(classes: DataFrame, centres: Broadcast, edges: list[float]) -> DataFrame:
    """Classes with their centre (-1: the label has none), level and distance."""

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            center, level, dist = np.full(n, -1, np.int32), np.zeros(n, np.int32), np.full(n, 2.0)
            for _, at, _, near, d in _nearest(batch.select([1, 2]), centres):
                center[at], dist[at] = near, d
                level[at] = sum((d <= e).astype(np.int32) for e in edges)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(center), pa.array(level), pa.array(dist)],
                                             ["cls", "grp", "v", "copies", "center", "level", "dist"])

    return classes.select("cls", "grp", "v", "copies").mapInArrow(
        run, "cls long, grp string, v array<double>, copies long, center int, level int, dist double")


def _packed(nodes: pd.DataFrame) -> pd.DataFrame:
    """The nodes of one label dealt to boxes: a large node has its own, of several parts."""
    nodes = nodes.sort_values(["level", "center"], ignore_index=True)
    size = nodes["n"].to_numpy()
    large = size > CHUNK
    before = np.where(large, 0, size).cumsum() - np.where(large, 0, size)
    nodes["box"] = np.where(large, -1 - np.arange(len(nodes)), before // CHUNK)
    nodes["parts"] = np.where(large, -(-size // CHUNK), 1)
    return nodes


def _open_pairs(centres: Broadcast, reach: float, tight: int):
    """Pairs of boxes of one label that no covering radius keeps apart."""

    def pairs(nodes: pd.DataFrame) -> pd.DataFrame:
        box, at = np.unique(nodes["box"], return_inverse=True)
        parts = np.zeros(len(box), int)
        parts[at] = nodes["parts"]
        center, lo, hi = (nodes[c].to_numpy() for c in ("center", "lo", "hi"))
        c = centres.value.get(nodes["grp"].iloc[0])
        open_ = np.zeros((len(box), len(box)), bool)
        for i in range(len(nodes)):
            if c is None or center[i] < 0:
                open_[at[i]] = True
                continue
            # nearest centres: a point of node j is at least lo[j] away from every centre, and at least d - hi[j] from this one's
            d = distances(c[center[i]][None], c[center])[0]
            gap = np.maximum(np.maximum(lo, d - hi) - hi[i], np.maximum(lo[i], d - hi[i]) - hi)
            open_[at[i], at[gap <= reach + SLACK]] = True
        open_ |= open_.T
        whole = nodes.loc[(nodes["parts"] > 1) & (nodes["level"] == tight), "box"]
        open_[np.searchsorted(box, whole), np.searchsorted(box, whole)] = False
        a, b = np.nonzero(np.triu(open_))
        return pd.DataFrame({"grp": nodes["grp"].iloc[0], "box_a": box[a], "parts_a": parts[a], "box_b": box[b], "parts_b": parts[b]})

    return pairs


def _met(threshold: float):
    """The links of the points of one pair of boxes, as counts and a spanning forest."""

    def meet(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("side", "ascending"), ("cls", "ascending")])
        cls, side = table["cls"].to_numpy(), table["side"].to_numpy()
        n_a = int((side == 0).sum())
        if 0 < n_a and (n_a < len(side) or not table["crossed"][0].as_py()):
            raw = table["v"].combine_chunks().flatten().to_numpy().reshape(len(cls), -1)
            links = Links(raw, table["copies"].to_numpy(), n_a, threshold)
            links.run()
            counted, child = np.flatnonzero(links.count), np.flatnonzero(links.root != np.arange(len(cls)))
            count = np.rint(links.count[counted]).astype(np.int64)
        else:
            counted = child = count = np.empty(0, np.int64)
        return pa.table({
            "a": np.concatenate([cls[counted], cls[child]]),
            "b": pa.concat_arrays([pa.nulls(len(counted), pa.int64()), pa.array(cls[links.root[child]] if len(child) else child, pa.int64())]),
            "n": pa.concat_arrays([pa.array(count), pa.nulls(len(child), pa.int64())])})

    return meet


def near_vectors(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    reach = math.sqrt(2 - 2 * threshold)
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), F.col("embedding").cast("array<double>").alias("v"))
    usable = finite("v") & F.col("label").isNotNull() & F.exists("v", lambda c: c != 0)
    hashed = lambda seed: F.when(usable, F.xxhash64(F.lit(seed), F.col("label"), F.col("v")))
    rows = rows.select("vec_id", "v", F.concat_ws("/", F.size("v"), "label").alias("grp"), hashed(1).alias("k1"), hashed(2).alias("k2"))
    classes = _classes(rows)
    sc = vectors.sparkSession.sparkContext
    centres = sc.broadcast(_centres(classes, reach))
    edges = [1.0, *(2.0**-i for i in range(1, 60) if 2.0**-i > reach / 2), reach / 2 - SLACK]
    tight = len(edges)
    points = stored(_placed(classes, centres, edges), "cover-points")
    nodes = points.groupBy("grp", "center", "level").agg(
        F.count("*").alias("n"), F.sum("copies").alias("weight"), F.min("dist").alias("lo"), F.max("dist").alias("hi"))
    node_schema = "grp string, center int, level int, n long, weight long, lo double, hi double"
    nodes = stored(nodes.groupBy("grp").applyInPandas(_packed, f"{node_schema}, box long, parts long"), "cover-nodes")
    pairs = nodes.groupBy("grp").applyInPandas(_open_pairs(centres, reach, tight), "grp string, box_a long, parts_a long, box_b long, parts_b long")
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    pairs = pairs.withColumn("part_a", each("parts_a")).withColumn("part_b", each("parts_b")).filter("box_a != box_b or part_a <= part_b")
    pairs = pairs.select("grp", "box_a", "part_a", "box_b", "part_b", ((F.col("box_a") != F.col("box_b")) | (F.col("part_a") != F.col("part_b"))).alias("crossed"))
    pairs = stored(pairs.withColumn("task", F.monotonically_increasing_id()), "cover-pairs")
    boxed = points.join(nodes.select("grp", "center", "level", "box", "parts", "weight"), ["grp", "center", "level"])
    boxed = stored(boxed.withColumn("part", F.pmod(F.xxhash64("cls"), F.col("parts"))), "cover-boxed")
    side = lambda x, other, n: boxed.select("grp", F.col("box").alias(f"box_{x}"), F.col("part").alias(f"part_{x}"), "cls", "copies", "v").join(
        other, ["grp", f"box_{x}", f"part_{x}"]).select("task", F.lit(n).alias("side"), "crossed", "cls", "copies", "v")
    both = side("a", pairs, 0).union(side("b", pairs.filter("crossed"), 1))
    met = stored(both.groupBy("task").applyInArrow(_met(threshold), "a long, b long, n long"), "cover-links")

    whole = boxed.filter((F.col("level") == tight) & (F.col("parts") > 1))
    heads = whole.groupBy("grp", "center").agg(F.min("cls").alias("head"))
    whole = whole.join(heads, ["grp", "center"]).select("cls", "head", (F.col("weight") - F.col("copies")).alias("n"))
    counts = met.filter("n is not null").select(F.col("a").alias("cls"), "n").union(whole.select("cls", "n"))
    counts = counts.groupBy("cls").agg(F.sum("n").alias("n"))
    forest = met.filter("b is not null").select("a", "b")
    for end in ("a", "b"):
        forest = forest.join(whole.select(F.col("cls").alias(end), F.col("head").alias("to")), end, "left").withColumn(end, F.coalesce("to", end)).drop("to")
    named = classes.select("cls", "k1", "k2", "copies", "first_id").join(whole.select("cls", "head"), "cls", "left").join(counts, "cls", "left")
    named = named.withColumn("node", F.coalesce("head", "cls")).join(components(forest), "node", "left").withColumn("root", F.coalesce("root", "node"))
    firsts = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = named.join(firsts, "root").select("k1", "k2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    linked = rows.filter("k1 is not null").join(named, ["k1", "k2"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter("k1 is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
