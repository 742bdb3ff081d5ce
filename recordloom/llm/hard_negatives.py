"""Hard negatives by vantage-point trees over norm-augmented vectors.

Every vector v gets one more component, sqrt(M^2 - |v|^2) with M the largest norm, an
anchor gets 0 and is lengthened to M, by c = M / |anchor|. All then lie on one sphere, and
distance^2 = 2 * M^2 - 2 * c * score: a higher score is a nearer row, and a window of scores is
an annulus around the anchor.

1. A vantage-point tree over a bounded sample (``SAMPLE`` rows, taken by hash) cuts space
   into cells; every row goes down it to its cell. Cells of over ``SHARD`` rows are dealt
   to several shards. For each cell the least and largest distance to the vantage points
   above it are kept: a table of cells, not of rows.
2. A request is an anchor with a window of scores. It goes to the most promising cell
   first; what that gives raises the window's lower end, and then to every other cell that
   the annulus still meets.
3. In a shard the rows make a vantage-point tree of their own. It is visited nearest first
   inside the annulus and left when the k-th score cannot be passed any more.
4. Positives come from one such search (same label, no window), negatives from a second
   (other labels, one window for each positive).

Tree distances are floating point and prune with slack; windows, scores and ranks are
decided on whole numbers. Of rows with one label and vector only the first ``k`` by id are
indexed: any further one ranks behind them in every search, so results are whole.

Rows: a null id, label, vector or component, or one that is not finite, takes no part;
shorter vectors count as ended by zeros; ties go by id; rows repeated whole count once;
rows of one id that differ all take part and each is an anchor of its own; columns of
other names are not looked at; an empty table gives an empty result. Components beyond
2^31 after scaling, and scores beyond 62 bits, abort the job.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, drop, lean, mapped, materialise

SAMPLE = 2048
CELL = 4096
CELLS = 256
SHARD = 4096
LEAF = 192
REQUESTS = 4096
LOWEST, HIGHEST = -(1 << 62), 1 << 62


@dataclass
class Tree:
    """Nodes of a vantage-point tree: inner child, outer child, and the distances found below each."""

    leaf: int
    vantage: list = field(default_factory=list)
    children: list = field(default_factory=list)
    bounds: list = field(default_factory=list)
    cut: list = field(default_factory=list)
    rows: list = field(default_factory=list)

    def build(self, points: np.ndarray, at: np.ndarray) -> int:
        node = len(self.children)
        for held in (self.vantage, self.children, self.bounds, self.cut, self.rows):
            held.append(None)
        if len(at) <= self.leaf:
            self.rows[node] = at
            return node
        own = points[at]
        far = at[int(np.argmax(((own - own.mean(axis=0)) ** 2).sum(axis=1)))]
        gap = np.sqrt(((own - points[far]) ** 2).sum(axis=1))
        order = np.argsort(gap, kind="stable")
        half = len(at) // 2
        self.vantage[node] = points[far]
        self.cut[node] = gap[order[half - 1]]
        self.bounds[node] = [(gap[part[0]], gap[part[-1]]) for part in (order[:half], order[half:])]
        self.children[node] = [self.build(points, at[part]) for part in (order[:half], order[half:])]
        return node

    def leaves(self, node: int = 0, path: tuple = ()) -> list[tuple[int, tuple]]:
        """Leaves from inner to outer, with the vantage nodes above them."""
        if self.children[node] is None:
            return [(node, path)]
        return [x for child in self.children[node] for x in self.leaves(child, (*path, node))]


def augmented(vectors: np.ndarray, most: float) -> np.ndarray:
    """Vectors with sqrt(M^2 - |v|^2) as one more component."""
    norm = (vectors * vectors).sum(axis=1)
    return np.concatenate([vectors, np.sqrt(np.maximum(most - norm, 0))[:, None]], axis=1)


class Place:
    """An anchor among the augmented rows: lengthened to their common norm M, so that it lies on their sphere."""

    def __init__(self, anchor: np.ndarray, most: float):
        norm = float(np.sqrt((anchor * anchor).sum()))
        self.scale, self.most = most**0.5 / norm if norm and most else 1.0, most
        self.point = np.append(anchor * self.scale, 0.0)
        self.norm2 = (norm * self.scale) ** 2
        self.slack = 1e-7 * (1 + 2 * most**0.5)

    def gaps(self, places: np.ndarray) -> np.ndarray:
        return np.sqrt(((places - self.point) ** 2).sum(axis=1))

    def radius(self, score: int) -> float:
        """Distance of a row with this score."""
        return float(np.sqrt(max(self.norm2 + self.most - 2.0 * self.scale * score, 0.0)))

    def ring(self, low: int, high: int) -> list[float]:
        """Radii between which rows of these scores lie, with slack."""
        return [self.radius(high) - self.slack, self.radius(low) + self.slack]


def exact_scores(rows: np.ndarray, largest: int, anchor: np.ndarray) -> np.ndarray:
    """Whole-number inner products; in floating point only where every sum stays exact."""
    if rows.shape[1] * largest * int(np.abs(anchor).max(initial=0)) < 1 << 53:
        return (rows @ anchor.astype(np.float64)).astype(np.int64)
    exact = rows.astype(np.int64).astype(object) @ anchor.astype(object)
    if any(not LOWEST < x < HIGHEST for x in exact):
        raise OverflowError("a score passes 62 bits")
    return exact.astype(np.int64)


class Shard:
    """Rows of one shard with their tree."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, most: float):
        self.ids, self.labels, self.vectors, self.most = ids, labels, vectors.astype(np.float64), most
        self.largest = int(np.abs(vectors).max(initial=0))
        self.tree = Tree(LEAF)
        points = augmented(self.vectors, most)
        self.tree.build(points, np.arange(len(ids)))
        self.places = np.array([x for x in self.tree.vantage if x is not None]).reshape(-1, points.shape[1])
        self.rank = np.cumsum([x is not None for x in self.tree.vantage]) - 1

    def nearest(self, own: int, label: int, anchor: np.ndarray, same: bool, windows: list[tuple[int, int]], k: int) -> list[list[tuple[int, int]]]:
        """For each window the k best (score, id) of rows with the same, or another, label; ties by least id."""
        place = Place(anchor.astype(np.float64), self.most)
        gaps = place.gaps(self.places)
        low, found = [w[0] for w in windows], [[] for _ in windows]
        rings = [place.ring(lo, hi) for lo, hi in windows]
        heap = [(0.0, np.inf, 0)]
        while heap:
            near, far, node = heapq.heappop(heap)
            live = [i for i, (inner, outer) in enumerate(rings) if near <= outer and far >= inner]
            if not live:
                if near > max(outer for _, outer in rings):
                    break
                continue
            rows = self.tree.rows[node]
            if rows is None:
                gap = gaps[self.rank[node]]
                for child, (least, most) in zip(self.tree.children[node], self.tree.bounds[node], strict=True):
                    heapq.heappush(heap, (max(near, gap - most, least - gap), min(far, gap + most), child))
                continue
            score = exact_scores(self.vectors[rows], self.largest, anchor)
            right = (self.labels[rows] == label) & (self.ids[rows] != own) if same else self.labels[rows] != label
            for i in live:
                hit = right & (score >= low[i]) & (score <= windows[i][1])
                if hit.any():
                    best = sorted([*found[i], *zip((-score[hit]).tolist(), self.ids[rows[hit]].tolist(), strict=True)])[:k]
                    found[i] = best
                    if len(best) == k:
                        low[i] = max(low[i], -best[-1][0])
                        rings[i] = [rings[i][0], place.ring(low[i], low[i])[1]]
        return [[(-s, x) for s, x in f] for f in found]


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


class Cells:
    """The cutting of space: a small tree, and distances from its vantage points to the rows of each cell."""

    def __init__(self, sample: np.ndarray, most: float, cells: int, dims: int):
        self.most, self.dims = most, dims
        self.tree = Tree(max(1, -(-len(sample) // max(cells, 1))))
        self.tree.build(augmented(sample.astype(np.float64), most), np.arange(len(sample)))
        found = self.tree.leaves()
        self.tree.rows = None
        self.cell = {node: i for i, (node, _) in enumerate(found)}
        self.paths = [path for _, path in found]
        self.depth = max(map(len, self.paths))
        self.low = self.high = self.salts = None

    def assign(self, batches):
        """Rows with their cell and the distances to the vantage points above it."""
        schema = pa.schema([("vec_id", pa.int64()), ("label", pa.int32()), ("v", pa.list_(pa.int64())), ("cell", pa.int32()), ("gaps", pa.list_(pa.float64()))])
        for batch in batches:
            points = augmented(_matrix(batch.column(2), self.dims).astype(np.float64), self.most)
            cell, gaps = np.zeros(len(points), np.int32), np.zeros((len(points), self.depth))
            todo = [(0, 0, np.arange(len(points)))]
            while todo:
                node, level, at = todo.pop()
                if self.tree.children[node] is None:
                    cell[at] = self.cell[node]
                    continue
                gap = np.sqrt(((points[at] - self.tree.vantage[node]) ** 2).sum(axis=1))
                gaps[at, level] = gap
                inner = gap <= self.tree.cut[node]
                todo += [(child, level + 1, at[part]) for child, part in zip(self.tree.children[node], (inner, ~inner), strict=True)]
            flat = pa.ListArray.from_arrays(np.arange(len(points) + 1, dtype=np.int32) * self.depth, pa.array(gaps.ravel()))
            yield batch_of({"vec_id": batch.column(0), "label": batch.column(1), "v": batch.column(2), "cell": cell, "gaps": flat}, schema)

    def measure(self, rows: DataFrame) -> None:
        """One row a cell reaches the driver: its size, and the bounds of its distances."""
        bounds = [f(F.col("gaps")[i]).alias(f"{n}{i}") for i in range(self.depth) for n, f in (("lo", F.min), ("hi", F.max))]
        n = len(self.paths)
        self.low, self.high, self.salts = np.full((n, self.depth), np.inf), np.full((n, self.depth), -np.inf), np.zeros(n, np.int64)
        for r in rows.groupBy("cell").agg(F.count("*").alias("n"), *bounds).collect():
            self.salts[r["cell"]] = -(-r["n"] // SHARD)
            for i in range(len(self.paths[r["cell"]])):
                self.low[r["cell"], i], self.high[r["cell"], i] = r[f"lo{i}"], r[f"hi{i}"]

    def route(self, first: bool):
        """Cells that a request's annulus meets: the most promising one, or all the others."""
        schema = pa.schema([("anchor_id", pa.int64()), ("akey", pa.int64()), ("w", pa.int32()), ("cells", pa.list_(pa.int32()))])
        nodes = sorted({x for path in self.paths for x in path})
        places = np.array([self.tree.vantage[x] for x in nodes]).reshape(len(nodes), self.dims + 1)
        column = {x: i for i, x in enumerate(nodes)}

        def run(batches):
            for batch in batches:
                query = _matrix(batch.column(3), self.dims).astype(np.float64)
                lows, highs = batch.column(4).to_pylist(), batch.column(5).to_pylist()
                seen, out = batch.column(6).to_pylist(), []
                for i, q in enumerate(query):
                    place = Place(q, self.most)
                    gaps = place.gaps(places)
                    inner, outer = place.ring(lows[i], highs[i])
                    met = []
                    for c, path in enumerate(self.paths):
                        if not self.salts[c]:
                            continue
                        gap = gaps[[column[x] for x in path]] if path else np.empty(0)
                        low, high = self.low[c, : len(path)], self.high[c, : len(path)]
                        near = float(np.maximum(gap - high, low - gap).max(initial=0.0))
                        far = float((gap + high).min(initial=np.inf))
                        if near <= outer and far >= inner:
                            met.append((max(near, inner), c))
                    out.append([min(met)[1]] if first and met else [] if first else [c for _, c in met if c not in seen[i]])
                yield batch_of({"anchor_id": batch.column(0), "akey": batch.column(1), "w": batch.column(2), "cells": out}, schema)

        return run


def _visits(most: float, dims: int, same: bool, k: int):
    """Rows sorted by shard, then index rows before requests: the k best of every request."""
    schema = pa.schema([("anchor_id", pa.int64()), ("akey", pa.int64()), ("w", pa.int32()), ("score", pa.int64()), ("vec_id", pa.int64())])

    def run(batches):
        key, parts, shard, asked = None, [], None, []
        out = {name: [] for name in schema.names}

        def answer():
            if asked and shard:
                own, akey, label, anchor = asked[0][:4]
                for (w, *_), best in zip([x[4:] for x in asked], shard.nearest(own, label, anchor, same, [x[5:] for x in asked], k), strict=True):
                    for score, x in best:
                        for name, value in zip(schema.names, (own, akey, w, score, x), strict=True):
                            out[name].append(value)
            asked.clear()

        for batch in batches:
            cells, salts, blocks_, kinds, ids, akeys, labels, ws, lows, highs = (batch.column(i).to_pylist() for i in range(10))
            vectors = _matrix(batch.column(10), dims)
            for i, kind in enumerate(kinds):
                here = (cells[i], salts[i], blocks_[i])
                if here != key:
                    answer()
                    key, parts, shard = here, [], None
                if kind == 0:
                    parts.append((ids[i], labels[i], vectors[i]))
                    continue
                if shard is None and parts:
                    shard = Shard(np.array([p[0] for p in parts]), np.array([p[1] for p in parts]), np.stack([p[2] for p in parts]), most)
                    parts = []
                if asked and asked[0][:2] != (ids[i], akeys[i]):
                    answer()
                asked.append((ids[i], akeys[i], labels[i], vectors[i], ws[i], lows[i], highs[i]))
            if len(out["w"]) > 1 << 14:
                yield batch_of(out, schema)
                out = {name: [] for name in schema.names}
        answer()
        yield batch_of(out, schema)

    return run


def _best(rows: DataFrame, k: int) -> DataFrame:
    return rows.withColumn("place", F.expr("row_number() over (partition by anchor_id, akey, w order by score desc, vec_id)")).where(F.col("place") <= k)


def _visit(placed: DataFrame, cells: Cells, requests: DataFrame, same: bool, k: int, label: str) -> DataFrame:
    """Results of requests (with a column ``cell``) in all shards of their cells."""
    spark = placed.sparkSession
    ddl = "cell int, blocks int"
    sizes = [(r["cell"], -(-r["count"] // REQUESTS)) for r in requests.groupBy("cell").count().collect()]
    blocks_ = F.broadcast(spark.createDataFrame(sizes, ddl))  # a row a cell
    salts = F.broadcast(spark.createDataFrame([(c, int(s)) for c, s in enumerate(cells.salts)], "cell int, salts int"))
    each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    rows = placed.join(blocks_, "cell").join(salts, "cell").select("cell", F.pmod(F.xxhash64("label", "v"), "salts").cast("int").alias("salt"), each(F.col("blocks")).alias("block"), F.lit(0).alias("kind"), F.col("vec_id").alias("id"), F.lit(0).cast("bigint").alias("akey"), "label", F.lit(0).alias("w"), F.lit(0).cast("bigint").alias("lo"), F.lit(0).cast("bigint").alias("hi"), "v")
    asked = requests.join(blocks_, "cell").join(salts, "cell").select("cell", each(F.col("salts")).alias("salt"), F.pmod(F.xxhash64("anchor_id", "akey"), "blocks").cast("int").alias("block"), F.lit(1).alias("kind"), F.col("anchor_id").alias("id"), "akey", "label", "w", "lo", "hi", "v")
    both = rows.unionByName(asked).repartition("cell", "salt", "block").sortWithinPartitions("cell", "salt", "block", "kind", "id", "akey", "w")
    return materialise(both, label, lean(_visits(cells.most, cells.dims, same, k)), "anchor_id bigint, akey bigint, w int, score bigint, vec_id bigint")


def _search(placed: DataFrame, cells: Cells, requests: DataFrame, same: bool, k: int) -> DataFrame:
    """The k best rows of every request (anchor_id, akey, label, v, w, lo, hi): anchor_id, akey, w, score, vec_id, place."""
    name = ["anchor_id", "akey", "w"]
    ddl = "anchor_id bigint, akey bigint, w int, cells array<int>"
    asked = requests.select(*name, "v", "lo", "hi", F.array().cast("array<int>").alias("seen"))
    first = materialise(mapped(asked, cells.route(True), ddl), "first-cells")
    near = _visit(placed, cells, requests.join(first.select(*name, F.explode("cells").alias("cell")), name), same, k, "near")
    floor = near.groupBy(*name).agg(F.count("*").alias("got"), F.max("score").alias("top"), F.min("score").alias("least")).where(F.col("got") >= k)
    raised = requests.join(floor.select(*name, "least"), name, "left").join(first.select(*name, F.col("cells").alias("seen")), name)
    raised = materialise(raised.withColumn("lo", F.greatest("lo", F.coalesce("least", "lo"))).select(*name, "v", "lo", "hi", "seen", "label"), "raised")
    rest = mapped(raised.drop("label"), cells.route(False), ddl).select(*name, F.explode("cells").alias("cell"))
    far = _visit(placed, cells, materialise(raised.join(rest, name), "rest"), same, k, "far")
    drop(first, raised)
    return _best(near.unionByName(far), k)


def prepared(vectors: DataFrame, scale: int, flip: int, labels: int, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """Rows that take part, with whole-number components and moved labels, each once: vec_id, label, v."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda e: F.coalesce(~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < float("inf")), F.lit(False)))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & x.isNotNull() & finite)
    whole = F.transform(x, lambda e: F.when(F.abs(e.cast("double")) * scale < float(1 << 31), F.floor(e.cast("double") * scale)).otherwise(F.raise_error(F.lit("a component passes 32 bits")).cast("bigint")))
    label = F.when(F.col(id_col) % flip == 0, (F.col(label_col) + 1) % labels).otherwise(F.col(label_col))
    return rows.select(F.col(id_col).cast("bigint").alias("vec_id"), label.cast("int").alias("label"), whole.alias("v")).distinct()


def hard_negatives(
    vectors: DataFrame,
    anchor_every: int = 100,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
    flip: int = 7,
    labels: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """Negatives of every anchor and positive: anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = vectors.sparkSession
    rows = materialise(prepared(vectors, scale, flip, labels, id_col, vector_col, label_col), "vectors")
    dims = max(1, rows.agg(F.max(F.size("v"))).first()[0] or 0)
    padded = F.concat("v", F.array_repeat(F.lit(0).cast("bigint"), F.lit(dims) - F.size("v")))
    rows = rows.withColumn("v", padded)
    k = max(positives + 1, negatives)
    few = F.expr("row_number() over (partition by label, v order by vec_id)")
    index = materialise(rows.withColumn("place", few).where(F.col("place") <= k).drop("place"), "indexed")
    norm = F.aggregate("v", F.lit(0.0), lambda a, e: a + e.cast("double") * e.cast("double"))
    n, most = index.agg(F.count("*"), F.max(norm)).first()
    if not n:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    # a hash keeps about twice the sample, of which the least stay
    hashed = F.pmod(F.xxhash64("vec_id", "label", "v"), F.lit(1 << 30))
    sample = index.where(hashed <= (1 << 30) * 2 * SAMPLE // n).orderBy(hashed, "vec_id").limit(SAMPLE).select("v").collect()
    cells = Cells(np.array([r["v"] for r in sample]), most, min(CELLS, -(-n // CELL)), dims)
    placed = materialise(index, "placed", lean(cells.assign), "vec_id bigint, label int, v array<bigint>, cell int, gaps array<double>")
    cells.measure(placed)

    anchors = rows.where(F.col("vec_id") % anchor_every == 0).select(F.col("vec_id").alias("anchor_id"), F.xxhash64("label", "v").alias("akey"), "label", "v")
    anchors = materialise(anchors, "anchors")
    wide = anchors.withColumns({"w": F.lit(0), "lo": F.lit(LOWEST), "hi": F.lit(HIGHEST)})
    liked = materialise(_search(placed, cells, wide, True, positives), "positives")
    score = F.col("score").cast("decimal(38,0)")
    window = {"lo": F.ceil(score * low / 100).cast("bigint"), "hi": F.floor(score * high / 100).cast("bigint")}
    liked = liked.select("anchor_id", "akey", F.col("place").alias("w"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), *[v.alias(c) for c, v in window.items()])
    wanted = materialise(liked.where("lo <= hi").select("anchor_id", "akey", "w", "lo", "hi").join(anchors, ["anchor_id", "akey"]), "windows")
    found = _search(placed, cells, wanted, False, negatives)
    found = found.join(liked.drop("lo", "hi"), ["anchor_id", "akey", "w"])
    return found.select("anchor_id", "positive_id", F.col("place").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
