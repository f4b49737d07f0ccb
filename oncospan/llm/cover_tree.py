"""Hard-negative mining with cover trees over norm-augmented candidates.

1. Vectors become vectors x of whole numbers, floor(scale * c) per entry; scores are exact inner products. Rows with the
   same label and x are one candidate that keeps its smallest ids, as many as an answer can use; a window with a row limit
   thins them before the shuffle.
2. Each candidate gets one more entry, so that all have the same norm. On that sphere an inner product is a cosine, and
   the angle between two candidates bounds how far their products with any anchor differ.
3. Pivots, picked farthest first from a bounded sample, are the top level: every candidate belongs to the cell of its
   nearest pivot, and cells are dealt into blocks of about ``block_rows``. Each block holds a cover tree: a node's
   children are candidates further apart than half its radius, and cover its candidates within that half; each node
   keeps the largest angle to any candidate below it, and the label if they all share one.
4. An anchor visits the cells whose angles allow a wanted product. In a tree it descends best first: a node is skipped
   when its bounds lie outside all windows or below what they already hold, and every candidate reached is scored
   exactly. First the best same-label rows, then for each of their scores the best other-label rows of its window.

The pivots only decide which candidates lie together; every candidate is in a tree and results are exact. Anchors travel
in chunks to tiles of a few blocks, trees are stored as rows and read by each chunk's tile, so a task holds one chunk and
one tree.

Defined results: a row with a null vec_id, label or vector, an empty vector, a null or non-finite entry, or an entry
of 2**20 or more after scaling, or more than 2**16 entries, takes no part. Vectors of different lengths don't meet. Equal rows count once; rows that share
an id but not a vector are separate, and a row with the anchor's id is never its positive. Equal scores go by smaller id.
An anchor without positives, or a positive without rows in its window, gives no rows. Only the four columns named in
``mine`` are read.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oncospan.llm.common import Scratch, map_arrow, small_batches, stream_groups

LARGEST = 1 << 20  # of an entry after scaling; 100 times a product of two vectors then fits a long
LONGEST = 1 << 16
EXACT_DOUBLE = 2 ** 53
LEAF = 32
SLACK = 1e-7  # radians; rounding of angles between vectors that point the same way
BLOCKS_PER_TILE = 8
CHUNK_ANCHORS = 1 << 15


def augment(x: np.ndarray, norm: float) -> np.ndarray:
    """Unit vectors: x and the entry that brings it to ``norm``, over ``norm``."""
    z = np.empty((len(x), x.shape[1] + 1))
    z[:, :-1] = x
    z[:, -1] = np.sqrt(np.maximum(0.0, norm * norm - np.einsum("ij,ij->i", z[:, :-1], z[:, :-1])))
    return z / norm


def angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


class CoverTree:
    """Nodes in arrays. The children of a node lie together, its own centre first; a candidate alone has radius 0."""

    def __init__(self, x: np.ndarray, labels: np.ndarray, ids: list[list[int]], norm: float):
        self.x, self.labels, self.ids, self.norm = x, labels, ids, norm
        self.rows = np.array([len(i) for i in ids])
        self.size = int(np.abs(x).max(initial=1))
        self.exact = x.astype(np.float64)
        z = augment(self.exact, norm)
        near = int(np.argmax(z @ z.mean(0)))
        centre, radius, first, count, only = [near], [0.0], [0], [0], [None]
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, members = todo.pop()
            c = centre[node]
            away = angles(z[members] @ z[c])
            away[members == c] = 0.0
            radius[node] = float(away.max())
            own = set(labels[members].tolist()) if len(members) < 4 * LEAF else set(np.unique(labels[members]).tolist())
            only[node] = own.pop() if len(own) == 1 else None
            if len(members) == 1:
                radius[node] = 0.0
                continue
            first[node] = len(centre)
            for child, part in self._split(z, c, members, away, radius[node]):
                if len(part) > 1:
                    todo.append((len(centre), part))
                centre.append(child)
                radius.append(0.0)
                first.append(0)
                count.append(0)
                only.append(labels[child])
            count[node] = len(centre) - first[node]
        self.centre, self.radius = np.array(centre), np.array(radius)
        self.first, self.count, self.only = np.array(first), np.array(count), np.array(only, object)

    @staticmethod
    def _split(z, c: int, members: np.ndarray, away: np.ndarray, radius: float) -> Iterator[tuple[int, np.ndarray]]:
        """Children's centres with the members they cover; the node's own centre comes first."""
        if len(members) <= LEAF or radius <= SLACK:
            yield c, np.array([c])
            yield from ((int(m), np.array([m])) for m in members if m != c)
            return
        half = radius / 2
        near = away <= half
        yield c, members[near]
        rest, far = members[~near], away[~near]
        while len(rest):
            child = int(rest[np.argmax(far)])
            off = angles(z[rest] @ z[child])
            off[rest == child] = 0.0
            near = off <= half
            yield child, rest[near]
            rest, far = rest[~near], np.minimum(far, off)[~near]

    def scores(self, at: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Exact inner products of candidates with an anchor."""
        if self.size * int(np.abs(q).max(initial=0)) * len(q) < EXACT_DOUBLE:
            return (self.exact[at] @ q.astype(np.float64)).astype(np.int64)
        return self.x[at] @ q

    def best(self, q: np.ndarray, label, same: bool, windows: list[tuple[int, int]], k: int) -> list[list[tuple[int, int]]]:
        """For each window (least, most) the first k of (score, id), by falling score, then rising id."""
        length = float(np.sqrt(q.astype(np.float64) @ q))
        scale = length * self.norm
        low, high = np.array([w[0] for w in windows]), np.array([w[1] for w in windows])
        held = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in windows]

        def take(at: np.ndarray, s: np.ndarray) -> None:
            wanted = (self.labels[at] == label) == same
            at, s = at[wanted], s[wanted]
            if not len(s) or s.max() < low.min():
                return
            for w, (rows, scores) in enumerate(held):
                fit = (s >= low[w]) & (s <= high[w])
                if not fit.any():
                    continue
                rows, scores = np.r_[rows, at[fit]], np.r_[scores, s[fit]]
                order = np.argsort(-scores, kind="stable")
                rows, scores = rows[order], scores[order]
                enough = np.searchsorted(np.cumsum(self.rows[rows]), k)
                if enough < len(rows):  # ties with the k-th stay until the end
                    low[w] = scores[enough]
                    stay = scores >= low[w]
                    rows, scores = rows[stay], scores[stay]
                held[w] = rows, scores

        def bounds(nodes: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            if not scale:
                return np.zeros(len(nodes)), np.zeros(len(nodes))
            off, radius = angles(s / scale), self.radius[nodes] + SLACK
            upper = scale * np.cos(np.maximum(0.0, off - radius))
            return upper + 1, scale * np.cos(np.minimum(np.pi, off + radius)) - 1

        agenda: list[tuple[float, int, float]] = []

        def offer(nodes: np.ndarray, s: np.ndarray) -> None:
            inner = self.count[nodes] > 0
            nodes, s = nodes[inner], s[inner]
            if not len(nodes):
                return
            only = self.only[nodes]
            able = np.array([o is None or (o == label) == same for o in only])
            upper, lower = bounds(nodes, s)
            able &= ((upper[:, None] >= low) & (lower[:, None] <= high)).any(1)
            for node, u, v in zip(nodes[able].tolist(), upper[able].tolist(), lower[able].tolist(), strict=True):
                heapq.heappush(agenda, (-u, node, v))

        root = np.array([0])
        s = self.scores(self.centre[root], q)
        take(self.centre[root], s)
        offer(root, s)
        while agenda:
            upper, node, lower = heapq.heappop(agenda)
            if -upper < low.min():
                break
            if not ((-upper >= low) & (lower <= high)).any():
                continue
            nodes = np.arange(self.first[node], self.first[node] + self.count[node])
            s = self.scores(self.centre[nodes], q)
            take(self.centre[nodes[1:]], s[1:])  # the first is the node's own centre, scored above it
            offer(nodes, s)
        out = []
        for rows, scores in held:
            found = [(int(v), i) for r, v in zip(rows.tolist(), scores.tolist(), strict=True) for i in self.ids[r]]
            out.append(sorted(found, key=lambda f: (-f[0], f[1]))[:k])
        return out


# ------------------------------------------------------------ candidates, cells, trees

def whole_rows(vectors: DataFrame, scale: float, vec_id: str, label: str, vector: str, anchor: Column) -> DataFrame:
    """(vec_id, label, x, length, is_anchor) of the rows that take part."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"),
                          F.col(vector).cast("array<double>").alias("v"),
                          F.coalesce(anchor, F.lit(False)).alias("is_anchor"))
    rows = rows.filter("vec_id is not null and label is not null and size(v) > 0").filter(F.size("v") <= LONGEST).filter(F.forall(
        "v", lambda c: c.isNotNull() & (F.abs(c) * abs(float(scale)) < LARGEST)))  # NaN compares as the largest number
    return rows.select("vec_id", "label", F.transform("v", lambda c: F.floor(F.lit(float(scale)) * c)).alias("x"),
                       F.size("v").alias("length"), "is_anchor")


def _candidates(rows: DataFrame, keep: int) -> DataFrame:
    """(length, label, x, ids): the ``keep`` smallest ids of each label and x."""
    by = Window.partitionBy("length", "label", "x").orderBy("vec_id")
    first = rows.withColumn("_place", F.dense_rank().over(by)).filter(F.col("_place") <= keep)
    return first.groupBy("length", "label", "x").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))


def _vectors(column) -> np.ndarray:
    if isinstance(column, pa.Array):
        return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    return np.stack(column)


class Cells:
    """Pivots of one vector length, on the sphere of ``norm``."""

    def __init__(self, pivots: np.ndarray, norm: float):
        self.pivots, self.norm = pivots, norm

    @classmethod
    def choose(cls, x: np.ndarray, norm: float, count: int) -> Cells:
        """Farthest first: each pivot is the sample row furthest from those before it."""
        z = augment(x, norm)
        near = z @ z[0]
        picked = [0]
        while len(picked) < min(count, len(z)):
            at = int(np.argmin(near))
            if near[at] >= 1 - 1e-12:
                break
            picked.append(at)
            near = np.maximum(near, z @ z[at])
        return cls(z[picked], norm)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cosines = augment(x.astype(np.float64), self.norm) @ self.pivots.T
        cell = cosines.argmax(1)
        return cell, angles(cosines[np.arange(len(x)), cell])


def _lengths(c: dict) -> list[tuple[int, np.ndarray]]:
    lengths = c["length"].to_numpy()
    return [(size, np.flatnonzero(lengths == size)) for size in np.unique(lengths).tolist()]


def _choose_cells(candidates: DataFrame, block_rows: int, max_cells: int, sample_rows: int) -> dict[int, Cells]:
    """Cells per vector length, from about ``sample_rows`` candidates."""
    square = F.aggregate("x", F.lit(0).cast("double"), lambda a, v: a + v.cast("double") * v)
    facts = {r.length: r for r in candidates.groupBy("length").agg(
        F.count("*").alias("n"), F.max(square).alias("square")).collect()}  # one row per vector length
    total = sum(r.n for r in facts.values())
    share = int(min(1.0, sample_rows / max(1, total)) * (1 << 30))
    sample: dict[int, list] = {}
    for row in candidates.filter(F.pmod(F.xxhash64("x", "label"), F.lit(1 << 30)) < share).select("length", "x").collect():
        sample.setdefault(row.length, []).append(row.x)
    cells = {}
    for size, r in facts.items():
        norm = float(np.sqrt(r.square)) * (1 + 1e-9) or 1.0
        rows = np.array(sorted(sample.get(size, [[0] * size])), np.float64)
        cells[size] = Cells.choose(rows, norm, min(max_cells, -(-r.n // block_rows)))
    return cells


def build_index(candidates: DataFrame, scratch: Scratch, block_rows: int, max_cells: int,
                sample_rows: int) -> tuple[DataFrame, dict[int, Cells], dict[tuple[int, int], tuple[int, float]]]:
    """Trees (length, cell, salt, tree), the cells, and per (length, cell) its number of blocks and largest angle."""
    cells = _choose_cells(candidates, block_rows, max_cells, sample_rows)

    def make() -> Callable[[dict], dict]:
        def step(c: dict) -> dict:
            cell, away = np.zeros(len(c["length"]), np.int32), np.zeros(len(c["length"]))
            for size, at in _lengths(c):
                cell[at], away[at] = cells[size].nearest(_vectors(c["x"].take(pa.array(at))))
            return {**c, "cell": cell, "away": away}

        return step

    placed = scratch.write(map_arrow(candidates.select("length", "label", "x", "ids"), make,
                                     "length int, label string, x array<long>, ids array<long>, cell int, away double"),
                           "placed")
    sizes = placed.groupBy("length", "cell").agg(F.count("*").alias("n"), F.max("away").alias("away")).collect()
    directory = {(r.length, r.cell): (-(-r.n // block_rows), r.away) for r in sizes}  # at most max_cells per length
    facts = placed.sparkSession.createDataFrame([(*k, v[0]) for k, v in directory.items()],
                                                "length int, cell int, blocks long")
    salted = placed.join(F.broadcast(facts), ["length", "cell"]).select(
        "length", "cell", F.pmod(F.xxhash64("x", "label", F.lit("block")), F.col("blocks")).cast("int").alias("salt"),
        "label", "x", "ids")
    norms = {size: c.norm for size, c in cells.items()}

    def grow() -> Callable[[dict], dict]:
        def step(c: dict) -> dict:
            keys = np.stack([c["length"], c["cell"], c["salt"]], 1)
            starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1)])
            out: dict[str, list] = {"length": [], "cell": [], "salt": [], "tree": []}
            for lo, hi in zip(starts, [*starts[1:], len(keys)], strict=True):
                tree = CoverTree(np.stack(c["x"][lo:hi]).astype(np.int64), c["label"][lo:hi],
                                 [i.tolist() for i in c["ids"][lo:hi]], norms[int(c["length"][lo])])
                for name, value in zip(("length", "cell", "salt"), keys[lo].tolist(), strict=True):
                    out[name].append(value)
                out["tree"].append(pickle.dumps(tree, protocol=5))
            return out

        return step

    trees = stream_groups(salted, ["length", "cell", "salt"], grow, "length int, cell int, salt int, tree binary")
    return scratch.write(trees, "trees"), cells, directory


# ------------------------------------------------------------ search

def search(anchors: DataFrame, trees: DataFrame, cells: dict[int, Cells],
           directory: dict[tuple[int, int], tuple[int, float]], same: bool, k: int, chunks: int) -> DataFrame:
    """(k1, k2, mark, score, vec_id): per tree the first k rows of each anchor's windows.

    ``anchors``: k1, k2, label, x, length, and the arrays least, most and mark (its name) with one entry per window.
    """
    spark = anchors.sparkSession
    schema = ("length int, cell int, part int, chunk int, kind int, tree binary, k1 long, k2 long, label string, "
              "x array<long>, least array<long>, most array<long>, mark array<long>")

    def make() -> Callable[[dict], dict]:
        def step(c: dict) -> dict:
            take, cell, part = [], [], []
            least, most = c["least"].to_pylist(), c["most"].to_pylist()
            for size, at in _lengths(c):
                q = _vectors(c["x"].take(pa.array(at))).astype(np.float64)
                length = np.sqrt(np.einsum("ij,ij->i", q, q))
                sphere = cells[size]
                scale = np.maximum(length * sphere.norm, 1e-300)
                off = angles(q @ sphere.pivots[:, :-1].T * sphere.norm / scale[:, None])
                for j in range(len(sphere.pivots)):
                    blocks, away = directory.get((size, j), (0, 0.0))
                    if not blocks:
                        continue
                    upper = scale * np.cos(np.maximum(0.0, off[:, j] - away - SLACK)) + 1
                    lower = scale * np.cos(np.minimum(np.pi, off[:, j] + away + SLACK)) - 1
                    for i, u, v in zip(at.tolist(), upper.tolist(), lower.tolist(), strict=True):
                        if any(u >= a and v <= b for a, b in zip(least[i], most[i], strict=True)):
                            for p in range(-(-blocks // BLOCKS_PER_TILE)):
                                take.append(i)
                                cell.append(j)
                                part.append(p)
            rows = pa.array(take, pa.int64())
            n = len(take)
            picked = {name: c[name].take(rows) for name in ("length", "chunk", "k1", "k2", "label", "x", "least", "most", "mark")}
            return {**picked, "cell": cell, "part": part, "kind": np.zeros(n, np.int32), "tree": [None] * n}

        return step

    chunk = F.pmod("k1", F.lit(chunks)).cast("int")
    sent = map_arrow(anchors.select("k1", "k2", "label", "x", "length", "least", "most", "mark",
                                    chunk.alias("chunk")), make, schema)
    null = [F.lit(None).cast(t).alias(n) for n, t in (("k1", "long"), ("k2", "long"), ("label", "string"),
                                                     ("x", "array<long>"), ("least", "array<long>"), ("most", "array<long>"),
                                                     ("mark", "array<long>"))]
    stored = trees.select("length", "cell", F.floor(F.col("salt") / BLOCKS_PER_TILE).cast("int").alias("part"),
                          F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"),
                          F.lit(1).alias("kind"), "tree", *null)
    keys = ["length", "cell", "part", "chunk"]
    out = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("mark", pa.int64()), ("score", pa.int64()),
                     ("vec_id", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                key = tuple(row[n] for n in keys)
                if key != tile:
                    tile, held = key, []
                if row["kind"] == 0:
                    held.append((row["k1"], row["k2"], row["label"], np.array(row["x"], np.int64),
                                 list(zip(row["least"], row["most"], strict=True)), row["mark"]))
                elif held:
                    tree = pickle.loads(row["tree"])
                    found = [(k1, k2, mark, score, vec_id) for k1, k2, label, q, windows, marks in held
                             for mark, rows in zip(marks, tree.best(q, label, same, windows, k), strict=True)
                             for score, vec_id in rows]
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*found, strict=True)],
                                                         schema=out)

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")  # trees are rows of a megabyte or so
    tiles = sent.unionByName(stored).repartition(*keys).sortWithinPartitions(*keys, "kind")
    return tiles.mapInArrow(run, "k1 long, k2 long, mark long, score long, vec_id long")


def _first(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def mine(vectors: DataFrame, scratch: Scratch, anchor: Column, scale: float = 256, positives: int = 5,
         negatives: int = 5, least: int = 80, most: int = 100, block_rows: int = 4096, max_cells: int = 256,
         sample_rows: int = 20_000, vec_id: str = "vec_id", label: str = "label",
         vector: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchor`` says which rows are anchors. Negatives of a positive score p have scores between ``least`` and ``most``
    hundredths of p. The pivots are chosen from about ``sample_rows`` candidates.
    """
    small_batches(vectors.sparkSession, 2000)
    rows = whole_rows(vectors, scale, vec_id, label, vector, anchor)
    keep = max(positives + 1, negatives)
    candidates = scratch.write(_candidates(rows, keep), "candidates")
    trees, cells, directory = build_index(candidates, scratch, block_rows, max_cells, sample_rows)
    # 128 bits name an anchor's label and vector; anchors that share both are searched once
    named = rows.filter("is_anchor").select("vec_id", "label", "x", "length", F.xxhash64("label", "x").alias("k1"),
                                            F.xxhash64("x", F.lit(1), "label").alias("k2")).distinct()
    named = scratch.write(named, "anchors")
    asked = scratch.write(named.groupBy("k1", "k2").agg(F.min(F.struct("label", "x", "length")).alias("a")).select(
        "k1", "k2", "a.*"), "asked")
    chunks = -(-asked.count() // CHUNK_ANCHORS) or 1
    all_of_them = [F.array(F.lit(v).cast("long")).alias(n) for n, v in (("least", -2 ** 62), ("most", 2 ** 62), ("mark", 0))]
    near = search(asked.select("*", *all_of_them), trees, cells, directory, True, positives + 1, chunks)
    near = scratch.write(_first(near, ["k1", "k2"], positives + 1).select(
        "k1", "k2", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), "place"), "positives")
    # whole numbers s with least * p <= 100 * s <= most * p
    low, high = f"positive_score * {least}", f"positive_score * {most}"
    window = F.struct(F.col("positive_score").alias("mark"), F.expr(f"({low} + pmod(-{low}, 100)) div 100").alias("least"),
                      F.expr(f"({high} - pmod({high}, 100)) div 100").alias("most"))
    windows = near.select("k1", "k2", window.alias("w")).filter("w.least <= w.most").groupBy("k1", "k2").agg(
        F.sort_array(F.collect_set("w")).alias("w"))  # at most one per positive
    windows = windows.select("k1", "k2", *(F.col(f"w.{n}").alias(n) for n in ("least", "most", "mark")))
    far = search(asked.join(windows, ["k1", "k2"]), trees, cells, directory, False, negatives, chunks)
    far = _first(far, ["k1", "k2", "mark"], negatives).select(
        "k1", "k2", F.col("mark").alias("positive_score"), F.col("place").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        F.col("score").alias("negative_score"))
    far = scratch.write(far, "negatives")
    own = named.select("k1", "k2", F.col("vec_id").alias("anchor_id")).join(near, ["k1", "k2"]).filter(
        "anchor_id <> positive_id")
    turn = Window.partitionBy("anchor_id", "k1", "k2").orderBy("place")
    own = own.withColumn("turn", F.row_number().over(turn)).filter(F.col("turn") <= positives)
    return own.join(far, ["k1", "k2", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id",
                                                                "positive_score", "negative_score")
