"""Embedding near-dedup by iterative quantisation and multi-index Hamming tables.

1. Equal vectors of one label form a class; only classes go on, so copies cost nothing further.
2. Rotations of the principal axes are learned on a bounded sample so that signs of the rotated vector lose as little as
   possible and halve the data; they start from different random rotations. Each gives every vector a 64-bit code of
   signs.
3. Each code is cut into four words of 16 bits, one hash table each. A class is filed under its own word and looked up
   under its word with each set bit cleared, so two codes that differ in at most one bit of some word meet exactly once
   in that table; any two codes within 7 bits do (four words, so one of them differs in at most one bit).
4. Buckets first compare codes: pairs further apart than ``radius`` bits, and pairs that an earlier table has met, end
   there. What is left is reranked with the original vectors by cosine in double precision.

Pairs inside a bucket are compared in blocks and reported as counts per class and as a spanning set of links, never as
all pairs. The index holds every vector; only the rotations depend on the sample. Pairs that differ in more than 7 bits of
every code may be missed: with ``rotations`` = 2 about one in a hundred of those with a cosine of 0.93 to 0.932, and none
that was measured from 0.97 on (tests/llm/test_embeddings.py). ``exact=True`` compares all classes of a label in blocks
instead, which takes time with the square of their number.

Defined results: a vector that is null, empty, zero, or holds a null or non-finite component, or has no label or no id,
links with nothing. Vectors of different lengths do not link. Rows that share a vec_id and a vector are one vector.
Only ``vec_id``, ``embedding`` and ``label`` are read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oncospan.llm.common import Scratch, block_tiles, borders, components, map_arrow, small_batches, stream_groups

WORDS, WORD_BITS = 4, 16
SMALL_BUCKET = 256
BLOCK_ROWS = 512


class Rotation:
    """Signs of 64 learned directions for vectors of one length."""

    def __init__(self, mean: np.ndarray, axes: np.ndarray):
        self.mean, self.axes = mean, axes

    @classmethod
    def learn(cls, x: np.ndarray, bits: int = WORDS * WORD_BITS, rounds: int = 50, seed: int = 0) -> Rotation:
        """Alternate between the signs of the rotated data and the rotation that fits them best."""
        rng = np.random.default_rng(seed)
        mean = x.mean(0)
        centred = x - mean
        _, _, principal = np.linalg.svd(centred.T @ centred)
        axes = principal[:bits].T
        if axes.shape[1] < bits:  # short vectors: more directions than axes
            axes = axes @ rng.normal(size=(axes.shape[1], bits)) / np.sqrt(bits)
        low = centred @ axes
        rotation = np.linalg.qr(rng.normal(size=(bits, bits)))[0]
        for _ in range(rounds):
            signs = np.sign(low @ rotation)
            left, _, right = np.linalg.svd(low.T @ signs)
            rotation = left @ right
        return cls(mean, axes @ rotation)

    def codes(self, x: np.ndarray) -> np.ndarray:
        bits = (x - self.mean) @ self.axes > 0
        return np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0]


def _unit(data: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(data), np.float64).reshape(len(data), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _usable(vector: list | None) -> bytes | None:
    """The vector in double precision, or None when it links with nothing."""
    if not vector or None in vector:
        return None
    x = np.array(vector, np.float64) + 0.0  # no negative zeros
    return x.tobytes() if np.isfinite(x).all() and x.any() else None


def word_distance(x: np.ndarray, word) -> np.ndarray:
    return np.bitwise_count((x >> np.uint64(WORD_BITS) * np.asarray(word, np.uint64)) & np.uint64((1 << WORD_BITS) - 1))


def first_met(x: list[np.ndarray], word, radius: int) -> np.ndarray:
    """x: differing bits of two vectors that meet in table ``word``, per code. True where no earlier table met them."""
    word = np.asarray(word)
    ok = np.zeros(np.broadcast_shapes(x[0].shape, word.shape), bool)
    before = np.zeros_like(ok)
    for code, bits in enumerate(x):
        near = np.bitwise_count(bits) <= radius
        for k in range(WORDS):
            met = near & (word_distance(bits, k) <= 1)
            ok |= (word == code * WORDS + k) & met & ~before
            before |= met
    return ok


def codes_of(column) -> list[np.ndarray]:
    """Rows of codes as one array per code."""
    return list(np.stack(column).view(np.uint64).T) if len(column) else []


def near_duplicates(vectors: DataFrame, scratch: Scratch, cosine: float = 0.93, radius: int = 18,
                    sample_rows: int = 20_000, rotations: int = 2, exact: bool = False) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row. ``sample_rows``: about as many vectors teach the rotations."""
    spark = vectors.sparkSession
    small_batches(spark, 4000)
    rows = scratch.write(_vectors(vectors), "vectors")
    usable = rows.filter("vec_id is not null and label is not null and class_id is not null")
    classes = scratch.write(usable.groupBy("label", "class_id", "check").agg(
        F.min("vec_id").alias("rep"), F.countDistinct("vec_id").alias("copies")), "classes")
    firsts = (rows.select("vec_id", "label", "class_id", "check", "vector")
              .join(classes.withColumnRenamed("rep", "vec_id"), ["label", "class_id", "check", "vec_id"])
              .dropDuplicates(["label", "class_id", "check"]))
    learned = _learn(firsts, classes.count(), sample_rows, rotations)
    coded = scratch.write(_coded(firsts.select("label", F.col("vec_id").alias("rep"), "copies", "vector"), learned,
                                 rotations), "coded")
    candidates = _all_of_label(coded) if exact else _candidates(coded, radius, scratch, rotations)
    found = scratch.write(_linked(candidates, coded, cosine, radius, exact), "found")
    named = components(found.filter("root is not null").select(F.col("rep").alias("a"), F.col("root").alias("b")),
                       scratch).withColumnRenamed("node", "rep")
    counts = found.groupBy("label", "rep").agg(F.sum("links").alias("links"))
    of_class = (classes.join(counts, ["label", "rep"], "left").join(named, "rep", "left")
                .filter("copies > 1 or links is not null")
                .select("label", "class_id", "check",
                        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                        F.coalesce("component", "rep").alias("component")))
    out = rows.join(of_class, ["label", "class_id", "check"], "left")
    known = F.col("vec_id").isNotNull()
    component = F.when(known, F.coalesce("component", "vec_id"))
    return out.select("vec_id", F.when(known, F.coalesce("n_links", F.lit(0))).otherwise(0).alias("n_links"),
                      component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))


def _vectors(vectors: DataFrame) -> DataFrame:
    def make() -> Callable[[dict], dict]:
        def step(c: dict) -> dict:
            data = [_usable(v) for v in c["embedding"].to_pylist()]
            ones = [d and int(np.uint64(xxhash.xxh3_64_intdigest(d)).view(np.int64)) for d in data]
            twos = [d and int(np.uint64(xxhash.xxh64_intdigest(d, 1)).view(np.int64)) for d in data]
            return {"vec_id": c["vec_id"], "label": c["label"], "class_id": ones, "check": twos, "vector": data}

        return step

    return map_arrow(vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                                    F.col("label").cast("string").alias("label"),
                                    F.col("embedding").cast("array<double>").alias("embedding")), make,
                     "vec_id long, label string, class_id long, check long, vector binary")


def _learn(firsts: DataFrame, n: int, sample_rows: int, rotations: int) -> dict[int, list[Rotation]]:
    """Rotations per vector length of a hash sample; a length that it lacks gets random directions."""
    share = int(min(1.0, sample_rows / max(1, n)) * (1 << 30))
    chosen = firsts.filter(F.pmod(F.xxhash64("class_id", "label"), F.lit(1 << 30)) < share).select("vector").collect()
    by_length: dict[int, list[bytes]] = {}
    for row in sorted(chosen):
        by_length.setdefault(len(row.vector) // 8, []).append(row.vector)
    return {size: [Rotation.learn(_spread(_unit(data)), seed=seed) for seed in range(rotations)]
            for size, data in by_length.items()}


def _spread(x: np.ndarray) -> np.ndarray:
    """One vector of each cell that 16 random planes cut, so that a large group of near copies does not draw the axes
    to the differences among its own members."""
    planes = np.random.default_rng(0).normal(size=(x.shape[1], 16))
    return x[np.unique(np.packbits(x @ planes > 0, axis=1), axis=0, return_index=True)[1]]


def _coded(classes: DataFrame, rotations: dict[int, list[Rotation]], n_codes: int) -> DataFrame:
    def make() -> Callable[[dict], dict]:
        known = dict(rotations)

        def step(c: dict) -> dict:
            data = c["vector"].to_pylist()
            lengths = np.fromiter((len(d) // 8 for d in data), np.int64, len(data))
            codes = np.zeros((len(data), n_codes), np.uint64)
            for size in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == size)
                if size not in known:
                    known[size] = [Rotation(np.zeros(size), np.random.default_rng([size, i]).normal(
                        size=(size, WORDS * WORD_BITS))) for i in range(n_codes)]
                x = _unit([data[i] for i in at])
                codes[at] = np.stack([rotation.codes(x) for rotation in known[size]], axis=1)
            return {**c, "length": lengths, "codes": codes.view(np.int64).tolist()}

        return step

    return map_arrow(classes, make,
                     "label string, rep long, copies long, vector binary, length long, codes array<long>")


def _all_of_label(coded: DataFrame) -> DataFrame:
    """All classes of a label and length as one bucket."""
    return coded.select("label", "length", F.lit(0).alias("word"), F.lit(0).cast("long").alias("bucket"),
                        F.lit(True).alias("filed"), "rep", "codes")


def _candidates(coded: DataFrame, radius: int, scratch: Scratch, n_codes: int) -> DataFrame:
    """(label, length, word, bucket, filed, rep, codes): rows that have a partner in their bucket, by their codes."""
    bits = F.expr(f"shiftright(codes[cast(word div {WORDS} as int)], (word % {WORDS}) * {WORD_BITS}) & {(1 << WORD_BITS) - 1}")
    filed = (coded.select("label", "length", "rep", "codes")
             .withColumn("word", F.explode(F.sequence(F.lit(0), F.lit(n_codes * WORDS - 1)))).withColumn("bits", bits))
    looked_up = filed.withColumn("cleared", F.explode(F.sequence(F.lit(0), F.lit(WORD_BITS - 1)))).filter(
        "shiftright(bits, cleared) & 1 = 1").withColumn("bucket", F.expr("bits - shiftleft(1L, cleared)"))
    keys = ["label", "length", "word", "bucket"]
    entries = (filed.select("label", "length", "word", F.col("bits").alias("bucket"), F.lit(True).alias("filed"), "rep", "codes")
               .unionByName(looked_up.select(*keys, F.lit(False).alias("filed"), "rep", "codes")))
    sizes = entries.groupBy(*keys).agg(F.count("*").alias("size"), F.count_if("filed").alias("n_filed"))
    live = scratch.write(entries.join(sizes.filter("size > 1 and n_filed > 0"), keys).drop("n_filed"), "buckets")

    def make() -> Callable[[dict], dict]:
        def step(c: dict) -> dict:
            n = len(c["rep"])
            group = np.cumsum(np.isin(np.arange(n), borders(c, keys)))
            codes, filed_, met = codes_of(c["codes"]), c["filed"].astype(bool), np.zeros(n, bool)
            for d in range(1, min(n, SMALL_BUCKET)):
                a = np.flatnonzero((group[:-d] == group[d:]) & (filed_[:-d] | filed_[d:]))
                if not len(a):
                    if not (group[:-d] == group[d:]).any():
                        break
                    continue
                a = a[first_met([x[a] ^ x[a + d] for x in codes], c["word"][a], radius)]
                met[a] = met[a + d] = True
            return {k: c[k][met] for k in (*keys, "filed", "rep", "codes")}

        return step

    schema = "label string, length long, word int, bucket long, filed boolean, rep long, codes array<long>"
    small = stream_groups(live.filter(F.col("size") <= SMALL_BUCKET).drop("size"), keys, make, schema)
    large = live.filter(F.col("size") > SMALL_BUCKET).drop("size")  # to be compared in blocks
    return scratch.write(small.unionByName(large), "candidates")


def _linked(candidates: DataFrame, coded: DataFrame, cosine: float, radius: int, exact: bool) -> DataFrame:
    """(label, rep, links, root) per class and tile: vectors linked there, and a class of its component there."""
    keys = ["label", "length", "word", "bucket"]
    tiled = block_tiles(candidates, keys, "rep", BLOCK_ROWS)
    full = tiled.join(coded.select("label", "rep", "copies", "vector"), ["label", "rep"])

    def make() -> Callable[[dict], dict]:
        def step(c: dict) -> dict:
            out: dict[str, list] = {"label": [], "rep": [], "links": [], "root": []}
            heads = borders(c, [*keys, "_i", "_j"])
            for lo, hi in zip(heads, [*heads[1:], len(c["rep"])], strict=True):
                side, same = c["_side"][lo:hi], c["_i"][lo] == c["_j"][lo]
                a = lo + np.flatnonzero(side == c["_i"][lo])
                b = a if same else lo + np.flatnonzero(side == c["_j"][lo])
                if not len(a) or not len(b):
                    continue
                link = _unit(list(c["vector"][a])) @ _unit(list(c["vector"][b])).T >= cosine
                if not exact:
                    filed = c["filed"].astype(bool)
                    one, two = codes_of(c["codes"][a]), codes_of(c["codes"][b])
                    link &= first_met([x[:, None] ^ y for x, y in zip(one, two, strict=True)], c["word"][lo], radius)
                    link &= filed[a][:, None] | filed[b]
                if same:
                    np.fill_diagonal(link, False)
                link &= c["rep"][a][:, None] != c["rep"][b]
                copies = c["copies"].astype(np.int64)
                reps, counts = c["rep"][a], link @ copies[b]
                if not same:
                    reps, counts = np.concatenate([reps, c["rep"][b]]), np.concatenate([counts, link.T @ copies[a]])
                root = _roots(link, len(a), same)
                keep = counts > 0
                out["label"] += [c["label"][lo]] * int(keep.sum())
                out["rep"] += reps[keep].tolist()
                out["links"] += counts[keep].tolist()
                out["root"] += reps[root][keep].tolist()
            return out

        return step

    return stream_groups(full, [*keys, "_i", "_j"], make, "label string, rep long, links long, root long")


def _roots(link: np.ndarray, n_a: int, same: bool) -> np.ndarray:
    """A row of each row's component in this tile; rows are those of a, then those of b unless they are the same."""
    n = n_a if same else n_a + link.shape[1]
    root = np.arange(n)
    one, two = np.nonzero(link)
    two = two if same else two + n_a
    while True:
        low = np.minimum(root[one], root[two])
        new = root.copy()
        np.minimum.at(new, root[one], low)
        np.minimum.at(new, root[two], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new
