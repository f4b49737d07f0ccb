"""N-gram Jaccard join: size-banded tiles, hashed bitmaps, exact intersection.

Documents are sets of word shingles, held as sorted arrays of 64-bit hashes; equal sets form one class, so copies cost
one row each. All pairs of classes with Jaccard >= num / den are found:

1. *Size bands.* Band limits grow by the threshold, so linked sets lie in one band or in neighbours. Tile i holds band i
   and the band below.
2. *Tiles.* Two linked sets of tile i differ in at most D shingles. Every set deals its shingles by hash into K > D parts
   and writes one signature per part: linked sets agree in at least K - D whole parts. K is chosen so that a set has
   fewer empty parts than that; one that has more also writes its empty parts. Rows meet by signature, in one sorted
   shuffle that is read as a stream; signatures of a single class, almost all, end there.
3. *Hubs.* In every tile each class is first compared with the class that appears in most tiles. The links so found
   connect nearly all of a group of near copies, with as many pairs as members. Tiles whose classes are still in
   several components take further rounds with another hub each, the class that a hash puts first: a class that is not
   yet in the hub's component meets it. Tiles share their hubs, so a round has few pairs per class.
4. *Blocks.* Tiles that are open after that are split into blocks of bounded size, and pairs of blocks are compared in
   full: sizes, then bitmaps, whose differing bits bound the overlap from above. A bitmap has at least four bits per
   shingle, so that most shingles which one set lacks show as a bit. Pairs inside one component need no comparison, as
   they can't change a component.
5. Pairs that pass both bounds meet the shingle arrays and are decided by exact intersection.

Links that join classes already connected may go unlisted; every pair that decides a component is compared, so
components are exact. Defined results: null or blank text has the empty set and links with nothing; fewer than
``words`` words form one shingle; rows with one doc_id are one document; rows without doc_id link with nothing and have
no component. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oncospan.llm.common import Scratch, block_tiles, borders, components, map_arrow, small_batches, stream_groups

BITS_PER_SHINGLE = 4
LEAST_BITS = 256
HUB_ROUNDS = 2  # with hubs drawn by a hash, after the first
BLOCK_ROWS = 512
BROADCAST_IDS = 500_000  # ids of 8 bytes: at most this many are sent to every executor, more are shuffled
BROADCAST_PAIRS = 200_000  # two ids each
CACHE_WORDS = 200_000
_P = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Word to 64-bit hash, for the words met lately."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: str | None, words: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes. ``bytes.lower`` changes A-Z alone; ``bytes.split`` cuts at [\\x20\\x09-\\x0D]."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(known.__getitem__, parts), np.uint64, len(parts))
    width = min(words, len(hashes))
    total = np.full(len(hashes) - width + 1, width, np.uint64)
    for i in range(width):
        total = mix(total * _P + hashes[i:len(hashes) - width + 1 + i])
    return np.unique(total)


@dataclass
class Bands:
    """Size bands and the part counts of their tiles for Jaccard >= num / den."""

    num: int
    den: int
    low: list[int] = field(default_factory=lambda: [1])
    parts: list[tuple[int, int]] = field(default_factory=list)  # (K, D) of tile i

    def band(self, n: int) -> int:
        while self.low[-1] <= n:
            low, below = self.low[-1], self.low[max(0, len(self.low) - 2)]
            high = low * self.den // self.num
            self.parts.append(self._part_count(high, below))
            self.low.append(high + 1)
        return int(np.searchsorted(self.low, n, "right")) - 1

    def tiles(self, n: int) -> list[tuple[int, int, int]]:
        """(tile, K, D) of a set of n shingles. With D = 0 only equal sets link, and those are one class."""
        i = self.band(n)
        self.band(self.low[i + 1])
        return [(t, *self.parts[t]) for t in (i, i + 1) if self.parts[t][1]]

    def _part_count(self, high: int, smallest: int) -> tuple[int, int]:
        differ = 2 * high * (self.den - self.num) // (self.den + self.num)
        for k in range(differ + 1, 2 * differ + 8):
            empty = k * math.exp(-smallest / k)
            if k - differ > empty + 3 * math.sqrt(empty):
                return k, differ
        return differ + 2, differ


def signatures(h: np.ndarray, bands: Bands) -> np.ndarray:
    """One hash per part that is not empty, in both tiles of the set."""
    out = []
    value = mix(h)
    for tile, k, differ in bands.tiles(len(h)):
        part = ((value * np.uint64(2 * tile + 1) + np.uint64(tile)) >> np.uint64(24)) % np.uint64(k)
        part = part.astype(np.int64)
        counts = np.bincount(part, minlength=k)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(value[np.argsort(part)], dtype=np.uint64)])
        ends = np.cumsum(counts)
        sums = sums[ends] - sums[ends - counts]
        index = np.arange(k, dtype=np.uint64)
        if k - np.count_nonzero(counts) < k - differ:
            index, sums = index[counts > 0], sums[counts > 0]
        out.append(mix(sums + mix(index * _P + np.uint64(tile + 1))))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def bitmap(h: np.ndarray) -> bytes:
    """Bits that the shingles set; their number is a power of two, so a longer bitmap folds to a shorter one."""
    size = LEAST_BITS
    while size < BITS_PER_SHINGLE * len(h):
        size *= 2
    bits = np.zeros(size, bool)
    bits[((h >> np.uint64(7)) % np.uint64(size)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def fold(maps: list[bytes], width: int) -> np.ndarray:
    """Bitmaps of ``width`` bytes or more as (rows, width / 8) words: bit i of a longer one goes to i modulo the width."""
    out = np.empty((len(maps), width // 8), np.uint64)
    sizes = np.fromiter(map(len, maps), np.int64, len(maps))
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        rows = np.frombuffer(b"".join([maps[i] for i in at.tolist()]), np.uint64).reshape(len(at), -1, width // 8)
        out[at] = np.bitwise_or.reduce(rows, axis=1)
    return out


def overlap_bound(n_a, n_b, map_a: np.ndarray, map_b: np.ndarray) -> np.ndarray:
    """Bitmaps as rows of words, equally wide. A bit that only one bitmap has stands for a shingle that only one set has."""
    only_a = np.bitwise_count(map_a & ~map_b).sum(1, dtype=np.int64)
    only_b = np.bitwise_count(map_b & ~map_a).sum(1, dtype=np.int64)
    return np.minimum(n_a - only_a, n_b - only_b)


def may_link(num: int, den: int, n_a, n_b, map_a: np.ndarray, map_b: np.ndarray) -> np.ndarray:
    overlap = overlap_bound(n_a, n_b, map_a, map_b)
    return den * overlap >= num * (n_a + n_b - overlap)


def _class_of(h: np.ndarray) -> tuple[int, int]:
    data = h.tobytes()
    return int(np.uint64(xxhash.xxh3_64_intdigest(data)).view(np.int64)), \
        int(np.uint64(xxhash.xxh64_intdigest(data, 1)).view(np.int64))


def pairs_may_link(num: int, den: int, n_a, n_b, maps_a: list[bytes], maps_b: list[bytes]) -> np.ndarray:
    """``may_link`` for bitmaps of any lengths; the longer one of a pair is folded."""
    ok = np.zeros(len(maps_a), bool)
    widths = np.fromiter((min(len(x), len(y)) for x, y in zip(maps_a, maps_b, strict=True)), np.int64, len(maps_a))
    for width in np.unique(widths).tolist():
        at = np.flatnonzero(widths == width)
        one, two = fold([maps_a[i] for i in at.tolist()], width), fold([maps_b[i] for i in at.tolist()], width)
        ok[at] = may_link(num, den, n_a[at], n_b[at], one, two)
    return ok


@dataclass
class JaccardJoin:
    """Near copies of ``docs`` by shingles of ``words`` words at Jaccard >= num / den."""

    scratch: Scratch
    words: int = 5
    num: int = 80
    den: int = 100

    def groups(self, docs: DataFrame) -> DataFrame:
        """(doc_id, n_shingles, component_id) for every row: the smallest doc_id that links reach."""
        sets, links, classes = self.links(docs)
        found = components(links, self.scratch).select(F.col("node").alias("rep"), "component")
        named = (classes.join(found, "rep", "left").filter("component is not null or copies > 1")
                 .select("class_id", "check", F.coalesce("component", "rep").alias("component")))
        rows = sets.join(named, ["class_id", "check"], "left")
        component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
        return rows.select("doc_id", "n_shingles", component.alias("component_id"))

    def links(self, docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """The staged sets, the links between classes (a < b, by their smallest doc_id, with their overlap), and the
        classes (class_id, check, rep, copies)."""
        scratch = self.scratch
        small_batches(docs.sparkSession)
        docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        described = scratch.write(self._described(docs), "sets")
        sets = described.drop("sigs")
        owned = sets.filter("doc_id is not null and n_shingles > 0")
        classes = scratch.write(owned.groupBy("class_id", "check").agg(
            F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "classes")
        tiles = scratch.write(self._tiles(described.filter("doc_id is not null and sigs is not null")), "tiles")
        live = scratch.write(tiles.groupBy("class_id").agg(F.count("*").alias("degree"))
                             .join(classes.select("class_id", "rep"), "class_id"), "live")
        members = scratch.write(self._members(docs, live), "members")
        rows = scratch.write(tiles.join(live, "class_id").join(
            members.groupBy("rep").agg(F.max("n").alias("n")), "rep").select("sig", "rep", "n", "degree"), "tile_rows")
        scratch.drop(tiles)
        hubs = rows.select("*", F.col("rep").alias("component")).repartition("sig").sortWithinPartitions(
            "sig", F.desc("degree"), "rep")
        tried = scratch.write(self._hub_pairs(hubs).distinct(), "hub_pairs")
        links = scratch.write(self._verified(tried, members), "links")
        for turn in range(HUB_ROUNDS + 1):
            left = self._open_rows(rows, components(links, scratch))
            if left.isEmpty():
                break
            if turn < HUB_ROUNDS:
                drawn = left.repartition("sig").sortWithinPartitions("sig", F.xxhash64("rep", F.lit(turn)), "rep")
                pairs = self._hub_pairs(drawn)
            else:
                pairs = self._block_pairs(left, members)
            more = scratch.write(pairs.distinct().join(tried, ["a", "b"], "left_anti"), "pairs")
            found = scratch.write(self._verified(more, members), "links")
            links, tried, rows = links.unionByName(found), tried.unionByName(more), left.drop("component")
        return sets, links, classes

    # -------------------------------------------------------- sets and tiles

    def _described(self, docs: DataFrame) -> DataFrame:
        """(doc_id, n_shingles, class_id, check, sigs): each text is cut into shingles once for all of these. A copy
        inside a split of the input has no signatures again."""
        words, num, den = self.words, self.num, self.den

        def make() -> Callable[[dict], dict]:
            known, bands, seen = WordHashes(), Bands(num, den), set()

            def step(c: dict) -> dict:
                sizes, ones, twos, sigs = [], [], [], []
                for doc, text in zip(c["doc_id"].to_pylist(), c["text"].to_pylist(), strict=True):
                    h = shingles(text, words, known)
                    one, two = _class_of(h)
                    new = len(h) and doc is not None and one not in seen
                    if new:
                        seen.add(one)
                    sizes.append(len(h))
                    ones.append(one if len(h) else None)
                    twos.append(two if len(h) else None)
                    sigs.append(signatures(h, bands).tobytes() if new else None)
                return {"doc_id": c["doc_id"], "n_shingles": sizes, "class_id": ones, "check": twos, "sigs": sigs}

            return step

        return map_arrow(docs, make, "doc_id long, n_shingles long, class_id long, check long, sigs binary")

    def _tiles(self, described: DataFrame) -> DataFrame:
        """(sig, class_id) of the signatures that at least two classes have."""
        def write() -> Callable[[dict], dict]:
            def step(c: dict) -> dict:
                sigs = c["sigs"].to_pylist()
                return {"sig": np.frombuffer(b"".join(sigs), np.int64),
                        "class_id": np.repeat(c["class_id"].to_numpy(), [len(s) // 8 for s in sigs])}

            return step

        def read() -> Callable[[dict | None], dict]:
            held: dict = {"sig": np.empty(0, np.int64), "class_id": np.empty(0, np.int64), "multi": False}

            def step(c: dict | None) -> dict:
                """The last row waits for its successor; ``multi``: it shares its signature with the row before."""
                new = [np.empty(0, np.int64)] * 2 if c is None else [c["sig"].to_numpy(), c["class_id"].to_numpy()]
                sig, ids = np.concatenate([held["sig"], new[0]]), np.concatenate([held["class_id"], new[1]])
                if not len(sig):
                    return {"sig": sig, "class_id": ids}
                keep = np.ones(len(sig), bool)
                keep[1:] = (sig[1:] != sig[:-1]) | (ids[1:] != ids[:-1])
                sig, ids = sig[keep], ids[keep]
                same = sig[1:] == sig[:-1]
                multi = np.append(same, False) | np.insert(same, 0, held["multi"])
                ready = len(sig) if c is None else len(sig) - 1
                held.update(sig=sig[ready:], class_id=ids[ready:], multi=bool(multi[-1]))
                return {"sig": sig[:ready][multi[:ready]], "class_id": ids[:ready][multi[:ready]]}

            return step

        schema = "sig long, class_id long"
        met = map_arrow(described.select("class_id", "sigs"), write, schema).repartition("sig").sortWithinPartitions(
            "sig", "class_id")
        return map_arrow(met, read, schema, flush=True)

    def _members(self, docs: DataFrame, live: DataFrame) -> DataFrame:
        """(rep, n, bitmap, shingles) of the classes that share a tile, from one document of each."""
        words = self.words
        ids = live.select(F.col("rep").alias("doc_id")).distinct()
        if ids.count() <= BROADCAST_IDS:
            ids = F.broadcast(ids)

        def make() -> Callable[[dict], dict]:
            known = WordHashes()

            def step(c: dict) -> dict:
                sets = [shingles(t, words, known) for t in c["text"].to_pylist()]
                return {"rep": c["doc_id"], "n": [len(h) for h in sets], "bitmap": [bitmap(h) for h in sets],
                        "shingles": [h.tobytes() for h in sets]}

            return step

        return map_arrow(docs.join(ids, "doc_id", "left_semi"), make,
                         "rep long, n long, bitmap binary, shingles binary").dropDuplicates(["rep", "shingles"])

    # -------------------------------------------------------- pairs

    def _open_rows(self, rows: DataFrame, found: DataFrame) -> DataFrame:
        """Rows, with their component, of the tiles that hold several. Of two classes, one was the hub: that pair has
        been compared."""
        named = rows.join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
            "component", F.coalesce("component", "rep"))
        still = (named.groupBy("sig").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                          F.count("*").alias("size"))
                 .filter("lo <> hi and size > 2").select("sig"))
        return self.scratch.write(named.join(still, "sig").select(*rows.columns, "component"), "open_rows")

    def _hub_pairs(self, rows: DataFrame) -> DataFrame:
        """Each class of a tile with the tile's first class, the hub, unless they share a component. Rows come sorted
        by tile; the stream holds the hub alone."""
        num, den = self.num, self.den

        def make() -> Callable[[dict], dict]:
            held: dict = {"sig": None}

            def step(c: dict) -> dict:
                sig, rep, n, group = (c[k].to_numpy() for k in ("sig", "rep", "n", "component"))
                if not len(sig):
                    return {"a": rep, "b": rep}
                heads = borders({"sig": sig}, ["sig"])
                at = np.repeat(heads, np.diff([*heads, len(sig)]))
                hub, hub_n, hub_group = rep[at], n[at], group[at]
                if held["sig"] == sig[0]:  # the batch begins inside a tile
                    first = slice(0, heads[1] if len(heads) > 1 else len(sig))
                    hub[first], hub_n[first], hub_group[first] = held["rep"], held["n"], held["component"]
                held.update(sig=sig[-1], rep=hub[-1], n=hub_n[-1], component=hub_group[-1])
                small, large = np.minimum(n, hub_n), np.maximum(n, hub_n)
                ok = (hub_group != group) & (den * small >= num * large)
                return {"a": np.minimum(hub, rep)[ok], "b": np.maximum(hub, rep)[ok]}

            return step

        return map_arrow(rows.select("sig", "rep", "n", "component"), make, "a long, b long")

    def _block_pairs(self, left: DataFrame, members: DataFrame) -> DataFrame:
        """Pairs of a tile that lie in different components and pass the size and bitmap bounds."""
        num, den = self.num, self.den
        tiled = block_tiles(left.select("sig", "rep", "component"), ["sig"], "rep", BLOCK_ROWS)
        full = tiled.join(members.select("rep", "n", "bitmap"), "rep")

        def compare(c: dict, width: int, out: list) -> None:
            """All pairs of whole tiles, whose narrowest bitmap has ``width`` bytes."""
            heads = borders(c, ["sig", "_i", "_j"])
            ends = np.repeat([*heads[1:], len(c["sig"])], np.diff([*heads, len(c["sig"])]))
            maps, rep, n, group = fold(list(c["bitmap"]), width), c["rep"], c["n"], c["component"]
            whole = c["_i"] == c["_j"]  # a block with itself: all its pairs; else one row from each block
            a = np.arange(len(rep))
            for d in range(1, len(rep)):
                a = a[a + d < ends[a]]
                if not len(a):
                    break
                b = a + d
                ok = (group[a] != group[b]) & (whole[a] | (c["_side"][a] != c["_side"][b]))
                ok &= den * np.minimum(n[a], n[b]) >= num * np.maximum(n[a], n[b])
                one, two = a[ok], b[ok]
                near = may_link(num, den, n[one], n[two], maps[one], maps[two])
                one, two = one[near], two[near]
                out.append(np.stack([np.minimum(rep[one], rep[two]), np.maximum(rep[one], rep[two])]))

        def make() -> Callable[[dict], dict]:
            def step(c: dict) -> dict:
                out: list = [np.empty((2, 0), np.int64)]
                heads = borders(c, ["sig", "_i", "_j"])
                size = np.fromiter(map(len, c["bitmap"]), np.int64, len(c["bitmap"]))
                narrowest = np.repeat(np.minimum.reduceat(size, heads), np.diff([*heads, len(size)]))
                for width in np.unique(narrowest).tolist():
                    compare({k: v[narrowest == width] for k, v in c.items()}, width, out)
                pairs = np.unique(np.concatenate(out, axis=1), axis=1)  # a pair meets in many tiles
                return {"a": pairs[0], "b": pairs[1]}

            return step

        return stream_groups(full, ["sig", "_i", "_j"], make, "a long, b long")

    def _verified(self, pairs: DataFrame, members: DataFrame) -> DataFrame:
        """(a, b, overlap) of the pairs that are linked: bitmaps first, then the sorted arrays."""
        num, den = self.num, self.den

        def side(name: str, *columns: str) -> DataFrame:
            return members.select(F.col("rep").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])

        def bound() -> Callable[[dict], dict]:
            def step(c: dict) -> dict:
                if not len(c["a"]):
                    return {"a": c["a"], "b": c["b"]}
                ok = pairs_may_link(num, den, c["n_a"].to_numpy(), c["n_b"].to_numpy(), c["bitmap_a"].to_pylist(),
                                    c["bitmap_b"].to_pylist())
                return {"a": c["a"].to_numpy()[ok], "b": c["b"].to_numpy()[ok]}

            return step

        def exact() -> Callable[[dict], dict]:
            def step(c: dict) -> dict:
                out = []
                for a, b, ones, twos in zip(*(c[k].to_pylist() for k in ("a", "b", "ones", "twos")), strict=True):
                    for one, two in itertools.product(ones, twos):  # several sets: rows that share a doc_id
                        one, two = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
                        overlap = len(np.intersect1d(one, two, assume_unique=True))
                        if den * overlap >= num * (len(one) + len(two) - overlap):
                            out.append((a, b, overlap))
                return {"a": [x[0] for x in out], "b": [x[1] for x in out], "overlap": [x[2] for x in out]}

            return step

        bounded = pairs.join(side("a", "n", "bitmap"), "a").join(side("b", "n", "bitmap"), "b")
        near = self.scratch.write(map_arrow(bounded, bound, "a long, b long").distinct(), "near")
        # pairs go to the sets where they are few enough to send, else both meet in a shuffle; arrays move once per pair
        pairs = F.broadcast(near) if near.count() <= BROADCAST_PAIRS else near
        none = F.lit(None).cast("binary")
        one = members.select(F.col("rep").alias("a"), "shingles").join(pairs, "a").select(
            "a", "b", F.col("shingles").alias("one"), none.alias("two"))
        two = members.select(F.col("rep").alias("b"), "shingles").join(pairs, "b").select(
            "a", "b", none.alias("one"), F.col("shingles").alias("two"))
        met = one.unionByName(two).groupBy("a", "b").agg(F.collect_list("one").alias("ones"),
                                                         F.collect_list("two").alias("twos"))
        return map_arrow(met, exact, "a long, b long, overlap long")
