"""Line dedup that can be undone: sharded cuckoo filters over exact reference counts.

A ``LineStore`` holds three tables in the shared folder:

* ``references`` (doc_id, key, n_lines): which document holds which line key, exactly;
* ``counts`` (key, shard, n_docs, first_doc): how many documents hold a key, and the smallest of them;
* ``filters`` (shard, filter): a cuckoo filter per shard, holding the keys that at least two documents hold.

Inserting documents raises counts; keys that reach two documents enter their shard's filter. Deleting documents lowers
counts; keys that fall below two leave the filter, which a cuckoo filter allows and a Bloom filter does not. To clean
documents, their references pass their shard's filter, which drops almost all; the rest meet the exact counts, so a
false hit of the filter never drops a line. A shard whose filter overflows is rebuilt from the counts; until then it
answers "maybe" to every key, which stays exact.

Shards grow with the store by linear hashing: with more keys than ``keys_per_shard`` on average, further shards split
off the first ones, only the filters of shards that split are built anew, and all other keys stay where they are.
``save`` writes the three tables to a folder, ``LineStore.load`` opens them in another session.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z lowered, as a 128-bit hash; keys of
fewer than ``min_chars`` code points are never dropped. Defined results: null or empty text is one empty line. Rows that
share a doc_id are one document. Lines of rows without doc_id stay and are not counted. An empty table gives an empty
result. Only ``doc_id`` and ``text`` are read; other columns are handed on, whatever their names, but columns called
``n_lines`` or ``n_dropped`` give way to the results of these names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oncospan.llm.common import ASCII_SPACE, Scratch, map_arrow, small_batches, stream_groups

SLOTS = 4
_KEY = "doc_id long, key binary, n_lines int"
_COUNTS = "key binary, n_docs long, first_doc long, shard int"
_FILTERS = "shard int, filter binary"


def line_key(line: str, min_chars: int) -> bytes | None:
    bare = line.strip(ASCII_SPACE)
    if len(bare) < min_chars:
        return None
    return hashlib.blake2b(bare.encode().lower(), digest_size=16).digest()  # bytes.lower changes A-Z alone


# ------------------------------------------------------------ the filter

class CuckooFilter:
    """16-bit fingerprints in buckets of four; a key has two buckets, each computed from the other."""

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        buckets = 1 << max(4, int(np.ceil(np.log2(max(1, keys) / (SLOTS * 0.85)))))
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @classmethod
    def read(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy())

    def write(self) -> bytes:
        return self.table.tobytes()

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """keys: (n, 16) bytes. The fingerprint is never 0, which marks a free slot."""
        words = np.ascontiguousarray(keys).view("<u4").reshape(-1, 4)
        mask = np.uint32(len(self.table) - 1)
        mark = (words[:, 1] % np.uint32(65535) + np.uint32(1)).astype(np.uint32)
        one = words[:, 2] & mask
        return mark.astype(np.uint16), one, one ^ (self._step(mark) & mask)

    @staticmethod
    def _step(mark):
        return (mark * np.uint32(0x5BD1E995)) | np.uint32(1)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        mark, one, two = self._places(keys)
        return (self.table[one] == mark[:, None]).any(1) | (self.table[two] == mark[:, None]).any(1)

    def insert(self, keys: np.ndarray) -> bool:
        """False when the filter is too full; it then misses keys and must not be used.

        Free slots are filled for all keys at once, one key per bucket and slot; keys that find both buckets full push
        others out, one after the other.
        """
        marks, one, two = self._places(keys)
        left = np.arange(len(marks))
        for places in (one, two):
            for slot in range(SLOTS):
                free = left[self.table[places[left], slot] == 0]
                _, first = np.unique(places[free], return_index=True)
                placed = free[first]
                self.table[places[placed], slot] = marks[placed]
                left = np.setdiff1d(left, placed, assume_unique=True)
        rng = np.random.default_rng(0)
        return all(self._push(marks[i], two[i], rng) for i in left.tolist())

    def _push(self, mark, at, rng) -> bool:
        mask = np.uint32(len(self.table) - 1)
        for _ in range(500):
            free = np.flatnonzero(self.table[at] == 0)
            if len(free):
                self.table[at, free[0]] = mark
                return True
            slot = rng.integers(SLOTS)
            mark, self.table[at, slot] = self.table[at, slot], mark
            at = at ^ (np.uint32((int(mark) * 0x5BD1E995) & 0xFFFFFFFF | 1) & mask)
        return False

    def delete(self, keys: np.ndarray) -> None:
        """Remove one copy of each key's fingerprint; only for keys that were inserted."""
        marks, one, two = self._places(keys)
        left = np.arange(len(marks))
        for places in (one, two):
            for slot in range(SLOTS):
                held = left[self.table[places[left], slot] == marks[left]]
                _, first = np.unique(places[held], return_index=True)  # a slot goes once
                gone = held[first]
                self.table[places[gone], slot] = 0
                left = np.setdiff1d(left, gone, assume_unique=True)


def _key_matrix(keys) -> np.ndarray:
    return np.frombuffer(b"".join(keys), np.uint8).reshape(-1, 16)


# ------------------------------------------------------------ the store

class LineStore:
    """Reference counts and filters of the lines of the documents inserted so far."""

    def __init__(self, spark: SparkSession, scratch: Scratch, min_chars: int = 10, keys_per_shard: int = 200_000):
        self.spark, self.scratch = spark, scratch
        self.min_chars, self.keys_per_shard = min_chars, keys_per_shard
        self.references = spark.createDataFrame([], _KEY)
        self.counts: DataFrame | None = None
        self.filters: DataFrame | None = None
        self.shards = 0

    # -------------------------------------------------------- changes

    def insert(self, docs: DataFrame) -> LineStore:
        """Add documents whose ids the store does not hold yet."""
        new = self.scratch.write(self._references_of(docs), "references")
        counted = new.groupBy("key").agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc"))
        if self.counts is None:
            merged = counted.withColumn("was", F.lit(0).cast("long"))
        else:
            old = self.counts.select("key", "n_docs", "first_doc", F.col("n_docs").alias("was"))
            merged = (old.unionByName(counted.withColumn("was", F.lit(0).cast("long"))).groupBy("key")
                      .agg(F.sum("n_docs").alias("n_docs"), F.min("first_doc").alias("first_doc"),
                           F.max("was").alias("was")))
        both = self.scratch.write(merged, "merged")
        self.references = new if self.counts is None else self.references.unionByName(new)
        before, self.shards = self.shards, max(self.shards, 1, -(-both.count() // self.keys_per_shard))
        placed = self._with_shard(both)
        self.counts = placed.drop("was")
        self._grow(before)
        split = self._split_shards(before)
        risen = placed.filter("n_docs >= 2 and was < 2").select("shard", "key")
        if split:  # these were built from the counts, with the new keys
            risen = risen.filter(~F.col("shard").isin(split))
        self._change_filters(risen, added=True)
        return self

    def _split_shards(self, before: int) -> list[int]:
        """Shards whose keys moved when the number of shards rose: the new ones and those that they split from."""
        if not before or self.shards == before:
            return []
        new = set(range(before, self.shards))
        for s in range(before, self.shards):
            while s >= before:  # the shard that held these keys
                s -= 1 << (s.bit_length() - 1)
            new.add(s)
        return sorted(new)

    def _grow(self, before: int) -> None:
        split = self._split_shards(before)
        if not split:
            return
        blank = self.spark.createDataFrame([(s, b"") for s in split], "shard int, filter binary")
        repeated = self.counts.filter("n_docs >= 2").select("shard", "key").filter(F.col("shard").isin(split))
        whole = self.filters.filter(~F.col("shard").isin(split))
        self.filters = self.scratch.write(whole.unionByName(self._filters_after(repeated, True, blank)), "filters")

    def delete(self, doc_ids: DataFrame) -> LineStore:
        """Take documents back out; lines that only they repeated become unique again."""
        ids = doc_ids.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
        gone = self.references.join(ids, "doc_id", "left_semi")
        touched = self.scratch.write(gone.select("key").distinct(), "touched")
        self.references = self.scratch.write(self.references.join(ids, "doc_id", "left_anti"), "references")
        recounted = (self.references.join(touched, "key", "left_semi").groupBy("key")
                     .agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc")))
        kept = self.counts.join(touched, "key", "left_anti").select("key", "n_docs", "first_doc")
        counts = self.scratch.write(self._with_shard(kept.unionByName(recounted)), "counts")
        still = counts.filter("n_docs >= 2").select("key")
        fallen = (self.counts.filter("n_docs >= 2").join(touched, "key", "left_semi")
                  .join(still, "key", "left_anti").select("shard", "key"))
        fallen = self.scratch.write(fallen, "fallen")
        self.counts = counts
        self._change_filters(fallen, added=False)
        return self

    # -------------------------------------------------------- files

    def save(self, folder: str) -> None:
        """Write the store to ``folder``, whose last store it replaces."""
        counts = self.counts if self.counts is not None else self.spark.createDataFrame([], _COUNTS)
        filters = self.filters if self.filters is not None else self.spark.createDataFrame([], _FILTERS)
        facts = self.spark.createDataFrame([(self.min_chars, self.keys_per_shard, self.shards)],
                                           "min_chars int, keys_per_shard long, shards int")
        for name, df in (("references", self.references), ("counts", counts), ("filters", filters), ("facts", facts)):
            df.write.mode("overwrite").parquet(f"{folder}/{name}")

    @classmethod
    def load(cls, spark: SparkSession, scratch: Scratch, folder: str) -> LineStore:
        """A saved store. Later changes go to ``scratch``; the folder stays as it is."""
        facts = spark.read.parquet(f"{folder}/facts").first()
        store = cls(spark, scratch, facts.min_chars, facts.keys_per_shard)
        store.shards = facts.shards
        store.references = spark.read.schema(_KEY).parquet(f"{folder}/references")
        if store.shards:
            store.counts = spark.read.schema(_COUNTS).parquet(f"{folder}/counts")
            store.filters = spark.read.schema(_FILTERS).parquet(f"{folder}/filters")
        return store

    # -------------------------------------------------------- use

    def clean(self, docs: DataFrame) -> DataFrame:
        """``docs`` without the repeated lines; adds n_lines (before) and n_dropped. The store must hold them."""
        hits = self._maybe_repeated()
        repeated = self.counts.filter("n_docs >= 2").select("key", "first_doc")
        docs = docs.select(*[c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")])
        doc, drop = _private(docs, "_doc"), _private(docs, "_drop")
        drops = (hits.join(repeated, "key").filter("doc_id <> first_doc")
                 .groupBy(F.col("doc_id").alias(doc)).agg(F.collect_list("key").alias(drop)))  # the document's own lines
        marked = docs.join(drops, docs["doc_id"].cast("long") == drops[doc], "left").drop(doc)
        return _without_lines(marked, drop, self.min_chars)

    def _maybe_repeated(self) -> DataFrame:
        """References whose key passes its shard's filter. Rows of a shard are spread over salts; each salt gets a
        copy of the filter, and the filter's row comes first in the sorted stream."""
        salts = 16
        rows = self._with_shard(self.references).select(
            "shard", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("salt"), F.lit(1).alias("kind"),
            "doc_id", "key", F.lit(None).cast("binary").alias("filter"))
        filters = self.filters.select(
            "shard", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(0).alias("kind"),
            F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("key"), "filter")

        def make() -> Callable[[dict], dict]:
            state: dict = {"shard": None, "filter": None}  # filter None: every key may be repeated

            def step(c: dict) -> dict:
                shard, kind, keys = c["shard"].to_numpy(), c["kind"].to_numpy(), c["key"].to_pylist()
                docs, data = c["doc_id"].to_pylist(), c["filter"]
                out_doc, out_key = [], []
                heads = np.flatnonzero(np.diff(shard, prepend=shard[0] - 1) != 0)
                for lo, hi in zip(heads, [*heads[1:], len(shard)], strict=True):
                    if kind[lo] == 0:
                        held = data[int(lo)].as_py()
                        state.update(shard=shard[lo], filter=None if held is None else CuckooFilter.read(held))
                    assert state["shard"] == shard[lo], "a shard's filter comes before its keys"
                    part = [i for i in range(lo, hi) if kind[i] == 1]
                    if not part:
                        continue
                    if state["filter"] is None:
                        passed = part
                    else:
                        passed = np.array(part)[state["filter"].contains(_key_matrix([keys[i] for i in part]))]
                    out_doc += [docs[i] for i in passed]
                    out_key += [keys[i] for i in passed]
                return {"doc_id": out_doc, "key": out_key}

            return step

        stream = rows.unionByName(filters).repartition("shard", "salt").sortWithinPartitions("shard", "kind")
        return map_arrow(stream, make, "doc_id long, key binary")

    # -------------------------------------------------------- parts

    def _references_of(self, docs: DataFrame) -> DataFrame:
        small_batches(self.spark)
        min_chars = self.min_chars

        def make() -> Callable[[dict], dict]:
            def step(c: dict) -> dict:
                ids, keys, lines = [], [], []
                for doc, text in zip(c["doc_id"].to_pylist(), c["text"].to_pylist(), strict=True):
                    own: dict[bytes, int] = {}
                    for line in (text or "").split("\n"):
                        key = line_key(line, min_chars)
                        if key is not None:
                            own[key] = own.get(key, 0) + 1
                    ids += [doc] * len(own)
                    keys += own.keys()
                    lines += own.values()
                return {"doc_id": ids, "key": keys, "n_lines": lines}

            return step

        owned = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null")
        found = map_arrow(owned, make, _KEY)
        return found.groupBy("doc_id", "key").agg(F.sum("n_lines").cast("int").alias("n_lines"))

    def _with_shard(self, rows: DataFrame) -> DataFrame:
        """Linear hashing: as many low bits of the hash as there are shards for, one bit less beyond the last shard."""
        width = 1 << max(0, (self.shards - 1).bit_length())
        h = F.xxhash64("key")
        wide, narrow = F.pmod(h, F.lit(width)), F.pmod(h, F.lit(max(1, width // 2)))
        return rows.withColumn("shard", F.when(wide < self.shards, wide).otherwise(narrow).cast("int"))

    def _change_filters(self, changes: DataFrame, added: bool) -> None:
        """Apply a shard's changes to its filter; a shard has ``keys_per_shard`` keys on average."""
        if self.filters is None:
            self.filters = self.spark.range(self.shards).select(F.col("id").cast("int").alias("shard"),
                                                                F.lit(b"").alias("filter"))
        changed = self._filters_after(changes, added)
        self.filters = self.scratch.write(changed, "filters")
        full = self.filters.filter("filter is null")
        if not full.isEmpty():
            repeated = self.counts.filter("n_docs >= 2").select("shard", "key").join(full.select("shard"), "shard")
            blank = full.select("shard", F.lit(b"").alias("filter"))
            whole = self.filters.filter("filter is not null")
            self.filters = self.scratch.write(
                whole.unionByName(self._filters_after(repeated, True, blank)), "filters")

    def _filters_after(self, changes: DataFrame, added: bool, filters: DataFrame | None = None) -> DataFrame:
        def apply(key, held: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            data = held["filter"].iloc[0] if len(held) else b""
            if data is None:
                return pd.DataFrame({"shard": [key[0]], "filter": [None]})
            keys = _key_matrix(rows["key"])
            table = CuckooFilter.read(data) if data else CuckooFilter.sized(len(keys))
            if not added:
                table.delete(keys)
            elif not table.insert(keys):
                if data:  # the keys held before are not here: to be rebuilt
                    return pd.DataFrame({"shard": [key[0]], "filter": [None]})
                size = len(keys)
                while not table.insert(keys):
                    size *= 2
                    table = CuckooFilter.sized(size)
            return pd.DataFrame({"shard": [key[0]], "filter": [table.write()]})

        held = self.filters if filters is None else filters
        return held.groupBy("shard").cogroup(changes.groupBy("shard")).applyInPandas(apply, "shard int, filter binary")


def _private(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    known = {c.lower() for c in df.columns}
    while name in known:
        name += "_"
    return name


def _without_lines(marked: DataFrame, drop: str, min_chars: int) -> DataFrame:
    """Rewrite ``text`` without the lines whose key is in column ``drop``."""
    small_batches(marked.sparkSession)
    others = [c for c in marked.columns if c not in ("text", drop)]
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in marked.schema if f.name in others)

    def make() -> Callable[[dict], dict]:
        def step(c: dict) -> dict:
            texts, n_lines, n_dropped = [], [], []
            for text, keys in zip(c["text"].to_pylist(), c[drop].to_pylist(), strict=True):
                lines = (text or "").split("\n")
                if keys:
                    gone = set(keys)
                    kept = [x for x in lines if line_key(x, min_chars) not in gone]
                else:
                    kept = lines
                texts.append("\n".join(kept))
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
            return {**{o: c[o] for o in others}, "text": texts, "n_lines": n_lines, "n_dropped": n_dropped}

        return step

    return map_arrow(marked.select(*[F.col(f"`{o}`") for o in others], "text", drop), make,
                     f"{fields}text string, n_lines long, n_dropped long")


def dedup_lines(docs: DataFrame, scratch: Scratch, min_chars: int = 10) -> DataFrame:
    """Insert all documents in one store and clean them: the first holder of a line keeps it."""
    store = LineStore(docs.sparkSession, scratch, min_chars).insert(docs)
    return store.clean(docs)
