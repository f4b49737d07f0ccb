"""Packing: concatenate and cut.

The corpus is one long row of tokens, cut every ``window`` tokens. Pass one tokenizes each document once, where it is
read, and stages its ids with the number of tokens before it in its partition. The totals of the partitions, one row
each, get a prefix sum. Pass two adds the two and knows every document's global offset, so each piece's sequence and
place are arithmetic; no row of text or ids is shuffled. Sequences that lie inside a partition are whole there; those
that cross a border are joined from boundary records (``assemble``).

Defined results: null text is the empty text, which holds the end token alone. A null or repeated doc_id is packed like
any other row. An empty table gives no pieces. Columns besides ``doc_id`` and ``text`` are not read, whatever their
names. The last sequence is the only one that is not full.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oncospan.llm.common import Scratch, map_arrow, small_batches

CACHE_WORDS = 250_000  # words that a task remembers in each table, and as many older ones; only memory depends on it
CACHE_LETTERS = 40  # longer words are not remembered


def byte_letters() -> dict[int, str]:
    """The letter that byte-level tokenizers write for each byte: itself where printable, else the next free one."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Recent(dict):
    """Ids of the words met lately. When ``words`` are held they become the older ones and those before them go, so
    frequent words stay and a task's memory is bounded."""

    def __init__(self, make: Callable[[str], bytes], words: int):
        self.make, self.words, self.older = make, words, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.make(word)
        if len(word) <= CACHE_LETTERS:
            if len(self) >= self.words:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


class WordEncoder:
    """Ids of whole texts, as little-endian unsigned 32-bit integers.

    The tokenizer drops white space and never merges across it, so a text's ids are those of its space-separated
    chunks in turn, and a chunk met before is looked up. Plain Latin chunks go straight to the tokenizer's model;
    every other chunk goes through the whole tokenizer.
    """

    def __init__(self, tokenizer_json: str, cache_words: int = CACHE_WORDS):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.plain = regex.compile(r"[!-~À-ɏ]+")
        self.words = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
        self.chunks, self.pieces = Recent(self.chunk, cache_words), Recent(self.piece, cache_words)

    def piece(self, word: str) -> bytes:
        shown = word if word.isascii() else "".join([self.letters[b] for b in word.encode()])
        return np.array([t.id for t in self.model.tokenize(shown)], "<u4").tobytes()

    def chunk(self, text: str) -> bytes:
        if not text:
            return b""
        lower = text.lower()
        if max(lower) < "\u0250":  # plain Latin letters: one word, perhaps with one mark after it
            if lower.isalpha():
                return self.pieces[lower]
            if lower[:-1].isalpha() and lower[-1] in ".,;:!?":
                return self.pieces[lower[:-1]] + self.pieces[lower[-1]]
        if "<|" in text or not self.plain.fullmatch(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.pieces.__getitem__, self.words.findall("".join([c.lower() for c in text]))))

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.chunks.__getitem__, text.replace("\n", " ").split(" ")))


def read_text(path: str) -> str:
    """A small file's content, read by the driver; it travels to the tasks with their code."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def tokenize(docs: DataFrame, tokenizer_json: str, end_id: int = 1, cache_words: int = CACHE_WORDS) -> DataFrame:
    """(doc_id, ids, n_tokens, part, before): ids with the end token, and the tokens before it in its partition."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)  # one vocabulary, fixed size

    def make() -> Callable[[dict], dict]:
        encoder = WordEncoder(shared.value, cache_words)
        end = np.array([end_id], "<u4").tobytes()
        part, total = TaskContext.get().partitionId(), 0

        def step(c: dict) -> dict:
            nonlocal total
            ids = [encoder.encode(t or "") + end for t in c["text"].to_pylist()]
            sizes = np.fromiter((len(i) // 4 for i in ids), np.int64, len(ids))
            before = total + np.cumsum(sizes) - sizes
            total += int(sizes.sum())
            return {"doc_id": c["doc_id"], "ids": ids, "n_tokens": sizes, "part": np.full(len(ids), part),
                    "before": before}

        return step

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make,
                     "doc_id long, ids binary, n_tokens long, part int, before long")


def pack(docs: DataFrame, scratch: Scratch, tokenizer_json: str, window: int = 2048, end_id: int = 1,
         cache_words: int = CACHE_WORDS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian 32-bit), doc_tokens, sequence_id, offset."""
    tokens = scratch.write(tokenize(docs, tokenizer_json, end_id, cache_words), "tokens")
    totals = tokens.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition of the scan
    starts = totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("part_start"))
    # one row per partition of the scan, 12 bytes each: bounded by the number of input splits
    placed = tokens.join(F.broadcast(starts), "part").withColumn("at", F.col("part_start") + F.col("before"))
    first = F.floor(F.col("at") / window)
    last = F.floor((F.col("at") + F.col("n_tokens") - 1) / window)
    pieces = placed.withColumn("sequence_id", F.explode(F.sequence(first, last)))
    start = F.greatest(F.lit(0).cast("long"), F.col("sequence_id") * window - F.col("at"))
    end = F.least(F.col("n_tokens"), (F.col("sequence_id") + 1) * window - F.col("at"))
    pieces = pieces.withColumn("start", start).withColumn("length", end - F.col("start"))
    return pieces.select(
        "doc_id", "start", "length",
        F.expr("substring(ids, cast(start * 4 + 1 as int), cast(length * 4 as int))").alias("ids"),
        F.col("n_tokens").alias("doc_tokens"), "sequence_id",
        (F.col("at") + F.col("start") - F.col("sequence_id") * window).alias("offset"))


def assemble(pieces: DataFrame) -> DataFrame:
    """Whole sequences from their pieces: (sequence_id, ids, n_tokens). A group is at most one window."""
    parts = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"),
                                              F.sum("length").alias("n_tokens"))
    joined = F.aggregate("p", F.unhex(F.lit("")), lambda acc, x: F.concat(acc, x["ids"]))
    return parts.select("sequence_id", joined.alias("ids"), "n_tokens")
