"""SentencePiece BPE encoding and decoding in vectorised merge rounds.

Encoding takes the best pair of neighbours (highest score, leftmost first) until no pair joins to a piece. No merge can
cross the place before a space that follows another letter, nor touch a letter that occurs in no longer piece, so a text
is cut there into words, and a word met before is looked up. All other words of a batch are merged together:

1. their symbols lie in one flat numpy array, with the rank and the result of each pair beside it;
2. every round takes the smallest rank of each word (a segmented minimum) and merges all its places at once, leftmost
   first where they overlap;
3. the array is compacted, only the pairs next to a merge are looked up again, and words without a pair leave.

A round is what the sequential order does as long as no pair that it creates ranks at or before the round's own; a word
where one does (the vocabulary gives all runs of spaces the same score) is merged one pair at a time instead. Letters
without a piece become their UTF-8 bytes.

Defined results: null text is the empty text, whose only id is the end id. Null and repeated doc_id are encoded like any
other row, an empty table gives an empty table. Texts of any length are encoded whole, in stretches that end at words.
Only ``doc_id`` and ``text`` are read, whatever other columns are called. ``decode`` turns null ids into empty text, and
raises on an id outside the vocabulary.
"""

from __future__ import annotations

import codecs
import heapq
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oncospan.llm.common import map_arrow, small_batches

SPACE = "▁"  # fixed value: how pieces write a space
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE = 1, 2, 3, 4, 6  # fixed values: kinds of pieces in a model file
NO_PAIR = np.iinfo(np.int32).max
CACHE_WORDS = 500_000  # words whose ids a task remembers; only memory depends on it
LONG_WORD = 40  # longer words are not remembered
STRETCH = 1 << 18  # characters that are cut into words at a time
BATCH_WORDS = 1 << 16


class PieceModel:
    """What a BPE model file says: pieces in the order of their ids, scores, kinds, and whether a space goes first."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[int], space_first: bool):
        self.pieces, self.scores, self.kinds, self.space_first = pieces, scores, kinds, space_first

    @classmethod
    def read(cls, path: str) -> PieceModel:
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        rules, trained = model.normalizer_spec, model.trainer_spec
        if (trained.model_type != trained.BPE or not trained.byte_fallback or trained.treat_whitespace_as_suffix
                or rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces
                or any(p.type not in (NORMAL, UNKNOWN, CONTROL, BYTE) for p in model.pieces)):
            raise ValueError(f"{path}: only BPE models with byte pieces and without text normalisation are read")
        return cls([p.piece for p in model.pieces], [p.score for p in model.pieces], [p.type for p in model.pieces],
                   rules.add_dummy_prefix)


class PieceCodec:
    """Encodes and decodes by the tables of one model."""

    def __init__(self, model: PieceModel):
        self.model = model
        normal = {p: i for i, p in enumerate(model.pieces) if model.kinds[i] == NORMAL}
        longer = [p for p in normal if len(p) > 1]
        # letters that no piece holds alone, but longer pieces do, get symbols beyond the ids
        loose = sorted({c for p in longer for c in p} - normal.keys())
        symbols = normal | {c: len(model.pieces) + i for i, c in enumerate(loose)}
        self.n = len(model.pieces) + len(loose)
        self.loose = {s: c for c, s in symbols.items() if s >= len(model.pieces)}
        letters = {ord(c): s for c, s in symbols.items() if len(c) == 1}
        self.of_letter = -1 - np.arange(0x110000, dtype=np.int64)  # a letter without a piece: -1 - its code point
        self.of_letter[list(letters)] = list(letters.values())
        order = {s: r for r, s in enumerate(sorted({model.scores[i] for i in normal.values()}, reverse=True))}
        self._pair_tables(longer, symbols, [order[model.scores[normal[p]]] for p in longer])
        self.byte_ids = np.zeros(256, np.int64)
        for i, p in enumerate(model.pieces):
            if model.kinds[i] == BYTE:
                self.byte_ids[int(p[3:5], 16)] = i
        joining = {c for p in longer for c in p} - {SPACE}
        self.cuts = not any(SPACE in p.lstrip(SPACE) for p in longer)  # no piece has a space after another letter
        inside = "".join(map(re.escape, sorted(joining)))
        self.words = re.compile(f" *+[{inside}]++| ++|[^ ]" if self.cuts and inside else ".+", re.DOTALL)
        self.known: dict[str, bytes] = {}
        self.controls = {i for i, kind in enumerate(model.kinds) if kind == CONTROL}
        self.surfaces = [self._surface(i) for i in range(len(model.pieces))]

    def _pair_tables(self, longer: list[str], symbols: dict[str, int], ranks: list[int]) -> None:
        pairs = [(symbols[p[:k]] * self.n + symbols[p[k:]], rank, symbols[p]) for p, rank in zip(longer, ranks, strict=True)
                 for k in range(1, len(p)) if p[:k] in symbols and p[k:] in symbols]
        table = np.array(sorted(pairs), np.int64).reshape(-1, 3)
        self.pair_keys, self.pair_ranks, self.pair_made = table[:, 0].copy(), table[:, 1].copy(), table[:, 2].copy()

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (NO_PAIR where it joins to no piece) and the symbol it becomes."""
        if not len(self.pair_keys):
            return np.full(len(left), NO_PAIR), np.zeros(len(left), np.int64)
        key = left * self.n + right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        found = (self.pair_keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(found, self.pair_ranks[at], NO_PAIR), self.pair_made[at]

    # ------------------------------------------------------------ encoding

    def merge_words(self, words: list[str]) -> list[bytes]:
        """Ids (little-endian 32-bit) of each word, spaces written as spaces."""
        text = "".join(words).replace(" ", SPACE)
        symbols = self.of_letter[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        word = np.repeat(np.arange(len(words)), lengths)
        rank, made = np.full(len(symbols), NO_PAIR, np.int64), np.zeros(len(symbols), np.int64)
        self._look_up(np.arange(len(symbols)), symbols, word, rank, made)
        out: list[bytes] = [b""] * len(words)
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lengths = np.diff(np.r_[starts, len(word)])
            low = np.minimum.reduceat(rank, starts)
            if (low == NO_PAIR).any():
                ended = np.repeat(low == NO_PAIR, lengths)
                self._store(word[ended], symbols[ended], out)
                symbols, word, rank, made = (x[~ended] for x in (symbols, word, rank, made))
                continue
            least = np.repeat(low, lengths)
            at = self._leftmost(np.flatnonzero(rank == least))
            odd = self._out_of_order(at, symbols, word, rank, made, least)
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols[at] = made[at]
            symbols, word, rank, made, least = (x[keep] for x in (symbols, word, rank, made, least))
            merged = at - np.arange(len(at))
            near = np.unique(np.r_[merged, merged[merged > 0] - 1])
            self._look_up(near, symbols, word, rank, made)
            odd = np.union1d(odd, word[near[rank[near] <= least[near]]])
            if len(odd):
                for w in odd.tolist():
                    out[w] = self._bytes(self.merge_in_order(words[w]))
                stay = ~np.isin(word, odd)
                symbols, word, rank, made = (x[stay] for x in (symbols, word, rank, made))
        return out

    def _look_up(self, at: np.ndarray, symbols, word, rank, made) -> None:
        """Rank and result of the pairs that start at these places."""
        last = at[at == len(symbols) - 1]
        at = at[at < len(symbols) - 1]
        ranks, results = self.pairs(symbols[at], symbols[at + 1])
        rank[at] = np.where(word[at] == word[at + 1], ranks, NO_PAIR)
        made[at] = results
        rank[last] = NO_PAIR

    @staticmethod
    def _leftmost(at: np.ndarray) -> np.ndarray:
        """Of places one apart, which overlap, the first, third, ... of each run."""
        place = np.arange(len(at))
        run = np.maximum.accumulate(np.where(np.r_[True, np.diff(at) != 1], place, 0))
        return at[(place - run) % 2 == 0]

    def _out_of_order(self, at, symbols, word, rank, made, least) -> np.ndarray:
        """Words where a merge and the symbol after it, before that one merges too, would rank at or before the round."""
        at = at[at + 2 < len(symbols)]
        at = at[word[at] == word[at + 2]]
        ranks, _ = self.pairs(made[at], symbols[at + 2])
        return np.unique(word[at[ranks <= least[at]]])

    def merge_in_order(self, text: str) -> list[int]:
        """Symbols of one word, merged one pair at a time from an agenda."""
        symbols = self.of_letter[np.frombuffer(text.replace(" ", SPACE).encode("utf-32-le"), np.uint32)].tolist()
        n = len(symbols)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        table = {}

        def pair(a: int, b: int) -> tuple[int, int] | None:
            if (a, b) not in table:
                rank, made = self.pairs(np.array([a]), np.array([b]))
                table[a, b] = None if rank[0] == NO_PAIR else (int(rank[0]), int(made[0]))
            return table[a, b]

        agenda: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] >= 0 and (p := pair(symbols[i], symbols[after[i]])):
                heapq.heappush(agenda, (p[0], i, symbols[i], symbols[after[i]]))

        for i in range(n):
            offer(i)
        while agenda:
            _, i, a, b = heapq.heappop(agenda)
            j = after[i]
            if symbols[i] != a or j < 0 or symbols[j] != b:
                continue  # one of the two has merged since
            symbols[i], symbols[j] = pair(a, b)[1], None
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [s for s in symbols if s is not None]

    def _store(self, word: np.ndarray, symbols: np.ndarray, out: list[bytes]) -> None:
        if not len(word):
            return
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        whole = symbols.astype("<i4").tobytes()
        plain = np.minimum.reduceat(np.where(symbols >= len(self.model.pieces), -1, symbols), starts) >= 0
        for lo, hi, w, ids in zip(starts.tolist(), [*starts[1:].tolist(), len(word)], word[starts].tolist(),
                                  plain.tolist(), strict=True):
            out[w] = whole[4 * lo:4 * hi] if ids else self._bytes(symbols[lo:hi].tolist())

    def _bytes(self, symbols: list[int]) -> bytes:
        ids: list[int] = []
        for s in symbols:
            if 0 <= s < len(self.model.pieces):
                ids.append(s)
            else:
                letter = self.loose[s] if s >= 0 else chr(-1 - s)
                ids.extend(self.byte_ids[list(letter.encode())].tolist())
        return np.array(ids, "<i4").tobytes()

    def _stretches(self, text: str) -> Iterator[str]:
        """The text in stretches that end at words."""
        text = text.replace(SPACE, " ")
        text = " " + text if text and self.model.space_first else text
        lo = 0
        while self.cuts and len(text) - lo > STRETCH:
            hit = re.compile("[^ ] ").search(text, lo + STRETCH - 1)
            if not hit:
                break
            yield text[lo:hi] if (hi := hit.start() + 1) else ""
            lo = hi
        yield text[lo:]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text (little-endian 32-bit)."""
        parts: list[list[bytes]] = [[] for _ in texts]
        held: list[tuple[int, list[str]]] = []
        size = 0

        def flush() -> None:
            known = self.known
            new = list({w for _, words in held for w in words if w not in known})
            if len(known) + len(new) > CACHE_WORDS:
                known.clear()
                new = list({w for _, words in held for w in words})
            ids = dict(zip(new, self.merge_words(new), strict=True)) if new else {}
            known.update((w, i) for w, i in ids.items() if len(w) <= LONG_WORD)
            for doc, words in held:
                try:
                    parts[doc].append(b"".join(map(known.__getitem__, words)))
                except KeyError:  # a long word
                    parts[doc].append(b"".join([known[w] if w in known else ids[w] for w in words]))
            held.clear()

        for doc, text in enumerate(texts):
            for stretch in self._stretches(text):
                words = self.words.findall(stretch)
                held.append((doc, words))
                size += len(words)
                if size >= BATCH_WORDS:
                    flush()
                    size = 0
        flush()
        return [b"".join(p) for p in parts]

    # ------------------------------------------------------------ decoding

    def _surface(self, i: int) -> bytes:
        kind, piece = self.model.kinds[i], self.model.pieces[i]
        if kind == CONTROL:
            return b""
        if kind == UNKNOWN:
            return " ⁇ ".encode()  # fixed value: what the library writes for the unknown piece
        return bytes([int(piece[3:5], 16)]) if kind == BYTE else piece.replace(SPACE, " ").encode()

    def decode(self, ids: list[int]) -> str:
        """Text of the ids; the space that encoding puts first is dropped, bytes that are no text become U+FFFD each."""
        if ids and (min(ids) < 0 or max(ids) >= len(self.surfaces)):
            raise ValueError("id outside the vocabulary")
        kinds = self.model.kinds
        text, lo = "", 0
        for hi in [*(k for k, i in enumerate(ids) if i in self.controls), len(ids)]:  # bytes don't join across these
            text += b"".join(map(self.surfaces.__getitem__, ids[lo:hi])).decode("utf-8", "piece_bytes")
            lo = hi + 1
        first = next((i for i in ids if kinds[i] != CONTROL), None)
        drop = self.model.space_first and first is not None and kinds[first] == NORMAL
        return text[1:] if drop and self.model.pieces[first].startswith(SPACE) else text


codecs.register_error("piece_bytes", lambda e: ("�" * (e.end - e.start), e.end))


def encode(docs: DataFrame, model: PieceModel, end_id: int | None = None) -> DataFrame:
    """(doc_id, ids) of every whole text; ``end_id`` is put after the ids of each."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one vocabulary, fixed size
    end = b"" if end_id is None else np.array([end_id], "<i4").tobytes()

    def make() -> Callable[[dict], dict]:
        codec = PieceCodec(shared.value)

        def step(c: dict) -> dict:
            ids = [i + end for i in codec.encode_all([t or "" for t in c["text"].to_pylist()])]
            offsets = np.cumsum([0, *(len(i) // 4 for i in ids)]).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(ids), "<i4"))
            return {"doc_id": c["doc_id"], "ids": pa.ListArray.from_arrays(pa.array(offsets), values)}

        return step

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make,
                     "doc_id long, ids array<int>")


def decode(tokens: DataFrame, model: PieceModel) -> DataFrame:
    """(doc_id, ids, text) of rows (doc_id, ids)."""
    shared = tokens.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable[[dict], dict]:
        codec = PieceCodec(shared.value)

        def step(c: dict) -> dict:
            return {"doc_id": c["doc_id"], "ids": c["ids"],
                    "text": [codec.decode([] if i is None else i) for i in _id_lists(c["ids"])]}

        return step

    return map_arrow(tokens.select("doc_id", "ids"), make, "doc_id long, ids array<int>, text string")


def _id_lists(column: pa.Array) -> Iterator[list[int] | None]:
    values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    for row, (lo, hi) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        yield values[lo:hi].tolist() if column[row].is_valid else None
