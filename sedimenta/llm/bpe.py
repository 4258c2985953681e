"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

A piece of text starts as its byte symbols. A segment tree holds, for every symbol that has
a right neighbour, the rank of that pair; its root yields the lowest rank, the leftmost of
equal ones. That pair is merged, at most three leaves change, each in logarithmic time, and
this goes on until no mergeable pair is left. A piece of n symbols takes n log n steps, however
long it is.

The vocabulary is one file in the format of the tokenizers library: byte-level BPE with a
word-end suffix, whose text is normalised (NFC, runs of white space to one space, lower case
by character) and cut into pieces by a pattern. Special tokens in a text are taken before that.
The file is read once on the driver, its size is checked, and it is broadcast.

Defined results: a null or empty text has no ids and decodes to the empty text. Null ids decode
to the empty text, an unknown id is an error. A result column replaces an input column of
its name; all others are carried along, whatever their names.
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm.common import give_back, in_use, ship_package

MAX_VOCABULARY_BYTES = 64 << 20
#: Bytes of remembered pieces, and of chunks; checked between batches.
REMEMBERED_BYTES = 16 << 20
#: What an entry takes beside its text and ids.
ENTRY_BYTES = 20
#: Slots of the hash table of merges, a power of two; they must fill half at most.
PAIR_SLOTS = 1 << 19
#: Pieces of more bytes have a tree of their own; shorter ones are merged side by side.
WIDEST = 64
#: Pieces merged side by side at a time.
ROWS_AT_ONCE = 1 << 13
#: Bytes of text encoded at a time, and ids decoded at a time.
TEXT_AT_ONCE, IDS_AT_ONCE = 4 << 20, 1 << 20
#: Separators of str.split() and of Arrow that are no white space in the pattern.
SEPARATORS = "\x1c\x1d\x1e\x1f"
NO_RANK = 1 << 40
_WHITE = r"\p{White_Space}"


def byte_symbols() -> dict[int, str]:
    """The printable stand-in of each byte: itself where printable, else from 256 upwards."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


class PairTree:
    """Ranks of adjacent pairs; the root is the lowest rank and, of equal ones, the leftmost."""

    NONE = 1 << 62

    def __init__(self, ranks: list[int]):
        self.leaves = leaves = 1 << max(0, len(ranks) - 1).bit_length()
        self.tree = tree = [self.NONE] * (2 * leaves)
        for k, rank in enumerate(ranks):
            if rank >= 0:
                tree[leaves + k] = rank << 32 | k
        for k in range(leaves - 1, 0, -1):
            left, right = tree[2 * k], tree[2 * k + 1]
            tree[k] = left if left < right else right

    def root(self) -> int:
        """The position of the pair to merge next, or -1."""
        return -1 if self.tree[1] == self.NONE else self.tree[1] & 0xFFFFFFFF

    def put(self, k: int, rank: int) -> None:
        tree, node = self.tree, self.leaves + k
        tree[node] = rank << 32 | k if rank >= 0 else self.NONE
        while node > 1:
            node >>= 1
            left, right = tree[2 * node], tree[2 * node + 1]
            low = left if left < right else right
            if tree[node] == low:
                break
            tree[node] = low


class Remembered:
    """Ids of pieces or chunks in Arrow columns of bounded size. Beyond the bound, those used
    longest ago are forgotten, so frequent words stay."""

    def __init__(self):
        self.keys = pa.array([], pa.string())
        self.ids = pa.array([], pa.large_binary())
        self.used = np.empty(0, np.int64)
        self.batch = 0

    def ids_of(
        self, words: pa.Array, learn: Callable[[pa.Array], pa.LargeBinaryArray]
    ) -> pa.LargeBinaryArray:
        """The ids of every word, each distinct one looked up once; `learn` gives the ids of
        those that are not known."""
        coded = words.dictionary_encode()
        place = pc.index_in(coded.dictionary, value_set=self.keys)
        unknown = place.is_null()
        fresh = coded.dictionary.filter(unknown)
        at = place.fill_null(0).to_numpy().copy()
        if len(fresh):
            at[unknown.to_numpy(zero_copy_only=False)] = len(self.keys) + np.arange(len(fresh))
            self.ids = pa.concat_arrays([self.ids, learn(fresh)])
            self.keys = pa.concat_arrays([self.keys, fresh])
            self.used = np.concatenate([self.used, np.zeros(len(fresh), np.int64)])
        self.used[at] = self.batch
        return self.ids.take(pa.array(at).take(coded.indices))

    def age(self) -> None:
        """Between batches: when full, the half of the bytes used longest ago is forgotten."""
        self.batch += 1
        if self.keys.nbytes + self.ids.nbytes + self.used.nbytes <= REMEMBERED_BYTES:
            return
        newest = np.argsort(-self.used, kind="stable")
        sizes = ENTRY_BYTES + pc.add(
            pc.cast(pc.binary_length(self.keys), pa.int64()), pc.binary_length(self.ids)
        ).to_numpy()
        kept = newest[sizes[newest].cumsum() <= REMEMBERED_BYTES // 2]
        self.keys, self.ids = self.keys.take(pa.array(kept)), self.ids.take(pa.array(kept))
        self.used = self.used[kept]


def _slots(keys: np.ndarray) -> np.ndarray:
    """Where in the hash table of merges to look first."""
    mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - PAIR_SLOTS.bit_length() + 1)).astype(np.int64)


def _binary(ids: np.ndarray, stops: np.ndarray) -> pa.LargeBinaryArray:
    """Consecutive runs of ids as bytes; `stops` are the ends of the runs."""
    offsets = np.concatenate([[0], 4 * stops]).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(ids))]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(stops), buffers)


def _flat(runs: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all runs, and 0 followed by the end of each run."""
    if not len(runs):
        return np.empty(0, np.int32), np.zeros(1, np.int64)
    _, offsets, data = runs.buffers()
    stops = np.frombuffer(offsets, np.int64)[runs.offset :][: len(runs) + 1] // 4
    ids = np.frombuffer(data or b"", np.int32)[stops[0] : stops[-1]]
    return ids, stops - stops[0]


def _quoted(text: str) -> str:
    """The text as a pattern of Arrow's, each character by its code point."""
    return "".join(rf"\x{{{ord(c):x}}}" for c in text)


class Tokenizer:
    def __init__(self, file: bytes):
        spec = json.loads(file)
        model, added = spec["model"], spec.get("added_tokens") or []
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("ignore_merges"):
            raise ValueError("this vocabulary is not a plain byte-level BPE")
        if spec.get("decoder") is not None:
            raise ValueError("only vocabularies without a decoder are supported")
        suffix = model.get("end_of_word_suffix") or ""
        vocabulary: dict[str, int] = model["vocab"]
        symbols = byte_symbols()
        self.inner = [vocabulary[symbols[b]] for b in range(256)]
        self.last = [vocabulary[symbols[b] + suffix] for b in range(256)]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            merged = vocabulary[left + right]
            self.merges[vocabulary[left], vocabulary[right]] = (rank, merged)
        if 2 * len(self.merges) > PAIR_SLOTS:
            raise ValueError(f"more merges than half of {PAIR_SLOTS}")
        self.pair_keys = np.full(PAIR_SLOTS, -1, np.int64)
        self.pair_ranks = np.full(PAIR_SLOTS, NO_RANK, np.int64)
        keys = np.array([left << 20 | right for left, right in self.merges], np.int64)
        for key, slot, (rank, _) in zip(keys.tolist(), _slots(keys).tolist(), self.merges.values()):
            while self.pair_keys[slot] >= 0:
                slot = (slot + 1) % PAIR_SLOTS
            self.pair_keys[slot], self.pair_ranks[slot] = key, rank
        self.merged = np.array([m for _, m in self.merges.values()], np.int32)
        self.inner_ids = np.array(self.inner, np.int32)
        self.last_ids = np.array(self.last, np.int32)
        self.tokens = {i: t for t, i in vocabulary.items()}
        self.special = {t["content"]: t["id"] for t in added}
        self.tokens |= {t["id"]: t["content"] for t in added}
        texts = [self.tokens.get(i) for i in range(max(self.tokens) + 1)]
        self.texts = pa.array(texts, pa.large_string())
        longest_first = sorted(self.special, key=len, reverse=True)
        self.special_pattern = (
            regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if added else None
        )
        splits = [p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        pattern = splits[0]["pattern"]["Regex"].replace(r"\s", _WHITE)
        self.odd_pattern = "|".join([f"[{SEPARATORS}]", *map(_quoted, longest_first)])
        self.piece_pattern = regex.compile(pattern + r"|\n")
        self.chunk_pattern = regex.compile(f"[^{_WHITE}]+")
        self.chunks, self.pieces = Remembered(), Remembered()

    def merge(self, ids: list[int]) -> list[int]:
        """The symbols of one piece after all merges."""
        merges, n = self.merges, len(ids)
        if n < 2:
            return ids
        absent = (-1, -1)
        tree = PairTree([merges.get(pair, absent)[0] for pair in zip(ids, ids[1:])])
        right = list(range(1, n + 1))
        left = list(range(-1, n - 1))
        alive = [True] * n
        while (at := tree.root()) >= 0:
            gone = right[at]
            ids[at] = merges[ids[at], ids[gone]][1]
            alive[gone] = False
            after = right[at] = right[gone]
            if after < n:
                left[after] = at
                tree.put(at, merges.get((ids[at], ids[after]), absent)[0])
                tree.put(gone, -1)
            else:
                tree.put(at, -1)
            before = left[at]
            if before >= 0:
                tree.put(before, merges.get((ids[before], ids[at]), absent)[0])
        return [ids[k] for k in range(n) if alive[k]]

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; NO_RANK where there is no merge or an id is -1."""
        keys = left.astype(np.int64) << 20 | right
        slots = _slots(keys)
        there = self.pair_keys[slots]
        other = np.nonzero((there != keys) & (there >= 0))
        while len(other[0]):  # another pair is in the slot; this one may be in the next
            slots[other] = (slots[other] + 1) % PAIR_SLOTS
            there = self.pair_keys[slots[other]]
            wrong = (there != keys[other]) & (there >= 0)
            other = tuple(axis[wrong] for axis in other)
        return np.where(self.pair_keys[slots] == keys, self.pair_ranks[slots], NO_RANK)

    def merge_rows(self, ids: np.ndarray) -> None:
        """Merges every row of a matrix of symbols in place; -1 fills the rows and what merges.

        One segment tree per row, kept side by side: each step merges the pair at the root of
        every tree that still has one.
        """
        n, width = ids.shape
        leaves = 1 << max(0, width - 2).bit_length()
        bits, end = leaves.bit_length(), width  # the column `end` stands for no neighbour
        ids_ = np.concatenate([ids, np.full((n, 1), -1, ids.dtype)], axis=1)
        tree = np.full((n, 2 * leaves), NO_RANK, np.int64)
        ranks = self._rank(ids_[:, : width - 1], ids_[:, 1:width])
        place = np.arange(width - 1)
        tree[:, leaves : leaves + width - 1] = np.where(ranks < NO_RANK, ranks << bits | place, NO_RANK)
        for k in range(leaves - 1, 0, -1):
            tree[:, k] = np.minimum(tree[:, 2 * k], tree[:, 2 * k + 1])
        column = np.arange(width + 1)
        right = np.tile(np.minimum(column + 1, end), (n, 1))
        left = np.tile(np.where(column > 0, column - 1, end), (n, 1))

        def put(rows: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
            node = at + leaves
            tree[rows, node] = values

        def lift(rows: np.ndarray, at: np.ndarray) -> None:
            node = at + leaves
            for _ in range(bits - 1):
                node = node >> 1
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

        def leaf(rank: np.ndarray, at: np.ndarray) -> np.ndarray:
            return np.where(rank < NO_RANK, rank << bits | at, NO_RANK)

        rows = np.flatnonzero(tree[:, 1] < NO_RANK)
        while len(rows):
            root = tree[rows, 1]
            at = root & ((1 << bits) - 1)
            merged = self.merged[root >> bits]
            gone = right[rows, at]
            after = right[rows, gone]
            ids_[rows, at] = merged
            ids_[rows, gone] = -1
            right[rows, at] = after
            left[rows, after] = at
            put(rows, at, leaf(self._rank(merged, ids_[rows, after]), at))
            inner = gone < leaves
            put(rows[inner], gone[inner], np.int64(NO_RANK))
            before = left[rows, at]
            has = before < end
            first, at_first = rows[has], before[has]
            put(first, at_first, leaf(self._rank(ids_[first, at_first], merged[has]), at_first))
            lift(rows[inner], gone[inner])
            lift(first, at_first)
            lift(rows, at)
            rows = rows[tree[rows, 1] < NO_RANK]
        ids[:] = ids_[:, :width]

    def _merge_all(self, pieces: pa.Array) -> pa.LargeBinaryArray:
        """The ids of pieces, many of like length at a time."""
        _, starts, data = pieces.buffers()
        starts = np.frombuffer(starts, np.int32)[pieces.offset :][: len(pieces) + 1]
        data = np.frombuffer(data, np.uint8)
        starts, lengths = starts[:-1], np.diff(starts)
        order, merged = [], []
        for at in np.flatnonzero(lengths > WIDEST).tolist():
            symbols = data[starts[at] : starts[at] + lengths[at]]
            ids = [*self.inner_ids[symbols[:-1]].tolist(), int(self.last_ids[symbols[-1]])]
            order.append([at])
            merged.append(pa.array([np.array(self.merge(ids), np.int32).tobytes()], pa.large_binary()))
        least, width = 1, 2
        while least <= WIDEST:
            group = np.flatnonzero((lengths >= least) & (lengths <= width))
            column = np.arange(width + 1)
            for first in range(0, len(group), ROWS_AT_ONCE):
                some = group[first : first + ROWS_AT_ONCE]
                last = lengths[some] - 1
                ids = np.full((len(some), width + 1), -1, np.int32)
                filled = column <= last[:, None]
                ids[filled] = self.inner_ids[data[(starts[some][:, None] + column)[filled]]]
                ids[np.arange(len(some)), last] = self.last_ids[data[starts[some] + last]]
                self.merge_rows(ids)
                left = ids >= 0
                order.append(some)
                merged.append(_binary(ids[left], left.sum(axis=1).cumsum()))
            least, width = width + 1, 2 * width
        return pa.concat_arrays(merged).take(pa.array(np.argsort(np.concatenate(order))))

    def learn(self, chunks: pa.Array) -> pa.LargeBinaryArray:
        """The ids of chunks, runs of text without white space.

        Normalising and cutting never reach across white space, so all chunks are normalised
        and cut in one pass, with newlines between them.
        """
        text = unicodedata.normalize("NFC", "\n".join(chunks.to_pylist()))
        text = text.replace("Σ", "σ").lower()  # no final form of sigma
        cut = pa.array(self.piece_pattern.findall(text), pa.string())
        ends = pc.equal(cut, "\n")
        placed = self.pieces.ids_of(cut.filter(pc.invert(ends)), self._merge_all)
        at = np.flatnonzero(ends.to_numpy(zero_copy_only=False))
        pieces = np.append(at - np.arange(len(at)), len(placed))  # up to the end of each chunk
        flat, stops = _flat(placed)
        ids = _binary(flat, stops[pieces])
        special = pc.is_in(chunks, value_set=pa.array(list(self.special), pa.string()))
        if not pc.any(special).as_py():
            return ids
        own = [np.int32(self.special.get(c, -1)).tobytes() for c in chunks.to_pylist()]
        return pc.if_else(special, pa.array(own, pa.large_binary()), ids)

    def _cut(self, text: str) -> list[str]:
        """The chunks of a text and its special tokens; split() knows four separators more than
        the pattern does."""
        if self.special_pattern is not None and self.special_pattern.search(text):
            parts = self.special_pattern.split(text)
            return [c for p in parts for c in ([p] if p in self.special else self._cut(p))]
        if any(c in text for c in SEPARATORS):
            return self.chunk_pattern.findall(text)
        return text.split()

    def _chunk_lists(self, texts: pa.Array) -> pa.Array:
        """The chunks of each text, empty ones among them; cut by Arrow, whose white space is
        that of split(), where no text has a special token or one of the four separators."""
        if pc.any(pc.match_substring_regex(texts, self.odd_pattern)).as_py():
            cut = [self._cut(text) for text in texts.to_pylist()]
            return pa.array(cut, pa.list_(texts.type))
        return pc.utf8_split_whitespace(texts)

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, none of them null, and how many each text has."""
        self.chunks.age()
        self.pieces.age()
        lists = self._chunk_lists(texts)
        ids, stops = _flat(self.chunks.ids_of(lists.flatten(), self.learn))
        bounds = lists.offsets.to_numpy()
        return ids, np.diff(stops[bounds - bounds[0]])

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as the bytes of 32-bit integers."""
        ids, lengths = self.encode_array(pa.array(texts, pa.string()))
        return [part.tobytes() for part in np.split(ids, lengths.cumsum()[:-1])]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_batch([text])[0], np.int32).tolist()

    def decode(self, ids: list[int]) -> str:
        return self.decode_lists(np.array(ids, np.int32), np.array([0, len(ids)]))[0].as_py()

    def decode_lists(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """The texts of lists of ids, given flat with their offsets."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.texts)):
            raise KeyError("an id is not in the vocabulary")
        words = self.texts.take(pa.array(ids, pa.int32()))
        if words.null_count:
            raise KeyError("an id is not in the vocabulary")
        lists = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), words)
        return pc.binary_join(lists, pa.scalar(" ", pa.large_string()))


_loaded: dict[int, Tokenizer] = {}


def _tokenizer(shared) -> Tokenizer:
    """One tokenizer per worker process and vocabulary; its memory of pieces lasts until
    other operators have had the worker for a while."""
    in_use(_loaded)
    key = hash(shared.value)
    if key not in _loaded:
        _loaded[key] = Tokenizer(shared.value)
    return _loaded[key]


def load_vocabulary(spark: SparkSession, path: str):
    """The vocabulary file as a broadcast value; a file beyond the bound is refused."""
    size = os.path.getsize(path)
    if size > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} has {size} bytes, more than {MAX_VOCABULARY_BYTES}")
    ship_package(spark)
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encode(df: DataFrame, vocabulary, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds the token ids of a text column."""

    @F.arrow_udf("array<int>")
    def encoded(texts: pa.Array) -> pa.Array:
        tokenizer = _tokenizer(vocabulary)
        filled = texts.fill_null("")
        sizes = pc.binary_length(filled).to_numpy(zero_copy_only=False)
        bounds = np.concatenate([[0], sizes.cumsum(dtype=np.int64)])
        out, lengths = [np.empty(0, np.int32)], [np.zeros(1, np.int64)]
        for first, end in parts_of(bounds, TEXT_AT_ONCE):
            ids_of_part, counts = tokenizer.encode_array(filled.slice(first, end - first))
            out.append(ids_of_part)
            lengths.append(counts)
        offsets = np.concatenate(lengths).cumsum().astype(np.int32)
        flat = pa.array(np.concatenate(out))  # the ids of the batch, once
        del out, filled
        give_back()  # texts and ids apart; decoding takes as much again
        return pa.ListArray.from_arrays(pa.array(offsets), flat)

    return df.withColumn(ids, encoded(F.col(text)))


def parts_of(offsets: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Runs of lists with at most that many values together, or of one list that has more."""
    parts, first, last = [], 0, len(offsets) - 1
    while first < last:
        end = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        parts.append((first, min(max(end, first + 1), last)))
        first = parts[-1][1]
    return parts


def decode(df: DataFrame, vocabulary, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds the text of a column of token ids, special tokens included."""

    @F.arrow_udf("string")
    def decoded(lists: pa.Array) -> pa.Array:
        filled = lists.fill_null([])
        offsets = filled.offsets.to_numpy().astype(np.int64)
        values = filled.values.to_numpy(zero_copy_only=False)
        tokenizer = _tokenizer(vocabulary)
        parts = []
        for first, end in parts_of(offsets, IDS_AT_ONCE):
            flat = values[offsets[first] : offsets[end]]
            texts = tokenizer.decode_lists(flat, offsets[first : end + 1] - offsets[first])
            parts.append(texts.cast(pa.string()))
        decoded_texts = pa.concat_arrays(parts) if parts else pa.array([], pa.string())
        del parts
        give_back()
        return decoded_texts

    return df.withColumn(text, decoded(F.col(ids)))
