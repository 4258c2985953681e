"""SentencePiece encoding and decoding through a table of distinct words.

No piece of a supported vocabulary holds a white-space marker after another character, so no
merge reaches across the place before a marker, and none touches a line end, which stands in no
piece. A text is cut there, into marked words; each batch of texts gives a table of its distinct
words, every word of it is segmented once, many of like length side by side, and the ids are
joined back by position. A worker remembers the words it has segmented, within a bound in bytes:
of two generations the older one goes, and a word found in it moves to the younger.

Segmenting merges, again and again, the adjacent pair whose union is the piece of best score,
the leftmost of equals. Characters that end in no piece become their bytes. A word of n
characters takes n log n steps, however long it is.

The model file is read once on the driver, its size is checked, and it is broadcast. It must be
a BPE model with byte fallback that leaves characters as they are (no character map, a marker
before the text); others are refused.

Defined results: a null or empty text has no ids and decodes to the empty text. Null ids decode
to the empty text, an unknown id is an error, bytes that are no UTF-8 decode to U+FFFD one by
one. A result column replaces an input column of its name; all others are carried along.
"""

from __future__ import annotations

import heapq
import os
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm.common import in_use, ship_package

MAX_MODEL_BYTES = 64 << 20
#: Bytes of remembered words per generation, with what Python keeps for each; checked between
#: batches of texts.
REMEMBERED_BYTES = 96 << 20
ENTRY_BYTES = 200
#: Words of more characters are merged with a heap, each by itself.
LONG = 48
#: Slots of the hash table of mergeable pairs, a power of two; the model must fill half at most.
PAIR_SLOTS = 1 << 19
#: Characters of text taken at a time.
AT_ONCE = 1 << 20
MARK = "▁"
#: Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
_NEVER = 1 << 60
_LAST = np.int32(2**31 - 1)


def _slots(keys: np.ndarray) -> np.ndarray:
    """Where in the hash table of pairs to look first."""
    mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - PAIR_SLOTS.bit_length() + 1)).astype(np.int64)


class Model:
    def __init__(self, file: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(file)
        rules, trained = proto.normalizer_spec, proto.trainer_spec
        kinds = {piece.type for piece in proto.pieces}
        if trained.model_type != trained.BPE or not trained.byte_fallback:
            raise ValueError("only BPE models with byte fallback are supported")
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces:
            raise ValueError("only models that leave the characters of a text are supported")
        if not (rules.add_dummy_prefix and rules.escape_whitespaces):
            raise ValueError("only models with a marker before the text are supported")
        if trained.treat_whitespace_as_suffix or not kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("only markers before words and plain pieces are supported")
        plain = [(i, p) for i, p in enumerate(proto.pieces) if p.type == NORMAL]
        if any(MARK in p.piece.lstrip(MARK) for _, p in plain):
            raise ValueError("a piece holds a marker after another character")
        self.ids = {p.piece: i for i, p in plain}
        # the order of merging: best score first; pieces of equal score share a place
        places = {s: k for k, s in enumerate(sorted({p.score for _, p in plain}, reverse=True))}
        self.place = {p.piece: places[p.score] for _, p in plain}
        self.byte_ids = [0] * 256
        self.surface: list[bytes] = []
        self.is_byte, self.marked, self.silent = np.zeros((3, len(proto.pieces)), bool)
        for i, p in enumerate(proto.pieces):
            value = p.piece.replace(MARK, " ").encode()
            if p.type == BYTE:
                byte = int(p.piece[3:5], 16)  # <0xHH>
                self.byte_ids[byte], value = i, bytes([byte])
                self.is_byte[i] = True
            elif p.type == CONTROL:
                value, self.silent[i] = b"", True
            elif p.type == UNKNOWN:
                value = trained.unk_surface.encode()
            else:
                self.marked[i] = p.piece.startswith(MARK)
            self.surface.append(value)
        # after the surfaces of all pieces the same without the marker before a text
        unmarked = [s[1:] if marked else s for s, marked in zip(self.surface, self.marked)]
        self.surfaces = pa.array(self.surface + unmarked, pa.large_binary())
        # line ends stand alone where they are in no piece
        self.alone = "" if any("\n" in piece for piece in self.ids) else "\n"
        self.word = re.compile(f"{MARK}+[^{MARK}{self.alone}]*|{self.alone or MARK}|[^{MARK}{self.alone}]+")
        # pairs of pieces whose union is a piece, in a hash table for many lookups at once
        self.pair_keys = np.full(PAIR_SLOTS, -1, np.int64)
        self.pair_places = np.full(PAIR_SLOTS, _LAST, np.int32)
        self.pair_ids = np.zeros(PAIR_SLOTS, np.int32)
        n_pairs = 0
        for piece, i in self.ids.items():
            if 2 * n_pairs > PAIR_SLOTS:
                raise ValueError(f"more mergeable pairs than half of {PAIR_SLOTS}")
            for k in range(1, len(piece)):
                left, right = self.ids.get(piece[:k]), self.ids.get(piece[k:])
                if left is not None and right is not None:
                    key = left << 32 | right
                    slot = int(_slots(np.array([key]))[0])
                    while self.pair_keys[slot] >= 0:
                        slot = (slot + 1) % PAIR_SLOTS
                    self.pair_keys[slot] = key
                    n_pairs += 1
                    self.pair_places[slot], self.pair_ids[slot] = self.place[piece], i
        self.character_ids = np.full(0x110000, -1, np.int32)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.character_ids[ord(piece)] = i
        # ids of the words segmented so far, in two generations
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.young_bytes = 0

    # ---- encoding ----------------------------------------------------------

    def _merge_short(self, symbols: list[str]) -> list[str]:
        place = self.place
        places = [place.get(a + b, _NEVER) for a, b in zip(symbols, symbols[1:])]
        while places:
            best = min(places)
            if best == _NEVER:
                break
            k = places.index(best)  # the leftmost
            merged = symbols[k] + symbols[k + 1]
            symbols[k : k + 2] = [merged]
            del places[k]
            if k < len(places):
                places[k] = place.get(merged + symbols[k + 1], _NEVER)
            if k:
                places[k - 1] = place.get(symbols[k - 1] + merged, _NEVER)
        return symbols

    def _merge_long(self, symbols: list[str]) -> list[str]:
        """The same merges; candidates wait in a heap and are dropped when outdated."""
        place, n = self.place, len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        waiting: list[tuple[int, int, str]] = []
        for k in range(n - 1):
            union = symbols[k] + symbols[k + 1]
            if union in place:
                waiting.append((place[union], k, union))
        heapq.heapify(waiting)
        while waiting:
            _, k, union = heapq.heappop(waiting)
            gone = after[k]
            if gone >= n or not symbols[k] or symbols[k] + symbols[gone] != union:
                continue
            symbols[k], symbols[gone] = union, ""
            after[k] = after[gone]
            if after[k] < n:
                before[after[k]] = k
                longer = union + symbols[after[k]]
                if longer in place:
                    heapq.heappush(waiting, (place[longer], k, longer))
            if before[k] >= 0:
                longer = symbols[before[k]] + union
                if longer in place:
                    heapq.heappush(waiting, (place[longer], before[k], longer))
        return [s for s in symbols if s]

    def segment(self, word: str) -> list[int]:
        """The ids of one word."""
        merge = self._merge_short if len(word) <= LONG else self._merge_long
        ids = []
        for symbol in merge(list(word)):
            known = self.ids.get(symbol)
            if known is None:
                ids += [self.byte_ids[b] for b in symbol.encode()]
            else:
                ids.append(known)
        return ids

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and ids of the unions of pairs; _LAST where there is none."""
        keys = left.astype(np.int64) << 32 | right
        slots = _slots(keys)
        there = self.pair_keys[slots]
        other = np.nonzero((there != keys) & (there >= 0))
        while len(other[0]):  # another pair is in the slot; this one may be in the next
            slots[other] = (slots[other] + 1) % PAIR_SLOTS
            there = self.pair_keys[slots[other]]
            wrong = (there != keys[other]) & (there >= 0)
            other = tuple(axis[wrong] for axis in other)
        found = self.pair_keys[slots] == keys
        return np.where(found, self.pair_places[slots], _LAST), self.pair_ids[slots]

    def _segment_rows(self, symbols: np.ndarray) -> np.ndarray:
        """The ids of many words of like length, one per row; -1 fills the rows."""
        n, width = symbols.shape
        rows = np.arange(n)
        out = np.full_like(symbols, -1)
        places, unions = self._pairs(symbols[:, :-1], symbols[:, 1:])
        column = np.arange(width)
        while True:
            best = places.argmin(axis=1)  # the leftmost of equals
            going = places[np.arange(len(rows)), best] < _LAST
            out[rows[~going], : symbols.shape[1]] = symbols[~going]
            if not going.any():
                return out
            rows, best = rows[going], best[going]
            symbols, places, unions = symbols[going], places[going], unions[going]
            at = np.arange(len(rows))
            symbols[at, best] = unions[at, best]
            # close the gap: the right part of the pair goes, and its place with it
            width -= 1
            onward = column[None, :width] + (column[None, :width] > best[:, None])
            symbols = np.take_along_axis(symbols, onward, axis=1)
            if width == 1:
                places = np.full((len(rows), 1), _LAST, np.int32)
                unions = np.zeros((len(rows), 1), np.int32)
                continue
            onward = column[None, : width - 1] + (column[None, : width - 1] >= best[:, None])
            places = np.take_along_axis(places, onward, axis=1)
            unions = np.take_along_axis(unions, onward, axis=1)
            for side in (best - 1, best):
                has = (side >= 0) & (side < width - 1)
                r, k = at[has], side[has]
                places[r, k], unions[r, k] = self._pairs(symbols[r, k], symbols[r, k + 1])

    def _segment_all(self, words: Iterable[str]) -> dict[str, bytes]:
        """The ids of new words, as the bytes of 32-bit integers."""
        table: dict[str, bytes] = {}
        groups: dict[int, list[str]] = {}
        for word in words:
            groups.setdefault((len(word) + 3) // 4, []).append(word)
        for fours, group in groups.items():
            if not fours or 4 * fours > LONG:
                for word in group:
                    table[word] = np.array(self.segment(word), np.int32).tobytes()
                continue
            lengths = np.fromiter(map(len, group), np.int64, len(group))
            characters = np.frombuffer("".join(group).encode("utf-32-le"), np.uint32)
            symbols = np.full((len(group), 4 * fours), -1, np.int32)
            filled = np.arange(4 * fours) < lengths[:, None]
            symbols[filled] = self.character_ids[characters]
            ids = self._segment_rows(symbols)
            left = ids >= 0
            flat, ends = ids[left].tobytes(), (4 * left.sum(axis=1).cumsum()).tolist()
            for word, start, end in zip(group, [0, *ends], ends):
                table[word] = flat[start:end]
            # characters of no piece become bytes, which the rows cannot hold
            for k in np.flatnonzero((symbols < 0).sum(axis=1) > 4 * fours - lengths).tolist():
                table[group[k]] = np.array(self.segment(group[k]), np.int32).tobytes()
        return table

    def cut(self, text: str) -> list[str]:
        """Marked words: a marker, or several, with what follows up to the next one; line ends
        stand alone."""
        if not text:
            return []
        if "  " in text or MARK in text or text[0] == " ":
            return self.word.findall(MARK + text.replace(" ", MARK))
        marked = MARK + text.replace(" ", " " + MARK)
        if self.alone:
            marked = marked.replace("\n", " \n ")
        return marked.split(" ")

    def _learn(self, fresh: set[str]) -> None:
        """Adds words to the younger generation, from the older one or segmented."""
        old = self.old
        found = {word: old[word] for word in fresh if word in old}
        found |= self._segment_all([word for word in fresh if word not in found])
        self.young |= found
        self.young_bytes += sum(map(len, found)) + sum(map(len, found.values()))
        self.young_bytes += ENTRY_BYTES * len(found)

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as the bytes of 32-bit integers."""
        if self.young_bytes > REMEMBERED_BYTES:
            self.old, self.young, self.young_bytes = self.young, {}, 0
        known = self.young.get
        cut = [self.cut(text) for text in texts]
        found = [list(map(known, words)) for words in cut]
        gaps = [k for k, ids in enumerate(found) if None in ids]
        self._learn({w for k in gaps for w, ids in zip(cut[k], found[k]) if ids is None})
        for k in gaps:
            found[k] = [known(w) if ids is None else ids for w, ids in zip(cut[k], found[k])]
        return list(map(b"".join, found))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_batch([text])[0], np.int32).tolist()

    # ---- decoding ----------------------------------------------------------

    def decode_lists(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """The texts of lists of ids, given flat with their offsets."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.surface)):
            raise ValueError("an id is not in the vocabulary")
        if self.silent[ids].any():
            said = ~self.silent[ids]
            offsets = np.concatenate([[0], said.cumsum()])[offsets]
            ids = ids[said]
        # the marker before the text is the first character of its first piece
        starts = offsets[:-1][offsets[1:] > offsets[:-1]]
        ids = ids.astype(np.int32)  # a copy
        ids[starts] += len(self.surface)
        flat = self.surfaces.take(pa.array(ids, pa.int32()))
        lists = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), flat)
        joined = pc.binary_join(lists, pa.scalar(b"", pa.large_binary()))
        try:
            return joined.cast(pa.large_string())
        except pa.ArrowInvalid:  # bytes that are no UTF-8
            pairs = zip(offsets.tolist(), offsets[1:].tolist())
            whole = [self._decode_slowly(ids[a:b].tolist()) for a, b in pairs]
            return pa.array(whole, pa.large_string())

    def _decode_slowly(self, ids: list[int]) -> str:
        parts, run = [], b""
        for i in ids:
            if self.is_byte[i % len(self.surface)]:
                run += self.surfaces[i].as_py()
                continue
            parts += [utf8_or_marks(run), self.surfaces[i].as_py().decode()]
            run = b""
        return "".join([*parts, utf8_or_marks(run)])


def utf8_or_marks(data: bytes) -> str:
    """Characters where the bytes are UTF-8, U+FFFD for each byte that is not."""
    out, k = [], 0
    while k < len(data):
        for width in (1, 2, 3, 4):
            try:
                out.append(data[k : k + width].decode())
                k += width
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            k += 1
    return "".join(out)


_loaded: dict[int, Model] = {}


def _model(shared) -> Model:
    """One model per worker process and file; its memory of words lasts until other
    operators have had the worker for a while."""
    in_use(_loaded)
    key = hash(shared.value)
    if key not in _loaded:
        _loaded[key] = Model(shared.value)
    return _loaded[key]


def load_model(spark: SparkSession, path: str):
    """The model file as a broadcast value; a file beyond the bound is refused."""
    size = os.path.getsize(path)
    if size > MAX_MODEL_BYTES:
        raise ValueError(f"{path} has {size} bytes, more than {MAX_MODEL_BYTES}")
    ship_package(spark)
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def _groups(texts: Iterable) -> Iterable[list[str]]:
    """The texts in turn, some at a time."""
    waiting: list[str] = []
    size = 0
    for value in texts:
        waiting.append(value.as_py() or "")
        size += len(waiting[-1])
        if size >= AT_ONCE:
            yield waiting
            waiting, size = [], 0
    yield waiting


def encode(df: DataFrame, shared, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds the ids of a text column, without begin or end ids."""

    @F.arrow_udf("array<int>")
    def encoded(texts: pa.Array) -> pa.Array:
        model = _model(shared)
        out = [ids for group in _groups(texts) for ids in model.encode_batch(group)]
        lengths = np.fromiter(map(len, out), np.int64, len(out)) // 4
        offsets = np.concatenate([[0], lengths.cumsum()]).astype(np.int32)
        flat = pa.array(np.frombuffer(b"".join(out), np.int32))
        return pa.ListArray.from_arrays(pa.array(offsets), flat)

    return df.withColumn(ids, encoded(F.col(text)))


def decode(df: DataFrame, shared, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds the text of a column of ids."""

    @F.arrow_udf("string")
    def decoded(lists: pa.Array) -> pa.Array:
        filled = lists.fill_null([])
        offsets = filled.offsets.to_numpy().astype(np.int64)
        values = filled.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
        return _model(shared).decode_lists(values, offsets - offsets[0]).cast(pa.string())

    return df.withColumn(text, decoded(F.col(ids)))
