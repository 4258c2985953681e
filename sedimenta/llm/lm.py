"""Language-model scores from a log-frequency Bloom filter.

Unigrams and bigrams of the training texts are counted exactly: every task sums its own part, and
Spark adds the parts up by hash. A count c is kept as its logarithmic level, and the filter holds an
n-gram once for each level up to its own. Reading probes level after level until one is
missing, which gives the quantised count; a false hit can only raise it. All bits of an n-gram lie
in one block of 512 bits, and blocks form segments by the n-gram's hash, so the filter is built
segment by segment where the counts lie, without gathering n-grams.

The filter's size follows the number of its entries at every scale; no n-gram is dropped. Up to
MAX_BITS it is one broadcast. Beyond, words and bigrams have a filter each, cut by n-gram hash into
parts of at most MAX_BITS, each a broadcast of its own. The exact base score needs the count of
every word; the table of words is broadcast in blocks of segments of about BLOCK_WORDS words. So no
broadcast grows with the data, but their number does.

The texts are read once, however many parts and blocks there are: the tokens of some texts wait in
a worker while it looks them up in one part or block after the other, and it holds one of them at a
time. Probabilities are smoothed with a Dirichlet prior: (bigram + PRIOR * unigram probability) /
(context + PRIOR), where the unigram probability adds one to the counts.

Defined results: a null or empty text is its end token alone; without training texts all
counts are zero. Repeated rows are scored alike. Text columns are read whole, other columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import ship_package, stored

SEGMENTS = 4096
BLOCK_BITS = 512
HASHES = 4
MAX_BITS = 1 << 29
BITS_PER_ENTRY = 1.44 * HASHES
BASES = {1: 2**0.25, 2: 2.0}  # of the levels, by order
PRIOR = 8.0
BLOCK_WORDS = 8_000_000
#: Bytes of texts that are counted, or scored, at once; a longer text is by itself.
_COUNTED_AT_ONCE, _SCORED_AT_ONCE = 6 << 20, 2 << 20
_HASHED_AT_ONCE = 1 << 18
#: Tokens that wait together for the parts and blocks, where there are several: some 20 bytes each.
_WAIT_TOGETHER = 1 << 22
_UPPER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_SPACE = b" \t\n\r\x0b\x0c"
END = xxhash.xxh3_64_intdigest(b"\nend")  # no word holds a newline
START = xxhash.xxh3_64_intdigest(b"\nstart")
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)

def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


@lru_cache(1)
def _byte_values() -> np.ndarray:
    """A random number for each byte, the same for A-Z and a-z, 0 for white space."""
    values = np.random.RandomState(29).randint(0, 1 << 64, 256, dtype=np.uint64)
    values = values[np.frombuffer(bytes(range(256)).translate(_UPPER), np.uint8)]
    values[list(_SPACE)] = 0
    return values


@lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number and of its inverse, modulo 2 ** 64."""
    odd = 0x9E3779B97F4A7C15
    both = []
    for base in (odd, pow(odd, -1, 1 << 64)):
        powers = np.full(n, base, np.uint64)
        powers[0] = 1
        both.append(np.multiply.accumulate(powers))
    return both[0], both[1]


def _word_sums(data: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A number for each word, by which words of a chunk are told apart: the values of its bytes
    times powers. `first`: where the words begin; what stands between them is white space."""
    out = np.empty(len(first), np.uint64)
    low = 0
    while low < len(first):
        high = max(low + 1, int(np.searchsorted(first, first[low] + _HASHED_AT_ONCE)))
        start, end = first[low], first[high] if high < len(first) else len(data)
        powers, inverse = _powers(max(2 * _HASHED_AT_ONCE, 1 << int(end - start).bit_length()))
        at = first[low:high] - start
        values = _byte_values()[data[start:end]] * powers[: end - start]
        out[low:high] = np.add.reduceat(values, at) * inverse[at]
        low = high
    return out


def _tokenised(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct tokens of several texts, which of them each token is, and where each
    text starts. The tokens of a text are its words and its end."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, content = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(content or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    blank = np.ones(len(data) + 1, bool)
    blank[:-1] = np.isin(np.arange(256), list(_SPACE))[data]
    opens = ~blank
    opens[1:] &= blank[:-1]  # texts stand back to back, so a word begins at the start of one too
    opens[offsets] = ~blank[offsets]
    closes = blank | opens
    closes[1:] &= ~blank[:-1]
    closes[0] = False
    first, ends = np.flatnonzero(opens), np.flatnonzero(closes)
    del blank, opens, closes
    which, own = pd.factorize(_word_sums(data, first))
    # one occurrence of each distinct word is hashed
    of = np.empty(len(own), np.int64)
    of[which] = np.arange(len(first))
    spans = zip(first[of].tolist(), ends[of].tolist())
    del ends
    raw = bytes(data).translate(_UPPER)
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in spans), np.uint64, len(of))
    del raw
    # behind the words of each text stands its end
    last = np.searchsorted(first, offsets[1:]) + np.arange(len(texts))
    place = np.full(len(first) + len(texts), len(hashes), np.int64)
    inner = np.ones(len(place), bool)
    inner[last] = False
    place[inner] = which
    return np.append(hashes, np.uint64(END)), place, np.concatenate([[0], last[:-1] + 1])


def contexts_of(tokens: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The token before each token; START at the starts of texts."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[starts] = START
    return before


def bigrams(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return _mixed(before * np.uint64(3) + tokens)


def _chunks(texts: pa.Array, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The tokens of several texts at a time, of `most` bytes together or one text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    low = 0
    while low < len(texts):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield _tokenised(texts.slice(low, high - low))
        low = high


def _distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ones and which of them each is."""
    which, own = pd.factorize(h)
    return own, which


def count(texts: DataFrame, text: str = "text") -> DataFrame:
    """n_order, segment, h and n: the exact count of every unigram and bigram."""
    ship_package(texts.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, place, starts in _chunks(batch.column(0), _COUNTED_AT_ONCE):
                singles = _mixed(words), np.bincount(place, minlength=len(words))
                tokens = words[place]
                del place  # a chunk's arrays are let go of before the next one is read
                pairs = np.unique(bigrams(contexts_of(tokens, starts), tokens), return_counts=True)
                del tokens
                for order, (h, n) in ((1, singles), (2, pairs)):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(h), order, np.int8)),
                            pa.array((h >> np.uint64(52)).astype(np.int16)),
                            pa.array(h.view(np.int64)),
                            pa.array(n, pa.int64()),
                        ],
                        ["n_order", "segment", "h", "n"],
                    )

    parts = texts.select(text).mapInArrow(
        counted, "n_order tinyint, segment smallint, h bigint, n bigint"
    )
    return (
        parts.repartition("segment")
        .groupBy("n_order", "segment", "h")
        .agg(F.sum("n").alias("n"))
        .sortWithinPartitions("segment")
    )


def level(n: np.ndarray, order: int) -> np.ndarray:
    """1 for a count of one, one more with each factor of the base; in integers, by thresholds."""
    return np.searchsorted(_thresholds(order), n, side="right")


def _thresholds(order: int) -> np.ndarray:
    """The least count of each level, strictly rising."""
    base, out = BASES[order], [1]
    while out[-1] < 1 << 60:
        out.append(max(out[-1] + 1, math.ceil(base ** (len(out)))))
    return np.array(out, np.int64)


def _values(order: int) -> np.ndarray:
    """The count that each level stands for, 0 for none: the geometric middle of its range."""
    least = _thresholds(order).astype(float)
    return np.concatenate([[0.0], np.sqrt(least[:-1] * np.maximum(least[:-1], least[1:] - 1)), least[-1:]])


def _block(h: np.ndarray, blocks: int) -> np.ndarray:
    """The block of an n-gram within its segment."""
    return ((h << np.uint64(12)) >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)


def _bits(h: np.ndarray, order: int, of: int, blocks: int) -> np.ndarray:
    """Positions within the segment, all parts, of the HASHES bits of an n-gram at a level."""
    block = _block(h, blocks)
    mix = _mixed(h + np.uint64((of * 2 + order) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    place = np.stack([(mix >> np.uint64(9 * k)) & np.uint64(511) for k in range(HASHES)])
    return block * np.uint64(BLOCK_BITS) + place


class Filter:
    """One part of a filter; blocks are those of the part, per segment."""

    def __init__(self, data: np.ndarray, blocks: int, part: int = 0, parts: int = 1):
        self.data, self.blocks, self.part, self.parts = data, blocks, part, parts

    def holds(self, h: np.ndarray) -> np.ndarray:
        """Whether the part is the one of an n-gram."""
        if self.parts == 1:
            return np.ones(len(h), bool)
        return _block(h, self.blocks * self.parts) // np.uint64(self.blocks) == self.part

    def levels(self, h: np.ndarray, order: int) -> np.ndarray:
        """The highest level up to which all levels of an n-gram are found; 0 in other parts."""
        found = np.zeros(len(h), np.int64)
        rest = np.flatnonzero(self.holds(h))
        size = self.blocks * BLOCK_BITS
        base = (h >> np.uint64(52)) * np.uint64(size) - np.uint64(self.part * size)
        for of in range(1, len(_thresholds(order)) + 1):
            bits = _bits(h[rest], order, of, self.blocks * self.parts) + base[rest]
            hit = self.data[bits >> np.uint64(3)] >> (bits & np.uint64(7)).astype(np.uint8) & 1
            rest = rest[hit.all(axis=0)]
            if not len(rest):
                break
            found[rest] = of
        return found

    def counts(self, h: np.ndarray, order: int) -> np.ndarray:
        return _values(order)[self.levels(h, order)]


@dataclass
class Table:
    """A filter in parts by n-gram hash."""

    parts: int
    blocks: int  # of BLOCK_BITS, per segment of a part
    rows: DataFrame  # part, segment and bits
    shared: object  # broadcast bytes, when there is one part

    def load(self, part: int):
        """The bytes of one part as a broadcast."""
        if self.shared is not None:
            return self.shared
        return _gathered(self.rows.where(F.col("part") == part), self.blocks)

    def load_all(self) -> list:
        """All parts, gathered one after the other."""
        return [self.load(part) for part in range(self.parts)]


@dataclass
class Model:
    counts: DataFrame  # of all n-grams, stored
    n_tokens: int
    n_words: int  # distinct tokens
    words: Table
    pairs: Table  # the same table while all fits one part

    @property
    def filter(self):
        return self.pairs.shared

    @property
    def blocks(self) -> int:
        return self.pairs.blocks


def _entries(counts: DataFrame) -> dict[tuple[int, int], int]:
    """N-grams by order and the power of two below their count: some dozens of rows."""
    power = F.floor(F.log2("n")).cast("int")
    rows = counts.groupBy("n_order", power.alias("power")).count().collect()
    return {(r["n_order"], r["power"]): r["count"] for r in rows}


def sized(entries: dict[tuple[int, int], int]) -> tuple[int, int]:
    """Parts of at most MAX_BITS, and blocks per segment of a part, for all entries."""

    def levels(order: int, power: int) -> int:
        return int(level(np.array([2 ** (power + 1) - 1]), order)[0])

    total = sum(n * levels(order, power) for (order, power), n in entries.items())
    bits = total * BITS_PER_ENTRY
    parts = math.ceil(bits / MAX_BITS) or 1
    return parts, math.ceil(bits / parts / SEGMENTS / BLOCK_BITS) or 1


def fit(texts: DataFrame, text: str = "text") -> Model:
    """Counts the n-grams of all texts and builds the filter."""
    counts = stored(count(texts, text), "ngram-counts")
    words = counts.where(F.col("n_order") == 1).agg(F.sum("n"), F.count(F.lit(1))).first()
    entries = _entries(counts)
    parts, blocks = sized(entries)
    if parts == 1:
        tables = [_table(counts, parts, blocks)] * 2
    else:
        tables = [
            _table(
                counts.where(F.col("n_order") == order),
                *sized({key: n for key, n in entries.items() if key[0] == order}),
            )
            for order in (1, 2)
        ]
    return Model(counts, words[0] or 0, words[1], *tables)


def _gathered(rows: DataFrame, blocks: int):
    """Broadcast bytes of the segments of one part."""
    size = blocks * BLOCK_BITS // 8
    data = np.zeros(SEGMENTS * size, np.uint8)
    built = rows.select("segment", "bits").toArrow()  # at most MAX_BITS, and a segment for each task
    for segment, bits in zip(built.column("segment"), built.column("bits")):
        at = segment.as_py() * size
        data[at : at + size] |= np.frombuffer(bits.as_buffer(), np.uint8)
    return rows.sparkSession.sparkContext.broadcast(data.tobytes())


def _table(counts: DataFrame, parts: int, blocks: int) -> Table:
    """Builds the filter of these n-grams where their counts lie."""
    size = blocks * BLOCK_BITS // 8  # bytes of a segment of a part

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, bits = None, np.zeros(parts * size * 8, bool)

        def done() -> pa.RecordBatch:
            data = np.packbits(bits, bitorder="little").tobytes()
            cut = [data[k * size : (k + 1) * size] for k in range(parts)]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(range(parts), pa.int32()),
                    pa.array([now] * parts, pa.int32()),
                    pa.array(cut, pa.binary()),
                ],
                ["part", "segment", "bits"],
            )

        for batch in batches:
            order = batch.column(0).to_numpy()
            segment = batch.column(1).to_numpy()
            h = batch.column(2).to_numpy().view(np.uint64)
            n = batch.column(3).to_numpy()
            cuts = np.flatnonzero(np.diff(segment)) + 1
            for low, high in zip([0, *cuts], [*cuts, len(segment)]):
                if low == high:
                    continue
                if now != segment[low]:
                    if now is not None:
                        yield done()
                    now = int(segment[low])
                    bits[:] = False
                for own in (1, 2):
                    mine = order[low:high] == own
                    grams, top = h[low:high][mine], level(n[low:high][mine], own)
                    for of in range(1, int(top.max(initial=0)) + 1):
                        bits[_bits(grams[top >= of], own, of, parts * blocks).ravel()] = True
        if now is not None:
            yield done()

    rows = counts.mapInArrow(segments, "part int, segment int, bits binary")
    if parts == 1:
        return Table(parts, blocks, rows, _gathered(rows, blocks))
    rows = rows.repartition(parts, "part").sortWithinPartitions("part")
    return Table(parts, blocks, stored(rows, "ngram-filter"), None)


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts)


class _Tokens:
    """The tokens of a chunk of texts, and what is known of them so far; parts and blocks add to it."""

    def __init__(self, words: np.ndarray, place: np.ndarray, starts: np.ndarray, waits: bool):
        tokens = words[place]
        self.words, self.place, self.starts = _mixed(words), place, starts
        self.grams, self.pair_of = _distinct(bigrams(contexts_of(tokens, starts), tokens))
        if waits:  # in half the memory
            self.place, self.pair_of = place.astype(np.int32), self.pair_of.astype(np.int32)
        self.single = np.zeros(len(words), np.uint8)  # levels
        self.pair = np.zeros(len(self.grams), np.uint8)
        self.counts = np.zeros(len(words), np.int64)  # exact ones

    def sums(self, total: int) -> tuple[np.ndarray, ...]:
        """n_tokens, score, n_known and log_sum of each text."""
        place, starts = self.place, self.starts
        single = _values(1)[self.single][place]
        context = np.empty_like(single)
        context[1:] = single[:-1]
        # every text has one start and one end, so the end's count is the start's
        context[starts] = single[-1]
        pair = np.minimum(_values(2)[self.pair][self.pair_of], np.minimum(context, single))
        prior = (single + 1) / total
        logs = np.log10((pair + PRIOR * prior) / (context + PRIOR))
        n_known = _sums((self.counts > 0).astype(np.int64)[place], starts)
        log_sum = _sums(np.log10(self.counts + 1.0)[place], starts)
        return np.diff([*starts, len(place)]), _sums(logs, starts), n_known, log_sum


def _waiting(texts: pa.Array, most: int) -> Iterator[list[_Tokens]]:
    """The chunks of several texts, some at a time that have about `most` tokens together."""
    some, n = [], 0
    for chunk in _chunks(texts, _SCORED_AT_ONCE):
        some.append(_Tokens(*chunk, waits=most > 0))
        n += len(some[-1].place)
        if n >= most:
            yield some
            some, n = [], 0
    if some:
        yield some


def _reader(table: Table):
    """Makes the filter of a part from its broadcast; without the table's rows, for the workers."""
    blocks, parts = table.blocks, table.parts
    return lambda data, part: Filter(np.frombuffer(data, np.uint8), blocks, part, parts)


def _in_turn(shared: list, look_up) -> None:
    """Calls look_up with the number and the value of each broadcast; where there are several, a
    worker lets go of one before it reads the next."""
    for part, one in enumerate(shared):
        look_up(part, one.value)
        if len(shared) > 1 and hasattr(one, "_path"):  # the file that it is read from again
            vars(one).pop("_value", None)


def _counts_in(block: tuple[np.ndarray, np.ndarray, int, int], own: np.ndarray) -> np.ndarray:
    """The exact counts of words; 0 in other blocks."""
    words, counts, low, high = block
    out = np.zeros(len(own), np.int64)
    segment = own >> np.uint64(52)
    mine = np.flatnonzero((segment >= low) & (segment < high))
    if len(words) and len(mine):
        at = np.minimum(np.searchsorted(words, own[mine]), len(words) - 1)
        out[mine] = np.where(words[at] == own[mine], counts[at], 0)
    return out


def _with_sums(
    df: DataFrame, model: Model, text: str, words: list, pairs: list, blocks: list
) -> DataFrame:
    """Adds _sums, in one pass over the texts: n_tokens; score, the log10 probability of the text;
    n_known and log_sum, its tokens in training texts and the sum of log10(count + 1). Broadcasts:
    all parts of both filters, and the blocks of words whose exact counts are asked for."""
    ship_package(df.sparkSession)
    total = model.n_tokens + model.n_words + 1
    words_of, pairs_of = _reader(model.words), _reader(model.pairs)
    most = _WAIT_TOGETHER if max(map(len, (words, pairs, blocks))) > 1 else 0

    @F.arrow_udf("struct<n_tokens: bigint, score: double, n_known: bigint, log_sum: double>")
    def summed(texts: pa.Array) -> pa.Array:
        sums, some = [], []

        def look_up_words(part: int, data: bytes) -> None:
            known = words_of(data, part)
            for tokens in some:
                tokens.single += known.levels(tokens.words, 1).astype(np.uint8)

        def look_up_pairs(part: int, data: bytes) -> None:
            known = pairs_of(data, part)
            for tokens in some:
                tokens.pair += known.levels(tokens.grams, 2).astype(np.uint8)

        def look_up_counts(_: int, block: tuple[np.ndarray, np.ndarray, int, int]) -> None:
            for tokens in some:
                tokens.counts += _counts_in(block, tokens.words)

        for some in _waiting(texts, most):
            _in_turn(words, look_up_words)
            _in_turn(pairs, look_up_pairs)
            _in_turn(blocks, look_up_counts)
            sums += [tokens.sums(total) for tokens in some]
        names = ["n_tokens", "score", "n_known", "log_sum"]
        types = [pa.int64(), pa.float64(), pa.int64(), pa.float64()]
        columns = [np.concatenate(c) for c in zip(*sums)] or [np.zeros(0)] * 4
        return pa.StructArray.from_arrays([pa.array(c).cast(t) for c, t in zip(columns, types)], names)

    return df.withColumn("_sums", summed(F.col(text)))


def with_score(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds n_tokens and score, the log10 probability of the text under the model."""
    return (
        _with_sums(df, model, text, model.words.load_all(), model.pairs.load_all(), [])
        .withColumns({c: F.col(f"_sums.{c}") for c in ("n_tokens", "score")})
        .drop("_sums")
    )


def _word_block(model: Model, block: int, blocks: int):
    """Broadcast hashes, sorted, and exact counts of the words of one block, about BLOCK_WORDS of them
    at most, and the segments it has."""
    low, high = (SEGMENTS * k // blocks for k in (block, block + 1))
    rows = model.counts.where(
        (F.col("n_order") == 1) & F.col("segment").between(low, high - 1)
    ).select("h", F.col("n"))
    table = rows.toArrow()
    h, n = table.column("h").to_numpy().view(np.uint64), table.column("n").to_numpy()
    if len(n) == 0 or n.max() < 1 << 32:
        n = n.astype(np.uint32)
    order = np.argsort(h)
    return rows.sparkSession.sparkContext.broadcast((h[order], n[order], low, high))


def score(
    df: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of every row."""
    n_blocks = min(SEGMENTS, max(1, math.ceil(model.n_words / BLOCK_WORDS)))
    blocks = [_word_block(model, k, n_blocks) for k in range(n_blocks)]
    words, pairs = model.words.load_all(), model.pairs.load_all()
    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    scored = _with_sums(rows, model, "_text", words, pairs, blocks).select("doc_id", "_sums.*")
    if max(map(len, (words, pairs, blocks))) > 1:
        scored = stored(scored, "text-sums")
        own = model.words.shared, model.pairs.shared
        for shared in (*words, *pairs, *blocks):
            if not any(shared is one for one in own):
                shared.destroy()
    unit = math.log10(model.n_tokens + model.n_words + 1)
    return scored.select(
        "doc_id",
        "n_tokens",
        "n_known",
        (F.col("log_sum") - F.col("n_tokens") * F.lit(unit)).alias("base_score"),
        "score",
    )
