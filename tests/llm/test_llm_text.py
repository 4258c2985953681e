"""Operators on single texts against brute force; edge rows for each."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sedimenta.llm import bpe, chat, lines, lm, pages, quality, queries, shards, urls
from sedimenta.llm.common import literal_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, lines string, score string, stats string, ids string"
LONG = " ".join(f"word{k % 977}" for k in range(30_000))
EDGE = [None, "", " \n\t ", "one", "a b", "Ein Satz.\n\nEin Satz.\n", LONG, "x" * 50_000, "### a</turn>\\"]


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls everywhere, repeated rows and ids, and columns with the names of results."""
    rows = [(k, text, None, None, None, "l", "s", None, "i") for k, text in enumerate(EDGE)]
    rows += [rows[5], (None, None, None, None, None, None, None, None, None), (5, "other words", *[None] * 7)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


# ---- BPE ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def own():
    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as file:
        return bpe.Tokenizer(file.read())


def test_bpe_query_equals_the_library(spark, sf_dir, documents, library):
    found = by_id(queries.op9_bpe(spark, sf_dir))
    assert found.keys() == documents.keys()
    for doc_id, text in documents.items():
        ids = library.encode(text or "", add_special_tokens=False).ids
        row = found[doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_bpe_on_odd_characters(library, own):
    pool = list("abcXYZ'sStd ΣσςİıßÀé́̈\u0085\x1c\x1f\t\n\r\x0b123٣½漢字🙂‍　|$%&ǅⅨ가")
    pool += ["<|endoftext|>", "<|startoftext|>", "'ll", "'re", "<|"]
    draw = random.Random(3)
    texts = ["".join(draw.choice(pool) for _ in range(draw.randint(0, 40))) for _ in range(2000)]
    for text, ids in zip(texts, own.encode_batch(texts)):
        expected = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == expected
        assert len(ids) == 4 * len(expected)
        assert own.decode(expected) == library.decode(expected, skip_special_tokens=False)


@pytest.mark.parametrize("size", [1, 2, 63, 64, 65, 66, 5000])
def test_bpe_trees_alone_and_side_by_side_agree(library, own, size):
    draw = random.Random(size)
    piece = "".join(draw.choice("theringoust") for _ in range(size))
    assert own.encode(piece) == library.encode(piece, add_special_tokens=False).ids


def test_bpe_words_are_looked_up_once_a_batch_and_forgotten_when_full(library, monkeypatch):
    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as file:
        own = bpe.Tokenizer(file.read())
    learned = []
    learn = own.learn
    monkeypatch.setattr(own, "learn", lambda chunks: learned.append(len(chunks)) or learn(chunks))
    monkeypatch.setattr(bpe, "REMEMBERED_BYTES", 4000)
    frequent = "the quick brown fox " * 50
    texts = ["skipped", "", "  ", *[frequent + "".join(f"word{k}x{n} " for n in range(99)) for k in range(9)]]
    texts += ["a<|endoftext|>b the\x1cfox", "<|endoftext|>", "plain <|endoftext|> again", " " + "é" * 70]
    for first in range(1, len(texts), 3):
        some = pa.array(texts, pa.string()).slice(first, 3)
        ids, lengths = own.encode_array(some)
        expected = [library.encode(t, add_special_tokens=False).ids for t in some.to_pylist()]
        assert ids.tolist() == [i for one in expected for i in one]
        assert lengths.tolist() == [len(one) for one in expected]
    assert learned[0] < 110  # 99 words of one text, four frequent ones and the empty one
    own.chunks.age()
    assert own.chunks.keys.nbytes + own.chunks.ids.nbytes <= 4000


def test_pair_tree_yields_the_leftmost_lowest():
    tree = bpe.PairTree([5, 3, -1, 3, 9])
    order = []
    while (at := tree.root()) >= 0:
        order.append(at)
        tree.put(at, -1)
    assert order == [1, 3, 0, 4]


def test_bpe_edge_rows(spark, edge, library):
    shared = queries.vocabulary(spark)
    coded = bpe.decode(bpe.encode(edge, shared), shared).collect()
    assert len(coded) == edge.count()
    for row in coded:
        assert row.ids == library.encode(row.text or "", add_special_tokens=False).ids
        assert row.decoded == library.decode(row.ids, skip_special_tokens=False)
    assert bpe.encode(edge.limit(0), shared).count() == 0


# ---- line labels ---------------------------------------------------------------


def base(text):
    words = WORD.findall(text or "")
    windows = list(zip(words, words[1:], words[2:]))
    seen = collections.Counter(windows)
    marked = {k + j for k, w in enumerate(windows) if seen[w] > 1 for j in range(3)}
    full = [line for line in (text or "").split("\n") if WORD.search(line)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(full) - len(set(full)), len(marked)


def test_quality_rules_query(spark, sf_dir, documents):
    found = by_id(queries.op3_quality_rules(spark, sf_dir))
    assert found.keys() == documents.keys()
    for doc_id, text in documents.items():
        row, counts = found[doc_id], base(text)
        assert tuple(row[c] for c in lines.COUNTS) == counts
        assert row.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (row.base_failed and row.kept)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    judged = [(labels[i], r.kept) for i, r in found.items() if i in labels and not r.base_failed]
    right = sum((q == 1) == kept for q, kept in judged)
    assert right >= 0.95 * len(judged)


def test_viterbi_is_the_best_sequence():
    import itertools

    import numpy as np

    draw = np.random.RandomState(1)
    for n in (1, 2, 5, 8):
        chain = lines.Chain(draw.normal(size=(lines.LINE_FEATURES, 2)), draw.normal(size=(2, 2)))
        x = draw.uniform(size=(n, lines.LINE_FEATURES))
        scores = x @ chain.lines

        def total(labels):
            steps = sum(chain.steps[a, b] for a, b in zip(labels, labels[1:]))
            return steps + sum(scores[k, y] for k, y in enumerate(labels))

        best = max(itertools.product((0, 1), repeat=n), key=total)
        assert chain.viterbi(x) == list(best)


def test_quality_rules_edge_rows(spark, edge):
    labels = edge.select("doc_id", F.lit(1).alias("quality"))
    chain = lines.train(edge, labels)  # one label only
    rows = lines.label_lines(edge, chain).collect()
    assert len(rows) == edge.count()
    for row in rows:
        assert tuple(row["lines"][c] for c in lines.COUNTS) == base(row.text)
        assert all(label == lines.CONTENT for label in row["lines"]["labels"])
    assert lines.label_lines(edge.limit(0), chain).count() == 0
    assert not lines.train(edge.limit(0), labels).lines.any()
    assert not lines.train(edge, labels.limit(0)).lines.any()


def test_lines_of_half_junk_texts_differ(spark):
    """Bad texts hold good lines too; the field is not told which of their lines are bad."""
    draw = random.Random(6)

    def good():
        return " ".join(draw.choices(["the", "river", "runs", "past", "old", "walls"], k=14)) + "."

    def junk():
        return " ".join(draw.choices(["BUY ##", "NOW $$", "FREE %%", "WIN &&"], k=9))

    rows, labels = [], []
    for k in range(160):
        parts = [good() for _ in range(6)]
        if k % 2:
            parts[k % 4 : k % 4 + 3] = [junk() for _ in range(3)]
        rows.append((k, "\n".join(parts)))
        labels.append((k, 1 - k % 2))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    chain = lines.train(
        docs.where("doc_id < 100"), spark.createDataFrame(labels, "doc_id bigint, quality int")
    )
    for row in lines.label_lines(docs.where("doc_id >= 100"), chain).collect():
        expected = [0 if set(line) & set("#$%&") else 1 for line in row.text.split("\n")]
        assert row["lines"]["labels"] == expected
        share = row["lines"]["content_words"] / row["lines"]["n_words"]
        assert 0 < share < 1 if row.doc_id % 2 else share == 1


# ---- classifier ----------------------------------------------------------------


def test_classifier_query(spark, sf_dir, documents):
    found = by_id(queries.op2_quality_classifier(spark, sf_dir))
    assert found.keys() == documents.keys()
    for doc_id, row in found.items():
        assert row.held_out == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
        assert 0 <= row.score <= 1 and row.predicted == (row.score >= 0.3)


def test_classifier_on_held_out_documents(spark):
    found = by_id(queries.op2_quality_classifier(spark, "/root/testdata/sf0.1"))
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()
    judged = [(r.quality, found[r.doc_id].predicted) for r in labels if found[r.doc_id].held_out]
    assert sum(q == p for q, p in judged) >= 0.97 * len(judged)


def test_classifier_edge_rows(spark, edge):
    stats = quality.with_stats(edge)
    none = quality.fit(stats.withColumn("quality", F.lit(None).cast("int")))
    assert {r.score for r in quality.score(stats, none).collect()} == {0.5}
    one = quality.fit(stats.withColumn("quality", F.lit(1)))
    assert all(0 <= r.score <= 1 for r in quality.score(stats, one).collect())
    assert quality.score(stats.limit(0), one).count() == 0


def test_isotonic_never_falls():
    import numpy as np

    draw = np.random.RandomState(2)
    n = draw.randint(1, 20, 50).astype(float)
    ones = np.floor(n * np.clip(np.linspace(-0.2, 1.2, 50) + draw.normal(0, 0.2, 50), 0, 1))
    heights = quality.isotonic(n, ones)
    assert len(heights) == 50 and (np.diff(heights) >= 0).all()
    assert (heights * n).sum() == pytest.approx(ones.sum())


def test_copies_do_not_fill_the_sample(spark, monkeypatch):
    monkeypatch.setattr(lines, "SAMPLE", 5)
    texts = [(f"text {k}", k % 2) for k in range(30)]
    once = spark.createDataFrame([(k, *row) for k, row in enumerate(texts)], "doc_id int, text string, quality int")
    lowest = once.orderBy(F.xxhash64("text")).where("quality = 1").limit(2)
    copies = lowest.crossJoin(spark.range(40)).selectExpr("doc_id + 100 * (id + 1) doc_id", "text", "quality")
    fitted = []
    monkeypatch.setattr(lines, "fit_chain", lambda rows, labels: fitted.append((len(rows), labels)))
    seen = []
    monkeypatch.setattr(lines, "features_of", lambda data: (seen.append(data) or [data], []))
    for rows in (once, once.union(copies)):
        lines.train(rows.select("doc_id", "text"), rows.select("doc_id", "quality"))
    assert seen[:10] == seen[10:] and len(set(seen)) == 10
    assert [(n, sorted(labels)) for n, labels in fitted] == [(10, [0] * 5 + [1] * 5)] * 2


# ---- language model ------------------------------------------------------------


def tokens(text):
    return WORD.findall((text or "").translate(ASCII)) + ["\n"]


def check_scores(rows, texts, held_out):
    counts = collections.Counter(t for i, x in texts.items() if not held_out(i) for t in tokens(x))
    n, v = sum(counts.values()), len(counts)
    for row in rows:
        own = tokens(texts[row.doc_id])
        score = math.fsum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own)
        assert row.n_tokens == len(own)
        assert row.n_known == sum(counts[t] > 0 for t in own)
        assert row.base_score == pytest.approx(score, abs=1e-6)
    return n


def test_lm_query(spark, sf_dir, documents):
    rows = queries.op4_lm_scoring(spark, sf_dir).collect()
    held_out = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    n = check_scores(rows, documents, held_out)
    assert all(r.train_tokens == n and r.held_out == held_out(r.doc_id) for r in rows)
    unseen = [r for r in rows if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_words_in_several_blocks_give_the_same(spark, sf_dir, documents, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_WORDS", 1500)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = lm.score(docs.union(docs.where("doc_id < 5")), lm.fit(docs)).collect()
    assert len(rows) == len(documents) + 5
    check_scores(rows, documents, lambda i: False)


def test_filter_counts(spark):
    text = " ".join(f"w{k}" for k in range(300) for _ in range(k % 9 + 1))
    model = lm.fit(spark.createDataFrame([(text,)], "text string"))
    import numpy as np

    known = lm.Filter(np.frombuffer(model.filter.value, np.uint8), model.blocks)
    rows = model.counts.collect()
    for order in (1, 2):
        own = [r for r in rows if r.n_order == order]
        h = np.array([r.h for r in own], np.int64).view(np.uint64)
        levels = lm.level(np.array([r.n for r in own]), order)
        found = known.levels(h, order)
        assert (found >= levels).all() and (found == levels).mean() > 0.85


def test_filter_size_is_bounded():
    entries = {(1, 3): 10**9, (2, 0): 10**11, (2, 9): 10**7}
    least, blocks = lm.sized(entries)
    assert least > 1 and blocks * lm.SEGMENTS * lm.BLOCK_BITS <= lm.MAX_BITS * 1.01


def test_no_bigram_is_dropped_beyond_one_part(spark, edge, monkeypatch):
    """Scores are those of one filter that holds all, but for false hits of either."""
    draw = random.Random(4)
    texts = [(100 + k, " ".join(f"w{draw.randrange(300)}" for _ in range(1500))) for k in range(40)]
    docs = spark.createDataFrame(texts + texts[:2], "doc_id bigint, text string")
    docs = docs.union(edge.select("doc_id", "text"))
    whole = lm.fit(docs)
    expected = sorted((r.doc_id or -1, r.n_tokens, r.score) for r in lm.score(docs, whole).collect())
    entries = lm._entries(whole.counts)
    monkeypatch.setattr(lm, "MAX_BITS", 1)
    of_words, _ = lm.sized({key: n for key, n in entries.items() if key[0] == 1})
    for bits in (of_words, of_words // 2):  # words in one part, then in several
        monkeypatch.setattr(lm, "MAX_BITS", bits)
        model = lm.fit(docs)
        assert model.pairs.parts > 1 and (model.words.parts > 1) == (bits < of_words)
        found = sorted((r.doc_id or -1, r.n_tokens, r.score) for r in lm.score(docs, model).collect())
        assert [r[:2] for r in found] == [r[:2] for r in expected]
        for own, other in zip(found, expected):
            assert own[2] == pytest.approx(other[2], rel=0.03, abs=0.3)
        kept = sum(t.parts * t.blocks * lm.SEGMENTS * lm.BLOCK_BITS for t in (model.words, model.pairs))
        assert kept >= sum(entries.values()) * lm.BITS_PER_ENTRY  # room for each, the rare ones too


def test_lm_edge_rows(spark, edge):
    rows = lm.score(edge, lm.fit(edge)).collect()
    assert len(rows) == edge.count()
    assert {r.n_tokens for r in rows if r.doc_id in (0, 1, 2)} == {1}
    empty = edge.limit(0)
    assert lm.score(empty, lm.fit(empty)).count() == 0
    assert all(r.n_known == 0 for r in lm.score(edge, lm.fit(empty)).collect())


def test_tokens_of_many_texts_at_once():
    """Those of every text by itself, however the texts are cut into chunks."""
    draw = random.Random(8)
    texts = [None, "", " ", "a", "A b", "x", "y ", " z", "\n", "w" * 3_000_000 + " b", "\u00e9 \u00c9", "a\x00b \x00 \x1c c"]
    texts += ["".join(draw.choice("abA \t\n\x0b\x0c\r\x1f\x85\xa0\u00c9") for _ in range(draw.randrange(30))) for _ in range(400)]
    ends = [[*map(lm.xxhash.xxh3_64_intdigest, (t or "").encode().translate(lm._UPPER).split()), lm.END] for t in texts]
    for column in (pa.array(texts), pa.array(["cut off", *texts]).slice(1)):
        for most in (1, 50, 1 << 20):
            found = []
            for words, place, starts in lm._chunks(column, most):
                assert len(set(words.tolist())) == len(words)
                found += [part.tolist() for part in np.split(words[place], starts[1:])]
            assert found == ends


def test_one_pass_over_the_texts_gives_all_sums(spark, edge):
    """Where there is one part of the filter and one block of words, the texts are cut into tokens once."""
    plan = lm.score(edge, lm.fit(edge))._jdf.queryExecution().optimizedPlan().toString()
    [line] = [line for line in plan.splitlines() if "EvalPython" in line]
    assert len(re.findall(r"\(text#", line)) == 1


def test_texts_are_read_once_for_all_parts_and_blocks(spark, edge, monkeypatch):
    """Several parts of both filters and several blocks of words take no further pass over the texts,
    and give what one part and one block give."""
    draw = random.Random(5)
    texts = [(k, " ".join(f"w{draw.randrange(900)}" for _ in range(400))) for k in range(60)]
    docs = spark.createDataFrame(texts + texts[:3], "doc_id bigint, text string")
    docs = docs.union(edge.select("doc_id", "text"))
    whole = lm.fit(docs)
    one_part = sorted((r.doc_id or -1, r.n_known, r.base_score) for r in lm.score(docs, whole).collect())
    monkeypatch.setattr(lm, "MAX_BITS", 1 << 17)
    monkeypatch.setattr(lm, "BLOCK_WORDS", 300)
    monkeypatch.setattr(lm, "_SCORED_AT_ONCE", 2_000)  # many chunks, a few of which wait together
    monkeypatch.setattr(lm, "_WAIT_TOGETHER", 3_000, raising=False)
    model = lm.fit(docs)
    assert model.pairs.parts > 1
    passes, kept = [], lm.stored

    def noted(rows, purpose):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        passes.append("EvalPython" in plan)
        return kept(rows, purpose)

    monkeypatch.setattr(lm, "stored", noted)
    scored = lm.score(docs, model)
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert sum(passes) + ("EvalPython" in plan) == 1
    rows = scored.collect()
    found = sorted((r.doc_id or -1, r.n_known, r.base_score) for r in rows)
    assert [r[:2] for r in found] == [r[:2] for r in one_part]
    for own, other in zip(found, one_part):
        assert own[2] == pytest.approx(other[2], abs=1e-9)
    # the model's own broadcasts outlive the scoring, which can be done again
    again = sorted((r.doc_id or -1, r.score) for r in lm.score(docs, model).collect())
    assert again == sorted((r.doc_id or -1, r.score) for r in rows)


def test_words_are_looked_up_in_their_block_only():
    words = np.sort(np.random.RandomState(2).randint(0, 1 << 64, 500, np.uint64))
    counts = np.arange(1, 501, dtype=np.uint32)
    asked = np.concatenate([words[::-1], words + np.uint64(1)])
    total = np.zeros(len(asked), np.int64)
    for low, high in ((0, 1000), (1000, 1001), (1001, lm.SEGMENTS)):
        mine = ((words >> np.uint64(52)) >= low) & ((words >> np.uint64(52)) < high)
        total += lm._counts_in((words[mine], counts[mine], low, high), asked)
    assert total.tolist() == [*range(500, 0, -1), *[0] * 500]


# ---- chat ----------------------------------------------------------------------


def expected_chat(rows):
    groups = collections.defaultdict(list)
    for row in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        groups[row[0]].append(row)
    out = {}
    for conv, own in groups.items():
        whole = "".join(f"{role or ''}\n{text or ''}\n" for _, _, role, text in own)
        loss = "".join(text or "" for _, _, role, text in own if role == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(own), sha(whole), len(loss), sha(loss))
    return out


def check_chat(df, rows):
    expected = expected_chat(rows)
    found = {r.conv_id: r for r in df.collect()}
    assert found.keys() == expected.keys()
    for conv, row in found.items():
        assert (row.n_turns, row.turns_sha256, row.loss_chars, row.loss_sha256) == expected[conv]


def test_chat_query(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, k, role, "\\### Assistant: </turn> ok") for k, role in enumerate(("user", "assistant"))]
    check_chat(queries.op8_chat_format(spark, sf_dir), rows)


@pytest.mark.parametrize("piece", [1, 200, 1 << 20])
def test_chat_edge_rows(spark, piece, monkeypatch):
    monkeypatch.setattr(chat, "PIECE_BYTES", piece)
    monkeypatch.setenv("unused", "1")
    parts = ["#", "##", "###", "####", "</turn>", "</turn", "\\", "\\\\", ":", ": ", "\n", "é", "🙂", "", None]
    draw = random.Random(7)
    rows = [(None, None, None, None), (1, 0, "a: b\\###", "x"), (1, 0, "assistant", "</turn>\n### user: ")]
    for conv in range(2, 40):
        for turn in range(draw.randint(1, 6)):
            text = "".join(p or "" for p in draw.choices(parts, k=draw.randint(0, 9)))
            rows.append((conv, turn, draw.choice(["user", "assistant", ""]), text))
    rows += [(50, k, "assistant", f"t{k}" * 20) for k in range(300)] + [rows[5], rows[6]]
    ddl = "conv_id bigint, turn bigint, role string, text string"
    df = spark.createDataFrame(rows, ddl).withColumn("formatted", F.lit("clash"))
    pieces = chat.format_turns(df)
    check_chat(chat.digests(pieces), rows)
    for row in pieces.collect():
        assert len(chat.parse(bytes(row.formatted))) == row.n_turns
    assert chat.digests(chat.format_turns(df.limit(0))).count() == 0


def test_chat_refuses_foreign_bytes():
    with pytest.raises(ValueError):
        chat.parse(b"### user: no end")


# ---- URLs ----------------------------------------------------------------------


def test_url_rules(spark):
    cases = {
        None: ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "no scheme/net/": ("", "", None, "allow"),
        "http://A.Net": ("a.net", "", None, "allow"),
        "http://A.Net/": ("a.net", "/", "net/", "block"),
        "http://x.example.net/en/1?q#f": ("x.example.net", "/en/1", "example.net/en/", "allow"),
        "http://x.example.net/EN/1": ("x.example.net", "/EN/1", "net/", "block"),
        "http://badexample.net/en/": ("badexample.net", "/en/", "net/", "block"),
        "http://example.com/de/x": ("example.com", "/de/x", "example.com/de/", "block"),
        "http://example.com/de": ("example.com", "/de", None, "allow"),
        "http://a.org/fr//x/": ("a.org", "/fr//x/", "org/fr/", "allow"),
        "http://a..net/x": ("a..net", "/x", "net/", "block"),
        "http://a.net:80/x": ("a.net:80", "/x", None, "allow"),
        "http://net?x=/://": ("net", "", None, "allow"),
        "http://h/" + "p/" * 3000 + "?": ("h", "/" + "p/" * 3000, None, "allow"),
    }
    rows = [(k, url, "own") for k, url in enumerate(cases)] * 2
    df = spark.createDataFrame(rows, "page_id int, url string, verdict string")
    rules = literal_rows(spark, queries.URL_RULES, "host string, path string, verdict string")
    found = urls.judge(df, rules).collect()
    assert len(found) == len(rows)
    for row in found:
        assert (row.host, row.path, row.rule, row.verdict) == cases[row.url]
    assert urls.judge(df.limit(0), rules).count() == 0
    assert {r.verdict for r in urls.judge(df, rules.limit(0)).collect()} == {"allow"}


def test_url_ties_block_and_bad_rules_are_refused(spark):
    df = spark.createDataFrame([("http://a.b/c/d",)], "url string")
    both = [dict(host="b", path="/c/", verdict=v) for v in ("allow", "block")]
    ddl = "host string, path string, verdict string"
    assert urls.judge(df, literal_rows(spark, both, ddl)).first().verdict == "block"
    with pytest.raises(Exception, match="must start and end"):
        urls.judge(df, literal_rows(spark, [dict(host="b", path="/c", verdict="block")], ddl)).collect()


# ---- pages ---------------------------------------------------------------------


def test_article_is_extracted(spark, sf_dir):
    import html

    source = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    found = by_id(queries.op7_html_extraction(spark, sf_dir), "page_id")
    assert found.keys() == source.keys()
    for page_id, page in source.items():
        article = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", article)
        texts = [" ".join(html.unescape(re.sub("<[^>]+>", " ", b)).split()) for b in blocks]
        text = "\n\n".join(t for t in texts if t)
        assert (found[page_id].text, found[page_id].n_chars) == (text, len(text))


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>a<p>b<br>c", "a\n\nb c"),
        ("<nav>x</nav><article><header><h1>T</h1></header><p>a</p><form>f</form></article>y", "T\n\na"),
        ("<header>x</header><p>a</p><aside>s</aside><div class='cookie-notice'>n</div>", "a"),
        ("<p>a</p><script>if (a<b) { '</p>' }</script><style>p</style><!-- c --><p>b", "a\n\nb"),
        ("<p>a</p><!-- never closed <p>b</p>", "a"),
        ("<div id='comments'><p>c</p></div><main><p>m</p></main><p>out</p>", "m"),
        ("<ul><li>1<li>2</ul><table><tr><td>3<td>4</table>", "1\n\n2\n\n3\n\n4"),
        ("<p title=\"a > b\">q</p> a < b &#233;&nbsp;x", "q\n\na < b é x"),
    ],
)
def test_page_shapes(page, text):
    assert "\n\n".join(t for _, t in pages.Page(page or "").kept()) == text


def test_style_tree_removes_what_a_site_repeats(spark):
    frame = "<div class='top'><p>Welcome to our site</p></div><div class='body'><p>{}</p></div><div class='end'><p>All rights</p></div>"
    rows = [(k, f"http://h.example/{k}", frame.format(f"story {k} of many")) for k in range(12)]
    rows += [(100, "http://single.example/", frame.format("alone")), (101, None, None), rows[0]]
    df = spark.createDataFrame(rows, "page_id int, url string, html string").withColumn("text", F.lit("x"))
    found = pages.extract(df).collect()
    assert len(found) == len(rows)
    texts = {r.page_id: r.text for r in found}
    assert all(texts[k] == f"story {k} of many" for k in range(12))
    assert texts[100] == "Welcome to our site\n\nalone\n\nAll rights" and texts[101] == ""
    assert pages.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<article><h2 id='related-work'>a</h2><h2 id='search'>b</h2><p class='share-price'>c</p></article>", "a\n\nb\n\nc"),
        ("<section id='social-history'>a</section><div class='form-factor'>b</div>", "a\n\nb"),
        ("<div id='search-results'>a</div><p class='comment'>b</p>", "a"),
        ("<article><p class='notice'>a</p><div class='ad-box-2'>b</div><ul class='x share-buttons'><li>c</ul></article>", "a"),
        ("<article><p>so <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math>.</p></article>", "so x=1."),
        ("<article><svg><title>t</title><g><path d='M0 0'/><text>a</text><text>b</text></g></svg>c</article>", "a bc"),
        ("<div><p>the long main text</p></div><article><p>card</p></article>", "the long main text\n\ncard"),
        ("<div id='main-menu'>m</div><div class='page-header'>h</div><p>a</p>", "a"),
    ],
)
def test_names_state_a_role_as_a_whole(page, text):
    assert "\n\n".join(t for _, t in pages.Page(page).kept()) == text


def test_copies_of_a_page_are_no_boilerplate(spark):
    page = "<div class='end'><p>All rights</p></div><div id='post-{0}'><p>story {0}</p></div>"
    rows = [(k, "http://one.example/", page.format(7)) for k in range(9)]
    rows += [(100 + k, "http://h.example/", page.format(k // 5)) for k in range(30)]
    df = spark.createDataFrame(rows, "page_id int, url string, html string").repartition(4)
    texts = {r.page_id: r.text for r in pages.extract(df).collect()}
    assert len(texts) == len(rows)
    assert all(texts[k] == "All rights\n\nstory 7" for k in range(9))
    assert all(texts[100 + k] == f"story {k // 5}" for k in range(30))


def test_pages_stay_where_they_are(spark):
    words = random.Random(3)
    rows = [
        (k, f"https://{'ab'[k % 2]}.org/{k}", "<ul><li>Menu</li></ul><p>" + "".join(words.choices("abcde ", k=600)) + "</p>")
        for k in range(120)
    ]
    rows += [(1000 + k, *rows[0][1:]) for k in range(40)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    usual = pages.extract(df)
    expected = {r.page_id: r.text for r in usual.collect()}
    assert not any("Menu" in text for text in expected.values())
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    try:
        spark.conf.set(threshold, "16384")
        found = pages.extract(df)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
        spark.conf.set(threshold, "-1")  # too many copies and branches to be sent to the pages
        moved = pages.extract(df)
        assert {r.page_id: r.text for r in moved.collect()} == expected
    finally:
        spark.conf.set(threshold, before)


# ---- shards --------------------------------------------------------------------


def test_sharding_query(spark, sf_dir, documents):
    rows = queries.op10_sharding(spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == documents.keys() and len(rows) == len(documents)
    sizes, places = collections.Counter(), collections.defaultdict(list)
    for row in rows:
        data = (documents[row.doc_id] or "").encode()
        assert (row.size, row.text_crc32, row.law) == (len(data) + 1, zlib.crc32(data), "bytes")
        assert row.grown_shard is None
        sizes[row.shard] += row["size"]
        places[row.shard].append(row.slot)
    assert all(sorted(own) == list(range(len(own))) for own in places.values())
    largest = max(r["size"] for r in rows)
    assert sizes.keys() == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= largest
    moved = [r for r in rows if r.shard != r.after_growth]
    assert moved and {r.after_growth for r in moved} == {8}


def test_maps_are_versions_and_edits_move_little(spark, root):
    totals = {slot: 100 + slot % 7 for slot in range(1000)}
    placed = shards.first_map(totals, 4, 1000)
    grown = shards.edited_map(placed, totals, 5)
    assert {grown[s] for s in placed if grown[s] != placed[s]} == {4}
    shrunk = shards.edited_map(grown, totals, 3)
    assert set(shrunk.values()) == {0, 1, 2} and len(shrunk) == 1000
    load = collections.Counter()
    for slot, shard in shrunk.items():
        load[shard] += totals[slot]
    assert max(load.values()) - min(load.values()) <= 200
    shards.store_map(spark, placed, root, 1)
    shards.store_map(spark, grown, root, 2)
    read = {r.virtual_slot: r.shard for r in shards.load_map(spark, root, 1).collect()}
    assert read == placed
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        shards.store_map(spark, grown, root, 1)


def test_sharding_edge_rows(spark, edge, root):
    for rows in (edge.withColumn("shard", F.lit("x")).withColumn("slot", F.lit("y")), edge.limit(0)):
        slotted = shards.with_slots(rows, ["doc_id", "text"])
        totals = shards.slot_totals(slotted)
        sizes, _ = shards.read_totals(totals)
        folder = f"{root}/{rows.count()}"
        shards.store_map(spark, shards.first_map(sizes, 3), folder, 1)
        out = shards.place(slotted, shards.load_map(spark, folder, 1), totals, ["doc_id"]).collect()
        assert len(out) == rows.count()
        for shard in {r.shard for r in out}:
            own = sorted(r.slot for r in out if r.shard == shard)
            assert own == list(range(len(own)))
        assert all(r["size"] == 1 and r.text_crc32 == 0 for r in out if r.text is None)


def test_a_worker_lets_go_of_what_other_operators_remember(monkeypatch):
    """Tables stay while batches use them, also in turns, and go once they are idle."""
    from sedimenta.llm import common

    now = [100.0]
    monkeypatch.setattr(common.time, "monotonic", lambda: now[0])
    monkeypatch.setattr(common, "_last_use", {})
    first, second = {"a": 1}, {"b": 2}
    for _ in range(5):
        common.in_use(first)
        now[0] += 0.9 * common.IDLE_SECONDS
        common.in_use(second)
    assert first and second
    now[0] += 1.1 * common.IDLE_SECONDS
    common.in_use(second)
    assert not first and second == {"b": 2}
    common.in_use()
    now[0] += 1.1 * common.IDLE_SECONDS
    common.in_use()
    assert not second


def test_idle_workers_return_their_memory(monkeypatch):
    """What is still in use lies scattered among what is freed, so C's allocator keeps the rest."""
    from sedimenta.llm import common

    def megabytes():
        with open("/proc/self/statm") as file:
            return int(file.read().split()[1]) * 4096 / 1e6

    now = [100.0]
    monkeypatch.setattr(common.time, "monotonic", lambda: now[0])
    monkeypatch.setattr(common, "_last_use", {})
    tables = {k: bytes(700) for k in range(200_000)}
    kept = [tables[k] for k in range(0, len(tables), 100)]
    common.in_use(tables)
    before = megabytes()
    now[0] += 1.1 * common.IDLE_SECONDS
    common.in_use()
    assert not tables and len(kept) == 2000
    assert before - megabytes() > 90


def test_decoding_in_parts():
    cases = [([], []), ([0], []), ([0, 0, 0], [(0, 2)]), ([0, 3, 3, 9, 10, 14], [(0, 2), (2, 3), (3, 5)])]
    for offsets, parts in cases:
        assert bpe.parts_of(np.array(offsets, np.int64), 5) == parts
