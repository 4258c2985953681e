"""Pieces, whitening and hard negatives against the library, numpy and brute force."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from sedimenta.llm import negatives, pieces, queries, whitening

EDGE = [
    None,
    "",
    " ",
    "   two  gaps   ",
    "▁▁ a ▁b",
    "Zeile.\n\nZeile.\t\r\n",
    "<s>word</s><unk><0x41>",
    "é́漢字🙂‍ﷺ \u0085\x01",
    "x" * 30_000,
    " " * 3_000,
    "word " * 20_000,
]


# ---- SentencePiece -----------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model")
    )


@pytest.fixture(scope="module")
def model():
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return pieces.Model(file.read())


def decoded(model, lists):
    offsets = np.cumsum([0, *map(len, lists)])
    return model.decode_lists(np.array(sum(lists, []), np.int32), offsets).to_pylist()


def test_pieces_query_equals_the_library(spark, sf_dir, library):
    found = {r.doc_id: r for r in queries.op11_sentencepiece(spark, sf_dir).collect()}
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(found) == len(documents)
    for doc in documents:
        ids = library.encode(doc.text or "")
        row = found[doc.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_pieces_of_odd_texts(library, model):
    draw = random.Random(1)
    pool = list("abcdefgtheAB  .\n\t▁▁é漢字🙂‍ｘ\x00\x7f0123Жтол(=|")
    pool += ["the ", "  ", "ing", "<s>", "</s>", "<unk>", "<0x41>", "    ", " ⁇ "]
    texts = ["".join(draw.choices(pool, k=draw.randint(0, 40))) for _ in range(3000)]
    texts += [text or "" for text in EDGE]
    ids = [np.frombuffer(b, np.int32).tolist() for b in model.encode_batch(texts)]
    assert ids == library.encode(texts)
    assert decoded(model, ids) == library.decode(ids)
    marked = [t.replace(" ", pieces.MARK) for t in texts[:300]]
    assert [model._merge_long(list(t)) for t in marked] == [model._merge_short(list(t)) for t in marked]


def test_any_ids_decode_as_in_the_library(library, model):
    draw = random.Random(2)
    some = [0, 1, 2, 259, 260, 29871]
    lists = [
        [draw.choice([*some, draw.randint(3, 258), draw.randint(0, 31_999)]) for _ in range(draw.randint(0, 6))]
        for _ in range(3000)
    ]
    assert decoded(model, lists) == [library.decode(ids) for ids in lists]
    with pytest.raises(ValueError):
        decoded(model, [[32_000]])


def test_words_never_cut_a_piece(model):
    for piece in model.ids:
        assert model.word.findall(piece) == [piece]


def test_remembered_words_stay_within_bytes(library, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED_BYTES", 40_000)
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        model = pieces.Model(file.read())
    for k in range(30):
        text = " ".join(f"w{chr(97 + j % 26)}ord{k}{j}" for j in range(200)) + " common words"
        assert model.encode(text) == library.encode(text)
        assert model.young_bytes <= 40_000 + 202 * (40 + pieces.ENTRY_BYTES)
    assert "▁common" in model.young
    assert len(model.young) + len(model.old) < 4 * 202


def test_pieces_of_edge_rows(spark, library):
    rows = [(k, text, "i", "d") for k, text in enumerate(EDGE)] + [(0, None, None, None), (3, EDGE[3], "x", "y")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, ids string, decoded string")
    shared = pieces.load_model(spark, public_tokenizers.path("piece_bpe_32k.model"))
    found = pieces.decode(pieces.encode(frame, shared), shared)
    assert found.columns == ["doc_id", "text", "ids", "decoded"]
    rows = found.collect()
    assert len(rows) == len(EDGE) + 2
    for row in rows:
        assert row.ids == library.encode(row.text or "")
        assert row.decoded == library.decode(row.ids)
    assert pieces.decode(pieces.encode(frame.limit(0), shared), shared).count() == 0
    empty = frame.withColumn("ids", F.lit(None).cast("array<int>"))
    assert {r.decoded for r in pieces.decode(empty, shared).collect()} == {""}


# ---- whitening ---------------------------------------------------------------


def qr(rows):
    return np.linalg.qr(np.asarray(rows, float), mode="r")


NOISE = np.random.default_rng(5)
TURN = np.linalg.qr(NOISE.standard_normal((40, 40)))[0]
FACTORS = {
    "random": qr(NOISE.standard_normal((900, 40))),
    "identity": np.eye(7),
    "zero": np.zeros((4, 4)),
    "repeated values": np.diag([5.0] * 5 + [2] * 35) @ TURN,
    "nearly repeated": np.diag(np.r_[5 * (1 + 1e-12 * np.arange(5)), np.ones(35)]) @ TURN,
    "graded": np.diag(10.0 ** -np.arange(12)) @ qr(NOISE.standard_normal((12, 12))),
    "one direction": qr(np.outer(NOISE.standard_normal(30), NOISE.standard_normal(8))),
    "one entry": np.array([[2.5]]),
}


@pytest.mark.parametrize("name", FACTORS)
def test_singular_values_and_directions(name):
    r = FACTORS[name]
    a, b, v = whitening.bidiagonalise(r)
    expected = np.linalg.svd(r, compute_uv=False)
    largest = max(expected[0], 1e-300)
    assert np.abs(v.T @ v - np.eye(len(r))).max() < 1e-13
    assert np.abs(whitening.singular_values(a, b) - expected).max() / largest < 1e-13
    values, z = whitening.directions(r, 6)
    assert len(values) == min(6, (expected > 1e-12 * largest).sum())
    if len(values):
        assert np.abs(z.T @ z - np.eye(len(values))).max() < 1e-13
        assert np.abs(r.T @ r @ z - z * values**2).max() / largest**2 < 1e-13


def test_small_singular_values_keep_their_digits():
    """The qd steps find tiny values of a bidiagonal matrix to relative precision."""
    a, b = 10.0 ** -np.arange(0.0, 24, 2), np.full(11, 1e-30)
    assert np.abs(whitening.singular_values(a, b) / a - 1).max() < 1e-14


def expected_whitening(vectors):
    x = np.floor(256 * np.asarray(vectors, float)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    values, v = np.linalg.eigh(np.cov(fit.T.astype(float), bias=True))
    values, v = values[::-1], v[:, ::-1]
    white = (x - sums / n) @ v[:, :4] / np.sqrt(values[:4])
    return n, ((n * x - sums) ** 2).sum(axis=1), white, values[:4] / values.sum()


def test_whitening_query_equals_a_direct_decomposition(spark, sf_dir):
    found = queries.op12_embedding_whitening(spark, sf_dir).toPandas()
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    n, deviation, white, explained = expected_whitening(np.stack(given.embedding))
    assert len(found) == 4 * len(given)
    assert set(found.n) == {n}
    table = found.pivot(index="vec_id", columns="component", values="whitened").loc[given.vec_id]
    signs = np.sign((table.to_numpy() * white).sum(axis=0))
    assert np.abs(table.to_numpy() - white * signs).max() < 1e-9
    first = found[found.component == 1].set_index("vec_id").loc[given.vec_id]
    assert (first.deviation.to_numpy() == deviation).all()
    by_component = found.groupby("component").explained.agg(["min", "max"])
    assert (by_component["min"] == by_component["max"]).all()
    assert np.abs(by_component["min"].to_numpy() / explained - 1).max() < 1e-12
    assert found.identity_error.nunique() == 1 and found.identity_error[0] < 1e-10


VECTORS = "vec_id bigint, embedding array<float>, x string, n string, label int"


def vector_frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", "n", l) for i, v, l in rows], VECTORS)


def test_whitening_of_edge_rows(spark):
    plain = [[float(v) for v in row] for row in NOISE.standard_normal((60, 5)).round(2)]
    rows = [(k, v, k % 3) for k, v in enumerate(plain)]
    bad = [None, [], [1.0, None, 0.0, 0.0, 0.0], [float("nan")] * 5, [float("inf")] * 5, [1.0, 2.0]]
    rows += [(100 + k, v, None) for k, v in enumerate(bad)]
    rows += [rows[3]] * 40 + [(None, plain[4], 1)]
    found = whitening.whiten(vector_frame(spark, rows)).collect()
    n, deviation, white, _ = expected_whitening(plain)
    assert len(found) == 60 + 41
    assert {r.n for r in found} == {n}
    for r in found:
        k = 4 if r.vec_id is None else r.vec_id
        assert r.deviation == deviation[k]
        assert np.allclose(np.abs(r.whitened), np.abs(white[k]), atol=1e-9)
    for few in (rows[:0], rows[:1], rows[60:66]):
        assert whitening.whiten(vector_frame(spark, few)).count() == 0


def test_whitening_has_no_direction_without_variance(spark):
    """Three of five entries never change; two directions are left."""
    rows = [(k, [float(k % 7), 1.0, float(k % 5), -2.0, 0.25], 0) for k in range(35)]
    found = whitening.whiten(vector_frame(spark, rows)).collect()
    assert {len(r.whitened) for r in found} == {2}
    assert found[0].identity_error < 1e-12


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(0, [1e15, 0.0], 0), (1, [0.0, 1.0], 0), (2, [0.0, 0.5], 0)]
    found = {r.vec_id: r.deviation for r in whitening.whiten(vector_frame(spark, rows)).collect()}
    assert set(found.values()) == {None}
    rows = [(0, [float(2**22), 0.0], 0), (1, [0.0, 1.0], 0), (2, [0.0, 0.5], 0)]
    found = {r.vec_id: r.deviation for r in whitening.whiten(vector_frame(spark, rows)).collect()}
    x = [[2**30, 0], [0, 256], [0, 128]]
    sums = [2**30, 384]
    assert found == {
        k: sum((3 * c - s) ** 2 for c, s in zip(row, sums)) for k, row in enumerate(x)
    }


def test_factors_of_many_tasks_are_reduced_in_levels(spark):
    vectors = NOISE.standard_normal((400, 6)).round(2)
    rows = whitening.with_entries(
        vector_frame(spark, [(k, v.tolist(), 0) for k, v in enumerate(vectors)]).repartition(40)
    ).select("x")
    sums = whitening.sums_of(rows)
    r = whitening.triangular_factor(rows, sums)
    x = np.floor(256 * vectors.astype(np.float32).astype(float))
    centred = x - x.mean(axis=0)
    assert sums.n == 400 and np.allclose(r.T @ r, centred.T @ centred, rtol=1e-12, atol=1e-4)


# ---- hard negatives ----------------------------------------------------------


def brute_force(rows, keep=5):
    """(anchor, positive, rank, negative, scores), rows without unusable ones."""
    usable = {
        (i, label, tuple(np.floor(256 * np.asarray(v, np.float32).astype(float)).astype(int)))
        for i, v, label in rows
    }
    last = float("inf")
    out = []
    for i, label, x in usable:
        if i is None or i % 100:
            continue
        others = [
            (-int(np.dot(x, y)), last if j is None else j, other == label)
            for j, other, y in usable
            if j != i
        ]
        others.sort(key=lambda o: o[:2])
        for p, positive, _ in [o for o in others if o[2]][:keep]:
            near = [o for o in others if not o[2] and 80 * -p <= 100 * -o[0] <= 100 * -p]
            out += [
                (i, positive, k + 1, negative, -p, -score)
                for k, (score, negative, _) in enumerate(near[:keep])
            ]
    return sorted(tuple(None if v == last else v for v in row) for row in out if last not in row[:2]) + [
        row for row in out if last in row[:2]
    ]


def mined(spark, rows):
    frame = vector_frame(spark, rows)
    found = negatives.mine(frame, F.col("vec_id") % 100 == 0).collect()
    return sorted(
        (r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score)
        for r in found
    )


def clustered(n, d, spread, seed):
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((6, d))
    at = draw.integers(0, 6, n)
    scale = draw.uniform(0.2, 2, (n, 1))
    vectors = (centres[at] + spread * draw.standard_normal((n, d))) * scale
    return [(k, v.tolist(), int(draw.integers(0, 3))) for k, v in enumerate(vectors.astype(np.float32))]


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, spread):
    """Several blocks, groups and lengths; ties from a vector that a third of the rows have."""
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 300)
    monkeypatch.setattr(negatives, "GROUP_ANCHORS", 4)
    rows = clustered(1000, 8, spread, 7)
    rows = [(i, rows[5][1], i % 2) if i % 3 == 0 else (i, v, label) for i, v, label in rows]
    assert mined(spark, rows) == brute_force(rows)


def test_hard_negatives_of_edge_rows(spark):
    rows = clustered(260, 4, 0.3, 8)
    zero = [(300, [0.0] * 4, 1), (301, [0.0] * 4, 1), (302, [0.0] * 4, 2), (303, [0.0] * 4, 2)]
    alone = [(400, [0.5, 0.5, 0.5, 0.5], 77)]
    rows += zero + alone + [rows[0]] * 9 + [rows[17]] * 9 + [(7, rows[30][1], 2)]
    unusable = [
        (500, None, 1),
        (501, [], 1),
        (600, [1.0, None, 0.0, 0.0], 1),
        (601, [float("nan")] * 4, 1),
        (700, [float("-inf")] * 4, 1),
        (701, [1.0, 1.0], 1),
        (800, [1.0, 1.0, 1.0, 1.0], None),
    ]
    assert mined(spark, rows + unusable) == brute_force(rows)
    assert mined(spark, []) == []
    assert mined(spark, alone) == []


def test_a_null_id_is_found_last_and_never_an_anchor(spark):
    same = [0.5, 0.25, -1.0, 2.0]
    rows = [(0, same, 1), (1, same, 1), (2, same, 2), (None, same, 2)]
    expected = [(0, 1, 1, 2, 348_160, 348_160), (0, 1, 2, None, 348_160, 348_160)]
    assert mined(spark, rows) == expected


def test_coordinate_ranges_leave_out_rows_and_lose_none():
    rows = clustered(3000, 6, 0.02, 9)
    x = np.floor(256 * np.array([v for _, v, _ in rows])).astype(np.int64)
    ids, labels = np.arange(len(x)), np.array([label for *_, label in rows])
    block = negatives.Block(x, ids, labels)
    assert len(block.buckets) > 3
    low, high = np.full((30, 1), -np.inf), np.full((30, 1), np.inf)
    wanted = negatives.Wanted(x[::100], ids[::100], labels[::100], low, high, True, 5)
    verified = negatives.search(block, wanted)
    assert verified < 0.5 * len(x) * 30
    for k in range(30):
        fits = (labels == labels[100 * k]) & (ids != 100 * k)
        scores = x @ x[100 * k]
        order = np.lexsort((ids, -scores))
        first = order[fits[order]][:5]
        scores_found, rows_found = wanted.best[k, 0]
        assert block.order[rows_found].tolist() == first.tolist()
        assert scores_found.tolist() == scores[first].tolist()


def test_feasible_ranges_hold_every_partner():
    draw = np.random.default_rng(4)
    a, b = (v / np.linalg.norm(v, axis=1)[:, None] for v in draw.standard_normal((2, 5000, 3)))
    low, high = negatives.feasible(a, (a * b).sum(axis=1)[:, None])
    assert ((low <= b) & (b <= high)).all()
