"""Operators on the whole corpus against brute force; hot groups, edge rows and the pipeline."""

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from checks.compare import differences, duck
from sedimenta.llm import components, contamination, neardup, oracles, queries
from sedimenta.llm.common import stored

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DDL = "doc_id bigint, text string, component string, key string, _set string"


def words(text):
    return WORD.findall((text or "").translate(ASCII))


def shingles(text, width):
    own = words(text)
    if not own:
        return frozenset()
    return frozenset(tuple(own[k : k + width]) for k in range(max(1, len(own) - width + 1)))


def expected_components(rows, width):
    """Set size and component of every row, by comparing all pairs."""
    sets = [shingles(text, width) for _, text in rows]
    group = list(range(len(rows)))

    def top(k):
        while group[k] != k:
            k = group[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                group[top(a)] = top(b)
    lowest = collections.defaultdict(list)
    for k, (doc_id, _) in enumerate(rows):
        lowest[top(k)].append(doc_id)
    least = {k: min((i for i in ids if i is not None), default=None) for k, ids in lowest.items()}
    return sorted(
        ((rows[k][0], len(sets[k]), least[top(k)] if sets[k] else rows[k][0]) for k in range(len(rows))),
        key=str,
    )


def found_components(df, width):
    rows = neardup.find(df, width).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str)


def test_near_duplicates_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = queries.op1_minhash_dedup(spark, sf_dir).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str) == expected_components(rows, 2)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def edited(draw, own, share):
    return " ".join(f"e{draw.randint(0, 10**6)}" if draw.random() < share else w for w in own)


def test_hot_groups_lose_no_link(spark):
    """Chains and near copies around the threshold, a passage that many texts share, copies."""
    draw = random.Random(11)
    base = [f"w{k}" for k in range(80)]
    passage = " ".join(f"p{k}" for k in range(60))
    texts = [edited(draw, base, 0.05) for _ in range(120)]
    texts += [f"{passage} {edited(draw, base[:40], 1)}" for _ in range(80)]
    texts += [" ".join(base)] * 40
    chain = list(base)
    for k in range(0, 80, 4):
        chain[k : k + 4] = [f"c{k}", *chain[k + 1 : k + 4]]
        texts.append(" ".join(chain))
    draw.shuffle(texts)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found_components(df, 2) == expected_components(rows, 2)


def test_marks_meet_a_class_once_for_all_its_buckets(spark, monkeypatch):
    """Near copies that are not linked share many buckets; the join with the marks has a row a class."""
    draw = random.Random(12)
    base = [f"w{k}" for k in range(60)]
    rows = [(k, edited(draw, base, 0.09)) for k in range(150)]
    made = []

    def noted(df, purpose, compression=None):
        if purpose == "open-buckets":
            plan = df._jdf.queryExecution().optimizedPlan()
            made.append(plan.toString())
        return stored(df, purpose, compression)

    monkeypatch.setattr(neardup, "stored", noted)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found_components(df, 2) == expected_components(rows, 2)
    assert made
    for plan in made:
        lines = plan.splitlines()
        [marks] = [k for k, line in enumerate(lines) if "Join Inner, (key#" in line]
        assert any("Generate inline" in line for line in lines[:marks])
        assert any("collect_list" in line for line in lines[marks:])


def test_few_members_outside_the_largest_component_end_a_bucket(spark, monkeypatch):
    """Passes do not go on until all members have been pivots, and no link is lost."""
    draw = random.Random(13)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(96):
        own = list(base)
        for place in draw.sample(range(60), 8 if k < 4 else 1):
            own[place] = f"e{k}x{place}"
        rows.append((k, " ".join(own)))
    passes = []

    def noted(df, purpose, compression=None):
        passes.append(purpose)
        return stored(df, purpose, compression)

    monkeypatch.setattr(neardup, "stored", noted)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found_components(df, 2) == expected_components(rows, 2)
    assert passes.count("open-buckets") == 2  # the second finds none left


def test_sketches_lose_no_similar_pair(spark):
    """The distance of two sketches never exceeds the symmetric difference; likely() keeps every
    pair of 0.8 or more and leaves out most that fall short."""
    import numpy as np

    draw = np.random.RandomState(3)
    rows, similar, short = [], 0, 0
    for k in range(400):
        a = np.unique(draw.randint(0, 1 << 62, draw.choice([1, 5, 60, 300, 1500])).astype(np.uint64))
        fresh = draw.randint(0, 1 << 62, len(a) // 8 + 1).astype(np.uint64)
        b = np.unique(np.concatenate([a[draw.randint(0, len(a) // 4 + 1) :], fresh[: draw.randint(0, len(fresh) + 1)]]))
        if not len(b):
            continue
        apart = sum((int(x) & (2**64 - 1)).bit_count() for x in neardup.sketch(a) ^ neardup.sketch(b))
        assert apart <= len(np.setxor1d(a, b))
        common = len(np.intersect1d(a, b))
        marks = [
            [int(x) for x in np.concatenate([neardup.sketch(x), neardup.signature(neardup.minima(x))])]
            for x in (a, b)
        ]
        is_similar = 100 * common >= 80 * (len(a) + len(b) - common)
        rows.append((len(a), marks[0], len(b), marks[1], is_similar))
    df = spark.createDataFrame(rows, "n bigint, m array<bigint>, k bigint, o array<bigint>, is_similar boolean")
    passes = neardup.likely(F.col("n"), F.col("m"), F.col("k"), F.col("o"))
    found = {(r.is_similar, r.passes): r["count"] for r in df.groupBy("is_similar", passes.alias("passes")).count().collect()}
    assert (True, False) not in found and found[True, True] > 50
    assert found[False, False] > 3 * found.get((False, True), 0)


def test_near_duplicate_edge_rows(spark):
    long = " ".join(f"word{k}" for k in range(20_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One"), (5, "one"), (6, "a b"), (7, "A  B\n"), (None, "x y z"),
            (9, "x y z"), (None, None), (4, "one"), (4, "something else here"), (12, long), (13, long + " end"), (14, "é É")]
    df = spark.createDataFrame([(*r, "c", "k", "s") for r in rows], DDL)
    assert found_components(df, 2) == expected_components(rows, 2)
    assert neardup.find(df.limit(0), 2).count() == 0
    kept = neardup.dedupe(df, 5)
    assert kept.columns == df.columns
    ids = collections.Counter(r.doc_id for r in kept.collect())
    assert ids == collections.Counter([1, 2, 3, None, 4, 4, 6, 9, 12, 14])
    assert neardup.dedupe(df.limit(0), 5).count() == 0


def test_one_row_of_repeated_rows_stays(spark):
    df = spark.createDataFrame([(1, "a b c d e f")] * 5 + [(2, "A B C D E F")], "doc_id bigint, text string")
    assert [r.doc_id for r in neardup.dedupe(df, 5).collect()] == [1]


def test_minima_estimate_the_similarity():
    import numpy as np

    draw = random.Random(5)
    own = [f"w{draw.randint(0, 10**9)}".encode() for _ in range(600)]
    a = neardup.shingle_set(own[:500], 1)
    b = neardup.shingle_set(own[100:], 1)
    similarity = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    agree = (neardup.minima(a) == neardup.minima(b)).mean()
    assert abs(agree - similarity) < 0.12


@pytest.mark.parametrize("shape", ["path", "star", "random", "empty"])
def test_connected_components(spark, shape):
    draw = random.Random(3)
    edges = {
        "path": [(k, k + 1) for k in range(60)],
        "star": [(500, k) for k in range(100)] + [(3, 3), (500, 1)],
        "random": [(draw.randint(0, 120), draw.randint(0, 120)) for _ in range(90)],
        "empty": [],
    }[shape]
    group = {}
    for a, b in edges:
        if a != b:
            low, high = sorted((group.setdefault(a, a), group.setdefault(b, b)))
            group = {k: low if v == high else v for k, v in group.items()}
    found = components.connected(spark.createDataFrame(edges, "u bigint, v bigint")).collect()
    assert len(found) == len(group) and {r.node: r.root for r in found} == group


# ---- benchmark items -------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    result = contract.queries()[name](spark, sf_dir).toArrow()
    expected = duck(sf_dir).sql(contract.oracle_sql()[name]).arrow().read_all()
    assert differences(result, expected) == ""


def test_leaks_equal_brute_force(spark, monkeypatch):
    draw = random.Random(9)
    items = [(k, " ".join(f"i{k}_{j}" for j in range(n))) for k, n in enumerate([1, 3, 5, 8, 20, 60])]
    items += [(None, "null id item of some words"), (3, items[3][1]), (90, None), (91, " "), (92, "")]
    long = [f"w{draw.randint(0, 500)}" for _ in range(8000)]
    docs = [(0, None), (1, ""), (2, "i0_0"), (None, items[4][1].upper()), (3, "x null id item of some words y")]
    for k, (_, text) in enumerate(items[:6]):
        at = draw.randint(0, 7000)
        docs.append((10 + k, " ".join([*long[:at], text, *long[at:]])))
        cut = text.split()
        docs.append((20 + k, " ".join([*long[:50], *cut[: int(len(cut) * 0.9)], "end"])))
        docs.append((30 + k, " ".join([*long[:50], *cut[: len(cut) // 2], "end"])))
    docs += [docs[5], (10, "same id, other text")]
    expected = {}
    for doc_id, text in docs:
        for item_id, item in items:
            width = min(5, len(words(item)))
            if width:
                parts = shingles(item, width)
                own = words(text)
                held = {tuple(own[j : j + width]) for j in range(len(own) - width + 1)}
                share = len(parts & held) / len(parts)
                if share >= 0.8:
                    key = (doc_id, item_id)
                    expected[key] = max(expected.get(key, 0), share)
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id bigint, text string, item string")
    bench = spark.createDataFrame([(*i, 1) for i in items], "item_id bigint, text string, n int")
    for rows in (contamination.BROADCAST_ROWS, 0):
        monkeypatch.setattr(contamination, "BROADCAST_ROWS", rows)
        found = {(r.doc_id, r.item_id): r.containment for r in contamination.find(df, bench).collect()}
        assert found == pytest.approx(expected)
    clean = contamination.clean(df, bench)
    assert clean.columns == df.columns
    leaked = {doc_id for doc_id, _ in expected}
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in docs} - leaked
    assert contamination.find(df.limit(0), bench).count() == 0
    assert contamination.find(df, bench.limit(0)).count() == 0


# ---- pipeline --------------------------------------------------------------------


def test_pipeline_keeps_and_drops(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    now = docs.withColumns({c: F.lit(c) for c in ("lines", "score", "stats", "_x", "ids")})
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id for r in now.select("doc_id").collect()}
        path = f"{spark.conf.get('spark.checkpoint.dir')}/pipeline-test-{name}-{random.random()}"
        stage(spark, now, sf_dir).write.parquet(path)
        after = spark.read.parquet(path)
        kept = {r.doc_id for r in after.select("doc_id").collect()}
        assert kept <= before
        if name != "tokens":
            assert sorted(after.columns) == sorted(now.columns)
        if name == "rules":
            assert not any(labels.get(i) == 1 and len(words(rows[i])) >= 50 for i in before - kept)
        if name == "dedup":
            survivors = [(i, rows[i]) for i in sorted(before)]
            assert kept == {c for _, _, c in expected_components(survivors, 5)}
        if name == "benchmark":
            found = contamination.find(now, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
            assert before - kept == {r.doc_id for r in found.collect()}
        sizes.append(len(kept))
        now = after
    assert sizes[0] > sizes[1] >= sizes[2] > sizes[3] > sizes[4] == sizes[5] > 0
    run = corpus_pipeline.run(spark, sf_dir)
    assert run.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"] and run.count() == sizes[5]


def test_pipeline_on_empty_and_null_rows(spark, root):
    ddl = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    good = " ".join(f"Word{k} goes" for k in range(60)) + "."
    rows = [(None,) * 5, (1, None, None, None, None), (2, "", "en", "s", 0), (3, good, None, None, None), (3, good, None, None, None)]
    for name, own in (("none", []), ("few", rows)):
        folder = f"{root}/{name}"
        spark.createDataFrame(own, ddl).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
        result = corpus_pipeline.run(spark, folder).collect()
        assert [r.doc_id for r in result] == ([3] if own else [])


def test_entry_works_without_the_subpackage(tmp_path):
    import os
    import shutil
    import subprocess
    import sys

    top = os.path.dirname(os.path.abspath(contract.__file__))
    for part in ("sedimenta", "checks", "__spark_entry__.py"):
        source = os.path.join(top, part)
        copy = shutil.copytree if os.path.isdir(source) else shutil.copy
        copy(source, tmp_path / part, **({"ignore": shutil.ignore_patterns("llm")} if os.path.isdir(source) else {}))
    code = "import __spark_entry__ as e; assert e.queries().keys() == e.oracle_sql().keys()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": os.environ["PATH"], "HOME": str(tmp_path)})
