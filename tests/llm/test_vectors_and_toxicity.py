"""Clusters by scalar tables, whitening by Jacobi-Davidson, toxicity: against brute force and held-out labels."""

import hashlib
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fixtrail.llm import jacobi_davidson, table_kmeans, toxicity

EMBEDDINGS = "vec_id long, embedding array<float>, cluster string, distance string, white string"


def embeddings(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], "c", None, "w") for i, v in zip(ids, vectors, strict=True)]
    return spark.createDataFrame(rows, EMBEDDINGS).repartition(3)


def clusters_by_hand(ids, x, k, rounds, seed=3):
    order = sorted(range(len(x)), key=lambda r: (hashlib.sha256(f"{seed}:{'' if ids[r] is None else ids[r]}".encode()).hexdigest(), x[r]))
    centroids = [list(x[r]) for r in order[:k]]

    def assign():
        out = []
        for v in x:
            d = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        found = assign()
        for c in range(len(centroids)):
            mine = [x[r] for r in range(len(x)) if found[r][0] == c]
            if mine:
                centroids[c] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    return assign(), centroids


def test_clusters_equal_plain_rounds(spark):
    rng = np.random.default_rng(5)
    good = [*rng.normal(size=(150, 6)).tolist(), [0.0] * 6, [0.0] * 6, [1 / 3] * 6, [-1e-9] * 6]
    bad = [None, [], [1.0] * 5, [1.0] * 7, [1.0] * 5 + [None], [1.0] * 5 + [math.nan], [math.inf] + [1.0] * 5]
    ids = [*range(150), 7, 7, None, -4, *range(900, 907)]
    df = embeddings(spark, good + bad, ids)
    rows = table_kmeans.cluster_vectors(df, dims=6, k=5, rounds=4).collect()
    x = [[math.floor(1024 * float(np.float32(c))) for c in v] for v in good]
    wanted, centroids = clusters_by_hand(ids[: len(good)], x, 5, 4)
    inertia = [sum(d for c, d in wanted if c == k) for k in range(5)]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    expected = [(i, c, d, inertia[c], sum(inertia), digests[c]) for i, (c, d) in zip(ids, wanted, strict=False)]
    assert sorted(map(tuple, rows), key=str) == sorted(expected, key=str)


def test_few_and_no_vectors_to_cluster(spark):
    three = table_kmeans.cluster_vectors(embeddings(spark, [[1.0, 2.0], [1.0, 2.0], [5.0, 5.0]]), dims=2).collect()
    assert len(three) == 3 and {r["distance"] for r in three} == {0} and len({r["cluster"] for r in three}) == 2
    assert table_kmeans.cluster_vectors(embeddings(spark, [])).collect() == []
    assert table_kmeans.cluster_vectors(embeddings(spark, [None, [1.0]])).collect() == []
    with pytest.raises(Exception, match="too large in vector 0"):
        table_kmeans.cluster_vectors(embeddings(spark, [[1e30, 0.0]]), dims=2).collect()


def test_places_and_tables_give_exact_distances():
    rng = np.random.default_rng(1)
    x, centroids = rng.integers(-900, 900, (300, 7)), rng.integers(-900, 900, (4, 7))
    cluster, distance, back = table_kmeans.nearest(*table_kmeans.encoded(x), centroids)
    d = ((x[:, None] - centroids) ** 2).sum(2)
    assert (cluster == d.argmin(1)).all() and (distance == d.min(1)).all() and (back.T == x).all()


@pytest.mark.parametrize("kind", ["spread", "clustered", "equal", "low rank", "wide"])
def test_largest_pairs_reach_double_precision(kind):
    rng = np.random.default_rng(4)
    values = {
        "spread": rng.uniform(1, 100, 64),
        "clustered": np.repeat([3.0, 5.0, 5.0 + 1e-9, 9.0], 12),
        "equal": np.full(40, 2.0),
        "low rank": np.concatenate([np.zeros(50), [1e-3, 1.0, 7.0]]),
        "wide": rng.uniform(0, 1, 260) ** 4,
    }[kind]
    turn = np.linalg.qr(rng.normal(size=(len(values), len(values))))[0]
    matrix = (turn * values) @ turn.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = jacobi_davidson.largest_pairs(lambda b: matrix @ b, len(values), 32, width=8)
    assert np.allclose(found, np.sort(values)[::-1][: len(found)], rtol=0, atol=1e-12 * values.max() * 4)
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-12 * values.max()
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-13


def test_minres_solves_columns_in_step():
    rng = np.random.default_rng(2)
    a = rng.normal(size=(12, 12))
    a = a + a.T
    right = np.column_stack([rng.normal(size=(12, 3)), np.zeros(12)])
    x = jacobi_davidson.minres(lambda b: a @ b, right, 40, enough=1e-13)
    assert np.allclose(a @ x, right, atol=1e-8)


def test_whitening_equals_dense_eigenvectors(spark):
    rng = np.random.default_rng(8)
    good = (rng.normal(size=(400, 10)) * np.linspace(0.2, 3, 10)).astype(np.float32)
    good[7] = good[3]
    bad = [None, [], [1.0] * 9, [1.0] * 9 + [None], [1.0] * 9 + [math.nan], [1.0] * 9 + [-math.inf]]
    df = embeddings(spark, [*good.tolist(), *bad], [*range(399), None, *range(900, 906)])
    rows = jacobi_davidson.whiten(df, components=4).collect()
    x = np.floor(64 * good.astype(float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(0)
    centred = (n * x - sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:4], vectors[:, ::-1][:, :4]
    white = centred @ vectors / np.sqrt(values)
    got = np.full((400, 4), np.nan)
    for r in rows:
        k = 399 if r["vec_id"] is None else r["vec_id"]
        got[k, r["component"] - 1] = r["whitened"]
        assert r["n"] == n and int(r["deviation"]) == int(((n * x[k] - sums) ** 2).sum())
        assert math.isclose(r["explained"], values[r["component"] - 1] / np.trace(np.cov(x.T, bias=True)), rel_tol=1e-9)
        assert r["identity_error"] < 1e-10
    assert len(rows) == 1600 and np.allclose(got * np.sign((got * white).sum(0)), white, atol=1e-9)


def test_deviations_beyond_64_bits():
    centre = jacobi_davidson.Centre(10**10, (10**16 + 3, -(10**17)))
    x = np.array([[1_000_000, -10_000_007], [1_000_900, -10_000_000]], np.int64)
    exact = [sum((centre.n * int(v) - s) ** 2 for v, s in zip(row, centre.sums, strict=True)) for row in x]
    assert [int(d) for d in centre.deviations(x)] == exact
    small = jacobi_davidson.Centre(3, (9, 8))
    assert [int(d) for d in small.deviations(np.array([[4, 2]]))] == [(12 - 9) ** 2 + (6 - 8) ** 2]


def test_nothing_to_whiten(spark):
    assert jacobi_davidson.whiten(embeddings(spark, [])).collect() == []
    assert jacobi_davidson.whiten(embeddings(spark, [None])).collect() == []
    assert jacobi_davidson.whiten(embeddings(spark, [[1.0, 2.0]] * 5)).collect() == []
    two = jacobi_davidson.whiten(embeddings(spark, [[0.0, 1.0, 2.0], [1.0, 1.0, 0.0]])).collect()
    assert [(r["component"], round(abs(r["whitened"]), 12)) for r in two] == [(1, 1.0)] * 2 and two[0]["explained"] == pytest.approx(1)


DOCUMENTS = "doc_id long, text string, lang string, toxic int, score string, words int"
_INSULT = ("grumbling", "zorfian", "vlecht")


def labelled(spark, n=1600):
    rng = np.random.default_rng(9)
    vocabulary = ["".join(rng.choice(list("abcdeiklmnorstu"), 5)) for _ in range(900)]
    docs, labels = [], []
    for k in range(n):
        words = list(rng.choice(vocabulary, rng.integers(5, 120)))
        toxic = int(k % 8 == 0)
        if toxic:
            for _ in range(rng.integers(2, 6)):
                words.insert(int(rng.integers(0, len(words))), str(rng.choice(_INSULT)) + "es"[: int(rng.integers(0, 3))])
        docs.append((k, " ".join(words), "xx", 0, "s", 1))
        labels.append((k, 1, toxic))
    docs += [(n, None, None, 1, None, None), (n + 1, "", None, 1, None, None), (None, "zorfian you zorfian", None, 1, None, None), (n + 3, "wort " * 40_000, None, 1, None, None)]
    docs.append(docs[3])
    labels += [(None, 1, 1), (n + 50, 1, 1), (4, 1, None), (5, 0, 0), (5, 0, 0)]
    return spark.createDataFrame(docs, DOCUMENTS).repartition(4), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_of_held_out_documents(spark):
    docs, labels = labelled(spark)
    rows = toxicity.score_toxicity(docs, labels).collect()
    assert len(rows) == docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
        assert r["held_out"] == (zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode()) % 4 == 2)
    held = [r for r in rows if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 1600]
    hits = sum(r["predicted"] == (r["doc_id"] % 8 == 0) for r in held)
    assert len(held) > 300 and hits / len(held) > 0.98
    assert by_id[1600]["score"] == by_id[1601]["score"] < 0.3 and by_id[1603]["predicted"] == 0
    assert sum(r["doc_id"] == 3 for r in rows) == 2 and by_id[None]["predicted"] == 1


def test_toxicity_ignores_held_out_labels_and_other_columns(spark):
    docs, labels = labelled(spark, 400)
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(4), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one = toxicity.score_toxicity(docs, labels).select("doc_id", "score")
    two = toxicity.score_toxicity(docs.select("text", "doc_id"), flipped).select("doc_id", "score")
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, two.collect()), key=str)


def test_toxicity_without_labels_or_documents(spark):
    docs, labels = labelled(spark, 40)
    none = toxicity.score_toxicity(docs, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.0} and len(none) == 45
    assert toxicity.score_toxicity(docs.limit(0), labels).collect() == []
    clean = toxicity.score_toxicity(docs, labels.where("toxic = 0")).collect()
    assert {r["score"] for r in clean} == {0.0}


def test_isotonic_regression_equals_least_squares_on_blocks():
    rng = np.random.default_rng(6)
    score = np.round(rng.normal(size=80), 1)
    y, weight = (rng.random(80) < 1 / (1 + np.exp(-2 * score))).astype(float), rng.uniform(0.5, 2, 80)
    at, share = toxicity.isotonic(score, y, weight)
    fitted = np.interp(score, at, share)
    assert (np.diff(np.interp(np.sort(score), at, share)) >= -1e-12).all()
    # max-min formula of isotonic regression over distinct scores
    levels = np.unique(score)
    total, mass = (np.array([(weight * v)[score == s].sum() for s in levels]) for v in (y, np.ones(80)))
    mean = lambda i, j: total[i : j + 1].sum() / mass[i : j + 1].sum()
    wanted = [max(min(mean(i, j) for j in range(k, len(levels))) for i in range(k + 1)) for k in range(len(levels))]
    assert np.allclose(fitted, np.array(wanted)[np.searchsorted(levels, score)])


def test_boosted_trees_learn_an_interaction():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0.2) & (x[:, 3] < 0)).astype(float)
    trees = toxicity.boost(x, y, np.ones(3000))
    fresh = rng.normal(size=(2000, 5))
    assert ((trees(fresh) > 0) == ((fresh[:, 0] > 0.2) & (fresh[:, 3] < 0))).mean() > 0.97


def test_features_by_hand():
    words = toxicity.Words({"vlec-": 4.0, "odd": 1.5})
    x = dict(zip(toxicity.FEATURES, toxicity.features("You are a STUPID vlechtes, st*pid 1diot!! s t u p i d noooo odd?", words), strict=True))
    n = 15
    assert math.isclose(x["insults"], 2) and math.isclose(x["strong"], 1) and math.isclose(x["learned"], 2) and math.isclose(x["weight"], 5.5)
    assert math.isclose(x["insult_rate"], 2 / n) and x["longest_spelled"] == 6 and math.isclose(x["shouted_share"], 1 / n)
    assert math.isclose(x["exclaim_rate"], 2 / n) and math.isclose(x["ask_rate"], 1 / n) and math.isclose(x["stretched_share"], 1 / n)
    assert x["disguised_share"] > 0 and x["closest_you"] > 0 and x["near_you"] >= 2 and math.isclose(x["words"], math.log1p(n))
    assert not toxicity.features(None, words).any() and not toxicity.features(" \n", words).any()
