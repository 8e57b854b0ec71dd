"""Nearest neighbours against brute force: exact with factor one, high recall with the fitted one."""

from __future__ import annotations

import math
import os
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from daystar.llm import neighbours, vp_tree
from daystar.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<double>, score string"


def usable(vector):
    return vector is not None and None not in vector and all(map(math.isfinite, vector)) and any(vector)


def brute(rows, asked, k):
    """Bag of (query_id, rank, vec_id, score) over all pairs of rows (vec_id, vector)."""
    good = [(i, v) for i, v in rows if usable(v)]
    out = []
    for at, (query, one) in enumerate(good):
        if query is None or not asked(query):
            continue
        scored = [
            (float(np.einsum("i,i->", one, two)), other)
            for to, (other, two) in enumerate(good)
            if to != at and len(two) == len(one)
        ]
        scored.sort(key=lambda pair: (-pair[0], pair[1] is None, pair[1] or 0))
        out += [(query, rank, other, round(score, 9)) for rank, (score, other) in enumerate(scored[:k], 1)]
    return Counter(out)


def bag(df):
    return Counter((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in df.collect())


def awkward():
    """Clusters, equal and scaled vectors, two lengths, shared and missing ids, and unusable vectors."""
    draw = np.random.default_rng(5)
    rows = []
    for centre in range(5):
        base = draw.integers(-8, 9, 6)
        rows += [(centre * 60 + i, [float(x) for x in base + draw.integers(-2, 3, 6)]) for i in range(60)]
    rows += [(20, [1.0, 2.0, 0.0, 0.0, 1.0, 5.0])] * 2 + [(None, [1.0, 2.0, 0.0, 0.0, 1.0, 5.0])] * 3
    rows += [(400, [3.0, 4.0]), (401, [1.0, 0.0]), (402, [0.5, 0.5]), (440, [9.0])]
    rows += [(460, None), (480, []), (500, [0.0] * 6), (520, [math.nan] * 6), (540, [math.inf] * 6), (560, [None, 1.0])]
    return rows


@pytest.mark.parametrize("shard_bytes", [4 << 20, 6 * 8 * 40], ids=["one-shard", "many-shards"])
def test_exact_search(spark, monkeypatch, shard_bytes):
    monkeypatch.setattr(neighbours, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(neighbours, "BLOCK_BYTES", 6 * 8 * 4)
    rows = awkward()
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA).repartition(4)
    found = neighbours.nearest(df, F.col("vec_id") % 20 == 0, k=7, factors=())
    assert bag(found) == brute(rows, lambda i: i % 20 == 0, 7)
    assert neighbours.nearest(df.limit(0), F.lit(True)).count() == 0
    assert neighbours.nearest(df.where("vec_id = 440"), F.lit(True)).count() == 0


def test_trees_are_exact_with_factor_one():
    draw = np.random.default_rng(1)
    for size, dims in ((1, 2), (40, 2), (900, 3), (700, 12)):
        vectors = draw.standard_normal((size, dims)) * draw.uniform(0.2, 3, (size, 1))
        vectors[::9] = vectors[0]
        order, bounds = vp_tree.build(vectors, leaf=16)
        tree = vp_tree.Tree(vectors[order], order, np.zeros(size, bool), order, bounds, leaf=16)
        best = vp_tree.Nearest(vectors, np.arange(size), 5)
        tree.search(best, 1.0)
        for at in range(size):
            scores = np.einsum("ij,j->i", vectors, vectors[at])
            wanted = [i for i in np.lexsort((np.arange(size), -scores.round(12))) if i != at][:5]
            assert np.allclose(best.scores[at][: len(wanted)], scores[wanted])
            assert len(set(best.found[at][best.found[at] >= 0])) == len(wanted)


@pytest.mark.parametrize("dims", [3, 16, 64])
def test_fitted_factor_prunes_and_finds(dims):
    """In few and in many dimensions the fitted factor finds the share it is asked for."""
    draw = np.random.default_rng(2)
    vectors = draw.standard_normal((4000, dims))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    order, bounds = vp_tree.build(vectors)
    tree = vp_tree.Tree(vectors[order], order, np.zeros(4000, bool), order, bounds)
    factor = vp_tree.fitted_factor(tree, 20, neighbours.FACTORS, neighbours.WANTED)
    asked = np.arange(0, 4000, 20)
    results = []
    for own in (1.0, factor):
        tree.compared = 0
        best = vp_tree.Nearest(vectors[asked], asked, 20)
        tree.search(best, own)
        results.append((tree.compared, [set(found) for found in best.found]))
    recall = np.mean([len(a & b) / 20 for a, b in zip(results[0][1], results[1][1], strict=True)])
    assert recall >= 0.93 and results[1][0] <= results[0][0]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    rows = [(i, None if v is None else [float(x) for x in v]) for i, v in rows]
    found = bag(QUERIES["op11_neighbours"](spark, SF_DIR))
    wanted = brute(rows, lambda i: i % 20 == 0, 20)
    assert sum(found.values()) == sum(wanted.values())
    pairs = [{(query, other) for query, _, other, _ in table} for table in (found, wanted)]
    assert len(pairs[0] & pairs[1]) >= 0.9 * len(pairs[1])
