"""Sparse features, models and total orders against closed forms, planted structure and plain sorting."""

import json
import random

import numpy as np
import pytest
from pyspark.ml.linalg import SparseVector, Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

import __spark_entry__ as E
from postlens.operators import ml as ML
from postlens.operators.median import exact_median
from postlens.operators.ranking import with_rank


@pytest.mark.parametrize("width", [300, 5000])
def test_ridge_of_any_width_equals_closed_form(spark, width):
    rng = np.random.default_rng(width)
    n, alpha = 900, 10.0
    X = (rng.random((n, width)) < 6 / width).astype(float)
    X[:, 0] = rng.random(n) < 0.5
    y = 60000 + X @ rng.normal(0, 9000, width) + rng.normal(0, 2000, n)
    schema = StructType([StructField("features", VectorUDT()), StructField("salary", DoubleType())])
    df = spark.createDataFrame([(Vectors.sparse(width, np.flatnonzero(x).tolist(), [1.0] * int(x.sum())), float(t)) for x, t in zip(X, y)], schema)
    got = ML.ridge_premiums(df.repartition(3), [f"skill: s{i}" for i in range(width)], alpha, head=width, tail=0).collect()
    Xc, yc = X - X.mean(0), y - y.mean()
    w = Xc.T @ np.linalg.solve(Xc @ Xc.T + alpha * np.eye(n), yc)  # the same solution, by the rows' own matrix
    assert len(got) == width and max(abs(r.delta - w[int(r.skill[1:])]) for r in got) <= 1.0
    deltas = [r.delta for r in sorted(got, key=lambda r: r["rank"])]
    assert sorted(r["rank"] for r in got) == list(range(1, width + 1)) and deltas == sorted(deltas, reverse=True)


def test_premiums_head_and_tail_hold_each_feature_once(spark):
    df = spark.createDataFrame([(Vectors.dense([i % 2, i % 3 == 0, i % 5 == 0]), 1000.0 * (i % 2) - 500.0 * (i % 3 == 0)) for i in range(200)], ["features", "salary"])
    names = spark.createDataFrame([("skill: a", 0), ("remote", 1), ("skill: c", 2)], "feature string, idx int")
    got = ML.ridge_premiums(df, names, 0.001, head=10, tail=4).collect()
    assert {(r.skill, r["rank"]) for r in got} == {("a", 1), ("c", 2)} and {r.skill: r.delta for r in got}["a"] in (999, 1000)


def test_features_are_sparse_vectors_over_an_index(spark):
    postings = spark.createDataFrame(
        [(1, "entry", "Boston", True, 50000.0, 70000.0), (2, None, "Austin", None, 40000.0, 60000.0), (3, "odd", None, False, 90000.0, 90000.0),
         (4, "mid", "Boston", True, None, 70000.0), (5, "mid", "x", True, 1.0, 2.0)],
        "job_id long, seniority string, location string, remote boolean, salary_min double, salary_max double")
    terms = spark.createDataFrame([(1, "sql"), (1, "sql"), (1, "go"), (2, "sql"), (4, "go"), (None, "sql"), (3, None)], "job_id long, skill string")
    x, index = ML.build_features(postings, terms, [("B", ["Boston"])], min_n=2)
    assert {r.feature: r.idx for r in index.collect()} == {"metro: B": 0, "metro: Other": 1, "remote": 2, "seniority: entry": 3, "skill: sql": 4}
    assert {r.job_id: r.features for r in x.collect()} == {
        1: SparseVector(5, [0, 2, 3, 4], [1.0] * 4), 2: SparseVector(5, [1, 4], [1.0] * 2), 3: SparseVector(5, [1], [1.0])}
    assert sorted(map(tuple, ML.vector_entries(x, "job_id").collect())) == [(1, 0, 1.0), (1, 2, 1.0), (1, 3, 1.0), (1, 4, 1.0), (2, 1, 1.0), (2, 4, 1.0), (3, 1, 1.0)]
    x, index = ML.build_features(postings.limit(0), terms, [("B", ["Boston"])])
    assert x.count() == 0 and index.count() == 0


def test_planted_clusters_are_found(spark):
    rng = random.Random(8)
    topics = [[f"{t}{c}" for c in "abcdefgh"] for t in ("alpha", "beta", "gamma", "delta")]
    rows = [(i, " ".join(rng.choice(topics[i % 4]) for _ in range(12)) + f" once{'x' * (i % 50)}") for i in range(400)] + [(1000, "unheardof")]
    found = ML.cluster_roles(spark.createDataFrame(rows, "job_id long, doc string"), k=4, seeds=(1, 2, 3)).collect()
    assert len(found) == 401
    of = {r.job_id: r.cluster for r in found}
    assert len({of[i] for i in range(4)}) == 4 and all(of[i] == of[i % 4] for i in range(400))


def test_trees_and_report(spark):
    rng = np.random.default_rng(5)
    rows = [(i, 30000.0 + 20000 * float(a) + 9000 * float(b) + float(rng.normal(0, 500)), Vectors.sparse(3, [j for j, v in enumerate((a, b, c)) if v], [1.0] * (int(a) + int(b) + int(c))))
            for i, (a, b, c) in enumerate(rng.random((500, 3)) < 0.5)]
    x = ML.split(spark.createDataFrame(rows, StructType.fromDDL("job_id long, salary double").add("features", VectorUDT())), "job_id")
    index = spark.createDataFrame([("skill: a", 0), ("skill: b", 1), ("remote", 2)], "feature string, idx int")
    r = ML.model_report(x, index, rounds=20, depth=3).first().asDict(recursive=True)
    assert list(r) == ["n_postings", "n_features", "n_test", "baseline_mae", "mae", "r2", "mae_improvement_pct", "premiums"]
    assert r["n_postings"] == 500 and r["n_features"] == 3 and r["n_test"] == x.where("is_test").count()
    assert r["mae"] < 0.2 * r["baseline_mae"] and r["r2"] > 0.95 and r["mae_improvement_pct"] > 80
    assert [p["skill"] for p in r["premiums"]] == ["a", "b"] and abs(r["premiums"][0]["delta"] - 20000) < 2500


def test_rows_of_vectors_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    def count(k):
        made.add(1)
        return f"f{k % 9}"

    rows = spark.range(200).select((F.col("id") % 40).alias("k"), F.udf(count)("id").alias("feature"), F.lit(1.0).alias("value"))
    x, index = ML.sparse_vectors(spark.range(41).withColumnRenamed("id", "k"), rows, ["k"])
    assert x.count() == 41 and index.count() == 9 and sum(r.value for r in ML.vector_entries(x, "k").collect()) == 200 and made.value == 200


def test_salaries_and_terms_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    def count(k):
        made.add(1)
        return "a" if k % 2 else "b"

    postings = spark.range(60).select(F.col("id").alias("job_id"), F.udf(count)("id").alias("location"), F.lit("mid").alias("seniority"), F.lit(True).alias("remote"),
                                      F.lit(50000.0).alias("salary_min"), F.lit(60000.0).alias("salary_max"))
    terms = spark.range(60).select(F.col("id").alias("job_id"), F.udf(count)("id").alias("skill"))
    x, index = ML.build_features(postings, terms, [("A", ["a"])], min_n=2)
    assert x.count() == 60 and index.count() == 6 and made.value == 120


def test_trees_are_fitted_on_even_parts(spark, monkeypatch):
    seen, cores = [], spark.sparkContext.defaultParallelism
    fit = ML.GBTRegressor.fit
    monkeypatch.setattr(ML, "DEAL_FROM", 400)
    monkeypatch.setattr(ML.GBTRegressor, "fit", lambda self, df: (seen.append([len(p) for p in df.rdd.glom().collect()]), fit(self, df))[1])
    rows = [(float(i % 7), i % 5 == 0, Vectors.dense([i % 2, i % 3])) for i in range(400)]
    df = spark.createDataFrame(rows, StructType.fromDDL("salary double, is_test boolean").add("features", VectorUDT())).repartition(cores + 1)
    assert ML.boosted_trees(df, rounds=2).first().n_test == 80
    assert len(seen[0]) == 2 * cores and sum(seen[0]) == 320 and min(seen[0]) > 0


@pytest.mark.parametrize("name", ["gbt_metrics", "kmeans_profile", "ridge_premiums", "model_artifact"])
def test_model_queries_run(spark, sf, name):
    rows = E.queries()[name](spark, sf).collect()
    assert rows
    if name == "model_artifact":
        assert len(json.loads(rows[0].artifact)) == 8


@pytest.mark.parametrize("parts", [1, 7])
def test_rank_is_a_total_order(spark, parts):
    rng = random.Random(1)
    rows = [(i, rng.choice([None, 1, 2, 2, 2, 3])) for i in range(500)]
    got = with_rank(spark.createDataFrame(rows, "k long, v int").repartition(parts), [F.col("v").desc_nulls_last(), "k"], "place", 0).collect()
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert {r.place: (r.k, r.v) for r in got} == dict(enumerate(want))
    assert with_rank(spark.createDataFrame([], "k long"), ["k"]).count() == 0


def test_median_of_a_whole_frame_plans_no_product(spark):
    df = spark.createDataFrame([(i, None if i % 7 == 0 else float(i * i % 101)) for i in range(501)], "k long, v double")
    med = exact_median(df, [], "v", "m", "n")
    assert med.first().asDict() == {"n": 429, "m": float(np.median([i * i % 101 for i in range(501) if i % 7]))}
    plan = med._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert exact_median(df.where("v < 0"), [], "v").count() == 0
