"""Features and models M1-M9 on ``pyspark.ml`` (distributed fits; only model coefficients reach the driver).

* M1 ``build_features``: salary set -> frequent terms -> multi-hot + one-hot + remote in long form -> feature index and
  sparse vectors by aggregation (no list of terms on the driver, no pivot, any width).
* M2 ``split``: hash split (stable under repartitioning, unlike ``randomSplit``).
* M3 ``regression_metrics`` / ``baseline``: MAE, R2, median predictor.
* M4 ``ridge_premiums``: iterative L2 least squares of any width, whose penalty equals an unstandardised ridge with alpha.
* M5 ``boosted_trees``: gradient-boosted trees.
* M6/M7 ``cluster_roles`` / ``tfidf``: smoothed TF-IDF (+1) with L2 norm, KMeans with restarts.
* M8 ``cluster_profile``: size, median, top terms, title-word labels with collision handling.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
import uuid

from pyspark.ml.clustering import KMeans
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from postlens.functions.scalars import LEVELS, explode_present, midpoint, round_even
from postlens.operators.market import flagged_terms, group_profile, region_last, scalar_median, topk_per_group
from postlens.operators.ranking import with_rank
from postlens.operators.tagging import tokenize
from postlens.session import checkpoint_dir, scratch_path

# Title words ignored when labelling clusters.
TITLE_STOPWORDS = [
    "senior", "junior", "staff", "principal", "lead", "sr", "jr", "mid", "level",
    "i", "ii", "iii", "remote", "m", "f", "d", "w", "x", "all", "genders",
    "and", "of", "for", "the", "a", "an", "in", "at", "with", "to",
]

#: Frames of this many rows are dealt evenly over the cores before trees are fitted; for fewer, a pass is short anyway.
DEAL_FROM = 100_000


def salary_set(postings: DataFrame, lo: float = 30000, hi: float = 500000, key: str = "job_id") -> DataFrame:
    """Postings with both bounds and a midpoint inside [lo, hi]; ``salary`` = midpoint."""
    s = postings.where(F.col("salary_min").isNotNull() & F.col("salary_max").isNotNull())
    s = s.withColumn("salary", midpoint())
    return s.where(F.col("salary").between(lo, hi))


def frequent_terms(terms: DataFrame, sal: DataFrame | None, min_n: int, key: str = "job_id", term: str = "skill") -> DataFrame:
    """Terms with at least ``min_n`` rows inside the salary set (None: all of ``terms`` are)."""
    t = terms if sal is None else terms.join(sal.select(key), key, "left_semi")
    return t.groupBy(term).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_n)


def feature_rows(postings: DataFrame, terms: DataFrame, regions: Sequence[tuple[str, Sequence[str]]],
                 min_n: int = 10, lo: float = 30000, hi: float = 500000, key: str = "job_id", term: str = "skill",
                 levels: Sequence[str] = LEVELS, inside: bool = False) -> DataFrame:
    """M1 in long form: (key, salary, feature, value) for every non-zero feature.

    Frequent-term selection is a join against the aggregated term counts, so no term list is collected. ``inside`` says that
    ``terms`` holds rows of the salary set only."""
    sal = salary_set(postings, lo, hi, key)
    kept = frequent_terms(terms, None if inside else sal, min_n, key, term).select(term)
    base = sal.select(key, "salary", "seniority", "remote", region_last("location", regions).alias("metro"))
    # the posting's own features in one generator pass (seniority one-hot, metro, remote) instead of one scan each
    none = F.array().cast("array<string>")
    own = F.concat(
        F.when(F.col("seniority").isin(list(levels)), F.array(F.concat(F.lit("seniority: "), F.col("seniority"))))
        .otherwise(none),
        F.array(F.concat(F.lit("metro: "), F.col("metro"))),
        F.when(F.col("remote").eqNullSafe(True), F.array(F.lit("remote"))).otherwise(none))
    posting = explode_present(base, own, "feature", key, "salary")
    sk = (terms.join(kept, term, "left_semi").join(base.select(key, "salary"), key)
          .select(key, "salary", F.concat(F.lit("skill: "), F.col(term)).alias("feature")).distinct())
    return posting.unionByName(sk).withColumn("value", F.lit(1.0))


def feature_index(rows: DataFrame, feature: str = "feature") -> DataFrame:
    """(feature, idx): the distinct features numbered from 0 in ascending order, by a distributed rank."""
    return with_rank(rows.select(feature).where(F.col(feature).isNotNull()).distinct(), [feature], "idx", first=0).withColumn(
        "idx", F.col("idx").cast("int"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared checkpoint folder and read from there by every later step."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sparse_vectors(base: DataFrame, rows: DataFrame, keys: Sequence[str], feature: str = "feature", value: str = "value"
                   ) -> tuple[DataFrame, DataFrame]:
    """(``base`` with its vectors in column features, index (feature, idx)) from ``rows`` (keys..., feature, value).

    A key's vector holds the summed values of its features and is sparse; a key of ``base`` without rows gets one without
    entries. Vectors are made by aggregation alone: their parts are written as a table of arrays, in the layout in which a vector
    is stored, and read back as vectors. Only their width reaches the driver.

    ``rows`` is made once, though the index samples and reads it and the vectors read it again."""
    spark = base.sparkSession
    checkpoint_dir(spark)
    rows = stored(rows.select(*keys, feature, value), "rows")
    index = feature_index(rows, feature)
    width = index.count()
    cells = rows.groupBy(*keys, feature).agg(F.sum(value).alias("_v")).join(index, feature)
    cells = cells.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("idx", "_v"))).alias("_cells"))
    both = base.join(cells, list(keys), "left").withColumn("_cells", F.coalesce("_cells", F.array().cast("array<struct<idx:int,_v:double>>")))
    vector = F.struct(F.lit(0).cast("byte").alias("type"), F.lit(width).alias("size"), F.transform("_cells", lambda c: c["idx"]).alias("indices"),
                      F.transform("_cells", lambda c: c["_v"]).alias("values"))
    out = both.select(*base.columns, vector.alias("features"))
    path = scratch_path(spark, f"vectors-{uuid.uuid4().hex}")
    out.write.parquet(path)
    schema = StructType([*base.schema.fields, StructField("features", VectorUDT())])
    return spark.read.schema(schema).parquet(path), index


def vector_entries(df: DataFrame, key: str, features: str = "features") -> DataFrame:
    """(key, idx, value): the entries of sparse vectors."""
    parts = F.from_json(F.to_json(F.struct(F.col(features).alias("v"))), "v struct<indices:array<int>,values:array<double>>")["v"]
    pairs = df.select(key, F.arrays_zip(parts["indices"].alias("idx"), parts["values"].alias("value")).alias("p"))
    return explode_present(pairs, F.col("p"), "e", key).select(key, "e.idx", "e.value")


def build_features(postings: DataFrame, terms: DataFrame, regions: Sequence[tuple[str, Sequence[str]]],
                   min_n: int = 10, lo: float = 30000, hi: float = 500000, key: str = "job_id", term: str = "skill",
                   levels: Sequence[str] = LEVELS) -> tuple[DataFrame, DataFrame]:
    """M1: (key, salary, features vector) and the index of its features (feature, idx).

    One-hot seniority (NULL -> zeros), metro last-match-wins incl. 'Other', remote (NULL -> 0), multi-hot frequent terms; a
    feature that no posting has is no column. ``key`` must be unique. The salary set and its terms, which the
    feature rows read several times, are made once for them."""
    sal = stored(salary_set(postings, lo, hi, key).select(key, "salary_min", "salary_max", "seniority", "remote", "location"), "salaries")
    inside = stored(terms.select(key, term).join(sal.select(key), key, "left_semi"), "terms")
    rows = feature_rows(sal, inside, regions, min_n, lo, hi, key, term, levels, inside=True)
    return sparse_vectors(salary_set(postings, lo, hi, key).select(key, "salary"), rows, [key])


def split(df: DataFrame, key: str, test_frac: float = 0.2, seed: int = 42, method: str = "hash") -> DataFrame:
    """M2: add ``is_test``; hash of (key, seed) so the split is independent of partitioning ('mod': key % 5 == 0). The hash is
    the first 8 digits of the SHA-256 of 'key:seed', so that any system can draw the same split."""
    if method == "mod":
        flag = F.pmod(F.col(key), F.lit(round(1 / test_frac))) == 0
    else:
        flag = F.conv(F.substring(F.sha2(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")), 256), 1, 8), 16, 10).cast("long") % 10000 < int(test_frac * 10000)
    return df.withColumn("is_test", flag)


def regression_metrics(df: DataFrame, y: str = "salary", p: str = "prediction") -> DataFrame:
    """M3: MAE and R2 (1 - SS_res / SS_tot around the mean of y) in one aggregation."""
    mean = df.agg(F.avg(y)).first()[0]  # one number; keeps the second pass an ordinary aggregation
    mean_c = F.lit(mean if mean is not None else 0.0)
    m = df.agg(F.avg(F.abs(F.col(y) - F.col(p))).alias("mae"), F.sum((F.col(y) - mean_c) ** 2).alias("_sst"),
               F.sum((F.col(y) - F.col(p)) ** 2).alias("_ssr"), F.count(F.lit(1)).alias("n_test"))
    return m.select("n_test", "mae", (1 - F.try_divide(F.col("_ssr"), F.col("_sst"))).alias("r2"))


def baseline(df: DataFrame, y: str = "salary") -> DataFrame:
    """M3: median of the training labels as the prediction for every test row."""
    med = scalar_median(df.where(~F.col("is_test")), y)
    return df.where(F.col("is_test")).withColumn("prediction", med)


def ridge_premiums(train: DataFrame, names: Sequence[str] | DataFrame, alpha: float = 10.0, prefix: str = "skill: ",
                   head: int = 10, tail: int = 4, y: str = "salary") -> DataFrame:
    """M4: ridge coefficients of the prefixed features, top ``head`` and bottom ``tail`` (each once): skill, delta (rounded
    half-even) and rank, its place among all of them from the largest coefficient on.

    ``names`` is the features' index (feature, idx) or their names in order. The fit is iterative (one pass over the rows a
    step, no matrix of features by features), so any number of features will do. It minimises 1/(2n)*RSS + regParam/2*||w||^2
    on a label scaled by its standard deviation (n - 1), with a free intercept, so regParam = alpha * std(y) / n reproduces
    sum-of-squares ridge with penalty alpha. The driver holds the coefficients, one number a feature."""
    spark = train.sparkSession
    if not isinstance(names, DataFrame):
        names = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "feature string, idx int")
    stats = train.agg(F.stddev_samp(y).alias("s"), F.count(F.lit(1)).alias("n")).first()
    lr = LinearRegression(featuresCol="features", labelCol=y, solver="l-bfgs", elasticNetParam=0.0, standardization=False,
                          fitIntercept=True, regParam=alpha * stats["s"] / stats["n"], maxIter=1000, tol=1e-14)
    coefficients = lr.fit(train).coefficients.toArray()
    deltas = spark.createDataFrame([(i, float(c)) for i, c in enumerate(coefficients)], "idx int, delta double")
    own = names.where(F.col("feature").startswith(prefix)).join(deltas, "idx").select(
        F.substring("feature", len(prefix) + 1, 1 << 20).alias("skill"), "delta")
    ranked = with_rank(own, [F.col("delta").desc(), "skill"])
    least = ranked.count() - tail
    return ranked.where((F.col("rank") <= head) | (F.col("rank") > least)).select(
        "skill", F.bround("delta", 0).cast("long").alias("delta"), "rank")


def boosted_trees(df: DataFrame, depth: int = 4, rate: float = 0.08, rounds: int = 100, seed: int = 42,
                  y: str = "salary") -> DataFrame:
    """M5: GBT fit on the training rows, metrics on the test rows next to the median baseline.

    The labelled frame is persisted only while the fit and the metric passes run; the one-row result is checkpointed
    (shared checkpoint folder) before the frame is released. It is read a few times and the fit's own rows a few hundred times, so
    it is kept on disk and memory is left to them. From ``DEAL_FROM`` rows on they are dealt evenly over a multiple of the cores, so
    that no core waits in any of the fit's passes."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = -(-max(df.rdd.getNumPartitions(), 1) // cores) * cores
    data = (df.repartition(parts) if df.count() >= DEAL_FROM else df).persist(StorageLevel.DISK_ONLY)
    train = data.where(~F.col("is_test"))
    model = GBTRegressor(featuresCol="features", labelCol=y, maxDepth=depth, stepSize=rate, maxIter=rounds,
                         seed=seed).fit(train)
    pred = model.transform(data.where(F.col("is_test")))
    m = regression_metrics(pred, y)
    b = regression_metrics(baseline(data, y), y).select("mae").scalar()
    out = m.withColumn("baseline_mae", b).select("n_test", round_even("baseline_mae", 0).alias("baseline_mae"),
                           round_even("mae", 0).alias("mae"), round_even("r2", 3).alias("r2"),
                           round_even((1 - F.col("mae") / F.col("baseline_mae")) * 100, 1).alias("mae_improvement_pct"))
    checkpoint_dir(df.sparkSession)
    out = out.checkpoint(eager=True)
    data.unpersist()
    return out


def tfidf(df: DataFrame, key: str, tokens: str, min_df: int = 5) -> DataFrame:
    """M7 as plain aggregations: (key, token, weight) with idf = ln((1+n)/(1+df)) + 1 and per-key L2 norm.

    Scales with the data: token document frequencies are a grouped count, no vocabulary vector on the driver."""
    n = df.select(F.count(F.lit(1))).scalar()
    # the explicit NOT NULL keeps both uses of ``tf`` one plan, so they share its exchange (ReuseExchange)
    toks = explode_present(df.where(F.col(key).isNotNull()), F.col(tokens), "token", key)
    tf = toks.groupBy(key, "token").agg(F.count(F.lit(1)).alias("tf"))
    # df as a sum of presence indicators reads tf, so this branch keeps tf's own aggregate: with count(*) column
    # pruning would drop it here and the two uses of tf would no longer share the exchange above the tokenizer
    dfreq = tf.groupBy("token").agg(F.sum(F.least("tf", F.lit(1))).alias("df")).where(F.col("df") >= min_df)
    w = tf.join(dfreq, "token").withColumn("w", F.col("tf") * (F.log((1 + n) / (1 + F.col("df"))) + 1))
    # a window over the key's own tokens: joined to an aggregate of itself, w would be made and shuffled twice
    norm = F.sqrt(F.sum(F.col("w") ** 2).over(Window.partitionBy(key)))
    return w.select(key, "token", (F.col("w") / norm).alias("weight"))


def role_docs(postings: DataFrame, terms: DataFrame, key: str = "job_id", term: str = "skill") -> DataFrame:
    """M6 input: postings with at least one term; doc = title + ' ' + terms (sorted)."""
    lists = terms.groupBy(key).agg(F.array_join(F.array_sort(F.collect_list(term)), " ").alias("_t"))
    return postings.join(lists, key).withColumn("doc", F.concat_ws(" ", F.coalesce("title", F.lit("")), "_t")).drop("_t")


def cluster_roles(docs: DataFrame, k: int = 6, seeds: Sequence[int] = tuple(range(42, 52)), min_df: int = 5,
                  key: str = "job_id", parallelism: int = 4) -> DataFrame:
    """M6: smoothed TF-IDF (+1) with L2 norm -> KMeans(k); the restart with the lowest training cost wins (ties: the
    earlier seed). Up to ``parallelism`` restarts are fitted concurrently, each a distributed fit submitted from its
    own driver thread (as ``CrossValidator(parallelism=...)`` does).

    The weights are M7's long form and become sparse vectors by aggregation, so no vocabulary is gathered on the driver; a
    document none of whose tokens is frequent has an empty vector. ``key`` must be unique."""
    weights = tfidf(docs.select(key, tokenize("doc").alias("tokens")), key, "tokens", min_df)
    x = sparse_vectors(docs.select(key), weights, [key], "token", "weight")[0].persist(StorageLevel.MEMORY_AND_DISK)

    def fit(seed: int):
        return KMeans(k=k, seed=seed, maxIter=300, featuresCol="features", predictionCol="cluster").fit(x)

    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(seeds)))) as pool:
        models = list(pool.map(fit, seeds))
    best = min(enumerate(models), key=lambda im: (im[1].summary.trainingCost, im[0]))[1]
    # the assignment is written to the shared checkpoint folder, so the cached vectors can be released
    out = best.transform(x).select(key, F.col("cluster").cast("long").alias("cluster")).checkpoint(eager=True)
    x.unpersist()
    return docs.join(out, key)


def ranked_clusters(profile: DataFrame, cluster: str = "cluster") -> DataFrame:
    """T4: a cluster profile with each cluster's ``rank`` by descending size (ties: cluster number)."""
    sizes = with_rank(profile.select(cluster, "size").distinct(), [F.col("size").desc(), cluster])
    return profile.join(sizes.select(cluster, "rank"), cluster)


def model_report(x: DataFrame, index: DataFrame, alpha: float = 10.0, y: str = "salary", **trees) -> DataFrame:
    """M9: one row with the numbers of both models over a split frame: n_postings, n_features, n_test, baseline_mae, mae, r2,
    mae_improvement_pct, premiums (from the largest on)."""
    metrics = boosted_trees(x, y=y, **trees)
    premiums = ridge_premiums(x.where(~F.col("is_test")), index, alpha, y=y)
    listed = premiums.agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "skill", "delta"))),
                                      lambda p: F.struct(p["skill"].alias("skill"), p["delta"].alias("delta"))).alias("premiums"))
    return metrics.select(
        x.select(F.count(F.lit(1))).scalar().alias("n_postings"), index.select(F.count(F.lit(1))).scalar().alias("n_features"), "n_test",
        F.col("baseline_mae").cast("long").alias("baseline_mae"), F.col("mae").cast("long").alias("mae"), "r2", "mae_improvement_pct",
        listed.select("premiums").scalar().alias("premiums"))


def cluster_profile(members: DataFrame, terms: DataFrame, k_top: int = 6, key: str = "job_id", term: str = "skill",
                    cluster: str = "cluster", stop: Sequence[str] = TITLE_STOPWORDS) -> DataFrame:
    """M8: long-form profile (cluster, label, size, median_salary, rk, skill, share).

    Labels: two most frequent title words (ties by word), title-cased; a label that is a prefix of an earlier
    cluster's label (cluster-id order) gets ' · ' + its first top term not already in the label, or 'misc'.
    The relabelling window runs over one row per cluster."""
    mids = members.select(key, cluster, F.when(F.col("salary_min").isNotNull() & F.col("salary_max").isNotNull(),
                                               midpoint()).alias("_mid"))
    stats = group_profile(flagged_terms(mids, terms, key, term), [cluster], "_mid", term, k_top)
    words = (explode_present(members, F.regexp_extract_all(F.lower("title"), F.lit("([a-z]+)"), 1), "w", cluster)
             .where((F.length("w") > 1) & ~F.col("w").isin(list(stop))))
    wc = words.groupBy(cluster, "w").agg(F.count(F.lit(1)).alias("c"))
    top2 = topk_per_group(wc, [cluster], [F.col("c").desc(), F.col("w")], 2, "wr")
    lab = top2.groupBy(cluster).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("wr", "w"))), lambda s: F.initcap(s["w"])), " ").alias("base"))
    lab = stats.join(lab, cluster, "left").withColumn("base", F.coalesce("base", F.lit("")))
    w = Window.orderBy(cluster).rowsBetween(Window.unboundedPreceding, -1)
    lab = lab.withColumn("_prev", F.collect_list("base").over(w))
    clash = F.exists("_prev", lambda p: p.startswith(F.col("base")))
    extra = F.coalesce(F.try_element_at(F.filter(F.transform("tops", lambda s: s["term"]),
                                                 lambda s: ~F.lower(F.col("base")).contains(F.lower(s))), F.lit(1)), F.lit("misc"))
    label = F.when(clash, F.concat("base", F.lit(" · "), extra)).otherwise(F.col("base"))
    prof = lab.select(cluster, label.alias("label"), F.col("n").alias("size"), "median", F.explode_outer("tops").alias("t"))
    return prof.select(cluster, "label", "size", round_even("median", 0).cast("long").alias("median_salary"), "t.rk", F.col("t.term").alias(term),
                       round_even(F.col("t.cnt") * 100.0 / F.col("size"), 0).cast("long").alias("share"))
