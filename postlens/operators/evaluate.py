"""Tagger evaluation E1-E3 and the gold-set reader S10."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions.scalars import explode_present, ratio


def read_gold(df: DataFrame, col: str, meta_prefix: str = "_", key: str = "key", terms: str = "terms") -> DataFrame:
    """JSON objects ``{key: [terms...], "_note": "..."}`` -> (key, distinct terms).

    Two-step parse: a direct ``map<string,array<string>>`` parse turns the whole map NULL when a metadata value is a
    plain string, so values are read as raw strings first and parsed per entry."""
    m = explode_present(df, F.from_json(F.col(col), "map<string,string>"), (key, "_v"))
    m = m.where(~F.col(key).startswith(meta_prefix))
    return m.select(key, F.array_distinct(F.from_json("_v", "array<string>")).alias(terms))


def _sets(pred: DataFrame, gold: DataFrame, key: str, p: str, g: str) -> DataFrame:
    """Pred rows restricted to gold keys (semi-join semantics), with NULL -> empty set on both sides."""
    j = gold.join(pred.select(key, F.col(p).alias("_p")), key, "inner")
    return j.select(key, F.coalesce("_p", F.array().cast("array<string>")).alias("pred"),
                    F.coalesce(F.col(g), F.array().cast("array<string>")).alias("gold"))


def prf1(pred: DataFrame, gold: DataFrame, key: str = "key", p: str = "terms", g: str = "terms",
         decimals: int = 3) -> DataFrame:
    """Micro precision / recall / F1 over keys present in both (set sizes summed map-side)."""
    s = _sets(pred, gold, key, p, g)
    agg = s.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.size(F.array_intersect("pred", "gold"))).cast("long").alias("tp"),
        F.sum(F.size(F.array_except("pred", "gold"))).cast("long").alias("fp"),
        F.sum(F.size(F.array_except("gold", "pred"))).cast("long").alias("fn"))
    prec = ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    out = agg.select("n", F.coalesce("tp", F.lit(0)).alias("tp"), F.coalesce("fp", F.lit(0)).alias("fp"),
                     F.coalesce("fn", F.lit(0)).alias("fn"))
    out = out.withColumn("precision", prec).withColumn("recall", rec)
    f1 = ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return out.withColumn("f1", f1).select(
        "n", "tp", "fp", "fn", F.bround("precision", decimals).alias("precision"),
        F.bround("recall", decimals).alias("recall"), F.bround("f1", decimals).alias("f1"))


def error_report(pred: DataFrame, gold: DataFrame, key: str = "key", p: str = "terms", g: str = "terms") -> DataFrame:
    """Per key the spurious and missed terms (sorted), only keys with an error."""
    s = _sets(pred, gold, key, p, g)
    out = s.select(key, F.array_sort(F.array_except("pred", "gold")).alias("spurious"),
                   F.array_sort(F.array_except("gold", "pred")).alias("missed"))
    return out.where((F.size("spurious") > 0) | (F.size("missed") > 0))


def missing_gold(gold: DataFrame, data: DataFrame, key: str = "key") -> DataFrame:
    """Gold keys absent from the data."""
    return gold.join(data.select(key), key, "left_anti")


def labels_to_terms(labels: Column, names: list[tuple[Column, str]]) -> Column:
    """Helper: array of names whose condition holds."""
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, n in names]))
