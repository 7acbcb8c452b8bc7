"""Operator 5, URL filter by rules and, where no rule fits, by character language models (DataFrame functions only).

Two smoothed variable-order Markov models of URL characters are counted from the URLs that the rules allow and block. With
``ORDER`` characters of context, the probability of a character blends each order with the one below:
P(c | x1..xk) = (n(x1..xk c) + A * P(c | x2..xk)) / (n(x1..xk) + A), down to the uniform one. Each distinct run of
ORDER + 1 characters gets its log ratio once, from small tables of counts; a URL's score is the mean over its characters,
so its length doesn't matter. The limit is the score that separates the URLs with rules best (balanced accuracy), found
from a histogram; at or above it a URL is allowed. Equal URLs are scored once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.llm.common import kept_table

ORDER, BLEND, ALPHABET = 3, 4.0, 256.0
SCALE, BINS, REACH = 1_000_000, 4000, 20.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first '://': the host up to '/', '?' or '#', lower-cased, and the path up to '?' or '#'. Both are empty
    for a null url or one without '://'."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[str]) -> Column:
    """The longest of ``rules`` ('host/path') that fits: its host is the url's or a domain above it, and the url's path
    starts with its path. Null if none fits."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        domain, slash, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def _grams(url: str = "text") -> Column:
    """The runs of ORDER + 1 characters that end at each character; the start and the end of a url are characters too. One
    regular expression looks ahead at each character, so the time is linear in the url's length."""
    padded = F.concat(F.lit("\u0002" * ORDER), F.col(url), F.lit("\u0003"))
    return F.regexp_extract_all(padded, F.lit(rf"(?s)(?=(.{{{ORDER + 1}}}))."), 1)


def gram_ratios(spark: SparkSession, grams: DataFrame) -> DataFrame:
    """(gram, ratio): log of accepted over rejected probability of each gram's last character, in millionths."""
    sides = ("accepted", "rejected")
    level = {ORDER + 1: grams}
    for k in range(ORDER, 0, -1):
        level[k] = level[k + 1].groupBy(F.substring("gram", 2, k).alias("gram")).agg(*(F.sum(s).alias(s) for s in sides))
    lower = None
    for k in range(1, ORDER + 2):
        here = level[k]
        if k == 1:
            total = here.agg(*(F.sum(s).alias(s) for s in sides)).first()
            here = here.select("gram", *((F.col(s) + BLEND / ALPHABET) / F.lit(float(total[s] or 0) + BLEND) for s in sides))
        else:
            context = Window.partitionBy(F.substring("gram", 1, k - 1))  # at most as many rows as there are characters
            seen = here.select("gram", F.substring("gram", 2, k - 1).alias("tail"), *sides, *(F.sum(s).over(context).alias(f"n_{s}") for s in sides))
            here = seen.join(lower, "tail").select("gram", *((F.col(s) + BLEND * F.col(f"p_{s}")) / (F.col(f"n_{s}") + BLEND) for s in sides))
        here = here.toDF("gram", *sides)
        lower = kept_table(spark, here.toDF("tail", *(f"p_{s}" for s in sides)), f"order{k}")
    ratio = F.round((F.log("p_accepted") - F.log("p_rejected")) * SCALE).cast("long")
    return lower.select(F.col("tail").alias("gram"), ratio.alias("ratio"))


def url_verdicts(spark: SparkSession, pages: DataFrame, rules: dict[str, str]) -> DataFrame:
    """One row per row of ``pages`` (page_id, url): page_id, host, path, rule, verdict ('allow' or 'block'), score,
    limit (score and limit in nats a character; score also where a rule decides).

    ``rules`` maps 'host/path' to its verdict; the longest rule that fits decides, else the models. A null url counts as
    an empty one: no host, no path, no rule. Without accepted and rejected urls both, all scores and the limit are 0, so
    urls without rule are allowed. Equal urls get equal verdicts. Other columns are ignored."""
    rows = pages.select("page_id", F.coalesce(F.col("url"), F.lit("")).alias("text"))
    host, path = host_and_path(F.col("text"))
    rows = rows.select("page_id", "text", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), list(rules)))
    verdict = F.lit(None).cast("string")
    for rule, word in rules.items():
        verdict = F.when(F.col("rule") == rule, F.lit(word)).otherwise(verdict)
    rows = rows.withColumn("ruled", verdict)
    urls = rows.groupBy("text").agg(F.min("ruled").alias("ruled"))
    urls = kept_table(spark, urls, "urls")
    marks = urls.select(F.explode(_grams()).alias("gram"), "ruled").groupBy("gram").agg(
        F.count_if(F.col("ruled") == "allow").alias("accepted"), F.count_if(F.col("ruled") == "block").alias("rejected"))
    marks = kept_table(spark, marks, "grams")
    both = urls.agg(F.count_if(F.col("ruled") == "allow"), F.count_if(F.col("ruled") == "block")).first()
    if all(both):
        ratios = gram_ratios(spark, marks)
        scored = urls.select("text", "ruled", F.explode(_grams()).alias("gram")).join(ratios, "gram")
        scored = scored.groupBy("text", "ruled").agg((F.sum("ratio") / F.count("*") / SCALE).alias("score"))
    else:
        scored = urls.withColumn("score", F.lit(0.0))
    scored = kept_table(spark, scored, "scores")
    limit = 0.0
    if all(both):
        cell = F.least(F.greatest(F.floor((F.col("score") + REACH) * (BINS / (2 * REACH))), F.lit(0)), F.lit(BINS - 1)).cast("int")
        counts = scored.where("ruled IS NOT NULL").groupBy(cell.alias("cell")).agg(
            F.count_if(F.col("ruled") == "allow").alias("a"), F.count_if(F.col("ruled") == "block").alias("b")).collect()
        a_total, b_total = sum(r["a"] for r in counts), sum(r["b"] for r in counts)
        best, below_a, below_b, last = -1.0, 0, 0, None
        for r in sorted(counts, key=lambda r: r["cell"]):  # limits lie half-way between cells that hold urls
            good = (a_total - below_a) / a_total + below_b / b_total
            if good > best:
                best, edge = good, (r["cell"] + (r["cell"] if last is None else last + 1)) / 2
                limit = edge * (2 * REACH / BINS) - REACH
            below_a, below_b, last = below_a + r["a"], below_b + r["b"], r["cell"]
    out = rows.join(scored.select("text", "score"), "text")
    method = F.when(F.col("score") >= limit, F.lit("allow")).otherwise(F.lit("block"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), "score", F.lit(limit).alias("limit"))
