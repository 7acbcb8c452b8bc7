"""Pluggable batch enrichment (e.g. a hosted model) as ``mapInPandas``, and the whole run around it.

The caller supplies ``fn(pandas.Series[str]) -> pandas.Series[str]`` returning one raw reply per text. Spark does the
selection (S8), prompt column, partitioning (= concurrency), parsing (F19), cleaning (F20), domain check (F21) and the
split into accepted and rejected rows. Replies are validated JSON-side on the JVM, not in Python.

``enrich_run`` is the run as one resumable change of two stored tables: what it is going to write is written to a folder of
the run first, step by step, and a step that is there already is not done again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.functions.scalars import clean_terms, in_domain, parse_reply
from postlens.operators.dedup import first_per_key
from postlens.session import checkpoint_dir, path_exists
from postlens.sources.sinks import key_bucket, overwrite_buckets, read_or_empty, replace_by_key, update_by_key
from postlens.sources.tables import scan_pending

REPLY_SCHEMA = "skills array<string>, seniority string"
#: One call of the model gets prompts of about so many characters, however long the texts are; a longer one goes alone.
CALL_CHARS = 1 << 20


def calls(batch: pd.DataFrame, chars: int = CALL_CHARS) -> Iterator[pd.DataFrame]:
    """A batch in its order, cut into pieces whose prompts begin within ``chars`` characters of each other."""
    size = batch["prompt"].map(lambda p: len(p) if isinstance(p, str) else 0).to_numpy(dtype="int64")
    piece = (size.cumsum() - size) // chars
    cuts = [0, *((piece[1:] != piece[:-1]).nonzero()[0] + 1), len(batch)]
    for a, b in zip(cuts, cuts[1:]):
        if a < b:
            yield batch.iloc[a:b].reset_index(drop=True)


def ask(src: DataFrame, fn: Callable[[pd.Series], pd.Series]) -> DataFrame:
    """(key, reply) for the rows of ``src`` (key, prompt). A batch is asked in calls of about CALL_CHARS characters, so that what
    a model makes of its texts doesn't grow with the batch. A call that ``fn`` fails on is asked row by row, so that only the
    rows that fail by themselves stay without a reply."""

    def one(prompt):
        try:
            return fn(pd.Series([prompt])).iloc[0]
        except Exception:  # whatever the model's client raises; the row stays pending
            return None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for b in calls(batch):
                try:
                    replies = list(fn(b["prompt"]))
                except Exception:
                    replies = [one(p) for p in b["prompt"]]
                yield pd.DataFrame({"key": b["key"], "reply": pd.Series(replies, index=b.index).astype("string")})

    return src.mapInPandas(run, f"key {src.schema['key'].dataType.simpleString()}, reply string")


def judge(replies: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(ok: key, skills, seniority, method) and (rejected: key, reply) of raw replies (key, reply)."""
    parsed = replies.withColumn("p", parse_reply("reply", REPLY_SCHEMA))
    ok = parsed.where(F.col("p").isNotNull()).select(
        F.col("key").alias(key), clean_terms(F.coalesce(F.col("p.skills"), F.array().cast("array<string>"))).alias("skills"),
        in_domain(F.col("p.seniority")).alias("seniority"), F.lit("llm").alias("method"))
    return ok, parsed.where(F.col("p").isNull()).select(F.col("key").alias(key), "reply")


def _prompts(df: DataFrame, key: str, text: str, max_chars: int | None, partitions: int | None) -> DataFrame:
    prompt = F.col(text) if max_chars is None else F.substring(F.col(text), 1, max_chars)
    src = df.select(F.col(key).alias("key"), prompt.alias("prompt"))
    return src.repartition(partitions) if partitions else src


def enrich(df: DataFrame, key: str, text: str, fn: Callable[[pd.Series], pd.Series], max_chars: int | None = None,
           partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Return (ok: key, skills, seniority, method) and (rejected: key, reply)."""
    # one external call per row: materialise the replies in the shared checkpoint folder so the two outputs below
    # (and any recomputation after an executor loss) reuse them instead of calling ``fn`` again
    checkpoint_dir(df.sparkSession)
    return judge(ask(_prompts(df, key, text, max_chars, partitions), fn).checkpoint(eager=True), key)


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """A table that ``enrich_run`` can change: partitioned by the key's bucket."""
    df.withColumn("bucket", key_bucket(key, buckets)).write.mode("overwrite").partitionBy("bucket").parquet(path)


def enrich_run(spark: SparkSession, postings: str, bridge: str, run: str, fn: Callable[[pd.Series], pd.Series], key: str = "job_id",
               text: str = "description", texts: DataFrame | None = None, limit: int | None = None, buckets: int = 64,
               flag: str = "extracted", max_chars: int | None = None, partitions: int | None = None) -> DataFrame:
    """One run of X7 over stored tables; returns its report: done, failed, skill_rows.

    1. Pending rows (S8: ``flag`` IS FALSE, the first ``limit`` by key) of the table at ``postings`` are asked. Their text is
       the column ``text`` of that table or, so that marking needn't rewrite texts, of ``texts`` (key, text).
    2. The replies are stored, then judged. Rejected rows stay pending for the next run.
    3. K2: the rows of all methods of accepted keys in the table at ``bridge`` (key, skill, method) are replaced, also by none.
    4. K4: accepted postings get their seniority, even NULL, and only then the mark that they are done.

    Both tables are partitioned by the key's bucket (``write_bucketed`` with the same ``buckets``); only buckets with accepted
    keys are rewritten. The replies, and the rewritten buckets before they replace the tables' own, are kept in the folder
    ``run``: a run that broke off anywhere and is started again with the same folder asks no model again and ends with the tables
    that it would have left; a finished run only returns its report. Rows without key are passed over; of rows of one key
    one is asked, that of the smallest text."""
    def step(name: str, build: Callable[[], DataFrame]) -> DataFrame:
        path = f"{run}/{name}"
        if not path_exists(spark, f"{path}/_SUCCESS"):
            build().write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    def ask_pending() -> DataFrame:
        table = spark.read.parquet(postings).where(F.col(key).isNotNull())
        pending = scan_pending(table, flag, [key], limit)
        if texts is not None:
            pending = pending.select(key).distinct().join(texts.select(key, text), key)
        return ask(_prompts(first_per_key(pending.select(key, text), key, [text]), key, text, max_chars, partitions), fn)

    checkpoint_dir(spark)
    replies = step("replies", ask_pending)
    if path_exists(spark, f"{run}/report/_SUCCESS"):
        return spark.read.parquet(f"{run}/report")
    ok, rejected = judge(replies, key)
    ok = step("accepted", lambda: ok.withColumn("bucket", key_bucket(key, buckets)))
    touched = ok.select("bucket").distinct()
    ddl = f"{key} {ok.schema[key].dataType.simpleString()}, skill string, method string, bucket int"

    def replaced() -> DataFrame:
        stored = read_or_empty(spark, bridge, None, ddl)
        new = ok.select(key, F.explode("skills").alias("skill"), "method", "bucket").select(*stored.columns)
        return replace_by_key(stored.join(touched, "bucket", "left_semi").select(*stored.columns), new, key, processed=ok.select(key))

    def marked() -> DataFrame:
        stored = spark.read.parquet(postings)
        upd = ok.select(key, "seniority", F.lit(True).alias(flag))
        return update_by_key(stored.join(touched, "bucket", "left_semi").select(*stored.columns), upd, key, ["seniority", flag])

    overwrite_buckets(spark, bridge, step("bridge", replaced), touched)
    overwrite_buckets(spark, postings, step("postings", marked), touched)

    def report() -> DataFrame:
        counts = [d.select(F.count(F.lit(1))).scalar().alias(n) for d, n in ((ok, "done"), (rejected, "failed"))]
        return read_or_empty(spark, bridge, None, ddl).agg(F.count(F.lit(1)).alias("skill_rows")).select(*counts, "skill_rows")

    return step("report", report)
