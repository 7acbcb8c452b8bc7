"""Feeds that land as JSON files, read as a stream, and the resumable enrichment run."""

import json
import uuid

import pandas as pd
import pytest
from pyspark.sql import functions as F

from postlens.operators import enrich as X
from postlens.session import make_folder, scratch_path
from postlens.sources import feeds as FD
from postlens.sources import sinks as K
from postlens.streaming import jobs as R


def folder(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def land(spark, path, payloads):
    lines = [p if isinstance(p, str) else json.dumps(p) for p in payloads]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)


ALL = dict(words=[""], codes=[], marker=None)


def landings(base):
    return [(f"{base}/a", FD.feed_a()), (f"{base}/b", FD.feed_b(relevant=["dev"], region=ALL)),
            (f"{base}/c", FD.feed_c(relevant=["dev"], region=ALL)), (f"{base}/d", FD.feed_d(relevant=["dev"], region=ALL))]


def stored(df):
    return {r.source_id: (r.title, r.description) for r in df.collect()}


@pytest.mark.parametrize("max_files", [None, 1])
def test_feeds_of_all_layouts_as_one_stream(spark, max_files):
    base = folder(spark, "landed")
    a = lambda i, title, text: {"id": i, "title": title, "description": text, "company": {"display_name": "x"}}
    land(spark, f"{base}/a/1", [{"results": [a("1", "first", "one"), a("2", "empty", "")]}, "{broken", "[]", {"results": None}, {}])
    land(spark, f"{base}/b/1", [{"jobs": [{"id": "1", "title": "dev", "description": "<p>b</p>"}, {"id": "2", "title": "cook", "description": "z"}]}])
    land(spark, f"{base}/d/1", [{"results": [{"id": "1", "name": "dev", "contents": "d", "locations": [{"name": "Flexible / Remote"}]}]}])
    got = R.stream_feeds(spark, landings(base), f"{base}/out", f"{base}/ck", max_files, 4)  # feed c has not landed yet
    want = {"feed_a:1": ("first", "one"), "feed_b:1": ("dev", "b"), "feed_d:1": ("dev", "d")}
    assert stored(got) == want and {r.remote for r in got.collect()} == {None, True}
    # later deliveries: keys come again, in one file twice; the one that was empty now has a text; feed c lands
    land(spark, f"{base}/a/2", [{"results": [a("1", "again", "two"), a("2", "full", "text"), a("2", "twice", "text")]}])
    land(spark, f"{base}/c/1", [{"jobs": [{"id": 7, "jobTitle": "dev c", "jobDescription": "c", "annualSalaryMin": 5}]}])
    want |= {"feed_a:2": ("full", "text"), "feed_c:7": ("dev c", "c")}
    for _ in range(2):  # a run without new files changes nothing
        assert stored(R.stream_feeds(spark, landings(base), f"{base}/out", f"{base}/ck", max_files, 4)) == want
    # a lost checkpoint replays everything, and appends nothing
    assert stored(R.stream_feeds(spark, landings(base), f"{base}/out", f"{base}/other", max_files, 4)) == want
    assert spark.read.parquet(f"{base}/out").count() == len(want)


def test_feeds_without_any_file(spark):
    base = folder(spark, "landed-none")
    got = R.stream_feeds(spark, landings(base), f"{base}/out", f"{base}/ck")
    assert got.columns == FD.POSTING_COLUMNS and got.count() == 0


# enrichment ----------------------------------------------------------------------------------------------------------
def model(texts):
    out = []
    for t in texts:
        if t == "raise":
            raise RuntimeError("the model is not there")
        out.append("{broken" if t == "broken" else json.dumps({"skills": t.split() if t else [], "seniority": t[:3] or None}))
    return pd.Series(out)


POSTINGS = [(1, "mid sql", False, "old"), (2, "broken", False, "old"), (3, "raise", False, "old"), (4, "mid done", True, "old"),
            (5, "", False, "old"), (6, "top a b", False, None), (7, None, None, "old"), (8, "mid x", False, "old"), (8, "mid y", False, "old"),
            (None, "mid z", False, "old")]
SKILLS = [(1, "before", "rules"), (1, "before", "llm"), (2, "kept", "rules"), (4, "kept", "rules"), (5, "gone", "rules"), (9, "kept", "rules")]


def tables(spark, buckets=4):
    base = folder(spark, "enrich")
    X.write_bucketed(spark.createDataFrame(POSTINGS, "job_id long, description string, extracted boolean, seniority string"), f"{base}/postings", "job_id", buckets)
    X.write_bucketed(spark.createDataFrame(SKILLS, "job_id long, skill string, method string"), f"{base}/skills", "job_id", buckets)
    return base


def state(spark, base):
    p = {(r.job_id, r.description): (r.extracted, r.seniority) for r in spark.read.parquet(f"{base}/postings").collect()}
    s = sorted((r.job_id, r.skill, r.method) for r in spark.read.parquet(f"{base}/skills").collect())
    return p, s


def run(spark, base, name, fn=model, **options):
    return X.enrich_run(spark, f"{base}/postings", f"{base}/skills", f"{base}/{name}", fn, buckets=4, **options).first().asDict()


AFTER = ({(1, "mid sql"): (True, "mid"), (2, "broken"): (False, "old"), (3, "raise"): (False, "old"), (4, "mid done"): (True, "old"),
          (5, ""): (True, None), (6, "top a b"): (True, None), (7, None): (None, "old"), (8, "mid x"): (True, "mid"), (8, "mid y"): (True, "mid"),
          (None, "mid z"): (False, "old")},
         sorted([(1, "SQL", "llm"), (1, "mid", "llm"), (2, "kept", "rules"), (4, "kept", "rules"), (6, "a", "llm"), (6, "b", "llm"), (6, "top", "llm"),
                 (8, "mid", "llm"), (8, "x", "llm"), (9, "kept", "rules")]))


def test_run_replaces_and_marks(spark):
    base = tables(spark)
    assert run(spark, base, "r1") == {"done": 4, "failed": 2, "skill_rows": 10} and state(spark, base) == AFTER
    # the rejected ones are pending again
    assert run(spark, base, "r2") == {"done": 0, "failed": 2, "skill_rows": 10} and state(spark, base) == AFTER
    assert run(spark, base, "r3", lambda t: pd.Series(['{"skills": ["late"], "seniority": "mid"}'] * len(t)), limit=1)["done"] == 1
    assert state(spark, base)[0][(2, "broken")] == (True, "mid") and state(spark, base)[0][(3, "raise")] == (False, "old")


@pytest.mark.parametrize("broken_at", ["judge", "replace_by_key", "overwrite_buckets", "update_by_key", "second overwrite", "report"])
def test_run_that_broke_off_is_resumed(spark, monkeypatch, broken_at):
    base = tables(spark)
    calls = []

    def fail(*args, **kwargs):
        raise OSError("lost")

    with monkeypatch.context() as m:
        if broken_at == "second overwrite":
            def once(*args):
                calls.append(1)
                return K.overwrite_buckets(*args) if len(calls) == 1 else fail()
            m.setattr(X, "overwrite_buckets", once)
        elif broken_at == "report":
            def after(spark_, path, rows, touched):
                K.overwrite_buckets(spark_, path, rows, touched)
                if path.endswith("postings"):
                    fail()
            m.setattr(X, "overwrite_buckets", after)
        else:
            m.setattr(X, broken_at, fail)
        with pytest.raises(OSError):
            run(spark, base, "r1")
    # started again, it asks no model a second time
    refuse = lambda t: pd.Series(["{asked twice"] * len(t))
    assert run(spark, base, "r1", refuse) == {"done": 4, "failed": 2, "skill_rows": 10} and state(spark, base) == AFTER
    assert run(spark, base, "r1", refuse) == {"done": 4, "failed": 2, "skill_rows": 10} and state(spark, base) == AFTER


def test_table_half_overwritten_is_restored(spark):
    base = tables(spark)
    run(spark, base, "r1")
    # a crash inside the replacement: buckets are gone, the report was never written
    for b in range(4):
        K.delete_folder(spark, f"{base}/skills/bucket={b}") if b % 2 else None
    lost = spark.read.parquet(f"{base}/skills").count()
    K.delete_folder(spark, f"{base}/r1/report")
    run(spark, base, "r1")
    touched = {r.bucket for r in spark.read.parquet(f"{base}/r1/accepted").collect()}
    assert lost < 10 and {s for s in AFTER[1] if s[2] == "llm"} <= set(state(spark, base)[1]) and touched


def test_texts_beside_and_nothing_pending(spark):
    base = tables(spark)
    texts = spark.createDataFrame([(1, "mid go"), (5, "mid other")], "job_id long, body string")
    assert run(spark, base, "r1", text="body", texts=texts) == {"done": 2, "failed": 0, "skill_rows": 7}
    assert state(spark, base)[0][(1, "mid sql")] == (True, "mid")
    assert run(spark, base, "r2", limit=0) == {"done": 0, "failed": 0, "skill_rows": 7}
    make_folder(spark, f"{base}/none")
    got = X.enrich_run(spark, f"{base}/postings", f"{base}/none", f"{base}/r3", model, buckets=4)
    assert got.first().done == 2 and spark.read.parquet(f"{base}/none").count() == 5


def test_update_by_key_repeated_updates(spark):
    target = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k long, v string")
    upd = spark.createDataFrame([(1, "y"), (1, "x"), (3, "z")], "k long, v string")
    assert sorted(map(tuple, K.update_by_key(target, upd, "k", ["v"]).collect())) == [(1, "x"), (1, "x"), (2, "c")]


def test_artifact_absent_or_unreadable(spark):
    assert K.read_artifact(spark, folder(spark, "absent"), "k int").count() == 0
    with pytest.raises(Exception):
        K.read_artifact(spark, folder(spark, "absent"), "k nothing")
    assert spark.range(1).select(F.lit(1)).count() == 1


def test_calls_of_the_model_are_bounded_by_their_characters():
    texts = ["a" * 60, None, "b" * 60, "", "c" * 250, "d", "e" * 99]
    batch = pd.DataFrame({"key": range(len(texts)), "prompt": texts})
    pieces = [list(p["key"]) for p in X.calls(batch, 100)]
    assert pieces == [[0, 1, 2], [3, 4], [5, 6]]
    assert [list(p["key"]) for p in X.calls(batch)] == [list(range(len(texts)))] and not list(X.calls(batch.iloc[:0]))
    assert [len(p) for p in X.calls(pd.DataFrame({"key": [1, 2], "prompt": [None, None]}))] == [2]


def test_long_texts_reach_the_model_in_several_calls(spark):
    def longest(texts):
        return pd.Series([json.dumps({"skills": [f"call {len(texts)}"], "seniority": "mid"})] * len(texts))

    df = spark.range(12).select("id", F.repeat(F.lit("x y "), 1 << 17).alias("text")).coalesce(1)
    ok, rejected = X.enrich(df, "id", "text", longest)
    assert {(r.id, r.skills[0]) for r in ok.collect()} == {(i, "call 2") for i in range(12)} and rejected.isEmpty()
