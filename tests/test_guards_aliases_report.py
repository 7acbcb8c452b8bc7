"""The tagger's guards lose no match; aliases by table; flags and their report; date forms."""

import random
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from postlens.functions import scalars as S
from postlens.operators import aliases as AL
from postlens.operators import dedup as D
from postlens.operators import tagging as T
from postlens.plans.q_text import SURFACES
from postlens.sources import sinks as K


def test_every_shipped_term_has_a_guard():
    vocab = T.skill_vocabulary()
    bare = [t.term for t in vocab if not t.guards()]
    assert bare == ["R"] and len(vocab) == len({t.term for t in vocab})  # one of R's alternatives has a single letter only


@pytest.mark.parametrize("pattern, stems", [
    ("java(?!script)", [" java "]), ("llms?|large language models?", [" large language model", " llm"]), ("time[- ]series", ["series "]),
    (r"\bml\b", [" ml "]), (r"c\+\+", [" c   "]), ("(?:ab|cd)", [" ab ", " cd "]), ("a?b", []), ("x|long", []), ("(?:a|b)c", []),
    ("abc+de", [" abc"]), ("ab*cd", ["cd "]), ("ab{2}cd", ["cd "]), ("a.b", []), (r"a\.b", [" a b "]), ("[(]ab", ["ab "]), ("(?i)Ab", [" ab "]), ("ab|ab cd", [" ab "])])
def test_stems(pattern, stems):
    assert T.Term("t", pattern).guards() == stems


@pytest.mark.parametrize("fold_from", [0, 1000])
def test_guards_lose_no_match(spark, monkeypatch, fold_from):
    monkeypatch.setattr(T, "FOLD_FROM", fold_from)
    rng = random.Random(3)
    words = SURFACES + ["Kafka", "SſKLEARN", "PİPELİNE posİt", "dırect git", "RAG", "sql server", "amazon web services", "gen ai", "SQL\nR, x", "(R)",
                        "postgresql", "ml", "drift detection", "K8ſ", "ſaſ", "mıcroso", "power bI", "Power Bİ", "Aİrflow", "statistical methods"]
    texts = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 6)))) for i in range(400)] + [(-1 - i, w) for i, w in enumerate(words)] + [(1000, None)]
    df = spark.createDataFrame(texts, "k long, t string")
    vocab = T.skill_vocabulary()
    guarded = {r.k: r.terms for r in T.tag_terms(df, ["t"], vocab).collect()}
    plain = {r.k: r.terms for r in T.tag_terms(df, ["t"], [replace(t, stem="") for t in vocab]).collect()}
    assert guarded == plain and sum(map(len, plain.values())) > 300


def test_iso_dates_by_the_hour(spark):
    good = ["2024-01-01T10", "2024-01-01T10:00:00+05", "2024-01-01 10:00-0530", "2024-01-01T10Z", "2024-01-01T10:00:00+05:30:15", "2024-01-01"]
    bad = ["2024-01-01T24", "2024-01-01T", "2024-01-01T1", "2024-01-01T10:00:00+5", "2024-01-01T10:", "2024-01-01T10.5"]
    df = spark.createDataFrame([(v,) for v in good + bad], "v string")
    got = {r.v: r.d for r in df.select("v", S.iso_date("v").alias("d")).collect()}
    assert [str(got[v]) for v in good] == ["2024-01-01"] * len(good) and all(got[v] is None for v in bad)


@pytest.mark.parametrize("most", [AL.BROADCAST_ROWS, 0])
def test_aliases_by_table(spark, monkeypatch, most):
    monkeypatch.setattr(AL, "BROADCAST_ROWS", most)
    table = spark.createDataFrame([("py", "Python"), ("PY", "Pyrite"), ("js", "JavaScript"), (None, "x"), ("y", None)], "alias string, canonical string")
    terms = spark.createDataFrame([(" Py. ", 1), ("PY;", 2), ("Js", 3), ("Other, ", 4), ("y", 5), (None, 6), ("", 7)], "t string, k int")
    got = {r.k: r.canonical for r in AL.normalize_terms(terms, "t", table).collect()}
    assert got == {1: "Pyrite" if "Pyrite" < "Python" else "Python", 2: "Pyrite", 3: "JavaScript", 4: "Other", 5: "y", 6: None, 7: ""}
    same = {r.term: r.n for r in AL.normalized_counts(terms, "t", table.where("alias <> 'PY'")).collect()}
    assert same == {"Python": 2, "JavaScript": 1, "Other": 1, "y": 1, None: 1, "": 1}
    assert AL.normalize_terms(terms, "t", table.limit(0)).where("k = 1").first().canonical == "Py"


def test_flags_agree_with_the_append(spark):
    rng = random.Random(5)
    batch = [(rng.choice("abcdefgh") * rng.randrange(1, 3), rng.choice("xyz"), rng.choice(["", "t", "u", None]), rng.randrange(3)) for _ in range(200)]
    existing = [("a", "x", "t", 0), ("bb", "x", "t", 0), ("a", "y", "t", 0)]
    ddl = "key string, source string, text string, ord int"
    b, e = spark.createDataFrame(batch, ddl), spark.createDataFrame(existing, ddl)
    new = D.dedup_append(e, b, "key", ["ord"], "text")
    want = {(r.source, r.new_rows, r.skipped, r.table_total) for r in K.ingest_report(b, new, "source", F.lit(3)).collect()}
    flags = D.flag_new(e, b, "key", ["ord"], "text", "source")
    assert {(r.source, r.new_rows, r.skipped, r.table_total) for r in K.flagged_report(flags, "source", F.lit(3)).collect()} == want
    assert {(r.key, r.source) for r in flags.where("is_new").collect()} == {(r.key, r.source) for r in new.collect()}
    empty = D.flag_new(e, b.limit(0), "key", ["ord"], "text", "source")
    assert empty.count() == 0


def test_larger_vocabularies_look_up_words(spark):
    """A term of whole words is looked up among the text's words: no search of the text but the regex (F8)."""
    vocab = [T.Term(f"t{i}", f"word{i}") for i in range(T.FOLD_FROM)] + [T.Term("odos", "οδος"), T.Term("two", "one two"), T.Term("pre", "abcs?"), T.Term("cs", "CS", case_sensitive=True)]
    rows = [(0, "WORD3, xword4 word5x (word6)"), (1, "ΟΔΟΣ'Α ΟΔΟΣ"), (2, "two one"), (3, "One Two, abc ABCS xabc"), (4, "cs"), (5, "CS"), (6, ""), (7, None)]
    tagged = T.tag_terms(spark.createDataFrame(rows, "k int, t string"), ["t"], vocab)
    assert {r.k: r.terms for r in tagged.collect()} == {0: ["t3", "t6"], 1: ["odos"], 2: [], 3: ["pre", "two"], 4: [], 5: ["cs"], 6: [], 7: []}
    plan = tagged._jdf.queryExecution().optimizedPlan().toString()
    assert set(re.findall(r"Contains\(_(?:low|folded)#\d+, ([^)]*)\)", plan)) == {"one two", " abc"} and plan.count("split(") == 1
