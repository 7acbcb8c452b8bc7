"""Hand-made edge cases (NULLs, empties, ties, tri-state, overlapping regions, boundaries)."""

import datetime as dt

from pyspark.sql import functions as F

from postlens.functions import predicates as P
from postlens.functions import scalars as S
from postlens.operators import alerts as A
from postlens.operators import dedup as D
from postlens.operators import evaluate as EV
from postlens.operators import market as M
from postlens.operators.tagging import SENIORITY_RULES, Term, classify_first, skill_vocabulary, tag_terms


def col(spark, values, name="v", typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {typ}")


def test_first_non_empty_wins_and_known_keys_skipped(spark):
    batch = spark.createDataFrame(
        [("k1", 0, 0, ""), ("k1", 0, 1, "x"), ("k1", 0, 2, "y"), ("k2", 0, 3, "z"), ("k3", 1, 0, "b"),
         ("k3", 0, 9, "a")], "key string, feed_ord int, pos int, text string")
    existing = spark.createDataFrame([("k2",)], "key string")
    out = {r.key: r.text for r in D.dedup_append(existing, batch, "key", ["feed_ord", "pos"], "text").collect()}
    assert out == {"k1": "x", "k3": "a"}


def test_iso_dates(spark):
    vals = ["2024-01-01T23:30:00-05:00", "2024-01-01T10:00:00Z", "2024-01-01 10:00:00", "2024-01-01", "2024",
            "nope", None, "", "2024-02-30", "2024-01-01T25:00:00"]
    got = [r[0] for r in col(spark, vals).select(S.iso_date("v")).collect()]
    d = dt.date(2024, 1, 1)
    assert got == [d, d, d, d, None, None, None, None, None, None]


def test_strip_html(spark):
    vals = ["<p>a</p>", "<div\nclass='x'>b</div>", "c <b", "&amp; kept", "\t  x  \n", None]
    got = [r[0] for r in col(spark, vals).select(S.strip_html("v")).collect()]
    assert got == ["a", "b", "c <b", "&amp; kept", "x", ""]


def test_region_words(spark):
    vals = ["Remote, USA", "New York, NY", "new york, ny", "Lausanne", None, "Berlin (Flexible / Remote)"]
    got = [r[0] for r in col(spark, vals).select(S.in_region("v")).collect()]
    assert got == [True, True, False, True, False, True]


def test_boundaries_and_custom_patterns(spark):
    texts = ["GitHub Actions pipelines", "we use github", "JavaScript only", "scalability matters",
             "data warehousing team", "C++ and Rust", "x_ml stuff", "éml", "Kafka streams", "Java, Scala",
             "skills: Python, R, SQL"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    got = {r.id: r.terms for r in tag_terms(df, ["t"], skill_vocabulary()).collect()}
    assert got[0] == ["GitHub Actions"]
    assert got[1] == ["Git"]
    assert got[2] == ["JavaScript"]
    assert got[3] == []
    assert got[4] == []  # the form is bounded on both sides
    assert got[5] == ["C++", "Rust"]
    assert got[6] == [] and got[7] == []
    assert got[8] == ["Kafka"]
    assert got[9] == ["Java", "Scala"]
    assert got[10] == ["Python", "R", "SQL"]


def test_lookahead_separates(spark):
    df = spark.createDataFrame([(1, "the of x"), (2, "the cat"), (3, "THE OF")], "id int, t string")
    v = [Term("the", "the"), Term("the_not_of", "the(?! of)", stem="the")]
    got = {r.id: r.terms for r in tag_terms(df, ["t"], v).collect()}
    assert got == {1: ["the"], 2: ["the", "the_not_of"], 3: ["the"]}


def test_normalize_aliases(spark):
    got = [r[0] for r in col(spark, [" Python3. ", "PYTHON 3", "Obscure Tool;"]).select(S.normalize_term("v")).collect()]
    assert got == ["Python", "Python", "Obscure Tool"]


def test_ordered_rules(spark):
    vals = ["Senior Staff Engineer", "Sr. Analyst", "Data Scientist", "", None, "Junior Dev", "Lead"]
    got = [r[0] for r in col(spark, vals).select(classify_first("v", SENIORITY_RULES, "mid")).collect()]
    assert got == ["staff+", "senior", "mid", "mid", "mid", "entry", "staff+"]


def test_tri_state(spark):
    df = col(spark, [True, False, None], typ="boolean")
    assert df.where(P.is_true("v")).count() == 1
    assert df.where(P.is_not_true("v")).count() == 2


def test_zero_denominators(spark):
    empty = spark.createDataFrame([], "key string, terms array<string>")
    gold = spark.createDataFrame([("a", []), ("b", ["x"])], "key string, terms array<string>")
    pred = spark.createDataFrame([("a", []), ("b", [])], "key string, terms array<string>")
    r = EV.prf1(pred, gold).first()
    assert (r.tp, r.fp, r.fn, r.precision, r.recall, r.f1) == (0, 0, 1, 0.0, 0.0, 0.0)
    r0 = EV.prf1(empty, empty).first()
    assert r0.n == 0 and r0.f1 == 0.0
    share = M.set_share(spark.createDataFrame([], "job_id long, skill string"),
                        spark.createDataFrame([], "job_id long"), ["x"]).first()
    assert share.n == 0 and share.share is None


def test_ties_at_half(spark):
    df = spark.createDataFrame([(112500.0, 113500.0), (None, 1.0)], "salary_min double, salary_max double")
    got = [r[0] for r in df.select(S.salary_band()).collect()]
    assert got == ["$112k – $114k", ""]


def test_digest_falsy_values(spark):
    rows = [(1, "T1", "", None, True, 0.0, 100000.0, dt.datetime(2024, 1, 2)),
            (2, "T2", "Acme", "Paris", None, 90000.0, 110000.0, dt.datetime(2024, 1, 1))]
    df = spark.createDataFrame(rows, "job_id long, title string, company string, location string, remote boolean, "
                                     "salary_min double, salary_max double, ingested_at timestamp")
    r = A.digest(df, 8).first()
    assert r.header == "2 new openings"
    assert r.message == "• T1 — ? (remote)\n• T2 — Acme (Paris) · $100k"
    assert A.digest(df.limit(0), 8).count() == 0


def test_parse_reply(spark):
    vals = ['```json\n{"skills": ["Python3.", "", "' + "x" * 90 + '"], "seniority": "senior"}\n```',
            '{"skills": ["SQL"], "seniority": "guru"}', "{broken"]
    df = col(spark, vals)
    p = df.select(S.parse_reply("v", "skills array<string>, seniority string").alias("p"))
    rows = p.select(S.clean_terms("p.skills").alias("s"), S.in_domain("p.seniority").alias("lv"),
                    F.col("p").isNull().alias("failed")).collect()
    assert rows[0].s == ["Python"] and rows[0].lv == "senior" and not rows[0].failed
    assert rows[1].s == ["SQL"] and rows[1].lv is None
    assert rows[2].failed


def test_reply_must_be_one_object_of_strings(spark):
    vals = ['[{"skills":["a"]}]', '"str"', "123", '{"skills":[1]}', '{"skills":["a"]} trailing', '{"skills":["a"]}, {}', "", None,
            '{"skills":"Python"}', '{"skills":["a"]}', "{}"]
    got = [r[0] for r in col(spark, vals).select(S.reply_ok("v")).collect()]
    assert got == [False] * 8 + [True] * 3


def test_gold_map_with_note(spark):
    df = col(spark, ['{"a:1": ["x", "y", "x"], "_note": "meta", "b:2": []}'])
    got = {r.key: r.terms for r in EV.read_gold(df, "v").collect()}
    assert got == {"a:1": ["x", "y"], "b:2": []}


def test_region_overlap(spark):
    df = spark.createDataFrame([(1, "NATION_1, X"), (2, "NATION_10, X"), (3, None)], "id int, loc string")
    regions = [("R1", ["NATION_1"]), ("R10", ["NATION_10"])]
    multi = sorted((r.id, r.region) for r in M.region_multi(df, "loc", regions).collect())
    assert multi == [(1, "R1"), (2, "R1"), (2, "R10")]
    last = [r[0] for r in df.orderBy("id").select(M.region_last("loc", regions)).collect()]
    assert last == ["R1", "R10", "Other"]


def test_search_blank_and_literal(spark):
    df = spark.createDataFrame([(1, "a.b", None, None), (2, "axb", "Co", "X")], "id int, title string, company string, location string")
    assert P.search(df, "  ").count() == 2
    assert [r.id for r in P.search(df, "A.B").collect()] == [1]


def test_topk_ties_key_ascending(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 1)], "skill string, n long")
    assert [r.skill for r in M.topk(df, [F.col("n").desc(), F.col("skill")], 2).collect()] == ["a", "b"]


def test_explode_present_keeps_no_empty_rows_and_no_inferred_filter(spark):
    from postlens.functions.scalars import explode_present

    df = spark.createDataFrame([(1, "a b"), (2, ""), (3, None)], "id int, t string")
    arr = F.regexp_extract_all(F.coalesce("t", F.lit("")), F.lit(r"(\w+)"), 1)
    out = explode_present(df, arr, "w", "id")
    assert sorted((r.id, r.w) for r in out.collect()) == [(1, "a"), (1, "b")]
    # the regex runs once: no size(...) > 0 filter below the generator
    assert "size(" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_spread_only_below_parallelism(spark, sf):
    from postlens.sources.tables import spread, table

    docs = table(spark, sf, "documents")
    assert docs.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    wide = spark.range(0, 1000, numPartitions=64)
    assert spread(wide, "id") is wide


def test_exact_median_fast_path_equals_builtin(spark):
    from postlens.operators.median import exact_median

    df = spark.range(5000).select((F.col("id") % 4).alias("g"), (F.rand(7) * 100).alias("x"))
    got = {r.g: (r.median, r.n) for r in exact_median(df, ["g"], "x", count_col="n").collect()}
    want = {r.g: (r.m, r.n) for r in df.groupBy("g").agg(F.median("x").alias("m"), F.count("x").alias("n")).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k][0] - want[k][0]) < 1e-9 and got[k][1] == want[k][1] for k in want)


def test_read_feed_landed_files_all_layouts(spark, tmp_path):
    import json

    from postlens.sources import feeds as FD

    pages = {
        "a": [{"results": [
            {"id": "1", "title": "Data Scientist", "company": {"display_name": "Acme"}, "location": None,
             "salary_min": 100000, "salary_max": 150000, "description": "<b>raw</b>", "redirect_url": "u1",
             "created": "2024-03-01T23:30:00-05:00"},
            {"id": "2"}]}],
        "b": [{"jobs": [
            {"id": "7", "title": "Senior Data Scientist", "company_name": "B", "candidate_required_location": "USA Only",
             "description": "<p>Hello</p> world ", "url": "u7", "publication_date": "2024-03-02T00:00:00Z"},
            {"id": "8", "title": "Chef", "candidate_required_location": "USA"},
            {"id": "9", "title": "ML Engineer", "candidate_required_location": "Berlin, Germany"}]}],
        "c": [{"jobs": [
            {"id": "3", "jobTitle": "Machine Learning Engineer", "companyName": "C", "jobGeo": "Austin, TX",
             "annualSalaryMin": 90000, "annualSalaryMax": None, "jobDescription": "x", "pubDate": "bad"}]}],
        "d": [{"results": [
            {"id": 11, "name": "AI Researcher", "company": {"name": "D"},
             "locations": [{"name": "Flexible / Remote"}, {"name": "New York, NY"}], "contents": "<i>c</i>",
             "refs": {"landing_page": "u11"}, "publication_date": "2024-03-04"}]},
              {"results": [{"id": 12, "name": "Data Analyst", "locations": [], "contents": None}]}],
    }
    specs = {"a": FD.feed_a(), "b": FD.feed_b(), "c": FD.feed_c(), "d": FD.feed_d()}
    frames = []
    for k, payloads in pages.items():
        d = tmp_path / k
        d.mkdir()
        (d / "page-0.json").write_text("\n".join(json.dumps(p) for p in payloads))
        frames.append(FD.read_feed(spark, str(d), specs[k]))
    u = FD.union_feeds(frames)
    rows = {r.source_id: r for r in u.collect()}
    assert sorted(rows) == ["feed_a:1", "feed_a:2", "feed_b:7", "feed_c:3", "feed_d:11"]
    a1, a2, b7, c3, d11 = (rows[k] for k in ["feed_a:1", "feed_a:2", "feed_b:7", "feed_c:3", "feed_d:11"])
    assert (a1.company, a1.location, a1.remote, a1.description) == ("Acme", None, None, "<b>raw</b>")
    assert a1.posted_at == dt.date(2024, 3, 1) and a2.title == "" and a2.salary_min is None
    assert (b7.remote, b7.description, b7.salary_min, b7.feed_ord) == (True, "Hello  world", None, 1)
    assert (c3.salary_min, c3.salary_max, c3.posted_at, c3.remote) == (90000.0, None, None, True)
    assert (d11.location, d11.remote, d11.url, d11.description) == ("Flexible / Remote, New York, NY", True, "u11", "c")
