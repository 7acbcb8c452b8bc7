"""Segment and cluster statistics that share one grouping-sets pass, against plain loops and by their plans."""

import re
import statistics

from postlens.operators.market import flagged_terms, group_profile, segment_profile
from postlens.operators.ml import cluster_profile
from postlens.plans.fixtures import REGIONS, jobs_fx, skills_fx


def _rows(spark, n=400):
    """Postings of two hot groups and a small one, some without terms or value, two rows of one key, a null key and group."""
    posts = [(i, "ab"[i % 7 == 0] if i % 50 else "rare", None if i % 5 == 0 else float(i * 37 % 101)) for i in range(n)]
    posts += [(1, "a", 3.0), (None, "b", 8.0), (n + 1, None, 2.0)]
    terms = [(i, t) for i in range(0, n, 1) for t in ("x", "y", None, "z")[: i % 4]] + [(1, "x"), (None, "x"), (n + 9, "y"), (n + 1, "y")]
    return (posts, terms, spark.createDataFrame(posts, "job_id long, g string, v double"),
            spark.createDataFrame(terms, "job_id long, skill string"))


def test_group_profile_equals_loops(spark):
    posts, terms, p, t = _rows(spark)
    for approx in (False, True):
        got = {r.g: r for r in group_profile(flagged_terms(p, t), ["g"], "v", "skill", 2, approx).collect()}
        assert set(got) == {"a", "b", "rare", None}
        for g in ("a", "b", "rare"):
            mine = [(k, v) for k, h, v in posts if h == g]
            values = [v for _, v in mine if v is not None]
            with_terms = [k for k, _ in mine if k is not None and any(j == k for j, _ in terms)]
            assert (got[g].n, got[g].n_with) == (len(mine), len(with_terms))
            if not approx:
                assert got[g]["median"] == (statistics.median(values) if values else None)
            counts = {}
            for k, _ in mine:
                for j, s in terms:
                    if j == k and k is not None:
                        counts[s] = counts.get(s, 0) + 1
            best = sorted(counts.items(), key=lambda c: (-c[1], c[0] is not None, c[0] or ""))[:2]
            assert [tuple(x) for x in got[g].tops] == [(i + 1, *c) for i, c in enumerate(best)]


def test_no_rows(spark):
    _, _, p, t = _rows(spark, 10)
    assert group_profile(flagged_terms(p.where("job_id > 999"), t), ["g"], "v", "skill", 2).count() == 0
    bare = group_profile(flagged_terms(p, t.where("job_id > 999")), ["g"], "v", "skill", 2)
    assert bare.where("n_with = 0 AND size(tops) = 0").count() == bare.count() > 0


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"Exchange hashpartitioning", plan)), len(re.findall(r"CartesianProduct|NestedLoop", plan))


def test_few_shuffles(spark, sf):
    jobs, skills = jobs_fx(spark, sf).checkpoint(), skills_fx(spark, sf).checkpoint()
    hashed, crossed = _exchanges(segment_profile(jobs, skills, REGIONS, ["entry", "mid", "senior", "staff+"]))
    assert hashed <= 12 and crossed == 0  # before exchanges are shared at run time
    hashed, crossed = _exchanges(cluster_profile(jobs.selectExpr("*", "job_id % 6 AS cluster"), skills))
    assert hashed <= 14 and crossed == 0
