"""Registered text queries: tagging (X1-X6), evaluation (E1-E3, D4), gold reader (S10), enrichment."""

from __future__ import annotations

import json
import re
import uuid

import pandas as pd
from pyspark.sql import functions as F

from postlens.functions.scalars import explode_present
from postlens.operators import evaluate as EV
from postlens.operators.dedup import set_diff
from postlens.operators.enrich import enrich, enrich_run, write_bucketed
from postlens.operators.market import value_counts
from postlens.operators.tagging import (SKILL_CUSTOM, SKILL_FORMS, Term, classify_first, explode_terms, skill_vocabulary, tag_terms,
                                        tokenize)
from postlens.plans.catalog_sql import TAG_SQL
from postlens.plans.fixtures import DOC_RULES, DOC_VOCAB
from postlens.plans.registry import query
from postlens.session import checkpoint_dir, scratch_path
from postlens.sources.tables import table

WB = r"[^\p{L}\p{N}_]"
CUSTOM_VOCAB = [
    Term("the_context", r"[,.]\s*The\s", stem="the", case_sensitive=True, bounded=False),
    Term("tion_prefix", r"(?iu)(?<![\p{L}\p{N}_])tion", stem="tion", bounded=False),
]


def _docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text", "n_chars")


@query("tag_terms", TAG_SQL + "SELECT doc_id, array_to_string(terms, '|') AS terms, len(terms) AS n_terms FROM tags")
def q_tag_terms(spark, sf):
    t = tag_terms(_docs(spark, sf), ["text"], DOC_VOCAB)
    return t.select("doc_id", F.array_join("terms", "|").alias("terms"), F.size("terms").cast("long").alias("n_terms"))


@query("tag_custom", f"""
SELECT doc_id, concat_ws('|', CASE WHEN regexp_matches(text, '[,.]\\s*The\\s') THEN 'the_context' END,
                              CASE WHEN regexp_matches(text, '(?i)(^|{WB})tion') THEN 'tion_prefix' END) AS terms
FROM documents""")
def q_tag_custom(spark, sf):
    t = tag_terms(_docs(spark, sf), ["text"], CUSTOM_VOCAB)
    return t.select("doc_id", F.array_join("terms", "|").alias("terms"))


@query("tag_lookahead", f"""
SELECT doc_id, regexp_matches(text, '(?i)(^|{WB})the($|[^\\p{{L}}\\p{{N}}_ ]| $| [^o]| o$| o[^f])') AS the_not_of,
       regexp_matches(text, '(?i)(^|{WB})the({WB}|$)') AS the_any FROM documents""")
def q_tag_lookahead(spark, sf):
    vocab = [Term("the_not_of", "the(?! of)", stem="the"), Term("the_any", "the")]
    t = tag_terms(_docs(spark, sf), ["text"], vocab)
    return t.select("doc_id", F.array_contains("terms", "the_not_of").alias("the_not_of"),
                    F.array_contains("terms", "the_any").alias("the_any"))


@query("explode_terms", TAG_SQL + "SELECT doc_id, unnest(terms) AS skill, 'rules' AS method FROM tags")
def q_explode_terms(spark, sf):
    return explode_terms(tag_terms(_docs(spark, sf), ["text"], DOC_VOCAB), "doc_id")


@query("classify_first", f"""
SELECT doc_id, CASE WHEN regexp_matches(text, '(?i)(^|{WB})worthless({WB}|$)') THEN 'junk'
                    WHEN regexp_matches(text, '(?i)(^|{WB})(the|was)({WB}|$)') THEN 'english'
                    WHEN regexp_matches(text, '(?i)(^|{WB})en({WB}|$)') THEN 'romance' ELSE 'mid' END AS label
FROM documents""")
def q_classify_first(spark, sf):
    return _docs(spark, sf).select("doc_id", classify_first("text", DOC_RULES, "mid").alias("label"))


@query("tokenize", """
SELECT token, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z][a-z+/#.-]+')) AS token
FROM documents) GROUP BY token""")
def q_tokenize(spark, sf):
    toks = explode_present(_docs(spark, sf), tokenize("text"), "token")
    return value_counts(toks, "token")


# ------------------------------------------------------------------------------------------------- evaluation
_BWR = r"(?<![\p{L}\p{N}_])worthless(?![\p{L}\p{N}_])"


def _pred(spark, sf):
    d = _docs(spark, sf)
    terms = EV.labels_to_terms(None, [(F.col("n_chars") > 1000, "good"), (F.col("text").rlike("(?iu)" + _BWR), "toxic")])
    return d.select("doc_id", F.array_sort(terms).alias("terms"))


def _gold(spark, sf):
    lb = table(spark, sf, "labels")
    terms = EV.labels_to_terms(None, [(F.col("quality") == 1, "good"), (F.col("toxic") == 1, "toxic")])
    return lb.select("doc_id", F.array_sort(terms).alias("terms"))


_EVAL_SQL = f"""
WITH keys AS (SELECT doc_id FROM labels WHERE doc_id IN (SELECT doc_id FROM documents)),
gold AS (SELECT doc_id, 'good' AS tag FROM labels WHERE quality = 1
         UNION ALL SELECT doc_id, 'toxic' FROM labels WHERE toxic = 1),
pred AS (SELECT doc_id, 'good' AS tag FROM documents WHERE n_chars > 1000
         UNION ALL SELECT doc_id, 'toxic' FROM documents WHERE regexp_matches(text, '(?i)(^|{WB})worthless({WB}|$)')),
g AS (SELECT * FROM gold WHERE doc_id IN (SELECT doc_id FROM keys)),
p AS (SELECT * FROM pred WHERE doc_id IN (SELECT doc_id FROM keys))
"""


@query("prf1", _EVAL_SQL + """
, c AS (SELECT (SELECT count(*) FROM keys) AS n,
               (SELECT count(*) FROM p JOIN g USING (doc_id, tag)) AS tp,
               (SELECT count(*) FROM p ANTI JOIN g USING (doc_id, tag)) AS fp,
               (SELECT count(*) FROM g ANTI JOIN p USING (doc_id, tag)) AS fn),
r AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS pr,
                CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS rc FROM c)
SELECT n, tp, fp, fn, round_even(pr, 3) AS precision, round_even(rc, 3) AS recall,
       round_even(CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END, 3) AS f1 FROM r""")
def q_prf1(spark, sf):
    return EV.prf1(_pred(spark, sf), _gold(spark, sf), key="doc_id")


@query("error_report", _EVAL_SQL + """
, sp AS (SELECT doc_id, string_agg(tag, '|' ORDER BY tag) AS spurious FROM (SELECT * FROM p ANTI JOIN g USING (doc_id, tag))
         GROUP BY doc_id),
mi AS (SELECT doc_id, string_agg(tag, '|' ORDER BY tag) AS missed FROM (SELECT * FROM g ANTI JOIN p USING (doc_id, tag))
       GROUP BY doc_id)
SELECT doc_id, coalesce(spurious, '') AS spurious, coalesce(missed, '') AS missed FROM sp FULL JOIN mi USING (doc_id)""")
def q_error_report(spark, sf):
    e = EV.error_report(_pred(spark, sf), _gold(spark, sf), key="doc_id")
    return e.select("doc_id", F.array_join("spurious", "|").alias("spurious"), F.array_join("missed", "|").alias("missed"))


@query("missing_gold", "SELECT doc_id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)")
def q_missing_gold(spark, sf):
    return EV.missing_gold(_gold(spark, sf), _docs(spark, sf), key="doc_id").select("doc_id")


@query("set_diff", _EVAL_SQL + """
, agg AS (SELECT doc_id,
     coalesce((SELECT string_agg(tag, '|' ORDER BY tag) FROM (SELECT tag FROM p WHERE p.doc_id = k.doc_id
               INTERSECT SELECT tag FROM g WHERE g.doc_id = k.doc_id)), '') AS common,
     coalesce((SELECT string_agg(tag, '|' ORDER BY tag) FROM (SELECT tag FROM p WHERE p.doc_id = k.doc_id
               EXCEPT SELECT tag FROM g WHERE g.doc_id = k.doc_id)), '') AS spurious,
     coalesce((SELECT string_agg(tag, '|' ORDER BY tag) FROM (SELECT tag FROM g WHERE g.doc_id = k.doc_id
               EXCEPT SELECT tag FROM p WHERE p.doc_id = k.doc_id)), '') AS missed
  FROM keys k)
SELECT * FROM agg""")
def q_set_diff(spark, sf):
    j = _gold(spark, sf).withColumnRenamed("terms", "gold").join(
        _pred(spark, sf).withColumnRenamed("terms", "pred"), "doc_id")
    s = set_diff(j, "pred", "gold")
    return s.select("doc_id", *[F.array_join(c, "|").alias(c) for c in ("common", "spurious", "missed")])


@query("read_gold", """
SELECT 'doc:' || CAST(doc_id AS VARCHAR) AS key,
       concat_ws('|', CASE WHEN quality = 1 THEN 'good' END, CASE WHEN toxic = 1 THEN 'toxic' END) AS terms
FROM labels""")
def q_read_gold(spark, sf):
    lb = table(spark, sf, "labels")
    raw = F.array_compact(F.array(F.when(F.col("quality") == 1, "good"), F.when(F.col("toxic") == 1, "toxic"),
                                  F.when(F.col("quality") == 1, "good")))
    js = F.concat(F.lit('{"doc:'), F.col("doc_id").cast("string"), F.lit('": '), F.to_json(raw),
                  F.lit(', "_note": "hand labelled"}'))
    g = EV.read_gold(lb.select(js.alias("json")), "json")
    return g.select("key", F.array_join("terms", "|").alias("terms"))


#: Words of the shipped vocabulary, put behind the documents' texts, which hold few of them.
SURFACES = ["Python and SQL", "JavaScript", "java, scala", "scalability", "rusty", "in R, mostly", "C++ or Rust", "machine  learning",
            "ML ops; ml", "GitHub Actions", "github", "GitHub, GitLab", "git", "time-series", "Retrieval augmented generation", "k8s CI/CD",
            "RESTful APIs", "excellent", "Excel", "vector dbs", "data warehousing", "a/b testing", "scikit-learn", "ScikitLearn", "power bi",
            "hugging face", "LLM", "LLMs", "large language model", "data visualisation", "elastic search", "pysparks", "x_ml"]


def _shipped_sql() -> str:
    """The shipped vocabulary without look-arounds: they say nothing between word boundaries, but for one, which is put in other
    words."""
    rows = []
    for term, forms in sorted(SKILL_FORMS.items()):
        plain = "|".join(re.sub(r"\(\?![^)]*\)", "", f).replace("\\b", "") for f in forms)
        text = "replace(lower(t), 'github actions', ' # ')" if term == "Git" else "t"
        rows.append(f"CASE WHEN regexp_matches({text}, '(?i)(^|{WB})(?:{plain})({WB}|$)') THEN '{term}' END")
    rows += [f"CASE WHEN regexp_matches(t, '{SKILL_CUSTOM['R'][0]}') THEN 'R' END", "CASE WHEN regexp_matches(t, '(?i)\\bc\\+\\+') THEN 'C++' END"]
    surfaces = ", ".join(f"'{s}'" for s in SURFACES)
    return f"""WITH d AS (SELECT doc_id, text || ' ' || [{surfaces}][doc_id % {len(SURFACES)} + 1] AS t FROM documents)
SELECT doc_id, array_to_string(list_sort(list_filter([{", ".join(rows)}], lambda x: x IS NOT NULL)), '|') AS terms FROM d"""


@query("tag_shipped", _shipped_sql())
def q_tag_shipped(spark, sf):
    more = F.element_at(F.array(*[F.lit(s) for s in SURFACES]), (F.pmod("doc_id", F.lit(len(SURFACES))) + 1).cast("int"))
    d = _docs(spark, sf).select("doc_id", F.concat("text", F.lit(" "), more).alias("t"))
    return tag_terms(d, ["t"], skill_vocabulary()).select("doc_id", F.array_join("terms", "|").alias("terms"))


def stub_model(texts: pd.Series) -> pd.Series:
    """Deterministic stand-in for a hosted model: fenced JSON with the first words as skills; every 7th text gets a
    broken reply."""
    words = texts.fillna("").str.split(n=3).str[:3]
    out = []
    for i, (t, w) in enumerate(zip(texts.fillna(""), words)):
        if len(t) % 7 == 0:
            out.append("{not json")
        else:
            skills = ", ".join(f'"{x.strip(chr(34))}"' for x in w)
            out.append('```json\n{"skills": [' + skills + '], "seniority": "' + ("mid" if len(t) % 2 else "lead")
                       + '"}\n```')
    return pd.Series(out)


@query("enrich_stub")
def q_enrich_stub(spark, sf):
    ok, rejected = enrich(_docs(spark, sf), "doc_id", "text", stub_model)
    return ok.select("doc_id", F.array_join("skills", "|").alias("skills"), "seniority", "method")


def counting_model(texts: pd.Series) -> pd.Series:
    """Deterministic stand-in for a hosted model whose reply SQL can say: skills by the text's length and words, no seniority of
    the domain for every other text, a broken reply for every 7th length."""
    out = []
    for t in texts.fillna(""):
        skills = [f"size {len(t) % 5};", "", "x" * 80] + (["Python3."] if "the" in t else [])
        body = json.dumps({"skills": skills, "seniority": "mid" if len(t) % 2 else "lead"})
        out.append("{broken" if len(t) % 7 == 0 else f"```json\n{body}\n```" if len(t) % 3 else body)
    return pd.Series(out, index=texts.index, dtype="object")


@query("enrich_run", """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, doc_id % 5 = 4 AS before FROM documents),
s AS (SELECT *, NOT before AND length(t) % 7 <> 0 AS worked FROM d)
SELECT doc_id, before OR worked AS extracted,
       CASE WHEN worked THEN CASE WHEN length(t) % 2 = 1 THEN 'mid' END ELSE 'entry' END AS seniority,
       CASE WHEN worked THEN CASE WHEN contains(t, 'the') THEN 'llm:Python|' ELSE '' END || 'llm:size ' || (length(t) % 5)
            WHEN doc_id % 2 = 0 THEN 'rules:old' ELSE '' END AS skills,
       (SELECT count(*) FROM s WHERE worked) AS done, (SELECT count(*) FROM s WHERE NOT before AND NOT worked) AS failed
FROM s""")
def q_enrich_run(spark, sf):
    """Two runs over all pending documents: the first takes a limited number, the second all that are left, the rejected ones of
    the first among them."""
    checkpoint_dir(spark)
    base = scratch_path(spark, f"enrich-{uuid.uuid4().hex}")
    docs = table(spark, sf, "documents").select("doc_id", "text")
    work = docs.select("doc_id", (F.col("doc_id") % 5 == 4).alias("extracted"), F.lit("entry").alias("seniority"))
    write_bucketed(work, f"{base}/work", "doc_id", 8)
    old = docs.where("doc_id % 2 = 0").select("doc_id", F.lit("old").alias("skill"), F.lit("rules").alias("method"))
    write_bucketed(old, f"{base}/skills", "doc_id", 8)
    runs = [enrich_run(spark, f"{base}/work", f"{base}/skills", f"{base}/run-{i}", counting_model, "doc_id", "text", docs, limit, 8)
            for i, limit in enumerate((100, None))]
    first, last = (r.select("done", "failed") for r in runs)
    skills = spark.read.parquet(f"{base}/skills").groupBy("doc_id").agg(
        F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "method", "skill"))), "|").alias("skills"))
    # rows that the first run rejected are asked and rejected again by the second
    done = first.select("done").scalar() + last.select("done").scalar()
    return spark.read.parquet(f"{base}/work").join(skills, "doc_id", "left").select(
        "doc_id", "extracted", "seniority", F.coalesce("skills", F.lit("")).alias("skills"), done.alias("done"),
        last.select("failed").scalar().alias("failed"))
