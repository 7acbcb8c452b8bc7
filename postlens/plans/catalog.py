"""Full catalogue: importing the plan modules registers every query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.operators.market import demand_share
from postlens.operators.tagging import explode_terms, tag_terms
from postlens.plans import q_ingest, q_market, q_ml, q_scalars, q_stream, q_text  # noqa: F401
from postlens.plans.fixtures import DOC_VOCAB
from postlens.plans.registry import ORACLES, QUERIES, query
from postlens.sources.tables import table

__all__ = ["QUERIES", "ORACLES", "flagship"]


def flagship(spark: SparkSession, sf: str, k: int | None = 10) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    bridge = explode_terms(tag_terms(docs, ["text"], DOC_VOCAB), "doc_id", term_col="term")
    # the bridge comes from these documents and holds each (doc, term) once: no semi-join, no distinct count
    return demand_share(bridge, docs, key="doc_id", term="term", k=k, restrict=False, distinct=False)


from postlens.plans.catalog_sql import TAG_SQL  # noqa: E402


query("flagship_demand_share", TAG_SQL + """
, bridge AS (SELECT doc_id, unnest(terms) AS term FROM tags)
SELECT term, n, round_even(n * 100.0 / (SELECT count(*) FROM documents), 1) AS share FROM (
  SELECT term, count(DISTINCT doc_id) AS n FROM bridge GROUP BY term)
ORDER BY n DESC, term LIMIT 10""")(lambda spark, sf: flagship(spark, sf, 10))
