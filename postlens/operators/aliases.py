"""Terms normalised by a join with an alias table.

F5's column form searches a literal map, which suits a handful of aliases inside arrays. Here the aliases are a table: of any
size, joined on the lower-cased cleaned term, after equal terms have been brought together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.functions.scalars import clean_term
from postlens.operators.dedup import first_per_key

#: Alias rows up to this number are broadcast (some 10 MB); a larger table is joined as the planner sees fit.
BROADCAST_ROWS = 100_000


def alias_lookup(aliases: DataFrame) -> DataFrame:
    """(_key, _to) from (alias, canonical): one row a lower-cased alias, the smallest canonical of several; rows without either
    go. Marked for broadcast after its size has been checked."""
    rows = aliases.select(F.lower("alias").alias("_key"), F.col("canonical").alias("_to")).dropna()
    rows = first_per_key(rows, "_key", ["_to"])
    few = aliases.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return F.broadcast(rows) if few else rows


def normalize_terms(terms: DataFrame, term: str, aliases: DataFrame, out: str = "canonical") -> DataFrame:
    """``terms`` with ``out``, the canonical form of ``term`` by the table ``aliases`` (alias, canonical): looked up by
    the cleaned lower-cased term; a miss gives the cleaned term in its own case, NULL stays NULL."""
    cleaned = terms.withColumn("_cleaned", clean_term(term)).withColumn("_key", F.lower("_cleaned"))
    joined = cleaned.join(alias_lookup(aliases), "_key", "left")
    return joined.withColumn(out, F.coalesce("_to", "_cleaned")).drop("_key", "_cleaned", "_to")


def normalized_counts(terms: DataFrame, term: str, aliases: DataFrame, out: str = "term", n: str = "n") -> DataFrame:
    """How often each canonical term occurs. Raw terms are counted first, so each distinct one is cleaned and joined once and a
    term that fills a third of the rows is one row in the join."""
    raw = terms.groupBy(term).agg(F.count(F.lit(1)).alias("_c"))
    return normalize_terms(raw, term, aliases, "_canonical").groupBy(F.col("_canonical").alias(out)).agg(F.sum("_c").alias(n))
