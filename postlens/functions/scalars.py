"""Scalar / projection functions F1-F26.

Each returns a ``Column`` built from built-in Spark expressions so that it stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

__all__ = [
    "col_of", "strip_ws", "strip_html", "iso_date", "in_region", "is_relevant", "clean_term", "normalize_term",
    "compose_key", "join_names", "true_or_null", "midpoint", "salary_band", "money_k", "count_label", "pct_label",
    "signed_k", "day_label", "collapse_ws", "text_window", "truncate", "falsy", "haystack", "lookup_or_self",
    "parse_reply", "reply_ok", "clean_terms", "in_domain", "title_label", "prefixed", "strip_prefix", "plural",
    "ratio", "round_even", "literal_map", "regex_quote", "explode_present",
    "ELIGIBLE_WORDS", "STATE_CODES", "REMOTE_MARKER", "RELEVANT_WORDS", "ALIASES", "SHORT_NAMES", "LEVELS",
]

# ---------------------------------------------------------------------------------------------------------------
# Fixed values that must equal the reference for identical results (dictionaries and word lists, natural order).
# ---------------------------------------------------------------------------------------------------------------
# Region eligibility words (case-insensitive), state codes (case-sensitive after ", "), and the remote marker.
ELIGIBLE_WORDS = ["usa", "united states", "u.s.", "north america", "americas", "worldwide", "anywhere"]
STATE_CODES = [
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA",
    "ME", "MD", "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ", "NM", "NY", "NC", "ND", "OH", "OK",
    "OR", "PA", "RI", "SC", "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY", "DC",
]
REMOTE_MARKER = "Flexible / Remote"
# Relevance alternation over titles (case-insensitive; `ml` and `ai` are word-bounded).
RELEVANT_WORDS = [
    "data scien", "machine learning", r"\bml\b", "data engineer", "data analy", "mlops", r"\bai\b",
    "artificial intelligence",
]
# Ordinal seniority domain.
LEVELS = ["entry", "mid", "senior", "staff+"]
# Alias -> canonical name.
ALIASES = {
    "python3": "Python", "python 3": "Python",
    "golang": "Go",
    "js": "JavaScript", "javascript": "JavaScript", "typescript": "TypeScript",
    "postgres": "PostgreSQL", "postgresql": "PostgreSQL",
    "ms sql": "SQL Server", "mssql": "SQL Server", "sql server": "SQL Server",
    "sklearn": "scikit-learn", "scikit learn": "scikit-learn", "scikitlearn": "scikit-learn",
    "tf": "TensorFlow", "tensorflow": "TensorFlow", "pytorch": "PyTorch", "torch": "PyTorch",
    "xgb": "XGBoost", "xgboost": "XGBoost",
    "hugging face": "Hugging Face", "huggingface": "Hugging Face",
    "llms": "LLMs", "llm": "LLMs", "large language models": "LLMs",
    "genai": "Generative AI", "gen ai": "Generative AI", "generative ai": "Generative AI",
    "nlp": "NLP", "natural language processing": "NLP",
    "cv": "Computer Vision", "computer vision": "Computer Vision",
    "rag": "RAG", "retrieval augmented generation": "RAG", "retrieval-augmented generation": "RAG",
    "aws": "AWS", "amazon web services": "AWS",
    "gcp": "GCP", "google cloud": "GCP", "google cloud platform": "GCP",
    "azure": "Azure", "microsoft azure": "Azure",
    "k8s": "Kubernetes", "kubernetes": "Kubernetes",
    "airflow": "Airflow", "apache airflow": "Airflow",
    "spark": "Spark", "apache spark": "Spark", "pyspark": "Spark",
    "kafka": "Kafka", "apache kafka": "Kafka",
    "dbt": "dbt",
    "databricks": "Databricks", "snowflake": "Snowflake", "bigquery": "BigQuery",
    "redshift": "Redshift",
    "ci/cd": "CI/CD", "cicd": "CI/CD", "ci cd": "CI/CD",
    "github actions": "GitHub Actions",
    "power bi": "Power BI", "powerbi": "Power BI", "tableau": "Tableau",
    "looker": "Looker",
    "excel": "Excel", "microsoft excel": "Excel",
    "etl": "ETL", "elt": "ETL",
    "docker": "Docker", "terraform": "Terraform",
    "mlflow": "MLflow", "mlops": "MLOps",
    "langchain": "LangChain",
    "fastapi": "FastAPI", "flask": "Flask", "django": "Django",
    "pandas": "pandas", "numpy": "NumPy",
    "a/b testing": "A/B Testing", "ab testing": "A/B Testing",
    "statistics": "Statistics", "statistical analysis": "Statistics",
    "machine learning": "Machine Learning", "ml": "Machine Learning",
    "deep learning": "Deep Learning", "dl": "Deep Learning",
    "data visualization": "Data Visualization", "dataviz": "Data Visualization",
    "sql": "SQL", "nosql": "NoSQL", "mongodb": "MongoDB", "redis": "Redis",
    "git": "Git", "linux": "Linux",
    "rest api": "REST APIs", "rest apis": "REST APIs", "restful apis": "REST APIs",
}
# Display short names for long canonical terms.
SHORT_NAMES = {
    "Machine Learning": "ML",
    "Deep Learning": "DL",
    "Generative AI": "GenAI",
    "Experimentation": "Experiments",
    "Statistics": "Stats",
    "Data Visualization": "DataViz",
    "Data Governance": "Governance",
    "Data Warehousing": "Warehousing",
    "Data Modeling": "Modeling",
    "Computer Vision": "CV",
    "Prompt Engineering": "Prompting",
    "Feature Engineering": "Feat. Eng.",
    "GitHub Actions": "GH Actions",
    "Vector Databases": "Vector DBs",
    "Model Monitoring": "Monitoring",
    "REST APIs": "REST",
}
# ---------------------------------------------------------------------------------------------------------------

_REGEX_SPECIALS = set("\\.^$|?*+()[]{}")


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def regex_quote(s: str) -> str:
    """Escape a literal for use inside a Java / RE2 regular expression."""
    return "".join("\\" + ch if ch in _REGEX_SPECIALS else ch for ch in s)


def literal_map(mapping: Mapping[str, str]) -> Column:
    """A literal ``map<string,string>``; size is bounded by the caller's dictionary."""
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def strip_ws(c: str | Column) -> Column:
    """Unicode-whitespace strip on both ends (Spark ``trim`` removes spaces only)."""
    return F.regexp_replace(col_of(c), r"(?U)^\s+|\s+$", "")


def strip_html(c: str | Column) -> Column:
    """NULL -> '', every tag -> one space, then strip. Entities and script bodies are kept."""
    return strip_ws(F.regexp_replace(F.coalesce(col_of(c), F.lit("")), "<[^>]+>", " "))


_ISO = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([T ]([01]\d|2[0-3])(:[0-5]\d(:[0-5]\d(\.\d{1,6})?)?)?(Z|[+-]([01]\d|2[0-3])(:?[0-5]\d(:?[0-5]\d)?)?)?)?$"
)


def iso_date(c: str | Column) -> Column:
    """ISO-8601 text -> date in the value's own offset (never shifted through a session zone); bad -> NULL."""
    v = col_of(c).cast("string")
    return F.when(F.coalesce(v.rlike(_ISO), F.lit(False)), F.substring(v, 1, 10).try_cast("date"))


def in_region(c: str | Column, words: Sequence[str] = ELIGIBLE_WORDS, codes: Sequence[str] = STATE_CODES,
              marker: str | None = REMOTE_MARKER, bounded_words: bool = False) -> Column:
    """eligibility words (case-insensitive; inside longer words too unless ``bounded_words``) OR ', XX' state code (case-sensitive, bounded) OR marker."""
    loc = F.coalesce(col_of(c), F.lit(""))
    alt = "|".join(regex_quote(w) for w in words)
    word_re = rf"(?iu)(?<![\p{{L}}\p{{N}}_])(?:{alt})(?![\p{{L}}\p{{N}}_])" if bounded_words else rf"(?iu)(?:{alt})"
    cond = loc.rlike(word_re)
    if codes:
        cond = cond | loc.rlike(r",\s*(?:" + "|".join(codes) + r")\b")
    if marker:
        cond = cond | loc.contains(marker)
    return cond


def is_relevant(c: str | Column, words: Sequence[str] = RELEVANT_WORDS) -> Column:
    """case-insensitive alternation (entries are regex fragments)."""
    return F.coalesce(col_of(c), F.lit("")).rlike("(?iu)(?:" + "|".join(words) + ")")


def clean_term(c: str | Column) -> Column:
    """Strip, then drop trailing '.', ',' and ';'."""
    return F.regexp_replace(strip_ws(c), "[.,;]+$", "")


def normalize_term(c: str | Column, aliases: Mapping[str, str] = ALIASES) -> Column:
    """F5 as a column: lower-case alias lookup of the cleaned term, miss -> cleaned original case."""
    cleaned = clean_term(c)
    return F.coalesce(F.try_element_at(literal_map(aliases), F.lower(cleaned)), cleaned)


def compose_key(src: str | Column, ident: str | Column) -> Column:
    """'<src>:<id>'."""
    return F.concat(col_of(src).cast("string"), F.lit(":"), col_of(ident).cast("string"))


def join_names(c: str | Column, field: str = "name", sep: str = ", ") -> Column:
    """F8: array of structs -> joined field values; missing array -> ''."""
    arr = F.coalesce(col_of(c), F.array())
    return F.array_join(F.transform(arr, lambda x: x[field]), sep)


def true_or_null(c: str | Column, marker: str = REMOTE_MARKER) -> Column:
    """True when the marker occurs, else NULL (never False)."""
    return F.when(F.coalesce(col_of(c), F.lit("")).contains(marker), F.lit(True))


def midpoint(lo: str | Column = "salary_min", hi: str | Column = "salary_max") -> Column:
    """(lo + hi) / 2, NULL if either is NULL."""
    return (col_of(lo) + col_of(hi)) / 2


def round_even(c: str | Column, d: int = 0) -> Column:
    """half-even rounding."""
    return F.bround(col_of(c), d)


def _k(c: Column) -> Column:
    return F.format_string("%.0f", F.bround(c / 1000, 0))


def salary_band(lo: str | Column = "salary_min", hi: str | Column = "salary_max") -> Column:
    """'$80k – $120k', '' when either bound is NULL (half-even, like Python's format)."""
    lo_c, hi_c = col_of(lo), col_of(hi)
    return F.when(lo_c.isNotNull() & hi_c.isNotNull(),
                  F.concat(F.lit("$"), _k(lo_c), F.lit("k – $"), _k(hi_c), F.lit("k"))).otherwise(F.lit(""))


def money_k(c: str | Column) -> Column:
    """'$113k'."""
    return F.concat(F.lit("$"), _k(col_of(c)), F.lit("k"))


def count_label(c: str | Column) -> Column:
    """'1,234'."""
    return F.format_number(col_of(c).cast("long"), 0)


def pct_label(c: str | Column) -> Column:
    """'42%'."""
    return F.concat(F.format_string("%.0f", F.bround(col_of(c), 0)), F.lit("%"))


def signed_k(c: str | Column) -> Column:
    """'+24.6k' / '-3.1k'."""
    v = F.bround(col_of(c) / 1000, 1)
    return F.concat(F.when(v < 0, F.lit("-")).otherwise(F.lit("+")), F.format_number(F.abs(v), 1), F.lit("k"))


def day_label(ts: str | Column) -> Column:
    """'Jan 05'."""
    return F.date_format(col_of(ts), "MMM dd")


def collapse_ws(c: str | Column) -> Column:
    """Collapse every whitespace run to one space and strip (Python ' '.join(s.split()))."""
    return strip_ws(F.regexp_replace(F.coalesce(col_of(c), F.lit("")), r"(?U)\s+", " "))


def text_window(title: str | Column, body: str | Column, n: int | None = 4200) -> Column:
    """title + newline + first n code points of the whitespace-collapsed body (n=None: whole body)."""
    b = collapse_ws(body)
    if n is not None:
        b = F.substring(b, 1, n)
    return F.concat(F.coalesce(col_of(title), F.lit("")), F.lit("\n"), b)


def truncate(c: str | Column, n: int) -> Column:
    """first n characters."""
    return F.substring(col_of(c), 1, n)


def falsy(c: str | Column, default: str | Column) -> Column:
    """F16: NULL or '' -> default."""
    d = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.nullif(col_of(c), F.lit("")), d)


def haystack(*cols: str | Column) -> Column:
    """lower(a + ' ' + b + ...) with NULL -> '' (keeps the separators)."""
    return F.lower(F.concat_ws(" ", *[F.coalesce(col_of(c), F.lit("")) for c in cols]))


def lookup_or_self(c: str | Column, mapping: Mapping[str, str] = SHORT_NAMES) -> Column:
    """map.get(x, x)."""
    return F.coalesce(F.try_element_at(literal_map(mapping), col_of(c)), col_of(c))


def _reply_body(c: str | Column) -> Column:
    t = strip_ws(col_of(c))
    fenced = strip_ws(F.regexp_replace(F.split_part(t, F.lit("```"), F.lit(2)), "^json", ""))
    return F.when(t.startswith("```"), fenced).otherwise(t)


def reply_ok(c: str | Column, text_lists: Sequence[str] = ("skills",)) -> Column:
    """True when the (de-fenced) reply is one complete JSON object and its ``text_lists`` hold nothing but strings."""
    body = _reply_body(c)
    ok = F.coalesce(F.size(F.from_json(F.concat(F.lit("["), body, F.lit("]")), "array<string>")) == 1, F.lit(False))
    ok = ok & F.json_object_keys(body).isNotNull()
    parsed = F.try_parse_json(body)
    for name in text_lists:
        items = F.try_variant_get(parsed, f"$.{name}", "array<variant>")
        ok = ok & F.coalesce(F.forall(items, lambda x: F.schema_of_variant(x) == "STRING"), F.lit(True))
    return F.coalesce(ok, F.lit(False))


def parse_reply(c: str | Column, schema: DataType | str) -> Column:
    """strip, drop a code fence and its 'json' tag, parse; anything ``reply_ok`` rejects -> NULL (count it as
    failed)."""
    return F.when(reply_ok(c), F.from_json(_reply_body(c), schema))


def clean_terms(c: str | Column, max_len: int = 80, aliases: Mapping[str, str] = ALIASES) -> Column:
    """drop empty and too-long items, normalise, distinct, sort (code-point order)."""
    kept = F.filter(col_of(c), lambda x: (x.isNotNull()) & (F.length(x) > 0) & (F.length(x) < max_len))
    amap = literal_map(aliases)

    def norm(x: Column) -> Column:
        cleaned = F.regexp_replace(F.regexp_replace(x, r"(?U)^\s+|\s+$", ""), "[.,;]+$", "")
        return F.coalesce(F.try_element_at(amap, F.lower(cleaned)), cleaned)

    return F.array_sort(F.array_distinct(F.transform(kept, norm)))


def in_domain(c: str | Column, values: Iterable[str] = LEVELS) -> Column:
    """value outside the domain -> NULL."""
    return F.when(col_of(c).isin(list(values)), col_of(c))


def title_label(c: str | Column) -> Column:
    """title-case words."""
    return F.initcap(col_of(c))


def prefixed(c: str | Column, prefix: str) -> Column:
    """add a feature-name prefix."""
    return F.concat(F.lit(prefix), col_of(c))


def strip_prefix(c: str | Column, prefix: str) -> Column:
    """remove a feature-name prefix."""
    return F.regexp_replace(col_of(c), "^" + regex_quote(prefix), "")


def plural(n: str | Column) -> Column:
    """'s' when n > 1."""
    return F.when(col_of(n) > 1, F.lit("s")).otherwise(F.lit(""))


def ratio(a: str | Column, b: str | Column, default: float = 0.0) -> Column:
    """a / b, default when b is 0 (ANSI division by zero raises; try_divide does not)."""
    return F.coalesce(F.try_divide(col_of(a).cast("double"), col_of(b).cast("double")), F.lit(default))


def explode_present(df: DataFrame, arr: Column, alias: str | Sequence[str], *keep: str | Column) -> DataFrame:
    """``keep`` columns plus one row per non-NULL element (or map entry) of ``arr``.

    ``explode_outer`` + NOT NULL instead of ``explode``: for ``explode`` the optimizer infers a ``size(arr) > 0``
    filter and pushes it toward the scan (through projections and repartitions), so an expensive array expression
    (regex extraction, tagging, JSON parsing) would be evaluated twice, the second time possibly in the scan task."""
    names = [alias] if isinstance(alias, str) else list(alias)
    out = df.select(*keep, F.explode_outer(arr).alias(*names))
    return out.where(F.col(names[0]).isNotNull())
