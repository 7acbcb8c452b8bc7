"""Nested JSON feed readers (S1-S5): declared schema -> explode items -> conform to one posting schema.

Landing files are read with an explicit schema (no inference pass, PERMISSIVE: missing fields are NULL), so the reader
is a single narrow scan; the four feed layouts differ only in their ``FeedSpec``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from postlens.functions.scalars import compose_key, in_region, is_relevant, iso_date, join_names, strip_html, true_or_null
from postlens.session import make_folder

POSTING_COLUMNS = ["source", "source_id", "title", "company", "location", "remote", "salary_min", "salary_max",
                   "description", "url", "posted_at"]
POSTING_DDL = ("source string, source_id string, title string, company string, location string, remote boolean, "
               "salary_min double, salary_max double, description string, url string, posted_at date")


@dataclass
class FeedSpec:
    """How one feed maps to the posting schema.

    ``mapping`` builds each posting column from the exploded ``item`` struct (missing entries become NULL);
    ``keep`` is an optional row filter over the conformed columns.
    """

    name: str
    items: str
    item_ddl: str
    mapping: dict[str, Callable[[], Column]]
    keep: Callable[[], Column] | None = None
    extra: dict[str, Callable[[], Column]] = field(default_factory=dict)

    def payload_schema(self) -> StructType:
        return StructType.fromDDL(f"{self.items} array<struct<{self.item_ddl}>>")


_TYPES = dict(c.split(" ") for c in POSTING_DDL.split(", "))


def conform(payload: DataFrame, spec: FeedSpec, payload_col: str | None = None, page: Column | None = None) -> DataFrame:
    """Explode a parsed payload (struct column or top-level ``items``) into posting rows with feed order columns."""
    items = F.col(f"{payload_col}.{spec.items}") if payload_col else F.col(spec.items)
    page_c = page if page is not None else F.lit(0)
    exploded = payload.select(page_c.alias("page"), F.posexplode_outer(items).alias("pos", "item")).where(
        F.col("item").isNotNull())
    cols = []
    for c in POSTING_COLUMNS:
        if c == "source":
            expr = F.lit(spec.name)
        elif c in spec.mapping:
            expr = spec.mapping[c]()
        else:
            expr = F.lit(None)
        cols.append(expr.cast(_TYPES[c]).alias(c))
    out = exploded.select(*cols, "page", "pos")
    if spec.keep is not None:
        out = out.where(spec.keep())
    return out


def read_feed(spark: SparkSession, path: str | Sequence[str], spec: FeedSpec) -> DataFrame:
    """S1-S4 over landed JSON files (one payload per file or line); page = source file."""
    df = spark.read.schema(spec.payload_schema()).option("mode", "PERMISSIVE").json(path)
    return conform(df, spec, page=F.input_file_name())


def read_feed_stream(spark: SparkSession, path: str, spec: FeedSpec, max_files: int | None = None) -> DataFrame:
    """S1-S4 on a landing folder that keeps growing: every file that lands (in sub-folders too) is read once, with the
    declared payload schema, and conformed in flight; page = source file. A line that is no JSON object of the layout gives no
    postings. ``max_files`` bounds a micro-batch."""
    r = spark.readStream.schema(spec.payload_schema()).option("mode", "PERMISSIVE").option("recursiveFileLookup", "true")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return conform(r.json(path), spec, page=F.input_file_name())


def landed_feeds(spark: SparkSession, landings: Sequence[tuple[str, FeedSpec]], max_files: int | None = None) -> DataFrame:
    """S5 on streams: the conformed rows of several landing folders as one stream, ``feed_ord`` in the given order. A folder
    that isn't there yet (no fetch of that feed has succeeded) is made, so that the stream's sources stay the same."""
    for path, _ in landings:
        make_folder(spark, path)
    return union_feeds([read_feed_stream(spark, path, spec, max_files) for path, spec in landings])


def parse_feed(df: DataFrame, col: str, spec: FeedSpec, page: Column | None = None) -> DataFrame:
    """S1-S4 over a column of JSON payload strings (e.g. a landing table)."""
    parsed = df.select(F.from_json(F.col(col), spec.payload_schema()).alias("p"),
                       (page if page is not None else F.lit(0)).alias("_page"))
    return conform(parsed, spec, "p", F.col("_page"))


def union_feeds(feeds: Sequence[DataFrame]) -> DataFrame:
    """Concatenate conformed feeds in a fixed order; ``feed_ord`` carries that order for first-wins dedup."""
    out = None
    for i, f in enumerate(feeds):
        f = f.withColumn("feed_ord", F.lit(i))
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out


def _i(name: str) -> Column:
    return F.col("item")[name]


def feed_a(name: str = "feed_a") -> FeedSpec:
    """Feed A: ``results[]`` with nested company/location structs, salary bounds, raw description, no filter."""
    return FeedSpec(
        name, "results",
        "id string, title string, company struct<display_name:string>, location struct<display_name:string>, "
        "salary_min double, salary_max double, description string, redirect_url string, created string",
        {
            "source_id": lambda: compose_key(F.lit(name), _i("id")),
            "title": lambda: F.coalesce(_i("title"), F.lit("")),
            "company": lambda: _i("company")["display_name"],
            "location": lambda: _i("location")["display_name"],
            "salary_min": lambda: _i("salary_min"),
            "salary_max": lambda: _i("salary_max"),
            "description": lambda: _i("description"),
            "url": lambda: _i("redirect_url"),
            "posted_at": lambda: iso_date(_i("created")),
        })


def feed_b(name: str = "feed_b", relevant: Sequence[str] | None = None, region: dict | None = None) -> FeedSpec:
    """Feed B: ``jobs[]``; relevance + region filter; remote = True; no salary; HTML stripped."""
    rel = dict(words=relevant) if relevant is not None else {}
    return FeedSpec(
        name, "jobs",
        "id string, title string, company_name string, candidate_required_location string, description string, "
        "url string, publication_date string",
        {
            "source_id": lambda: compose_key(F.lit(name), _i("id")),
            "title": lambda: F.coalesce(_i("title"), F.lit("")),
            "company": lambda: _i("company_name"),
            "location": lambda: _i("candidate_required_location"),
            "remote": lambda: F.lit(True),
            "description": lambda: strip_html(_i("description")),
            "url": lambda: _i("url"),
            "posted_at": lambda: iso_date(_i("publication_date")),
        },
        keep=lambda: is_relevant("title", **rel) & in_region("location", **(region or {})))


def feed_c(name: str = "feed_c", relevant: Sequence[str] | None = None, region: dict | None = None) -> FeedSpec:
    """Feed C: ``jobs[]`` with other field names and salary bounds; relevance + region filter; HTML stripped."""
    rel = dict(words=relevant) if relevant is not None else {}
    return FeedSpec(
        name, "jobs",
        "id string, jobTitle string, companyName string, jobGeo string, annualSalaryMin double, "
        "annualSalaryMax double, jobDescription string, url string, pubDate string",
        {
            "source_id": lambda: compose_key(F.lit(name), _i("id")),
            "title": lambda: F.coalesce(_i("jobTitle"), F.lit("")),
            "company": lambda: _i("companyName"),
            "location": lambda: _i("jobGeo"),
            "remote": lambda: F.lit(True),
            "salary_min": lambda: _i("annualSalaryMin"),
            "salary_max": lambda: _i("annualSalaryMax"),
            "description": lambda: strip_html(_i("jobDescription")),
            "url": lambda: _i("url"),
            "posted_at": lambda: iso_date(_i("pubDate")),
        },
        keep=lambda: is_relevant("title", **rel) & in_region("location", **(region or {})))


def feed_d(name: str = "feed_d", relevant: Sequence[str] | None = None, region: dict | None = None,
           marker: str = "Flexible / Remote") -> FeedSpec:
    """Feed D: paged ``results[]``; location = joined ``locations[].name``; remote = marker present else NULL."""
    rel = dict(words=relevant) if relevant is not None else {}
    return FeedSpec(
        name, "results",
        "id string, name string, company struct<name:string>, locations array<struct<name:string>>, "
        "contents string, refs struct<landing_page:string>, publication_date string",
        {
            "source_id": lambda: compose_key(F.lit(name), _i("id")),
            "title": lambda: F.coalesce(_i("name"), F.lit("")),
            "company": lambda: _i("company")["name"],
            "location": lambda: join_names(_i("locations")),
            "remote": lambda: true_or_null(join_names(_i("locations")), marker),
            "description": lambda: strip_html(_i("contents")),
            "url": lambda: _i("refs")["landing_page"],
            "posted_at": lambda: iso_date(_i("publication_date")),
        },
        keep=lambda: is_relevant("title", **rel) & in_region("location", **(region or {})))
