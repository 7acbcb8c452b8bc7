"""Operator 8, benchmark decontamination by SimHash over item-sized windows (DataFrame functions only).

Windows: where a document shares a shingle with an item, a window of the item's number of words is laid so that the two
shingles fall together. A window without a common shingle has similarity 0, so no other place needs one. Windows of equal
content for one item are compared once.

Candidates: a window's fingerprint has 168 bits, each the majority over its shingles, as often as they occur. Window and
item are compared if their fingerprints differ in at most ``RADIUS`` = 41 bits. Found by multi-index: of 21 blocks of 8
bits at least one then differs in at most one bit, so every item is entered under each block's value and its 8
neighbours, and a window looks up its 21 blocks. All fingerprints within the radius are found. A window shorter than its
item, of which a document has at most one, is compared whatever its fingerprint, if the lengths allow the similarity.

Verification: weighted similarity of the full shingle sets, each shingle weighing the times it occurs:
sum of the smaller counts / sum of the larger counts >= ``per_cent`` / 100. Equal windows have distance 0; for a window of the
item's length at similarity 0.8 the expected distance is about 25 with a deviation of 5, so the radius loses less than 1 in
1000 such pairs at the threshold itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.common import kept_table

SIZE = 5
#: Three hashes give 56 bits each, in 7 blocks.
PARTS, RADIUS = 3, 41
#: Item shingles up to this number are broadcast (at most some 50 MB); more are joined by a shuffle.
BROADCAST_ROWS = 500_000
#: Bits are counted side by side, two lanes of 30 bits in a long, which holds more words than a text can have.
_SHIFTS = 14
_LANES = 1 | 1 << 30


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def shingles(own: Column, size: Column | int) -> Column:
    """Hashes of the runs of SIZE words, or of ``size`` words if that is less."""
    def hashed(k: int) -> Column:
        return F.when(F.size(own) >= k, F.transform(F.sequence(F.lit(0), F.size(own) - k), lambda i: F.xxhash64(
            *(F.get(own, i + j) for j in range(k)))))

    if isinstance(size, int):
        return hashed(size)
    out = hashed(SIZE)
    for k in range(1, SIZE):
        out = F.when(size == k, hashed(k)).otherwise(out)
    return out


def occurrences(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """(keys, x, name): how often each shingle x of column sh occurs."""
    return df.select(*keys, F.explode("sh").alias("x")).groupBy(*keys, "x").agg(F.count("*").alias(name))


def fingerprints(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, prints): three numbers of 56 bits, each bit the majority over the shingles in column sh. The bits stand in four
    lanes of 14; those of the first and third, and of the second and fourth, are counted together."""
    places = [j + lane for lane in (0, 15) for j in range(_SHIFTS)]
    sums = []
    for part in range(PARTS):
        h = F.xxhash64("x", F.lit(part))
        sums += [F.sum(F.shiftrightunsigned(h, j).bitwiseAND(F.lit(_LANES))).alias(f"s{part}_{j}") for j in places]
    counted = df.select(*keys, F.explode("sh").alias("x")).groupBy(*keys).agg(F.count("*").alias("n"), *sums)
    level = (F.lit((1 << 29) - 1) - F.col("n")) * F.lit(_LANES)  # lifts twice the count to the lane's top bit if it is over n
    prints = []
    for part in range(PARTS):
        out = F.lit(0).cast("long")
        for j in places:
            over = F.col(f"s{part}_{j}") * 2 + level
            out = out.bitwiseOR(F.shiftleft(F.shiftrightunsigned(over, 29).bitwiseAND(F.lit(_LANES)), j))
        prints.append(out)
    return counted.select(*keys, F.array(*prints).alias("prints"))


def blocks(prints: Column) -> Column:
    """The 21 blocks of 8 bits: of each number its four lanes of 14 bits, without the unused bit between them."""
    def packed(x: Column) -> Column:
        lanes = [F.shiftrightunsigned(x, 15 * k).bitwiseAND(F.lit((1 << _SHIFTS) - 1)) for k in range(4)]
        whole = lanes[0]
        for k in range(1, 4):
            whole = whole.bitwiseOR(F.shiftleft(lanes[k], _SHIFTS * k))
        return F.transform(F.array(*(F.lit(8 * b) for b in range(7))), lambda at: F.pmod(F.call_function("shiftright", whole, at), F.lit(256)))

    return F.flatten(F.transform(prints, packed))


def contaminated(spark: SparkSession, docs: DataFrame, items: DataFrame, per_cent: int = 80) -> DataFrame:
    """One row per document and benchmark item that it holds: doc_id, tie (CRC-32 of the text), item_id, similarity,
    first_word and n_words of the best window (smallest at ties), distance of the fingerprints.

    Words are lower-cased runs of letters and digits; shingles are runs of five words, or all words of a shorter item. A
    document shorter than an item is one window. ``docs`` (doc_id, text), ``items`` (item_id, text); other columns are
    ignored. Null or empty texts, and texts without words, match nothing. Rows of equal id and text count as one; a null
    doc_id is reported like any other, rows of a repeated item_id are items of their own."""
    cut = items.select("item_id", words(F.col("text")).alias("w")).where("size(w) > 0").distinct()
    cut = cut.withColumn("size", F.least(F.size("w"), F.lit(SIZE))).withColumn(
        "sh", shingles(F.col("w"), F.col("size"))).select(
        F.xxhash64("item_id", "w").alias("item"), "item_id", F.size("w").alias("long"), "size", "sh")
    items = kept_table(spark, cut, "items")
    entries = items.agg(F.sum(F.size("sh"))).first()[0]
    lookup = items.select("item", "long", "size", F.posexplode("sh").alias("at", "x")).groupBy("x", "item", "long", "size").agg(
        F.min("at").alias("at"))
    if (entries or 0) <= BROADCAST_ROWS:
        lookup = F.broadcast(lookup)

    base = docs.select("doc_id", F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("tie"), "text")
    cut = base.select("doc_id", "tie", words(F.col("text")).alias("w"))
    sizes = sorted({SIZE} | {r["size"] for r in items.select("size").distinct().collect()})
    found = None
    for k in sizes:
        some = cut.select("doc_id", "tie", F.size("w").alias("n"), F.posexplode(shingles(F.col("w"), k)).alias("place", "x"))
        some = some.join(lookup.where(F.col("size") == k), "x")
        found = some if found is None else found.unionByName(some)
    start = F.greatest(F.lit(0), F.least(F.col("place") - F.col("at"), F.col("n") - F.col("long")))
    windows = found.select("doc_id", "tie", "item", "long", "size", start.alias("start")).distinct()
    per_doc = kept_table(spark, windows.groupBy("doc_id", "tie").agg(
        F.collect_list(F.struct("item", "long", "size", "start")).alias("windows")), "hits")

    b = base.alias("b").join(per_doc.alias("p"), F.col("b.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("b.tie") == F.col("p.tie")))
    laid = b.select("b.doc_id", "b.tie", "b.text", "p.windows").dropDuplicates(["doc_id", "tie"])
    laid = laid.select("doc_id", "tie", F.explode(F.transform(
        "windows", lambda x: F.struct(x["item"].alias("item"), x["size"].alias("size"), x["start"].alias("start"),
                                      F.slice(words(F.col("text")), x["start"] + 1, x["long"]).alias("w")))).alias("x"))
    laid = laid.select("doc_id", "tie", "x.*").withColumn("sh", shingles(F.col("w"), F.col("size"))).where("size(sh) > 0")
    laid = kept_table(spark, laid.select("doc_id", "tie", "item", "start", F.size("w").alias("n_words"),
                                         F.xxhash64("sh").alias("content"), "sh"), "windows")

    contents = laid.groupBy("item", "content").agg(F.first("sh").alias("sh"), F.first("n_words").alias("n_words"))
    contents = kept_table(spark, contents, "contents")
    prints = kept_table(spark, fingerprints(contents, ["item", "content"]), "prints")
    of_items = kept_table(spark, fingerprints(items, ["item"]).withColumnRenamed("prints", "item_prints"), "item-prints")
    near = F.array(F.lit(0).cast("long"), *(F.lit(1 << k).cast("long") for k in range(8)))
    entered = of_items.select("item", F.posexplode(blocks(F.col("item_prints"))).alias("block", "v")).select(
        "item", "block", F.explode(F.transform(near, lambda m: F.col("v").bitwiseXOR(m))).alias("value"))
    asked = prints.select("item", "content", F.posexplode(blocks(F.col("prints"))).alias("block", "value"))
    lengths = items.select("item", "long", F.size("sh").alias("n_item"))
    short = contents.join(lengths, "item").where((F.col("n_words") < F.col("long")) & (100 * F.size("sh") >= per_cent * F.col("n_item")))
    candidates = asked.join(entered, ["item", "block", "value"]).select("item", "content", F.lit(False).alias("short")).unionByName(
        short.select("item", "content", F.lit(True).alias("short"))).groupBy("item", "content").agg(F.max("short").alias("short"))

    distance = F.aggregate(F.zip_with("prints", "item_prints", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda a, x: a + x)
    pairs = candidates.join(prints, ["item", "content"]).join(of_items, "item")
    pairs = pairs.select("item", "content", "short", distance.alias("distance")).where(F.col("short") | (F.col("distance") <= RADIUS))
    counts = occurrences(contents.join(pairs, ["item", "content"], "left_semi"), ["item", "content"], "c")
    both = counts.join(occurrences(items, ["item"], "i"), ["item", "x"]).groupBy("item", "content").agg(
        F.sum(F.least("c", "i")).alias("both"))
    full = pairs.join(contents.select("item", "content", F.size("sh").alias("n")), ["item", "content"]).join(both, ["item", "content"]).join(
        items.select("item", "item_id", F.size("sh").alias("n_item")), "item")
    full = full.withColumn("either", F.col("n") + F.col("n_item") - F.col("both")).where(100 * F.col("both") >= per_cent * F.col("either"))
    good = full.select("item", "item_id", "content", (F.col("both") / F.col("either")).alias("similarity"), "distance")
    best = laid.drop("sh").join(good, ["item", "content"]).groupBy("doc_id", "tie", "item", "item_id").agg(F.max(F.struct(
        "similarity", (-F.col("start")).alias("back"), "n_words", "distance")).alias("m"))
    return best.select("doc_id", "tie", "item_id", "m.similarity", (-F.col("m.back")).alias("first_word"), "m.n_words", "m.distance")
