"""Operator 4, chat formatting by quotation linking (DataFrame functions only).

A message's lines are parsed for nested quote marks ('>' signs, blanks between them allowed). Lines of one level that
follow each other without an empty line make a passage. Passages are normalised (marks off, lower case, white space and
line ends as one blank), so it doesn't matter where a mail program wrapped the lines, and hashed as runs of ``RUN`` words.
Each hash of a quoted passage is joined to the first message of its conversation that says the same words itself; a passage
is linked to the earlier message that says most of its hashes (the later one at ties), at least half of them. A message
replies to the one that most of its singly quoted words come from. Following replies upwards, by pointer doubling, gives
each message its thread, the turn that it goes back to, and its depth. Sorted by (thread, turn), every message stands after
what it replies to, and threads don't mix; linked quotes are gone, and each message is written in the chat template.

A conversation is never gathered in one task: messages stay rows, and their order is in columns. Both joins deal the rows of
one key to ``SALTS`` tasks, as a third of all rows may quote the same words or go back to the same message.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.common import kept_table

TEMPLATE = ("<|", "|>\n", "\n<|end|>\n")
#: Words of a hashed run; a passage or a line of fewer words is hashed whole.
RUN = 4
SALTS = 8
_MARKS = r"^((?:[ \t]*>)+)[ \t]?"


def quote_level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 1), "[^>]", ""))


def normal_words(text: Column) -> Column:
    """The words of a text in lower case."""
    return F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")


def passages(messages: DataFrame, keys: list[str], lines: str = "lines") -> DataFrame:
    """(keys..., passages) with array<(level, blank, lines, bare)>: the maximal runs of lines that agree in their quote level
    and in being empty but for marks; ``lines`` as they stand, ``bare`` without marks."""
    parsed = F.transform(lines, lambda x: F.struct(
        quote_level(x).alias("level"), F.trim(F.regexp_replace(x, _MARKS, "")).alias("bare"), x.alias("line")))

    def begins(of: Column, i: Column) -> Column:
        here, last = F.get(of, i), F.get(of, i - 1)
        return (i == 0) | (here["level"] != last["level"]) | ((here["bare"] == "") != (last["bare"] == ""))

    def passage(of: Column, starts: Column, start: Column, j: Column) -> Column:
        part = F.slice(of, start + 1, F.coalesce(F.get(starts, j + 1), F.size(of)) - start)
        head = F.get(of, start)
        return F.struct(head["level"].alias("level"), (head["bare"] == "").alias("blank"),
                        F.transform(part, lambda x: x["line"]).alias("lines"), F.transform(part, lambda x: x["bare"]).alias("bare"))

    def cut(of: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(of) - 1), lambda i: begins(of, i))
        return _let(starts, lambda s: F.transform(s, lambda start, j: passage(of, s, start, j)))

    return messages.select(*keys, _let(parsed, cut).alias("passages"))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once: as a column it would be computed anew at each element of a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _hashes(words: Column) -> Column:
    """Hashes of the runs of RUN words, or of all words where there are fewer."""
    def runs(w: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.size(w) - RUN), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(RUN)]))
        return F.when(F.size(w) >= RUN, F.array_distinct(each)).otherwise(F.array(F.xxhash64(F.array_join(w, " "))))

    return _let(words, runs)


def _salted_join(rows: DataFrame, side: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined to ``side`` (one row a key); the rows of a key are dealt to SALTS tasks."""
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64("t"), F.lit(SALTS)))
    copies = side.withColumn("_salt", F.explode(F.array(*[F.lit(i).cast("long") for i in range(SALTS)])))
    return dealt.join(copies, [*keys, "_salt"], how).drop("_salt")


def linked_passages(spark: SparkSession, parted: DataFrame) -> DataFrame:
    """Quoted passages found in an earlier message: (c, t, m, p number of the passage, level, from turn, weight in hashes,
    n_lines). ``parted`` holds (c, t, m, passages)."""
    each = parted.select("c", "t", "m", F.posexplode("passages").alias("p", "x")).where("NOT x.blank")
    each = each.select("c", "t", "m", "p", "x.level", "x.bare", normal_words(F.array_join("x.bare", " ")).alias("words"))
    each = each.where(F.size("words") > 0)
    own = each.where("level = 0")
    short = F.filter(F.transform("bare", normal_words), lambda w: (F.size(w) > 0) & (F.size(w) < RUN))  # lines that may be quoted alone
    said = own.select("c", "t", F.explode(F.array_union(_hashes(F.col("words")), F.transform(short, lambda w: F.xxhash64(F.array_join(w, " "))))).alias("h"))
    quoted = each.where("level > 0").select("c", "t", "m", "p", "level", F.size("bare").alias("n_lines"), _hashes(F.col("words")).alias("hs"))
    quoted = kept_table(spark, quoted.dropDuplicates(["c", "t", "m", "p"]), "quotes")
    marks = quoted.select("c", "t", "m", "p", "level", "n_lines", F.size("hs").alias("weight"), F.explode("hs").alias("h"))
    first = said.groupBy("c", "h").agg(F.min("t").alias("from")).join(marks.select("c", "h").distinct(), ["c", "h"], "left_semi")
    votes = _salted_join(marks, first, ["c", "h"]).where(F.col("from") < F.col("t"))
    passage = ["c", "t", "m", "p", "level", "weight", "n_lines"]
    votes = votes.groupBy(*passage, "from").agg(F.count("*").alias("n"))
    best = votes.groupBy(*passage).agg(F.max(F.struct("n", "from")).alias("best")).where(F.col("best.n") * 2 >= F.col("weight"))
    return kept_table(spark, best.select(*passage, F.col("best.from").alias("from"), F.col("best.n").alias("n")), "links")


def chat_messages(spark: SparkSession, messages: DataFrame) -> DataFrame:
    """One row per row of ``messages`` (conv_id, turn, role, text): conv_id, turn, role, thread, parent_turn, depth,
    n_quotes (quoted lines), n_linked (lines of linked passages), body (text without linked passages), chat
    (body in the template). The conversation reads in the order of (thread, turn).

    parent_turn is null and thread the own turn where nothing earlier is quoted. Null conv_id counts as one conversation,
    a null turn as before all others; rows of equal conv_id and turn are one message for linking. A null text has an
    empty body; a null role is written 'unknown'. White space around a body goes. A quoted passage that no earlier message says stays in the body as it
    stands, marks included, so no text is lost; quoted lines without words go. A passage of fewer than ``RUN`` words is linked
    where it equals a whole passage or a whole line of fewer words. Quotes of later turns or of the own one link nothing.
    Other columns are ignored."""
    base = messages.select("conv_id", "turn", "role", "text", F.coalesce(F.col("turn").cast("long"), F.lit(-(1 << 62))).alias("t"),
                           F.xxhash64(F.coalesce(F.col("conv_id").cast("string"), F.lit("\u0000null"))).alias("c"),
                           F.xxhash64(F.coalesce("text", F.lit(""))).alias("m"),
                           F.split(F.coalesce(F.col("text"), F.lit("")), r"\r?\n").alias("lines"))
    base = passages(base, ["conv_id", "turn", "role", "c", "t", "m"])
    linked = linked_passages(spark, base.select("c", "t", "m", "passages"))
    cut = linked.groupBy("c", "t", "m").agg(F.collect_set("p").alias("cut"), F.sum("n_lines").alias("n_linked"))
    votes = linked.where("level = 1").groupBy("c", "t", "from").agg(F.sum("n").alias("n"))
    up = votes.groupBy("c", "t").agg(F.max(F.struct("n", "from")).alias("best")).select(
        "c", "t", F.col("best.from").alias("parent"), F.col("best.from").alias("top"), F.lit(1).alias("depth"))
    up = kept_table(spark, up, "replies")
    done = None
    while True:  # doubling: each pass looks as far up as all passes before together
        ends = up if done is None else up.unionByName(done)
        above = ends.select("c", F.col("t").alias("top"), F.col("top").alias("top2"), F.col("depth").alias("more"))
        step = _salted_join(up, above, ["c", "top"], "left").select(
            "c", "t", "parent", F.coalesce("top2", "top").alias("top"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.col("top2").isNotNull().alias("moved"))
        step = kept_table(spark, step, "replies")
        still = step.where("NOT moved").drop("moved")  # these have reached a message that replies to nothing
        done = still if done is None else done.unionByName(still)
        up = step.where("moved").drop("moved")
        if up.limit(1).count() == 0:
            break
    out = base.join(done, ["c", "t"], "left").join(cut, ["c", "t", "m"], "left")
    numbers = F.sequence(F.lit(0), F.size("passages") - 1)
    kept = F.array_except(numbers, F.coalesce("cut", F.array().cast("array<int>")))
    kept = F.filter(F.transform(kept, lambda i: F.get("passages", i)), lambda x: ~x["blank"] | (x["level"] == 0))
    body = F.btrim(F.array_join(F.flatten(F.transform(kept, lambda x: x["lines"])), "\n"), F.lit(" \t\r\n"))
    n_quotes = F.aggregate("passages", F.lit(0).cast("long"), lambda n, x: n + F.when(x["level"] > 0, F.size(x["lines"])).otherwise(0))
    null_turn = F.lit(-(1 << 62))
    out = out.select("conv_id", "turn", "role", F.nullif(F.coalesce("top", "t"), null_turn).alias("thread"),
                     F.nullif(F.col("parent"), null_turn).alias("parent_turn"), F.coalesce("depth", F.lit(0)).alias("depth"),
                     n_quotes.alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), body.alias("body"))
    opened, named, closed = TEMPLATE
    return out.withColumn("chat", F.concat(F.lit(opened), F.coalesce("role", F.lit("unknown")), F.lit(named), F.col("body"), F.lit(closed)))
