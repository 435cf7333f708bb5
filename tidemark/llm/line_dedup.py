"""Deduplication of line runs by prefix doubling over line ids, in DataFrame operations.

The corpus is a sequence of line ids.  Doubling names, for each suffix, the interval of
suffixes that share its first 1, 2, 4, ... lines; the name is the interval's first suffix in
corpus order, so it tells at once which copy came first.  A suffix that shares its prefix
with no other is unique from there on and drops out, so only repeated lines are doubled.
From the names of two overlapping prefixes follows the interval of any run length.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.store import Scratch

MIN_WORDS = 10
_WORD = r"[^\x20\x09-\x0D]+"


def _line_table(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc, mark, pos, one, two, first, needs): each line with a word of each text.

    ``pos`` numbers them and ``first`` is the line's number in the whole text.  ``needs`` are
    the runs from here on whose repetition is asked for: the shortest with ``min_words``
    words, and those that are the shortest ending at their last line.  Each line of a repeated
    run of ``min_words`` words lies in one of these inside that run: in the one that ends with
    the line, or else in the one that starts where the run does.  A need is the number of
    lines times 2**32, plus the last one's number in the text.
    """
    lines = (docs.select(F.col("doc_id").alias("doc"), "mark", F.posexplode(F.split("text", "\n")).alias("first", "x"))
             .select("doc", "mark", "first", F.regexp_count("x", F.lit(_WORD)).alias("words"),
                     F.xxhash64("x").alias("one"), F.xxhash64(F.lit(1), "x").alias("two"))
             .where("words > 0"))
    in_order = Window.partitionBy("doc", "mark").orderBy("first")
    ahead = F.collect_list(F.struct("words", "first")).over(in_order.rowsBetween(0, min_words - 1))

    def longer(held: Column, x: Column) -> Column:
        n, total = held["n"] + 1, held["total"] + x["words"]
        asked = (total >= min_words) & ((held["total"] < min_words) | (total - F.col("words") < min_words))
        need = F.shiftleft(n.cast("long"), 32) + x["first"]
        return F.struct(n.alias("n"), total.alias("total"),
                        F.when(asked, F.array_append(held["needs"], need)).otherwise(held["needs"]).alias("needs"))

    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("total"), F.array().cast("array<long>").alias("needs"))
    needs = F.aggregate("ahead", start, longer, lambda held: held["needs"])
    return (lines.withColumn("pos", F.row_number().over(in_order) - 1).withColumn("ahead", ahead)
            .select("doc", "mark", "pos", "one", "two", "first", needs.alias("needs")))


def _name(entries: DataFrame, key: list[str], scratch: Scratch) -> DataFrame:
    """``entries`` whose ``key`` is found at several places, with ``name``: the first place."""
    place = F.struct("doc", "mark", "pos")
    # Counting a repeated row twice would only keep an entry that is then found to be first.
    names = scratch(entries.groupBy(*key).agg(F.min(place).alias("name"), F.max(place).alias("end"))
                    .where("name < end").drop("end"), "names")
    return entries.join(names, key).drop(*key)


def _asked(named: DataFrame, n: int) -> DataFrame:
    """(doc, mark, pos, end, first, last) of the later copies among runs of ``n`` lines asked for;
    ``end`` is the number of the line after them, as ``pos`` counts."""
    need = F.filter("needs", lambda x: F.shiftright(x, 32) == n)
    return (named.where(F.col("name") != F.struct("doc", "mark", "pos"))
            .select("doc", "mark", "pos", "first", F.explode(need).alias("need"))
            .select("doc", "mark", "pos", (F.col("pos") + n).alias("end"), "first",
                    F.col("need").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("last")))


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, mark, first, last): line ranges of later copies, joined where they meet."""
    scratch = Scratch(docs.sparkSession, "lines")
    lines = scratch(_line_table(docs, min_words), "lines")
    at = ["doc", "mark", "pos"]
    level = scratch(_name(lines, ["one", "two"], scratch), "level")  # runs of one line
    found = [_asked(level, 1)]
    size = 1
    more = lambda x: F.shiftright(x, 32) > size
    while size < min_words and not level.where(F.exists("needs", more)).isEmpty():
        ahead = lambda n: level.select("doc", "mark", (F.col("pos") - n).alias("pos"),
                                       F.col("name").alias("next"))
        # Runs of size+1 .. 2*size lines, from two prefixes of size lines that overlap.
        for n in range(size + 1, 2 * size):
            pairs = level.join(ahead(n - size), at).withColumnRenamed("name", "here")
            found.append(_asked(_name(pairs, ["here", "next"], scratch), n))
        pairs = level.join(ahead(size), at).withColumnRenamed("name", "here")
        level = scratch(_name(pairs, ["here", "next"], scratch), "level")
        size *= 2
        found.append(_asked(level, size))
    runs = reduce(DataFrame.unionByName, found)
    in_order = Window.partitionBy("doc", "mark").orderBy("pos")
    reach = F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(F.coalesce(reach, F.lit(-1)) < F.col("pos"), 1).otherwise(0)
    island = F.sum("new").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    return (runs.distinct().withColumn("new", new).withColumn("island", island)
            .groupBy("doc", "mark", "island").agg(F.min("first").alias("first"), F.max("last").alias("last"))
            .drop("island"))


def remove_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, counts: bool = True) -> DataFrame:
    """``docs`` with ``text`` freed of line runs found earlier, and n_lines, n_removed_lines.

    Lines are what ``\n`` separates.  A line goes if it lies in a run of lines with at least
    ``min_words`` words that also starts at an earlier place: in a row with a smaller doc_id,
    or before it in the same row; so of each maximal repeated run every line of the later
    copies goes.  Lines without a word are passed over in comparing and go if the
    next lines with words before and after them both go.  A line counts as equal if its two 64-bit hashes are.  A null text
    stays null; a null doc_id has no place, so its row stays; rows that repeat a doc_id are set
    apart by their text, and rows that repeat both are one.  Columns named n_lines and
    n_removed_lines are replaced, unless ``counts`` is false, when there are none; all others
    are passed through, whatever their names.  The work per text grows with its lines.  An
    empty table gives an empty one.
    """
    marked = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
                         docs["doc_id"].cast("long").alias("doc"), F.xxhash64(docs["text"]).alias("mark"))
    text = F.col("row").getField("text")
    usable = marked.where(F.col("doc").isNotNull() & text.isNotNull()).select(
        F.col("doc").alias("doc_id"), "mark", text.alias("text"))
    # A flag for each line up to the last one that goes.
    before = F.lag("last", 1, -1).over(Window.partitionBy("doc", "mark").orderBy("first"))
    runs = (repeated_runs(usable, min_words).withColumn("stay", F.col("first") - before - 1)
            .withColumn("go", F.col("last") - F.col("first") + 1).groupBy("doc", "mark")
            .agg(F.sort_array(F.collect_list(F.struct("first", "stay", "go"))).alias("runs"),
                 F.sum("go").alias("removed")))
    flags = F.flatten(F.transform("runs", lambda r: F.concat(F.array_repeat(F.lit(False), r["stay"]),
                                                             F.array_repeat(F.lit(True), r["go"]))))
    runs = Scratch(docs.sparkSession, "lines")(runs.select("doc", "mark", flags.alias("flags"), "removed"), "runs")
    # The list of runs grows with the texts, so it is never sent to every task, at no size.
    met = marked.join(runs.hint("shuffle_merge"), ["doc", "mark"], "left")
    lines = F.split(text, "\n")
    left = F.array_join(F.filter(lines, lambda x, i: ~F.coalesce(F.get("flags", i), F.lit(False))), "\n")
    out = [(F.when(F.col("flags").isNull(), text).otherwise(left) if c == "text" else F.col("row").getField(c)).alias(c)
           for c in docs.columns if not counts or c not in ("n_lines", "n_removed_lines")]
    if counts:
        out += [F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"),
                F.coalesce("removed", F.lit(0)).cast("int").alias("n_removed_lines")]
    return met.select(*out)
