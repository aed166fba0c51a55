"""Operator 12: benchmark decontamination on a distributed positional inverted index, in DataFrame functions alone.

``build_index`` stores the postings (term, row, position) of the training texts for the terms that test texts use, and a
posting of END at each text's end, whose position is the number of words. Postings lie in the order of the texts: storing
them moves nothing between tasks. ``exact_matches`` takes each window's terms from the rarest on, by their number of
postings: the list of the rarest, adjusted by its offset, gives the places where the window may begin; these are
intersected with the adjusted list of the second, and what is left with the lists of all other terms.
``proximity_matches`` asks for the words within a distance of the rarest one instead.

Windows, terms and anchors have the size of the test texts; they are sent to all tasks if they are few (``FEW``, counted),
else joined by a shuffle, with the same result. Postings meet by (row, position, term), so that neither a frequent
term nor a passage in many texts gathers in one task.

Defined results: a null or empty text has no words. Repeated rows, and rows with a null id, are judged and returned each.
A test item without words has no windows; items of the same id count as one; an item with a null id marks words but is
neither counted nor listed. Extra columns are dropped.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The term that stands behind the last word of each text.
END = -1
#: So many rows at most are sent to all tasks: some tens of megabytes.
FEW = 1_000_000


@dataclass
class Index:
    """``postings``: row, pos, term; ``texts``: row, key, n_words; ``terms``: term, word."""

    postings: DataFrame
    texts: DataFrame
    terms: DataFrame
    scratch: Scratch


def words_of(text: Column) -> Column:
    """The words as they stand in the text; ``folded`` lower-cases their A-Z."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def folded(word: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(F.translate(word, _UPPER, _LOWER))


def few(df: DataFrame) -> DataFrame:
    """``df`` to be sent to all tasks if its rows are few, else as it is."""
    return F.broadcast(df) if df.count() <= FEW else df


def windows_of(items: DataFrame, scratch: Scratch, key: str = "item_id", text: str = "text", size: int = 10) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(window, offset, word, n), (window, key) and (term, word) of the test items."""
    words = items.select(F.col(key).alias("item"), F.transform(words_of(F.col(text)), folded).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (size - 1)))
    each = words.select("item", F.explode(F.transform(starts, lambda s: F.slice("w", s, size))).alias("ws"))
    each = scratch.write(each, "each")
    distinct = scratch.write(each.select("ws").distinct().withColumn("window", F.monotonically_increasing_id()), "windows")
    owners = scratch.write(each.join(distinct, "ws").where(F.col("item").isNotNull()).select("window", "item").distinct(), "owners")
    at = scratch.write(distinct.select("window", F.size("ws").alias("n"), F.posexplode("ws").alias("offset", "word")), "offsets")
    terms = scratch.write(at.select("word").distinct().withColumn("term", F.monotonically_increasing_id()), "terms")
    return at, owners, terms


def build_index(texts: DataFrame, terms: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text") -> Index:
    """Store the postings of the given (term, word) in all texts, in one pass over them."""
    numbered = texts.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.array_append(words_of(F.col(text)), F.lit("")).alias("w"))
    each = numbered.select("row", "key", F.posexplode("w").alias("pos", "raw")).withColumn("word", folded(F.col("raw")))
    known = terms.select("term", "word").unionByName(terms.sparkSession.range(1).select(F.lit(END).cast("long").alias("term"), F.lit("").alias("word")))
    stored = each.join(few(known), "word").select("row", "pos", "term", F.when(F.col("term") == END, F.col("key")).alias("key"))
    at = scratch.write(stored, "postings")
    postings = at.where(F.col("term") != END).select("row", "pos", "term")
    return Index(postings, at.where(F.col("term") == END).select("row", "key", F.col("pos").cast("long").alias("n_words")), terms, scratch)


def ranked(index: Index, offsets: DataFrame) -> DataFrame:
    """(window, n, offset, term, rank): each window's places from its rarest term on; none if a term has no postings."""
    counts = few(index.scratch.write(index.postings.groupBy("term").agg(F.count("*").alias("times")), "counts"))
    known = offsets.join(few(index.terms), "word").join(counts, "term")
    whole = Window.partitionBy("window")
    order = known.withColumns({"found": F.count("*").over(whole), "rank": F.row_number().over(whole.orderBy("times", "offset"))})
    return index.scratch.write(order.where("found = n").select("window", "n", "offset", "term", "rank"), "ranked")


def exact_matches(index: Index, offsets: DataFrame) -> DataFrame:
    """(window, row, start, n): every place where all words of a window stand in order."""
    order = ranked(index, offsets)
    at = lambda r: order.where(F.col("rank") == r).select("window", F.col("offset").alias(f"o{r}"), F.col("term").alias(f"t{r}"))
    first = order.where("rank = 1").select("window", "n", F.col("offset").alias("o1"), F.col("term")).join(at(2), "window", "left")
    begun = index.postings.join(few(first), "term").withColumn("start", F.col("pos") - F.col("o1")).where("start >= 0")
    begun = begun.select("window", "n", "row", "start", "o2", "t2")
    # the second list holds postings of terms that are some window's second rarest
    second = index.postings.join(few(order.where("rank = 2").select("term").distinct()), "term", "left_semi")
    asked = begun.where("n > 1").select("window", "n", "row", "start", (F.col("start") + F.col("o2")).cast("int").alias("pos"), F.col("t2").alias("term"))
    met = asked.join(second, ["row", "pos", "term"]).select("window", "n", "row", "start")
    left = index.scratch.write(begun.where("n = 1").select("window", "n", "row", "start").unionByName(met), "begun")
    # the other terms: each place asks for n - 2 postings; only texts with such places are read
    more = left.where("n > 2").join(few(order.where("rank > 2").select("window", "offset", "term")), "window")
    asked = more.select("window", "n", "row", "start", (F.col("start") + F.col("offset")).cast("int").alias("pos"), "term")
    rows = few(left.where("n > 2").select("row").distinct())
    rest = asked.join(index.postings.join(rows, "row", "left_semi"), ["row", "pos", "term"])
    whole = rest.groupBy("window", "n", "row", "start").agg(F.count("*").alias("found")).where("found = n - 2").drop("found")
    return left.where("n <= 2").unionByName(whole).select("window", "row", "start", "n")


def proximity_matches(index: Index, offsets: DataFrame, within: int) -> DataFrame:
    """(window, row, pos): places of a window's rarest word with each of its other words at most ``within`` positions away, in any order."""
    order = ranked(index, offsets)
    each = Window.partitionBy("window", "term").orderBy("rank")
    order = order.withColumn("once", F.row_number().over(each)).where("once = 1").drop("once")
    size = order.groupBy("window").agg(F.count("*").alias("m"))
    anchors = order.where("rank = 1").join(size, "window").select("window", "m", "term")
    found = index.scratch.write(index.postings.join(few(anchors), "term").select("window", "m", "row", "pos"), "near")
    width = max(1, within)
    block = lambda c: F.floor(c / width).cast("long")
    asked = found.where("m > 1").join(few(order.where("rank > 1").select("window", "term")), "window")
    asked = asked.withColumn("block", F.explode(F.sequence(block(F.col("pos") - within), block(F.col("pos") + within))))
    there = index.postings.join(few(found.select("row").distinct()), "row", "left_semi").select("row", block(F.col("pos")).alias("block"), "term", F.col("pos").alias("at"))
    met = asked.join(there, ["row", "block", "term"]).where(F.abs(F.col("at") - F.col("pos")) <= within)
    met = met.select("window", "m", "row", "pos", "term").distinct().groupBy("window", "m", "row", "pos").agg(F.count("*").alias("n")).where("n = m - 1")
    return found.where("m = 1").select("window", "row", "pos").unionByName(met.select("window", "row", "pos"))


def spans(matches: DataFrame) -> DataFrame:
    """(row, start, stop): the longest match from each place."""
    return matches.groupBy("row", "start").agg(F.max(F.col("start") + F.col("n")).alias("stop"))


def decontaminate(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", size: int = 10) -> DataFrame:
    """Per document: key, n_words, n_hit, n_items, items_sha256, contaminated."""
    scratch = Scratch(docs.sparkSession, "decontamination")
    offsets, owners, terms = windows_of(items, scratch, item_key, item_text, size)
    index = build_index(docs, terms, scratch, key, text)
    matches = scratch.write(exact_matches(index, offsets), "matches")
    before = Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("stop") - F.greatest(F.col("start"), F.coalesce(F.max("stop").over(before), F.lit(0))))
    hit = spans(matches).withColumn("fresh", fresh).groupBy("row").agg(F.sum("fresh").cast("long").alias("n_hit"))
    listed = matches.select("row", "window").distinct().join(few(owners), "window").select("row", F.col("item").cast("string").alias("item")).groupBy("row").agg(F.collect_set("item").alias("listed"))
    out = index.texts.join(hit.join(listed, "row", "left"), "row", "left")
    ids = F.coalesce("listed", F.array().cast("array<string>"))
    return out.select(
        F.col("key").alias(key),
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array(ids), ","), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )
