"""Benchmark decontamination through a positional inverted index, in SQL functions only.

The index holds a posting (row, position, term) for each word of the training
texts that some test item uses.  A phrase (a window of test words) is looked up
from its rarest term: each posting of it, moved back by the term's offset, is a
place where the phrase may start; the posting lists of the other terms, moved by
theirs, must all hold that place.  Lists meet in equi-joins on (row, position).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pingzones.llm.common import IDENTITY, identity, named_again, placed, stored

# Which characters make a word (after A-Z are lower-cased), and the window.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 10


def tokens(text: Column | str) -> Column:
    """The words in order; an empty array for null."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


def phrases(items: DataFrame, window: int = WINDOW, text: str = "text", id_: str = "item_id") -> DataFrame:
    """Distinct windows of the items: (phrase, words, n, items).

    ``items`` lists the ids, as sorted strings, of the items the window occurs in
    (a null id is an empty string).  An item with fewer words than a window is one
    window, one without words none.
    """
    listed = items.select(F.coalesce(F.col(id_).cast("string"), F.lit("")).alias("item"), tokens(text).alias("all"))
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("all") - window + 1))
    cut = listed.filter(F.size("all") > 0).select("item", "all", F.explode(starts).alias("at"))
    windows = cut.select("item", F.slice("all", F.col("at"), window).alias("words"))
    grouped = windows.groupBy("words").agg(F.sort_array(F.collect_set("item")).alias("items"))
    numbered = grouped.withColumns({"phrase": F.monotonically_increasing_id(), "n": F.size("words")})
    return stored(numbered, "phrases")


def vocabulary(wanted: DataFrame) -> DataFrame:
    """(term, word) of the phrases."""
    words = wanted.select(F.explode("words").alias("word")).distinct()
    return stored(words.withColumn("term", F.monotonically_increasing_id()), "phrase-words")


def build_index(docs: DataFrame, terms: DataFrame, text: str = "text", id_: str = "doc_id") -> DataFrame:
    """Postings (row, position, term) of ``terms`` in the texts of ``docs``, written.

    ``row`` numbers the documents.  The posting of a document's last word is
    there whether its word is wanted or not (``term`` is null then), and carries
    the document's ``doc_id`` and ``n_words``; so does the one row, without a
    position, of a document without words.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_).alias("doc_id"), tokens(text).alias("all")
    ).select("row", "doc_id", F.size("all").alias("n_words"), F.posexplode_outer("all").alias("position", "word"))
    # Spark broadcasts the vocabulary if its written size allows and shuffles by word if not.
    last = F.col("position").isNull() | (F.col("position") == F.col("n_words") - 1)
    found = rows.join(terms, "word", "left").filter(F.col("term").isNotNull() | last)
    only_last = lambda c: F.when(last, F.col(c)).alias(c)
    return stored(
        found.select("row", "position", "term", only_last("doc_id"), only_last("n_words")), "postings"
    )


def indexed_documents(index: DataFrame) -> DataFrame:
    """(row, doc_id, n_words) of every document."""
    return index.filter("n_words is not null").select("row", "doc_id", F.col("n_words").cast("long").alias("n_words"))


def _terms_by_rarity(wanted: DataFrame, terms: DataFrame, index: DataFrame) -> DataFrame:
    """(phrase, n, offset, term, rank): rank 1 is the phrase's rarest term.

    Phrases with a term that the corpus does not have are left out.
    """
    counts = index.filter("term is not null").groupBy("term").agg(F.count(F.lit(1)).alias("postings"))
    of_phrase = Window.partitionBy("phrase")
    placed = wanted.select("phrase", "n", F.posexplode("words").alias("offset", "word")).join(terms, "word")
    ranked = (
        placed.join(counts, "term", "left")
        .withColumn("rank", F.row_number().over(of_phrase.orderBy(F.col("postings").asc_nulls_first(), "offset")))
        .withColumn("absent", F.max(F.col("postings").isNull()).over(of_phrase))
    )
    return stored(ranked.filter("not absent").select("phrase", "n", "offset", "term", "rank"), "phrase-terms")


def phrase_matches(wanted: DataFrame, terms: DataFrame, index: DataFrame) -> DataFrame:
    """Exact occurrences: (row, start, phrase, n), each once."""
    ranked = _terms_by_rarity(wanted, terms, index)
    postings = index.filter("term is not null").select("row", "position", "term")
    rarest = ranked.filter("rank = 1").select("phrase", "n", "offset", "term")
    start = (F.col("position") - F.col("offset")).alias("start")
    places = postings.join(rarest, "term").select("row", start, "phrase", "n").filter("start >= 0")
    places = stored(places, "phrase-places")
    # The other terms of each place, met with their own lists.
    others = ranked.filter("rank > 1").select("phrase", "offset", "term")
    sought = places.filter("n > 1").join(others, "phrase").select(
        "row", (F.col("start") + F.col("offset")).alias("position"), "term", "start", "phrase", "n"
    )
    held = sought.join(postings, ["row", "position", "term"])
    whole = held.groupBy("row", "start", "phrase", "n").agg(F.count(F.lit(1)).alias("held")).filter("held = n - 1")
    single = places.filter("n = 1")
    return stored(whole.drop("held").unionByName(single), "phrase-matches")


def proximity_matches(wanted: DataFrame, terms: DataFrame, index: DataFrame, slop: int) -> DataFrame:
    """Places where all words of a phrase lie near its rarest one: (row, position, phrase).

    Each distinct word of the phrase must occur at most ``slop`` words before or
    after the posting ``position`` of the rarest one, in any order.  Postings
    meet by blocks of ``slop`` positions and their neighbours, not by document.
    """
    ranked = _terms_by_rarity(wanted, terms, index)
    postings = index.filter("term is not null").select("row", "position", "term")
    block = F.floor(F.col("position") / max(slop, 1))
    rarest = ranked.filter("rank = 1").select("phrase", "term")
    around = F.explode(F.array(*[block + d for d in (-1, 0, 1)])).alias("block")
    anchors = postings.join(rarest, "term").select("row", F.col("position").alias("anchor"), "phrase", around)
    distinct_terms = ranked.select("phrase", "term").distinct()
    needed = distinct_terms.groupBy("phrase").agg(F.count(F.lit(1)).alias("needed"))
    lists = postings.join(distinct_terms, "term").select("row", block.alias("block"), "phrase", "term", "position")
    near = anchors.join(lists, ["row", "block", "phrase"]).filter(F.abs(F.col("position") - F.col("anchor")) <= slop)
    found = near.select("row", "anchor", "phrase", "term").distinct().groupBy("row", "anchor", "phrase").count()
    return found.join(needed, "phrase").filter("count = needed").select(
        "row", F.col("anchor").alias("position"), "phrase"
    )


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, text: str = "text", id_: str = "doc_id",
    item_text: str = "text", item_id: str = "item_id",
) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A word inside an occurrence of a window is hit once, however many windows
    cover it.  A null or empty text has no words and no hit, a null item text no
    window; repeated documents each get their row; items without a common id
    count as one (the ids are listed once each); empty tables give no rows or no
    hits.  Other columns are not read.
    """
    wanted = phrases(items, window, item_text, item_id)
    terms = vocabulary(wanted)
    index = build_index(docs, terms, text, id_)
    matches = phrase_matches(wanted, terms, index)
    covered = matches.select("row", "start", "n").distinct().select(
        "row", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)).alias("position")
    )
    hits = covered.distinct().groupBy("row").agg(F.count(F.lit(1)).alias("n_hit"))
    of_items = matches.select("row", "phrase").distinct().join(wanted.select("phrase", "items"), "phrase")
    listed = of_items.select("row", F.explode("items").alias("item")).distinct().groupBy("row").agg(
        F.count(F.lit(1)).alias("n_items"), F.concat_ws(",", F.sort_array(F.collect_list("item"))).alias("_items")
    )
    found = hits.join(listed, "row")
    joined = indexed_documents(index).join(found, "row", "left")
    return joined.select(
        "doc_id", "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.sha2(F.coalesce("_items", F.lit("")), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def clean_documents(docs: DataFrame, items: DataFrame, window: int = WINDOW, text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no window of an item occurs."""
    whole = placed(docs, **identity(docs))
    unit = F.struct(*IDENTITY)
    narrow = whole.select(unit.alias("doc_id"), F.col(f"c{docs.columns.index(text)}").alias("text"))
    hit = contamination(narrow, items, window).filter("contaminated").select("doc_id.*").distinct()
    return named_again(whole.join(hit, IDENTITY, "left_anti"), docs)
