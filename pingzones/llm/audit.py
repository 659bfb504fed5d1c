"""How filters overlap, in every order they could run in.

The filters that a document fails are a set.  A set of filters already applied
is a state of the subset lattice, and applying one more is an edge; what an edge
removes depends on the state alone, not on the order that led there.  So each
document is read once, documents are counted by (part, failed set), and those
counts give the removals of every edge.  Counting the paths forward from the
empty state and backward from the full one gives the number of orders through an
edge, which weighs its removals in the Shapley sum; the steps of single orders
are read from the same edges.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pingzones.llm.common import named, stored

# The words of a text, and the thresholds of the filters.
WORD = r"[^\x20\x09-\x0D]+"
LEAST_WORDS = 200
LEAST_DISTINCT_PERCENT = 50
MOST_CAPITALS_PERCENT = 2
MARKS = r"[#$%&*|]"


def text_filters(text: Column, words: Column) -> dict[str, Column]:
    """Failure conditions that look at one text and its words, by filter letter."""
    n = F.size(words)
    return {
        "A": n < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT_PERCENT * n,
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > MOST_CAPITALS_PERCENT * F.char_length(text),
        "D": text.rlike(MARKS),
    }


def forward_counts(n: int) -> list[int]:
    """Orders of the first filters that reach each state (a set of bits)."""
    counts = [1] + [0] * ((1 << n) - 1)
    for state in range(1, 1 << n):
        counts[state] = sum(counts[state ^ (1 << f)] for f in range(n) if state >> f & 1)
    return counts


def backward_counts(n: int) -> list[int]:
    """Orders of the other filters that leave each state."""
    counts = [0] * (1 << n)
    counts[-1] = 1
    for state in reversed(range((1 << n) - 1)):
        counts[state] = sum(counts[state | (1 << f)] for f in range(n) if not state >> f & 1)
    return counts


def lattice_edges(n: int) -> list[tuple[int, int, int]]:
    """(state before, bit of the filter, orders that take this edge)."""
    forward, backward = forward_counts(n), backward_counts(n)
    return [
        (state, 1 << f, forward[state] * backward[state | 1 << f])
        for state in range(1 << n)
        for f in range(n)
        if not state >> f & 1
    ]


def order_steps(names: str) -> list[tuple[str, int, int, int]]:
    """(order, step from 1, state before, bit of the filter) of every order of the filters."""
    rows = []
    for order in permutations(range(len(names))):
        state = 0
        for step, f in enumerate(order, 1):
            rows.append(("".join(names[g] for g in order), step, state, 1 << f))
            state |= 1 << f
    return rows


def failed_sets(
    docs: DataFrame, labels: DataFrame, copies: str | None = "E", text: str = "text", id_: str = "doc_id",
    part: str = "source", filters=text_filters,
) -> tuple[str, DataFrame]:
    """Filter letters, and per document (id, part, failed, good, toxic); ``failed`` has bit i for letter i.

    ``filters`` gives the conditions from (text, words).  ``copies`` is the letter
    of one more filter: fails a document whose whole text a smaller id has too.
    The least id of a text is found by its SHA-256; a document then meets it by
    (text, id), so copies of one text do not meet in one task.
    """
    whole = docs.select(
        named(id_).alias("id"), F.coalesce(named(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(named(text), F.lit("")).alias("text"),
    ).withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    conditions: Mapping[str, Column] = filters(F.col("text"), F.col("words"))
    bits = [F.when(c, 1 << i).otherwise(0) for i, c in enumerate(conditions.values())]
    judged = stored(
        whole.select(
            "id", "part", F.unhex(F.sha2("text", 256)).alias("hash"),
            sum(bits[1:], bits[0]).cast("int").alias("failed"),
        ),
        "audit-failed",
    )
    letters = "".join(conditions)
    if copies is not None:
        first = judged.filter("id IS NOT NULL").groupBy("hash").agg(F.min("id").alias("id"))
        judged = judged.join(first.withColumn("first", F.lit(True)), ["hash", "id"], "left").withColumn(
            "failed",
            F.col("failed") + F.when(F.col("id").isNotNull() & F.col("first").isNull(), 1 << len(letters)).otherwise(0),
        )
        letters += copies
    known = labels.select(named(id_).alias("id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
    known = known.filter("id IS NOT NULL").groupBy("id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    return letters, judged.join(known, "id", "left").select("id", "part", "failed", "good", "toxic")


def audit(
    docs: DataFrame, labels: DataFrame, copies: str | None = "E", text: str = "text", id_: str = "doc_id",
    part: str = "source", filters=text_filters,
) -> DataFrame:
    """What each step of each order of the filters keeps and removes, by part.

    Returns part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley.  A null text is empty, a null part the empty
    string.  A document without an id has no labels and is never a copy; rows that
    repeat an id and its text are no copies of each other.  Of several labels of
    one id, any 1 counts.  An empty table gives no rows; other columns are not
    read.  The orders grow with the factorial of the filters: meant for a few.
    """
    letters, documents = failed_sets(docs, labels, copies, text, id_, part, filters)
    spark = docs.sparkSession
    count = lambda c, name: F.count_if(c).alias(name)
    # A row for each part and failed set: hot parts are summed before they are dealt out.
    cells = documents.groupBy("part", "failed").agg(
        F.count(F.lit(1)).alias("n"), count(F.col("good"), "good"), count(F.col("toxic"), "toxic")
    )
    edge = F.inline(
        F.array(
            *[
                F.struct(F.lit(s).alias("state"), F.lit(b).alias("bit"), F.lit(w).cast("long").alias("orders"))
                for s, b, w in lattice_edges(len(letters))
            ]
        )
    )
    failed, state, bit = F.col("failed"), F.col("state"), F.col("bit")
    fails, before = failed.bitwiseAND(bit) != 0, failed.bitwiseAND(state) != 0
    total = lambda c, of, name: F.sum(F.when(c, F.col(of)).otherwise(0)).alias(name)
    edges = cells.select("*", edge).groupBy("part", "state", "bit", "orders").agg(
        total(~before & ~fails, "n", "kept"),
        total(~before & fails, "n", "removed"),
        total(before & fails, "n", "redundant"),
        total(failed == bit, "n", "unique_fails"),
        total(~before & fails, "good", "good_lost"),
        total(~before & fails, "toxic", "toxic_lost"),
    )
    of_filter = Window.partitionBy("part", "bit")
    weighed = edges.withColumn("shapley", F.sum(F.col("removed") * F.col("orders")).over(of_filter))
    steps = spark.createDataFrame(order_steps(letters), "filter_order string, step int, state int, bit int")
    return weighed.join(F.broadcast(steps), ["state", "bit"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost",
        "shapley",
    )
