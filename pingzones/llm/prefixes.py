"""Prefix trie of conversations by whole-sequence collapse.

Identical conversations become one weighted sequence with the list of those that
end there.  Sequences that are a proper prefix of another are found by anti-join;
the others are the leaves.  The nodes of the trie are the distinct prefixes of the
sequences, and everything known of a node is a sum over the weighted sequences
that start with it, so no tree is walked, however deep it is.

A prefix is known by its depth and 128 bits: the exclusive or of a hash of each
turn with its place.  Such hashes can be put together from parts in any order, so
a conversation that holds much of the table is worked on in blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pingzones.llm.common import named, stored
from pingzones.operators.skew import salted_left_join

# A conversation is rebuilt on the first of its group of this many ids ...
GROUP = 5
# ... of which it takes its crc32 modulo this many turns.
MOST_SHARED = 9
# Turns, or ids of an end list, that are put together at a time.
BLOCK = 4096

_NODE = ["depth", "key_a", "key_b"]


def turns_in_order(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, place, digest, n_bytes): the turns of each conversation, places from 1.

    Ordered by turn, null first; equal turns by a digest of role and text.  Rows
    without a conversation are left out.  The rows are sorted over all tasks and
    counted within each; what a conversation has in the tasks before is added, so
    a long one is shared out.
    """
    role_, text_ = (F.coalesce(named(c).cast("string"), F.lit("")) for c in (role, text))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role_).cast("string"), F.lit(":"), role_, text_)))
    slim = conversations.filter(named(conv_id).isNotNull()).select(
        named(conv_id).cast("long").alias("conv_id"), named(turn).alias("turn"), digest.alias("digest"),
        F.octet_length(text_).cast("long").alias("n_bytes"), F.monotonically_increasing_id().alias("copy"),
    )
    order = [F.col("conv_id"), F.asc_nulls_first("turn"), F.col("digest"), F.col("copy")]
    lined_up = stored(
        slim.repartitionByRange(*order).sortWithinPartitions(*order).select(
            "conv_id", "digest", "n_bytes", F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("line"),
        ),
        "trie-turns",
    )
    counts = lined_up.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # At most one conversation goes on into each part.
    going_on = counts.withColumn("before", F.sum("n").over(earlier)).filter("before > 0").drop("n")
    within = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy("line"))
    return lined_up.withColumn("place", within).join(F.broadcast(going_on), ["conv_id", "part"], "left").select(
        "conv_id", (F.col("place") + F.coalesce("before", F.lit(0))).alias("place"), "digest", "n_bytes"
    )


def rebuilt(turns: DataFrame, group: int = GROUP, most_shared: int = MOST_SHARED) -> tuple[DataFrame, DataFrame]:
    """Every conversation on the start of the first one of its group.

    Takes ``turns_in_order``.  Returns the turns (conv_id, depth, digest, n_bytes,
    source, place), the latter two telling where a turn comes from, and the
    conversations (conv_id, n_turns).  A conversation has the first turns of the one
    whose id is the next lower multiple (towards zero) of ``group``, as many as its
    crc32 says if there are that many, then its own after as many.
    """
    own = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    shared = (F.crc32(F.col("conv_id").cast("string")) % most_shared).alias("shared")
    planned = own.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % group).alias("source"), shared)
    first = own.select(F.col("conv_id").alias("source"), F.col("n").alias("n_source"))
    plan = stored(
        planned.join(first, "source", "left").withColumn(
            "taken", F.least("shared", F.coalesce("n_source", F.lit(0)))
        ).select("conv_id", "n", "source", "shared", "taken"),
        "trie-plan",
    )
    of_own = turns.join(plan.select("conv_id", "shared", "taken"), "conv_id").filter("place > shared").select(
        "conv_id", (F.col("place") - F.col("shared") + F.col("taken")).alias("depth"), "digest", "n_bytes",
        F.col("conv_id").alias("source"), "place",
    )
    starts = turns.filter(F.col("place") < most_shared).withColumnRenamed("conv_id", "source")
    of_first = starts.join(plan.select("source", "conv_id", "shared"), "source").filter("place <= shared").select(
        "conv_id", F.col("place").alias("depth"), "digest", "n_bytes", "source", "place"
    )
    sizes = plan.select("conv_id", (F.col("taken") + F.greatest(F.lit(0), F.col("n") - F.col("shared"))).alias("n_turns"))
    # Written, so that the join may split a hot conversation whatever comes next.
    return stored(of_own.unionByName(of_first), "trie-rebuilt"), sizes


def _prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, key_a, key_b, up_a, up_b, n_bytes, so_far): each prefix, its parent and its bytes.

    Blocks of a conversation are run along on their own; what the blocks before
    come to is added.
    """
    hashed = turns.select(
        "conv_id", "depth", "n_bytes", F.floor((F.col("depth") - 1) / BLOCK).alias("block"),
        F.xxhash64("digest", "depth").alias("a"), F.xxhash64(F.lit("b"), "depth", "digest").alias("b"),
    )
    along = Window.partitionBy("conv_id", "block").orderBy("depth")
    of_block = F.bit_xor("a").alias("all_a"), F.bit_xor("b").alias("all_b"), F.sum("n_bytes").alias("all_bytes")
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = hashed.groupBy("conv_id", "block").agg(*of_block).select(
        "conv_id", "block", F.bit_xor("all_a").over(earlier).alias("before_a"),
        F.bit_xor("all_b").over(earlier).alias("before_b"), F.sum("all_bytes").over(earlier).alias("before_bytes"),
    ).filter("block > 0")
    zero = F.lit(0).cast("long")
    run = hashed.withColumns(
        {"run_a": F.bit_xor("a").over(along), "run_b": F.bit_xor("b").over(along), "run_bytes": F.sum("n_bytes").over(along)}
    ).join(before, ["conv_id", "block"], "left")
    keyed = run.select(
        "conv_id", "depth", "a", "b", "n_bytes",
        F.col("run_a").bitwiseXOR(F.coalesce("before_a", zero)).alias("key_a"),
        F.col("run_b").bitwiseXOR(F.coalesce("before_b", zero)).alias("key_b"),
        (F.col("run_bytes") + F.coalesce("before_bytes", zero)).alias("so_far"),
    )
    return keyed.select(
        "conv_id", "depth", "key_a", "key_b", F.col("key_a").bitwiseXOR(F.col("a")).alias("up_a"),
        F.col("key_b").bitwiseXOR(F.col("b")).alias("up_b"), "n_bytes", "so_far",
    )


def _hash_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each group's joined chunks; the chunks of a group follow one another."""
    group, digest, done = None, None, []

    def handed_on() -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        columns = zip(*done) if done else ((), (), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], [*_NODE, "ends_sha256"]
        )

    for batch in batches:
        for *this, chunk in zip(*(c.to_pylist() for c in batch.columns)):
            if this == group:
                digest.update(b",")
            else:
                if group is not None:
                    done.append((*group, digest.hexdigest()))
                group, digest = this, hashlib.sha256()
            digest.update(chunk.encode())
        yield handed_on()
        done.clear()
    if group is not None:
        done.append((*group, digest.hexdigest()))
    yield handed_on()


def _end_lists(ends: DataFrame) -> DataFrame:
    """(depth, key_a, key_b, ends_sha256) of the conversations that end at a node.

    Ids are sorted over all tasks and joined into chunks; a group's chunks then
    stream through one task, which holds one of them at a time (SHA-256 has to
    read its input in order).
    """
    order = [*_NODE, "conv_id"]
    lined_up = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).select(
        *order, F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("line")
    )
    number = F.row_number().over(Window.partitionBy(*_NODE, "part").orderBy("line"))
    chunks = stored(lined_up, "trie-ends").withColumn("chunk", F.floor((number - 1) / BLOCK)).groupBy(
        *_NODE, "part", "chunk"
    ).agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    in_order = chunks.repartition(*_NODE).sortWithinPartitions(*_NODE, "part", "chunk").select(*_NODE, "ids")
    return in_order.mapInArrow(_hash_lists, "depth long, key_a long, key_b long, ends_sha256 string")


def prefix_trie(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """The nodes of the trie of sequences.

    ``turns`` holds (conv_id, depth, digest, n_bytes) with depths gapless from 1,
    ``sizes`` (conv_id, n_turns) of every conversation, turnless ones too.  Returns
    per node conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256.  Without conversations there is no
    node, not even the root.
    """
    zero = F.lit(0).cast("long")
    prefixes = stored(_prefixes(turns), "trie-prefixes")
    ending = sizes.join(prefixes, (prefixes.conv_id == sizes.conv_id) & (prefixes.depth == sizes.n_turns), "left").select(
        sizes.conv_id, sizes.n_turns.cast("long").alias("depth"),
        *[F.coalesce(c, zero).alias(c) for c in ("key_a", "key_b", "so_far")],
    )
    ending = stored(ending, "trie-conversations")
    # Whole-sequence collapse; hot sequences are summed before they are dealt out.
    sequences = stored(
        ending.groupBy(*_NODE).agg(
            F.count(F.lit(1)).alias("weight"), F.min("conv_id").alias("first"), F.max("so_far").alias("total")
        ),
        "trie-sequences",
    )
    lengths = sequences.select(F.col("first").alias("conv_id"), F.col("depth").alias("length"))
    paths = prefixes.join(lengths, "conv_id").withColumnRenamed("conv_id", "first")
    root = lengths.select(
        F.col("conv_id").alias("first"), *[zero.alias(c) for c in paths.columns[1:-1]], "length"
    )
    paths = stored(paths.unionByName(root), "trie-paths")
    nodes = stored(
        paths.groupBy(*_NODE).agg(
            F.min("first").alias("first"), F.max("n_bytes").alias("n_bytes"),
            F.max(F.col("depth") < F.col("length")).alias("inner"),
        ),
        "trie-nodes",
    )
    # A node is owned by the sequence of its smallest member, which then owns all of its path below.
    owned = nodes.groupBy("first").agg(F.sum("n_bytes").alias("owned"))
    leaves = sequences.join(nodes.filter("inner"), _NODE, "left_anti").select("first", F.lit(1).alias("leaf"))
    weighted = stored(
        sequences.select("first", "weight", "total")
        .join(owned, "first", "left")
        .join(leaves, "first", "left")
        .select("first", "weight", "total", F.coalesce("owned", zero).alias("owned"), F.coalesce("leaf", F.lit(0)).alias("leaf")),
        "trie-weights",
    )
    summed = paths.join(weighted, "first").groupBy(*_NODE).agg(
        F.sum("weight").alias("n_convs"),
        F.sum(F.col("weight") * F.col("total")).alias("weighted_bytes"),
        F.sum("owned").alias("owned"),
        F.sum("leaf").alias("n_leaves"),
        F.min(F.struct("first", "total", "owned")).alias("of_first"),
        F.max(F.col("so_far") - F.col("n_bytes")).alias("above"),
        F.max("up_a").alias("up_a"), F.max("up_b").alias("up_b"),
    )
    # All turns below (n_convs times each) less one of each: those that others own,
    # and those of the smallest member from here on.
    once = F.col("owned") - F.col("of_first.owned") + F.col("of_first.total") - F.col("above")
    saved = F.col("weighted_bytes") - F.col("n_convs") * F.col("above") - once
    figures = stored(
        summed.select(
            *_NODE, (F.col("depth") - 1).alias("up_depth"), "up_a", "up_b", F.col("of_first.first").alias("conv_id"),
            "n_convs", "n_leaves", saved.alias("saved_tokens"),
        ),
        "trie-figures",
    )
    above = ["up_depth", "up_a", "up_b"]
    children = figures.filter("depth > 0").groupBy(*above).agg(F.count(F.lit(1)).alias("n_children"))
    children = children.withColumnsRenamed(dict(zip(above, _NODE)))
    parents = figures.select(
        *[F.col(c).alias(u) for c, u in zip(_NODE, above)], F.col("conv_id").alias("parent_conv_id")
    )
    # A node may have a third of all others as children: its row is repeated for salted parts of them.
    placed = salted_left_join(figures, parents, above)
    return placed.join(children, _NODE, "left").join(_end_lists(ending), _NODE, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"),
        F.col("n_leaves").cast("long").alias("n_leaves"), "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def conversation_trie(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    group: int = GROUP, most_shared: int = MOST_SHARED,
) -> DataFrame:
    """The trie of all conversations, each rebuilt on the first of its group.

    A null role or text is empty, a null turn comes first, equal turns go by a
    digest of role and text, so repeated rows are turns of their own.  Rows without a
    conversation take no part; an empty table has no nodes; other columns are not read.
    """
    turns = stored(turns_in_order(conversations, conv_id, turn, role, text), "trie-places")
    return prefix_trie(*rebuilt(turns, group, most_shared))
