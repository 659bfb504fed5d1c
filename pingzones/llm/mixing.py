"""Mixing sources to target weights by pivotal dependent rounding.

A source's target divided by its size says how many copies of each of its
documents are wanted.  The whole part is taken at once; the fractions are
rounded in pairs: mass (copies times words) moves at random from one document
of a pair to the other until one of them holds a whole number of copies.  What
remains fractional meets in a reduction tree: one document per block, then one
per group of blocks, then one per source.  A move keeps the words of the
source, so only the last document's rounding changes its total.  Long
documents are rounded first and what they missed is spread over the short ones,
so that the last document is a short one.  Documents without words have no mass;
they pair with one another and move copies, which changes no words.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pingzones.llm.common import IDENTITY, identity, named, named_again, placed, stored, uniform, words

# Documents that one task rounds one after the other.
BLOCK_ROWS = 1_000
# Blocks whose remainders meet in one task of the next level.
FAN_IN = 1_000
# Fractions nearer to a whole number than this are whole.
WHOLE = 1e-9


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """Target of each source: its weight's part of ``share`` times all sizes.

    ``sizes`` has one row (source, source_size) per source.  Sources in code
    point order, null last, take ``weights`` in turn.  A target stops at ``cap``
    times the source's size; the excess goes to the others by weight, again and
    again until none is above.
    """
    ranked = stored(_with_weights(sizes, weights), "mix-sources")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    limit = F.col("source_size") * F.lit(float(cap))
    # The level only rises, so each pass stops at least one more source.
    level = 0.0
    while True:
        s = ranked.agg(
            F.sum(F.when(limit <= F.col("weight") * level, F.col("source_size"))).alias("stopped"),
            F.sum(F.when(limit > F.col("weight") * level, F.col("weight"))).alias("weight"),
        ).first()
        if not s["weight"]:
            break
        risen = (share * total - cap * (s["stopped"] or 0)) / s["weight"]
        if risen <= level:
            break
        level = risen
    return ranked.select("source", "source_size", F.least(limit, F.col("weight") * level).alias("target"))


def _with_weights(sizes: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """Weights in turn by the rank of the source; ranks come from partition counts."""
    order = [F.col("source").asc_nulls_last()]
    placed = stored(
        sizes.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns({"_part": F.spark_partition_id(), "_row": F.lit(1), "_id": F.monotonically_increasing_id()}),
        "mix-ranks",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_part").agg(F.sum("_row").alias("_row")).select(
        "_part", F.coalesce(F.sum("_row").over(before), F.lit(0)).alias("_start")
    )
    rank = F.col("_start") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    of_rank = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    return placed.join(F.broadcast(starts), "_part").select("source", "source_size", of_rank.alias("weight"))


def _round_pairs(block: pa.Table) -> pa.Table:
    """One document after the other against the one of its kind still fractional.

    Documents without words are a kind of their own, in which copies move.  All
    columns but ``_part`` stay in Arrow: pandas would turn ids beside a null into doubles.
    """
    unit, size, part, chance = (block[c].to_pylist() for c in ("_unit", "_size", "_part", "_chance"))
    still_open = {}
    for i in sorted(range(len(unit)), key=lambda i: (unit[i], size[i])):
        p, kind = part[i], size[i] > 0
        if not WHOLE < p < 1 - WHOLE:
            part[i] = float(round(p))
            continue
        open_ = still_open.get(kind)
        if open_ is None:
            still_open[kind] = i
            continue
        a, b, q = size[open_] or 1, size[i] or 1, part[open_]
        up, down = min(a * (1 - q), b * p), min(a * q, b * (1 - p))
        if chance[i] * (up + down) < down:
            q, p = q + up / a, p - up / b
        else:
            q, p = q - down / a, p + down / b
        part[open_], part[i] = q, p
        if not WHOLE < q < 1 - WHOLE:
            part[open_] = float(round(q))
            open_ = i
        if not WHOLE < p < 1 - WHOLE:
            part[i] = float(round(p))
            open_ = None if open_ == i else open_
        still_open[kind] = open_
    return block.set_column(block.schema.get_field_index("_part"), "_part", pa.array(part, pa.float64()))


def _round(units: DataFrame, blocks: int, seed: int) -> DataFrame:
    """``units`` with a whole ``_part``: the levels of the reduction tree.

    ``_block`` numbers the blocks of a source; a level has a ``FAN_IN``th of the
    blocks of the one before.
    """
    whole, level = None, 0
    while True:
        dealt = units.withColumn("_chance", uniform("_unit", F.lit(seed), F.lit(level)))
        rounded = dealt.groupBy("source", "_block").applyInArrow(_round_pairs, dealt.schema)
        rounded = stored(rounded.drop("_chance"), "mix-level")
        is_whole = F.col("_part").isin(0.0, 1.0)
        if blocks <= 1:
            last = F.when(uniform("_unit", F.lit(seed), F.lit(-1)) < F.col("_part"), 1.0).otherwise(0.0)
            rounded = rounded.withColumn("_part", F.when(is_whole, F.col("_part")).otherwise(last))
            return rounded if whole is None else whole.unionByName(rounded)
        done = rounded.filter(is_whole)
        whole = done if whole is None else whole.unionByName(done)
        units = rounded.filter(~is_whole).withColumn("_block", F.floor(F.col("_block") / FAN_IN))
        blocks, level = -(-blocks // FAN_IN), level + 1


def _copies(docs: DataFrame, weights, share: float, cap: float, seed: int, source: str, id_: str, text: str):
    """One row per distinct document: ``_unit``, how many rows it has, copies of all."""
    units = stored(
        docs.select(
            named(source).alias("source"), named(id_).alias("doc_id"),
            words(named(text)).alias("_size"), *[c.alias(n) for n, c in identity(docs).items()],
        )
        .groupBy("source", "doc_id", "_size", *IDENTITY)
        .agg(F.count(F.lit(1)).alias("_rows")),
        "mix-units",
    )
    sizes = units.groupBy("source").agg(
        F.sum(F.col("_size") * F.col("_rows")).alias("source_size"),
        F.count(F.lit(1)).alias("_units"),
    )
    sizes = stored(sizes, "mix-sizes")
    targets = source_targets(sizes.drop("_units"), weights, share, cap)
    plan = stored(
        targets.alias("t").join(sizes.alias("s"), F.col("t.source").eqNullSafe(F.col("s.source")))
        .select("t.source", "t.source_size", "t.target", "s._units"),
        "mix-plan",
    )
    most = plan.agg(F.max("_units")).first()[0] or 0
    blocks = max(1, -(-most // BLOCK_ROWS))
    joined = units.alias("u").join(plan.alias("p"), F.col("u.source").eqNullSafe(F.col("p.source"))).select(
        "u.*", "p.source_size", "p.target",
        F.pmod("_unit", F.ceil(F.col("_units") / BLOCK_ROWS)).alias("_block"),
        (F.col("_size") * F.col("_units") > F.col("source_size")).alias("_long"),
    )

    def rounded(part: DataFrame, rate, tier: int) -> DataFrame:
        wanted = part.withColumn("_wanted", F.greatest(F.lit(0.0), F.least(F.lit(float(cap)), rate)) * F.col("_rows"))
        split = wanted.withColumns(
            {"_base": F.floor("_wanted"), "_part": F.col("_wanted") - F.floor("_wanted")}
        ).drop("_wanted")
        return _round(split, blocks, seed + tier).withColumn("copies", (F.col("_base") + F.col("_part")).cast("long"))

    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    long_ones = rounded(joined.filter("_long"), rate, 0)
    got = long_ones.groupBy("source").agg(
        F.sum(F.col("copies") * F.col("_size")).alias("_got"), F.sum(F.col("_rows") * F.col("_size")).alias("_had")
    )
    short = joined.filter(~F.col("_long")).alias("u").join(
        got.alias("g"), F.col("u.source").eqNullSafe(F.col("g.source")), "left"
    ).select("u.*", F.coalesce("_got", F.lit(0)).alias("_got"), F.coalesce("_had", F.lit(0)).alias("_had"))
    left = F.try_divide(F.col("target") - F.col("_got"), F.col("source_size") - F.col("_had"))
    return long_ones.unionByName(rounded(short, F.coalesce(left, rate), 1).drop("_got", "_had"))


def _share_of_row(number: Column, copies: str) -> Column:
    """Copies of the ``number``th (from 1) of the equal rows of a unit."""
    rest = F.pmod(F.col(copies), F.col("_rows"))
    return F.floor(F.col(copies) / F.col("_rows")) + F.when(number <= rest, 1).otherwise(0)


def mix(
    docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: int = 7,
    source: str = "source", id_: str = "doc_id", text: str = "text",
) -> DataFrame:
    """For each document row: what the mix takes of it.

    Returns doc_id, source, size (words), source_size, target, copies and taken
    (words).  A source's taken words differ from its target by less than the
    mean size of its documents, or by a longer one where it has no other.
    Null or empty texts have size 0 and take copies at their source's rate; a
    null source is a source of its own; equal rows share their copies evenly; an
    empty table gives no rows.  Other columns only take part in the hash that
    orders the documents.  The draw depends on that hash and ``seed`` alone.
    """
    units = _copies(docs, weights, share, cap, seed, source, id_, text)
    numbered = units.withColumn("_number", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_rows"))))
    return numbered.withColumn("copies", _share_of_row(F.col("_number"), "copies")).select(
        "doc_id", "source", F.col("_size").alias("size"), "source_size", "target", "copies",
        (F.col("copies") * F.col("_size")).alias("taken"),
    )


def mixed_documents(
    docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: int = 7,
    source: str = "source", id_: str = "doc_id", text: str = "text",
) -> DataFrame:
    """The rows of ``docs``, each as often as ``mix`` takes it; columns as in ``docs``."""
    units = _copies(docs, weights, share, cap, seed, source, id_, text).select(
        *IDENTITY, "_rows", F.col("copies").alias("_copies")
    )
    keyed = placed(docs, **identity(docs))
    number = F.when(F.col("_rows") == 1, 1).otherwise(
        F.row_number().over(Window.partitionBy(*IDENTITY).orderBy("_unit"))
    )
    joined = keyed.join(units, IDENTITY).withColumn("_number", number)
    times = F.array_repeat(F.lit(0), _share_of_row(F.col("_number"), "_copies").cast("int"))
    return named_again(joined.withColumn("_copy", F.explode(times)), docs)
