"""Removal of repeated byte strings through run-length indexes.

Every string of ``LENGTH`` bytes holds an anchor: a short string whose hash is
the least among those it holds.  Equal strings hold equal anchors, so all
occurrences of a string meet under the hash of one.  An occurrence is told by
its context, the bytes of all such strings around its anchor: of equal contexts
all but the first are repeats as a whole.  Anchors with different contexts are
dealt to shards.  A shard puts its contexts in one text, builds its
run-compressed Burrows-Wheeler transform with the suffixes at run ends sampled,
and streams matching statistics: the match length of a suffix with the one
before it is compared at samples only and falls by one from place to place in
between.  Places that match for ``LENGTH`` bytes or more form classes, in which
all but the first occurrence are repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pingzones.llm.common import stored

LENGTH = 100
ANCHOR = 32
# Anchors that a string of LENGTH bytes chooses from.
CHOICES = LENGTH - ANCHOR + 1
# Bytes that are hashed at once, and bytes of contexts in one index: few enough
# for three ranks in one number.
CHUNK = 1 << 21
SHARD_BYTES = 3 << 19
# Contexts of one anchor that a task takes; an anchor with more is made longer.
ANCHOR_ROWS = 8192

# Intervals of several texts in one line lie this many bits apart.
SHIFT = 33
LOW = (1 << SHIFT) - 1

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.array([xxhash.xxh64_intdigest(bytes([b]), 7) | 1 for b in range(256)], np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _window(op, x: np.ndarray, width: int) -> np.ndarray:
    """``op`` over every ``width`` neighbours, by doubling."""
    have = 1
    while 2 * have <= width:
        x = op(x[:-have], x[have:])
        have *= 2
    return op(x[: len(x) - (width - have)], x[width - have :]) if width > have else x


class _Anchors:
    """Places of the anchors of pieces of text."""

    def __init__(self):
        size = CHUNK + 2 * LENGTH
        base = int(_ODD)
        self.up, self.down = _powers(base, size), _powers(pow(base, -1, 1 << 64), size)

    def of(self, pieces: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each piece: places of its anchors, and their hashes."""
        whole = np.frombuffer(b"".join(pieces), np.uint8)
        sums = np.zeros(len(whole) + 1, np.uint64)
        np.cumsum(_BYTES[whole] * self.up[: len(whole)], out=sums[1:])
        h = (sums[ANCHOR:] - sums[:-ANCHOR]) * self.down[: len(sums) - ANCHOR]
        h ^= h >> np.uint64(29)
        h *= _ODD
        h ^= h >> np.uint64(32)
        least = _window(np.minimum, h, CHOICES)
        ends = np.cumsum([len(p) for p in pieces])
        for end in ends[:-1]:  # strings that reach over an end do not count
            least[max(0, end - LENGTH + 1) : end] = 0
        padded = np.concatenate([np.zeros(CHOICES - 1, np.uint64), least, np.zeros(CHOICES - 1, np.uint64)])
        at = np.flatnonzero(_window(np.maximum, padded, CHOICES)[: len(h)] == h)
        of_piece = np.searchsorted(ends, at, side="right")
        cuts = np.searchsorted(of_piece, np.arange(len(pieces) + 1))
        starts = ends - [len(p) for p in pieces]
        return [(at[a:b] - s, h[at[a:b]]) for a, b, s in zip(cuts, cuts[1:], starts)]


def _pieces(texts: list[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
    """(text, offset, bytes) in lists of about CHUNK bytes; long texts in parts that overlap."""
    held, size = [], 0
    for i, text in enumerate(texts):
        for at in range(0, len(text) - LENGTH + 1, CHUNK // 2):
            part = text[at : at + CHUNK // 2 + LENGTH - 1]
            if size + len(part) > CHUNK:
                yield held
                held, size = [], 0
            held.append((i, at, part))
            size += len(part)
    if held:
        yield held


def _merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals; those that touch become one."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.r_[True, starts[1:] > reach[:-1]]
    return starts[new], reach[np.r_[np.flatnonzero(new)[1:] - 1, len(reach) - 1]]


# A row of ``found``: an anchor of a text (hash, context, place), or, without a
# context, bytes [start, stop) that repeat.
FOUND = "hash long, context long, doc long, unit long, place int, start int, stop int"


def _found(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
    names = [f.split()[0] for f in FOUND.split(", ")]
    nulls = lambda n: n == "context" and columns.get("context") is None
    size = len(columns["start"])
    arrays = [pa.nulls(size, k) if nulls(n) else pa.array(columns[n], k) for n, k in zip(names, kinds)]
    return pa.RecordBatch.from_arrays(arrays, names)


def _find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``FOUND`` of (doc, unit, text).

    Of equal contexts in a batch only the first goes on as an anchor; the others
    are repeats already.
    """
    anchors = _Anchors()
    for batch in batches:
        doc, unit = (batch.column(i).to_numpy() for i in range(2))
        texts = [t.as_py() for t in batch.column(2).cast(pa.binary())]
        rows: list[tuple[np.ndarray, ...]] = []
        for pieces in _pieces(texts):
            for (i, offset, _), (at, h) in zip(pieces, anchors.of([p for *_, p in pieces])):
                at = at + offset
                start, stop = np.maximum(at - CHOICES + 1, 0), np.minimum(at + LENGTH, len(texts[i]))
                text = texts[i]
                context = [xxhash.xxh64_intdigest(text[a:b]) for a, b in zip(start.tolist(), stop.tolist())]
                rows.append((np.full(len(at), i), at, h, np.array(context, np.uint64), start, stop))
        if not rows:
            continue
        i, at, h, context, start, stop = (np.concatenate(c) for c in zip(*rows))
        order = np.lexsort((at, unit[i], doc[i], context, h))
        i, at, h, context, start, stop = (x[order] for x in (i, at, h, context, start, stop))
        first = np.r_[True, (h[1:] != h[:-1]) | (context[1:] != context[:-1])]
        # The same place again, from overlapping parts or an equal row, is no repeat.
        group = np.cumsum(first) - 1
        lead = np.flatnonzero(first)[group]
        same = (unit[i] == unit[i[lead]]) & (doc[i] == doc[i[lead]]) & (at == at[lead])
        yield _found(
            {"hash": h[first].view(np.int64), "context": context[first].view(np.int64), "doc": doc[i[first]],
             "unit": unit[i[first]], "place": at[first], "start": start[first], "stop": stop[first]}
        )
        again = ~same
        if again.any():
            base = i[again].astype(np.int64) << SHIFT
            a, b = _merged(base + start[again], base + stop[again])
            text, a, b = a >> SHIFT, a & LOW, b & LOW
            yield _found(
                {"hash": unit[text], "doc": doc[text], "unit": unit[text], "place": a, "start": a, "stop": b}
            )


class RunLengthIndex:
    """Run-compressed transform of a text of pieces, with samples at run ends.

    Every piece ends in a character of its own, so no match reaches over an end
    and no two suffixes are equal.
    """

    def __init__(self, pieces: list[bytes]):
        self.sizes = sizes = np.array([len(p) + 1 for p in pieces])
        self.starts = np.cumsum(sizes) - sizes
        self.text = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8).astype(np.uint32) + np.uint32(len(pieces))
        self.text[self.starts + sizes - 1] = np.arange(len(pieces))
        self.order = self._suffixes()
        before = self.text[self.order - 1]
        self.runs = np.flatnonzero(np.r_[True, before[1:] != before[:-1]])
        # Suffixes at the first place of each run, and at the end of the run before.
        self.sampled = self.order[self.runs]
        self.run_ends = np.where(self.runs > 0, self.order[self.runs - 1], -1)

    def _suffixes(self) -> np.ndarray:
        """Order of the suffixes: by seven characters, then by as many ranks at a time as a number holds.

        A suffix that ends within the characters compared is told by its piece.
        """
        n, n_pieces, places = len(self.text), len(self.starts), np.arange(len(self.text))
        piece = np.repeat(np.arange(n_pieces), self.sizes)
        left = (self.starts + self.sizes - 1)[piece] - places
        letter = np.where(left > 0, self.text.astype(np.int64) - n_pieces + 1, 0)
        ahead = lambda x, by: np.concatenate((x[by:], np.zeros(min(by, n), x.dtype)))
        key, length = letter.copy(), 7
        for k in range(1, length):
            key <<= 9
            key |= ahead(letter, k) * (left >= k)
        while True:
            order = np.argsort(key)
            key = key[order]
            dense = np.zeros(n, np.int64)
            np.cumsum(key[1:] != key[:-1], out=dense[1:])
            top = int(dense[-1])
            if top == n - 1:
                return order
            rank = np.empty(n, np.int64)
            rank[order] = dense
            bits = (top + n_pieces).bit_length()
            key, more = rank.copy(), 63 // bits
            rank += n_pieces
            for k in range(1, more):
                key <<= bits
                key |= np.where(left >= k * length, ahead(rank, k * length), piece)
            length *= more

    def matching_statistics(self) -> np.ndarray:
        """For every place: how far its suffix matches the one before it in order."""
        n, at = len(self.text), np.arange(len(self.text))
        sampled_length, k = np.zeros(len(self.sampled), np.int64), 0
        open_ = np.flatnonzero(self.run_ends >= 0)
        while open_.size:
            open_ = open_[self.text[self.sampled[open_] + k] == self.text[self.run_ends[open_] + k]]
            k += 1
            sampled_length[open_] = k
        here, known = np.zeros(n, np.int64), np.zeros(n, np.int64)
        here[self.sampled], known[self.sampled] = self.sampled, sampled_length
        last = np.maximum.accumulate(here)
        return np.maximum(known[last] - (at - last), 0)

    def repeats(self, occurrence: np.ndarray, room: np.ndarray, length: int) -> np.ndarray:
        """Places with ``room`` for ``length`` bytes whose string has an earlier occurrence."""
        match = self.matching_statistics()[self.order]
        first = np.flatnonzero(np.r_[True, match[1:] < length])
        held = np.where(room >= length, occurrence, np.iinfo(np.int64).max)[self.order]
        least = np.repeat(np.minimum.reduceat(held, first), np.diff(np.r_[first, len(held)]))
        return self.order[(held != np.iinfo(np.int64).max) & (held > least)]


RANGES = "unit long, start int, stop int"


def _ranges_of_shard(doc, unit, start, contexts: list[bytes]) -> pa.RecordBatch:
    order = np.lexsort((start, unit, doc))
    doc, unit, start = doc[order], unit[order], start[order]
    contexts = [contexts[i] for i in order]
    index = RunLengthIndex(contexts)
    sizes = np.array([len(c) + 1 for c in contexts])
    piece = np.repeat(np.arange(len(contexts)), sizes)
    within = np.arange(len(piece)) - index.starts[piece]
    text = np.cumsum(np.r_[False, (doc[1:] != doc[:-1]) | (unit[1:] != unit[:-1])])
    place = start[piece] + within
    repeated = index.repeats((text[piece] << 32) | place, sizes[piece] - 1 - within, LENGTH)
    # Apart by text, so that intervals of different texts do not touch.
    a = (text[piece[repeated]] << SHIFT) + place[repeated]
    a, b = _merged(a, a + LENGTH) if len(a) else (a, a)
    of_text = unit[np.searchsorted(text, a >> SHIFT)]
    columns = [pa.array(of_text, pa.int64()), pa.array(a & LOW, pa.int32()), pa.array(b & LOW, pa.int32())]
    return pa.RecordBatch.from_arrays(columns, ["unit", "start", "stop"])


def _index_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of (hash, doc, unit, start, context) sorted by hash; a hash stays in one shard."""
    held: list[list] = [[] for _ in range(5)]
    size = 0
    for batch in batches:
        columns = [batch.column(i).to_numpy() for i in range(4)] + [batch.column(4).to_pylist()]
        hashes = columns[0]
        ends = np.flatnonzero(np.r_[hashes[1:] != hashes[:-1], True]) + 1 if len(hashes) else []
        a = 0
        for b in ends:
            if size >= SHARD_BYTES and held[0] and held[0][-1] != hashes[a]:
                yield _ranges_of_shard(*(np.array(h) for h in held[1:4]), held[4])
                held, size = [[] for _ in range(5)], 0
            for h, c in zip(held, columns):
                h.extend(c[a:b])
            size += sum(map(len, columns[4][a:b]))
            a = b
    if held[0]:
        yield _ranges_of_shard(*(np.array(h) for h in held[1:4]), held[4])


def _units(docs: DataFrame, text: str, id_: str) -> DataFrame:
    """(doc, unit, text) of the texts that can hold a repeat; equal rows of id and text are one unit."""
    return docs.select(
        F.coalesce(F.col(id_).cast("long"), F.lit((1 << 63) - 1)).alias("doc"), _unit(text, id_).alias("unit"),
        F.col(text).alias("text"),
    ).filter(F.octet_length("text") >= LENGTH)


def _unit(text: str, id_: str) -> Column:
    return F.xxhash64(id_, text)


def _marks(units: DataFrame) -> DataFrame:
    """Anchors that occur more than once.

    ``open`` ones are the first occurrence of a context whose anchor has others
    as well; of the rest, ``start`` to ``stop`` repeats.
    """
    anchors = units.mapInArrow(_find_anchors, FOUND)
    of_hash = Window.partitionBy("hash")
    of_context = Window.partitionBy("hash", "context").orderBy("doc", "unit", "place")
    is_first = F.struct("doc", "unit", "place") == F.first(F.struct("doc", "unit", "place")).over(of_context)
    varied = F.min("context").over(of_hash) != F.max("context").over(of_hash)
    known = F.col("context").isNull()
    judged = anchors.withColumns({"open": ~known & is_first, "varied": ~known & varied})
    kept = judged.filter(known | ~F.col("open") | F.col("varied"))
    return stored(kept.select("hash", "unit", "place", "start", "stop", "open"), "repeat-marks")


def _contexts(units: DataFrame, wanted: DataFrame) -> DataFrame:
    """(hash, doc, unit, start, anchor, context): the bytes of ``wanted``, written."""
    place = F.struct("hash", "place", "start", "stop")
    per_unit = wanted.groupBy("unit").agg(F.collect_list(place).alias("wanted"))
    # Equal rows bring equal contexts at one place, which are no repeats of each other.
    joined = units.join(per_unit, "unit").select("doc", "unit", F.encode("text", "utf-8").alias("whole"), "wanted")
    cut = F.transform(
        "wanted",
        lambda w: F.struct(
            w["hash"].alias("hash"), w["start"].alias("start"), (w["place"] - w["start"]).alias("anchor"),
            F.substring(F.col("whole"), w["start"] + 1, w["stop"] - w["start"]).alias("context"),
        ),
    )
    return joined.select("doc", "unit", F.inline(cut))


def _longer_anchors(rows: DataFrame, length: int, more: int) -> DataFrame:
    """``rows`` under anchors longer by ``more`` bytes on the left, and on the right.

    Strings of LENGTH bytes that hold the anchor hold half of what they lack of
    it on one side at least, so each is held by one of the two.  Contexts are
    cut to what strings with the longer anchor reach.
    """
    context, at, size = F.col("context"), F.col("anchor"), F.octet_length("context")

    def side(fits: Column, key: int, extra: Column, start: Column) -> Column:
        cut = F.greatest(F.lit(0), start - (LENGTH - length - more))
        return F.struct(
            fits.alias("fits"), F.xxhash64("hash", F.lit(key), extra).alias("hash"),
            (F.col("start") + cut).alias("start"), (start - cut).alias("anchor"),
            F.substring(context, cut + 1, F.least(size, start + LENGTH) - cut).alias("context"),
        )

    left = side(at >= more, 0, F.substring(context, at - more + 1, F.lit(more)), at - more)
    right = side(size - at - length >= more, 1, F.substring(context, at + length + 1, F.lit(more)), at)
    return rows.select("doc", "unit", F.inline(F.array(left, right))).filter("fits").drop("fits")


def _open_ranges(contexts: DataFrame, anchor_rows: int) -> DataFrame:
    """Ranges (unit, start, stop) that repeat among contexts of one anchor.

    Anchors are made longer once before any index is built, which leaves out
    contexts that share the short anchor alone; and again while an anchor has
    more than ``anchor_rows`` contexts.
    """
    rows, length, ranges = contexts, ANCHOR, None
    place = F.struct("doc", "unit", "start")
    of_context = Window.partitionBy("hash", "context").orderBy("doc", "unit", "start")

    def also(found: DataFrame) -> None:
        nonlocal ranges
        ranges = found if ranges is None else ranges.unionByName(found)

    while True:
        more = -(-(LENGTH - length) // 2)
        rows = _longer_anchors(rows, length, more)
        length += more
        if ranges is not None:  # many contexts of one anchor: equal ones need no index
            judged = stored(rows.withColumn("open", place == F.first(place).over(of_context)), "repeat-longer")
            stop = (F.col("start") + F.octet_length("context")).alias("stop")
            also(judged.filter("not open").select("unit", "start", stop))
            rows = judged.filter("open").drop("open")
        met = rows.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("hash"))).filter("n > 1")
        rows = stored(met, "repeat-contexts")
        last = LENGTH - length < 4  # the anchor is nearly the whole string: few contexts differ
        few = rows if last else rows.filter(F.col("n") <= anchor_rows)
        dealt = few.select("hash", "doc", "unit", "start", "context").repartition("hash").sortWithinPartitions("hash")
        also(stored(dealt.mapInArrow(_index_shards, RANGES), "repeat-ranges"))
        rows = rows.filter(F.col("n") > anchor_rows).drop("n")
        if last or rows.isEmpty():
            return ranges


def _cut_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, n_bytes, n_removed, n_spans, kept) of (id, text, ranges)."""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
    for batch in batches:
        texts, ranges = batch.column(1).cast(pa.binary()), batch.column(2)
        rows = []
        for i, text in enumerate(texts):
            text = text.as_py() or b""
            of_text = ranges[i].values
            if of_text is None or not len(of_text):
                rows.append((len(text), 0, 0, text))
                continue
            a, b = _merged(*(of_text.field(n).to_numpy().astype(np.int64) for n in ("start", "stop")))
            kept = b"".join(text[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(text)]))
            rows.append((len(text), int((b - a).sum()), len(a), kept))
        columns = list(zip(*rows)) or [()] * 4
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns, kinds)], names)


def without_repeats(
    docs: DataFrame, text: str = "text", id_: str = "doc_id", anchor_rows: int = ANCHOR_ROWS
) -> DataFrame:
    """Per document row: doc_id, n_bytes, n_removed, n_spans and kept (bytes).

    A byte goes if a string of ``LENGTH`` bytes that covers it starts earlier
    too: in a text of smaller id, or before it in its own.  Null ids come last;
    texts of one id come in the order of their hash; rows equal in id and text
    are one text, and each has its result.  A null text is empty; an empty table
    gives no rows.  Long texts are read in overlapping parts, whole.  Other
    columns are not read.
    """
    units = _units(docs, text, id_)
    marks = _marks(units)
    contexts = _contexts(units, marks.filter("open"))
    ranges = marks.filter("not open").select("unit", "start", "stop").unionByName(_open_ranges(contexts, anchor_rows))
    per_unit = ranges.groupBy("unit").agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))
    narrow = docs.select(F.col(id_).alias("doc_id"), F.col(text).alias("text"), _unit(text, id_).alias("unit"))
    joined = narrow.join(per_unit, "unit", "left").select("doc_id", "text", "ranges")
    id_type = docs.schema[id_].dataType.simpleString()
    return joined.mapInArrow(
        _cut_ranges, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept binary"
    )
