"""Exact encoding and decoding with a merge-type piece vocabulary.

A text is the sequence of pieces that merging neighbours, best score first, would
end in.  That sequence is the only one in which every two adjacent pieces, merged
anew on their own, come out as they were.  So the encoder does not merge: at each
place it takes the longest piece (found for all places by one Aho-Corasick run),
checks it against the piece before, goes to shorter ones if they do not go
together, and steps back a piece if none does.  A place that was given up is
marked in a bitfield and never tried again, so the work stays linear.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, fields
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pingzones.llm.common import named

# Fixed values of the vocabulary format: the mark that stands for a space, piece
# kinds, what an unknown id is shown as, and what a wrong byte is replaced by.
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE, MERGE_TYPE = 1, 2, 3, 6, 2
UNKNOWN_TEXT, WRONG_BYTE = " ⁇ ", "�"
# Words and pairs that a Python worker remembers, and the longest such word: some 200 MB.
REMEMBERED = 800_000
REMEMBERED_LENGTH = 48
# Ids that a task collects before it hands on a batch.
BATCH_IDS = 1 << 20


@dataclass(frozen=True)
class PieceModel:
    """What encoding and decoding need, of the size of the vocabulary."""

    scores: dict[str, float]
    ids: dict[str, int]
    # Next shorter piece that starts alike; the last one is a single character.
    shorter: dict[str, str | None]
    # Text of each id, and the byte of those that stand for one.
    texts: list[str]
    bytes_: dict[int, int]
    byte_ids: list[int]
    unknown: int
    prefix: bool
    # No piece goes on behind a space mark, so words can be encoded alone.
    by_word: bool

    # Made once a process: a task finds what earlier ones in its worker have remembered.
    @cached_property
    def encoder(self) -> Encoder:
        return Encoder(self)

    @cached_property
    def decoder(self) -> Decoder:
        return Decoder(self)

    def __getstate__(self):
        return {f.name: getattr(self, f.name) for f in fields(self)}


def remerged_steps(text: str, scores: dict[str, float]) -> Iterator[list[str]]:
    """The parts of ``text`` before and after each merge: best score first, of equal scores the leftmost."""
    parts = list(text)
    while True:
        yield parts
        best, at = None, 0
        for i in range(len(parts) - 1):
            score = scores.get(parts[i] + parts[i + 1])
            if score is not None and (best is None or score > best):
                best, at = score, i
        if best is None:
            return
        parts = [*parts[:at], parts[at] + parts[at + 1], *parts[at + 2 :]]


def remerged(text: str, scores: dict[str, float]) -> list[str]:
    """``text`` by merging."""
    for parts in remerged_steps(text, scores):
        pass
    return parts


def load_model(path: str) -> PieceModel:
    """The model file at ``path``, which the driver reads.

    Only merge-type vocabularies that spell unknown characters in bytes, without a
    character map, user-defined or unused pieces, are supported; others raise
    ValueError.
    """
    from sentencepiece import sentencepiece_model_pb2 as format_

    proto = format_.ModelProto()
    with open(path, "rb") as file:
        proto.ParseFromString(file.read())
    rules, trained = proto.normalizer_spec, proto.trainer_spec
    plain = not (rules.precompiled_charsmap or rules.remove_extra_whitespaces) and rules.escape_whitespaces
    if trained.model_type != MERGE_TYPE or not plain or trained.treat_whitespace_as_suffix or not trained.byte_fallback:
        raise ValueError(f"{path}: only merge-type vocabularies with bytes and without text rules are supported")
    if any(p.type not in (NORMAL, UNKNOWN, CONTROL, BYTE) for p in proto.pieces):
        raise ValueError(f"{path}: user-defined and unused pieces are not supported")
    of_kind = lambda kind: {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kind}
    ids, single = of_kind(NORMAL), of_kind(BYTE)
    scores = {p: proto.pieces[i].score for p, i in ids.items()}
    bytes_ = {i: int(name[1:-1], 16) for name, i in single.items()}
    # A piece that does not come out of its own characters is never part of a result.
    whole = {p for p in scores if remerged(p, scores) == [p]}
    shorter: dict[str, str | None] = {}
    for p in whole:
        cut = next((p[:k] for k in range(len(p) - 1, 1, -1) if p[:k] in whole), p[0])
        shorter[p] = cut if len(p) > 1 else None
    spelled = {NORMAL: lambda p: p.replace(SPACE, " "), UNKNOWN: lambda p: UNKNOWN_TEXT}
    texts = [spelled.get(p.type, lambda p: "")(p.piece) for p in proto.pieces]
    unknown = next(iter(of_kind(UNKNOWN).values()), -1)
    byte_ids = [i for i, _ in sorted(bytes_.items(), key=lambda x: x[1])]
    by_word = not any(SPACE in p.lstrip(SPACE) for p in scores)
    return PieceModel(scores, ids, shorter, texts, bytes_, byte_ids, unknown, rules.add_dummy_prefix, by_word)


class Encoder:
    """Ids of texts; remembers words and pairs of pieces it has met.

    A piece is known by its id; a character that is no piece by its code point
    above all ids.
    """

    def __init__(self, model: PieceModel):
        self.model, self.n_ids = model, len(model.texts)
        self.names = {i: p for p, i in model.ids.items()}
        self.lengths = [len(self.names.get(i, " ")) for i in range(self.n_ids)]
        self.shorter = {model.ids[p]: None if q is None else self.of(q) for p, q in model.shorter.items()}
        # Backwards, so that a match's end is the place where the piece starts.
        self.matches = ahocorasick.Automaton()
        for piece in model.shorter:
            self.matches.add_word(piece[::-1], model.ids[piece])
        if len(self.matches):
            self.matches.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.edges: dict[tuple[str, int], list[str]] = {}
        # Words met last, and those met before them.
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.segments = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+" if model.by_word else "(?s).+")
        in_pieces = set().union(*model.ids)
        self.mark = next(chr(c) for c in range(0x110000) if chr(c) not in in_pieces)

    def of(self, piece: str) -> int:
        at = self.model.ids.get(piece)
        return self.n_ids + ord(piece) if at is None else at

    def name(self, at: int) -> str:
        return self.names[at] if at < self.n_ids else chr(at - self.n_ids)

    def go_together(self, left: int, right: int) -> bool:
        """Whether merging the two anew leaves them as they are.

        Only parts that touch in the middle can join them, so nothing is merged if
        no two of those make a piece.
        """
        left, right, scores = self.name(left), self.name(right), self.model.scores
        if not any(a + b in scores for a in self.edge(left, -1) for b in self.edge(right, 0)):
            return True
        return remerged(left + right, scores) == [left, right]

    def edge(self, piece: str, side: int) -> list[str]:
        """The parts at the end (-1) or start (0) of a piece while it is merged."""
        known = self.edges.get((piece, side))
        if known is None:
            steps = remerged_steps(piece, self.model.scores)
            known = self.edges[piece, side] = list({parts[side] for parts in steps})
        return known

    def longest(self, text: str) -> dict[int, int]:
        """The longest piece that starts at each place, by its distance from the end of the text."""
        if not len(self.matches):
            return {}
        # Of the matches at a place the longest comes first, so it is put in last.
        return dict(reversed(list(self.matches.iter(text[::-1]))))

    def pieces(self, words: list[str]) -> Iterator[list[int]]:
        """The pieces of each word; none of them is empty.

        The words lie in one text, between marks that are in no piece, so the
        automaton runs once for all.
        """
        n_ids, lengths, shorter, pairs = self.n_ids, self.lengths, self.shorter, self.pairs
        text = self.mark.join(words)
        longest, top = self.longest(text), len(text) - 1
        given_up, stepped_back = bytearray(len(text) // 8 + 1), False
        at = 0
        for word in words:
            taken: list[int] = []
            stop, last = at + len(word), None
            piece = longest.get(top - at)
            if piece is None:
                # A character that no piece starts with stands for itself.
                piece = n_ids + ord(text[at])
            while True:
                end = at + (lengths[piece] if piece < n_ids else 1)
                if last is None:
                    fits = True
                else:
                    fits = pairs.get(last << 22 | piece)
                    if fits is None:
                        if len(pairs) >= REMEMBERED:
                            pairs.clear()
                        fits = pairs[last << 22 | piece] = self.go_together(last, piece)
                if fits and not (stepped_back and given_up[end >> 3] >> (end & 7) & 1):
                    taken.append(piece)
                    if end == stop:
                        break
                    at, last = end, piece
                    piece = longest.get(top - end)
                    if piece is None:
                        piece = n_ids + ord(text[end])
                    continue
                piece = shorter.get(piece)
                if piece is None:
                    stepped_back = True
                    given_up[at >> 3] |= 1 << (at & 7)
                    piece = taken.pop()
                    at -= lengths[piece] if piece < n_ids else 1
                    last = taken[-1] if taken else None
            at = stop + 1
            yield taken

    def _ids_of(self, taken: list[int]) -> bytes:
        n_ids, byte_ids = self.n_ids, self.model.byte_ids
        if max(taken) >= n_ids:
            spelled = ([i] if i < n_ids else [byte_ids[b] for b in chr(i - n_ids).encode()] for i in taken)
            taken = [i for one in spelled for i in one]
        return array("i", taken).tobytes()

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text, 32 bits each."""
        if not text:
            return np.empty(0, np.int32)
        marked = (SPACE if self.model.prefix else "") + text.replace(" ", SPACE)
        segments = self.segments.findall(marked)
        # Ids of words are kept as bytes, which are joined without looking into them.
        found = list(map(self.words.get, segments))
        if None in found:
            new = {w: self.older.get(w) for w, ids in zip(segments, found) if ids is None}
            unknown = [w for w, ids in new.items() if ids is None]
            new.update(zip(unknown, map(self._ids_of, self.pieces(unknown))))
            found = [new[w] if ids is None else ids for w, ids in zip(segments, found)]
            if len(self.words) + len(new) > REMEMBERED // 2:
                self.older, self.words = self.words, {}
            self.words.update((w, ids) for w, ids in new.items() if len(w) <= REMEMBERED_LENGTH)
        return np.frombuffer(b"".join(found), np.int32)


def _bytes_to_text(raw: bytes) -> str:
    """UTF-8; each byte that fits nowhere becomes one mark."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        pass
    out, i = [], 0
    while i < len(raw):
        for k in (1, 2, 3, 4):
            try:
                out.append(raw[i : i + k].decode())
            except UnicodeDecodeError:
                continue
            i += k
            break
        else:
            out.append(WRONG_BYTE)
            i += 1
    return "".join(out)


class Decoder:
    """Texts of ids, by tables."""

    def __init__(self, model: PieceModel):
        self.prefix, self.unknown = model.prefix, model.unknown
        self.bytes = np.zeros(len(model.texts), np.uint8)
        self.bytes[list(model.bytes_)] = list(model.bytes_.values())
        # An ASCII byte is a character wherever it stands; others count together.
        self.part = self.bytes >= 0x80
        self.is_byte = np.zeros(len(model.texts), bool)
        self.is_byte[list(model.bytes_)] = True
        spelled = [chr(model.bytes_[i]) if i in model.bytes_ else t for i, t in enumerate(model.texts)]
        self.texts = np.array(spelled, object)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ``ids``; an id outside the vocabulary raises IndexError."""
        if not len(ids):
            return ""
        if ids.min() < 0:
            raise IndexError(int(ids.min()))
        texts = self.texts[ids]
        part = self.part[ids]
        if part.any():
            edges = np.flatnonzero(np.diff(part, prepend=False, append=False))
            for start, end in edges.reshape(-1, 2).tolist():
                texts[start] = _bytes_to_text(self.bytes[ids[start:end]].tobytes())
                texts[start + 1 : end] = ""
        if self.prefix:
            # The mark put before the text is taken away again: from the first id that shows.
            first = next((k for k, t in enumerate(texts) if t), 0)
            if ids[first] != self.unknown and not self.is_byte[ids[first]]:
                texts[first] = texts[first].removeprefix(" ")
        return "".join(texts.tolist())


def _encoded(texts: pa.Array, model: PieceModel, decoded: bool) -> Iterator[list[pa.Array]]:
    """Id lists, and texts made of them, for as many texts at a time as give about ``BATCH_IDS``."""
    lists: list[np.ndarray] = []

    def handed_on() -> list[pa.Array]:
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
        values = np.concatenate([np.empty(0, np.int32), *lists])
        ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))
        return [ids, pa.array(map(model.decoder.decode, lists), pa.string())] if decoded else [ids]

    total = 0
    for text in texts:
        lists.append(model.encoder.encode(text.as_py() or ""))
        total += len(lists[-1])
        if total >= BATCH_IDS:
            yield handed_on()
            lists, total = [], 0
    yield handed_on()


def _texts_column(lists: pa.ListArray, decoder: Decoder) -> pa.Array:
    """The texts of a column of id lists; a null list has no ids."""
    ids = lists.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    return pa.array([decoder.decode(part) for part in np.split(ids, ends)[:-1]], pa.string())


def _with_columns(
    rows: DataFrame, model: PieceModel, source: str, out: dict[str, T.DataType], carry: list[str] | None, values
) -> DataFrame:
    """``rows`` with columns ``out``: ``values(column, model)`` yields them in parts, in order."""
    kept = [c for c in (rows.columns if carry is None else carry) if c not in out]
    # Columns go by their place, as Arrow functions take no names with dots.
    given = rows.select(*[named(c) for c in [*kept, source]]).toDF(*[f"c{i}" for i in range(len(kept) + 1)])
    places = [f"c{i}" for i in range(len(kept) + len(out))]
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for parts in values(batch.column(len(kept)), shared.value):
                others = [c.slice(at, len(parts[0])) for c in batch.columns[: len(kept)]]
                at += len(parts[0])
                yield pa.RecordBatch.from_arrays([*others, *parts], places)

    made = [T.StructField(c, kind) for c, kind in zip(places[len(kept) :], out.values())]
    return given.mapInArrow(run, T.StructType([*given.schema.fields[:-1], *made])).toDF(*kept, *out)


def encode(
    docs: DataFrame, model: PieceModel, text: str = "text", ids: str = "ids", carry: list[str] | None = None,
    decoded: str | None = None,
) -> DataFrame:
    """The columns ``carry`` (default: all) of every row, with the ids of its text.

    With ``decoded`` that column holds the text decoded from the ids again, in the
    same pass.  A null or empty text has no ids; texts are encoded whole, however
    long; equal rows get equal ids; an empty table stays empty.  Columns named like
    the new ones are replaced.
    """
    out: dict[str, T.DataType] = {ids: T.ArrayType(T.IntegerType())}
    if decoded is not None:
        out[decoded] = T.StringType()
    return _with_columns(docs, model, text, out, carry, lambda c, m: _encoded(c, m, decoded is not None))


def decode(
    rows: DataFrame, model: PieceModel, ids: str = "ids", text: str = "text", carry: list[str] | None = None
) -> DataFrame:
    """The columns ``carry`` (default: all) of every row, with the text of its ids.

    Null ids give an empty text.  A column named like the new one is replaced.
    """
    values = lambda lists, m: [[_texts_column(lists, m.decoder)]]
    return _with_columns(rows, model, ids, {text: T.StringType()}, carry, values)
