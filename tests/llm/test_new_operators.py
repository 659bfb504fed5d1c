"""Conversation trie, filter audit and piece codec against brute force, and on awkward rows."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from pingzones.llm import audit, catalog, pieces, prefixes

# --- conversation trie --------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, depth string, `a.b` int"


def trie_by_hand(rows):
    """Nodes as tuples, each conversation walked turn by turn."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))

    def in_order(c):
        def key(t):
            given = f"{len(t[2].encode())}:{t[2]}{t[3]}".encode()
            return t[0], t[1], hashlib.md5(given).digest()

        return [t[2:] for t in sorted(own.get(c, []), key=key)]

    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = int(c / 5) * 5
        whole[c] = tuple(in_order(base)[:h] + in_order(c)[h:])
    members = defaultdict(list)
    for c, q in whole.items():
        for d in range(len(q) + 1):
            members[q[:d]].append(c)
    out = []
    for node, of in members.items():
        below = [n for n in members if n[: len(node)] == node]
        leaves = [n for n in below if not any(len(m) == len(n) + 1 and m[:-1] == n for m in below)]
        ends = ",".join(str(c) for c in sorted(c for c in of if len(whole[c]) == len(node)))
        saved = sum((len(members[n]) - 1) * (len(n[-1][1].encode()) if n else 0) for n in below)
        children = [n for n in below if len(n) == len(node) + 1]
        parent = min(members[node[:-1]]) if node else None
        out.append(
            (min(of), len(node), parent, len(of), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest())
        )
    return Counter(out)


def trie(df):
    columns = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    return Counter(map(tuple, df.select(*columns).collect()))


def _conversations(seed, n):
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(-20, 60), n):
        length = rnd.choice([1, 2, 3, 5, 9, 14])
        rows += [(c, t, rnd.choice(["user", None, ""]), rnd.choice(["a", "é", "", None])) for t in range(length)]
    return rows


@pytest.mark.parametrize(("seed", "block"), [(1, 4096), (2, 3), (3, 1)])
def test_trie_of_random_conversations(spark, monkeypatch, seed, block):
    monkeypatch.setattr(prefixes, "BLOCK", block)
    rows = _conversations(seed, 40)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS).repartition(5)
    assert trie(prefixes.conversation_trie(df)) == trie_by_hand(rows)


def test_trie_of_awkward_conversations(spark):
    rows = [
        (None, 0, "user", "nobody"), (1, None, "user", "b"), (1, None, None, None), (1, 2, "user", "ü" * 70_000),
        (1, 2, "user", "ü" * 70_000), (5, 0, "user", "same"), (10, 0, "user", "same"), (15, 0, "user", "same"),
        (15, 1, "user", "more"), (6, 0, "system", None), (-7, 3, "", ""), (-5, 0, "ab", "c"), (0, 0, "a", "bc"),
    ]
    rows += [(20, t, "user", f"t{t % 3}") for t in range(500)] + [(21, t, "user", f"t{t % 3}") for t in range(300)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS).repartition(3)
    assert trie(prefixes.conversation_trie(df)) == trie_by_hand(rows)
    assert prefixes.conversation_trie(df.limit(0)).collect() == []


def test_trie_holds_turnless_conversations(spark):
    """13's own turn lies within what it would share, and there is no conversation 10."""
    shared = zlib.crc32(b"13") % 9
    assert shared > 0
    rows = [(13, 0, "user", "hidden")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS)
    assert trie(prefixes.conversation_trie(df)) == trie_by_hand(rows)
    only = prefixes.conversation_trie(df).first()
    assert (only["depth"], only["n_convs"], only["n_leaves"], only["parent_conv_id"]) == (0, 1, 1, None)
    assert only["ends_sha256"] == hashlib.sha256(b"13").hexdigest()


def test_rebuilt_turns_say_where_they_come_from(spark):
    rows = [(c, t, "user", f"{c}-{t}") for c in (10, 12) for t in range(12)]
    turns = prefixes.turns_in_order(spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS))
    built, sizes = prefixes.rebuilt(turns)
    shared = zlib.crc32(b"12") % 9
    of_12 = built.filter("conv_id = 12").orderBy("depth").select("source", "place").collect()
    wanted = [(10, p) for p in range(1, shared + 1)] + [(12, p) for p in range(shared + 1, 13)]
    assert [tuple(r) for r in of_12] == wanted
    assert {tuple(r) for r in sizes.collect()} == {(10, 12), (12, 12)}


# --- filter audit -------------------------------------------------------------


def test_path_counts():
    forward, backward = audit.forward_counts(5), audit.backward_counts(5)
    assert forward[-1] == backward[0] == 120
    edges = audit.lattice_edges(5)
    assert len(edges) == 80
    # Every order takes one edge of each filter.
    assert all(sum(w for _, b, w in edges if b == 1 << f) == 120 for f in range(5))
    steps = audit.order_steps("ABC")
    assert [s[0] for s in steps[::3]] == ["".join(p) for p in permutations("ABC")]


def audit_by_hand(docs, labels):
    """Each order applied to each document, one filter after the other."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    texts = defaultdict(set)
    for d, text, _ in docs:
        if d is not None:
            texts[text or ""].add(d)
    per_part = defaultdict(list)
    for d, text, source in docs:
        t = text or ""
        words = [w for w in _split(t)]
        fails = set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * sum("A" <= ch <= "Z" for ch in t) > 2 * len(t):
            fails.add("C")
        if any(ch in "#$%&*|" for ch in t):
            fails.add("D")
        if d is not None and any(other < d for other in texts[t]):
            fails.add("E")
        per_part[source or ""].append((fails, d in good, d in toxic))
    out, shapley = [], Counter()
    for part, rows in per_part.items():
        for order in permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                redundant = sum(f in r[0] for r in rows) - len(gone)
                unique = sum(r[0] == {f} for r in rows)
                shapley[part, f] += len(gone)
                out.append(
                    [part, "".join(order), step, len(left), len(gone), redundant, unique, sum(r[1] for r in gone), sum(r[2] for r in gone)]
                )
    return Counter((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def _split(text):
    word = ""
    for ch in text:
        if ch in " \t\n\x0b\x0c\r":
            if word:
                yield word
            word = ""
        else:
            word += ch
    if word:
        yield word


AUDITED = "doc_id long, text string, source string, part int, failed string, `a.b` int"
LABELS = "doc_id long, quality int, toxic int"


def test_audit_of_awkward_rows(spark):
    many = " ".join(f"w{i}" for i in range(220))
    docs = [
        (1, None, "a"), (2, "", "a"), (3, " \t\n", None), (4, many, "a"), (5, many, "a"), (5, many, "b"), (4, many, ""),
        (None, many, "a"), (None, None, None), (6, "Ab " * 300, "a"), (7, "x#y " * 150 + many, "c"), (8, "É\xa0é\x0b" * 9, "c"),
        (9, "long " * 40_000, "b"), (10, "long " * 40_000, "b"), (-3, "x", "b"), (11, many + " A" * 30, "c"),
    ]
    labels = [(4, 1, 0), (5, 0, 1), (5, 1, None), (9, None, 1), (None, 1, 1), (77, 1, 1), (11, 1, 1)]
    df = spark.createDataFrame([(*d, 1, "x", 2) for d in docs], AUDITED).repartition(3)
    known = spark.createDataFrame(labels, LABELS)
    got = audit.audit(df, known)
    assert Counter(map(tuple, got.collect())) == audit_by_hand(docs, labels)
    assert got.filter("part = 'c'").count() == 600
    assert audit.audit(df.limit(0), known).collect() == []
    assert audit.audit(df, known.limit(0)).agg(F.sum("good_lost")).first()[0] == 0


def test_audit_of_other_filters(spark):
    """Two filters of the caller's, no copies."""
    df = spark.createDataFrame([(1, "a b", "s"), (2, "a", "s"), (3, "b", "s")], "doc_id long, text string, source string")
    has = lambda text, words: {"x": text.contains("a"), "y": text.contains("b")}
    rows = audit.audit(df, spark.createDataFrame([], LABELS), copies=None, filters=has).collect()
    got = {(r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["shapley"]) for r in rows}
    assert got == {("xy", 1): (1, 2, 0, 3), ("xy", 2): (0, 1, 1, 3), ("yx", 1): (1, 2, 0, 3), ("yx", 2): (0, 1, 1, 3)}


# --- piece codec --------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=catalog.piece_model_path())


@pytest.fixture(scope="module")
def model():
    return pieces.load_model(catalog.piece_model_path())


def _texts():
    rnd = random.Random(5)
    kinds = ["abcdeinthrs ", "  ▁ab", "日本語中 aé\U0001f600\n", "the and ing er ", "\t\n\r \x00\x7f", "a", "ҢәңŁß́e"]
    out = ["", " ", "▁", " ▁ ", "<s></s><unk><0x41>", "�﻿", "é", "a" * 5000, " " * 1000 + "x", "ab" * 9999, "\n" * 99]
    for _ in range(1500):
        kind = rnd.choice(kinds)
        out.append("".join(rnd.choice(kind) for _ in range(rnd.randint(0, 50))))
    return out


def test_encoder_equals_the_library(library, model):
    encoder = pieces.Encoder(model)
    for text in _texts():
        wanted = library.encode(text)
        assert encoder.encode(text).tolist() == wanted, text[:80]
        assert model.decoder.decode(np.array(wanted, int)) == library.decode(wanted), text[:80]


def test_decoder_equals_the_library_on_any_ids(library, model):
    rnd = random.Random(6)
    some = [0, 1, 2, 259, 28705]
    for _ in range(5000):
        ids = [rnd.choice([rnd.randrange(32_000), rnd.randrange(262), rnd.choice(some)]) for _ in range(rnd.randint(0, 8))]
        assert model.decoder.decode(np.array(ids, int)) == library.decode(ids), ids
    for wrong in (-1, 32_000):
        with pytest.raises(IndexError):
            model.decoder.decode(np.array([5, wrong]))


def test_encoder_steps_back():
    """Greedy pieces that do not go together: 'abc' is longest, but merging gives 'ab', 'cd'."""
    scores = {p: -float(i) for i, p in enumerate(["ab", "cd", "bc", "abc"])}
    alphabet = {c: -9.0 for c in "abcd"}
    scores |= alphabet
    assert pieces.remerged("abcd", scores) == ["ab", "cd"]
    whole = {p for p in scores if pieces.remerged(p, scores) == [p]}
    shorter = {p: next((p[:k] for k in range(len(p) - 1, 1, -1) if p[:k] in whole), p[0]) if len(p) > 1 else None for p in whole}
    names = sorted(scores)
    made = pieces.PieceModel(
        scores, {p: i for i, p in enumerate(names)}, shorter, names, {}, list(range(256)), -1, False, True
    )
    rnd = random.Random(7)
    encoder = pieces.Encoder(made)
    for _ in range(2000):
        text = "".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 12)))
        assert [names[i] for i in encoder.encode(text)] == pieces.remerged(text, scores)


def test_forgetting_changes_nothing(library, model, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 2)
    encoder = pieces.Encoder(model)
    for text in _texts()[:200]:
        assert encoder.encode(text).tolist() == library.encode(text)


def test_codec_on_awkward_rows(spark, library, model, monkeypatch):
    monkeypatch.setattr(pieces, "BATCH_IDS", 50)
    rows = [(i, t, "x", [9], i) for i, t in enumerate([None, "", " ", "a b", "a b", "long " * 20_000, "é\U0001f600", None])]
    df = spark.createDataFrame(rows, "doc_id long, text string, decoded string, ids array<int>, `a.b` int").repartition(2)
    encoded = pieces.encode(df, model)
    assert encoded.columns == ["doc_id", "text", "decoded", "a.b", "ids"]
    back = pieces.decode(encoded, model, text="decoded").collect()
    assert len(back) == len(rows)
    for r in back:
        assert r["ids"] == library.encode(r["text"] or "") and r["decoded"] == library.decode(r["ids"])
    at_once = pieces.encode(df, model, ids="a.b", carry=["doc_id"], decoded="text")
    assert at_once.columns == ["doc_id", "a.b", "text"]
    again = pieces.decode(encoded, model, text="decoded").select("doc_id", F.col("ids").alias("a.b"), F.col("decoded").alias("text"))
    assert sorted(map(tuple, at_once.collect())) == sorted(map(tuple, again.collect()))
    assert pieces.encode(df.limit(0), model).collect() == []
    nothing = spark.createDataFrame([(None,)], "ids array<int>")
    assert pieces.decode(nothing, model).first()["text"] == ""


def test_codec_whole_table(spark, tiny, library):
    texts = {r["doc_id"]: r["text"] or "" for r in catalog.table(spark, tiny, "documents").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in catalog.op13_piece_codec(spark, tiny).collect():
        ids = library.encode(texts.pop(r["doc_id"]))
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == sha(",".join(map(str, ids)))
        assert r["decoded_sha256"] == sha(library.decode(ids))
    assert not texts


def test_other_vocabularies_are_refused(tmp_path, model):
    from sentencepiece import sentencepiece_model_pb2 as format_

    proto = format_.ModelProto()
    proto.trainer_spec.model_type = 1
    (tmp_path / "other.model").write_bytes(proto.SerializeToString())
    with pytest.raises(ValueError, match="merge-type"):
        pieces.load_model(str(tmp_path / "other.model"))
