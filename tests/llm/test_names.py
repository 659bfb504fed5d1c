"""Documents with awkward rows and clashing column names, through every operator on whole rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pingzones.llm import decontaminate, language, mixing, sharding, simhash

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, `a.b` string, _unit string, _check long,"
    " c0 string, c1 int, _row string, size string, `with ``tick` int, tags map<string,int>"
)
PASSAGE = "the quick brown fox jumps over the lazy dog while seven wizards brew strange potions in a quiet tower tonight"


def _row(k, doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None, f"ab{k}", f"unit{k}", k, f"zero{k}", k, f"row{k}", f"size{k}", k, {"k": k})


ROWS = [
    _row(0, 1, None), _row(1, 2, ""), _row(2, 3, " \t\n"), _row(3, 4, "12 34 !!"),
    _row(4, 5, "Hello world this is a small english text about the house"),
    _row(4, 5, "Hello world this is a small english text about the house"),
    _row(5, 6, "el perro y la casa son de los hombres que viven aquí", "es", "b"),
    _row(6, 7, "el perro y la casa son de los hombres que viven aquí", "es", None),
    _row(7, None, "nobody knows the id of this english document", None, "b"), _row(8, None, None, None, None),
    _row(9, 8, "long " * 30_000 + PASSAGE), _row(10, 9, PASSAGE.upper() + " and some more words that follow", None, "c"),
    _row(11, 10, "the house and the dog of the english world are in a small text", "en", "c"),
]
ITEMS = [(1, PASSAGE), (2, None), (None, "")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def _values(rows):
    return sorted((repr(tuple(r)) for r in rows))


def _kept(out, docs):
    """Every row of ``out`` is a row of ``docs``, column by column."""
    assert out.columns == docs.columns
    given, got = _values(docs.collect()), _values(out.collect())
    assert set(got) <= set(given)
    return got


def test_language_keeps_the_columns(docs):
    kept = _kept(language.in_known_language(docs), docs)
    assert not any("12 34" in r or "text=None" in r for r in kept)


def test_near_duplicates_keep_the_columns(docs):
    kept = _kept(simhash.one_of_each_group(docs), docs)
    assert len(kept) == len(set(kept)) and sum("el perro" in r for r in kept) == 1


def test_decontamination_keeps_the_columns(docs, items):
    kept = _kept(decontaminate.clean_documents(docs, items), docs)
    assert len(kept) == len(ROWS) - 2 and not any("wizards" in r.lower() for r in kept)


def test_mixing_keeps_the_columns(docs):
    got = _kept(mixing.mixed_documents(docs), docs)
    taken = mixing.mix(docs).agg(F.sum("copies")).first()[0]
    assert len(got) == taken


def test_sharding_keeps_the_columns(docs):
    out = sharding.contiguous_shards(docs, 4)
    others = [c for c in docs.columns if c != "size"]
    assert out.columns == [*others, "size", "shard", "slot"]
    pick = [F.col(f"`{c.replace('`', '``')}`") for c in others]
    assert _values(out.select(*pick).collect()) == _values(docs.select(*pick).collect())


def test_stages_on_awkward_rows(spark, docs, items, tmp_path):
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    for given in (docs, docs.limit(0)):
        docs_ = given
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs_, str(tmp_path))
            _kept(out, docs_)
            docs_ = corpus_pipeline.stored(out, "test-awkward")
        last = corpus_pipeline.STAGES[-1][1](spark, docs_, str(tmp_path))
        assert last.count() == docs_.count()
    assert last.count() == 0


def test_identity_has_128_bits(spark, docs):
    from pingzones.llm.common import identity

    pairs = docs.select(*identity(docs).values()).distinct().collect()
    assert len(pairs) == len({r[0] for r in pairs}) == len({r[1] for r in pairs}) == len(set(map(repr, ROWS)))


def test_more_words_than_the_model_holds(spark, monkeypatch):
    """Words of one count: those first by name are taken, as many as there is room for."""
    monkeypatch.setattr(language, "MAX_WORDS", 5)
    monkeypatch.setattr(language, "MAX_GRAMS", 7)
    words = [f"{a}{b}" for a in "abcdefgh" for b in "uvwxyz"]
    rows = [(4 * k, " ".join(words), "en" if k % 2 else "es") for k in range(4)] + [(1, "zz zz zz zz zz zz", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(df)
    assert sorted(model.words) == sorted(["zz", *sorted(words)[:4]]) or sorted(model.words) == sorted(words)[:5]
    assert len(model.words) == 5 and len(model.grams) == 7
