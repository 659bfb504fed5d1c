"""Load cycles, the stream, and the plans they run."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from checking import plan_text
from pingzones.catalog import derived
from pingzones.plans.cycle import run_cycle
from pingzones.plans.transform import fill_labels, label_pings
from pingzones.schema import OUTPUT_SCHEMA, PASS_THROUGH
from pingzones.sinks.targets import PathTarget
from pingzones.sources.pings import empty_pings, read_pages, stream_pages, write_pages
from pingzones.streaming.cycle import start_stream

MIDDLE = datetime(2024, 1, 15)


@pytest.fixture(scope="module")
def pings(spark, tiny):
    return derived.pings(spark, tiny)


@pytest.fixture(scope="module")
def index(spark):
    return derived.sample_index(spark)


def rows(df):
    return sorted(map(str, df.collect()))


def target(spark, tmp_path, name="target"):
    return PathTarget(spark, str(tmp_path / name))


def test_output_schema(pings, index):
    out = label_pings(pings, index).schema
    assert [(f.name, f.dataType) for f in out] == [(f.name, f.dataType) for f in OUTPUT_SCHEMA]


def test_fill_labels(spark):
    df = spark.createDataFrame([(1, None, None), (2, "Sur", "TIGO")], "id int, zona string, compania string")
    assert [tuple(r) for r in fill_labels(df).orderBy("id").collect()] == [
        (1, "Desconocida", "Desconocida"),
        (2, "Sur", "TIGO"),
    ]


def test_cycles_make_one_load(spark, tmp_path, pings, index):
    t = target(spark, tmp_path)
    early = pings.filter(F.col("timestamp") < F.lit(MIDDLE).cast("timestamp_ntz"))
    reports = [run_cycle(df, t, index) for df in (early, pings, pings)]
    n, total = early.count(), pings.count()
    assert [(r.extracted, r.loaded) for r in reports] == [(n, n), (total - n, total - n), (0, 0)]
    assert reports[0].mark is None and reports[1].mark < MIDDLE <= reports[2].mark
    assert rows(t.read()) == rows(label_pings(pings, index))


def test_nothing_to_load(spark, tmp_path, index):
    t = target(spark, tmp_path)
    assert run_cycle(empty_pings(spark), t, index).loaded == 0
    assert not t.exists()


def test_lookback_completes_a_partial_append(spark, tmp_path, pings, index):
    """Some rows are missing below the mark; they come once, with their copies, and only they."""
    copied = pings.unionByName(pings.filter("battery IS NULL"))
    part = copied.filter("speed > 10")
    newest = copied.orderBy(F.col("timestamp").desc()).limit(1)
    t = target(spark, tmp_path)
    t.append(label_pings(part.unionByName(newest).distinct(), index))
    loaded_before = t.read().count()
    report = run_cycle(copied, t, index, lookback=timedelta(days=60))
    keys = list(PASS_THROUGH)
    assert rows(t.read().select(keys).distinct()) == rows(label_pings(pings, index).select(keys).distinct())
    missing = label_pings(copied, index).join(
        t.read().select("id").distinct(), "id", "left_anti"
    )
    assert missing.count() == 0 and report.loaded > 0
    assert t.read().count() == loaded_before + report.loaded
    assert run_cycle(copied, t, index, lookback=timedelta(days=60)).loaded == 0


def test_stream_equals_batch(spark, tmp_path, pings, index):
    pages, t = str(tmp_path / "pages"), target(spark, tmp_path)
    write_pages(pings.repartition(5), pages)
    for _ in range(2):  # the second run finds nothing new
        stream = stream_pages(spark, pages, multi_line=False, max_files_per_trigger=2)
        start_stream(stream, t, index, str(tmp_path / "state")).awaitTermination()
    batch = label_pings(read_pages(spark, pages, multi_line=False), index)
    assert rows(t.read()) == rows(batch) == rows(label_pings(pings, index))


@pytest.mark.parametrize("lost", ["commit", "commit and mark"])
def test_stream_repeats_a_batch_without_doubling(spark, tmp_path, pings, index, lost):
    """A batch whose rows landed but whose commit was lost runs again; copies stay."""
    pages, state, t = str(tmp_path / "pages"), tmp_path / "state", target(spark, tmp_path)
    copied = pings.unionByName(pings.filter("battery IS NULL"))
    write_pages(copied, pages)
    for _ in range(2):
        stream = stream_pages(spark, pages, multi_line=False)
        start_stream(stream, t, index, str(state)).awaitTermination()
        gone = ["commits/0", "commits/.0.crc"] + ["appended/0.ended"] * (lost != "commit")
        for name in gone:
            (state / name).unlink(missing_ok=True)
    assert rows(t.read()) == rows(label_pings(copied, index))


def test_stream_keeps_copies_of_earlier_batches(spark, tmp_path, pings, index):
    pages, t = str(tmp_path / "pages"), target(spark, tmp_path)
    for step in range(2):  # the same pings land twice, with a restart between
        write_pages(pings, f"{pages}/step={step}")
        stream = stream_pages(spark, f"{pages}/*", multi_line=False)
        start_stream(stream, t, index, str(tmp_path / "state")).awaitTermination()
    assert rows(t.read()) == rows(label_pings(pings.unionByName(pings), index))


def test_lookback_tells_operators_and_null_ids_apart(spark, tmp_path, pings, index):
    some = pings.limit(50).cache()
    twins = some.withColumn("sim_operator", F.lit("other")).withColumn("id", F.lit(None).cast("int"))
    both = some.withColumn("id", F.lit(None).cast("int")).unionByName(twins).unionByName(twins.limit(5))
    late = [some.withColumn("id", F.lit(None).cast("int")), both]
    t = target(spark, tmp_path)
    for version in late:
        run_cycle(version, t, index, lookback=timedelta(days=400))
    timed = both.filter("timestamp is not null")
    assert t.read().filter("fecha_hora is not null").count() == timed.count()


def test_label_plan(pings, index):
    """Pings are neither shuffled nor sent to Python nor compared with every zone."""
    text = plan_text(label_pings(pings, index))
    above_index = text.split("InMemoryTableScan")[0]
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in above_index
    for unwanted in ("BatchEvalPython", "ArrowEvalPython", "BroadcastNestedLoopJoin", "CartesianProduct"):
        assert unwanted not in text


def test_label_plan_prunes_columns(pings, index):
    text = plan_text(label_pings(pings, index).select("zona"))
    assert "user_id" not in text and "props" not in text


def test_large_index_is_not_broadcast(pings, index):
    text = plan_text(label_pings(pings, index, broadcast_limit=0))
    assert "ShuffledHashJoin" in text and "BroadcastNestedLoopJoin" not in text
