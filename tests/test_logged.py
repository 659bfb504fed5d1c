"""The target with a log: failed cycles, overlapping ones, marks, replacing, stream batches."""

from __future__ import annotations

import json
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pingzones.catalog import derived
from pingzones.functions.parsing import ntz
from pingzones.operators.shared_folder import create_text, read_text
from pingzones.plans.cycle import run_cycle
from pingzones.plans.transform import label_pings
from pingzones.schema import OUTPUT_SCHEMA
from pingzones.sinks import logged
from pingzones.sinks.logged import LoggedTarget
from pingzones.sinks.targets import Conflict, latest_time
from pingzones.sources.pings import empty_pings, stream_pages, write_pages
from pingzones.streaming.cycle import BatchReport, start_stream

MIDDLE = datetime(2024, 1, 15)


@pytest.fixture(scope="module")
def pings(spark, tiny):
    return derived.pings(spark, tiny)


@pytest.fixture(scope="module")
def index(spark):
    return derived.sample_index(spark)


@pytest.fixture
def target(spark, tmp_path):
    return LoggedTarget(spark, str(tmp_path / "target"))


def rows(df):
    return sorted(map(str, df.collect()))


def jobs_of(spark, call):
    """Result of a call and the number of Spark jobs it started."""
    sc = spark.sparkContext
    sc.setJobGroup("counted", "")
    try:
        return call(), len(sc.statusTracker().getJobIdsForGroup("counted"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_a_name_is_given_once(spark, tmp_path):
    path = str(tmp_path / "log" / "1.json")
    assert create_text(spark, path, "é") and not create_text(spark, path, "b")
    assert read_text(spark, path) == "é" and [f.name for f in (tmp_path / "log").iterdir() if ".crc" not in f.name] == ["1.json"]


def test_cycles_make_one_load(spark, target, pings, index):
    early = pings.filter(F.col("timestamp") < ntz(MIDDLE))
    reports = [run_cycle(df, target, index) for df in (early, pings, pings, empty_pings(spark))]
    n, total = early.count(), pings.count()
    assert [(r.extracted, r.loaded, r.conflict) for r in reports] == [
        (n, n, False), (total - n, total - n, False), (0, 0, False), (0, 0, False),
    ]
    assert rows(target.read()) == rows(label_pings(pings, index))
    assert target.state().version == 2


def test_nothing_is_seen_of_a_cycle_that_dies_between_tasks(spark, target, pings, index):
    """Some tasks end, one fails: the mark stays, and the next cycle loads exactly the rest."""
    early = pings.filter(F.col("timestamp") < ntz(MIDDLE))
    run_cycle(early, target, index)
    mark = target.high_water_mark()
    # The last of eight tasks fails while the others have written their files.
    newest = F.col("id") == pings.orderBy(F.desc("timestamp")).first()["id"]
    killed = pings.repartition(8, "timestamp").withColumn(
        "speed", F.when(newest, F.raise_error(F.lit("killed")).cast("double")).otherwise(F.col("speed"))
    )
    with pytest.raises(Exception, match="killed"):
        run_cycle(killed, target, index)
    assert target.high_water_mark() == mark and target.read().count() == early.count()
    assert run_cycle(pings, target, index).loaded == pings.count() - early.count()
    assert rows(target.read()) == rows(label_pings(pings, index))


def test_nothing_is_seen_of_a_cycle_that_dies_before_its_entry(spark, target, pings, index, monkeypatch):
    def die(*_, **__):
        raise KeyboardInterrupt

    monkeypatch.setattr(LoggedTarget, "_add", die)
    with pytest.raises(KeyboardInterrupt):
        run_cycle(pings, target, index)
    monkeypatch.undo()
    assert target.high_water_mark() is None and target.read().count() == 0
    left = list(Path(target.path, "data").iterdir())
    assert len(left) == 1
    assert run_cycle(pings, target, index).loaded == pings.count()
    assert target.tidy() == [f"{target.path}/data/{left[0].name}"]
    assert rows(target.read()) == rows(label_pings(pings, index))


def test_of_two_overlapping_cycles_one_appends(spark, target, pings, index, monkeypatch):
    early = pings.filter(F.col("timestamp") < ntz(MIDDLE))
    run_cycle(early, target, index)
    staged = LoggedTarget.staged
    inner = []

    def meanwhile(self, *args):
        """Another whole cycle runs while the first one writes its files."""
        if not inner:
            inner.append(None)
            inner[0] = run_cycle(pings, LoggedTarget(spark, target.path), index)
        return staged(self, *args)

    monkeypatch.setattr(LoggedTarget, "staged", meanwhile)
    outer = run_cycle(pings, target, index)
    rest = pings.count() - early.count()
    assert (inner[0].loaded, inner[0].conflict) == (rest, False)
    assert (outer.extracted, outer.loaded, outer.conflict) == (rest, 0, True)
    assert inner[0].mark == outer.mark
    assert rows(target.read()) == rows(label_pings(pings, index))
    assert target.tidy() == []


def test_mark_is_read_from_the_log_alone(spark, target, pings, index):
    labelled = label_pings(pings, index)
    target.append(labelled.filter(F.col("fecha_hora") >= ntz(MIDDLE)))
    target.append(labelled.filter(F.col("fecha_hora") < ntz(MIDDLE)))
    target.append(labelled.filter("fecha_hora IS NULL"))
    mark, jobs = jobs_of(spark, target.high_water_mark)
    assert jobs == 0 and mark == latest_time(labelled).first()["max_ts"]
    first = target.state().batches[1]
    assert first.rows == labelled.filter(F.col("fecha_hora") < ntz(MIDDLE)).count()


def test_mark_without_figures(spark, target, pings, index, tmp_path):
    """Files that came without figures are looked into."""
    labelled = label_pings(pings, index)
    target.append(labelled.filter(F.col("fecha_hora") < ntz(MIDDLE)))
    labelled.filter(F.col("fecha_hora") >= ntz(MIDDLE)).write.parquet(str(tmp_path / "old"))
    target.adopt(str(tmp_path / "old"))
    mark, jobs = jobs_of(spark, target.high_water_mark)
    assert jobs > 0 and mark == latest_time(labelled).first()["max_ts"]
    assert rows(target.read()) == rows(labelled)


def test_times_without_a_fraction_and_far_off(spark, target):
    values = ", ".join(["NULL"] * 13)
    for text in ("1582-10-15 00:00:00", "2024-01-01 10:00:00.000001", "9999-12-31 23:59:59.999999"):
        target.append(spark.sql(f"SELECT {values}, TIMESTAMP_NTZ'{text}'").toDF(*OUTPUT_SCHEMA.names).to(OUTPUT_SCHEMA))
        assert target.high_water_mark() == datetime.fromisoformat(text)


def test_replace_leaves_the_old_rows_if_it_fails(spark, target, pings, index):
    labelled = label_pings(pings, index)
    target.append(labelled)
    broken = labelled.withColumn("zona", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        target.replace(broken)
    assert rows(target.read()) == rows(labelled)
    # The new rows may be made from the old ones.
    target.replace(target.read().filter("zona = 'Norte'"))
    assert rows(target.read()) == rows(labelled.filter("zona = 'Norte'"))
    assert len(target.tidy()) == 2
    target.replace(labelled.limit(0))
    assert target.read().count() == 0 and target.high_water_mark() is None and target.exists()


def test_replace_and_append_at_once(spark, target, pings, index, monkeypatch):
    labelled = label_pings(pings, index).limit(10)
    target.append(labelled)
    staged = LoggedTarget.staged

    def meanwhile(self, df, *args):
        monkeypatch.setattr(LoggedTarget, "staged", staged)
        LoggedTarget(spark, target.path).append(labelled)
        return staged(self, df, *args)

    monkeypatch.setattr(LoggedTarget, "staged", meanwhile)
    with pytest.raises(Conflict):
        target.replace(labelled.limit(1))
    assert target.read().count() == 20
    # An append that depends on nothing goes in behind the other one.
    monkeypatch.setattr(LoggedTarget, "staged", meanwhile)
    target.append(labelled)
    assert target.read().count() == 40


def test_long_log(spark, target, monkeypatch):
    monkeypatch.setattr(logged, "ENTRIES_PER_LIST", 3)
    time = F.lit("2024-01-01").cast("timestamp_ntz")
    for i in range(8):
        row = spark.range(1).select(F.lit(i).alias("id"), time.alias("fecha_hora"))
        target.append(row.select(*[F.lit(None).cast(f.dataType).alias(f.name) if f.name not in row.columns else f.name for f in OUTPUT_SCHEMA]))
    names = sorted(p.name for p in Path(target.path, "_log").iterdir() if p.suffix == ".list")
    assert names == ["000000000003.list", "000000000006.list"]
    # Entries before the last list are not needed any more.
    for i in range(1, 7):
        Path(target.path, "_log", f"{i:012}.json").unlink()
    assert target.state().version == 8 and sorted(r["id"] for r in target.read().collect()) == list(range(8))
    assert json.loads(read_text(spark, f"{target.path}/_log/000000000006.list"))["version"] == 6


def test_stream_batch_runs_twice(spark, target, tmp_path, pings, index):
    """The rows and the entry of a batch are there, its commit is lost: it is passed over."""
    pages, state = str(tmp_path / "pages"), tmp_path / "state"
    copied = pings.unionByName(pings.filter("battery IS NULL"))
    write_pages(copied, pages)
    reports = []
    for _ in range(2):
        stream = stream_pages(spark, pages, multi_line=False)
        start_stream(stream, target, index, str(state), reports=reports).awaitTermination()
        for name in ("commits/0", "commits/.0.crc"):
            (state / name).unlink(missing_ok=True)
    assert rows(target.read()) == rows(label_pings(copied, index))
    assert reports == [BatchReport(0, copied.count(), copied.count())]


def test_stream_reports_its_batches(spark, target, tmp_path, pings, index):
    pages, reports = str(tmp_path / "pages"), []
    early = F.col("timestamp") < ntz(MIDDLE)
    for step, some in enumerate([pings.filter(early), pings.filter(~early)]):
        write_pages(some, f"{pages}/step={step}")
        stream = stream_pages(spark, f"{pages}/*", multi_line=False)
        start_stream(stream, target, index, str(tmp_path / "state"), reports=reports).awaitTermination()
    n = pings.filter(early).count()
    assert [(r.extracted, r.loaded) for r in reports] == [(n, n), (pings.count() - n, pings.count() - n)]
    assert [b.rows for b in target.state().batches] == [r.loaded for r in reports]


def test_stream_with_lookback_equals_the_batch(spark, tmp_path, pings, index):
    """Pings come again and late: those within the lookback are loaded once, later ones dropped."""
    lookback = timedelta(days=3)
    seen = pings.filter((F.col("timestamp") < ntz(MIDDLE)) & (F.col("network_type") != "3G"))
    untimed = pings.limit(3).withColumn("timestamp", F.lit(None).cast("timestamp_ntz"))
    batch, stream = (LoggedTarget(spark, str(tmp_path / name)) for name in ("batch", "stream"))
    pages = str(tmp_path / "pages")
    for step, version in enumerate([seen.unionByName(untimed), pings.unionByName(untimed), pings]):
        run_cycle(version, batch, index, lookback=lookback)
        write_pages(version, f"{pages}/step={step}")
        landed = stream_pages(spark, f"{pages}/*", multi_line=False)
        start_stream(landed, stream, index, str(tmp_path / "state"), lookback=lookback).awaitTermination()
    assert rows(stream.read()) == rows(batch.read())
    assert seen.count() < batch.read().count() < pings.count()
