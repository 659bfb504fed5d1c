"""Paging, numbering, sources and targets."""

from __future__ import annotations

from datetime import datetime, timedelta
from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F

from pingzones.catalog import derived
from pingzones.operators import numbering, paging
from pingzones.operators.shared_folder import new_folder, shared_folder
from pingzones.schema import OUTPUT_SCHEMA, PING_COLUMNS, PING_SCHEMA
from pingzones.sinks import targets
from pingzones.sources import pings as source
from checking import plan_text

T0 = datetime(2024, 1, 1)


def timed(spark, rows):
    """Pings with only id and timestamp set."""
    df = spark.createDataFrame(rows, "id int, timestamp timestamp_ntz")
    return df.select(
        *[
            F.col(f.name) if f.name in ("id", "timestamp") else F.lit(None).cast(f.dataType).alias(f.name)
            for f in PING_SCHEMA
        ]
    )


def keys(df):
    return [(r["timestamp"], r["id"]) for r in df.collect()]


def in_order(pairs):
    return sorted(pairs, key=lambda p: (p[0] is None, p[0] or T0, p[1] is None, p[1] or 0))


@pytest.fixture(scope="module")
def tied(spark):
    """Few distinct times, one of them very common, and missing times and ids."""
    rows = [(i, T0 + timedelta(hours=i % 7)) for i in range(300)]
    rows += [(1000 + i, T0 + timedelta(hours=3)) for i in range(400)]
    rows += [(2000 + i, None) for i in range(60)] + [(None, T0), (None, None)]
    df = timed(spark, rows).cache()
    yield df, in_order([(t, i) for i, t in rows])
    df.unpersist()


# --- paging ----------------------------------------------------------------


def test_keyset_pages_cover_everything_once(tied):
    df, wanted = tied
    got, after = [], None
    while True:
        page = keys(paging.keyset_page(df, after, 100))
        got += page
        if len(page) < 100:
            break
        after = page[-1]
    assert got == wanted


@pytest.mark.parametrize("offset", [0, 5, 99, 100, 250, 450, 690, 701, 740, 761, 762, 900])
def test_offset_page_after_counting(tied, monkeypatch, offset):
    df, wanted = tied
    monkeypatch.setattr(paging, "MAX_SKIP", 20)
    monkeypatch.setattr(paging, "_BUCKETS", 4)
    assert keys(paging.offset_page(df, offset, 50)) == wanted[offset : offset + 50]


@pytest.mark.parametrize("max_skip", [7, 60, 1000])
def test_pages_over_equal_keys_cover_the_rows_once(spark, max_skip):
    """Rows of one time and id differ in other columns; some are copies."""
    rows = [(1, T0)] * 90 + [(2, T0), (None, T0), (3, None), (3, T0 + timedelta(days=1))] + [(3, None)] * 20
    df = timed(spark, rows).withColumn("battery", (F.monotonically_increasing_id() % 40).cast("int"))
    df = spark.createDataFrame(df.collect(), df.schema)
    pages = [paging.offset_page(df, at, 30, max_skip) for at in range(0, 120, 30)]
    got = [tuple(r) for page in pages for r in page.collect()]
    assert sorted(got, key=repr) == sorted(map(tuple, df.collect()), key=repr)
    assert [len(p.collect()) for p in pages] == [30, 30, 30, 24]


@pytest.mark.parametrize("size", [25, 93, 1000])
def test_directory_pages_cover_the_rows_once_in_order(spark, tied, size):
    """Pages start within runs of copies, at missing keys, and may hold one run only."""
    rows = [(1, T0)] * 90 + [(2, T0), (None, T0), (3, None), (3, T0 + timedelta(days=1))] + [(3, None)] * 20
    copies = timed(spark, rows).withColumn("battery", F.lit(4))
    for df, n in ((copies, len(rows)), (tied[0], tied[0].count()))[: 1 if size < 90 else 2]:
        directory = paging.page_directory(df, size)
        assert sorted(r["page"] for r in directory.collect()) == list(range(-(-n // size)))
        pages = [paging.directory_page(df, directory, k, size) for k in range(-(-n // size) + 1)]
        got = [tuple(r) for page in pages for r in page.collect()]
        assert sorted(got, key=repr) == sorted(map(tuple, df.collect()), key=repr)
        places = [(r[PING_COLUMNS.index("timestamp")], r[0]) for r in got]
        assert places == in_order(places)
        assert [p.count() for p in pages[:-2]] == [size] * (len(pages) - 2) and pages[-1].count() == 0


def test_a_directory_serves_all_its_pages(spark, tied, monkeypatch):
    """Reading a page neither counts nor numbers rows again, and its range reaches the scan."""
    df, wanted = tied
    folder = new_folder(spark, "paged")
    df.write.parquet(folder)
    kept = spark.read.parquet(folder)
    directory = paging.page_directory(kept, 100)
    monkeypatch.setattr(paging, "with_row_index", None)
    monkeypatch.setattr(paging, "_descend", None)
    assert [k for at in range(8) for k in keys(paging.directory_page(kept, directory, at, 100))] == wanted
    plan = plan_text(paging.directory_page(kept, directory, 1, 100))
    assert "GreaterThanOrEqual(timestamp" in plan and "LessThanOrEqual(timestamp" in plan


def test_directory_of_nothing(spark):
    directory = paging.page_directory(timed(spark, []), 10)
    assert directory.count() == 0 and paging.directory_page(timed(spark, []), directory, 0, 10).count() == 0


def test_filter_reaches_the_scan(spark, tiny, tmp_path):
    df = paging.newer_than(derived.pings(spark, tiny), datetime(2024, 1, 15, 1, 2, 3))
    assert "GreaterThan(ts,2024-01-15T01:02:03)" in plan_text(df)
    derived.pings(spark, tiny).write.parquet(str(tmp_path / "pings"))
    stored = source.read_pings(spark, "parquet", path=str(tmp_path / "pings"))
    plan = plan_text(paging.keyset_page(stored, (datetime(2024, 1, 15), 5)))
    assert "TakeOrderedAndProject" in plan and "GreaterThanOrEqual(timestamp,2024-01-15T00:00)" in plan


# --- numbering -------------------------------------------------------------


def test_row_index_is_consecutive(spark):
    df = spark.range(1000).repartition(7).filter("id % 3 > 0")
    assert sorted(r["i"] for r in numbering.with_row_index(df, "i").collect()) == list(range(666))


def test_row_index_follows_order_and_splits_equal_keys(spark):
    df = spark.range(2000).selectExpr("CASE WHEN id % 2 = 0 THEN 5 ELSE id % 11 END AS k", "id")
    got = numbering.with_row_index(df, "i", ["k"]).orderBy("i").collect()
    assert [r["i"] for r in got] == list(range(2000))
    assert [r["k"] for r in got] == sorted(r["k"] for r in got)
    assert len({r["id"] for r in got}) == 2000


def test_next_ids(spark):
    existing = timed(spark, [(4, T0), (9, T0), (None, T0)])
    new = timed(spark, [(None, T0)] * 3)
    got = numbering.with_next_ids(new, existing)
    assert got.columns == PING_COLUMNS and got.schema["id"].dataType.simpleString() == "int"
    assert sorted(r["id"] for r in got.collect()) == [10, 11, 12]
    assert [r["id"] for r in numbering.with_next_ids(new.limit(1), timed(spark, [])).collect()] == [1]


def test_id_overflow_fails(spark):
    new = timed(spark, [(None, T0)])
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        numbering.with_next_ids(new, timed(spark, [(2**31 - 1, T0)])).collect()


# --- sources ---------------------------------------------------------------


def test_unknown_source(spark):
    with pytest.raises(ValueError, match="unknown source"):
        source.read_pings(spark, "ftp", path="x")


def test_empty_pings(spark):
    df = source.empty_pings(spark)
    assert df.schema == PING_SCHEMA and df.isEmpty()


PAGE = """[
 {"timestamp": "2024-01-01T10:00:00.5", "id": 1, "altitude": 450, "battery": null, "latitude": -17.8, "longitude": -63.1},
 {"id": 2, "timestamp": "2024-01-01T10:00:00+00:00", "sim_operator": "ENTEL", "speed": 1.5, "signal": -60, "extra": 1}
]"""


def test_page_binds_by_name(spark, tmp_path):
    (tmp_path / "page.json").write_text(PAGE)
    first, second = source.read_pings(spark, "pages", path=str(tmp_path)).orderBy("id").collect()
    assert first["altitude"] == 450.0 and first["battery"] is None
    assert first["timestamp"] == datetime(2024, 1, 1, 10, 0, 0, 500000)
    assert second["timestamp"] == datetime(2024, 1, 1, 6) and second["latitude"] is None


def test_page_mark(spark, tmp_path):
    (tmp_path / "page.json").write_text(PAGE)
    rows = source.read_pings(spark, "pages", datetime(2024, 1, 1, 6), path=str(tmp_path)).collect()
    assert [r["id"] for r in rows] == [1]


def test_pages_landed_before_are_left_out(spark, tmp_path):
    (tmp_path / "page.json").write_text(PAGE)
    for day, n in (("2000-01-01T00:00:00", 2), ("2999-01-01T00:00:00", 0)):
        options = {"path": str(tmp_path), "landed_after": day}
        assert source.read_pings(spark, "pages", **options).count() == n


BAD_LINES = [
    '{"id": 1, "timestamp": "2024-01-01T10:00:00"}',
    '{"id": "x", "timestamp": "2024-01-01T10:00:00"}',
    '{"id": 3, "timestamp": "yesterday"}',
    "{",
]


@pytest.mark.parametrize("line", BAD_LINES[1:])
def test_bad_page_row_fails(spark, tmp_path, line):
    (tmp_path / "page.json").write_text("\n".join([BAD_LINES[0], line]))
    with pytest.raises(Exception, match="MALFORMED_RECORD|unreadable timestamp"):
        source.read_pages(spark, str(tmp_path), multi_line=False).collect()


def test_bad_page_rows_kept_on_request(spark, tmp_path):
    (tmp_path / "page.json").write_text("\n".join(BAD_LINES))
    df = source.read_pages(spark, str(tmp_path), multi_line=False, keep_bad_rows=True)
    bad = [r[source.BAD_ROW] for r in df.collect()]
    assert len(bad) == 4 and bad.count(None) == 1


def test_csv_by_name(spark, tmp_path):
    header = [c for c in reversed(PING_COLUMNS)]
    values = {"id": "5", "timestamp": "2024-01-01 10:00:00", "speed": "2", "sim_operator": " tigo "}
    line = ",".join(values.get(c, "") for c in header)
    (tmp_path / "a.csv").write_text(",".join(header) + "\n" + line + "\n")
    df = source.read_pings(spark, "csv", path=str(tmp_path))
    row = df.first()
    assert df.columns == PING_COLUMNS
    assert (row["id"], row["speed"], row["sim_operator"]) == (5, 2.0, " tigo ")
    assert row["timestamp"] == datetime(2024, 1, 1, 10) and row["battery"] is None
    (tmp_path / "b.csv").write_text(",".join(PING_COLUMNS) + "\n")
    with pytest.raises(Exception, match="header"):
        source.read_pings(spark, "csv", path=str(tmp_path)).collect()


@pytest.mark.parametrize(("text", "wanted"), [("75.0", 75), ("-3", -3), ("", None), ("75.5", "fails")])
def test_csv_whole_numbers(spark, tmp_path, text, wanted):
    line = ",".join({"id": "1", "battery": text}.get(c, "") for c in PING_COLUMNS)
    (tmp_path / "a.csv").write_text(",".join(PING_COLUMNS) + "\n" + line + "\n")
    df = source.read_csv(spark, str(tmp_path))
    if wanted == "fails":
        with pytest.raises(Exception, match="not a whole number"):
            df.collect()
    else:
        assert df.first()["battery"] == wanted and df.schema == PING_SCHEMA


def test_table_source_and_drop_missing_id(spark):
    timed(spark, [(1, T0), (None, T0)]).createOrReplaceTempView("some_pings")
    df = source.read_pings(spark, "table", name="some_pings")
    assert source.drop_missing_id(df).count() == 1


class FakeReader:
    """Records options; answers the range query with a row and a scan with no rows."""

    def __init__(self, spark, bounds):
        self.spark, self.bounds, self.calls = spark, bounds, []

    def __call__(self):
        reader = MagicMock()
        seen = {}
        reader.format.return_value = reader
        reader.options.side_effect = lambda **o: (seen.update(o), reader)[1]
        reader.load.side_effect = lambda: self._load(seen)
        return reader

    def _load(self, seen):
        self.calls.append(seen)
        if "query" in seen:
            return self.spark.createDataFrame([self.bounds], "lo int, hi int, n bigint")
        return source.empty_pings(self.spark)


@pytest.mark.parametrize(
    ("bounds", "parts"),
    [((1, 4_000_000, 4_000_000), "8"), ((1, 10**9, 10**9), "32"), ((1, 9, 9), None), ((None, None, 0), None)],
)
def test_jdbc_scan_is_split(spark, bounds, parts):
    fake = FakeReader(spark, bounds)
    session = MagicMock()
    type(session).read = property(lambda _: fake())
    source.read_jdbc(session, "jdbc:x", "public.locations", datetime(2024, 1, 2), {"user": "u"})
    asked, scanned = fake.calls
    assert "\"timestamp\" > '2024-01-02 00:00:00.000000'" in asked["query"]
    assert scanned["dbtable"] == "public.locations" and scanned["user"] == "u"
    assert scanned.get("numPartitions") == parts
    if parts:
        assert (scanned["lowerBound"], scanned["upperBound"]) == (str(bounds[0]), str(bounds[1] + 1))


# --- targets ---------------------------------------------------------------


def labelled(spark, times):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "id int, fecha_hora timestamp_ntz")
    return df.select(
        *[
            F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in OUTPUT_SCHEMA
        ]
    )


def make_target(kind, spark, tmp_path):
    if kind == "path":
        return targets.PathTarget(spark, str(tmp_path / "target"))
    spark.sql("DROP TABLE IF EXISTS ping_target")
    return targets.TableTarget(spark, "ping_target")


@pytest.mark.parametrize("kind", ["path", "table"])
def test_target_life(spark, tmp_path, kind):
    target = make_target(kind, spark, tmp_path)
    assert not target.exists() and target.high_water_mark() is None
    target.append(labelled(spark, []))
    assert target.exists() and target.high_water_mark() is None
    late, early = T0 + timedelta(days=1, microseconds=3), T0
    target.append(labelled(spark, [late, None]))
    target.append(labelled(spark, [early]))
    assert target.high_water_mark() == late and target.read().count() == 3
    target.replace(labelled(spark, [early]))
    assert target.high_water_mark() == early and target.read().count() == 1
    assert target.read().columns == OUTPUT_SCHEMA.fieldNames()


@pytest.mark.parametrize("order", [[3, 1, 2], [1, 2, 3], [None, 2], [2, None], [None]])
@pytest.mark.parametrize("kind", ["path", "table"])
def test_mark_of_many_files(spark, tmp_path, order, kind):
    target = make_target(kind, spark, tmp_path)
    for day in order:
        target.append(labelled(spark, [None if day is None else T0 + timedelta(days=day)]))
    known = [d for d in order if d is not None]
    assert target.high_water_mark() == (T0 + timedelta(days=max(known)) if known else None)


def test_jdbc_target_options(spark):
    session, df = MagicMock(), MagicMock()
    writer = df.repartition.return_value.write.format.return_value
    writer.mode.return_value.options.return_value = writer
    target = targets.JdbcTarget(session, "jdbc:x", "locations", {"user": "u"}, connections=4)
    target.append(df)
    target.replace(df)
    assert [c.args[0] for c in writer.mode.call_args_list] == ["append", "overwrite"]
    assert {c.args for c in df.repartition.call_args_list} == {(4,)}
    options = writer.mode.return_value.options.call_args.kwargs
    assert options["numPartitions"] == "4" and options["batchsize"] == "5000"
    assert "createTableColumnTypes" not in options
    conf = targets.jdbc_catalog_conf("pg", "jdbc:x", "org.postgresql.Driver", user="u")
    assert conf["spark.sql.catalog.pg.pushDownAggregate"] == "true"
    assert conf["spark.sql.catalog.pg.user"] == "u"


@pytest.mark.parametrize("found", [0, 1])
def test_missing_jdbc_table_has_no_mark(found):
    """Asked of the information schema; only an existing table is read."""
    session = MagicMock()
    options = session.read.format.return_value.options
    options.return_value.load.return_value.first.side_effect = [(found,), (T0,)]
    target = targets.JdbcTarget(session, "jdbc:x", 'geo."Locations"')
    assert target.high_water_mark() == (T0 if found else None)
    asked = [c.kwargs["query"] for c in options.call_args_list]
    assert "lower('Locations')" in asked[0] and "lower('geo')" in asked[0] and len(asked) == 1 + found


def test_postgres_column_types(spark):
    """The types that Spark's dialect gives a created table."""
    jvm = spark.sparkContext._jvm
    df = spark.createDataFrame([], OUTPUT_SCHEMA)
    dialect = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get("jdbc:postgresql://x/y")
    types = {
        f.name: dialect.getJDBCType(jvm.org.apache.spark.sql.types.DataType.fromDDL(f.dataType.simpleString()))
        for f in df.schema
    }
    said = {n: t.get().databaseTypeDefinition() for n, t in types.items() if t.isDefined()}
    assert said["latitud"] == "FLOAT8" and said["zona"] == "TEXT"


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/La_Paz"])
def test_instants_do_not_depend_on_the_session(spark, tmp_path, zone):
    """A file that stores instants: same clocks, and same rows after a mark, under every zone."""
    path = str(tmp_path / "instants")
    texts = [f"2024-01-{d:02d} 12:00:00+00:00" for d in range(1, 11)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, at string")
    others = [F.lit(None).cast(f.dataType).alias(f.name) for f in PING_SCHEMA if f.name not in ("id", "timestamp")]
    df.select("id", F.col("at").cast("timestamp").alias("timestamp"), *others).write.parquet(path)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = source.read_pings(spark, "parquet", datetime(2024, 1, 5, 8), path=path)
        assert {r["id"] for r in rows.collect()} == {5, 6, 7, 8, 9}
        assert rows.agg(F.max("timestamp")).first()[0] == datetime(2024, 1, 10, 8)
        assert "GreaterThan(timestamp" in plan_text(rows)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


# --- folder for intermediate tables ----------------------------------------


def test_shared_folder():
    session = MagicMock()
    session.conf.get.return_value = "s3a://bucket/state/"
    assert shared_folder(session) == "s3a://bucket/state"
    session.conf.get.return_value = None
    session.sparkContext.master = "yarn"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session)
    session.sparkContext.master, session.sparkContext.applicationId = "local[2]", "app"
    assert shared_folder(session) == shared_folder(session)
    assert new_folder(session, "x") != new_folder(session, "x")
