import datetime as dt

import pytest
from pyspark.sql import functions as F

from grainmill.session import materialise, scratch_path, shared_dir
from grainmill.sources import documents, scans
from grainmill.sources.versioned import KeyViolation, TableStore, VersionedTable, latest_version
from tests.conftest import rows


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "t"))


def frame(spark, data, schema="Id string, hour int, date date, z double"):
    return spark.createDataFrame(data, schema)


D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def test_new_table_has_no_version(table):
    assert table.latest() is None and not table.exists()
    with pytest.raises(LookupError):
        table.read()


def test_overwrite_append_and_time_travel(spark, table):
    assert table.overwrite(spark.range(3)) == 1
    assert table.append(spark.range(3, 5)) == 2
    assert table.overwrite(spark.range(1).selectExpr("id AS other", "'x' AS text")) == 3
    assert table.append(spark.range(1).selectExpr("'y' AS text", "id AS other")) == 4
    assert rows(table.read(1)) == [(0,), (1,), (2,)]
    assert table.read(2).count() == 5
    assert rows(table.read(3)) == [(0, "x")]
    assert rows(table.read()) == [(0, "x"), (0, "y")]
    assert table.latest() == 4
    with pytest.raises(LookupError):
        table.read(9)


def test_overwrite_may_read_itself(spark, table):
    table.overwrite(spark.range(4))
    table.overwrite(table.read().selectExpr("id", "id * 2 AS prediction"))
    assert rows(table.read()) == [(0, 0), (1, 2), (2, 4), (3, 6)]


def test_append_rejects_another_schema(spark, table):
    table.overwrite(spark.range(1))
    with pytest.raises(ValueError):
        table.append(spark.range(1).selectExpr("id", "1 AS more"))


def test_uncommitted_version_is_invisible_and_replaced(spark, table):
    table.overwrite(spark.range(2))
    spark.range(100).write.parquet(f"{table.path}/_version=2")
    assert table.read().count() == 2 and table.latest() == 1
    table.append(spark.range(2, 3))
    assert table.read().count() == 3


def test_create_and_upsert(spark, table):
    first = frame(spark, [("a", 1, D1, 1.0), ("b", 1, D1, 2.0), ("b", 2, D1, 3.0)])
    assert table.create(first, ["Id", "hour"], ["date"]) == 1
    assert table.create(first, ["Id", "hour"]) is None
    # b/1 moves to another date, c is new, a/1 gets a null feature
    batch = frame(spark, [("b", 1, D2, 9.0), ("c", 1, D2, 4.0), ("a", 1, D1, None)])
    assert table.upsert(batch) == 2
    wanted = {("a", 1, D1, None), ("b", 1, D2, 9.0), ("b", 2, D1, 3.0), ("c", 1, D2, 4.0)}
    assert {tuple(r) for r in table.read().collect()} == wanted
    table.upsert(batch)
    assert {tuple(r) for r in table.read().collect()} == wanted
    assert table.read(1).count() == 3


@pytest.mark.parametrize("bad", [[("a", 1, D1, 1.0), ("a", 1, D2, 2.0)], [(None, 1, D1, 1.0)]])
def test_keys_are_checked(spark, table, bad):
    with pytest.raises(KeyViolation):
        table.create(frame(spark, bad), ["Id", "hour"], ["date"])
    assert not table.exists()
    table.create(frame(spark, [("x", 1, D1, 1.0)]), ["Id", "hour"], ["date"])
    with pytest.raises(KeyViolation):
        table.upsert(frame(spark, bad))
    assert table.latest() == 1


def test_upsert_needs_the_stored_types(spark, table):
    table.create(frame(spark, [("x", 1, D1, 1.0)]), ["Id", "hour"])
    for column, kind in (("hour", "bigint"), ("hour", "string")):
        batch = frame(spark, [("x", 1, D1, 2.0)]).withColumn(column, F.col(column).cast(kind))
        with pytest.raises(ValueError):
            table.upsert(batch)
    assert table.latest() == 1


def test_upsert_of_an_empty_batch(spark, table):
    table.create(frame(spark, [("x", 1, D1, 1.0)]), ["Id", "hour"], ["date"])
    table.upsert(frame(spark, []))
    assert table.read().count() == 1


def test_an_empty_partitioned_table(spark, table):
    table.create(frame(spark, []), ["Id", "hour"], ["date"])
    assert table.read().count() == 0
    table.upsert(frame(spark, [("x", 1, D1, 1.0)]))
    assert table.read().count() == 1


def test_partitioned_version_is_pruned(spark, table):
    table.create(frame(spark, [("x", 1, D1, 1.0), ("y", 1, D2, 1.0)]), ["Id", "hour"], ["date"])
    plan = table.read().filter("date = '2024-01-01'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_latest_version_compares_numbers(spark):
    log = spark.createDataFrame([("t", "9"), ("t", "10"), ("u", "2")], "name string, version string")
    assert rows(latest_version(log, by=["name"])) == [("t", 10), ("u", 2)]


def test_store_names(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.table("db.t").overwrite(spark.range(1))
    assert store.table("db.t").path.endswith("/db.db/t")
    assert store.table("t").path.endswith("/default.db/t")
    store.table("db.t").overwrite(spark.range(5))
    assert spark.table(store.view("db.t")).count() == 5
    assert spark.sql(f"SELECT * FROM {store.view('db.t', 1)}").count() == 1


def test_catalog_scan_and_preview(spark):
    spark.range(10).createOrReplaceTempView("ten")
    assert scans.scan(spark, "ten", ["id"]).count() == 10
    assert rows(scans.preview(scans.scan(spark, "ten"), ["id"], 3)) == [(0,), (1,), (2,)]


def test_documents_round_trip(spark):
    df = spark.createDataFrame(
        [(1, None, [("a", 1.5)])], "n int, t string, f array<struct<name:string,v:double>>"
    )
    back = documents.from_document(documents.to_document(df), df.schema)
    assert back.collect() == df.collect()
    broken = spark.createDataFrame([("{",)], "document string")
    with pytest.raises(Exception):
        documents.from_document(broken, df.schema).collect()


def test_scratch_is_under_the_configured_folder(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark))
    assert materialise(spark.range(3)).count() == 3


def test_upsert_of_a_batch_too_large_to_broadcast(spark, table, no_broadcast):
    old = spark.range(200).selectExpr("cast(id AS string) AS Id", "1 AS hour", "date'2024-01-01' AS date", "1.0D AS z")
    new = spark.range(100, 300).selectExpr("cast(id AS string) AS Id", "1 AS hour", "date'2024-01-02' AS date", "2.0D AS z")
    table.create(old, ["Id", "hour"], ["date"])
    table.upsert(new)
    assert rows(table.read().groupBy("date", "z").count()) == [(D1, 1.0, 100), (D2, 2.0, 200)]


def test_tables_are_found_by_name(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    table = store.table("shelf.goods")
    other = spark.newSession()
    table.overwrite(frame(spark, [("a", 1, D1, 1.0)]), ["date"])
    assert rows(other.table("shelf.goods")) == [("a", 1, D1, 1.0)]
    table.append(frame(spark, [("b", 2, D2, 2.0)]))
    table.append(frame(spark, []))
    assert rows(other.table("shelf.goods")) == [("a", 1, D1, 1.0), ("b", 2, D2, 2.0)]
    before = rows(table.read())
    assert table.fold() == 4 and table.fold() == 4
    assert rows(table.read()) == before == rows(other.table("shelf.goods"))
    table.overwrite(spark.range(2))
    assert rows(other.table("shelf.goods")) == [(0,), (1,)]
    store.table("plain").overwrite(spark.range(1))
    assert rows(other.table("default.plain")) == [(0,)]
    for name in ("shelf.goods", "default.plain"):
        spark.sql(f"DROP VIEW {name}")


def files(table):
    return {f.split("/_version=")[1] for f in table.read().inputFiles()}


def days(*numbers):
    return [dt.date(2024, 1, n) for n in numbers]


def test_upsert_leaves_the_files_of_other_dates(spark, table):
    table.create(frame(spark, [(f"k{i}", 1, d, 0.0) for i, d in enumerate(days(1, 1, 2, 2, 3, 4))]), ["Id", "hour"], ["date"])
    before = files(table)
    # k0 changes, k2 moves from the 2nd to the 4th, k9 is new on the 3rd and k8 on a new date
    batch = [("k0", 1, days(1)[0], 1.0), ("k2", 1, days(4)[0], 2.0), ("k9", 1, days(3)[0], 9.0), ("k8", 1, days(7)[0], 8.0)]
    table.upsert(frame(spark, batch))
    after = files(table)
    kept = {f.split("/date=")[1][:10] for f in before & after}
    assert kept == {"2024-01-03", "2024-01-04"}  # the 3rd and 4th only gain a folder
    rows_now = {(r.Id, r.date.day, r.z) for r in table.read().collect()}
    assert rows_now == {("k0", 1, 1.0), ("k1", 1, 0.0), ("k2", 4, 2.0), ("k3", 2, 0.0), ("k4", 3, 0.0), ("k5", 4, 0.0), ("k9", 3, 9.0), ("k8", 7, 8.0)}
    assert {(r.Id, r.z) for r in table.read(1).collect()} == {(f"k{i}", 0.0) for i in range(6)}
    # the last row of a date moves away: the date is gone
    table.upsert(frame(spark, [("k3", 1, days(1)[0], 3.0)]))
    assert table.read().where("date = '2024-01-02'").count() == 0 and table.read().count() == 8


def test_upsert_against_a_dictionary(spark, table):
    import random

    rng, held = random.Random(2), {}

    def batch(n):
        return {(f"k{rng.randrange(40)}", rng.randrange(2)): (rng.choice(days(1, 2, 3, 9)), rng.random()) for _ in range(n)}

    for step in range(5):
        new = batch(25)
        df = frame(spark, [(*k, *v) for k, v in new.items()])
        table.upsert(df) if step else table.create(df, ["Id", "hour"], ["date"])
        held |= new
        assert {(r.Id, r.hour): (r.date, r.z) for r in table.read().collect()} == held


def test_partition_values_that_need_escaping(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    table = store.table("shelf.odd")
    values = ["a/b", "a b", "50%", "x=1", "it's", "é", None]
    schema = "id int, part string"
    table.create(spark.createDataFrame(list(enumerate(values)), schema), ["id"], ["part"])
    table.upsert(spark.createDataFrame([(0, "it's"), (99, "a b")], schema))
    wanted = {(i, v) for i, v in enumerate(values)} - {(0, "a/b")} | {(0, "it's"), (99, "a b")}
    assert {tuple(r) for r in table.read().collect()} == wanted
    assert {tuple(r) for r in spark.table("shelf.odd").collect()} == wanted
    spark.sql("DROP VIEW shelf.odd")


def test_keyed_append_reads_no_old_keys_for_fresh_ones(spark, table, monkeypatch):
    table.create(spark.range(5_000).selectExpr("id AS k", "id % 3 AS d", "0 AS v"), ["k"], ["d"])
    table.append(spark.range(5_000, 5_003).selectExpr("id AS k", "id % 3 AS d", "1 AS v"))
    scanned = []
    scan = VersionedTable._scan
    monkeypatch.setattr(VersionedTable, "_scan", lambda self, parts, *a: scanned.append(parts) or scan(self, parts, *a))
    assert table.append(spark.range(9_000, 9_020).selectExpr("id AS k", "id % 3 AS d", "2 AS v")) == 3
    # a false alarm in 200 keys and two filters: hardly ever more than the batch itself is read
    read = {v for parts in scanned for versions in parts.values() for v in versions}
    assert 3 in read and len(read) < 3
    monkeypatch.undo()
    with pytest.raises(KeyViolation):
        table.append(spark.createDataFrame([(9_100, 1, 3), (4_321, 0, 3)], "k long, d long, v int"))
    assert table.latest() == 3 and table.read().count() == 5_023
    with pytest.raises(KeyViolation):
        table.append(spark.createDataFrame([(9_200, 1, 3), (9_200, 0, 3)], "k long, d long, v int"))
    table.append(table.read().limit(0))
    assert table.read().count() == 5_023


def test_bloom_filters_know_every_key(spark):
    from grainmill.sources import versioned

    rows_ = spark.range(3_000).selectExpr("id", "cast(id * 7 AS string) AS s")
    words = materialise(versioned.bloom_words(rows_, ["id", "s"], 3_000), "bloom")
    word, bits = versioned.bloom_place(["id", "s"], F.lit(words.first().words).cast("bigint"))

    def found(df):
        asked = df.select(word.alias("word"), bits.alias("asked"))
        return asked.join(words, "word").where("bits & asked = asked").count()

    assert found(rows_) == 3_000
    assert found(spark.range(10_000, 30_000).selectExpr("id", "cast(id AS string) AS s")) < 300


def test_a_chain_of_appends_is_folded_by_partition(spark, table, monkeypatch):
    monkeypatch.setattr("grainmill.sources.versioned.FOLD_AT", 3)
    for i in range(6):
        table.append(spark.createDataFrame([(i, "hot"), *([(i, "cold")] if i < 2 else [])], "v int, p string")) if i else table.overwrite(
            spark.createDataFrame([(0, "hot"), (0, "cold")], "v int, p string"), ["p"]
        )
    row = table._commit_row()
    assert len(row["parts"]["/p=hot"]) <= 3 and row["parts"]["/p=cold"] == [1, 2]
    assert rows(table.read()) == sorted([(i, "hot") for i in range(6)] + [(0, "cold"), (1, "cold")])
    assert [r.v for r in table.added_since(2).orderBy("v").collect()] == [2, 3, 4, 5]
    assert table.added_since(table.latest()).count() == 0
    table.overwrite(table.read())
    assert table.added_since(2) is None
