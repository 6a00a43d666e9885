import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from vecshoal.operators import lookup
from vecshoal.sources.items import modern_names, read_csv_items, stored_layout
from vecshoal.sources.schema import CLUSTERED, ITEM
from vecshoal.sources import store
from vecshoal.sources.store import ItemTable, RejectedRows, export_csv, ingest_csv, last_wins

ROWS = [("a", [1, 2], 0), ("b", [3, 4], 1), ("o'c", [5, 6], 1), ("d", [7, 8], 2)]


@pytest.fixture
def stored(spark, items, scratch):
    rows = items(ROWS)
    made = ItemTable(spark, scratch("items"), rows.schema)
    made.replace(rows)
    return made


def content(table):
    return {r.id: (r.encd, r.cluster_id) for r in table.read().collect()}


def test_lookups(stored):
    table = stored.read()
    assert lookup.by_id(table, "o'c").count() == 1
    assert lookup.by_ids(table, []).count() == 0
    assert lookup.by_ids(table, ["a"]).count() == 1
    assert lookup.by_ids(table, ["a", "o'c", "zz"]).count() == 2
    ids = table.sparkSession.createDataFrame([("a",), ("a",), ("zz",)], "id string")
    assert [r.id for r in lookup.by_id_table(table, ids).collect()] == ["a"]
    assert lookup.by_cluster(table, 1).count() == 2
    assert lookup.matching(table, F.col("encd")[0] > 4).count() == 2
    assert lookup.matching(table, {"cluster_id": 1, "id": "b"}).count() == 1
    assert lookup.matching(table, {}).count() == 4


def test_upsert_inserts_replaces_and_moves(stored, items):
    assert stored.upsert(items([("a", [9, 9], 2), ("e", [0, 0], 5)]), None) == 2
    found = content(stored)
    assert found["a"] == ([9.0, 9.0], 2) and found["e"] == ([0.0, 0.0], 5)
    assert len(found) == 5
    assert lookup.by_cluster(stored.read(), 0).count() == 0


@pytest.mark.parametrize("limit", [500_000, 2, 1])
def test_upsert_twice_is_upsert_once(stored, items, monkeypatch, limit):
    monkeypatch.setattr(store, "REPLACED_IDS", limit)
    batch = items([("a", [9, 9], 2), ("b", [1, 1], 0), ("e", [0, 0], 5)])
    stored.upsert(batch, None)
    once = content(stored)
    stored.upsert(batch, None)
    assert content(stored) == once


def test_last_row_of_a_batch_wins(stored, items):
    batch = items([("a", [1, 0], 1), ("a", [2, 0], 2), ("a", [3, 0], 3)])
    stored.upsert(batch, ["cluster_id"])
    assert content(stored)["a"] == ([3.0, 0.0], 3)
    assert len(content(stored)) == 4


@pytest.mark.parametrize("order", [None, ["cluster_id"]])
def test_rows_without_id_are_set_aside(stored, items, order):
    stored.upsert(items([(None, [1, 0], 1), ("e", [2, 0], 2), (None, [3, 0], 3)]), order)
    assert sorted(r.cluster_id for r in stored.rejected().collect()) == [1, 3]
    assert sorted(content(stored)) == ["a", "b", "d", "e", "o'c"]


def test_an_unfinished_version_is_not_read(stored, items):
    with open(f"{stored.path}/versions/2", "w") as cut_off:
        cut_off.write(stored.files(1)[0])
    assert stored.versions() == [1]
    assert len(content(stored)) == 4
    assert stored.upsert(items([("e", [0, 0], 5)]), None) == 3
    assert stored.versions() == [1, 3]
    assert len(content(stored)) == 5


def test_an_upsert_keeps_the_files_it_does_not_touch(stored, items):
    before = stored.files()
    stored.upsert(items([("a", [9, 9], 0)]), None)
    after = stored.files()
    assert len(set(before) - set(after)) == 1 and len(set(after) - set(before)) == 1
    stored.upsert(items([("new", [9, 9], 0)]), None)
    assert set(after) < set(stored.files())
    assert sorted(content(stored)) == ["a", "b", "d", "new", "o'c"]
    assert len(stored._read(before).collect()) == 4


def test_of_two_writers_one_fails(stored, items, monkeypatch):
    last = stored._last()
    stored.append(items([("e", [0, 0], 5)]))
    monkeypatch.setattr(stored, "_last", lambda: last)
    for change in (lambda: stored.append(items([("f", [0, 0], 5)])), lambda: stored.upsert(items([("f", [0, 0], 5)]), None), stored.truncate):
        with pytest.raises(store.LostRace):
            change()
    assert sorted(content(stored)) == ["a", "b", "d", "e", "o'c"]


def test_an_append_is_a_version_of_its_own(stored, items):
    assert stored.append(items([("e", [0, 0], 5)])) == 2
    assert len(stored._read(stored.files(1)).collect()) == 4


def test_files_are_sorted_by_id(spark, items, scratch):
    rows = items([(f"i{i * 7919 % 1000:04d}", [i, 0], i % 3) for i in range(1000)])
    table = ItemTable(spark, scratch("items"), rows.schema)
    table.replace(rows)
    table.upsert(items([(f"i{i:04d}", [0, 0], 1) for i in range(500, 1100)]), None)
    for version in (1, 2):
        assert table.files(version)
        for file in table.files(version):
            file = f"{table.path}/data/{file}"
            ids = pq.read_table(file, columns=["id"], partitioning=None).column("id").to_pylist()
            assert ids == sorted(ids)
    assert table.read().count() == 1100


def test_append_and_truncate(stored, items):
    stored.append(items([("a", [1, 2], 0)]))
    assert stored.read().count() == 5
    assert stored.truncate() == 5
    assert stored.read().count() == 0
    stored.upsert(items([("x", [1, 2], 0)]), None)
    assert list(content(stored)) == ["x"]


def test_old_versions_can_go(stored, items):
    for i in range(3):
        stored.upsert(items([(f"n{i}", [1, 2], 0)]), None)
    assert stored.versions() == [1, 2, 3, 4]
    assert stored.drop_old(keep=2) == [1, 2]
    assert stored.versions() == [3, 4]
    assert stored.read().count() == 7
    assert stored._read(stored.files(3)).count() == 6


def test_a_table_without_versions_is_empty(spark, scratch):
    assert ItemTable(spark, scratch("none"), CLUSTERED).read().count() == 0


def test_last_wins_with_a_hot_id(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("key"), F.col("id").alias("seq")
    )
    latest = last_wins(rows, ["seq"], "key")
    assert latest.count() == 2001
    assert latest.where("key = 'hot'").first().seq == 2997


def test_older_names(spark):
    older = spark.createDataFrame(
        [("images_1", "images", "u", [1.0], "1", 4, [0.5])],
        "id string, dataset string, url string, bert_ecd array<double>, img_name string, "
        "kmeans_cluster_id long, kmeans_cluster_centroid array<double>",
    )
    assert stored_layout(older).schema.names == CLUSTERED.names
    assert stored_layout(older).first().cluster_id == 4
    assert "encd" in modern_names(older).columns


def test_csv_round_trip_keeps_awkward_text(spark, items, scratch):
    rows = items([('say "hi", x', [0.1, 1e-17], 0), ("plain", [1 / 3, -2], 1)])
    path = scratch("csv")
    export_csv(rows, path)
    back = {r.id: r.encd for r in read_csv_items(spark, path).collect()}
    assert back == {r.id: r.encd for r in rows.collect()}


def write_lines(spark, path, lines):
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)


def test_ingest(spark, scratch):
    path = scratch("csv")
    lines = ["img_name,url,encd", '1,u1,"[1, 2]"', '2,u2,"[1]"', '3,u3,"[3, x]"', '1,u1b,"[5, 6]"', "4,u4,", '5,u5,"[7, 8]"']
    write_lines(spark, path, lines)
    table = ItemTable(spark, scratch("items"), ITEM, partition=None)
    bad = ingest_csv(table, path, 2)
    assert {r.img_name for r in bad.collect()} == {"2", "3", "4"}
    assert {r.id: (r.url, r.encd, r.dataset) for r in table.read().collect()} == {
        "images_1": ("u1b", [5.0, 6.0], "images"),
        "images_5": ("u5", [7.0, 8.0], "images"),
    }


def test_ingest_takes_the_last_line_of_a_split_file(spark, scratch):
    path = scratch("csv")
    write_lines(spark, path, ["img_name,url,encd"] + [f'1,u{i},"[{i}]"' for i in range(4000)])
    table = ItemTable(spark, scratch("items"), ITEM, partition=None)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        ingest_csv(table, path, 1)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.url for r in table.read().collect()] == ["u3999"]


def test_ingest_can_stop_at_a_failure(spark, scratch):
    path = scratch("csv")
    write_lines(spark, path, ["img_name,url,encd", '1,u1,"[1, 2]"', '2,u2,"[1]"'])
    table = ItemTable(spark, scratch("items"), ITEM, partition=None)
    with pytest.raises(RejectedRows):
        ingest_csv(table, path, 2, on_error="fail")
    assert table.versions() == []
    ingest_csv(table, path, 2, form="bracketed")
    assert table.read().count() == 1
