import json

import pytest

from weavegraph.plans import source_plans
from weavegraph.plans.registry import Tables
from weavegraph.sources import io


def test_files(spark, tmp_path):
    for family, cls, name, body in (("f", "A", "b_1.json", '{"x":1}'), ("f", "B", "c_-2.json", '{"x":2}'), ("f", "B", "d_3.json", "broken")):
        folder = tmp_path / "tree" / family / cls
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text(body)
    tree = sorted((r["family"], r["class"], r["bundle"], r["path_id"]) for r in io.scan_payload_tree(spark, str(tmp_path / "tree")).collect())
    assert tree == [("f", "A", "b", 1), ("f", "B", "c", -2)]
    assert [r["bundle"] for r in io.scan_class_family(spark, str(tmp_path / "tree"), "A").collect()] == ["b"]
    assert sorted(r.length for r in io.scan_file_inventory(spark, str(tmp_path / "tree")).collect()) == [6, 7, 7]
    (tmp_path / "one.json").write_text(json.dumps({"keys": [{"k": "a", "n": 1}, {"k": "b"}], "more": 1}))
    assert [tuple(r) for r in io.scan_single_json(spark, str(tmp_path / "one.json"), "keys", "k string, n int").collect()] == [("a", 1), ("b", None)]


def test_round_trips(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (1, "a"), (3, None)], "id int, v string")
    io.sink_jsonl_sorted(df.repartition(3), str(tmp_path / "lines"), ["id"])
    text = "".join(p.read_text() for p in sorted((tmp_path / "lines").glob("part-*")))
    assert text == '{"id":1,"v":"a"}\n{"id":2,"v":"b"}\n{"id":3}\n'
    assert sorted(map(tuple, io.scan_jsonl(spark, str(tmp_path / "lines"), "id int, v string").collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    io.sink_split(df.fillna("c"), str(tmp_path / "split"), ["v"], ["id"])
    assert {p.name for p in (tmp_path / "split").iterdir() if p.is_dir()} == {"v=a", "v=b", "v=c"}
    assert io.projection_matches(df, df.selectExpr("id as i"), {"i": "id"}).count() == 0


def test_optional_and_curated(spark, tmp_path):
    missing, there = io.scan_optional(spark, str(tmp_path / "none"), "a int")
    assert not there and missing.count() == 0 and missing.columns == ["a"]
    targets = spark.createDataFrame([("t",)], "name string")
    make = lambda rows: spark.createDataFrame(rows, "k string, t string")
    assert io.scan_curated(make([("a", "t")]), "k", ["t"], "t", targets, "name").count() == 1
    for broken in ([("a", "t"), ("a", "t")], [("a", None)], [("a", "u")]):
        with pytest.raises(ValueError):
            io.scan_curated(make(broken), "k", ["t"], "t", targets, "name")


def test_places_of_lines_when_files_are_read_in_blocks(spark, tmp_path):
    io.sink_jsonl_sorted(spark.range(3000).repartition(3), str(tmp_path / "lines"), ["id"])
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        blocks = spark.read.text(str(tmp_path / "lines")).rdd.getNumPartitions()
        got = source_plans.places_in_files(spark, str(tmp_path / "lines")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert blocks > 4 and sorted((r.place, r.value) for r in got) == [(i + 1, f'{{"id":{i}}}') for i in range(3000)]


def test_tree_is_written_by_more_tasks_than_its_folders_give(spark, tmp_path):
    """Supplier rows of one folder are no single task's: each file's name holds its task."""
    spark.range(60).selectExpr("id as s_suppkey", "'n' as s_name", "0 as s_nationkey").write.parquet(str(tmp_path / "supplier.parquet"))
    tree = source_plans.payload_tree(Tables(spark, str(tmp_path)))
    files = [f for f in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(tree).select("path").toPandas()["path"] if f.endswith(".txt")]
    assert len(files) == 60 and len({f.rsplit("/", 1)[1].split("-")[1] for f in files}) > 4
