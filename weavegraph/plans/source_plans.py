"""Sources and sinks S1-S11: tables written to the shared folder and read back through each source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weavegraph.plans.registry import Plans, Tables, over_cores
from weavegraph.sources import io
from weavegraph.sources.json_elements import scan_json_elements
from weavegraph.sources.shared import scratch, stored

plan = Plans()
ORDER_LINES = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double"


@plan("select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders")
def s1_scan_jsonl(t: Tables) -> DataFrame:
    path = scratch(t.spark, "s1")
    t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice").write.json(path)
    return io.scan_jsonl(t.spark, path, ORDER_LINES)


def payload_tree(t: Tables) -> str:
    """A JSON file per supplier, in the folders of its family and class. A file costs more than its row, and its folder has
    thousands, so rows are dealt over all cores and not by folders."""
    path = scratch(t.spark, "tree")
    body = F.to_json(F.struct("s_suppkey", F.struct("s_name").alias("deep")))
    rows = t.supplier.select(body.alias("value"), (F.col("s_nationkey") % 3).alias("family"), F.concat(F.lit("C"), (F.col("s_suppkey") % 4).cast("string")).alias("class"))
    over_cores(rows).write.option("maxRecordsPerFile", 1).partitionBy("family", "class").text(path)
    return path


@plan("select 'family=' || (s_nationkey % 3) as family, 'class=C' || (s_suppkey % 4) as class, s_suppkey, s_name from supplier")
def s2_scan_payload_tree(t: Tables) -> DataFrame:
    tree = io.scan_payload_tree(t.spark, payload_tree(t), "*.txt")
    return tree.select("family", "class", F.try_variant_get("payload", "$.s_suppkey", "bigint").alias("s_suppkey"), F.try_variant_get("payload", "$.deep.s_name", "string").alias("s_name"))


@plan("select 'family=' || (s_nationkey % 3) as family, s_suppkey from supplier where s_suppkey % 4 = 2")
def s3_scan_class_family(t: Tables) -> DataFrame:
    rows = io.scan_class_family(t.spark, payload_tree(t), "class=C2", "*.txt")
    return rows.select("family", F.try_variant_get("payload", "$.s_suppkey", "bigint").alias("s_suppkey"))


@plan("select n_nationkey, n_name from nation")
def s4_scan_single_json(t: Tables) -> DataFrame:
    path = scratch(t.spark, "s4")
    one = t.nation.agg(F.to_json(F.struct(F.collect_list(F.struct("n_nationkey", "n_name")).alias("keys"), F.lit(1).alias("more"))).alias("value"))  # 25 rows
    one.write.text(path)
    return io.scan_single_json(t.spark, path, "keys", "n_nationkey int, n_name string")


@plan("""select s_suppkey, s_name || '"}],{[\\ "' as name from supplier""")
def s4_scan_json_elements(t: Tables) -> DataFrame:
    """One document read by ranges of a kilobyte and a half, with brackets and quotes inside its strings."""
    path = scratch(t.spark, "s4")
    row = F.to_json(F.struct("s_suppkey", F.concat("s_name", F.lit('"}],{[\\ "')).alias("name"), F.array(F.lit("]"), F.lit("keys")).alias("more")))
    rows = t.supplier.select(F.lit(1).alias("part"), F.col("s_suppkey").alias("at"), F.concat(row, F.lit(",")).alias("value"))
    ends = t.spark.createDataFrame([(0, 0, '{"other": {"keys": [1, 2]}, "keys" : ['), (2, 0, 'null], "last": [[3]]}')], "part int, at bigint, value string")
    rows.unionByName(ends).coalesce(1).sortWithinPartitions("part", "at").select("value").write.text(path)
    (file,) = t.spark.read.text(path).inputFiles()
    return scan_json_elements(t.spark, file, "keys", 1536).select(F.from_json("value", "s_suppkey bigint, name string").alias("r")).select("r.*").filter("s_suppkey is not null")


@plan("""select 'class=C' || (s_suppkey % 4) as class, count(*) as files, sum(strlen('{"s_suppkey":' || s_suppkey || ',"deep":{"s_name":"' || s_name || '"}}') + 1)::bigint as bytes from supplier group by 1""")
def s5_scan_file_inventory(t: Tables) -> DataFrame:
    files = io.scan_file_inventory(t.spark, payload_tree(t)).filter(F.col("path").endswith(".txt"))
    return files.groupBy(F.regexp_extract("path", "/(class=[^/]+)/", 1).alias("class")).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


@plan("select 'there' as state, count(*) as n from region union all select 'absent', 0")
def s6_scan_optional(t: Tables) -> DataFrame:
    out = None
    for name in ("region", "never"):
        rows, there = io.scan_optional(t.spark, f"{t.sf_dir}/{name}.parquet", "r_regionkey int, r_name string")
        one = rows.agg(F.count("*").alias("n")).select(F.lit("there" if there else "absent").alias("state"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@plan("select n_nationkey, n_name, n_regionkey from nation")
def s7_scan_curated(t: Tables) -> DataFrame:
    return io.scan_curated(t.nation, "n_nationkey", ["n_name", "n_regionkey"], "n_regionkey", t.region, "r_regionkey").select("n_nationkey", "n_name", "n_regionkey")


def places_in_files(spark: SparkSession, path: str) -> DataFrame:
    """value and place, from 1, of every line in the order of the files' names. Spark reads a file in blocks, which several
    tasks may share out in any order, so a line's place is that in its block after the lines of the blocks before."""
    made = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    lines = stored(made, "lines")
    blocks = lines.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("row").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row per block
    return lines.join(blocks.withColumn("before", before), ["file", "block"]).select("value", (F.col("before") + F.col("row") - F.col("first") + 1).alias("place"))


@plan("""with l as (select row_number() over (order by c_custkey)::bigint as place, '{"c_custkey":' || c_custkey || ',"c_mktsegment":"' || c_mktsegment || '"}' as line from customer) select * from l""")
def s8_sink_jsonl_sorted(t: Tables) -> DataFrame:
    """The lines in the order of the files and of each file: their places are those of the total order."""
    path = scratch(t.spark, "s8")
    io.sink_jsonl_sorted(t.customer.select("c_mktsegment", "c_custkey"), path, ["c_custkey"])
    return places_in_files(t.spark, path).select("place", F.col("value").alias("line"))


@plan("select lang, doc_id, n_chars from documents")
def s9_sink_split(t: Tables) -> DataFrame:
    path = scratch(t.spark, "s9")
    io.sink_split(t.documents.select("lang", "doc_id", "n_chars"), path, ["lang"], ["doc_id"])
    return t.spark.read.schema("doc_id bigint, n_chars bigint, lang string").parquet(path).select("lang", "doc_id", "n_chars")


@plan(
    """with h as (select lang, ('0x' || substr(sha256('{"doc_id":' || doc_id || ',"lang":"' || lang || '","n_chars":' || n_chars || '}'), 1, 15))::bigint as h from documents) select lang, count(*) as n, sum(h)::varchar as content from h group by 1"""
)
def s11_content_manifest(t: Tables) -> DataFrame:
    return io.content_manifest(t.documents.select("doc_id", "lang", "n_chars"), ["lang"])


@plan("""select 'n_regionkey=' || n_regionkey as folder, sum(strlen(n_name) + 1)::bigint as length, sha256(string_agg(n_name || chr(10), '' order by n_name)) as sha256 from nation group by 1""")
def s11_file_manifest(t: Tables) -> DataFrame:
    path = scratch(t.spark, "s11")
    t.nation.select("n_name", "n_regionkey").repartition(1).sortWithinPartitions("n_regionkey", "n_name").write.partitionBy("n_regionkey").text(path)
    return io.file_manifest(t.spark, path, "*.txt").select(F.regexp_extract("path", "/(n_regionkey=[^/]+)/", 1).alias("folder"), "length", "sha256")
