"""Canonical payloads and their hashes (F12), chains (P6) and residue classes."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def canonical_json(df: DataFrame, payload: str, into: str = "canonical") -> DataFrame:
    """the payload with sorted keys at every depth, without top-level keys that begin with an underscore.

    The one place where the library needs Python: Spark's JSON keeps the keys' order. Batches go by Arrow. Null stays
    null; what isn't JSON becomes null.
    """
    schema = df.withColumn(into, F.lit("").cast("string")).schema
    schema[into].nullable = True
    at, names = df.columns.index(payload), schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for text in batch.column(at).to_pylist():
                try:
                    value = None if text is None else json.loads(text)
                except ValueError:
                    made.append(None)
                    continue
                if isinstance(value, dict):
                    value = {k: v for k, v in value.items() if not k.startswith("_")}
                made.append(None if text is None else json.dumps(value, sort_keys=True, ensure_ascii=False))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], names=names)

    return df.mapInArrow(run, schema)


def payload_hash(df: DataFrame, payload: str, into: str = "payload_hash") -> DataFrame:
    """sha256 of the canonical payload."""
    made = canonical_json(df, payload, "canonical__")
    return made.withColumn(into, F.sha2("canonical__", 256)).drop("canonical__")


def classify_chain(guid: Column, address: Column, container: Column) -> Column:
    """The first broken step of guid to address to container, or none."""
    return F.when(guid.isNull(), "guid").when(address.isNull(), "address").when(container.isNull(), "container").otherwise("none")


def chosen_address(refs: DataFrame, guid: str, entries: DataFrame, containers: DataFrame) -> DataFrame:
    """Refs with address and chain. Of a guid's addresses (entries: guid, address) the smallest that has a container
    (containers: address) counts, or the smallest if none has; chain is the first broken step."""
    placed = containers.select("address").distinct().withColumn("placed__", F.lit(True))
    by = entries.filter("address is not null").select("guid", "address").distinct().join(placed, "address", "left")
    best = by.groupBy("guid").agg(F.min(F.when(F.col("placed__"), F.col("address"))).alias("held__"), F.min("address").alias("any__"))
    known = entries.select("guid").distinct().withColumn("known__", F.lit(True)).join(best, "guid", "left").withColumnRenamed("guid", "guid__")
    out = refs.join(known, F.col(guid) == F.col("guid__"), "left").withColumn("address", F.coalesce("held__", "any__"))
    return out.withColumn("chain", classify_chain(F.col("known__"), F.col("address"), F.col("held__"))).drop("guid__", "known__", "held__", "any__")


def classify_unjoined(has_literal: Column, has_name: Column, is_internal: Column) -> Column:
    """Why an entity has no localised name."""
    return F.when(is_internal, "internal-kernel").when(has_literal, "english-only-literal").when(~has_name, "no-display-field").otherwise("residue")


def classify_residue(removed: Column, address: Column, scene: Column, editor: Column) -> Column:
    """P10: where an unresolved target went."""
    return F.when(removed, "removed").when(address.isNotNull(), "resolved-address").when(scene, "resolved-scene").when(editor, "editor-only").otherwise("open")
