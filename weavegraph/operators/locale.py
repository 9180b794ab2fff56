"""Localisation proofs over a long key-to-text table (locale, key, text): A6-A13, P12, C9, U1-U5."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weavegraph.functions.text import ratio_half_up


def key_locale_matrix(texts: DataFrame, base: str) -> DataFrame:
    """Per key its locales other than base, sorted, and whether base has it."""
    return texts.groupBy("key").agg(F.array_join(F.array_sort(F.collect_set(F.when(F.col("locale") != base, F.col("locale")))), ",").alias("locales"), F.bool_or(F.col("locale") == base).alias("in_base"))


def presence_histogram(texts: DataFrame) -> DataFrame:
    """How many keys have how many locales."""
    return texts.groupBy("key").agg(F.countDistinct("locale").alias("locales")).groupBy("locales").agg(F.count("*").alias("keys"))


def locale_census(texts: DataFrame) -> DataFrame:
    """Per locale its rows, empty cells, and holes against the universe of all keys, with the share in hundredths of a percent."""
    keys = texts.agg(F.countDistinct("key").alias("universe"))
    by = texts.groupBy("locale").agg(F.countDistinct("key").alias("keys_held"), F.count_if(F.coalesce(F.trim("text"), F.lit("")) == "").alias("empty_cells"))
    out = by.crossJoin(F.broadcast(keys))  # one row
    return out.select("locale", "keys_held", "empty_cells", (F.col("universe") - F.col("keys_held")).alias("holes"), ratio_half_up("keys_held", "universe", 4).alias("share"))


def holes(texts: DataFrame) -> DataFrame:
    """(locale, key) that a locale lacks of the universe of keys."""
    held = texts.select("locale", "key").distinct()
    locales = held.groupBy("key").agg(F.collect_set("locale").alias("held"))
    every = held.agg(F.collect_set("locale").alias("all_locales"))
    missing = locales.crossJoin(F.broadcast(every)).select("key", F.explode(F.array_except("all_locales", "held")).alias("locale"))
    return missing.select("locale", "key")


def hole_namespaces(texts: DataFrame, separator: str = "/") -> DataFrame:
    """Holes by the key's first segment."""
    return holes(texts).groupBy("locale", F.substring_index("key", separator, 1).alias("namespace")).agg(F.count("*").alias("holes"))


def identity_to_pivot(texts: DataFrame, pivot: str, comparator: str) -> DataFrame:
    """A10: per locale the keys shared with the pivot, of these those with the pivot's very text, and of these those where the comparator's differs."""
    p = texts.filter(F.col("locale") == pivot).select("key", F.col("text").alias("pivot_text"))
    c = texts.filter(F.col("locale") == comparator).select("key", F.col("text").alias("other_text"))
    j = texts.filter(F.col("locale") != pivot).join(p, "key").join(c, "key", "left")
    same = F.col("text") == F.col("pivot_text")
    return j.groupBy("locale").agg(F.count("*").alias("shared"), F.count_if(same).alias("same_text"), F.count_if(same & (F.col("other_text") != F.col("pivot_text"))).alias("comparator_differs"))


def kind_locale_matrix(edges: DataFrame, texts: DataFrame) -> DataFrame:
    """Edges (kind, id, key) against texts: per kind and locale the entities with any and with all of their terms present."""
    need = edges.select("kind", "id", "key").distinct()
    total = need.groupBy("kind", "id").agg(F.count("*").alias("terms"))
    have = need.join(texts.select("locale", "key").distinct(), "key").groupBy("kind", "id", "locale").agg(F.count("*").alias("present"))
    return have.join(total, ["kind", "id"]).groupBy("kind", "locale").agg(F.count("*").alias("any_present"), F.count_if(F.col("present") == F.col("terms")).alias("all_present"))


def availability(edges: DataFrame, texts: DataFrame) -> DataFrame:
    """Per entity the locales with all, and with only some, of its terms."""
    need = edges.select("kind", "id", "key").distinct()
    total = need.groupBy("kind", "id").agg(F.count("*").alias("terms"))
    have = need.join(texts.select("locale", "key").distinct(), "key").groupBy("kind", "id", "locale").agg(F.count("*").alias("present")).join(total, ["kind", "id"])
    whole = F.col("present") == F.col("terms")
    lists = have.groupBy("kind", "id").agg(F.array_join(F.array_sort(F.collect_list(F.when(whole, F.col("locale")))), ",").alias("available"), F.array_join(F.array_sort(F.collect_list(F.when(~whole, F.col("locale")))), ",").alias("partial"))
    return total.join(lists, ["kind", "id"], "left").fillna("", ["available", "partial"])


def hole_rows(texts: DataFrame, separator: str = "/") -> DataFrame:
    """A row per hole: locale, key, namespace and also_missing_in, the other locales that lack the key, sorted."""
    held = texts.select("locale", "key").distinct()
    every = held.agg(F.collect_set("locale").alias("all_locales"))
    missing = held.groupBy("key").agg(F.collect_set("locale").alias("held")).crossJoin(F.broadcast(every))  # one row
    missing = missing.select("key", F.array_sort(F.array_except("all_locales", "held")).alias("missing")).select("key", "missing", F.explode("missing").alias("locale"))
    return missing.select("locale", "key", F.substring_index("key", separator, 1).alias("namespace"), F.array_remove("missing", F.col("locale")).alias("also_missing_in"))


def _against_pivot(texts: DataFrame, pivot: str, comparator: str) -> DataFrame:
    """Every text with the pivot's and the comparator's of its key, and whether it is the pivot's, byte for byte; an empty pivot text is none."""
    side = lambda locale, name: texts.filter(F.col("locale") == locale).select("key", F.col("text").alias(name))
    j = texts.join(side(pivot, "pivot__"), "key", "left").join(side(comparator, "other__"), "key", "left")
    return j.withColumn("same__", F.coalesce((F.col("text") == F.col("pivot__")) & (F.col("pivot__") != ""), F.lit(False))).withColumn("differs__", ~F.col("other__").eqNullSafe(F.col("pivot__")))


def identity_profile(texts: DataFrame, pivot: str, comparator: str) -> DataFrame:
    """A10: per locale: keys held, of these with the pivot's very text, of these those on which the comparator differs (or has
    none), and keys held whose text is the pivot's in every locale that holds them."""
    j = _against_pivot(texts, pivot, comparator)
    everywhere = j.groupBy("key").agg(F.bool_and(F.col("text").eqNullSafe(F.col("pivot__")) & F.col("pivot__").isNotNull()).alias("everywhere__"))
    return j.join(everywhere, "key").groupBy("locale").agg(
        F.count("*").alias("held"), F.count_if("same__").alias("same_text"), F.count_if(F.col("same__") & F.col("differs__")).alias("comparator_differs"), F.count_if("everywhere__").alias("same_everywhere")
    )


def identity_residual(texts: DataFrame, pivot: str, comparator: str) -> DataFrame:
    """A10: (locale, key) of the keys with the pivot's very text on which the comparator doesn't differ either."""
    return _against_pivot(texts, pivot, comparator).filter("same__ and not differs__").select("locale", "key")


def locale_profile(edges: DataFrame, texts: DataFrame, names: DataFrame, pivot: str) -> DataFrame:
    """Per kind and locale: entities, those with any and with all of their terms, those whose name is the pivot's very
    text, and the rates of the first two in hundred-thousandths, half up. edges: kind, id, key; names: kind, id, key of an
    entity's effective name. Every kind has a row for every locale, zeros included; empty texts aren't there."""
    held = texts.filter("text <> ''").select("locale", "key", "text")
    need = edges.select("kind", "id", "key").distinct()
    total = need.groupBy("kind", "id").agg(F.count("*").alias("terms"))
    have = need.join(held.select("locale", "key").distinct(), "key").groupBy("kind", "id", "locale").agg(F.count("*").alias("present")).join(total, ["kind", "id"])
    counts = have.groupBy("kind", "locale").agg(F.count("*").alias("any_present"), F.count_if(F.col("present") == F.col("terms")).alias("all_present"))
    mine = names.select("kind", "id", "key").join(held, "key")
    p = held.filter(F.col("locale") == pivot).select("key", F.col("text").alias("pivot__"))
    same = mine.join(p, "key").filter((F.col("locale") != pivot) & (F.col("text") == F.col("pivot__"))).groupBy("kind", "locale").agg(F.countDistinct("id").alias("name_identical"))
    kinds = total.groupBy("kind").agg(F.count("*").alias("entities"))
    cells = kinds.crossJoin(F.broadcast(texts.agg(F.collect_set("locale").alias("l")))).select("kind", "entities", F.explode("l").alias("locale"))  # one row
    out = cells.join(counts, ["kind", "locale"], "left").join(same, ["kind", "locale"], "left").fillna(0, ["any_present", "all_present", "name_identical"])
    return out.select("*", ratio_half_up("any_present", "entities", 5).alias("any_rate"), ratio_half_up("all_present", "entities", 5).alias("all_rate"))


def availability_profile(edges: DataFrame, texts: DataFrame, names: DataFrame, pivot: str) -> DataFrame:
    """Per entity (kind, id): the locales with any of its terms (available), of these those that lack some (partial),
    those with any of its names (named), those other than the pivot whose effective name is the pivot's very text
    (identity), and fields, a map of each available locale to the fields whose terms it has. All are sorted arrays.

    edges: kind, id, key, field, is_name; names: kind, id, key, the effective name, which counts as one beside the edges'.
    """
    held = texts.filter("text <> ''").select("locale", "key", "text")
    every = edges.select("kind", "id", "key", "field", "is_name")
    terms = every.groupBy("kind", "id").agg(F.countDistinct("key").alias("terms"))
    here = every.join(held, "key").groupBy("kind", "id", "locale").agg(F.countDistinct("key").alias("present"), F.array_sort(F.collect_set("field")).alias("fields"), F.bool_or("is_name").alias("named"))
    p = held.filter(F.col("locale") == pivot).select("key", F.col("text").alias("pivot__"))
    effective = names.select("kind", "id", "key").join(held, "key").join(p, "key", "left")
    effective = effective.groupBy("kind", "id", "locale").agg(F.lit(True).alias("effective"), F.bool_or((F.col("locale") != pivot) & F.coalesce(F.col("text") == F.col("pivot__"), F.lit(False))).alias("same"))
    each = terms.join(here.join(effective, ["kind", "id", "locale"], "full"), ["kind", "id"], "left")
    there = F.col("present").isNotNull()
    of = lambda condition: F.array_sort(F.collect_list(F.when(F.coalesce(condition, F.lit(False)), F.col("locale"))))
    pairs = F.array_sort(F.collect_list(F.when(there, F.struct(F.col("locale").alias("k"), F.col("fields").alias("v")))))
    return each.groupBy("kind", "id").agg(
        of(there).alias("available"), of(F.col("present") < F.col("terms")).alias("partial"), of(F.coalesce("named", F.lit(False)) | F.col("effective")).alias("named"), of(F.col("same")).alias("identity"), F.map_from_entries(pairs).alias("fields")
    )


def namespace_split(texts: DataFrame, referenced: DataFrame, separator: str = "/") -> DataFrame:
    """Keys by first segment: total, referenced and free."""
    keys = texts.select("key").distinct().join(referenced.select("key").distinct().withColumn("used", F.lit(True)), "key", "left")
    return keys.groupBy(F.substring_index("key", separator, 1).alias("namespace")).agg(F.count("*").alias("total"), F.count_if(F.coalesce("used", F.lit(False))).alias("referenced"), F.count_if(F.col("used").isNull()).alias("free"))


def classify_composition(base: DataFrame, over: DataFrame) -> DataFrame:
    """Two key-to-text tables in one row: keys only in either, equal and differing texts, and the name of what that is."""
    j = base.select("key", F.col("text").alias("a")).join(over.select("key", F.col("text").alias("b")), "key", "full")
    n = j.agg(
        F.count_if(F.col("b").isNull()).alias("base_only"), F.count_if(F.col("a").isNull()).alias("over_only"), F.count_if(F.col("a") == F.col("b")).alias("equal"), F.count_if(F.col("a") != F.col("b")).alias("differ")
    )
    name = F.when((F.col("equal") + F.col("differ")) == 0, "disjoint").when((F.col("base_only") > 0) & (F.col("over_only") > 0), "mixed").when(F.col("over_only") > 0, "over-base").when(F.col("base_only") > 0, "base-over").otherwise("same keys")
    return n.withColumn("composition", name)


def close_misses(misses: DataFrame, keys: DataFrame, candidates: dict[str, F.Column]) -> DataFrame:
    """The first candidate key of a miss that exists, and which it was."""
    known = keys.select("key").distinct()
    out = misses
    for i, c in enumerate(candidates.values()):
        out = out.join(known.withColumnRenamed("key", f"k{i}__"), c == F.col(f"k{i}__"), "left")
    found = [F.col(f"k{i}__") for i in range(len(candidates))]
    how = F.coalesce(*[F.when(k.isNotNull(), F.lit(n)) for n, k in zip(candidates, found, strict=True)])
    return out.withColumn("closed_by", F.coalesce(*found)).withColumn("how", how).drop(*[f"k{i}__" for i in range(len(candidates))])


def last_write_wins(rows: DataFrame, keys: list[str], text: str, order: list[str]) -> DataFrame:
    """Duplicate keys in text tables: the last in order stays, overwrites are counted."""
    return rows.groupBy(*keys).agg(F.max_by(text, F.struct(*order)).alias("text"), (F.count("*") - 1).alias("overwrites"))
