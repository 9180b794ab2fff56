"""Search corpus: names, documents, shards and their censuses."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weavegraph.functions.text import clean_text, id_tokens, is_cjk
from weavegraph.operators.resolve import first_by_priority, top_k


def name_waterfall(candidates: DataFrame, keys: list[str], bases: list[str]) -> DataFrame:
    """The name of the first basis that has one per key. candidates: keys, basis, name; ties to the smaller name."""
    rank = F.coalesce(*[F.when(F.col("basis") == b, F.lit(i)) for i, b in enumerate(bases)])
    live = candidates.filter(F.col("name").isNotNull() & (F.trim("name") != "")).withColumn("r__", rank).filter("r__ is not null")
    return first_by_priority(live, keys, [F.col("r__"), F.col("name")]).drop("r__")


def name_pools(edges: DataFrame, path_class: DataFrame) -> DataFrame:
    """Names by class of the path on which they hang."""
    return edges.join(path_class, "path").groupBy("id", "class").agg(F.array_join(F.array_sort(F.collect_set("name")), ",").alias("names"))


def build_documents(names: DataFrame, aliases: DataFrame, keys: list[str], most: int = 16) -> DataFrame:
    """A document per key: its name and its distinct aliases (class, text) other than the name, the first `most` in order."""
    cut = top_k(aliases.select(*keys, "class", "text").distinct(), keys, [F.col("class"), F.col("text")], most)
    lists = cut.groupBy(*keys).agg(F.array_sort(F.collect_list(F.concat_ws(":", "class", "text"))).alias("aliases"))
    return names.join(lists, keys, "left").withColumn("aliases", F.coalesce("aliases", F.array().cast("array<string>")))


def search_documents(names: DataFrame, aliases: DataFrame, descriptions: DataFrame, icons: DataFrame, weights: dict[str, int], internal: dict[str, list[str]], most: int = 16) -> DataFrame:
    """Whole search documents: build_documents() for kind and id, with descriptions (key and cleaned text, sorted by key, one
    text per key, empty ones left out), icon (sub_name, guid; nulls without one), the weight of the kind, and visibility,
    internal for the names that a kind keeps to itself, else public.

    names: kind, id, name; aliases: kind, id, class, text; descriptions: kind, id, key, text; icons: kind, id, sub_name, guid.
    A document's descriptions are few and are gathered per document.
    """
    keys = ["kind", "id"]
    clean = descriptions.select(*keys, "key", clean_text("text").alias("text")).filter("text <> ''").groupBy(*keys, "key").agg(F.min("text").alias("text"))
    told = clean.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("key", "text"))).alias("descriptions"))
    icon = icons.groupBy(*keys).agg(F.min(F.struct("sub_name", "guid")).alias("icon"))
    out = build_documents(names, aliases, keys, most).join(told, keys, "left").join(icon, keys, "left")
    weight = F.coalesce(*[F.when(F.col("kind") == k, w) for k, w in weights.items()], F.lit(0))
    hidden = reduce(lambda a, b: a | b, [(F.col("kind") == k) & F.col("name").isin(*v) for k, v in internal.items()], F.lit(False))
    out = out.withColumn("descriptions", F.coalesce("descriptions", F.array().cast("array<struct<key:string,text:string>>")))
    return out.withColumn("weight", weight).withColumn("visibility", F.when(hidden, "internal").otherwise("public"))


def component_census(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """C4: what a universe of names is made of, per kind, in one pass over rows (kind, id, literal, dev, term, sub_name): rows,
    narrow carriers (a term or a dev text), plain literals, dev texts, terms, those that resolve among texts (key, text, of
    the pivot) and those that are open, and rows with an icon's name. Texts are cleaned first; empty ones are none."""
    held = texts.filter(clean_text("text") != "").select(F.col("key").alias("term")).distinct().withColumn("held__", F.lit(True))
    there = lambda c: F.coalesce(clean_text(c) != "", F.lit(False))
    term = F.col("term").isNotNull()
    return rows.join(held, "term", "left").groupBy("kind").agg(
        F.count("*").alias("n_rows"),
        F.count_if(term | there("dev")).alias("carriers"),
        F.count_if(there("literal")).alias("literals"),
        F.count_if(there("dev")).alias("dev_texts"),
        F.count_if(term).alias("terms"),
        F.count_if(F.col("held__")).alias("resolved"),
        F.count_if(term & F.col("held__").isNull()).alias("open"),
        F.count_if(there("sub_name")).alias("sprites"),
    )


def analyzer_census(docs: DataFrame, locale: str, text: str) -> DataFrame:
    """Per locale the rows, tokens (runs of letters, digits and underscores), distinct lower-cased tokens, median
    tokens of a row, rows with CJK, without spaces, with tags and with placeholders."""
    tokens = F.regexp_extract_all(F.col(text), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))
    flags = {"cjk_rows": is_cjk("text"), "no_space_rows": ~F.col("text").contains(" "), "tag_rows": F.col("text").rlike("<[^>]+>"), "placeholder_rows": F.col("text").rlike(r"\{[^{}]+\}")}
    d = docs.select(F.col(locale).alias("locale"), F.col(text).alias("text"), tokens.alias("tokens"))
    d = d.select("locale", F.size("tokens").alias("size"), F.array_distinct(F.transform("tokens", F.lower)).alias("own"), *[F.coalesce(c, F.lit(False)).alias(n) for n, c in flags.items()])
    # A row goes on as itself, without a word, and as each of its words; so texts are read and cut once.
    itself = F.concat(F.array(F.lit(None).cast("string")), F.coalesce("own", F.array().cast("array<string>")))
    each, row = d.withColumn("w", F.explode(itself)), F.col("w").isNull()
    by = each.groupBy("locale", "w", F.when(row, F.col("size")).alias("size")).agg(F.count("*").alias("n"), *[F.count_if(row & F.col(c)).alias(c) for c in flags])
    rows = F.when(row, F.col("n"))
    return by.groupBy("locale").agg(
        F.sum(rows).alias("n_rows"),
        F.sum(F.col("size") * F.col("n")).alias("tokens"),
        F.percentile("size", 0.5, F.coalesce(rows, F.lit(0))).alias("median_tokens"),
        *[F.sum(c).alias(c) for c in flags],
        F.count("w").alias("vocabulary"),
    )


def collisions(docs: DataFrame, kind: str, title: str, k: int = 10) -> DataFrame:
    """Titles that several documents of a kind have, the k most frequent of each kind."""
    many = docs.groupBy(kind, title).agg(F.count("*").alias("n")).filter("n > 1")
    return top_k(many, [kind], [F.col("n").desc(), F.col(title)], k)


def collision_totals(docs: DataFrame, kind: str, title: str) -> DataFrame:
    """Titles used more than once, with more than one kind, and documents in them."""
    by = docs.groupBy(title).agg(F.count("*").alias("n"), F.countDistinct(kind).alias("kinds"))
    return by.agg(F.count_if(F.col("n") > 1).alias("repeated_titles"), F.count_if(F.col("kinds") > 1).alias("titles_of_kinds"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("documents"))


def alias_volume(ids: DataFrame, column: str) -> DataFrame:
    """Distinct id tokens as they are and folded, and how many folding merges."""
    t = ids.select(F.explode(id_tokens(column, lowercase=False)).alias("token"))
    return t.agg(F.countDistinct("token").alias("exact"), F.countDistinct(F.lower("token")).alias("folded")).withColumn("merged", F.col("exact") - F.col("folded"))


def universe_sets(edges: DataFrame, carriers: DataFrame, capable: DataFrame, everything: DataFrame, named: DataFrame) -> DataFrame:
    """Sizes per kind of the narrow universe (edges and carriers), the expanded (and capable), id-only and description-only. All have kind and id."""
    key = ["kind", "id"]
    narrow = edges.select(*key).union(carriers.select(*key)).distinct()
    expanded = narrow.union(capable.select(*key)).distinct()
    sets = {"narrow": narrow, "expanded": expanded, "id_only": everything.select(*key).distinct().join(expanded, key, "left_anti"), "description_only": expanded.join(named.select(*key).distinct(), key, "left_anti")}
    out = None
    for name, df in sets.items():
        one = df.select("kind", F.lit(name).alias("which"))
        out = one if out is None else out.unionByName(one)
    return out.groupBy("kind", "which").agg(F.count("*").alias("n"))


def byte_census(docs: DataFrame, locale: str, title: str, key: str) -> DataFrame:
    """C11: bytes of titles, of key lines and of the JSON lines of documents, per locale."""
    line = F.octet_length(F.to_json(F.struct(F.col(key).alias("id"), F.col(title).alias("t")))) + 1
    return docs.groupBy(F.col(locale).alias("locale")).agg(F.count("*").alias("documents"), F.sum(F.octet_length(title)).alias("title_bytes"), F.sum(F.octet_length(F.col(key).cast("string")) + 1).alias("key_bytes"), F.sum(line).alias("shard_bytes"))


def size_band(census: DataFrame, low: int, high: int) -> DataFrame:
    """Whether each shard's bytes lie between low and high for a document."""
    return census.withColumn("in_band", (F.col("shard_bytes") >= low * F.col("documents")) & (F.col("shard_bytes") <= high * F.col("documents")))


def metrics(report: str, df: DataFrame, snapshot: int, units: dict[str, str]) -> DataFrame:
    """The counters of a one-row frame as rows (report, metric, value, unit, snapshot_id)."""
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"), F.lit(u).alias("unit")) for m, u in units.items()])
    return df.select(F.lit(report).alias("report"), F.explode(rows).alias("m"), F.lit(snapshot).cast("bigint").alias("snapshot_id")).select("report", "m.metric", "m.value", "m.unit", "snapshot_id")


def corpus_manifest(docs: DataFrame, locale: str, kind: str, title: str, key: str, snapshot: int) -> DataFrame:
    """All counters of a corpus as rows (report, metric, value, unit, snapshot_id): per locale its documents and bytes,
    over all its documents, locales, kinds, keys, repeated titles and the bytes of all shards."""
    census = byte_census(docs, locale, title, key)
    names = {"documents": "documents", "title_bytes": "bytes", "key_bytes": "bytes", "shard_bytes": "bytes"}
    each = F.array(*[F.struct(F.concat(F.lit(f"{m}."), F.col("locale")).alias("metric"), F.col(m).cast("double").alias("value"), F.lit(u).alias("unit")) for m, u in names.items()])
    by_locale = census.select(F.explode(each).alias("m")).select(F.lit("corpus").alias("report"), "m.*", F.lit(snapshot).cast("bigint").alias("snapshot_id"))
    whole = docs.agg(F.count("*").alias("documents"), F.countDistinct(locale).alias("locales"), F.countDistinct(kind).alias("kinds"), F.countDistinct(key).alias("keys"))
    repeats = collision_totals(docs, kind, title).select("repeated_titles", "titles_of_kinds", F.col("documents").alias("documents_in_repeats"))
    size = census.agg(F.sum("shard_bytes").alias("shard_bytes"))
    units = {"documents": "documents", "locales": "locales", "kinds": "kinds", "keys": "keys", "repeated_titles": "titles", "titles_of_kinds": "titles", "documents_in_repeats": "documents", "shard_bytes": "bytes"}
    one = whole.crossJoin(F.broadcast(repeats)).crossJoin(F.broadcast(size))  # a row each
    return by_locale.unionByName(metrics("corpus", one, snapshot, units))


def open_items(parts: dict[str, DataFrame], item: str) -> DataFrame:
    """One row per open item, with the reason that its part stands for."""
    out = None
    for reason, df in parts.items():
        one = df.select(F.lit(reason).alias("reason"), F.col(item).cast("string").alias("item"))
        out = one if out is None else out.unionByName(one)
    return out


def open_item_ledger(parts: dict[str, DataFrame], item: str, severity: dict[str, str], unblock: dict[str, str], populations: tuple[str, ...] = ()) -> DataFrame:
    """The ledger of open items: reason, severity, unblock, detail and n. A part is a row per item (n is 1), or, if it is a
    population, one row with its number of items, also if that is none; other parts without items have no row."""
    out = None
    for reason, df in parts.items():
        one = df.agg(F.lit(None).cast("string").alias("detail"), F.count("*").alias("n")) if reason in populations else df.select(F.col(item).cast("string").alias("detail"), F.lit(1).cast("bigint").alias("n"))
        one = one.select(F.lit(reason).alias("reason"), F.lit(severity.get(reason, "gap")).alias("severity"), F.lit(unblock.get(reason, "")).alias("unblock"), "detail", "n")
        out = one if out is None else out.unionByName(one)
    return out


def narrow_carrier(rows: DataFrame, allowed: DataFrame) -> DataFrame:
    """Rows (kind, field, ...) whose field is one of their kind's name fields."""
    return rows.join(allowed, ["kind", "field"], "left_semi")


def shard_lines(docs: DataFrame, locale: str, columns: list[str]) -> DataFrame:
    """The JSON line of every document beside its locale, columns in sorted order."""
    return docs.select(F.col(locale).alias("locale"), F.to_json(F.struct(*sorted(columns))).alias("line"))

