"""Localisation proofs and the search corpus. Locale is documents.lang, a key is source/bucket, its text the smallest of the cell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weavegraph.operators import corpus as C
from weavegraph.operators import locale as L
from weavegraph.plans.registry import Plans, Tables

plan = Plans()
#: Keys: source and one of nine buckets, so that locales have holes.
TEXTS_SQL = "texts as (select lang as locale, source || '/' || (n_chars % 9)::varchar as key, min(text) as text from documents group by 1, 2)"
TERMS_SQL = "edges as (select distinct 'c' || (doc_id % 3)::varchar as kind, doc_id % 40 as id, source || '/' || (n_chars % 9)::varchar as key from documents)"


def texts(t: Tables) -> DataFrame:
    return t.documents.groupBy(F.col("lang").alias("locale"), F.concat("source", F.lit("/"), (F.col("n_chars") % 9).cast("string")).alias("key")).agg(F.min("text").alias("text"))


def edges(t: Tables) -> DataFrame:
    return t.documents.select(F.concat(F.lit("c"), (F.col("doc_id") % 3).cast("string")).alias("kind"), (F.col("doc_id") % 40).alias("id"), F.concat("source", F.lit("/"), (F.col("n_chars") % 9).cast("string")).alias("key")).distinct()


@plan(f"with {TEXTS_SQL} select key, coalesce(string_agg(locale, ',' order by locale) filter (locale <> 'en'), '') as locales, bool_or(locale = 'en') as in_base from texts group by 1")
def a6_key_locale_matrix(t: Tables) -> DataFrame:
    return L.key_locale_matrix(texts(t), "en")


@plan(f"with {TEXTS_SQL} select locales, count(*) as keys from (select key, count(distinct locale) as locales from texts group by 1) group by 1")
def a7_presence_histogram(t: Tables) -> DataFrame:
    return L.presence_histogram(texts(t))


@plan(
    f"with {TEXTS_SQL}, u as (select count(distinct key) as n from texts), b as (select locale, count(*) as k, count(*) filter (trim(text) = '') as empty_cells from texts group by 1) select locale, k as keys_held, empty_cells, n - k as holes, (20000 * k + n) // (2 * n) as share from b, u"
)
def a8_locale_census(t: Tables) -> DataFrame:
    return L.locale_census(texts(t))


@plan(
    f"with {TEXTS_SQL}, k as (select distinct key from texts), l as (select distinct locale from texts), h as (select locale, key from k, l except select locale, key from texts) select locale, split_part(key, '/', 1) as namespace, count(*) as holes from h group by 1, 2"
)
def a9_hole_namespaces(t: Tables) -> DataFrame:
    return L.hole_namespaces(texts(t))


@plan(
    f"with {TEXTS_SQL} select x.locale, count(*) as shared, count(*) filter (x.text = p.text) as same_text, count(*) filter (x.text = p.text and c.text <> p.text) as comparator_differs from texts x join texts p on p.key = x.key and p.locale = 'en' left join texts c on c.key = x.key and c.locale = 'de' where x.locale <> 'en' group by 1"
)
def a10_identity_to_pivot(t: Tables) -> DataFrame:
    return L.identity_to_pivot(texts(t), "en", "de")


HAVE_SQL = "n as (select kind, id, count(*) as terms from edges group by 1, 2), h as (select kind, id, locale, count(*) as present from edges join texts using (key) group by 1, 2, 3)"


@plan(f"with {TEXTS_SQL}, {TERMS_SQL}, {HAVE_SQL} select kind, locale, count(*) as any_present, count(*) filter (present = terms) as all_present from h join n using (kind, id) group by 1, 2")
def a11_kind_locale_matrix(t: Tables) -> DataFrame:
    return L.kind_locale_matrix(edges(t), texts(t))


@plan(
    f"with {TEXTS_SQL}, {TERMS_SQL}, {HAVE_SQL} select kind, id, terms, coalesce(string_agg(locale, ',' order by locale) filter (present = terms), '') as available, coalesce(string_agg(locale, ',' order by locale) filter (present < terms), '') as partial from n left join h using (kind, id) group by 1, 2, 3"
)
def a12_availability(t: Tables) -> DataFrame:
    return L.availability(edges(t), texts(t))


@plan(
    f"with {TEXTS_SQL}, {TERMS_SQL}, k as (select distinct key from texts), r as (select distinct key from edges) select split_part(k.key, '/', 1) as namespace, count(*) as total, count(r.key) as referenced, count(*) - count(r.key) as free from k left join r using (key) group by 1"
)
def a13_namespace_split(t: Tables) -> DataFrame:
    return L.namespace_split(texts(t), edges(t))


@plan(
    f"""with {TEXTS_SQL}, a as (select key, text as a from texts where locale = 'en'), b as (select key, text as b from texts where locale = 'fr'), n as (select count(*) filter (b is null) as base_only, count(*) filter (a is null) as over_only, count(*) filter (a = b) as equal, count(*) filter (a <> b) as differ from a full join b using (key))
    select *, case when equal + differ = 0 then 'disjoint' when base_only > 0 and over_only > 0 then 'mixed' when over_only > 0 then 'over-base' when base_only > 0 then 'base-over' else 'same keys' end as composition from n"""
)
def p12_classify_composition(t: Tables) -> DataFrame:
    x = texts(t)
    return L.classify_composition(x.filter("locale = 'en'"), x.filter("locale = 'fr'"))


@plan(
    f"""with {TEXTS_SQL}, k as (select distinct key from texts where locale = 'es'), m as (select distinct source, n_chars % 9 as b from documents)
    select m.source, m.b, coalesce(x.key, y.key) as closed_by, case when x.key is not null then 'field' when y.key is not null then 'dev' end as how from m left join k x on x.key = source || '/' || b::varchar left join k y on y.key = source || '/' || ((b + 1) % 9)::varchar"""
)
def c9_miss_closer(t: Tables) -> DataFrame:
    m = t.documents.select("source", (F.col("n_chars") % 9).alias("b")).distinct()
    slash = lambda b: F.concat("source", F.lit("/"), b.cast("string"))
    return L.close_misses(m, texts(t).filter("locale = 'es'"), {"field": slash(F.col("b")), "dev": slash((F.col("b") + 1) % 9)})


@plan("select lang, source, arg_max(md5(text), doc_id) as text, count(*) - 1 as overwrites from documents group by 1, 2")
def n_last_write_wins(t: Tables) -> DataFrame:
    return L.last_write_wins(t.documents.withColumn("h", F.md5("text")), ["lang", "source"], "h", ["doc_id"])


@plan("select source as key from documents where lang = 'en' union select source from documents where lang = 'de' and n_chars > 20000")
def u1_union_of_keys(t: Tables) -> DataFrame:
    d = t.documents
    return d.filter("lang = 'en'").select(F.col("source").alias("key")).union(d.filter("lang = 'de' and n_chars > 20000").select("source")).distinct()


@plan("(select 'left' as side, key from (select distinct l_orderkey as key from lineitem where l_quantity > 45 except select distinct l_orderkey from lineitem where l_discount > 0.05)) union all (select 'right', key from (select distinct l_orderkey as key from lineitem where l_discount > 0.05 except select distinct l_orderkey from lineitem where l_quantity > 45))")
def u2_bidirectional_diff(t: Tables) -> DataFrame:
    a, b = t.lineitem.filter("l_quantity > 45").select(F.col("l_orderkey").alias("key")), t.lineitem.filter("l_discount > 0.05").select(F.col("l_orderkey").alias("key"))
    side = lambda x, y, s: x.distinct().join(y.distinct(), "key", "left_anti").select(F.lit(s).alias("side"), "key")
    return side(a, b, "left").unionByName(side(b, a, "right"))


@plan("select count(*) as n from (select distinct l_partkey from lineitem where l_quantity > 45 intersect select p_partkey from part where p_size < 10)")
def u3_intersection_size(t: Tables) -> DataFrame:
    a = t.lineitem.filter("l_quantity > 45").select(F.col("l_partkey").alias("k")).distinct()
    return a.join(t.part.filter("p_size < 10"), F.col("k") == F.col("p_partkey"), "left_semi").agg(F.count("*").alias("n"))


@plan("select o_orderkey, count(*) filter (l_linenumber > 2) = 0 as subset from orders left join lineitem on l_orderkey = o_orderkey group by 1")
def u4_subset_check(t: Tables) -> DataFrame:
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_set("l_linenumber").alias("ls"))
    return t.orders.select("o_orderkey").join(lines, "o_orderkey", "left").select("o_orderkey", (F.size(F.array_except(F.coalesce("ls", F.array().cast("array<int>")), F.array(F.lit(1), F.lit(2)))) == 0).alias("subset"))


@plan("select 'order' as family, o_orderkey as id, o_orderpriority as label, null::double as size from orders union all select 'part', p_partkey, p_name, p_retailprice from part")
def u5_union_of_families(t: Tables) -> DataFrame:
    a = t.orders.select(F.lit("order").alias("family"), F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("label"))
    b = t.part.select(F.lit("part").alias("family"), F.col("p_partkey").alias("id"), F.col("p_name").alias("label"), F.col("p_retailprice").alias("size"))
    return a.unionByName(b, allowMissingColumns=True)


@plan(
    """select p_partkey, case when p_size > 30 then p_name when p_size > 10 then p_brand else p_type end as name, case when p_size > 30 then 'localised' when p_size > 10 then 'literal' else 'convention' end as basis from part"""
)
def c1_name_waterfall(t: Tables) -> DataFrame:
    names = F.array(F.struct(F.lit("localised").alias("basis"), F.when(F.col("p_size") > 30, F.col("p_name")).alias("name")), F.struct(F.lit("literal").alias("basis"), F.when(F.col("p_size") > 10, F.col("p_brand")).alias("name")), F.struct(F.lit("convention").alias("basis"), F.col("p_type").alias("name")))
    c = t.part.select("p_partkey", F.explode(names).alias("x")).select("p_partkey", "x.basis", "x.name")
    return C.name_waterfall(c, ["p_partkey"], ["localised", "literal", "convention"]).select("p_partkey", "name", "basis")


@plan("select o_custkey as id, case o_orderstatus when 'F' then 'own' when 'O' then 'variant' end as class, string_agg(distinct o_orderpriority, ',' order by o_orderpriority) as names from orders where o_orderstatus in ('F', 'O') group by 1, 2")
def c2_name_pools(t: Tables) -> DataFrame:
    e = t.orders.select(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("path"), F.col("o_orderpriority").alias("name"))
    classes = e.select("path").distinct().filter("path in ('F', 'O')").select("path", F.when(F.col("path") == "F", "own").otherwise("variant").alias("class"))
    return C.name_pools(e, classes)


@plan(
    """with a as (select distinct o_custkey as c, o_orderstatus || ':' || o_orderpriority as x, o_orderstatus as k, o_orderpriority as v from orders), r as (select *, row_number() over (partition by c order by k, v) as rn from a), l as (select c, string_agg(x, ',' order by x) as aliases from r where rn <= 4 group by 1)
    select c_custkey, c_name as name, coalesce(aliases, '') as aliases from customer left join l on c = c_custkey"""
)
def c3_build_documents(t: Tables) -> DataFrame:
    aliases = t.orders.select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderstatus").alias("class"), F.col("o_orderpriority").alias("text"))
    d = C.build_documents(t.customer.select("c_custkey", F.col("c_name").alias("name")), aliases, ["c_custkey"], 4)
    return d.select("c_custkey", "name", F.array_join("aliases", ",").alias("aliases"))


UNIVERSE_SQL = """e as (select 'p' as kind, l_partkey as id from lineitem group by l_partkey having count(*) > 32), ca as (select 'p' as kind, p_partkey as id from part where p_size < 10), cp as (select 'p' as kind, p_partkey as id from part where p_size < 25), al as (select 'p' as kind, p_partkey as id from part), nm as (select 'p' as kind, p_partkey as id from part where p_size % 2 = 0),
na as (select * from e union select * from ca), ex as (select * from na union select * from cp)"""


@plan(f"with {UNIVERSE_SQL} select kind, 'narrow' as which, count(*) as n from na group by 1 union all select kind, 'expanded', count(*) from ex group by 1 union all select kind, 'id_only', count(*) from (select * from al except select * from ex) group by 1 union all select kind, 'description_only', count(*) from (select * from ex except select * from nm) group by 1")
def c10_universe_sets(t: Tables) -> DataFrame:
    p = lambda cond: t.part.filter(cond).select(F.lit("p").alias("kind"), F.col("p_partkey").alias("id"))
    e = t.lineitem.groupBy(F.col("l_partkey").alias("id")).agg(F.count("*").alias("n")).filter("n > 32").select(F.lit("p").alias("kind"), "id")
    return C.universe_sets(e, p("p_size < 10"), p("p_size < 25"), p("true"), p("p_size % 2 = 0"))


SHARD_SQL = """s as (select lang as locale, count(*) as documents, sum(strlen(source))::bigint as title_bytes, sum(strlen(doc_id::varchar) + 1)::bigint as key_bytes, sum(strlen('{"id":' || doc_id::varchar || ',"t":"' || source || '"}') + 1)::bigint as shard_bytes from documents group by 1)"""


@plan(f"with {SHARD_SQL} select *, shard_bytes between 20 * documents and 24 * documents as in_band from s")
def c6_c11_byte_census(t: Tables) -> DataFrame:
    return C.size_band(C.byte_census(t.documents, "lang", "source", "doc_id"), 20, 24)


@plan(
    f"""with {SHARD_SQL}, k as (select source, count(*) as n, count(distinct lang) as k from documents group by 1), o as (select count(*) as documents, count(distinct lang) as locales, count(distinct lang) as kinds, count(distinct doc_id) as keys, (select count(*) filter (n > 1) from k) as repeated_titles, (select count(*) filter (k > 1) from k) as titles_of_kinds, (select sum(n) filter (n > 1) from k) as documents_in_repeats, (select sum(shard_bytes) from s) as shard_bytes from documents),
    m as (select unnest([{{'metric': 'documents.' || locale, 'value': documents::double, 'unit': 'documents'}}, {{'metric': 'title_bytes.' || locale, 'value': title_bytes::double, 'unit': 'bytes'}}, {{'metric': 'key_bytes.' || locale, 'value': key_bytes::double, 'unit': 'bytes'}}, {{'metric': 'shard_bytes.' || locale, 'value': shard_bytes::double, 'unit': 'bytes'}}]) as x from s
    union all select unnest([{{'metric': 'documents', 'value': documents::double, 'unit': 'documents'}}, {{'metric': 'locales', 'value': locales::double, 'unit': 'locales'}}, {{'metric': 'kinds', 'value': kinds::double, 'unit': 'kinds'}}, {{'metric': 'keys', 'value': keys::double, 'unit': 'keys'}}, {{'metric': 'repeated_titles', 'value': repeated_titles::double, 'unit': 'titles'}}, {{'metric': 'titles_of_kinds', 'value': titles_of_kinds::double, 'unit': 'titles'}}, {{'metric': 'documents_in_repeats', 'value': documents_in_repeats::double, 'unit': 'documents'}}, {{'metric': 'shard_bytes', 'value': shard_bytes::double, 'unit': 'bytes'}}]) from o)
    select 'corpus' as report, x.metric as metric, x.value as value, x.unit as unit, 7::bigint as snapshot_id from m"""
)
def c7_corpus_manifest(t: Tables) -> DataFrame:
    return C.corpus_manifest(t.documents, "lang", "lang", "source", "doc_id", 7)


@plan("select 'no order' as reason, c_custkey::varchar as item from customer where c_custkey not in (select o_custkey from orders) union all select 'debt', c_custkey::varchar from customer where c_acctbal < -900")
def c8_open_items(t: Tables) -> DataFrame:
    none = t.customer.join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left_anti")
    return C.open_items({"no order": none, "debt": t.customer.filter("c_acctbal < -900")}, "c_custkey")


@plan("select p_partkey from part where p_brand in ('Brand#11', 'Brand#22') and (p_brand, p_size % 3) in (('Brand#11', 0), ('Brand#22', 1))")
def p19_narrow_carrier(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", F.col("p_brand").alias("kind"), (F.col("p_size") % 3).alias("field"))
    allowed = rows.filter("(kind = 'Brand#11' and field = 0) or (kind = 'Brand#22' and field = 1)").select("kind", "field").distinct()
    return C.narrow_carrier(rows, allowed).select("p_partkey")


@plan(
    r"""with d as (select lang as locale, text, regexp_extract_all(text, '[\p{L}\p{N}_]+') as tk from documents), v as (select locale, count(distinct lower(w)) as vocabulary from (select locale, unnest(tk) as w from d) group by 1)
    select locale, count(*) as n_rows, sum(len(tk))::bigint as tokens, median(len(tk))::double as median_tokens, count(*) filter (regexp_matches(text, '[\x{4E00}-\x{9FFF}\x{3040}-\x{30FF}\x{AC00}-\x{D7A3}]')) as cjk_rows, count(*) filter (not contains(text, ' ')) as no_space_rows,
    count(*) filter (regexp_matches(text, '<[^>]+>')) as tag_rows, count(*) filter (regexp_matches(text, '\{[^{}]+\}')) as placeholder_rows, any_value(vocabulary) as vocabulary from d join v using (locale) group by 1"""
)
def a14_analyzer_census(t: Tables) -> DataFrame:
    return C.analyzer_census(t.documents, "lang", "text")


@plan("select p_brand, p_name, n from (select *, row_number() over (partition by p_brand order by n desc, p_name) as rn from (select p_brand, p_name, count(*) as n from part group by 1, 2 having count(*) > 1)) where rn <= 10")
def a15_collisions(t: Tables) -> DataFrame:
    return C.collisions(t.part, "p_brand", "p_name")


@plan("select count(*) filter (n > 1) as repeated_titles, count(*) filter (k > 1) as titles_of_kinds, coalesce(sum(n) filter (n > 1), 0)::bigint as documents from (select p_name, count(*) as n, count(distinct p_brand) as k from part group by 1)")
def a15_collision_totals(t: Tables) -> DataFrame:
    return C.collision_totals(t.part, "p_brand", "p_name")


@plan(r"select count(distinct tok) as exact, count(distinct lower(tok)) as folded, count(distinct tok) - count(distinct lower(tok)) as merged from (select unnest(regexp_split_to_array(p_name || '-' || upper(p_type) || ' ' || p_type, '[^A-Za-z0-9]+')) as tok from part) where length(tok) >= 2 and not regexp_matches(tok, '^[0-9]+$')")
def a16_alias_volume(t: Tables) -> DataFrame:
    return C.alias_volume(t.part.select(F.concat("p_name", F.lit("-"), F.upper("p_type"), F.lit(" "), "p_type").alias("x")), "x")


@plan("select md5(text) as text, count(*) as keys from documents group by documents.text having count(*) > 1")
def a17_duplicate_texts(t: Tables) -> DataFrame:
    return t.documents.groupBy("text").agg(F.count("*").alias("keys")).filter("keys > 1").select(F.md5("text").alias("text"), "keys")


@plan("""select lang as locale, '{"doc_id":' || doc_id || ',"source":"' || source || '"}' as line from documents""")
def s10_shard_lines(t: Tables) -> DataFrame:
    return C.shard_lines(t.documents, "lang", ["source", "doc_id"])


PLANTED_SQL = f"{TEXTS_SQL}, planted as (select locale, key, case when key like '%/2' then 'same' when key like '%/3' and locale <> 'de' then 'same3' when key like '%/4' and locale = 'fr' then '' else text end as text from texts)"
FIELDS_SQL = "fields as (select distinct 'c' || (doc_id % 3)::varchar as kind, doc_id % 40 as id, source || '/' || (n_chars % 9)::varchar as key, 'f' || (doc_id % 4)::varchar as field from documents), names as (select kind, id, min(key) as key from fields where id % 3 > 0 group by 1, 2)"


def planted(t: Tables) -> DataFrame:
    """Texts of which some are the same in all locales, some in all but one, and some empty."""
    k = F.col("key")
    text = F.when(k.endswith("/2"), "same").when(k.endswith("/3") & (F.col("locale") != "de"), "same3").when(k.endswith("/4") & (F.col("locale") == "fr"), "").otherwise(F.col("text"))
    return texts(t).select("locale", "key", text.alias("text"))


def fields(t: Tables) -> DataFrame:
    d = F.col("doc_id")
    e = t.documents.select(F.concat(F.lit("c"), (d % 3).cast("string")).alias("kind"), (d % 40).alias("id"), F.concat("source", F.lit("/"), (F.col("n_chars") % 9).cast("string")).alias("key"), F.concat(F.lit("f"), (d % 4).cast("string")).alias("field")).distinct()
    return e.withColumn("is_name", F.col("field") == "f0")


def names(t: Tables) -> DataFrame:
    return fields(t).filter("id % 3 > 0").groupBy("kind", "id").agg(F.min("key").alias("key"))


@plan(
    f"with {TEXTS_SQL}, k as (select distinct key from texts), l as (select distinct locale from texts), h as (select locale, key from k, l except select locale, key from texts) select h.locale, h.key, split_part(h.key, '/', 1) as namespace, coalesce((select string_agg(o.locale, ',' order by o.locale) from h o where o.key = h.key and o.locale <> h.locale), '') as also_missing_in from h"
)
def a9_hole_rows(t: Tables) -> DataFrame:
    return L.hole_rows(texts(t)).withColumn("also_missing_in", F.array_join("also_missing_in", ","))


PIVOT_SQL = "j as (select x.*, p.text as p, c.text as c, coalesce(x.text = p.text and p.text <> '', false) as same from planted x left join planted p on p.key = x.key and p.locale = 'en' left join planted c on c.key = x.key and c.locale = 'de')"


@plan(
    f"with {PLANTED_SQL}, {PIVOT_SQL}, e as (select key, bool_and(text is not distinct from p and p is not null) as everywhere from j group by 1) select locale, count(*) as held, count(*) filter (same) as same_text, count(*) filter (same and c is distinct from p) as comparator_differs, count(*) filter (everywhere) as same_everywhere from j join e using (key) group by 1"
)
def a10_identity_profile(t: Tables) -> DataFrame:
    return L.identity_profile(planted(t), "en", "de")


@plan(f"with {PLANTED_SQL}, {PIVOT_SQL} select locale, key from j where same and c is not distinct from p")
def a10_identity_residual(t: Tables) -> DataFrame:
    return L.identity_residual(planted(t), "en", "de")


HELD_SQL = "held as (select * from planted where text <> '')"


@plan(
    f"""with {PLANTED_SQL}, {FIELDS_SQL}, {HELD_SQL}, e as (select distinct kind, id, key from fields), n as (select kind, id, count(*) as terms from e group by 1, 2), h as (select kind, id, locale, count(*) as present from e join held using (key) group by 1, 2, 3),
    c as (select kind, locale, count(*) as any_present, count(*) filter (present = terms) as all_present from h join n using (kind, id) group by 1, 2), s as (select kind, x.locale, count(distinct id) as same from names join held x using (key) join held p on p.key = x.key and p.locale = 'en' where x.locale <> 'en' and x.text = p.text group by 1, 2),
    k as (select kind, count(*) as entities from n group by 1), l as (select distinct locale from texts) select k.kind, l.locale, entities, coalesce(any_present, 0) as any_present, coalesce(all_present, 0) as all_present, coalesce(same, 0) as name_identical,
    (200000 * coalesce(any_present, 0) + entities) // (2 * entities) as any_rate, (200000 * coalesce(all_present, 0) + entities) // (2 * entities) as all_rate from k cross join l left join c on c.kind = k.kind and c.locale = l.locale left join s on s.kind = k.kind and s.locale = l.locale"""
)
def a11_locale_profile(t: Tables) -> DataFrame:
    return L.locale_profile(fields(t), planted(t), names(t), "en")


@plan(
    f"""with {PLANTED_SQL}, {FIELDS_SQL}, {HELD_SQL}, n as (select kind, id, count(distinct key) as terms from fields group by 1, 2), h as (select kind, id, locale, count(distinct key) as present, string_agg(distinct field, '+' order by field) as f, bool_or(field = 'f0') as named from fields join held using (key) group by 1, 2, 3),
    g as (select kind, id, x.locale, bool_or(x.locale <> 'en' and x.text = p.text) as same, true as eff from names join held x using (key) left join held p on p.key = x.key and p.locale = 'en' group by 1, 2, 3), j as (select * from h full join g using (kind, id, locale))
    select n.kind, n.id, coalesce(string_agg(locale, ',' order by locale) filter (present is not null), '') as available, coalesce(string_agg(locale, ',' order by locale) filter (present < terms), '') as partial, coalesce(string_agg(locale, ',' order by locale) filter (named or eff), '') as named,
    coalesce(string_agg(locale, ',' order by locale) filter (same), '') as identity, coalesce(string_agg(locale || ':' || f, ',' order by locale) filter (present is not null), '') as fields from n left join j using (kind, id) group by 1, 2"""
)
def a12_availability_profile(t: Tables) -> DataFrame:
    a = L.availability_profile(fields(t), planted(t), names(t), "en")
    spelled = F.array_sort(F.transform(F.map_entries("fields"), lambda e: F.concat(e["key"], F.lit(":"), F.array_join(e["value"], "+"))))
    return a.select("kind", "id", *[F.array_join(c, ",").alias(c) for c in ("available", "partial", "named", "identity")], F.array_join(spelled, ",").alias("fields"))


@plan("select 'no order' as reason, 'gap' as severity, 'ask' as unblock, c_custkey::varchar as detail, 1::bigint as n from customer where c_custkey not in (select o_custkey from orders) union all select 'debt', 'info', '', null, count(*) from customer where c_acctbal < -900 union all select 'rich', 'gap', '', null, 0")
def c8_ledger_of_items_and_populations(t: Tables) -> DataFrame:
    none = t.customer.join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left_anti")
    parts = {"no order": none, "debt": t.customer.filter("c_acctbal < -900"), "rich": t.customer.filter("c_acctbal > 1e9"), "nobody": t.customer.filter("c_custkey < -1")}
    return C.open_item_ledger(parts, "c_custkey", {"debt": "info"}, {"no order": "ask"}, ("debt", "rich"))


@plan(
    """with d as (select c_custkey as id, n_name as kind from customer join nation on n_nationkey = c_nationkey), t as (select distinct o_custkey as id, o_orderpriority as key, '<b>' || o_orderstatus || '</b> ' as text from orders where o_orderstatus <> 'P'),
    e as (select id, key, min(trim(regexp_replace(text, '<[^>]+>', '', 'g'))) as text from t group by 1, 2), l as (select id, string_agg(key || '=' || text, ',' order by key) as descriptions from e group by 1)
    select c_custkey as id, c_name as name, coalesce(descriptions, '') as descriptions, case when c_custkey % 2 = 0 then 'icon' || (c_custkey % 5) end as sub_name, case when kind = 'FRANCE' then 3 when kind = 'CHINA' then 2 else 0 end as weight,
    case when kind = 'FRANCE' and c_name < 'Customer#000000500' then 'internal' else 'public' end as visibility from customer join d on d.id = c_custkey left join l on l.id = c_custkey"""
)
def c3_search_documents(t: Tables) -> DataFrame:
    kinds = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey")).select(F.col("n_name").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    o = t.orders.select(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("key"), F.when(F.col("o_orderstatus") == "P", "<i></i> ").otherwise(F.concat(F.lit("<b>"), "o_orderstatus", F.lit("</b> "))).alias("text")).distinct()
    told = o.join(kinds.select("kind", "id"), "id")
    icons = kinds.filter("id % 2 = 0").select("kind", "id", F.concat(F.lit("icon"), (F.col("id") % 5).cast("string")).alias("sub_name"), F.lit(None).cast("string").alias("guid"))
    aliases = told.limit(0).select("kind", "id", F.col("key").alias("class"), "text")
    hidden = [f"Customer#{i:09}" for i in range(500)]
    d = C.search_documents(kinds, aliases, told, icons, {"FRANCE": 3, "CHINA": 2}, {"FRANCE": hidden})
    spelled = F.array_join(F.transform("descriptions", lambda x: F.concat(x["key"], F.lit("="), x["text"])), ",")
    return d.select("id", "name", spelled.alias("descriptions"), "icon.sub_name", "weight", "visibility")


@plan(
    """with r as (select p_brand as kind, p_partkey as id, case when p_size % 4 = 0 then p_name when p_size % 4 = 1 then '<b></b>' end as literal, case when p_size % 3 = 0 then 'dev' end as dev, case when p_size % 5 > 0 then 't' || (p_size % 10) end as term, case when p_size > 40 then 'icon' when p_size < 3 then '' end as sub_name from part),
    x as (select 't' || i as key from range(0, 7) g(i)) select kind, count(*) as n_rows, count(*) filter (term is not null or dev is not null) as carriers, count(*) filter (literal is not null and literal <> '<b></b>') as literals, count(dev) as dev_texts, count(term) as terms, count(key) as resolved, count(*) filter (term is not null and key is null) as open, count(*) filter (sub_name = 'icon') as sprites from r left join x on key = term group by 1"""
)
def c4_component_census(t: Tables) -> DataFrame:
    s = F.col("p_size")
    rows = t.part.select(F.col("p_brand").alias("kind"), F.col("p_partkey").alias("id"), F.when(s % 4 == 0, F.col("p_name")).when(s % 4 == 1, "<b></b>").alias("literal"), F.when(s % 3 == 0, "dev").alias("dev"), F.when(s % 5 > 0, F.concat(F.lit("t"), (s % 10).cast("string"))).alias("term"), F.when(s > 40, "icon").when(s < 3, "").alias("sub_name"))
    keys = t.region.limit(1).select(F.explode(F.sequence(F.lit(0), F.lit(9))).alias("i")).select(F.concat(F.lit("t"), F.col("i").cast("string")).alias("key"), F.when(F.col("i") < 7, "text").otherwise("<b> </b>").alias("text"))
    return C.component_census(rows, keys)
