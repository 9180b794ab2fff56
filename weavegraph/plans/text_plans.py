"""Text functions F1-F20 and projections P5-P25 on parts, pages and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weavegraph.functions import text as X
from weavegraph.operators import project as P
from weavegraph.plans.registry import Plans, Tables

plan = Plans()
LOCALES = {"en": "english", "de": "german", "fr": "french"}


@plan(
    r"""select page_id, regexp_replace(lower(split_part(regexp_replace(regexp_replace(regexp_replace(list_last(string_split(url, '/')), '^(\{[^}]*\}([^.?]))', '\2'), '^\{([^}]*)\}', '\1'), '[{}]', '', 'g'), '?', 1)), '\.bundle$', '') as ref_key,
    list_last(string_split(url, '/')) as base, nullif(regexp_replace(list_last(string_split(url, '/')), '\.[^.]*$', ''), '') as stem from pages"""
)
def f1_normalize_ref(t: Tables) -> DataFrame:
    return t.pages.select("page_id", X.normalize_ref("url").alias("ref_key"), X.basename("url").alias("base"), X.address_basename("url").alias("stem"))


@plan(r"select doc_id, nullif(regexp_extract(source || '_' || md5(text), '^(.+)_[0-9a-f]{32}$', 1), '') as stripped, nullif(regexp_extract(source, '^(.+)_[0-9a-f]{32}$', 1), '') as none_stripped from documents")
def f2_strip_hash_suffix(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.strip_hash_suffix(F.concat_ws("_", "source", F.md5("text"))).alias("stripped"), X.strip_hash_suffix("source").alias("none_stripped"))


@plan(r"select p_partkey, replace(p_name, ' ', '_') as base, -p_partkey as path_id from part")
def f3_parse_stem(t: Tables) -> DataFrame:
    stem = F.concat(F.translate("p_name", " ", "_"), F.lit("_"), (-F.col("p_partkey")).cast("string"), F.lit(".json"))
    return t.part.select("p_partkey", X.parse_stem(stem).alias("s")).select("p_partkey", "s.base", "s.path_id")


@plan(
    r"""with n as (select doc_id, case lang when 'de' then 'dlc-a-' when 'fr' then 'dlc-b-' else '' end || case when doc_id % 2 = 0 then substr(md5(source), 1, 16) || '_' else '' end || source || case doc_id % 3 when 0 then '_assets_all' when 1 then '.unity' else '' end as stem, lang from documents)
    select doc_id, regexp_replace(regexp_replace(case when lang in ('de', 'fr') then substr(stem, 7) else stem end, '^[0-9a-f]{16,}_', ''), '(_assets_all|\.unity)$', '') as family,
    case lang when 'de' then 'dlc-a' when 'fr' then 'dlc-b' else 'base' end as axis, doc_id % 2 = 0 as hash_named, case when doc_id % 3 = 1 then '.unity' else 'none' end as scene from n"""
)
def f4_split_family(t: Tables) -> DataFrame:
    axis = F.when(F.col("lang") == "de", "dlc-a-").when(F.col("lang") == "fr", "dlc-b-").otherwise("")
    hashed = F.when(F.col("doc_id") % 2 == 0, F.concat(F.substring(F.md5("source"), 1, 16), F.lit("_"))).otherwise("")
    end = F.when(F.col("doc_id") % 3 == 0, "_assets_all").when(F.col("doc_id") % 3 == 1, ".unity").otherwise("")
    d = t.documents.select("doc_id", F.concat(axis, hashed, F.col("source"), end, F.lit(".bundle")).alias("name"))
    d = d.withColumn("f", X.family_of("name", ["dlc-a", "dlc-b"], [".unity", "_assets_all"]))
    return d.select("doc_id", "f.*", X.scene_flag("name", ".unity", "scenes-").alias("scene"))


@plan(
    r"""select page_id, lower(list_last(string_split(regexp_replace(regexp_replace(u, '^archive:/', ''), '^assets/', ''), '/'))) as match_key, not starts_with(u, 'archive:') as builtin
    from (select page_id, case when page_id % 2 = 0 then 'archive:/' else '' end || url as u from pages)"""
)
def f6_externals(t: Tables) -> DataFrame:
    d = t.pages.select("page_id", F.concat(F.when(F.col("page_id") % 2 == 0, "archive:/").otherwise(""), "url").alias("u"))
    return d.select("page_id", X.simplify_external("u").alias("match_key"), X.builtin_external("u").alias("builtin"))


@plan(r"select page_id, md5(trim(regexp_replace(regexp_replace(html, '\{[^{}]+\}', '', 'g'), '<[^>]+>', '', 'g'), ' ')) as cleaned, length(trim(regexp_replace(regexp_replace(html, '\{[^{}]+\}', '', 'g'), '<[^>]+>', '', 'g'), ' '))::bigint as n from pages")
def f7_clean_text(t: Tables) -> DataFrame:
    c = X.clean_text("html")
    return t.pages.select("page_id", F.md5(c).alias("cleaned"), F.length(c).cast("bigint").alias("n"))


@plan(
    r"""select p_partkey, array_to_string(list_sort(list_distinct(list_transform(list_filter(regexp_split_to_array(p_name || '-' || p_brand || ' ' || p_type, '[^A-Za-z0-9]+'), lambda p: length(p) >= 2 and not regexp_matches(p, '^[0-9]+$')), lambda p: lower(p)))), ',') as tokens from part"""
)
def f8_id_tokens(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.array_join(X.id_tokens(F.concat("p_name", F.lit("-"), "p_brand", F.lit(" "), "p_type")), ",").alias("tokens"))


@plan(
    r"""with b as (select p_partkey, regexp_replace(replace(p_type, ' ', '_'), '_Long$', '') as bare from part),
    f as (select p_partkey, bare, list_last(string_split(bare, '_')) as last from b),
    g as (select p_partkey, unnest([{'o': 1, 'form': bare, 'method': 'family'}, {'o': 2, 'form': case when bare like '%s' then bare[:-2] else bare || 's' end, 'method': 'plural-fold'}, {'o': 3, 'form': last, 'method': 'last-segment'}, {'o': 4, 'form': case when last like '%s' then last[:-2] else last || 's' end, 'method': 'plural-fold'}]) as x from f)
    select p_partkey, x.form as form, arg_min(x.method, x.o) as method from g where x.form <> '' group by 1, 2"""
)
def f9_candidate_forms(t: Tables) -> DataFrame:
    forms = X.candidate_forms(F.translate("p_type", " ", "_"), ["Course_"], "_Long")
    return t.part.select("p_partkey", F.explode(forms).alias("x")).select("p_partkey", "x.form", "x.method")


@plan(r"select p_partkey, array_to_string(list_sort(list_distinct(list_filter([case when p_brand = 'Brand#11' then 'First' when contains(lower(p_brand), 'brand#11') then 'First' end, case when contains(lower(p_brand), 'brand') then replace(p_brand, 'Brand', 'Make') end], lambda x: x is not null))), ',') as forms from part")
def f10_token_rewrite(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.array_join(F.array_sort(X.token_rewrite("p_brand", [("Brand#11", "First"), ("brand", "Make")])), ",").alias("forms"))


@plan(r"select p_partkey, lower(regexp_replace(trim(p_name), '[\s-]+', '_', 'g')) as name_key from part")
def f11_norm_name(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", X.norm_name("p_name").alias("name_key"))


@plan(
    r"""with c as (select o_orderpriority, count(*) as d, count(*) filter (o_orderstatus = 'F') as n from orders group by 1)
    select o_orderpriority, n, d, (200000 * n + d) // (2 * d) as rate5, ((20000 * n + d) // (2 * d)) // 100 || '.' || lpad((((20000 * n + d) // (2 * d)) % 100)::varchar, 2, '0') || '%' as pct from c"""
)
def f13_percent(t: Tables) -> DataFrame:
    c = t.orders.groupBy("o_orderpriority").agg(F.count("*").alias("d"), F.count_if(F.col("o_orderstatus") == "F").alias("n"))
    return c.select("o_orderpriority", "n", "d", X.ratio_half_up("n", "d", 5).alias("rate5"), X.percent("n", "d").alias("pct"))


@plan(
    r"""with k as (select lang, min(source || '/' || lang || '/' || doc_id) as lo, max(source || '/' || lang || '/' || doc_id) as hi, min(lang || '/x/' || source) as lo2, max(lang || '/x/' || source) as hi2 from documents group by 1)
    select lang, case when string_split(lo, '/')[1] = string_split(hi, '/')[1] then string_split(lo, '/')[1] else '' end as across, lang || '/x' as within from k"""
)
def f14_common_namespace(t: Tables) -> DataFrame:
    a, b = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")), F.concat_ws("/", "lang", F.lit("x"), "source")
    k = t.documents.groupBy("lang").agg(F.min(a).alias("a0"), F.max(a).alias("a1"), F.min(b).alias("b0"), F.max(b).alias("b1"))
    return k.select("lang", X.common_namespace("a0", "a1").alias("across"), X.common_namespace("b0", "b1").alias("within"))


@plan(r"select lang, count(*) filter (doc_id % 4 < 3) as cjk, count(*) as n from documents group by 1")
def f15_is_cjk(t: Tables) -> DataFrame:
    """Texts with a Han, Kana or Hangul letter behind three in four of them."""
    k = F.col("doc_id") % 4
    added = F.when(k == 0, "漢").when(k == 1, "か").when(k == 2, "한").otherwise("é")
    return t.documents.groupBy("lang").agg(F.count_if(X.is_cjk(F.concat("text", added))).alias("cjk"), F.count("*").alias("n"))


@plan(r"""select page_id, coalesce(nullif(regexp_replace(regexp_replace(url, '[<>:"/\\|?*\x00-\x1f]', '_', 'g'), '[ .]+$', ''), ''), '_unnamed') as safe, 'web/icons/' || coalesce(nullif(regexp_replace(regexp_replace(url, '[<>:"/\\|?*\x00-\x1f]', '_', 'g'), '[ .]+$', ''), ''), '_unnamed') || '.webp' as path from pages""")
def f16_sanitize(t: Tables) -> DataFrame:
    return t.pages.select("page_id", X.sanitize_component("url").alias("safe"), X.emitted_path("url", "web/icons", "webp").alias("path"))


@plan("select doc_id, case lang when 'en' then 'english' when 'de' then 'german' when 'fr' then 'french' end as locale, case when lang in ('en', 'de') then 'word' else 'other' end as tokenizer from documents")
def f17_f19_lookup(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.lookup("lang", LOCALES).alias("locale"), X.lookup("lang", {"en": "word", "de": "word"}, F.lit("other")).alias("tokenizer"))


@plan("select l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, l_discount = l_tax and (l_discount <> 0 or true) as same, l_discount = 0 as zeros_differ from lineitem")
def f18_numbers_equal(t: Tables) -> DataFrame:
    zeros = (F.col("l_discount") == 0) & ~X.numbers_equal(F.lit(0.0), -F.abs(F.col("l_discount")))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", X.numbers_equal("l_discount", "l_tax").alias("same"), zeros.alias("zeros_differ"))


@plan("select n_nationkey, case when n_regionkey = 0 then n_name else r_name || '.' || n_name end as full_name from nation join region on r_regionkey = n_regionkey")
def f20_full_type_name(t: Tables) -> DataFrame:
    ns = F.when(F.col("n_regionkey") == 0, "").otherwise(F.col("r_name"))
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", X.full_type_name(ns, "n_name").alias("full_name"))


@plan("select event_id, coalesce(nullif(trim(case when event_type = 'click' then ' ' else event_type end), ''), user_id::varchar) as id, case when trim(case when event_type = 'click' then ' ' else event_type end) <> '' then 'event_type' else 'user_id' end as id_field from events")
def p1_extract_id(t: Tables) -> DataFrame:
    e = t.events.withColumn("event_type", F.when(F.col("event_type") == "click", " ").otherwise(F.col("event_type")))
    return e.select("event_id", *P.first_usable_id(e, ["event_type", "user_id"]))


@plan(
    r"""select p_partkey, case when p_brand = 'Brand#13' then 'known' when ends_with(lower(p_type), 'all') then 'metal' when starts_with(lower(p_type), 'promo') then 'promo' when contains(lower(p_name), 'red') then 'red' else 'config' end as kind,
    case when p_brand = 'Brand#13' then 'discriminator' when ends_with(lower(p_type), 'all') or starts_with(lower(p_type), 'promo') then 'class' when contains(lower(p_name), 'red') then 'family' else 'default' end as method, p_brand <> 'Brand#13' as inferred from part"""
)
def p2_assign_kind(t: Tables) -> DataFrame:
    rules = [("known", "discriminator", "p_brand", "equal", "Brand#13"), ("metal", "class", "p_type", "suffix", "ALL"), ("promo", "class", "p_type", "prefix", "promo"), ("red", "family", "p_name", "contains", "RED")]
    return P.assign_kind(t.part, rules, default="config").select("p_partkey", "kind", "method", "inferred")


@plan(r"select case when regexp_matches(k, '^[0-9a-f]{32}$') then 'guid' when regexp_matches(k, '^[0-9]+$') then 'integer' else 'address' end as kind, count(*) as n from (select case page_id % 3 when 0 then md5(url) when 1 then page_id::varchar else url end as k from pages) group by 1")
def p5_classify_key(t: Tables) -> DataFrame:
    k = F.when(F.col("page_id") % 3 == 0, F.md5("url")).when(F.col("page_id") % 3 == 1, F.col("page_id").cast("string")).otherwise(F.col("url"))
    return t.pages.select(P.classify_key(k).alias("kind")).groupBy("kind").agg(F.count("*").alias("n"))


@plan("select p_partkey, case when p_size > 40 then 'no-name' when p_size > 20 then 'unknown' when p_retailprice > 1200 then 'no-chain' else 'resolved' end as reason from part")
def p7_reason_from_evidence(t: Tables) -> DataFrame:
    reason = P.first_true({"no-name": F.col("p_size") > 40, "unknown": F.col("p_size") > 20, "no-chain": F.col("p_retailprice") > 1200}, "resolved")
    return t.part.select("p_partkey", reason.alias("reason"))


@plan(r"select doc_id, case when source in ('src0', 'src1') and regexp_matches(text, '!!') then 'shouting' when source in ('src0', 'src1') and regexp_matches(text, '\|') then 'table' end as skip_reason from documents")
def p8_family_skip_reason(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", P.first_pattern("text", {"shouting": "!!", "table": r"\|"}, F.col("source").isin("src0", "src1")).alias("skip_reason"))


@plan("select c_custkey, case when o_custkey is null then 'absent' when o_orderstatus = 'F' then 'match' else 'twin-mismatch' end as corroboration from customer left join (select o_custkey, min(o_orderstatus) as o_orderstatus from orders where o_custkey % 3 > 0 group by 1) on o_custkey = c_custkey")
def p11_classify_corroboration(t: Tables) -> DataFrame:
    o = t.orders.filter("o_custkey % 3 > 0").groupBy("o_custkey").agg(F.min("o_orderstatus").alias("status"))
    return t.customer.join(o, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", P.corroboration(F.col("status"), F.lit("F")).alias("corroboration"))


@plan("select c_mktsegment, case c_mktsegment when 'BUILDING' then 'b' when 'MACHINERY' then 'm' end as label, count(*) as n from customer group by 1")
def p14_generation_label(t: Tables) -> DataFrame:
    return t.customer.withColumn("label", X.lookup("c_mktsegment", {"BUILDING": "b", "MACHINERY": "m"})).groupBy("c_mktsegment", "label").agg(F.count("*").alias("n"))


@plan(
    r"""select pattern, count(*) filter (hit) as hits from (select 'exact' as pattern, contains(p_name, 'red') as hit from part union all select 'folded', contains(lower(p_type), 'promo') from part
    union all select 'any', contains(p_name, 'blue') or contains(p_name, 'red') from part union all select 'regex', regexp_matches(p_name, '^[a-c].*e$') from part union all select 'never', false from part) group by 1"""
)
def p15_predicate_battery(t: Tables) -> DataFrame:
    n = F.col("p_name")
    tests = {"exact": F.contains(n, F.lit("red")), "folded": F.contains(F.lower("p_type"), F.lit("promo")), "any": F.contains(n, F.lit("blue")) | F.contains(n, F.lit("red")), "regex": n.rlike("^[a-c].*e$"), "never": F.lit(False)}
    return P.predicate_battery(t.part, tests)


@plan("select c_custkey, c_mktsegment in ('BUILDING', 'FURNITURE') as visible, case c_mktsegment when 'BUILDING' then 3 when 'FURNITURE' then 2 else 1 end as weight from customer")
def p16_visibility_weight(t: Tables) -> DataFrame:
    w = F.when(F.col("c_mktsegment") == "BUILDING", 3).when(F.col("c_mktsegment") == "FURNITURE", 2).otherwise(1)
    return t.customer.select("c_custkey", F.col("c_mktsegment").isin("BUILDING", "FURNITURE").alias("visible"), w.alias("weight"))


@plan(r"select page_id, list_has_any(regexp_split_to_array(url, '[/.\[\]]+'), ['com', 'net']) as blocked from pages")
def p17_blacklist_path(t: Tables) -> DataFrame:
    return t.pages.select("page_id", P.path_has("url", ["com", "net"], r"[/.\[\]]+").alias("blocked"))


@plan("select doc_id, (doc_id % 4 <> 0) or length(case when doc_id % 8 = 0 then '' else source end) > 0 as capable from documents")
def p18_text_capable(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", P.text_capable(F.col("doc_id") % 4, F.when(F.col("doc_id") % 8 == 0, "").otherwise(F.col("source"))).alias("capable"))


@plan("select l_returnflag, count(*) filter (l_discount <> 0) as kept, count(*) filter (l_discount = 0) as sentinels from lineitem group by 1")
def p20_sentinels_counted(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(F.count_if(F.col("l_discount") != 0).alias("kept"), F.count_if(F.col("l_discount") == 0).alias("sentinels"))


@plan("select event_id, json_extract_string(props, '$.k') as k, json_extract_string(props, '$.missing') as missing from events")
def p21_verbatim_projection(t: Tables) -> DataFrame:
    return P.verbatim(t.events, "props", {"k": "$.k", "missing": "$.missing"}, ["event_id"])


@plan("select p_partkey, p_name from part where contains(p_name, 'red')")
def p25_name_projection(t: Tables) -> DataFrame:
    return P.name_projection(t.part.select("p_partkey", "p_name"), "p_name", "red")[0]


@plan("select p_name, count(*) as n from part where contains(p_name, 'red') group by 1")
def p25_projected_names(t: Tables) -> DataFrame:
    return P.name_projection(t.part, "p_name", "red")[1]


@plan(r"select page_id, case when regexp_matches(url, '\{[^}]*\}') then 'braced' when page_id % 5 = 0 then 'known key' end as excuse from pages")
def p26_miss_excuse(t: Tables) -> DataFrame:
    keys = t.pages.filter("page_id % 5 = 0").select(X.normalize_ref("url").alias("key"), F.col("page_id").alias("known_id")).distinct()
    d = t.pages.withColumn("key", X.normalize_ref("url"))
    j = d.join(keys, (d["key"] == keys["key"]) & (d["page_id"] == keys["known_id"]), "left")
    return j.select("page_id", F.when(F.col("url").rlike(r"\{[^}]*\}"), "braced").when(F.col("known_id").isNotNull(), "known key").alias("excuse"))


@plan("select p_partkey, concat_ws(',', case when contains(p_name, 'red') then 'red' end, case when contains(lower(p_type), 'promo') then 'promo' end, case when p_size > 40 then 'large' end) as hits from part")
def p15_predicate_hits(t: Tables) -> DataFrame:
    tests = {"red": F.contains(F.col("p_name"), F.lit("red")), "promo": F.contains(F.lower("p_type"), F.lit("promo")), "large": F.col("p_size") > 40}
    return P.predicate_hits(t.part, tests, ["p_partkey"]).select("p_partkey", F.array_join("hits", ",").alias("hits"))


@plan("select o_orderstatus, case o_orderstatus when 'F' then 'done' when 'O' then 'open' else 'partial' end as label, count(*) as n from orders group by 1")
def p14_closed_label(t: Tables) -> DataFrame:
    return t.orders.withColumn("label", P.closed_label("o_orderstatus", {"F": "done", "O": "open", "P": "partial"})).groupBy("o_orderstatus", "label").agg(F.count("*").alias("n"))


@plan(
    """select doc_id, case lang when 'en' then 'base' when 'de' then 'de-DE' when 'fr' then 'fr-FR' when 'es' then 'unknown:es' end as locale, case when doc_id % 3 = 0 then source else 'b_' || doc_id end as stem, case when doc_id % 3 = 0 then 'address-basename' else 'bundle-pathid' end as named_by from documents where lang in ('en', 'de', 'fr', 'es')"""
)
def f4_f16_locale_and_standalone_name(t: Tables) -> DataFrame:
    d = t.documents.filter("lang in ('en', 'de', 'fr', 'es')")
    name = F.when(F.col("lang") == "en", "texts.bundle").when(F.col("lang") == "de", "texts_German.bundle").otherwise(F.concat(F.lit("texts"), "lang", F.lit(".bundle")))
    address = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("a/b/"), "source", F.lit(".png"))).when(F.col("doc_id") % 3 == 1, F.lit("a/.png"))
    named = X.standalone_name(address, F.lit("b"), F.col("doc_id"))
    return d.select("doc_id", X.locale_of(name, "texts", {"german": "de-DE", "fr": "fr-FR"}).alias("locale"), named.alias("s")).select("doc_id", "locale", "s.*")
