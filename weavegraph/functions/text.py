"""Column functions on names, references and texts (F1-F20). All are built-in expressions, so they stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def basename(path: str | Column) -> Column:
    """what follows the last slash; backslashes count as slashes."""
    return F.element_at(F.split(F.regexp_replace(_c(path), r"\\", "/"), "/"), -1)


def address_basename(address: str | Column) -> Column:
    """basename without its last extension; null where nothing is left."""
    return F.nullif(F.regexp_replace(basename(address), r"\.[^.]*$", ""), F.lit(""))


def normalize_ref(ref: str | Column) -> Column:
    """the match key of a file reference. Basename; a leading braced part is dropped, unless a dot, a question mark or
    nothing follows it (then the braces wrap the name itself); query string and .bundle go; lower case."""
    name = basename(ref)
    bare = F.regexp_replace(name, r"^(\{[^}]*\}(?=[^.?]))+", "")
    named = F.regexp_replace(bare, r"^\{([^}]*)\}([.?].*)?$", "$1")
    plain = F.regexp_replace(named, r"[{}]", "")
    return F.regexp_replace(F.lower(F.substring_index(plain, "?", 1)), r"\.bundle$", "")


def strip_hash_suffix(key: str | Column) -> Column:
    """F2: the key without a trailing underscore and 32 hex digits; null where there are none."""
    return F.nullif(F.regexp_extract(_c(key), r"^(?i)(.+)_[0-9a-f]{32}$", 1), F.lit(""))


def parse_stem(name: str | Column) -> Column:
    """struct(base, path_id) of <base>_<signed number>[.<ext of 1 to 5>]; null where the name has no number."""
    stem = F.regexp_replace(_c(name), r"(_-?\d+)\.[A-Za-z0-9]{1,5}$", "$1")
    base, number = (F.regexp_extract(stem, r"^(.+)_(-?\d+)$", i) for i in (1, 2))
    return F.when(base != "", F.struct(base.alias("base"), number.cast("bigint").alias("path_id")))


def family_of(name: str | Column, axes: list[str], suffixes: list[str]) -> Column:
    """struct(family, axis, hash_named): the axis tag, a hex prefix of 16 or more, and the first matching suffix go."""
    stem = F.regexp_replace(_c(name), r"\.bundle$", "")
    axis = F.coalesce(*[F.when(stem.startswith(f"{a}-"), F.lit(a)) for a in axes], F.lit("base"))
    bare = F.when(axis != "base", F.substr(stem, F.length(axis) + 2)).otherwise(stem)
    hashed = bare.rlike(r"^[0-9a-f]{16,}_.")
    bare = F.when(hashed, F.regexp_replace(bare, r"^[0-9a-f]{16,}_", "")).otherwise(bare)
    cut = bare
    for s in reversed(suffixes):
        cut = F.when(bare.endswith(s) & (F.length(bare) > len(s)), F.substr(bare, F.lit(1), F.length(bare) - len(s))).otherwise(cut)
    return F.struct(cut.alias("family"), axis.alias("axis"), hashed.alias("hash_named"))


def scene_flag(name: str | Column, suffix: str, prefix: str) -> Column:
    """the suffix itself, 'seasonal' for the prefix, or none."""
    stem = F.regexp_replace(_c(name), r"\.bundle$", "")
    return F.when(stem.endswith(suffix), F.lit(suffix)).when(stem.startswith(prefix), F.lit("seasonal")).otherwise("none")


def locale_of(name: str | Column, stem: str, locales: dict[str, str], base: str = "base") -> Column:
    """the locale of a localisation bundle: base for the stem alone, else that of what follows it, which is unknown:<what> if
    no locale has it; null for other bundles. A separating underscore and capitals don't matter."""
    bare = F.regexp_replace(_c(name), r"\.bundle$", "")
    suffix = F.regexp_replace(F.lower(F.substr(bare, F.lit(len(stem) + 1))), "^_+", "")
    known = F.coalesce(*[F.when(suffix == k, F.lit(v)) for k, v in locales.items()], F.concat(F.lit("unknown:"), suffix))
    return F.when(bare == stem, F.lit(base)).when(bare.startswith(stem), known)


def lookup(value: str | Column, table: dict[str, str], default: Column | None = None) -> Column:
    """A small constant map; a missing key gives default or null."""
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    found = F.element_at(pairs, _c(value))
    return found if default is None else F.coalesce(found, default)


def simplify_external(path: str | Column) -> Column:
    """archive:/ and assets/ go, the basename stays, lower case."""
    return F.lower(basename(F.regexp_replace(F.regexp_replace(F.regexp_replace(_c(path), r"\\", "/"), "^archive:/", ""), "^assets/", "")))


def builtin_external(path: str | Column) -> Column:
    """whether an external path is none of an archive."""
    return ~F.startswith(_c(path), F.lit("archive:"))


def clean_text(text: str | Column) -> Column:
    """braced placeholders go first, then tags, then outer white space."""
    return F.trim(F.regexp_replace(F.regexp_replace(_c(text), r"\{[^{}]+\}", ""), r"<[^>]+>", ""))


def id_tokens(value: str | Column, lowercase: bool = True) -> Column:
    """F8: parts between non-alphanumeric runs, of two characters at least and not all digits; distinct and sorted."""
    parts = F.filter(F.split(_c(value), "[^A-Za-z0-9]+"), lambda p: (F.length(p) >= 2) & ~p.rlike("^[0-9]+$"))
    return F.array_sort(F.array_distinct(F.transform(parts, F.lower) if lowercase else parts))


def candidate_forms(value: str | Column, prefixes: list[str], suffix: str) -> Column:
    """array of struct(form, method): the value without prefix and suffix, its plural or singular, and both of its last segment; first method wins."""
    v, bare = _c(value), _c(value)
    for p in reversed(prefixes):
        bare = F.when(v.startswith(p), F.substr(v, F.lit(len(p) + 1))).otherwise(bare)
    bare = F.when(bare.endswith(suffix), F.substr(bare, F.lit(1), F.length(bare) - len(suffix))).otherwise(bare)
    last = F.element_at(F.split(bare, "_"), -1)
    fold = lambda x: F.when(x.endswith("s"), F.substr(x, F.lit(1), F.length(x) - 1)).otherwise(F.concat(x, F.lit("s")))
    made = F.array(*[F.struct(f.alias("form"), F.lit(m).alias("method")) for f, m in ((bare, "family"), (fold(bare), "plural-fold"), (last, "last-segment"), (fold(last), "plural-fold"))])
    return F.filter(made, lambda x, i: (x["form"] != "") & ~F.exists(F.slice(made, F.lit(1), i), lambda y: y["form"] == x["form"]))


def token_rewrite(value: str | Column, table: list[tuple[str, str]]) -> Column:
    """array of rewritten forms: exact matches are replaced whole, others wherever the source occurs in any case."""
    v = _c(value)
    made = [F.when(v == s, F.lit(d)).when(F.contains(F.lower(v), F.lit(s.lower())), F.regexp_replace(v, "(?i)" + _quoted(s), d)) for s, d in table]
    return F.array_distinct(F.array_compact(F.array(*made)))


def _quoted(literal: str) -> str:
    return "\\Q" + literal.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def norm_name(name: str | Column) -> Column:
    """trimmed, runs of white space and hyphens become an underscore, lower case."""
    return F.lower(F.regexp_replace(F.trim(_c(name)), r"[\s-]+", "_"))


def ratio_half_up(numerator: str | Column, denominator: str | Column, digits: int) -> Column:
    """numerator/denominator times 10**digits as a whole number, rounded half up by integer arithmetic; 0 for no denominator."""
    n, d = _c(numerator).cast("bigint"), _c(denominator).cast("bigint")
    return F.when(d > 0, F.call_function("div", 2 * 10**digits * n + d, 2 * d)).otherwise(F.lit(0).cast("bigint"))


def percent(numerator: str | Column, denominator: str | Column) -> Column:
    """percent with two decimals, as text."""
    h = ratio_half_up(numerator, denominator, 4)
    return F.concat(F.call_function("div", h, F.lit(100)).cast("string"), F.lit("."), F.lpad((h % 100).cast("string"), 2, "0"), F.lit("%"))


def common_namespace(low: str | Column, high: str | Column) -> Column:
    """the longest common prefix of keys that ends before a slash, from their smallest and largest."""
    a, b = F.split(_c(low), "/"), F.split(_c(high), "/")
    n = F.least(F.size(a), F.size(b))
    same = F.filter(F.sequence(F.lit(1), n), lambda i: F.slice(a, F.lit(1), i) == F.slice(b, F.lit(1), i))
    return F.array_join(F.slice(a, F.lit(1), F.size(same)), "/")


def is_cjk(text: str | Column) -> Column:
    """holds Han, Kana or Hangul."""
    return _c(text).rlike(r"[一-鿿぀-ヿ가-힣]")


def sanitize_component(name: str | Column) -> Column:
    """F16: characters that file names can't have become underscores; trailing dots and spaces go; _unnamed if nothing stays."""
    clean = F.regexp_replace(F.regexp_replace(_c(name), r'[<>:"/\\|?*\x00-\x1f]', "_"), r"[ .]+$", "")
    return F.coalesce(F.nullif(clean, F.lit("")), F.lit("_unnamed"))


def standalone_name(address: str | Column, bundle: str | Column, path_id: str | Column) -> Column:
    """F16: struct(stem, named_by) of an object without a name of its own: its address's base name, else <bundle>_<path id>."""
    base = address_basename(address)
    other = F.concat(sanitize_component(bundle), F.lit("_"), _c(path_id).cast("string"))
    return F.struct(F.coalesce(F.when(base.isNotNull(), sanitize_component(base)), other).alias("stem"), F.when(base.isNotNull(), "address-basename").otherwise("bundle-pathid").alias("named_by"))


def emitted_path(stem: str | Column, folder: str, ext: str) -> Column:
    return F.concat(F.lit(f"{folder}/"), sanitize_component(stem), F.lit(f".{ext}"))


def numbers_equal(a: str | Column, b: str | Column) -> Column:
    """equal numbers, NaN equal to itself, zeros by their sign."""
    x, y = _c(a), _c(b)
    return x.eqNullSafe(y) & ((x != 0) | x.isNull() | (x.cast("string") == y.cast("string")))


def full_type_name(namespace: str | Column, name: str | Column) -> Column:
    """namespace.name, the name alone for an empty namespace."""
    return F.concat_ws(".", F.nullif(_c(namespace), F.lit("")), _c(name))
