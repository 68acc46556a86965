"""Column detection, auto-mapping and mapping application.

Detection opens the JSON of every row level by level: object entries become (path, value)
pairs; arrays continue with their first object element; primitives, nulls and arrays without an
object element are leaves; empty objects end silently.  The union of the leaves of every order is
the site's column set (a distinct with map-side combine), so nothing depends on how many distinct
keys exist, and nothing is walked on the driver.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopfold.functions.text import truncate_sample
from shopfold.functions.values import as_array, as_object, is_object
from shopfold.schema import GOMAG_IGNORED_TOP_KEYS, STANDARD_COLUMNS, WOO_IGNORED_TOP_KEYS


def _first_object(arr: Column) -> Column:
    return F.try_element_at(F.filter(arr, lambda x: is_object(x)), F.lit(1))


def clean_top_level(entries: DataFrame) -> DataFrame:
    """Drop noisy top-level keys; GoMag ``delivery`` keeps only ``delivery.total``."""
    woo = (F.col("platform") == "woocommerce") & F.col("path").isin(*WOO_IGNORED_TOP_KEYS)
    gom = (F.col("platform") == "gomag") & F.col("path").isin(*GOMAG_IGNORED_TOP_KEYS)
    e = entries.filter(~(woo | gom))
    deliv = ((F.col("platform") == "gomag") & (F.col("path") == "delivery")
             & is_object(F.col("value")))
    total = F.coalesce(F.variant_get(F.col("value"), "$.total", "variant"),
                       F.lit(0).cast("variant"))
    return e.select(
        "source_site", "platform",
        F.when(deliv, F.lit("delivery.total")).otherwise(F.col("path")).alias("path"),
        F.when(deliv, total).otherwise(F.col("value")).alias("value"))


def _depth(raw: Column) -> Column:
    """How deep a row's objects lie in each other: the deepest open brace outside of strings."""
    braces = F.regexp_replace(F.to_json(raw), r'"(?:[^"\\]|\\.)*"|[^{}]', "")

    def step(state, brace):
        now = state["now"] + F.when(brace == "{", 1).otherwise(-1)
        return F.struct(now.alias("now"), F.greatest(state["top"], now).alias("top"))

    none = F.struct(F.lit(0).alias("now"), F.lit(0).alias("top"))
    return F.aggregate(F.split(braces, ""), none, step, lambda state: state["top"])


def _entry(path: Column, value: Column) -> Column:
    """(path, value that continues): an object, or the first object of an array; NULL is a leaf."""
    arr = as_array(value)
    return F.struct(path.alias("path"), F.when(is_object(value), value).when(
        arr.isNotNull(), _first_object(arr)).alias("value"))


def _clean_entries(entries: Column, platform: Column) -> Column:
    """P6 on an array of top-level map entries (see :func:`clean_top_level`)."""
    def kept(e):
        return ~(((platform == "woocommerce") & e["key"].isin(*WOO_IGNORED_TOP_KEYS))
                 | ((platform == "gomag") & e["key"].isin(*GOMAG_IGNORED_TOP_KEYS)))

    def one(e):
        total = F.coalesce(F.variant_get(e["value"], "$.total", "variant"), F.lit(0).cast("variant"))
        delivery = (platform == "gomag") & (e["key"] == "delivery") & is_object(e["value"])
        return F.struct(F.when(delivery, F.lit("delivery.total")).otherwise(e["key"]).alias("key"),
                        F.when(delivery, total).otherwise(e["value"]).alias("value"))

    return F.transform(F.filter(entries, kept), one)


def detect_paths(raw: DataFrame, clean: bool = True) -> DataFrame:
    """(source_site, path) leaf paths of every order, dot notation.

    One pass over the orders: each row opens its own objects level by level, as often as it is
    deep, and sends its leaf paths to a distinct that combines map-side.  Nothing is stored, and
    how deep the JSON is costs no further job.
    """
    entries = F.map_entries(as_object(F.col("raw")))
    if clean:
        entries = _clean_entries(entries, F.col("platform"))
    top = F.transform(entries, lambda e: _entry(e["key"], e["value"]))

    def opened(state, _):
        return F.flatten(F.transform(state, lambda s: F.when(s["value"].isNull(), F.array(s)).otherwise(
            F.transform(F.map_entries(as_object(s["value"])),
                        lambda e: _entry(F.concat_ws(".", s["path"], e["key"]), e["value"])))))

    # Two levels are opened in any row; only rows that are deeper measure how deep they are.
    state, unopened = F.col("state"), F.exists(F.col("state"), lambda s: s["value"].isNotNull())
    left = F.when(unopened, F.aggregate(F.sequence(F.lit(3), _depth(F.col("raw"))), state, opened)).otherwise(state)
    return (raw.withColumn("state", opened(top, None)).select("source_site", F.explode(left).alias("leaf"))
            .select("source_site", "leaf.path").distinct())


def auto_map(paths: DataFrame) -> DataFrame:
    """target = the standard column of exactly the same name, else ''."""
    std = F.array(*[F.lit(c) for c in STANDARD_COLUMNS])
    hit = F.array_contains(std, F.col("path"))
    return paths.select(
        "source_site", F.col("path").alias("source_column"),
        F.when(hit, F.col("path")).otherwise(F.lit("")).alias("target_column"),
        F.when(hit, F.lit("confirmed")).otherwise(F.lit("unmapped")).alias("status"))


#: Where line items lie in a raw order: a leaf below is a product's, a top-level one the order's.
ITEM_ROOTS = ["line_items", "items", "products"]
#: Least similarity of a suggestion: one letter in four may differ.
MIN_SIMILARITY = 0.75


def _similarity(a: Column, b: Column) -> Column:
    """1 - edit distance / length of the longer name."""
    return F.lit(1.0) - F.levenshtein(a, b) / F.greatest(F.char_length(a), F.char_length(b))


def _plain(name: Column) -> Column:
    """A name as it is compared: lower case, words split where camelCase or signs split them."""
    words = F.regexp_replace(name, "([a-z0-9])([A-Z])", "$1_$2")
    return F.btrim(F.regexp_replace(F.lower(words), "[^a-z0-9]+", "_"), F.lit("_"))


def suggest_columns(paths: DataFrame, min_similarity: float = MIN_SIMILARITY) -> DataFrame:
    """P8 by name similarity: the standard column most like the path, its last part, or that part
    with the prefix of its place (``product_`` below the line items, ``order_`` at the top).

    An equal name is confirmed; a similar one is a suggestion that stays unmapped until someone
    confirms it.  Of equally similar columns the first in schema order is taken.
    """
    parts = F.split("path", r"\.")
    last = _plain(F.element_at(parts, -1))
    placed = (F.when(F.element_at(parts, 1).isin(*ITEM_ROOTS) & (F.size(parts) > 1),
                     F.concat(F.lit("product_"), last))
              .when(F.size(parts) == 1, F.concat(F.lit("order_"), last)).otherwise(last))
    named = paths.select("source_site", "path", F.array(_plain(F.col("path")), last, placed).alias("names"))
    scores = F.array(*[F.struct(
        F.round(F.array_max(F.transform("names", lambda n: _similarity(n, F.lit(c)))), 4).alias("similarity"),  # noqa: B023
        F.lit(-k).alias("first"), F.lit(c).alias("target")) for k, c in enumerate(STANDARD_COLUMNS)])
    best = named.select("source_site", "path", F.array_max(scores).alias("best"))
    exact = F.col("path") == F.col("best.target")
    good = F.col("best.similarity") >= min_similarity
    return best.select(
        "source_site", F.col("path").alias("source_column"),
        F.when(good, F.col("best.target")).otherwise(F.lit("")).alias("target_column"),
        F.when(exact, F.lit("confirmed")).otherwise(F.lit("unmapped")).alias("status"),
        F.when(good, F.col("best.similarity")).alias("similarity"))


def nested_value(v: Column, path: str) -> Column:
    """P10: value at a dotted path; an array on the way yields its first element."""
    cur = v
    for seg in path.split("."):
        key = seg.replace("'", "\\'")
        step_arr = F.variant_get(cur, f"$[0]['{key}']", "variant")
        step_obj = F.variant_get(cur, f"$['{key}']", "variant")
        cur = F.when(F.variant_get(cur, "$[0]", "variant").isNotNull(),
                     F.when(is_object(F.variant_get(cur, "$[0]", "variant")), step_arr)
                     ).otherwise(F.when(is_object(cur), step_obj))
    return cur


def sample_text(v: Column) -> Column:
    """X10 on a variant value: ``String(v)`` / JSON text, '—' when missing."""
    missing = v.isNull() | F.is_variant_null(v)
    return truncate_sample(F.when(missing, F.lit(None).cast("string")).otherwise(
        F.variant_get(v, "$", "string")))


# --- P9 / X11: mapping application ------------------------------------------

def apply_transform(text: Column, transform: str | None) -> Column:
    """X11 transforms on the value's text.

    toString -> text; toNumber -> ``Number(text)`` ('' -> 0, invalid -> NULL);
    toDate -> timestamp (NULL when unparsable); split(',') -> array of parts;
    regex:<pattern> -> the first group of the first match (the match itself if the pattern has no
    group), NULL when nothing matches.
    """
    if transform in (None, "", "toString"):
        return text
    if transform == "toNumber":
        t = F.trim(text)
        return F.when(t == "", F.lit(0.0)).otherwise(t.try_cast("double"))
    if transform == "toDate":
        return F.try_to_timestamp(text)
    if transform == "split(',')":
        return F.split(text, ",")
    if transform.startswith("regex:"):
        pattern = transform[len("regex:"):]
        group = 1 if re.compile(pattern).groups else 0
        return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))
    raise ValueError(f"unknown transform {transform!r}")


def apply_mapping(raw: DataFrame, mapping: list[tuple[str, str, str, str | None]],
                  items_path: str) -> DataFrame:
    """Project source paths onto target columns.

    ``mapping`` rows are (source_column, target_column, status, transform);
    ``ignored`` rows and rows without a target are skipped.  Paths under
    ``items_path`` are read per line item (the array is exploded, keeping
    orders without items as one row); the others once per order.
    """
    rows = [m for m in mapping if m[2] != "ignored" and m[1]]
    prefix = items_path + "."
    order_level = [m for m in rows if not m[0].startswith(prefix)]
    item_level = [m for m in rows if m[0].startswith(prefix)]
    base = raw.select("source_site", "raw", F.explode_outer(
        as_array(F.variant_get(F.col("raw"), "$." + items_path, "variant"))).alias("_item"))
    cols = [F.col("source_site")]
    for src, tgt, _, tr in order_level:
        cols.append(apply_transform(F.variant_get(nested_value(F.col("raw"), src), "$",
                                                  "string"), tr).alias(tgt))
    for src, tgt, _, tr in item_level:
        rel = src[len(prefix):]
        cols.append(apply_transform(F.variant_get(nested_value(F.col("_item"), rel), "$",
                                                  "string"), tr).alias(tgt))
    return base.select(*cols)

