"""Dynamic JSON value semantics on VARIANT columns.

Store APIs hand out the same field sometimes as a JSON string and sometimes as
a JSON number, and the flatteners use JavaScript truthiness (``a || b``),
``String(v)`` and ``parseFloat``.  Reading the raw order as VARIANT keeps the
JSON type of every value, which is what these rules need: the *string* ``"0"``
is truthy while the *number* ``0`` is not.

The rules are applied in stages of named columns (candidates -> types ->
truthy flags -> text -> number).  Each stage references the previous one by
name, so expressions are never nested into exponential trees and Catalyst
keeps the stages as separate projections inside one whole-stage-codegen span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(v) -> Column:
    return F.col(v) if isinstance(v, str) else v


def vtype(v) -> Column:
    """Type name of a variant value ('STRING', 'BIGINT', 'DECIMAL(4,1)', ...).

    Only meant for scalar values: on a large object it walks the whole value.
    """
    return F.schema_of_variant(_c(v))


def is_number_type(t: Column) -> Column:
    return (t.isin("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT")
            | t.startswith("DECIMAL"))


def as_array(v) -> Column:
    """array<variant> when the value is a JSON array, else NULL."""
    return F.try_variant_get(_c(v), "$", "array<variant>")


def as_object(v) -> Column:
    """map<string, variant> when the value is a JSON object, else NULL."""
    return F.try_variant_get(_c(v), "$", "map<string,variant>")


def truthy_from_type(v, t) -> Column:
    """Truthiness of a variant value given its type name column.

    null / missing / '' / 0 / NaN / false are falsy; arrays and objects (even
    empty ones) are truthy.
    """
    v, t = _c(v), _c(t)
    num = F.variant_get(v, "$", "double")
    return (F.when(v.isNull() | F.is_variant_null(v), F.lit(False))
            .when(t == "STRING", F.variant_get(v, "$", "string") != "")
            .when(t == "BOOLEAN", F.variant_get(v, "$", "boolean"))
            .when(is_number_type(t), (num != 0) & ~F.isnan(num))
            .otherwise(F.lit(True)))


def is_object(v) -> Column:
    """True for a JSON object; casting to a one-field struct does not walk it."""
    return F.try_variant_get(_c(v), "$", "struct<__probe:int>").isNotNull()


def is_nonempty_array(v) -> Column:
    return F.variant_get(_c(v), "$[0]", "variant").isNotNull()


def is_truthy(v) -> Column:
    """Truthiness of any variant value; containers are never walked."""
    v = _c(v)
    return (F.when(v.isNull() | F.is_variant_null(v), F.lit(False))
            .when(is_nonempty_array(v) | is_object(v), F.lit(True))
            .otherwise(truthy_from_type(v, vtype(v))))


def to_text(v) -> Column:
    """``String(v)`` for a scalar variant value."""
    return F.variant_get(_c(v), "$", "string")


# ---------------------------------------------------------------------------
# Staged resolvers
# ---------------------------------------------------------------------------

def _sql_truthy(v: str, t: str) -> str:
    return (f"CASE WHEN {v} IS NULL OR is_variant_null({v}) THEN false "
            f"WHEN {t} = 'STRING' THEN variant_get({v}, '$', 'string') <> '' "
            f"WHEN {t} = 'BOOLEAN' THEN variant_get({v}, '$', 'boolean') "
            f"WHEN {t} IN ('BIGINT','INT','SMALLINT','TINYINT','DOUBLE','FLOAT') "
            f"OR startswith({t}, 'DECIMAL') "
            f"THEN variant_get({v}, '$', 'double') <> 0 AND NOT isnan(variant_get({v}, '$', 'double')) "
            f"ELSE true END")


def _sql_str(x: str) -> str:
    return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sql_truthy_fast(v: str, text: str, t_expr: str) -> str:
    """Truthiness given the value's text; the type is looked up only when needed.

    NULL text (null / missing) and '' are falsy.  Only 'false' or a text
    starting with '0', '-' or '.' can belong to another falsy value (false,
    0, -0, 0.0); there the JSON type decides: a string is truthy, a boolean
    'false' or a number equal to 0 is not.  Any other text is truthy whatever
    its type.  CASE is lazy, so the type lookup runs only for that remainder.
    """
    return (f"CASE WHEN {text} IS NULL OR {text} = '' THEN false "
            f"WHEN {text} = 'false' OR substr({text}, 1, 1) IN ('0', '-', '.') "
            f"THEN {t_expr} = 'STRING' OR ({text} <> 'false' AND "
            f"coalesce(try_cast({text} AS DOUBLE), 1.0D) <> 0.0D) "
            f"ELSE true END")


def resolve_texts(df: DataFrame, fields: dict[str, tuple[list, str]]) -> DataFrame:
    """Add ``name = String(c1 || c2 || ... || default)`` for every field.

    ``fields`` maps an output name to (candidates, default text).  A candidate
    is either a variant SQL expression, or a pair (text SQL expression, variant
    SQL expression) reading the same value; with pairs the text is read
    straight from the source document and the variant is only built inside
    the rare branch that needs the JSON type.  Each stage is one
    ``selectExpr`` (SQL text, one JVM call): texts -> truthy flags -> the
    first truthy text.
    """
    keep = [f"`{c}`" for c in df.columns]

    def pair(c):
        return c if isinstance(c, tuple) else (f"variant_get({c}, '$', 'string')", c)

    texts = [f"{pair(c)[0]} AS `__{n}_s{i}`"
             for n, (cs, _) in fields.items() for i, c in enumerate(cs)]
    df = df.selectExpr(*keep, *texts)
    flags = []
    for n, (cs, _) in fields.items():
        for i, c in enumerate(cs):
            v = pair(c)[1]
            flags.append(f"{_sql_truthy_fast(v, f'`__{n}_s{i}`', f'schema_of_variant({v})')}"
                         f" AS `__{n}_b{i}`")
    df = df.selectExpr("*", *flags)
    out = []
    for n, (cs, default) in fields.items():
        picks = [f"CASE WHEN `__{n}_b{i}` THEN `__{n}_s{i}` END" for i in range(len(cs))]
        out.append(f"coalesce({', '.join(picks + [_sql_str(default)])}) AS `{n}`")
    return df.selectExpr(*keep, *out)


_MONEY_PREFIX = r"^(-?(?:[0-9]+\.?[0-9]*|\.[0-9]+))"
_QTY_PREFIX = r"^([+-]?(?:Infinity|(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?))"
# JavaScript's white space, trimmed by parseFloat.
_JS_SPACE = ("[\\s\\x{00A0}\\x{FEFF}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}"
             "\\x{202F}\\x{205F}\\x{3000}]+")


def money_prefix(text) -> Column:
    """The part of ``String(x).replace(/[^0-9.-]+/g, '')`` parseFloat reads."""
    stripped = F.regexp_replace(_c(text), r"[^0-9.\-]+", "")
    return F.regexp_extract(stripped, _MONEY_PREFIX, 1)


def qty_prefix(text) -> Column:
    """The part of ``String(x)`` parseFloat reads (leading white space skipped)."""
    trimmed = F.regexp_replace(_c(text), "^" + _JS_SPACE, "")
    return F.regexp_extract(trimmed, _QTY_PREFIX, 1)


def prefix_to_number(lit) -> Column:
    """``parseFloat`` result of an extracted prefix, then ``|| 0``.

    ``|| 0`` maps NaN, 0 and -0 to +0 (adding 0.0 turns -0.0 into +0.0).
    """
    lit = _c(lit)
    val = (F.when(lit.isin("Infinity", "+Infinity"), F.lit(float("inf")))
           .when(lit == "-Infinity", F.lit(float("-inf")))
           .otherwise(lit.try_cast("double")))
    return F.coalesce(F.nanvl(val, F.lit(0.0)), F.lit(0.0)) + F.lit(0.0)


_PLAIN_DECIMAL = "^-?[0-9]+([.][0-9]+)?$"


def _sql_prefix_to_number(lit: str) -> str:
    """``parseFloat`` of an extracted prefix, then ``|| 0`` (Spark's cast reads
    'Infinity'; NaN, 0 and -0 become +0)."""
    return f"(coalesce(nanvl(try_cast({lit} AS DOUBLE), 0.0D), 0.0D) + 0.0D)"


def _sql_money_prefix(t: str) -> str:
    return (f"regexp_extract(regexp_replace({t}, {_sql_str('[^0-9.-]+')}, ''), "
            f"{_sql_str(_MONEY_PREFIX)}, 1)")


def _sql_qty_prefix(t: str) -> str:
    return (f"regexp_extract(regexp_replace({t}, {_sql_str('^' + _JS_SPACE)}, ''), "
            f"{_sql_str(_QTY_PREFIX)}, 1)")


def resolve_numbers(df: DataFrame, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """Add ``name = parseFloat(...) || 0`` from a text column.

    ``fields`` maps an output name to (text column, 'money' | 'qty').  A text
    that already is a plain decimal is cast directly: stripping leaves it
    unchanged and parseFloat reads all of it, so the result is the same; only
    other texts go through the regular-expression path.  One ``selectExpr``.
    """
    out = []
    for n, (t, kind) in fields.items():
        tc = f"`{t}`"
        slow = _sql_money_prefix(tc) if kind == "money" else _sql_qty_prefix(tc)
        lit = f"CASE WHEN {tc} RLIKE {_sql_str(_PLAIN_DECIMAL)} THEN {tc} ELSE {slow} END"
        out.append(f"{_sql_prefix_to_number(lit)} AS `{n}`")
    return df.selectExpr("*", *out)


# Column-level conveniences for small, non-nested uses (tests, one-off fields).

def parse_money(text) -> Column:
    return prefix_to_number(money_prefix(text))


def parse_qty(text) -> Column:
    return prefix_to_number(qty_prefix(text))


def first_truthy(*vs) -> Column:
    return F.coalesce(*[F.when(is_truthy(v), _c(v)) for v in vs])


def text_of(*vs, default: str = "") -> Column:
    return F.coalesce(to_text(first_truthy(*vs)), F.lit(default))


def money_of(*vs) -> Column:
    return parse_money(text_of(*vs, default="0"))


def qty_of(*vs) -> Column:
    return parse_qty(text_of(*vs, default="0"))
