"""Strict JSON payloads as VARIANT, with type tests that mirror dynamic typing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a string's ends may be trimmed of: every Unicode white-space character.
WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def decode_text(value: Column) -> Column:
    """Bytes as text, null when they are not valid UTF-8."""
    return F.try_validate_utf8(value.cast("string"))


def with_document(rows: DataFrame, text: Column, name: str = "_doc") -> DataFrame:
    """Add a one-element VARIANT array holding the parsed text; null unless one JSON object.

    ``try_parse_json`` ignores whatever follows the first value. Wrapping the text in
    brackets turns trailing data into a syntax error or a second element. What is left is
    text that closes the bracket itself (``{..}] x``): only where ``}]`` occurs at all is
    the text parsed a second time inside an object, where a bracket cannot close anything.

    Text and parse are columns of their own steps, so each is computed once per row.
    """
    column, body, tail = F.col(name), F.col("_text"), F.col("_tail_ok")
    wrapped = F.try_parse_json(F.concat(F.lit("["), body, F.lit("]")))
    inner = F.try_parse_json(F.concat(F.lit('{"v":'), body, F.lit("}")))
    return (
        rows.withColumn("_text", text)
        .withColumns(
            {
                name: F.when(F.ltrim(body, F.lit(" \t\r\n")).startswith("{"), wrapped),
                # Most documents have no bracket at all; the pattern runs on the others.
                "_tail_ok": ~body.contains("]") | ~body.rlike(r"\}\s*\]") | inner.isNotNull(),
            }
        )
        .withColumn(
            name,
            F.when(tail & F.try_variant_get(column, "$[1]", "variant").isNull(), column),
        )
        .drop("_text", "_tail_ok")
    )


def member(doc: Column, name: str, kind: str = "variant") -> Column:
    """Member of a document from :func:`with_document`; null when absent or not castable."""
    return F.try_variant_get(doc, f"$[0].{name}", kind)


def numeric(type_name: Column) -> Column:
    """Whether a VARIANT type name is that of a JSON number."""
    # BIGINT, DOUBLE, FLOAT or DECIMAL(p,s), told apart from all other types by three letters.
    return F.left(type_name, F.lit(3)).isin("BIG", "DOU", "FLO", "DEC")


def number(v: Column, type_name: Column) -> Column:
    """A JSON number as a double, null for other types.

    Read through its text: casting inside ``try_variant_get`` builds a cast per value.
    """
    return F.when(numeric(type_name), F.to_json(v).try_cast("double"))


def is_number(v: Column) -> Column:
    """True for JSON numbers only: not booleans, not numeric strings."""
    return F.coalesce(numeric(F.schema_of_variant(v)), F.lit(False))


def is_string(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v) == "STRING", F.lit(False))


def is_boolean(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v) == "BOOLEAN", F.lit(False))


def is_json_null(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v) == "VOID", F.lit(False))


def is_truthy(v: Column) -> Column:
    """False for absent, null, false, zero, empty text, array or object; true otherwise."""
    text = F.try_variant_get(v, "$", "string")
    number = F.try_variant_get(v, "$", "double")
    return F.coalesce(
        F.when(is_number(v), number != 0)
        .when(is_boolean(v), F.try_variant_get(v, "$", "boolean"))
        .when(is_string(v), text != "")
        .when(is_json_null(v), F.lit(False))
        .otherwise(~F.to_json(v).isin("[]", "{}")),
        F.lit(False),
    )


def finite(value: Column) -> Column:
    """True when a double is present and neither NaN nor infinite."""
    return F.coalesce(
        value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf"))), F.lit(False)
    )
