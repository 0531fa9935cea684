"""Masking of secrets in free text and in keyed values of any nesting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: what counts as a secret ---------------------------------
SENSITIVE_KEY_PARTS = (
    "authorization",
    "client_secret",
    "credential",
    "password",
    "payload",
    "raw_message",
    "raw_payload",
    "secret",
    "token",
)
ASSIGNED_SECRET = (
    r"(?iU)\b(client_secret|access_token|refresh_token|password|authorization)"
    r"\s*[=:]\s*([^\s&,;]+)"
)
BEARER_SECRET = r"(?iU)\bBearer\s+[^\s,;]+"
MASK = "[REDACTED]"

#: JSON text: a string, and a value up to this many levels deep. Possessive, so that matching takes
#: neither time nor stack beyond the text's length.
_NESTING = 16
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'


def _json_value() -> str:
    """Pattern of a whole JSON value; one nested deeper reaches to the end of the text."""
    inner = ""
    for _ in range(_NESTING):
        inner = rf'[\[{{](?:[^"\[\]{{}}]++|{_STRING}{"|" + inner if inner else ""})*+[\]}}]'
    return rf"(?:{_STRING}|{inner}|[\[{{].*+|[^\s,\]}}\[{{\"]++)"


_SENSITIVE_MEMBER = (
    rf'(?is)("[^"]*?(?:{"|".join(SENSITIVE_KEY_PARTS)})[^"\\]*+(?:\\.[^"\\]*+)*+"\s*+:\s*+)'
    + _json_value()
)


def redact_text(text: Column) -> Column:
    """Mask ``name=secret`` assignments, then bearer tokens."""
    assigned = F.regexp_replace(text, ASSIGNED_SECRET, f"$1={MASK}")
    return F.regexp_replace(assigned, BEARER_SECRET, f"Bearer {MASK}")


def redact_json(text: Column) -> Column:
    """Mask the values of sensitive names at any depth of a JSON text, and secrets inside strings.

    A sensitive value nested deeper than 16 levels is masked together with all that follows.
    """
    named = F.regexp_replace(text, _SENSITIVE_MEMBER, f'$1"{MASK}"')
    assigned = F.regexp_replace(named, _inside_strings(ASSIGNED_SECRET), f"$1={MASK}")
    return F.regexp_replace(assigned, _inside_strings(BEARER_SECRET), f"Bearer {MASK}")


def _inside_strings(pattern: str) -> str:
    """The same secret, ending at the quote that ends its JSON string."""
    for free in ("&,;", ",;"):
        pattern = pattern.replace(rf"[^\s{free}]+", rf'(?:[^\s"\\{free}]++|\\.)++')
    return pattern


def redact_open_text(text: Column) -> Column:
    """Text that may be JSON: objects and arrays by their members, other text as it stands."""
    is_json = text.rlike(r"^\s*[\[{]") & F.try_parse_json(text).isNotNull()
    return F.when(is_json, redact_json(text)).otherwise(redact_text(text))


def is_sensitive(name: Column) -> Column:
    return F.lower(name).rlike("|".join(SENSITIVE_KEY_PARTS))


def redact_value(value: Column, kind: T.DataType, key: str | None = None) -> Column:
    """Rewrite a typed value, walking its schema; sensitive names lose their whole value."""
    if key is not None and any(part in key.lower() for part in SENSITIVE_KEY_PARTS):
        return F.lit(MASK)
    if isinstance(kind, T.StructType):
        return F.when(
            value.isNotNull(),
            F.struct(
                *(
                    redact_value(value.getField(f.name), f.dataType, f.name).alias(f.name)
                    for f in kind.fields
                )
            ),
        )
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda item: redact_value(item, kind.elementType))
    if isinstance(kind, T.MapType) and isinstance(kind.valueType, T.StringType):
        return F.transform_values(
            value, lambda k, v: F.when(is_sensitive(k), MASK).otherwise(redact_open_text(v))
        )
    if isinstance(kind, T.MapType):
        # The masked value is text, so the map's values become JSON text throughout.
        return F.transform_values(
            value,
            lambda k, v: F.when(is_sensitive(k), MASK).otherwise(
                _as_text(redact_value(v, kind.valueType), kind.valueType)
            ),
        )
    if isinstance(kind, T.StringType):
        return redact_open_text(value)
    if isinstance(kind, T.VariantType):
        return F.try_parse_json(redact_json(F.to_json(value)))
    return value


def _as_text(value: Column, kind: T.DataType) -> Column:
    nested = (T.StructType, T.ArrayType, T.MapType)
    return F.to_json(value) if isinstance(kind, nested) else value.cast("string")


def redact_columns(schema: T.StructType) -> list[Column]:
    """One redacted column per field of a row schema."""
    return [redact_value(F.col(f.name), f.dataType, f.name).alias(f.name) for f in schema.fields]
