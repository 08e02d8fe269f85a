"""Column expressions over parsed JSON (VARIANT) values.

Type labels follow Python's ``json`` module: null, boolean, string, integer,
number, array, object. VARIANT folds ``2020.0`` into DECIMAL(4,0) and keeps
30-digit integers as DECIMAL(30,0), so for non-BIGINT numbers the raw text of the
field decides: integer iff it is written without fraction or exponent.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INTEGRAL_TYPES = ("TINYINT", "SMALLINT", "INT", "BIGINT")
FLOAT_TYPES = ("FLOAT", "DOUBLE")


def parse(text: Column) -> Column:
    """VARIANT of a JSON text; SQL NULL when malformed (JSON ``null`` is a VARIANT null)."""
    return F.try_parse_json(text)


def as_object(v: Column) -> Column:
    """``map<string, variant>`` of a JSON object (keys sorted, repeated keys: last wins);
    NULL for anything that is not an object."""
    return F.try_variant_get(v, "$", "map<string,variant>")


def field(m: Column, name: str) -> Column:
    """Value of one key: NULL when absent, a VARIANT null when JSON null."""
    return m.getItem(name)


def type_name(x: Column) -> Column:
    return F.schema_of_variant(x)


def is_numeric_type(t: Column) -> Column:
    return t.isin(*INTEGRAL_TYPES, *FLOAT_TYPES) | t.startswith("DECIMAL(")


def json_type(x: Column, raw_text: Column | None = None) -> Column:
    """Python-json type label of a VARIANT value; NULL when the value is absent.

    ``raw_text``: the value's text as written (needed only for non-BIGINT numbers);
    without it such numbers are labelled ``number``.
    """
    t = F.schema_of_variant(x)
    integral_text = (raw_text.rlike(r"^-?[0-9]+$") if raw_text is not None else F.lit(False))
    return (F.when(x.isNull(), F.lit(None).cast("string"))
            .when(t == "VOID", "null")
            .when(t == "BOOLEAN", "boolean")
            .when(t == "STRING", "string")
            .when(t.startswith("ARRAY"), "array")
            .when(t.startswith("OBJECT"), "object")
            .when(t.isin(*INTEGRAL_TYPES), "integer")
            .when(is_numeric_type(t), F.when(integral_text, "integer").otherwise("number"))
            .otherwise(F.lower(t)))


def raw_texts(text: Column) -> Column:
    """Top-level values of a JSON object as written (strings unquoted)."""
    return F.from_json(text, "map<string,string>")


def as_string(x: Column) -> Column:
    return F.try_variant_get(x, "$", "string")


def as_double(x: Column) -> Column:
    return F.try_variant_get(x, "$", "double")


def as_int(x: Column) -> Column:
    return F.try_variant_get(x, "$", "int")
