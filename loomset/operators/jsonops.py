"""Keyword search, flattening and editing of arbitrary JSON, by built-in expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsontext

# blanks as the replaced tools strip them: white space and the four separators below it
_BLANK = r"[\s\x1c-\x1f]"


def contains_keyword(text: Column, keyword: str, mode: str = "value") -> Column:
    """True where a string value anywhere in the JSON equals the keyword.

    Trimmed, any case; keys don't count. Text that is not JSON is searched for the
    quoted keyword. ``token`` compares the words of string values instead. Null and
    empty texts hold nothing. A cheap containment test goes first.
    """
    wanted = keyword.strip().lower()
    clean = jsontext.without_mark(text)
    if mode == "token":
        same = lambda x: F.array_contains(F.split(F.lower(x), f"(?U){_BLANK}+"), wanted)
    else:
        same = lambda x: F.lower(F.regexp_replace(x, rf"(?U)\A{_BLANK}+|{_BLANK}+\z", "")) == wanted
    loose = clean.rlike(rf'(?iU)"\s*{re.escape(wanted)}\s*"(?=[,\]}}])')
    likely = F.lower(text).contains(wanted) | text.contains("\\")
    inside = F.when(jsontext.is_json(clean), F.exists(jsontext.string_values(clean), same)).otherwise(loose)
    return F.coalesce(F.when(likely & (text != ""), inside), F.lit(False))


def flatten_objects(rows: DataFrame, text_col: str) -> DataFrame:
    """(item, key, value) of every object, or object in a list, per JSON text.

    Other things in a list are passed over, and items are numbered without them; bad
    JSON yields nothing. Nested values are JSON text, null is null."""
    clean = jsontext.without_mark(F.col(text_col))
    of_object = lambda x: F.from_json(x, "map<string,string>")
    elements = F.filter(F.from_json(clean, "array<variant>"), lambda v: F.schema_of_variant(v).startswith("OBJECT"))
    # a variant takes no object with a repeated key; the plain map does
    many = F.coalesce(F.transform(elements, lambda v: of_object(F.to_json(v))), F.from_json(clean, "array<map<string,string>>"))
    objects = F.when(jsontext.is_json(clean), F.when(F.ltrim(clean).startswith("["), many).when(F.ltrim(clean).startswith("{"), F.array(of_object(clean))))
    one = rows.select(*[c for c in rows.columns if c != text_col], F.posexplode(objects).alias("item", "_o")).where(F.col("_o").isNotNull())
    return one.select(*[c for c in one.columns if c != "_o"], F.explode("_o").alias("key", "value"))


def to_table(flat: DataFrame, by: list[str], keys: list[str]) -> DataFrame:
    """A column per key in the given order, missing values empty."""
    return flat.groupBy(*by).pivot("key", keys).agg(F.first("value")).na.fill("", keys)


def patch_file_name(text: Column, new_name: Column) -> Column:
    """The JSON object with its file_name replaced or added, the rest as it was; null for anything else."""
    return jsontext.set_member(text, "file_name", jsontext.quoted(new_name))
