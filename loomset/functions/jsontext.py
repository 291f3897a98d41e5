"""JSON as text: string literals and single members, by built-in expressions only.

A text is cut into tokens by one pattern (string literals, marks, everything
else), so strings are told from marks without parsing to a schema, at any depth,
and what isn't edited stays as it is, byte by byte. Patterns are possessive: they
neither backtrack nor recurse, however long a literal is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_LITERAL = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
#: A key comes with its colon, a value ends with its quote.
_KEY_OR_VALUE = rf"(?s){_LITERAL}(?:\s*+:)?+"
_TOKEN = rf'(?s){_LITERAL}|[{{}}\[\],:]|[^"{{}}\[\],:]++'


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once however often it is used."""
    return F.transform(F.array(value), body)[0]


def without_mark(text: Column) -> Column:
    """The text without a byte-order mark."""
    return F.when(text.startswith("﻿"), F.substring(text, 2, 2**31 - 1)).otherwise(text)


def is_json(text: Column) -> Column:
    """Whether the whole text is one JSON value.

    A parser stops after the first value, so the text is tried as the only element of
    a list and as the only member of an object: nothing else passes both."""
    strict = {"allowSingleQuotes": "false"}
    listed = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>", strict)
    member = F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), "v string, _corrupt_record string", strict)
    return F.coalesce((F.size(listed) == 1) & member["_corrupt_record"].isNull(), F.lit(False))


def decoded(literal: Column) -> Column:
    """The string that a literal with its quotes stands for."""
    plain = F.substring(literal, 2, F.length(literal) - 2)
    return F.when(literal.contains("\\"), F.get_json_object(F.concat(F.lit("["), literal, F.lit("]")), "$[0]")).otherwise(plain)


def string_values(text: Column) -> Column:
    """All string values of a JSON text at any depth, decoded and in order; keys are none."""
    found = F.regexp_extract_all(text, F.lit(_KEY_OR_VALUE), 0)
    return F.transform(F.filter(found, lambda x: x.endswith('"')), decoded)


def set_member(text: Column, key: str, value: Column) -> Column:
    """The JSON object with one member of the top level set to a JSON value (a text).

    All the rest is copied as it is: order, blanks, numbers, nested values. An absent
    key is added at the end; of a repeated key the last one is set, the one that
    parsers take. Null for null, for text that is no JSON and for anything but an object.
    """
    none = F.lit(None).cast("string")
    start = F.struct(
        F.lit(0).alias("i"), F.lit(0).alias("depth"), F.lit(0).alias("members"), none.alias("last"), F.lit(False).alias("inside"), F.lit(0).alias("first"), F.lit(0).alias("end"),
    )

    def step(a: Column, x: Column) -> Column:
        i, top = a["i"] + 1, a["depth"] == 1
        opening, closing = x.isin("{", "["), x.isin("}", "]")
        colon, stop = top & (x == ":"), a["inside"] & top & (x.isin(",", "}"))
        hit = colon & (decoded(a["last"]) == key)
        return F.struct(
            i.alias("i"), (a["depth"] + F.when(opening, 1).when(closing, -1).otherwise(0)).alias("depth"), (a["members"] + colon.cast("int")).alias("members"),
            F.when(x.startswith('"'), x).otherwise(a["last"]).alias("last"), F.when(hit, True).when(stop, False).otherwise(a["inside"]).alias("inside"),
            F.when(hit, i + 1).otherwise(a["first"]).alias("first"), F.when(hit, 0).when(stop, i - 1).otherwise(a["end"]).alias("end"),
        )

    def edit(tokens: Column) -> Column:
        def at(a: Column) -> Column:
            joined = lambda first, size: F.array_join(F.slice(tokens, first, size), "")
            old = joined(a["first"], a["end"] - a["first"] + 1)
            blanks = F.regexp_extract(old, r"\A\s*+", 0), F.regexp_extract(old, r"\s*\z", 0)
            replaced = F.concat(joined(F.lit(1), a["first"] - 1), blanks[0], value, blanks[1], joined(a["end"] + 1, F.size(tokens)))
            tail = F.regexp_extract(text, r"\s*\}\s*\z", 0)
            head = F.substring(text, F.lit(1), F.length(text) - F.length(tail))
            literal = F.lit('"' + key.replace("\\", "\\\\").replace('"', '\\"') + '": ')
            added = F.concat(head, F.when(a["members"] > 0, ", ").otherwise(""), literal, value, tail)
            return F.when(a["first"] > 0, replaced).otherwise(added)

        return let(F.aggregate(tokens, start, step), at)

    edited = let(F.regexp_extract_all(text, F.lit(_TOKEN), 0), edit)
    return F.when(F.ltrim(text).startswith("{") & is_json(text), edited)


def quoted(text: Column) -> Column:
    """A string as a JSON literal, characters beyond ASCII as they are."""
    return F.regexp_extract(F.to_json(F.struct(text.alias("v"))), r'(?s)\A\{"v":(.*)\}\z', 1)
