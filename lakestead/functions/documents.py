"""Queries over JSON documents kept as text.

Fields are read with the built-in JSON reader. Where the type of a value matters (containment,
update) the document is parsed to VARIANT, which tells ``1`` from ``"1"`` and a null value from an
absent key. A document that does not parse, or repeats a key, gives NULL there.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F


def field_text(doc: Column, key: str) -> Column:
    """Field as text; NULL for an absent key and for a null value."""
    if "'" in key:  # a path cannot name it
        return F.try_element_at(F.from_json(doc, "map<string,string>"), F.lit(key))
    return F.get_json_object(doc, f"$['{key}']")


def path_text(doc: Column, path: str) -> Column:
    return F.get_json_object(doc, path)


def fields(df: DataFrame, doc: str, keys: list[str]) -> DataFrame:
    """Add one text column per key, parsing each document once."""
    schema = ", ".join(f"`{k}` string" for k in keys)
    parsed = df.withColumn("_fields", F.from_json(F.col(doc), schema))
    return parsed.select(*df.columns, *[F.col(f"_fields.`{k}`").alias(k) for k in keys])


def sub_document(doc: Column, path: str) -> Column:
    """The value under ``path`` as JSON text; strings keep their quotes."""
    return F.to_json(F.variant_get(F.try_parse_json(doc), path, "variant"))


def field_as(doc: Column, key: str, data_type: str) -> Column:
    """Field cast to a type; NULL where the text does not fit it."""
    return field_text(doc, key).try_cast(data_type)


def keys_of(doc: Column) -> Column:
    return F.json_object_keys(doc)


def has_key(doc: Column, key: str) -> Column:
    """True when the key is there, also with a null value; false for a document without it."""
    return F.coalesce(F.array_contains(keys_of(doc), key), F.lit(False))


def path_exists(doc: Column, path: str) -> Column:
    """True when the path leads to a value, null included."""
    return F.variant_get(F.try_parse_json(doc), path, "variant").isNotNull()


def is_null_or_empty(doc: Column) -> Column:
    return doc.isNull() | F.coalesce(F.size(keys_of(doc)) == 0, F.lit(False))


def contains(doc: Column, pattern: Any) -> Column:
    """Does the document contain ``pattern`` (a dict, list or scalar)?

    Objects match key by key, arrays when every wanted element matches some element.
    """
    return F.coalesce(_contains(F.try_parse_json(doc), pattern), F.lit(False))


def _contains(value: Column, pattern: Any) -> Column:
    kind = F.schema_of_variant(value)
    if isinstance(pattern, dict):
        matches = kind.startswith("OBJECT")
        for key, wanted in pattern.items():
            matches = matches & _contains(member(value, key), wanted)
        return matches
    if isinstance(pattern, list):
        elements = F.try_variant_get(value, "$", "array<variant>")
        matches = kind.startswith("ARRAY")
        for wanted in pattern:
            matches = matches & F.exists(elements, _matcher(wanted))
        return matches
    if pattern is None:
        return F.is_variant_null(value)
    if isinstance(pattern, bool):
        return (kind == "BOOLEAN") & (F.try_variant_get(value, "$", "boolean") == F.lit(pattern))
    if isinstance(pattern, (int, float)):
        return (kind != "STRING") & (
            F.try_variant_get(value, "$", "decimal(38,10)") == F.lit(str(pattern)).cast("decimal(38,10)")
        )
    return (kind == "STRING") & (F.try_variant_get(value, "$", "string") == F.lit(pattern))


def member(value: Column, key: str) -> Column:
    """The member of a VARIANT object by any name; a path can quote one kind of quotes."""
    for quote in "'\"":
        if quote not in key:
            return F.try_variant_get(value, f"$[{quote}{key}{quote}]", "variant")
    return F.try_element_at(F.try_variant_get(value, "$", "map<string,variant>"), F.lit(key))


def _matcher(wanted: Any) -> Callable[[Column], Column]:
    return lambda element: F.coalesce(_contains(element, wanted), F.lit(False))


def merge(doc: Column, patch: dict[str, Any]) -> Column:
    """Top-level merge; the patch wins and other values keep their types.

    Documents that are NULL or no object stay as they are.
    """
    names = list(patch)
    kept = F.map_filter(_entries(doc), lambda k, _: ~k.isin(names))
    added = F.create_map(
        *[c for k in names for c in (F.lit(k), F.parse_json(F.lit(json.dumps(patch[k]))))]
    )
    return F.coalesce(F.to_json(F.map_concat(kept, added)), doc)


def set_field(doc: Column, key: str, value: Any, create_missing: bool = True) -> Column:
    updated = merge(doc, {key: value})
    return updated if create_missing else F.when(has_key(doc, key), updated).otherwise(doc)


def pretty(doc: Column) -> Column:
    """The document with a line per member and element, four blanks deeper per level; NULL where it does not parse.

    The text is cut into tokens, and depth is a running sum of the brackets outside strings. Tokens are put together in
    blocks of about the root of their number, so long documents are not copied once per token. Members keep
    their order.
    """
    found = F.regexp_extract_all(doc, F.lit(_TOKENS), F.lit(0))

    def once(value: Column, use: Callable[[Column], Column]) -> Column:
        """use() of a value that is computed once, as a lambda variable is."""
        return F.transform(F.array(value), use)[0]

    def cut(tokens: Column, block: Column) -> Column:
        starts = F.sequence(F.lit(0), F.ceil(F.size(tokens) / block).cast("int") - 1)
        return F.transform(starts, lambda n: F.slice(tokens, n * block + 1, block))

    blocks = once(found, lambda t: once(F.ceil(F.sqrt(F.size(t))).cast("int"), lambda size: cut(t, size)))

    def state(depth: Column, last: Column, text: Column) -> Column:
        return F.struct(depth.alias("depth"), last.alias("last"), text.alias("text"))

    def line(depth: Column) -> Column:
        return F.concat(F.lit("\n"), F.repeat(F.lit("    "), depth))

    def step(at: Column, token: Column) -> Column:
        opens, closes = token.isin("{", "["), token.isin("}", "]")
        first = at["last"].isin("{", "[")
        lead = (
            F.when(closes, F.when(first, "").otherwise(line(at["depth"] - 1)))
            .when(first | (at["last"] == ","), line(at["depth"]))
            .when(at["last"] == ":", " ")
            .otherwise("")
        )
        depth = at["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)
        return state(depth, token, F.concat(at["text"], lead, token))

    def add(done: Column, part: Column) -> Column:
        start = state(done["depth"], done["last"], F.lit(""))
        return once(
            F.aggregate(part, start, step),
            lambda s: state(s["depth"], s["last"], F.concat(done["text"], s["text"])),
        )

    whole = F.aggregate(blocks, state(F.lit(0), F.lit(""), F.lit("")), add, lambda s: s["text"])
    return F.when(F.try_parse_json(doc).isNotNull(), whole)


_TOKENS = r'"(?:[^"\\]|\\.)*"|[{}\[\],:]|[^\s{}\[\],:"]+'


def _entries(doc: Column) -> Column:
    return F.try_variant_get(F.try_parse_json(doc), "$", "map<string,variant>")


def each_text(df: DataFrame, doc: str, keep: list[str]) -> DataFrame:
    """One row per top-level key with its value as text; of a repeated key the last value."""
    parsed = df.select(*keep, F.map_entries(F.from_json(F.col(doc), "map<string,string>")).alias("_entries"))
    all_of = F.col("_entries")

    def is_last(entry: Column, at: Column) -> Column:
        return ~F.exists(F.slice(all_of, at + 2, F.size(all_of)), lambda later: later["key"] == entry["key"])

    entries = parsed.select(*keep, F.explode(F.filter(all_of, is_last)).alias("_entry"))
    return entries.select(*keep, "_entry.key", "_entry.value")


def distinct_keys(df: DataFrame, doc: str) -> DataFrame:
    return df.select(F.explode(keys_of(F.col(doc))).alias("field_name")).distinct()


def search(doc: Column, text: str) -> Column:
    """Case-insensitive substring test over the whole document text."""
    return doc.ilike("%" + re.sub(r"([\\%_])", r"\\\1", text) + "%")
