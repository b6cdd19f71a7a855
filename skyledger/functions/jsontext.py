"""JSON text helpers."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A whole string literal (kept through $1), or a run of white space between tokens (dropped).
_STRING_OR_SPACE = r'("[^"\\]*+(?:\\.[^"\\]*+)*+")|[ \t\r\n]+'


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once however often ``use`` mentions it.

    For parses of whole documents. It leaves generated code, so cheap values are better repeated.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def evaluated(rows: DataFrame, **values: Column) -> DataFrame:
    """``rows`` with further columns that are computed once a row, whatever is asked of them.

    They leave a generator of one row. The optimizer copies the expressions of a projection into
    each filter above it, and so repeats a parse of a document; it does not look into a generator.
    """
    named = F.struct(*[value.alias(name) for name, value in values.items()])
    return rows.select("*", F.inline(F.array(named)))


STRICT = {"allowSingleQuotes": "false"}
_CONTAINER_TYPE = "^(ARRAY|OBJECT)"


def sealed(document: Column) -> Column:
    """A list of the document and a seal, by which one parse reads it and tells if it is whole.

    A parser stops after the first value. In a list, text after a value is an error, a second value
    shows in the list's length, and a text that closes the list early leaves no seal after it: it
    would have to hold its own checksum.
    """
    seal = F.concat(F.lit(',{"seal":"'), F.sha2(document, 256), F.lit('"}]'))
    return F.concat(F.lit("["), document, seal)


def unsealed(read: Column, document: Column) -> Column:
    """The value read from ``sealed`` text, an object with a field or key ``seal``; NULL if not whole."""
    intact = (F.size(read) == 2) & (F.get(read, F.lit(1))["seal"] == F.sha2(document, 256))
    return F.when(intact, F.get(read, F.lit(0)))


def member(fields: Column, name: str) -> Column:
    """Value of a key in a map read from JSON; of a repeated key the last one."""
    found = F.filter(F.map_entries(fields), lambda entry: entry["key"] == name)
    return F.try_element_at(found, F.lit(-1))["value"]


def _looks_nested(text: Column) -> Column:
    return text.startswith("{") | text.startswith("[")


def _typed_as_container(value: Column) -> Column:
    return F.schema_of_variant(value).rlike(_CONTAINER_TYPE)


def scalar_only(text: Column, tree: Column, path: str) -> Column:
    """NULL out ``text``, read at ``path``, if the value there is an object or an array.

    Text that begins like one may still be a string; then the value's type in the document's
    ``tree``, a VARIANT, decides. A document that has no tree (a repeated key) is judged by its text.
    """
    nested = F.coalesce(_typed_as_container(F.try_variant_get(tree, path, "variant")), F.lit(True))
    return F.when(~_looks_nested(text), text).when(~nested, text)


def json_scalar(document: Column, path: str) -> Column:
    """The scalar at ``path`` as text; objects, arrays, JSON null and missing paths give NULL.

    Numbers come in the parser's shortest form, so 2.50 reads as '2.5'.
    """
    return scalar_only(F.get_json_object(document, path), F.try_parse_json(document), path)


def needs_tree(texts: list[Column], arrays: list[Column]) -> Column:
    """Whether any of these begins like an object or array, so that only types can decide."""
    looks = [_looks_nested(t) for t in texts] + [F.exists(a, _looks_nested) for a in arrays]
    return reduce(or_, [F.coalesce(seen, F.lit(False)) for seen in looks])


def nested_elements(items: Column, tree: Column, path: str) -> Column:
    """For each element of the array at ``path``, read as text, whether it is an object or array."""
    values = F.try_variant_get(tree, path, "array<variant>")
    typed = F.transform(values, _typed_as_container)
    looks = F.transform(items, lambda x: F.coalesce(_looks_nested(x), F.lit(False)))
    return F.when(F.exists(looks, lambda x: x), F.coalesce(typed, looks)).otherwise(looks)


def scalar_array(items: Column, tree: Column, path: str) -> Column:
    """An ``array<string>`` read at ``path``, NULL as a whole if any element is not a scalar."""
    nested = nested_elements(items, tree, path)
    return F.when(~F.coalesce(F.exists(nested, lambda x: x), F.lit(False)), items)


def compact(document: Column) -> Column:
    """Drop white space between JSON tokens, keeping key order and unknown keys."""
    return F.regexp_replace(document, _STRING_OR_SPACE, "$1")


def without_bom(text: Column) -> Column:
    """Strip a leading byte-order mark, which JSON parsers reject."""
    return F.regexp_replace(text, "^﻿", "")
