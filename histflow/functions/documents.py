"""JSON documents: scalars, subtrees, arrays, canonical text, key prefixes.

Inside a plan a document is a VARIANT. VARIANT can be neither compared nor
grouped, so documents are stored, hashed and compared as canonical text:
``to_json`` of a VARIANT sorts the keys at every depth.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

EMPTY_OBJECT = "{}"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def document(text: Column | str) -> Column:
    """JSON text -> VARIANT; NULL where the text is not JSON."""
    return F.try_parse_json(_col(text))


def scalar_only(text: Column, doc: Column, path: str) -> Column:
    """The text read at ``path``, unless it is that of an object or array."""
    # Only text that starts like a container needs the look at the real type: a
    # string may start with a brace too.
    container = F.schema_of_variant(F.try_variant_get(doc, path, "variant")).rlike("^(OBJECT|ARRAY)<")
    return F.when(F.substring(text, 1, 1).isin("{", "[") & container, F.lit(None)).otherwise(text)


def json_value(doc: Column | str, path: str) -> Column:
    """The scalar at ``path`` as text; NULL for an object, array or JSON null.

    Numbers come in normal form, up to 38 digits; longer ones are rounded to a double.
    """
    doc = _col(doc)
    return scalar_only(F.try_variant_get(doc, path, "string"), doc, path)


def with_scalars(df: DataFrame, doc: str, paths: Mapping[str, str]) -> DataFrame:
    """Add ``json_value`` columns (name -> path), reading each path once.

    The texts are a projection of their own, so that checking and using one
    does not walk the document again.
    """
    texts = df.withColumns({name: F.try_variant_get(F.col(doc), path, "string") for name, path in paths.items()})
    return texts.withColumns({name: scalar_only(F.col(name), F.col(doc), path) for name, path in paths.items()})


def json_subtree(doc: Column | str, path: str) -> Column:
    """Canonical text of whatever is at ``path``; NULL only if nothing is."""
    return F.to_json(F.try_variant_get(_col(doc), path, "variant"))


def json_quote(text: Column | str) -> Column:
    """Text as a JSON string with quotes and escapes; NULL as ``null``."""
    text = _col(text)
    # the brackets of a list of one go; the quotes inside them keep the text's own
    return F.when(text.isNull(), "null").otherwise(F.btrim(F.to_json(F.array(text)), F.lit("[]")))


def json_member(key: str | Column, value: Column) -> Column:
    """An object member as ``struct(key, "key":value)``; a plain str is a constant key."""
    if isinstance(key, str):
        return F.struct(F.lit(key).alias("key"), F.concat(F.lit(f"{json.dumps(key)}:"), value).alias("text"))
    return F.struct(key.alias("key"), F.concat(json_quote(key), F.lit(":"), value).alias("text"))


def json_object(members: Column) -> Column:
    """Object text from an array of ``json_member``; keys must be distinct.

    Keys come out sorted, so the text is canonical.
    """
    return F.concat(F.lit("{"), F.array_join(F.sort_array(members)["text"], ","), F.lit("}"))


def json_elements(text: Column | str) -> Column:
    """JSON array text -> array of VARIANT; NULL where it is not an array."""
    return F.from_json(_col(text), "array<variant>")


def json_first(text: Column | str) -> Column:
    """Element 0 of a JSON array, or an empty object."""
    return F.coalesce(
        F.try_variant_get(document(text), "$[0]", "variant"),
        F.parse_json(F.lit(EMPTY_OBJECT)),
    )


def json_object_of(text: Column | str) -> Column:
    """A payload's object: the JSON object itself, or element 0 of an array, or an empty object."""
    doc = document(text)
    whole = F.when(F.schema_of_variant(doc).startswith("OBJECT<"), doc)
    return F.coalesce(whole, F.try_variant_get(doc, "$[0]", "variant"), F.parse_json(F.lit(EMPTY_OBJECT)))


def canonical(text: Column | str) -> Column:
    """JSON text with sorted keys and normal numbers; NULL if not JSON."""
    return F.to_json(document(text))


def document_or_empty(text: Column | str) -> Column:
    """Canonical text for comparing; text that is not JSON stands for itself, NULL for ``{}``."""
    return F.coalesce(canonical(text), _col(text), F.lit(EMPTY_OBJECT))


#: The texts of an empty object.
_EMPTY = r"^[ \t\n\r]*\{[ \t\n\r]*\}[ \t\n\r]*$"


def documents_differ(a: Column | str, b: Column | str) -> Column:
    """Whether two documents differ; NULL and ``{}`` mean the same.

    Equal texts are equal documents, and NULL equals the empty object alone: only two
    different texts are parsed.
    """
    a, b = _col(a), _col(b)
    return (
        F.when(a.eqNullSafe(b), False)
        .when(a.isNull(), ~b.rlike(_EMPTY))
        .when(b.isNull(), ~a.rlike(_EMPTY))
        .otherwise(document_or_empty(a) != document_or_empty(b))
    )


def same_document(a: Column | str, b: Column | str) -> Column:
    """Equality of canonical texts where NULL and ``{}`` mean the same."""
    return ~documents_differ(a, b)


def prefix_split(doc: Column | str, prefix: str) -> Column:
    """The top-level keys with a prefix and a non-null value, as an object."""
    members = F.try_variant_get(_col(doc), "$", "map<string,variant>")
    chosen = F.map_filter(members, lambda k, v: k.startswith(prefix) & ~F.is_variant_null(v))
    return F.coalesce(F.to_json(chosen), F.lit(EMPTY_OBJECT))
