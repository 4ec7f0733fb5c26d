"""JSON text columns: one parse per document, tolerant numerics, column fallbacks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def json_text(doc: Column, path: str) -> Column:
    """Text at ``$.path``; call it on its own result to read a JSON text nested in a JSON text."""
    return F.get_json_object(doc, f"$.{path}")


def with_json_fields(df: DataFrame, doc: Column, names: Mapping[str, str]) -> DataFrame:
    """Add text columns (field -> column name) read from ``doc``, in a single parse per row.

    For fields that are filtered or joined on: they come from a generator, which such conditions are not
    pushed through, while an expression would be parsed again in every condition that mentions it.
    """
    return df.select("*", F.json_tuple(doc, *names).alias(*names.values()))


def with_document(df: DataFrame, doc: Column, name: str) -> DataFrame:
    """Add ``doc`` as a parsed document (VARIANT), so that any number of fields at any depth cost one parse.

    Malformed and null text gives null. Of repeated keys no value is taken: such a text counts as malformed.
    """
    return df.withColumn(name, F.try_parse_json(doc))


def document_text(document: Column, path: str) -> Column:
    """Text at ``$.path`` of a parsed document: objects and lists as JSON text, JSON null as null.

    Numbers come in their shortest form (``5.50`` as ``5.5``), where :func:`json_text` keeps the characters.
    """
    return F.try_variant_get(document, f"$.{path}", "string")


def document_double(document: Column, path: str, default: float | None = None) -> Column:
    """Double at ``$.path`` of a parsed document, under the rules of :func:`text_to_double`."""
    return text_to_double(document_text(document, path), default)


def text_to_double(text: Column, default: float | None = None) -> Column:
    """Double from text; empty, missing or non-numeric text gives ``default``."""
    number = F.nullif(F.trim(text), F.lit("")).try_cast("double")
    return number if default is None else F.coalesce(number, F.lit(float(default)))


def json_struct(doc: Column, names: Sequence[str]) -> Column:
    """Struct of text fields read from ``doc`` in a single parse, which is skipped when no field is used.

    A nested object arrives as its JSON text and a nested JSON string as its content, so both shapes can
    be parsed again.
    """
    return F.from_json(doc, T.StructType([T.StructField(n, T.StringType()) for n in names]))


def json_double(doc: Column, path: str, default: float | None = None) -> Column:
    return text_to_double(json_text(doc, path), default)


def non_empty_or(text: Column, fallback: Column) -> Column:
    """``text`` when it is not null and not empty, else ``fallback``."""
    return F.coalesce(F.nullif(text, F.lit("")), fallback)


def json_or(doc: Column, path: str, fallback: Column) -> Column:
    return non_empty_or(json_text(doc, path), fallback)
