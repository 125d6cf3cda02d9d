"""Typed reads from VARIANT values.

JSON bodies are parsed once to VARIANT. A missing key is SQL NULL, an explicit JSON null is a
variant null; the two differ for some rules, so leaves stay VARIANT until a rule reads them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludoshelf.functions.clean import FALSE_WORDS, TRUE_WORDS, col, strip


def read(v: Column | str, data_type: str) -> Column:
    """Cast a variant; anything that does not fit becomes null."""
    return F.try_variant_get(col(v), "$", data_type)


def leaves(names: Iterable[str]) -> str:
    """DDL of a struct whose members stay VARIANT; reading it also tests for 'is an object'."""
    return "struct<" + ",".join(f"`{name}`:variant" for name in names) + ">"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def computed_once(rows: DataFrame, **columns: Column) -> DataFrame:
    """Rows with new columns from a one-row generate.

    A filter on such a column stays above the generate. With a plain projection it would be pushed below and
    would parse the body again, once per mention. The same holds for the size filter that the optimizer infers
    for every explode.
    """
    return rows.select("*", F.inline(F.array(F.struct(*(c.alias(name) for name, c in columns.items())))))


def kind(v: Column | str) -> Column:
    return F.schema_of_variant(col(v))


def string(v: Column | str) -> Column:
    """The value if it is a JSON string (an object or number is not free text)."""
    v = col(v)
    return F.when(kind(v) == "STRING", read(v, "string"))


def text(v: Column | str) -> Column:
    """Any scalar as text; null stays null."""
    return read(v, "string")


def integer(v: Column | str) -> Column:
    """Lenient integer: numbers, booleans and digit strings; everything else null."""
    return read(v, "bigint")


def number(v: Column | str) -> Column:
    return read(v, "double")


def boolean(v: Column | str) -> Column:
    """Lenient boolean: booleans, numbers (non-zero), and the accepted words."""
    v = col(v)
    word = F.lower(strip(read(v, "string")))
    return (
        F.when(kind(v) == "BOOLEAN", read(v, "boolean"))
        .when(kind(v) == "STRING", F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False))
        .when(kind(v) != "VOID", number(v) != 0)
    )


def truthy(v: Column | str) -> Column:
    """Truth of a value: true, non-zero, non-empty text. Never null."""
    v = col(v)
    return F.coalesce(
        F.when(kind(v) == "STRING", read(v, "string") != "")
        .when(kind(v) == "BOOLEAN", read(v, "boolean"))
        .when(kind(v).like("OBJECT<%_>") | kind(v).like("ARRAY<%_>"), F.lit(True))
        .when(kind(v) != "VOID", number(v) != 0),
        F.lit(False),
    )


def items(v: Column | str) -> Column:
    """Elements of a JSON array; missing, null and non-arrays give an empty array."""
    return F.coalesce(read(v, "array<variant>"), F.array().cast("array<variant>"))


def objects(v: Column | str, names: Iterable[str]) -> Column:
    """Object elements of a JSON array as structs of variants; other elements are dropped."""
    ddl = leaves(names)
    return F.filter(
        F.transform(items(v), lambda x: F.try_variant_get(x, "$", ddl)), lambda x: x.isNotNull()
    )


def entries(v: Column | str) -> Column:
    """Key/value entries of a JSON object; anything else gives an empty array."""
    return F.coalesce(
        F.map_entries(read(v, "map<string,variant>")),
        F.array().cast("array<struct<key:string,value:variant>>"),
    )
