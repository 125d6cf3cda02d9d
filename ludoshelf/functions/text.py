"""Text out of HTML, entities and slugs.

Tags are removed in the JVM. Only two rules need Python, both as small Arrow functions: HTML entity
names and Unicode decomposition. Rows that need neither are passed to the worker as null.
"""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from ludoshelf.functions.clean import col, collapse

# Comments, raw-text elements (their content is text), tags, declarations.
MARKUP = (
    r"(?is)<!--.*?(?:-->|\z)"
    r"|<(script|style)\b[^>]*+>(.*?)(?:</\1\s*>|\z)"
    r"""|</?[a-z](?:[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+>|[^>]*+>)"""
    r"|<[!?][^>]*+>"
)


@pandas_udf(T.StringType())
def _decode_entities(values: pd.Series) -> pd.Series:
    return values.map(html.unescape, na_action="ignore")


@pandas_udf(T.ArrayType(T.StringType()))
def _decode_entities_each(values: pd.Series) -> pd.Series:
    return values.map(lambda parts: [html.unescape(p) for p in parts], na_action="ignore")


@pandas_udf(T.StringType())
def _to_ascii(values: pd.Series) -> pd.Series:
    return values.map(
        lambda s: unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode("ascii"),
        na_action="ignore",
    )


def strip_markup(c: Column | str) -> Column:
    """Markup becomes a space; text nodes stay, entities are not decoded."""
    c = col(c)
    return F.when(c.contains("<"), F.regexp_replace(c, MARKUP, " $2 ")).otherwise(c)


def plain_text(c: Column | str) -> Column:
    """Text nodes joined by one space, white space collapsed; null stays null."""
    c = col(c)
    bare = strip_markup(c)
    # Either branch runs the pattern once: with an entity for the worker, without one for the fallback.
    return collapse(F.coalesce(_decode_entities(F.when(c.contains("&"), bare)), bare))


def plain_text_each(parts: Column) -> Column:
    """``plain_text`` over every element of an array of fragments."""
    bare = F.transform(parts, strip_markup)
    has_entity = F.exists(parts, lambda p: p.contains("&"))
    decoded = F.coalesce(_decode_entities_each(F.when(has_entity, bare)), bare)
    return F.transform(decoded, collapse)


def text_value(c: Column | str) -> Column:
    """The {text, html} pair of a fragment, null for null."""
    c = col(c)
    return F.when(c.isNotNull(), F.struct(plain_text(c).alias("text"), c.alias("html")))


# Fixed value: symbols dropped from a title before it becomes a slug.
SLUG_SYMBOLS = "[™®©]"


def slug(title: Column | str) -> Column:
    """ASCII slug: symbols out, accents decomposed, other runs to '-', trimmed, lower case."""
    bare = F.regexp_replace(col(title), SLUG_SYMBOLS, "")
    ascii_only = F.coalesce(_to_ascii(F.when(bare.rlike(r"[^\x00-\x7f]"), bare)), bare)
    return F.lower(F.btrim(F.regexp_replace(ascii_only, "[^a-zA-Z0-9]+", "-"), F.lit("-")))
