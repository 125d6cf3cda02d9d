"""Fixed dimensions: locales, regional overrides and language names.

They hold 28, 4 and 31 rows, so they are literal maps in the plan: a lookup is a projection, not a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ludoshelf.functions.clean import col, collapse, strip
from ludoshelf.functions.variant import let

# Store country used when a request names none; locale used for an empty list.
DEFAULT_STORE_COUNTRY = "kz"
DEFAULT_LOCALE = "en-US"

# Language subtag -> (web language, store language).
LANGUAGES = {
    "ar": ("ar", "arabic"),
    "bg": ("bg", "bulgarian"),
    "cs": ("cs", "czech"),
    "da": ("da", "danish"),
    "de": ("de", "german"),
    "el": ("el", "greek"),
    "en": ("en", "english"),
    "es": ("es", "spanish"),
    "fi": ("fi", "finnish"),
    "fr": ("fr", "french"),
    "hu": ("hu", "hungarian"),
    "id": ("id", "indonesian"),
    "it": ("it", "italian"),
    "ja": ("ja", "japanese"),
    "ko": ("ko", "koreana"),
    "ms": ("ms", "malay"),
    "nl": ("nl", "dutch"),
    "no": ("no", "norwegian"),
    "pl": ("pl", "polish"),
    "pt": ("pt", "portuguese"),
    "ro": ("ro", "romanian"),
    "ru": ("ru", "russian"),
    "sv": ("sv", "swedish"),
    "th": ("th", "thai"),
    "tr": ("tr", "turkish"),
    "uk": ("uk", "ukrainian"),
    "vi": ("vi", "vietnamese"),
    "zh": ("zh-CN", "schinese"),
}

# Full locales that do not follow their language subtag.
REGIONAL_OVERRIDES = {
    "zh-cn": ("zh-CN", "schinese"),
    "zh-tw": ("zh-TW", "tchinese"),
    "es-419": ("es-419", "latam"),
    "pt-br": ("pt-BR", "brazilian"),
}

# English language name -> (web language, store language).
LANGUAGE_NAMES = {
    "arabic": ("ar", "arabic"),
    "bulgarian": ("bg", "bulgarian"),
    "czech": ("cs", "czech"),
    "danish": ("da", "danish"),
    "dutch": ("nl", "dutch"),
    "english": ("en", "english"),
    "finnish": ("fi", "finnish"),
    "french": ("fr", "french"),
    "german": ("de", "german"),
    "greek": ("el", "greek"),
    "hungarian": ("hu", "hungarian"),
    "indonesian": ("id", "indonesian"),
    "italian": ("it", "italian"),
    "japanese": ("ja", "japanese"),
    "korean": ("ko", "koreana"),
    "malay": ("ms", "malay"),
    "norwegian": ("no", "norwegian"),
    "polish": ("pl", "polish"),
    "portuguese - portugal": ("pt", "portuguese"),
    "portuguese - brazil": ("pt-BR", "brazilian"),
    "romanian": ("ro", "romanian"),
    "russian": ("ru", "russian"),
    "simplified chinese": ("zh-CN", "schinese"),
    "spanish - spain": ("es", "spanish"),
    "spanish - latin america": ("es-419", "latam"),
    "swedish": ("sv", "swedish"),
    "thai": ("th", "thai"),
    "traditional chinese": ("zh-TW", "tchinese"),
    "turkish": ("tr", "turkish"),
    "ukrainian": ("uk", "ukrainian"),
    "vietnamese": ("vi", "vietnamese"),
}


def _lookup(table: dict[str, tuple[str, str]], key: Column) -> Column:
    entries = ", ".join(
        f"'{k}', named_struct('web_language', '{web}', 'steam_language', '{store}')" for k, (web, store) in table.items()
    )
    return F.try_element_at(F.expr(f"map({entries})"), key)


def locale_info(value: Column | str) -> Column:
    """struct<locale, web_language, steam_language> of a locale tag, null when unsupported."""

    def known(requested: Column) -> Column:
        key = F.lower(requested)
        hit = F.coalesce(
            _lookup(REGIONAL_OVERRIDES, key), _lookup(LANGUAGES, F.split_part(key, F.lit("-"), F.lit(1)))
        )
        return let(hit, lambda h: F.when(h.isNotNull(), _locale(requested, h)))

    return let(F.replace(strip(value), F.lit("_"), F.lit("-")), known)


def _locale(requested: Column, hit: Column) -> Column:
    return F.struct(
        requested.alias("locale"),
        hit["web_language"].alias("web_language"),
        hit["steam_language"].alias("steam_language"),
    )


def language_by_name(name: Column | str) -> Column:
    """struct<web_language, steam_language> of an English language name, null when unknown."""
    return language_by_clean_name(collapse(name))


def language_by_clean_name(name: Column | str) -> Column:
    """The same for a name whose white space is already collapsed."""
    return _lookup(LANGUAGE_NAMES, F.lower(col(name)))


def locale_dimension(spark: SparkSession) -> DataFrame:
    """The locale tables as one small DataFrame, for joins and reports."""
    rows = [(k, *v, False) for k, v in LANGUAGES.items()]
    rows += [(k, *v, True) for k, v in REGIONAL_OVERRIDES.items()]
    return spark.createDataFrame(rows, "tag string, web_language string, steam_language string, is_override boolean")
