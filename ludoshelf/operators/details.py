"""Product details. Every fact of one body is a projection over its variant leaves: no shuffle, no join.

Lists inside a body stay arrays in the row (``transform``/``filter``); ``item_rows`` turns one into a child
table where a report over many products needs it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludoshelf.functions import variant
from ludoshelf.functions.clean import blank_to_null, collapse, http_url, strip
from ludoshelf.functions.dims import language_by_clean_name
from ludoshelf.functions.text import plain_text_each, text_value
from ludoshelf.sources.landing import with_details

# Members read from a details object.
FIELDS = (
    "type", "name", "short_description", "detailed_description", "about_the_game", "is_free",
    "header_image", "website", "developers", "publishers", "release_date", "screenshots", "movies",
    "pc_requirements", "mac_requirements", "linux_requirements", "supported_languages", "platforms",
    "categories", "genres", "ratings", "price_overview", "metacritic",
)

# The release date formats, tried in this order.
DATE_FORMATS = ("MMM d, yyyy", "MMMM d, yyyy", "d MMM, yyyy", "yyyy-M-d")
# The outline of a date in each format. A failed parse is costly, so a format is tried only on its outline.
DATE_OUTLINES = (r"^\p{L}{3} ", r"^\p{L}{3,} ", r"^\d+ \p{L}{3},", r"^\d{4}-")

# Operating system -> member that holds its requirements.
REQUIREMENT_MEMBERS = {"windows": "pc_requirements", "mac": "mac_requirements", "linux": "linux_requirements"}


def landed_details(landed: DataFrame, names: tuple[str, ...] = FIELDS) -> DataFrame:
    """Details responses with ``data`` (the named members only) and ``error``."""
    return with_details(landed, names)


def release_date(raw: Column) -> Column:
    """Date of a free-text release date; the first four digits give the first day of that year."""
    candidate = collapse(raw)
    year = blank_to_null(F.regexp_extract(candidate, r"(\d{4})", 1)).try_cast("int")
    by_year = F.when(year > 0, F.make_date(year, F.lit(1), F.lit(1)))
    parsed = (
        F.when(candidate.rlike(outline), F.try_to_date(candidate, f))
        for outline, f in zip(DATE_OUTLINES, DATE_FORMATS, strict=True)
    )
    return F.coalesce(*parsed, by_year)


def release(v: Column) -> Column:
    """struct<release_date, release_date_raw, coming_soon>."""

    def read(member: Column) -> Column:
        raw = variant.string(member["date"])
        bare = strip(raw)
        return F.struct(
            variant.let(F.when(bare != "", bare), release_date).alias("release_date"),
            F.when(bare == "", raw).otherwise(bare).alias("release_date_raw"),
            variant.boolean(member["coming_soon"]).alias("coming_soon"),
        )

    return variant.let(variant.read(v, variant.leaves(("date", "coming_soon"))), read)


def price(v: Column) -> Column:
    """Price in minor units, null without a currency."""
    members = ("currency", "initial", "final", "discount_percent", "initial_formatted", "final_formatted")

    def read(p: Column) -> Column:
        currency = variant.string(p["currency"])
        return F.when(
            strip(currency) != "",
            F.struct(
                currency.alias("currency"),
                variant.integer(p["initial"]).alias("initial"),
                variant.integer(p["final"]).alias("final"),
                variant.integer(p["discount_percent"]).alias("discount_percent"),
                variant.string(p["initial_formatted"]).alias("initial_formatted"),
                variant.string(p["final_formatted"]).alias("final_formatted"),
            ),
        )

    return variant.let(variant.read(v, variant.leaves(members)), read)


def screenshots(v: Column) -> Column:
    return F.transform(
        variant.objects(v, ("id", "path_thumbnail", "path_full")),
        lambda s: F.struct(
            http_url(variant.string(s["path_thumbnail"])).alias("thumbnail_url"),
            http_url(variant.string(s["path_full"])).alias("full_url"),
            variant.integer(s["id"]).alias("id"),
        ),
    )


def videos(v: Column) -> Column:
    members = ("id", "name", "thumbnail", "dash_av1", "dash_h264", "hls_h264", "highlight")
    return F.transform(
        variant.objects(v, members),
        lambda m: F.struct(
            variant.integer(m["id"]).alias("id"),
            variant.string(m["name"]).alias("name"),
            http_url(variant.string(m["thumbnail"])).alias("thumbnail_url"),
            http_url(variant.string(m["dash_av1"])).alias("dash_av1_url"),
            http_url(variant.string(m["dash_h264"])).alias("dash_h264_url"),
            http_url(variant.string(m["hls_h264"])).alias("hls_h264_url"),
            variant.boolean(m["highlight"]).alias("highlight"),
        ),
    )


def requirement_fragments(v: Column) -> Column:
    """struct<minimum, recommended> of one system as HTML fragments, null when it is no object or holds neither."""

    def read(r: Column) -> Column:
        minimum, recommended = variant.string(r["minimum"]), variant.string(r["recommended"])
        return F.when(
            minimum.isNotNull() | recommended.isNotNull(),
            F.struct(minimum.alias("minimum"), recommended.alias("recommended")),
        )

    return variant.let(variant.read(v, variant.leaves(("minimum", "recommended"))), read)


def requirement_texts(r: Column) -> Column:
    return F.when(
        r.isNotNull(),
        F.struct(text_value(r["minimum"]).alias("minimum"), text_value(r["recommended"]).alias("recommended")),
    )


def language_fragments(v: Column) -> Column:
    """Parts of a language list as HTML fragments; the footnote after the first line break is cut off."""
    listed = F.regexp_extract(variant.string(v), r"(?is)\A(.*?)(?:<br\b|\z)", 1)
    return F.when(listed != "", F.split(listed, r",\s*")).otherwise(F.array().cast("array<string>"))


def languages(fragments: Column) -> Column:
    """Languages of the listed parts: interface and subtitles for all, full audio where marked."""
    pairs = F.arrays_zip(fragments.alias("raw"), plain_text_each(fragments).alias("text"))
    named = F.transform(
        pairs,
        lambda p: F.struct(
            F.trim(F.rtrim(p["text"], F.lit("*"))).alias("name"),
            (F.lower(p["raw"]).contains("<strong>") | strip(p["raw"]).endswith("*")).alias("full_audio"),
        ),
    )
    kept = F.filter(named, lambda p: (p["name"] != "") & ~F.lower(p["name"]).contains("languages with"))
    return F.transform(
        kept,
        lambda p: language_struct(p["name"], F.lit(True), F.lit(True), p["full_audio"]),
    )


def language_struct(name: Column, interface: Column, subtitles: Column, full_audio: Column) -> Column:
    return variant.let(
        language_by_clean_name(name),
        lambda hit: F.struct(
            name.alias("name"),
            hit["steam_language"].alias("steam_language"),
            hit["web_language"].alias("web_code"),
            interface.alias("interface"),
            subtitles.alias("subtitles"),
            full_audio.alias("full_audio"),
        ),
    )


def categories(v: Column) -> Column:
    described = F.filter(
        variant.objects(v, ("id", "description")), lambda c: variant.truthy(c["description"])
    )
    return F.transform(
        described,
        lambda c: F.struct(
            variant.integer(c["id"]).alias("id"),
            variant.text(c["description"]).alias("name"),
            F.lit("steam").alias("source"),
        ),
    )


def genres(v: Column) -> Column:
    described = F.filter(variant.objects(v, ("description",)), lambda g: variant.truthy(g["description"]))
    return F.transform(described, lambda g: variant.text(g["description"]))


def names(v: Column) -> Column:
    """Array of names (developers, publishers); null elements are dropped."""
    return F.filter(F.transform(variant.items(v), variant.text), lambda n: n.isNotNull())


def platforms(v: Column) -> Column:
    """Platform flags, only those that are really boolean."""
    flags = F.filter(variant.entries(v), lambda e: variant.kind(e["value"]) == "BOOLEAN")
    return F.map_from_entries(
        F.transform(flags, lambda e: F.struct(e["key"], variant.read(e["value"], "boolean").alias("value")))
    )


def descriptors(text: Column) -> Column:
    """Parts between semicolons and line breaks, trimmed, blanks out."""
    return F.filter(F.transform(F.split(text, r"[;\n]+"), strip), lambda d: d != "")


def age_ratings(v: Column) -> Column:
    """One entry per authority whose value is an object, in order of authority."""
    members = ("rating", "required_age", "descriptors", "banned", "use_age_gate")
    opened = F.transform(
        variant.entries(v),
        lambda e: F.struct(
            e["key"].alias("authority"), variant.read(e["value"], variant.leaves(members)).alias("r")
        ),
    )
    return F.array_sort(
        F.transform(
            F.filter(opened, lambda e: e["r"].isNotNull()),
            lambda e: F.struct(
                e["authority"].alias("authority"),
                variant.text(e["r"]["rating"]).alias("rating"),
                variant.integer(e["r"]["required_age"]).alias("required_age"),
                F.coalesce(
                    descriptors(variant.text(e["r"]["descriptors"])), F.array().cast("array<string>")
                ).alias("descriptors"),
                variant.boolean(e["r"]["banned"]).alias("banned"),
                variant.boolean(e["r"]["use_age_gate"]).alias("use_age_gate"),
            ),
        )
    )


def score_stub(v: Column) -> Column:
    """Score record named in the details themselves, null when it holds neither url nor score."""

    def read(m: Column) -> Column:
        url = blank_to_null(variant.string(m["url"]))
        score = variant.integer(m["score"])
        return F.when(
            url.isNotNull() | score.isNotNull(),
            F.struct(
                url.alias("url"),
                score.alias("critic_score"),
                F.lit(None).cast("double").alias("user_score"),
                F.lit(None).cast("string").alias("user_score_raw"),
                F.lit("pc").alias("platform"),
            ),
        )

    return variant.let(variant.read(v, variant.leaves(("url", "score"))), read)


def with_facts(rows: DataFrame) -> DataFrame:
    """Rows with ``data`` replaced by all locale-independent facts of the body.

    Fragments that need plain text are read in a first projection, so each is extracted once.
    """
    data = F.col("data")
    fragments = {f"_{os}": requirement_fragments(data[member]) for os, member in REQUIREMENT_MEMBERS.items()}
    fragments["_languages"] = language_fragments(data["supported_languages"])
    fragments["_release"] = release(data["release_date"])
    keep = [c for c in rows.columns if c != "data"]
    return rows.withColumns(fragments).select(
        *keep,
        variant.string(data["type"]).alias("type"),
        variant.boolean(data["is_free"]).alias("is_free"),
        price(data["price_overview"]).alias("price"),
        names(data["developers"]).alias("developers"),
        names(data["publishers"]).alias("publishers"),
        "_release.release_date",
        "_release.release_date_raw",
        "_release.coming_soon",
        screenshots(data["screenshots"]).alias("screenshots"),
        videos(data["movies"]).alias("videos"),
        http_url(variant.string(data["header_image"])).alias("header_image"),
        http_url(variant.string(data["website"])).alias("website"),
        F.struct(*(requirement_texts(F.col(f"_{os}")).alias(os) for os in REQUIREMENT_MEMBERS)).alias("requirements"),
        languages(F.col("_languages")).alias("supported_languages"),
        platforms(data["platforms"]).alias("platforms"),
        categories(data["categories"]).alias("categories"),
        genres(data["genres"]).alias("genres"),
        age_ratings(data["ratings"]).alias("age_ratings"),
        score_stub(data["metacritic"]).alias("score_stub"),
    )


def with_texts(details: DataFrame) -> DataFrame:
    """Admitted details rows with their ``localized`` texts.

    The full text falls back when the first choice is null or empty.
    """
    data = F.col("data")
    read = details.withColumns(
        {
            "_name": variant.string(data["name"]),
            "_short": variant.string(data["short_description"]),
            "_full": F.coalesce(
                blank_to_null(variant.string(data["detailed_description"])), variant.string(data["about_the_game"])
            ),
        }
    )
    texts = F.struct(
        "locale",
        "steam_language",
        "store_country",
        F.col("_name").alias("name"),
        text_value("_short").alias("short_description"),
        text_value("_full").alias("full_description"),
    )
    return read.withColumn("localized", texts).drop("_name", "_short", "_full")


def base_pick(details: DataFrame, *key: str) -> DataFrame:
    """Per key (app_id): ``base`` (locale and body of the first requested locale that was admitted) and
    ``localizations`` (locale -> texts).

    Needs app_id, locale, locale_ord, fetched_at, localized, data. Facts are read after it, so only from the
    body that was picked. A locale landed more than once keeps its newest response. A group holds
    one row per requested locale; copies of a response are reduced before the shuffle.
    """
    key = key or ("app_id",)
    newest = details.groupBy(*key, "locale").agg(
        F.max_by(
            F.struct("locale_ord", "localized", "data"),
            F.struct(F.coalesce("fetched_at", F.timestamp_seconds(F.lit(0))), "row_key" if "row_key" in details.columns else F.lit(0)),
        ).alias("d")
    )
    return newest.groupBy(*key).agg(
        F.min_by(F.struct("locale", "d.data"), F.col("d.locale_ord")).alias("base"),
        F.map_from_entries(F.collect_list(F.struct("locale", "d.localized"))).alias("localizations"),
    )


def item_rows(rows: DataFrame, array: Column, *keep: str) -> DataFrame:
    """Child table of a list: kept columns, 0-based position, item."""
    built = variant.computed_once(rows, _items=array)
    return built.select(*keep, F.posexplode("_items").alias("pos", "item"))


def price_summary(priced: DataFrame, *keys: str) -> DataFrame:
    """Price totals and discount range per key (country, currency…)."""
    return priced.groupBy(*keys).agg(
        F.count("price").alias("priced"),
        F.min("price.discount_percent").alias("min_discount"),
        F.max("price.discount_percent").alias("max_discount"),
        F.round(F.avg("price.discount_percent"), 4).alias("avg_discount"),
        F.sum("price.initial").alias("sum_initial"),
        F.sum("price.final").alias("sum_final"),
    )


def company_rows(rows: DataFrame, *keep: str) -> DataFrame:
    """Developers and publishers as rows of company and role."""

    def of(member: str, role: str) -> Column:
        return F.transform(
            names(F.col(f"data.{member}")), lambda n: F.struct(n.alias("company"), F.lit(role).alias("role"))
        )

    both = F.concat(of("developers", "developer"), of("publishers", "publisher"))
    return item_rows(rows, both, *keep).select(*keep, "item.company", "item.role")


def required_age(ratings: DataFrame, *keys: str) -> DataFrame:
    """Highest required age over all authorities."""
    return ratings.groupBy(*keys).agg(F.max("item.required_age").alias("required_age"))


def requirement_rows(rows: DataFrame, *keep: str) -> DataFrame:
    """Requirements unpivoted: one row per system that has any, with plain texts."""
    by_os = [
        F.struct(
            F.lit(os).alias("os"),
            F.col(f"requirements.{os}.minimum.text").alias("minimum"),
            F.col(f"requirements.{os}.recommended.text").alias("recommended"),
        )
        for os in REQUIREMENT_MEMBERS
    ]
    return rows.select(*keep, F.inline(F.array(*by_os))).where(
        F.col("minimum").isNotNull() | F.col("recommended").isNotNull()
    )
