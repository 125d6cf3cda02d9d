"""Facts from HTML pages: tags, language matrix, achievements, score blocks.

A page is tokenized once by an Arrow function that marks elements; everything else is Column expressions
over the marks of that row, so no fact needs a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludoshelf.functions import variant
from ludoshelf.functions.clean import blank_to_null, bounded_number, first_number, http_url
from ludoshelf.functions.markup import Rule, mark_elements
from ludoshelf.operators.details import language_struct

# The elements that hold facts on each kind of page.
STORE_PAGE = (
    Rule("tag_list", css_class="popular_tags"),
    Rule("tag", css_class="app_tag", within="tag_list"),
    Rule("table", tag="table", css_class="game_language_options"),
    Rule("row", tag="tr", within="table"),
    Rule("cell", tag="td", within="row"),
    Rule("tick", tag="span", within="cell"),
)
ACHIEVEMENTS = (
    Rule("block", css_class="achieveRow", keep="class"),
    Rule("text", css_class="achieveTxt", within="block"),
    Rule("name", tag="h3", within="text"),
    Rule("description", tag="h5", within="text"),
    Rule("percent", css_class="achievePercent", within="block"),
    Rule("image", css_class="achieveImgHolder", within="block"),
    Rule("icon", tag="img", within="image", keep="src"),
)
SCORE_PAGE = (
    Rule("value", tag="span", where=("data-testid", "global-score-value")),
    Rule("header", tag="div", where=("data-testid", "global-score-header")),
    Rule("ld_json", tag="script", where=("type", "application/ld+json"), raw=True),
)


def _of(marks: Column, *kinds: str) -> Column:
    return F.filter(marks, lambda m: m["mark"].isin(*kinds))


def _inside(marks: Column, outer: Column) -> Column:
    return F.filter(marks, lambda m: (m["first"] > outer["first"]) & (m["last"] <= outer["last"]))


def _within(marks: Column, outer: Column) -> Column:
    """The marks inside one, as a slice of all marks: they stand together in document order."""
    return F.slice(marks, outer["inner"] + 1, outer["upto"] - outer["inner"])


def _first(marks: Column, kind: str) -> Column:
    return F.get(_of(marks, kind), F.lit(0))


def tags(marks: Column) -> Column:
    """Tags in page order. The rank counts blank ones too, so their gap stays."""
    ranked = F.transform(
        _of(marks, "tag"),
        lambda m, i: F.struct(
            m["text"].alias("name"),
            F.lit("audience").alias("source"),
            (i + 1).alias("rank"),
            F.lit(None).cast("bigint").alias("votes"),
        ),
    )
    return F.filter(ranked, lambda t: t["name"] != "")


def language_matrix(marks: Column) -> Column:
    """Rows of the first language table after its header row: interface, full audio, subtitles.

    A row needs four cells and a name; a tick is any span in the cell. Without a table the array is empty.
    """
    table = _first(marks, "table")
    rows = F.filter(_inside(_of(marks, "row"), table), lambda row, i: i > 0)
    in_table = _inside(_of(marks, "cell", "tick"), table)
    opened = F.transform(
        rows,
        lambda row: F.struct(
            _inside(_of(in_table, "cell"), row).alias("cells"), _inside(_of(in_table, "tick"), row).alias("ticks")
        ),
    )
    full = F.filter(opened, lambda r: (F.size(r["cells"]) >= 4) & (r["cells"][0]["text"] != ""))

    def ticked(r: Column, n: int) -> Column:
        return F.size(_inside(r["ticks"], r["cells"][n])) > 0

    lines = F.transform(
        full, lambda r: language_struct(r["cells"][0]["text"], ticked(r, 1), ticked(r, 3), ticked(r, 2))
    )
    return F.when(table.isNotNull(), lines).otherwise(F.slice(lines, 1, 0))


def achievements(marks: Column) -> Column:
    """Achievement blocks that have a name, in page order."""
    opened = F.transform(
        _of(marks, "block"),
        lambda b: F.struct(b["attr"].alias("css"), _within(marks, b).alias("inner")),
    )
    lines = F.transform(
        opened,
        lambda b: F.struct(
            F.lit(None).cast("string").alias("api_name"),
            _first(b["inner"], "name")["text"].alias("name"),
            blank_to_null(_first(b["inner"], "description")["text"]).alias("description"),
            first_number(_first(b["inner"], "percent")["text"]).alias("global_percent"),
            F.lower(b["css"]).contains("hidden").alias("hidden"),
            http_url(_first(b["inner"], "icon")["attr"]).alias("icon_url"),
        ),
    )
    return F.filter(lines, lambda a: a["name"] != "")


def last_value(headers: Column, values: Column, name: str) -> Column:
    """Value paired by position with the last header of this name; pairs end with the shorter list."""
    n = F.least(F.size(headers), F.size(values))
    paired = F.transform(
        F.filter(
            F.transform(headers, lambda h, i: F.struct(F.lower(h).alias("h"), i.alias("i"))),
            lambda p: (p["i"] < n) & (p["h"] == name),
        ),
        lambda p: F.get(values, p["i"]),
    )
    return F.try_element_at(paired, F.lit(-1))


def json_ld_score(scripts: Column) -> Column:
    """Rating of the first embedded JSON object that has a usable one; broken JSON is skipped."""
    ratings = F.transform(
        scripts,
        lambda s: bounded_number(
            variant.text(F.try_variant_get(F.try_parse_json(s), "$.aggregateRating.ratingValue", "variant")), 100
        ),
    )
    return F.get(F.filter(ratings, lambda r: r.isNotNull()), F.lit(0))


def scores(marks: Column) -> Column:
    """struct<critic_score, user_score, user_score_raw> of a score page."""
    headers = F.transform(_of(marks, "header"), lambda m: m["text"])
    values = F.transform(_of(marks, "value"), lambda m: m["text"])
    scripts = F.transform(_of(marks, "ld_json"), lambda m: m["text"])
    user_raw = last_value(headers, values, "user score")
    critic = bounded_number(last_value(headers, values, "metascore"), 100)
    return F.struct(
        F.coalesce(critic, json_ld_score(scripts)).cast("bigint").alias("critic_score"),
        bounded_number(user_raw, 10).alias("user_score"),
        user_raw.alias("user_score_raw"),
    )


def store_facts(pages: DataFrame, *keep: str) -> DataFrame:
    """(tags, language_matrix) of store pages."""
    marked = pages.select(*keep, mark_elements(*STORE_PAGE)("body").alias("marks"))
    marks = F.col("marks")
    facts = variant.computed_once(marked, tags=tags(marks), language_matrix=language_matrix(marks))
    return facts.drop("marks")


def achievement_facts(pages: DataFrame, *keep: str) -> DataFrame:
    marked = pages.select(*keep, mark_elements(*ACHIEVEMENTS)("body").alias("marks"))
    return variant.computed_once(marked, achievements=achievements(F.col("marks"))).drop("marks")


def score_facts(pages: DataFrame, *keep: str) -> DataFrame:
    marked = pages.select(*keep, mark_elements(*SCORE_PAGE)("body").alias("marks"))
    return marked.select(*keep, F.inline(F.array(scores(F.col("marks")))))


def override_languages(matrix: Column, listed: Column) -> Column:
    """A non-empty matrix of the page replaces the language list of the details."""
    return F.when(F.size(matrix) > 0, matrix).otherwise(listed)


def tag_counts(tagged: DataFrame) -> DataFrame:
    """How many products carry a tag, over the whole corpus, and its best rank."""
    return (
        tagged.select(F.inline("tags"))
        .groupBy("name")
        .agg(F.count("*").alias("products"), F.min("rank").alias("best_rank"))
    )


def achievement_summary(rows: DataFrame, *keys: str) -> DataFrame:
    """Count and mean share of achievements per key, without exploding them."""
    n = F.size("achievements")
    return rows.select(
        *keys,
        n.alias("achievements"),
        F.aggregate(
            "achievements", F.lit(0).cast("bigint"), lambda acc, a: acc + a["hidden"].cast("bigint")
        ).alias("hidden"),
        F.round(
            F.try_divide(
                F.aggregate(
                    "achievements", F.lit(0.0), lambda acc, a: acc + F.coalesce(a["global_percent"], F.lit(0.0))
                ),
                F.size(F.filter("achievements", lambda a: a["global_percent"].isNotNull())).cast("double"),
            ),
            4,
        ).alias("avg_percent"),
    )
