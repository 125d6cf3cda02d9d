"""Landing tables derived from the star-schema test tables, so that reports run the real operators.

Every derivation covers its whole input table and grows with it. Bodies are JSON or HTML text as a source would land
it, with the odd values (numbers as text, blanks, wrong types) the cleaning rules exist for.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ludoshelf import schemas
from ludoshelf.functions.dims import locale_info

LANDING_TYPES = dict(part.split(" ") for part in schemas.LANDING.split(", "))
# Documents per page range of the derived review pages.
PAGE_RANGE = 200


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def wide(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows become bodies to parse, dealt by its first column: the test tables are single files."""
    rows = table(spark, sf_dir, name)
    return rows.repartition(F.col(rows.columns[0]))


def landed(rows: DataFrame, kind: str | Column, **values: Column) -> DataFrame:
    """Rows in the landing schema; columns not given are null."""
    values = {"request_kind": F.lit(kind) if isinstance(kind, str) else kind, **values}
    return rows.select(
        *(values.get(name, F.lit(None)).cast(data_type).alias(name) for name, data_type in LANDING_TYPES.items())
    )


def with_member(json: Column, name: str, raw: Column | str) -> Column:
    """JSON object text with one more member whose value is given as JSON text."""
    raw = F.lit(raw) if isinstance(raw, str) else raw
    return F.concat(F.regexp_replace(json, r"\}\z", f',"{name}":'), raw, F.lit("}"))


def details_body(app_id: Column, data: Column, success: Column | str = "true") -> Column:
    success = F.lit(success) if isinstance(success, str) else success
    return F.concat(
        F.lit('{"'), app_id.cast("string"), F.lit('":{"success":'), success, F.lit(',"data":'), data, F.lit("}}")
    )


def part_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` as details responses, one per locale (de-DE, en-US); sizes of 50 are not found."""
    k, n, b, t, s = (F.col(f"p_{c}") for c in ("partkey", "name", "brand", "type", "size"))
    data = F.to_json(
        F.struct(
            n.alias("name"),
            t.alias("type"),
            F.concat(F.lit("<b>"), n, F.lit("</b> &amp; "), b).alias("short_description"),
            F.when(s % 3 == 0, "").otherwise(F.concat(F.lit("Made by <i>"), b, F.lit("</i>"))).alias(
                "detailed_description"
            ),
            F.concat(F.lit("About "), n).alias("about_the_game"),
            F.concat(F.when(k % 2 == 0, "https:").otherwise(""), F.lit("//img.example/"), k).alias("header_image"),
            F.when(k % 3 == 0, F.concat(F.lit("http://site.example/"), k)).alias("website"),
            F.array(b).alias("developers"),
            F.array(b, t).alias("publishers"),
            F.transform(F.split(n, " "), lambda w: F.struct(w.alias("description"))).alias("genres"),
            F.array(
                F.struct(s.alias("id"), t.alias("description")), F.struct(F.lit(0).alias("id"), F.lit("").alias("description"))
            ).alias("categories"),
            F.struct(
                F.when(k % 4 != 3, F.concat(F.lit("https://scores.example/"), k)).alias("url"),
                F.when(k % 4 < 2, s).alias("score"),
            ).alias("metacritic"),
            F.lit("English<strong>*</strong>, Klingon<br>*languages with full audio support").alias(
                "supported_languages"
            ),
        )
    )
    free = (
        F.when(k % 4 == 0, "true").when(k % 4 == 1, '" No "').when(k % 4 == 2, "1").otherwise('"maybe"')
    )
    data = with_member(data, "is_free", free)
    success = F.when(s == 50, "false").when(k % 2 == 0, "true").otherwise("1")
    rows = wide(spark, sf_dir, "part").withColumn("locale", F.explode(F.array(F.lit("de-DE"), F.lit("en-US"))))
    return landed(
        rows,
        "app_details",
        app_id=k,
        locale=F.col("locale"),
        steam_language=F.when(F.col("locale") == "de-DE", "german").otherwise("english"),
        store_country=F.lit("kz"),
        http_status=F.when((F.col("locale") == "de-DE") & (s % 7 == 0), 500).otherwise(200),
        body=details_body(k, data, success),
    )


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``; the labels are null where there are none."""
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")


def source_id() -> Column:
    return F.substring("source", 4, 20).cast("bigint")


def review_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as review pages: source = app, quality = polarity; without a label ``voted_up`` is missing.

    A page covers an id range, so its size is bounded however many documents one source holds. The cursor goes
    on until a chain's last page.
    """
    d = F.col("doc_id")
    review = F.struct(
        d,
        d.cast("string").alias("recommendationid"),
        F.col("text").alias("review"),
        (F.col("quality") == 1).alias("voted_up"),
        F.col("lang").alias("language"),
        F.when(d % 7 == 0, 0).otherwise(1_600_000_000 + d * 60).alias("timestamp_created"),
        (F.col("n_chars") % 10).alias("votes_up"),
        F.when(d % 5 == 0, "").otherwise(F.concat(F.lit("0."), F.lpad((d % 100).cast("string"), 2, "0"))).alias(
            "weighted_vote_score"
        ),
        F.when(
            d % 3 != 0,
            F.struct((d % 97).cast("string").alias("steamid"), F.col("n_chars").alias("num_reviews")),
        ).alias("author"),
    )
    pages = (
        labelled_documents(spark, sf_dir)
        .groupBy(
            source_id().alias("app_id"),
            F.when(F.col("quality") == 1, "positive").otherwise("negative").alias("review_type"),
            F.expr(f"cast(doc_id div {PAGE_RANGE} as int)").alias("page_no"),
        )
        .agg(F.array_sort(F.collect_list(review)).alias("reviews"))
    )
    cursor = F.when(F.col("page_no") == 0, "*").otherwise(F.concat(F.lit("c"), F.col("page_no")))
    repeats = (F.col("app_id") % 5 == 0) & (F.col("page_no") == 3)
    lasts = pages.groupBy("app_id", "review_type").agg(F.max("page_no").alias("last"))
    pages = pages.join(lasts, ["app_id", "review_type"])
    following = F.when(repeats, cursor).when(F.col("page_no") < F.col("last"), F.concat(F.lit("c"), F.col("page_no") + 1))
    body = F.to_json(F.struct(F.lit(1).alias("success"), following.alias("cursor"), "reviews"))
    return landed(
        pages,
        "reviews",
        app_id=F.col("app_id"),
        steam_language=F.lit("all"),
        review_type=F.col("review_type"),
        page_no=F.col("page_no"),
        cursor=cursor,
        body=body,
    )


def review_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled ``documents`` counted per source and per (source, lang), landed as summary responses."""
    votes = labelled_documents(spark, sf_dir).select(source_id().alias("app_id"), "lang", "quality")
    counted = votes.groupingSets([[F.col("app_id")], [F.col("app_id"), F.col("lang")]], "app_id", "lang").agg(
        F.count_if(F.col("quality") == 1).alias("up"), F.count_if(F.coalesce(F.col("quality") != 1, F.lit(True))).alias("down")
    )
    summary = F.to_json(
        F.struct(
            F.lit(9).alias("review_score"),
            F.lit("Fine").alias("review_score_desc"),
            F.col("up").cast("string").alias("total_positive"),
            F.when(F.col("down") > 0, F.col("down")).alias("total_negative"),
        )
    )
    # The total is stated, missing, or an explicit null.
    summary = (
        F.when(F.col("app_id") % 3 == 0, with_member(summary, "total_reviews", F.lit("null")))
        .when(F.col("app_id") % 3 == 1, with_member(summary, "total_reviews", (F.col("up") + F.col("down") + 5).cast("string")))
        .otherwise(summary)
    )
    return landed(
        counted,
        "reviews",
        app_id=F.col("app_id"),
        locale=F.col("lang"),
        steam_language=F.coalesce(locale_info("lang")["steam_language"], F.lit("all")),
        review_type=F.lit("all"),
        page_no=F.lit(0),
        cursor=F.lit("*"),
        body=F.concat(F.lit('{"success":1,"cursor":"n","reviews":[],"query_summary":'), summary, F.lit("}")),
    )


# How the anchors of a raw page become the elements of a product page.
ANCHOR = r'<li><a href="([^"]*)">([^<]*)</a></li>'


def store_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` as product pages: the navigation becomes the tag list, its links tags, plus a language table."""
    html = F.regexp_replace("html", "<nav><ul>", '<nav class="glance popular_tags"><ul>')
    html = F.regexp_replace(html, ANCHOR, '<li><a class="app_tag" href="$1">$2</a></li>')
    p = F.col("page_id")

    def cell(tick: Column) -> Column:
        return F.concat(F.lit("<td>"), F.when(tick, "<span>&#10003;</span>").otherwise(""), F.lit("</td>"))

    language_table = F.concat(
        F.lit('<table class="wide game_language_options"><tr><th></th><th>Interface</th><th>Full Audio</th>'),
        F.lit("<th>Subtitles</th></tr><tr><td> English </td>"),
        cell(p % 2 == 0), cell(p % 3 == 0), cell(p % 5 == 0),
        F.lit("</tr><tr><td>Page "), p, F.lit("<td><td><span>x</span><td></table>"),
    )
    return landed(
        wide(spark, sf_dir, "pages"),
        "store_page",
        app_id=p,
        locale=F.lit("de-DE"),
        store_country=F.lit("kz"),
        body=F.regexp_replace(html, "</nav>", F.concat(F.lit("</nav>"), F.when(p % 4 != 0, language_table).otherwise(""))),
    )


def achievement_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` as achievement pages: every navigation link becomes a block, its number from the page id."""
    p = F.col("page_id")
    block = F.concat(
        F.lit('<div class="achieveRow'),
        F.when(p % 3 == 0, " hiddenRow").otherwise(""),
        F.lit('"><div class="achieveImgHolder"><img src="'),
        F.when(p % 2 == 0, "https://img.example").otherwise(""),
        F.lit('$1"></div><div class="achievePercent"> '),
        (p % 100).cast("string"),
        F.lit('.5% of players</div><div class="achieveTxt"><h3>$2</h3><h5>'),
        F.when(p % 5 == 0, "").otherwise("Get <i>$2</i>"),
        F.lit("</h5></div></div>"),
    )
    return landed(
        wide(spark, sf_dir, "pages"),
        "achievements",
        app_id=p,
        locale=F.lit("de-DE"),
        body=F.regexp_replace("html", F.lit(ANCHOR), block),
    )


def score_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` as score pages: header/value pairs, or embedded JSON, or nothing usable."""
    k, s = F.col("p_partkey"), F.col("p_size")

    def pair(value: Column, header: str) -> Column:
        return F.concat(
            F.lit('<p><span data-testid="global-score-value">'), value,
            F.lit(f'</span><div data-testid="global-score-header"> {header}</div>'),
        )

    def script(content: Column) -> Column:
        return F.concat(F.lit('<script type="application/ld+json">'), content, F.lit("</script>"))

    rated = F.concat(F.lit('{"aggregateRating":{"ratingValue":"'), s, F.lit('"}}'))
    body = F.concat(
        F.lit("<html><body>"),
        F.when(k % 5 == 0, pair(s.cast("string"), "Metascore")).otherwise(""),
        F.when(k % 5 == 0, pair(F.concat(s / 10, F.lit(" of 10")), "User  Score")).otherwise(""),
        F.when(k % 5 == 1, pair(F.lit("tbd"), "User score")).otherwise(""),
        F.when(k % 5 == 1, script(F.lit("{broken"))).otherwise(""),
        F.when(k % 5 == 2, F.concat(script(F.lit("[1]")), script(rated), script(F.lit('{"aggregateRating":{"ratingValue":1}}')))).otherwise(""),
        F.when(k % 5 == 3, pair(F.concat(s + 60), "METASCORE")).otherwise(""),
        F.lit("</body></html>"),
    )
    return landed(
        wide(spark, sf_dir, "part"),
        "score_page",
        app_id=k,
        url=F.concat(F.lit("https://scores.example/"), k),
        http_status=F.when(k % 10 == 9, 404).otherwise(200),
        body=body,
    )


def order_searches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``lineitem`` as title searches: an order's line 1 names the title, its other lines are the results.

    Results are bounded by the lines of one order; nothing is compared across orders.
    """
    names = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    named = lines.join(names, "l_partkey")
    titles = (
        named.where(F.col("l_linenumber") == 1)
        .groupBy(F.col("l_orderkey").alias("app_id"))
        .agg(F.min_by("p_name", F.struct("l_partkey", "l_suppkey")).alias("p_name"))
        .select("app_id", F.initcap("p_name").alias("title"))
    )
    results = named.where(F.col("l_linenumber") > 1).select(
        F.col("l_orderkey").alias("app_id"),
        F.lit(0).alias("variant_ord"),
        F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("result_ord"),
        F.col("l_partkey").alias("game_id"),
        F.col("p_name").alias("game_name"),
        F.concat(F.lit("https://hours.example/"), "l_partkey").alias("game_web_link"),
        F.when(F.col("l_suppkey") % 3 == 0, "n/a").otherwise((F.col("l_suppkey") / 2).cast("string")).alias("main_story"),
        F.lit(None).cast("string").alias("main_extra"),
        F.col("l_suppkey").cast("string").alias("completionist"),
        F.lit("1.5").alias("all_styles"),
        F.lit(None).cast("double").alias("similarity"),
        F.lit("{}").alias("json_content"),
    )
    return titles, results


def requests_from_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` as requests: the product id and language come from the page address."""
    p = F.col("page_id")
    lang = F.regexp_extract("url", r"^https?://[^/]+/([a-z]{2})/", 1)
    url = F.when(
        lang != "es", F.regexp_replace("url", r"^(https?)://[^/]+/[a-z]{2}/", r"$1://Store.SteamPowered.com/app/")
    ).otherwise(F.col("url"))
    return table(spark, sf_dir, "pages").select(
        url.alias("url"),
        F.array(lang, F.lit("en_US"), F.upper(lang), F.when(p % 9 == 0, "xx").otherwise("ru-RU")).alias("languages"),
        F.when(p % 4 == 0, None).when(p % 4 == 1, " KZ").when(p % 4 == 2, "us").otherwise(
            F.when(p % 8 == 3, "usa").otherwise("de")
        ).alias("store_country"),
        F.lit(4).alias("positive_review_count"),
        F.lit(4).alias("negative_review_count"),
        F.lit(1).alias("review_pages"),
    )


def catalogue_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as catalogue pages: return flag and supplier residue = chain, 100 order keys per page, items in mixed shapes.

    Page 4 of a chain is, by the residue: empty (1), without a next key (2), with a key that does not advance (3), the short last
    one (4), or no answer at all (5). The others end where a page brings nothing new.
    """
    key = F.col("l_partkey").cast("string")
    n = F.col("l_linenumber")
    item = (
        F.when(n % 3 == 0, F.concat(F.lit('{"appid":'), key, F.lit("}")))
        .when(n % 3 == 1, key)
        .otherwise(F.concat(F.lit('"'), key, F.lit('"')))
    )
    pages = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_returnflag", (F.col("l_suppkey") % 7).alias("residue"), F.expr("cast(l_orderkey div 100 as int)").alias("page_no"))
        .agg(F.collect_list(item).alias("items"))
    )

    def fourth(residue: int) -> Column:
        return (F.col("page_no") == 4) & (F.col("residue") == residue)

    page_no = F.col("page_no").cast("string")
    apps = F.when(fourth(1), "").otherwise(F.concat(F.array_join("items", ","), F.lit(',null,"x",{"name":1}')))
    next_key = F.when(fourth(2), "null").when(fourth(3), page_no).otherwise((F.col("page_no") + 1).cast("string"))
    answer = F.concat(
        F.lit('{"response":{"apps":['),
        apps,
        F.lit('],"have_more_results":'),
        F.when(fourth(4), "false").otherwise("true"),
        F.lit(',"last_appid":'),
        next_key,
        F.lit("}}"),
    )
    return landed(
        pages,
        "app_list",
        url=F.concat_ws("-", "l_returnflag", "residue"),
        page_no=F.col("page_no"),
        cursor=F.when(F.col("page_no") > 0, page_no),
        body=F.when(fourth(5), '{"answer":{}}').otherwise(answer),
    )


def part_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` as requests for its products in two locales, three review pages."""
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("https://store.steampowered.com/app/"), "p_partkey", F.lit("/")).alias("url"),
        F.array(F.lit("de-DE"), F.lit("en-US")).alias("languages"),
        F.lit("KZ").alias("store_country"),
        F.lit(4).alias("positive_review_count"),
        F.lit(2).alias("negative_review_count"),
        F.lit(3).alias("review_pages"),
    )


def landing_parts(spark: SparkSession, sf_dir: str) -> Iterator[DataFrame]:
    """The kinds of response one after another."""
    for kind in (part_details, review_pages, review_summaries, store_pages, achievement_pages, score_pages):
        yield kind(spark, sf_dir)


def all_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every kind of response in one landing table."""
    return reduce(DataFrame.unionByName, landing_parts(spark, sf_dir))
