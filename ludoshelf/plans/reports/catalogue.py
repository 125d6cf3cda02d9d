"""Reports over landing scans, the id catalogue, and requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ludoshelf.functions import variant
from ludoshelf.functions.clean import country_code
from ludoshelf.functions.dims import LANGUAGE_NAMES, LANGUAGES, REGIONAL_OVERRIDES, language_by_name, locale_info
from ludoshelf.operators import catalogue, keyed, requests
from ludoshelf.plans import workload
from ludoshelf.plans.workload import table
from ludoshelf.sources import landing
from ludoshelf.sources.staging import Staging


def _values(table_: dict[str, tuple[str, str]]) -> str:
    return ", ".join(f"('{k}', '{web}', '{store}')" for k, (web, store) in table_.items())


LANGUAGE_VALUES = f"(VALUES {_values(LANGUAGES)}) AS dim(tag, web, steam)"
OVERRIDE_VALUES = f"(VALUES {_values(REGIONAL_OVERRIDES)}) AS dim(tag, web, steam)"
NAME_VALUES = f"(VALUES {_values(LANGUAGE_NAMES)}) AS dim(name, web, steam)"


def landing_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("request_kind"), F.col("user_id").alias("app_id"), "event_id", "value", "ts"
    )
    owing = table(spark, sf_dir, "customer").where(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("app_id"))
    kept = landing.scan(rows.where(F.col("ts") >= F.lit("2024-01-05").cast("timestamp_ntz")), "purchase", owing)
    return kept.select("event_id", "app_id", "value")


LANDING_SCAN = """
SELECT event_id, user_id AS app_id, value FROM events
WHERE event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-05'
  AND user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
"""


def admission_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, props = F.col("event_type"), F.col("props")
    body = (
        F.when(kind == "signup", props)
        .when(kind == "error", F.concat(F.lit("["), props, F.lit("]")))
        .when(kind == "click", workload.with_member(props, "success", '"1"'))
        .otherwise(workload.with_member(props, "success", "1"))
    )
    rows = workload.wide(spark, sf_dir, "events").select(
        "event_type", F.when(F.col("value") < 5, 503).alias("http_status"), body.alias("body")
    )
    read = landing.with_payload(rows, ("k",), require_success=True)
    return (
        read.groupBy("event_type", F.coalesce("error", F.lit("admitted")).alias("outcome"))
        .agg(F.count("*").alias("n"), F.sum(variant.integer("payload.k")).alias("sum_k"))
    )


ADMISSION_SPLIT = """
SELECT event_type, outcome, COUNT(*) AS n,
       CAST(SUM(CASE WHEN event_type <> 'error' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END) AS BIGINT) AS sum_k
FROM (SELECT *, CASE WHEN value < 5 THEN 'http status 503'
                     WHEN event_type = 'error' THEN 'unexpected response'
                     WHEN event_type IN ('signup', 'click') THEN 'no success flag'
                     ELSE 'admitted' END AS outcome FROM events)
GROUP BY event_type, outcome
"""


def id_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id").cast("string")
    line = F.when(F.col("event_type") == "error", F.concat(user, F.lit("x"))).otherwise(
        F.concat(F.lit("\t"), user, F.lit(" "))
    )
    return landing.seed_ids(table(spark, sf_dir, "events").select(line.alias("value")), "value")


ID_SEED = "SELECT DISTINCT user_id AS app_id FROM events WHERE event_type <> 'error' AND user_id > 0"


def game_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("app_id"),
        F.when(F.col("c_nationkey") % 2 == 0, F.col("c_name")).alias("name"),
        F.array("c_mktsegment", F.lit('say "hi"')).alias("developers"),
        (F.col("c_acctbal") > 0).alias("is_free"),
    )
    return landing.to_document(rows)


GAME_JSON = """
SELECT CAST(to_json(struct_pack(app_id := c_custkey, name := CASE WHEN c_nationkey % 2 = 0 THEN c_name END,
       developers := [c_mktsegment, 'say "hi"'], is_free := c_acctbal > 0)) AS VARCHAR) AS document
FROM customer
"""


def app_ids(spark: SparkSession, sf_dir: str, limit: int | None = None) -> DataFrame:
    """The whole catalogue, with the chain audit."""
    return catalogue.app_ids(workload.catalogue_pages(spark, sf_dir), limit=limit, stage=Staging(spark))


def id_catalogue(spark: SparkSession, sf_dir: str, limit: int = 1000) -> DataFrame:
    """The smallest ids up to a limit."""
    return app_ids(spark, sf_dir, limit)


def catalogue_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = Staging(spark)(catalogue.list_pages(workload.catalogue_pages(spark, sf_dir)), "catalogue_pages")
    return catalogue.audited_pages(pages).select(
        "chain", "page_no", F.size("apps").alias("items"), "next_key", F.coalesce("new_ids", F.lit(0)).alias("new_ids"), "stop_reason"
    )


CATALOGUE_ITEMS = """
SELECT l_returnflag || '-' || (l_suppkey % 7) AS chain, l_suppkey % 7 AS residue, l_orderkey // 100 AS page_no, l_partkey FROM lineitem
"""
CATALOGUE_CHAIN = f"""
WITH items AS ({CATALOGUE_ITEMS}),
pages AS (SELECT chain, residue, page_no, CASE WHEN page_no <> 4 THEN 0 ELSE residue END AS odd, COUNT(*) + 3 AS items FROM items GROUP BY 1, 2, 3),
firsts AS (SELECT chain, l_partkey, MIN(page_no) AS page_no FROM items WHERE l_partkey > 0 AND NOT (page_no = 4 AND residue IN (1, 5)) GROUP BY 1, 2),
new AS (SELECT chain, page_no, COUNT(*) AS new_ids FROM firsts GROUP BY 1, 2),
known AS (SELECT p.chain, p.page_no, p.odd, CASE odd WHEN 1 THEN 0 WHEN 5 THEN NULL ELSE p.items END AS items,
            CASE odd WHEN 2 THEN NULL WHEN 5 THEN NULL WHEN 3 THEN 4 ELSE p.page_no + 1 END AS next_key, COALESCE(n.new_ids, 0) AS new_ids,
            CASE odd WHEN 5 THEN 'error' WHEN 1 THEN 'empty page' WHEN 2 THEN 'no next key' WHEN 3 THEN 'key not advancing' WHEN 4 THEN 'short page'
              ELSE CASE WHEN n.new_ids IS NULL THEN 'no new ids' END END AS stop_reason
          FROM pages p LEFT JOIN new n ON p.chain = n.chain AND p.page_no = n.page_no),
stops AS (SELECT chain, MIN(page_no) AS stop_at FROM known WHERE stop_reason IS NOT NULL GROUP BY 1)
SELECT k.chain, CAST(k.page_no AS INTEGER) AS page_no, CAST(k.items AS INTEGER) AS items,
       CAST(k.next_key AS BIGINT) AS next_key, k.new_ids, k.stop_reason
FROM known k LEFT JOIN stops s ON k.chain = s.chain WHERE s.stop_at IS NULL OR k.page_no <= s.stop_at
"""


APP_IDS = f"""
SELECT DISTINCT l_partkey AS app_id FROM ({CATALOGUE_ITEMS}) i JOIN ({CATALOGUE_CHAIN}) c
  ON i.chain = c.chain AND i.page_no = c.page_no AND c.items > 0 WHERE l_partkey > 0
"""

ID_CATALOGUE = f"SELECT app_id FROM ({APP_IDS}) ORDER BY 1 LIMIT 1000"


def id_keyset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.keyset_page(table(spark, sf_dir, "lineitem"), "l_partkey", 500, 100)


ID_KEYSET = "SELECT DISTINCT l_partkey AS app_id FROM lineitem WHERE l_partkey > 500 ORDER BY 1 LIMIT 100"


def id_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("app_id"))
    lines = table(spark, sf_dir, "lineitem").where((F.col("l_returnflag") == "R") & (F.col("l_partkey") % 3 != 0))
    return catalogue.unknown_ids(ids, lines.select(F.col("l_partkey").alias("app_id")))


ID_INCREMENT = """
SELECT p_partkey AS app_id FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_partkey % 3 <> 0)
"""


def catalogue_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = catalogue.of_kinds(table(spark, sf_dir, "events"), "event_type", ["view", "purchase"])
    return kept.groupBy("event_type").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("apps"))


CATALOGUE_KIND = """
SELECT event_type, COUNT(*) AS n, COUNT(DISTINCT user_id) AS apps FROM events
WHERE event_type IN ('view', 'purchase') GROUP BY event_type
"""


def chain_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    kept = keyed.until_first_stop(
        events, ["user_id"], F.struct("ts", "event_id"), F.col("event_type") == "error"
    )
    return kept.select("user_id", "event_id", "event_type")


CHAIN_PREFIX = """
SELECT user_id, event_id, event_type FROM (
  SELECT *, COALESCE(SUM(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (
    PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stops
  FROM events) WHERE stops = 0
"""


def url_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = workload.requests_from_pages(spark, sf_dir)
    return (
        asked.select(requests.app_id_of("url").alias("app_id"))
        .groupBy("app_id")
        .agg(F.count("*").alias("urls"))
    )


# The product id of a page address: any language but es, then digits up to a path, query or fragment end.
URL_PARTS = """
SELECT *, regexp_extract(url, '^https?://[^/]+/([a-z]{2})/', 1) AS lang,
       TRY_CAST(NULLIF(regexp_extract(url, '^https?://[^/]+/(?:en|fr|de)/([0-9]+)(?:[/?#]|$)', 1), '') AS BIGINT) AS app_id
FROM pages
"""
URL_IDS = f"SELECT app_id, COUNT(*) AS urls FROM ({URL_PARTS}) GROUP BY app_id"


def locale_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, lang = F.col("doc_id"), F.col("lang")
    tag = (
        F.when(d % 4 == 0, lang)
        .when(d % 4 == 1, F.concat(F.upper(lang), F.lit("_XX")))
        .when(d % 4 == 2, F.concat(F.lit(" "), lang, F.lit("-419\t")))
        .otherwise(F.concat(F.lit("xx-"), lang))
    )
    info = locale_info(tag)
    return (
        table(spark, sf_dir, "documents")
        .select(info["locale"].alias("locale"), info["web_language"].alias("web"), info["steam_language"].alias("steam"))
        .groupBy("locale", "web", "steam")
        .agg(F.count("*").alias("n"))
    )


LOCALE_DIM = f"""
WITH tags AS (
  SELECT CASE doc_id % 4 WHEN 0 THEN lang WHEN 1 THEN upper(lang) || '-XX' WHEN 2 THEN lang || '-419'
         ELSE 'xx-' || lang END AS tag FROM documents),
known AS (
  SELECT t.tag, COALESCE(o.web, b.web) AS web, COALESCE(o.steam, b.steam) AS steam FROM tags t
  LEFT JOIN (SELECT * FROM {OVERRIDE_VALUES}) o ON lower(t.tag) = o.tag
  LEFT JOIN (SELECT * FROM {LANGUAGE_VALUES}) b ON string_split(lower(t.tag), '-')[1] = b.tag)
SELECT CASE WHEN steam IS NOT NULL THEN tag END AS locale, web, steam, COUNT(*) AS n FROM known GROUP BY 1, 2, 3
"""


def language_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    lang = F.col("lang")
    name = (
        F.when(lang == "en", " English")
        .when(lang == "fr", "FRENCH\n")
        .when(lang == "es", "Spanish -  Latin\u00a0America")
        .otherwise("Klingon")
    )
    hit = language_by_name(name)
    return (
        table(spark, sf_dir, "documents")
        .select("lang", hit["web_language"].alias("web"), hit["steam_language"].alias("steam"))
        .groupBy("lang", "web", "steam")
        .agg(F.count("*").alias("n"))
    )


LANGUAGE_NAMES_SQL = f"""
SELECT d.lang, n.web, n.steam, COUNT(*) AS n
FROM (SELECT CASE lang WHEN 'en' THEN 'english' WHEN 'fr' THEN 'french' WHEN 'es' THEN 'spanish - latin america'
      ELSE 'klingon' END AS name, lang FROM documents) d
LEFT JOIN (SELECT * FROM {NAME_VALUES}) n ON d.name = n.name GROUP BY 1, 2, 3
"""


def first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return keyed.first_wins(documents, ["text"], [F.col("doc_id")]).select("doc_id", "lang")


FIRST_WINS = "SELECT MIN(doc_id) AS doc_id, arg_min(lang, doc_id) AS lang FROM documents GROUP BY text"


def locale_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = F.array(*(F.lit(t) for t in ("en-US", "de", "EN_us", "pt-BR", "DE", "xx", "ru-RU")))
    # Equal tags of one order are reduced to their first place, so a list holds seven tags at most.
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey", F.get(tags, F.col("l_suppkey") % 7).alias("tag"))
        .agg(F.min(F.struct("l_linenumber", "l_partkey", "l_suppkey")).alias("place"))
    )
    lists = lines.groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct("place", "tag")))["tag"].alias("languages")
    )
    lists = variant.computed_once(lists, locales=requests.normalized_locales("languages"))
    good = F.filter("locales", lambda x: x.isNotNull())
    return lists.select(
        F.col("l_orderkey").alias("app_id"),
        F.array_join(F.transform(good, lambda x: F.concat(x["locale"], F.lit(":"), x["steam_language"])), ",").alias("locales"),
        F.exists("locales", lambda x: x.isNull()).alias("rejected"),
    )


LOCALE_LISTS = """
WITH lines AS (
  SELECT l_orderkey AS app_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS pos,
         (['en-US', 'de', 'EN-us', 'pt-BR', 'DE', 'xx', 'ru-RU'])[l_suppkey % 7 + 1] AS tag FROM lineitem),
firsts AS (SELECT app_id, MIN(pos) AS pos, arg_min(tag, pos) AS tag FROM lines GROUP BY app_id, lower(tag))
SELECT app_id, bool_or(tag = 'xx') AS rejected,
  COALESCE(string_agg(CASE WHEN tag <> 'xx' THEN tag || ':' || CASE lower(tag) WHEN 'en-us' THEN 'english' WHEN 'de' THEN 'german'
    WHEN 'pt-br' THEN 'brazilian' ELSE 'russian' END END, ',' ORDER BY pos), '') AS locales
FROM firsts GROUP BY app_id
"""


def country_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("c_custkey"), F.col("n_name")
    asked = (
        F.when(k % 4 == 0, F.substring(n, 1, 2))
        .when(k % 4 == 1, F.concat(F.lit(" "), F.substring("c_mktsegment", 1, 2), F.lit("\n")))
        .when(k % 4 == 2, F.substring(n, 7, 3))
    )
    customers = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return (
        customers.select(asked.alias("asked"), country_code(asked).alias("country"))
        .groupBy("country", (F.col("asked").isNotNull() & F.col("country").isNull()).alias("rejected"))
        .agg(F.count("*").alias("n"))
    )


COUNTRY_CHECK = """
SELECT CASE WHEN c_custkey % 4 = 0 THEN lower(substr(n_name, 1, 2)) WHEN c_custkey % 4 = 1 THEN lower(substr(c_mktsegment, 1, 2)) END AS country,
       c_custkey % 4 = 2 AS rejected, COUNT(*) AS n
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2
"""


def request_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted, _ = requests.normalize(workload.requests_from_pages(spark, sf_dir))
    return (
        requests.expand(accepted)
        .groupBy("request_kind", "review_type", "steam_language", "store_country")
        .agg(F.count("*").alias("n"), F.countDistinct("app_id").alias("apps"))
    )


ACCEPTED_PAGES = f"""
SELECT DISTINCT regexp_replace(url, '^(https?)://[^/]+/[a-z]{{2}}/', '\\1://Store.SteamPowered.com/app/') AS url, app_id, lang,
  CASE page_id % 4 WHEN 1 THEN 'kz' WHEN 2 THEN 'us' WHEN 3 THEN 'de' END AS country
FROM ({URL_PARTS}) WHERE app_id IS NOT NULL AND page_id % 9 <> 0 AND page_id % 8 <> 3
"""


def request_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every request once with its outcome; the pages are asked twice over, so that half of the good ones are repeats."""
    asked = workload.requests_from_pages(spark, sf_dir)
    accepted, rejected = requests.normalize(asked.unionAll(asked))
    outcomes = accepted.select("url", F.lit("accepted").alias("outcome")).unionByName(rejected.withColumnRenamed("reason", "outcome"))
    return outcomes.groupBy("outcome").agg(F.count("*").alias("n"), F.countDistinct("url").alias("urls"))


REQUEST_SPLIT = f"""
WITH judged AS (
  SELECT CASE WHEN lang <> 'es' THEN regexp_replace(url, '^(https?)://[^/]+/[a-z]{{2}}/', '\\1://Store.SteamPowered.com/app/') ELSE url END AS url,
    CASE WHEN app_id IS NULL THEN 'unsupported url' WHEN page_id % 9 = 0 THEN 'unsupported locale' WHEN page_id % 8 = 3 THEN 'unsupported country' END AS reason
  FROM ({URL_PARTS})),
bad AS (SELECT url, reason FROM judged WHERE reason IS NOT NULL),
good AS (SELECT url FROM ({ACCEPTED_PAGES})),
again AS (SELECT COUNT(*) AS n FROM judged WHERE reason IS NULL)
SELECT reason AS outcome, 2 * COUNT(*) AS n, COUNT(DISTINCT url) AS urls FROM bad GROUP BY 1
UNION ALL SELECT 'accepted', COUNT(*), COUNT(DISTINCT url) FROM good
UNION ALL SELECT 'repeated request', 2 * (SELECT n FROM again) - COUNT(*), COUNT(DISTINCT url) FROM good
"""

REQUEST_PLAN = f"""
WITH accepted AS ({ACCEPTED_PAGES}),
asked AS (
  SELECT app_id, country, unnest([lang, 'en-US', 'ru-RU']) AS locale, generate_subscripts([lang, 'en-US', 'ru-RU'], 1) AS pos FROM accepted),
named AS (SELECT *, CASE WHEN locale LIKE 'en%' THEN 'english' WHEN locale = 'fr' THEN 'french' WHEN locale = 'de' THEN 'german' ELSE 'russian' END AS steam FROM asked),
fetches AS (
  SELECT app_id, 'app_details' AS request_kind, NULL AS review_type, steam, country FROM named
  UNION ALL SELECT app_id, 'reviews', 'all', steam, NULL FROM named
  UNION ALL SELECT app_id, 'store_page', NULL, steam, country FROM named WHERE pos = 1
  UNION ALL SELECT app_id, 'achievements', NULL, steam, NULL FROM named WHERE pos = 1
  UNION ALL SELECT app_id, 'reviews', unnest(['all', 'positive', 'negative']), 'all', NULL FROM accepted)
SELECT request_kind, review_type, steam AS steam_language, country AS store_country, COUNT(*) AS n, COUNT(DISTINCT app_id) AS apps
FROM fetches GROUP BY 1, 2, 3, 4
"""


REPORTS = {
    "landing_scan": (landing_scan, LANDING_SCAN),
    "admission_split": (admission_split, ADMISSION_SPLIT),
    "id_seed": (id_seed, ID_SEED),
    "game_json": (game_json, GAME_JSON),
    "app_ids": (app_ids, APP_IDS),
    "id_catalogue": (id_catalogue, ID_CATALOGUE),
    "catalogue_chain": (catalogue_chain, CATALOGUE_CHAIN),
    "id_keyset": (id_keyset, ID_KEYSET),
    "id_increment": (id_increment, ID_INCREMENT),
    "catalogue_kind": (catalogue_kind, CATALOGUE_KIND),
    "chain_prefix": (chain_prefix, CHAIN_PREFIX),
    "url_ids": (url_ids, URL_IDS),
    "locale_dim": (locale_dim, LOCALE_DIM),
    "language_names": (language_names, LANGUAGE_NAMES_SQL),
    "first_wins": (first_wins, FIRST_WINS),
    "locale_lists": (locale_lists, LOCALE_LISTS),
    "country_check": (country_check, COUNTRY_CHECK),
    "request_split": (request_split, REQUEST_SPLIT),
    "request_plan": (request_plan, REQUEST_PLAN),
}
