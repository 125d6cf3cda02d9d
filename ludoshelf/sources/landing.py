"""Landed responses: scan, admission, id seed, and the document sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ludoshelf import schemas
from ludoshelf.functions import variant
from ludoshelf.functions.clean import strip
from ludoshelf.sources.staging import shuffles_removed


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """Landing table, Parquet partitioned by ``request_kind``. The schema is declared, never inferred."""
    return spark.read.schema(schemas.LANDING).parquet(path)


def write_landing(landing: DataFrame, path: str, mode: str = "append") -> None:
    """Range-partitioned by kind and app, so a scan by app id skips files and row groups.

    An app with very many pages is cut into several ranges by page number and locale.
    """
    order = ("request_kind", "app_id", "page_no", "locale")
    ordered = landing.repartitionByRange(*order).sortWithinPartitions(*order)
    with shuffles_removed(landing.sparkSession):
        ordered.write.mode(mode).partitionBy("request_kind").parquet(path)


def scan(
    landing: DataFrame,
    kind: str,
    app_ids: DataFrame | None = None,
    **parameters: str | int,
) -> DataFrame:
    """Responses of one kind. The kind prunes partitions; request parameters become pushed filters.

    ``app_ids`` (one column, app_id) restricts the scan by a left semi join.
    """
    rows = landing.where(F.col("request_kind") == kind)
    for name, value in parameters.items():
        rows = rows.where(F.col(name) == value)
    return rows if app_ids is None else rows.join(app_ids.select("app_id").distinct(), "app_id", "left_semi")


def delivered(status: Column | str = "http_status") -> Column:
    """A response arrived; no status counts as delivered."""
    return F.coalesce(F.col(status) if isinstance(status, str) else status, F.lit(200)).between(200, 399)


def with_details(rows: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Details bodies read to ``data``, a struct of variant leaves, and ``error`` where not admitted.

    The body is an object keyed by the app id; it counts when ``success`` is truthy and ``data`` an object.
    """
    opened = variant.let(
        variant.read(F.try_parse_json("body"), "map<string,variant>"),
        lambda body: F.struct(
            body.isNotNull().alias("is_object"),
            variant.read(
                F.try_element_at(body, F.col("app_id").cast("string")), "struct<success:variant,data:variant>"
            ).alias("entry"),
        ),
    )
    admitted = variant.let(
        opened,
        lambda o: F.struct(
            o["is_object"].alias("is_object"),
            F.when(
                variant.truthy(o["entry"]["success"]), variant.read(o["entry"]["data"], variant.leaves(names))
            ).alias("data"),
        ),
    )
    read = variant.computed_once(rows, _read=F.when(delivered(), admitted)).withColumn("row_key", F.xxhash64("body")).drop("body")
    return read.select(
        *(c for c in read.columns if c != "_read"),
        "_read.data",
        _http_error()
        .when(~F.col("_read.is_object"), F.lit("unexpected response"))
        .when(F.col("_read.data").isNull(), F.lit("app was not found"))
        .alias("error"),
    )


def _http_error() -> Column:
    return F.when(~delivered(), F.concat(F.lit("http status "), F.col("http_status")))


def with_payload(rows: DataFrame, names: tuple[str, ...], require_success: bool = False) -> DataFrame:
    """Object bodies read to ``payload``, a struct of variant leaves, and ``error`` where not admitted.

    ``require_success`` asks for the number 1 (or true) in ``success``.
    """
    wanted = variant.leaves(dict.fromkeys((*names, "success")))
    read = variant.computed_once(rows, payload=variant.read(F.try_parse_json("body"), wanted)).drop("body")
    success = F.col("payload.success")
    is_one = (variant.kind(success) != "STRING") & (variant.number(success) == 1)
    return read.withColumn(
        "error",
        _http_error()
        .when(F.col("payload").isNull(), F.lit("unexpected response"))
        .when(F.lit(require_success) & ~F.coalesce(is_one, F.lit(False)), F.lit("no success flag")),
    )


def with_page(rows: DataFrame) -> DataFrame:
    """HTML bodies with ``error`` where the page did not arrive."""
    return rows.withColumn(
        "error",
        _http_error().when(F.col("body").isNull(), F.lit("empty response")),
    )


def id_seed(spark: SparkSession, path: str) -> DataFrame:
    """Text file with one id per line to distinct ids."""
    return seed_ids(spark.read.text(path), "value")


def seed_ids(lines: DataFrame, column: str) -> DataFrame:
    return (
        lines.select(strip(column).try_cast("bigint").alias("app_id")).where(F.col("app_id") > 0).distinct()
    )


def to_document(record: DataFrame) -> DataFrame:
    """One JSON document per row, nulls kept, fields in column order."""
    return record.select(
        F.to_json(F.struct(*record.columns), {"ignoreNullFields": "false"}).alias("document")
    )


def write_documents(games: DataFrame, path: str, mode: str = "overwrite") -> None:
    games.write.mode(mode).option("ignoreNullFields", "false").json(path)

