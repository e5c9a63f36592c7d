"""Landed pages of a cursor-paged endpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StructType

from tidegate.operators.ordered import running
from tidegate.operators.validate import parsed_once
from tidegate.schema import CHARGE_SCHEMA


def parse_envelopes(
    pages: DataFrame,
    record: StructType = CHARGE_SCHEMA,
    body: str = "body",
    data_field: str = "data",
    has_more_field: str = "has_more",
) -> DataFrame:
    """Replace the JSON body by ``data`` (empty when absent) and ``has_more`` (false when absent)."""
    envelope = StructType().add(data_field, ArrayType(record)).add(has_more_field, BooleanType())
    others = [c for c in pages.columns if c != body]
    return pages.select(*others, parsed_once(F.from_json(body, envelope))).select(
        *others,
        F.coalesce(data_field, F.array().cast(ArrayType(record))).alias("data"),
        F.coalesce(has_more_field, F.lit(False)).alias("has_more"),
    )


def flatten_pages(pages: DataFrame, keep: list[str] | None = None, **options) -> DataFrame:
    """One row per record of every page, with the page columns in ``keep``."""
    parsed = parse_envelopes(pages, **options)
    return parsed.select(*(keep or []), F.explode("data").alias("record")).select(*(keep or []), "record.*")


def check_chains(pages: DataFrame, chain: str = "chain_id") -> DataFrame:
    """Pages that break their cursor chain, with the ``problem``.

    Takes parsed pages. Each page is joined to its predecessor by page number,
    which spreads a long chain over all tasks; a window per chain would not.

    * ``missing_page``: a page's predecessor is absent,
    * ``wrong_cursor``: the cursor is not the last id of the page before,
    * ``empty_page``: more pages are promised but this one has no record,
    * ``open_end``: more pages are promised but none follows.
    """
    here = pages.select(
        chain,
        "page_no",
        F.size("data").alias("records"),
        "has_more",
        "starting_after",
        F.lit(True).alias("present"),
    )
    before = pages.select(
        F.col(chain),
        (F.col("page_no") + 1).alias("page_no"),
        F.try_element_at("data", F.lit(-1))["id"].alias("expected"),
        F.col("has_more").alias("promised"),
    )
    joined = here.join(before, [chain, "page_no"], "full")
    problem = (
        F.when(F.col("present").isNull() & F.col("promised"), "open_end")
        .when(F.col("present").isNull(), None)
        .when((F.col("page_no") > 0) & F.col("promised").isNull(), "missing_page")
        .when(F.col("has_more") & (F.col("records") == 0), "empty_page")
        .when(~F.col("starting_after").eqNullSafe(F.col("expected")), "wrong_cursor")
    )
    reported = F.when(F.col("present").isNull(), F.col("page_no") - 1).otherwise(F.col("page_no"))
    return joined.select(chain, reported.alias("page_no"), problem.alias("problem")).where("problem IS NOT NULL")


def page_totals(pages: DataFrame, chain: str = "chain_id") -> DataFrame:
    """Pages, records and highest page number of each chain."""
    return pages.groupBy(chain).agg(
        F.count("*").alias("pages"), F.sum(F.size("data")).alias("records"), F.max("page_no").alias("last_page")
    )


def page_progress(pages: DataFrame, chain: str = "chain_id") -> DataFrame:
    """Records in each page and the running total of its chain."""
    sized = pages.select(chain, "page_no", F.size("data").cast("bigint").alias("records_in_page"))
    return running(sized, [chain], ["page_no"], {"total_records": ("sum", F.col("records_in_page"))})
