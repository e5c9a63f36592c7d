"""Health of the paged endpoint from a request log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Target and alert limit of each rate, and the least page fill.
RATE_LIMIT_HITS = (0.01, 0.05)
RESPONSE_MS = (500, 2000)
RETRIES = (0.05, 0.10)
PAGE_FILL = 0.9


def request_health(log: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Requests, rate-limit hits, retries, and the hit rate (0 without requests)."""
    hits = F.count_if(F.col("status") == 429)
    rate = F.coalesce(hits / F.nullif(F.count("*"), F.lit(0)), F.lit(0.0))
    return log.groupBy(*(by or [])).agg(
        F.count("*").alias("total_requests"),
        hits.alias("total_rate_limit_hits"),
        F.count_if("is_retry").alias("total_retries"),
        rate.alias("rate_limit_hit_rate"),
    )


def _level(value, good: float, bad: float):
    return F.when(value > bad, "alert").when(value >= good, "watch").otherwise("ok")


def request_alerts(log: DataFrame, page_size: int = 100, by: list[str] | None = None) -> DataFrame:
    """(Specified here.) Rates with their level: ok below the target, alert above the limit."""
    total = F.nullif(F.count("*"), F.lit(0))
    rates = log.groupBy(*(by or [])).agg(
        (F.count_if(F.col("status") == 429) / total).alias("rate_limit_hit_rate"),
        F.avg("duration_ms").alias("avg_response_ms"),
        (F.count_if("is_retry") / total).alias("retry_rate"),
        (F.sum("records") / total).alias("records_per_request"),
    )
    efficiency = F.col("records_per_request") / page_size
    return rates.select(
        *(by or []),
        *[c for c in rates.columns if c not in (by or [])],
        efficiency.alias("page_fill"),
        _level(F.col("rate_limit_hit_rate"), *RATE_LIMIT_HITS).alias("rate_limit_level"),
        _level(F.col("avg_response_ms"), *RESPONSE_MS).alias("response_level"),
        _level(F.col("retry_rate"), *RETRIES).alias("retry_level"),
        F.when(efficiency >= PAGE_FILL, "ok").otherwise("watch").alias("page_fill_level"),
    )
