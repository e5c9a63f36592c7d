"""Masking and run identifiers."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the layout of a run id.
RUN_ID_PATTERN = r"^run-(\d{8})-(\d{6})-([0-9a-f]{8})$"
MASK = "****"


def mask_sensitive(value: Column, visible: int = 4) -> Column:
    """First ``visible`` characters and a mask; shorter or NULL values are masked whole."""
    return F.when(F.length(value) > visible, F.concat(F.substring(value, 1, visible), F.lit(MASK))).otherwise(
        F.lit(MASK)
    )


def new_run_id(now: datetime) -> str:
    return f"run-{now:%Y%m%d-%H%M%S}-{uuid.uuid4().hex[:8]}"


def run_started_at(run_id: Column) -> Column:
    """Start time encoded in a run id; NULL when the text is no run id."""
    stamp = F.concat(F.regexp_extract(run_id, RUN_ID_PATTERN, 1), F.regexp_extract(run_id, RUN_ID_PATTERN, 2))
    return F.try_to_timestamp(stamp, F.lit("yyyyMMddHHmmss"))


def run_suffix(run_id: Column) -> Column:
    return F.nullif(F.regexp_extract(run_id, RUN_ID_PATTERN, 3), F.lit(""))
