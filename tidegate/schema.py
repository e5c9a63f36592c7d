"""Schemas of the records the library reads and writes."""

from pyspark.sql.types import StructType


def _schema(**fields: str) -> StructType:
    """Types by name; a trailing ``!`` marks a column that must not be NULL."""
    schema = StructType()
    for name, kind in fields.items():
        schema = schema.add(name, kind.removesuffix("!"), not kind.endswith("!"))
    return schema


# The column names and types of a charge record.
CHARGE_SCHEMA = _schema(
    id="string!",
    object="string",
    amount="long",
    amount_captured="long",
    amount_refunded="long",
    currency="string",
    customer="string",
    description="string",
    status="string",
    created="long",
    paid="boolean",
    refunded="boolean",
    payment_method="string",
    receipt_email="string",
    receipt_url="string",
)
CHARGE_COLUMNS = CHARGE_SCHEMA.fieldNames()

# The fields of a structured log line.
LOG_SCHEMA = _schema(
    timestamp="string",
    level="string",
    logger="string",
    message="string",
    module="string",
    function="string",
    line="integer",
    exception="string",
    job_id="string",
    run_id="string",
    partition_id="long",
    api_endpoint="string",
    duration_ms="long",
    operation="string",
)

# One run of a job; the checkpoint is a fold over these rows. A reset row voids those before it.
RUN_SCHEMA = _schema(
    checkpoint_key="string!",
    run_id="string!",
    high_water_mark="timestamp",
    records="long",
    cursor="string",
    updated_at="timestamp",
    metadata="string",
    is_reset="boolean",
)
