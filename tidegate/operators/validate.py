"""Typed ingest of JSON records and schema validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidegate.schema import CHARGE_SCHEMA


def parsed_once(struct: Column) -> Column:
    """The fields of a parsed struct as columns.

    Selecting ``struct.*`` would let the optimizer parse the text again for
    every field; a generator is evaluated once per row.
    """
    return F.inline(F.array(struct))


# JSON types that a column of each type accepts, as named by ``schema_of_variant``.
_ACCEPTED = {"string": "STRING", "bigint": "BIGINT", "boolean": "BOOLEAN"}


def typed_ingest(df: DataFrame, text: str = "value", schema: StructType = CHARGE_SCHEMA) -> DataFrame:
    """Records under a fixed schema: unknown keys are dropped, missing ones are NULL.

    Broken JSON, a value of another type and a NULL in a column that must not have one fail the
    job; the reading is that of :func:`validate_schema`, which reports such records instead.
    """
    checked = validate_schema(df, text, schema)
    required = [F.when(F.col(f.name).isNull(), F.lit(f"missing:{f.name}")) for f in schema if not f.nullable]
    wrong = F.filter("reasons", lambda reason: ~reason.startswith("missing:"))
    problems = F.concat(wrong, F.array_compact(F.array(*required)))
    failed = F.raise_error(F.concat(F.lit("record without a valid reading: "), F.array_join(problems, ",")))
    first = schema[0]
    guarded = F.when(F.size(problems) > 0, failed.cast(first.dataType)).otherwise(F.col(first.name))
    return checked.select(guarded.alias(first.name), *[f.name for f in schema if f.name != first.name])


def validate_schema(df: DataFrame, text: str = "value", schema: StructType = CHARGE_SCHEMA) -> DataFrame:
    """(Specified here.) Typed records, the raw text and ``reasons`` (empty when valid).

    Reasons: ``malformed`` for broken JSON or text that is no object, ``missing:<column>`` for a
    required column that is NULL or blank, ``type:<column>`` for a value of another JSON type: a
    quoted number is no number, a number no text.
    """
    kind = {f.name: f.dataType.simpleString() for f in schema}
    # Four steps behind generators, each evaluated once per row: parse, find the fields, type them, judge them.
    parsed = df.select(F.col(text).alias("raw"), parsed_once(F.struct(F.try_parse_json(text).alias("_v"))))
    fields = [F.try_variant_get("_v", f"$.{name}", "variant").alias(f"_v_{name}") for name in kind]
    # An object begins with a brace; naming the whole record's schema would go through all of its values.
    broken = (F.col("_v").isNull() | ~F.col("raw").rlike(r"^\s*\{")).alias("_broken")
    found = parsed.select("raw", parsed_once(F.struct(broken, *fields)))
    kinds = [F.schema_of_variant(f"_v_{name}").alias(f"_k_{name}") for name in kind]
    values = [F.try_variant_get(f"_v_{name}", "$", of).alias(f"_x_{name}") for name, of in kind.items()]
    typed = found.select("raw", parsed_once(F.struct(F.col("_broken"), *kinds, *values)))
    reasons, columns = [F.when(F.col("_broken"), F.lit("malformed"))], []
    for field in schema:
        name, value = field.name, F.col(f"_x_{field.name}")
        fits = F.coalesce(F.col(f"_k_{name}") == _ACCEPTED[kind[name]], F.lit(False))
        given = F.coalesce(F.col(f"_k_{name}") != "VOID", F.lit(False))
        columns.append(F.when(fits, value).alias(name))
        if not field.nullable:
            empty = ~given | F.coalesce(F.trim(value.cast("string")) == "", F.lit(False))
            reasons.append(F.when(~F.col("_broken") & empty, F.lit(f"missing:{name}")))
        reasons.append(F.when(~F.col("_broken") & given & ~fits, F.lit(f"type:{name}")))
    judged = typed.select("raw", parsed_once(F.struct(*columns, F.array_compact(F.array(*reasons)).alias("reasons"))))
    return judged.select(*kind, "raw", "reasons")


def blank(key: Column) -> Column:
    return key.isNull() | (F.trim(key) == "")


def keyed(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key is neither NULL nor blank."""
    return df.where(~blank(F.col(key)))


def unkeyed(df: DataFrame, key: str) -> DataFrame:
    """The rows that :func:`keyed` leaves out."""
    return df.where(blank(F.col(key)))


def valid_rows(validated: DataFrame) -> DataFrame:
    return validated.where(F.size("reasons") == 0).drop("raw", "reasons")


def rejected_rows(validated: DataFrame) -> DataFrame:
    return validated.where(F.size("reasons") > 0).select("raw", "reasons")


def conform(df: DataFrame, columns: dict, source: str) -> DataFrame:
    """(Specified here.) Project a source onto shared columns and name it in ``source``."""
    return df.select(F.lit(source).alias("source"), *[column.alias(name) for name, column in columns.items()])


def union_sources(*frames: DataFrame) -> DataFrame:
    """(Specified here.) Conformed sources as one table; absent columns become NULL."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result
