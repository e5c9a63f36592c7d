"""``spark.read.format("paged")`` / ``spark.readStream.format("paged")``.

One time chunk is one input partition; its task follows the cursor chain and
yields one Arrow batch per page. Options:

=================  ==========================================================
transport          ``http`` (default) or ``module:Class``
transport.<name>   options of the transport
endpoint           path of the resource
start, end         range of ``created`` in epoch seconds, end exclusive
chunk_seconds      width of a chunk (default one day)
edges              comma-separated epoch seconds at which chunks are cut instead,
                   so that a busy period is read by several tasks
ranges             comma-separated ``lo-hi`` pairs of epoch seconds: the chunks themselves, in
                   place of a cut range, so that only what is missing is read
page_size          records per page (default 100)
max_pages          page budget of a chunk (default none); a chunk that needs more
                   fails, which ``on_error=record`` reports
on_error           ``fail`` (default) or ``record``: a failing chunk yields one
                   row with ``_error`` instead of failing the job
cursor_field, data_field, has_more_field   names in the page envelope
=================  ==========================================================

A filter on ``created`` leaves out the chunks that it excludes whole; Spark applies it to the rows. Run with
``spark.speculation=false``: a speculative copy of a task would page twice. Land
the result as Parquet before using it more than once. A record that does not fit the
schema is a row with its text in ``_reject`` and why in ``_reasons``.
"""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

import tidegate
from tidegate.schema import CHARGE_SCHEMA
from tidegate.sources.transport import HttpTransport

TRANSPORTS = {"http": HttpTransport}

_META = [
    StructField("_chunk_start", LongType()),
    StructField("_chunk_end", LongType()),
    StructField("_page", LongType()),
    StructField("_error", StringType()),
    StructField("_reject", StringType()),
    StructField("_reasons", StringType()),
]

_PYTHON = {"bigint": int, "string": str, "boolean": bool}


def reasons(record: object, fields: list[StructField]) -> list[str]:
    """What keeps a record from the schema: ``malformed``, ``type:<column>``, ``missing:<column>``."""
    if not isinstance(record, dict):
        return ["malformed"]
    found = []
    for field in fields:
        value, kind = record.get(field.name), _PYTHON[field.dataType.simpleString()]
        if value is None or (not field.nullable and isinstance(value, str) and not value.strip()):
            found += [] if field.nullable else [f"missing:{field.name}"]
        elif type(value) is not kind:
            found.append(f"type:{field.name}")
    return found


@dataclass
class Chunk(InputPartition):
    start: int
    end: int


def chunk_range(start: int, end: int, width: int, edges: list[int]) -> list[Chunk]:
    """Half-open chunks of a range: cut at the edges inside it, or every ``width`` seconds without any."""
    cuts = sorted({e for e in edges if start < e < end}) if edges else range(start + width, end, width)
    bounds = [start, *cuts, end]
    return [Chunk(lo, hi) for lo, hi in zip(bounds, bounds[1:]) if lo < hi]


def chunk_list(ranges: str) -> list[Chunk]:
    """The chunks that the ``ranges`` option names."""
    pairs = [item.split("-") for item in ranges.split(",") if item.strip()]
    return [Chunk(int(lo), int(hi)) for lo, hi in pairs]


class _Pager:
    """Follows one cursor chain; shared by the batch and the stream reader."""

    def __init__(self, options: dict[str, str], schema: StructType):
        self.options = {key.lower(): value for key, value in options.items()}
        self.schema = schema
        self.width = int(self.options.get("chunk_seconds", "86400"))
        self.edges = [int(e) for e in self.options.get("edges", "").split(",") if e.strip()]

    def transport(self):
        chosen, prefix = self.options.get("transport", "http"), "transport."
        options = {k[len(prefix) :]: v for k, v in self.options.items() if k.startswith(prefix)}
        if chosen in TRANSPORTS:
            return TRANSPORTS[chosen](options)
        module, name = chosen.split(":")
        return getattr(importlib.import_module(module), name)(options)

    def pages(self, chunk: Chunk) -> Iterator[list[dict]]:
        get = self.options.get
        cursor_field, data_field = get("cursor_field", "starting_after"), get("data_field", "data")
        transport, cursor, budget = self.transport(), None, int(get("max_pages", "0"))
        params = {"limit": int(get("page_size", "100")), "created[gte]": chunk.start, "created[lt]": chunk.end}
        count = 0
        while True:
            page = transport.fetch(get("endpoint", ""), params | ({cursor_field: cursor} if cursor else {}))
            records = page.get(data_field) or []
            more = bool(page.get(get("has_more_field", "has_more")))
            count += 1
            yield records
            if not more:
                return
            # An empty page with the promise of more would repeat the same cursor for ever.
            cursor = records[-1].get("id") if records and isinstance(records[-1], dict) else None
            if not cursor:
                raise ValueError(f"page {count} promises more but has no cursor")
            if budget and count >= budget:
                raise ValueError(f"page budget of {budget} is used up")

    def batches(self, chunk: Chunk | None) -> Iterator[pa.RecordBatch]:
        if chunk is None:  # how Spark reads a source without partitions
            return
        arrow = to_arrow_schema(self.schema)
        names = [n for n in self.schema.fieldNames() if not n.startswith("_")]
        number = 0

        def batch(records: list[dict], error: str | None) -> pa.RecordBatch:
            meta = {"_chunk_start": chunk.start, "_chunk_end": chunk.end, "_page": number, "_error": error}
            rows = []
            for record in records:
                wrong = reasons(record, CHARGE_SCHEMA.fields) if error is None else []
                # A record that does not fit costs itself, not its page.
                kept = {n: None if wrong else record.get(n) for n in names}
                rows.append(kept | meta | ({"_reject": json.dumps(record), "_reasons": ",".join(wrong)} if wrong else {}))
            return pa.RecordBatch.from_pylist(rows, schema=arrow)

        try:
            for records in self.pages(chunk):
                if records:
                    yield batch(records, None)
                number += 1
        except Exception as error:
            if self.options.get("on_error", "fail") != "record":
                raise
            yield batch([{}], f"{type(error).__name__}: {error}")


class PagedReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.pager = _Pager(options, schema)
        self.chunks = chunk_list(self.pager.options.get("ranges", ""))
        self.start = self.low = self.chunks[0].start if self.chunks else int(self.pager.options["start"])
        self.end = self.high = max(c.end for c in self.chunks) if self.chunks else int(self.pager.options["end"])

    def pushFilters(self, filters: list[Filter]):
        """Bounds on ``created`` leave out whole chunks; Spark applies every filter again to the rows."""
        for item in filters:
            bound = getattr(item, "value", None)
            if getattr(item, "attribute", None) == ("created",) and isinstance(bound, int):
                if isinstance(item, GreaterThanOrEqual):
                    self.low = max(self.low, bound)
                elif isinstance(item, GreaterThan):
                    self.low = max(self.low, bound + 1)
                elif isinstance(item, LessThan):
                    self.high = min(self.high, bound)
                elif isinstance(item, LessThanOrEqual):
                    self.high = min(self.high, bound + 1)
            yield item

    def partitions(self) -> list[Chunk]:
        """The named chunks or those of the configured range, whatever the filters, less those beyond the pushed bounds."""
        chunks = self.chunks or chunk_range(self.start, self.end, self.pager.width, self.pager.edges)
        return [c for c in chunks if c.start < self.high and c.end > self.low]

    def read(self, partition: Chunk | None) -> Iterator[pa.RecordBatch]:
        return self.pager.batches(partition)


class PagedStreamReader(DataSourceStreamReader):
    """The offset is the high-water mark of ``created``.

    Without ``end`` it trails the clock by ``delay_seconds``, so that records
    that show up late still fall into a later batch.
    """

    def __init__(self, options: dict[str, str], schema: StructType):
        self.pager = _Pager(options, schema)

    def initialOffset(self) -> dict:
        return {"created": int(self.pager.options["start"])}

    def latestOffset(self) -> dict:
        fixed = self.pager.options.get("end")
        delay = int(self.pager.options.get("delay_seconds", "300"))
        return {"created": int(fixed) if fixed else int(time.time()) - delay}

    def partitions(self, start: dict, end: dict) -> list[Chunk]:
        return chunk_range(start["created"], end["created"], self.pager.width, self.pager.edges)

    def read(self, partition: Chunk | None) -> Iterator[pa.RecordBatch]:
        return self.pager.batches(partition)

    def commit(self, end: dict) -> None:
        pass


class PagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> StructType:
        record = StructType([StructField(f.name, f.dataType) for f in CHARGE_SCHEMA])
        return StructType([*record.fields, *_META])

    def reader(self, schema: StructType) -> PagedReader:
        return PagedReader(self.options, schema)

    def streamReader(self, schema: StructType) -> PagedStreamReader:
        return PagedStreamReader(self.options, schema)


def register(spark: SparkSession) -> SparkSession:
    """Make the ``paged`` format known to the session.

    The package travels inside the pickled source, so executors need not have it
    installed. Spark refuses a source that takes filters while pushdown is off.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    cloudpickle.register_pickle_by_value(tidegate)
    spark.dataSource.register(PagedSource)
    return spark
