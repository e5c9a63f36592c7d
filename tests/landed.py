"""A stand-in endpoint for tests: pages that Spark has landed as Parquet."""

from __future__ import annotations

import json
import uuid

import pyarrow.fs as fs
import pyarrow.parquet as pq


class LandedPages:
    """Replays pages that an earlier job landed as Parquet.

    Layout: ``<path>/chain_id=<created[gte]>/*.parquet`` with ``page_no``,
    ``starting_after`` and ``body``; files sort by name into page order. Pages
    are streamed, so a long chain needs no more memory than a short one.
    ``fail_chain`` makes that chain fail, to exercise error handling.
    """

    def __init__(self, options: dict[str, str]):
        self.filesystem, self.root = fs.FileSystem.from_uri(options["path"])
        self.fail_chain = options.get("fail_chain")
        self._chain, self._cursor, self._pages = None, None, iter(())

    def _open(self, chain: str):
        if chain == self.fail_chain:
            raise OSError(f"chain {chain} is not available")
        selector = fs.FileSelector(f"{self.root}/chain_id={chain}")
        names = sorted(i.path for i in self.filesystem.get_file_info(selector) if i.path.endswith(".parquet"))
        for name in names:
            with self.filesystem.open_input_file(name) as handle:
                for batch in pq.ParquetFile(handle).iter_batches(64, columns=["starting_after", "body"]):
                    yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())

    def fetch(self, endpoint: str, params: dict) -> dict:
        chain, cursor = str(params["created[gte]"]), params.get("starting_after")
        if cursor is None or chain != self._chain:
            self._chain, self._pages = chain, self._open(chain)
        for starting_after, body in self._pages:
            if starting_after == cursor:
                return json.loads(body)
        raise OSError(f"chain {chain} has no page after {cursor}")


class RangedPages:
    """Serves any range of records that Spark has landed as Parquet (``id``, ``created`` and others), page by page.

    ``fail`` names starts of chunks that fail, comma-separated; ``calls`` a folder in which every chunk that is
    asked for leaves a file, so that a test sees what was paged.
    """

    def __init__(self, options: dict[str, str]):
        self.path, self.calls = options["path"], options.get("calls")
        self.fail = set(filter(None, options.get("fail", "").split(",")))

    def fetch(self, endpoint: str, params: dict) -> dict:
        lo, hi, after = params["created[gte]"], params["created[lt]"], params.get("starting_after")
        if self.calls and after is None:
            with open(f"{self.calls}/{lo}-{hi}-{uuid.uuid4().hex}", "w"):
                pass
        if str(lo) in self.fail:
            raise OSError(f"chunk {lo} is not available")
        records = pq.read_table(self.path, filters=[("created", ">=", lo), ("created", "<", hi)]).to_pylist()
        records.sort(key=lambda r: (r["created"], r["id"]))
        start = next(i for i, r in enumerate(records) if r["id"] == after) + 1 if after else 0
        page = records[start : start + params["limit"]]
        return {"data": page, "has_more": start + len(page) < len(records)}
