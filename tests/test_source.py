import io
import json
import os
import urllib.error

import pytest
from tabular import rows

from tidegate.sources import paged, transport
from tidegate.sources.paged import register


class Ids:
    """An endpoint with one record per 100 seconds, three records to a page.

    ``break_at`` makes the chunk that starts there fail on its second page;
    ``empty_at`` makes it return an empty page with the promise of more.
    """

    def __init__(self, options):
        self.options = options

    def fetch(self, endpoint, params):
        start, end = params["created[gte]"], params["created[lt]"]
        cursor = params.get("starting_after")
        if str(start) == self.options.get("break_at") and cursor:
            raise OSError("connection lost")
        if str(start) == self.options.get("empty_at"):
            return {"data": [], "has_more": True}
        times = [t for t in range(-(-start // 100) * 100, end, 100) if cursor is None or t > int(cursor[2:])]
        data = [{"id": f"r_{t}", "created": t, "amount": t, "unknown": 1} for t in times[: params["limit"]]]
        return {"data": data, "has_more": len(times) > params["limit"]}


OPTIONS = {"transport": f"{__name__}:Ids", "start": "0", "end": "3000", "chunk_seconds": "1000", "page_size": "3"}


@pytest.fixture()
def read(spark, monkeypatch):
    monkeypatch.setenv("PYTHONPATH", os.path.dirname(__file__))
    monkeypatch.setitem(paged.TRANSPORTS, "ids", Ids)
    from pyspark import cloudpickle

    import test_source

    cloudpickle.register_pickle_by_value(test_source)

    def load(**options):
        return register(spark).read.format("paged").options(**(OPTIONS | {"transport": "ids"} | options)).load()

    yield load
    cloudpickle.unregister_pickle_by_value(test_source)


def test_every_record_once_in_one_partition_per_chunk(read):
    df = read()
    assert [r.created for r in df.orderBy("created").collect()] == list(range(0, 3000, 100))
    assert df.rdd.getNumPartitions() == 3
    assert {(r._chunk_start, r._chunk_end) for r in df.collect()} == {(0, 1000), (1000, 2000), (2000, 3000)}
    assert df.where("_chunk_start = 0").select("_page").distinct().count() == 4


def test_last_chunk_is_clipped_and_empty_range_is_empty(read):
    assert read(end="2500").rdd.getNumPartitions() == 3
    assert read(end="2500").count() == 25
    assert read(start="3000").count() == 0


def test_edges_cut_a_busy_period(read):
    df = read(edges="2100,2200,2300,9999")
    assert {(r._chunk_start, r._chunk_end) for r in df.collect()} == {(0, 2100), (2100, 2200), (2200, 2300), (2300, 3000)}
    assert df.count() == 30


def test_filters_on_created_narrow_the_range(read):
    df = read().where("created >= 1500 AND created < 1800")
    assert df.rdd.getNumPartitions() == 1
    assert [r.created for r in df.orderBy("created").collect()] == [1500, 1600, 1700]
    strict = read().where("created > 1500 AND created <= 1800 AND amount <> 1600")
    assert [r.created for r in strict.orderBy("created").collect()] == [1700, 1800]


def test_bounds_off_the_grid_keep_the_chunks_and_lose_nothing(read):
    df = read().where("created >= 850 AND created < 2050")
    assert [r.created for r in df.orderBy("created").collect()] == list(range(900, 2050, 100))
    assert {r._chunk_start for r in df.collect()} == {0, 1000, 2000}
    assert read().where("created >= 5000").count() == 0


def test_http_transport_retries_broken_connections(monkeypatch):
    calls = []

    def urlopen(request, timeout):
        calls.append(1)
        if len(calls) < 4:
            raise [urllib.error.URLError("reset"), TimeoutError(), ConnectionResetError()][len(calls) - 1]
        return Reply(b'{"data": []}')

    monkeypatch.setattr(transport.urllib.request, "urlopen", urlopen)
    monkeypatch.setattr(transport.time, "sleep", lambda _: None)
    assert transport.HttpTransport({"base_url": "https://api.invalid"}).fetch("x", {}) == {"data": []}
    calls.clear()
    with pytest.raises(urllib.error.URLError):
        transport.HttpTransport({"base_url": "https://api.invalid", "retries": "0"}).fetch("x", {})


def test_failing_chunk_fails_the_job_or_is_recorded(read):
    with pytest.raises(Exception, match="connection lost"):
        read(**{"transport.break_at": "1000"}).collect()
    df = read(**{"transport.break_at": "1000", "on_error": "record"})
    errors = df.where("_error IS NOT NULL").collect()
    assert [(e._chunk_start, e._error) for e in errors] == [(1000, "OSError: connection lost")]
    assert df.where("_error IS NULL AND _chunk_start <> 1000").count() == 20


def test_empty_page_with_more_does_not_loop(read):
    with pytest.raises(Exception, match="has no cursor"):
        read(**{"transport.empty_at": "1000"}).collect()


def test_page_budget(read):
    with pytest.raises(Exception, match="page budget"):
        read(max_pages="2").collect()
    assert read(max_pages="4").count() == 30


class Reply(io.BytesIO):
    def __enter__(self):
        return self

    def __exit__(self, *_):
        return False


def test_http_transport_retries_and_sends_the_token(monkeypatch):
    seen, waits = [], []

    def urlopen(request, timeout):
        seen.append((request.full_url, request.get_header("Authorization"), timeout))
        if len(seen) < 3:
            headers = {"Retry-After": "7"} if len(seen) == 1 else {}
            raise urllib.error.HTTPError(request.full_url, 429 if len(seen) == 1 else 503, "busy", headers, None)
        return Reply(json.dumps({"data": [], "has_more": False}).encode())

    monkeypatch.setattr(transport.urllib.request, "urlopen", urlopen)
    monkeypatch.setattr(transport.time, "sleep", waits.append)
    monkeypatch.setenv("API_TOKEN", "secret")
    client = transport.HttpTransport({"base_url": "https://api.invalid/v1/", "token_env": "API_TOKEN", "timeout": "9"})
    assert client.fetch("/charges", {"created[gte]": 1, "limit": 2}) == {"data": [], "has_more": False}
    assert seen[0] == ("https://api.invalid/v1/charges?created%5Bgte%5D=1&limit=2", "Bearer secret", 9.0)
    assert waits == [7.0, 2.0]


def test_http_transport_gives_up(monkeypatch):
    def urlopen(request, timeout):
        raise urllib.error.HTTPError(request.full_url, status, "no", {}, None)

    monkeypatch.setattr(transport.urllib.request, "urlopen", urlopen)
    monkeypatch.setattr(transport.time, "sleep", lambda _: None)
    for status in (404, 500):
        with pytest.raises(urllib.error.HTTPError):
            transport.HttpTransport({"base_url": "https://api.invalid", "retries": "2"}).fetch("x", {})


def test_stream_continues_where_it_stopped(read, spark, tmp_path):
    read()
    from tidegate.streaming import jobs

    def run(end):
        options = OPTIONS | {"transport": "ids", "end": end}
        stream = spark.readStream.format("paged").options(**options).load()
        return jobs.run_to_parquet(stream, str(tmp_path / "out"), str(tmp_path / "state"))

    assert run("1500").count() == 15
    assert run("1500").count() == 15
    assert rows(run("3000").select("created")) == sorted(((t,) for t in range(0, 3000, 100)), key=repr)
