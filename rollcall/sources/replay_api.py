"""A paginated REST source of battle records, as a Python data source ('replay_api').

Options: url; since (mark, exclusive); earliest (bound, inclusive); limit (page size, 1024); delay (seconds
between pages, 1.0). Records arrive newest first, so pages are read in turn until one is empty or reaches the
mark. A page that fails raises: a part of the pull must not pass for the whole (see ingest.ingest).

As a stream it reads a page a batch, and its offset says how far the pull has come, so after a failure the
checkpoint resumes it at the page that failed: spark.readStream.format("replay_api").
"""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Callable, Iterator
from urllib.parse import urlencode
from urllib.request import urlopen

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader
from pyspark.sql.types import StructType

from ..operators.ingest import EARLIEST
from ..schemas import API_BATTLE
from ..session import importable

PAGE_ROWS = 1024


def http_page(url: str, page: int, limit: int) -> list[dict]:
    """One page of the service."""
    with urlopen(f"{url}?{urlencode({'page': page, 'limit': limit, 'endedNormally': 'true'})}", timeout=60) as reply:
        return json.load(reply).get("data") or []


def pull(fetch: Callable[[int], list[dict]], since: str | None, earliest: str = EARLIEST, delay: float = 1.0) -> Iterator[dict]:
    """Records of all pages until an empty page, the mark or the bound. Records without id or time are skipped."""
    page = 1
    while records := fetch(page):
        for record in records:
            at = record.get("startTime")
            if not record.get("id") or not at:
                continue
            if (since is not None and at <= since) or at < earliest:
                return
            yield record
        page += 1
        time.sleep(delay)


class ReplayApi(DataSource):
    @classmethod
    def name(cls) -> str:
        return "replay_api"

    def schema(self) -> StructType:
        return API_BATTLE

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return _StreamReader(dict(self.options))


def _fetch(options: dict) -> Callable[[int], list[dict]]:
    module, _, name = options.get("fetch", f"{__name__}:http_page").partition(":")
    page = getattr(importlib.import_module(module), name)
    limit = int(options.get("limit", PAGE_ROWS))
    return lambda n: page(options["url"], n, limit)


def _row(r: dict) -> tuple:
    teams = [([(p.get("name"),) for p in t.get("Players") or []],) for t in r.get("AllyTeams") or []]
    return r["id"], r["startTime"], ((r.get("Map") or {}).get("scriptName"),), teams


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]  # where a page ends the pull is only known from the one before

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        o = self.options
        yield from map(_row, pull(_fetch(o), o.get("since"), o.get("earliest", EARLIEST), float(o.get("delay", 1.0))))


class _StreamReader(SimpleDataSourceStreamReader):
    """A page a batch. The offset of a pull under way is its mark below (since), the newest time it began with (top),
    the page to read next, and the last record read: its time (last) and the ids read at that time. New records push
    older ones to later pages, never to earlier ones, so a pull goes on at its page and skips what it has read. When
    it reaches the mark, top is the next mark.
    """

    def __init__(self, options: dict):
        self.fetch, self.earliest, self.delay = _fetch(options), options.get("earliest", EARLIEST), float(options.get("delay", 1.0))
        self.first = options.get("since")

    def initialOffset(self) -> dict:
        return {"since": self.first, "top": None, "page": 1, "last": None, "ids": []}

    def _page(self, o: dict) -> tuple[list[dict], dict]:
        """Records of the offset's page that weren't read, and the offset behind it."""
        records, rows, end = self.fetch(o["page"]), [], False
        top, last, ids = o["top"], o["last"], list(o["ids"])
        for r in records:
            at = r.get("startTime")
            if not r.get("id") or not at:
                continue
            end = (o["since"] is not None and at <= o["since"]) or at < self.earliest
            if end:
                break
            if last is not None and (at > last or (at == last and r["id"] in ids)):
                continue
            top = at if top is None else top  # records come newest first
            last, ids = at, [*(ids if at == last else []), r["id"]]
            rows.append(r)
        if end or not records:
            return rows, {"since": top or o["since"], "top": None, "page": 1, "last": None, "ids": []}
        return rows, {"since": o["since"], "top": top, "page": o["page"] + 1, "last": last, "ids": ids}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        if start["page"] > 1:
            time.sleep(self.delay)
        rows, end = self._page(start)
        return iter([_row(r) for r in rows]), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        """What a batch had that is run again: newer records are left out, older ones end it."""
        top, at = end["top"] or end["since"], start
        while True:
            rows, behind = self._page(at)
            for r in rows:
                if end["last"] is not None and (r["startTime"] < end["last"] or (r["startTime"] == end["last"] and r["id"] not in end["ids"])):
                    return
                if r["startTime"] <= top:
                    yield _row(r)
            if behind["page"] == 1:
                return
            at = behind


def register(spark: SparkSession) -> None:
    importable(spark)
    spark.dataSource.register(ReplayApi)
