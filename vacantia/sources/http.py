"""Live boards: a batch data source that fetches provider URLs politely, one partition a host.

    spark.dataSource.register(BoardSource)
    spark.read.format("boards").option("requests", json.dumps([{"provider": ..., "slug": ..., "url": ...}])).load()

A request that fails is a row with a status, never a lost row. All requests of a host are in one partition, so that its rate limit is
global; a task that Spark runs again starts over and keeps to it.
"""

from __future__ import annotations

import gzip
import io
import json
import random
import time
import urllib.error
import urllib.request
from collections.abc import Iterator
from urllib.parse import urlsplit

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Hosts that may be asked, their rates in requests a second, and the budgets of a request.
HOSTS = (
    "boards-api.greenhouse.io", "boards.greenhouse.io", "api.lever.co", "api.eu.lever.co", "jobs.lever.co", "api.ashbyhq.com", "api.rippling.com", "ats.rippling.com", "recruitee.com", "jobs.personio.de", "jobs.personio.com",
)
RATES = {"api.lever.co": 1.0, "api.eu.lever.co": 1.0, "api.rippling.com": 0.16, "ats.rippling.com": 0.16}
RATE = 2.0
HARD_RETRIES, SOFT_RETRIES = 3, 1
MAX_BODY, MAX_WAIT, TIMEOUT = 24 << 20, 60.0, 30.0


def allowed(url: str, hosts: tuple[str, ...] = HOSTS) -> bool:
    """Whether a URL is plain https to a listed host or one below it."""
    parts = urlsplit(url)
    host = (parts.hostname or "").lower()
    return parts.scheme == "https" and not parts.username and parts.port in (None, 443) and any(host == h or host.endswith("." + h) for h in hosts)


class Pace:
    """Keeps calls at least 1 / rate seconds apart."""

    def __init__(self, rate: float, clock=time.monotonic, sleep=time.sleep):
        self.gap, self.clock, self.sleep, self.next = 1 / rate, clock, sleep, 0.0

    def wait(self) -> None:
        now = self.clock()
        if self.next > now:
            self.sleep(self.next - now)
        self.next = max(now, self.next) + self.gap


def read_capped(stream, limit: int = MAX_BODY) -> bytes:
    """Body of a response, gzip undone; ValueError beyond ``limit`` bytes, packed or not."""
    data = stream.read(limit + 1)
    if len(data) > limit:
        raise ValueError("body too large")
    if data[:2] == b"\x1f\x8b":
        with gzip.GzipFile(fileobj=io.BytesIO(data)) as f:
            data = f.read(limit + 1)
        if len(data) > limit:
            raise ValueError("body too large")
    return data


def fetch(url: str, pace: Pace, opener=urllib.request.urlopen, sleep=time.sleep, wanted=json.loads) -> tuple[str, str | None]:
    """(status, body): ok, not_found, rate_limited, timeout, parse_error or error.

    429 and 5xx are tried up to three times more, after 1, 2 and 4 seconds give or take a quarter, or as long as the server
    asks up to a minute; a timeout or a body that ``wanted`` can't read once more.
    """
    hard = soft = 0
    while True:
        pace.wait()
        try:
            with opener(urllib.request.Request(url, headers={"Accept-Encoding": "gzip"}), timeout=TIMEOUT) as r:
                body = read_capped(r).decode("utf-8", "replace")
            wanted(body)
            return "ok", body
        except urllib.error.HTTPError as e:
            if e.code in (301, 302, 404, 410):
                return "not_found", None
            if e.code != 429 and e.code < 500:
                return "error", None
            if hard == HARD_RETRIES:
                return ("rate_limited" if e.code == 429 else "error"), None
            asked = (e.headers or {}).get("Retry-After", "")
            sleep(min(MAX_WAIT, float(asked)) if asked.isdigit() else 2**hard * random.uniform(0.75, 1.25))
            hard += 1
        except (TimeoutError, urllib.error.URLError):
            if soft == SOFT_RETRIES:
                return "timeout", None
            soft += 1
        except ValueError as e:
            if "too large" in str(e) or soft == SOFT_RETRIES:
                return "parse_error", None
            soft += 1


class _Host(InputPartition):
    def __init__(self, host: str, requests: list[dict]):
        self.host, self.requests = host, requests


class _Reader(DataSourceReader):
    def __init__(self, requests: list[dict], hosts: tuple[str, ...]):
        self.requests, self.hosts = requests, hosts

    def partitions(self) -> list[InputPartition]:
        by_host: dict[str, list[dict]] = {}
        for n, r in enumerate(self.requests):
            by_host.setdefault((urlsplit(r["url"]).hostname or "").lower(), []).append({**r, "ord": n})
        return [_Host(h, rs) for h, rs in sorted(by_host.items())]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        pace = Pace(RATES.get(partition.host, RATE))
        for r in partition.requests:
            xml = r["provider"] == "personio"
            status, body = fetch(r["url"], pace, wanted=(lambda b: None) if xml else json.loads) if allowed(r["url"], self.hosts) else ("refused", None)
            yield r["provider"], r["slug"], r.get("input"), status, body, r["ord"]


class BoardSource(DataSource):
    """Landed boards (see vacantia.schema.RAW_BOARDS) straight from the providers."""

    @classmethod
    def name(cls) -> str:
        return "boards"

    def schema(self) -> str:
        return "provider string, slug string, input string, status string, body string, ord bigint"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(json.loads(self.options.get("requests", "[]")), tuple(json.loads(self.options["hosts"])) if "hosts" in self.options else HOSTS)
