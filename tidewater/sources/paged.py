"""A cursor-paginated HTTP API as a Spark data source."""

from __future__ import annotations

import datetime as dt
import json
import random
import threading
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, GreaterThanOrEqual, InputPartition, LessThanOrEqual

MAX_PAGE = 1000
#: Answers worth another try.
RETRYABLE = {429, 500, 502, 503, 504}


class ApiError(RuntimeError):
    pass


class RateLimiter:
    """At most so many calls a minute, evenly spaced, for all threads together."""

    def __init__(self, per_minute: int):
        self.interval, self.next, self.lock = 60.0 / max(1, per_minute), 0.0, threading.Lock()

    def wait(self) -> None:
        with self.lock:
            delay = self.next - time.monotonic()
            if delay > 0:
                time.sleep(delay)
            self.next = max(self.next, time.monotonic()) + self.interval


def _fetch(url: str, timeout: float) -> tuple[int, dict, bytes]:
    try:
        with urllib.request.urlopen(url, timeout=timeout) as r:  # noqa: S310
            return r.status, dict(r.headers), r.read()
    except urllib.error.HTTPError as e:
        return e.code, dict(e.headers), e.read()


class PagedClient:
    """Follows page tokens through a window of update dates, with retries."""

    def __init__(
        self,
        url: str,
        requests_per_minute: int = 40,
        max_retries: int = 5,
        page_size: int = MAX_PAGE,
        timeout: float = 60,
        fetch: Callable[[str, float], tuple[int, dict, bytes]] = _fetch,
        sleep: Callable[[float], None] = time.sleep,
    ):
        self.url, self.max_retries, self.timeout = url, max_retries, timeout
        self.page_size = min(page_size, MAX_PAGE)
        self.limiter, self.fetch, self.sleep = RateLimiter(requests_per_minute), fetch, sleep
        self.request_count = self.retry_count = 0

    def get(self, params: dict) -> dict:
        url = f"{self.url}?{urllib.parse.urlencode(params)}"
        problem = "no attempt"
        for attempt in range(self.max_retries + 1):
            self.limiter.wait()
            self.request_count += 1
            wait = min(60.0, 2.0**attempt) + random.random()  # noqa: S311
            try:
                status, headers, body = self.fetch(url, self.timeout)
            except OSError as e:
                problem = repr(e)
            else:
                if status == 200:
                    return json.loads(body)
                problem = f"status {status}"
                if status not in RETRYABLE:
                    raise ApiError(f"{problem}: {body[:300].decode(errors='replace')}")
                after = {k.lower(): v for k, v in headers.items()}.get("retry-after", "")
                if after.isdigit():
                    wait = float(after)
            if attempt < self.max_retries:
                self.retry_count += 1
                self.sleep(wait)
        raise ApiError(f"gave up after {self.max_retries + 1} attempts: {problem}")

    def studies(self, start: dt.date, end: dt.date, count_total: bool = True) -> Iterator[dict]:
        """Every record last updated from ``start`` to ``end``, both included."""
        params = {
            "filter.advanced": f"AREA[LastUpdatePostDate]RANGE[{start.isoformat()},{end.isoformat()}]",
            "pageSize": self.page_size,
            "sort": "LastUpdatePostDate",
        }
        if count_total:
            params["countTotal"] = "true"
        while True:
            page = self.get(params)
            yield from page.get("studies") or []
            params.pop("countTotal", None)
            if not page.get("nextPageToken"):
                return
            params["pageToken"] = page["nextPageToken"]


class _Window(InputPartition):
    def __init__(self, start: dt.date, end: dt.date):
        self.start, self.end = start, end


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options
        self.start = dt.date.fromisoformat(options["start"]) if "start" in options else None
        self.end = dt.date.fromisoformat(options["end"]) if "end" in options else None

    def pushFilters(self, filters):  # noqa: N802
        """Bounds on the date narrow the window; Spark still applies every filter."""
        for f in filters:
            if isinstance(f, GreaterThanOrEqual) and f.attribute == ("last_update_post_date",):
                self.start = max(self.start or f.value, f.value)
            elif isinstance(f, LessThanOrEqual) and f.attribute == ("last_update_post_date",):
                self.end = min(self.end or f.value, f.value)
            yield f

    def partitions(self):
        if self.start is None or self.end is None:
            raise ValueError("a window is needed: options start and end, or filters on last_update_post_date")
        days = (self.end - self.start).days + 1
        # The limit is one for all requests from an address, so one reader is the default.
        n = max(1, min(int(self.options.get("partitions", 1)), days))
        cuts = [self.start + dt.timedelta(days=days * i // n) for i in range(n + 1)]
        return [_Window(a, b - dt.timedelta(days=1)) for a, b in zip(cuts, cuts[1:], strict=False)] if days > 0 else []

    def read(self, partition):
        o = self.options
        n = max(1, int(o.get("partitions", 1)))
        client = PagedClient(
            o["url"],
            max(1, int(o.get("requestsPerMinute", 40)) // n),
            int(o.get("maxRetries", 5)),
            int(o.get("pageSize", MAX_PAGE)),
        )
        for study in client.studies(partition.start, partition.end):
            text = ((study.get("protocolSection") or {}).get("statusModule") or {}).get("lastUpdatePostDateStruct") or {}
            try:
                day = dt.date.fromisoformat(text.get("date", ""))
            except (TypeError, ValueError):
                day = None
            yield json.dumps(study, ensure_ascii=False), day


class PagedSource(DataSource):
    """spark.read.format("paged_studies").option("url", ...).option("start", ...).option("end", ...)"""

    @classmethod
    def name(cls):
        return "paged_studies"

    def schema(self):
        return "payload string, last_update_post_date date"

    def reader(self, schema):
        return _Reader(dict(self.options))
