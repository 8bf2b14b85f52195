import datetime as dt
import json
import threading
import time
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import parse_qs, urlparse

import pytest

from tidewater.sources.paged import ApiError, PagedClient, PagedSource, RateLimiter

DAY = dt.date(2026, 8, 27)


def client(answers, **kw):
    seen, slept = [], []

    def fetch(url, timeout):
        seen.append({k: v[0] for k, v in parse_qs(urlparse(url).query).items()})
        a = answers[min(len(seen), len(answers)) - 1]
        if isinstance(a, Exception):
            raise a
        return a if isinstance(a, tuple) else (200, {}, json.dumps(a).encode())

    c = PagedClient("http://x/studies", 10**6, fetch=fetch, sleep=slept.append, **kw)
    return c, seen, slept


def test_follows_tokens():
    pages = [{"studies": [1, 2], "nextPageToken": "a", "totalCount": 5}, {"nextPageToken": "b"}, {"studies": [5]}]
    c, seen, _ = client(pages)
    assert list(c.studies(DAY, DAY)) == [1, 2, 5]
    assert seen[0]["countTotal"] == "true" and "countTotal" not in seen[1]
    assert [s.get("pageToken") for s in seen] == [None, "a", "b"]
    assert seen[0]["filter.advanced"] == "AREA[LastUpdatePostDate]RANGE[2026-08-27,2026-08-27]"


def test_page_size_is_capped():
    assert PagedClient("x", page_size=5000).page_size == 1000


def test_retries():
    c, _, slept = client([(429, {"Retry-After": "7"}, b""), (503, {}, b""), OSError("reset"), {"studies": []}])
    assert list(c.studies(DAY, DAY)) == [] and c.retry_count == 3 and c.request_count == 4
    assert slept[0] == 7 and 2 <= slept[1] <= 3 and 4 <= slept[2] <= 5
    c, _, slept = client([(500, {}, b"")], max_retries=2)
    with pytest.raises(ApiError, match="status 500"):
        list(c.studies(DAY, DAY))
    assert len(slept) == 2
    c, seen, _ = client([(404, {}, b"nothing here")])
    with pytest.raises(ApiError, match="404: nothing here"):
        list(c.studies(DAY, DAY))
    assert len(seen) == 1


def test_limiter():
    limiter, began = RateLimiter(600), time.monotonic()
    for _ in range(3):
        limiter.wait()
    assert time.monotonic() - began >= 0.18


def test_source(spark):
    asked = []

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            q = {k: v[0] for k, v in parse_qs(urlparse(self.path).query).items()}
            asked.append(q)
            n = int(q.get("pageToken", 0))
            date = "2026-08-27" if n < 2 else "2026-08-28"
            s = {"protocolSection": {"statusModule": {"lastUpdatePostDateStruct": {"date": date}}}, "n": n}
            body = json.dumps({"studies": [s], **({"nextPageToken": str(n + 1)} if n < 3 else {})}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    spark.dataSource.register(PagedSource)
    options = {"url": f"http://127.0.0.1:{server.server_port}/studies", "requestsPerMinute": "100000"}
    df = spark.read.format("paged_studies").options(**options, start="2026-08-27", end="2026-08-28").load()
    rows = df.collect()
    assert [json.loads(r.payload)["n"] for r in rows] == [0, 1, 2, 3] and rows[3].last_update_post_date == dt.date(2026, 8, 28)
    asked.clear()
    wide = spark.read.format("paged_studies").options(**options, start="2026-01-01", end="2026-12-31").load()
    got = wide.where("last_update_post_date >= date '2026-08-28' and last_update_post_date <= date '2026-08-30'").collect()
    assert len(got) == 2 and asked[0]["filter.advanced"].endswith("RANGE[2026-08-28,2026-08-30]")
    server.shutdown()
