"""Byte ranges of capture files, read and written where the rows are.

A location is (canonical_url, filename, length, offset); a task opens ``base`` + filename, takes the
range, unpacks the gzip member, and yields the page behind the record's and the response's headers, or
null where a range is missing, is no page or isn't UTF-8. Files may be in a shared folder (file://) or
behind HTTP where a network exists; a server's 429 ends the job. The driver sees no location.
"""

from __future__ import annotations

import gzip
import json
import math
import os
import re
import time
import urllib.error
import urllib.parse
import urllib.request
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class TooManyRequests(RuntimeError):
    """The server asked to stop."""


def _local_path(folder: str) -> str:
    """The path behind a file URL, written with one slash or three."""
    return re.sub(r"^file:(//)?", "", folder)


def fetch_range(url: str, offset: int, length: int) -> bytes | None:
    """Bytes of a range; None unless the server sends just that part."""
    if url.startswith("file:"):
        try:
            with open(_local_path(url), "rb") as f:
                f.seek(offset)
                return f.read(length)
        except OSError:
            return None
    request = urllib.request.Request(url, headers={"Range": f"bytes={offset}-{offset + length - 1}"})
    try:
        with urllib.request.urlopen(request, timeout=60) as response:
            return response.read() if response.status == 206 else None
    except urllib.error.HTTPError as error:
        if error.code == 429:
            raise TooManyRequests(url) from error
        return None


def page_of(record: bytes | None) -> str | None:
    """The page in the first record of a capture range."""
    if not record:
        return None
    try:
        raw = gzip.decompress(record) if record[:2] == b"\x1f\x8b" else record
        parts = raw.split(b"\r\n\r\n", 2)
        return parts[2].rstrip(b"\r\n").decode("utf-8") if len(parts) == 3 else None
    except (OSError, EOFError, UnicodeDecodeError):
        return None


class RateLimiter:
    """Requests a second over a window that restarts when it is full."""

    def __init__(self, max_qps: float, window: float = 30.0, clock=time.monotonic, sleep=time.sleep) -> None:  # noqa: ANN001
        self.max_qps, self.window, self.clock, self.sleep = max_qps, window, clock, sleep
        self.started, self.sent = clock(), 0

    def take(self, n: int = 1) -> None:
        """Wait until ``n`` more requests keep the rate."""
        if self.clock() - self.started >= self.window:
            self.started, self.sent = self.clock(), 0
        while (self.sent + n) / max(self.clock() - self.started, 1e-9) > self.max_qps and self.sent:
            self.sleep(0.1)
        self.sent += n


class FailureBudget:
    """Counts failures and gives up at ``limit``."""

    def __init__(self, limit: int = 20, pause: float = 10.0, sleep=time.sleep) -> None:  # noqa: ANN001
        self.limit, self.pause, self.sleep, self.failures = limit, pause, sleep, 0

    def spend(self, error: Exception) -> None:
        """Record one failure; raise it if it was the last allowed."""
        self.failures += 1
        if self.failures >= self.limit:
            raise error
        self.sleep(self.pause)


def read_captures(locations: DataFrame, base: str, qps: float = math.inf, tasks: int | None = None, failures: int = 20) -> DataFrame:
    """locations(canonical_url, filename, length, offset) to (canonical_url, html). With a rate or a limit
    of failures the work is spread over ``tasks`` tasks, each of which has its part of both, so that all
    together keep them. Null fields give a null page."""
    n = tasks or int(locations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own_rate, own_failures = qps / n, max(1, failures // n)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        limiter, budget = RateLimiter(own_rate), FailureBudget(own_failures)
        for batch in batches:
            pages: list[str | None] = []
            for name, length, offset in zip(batch["filename"], batch["length"], batch["offset"]):
                if name is None or pd.isna(length) or pd.isna(offset):
                    pages.append(None)
                    continue
                limiter.take()
                try:
                    pages.append(page_of(fetch_range(base + name, int(offset), int(length))))
                except OSError as error:
                    budget.spend(error)
                    pages.append(None)
            yield pd.DataFrame({"canonical_url": batch["canonical_url"], "html": pd.Series(pages, dtype="object", index=batch.index)})

    asked = locations.select("canonical_url", "filename", F.col("length").cast("bigint"), F.col("offset").cast("bigint"))
    return asked.repartition(n).mapInPandas(run, "canonical_url string, html string")


def write_captures(pages: DataFrame, folder: str) -> DataFrame:
    """pages(canonical_url, html) as gzipped records in files below a shared folder, one file a task, and
    their locations (canonical_url, filename, length, offset), which must be stored: they are those of
    the run that wrote. A file of a failed attempt is left but no location names it. Null pages are left
    out."""
    root = _local_path(folder)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.makedirs(root, exist_ok=True)
        name, at = f"capture-{uuid.uuid4().hex}.warc.gz", 0
        with open(os.path.join(root, name), "wb") as out:
            for batch in batches:
                rows = []
                for key, html in zip(batch["canonical_url"], batch["html"]):
                    record = gzip.compress(b"WARC/1.0\r\nWARC-Type: response\r\n\r\nHTTP/1.1 200 OK\r\n\r\n" + html.encode() + b"\r\n\r\n", mtime=0)
                    out.write(record)
                    rows.append((key, name, len(record), at))
                    at += len(record)
                yield pd.DataFrame(rows, columns=["canonical_url", "filename", "length", "offset"])

    return pages.select("canonical_url", "html").where("html is not null").mapInPandas(run, "canonical_url string, filename string, length bigint, offset bigint")


def capture_stats(captured: DataFrame, seconds: float | None = None) -> DataFrame:
    """captured(html) to one row: pages asked for, found, the percentage found, and pages a second."""
    found = F.count("html")
    rate = F.lit(None).cast("double") if not seconds else F.count("*") / F.lit(float(seconds))
    return captured.agg(F.count("*").alias("n_total"), found.alias("n_found"), F.round(F.try_divide(100 * found, F.count("*")), 2).alias("successful"), rate.alias("qps"))


def fetch_page_views(pages: DataFrame, base: str, pause: float = 0.1, first: str = "20151010", last: str = "20181231") -> DataFrame:
    """pages(page_title, page_id) to (page_title, page_id, views): the sum of a page's monthly views, asked
    of ``base``/title/monthly/first/last once a page. Pages without a good answer are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for title, page in zip(batch["page_title"], batch["page_id"]):
                try:
                    with urllib.request.urlopen(f"{base}/{urllib.parse.quote(title, safe='')}/monthly/{first}/{last}", timeout=60) as answer:
                        if getattr(answer, "status", None) in (None, 200):
                            rows.append((title, page, sum(x["views"] for x in json.load(answer)["items"])))
                except (OSError, ValueError, KeyError, TypeError):
                    pass
                time.sleep(pause)
            yield pd.DataFrame(rows, columns=["page_title", "page_id", "views"]).astype({"page_title": "object", "page_id": "int64", "views": "int64"})

    return pages.select("page_title", "page_id").where("page_title is not null and page_id is not null").distinct().mapInPandas(run, "page_title string, page_id bigint, views bigint")
