"""Fetching and checking of URLs in parallel tasks, with a kept table in place of a cache file."""

from __future__ import annotations

import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.operators.state import not_yet_known, url_key

AGENT = "Mozilla/5.0 (compatible; document-pipeline)"
Fetch = Callable[[str, int], tuple[bytes, str]]


def http_fetch(url: str, timeout: int) -> tuple[bytes, str]:
    """Body and content type; ``file:`` URLs are read as well."""
    with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": AGENT}), timeout=timeout) as answer:
        return answer.read(), answer.headers.get("Content-Type", "")


def fetched(sources: DataFrame, fetch: Fetch = http_fetch, timeout: int = 30, retries: int = 4, delay: float = 1.0, tasks: int | None = None, request_delay: float = 1.0) -> DataFrame:
    """``id, url, content, content_type, error``: every source is tried up to ``retries`` times with growing pauses.

    All sources of a host are one task's, which pauses ``request_delay`` between two requests to it.

    Forms are not fetched. A failure is a row with an error, never a failed task.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: dict[str, float] = {}
        for part in parts:
            out = []
            for name, url in zip(part["id"], part["url"]):
                host = urllib.parse.urlsplit(url or "").netloc
                if host:
                    time.sleep(max(0.0, last.get(host, 0.0) + request_delay - time.monotonic()))
                    last[host] = time.monotonic()
                content, kind, error = None, None, None
                if not url or "docs.google.com/forms" in url or "forms.gle" in url:
                    error = "not fetched"
                else:
                    for attempt in range(max(1, retries)):
                        try:
                            (content, kind), error = fetch(url, timeout), None
                            break
                        except Exception as e:  # noqa: BLE001 - whatever the network brings
                            error = f"{type(e).__name__}: {e}"[:100]
                            time.sleep(delay * 2**attempt if attempt + 1 < retries else 0)
                out.append((name, url, content, kind, error))
            yield pd.DataFrame(out, columns=["id", "url", "content", "content_type", "error"])

    host = F.coalesce(F.regexp_extract("url", "^[^:/?#]+://([^/?#]*)", 1), F.lit(""))
    rows = sources.select("id", "url")
    return (rows.repartition(tasks, host) if tasks else rows.repartition(host)).mapInPandas(run, "id string, url string, content binary, content_type string, error string")


def to_fetch(sources: DataFrame, kept: DataFrame) -> DataFrame:
    """Sources whose URL is not in the kept table."""
    keyed = sources.withColumn("url_key", url_key(F.col("url")))
    return not_yet_known(keyed, kept, "url_key").drop("url_key")


def http_check(url: str, timeout: int) -> tuple[int, str]:
    """Status and content type by a HEAD request, by GET if that is not allowed."""
    for method in ("HEAD", "GET"):
        try:
            with urllib.request.urlopen(urllib.request.Request(url, method=method, headers={"User-Agent": AGENT}), timeout=timeout) as answer:
                return answer.status, answer.headers.get("Content-Type", "")
        except urllib.error.HTTPError as e:
            if e.code != 405 or method == "GET":
                return e.code, e.headers.get("Content-Type", "") if e.headers else ""
    raise AssertionError


def verified(sources: DataFrame, check: Callable[[str, int], tuple[int, str]] = http_check, timeout: int = 10, tasks: int = 10) -> DataFrame:
    """``id, accessible, status_code, content_type, error`` in order of id; only status 200 is accessible."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for name, url in zip(part["id"], part["url"]):
                try:
                    status, kind = check(url, timeout)
                    out.append((name, status == 200, status, kind, None if status == 200 else f"HTTP {status}"))
                except Exception as e:  # noqa: BLE001 - whatever the network brings
                    out.append((name, False, None, None, f"{type(e).__name__}: {e}"[:100]))
            made = pd.DataFrame(out, columns=["id", "accessible", "status_code", "content_type", "error"])
            yield made.astype({"status_code": "Int32"})

    return sources.select("id", "url").repartition(tasks).mapInPandas(run, "id string, accessible boolean, status_code int, content_type string, error string").orderBy("id")
