"""Pages over HTTP as a Spark data source: ``spark.read.format("web_pages").schema(...)``, or ``fetched`` for a table of urls.

Each partition belongs to one host and keeps one connection to it open, so a host is never asked by more tasks than
``per_host`` says. Answers 429 and 5xx and broken connections are tried again after growing pauses, or after the pause that
the host asks for (Retry-After); other answers are final. Nothing raises: a page that can't be had is a row with its status
and error and no body, so that what failed can be asked for again. A lost task asks its host's pages again.
"""

from __future__ import annotations

import email.utils
import http.client
import time
from collections.abc import Iterator, Sequence
from urllib.parse import urljoin, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "url string, status int, attempts int, error string, body binary"
AGAIN = frozenset((408, 425, 429, 500, 502, 503, 504))
REDIRECTS = frozenset((301, 302, 303, 307, 308))


def pause_of(attempt: int, backoff: float, retry_after: str | None, most: float) -> float:
    """Seconds to wait after a failed attempt: what the host says, in seconds or as a date, or backoff * 2 ** (attempt - 1)."""
    if retry_after:
        if retry_after.strip().isdigit():
            return min(most, float(retry_after))
        try:
            return min(most, max(0.0, email.utils.parsedate_to_datetime(retry_after).timestamp() - time.time()))
        except (TypeError, ValueError):
            pass
    return min(most, backoff * 2 ** (attempt - 1))


class Session:
    """One kept connection to a host."""

    def __init__(self, scheme: str, host: str, timeout: float, agent: str) -> None:
        kind = http.client.HTTPSConnection if scheme == "https" else http.client.HTTPConnection
        self.connection, self.agent = kind(host, timeout=timeout), agent

    def get(self, url: str) -> tuple[int, bytes, str | None, str | None]:
        """Status, body, Retry-After, Location."""
        parts = urlsplit(url)
        try:
            self.connection.request("GET", (parts.path or "/") + (f"?{parts.query}" if parts.query else ""), headers={"User-Agent": self.agent, "Connection": "keep-alive"})
            answer = self.connection.getresponse()
            return answer.status, answer.read(), answer.getheader("Retry-After"), answer.getheader("Location")
        except BaseException:
            self.connection.close()  # the next request opens it anew
            raise


def fetch(session: Session, url: str, retries: int, backoff: float, most_pause: float) -> tuple:
    """(url, status, attempts, error, body) of one page."""
    status, error, at, hops = None, None, url, 0
    for attempt in range(1, retries + 2):
        after = None
        try:
            status, body, after, location = session.get(at)
            while status in REDIRECTS and location and hops < 5 and urlsplit(urljoin(at, location)).netloc == urlsplit(url).netloc:
                at, hops = urljoin(at, location), hops + 1
                status, body, after, location = session.get(at)
            if status < 300:
                return url, status, attempt, None, body
            error = f"HTTP {status}"
            if status not in AGAIN:
                return url, status, attempt, error, None
        except (OSError, http.client.HTTPException) as e:
            status, error = None, f"{type(e).__name__}: {e}"
        if attempt <= retries:
            time.sleep(pause_of(attempt, backoff, after, most_pause))
    return url, status, retries + 1, error, None


def fetched_rows(urls: Sequence[str], options: dict[str, float]) -> Iterator[tuple]:
    """The pages of one host after each other, over one session."""
    sessions: dict[tuple[str, str], Session] = {}
    for url in urls:
        try:
            parts = urlsplit(url)
            key = parts.scheme, parts.netloc
            if parts.scheme not in ("http", "https") or not parts.netloc:
                raise ValueError("no http url")
            if key not in sessions:
                sessions[key] = Session(*key, options["timeout"], "tidemark")
        except ValueError as e:
            yield url, None, 0, f"{type(e).__name__}: {e}", None
            continue
        yield fetch(sessions[key], url, int(options["retries"]), options["backoff"], options["most_pause"])
    for s in sessions.values():
        s.connection.close()


DEFAULTS = {"timeout": 60.0, "retries": 3.0, "backoff": 1.0, "most_pause": 120.0}


class HostPartition(InputPartition):
    def __init__(self, urls: list[str]) -> None:
        self.urls = urls


class WebPagesReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.urls = [u for u in options.get("urls", "").split("\n") if u]
        self.options = {k: float(options.get(k, v)) for k, v in DEFAULTS.items()}

    def partitions(self) -> list[HostPartition]:
        by_host: dict[str, list[str]] = {}
        for u in self.urls:
            by_host.setdefault(urlsplit(u).netloc if "://" in u else "", []).append(u)
        return [HostPartition(urls) for urls in by_host.values()]

    def read(self, partition: HostPartition) -> Iterator[tuple]:
        yield from fetched_rows(partition.urls, self.options)


class WebPages(DataSource):
    """A short list of urls, as the option ``urls``, one a line."""

    @classmethod
    def name(cls) -> str:
        return "web_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: object) -> WebPagesReader:
        return WebPagesReader(dict(self.options))


def read_pages(spark: SparkSession, urls: Sequence[str], **options: float) -> DataFrame:
    spark.dataSource.register(WebPages)
    return spark.read.format("web_pages").options(urls="\n".join(urls), **options).load()


def fetched(urls: DataFrame, column: str = "url", per_host: int = 1, **options: float) -> DataFrame:
    """The pages of a table of urls, of any length: (url, status, attempts, error, body). Rows are dealt by host, ``per_host`` tasks
    at most to each; a host's pages are fetched one after the other by each of these."""
    settings = DEFAULTS | options
    host = F.coalesce(F.try_parse_url(F.col(column), F.lit("HOST")), F.lit(""))
    dealt = urls.select(F.col(column).alias("url")).where("url is not null").repartition(host, F.pmod(F.xxhash64("url"), F.lit(per_host)))

    def run(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        for batch in batches:
            for row in fetched_rows(batch.column("url").to_pylist(), settings):
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (pa.string(), pa.int32(), pa.int32(), pa.string(), pa.binary()), strict=True)], names=["url", "status", "attempts", "error", "body"])

    return dealt.mapInArrow(run, SCHEMA)
