"""Extraction that keeps its failures: every page comes out once, with a status and, if it failed, what went wrong.

Pages are parsed one by one in Arrow batches: whatever a page makes the parser raise becomes that page's status and message,
and no task fails. What became of the pages is counted while they go by.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.sources import race_pages as P

STATUSES = ("OK", "REQUEST_FAILED", "PARSE_FAILED", "SKIP_ZERO_PRIZE", "SKIP_NO_RESULTS")

_CHARSET = re.compile(rb"""charset\s*=\s*["']?\s*([\w.:-]+)""", re.IGNORECASE)


def decoded(html: str | bytes) -> str:
    """A page's text: bytes are read as the charset that their head names, else as UTF-8."""
    if isinstance(html, str):
        return html
    named = _CHARSET.search(html[:2048])
    return bytes(html).decode(named[1].decode() if named else "utf-8")


def captured(html: str | bytes | None) -> tuple:
    """failure, message and the parts of a page, whatever it is."""
    if html is None:
        return "REQUEST_FAILED", None, P.Parts()
    try:
        return None, None, P.parts(decoded(html))
    except Exception as e:  # noqa: BLE001  a page may make the parser raise anything
        return "PARSE_FAILED", f"{type(e).__name__}: {e}", P.Parts()


def captured_parts(pages: DataFrame, html: str, columns: Sequence[str] = tuple(P.COLUMNS)) -> DataFrame:
    """The other columns of ``pages`` with failure, message, strings, hrefs and rows, or some of the last three; ``html``: text or bytes, null where the
    page could not be had. ``failure`` is null where the page could be parsed."""
    return P.with_parts(pages, html, captured, "failure string, message string", columns)


def outcomes(pages: DataFrame, html: str = "html") -> DataFrame:
    """A row a race page (race_id, html): status, message, what the header says, the runners. A failed request comes before a
    failed parse, then a race without prize, then one without runners."""
    df = P.with_runners(P.race_header(captured_parts(pages, html, ["rows"])))
    status = F.coalesce("failure", F.when(F.col("prize_money_hkd") == 0, "SKIP_ZERO_PRIZE").when(F.coalesce(F.size("runners"), F.lit(0)) <= 0, "SKIP_NO_RESULTS").otherwise("OK"))
    return df.withColumn("status", status).drop("failure", "rows")


def counted(found: DataFrame, name: str = "extraction") -> tuple[DataFrame, Observation]:
    """The outcomes, and the counts of each status and of the runners, which are there once they have been written."""
    seen = Observation(name)
    runners = F.sum(F.when(F.col("status") == "OK", F.size("runners")).otherwise(0)).alias("runners")
    return found.observe(seen, F.count(F.lit(1)).alias("pages"), *[F.count_if(F.col("status") == s).alias(s) for s in STATUSES], runners), seen


def runner_rows(found: DataFrame, site: str) -> DataFrame:
    """The rows of the runners of all pages that are OK."""
    return P.runner_rows(found.withColumn("runners", F.when(F.col("status") == "OK", F.col("runners"))), site)


def extract(pages: DataFrame, path: str, html: str = "html") -> dict[str, int]:
    """Write the outcomes of all pages to ``path`` and return the counts: one pass over the pages, and the runners' rows come from
    what was written (``runner_rows`` of it)."""
    found, seen = counted(outcomes(pages, html))
    found.write.option("compression", "zstd").parquet(path)
    if pages.sparkSession.read.schema(found.schema).parquet(path).isEmpty():  # an empty plan observes nothing
        return dict.fromkeys(("pages", *STATUSES, "runners"), 0)
    return {k: v or 0 for k, v in seen.get.items()}
