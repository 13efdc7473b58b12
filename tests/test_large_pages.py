"""Pages of any length: what must not grow with the square of a page's rows, nor with the pages of a batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from tests.test_extraction import HEAD, page
from tidemark.sources import extraction as X
from tidemark.sources import race_pages as P

SITE = "https://s.example"


def long_page(spark, n, cell):
    """One page of ``n`` rows, made by Spark."""
    return spark.range(n).groupBy().agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", cell.alias("row")))), lambda x: x["row"]), "").alias("rows"))


def test_runners_of_a_long_page_do_not_each_carry_the_field(spark):
    i = F.col("id").cast("string")
    cell = F.concat(F.lit("<tr><td>"), i, F.lit("</td><td>"), i, F.lit('</td><td><a href="/horse?HorseId=H'), i, F.lit('">Name</a></td><td>J</td><td>T</td><td>120</td><td>1100</td><td>3</td><td>-</td><td>1:09.1</td><td>4.5</td></tr>'))
    rows = long_page(spark, 20_000, cell)
    start, end = page("@").split("@")
    pages = rows.select(F.lit("r").alias("race_id"), F.concat(F.lit(start), "rows", F.lit(end)).alias("html"))
    for found in (P.results(P.page_parts(pages, "html", ["rows"]), SITE), X.runner_rows(X.outcomes(pages), SITE)):
        got = found.agg(F.count("*").alias("n"), F.countDistinct("result_id").alias("ids"), F.min("field_size").alias("low"), F.max("field_size").alias("high"), F.sum("finishing_position").alias("s")).first()
        assert tuple(got) == (20_000, 20_000, 20_000, 20_000, 20_000 * 19_999 // 2)


def test_pages_are_handed_on_by_their_length():
    """Twelve pages of half a million characters in one Arrow batch come out four at a time."""
    import pyarrow as pa

    class Pages:
        columns = ["race_id", "html"]

        class schema:  # noqa: N801
            fields = ()

        def select(self, *_):
            return self

        def mapInArrow(self, f, _):  # noqa: N802
            html = page("<tr><td>1</td></tr>" * 27_000)
            given = pa.RecordBatch.from_pydict({"race_id": [f"r{k}" for k in range(12)], "html": [html] * 12})
            return [(b.num_rows, b.column(0).to_pylist()) for b in f(iter([given]))]

    assert len(page("<tr><td>1</td></tr>" * 27_000)) * 5 > P.BATCH_CHARACTERS
    found = P.page_parts(Pages(), "html", ["rows"])
    assert max(n for n, _ in found) <= 5 and sum((ids for _, ids in found), []) == [f"r{k}" for k in range(12)]


def test_plain_tags_and_raw_text():
    """Tags read at a glance are those that the parser reads; none inside a script."""
    found = P.parts(f"<script>'</td><td>'</script><table><TR><td>a<td >b</td></tr ><tr><td colspan=2>c</td></tr></table>{HEAD}")
    assert [found.cells, found.row_begins, found.strings[:3]] == [["a", "b", "c"], [0, 2], ["a", "b", "c"]]
