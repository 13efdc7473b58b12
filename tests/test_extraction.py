"""Race pages of every kind: none of them fails a task, each has one outcome."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.sources import extraction as X
from tidemark.sources import race_pages as P

HEAD = "".join(f"<th>{h}</th>" for h in ("Pla.", "Horse No.", "Horse", "Jockey", "Trainer", "Act. Wt.", "Declar. Horse Wt.", "Dr.", "LBW", "Finish Time", "Win Odds"))


def runner(n, horse="X1", position="1"):
    link = f'<a href="/horse?HorseId={horse}">Nämé {n}</a>' if horse else f"Name {n}"
    return f"<tr><td>{position}</td><td>{n}</td><td>{link}</td><td>J</td><td>T</td><td>120</td><td>1100</td><td>3</td><td>-</td><td>1:09.1</td><td>4.5</td></tr>"


def page(rows, prize="HK$ 1,000", head=HEAD, mark=' class="performance"'):
    return f'<table class="race_tab"><tr><td>RACE 3 (17)</td><td>{prize}</td></tr></table><div{mark}><table><tr>{head}</tr>{rows}</table></div>'


GOOD = page(runner(1) + runner(2, "X2", "2") + "<tr><td colspan=11>note</td></tr>" + runner(3, "", "3"))
PAGES = {
    "good": (GOOD, "OK", 3), "no_page": (None, "REQUEST_FAILED", None), "broken": ("<p>x</p><![odd[" + GOOD, "PARSE_FAILED", None), "empty": ("", "SKIP_NO_RESULTS", None),
    "no_prize": (page(runner(1), "HK$ 0"), "SKIP_ZERO_PRIZE", 1), "no_table": ("<html><p>Abandoned</p>", "SKIP_NO_RESULTS", None), "other_table": (page(runner(1), mark=""), "SKIP_NO_RESULTS", None),
    "few_headers": (page(runner(1), head=HEAD.replace("Trainer", "Coach")), "SKIP_NO_RESULTS", None), "no_runner": (page("<tr><td>-</td><td></td><td>void</td></tr>"), "SKIP_NO_RESULTS", 0),
    "cut_off": (GOOD[: GOOD.index("Win Odds")], "SKIP_NO_RESULTS", 0), "twice": (GOOD + GOOD.replace("X1", "X9"), "OK", 3),
}


def pages_of(spark, pages, kind="string"):
    return spark.createDataFrame([(k, h, 1) for k, h in pages.items()], f"race_id string, html {kind}, n int").repartition(3)


def test_every_page_has_one_outcome(spark):
    found = {r["race_id"]: r for r in X.outcomes(pages_of(spark, {k: v[0] for k, v in PAGES.items()})).collect()}
    assert {k: (r["status"], None if r["runners"] is None else len(r["runners"])) for k, r in found.items()} == {k: v[1:] for k, v in PAGES.items()}
    assert found["broken"]["message"].startswith("AssertionError: ") and all(r["message"] is None for k, r in found.items() if k != "broken")
    assert found["good"]["n"] == 1 and found["good"]["race_number"] == 3 and found["good"]["prize_money_hkd"] == 1000


def test_bytes_are_read_in_the_charset_they_name(spark):
    latin = ('<meta charset="latin-1">' + GOOD).encode("latin-1")
    pages = {"utf8": GOOD.encode(), "latin": latin, "not_utf8": GOOD.encode("latin-1"), "unknown": b"<meta charset=no-such-one>", "none": None}
    found = {r["race_id"]: r for r in X.outcomes(pages_of(spark, pages, "binary")).collect()}
    assert {k: r["status"] for k, r in found.items()} == {"utf8": "OK", "latin": "OK", "not_utf8": "PARSE_FAILED", "unknown": "PARSE_FAILED", "none": "REQUEST_FAILED"}
    assert found["not_utf8"]["message"].startswith("UnicodeDecodeError: ") and found["unknown"]["message"].startswith("LookupError: ")
    names = X.runner_rows(X.outcomes(pages_of(spark, {"latin": latin}, "binary")), "https://s.example").select("horse_name").collect()
    assert sorted(r[0] for r in names) == ["Name 3", "Nämé 1", "Nämé 2"]


def test_one_pass_writes_and_counts(spark, tmp_path):
    df = pages_of(spark, {k: v[0] for k, v in PAGES.items()})
    counts = X.extract(df, str(tmp_path / "out"))
    assert counts == {"pages": 11, "OK": 2, "REQUEST_FAILED": 1, "PARSE_FAILED": 1, "SKIP_ZERO_PRIZE": 1, "SKIP_NO_RESULTS": 6, "runners": 6}
    rows = X.runner_rows(spark.read.parquet(str(tmp_path / "out")), "https://s.example")
    assert sorted((r["result_id"], r["field_size"], r["is_winner"]) for r in rows.where("race_id = 'good'").collect()) == [("good_3", 3, False), ("good_X1", 3, True), ("good_X2", 3, False)]
    assert rows.count() == 6
    assert sum(X.extract(df.limit(0), str(tmp_path / "none")).values()) == 0


def test_the_plain_parser_still_raises(spark):
    with pytest.raises(Exception, match="unknown status keyword"):
        P.page_parts(pages_of(spark, {"broken": PAGES["broken"][0]}), "html").collect()


def test_tables_of_history_and_cards_without_their_table(spark):
    form = "<table><tr><td>Race Index</td><td>Date</td><td>Race Class</td><td>Rtg.</td></tr><tr><td>7</td><td>05/01/24</td><td>4</td><td>60</td></tr><tr><td>7</td><td>05/01/24</td><td>3</td><td>61</td></tr><tr><td>x</td><td>y</td></tr></table><p>Current Rating : 64</p>"
    pages = spark.createDataFrame([("A", form), ("B", "<table><tr><td>Date</td></tr></table>"), ("C", None), ("D", "")], "horse_id string, html string")
    found = P.rating_history(P.page_parts(pages, "html")).collect()
    assert [(r["horse_id"], r["race_index"], r["race_class"], r["horse_rating_before"], r["horse_rating_after"]) for r in found] == [("A", 7, "3", 61, 64)]
    cards = P.starters(P.page_parts(pages.withColumnRenamed("horse_id", "race_id"), "html"), "https://s.example")
    assert cards.count() == 0


def test_a_page_of_many_rows_takes_time_in_proportion(spark):
    """600 and 2,400 header rows: what was evaluated for each row of each row took sixteen times as long."""
    import time

    took = []
    for n in (600, 2400, 600, 2400):
        rows = "".join(f"<tr><td>RACE {i} ({i})</td><td>Class 4 - 1200M</td></tr>" for i in range(n))
        df = P.race_header(P.page_parts(spark.createDataFrame([("r", f'<table class="race_tab">{rows}</table>')], "race_id string, html string"), "html"))
        began = time.time()
        df.select(F.col("race_number")).collect()
        took.append(time.time() - began)
    assert took[3] < 10 * max(took[2], 0.3)
