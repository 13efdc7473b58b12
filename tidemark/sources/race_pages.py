"""Result pages, horses' histories, profiles, race numbers and race cards from HTML.

A small parser turns a page into its texts, links and table rows (``page_parts``); which table is meant, what its columns
are and what a row says is decided by Column expressions on these parts. A page is one row throughout: nothing is shuffled.
A page without the table that is looked for gives no rows, which is the normal case of a race without result.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import dates, text

# The spellings of the headers of the three tables, after normalisation, the columns that each must have, the
# headers by which a race card is known, and the labels of a profile.
RESULT_HEADERS = {
    "finishing_position": ("pla", "place", "placing", "position", "pos"), "horse_number": ("horse no", "horse number", "horse num"), "horse": ("horse", "horse name"),
    "jockey": ("jockey",), "trainer": ("trainer",), "actual_weight": ("act wt", "actual wt", "actual weight"),
    "declared_horse_weight": ("declar horse wt", "declared horse wt", "declar horse weight", "declared horse weight"), "draw": ("dr", "draw"),
    "margin": ("lbw", "margin", "lengths behind winner"), "finish_time": ("finish time", "finishing time"), "odds": ("win odds", "winning odds", "odds"),
}
RESULT_CORE = ("finishing_position", "horse_number", "horse", "jockey", "trainer", "actual_weight", "declared_horse_weight", "draw", "margin")
FORM_HEADERS = {"race_index": ("race index", "race no index"), "date": ("date", "race date"), "race_class": ("race class", "class"), "rating": ("rtg", "rating")}
CARD_HEADERS = {
    "horse_number": ("horse no", "horse number"), "horse_name": ("horse", "name"), "handicap_weight": ("wt", "handicap weight"), "jockey": ("jockey",), "draw": ("draw", "dr"),
    "trainer": ("trainer",), "horse_rating": ("rtg", "rating"),
    "declared_horse_weight": ("horse wt declaration", "horse wt declaration horse weight", "horse weight declaration"), "days_since_last_run": ("days since last run",),
}
CARD_FINGERPRINT = ("horse no", "last 6 runs", "colour", "horse", "wt", "jockey", "draw", "trainer", "rtg", "horse wt declaration", "days since last run")
PROFILE_LABELS = ("Country of Origin / Age", "Country of Origin", "Colour / Sex", "Import Type", "Import Date", "Owner", "Sire", "Dam", "Dam's Sire", "Current Rating", "Last Rating")

CELL = "struct<text: string, head: boolean, links: array<struct<href: string, text: string>>>"
ROW = f"struct<table_no: int, own: string, around: string, cells: array<{CELL}>>"
COLUMNS = {"strings": "array<string>", "hrefs": "array<string>", "rows": f"array<{ROW}>"}
SILENT = {"script", "style", "template"}
#: Tags without attributes of elements that hold no raw text: as they make up most of a long page, they are read at a glance.
PLAIN_START, PLAIN_END = re.compile("<(td|th|tr|table|thead|tbody|p|b|div|span|h1)>"), re.compile("</(td|th|tr|table|thead|tbody|a|p|b|div|span|h1)>")
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class Parts(HTMLParser):
    """Texts, links, and the rows of all tables with the classes of the table and of what is around it. What is found is kept in
    flat lists, as Arrow has it: a row begins at a cell, a cell at a link."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.strings: list[str] = []
        self.hrefs: list[str] = []
        self.rows: list[tuple[int, str, str]] = []
        self.row_begins: list[int] = []
        self.cells: list[str] = []
        self.heads: list[bool] = []
        self.cell_begins: list[int] = []
        self.link_hrefs: list[str] = []
        self.link_texts: list[list[str]] = []
        self.stack: list[tuple[str, str]] = []
        self.silent = 0
        self.tables: list[tuple[int, str, str]] = []
        self.n_tables = 0
        self.cell: list[str] | None = None
        self.link: list[str] | None = None

    def updatepos(self, i: int, j: int) -> int:
        return j  # nobody asks for lines

    def parse_starttag(self, i: int) -> int:
        if plain := PLAIN_START.match(self.rawdata, i):
            self.handle_starttag(plain[1], [])
            return plain.end()
        return super().parse_starttag(i)

    def parse_endtag(self, i: int) -> int:
        if self.cdata_elem is None and (plain := PLAIN_END.match(self.rawdata, i)):
            self.handle_endtag(plain[1])
            return plain.end()
        return super().parse_endtag(i)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        named = {k: v or "" for k, v in attrs} if attrs else {}
        if tag in ("td", "th", "tr", "table"):
            self.end_cell()
        if tag == "table":
            self.tables.append((self.n_tables, named.get("class", ""), " ".join(c for _, c in self.stack if c)))
            self.n_tables += 1
        elif tag == "tr" and self.tables:
            self.new_row()
        elif tag in ("td", "th") and self.tables:
            if not self.rows or self.rows[-1][0] != self.tables[-1][0]:
                self.new_row()
            self.cell = []
            self.heads.append(tag == "th")
            self.cell_begins.append(len(self.link_hrefs))
        elif tag == "a" and "href" in named:
            self.hrefs.append(named["href"])
            self.link = []
            if self.cell is not None:
                self.link_hrefs.append(named["href"])
                self.link_texts.append(self.link)
        if tag not in VOID:
            self.stack.append((tag, named.get("class", "")))
            self.silent += tag in SILENT

    def new_row(self) -> None:
        self.rows.append(self.tables[-1])
        self.row_begins.append(len(self.heads))

    def end_cell(self) -> None:
        if self.cell is not None:
            self.cells.append(" ".join(self.cell))
        self.cell = self.link = None

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th", "tr", "table"):
            self.end_cell()
        if tag == "a":
            self.link = None
        if tag == "table" and self.tables:
            self.tables.pop()
        if self.stack and self.stack[-1][0] == tag or any(t == tag for t, _ in self.stack):
            while True:
                closed = self.stack.pop()[0]
                self.silent -= closed in SILENT
                if closed == tag:
                    break

    def handle_data(self, data: str) -> None:
        if not self.silent and (said := " ".join(data.split())):
            self.strings.append(said)
            for held in (self.cell, self.link):
                if held is not None:
                    held.append(said)

    def close(self) -> None:
        super().close()
        self.end_cell()


def parts(html: str | None) -> Parts:
    parser = Parts()
    parser.feed(html or "")
    parser.close()
    return parser


def _lists(values: pa.Array, begins: list[np.ndarray], counts: list[int]) -> pa.ListArray:
    """Lists of ``values``, whose parts have ``counts`` values; ``begins`` of each part: where its lists begin."""
    firsts = np.cumsum([0, *counts])
    offsets = np.concatenate([*(np.asarray(b, dtype=np.int64) + first for b, first in zip(begins, firsts, strict=False)), firsts[-1:]])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def parts_as_arrow(found: list[Parts], columns: Sequence[str]) -> list[pa.Array]:
    """Of the columns strings, hrefs and rows of some pages those of ``columns``."""
    text = lambda name: pa.array([x for p in found for x in getattr(p, name)], pa.string())
    whole = lambda values, name: _lists(values, [np.zeros(1)] * len(found), [len(getattr(p, name)) for p in found])
    links = pa.StructArray.from_arrays([text("link_hrefs"), pa.array([" ".join(x) for p in found for x in p.link_texts], pa.string())], ["href", "text"])
    of_cells = _lists(links, [p.cell_begins for p in found], [len(p.link_hrefs) for p in found])
    cells = pa.StructArray.from_arrays([text("cells"), pa.array([x for p in found for x in p.heads], pa.bool_()), of_cells], ["text", "head", "links"])
    of_rows = _lists(cells, [p.row_begins for p in found], [len(p.cells) for p in found])
    tables = [pa.array([r[i] for p in found for r in p.rows], kind) for i, kind in enumerate((pa.int32(), pa.string(), pa.string()))]
    rows = pa.StructArray.from_arrays([*tables, of_rows], ["table_no", "own", "around", "cells"])
    return [whole(rows if c == "rows" else text(c), c) for c in columns]


#: A batch of parsed pages is handed on from so many characters of html: a large page is alone in its batch.
BATCH_CHARACTERS = 1 << 21


def page_parts(pages: DataFrame, html: str, columns: Sequence[str] = tuple(COLUMNS)) -> DataFrame:
    """The other columns of ``pages`` with strings, hrefs and rows, or some of these, in place of the html."""
    return with_parts(pages, html, parts, columns=columns)


def with_parts(pages: DataFrame, html: str, parse: Callable, captured: str = "", columns: Sequence[str] = tuple(COLUMNS)) -> DataFrame:
    """The other columns of ``pages`` with what ``parse`` gives of each page. It gives parts or, where there are columns
    ``captured`` (of strings), their values and parts. Pages go one by one: a task holds the parts of BATCH_CHARACTERS or a page."""
    kept, n = [c for c in pages.columns if c != html], len(captured.split(",")) if captured else 0

    names = [*kept, *(x.split()[0] for x in captured.split(",")[:n]), *columns]

    def made(batch: pa.RecordBatch, begin: int, held: list) -> pa.RecordBatch:
        said = [pa.array([x[i] for x in held], pa.string()) for i in range(n)]
        own = [batch.column(i).slice(begin, len(held)) for i in range(len(kept))]
        return pa.RecordBatch.from_arrays([*own, *said, *parts_as_arrow([x[n] for x in held] if n else held, columns)], names=names)

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            begin, held, size = 0, [], 0
            for at in range(batch.num_rows):
                page = batch.column(len(kept))[at].as_py()
                held.append(parse(page))
                size += len(page or "")
                if size >= BATCH_CHARACTERS or at + 1 == batch.num_rows:
                    out = made(batch, begin, held)
                    begin, held, size, page = at + 1, [], 0, None
                    yield out
                    out = None  # nothing of a long page stays while the next one is read

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema.fields if f.name != html), *([captured] if captured else []), *(f"{c} {COLUMNS[c]}" for c in columns)])
    return pages.select(*kept, html).mapInArrow(batches, schema)


def _names(row: Column, headers: dict[str, tuple[str, ...]], normalise) -> Column:
    """The canonical name of each cell of a row, null for others."""
    spelled = F.create_map(*[F.lit(x) for name, words in headers.items() for w in words for x in (w, name)])
    return F.transform(row["cells"], lambda c: F.try_element_at(spelled, normalise(c["text"])))


def _known(names: Column) -> Column:
    return F.size(F.array_distinct(F.filter(names, lambda n: n.isNotNull())))


def _of_table(chosen: Column) -> Column:
    """The rows of the table of that number; null if there is none."""
    return within(chosen, lambda t: F.when(t.isNotNull(), F.filter("rows", lambda r: r["table_no"] == t)))


def within(value: Column, then) -> Column:
    """``then`` of a value that is made once, however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _best_header(rows: Column, headers: dict[str, tuple[str, ...]], normalise) -> Column:
    """The names of the row that knows most of them, the first of equal ones; "" for cells without a name."""
    named = lambda n, i: F.struct(_known(n).alias("score"), (-i).alias("place"), F.transform(n, lambda x: F.coalesce(x, F.lit(""))).alias("names"))
    return F.array_max(F.transform(rows, lambda r, i: within(_names(r, headers, normalise), lambda n: named(n, i))))["names"]


def _cell(name: str, last: bool = False, data: Column | None = None) -> Column:
    """The data cell under a header; null where the row has none."""
    at, data = F.array_position("header", name), F.col("data") if data is None else data
    if last:
        at = F.when(at > 0, F.size("header") + 1 - F.array_position(F.reverse("header"), name)).otherwise(F.lit(0))
    return F.when((at > 0) & (at <= F.size(data)), F.get(data, (at - 1).cast("int")))


def _text(name: str, last: bool = False) -> Column:
    return text.clean_text(_cell(name, last)["text"])


def _data_rows(df: DataFrame) -> DataFrame:
    """A row a table row with td cells: row_no and data. Pages without rows are left to an outer explode: a condition on them
    would be pushed down, and the arrays be made twice."""
    out = df.select(*[c for c in df.columns if c != "rows"], F.posexplode_outer("rows").alias("row_no", "_row"))
    out = out.withColumn("data", F.filter(F.col("_row")["cells"], lambda c: ~c["head"]))
    return out.where(F.size("data") > 0).drop("_row")


def _horse_link(first_in: Column, data: Column | None = None) -> Column:
    """The first link to a horse in a cell, else in the row."""
    horses = lambda links: F.get(F.filter(links, lambda a: F.lower(a["href"]).contains("horse")), F.lit(0))
    return F.coalesce(horses(first_in["links"]), horses(F.flatten(F.transform("data" if data is None else data, lambda c: c["links"]))))


def absolute(href: Column, site: str) -> Column:
    """A link of a page of ``site`` (scheme and host) as a whole url."""
    return F.when(href.rlike("^[a-z]+://"), href).when(href.startswith("/"), F.concat(F.lit(site), href)).otherwise(F.concat(F.lit(site + "/"), href))


def race_numbers(df: DataFrame) -> DataFrame:
    """page parts with ``race_numbers``: those of texts "RACE n" and of links' RaceNo=n, distinct and sorted."""
    said = F.flatten(F.transform("strings", lambda s: F.slice(F.regexp_extract_all(s, F.lit(r"(?i)\bRACE\s+(\d+)\b"), 1), 1, 1)))
    linked = F.flatten(F.transform("hrefs", lambda h: F.slice(F.regexp_extract_all(h, F.lit(r"(?i)[?&]RaceNo=(\d+)"), 1), 1, 1)))
    return df.withColumn("race_numbers", F.array_sort(F.array_distinct(F.transform(F.concat(said, linked), lambda n: n.try_cast("int")))))


def label_of_cells(cells: Column, label: str) -> Column:
    """What follows "label:" in its own cell, else the next cell that isn't blank; "" if there is none."""
    mark = rf"(?i)\b{label}\s*:"
    at = F.array_position(F.transform(cells, lambda c: c.rlike(mark)), True)
    own = F.trim(F.regexp_replace(F.get(cells, (at - 1).cast("int")), mark, ""))
    after = F.get(F.filter(F.slice(cells, at.cast("int") + 1, F.greatest(F.size(cells), F.lit(1))), lambda c: c != ""), F.lit(0))
    return F.when(at > 0, F.coalesce(F.nullif(own, F.lit("")), after, F.lit(""))).otherwise(F.lit(""))


def race_header(df: DataFrame) -> DataFrame:
    """Page parts with the columns of the race's header table: race_number and race_index, class (the last said), distance (the
    first), rating band (the first), prize (the last), going, course, name and surface; each null or "" if it isn't said."""
    marked = lambda c: F.array_contains(F.split(c, r"\s+"), "race_tab")
    found = F.filter("rows", lambda r: marked(r["own"]) | marked(r["around"]))
    df = df.withColumn("_head", within(found, lambda rows: within(F.get(rows, F.lit(0))["table_no"], lambda t: F.filter(rows, lambda r: r["table_no"] == t))))
    df = df.withColumn("_lines", F.transform("_head", lambda r: F.transform(r["cells"], lambda c: text.clean_text(c["text"]))))
    df = df.withColumns({"_cells": F.flatten("_lines"), "_all": F.array_join(F.flatten("_lines"), " ")})
    each = lambda pattern, group=1: F.filter(F.transform("_cells", lambda c: F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))), lambda x: x.isNotNull())
    first, last = lambda a: F.get(a, F.lit(0)), lambda a: F.try_element_at(a, F.lit(-1))
    whole = lambda pattern, group=1: F.nullif(F.regexp_extract("_all", pattern, group), F.lit(""))
    number = r"(?i)\bRACE\s+(\d+)\s*\(\s*(\d+)\s*\)"
    kind, distance, band = r"(?i)\b(Class\s+\d+)\b", r"(?i)\b(\d{3,4})\s*M\b", r"\(\s*(\d+\s*-\s*\d+)\s*\)"
    labelled = lambda name: F.coalesce(last(F.filter(F.transform("_lines", lambda cells: label_of_cells(cells, name)), lambda x: x != "")), F.lit(""))
    plain = lambda c: (c != "") & ~c.rlike(r"(?i)\bClass\s+\d+") & ~c.rlike(r"(?i)\bRACE\s+\d+")
    until = lambda cells: F.slice(cells, 1, F.greatest(F.array_position(F.transform(cells, lambda c: c.rlike(r"(?i)\bCourse\s*:")), True).cast("int") - 1, F.lit(0)))
    named = F.flatten(F.transform("_lines", lambda cells: F.slice(F.filter(until(cells), plain), 1, 1)))
    prizes = F.filter(F.transform("_cells", text.parse_money), lambda x: x.isNotNull())
    course = labelled("Course")
    surface = F.when(F.upper(course).contains("TURF"), "TURF").when(F.upper(course).contains("ALL WEATHER") | F.upper(course).contains("AWT"), "ALL WEATHER TRACK").otherwise("")
    return df.withColumns({
        "race_number": whole(number).try_cast("int"), "race_index": whole(number, 2).try_cast("int"), "race_class": F.coalesce(F.initcap(last(each(kind))), F.initcap(whole(kind)), F.lit("")),
        "distance_m": F.coalesce(first(each(distance)), whole(distance)).try_cast("int"), "rating_band": F.coalesce(F.regexp_replace(first(each(band)), r"\s+", ""), F.lit("")),
        "prize_money_hkd": F.coalesce(last(prizes), text.parse_money(F.col("_all"))), "going": labelled("Going"), "course": course, "race_name": F.coalesce(last(named), F.lit("")), "surface": surface,
    }).drop("_head", "_lines", "_cells", "_all")


def with_runners(df: DataFrame) -> DataFrame:
    """Page parts with ``header``, the names of the columns of the result table, and ``runners``, its rows (row_no, data) with a
    horse's id or number. The table of class "performance", or the first inside an element of that class; five known headers
    and all core ones are needed. Both are null on a page without such a table."""
    marked = lambda c: F.array_contains(F.split(c, r"\s+"), "performance")
    ranked = F.transform(F.filter("rows", lambda r: marked(r["own"]) | marked(r["around"])), lambda r: F.struct((~marked(r["own"])).alias("inside"), r["table_no"].alias("table_no")))
    complete = lambda h: (_known(F.filter(h, lambda n: n != "")) >= 5) & (F.size(F.array_intersect(h, F.array(*map(F.lit, RESULT_CORE)))) == len(RESULT_CORE))
    df = df.withColumn("_table", _of_table(F.array_min(ranked)["table_no"]))
    df = df.withColumn("header", within(_best_header(F.col("_table"), RESULT_HEADERS, text.normalise_header), lambda h: F.when(complete(h), h)))
    data = F.transform("_table", lambda r, i: F.struct(i.alias("row_no"), F.filter(r["cells"], lambda c: ~c["head"]).alias("data")))

    def runs(data: Column) -> Column:
        horse = _horse_link(_cell("horse", data=data), data)
        number = text.parse_integer(text.clean_text(_cell("horse_number", data=data)["text"]))
        return (F.size(data) > 0) & ((F.coalesce(text.id_from_link(horse["href"]), F.lit("")) != "") | number.isNotNull())

    return df.withColumn("runners", F.when(F.col("header").isNotNull(), F.filter(data, lambda r: runs(r["data"])))).drop("_table")


def runner_rows(df: DataFrame, site: str) -> DataFrame:
    """The runners of pages (race_id, header, runners) as rows. The size is made before the explode: in one select with it, it would
    be made after, and every row would carry the whole field."""
    rows = df.select("race_id", "header", "runners", F.size("runners").alias("field_size"))
    rows = rows.select("race_id", "header", "field_size", F.explode_outer("runners").alias("_runner"))
    rows = rows.select("race_id", "header", "field_size", "_runner.row_no", "_runner.data").where("row_no is not null")
    rows = rows.withColumn("link", _horse_link(_cell("horse")))
    rows = rows.withColumns({"horse_id": F.coalesce(text.id_from_link(F.col("link")["href"]), F.lit("")), "horse_number": text.parse_integer(_text("horse_number"))})
    position = text.parse_integer(_text("finishing_position"))
    return rows.select(
        F.concat_ws("_", "race_id", F.coalesce(F.nullif("horse_id", F.lit("")), F.col("horse_number").cast("string"))).alias("result_id"), "race_id", "row_no",
        "field_size", "horse_id", "horse_number",
        F.coalesce(text.clean_text(F.col("link")["text"]), F.lit("")).alias("_linked"), _text("horse").alias("_shown"), position.alias("finishing_position"),
        F.coalesce(position == 1, F.lit(False)).alias("is_winner"), F.coalesce(position <= 3, F.lit(False)).alias("is_top_three"), _text("jockey").alias("jockey"), _text("trainer").alias("trainer"),
        text.parse_integer(_text("actual_weight")).alias("actual_weight"), text.parse_integer(_text("declared_horse_weight")).alias("declared_horse_weight"), text.parse_integer(_text("draw")).alias("draw"),
        _text("margin").alias("margin"), text.clean_finish_time(_text("finish_time")).alias("finish_time"), text.parse_float(_text("odds")).alias("odds"),
        F.when(F.col("link").isNotNull(), text.with_query_option(absolute(F.col("link")["href"], site))).otherwise("").alias("horse_profile_url"), F.col("link").isNotNull().alias("_has_link"),
    ).withColumn("horse_name", F.when(F.col("_has_link"), F.col("_linked")).otherwise(F.col("_shown"))).drop("_linked", "_shown", "_has_link")


def results(df: DataFrame, site: str) -> DataFrame:
    """Runner rows of result pages: page parts with race_id. A page is one race: its runners are the field."""
    return runner_rows(with_runners(df), site)


def header_rating(whole: Column) -> Column:
    """The last rating, else the current one."""
    said = lambda label: F.nullif(F.regexp_extract(whole, rf"(?i)\b{label}\s*:\s*(-?\d+)", 1), F.lit("")).try_cast("int")
    return F.coalesce(said("Last Rating"), said("Current Rating"))


def rating_history(df: DataFrame) -> DataFrame:
    """horse_id, race_date, race_index, race_class, horse_rating_before and _after of horses' pages (page parts with horse_id).
    The first table with the four headers; of equal (date, index) the last row counts; after the last race the rating is the
    one that the page's head says."""
    # the header row of a table is its best one, and the last of equal spellings is its column
    complete = lambda r: _known(_names(r, FORM_HEADERS, text.normalise_header)) == len(FORM_HEADERS)
    df = df.withColumn("rows", _of_table(F.get(F.filter("rows", complete), F.lit(0))["table_no"]))
    df = df.withColumns({"header": _best_header(F.col("rows"), FORM_HEADERS, text.normalise_header), "latest": header_rating(F.array_join("strings", " "))})
    rows = _data_rows(df.select("horse_id", "header", "latest", "rows"))
    rows = rows.select(
        "horse_id", "latest", "row_no", dates.parse_form_day(_text("date", True)).alias("race_date"), text.parse_integer(_text("race_index", True)).alias("race_index"),
        _text("race_class", True).alias("race_class"), text.parse_integer(_text("rating", True)).alias("horse_rating_before"),
    ).where("race_date is not null and race_index is not null")
    rows = rows.groupBy("horse_id", "race_date", "race_index").agg(F.max_by(F.struct("latest", "race_class", "horse_rating_before"), "row_no").alias("r")).select("horse_id", "race_date", "race_index", "r.*")
    w = Window.partitionBy("horse_id").orderBy("race_date", "race_index")
    after = F.when(F.lead(F.lit(1)).over(w).isNull(), F.col("latest")).otherwise(F.lead("horse_rating_before").over(w))
    return rows.withColumn("horse_rating_after", after).drop("latest")


def profile_value(whole: Column, label: str) -> Column:
    """What stands after "label :" up to the next other label; "" if the label isn't there."""
    quoted = lambda s: rf"\Q{s}\E"
    stop = "|".join(quoted(x) for x in sorted(PROFILE_LABELS, key=len, reverse=True) if x != label)
    return text.clean_text(F.regexp_extract(whole, rf"(?i){quoted(label)}\s*:\s*(.*?)(?=\s+(?:{stop})\s*:|$)", 1))


def profiles(df: DataFrame) -> DataFrame:
    """A row a profile page (page parts with horse_id). profile_scraped: one of the six useful fields is known."""
    df = df.withColumn("_all", text.clean_text(F.array_join("strings", " ")))
    heading = r"(?i)\b([A-Z][A-Z0-9 '&.\-]+?)\s+\(([A-Z]{1,3}\d{3})\)"
    value = lambda label: profile_value(F.col("_all"), label)
    origin_age = F.coalesce(F.nullif(value("Country of Origin / Age"), F.lit("")), value("Country of Origin"))
    colour_sex = value("Colour / Sex")
    name = text.clean_text(F.regexp_extract("_all", heading, 1))
    found = df.select(
        "horse_id", F.when(F.length(name) <= 80, name).otherwise("").alias("horse_name"), text.clean_text(F.regexp_extract("_all", heading, 2)).alias("brand_number"),
        text.split_first(origin_age, "/", 0).alias("country_of_origin"), text.parse_integer(text.split_first(origin_age, "/", 1)).alias("horse_age"),
        F.trim(F.regexp_replace(colour_sex, "/[^/]*$", "")).alias("horse_colour"), F.when(colour_sex.contains("/"), F.trim(F.element_at(F.split(colour_sex, "/"), -1))).otherwise("").alias("horse_sex"),
        value("Sire").alias("sire"), value("Dam").alias("dam"), value("Dam's Sire").alias("dam_sire"),
    )
    useful = F.lit(False)
    for c in ("country_of_origin", "horse_age", "horse_colour", "horse_sex", "sire", "dam"):
        useful = useful | (F.coalesce(F.col(c).cast("string"), F.lit("")) != "")
    hemisphere = F.when(F.col("country_of_origin") != "", dates.hemisphere(F.col("country_of_origin"))).otherwise("")
    return found.withColumns({"hemisphere_of_origin": hemisphere, "profile_scraped": useful})


def card_header(c: Column) -> Column:
    """As normalise_header, +/- as "vs"."""
    t = F.replace(F.replace(F.lower(text.clean_text(c)), F.lit("’"), F.lit("'")), F.lit("+/-"), F.lit(" vs "))
    t = F.replace(F.regexp_replace(t, "[+-]", " "), F.lit("&"), F.lit(" and "))
    return F.trim(F.regexp_replace(F.regexp_replace(t, "[^a-z0-9 ]+", " "), " +", " "))


def starters(df: DataFrame, site: str) -> DataFrame:
    """Starters of race cards (page parts with race_id): the first table with a row of all eleven headers by which a card is
    known, its rows after that one, numbers 1 to 30, with a link to a horse. Of a race's rows of one number, then of one horse,
    the one that says most stays, the first of equal ones."""
    texts = lambda r: F.transform(r["cells"], lambda c: card_header(c["text"]))
    maybe = lambda r: F.exists(r["cells"], lambda c: F.lower(c["text"]).contains("last"))  # noqa: E731  of "last 6 runs": spares most rows the patterns
    known = lambda r: F.when(maybe(r), F.size(F.array_intersect(texts(r), F.array(*map(F.lit, CARD_FINGERPRINT)))) == len(CARD_FINGERPRINT)).otherwise(F.lit(False))
    places = F.filter(F.transform("rows", lambda r, i: F.struct(i.alias("i"), known(r).alias("known"))), lambda p: p["known"])
    df = df.withColumn("_at", F.get(places, F.lit(0))["i"])
    names = F.transform(_names(F.get("rows", F.col("_at")), CARD_HEADERS, card_header), lambda n: F.coalesce(n, F.lit("")))
    after = within(F.col("_at"), lambda at: within(F.get("rows", at)["table_no"], lambda t: F.filter("rows", lambda r, i: (r["table_no"] == t) & (i > at))))
    df = df.withColumns({"header": names, "rows": F.when(F.col("_at").isNotNull(), after)})
    rows = _data_rows(df.select("race_id", "header", "rows")).withColumn("link", _horse_link(_cell("horse_name")))
    number = text.parse_int(_text("horse_number"))
    url = absolute(F.col("link")["href"], site)
    whole = {c: text.parse_int(_text(c)) for c in ("handicap_weight", "draw", "horse_rating", "declared_horse_weight", "days_since_last_run")}
    rows = rows.select("race_id", "row_no", number.alias("horse_number"), text.clean_text(F.col("link")["text"]).alias("horse_name"), _text("jockey").alias("jockey"), _text("trainer").alias("trainer"),
                       F.coalesce(text.id_from_url(url), F.lit("")).alias("horse_id"), url.alias("horse_profile_url"), *[c.alias(n) for n, c in whole.items()])
    rows = rows.where("horse_number between 1 and 30 and horse_id <> '' and horse_name <> ''")
    return best_records(rows, ["race_id"], "horse_number", "horse_id", [c for c in rows.columns if c not in ("race_id", "row_no")], "row_no").withColumn("runner_id", F.concat(F.col("race_id"), F.lit("_"), F.lpad(F.col("horse_number").cast("string"), 2, "0"))).drop("row_no")


def best_records(df: DataFrame, group: list[str], first: str, second: str, scored: list[str], order: str) -> DataFrame:
    """Of each group's rows of one value of ``first`` the one with most of the columns ``scored`` filled, the earliest of
    equal ones; then the same by ``second``. Rows without a value of the key of a pass stay in that pass."""
    for key in (first, second):
        score = text.completeness([F.col(c) for c in scored])
        w = Window.partitionBy(*group, key).orderBy(score.desc(), F.col(order).asc())
        blank = F.coalesce(F.col(key).cast("string"), F.lit("")) == ""
        df = df.withColumns({"_n": F.row_number().over(w), "_blank": blank}).where("_blank or _n = 1").drop("_n", "_blank")
    return df


def card_places(df: DataFrame, ties: list[str]) -> DataFrame:
    """Adds ``place`` (0, 1, ...) in the order of cards: course, race and horse number, unknown numbers and 0 last, then ``ties``."""
    from tidemark.operators.scans import in_order

    last = lambda c: F.coalesce(F.nullif(c, F.lit(0)), F.lit(999))
    keys = {"_known": F.col("racecourse_code").isNotNull(), "_race": last("race_number"), "_horse": last("horse_number")}
    return in_order(df.withColumns(keys), ["_known", "racecourse_code", "_race", "_horse", *ties], "place").drop(*keys)


def with_profiles(runners: DataFrame, found: DataFrame, columns: list[str]) -> DataFrame:
    """Runners with the columns of their horses' profiles; those without a profile keep what they have."""
    from tidemark.operators.tables import lookup

    return lookup(runners, found, ["horse_id"], {c: c for c in columns})


def venue(link: Column, said: Column) -> Column:
    """HV or ST: the course code of the link, else the course that the text names, Sha Tin first; null if neither does."""
    code = F.upper(F.nullif(F.regexp_extract(link, r"(?i)[?&]racecourse=(ST|HV)\b", 1), F.lit("")))
    t = F.upper(said)
    return F.coalesce(code, F.when(t.contains("SHA TIN"), "ST").when(t.contains("HAPPY VALLEY"), "HV"))


def race_status(df: DataFrame, requested: Column, prize: Column, n_results: Column) -> DataFrame:
    """``status`` of each race page: REQUEST_FAILED, SKIP_ZERO_PRIZE, SKIP_NO_RESULTS or OK."""
    out = F.when(~requested, "REQUEST_FAILED").when(prize == 0, "SKIP_ZERO_PRIZE").when(F.coalesce(n_results, F.lit(0)) == 0, "SKIP_NO_RESULTS").otherwise("OK")
    return df.withColumn("status", out)


def card_race(df: DataFrame) -> DataFrame:
    """Page parts with the header of a race card: the first text "Race n - NAME" and the twenty texts from there on, or all
    texts if there is none; of several texts that say the same thing the last counts."""
    heading = r"(?i)^Race\s+(\d+)\s*-\s*(.+)$"
    at = F.array_position(F.transform("strings", lambda s: s.rlike(heading)), True).cast("int")
    head = F.when(at > 0, F.get("strings", at - 1))
    df = df.withColumns({"_head": head, "_near": F.when(at > 0, F.slice("strings", F.greatest(at, F.lit(1)), 20)).otherwise(F.col("strings"))})
    last = lambda keep, value: F.try_element_at(F.transform(F.filter("_near", keep), value), F.lit(-1))
    found = lambda pattern: lambda s: F.regexp_extract(s, pattern, 1)
    clock, metres = r"\b(\d{1,2}:\d{2})\b", r"(?i)\b(\d{3,4})\s*M\b"
    place = lambda s: (s.contains("Sha Tin") | s.contains("Happy Valley")) & s.rlike(clock)
    going = lambda s: s.rlike(metres) & (s.contains("Turf") | s.contains("All Weather") | s.contains("AWT"))
    prize = lambda s: s.contains("Prize Money")
    marks = '["“”]'
    course = F.regexp_replace(F.trim(last(lambda s: going(s) & s.rlike(r"(?i)[^,\"”]+[\"”]?\s+Course"), found(r"(?i)[\"“]?([^,\"”]+)[\"”]?\s+Course"))), f"^{marks}+|{marks}+$", "")
    whole = F.array_join("_near", " ")
    or_whole = lambda rule: F.coalesce(F.nullif(last(prize, rule), F.lit("")), rule(whole), F.lit(""))
    said = lambda c: F.coalesce(c, F.lit(""))
    return df.withColumns({
        "race_number": F.nullif(F.regexp_extract("_head", heading, 1), F.lit("")).try_cast("int"), "race_name": said(text.clean_text(F.regexp_extract("_head", heading, 2))),
        "race_time": said(last(place, found(clock))), "racecourse_name": last(place, lambda s: F.when(s.contains("Sha Tin"), "Sha Tin").otherwise("Happy Valley")),
        "surface": said(F.trim(F.get(F.split(last(going, lambda s: s), ","), F.lit(0)))), "course": said(course), "distance_m": last(going, found(metres)).try_cast("int"),
        "going": said(F.trim(last(lambda s: going(s) & s.contains(","), lambda s: F.element_at(F.split(s, ","), -1)))), "prize_money_hkd": last(prize, text.parse_money),
        "rating_band": or_whole(text.rating_band), "race_class": or_whole(text.race_class_code),
    }).drop("_head", "_near")


def runner_profiles(df: DataFrame) -> DataFrame:
    """horse_id, horse_age, horse_sex, season and total stakes, sire and dam of profile pages (page parts with horse_id), each
    between its own label and the one after it."""
    df = df.withColumn("_all", text.clean_text(F.array_join("strings", " ")))
    between = lambda start, stop: text.clean_text(F.regexp_extract("_all", rf"(?i){start}\s*:\s*(.*?)\s+{stop}\s*:", 1))
    stakes = lambda label: text.parse_money(F.regexp_extract("_all", rf"(?i){label}\*?\s*:\s*((?:HK\s*)?\$\s*[\d,]+)", 1))
    sex = between(r"Colour\s*/\s*Sex", "Import Type")
    age = F.nullif(F.regexp_extract(between(r"Country of Origin\s*/\s*Age", r"Colour\s*/\s*Sex"), r"/\s*(\d+)\s*$", 1), F.lit(""))
    return df.select(
        "horse_id", age.try_cast("int").alias("horse_age"), text.split_last(sex, "/", 1).alias("horse_sex"), stakes("Season Stakes").alias("season_stakes_hkd"),
        stakes("Total Stakes").alias("total_stakes_hkd"), between(r"\bSire", "Dam").alias("sire"), between(r"\bDam", "Dam['’]s Sire").alias("dam"),
    )
