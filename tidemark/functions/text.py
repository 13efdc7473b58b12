"""Scalar text rules as Column expressions. Null in, null out, unless said otherwise; nothing raises."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _first(c: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def clean_text(c: Column) -> Column:
    """Null becomes "", runs of Unicode white space one space, ends trimmed."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))


def parse_integer(c: Column) -> Column:
    """The first run of digits, with its sign; commas end it, so "1,067" is 1."""
    return _first(c, r"(-?\d+)").try_cast("int")


def parse_int(c: Column) -> Column:
    """As parse_integer after commas are taken out, so "1,067" is 1067."""
    return parse_integer(F.replace(c, F.lit(","), F.lit("")))


def parse_float(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit("")).try_cast("double")


def parse_money(c: Column) -> Column:
    """The first amount after a dollar sign, with or without HK before it."""
    return F.replace(_first(c, r"(?i)(?:HK\s*)?\$\s*([\d,]+)"), F.lit(","), F.lit("")).try_cast("bigint")


def id_from_link(c: Column, key: str = "horseid") -> Column:
    """A query parameter as it stands in a link, its name in any case."""
    return _first(c, rf"(?i)[?&]{key}=([^&]+)")


def id_from_url(c: Column, key: str = "horseid") -> Column:
    """As id_from_link, URL-decoded and without a fragment."""
    return F.url_decode(_first(c, rf"(?i)[?&]{key}=([^&#]+)"))


def with_query_option(c: Column, name: str = "Option", value: str = "1") -> Column:
    """The url with ``name=value`` as its last parameter, in place of any parameter of that name; the fragment stays."""
    base, fragment = F.regexp_extract(c, r"^([^?#]*)", 1), F.regexp_extract(c, r"(#.*)$", 1)
    kept = F.filter(F.split(F.regexp_extract(c, r"\?([^#]*)", 1), "&"), lambda p: (p != "") & ~F.lower(p).rlike(rf"^{name.lower()}(=|$)"))
    return F.concat(base, F.lit("?"), F.array_join(F.concat(kept, F.array(F.lit(f"{name}={value}"))), "&"), fragment)


def clean_finish_time(c: Column) -> Column:
    """Blank and all-zero times are null."""
    t = clean_text(c)
    return F.when((t != "") & ~t.rlike(r"^0+(?:[:.]0+)+$"), t)


def normalise_header(c: Column) -> Column:
    """Lower case, & as "and", letters and digits only, single spaces."""
    t = F.replace(F.lower(clean_text(c)), F.lit("&"), F.lit(" and "))
    return F.trim(F.regexp_replace(F.regexp_replace(t, "[^a-z0-9 ]+", " "), " +", " "))


def label_value(text: Column, label: str, labels: tuple[str, ...]) -> Column:
    """What stands after "label:" up to the next of ``labels``."""
    others = "|".join(sorted((x for x in labels if x != label), key=len, reverse=True))
    stop = rf"(?=\s*(?:{others})\s*:|$)" if others else "$"
    return F.nullif(F.trim(F.regexp_extract(text, rf"(?is)\b{label}\s*:\s*(.*?){stop}", 1)), F.lit(""))


def margin_lengths(c: Column) -> Column:
    """Winning margin in lengths: names of short margins, whole numbers, fractions, and whole-fraction forms."""
    t = F.regexp_replace(F.upper(F.trim(c)), r"^\+", "")
    whole, top, bottom = (F.regexp_extract(t, r"^(?:(\d+)-)?(\d+)/(\d+)$", i) for i in (1, 2, 3))
    fraction = F.coalesce(whole.try_cast("double"), F.lit(0.0)) + F.try_divide(top.try_cast("double"), bottom.try_cast("double"))
    named = F.when(t == "DH", 0.0).when(t.isin("N", "NOSE"), 0.05).when(t == "SH", 0.1).when(t == "HD", 0.2).when(t.isin("NK", "NECK"), 0.25)
    number = F.when(t.rlike(r"^\d+(\.\d+)?$"), t.try_cast("double"))
    return F.when(t.isin("", "---", "ML", "TO"), F.lit(None).cast("double")).otherwise(F.coalesce(named, F.when(t.rlike(r"^(?:\d+-)?\d+/\d+$"), fraction), number))


def finish_seconds(c: Column) -> Column:
    """[minutes:]seconds[.fraction] as seconds; any other form is null."""
    t = F.trim(c)
    form = r"^(?:(\d+):)?(\d{1,2}(?:\.\d+)?)$"
    minutes = F.coalesce(F.regexp_extract(t, form, 1).try_cast("double"), F.lit(0.0))
    return F.when(t.rlike(form), minutes * 60 + F.regexp_extract(t, form, 2).try_cast("double"))


def class_number(c: Column) -> Column:
    """Bare 1 to 5 only."""
    t = F.trim(c)
    return F.when(t.rlike("^[1-5]$"), t.try_cast("double"))


def text_flag(c: Column) -> Column:
    """1, 0 or null of a text boolean."""
    t = F.lower(F.trim(c.cast("string")))
    return F.when(t.isin("true", "1", "yes", "y"), 1).when(t.isin("false", "0", "no", "n"), 0)


def is_scraped(c: Column) -> Column:
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin("true", "1", "yes"), F.lit(False))


def race_class_code(c: Column) -> Column:
    """Class n as Cn, groups as G1 to G3, listed as L, griffin as GRIFFIN, else ""."""
    t = F.upper(clean_text(c))
    out = F.when(t.rlike(r"\bCLASS\s*[1-5]\b"), F.concat(F.lit("C"), F.regexp_extract(t, r"\bCLASS\s*([1-5])\b", 1)))
    for n, word in ((1, "ONE"), (2, "TWO"), (3, "THREE")):
        out = out.when(t.rlike(rf"\bGROUP\s*(?:{n}|{word})\b"), f"G{n}")
    return out.when(t.rlike(r"\bLISTED\b"), "L").when(t.rlike(r"\bGRIFFIN\b"), "GRIFFIN").otherwise("")


def rating_band(c: Column) -> Column:
    """a-b after "Rating:", else after "Rating", else as a whole part between commas; spaces out."""
    t = clean_text(c)
    part = F.get(F.filter(F.split(t, ","), lambda p: F.trim(p).rlike(r"^\d+\s*-\s*\d+$")), F.lit(0))
    found = F.coalesce(_first(t, r"(?i)rating\s*:\s*(\d+\s*-\s*\d+)"), _first(t, r"(?i)rating\s+(\d+\s*-\s*\d+)"), part)
    return F.regexp_replace(found, r"\s+", "")


def race_key(code: Column, day: Column, number: Column) -> Column:
    """CODE_yyyymmdd_Rnn."""
    return F.concat(code, F.lit("_"), F.date_format(day, "yyyyMMdd"), F.lit("_R"), F.lpad(number.cast("string"), 2, "0"))


def rating_key(*parts: Column) -> Column:
    """The parts joined by |, null if one is null or blank."""
    whole = F.lit(True)
    for p in parts:
        whole = whole & (F.trim(p.cast("string")) != "")
    return F.when(whole, F.concat_ws("|", *(F.trim(p.cast("string")) for p in parts)))


def split_first(c: Column, mark: str, part: int) -> Column:
    """The part before (0) or after (1) the first mark, trimmed."""
    return F.trim(F.get(F.split(c, mark, 2), F.lit(part)))


def split_last(c: Column, mark: str, part: int) -> Column:
    """The part before (0) or after (1) the last mark, trimmed; without a mark the whole for either."""
    at = F.length(c) - F.locate(mark, F.reverse(c)) + 1
    return F.when(~c.contains(mark), F.trim(c)).otherwise(F.trim(F.substring(c, F.lit(1), at - 1) if part == 0 else F.substring(c, at + 1, F.length(c))))


def race_url(site: str, day: Column, code: Column, number: Column) -> Column:
    """The result page of a race."""
    return F.concat(F.lit(f"{site}?RaceDate="), F.date_format(day, "yyyy/MM/dd"), F.lit("&Racecourse="), code, F.lit("&RaceNo="), number.cast("string"))


def horse_url(site: str, horse_id: Column) -> Column:
    """The profile page of a horse."""
    return F.concat(F.lit(f"{site}?HorseId="), horse_id, F.lit("&Option=1"))


def name_and_brand(c: Column) -> tuple[Column, Column]:
    """NAME (A123)."""
    form = r"^(.{1,80}?)\s*\(([A-Z]\d{3})\)"
    return _first(c, form, 1), _first(c, form, 2)


def completeness(columns: list[Column]) -> Column:
    """How many of the columns hold more than "", "None" or "nan"."""
    filled = [F.when(F.coalesce(c.cast("string"), F.lit("")).isin("", "None", "nan"), 0).otherwise(1) for c in columns]
    return sum(filled[1:], filled[0])


def form_string(latest_first: list[Column]) -> Column:
    """Positions joined by -, nulls left out; whole ones without decimals."""
    shown = lambda x: F.when(x == F.floor(x), x.cast("bigint").cast("string")).otherwise(x.cast("double").cast("string"))
    return F.array_join(F.transform(F.filter(F.array(*latest_first), lambda x: x.isNotNull()), shown), "-")
