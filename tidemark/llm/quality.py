"""Line-first quality rules: lines that fail are removed, and documents that lose too much that way are rejected.

A text is cut at line feeds. Each line is judged by itself, with the white space at its ends taken off. A line fails

* navigation, if it holds two or more separators that stand alone and they are more than a fifth of its words, or if it has
  at most NAV_WORDS words and no sentence mark at its end;
* punctuation, if runs of symbols or of repeated ! and ? are more than a fifth of its words, or if it has fewer than
  SHORT_LINE words and no sentence mark;
* boilerplate, if it has at most BOILER_WORDS words and holds one of BOILERPLATE.

Rejected is a document of whose code points in words more than MOST_LOST percent stand in failed lines, and one that fails
the base rules on the text as it came: fewer than LEAST_WORDS words, or more than MOST_REPEATED percent of the words inside
three-word windows found twice or more.

Words are runs of anything but ASCII white space. Null text: no words, rejected; empty text and white space the same.
Repeated rows get a row each; rows without an id keep a null one; an empty table gives no rows. Other columns are ignored,
whatever their names. A row needs nothing of another one, so nothing is shuffled; a task holds a batch of texts and what
one text's words take, about 100 bytes a word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_text

LEAST_WORDS, MOST_REPEATED, MOST_LOST = 50, 50, 30
SHORT_LINE, NAV_WORDS, BOILER_WORDS = 8, 3, 25

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Marks that end or part sentences, in several scripts, and what may close after them.
SENTENCE_MARK = r"[.!?…。！？؟।;:]"
SENTENCE_END = SENTENCE_MARK + r"[\"'”’»)\]]*$"
#: Symbols in a run, or marks repeated as in shouting.
NOISE = r"[#*$%&|<>=~^_{}\\]{2,}|[!?]{2,}"
SEPARATOR = r"[|/\\>»›·•→*-]+"
#: Phrases of page furniture.
BOILERPLATE = (
    "all rights reserved", "privacy policy", "cookie policy", "use of cookies", "terms of use", "terms of service", "terms and conditions",
    "lorem ipsum", "enable javascript", "javascript is disabled", "click here", "read more", "skip to content", "back to top",
    "sign up for", "subscribe to", "log in to", "share this", "follow us", "powered by",
)
BOILER = "(?i)" + "|".join(BOILERPLATE)

_MARK, _END, _NOISE, _SEPARATOR, _BOILER = (re.compile(x) for x in (SENTENCE_MARK, SENTENCE_END, NOISE, SEPARATOR, BOILER))

FIGURES = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long", "lost_chars": "long"}


def words_of(text: str) -> list[bytes]:
    return text.encode().split()  # bytes are split at ASCII white space only


def chars_in_words(text: str) -> int:
    return len(text) - sum(map(text.count, SPACE))


def repeated_words(words: list[bytes]) -> int:
    """How many words stand in three-word windows that occur twice or more."""
    if len(words) < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    pairs = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)[1]
    _, which, times = np.unique(pairs[:-1] * len(known) + ids[2:], return_inverse=True, return_counts=True)
    again, covered = times[which] > 1, np.zeros(len(words), bool)
    for at in range(3):
        covered[at : at + len(again)] |= again
    return int(covered.sum())


def fault(line: str) -> str | None:
    """The first rule that a line without white space at its ends fails."""
    words = line.encode().split()
    n = len(words)
    if _SEPARATOR.search(line):
        alone = sum(_SEPARATOR.fullmatch(w.decode()) is not None for w in words)
        if alone >= 2 and 5 * alone > n:
            return "navigation"
    if n <= NAV_WORDS and not _END.search(line):
        return "navigation"
    if 5 * len(_NOISE.findall(line)) > n or n < SHORT_LINE and not _MARK.search(line):
        return "punctuation"
    return "boilerplate" if n <= BOILER_WORDS and _BOILER.search(line) else None


def judged(text: str) -> tuple[list[str], dict[str, int]]:
    """The lines that stay, as they came, and a text's figures."""
    words = words_of(text)
    left, lost, seen, again = [], 0, set(), 0
    for line in text.split("\n"):
        bare = line.strip(SPACE)
        if bare:
            again += line in seen
            seen.add(line)
            if fault(bare) is not None:
                lost += chars_in_words(line)
                continue
        left.append(line)
    figures = (len(words), chars_in_words(text), sum(map(text.count, SYMBOLS)), again, repeated_words(words), lost)
    return left, dict(zip(FIGURES, figures, strict=True))


def judge(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """doc_id, the figures, base_failed, kept; with ``keep_text`` also ``cleaned``, the text without its failed lines."""
    schema = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in FIGURES], *([("cleaned", pa.string())] if keep_text else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, list] = {c: [] for c in schema.names[1:]}
            for text in batch.column("text"):
                left, figures = judged(text.as_py())
                for c, x in figures.items():
                    found[c].append(x)
                if keep_text:
                    found["cleaned"].append("\n".join(left))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(found[c], schema.field(c).type) for c in schema.names[1:]]], schema=schema)

    names = ", ".join(["doc_id long", *[f"{c} {t}" for c, t in FIGURES.items()], *(["cleaned string"] if keep_text else [])])
    out = id_text(docs).mapInArrow(run, names)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    loses = 100 * F.col("lost_chars") > MOST_LOST * F.col("word_chars")
    return out.withColumns({"base_failed": failed, "kept": ~failed & ~loses}).select("doc_id", *FIGURES, "base_failed", "kept", *(["cleaned"] if keep_text else []))


def clean(docs: DataFrame) -> DataFrame:
    """doc_id and text of the documents that are kept, without their failed lines."""
    return judge(docs, keep_text=True).where("kept").select("doc_id", F.col("cleaned").alias("text"))
