"""Column functions on free text: normal forms, tokens, phrases, windows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes and limits that decide what matches.
WORD = "[a-z0-9+/-]+"
TRIAGE_TOKEN = "[a-z][a-z0-9+/-]{2,}"
PRESCREEN_TOKEN = "[a-z][a-z0-9-]{2,}"
SPACES = r"(?U)\s+"
SENTENCE_GAP = r"(?U)(?<=[.!?])\s+"
HEADING_CHARS = 120
LOCATOR_CHARS = 80
CHUNK_CHARS = 800


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(" \t\n\r\x0b\x0c"))


def is_blank(c: Column) -> Column:
    return c.isNull() | (strip(c) == "")


def text_of(c: Column) -> Column:
    """Null is missing text."""
    return F.coalesce(c, F.lit(""))


def squash(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, SPACES, " "))


def squash_all(df):
    """``squash`` on every string column of a table."""
    return df.select(*[squash(F.col(f"`{n}`")).alias(n) if t == "string" else F.col(f"`{n}`") for n, t in df.dtypes])


def norm_venue(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))


def compact_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def without(arr: Column, stop: Sequence[str]) -> Column:
    """Drop stopwords, keeping order and repeats."""
    return F.filter(arr, lambda x: ~x.isin(list(stop))) if stop else arr


def tokens(c: Column, stop: Sequence[str] = (), pattern: str = TRIAGE_TOKEN) -> Column:
    return without(F.regexp_extract_all(F.lower(text_of(c)), F.lit(pattern), 0), stop)


def words(c: Column) -> Column:
    """Distinct whole words in the class single-word terms are matched in."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text_of(c)), F.lit(WORD), 0))


def token_set(c: Column, stop: Sequence[str] = ()) -> Column:
    parts = F.filter(F.split(norm_venue(text_of(c)), " "), lambda x: F.length(x) > 2)
    return F.array_distinct(without(parts, stop))


def declared_terms(c: Column, stop: Sequence[str] = ()) -> Column:
    """Terms of a comma, semicolon, pipe or line separated list; a part of
    several words also yields the words in it that look like identifiers."""

    def part_terms(part: Column) -> Column:
        kept = without(
            F.filter(F.split(F.regexp_replace(F.lower(part), "[^a-z0-9+/-]+", " "), " "), lambda x: x != ""), stop
        )
        found = F.regexp_extract_all(part, F.lit("[A-Za-z][A-Za-z0-9+/-]+"), 0)
        ids = F.filter(found, lambda x: x.rlike("[A-Z]{2,}|[0-9]|[-+/]"))
        atoms = without(F.transform(ids, F.lower), stop)
        return (
            F.when(F.size(kept) == 0, F.array().cast("array<string>"))
            .when(F.size(kept) == 1, kept)
            .otherwise(F.concat(F.array(F.array_join(kept, " ")), atoms))
        )

    parts = F.split(text_of(c), "[,;\n|]+")
    return F.array_sort(F.array_distinct(F.flatten(F.transform(parts, part_terms))))


def feedback_phrases(c: Column, stop: Sequence[str] = ()) -> Column:
    """Cleaned phrases of a feedback cell, first order kept, repeats dropped."""

    def clean(part: Column) -> Column:
        plain = F.regexp_replace(F.regexp_replace(part, r"\([^)]*\)", " "), "[^A-Za-z0-9:/+_. -]+", " ")
        return F.lower(F.regexp_replace(squash(plain), "^[ .,:;-]+|[ .,:;-]+$", ""))

    parts = F.transform(F.split(text_of(c), "[;\n|]+"), clean)
    return F.array_distinct(without(F.filter(parts, lambda x: F.length(x) >= 3), stop))


def windows(title: Column, text: Column) -> Column:
    """The title, then the sentences of the text; lower case, squashed."""
    head = F.when(F.length(text_of(title)) > 0, F.array(F.lower(title))).otherwise(F.array().cast("array<string>"))
    body = F.transform(F.split(text_of(text), SENTENCE_GAP), lambda s: F.lower(squash(s)))
    return F.concat(head, F.filter(body, lambda s: s != ""))


def line_windows(text: Column) -> Column:
    """Non-blank lines as structs (heading, line); a short line that does not
    end like a sentence is a heading."""
    lines = F.filter(F.transform(F.split(text_of(text), r"\R|[\x1c-\x1e]"), squash), lambda x: x != "")
    return F.transform(
        lines,
        lambda x: F.struct(
            F.when((F.length(x) <= HEADING_CHARS) & ~x.endswith("."), F.substring(x, 1, LOCATOR_CHARS)).alias("heading"),
            x.alias("line"),
        ),
    )


def sentences_or_chunks(line: Column) -> Column:
    """Sentences of one line; a single sentence over 800 characters is cut in
    pieces of 800."""
    parts = F.split(line, SENTENCE_GAP)
    pieces = F.transform(
        F.sequence(F.lit(0), F.greatest(F.length(line) - 1, F.lit(0)), F.lit(CHUNK_CHARS)),
        lambda i: F.substring(line, i + 1, F.lit(CHUNK_CHARS)),
    )
    return F.when((F.size(parts) == 1) & (F.length(line) > CHUNK_CHARS), pieces).otherwise(parts)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often it is named."""
    return F.get(F.transform(F.array(value), body), 0)


def _headings(lines: Column) -> Column:
    """(first line, heading) of each stretch of lines under one heading."""
    own = F.transform(lines, lambda x, i: F.struct(i.alias("at"), x["heading"].alias("heading")))
    first = F.array(F.struct(F.lit(0).alias("at"), F.lit("full text").alias("heading")))
    return F.concat(first, F.filter(own, lambda m: m["heading"].isNotNull()))


def _under(lines: Column, marks: Column) -> Column:
    """Per line its sentences with the last heading seen."""

    def stretch(m: Column, i: Column) -> Column:
        end = F.coalesce(F.get(marks, i + 1)["at"], F.size(lines))
        return F.array_repeat(m["heading"], end - m["at"])

    def cut(h: Column, line: Column) -> Column:
        parts = F.filter(sentences_or_chunks(line["line"]), lambda s: s != "")
        return F.transform(parts, lambda s: F.struct(h.alias("locator"), s.alias("window")))

    return F.zip_with(F.flatten(F.transform(marks, stretch)), lines, cut)


def evidence_windows(title: Column, text: Column) -> Column:
    """Array of (locator, window) over title and lines; the locator is the
    last heading seen."""
    head = F.when(
        F.length(text_of(title)) > 0,
        F.array(F.struct(F.lit("title").alias("locator"), F.lower(title).alias("window"))),
    ).otherwise(F.array().cast("array<struct<locator:string,window:string>>"))
    body = bound(line_windows(text), lambda lines: bound(_headings(lines), lambda marks: _under(lines, marks)))
    return F.concat(head, F.flatten(body))


def has_chunk(text: Column) -> Column:
    """True when some line of the text is cut into pieces by length."""
    return F.exists(
        line_windows(text),
        lambda x: (F.length(x["line"]) > CHUNK_CHARS) & (F.size(F.split(x["line"], SENTENCE_GAP)) == 1),
    )
