"""Article markup to columns.

Payloads go through an event parser that never builds a tree: text between two
tags is a node, and whatever a rule asks for (body, title, headings, paragraphs)
is a span of nodes, opened and closed by the tags. Nodes and spans leave the
parser as arrays; joining, collapsing and judging them is done by column
functions. What has no nesting is read by the built-in XML functions.
"""

from __future__ import annotations

import sys
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import _parse_datatype_string

from screenline.functions.fields import join_clean, year_of
from screenline.functions.text import squash, strip, text_of

# Ship the helpers with the job: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Shortest usable body, smallest cached parser file.
MIN_BODY_CHARS = 1000
MIN_CACHED_BYTES = 500
# Element names of the two article formats (section, heading, title).
FORMATS = {"jats": ("sec", "title", "article-title"), "tei": ("div", "head", "title")}

# Payload bytes whose spans are held at a time.
PARSED_BYTES = 1 << 20

SPAN = "struct<first:int,size:int>"
ARTICLE = f"struct<read:boolean,nodes:array<string>,body:{SPAN},title:{SPAN},sections:array<struct<head:{SPAN},parts:array<{SPAN}>>>>"
RECORDS = f"struct<nodes:array<string>,records:array<struct<fields:array<struct<name:string,owner:int,label:string,span:{SPAN}>>>>>"


class _Events:
    """Takes a parser's events. ``opened`` names the spans that begin with an
    element; they end with it."""

    def __init__(self):
        self.nodes: list[str] = []
        self._text: list[str] = []
        self._open: list[list[dict]] = []

    def data(self, text: str) -> None:
        self._text.append(text)

    def _settle(self) -> None:
        if self._text:
            self.nodes.append("".join(self._text))
            self._text.clear()

    def span(self) -> dict:
        return {"first": len(self.nodes), "size": None}

    def start(self, tag: str, attributes: dict[str, str]) -> None:
        self._settle()
        self._open.append(self.opened(tag.rpartition("}")[2], attributes))

    def end(self, tag: str) -> None:
        self._settle()
        for span in self._open.pop():
            span["size"] = len(self.nodes) - span["first"]
        self.closed()

    def opened(self, name: str, attributes: dict[str, str]) -> list[dict]:
        raise NotImplementedError

    def closed(self) -> None:
        raise NotImplementedError


class _Article(_Events):
    """Body, title, and each section's heading and own paragraphs, sections in
    the order in which they begin."""

    def __init__(self, section: str, heading: str, title: str):
        super().__init__()
        self.names = (section, heading, title)
        self.body = self.title = None
        self.sections: list[dict] = []
        # The section an open element is, if it is one.
        self._inside: list[dict | None] = [None]

    def opened(self, name, attributes):
        section, heading, title = self.names
        spans, holder, own = [], self._inside[-1], None
        if name == title and self.title is None:
            self.title = self.span()
            spans.append(self.title)
        if holder is not None and name == heading and holder["head"] is None:
            holder["head"] = self.span()
            spans.append(holder["head"])
        if holder is not None and name == "p":
            holder["parts"].append(self.span())
            spans.append(holder["parts"][-1])
        # A body is open until its span has a size.
        if name == section and self.body is not None and self.body["size"] is None:
            own = {"head": None, "parts": []}
            self.sections.append(own)
        if name == "body" and self.body is None:
            self.body = self.span()
            spans.append(self.body)
        self._inside.append(own)
        return spans

    def closed(self):
        self._inside.pop()

    def found(self) -> dict:
        return {"read": True, "nodes": self.nodes, "body": self.body, "title": self.title, "sections": self.sections}


class _Records(_Events):
    """Wanted fields of every record element: name (the path's last element),
    number of the element that holds it, its label."""

    def __init__(self, record: str, wanted: tuple[tuple[str, ...], ...]):
        super().__init__()
        self.record, self.wanted = record, wanted
        self.records: list[dict] = []
        self._path: list[tuple[str, int]] = []
        self._number = 0

    def opened(self, name, attributes):
        self._number += 1
        self._path.append((name, self._number))
        names = tuple(n for n, _ in self._path)
        if name == self.record:
            self.records.append({"fields": []})
        if self.record not in names or not any(names[-len(w) :] == w for w in self.wanted):
            return []
        span = self.span()
        field = {"name": name, "owner": self._path[-2][1], "label": attributes.get("Label"), "span": span}
        self.records[-1]["fields"].append(field)
        return [span]

    def closed(self):
        self._path.pop()

    def found(self) -> dict:
        return {"nodes": self.nodes, "records": self.records}


def _parsed(payload: str | None, target: _Events, failed: dict) -> dict:
    parser = ET.XMLParser(target=target)
    try:
        parser.feed(payload or "")
        parser.close()
    except (ET.ParseError, ValueError):
        return failed
    return target.found()


def _events_of(xml: Column, schema: str, target: Callable[[], _Events], failed: dict) -> Column:
    """What the target finds in each payload; spans of at most about
    ``PARSED_BYTES`` of payloads are held at a time."""
    kind = to_arrow_type(_parse_datatype_string(schema))

    @F.arrow_udf(schema)
    def read(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            sizes = pc.cumulative_sum(pc.fill_null(pc.binary_length(column), 0).cast(pa.int64())).to_pylist()
            at = 0
            while at < len(column):
                base, upto = sizes[at - 1] if at else 0, at + 1
                while upto < len(column) and sizes[upto] - base <= PARSED_BYTES:
                    upto += 1
                yield pa.array([_parsed(p.as_py(), target(), failed) for p in column[at:upto]], kind)
                at = upto

    return read(xml)


def _text(nodes: Column, span: Column, gap: str = "") -> Column:
    """The collapsed text of a span; empty where there is none."""
    return F.when(span["size"] > 0, squash(F.array_join(F.slice(nodes, span["first"] + 1, span["size"]), gap))).otherwise("")


def normalize_markup(xml: Column, kind: str = "jats") -> Column:
    """Struct (error, title, raw_text, sections); error null means usable.

    Text is collapsed; the body's nodes are parted by a space, since tags part
    words. A section counts when it has a heading or a paragraph with text; the
    sections inside it are its own entries."""
    names = FORMATS[kind]
    none = {"read": False, "nodes": None, "body": None, "title": None, "sections": None}
    found = _events_of(xml, ARTICLE, lambda: _Article(*names), none)

    def judged(f: Column) -> Column:
        nodes = f["nodes"]

        def section(s: Column) -> Column:
            parts = F.filter(F.transform(s["parts"], lambda p: _text(nodes, p)), lambda t: t != "")
            return F.struct(_text(nodes, s["head"]).alias("title"), F.array_join(parts, "\n\n").alias("text"))

        sections = F.filter(F.transform(f["sections"], section), lambda s: (s["title"] != "") | (s["text"] != ""))
        raw = _text(nodes, f["body"], " ")
        error = F.when(~f["read"], "parse_error").when(f["body"].isNull(), "no_body").when(F.length(raw) < MIN_BODY_CHARS, "body_too_short")
        title = _text(nodes, f["title"])
        return F.struct(
            error.alias("error"),
            F.when(title != "", title).alias("title"),
            F.when(f["body"].isNotNull(), raw).alias("raw_text"),
            F.when(error.isNull(), sections).alias("sections"),
        )

    # Bound once, so that the payload is parsed once.
    return F.transform(F.array(found), judged)[0]


def normalize_articles(df: DataFrame, xml: str = "xml", kind: str = "jats") -> DataFrame:
    """Payload rows (paper_id, title, xml, ...) to normalised full texts with
    ``error``; the given title stands in where the article has none."""
    source = {"jats": "pmc_xml", "tei": "pdf_grobid"}[kind]
    d = df.withColumn("_n", normalize_markup(F.col(xml), kind))
    rest = [c for c in df.columns if c not in (xml, "title")]
    ok = F.col("_n.error").isNull()
    return d.select(
        *rest,
        F.coalesce(F.when(ok, F.col("_n.title")), text_of(F.col("title"))).alias("title"),
        F.lit(source).alias("source_type"),
        F.col("_n.error").alias("error"),
        F.when(ok, F.col("_n.raw_text")).alias("raw_text"),
        F.when(ok, F.col("_n.sections")).alias("sections"),
    )


class _BodyLength(_Events):
    """Only counts the body's collapsed characters; keeps no text."""

    def __init__(self):
        super().__init__()
        self.chars, self._depth, self._words = None, 0, 0

    def start(self, tag, attributes):
        self._count()
        if self._depth or (tag.rpartition("}")[2] == "body" and self.chars is None):
            self._depth += 1
            self.chars = self.chars or 0

    def end(self, tag):
        self._count()
        self._depth -= self._depth > 0

    def _count(self):
        if self._depth:
            words = "".join(self._text).split()
            self.chars += sum(map(len, words))
            self._words += len(words)
        self._text.clear()

    def found(self):
        return {"chars": None if self.chars is None else self.chars + max(0, self._words - 1)}


def cached_markup_ok(xml: Column) -> Column:
    """Is a cached parser result worth keeping: large enough, readable, and with
    a body long enough. Smaller ones are not parsed."""
    large = F.octet_length(text_of(xml)) >= MIN_CACHED_BYTES
    chars = _events_of(F.when(large, xml), "struct<chars:int>", _BodyLength, {"chars": None})["chars"]
    return large & F.coalesce(chars >= MIN_BODY_CHARS, F.lit(False))


SUMMARY_XML = (
    "DocSum array<struct<Id:string,Item:array<struct<_Name:string,_Type:string,_VALUE:string,"
    "Item:array<struct<_Name:string,_Type:string,_VALUE:string>>>>>>"
)


def parse_summaries(df: DataFrame, xml: str = "xml") -> DataFrame:
    """Summary payloads to one row per record."""
    opts = {"rowTag": "eSummaryResult", "mode": "PERMISSIVE"}
    d = df.select(F.explode(F.from_xml(F.col(xml), SUMMARY_XML, opts)["DocSum"]).alias("d"))
    items = F.col("d.Item")
    named = lambda n: F.get(F.filter(items, lambda i: i["_Name"] == n), F.lit(0))
    text = lambda n: F.trim(text_of(named(n)["_VALUE"]))
    none = F.array().cast("array<struct<_Name:string,_Type:string,_VALUE:string>>")
    inner = lambda n: F.coalesce(named(n)["Item"], none)
    filled = lambda x: F.coalesce(x["_VALUE"], F.lit("")) != ""
    authors = F.transform(F.filter(inner("AuthorList"), filled), lambda x: F.trim(x["_VALUE"]))
    ids = F.filter(inner("ArticleIds"), lambda x: filled(x) & x["_Name"].isNotNull())
    # Of repeated id names the last one counts.
    last = F.filter(
        ids, lambda x, i: ~F.exists(F.slice(ids, i + 2, F.greatest(F.size(ids), F.lit(1))), lambda y: y["_Name"] == x["_Name"])
    )
    return d.select(
        F.trim(text_of(F.col("d.Id"))).alias("pmid"),
        text("Title").alias("title"),
        text("PubDate").alias("pubdate"),
        year_of(text("PubDate")).alias("year"),
        text("FullJournalName").alias("journal"),
        authors.alias("authors"),
        F.map_from_entries(F.transform(last, lambda x: F.struct(x["_Name"], F.trim(x["_VALUE"])))).alias("article_ids"),
    )


# The elements of an article record that are read.
_DETAIL_PATHS = (
    ("MedlineCitation", "PMID"),
    ("Article", "Abstract", "AbstractText"),
    ("PublicationTypeList", "PublicationType"),
)


def parse_article_details(df: DataFrame, xml: str = "xml") -> DataFrame:
    """Article payloads to (pmid, abstract, publication_types). Labelled parts of
    the first abstract are ``label: text``, parted by a blank line; records
    without an id are left out, as are payloads that cannot be read."""
    found = _events_of(F.col(xml), RECORDS, lambda: _Records("PubmedArticle", _DETAIL_PATHS), {"nodes": None, "records": None})
    d = df.select(found.alias("_f")).select(F.col("_f.nodes").alias("_nodes"), F.explode("_f.records").alias("_r"))

    def named(name: str) -> Column:
        held = F.filter("_r.fields", lambda f: f["name"] == name)
        nodes = F.col("_nodes")

        def whole(f: Column) -> Column:
            span = f["span"]
            text = F.when(span["size"] > 0, F.array_join(F.slice(nodes, span["first"] + 1, span["size"]), ""))
            return F.struct(strip(text_of(text)).alias("text"), strip(text_of(f["label"])).alias("label"), f["owner"].alias("owner"))

        return F.transform(held, whole)

    ids, parts, kinds = named("PMID"), named("AbstractText"), named("PublicationType")
    first = F.filter(parts, lambda p: (p["owner"] == F.get(parts, F.lit(0))["owner"]) & (p["text"] != ""))
    lines = F.transform(first, lambda p: F.when(p["label"] == "", p["text"]).otherwise(F.concat(p["label"], F.lit(": "), p["text"])))
    out = d.select(
        text_of(F.get(ids, F.lit(0))["text"]).alias("pmid"),
        F.array_join(lines, "\n\n").alias("abstract"),
        F.filter(F.transform(kinds, lambda k: k["text"]), lambda k: k != "").alias("publication_types"),
    )
    return out.where("pmid <> ''")


def manifest_cells(df: DataFrame) -> DataFrame:
    """List columns as the text cells of the exported table."""
    return df.withColumns(
        {
            "publication_types": join_clean(F.col("publication_types")),
            "authors": join_clean(F.col("authors")),
            "source_query": join_clean(F.col("source_queries"), "; "),
            "title": squash(text_of(F.col("title"))),
        }
    )
