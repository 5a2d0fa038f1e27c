"""Files, payloads and streams."""

import glob
import os

from pyspark.sql import functions as F

from screenline.operators import collect
from screenline.sources import markup, stage
from screenline.streaming import streams


def test_csv_round_trip(spark, rows, tmp_path):
    d = rows([("a", 'say "hi", ok', "two\nlines", None), ("b", "", " x ", "y")], "id string, q string, n string, z string")
    for form in ("plain", "quoted"):
        path = str(tmp_path / form)
        stage.write_stage(d.coalesce(1), path, ["id", "q", "n", "z"], "csv", quoted=form == "quoted")
        got = {r.id: (r.q or "", r.n or "", r.z or "") for r in stage.read_stage(spark, path, "id string, q string, n string, z string").collect()}
        assert got["a"] == ('say "hi", ok', "two\nlines", "") and got["b"][0] == "" and got["b"][2] == "y"


def test_missing_table_is_empty(spark, tmp_path):
    assert stage.read_stage(spark, str(tmp_path / "none"), "a string").count() == 0
    assert stage.read_passes(spark, str(tmp_path / "none"), "run_id string, a string").count() == 0


ARTICLE = "<article><front><article-title>T <i>x</i></article-title></front><body>{0}</body></article>"


def test_articles(spark, rows):
    long = "word " * 300
    nested = f"<sec><title>A</title><p>{long}</p><sec><p>inner &amp; <b>bold</b>  text</p></sec></sec>"
    data = [
        ("ok", ARTICLE.format(nested)),
        ("short", ARTICLE.format("<p>few</p>")),
        ("nobody", "<article/>"),
        ("broken", "<article><body>"),
        ("none", None),
    ]
    got = {r.paper_id: r for r in markup.normalize_articles(rows([(k, "given", x) for k, x in data], "paper_id string, title string, xml string")).collect()}
    assert {k: r.error for k, r in got.items()} == {"ok": None, "short": "body_too_short", "nobody": "no_body", "broken": "parse_error", "none": "parse_error"}
    ok = got["ok"]
    assert ok.title == "T x" and [s.title for s in ok.sections] == ["A", ""] and ok.sections[1].text == "inner & bold text"
    assert got["short"].title == "given" and got["short"].raw_text is None


def test_tei(spark, rows):
    x = f'<TEI xmlns="http://www.tei-c.org/ns/1.0"><title>N</title><text><body><div><p>{"w " * 600}</p></div></body></text></TEI>'
    d = rows([("a", "", x)], "paper_id string, title string, xml string")
    r = markup.normalize_articles(d, kind="tei").first()
    assert r.error is None and r.title == "N" and r.source_type == "pdf_grobid"
    assert d.select(markup.cached_markup_ok(F.col("xml"))).first()[0] is True


def test_contract(spark, rows):
    text = "# Brief\n- Primary entities: AKT1, liver cancer\n  more of AB-12 kind\n- Outcomes:\n- Exclusions: zebrafish; yeast | fungi\nOther notes: akt\n"
    d = stage.read_contract_terms(rows([("r", 1, text)], "run_id string, pass_number int, value string"), ("of",))
    got = {(r.role, r.term) for r in d.collect()}
    assert got == {("primary", "akt1"), ("primary", "liver cancer"), ("primary", "more ab-12 kind"), ("primary", "ab-12"), ("exclusion", "zebrafish"), ("exclusion", "yeast"), ("exclusion", "fungi")}


def test_query_list(spark, rows):
    text = "# S\n## Notes\n1. no\n## Query set\n1. `a AND b`\nfree\n2. <search query 2>\n3. c\n## End\n4. no"
    lines = stage.numbered_lines(rows([("r", text)], "run_id string, value string"), ["run_id"])
    assert [r.query for r in stage.read_query_list(lines, ["run_id"]).orderBy("line_no").collect()] == ["a AND b", "c"]


def test_scan_files(spark, tmp_path):
    for name, body in (("a.pdf", b"%PDF-1"), ("b.pdf", b"<html>"), ("c.txt", b"%PDF-1"), ("D.PDF", b"%PDF-2")):
        (tmp_path / name).write_bytes(body)
    assert [r.stem for r in stage.scan_files(spark, str(tmp_path)).collect()] == ["D", "a"]
    out = str(tmp_path / "out")
    streams.run_available(streams.stream_files(spark, str(tmp_path)), out, str(tmp_path / "cp"))
    assert sorted(r.stem for r in spark.read.parquet(out).collect()) == ["D", "a"]


def test_late_repeats_come_back(spark, rows, tmp_path):
    """Beyond the watermark a repeat is let through; within it, it is not."""
    src = str(tmp_path / "in")
    for n, batch in enumerate([[("a", "2024-01-01 00:00:00")], [("a", "2024-01-01 00:30:00"), ("b", "2024-01-09 00:00:00")], [("a", "2024-01-10 00:00:00")]]):
        rows(batch, "k string, t string").select("k", F.col("t").cast("timestamp").alias("t")).coalesce(1).write.mode("append").parquet(src)
        s = spark.readStream.schema("k string, t timestamp").parquet(src)
        streams.run_available(streams.stream_dedupe(s, ["k"], "t", "1 hour"), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "a", "b"]


def test_a_batch_writes_its_own_partitions(spark, rows, tmp_path):
    """Ten keys touch ten partitions at most; a replacement cut short is
    completed, one that was not written in full is let go."""
    folder = str(tmp_path / "s")
    s = streams.PartitionedState(spark, folder, "k long, n long", ["k"], 50)
    put = lambda old, new: new.unionByName(old.join(new, "k", "left_anti"))
    assert len(s.update(rows([(i, 0) for i in range(1000)], "k long, n long"), put)) == 50
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{folder}/*/*.parquet")}
    for _ in range(2):
        assert len(s.update(rows([(i, 1) for i in range(10)], "k long, n long"), put)) <= 10
    after = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{folder}/*/*.parquet")}
    assert len({os.path.dirname(f) for f in set(before) - set(after)}) <= 10
    assert sorted(map(tuple, s.read().collect())) == [(i, int(i < 10)) for i in range(1000)]
    s._marked(rows([(5, 7)], "k long, n long")).write.partitionBy("_part").parquet(f"{folder}/{stage.NEXT}")
    part = s._marked(rows([(5, 7)], "k long, n long")).first()["_part"]
    inside = [r.k for r in s._marked(rows([(i, 0) for i in range(1000)], "k long, n long")).where(F.col("_part") == part).collect()]
    assert sorted(map(tuple, s.read().collect())) == sorted([(i, int(i < 10)) for i in range(1000) if i not in inside] + [(5, 7)])
    rows([(6, 9)], "k long, n long").write.parquet(f"{folder}/{stage.NEXT}")
    os.remove(f"{folder}/{stage.NEXT}/_SUCCESS")
    assert s.read().where("n = 9").count() == 0 and not os.path.exists(f"{folder}/{stage.NEXT}")


def test_purged_table(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    rows([("007", 1, "a"), ("007", 2, "b"), ("r", 1, "c"), ("s", 1, "d"), ("t", 3, "e")], "run_id string, pass_number int, v string").write.partitionBy("run_id").parquet(path)
    kept = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/run_id=[st]/*.parquet")}
    active = rows([("007", 2), ("r", 2), ("s", 1)], "run_id string, pass_number int")
    for _ in range(2):
        stage.purge_prior_payloads(spark, path, active)
    got = spark.read.schema("run_id string, pass_number int, v string").parquet(path).collect()
    assert sorted((r.run_id, r.pass_number, r.v) for r in got) == [("007", 2, "b"), ("s", 1, "d"), ("t", 3, "e")]
    assert kept == {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/run_id=[st]/*.parquet")}
    assert sorted(os.path.basename(d) for d in glob.glob(f"{path}/run_id=*")) == ["run_id=007", "run_id=s", "run_id=t"]


def test_counted_windows_are_let_go(spark, rows, tmp_path):
    """A long stream holds the open windows only; late rows are told apart."""
    src, told = str(tmp_path / "in"), []
    for day in range(1, 7):
        data = [("x", f"2024-01-{day:02d} {h:02d}:10:00") for h in range(24)] + ([("x", "2024-01-01 05:00:00")] * 3 if day == 5 else [])
        rows(data, "k string, t string").select("k", F.col("t").cast("timestamp").alias("t")).coalesce(1).write.mode("append").parquet(src)
        s = spark.readStream.schema("k string, t timestamp").parquet(src)
        told.append(streams.run_available(streams.progress_counts(s, "t", "k"), str(tmp_path / "out"), str(tmp_path / "cp")))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 6 * 24 - 2 and got.where("n <> 1").count() == 0
    assert sum(t["late_rows"] for t in told) == 1 and all(t["late_rows"] == 0 for t in told[:4])
    assert max(t["state_rows"] for t in told) <= 30


def test_caps(spark, rows):
    lines = rows([("- `retmax`: 5",), ("retmaxx: 5",), ("# retmax: 1",), ("record_cap : 9",)], "value string")
    assert sorted(r.cap_key for r in collect.forbidden_caps(lines).collect()) == ["record_cap", "retmax"]


def test_nested_and_mixed_markup(spark, rows):
    long = "word " * 250
    body = (
        f"<sec><title>A<xref>1</xref></title><title>again</title><p>{long}</p><list><p>not its own</p></list>"
        "<sec><p>one<sec><title>in a paragraph</title></sec>two</p></sec></sec><sec><title> </title><p>\n</p></sec>"
    )
    xml = f'<a xmlns:m="u:m"><body>{body}<m:sec><m:p>named</m:p></m:sec></body><back><sec><p>behind</p></sec></back><body>second</body><article-title>late &lt;T&gt;</article-title></a>'
    d = rows([("a", "given", xml), ("b", "", xml.replace("u:m", "")), ("c", "", "&x;"), ("d", "", "\x00")], "paper_id string, title string, xml string")
    got = {r.paper_id: r for r in markup.normalize_articles(d).collect()}
    assert {k: r.error for k, r in got.items()} == {"a": None, "b": "parse_error", "c": "parse_error", "d": "parse_error"}
    a = got["a"]
    assert a.title == "late <T>"
    assert [(s.title, s.text[:20]) for s in a.sections] == [("A1", "word word word word w"[:20]), ("", "onein a paragraphtwo"), ("in a paragraph", ""), ("", "named")]
    assert a.raw_text.startswith("A 1 again word") and a.raw_text.endswith("not its own one in a paragraph two named")


def test_body_length_needs_no_text(spark, rows):
    filled = lambda n: f"<TEI><pad>{'x' * 600}</pad><text><body><p>{'w' * (n - 2)}</p>\n <b>v</b></body><p>{'y' * 900}</p></text></TEI>"
    data = [("a", filled(1000)), ("b", filled(999)), ("c", filled(2000)[:-1]), ("d", None), ("e", "<TEI/>"), ("f", f"<TEI>{'z' * 3000}</TEI>")]
    d = rows(data, "paper_id string, xml string").select("paper_id", markup.cached_markup_ok(F.col("xml")).alias("ok"))
    assert {r.paper_id: r.ok for r in d.collect()} == {"a": True, "b": False, "c": False, "d": False, "e": False, "f": False}


def test_article_details(spark, rows):
    one = (
        "<S><PubmedArticle><MedlineCitation><PMID> 7 </PMID><Article><Abstract><AbstractText Label=' AIM '>a<i>b</i>\n</AbstractText>"
        "<AbstractText/><AbstractText>c</AbstractText></Abstract><Abstract><AbstractText>other</AbstractText></Abstract></Article></MedlineCitation>"
        "<PublicationTypeList><PublicationType>Review</PublicationType><PublicationType> </PublicationType></PublicationTypeList></PubmedArticle>"
        "<PubmedArticle><MedlineCitation><PMID>8</PMID></MedlineCitation></PubmedArticle><PubmedArticle/><PMID>9</PMID></S>"
    )
    got = markup.parse_article_details(rows([(one,), (None,), ("<S>",), ("<S/>",)], "xml string")).collect()
    assert [tuple(r) for r in got] == [("7", "AIM: ab\n\nc", ["Review"]), ("8", "", [])]
