"""Cases that the registered queries' data do not reach."""

import pytest

from screenline.functions import text
from screenline.operators import access, collect, match, quality
from screenline.sources import stage
from screenline.streaming import streams

PAPER = "run_id string, pass_number int, paper_id string, title string, abstract string, publication_types array<string>"


def test_slices_keep_rows_of_one_id_apart(rows, monkeypatch):
    terms = [("r", 1, "primary", t) for t in ("akt", "liver cancer", "mtor", "p53")] + [("r", 1, "mechanism", "autophagy")]
    profile = rows(terms, "run_id string, pass_number int, role string, term string")
    papers = rows(
        [("r", 1, "a", "On akt", "x", []), ("r", 1, "a", "On autophagy", "p53 and mtor", []), ("r", 1, None, "On akt", "liver cancer", [])] * 2,
        PAPER,
    )
    want = sorted(map(str, match.paper_flags(papers, profile).collect()))
    monkeypatch.setattr(match.pack_profile, "__defaults__", (match.RUN_KEYS, 1))
    assert sorted(map(str, match.paper_flags(papers, profile).collect())) == want


def test_rules_are_numbered_over_files(spark, tmp_path):
    for name, value in (("b", "second"), ("a", "first")):
        (tmp_path / f"{name}.csv").write_text(f"match_type,match_value,rationale\njournal_exact,{value},r\njournal_exact,{value}2,r\n")
    got = stage.read_venue_rules(spark, str(tmp_path)).orderBy("rule_no").collect()
    assert [r["match_value"] for r in got] == ["first", "first2", "second", "second2"]


def test_a_rejection_belongs_to_its_run(rows):
    papers = rows([("a", 2, "1"), ("b", 2, "1")], "run_id string, pass_number int, pmid string")
    state = rows([("a", "1", "rejected")], "run_id string, pmid string, latest_status string")
    assert [r["run_id"] for r in collect.drop_rejected(papers, state).collect()] == ["b"]


def test_state_after_a_restart_with_nothing_new(spark, rows, tmp_path):
    rows([(1,), (2,)], "n int").write.parquet(str(tmp_path / "in"))
    state = streams.PartitionedState(spark, str(tmp_path / "state"), "n int", ["n"], 4)
    assert state.read().collect() == []

    def go(mark):
        stream = spark.readStream.schema("n int").parquet(str(tmp_path / "in"))
        streams.stream_fold(stream, state, lambda old, new: old.unionByName(new).distinct(), str(tmp_path / mark))
        return sorted(r.n for r in state.read().collect())

    # The same query again, then one that knows nothing of the first.
    assert go("mark") == go("mark") == go("other") == [1, 2]


def test_reason_codes_are_no_phrases():
    assert not set(access.NOISE_FIELDS) & {"recommended_abstract_rule_changes"}


def test_checks_that_lack_a_table_are_told(rows):
    manifest = rows([("r", 1, "a")], "run_id string, pass_number int, paper_id string")
    got = quality.validate({"paper_manifest": manifest}, names=["x"], required=["y"]).where("check = 'not_run'").collect()
    told = {r["item"] for r in got}
    assert {"check_listing", "check_required", "check_prior_payloads", "check_evidence_handoff"} <= told
    assert all(r["detail"].startswith("no table ") for r in got)


@pytest.mark.parametrize("body", ["", "one line.", "Head\nfirst. Second one.\nmore.\n\nNext\nlast", "a.\nHead\nHead two\nx."])
def test_locators_are_the_last_heading(rows, body):
    d = rows([("T", body)], "title string, body string")
    got = d.select(text.evidence_windows(d["title"], d["body"]).alias("w")).first()["w"]
    now, want = "full text", [("title", "t")]
    for line in filter(None, (x.strip() for x in body.split("\n"))):
        now = now if line.endswith(".") else line
        want += [(now, s) for s in line.replace(". ", ".|").split("|")]
    assert [tuple(w) for w in got] == want


def test_loop_bounds_are_the_runs_own(spark, rows):
    from screenline.operators import runs

    d = spark.createDataFrame(
        [("a", {"min_big_workflow_loops": "3"}), ("b", {"max_workflow_loops": "5"}), ("c", {})], "run_id string, settings map<string,string>"
    )
    got = {r["run_id"]: (r["min_loops"], r["max_loops"]) for r in runs.loop_bounds(d).collect()}
    assert got == {"a": (3, 3), "b": (2, 5), "c": (2, 2)}


def test_files_serve_their_own_run(rows):
    from screenline.operators import linking

    queue = rows(
        [("a", 1, "p1", "", "", "", "deep autophagy survey", "Lee", "Cell", "2020"), ("b", 2, "p1", "", "", "", "deep autophagy survey", "Lee", "Cell", "2020")],
        "run_id string, queue_no long, paper_id string, pmid string, pmcid string, doi string, title string, first_author string, journal string, year string",
    )
    files = rows(
        [("b", "/in/x.pdf", "deep autophagy survey", "deep autophagy survey", "", "")],
        "run_id string, path string, name string, stem string, meta_title string, origin string",
    )
    found = linking.link_candidates(queue, files).collect()
    assert [(r["queue_no"], r["first_path"]) for r in found] == [(2, "/in/x.pdf")]
    given = linking.assign_one_to_one(queue, files).collect()
    assert [(r["queue_no"], r["path"]) for r in given] == [(2, "/in/x.pdf")]
    loose = linking.link_candidates(queue.drop("run_id"), files).collect()
    assert sorted(r["queue_no"] for r in loose) == [1, 2]
