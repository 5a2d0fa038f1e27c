"""Collection, ranking, state folds and linking on small fixtures."""

import random

import pytest

from pyspark.sql import functions as F

from screenline.operators.components import components
from screenline.operators import collect, linking, ranking, state
from screenline.operators.match import pack_profile


def test_first_rule_wins_and_blank_never_blocked(spark, rows):
    rules = rows(
        [(0, "journal_prefix", "Front", "a"), (1, "journal_exact", "Frontier", "b"), (2, "journal_exact", " ", "c"), (3, "other", "Nature", "d"), (4, "journal_exact", "Nature", "e")],
        "rule_no int, match_type string, match_value string, rationale string",
    )
    papers = rows([(str(i), v) for i, v in enumerate(["Frontier", "FRONT. Med", "nature!", "Nature X", "", None])], "pmid string, journal string")
    want = {"0": 0, "1": 0, "2": 4, "3": None, "4": None, "5": None}
    for marked in (collect.block_venues(papers, rules), collect._block_by_key(papers, collect.read_rules(rules), "journal")):
        assert {r.pmid: r.rule.rule_no if r.rule else None for r in marked.collect()} == want
    marked = collect.block_venues(papers, rules)
    assert collect.kept(marked).count() + collect.blocked(marked).count() == 6


def test_row_numbers_with_one_hot_key(spark):
    """A key with nearly all rows is numbered in pieces."""
    d = spark.range(5000).select(F.when(F.col("id") % 50 == 0, "b").when(F.col("id") % 50 > 1, "a").alias("k"), F.concat(F.lit("p"), (F.col("id") * 7919 % 5003)).alias("v"))
    got = ranking.row_numbers(d, ["k"], "v").collect()
    for key in ("a", "b", None):
        mine = sorted(r.v for r in got if r.k == key)
        assert {r.v: r.row_no for r in got if r.k == key} == {v: i for i, v in enumerate(mine, 1)}


def test_sample_sizes(spark):
    got = spark.createDataFrame([(200,), (201,), (1000,), (1001,)], "n int").select(ranking.sample_size(F.col("n"))).collect()
    assert [r[0] for r in got] == [40, 50, 50, 75]


def test_sort_orders(spark, rows):
    d = rows([("low", None, "b"), ("high", 2001, "c"), ("odd", 1990, "a"), ("low", 1999, "a"), ("exclude", 1, "z")], "priority string, year int, title string")
    assert [(r.priority, r.title) for r in ranking.sort_shortlist(d).collect()] == [("high", "c"), ("low", "b"), ("low", "a"), ("exclude", "z"), ("odd", "a")]
    m = rows([(2001, "9"), (2001, "10"), (2010, "1")], "year int, pmid string")
    assert [r.pmid for r in ranking.sort_manifest(m).collect()] == ["1", "9", "10"]


def test_supersede_loses_rejections_unless_kept(spark, rows):
    p = rows([("r", "pmid-1", "1", "", "", "", 1, 2, "rejected", "x", "y"), ("r", "pmid-2", "2", "", "", "", 1, 2, "advanced", "x", "y"), ("s", "pmid-1", "1", "", "", "", 2, 2, "advanced", "x", "y")], state.PAPERS)
    d = rows([("r", 2, "pmid-1", "1", "abstract_triage", "x", "rejected", "y")], state.DECISIONS)
    m = rows([("r", "", "2")], "run_id string, paper_id string, pmid string")
    got, dec = state.supersede(p, d, m, 2)
    assert {(r.run_id, r.paper_id): r.latest_status for r in got.collect()} == {("r", "pmid-1"): "superseded", ("r", "pmid-2"): "advanced", ("s", "pmid-1"): "advanced"}
    assert dec.first().status == "superseded"
    safe, _ = state.supersede(p, d, m, 2, keep_rejected=True)
    assert {r.paper_id: r.latest_status for r in safe.where("run_id = 'r'").collect()}["pmid-1"] == "rejected"


def test_fold_twice_is_the_same(spark, rows):
    m = rows([("r", "", "1", "d", "t", 2001), ("r", "pmid-2", "2", "", "t2", 2002), ("r", " ", " ", "x", "x", 1)], "run_id string, paper_id string, pmid string, doi string, title string, year int")
    empty = spark.createDataFrame([], state.PAPERS)
    once = state.fold_collected(empty, m, 1)
    assert sorted(map(tuple, state.fold_collected(once, m, 1).collect())) == sorted(map(tuple, once.collect()))
    assert {r.paper_id for r in once.collect()} == {"pmid-1", "pmid-2"}


def brute(queue, files, stop=()):
    """Going through the queue one by one."""
    def words(s):
        import re

        return {w for w in re.sub("[^a-z0-9]+", " ", (s or "").lower()).split() if len(w) > 2 and w not in stop}

    def squeeze(s):
        import re

        return re.sub("[^a-z0-9]+", "", (s or "").lower())

    used, out = set(), {}
    for q in sorted(queue, key=lambda r: r["queue_no"]):
        hit = None
        for f in sorted(files, key=lambda r: r["path"]):
            if f["path"] in used:
                continue
            name = squeeze(f["name"])
            for m in ("paper_id", "pmid", "pmcid"):
                if q[m] and squeeze(q[m]) in name:
                    hit = hit or (f["path"], m, 1.0)
            if q["pmcid"] and squeeze(q["pmcid"]) in squeeze(f["origin"]):
                hit = hit or (f["path"], "pdf_metadata_pmcid", 1.0)
            if hit:
                break
        if not hit:
            best = (None, "", 0.0)
            for f in sorted(files, key=lambda r: r["path"]):
                if f["path"] in used:
                    continue
                t, s, m = words(q["title"]), words(f["stem"]), words(f["meta_title"])
                for method, w in (("title_overlap", s), ("pdf_metadata_title", m)):
                    if t and w and len(t & w) / len(t) > best[2]:
                        best = (f["path"], method, len(t & w) / len(t))
                author = squeeze((q["first_author"] or "").split(" ")[0])
                if author and author in s and q["year"] and q["year"] in f["name"] and words(q["journal"]) & s and 0.7 > best[2]:
                    best = (f["path"], "author_year_journal", 0.7)
            if best[2] >= 0.45:
                hit = (best[0], best[1], round(best[2], 3))
        if hit:
            used.add(hit[0])
            out[q["queue_no"]] = hit
    return out


QUEUE = "queue_no bigint, paper_id string, pmid string, pmcid string, doi string, title string, first_author string, journal string, year string"
FILES = "path string, name string, stem string, meta_title string, origin string"


@pytest.mark.parametrize(
    "bounds", [{}, {"IN_ONE_COMPONENT": 3, "FREQUENT": 5}, {"IN_ONE_GROUP": 10, "FREQUENT": 0, "LEAST_GRAM": 9}], ids=["plain", "rounds", "frequent"]
)
def test_assignment_equals_one_by_one(spark, rows, monkeypatch, bounds):
    for k, v in bounds.items():
        monkeypatch.setattr(linking, k, v)
    rnd = random.Random(7)
    vocab = ["tumor", "growth", "signal", "kinase", "liver", "mouse", "cell", "gene", "protein", "pathway", "receptor", "immune"]
    queue, files = [], []
    for i in range(60):
        title = " ".join(rnd.sample(vocab, 5)) if i % 3 else "erratum liver kinase signal notes"
        queue.append(dict(queue_no=i, paper_id=f"pmid-{5000 + i}", pmid=str(5000 + i), pmcid=f"PMC{70000 + i}" if i % 7 == 0 else "", doi="", title=title, first_author="Smith J" if i % 5 == 0 else "", journal="Liver Journal" if i % 5 == 0 else "", year="2019" if i % 5 == 0 else ""))
    for j in range(45):
        stem = " ".join(rnd.sample(vocab, 4)) + f" v{j}"
        if j % 6 == 0:
            stem = f"PMID {5000 + j}"
        if j % 11 == 0:
            stem = f"smith liver 2019 n{j}"
        if j % 4 == 1:
            stem = f"erratum liver kinase n{j}"
        files.append(dict(path=f"/in/{j:03d}.pdf", name=stem + ".pdf", stem=stem, meta_title=" ".join(rnd.sample(vocab, 5)) if j % 5 == 0 else "", origin=f"http://x/PMC{70000 + j}/pdf" if j % 9 == 0 else ""))
    q = rows([tuple(r.values()) for r in queue], QUEUE)
    f = rows([tuple(r.values()) for r in files], FILES)
    got = {r.queue_no: (r.path, r.method, r.score) for r in linking.assign_one_to_one(q, f).collect()}
    want = brute(queue, files)
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert got == want and len(want) > 25
    report = linking.import_report(q, linking.assign_one_to_one(q, f))
    assert report.where("import_status = 'staged'").count() == len(want) and report.count() == 60


def test_first_candidates_equal_one_by_one(spark, rows, monkeypatch):
    """Without competition; ids of one to eight characters."""
    rnd = random.Random(8)
    vocab = ["tumor", "growth", "signal", "kinase", "liver", "mouse", "cell", "gene", "zeta2019", "smith"]
    queue = [
        dict(queue_no=i, paper_id=f"pmid-{i}", pmid=str(rnd.choice([i, 10**rnd.randrange(8) + i])), pmcid="", doi="", title=" ".join(rnd.sample(vocab, rnd.randrange(0, 7))), first_author="Smith J", journal="Liver Cell", year=rnd.choice(["2019", "2020", "19", ""]))
        for i in range(40)
    ]
    files = []
    for j in range(30):
        stem = " ".join(rnd.sample(vocab, rnd.randrange(1, 6))) + rnd.choice(["", f" {rnd.choice('xyz')}{rnd.randrange(10, 40)}", " 120192"])
        files.append(dict(path=f"/in/{j:03d}.pdf", name=stem + ".pdf", stem=stem, meta_title=" ".join(rnd.sample(vocab, 3)) if j % 3 == 0 else "", origin=""))
    q, f = rows([tuple(r.values()) for r in queue], QUEUE), rows([tuple(r.values()) for r in files], FILES)
    want = {}
    for one in queue:
        want.update(brute([one], files))
    for hot in (1_000, 2):
        monkeypatch.setattr(linking, "FREQUENT", hot)
        got = {r.queue_no: (r.first_path, r.method, r.score) for r in linking.link_candidates(q, f).collect()}
        assert got == want


def test_many_of_one_author_do_not_meet_everywhere(spark, rows):
    """300 titles of one author against 300 files: what is brought together."""
    titles = [f"common words alpha{i:03d} beta{i:03d} delta{i:03d}" for i in range(300)]
    q = rows([(i, f"p{i}q", "", "", "", t, "Smith J", f"Journal of field{i:03d}", str(1700 + i)) for i, t in enumerate(titles)], QUEUE)
    f = rows([(f"/{i}", f"smith journal field{i:03d} {1700 + i} {t}.pdf", f"smith journal field{i:03d} {1700 + i} {t}", "", "") for i, t in enumerate(titles)], FILES)
    queue, files = linking._runs(q, f)
    t, g = linking.titles_of(queue), linking.file_groups(files)
    found = linking.title_candidates(t.dropDuplicates(["title_key"]), g)
    assert found.count() == 300 and found.where("score = 1").count() == 300
    names = g.select("_run", "first_path", F.lit(0).alias("m"), F.split("stem", " ").alias("file_words"))
    often = names.select("_run", F.explode("file_words").alias("word")).groupBy("_run", "word").agg(F.count("*").alias("df"))
    assert linking._similar(t, names, often).count() < 3_000
    assert linking.link_candidates(q, f).count() == 300


def test_the_best_candidate_is_found_without_all_pairs(spark, rows, monkeypatch):
    """200 titles of two words against 200 files of the first of them."""
    made, similar = [], linking._similar
    monkeypatch.setattr(linking, "_similar", lambda *a: made.append(similar(*a)) or made[-1])
    q = rows([(i, f"p{i}q", "", "", "", f"common alpha{i:03d}", "", "", "") for i in range(200)], QUEUE)
    f = rows([(f"/{i}", f"f{i}.pdf", f"common beta{i:03d}" if i else "common alpha007", "", "") for i in range(200)], FILES)
    got = {r.queue_no: (r.first_path, r.score) for r in linking.link_candidates(q, f).collect()}
    assert got == {i: ("/0", 1.0 if i == 7 else 0.5) for i in range(200)}
    assert sum(d.count() for d in made) < 1_000


def test_the_best_of_three_words_is_found_without_all_pairs(spark, rows, monkeypatch):
    """200 titles of three words, two of which are in every one of 200 files."""
    made, similar = [], linking._similar
    monkeypatch.setattr(linking, "_similar", lambda *a: made.append(similar(*a)) or made[-1])
    q = rows([(i, f"p{i}q", "", "", "", f"red blue alpha{i:03d}", "", "", "") for i in range(200)], QUEUE)
    f = rows([(f"/{j:03d}", f"f{j}.pdf", f"red blue alpha{j // 2 * 2:03d} alpha{(j + 5) % 200:03d}", "", "") for j in range(200)], FILES)
    got = {r.queue_no: (r.first_path, r.score) for r in linking.link_candidates(q, f).collect()}
    assert got == {i: (f"/{min(j for j in range(200) if i in (j // 2 * 2, (j + 5) % 200)):03d}", 1.0) for i in range(200)}
    assert sum(d.count() for d in made) < 1_000


@pytest.mark.parametrize("bounds", [{}, {"WORDS_HELD": 40, "PLACES_HELD": 6}])
@pytest.mark.parametrize("first_only", [False, True])
def test_titles_meet_sets_of_words(spark, rows, monkeypatch, bounds, first_only):
    for k, v in bounds.items():
        monkeypatch.setattr(linking, k, v)
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(30)] + ["é", "for", "the"]
    draw = lambda most: sorted({vocab[int(len(vocab) * rnd.random() ** 3)] for _ in range(rnd.randrange(3, most))})
    titles = [(run, f"{run}{i}", w) for run in ("a", "b") for i in range(40) if len(w := draw(14)) > 2]
    sets = [(run, f"/{run}/{i}", m, draw(20)) for run in ("a", "b") for i in range(25) for m in (0, 1)]
    t, s = rows(titles, "_run string, title_key string, words array<string>"), rows(sets, "_run string, first_path string, m int, file_words array<string>")
    want = {}
    for run, key, words in titles:
        for other, path, m, held in sets:
            if run == other and (share := len(set(words) & set(held)) / len(words)) >= 0.45:
                want.setdefault(key, []).append((-share, path, m))
    got = {}
    for r in linking._meet_sets(t, s, first_only).collect():
        got.setdefault(r.title_key, []).append((-r.score, r.first_path, r.m))
    if first_only:
        assert {k: min(v) for k, v in got.items()} == {k: min(v) for k, v in want.items()}
    else:
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()} and len(want) > 20


def test_long_names_are_cut_in_pieces(spark, rows, monkeypatch):
    """Ids at every place of names longer than a piece."""
    monkeypatch.setattr(linking, "PIECE", 5)
    q = rows([(i, f"p{7000 + i}q", f"{i}z", "", "", "", "", "", "") for i in range(12)], QUEUE)
    f = rows([(f"/{i:03d}", "a" * i + f"p{7000 + i}q" + "b" * (12 - i) + ("3z" if i == 9 else ""), "", "", "") for i in range(12)], FILES)
    got = {(r.queue_no, r.first_path, r.method) for r in linking.id_candidates(q, linking.file_groups(f)).collect()}
    assert got == {(i, f"/{i:03d}", "paper_id") for i in range(12)} | {(3, "/009", "pmid")}


@pytest.mark.parametrize("few", [0, 10**6])
def test_components(spark, few):
    rnd = random.Random(few)
    links = [(rnd.randrange(-300, 300), rnd.randrange(-300, 300)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1080)]
    links += [(5, 5), (5000, 5000), (None, 3), (7, None), links[0], links[0][::-1]] + [(2000, 2000 + i) for i in range(1, 90)]
    above = {}

    def top(x):
        while above.setdefault(x, x) != x:
            x = above[x]
        return x

    for a, b in links:
        if a is not None and b is not None:
            a, b = sorted((top(a), top(b)))
            above[b] = a
    d = spark.createDataFrame(links, "a long, b long")
    assert {r.node: r.component for r in components(d, few).collect()} == {x: top(x) for x in list(above)}
    assert components(d.where("a > 10000"), few).collect() == []


def test_copies_share_their_files(spark, rows):
    """Papers and files that are copies: one group each, files in order."""
    q = rows([(i, f"p{i}", "", "", "", "same title words here", "", "", "") for i in range(8)], QUEUE)
    f = rows([(f"/d{i}/same title words.pdf", "same title words.pdf", "same title words", "", "") for i in range(5)], FILES)
    got = {r.queue_no: r.path for r in linking.assign_one_to_one(q, f).collect()}
    assert got == {i: f"/d{i}/same title words.pdf" for i in range(5)}


def test_exact_ids(spark, rows):
    q = rows([(1, "pmid-12", "12", "", "", "", "", "", "")], QUEUE)
    f = rows([("/a", "PMID 312.pdf", "PMID 312", "", ""), ("/b", "PMID 12.pdf", "PMID 12", "", "")], FILES)
    g = linking.file_groups(f)
    assert {r.first_path for r in linking.id_candidates(q, g).collect()} == {"/a", "/b"}
    assert {r.first_path for r in linking.id_candidates(q, g, exact_ids=True).collect()} == {"/b"}


def test_score_bounds(spark, rows):
    """Nine words: four of them are not enough, five are."""
    words = ["alpha", "bravo", "charlie", "delta", "echo", "foxtrot", "golf", "hotel", "india"]
    q = rows([(1, "pmid-77", "", "", "", " ".join(words), "", "", "")], QUEUE)
    for n, want in ((4, 0), (5, 1)):
        f = rows([("/a", "x.pdf", " ".join(words[:n]), "", "")], FILES)
        assert linking.link_candidates(q, f).count() == want


def test_profile_is_packed_once_per_run(spark, rows):
    p = rows([("r", 1, "primary", "A  b"), ("r", 1, "primary", "x"), ("s", 1, "claim", "x")], "run_id string, pass_number int, role string, term string")
    packed, slices, loose = pack_profile(p)
    assert packed.count() == 2 and slices == 1 and loose == ["primary"]


@pytest.mark.parametrize("more", [1, 5])
def test_assignment_in_short_turns_equals_one_by_one(spark, rows, monkeypatch, more):
    """Turns of few papers to which each channel brings few files."""
    for k, v in {"IN_ONE_COMPONENT": 3, "IN_ONE_GROUP": 40, "TIMES": 0, "MORE": more}.items():
        monkeypatch.setattr(linking, k, v)
    rnd = random.Random(11)
    vocab = ["tumor", "growth", "signal", "kinase", "liver"]
    queue = [
        dict(queue_no=3 * i, paper_id=f"pmid-{70 + i}", pmid="", pmcid="", doi="", title=" ".join(rnd.sample(vocab, rnd.randrange(0, 5))), first_author="Smith J" if i % 2 else "", journal="Liver Journal", year="2019")
        for i in range(16)
    ]
    files = []
    for j in range(14):
        stem = f"Copy of pmid-{70 + j}" if j % 4 == 0 else f"smith liver 2019 n{j}" if j % 4 == 1 else " ".join(rnd.sample(vocab, 3))
        files.append(dict(path=f"/in/{j:03d}.pdf", name=stem + ".pdf", stem=stem, meta_title=" ".join(rnd.sample(vocab, 2)) if j % 3 == 0 else "", origin=""))
    q, f = rows([tuple(r.values()) for r in queue], QUEUE), rows([tuple(r.values()) for r in files], FILES)
    got = {r.queue_no: (r.path, r.method, r.score) for r in linking.assign_one_to_one(q, f).collect()}
    assert got == brute(queue, files) and len(got) > 8


def test_assignment_makes_no_pairs(spark, rows, monkeypatch):
    """300 titles that 300 files of their author and year, and of a word, all meet."""
    made, kept = [], linking.cut
    monkeypatch.setattr(linking, "cut", lambda d: made.append(kept(d)) or made[-1])
    q = rows([(i, f"p{i}q", "", "", "", f"common alpha{i:03d}", "Smith J", "Liver Journal", "2019") for i in range(300)], QUEUE)
    f = rows([(f"/{i:03d}", f"smith liver 2019 common n{i:03d}.pdf", f"smith liver 2019 common n{i:03d}", "", "") for i in range(300)], FILES)
    got = {r.queue_no: (r.path, r.method, r.score) for r in linking.assign_one_to_one(q, f).collect()}
    assert got == {i: (f"/{i:03d}", "author_year_journal", 0.7) for i in range(300)}
    assert max(d.count() for d in made) < 5_000


def test_assignment_of_titles_that_share_words_makes_no_pairs(spark, rows, monkeypatch):
    """80 titles of three words, two of which are in every one of 70 files; one turn."""
    made, similar, turns, together = [], linking._similar, [], linking.cut
    monkeypatch.setattr(linking, "_similar", lambda *a: made.append(similar(*a)) or made[-1])
    monkeypatch.setattr(linking, "cut", lambda d: (turns.append(1) if d.columns == ["no", "file", "m", "score"] else None) or together(d))
    queue = [dict(queue_no=i, paper_id=f"p{i}q", pmid="", pmcid="", doi="", title=f"red blue alpha{i * 3 % 80:03d}", first_author="", journal="", year="") for i in range(80)]
    files = []
    for j in range(70):
        stem = f"red blue alpha{j // 2 * 2:03d} alpha{(j + 5) % 80:03d}"
        files.append(dict(path=f"/{j:03d}", name=f"f{j}.pdf", stem=stem, meta_title="", origin=""))
    q, f = rows([tuple(r.values()) for r in queue], QUEUE), rows([tuple(r.values()) for r in files], FILES)
    got = {r.queue_no: (r.path, r.method, r.score) for r in linking.assign_one_to_one(q, f).collect()}
    assert got == brute(queue, files) and len(got) == 70
    assert sum(d.count() for d in made) < 1_000 and len(turns) == 1
