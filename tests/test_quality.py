"""Checks on hand-made tables."""

from screenline.operators import quality as q


def test_validate_runs_the_checks_its_tables_allow(spark, rows):
    second = rows(
        [("r", 1, "a", "advance_to_import"), ("r", 1, "b", "advance_to_import"), ("r", 1, "c", "stop"), ("r", 1, " ", "stop")],
        "run_id string, pass_number int, paper_id string, promotion_decision string",
    )
    imports = rows([("r", 1, "a"), ("r", 1, "d")], "run_id string, pass_number int, paper_id string")
    got = q.validate({"second_pass": second, "import_status": imports}).where("check = 'import_ids'").collect()
    assert {(r.item, r.detail) for r in got} == {("b", "missing"), ("d", "extra")}


def test_difference_is_symmetric(spark, rows):
    a = rows([("r", 1, "a"), ("r", 1, "b"), ("r", 1, None)], "run_id string, pass_number int, paper_id string")
    b = rows([("r", 1, "b"), ("s", 1, "b"), ("r", 1, "")], "run_id string, pass_number int, paper_id string")
    swap = {"missing": "extra", "extra": "missing"}
    one = {(r.run_id, r.paper_id, r.side) for r in q.id_difference(a, b).collect()}
    two = {(r.run_id, r.paper_id, swap[r.side]) for r in q.id_difference(b, a).collect()}
    assert one == two == {("r", "a", "missing"), ("s", "b", "extra")}


def test_column_quality_examples(spark, rows):
    d = rows([("r", 1, v) for v in ["yes", "no", "maybe", "maybe", "odd", "", None, "x1", "x2", "x3", "x4"]], "run_id string, pass_number int, c string")
    r = q.column_quality(d, {"c": ("yes", "no")}).first()
    assert (r.blank_count, r.invalid_count) == (2, 7)
    assert r.examples == ["maybe", "odd", "x1", "x2", "x3"]
