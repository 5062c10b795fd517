import json

import pytest
from biblion.operators import documents
from biblion.plans import runs
from biblion.plans.runs import Manifest, Pause, StepResult

PLAN = ["read", "screen", "export"]


def test_selection():
    assert runs.selected(PLAN, first="screen") == ["screen", "export"] and runs.selected(PLAN, only="read") == ["read"]
    for bad in ({"first": "x"}, {"first": "export", "last": "read"}):
        with pytest.raises(ValueError):
            runs.selected(PLAN, **bad)


def test_resume_keeps_earlier_steps(tmp_path):
    out, path = tmp_path / "a.txt", str(tmp_path / "run.json")
    out.write_text("x")

    def pause():
        raise Pause("review.json")

    def fail():
        raise ValueError("no rows")

    steps = {"read": lambda: StepResult(counts={"rows": 3}, outputs=[str(out)]), "screen": fail, "export": StepResult}
    assert runs.run(PLAN, steps, Manifest(path)) == "failed"
    again = Manifest(path)
    assert again.resume_step(PLAN) == "screen" and again.steps[1]["error"] == "ValueError: no rows"
    assert len(again.steps[0]["outputs"][str(out)]) == 64
    steps["screen"] = pause
    assert runs.run(PLAN[1:], steps, again) == "paused"
    steps["screen"] = StepResult
    assert runs.run(PLAN[1:], steps, again) == "succeeded" and Manifest(path).resume_step(PLAN) is None
    assert [s["step"] for s in Manifest(path).steps] == ["read", "screen", "screen", "screen", "export"]
    (tmp_path / "review.json").write_text(json.dumps({"status": "approved"}))
    assert runs.approved(str(tmp_path / "review.json")) and not runs.approved(str(tmp_path / "none.json"))


def test_documents(spark):
    rows = [("p1", "B & C", "2020", "Doe, Jane; Roe, R", "10.1/a"), ("p2", "A", "2019", "Abe, J", "10.1/b"), ("p2", "A", "2019", "Abe, J", "10.1/b"), ("p3", "C", "", "Poe", "10.1/c")]
    df = documents.citable(spark.createDataFrame(rows, "paper_id string, title string, year string, authors string, doi string"))
    papers = [r.asDict() for r in documents.references(df).collect()]
    assert [(p["paper_id"], p["label"]) for p in papers] == [("p2", "Abe"), ("p1", "Doe and Roe")]
    assert [r.paper_id for r in documents.references(df, ["p1"]).collect()] == ["p1"]
    text = documents.repaired("As (Do and Roe, 2020) and (Abe, 2019) say.", papers)
    assert text == "As (Doe and Roe, 2020) and (Abe, 2019) say."
    with pytest.raises(ValueError):
        documents.repaired("(Nobody, 1999)", papers)
    assert documents.coverage_gaps("(Abe, 2019)", papers) == ["p1"] and documents.coverage_gaps("(Abe, 2019; Doe and Roe, 2020)", papers) == []
    assert "- Abe, J (2019). A. https://doi.org/10.1/b" in documents.markdown("T", [("S", text)], papers)
    tex = documents.latex("T & U", [("S", text + " 5%")], papers)
    assert "\\citep{p1}" in tex and "5\\%" in tex and "T \\& U" in tex
    assert "title = {B \\& C}" in documents.bibtex(papers)
