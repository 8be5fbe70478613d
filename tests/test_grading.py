import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from talkmill.functions import grading as gr
from talkmill.operators import evaluation as ev


@pytest.mark.parametrize(
    "mode, cases",
    [
        (
            "MCQ",
            {
                "\\boxed{A}": "A",
                "x \\boxed{B} y \\boxed{ c }": "C",
                "\\boxed{\\textbf{D}": "D",
                "\\boxed{AB}": "None",
                "\\boxed{": "None",
                "Đáp án: b": "B",
                "Đáp án: ": None,
                "Đáp án: xyz": "None",
                "Đáp án là C. Đáp án : d vì": "D",
                "The answer is B": "B",
                "Answer: (C)": "C",
                "the answer is (A)(B)": "AB",
                "(A) ... (D)": "D",
                "(A)(B) then (C)": "AB",
                "answer A, B and C": "ABC",
                "no idea": "None",
                "": "None",
            },
        ),
        ("MCQ(multiple)", {"\\boxed{A, C}": "AC", "\\boxed{}": "", "\\boxed{A1}": "None", "answer is (AB)": "AB"}),
        (
            "numeric",
            {
                "\\boxed{3.5}": "3.5",
                "\\boxed{abc}": "None",
                "\\boxed{1,000}": "1000",
                "\\boxed{1e5}": "1e5",
                "\\boxed{5d}": "None",
                "answer is 42": "42",
                "the answer is (-7.5)": "-7.5",
                "answer 12 or (13)": "12",
                "(3) and [4]": "4",
                "(A)": "None",
            },
        ),
    ],
)
def test_extract(values, mode, cases):
    assert values(lambda t: gr.extract_answer(t, mode), *cases) == list(cases.values())


def model(text, numeric):
    """Rules in order; the last match of the first rule that occurs."""
    t = text.strip().upper()
    for piece in (" ", ",", "AND", ":"):
        t = t.replace(piece, "")
    o, c = r"[\[,\{,\(]", r"[\],\},\)]"
    n = r"-?[0-9]+\.?[0-9]*"
    one = o + "[A-D]" + c
    if numeric:
        table = [("ANSWERIS" + o + n + c, 9, 1), ("ANSWER" + o + n + c, 7, 1), ("ANSWERIS" + n, 8, 0), ("ANSWER" + n, 6, 0), (o + n + c, 1, 1)]
        for pattern, front, behind in table:
            found = re.findall(pattern, t)
            if found:
                return found[-1][front : len(found[-1]) - behind]
        return "None"
    for lead in ("ANSWERIS", "ANSWER"):
        for pattern in (one * 4, one * 3, one * 2, o + "[A-D]{1,4}" + c):
            found = re.findall(lead + pattern, t)
            if found:
                return re.sub("[^A-F]", "", found[-1][len(lead) :])
    for lead in ("ANSWERIS", "ANSWER"):
        found = re.findall(lead + "[A-D]{1,4}", t)
        if found:
            return found[-1][len(lead) :]
    for pattern in (one * 4, one * 3, one * 2):
        found = re.findall(pattern, t)
        if found:
            return re.sub("[^A-F]", "", found[-1])
    found = re.findall(o + "[A-D]+" + c, t)
    return found[-1][1:-1] if found else "None"


PIECES = st.sampled_from(["answer", " is ", "(A)", "[B]", "{C}", "(AB)", "B", "D", "7", "-3.5", "(4)", " and ", ": ", ",", "x", "("])


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(PIECES, max_size=8).map("".join), min_size=30, max_size=80))
def test_rules_like_model(values, texts):
    assert values(lambda t: gr.extract_answer(t, "MCQ"), *texts) == [model(t, False) for t in texts]
    assert values(lambda t: gr.extract_answer(t, "numeric"), *texts) == [model(t, True) for t in texts]


def test_normalise(values):
    ddl = "c array<string>"
    got = values(gr.choice_text, (["1", "2"],), (["A. 1", "B. 2"],), (["1"] * 6,), (["Ab", "b"],), ddl=ddl)
    assert got == ["A. 1\nB. 2\n", "A. 1\nB. 2\n", "A. 1\nB. 1\nC. 1\nD. 1\nE. 1\nF. 1\n", "A. Ab\nB. b\n"]
    assert values(gr.answer_letter, "0", "3", "d", "B") == ["A", "D", "D", "B"]


def test_prompt(values):
    got = values(gr.grading_messages, ("1+1?", "A. 2\nB. 3\n"), ddl="q string, c string")[0]
    assert [m["role"] for m in got] == ["system", "user"]
    assert got[1]["content"] == "Câu hỏi:\n1+1?\n\nCác lựa chọn:\nA. 2\nB. 3"
    assert "\\boxed{A}" in got[0]["content"]


def test_missing_and_failed_responses_score_zero(spark):
    questions = spark.createDataFrame(
        [("q1", "What is 1+1?", "A. 2\nB. 3", "A"), ("q2", "Capital?", "A. London\nC. Paris", "C")],
        "id string, mcq_question string, choice string, answer string",
    )
    responses = spark.createDataFrame(
        [("q1", 1, "\\boxed{A}"), ("q2", 1, "\\boxed{E}"), ("q1", 2, "Đáp án: ")], "id string, round int, response string"
    )
    got = {(r["id"], r["round"]): r for r in ev.grade(questions, responses, rounds=2).collect()}
    assert {k: r["score"] for k, r in got.items()} == {("q1", 1): 1, ("q2", 1): 0, ("q1", 2): 0, ("q2", 2): 0}
    assert got[("q2", 2)]["response"] is None and got[("q2", 2)]["question"] == "Capital?"
    assert got[("q1", 1)]["question"] == "What is 1+1?\n\nA. 2\nB. 3"


def test_accuracy(spark):
    scores = spark.createDataFrame(
        [("x", 1, s) for s in (1, 0, 1)] + [("x", 2, s) for s in (1, 1, 0)], "dataset string, round int, score int"
    )
    assert round(ev.accuracy(scores, "dataset").first()["accuracy"], 3) == 66.667
    per = spark.createDataFrame([("a", 50.0), ("b", 100.0)], "dataset string, accuracy double")
    assert ev.macro_mean(per).first()[0] == 75.0


def test_champions(spark):
    rows = [("m", 1, 50.0), ("m", 2, 70.0), ("m", 3, 70.0), ("lone", 1, 0.0)]
    scored = spark.createDataFrame(rows, "model string, version int, mean_score double")
    got = {(r["model"], r["alias"]): r["version"] for r in ev.champions(scored, "mean_score").collect()}
    assert got == {("m", "champion"): 2, ("m", "challenger"): 3, ("lone", "champion"): 1}
