"""Multiple-choice items: normalising, prompts and answer extraction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from talkmill import fixed
from talkmill.functions import text as tx
from talkmill.functions.messages import message

OPEN, CLOSE = r"[\[,\{,\(]", r"[\],\},\)]"
NUMBER = r"-?[0-9]+\.?[0-9]*"
LETTER = f"{OPEN}[A-D]{CLOSE}"

# Fixed values: (pattern, characters cut in front, characters cut behind, keep letters only),
# tried in this order; the last match of the first pattern that occurs wins.
LETTER_RULES = [
    ("ANSWERIS" + LETTER * 4, 8, 0, True),
    ("ANSWERIS" + LETTER * 3, 8, 0, True),
    ("ANSWERIS" + LETTER * 2, 8, 0, True),
    (f"ANSWERIS{OPEN}[A-D]{{1,4}}{CLOSE}", 8, 0, True),
    ("ANSWER" + LETTER * 4, 6, 0, True),
    ("ANSWER" + LETTER * 3, 6, 0, True),
    ("ANSWER" + LETTER * 2, 6, 0, True),
    (f"ANSWER{OPEN}[A-D]{{1,4}}{CLOSE}", 6, 0, True),
    ("ANSWERIS[A-D]{1,4}", 8, 0, False),
    ("ANSWER[A-D]{1,4}", 6, 0, False),
    (LETTER * 4, 0, 0, True),
    (LETTER * 3, 0, 0, True),
    (LETTER * 2, 0, 0, True),
    (f"{OPEN}[A-D]+{CLOSE}", 1, 1, False),
]
NUMBER_RULES = [
    (f"ANSWERIS{OPEN}{NUMBER}{CLOSE}", 9, 1, False),
    (f"ANSWER{OPEN}{NUMBER}{CLOSE}", 7, 1, False),
    (f"ANSWERIS{NUMBER}", 8, 0, False),
    (f"ANSWER{NUMBER}", 6, 0, False),
    (f"{OPEN}{NUMBER}{CLOSE}", 1, 1, False),
]
# Text that reads as a floating-point number.
FLOAT = (
    r"(?i)^[+-]?(?:(?:\d(?:_?\d)*(?:\.(?:\d(?:_?\d)*)?)?|\.\d(?:_?\d)*)(?:e[+-]?\d(?:_?\d)*)?"
    r"|inf|infinity|nan)\z"
)
NO_ANSWER = "None"
MODES = ("MCQ", "MCQ(multiple)", "numeric")


def _drop(text: Column, *pieces: str) -> Column:
    for piece in pieces:
        text = F.replace(text, F.lit(piece), F.lit(""))
    return text


def _by_rule(text: Column, rule: tuple[str, int, int, bool]) -> Column:
    pattern, front, behind, letters_only = rule
    found = F.try_element_at(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.lit(-1))
    cut = F.substring(found, F.lit(front + 1), F.length(found) - front - behind)
    return F.regexp_replace(cut, f"[^{fixed.CHOICE_LETTERS}]", "") if letters_only else cut


def extract_answer(response: Column, mode: str = "MCQ") -> Column:
    """Answer given in a response: the last box, else a labelled letter, else
    the first rule that matches; 'None' when nothing does.  NULL where the
    labelled answer is blank, which counts as wrong."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")

    def boxed(piece: Column) -> Column:
        if mode == "MCQ":
            ok, value = piece.rlike(f"^[{fixed.CHOICE_LETTERS}]\\z"), F.upper(piece)
        elif mode == "MCQ(multiple)":
            ok, value = piece.rlike(f"^[{fixed.CHOICE_LETTERS}]*\\z"), F.upper(piece)
        else:
            ok, value = piece.rlike(FLOAT), piece
        return F.when(ok, value).otherwise(NO_ANSWER)

    box = F.substring_index(F.substring_index(response, "\\boxed{", -1), "}", 1)
    box = F.substring_index(_drop(tx.strip(box), " ", ","), "\\textbf{", -1)

    tail = F.regexp_replace(response, f"(?sU)^.*{fixed.ANSWER_LABEL}[{fixed.BLANKS}]*:", "")
    letter = F.substring(_drop(F.upper(tx.strip(tail)), " ", ","), 1, 1)
    labelled = F.when(letter == "", F.lit(None)).when(
        letter.rlike(f"^[{fixed.CHOICE_LETTERS}]\\z"), letter
    ).otherwise(NO_ANSWER)

    plain = _drop(F.upper(tx.strip(response)), " ", ",", "AND", ":")
    rules = NUMBER_RULES if mode == "numeric" else LETTER_RULES
    matched = tx.bind(plain, lambda t: F.coalesce(*[_by_rule(t, r) for r in rules], F.lit(NO_ANSWER)))

    return (
        F.when(F.contains(response, F.lit("\\boxed{")), tx.bind(box, boxed))
        .when(F.contains(response, F.lit(fixed.ANSWER_LABEL)), labelled)
        .otherwise(matched)
    )


def score(response: Column, answer: Column, mode: str = "MCQ") -> Column:
    """1 when the extracted answer is the right one, else 0 (also without a response)."""
    return F.coalesce((extract_answer(response, mode) == answer).cast("int"), F.lit(0))


def choice_text(choices: Column) -> Column:
    """One line per choice, lettered unless the first one already has a letter."""
    lettered = F.coalesce(F.get(choices, F.lit(0)).rlike(r"(?U)\b[A-D]\b"), F.lit(False))
    lines = F.transform(
        choices,
        lambda c, i: F.concat(
            F.when(lettered, F.lit("")).otherwise(F.concat(F.char(i + 65), F.lit(". "))), c, F.lit("\n")
        ),
    )
    return F.array_join(lines, "")


def answer_letter(answer: Column) -> Column:
    """Numbers become letters (0 -> A); letters become upper case."""
    letters = F.array(*[F.lit(x) for x in fixed.CHOICE_LETTERS])
    return F.coalesce(F.get(letters, answer.try_cast("int")), F.upper(answer))


def normalised_item(id_: Column, question: Column, choices: Column, answer: Column) -> list[Column]:
    return [
        id_.alias("id"),
        question.alias("mcq_question"),
        choice_text(choices).alias("choice"),
        answer_letter(answer).alias("answer"),
    ]


def grading_messages(question: Column, choice: Column) -> Column:
    """System and user message asking for the answer in a box."""
    body = F.concat(F.lit(fixed.GRADING_QUESTION), question, F.lit(fixed.GRADING_CHOICES), choice)
    return F.array(message("system", F.lit(fixed.GRADING_SYSTEM)), message("user", tx.strip(body)))
