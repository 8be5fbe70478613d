"""Batch text generation through a callable, with failures kept per row."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkmill.functions import batches as bt
from talkmill.functions import messages as ms
from talkmill.functions import text as tx
from talkmill.session import ship_package


def respond(
    prompts: DataFrame, make_generator: Callable[[], Callable[[str], str]], prompt: str = "prompt"
) -> DataFrame:
    """Prompt rows with ``response`` and ``failure``.

    ``make_generator`` is called once per task and gives the function from
    prompt to response; an exception becomes the row's failure.  A task holds
    a bounded stretch of prompts and responses, however many rows its batches
    have; the other columns stay out of Python.
    """

    def run(prompts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        generator = make_generator()

        def one(text: str) -> tuple[str | None, str | None]:
            try:
                return generator(text), None
            except Exception as error:  # one bad row must not fail the task
                return None, f"{type(error).__name__}: {error}"

        for texts in prompts:
            for low, n in bt.by_size(texts):
                answers = [one(t) for t in texts.slice(low, n).to_pylist()]
                parts = [pa.array([a[k] for a in answers], pa.string()) for k in range(2)]
                del answers
                yield pa.StructArray.from_arrays(parts, names=["response", "failure"])

    ship_package(prompts.sparkSession)
    # Not deterministic: a generator must not be called again for a filter.
    answer = F.arrow_udf(run, "response string, failure string").asNondeterministic()
    rows = prompts.withColumn("_answer", answer(F.col(prompt)))
    return rows.select(*[F.col(f"`{c}`") for c in prompts.columns], "_answer.response", "_answer.failure")


def document_prompt(time, content):
    """The text a document is presented with."""
    return F.concat(F.lit("Ngày đăng: "), time, F.lit("\n\n Nội dung: "), content)


def generate_pairs(documents: DataFrame, make_generator, key: str = "link") -> DataFrame:
    """One call per document whose response holds questions and answers:
    ``key, pairs, failure``; unreadable responses fail."""
    asked = documents.select(key, document_prompt(F.col("time"), F.col("content")).alias("prompt"))
    answered = respond(asked, make_generator).withColumn("pairs", ms.parse_qa(F.col("response")))
    failure = F.coalesce("failure", F.when(F.col("pairs").isNull(), "template"))
    return answered.select(key, "pairs", failure.alias("failure"))


def generate_pairs_by_question(documents: DataFrame, make_asker, make_answerer, key: str = "link") -> DataFrame:
    """First call: questions of a document; questions that need their source are
    left out; then one call per question: ``key, position, question, answer,
    failure``.  A document whose first call fails gives one failure row."""
    text = document_prompt(F.col("time"), F.col("content"))
    asked = respond(documents.select(key, text.alias("prompt")), make_asker)
    questions = asked.filter(F.col("failure").isNull()).select(
        key, F.col("prompt").alias("text"), F.posexplode(ms.parse_questions(F.col("response"))).alias("position", "question")
    )
    kept = questions.filter(~tx.needs_context(F.col("question")))
    prompts = kept.withColumn("prompt", F.concat("text", F.lit("\n\n"), "question")).drop("text")
    answers = respond(prompts, make_answerer).select(
        key, "position", "question", F.col("response").alias("answer"), "failure"
    )
    failed = asked.filter(F.col("failure").isNotNull()).select(
        key,
        F.lit(None).cast("int").alias("position"),
        F.lit(None).cast("string").alias("question"),
        F.lit(None).cast("string").alias("answer"),
        "failure",
    )
    return answers.unionByName(failed)


def outcomes(pairs: DataFrame, key: str = "link") -> DataFrame:
    """``key, succeeded`` for marking the sources: a non-empty result without a
    failure."""
    return pairs.select(
        key, (F.col("failure").isNull() & (F.coalesce(F.size("pairs"), F.lit(0)) > 0)).alias("succeeded")
    )
