"""Markdown clean-up as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from talkmill.functions.text import bind

FENCE = "```"


def unwrap_newlines(text: Column) -> Column:
    """Single newlines inside sentences become blanks; list and table lines stay."""
    # Starts with the newline itself, so that the search skips to newlines.
    joined = F.regexp_replace(text, r"\n(?<!\n\n)(?![\n\-*|])", " ")
    return F.replace(F.replace(joined, F.lit("** _"), F.lit("**_")), F.lit("_ **"), F.lit("_**"))


def normalise_markdown(text: Column) -> Column:
    """Blanks collapsed and newlines unwrapped outside closed code fences."""

    def tidy(t: Column) -> Column:
        return unwrap_newlines(F.regexp_replace(t, " {2,}", " "))

    def by_fence(pieces: Column) -> Column:
        # Odd pieces are inside a fence; the last piece is never closed.
        return F.array_join(
            F.transform(
                pieces,
                lambda p, i: F.when((i % 2 == 1) & (i < F.size(pieces) - 1), p).otherwise(tidy(p)),
            ),
            FENCE,
        )

    return F.when(F.contains(text, F.lit(FENCE)), bind(F.split(text, FENCE, -1), by_fence)).otherwise(
        tidy(text)
    )


def repair_tables(text: Column) -> Column:
    """Outer pipes for the lines of tables and a blank line after each table.

    A table starts at a line followed by a divider line with as many pipes and
    runs while lines have pipes.  Every line ends in a newline.
    """

    def pipes(line: Column) -> Column:
        return F.length(line) - F.length(F.replace(line, F.lit("|"), F.lit("")))

    def repair(lines: Column) -> Column:
        facts = F.transform(
            lines,
            lambda line, i: F.struct(
                (pipes(line) > 0).alias("piped"),
                (
                    (pipes(line) > 0)
                    & F.coalesce(
                        (pipes(F.get(lines, i + 1)) == pipes(line))
                        & F.get(lines, i + 1).rlike(r"^[ \-:|]*$"),
                        F.lit(False),
                    )
                ).alias("header"),
            ),
        )
        # One character per line: 1 inside a table, 0 outside; a leading 0 for
        # the line before the first.
        flags = F.aggregate(
            facts,
            F.lit("0"),
            lambda acc, f: F.concat(
                acc,
                F.when(f["piped"] & (f["header"] | F.endswith(acc, F.lit("1"))), F.lit("1")).otherwise(
                    F.lit("0")
                ),
            ),
        )
        return bind(flags, lambda fl: render(lines, fl))

    def render(lines: Column, flags: Column) -> Column:
        rows = F.transform(
            lines,
            lambda line, i: F.when(
                F.substring(flags, i + 2, F.lit(1)) == "1",
                F.concat(
                    F.lit("| "),
                    line,
                    F.lit("|\n"),
                    F.when(F.substring(flags, i + 3, F.lit(1)) == "1", F.lit("")).otherwise(F.lit("\n")),
                ),
            ).otherwise(F.concat(line, F.lit("\n"))),
        )
        return F.array_join(rows, "")

    has_divider = F.contains(text, F.lit("|")) & text.rlike(r"(?m)^[ \-:]*\|[ \-:|]*$")
    return F.when(has_divider, bind(F.split(text, "\n", -1), repair)).otherwise(
        F.concat(text, F.lit("\n"))
    )


def clean_markdown(text: Column) -> Column:
    return normalise_markdown(repair_tables(text))
