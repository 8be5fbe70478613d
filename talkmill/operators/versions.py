"""Document versions: newest, n-th, navigation, restore, differences, spans;
and data versions with a high-water mark."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkmill import fixed
from talkmill.functions import alignment
from talkmill.operators.ordered import ordered_scan
from talkmill.session import join_facts, ship_package, stage

SENTENCE = r"[^.!?]+[.!?]*\s*"


#: Types whose values are whole numbers of 64 bits.
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _packed(documents: DataFrame, order: list[str]) -> Column | None:
    """Two order columns as one decimal that sorts alike: a time, day or whole
    number of 32 bits, and a whole number.  Nulls sort first.  None for other
    types."""
    if len(order) != 2:
        return None
    first, second = (documents.schema[c].dataType for c in order)
    if not isinstance(second, WHOLE):
        return None
    if isinstance(first, (T.TimestampType, T.TimestampNTZType)):
        # Micros, whatever the session's time zone: it only has to sort.
        high = F.unix_micros(F.col(order[0]).cast("timestamp"))
    elif isinstance(first, T.DateType):
        high = F.unix_date(order[0]).cast("bigint")
    elif isinstance(first, (T.ByteType, T.ShortType, T.IntegerType)):
        high = F.col(order[0]).cast("bigint")
    else:
        return None

    def whole(value: int) -> Column:
        return F.lit(str(value)).cast("decimal(38,0)")

    # Below any time: 2^62 microseconds are 146,000 years.
    high = F.coalesce(high, F.lit(-(2**62))).cast("decimal(19,0)") * F.lit(str(2**64)).cast("decimal(20,0)")
    low = F.coalesce(F.col(order[1]).cast("bigint"), F.lit(-(2**63))).cast("decimal(38,0)") + whole(2**63)
    return (high.cast("decimal(38,0)") + low).cast("decimal(38,0)")


def latest(documents: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The newest version of every document.  Only the key and the order
    columns are aggregated; (key, order) is unique.

    A time and a whole number are one decimal, whose maximum a hash aggregate
    can hold; other orders are compared as a struct, in one aggregate as well.
    """
    packed = _packed(documents, order)
    if packed is None:
        newest = documents.groupBy(key).agg(F.max(F.struct(*order)).alias("_newest")).select(key, "_newest.*")
        return join_facts(documents, newest, [key, *order], "left_semi").select(documents.columns)
    marked = documents.withColumn("_packed", packed)
    newest = marked.groupBy(key).agg(F.max("_packed").alias("_packed"))
    return join_facts(marked, newest, [key, "_packed"], "left_semi").select(documents.columns)


def numbered(documents: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``version_no`` from 1 in time order."""
    return ordered_scan(documents, [key], [F.col(c) for c in order], row_number="version_no")


def nth_time(documents: DataFrame, key: str, order: list[str], index: int, now: datetime) -> DataFrame:
    """Time of version ``index`` (from 0) of every document; ``now`` past the end."""
    versions = numbered(documents.select(key, *order), key, order)
    return versions.groupBy(key).agg(
        F.coalesce(
            F.max(F.when(F.col("version_no") == index + 1, F.col(order[0]))),
            F.lit(now).cast(documents.schema[order[0]].dataType),
        ).alias("version_time")
    )


def navigation(documents: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``version_no, prev_time, is_latest`` of every version."""
    scanned = ordered_scan(
        documents,
        [key],
        [F.col(c) for c in order],
        row_number="version_no",
        lags={"prev_time": order[0]},
    )
    totals = documents.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return (
        join_facts(scanned, totals, key).withColumn("is_latest", F.col("version_no") == F.col("_n")).drop("_n")
    )


def restore(documents: DataFrame, key: str, order: list[str], index: int) -> DataFrame:
    """Documents with the versions after number ``index`` (from 0) removed.
    Only the keys are numbered; contents are joined back on (key, order)."""
    kept = numbered(documents.select(key, *order), key, order).filter(F.col("version_no") <= index + 1)
    return documents.join(kept, [key, *order])


def delete_newer(
    documents: DataFrame, suggestions: DataFrame, marks: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents left, suggestions left, documents deleted).

    ``marks`` has one row ``id, keep_until`` per document; versions strictly
    newer are deleted with their suggestions.
    """
    doc_newer = (F.col("d.id") == F.col("m.id")) & (F.col("d.createdAt") > F.col("m.keep_until"))
    sug_newer = (F.col("s.documentId") == F.col("m.id")) & (
        F.col("s.documentCreatedAt") > F.col("m.keep_until")
    )
    d, s, m = documents.alias("d"), suggestions.alias("s"), stage(marks, "marks").alias("m")
    return (
        d.join(m, doc_newer, "left_anti"),
        s.join(m, sug_newer, "left_anti"),
        d.join(m, doc_newer, "left_semi"),
    )


def sentences(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(SENTENCE), F.lit(0))


def _against_previous(documents: DataFrame, key: str, order: list[str], content: str) -> DataFrame:
    """``key, order, version_no, new, old`` and ``prev_*`` of the order columns:
    hashes of each version's sentences beside those of the version before.
    Only these narrow rows are put in order; texts stay where they are."""
    hashes = F.transform(sentences(F.coalesce(content, F.lit(""))), lambda s: F.xxhash64(s))
    narrow = documents.select(key, *order, hashes.alias("new"))
    lags = {"old": "new", **{f"prev_{c}": c for c in order}}
    scanned = ordered_scan(narrow, [key], [F.col(c) for c in order], row_number="version_no", lags=lags)
    return scanned.withColumn("old", F.coalesce("old", F.array().cast("array<bigint>")))


def sentence_changes(documents: DataFrame, key: str, order: list[str], content: str) -> DataFrame:
    """``added`` and ``removed`` sentences of every version against the one
    before it (as sets; ``edit_script`` has the sequence).

    Hashes of the sentences decide.  Then each text is read once: for the
    sentences that its own version added, and for those that the next one
    removed, which go to that version's row.
    """
    scanned = _against_previous(documents, key, order, content)
    facts = stage(
        scanned.select(
            key, *order, "version_no", *[f"prev_{c}" for c in order],
            F.array_except("new", "old").alias("_added"), F.array_except("old", "new").alias("_removed"),
        ),
        "changes",
    )
    own = facts.drop("_removed", *[f"prev_{c}" for c in order])
    following = facts.filter("version_no > 1").select(
        key, *[F.col(f"prev_{c}").alias(c) for c in order], *[F.col(c).alias(f"_next_{c}") for c in order], "_removed"
    )
    wanted = own.join(following, [key, *order], "left")
    read = documents.join(wanted, [key, *order]).withColumn("_said", sentences(F.coalesce(content, F.lit(""))))

    def among(hashes: str) -> Column:
        return F.array_distinct(F.filter("_said", lambda s: F.array_contains(hashes, F.xxhash64(s))))

    gone = read.filter(F.size("_removed") > 0).select(key, *[F.col(f"_next_{c}").alias(c) for c in order], among("_removed").alias("removed"))
    rows = read.select(*documents.columns, "version_no", among("_added").alias("added"))
    return rows.join(gone, [key, *order], "left").select(
        *documents.columns, "version_no", "added", F.coalesce("removed", F.array().cast("array<string>")).alias("removed")
    )


def edit_script(documents: DataFrame, key: str, order: list[str], content: str) -> DataFrame:
    """``key, order, position, kind, sentence``: the sentences of every version
    but the first, in order, against the version before: ``kept``,
    ``removed`` or ``inserted``.  Kept and inserted sentences give the new
    text, kept and removed ones the old (as far as it consists of sentences).
    A moved sentence is removed and inserted; a doubled one is inserted.

    (key, order) is unique; a null text is the empty text.  The alignment
    (``functions.alignment``) works on hashes of one version pair at a time;
    texts are read once, for the positions that the scripts name.
    """
    ship_package(documents.sparkSession)
    scanned = _against_previous(documents, key, order, content).filter("version_no > 1").drop("version_no")
    kept = [c for c in scanned.columns if c not in ("new", "old")]
    fields = [scanned.schema[c] for c in kept] + [T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("kinds", "places")]
    scripts = stage(scanned.mapInArrow(alignment.aligned_rows(kept), T.StructType(fields)), "scripts")
    steps = F.arrays_zip(F.sequence(F.lit(0), F.size("kinds") - 1).alias("position"), F.col("kinds"), F.col("places"))
    items = F.when(F.size("kinds") > 0, steps)

    def part(kinds: list[int], version: str) -> DataFrame:
        """Steps whose sentence stands in this or in the previous version."""
        chosen = F.filter(items, lambda x: x["kinds"].isin(kinds))
        target = [F.col(c).alias(f"_own_{c}") for c in order]
        rows = scripts.select(key, *[F.col(f"{version}{c}").alias(c) for c in order], *target, chosen.alias("_steps"))
        return rows.filter(F.size("_steps") > 0)

    wanted = part([alignment.KEPT, alignment.INSERTED], "").unionByName(part([alignment.REMOVED], "prev_"))
    texts = documents.select(key, *order, F.col(content).alias("_content"))
    read = texts.join(wanted, [key, *order]).withColumn("_said", sentences("_content"))
    flat = read.select(key, *[F.col(f"_own_{c}").alias(c) for c in order], "_said", F.explode("_steps").alias("_step"))
    names = F.element_at(F.array(*[F.lit(n) for n in alignment.KINDS]), F.col("_step.kinds") + 1)
    return flat.select(
        key, *order, F.col("_step.position").alias("position"), names.alias("kind"), F.element_at("_said", F.col("_step.places") + 1).alias("sentence")
    )


def suggestion_spans(suggestions: DataFrame, documents: DataFrame) -> DataFrame:
    """``selection_start, selection_end`` of the original text in the exact
    document version; (0, 0) when it is not there."""
    version = documents.select(
        F.col("id").alias("documentId"), F.col("createdAt").alias("documentCreatedAt"), "content"
    )
    at = F.position(F.col("originalText"), F.col("content"))
    found = at > 0
    return suggestions.join(version, ["documentId", "documentCreatedAt"]).withColumns(
        {
            "selection_start": F.when(found, at - 1).otherwise(0).cast("bigint"),
            "selection_end": F.when(found, at - 1 + F.length("originalText")).otherwise(0).cast("bigint"),
        }
    ).drop("content")


def since_version(
    rows: DataFrame,
    versions: DataFrame,
    version: float,
    column: str = "timestamp",
    epoch: datetime = datetime(1970, 1, 1),
) -> DataFrame:
    """Rows newer than the mark of a data version (``epoch`` without one)."""
    kind = rows.schema[column].dataType
    mark = versions.filter(F.col("version_number") == version).agg(
        F.coalesce(F.max("timestamp").cast(kind), F.lit(epoch).cast(kind)).alias("mark")
    )
    return rows.filter(F.col(column) > mark.scalar())


def latest_version(versions: DataFrame) -> DataFrame:
    return versions.orderBy(F.col("version_number").desc()).limit(1)


def retrain_check(new_rows: DataFrame, threshold: int = fixed.NEW_ROWS_THRESHOLD) -> DataFrame:
    """One row ``new_records, is_train`` (strictly more than the threshold)."""
    n = F.count(F.lit(1))
    return new_rows.agg(n.alias("new_records"), (n > threshold).alias("is_train"))


def next_version_row(last_version: float, new_records: int, now: datetime, query: str) -> tuple:
    """Row of the version table: number, query, time, record count, status."""
    return (last_version + 1.0, query, now, new_records, "PENDING")


VERSION_SCHEMA = (
    "version_number double, query_logic string, timestamp timestamp, record_count bigint, training_status string"
)
