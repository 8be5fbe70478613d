"""Chat-store queries: pages, deletes, votes, quotas, visibility."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkmill import fixed
from talkmill.operators.ordered import ordered_scan
from talkmill.session import join_facts, range_partitions, stage


class UnknownCursor(ValueError):
    """The cursor row of a keyset page does not exist."""


def lookup(rows: DataFrame, column: str, value) -> DataFrame:
    """Rows with one key value."""
    return rows.filter(F.col(column) == F.lit(value))


def in_time_order(messages: DataFrame, chat_id, created: str = "createdAt") -> DataFrame:
    return lookup(messages, "chatId", chat_id).orderBy(created)


def keyset_page(
    chats: DataFrame,
    user_id,
    limit: int,
    starting_after=None,
    ending_before=None,
    *,
    user: str = "userId",
    key: str = "id",
    created: str = "createdAt",
) -> tuple[DataFrame, bool]:
    """(page, has_more): the user's newest chats, optionally newer
    (``starting_after``) or older (``ending_before``) than a cursor chat.
    """
    if starting_after is not None and ending_before is not None:
        raise ValueError("give one cursor at most")
    mine = chats.filter(F.col(user) == F.lit(user_id))
    cursor = starting_after if starting_after is not None else ending_before
    if cursor is not None:
        at = chats.filter(F.col(key) == F.lit(cursor)).select(created).take(1)
        if not at:
            raise UnknownCursor(str(cursor))
        edge = F.lit(at[0][0])
        mine = mine.filter(F.col(created) > edge if starting_after is not None else F.col(created) < edge)
    fetched = mine.orderBy(F.col(created).desc(), F.col(key).desc()).limit(limit + 1)
    has_more = fetched.count() > limit
    return fetched.limit(limit), has_more


def next_cursor(page: DataFrame, has_more: bool, key: str = "id", created: str = "createdAt"):
    """Key of the last row of a page, or None at the end."""
    if not has_more:
        return None
    last = page.orderBy(F.col(created).asc(), F.col(key).asc()).select(key).take(1)
    return last[0][0] if last else None


def all_pages(
    chats: DataFrame,
    limit: int = fixed.CHAT_PAGE_SIZE,
    *,
    user: str = "userId",
    key: str = "id",
    created: str = "createdAt",
) -> DataFrame:
    """Every user's pages at once: ``rn, page, has_more``, newest first."""
    numbered = ordered_scan(
        chats, [user], [F.col(created).desc(), F.col(key).desc()], row_number="rn"
    )
    totals = chats.groupBy(user).agg(F.count(F.lit(1)).alias("_n"))
    page = F.floor((F.col("rn") - 1) / limit)
    return (
        join_facts(numbered, totals, user)
        .withColumn("page", page)
        .withColumn("has_more", F.col("_n") > (F.col("page") + 1) * limit)
        .drop("_n")
    )


def write_pages(chats: DataFrame, path: str, limit: int = fixed.CHAT_PAGE_SIZE, **columns: str) -> None:
    """Store every user's pages so that a cursor finds its page by a seek: the
    chats by file parts that hold whole pages, and an index with one row per
    page: ``userId, page, first_key, last_key, has_more, part``.

    Pages are what ``all_pages`` says.  A user's pages are spread over as many
    parts as needed; a page lies in one part.
    """
    user, key = columns.get("user", "userId"), columns.get("key", "id")
    paged = all_pages(chats, limit, **columns)
    spark = chats.sparkSession
    placed = paged.repartitionByRange(range_partitions(spark), user, "page").sortWithinPartitions(user, "rn")
    placed.withColumn("part", F.spark_partition_id()).write.partitionBy("part").parquet(f"{path}/chats")
    stored = spark.read.schema(T.StructType([*paged.schema.fields, T.StructField("part", T.IntegerType())])).parquet(f"{path}/chats")
    index = stored.groupBy(F.col(user).alias("userId"), "page").agg(
        F.min_by(key, "rn").alias("first_key"), F.max_by(key, "rn").alias("last_key"), F.max("has_more").alias("has_more"), F.max("part").alias("part")
    )
    index.repartitionByRange("userId", "page").sortWithinPartitions("userId", "page").write.parquet(f"{path}/index")


def open_page(spark: SparkSession, path: str, user_id, cursor=None, *, user: str = "userId") -> tuple[DataFrame, object]:
    """(page, next cursor): the user's first page, or the one after the page
    that ends with ``cursor``; the next cursor is None on the last page.  The
    index is sorted, so its scan skips other users; of the chats only the
    page's part is opened.  A user without chats has one empty page."""
    index = spark.read.parquet(f"{path}/index").filter(F.col("userId") == F.lit(user_id))
    number = 0
    if cursor is not None:
        at = index.filter(F.col("last_key") == F.lit(cursor)).select("page").take(1)
        if not at:
            raise UnknownCursor(str(cursor))
        number = at[0][0] + 1
    stored = spark.read.parquet(f"{path}/chats")
    found = index.filter(F.col("page") == number).take(1)
    if not found:
        return stored.limit(0).drop("part"), None
    page = stored.filter((F.col("part") == found[0]["part"]) & (F.col(user) == F.lit(user_id)) & (F.col("page") == number))
    return page.drop("part"), found[0]["last_key"] if found[0]["has_more"] else None


def walk_pages(spark: SparkSession, path: str, user_id, *, user: str = "userId") -> Iterator[DataFrame]:
    """A user's pages one after the other, from cursor to cursor."""
    cursor = None
    while True:
        page, cursor = open_page(spark, path, user_id, cursor, user=user)
        yield page
        if cursor is None:
            return


def messages_of(messages: DataFrame, chats: DataFrame, chat_key: str = "id") -> DataFrame:
    """Messages (or votes) of a set of chats."""
    keys = chats.select(F.col(chat_key).alias("chatId")).distinct()
    return join_facts(messages, keys, "chatId", "left_semi")


def delete_after(
    messages: DataFrame, votes: DataFrame, chat_id, since: datetime
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(messages left, votes left, messages deleted) after deleting a chat's
    messages from ``since`` on, with their votes."""
    doomed = (F.col("chatId") == F.lit(chat_id)) & (F.col("createdAt") >= F.lit(since))
    deleted = messages.filter(doomed)
    gone = deleted.select(F.col("id").alias("messageId"), "chatId")
    return messages.filter(~doomed), votes.join(gone, ["chatId", "messageId"], "left_anti"), deleted


def cascade_delete(
    chats: DataFrame, messages: DataFrame, votes: DataFrame, doomed: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(chats, messages, votes) left and the deleted chats; ``doomed`` has the
    chat ids in ``id``."""
    ids = stage(doomed.select("id").distinct(), "doomed")
    chat_ids = ids.withColumnRenamed("id", "chatId")
    return (
        chats.join(ids, "id", "left_anti"),
        messages.join(chat_ids, "chatId", "left_anti"),
        votes.join(chat_ids, "chatId", "left_anti"),
        chats.join(ids, "id", "left_semi"),
    )


def latest_votes(votes: DataFrame, order: list[str]) -> DataFrame:
    """One vote per message: the last one by ``order``."""
    latest = F.max(F.struct(*order, "chatId", "isUpvoted")).alias("v")
    return votes.groupBy("messageId").agg(latest).select("messageId", "v.chatId", "v.isUpvoted")


def upsert_votes(stored: DataFrame, incoming: DataFrame, order: list[str]) -> DataFrame:
    """Stored votes overwritten by the latest incoming one of each message.  A
    stored vote changes only when the chat is the same too."""
    new = latest_votes(incoming, order)
    old, fresh = stored.alias("o"), new.alias("n")
    joined = old.join(fresh, F.col("o.messageId") == F.col("n.messageId"), "full_outer")
    same_chat = F.col("o.chatId").isNull() | (F.col("o.chatId") == F.col("n.chatId"))
    return joined.select(
        F.coalesce("o.messageId", "n.messageId").alias("messageId"),
        F.coalesce("o.chatId", "n.chatId").alias("chatId"),
        F.when(same_chat & F.col("n.messageId").isNotNull(), F.col("n.isUpvoted"))
        .otherwise(F.col("o.isUpvoted"))
        .alias("isUpvoted"),
    )


def vote_of_answers(messages: DataFrame, votes: DataFrame, order: list[str]) -> DataFrame:
    """Votes of assistant messages, the first vote of each message."""
    first = votes.groupBy("messageId").agg(F.min(F.struct(*order, "isUpvoted")).alias("v"))
    answers = messages.filter(F.col("role") == "assistant").select(F.col("id").alias("messageId"), "chatId")
    return answers.join(first, "messageId").select("messageId", "chatId", "v.isUpvoted")


def message_counts(
    messages: DataFrame, chats: DataFrame, now: datetime, hours: int = fixed.QUOTA_HOURS
) -> DataFrame:
    """User messages per user in the trailing window.  Messages are counted per
    chat before the join, so a busy chat is one row by then."""
    since = now - timedelta(hours=hours)
    per_chat = (
        messages.filter((F.col("role") == "user") & (F.col("createdAt") >= F.lit(since)))
        .groupBy("chatId")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    owners = chats.select(F.col("id").alias("chatId"), "userId")
    return per_chat.join(owners, "chatId").groupBy("userId").agg(F.sum("n").alias("n_messages"))


def quota_limit(user_type: Column) -> Column:
    limit = F.lit(None).cast("int")
    for name, value in fixed.CHAT_QUOTA.items():
        limit = F.when(user_type == name, value).otherwise(limit)
    return limit


def over_quota(counts: DataFrame, user_type: str = "user_type", count: str = "n_messages") -> DataFrame:
    """Users with more messages than their type allows."""
    limited = counts.withColumn("quota", quota_limit(F.col(user_type)))
    return limited.filter(F.col(count) > F.col("quota"))


def recency(created: Column, now: datetime) -> Column:
    """today, yesterday, lastWeek, lastMonth or older, seen from ``now``."""
    at = F.lit(now).cast("timestamp_ntz")
    day = F.datediff(F.to_date(at), F.to_date(created))
    month_ago = F.lit(now).cast("timestamp_ntz") - F.expr("INTERVAL 1 MONTH")
    return (
        F.when(day == 0, "today")
        .when(day == 1, "yesterday")
        .when(created > at - F.expr("INTERVAL 7 DAYS"), "lastWeek")
        .when(created > month_ago, "lastMonth")
        .otherwise("older")
    )


def visible_to(rows: DataFrame, user_id: Column) -> DataFrame:
    """Public rows and the user's own."""
    return rows.filter((F.col("visibility") == "public") | (F.col("userId") == user_id))


def set_visibility(chats: DataFrame, chat_ids: DataFrame, visibility: str) -> DataFrame:
    """``visibility`` set on the chats whose ``id`` is listed."""
    listed = chat_ids.select("id").distinct().withColumn("_hit", F.lit(True))
    changed = F.when(F.col("_hit"), visibility).otherwise(F.col("visibility"))
    return join_facts(chats, listed, "id", "left").withColumn("visibility", changed).drop("_hit")


def request_faults(text: Column, role: Column, content_types: Column) -> Column:
    """Names of the rules a posted message breaks; empty for a valid one."""
    chars = F.coalesce(F.length(text), F.lit(0))
    faults = F.array(
        F.when(~chars.between(1, fixed.MAX_MESSAGE_CHARS), "length"),
        F.when(~F.coalesce(role == "user", F.lit(False)), "role"),
        F.when(
            F.exists(
                F.coalesce(content_types, F.array().cast("array<string>")),
                lambda t: ~F.coalesce(t.isin(fixed.IMAGE_TYPES), F.lit(False)),
            ),
            "attachment",
        ),
    )
    return F.array_compact(faults)
