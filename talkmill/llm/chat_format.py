"""Chat formatting: records of different layouts become canonical turns by
the fingerprint of their schema, and turns become template text.

A layout's fingerprint is the hash of its nested field paths.  A registry maps
fingerprints to declarative mappings (where the id, the order, the role and
the text of a turn are); nothing is guessed from values.  A table's layout is
its schema's; records in JSON may each have a layout of their own, and are
fingerprinted one by one.  The canonical form
has one row for each turn, so no conversation is gathered.  Formatting and
reading back work on single turns as well.  Only a digest over a whole
conversation needs its turns in order: they stream through a task, and memory
holds one turn at a time.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkmill.llm.common import ship_package

TURN = "conv_id long, turn long, role string, text string"


def field_paths(schema: T.DataType, above: str = "") -> list[str]:
    """Paths of all leaves: ``messages[].role:string``.  Whole numbers of any
    width are one type."""
    if isinstance(schema, T.StructType):
        return [p for f in schema.fields for p in field_paths(f.dataType, f"{above}.{f.name}" if above else f.name)]
    if isinstance(schema, T.ArrayType):
        return field_paths(schema.elementType, f"{above}[]")
    whole = isinstance(schema, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    return [f"{above}:{'bigint' if whole else schema.simpleString()}"]


def fingerprint(paths: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


@dataclass(frozen=True)
class Mapping:
    """Where the turns of a layout are.

    ``paths``: the fields that make up the layout.  ``turns``: the array that
    holds turns, or None.  ``role`` and ``text``: fields of a turn (of the
    array's elements, or of the row itself).  ``fixed``: instead, the turns of
    a row as (role, fields joined by a blank line), an empty system turn
    left out.  ``order``: the field that orders a flat row's turns.
    """

    name: str
    paths: tuple[str, ...]
    conv_id: str = "conv_id"
    turns: str | None = None
    role: str | None = None
    text: str | None = None
    order: str | None = None
    fixed: tuple[tuple[str, tuple[str, ...]], ...] = ()
    roles: dict[str, str] = field(default_factory=dict, hash=False)


SPEAKERS = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

MAPPINGS = (
    Mapping("turn rows", ("conv_id:bigint", "turn:bigint", "role:string", "text:string"), role="role", text="text", order="turn"),
    Mapping("messages", ("conv_id:bigint", "messages[].role:string", "messages[].content:string"), turns="messages", role="role", text="content"),
    Mapping("from and value", ("conv_id:bigint", "conversations[].from:string", "conversations[].value:string"), turns="conversations", role="from", text="value", roles=SPEAKERS),
    Mapping("prompt and completion", ("conv_id:bigint", "prompt:string", "completion:string"), fixed=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping("prompt and response", ("conv_id:bigint", "prompt:string", "response:string"), fixed=(("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping("instruction", ("conv_id:bigint", "instruction:string", "input:string", "output:string"), fixed=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Mapping(
        "system and instruction",
        ("conv_id:bigint", "system:string", "instruction:string", "input:string", "output:string"),
        fixed=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",))),
    ),
    Mapping("question and answer", ("conv_id:bigint", "question:string", "answer:string"), fixed=(("user", ("question",)), ("assistant", ("answer",)))),
)
REGISTRY = {fingerprint(list(m.paths)): m for m in MAPPINGS}


def mapping_for(schema: T.StructType, registry: dict[str, Mapping] = REGISTRY) -> Mapping:
    """The mapping of a schema, by the hash of all its paths; if there are
    further fields, the mapping with most paths among those all of whose paths
    the schema has."""
    paths = field_paths(schema)
    exact = registry.get(fingerprint(paths))
    if exact is not None:
        return exact
    fitting = [m for m in registry.values() if set(m.paths) <= set(paths)]
    if not fitting:
        raise ValueError(f"no mapping for a layout with {', '.join(sorted(paths))}")
    return max(fitting, key=lambda m: len(m.paths))


def canonical_turns(records: DataFrame, registry: dict[str, Mapping] = REGISTRY) -> DataFrame:
    """``conv_id, turn, role, text``: one row for each turn.

    Null roles are "", null texts are "".  Turns of an array are numbered from
    0.  An empty or null array gives no turn, an empty table none at all.
    Fields that the mapping does not name are left out.
    """
    m = mapping_for(records.schema, registry)
    conv = F.col(f"`{m.conv_id}`").cast("long").alias("conv_id")
    if m.fixed:
        turns = [
            F.struct(
                F.lit(role).alias("role"),
                F.concat_ws("\n\n", *(F.when(F.col(f"`{c}`") != "", F.col(f"`{c}`")) for c in columns)).alias("text"),
            )
            for role, columns in m.fixed
        ]
        given = F.filter(F.array(*turns), lambda t: (t["role"] != "system") | (t["text"] != ""))
        rows = records.select(conv, F.posexplode(given).alias("turn", "t")).select("conv_id", F.col("turn").cast("long"), "t.role", "t.text")
    elif m.turns:
        rows = records.select(conv, F.posexplode(f"`{m.turns}`").alias("turn", "t"))
        rows = rows.select("conv_id", F.col("turn").cast("long"), F.col(f"t.{m.role}").alias("role"), F.col(f"t.{m.text}").alias("text"))
    else:
        rows = records.select(conv, F.col(f"`{m.order}`").cast("long").alias("turn"), F.col(f"`{m.role}`").alias("role"), F.col(f"`{m.text}`").alias("text"))
    role = F.col("role")
    if m.roles:
        role = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in m.roles.items() for x in kv)), role), role)
    return rows.select("conv_id", "turn", F.coalesce(role, F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def variant_paths(schema: str) -> list[str]:
    """Field paths of what ``schema_of_variant`` says of a record; a null, or
    the elements of an empty array, may be of any type."""
    at, out = 0, []

    def read(above: str) -> None:
        nonlocal at
        head = re.compile(r"OBJECT<|ARRAY<|[A-Z_]+(?:\([^)]*\))?").match(schema, at)
        at = head.end()
        if head[0] == "OBJECT<":
            while schema[at] != ">":
                name = re.compile(r"`((?:[^`]|``)*)`: |((?:(?!: ).)*): ").match(schema, at)
                at = name.end()
                own = name[1].replace("``", "`") if name[1] is not None else name[2]
                read(f"{above}.{own}" if above else own)
                if schema.startswith(", ", at):
                    at += 2
            at += 1
        elif head[0] == "ARRAY<":
            read(f"{above}[]")
            at += 1
        elif head[0] != "OBJECT":
            out.append(f"{above}:{head[0].lower()}")

    read("")
    return out


def _names(paths) -> frozenset[str]:
    return frozenset(p.rsplit(":", 1)[0] for p in paths)


def record_mapping(paths: list[str], registry: dict[str, Mapping] = REGISTRY) -> Mapping | None:
    """The mapping whose field names a record has, by the hash of the names:
    all of them, or else as many as any other mapping that it has in full.  A
    null array counts as having the fields of its elements."""
    names = _names(paths)
    hollow = {p.rsplit(":", 1)[0].removesuffix("[]") for p in paths if p.endswith(":void")}
    exact = {fingerprint(sorted(_names(m.paths))): m for m in registry.values()}.get(fingerprint(sorted(names)))
    if exact is not None:
        return exact

    def has(name: str) -> bool:
        return name in names or name.split("[]")[0] in hollow

    fitting = [m for m in registry.values() if all(map(has, _names(m.paths)))]
    return max(fitting, key=lambda m: len(m.paths)) if fitting else None


def _schema_of(m: Mapping) -> str:
    """A mapping's fields as DDL."""
    if m.turns:
        return f"`{m.conv_id}` bigint, `{m.turns}` array<struct<`{m.role}`: string, `{m.text}`: string>>"
    return ", ".join(f"`{p.rsplit(':', 1)[0]}` {p.rsplit(':', 1)[1]}" for p in m.paths)


#: Layouts that a table of records may have, wholly different ones.
LAYOUTS = 10_000


def canonical_records(records: DataFrame, column: str, registry: dict[str, Mapping] = REGISTRY) -> DataFrame:
    """``conv_id, turn, role, text`` of records in JSON, each of which may have
    another layout.

    A record's layout is the fingerprint of its own field paths.  The distinct
    layouts reach the driver, ``LAYOUTS`` at most; each one's mapping then
    reads the records that have it, all in one pass.  Records that are no
    JSON object, or whose layout no mapping fits, are an error that names the
    layout.  Else as ``canonical_turns``.
    """
    parsed = records.select(F.col(f"`{column}`").cast("string").alias("r")).where("r is not null")
    shaped = parsed.withColumn("layout", F.coalesce(F.schema_of_variant(F.try_parse_json("r")), F.lit("")))
    layouts = [r["layout"] for r in shaped.select("layout").distinct().limit(LAYOUTS + 1).collect()]
    if len(layouts) > LAYOUTS:
        raise ValueError(f"more than {LAYOUTS} layouts")
    by_mapping: dict[str, list[str]] = {}
    for layout in layouts:
        m = record_mapping(variant_paths(layout), registry) if layout.startswith("OBJECT<") else None
        if m is None:
            raise ValueError(f"no mapping for records of the layout {layout or 'that is no JSON'}")
        by_mapping.setdefault(m.name, []).append(layout)
    named = {m.name: m for m in registry.values()}
    whole = records.sparkSession.createDataFrame([], TURN)
    for name, own in by_mapping.items():
        m = named[name]
        rows = shaped.where(F.col("layout").isin(own)).select(F.from_json("r", _schema_of(m)).alias("r")).select("r.*")
        whole = whole.unionByName(canonical_turns(rows, {fingerprint(field_paths(rows.schema)): m}))
    return whole


@dataclass(frozen=True)
class Template:
    """``open role after_role text close``; ``control`` strings are escaped
    inside roles and texts.

    One backslash more goes behind the first character of a control string,
    also of one that has backslashes there already, so taking one out again
    gives back every text.
    """

    open: str = "<|im_start|>"
    after_role: str = "\n"
    close: str = "<|im_end|>\n"
    control: tuple[str, ...] = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]")
    trained: tuple[str, ...] = ("assistant",)

    def patterns(self) -> list[tuple[str, str]]:
        """First characters of control strings, and what can follow each."""
        heads = sorted({c[0] for c in self.control})
        return [(h, "|".join(re.escape(c[1:]) for c in self.control if c[0] == h)) for h in heads]

    def escape(self, text: Column) -> Column:
        for head, rest in self.patterns():
            text = F.regexp_replace(text, f"({re.escape(head)})(\\\\*)({rest})", r"$1\\$2$3")
        return text

    def unescape(self, text: str) -> str:
        for head, rest in self.patterns():
            text = re.sub(rf"({re.escape(head)})\\(\\*)({rest})", r"\1\2\3", text)
        return text

    def escape_role(self, role: Column) -> Column:
        """A role is one line: backslashes and line ends are escaped too."""
        return self.escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))

    def unescape_role(self, role: str) -> str:
        return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], self.unescape(role))

    def read(self, piece: str) -> tuple[str, str]:
        """Role and text of the formatted text of a turn."""
        if not (piece.startswith(self.open) and piece.endswith(self.close)):
            raise ValueError("not a formatted turn")
        role, _, text = piece[len(self.open) : len(piece) - len(self.close)].partition(self.after_role)
        return self.unescape_role(role), self.unescape(text)


def formatted_turns(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """``conv_id, turn, formatted, loss_from, loss_to``: the text of each turn
    and the code points of it that are trained on (empty for other roles).
    The formatted conversation is its turns' texts one after the other."""
    head = F.concat(F.lit(template.open), template.escape_role(F.col("role")), F.lit(template.after_role))
    body = template.escape(F.col("text"))
    rows = turns.select("conv_id", "turn", "role", head.alias("head"), body.alias("body"))
    begin = F.length("head").cast("long")
    trained = F.col("role").isin(*template.trained)
    return rows.select(
        "conv_id", "turn", F.concat("head", "body", F.lit(template.close)).alias("formatted"),
        begin.alias("loss_from"), F.when(trained, begin + F.length("body")).otherwise(begin).alias("loss_to"),
    )


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digests(template: Template):
    def run(batches):
        """Rows come sorted by conversation, so one digest is open at a time."""
        names = [c.split()[0] for c in DIGESTS.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        now, done = None, []

        def close() -> None:
            if now is not None:
                conv, n, turns, loss_chars, loss, chars = now
                done.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))

        def flush() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)
            done.clear()
            return rows

        for batch in batches:
            for conv, formatted, begin, end in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_from", "loss_to"))):
                if now is None or now[0] != conv:
                    close()
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = template.read(formatted)
                now[1] += 1
                now[2].update(f"{role}\n{text}\n".encode())
                if end > begin:
                    trained = template.unescape(formatted[begin:end])
                    now[3] += len(trained)
                    now[4].update(trained.encode())
                now[5] += len(formatted)
            if len(done) > 1000:
                yield flush()
        close()
        if done:
            yield flush()

    return run


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars`` per conversation, from the formatted text alone.

    Turns are taken by their number, then (repeated numbers) by their text;
    null numbers come first; rows with a null conv_id are one conversation.
    An empty table gives no row.
    """
    ship_package(formatted.sparkSession)
    columns = ("conv_id", "turn", "formatted", "loss_from", "loss_to")
    laid = formatted.select(*columns).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
    return laid.drop("turn").mapInArrow(_digests(template), DIGESTS)


def format_conversations(*layouts: DataFrame, template: Template = Template()) -> DataFrame:
    """Formatted turns of records of any layouts that the registry knows."""
    turns = [canonical_turns(records) for records in layouts]
    whole = turns[0]
    for more in turns[1:]:
        whole = whole.unionByName(more)
    return formatted_turns(whole, template)
