"""Chat formatting: records of many layouts become one template with a loss mask.

A record is read into one struct that has every field some layout knows. The nested paths
that hold a value are hashed in order; this fingerprint selects the declarative mapping that
turns the record into (role, text) turns. All of it is column expressions.

The template is ``<|im_start|>role\\ntext<|im_end|>\\n``. In a text, one more backslash goes
between ``<`` and ``|`` wherever only backslashes stand between them, so no text can hold a
marker and the change can be undone. In a role, backslash, line feed and ``<`` become ``\\s``,
``\\n`` and ``\\l``.

Defined results
    null text or role       counts as empty
    very long text          formatted whole; a conversation is one row and must fit one
    ties, repeated rows     rows of one turn number go by role, then text; each is a turn
    no known layout         ``layout`` null, no turns, empty output
    empty table             empty result
    clashing extra columns  ``gather_turns`` reads four columns; records keep only ``keep``,
                            and fields that no layout knows have no influence
"""

from dataclasses import dataclass
from functools import reduce
from hashlib import sha256
from itertools import chain, combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MESSAGES = "array<struct<role:string,content:string>>"
_SHARED = "array<struct<from:string,value:string>>"
_TURNS = "array<struct<turn:bigint,role:string,text:string>>"

# The fields that the layouts below read.
FIELDS = {
    "turns": _TURNS,
    "messages": _MESSAGES,
    "conversations": _SHARED,
    "system": "string",
    "instruction": "string",
    "input": "string",
    "output": "string",
    "prompt": "string",
    "completion": "string",
    "response": "string",
    "question": "string",
    "answer": "string",
}

START, END = "<|im_start|>", "<|im_end|>\n"
TURN_TYPE = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Each:
    """One turn per element of an array field; roles not named stay as they are."""

    field: str
    role: str
    text: str
    names: tuple[tuple[str, str], ...] = ()

    def turns(self) -> Column:
        def turn(x):
            role = F.coalesce(x[self.role], F.lit(""))
            for name, canonical in self.names:
                role = F.when(x[self.role] == name, F.lit(canonical)).otherwise(role)
            return F.struct(role.alias("role"), F.coalesce(x[self.text], F.lit("")).alias("text"))

        return F.transform(F.col(f"__record.{self.field}"), turn)


@dataclass(frozen=True)
class One:
    """One turn from the fields that hold a value, with an empty line between them."""

    role: str
    fields: tuple[str, ...]
    optional: bool = False

    def turns(self) -> Column:
        values = [F.col(f"__record.{f}") for f in self.fields]
        turn = F.array(F.struct(F.lit(self.role).alias("role"), F.concat_ws("\n\n", *values).alias("text")))
        if not self.optional:
            return turn
        present = reduce(lambda a, b: a | b, [v.isNotNull() for v in values])
        return F.when(present, turn).otherwise(F.array().cast(TURN_TYPE))


@dataclass(frozen=True)
class Layout:
    name: str
    required: tuple[str, ...]
    optional: tuple[str, ...]
    parts: tuple[Each | One, ...]

    def turns(self) -> Column:
        return F.concat(*[part.turns() for part in self.parts])

    def fingerprints(self) -> list[str]:
        some = chain.from_iterable(combinations(self.optional, n) for n in range(len(self.optional) + 1))
        return [fingerprint_of(self.required + chosen) for chosen in some]


_SYSTEM = One("system", ("system",), optional=True)
_NAMES = (("human", "user"), ("gpt", "assistant"))

LAYOUTS = (
    Layout("turn rows", ("turns",), ("turns[].turn", "turns[].role", "turns[].text"), (Each("turns", "role", "text"),)),
    Layout("messages", ("messages",), ("messages[].role", "messages[].content", "system"), (_SYSTEM, Each("messages", "role", "content"))),
    Layout("shared", ("conversations",), ("conversations[].from", "conversations[].value", "system"), (_SYSTEM, Each("conversations", "from", "value", _NAMES))),
    Layout("instruction", ("instruction", "output"), ("input", "system"), (_SYSTEM, One("user", ("instruction", "input")), One("assistant", ("output",)))),
    Layout("completion", ("prompt", "completion"), ("system",), (_SYSTEM, One("user", ("prompt",)), One("assistant", ("completion",)))),
    Layout("response", ("prompt", "response"), ("system",), (_SYSTEM, One("user", ("prompt",)), One("assistant", ("response",)))),
    Layout("question", ("question", "answer"), ("system",), (_SYSTEM, One("user", ("question",)), One("assistant", ("answer",)))),
)


# --- fingerprints -------------------------------------------------------------------


def nested_paths() -> list[str]:
    """All paths of ``FIELDS``, in order."""
    paths = []
    for name, kind in FIELDS.items():
        paths.append(name)
        element = T.DataType.fromDDL(kind)
        if isinstance(element, T.ArrayType):
            paths += [f"{name}[].{f.name}" for f in element.elementType.fields]
    return sorted(paths)


def fingerprint_of(paths: tuple[str, ...]) -> str:
    return sha256("\n".join(sorted(paths)).encode()).hexdigest()


def _holds(path: str) -> Column:
    field, _, inner = path.partition("[].")
    column = F.col(f"__record.{field}")
    return F.exists(column, lambda x: x[inner].isNotNull()) if inner else column.isNotNull()


def fingerprint() -> Column:
    """Hash of the record's nested paths that hold a value."""
    present = [F.when(_holds(path), F.lit(path)) for path in nested_paths()]
    return F.sha2(F.concat_ws("\n", *present).cast("binary"), 256)


# --- records ------------------------------------------------------------------------


def gather_turns(rows: DataFrame, conv_id="conv_id", turn="turn", role="role", text="text") -> DataFrame:
    """A table with a row per turn as one record per conversation."""
    element = F.struct(F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    grouped = rows.groupBy(F.col(conv_id).alias("conv_id")).agg(F.sort_array(F.collect_list(element)).alias("turns"))
    return grouped


def from_table(records: DataFrame, keep: list[str]) -> DataFrame:
    """Typed columns as records. A column counts as a field if its type can be read as such."""
    fields = []
    for name, kind in FIELDS.items():
        wanted = T.DataType.fromDDL(kind)
        have = records.schema[name].dataType if name in records.columns else None
        fits = have is not None and _fits(have, wanted)
        fields.append((_shaped(F.col(name), wanted) if fits else F.lit(None).cast(wanted)).alias(name))
    return records.select(*keep, F.struct(*fields).alias("__record"))


def _fits(have: T.DataType, wanted: T.DataType) -> bool:
    if isinstance(wanted, T.ArrayType):
        return isinstance(have, T.ArrayType) and isinstance(have.elementType, T.StructType) and {
            f.name for f in wanted.elementType.fields
        } <= set(have.elementType.names)
    return isinstance(have, T.StringType)


def _shaped(column: Column, wanted: T.DataType) -> Column:
    if not isinstance(wanted, T.ArrayType):
        return column
    fields = wanted.elementType.fields
    return F.transform(column, lambda x: F.struct(*[x[f.name].cast(f.dataType).alias(f.name) for f in fields]))


def from_json(records: DataFrame, json: str, keep: list[str]) -> DataFrame:
    """A column of JSON text as records; text that is no object has no known layout."""
    schema = ", ".join(f"`{name}` {kind}" for name, kind in FIELDS.items())
    return records.select(*keep, F.from_json(json, schema).alias("__record"))


# --- template -----------------------------------------------------------------------


def escape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    for plain, escaped in (("\\", r"\s"), ("\n", r"\n"), ("<", r"\l")):
        role = F.replace(role, F.lit(plain), F.lit(escaped))
    return role


def unescape_role(role: Column) -> Column:
    for plain, escaped in (("<", r"\l"), ("\n", r"\n"), ("\\", r"\s")):
        role = F.replace(role, F.lit(escaped), F.lit(plain))
    return role


def format_chats(records: DataFrame, trained: str = "assistant") -> DataFrame:
    """Records as ``layout``, ``segments`` (text, under the loss mask or not) and ``formatted``.

    ``records`` come from ``from_table`` or ``from_json``. The segments joined are the output.
    """
    kept = [c for c in records.columns if c != "__record"]
    marked = records.withColumn("__print", fingerprint())
    layout, turns = F.lit(None).cast("string"), F.array().cast(TURN_TYPE)
    for known in LAYOUTS:
        chosen = F.col("__print").isin(known.fingerprints())
        layout = F.when(chosen, F.lit(known.name)).otherwise(layout)
        turns = F.when(chosen, known.turns()).otherwise(turns)
    canonical = marked.select(*kept, layout.alias("layout"), turns.alias("__turns"))

    def segments(turn):
        head = F.concat(F.lit(START), escape_role(turn["role"]), F.lit("\n"))
        cells = [(head, F.lit(False)), (escape_text(turn["text"]), turn["role"] == trained), (F.lit(END), F.lit(False))]
        return F.array(*[F.struct(text.alias("text"), loss.alias("loss")) for text, loss in cells])

    split = canonical.select(*kept, "layout", F.flatten(F.transform("__turns", segments)).alias("segments"))
    return split.select(*split.columns, F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"))


def read_turns(formatted: Column) -> Column:
    """The (role, text) turns of an output."""
    def turn(part):
        role = F.substring_index(part, "\n", 1)
        after = F.char_length(role) + 1
        text = F.substring(part, after + 1, F.char_length(part) - after - len(END))
        return F.struct(unescape_role(role).alias("role"), unescape_text(text).alias("text"))

    parts = F.split(formatted, START.replace("|", r"\|"))
    return F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), turn)


def read_loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape_text(s["text"])), "")
