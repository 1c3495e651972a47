"""Chat formatting by schema fingerprints, in DataFrame functions alone.

A record is a variant of any layout. Its nested field paths, taken from the
variant's schema without scalar types and without fields that no layout knows
(nested up to four deep),
are hashed; the hash selects one of the declarative LAYOUTS, which says where
turns, roles and texts lie. All layouts become rows (conversation, order, role,
text); a record of no known layout becomes one row with role and text null that
carries the record as JSON, so that nothing is lost. Where a message's content is
a list of parts, its text joins them by an empty line, parts without text as
JSON; calls of tools follow the text as JSON, each on a line of its own.

The template writes a turn as

    <|im_start|>role newline text <|im_end|> newline

Inside roles and texts a backslash is doubled and "<|" becomes "<\\|", so no
text can hold a control string; a line end in a role becomes <|nl|>. Reading
back undoes both exactly. The loss mask lists the assistant texts by place.

A conversation is one row by definition of the output; its turns are gathered
after a window has summed their places, which spills. Null texts and roles are
empty; turns of one number go by place in the record, role and text; a null
conversation id is a conversation of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END, LINE = "<|im_start|>", "<|im_end|>\n", "<|nl|>"


@dataclass(frozen=True)
class Turn:
    """A turn of fixed role whose text joins the fields, those present and filled, by an empty line."""

    role: str
    fields: tuple[str, ...]


@dataclass(frozen=True)
class Layout:
    """paths: the record's shape, * for a scalar. Either ``each`` names a list of turns, or ``turns`` lists them."""

    name: str
    paths: str
    each: str | None = None
    role: str = ""
    text: str = ""
    turns: tuple[Turn, ...] = ()


def _pair(name: str, question: tuple[str, ...], answer: str, *others: str) -> list[Layout]:
    """A question and its answer, with and without the other fields and a system prompt."""
    out = []
    for system in ((), ("system",)):
        for more in ((), others) if others else ((),):
            paths = ", ".join(f"{f}: *" for f in sorted((*question, answer, *system, *more)))
            turns = (
                *((Turn("system", system),) if system else ()),
                Turn("user", (*question, *more)),
                Turn("assistant", (answer,)),
            )
            out.append(Layout(" ".join((name, *system, *more)), f"OBJECT<{paths}>", turns=turns))
    return out


LAYOUTS = [
    Layout("turn", "OBJECT<role: *, text: *>", role="$.role", text="$.text"),
    Layout("turn content", "OBJECT<content: *, role: *>", role="$.role", text="$.content"),
    Layout("messages", "OBJECT<messages: ARRAY<OBJECT<content: *, role: *>>>", "$.messages", "$.role", "$.content"),
    Layout("messages text", "OBJECT<messages: ARRAY<OBJECT<role: *, text: *>>>", "$.messages", "$.role", "$.text"),
    Layout("from value", "OBJECT<conversations: ARRAY<OBJECT<from: *, value: *>>>", "$.conversations", "$.from", "$.value"),
    Layout("dialog", "OBJECT<dialog: ARRAY<OBJECT<content: *, role: *>>>", "$.dialog", "$.role", "$.content"),
    Layout("no messages", "OBJECT<messages: ARRAY<*>>", "$.messages", "$.role", "$.content"),
    Layout("no conversations", "OBJECT<conversations: ARRAY<*>>", "$.conversations", "$.from", "$.value"),
    Layout("messages parts", "OBJECT<messages: ARRAY<OBJECT<content: ARRAY<OBJECT<text: *>>, role: *>>>", "$.messages", "$.role", "$.content"),
    Layout("messages other parts", "OBJECT<messages: ARRAY<OBJECT<content: ARRAY<OBJECT<>>, role: *>>>", "$.messages", "$.role", "$.content"),
    Layout("messages strings", "OBJECT<messages: ARRAY<OBJECT<content: ARRAY<*>, role: *>>>", "$.messages", "$.role", "$.content"),
    Layout("list", "ARRAY<OBJECT<content: *, role: *>>", "$", "$.role", "$.content"),
    Layout("list parts", "ARRAY<OBJECT<content: ARRAY<OBJECT<text: *>>, role: *>>", "$", "$.role", "$.content"),
    Layout("list from value", "ARRAY<OBJECT<from: *, value: *>>", "$", "$.from", "$.value"),
    *_pair("instruction", ("instruction",), "output", "input"),
    *_pair("instruction response", ("instruction",), "response", "context"),
    *_pair("prompt response", ("prompt",), "response"),
    *_pair("prompt completion", ("prompt",), "completion"),
    *_pair("question answer", ("question",), "answer", "context"),
    Layout("text", "OBJECT<text: *>", turns=(Turn("assistant", ("text",)),)),
]
#: Roles of some layouts under the names used here.
ROLES = {"human": "user", "gpt": "assistant", "model": "assistant", "bot": "assistant", "chatgpt": "assistant"}


def _known_fields() -> list[str]:
    words = " ".join(layout.paths for layout in LAYOUTS).replace("OBJECT", " ").replace("ARRAY", " ")
    return sorted(set("".join(c if c.isalnum() or c == "_" else " " for c in words).split()))


def nested_paths(record: Column) -> Column:
    """The record's field paths as one string: names in order, nesting, * for any scalar or null."""
    schema = F.schema_of_variant(record)
    scalars = r"(?<=[<: ])(?:VOID|STRING|BOOLEAN|BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DATE|BINARY|VARIANT|TIMESTAMP(?:_NTZ)?|UUID|DECIMAL\(\d+,\s?\d+\))(?=[,>]|$)"
    shape = F.regexp_replace(schema, scalars, "*")
    name = rf"(?<=[<, ])(?!(?:{'|'.join(_known_fields())}): )(?:`(?:[^`]|``)*`|[^\s,<>:`]+)"
    for _ in range(4):  # an unknown field goes once all within it has gone
        shape = F.regexp_replace(shape, rf"{name}: (?:\*|OBJECT<>|ARRAY<(?:\*|OBJECT<>)?>)(?:, )?", "")
        shape = F.regexp_replace(shape, r",\s*>", ">")
    return shape


def fingerprint(paths: Column) -> Column:
    return F.xxhash64(paths)


def _text(record: Column, path: str) -> Column:
    return F.coalesce(F.try_variant_get(record, path, "string"), F.lit(""))


#: Fields of a message that hold calls of tools.
CALLS = ("tool_calls", "function_call")


def _message_text(message: Column, path: str) -> Column:
    """Text of a message: its content, which may be a list of parts, and the calls that it makes."""
    parts = F.try_variant_get(message, path, "array<variant>")
    texts = F.transform(
        parts,
        lambda p: F.coalesce(
            F.try_variant_get(p, "$.text", "string"),
            F.when(F.schema_of_variant(p) == "STRING", F.try_variant_get(p, "$", "string")),
            F.to_json(p),
        ),
    )
    calls = [F.nullif(F.to_json(F.try_variant_get(message, f"$.{c}", "variant")), F.lit("null")) for c in CALLS]
    content = F.coalesce(F.array_join(texts, "\n\n"), _text(message, path))
    return F.array_join(F.filter(F.array(content, *calls), lambda x: x.isNotNull() & (x != "")), "\n")


def _role(role: Column) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])[role], role)


def _turns(layout: Layout, record: Column) -> Column:
    """Array of (role, text) that the layout's mapping gives."""
    if layout.each:
        items = F.try_variant_get(record, layout.each, "array<variant>")
        return F.transform(
            items, lambda x: F.struct(_role(_text(x, layout.role)).alias("role"), _message_text(x, layout.text).alias("text"))
        )
    if layout.turns:
        parts = []
        for turn in layout.turns:
            fields = F.filter(F.array(*[_text(record, f"$.{f}") for f in turn.fields]), lambda x: x != "")
            parts.append(F.struct(F.lit(turn.role).alias("role"), F.array_join(fields, "\n\n").alias("text")))
        return F.array(*parts)
    return F.array(F.struct(_text(record, layout.role).alias("role"), _text(record, layout.text).alias("text")))


def canonical_turns(records: DataFrame, conversation: str, order: str, record: str = "record") -> DataFrame:
    """Rows (conv_id, at, place, layout, role, text, raw) of all records, variants in any of LAYOUTS.

    ``order`` sorts the records of a conversation. A record of no known layout, or null, gives one row with layout,
    role and text null and the record itself, as JSON, in raw; a known one without turns gives none.
    """
    rows = records.select(
        F.col(conversation).alias("conv_id"), F.col(order).alias("at"), F.col(record).alias("record")
    ).withColumn("fingerprint", fingerprint(nested_paths(F.col("record"))))
    name, turns = None, None
    for layout in LAYOUTS:
        same = F.col("fingerprint") == fingerprint(F.lit(layout.paths))
        mapped = _turns(layout, F.col("record"))
        name = F.when(same, layout.name) if name is None else name.when(same, layout.name)
        turns = F.when(same, mapped) if turns is None else turns.when(same, mapped)
    unknown = F.array(F.struct(F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text")))
    raw = F.when(name.isNull(), F.to_json("record"))
    rows = rows.select("conv_id", "at", name.alias("layout"), raw.alias("raw"), turns.otherwise(unknown).alias("turns"))
    return rows.select("conv_id", "at", "layout", "raw", F.posexplode("turns").alias("place", "turn")).select(
        "conv_id", "at", "place", "layout", "turn.role", "turn.text", "raw"
    )


# --- template -------------------------------------------------------------------------------------


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def format_turns(turns: DataFrame, learn: str = "assistant") -> DataFrame:
    """One row for each conversation: conv_id, formatted, loss.

    turns: conv_id, at, place, role, text. loss lists the texts of role ``learn``, in order: start and length in
    characters of formatted, first_byte and n_bytes in its UTF-8.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.select(
        "conv_id",
        F.struct("at", "place", "role", "text").alias("order"),
        F.concat(F.lit(START), F.replace(escape(role), F.lit("\n"), F.lit(LINE)), F.lit("\n")).alias("head"),
        escape(text).alias("body"),
        (role == learn).alias("learnt"),
    )
    before = Window.partitionBy("conv_id").orderBy("order").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id").orderBy("order")

    def ahead(size) -> Column:
        past = F.sum(size("head") + size("body") + len(END)).over(before)
        return F.coalesce(past, F.lit(0)) + size("head")

    placed = rows.select(
        "conv_id",
        F.row_number().over(whole).alias("number"),
        F.concat("head", "body", F.lit(END)).alias("segment"),
        F.when(
            F.col("learnt"),
            F.struct(
                ahead(F.char_length).cast("long").alias("start"),
                F.char_length("body").cast("long").alias("length"),
                ahead(F.octet_length).cast("long").alias("first_byte"),
                F.octet_length("body").cast("long").alias("n_bytes"),
            ),
        ).alias("span"),
    )
    gathered = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("number", "segment", "span"))).alias("all"))
    return gathered.select(
        "conv_id",
        F.array_join(F.col("all.segment"), "").alias("formatted"),
        F.filter(F.col("all.span"), lambda s: s.isNotNull()).alias("loss"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns behind a formatted conversation: array of (role, text)."""
    parts = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda p: p != "")

    def turn(part: Column) -> Column:
        role = F.substring_index(part, "\n", 1)
        text = F.substr(part, F.char_length(role) + 2)
        role = F.replace(F.substr(role, F.lit(len(START) + 1)), F.lit(LINE), F.lit("\n"))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(parts, turn)


def read_loss(formatted: Column, loss: Column) -> Column:
    """The texts under the loss mask, unescaped, one after another; cut from the bytes, so long ones cost no more."""
    data = formatted.cast("binary")
    pieces = F.transform(
        F.array(data),
        lambda b: F.array_join(
            F.transform(
                loss, lambda s: unescape(F.decode(F.substring(b, (s["first_byte"] + 1).cast("int"), s["n_bytes"].cast("int")), "UTF-8"))
            ),
            "",
        ),
    )
    return pieces[0]


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars, read back from the output."""
    read = formatted.select(
        "conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("formatted"), F.col("loss")).alias("learnt")
    )
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(joined, 256).alias("turns_sha256"),
        F.char_length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
