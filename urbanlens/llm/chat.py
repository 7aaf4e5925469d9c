"""Chat formatting: records of any known layout into one template, natively.

A record is JSON text, or a struct (the rows of a turn table, see
``records_of``).  Its *layout* is the nested field paths it has, in
order, without the values; the hash of that is its fingerprint.  A struct has
the layout of its type and is never written as JSON, so neither limit of
Spark's JSON variants (20,000,000 characters a text, 128 MiB a record) holds
for it.  ``MAPPINGS``
declares, by an example record each, how a layout becomes canonical turns
(role, text): an array of messages, or fields in a fixed order.  The
fingerprint of a row selects its mapping; rows of other layouts come back
with no turns and their fingerprint, so that a mapping can be added.

The template of a turn is

    <|im_start|>ROLE\\nTEXT<|im_end|>\\n

and nothing else.  ``&`` and ``<|`` inside roles and texts (and line ends in
roles) are escaped, so control strings in a text can't open or close a turn,
and reading the output back gives the exact texts.  The loss mask is a list
of segments whose texts joined are the output; those under loss are exactly
the escaped assistant texts.

Only DataFrame functions are used: no Python runs in the tasks.

Defined results: null text is empty, null role is empty; a record that isn't
JSON, or null, has no layout (fingerprint null) and no turns; JSON text beyond
those limits is an error, not a record without turns; a record
without turns gives the empty output; equal turn numbers are ordered by role,
then text; repeated rows are repeated turns.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>"
TURNS = "array<struct<role:string,text:string>>"
#: Shorter JSON texts are within the limits of variants.
SAFE_BYTES = 16_000_000


@dataclass(frozen=True)
class Mapping:
    """How records laid out as ``example`` become turns.

    Either ``messages`` (JSON path of an array) with the names of its role and
    text fields, or ``fields``: (role, JSON paths whose texts are joined by a
    blank line) in order; fields that are empty in a record make no turn if
    ``skip_empty`` names their role.
    """

    name: str
    example: str
    messages: str = ""
    role: str = ""
    text: str = ""
    roles: dict = field(default_factory=dict)
    fields: tuple = ()
    skip_empty: tuple = ("system",)

    def turns(self, get: Callable[[str, str], Column]) -> Column:
        """``get`` (JSON path, type) gives a record's value; structs inside an array keep their own type."""
        if self.messages:
            got = get(self.messages, f"array<struct<`{self.role}`:string,`{self.text}`:string>>")

            def one(m: Column) -> Column:
                said = m[self.role].cast("string")
                role = F.coalesce(said, F.lit(""))
                for known, canonical in self.roles.items():
                    role = F.when(said == known, F.lit(canonical)).otherwise(role)
                return F.struct(role.alias("role"), F.coalesce(m[self.text].cast("string"), F.lit("")).alias("text"))

            return F.transform(got, one)
        parts = []
        for role, paths in self.fields:
            texts = [F.coalesce(get(p, "string"), F.lit("")) for p in paths]
            text = texts[0] if len(texts) == 1 else F.array_join(
                F.filter(F.array(*texts), lambda t: t != ""), "\n\n")
            parts.append(F.struct(F.lit(role).alias("role"), text.alias("text")))
        return F.filter(F.array(*parts), lambda t: ~(t["role"].isin(*self.skip_empty) & (t["text"] == "")))


_SHARED = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

#: The layouts known by default.
MAPPINGS = (
    Mapping("messages", '{"messages":[{"role":"r","content":"c"}]}', "$.messages", "role", "content", _SHARED),
    Mapping("system_messages", '{"system":"s","messages":[{"role":"r","content":"c"}]}', "$.messages", "role",
            "content", _SHARED),
    Mapping("conversations", '{"conversations":[{"from":"f","value":"v"}]}', "$.conversations", "from", "value",
            _SHARED),
    Mapping("prompt_response", '{"prompt":"p","response":"r"}',
            fields=(("user", ("$.prompt",)), ("assistant", ("$.response",)))),
    Mapping("prompt_completion", '{"prompt":"p","completion":"c"}',
            fields=(("user", ("$.prompt",)), ("assistant", ("$.completion",)))),
    Mapping("question_answer", '{"question":"q","answer":"a"}',
            fields=(("user", ("$.question",)), ("assistant", ("$.answer",)))),
    Mapping("instruction_output", '{"instruction":"i","output":"o"}',
            fields=(("user", ("$.instruction",)), ("assistant", ("$.output",)))),
    Mapping("instruction_input_output", '{"instruction":"i","input":"x","output":"o"}',
            fields=(("user", ("$.instruction", "$.input")), ("assistant", ("$.output",)))),
    Mapping("system_instruction_output", '{"system":"s","instruction":"i","output":"o"}',
            fields=(("system", ("$.system",)), ("user", ("$.instruction",)), ("assistant", ("$.output",)))),
)


def layout(v: Column) -> Column:
    """The nested field paths of a variant: its schema (fields sorted by name) without the leaf types."""
    return F.regexp_replace(F.schema_of_variant(v), r"(?<=[:<] ?)(STRING|VOID|BIGINT|DOUBLE|FLOAT|BOOLEAN|"
                            r"DECIMAL\(\d+,\d+\)|DATE|TIMESTAMP(_NTZ)?|BINARY)", "_")


def fingerprint(v: Column) -> Column:
    return F.substring(F.sha2(layout(v), 256), 1, 16)


def _beyond_limits(record: Column, v: Column) -> Column:
    """Whether JSON text failed to parse for its size alone."""
    whole = F.from_json(record, "wrong string", {"columnNameOfCorruptRecord": "wrong", "maxStringLen": str(2**31 - 1)})
    return v.isNull() & (F.octet_length(record) > SAFE_BYTES) & whole["wrong"].isNull()


def _mapped(mark: Column, get: Callable[[str, str], Column],
            mappings: tuple[Mapping, ...]) -> tuple[Column, Column]:
    """Name and turns by the mapping whose example has the fingerprint ``mark``."""
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for m in reversed(mappings):
        known = mark == fingerprint(F.parse_json(F.lit(m.example)))
        name = F.when(known, F.lit(m.name)).otherwise(name)
        turns = F.when(known, m.turns(get)).otherwise(turns)
    return name, turns


def _json_turns(record: Column, mappings: tuple[Mapping, ...]) -> tuple[Column, Column, Column]:
    v = F.try_parse_json(record)
    mark = fingerprint(v)
    name, turns = _mapped(mark, lambda path, kind: F.try_variant_get(v, path, kind), mappings)
    error = F.raise_error(F.lit("JSON record beyond the limits of a variant (20,000,000 characters a text, 128 MiB)"))
    return mark, name, F.when(_beyond_limits(record, v), error.cast(TURNS)).otherwise(turns)


def _sample(kind: T.DataType):
    """A value of the type, as :func:`json.dumps` takes it."""
    if isinstance(kind, T.StructType):
        return {f.name: _sample(f.dataType) for f in kind.fields}
    return [_sample(kind.elementType)] if isinstance(kind, T.ArrayType) else ""


def _struct_turns(record: Column, kind: T.StructType,
                  mappings: tuple[Mapping, ...]) -> tuple[Column, Column, Column]:
    def get(path: str, wanted: str) -> Column:
        """The field at ``path``; null where the type has none such, as in a variant."""
        out, at = record, kind
        for name in path.removeprefix("$.").split("."):
            if not isinstance(at, T.StructType) or name not in at.names:
                return F.lit(None).cast(wanted)
            out, at = out.getField(name), at[name].dataType
        if wanted == "string":
            return out.cast(wanted)
        inner = at.elementType if isinstance(at, T.ArrayType) else None
        names = T.DataType.fromDDL(wanted).elementType.names
        held = isinstance(inner, T.StructType) and set(names) <= set(inner.names)
        return out if held else F.lit(None).cast(wanted)

    mark = F.when(record.isNotNull(), fingerprint(F.parse_json(F.lit(json.dumps(_sample(kind))))))
    return mark, *_mapped(mark, get, mappings)


def canonical_turns(record: Column, mappings: tuple[Mapping, ...] = MAPPINGS,
                    kind: T.DataType | None = None) -> tuple[Column, Column, Column]:
    """(fingerprint, mapping name, turns) of a column of JSON texts, or of structs of type ``kind``."""
    if isinstance(kind, T.StructType):
        mark, name, turns = _struct_turns(record, kind, mappings)
    else:
        mark, name, turns = _json_turns(record, mappings)
    return mark, name, F.when(record.isNotNull(), F.coalesce(turns, F.array().cast(TURNS))).otherwise(
        F.array().cast(TURNS))


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&#10;"), F.lit("\n")),
                     F.lit("&amp;"), F.lit("&"))


def segments(turns: Column) -> Column:
    """The output as (text, loss) pieces: per turn its head, its text and its end."""
    def one(t: Column) -> Column:
        role = F.replace(escape(t["role"]), F.lit("\n"), F.lit("&#10;"))
        return F.array(
            F.struct(F.concat(F.lit(START), role, F.lit("\n")).alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(t["text"]).alias("text"), (t["role"] == "assistant").alias("loss")),
            F.struct(F.lit(END + "\n").alias("text"), F.lit(False).alias("loss")))
    return F.flatten(F.transform(turns, one))


def format_records(df: DataFrame, record_col: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """``row`` (all columns), ``fingerprint``, ``mapping``, ``segments`` and ``formatted`` of each record."""
    mark, name, turns = canonical_turns(F.col("record"), mappings, df.schema[record_col].dataType)
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
                     F.col(f"`{record_col}`").alias("record"))
    rows = rows.select("row", mark.alias("fingerprint"), name.alias("mapping"), turns.alias("turns"))
    rows = rows.select("row", "fingerprint", "mapping", segments(F.col("turns")).alias("segments"))
    return rows.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of an output, unescaped."""
    parts = F.split(formatted, START.replace("|", r"\|"))
    parts = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))

    def one(p: Column) -> Column:
        role = F.substring_index(p, "\n", 1)
        begin = F.length(role) + 2
        text = F.substr(p, begin, F.length(p) - begin + 1 - len(END) - 1)
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(parts, one)


def loss_text(segments_: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    kept = F.filter(segments_, lambda s: s["loss"])
    return F.array_join(F.transform(kept, lambda s: unescape(s["text"])), "")


def records_of(df: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role",
               text: str = "text") -> DataFrame:
    """(key, record): the rows of a turn table as one messages record (a struct) per conversation.

    One conversation is one output text, so its rows meet in one task; a
    conversation, with its template, has to fit a string (2 GB).
    """
    turn = F.struct(F.col(order).alias("n"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                    F.coalesce(F.col(text), F.lit("")).alias("content"))
    turns = F.transform(F.array_sort(F.collect_list(turn)), lambda t: F.struct(
        t["role"].alias("role"), t["content"].alias("content")))
    return df.groupBy(F.col(key).alias("key")).agg(turns.alias("messages")).select(
        "key", F.struct("messages").alias("record"))
