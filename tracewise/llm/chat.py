"""Chat formatting by schema fingerprints; DataFrame functions only.

A record is a JSON object. The sorted paths of its fields are hashed, and the hash selects a declarative mapping that
turns the record into canonical turns. Turns are set in a template whose control strings are escaped inside texts, so
that turns and the texts under the loss mask can be read back from the output.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Mapping:
    """fields: top-level names. parts: (role, field) of each turn, empty fields left out. array: a field of messages, whose items have `role` and `text`; `roles` renames roles. By `row`, the record itself is one message."""

    name: str
    fields: tuple[str, ...]
    parts: tuple[tuple[str, str], ...] = ()
    array: str | None = None
    role: str = "role"
    text: str = "content"
    roles: tuple[tuple[str, str], ...] = ()
    row: bool = False

    @property
    def paths(self) -> list[str]:
        return sorted([*self.fields, *(f"{self.array}[].{x}" for x in (self.role, self.text) if self.array)])

    def turns(self, record: Column) -> Column:
        one = lambda role, text: F.struct(role.alias("role"), F.coalesce(text, F.lit("")).alias("text"))
        at = lambda f: F.get_json_object(record, f"$.{f}")
        if self.row:
            return F.array(one(F.coalesce(at(self.role), F.lit("")), at(self.text)))
        if not self.array:
            return F.filter(F.array(*(one(F.lit(r), at(f)) for r, f in self.parts)), lambda t: t.text != "")

        def renamed(role: Column) -> Column:
            return reduce(lambda c, x: F.when(role == x[0], x[1]).otherwise(c), self.roles, role)

        return F.transform(
            F.from_json(at(self.array), "array<map<string,string>>"),
            lambda m: one(F.coalesce(renamed(m[self.role]), F.lit("")), m[self.text]),
        )


MAPPINGS = (
    Mapping("row", ("role", "text"), row=True, text="text"),
    Mapping("completion", ("prompt", "completion"), (("user", "prompt"), ("assistant", "completion"))),
    Mapping("response", ("prompt", "response"), (("user", "prompt"), ("assistant", "response"))),
    Mapping("instruction", ("instruction", "output"), (("user", "instruction"), ("assistant", "output"))),
    Mapping("instruction_input", ("instruction", "input", "output"), (("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Mapping("system_instruction", ("system", "instruction", "output"), (("system", "system"), ("user", "instruction"), ("assistant", "output"))),
    Mapping("messages", ("messages",), array="messages"),
    Mapping("from_value", ("conversations",), array="conversations", role="from", text="value", roles=(("human", "user"), ("gpt", "assistant"))),
)


def field_paths(record: Column, arrays: tuple[str, ...]) -> Column:
    """Sorted field names of a JSON object, and `field[].name` for objects in those of its fields that `arrays` lists."""
    none = F.array().cast("array<string>")
    found = [F.coalesce(F.json_object_keys(record), none)]
    for a in arrays:
        inner = F.try_variant_get(F.try_parse_json(record), f"$.{a}", "variant")
        items = F.when(F.schema_of_variant(inner).startswith("ARRAY"), F.from_json(F.to_json(inner), "array<string>"))
        keys = F.flatten(F.transform(items, lambda x: F.coalesce(F.json_object_keys(x), none)))
        found.append(F.coalesce(_prefixed(f"{a}[].", keys), none))
    return F.array_sort(F.array_distinct(F.concat(*found)))


def _prefixed(prefix: str, names: Column) -> Column:
    return F.transform(names, lambda n: F.concat(F.lit(prefix), n))


def fingerprint(paths: Column) -> Column:
    return F.xxhash64(F.array_join(paths, "\n"))


def canonical_turns(records: DataFrame, record: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """records with three more columns: layout_hash, layout (null if no mapping has that fingerprint), and turns,
    array<struct<role,text>> (null without a layout). A null or malformed record has the fingerprint of no fields."""
    r = F.col(record)
    arrays = tuple(dict.fromkeys(m.array for m in mappings if m.array))
    out = records.withColumn("layout_hash", fingerprint(field_paths(r, arrays)))
    pick = lambda value: reduce(
        lambda c, m: F.when(F.col("layout_hash") == fingerprint(F.array(*map(F.lit, m.paths))), value(m)).otherwise(c),
        reversed(mappings), F.lit(None),
    )
    return out.withColumn("layout", pick(lambda m: F.lit(m.name))).withColumn("turns", pick(lambda m: m.turns(r)))


@dataclass(frozen=True)
class Template:
    """Fixed strings round each turn, and further strings that no text may show to a tokenizer."""

    start: str = "<|im_start|>"
    end: str = "<|im_end|>\n"
    trained: str = "assistant"
    control: tuple[str, ...] = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

    def escape(self, text: Column, *more: str) -> Column:
        """A backslash goes into each control string after its first character; backslashes of the text are doubled."""
        return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}")), self.control, F.replace(text, F.lit("\\"), F.lit("\\\\")))

    def unescape(self, text: Column) -> Column:
        back = reduce(lambda t, c: F.replace(t, F.lit(f"{c[0]}\\{c[1:]}"), F.lit(c)), reversed(self.control), text)
        return F.replace(back, F.lit("\\\\"), F.lit("\\"))

    def escape_role(self, role: Column) -> Column:
        return F.replace(self.escape(role), F.lit("\n"), F.lit("<\\n>"))

    def unescape_role(self, role: Column) -> Column:
        return self.unescape(F.replace(role, F.lit("<\\n>"), F.lit("\n")))


def format_turns(turns: DataFrame, key: str, order: list[str], template: Template = Template()) -> DataFrame:
    """One row per key from rows with `role` and `text`: formatted string, segments array<struct<text,loss>> whose texts
    join to it, and loss_spans array<struct<start,end>> in code points. Equal order values go by role, then text; null
    role or text: empty. A repeated row is a turn of its own; an empty table gives none; a null key is a key. The key may have any name but
    those of the three results; other columns are not read."""
    body, role = template.escape(F.coalesce("text", F.lit(""))), F.coalesce("role", F.lit(""))
    rows = turns.select(
        F.col(key).alias("_key"),
        F.struct(
            F.struct(*order, role.alias("r"), F.coalesce("text", F.lit("")).alias("t")).alias("at"),
            F.concat(F.lit(template.start), template.escape_role(role), F.lit("\n")).alias("head"), body.alias("body"), (role == template.trained).alias("loss"),
        ).alias("_turn"),
    )
    size = lambda c: F.char_length(c).cast("long")
    whole = size("_turn.head") + size("_turn.body") + len(template.end)
    w = Window.partitionBy("_key").orderBy("_turn.at").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_stop", F.sum(whole).over(w) - len(template.end))
    out = rows.groupBy("_key").agg(F.array_sort(F.collect_list(F.struct("_turn.*", (F.col("_stop") - size("_turn.body")).alias("start"), F.col("_stop").alias("stop")))).alias("_turns"))
    parts = F.flatten(F.transform("_turns", lambda t: F.array(
        F.struct(t.head.alias("text"), F.lit(False).alias("loss")),
        F.struct(t.body.alias("text"), t.loss.alias("loss")),
        F.struct(F.lit(template.end).alias("text"), F.lit(False).alias("loss")),
    )))
    spans = F.transform(F.filter("_turns", lambda t: t.loss), lambda t: F.struct(t.start.alias("start"), t.stop.alias("end")))
    return out.select(F.col("_key").alias(key), parts.alias("segments"), spans.alias("loss_spans")).select(
        key, F.array_join(F.transform("segments", lambda s: s.text), "").alias("formatted"), "segments", "loss_spans"
    )


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """array<struct<role,text>> read back from a formatted string."""
    pieces = F.filter(F.split(formatted, _literal(template.end)), lambda p: p != "")
    head = lambda p: F.substring_index(p, "\n", 1)
    return F.transform(pieces, lambda p: F.struct(
        template.unescape_role(F.substr(head(p), F.lit(len(template.start) + 1))).alias("role"),
        template.unescape(F.substr(p, F.char_length(head(p)) + 2)).alias("text"),
    ))


def read_loss(segments: Column, template: Template = Template()) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s.loss), lambda s: template.unescape(s.text)), "")


def _literal(text: str) -> str:
    return "".join(f"\\{c}" if c in "<>|[]()^$.*+?{}\\" else c for c in text)
