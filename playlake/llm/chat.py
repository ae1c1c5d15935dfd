"""Chat records of many layouts as canonical turns and one text (operator 6).

DataFrame functions only.  A record is JSON text.  The paths of its nested fields give a
schema fingerprint, which selects a declarative mapping to turns; the turns are written
with a template whose control strings are escaped in the texts, and can be read back.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
LOSS_ROLE = "assistant"
TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Layout:
    """Field paths that a record must have, those it may have, and how to read its turns, as
    SQL over ``r`` (the parsed record)."""

    name: str
    paths: tuple[str, ...]
    turns: str
    optional: tuple[str, ...] = ()

    def fingerprints(self) -> list[Column]:
        """One for each set of paths that the layout allows."""
        sets = [self.paths]
        for p in self.optional:
            sets += [(*s, p) for s in sets]
        return [fingerprint(F.array(*[F.lit(p) for p in sorted(s)])) for s in sets]


def _fields(*pairs: tuple[str, str]) -> str:
    items = ", ".join(f"named_struct('role', '{role}', 'text', r.{field})" for role, field in pairs)
    return f"filter(array({items}), x -> x.text is not null)"


RECORD = (
    "struct<messages:array<struct<role:string,content:string>>,conversations:array<struct<from:string,value:string>>,"
    "prompt:string,completion:string,system:string,instruction:string,input:string,output:string>"
)
#: A system text beside the list of turns is its first turn.
_SYSTEM = "if(r.system is null, array(), array(named_struct('role', 'system', 'text', r.system)))"
LAYOUTS = (
    Layout(
        "messages",
        ("messages[].content", "messages[].role"),
        f"concat({_SYSTEM}, transform(r.messages, m -> named_struct('role', m.role, 'text', m.content)))",
        ("system",),
    ),
    Layout(
        "conversations",
        ("conversations[].from", "conversations[].value"),
        f"concat({_SYSTEM}, transform(r.conversations, m -> named_struct('role', case m.from when 'human' then 'user' when 'gpt' then 'assistant' else m.from end, 'text', m.value)))",
        ("system",),
    ),
    Layout("no_messages", ("messages",), "array()", ("system",)),
    Layout("no_conversations", ("conversations",), "array()", ("system",)),
    Layout("prompt", ("completion", "prompt"), _fields(("system", "system"), ("user", "prompt"), ("assistant", "completion")), ("system",)),
    Layout("instruction", ("instruction", "output"), _fields(("user", "instruction"), ("assistant", "output"))),
    Layout("system_instruction", ("instruction", "output", "system"), _fields(("system", "system"), ("user", "instruction"), ("assistant", "output"))),
    Layout(
        "instruction_input",
        ("input", "instruction", "output"),
        f"concat({_SYSTEM}, array(named_struct('role', 'user', 'text', concat_ws('\\n\\n', r.instruction, nullif(r.input, ''))), named_struct('role', 'assistant', 'text', r.output)))",
        ("system",),
    ),
)
#: Paths that some layout reads.  Others (ids, names, tags) say nothing about the turns.
KNOWN = sorted({p for x in LAYOUTS for p in (*x.paths, *x.optional)})


def field_paths(record: Column) -> Column:
    """Sorted paths of a JSON record's fields down to its arrays' records; empty if it is no object."""
    kind = F.schema_of_variant(F.try_parse_json(record))
    # OBJECT<a: STRING, b: ARRAY<OBJECT<c: STRING>>>: an array of records opens one more level
    inner = F.regexp_extract_all(kind, F.lit(r"(\w+): ARRAY<OBJECT<([^<>]*)>>"), F.lit(1))
    names = F.regexp_extract_all(kind, F.lit(r"(\w+): ARRAY<OBJECT<([^<>]*)>>"), F.lit(2))
    nested = F.flatten(
        F.transform(
            F.arrays_zip(inner.alias("p"), names.alias("f")),
            lambda x: F.transform(F.split(x["f"], ", "), lambda y: F.concat(x["p"], F.lit("[]."), F.substring_index(y, ":", 1))),
        )
    )
    flat = F.regexp_replace(F.regexp_replace(kind, r"^OBJECT<|>$", ""), r"\w+: ARRAY<OBJECT<[^<>]*>>", "")
    top = F.transform(F.filter(F.split(flat, ", "), lambda y: F.contains(y, F.lit(":"))), lambda y: F.substring_index(y, ":", 1))
    return F.when(F.startswith(kind, F.lit("OBJECT<")), F.array_sort(F.concat(top, nested))).otherwise(F.array().cast("array<string>"))


def fingerprint(paths: Column) -> Column:
    return F.xxhash64(F.array_join(paths, "\n"))


def canonical(records: DataFrame, record: str = "record") -> DataFrame:
    """``records`` with ``layout`` (name, ``unknown`` if no mapping has the fingerprint),
    ``fingerprint`` (of the paths that layouts know; further fields do not count) and
    ``turns``; null roles and texts become empty.  An unknown or null record has no turns:
    ``unmapped`` returns those.  ``records`` may not have a column of these three names."""
    if {"layout", "fingerprint", "turns"} & set(records.columns):
        raise ValueError("a column of the records has the name of a result")
    known = F.array(*[F.lit(p) for p in KNOWN])
    named = records.withColumn("fingerprint", fingerprint(F.array_intersect(field_paths(F.col(record)), known)))
    parsed = named.withColumn("__r", F.from_json(record, RECORD))
    layout, turns = F.lit("unknown"), F.array().cast(TURNS)
    for x in LAYOUTS:
        layout = F.when(F.col("fingerprint").isin(*x.fingerprints()), x.name).otherwise(layout)
        turns = F.when(F.col("layout") == x.name, F.expr(x.turns.replace("r.", "__r.")).cast(TURNS)).otherwise(turns)
    out = parsed.withColumn("layout", layout).withColumn("turns", turns).drop("__r")
    clean = F.transform("turns", lambda t: F.struct(F.coalesce(t["role"], F.lit("")).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text")))
    return out.withColumn("turns", F.coalesce(clean, F.array().cast(TURNS)))


def unmapped(records: DataFrame) -> DataFrame:
    """Rows of ``canonical`` that no mapping reads: the error output, with the whole record."""
    return records.where("layout = 'unknown'")


def escape(text: Column) -> Column:
    """One backslash more between ``<`` and ``|``: no control string is left, and nothing is lost."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """A role stands on one line: a backslash becomes backslash s, a line end backslash n."""
    return F.replace(F.replace(escape(role), F.lit("\\"), F.lit("\\s")), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit("\\n"), F.lit("\n")), F.lit("\\s"), F.lit("\\")))


def render(turns: DataFrame, column: str = "turns") -> DataFrame:
    """``formatted`` text and ``loss`` (start, length: code points of each assistant text in it)."""
    body = lambda t: F.concat(escape_role(t["role"]), F.lit("\n"), escape(t["text"]))
    out = turns.withColumn("formatted", F.array_join(F.transform(column, lambda t: F.concat(F.lit(START), body(t), F.lit(END))), ""))
    parts = F.transform(
        column,
        lambda t: F.struct(
            (t["role"] == LOSS_ROLE).alias("own"), F.length(escape_role(t["role"])).alias("r"), F.length(escape(t["text"])).alias("n")
        ),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    fixed = len(START) + 1

    def step(acc: Column, p: Column) -> Column:
        here = F.struct((acc["at"] + fixed + p["r"]).alias("start"), p["n"].alias("length"))
        return F.struct(
            (acc["at"] + fixed + p["r"] + p["n"] + len(END)).alias("at"), F.when(p["own"], F.concat(acc["spans"], F.array(here))).otherwise(acc["spans"]).alias("spans")
        )

    return out.withColumn("loss", F.aggregate(parts, start, step, lambda acc: acc["spans"]))


def read_turns(formatted: str) -> Column:
    """Turns of a formatted text."""
    pieces = F.split(formatted, r"<\|im_start\|>")
    body = F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))
    return F.transform(
        body,
        lambda x: F.struct(
            unescape_role(F.substring_index(x, "\n", 1)).alias("role"),
            unescape(F.substr(x, F.length(F.substring_index(x, "\n", 1)) + 2, F.length(x) - F.length(F.substring_index(x, "\n", 1)) - 1 - len(END))).alias("text"),
        ),
    )


def read_loss(formatted: str, loss: str) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substr(F.col(formatted), s["start"] + 1, s["length"]))), "")
