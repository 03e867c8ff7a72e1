"""Chat formatting: layouts recognised by fingerprint, one canonical form, a reversible template.

A layout is known by the hash of its nested field paths.  The fingerprint selects a declarative
mapping to canonical turns (conv_id, turn, role, text): whole tables by their schema, JSON records
row by row.  A turn is written as ``<turn:ROLE>TEXT</turn>`` and a newline.  Inside roles and texts
the characters that could form a control string are escaped with a backslash, and so is the
backslash, so ``read_back`` returns the turns exactly.

Defined results: null roles and texts are empty; null turns come first; tied turns are ordered by
role and text; a null conversation id is a conversation of its own; records of an unknown layout, or
null ones, are kept with no turns and ``layout`` null; further columns are ignored unless they change
the fingerprint; an empty table gives an empty result.
"""

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

END = "</turn>\n"
OPEN = "<turn:"

TURN = "array<struct<role:string,text:string>>"

# Layouts: their nested field paths, and where the turns are.
# A list layout names the list and its role and text fields; a pair layout the fields of either side.
LAYOUTS = {
    "messages": {"paths": ["messages[].content", "messages[].role"],
                 "list": ("messages", "role", "content")},
    "sharegpt": {"paths": ["conversations[].from", "conversations[].value"],
                 "list": ("conversations", "from", "value")},
    "prompt": {"paths": ["prompt", "response"], "user": ["prompt"], "assistant": "response"},
    "completion": {"paths": ["completion", "prompt"], "user": ["prompt"], "assistant": "completion"},
    "instruction": {"paths": ["instruction", "output"], "user": ["instruction"], "assistant": "output"},
    "instruction with input": {"paths": ["input", "instruction", "output"],
                               "user": ["instruction", "input"], "assistant": "output"},
}
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
# Tables with one row per turn.
ROW_LAYOUTS = {
    "turn rows": {"paths": ["conv_id", "role", "text", "turn"],
                  "columns": {"conv_id": "conv_id", "turn": "turn", "role": "role", "text": "text"}},
    "thread rows": {"paths": ["author", "body", "position", "thread"],
                    "columns": {"conv_id": "thread", "turn": "position", "role": "author", "text": "body"}},
}


def fingerprint(paths) -> str:
    return hashlib.sha256(",".join(sorted(paths)).encode()).hexdigest()


def field_paths(kind: T.DataType, at: str = "") -> list:
    """Nested field paths of a schema; lists are marked with []."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in field_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, at + "[]")
    return [at]


def table_layout(schema: T.StructType) -> dict:
    """The mapping of a table of turns; columns that no layout has are left out of the fingerprint."""
    known = {fingerprint(x["paths"]): x for x in ROW_LAYOUTS.values()}
    own = field_paths(schema)
    for paths in [own, *([p for p in own if p in x["paths"]] for x in ROW_LAYOUTS.values())]:
        if fingerprint(paths) in known:
            return known[fingerprint(paths)]
    raise ValueError(f"no layout for the fields {sorted(own)}")


def canonical_rows(df: DataFrame) -> DataFrame:
    """conv_id, turn, role, text from a table with one row per turn."""
    at = table_layout(df.schema)["columns"]
    return df.select(F.col(at["conv_id"]).cast("long").alias("conv_id"), F.col(at["turn"]).cast("long").alias("turn"),
                     F.coalesce(F.col(at["role"]), F.lit("")).alias("role"),
                     F.coalesce(F.col(at["text"]), F.lit("")).alias("text"))


def _prefixed(names: Column, prefix: str) -> Column:
    return F.transform(names, lambda name: F.concat(F.lit(prefix), name))


def record_fingerprint(record: Column) -> Column:
    """The fingerprint of a JSON record: its keys, and those of the first element of its lists."""
    paths = F.json_object_keys(record)
    for layout in LAYOUTS.values():
        if "list" in layout:
            name = layout["list"][0]
            inner = F.json_object_keys(F.get_json_object(record, f"$.{name}[0]"))
            nested = _prefixed(inner, f"{name}[].")
            paths = F.when(F.array_contains(paths, name), F.concat(
                F.array_remove(paths, name), F.coalesce(nested, F.array(F.lit(name))))).otherwise(paths)
    known = F.array(*[F.lit(p) for p in sorted({p for x in LAYOUTS.values() for p in x["paths"]})])
    return F.sha2(F.array_join(F.array_sort(F.array_intersect(paths, known)), ","), 256)


def _turns_of(record: Column, layout: dict) -> Column:
    if "list" in layout:
        name, role, text = layout["list"]
        items = F.from_json(F.get_json_object(record, f"$.{name}"), f"array<struct<`{role}`:string,`{text}`:string>>")

        def one(item):
            spoken = item[role]
            for alias, plain in ROLES.items():
                spoken = F.when(item[role] == alias, plain).otherwise(spoken)
            return F.struct(F.coalesce(spoken, F.lit("")).alias("role"),
                            F.coalesce(item[text], F.lit("")).alias("text"))
        return F.transform(items, one)
    asked = F.array_join(F.filter(F.array(*[F.get_json_object(record, f"$.{p}") for p in layout["user"]]),
                                  lambda x: x.isNotNull() & (x != "")), "\n")
    said = F.coalesce(F.get_json_object(record, f"$.{layout['assistant']}"), F.lit(""))
    return F.array(F.struct(F.lit("user").alias("role"), asked.alias("text")),
                   F.struct(F.lit("assistant").alias("role"), said.alias("text")))


def canonical_records(df: DataFrame, conv_id: str, record: str) -> DataFrame:
    """conv_id, layout, turns (list of role and text) from JSON records of any known layout."""
    rows = df.select(F.col(conv_id).alias("conv_id"), F.col(record).alias("_record")).withColumn(
        "_print", record_fingerprint(F.col("_record")))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURN)
    for name, x in LAYOUTS.items():
        hit = F.col("_print") == fingerprint(x["paths"])
        layout = F.when(hit, F.lit(name)).otherwise(layout)
        turns = F.when(hit, _turns_of(F.col("_record"), x)).otherwise(turns)
    return rows.select("conv_id", layout.alias("layout"), F.coalesce(turns, F.array().cast(TURN)).alias("turns"))


def escaped(text: Column) -> Column:
    for plain, code in (("\\", "\\s"), ("<", "\\l"), (">", "\\g")):
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    # Every backslash of an escaped text begins a pair, so the pairs can be undone one kind at a time.
    for plain, code in ((">", "\\g"), ("<", "\\l"), ("\\", "\\s")):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def written(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), escaped(role), F.lit(">"), escaped(text), F.lit(END))


def format_rows(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, loss (list of start and length of the assistants' texts, from 0)."""
    rows = turns.withColumn("_piece", written(F.col("role"), F.col("text")))
    rows = rows.withColumn("_chars", F.char_length("_piece").cast("long"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.select(
        "conv_id", F.row_number().over(order).alias("_at"), "role", "_piece", "_chars",
        F.sum("_chars").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_end"))
    shell = len(OPEN) + 1 + F.char_length(escaped(F.col("role")))
    span = F.when(F.col("role") == "assistant", F.struct(
        (F.col("_end") - F.col("_chars") + shell).alias("start"),
        (F.col("_chars") - shell - len(END)).alias("length")))
    got = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(
        F.struct("_at", "_piece", span.alias("span")))).alias("_all"))
    return got.select("conv_id", F.array_join(F.transform("_all", lambda x: x["_piece"]), "").alias("formatted"),
                      F.filter(F.transform("_all", lambda x: x["span"]), lambda x: x.isNotNull()).alias("loss"))


def format_records(records: DataFrame) -> DataFrame:
    """The same from canonical records; ``layout`` goes along."""
    pieces = F.transform("turns", lambda t: written(t["role"], t["text"]))
    return records.select("conv_id", "layout", F.array_join(pieces, "").alias("formatted"))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation, a list of role and text."""
    pieces = F.split(formatted, END)

    def one(piece):
        role = F.substring_index(piece, ">", 1)
        return F.struct(unescaped(F.substr(role, F.lit(len(OPEN) + 1))).alias("role"),
                        unescaped(F.substr(piece, F.char_length(role) + 2)).alias("text"))
    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), one)


def loss_text(formatted: Column, loss: Column) -> Column:
    """The unescaped text under the loss mask."""
    return F.array_join(F.transform(loss, lambda s: unescaped(
        F.substr(formatted, s["start"].cast("int") + 1, s["length"].cast("int")))), "")
