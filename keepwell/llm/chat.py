"""Chat formatting in DataFrame functions: layouts by schema fingerprint, one canonical form, one reversible template.

A layout is known by its nested field paths. The paths of a mapping, sorted, joined and hashed, are its fingerprint. A table or
JSON record takes the mapping with most paths among those whose paths it has all, in their listed order where several are equally
wide, so further fields change nothing, also those that other mappings name. A list has a path if any of its elements has it.
`shape` is the hash of the whole nested schema of a record, whatever mapping it takes. A layout without a mapping raises for a
table and gives no turns for a record, as do text that is no JSON and lists without a role or without a text.

Template of a turn: `[role]text</s>`. In roles and texts `&`, `<`, `[` and `]` are written as `&amp;`, `&lt;`, `&lb;` and
`&rb;`, so none of the control strings can occur inside a text, and unescaping gives every text back.

Null roles and texts are empty strings. Turns sort by order value (null first), then role, then text; repeated rows are
repeated turns. A null conversation id is one conversation. A table without rows gives none. A conversation is one string, so it
must be under 2 GB; very long texts are kept whole. Further columns are not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lb;"), ("]", "&rb;"))
TURN_END = "</s>"
#: tables with a row per turn: field paths -> which is the conversation, order, role and text
ROW_LAYOUTS = (
    {"conversation": "conv_id", "order": "turn", "role": "role", "text": "text"},
    {"conversation": "conversation_id", "order": "index", "role": "role", "text": "content"},
    {"conversation": "thread_id", "order": "position", "role": "author", "text": "body"},
)
#: records: field paths -> turns, each a (role or its path, text path); `list` names an array of turns
RECORD_LAYOUTS = (
    {"list": "messages", "role": "role", "text": "content"},
    {"list": "conversations", "role": "from", "text": "value"},
    {"list": "turns", "role": "speaker", "text": "utterance"},
    {"turns": (("user", "prompt"), ("assistant", "completion"))},
    {"turns": (("user", "prompt"), ("assistant", "response"))},
    {"turns": (("system", "system"), ("user", "prompt"), ("assistant", "completion"))},
    {"turns": (("system", "system"), ("user", "prompt"), ("assistant", "response"))},
    {"turns": (("user", "instruction"), ("assistant", "output"))},
    {"turns": (("user", "instruction"), ("user", "input"), ("assistant", "output"))},
    {"turns": (("user", "question"), ("assistant", "answer"))},
)
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "chatgpt": "assistant"}


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def schema_paths(kind: T.DataType, above: str = "") -> set[str]:
    """Nested field paths, `[]` for array elements."""
    if isinstance(kind, T.ArrayType):
        return schema_paths(kind.elementType, f"{above}[]")
    if isinstance(kind, T.StructType):
        return set().union(*(schema_paths(f.dataType, f"{above}.{f.name}" if above else f.name) for f in kind.fields)) if kind.fields else set()
    return {above}


def _record_paths(layout: dict) -> set[str]:
    if "list" in layout:
        return {f"{layout['list']}[].{layout[k]}" for k in ("role", "text")}
    return {path for _, path in layout["turns"]}


ROW_MAPPINGS = {fingerprint(layout.values()): layout for layout in ROW_LAYOUTS}
RECORD_MAPPINGS = {fingerprint(_record_paths(layout)): layout for layout in RECORD_LAYOUTS}


def turns_of_table(table: DataFrame) -> DataFrame:
    """(conversation, order, role, text) of a table with a row per turn, its layout found by fingerprint."""
    paths = schema_paths(table.schema)
    for layout in ROW_LAYOUTS:
        found = ROW_MAPPINGS.get(fingerprint(paths & set(layout.values())))
        if found is layout:
            return table.select(F.col(layout["conversation"]).alias("conversation"), F.col(layout["order"]).alias("order"),
                                F.coalesce(F.col(layout["role"]).cast("string"), F.lit("")).alias("role"),
                                F.coalesce(F.col(layout["text"]).cast("string"), F.lit("")).alias("text"))
    raise ValueError(f"no mapping for a table with the fields {sorted(paths)}")


def _canonical_role(role: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    plain = F.lower(F.trim(F.coalesce(role, F.lit(""))))
    return F.coalesce(known[plain], plain)


def _listed_turn(layout: dict):
    return lambda t: F.struct(_canonical_role(t[layout["role"]]).alias("role"), F.coalesce(t[layout["text"]], F.lit("")).alias("text"))


def turns_of_records(records: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """(conversation, shape, fingerprint, turns) of JSON records of mixed layouts; turns is null where no mapping fits, and the
    fingerprint is that of the mapping taken."""
    opened = records.select(F.col(id_col).alias("conversation"), F.try_parse_json(F.col(json_col)).alias("v"))
    lists = {layout["list"]: f"array<struct<`{layout['role']}`:string,`{layout['text']}`:string>>" for layout in RECORD_LAYOUTS if "list" in layout}
    plain = sorted({path for layout in RECORD_LAYOUTS for _, path in layout.get("turns", ())})
    fields = opened.select("conversation", F.sha2(F.schema_of_variant("v"), 256).alias("shape"),
                           F.struct(*[F.try_variant_get("v", f"$.{path}", kind).alias(path) for path, kind in
                                      (*lists.items(), *((p, "string") for p in plain))]).alias("f"))

    def has(layout: dict) -> Column:
        if "list" in layout:
            parts = [F.exists(F.col("f")[layout["list"]][layout[k]], lambda x: x.isNotNull()) for k in ("role", "text")]
        else:
            parts = [F.col("f")[path].isNotNull() for _, path in layout["turns"]]
        return reduce(Column.__and__, parts)

    def built(layout: dict) -> Column:
        if "list" in layout:
            return F.transform(F.col("f")[layout["list"]], _listed_turn(layout))
        return F.array(*[F.struct(F.lit(role).alias("role"), F.col("f")[path].alias("text")) for role, path in layout["turns"]])

    widest_first = sorted(RECORD_MAPPINGS.items(), key=lambda entry: -len(_record_paths(entry[1])))
    mark = F.coalesce(*[F.when(has(layout), F.lit(mark)) for mark, layout in widest_first])
    turns = F.coalesce(*[F.when(F.col("fingerprint") == mark, built(layout)) for mark, layout in widest_first])
    return fields.withColumn("fingerprint", mark).select("conversation", "shape", "fingerprint", turns.alias("turns"))


def escaped(text: Column) -> Column:
    for plain, safe in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescaped(text: Column) -> Column:
    for plain, safe in reversed(ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def formatted(turns: DataFrame) -> DataFrame:
    """(conversation, formatted, loss) of rows (conversation, order, role, text), one row per conversation.

    `loss` is the mask: for each assistant turn its number, code-point offset in the formatted text, offset in its own
    turn and length. One shuffle serves both the running offsets and the grouping."""
    made = turns.withColumn("head", F.concat(F.lit("["), escaped(F.col("role")), F.lit("]"))).withColumn("body", escaped(F.col("text")))
    piece = F.concat("head", "body", F.lit(TURN_END))
    order = Window.partitionBy("conversation").orderBy("order", "role", "text")
    placed = (made.withColumn("piece", piece).withColumn("number", F.row_number().over(order))
              .withColumn("end", F.sum(F.length("piece").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0))))
    mask = F.when(F.col("role") == "assistant", F.struct(
        F.col("number").alias("turn"), (F.col("end") - F.length("piece") + F.length("head")).alias("start"),
        F.length("head").alias("offset"), F.length("body").alias("length")))
    rows = placed.select("conversation", F.struct("number", "piece", mask.alias("mask")).alias("row"))
    grouped = rows.groupBy("conversation").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    return grouped.select("conversation", F.array_join(F.col("rows")["piece"], "").alias("formatted"),
                          F.array_compact(F.col("rows")["mask"]).alias("loss"))


def read_back(formatted_rows: DataFrame) -> DataFrame:
    """(conversation, turns, loss_texts, formatted_chars) from the formatted text and its mask alone."""
    pieces = F.split("formatted", TURN_END, -1)
    split = formatted_rows.withColumn("pieces", F.slice(pieces, F.lit(1), F.size(pieces) - 1))
    turns = F.transform("pieces", lambda p: F.struct(
        unescaped(F.substr(p, F.lit(2), F.instr(p, "]") - 2)).alias("role"), unescaped(F.substr(p, F.instr(p, "]") + 1)).alias("text")))
    under = F.transform("loss", lambda m: unescaped(F.substr(F.element_at(F.col("pieces"), m["turn"]), m["offset"] + 1, m["length"])))
    return split.select("conversation", turns.alias("turns"), under.alias("loss_texts"), F.length("formatted").cast("long").alias("formatted_chars"))
