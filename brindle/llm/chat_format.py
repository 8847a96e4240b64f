"""Chat formatting by schema fingerprints.

A layout is a record schema with a declarative mapping to canonical turns.  The
fingerprint of a schema is the SHA-256 of its sorted nested field paths, so neither the
order nor the types of fields matter.  Records may come as a DataFrame, whose own schema has the
fingerprint, or as JSON text, each row with a layout of its own.

A JSON record has a layout's fingerprint when hashing those of its paths that the
layout names gives it: further fields do not matter, and a null or an empty array stands for all paths
below it.  Of several layouts the one with most paths is taken, then the first.

The template marks turns and escapes its marks inside roles and texts with a
backslash, reversibly.  Everything is made of built-in expressions.

Defined results: a null role or text is empty; turns are ordered by number (nulls
first), then role, then text; repeated rows are turns of their own; rows of a null
conversation form one conversation; a record of an unknown layout, or without turns, formats to
an empty string; columns beyond those named do not matter; an empty table gives no rows.  A conversation is
one record, so its turns meet in one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import let

OPEN, SAYS, CLOSE = "<|turn|>", "<|says|>", "<|end|>"
TURNS = "array<struct<role:string,text:string>>"
#: Strings of any length: the parser's own limit would turn a record with a longer one into nulls.
READ = {"maxStringLen": str((1 << 31) - 1), "maxNumLen": str((1 << 31) - 1)}


def paths(kind: T.DataType, at: str = "") -> list[str]:
    """The nested field paths of a schema; ``[]`` marks what lies in an array."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, T.ArrayType):
        return paths(kind.elementType, at + "[]")
    return [at]


def fingerprint(schema: T.StructType) -> str:
    return hashlib.sha256("\n".join(sorted(paths(schema))).encode()).hexdigest()


@dataclass(frozen=True)
class Layout:
    """``turns`` maps a record of ``schema`` to an array of (role, text)."""

    name: str
    schema: str
    turns: Callable[[Column], Column]

    @property
    def kind(self) -> T.StructType:
        return T.StructType.fromDDL(self.schema)

    @property
    def fingerprint(self) -> str:
        return fingerprint(self.kind)


def _said(role, text: Column) -> Column:
    return F.struct((role if isinstance(role, Column) else F.lit(role)).alias("role"), text.alias("text"))


def _pair(ask: str, answer: str) -> Callable[[Column], Column]:
    return lambda r: F.array(_said("user", r[ask]), _said("assistant", r[answer]))


def _speaker(name: Column) -> Column:
    low = F.lower(name)
    return F.when(low == "human", "user").when(low.isin("gpt", "bot"), "assistant").otherwise(low)


LAYOUTS = (
    Layout("turn rows", "turns ARRAY<STRUCT<turn: BIGINT, role: STRING, text: STRING>>", lambda r: F.transform(F.array_sort(r["turns"]), lambda x: _said(x["role"], x["text"]))),
    Layout("messages", "messages ARRAY<STRUCT<role: STRING, content: STRING>>", lambda r: F.transform(r["messages"], lambda x: _said(x["role"], x["content"]))),
    Layout("speakers", "conversations ARRAY<STRUCT<`from`: STRING, value: STRING>>", lambda r: F.transform(r["conversations"], lambda x: _said(_speaker(x["from"]), x["value"]))),
    Layout("prompt, response", "prompt STRING, response STRING", _pair("prompt", "response")),
    Layout("prompt, completion", "prompt STRING, completion STRING", _pair("prompt", "completion")),
    Layout("question, answer", "question STRING, answer STRING", _pair("question", "answer")),
    Layout("instruction, output", "instruction STRING, output STRING", _pair("instruction", "output")),
    Layout("instruction, input, output", "instruction STRING, input STRING, output STRING", lambda r: F.array(_said("user", F.concat_ws("\n\n", r["instruction"], F.nullif(r["input"], F.lit("")))), _said("assistant", r["output"]))),
    Layout("system, prompt, response", "system STRING, prompt STRING, response STRING", lambda r: F.array(_said("system", r["system"]), _said("user", r["prompt"]), _said("assistant", r["response"]))),
)


def canonical(df: DataFrame, fields: list[str], layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``df`` with ``turns_out``: the fields' own schema selects the mapping; the other columns stay."""
    found = fingerprint(T.StructType([df.schema[f] for f in fields]))
    record = F.struct(*[F.col(f"`{f}`") for f in fields])
    turns = next((x.turns(record) for x in layouts if x.fingerprint == found), F.array())
    return df.withColumn("turns_out", turns.cast(TURNS)).withColumn("fingerprint", F.lit(found))


def record_paths(raw: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """Those nested paths of a JSON record that any layout names, with repeats; empty for what is no object."""
    keys = F.coalesce(F.json_object_keys(raw), F.array().cast("array<string>"))
    fields = {f.name: f.dataType for x in layouts for f in x.kind.fields}
    lists = [n for n, k in fields.items() if isinstance(k, T.ArrayType)]
    plain = F.filter(keys, lambda k: k.isin([n for n in fields if n not in lists]))
    if not lists:
        return plain
    rows = F.from_json(raw, ", ".join(f"`{n}` ARRAY<MAP<STRING, STRING>>" for n in lists), READ)

    def below(name: str, r: Column) -> Column:
        all_ = F.array(*[F.lit(p) for p in dict.fromkeys(p for x in layouts for f in x.kind.fields if f.name == name for p in paths(f.dataType, name))])
        objects = F.filter(r[name], lambda x: x.isNotNull())
        seen = F.transform(F.flatten(F.transform(objects, lambda x: F.map_keys(x))), lambda k: F.concat(F.lit(f"{name}[]."), k))
        return F.when(~F.array_contains(keys, name), F.array().cast("array<string>")).when(F.coalesce(F.size(objects), F.lit(0)) <= 0, all_).otherwise(seen)

    return let(rows, lambda r: F.concat(plain, *[below(n, r) for n in lists]))


def canonical_json(df: DataFrame, column: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Records as JSON text, with ``turns_out`` and ``fingerprint``: each row's own paths choose its mapping."""
    raw, none = F.col(column), F.array().cast(TURNS)
    order = sorted(layouts, key=lambda x: -len(paths(x.kind)))

    def has(found: Column, x: Layout) -> Column:
        named = F.array_intersect(found, F.array(*[F.lit(p) for p in paths(x.kind)]))
        return F.sha2(F.array_join(F.array_sort(named), "\n"), 256) == x.fingerprint

    chosen = let(record_paths(raw, layouts), lambda found: F.coalesce(*[F.when(has(found, x), F.lit(x.fingerprint)) for x in order], F.sha2(F.array_join(F.array_sort(F.array_distinct(found)), "\n"), 256)))
    df = df.withColumn("fingerprint", chosen)
    turns = none
    for x in reversed(order):
        map_ = x.turns
        mapped = let(F.from_json(raw, x.kind, READ), lambda r: F.coalesce(map_(r).cast(TURNS), none))
        turns = F.when(F.col("fingerprint") == x.fingerprint, mapped).otherwise(turns)
    return df.withColumn("turns_out", turns)


def as_records(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as (conv_id, raw): one JSON record a conversation, in the layouts that a corpus mixes.

    A question with its answer takes one of the two-field layouts (three, where the question has two
    parts), one with a system text before it the layout with ``system``; other conversations are listed as turn rows,
    messages or, where every role has a speaker's name, speakers.  Which of the fitting ones is up to the id's hash.
    """
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    records = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("ts"))
    json = lambda x: F.to_json(x, {"ignoreNullFields": "false"})
    pick = lambda n: F.pmod(F.xxhash64(F.col("conv_id").cast("string"), F.lit("layout")), F.lit(n))
    roles = F.transform("ts", lambda t: F.coalesce(t["role"], F.lit("")))
    text = lambda i: F.get(F.col("ts"), F.lit(i))["text"]
    two = lambda ask, answer, a=0: F.struct(text(a).alias(ask), text(a + 1).alias(answer))
    cut = F.instr(text(0), "\n\n")
    parts = F.struct(F.substring(text(0), F.lit(1), cut - 1).alias("instruction"), F.substring(text(0), cut + 2, F.length(text(0))).alias("input"), text(1).alias("output"))
    pair = F.array_join(roles, ",") == "user,assistant"
    asked = F.array_join(roles, ",") == "system,user,assistant"
    raw = F.when(pair & (cut > 1) & (F.length(text(0)) > cut + 1), json(parts))
    raw = raw.when(pair & (pick(4) == 0), json(two("prompt", "response"))).when(pair & (pick(4) == 1), json(two("prompt", "completion")))
    raw = raw.when(pair & (pick(4) == 2), json(two("question", "answer"))).when(pair, json(two("instruction", "output")))
    raw = raw.when(asked, json(F.struct(text(0).alias("system"), text(1).alias("prompt"), text(2).alias("response"))))
    speakers = F.transform("ts", lambda t: F.struct(F.when(t["role"] == "user", "human").when(t["role"] == "assistant", "gpt").otherwise(t["role"]).alias("from"), t["text"].alias("value")))
    messages = F.transform("ts", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content")))
    raw = raw.when((pick(3) == 0) & F.forall(roles, lambda r: r.isin("user", "assistant", "system", "tool")), json(F.struct(speakers.alias("conversations"))))
    raw = raw.when(pick(3) == 1, json(F.struct(messages.alias("messages")))).otherwise(json(F.struct(F.col("ts").alias("turns"))))
    return records.select("conv_id", raw.alias("raw"))


def escape(x: Column) -> Column:
    """No mark of the template can begin inside an escaped text; ``unescape`` gives the text back."""
    return F.replace(F.replace(F.coalesce(x, F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(x: Column) -> Column:
    return F.regexp_replace(x, "(?s)\\\\(.)", "$1")


def format_turns(turns: Column) -> Column:
    """(formatted, spans): the text, and the code points (start, end exclusive) under the loss mask."""
    pieces = F.transform(
        turns,
        lambda t: F.struct(
            F.concat(F.lit(OPEN), escape(t["role"]), F.lit(SAYS)).alias("head"), escape(t["text"]).alias("body"), F.coalesce(t["role"] == "assistant", F.lit(False)).alias("loss")
        ),
    )

    def spans(ps: Column) -> Column:
        none = F.array().cast("array<struct<start:bigint,end:bigint>>")

        def step(a: Column, p: Column) -> Column:
            start = a["at"] + F.length(p["head"])
            end = start + F.length(p["body"])
            grown = F.when(p["loss"], F.array_append(a["spans"], F.struct(start.alias("start"), end.alias("end")))).otherwise(a["spans"])
            return F.struct((end + len(CLOSE)).alias("at"), grown.alias("spans"))

        return F.aggregate(ps, F.struct(F.lit(0).cast("long").alias("at"), none.alias("spans")), step, lambda a: a["spans"])

    return let(pieces, lambda ps: F.struct(F.array_join(F.transform(ps, lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), "").alias("formatted"), spans(ps).alias("spans")))


def parse(formatted: Column) -> Column:
    """The turns, read back from a formatted text."""
    parts = F.filter(F.split(formatted, "\\Q" + OPEN + "\\E"), lambda x: x != "")

    def turn(x: Column) -> Column:
        halves = F.split(F.left(x, F.length(x) - len(CLOSE)), "\\Q" + SAYS + "\\E")
        return let(halves, lambda h: F.struct(unescape(F.get(h, 0)).alias("role"), unescape(F.get(h, 1)).alias("text")))

    return F.transform(parts, turn)


def under_mask(formatted: Column, spans: Column) -> Column:
    """The unescaped text under the loss mask, by one scan: the spans are bodies of turns, found again by their places."""
    parts = F.filter(F.split(formatted, "\\Q" + OPEN + "\\E"), lambda x: x != "")
    none = F.array().cast("array<bigint>")
    step = lambda a, x: F.struct((a["at"] + len(OPEN) + F.length(x)).alias("at"), F.array_append(a["starts"], a["at"] + len(OPEN)).alias("starts"))
    starts = lambda ps: F.aggregate(ps, F.struct(F.lit(0).cast("long").alias("at"), none.alias("starts")), step, lambda a: a["starts"])

    def cut(x: Column, at: Column) -> Column:
        head = F.instr(x, SAYS) + len(SAYS) - 1
        return F.struct((at + head).alias("start"), (at + F.length(x) - len(CLOSE)).alias("end"), F.substring(x, head + 1, F.length(x) - head - len(CLOSE)).alias("body"))

    bodies = let(parts, lambda ps: F.zip_with(ps, starts(ps), cut))
    masked = F.filter(bodies, lambda p: F.array_contains(spans, F.struct(p["start"].cast("long").alias("start"), p["end"].cast("long").alias("end"))))
    return F.array_join(F.transform(masked, lambda p: unescape(p["body"])), "")


def format_chats(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) into one formatted record a conversation, by way of records in mixed layouts."""
    return format_records(as_records(rows))


def format_records(records: DataFrame) -> DataFrame:
    """(conv_id, raw) with ``raw`` as JSON of any known layout -> (conv_id, fingerprint, formatted, spans)."""
    out = canonical_json(records, "raw").select("conv_id", "fingerprint", format_turns(F.col("turns_out")).alias("f"))
    return out.select("conv_id", "fingerprint", "f.formatted", "f.spans")


def digest(formatted: DataFrame) -> DataFrame:
    """Counts and digests, read back from the formatted records."""
    x = formatted.withColumn("read", parse(F.col("formatted"))).withColumn("loss", under_mask(F.col("formatted"), F.col("spans")))
    flat = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return x.select(
        "conv_id",
        F.size("read").cast("long").alias("n_turns"),
        F.sha2(flat, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def with_probe(rows: DataFrame) -> DataFrame:
    """The rows plus conversation -7, whose texts hold control strings."""
    said = "\\### Assistant: </turn> ok"
    probe = rows.sparkSession.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return rows.select("conv_id", "turn", "role", "text").unionByName(probe)


ORACLE = """
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
e AS (SELECT *, length(replace(replace(role, '\\', '\\\\'), '<|', '<\\|')) + length(replace(replace(text, '\\', '\\\\'), '<|', '<\\|')) AS n FROM r),
c AS (SELECT conv_id, count(*)::BIGINT AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS flat,
  coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss, sum(n + 23)::BIGINT AS formatted_chars FROM e GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(flat) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM c"""
