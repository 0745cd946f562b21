"""Chat formatting: schema fingerprints select declarative mappings onto canonical turns.

A record's fingerprint hashes the sorted paths of its nested fields that hold a value.  Each mapping names
the paths it needs and may use; the fingerprints of all its shapes select it by equality, so records of
different layouts in one table convert in one projection.  Canonical turns are rows
``(conv, turn, role, text)``; formatting and reading back are column expressions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.common import table

# Control strings of the template.  All start with '<' or '['; inside texts and roles every '<', '[' and '\\' is
# followed by a backslash, so no control string can occur there and removing those restores the text.
OPEN, SEP, CLOSE = "<s>", "[INST]", "</s>"
SPECIAL = r"([<\[\\])"


@dataclass(frozen=True)
class Mapping:
    """How one layout becomes turns.

    ``needs`` / ``may``: dotted field paths (``messages[].role`` for fields of array elements) that a record of this
    layout holds / may hold.  ``turns``: (role, path, ...) entries whose texts join with a blank line, for flat layouts;
    ``messages``: (array path, role field, text field) for message lists; ``row``: (role path, text path) for
    tables with one turn per row.  ``roles`` renames roles.
    """

    name: str
    needs: tuple[str, ...]
    may: tuple[str, ...] = ()
    turns: tuple[tuple[str, ...], ...] = ()
    messages: tuple[str, str, str] | None = None
    row: tuple[str, str] | None = None
    roles: dict = field(default_factory=dict, hash=False)


DEFAULT_MAPPINGS = (
    Mapping("row", ("role",), ("text",), row=("role", "text")),
    Mapping("bare_row", ("text",), row=("role", "text")),
    Mapping("messages", ("messages[].role",), ("messages[].content",), messages=("messages", "role", "content")),
    Mapping("shares", ("conversations[].from",), ("conversations[].value",), messages=("conversations", "from", "value"),
            roles={"human": "user", "gpt": "assistant"}),
    Mapping("instruction", ("instruction", "output"), ("input", "system"),
            turns=(("system", "system"), ("user", "instruction", "input"), ("assistant", "output"))),
    Mapping("prompt", ("prompt",), ("response",), turns=(("user", "prompt"), ("assistant", "response"))),
)


def leaf_paths(schema: T.StructType, prefix: str = "") -> list[tuple[str, Column]]:
    """Every leaf path of a schema with the condition that a record holds a value there."""

    def walk(kind: T.DataType, path: str, get) -> list[tuple[str, object]]:
        if isinstance(kind, T.StructType):
            return [x for f in kind.fields for x in walk(f.dataType, f"{path}.{f.name}" if path else f.name,
                                                        lambda r, g=get, n=f.name: (g(r).getField(n) if g(r) is not None else F.col(f"`{n}`")))]
        if isinstance(kind, T.ArrayType):
            return [(p, lambda r, g=get, t=test: F.exists(F.coalesce(g(r), F.array().cast(kind)), lambda e: t(e)))
                    for p, test in walk_element(kind.elementType, f"{path}[]")]
        return [(path, lambda r, g=get: g(r).isNotNull())]

    def walk_element(kind: T.DataType, path: str) -> list[tuple[str, object]]:
        if isinstance(kind, T.StructType):
            return [x for f in kind.fields for x in walk(f.dataType, f"{path}.{f.name}", lambda r, n=f.name: r.getField(n))]
        return walk(kind, path, lambda r: r)

    return [(p, test(None)) for p, test in walk(schema, prefix, lambda r: None)]


def fingerprint(schema: T.StructType, known: set[str]) -> Column:
    """Hash of the sorted paths, among the ``known`` ones, of the fields that hold a value."""
    found = sorted((x for x in leaf_paths(schema) if x[0] in known), key=lambda x: x[0])
    held = F.concat_ws("\n", *[F.when(c, F.lit(p)) for p, c in found])
    return F.xxhash64(held)


def _shapes(m: Mapping) -> list[str]:
    return ["\n".join(sorted({*m.needs, *extra})) for k in range(len(m.may) + 1) for extra in combinations(m.may, k)]


def canonical_turns(records: DataFrame, key: str, order: str | None = None, fields: Sequence[str] | None = None,
                    mappings: Sequence[Mapping] = DEFAULT_MAPPINGS) -> DataFrame:
    """Rows ``(conv, ord, pos, role, text, layout)`` of all records; ``fields`` are the columns that hold the record.

    Columns outside ``fields`` (extra ones, also with clashing names) are ignored.  A null text reads as empty; a
    flat entry whose paths are all null gives no turn.  Fields that no mapping knows (a message's name, say) do not
    matter to the shape.  A record whose known fields are those of no mapping gives one turn of null role and layout ``unknown``, its
    text the record as JSON, so nothing of it is lost.  ``order`` sorts rows of one conversation (nulls first).
    """
    fields = list(fields or [c for c in records.columns if c not in (key, order)])
    held = records.select(F.col(f"`{key}`").alias("conv"),
                          (F.col(f"`{order}`") if order else F.lit(0)).cast("long").alias("ord"), F.struct(*[F.col(f"`{c}`") for c in fields]).alias("rec"))
    schema = held.schema["rec"].dataType
    names = {f.name for f in schema.fields}
    print_ = fingerprint(schema, {p for m in mappings for p in (*m.needs, *m.may)})
    one = T.ArrayType(T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))

    def get(path: str) -> Column:
        parts = path.split(".")
        if parts[0] not in names:
            return F.lit(None).cast("string")
        c = F.col(f"`{parts[0]}`")
        for p in parts[1:]:
            c = c.getField(p)
        return c

    def rename(m: Mapping, role: Column) -> Column:
        for old, new in m.roles.items():
            role = F.when(role == old, F.lit(new)).otherwise(role)
        return role

    def turns(m: Mapping) -> Column:
        if m.row:
            out = F.array(F.struct(F.lit(0).alias("pos"), rename(m, get(m.row[0])).alias("role"), F.coalesce(get(m.row[1]), F.lit("")).alias("text")))
        elif m.messages:
            at, role, text = m.messages
            out = F.transform(F.col(f"`{at}`"), lambda x, i: F.struct(i.alias("pos"), rename(m, x.getField(role)).alias("role"),
                                                                     F.coalesce(x.getField(text), F.lit("")).alias("text")))
        else:
            out = F.array(*[F.when(F.coalesce(*[get(p) for p in paths]).isNotNull(),
                                   F.struct(F.lit(i).alias("pos"), F.lit(role).alias("role"), F.concat_ws("\n\n", *[get(p) for p in paths]).alias("text")))
                            for i, (role, *paths) in enumerate(m.turns)])
            out = F.filter(out, lambda x: x.isNotNull())
        return out.cast(one)

    # Shapes a mapping accepts, among the columns this table has: their hashes select it.
    raw = F.to_json(F.struct(*[F.col(f"`{c}`") for c in fields]))
    unknown = F.array(F.struct(F.lit(0).alias("pos"), F.lit(None).cast("string").alias("role"), F.when(raw == "{}", "").otherwise(raw).alias("text"))).cast(one)
    layout, body = F.lit(None).cast("string"), None
    fit = [m for m in mappings if {p.split("[")[0].split(".")[0] for p in m.needs} <= names]
    flat = held.select("conv", "ord", "rec.*").select("conv", "ord", *[F.col(f"`{c}`") for c in fields])
    flat = flat.withColumn("__print", print_)
    for m in reversed(fit):
        hit = F.col("__print").isin(*[F.xxhash64(F.lit(x)) for x in _shapes(m)])
        layout = F.when(hit, F.lit(m.name)).otherwise(layout)
        body = F.when(hit, turns(m)).otherwise(unknown if body is None else body)
    body = unknown if body is None else body
    return (flat.select("conv", "ord", F.coalesce(layout, F.lit("unknown")).alias("layout"), F.explode(body).alias("x"))
            .select("conv", "ord", "x.pos", "x.role", "x.text", "layout"))


def escape(c: Column) -> Column:
    """Reversible: every '<', '[' and backslash gets a backslash after it."""
    return F.regexp_replace(c, SPECIAL, r"$1\\")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, SPECIAL + r"\\", "$1")


def format_chats(turns: DataFrame) -> DataFrame:
    """``(conv, formatted, loss_spans)`` per conversation of canonical turns.

    A turn is ``<s>role[INST]text</s>``; a null role reads as empty.  ``loss_spans`` holds the code-point ranges
    [start, end) of assistant texts in ``formatted``.  Turns order by (ord, pos, role, text), so ties and repeated rows
    are kept and have one defined order.
    """
    rows = turns.select("conv", F.struct(F.col("ord"), F.col("pos"), escape(F.coalesce("role", F.lit(""))).alias("r"),
                                         escape(F.coalesce("text", F.lit(""))).alias("t")).alias("turn"))
    chat = rows.groupBy("conv").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    piece = F.transform("turns", lambda x: F.concat(F.lit(OPEN), x["r"], F.lit(SEP), x["t"], F.lit(CLOSE)))
    # Where each turn's text ends: a running sum kept as the last element of a growing list of ends.
    sizes = F.transform("turns", lambda x: F.struct(F.char_length(x["r"]).alias("r"), F.char_length(x["t"]).alias("t"),
                                                    (x["r"] == "assistant").alias("loss")))
    fixed = len(OPEN + SEP + CLOSE)
    walk = F.aggregate(F.col("sizes"), F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")),
                       lambda acc, x: F.struct((acc["at"] + x["r"] + x["t"] + fixed).alias("at"),
                                               F.when(x["loss"], F.array_append(acc["spans"], F.struct(
                                                   (acc["at"] + x["r"] + len(OPEN + SEP)).alias("start"),
                                                   (acc["at"] + x["r"] + x["t"] + len(OPEN + SEP)).alias("end"))))
                                               .otherwise(acc["spans"]).alias("spans")))
    return (chat.withColumn("sizes", sizes)
            .select("conv", F.concat_ws("", piece).alias("formatted"), walk["spans"].alias("loss_spans")))


def read_chats(formatted: Column) -> Column:
    """Turns ``array<struct<role, text>>`` read back from a formatted conversation."""
    pieces = F.filter(F.split(formatted, F.lit(r"\Q</s>\E")), lambda p: F.startswith(p, F.lit(OPEN)))
    cut = lambda p: F.instr(p, SEP)
    return F.transform(pieces, lambda p: F.struct(
        unescape(F.substr(p, F.lit(len(OPEN) + 1), F.instr(p, SEP) - len(OPEN) - 1)).alias("role"),
        unescape(F.substr(p, F.instr(p, SEP) + len(SEP))).alias("text")))


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.concat_ws("", F.transform(spans, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["end"] - s["start"]))))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(probe).alias("text")))
    chats = format_chats(canonical_turns(rows, "conv_id", "turn", ["role", "text"]))
    back = (chats.withColumn("turns", read_chats(F.col("formatted")))
            .withColumn("loss", masked_text(F.col("formatted"), F.col("loss_spans"))))
    return back.select(
        F.col("conv").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.concat_ws("", F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


ORACLE = r"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations
 UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM c)
SELECT conv_id, count(*) AS n_turns,
 sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
 CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
 sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
 CAST(sum(13 + length(regexp_replace(role, '([<\[\\])', '\1\\', 'g')) + length(regexp_replace(text, '([<\[\\])', '\1\\', 'g'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id"""
