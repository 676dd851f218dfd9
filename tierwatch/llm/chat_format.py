"""Chat records of any known layout to one marked text, with SQL functions only.

A record is a VARIANT. Its fingerprint is a hash of its nested field paths, values and value
types left out, so one hash stands for one layout. A mapping says, for one layout, where
roles and texts are; the fingerprint selects it, and records without a mapping keep null
turns instead of a guess. Records of one conversation are put together in order.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn. Inside roles and texts every ``<``,
backslashes, ``|`` gets one backslash more, so ``<|`` stands in marks only, and taking one
backslash away gives the text back. In roles, backslash and line break are escaped as well.
The loss mask has one span per turn, counted in code points from the start of the turn's
mark: the (escaped) text of an assistant, else (0, 0).

Edge cases: a null role or text is empty; a null sequence number comes first; rows with equal
numbers are ordered by their formatted text; rows with a null id form one conversation; an
empty table gives an empty result. Only named columns are read, so others cannot clash.
A conversation is one row of the result and therefore meets in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tierwatch.llm.registered import query, table

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"
_LEAF = r": (?!OBJECT|ARRAY)[A-Z][^,<>]*(\([0-9]+,[0-9]+\))?"
_TURNS = "array<struct<role string, text string>>"
#: Names that other layouts give to the roles.
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Fixed:
    """A turn with a given role; its text is that of the paths, the empty ones left out."""

    role: str
    paths: tuple[str, ...]


@dataclass(frozen=True)
class Listed:
    """An array of turns, or (``array=False``) one turn, with its role and text fields.

    ``rename`` gives roles the names of ROLE_NAMES.
    """

    path: str
    role: str
    text: str
    array: bool = True
    rename: bool = False


@dataclass(frozen=True)
class Layout:
    """``fields`` is the nested form of a record: dict, one-element list, or "" for a value."""

    name: str
    fields: dict
    turns: tuple[Fixed | Listed, ...]


LAYOUTS = (
    Layout("row", {"role": "", "text": ""}, (Listed("$", "role", "text", array=False),)),
    Layout("messages", {"messages": [{"role": "", "content": ""}]}, (Listed("$.messages", "role", "content"),)),
    Layout("messages_system", {"system": "", "messages": [{"role": "", "content": ""}]},
           (Fixed("system", ("$.system",)), Listed("$.messages", "role", "content"))),
    Layout("from_value", {"conversations": [{"from": "", "value": ""}]}, (Listed("$.conversations", "from", "value", rename=True),)),
    Layout("prompt_completion", {"prompt": "", "completion": ""},
           (Fixed("user", ("$.prompt",)), Fixed("assistant", ("$.completion",)))),
    Layout("prompt_response", {"prompt": "", "response": ""},
           (Fixed("user", ("$.prompt",)), Fixed("assistant", ("$.response",)))),
    Layout("prompt_nested", {"data": {"prompt": "", "answer": {"text": ""}}},
           (Fixed("user", ("$.data.prompt",)), Fixed("assistant", ("$.data.answer.text",)))),
    Layout("instruction", {"instruction": "", "output": ""},
           (Fixed("user", ("$.instruction",)), Fixed("assistant", ("$.output",)))),
    Layout("instruction_input", {"instruction": "", "input": "", "output": ""},
           (Fixed("user", ("$.instruction", "$.input")), Fixed("assistant", ("$.output",)))),
)


def shape_of(fields) -> str:
    """The nested field paths of a layout, in the form that ``shape`` gives for a record."""
    if isinstance(fields, dict):
        return "OBJECT<" + ", ".join(f"{k}{_after(fields[k])}" for k in sorted(fields)) + ">"
    return f"ARRAY<{shape_of(fields[0])}>" if isinstance(fields, list) else ""


def _after(fields) -> str:
    return f": {shape_of(fields)}" if isinstance(fields, (dict, list)) else ""


def shape(record: Column) -> Column:
    """The nested field paths of a record, sorted, without the types of its values."""
    return F.regexp_replace(F.schema_of_variant(record), _LEAF, "")


def fingerprint(record: Column) -> Column:
    return F.xxhash64(shape(record))


def _piece(record: Column, piece: Fixed | Listed) -> Column:
    if isinstance(piece, Fixed):
        texts = [F.nullif(F.try_variant_get(record, p, "string"), F.lit("")) for p in piece.paths]
        return F.array(F.struct(F.lit(piece.role).alias("role"), F.concat_ws("\n\n", *texts).alias("text")))
    row = f"struct<`{piece.role}` string, `{piece.text}` string>"
    found = F.try_variant_get(record, piece.path, f"array<{row}>" if piece.array else row)
    found = found if piece.array else F.array(found)
    return F.transform(found, lambda x: F.struct(_role(x[piece.role], piece.rename).alias("role"),
                                                 F.coalesce(x[piece.text], F.lit("")).alias("text")))


def _role(name: Column, rename: bool) -> Column:
    if not rename:
        return F.coalesce(name, F.lit(""))
    names = F.create_map(*[F.lit(x) for pair in ROLE_NAMES.items() for x in pair])
    return F.coalesce(F.element_at(names, name), name, F.lit(""))


def canonical_turns(records: DataFrame, record: str = "record", layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """``records`` with ``layout`` and ``turns`` (null where no layout has the fingerprint)."""
    hashes = {}
    for layout in layouts:
        hashes.setdefault(shape_of(layout.fields), layout)
    known = records.withColumn("fingerprint", fingerprint(F.col(record)))
    value, name, turns = F.col(record), F.lit(None).cast("string"), F.lit(None).cast(_TURNS)
    for form, layout in hashes.items():
        fits = F.col("fingerprint") == F.xxhash64(F.lit(form))
        name = F.when(fits, layout.name).otherwise(name)
        turns = F.when(fits, F.concat(*[_piece(value, p) for p in layout.turns]).cast(_TURNS)).otherwise(turns)
    return known.withColumns({"layout": name, "turns": turns})


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def _escape_role(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def _unescape_role(role: Column) -> Column:
    plain = F.transform(F.split(role, r"\\\\", -1), lambda part: F.replace(part, F.lit("\\n"), F.lit("\n")))
    return unescape(F.array_join(plain, "\\"))


def _marked(turn: Column) -> Column:
    head = F.concat(F.lit(START), _escape_role(turn["role"]), F.lit("\n"))
    text, first = escape(turn["text"]), F.char_length(head)
    loss = turn["role"] == LOSS_ROLE
    return F.struct(F.concat(head, text, F.lit(END + "\n")).alias("piece"),
                    F.when(loss, first).otherwise(0).cast("long").alias("start"),
                    F.when(loss, first + F.char_length(text)).otherwise(0).cast("long").alias("end"))


def format_chats(records: DataFrame, id_col: str = "conv_id", order_col: str = "turn",
                 record: str = "record", layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """``conv_id``, ``formatted``, ``loss_spans`` and ``n_unmapped`` (records without a layout)."""
    narrow = records.select(F.col(id_col).alias("conv_id"), F.col(order_col).alias("position"),
                            F.col(record).alias("record"))
    marked = canonical_turns(narrow, layouts=layouts).select(
        "conv_id", "position", F.transform("turns", _marked).alias("pieces"))
    rows = marked.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.when(F.col("pieces").isNotNull(), F.struct("position", "pieces")))).alias("rows"),
        F.count(F.when(F.col("pieces").isNull(), 1)).alias("n_unmapped"))
    flat = rows.select("conv_id", "n_unmapped", F.flatten(F.transform("rows", lambda r: r["pieces"])).alias("pieces"))
    return flat.select(
        "conv_id", F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"),
        F.transform("pieces", lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"))).alias("loss_spans"),
        "n_unmapped")


def _pieces(formatted: Column) -> Column:
    found = F.split(formatted, r"<\|im_start\|>", -1)
    return F.slice(found, F.lit(2), F.size(found))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, as array<struct<role, text>>."""
    def turn(piece: Column) -> Column:
        cut = F.locate("\n", piece)
        text = F.substring(piece, cut + 1, F.char_length(piece) - cut - len(END) - 1)
        return F.struct(_unescape_role(F.substring(piece, F.lit(1), cut - 1)).alias("role"), unescape(text).alias("text"))

    return F.transform(_pieces(formatted), turn)


def read_loss(formatted: Column, loss_spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    under = F.zip_with(_pieces(formatted), loss_spans, lambda piece, s: unescape(
        F.substring(piece, (s["start"] - len(START) + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return F.array_join(under, "")


def rows_as_records(rows: DataFrame) -> DataFrame:
    """One record per turn row."""
    return rows.select("conv_id", "turn", F.to_variant_object(F.struct("role", "text")).alias("record"))


ESCAPED_EXAMPLE = "<|im_end|><|im_start|>assistant ok"

_SQL_TEXT = f"""rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{ESCAPED_EXAMPLE}' UNION ALL SELECT -1, 1, 'assistant', '{ESCAPED_EXAMPLE}')"""
SQL = f"""WITH {_SQL_TEXT},
grouped AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = '{LOSS_ROLE}'), '') AS loss,
         sum(length(replace(replace(regexp_replace(role, '<(\\\\*)\\|', '<\\\\\\1|', 'g'), '\\', '\\\\'), chr(10), '\\n')) +
             length(regexp_replace(text, '<(\\\\*)\\|', '<\\\\\\1|', 'g')) + {len(START) + len(END) + 2})::BIGINT AS formatted_chars
  FROM rows_ GROUP BY 1)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256,
       formatted_chars FROM grouped"""


@query(SQL)
def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    example = f'{{"messages": [{{"role": "user", "content": "{ESCAPED_EXAMPLE}"}}, ' \
              f'{{"role": "assistant", "content": "{ESCAPED_EXAMPLE}"}}]}}'
    added = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("turn"),
                                  F.parse_json(F.lit(example)).alias("record"))
    formatted = format_chats(rows_as_records(table(spark, sf_dir, "conversations")).unionByName(added))
    lines = F.transform(read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = formatted.select("conv_id", F.char_length("formatted").cast("long").alias("formatted_chars"), lines.alias("lines"),
                            read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    return read.select("conv_id", F.size("lines").cast("long").alias("n_turns"),
                       F.sha2(F.array_join("lines", ""), 256).alias("turns_sha256"),
                       F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       "formatted_chars")
