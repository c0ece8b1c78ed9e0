"""Chat formatting by schema fingerprints.

A record is one JSON object. The tree of its field names, without values and types, is hashed; the
hash selects a mapping, declared below, that turns the record into canonical turns. Turns are then
written with a template whose control strings cannot occur inside a text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayblotter.llm.common import table, without

TURN, SEP, END = "<|turn|>", "<|says|>", "<|end|>"
_TURNS = "array<struct<role string, text string>>"


@dataclass(frozen=True)
class Mapping:
    """A layout: the trees of field names it covers, and an expression over `_record` for its turns."""

    name: str
    trees: Sequence[str]
    turns: str


def _listed(field: str, role: str, text: str) -> str:
    return f"transform(_record.{field}, m -> named_struct('role', m.`{role}`, 'text', m.{text}))"


def _said(*pairs: tuple[str, str]) -> str:
    """Turns from fields; an absent system text or input makes no turn."""
    turns = ", ".join(
        f"named_struct('role', '{role}', 'text', _record.{field})"
        for role, field in pairs
    )
    return f"filter(array({turns}), t -> t.role <> 'system' or t.text is not null)"


MAPPINGS = [
    Mapping("messages", ["{messages:[{content,role}]}"], _listed("messages", "role", "content")),
    Mapping("turns", ["{turns:[{role,text}]}"], _listed("turns", "role", "text")),
    Mapping("conversations", ["{conversations:[{from,value}]}"], _listed("conversations", "from", "value")),
    Mapping(
        "instruction",
        ["{instruction,output}", "{input,instruction,output}"],
        "array(named_struct('role', 'user', 'text', concat_ws('\\n\\n', "
        "_record.instruction, "
        "nullif(_record.input, ''))), "
        "named_struct('role', 'assistant', 'text', _record.output))",
    ),
    Mapping(
        "prompt",
        ["{completion,prompt}", "{completion,prompt,system}"],
        _said(("system", "system"), ("user", "prompt"), ("assistant", "completion")),
    ),
    Mapping(
        "response",
        ["{prompt,response}", "{prompt,response,system}"],
        _said(("system", "system"), ("user", "prompt"), ("assistant", "response")),
    ),
    Mapping("question", ["{answer,question}"], _said(("user", "question"), ("assistant", "answer"))),
]

# Every field that the mappings read. Unlike a variant, of 128 MiB at most, this has no limit of its own.
_FIELDS = (
    "messages array<struct<role string, content string>>, turns array<struct<role string, text string>>, "
    "conversations array<struct<`from` string, value string>>, instruction string, input string, output string, "
    "prompt string, completion string, response string, system string, question string, answer string, "
    "_damaged string"
)
_READING = {"maxStringLen": str(2**31 - 1), "columnNameOfCorruptRecord": "_damaged"}

# Quantifiers are possessive: others take stack by the match.
_STRING = r'"[^"\\\x00-\x1f]*+(?:\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})[^"\\\x00-\x1f]*+)*+"'
_ANY_STRING = r'"[^"\\]*+(?:(?s:\\.)[^"\\]*+)*+"'
_NAME = _ANY_STRING + r"\s*+:"
_FLAT = r'\{(?:[^{}\[\]"]|' + _ANY_STRING + r")*+\}"
MOST_SKELETON = 100_000_000  # bytes of JSON, whose variant is surely within 128 MiB

# Role names that other layouts use.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def fingerprint_of(tree: str) -> str:
    return hashlib.md5(tree.encode()).hexdigest()


def field_tree(record: Column) -> Column:
    """Nested field names of a variant, sorted, as `{a,b:[{c}]}`: leaf types are left out."""
    shape = F.schema_of_variant(record)
    for found, put in [
        (r": (?:BIGINT|BOOLEAN|DATE|DOUBLE|FLOAT|STRING|TIMESTAMP|TIMESTAMP_NTZ|BINARY|VARIANT|VOID|UUID|DECIMAL\(\d+,\d+\))(?=[,>])", ""),
        (r"(?:^|(?<=: )|(?<=<))OBJECT<", "{"),
        (r"(?:^|(?<=: )|(?<=<))ARRAY<", "["),
        (": ", ":"),
        (", ", ","),
    ]:
        shape = F.regexp_replace(shape, found, put)
    # Closing brackets follow from the opening ones; a name never ends in one without being quoted.
    return shape


def skeleton(record: Column) -> Column:
    """A JSON text without its texts, of the same tree: strings are empty, equal flat neighbours are one.

    Names stay, and so do strings that are no JSON, for a parser to refuse.
    """
    emptied = F.regexp_replace(record, rf'({_NAME})|(")(?:{_STRING[1:-1]})(")|({_ANY_STRING})', "$1$2$3$4")
    return F.regexp_replace(emptied, rf"({_NAME})|({_FLAT})(?:\s*+,\s*+\2)++", "$1$2")


def _closed(tree: str) -> str:
    """A declared tree as `field_tree` writes it, which closes every bracket with `>`."""
    return tree.replace("}", ">").replace("]", ">")


def escape(text: Column) -> Column:
    """A text in which no control string can begin; `unescape` gives the text back.

    Backslashes are doubled, and one is put after the first character of every control string, the
    template's own and those of other common templates.
    """
    text = F.regexp_replace(F.coalesce(text, F.lit("")), r"\\", r"\\\\")
    text = F.regexp_replace(text, r"<(?=\||/?s>)", r"<\\")
    return F.regexp_replace(text, r"\[(?=/?INST\])", r"[\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def canonical_turns(records: DataFrame, record: str) -> DataFrame:
    """Records with `schema_fingerprint`, `layout` and `turns`.

    `record` names a column of JSON texts. A null, damaged or empty text, one that is no object and
    one whose tree no mapping covers keep their row, with null `layout` and `turns`. A null text in
    a turn becomes empty, a null role becomes `user`. Repeated rows are kept. Input columns named
    like added ones give way to them.

    Names are taken from the record's `skeleton`, texts by a reader without a limit on their length.
    A skeleton above `MOST_SKELETON` is an error.
    """
    held = without(records, ["schema_fingerprint", "layout", "turns", "_record", "_skeleton"])
    parsed = held.withColumn("_skeleton", skeleton(F.col(f"`{record}`")))
    short = F.when(
        F.octet_length("_skeleton") > MOST_SKELETON, F.raise_error(F.lit("a record has too many fields")).cast("string")
    ).otherwise(F.col("_skeleton"))
    parsed = parsed.withColumn("schema_fingerprint", F.md5(field_tree(F.try_parse_json(short)))).drop("_skeleton")
    parsed = parsed.withColumn("_record", F.from_json(F.col(f"`{record}`"), _FIELDS, _READING))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(_TURNS)
    for mapping in MAPPINGS:
        prints = [fingerprint_of(_closed(tree)) for tree in mapping.trees]
        chosen = F.col("schema_fingerprint").isin(prints) & F.col("_record._damaged").isNull()
        layout = F.when(chosen, F.lit(mapping.name)).otherwise(layout)
        turns = F.when(chosen, F.expr(mapping.turns).cast(_TURNS)).otherwise(turns)
    names = F.create_map(*[F.lit(word) for pair in ROLES.items() for word in pair])
    plain = F.transform(
        turns,
        lambda turn: F.struct(
            F.coalesce(names[turn["role"]], turn["role"], F.lit("user")).alias("role"),
            F.coalesce(turn["text"], F.lit("")).alias("text"),
        ),
    )
    return parsed.withColumn("layout", layout).withColumn("turns", plain).drop("_record")


def format_turns(records: DataFrame) -> DataFrame:
    """Records with `formatted` and `segments`, from `turns`; null turns give nulls.

    `segments` are the pieces of `formatted` in order, each with `loss`: true for what a model is to
    be trained on, the assistant's texts. Their concatenation is `formatted`.
    """
    def pieces(turn: Column) -> Column:
        opening = F.concat(F.lit(TURN), escape(turn["role"]), F.lit(SEP))
        return F.array(
            F.struct(opening.alias("piece"), F.lit(False).alias("loss")),
            F.struct(escape(turn["text"]).alias("piece"), (turn["role"] == "assistant").alias("loss")),
            F.struct(F.lit(END).alias("piece"), F.lit(False).alias("loss")),
        )

    rows = without(records, ["formatted", "segments"])
    rows = rows.withColumn("segments", F.flatten(F.transform("turns", pieces)))
    return rows.withColumn("formatted", F.concat_ws("", F.col("segments.piece"))).withColumn(
        "formatted", F.when(F.col("segments").isNotNull(), F.col("formatted"))
    )


def read_back(formatted: Column) -> Column:
    """The turns in a formatted text."""
    found = F.filter(F.split(formatted, r"<\|turn\|>"), lambda piece: piece != "")
    return F.transform(
        found,
        lambda piece: F.struct(
            unescape(F.substring_index(piece, SEP, 1)).alias("role"),
            unescape(F.substring_index(F.substring_index(piece, SEP, -1), END, 1)).alias("text"),
        ),
    )


def records_of(turns: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """One JSON record in the `messages` layout per conversation of a table with a row per turn.

    Turns are ordered by number, nulls first, ties by role and text. A conversation is one record, so
    one task gathers it; its length is that of a text to be trained on.
    """
    message = F.struct(
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("user")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("content"),
    )
    sorted_messages = F.sort_array(F.collect_list(message))
    return (
        turns.groupBy(F.col(f"`{key}`").alias(key))
        .agg(sorted_messages.alias("_messages"))
        .select(
            f"`{key}`",
            F.to_json(
                F.struct(
                    F.transform(
                        "_messages", lambda m: F.struct(m["content"].alias("content"), m["role"].alias("role"))
                    ).alias("messages")
                )
            ).alias("record"),
        )
    )


_PROBE = "</s>[INST] ok [/INST]"


def op2_chat_format(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.sql(
        f"select -1L conv_id, i turn, if(i = 0, 'user', 'assistant') role, '{_PROBE}' text "
        "from (select explode(sequence(0L, 1L)) i)"
    )
    records = records_of(turns.unionByName(probe), "conv_id", "turn", "role", "text")
    known = canonical_turns(records, "record")
    # Every record was made above, so one that is not understood is a fault, not damaged input.
    lost = F.concat(F.lit("no layout for the record of conversation "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null")))
    known = known.withColumn("turns", F.coalesce("turns", F.raise_error(lost).cast(_TURNS)))
    formatted = format_turns(known)
    read = read_back(F.col("formatted"))
    said = F.concat_ws(
        "", F.transform("_read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    )
    loss = unescape(F.concat_ws("", F.col("_loss.piece")))
    return (
        formatted.withColumn("_read", read)
        .withColumn("_loss", F.filter("segments", lambda s: s["loss"]))
        .select(
            "conv_id",
            F.size("_read").cast("long").alias("n_turns"),
            F.sha2(said, 256).alias("turns_sha256"),
            F.length(loss).cast("long").alias("loss_chars"),
            F.sha2(loss, 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
        )
    )


ORACLE = f"""
with rows as (
  select conv_id, turn, coalesce(role, 'user') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '{_PROBE}' union all select -1, 1, 'assistant', '{_PROBE}'
), escaped as (
  select *, regexp_replace(regexp_replace(regexp_replace(replace(text, '\\', '\\\\'),
    '<\\|', '<\\\\|', 'g'), '<(/?s>)', '<\\\\\\1', 'g'), '\\[(/?INST\\])', '[\\\\\\1', 'g') as safe from rows
)
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(length(role) + length(safe) + {len(TURN) + len(SEP) + len(END)})::bigint as formatted_chars
from escaped group by conv_id
"""
