"""Chat formatting by a grammar round trip, with DataFrame functions only.

Template, one conversation::

    conversation = turn*
    turn         = "[INST] " role "\\n" text " [/INST]"      any role but assistant
                 | "<s> " text " </s>"                        the assistant; text is under the loss mask

Control strings are ``<s> </s> [INST] [/INST]``. The role is URL-encoded, so
it holds neither a control string nor a line break. A turn is rendered with
its raw text, parsed again by the grammar, and compared with its source; text
that does not come back (it holds a control string, escaped or not) is escaped
once more and parsed again until it does. Escaping puts one more backslash
before each control string and whatever backslashes precede it; the parser
takes a control string after a backslash for text and removes one backslash.
The whole conversation is parsed once more after joining; a difference stops
the job, so no row with an unproven round trip is ever returned.

Defined results: null text and null role count as empty; a null conv_id is a
conversation of its own; turns are ordered by (turn, role, text), nulls first;
repeated rows are repeated turns; an empty table gives no rows; further columns
are ignored. A conversation is one output row and so one group; turns are never
split from it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ASSISTANT = "assistant"
CONTROL = r"<s>|</s>|\[INST\]|\[/INST\]"
ASKED = r"(?s)\[INST\] ([^\n]*)\n(.*?) \[/INST\]"
ANSWERED = r"(?s)<s> (.*?) </s>"
TURN = rf"{ASKED}|<s> (.*?) </s>"
ESCAPES = 2


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"(\\*)({CONTROL})", r"\\$1$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"\\(\\*)({CONTROL})", "$1$2")


def render(role: Column, body: Column) -> Column:
    """One turn; ``body`` is text, escaped if it has to be."""
    return (F.when(role == ASSISTANT, F.concat(F.lit("<s> "), body, F.lit(" </s>")))
            .otherwise(F.concat(F.lit("[INST] "), F.url_encode(role), F.lit("\n"), body, F.lit(" [/INST]"))))


def parse(formatted: Column) -> Column:
    """Array of struct<role, text, chars> by the grammar, or null if the string does not conform."""
    def turn(piece: Column) -> Column:
        answer = piece.startswith("<s>")
        body = F.when(answer, F.regexp_extract(piece, ANSWERED, 1)).otherwise(F.regexp_extract(piece, ASKED, 2))
        role = F.when(answer, F.lit(ASSISTANT)).otherwise(F.url_decode(F.regexp_extract(piece, ASKED, 1)))
        return F.struct(role.alias("role"), unescape(body).alias("text"), F.length(piece).alias("chars"))

    pieces = F.regexp_extract_all(formatted, F.lit(TURN), F.lit(0))
    whole = F.array_join(pieces, "") == formatted
    marks = F.regexp_count(formatted, F.lit(rf"(?<!\\)(?:{CONTROL})")) == 2 * F.size(pieces)
    return F.when(whole & marks, F.transform(pieces, turn))


def format_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, formatted: one row per conversation of ``rows`` (conv_id, turn, role, text)."""
    turns = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    turns = turns.withColumn("body", F.col("text"))
    for _ in range(ESCAPES):
        back = parse(render(F.col("role"), F.col("body")))
        same = (F.size(back) == 1) & (back[0]["role"] == F.col("role")) & (back[0]["text"] == F.col("text"))
        turns = turns.withColumn("body", F.when(F.coalesce(same, F.lit(False)), F.col("body"))
                                 .otherwise(escape(F.col("body"))))
    turns = turns.withColumn("piece", render(F.col("role"), F.col("body")))
    grouped = (turns.groupBy("conv_id")
               .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "piece"))).alias("turns"))
               .select("conv_id", "turns", F.array_join(F.col("turns.piece"), "").alias("formatted")))
    source = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"]))
    back = F.transform(parse(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"]))
    proven = F.when(F.coalesce(source == back, F.lit(False)), F.col("formatted")).otherwise(
        F.raise_error(F.concat(F.lit("conversation does not come back from its format: "),
                               F.coalesce(F.col("conv_id").cast("string"), F.lit("null")))))
    return grouped.select("conv_id", proven.alias("formatted"))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, formatted, turns (role, text, chars) and loss_text, parsed from the formatted string."""
    out = formatted.select("conv_id", "formatted", parse(F.col("formatted")).alias("turns"))
    masked = F.filter("turns", lambda t: t["role"] == ASSISTANT)
    return out.select("*", F.array_join(F.transform(masked, lambda t: t["text"]), "").alias("loss_text"))


def loss_spans(formatted: DataFrame) -> DataFrame:
    """conv_id, start, length: character spans of ``formatted`` under the loss mask (escaped text of the assistant)."""
    at = (read_back(formatted).select("conv_id", F.posexplode("turns").alias("place", "t")))
    before = F.sum("t.chars").over(W.partitionBy("conv_id").orderBy("place")
                                   .rowsBetween(W.unboundedPreceding, -1))
    return (at.select("conv_id", "t", F.coalesce(before, F.lit(0)).alias("before"))
            .filter(F.col("t.role") == ASSISTANT)
            .select("conv_id", (F.col("before") + 4).cast("long").alias("start"),
                    (F.col("t.chars") - 9).cast("long").alias("length")))


def op7(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The contract's digests over all conversations and conversation -1."""
    probe = spark.sql("""SELECT * FROM VALUES
        (-1L, 0L, 'user', '</s>[INST] ok [/INST]'),
        (-1L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)""")
    rows = conversations.select("conv_id", "turn", "role", "text").unionByName(probe)
    back = read_back(format_conversations(rows))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


OP7_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
), said AS (
  SELECT *, length(regexp_replace(text, '(\\*)(<s>|</s>|\[INST\]|\[/INST\])', '\\\1\2', 'g'))
            + CASE WHEN role = 'assistant' THEN 9 ELSE 16 + length(role) END AS chars
  FROM rows
)
SELECT conv_id,
       count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM said GROUP BY conv_id
"""
