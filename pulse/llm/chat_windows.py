"""Chat formatting: conversations as windows of whole turns within a token budget.

A turn is written as ``<s>[INST]role[/INST]text</s>``. These control strings inside roles
and texts get a backslash after their first character, and backslashes are doubled, so a
text can never open or close a turn and is read back exactly.

A window holds at most ``SPAN`` tokens (from the formatted length). It opens with the
conversation's system turn, repeats up to ``HISTORY`` turns before its first new one, as far
as they are short, and then holds its new turns. What system turn and history may take is
set aside first; the running sum of the turns' tokens is divided into spans of the rest, and
a turn belongs to the span its end lies in. If the turn that reaches in from an earlier span
does not fit beside the span's other turns, it is a window of its own. Only assistant texts
among the new turns are under the loss mask, so each is learned once. Turns are never cut:
more than ``SPAN`` tokens come only from a single new turn longer than what is left, or from
a system turn of more than half of ``SPAN``, with which new turns still get a quarter.

The running sum is taken in two steps, inside blocks of turns and over the block totals,
and history is an equi-join on turn numbers: no task sorts the texts of a whole
conversation. Only the digest of a conversation, which is a value over all its turns in
order, gathers its text.

Defined cases: rows are ordered by turn (null first), role, text; null role and text count
as empty; null ``conv_id`` is a conversation; repeated rows are turns of their own; an empty
table gives no windows; other columns are not looked at.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from pulse.llm.columns import text_or_empty
from pulse.session import shared_folder

SPAN = 1024  # tokens of a window
HISTORY = 2
HISTORY_TOKENS = 128  # longer turns are not repeated
CHARS_PER_TOKEN = 4
BLOCK = 256  # turns in a block of the running sum
CONTROL = "<s>", "</s>", "[INST]", "[/INST]"  # a turn is built of these


def escape(text):
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(
        F.regexp_replace(doubled, r"<(/?s>)", r"<\\$1"), r"\[(/?INST\])", r"[\\$1"
    )


def unescape(text):
    return F.regexp_replace(text, r"\\(.)", "$1")


def format_turn(role, text):
    return F.concat(F.lit("<s>[INST]"), escape(role), F.lit("[/INST]"), escape(text), F.lit("</s>"))


def _numbered(turns):
    """Turns with their number in the conversation and the tokens before them."""
    rows = turns.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        text_or_empty().alias("text"),
    ).withColumn("block", F.floor(F.col("turn") / BLOCK))
    rows = rows.withColumn("formatted", format_turn(F.col("role"), F.col("text")))
    tokens = F.ceil(F.length("formatted") / CHARS_PER_TOKEN)
    rows = rows.withColumn("tokens", tokens.cast("long"))
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("n", F.row_number().over(inside).cast("long")).withColumn(
        "sum", F.coalesce(F.sum("tokens").over(before), F.lit(0))
    )
    blocks = rows.groupBy("conv_id", "block").agg(
        F.count(F.lit(1)).alias("count"),
        F.sum("tokens").alias("total"),
        F.max(F.when((F.col("n") == 1) & (F.col("role") == "system"), F.col("tokens"))).alias("system"),
    )
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    blocks = blocks.select(
        F.col("conv_id").alias("b_conv"),
        F.col("block").alias("b_block"),
        F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("n_before"),
        F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before"),
        F.first("system").over(Window.partitionBy("conv_id").orderBy("block")).alias("system"),
    )
    same = F.col("conv_id").eqNullSafe(F.col("b_conv")) & F.col("block").eqNullSafe(F.col("b_block"))
    left = SPAN - HISTORY * HISTORY_TOKENS - F.coalesce("system", F.lit(0))
    rows = rows.join(blocks, same).select(
        "conv_id",
        (F.col("n_before") + F.col("n")).alias("n"),
        "role",
        "text",
        "formatted",
        "tokens",
        (F.col("before") + F.col("sum")).alias("start"),
        F.greatest(left, F.lit(SPAN // 4)).alias("room"),
    )
    rows = rows.withColumn("span", F.floor((F.col("start") + F.col("tokens") - 1) / F.col("room")))
    # The turns of a span are few: all but one lie in its ``room`` tokens.
    span = Window.partitionBy("conv_id", "span")
    too_full = F.sum("tokens").over(span) > F.col("room")
    inside = F.col("start") >= F.col("span") * F.col("room")
    window = 2 * F.col("span") + F.when(too_full & inside, 1).otherwise(0)
    return rows.withColumn("window", window).drop("start", "room", "span")


def format_windows(turns):
    """``conv_id, window, text, n_repeated, loss``; ``loss`` lists start and length of the
    texts under the mask, in code points of ``text``."""
    spark = turns.sparkSession
    folder = shared_folder(spark, "turns")
    _numbered(turns).write.parquet(folder)
    numbered = spark.read.parquet(folder)
    new = numbered.withColumn("repeated", F.lit(0))
    # First new turn of each window; the first window repeats nothing.
    firsts = (
        numbered.groupBy("conv_id", "window").agg(F.min("n").alias("first")).where("first > 1")
    )
    history = firsts.select(
        F.col("conv_id").alias("h_conv"),
        F.col("window").alias("h_window"),
        # the system turn opens the window whatever lies between
        F.explode(
            F.array_distinct(
                F.concat(
                    F.array(F.lit(1).cast("long")),
                    F.sequence(F.greatest(F.lit(1), F.col("first") - HISTORY), F.col("first") - 1),
                )
            )
        ).alias("h_n"),
        "first",
    )
    short = F.col("tokens") <= HISTORY_TOKENS
    recent = F.col("h_n") >= F.col("first") - HISTORY
    opening = (F.col("h_n") == 1) & (F.col("role") == "system")
    repeated = (
        numbered.drop("window")
        .join(history, F.col("conv_id").eqNullSafe(F.col("h_conv")) & (F.col("n") == F.col("h_n")))
        .where(opening | (recent & short))
        .withColumnRenamed("h_window", "window")
        .withColumn("repeated", F.lit(1))
        .select(new.columns)
    )
    rows = new.unionByName(repeated)
    order = Window.partitionBy("conv_id", "window").orderBy("n")
    start = F.coalesce(
        F.sum(F.length("formatted")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    written = F.length(escape(F.col("text")))
    rows = rows.withColumn("end", start + F.length("formatted") - len("</s>"))
    learned = (F.col("repeated") == 0) & (F.col("role") == "assistant")
    mask = F.when(learned, F.struct((F.col("end") - written).alias("start"), written.alias("chars")))
    gathered = rows.groupBy("conv_id", "window").agg(
        F.sort_array(F.collect_list(F.struct("n", "formatted"))).alias("turns"),
        F.sum("repeated").alias("n_repeated"),
        F.sort_array(F.collect_list(mask)).alias("loss"),
    )
    return gathered.select(
        "conv_id",
        "window",
        F.array_join(F.transform("turns", lambda t: t["formatted"]), "").alias("text"),
        "n_repeated",
        "loss",
    )


def read_windows(windows):
    """Per conversation the turns and the texts under the mask, from formatted windows."""
    parts = F.filter(F.split("text", r"</s>", -1), lambda p: p != "")
    turns = F.transform(
        F.slice("_parts", F.col("n_repeated").cast("int") + 1, F.size("_parts")),
        lambda p: F.concat(
            unescape(F.substring_index(F.substring(p, len("<s>[INST]") + 1, 1 << 30), "[/INST]", 1)),
            F.lit("\n"),
            unescape(F.substring_index(p, "[/INST]", -1)),
            F.lit("\n"),
        ),
    )
    learned = F.transform(
        "loss", lambda m: unescape(F.substring(F.col("text"), m["start"] + 1, m["chars"]))
    )
    read = windows.withColumn("_parts", parts).select(
        "conv_id",
        "window",
        turns.alias("turns"),
        F.array_join(learned, "").alias("learned"),
        F.length("text").alias("chars"),
    )
    return (
        read.groupBy("conv_id")
        .agg(
            F.sum(F.size("turns")).cast("long").alias("n_turns"),
            F.sort_array(
                F.collect_list(
                    F.struct("window", F.array_join("turns", "").alias("turns"), "learned")
                )
            ).alias("all"),
            F.sum("chars").cast("long").alias("formatted_chars"),
        )
        .select(
            "conv_id",
            "n_turns",
            F.array_join(F.transform("all", lambda w: w["turns"]), "").alias("turns"),
            F.array_join(F.transform("all", lambda w: w["learned"]), "").alias("learned"),
            "formatted_chars",
        )
    )


def with_probe(conversations):
    """Conversation -1, whose texts are made of control strings, beside the others."""
    probe = conversations.sparkSession.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)


def query(spark, sf_dir):
    turns = with_probe(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    folder = shared_folder(spark, "chat-windows")
    format_windows(turns).write.parquet(folder)
    return read_windows(spark.read.parquet(folder)).select(
        "conv_id",
        "n_turns",
        F.sha2(F.col("turns").cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


ORACLE = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, k, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(k, r)),
e AS (
  SELECT *, length(replace(text, '\', '\\'))
           + len(regexp_extract_all(text, '</?s>|\[/?INST\]'))
           + length(replace(role, '\', '\\'))
           + len(regexp_extract_all(role, '</?s>|\[/?INST\]'))
           + length('<s>[INST][/INST]</s>') AS chars
  FROM t),
ordered AS (
  SELECT conv_id, role, text, chars, (chars + 3) // 4 AS tokens,
         row_number() OVER o AS n,
         sum((chars + 3) // 4) OVER (o ROWS UNBOUNDED PRECEDING) AS upto
  FROM e WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
rooms AS (
  SELECT conv_id, greatest(256, 1024 - 256 - coalesce(max(tokens) FILTER (n = 1 AND role = 'system'), 0)) AS room
  FROM ordered GROUP BY conv_id),
spans AS (
  SELECT ordered.*, room, CAST((upto - 1) // room AS BIGINT) AS span
  FROM ordered JOIN rooms USING (conv_id)),
numbered AS (
  SELECT conv_id, role, text, chars, tokens, n,
         span + CASE WHEN upto - tokens < span * room THEN 0
                     WHEN sum(tokens) OVER (PARTITION BY conv_id, span) <= room THEN 0
                     ELSE 0.5 END AS win
  FROM spans),
firsts AS (
  SELECT conv_id, win, min(n) AS first FROM numbered GROUP BY conv_id, win HAVING min(n) > 1),
repeated AS (
  SELECT n.conv_id, sum(n.chars) AS chars
  FROM firsts f JOIN numbered n ON n.conv_id = f.conv_id AND n.n < f.first
   AND ((n.n = 1 AND n.role = 'system') OR (n.n >= f.first - 2 AND n.tokens <= 128))
  GROUP BY n.conv_id),
g AS (
  SELECT conv_id, count(*) AS n_turns, sum(chars) AS chars,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY n) AS turns,
         coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '') AS learned
  FROM numbered GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256,
       CAST(length(learned) AS BIGINT) AS loss_chars, sha256(learned) AS loss_sha256,
       CAST(g.chars + coalesce(repeated.chars, 0) AS BIGINT) AS formatted_chars
FROM g LEFT JOIN repeated USING (conv_id)
"""
