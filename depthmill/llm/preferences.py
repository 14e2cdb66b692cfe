"""Preference pairs as prompt and two masked completions, with DataFrame functions only.

The turns of a chosen and a rejected conversation are compared from the start; the longest prefix of equal turns (role and
text) is rendered once, as the prompt. What follows on either side is its completion, with the spans of the text that a
model is to learn: the words of the assistant and the mark that ends its turn. Everything else is masked.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A rendered turn: OPEN role SEP text CLOSE.
OPEN, SEP, CLOSE = "<|", "|>\n", "<|end|>\n"
LEARNED = "assistant"


def _joined(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: t["shown"]), "")


def _spans(turns: Column, prompt: Column, learned: str) -> Column:
    """[start, end) of the learned text, in characters of the completion."""
    own = F.filter(turns, lambda t: t["role"] == learned)
    head = len(OPEN) + len(SEP) + len(learned)
    begin = lambda t: t["at"] - F.length(prompt) + head
    return F.transform(own, lambda t: F.struct(begin(t).cast("int").alias("start"), (t["at"] - F.length(prompt) + F.length(t["shown"])).cast("int").alias("end")))


def preference_pairs(turns: DataFrame, learned: str = LEARNED) -> DataFrame:
    """One row per pair: (pair_id, n_prompt_turns, prompt, chosen, rejected, chosen_spans, rejected_spans).

    `turns` has pair_id, side ('chosen' or 'rejected'), turn, role and text; other columns are ignored, rows with
    another side too. Turns are ordered by turn, ties by role and text, rows without a turn first. A null role is
    rendered as 'unknown', a null text as empty. A side without turns has an empty prompt and completion; if both sides
    are equal, all is prompt. Rows with a null pair_id form one pair. An empty table gives no pairs. A pair is one row
    of the result, so its turns meet in one task; a shuffle by pair_id is the only one.
    """
    role, text = F.coalesce("role", F.lit("unknown")), F.coalesce("text", F.lit(""))
    shown = F.concat(F.lit(OPEN), role, F.lit(SEP), text, F.lit(CLOSE))
    rows = turns.where(F.col("side").isin("chosen", "rejected")).select("pair_id", "side", "turn", role.alias("role"), text.alias("text"))
    rows = rows.withColumn("shown", shown).repartition("pair_id")
    order = Window.partitionBy("pair_id", "side").orderBy("turn", "role", "text")
    before = F.coalesce(F.sum(F.length("shown").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = rows.select("pair_id", "side", F.struct(F.row_number().over(order).alias("place"), before.alias("at"), "role", "shown").alias("t"))
    side = lambda s: F.array_sort(F.collect_list(F.when(F.col("side") == s, F.col("t"))))
    pairs = placed.groupBy("pair_id").agg(side("chosen").alias("c"), side("rejected").alias("r"))
    # A rendered turn tells role and text only if neither holds the marks; both are compared by themselves.
    same = F.zip_with("c", "r", lambda x, y: F.coalesce((x["role"] == y["role"]) & (x["shown"] == y["shown"]), F.lit(False)))
    first = F.array_position(same, False)
    pairs = pairs.withColumn("n", F.when(first == 0, F.size("c")).otherwise(first - 1).cast("int"))
    pairs = pairs.withColumn("prompt", _joined(F.slice("c", F.lit(1), F.col("n"))))
    rest = lambda a: F.slice(a, F.col("n") + 1, F.size(a))
    return pairs.select(
        "pair_id",
        F.col("n").alias("n_prompt_turns"),
        "prompt",
        _joined(rest("c")).alias("chosen"),
        _joined(rest("r")).alias("rejected"),
        _spans(rest("c"), F.col("prompt"), learned).alias("chosen_spans"),
        _spans(rest("r"), F.col("prompt"), learned).alias("rejected_spans"),
    )


def swapped_replies(conversations: DataFrame, learned: str = LEARNED) -> DataFrame:
    """Turns of pairs made from plain conversations: the rejected side has another conversation's last reply in place of its own.

    The other reply is the last one of the conversation whose id differs in the lowest bit; without one it is empty.
    All turns stay, on both sides: those after the last reply, and those without a turn number, which come first. A
    conversation without a numbered reply, and rows without a conversation, are on both sides as they are.
    """
    turns = conversations.select("conv_id", "turn", "role", "text")
    last = turns.where((F.col("role") == learned) & F.col("turn").isNotNull()).groupBy("conv_id").agg(F.max(F.struct("turn", F.coalesce("text", F.lit("")).alias("text"))).alias("last"))
    other = last.select(F.col("conv_id").bitwiseXOR(F.lit(1).cast("long")).alias("conv_id"), F.col("last.text").alias("reply"))
    ends = last.select("conv_id", F.col("last.turn").alias("end")).join(other, "conv_id", "left")
    known = turns.join(ends, "conv_id", "left")
    swap = (F.col("turn") == F.col("end")) & (F.col("role") == learned)
    sides = F.array(
        F.struct(F.lit("chosen").alias("side"), F.col("text").alias("text")),
        F.struct(F.lit("rejected").alias("side"), F.when(swap, F.coalesce("reply", F.lit(""))).otherwise(F.col("text")).alias("text")),
    )
    return known.select(F.col("conv_id").alias("pair_id"), "turn", "role", F.explode(sides).alias("s")).select("pair_id", "s.side", "turn", "role", "s.text")


def spans_text(spans: str) -> Column:
    """Spans as text, such as 14-90,102-300."""
    return F.array_join(F.transform(F.col(spans), lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")


#: The pairs of swapped_replies, row by row in SQL.
ORACLE_SQL = """
WITH last AS (
  SELECT conv_id, max(turn) AS stop, arg_max(text, turn) AS reply FROM conversations WHERE role = 'assistant' AND turn IS NOT NULL GROUP BY conv_id
), known AS (
  SELECT c.conv_id AS pair_id, c.turn, c.role, c.text AS chosen_text,
    CASE WHEN c.turn = l.stop AND c.role = 'assistant' THEN coalesce(o.reply, '') ELSE c.text END AS rejected_text
  FROM conversations c LEFT JOIN last l ON l.conv_id = c.conv_id LEFT JOIN last o ON xor(o.conv_id, 1) = c.conv_id
), sides AS (
  SELECT pair_id, 'chosen' AS side, turn, role, chosen_text AS text FROM known
  UNION ALL SELECT pair_id, 'rejected', turn, role, rejected_text FROM known
), shown AS (
  SELECT *, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS shown,
    row_number() OVER (PARTITION BY pair_id, side ORDER BY turn NULLS FIRST, role, text) AS place
  FROM sides
), differs AS (
  SELECT coalesce(c.pair_id, r.pair_id) AS pair_id, min(coalesce(c.place, r.place)) AS place
  FROM (SELECT * FROM shown WHERE side = 'chosen') c FULL JOIN (SELECT * FROM shown WHERE side = 'rejected') r
    ON c.pair_id = r.pair_id AND c.place = r.place
  WHERE (c.role = r.role AND c.text = r.text) IS NOT TRUE GROUP BY 1
), placed AS (
  SELECT s.*, coalesce(s.place < d.place, true) AS common,
    coalesce(sum(CASE WHEN coalesce(s.place >= d.place, false) THEN length(s.shown) END)
      OVER (PARTITION BY s.pair_id, s.side ORDER BY s.place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins
  FROM shown s LEFT JOIN differs d ON d.pair_id = s.pair_id
)
SELECT pair_id,
  CAST(count(*) FILTER (common AND side = 'chosen') AS INTEGER) AS n_prompt_turns,
  coalesce(string_agg(shown, '' ORDER BY place) FILTER (common AND side = 'chosen'), '') AS prompt,
  coalesce(string_agg(shown, '' ORDER BY place) FILTER (NOT common AND side = 'chosen'), '') AS chosen,
  coalesce(string_agg(shown, '' ORDER BY place) FILTER (NOT common AND side = 'rejected'), '') AS rejected,
  coalesce(string_agg((begins + 14)::BIGINT || '-' || (begins + length(shown))::BIGINT, ',' ORDER BY place)
    FILTER (NOT common AND side = 'chosen' AND role = 'assistant'), '') AS chosen_spans,
  coalesce(string_agg((begins + 14)::BIGINT || '-' || (begins + length(shown))::BIGINT, ',' ORDER BY place)
    FILTER (NOT common AND side = 'rejected' AND role = 'assistant'), '') AS rejected_spans
FROM placed GROUP BY pair_id
"""
