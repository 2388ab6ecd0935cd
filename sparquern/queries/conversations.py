"""Conversation transforms: rendering, pairs, histories, templates, masks and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import query
from ..functions import conversations as C
from ..functions.text import token_count
from ..operators import segments
from ..session import table

#: Turns with the role names of the array form, numbered without the system turn.
TURNS_SQL = """
WITH t AS (
  SELECT conv_id, turn, CASE role WHEN 'user' THEN 'human' WHEN 'assistant' THEN 'gpt' WHEN 'system' THEN 'system' ELSE 'unknown' END AS sender, text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations),
s AS (SELECT *, max(CASE WHEN i = 0 AND sender = 'system' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS sys FROM t),
p AS (
  SELECT a.conv_id, ((a.i - a.sys) // 2)::INTEGER AS pair_idx, a.text AS human, b.text AS gpt, a.i AS hi, b.i AS gi
  FROM s a JOIN s b ON b.conv_id = a.conv_id AND b.i = a.i + 1 WHERE a.i >= a.sys AND (a.i - a.sys) % 2 = 0 AND a.sender = 'human' AND b.sender = 'gpt')
"""
STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations")


def _conv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.gathered(_turns(spark, sf_dir))


@query("SELECT role, count(*) AS n_turns, sum(len(regexp_extract_all(text, '\\S+')))::BIGINT AS n_tokens FROM conversations GROUP BY role")
def token_totals_by_role(spark, sf_dir):
    return _turns(spark, sf_dir).groupBy("role").agg(F.count(F.lit(1)).alias("n_turns"), F.sum(token_count("text")).alias("n_tokens"))


@query("SELECT conv_id, string_agg(text, '' ORDER BY turn) AS text FROM conversations GROUP BY conv_id")
def doc_recombine(spark, sf_dir):
    from ..operators import keys

    return keys.recombined(_turns(spark, sf_dir), "conv_id", "turn", "text").select("conv_id", F.array_join("sorted.text", "").alias("text"))


@query(TURNS_SQL + f"SELECT conv_id, {STRIP.format('''string_agg(chr(10) || upper(sender) || ':' || chr(10) || text, '' ORDER BY i)''')} AS text FROM s GROUP BY conv_id")
def conv_render_text(spark, sf_dir):
    return _conv(spark, sf_dir).select("conv_id", C.rendered_plain("conversations").alias("text"))


@query(TURNS_SQL + f"SELECT conv_id, md5(coalesce({STRIP.format('''string_agg(chr(10) || upper(sender) || ':' || chr(10) || text, '' ORDER BY i) FILTER (WHERE i > 0)''')}, '')) AS h FROM s GROUP BY conv_id")
def conv_hash_without_first(spark, sf_dir):
    return _conv(spark, sf_dir).select("conv_id", C.hash_without_first("conversations").alias("h"))


@query(TURNS_SQL + r"""SELECT conv_id, pair_idx, human, gpt, hi::INTEGER AS human_idx, gi::INTEGER AS gpt_idx, 'HUMAN:\n' || human || '\n\nGPT:\n' || gpt AS text FROM p""")
def conv_pairs(spark, sf_dir):
    rows = _conv(spark, sf_dir).select("conv_id", F.explode(C.pairs("conversations")).alias("p"))
    return rows.select("conv_id", "p.pair_idx", "p.human", "p.gpt", "p.human_idx", "p.gpt_idx", C.pair_text(F.col("p.human"), F.col("p.gpt")).alias("text"))


@query(TURNS_SQL + """SELECT p.conv_id, p.pair_idx, count(s.i) AS n_turns, md5(coalesce(string_agg(s.sender || '=' || s.text, '|' ORDER BY s.i), '')) AS h
FROM p LEFT JOIN s ON s.conv_id = p.conv_id AND s.i >= s.sys AND s.i < s.sys + 2 * p.pair_idx GROUP BY p.conv_id, p.pair_idx""")
def conv_history_slice(spark, sf_dir):
    rows = _conv(spark, sf_dir).select("conv_id", "conversations", F.explode(C.pairs("conversations")).alias("p"))
    h = C.history("conversations", F.col("p.pair_idx"))
    return rows.select("conv_id", "p.pair_idx", F.size(h).cast("long").alias("n_turns"), F.md5(F.array_join(F.transform(h, lambda m: F.concat(m["from"], F.lit("="), m["value"])), "|").cast("binary")).alias("h"))


@query(TURNS_SQL + f"""SELECT conv_id, CASE WHEN len(w) > 60 THEN '...truncated...' || array_to_string(w[len(w) - 59:], ' ') ELSE {STRIP.format('x')} END AS text FROM (
  SELECT conv_id, x, regexp_extract_all(x, '\\S+') AS w FROM (
    SELECT conv_id, string_agg(' ' || chr(10) || upper(sender) || ':' || chr(10) || text, '' ORDER BY i) AS x FROM s GROUP BY conv_id))""")
def conv_tail_truncate(spark, sf_dir):
    return _conv(spark, sf_dir).select("conv_id", C.history_text(F.col("conversations"), 60).alias("text"))


@query(TURNS_SQL + """, w AS (SELECT *, len(regexp_extract_all(text, '\\S+')) AS k FROM s),
r AS (SELECT *, sum(CASE WHEN i < sys THEN 0 ELSE k END) OVER (PARTITION BY conv_id ORDER BY i DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run,
  sum(CASE WHEN i < sys THEN k ELSE 0 END) OVER (PARTITION BY conv_id) AS own FROM w)
SELECT conv_id, count(*) AS n_turns, sum(k)::BIGINT AS n_tokens FROM r WHERE i < sys OR own + run <= 300 GROUP BY conv_id""")
def conv_suffix_budget(spark, sf_dir):
    """The oldest turns that do not fit 300 words are dropped; the system turn stays."""
    rows = _conv(spark, sf_dir).select("conv_id", F.explode(C.suffix_within("conversations", 300)).alias("m"))
    return rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"), F.sum(token_count("m.value")).alias("n_tokens"))


@query("SELECT conv_id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INTEGER AS i, CASE WHEN role IN ('user', 'assistant', 'system') THEN role ELSE 'unknown' END AS role, text AS content FROM conversations")
def sharegpt_to_openai(spark, sf_dir):
    rows = _conv(spark, sf_dir).select("conv_id", F.posexplode(C.to_openai("conversations")).alias("i", "m"))
    return rows.select("conv_id", "i", "m.role", "m.content")


@query(TURNS_SQL + f"""SELECT conv_id, {STRIP.format('''string_agg('<|im_start|>' || CASE sender WHEN 'system' THEN 'system' WHEN 'human' THEN 'user' ELSE 'assistant' END || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY i)''')} AS text FROM s GROUP BY conv_id""")
def render_chatml(spark, sf_dir):
    return _conv(spark, sf_dir).select("conv_id", C.rendered_preset("conversations", C.CHATML).alias("text"))


@query(TURNS_SQL + f"""SELECT conv_id, {STRIP.format('''string_agg(CASE sender WHEN 'system' THEN 'Instruction: ' WHEN 'human' THEN 'Human: ' ELSE 'AI: ' END || text || ' **Finished.**' || chr(10), '' ORDER BY i)''')} AS text FROM s GROUP BY conv_id""")
def render_labelled(spark, sf_dir):
    return _conv(spark, sf_dir).select("conv_id", C.rendered_preset("conversations", C.LABELLED).alias("text"))


@query(TURNS_SQL + """SELECT conv_id, max(CASE WHEN sys = 1 AND i = 0 THEN 'Answer well.' || chr(10) || text WHEN sys = 0 AND i = 0 THEN 'Answer well.' END) AS system, count(*) + 1 - max(sys) AS n_turns FROM s GROUP BY conv_id""")
def add_system_prompt(spark, sf_dir):
    rows = _conv(spark, sf_dir).select("conv_id", C.system_added("conversations", "Answer well.").alias("c"))
    return rows.select("conv_id", F.get("c", F.lit(0))["value"].alias("system"), F.size("c").cast("long").alias("n_turns"))


@query(TURNS_SQL + """SELECT conv_id, count(*) FILTER (WHERE NOT (i < sys AND ('0x' || substr(sha256(conv_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0::DOUBLE < 0.5)) AS n_turns FROM s GROUP BY conv_id""")
def drop_system_bernoulli(spark, sf_dir):
    return _conv(spark, sf_dir).select("conv_id", F.size(C.system_dropped("conversations", F.col("conv_id").cast("string"), 0.5)).cast("long").alias("n_turns"))


@query(TURNS_SQL + """SELECT conv_id, i::INTEGER AS i, (i = 0 AND sys = 1) OR i >= n - 2 AS label,
  '<|im_start|>' || CASE sender WHEN 'system' THEN 'system' WHEN 'human' THEN 'user' ELSE 'assistant' END || chr(10) || text || '<|im_end|>' || chr(10) AS text FROM s""")
def loss_mask_segments(spark, sf_dir):
    rows = _conv(spark, sf_dir).select("conv_id", F.posexplode(C.loss_segments("conversations")).alias("i", "m"))
    return rows.select("conv_id", "i", "m.label", "m.text")


@query(TURNS_SQL + """, picked AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY md5(conv_id::VARCHAR || '|' || pair_idx::VARCHAR), pair_idx) AS r FROM p) WHERE r <= 2),
last AS (SELECT conv_id, max(i) AS i FROM s WHERE sender = 'human' GROUP BY conv_id),
kept AS (
  SELECT conv_id, i, text, 1 AS part FROM s WHERE n <= 3
  UNION ALL SELECT conv_id, i, text, 0 FROM s WHERE n > 3 AND i < sys
  UNION ALL SELECT s.conv_id, s.i, s.text, 1 FROM s JOIN picked k ON k.conv_id = s.conv_id AND s.i IN (k.hi, k.gi) WHERE s.n > 3
  UNION ALL SELECT s.conv_id, s.i, s.text, 2 FROM s JOIN last l ON l.conv_id = s.conv_id AND l.i = s.i WHERE s.n > 3)
SELECT conv_id, count(*) AS n_turns, md5(string_agg(text, '|' ORDER BY part, i)) AS h FROM kept GROUP BY conv_id""")
def fewshot_subsample(spark, sf_dir):
    rows = _conv(spark, sf_dir).select("conv_id", C.fewshot("conversations", F.col("conv_id").cast("string"), 2).alias("c"))
    return rows.select("conv_id", F.size("c").cast("long").alias("n_turns"), F.md5(F.array_join("c.value", "|").cast("binary")).alias("h"))


@query(TURNS_SQL + """, g AS (SELECT conv_id, i, text, row_number() OVER (PARTITION BY conv_id ORDER BY i) - 1 AS k, count(*) OVER (PARTITION BY conv_id) AS m FROM s WHERE sender = 'gpt')
SELECT conv_id, i::INTEGER AS turn, text AS answer FROM g
WHERE k = CASE WHEN ('0x' || substr(sha256(conv_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0::DOUBLE < 0.5 THEN 0 ELSE ('0x' || substr(sha256(conv_id::VARCHAR), 9, 8))::BIGINT % m END""")
def grpo_truncate(spark, sf_dir):
    rows = _conv(spark, sf_dir).withColumn("turn", C.truncation_turn("conversations", F.col("conv_id").cast("string"), 0.5)).filter("turn is not null")
    return rows.select("conv_id", "turn", F.get("conversations", F.col("turn"))["value"].alias("answer"))


@query(TURNS_SQL + """, q AS (SELECT conv_id, pair_idx, human, gpt, (row_number() OVER (ORDER BY conv_id, pair_idx) - 1) // 3 AS g FROM p),
z AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY conv_id, pair_idx) - 1 AS k FROM q)
SELECT a.g::BIGINT AS group_id, a.k::INTEGER AS focus, 2 * count(*) AS n_segments, md5(string_agg((a.k = b.k)::VARCHAR || b.human || b.gpt, '' ORDER BY b.k)) AS h FROM z a JOIN z b ON a.g = b.g GROUP BY a.g, a.k""")
def rag_group_segments(spark, sf_dir):
    from ..operators import chunking

    rows = _conv(spark, sf_dir).select("conv_id", F.explode(C.pairs("conversations")).alias("p")).select("conv_id", "p.pair_idx", "p.human", "p.gpt")
    grouped = chunking.fixed_groups(rows, 3, "conv_id", "pair_idx").withColumn("at", F.struct("conv_id", "pair_idx"))
    plain = {"user": ("", ""), "assistant": ("", "")}
    out = segments.group_segments(grouped, "group_id", "at", "human", "gpt", plain)
    shown = F.transform("segments", lambda s, i: F.when(i % 2 == 0, F.concat(s["label"].cast("string"), s["text"])).otherwise(s["text"]))
    return out.select("group_id", "focus", F.size("segments").cast("long").alias("n_segments"), F.md5(F.array_join(shown, "").cast("binary")).alias("h"))


@query(TURNS_SQL + """SELECT conv_id, md5(coalesce(max(CASE WHEN sys = 1 AND i = 0 THEN 'system=' || text || '|' END), '') || coalesce((SELECT string_agg('human=' || human || '|gpt=' || gpt, '|' ORDER BY pair_idx) FROM p WHERE p.conv_id = s.conv_id), '')) AS h
FROM s WHERE conv_id IN (SELECT conv_id FROM p) GROUP BY conv_id""")
def pairs_reassembled(spark, sf_dir):
    """Pairs back to conversations, the system turn first where there is one."""
    rows = _conv(spark, sf_dir).select("conv_id", C.pairs("conversations").alias("ps")).filter(F.size("ps") > 0)
    conv = C.reassembled(F.get("ps", F.lit(0))["system"], F.col("ps"))
    return rows.select("conv_id", F.md5(F.array_join(F.transform(conv, lambda m: F.concat(m["from"], F.lit("="), m["value"])), "|").cast("binary")).alias("h"))


@query(TURNS_SQL + """SELECT conv_id, i::INTEGER AS call, CASE WHEN i % 2 = 0 THEN 2 ELSE 0 END AS n_segments, CASE WHEN i % 2 = 1 THEN 2 ELSE 0 END AS n_messages FROM s""")
def meta_dataset(spark, sf_dir):
    """Each turn stands for a call: even ones in completion mode, odd ones in chat mode."""
    calls = _turns(spark, sf_dir).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("t"))
    detail = F.transform("t", lambda t, i: F.struct(t["text"].alias("input_text"), F.array(F.struct(F.lit("user").alias("role"), t["text"].alias("content"))).alias("input_messages"), t["text"].alias("response"), (i % 2 == 0).alias("completion_mode")))
    out = segments.meta_rows(calls.select("conv_id", detail.alias("details")), "conv_id")
    n = lambda c: F.coalesce(F.when(F.col(c).isNotNull(), F.size(c)), F.lit(0))
    return out.select("conv_id", "call", n("segments").alias("n_segments"), n("messages").alias("n_messages"))


@query("""SELECT conv_id, turn, text FROM conversations WHERE regexp_matches(regexp_replace(text, '\\s+$', ''), '[.!?]["'')\\]]*$')""")
def sentence_final_filter(spark, sf_dir):
    from ..functions.text import ends_sentence

    return _turns(spark, sf_dir).filter(ends_sentence("text")).select("conv_id", "turn", "text")
