"""Story helpers, openings, steps and regrouping over documents and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import query
from ..functions import stories as S
from ..functions.text import token_count
from ..operators import keys, sampling
from ..session import table
from ..sources import readers
from .texts import STRIP, UPPER


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")


def _one(df: DataFrame, value, name: str = "value") -> DataFrame:
    return df.select("doc_id", value.alias(name))


@query(f"""SELECT doc_id, CASE WHEN strpos(x, ':') > 0 THEN {UPPER.format("left(x, strpos(x, ':') - 1)")} || substr(x, strpos(x, ':')) ELSE x END AS value
FROM (SELECT doc_id, {STRIP.format("split_part(CASE WHEN doc_id % 2 = 0 THEN lang || ': ' ELSE '' END || text, chr(10), 1)")} AS x FROM documents)""")
def emotion_line(spark, sf_dir):
    return _one(_docs(spark, sf_dir), S.emotion_line(F.concat(F.when(F.col("doc_id") % 2 == 0, F.concat("lang", F.lit(": "))).otherwise(""), "text")))


@query(f"""SELECT doc_id, {STRIP.format("split_part(upper(lang) || ' MOOD: ' || text || chr(10) || chr(10) || 'rest', chr(10) || chr(10), 1)")} AS value FROM documents""")
def emotion_block(spark, sf_dir):
    return _one(_docs(spark, sf_dir), S.capitals_block(F.concat(F.lit("intro\n"), F.upper("lang"), F.lit(" MOOD: "), F.col("text"), F.lit("\n\nrest"))))


@query("SELECT doc_id, lower(left(x, strpos(x, ':') - 1)) <> left(x, strpos(x, ':') - 1) AS value FROM (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'FEAR' ELSE 'fear' END || ': ' || text AS x FROM documents)")
def emotion_capitals(spark, sf_dir):
    return _one(_docs(spark, sf_dir), S.capitals_before_colon(F.concat(F.when(F.col("doc_id") % 2 == 0, "FEAR").otherwise("fear"), F.lit(": "), "text")))


@query("SELECT doc_id, '[' || lang || ', ' || source || ']' AS value, contains(text, lang || ' ') OR contains(text, 'tion') AS found FROM documents WHERE lang = 'en' UNION ALL SELECT doc_id, '[' || lang || ', ' || source || ']', contains(text, 'tion') OR contains(text, 'en ') FROM documents WHERE lang <> 'en'")
def emotion_list(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", S.listed(F.array("lang", "source")).alias("value"), S.contains_any("text", ["en ", "tion"]).alias("found"))


@query()
def emotion_valid(spark, sf_dir):
    return _one(_docs(spark, sf_dir), S.emotion_ok("text"))


@query("SELECT doc_id, doc_id % 3 = 0 AS value FROM documents")
def rating_keys(spark, sf_dir):
    n = F.col("doc_id") % 3
    ratings = F.when(n == 0, F.create_map(F.lit("style"), F.lit("good"), F.lit("plot"), F.lit("poor"))).when(n == 1, F.create_map(F.lit("style"), F.lit("good")))
    return _one(_docs(spark, sf_dir), S.has_keys(ratings, ["style", "plot"]))


@query(r"SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN regexp_extract(source, '^\S*') WHEN 1 THEN source || chr(10) || 'end' END AS value FROM documents")
def card_name(spark, sf_dir):
    n = F.col("doc_id") % 3
    card = F.when(n == 0, F.concat(F.lit("A card\nName: "), "source", F.lit(" the Second\nName: no"))).when(n == 1, F.concat(F.lit("The Name:  "), "source", F.lit("\nend\\ more"))).otherwise("no such line")
    return _one(_docs(spark, sf_dir), S.card_name(card))


#: A card whose character begins what it says with the text's first words, and with Hello.
CARD_SQL = "'Name: ' || source || chr(10) || source || ': \"' || regexp_extract(text, '[\\p{L}\\p{N}_]+') || ' there\"' || chr(10) || 'other: \"Ah\"' || chr(10) || source || ': \"Hello\"'"


def _card():
    return F.concat(F.lit("Name: "), "source", F.lit("\n"), "source", F.lit(': "'), F.regexp_extract("text", r"[\p{L}\p{N}_]+", 0), F.lit(' there"\nother: "Ah"\n'), "source", F.lit(': "Hello"'))


@query(f"SELECT doc_id, array_to_string(regexp_extract_all({CARD_SQL}, source || ': \"([\\p{{L}}\\p{{N}}_]+)', 1), ',') AS value FROM documents")
def card_first_words(spark, sf_dir):
    return _one(_docs(spark, sf_dir), F.array_join(S.first_words("source", _card()), ","))


@query(f"""SELECT doc_id, free[('0x' || substr(sha256(doc_id::VARCHAR), 1, 8))::BIGINT % len(free) + 1] AS value FROM (
  SELECT doc_id, list_filter(['Ah', 'Oh', 'I', 'Welcome', 'Hey', 'It''s', 'Hello'], lambda w: NOT list_contains(regexp_extract_all({CARD_SQL}, source || ': "([\\p{{L}}\\p{{N}}_]+)', 1), w)) AS free FROM documents)""")
def conversation_starter(spark, sf_dir):
    return _one(_docs(spark, sf_dir), S.conversation_starter(_card(), "doc_id"))


@query(f"SELECT doc_id, lang || chr(10) || source || chr(10) || {STRIP.format('text')} AS value FROM documents")
def steps_extracted(spark, sf_dir):
    reply = F.concat(F.lit("Plan. Step 1. think\nStep 2. "), "lang", F.lit("\n\nStep 3. no\nStep 4."), "source", F.lit(" Step 5.  "), "text")
    return _one(_docs(spark, sf_dir), S.steps_extracted(reply))


@query(r"""SELECT doc_id, array_to_string(list_transform(string_split('Step 1. ' || lang || chr(10) || '  Step2.' || source || chr(10) || text, chr(10)),
  lambda x: CASE WHEN starts_with(regexp_replace(x, '^\s+', ''), 'Step') AND contains(x, '.') THEN regexp_replace(substr(x, strpos(x, '.') + 1), '^\s+', '') ELSE x END), chr(10)) AS value FROM documents""")
def steps_stripped(spark, sf_dir):
    return _one(_docs(spark, sf_dir), S.steps_stripped(F.concat(F.lit("Step 1. "), "lang", F.lit("\n  Step2."), "source", F.lit("\n"), "text")))


YES_SQL = ", ".join("'" + w.replace("'", "''") + "'" for w in S.YES_PLEASE)


@query(f"SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN [{YES_SQL}][('0x' || substr(sha256(doc_id::VARCHAR), 1, 8))::BIGINT % 16 + 1] ELSE text END AS value FROM documents")
def agreeing_replies(spark, sf_dir):
    return _one(_docs(spark, sf_dir), S.agreed(F.when(F.col("doc_id") % 2 == 0, "Yes, please.").otherwise(F.col("text")), "doc_id"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN lang || '|a''b|' || source END AS value FROM documents")
def literal_lists(spark, sf_dir):
    n = F.col("doc_id") % 3
    reply = F.when(n == 0, F.concat(F.lit("['"), "lang", F.lit("', \"a'b\", '"), "source", F.lit("']"))).when(n == 1, F.lit("['a', 2]")).otherwise(F.col("text"))
    return _one(_docs(spark, sf_dir), F.array_join(S.string_list(reply), "|"))


@query("SELECT doc_id, lang AS tag_lang, source AS tag_source, text FROM documents")
def flattened_struct(spark, sf_dir):
    return S.flattened(_docs(spark, sf_dir).select("doc_id", F.struct("lang", "source").alias("tag"), "text"), "tag")


@query("""SELECT doc_id, CASE WHEN ('0x' || substr(sha256(doc_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0 < 0.5 AND lang IN ('en', 'fr') THEN CASE lang WHEN 'en' THEN 'Reply.' ELSE 'Réponds.' END ELSE 'Write ' || lang END AS prompt FROM documents""")
def prompts_replaced(spark, sf_dir):
    rows = _docs(spark, sf_dir).select("doc_id", F.concat(F.lit("Write "), "lang").alias("prompt"))
    return S.prompts_replaced(rows, "prompt", {"Write en": "Reply.", "Write fr": "Réponds."}, "doc_id")


@query(f"""WITH t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM conversations WHERE role <> 'system')
SELECT conv_id, i::INTEGER AS i, CASE role WHEN 'user' THEN 'human' ELSE 'gpt' END AS sender, {STRIP.format('text')} AS value FROM t
UNION ALL SELECT DISTINCT conv_id, 0, 'system', 'card of Mirela' FROM t""")
def story_conversation(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").filter("role <> 'system'").withColumn("line", F.concat(F.when(F.col("role") == "user", "{user}: ").otherwise("Mirela: "), "text"))
    told = keys.recombined(turns, "conv_id", "turn", "line").select("conv_id", F.array_join("sorted.line", "\n").alias("story"))
    rows = told.select("conv_id", F.posexplode(S.story_conversation(F.lit("card of Mirela"), F.col("story"), F.lit("Mirela"))).alias("i", "m"))
    return rows.select("conv_id", "i", F.col("m.from").alias("sender"), "m.value")


@query("""SELECT text, min((doc_id // 2)) FILTER (WHERE doc_id % 2 = f) AS ordinal, f AS half FROM (
  SELECT *, min(doc_id % 2) OVER (PARTITION BY text) AS f FROM documents) GROUP BY text, f""")
def keyed_union(spark, sf_dir):
    """Two halves of the documents, numbered alike, by their texts."""
    halves = [_docs(spark, sf_dir).filter(F.col("doc_id") % 2 == i).select("text", F.floor(F.col("doc_id") / 2).alias("ordinal"), (F.col("doc_id") % 2).alias("half")) for i in (0, 1)]
    return keys.united(halves, "text")


@query("""SELECT doc_id % 50 AS idx, string_agg(source || ':' || doc_id, ',' ORDER BY doc_id) AS outputs FROM documents GROUP BY doc_id % 50""")
def outputs_by_index(spark, sf_dir):
    rows = _docs(spark, sf_dir).select((F.col("doc_id") % 50).alias("idx"), "doc_id", F.concat("source", F.lit(":"), F.col("doc_id").cast("string")).alias("out"))
    return keys.collected_by(rows, "idx", "doc_id", "out").select("idx", F.array_join("outputs.out", ",").alias("outputs"))


@query("""SELECT lang AS paragraph, string_agg('**QUESTION:**' || chr(10) || source || '?' || chr(10) || chr(10) || '**ANSWER:**' || chr(10) || text || chr(10), chr(10) || chr(10) ORDER BY doc_id) AS question_answer_pairs
FROM documents GROUP BY lang""")
def questions_by_text(spark, sf_dir):
    rows = _docs(spark, sf_dir).select("doc_id", F.col("lang").alias("paragraph"), F.concat("source", F.lit("?")).alias("question"), F.col("text").alias("answer"))
    return keys.questions_by_text(rows, "paragraph", "question", "answer", "doc_id")


@query("""SELECT place, doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (ORDER BY sha256('{"lang":"' || lang || '","source":"' || source || '"}'), doc_id) - 1 AS place FROM documents) WHERE place < 100""")
def json_hash_sample(spark, sf_dir):
    rows = _docs(spark, sf_dir).withColumn("prompt", F.struct("lang", "source"))
    return sampling.json_order(rows, "prompt", "doc_id", 100).select("place", "doc_id", "lang")


@query("""WITH g AS (SELECT source, min_by(text, doc_id) AS t, row_number() OVER (ORDER BY md5('1048596' || source)) AS i, count(*) OVER () AS n FROM documents GROUP BY source)
SELECT a.source, b.source AS other, b.t AS other_text FROM g a JOIN g b ON b.i = a.i % a.n + 1 WHERE a.source <> b.source""")
def other_group_context(spark, sf_dir):
    return sampling.other_group(_docs(spark, sf_dir), "source", "doc_id", "text")


@query(r"""WITH a AS (SELECT unnest(['is calm', '', 'is loud']) AS x, generate_subscripts(['is calm', '', 'is loud'], 1) AS i),
b AS (SELECT unnest(['is kind', 'is cold']) AS x, generate_subscripts(['is kind', 'is cold'], 1) AS i), c AS (SELECT unnest(['', 'has a secret']) AS x, generate_subscripts(['', 'has a secret'], 1) AS i)
SELECT ((a.i - 1) * 4 + (b.i - 1) * 2 + c.i - 1)::BIGINT AS combination, replace(regexp_replace(a.x || chr(10) || b.x || chr(10) || c.x, '^\s+|\s+$', '', 'g'), chr(10) || chr(10), chr(10)) AS traits FROM a, b, c""")
def trait_combinations(spark, sf_dir):
    return sampling.trait_sets(spark, [["is calm", "", "is loud"], ["is kind", "is cold"], ["", "has a secret"]])


@query(r"SELECT 'documents.parquet' AS file, count(*) AS n_rows, sum(coalesce(len(regexp_extract_all(text, '\S+')), 0))::BIGINT AS n_tokens FROM documents")
def tokens_over_files(spark, sf_dir):
    """A glob and a path that name the same file."""
    return readers.tokens_over(spark, [f"{sf_dir}/documents.parquet", f"{sf_dir}/doc*.parquet"])
