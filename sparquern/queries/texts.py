"""Scalar text functions and reply parsers; replies are put together from the tables, the same in the oracles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import query
from ..functions import text as T
from ..operators import retrieval, segments
from ..session import table

def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars", "text")


def _one(df: DataFrame, value: Column, name: str = "value") -> DataFrame:
    return df.select("doc_id", value.alias(name))


@query("SELECT doc_id, replace(lower(text), ' ', '_') AS value FROM documents")
def case_snake(spark, sf_dir):
    return _one(_docs(spark, sf_dir), T.snake_case("text"))


@query("SELECT doc_id, replace(lower(text), ' ', '-') AS value FROM documents")
def case_kebab(spark, sf_dir):
    return _one(_docs(spark, sf_dir), T.kebab_case("text"))


#: The engine's capital of ß is SS, which DuckDB's upper() leaves.
UPPER = "upper(replace({0}, 'ß', 'SS'))"
WORDS = r"list_filter(string_split_regex(text, '\s+'), lambda w: w <> '')"
CAP = "upper(replace({0}[1], 'ß', 'SS')) || lower({0}[2:])"
CHARS = "regexp_extract_all(text, '(?s).')"


@query(f"""SELECT doc_id, array_to_string(list_transform(w, lambda x, i: CASE WHEN i = 1 THEN lower(x) ELSE {CAP.format('x')} END), '') AS value
FROM (SELECT doc_id, {WORDS} AS w FROM documents) WHERE len(w) > 0""")
def case_camel(spark, sf_dir):
    return _one(_docs(spark, sf_dir), T.camel_case("text")).filter("value is not null")


@query(f"SELECT doc_id, array_to_string(list_transform({WORDS}, lambda x: {CAP.format('x')}), '') AS value FROM documents")
def case_pascal(spark, sf_dir):
    return _one(_docs(spark, sf_dir), T.pascal_case("text"))


@query(f"SELECT doc_id, array_to_string(list_transform({CHARS}, lambda c, i: CASE WHEN i % 2 = 1 THEN lower(c) ELSE {UPPER.format('c')} END), '') AS value FROM documents")
def case_alternating(spark, sf_dir):
    return _one(_docs(spark, sf_dir), T.alternating_case("text"))


@query(f"SELECT doc_id, array_to_string(list_transform(string_split(text, '. '), lambda s: {CAP.format('s')}), '. ') AS value FROM documents")
def case_sentence(spark, sf_dir):
    return _one(_docs(spark, sf_dir), T.sentence_case("text"))


@query(f"SELECT doc_id, array_to_string(list_transform({CHARS}, lambda c: CASE WHEN c = {UPPER.format('c')} THEN lower(c) ELSE {UPPER.format('c')} END), '') AS value FROM documents")
def case_invert(spark, sf_dir):
    return _one(_docs(spark, sf_dir), T.inverted_case("text"))


@query(rf"SELECT doc_id, array_to_string(list_transform(regexp_extract_all(text, '(\p{{L}}+|\P{{L}}+)'), lambda x: {CAP.format('x')}), '') AS value FROM documents")
def case_title(spark, sf_dir):
    return _one(_docs(spark, sf_dir), T.title_case("text"))


@query(f"""SELECT doc_id, v.name AS variation, CASE v.name WHEN 'allcaps' THEN {UPPER.format('text')} WHEN 'lowercase' THEN lower(text) ELSE replace(lower(text), ' ', '_') END AS text
FROM documents, (SELECT unnest(['allcaps', 'lowercase', 'snake']) AS name) v""")
def case_variation_rows(spark, sf_dir):
    rows = _docs(spark, sf_dir).select("doc_id", F.explode(T.case_variations("text", ["allcaps", "lowercase", "no such case", "snake"])).alias("v"))
    return rows.select("doc_id", "v.variation", "v.text")


@query()
def case_noisy(spark, sf_dir):
    """The variations that draw: random case and typing noise, from the document's number."""
    rows = _docs(spark, sf_dir).select("doc_id", F.explode(T.case_variations("text", ["random", "keyboard"])).alias("v"))
    return rows.select("doc_id", "v.variation", "v.text")


@query("SELECT doc_id, CASE WHEN length(text) <= 100 THEN text ELSE left(text, 20) || right(text, 60) END AS value FROM documents")
def head_tail(spark, sf_dir):
    return _one(_docs(spark, sf_dir), T.head_tail("text", 100))


STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
THINK = "regexp_replace({}, '(?s)<think>.*?</think>', '', 'g')"


@query(f"""SELECT doc_id, {THINK.format("'a <think>x' || chr(10) || 'y</think>' || text || '<think>' || text || '</think> z'")} AS value FROM documents""")
def strip_think(spark, sf_dir):
    reply = F.concat(F.lit("a <think>x\ny</think>"), F.col("text"), F.lit("<think>"), F.col("text"), F.lit("</think> z"))
    return _one(_docs(spark, sf_dir), T.strip_think(reply))


@query(f"""SELECT doc_id, {STRIP.format("split_part(split_part(r, '<answer>', -1), '</answer>', 1)")} AS value FROM (
  SELECT doc_id, {THINK.format("'<answer>first</answer> then <think>no <answer>z</answer></think><answer> ' || text || '</answer> end'")} AS r FROM documents)""")
def extract_tag_last(spark, sf_dir):
    reply = F.concat(F.lit("<answer>first</answer> then <think>no <answer>z</answer></think><answer> "), F.col("text"), F.lit("</answer> end"))
    return _one(_docs(spark, sf_dir), T.tag_last(reply, "answer"))


@query(f"""SELECT doc_id, CASE WHEN doc_id % 3 > 0 THEN {STRIP.format("regexp_extract('x <rewrite>' || text || '</rewrite><rewrite>no</rewrite>', '(?s)<rewrite>(.*?)</rewrite>', 1)")} END AS value FROM documents""")
def extract_tag_first(spark, sf_dir):
    reply = F.when(F.col("doc_id") % 3 == 0, F.lit("no tag")).otherwise(F.concat(F.lit("x <rewrite>"), F.col("text"), F.lit("</rewrite><rewrite>no</rewrite>")))
    return _one(_docs(spark, sf_dir), T.tag_first(reply, "rewrite"))


@query(f"""WITH replies AS (
  SELECT doc_id, 'Sure.' || chr(10) || '**QUESTION 1:**' || chr(10) || split_part(text, chr(10), 1) || chr(10) || '**ANSWER:** ' || text || chr(10) || chr(10) || '**QUESTION:** ' || text
    || chr(10) || '**ANSWER:**' || chr(10) || 'last' || chr(10) || chr(10) || '**QUESTION:** without answer' AS r FROM documents),
blocks AS (
  SELECT doc_id, list_filter(string_split(regexp_replace(r, '\\*\\*QUESTION \\d:\\*\\*', '**QUESTION:**', 'g'), '**QUESTION:**')[2:], lambda b: contains(b, '**ANSWER:**')) AS b FROM replies),
rows AS (SELECT doc_id, unnest(range(len(b))) AS k, unnest(b) AS x FROM blocks)
SELECT doc_id, k::INTEGER AS k, {STRIP.format("left(x, strpos(x, '**ANSWER:**') - 1)")} AS question, {STRIP.format("substr(x, strpos(x, '**ANSWER:**') + 11)")} AS answer FROM rows""")
def extract_qa(spark, sf_dir):
    reply = F.concat(F.lit("Sure.\n**QUESTION 1:**\n"), F.substring_index("text", "\n", 1), F.lit("\n**ANSWER:** "), F.col("text"), F.lit("\n\n**QUESTION:** "), F.col("text"), F.lit("\n**ANSWER:**\nlast\n\n**QUESTION:** without answer"))
    rows = _docs(spark, sf_dir).select("doc_id", F.posexplode(T.qa_pairs(reply)).alias("k", "p"))
    return rows.select("doc_id", "k", "p.question", "p.answer")


@query("SELECT doc_id, lang AS value FROM documents")
def last_label(spark, sf_dir):
    reply = F.concat(F.lit("Final label: none\nthoughts\nFinal label: "), F.col("lang"))
    return _one(_docs(spark, sf_dir), T.last_label(reply))


@query("SELECT doc_id, CASE WHEN doc_id % 5 = 4 THEN NULL ELSE (doc_id % 5 % 3)::INTEGER END AS value FROM documents")
def label_index(spark, sf_dir):
    i = F.col("doc_id") % 5
    reply = F.when(i == 0, F.lit(" good ")).when(i == 1, F.lit("1")).when(i == 2, F.lit("2 perhaps")).when(i == 3, F.lit("0. good.")).otherwise(F.lit("unclear"))
    return _one(_docs(spark, sf_dir), T.label_index(reply, ["good", "bad", "mixed"]))


@query(f"""SELECT doc_id, {STRIP.format("string_split(text || chr(10) || '#### ' || source || ' ', '####')[2]")} AS value FROM documents""")
def hash_answer(spark, sf_dir):
    return _one(_docs(spark, sf_dir), T.hash_answer(F.concat(F.col("text"), F.lit("\n#### "), F.col("source"), F.lit(" "))))


@query("SELECT doc_id, CASE WHEN doc_id % 7 <= 4 THEN (doc_id % 7)::DOUBLE END AS rating, CASE WHEN doc_id % 7 = 6 THEN NULL ELSE doc_id % 7 <= 4 END AS ok FROM documents")
def numeric_rating(spark, sf_dir):
    n = F.col("doc_id") % 7
    reply = F.when(n == 6, F.lit("none")).otherwise(F.concat(F.lit("<rating>bad</rating> <rating> "), n.cast("string"), F.lit("</rating>")))
    return _docs(spark, sf_dir).select("doc_id", T.numeric_rating(reply).alias("r")).select("doc_id", "r.rating", "r.ok")


@query("SELECT doc_id, source AS thought, lang AS answer FROM documents")
def thought_split(spark, sf_dir):
    reply = F.concat(F.col("source"), F.lit(" Answer: "), F.col("lang"))
    return _docs(spark, sf_dir).select("doc_id", T.thought_and_answer(reply, "Answer:").alias("x")).select("doc_id", "x.thought", "x.answer")


@query("SELECT doc_id, doc_id % 3 = 1 AS value FROM documents")
def one_marker_only(spark, sf_dir):
    n = F.col("doc_id") % 3
    reply = F.when(n == 0, F.lit("no marker")).when(n == 1, F.lit("so Answer: yes")).otherwise(F.lit("Answer: a Answer: b"))
    return _one(_docs(spark, sf_dir), T.one_marker_only(reply, "Answer:", "Thought Process:"))


@query("SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 0.0::DOUBLE ELSE (doc_id % 4 + 2)::DOUBLE END AS value FROM documents")
def xml_score_sum(spark, sf_dir):
    n = (F.col("doc_id") % 4).cast("string")
    reply = F.concat(F.lit("<style>2</style><truth>"), n, F.lit("</truth><wild>99</wild>"))
    return _one(_docs(spark, sf_dir), T.xml_score_sum(reply, ["style", "truth", "wild"], autofail=["truth"], least=0, most=10))


@query(r"""SELECT doc_id, '**Name**' || chr(10) || source || chr(10) || chr(10) || '**Words**' || chr(10) || lang AS value FROM documents""")
def section_format(spark, sf_dir):
    return _one(_docs(spark, sf_dir), segments.formatted([("Name", F.col("source")), ("Words", F.col("lang"))], heading="bold_heading"))


@query(r"""SELECT doc_id, '# Items' || chr(10) || '1. ' || source || chr(10) || '2. ' || lang AS value FROM documents""")
def section_format_list(spark, sf_dir):
    return _one(_docs(spark, sf_dir), segments.formatted([("Items", F.array("source", "lang"))], heading="hash_heading", content="numbered_list"))


@query("""SELECT doc_id, '1. ' || source || chr(10) || '2. ' || lang AS value FROM documents""")
def atomic_facts(spark, sf_dir):
    reply = F.concat(F.lit("<think>1. no</think>Facts:\n1. old\n\nThen\n1. "), F.col("source"), F.lit("\n2. "), F.col("lang"), F.lit("\nDone."))
    return _one(_docs(spark, sf_dir), T.atomic_facts(reply))


@query("SELECT doc_id, 'Read ' || source || ' in ' || lang || ': {unknown} }' AS value FROM documents")
def template_render(spark, sf_dir):
    return _one(_docs(spark, sf_dir), T.rendered("Read {source} in {lang}: {unknown} }", source=F.col("source"), lang=F.col("lang")))


@query("SELECT doc_id, lang || '/' || upper(lang) || '/' || lower(lang) AS value FROM documents")
def context_fill(spark, sf_dir):
    return _one(_docs(spark, sf_dir), T.context_filled(F.lit("{context}/{context_uppercase}/{context_lowercase}"), "lang"))


@query("""SELECT doc_id, CASE WHEN n < 1024 THEN format('{:.2f} B', n) WHEN n < 1048576 THEN format('{:.2f} KB', n / 1024) WHEN n < 1073741824 THEN format('{:.2f} MB', n / 1048576)
  WHEN n < 1099511627776 THEN format('{:.2f} GB', n / 1073741824) ELSE format('{:.2f} TB', n / 1099511627776) END AS value FROM (SELECT doc_id, n_chars::DOUBLE AS n FROM documents)""")
def readable_size(spark, sf_dir):
    return _one(_docs(spark, sf_dir), T.readable_size("n_chars"))


@query("""SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'Odrun' WHEN 1 THEN 'Tavish' WHEN 2 THEN 'Belka' WHEN 3 THEN 'Mirela' ELSE source END AS value FROM documents""")
def base_name(spark, sf_dir):
    n = F.col("doc_id") % 5
    name = F.when(n == 0, F.lit("Queen Odrun III")).when(n == 1, F.lit("Tavish the Tall")).when(n == 2, F.lit("Belka, the Silver Wind")).when(n == 3, F.lit("general Mirela (retired)")).otherwise(F.concat(F.lit("Captain "), F.col("source"), F.lit(" IV")))
    return _one(_docs(spark, sf_dir), T.base_name(name))


@query("""WITH grams AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, length(text) - 13), lambda i: substr(text, i, 15))) AS g FROM benchmark WHERE length(text) >= 15),
own AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, length(text) - 13), lambda i: substr(text, i, 15))) AS g FROM documents WHERE length(text) >= 15)
SELECT DISTINCT item_id, doc_id FROM grams JOIN own USING (g)""")
def ngram_overlap(spark, sf_dir):
    """All pairs of a benchmark item and a document that share 15 characters."""
    return retrieval.sharing_characters(_docs(spark, sf_dir), table(spark, sf_dir, "benchmark"), 15)


@query()
def repetition_flag(spark, sf_dir):
    return _one(_docs(spark, sf_dir), T.repeats("text", 8))
