"""Readers of text, JSON, JSONL and Parquet corpora, all as lazy scans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TEXT_EXTENSIONS = (".txt", ".md", ".html", ".epub")
CONVERSATION = "conversations array<struct<`from`:string,value:string>>"

#: Extractors of binary formats by extension: bytes to text. Libraries for them are not part of this repository.
EXTRACTORS: dict[str, Callable[[bytes], str]] = {}


def extractor(extension: str):
    def register(f):
        EXTRACTORS[extension] = f
        return f

    return register


def read_text(spark: SparkSession, folder: str, extensions: tuple[str, ...] = TEXT_EXTENSIONS) -> DataFrame:
    """(text, metadata): whole files below the folder with these extensions, metadata their path. Undecodable bytes are
    replaced; .html and .epub are read as they are."""
    glob = "*{" + ",".join(extensions) + "}"
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder)
    return _decoded(rows)


def _decoded(rows: DataFrame) -> DataFrame:
    def run(frames):
        for pdf in frames:
            pdf["text"] = [bytes(b).decode("utf-8", "replace") for b in pdf["content"]]
            yield pdf[["text", "path"]].rename(columns={"path": "metadata"})

    return rows.select("content", "path").mapInPandas(run, "text string, metadata string")


def read_documents(spark: SparkSession, folder: str, extension: str) -> DataFrame:
    """(text, metadata) of a binary format by its registered extractor; a broken file gives an empty text."""
    if extension not in EXTRACTORS:
        raise NotImplementedError(f"no extractor for {extension}; register one with @extractor")
    extract = EXTRACTORS[extension]
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{extension}").load(folder)

    def run(frames):
        for pdf in frames:
            texts = []
            for b in pdf["content"]:
                try:
                    texts.append(extract(bytes(b)))
                except Exception:  # any fault of a file is that file's alone
                    texts.append("")
            pdf["text"] = texts
            yield pdf[["text", "path"]].rename(columns={"path": "metadata"})

    return rows.select("content", "path").mapInPandas(run, "text string, metadata string")


def _json(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Objects of .json arrays and .jsonl lines below the folder, with their file in ``metadata``; broken lines are left out."""
    read = lambda glob, lines: spark.read.schema(f"{schema}, _corrupt_record string").option("multiLine", not lines).option("mode", "PERMISSIVE").option("recursiveFileLookup", True).option("pathGlobFilter", glob).json(folder)
    parts = [read("*.json", False), read("*.jsonl", True)]
    named = [p.withColumn("metadata", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)) for p in parts]
    return named[0].unionByName(named[1]).filter("_corrupt_record is null").drop("_corrupt_record")


def read_completions(spark: SparkSession, folder: str) -> DataFrame:
    """(text, metadata) of each object that has a text."""
    return _json(spark, folder, "text string").filter("text is not null")


def read_jsonl_file(spark: SparkSession, path: str, schema: str = "text string") -> DataFrame:
    """The lines of one file that parse."""
    return spark.read.schema(f"{schema}, _corrupt_record string").option("mode", "PERMISSIVE").json(path).filter("_corrupt_record is null").drop("_corrupt_record")


def read_all_text(spark: SparkSession, folder: str, extensions: tuple[str, ...] = TEXT_EXTENSIONS, jsonl_as_text: bool = False) -> DataFrame:
    """Completions and text files together; .jsonl files a second time as plain text only if asked for."""
    return read_completions(spark, folder).unionByName(read_text(spark, folder, (*extensions, ".jsonl") if jsonl_as_text else extensions))


def read_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations with their rendered text and the hash of all but the first turn."""
    from ..functions import conversations as C

    rows = _json(spark, folder, CONVERSATION).filter("conversations is not null")
    return rows.select("conversations", C.rendered_plain("conversations").alias("text"), C.hash_without_first("conversations").alias("hash_without_first"), F.col("metadata").alias("source_file"))


def read_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Human and gpt pairs of all conversations, with the file they are from."""
    from ..functions import conversations as C

    rows = read_conversations(spark, folder).select("source_file", "hash_without_first", F.explode(C.pairs("conversations")).alias("p"))
    return rows.select("source_file", "hash_without_first", "p.*", C.pair_text(F.col("p.human"), F.col("p.gpt")).alias("text"))


def load_dataset(spark: SparkSession, path: str) -> DataFrame:
    """By extension: .json, .jsonl, .parquet and .pq; others raise."""
    if path.endswith((".parquet", ".pq")):
        return spark.read.parquet(path)
    if path.endswith(".jsonl"):
        return spark.read.json(path)
    if path.endswith(".json"):
        return spark.read.option("multiLine", True).json(path)
    raise ValueError(f"unknown kind of dataset: {path}")


def matched_documents(wanted: DataFrame, docs: DataFrame, path: str = "path") -> DataFrame:
    """Documents by their path, by path with .txt, or by the path's stem with .txt, whichever is there first."""
    tries = wanted.select(F.col(path).alias("_p")).distinct().select("_p", F.posexplode(F.array("_p", F.concat("_p", F.lit(".txt")), F.concat(F.regexp_replace("_p", r"\.[^./]*$", ""), F.lit(".txt")))).alias("_i", path))
    hits = tries.join(docs, path)
    best = hits.groupBy("_p").agg(F.min_by(F.struct(*docs.columns), "_i").alias("d"))
    return best.select(F.col("_p").alias("wanted"), "d.*")


def checkpoint_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """A step's saved rows, or None where there are none yet."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def vector_index(rows: DataFrame, path: str) -> DataFrame:
    """The index table at ``path`` if it was made of just these non-blank chunks, else built anew there. The number and the
    sum of hashes of whole rows say so, so a changed text makes a new index."""
    spark = rows.sparkSession
    chunks = rows.filter(F.trim(F.coalesce("text", F.lit(""))) != "")
    mark = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)"))).first()
    old = checkpoint_or_none(spark, path)
    if old is None or sorted(old.columns) != sorted(chunks.columns) or mark(old) != mark(chunks):
        chunks.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def cached(df: DataFrame, folder: str, name: str, settings: dict) -> DataFrame:
    """df as stored below the folder under a digest of its settings and of its rows' hashes, written there if it isn't yet.

    Whatever changes the content changes the digest, so no stale table is ever taken."""
    import hashlib
    import json

    spark = df.sparkSession
    n, hashes = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()
    digest = hashlib.md5(json.dumps([name, settings, n, str(hashes), df.schema.json()], sort_keys=True).encode()).hexdigest()
    found = checkpoint_or_none(spark, f"{folder}/{name}-{digest}")
    if found is None:
        df.write.mode("overwrite").parquet(f"{folder}/{name}-{digest}")
    return spark.read.parquet(f"{folder}/{name}-{digest}")


def saved_dataset(spark: SparkSession, source: str, local: str, split: str | None = None, order: str | None = None, most: int | None = None) -> DataFrame:
    """A dataset (a folder with a Parquet folder a split, or one table) saved at ``local`` and read from there.

    Several splits and none named is an error. What is saved already is taken, unless a number of rows is asked
    for, which are the first in the given order."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(source)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path) if split is None else []
    splits = sorted(f.getPath().getName() for f in found if f.isDirectory() and not f.getPath().getName().startswith(("_", ".")))
    if split is None and len(splits) > 1:
        raise ValueError(f"name one of the splits {', '.join(splits)}")
    split = split or (splits[0] if splits else None)
    old = checkpoint_or_none(spark, local)
    if old is None or most is not None:
        rows = spark.read.parquet(f"{source}/{split}" if split else source)
        if most is not None:
            rows = rows.orderBy(order or rows.columns[0]).limit(most)
        rows.write.mode("overwrite").parquet(local)
    return spark.read.parquet(local)


def read_chat_lists(spark: SparkSession, folder: str) -> DataFrame:
    """Message lists below <folder>/<digits>/meta_datagen/chat_lists, .json arrays and .jsonl lines, with their run."""
    schema = "messages array<struct<role:string,content:string>>, conversations array<struct<`from`:string,value:string>>, _corrupt_record string"
    out = None
    for glob, lines in (("*.json", False), ("*.jsonl", True)):
        rows = spark.read.schema(schema).option("multiLine", not lines).option("recursiveFileLookup", True).option("pathGlobFilter", glob).json(folder)
        rows = rows.withColumn("run", F.regexp_extract(F.col("_metadata.file_path"), r"/(\d+)/meta_datagen/chat_lists/[^/]+$", 1)).filter("run <> '' and _corrupt_record is null")
        out = rows if out is None else out.unionByName(rows)
    from ..functions.conversations import to_openai

    return out.select(F.col("run").cast("int").alias("run"), F.coalesce("messages", to_openai("conversations")).alias("messages")).filter("messages is not null")


def tokens_over(spark: SparkSession, paths: list[str], text: str = "text") -> DataFrame:
    """(file, n_rows, n_tokens) over paths and globs of .json, .jsonl, .parquet and text files, each file once however often it is named.

    A folder with a dataset's ending is a table in parts, which counts as one file of the folder's name; so do its parts if
    they are named too. A file without rows has 0 rows and, as in SQL, no sum of tokens."""
    from ..functions.text import token_count

    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    ending = lambda f: f.rsplit(".", 1)[-1]
    found: dict[str, bool] = {}
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        found |= {f.getPath().toString(): f.isDirectory() for f in path.getFileSystem(conf).globStatus(path) or []}
    if not found:
        raise FileNotFoundError(", ".join(paths))
    tables = {f for f, folder in found.items() if folder and ending(f) in ("parquet", "pq", "json", "jsonl")}
    above = lambda f: {f[:i] for i, x in enumerate(f) if x == "/"}
    files = {f for f in found if not tables & above(f)}
    # tables are read one by one, as each may have partitions and columns of its own.
    groups = [([f], f.rsplit("/", 1)[-1]) for f in sorted(files & tables)]
    groups += [(sorted(f for f in files - tables if ending(f) == kind), None) for kind in sorted({ending(f) for f in files - tables})]
    named = [(f.rsplit("/", 1)[-1],) for f in sorted(files) if f in tables or not found[f]]
    part = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    out = spark.createDataFrame(named, "file string").select("file", F.lit(None).cast("long").alias("n"))
    for own, name in groups:
        kind = ending(own[0])
        if kind in ("parquet", "pq"):
            rows = spark.read.parquet(*own)
        elif kind in ("json", "jsonl"):
            rows = spark.read.schema(f"{text} string").option("multiLine", kind == "json").json(own)
        else:
            rows = spark.read.option("wholetext", True).text(own).withColumnRenamed("value", text)
        out = out.unionByName(rows.select((F.lit(name) if name else part).alias("file"), token_count(text).alias("n")))
    return out.groupBy("file").agg(F.count("n").alias("n_rows"), F.sum("n").alias("n_tokens"))
