"""Writers. All go through Spark's output committer, so a reader sees a whole output or none."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.verdicts import story_ok
from ..operators import keys


def write_jsonl(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def save_checkpoint(df: DataFrame, folder: str) -> str:
    """A new version below the folder; the name of the newest is the last one in order of time."""
    from datetime import datetime, timezone

    path = f"{folder}/v{datetime.now(timezone.utc):%Y%m%d%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(path)
    return path


def upsert(df: DataFrame, saved: DataFrame | None, key: str, folder: str) -> str:
    """Saved columns stay, missing ones and new rows come from df."""
    return save_checkpoint(df if saved is None else keys.upserted(df, saved, key), folder)


def write_by_source(df: DataFrame, path: str, source: str = "source_file") -> None:
    """JSONL in a folder for each source file, and all rows together."""
    df.withColumn("_part", F.col(source)).write.mode("overwrite").partitionBy("_part").json(f"{path}/by_source")
    df.write.mode("overwrite").json(f"{path}/all")


def write_text_files(df: DataFrame, path: str, name: str = "path", text: str = "text") -> int:
    """One file for each row, of its relative name, with the text in it; the number of files.

    ``path`` is a URI that all executors reach (by pyarrow.fs). A file is written under a name of the attempt's own and then
    moved to its place. Names that lead out of the folder are an error; of rows of one name one is kept."""
    from pyarrow import fs

    system, folder = fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
    system.create_dir(folder, recursive=True)

    def run(frames):
        import pandas as pd

        system, folder = fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
        for pdf in frames:
            for file, value in zip(pdf["name"], pdf["value"], strict=True):
                if ".." in file.split("/") or file.startswith("/"):
                    raise ValueError(f"{file} leads out of the folder")
                system.create_dir(f"{folder}/{file}".rsplit("/", 1)[0], recursive=True)
                own = f"{folder}/{file}.{uuid.uuid4().hex}"
                with system.open_output_stream(own) as f:
                    f.write((value or "").encode("utf-8", "replace"))
                system.move(own, f"{folder}/{file}")
            yield pd.DataFrame({"n": [len(pdf)]})

    rows = df.select(F.col(name).alias("name"), F.col(text).alias("value")).dropDuplicates(["name"])
    return rows.mapInPandas(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def rewritten(spark, path: str, change, folder: str) -> str:
    """The rows at ``path`` changed by a function of DataFrames, saved as a new version below the folder."""
    return save_checkpoint(change(spark.read.parquet(path)), folder)


def cleaned(spark, folder: str) -> bool:
    """Delete a folder; whether there was one."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True))


def preview(df: DataFrame, n: int = 1) -> list[dict]:
    """The first rows, as dictionaries."""
    return [r.asDict(recursive=True) for r in df.limit(n).collect()]


def write_questions(qa: DataFrame, conversations: DataFrame, path: str) -> None:
    """Questions and conversations of a run, each as JSONL."""
    qa.write.mode("overwrite").json(f"{path}/questions")
    conversations.write.mode("overwrite").json(f"{path}/conversations")


def write_story_tiers(df: DataFrame, path: str, ratings: str = "ratings") -> None:
    """All stories, those rated good or better throughout, and those rated incredible throughout."""
    rated = F.col(ratings)
    df.write.mode("overwrite").json(f"{path}/all")
    df.filter(story_ok(rated)).write.mode("overwrite").json(f"{path}/good_and_above")
    df.filter(story_ok(rated, ("incredible",))).write.mode("overwrite").json(f"{path}/incredible")


def append_rewarded(df: DataFrame, path: str, least: float, reward: str = "reward") -> None:
    """Rows whose reward reaches ``least`` are appended as segments: the prompt masked, the reply learned."""
    segment = lambda label, c: F.struct(F.lit(label).alias("label"), F.col(c).alias("text"))
    df.filter(F.col(reward) >= least).select(F.array(segment(False, "prompt"), segment(True, "reply")).alias("segments")).write.mode("append").json(path)


def write_meta(completions: DataFrame, chats: DataFrame, path: str) -> None:
    """Completion rows and chat rows of a meta-dataset; both empty is an error."""
    if completions.isEmpty() and chats.isEmpty():
        raise ValueError("a meta-dataset without rows")
    completions.write.mode("overwrite").json(f"{path}/completion_lists")
    chats.write.mode("overwrite").json(f"{path}/chat_lists")


def training_config(datasets: list[dict], out: str, base: dict | None = None) -> str:
    """YAML of a training run over the datasets."""
    import yaml

    return yaml.safe_dump({**(base or {}), "datasets": datasets, "output_dir": out}, sort_keys=False)


def completion_dataset(path: str) -> dict:
    return {"path": path, "type": "completion", "ds_type": "json"}


def segments_dataset(path: str) -> dict:
    return {"path": path, "type": "input_output", "ds_type": "json"}
