"""Files of the stages: layout JSON in, Parquet tables with restart, CSV and JSON out."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Iterator, Mapping
from types import MappingProxyType

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_layout(spark: SparkSession, path: str, doc_ids: Iterable[str] | None = None) -> DataFrame:
    """(doc_id, json) of the JSON files in a folder; a document is named by its file."""
    df = spark.read.option("wholetext", True).option("pathGlobFilter", "*.json").text(path)
    return only(df.select(F.regexp_replace("_metadata.file_name", r"\.json$", "").alias("doc_id"), F.col("value").alias("json")), doc_ids)


def read_pdfs(spark: SparkSession, path: str, doc_ids: Iterable[str] | None = None) -> DataFrame:
    """(doc_id, path, content) of the PDF files in a folder; an error if there are none."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", "*.[pP][dD][fF]").load(path)
    df = only(df.select(F.regexp_replace("_metadata.file_name", r"(?i)\.pdf$", "").alias("doc_id"), "path", "content"), doc_ids)
    if df.select("path").isEmpty():
        raise FileNotFoundError(f"no PDF files in {path}")
    return df


def convert(pdfs: DataFrame, converter: Callable[[bytes], str], done: DataFrame | None = None) -> DataFrame:
    """(doc_id, json) by a given picklable converter, but for the documents in ``done``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "json": [converter(bytes(c)) for c in b["content"]]}, dtype=object)

    todo = pdfs if done is None else pdfs.join(done.select("doc_id"), "doc_id", "left_anti")
    return todo.select("doc_id", "content").mapInPandas(run, "doc_id string, json string")


def in_order(df: DataFrame, doc_ids: Iterable[str] | None) -> DataFrame:
    """(place, doc_id): the documents there are, by name or, if ids are given, in their order,
    repeated ones repeatedly, unknown ones not at all."""
    names = df.select(F.col("doc_id").cast("string").alias("doc_id")).distinct()
    if doc_ids is None:
        return names.select("doc_id").withColumn("place", F.lit(None).cast("int"))
    given = df.sparkSession.createDataFrame(list(enumerate(doc_ids)), "place int, doc_id string")
    return given.join(names, "doc_id", "left_semi")


def required(df: DataFrame, doc_ids: Iterable[str]) -> DataFrame:
    """The rows of the documents; an error that names those without any."""
    wanted = df.sparkSession.createDataFrame([(d,) for d in set(doc_ids)], "doc_id string")
    lost = sorted(r.doc_id for r in wanted.join(df.select("doc_id"), "doc_id", "left_anti").collect())  # at most the ids given
    if lost:
        raise LookupError("no rows of " + ", ".join(lost))
    return only(df, doc_ids)


def read_summaries(spark: SparkSession, path: str, schema: str, doc_ids: Iterable[str] | None = None, name: str = "visual_summary_items.json") -> DataFrame:
    """Summaries of a folder of documents, each a JSON file in the folder of its document."""
    df = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", name).json(path)
    return only(df.withColumn("doc_id", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1)), doc_ids)


def only(df: DataFrame, doc_ids: Iterable[str] | None) -> DataFrame:
    return df if doc_ids is None else df.where(F.col("doc_id").isin(*set(doc_ids)))


def fingerprint(*parts: object) -> str:
    """24 hex digits that stand for plain values, whatever the order of their keys."""
    return hashlib.sha256(json.dumps(parts, sort_keys=True, ensure_ascii=False, default=str).encode()).hexdigest()[:24]


def files_fingerprint(spark: SparkSession, path: str, pattern: str = "*.json", doc_ids: Iterable[str] | None = None, by_content: bool = False) -> str:
    """Of the names, lengths and times of a folder's files (of the documents, if given) or, with
    ``by_content``, of their names and contents; counted and summed where the files are listed."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    df = only(df.withColumn("doc_id", F.regexp_replace("_metadata.file_name", r"\.[^.]*$", "")), doc_ids)
    state = [F.sha2("content", 256)] if by_content else ["length", "modificationTime"]
    r = df.select(F.xxhash64("doc_id", *state).alias("h")).agg(F.count(F.lit(1)), F.sum(F.col("h").cast("decimal(38,0)")), F.bit_xor("h")).first()
    return fingerprint(*map(str, r))


class Files:
    """Small files through Spark's own file systems."""

    def __init__(self, spark: SparkSession):
        self._spark = spark

    def _at(self, path: str):
        at = self._spark._jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self._spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        at, fs = self._at(path)
        return fs.exists(at)

    def glob(self, pattern: str) -> list[str]:
        at, fs = self._at(pattern)
        return sorted(str(x.getPath().toString()) for x in fs.globStatus(at) or [])

    def delete(self, path: str) -> None:
        at, fs = self._at(path)
        fs.delete(at, True)

    def read(self, path: str) -> str | None:
        at, fs = self._at(path)
        if not fs.exists(at):
            return None
        stream = fs.open(at)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        at, fs = self._at(path)
        stream = fs.create(at, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()


class Stages:
    """Tables and files of a run in one folder, each with a note of what it was made from.

    The note holds a fingerprint of the ``inputs`` (plain values: parameters, fingerprints of
    files) and of the notes of the tables that it was built ``after``. What is there whole and
    under the same fingerprint is not built again; a change is passed on to all that depends on
    it. The note goes before a table is written and comes when it is whole.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark)

    def note(self, name: str) -> dict | None:
        text = self.files.read(f"{self.root}/_notes/{name}.json")
        return json.loads(text) if text else None

    def done(self, name: str) -> bool:
        return self.files.exists(f"{self.root}/{name}.parquet/_SUCCESS")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")

    def fingerprint(self, inputs: Mapping[str, object], after: Iterable[str]) -> str:
        notes = {x: (self.note(x) or {}).get("fingerprint") for x in after}
        return fingerprint(dict(inputs), notes)

    def fresh(self, name: str, mark: str, path: str) -> bool:
        return (self.note(name) or {}).get("fingerprint") == mark and self.files.exists(f"{path}/_SUCCESS")

    def keep(self, name: str, path: str, write: Callable[[], None], inputs: Mapping[str, object], after: Iterable[str], again: bool = False) -> bool:
        """Whether ``write`` ran: not if what it writes is there under the same fingerprint."""
        after = tuple(after)
        mark, note = self.fingerprint(inputs, after), f"{self.root}/_notes/{name}.json"
        if not again and self.fresh(name, mark, path):
            return False
        self.files.delete(note)
        write()
        self.files.write(note, json.dumps({"fingerprint": mark, "inputs": dict(inputs), "after": list(after)}, default=str))
        return True

    def table(self, name: str, build: Callable[[], DataFrame], again: bool = False, *, inputs: Mapping[str, object] = MappingProxyType({}), after: Iterable[str] = ()) -> DataFrame:
        path = f"{self.root}/{name}.parquet"
        self.keep(name, path, lambda: build().write.mode("overwrite").parquet(path), inputs, after, again)
        return self.read(name)

    def numbered(self, name: str, build: Callable[[], DataFrame], order: list[str], column: str) -> DataFrame:
        """The table in order, numbered from 0 over all rows. Numbers are places in the sorted
        partitions plus the sizes of those before; only the sizes reach the driver."""
        place = F.monotonically_increasing_id().alias("__place")
        df = self.table(name, lambda: build().sort(*order).select("*", place))
        part = F.shiftright("__place", 33)
        sizes = df.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect()
        before, offsets = 0, []
        for r in sizes:
            offsets += [F.lit(r.p), F.lit(before)]
            before += r.n
        if not offsets:
            return df.withColumn(column, F.col("__place")).drop("__place")
        base = F.element_at(F.create_map(*offsets), part).cast("long")
        return df.withColumn(column, base + F.col("__place").bitwiseAND((1 << 33) - 1)).drop("__place")

    def csv(self, name: str, df: DataFrame) -> None:
        """Nested columns as JSON text."""
        flat = [F.to_json(c).alias(c) if t.startswith(("array", "struct", "map")) else F.col(c) for c, t in df.dtypes]
        df.select(*flat).write.mode("overwrite").option("header", True).csv(f"{self.root}/{name}.csv")

    def json(self, name: str, value: object) -> None:
        """One file of indented JSON."""
        self.files.write(f"{self.root}/{name}.json", json.dumps(value, ensure_ascii=False, indent=2, default=str))

    def documents(self, name: str, df: DataFrame) -> None:
        """One folder of JSON lines a document."""
        df.write.mode("overwrite").partitionBy("doc_id").json(f"{self.root}/{name}")

    def texts(self, name: str, df: DataFrame, column: str) -> None:
        """One folder of a text file a document."""
        df.select("doc_id", column).write.mode("overwrite").partitionBy("doc_id").text(f"{self.root}/{name}")

    def read_documents(self, name: str, schema: str, doc_ids: Iterable[str] | None = None) -> DataFrame:
        return only(self.spark.read.schema(schema).json(f"{self.root}/{name}"), doc_ids)
