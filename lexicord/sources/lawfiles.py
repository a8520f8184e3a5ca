"""Files of the corpus under their own names.

Reading takes a list of addresses and gives a row for each: its content, or why
there is none.  A short list is planned into partitions of a data source; a list
kept in files is a table, dealt over tasks, that never passes through the driver.
Writing takes (path, text) rows and makes one file of the texts of each path, in
order; files are written aside and get their names, in tasks again, when all of
them are there, so a task that fails or runs twice leaves no half file.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from lexicord.functions import rules
from lexicord.sources.tables import checkpointed

#: Addresses that one partition reads, from a short list and from one kept in files.
PER_TASK, LISTED_PER_TASK = 64, 4096
#: Bytes of content and files in one batch of a task's results.
BATCH_BYTES, BATCH_FILES = 4 << 20, 1000
STAGING = "_staging"
FILE = "url string, content binary, content_type string, error string"


def opened(root: str):
    """The file system and path of a folder: a local path, or any address that pyarrow knows."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(root) if ":" in root.split("/")[0] else (fs.LocalFileSystem(), root)
    return store, path.rstrip("/")


def contents(root: str, urls: Iterable[str]) -> Iterator[tuple]:
    """(url, content, content_type, error) of each address below root."""
    from pyarrow import fs

    store, root = opened(root)
    for url in urls:
        path = f"{root}/{url.removeprefix('file:').lstrip('/')}"
        kind = "application/pdf" if path.endswith(".pdf") else "text/html"
        try:
            if store.get_file_info(path).type != fs.FileType.File:
                yield url, None, kind, rules.SAYS_NO_FILE % path
                continue
            with store.open_input_stream(path) as f:
                yield url, f.read(), kind, None
        except OSError as e:  # a file that cannot be read is a row, not a failed job
            yield url, None, kind, f"{type(e).__name__}: {e}"


def set_aside(root: str, job: str, rows: Iterable[tuple[str, str | None]]) -> Iterator[tuple[str, str]]:
    """(place aside, final place) of each file: texts of one path that follow one another go to one file."""
    store, root = opened(root)
    folder, count, path, out = f"{root}/{STAGING}/{job}/{uuid.uuid4().hex}", 0, None, None
    store.create_dir(folder, recursive=True)
    for name, text in rows:
        if name != path:
            if out:
                out.close()
                yield f"{folder}/{count}", f"{root}/{path}"
                count += 1
            path, out = name, store.open_output_stream(f"{folder}/{count}")
        out.write((text or "").encode())
    if out:
        out.close()
        yield f"{folder}/{count}", f"{root}/{path}"


def put_in_place(root: str, files: Iterable[tuple[str, str]]) -> int:
    """Files that were set aside get their names; one that an earlier attempt has moved stays."""
    from pyarrow import fs

    store, _ = opened(root)
    folders, count = set(), 0
    for aside, final in files:
        folder = final.rsplit("/", 1)[0]
        if folder not in folders:
            store.create_dir(folder, recursive=True)
            folders.add(folder)
        if not isinstance(store, fs.LocalFileSystem) and store.get_file_info(aside).type == fs.FileType.File and store.get_file_info(final).type == fs.FileType.File:
            store.delete_file(final)  # elsewhere a move does not replace
        try:
            store.move(aside, final)
        except OSError:
            if store.get_file_info(aside).type == fs.FileType.File or store.get_file_info(final).type != fs.FileType.File:
                raise
        count += 1
    return count


def cleared(root: str, job: str) -> None:
    """Remove all that was written aside, that of lost attempts too."""
    from pyarrow import fs

    store, root = opened(root)
    if store.get_file_info(f"{root}/{STAGING}/{job}").type == fs.FileType.Directory:
        store.delete_dir(f"{root}/{STAGING}/{job}")


@dataclass
class Addresses(InputPartition):
    urls: list[str]


class LawFileReader(DataSourceReader):
    def __init__(self, root: str, urls: list[str]):
        self.root, self.urls = root, urls

    def partitions(self) -> list[Addresses]:
        return [Addresses(self.urls[k : k + PER_TASK]) for k in range(0, len(self.urls), PER_TASK)] or [Addresses([])]

    def read(self, partition: Addresses) -> Iterator[tuple]:
        return contents(self.root, partition.urls)


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]


class LawFileWriter(DataSourceWriter):
    """For few files, whose names the driver gives; write_files() has tasks do that."""

    def __init__(self, root: str):
        self.root, self.job = root, uuid.uuid4().hex

    def write(self, iterator: Iterator) -> Written:
        return Written(list(set_aside(self.root, self.job, ((row.path, row.text) for row in iterator))))

    def commit(self, messages: list[Written]) -> None:
        put_in_place(self.root, (f for m in messages if m for f in m.files))
        self.abort(messages)

    def abort(self, messages: list[Written]) -> None:
        cleared(self.root, self.job)


class LawFiles(DataSource):
    """Options: root; for reading, urls (a JSON list) or list (the place of a text file with an address on each line, below root)."""

    @classmethod
    def name(cls) -> str:
        return "law_files"

    def schema(self) -> str:
        return FILE

    def reader(self, schema) -> LawFileReader:
        root = self.options["root"]
        if "urls" in self.options:
            return LawFileReader(root, json.loads(self.options["urls"]))
        store, path = opened(root)
        with store.open_input_stream(f"{path}/{self.options['list']}") as f:
            return LawFileReader(root, [u for u in f.read().decode().split("\n") if u])

    def writer(self, schema, overwrite: bool) -> LawFileWriter:
        return LawFileWriter(self.options["root"])


def in_batches(rows: Iterable[tuple], schema: pa.Schema, content: int | None = None) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded count and bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[content] or b"") if content is not None else 0
        if len(held) >= BATCH_FILES or size >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def values(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[column.to_pylist() for column in batch.columns])


def listed_files(addresses: DataFrame, root: str) -> DataFrame:
    """(url, content, content_type, error) of each address of a table's only column, some thousand in a task."""
    schema = pa.schema([("url", pa.string()), ("content", pa.binary()), ("content_type", pa.string()), ("error", pa.string())])

    def read(batches):
        return in_batches(contents(root, (url for url, in values(batches))), schema, content=1)

    tasks = max(addresses.sparkSession.sparkContext.defaultParallelism, -(-addresses.count() // LISTED_PER_TASK))
    return addresses.repartition(tasks).mapInArrow(read, FILE)


def read_files(spark: SparkSession, root: str, urls: list[str] | None = None, listed: str | None = None) -> DataFrame:
    """(url, content, content_type, error) of each address, which is a path below `root`, with or without `file:`.

    Addresses are given, or `listed` in a text file or folder of such files below root, one on each line.
    """
    if listed:
        return listed_files(spark.read.option("lineSep", "\n").text(f"{root}/{listed}").where("value != ''"), root)
    spark.dataSource.register(LawFiles)
    return spark.read.format("law_files").option("root", root).option("urls", json.dumps(urls or [])).load()


def write_files(rows: DataFrame, root: str, path: str = "path", order: str = "seq", text: str = "text") -> None:
    """One file for each path, of its texts in order; existing files of these names are replaced, others stay."""
    job = uuid.uuid4().hex
    names = pa.schema([("aside", pa.string()), ("final", pa.string())])
    moved = pa.schema([("files", pa.int64())])

    def aside(batches):
        return in_batches(set_aside(root, job, values(batches)), names)

    def in_place(batches):
        return in_batches([(put_in_place(root, values(batches)),)], moved)

    dealt = rows.select(F.col(path).alias("path"), F.col(order).alias("seq"), F.col(text).alias("text")).repartition("path").sortWithinPartitions("path", "seq")
    try:
        # the table holds the files of the attempts that count
        files = checkpointed(dealt.select("path", "text").mapInArrow(aside, "aside string, final string"))
        files.mapInArrow(in_place, "files long").agg(F.sum("files")).collect()
    finally:
        cleared(root, job)


def json_text(columns: list[str], between: str = ", ", start: str = "", end: str = "") -> Column:
    """A row's columns as a JSON object, null ones too, with blanks as the standard library writes them."""
    fields = []
    for c in columns:
        value = F.to_json(F.array(F.col(c)), {"ignoreNullFields": "false"})
        fields.append(F.concat(F.lit(f'"{c}": '), F.substring(value, F.lit(2), F.length(value) - 2)))
    return F.concat(F.lit("{" + start), F.concat_ws(between, *fields), F.lit(end + "}"))


def folder_of(theme: Column, law: Column) -> Column:
    return F.concat(theme, F.lit("/"), law.cast("string"))


def write_law_files(root: str, documents: DataFrame, records: DataFrame, facts: DataFrame) -> None:
    """`<theme>/<id>/full.md`, `articles.jsonl` and `meta.json` of each law.

    documents is (law, document), records the rows of paragraph_records with their
    place `seq`, facts the rows of law_meta.
    """
    places = facts.select(F.col("id").alias("law"), folder_of(F.col("thematiki"), F.col("id")).alias("folder"))
    full = documents.join(places, "law").select(F.concat("folder", F.lit("/full.md")).alias("path"), F.struct(F.lit(0).alias("pos"), F.lit(0).alias("par")).alias("seq"), F.col("document").alias("text"))
    lines = records.select(F.concat(folder_of(F.col("thematiki"), F.col("nomothetima_id")), F.lit("/articles.jsonl")).alias("path"), F.struct(F.col("seq.pos").cast("int").alias("pos"), F.col("seq.par").cast("int").alias("par")).alias("seq"), F.concat(json_text([c for c in records.columns if c != "seq"]), F.lit("\n")).alias("text"))
    meta = facts.select(F.concat(folder_of(F.col("thematiki"), F.col("id")), F.lit("/meta.json")).alias("path"), F.struct(F.lit(0).alias("pos"), F.lit(0).alias("par")).alias("seq"), F.concat(json_text(facts.columns, ",\n  ", "\n  ", "\n"), F.lit("\n")).alias("text"))
    write_files(full.unionByName(lines).unionByName(meta), root)


def write_export_files(exported: DataFrame, laws: DataFrame, root: str) -> None:
    """`<theme>/<id>.md` of each exported law."""
    rows = exported.join(laws.select(F.col("id").alias("law"), "thematiki"), "law")
    write_files(rows.select(F.concat(folder_of(F.col("thematiki"), F.col("law")), F.lit(".md")).alias("path"), F.lit(0).alias("seq"), F.col("document").alias("text")), root)
