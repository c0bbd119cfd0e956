"""One file for each entity (SNK-5, SNK-6): a writer and a reader of Markdown pages for Spark's Python data sources."""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

SHARES = 32  # tasks of a reader; each goes through the names in the folder, so that their number does not grow with these


def opened(path: str):
    """The file system and folder of path, which may be an address (hdfs://, s3://, file:)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (fs.LocalFileSystem(), path)


def files_in(files, folder: str) -> Iterator[str]:
    """Names of the files in a folder, one by one where the file system can; none if it is not there."""
    from pyarrow import fs

    if isinstance(files, fs.LocalFileSystem):
        if os.path.isdir(folder):
            with os.scandir(folder) as inside:
                yield from (x.name for x in inside if x.is_file())
    else:
        yield from (x.base_name for x in files.get_file_info(fs.FileSelector(folder, allow_not_found=True)) if x.type == fs.FileType.File)


@dataclass
class Written(WriterCommitMessage):
    folder: str
    n: int


class PageSource(DataSource):
    """Rows of (slug, page) to path/slug.md. Options: path, suffix (.md)."""

    @classmethod
    def name(cls) -> str:
        return "foliant-pages"

    def schema(self) -> str:
        return "slug string, page string"

    def reader(self, schema) -> DataSourceReader:
        return PageReader(self.options["path"], self.options.get("suffix", ".md"))

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return PageWriter(self.options["path"], self.options.get("suffix", ".md"), overwrite)


@dataclass
class Share(InputPartition):
    k: int


class PageReader(DataSourceReader):
    """The pages of a folder in SHARES tasks, each of the names that fall to it: the driver holds no list of files."""

    def __init__(self, path: str, suffix: str) -> None:
        self.path, self.suffix = path.rstrip("/"), suffix

    def partitions(self) -> list[Share]:
        return [Share(k) for k in range(SHARES)]

    def read(self, share: Share) -> Iterator[tuple]:
        files, at = opened(self.path)
        for name in files_in(files, at):
            if name.endswith(self.suffix) and zlib.crc32(name.encode()) % SHARES == share.k:
                with files.open_input_stream(f"{at}/{name}") as f:
                    yield name.removesuffix(self.suffix), f.read().decode("utf-8", "replace")


class PageWriter(DataSourceWriter):
    """Each attempt of a task writes to a folder of its own below `.staging`; the driver moves the pages of the attempts that count, and deletes the rest.
    With overwrite, pages of an earlier run go before the new ones come. So a failed or retried task leaves no page."""

    def __init__(self, path: str, suffix: str, overwrite: bool) -> None:
        self.path, self.suffix, self.overwrite, self.run = path.rstrip("/"), suffix, overwrite, uuid.uuid4().hex

    def write(self, rows: Iterator) -> WriterCommitMessage:
        files, at = opened(self.path)
        folder, n = f"{at}/.staging-{self.run}/{uuid.uuid4().hex}", 0
        files.create_dir(folder, recursive=True)
        for slug, page in rows:
            if not slug or slug.startswith(".") or "/" in slug or "\0" in slug:
                raise ValueError(f"no name for a page: {slug!r}")
            with files.open_output_stream(f"{folder}/{slug}{self.suffix}") as f:
                f.write((page or "").encode())
            n += 1
        return Written(folder, n)

    def commit(self, messages: list) -> None:
        files, at = opened(self.path)
        if self.overwrite:
            for name in files_in(files, at):
                if name.endswith(self.suffix):
                    files.delete_file(f"{at}/{name}")
        for message in filter(None, messages):
            for name in files_in(files, message.folder):
                files.move(f"{message.folder}/{name}", f"{at}/{name}")
        self.abort(messages)

    def abort(self, messages: list) -> None:
        from pyarrow import fs

        files, at = opened(self.path)
        staging = f"{at}/.staging-{self.run}"
        if files.get_file_info(staging).type == fs.FileType.Directory:
            files.delete_dir(staging)


def write_pages(df: DataFrame, path: str, name: str = "slug", text: str = "page", append: bool = False, suffix: str = ".md") -> None:
    """SNK-5, SNK-6: path/slug<suffix> for each slug, nothing else; pages of an earlier run go unless append. Rows of one slug make one page, in the order of their texts.

    The folder must be one that driver and executors reach by the same name.
    """
    spark = df.sparkSession
    spark.dataSource.register(PageSource)
    each = df.groupBy(F.col(name).alias("slug")).agg(F.array_join(F.array_sort(F.collect_list(text)), "\n\n").alias("page"))
    each.write.format("foliant-pages").mode("append" if append else "overwrite").option("path", path).option("suffix", suffix).save()


def read_pages(spark: SparkSession, path: str, suffix: str = ".md") -> DataFrame:
    """slug, page of each page in a folder. Spark's own file sources list all files on the driver first."""
    spark.dataSource.register(PageSource)
    return spark.read.format("foliant-pages").option("path", path).option("suffix", suffix).load()
