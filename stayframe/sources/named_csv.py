"""A sink that writes one CSV file per parameter, named after it.

``write_named_csv`` writes ``<folder>/<parameter>.csv`` for every value of a
column, with a header, on request with the byte-order mark and the leading
unnamed index column (0, 1, ..) that notebook tools write. It is a Python data
source: tasks stream Arrow batches into files of a temporary folder, and the
commit renames them, so a failed or repeated task leaves nothing behind and a
reader never sees half a file. Files are read back by Spark's own CSV reader
(``files.read_param_files``, ``from_="file"``).

A file is one task's stream. ``rows_per_file`` cuts a parameter with more rows
into ``<parameter>~1.csv``, ``<parameter>~2.csv`` and so on, so a hot one is
written by many tasks. Characters of a parameter that a file name should not
have are percent-encoded. A null parameter is written as ``~null``;
an empty text is read back as null, since CSV does not tell them apart."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import csv, fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

BOM = b"\xef\xbb\xbf"
NULL_NAME = "~null"
_FILE = "_file"

# the sink travels to the executors by value, so that the package need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _encoded(parameter: Column, piece: Column) -> Column:
    """The file of a parameter: letters, digits, blanks and ``-._`` stay; other
    characters, and a dot or underscore at the start, which would hide the file
    from Spark, are percent-encoded."""
    name = F.replace(F.replace(F.url_encode(parameter), F.lit("+"), F.lit(" ")), F.lit("*"), F.lit("%2A"))
    name = F.when(name.startswith("."), F.concat(F.lit("%2E"), F.substring(name, 2, 1 << 30))).when(
        name.startswith("_"), F.concat(F.lit("%5F"), F.substring(name, 2, 1 << 30))).otherwise(name)
    return F.concat(F.coalesce(name, F.lit(NULL_NAME)), F.when(piece > 0, F.concat(F.lit("~"), piece.cast("string"))).otherwise(""),
                    F.lit(".csv"))


def decoded(file: Column) -> Column:
    """The parameter of a file name as ``_metadata.file_name`` gives it; names
    from elsewhere need not be encoded."""
    plain = lambda c: F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))
    name = F.regexp_extract(F.coalesce(plain(file), file), r"^(?s)(.*?)(~[0-9]+)?\.csv$", 1)
    return F.when(name != NULL_NAME, F.coalesce(plain(name), name))


@dataclass
class Files(WriterCommitMessage):
    names: list[str]


class NamedCsvWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.path, self.run = options["path"].rstrip("/"), options["run"]
        self.bom, self.index = options["bom"] == "true", options["index"] == "true"

    def _folder(self) -> tuple[fs.FileSystem, str]:
        system, root = fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (
            fs.LocalFileSystem(), self.path)
        return system, root

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Files:
        """Rows sorted by file; a file's rows come together."""
        system, root = self._folder()
        temporary = f"{root}/_temporary-{self.run}/{uuid.uuid4().hex}"
        system.create_dir(temporary)
        names: list[str] = []
        name = stream = writer = None
        at = 0
        for batch in iterator:
            files = batch.column(batch.schema.get_field_index(_FILE))
            kept = batch.drop_columns([_FILE])
            start = 0
            while start < batch.num_rows:
                here = files[start].as_py()
                end = start + 1
                while end < batch.num_rows and files[end].as_py() == here:
                    end += 1
                part = kept.slice(start, end - start)
                if here != name:
                    if writer is not None:
                        writer.close()
                        stream.close()
                    name, at = here, 0
                    names.append(f"{temporary}/{name}")
                    stream = system.open_output_stream(names[-1])
                    if self.bom:
                        stream.write(BOM)
                    writer = None
                if self.index:
                    count = pa.array(range(at, at + part.num_rows), pa.int64())
                    part = pa.RecordBatch.from_arrays([count, *part.columns], names=["", *part.schema.names])
                if writer is None:
                    writer = csv.CSVWriter(stream, part.schema)
                writer.write(part)
                at += part.num_rows
                start = end
        if writer is not None:
            writer.close()
            stream.close()
        return Files(names)

    def commit(self, messages: list[Files | None]) -> None:
        system, root = self._folder()
        for message in messages:
            for name in message.names if message else []:
                system.move(name, f"{root}/{name.rpartition('/')[2]}")
        self.abort(messages)

    def abort(self, messages: list[Files | None]) -> None:
        system, root = self._folder()
        if system.get_file_info(f"{root}/_temporary-{self.run}").type == fs.FileType.Directory:
            system.delete_dir(f"{root}/_temporary-{self.run}")


class NamedCsv(DataSource):
    @classmethod
    def name(cls) -> str:
        return "named_csv"

    def writer(self, schema, overwrite: bool) -> NamedCsvWriter:
        return NamedCsvWriter(dict(self.options))


def write_named_csv(df: DataFrame, path: str, param: str, index: bool = False, bom: bool = False, order: tuple[str, ...] = (),
                    rows_per_file: int | None = None) -> str:
    """One named CSV file per value of ``param``, which itself is not written,
    with rows in ``order``. Times are written as text with microseconds. A file of
    that name is replaced; other files of the folder stay."""
    spark = df.sparkSession
    spark.dataSource.register(NamedCsv)
    as_text = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c, t in df.dtypes if t.startswith("timestamp")}
    rows = df.withColumns(as_text).withColumn("_param", F.col(param).cast("string"))
    piece = F.lit(0)
    if rows_per_file:
        sizes = rows.groupBy("_param").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > rows_per_file)
        sizes = sizes.select(F.col("_param").alias("_large"), F.ceil(F.col("_n") / rows_per_file).cast("int").alias("_pieces"))
        rows = rows.join(sizes, rows["_param"].eqNullSafe(sizes["_large"]), "left")
        piece = F.coalesce(F.pmod(F.xxhash64(*df.columns), F.col("_pieces")), F.lit(0)).cast("int")
    rows = rows.withColumn(_FILE, _encoded(F.col("_param"), piece))
    out = rows.select(_FILE, *[c for c in df.columns if c != param])
    out = out.repartition(_FILE).sortWithinPartitions(_FILE, *order)
    out.write.format("named_csv").mode("append").option("path", path).option("run", uuid.uuid4().hex[:12]).option(
        "bom", str(bom).lower()).option("index", str(index).lower()).save()
    return path
