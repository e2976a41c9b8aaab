"""Where each member of a tar archive lies, random access to members, and archives split over tasks.

`member_index` walks an archive's headers once and notes at which byte every
member begins. From its table come `splits`, pieces of archives of about equal
size that tasks read on their own, and `fetch`, which reads the byte ranges of
chosen members and nothing else. Compressed archives have no such places: they
are one split, and fetch walks through them once, up to the last member wanted.

Archives are opened where they lie: on local or mounted file systems, or in any
store that Arrow's file systems reach (s3, gs, abfs, hdfs). What cannot be opened
or read becomes a row with an error.
"""

from __future__ import annotations

import bz2
import gzip
import io
import lzma
import tarfile
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from driftscan import functions as X
from driftscan.session import ship
from driftscan.stores import STREAMED, file_system, files_below, open_file

#: Errors of unreadable archives: such a one is a row.
UNREADABLE = (tarfile.TarError, EOFError, OSError, ValueError, zlib.error, lzma.LZMAError)
#: A member above this many bytes does not fit into a row; its content is null and its error says so.
LARGEST = 2_000_000_000
_MEMBER = [T.StructField("tar_path", T.StringType()), T.StructField("member_idx", T.IntegerType()), T.StructField("name", T.StringType()), T.StructField("size", T.LongType())]
_ERROR = T.StructField("error", T.StringType())
INDEX = T.StructType([*_MEMBER, *(T.StructField(n, T.LongType()) for n in ("offset", "data_offset", "next_offset")), _ERROR])
MEMBERS = T.StructType([*_MEMBER, T.StructField("content", T.BinaryType()), _ERROR])


class _Header(tarfile.TarInfo):
    """A header that reports damage in the middle of an archive, which would else pass for its end."""

    @classmethod
    def fromtarfile(cls, tar: tarfile.TarFile) -> tarfile.TarInfo:
        try:
            return super().fromtarfile(tar)
        except (tarfile.InvalidHeaderError, tarfile.TruncatedHeaderError) as e:
            raise tarfile.ReadError(f"{e} at {tar.offset}") from None


def unpacked(file):
    """The decompressing reader of a file that begins as gzip, bzip2 or xz; None for others."""
    head = file.read(6)
    file.seek(0)
    kind = next((k for k, magic in ((gzip.GzipFile, b"\x1f\x8b"), (bz2.BZ2File, b"BZh"), (lzma.LZMAFile, b"\xfd7zXZ\x00")) if head.startswith(magic)), None)
    return kind and (kind(fileobj=file) if kind is gzip.GzipFile else kind(file))


def walk(file, start: int | None = None, stop: int | None = None) -> Iterator[tuple[tarfile.TarFile, tarfile.TarInfo]]:
    """The members of an open archive in order, one held at a time; start and stop are header offsets of an uncompressed one."""
    packed = unpacked(file) if start is None else None
    if start is not None:
        file.seek(start)
    with tarfile.open(fileobj=packed or file, mode="r|" if packed else "r:", tarinfo=_Header) as tar:
        while (m := tar.next()) is not None and (stop is None or m.offset < stop):
            yield tar, m
            tar.members.clear()  # else a list of all of them would grow
    while packed and packed.read(1 << 20):
        pass  # to the end, where the checksum is


def index_rows(path: str, opened: Callable = open_file) -> Iterator[tuple]:
    """INDEX rows of one archive: its regular files, then an error if it breaks off.

    offset is where a member's headers begin and next_offset where the next one's
    do; both are null where the archive has to be read from its beginning
    (compressed, or with headers that hold for all members). data_offset is where
    its bytes lie, null where they do not lie together.
    """
    try:
        with opened(path) as file:
            plain = unpacked(file) is None
            for k, (tar, m) in enumerate(walk(file)):
                whole = not plain or bool(tar.pax_headers)
                if m.isfile():
                    yield path, k, m.name, m.size, None if whole else m.offset, m.offset_data if plain and not m.issparse() else None, None if whole else tar.offset, None
    except UNREADABLE as e:
        yield path, -1, None, None, None, None, None, f"{type(e).__name__}: {e}"[:200]


def read_split(path: str, start: int | None, stop: int | None, first: int, content: bool, opened: Callable = open_file, wanted: Callable[[str], bool] = lambda name: True) -> Iterator[tuple]:
    """MEMBERS rows of the files with a wanted name whose headers begin from start to before stop; first is the first member's number."""
    try:
        with opened(path) as file:
            for k, (tar, m) in enumerate(walk(file, start, stop), first):
                if m.isfile() and wanted(m.name):
                    large = content and m.size > LARGEST
                    data = tar.extractfile(m).read() if content and not large else None
                    yield path, k, m.name, m.size, data, f"a member of {m.size} bytes" if large else None
    except UNREADABLE as e:
        yield path, -1, None, None, None, f"{type(e).__name__}: {e}"[:200]


def batches(rows: Iterator[tuple], schema: T.StructType, payload: int | None, names: list[str] | None = None, most_bytes: int = 16_000_000, most_rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Arrow batches of rows (the columns names of schema), emitted by bytes of the column at payload."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kinds, pick = to_arrow_schema(schema), [schema.names.index(n) for n in names or schema.names]
    held, out = 0, []

    def made() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(columns[i], kinds.field(i).type) for i in pick], [schema.names[i] for i in pick])

    for row in rows:
        out.append(row)
        held += len(row[payload] or b"") if payload is not None else 0
        if held >= most_bytes or len(out) >= most_rows:
            yield made()
            held, out = 0, []
    if out:
        yield made()


def _column(b: pa.RecordBatch, name: str) -> list:
    return b.column(name).to_pylist()


def member_index(tars: DataFrame) -> DataFrame:
    """INDEX rows of all archives at tar_path, read header by header: one pass, and of uncompressed ones without their contents."""
    ship(tars.sparkSession)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches((r for b in parts for p in _column(b, "tar_path") for r in index_rows(p)), INDEX, None)

    return tars.select("tar_path").mapInArrow(run, INDEX)


def whole_members(tars: DataFrame, with_content: bool = True, wanted: Callable[[str], bool] = lambda name: True) -> DataFrame:
    """MEMBERS rows of whole archives at tar_path, one after another within a task.

    Archives in stores that only Spark reaches come as values in the column
    content, which is read for no others; there, one of more than LARGEST bytes
    is a row with an error.
    """
    ship(tars.sparkSession)
    scheme = F.regexp_extract("tar_path", r"^([a-z0-9]+)://", 1)
    own = F.col("tar_path").startswith("/") | F.col("tar_path").startswith("file:") | scheme.isin(*STREAMED)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for b in parts:
                for k, path in enumerate(_column(b, "tar_path")):
                    how = open_file if b.num_columns == 1 else lambda _, b=b, k=k: io.BytesIO(b.column("content")[k].as_py() or b"")
                    yield from read_split(path, None, None, 0, with_content, how, wanted)

        yield from batches(rows(), MEMBERS, 4)

    streamed = tars.select("tar_path").filter(own).mapInArrow(run, MEMBERS)
    other = tars.filter(~own)
    if other.select("tar_path").isEmpty():
        return streamed
    large = F.col("length") > LARGEST if "length" in tars.columns else F.lit(False)
    refused = other.filter(large).select("tar_path", F.lit(-1).alias("member_idx"), *(F.lit(None).cast(t).alias(n) for n, t in (("name", "string"), ("size", "bigint"), ("content", "binary"))), F.lit(f"an archive of more than {LARGEST} bytes in a store that is read by value").alias("error"))
    return streamed.unionByName(other.filter(~large).select("tar_path", "content").mapInArrow(run, MEMBERS)).unionByName(refused)


def splits(index: DataFrame, split_bytes: int = 128 << 20) -> DataFrame:
    """tar_path, start, stop, first and n_members of pieces of about split_bytes; start and stop are null for archives in one piece.

    Unreadable archives have none. Pieces are made of whole members, so that a
    large member makes a large piece.
    """
    piece = F.coalesce(F.floor(F.col("offset") / split_bytes), F.lit(0)).alias("piece")
    grouped = index.filter("member_idx >= 0").groupBy("tar_path", piece).agg(
        F.min("offset").alias("start"), F.max("next_offset").alias("stop"), F.min("member_idx").alias("first"), F.count("*").alias("n_members"))
    return grouped.select("tar_path", "start", "stop", F.when(F.col("start").isNull(), 0).otherwise(F.col("first")).alias("first"), "n_members")


def together(pieces: list[tuple], n_tasks: int, most_bytes: int = 128 << 20) -> list[list[tuple]]:
    """Pieces (tar_path, start, stop, first) in lists of about a task's share of the bytes, in order; archives in one piece stand alone."""
    placed = sorted(x for x in pieces if x[1] is not None)
    share = min(most_bytes, sum(stop - start for _, start, stop, _ in placed) // max(1, n_tasks))
    lists, held = [], 0
    for x in placed:
        size = x[2] - x[1]
        if not lists or held + size > share:
            lists.append([])
            held = 0
        lists[-1].append(x)
        held += size
    return lists + [[x] for x in pieces if x[1] is None]


def split_members(pieces: DataFrame, with_content: bool = True, n_tasks: int | None = None, wanted: Callable[[str], bool] = lambda name: True) -> DataFrame:
    """MEMBERS rows of all pieces, dealt over tasks by place, so that one archive's pieces go to many; of files with other than wanted names nothing is read."""
    ship(pieces.sparkSession)
    names = MEMBERS.names if with_content else [n for n in MEMBERS.names if n != "content"]
    schema = T.StructType([MEMBERS[n] for n in names])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = (x for b in parts for x in zip(*(_column(b, n) for n in ("tar_path", "start", "stop", "first")), strict=True))
        yield from batches((r for x in at for r in read_split(*x, with_content, wanted=wanted)), MEMBERS, 4, names)

    by = ["tar_path", "start"]
    return (pieces.repartition(n_tasks, *by) if n_tasks else pieces.repartition(*by)).mapInArrow(run, schema)


def locate(samples: DataFrame, index: DataFrame, on: str = "id") -> DataFrame:
    """samples (tar_path and a name or path in `on`) with the index columns of the member of that archive and base name.

    Either separator is taken in both names. Members that bear one base name in
    an archive all come back; samples without any come back with a null member_idx.
    """
    places = index.filter("member_idx >= 0").select("tar_path", X.basename("name").alias("__base"), "member_idx", "name", "size", "data_offset")
    return samples.withColumn("__base", X.basename(on)).join(places, ["tar_path", "__base"], "left").drop("__base")


#: So many archives a task keeps open at once.
MOST_OPEN = 16


class _Archive:
    """An open archive whose members are read by place, or, without one, by going on through it."""

    def __init__(self, path: str, opened: Callable):
        self.file, self.members = opened(path), None
        self.last: tuple[int, bytes | None] = (-1, None)

    def read(self, member_idx: int, size: int, at: int | None) -> tuple[bytes | None, str | None]:
        if size > LARGEST:
            return None, f"a member of {size} bytes"
        if at is None:
            if self.members is None or member_idx < self.last[0]:
                self.file.seek(0)
                self.members, self.last = enumerate(walk(self.file)), (-1, None)
            if member_idx != self.last[0]:
                tar, m = next(x for k, x in self.members if k == member_idx)
                self.last = (member_idx, tar.extractfile(m).read())
            return self.last[1], None
        self.file.seek(at)
        data = b""
        while len(data) < size and (more := self.file.read(size - len(data))):
            data += more
        return (data, None) if len(data) == size else (None, "unexpected end of data")


def _ranges(rows: Iterator[tuple], opened: Callable = open_file) -> Iterator[tuple[bytes | None, str | None]]:
    """Content and error of each (tar_path, member_idx, size, data_offset); rows of one archive are best together and in its order."""
    held: dict[str, _Archive] = {}
    try:
        for tar_path, member_idx, size, at in rows:
            if member_idx is None:
                yield None, "no such member"
                continue
            try:
                if tar_path not in held:
                    if len(held) >= MOST_OPEN:
                        held.pop(next(iter(held))).file.close()
                    held[tar_path] = _Archive(tar_path, opened)
                found = held[tar_path].read(member_idx, size, at)
            except (*UNREADABLE, StopIteration) as e:
                if tar_path in held:
                    held.pop(tar_path).file.close()
                found = None, f"{type(e).__name__}: {e}"[:200]
            yield found
    finally:
        for a in held.values():
            a.file.close()


def fetch_in_place(located: DataFrame) -> DataFrame:
    """As fetch, but rows are read in the order and by the tasks in which they are.

    Members without a data_offset have to come in the order of their archive.
    """
    ship(located.sparkSession)
    own = [c for c in located.columns if c not in ("content", "error")]
    schema = T.StructType([*(located.schema[c] for c in own), MEMBERS["content"], MEMBERS["error"]])
    keys = ("tar_path", "member_idx", "size", "data_offset")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            found = _ranges(zip(*(_column(b, n) for n in keys), strict=True))
            first, held, got = 0, 0, []
            for k, x in enumerate(found):
                got.append(x)
                held += len(x[0] or b"")
                if held >= 16_000_000 or k == b.num_rows - 1:
                    part = b.slice(first, k + 1 - first)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array([g[0] for g in got], pa.binary()), pa.array([g[1] for g in got], pa.string())], schema.names)
                    first, held, got = k + 1, 0, []

    return located.select(*own).mapInArrow(run, schema)


def fetch(located: DataFrame) -> DataFrame:
    """located rows (tar_path, member_idx, size, data_offset and any others) with content and error.

    Only the bytes of these members are read. Rows are dealt by ranges of archive
    and place: a task opens an archive once, and one archive that most rows want
    is spread over tasks. A missing or unreadable member has an error and no content.
    """
    order = [F.col("tar_path"), F.col("member_idx")]
    return fetch_in_place(located.repartitionByRange(*order).sortWithinPartitions(*order))


class ArchiveSource(DataSource):
    """spark.read.format("tar").load(path): MEMBERS rows of archives.

    The schema asked for decides what is read: without `content` no member's
    bytes are. Option splits names a written table of `splits`, from which large
    archives are read by many tasks; without it every archive below path is one task.
    Small pieces are read together, one after another, so that they make about `tasks`
    (option, 256) tasks and not one each; no task is given more than 128 MB by this.
    """

    @classmethod
    def name(cls) -> str:
        return "tar"

    def schema(self) -> T.StructType:
        return MEMBERS

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return ArchiveReader(dict(self.options), schema)


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: T.StructType):
        unknown = set(schema.names) - set(MEMBERS.names)
        if unknown:
            raise ValueError(f"archives have no columns {sorted(unknown)}")
        self.options, self.names = options, schema.names

    def partitions(self) -> list[InputPartition]:
        if "splits" not in self.options:
            return [InputPartition([(p, None, None, 0)]) for p in files_below(self.options["path"], lambda name: ".tar" in name)]
        import pyarrow.dataset as ds

        table = self.options["splits"]
        files = [file_system(p)[1] for p in files_below(table, lambda name: name.endswith(".parquet"))]
        at = ds.dataset(files, filesystem=file_system(table)[0]).to_table(columns=["tar_path", "start", "stop", "first"]).to_pylist() if files else []
        return [InputPartition(pieces) for pieces in together([tuple(r.values()) for r in at], int(self.options.get("tasks", 256)))]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        yield from batches((r for piece in partition.value for r in read_split(*piece, "content" in self.names)), MEMBERS, 4, self.names)


def register(spark: SparkSession) -> None:
    """Makes the format "tar" known to the session."""
    ship(spark)
    spark.dataSource.register(ArchiveSource)
