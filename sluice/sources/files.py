"""File sources. Every reader yields the chunk columns

``chunk_id, content, data_type, language, source, row_number, json_path``
"""

from __future__ import annotations

import csv
import hashlib
import io
from collections.abc import Iterator
from functools import reduce
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.functions.language import language_tag
from sluice.functions.text import BLANKS, strip
from sluice.session import durable

EXTENSIONS = {
    "text": ["txt", "text"],
    "markdown": ["md", "markdown"],
    "csv": ["csv"],
    "json": ["json"],
}
# Files of this many bytes are read in pieces of about so many.
LONG_FILE, PIECE = 4 << 20, 1 << 20
SOURCE_FIELDS = ["file_path", "file_name", "file_size", "file_type", "encoding", "hash_value", "modified_at"]


def formats() -> list[str]:
    """Accepted file extensions."""
    return [e for group in EXTENSIONS.values() for e in group]


def _glob(kinds: list[str]) -> str:
    # Both cases of each letter, as the extension check ignores case.
    either = lambda e: "".join(f"[{c.lower()}{c.upper()}]" for c in e)
    return "*.{" + ",".join(either(e) for e in kinds) + "}"


def _files(spark: SparkSession, path: str | list[str], extensions: list[str], recursive: bool) -> DataFrame:
    reader = spark.read.format("binaryFile").option("pathGlobFilter", _glob(extensions))
    return reader.option("recursiveFileLookup", str(recursive).lower()).load(path)


def decode_bytes(content: Column) -> Column:
    """UTF-8 if valid, else GBK if valid, else Latin-1. Only bytes that are not UTF-8 go to Python."""
    text = content.cast("string")
    odd = _other_charset()(F.when(~F.is_valid_utf8(text), content))
    return F.when(F.is_valid_utf8(text), text).otherwise(odd["text"])


def charset_of(content: Column) -> Column:
    """The charset by which ``decode_bytes`` reads the bytes."""
    text = content.cast("string")
    odd = _other_charset()(F.when(~F.is_valid_utf8(text), content))
    return F.when(F.is_valid_utf8(text), "utf-8").otherwise(odd["charset"])


def _read_other(data: bytes) -> tuple[str, str]:
    try:
        return data.decode("gbk"), "gbk"
    except UnicodeDecodeError:
        return data.decode("latin-1"), "latin-1"


def _other_charset():
    @F.pandas_udf("text string, charset string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(None, None) if data is None else _read_other(data) for data in batch]
            yield pd.DataFrame(found, columns=["text", "charset"], dtype="object")

    return decode


def with_source_metadata(df: DataFrame, encoding: Column | None = None, digest: Column | None = None) -> DataFrame:
    """``source`` struct for rows of a binary file scan; ``encoding`` and ``digest`` if the caller knows them."""
    name = F.element_at(F.split("path", "/"), -1)
    return df.withColumn(
        "source",
        F.struct(
            F.col("path").alias("file_path"),
            name.alias("file_name"),
            F.col("length").alias("file_size"),
            F.lower(F.regexp_extract(name, r"(\.[^.]*)\z", 1)).alias("file_type"),
            (charset_of(F.col("content")) if encoding is None else encoding).alias("encoding"),
            (F.md5("content") if digest is None else digest).alias("hash_value"),
            F.col("modificationTime").alias("modified_at"),
        ),
    )


def chunk_id(*parts: Column | str) -> Column:
    """Repeatable id from the place a chunk comes from."""
    return F.sha2(F.concat_ws("|", *parts), 256)


def _chunks(df: DataFrame, kind: str, *extra: str) -> DataFrame:
    keep = {"row_number": "bigint", "json_path": "string"}
    extras = [(F.col(c) if c in extra else F.lit(None)).cast(t).alias(c) for c, t in keep.items()]
    place = [F.col("source.file_path"), F.lit(kind), *[F.col(c).cast("string") for c in extra]]
    return df.select(
        chunk_id(*place).alias("chunk_id"), "content", F.lit(kind).alias("data_type"),
        language_tag(F.col("content")).alias("language"), "source", *extras,
    )


def read_text(spark: SparkSession, path, recursive: bool = True, min_length: int = 10, kind: str = "text") -> DataFrame:
    """One chunk per file with at least ``min_length`` characters.

    Long files are read in pieces that meet in one task each, which holds a
    file's text some four times; a cell, so a file, has 2 GB at most.
    """
    whole = with_source_metadata(_files(spark, path, EXTENSIONS[kind], recursive).filter(F.col("length") < LONG_FILE))
    whole = whole.select("source", strip(decode_bytes(F.col("content"))).alias("content"))
    df = whole.unionByName(_long_texts(spark, path, EXTENSIONS[kind], recursive))
    return _chunks(df.filter(F.length("content") >= min_length), kind)


def _long_texts(spark: SparkSession, path, extensions: list[str], recursive: bool) -> DataFrame:
    """``source`` and stripped ``content`` of the long files, as ``read_text`` has them of others.

    Splits give their lines as compressed pieces. A file's pieces are laid end
    to end in a Python worker, where charset, digest and ends of the text are
    looked at in place: on the way of the other files a text is copied by each
    step, and stripping it takes eight bytes more for each of its bytes.
    """
    reader = spark.read.option("pathGlobFilter", _glob(extensions)).option("recursiveFileLookup", str(recursive).lower())
    at = F.col("_metadata.file_path").alias("at")
    lines = reader.option("lineSep", "\n").text(path).filter(F.col("_metadata.file_size") >= LONG_FILE)
    lines = lines.select(at, F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("line"))
    known = _files(spark, path, extensions, recursive).filter(F.col("length") >= LONG_FILE)
    known = known.select(at, "path", "length", "modificationTime")
    pieces = lines.mapInArrow(_pieces, "at string, block long, number long, piece binary").join(F.broadcast(known), "at")
    dealt = pieces.repartition("path").sortWithinPartitions("path", "block", "number")
    names = ["path", "length", "modificationTime"]
    kinds = ", ".join(f"{c} {dealt.schema[c].dataType.simpleString()}" for c in names)
    texts = dealt.select(*names, "piece").mapInArrow(_joined, f"{kinds}, charset string, digest string, content string")
    return with_source_metadata(texts, F.col("charset"), F.col("digest")).select("source", "content")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of each split, line breaks added, as numbered pieces of zstandard frames."""
    place, number, held = None, 0, bytearray()

    def piece() -> pa.RecordBatch:
        packed = pa.array([zstandard.ZstdCompressor(level=3).compress(held)], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([place[0]]), pa.array([place[1]]), pa.array([number]), packed], names=["at", "block", "number", "piece"])

    for batch in batches:
        n, ends = batch.num_rows, np.cumsum(pc.add(pc.binary_length(batch.column("line")), 1).to_numpy(), dtype=np.int64)
        changes = [pc.not_equal(batch.column(c).slice(1), batch.column(c).slice(0, max(n - 1, 0))) for c in ("at", "block")]
        stops = [*(np.flatnonzero(pc.or_(*changes).to_numpy(zero_copy_only=False)) + 1).tolist(), n]
        begin = 0
        while begin < n:
            here = (batch.column("at")[begin].as_py(), batch.column("block")[begin].as_py())
            if held and (here != place or len(held) >= PIECE):
                yield piece()
                number, held = number + 1 if here == place else 0, bytearray()
            place = here
            # Lines of one split, as many as a piece still takes.
            room = PIECE - len(held) + (ends[begin - 1] if begin else 0)
            stop = min(next(x for x in stops if x > begin), max(begin + 1, int(np.searchsorted(ends, room, side="right"))))
            some = pa.ListArray.from_arrays(pa.array([0, stop - begin], pa.int32()), batch.column("line").slice(begin, stop - begin))
            held += pc.binary_join(some, b"\n")[0].as_buffer()
            held += b"\n"
            begin = stop
    if held:
        yield piece()


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files of pieces in order, a row each: charset, digest of the bytes, text without blanks at its ends."""
    own, data = None, bytearray()
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            if own is not None and row.column("path")[0] != own.column("path")[0]:
                yield _text_row(own, data)
                data = bytearray()
            # The row is kept for its first columns only.
            own = row.select(["path", "length", "modificationTime"])
            data += zstandard.ZstdDecompressor().decompress(row.column("piece")[0].as_buffer())
    if own is not None:
        yield _text_row(own, data)


def _text_row(own: pa.RecordBatch, data: bytearray) -> pa.RecordBatch:
    length = own.column("length")[0].as_py()
    # Lines are read without the mark of UTF-8 at the start of a file, and the last one may have had no line break.
    if length - len(data) in (2, 3):
        data[:0] = b"\xef\xbb\xbf"
    del data[length:]
    digest, charset, size = hashlib.md5(data).hexdigest(), "utf-8", len(data)
    try:
        _string(data, 0, size).validate(full=True)
    except pa.ArrowInvalid:
        text, charset = _read_other(bytes(data))
        data = text.encode()
    start, end = _ends(memoryview(data))
    columns = [*own.columns, pa.array([charset]), pa.array([digest]), _string(data, start, end)]
    return pa.RecordBatch.from_arrays(columns, names=[*own.schema.names, "charset", "digest", "content"])


def _string(data: bytes | bytearray, start: int, end: int) -> pa.StringArray:
    """One cell of the bytes from ``start`` to ``end``, which are not copied."""
    if end - start > 2**31 - 1:
        raise ValueError(f"a text of {end - start} bytes does not fit a cell")
    offsets = pa.array([0, end - start], pa.int32()).buffers()[1]
    return pa.StringArray.from_buffers(1, offsets, pa.py_buffer(memoryview(data)[start:end]))


def _ends(data: memoryview, step: int = 4096) -> tuple[int, int]:
    """Where UTF-8 text begins and ends without the blanks around it."""

    def is_inside(at: int) -> bool:
        return at < len(data) and data[at] & 0xC0 == 0x80

    start, end = 0, len(data)
    while start < end:
        stop = min(start + step, end)
        while is_inside(stop):
            stop += 1
        rest = len(bytes(data[start:stop]).decode().lstrip(BLANKS).encode())
        start = stop - rest
        if rest:
            break
    while end > start:
        begin = max(start, end - step)
        while begin > start and is_inside(begin):
            begin -= 1
        rest = len(bytes(data[begin:end]).decode().rstrip(BLANKS).encode())
        end = begin + rest
        if rest:
            break
    return start, end


def read_markdown(spark: SparkSession, path, recursive: bool = True, min_length: int = 10) -> DataFrame:
    return read_text(spark, path, recursive, min_length, "markdown")


# Cell texts that mean "no value" (fixed values of the usual table reader).
NO_VALUE = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
]


def row_text(columns: list[str]) -> Column:
    """``name: value`` of all cells that hold a value."""

    def cell(name: str) -> Column:
        value = F.col(f"`{name}`").cast("string")
        return F.when(~value.isin(NO_VALUE), F.concat(F.lit(f"{name}: "), value))

    return F.concat_ws(" | ", *[cell(c) for c in columns])


def table_rows(df: DataFrame, id_col: str | None = None) -> DataFrame:
    """Rows of any table as text."""
    columns = [c for c in df.columns if c != id_col]
    out = df.select(*([id_col] if id_col else []), row_text(columns).alias("content"))
    return out.filter(strip(F.col("content")) != "")


def read_csv_rows(spark: SparkSession, path, recursive: bool = True, multi_line: bool = True) -> DataFrame:
    """One chunk per CSV row, cells labelled by the header of their own file.

    All files are read by one scan, however many headers there are; no list of
    files or headers reaches the driver. Quoted line breaks need ``multi_line``,
    which reads a file whole, in one task (2 GB at most, charsets as in
    ``read_text``). Without it files of any size are split at line breaks and
    read as UTF-8. Blank lines do not count as rows, cells beyond the header have
    no label and are left out, and rows without a value give no chunk.
    """
    rows = _whole_csv(spark, path, recursive) if multi_line else _split_csv(spark, path, recursive)
    return _chunks(rows.filter(strip(F.col("content")) != ""), "csv", "row_number")


def _whole_csv(spark: SparkSession, path, recursive: bool) -> DataFrame:
    df = with_source_metadata(_files(spark, path, EXTENSIONS["csv"], recursive))
    df = df.select("source", decode_bytes(F.col("content")).alias("text"))
    empty, most, names = frozenset(NO_VALUE), 10_000, ["source", "content", "row_number"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(2**31 - 1)
        for batch in batches:
            for at, text in enumerate(batch.column("text")):
                rows = (r for r in csv.reader(io.StringIO((text.as_py() or "").removeprefix("\ufeff"), newline="")) if r)
                header = [name or f"_c{i}" for i, name in enumerate(next(rows, []))]
                start = 0
                while some := list(islice(rows, most)):
                    found = [" | ".join(f"{n}: {c}" for n, c in zip(header, row) if c not in empty) for row in some]
                    numbers = pa.array(range(start, start + len(some)), pa.int64())
                    source = batch.column("source").take(pa.array([at] * len(some)))
                    yield pa.RecordBatch.from_arrays([source, pa.array(found, pa.string()), numbers], names=names)
                    start += len(some)

    return df.mapInArrow(run, f"source {df.schema['source'].dataType.simpleString()}, content string, row_number long")


def csv_cells(line: Column) -> Column:
    """Cells of a CSV line without line breaks inside; doubled quotes stand for one."""
    cells = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(r',("(?:[^"]|"")*"|[^,]*)'), F.lit(1))
    return F.transform(
        cells, lambda c: F.when(c.startswith('"'), F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c)
    )


def _split_csv(spark: SparkSession, path, recursive: bool) -> DataFrame:
    reader = spark.read.option("pathGlobFilter", _glob(EXTENSIONS["csv"])).option("recursiveFileLookup", str(recursive).lower())
    meta = F.col("_metadata")
    lines = reader.text(path).filter(F.trim("value") != "").select(
        "value", meta["file_path"].alias("file_path"), meta["file_name"].alias("file_name"), meta["file_size"].alias("file_size"),
        meta["file_modification_time"].alias("modified_at"), meta["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("at"),
    )
    # A row for each split: where its lines start in the file, and the header, which is the file's first line.
    splits = lines.groupBy("file_path", "block").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"), F.min_by("value", "at").alias("top"))
    so_far = Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    header = F.transform(csv_cells(F.first("top").over(so_far)), lambda name, i: F.when(name == "", F.concat(F.lit("_c"), i)).otherwise(name))
    splits = splits.select("file_path", "block", "first", (F.sum("n").over(so_far) - F.col("n")).alias("before"), header.alias("header"))
    rows = lines.join(splits, ["file_path", "block"])
    number = F.col("at") - F.col("first") + F.col("before") - 1

    def cell(pair: Column) -> Column:
        return F.when(~pair["value"].isin(NO_VALUE) & pair["name"].isNotNull(), F.concat(pair["name"], F.lit(": "), pair["value"]))

    pairs = F.arrays_zip(F.col("header").alias("name"), csv_cells(F.col("value")).alias("value"))
    source = F.struct(
        "file_path", "file_name", "file_size", F.lit(".csv").alias("file_type"), F.lit("utf-8").alias("encoding"),
        F.lit(None).cast("string").alias("hash_value"), "modified_at",
    )
    return rows.select(source.alias("source"), F.concat_ws(" | ", F.transform(pairs, cell)).alias("content"), number.alias("row_number")).filter("row_number >= 0")


def json_leaves(df: DataFrame, json_col: str, min_length: int = 10) -> DataFrame:
    """One row per string leaf of a JSON document, with its path ``a.b[0].c``.

    A round opens the objects and arrays of one level and keeps what is open
    still, as a stored table; rounds end with the deepest document, and a leaf
    takes part in one only. No schema is needed. Documents that do not parse
    give no rows here; ``unparsed_json`` has them.
    """
    spark = df.sparkSession
    others = [c for c in df.columns if c != json_col]
    level = df.select(*others, F.try_parse_json(json_col).alias("v"), F.lit("").alias("json_path"))
    kind = F.schema_of_variant("v")
    is_open = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    found = []
    while True:
        leaves = level.filter(kind == "STRING").select(*others, "json_path", strip(F.col("v").cast("string")).alias("content"))
        found.append(leaves.filter(F.length("content") >= min_length))
        inner = level.filter(is_open).lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
        path = (
            F.when(F.col("key").isNull(), F.concat("json_path", F.lit("["), F.col("pos").cast("string"), F.lit("]")))
            .when(F.col("json_path") == "", F.col("key"))
            .otherwise(F.concat_ws(".", "json_path", "key"))
        )
        level = durable(inner.select(*others, F.col("value").alias("v"), path.alias("json_path")).filter(is_open | (kind == "STRING")))
        if level.isEmpty():
            return reduce(DataFrame.unionByName, found)


def unparsed_json(df: DataFrame, json_col: str) -> DataFrame:
    """The rows whose document is not JSON."""
    return df.filter(F.col(json_col).isNotNull() & F.try_parse_json(json_col).isNull())


def read_json_leaves(spark: SparkSession, path, recursive: bool = True, min_length: int = 10) -> DataFrame:
    df = with_source_metadata(_files(spark, path, EXTENSIONS["json"], recursive))
    df = df.select("source", decode_bytes(F.col("content")).alias("_json"))
    return _chunks(json_leaves(df, "_json", min_length), "json", "json_path")


def read_records(spark: SparkSession, path, schema=None, fmt: str | None = None) -> DataFrame:
    """A recipe's input table from ``json`` (one array) or ``jsonl``."""
    first = path if isinstance(path, str) else path[0]
    fmt = fmt or ("json" if first.endswith(".json") else "jsonl")
    reader = spark.read.option("multiLine", str(fmt == "json").lower())
    return (reader.schema(schema) if schema else reader).json(path)


def read_directory(spark: SparkSession, path: str, recursive: bool = True, kinds: list[str] | None = None) -> DataFrame:
    """All accepted files below a folder as chunks; error if there is none."""
    readers = {"text": read_text, "markdown": read_markdown, "csv": read_csv_rows, "json": read_json_leaves}
    kinds = kinds or list(readers)
    every = [e for k in kinds for e in EXTENSIONS[k]]
    if _files(spark, path, every, recursive).select("path").isEmpty():
        raise ValueError(f"no files to read below {path}")
    present = [k for k in kinds if not _files(spark, path, EXTENSIONS[k], recursive).select("path").isEmpty()]
    return reduce(DataFrame.unionByName, [readers[k](spark, path, recursive) for k in present])


def table_to_text(cells: Column) -> Column:
    """Rows joined by `` | ``, null cells empty, blank rows dropped."""
    rows = F.transform(cells, lambda r: F.array_join(r, " | ", ""))
    return F.array_join(F.filter(rows, lambda s: strip(s) != ""), "\n")
