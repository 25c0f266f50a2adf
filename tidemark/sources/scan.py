"""Reading delimited files: the built-in reader for clean ones, and a record reader for all that it would hide."""

from __future__ import annotations

import codecs
import csv
import io
import zipfile
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .detect import SAMPLE_BYTES, SourceError, detect_dialect, detect_encoding, detect_header, require_delimiter

#: A field larger than this, and a file that unpacks to more, are errors.
FIELD_LIMIT, UNPACKED_LIMIT = 1 << 20, 512 << 20
MAX_PARTS = 50
#: Bytes of a file that are unpacked at a time.
PIECE = 1 << 20
RECORD_SCHEMA = "path string, ordinal long, fields array<string>, error string"


@dataclass(frozen=True)
class CsvOptions:
    """None: found out from each file's sample."""

    delimiter: str | None = None
    quote: str | None = None
    encoding: str | None = None
    header_index: int | None = None
    unpacked_limit: int = UNPACKED_LIMIT
    field_limit: int = FIELD_LIMIT


def unpacked(name: str, raw: bytes, limit: int = UNPACKED_LIMIT) -> Iterator[bytes]:
    """Contents of a plain, .gz or .zip file, by its extension, piece by piece; a zip file has one member."""
    low, size = name.lower(), 0
    pieces = _gunzipped(raw) if low.endswith(".gz") else _unzipped(raw) if low.endswith(".zip") else (raw[k : k + PIECE] for k in range(0, len(raw), PIECE))
    for piece in pieces:
        size += len(piece)
        if size > limit and low.endswith((".gz", ".zip")):
            raise SourceError("decompression-bomb-exceeded")
        yield piece


def _gunzipped(raw: bytes) -> Iterator[bytes]:
    rest = raw
    while rest:
        member = zlib.decompressobj(31)
        while not member.eof:
            try:
                piece = member.decompress(rest, PIECE)
            except zlib.error as e:
                raise SourceError("corrupted-archive", str(e)) from e
            if not piece and not member.unconsumed_tail and not member.eof:
                raise SourceError("corrupted-archive", "cut short")
            yield piece
            rest = member.unconsumed_tail
        rest = member.unused_data.lstrip(b"\0")


def _unzipped(raw: bytes) -> Iterator[bytes]:
    try:
        with zipfile.ZipFile(io.BytesIO(raw)) as z:
            members = [m for m in z.infolist() if not m.is_dir()]
            if len(members) != 1:
                raise SourceError("archive-member-count", str(len(members)))
            with z.open(members[0]) as f:
                while piece := f.read(PIECE):
                    yield piece
    except (zipfile.BadZipFile, zlib.error, NotImplementedError, RuntimeError) as e:
        raise SourceError("corrupted-archive", str(e)) from e


def unpack(name: str, raw: bytes, limit: int = UNPACKED_LIMIT) -> bytes:
    return b"".join(unpacked(name, raw, limit))


class _Stream(io.RawIOBase):
    """Pieces of bytes as a file."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.rest = pieces, b""

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while not self.rest:
            if (piece := next(self.pieces, None)) is None:
                return 0
            self.rest = piece
        n = min(len(buffer), len(self.rest))
        buffer[:n], self.rest = self.rest[:n], self.rest[n:]
        return n


def _lines(pieces: Iterator[bytes], encoding: str) -> Iterator[str]:
    with io.TextIOWrapper(io.BufferedReader(_Stream(pieces), PIECE), encoding, newline="") as text:
        first = True
        for line in text:
            line = line.replace("\0", "")
            yield line.removeprefix("\ufeff") if first else line
            first = False


def _check(pieces: Iterator[bytes], encoding: str) -> None:
    """Decodes all, strictly, and keeps nothing; an error must show before the first record does."""
    try:
        decoder, any_ = codecs.getincrementaldecoder(encoding)("strict"), False
        for piece in pieces:
            any_ |= bool(decoder.decode(piece).strip("\0\ufeff"))
        any_ |= bool(decoder.decode(b"", True).strip("\0\ufeff"))
    except (UnicodeDecodeError, LookupError) as e:
        raise SourceError("undecodable-bytes", str(e)) from e
    if not any_:
        raise SourceError("empty-file")


def records(open_: Callable[[], Iterator[bytes]], options: CsvOptions) -> Iterator[tuple[int, list[str], str | None]]:
    """(ordinal, fields, error) of every record after the header; the header itself comes first as ordinal 0.

    open_ starts the file's pieces anew: it is gone through once for its sample, once to be checked, and once for its records,
    of which one is held at a time. Blank lines are records without fields, so that what is read adds up. A file that can't be
    read gives one record with ordinal -1 and the error; only what the CSV reader itself refuses comes after good records.
    """
    try:
        sample = b""
        for piece in open_():
            sample += piece
            if len(sample) >= SAMPLE_BYTES:
                break
        sample = sample[:SAMPLE_BYTES]
        encoding = options.encoding or (detect_encoding(sample).name if sample else "utf-8")
        if encoding == "undetermined":
            raise SourceError("undetermined-encoding", "name one in the contract")
        _check(open_(), encoding)
        text = codecs.getincrementaldecoder(encoding)("strict").decode(sample).removeprefix("\ufeff").replace("\0", "")
        dialect = detect_dialect(text, options.delimiter, options.quote)
        delimiter = require_delimiter(dialect.delimiter)
        csv.field_size_limit(options.field_limit)
        read = lambda lines: csv.reader(lines, delimiter=delimiter, quotechar=dialect.quote, doublequote=True, strict=False)
        head = [r for _, r in zip(range(50), read(io.StringIO(text, newline="")), strict=False)]
        header = detect_header(head, options.header_index)
        width, ordinal = len(header.names), 0
        yield 0, list(header.names), None
        for k, row in enumerate(read(_lines(open_(), encoding))):
            if k > header.index:
                ordinal += 1
                yield ordinal, row, None if len(row) == width else "RAGGED_ROW"
    except SourceError as e:
        yield -1, [], str(e)
    except csv.Error as e:
        yield -1, [], f"csv-error: {e}"


def _frames(rows: Iterator[tuple], size: int = 10_000) -> Iterator[pd.DataFrame]:
    while part := list(islice(rows, size)):
        yield pd.DataFrame(part, columns=["path", "ordinal", "fields", "error"])


def scan(spark: SparkSession, path: str | Sequence[str], options: CsvOptions = CsvOptions(), glob: str | None = None) -> DataFrame:
    """Records of all files: path, ordinal from 1, fields, and error for rows not as wide as the header, which is ordinal 0.

    Spark's reader leaves out files of no bytes, which the integrity gate rejects. A file is read by one task, as quoted line ends and archives can't be split; many files spread over many tasks.
    """
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load([path] if isinstance(path, str) else list(path)).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, raw in zip(batch["path"], batch["content"], strict=True):
                yield from _frames((name, *r) for r in records(lambda name=name, raw=raw: unpacked(name, raw, options.unpacked_limit), options))

    return files.mapInPandas(run, RECORD_SCHEMA)


def as_columns(found: DataFrame, names: Sequence[str]) -> DataFrame:
    """Good records with named text columns, path and ordinal; fields beyond the names are cut."""
    return found.filter("ordinal > 0 AND error IS NULL").select("path", "ordinal", *(F.get("fields", k).alias(n) for k, n in enumerate(names)))


def resume(found: DataFrame, ordinal: int) -> DataFrame:
    """Records from an ordinal on."""
    return found.filter(F.col("ordinal") >= ordinal)


def read_clean(spark: SparkSession, path: str | Sequence[str], schema: str, delimiter: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """Files known to be regular, by the built-in reader, which splits them. Empty fields are null; short and long rows are kept aside in `_corrupt`."""
    options = {"sep": delimiter, "quote": '"', "escape": '"', "header": True, "encoding": encoding, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "maxCharsPerColumn": FIELD_LIMIT, "columnPruning": False}  # else a query of few columns takes ragged rows for good ones
    read = spark.read.options(**options).schema(f"{schema}, _corrupt string").csv(path if isinstance(path, str) else list(path))
    # Spark refuses queries of _corrupt alone, so this one always asks for another column too.
    return read.withColumn("_corrupt", F.when(F.col("_corrupt").isNotNull(), F.coalesce("_corrupt", F.col(read.columns[0]).cast("string"))))


def concatenated(spark: SparkSession, parts: Sequence[str], options: CsvOptions = CsvOptions()) -> DataFrame:
    """Parts of one file, in order, as one run of records; the first one's header counts, others' lines are all data.

    One task reads them, as a quoted field may go on in the next part; it holds the parts as they are stored, MAX_PARTS at most.
    """
    if len(parts) > MAX_PARTS:
        raise SourceError("too-many-parts", str(len(parts)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = {name: raw for batch in batches for name, raw in zip(batch["path"], batch["content"], strict=True)}
        order = [next(n for n in held if n.endswith(p.rsplit("/", 1)[-1])) for p in parts]
        if order:
            yield from _frames((order[0], *r) for r in records(lambda: (piece for n in order for piece in unpacked(n, held[n], options.unpacked_limit)), options))

    files = spark.read.format("binaryFile").load(list(parts)).select("path", "content").repartition(1)
    return files.mapInPandas(run, RECORD_SCHEMA)
