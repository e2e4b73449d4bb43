"""Camera make and original date of JPEG images.

One parser, three ways in:

* ``spark.read.format("exif").load(folder)`` after ``register(spark)``: the folder is
  listed once, the list split over tasks;
* ``exif_scan``: Spark lists the files, of any storage it can read;
* ``exif_from_content``: images already held in a column.

Files are opened by tasks through Arrow's file systems (local, S3, GCS, HDFS). The
parser walks the segments of a file up to the image data, skipping those it does
not need, so it reads little of a large image, however long the part in front of
the EXIF block. A file that cannot be opened fails the job.
"""

from __future__ import annotations

import io
import struct
import sys
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tallyworks.schemas import EXIF

# Fixed values of the JPEG, TIFF and EXIF formats.
APP1 = 0xE1
START_OF_IMAGE = b"\xff\xd8"
START_OF_SCAN, END_OF_IMAGE = 0xDA, 0xD9
#: Markers that stand alone, without a length: TEM and the restart markers.
ALONE = frozenset([0x01, *range(0xD0, 0xD8)])
TAG_MAKE = 271
TAG_EXIF_FOLDER = 34665
TAG_DATE_TIME_ORIGINAL = 36867
TYPE_ASCII = 2


def parse_header(data: bytes) -> tuple[str | None, str | None]:
    """(camera make, original date) of a JPEG held in memory."""
    return parse_stream(io.BytesIO(data))


def parse_stream(image: BinaryIO) -> tuple[str | None, str | None]:
    """(camera make, original date) of an open JPEG; None where absent or malformed."""
    try:
        tiff = _exif_block(image)
        if tiff is None:
            return None, None
        order = {b"II": "<", b"MM": ">"}[tiff[:2]]
        main = _entries(tiff, order, struct.unpack_from(order + "I", tiff, 4)[0])
        make = _text(tiff, order, main.get(TAG_MAKE))
        taken = None
        if TAG_EXIF_FOLDER in main:
            at = struct.unpack(order + "I", main[TAG_EXIF_FOLDER][2])[0]
            taken = _text(tiff, order, _entries(tiff, order, at).get(TAG_DATE_TIME_ORIGINAL))
        return make, taken
    except (struct.error, KeyError, IndexError):
        return None, None


def _exif_block(image: BinaryIO) -> bytes | None:
    """The TIFF part of the first EXIF segment before the image data."""
    if image.read(2) != START_OF_IMAGE:
        return None
    while True:
        if image.read(1) != b"\xff":
            return None
        code = image.read(1)
        while code == b"\xff":  # fill bytes may stand before any marker
            code = image.read(1)
        if not code or code[0] in (START_OF_SCAN, END_OF_IMAGE):
            return None
        if code[0] in ALONE:
            continue
        size = struct.unpack(">H", image.read(2))[0] - 2
        if code[0] == APP1:
            segment = image.read(size)
            if segment[:6] == b"Exif\0\0":
                return segment[6:]
        else:
            image.seek(size, io.SEEK_CUR)


def _entries(tiff: bytes, order: str, at: int) -> dict[int, tuple[int, int, bytes]]:
    count = struct.unpack_from(order + "H", tiff, at)[0]
    found = {}
    for i in range(count):
        tag, kind, length, value = struct.unpack_from(order + "HHI4s", tiff, at + 2 + 12 * i)
        found[tag] = (kind, length, value)
    return found


def _text(tiff: bytes, order: str, entry: tuple[int, int, bytes] | None) -> str | None:
    if entry is None or entry[0] != TYPE_ASCII:
        return None
    kind, length, value = entry
    if length > 4:
        at = struct.unpack(order + "I", value)[0]
        value = tiff[at : at + length]
    return value[:length].split(b"\0")[0].decode("ascii", "replace")


def exif_from_content(df: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """EXIF fields of images held in a binary column; a null image has none."""
    images = df.select(F.col(path).alias("image_path"), F.col(content).alias("content"))
    return images.mapInPandas(_parse_batches, EXIF)


def exif_scan(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """EXIF fields of every file under ``path``; Spark lists the files without reading them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(path)
    return files.select("path").mapInPandas(_read_batches, EXIF)


def write_images(images: DataFrame, folder: str, path: str = "path", content: str = "content") -> None:
    """One file per row below ``folder``, written by tasks; a task run again writes the same."""

    def write(rows: Iterator[Row]) -> None:
        for row in rows:
            system, place = _opened(f"{folder}/{row[0]}")
            system.create_dir(place.rsplit("/", 1)[0], recursive=True)
            with system.open_output_stream(place) as file:
                file.write(bytes(row[1]))

    images.select(path, content).foreachPartition(write)


def _opened(path: str):
    """Arrow's file system for a path or address, and the path in it."""
    from pyarrow import fs

    # Spark writes local paths as file:/x, Arrow wants file:///x.
    if path.startswith("file:/") and not path.startswith("file://"):
        path = path.replace("file:/", "file:///", 1)
    return fs.FileSystem.from_uri(path)


def _parsed_file(path: str) -> tuple[str | None, str | None]:
    system, inner = _opened(path)
    with system.open_input_file(inner) as image:
        return parse_stream(image)


def _parse_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        parsed = [(None, None) if c is None else parse_header(bytes(c)) for c in batch["content"]]
        yield _rows(batch["image_path"], parsed)


def _read_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield _rows(batch["path"], [_parsed_file(path) for path in batch["path"]])


def _rows(paths: pd.Series, parsed: list[tuple[str | None, str | None]]) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "image_path": paths,
            "camera_make": [make for make, _ in parsed],
            "date_time_original": [taken for _, taken in parsed],
        }
    )


class Share(InputPartition):
    """One task's share of the files."""

    def __init__(self, paths: list[str]):
        self.paths = paths


class ExifReader(DataSourceReader):
    def __init__(self, folder: str, tasks: int, recursive: bool):
        self.folder, self.tasks, self.recursive = folder, tasks, recursive

    def partitions(self) -> list[InputPartition]:
        """Lists the folder, once, and deals its files out."""
        from pyarrow import fs

        system, inner = _opened(self.folder)
        listed = system.get_file_info(fs.FileSelector(inner, recursive=self.recursive))
        scheme = self.folder.partition(":")[0] if ":" in self.folder else "file"
        lead = "" if scheme == "file" else f"{scheme}://"
        paths = sorted(lead + info.path for info in listed if info.type == fs.FileType.File)
        shares = [paths[index :: self.tasks] for index in range(self.tasks)]
        return [Share(share) for share in shares if share] or [Share([])]

    def read(self, partition: Share) -> Iterator[tuple]:
        for path in partition.paths:
            yield (path, *_parsed_file(path))


class ExifSource(DataSource):
    """``format("exif")``: the folder to load, ``tasks`` to spread it over, ``recursive``."""

    @classmethod
    def name(cls) -> str:
        return "exif"

    def schema(self) -> str:
        return EXIF

    def reader(self, schema) -> ExifReader:
        recursive = self.options.get("recursive", "false").lower() == "true"
        return ExifReader(self.options["path"], int(self.options.get("tasks", "32")), recursive)


# Workers get the functions above by value, wherever this package is installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def register(spark: SparkSession) -> None:
    """Make ``format("exif")`` known to the session."""
    spark.dataSource.register(ExifSource)
