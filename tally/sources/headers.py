"""Headers of part files by a data source: one task for a group of files, the first block of each file read.

The bytes read do not depend on the sizes of the files.  Folders are reached with ``pyarrow.fs``.
"""

from __future__ import annotations

import csv
import fnmatch
import re
import sys

from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tally.sinks.partfiles import file_system

# executors need no copy of this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_BYTES = 16 << 10
FILES_PER_TASK = 256
HEADER_SCHEMA = "_part_file string, _part_size long, columns array<string>, bytes_read long"


class Group(InputPartition):
    def __init__(self, files: list[tuple[str, str, int]]):
        self.files = files


def first_line(stream) -> tuple[str, int]:
    """(the first line without BOM and line end, bytes read)."""
    held = b""
    while b"\n" not in held:
        block = stream.read(BLOCK_BYTES)
        if not block:
            break
        held += block
    return held.split(b"\n")[0].decode("utf-8-sig", errors="replace").removesuffix("\r"), len(held)


class PartHeaders(DataSource):
    """Source ``tally_part_headers``; options: path, glob, excluded (a pattern on paths below the folder)."""

    @classmethod
    def name(cls) -> str:
        return "tally_part_headers"

    def schema(self) -> str:
        return HEADER_SCHEMA

    def reader(self, schema) -> HeaderReader:
        return HeaderReader(self.options["path"], self.options.get("glob", "*.csv"), self.options.get("excluded", "(?!)"))


class HeaderReader(DataSourceReader):
    def __init__(self, path: str, glob: str, excluded: str):
        self.path, self.glob, self.excluded = path, glob, excluded

    def partitions(self) -> list[Group]:
        files, folder = file_system(self.path)
        prefix = "file://" if isinstance(files, pafs.LocalFileSystem) else self.path[:self.path.index(":")] + "://"
        root = folder.rstrip("/")
        found = []
        for info in files.get_file_info(pafs.FileSelector(folder, recursive=True, allow_not_found=True)):
            below = info.path[len(root) + 1:]
            hidden = any(x[0] in "._" for x in below.split("/") if "=" not in x)
            if info.is_file and not hidden and fnmatch.fnmatch(info.base_name, self.glob) and not re.search(self.excluded, below):
                found.append((info.path, prefix + info.path, info.size))
        found.sort()
        return [Group(found[i:i + FILES_PER_TASK]) for i in range(0, max(len(found), 1), FILES_PER_TASK)]

    def read(self, partition: Group):
        files, _ = file_system(self.path)
        for path, uri, size in partition.files:
            with files.open_input_stream(path) as stream:
                line, n = first_line(stream)
            if line:
                yield uri, size, next(csv.reader([line])), n
