"""Part files with flat names, by a data source writer: ``<folder>/<file name>.csv``, one file per part.

Rows come as (file_name, line), sorted by file within a task, each file in one task.  A task writes a part under
a name of its own and renames it when it is whole, in a staging folder beside the target; the job's commit renames
the staging folder.  So a killed task leaves no partial part, a second attempt writes the same names again,
and a failed job leaves the target as it was.  Folders are reached with ``pyarrow.fs`` (local, HDFS, S3, GCS).

Compressed files have sizes that nobody knows before they are written.  With a limit, the task that wrote a file
over it divides the file's rows again, at ``fill`` of the limit, measures those files, and so on down to single rows.
"""

from __future__ import annotations

import os
import sys
import uuid
from array import array
from dataclasses import dataclass

from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

# executors need no copy of this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PART_SCHEMA = "file_name string, line string"
STAGING = "_staging-"
SUFFIX = {"": ".csv", "gzip": ".csv.gz", "bz2": ".csv.bz2"}


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """(file system, path within it) of a URI or a local path."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if path.startswith("/"):
        return pafs.LocalFileSystem(), os.path.normpath(path)
    return pafs.FileSystem.from_uri(path)


def pieces(rows: int, size: int, limit: float, fill: float) -> list[int]:
    """Rows of the files that ``rows`` rows of a file of ``size`` bytes, over the limit, are dealt into."""
    wanted = min(rows, max(2, -(-size // max(1, int(limit * fill)))))
    k = -(-rows // wanted)
    return [min(k, rows - i) for i in range(0, rows, k)]


@dataclass
class PartsWritten(WriterCommitMessage):
    files: int
    size: int


class PartFiles(DataSource):
    """Sink ``tally_parts``; options: path, header (the first line, written as it is), compression ('', gzip or bz2),
    limit (bytes of a written file, 0 for none) and fill (share of the limit that a file over it is divided by)."""

    @classmethod
    def name(cls) -> str:
        return "tally_parts"

    def schema(self) -> str:
        return PART_SCHEMA

    def writer(self, schema, overwrite: bool) -> PartWriter:
        o = self.options
        return PartWriter(o["path"], o.get("header", ""), overwrite, o.get("compression", ""), float(o.get("limit", 0)),
                          float(o.get("fill", 1)))


class PartWriter(DataSourceArrowWriter):
    def __init__(self, path: str, header: str, overwrite: bool, compression: str = "", limit: float = 0, fill: float = 1):
        self.path, self.header, self.overwrite = path.rstrip("/"), header, overwrite
        self.compression, self.limit, self.fill, self.suffix = compression or None, limit, fill, SUFFIX[compression]
        self.staging = f"{os.path.dirname(self.path)}/{STAGING}{uuid.uuid4().hex}"
        files, target = file_system(self.path)
        if not overwrite and files.get_file_info(target).type != pafs.FileType.NotFound:
            raise FileExistsError(f"{self.path} exists")
        files.create_dir(file_system(self.staging)[1], recursive=True)      # here, so that no late task makes it again

    def write(self, iterator) -> PartsWritten:
        files, staging = file_system(self.staging)
        name, own, out, n, size = None, None, None, 0, 0
        lengths = array("q")                                # bytes of each row of the open file

        def start() -> tuple:
            own = f"{staging}/.{uuid.uuid4().hex}"
            out = files.open_output_stream(own, compression=self.compression)
            out.write(self.header.encode())
            return own, out

        def publish(own: str, name: str, lengths: array):
            nonlocal n, size
            written = files.get_file_info(own).size
            if self.limit and written > self.limit and len(lengths) > 1:
                with files.open_input_stream(own, compression=self.compression) as back:
                    back.read(len(self.header.encode()))
                    at = 0
                    for j, rows in enumerate(pieces(len(lengths), written, self.limit, self.fill), 1):
                        share = lengths[at:at + rows]
                        piece, out = start()
                        for x in share:
                            out.write(back.read(x))
                        out.close()
                        publish(piece, f"{name}_parte{j}", share)
                        at += rows
                files.delete_file(own)
                return
            files.move(own, f"{staging}/{name}{self.suffix}")
            n, size = n + 1, size + written

        for batch in iterator:
            names, lines = batch.column(0), batch.column(1)
            p = 0
            while p < batch.num_rows:
                key = names[p].as_py()
                if "/" in key:
                    raise ValueError(f"a part's name is a plain file name: {key!r}")
                q = p + 1
                while q < batch.num_rows and names[q].as_py() == key:
                    q += 1
                if key != name:
                    if out is not None:
                        out.close()
                        publish(own, name, lengths)
                    name, lengths = key, array("q")
                    own, out = start()
                rows = [f"{x}\n".encode() for x in lines.slice(p, q - p).to_pylist()]
                if self.limit:
                    lengths.extend(map(len, rows))
                out.write(b"".join(rows))
                p = q
        if out is not None:
            out.close()
            publish(own, name, lengths)
        return PartsWritten(n, size)

    def commit(self, messages) -> None:
        files, target = file_system(self.path)
        _, staging = file_system(self.staging)
        for info in files.get_file_info(pafs.FileSelector(staging)):
            if info.base_name.startswith("."):              # of attempts that were killed
                files.delete_file(info.path)
        old = f"{staging}-old"
        if files.get_file_info(target).type != pafs.FileType.NotFound:
            files.move(target, old)
        files.move(staging, target)
        if files.get_file_info(old).type != pafs.FileType.NotFound:
            files.delete_dir(old)

    def abort(self, messages) -> None:
        files, staging = file_system(self.staging)
        if files.get_file_info(staging).type != pafs.FileType.NotFound:
            files.delete_dir(staging)


__all__ = ["PartFiles", "PartWriter", "PartsWritten", "file_system"]
