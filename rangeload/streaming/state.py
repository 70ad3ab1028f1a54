"""Small JSON documents of a load, kept beside its data.

Written under another name and then given their own, which fails if it is taken: a document is
there whole or not at all, and of two loaders that write the same one, one is
refused. Goes through the Hadoop file system, hence to wherever the data lies.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class ConcurrentLoad(RuntimeError):
    """Another loader works on the same root."""


class StateFiles:
    """Numbered documents of a few kinds under one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()
        self._root = root.rstrip("/")

    def path(self, kind: str, number: int) -> str:
        return f"{self._root}/{kind}/{number:06d}.json"

    def _open(self, path: str):
        hadoop_path = self._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path, hadoop_path.getFileSystem(self._conf)

    def write(self, kind: str, number: int, document: dict, replace: bool = False) -> None:
        """A new document; one of the same number is replaced only if asked for, else
        another loader has written it."""
        target, fs = self._open(self.path(kind, number))
        draft, _ = self._open(f"{self._root}/{kind}/.{number:06d}.{uuid.uuid4().hex}.tmp")
        out = fs.create(draft, True)
        try:
            out.write(bytearray(json.dumps(document).encode()))
        finally:
            out.close()
        if replace:
            fs.delete(target, False)
        try:
            self._publish(draft, target, fs)
        except Py4JJavaError as error:
            if not error.java_exception.getClass().getName().endswith("FileAlreadyExistsException"):
                raise
            raise ConcurrentLoad(f"{target.toString()} was written by another loader") from None
        finally:
            fs.delete(draft, False)

    def _publish(self, draft, target, fs) -> None:
        """Give a draft its name, in one step that fails if the name is taken.

        On a local disk a rename would replace the file that has it, and a look beforehand could
        come too early, so the name is made as a second link to the draft. Elsewhere the
        file system itself refuses a rename that is not to overwrite.
        """
        if fs.getUri().getScheme() == "file":
            files = self._jvm.java.nio.file.Files
            one, other = (self._jvm.java.io.File(fs.makeQualified(path).toUri().getPath()).toPath() for path in (target, draft))
            files.createLink(one, other)
            return
        mode = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        modes = self._gateway.new_array(mode, 1)
        modes[0] = getattr(mode, "NONE")
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self._conf)
        context.rename(draft, target, modes)

    def read(self, kind: str, number: int) -> dict | None:
        path, fs = self._open(self.path(kind, number))
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def numbers(self, kind: str) -> list[int]:
        folder, fs = self._open(f"{self._root}/{kind}")
        if not fs.exists(folder):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("."))

    def remove(self, path: str) -> None:
        """Delete a folder of the load with all it holds."""
        hadoop_path, fs = self._open(path)
        fs.delete(hadoop_path, True)

    def exists(self, path: str) -> bool:
        hadoop_path, fs = self._open(path)
        return fs.exists(hadoop_path)
