"""Small control files on any filesystem Spark can reach.

A path belongs to the filesystem that Spark resolves it on, so a path without a scheme follows the
session's default filesystem. A numbered commit file is created exclusively: its content is
complete when it becomes visible and the second writer of a number loses. The local filesystem
uses a hard link, others Hadoop's rename without overwrite. Object stores, whose rename is not
atomic, are refused.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from urllib.parse import urlparse

from pyspark.sql import SparkSession

from ..errors import CommitConflict, require

# Schemes of object stores that Hadoop renames by copying.
OBJECT_STORES = frozenset("s3 s3a s3n gs oss cosn obs swift wasb wasbs abfs abfss".split())


def _local(path: str) -> str:
    return urlparse(path).path


class Storage:
    def __init__(self, spark: SparkSession, use_hadoop: bool = False):
        self.spark = spark
        self.use_hadoop = use_hadoop

    def _is_local(self, path: str) -> bool:
        scheme = urlparse(path).scheme or self._default()
        require(scheme not in OBJECT_STORES, f"Commits on {scheme}: need conditional writes, which are not offered")
        return not self.use_hadoop and scheme == "file"

    def _default(self) -> str:
        """Scheme of the filesystem that Spark resolves paths without one on."""
        jvm = self.spark._jvm
        return jvm.org.apache.hadoop.fs.FileSystem.getDefaultUri(self.spark._jsc.hadoopConfiguration()).getScheme()

    def _hadoop(self, path: str):
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        conf = self.spark._jsc.hadoopConfiguration()
        return jvm, where, where.getFileSystem(conf)

    def names(self, folder: str) -> list[str]:
        """Names inside a folder, or nothing when it does not exist."""
        if self._is_local(folder):
            found = _local(folder)
            return sorted(os.listdir(found)) if os.path.isdir(found) else []
        _, where, fs = self._hadoop(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []

    def read(self, path: str) -> bytes:
        if self._is_local(path):
            with open(_local(path), "rb") as file:
                return file.read()
        jvm, where, fs = self._hadoop(path)
        stream = fs.open(where)
        try:
            return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def create(self, path: str, body: bytes) -> None:
        """Create a file with this content unless it exists already."""
        folder, name = path.rsplit("/", 1)
        draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
        if self._is_local(path):
            os.makedirs(_local(folder), exist_ok=True)
            with open(_local(draft), "xb") as file:
                file.write(body)
                file.flush()
                os.fsync(file.fileno())
            try:
                os.link(_local(draft), _local(path))
            except FileExistsError:
                raise CommitConflict(f"{name} was committed by another writer") from None
            finally:
                os.unlink(_local(draft))
            return
        jvm, target, fs = self._hadoop(path)
        source = jvm.org.apache.hadoop.fs.Path(draft)
        stream = fs.create(source, False)
        stream.write(bytearray(body))
        stream.close()
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            fs.getUri(), self.spark._jsc.hadoopConfiguration()
        )
        try:
            context.rename(source, target, options)
        except Exception as error:
            if not fs.exists(target):
                raise
            raise CommitConflict(f"{name} was committed by another writer") from error
        finally:
            fs.delete(source, False)


class CommitLog:
    """Numbered JSON files ``<prefix><n>.json`` in one folder; the highest number is current."""

    def __init__(self, storage: Storage, folder: str, prefix: str = ""):
        self.storage, self.folder, self.prefix = storage, folder, prefix

    def path(self, number: int) -> str:
        return f"{self.folder}/{self.prefix}{number:012d}.json"

    def numbers(self) -> list[int]:
        form = re.compile(re.escape(self.prefix) + r"(\d+)\.json")
        found = (form.fullmatch(n) for n in self.storage.names(self.folder))
        return sorted(int(m.group(1)) for m in found if m)

    def latest(self) -> int | None:
        numbers = self.numbers()
        return numbers[-1] if numbers else None

    def read(self, number: int) -> bytes:
        return self.storage.read(self.path(number))

    def load(self, number: int) -> dict:
        return json.loads(self.read(number))

    def append(self, number: int, body: bytes) -> None:
        self.storage.create(self.path(number), body)
