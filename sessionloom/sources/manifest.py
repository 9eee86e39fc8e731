"""A small file that says what a folder holds, replaced in one step.

Each version is a file of its own, put in place by a rename that fails if the version is there already, so
of two writers who start from the same version one is told to start again, and a reader always finds one
whole version: the latest.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

from sessionloom.session import hadoop_path

KEPT_VERSIONS = 10
ATTEMPTS = 20


class Manifest:
    """Versions of a JSON object in a folder. The folder may be missing; then the object is empty."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def versions(self) -> list[int]:
        files, path = hadoop_path(self.spark, self.folder)
        if not files.exists(path):
            return []
        names = [status.getPath().getName() for status in files.listStatus(path)]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def read(self, version: int | None = None) -> tuple[int, dict]:
        """A version and what it says; the latest by default, 0 and nothing if there is none."""
        if version is None:
            found = self.versions()
            if not found:
                return 0, {}
            version = found[-1]
        files, path = hadoop_path(self.spark, self._file(version))
        stream = files.open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return version, json.loads(text)

    def change(self, step: Callable[[dict], dict]) -> tuple[int, dict, dict]:
        """Put ``step`` of the latest version in its place; gives the new version, and the object before
        and after.

        If another writer was faster, ``step`` is applied to what that one has left.
        """
        for _ in range(ATTEMPTS):
            version, before = self.read()
            after = step(dict(before))
            if self._put(version + 1, after):
                self._forget(version + 1 - KEPT_VERSIONS)
                return version + 1, before, after
        raise RuntimeError(f"{self.folder} was changed by others {ATTEMPTS} times in a row")

    def _file(self, version: int) -> str:
        return f"{self.folder}/v{version:012d}.json"

    def _put(self, version: int, content: dict) -> bool:
        files, draft = hadoop_path(self.spark, f"{self.folder}/.draft-{uuid.uuid4().hex}")
        out = files.create(draft, False)
        out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
        out.close()
        jvm, (_, target) = self.spark._jvm, hadoop_path(self.spark, self._file(version))
        hadoop = jvm.org.apache.hadoop.fs
        context = hadoop.FileContext.getFileContext(draft.toUri(), self.spark._jsc.hadoopConfiguration())
        # Without the option to overwrite, the rename fails if the target is there.
        none = self.spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        try:
            context.rename(draft, target, none)
        except Exception as error:
            files.delete(draft, False)
            if "FileAlreadyExistsException" in str(error) and not isinstance(error, PySparkException):
                return False
            raise
        return True

    def _forget(self, before: int) -> None:
        for version in self.versions():
            if version < before:
                files, path = hadoop_path(self.spark, self._file(version))
                files.delete(path, False)
