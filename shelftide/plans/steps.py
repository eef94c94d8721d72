"""Steps of a run that can be taken up again.

Every step leaves a manifest: its name, a fingerprint of its settings and of the steps it was made from, and where its
output is. Output goes to a path of its own first; the manifest, written beside and renamed, publishes it. A run that
finds a manifest with the fingerprint it would give itself takes the output instead of making it again. A run
that was stopped in the middle of a step leaves no manifest for it, and only unpublished files.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def source_fingerprint(df: DataFrame) -> str:
    """Of the files behind a frame (path, size, time of change) and of what is done with them. A frame that reads no
    files is like no other."""
    files = sorted(df.inputFiles())
    if not files:
        return uuid.uuid4().hex
    listed = []
    for name in files:
        status = _file_system(df.sparkSession, name).getFileStatus(_path(df.sparkSession, name))
        listed.append([name, status.getLen(), status.getModificationTime()])
    plan = re.sub(r"#\d+L?", "", df._jdf.queryExecution().analyzed().toString())
    return digest([listed, plan, df.schema.json()])


def digest(parts: object) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()


def _path(spark: SparkSession, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def _file_system(spark: SparkSession, name: str):
    return _path(spark, name).getFileSystem(spark._jsc.hadoopConfiguration())


@dataclass
class Steps:
    """Steps in one folder. With ``resume`` published outputs of the same fingerprint are used again; without it every step
    is made anew."""

    spark: SparkSession
    folder: str
    resume: bool = False
    fingerprints: dict[str, str] = field(default_factory=dict)
    reused: list[str] = field(default_factory=list)

    def _manifest(self, name: str) -> str:
        return f"{self.folder}/manifests/{name}.json"

    def published(self, name: str) -> dict | None:
        path = self._manifest(name)
        if not _file_system(self.spark, path).exists(_path(self.spark, path)):
            return None
        return json.loads(self.spark.read.text(path, wholetext=True).first()[0])

    def fingerprint(self, name: str, settings: object, inputs: tuple[str, ...]) -> str:
        """``inputs``: names of steps made before, or fingerprints of sources."""
        self.fingerprints[name] = digest([name, settings, [self.fingerprints.get(i, i) for i in inputs]])
        return self.fingerprints[name]

    def publish(self, name: str, **facts: object) -> None:
        """The manifest appears whole or not at all."""
        text = json.dumps({"name": name, "fingerprint": self.fingerprints[name], **facts}, indent=1)
        final, beside = self._manifest(name), f"{self.folder}/manifests/.{name}-{uuid.uuid4().hex}"
        system = _file_system(self.spark, final)
        out = system.create(_path(self.spark, beside), True)
        out.write(bytearray(text.encode()))
        out.close()
        if system.exists(_path(self.spark, final)):
            system.delete(_path(self.spark, final), False)
        if not system.rename(_path(self.spark, beside), _path(self.spark, final)):
            raise OSError(f"the manifest of {name} could not be published")

    def known(self, name: str) -> dict | None:
        """The manifest, if this step was made before from the same and may be used again."""
        found = self.published(name) if self.resume else None
        if found and found["fingerprint"] == self.fingerprints[name]:
            self.reused.append(name)
            return found
        return None

    def table(self, name: str, build: Callable[[], DataFrame], settings: object = None, inputs: tuple[str, ...] = ()) -> DataFrame:
        """The staged output of a step."""
        self.fingerprint(name, settings, inputs)
        found = self.known(name)
        if found:
            schema = T.StructType.fromJson(found["schema"])
            return self.spark.read.schema(schema).parquet(found["path"]).select(*schema.names)
        before = self.published(name)
        path = f"{self.folder}/{name}-{uuid.uuid4().hex[:12]}"
        df = build()
        df.write.parquet(path)
        self.publish(name, path=path, schema=df.schema.jsonValue(), settings=settings, inputs=list(inputs))
        if before:
            _file_system(self.spark, before["path"]).delete(_path(self.spark, before["path"]), True)
        return self.spark.read.schema(df.schema).parquet(path).select(*df.columns)
