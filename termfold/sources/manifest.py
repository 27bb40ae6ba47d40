"""Committed versions of an output folder.

Files are written below a folder of their own run, which nobody reads yet. One small file, the manifest of the next
version, then names for every class the run, schema and files that hold its output. It is put in place by a rename that
fails if that version exists, so there is always one newest manifest, complete, with the old or the new output of every
class; two writers at a time both get through, one after the other. What no kept version names is removed later.

    <path>/_manifest/000000000007.json      <path>/run-<id>/profile=UA/section=all groups/part-...
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import SparkSession

from termfold.operators.staging import file_system

FOLDER = "_manifest"
TRIES = 20


@dataclass(frozen=True)
class Output:
    """Where one class's output is."""

    run: str                                          # folder below the path
    fmt: str
    schema: str                                       # JSON of the columns in the files
    sections: dict[str, list[list]] = field(default_factory=dict)    # section -> [file below the path, rows], in order
    digest: str | None = None                         # of what it was made from


@dataclass(frozen=True)
class Version:
    number: int
    classes: dict[str, Output]


def _numbers(spark: SparkSession, path: str) -> list[int]:
    fs, at = file_system(spark, f"{path}/{FOLDER}")
    if not fs.exists(at):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(at)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _file(path: str, number: int) -> str:
    return f"{path}/{FOLDER}/{number:012d}.json"


def read_text(spark: SparkSession, file: str) -> str:
    fs, at = file_system(spark, file)
    stream = fs.open(at)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, file: str, text: str) -> None:
    fs, at = file_system(spark, file)
    stream = fs.create(at, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def version(spark: SparkSession, path: str, number: int | None = None) -> Version:
    """The newest version, or an earlier one that is still kept; version 0 has no output."""
    path = path.rstrip("/")
    if number is None:
        number = max(_numbers(spark, path), default=0)
    if not number:
        return Version(0, {})
    found = json.loads(read_text(spark, _file(path, number)))
    return Version(number, {name: Output(**o) for name, o in found["classes"].items()})


def _put(spark: SparkSession, path: str, new: Version) -> bool:
    """Put a manifest in place unless its version exists."""
    temporary = f"{path}/{FOLDER}/tmp-{uuid.uuid4().hex}"
    write_text(spark, temporary, json.dumps({"version": new.number, "classes": {n: asdict(o) for n, o in new.classes.items()}}))
    fs, source = file_system(spark, temporary)
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(fs.makeQualified(source).toUri(), spark._jsc.hadoopConfiguration())
    never_over = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(source), fs.makeQualified(hadoop.Path(_file(path, new.number))), never_over)
        return True
    except Exception as e:  # noqa: BLE001 - whatever went wrong, the version is taken or it is not
        fs.delete(source, False)
        if fs.exists(hadoop.Path(_file(path, new.number))):
            return False
        raise e


def commit(spark: SparkSession, path: str, outputs: dict[str, Output]) -> Version:
    """Make a run's output the current one of its classes; those of others stay as they are."""
    path = path.rstrip("/")
    for _ in range(TRIES):
        now = version(spark, path)
        new = Version(now.number + 1, {**now.classes, **outputs})
        if _put(spark, path, new):
            return new
    raise OSError(f"{TRIES} other writers were faster; the output is in {sorted({o.run for o in outputs.values()})}")


def clean(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Remove what only versions before the newest ``keep`` name; gives the removed folders.

    Folders of runs that are not committed are left alone: they may be at work. A removal that is cut short is
    finished by the next one, since manifests go after what they name.
    """
    path = path.rstrip("/")
    numbers = _numbers(spark, path)
    old, kept = numbers[: max(0, len(numbers) - keep)], numbers[max(0, len(numbers) - keep):]
    used = {(o.run, name) for n in kept for name, o in version(spark, path, n).classes.items()}
    gone: list[str] = []
    for n in old:
        for name, o in version(spark, path, n).classes.items():
            folder = f"{o.run}/profile={name}"
            if (o.run, name) not in used and folder not in gone:
                fs, at = file_system(spark, f"{path}/{folder}")
                fs.delete(at, True)
                gone.append(folder)
    for run in {folder.split("/")[0] for folder in gone} - {run for run, _ in used}:
        fs, at = file_system(spark, f"{path}/{run}")
        fs.delete(at, True)
    for n in old:
        fs, at = file_system(spark, _file(path, n))
        fs.delete(at, False)
    return gone


def abandoned(spark: SparkSession, path: str, hours: float = 24.0) -> list[str]:
    """Remove folders of runs that never got committed and whose last change is so many hours ago."""
    path = path.rstrip("/")
    used = {o.run for n in _numbers(spark, path) for o in version(spark, path, n).classes.values()}
    fs, at = file_system(spark, path)
    before = spark._jvm.java.lang.System.currentTimeMillis() - int(hours * 3_600_000)
    gone = []
    for s in fs.listStatus(at) if fs.exists(at) else []:
        name = s.getPath().getName()
        if name.startswith("run-") and name not in used and s.getModificationTime() <= before:
            fs.delete(s.getPath(), True)
            gone.append(name)
    return gone
