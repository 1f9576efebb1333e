"""The few file-system calls a table needs, through Spark's own Hadoop client."""

from __future__ import annotations

import posixpath
import re
import tempfile
import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from lodeworks.errors import ConcurrentPublishError

_SLASHES = "^([A-Za-z][A-Za-z0-9+.-]*):/+"
# what stands in a URI as it stands in a path, and names no other place
_PLAIN = re.compile(r"(?:/[A-Za-z0-9_=-][A-Za-z0-9_.=-]*)+")
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def uri(spark: SparkSession, path: str) -> str:
    """A path in the spelling of ``file_column``."""
    system, p = _open(spark, path)
    return re.sub(_SLASHES, r"\1:/", system.makeQualified(p).toUri().toString())


def uris(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """``uri`` of each path: of all in folders of one folder at once, as there may be very many."""
    shared = posixpath.commonprefix([p.rpartition("/")[0] + "/" for p in paths]).rpartition("/")[0]
    base = uri(spark, shared) if shared and not shared.endswith((":", ":/", "/")) else ""
    return [base + p[len(shared) :] if base and _PLAIN.fullmatch(p[len(shared) :]) else uri(spark, p) for p in paths]


@contextmanager
def listed_by_few(spark: SparkSession) -> Iterator[None]:
    """Frames made inside list their files by a few tasks a core, where Spark would start a task for each of up to 10,000 files."""
    before = spark.conf.get(_LISTING)
    spark.conf.set(_LISTING, str(min(int(before), 8 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(_LISTING, before)


def file_column() -> Column:
    """The file a row was read from; one slash after the scheme, however it was listed."""
    return F.regexp_replace("_metadata.file_path", _SLASHES, "$1:/")


def exists(spark: SparkSession, path: str) -> bool:
    system, p = _open(spark, path)
    return system.exists(p)


def is_directory(spark: SparkSession, path: str) -> bool:
    system, p = _open(spark, path)
    return system.exists(p) and system.getFileStatus(p).isDirectory()


def make_directory(spark: SparkSession, path: str) -> None:
    system, p = _open(spark, path)
    system.mkdirs(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names inside a directory, sorted; none if it is not there."""
    system, p = _open(spark, path)
    if not system.exists(p):
        return []
    return sorted(_below(spark, system, p, system.listStatus(p)))


def matching(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """Paths of what a glob pattern finds below a directory, in the order of their names."""
    system, p = _open(spark, path)
    _, wanted = _open(spark, f"{path.rstrip('/')}/{pattern}")
    return [f"{path.rstrip('/')}/{n}" for n in sorted(_below(spark, system, p, system.globStatus(wanted)))]


def _below(spark: SparkSession, system, folder, statuses) -> list[str]:
    """Names of files or directories relative to a folder that they are in."""
    paths = spark._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(statuses)
    # "{<folder>/a,<folder>/b}": one call for all names, as a directory may hold very many
    text, home = spark._jvm.org.apache.commons.lang3.ArrayUtils.toString(paths), system.makeQualified(folder).toString()
    names = f",{text[1:-1]}".split(f",{home}/")[1:]
    if len(names) != len(statuses):
        names = [status.getPath().toString()[len(home) + 1 :] for status in statuses]
    return names


def size_of(spark: SparkSession, path: str) -> tuple[int, int]:
    """Data files directly inside a directory that a write made, and their bytes."""
    system, p = _open(spark, path)
    _, marker = _open(spark, f"{path}/_SUCCESS")
    summary = system.getContentSummary(p)
    return summary.getFileCount() - int(system.exists(marker)), summary.getLength()


def age_hours(spark: SparkSession, path: str) -> float:
    """Hours since a directory, or any file directly in it, last changed."""
    system, p = _open(spark, path)
    newest = max([system.getFileStatus(p).getModificationTime(), *(s.getModificationTime() for s in system.listStatus(p))])
    return (time.time() - newest / 1000) / 3600


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Data files directly inside a directory, in name order (numbers as numbers)."""
    names = [n for n in children(spark, path) if n[0] not in "._"]
    names.sort(key=lambda n: [int(t) if t.isdigit() else t for t in re.split(r"(\d+)", n)])
    return [f"{path.rstrip('/')}/{n}" for n in names]


def read_text(spark: SparkSession, path: str) -> str:
    system, p = _open(spark, path)
    stream = system.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Create a file whole or not at all; refuse one that is already there.

    The text goes to a draft, which then gets its name in one step that fails if the name is
    taken: a hard link on a local file system, a rename without overwriting elsewhere.
    """
    system, target = _open(spark, path)
    folder, _, name = path.rpartition("/")
    _, draft = _open(spark, f"{folder}/.{name}.{uuid.uuid4().hex}")
    stream = system.create(draft, False)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    try:
        taken = not _named(spark, system, draft, target)
    finally:
        if system.exists(draft):
            system.delete(draft, False)
    if taken:
        raise ConcurrentPublishError(f"{path} was written by someone else")


def _named(spark: SparkSession, system, draft, target) -> bool:
    qualified = system.makeQualified(target).toUri()
    if qualified.getScheme() != "file":
        return not system.exists(target) and system.rename(draft, target)
    paths = spark._jvm.java.nio.file.Paths
    link = spark._jvm.java.nio.file.Files.createLink
    try:
        link(paths.get(qualified), paths.get(system.makeQualified(draft).toUri()))
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in str(error.java_exception.getClass().getName()):
            return False
        raise


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    system, p = _open(spark, path)
    stream = system.create(p, False)
    stream.write(bytearray(content))
    stream.close()


def rename(spark: SparkSession, old: str, new: str) -> None:
    system, p = _open(spark, old)
    _, target = _open(spark, new)
    if not system.rename(p, target):
        raise OSError(f"could not rename {old} to {new}")


def delete(spark: SparkSession, path: str) -> None:
    system, p = _open(spark, path)
    system.delete(p, True)


def shared_folder(spark: SparkSession) -> str:
    """A new folder for intermediate tables, in the place the cluster names for them.

    ``spark.checkpoint.dir`` (or the context's checkpoint directory) is shared by all
    executors. Only a local session without one gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="lodeworks-")
        spark.sparkContext.setCheckpointDir(base)
    folder = f"{base.rstrip('/')}/lodeworks-{uuid.uuid4().hex}"
    make_directory(spark, folder)
    return folder


def unique(name: str) -> str:
    """A name no other call gives."""
    return f"{name}-{uuid.uuid4().hex}"
