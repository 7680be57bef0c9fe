"""Progress marks and small state tables of the incremental jobs.

Both are a few small files that the driver reads and writes itself; no Spark job runs for them. Every file gets the next number in
its folder and is put in place by a rename, so a run that dies while saving leaves what was there before.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tickmart.sources.partitions import file_system

#: Files of a state table that gather before they are folded into one.
FOLD_AT = 64


def _numbered(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Number and name of the files, in order."""
    fs, folder = file_system(spark, path)
    if not fs.exists(folder):
        return []
    names = (status.getPath().getName() for status in fs.listStatus(folder))
    return sorted((int(n.split(".")[0]), n) for n in names if n.split(".")[0].isdigit())


def _read(spark: SparkSession, path: str) -> str:
    fs, file = file_system(spark, path)
    stream = fs.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write(spark: SparkSession, path: str, name: str, text: str) -> None:
    """A file under its final name is a whole one."""
    fs, unfinished = file_system(spark, f"{path}/_{uuid.uuid4().hex}")
    stream = fs.create(unfinished)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not fs.rename(unfinished, file_system(spark, f"{path}/{name}")[1]):
        raise OSError(f"{path}/{name} could not be put in place")


def _remove(spark: SparkSession, path: str, names: list[str]) -> None:
    for name in names:
        fs, file = file_system(spark, f"{path}/{name}")
        fs.delete(file, False)


def load_mark(spark: SparkSession, path: str) -> str | None:
    files = _numbered(spark, path)
    return _read(spark, f"{path}/{files[-1][1]}") if files else None


def save_mark(spark: SparkSession, path: str, value) -> None:
    """Call only after the data the mark speaks of has been written. The newest mark and the one before it are kept."""
    files = _numbered(spark, path)
    text = value.isoformat() if hasattr(value, "isoformat") else str(value)
    _write(spark, path, f"{files[-1][0] + 1 if files else 0:012d}", text)
    _remove(spark, path, [n for _, n in files[:-1]])


def _current(files: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """A folded file stands for every file up to its number."""
    folded = max((n for n, name in files if name.endswith(".all")), default=-1)
    return [(n, name) for n, name in files if n > folded or (n == folded and name.endswith(".all"))]


def read_rows(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Rows of a small state table, each once; none where it does not exist yet."""
    schema = T.StructType.fromDDL(ddl)
    lines = {line for _, name in _current(_numbered(spark, path)) for line in _read(spark, f"{path}/{name}").splitlines()}
    if not lines:
        return spark.createDataFrame([], schema)
    texts = spark.createDataFrame([(line,) for line in sorted(lines)], "line string")
    return texts.selectExpr(f"inline(array(from_json(line, '{' '.join(ddl.split())}')))")


def append_rows(spark: SparkSession, path: str, rows: list[tuple], ddl: str) -> None:
    """Add rows; a row that is there already is not kept twice. Many files are folded into one."""
    if not rows:
        return
    files = _numbered(spark, path)
    names = [f.name for f in T.StructType.fromDDL(ddl).fields]
    lines = [json.dumps({k: v.isoformat() if hasattr(v, "isoformat") else v for k, v in zip(names, row) if v is not None}) for row in rows]
    number = files[-1][0] + 1 if files else 0
    current = _current(files)
    if len(current) < FOLD_AT:
        _write(spark, path, f"{number:012d}", "\n".join(lines))
    else:
        before = [line for _, name in current for line in _read(spark, f"{path}/{name}").splitlines()]
        _write(spark, path, f"{number:012d}.all", "\n".join(dict.fromkeys(before + lines)))
        _remove(spark, path, [n for _, n in files])
