"""The trip files of folders: which there are, and how they are stored.

A file lies in a folder plainly, or in parts in a directory ``file=<name>``
(:func:`~stationflow.sources.files.write_trip_files`); one folder may hold both.
Spark's partition discovery would take such directories as a partition column and
leave out the files beside them, so folders are listed through and a filter on the
path, which Spark applies while it lists, keeps the two layouts and nothing else."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.functions.columns import FILE_DIR, file_key_sql
from stationflow.schema import FILE

#: Options of a reader that lists folders through, without partition columns.
LISTED_THROUGH = {"recursiveFileLookup": "true"}
_LAYOUTS = f"^({FILE_DIR}[^/]+/)?[^/]+$"


def input_roots(spark: SparkSession, paths: list[str]) -> list[str]:
    """The folders (or files) that the paths name, patterns resolved, with their
    file system and URL-encoded, as ``_metadata.file_path`` writes them."""
    roots = []
    for path in paths:
        given = spark._jvm.org.apache.hadoop.fs.Path(path)
        system = given.getFileSystem(spark._jsc.hadoopConfiguration())
        found = system.globStatus(given)
        roots += [str(s.getPath().toUri()) for s in found] if found else [str(system.makeQualified(given).toUri())]
    return [_plain(r.rstrip("/")) for r in roots]


def _plain(uri: str) -> str:
    """``file:///x`` and ``file:/x`` alike."""
    scheme, colon, rest = uri.partition(":")
    return f"{scheme}:/{rest.lstrip('/')}" if colon else uri


def belongs(roots: list[str], path: Column | None = None) -> Column:
    """Whether a file lies in one of the folders, plainly or as a part."""
    path = F.col("_metadata.file_path") if path is None else path
    plain = F.regexp_replace(path, "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")
    tests = [(plain == F.lit(r)) | (F.startswith(plain, F.lit(f"{r}/")) & F.substring(plain, len(r) + 2, 1 << 20).rlike(_LAYOUTS)) for r in roots]
    return reduce(lambda a, b: a | b, tests)


def is_trip_file(roots: list[str], uri: str) -> bool:
    """The same for one path, on the driver."""
    plain = _plain(uri)
    rests = [plain[len(r) + 1 :] for r in roots if plain.startswith(f"{r}/")]
    return plain in roots or any("/" not in x or (x.startswith(FILE_DIR) and x.count("/") == 1) for x in rests)


def literal_path(path: str) -> str:
    """A listed path as a reader takes it: characters of patterns escaped."""
    return "".join(f"\\{c}" if c in "{}[]*?\\" else c for c in path)


def trip_file_manifest(spark: SparkSession, path: str | list[str], *, glob: str | None = None) -> DataFrame:
    """``file, path, length, modified`` of every stored trip file or part in the
    folders: ``file`` is the identity that its trips carry. Only names are listed;
    no file is opened."""
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.format("binaryFile").options(**LISTED_THROUGH)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    listed = reader.load(paths).where(belongs(input_roots(spark, paths)))
    return listed.selectExpr(f"{file_key_sql()} AS {FILE}", "path", "length", "modificationTime AS modified")
