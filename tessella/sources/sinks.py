"""Writers: upsert, pruning, checksums, volumes, label text, verified copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of new, and those of old whose keys new doesn't have."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def delete_prefix(registry: DataFrame, column: str, prefix: str) -> DataFrame:
    return registry.where(~F.coalesce(F.startswith(F.col(column), F.lit(prefix)), F.lit(False)))


def write_jsonl(df: DataFrame, path: str, rows_per_file: int = 0) -> None:
    """JSON Lines in UTF-8 with nulls written out; at most rows_per_file rows a file if given."""
    writer = df.write.option("ignoreNullFields", "false")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.json(path)


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256) of every file below path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))


def checksum_mismatches(spark: SparkSession, path: str, expected: DataFrame) -> DataFrame:
    """Files whose checksum isn't the expected one (columns path, sha256), or that only one side has."""
    found = checksums(spark, path).select("path", F.col("sha256").alias("found"))
    return found.join(expected, "path", "full").where(~F.col("found").eqNullSafe(F.col("sha256")))


def stale(listing: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Outputs that belong to no current key: what a prune deletes."""
    return listing.join(keys, on, "left_anti")


def volume(position: Column, rows: int = 5000) -> Column:
    """The volume (from 0) in which the row at a position (from 0) is shipped."""
    return F.floor(position / rows)


def label_text(synthetic: Column, originals: Column) -> Column:
    """Label lines, the synthetic ones first; a null line (an empty box) is dropped."""
    return F.array_join(F.concat(F.array_compact(synthetic), F.array_compact(originals)), "\n")


def content_digest(df: DataFrame) -> tuple[int, int]:
    """(rows, a digest of their contents that order doesn't change): a sum of 64-bit hashes."""
    row = df.agg(F.count("*"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()
    return row[0], int(row[1] or 0)


def verified_copy(df: DataFrame, path: str) -> DataFrame:
    """df written to path and read again; an error if the copy isn't what df held."""
    before = content_digest(df)
    df.write.parquet(path)
    copy = df.sparkSession.read.schema(df.schema).parquet(path)
    if content_digest(copy) != before:
        raise RuntimeError(f"the copy at {path} differs from its source")
    return copy


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def replace_file(spark: SparkSession, path: str, content: bytes) -> None:
    """A small file, replaced as a whole: written beside it and renamed over it."""
    p, fs = _file_system(spark, path)
    beside = p.suffix(".tmp")
    out = fs.create(beside, True)
    out.write(bytearray(content))
    out.close()
    context = spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    rename = spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(beside, p, options)


def replace_table(df: DataFrame, path: str) -> None:
    """A table, replaced as a whole: written beside it, then put in its place."""
    spark = df.sparkSession
    p, fs = _file_system(spark, path)
    beside, old = p.suffix(".tmp"), p.suffix(".old")
    df.write.mode("overwrite").parquet(beside.toString())
    fs.delete(old, True)
    if fs.exists(p) and not fs.rename(p, old):
        raise RuntimeError(f"can't move {path} away")
    if not fs.rename(beside, p):
        raise RuntimeError(f"can't put the new table in place at {path}")
    fs.delete(old, True)


def dataset_yaml(root: str, names: list[str], splits: dict[str, str]) -> str:
    """A training set's description: its root, the folders of its splits, its ordered class names."""
    lines = [f"path: {root}", *(f"{k}: {v}" for k, v in splits.items()), f"nc: {len(names)}", "names:"]
    return "\n".join([*lines, *(f"  {i}: {n}" for i, n in enumerate(names))]) + "\n"


def with_yaml_root(text: Column, root: Column) -> Column:
    """A description with its first `path:` line replaced."""
    first = F.regexp_extract(text, r"(?m)^(path:.*)$", 1)
    at = F.instr(text, first)
    return F.when(first == "", text).otherwise(F.concat(F.substr(text, F.lit(1), at - 1), F.lit("path: "), root, F.substr(text, at + F.length(first), F.length(text))))


def verified_view(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A view over the table at path. A view of that name that shows another place is an error,
    so one release never stands in for another."""
    files = spark.read.parquet(path)
    if spark.catalog.tableExists(name) and sorted(spark.table(name).inputFiles()) != sorted(files.inputFiles()):
        raise RuntimeError(f"view {name} shows something else than {path}")
    files.createOrReplaceTempView(name)
    return spark.table(name)


def tar_archives(rows: DataFrame, volume: str, name: str, content: str) -> DataFrame:
    """(volume, archive): each volume's rows as one tar file, members by name. A volume holds a
    bounded number of rows, see volume()."""

    def pack(key, part):
        import io
        import tarfile

        import pandas as pd

        body = io.BytesIO()
        with tarfile.open(fileobj=body, mode="w") as tar:
            for member, data in sorted(zip(part["name"], part["content"])):
                info = tarfile.TarInfo(member)
                info.size = len(data)
                tar.addfile(info, io.BytesIO(bytes(data)))
        return pd.DataFrame({"volume": [key[0]], "archive": [body.getvalue()]})

    wanted = rows.select(F.col(volume).cast("long").alias("volume"), F.col(name).alias("name"), F.col(content).cast("binary").alias("content"))
    return wanted.groupBy("volume").applyInPandas(pack, "volume long, archive binary")


def markdown_table(rows: list, columns: list[str], totals: list[str] = ()) -> str:
    """A report's table with thousands separated; with totals, a last row that sums those columns."""
    shown = lambda v: f"{v:,}" if isinstance(v, int) else "" if v is None else f"{v:.2f}" if isinstance(v, float) else str(v)
    out = ["| " + " | ".join(columns) + " |", "|" + "---|" * len(columns)]
    out += ["| " + " | ".join(shown(r[c]) for c in columns) + " |" for r in rows]
    if totals:
        sums = {c: sum(r[c] or 0 for r in rows) for c in totals}
        out.append("| " + " | ".join(shown(sums[c]) if c in sums else "total" if c == columns[0] else "" for c in columns) + " |")
    return "\n".join(out) + "\n"


def code_hashes(folder: str) -> list[tuple[str, str]]:
    """(file, sha256) of the Python files below a folder of the driver: what made a batch."""
    import hashlib
    from pathlib import Path

    files = sorted(Path(folder).rglob("*.py"))
    return [(str(f.relative_to(folder)), hashlib.sha256(f.read_bytes()).hexdigest()) for f in files]


def notify(url: str, timeout: float = 5.0) -> bool:
    """Tell a dashboard to reload; whether it answered. A release doesn't fail for it."""
    import urllib.request

    try:
        with urllib.request.urlopen(urllib.request.Request(url, method="POST"), timeout=timeout) as answer:  # noqa: S310
            return 200 <= answer.status < 300
    except OSError:
        return False
