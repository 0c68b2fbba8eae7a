"""Scans of the file formats that manifests and labels come in.

Manifests are JSON Lines or JSON arrays, box inventories COCO or nested JSON, labels one
object a line. All readers take paths that Spark can open, shards as globs. A malformed
manifest fails the scan, as a release must not lose rows silently; labels have a policy.
"""

from __future__ import annotations

import io
import json
import time
import urllib.request
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything is at path, a glob allowed, through Hadoop's file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def file_part(pattern: str) -> Column:
    """What the pattern's first group matches in the path of a row's file."""
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)


def json_lines(spark: SparkSession, path: str, schema: str, shard: str | None = None, missing_ok: bool = False) -> DataFrame:
    """Rows of JSON Lines files; blank lines are skipped. With shard, a pattern whose group
    names a file's shard, a column `shard` is added. Nothing at path is an error or, with
    missing_ok, an empty table."""
    if missing_ok and not exists(spark, path):
        rows = spark.createDataFrame([], schema)
        return rows.withColumn("shard", F.lit(None).cast("string")) if shard else rows
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return rows.withColumn("shard", file_part(shard)) if shard else rows


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of files that are one JSON array each."""
    return spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", "true").json(path)


_COCO = (
    "images array<struct<id: long, file_name: string, width: int, height: int>>, "
    "annotations array<struct<id: long, image_id: long, category_id: int, bbox: array<double>>>, "
    "categories array<struct<id: int, name: string>>"
)


def coco(spark: SparkSession, path: str, inventory: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(images, annotations, categories) of COCO files; `file` tells files apart, as ids are a
    file's own. With inventory, a pattern whose group names what ids belong to, `file` is that:
    an inventory in several files, where an image's annotations may be in any of them.

    A task holds one file at a time, so a large inventory should come in several."""
    whole = json_array(spark, path, _COCO).withColumn("file", file_part(inventory) if inventory else F.col("_metadata.file_path"))
    return tuple(whole.select("file", F.inline(c)) for c in ("images", "annotations", "categories"))


def boxed_images(images: DataFrame, annotations: DataFrame, categories: DataFrame, wanted: list[str], least: int = 1, files: DataFrame | None = None, prefix: str = "") -> DataFrame:
    """(file, id, file_name, width, height, boxes, hits) of images with `least` wanted objects.

    Annotations of an unknown category are dropped. boxes counts an image's annotations,
    hits those of a wanted category. files (file_name) are those that exist; prefix is
    what names must start with.
    """
    # each file of an inventory repeats its categories
    known = categories.select("file", F.col("id").alias("category_id"), "name").distinct()
    named = annotations.join(F.broadcast(known), ["file", "category_id"])
    per_image = named.groupBy("file", F.col("image_id").alias("id")).agg(F.count("*").alias("boxes"), F.count_if(F.col("name").isin(wanted)).alias("hits"))
    images = images.where(F.startswith("file_name", F.lit(prefix)))
    if files is not None:
        images = images.join(files.select("file_name"), "file_name", "left_semi")
    return images.join(per_image.where(F.col("hits") >= least), ["file", "id"])


def label_lines(spark: SparkSession, path: str, image: str = r"([^/]+)/[^/]*$") -> DataFrame:
    """(image, line) of label files; image is what the pattern's group matches in the path."""
    return spark.read.text(path).select(file_part(image).alias("image"), F.trim("value").alias("line"))


def oriented_boxes(lines: DataFrame, policy: str, classes: int = 20, mapping: dict[int, str] | None = None, slack: float = 0.05) -> DataFrame:
    """lines with class_id and points (8 normalised numbers) of `class x1 y1 ... x4 y4` labels.

    strict: blank lines are skipped; a wrong number of fields, a class outside 0 to
    classes - 1 or a coordinate that is no number from -slack to 1 + slack fails the scan;
    points are clipped to 0..1. lenient: what is malformed is skipped. mapped: blank lines
    and classes that mapping doesn't have are skipped, and only then a wrong number of
    fields fails the scan; class_name is added.
    """
    fields = F.split("line", r"\s+")
    first = F.get(fields, F.lit(0))
    rows = lines.where(F.col("line") != "").withColumns({"class_id": first.try_cast("int"), "points": F.transform(F.slice(fields, 2, 8), lambda v: v.try_cast("float").cast("double"))})
    nine = F.size(fields) == 9
    known = F.coalesce(F.col("class_id").between(0, classes - 1), F.lit(False))
    number = F.forall("points", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    if policy == "lenient":
        return rows.where(nine & known & number)
    if policy == "strict":
        inside = F.forall("points", lambda v: v.between(-slack, 1 + slack))
        good = nine & known & number & F.coalesce(inside, F.lit(False))
        clip = F.transform("points", lambda v: F.greatest(F.least(v, F.lit(1.0)), F.lit(0.0)))
        return rows.withColumn("points", F.when(good, clip).otherwise(F.raise_error(F.concat(F.lit("malformed label: "), "line"))))
    if policy == "mapped":
        name = F.create_map(*(F.lit(x) for pair in mapping.items() for x in pair))
        rows = rows.withColumn("class_name", F.try_element_at(name, "class_id")).where(F.col("class_name").isNotNull())
        return rows.withColumn("points", F.when(nine, F.col("points")).otherwise(F.raise_error(F.concat(F.lit("malformed label: "), "line"))))
    raise ValueError(f"no policy {policy}")


def label_line(class_id: Column, points: Column) -> Column:
    """The label in its normal form, six decimals each."""
    return F.concat_ws(" ", class_id.cast("string"), F.array_join(F.transform(points, lambda v: F.format_string("%.6f", v)), " "))


def tile_polygons(spark: SparkSession, path: str, name: str) -> DataFrame:
    """(tile, source, class_name, x1, y1, x2, y2) of polygon labels `x1 y1 ... x4 y4 class ...`
    in the whole picture's coordinates. name is a pattern whose group is a file's tile,
    <source>__<x offset>___<y offset>. Lines of fewer than nine fields are skipped."""
    rows = label_lines(spark, path, name).withColumnRenamed("image", "tile").withColumn("f", F.split("line", r"\s+")).where(F.size("f") >= 9)
    numbers = F.transform(F.slice("f", 1, 8), lambda v: v.cast("double"))
    xs, ys = (F.transform(F.array(*(F.lit(i) for i in at)), lambda i: F.get("n", i)) for at in ((0, 2, 4, 6), (1, 3, 5, 7)))
    left = F.element_at(F.split(F.element_at(F.split("tile", "___"), -2), "__"), -1).cast("double")
    top = F.element_at(F.split("tile", "___"), -1).cast("double")
    rows = rows.select("tile", F.element_at(F.split("tile", "__"), 1).alias("source"), F.get("f", F.lit(8)).alias("class_name"), numbers.alias("n"), left.alias("left"), top.alias("top"))
    return rows.select(
        "tile", "source", "class_name",
        (F.array_min(xs) + F.col("left")).alias("x1"), (F.array_min(ys) + F.col("top")).alias("y1"), (F.array_max(xs) + F.col("left")).alias("x2"), (F.array_max(ys) + F.col("top")).alias("y2"),
    )


def csv_dimension(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of CSV files with a header line."""
    return spark.read.schema(schema).option("header", "true").option("mode", "FAILFAST").csv(path)


def class_folders(spark: SparkSession, path: str, suffixes: tuple[str, ...]) -> DataFrame:
    """(path, name, class_name, length) of the files below path with one of the suffixes; a
    file's class is the name of its folder. Contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    name = F.element_at(F.split("path", "/"), -1)
    wanted = F.regexp_extract(F.lower(name), r"(\.[^.]*)$", 1).isin(list(suffixes))
    return files.where(wanted).select("path", name.alias("name"), F.element_at(F.split("path", "/"), -2).alias("class_name"), "length")


def id_list(spark: SparkSession, path: str, column: str = "id") -> DataFrame:
    """Distinct ids of files with one a line; blank lines are none."""
    return spark.read.text(path).select(F.trim("value").alias(column)).where(F.col(column) != "").distinct()


def zip_lines(archives: DataFrame, suffix: str = ".txt") -> DataFrame:
    """(path, member, number, line) of the text members of zip archives (columns path, content).

    An archive is opened in the task that has it; blank lines are left out but counted.
    """

    def read(batches):
        import pyarrow as pa

        kinds = (pa.string(), pa.string(), pa.int32(), pa.string())
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for member in sorted(n for n in z.namelist() if n.endswith(suffix)):
                        lines = z.read(member).decode("utf-8").splitlines()
                        rows = [(path, member, i + 1, line) for i, line in enumerate(lines) if line.strip()]
                        columns = [pa.array(c, k) for c, k in zip([*zip(*rows)] or [[]] * 4, kinds)]
                        yield pa.record_batch(columns, ["path", "member", "number", "line"])

    return archives.select("path", "content").mapInArrow(read, "path string, member string, number int, line string")


class PagedListing(DataSource):
    """Items of a paginated listing over HTTP, as JSON text: format "paged_listing".

    Options: url of the first page, items (the field that holds a page's items, a page
    that is a list holds them itself), retries. Pages link the next one in links.next or
    in a Link header, so one task follows them; each page is tried `retries` times.
    """

    @classmethod
    def name(cls):
        return "paged_listing"

    def schema(self):
        return "page int, item string"

    def reader(self, schema):
        return _PagedReader(self.options)


class _PagedReader(DataSourceReader):
    def __init__(self, options):
        self.options = dict(options)

    def partitions(self):
        return [InputPartition(0)]

    def read(self, partition):
        url, field, retries = self.options["url"], self.options.get("items", "items"), int(self.options.get("retries", "3"))
        page = 0
        while url:
            body, link = _fetch(url, retries)
            found = json.loads(body)
            for item in found if isinstance(found, list) else found.get(field, []):
                yield page, json.dumps(item, ensure_ascii=False)
            url = (None if isinstance(found, list) else (found.get("links") or {}).get("next")) or _next_of(link)
            page += 1


def _fetch(url: str, retries: int) -> tuple[bytes, str]:
    for left in reversed(range(retries)):
        try:
            with urllib.request.urlopen(url, timeout=40) as answer:  # noqa: S310
                return answer.read(), answer.headers.get("Link", "") or ""
        except OSError:
            if not left:
                raise
            time.sleep(0.1)
    raise ValueError("retries must be 1 or more")


def _next_of(link: str) -> str | None:
    for part in link.split(","):
        target, _, rel = part.partition(";")
        if 'rel="next"' in rel:
            return target.strip().strip("<>")
    return None


def paged_listing(spark: SparkSession, url: str, items: str = "items", retries: int = 3) -> DataFrame:
    """(page, item) of a listing; item is JSON text."""
    spark.dataSource.register(PagedListing)
    return spark.read.format("paged_listing").options(url=url, items=items, retries=str(retries)).load()


def to_fetch(listing: DataFrame, present: DataFrame) -> DataFrame:
    """Rows of listing (path, size, ...) that are not present (path, size) in that size."""
    return listing.join(present.select("path", "size"), ["path", "size"], "left_anti")


def first_of_category(features: Column, category: int) -> Column:
    """The first struct of an array whose field category has that value, else null."""
    return F.get(F.filter(features, lambda f: f["category"] == category), F.lit(0))
