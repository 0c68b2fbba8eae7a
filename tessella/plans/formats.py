"""Manifests, inventories and labels written in their file formats and scanned again.

Each query writes a table as the files that a producer leaves in the shared folder, reads
them with the reader of that format and answers from what was read; the SQL answers from
the table. So a reader that loses or changes a row shows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.plans.registry import query, table
from tessella.sources import readers
from tessella.sources.shared import new_path

_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def _text(df: DataFrame, line: Column, path: str, *by: str) -> str:
    """line of every row as a text file below path, in folders by columns."""
    writer = df.select(line.alias("value"), *by).write
    (writer.partitionBy(*by) if by else writer).text(path)
    return path


def _array_file(df: DataFrame, columns: list[str], path: str, by: str) -> str:
    """One JSON array for each value of by. Such a file is one document, so by bounds its rows."""
    rows = df.groupBy(by).agg(F.array_join(F.collect_list(F.to_json(F.struct(*columns))), ",\n").alias("rows"))
    return _text(rows, F.concat(F.lit("[\n"), "rows", F.lit("\n]\n")), path, by)


#: Rows of one COCO document, which a task holds whole when it is written or read.
_DOCUMENT_ROWS = 50_000


def _coco_files(images: DataFrame, annotations: DataFrame, categories: Column, path: str, by: str) -> str:
    """COCO files of the rows' structs (images: by, image; annotations: by, annotation), as many
    for each value of by as keep a file to about _DOCUMENT_ROWS. Rows are dealt by their ids, so
    neither a frequent value of by nor an image of many annotations makes a file longer."""
    parts = max(1, -(-(images.count() + annotations.count()) // _DOCUMENT_ROWS))
    deal = lambda c: F.pmod(F.xxhash64(f"{c}.id"), F.lit(parts)).alias("part")
    both = images.select(by, deal("image"), "image").unionByName(annotations.select(by, deal("annotation"), "annotation"), allowMissingColumns=True)
    whole = both.repartition(parts, by, "part").groupBy(by, "part").agg(F.collect_list("image").alias("images"), F.collect_list("annotation").alias("annotations"))
    whole.select(F.to_json(F.struct("images", "annotations", categories.alias("categories"))).alias("value"), by).write.option("maxRecordsPerFile", 1).partitionBy(by).text(path)
    return path


@query("select o_orderpriority as shard, count(*) as images, round(sum(o_totalprice), 2) as price, count(distinct o_custkey) as backgrounds from orders group by 1")
def shard_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON Lines of several shards through a glob, blank lines between rows, shard from the path."""
    path = new_path(spark, "manifests")
    orders = table(spark, sf_dir, "orders")
    rows = orders.select(F.explode(F.array(F.to_json(F.struct("o_orderkey", "o_custkey", "o_totalprice")), F.lit(" "))).alias("line"), F.col("o_orderpriority").alias("shard"))
    _text(rows, F.col("line"), path, "shard")
    found = readers.json_lines(spark, f"{path}/*", "o_orderkey long, o_custkey long, o_totalprice double", r"/shard=([^/]+)/")
    return found.groupBy(F.url_decode("shard").alias("shard")).agg(
        F.count("*").alias("images"), F.round(F.sum("o_totalprice"), 2).alias("price"), F.count_distinct("o_custkey").alias("backgrounds")
    )


@query("select p_type as class_name, case when p_size % 2 = 0 then 'fixed' else 'innar_train' end as source, coalesce(case when p_size < 10 then 'extra' end, 'foreground_pool') as pool, count(*) as crops, min(p_partkey) as first_id, max(p_partkey) as last_id from part where p_retailprice < 1400 and p_type <> 'PROMO' and p_size % 5 <> 0 group by all union all select 'C-5', 'special', 'foreground_pool', count(*), min(p_partkey), max(p_partkey) from part where p_type = 'PROMO' and p_size % 5 = 0")
def crop_pool_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted crops of mapped classes and allowed sources from JSON arrays, a default pool
    tag where none is written, and one special file; counted by class, source and pool."""
    path = new_path(spark, "pool")
    part = table(spark, sf_dir, "part")
    source = F.when(F.col("p_size") % 5 == 0, "web").when(F.col("p_size") % 2 == 0, "fixed").otherwise("innar_train")
    crops = part.select(
        F.col("p_partkey").alias("id"), F.col("p_type").alias("class_name"), source.alias("source"), F.struct((F.col("p_retailprice") < 1400).alias("accepted")).alias("quality_gate"),
        F.when(F.col("p_size") < 10, "extra").alias("pool"), (F.col("p_partkey") % 4).alias("shard"),
    )
    columns = ["id", "class_name", "source", "quality_gate", "pool"]
    schema = "id long, class_name string, source string, quality_gate struct<accepted: boolean>, pool string"
    _array_file(crops, columns, f"{path}/shards", "shard")
    _array_file(crops.where("class_name = 'PROMO' and source = 'web'").withColumn("shard", F.lit("c5")), columns, f"{path}/special", "shard")
    mapped = ("ECONOMY", "LARGE", "MEDIUM", "SMALL", "STANDARD")
    accepted = F.coalesce("quality_gate.accepted", F.lit(False)) & F.col("class_name").isin(*mapped) & F.col("source").isin("fixed", "innar_train")
    pool = readers.json_array(spark, f"{path}/shards/*", schema).where(accepted)
    special = readers.json_array(spark, f"{path}/special/*", schema).withColumns({"class_name": F.lit("C-5"), "source": F.lit("special"), "pool": F.lit(None).cast("string")})
    both = pool.unionByName(special).withColumn("pool", F.coalesce("pool", F.lit("foreground_pool")))
    return both.groupBy("class_name", "source", "pool").agg(F.count("*").alias("crops"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


@query("select 0::bigint as missing, count(*) as present from nation")
def missing_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest that isn't there yet is an empty table; one that is, is read."""
    path = new_path(spark, "manifest")
    schema = "n_nationkey int, n_name string"
    before = readers.json_lines(spark, path, schema, missing_ok=True).agg(F.count("*").alias("missing")).first()["missing"]
    table(spark, sf_dir, "nation").select("n_nationkey", "n_name").write.json(path)
    return readers.json_lines(spark, path, schema, missing_ok=True).agg(F.lit(before).alias("missing"), F.count("*").alias("present"))


_COCO_SQL = """with a as (select c_custkey as id, c_mktsegment as segment, c_name || '.jpg' as name, o_orderkey as ann, left(o_orderpriority, 1)::int as category
  from customer join orders on o_custkey = c_custkey where c_custkey % 10 <> 3 and left(o_orderpriority, 1)::int <= 4),
g as (select id, segment, name, count(*) as boxes, count(*) filter (category <= 2) as hits from a group by all)"""


@query(_COCO_SQL + " select segment, count(*) as images, sum(boxes)::bigint as boxes, sum(hits)::bigint as hits from g where hits >= 2 and name like 'Customer#0000000%' group by segment")
def coco_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images with at least two wanted objects from COCO files: unknown categories dropped,
    images without a file dropped, file names guarded by a prefix, files listed as ids. A segment is an inventory
    of as many files as its rows need."""
    path = new_path(spark, "coco")
    customer = table(spark, sf_dir, "customer")
    image = F.struct(F.col("c_custkey").alias("id"), F.concat("c_name", F.lit(".jpg")).alias("file_name"), F.lit(100).alias("width"), F.lit(100).alias("height"))
    orders = table(spark, sf_dir, "orders").join(customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment")), "o_custkey")
    box = F.array(F.lit(1.5), F.lit(2.0), F.col("o_totalprice") % 50, F.lit(4.0))
    annotation = F.struct(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("image_id"), F.substring("o_orderpriority", 1, 1).cast("int").alias("category_id"), box.alias("bbox"))
    names = F.array(*(F.struct(F.lit(i).alias("id"), F.lit(n).alias("name")) for i, n in ((1, "airplane"), (2, "plane"), (3, "ship"), (4, "car"))))
    _coco_files(customer.select(F.col("c_mktsegment").alias("segment"), image.alias("image")), orders.select("segment", annotation.alias("annotation")), names, path, "segment")
    _text(customer.where("c_custkey % 10 <> 3"), F.concat("c_name", F.lit(".jpg")), f"{path}-files")
    files = readers.id_list(spark, f"{path}-files", "file_name")
    found = readers.boxed_images(*readers.coco(spark, f"{path}/*", r"/segment=([^/]+)/"), ["airplane", "plane"], 2, files, "Customer#0000000")
    return found.groupBy(F.url_decode("file").alias("segment")).agg(F.count("*").alias("images"), F.sum("boxes").alias("boxes"), F.sum("hits").alias("hits"))


_POINT_SQL = "least(greatest(((p_partkey * {k}) % 104 - 2)::float / 100::float, 0::float), 1::float)::double"
_POINTS = (3, 5, 7, 11, 13, 17, 19, 23)


def _points(shift: int = 0) -> Column:
    """Eight coordinates from -0.02 to 1.01, as text of two decimals."""
    return F.array_join(F.array(*(F.format_string("%.2f", ((F.col("p_partkey") * k) % 104 - 2 + shift) / 100) for k in _POINTS)), " ")


@query("select p_brand as image, count(*) as boxes, count(distinct p_size % 20) as classes, string_agg(p_size % 20 || ' ' || " + " || ' ' || ".join(f"printf('%.6f', {_POINT_SQL.format(k=k)})" for k in _POINTS) + ", '|' order by p_size % 20, " + " || ' ' || ".join(f"printf('%.6f', {_POINT_SQL.format(k=k)})" for k in _POINTS) + ") as lines from (select *, row_number() over (partition by p_brand order by p_size % 20, p_partkey) as rn from part) where rn <= 5 group by p_brand")
def strict_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Oriented boxes under the strict policy: clipped to the image and written with six
    decimals; the first five of each image."""
    path = new_path(spark, "labels")
    rank = F.expr("row_number() over (partition by p_brand order by p_size % 20, p_partkey)")
    first = table(spark, sf_dir, "part").withColumn("rn", rank).where("rn <= 5").withColumn("image", F.translate("p_brand", "#", "_"))
    _text(first, F.concat_ws("  ", (F.col("p_size") % 20).cast("string"), _points(), F.lit(" ")), path, "image")
    found = readers.oriented_boxes(readers.label_lines(spark, f"{path}/*", r"/image=([^/]+)/"), "strict")
    line = F.struct("class_id", readers.label_line(F.col("class_id"), F.col("points")).alias("line"))
    # lines of one class stand in the file's order; here that of their text is taken on both sides
    rows = found.groupBy(F.translate("image", "_", "#").alias("image")).agg(F.count("*").alias("boxes"), F.count_distinct("class_id").alias("classes"), F.array_sort(F.collect_list(line)).alias("l"))
    return rows.select("image", "boxes", "classes", F.array_join(F.transform("l", lambda x: x["line"]), "|").alias("lines"))


@query("select p_brand as image, count(*) filter (p_size % 7 <> 0 and p_size < 20) as lenient, count(*) filter (p_size % 20 in (1, 3, 5)) as mapped from part group by p_brand")
def label_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files under two policies: lenient skips lines with a missing field, letters or
    an unknown class; mapped skips unmapped classes before it looks at the fields."""
    path = new_path(spark, "labels")
    part = table(spark, sf_dir, "part").withColumn("image", F.translate("p_brand", "#", "_"))
    broken = F.when(F.col("p_size") % 14 == 0, F.concat_ws(" ", F.col("p_size").cast("string"), _points(), F.lit("9"))).when(F.col("p_size") % 7 == 0, F.lit("7 x y"))
    _text(part, F.coalesce(broken, F.concat_ws(" ", F.col("p_size").cast("string"), _points())), f"{path}/a", "image")
    mapped = F.when((F.col("p_size") % 20).isin(1, 3, 5), F.concat_ws(" ", (F.col("p_size") % 20).cast("string"), _points())).otherwise(F.concat_ws(" ", (F.col("p_size") % 20).cast("string"), F.lit("junk")))
    _text(part, F.when(F.col("p_partkey") % 50 == 0, F.concat(mapped, F.lit("\n\n"))).otherwise(mapped), f"{path}/b", "image")
    a = readers.oriented_boxes(readers.label_lines(spark, f"{path}/a/*", r"/image=([^/]+)/"), "lenient").select("image", F.lit(1).alias("lenient"), F.lit(0).alias("mapped"))
    b = readers.oriented_boxes(readers.label_lines(spark, f"{path}/b/*", r"/image=([^/]+)/"), "mapped", mapping={1: "A", 3: "B", 5: "C"}).select("image", F.lit(0).alias("lenient"), F.lit(1).alias("mapped"))
    counted = a.unionByName(b).groupBy("image").agg(F.sum("lenient").alias("lenient"), F.sum("mapped").alias("mapped"))
    every = part.select("image").distinct().join(counted, "image", "left")
    return every.select(F.translate("image", "_", "#").alias("image"), F.coalesce("lenient", F.lit(0)).alias("lenient"), F.coalesce("mapped", F.lit(0)).alias("mapped"))


@query("""
with b as (select 'P' || s_nationkey as source, (s_nationkey * 512)::double as left_, 256.0::double as top, (s_suppkey % 500)::double as x, (s_suppkey * 7 % 450)::double as y, 8 + s_suppkey % 30 as w from supplier where s_suppkey % 3 <> 0),
k as (select source, round_even((left_ + x + w / 2.0) / 8, 0)::int as cx, round_even((top + y + 5) / 8, 0)::int as cy, x, y from b)
select source, count(*) as planes, count(distinct (cx, cy)) as cells, min(cx) as least, max(cy) as most from k group by source
""")
def tile_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polygons of picture tiles in the picture's coordinates, offsets from the files' names,
    and how many 8-pixel cells their centres take."""
    path = new_path(spark, "tiles")
    s = table(spark, sf_dir, "supplier")
    x, y, w = F.col("s_suppkey") % 500, F.col("s_suppkey") * 7 % 450, 8 + F.col("s_suppkey") % 30
    name = F.when(F.col("s_suppkey") % 3 == 0, "ship").otherwise("plane")
    line = F.concat_ws(" ", *(c.cast("string") for c in (x + w, y, x, y + 3, x, y + 10, x + w, y + 10)), name, F.lit("0"))
    _text(s.withColumn("tile", F.format_string("P%d__1__%d___256", "s_nationkey", F.col("s_nationkey") * 512)), F.when(F.col("s_suppkey") % 50 == 0, F.concat(line, F.lit("\nimagesource:x"))).otherwise(line), path, "tile")
    found = readers.tile_polygons(spark, f"{path}/*", r"/tile=([^/]+)/").where("class_name = 'plane'")
    cell = lambda a, b: F.bround((F.col(a) + F.col(b)) / 2 / 8).cast("int")
    return found.withColumns({"cx": cell("x1", "x2"), "cy": cell("y1", "y2")}).groupBy("source").agg(
        F.count("*").alias("planes"), F.count_distinct("cx", "cy").alias("cells"), F.min("cx").alias("least"), F.max("cy").alias("most")
    )


@query("select n_name as name, count(*) as images, round(sum(s_acctbal), 2) as balance from supplier join nation on s_nationkey = n_nationkey group by n_name")
def csv_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a dimension that comes as CSV with a header."""
    path = new_path(spark, "locations")
    table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("loc_id"), "n_name").write.option("header", "true").csv(path)
    places = readers.csv_dimension(spark, path, "loc_id int, n_name string")
    s = table(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "loc_id")
    return s.join(F.broadcast(places), "loc_id").groupBy(F.col("n_name").alias("name")).agg(F.count("*").alias("images"), F.round(F.sum("s_acctbal"), 2).alias("balance"))


@query("select p_type as class_name, 1::bigint as files, count(*) as crops from part group by p_type")
def class_folder_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files below class folders, filtered by suffix; contents are read for the count only."""
    path = new_path(spark, "folders")
    part = table(spark, sf_dir, "part").withColumnRenamed("p_type", "class_name")
    part.repartition("class_name").select(F.col("p_name").alias("value"), "class_name").write.partitionBy("class_name").text(path)
    files = readers.class_folders(spark, path, (".txt",)).select(F.regexp_extract("class_name", "=(.*)$", 1).alias("class_name"), "path")
    lines = readers.label_lines(spark, f"{path}/*", r"/class_name=([^/]+)/").groupBy(F.col("image").alias("class_name")).agg(F.count("*").alias("crops"))
    return files.groupBy("class_name").agg(F.count("*").alias("files")).join(lines, "class_name")


@query("""
select 'SIMD_validation/' || c_custkey as scene, (c_custkey % 40)::double as x1, 3.0::double as y1, (c_custkey % 40 + 25)::double as x2, (3 + c_nationkey)::double as y2
from customer where c_custkey % 3 = 1 and c_nationkey <> 7
""")
def nested_box_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects of one split from an inventory with nested boxes, where the image's file exists."""
    path = new_path(spark, "inventory")
    c = table(spark, sf_dir, "customer")
    box = F.struct((F.col("c_custkey") % 40).alias("xmin"), F.lit(3).alias("ymin"), (F.col("c_custkey") % 40 + 25).alias("xmax"), (3 + F.col("c_nationkey")).alias("ymax"))
    split = F.when(F.col("c_custkey") % 3 == 1, "held_out").otherwise("train")
    rows = c.select(F.col("c_custkey").cast("string").alias("image_stem"), split.alias("source_split"), box.alias("bbox"), F.col("c_nationkey").alias("shard"))
    _array_file(rows, ["image_stem", "source_split", "bbox"], path, "shard")
    _text(c.where("c_nationkey <> 7"), F.concat(F.col("c_custkey").cast("string"), F.lit(".jpg")), f"{path}-files")
    files = readers.id_list(spark, f"{path}-files").select(F.regexp_extract("id", r"^(.*)\.jpg$", 1).alias("image_stem"))
    schema = "image_stem string, source_split string, bbox struct<xmin: double, ymin: double, xmax: double, ymax: double>"
    held = readers.json_array(spark, f"{path}/*", schema).where("source_split = 'held_out'").join(files, "image_stem", "left_semi")
    return held.select(F.concat(F.lit("SIMD_validation/"), "image_stem").alias("scene"), F.col("bbox.xmin").alias("x1"), F.col("bbox.ymin").alias("y1"), F.col("bbox.xmax").alias("x2"), F.col("bbox.ymax").alias("y2"))


@query("select c_mktsegment as segment, count(*) as open from customer where c_custkey % 4 <> 1 group by 1")
def excluded_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a list of ids, one a line, doesn't name."""
    path = new_path(spark, "ids")
    c = table(spark, sf_dir, "customer")
    _text(c.where("c_custkey % 4 = 1"), F.when(F.col("c_custkey") % 8 == 1, F.concat("c_name", F.lit(" \n"))).otherwise(F.col("c_name")), path)
    return c.join(readers.id_list(spark, path, "c_name"), "c_name", "left_anti").groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count("*").alias("open"))


@query("select n_regionkey as archive, count(*) as boxes, sum(n_nationkey)::bigint as classes, count(distinct n_name) as members from nation group by 1")
def zipped_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label lines of the members of zip archives, one archive a region."""
    import io
    import zipfile

    def packed(key, rows):
        import pandas as pd

        body = io.BytesIO()
        with zipfile.ZipFile(body, "w", zipfile.ZIP_DEFLATED) as z:
            for r in rows.itertuples():
                z.writestr(f"{r.n_name}.txt", f"{r.n_nationkey} 0.5 0.5 0.1 0.2\n\n")
                z.writestr(f"{r.n_name}.jpg", b"")
        return pd.DataFrame({"path": [str(key[0])], "content": [body.getvalue()]})

    path = new_path(spark, "archives")
    # a region holds a few nations
    table(spark, sf_dir, "nation").groupBy("n_regionkey").applyInPandas(packed, "path string, content binary").write.parquet(path)
    lines = readers.zip_lines(spark.read.parquet(path))
    fields = F.split("line", " ")
    return lines.groupBy(F.col("path").cast("int").alias("archive")).agg(F.count("*").alias("boxes"), F.sum(F.get(fields, F.lit(0)).cast("int")).alias("classes"), F.count_distinct("member").alias("members"))


@query("select p_type as class_name, count(*) as files from part where not (p_size % 3 = 0 and p_partkey % 2 = 0) group by 1")
def files_to_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a listing that aren't there in the listed size: what a resumed download takes."""
    part = table(spark, sf_dir, "part").select(F.concat("p_type", F.lit("/"), "p_partkey").alias("path"), F.col("p_size").alias("size"), "p_partkey", "p_type")
    present = part.where("size % 3 = 0").select("path", F.when(F.col("p_partkey") % 2 == 0, F.col("size")).otherwise(0).alias("size"))
    return readers.to_fetch(part, present).groupBy(F.col("p_type").alias("class_name")).agg(F.count("*").alias("files"))


@query("""
select s_name as site, strftime(o_orderdate, '%Y-%m-%d') as day, o_orderkey as item, round(s_acctbal / 100 - 0.0015, 6) as west, round(s_acctbal / 100 + 0.0015, 6) as east, strftime(o_orderdate, '%Y') = '1997' as in_year
from supplier join orders on o_custkey % 50 = s_suppkey where s_suppkey < 5
""")
def site_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items found for each of a few sites, the box asked for around the site, by site and date."""
    from tessella.functions.geometry import around

    sites = table(spark, sf_dir, "supplier").where("s_suppkey < 5").withColumn("lon", F.col("s_acctbal") / 100)
    items = table(spark, sf_dir, "orders").withColumn("s_suppkey", F.col("o_custkey") % 50)
    box = around(F.col("lon"), F.lit(0.0), 0.0015, 0.0012)
    jobs = items.join(F.broadcast(sites), "s_suppkey").withColumn("day", F.substring(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), 1, 10))
    rows = jobs.select(F.col("s_name").alias("site"), "day", F.col("o_orderkey").alias("item"), F.round(box["west"], 6).alias("west"), F.round(box["east"], 6).alias("east"), F.startswith("day", F.lit("1997")).alias("in_year"))
    return rows.orderBy("site", "day", "item")


@query("""
select o_custkey as place, coalesce(arg_min(o_orderkey, o_orderkey) filter (o_orderstatus = 'F'), -1) as source, coalesce(year(arg_min(o_orderdate, o_orderkey) filter (o_orderstatus = 'F')), 0)::int as source_year from orders group by 1
""")
def first_catalogue_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a place's catalogue features the first of the wanted category, or a default."""
    feature = F.struct(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") == "F", 1).otherwise(2).alias("category"), F.year("o_orderdate").alias("year"))
    places = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("place")).agg(F.array_sort(F.collect_list(feature)).alias("features"))
    source = readers.first_of_category(F.col("features"), 1)
    return places.select("place", F.coalesce(source["id"], F.lit(-1)).alias("source"), F.coalesce(source["year"], F.lit(0)).alias("source_year"))
