"""Readers and writers of files on cases whose answers can be read off."""

import io
import json
import tarfile
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F
from tessella.plans import catalog, formats
from tessella.sources import readers, sinks
from tessella.streaming.watch import kept_in_memory, wait_for


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_json_lines(spark, tmp_path):
    write(tmp_path / "shards/a/manifest.jsonl", '{"id": 1}\n\n   \n{"id": 2, "x": "é"}\n')
    write(tmp_path / "shards/b/manifest.jsonl", "")
    write(tmp_path / "shards/c/manifest.jsonl", '{"id": 3}')
    found = readers.json_lines(spark, f"{tmp_path}/shards/*/manifest.jsonl", "id int, x string", r"/shards/([^/]+)/")
    assert sorted((r.id, r.x, r.shard) for r in found.collect()) == [(1, None, "a"), (2, "é", "a"), (3, None, "c")]
    assert readers.json_lines(spark, f"{tmp_path}/none", "id int", r"/(x)/", missing_ok=True).columns == ["id", "shard"]
    bad = readers.json_lines(spark, write(tmp_path / "bad.jsonl", '{"id": 1}\n{"id": \n'), "id int")
    with pytest.raises(Exception):
        bad.collect()


def test_an_inventory_in_several_coco_files(spark, tmp_path):
    names = [{"id": 1, "name": "plane"}, {"id": 2, "name": "ship"}]
    image = lambda i: {"id": i, "file_name": f"{i}.jpg", "width": 9, "height": 9}
    box = lambda i, of, c: {"id": i, "image_id": of, "category_id": c, "bbox": [1, 2, 3, 4]}
    write(tmp_path / "at=a/1.json", json.dumps({"images": [image(1)], "annotations": [box(1, 1, 1), box(2, 2, 2)], "categories": names}))
    write(tmp_path / "at=a/2.json", json.dumps({"images": [image(2)], "annotations": [box(3, 1, 1), box(4, 1, 2), box(5, 1, 3)], "categories": names}))
    write(tmp_path / "at=b/1.json", json.dumps({"annotations": [box(1, 1, 1)], "images": [image(1)], "categories": names}))
    found = lambda *at: sorted((r.file[-1], r.id, r.boxes, r.hits) for r in readers.boxed_images(*readers.coco(spark, f"{tmp_path}/*", *at), ["plane"], 1).collect())
    assert found(r"/at=([^/]+)/") == [("a", 1, 3, 2), ("b", 1, 1, 1)]
    assert found() == [("n", 1, 1, 1)] * 2  # ids that are a file's own


def test_a_coco_file_holds_few_rows_of_a_frequent_segment_and_image(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(formats, "_DOCUMENT_ROWS", 40, raising=False)
    monkeypatch.setattr(formats, "new_path", lambda spark, name: f"{tmp_path}/{name}")
    spark.range(95).selectExpr("id as c_custkey", "printf('Customer#%09d', id) as c_name", "'A B' as c_mktsegment").write.parquet(f"{tmp_path}/customer.parquet")
    orders = spark.range(900).selectExpr("id as o_orderkey", "if(id < 500, 7, id % 95) as o_custkey", "concat(1 + id % 5, '-X') as o_orderpriority", "id * 1.5d as o_totalprice")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    found = catalog.queries()["coco_inventory"](spark, str(tmp_path)).collect()
    kept = [(o.o_custkey, int(o.o_orderpriority[0])) for o in orders.collect() if o.o_custkey % 10 != 3 and o.o_orderpriority[0] != "5"]
    images = [i for i in range(95) if sum(k == i and c <= 2 for k, c in kept) >= 2]
    assert list(map(tuple, found)) == [("A B", len(images), sum(k in images for k, _ in kept), sum(k in images and c <= 2 for k, c in kept))]
    documents = [json.loads(p.read_text()) for p in (tmp_path / "coco").rglob("part-*")]
    assert sum(len(d["images"]) for d in documents) == 95 and sum(len(d["annotations"]) for d in documents) == 900
    assert max(len(d["images"]) + len(d["annotations"]) for d in documents) <= 80


def test_label_policies(spark, tmp_path):
    good = "3 " + " ".join(["0.5"] * 7) + " 1.04"
    path = write(tmp_path / "labels/im1/l.txt", f"{good}\n\n{good}  \n")
    strict = readers.oriented_boxes(readers.label_lines(spark, path), "strict").collect()
    assert [(r.image, r.class_id, r.points[0], r.points[7]) for r in strict] == [("im1", 3, 0.5, 1.0)] * 2
    for line in ("3 1 2", "25" + good[1:], good.replace("1.04", "1.06"), good.replace("1.04", "nan"), good.replace("3 ", "x ")):
        lines = spark.createDataFrame([("i", line)], "image string, line string")
        with pytest.raises(Exception):
            readers.oriented_boxes(lines, "strict").collect()
        n = readers.oriented_boxes(lines, "lenient").count()
        assert n == (1 if "1.06" in line else 0)  # lenient keeps what only strays too far
    lines = spark.createDataFrame([("i", x) for x in ("", "9 junk", good)], "image string, line string")
    assert [r.class_name for r in readers.oriented_boxes(lines, "mapped", mapping={3: "C"}).collect()] == ["C"]
    with pytest.raises(Exception):
        readers.oriented_boxes(lines, "mapped", mapping={3: "C", 9: "D"}).collect()


def test_listing_follows_links_and_tries_again(spark):
    failures = iter([1, 1, 0, 0, 0, 0, 0])

    class Pages(BaseHTTPRequestHandler):
        def do_GET(self):
            n = int(self.path.rsplit("=", 1)[1])
            if n == 1 and next(failures):
                self.send_error(503)
                return
            base = f"http://127.0.0.1:{self.server.server_port}"
            if self.path.startswith("/list"):
                body = [{"k": n}]
                link = f'<{base}/list?p={n + 1}>; rel="next"' if n < 2 else ""
            else:
                body, link = {"items": [{"k": n}, {"k": "é"}], "links": {"next": f"{base}/page?p={n + 1}"} if n < 3 else {}}, ""
            data = json.dumps(body).encode()
            self.send_response(200)
            if link:
                self.send_header("Link", link)
            self.end_headers()
            self.wfile.write(data)

        def do_POST(self):
            self.send_response(204)
            self.end_headers()

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Pages)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}"
    try:
        found = [(r.page, json.loads(r.item)["k"]) for r in readers.paged_listing(spark, f"{url}/page?p=0").collect()]
        assert found == [(p, k) for p in range(4) for k in (p, "é")]
        assert [json.loads(r.item)["k"] for r in readers.paged_listing(spark, f"{url}/list?p=0").collect()] == [0, 1, 2]
        assert sinks.notify(f"{url}/reload")
    finally:
        server.shutdown()
        server.server_close()
    assert not sinks.notify(f"{url}/reload", 0.5)


def test_files_and_tables_are_replaced_whole(spark, tmp_path):
    path = f"{tmp_path}/state.json"
    for body in (b"one", b"two\xc3\xa9"):
        sinks.replace_file(spark, path, body)
        assert (tmp_path / "state.json").read_bytes() == body and not (tmp_path / "state.json.tmp").exists()
    for n in (3, 5):
        sinks.replace_table(spark.range(n), f"{tmp_path}/table")
        assert spark.read.parquet(f"{tmp_path}/table").count() == n
    assert sorted(p.name for p in tmp_path.iterdir() if p.name.startswith("table")) == ["table"]


def test_views_show_one_place(spark, tmp_path):
    for n in (1, 2):
        spark.range(n).write.parquet(f"{tmp_path}/v{n}")
    assert sinks.verified_view(spark, "release_view", f"{tmp_path}/v1").count() == 1
    assert sinks.verified_view(spark, "release_view", f"{tmp_path}/v1").count() == 1
    with pytest.raises(RuntimeError):
        sinks.verified_view(spark, "release_view", f"{tmp_path}/v2")
    spark.catalog.dropTempView("release_view")


def test_tar_archives(spark):
    rows = spark.createDataFrame([(i // 3, f"m{i}.txt", f"body {i}") for i in range(7)], "v int, name string, body string")
    found = {}
    for r in sinks.tar_archives(rows, "v", "name", "body").collect():
        with tarfile.open(fileobj=io.BytesIO(r.archive)) as tar:
            found[r.volume] = {m.name: tar.extractfile(m).read().decode() for m in tar.getmembers()}
    assert found == {v: {f"m{i}.txt": f"body {i}" for i in range(7) if i // 3 == v} for v in range(3)}


def test_copies_and_reports(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(1, "a"), (2, None)], "i int, s string")
    assert sinks.verified_copy(df, f"{tmp_path}/copy").count() == 2
    monkeypatch.setattr(sinks, "content_digest", lambda d: (0, id(d)))
    with pytest.raises(RuntimeError):
        sinks.verified_copy(df, f"{tmp_path}/other")
    assert sinks.dataset_yaml("/d", ["a", "b"], {"train": "images/train"}) == "path: /d\ntrain: images/train\nnc: 2\nnames:\n  0: a\n  1: b\n"
    table = sinks.markdown_table([{"c": "x", "n": 1200, "r": 0.5}, {"c": "y", "n": 3, "r": None}], ["c", "n", "r"], ["n"])
    assert table == "| c | n | r |\n|---|---|---|\n| x | 1,200 | 0.50 |\n| y | 3 |  |\n| total | 1,203 |  |\n"
    write(tmp_path / "code/a.py", "x = 1\n")
    assert [f for f, _ in sinks.code_hashes(f"{tmp_path}/code")] == ["a.py"]
    listing = spark.createDataFrame([("a",), ("b",)], "k string")
    assert [r.k for r in sinks.stale(listing, listing.where("k = 'a'"), "k").collect()] == ["b"]


def test_yaml_without_a_path_stays(spark):
    one = spark.createDataFrame([("nc: 1\n",), ("path: a.b\npath: a.b",)], "t string")
    assert [r[0] for r in one.select(sinks.with_yaml_root(F.col("t"), F.lit("/n"))).collect()] == ["nc: 1\n", "path: /n\npath: a.b"]


def test_waiting_for_shards(spark):
    done = iter([set(), {"a"}, {"a", "b"}])
    assert wait_for(lambda: next(done), {"a", "b"}, lambda: True, every=0.01, timeout=5) == {"a", "b"}
    with pytest.raises(RuntimeError, match="b"):
        wait_for(lambda: {"a"}, {"a", "b"}, lambda: False, every=0.01, timeout=5)
    with pytest.raises(TimeoutError):
        wait_for(lambda: set(), {"a"}, lambda: True, every=0.01, timeout=0.05)
    with kept_in_memory(spark.range(5)) as kept:
        assert kept.is_cached and kept.count() == 5
    assert not kept.is_cached
