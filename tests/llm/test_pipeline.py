"""The pipeline's stages, each on what the stage before it kept."""

import zlib

import brute_force as brute
import corpus_pipeline
import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tessella.llm import decontam, pii, quality, simhash
from tokenizers import Tokenizer


def test_each_stage_takes_effect(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, before, sf).cache()
        kept[name] = docs.count()
        if name != "packing":
            assert docs.columns == before.columns and 0 < kept[name] <= before.count()
        if name == "near_duplicates":
            groups = simhash.near_duplicate_groups(docs)
            assert groups.select("component_id").distinct().count() == kept[name]
        if name == "decontamination":
            assert decontam.find_overlap(docs, benchmark).where("n_hit > 0").count() == 0
        if name == "personal_data":
            assert all(not pii.find_entities(r.text or "") for r in docs.collect()) and kept[name] == before.count()
    assert kept["packing"] >= kept["personal_data"]
    assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in before.collect()}
    assert corpus_pipeline.ORACLE_SQL is None and 4 <= len(corpus_pipeline.STAGES) <= 5 and quality.THRESHOLD == 0.3


def planted(spark):
    """Documents of the smallest tables with copies, benchmark passages and personal data put in."""
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    good = [t for _, t in docs if t and 300 < len(t) < 3000][:40]
    more = [good[0], good[0], good[1] + " end", good[2], items[0], good[3] + " " + items[1] + " " + good[4], f"{good[5]} {items[2]}", None, "", ""]
    more += [f"{good[6 + i]} reach zorblax u{i}@x.example.com or 4111 1111 1111 1111 {good[12 + i]}" for i in range(5)] + ["zorblax " + good[20]]
    return docs + [(10_000 + i, t) for i, t in enumerate(more)], items


def test_run_against_plain_stages(spark, tmp_path):
    rows, items = planted(spark)
    whole = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    whole.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").collect()}
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()

    # quality: the sample, features and scores by hand; training itself is tested elsewhere
    texts, examples = dict(rows), []
    for i in sorted(labels):
        if i in texts and zlib.crc32(str(i).encode()) % 5:
            counts = np.zeros(quality.BUCKETS)
            for w in (texts[i] or "").split():
                for f in brute.features(w):
                    counts[f] += 1
            w = (texts[i] or "").split()
            counts[0] = sum(a == b for a, b in zip(w, w[1:]))
            at = np.flatnonzero(counts)
            examples.append((at.astype(np.int32), counts[at].astype(np.float32), labels[i]))
    odds = quality.train(examples).astype(float)
    kept = []
    for i, t in rows:
        w = (t or "").split()
        own = [f for x in w for f in brute.features(x)] + [0] * sum(a == b for a, b in zip(w, w[1:]))
        if not own or 1 / (1 + np.exp(-sum(odds[f] for f in own) / len(own))) >= 0.3:
            kept.append((i, t))
    assert len(kept) < len(rows)
    group = brute.near_groups([i for i, _ in kept], [brute.simhash(t) for _, t in kept])
    kept = [(i, t) for i, t in kept if group[i] == i]
    clean = [(i, brute.decontaminated(t, items)) for i, t in kept]
    kept = [(i, c) for (i, t), (_, c) in zip(kept, clean) if c is not None or t is None]
    terms = {w for w, _ in brute.disclosing([t for _, t in kept if t])}
    assert "zorblax" in terms
    kept = {i: brute.masked(t or "", terms) for i, t in kept}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = set()
    for i, t in kept.items():
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 0], "<u4")
        for k in range(0, len(ids), 2048):
            part = ids[k : k + 2048]
            want.add((i, k // 2048, k, len(part), zlib.crc32(part.tobytes())))
    assert {tuple(r)[:5] for r in found} == want and len(found) == len(want)
    places = {}
    for r in found:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for p in places.values():
        ends = [0, *(o + n for o, n in sorted(p))]
        assert [o for o, _ in sorted(p)] == ends[:-1] and ends[-1] <= 2048


def test_empty_tables_pass_through(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where(F.col("doc_id") < 20).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
