import random

import corpus_pipeline
from pyspark.sql import functions as F

from .helpers import shingles, write


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n)) + "."


def test_pipeline_on_planted_cases(spark, tmp_path):
    rng = random.Random(1)
    folder = f"file://{tmp_path}"
    clean = [(i, prose(rng, 60) + "\n" + prose(rng, 60)) for i in range(120)]
    bad = [(200 + i, prose(rng, 80).upper().replace(" ", "!! ")) for i in range(40)]
    passage = prose(rng, 60)
    words = clean[3][1].split(" ")
    planted = {
        300: clean[0][1],  # a copy
        301: " ".join([*words[:30], "other", *words[31:90], "other", *words[91:]]),  # a near copy, changed in both lines
        302: prose(rng, 80) + "\n" + passage,
        303: prose(rng, 80) + "\n" + passage,  # repeats a line of 302
        304: prose(rng, 40) + " " + "leak " * 3 + " ".join(f"question{i}" for i in range(30)),
        305: None,
        306: "",
    }
    rows = [(k, t, "en", "s", len(t or ""), "extra", "x") for k, t in [*clean, *bad, *planted.items(), (None, prose(rng, 70))]]
    schema = "doc_id long, text string, lang string, source string, n_chars long, __id string, __score string"
    write(spark.createDataFrame(rows, schema), folder, "documents")
    labels = [(k, 1, 0) for k, _ in clean] + [(k, 0, 0) for k, _ in bad]
    write(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), folder, "labels")
    write(spark.createDataFrame([(1, " ".join(f"question{i}" for i in range(30)))], "item_id long, text string"), folder, "benchmark")

    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, folder)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert found.columns == docs.columns
        write(found, folder, name)
        docs = spark.read.parquet(f"{folder}/{name}.parquet")
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
    ids = {k for k, _ in clean}
    assert not kept["quality_classifier"] & {k for k, _ in bad} and ids <= kept["quality_classifier"]
    assert 300 not in kept["line_dedup"] and ids <= kept["line_dedup"]
    second = spark.read.parquet(f"{folder}/line_dedup.parquet").filter("doc_id = 303").first()
    assert passage not in second.text and second.n_chars == len(second.text)
    near = kept["minhash_near_dedup"]
    sets = {k: shingles(t) for k, t in [*clean, *planted.items()]}
    assert len(sets[301] & sets[3]) >= 0.8 * len(sets[301] | sets[3]) and 301 not in near and ids <= near
    assert 304 in near and 304 not in kept["benchmark_decontamination"]
    last = kept["sentencepiece"]
    assert last == kept["benchmark_decontamination"] and ids <= last and None in last
    assert docs.filter("not lossless").count() == 0 and docs.filter(F.col("pieces").isNull() & (F.col("doc_id") != 305)).count() == 0


def test_rows_with_null_or_repeated_ids_are_judged_on_their_own(spark, tmp_path):
    rng = random.Random(2)
    folder = f"file://{tmp_path}"
    item = " ".join(f"question{i}" for i in range(30))
    write(spark.createDataFrame([(1, item)], "item_id long, text string"), folder, "benchmark")
    texts = [prose(rng, 60) for _ in range(9)]
    near = " ".join([*texts[0].split(" ")[:58], "other"])
    groups = [
        [(5, texts[0]), (None, texts[0]), (None, near), (9, texts[0])],  # copies with and without an id
        [(None, texts[1])] * 40,
        [(20, texts[2])] * 40,
        [(30, texts[3]), (31, texts[3]), (31, texts[4])],  # 31 is a copy once, and a text of its own
        [(32, texts[5]), (32, texts[6])],
        [(40, "")] * 3, [(40, None)] * 3, [(41, "")],
        [(None, "")], [(None, "")], [(None, None)],
        [(50, texts[7])], [(None, texts[8])],
    ]
    leaking = [(50, prose(rng, 20) + " " + item), (None, prose(rng, 20) + " " + item)]
    rows = [r for g in groups for r in g] + leaking
    rng.shuffle(rows)
    rows = [(k, t, "en", "s", len(t or ""), k) for k, t in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, __row long").repartition(5)
    stages = dict(corpus_pipeline.STAGES)
    apart = stages["minhash_near_dedup"](spark, docs, folder)
    assert apart.columns == docs.columns and apart.filter("not doc_id <=> __row").count() == 0
    left = sorted(((r.doc_id or 0, r.text or "") for r in apart.collect()))
    want = [(5, texts[0]), (0, texts[1]), (20, texts[2]), (30, texts[3]), (31, texts[4]), (32, texts[5]), (32, texts[6])]
    want += [(40, ""), (40, ""), (41, ""), (0, ""), (0, ""), (0, ""), (50, texts[7]), (0, texts[8])]
    assert left == sorted(want + [(k or 0, t) for k, t in leaking])
    clean = stages["benchmark_decontamination"](spark, apart, folder)
    assert clean.columns == docs.columns
    assert sorted(((r.doc_id or 0, r.text or "") for r in clean.collect())) == sorted(want)


def test_run_gives_the_rows_of_the_stages(spark):
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert found.filter("lossless").count() == found.count() > 0
