"""The pipeline's stages on a small corpus with planted cases."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from tesserae.llm.registry import tokenizer_path


def test_stages_and_run(spark, tmp_path):
    rnd = random.Random(3)
    vocabulary = ["".join(rnd.choice("aeiourstlnmd") for _ in range(rnd.randint(3, 9))) for _ in range(900)]
    prose = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    rows = [(k, prose(rnd.randint(60, 120)), "en" if k % 2 else "fr", "s", 0) for k in range(40)]
    rows = [(k, t + ("\nshared footer line of site" if k < 10 else ""), lang, s, n) for k, t, lang, s, n in rows]
    passage = prose(30)
    rows += [(100, rows[3][1], "en", "s", 0), (101, prose(40) + " " + passage + " " + prose(40), "en", "s", 0), (102, None, "en", "s", 0), (103, "123 456", "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for (_, stage), last in zip(corpus_pipeline.STAGES, [False] * 4 + [True]):
        docs = corpus_pipeline.cut(stage(spark, docs, str(tmp_path)))
        if not last:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            assert docs.where(F.col("text").isNotNull() & (F.col("n_chars") > 0) & (F.col("n_chars") != F.length("text"))).count() == 0
        kept.append({r[0] for r in docs.select("doc_id").collect()})
    assert kept[0] >= set(range(40)) | {100, 101} and not kept[0] & {102, 103}
    assert kept[1] == kept[0] and kept[2] == kept[1] - {100} and kept[3] == kept[2] - {101} and kept[4] == kept[3]
    assert {r[0] for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").collect()} == kept[4]
    assert tokenizer_path().endswith(".json")
