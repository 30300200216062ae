"""What the encoder holds and what written tables leave behind."""

import pyarrow as pa
from pyspark.sql import functions as F

from leadlens.llm import sentencepiece_sampling
from leadlens.llm.common import written

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def test_encoder_holds_short_runs():
    texts = pa.array(["x" * 1000] * 999 + [None, "", "y" * 1_000_000, "z"])
    runs = list(sentencepiece_sampling._runs(texts))
    assert [i for a, b in runs for i in range(a, b)] == list(range(len(texts)))
    sizes = [sum(len(x or "") // 5 for x in texts[a:b].to_pylist()[:-1]) for a, b in runs]
    assert max(sizes) < sentencepiece_sampling.UNITS <= 20_000  # beyond it only the last text of a run
    assert list(sentencepiece_sampling._runs(pa.array([], pa.string()))) == []


def test_encoded_docs_in_small_batches(spark):
    docs = spark.createDataFrame([(i, f"some text {i}") for i in range(40)] + [(None, None)], "doc_id long, text string")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    out = sentencepiece_sampling.encoded_docs(docs)
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
    assert out.select("doc_id").distinct().count() == 41
    assert all("leadlens-encoded" in f for f in out.inputFiles()) and out.inputFiles()


def test_written_leaves_no_shuffle_files(spark):
    state = spark.conf.get(CLEANUP, None)
    seen = []

    def look(batches):
        for b in batches:
            yield b

    df = spark.range(1000).repartition(4).mapInArrow(look, "id long").groupBy((F.col("id") % 7).alias("k")).count()
    real = type(df.write).parquet
    try:
        type(df.write).parquet = lambda w, *a, **k: (seen.append(spark.conf.get(CLEANUP, None)), real(w, *a, **k))[1]
        out = written(df, "freed")
    finally:
        type(df.write).parquet = real
    assert seen == ["true"] and spark.conf.get(CLEANUP, None) == state
    assert out.count() == 7
