"""What the pipeline's stages leave in the Python workers, which Spark keeps between tasks."""

import os
import re
import time

import pyarrow as pa
import public_tokenizers
import tokenizers

from gavelframe.llm import near_dedup, packing, repeats
from pyspark.sql import functions as F


def held(spark):
    """MB of anonymous memory of the workers that take part, by pid."""

    def report(batches):
        for _ in batches:
            time.sleep(0.3)
            with open("/proc/self/smaps_rollup") as file:
                kb = re.search(r"\nPss_Anon:\s+(\d+)", file.read())[1]
            yield pa.RecordBatch.from_arrays([pa.array([os.getpid()]), pa.array([int(kb) / 1024])], ["pid", "mb"])

    return {r.pid: r.mb for r in spark.range(8).repartition(8).mapInArrow(report, "pid long, mb double").collect()}


def test_idle_workers_keep_nothing_of_the_texts(spark):
    before = held(spark)
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.expr("concat_ws(' ', transform(sequence(1, 400), k -> sha1(cast(id * 1000 + k as string))))").alias("text")).repartition(2)
    near_dedup.signatures(docs).write.format("noop").mode("overwrite").save()
    repeats.written(docs, lambda every: every.select("doc_id", "n_removed"), "kept")
    grown = {pid: mb - before.get(pid, min(before.values())) for pid, mb in held(spark).items()}
    assert max(grown.values()) < 40, grown


def test_the_tokenizers_library_is_loaded_for_texts_that_need_it_only(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)
    monkeypatch.setattr(packing, "_TOKENIZERS", {})
    monkeypatch.setattr(tokenizers, "Tokenizer", None)
    encode = packing.worker_tokenizer(path, public_tokenizers.PATTERN)
    want = lambda text: b"".join(i.to_bytes(4, "little") for i in library.encode(text, add_special_tokens=False).ids)
    assert encode("a plain text") == want("a plain text")
    monkeypatch.undo()
    added = [x.content for x in library.get_added_tokens_decoder().values()]
    assert sorted(packing.added_tokens(path)) == sorted(added)
    for token in added:
        assert encode(f"a {token} b") == want(f"a {token} b")
