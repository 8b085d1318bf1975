"""What a task of the pipeline needs of Python workers, which executors keep with their memory."""

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

from feedloom.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_tokens_need_one_worker_at_a_time(spark, docs):
    made = corpus_pipeline.tokens(spark, docs, "")
    assert made._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


def test_encoded_and_decoded_in_one_pass(docs, none):
    own = byte_bpe.encode(docs, PATH, public_tokenizers.PATTERN)
    two = byte_bpe.decode(own, PATH)
    one = byte_bpe.encode_and_decode(docs, PATH, public_tokenizers.PATTERN)
    assert one.columns == two.columns and one.dtypes == two.dtypes
    rows = lambda frame: sorted(map(repr, frame.withColumn("decoded", F.hex("decoded")).collect()))
    assert rows(one) == rows(two) and one.count() == docs.count()
    assert byte_bpe.encode_and_decode(none, PATH, public_tokenizers.PATTERN).count() == 0
