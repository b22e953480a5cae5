"""What a Python worker holds while it writes token files."""

import public_tokenizers

from cartoloom.llm import common, token_files


def test_encoder_gives_back_the_caches_of_earlier_stages():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        spec = f.read()
    common.word_hashes([b"one", b"two"])
    token_files._CACHE.clear()
    token_files._encoder(spec, "<u2")
    assert not common._WORD_HASH


def test_batches_are_small_while_tokens_are_written(spark, tmp_path):
    docs = spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string")
    token_files.write_tokens(docs, str(tmp_path / "tokens"), public_tokenizers.path("word_bpe_49k.json"))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 4 << 20
    assert token_files.read_tokens(spark, str(tmp_path / "tokens")).count() == 2
