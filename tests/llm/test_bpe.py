"""Against the public library for any chunk size, and the way back."""

from __future__ import annotations

import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from coursetide.llm import bpe

from .data import awkward, documents

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(open(PATH, "rb").read(), PATTERN)


@pytest.mark.parametrize(("chunk", "overlap"), [(1 << 16, 1 << 10), (1000, 50), (64, 8), (7, 3)])
def test_equals_the_library(spark, library, chunk, overlap):
    rows = awkward() if chunk > 100 else [(i, (t or "")[:900]) for i, t in awkward()]
    rows += [(20, " \n\n  x" * 100), (21, "we're'll 've" * 70), (22, "1234567" * 100), (23, "don't  \n stop!? " * 60)]
    docs = documents(spark, rows, clash=True)
    encoded = bpe.encode(docs, PATH, PATTERN, chunk=chunk, overlap=overlap)
    assert encoded.columns == ["doc_id", "n_tokens", "ids"]
    back = bpe.decode(encoded, PATH).collect()
    got = sorted((str(r.doc_id), r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in back)
    want = []
    for i, text in rows:
        ids = library.encode_ordinary(text or "")
        want.append((str(i), len(ids), np.array(ids, "<u4").tobytes(), (text or "").encode()))
    assert got == sorted(want)


def test_short_list_pattern_equals_the_whole_one(vocabulary):
    draw = random.Random(5)
    signs = "".join(map(chr, range(256))) + "  '''lredstm\n\x1c\x85"
    for _ in range(3000):
        text = "".join(draw.choices(signs, k=30))
        assert vocabulary.fast.findall(text) == vocabulary.pattern.findall(text)


def test_long_and_short_merges_agree(vocabulary, library):
    draw = random.Random(6)
    for n in (2, 40, 99, 100, 101, 300):
        text = "".join(draw.choices("abcdé", k=n))
        assert np.frombuffer(vocabulary.piece(text), "<u4").tolist() == library.encode_ordinary(text)
        assert b"".join(vocabulary._many(text.encode())) == text.encode()


def test_no_rows_and_bad_arguments(spark):
    docs = documents(spark, [])
    assert bpe.decode(bpe.encode(docs, PATH, PATTERN), PATH).count() == 0
    with pytest.raises(ValueError, match="overlap"):
        bpe.encode(docs, PATH, PATTERN, overlap=2)


def test_decode_keeps_columns_and_takes_null_ids(spark):
    row = spark.range(1).select(F.lit(None).cast("binary").alias("ids"), F.lit("x").alias("decoded"), F.lit(1).alias("kept"))
    [got] = bpe.decode(row, PATH).collect()
    assert (got.kept, bytes(got.decoded)) == (1, b"")
