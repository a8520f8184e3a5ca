import hashlib
import json
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from lexicord.llm import bpe, queries, tokenfiles
from lexicord.llm.shared import shared_folder

ODD = [
    "a<|endoftext|>b I'll 12 345  \n\n x  y \x1c é Ⅷ ١٢ ﬁ ΣΑΣ ​ 😀😀 <|startoftext|>x '''re 'S aaaaaaaa",
    "don't STOP: it's 'twas we'Re 3½ áb ≠ x́",
    "\x0b\x0c\x85  x",
    "***abc###é,ü;ß×÷—“q”",
]


def test_bpe_equals_the_library(spark, docs, texts):
    rows = [(i, t) for i, t in texts] + [(1000 + k, t) for k, t in enumerate(ODD)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = bpe.encode_documents(df, P.path("byte_bpe_50k.json")).collect()
    assert len(got) == len(rows)
    expected = sorted(((i, t or "") for i, t in rows), key=repr)
    for r, (i, t) in zip(sorted(got, key=lambda r: repr((r.doc_id, r.decoded))), sorted(expected, key=repr)):
        ids = library.encode(t, add_special_tokens=False).ids
        assert r.ids == np.array(ids, "<u4").tobytes() and r.n_tokens == len(ids)
        assert r.decoded == library.decode(ids, skip_special_tokens=False)


def test_merges_that_are_no_order_are_refused(tmp_path):
    letters = bpe.byte_letters()
    vocab = {letters[b]: b for b in range(256)} | {"ab": 256, "abc": 257}
    told = {"model": {"vocab": vocab, "merges": ["ab c", "a b"]}, "added_tokens": []}
    (tmp_path / "t.json").write_text(json.dumps(told))
    with pytest.raises(ValueError):
        bpe.Vocabulary.read(str(tmp_path / "t.json"))


def test_token_files(spark, texts):
    rows = [x for x in texts if x[0] is not None] + [(1000 + k, t) for k, t in enumerate(ODD)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    folder = shared_folder(spark)
    manifest = tokenfiles.write_token_files(df, P.path("word_bpe_49k.json"), 1, folder)
    got = tokenfiles.read_token_files(spark, folder).collect()
    assert manifest["type"] == "<u2" and len(got) == len(rows)
    start = 0
    own = sorted(rows, key=lambda x: x[0])
    for r, (i, t) in zip(sorted(got), own):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert manifest["tokens"] == start


def test_empty_table_and_null_id(spark, none, docs):
    assert tokenfiles.token_files(none, P.path("word_bpe_49k.json")).count() == 0
    assert bpe.encode_documents(none, P.path("byte_bpe_50k.json")).count() == 0
    assert tokenfiles.token_files(docs, P.path("word_bpe_49k.json")).where("doc_id is null").count() == 1


def test_query_digests(spark, sf_dir):
    row = queries.op8_bpe(spark, sf_dir).orderBy("doc_id").first()
    text = spark.read.parquet(f"{sf_dir}/documents.parquet").where(f"doc_id = {row.doc_id}").first().text
    assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_every_code_point_is_cut_as_the_library_cuts_it():
    path = P.path("byte_bpe_50k.json")
    coder, library = bpe.encoder(path, bpe.odd_characters(path)), Tokenizer.from_file(path).pre_tokenizer
    points = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    for first in range(0, len(points), 50_000):
        text = "".join(f"a{chr(c)}1 {chr(c)}!{chr(c)}\n" for c in points[first : first + 50_000])
        expected = [text[a:b] for _, (a, b) in library.pre_tokenize_str(text)]
        assert coder.cut(text) == expected
