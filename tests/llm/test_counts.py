import random

import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lexicord.llm import queries, tokencounts

ODD = [
    "a<|endoftext|>b I'll 12 345  \n\n x  y \x1c é Ⅷ ١٢ ﬁ ΣΑΣ  ​ 😀😀 <|startoftext|>x '''re 'S aaaaaaaa",
    "<|STARTOFTEXT|> <| endoftext|> Don't STOP: it's 'twas we'Re 3½ áb ≠ x́ é ́a",
    "\x0b\x0c\x85  x", " lead", "trail ", " ", "a b", "x. y", "b  c", "l'été d 'or ' s", "a  b   c", "ＡＢＣ ｄ", "Á b ́c",
]


def library(name):
    if name.endswith(".model"):
        model = sentencepiece.SentencePieceProcessor(model_file=P.path(name))
        return lambda t: len(model.encode(t))
    tokenizer = Tokenizer.from_file(P.path(name))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_counts_equal_the_library(spark, texts, name):
    rng = random.Random(2)
    alphabet = "aB z. 'ts<|>09\n\té́ ▁ß中,  "
    mixed = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 80))) for _ in range(600)]
    very_long = ["ab cd " * 60_000 + "e" * 50_000, "é" * 30_000]
    rows = texts + [(1000 + k, t) for k, t in enumerate(ODD + mixed + very_long)]
    got = tokencounts.token_counts(spark.createDataFrame(rows, "doc_id long, text string"), P.path(name), limit=20).collect()
    count = library(name)
    expected = [(i, len((t or "").encode()), n := count(t or ""), n > 20) for i, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


def test_cuts_are_safe_between_rows():
    import numpy as np

    body, starts = np.frombuffer(b"a b cd e", np.uint8), np.array([0, 2, 2, 8])
    assert tokencounts.safe_cuts(body, starts).tolist() == [3, 6]
    counter = tokencounts.Counter(P.path("word_bpe_49k.json"))
    assert counter.count(body, starts).tolist() == [1, 0, 3]


def test_memory_of_lengths_is_bounded(monkeypatch):
    import numpy as np

    monkeypatch.setattr(tokencounts, "REMEMBERED", 5)
    counter = tokencounts.Counter(P.path("word_bpe_49k.json"))
    for k in range(4):
        body = f"one{k} two{k} three{k} four{k}".encode()
        assert counter.count(np.frombuffer(body, np.uint8), np.array([0, len(body)]))[0] == len(counter_ids(body.decode()))
    assert len(counter.known) <= 9


def counter_ids(text):
    return Tokenizer.from_file(P.path("word_bpe_49k.json")).encode(text, add_special_tokens=False).ids


def test_empty_table_null_id_clashing_columns(spark, none, docs):
    path = P.path("word_bpe_49k.json")
    assert tokencounts.token_counts(none, path).count() == 0
    assert tokencounts.token_counts(docs, path).where("doc_id is null").count() == 1
    clash = spark.createDataFrame([("k", "a b", 1, 2)], "doc_id string, text string, n_tokens int, id int")
    assert [tuple(r) for r in tokencounts.token_counts(clash, path).collect()] == [("k", 3, 2, False)]


def test_query(spark, sf_dir):
    got = queries.op11_token_counts(spark, sf_dir)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert got.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert got.where("over_limit != (n_tokens > 2048)").count() == 0
