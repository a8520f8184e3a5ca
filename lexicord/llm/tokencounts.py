"""Token counts: what a tokenizer makes of each whole text, as lengths only.

An Arrow function takes a batch of texts at a time, cuts them at safe boundaries,
and hands each distinct piece to the tokenizer once, in calls of about equal
bytes; only its length comes back, and a text's count is the sum over its pieces.
Nothing is shuffled and no ids leave the worker.

A boundary is safe in front of one blank that stands between a printable ASCII
character and an ASCII letter: normal forms do not reach across it, no word of
the tokenizer goes over it, and special strings hold no blank.  So a long text is
many small pieces; a stretch without such a place stays whole.  Tokenizers
without a pre-tokenizer, and models with pieces that go over a blank, get whole
texts.

Edge cases: null text counts as empty and has no tokens; ids may be null, and
every row gives one row, repeated ones too; an empty table gives none; columns
other than id and text are not looked at.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexicord.llm.textarrays import pieces

#: Pieces whose lengths a worker remembers at once, and bytes handed to the tokenizer in one call.
REMEMBERED = 400_000
CALL_BYTES = 1 << 16

PRINTABLE = np.zeros(256, bool)
PRINTABLE[33:127] = True
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True


def safe_cuts(body: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Places of the blanks in front of which rows may be cut."""
    if len(body) < 3:
        return np.empty(0, np.int64)
    edge = np.zeros(len(body) + 1, bool)
    edge[starts] = True
    at = np.flatnonzero((body[1:-1] == 32) & PRINTABLE[body[:-2]] & LETTER[body[2:]]) + 1
    return at[~edge[at] & ~edge[at + 1]]


def lengths_of(path: str) -> tuple[Callable[[list[str]], list[int]], bool, bool]:
    """How many ids each text gives, whether texts may be cut, and whether the blank goes with the cut."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        inner = any("▁" in model.id_to_piece(i).lstrip("▁") for i in range(model.get_piece_size()))
        prefixed = model.encode("a") == model.encode("b a")[len(model.encode("b")) :]
        return (lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]), prefixed and not inner, True
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return (lambda texts: [len(x) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]), tokenizer.pre_tokenizer is not None, False


class Counter:
    """Counts the tokens of rows of bytes, and remembers the lengths of pieces."""

    def __init__(self, path: str):
        self.lengths, self.cuts, self.drops = lengths_of(path)
        self.known: dict[bytes, int] = {}

    def learn(self, new: list[bytes]) -> None:
        """Lengths of pieces, in calls that end where the running sum of bytes passes a multiple of the call's size."""
        call = np.cumsum([len(x) for x in new]) // CALL_BYTES
        stops = [*(np.flatnonzero(np.diff(call)) + 1).tolist(), len(new)]
        first = 0
        for last in stops:
            own = new[first:last]
            self.known.update(zip(own, self.lengths([x.decode("utf-8", "replace") for x in own])))
            first = last

    def count(self, body: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The number of tokens of each row."""
        at = safe_cuts(body, starts) if self.cuts else np.empty(0, np.int64)
        begins = np.union1d(starts[:-1][np.diff(starts) > 0], at)
        firsts = np.searchsorted(begins, starts)
        if not len(begins):
            return np.zeros(len(starts) - 1, np.int64)
        offsets, kept = np.append(begins, len(body)), body
        if self.drops:  # the blank at a cut goes
            kept = np.delete(body, at)
            offsets = offsets - np.searchsorted(at, offsets)
        units = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(kept))])
        coded = units.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = [x for x in distinct if x not in self.known]
        if new:
            self.learn(new)
        counts = np.array([self.known[x] for x in distinct], np.int64)
        run = np.zeros(len(begins) + 1, np.int64)
        np.cumsum(counts[coded.indices.to_numpy()], out=run[1:])
        return run[firsts[1:]] - run[firsts[:-1]]


_counters: dict[str, Counter] = {}


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row; `tokenizer` is a .json of tokenizers or a .model of sentencepiece."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _counters:
            _counters[tokenizer] = Counter(tokenizer)
        for batch, body, starts in pieces(batches, most=2_000_000):
            n = _counters[tokenizer].count(body, starts)
            yield pa.record_batch([batch.column("id"), pa.array(np.diff(starts)), pa.array(n), pa.array(n > limit)], [id_col, "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(counted, f"`{id_col}` {rows.schema['id'].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean")
