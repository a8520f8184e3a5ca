"""Byte-level BPE encoding and decoding by a pair occurrence index.

Text is cut at white space into chunks, whose pre-tokens do not depend on what
stands around them; each distinct chunk is encoded once.  The distinct
pre-tokens of new chunks of a part of a partition lie in one flat list of
symbols.  An index maps every mergeable pair to all places where it stands;
active ranks are applied in ascending order, each at all of its places, and the
lists of the pairs that arise or vanish around a merge are updated.

Edge cases: null and empty texts have no ids and decode to "".  Strings of
special tokens in a text are encoded as those tokens, as the tokenizers library
does.  Repeated rows are encoded alike; other columns, whatever their names, are
not read.  A text of any length is one row of its part.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexicord.llm.textarrays import pieces, range_hashes

#: The pattern that cuts text into pre-tokens, as byte-level vocabularies of this kind use it.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Chunks whose ids a worker remembers at once, and bytes of text it encodes at once.
REMEMBERED = 1_000_000
PIECE = 1_000_000

ASCII_SPACES = np.zeros(256, bool)
ASCII_SPACES[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
SPACES = ASCII_SPACES.copy()


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: printable Latin-1 bytes for themselves, others from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


@dataclass
class Vocabulary:
    """Merges (left, right, whole) by rank, and the bytes of each id, read from a tokenizer.json of byte-level BPE."""

    merges: np.ndarray
    byte_ids: np.ndarray
    token_bytes: list[bytes]
    specials: dict[str, int]

    def __post_init__(self):
        self.width = len(self.token_bytes)
        codes = self.merges[:, 0] * self.width + self.merges[:, 1]
        self.pair_ranks = np.argsort(codes, kind="stable")
        self.pair_codes = codes[self.pair_ranks]

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        vocab, letters = told["model"]["vocab"], byte_letters()
        back = {c: b for b, c in letters.items()}
        merges: list[tuple[int, int, int]] = []
        made: set[int] = set()
        for pair in told["model"]["merges"]:
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            late = any(len(part) > 1 and i not in made for part, i in ((a, left), (b, right)))
            if whole in made or late:
                raise ValueError("a pair must be made of earlier tokens, each made by one merge")
            made.add(whole)
            merges.append((left, right, whole))
        specials = {x["content"]: x["id"] for x in told["added_tokens"]}
        token_bytes = [b""] * (1 + max([*vocab.values(), *specials.values()]))
        for token, i in vocab.items():
            token_bytes[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        for token, i in specials.items():
            token_bytes[i] = token.encode()
        return cls(np.array(merges, np.int64).reshape(-1, 3), np.array([vocab[letters[b]] for b in range(256)]), token_bytes, specials)


def alternate(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of the places of a pair of two equal symbols, those that merge from the left: every other one of a run."""
    out, last = [], -1
    for place, next_place in zip(at.tolist(), after[at].tolist()):
        if place != last:
            out.append(place)
            last = next_place
    return np.array(out, np.int64)


def merged(tokens: list[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all pre-tokens in a row, and the n + 1 places where each one's begin, by one index of pair occurrences."""
    sizes = np.array([len(t) for t in tokens], np.int64)
    ends = np.cumsum(sizes + 1) - 1
    symbols = np.full(int(sizes.sum()) + len(tokens), -1, np.int64)  # nothing merges across -1
    inside = np.ones(len(symbols), bool)
    inside[ends] = False
    symbols[inside] = v.byte_ids[np.frombuffer(b"".join(tokens), np.uint8)]
    after, before = np.arange(1, len(symbols) + 1), np.arange(-1, len(symbols) - 1)
    places: dict[int, list[np.ndarray]] = {}
    ranks: list[int] = []

    def enter(at: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        """Add the places of pairs (a, b) that can merge to the index."""
        if not len(v.pair_codes):
            return
        code = a * v.width + b
        found = np.searchsorted(v.pair_codes, code)
        hit = v.pair_codes[np.minimum(found, len(v.pair_codes) - 1)] == code
        at, rank = at[hit], v.pair_ranks[found[hit]]
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        firsts = np.flatnonzero(np.append(True, rank[1:] != rank[:-1])) if len(rank) else []
        for r, own in zip(rank[firsts].tolist(), np.split(at, firsts[1:])):
            if r in places:
                places[r].append(own)
            else:
                places[r] = [own]
                heapq.heappush(ranks, r)

    at = np.flatnonzero(inside[:-1] & inside[1:]) if len(symbols) else np.empty(0, np.int64)
    enter(at, symbols[at], symbols[at + 1])
    while ranks:
        rank = heapq.heappop(ranks)
        left, right, whole = v.merges[rank].tolist()
        own = places.pop(rank)
        at = own[0] if len(own) == 1 else np.unique(np.concatenate(own))
        at = at[symbols[at] == left]
        at = at[symbols[after[at]] == right]
        if left == right:
            at = alternate(np.sort(at), after)
        if not len(at):
            continue
        gone = after[at]
        follows, leads = after[gone], before[at]
        symbols[at], symbols[gone] = whole, -2
        after[at], before[follows] = follows, at
        one, two = symbols[leads], symbols[follows]
        some, more = (one >= 0) & (leads >= 0), two >= 0
        full = np.full(len(at), whole)
        enter(np.concatenate([leads[some], at[more]]), np.concatenate([one[some], full[more]]), np.concatenate([full[some], two[more]]))
    return symbols[symbols >= 0], np.append(0, np.cumsum(symbols >= 0)[ends])


def chunk_starts(body: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Places where text can be cut without changing its pre-tokens: row starts, and white space after anything else.

    No pre-token goes on over such a place.  Bytes that may end white space beyond ASCII
    count as white space, which only makes chunks longer.
    """
    blank = SPACES[body]
    wide = np.flatnonzero(body >= 0x80)
    for back, leads in ((1, (0xC2,)), (2, (0xE1, 0xE2, 0xE3))):
        at = wide[wide >= back]
        blank[at[np.isin(body[at - back], leads)]] = True
    cut = np.zeros(len(body) + 1, bool)
    cut[1:-1] = ASCII_SPACES[body[1:]] & ~blank[:-1]
    cut[starts] = True
    return np.flatnonzero(cut[:-1])


#: A character of each class that takes part in no contraction.
STAND_INS = {"letter": "a", "number": "1", "space": "\u00a0", "mark": "!"}


@lru_cache(maxsize=8)
def odd_characters(path: str) -> dict[int, str]:
    """Characters that the tokenizers library and `regex` class differently (their Unicode tables have other ages), each with a stand-in of the library's class.

    The library cuts a text of all code points beyond ASCII, in order, into runs of
    one class, and tells the class of each run by what its first character joins.
    """
    from tokenizers import Tokenizer

    cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    every = "".join(map(chr, (*range(0x80, 0xD800), *range(0xE000, 0x110000))))
    here = np.empty(len(every), "U6")
    for m in regex.compile(r"(\p{L}+)|(\p{N}+)|(\s+)|[^\s\p{L}\p{N}]+").finditer(every):
        here[m.start() : m.end()] = ("mark", "letter", "number", "space")[m.lastindex or 0]
    odd = {}
    for _, (first, last) in cut(every):
        joins = [k for k in ("letter", "number", "mark") if len(cut(STAND_INS[k] + every[first])) == 1]
        kind = joins[0] if joins else "space"
        odd |= {ord(every[first + i]): STAND_INS[kind] for i in np.flatnonzero(here[first:last] != kind).tolist()}
    return odd


class Encoder:
    """Encodes texts with one vocabulary; the ids of chunks lie in flat arrays, sorted by the chunks' hashes."""

    def __init__(self, path: str, odd: dict[int, str]):
        self.v = Vocabulary.read(path)
        self.pattern = regex.compile(PRE_TOKENS)
        self.odd = odd
        self.newest = chr(min(odd)) if odd else chr(0x10FFFF)
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.v.specials, key=len, reverse=True))) + ")") if self.v.specials else None
        self.sizes = np.array([len(t) for t in self.v.token_bytes], np.int64)
        self.token_starts = np.append(0, np.cumsum(self.sizes))
        self.token_body = np.frombuffer(b"".join(self.v.token_bytes), np.uint8)
        self.forget()

    def forget(self) -> None:
        self.hashes, self.firsts, self.counts, self.ids = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.uint32)

    def cut(self, text: str) -> list[str]:
        """Pre-tokens, with the library's classes of characters."""
        if text.isascii() or max(text) < self.newest:
            return self.pattern.findall(text)
        return [text[m.start() : m.end()] for m in self.pattern.finditer(text.translate(self.odd))]

    def pre_tokens(self, text: str) -> list[str]:
        """Special tokens' strings stay whole."""
        if not self.special or not self.special.search(text):
            return self.cut(text)
        out = []
        for k, part in enumerate(self.special.split(text)):
            out += [part] if k % 2 else self.cut(part)
        return out

    def learn(self, chunks: list[bytes], hashes: np.ndarray) -> None:
        """Add the ids of new chunks; their distinct pre-tokens are merged over one index."""
        specials, number, cut = self.v.specials, {}, []
        parts = [self.pre_tokens(c.decode()) for c in chunks]
        for tokens in parts:
            for t in tokens:
                cut.append(number.setdefault(t, len(number)))
        # a special token is its id, whatever its bytes merge to
        ids, firsts = merged([b"" if t in specials else t.encode() for t in number], self.v)
        special = [(k, specials[t]) for t, k in number.items() if t in specials]
        if special:
            ids = np.insert(ids, firsts[[k for k, _ in special]], [i for _, i in special])
            firsts = firsts + np.searchsorted([k for k, _ in special], np.arange(len(firsts)))
        cut = np.array(cut, np.int64)
        run, at = gathered(firsts[cut], np.diff(firsts)[cut])
        rows = run[np.append(0, np.cumsum([len(p) for p in parts]))]
        place = np.searchsorted(self.hashes, hashes)
        self.hashes, self.firsts, self.counts = np.insert(self.hashes, place, hashes), np.insert(self.firsts, place, rows[:-1] + len(self.ids)), np.insert(self.counts, place, np.diff(rows))
        self.ids = np.concatenate([self.ids, ids[at].astype(np.uint32)])

    def encode(self, body: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows in a row, and the n + 1 places where rows' ids begin."""
        begins = chunk_starts(body, starts)
        if not len(begins):
            return np.empty(0, np.uint32), np.zeros(len(starts), np.int64)
        ends = np.append(begins[1:], len(body))
        hashes = range_hashes(body, begins, ends)
        if len(self.hashes) > REMEMBERED:
            self.forget()
        distinct, at, number = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.hashes, distinct)
        new = np.append(self.hashes, np.uint64(0))[place] != distinct
        new |= place == len(self.hashes)
        if new.any():
            raw = body.tobytes()
            self.learn([raw[a:b] for a, b in zip(begins[at[new]].tolist(), ends[at[new]].tolist())], distinct[new])
        place = np.searchsorted(self.hashes, distinct)[number]
        run, at = gathered(self.firsts[place], self.counts[place])
        return self.ids[at], run[np.searchsorted(begins, starts)]

    def decode(self, ids: np.ndarray, firsts: np.ndarray) -> pa.Array:
        """The text of each row's ids; bytes that are no UTF-8 become replacement characters."""
        run, at = gathered(self.token_starts[ids], self.sizes[ids])
        body, starts = self.token_body[at], run[firsts]
        raw = body.tobytes()
        rows = pa.Array.from_buffers(pa.large_binary(), len(firsts) - 1, [None, pa.py_buffer(starts.astype(np.int64).tobytes()), pa.py_buffer(raw)])
        try:
            return rows.cast(pa.large_string())
        except pa.ArrowInvalid:  # a row is no UTF-8
            return pa.array([x.as_py().decode("utf-8", "replace") for x in rows], pa.large_string())


def gathered(firsts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running counts from 0, and the places of all runs of `counts` values from `firsts`."""
    run = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=run[1:])
    return run, np.arange(run[-1]) + np.repeat(firsts - run[:-1], counts)


_encoders: dict[str, Encoder] = {}


def encoder(path: str, odd: dict[int, str]) -> Encoder:
    """One for each worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path, odd)
    return _encoders[path]


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids binary, n_tokens, decoded): ids are little-endian unsigned 32-bit integers.

    The map stays in the tasks that read the texts; nothing is shuffled.  What a
    worker remembers goes with its task.
    """
    odd = odd_characters(vocabulary)  # a few ten thousand at most, whatever the texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary, odd)
        for batch, body, starts in pieces(batches, most=PIECE):
            ids, firsts = coder.encode(body, starts)
            rows = pa.Array.from_buffers(pa.large_binary(), batch.num_rows, [None, pa.py_buffer((firsts * 4).tobytes()), pa.py_buffer(ids.astype("<u4").tobytes())])
            yield pa.record_batch([batch.column("doc_id"), rows.cast(pa.binary()), pa.array(np.diff(firsts)), coder.decode(ids, firsts).cast(pa.string())], ["doc_id", "ids", "n_tokens", "decoded"])
        coder.forget()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, ids binary, n_tokens long, decoded string")
