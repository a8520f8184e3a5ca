"""Token files: flat unsigned integers and 64-bit document offsets.

A set of token files is a folder with, for each shard, `<name>.tokens`
(little-endian unsigned integers, 16 bits if the vocabulary fits, else 32),
`<name>.offsets` (n + 1 unsigned 64-bit places in the shard) and `<name>.docs`
(n signed 64-bit document ids), and `manifest.json` with the shards in ascending
document id, each with its counts and its base.  A base is the prefix sum of the
token counts before the shard; base plus offset is a place in the whole set.

Each attempt of a task writes under a new name, and the manifest names the
attempts that succeeded; files of lost attempts are never read.

Edge cases: null text counts as empty and has the end id alone; rows with a null
id come first; equal ids stand next to each other, ordered by text; an empty
table gives a manifest without shards.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexicord.llm.shared import shared_folder
from lexicord.llm.textarrays import LOWER, pieces, range_hashes, spans

#: Stands in `.docs` for a null id.
NO_ID = -(1 << 63)

#: Units whose ids a worker remembers at once.
REMEMBERED = 1_500_000

SPACE, MARK, LETTER, OTHER = 0, 1, 2, 3
CLASSES = np.full(256, OTHER, np.uint8)
CLASSES[33:127] = MARK
CLASSES[65:91] = CLASSES[97:123] = LETTER
CLASSES[[9, 10, 13, 32]] = SPACE


def byte_classes(body: np.ndarray) -> np.ndarray:
    """Letters are A-Z, a-z and the two-byte Latin-1 letters; other bytes beyond ASCII and control bytes are OTHER."""
    classes = CLASSES[body]
    lead = np.flatnonzero(body[:-1] == 0xC3)
    lead = lead[~np.isin(body[lead + 1], (0x97, 0xB7))]  # signs of multiplication and division
    classes[lead] = classes[lead + 1] = LETTER
    return classes


def units(body: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Begins, ends and hashes of pieces of text that can be encoded apart, and where rows' pieces begin.

    White space ends a piece, and so does a change between letters and marks,
    unless the word holds an apostrophe (contractions), `<` (special tokens) or
    an OTHER byte (marks that compose, unknown classes): such a word stays whole.
    """
    classes = byte_classes(body)
    begins, ends, _ = spans(classes != SPACE, starts)
    odd = np.zeros(len(body) + 1, np.int64)
    np.cumsum((classes == OTHER) | (body == 39) | (body == 60), out=odd[1:])
    whole = odd[ends] > odd[begins]
    edges = np.zeros(len(body) + 1, np.int8)
    edges[begins[whole]] += 1
    edges[ends[whole]] -= 1
    inside = np.cumsum(edges[:-1], dtype=np.int8).astype(bool)
    cut = np.zeros(len(body), bool)
    cut[1:] = (classes[1:] != classes[:-1]) & (classes[1:] != SPACE) & ~inside[1:]
    cut[begins] = True
    firsts = np.flatnonzero(cut)
    word = np.searchsorted(begins, firsts, "right") - 1
    lasts = np.minimum(np.append(firsts[1:], len(body)), ends[word])
    hashes = range_hashes(np.where(inside, body, LOWER[body]), firsts, lasts)
    hashes[inside[firsts]] ^= np.uint64(0xA5A5A5A5A5A5A5A5)
    return firsts, lasts, hashes, np.searchsorted(firsts, starts)


class UnitEncoder:
    """Encodes texts with the tokenizers library, each distinct unit once.

    The tokenizer must lower-case, drop white space, cut words where letters end
    and mark word ends; then a text's ids are its units' ids in a row.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.size = self.tokenizer.get_vocab_size()
        self.final = np.zeros(self.size, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.final[i] = token.endswith("</w>")
        self.forget()

    def forget(self) -> None:
        self.hashes, self.firsts, self.counts, self.ids = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint32)

    def library_ids(self, texts: list[bytes], plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units, plain ones first, and each unit's count; plain units are letters alone and go to the library in a row."""
        ids, counts = [], np.zeros(len(texts), np.int64)
        rows = np.flatnonzero(plain)
        for first in range(0, len(rows), 5_000):
            own = rows[first : first + 5_000]
            got = np.array(self.tokenizer.encode_batch_fast([b" ".join([texts[i] for i in own]).decode()], add_special_tokens=False)[0].ids, np.uint32)
            stops = np.flatnonzero(self.final[got]) + 1
            if len(stops) != len(own):
                raise ValueError("a word of letters must give one word end")
            counts[own] = np.diff(stops, prepend=0)
            ids.append(got)
        for i, x in zip((rows := np.flatnonzero(~plain)), self.tokenizer.encode_batch_fast([texts[i].decode() for i in rows], add_special_tokens=False)):
            ids.append(np.array(x.ids, np.uint32))
            counts[i] = len(ids[-1])
        return np.concatenate(ids), counts

    def learn(self, body: np.ndarray, begins: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> None:
        raw = body.tobytes()
        letters = np.zeros(len(body) + 1, np.int64)
        np.cumsum(byte_classes(body) == LETTER, out=letters[1:])
        plain = letters[ends] - letters[begins] == ends - begins
        ids, counts = self.library_ids([raw[a:b] for a, b in zip(begins.tolist(), ends.tolist())], plain)
        order = np.argsort(~plain, kind="stable")
        firsts = np.empty(len(counts), np.int64)
        firsts[order] = np.cumsum(counts[order]) - counts[order] + len(self.ids)
        at = np.searchsorted(self.hashes, hashes)
        self.hashes, self.firsts, self.counts = np.insert(self.hashes, at, hashes), np.insert(self.firsts, at, firsts), np.insert(self.counts, at, counts)
        self.ids = np.concatenate([self.ids, ids])

    def encode(self, body: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows in a row, and where each row's begin."""
        begins, ends, hashes, firsts = units(body, starts)
        if not len(hashes):
            return np.empty(0, np.uint32), np.zeros(len(starts), np.int64)
        if len(self.hashes) > REMEMBERED:
            self.forget()
        distinct, at, number = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.hashes, distinct)
        new = np.append(self.hashes, np.uint64(0))[place] != distinct
        new |= place == len(self.hashes)
        if new.any():
            self.learn(body, begins[at[new]], ends[at[new]], distinct[new])
        place = np.searchsorted(self.hashes, distinct)[number]
        counts = self.counts[place]
        run = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(counts, out=run[1:])
        return self.ids[np.arange(run[-1]) + np.repeat(self.firsts[place] - run[:-1], counts)], run[firsts]


_encoders: dict[str, UnitEncoder] = {}


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder: a local path, or any address that pyarrow knows."""
    return fs.FileSystem.from_uri(uri) if ":" in uri.split("/")[0] else (fs.LocalFileSystem(), uri)


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, folder: str, id_col: str = "doc_id", text_col: str = "text") -> dict:
    """Encode all texts and write them as token files to `folder`; returns the manifest, a few numbers a shard.

    The texts are dealt by ranges of ids (one shuffle) and encoded where they
    are written.
    """
    kind = "<u2" if max(UnitEncoder(tokenizer).size - 1, end_id) < 1 << 16 else "<u4"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        if tokenizer not in _encoders:
            _encoders[tokenizer] = UnitEncoder(tokenizer)
        shard, (store, path), name, out = TaskContext.get().partitionId(), opened(folder), uuid.uuid4().hex, None
        store.create_dir(path, recursive=True)
        counts, ids = [], []
        for batch, body, starts in pieces(batches):
            out = out or store.open_output_stream(f"{path}/{name}.tokens")
            tokens, firsts = _encoders[tokenizer].encode(body, starts)
            out.write(np.insert(tokens, firsts[1:], end_id).astype(kind).tobytes())
            counts.append(np.diff(firsts) + 1)
            ids.append(batch.column("doc_id").fill_null(NO_ID).to_numpy())
        if out:
            out.close()
            counts, ids = np.concatenate(counts), np.concatenate(ids)
            for what, body in (("offsets", np.append(0, np.cumsum(counts)).astype("<u8")), ("docs", ids.astype("<i8"))):
                with store.open_output_stream(f"{path}/{name}.{what}") as f:
                    f.write(body.tobytes())
            yield pa.record_batch([pa.array([shard], pa.int32()), pa.array([name]), pa.array([len(ids)]), pa.array([int(counts.sum())])], ["shard", "name", "docs", "tokens"])

    dealt = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("tie"), F.col(text_col).alias("text")).repartitionByRange("doc_id", "tie")
    told = dealt.sortWithinPartitions("doc_id", "tie").mapInArrow(write, "shard int, name string, docs long, tokens long").collect()
    base, shards = 0, []
    for row in sorted(told):
        shards.append({"name": row.name, "docs": row.docs, "tokens": row.tokens, "base": base})
        base += row.tokens
    manifest = {"type": kind, "end_id": end_id, "tokens": base, "shards": shards}
    store, path = opened(folder)
    store.create_dir(path, recursive=True)
    with store.open_output_stream(f"{path}/manifest.json") as f:
        f.write(json.dumps(manifest).encode())
    return manifest


def mapped(store: fs.FileSystem, path: str, kind: str) -> np.ndarray:
    """A file's integers, memory-mapped where the store is a mounted folder."""
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, kind, "r")
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read_buffer(), kind)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the files of `folder`, a task for each shard."""
    store, path = opened(folder)
    with store.open_input_stream(f"{path}/manifest.json") as f:
        manifest = json.loads(f.read())
    shards, kind = manifest["shards"], manifest["type"]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, path = opened(folder)
        for batch in batches:
            for k in batch["id"]:
                shard = shards[k]
                offsets = mapped(store, f"{path}/{shard['name']}.offsets", "<u8").astype(np.int64)
                ids = mapped(store, f"{path}/{shard['name']}.docs", "<i8")
                tokens = mapped(store, f"{path}/{shard['name']}.tokens", kind)
                for first in range(0, len(ids), 10_000):
                    last = min(first + 10_000, len(ids))
                    own = ids[first:last]
                    yield pd.DataFrame(
                        {
                            "doc_id": pd.array(own, "Int64").copy() if (own != NO_ID).all() else pd.array([None if i == NO_ID else i for i in own.tolist()], "Int64"),
                            "start": offsets[first:last] + shard["base"],
                            "n_tokens": np.diff(offsets[first : last + 1]),
                            "ids_crc32": [zlib.crc32(tokens[a:b].astype("<u4")) for a, b in zip(offsets[first:last], offsets[first + 1 : last + 1])],
                        }
                    )

    return spark.range(0, len(shards), 1, max(1, len(shards))).mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Write token files to the shared folder and return what they hold of each document."""
    folder = shared_folder(docs.sparkSession)
    write_token_files(docs, tokenizer, end_id, folder)
    return read_token_files(docs.sparkSession, folder)
