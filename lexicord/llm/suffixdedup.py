"""Removal of long byte strings that an earlier document already has.

A byte goes if a string of `length` bytes over it also starts in a document with
a smaller id; strings are those of the input.

Strings that two documents share meet through anchors: among the 16-byte strings
inside any window of `length` bytes the one of least hash is an anchor, and equal
windows have equal anchors.  Around each anchor that at least two documents hold,
a fragment reaches as far as any window over it.  Equal fragments are one, with
their least document.  Within blocks of fragments that share anchors, a
multi-document Burrows-Wheeler transform is built column by column: each round
puts one more symbol in front of every fragment's suffix, and the order of all
suffixes follows from one stable counting sort of the transform.  Neighbours in
the final order with `length` common symbols are equal strings; the least
document of such a run keeps its bytes, the others lose them.

Blocks are bounded, so a transform stays in the memory of its task; an anchor
with more than `most` different fragments is resolved by grouping hashed windows
over all executors instead.  Documents that equal an earlier one as a whole go
without fragments.

Edge cases: null counts as empty; texts shorter than `length` bytes lose
nothing; rows with one id never take from each other, and what one of them loses
the others keep, as rows are told apart by their text's hash too; a null id
counts as larger than all others.  Other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexicord.llm.shared import written
from lexicord.llm.textarrays import mix, pieces

ANCHOR = 16


def forward(a: np.ndarray, width: int, f) -> np.ndarray:
    """f over the `width` values from each place on."""
    step = 1
    while step * 2 <= width:
        a = np.concatenate([f(a[:-step], a[step:]), a[-step:]])
        step *= 2
    rest = width - step
    return np.concatenate([f(a[:-rest], a[rest:]), a[-rest:]]) if rest else a


def anchors(body: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors of all rows, and their hashes."""
    n, width = len(body), length - ANCHOR + 1
    if n < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    padded = np.concatenate([body, np.zeros(32, np.uint8)])
    eight = np.lib.stride_tricks.as_strided(padded, (n + 8, 8), (1, 1)).copy().view("<u8").ravel()
    hashes = mix(eight[:n] + mix(eight[8 : n + 8])) | np.uint64(1)
    least = forward(hashes, width, np.minimum)
    ends = np.repeat(starts[1:], np.diff(starts))
    least[np.arange(n) + length > ends] = 0  # no whole window from here
    reached = forward(least[::-1], width, np.maximum)[::-1]
    at = np.flatnonzero(reached == hashes)
    return at, hashes[at]


def anchor_rows(docs: DataFrame, length: int) -> DataFrame:
    """(hash, doc, tie) of the anchors of each row, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, body, starts in pieces(batches, most=1_000_000):
            at, hashes = anchors(body, starts, length)
            row = np.searchsorted(starts, at, "right") - 1
            order = np.lexsort((hashes, row))
            row, hashes = row[order], hashes[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
            yield pa.record_batch([pa.array(hashes[new].view(np.int64)), *[batch.column(c).take(pa.array(row[new])) for c in ("doc", "tie")]], ["hash", "doc", "tie"])

    return docs.select("doc", "tie", "text").mapInArrow(run, "hash long, doc long, tie long")


def shared_anchors(rows: DataFrame) -> DataFrame:
    """The (hash, doc, tie) whose hash another document has too: in sorted order, the first and last document with it differ."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, told = None, False  # rows of the last hash wait for its second document; once it is told, the last row
        for batch in batches:
            if not batch.num_rows:
                continue
            h, d, t = (batch.column(c).to_numpy() for c in ("hash", "doc", "tie"))
            if held is not None:
                h, d, t = (np.append(a, b) for a, b in zip(held, (h, d, t)))
            new = np.ones(len(h), bool)  # a repeated row repeats its anchors
            new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1]) | (t[1:] != t[:-1])
            h, d, t = h[new], d[new], t[new]
            firsts = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            lasts = np.append(firsts[1:], len(h)) - 1
            hit = d[firsts] != d[lasts]
            hit[0] |= told
            out = np.repeat(hit, lasts - firsts + 1)
            out[0] &= not told
            yield pa.record_batch([pa.array(x[out]) for x in (h, d, t)], ["hash", "doc", "tie"])
            told = bool(hit[-1])
            rest = slice(len(h) - 1 if told else firsts[-1], None)
            held = (h[rest], d[rest], t[rest])

    return rows.repartition("hash").sortWithinPartitions("hash", "doc", "tie").mapInArrow(run, "hash long, doc long, tie long")


def fragments(joined: DataFrame, length: int) -> DataFrame:
    """(hash, doc, tie, at, piece) around the shared anchors of (doc, tie, text, hashes); a piece's first byte tells where its anchor is."""
    reach = length - ANCHOR

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, body, starts in pieces(batches, most=1_000_000):
            at, hashes = anchors(body, starts, length)
            row = np.searchsorted(starts, at, "right") - 1
            lists = batch.column("hashes")
            wanted_row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy())
            wanted = lists.flatten().to_numpy().view(np.uint64)
            own = np.isin(mix(hashes + mix(row.astype(np.uint64))), mix(wanted + mix(wanted_row.astype(np.uint64))))
            at, hashes, row = at[own], hashes[own], row[own]
            first, last = np.maximum(at - reach, starts[row]), np.minimum(at + length, starts[row + 1])
            raw = body.tobytes()
            found = [bytes((a - f,)) + raw[f:z] for a, f, z in zip(at.tolist(), first.tolist(), last.tolist())]
            take = pa.array(row)
            yield pa.record_batch([pa.array(hashes.view(np.int64)), batch.column("doc").take(take), batch.column("tie").take(take), pa.array((first - starts[row]).astype(np.int64)), pa.array(found, pa.binary())], ["hash", "doc", "tie", "at", "piece"])

    return joined.select("doc", "tie", "text", "hashes").mapInArrow(run, "hash long, doc long, tie long, at long, piece binary")


def suffix_order(symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All suffixes of a collection in order, as (document, place), built column by column.

    `transform` holds, in suffix order, the symbol before each suffix that is in;
    a document that is all in gives no more.  A stable counting sort of it is the
    order of the suffixes one symbol longer.
    """
    sizes = np.diff(starts)
    doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes + 1)  # of each place; a place more at each end is the empty suffix
    ends = (starts[1:] + np.arange(len(sizes))).astype(np.int32)
    spread = np.zeros(len(doc), np.uint8)
    spread[np.arange(len(symbols)) + np.repeat(np.arange(len(sizes)), sizes)] = symbols
    inner = np.ones(len(doc), bool)
    inner[starts[:-1] + np.arange(len(sizes))] = False
    order = ends
    for _ in range(int(sizes.max()) if len(sizes) else 0):
        before = order[inner[order]] - np.int32(1)
        order = np.concatenate([ends, before[np.argsort(spread[before], kind="stable")]])
    return doc[order], order.astype(np.int64) - doc[order]


def repeated_windows(found: list[bytes], docs: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(fragment, place) of the windows of these fragments that a fragment of a smaller document has too."""
    sizes = np.array([len(x) - 1 for x in found])
    body = np.frombuffer(b"".join([x[1:] for x in found]), np.uint8)
    starts = np.append(0, np.cumsum(sizes))
    own, place = suffix_order(body, starts)
    whole = starts[own + 1] - place >= length
    own, place = own[whole], place[whole]
    windows = np.lib.stride_tricks.sliding_window_view(body, length)
    fresh = np.ones(len(own), bool)
    for first in range(1, len(own), 200_000):
        a = slice(first, first + 200_000)
        fresh[a] = (windows[place[a]] != windows[place[first - 1 : first - 1 + len(place[a])]]).any(axis=1)
    run = np.cumsum(fresh) - 1
    least = np.full(run[-1] + 1 if len(run) else 0, np.iinfo(np.int64).max)
    np.minimum.at(least, run, docs[own])
    hit = least[run] < docs[own]
    return own[hit], (place - starts[own])[hit]


def may_repeat(found: list[bytes], length: int) -> np.ndarray:
    """Fragments that share half a window's reach beside the anchor with another one; the rest repeat nothing."""
    reach = length - ANCHOR
    half = reach // 2
    keys = {}
    sides = []
    for i, x in enumerate(found):
        at = x[0] + 1
        for side, key in ((0, x[at - half : at + ANCHOR] if at - 1 >= half else None), (1, x[at : at + ANCHOR + reach - half] if len(x) - at >= ANCHOR + reach - half else None)):
            if key is not None:
                keys[side, key] = keys.get((side, key), 0) + 1
                sides.append((i, (side, key)))
    hit = np.zeros(len(found), bool)
    for i, key in sides:
        if keys[key] > 1:
            hit[i] = True
    return hit


def spans_of_blocks(rows: DataFrame, length: int, block: int, most: int) -> DataFrame:
    """(doc, tie, at, size, window): bytes that go (window null), or windows of crowded anchors still to be grouped."""

    def solve(anchor: np.ndarray, doc: np.ndarray, tie: np.ndarray, at: np.ndarray, column: pa.Array, crowd: int | None, carried: tuple[bytes, int] | None) -> Iterator[pa.RecordBatch]:
        """crowd: an anchor known to be crowded; carried: its last piece so far, with the least document."""
        coded = column.dictionary_encode()
        code, found = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        least = np.full(len(found), np.iinfo(np.int64).max)
        np.minimum.at(least, code, doc)
        if carried and found[code[0]] == carried[0]:
            least[code[0]] = carried[1]
        sizes = np.array([len(x) - 1 for x in found])
        later = doc > least[code]
        out = [(doc[later], tie[later], at[later], sizes[code[later]])]
        own_anchor = np.zeros(len(found), np.int64)
        own_anchor[code] = anchor
        firsts = np.flatnonzero(~later)
        names, counts = np.unique(own_anchor, return_counts=True)
        crowded = np.isin(own_anchor, names[counts > most])
        if crowd is not None:
            crowded |= own_anchor == crowd
        if crowded.any():
            for i in firsts[crowded[code[firsts]]].tolist():
                x = found[code[i]]
                hashed = np.array([int.from_bytes(hashlib.blake2b(x[k : k + length], digest_size=8).digest(), "little", signed=True) for k in range(1, len(x) - length + 1)])
                n = len(hashed)
                yield pa.record_batch([pa.array(np.full(n, doc[i])), pa.array(np.full(n, tie[i])), pa.array(at[i] + np.arange(n)), pa.array(np.full(n, length)), pa.array(hashed)], ["doc", "tie", "at", "size", "window"])
        part = np.flatnonzero(~crowded)
        part = part[may_repeat([found[i] for i in part], length)]
        if len(part):
            i, place = repeated_windows([found[i] for i in part], least[part], length)
            order = np.lexsort((place, i))
            piece, place = part[i][order], place[order]
            if len(piece):  # windows that touch are one span
                new = np.append(True, (piece[1:] != piece[:-1]) | (place[1:] > place[:-1] + length))
                last = np.append(np.flatnonzero(new)[1:], len(new)) - 1
                piece, place, size = piece[new], place[new], place[last] - place[new] + length
                begin, end = np.searchsorted(piece, code[firsts]), np.searchsorted(piece, code[firsts], "right")
                n = end - begin
                rows = np.repeat(firsts, n)
                which = np.repeat(begin - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
                out.append((doc[rows], tie[rows], at[rows] + place[which], size[which]))
        d, t, a, s = (np.concatenate(x) for x in zip(*out))
        yield pa.record_batch([pa.array(d), pa.array(t), pa.array(a), pa.array(s), pa.nulls(len(d), pa.int64())], ["doc", "tie", "at", "size", "window"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        crowd, carried = None, None
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < block:
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            anchor = rows.column("hash").to_numpy()
            cut = int(np.searchsorted(anchor, anchor[-1], "left"))  # the last anchor may go on
            if not cut and len(anchor) < 4 * most:
                continue
            if not cut:  # so many rows that it is crowded: they need not be held together
                carried = carried if crowd == anchor[0] else None
                crowd, cut = int(anchor[0]), len(anchor)
            yield from whole(rows.slice(0, cut), crowd, carried)
            carried = kept_least(rows.slice(0, cut), crowd, carried)
            held = rows.slice(cut).to_batches()
        if held:
            yield from whole(pa.Table.from_batches(held), crowd, carried)

    def kept_least(rows: pa.Table, crowd: int | None, carried: tuple[bytes, int] | None) -> tuple[bytes, int] | None:
        """The last piece and its least document, if it belongs to the crowded anchor; rows are sorted by piece and document."""
        if crowd is None or rows.column("hash")[-1].as_py() != crowd:
            return None
        last = rows.column("piece")[-1].as_py()
        if carried and carried[0] == last:
            return carried
        return last, pc.min(rows.column("doc").filter(pc.equal(rows.column("piece"), pa.scalar(last, pa.binary())))).as_py()

    def whole(rows: pa.Table, crowd: int | None, carried: tuple[bytes, int] | None) -> Iterator[pa.RecordBatch]:
        rows = rows.combine_chunks()
        if rows.num_rows:
            yield from solve(*(rows.column(c).to_numpy() for c in ("hash", "doc", "tie", "at")), rows.column("piece").combine_chunks(), crowd, carried)

    dealt = rows.repartition("hash").sortWithinPartitions("hash", "piece", "doc")
    return dealt.mapInArrow(run, "doc long, tie long, at long, size long, window long")


def merged(spans: np.ndarray) -> np.ndarray:
    """Maximal runs of the union of (start, end)."""
    if not len(spans):
        return spans
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    ends = np.maximum.accumulate(spans[:, 1])
    new = np.append(True, spans[1:, 0] > ends[:-1])
    first = np.flatnonzero(new)
    return np.stack([spans[first, 0], ends[np.append(first[1:], len(spans)) - 1]], axis=1)


def repeated_strings(docs: DataFrame, length: int = 50, block: int = 40_000, most: int = 20_000) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, spans, kept binary) of every row; spans are (start, end) in bytes."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("doc"), F.xxhash64("text").alias("tie"), F.coalesce("text", F.lit("")).alias("text"))
    long = rows.where(F.octet_length("text") >= length)
    # documents that equal an earlier one
    names = long.select("doc", "tie", F.sha2(F.encode("text", "UTF-8"), 256).alias("name"))
    copies = written(names.join(names.groupBy("name").agg(F.min("doc").alias("least")), "name").where("doc > least").select("doc", "tie").distinct())
    shared = shared_anchors(anchor_rows(long, length))
    hashes = written(shared.groupBy("doc", "tie").agg(F.collect_list("hash").alias("hashes")).join(copies, ["doc", "tie"], "left_anti"))
    cut = spans_of_blocks(fragments(long.join(hashes, ["doc", "tie"]), length), length, block, most)
    spans = written(cut)
    crowded = spans.where("window is not null")
    least = crowded.groupBy("window").agg(F.min("doc").alias("least"), F.max("doc").alias("largest")).where("least < largest")
    late = crowded.join(least, "window").where("doc > least").select("doc", "tie", "at", "size")
    all_spans = spans.where("window is null").select("doc", "tie", "at", "size").unionByName(late)
    whole = copies.select("doc", "tie", F.lit(0).cast("long").alias("at"), F.lit(1 << 40).alias("size"))
    by_row = all_spans.unionByName(whole).groupBy("doc", "tie").agg(F.collect_list(F.struct("at", "size")).alias("spans"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, body, starts in pieces(batches):
            lists = batch.column("spans")
            told = lists.flatten()
            at, size = told.field("at").to_numpy(), told.field("size").to_numpy()
            firsts = np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy()))
            sizes, removed, runs, kept = np.diff(starts), [], [], []
            for k, (a, b) in enumerate(zip(firsts[:-1], firsts[1:])):
                found = merged(np.stack([at[a:b], np.minimum(at[a:b] + size[a:b], sizes[k])], axis=1))
                keep = np.ones(sizes[k], bool)
                for x, y in found:
                    keep[x:y] = False
                kept.append(body[starts[k] : starts[k + 1]][keep].tobytes())
                removed.append(int(sizes[k]) - len(kept[-1]))
                runs.append([{"start": int(x), "end": int(y)} for x, y in found])
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.record_batch([batch.column("doc_id"), pa.array(sizes), pa.array(removed, pa.int64()), pa.array([len(r) for r in runs], pa.int64()), pa.array(runs, span), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"])

    done = rows.join(by_row, ["doc", "tie"], "left").select("doc_id", "text", "spans")
    return done.mapInArrow(finish, "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<struct<start:long,end:long>>, kept binary")
