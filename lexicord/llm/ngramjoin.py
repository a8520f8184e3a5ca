"""N-gram Jaccard join of documents by a token-group matrix.

A document is the set of its distinct k-word shingles (tokens).  Documents with
equal sets are one from the start.  Similar documents form groups; a group keeps
the union of its members' tokens.  A document that links with any member shares
at least the threshold's part of its own tokens with that union, so the overlap
of query and union bounds all similarities in the group at once, and only groups
that qualify are opened and compared member by member.

Which documents are similar enough to meet at all comes from segments: the hash
space is cut into more segments than two linked sets can have differing tokens,
so linked sets agree on a whole segment, and the hash of a segment's tokens is a
key both hold.  (All agreeing segments may be empty; the number of segments
leaves that to at most 1e-6 for a pair just at the threshold.)  A passage that
many documents share makes no key, for a segment takes tokens from everywhere.

The work has two passes.  In the first, each document is compared with the
document of least id that it shares most keys with: a group of any number of
near copies is a star, not all pairs.  Components of what is linked are the
groups.  In the second pass only keys that still join different components count.
A document with many tokens of its own cannot link outside its component, and of
two that link one has few (see `viable`); these light ones, in groups of at most
about `part` members of a component that share their rarest key, are what
documents of other components query by the bound, opening the groups that
qualify.  A document meets a group once, and only if they share as many keys as
linked sets do.  Links inside a component
cannot change components, so no link between components is lost.  Joins whose
both sides grow with the documents are sort-merge joins at every size, and keys and
tokens are met in waves by their hash, so that the disk holds one wave's shuffle.

Edge cases: null, empty and blank texts have no tokens, link with nothing and are
their own components; fewer than k words are one token.  Rows with one id count
as one document, whatever their texts: what links with any of them is in one
component, and each row has its own n_shingles; a null id links with nothing and
has a null component.  Texts of any length are read whole.  Other columns,
whatever their names, do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, comb, exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexicord.llm.components import components
from lexicord.llm.shared import dropped, in_waves, written
from lexicord.llm.textarrays import mix, pieces, shingles, words

#: Sizes of one class grow by at most this factor.
GROWTH = 1.6
MISS = 1e-6
#: Groups of the matrix hold sets of a band of sizes; bands a factor e of size.
BANDS = 50


def most_differing(percent: int, high: int) -> int:
    """How many tokens two linked sets of fewer than `high` tokens can differ in."""
    t = percent / 100
    return int((1 - t) / (1 + t) * 2 * (high - 1) + 1e-9)


def classes(percent: int) -> tuple[np.ndarray, list[int]]:
    """Least sizes of the classes, and the number of segments of each."""
    least = [1]
    while least[-1] < 1 << 40:
        least.append(max(least[-1] + 1, int(least[-1] * GROWTH)))
    t, counts = percent / 100, []
    for low, high in zip(least, least[1:]):
        differing = most_differing(percent, high)
        common = max(1, t * low)
        counts.append(max(differing + 1, ceil(differing * exp(-log(MISS) / common))) if differing else 1)
    return np.array(least), counts


def own_classes(n: int, percent: int, least: np.ndarray) -> list[int]:
    """Size classes in which partners of a set of n tokens can be."""
    return sorted({int(np.searchsorted(least, n, "right")) - 1, int(np.searchsorted(least, n * 100 // percent, "right")) - 1})


def segment_keys(tokens: np.ndarray, percent: int, least: np.ndarray, counts: list[int]) -> list[np.ndarray]:
    """Keys of a sorted token set in each of its classes: one for each segment that is not empty."""
    out = []
    mixed = mix(tokens ^ np.uint64(0x5851F42D4C957F2D))
    for c in own_classes(len(tokens), percent, least):
        segment = ((tokens >> np.uint64(32)) * np.uint64(counts[c])) >> np.uint64(32)
        first = np.append(0, np.flatnonzero(segment[1:] != segment[:-1]) + 1)
        out.append(mix(np.add.reduceat(mixed, first) + mix(segment[first] * np.uint64(64) + np.uint64(c))))
    return out


def token_sets(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(doc_id, n, f1, f2, keys): set size, two 64-bit fingerprints of the set, and segment keys."""
    least, counts = classes(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, body, starts in pieces(batches):
            sets = shingles(*words(body, starts), k)
            f1 = np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64)
            f2 = np.array([mix(s + np.uint64(12345)).sum(dtype=np.uint64) for s in sets], np.uint64)
            keys = [np.concatenate(segment_keys(s, percent, least, counts)) if len(s) else s for s in sets]
            ends = np.append(0, np.cumsum([len(x) for x in keys]))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(keys).view(np.int64)))
            yield pa.record_batch([batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)), lists], ["doc_id", "n", "f1", "f2", "keys"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n long, f1 long, f2 long, keys array<long>")


def tokens_of(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(id, tokens array<long>) of the wanted (id, first, f1); first is a document with that set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, body, starts in pieces(batches):
            sets = shingles(*words(body, starts), k)
            same = np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64) == batch.column("f1").to_numpy()
            sets = [s.view(np.int64) if keep else s[:0].view(np.int64) for s, keep in zip(sets, same)]
            ends = np.append(0, np.cumsum([len(s) for s in sets]))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets)))
            yield pa.record_batch([batch.column("id"), lists], ["id", "tokens"]).filter(pa.array(same))

    texts = docs.select(F.col("doc_id").cast("long").alias("first"), "text").join(wanted.hint("merge"), "first").select("id", "f1", "text")
    return texts.mapInArrow(run, "id long, tokens array<long>").dropDuplicates(["id"])


def linked(a: Column, b: Column, percent: int) -> Column:
    common = F.size(F.array_intersect(a, b))
    return common * 100 >= (F.size(a) + F.size(b) - common) * percent


def enough_common(common: Column, n: Column, m: Column, percent: int) -> Column:
    """Whether sets of n and m tokens that share no more than `common` can link."""
    return common * (100 + percent) >= (n + m) * percent


def bound(tokens: Column, union: Column, low: Column, percent: int) -> Column:
    """Whether a document can link with any member of a group of sets of `low` tokens or more, by its overlap with the group's union."""
    return enough_common(F.size(F.array_intersect(tokens, union)), F.size(tokens), low, percent)


def verified(pairs: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link."""
    one = tokens.select(F.col("id").alias("a"), F.col("tokens").alias("s"))
    two = tokens.select(F.col("id").alias("b"), F.col("tokens").alias("t"))
    return pairs.hint("merge").join(one, "a").join(two, "b").where(linked(F.col("s"), F.col("t"), percent)).select("a", "b")


def viable(rows: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """Written (id, group, n, common, light) of the (id, group) that can link outside their group.

    n counts a document's tokens, common those of them that other groups have.

    Tokens that no other group has are private.  With s common and p, q private
    tokens, the similarity of two documents of different groups is s / (s + p + q)
    at most, and s is no more than the tokens that are not private.  So a document
    with too many private tokens links with nothing outside, and of two that link
    one at least is light: has no more than half as many.
    """
    held = written(rows.hint("merge").join(tokens, "id").select("id", "group", "tokens"))

    def shared(spread: DataFrame) -> DataFrame:
        owners = spread.groupBy("token").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low != high").select("token")
        return spread.join(owners.hint("merge"), "token").groupBy("id").agg(F.count("*").alias("common"))

    by_wave = in_waves(held.select("id", "group", F.explode("tokens").alias("token")), "token", shared)
    common = by_wave.groupBy("id").agg(F.sum("common").alias("common"))
    dropped(held)
    told = rows.join(tokens.select("id", F.size("tokens").alias("n")), "id").join(common, "id")
    private = F.col("n") - F.col("common")
    out = written(told.where(private * percent <= F.col("common") * (100 - percent)).select("id", "group", "n", "common", (private * 2 * percent <= F.col("common") * (100 - percent)).alias("light")))
    dropped(by_wave)
    return out


def shared_keys(c: int, percent: int, least: np.ndarray, segments: int, d: int) -> int:
    """How many keys linked sets of class c share at least, of their first d + that many, but for a chance of MISS.

    Fewer than n share them only if all common tokens lie in the d segments that differ and n - 1 others.
    """
    common = max(1, percent * int(least[c]) // 100)
    sure = [n for n in (16, 12, 8, 4, 3, 2) if segments - d >= n and comb(segments - d, n - 1) * ((n - 1 + d) / segments) ** common <= MISS]
    return sure[0] if sure else 1


def rare_keys(rows: DataFrame, percent: int) -> DataFrame:
    """(id, mine, lead, need): each document's rarest keys, the rarest of all, and how many of them linked ones share.

    Segments are three times finer here, or as many as in classes() where small
    sets need more lest all common tokens fall into segments that differ.  Linked sets differ in at most d of them,
    and in no more than a document's own size allows, so of the keys in each class,
    ordered by how many documents have them, the
    first d + n of both hold n common ones (see `shared_keys`).  What most of a group of copies shares
    is never among those of documents that differ from it; keys of one group alone go.
    """
    least, coarse = classes(percent)
    differing = [most_differing(percent, int(high)) for high in least[1:]]
    counts = [max(3 * d + 1, c) for d, c in zip(differing, coarse)]
    needs = [shared_keys(c, percent, least, counts[c], d) for c, d in enumerate(differing)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, groups, keys, class_, enough, need = [], [], [], [], [], []
            for i, group, row in zip(batch.column("id").to_pylist(), batch.column("group").to_pylist(), batch.column("tokens")):
                tokens = row.values.to_numpy().view(np.uint64)
                for c, own in zip(own_classes(len(tokens), percent, least), segment_keys(tokens, percent, least, counts)):
                    ids.append(np.full(len(own), i))
                    groups.append(np.full(len(own), group))
                    keys.append(own.view(np.int64))
                    class_.append(np.full(len(own), c, np.int32))
                    enough.append(np.full(len(own), min(differing[c], len(tokens) * (100 - percent) // percent) + needs[c], np.int32))
                    need.append(np.full(len(own), needs[c], np.int32))
            if ids:
                yield pa.record_batch([pa.array(np.concatenate(x)) for x in (ids, groups, keys, class_, enough, need)], ["id", "group", "key", "class", "enough", "need"])

    fine = rows.select("id", "tokens", "group").mapInArrow(run, "id long, group long, key long, class int, enough int, need int")
    held = fine.groupBy("key").agg(F.count("*").alias("times"), F.min("group").alias("low"), F.max("group").alias("high"))
    order = F.row_number().over(Window.partitionBy("id", "class").orderBy("times", "key"))
    first = fine.join(held.hint("merge"), "key").withColumn("nth", order).where("nth <= enough and low != high")
    return first.groupBy("id").agg(F.collect_set("key").alias("mine"), F.min_by("key", F.struct("times", "key")).alias("lead"), F.min("need").alias("need"))


def nodes_of(sets: DataFrame) -> DataFrame:
    """(n, f1, f2, first, id): each set of tokens that is not empty, its least document, and its node.

    The node is that document's id; if it has several sets (rows of one id with
    different texts), those but one have a negative hash as node.
    """
    found = sets.where("n > 0 and doc_id is not null").groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("first"))
    found = written(found)
    several = found.groupBy("first").agg(F.min_by("f1", F.struct("n", "f1", "f2")).alias("main"), F.count("*").alias("times")).where("times > 1").drop("times")
    own = F.when(F.col("main").isNull() | (F.col("main") == F.col("f1")), F.col("first")).otherwise(-F.shiftrightunsigned(F.xxhash64("n", "f1", "f2"), 1) - 1)
    nodes = written(found.join(several, "first", "left").select("n", "f1", "f2", "first", own.alias("id")))
    dropped(found)
    return nodes


def document_components(docs: DataFrame, k: int = 3, percent: int = 90, part: int = 16) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    sets = written(token_sets(docs, k, percent))
    nodes = nodes_of(sets)
    # (n, f1, f2) of a set that many documents have is a large key on one side only, so Spark can split it
    keyed = written(sets.where("n > 0 and doc_id is not null").join(nodes.hint("merge"), ["n", "f1", "f2"]).where("doc_id = first").dropDuplicates(["doc_id", "n", "f1", "f2"]).select("id", "keys"))
    sized = written(sets.select("doc_id", "n", "f1", "f2"))
    dropped(sets)
    full = sized.where("n > 0 and doc_id is not null")

    def meetings(own: DataFrame) -> DataFrame:
        own = own.repartition("key")  # dealt by key once, for the hubs and for meeting them
        hubs = own.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("last")).where("hub != last").drop("last")
        return own.join(hubs.hint("merge"), "key").where("id != hub").groupBy("id", "hub").agg(F.count("*").alias("shared"))

    own = keyed.select("id", F.explode("keys").alias("key")).where("id is not null and key is not null")
    by_wave = in_waves(own, "key", meetings)
    met = written(by_wave.groupBy("id", "hub").agg(F.sum("shared").alias("shared")))
    dropped(by_wave)
    active = met.select("id").union(met.select("hub")).distinct()
    ids = written(nodes.select("id", "first", "f1").join(active, "id"))
    tokens = written(tokens_of(docs, ids, k))
    dropped(ids)

    best = met.groupBy(F.col("id").alias("a")).agg(F.max_by("hub", F.struct("shared", -F.col("hub"))).alias("b"))
    edges = written(verified(best, tokens, percent))
    dropped(met)
    parts_of = components(edges)
    groups = written(tokens.select("id").join(parts_of, "id", "left").select("id", F.coalesce("component_id", "id").alias("group")))
    dropped(parts_of)

    again = keyed.join(groups.hint("merge"), "id").select("id", "group", F.explode("keys").alias("key"))

    def between(rows: DataFrame) -> DataFrame:
        split = rows.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low != high").select("key")
        return rows.join(split.hint("merge"), "key").select("id", "group").distinct()

    by_wave = in_waves(again, "key", between)
    open_ids = written(by_wave.distinct())
    dropped(by_wave, keyed, groups)
    able_ids = viable(open_ids, tokens, percent)
    dropped(open_ids)
    rare = written(rare_keys(able_ids.join(tokens, "id"), percent))
    sizes = able_ids.groupBy("group").agg(F.count_if("light").alias("size"))
    asking = written(able_ids.join(sizes, "group").join(rare, "id"))
    dropped(able_ids, rare)

    # light members of a component of like sizes that share their rarest key are one group of the matrix, at most about `part` of them
    light = asking.where("light").withColumn("band", F.floor(F.log("n") * BANDS))
    crowds = light.groupBy("group", "lead", "band").agg(F.count("*").alias("crowd"))
    members = written(light.join(crowds, ["group", "lead", "band"]).withColumn("part", F.xxhash64("lead", "band", F.pmod(F.xxhash64("id"), F.ceil(F.col("crowd") / part)))))
    parts = members.groupBy(F.col("group").alias("other"), "part").agg(F.min("n").alias("low_n"), F.max("n").alias("high_n"), F.max("common").alias("high_common"), F.max("size").alias("other_size"), F.min("need").alias("other_need"), F.array_distinct(F.flatten(F.collect_list("mine"))).alias("theirs"))
    parts = parts.select("*", F.explode("theirs").alias("key"))
    unions = members.select("id", "group", "part").join(tokens, "id").groupBy("group", "part").agg(F.array_distinct(F.flatten(F.collect_list("tokens"))).alias("union"))
    asked = asking.select("*", F.explode("mine").alias("key"))
    fits = (F.col("n") * percent <= F.col("high_n") * 100) & (F.col("low_n") * percent <= F.col("n") * 100)
    fits = fits & enough_common(F.least("common", "high_common"), F.col("n"), F.col("low_n"), percent)
    # of two components with light documents, the smaller one asks
    smaller = F.struct("size", "group") < F.struct("other_size", "other")
    apart = (F.col("group") != F.col("other")) & (~F.col("light") | smaller)
    # a document and a group that share enough keys meet on the least of them only
    both = F.array_intersect("mine", "theirs")
    once = (F.array_min(both) == F.col("key")) & (F.size(both) >= F.least("need", "other_need"))
    meets = written(asked.join(parts.hint("merge"), "key").where(apart & fits & once).select("id", F.col("other").alias("group"), "part", "low_n", "n", "common", "mine", "need"))
    bounded = meets.join(tokens, "id").join(unions, ["group", "part"]).where(bound(F.col("tokens"), F.col("union"), F.col("low_n"), percent)).select(F.col("id").alias("a"), "group", "part", "n", "common", "mine", "need")
    inside = members.select(F.col("id").alias("b"), F.col("group").alias("g"), F.col("part").alias("p"), F.col("n").alias("m"), F.col("common").alias("other_common"), F.col("mine").alias("theirs"), F.col("need").alias("other_need"))
    able = enough_common(F.least("common", "other_common"), F.col("n"), F.col("m"), percent) & (F.size(F.array_intersect("mine", "theirs")) >= F.least("need", "other_need"))
    opened = bounded.join(inside, (F.col("group") == F.col("g")) & (F.col("part") == F.col("p")) & able).select("a", "b")
    late = written(verified(opened, tokens, percent))
    dropped(tokens, meets, members, asking)

    # nodes of one document are one
    twice = full.join(nodes, ["n", "f1", "f2"]).select("doc_id", "id")
    ends = twice.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a != z").drop("z")
    same = ends.join(twice, "doc_id").where("a != id").select("a", F.col("id").alias("b")).distinct()
    linked_ = components(edges.unionByName(late).unionByName(same))
    least = nodes.select("id", "first").join(linked_, "id").groupBy("component_id").agg(F.min("first").alias("least"))
    joined = written(nodes.join(linked_.join(least, "component_id").select("id", "least"), "id", "left").select("n", "f1", "f2", F.coalesce("least", "first").alias("least")))
    dropped(edges, late, linked_, nodes)
    told = full.select("doc_id", "n", "f1", "f2").join(joined, ["n", "f1", "f2"]).select("doc_id", "n", "least")
    empty = sized.where("n = 0 or doc_id is null").select("doc_id", "n", F.col("doc_id").alias("least"))
    return told.unionByName(empty).select("doc_id", F.col("n").alias("n_shingles"), F.col("least").alias("component_id"))
