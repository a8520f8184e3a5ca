"""Filter interaction audit: what each of five filters removes, alone and after the others, in every order.

Words become columns of a sparse document-term matrix.  A task cuts its texts
into words, numbers them by a dictionary of its own, and writes shards in
compressed sparse row form; the words of all tasks' dictionaries meet once, by
word, and get dense numbers of the whole table; each shard's columns are then
renumbered by its dictionary's numbers.  Row sums are words, nonzero counts are
distinct words.  The other flags are attached to the rows, rows are counted by
part and pattern of failures, and the orders are played through on these counts.

Filters (a document fails A to E): A under 200 words; B distinct words under half
of the words; C over 2 % capitals; D a character of `#$%&*|`; E the text of a
smaller id.

Edge cases: null text counts as empty; a null part is the empty string; a row
without id is no copy, nor is another a copy of it, and it has no labels; rows of
one id count each, and are copies only of smaller ids; a document that is labelled
more than once counts as 1 where any label is 1; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexicord.llm.shared import dropped, written
from lexicord.llm.textarrays import BLANK, pieces, spans

FILTERS = "ABCDE"
#: Text of one shard, and words of one local dictionary; both bound what a task holds.
SHARD_BYTES = 8_000_000
DICTIONARY_WORDS = 600_000

ODD = np.zeros(256, bool)
ODD[list(b"#$%&*|")] = True


def packed(values: np.ndarray) -> bytes:
    """32-bit integers with all lowest bytes first, so that the zeros of small ones lie together."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(body: bytes) -> np.ndarray:
    return np.frombuffer(body, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)


def per_row(mask: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How many bytes of each row the mask holds."""
    return np.diff(np.searchsorted(np.flatnonzero(mask), starts))


class Dictionary:
    """Numbers words in order of their first occurrence in a task."""

    def __init__(self):
        self.numbers: dict[bytes, int] = {}

    def encode(self, body: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """The number of each word of all rows, where rows begin among them, and the words that are new."""
        begins, ends, firsts = spans(~BLANK[body], starts)
        offsets = np.append(0, np.cumsum(ends - begins))
        kept = body[~BLANK[body]]
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(kept)]).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        new = [w for w in distinct if w not in self.numbers]
        self.numbers.update(zip(new, range(len(self.numbers), len(self.numbers) + len(new))))
        local = np.fromiter((self.numbers[w] for w in distinct), np.int64, len(distinct))
        return local[coded.indices.to_numpy()], firsts, new


def rows_of(numbers: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row pointers, columns (ascending within a row) and counts of a shard."""
    row = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    keys, counts = np.unique(row << 32 | numbers, return_counts=True)
    return np.searchsorted(keys, np.arange(len(firsts)) << 32), keys & 0xFFFFFFFF, counts


SHARD = "dictionary long, first long, words array<binary>, ids array<{id}>, parts array<string>, capitals array<boolean>, odd array<boolean>, digests array<binary>, pointers binary, columns binary, counts binary"


def local_shards(docs: DataFrame) -> DataFrame:
    """Shards numbered by the dictionaries of their tasks; docs has (id, part, text).

    `words` are those that a shard adds to its dictionary, from number `first` on.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, nth, words = TaskContext.get().partitionId(), 0, Dictionary()
        for batch, body, starts in pieces(batches, most=SHARD_BYTES):
            if len(words.numbers) > DICTIONARY_WORDS:
                words, nth = Dictionary(), nth + 1
            first = len(words.numbers)
            numbers, firsts, new = words.encode(body, starts)
            pointers, columns, counts = rows_of(numbers, firsts)
            # columns ascend within a row, so their steps are small but at the begins of rows
            steps = np.diff(columns, prepend=0)
            full = pointers[:-1][np.diff(pointers) > 0]
            steps[full] = columns[full]
            points = np.diff(starts) - per_row((body & 0xC0) == 0x80, starts)
            capitals = 100 * per_row((body >= 65) & (body <= 90), starts) > 2 * points
            digests = [hashlib.sha256(body[a:b]).digest() for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
            one = {
                "dictionary": pa.array([task << 24 | nth], pa.int64()),
                "first": pa.array([first], pa.int64()),
                "words": pa.array([new], pa.list_(pa.binary())),
                "ids": pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column("id")),
                "parts": pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column("part")),
                "capitals": pa.array([capitals.tolist()], pa.list_(pa.bool_())),
                "odd": pa.array([(per_row(ODD[body], starts) > 0).tolist()], pa.list_(pa.bool_())),
                "digests": pa.array([digests], pa.list_(pa.binary())),
                "pointers": pa.array([packed(pointers)], pa.binary()),
                "columns": pa.array([packed(steps)], pa.binary()),
                "counts": pa.array([packed(counts)], pa.binary()),
            }
            yield pa.RecordBatch.from_pydict(one)

    return docs.mapInArrow(build, SHARD.format(id=docs.schema["id"].dataType.simpleString()))


def global_numbers(shards: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Written (dictionary, local, part, nth, word) of all words of local dictionaries, and (part, base).

    Equal words meet in one sorted partition and get its next number; base plus
    nth is a word's dense number.  A word has a row for each local dictionary that
    holds it; `word` stands on the first of them only.
    """

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, last, seen = TaskContext.get().partitionId(), None, -1
        for batch in batches:
            if not batch.num_rows:
                continue
            words = batch.column("word").cast(pa.large_binary())
            new = np.ones(len(words), bool)
            new[1:] = np.array(pa.compute.not_equal(words[1:], words[:-1]))
            new[0] = words[0].as_py() != last
            nth = seen + np.cumsum(new)
            last, seen = words[-1].as_py(), int(nth[-1])
            word = pa.compute.if_else(pa.array(new), words, None).cast(pa.binary())
            yield pa.record_batch([batch.column("dictionary"), batch.column("local"), pa.array(np.full(len(nth), part)), pa.array(nth), word], ["dictionary", "local", "part", "nth", "word"])

    words = shards.select("dictionary", "first", F.posexplode("words").alias("pos", "word")).select("dictionary", (F.col("first") + F.col("pos")).alias("local"), "word")
    numbered = written(words.repartition("word").sortWithinPartitions("word").mapInArrow(number, "dictionary long, local long, part long, nth long, word binary"))
    sizes = numbered.groupBy("part").agg((F.max("nth") + 1).alias("n"))  # one row for each shuffle partition
    base = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return numbered, sizes.select("part", F.coalesce(base, F.lit(0)).alias("base"))


def renumbered(shards: DataFrame, numbered: DataFrame, bases: DataFrame) -> DataFrame:
    """(dictionary, local, column): the number in the whole table of each word of each local dictionary."""
    return numbered.join(F.broadcast(bases), "part").select("dictionary", "local", (F.col("base") + F.col("nth")).alias("column"))


def whole_columns(numbers: pa.Table) -> np.ndarray:
    """The numbers of a local dictionary in the whole table, by local number."""
    out = np.empty(numbers.num_rows, np.int64)
    out[numbers.column("local").to_numpy()] = numbers.column("column").to_numpy()
    return out


def shard_rows(shard: dict, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row pointers, columns by whole-table numbers and counts of a written shard."""
    pointers, steps, counts = (unpacked(shard[c]) for c in ("pointers", "columns", "counts"))
    run = np.cumsum(steps)
    row = np.repeat(np.arange(len(pointers) - 1), np.diff(pointers))
    before = np.where(pointers[:-1] > 0, np.append(run, 0)[pointers[:-1] - 1], 0)
    return pointers, whole[run - before[row]], counts


def document_terms(docs: DataFrame, id_col: str = "doc_id", part_col: str = "source", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The matrix: (id, part, columns, counts, capitals, odd, digest), a row for each document, and the dictionary (word, column)."""
    shards, numbered, bases = _built(docs, id_col, part_col, text_col)
    words = numbered.where("word is not null").join(F.broadcast(bases), "part").select(F.col("word").cast("string").alias("word"), (F.col("base") + F.col("nth")).alias("column"))

    def lines(shard: dict, whole: np.ndarray, ids: pa.Array) -> pa.Table:
        pointers, columns, counts = shard_rows(shard, whole)
        cut = lambda x: pa.ListArray.from_arrays(pa.array(pointers, pa.int32()), pa.array(x, pa.int64()))
        return _table(shard, ids, columns=cut(columns), counts=cut(counts))

    return _by_dictionary(shards, renumbered(shards, numbered, bases), lines, "columns array<long>, counts array<long>"), words


def measured(docs: DataFrame, id_col: str = "doc_id", part_col: str = "source", text_col: str = "text") -> DataFrame:
    """Written (id, part, n_words, n_distinct, capitals, odd, digest), a row for each document: row sums and nonzero counts."""
    shards, numbered, bases = _built(docs, id_col, part_col, text_col)

    def sums(shard: dict, whole: np.ndarray, ids: pa.Array) -> pa.Table:
        pointers, columns, counts = shard_rows(shard, whole)
        row = np.repeat(np.arange(len(pointers) - 1), np.diff(pointers))
        order = np.lexsort((columns, row))
        new = np.ones(len(row), bool)
        new[1:] = (np.diff(columns[order]) != 0) | (np.diff(row[order]) != 0)
        n = len(pointers) - 1
        n_words = np.bincount(row, counts, n).astype(np.int64)
        return _table(shard, ids, n_words=pa.array(n_words), n_distinct=pa.array(np.bincount(row[order][new], minlength=n).astype(np.int64)))

    out = written(_by_dictionary(shards, renumbered(shards, numbered, bases), sums, "n_words long, n_distinct long"))
    dropped(shards, numbered)
    return out


def _built(docs: DataFrame, id_col: str, part_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.col(text_col).alias("text"))
    shards = written(local_shards(rows))
    return shards, *global_numbers(shards)


def _table(shard: dict, ids: pa.Array, **more: pa.Array) -> pa.Table:
    told = {"id": ids, "part": pa.array(shard["parts"], pa.string())} | more
    told |= {"capitals": pa.array(shard["capitals"], pa.bool_()), "odd": pa.array(shard["odd"], pa.bool_()), "digest": pa.array(shard["digests"], pa.binary())}
    return pa.table(told)


def _by_dictionary(shards: DataFrame, numbers: DataFrame, made, columns: str) -> DataFrame:
    """What `made` makes of each shard and its dictionary's numbers; both sides of a group are bounded by DICTIONARY_WORDS."""

    def together(left: pa.Table, right: pa.Table) -> Iterator[pa.RecordBatch]:
        whole, out = whole_columns(right), []
        for k in range(left.num_rows):
            one = left.slice(k, 1)
            shard = {c: one.column(c)[0].as_py() for c in ("parts", "capitals", "odd", "digests", "pointers", "columns", "counts")}
            out.append(made(shard, whole, one.column("ids").combine_chunks().flatten()))
        return pa.concat_tables(out)

    kind = shards.schema["ids"].dataType.elementType.simpleString()
    left = shards.drop("first", "words").groupBy("dictionary")
    return left.cogroup(numbers.groupBy("dictionary")).applyInArrow(together, f"id {kind}, part string, {columns}, capitals boolean, odd boolean, digest binary")


def failures(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", part_col: str = "source", text_col: str = "text") -> DataFrame:
    """(part, fails, good, toxic, n): documents by part, failed filters (bit k for the k-th) and labels.

    Equal rows are counted before they meet ids, and only ids meet: a text of any
    number of copies sends its least id to the document of that id.
    """
    rows = measured(docs, id_col, part_col, text_col)
    flags = [F.col("n_words") < 200, 100 * F.col("n_distinct") < 50 * F.col("n_words"), F.col("capitals"), F.col("odd")]
    fails = sum((f.cast("int") * (1 << k) for k, f in enumerate(flags)), F.lit(0))
    counted = rows.groupBy("id", "digest", "part", fails.alias("fails")).agg(F.count("*").alias("n"))
    firsts = rows.where("id is not null").groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    one = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)))
    told = labels.select(F.col("doc_id").alias("id"), "quality", "toxic").where("id is not null").groupBy("id").agg(one("quality").alias("good"), one("toxic").alias("toxic"))
    known = counted.where("id is not null").join(firsts.hint("merge"), ["id", "digest"], "left").join(told.hint("merge"), "id", "left")
    copy = (F.col("first").isNull().cast("int") * 16).alias("copy")
    no = F.lit(False)
    known = known.select("part", (F.col("fails") + copy).alias("fails"), F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"), "n")
    nameless = counted.where("id is null").select("part", "fails", no.alias("good"), no.alias("toxic"), "n")
    return known.unionByName(nameless).groupBy("part", "fails", "good", "toxic").agg(F.sum("n").alias("n"))


def interactions(counts: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) from failures().

    For each set of filters the documents that none of it fails are summed; a step
    of an order is a difference of two such sums.  All orders are the 600 rows of a
    literal, and a part is one row of 32 sums.
    """
    n, fails = F.col("n"), F.col("fails")
    single = [F.sum(F.when(fails.bitwiseAND(1 << k) > 0, n).otherwise(0)) for k in range(5)]
    alone = [F.sum(F.when(fails == 1 << k, n).otherwise(0)) for k in range(5)]
    # a document that fails k filters is removed by each of them in 120 / k orders
    share = (n * 120 / F.bit_count(fails)).cast("long")
    shapley = [F.sum(F.when(fails.bitwiseAND(1 << k) > 0, share).otherwise(0)) for k in range(5)]
    by_filter = counts.groupBy("part").agg(*[F.array(*x).alias(name) for name, x in (("fail", single), ("alone", alone), ("shapley", shapley))])
    passing = counts.withColumn("passed", F.explode(F.array(*[F.lit(s) for s in range(32)])))
    through = F.when(fails.bitwiseAND(F.col("passed")) == 0, n).otherwise(0)
    sums = passing.groupBy("part", "passed").agg(F.sum(through).alias("n"), F.sum(F.when(F.col("good"), through).otherwise(0)).alias("g"), F.sum(F.when(F.col("toxic"), through).otherwise(0)).alias("t"))
    sums = sums.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("passed", "n", "g", "t"))).alias("s"))  # 32 of them
    steps = []
    for order in permutations(range(5)):
        before = 0
        for step, k in enumerate(order):
            steps.append((("".join(FILTERS[i] for i in order)), step + 1, k, before, before | 1 << k))
            before |= 1 << k
    told = F.from_json(F.lit(str([{"o": o, "i": i, "k": k, "b": b, "a": a} for o, i, k, b, a in steps]).replace("'", '"')), "array<struct<o:string,i:int,k:int,b:int,a:int>>")
    rows = sums.join(by_filter, "part").withColumn("x", F.explode(told))
    at = lambda which, c: F.get("s", F.col(f"x.{which}"))[c]
    own = lambda c: F.get(c, F.col("x.k"))
    removed = at("b", "n") - at("a", "n")
    return rows.select(
        "part",
        F.col("x.o").alias("filter_order"),
        F.col("x.i").alias("step"),
        at("a", "n").alias("kept"),
        removed.alias("removed"),
        (own("fail") - removed).alias("redundant"),
        own("alone").alias("unique_fails"),
        (at("b", "g") - at("a", "g")).alias("good_lost"),
        (at("b", "t") - at("a", "t")).alias("toxic_lost"),
        own("shapley").alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """interactions() of the five filters over whole documents, by source."""
    return interactions(failures(docs, labels))
