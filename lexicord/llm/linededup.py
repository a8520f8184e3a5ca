"""Line dedup by a deletion-neighbourhood join, in DataFrame operations alone.

A line goes if an earlier line (by document id, then place) has the same words,
or if it has at least `near_words` words and an earlier line of such length is
one word edit away: a word put in, left out or replaced.  Whether the earlier
line itself stays makes no difference.

Every line emits all its variants with one word left out, as hashed keys.  Two
lines of equal length that share a variant with the same place left out differ
by one replacement; a line that equals another's variant lacks one word of it.
Both cases need only the least place among the lines that emit a key, so a key
shared by any number of lines is a minimum, never a set of pairs.  Candidates
are verified against the earliest such line word by word.

Only lines that share half their words in order with another line can have a
neighbour (an edit leaves one half whole), so the others emit no variants.

Edge cases: null texts have no lines; blank lines are always kept and never
matched; white space around and between words does not count; lines shorter than
`exact_words` words are kept (the queries pass 1, so every line that is not blank
is compared).  Rows with the same id count as one document: equal
places never remove each other.  Its rows are told apart by their texts' hashes,
so each loses its own lines.  A null id comes last.  Other columns, whatever
their names, do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexicord.llm.shared import dropped, written


def one_blank(text: Column) -> Column:
    """The text with one blank for each run of blanks; most texts have no other runs and are not searched."""
    odd = F.contains(text, F.lit("  ")) | F.contains(text, F.lit("\t")) | F.contains(text, F.lit("\r"))
    return F.when(odd, F.regexp_replace(text, "[ \t\r]+", " ")).otherwise(text)


def document_key() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))


def text_key() -> Column:
    """Tells rows of one id apart."""
    return F.xxhash64("text")


def place(doc: str, pos: str) -> Column:
    """Document and place of a line as one number, in their order."""
    return F.col(doc).cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(10,0)") + F.col(pos)


def measured_lines(docs: DataFrame, exact_words: int, near_words: int) -> DataFrame:
    """(doc, pos, tie, n, h1, h2, k0..k3) of all lines of `exact_words` words or more; h1 and h2 identify the words, k are half keys."""
    lines = docs.select(document_key().alias("doc"), text_key().alias("tie"), F.posexplode(F.split(one_blank(F.col("text")), "\n")).alias("pos", "line"))
    words = lines.select("doc", "pos", "tie", F.trim("line").alias("line")).where("line != ''").withColumn("n", F.expr("octet_length(line) - octet_length(replace(line, ' ', '')) + 1"))
    if exact_words > 1:
        words = words.where(F.col("n") >= exact_words)
    return words.select("doc", "pos", "tie", "n", F.xxhash64("line").alias("h1"), F.hash("line").alias("h2"), *[F.when(F.col("n") >= near_words, k).alias(f"k{i}") for i, k in enumerate(halves())])


def halves() -> list[Column]:
    """Keys of the first and the last half, as a line of n words and as one of n - 1 words and one more."""
    return [F.expr(f"xxhash64({side}, n - {shorter}, substring_index(line, ' ', {words}))") for shorter in (0, 1) for side, words in ((0, f"(n - {shorter}) div 2"), (1, f"(n - {shorter}) div 2 - (n - {shorter})"))]


def near_lines(kept: DataFrame, docs: DataFrame, near_words: int) -> DataFrame:
    """(h1, h2, near_first): lines with an earlier neighbour, and the neighbour's place."""
    keys = kept.where(F.col("n") >= near_words).select("h1", "h2", F.explode(F.array("k0", "k1", "k2", "k3")).alias("key"))
    shared = keys.groupBy("key").agg(F.min("h1").alias("low"), F.max("h1").alias("high")).where("low != high").select("key")
    active = written(keys.join(shared, "key").select("h1", "h2").distinct())
    wanted = active.join(kept.select("h1", "h2", "first", "tie"), ["h1", "h2"])
    doc, pos = F.expr("cast(floor(first / 2147483648) as long)"), F.expr("cast(pmod(first, 2147483648) as int)")
    by_doc = wanted.groupBy(doc.alias("doc"), "tie").agg(F.collect_list(F.struct("h1", "h2", "first", pos.alias("pos"))).alias("wanted"))
    texts = docs.select(document_key().alias("doc"), text_key().alias("tie"), "text").join(by_doc, ["doc", "tie"])
    parts = F.array(F.split(one_blank(F.col("text")), "\n"))
    picked = F.transform(parts, lambda p: F.transform("wanted", lambda w: F.struct(w["h1"].alias("h1"), w["h2"].alias("h2"), w["first"].alias("first"), F.trim(F.get(p, w["pos"])).alias("line"))))
    found = texts.select(F.inline(F.get(picked, 0))).where(F.xxhash64("line") == F.col("h1")).dropDuplicates(["h1", "h2"])
    own = written(found.select("h1", "h2", "first", F.split("line", " ").alias("words")).withColumn("n", F.size("words")))

    at = own.select("h1", "h2", "first", "n", F.posexplode("words").alias("i", "word")).select("h1", "h2", "first", "n", "i", F.xxhash64("word", "i").alias("c"), F.xxhash64("word", F.col("i") - 1).alias("d"))
    line = Window.partitionBy("h1", "h2")
    run = line.orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    variants = (
        at.withColumn("c_all", F.bit_xor("c").over(line))
        .withColumn("d_all", F.bit_xor("d").over(line))
        .withColumn("c_run", F.bit_xor("c").over(run))
        .withColumn("d_run", F.bit_xor("d").over(run))
        .withColumn("left_out", F.col("c_run").bitwiseXOR(F.col("c")).bitwiseXOR(F.col("d_all")).bitwiseXOR(F.col("d_run")))
    )
    # role 0: replaced here; role 1: a word left out; role 2: the whole line
    emitted = variants.select(
        "h1",
        "h2",
        "first",
        F.explode(
            F.array(
                F.struct(F.xxhash64(F.lit("replaced"), "left_out", "n", "i").alias("key"), F.lit(0).alias("role"), F.lit(True).alias("on")),
                F.struct(F.xxhash64(F.lit("whole"), "left_out", F.col("n") - 1).alias("key"), F.lit(1).alias("role"), F.lit(True).alias("on")),
                F.struct(F.xxhash64(F.lit("whole"), "c_all", "n").alias("key"), F.lit(2).alias("role"), (F.col("i") == 0).alias("on")),
            )
        ).alias("e"),
    ).where("e.on").select("h1", "h2", "first", "e.key", "e.role")
    least = emitted.groupBy("key").agg(F.count("*").alias("times"), *[F.min(F.when(F.col("role") == r, F.col("first"))).alias(f"m{r}") for r in (0, 1, 2)]).where("times > 1")
    earlier = F.when(F.col("role") == 0, F.col("m0")).when(F.col("role") == 1, F.col("m2")).otherwise(F.col("m1"))
    found = emitted.join(least, "key").select("h1", "h2", "first", earlier.alias("near_first")).where("near_first < first").groupBy("h1", "h2").agg(F.min("near_first").alias("near_first"))

    a = own.select("h1", "h2", "words", "n").join(found, ["h1", "h2"])
    b = own.select(F.col("first").alias("near_first"), F.col("words").alias("other"), F.col("n").alias("m"))
    shorter, longer = F.least("n", "m"), F.greatest("n", "m")

    def equal_run(x: Column, y: Column) -> Column:
        """Length of the common start."""
        differs = F.array_position(F.zip_with(F.slice(x, F.lit(1), shorter), F.slice(y, F.lit(1), shorter), lambda p, q: p != q), True)
        return F.when(differs > 0, differs - 1).otherwise(shorter)

    one_edit = equal_run(F.col("words"), F.col("other")) + equal_run(F.reverse("words"), F.reverse("other")) >= longer - 1
    near = written(a.join(b, "near_first").where(one_edit).select("h1", "h2", "near_first"))
    dropped(active, own)
    return near


def removals(docs: DataFrame, exact_words: int = 3, near_words: int = 10) -> DataFrame:
    """(doc, tie, exact, near): places of the lines that go from each row, as sorted arrays."""
    all_lines = written(measured_lines(docs, exact_words, near_words))
    at = place("doc", "pos")
    kept = written(all_lines.groupBy("h1", "h2").agg(F.min(at).alias("first"), F.min_by("tie", at).alias("tie"), F.count("*").alias("times"), F.max("n").alias("n"), *[F.max(f"k{i}").alias(f"k{i}") for i in range(4)]))
    near = near_lines(kept, docs, near_words)
    told = written(kept.select("h1", "h2", "first", "times").join(near, ["h1", "h2"], "left").where("times > 1 or near_first is not null").drop("times"))
    dropped(kept, near)
    gone = all_lines.select("doc", "pos", "tie", "h1", "h2").join(told, ["h1", "h2"]).where((F.col("first") < at) | (F.col("near_first") < at))
    exact = F.col("first") < at
    out = written(gone.groupBy("doc", "tie").agg(F.array_sort(F.collect_set(F.when(exact, F.col("pos")))).alias("exact"), F.array_sort(F.collect_set(F.when(~exact, F.col("pos")))).alias("near")))
    dropped(all_lines, told)
    return out


def without(parts: Column, gone: Column) -> Column:
    """The lines but for those at the sorted places `gone`: the slices between them."""
    bounds = F.concat(F.array(F.lit(-1)), gone, F.array(F.size(parts)))
    slices = lambda p, b: F.transform(F.sequence(F.lit(1), F.size(b) - 1), lambda k: F.slice(p, F.get(b, k - 1) + 2, F.get(b, k) - F.get(b, k - 1) - 1))
    return F.flatten(F.get(F.transform(F.array(F.struct(parts.alias("p"), bounds.alias("b"))), lambda x: slices(x["p"], x["b"])), 0))


def line_dedup(docs: DataFrame, exact_words: int = 3, near_words: int = 10) -> DataFrame:
    """The rows with their columns, `text` without the lines that go, and n_lines, n_exact, n_near (long).

    The three counts replace columns of the same names.
    """
    gone = removals(docs, exact_words, near_words)
    joined = docs.alias("d").join(gone.alias("g"), (document_key() == F.col("g.doc")) & (F.xxhash64("d.text") == F.col("g.tie")), "left")
    none = F.array().cast("array<int>")
    exact, near = F.coalesce("g.exact", none), F.coalesce("g.near", none)
    parts = F.split("d.text", "\n")
    text = F.when(F.col("g.doc").isNull(), F.col("d.text")).otherwise(F.array_join(without(parts, F.array_sort(F.concat("g.exact", "g.near"))), "\n"))
    n_lines = F.expr("octet_length(d.text) - octet_length(replace(d.text, '\n', '')) + 1")
    counts = {"n_lines": F.coalesce(n_lines, F.lit(0)).cast("long"), "n_exact": F.size(exact).cast("long"), "n_near": F.size(near).cast("long")}
    own = [text.alias("text") if c == "text" else F.col(f"d.`{c}`") for c in docs.columns if c not in counts]
    return joined.select(*own, *[v.alias(k) for k, v in counts.items()])
