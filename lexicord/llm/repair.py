"""Conversation structure repair: the cheapest edits that make roles alternate, and the conversation they give.

Nodes of the edit lattice are (rows consumed, last role given); edges keep, give
another role to, delete or insert a row.  Bidirectional Dijkstra labels nodes with
cost and least audit (the edits' initials) from the front and from the back,
nearest first and at equal cost fewest rows first, so that edges without cost come
in order.  When the two nearest open nodes together cost more than the best
meeting, every node of an equal best path is labelled from one side or lies next to
one that is; the least concatenated audit over all meetings of best cost is the
answer.  Two audits of equal cost to one node differ before either ends (an edit
more would cost more), so least parts make the least whole.  A lattice depends on
few letters a row, and equal ones are solved once in a worker.

Rows are dealt by ranges of conversation, turn, role and text, so a conversation
of any size lies over as many tasks as it needs.  One within a task that has at
most SEGMENT rows is solved there.  Others are cut into segments: each is solved
for every role before it and after it, the few results are chained, and each
segment then builds its piece of the repaired text with the edits chosen for it.

Rows of a conversation stand by turn, nulls first; rows of one turn by role and
then by the hash of their text.  Faults, the first of which counts: blank (nothing
but ASCII white space), duplicate (role and text stood earlier), truncated (the
last character that is not white space is no `.`, `!` or `?`).

Edge cases: null role and text are one space; a null conversation id is an id; a
null turn counts neither as a gap nor as a turn; a conversation whose rows are all
deleted is the empty text with an audit of deletions; an empty table gives no
rows; columns other than the four are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexicord.llm.shared import dropped, written

#: Rows and characters of a segment; a conversation of more rows is solved in segments.
SEGMENT = 256
SEGMENT_TEXT = 2_000_000
#: Characters of one batch that a task gives back.
BATCH_TEXT = 4_000_000

BLANKS = " \t\n\x0b\x0c\r"
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (NOTHING, ASSISTANT)
#: Where a role's initial leads from a state.
AFTER = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
#: The role that must come next, and the state it leads to.
NEXT = {NOTHING: ("user", USER), SYSTEM: ("user", USER), ASSISTANT: ("user", USER), USER: ("assistant", ASSISTANT)}
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3


def step_edges(code: str, state: int) -> list[tuple[int, str, int]]:
    """(cost, edit, state after) of what may happen to a row; its code is `x` if it must go, else its initial, upper case if truncated."""
    out = [(DELETE, "D", state)]
    if code != "x":
        more, initial = (TRUNCATED, code.lower()) if code.isupper() else (0, code)
        kept = AFTER.get((state, initial))
        if kept is not None:
            out.append((more, "K", kept))
        if kept != NEXT[state][1]:  # else keeping gives the same for less
            out.append((more + REROLE, "R", NEXT[state][1]))
    return out


FORWARD = {(c, q): step_edges(c, q) for c in "xsuaoSUAO" for q in range(4)}
BACKWARD = {(c, q): [(w, x, p) for p in range(4) for w, x, t in FORWARD[c, p] if t == q] for c in "xsuaoSUAO" for q in range(4)}
BEFORE = {q: [p for p in range(4) if NEXT[p][1] == q] for q in range(4)}


@lru_cache(maxsize=50_000)
def cheapest(codes: str, start: int = NOTHING, ends: tuple[int, ...] = ENDS) -> tuple[int, str] | None:
    """Cost and audit of the cheapest edits from `start` to one of `ends`, the least audit of equals; None if there are none."""
    n = len(codes)
    front, back = {(0, start): (0, "")}, {(n, q): (0, "") for q in ends}
    ahead, behind = [(0, 0, start)], [(0, 0, q) for q in ends]
    best = 0 if any((0, start) == node for node in back) else None

    while ahead and behind and (best is None or ahead[0][0] + behind[0][0] <= best):
        forward = ahead[0] <= behind[0]
        heap, own, other = (ahead, front, back) if forward else (behind, back, front)
        cost, rows, state = heappop(heap)
        i = rows if forward else n - rows
        settled, audit = own[i, state]
        if settled < cost:
            continue
        edges = []
        if forward:
            edges.append((INSERT, "I", i, NEXT[state][1]))
            if i < n:
                edges += [(w, x, i + 1, q) for w, x, q in FORWARD[codes[i], state]]
        else:
            edges += [(INSERT, "I", i, p) for p in BEFORE[state]]
            if i:
                edges += [(w, x, i - 1, p) for w, x, p in BACKWARD[codes[i - 1], state]]
        for w, x, j, q in edges:
            label = (cost + w, audit + x if forward else x + audit)
            known = own.get((j, q))
            if known is None or label < known:
                own[j, q] = label
                if known is None or label[0] < known[0]:
                    heappush(heap, (label[0], j if forward else n - j, q))
                met = other.get((j, q))
                if met and (best is None or label[0] + met[0] < best):
                    best = label[0] + met[0]
    if best is None:
        return None
    return best, min(a + back[node][1] for node, (c, a) in front.items() if node in back and c + back[node][0] == best)


def code_of(role: str, text: str, repeated: bool) -> tuple[str, int | None]:
    """A row's code, and its fault: 0 blank, 1 duplicate, 2 truncated, None."""
    bare = text.rstrip(BLANKS)
    if not bare:
        return "x", 0
    if repeated:
        return "x", 1
    initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return (initial, None) if bare[-1] in ".!?" else (initial.upper(), 2)


def illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def edited(edits: str, state: int, rows: list[tuple[str, str]]) -> list[str]:
    """`role:text` of the rows that the edits give."""
    out, left = [], iter(rows)
    for x in edits:
        if x == "I":
            role, text = NEXT[state][0], ""
        else:
            role, text = next(left)
        if x == "D":
            continue
        if x == "R":
            role = NEXT[state][0]
        state = AFTER[state, role[:1]]
        out.append(f"{role}:{text}")
    return out


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with faults made by the checksum of `conv_id:turn`: dropped, emptied, without ends of sentences, repeated, role user."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), (F.crc32(F.encode(key, "UTF-8")) % 20).alias("kind"))
    rows = rows.where("kind != 0").withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"))


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
TOLD = ", ".join(f"{c} long" for c in COUNTS) + ", audit string"


def solved(turns: list, rows: list[tuple[str, str]]) -> tuple:
    """Counts, audit and repaired text of a whole conversation."""
    seen, codes, faults = set(), [], [0, 0, 0]
    for row in rows:
        code, fault = code_of(*row, row in seen)
        seen.add(row)
        codes.append(code)
        if fault is not None:
            faults[fault] += 1
    real = [t for t in turns if t is not None]
    gaps = max(real) - min(real) + 1 - len(set(real)) if real else 0
    cost, audit = cheapest("".join(codes))
    return gaps, *faults, illegal([r[:1] for r, _ in rows]), cost, audit, "\n".join(edited(audit, NOTHING, rows))


def segments(rows: DataFrame) -> DataFrame:
    """Written table of whole conversations, solved, and of segments of the others (closed false), `seg` ascending.

    The first and last conversation of a task may go on in another one, so both
    are left open.
    """
    conv_type, turn_type = rows.schema["conv_id"].dataType.simpleString(), rows.schema["turn"].dataType.simpleString()
    tie = F.xxhash64("text")
    # copies of one row are alike, so a number may split them
    dealt = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    dealt = dealt.repartitionByRange("conv_id", "turn", "role", tie, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 20))).sortWithinPartitions("conv_id", "turn", "role", tie, "text")
    fields = [f.name for f in _segment_fields(rows)]
    kinds = {f.name: f for f in _segment_fields(rows)}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        seg = TaskContext.get().partitionId() << 32
        out, size = [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r.get(f) for r in out], kinds[f].type) for f in fields], fields)

        conv, turns, own, length, whole = None, [], [], 0, False

        def closed_row() -> dict:
            return {"conv_id": conv, "seg": seg, "closed": True} | dict(zip((*COUNTS, "audit", "repaired"), solved(turns, own)))

        def open_row() -> dict:
            return {"conv_id": conv, "seg": seg, "closed": False, "turns": turns, "roles": [r for r, _ in own], "texts": [t for _, t in own]}

        for b in batches:
            for c, turn, role, text in zip(*(b.column(k).to_pylist() for k in ("conv_id", "turn", "role", "text"))):
                if own and c != conv:  # the conversation ends in this task
                    out.append(closed_row() if whole else open_row())
                    size += length
                    seg, turns, own, length, whole = seg + 1, [], [], 0, True
                elif len(own) == SEGMENT or length > SEGMENT_TEXT:
                    out.append(open_row())
                    size += length
                    seg, turns, own, length, whole = seg + 1, [], [], 0, False
                conv = c
                turns.append(turn)
                own.append((role, text))
                length += len(text) + 100
                if size > BATCH_TEXT:
                    yield batch()
                    out, size = [], 0
        if own:
            out.append(open_row())
        if out:
            yield batch()

    schema = f"conv_id {conv_type}, seg long, closed boolean, {TOLD}, repaired string, turns array<{turn_type}>, roles array<string>, texts array<string>"
    return written(dealt.mapInArrow(cut, schema))


def _segment_fields(rows: DataFrame) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_type

    conv, turn = (to_arrow_type(rows.schema[c].dataType) for c in ("conv_id", "turn"))
    told = [pa.field(c, pa.int64()) for c in COUNTS] + [pa.field("audit", pa.string()), pa.field("repaired", pa.string())]
    parts = [pa.field("turns", pa.list_(turn)), pa.field("roles", pa.list_(pa.string())), pa.field("texts", pa.list_(pa.string()))]
    return pa.schema([pa.field("conv_id", conv), pa.field("seg", pa.int64()), pa.field("closed", pa.bool_()), *told, *parts])


def segment_costs(parts: DataFrame) -> DataFrame:
    """Written (conv_id, seg, costs, audits, faults, illegal, ends, turns) of open segments: costs and audits by state before (x 4) and after.

    A row is a duplicate unless it is the first of its conversation with its role
    and text; firsts are minima over all segments, and go to their segments.
    """
    rows = parts.select("conv_id", "seg", F.posexplode(F.arrays_zip("roles", "texts")).alias("k", "r"))
    firsts = rows.groupBy("conv_id", F.col("r.roles").alias("role"), F.sha2(F.encode("r.texts", "UTF-8"), 256).alias("hash")).agg(F.min(F.struct("seg", "k")).alias("at"))
    firsts = firsts.groupBy(F.col("at.seg").alias("seg")).agg(F.collect_list("at.k").alias("firsts"))  # at most a segment's rows
    joined = parts.select("conv_id", "seg", "turns", "roles", "texts").join(firsts.hint("merge"), "seg", "left").select("conv_id", "seg", "turns", "roles", "texts", "firsts")
    conv_type, turn_type = parts.schema["conv_id"].dataType.simpleString(), parts.schema["turns"].dataType.elementType.simpleString()
    schema = f"conv_id {conv_type}, seg long, costs array<int>, audits array<string>, faults array<long>, illegal long, ends array<string>, distinct long, least {turn_type}, most {turn_type}"

    def cost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = {c: [] for c in ("costs", "audits", "faults", "illegal", "ends", "distinct", "least", "most")}
            for turns, roles, texts, new in zip(*(b.column(k).to_pylist() for k in ("turns", "roles", "texts", "firsts"))):
                new, codes, faults = set(new or ()), [], [0, 0, 0]
                for k, (role, text) in enumerate(zip(roles, texts)):
                    code, fault = code_of(role, text, k not in new)
                    codes.append(code)
                    if fault is not None:
                        faults[fault] += 1
                found = [cheapest("".join(codes), p, (q,)) for p in range(4) for q in range(4)]
                real = [t for t in turns if t is not None]
                out["costs"].append([f and f[0] for f in found])
                out["audits"].append([f and f[1] for f in found])
                out["faults"].append(faults)
                out["illegal"].append(illegal([r[:1] for r in roles]))
                out["ends"].append([roles[0][:1], roles[-1][:1]])
                out["distinct"].append(len(set(real)))
                out["least"].append(real[0] if real else None)
                out["most"].append(real[-1] if real else None)
            turn = b.schema.field("turns").type.value_type
            kinds = {"costs": pa.list_(pa.int32()), "audits": pa.list_(pa.string()), "faults": pa.list_(pa.int64()), "illegal": pa.int64(), "ends": pa.list_(pa.string()), "distinct": pa.int64(), "least": turn, "most": turn}
            yield pa.record_batch([b.column("conv_id"), b.column("seg"), *[pa.array(v, kinds[c]) for c, v in out.items()]], ["conv_id", "seg", *out])

    return written(joined.mapInArrow(cost, schema))


def chained(costs: DataFrame) -> DataFrame:
    """Written (conv_id, seg, state, edits) of each segment of the best chain, and a row of counts (seg null) for each conversation.

    A conversation's segments pass one after another; what stays of them are the
    four best audits so far and each segment's choice.
    """
    conv_type = costs.schema["conv_id"].dataType.simpleString()

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("conv_id", "seg", "state", "edits", *COUNTS, "audit")

        def finish(c: dict) -> list[tuple]:
            end = min((c["best"][q], q) for q in ENDS if c["best"][q])[1]
            (cost, audit), state, out = c["best"][end], end, []
            for seg, before, audits in reversed(c["steps"]):
                p = before[state]
                out.append((c["conv"], seg, p, audits[4 * p + state], *[None] * 7))
                state = p
            gaps = c["most"] - c["least"] + 1 - c["distinct"] if c["least"] is not None else 0
            return [*out, (c["conv"], None, None, None, gaps, *c["faults"], c["illegal"], cost, audit)]

        def batch(out: list[tuple], like: pa.RecordBatch) -> pa.RecordBatch:
            kinds = [like.schema.field("conv_id").type, pa.int64(), pa.int32(), pa.string(), *[pa.int64()] * 6, pa.string()]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names)

        c = b = None
        for b in batches:
            out = []
            for r in b.to_pylist():
                if c is None or r["conv_id"] != c["conv"]:
                    out += finish(c) if c else []
                    c = {"conv": r["conv_id"], "best": [(0, ""), None, None, None], "steps": [], "faults": [0, 0, 0], "illegal": 0, "last": None, "distinct": 0, "least": None, "most": None}
                ways = [[(f[0] + w, f[1] + a, p) for p in range(4) if (f := c["best"][p]) and (w := r["costs"][4 * p + q]) is not None and (a := r["audits"][4 * p + q]) is not None] for q in range(4)]
                best = [min(w) if w else None for w in ways]
                c["steps"].append((r["seg"], [x and x[2] for x in best], r["audits"]))
                c["best"] = [x and x[:2] for x in best]
                c["faults"] = [x + y for x, y in zip(c["faults"], r["faults"])]
                c["illegal"] += r["illegal"] + (c["last"] is not None and c["last"] + r["ends"][0] not in ("su", "ua", "au"))
                c["last"] = r["ends"][1]
                if r["least"] is not None:
                    c["distinct"] += r["distinct"] - (r["least"] == c["most"])
                    c["least"] = r["least"] if c["least"] is None else c["least"]
                    c["most"] = r["most"]
            if out:
                yield batch(out, b)
        if c:
            yield batch(finish(c), b)

    dealt = costs.repartition("conv_id").sortWithinPartitions("conv_id", "seg")
    return written(dealt.mapInArrow(chain, f"conv_id {conv_type}, seg long, state int, edits string, {TOLD}"))


def pieces_of(parts: DataFrame, chosen: DataFrame) -> DataFrame:
    """(conv_id, seg, repaired) of each open segment that gives any rows."""
    joined = parts.select("conv_id", "seg", "roles", "texts").join(chosen.where("seg is not null").select("seg", "state", "edits").hint("merge"), "seg").select("conv_id", "seg", "roles", "texts", "state", "edits")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(*(b.column(k).to_pylist() for k in ("roles", "texts", "state", "edits")))
            made = [edited(edits, state, list(zip(roles, texts))) for roles, texts, state, edits in rows]
            yield pa.record_batch([b.column("conv_id"), b.column("seg"), pa.array(["\n".join(x) if x else None for x in made], pa.string())], ["conv_id", "seg", "repaired"])

    return joined.mapInArrow(build, f"conv_id {parts.schema['conv_id'].dataType.simpleString()}, seg long, repaired string").where("repaired is not null")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit), a row for each conversation, and (conv_id, seg, whole, repaired).

    The second has the repaired text as `role:text` lines, whole, or in pieces
    that follow one another by `seg`; a conversation without any row left has
    the empty text or no piece.
    """
    parts = segments(rows)
    left = parts.where("not closed")
    costs = segment_costs(left)
    chosen = chained(costs)
    dropped(costs)
    told = ("conv_id", *COUNTS, "audit")
    done = parts.where("closed")
    counts = done.select(*told).unionByName(chosen.where("seg is null").select(*told))
    texts = done.select("conv_id", "seg", F.lit(True).alias("whole"), "repaired")
    return counts, texts.unionByName(pieces_of(left, chosen).select("conv_id", "seg", F.lit(False).alias("whole"), "repaired"))


def text_digests(texts: DataFrame) -> DataFrame:
    """(conv_id, sha): the hash of each conversation's repaired text; pieces pass through it in order, one at a time."""
    whole = texts.where("whole").select("conv_id", F.sha2(F.encode("repaired", "UTF-8"), 256).alias("sha"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, running, b = None, None, None
        for b in batches:
            ids, shas = [], []
            for c, text in zip(b.column("conv_id").to_pylist(), b.column("repaired").to_pylist()):
                if running and c == conv:
                    running.update(b"\n")
                else:
                    if running:
                        ids.append(conv)
                        shas.append(running.hexdigest())
                    conv, running = c, hashlib.sha256()
                running.update(text.encode())
            yield pa.record_batch([pa.array(ids, b.schema.field("conv_id").type), pa.array(shas, pa.string())], ["conv_id", "sha"])
        if running:
            yield pa.record_batch([pa.array([conv], b.schema.field("conv_id").type), pa.array([running.hexdigest()])], ["conv_id", "sha"])

    dealt = texts.where("not whole").select("conv_id", "seg", "repaired").repartition("conv_id").sortWithinPartitions("conv_id", "seg")
    return whole.unionByName(dealt.mapInArrow(digest, f"conv_id {texts.schema['conv_id'].dataType.simpleString()}, sha string"))


def structure_repair(conversations: DataFrame) -> DataFrame:
    """Damage and repair: one row for each conversation id of the table, with the hash of the repaired text."""
    counts, texts = repair(damaged(conversations))
    rows = counts.select("conv_id", F.struct(*COUNTS, "audit").alias("told"), F.lit(None).cast("string").alias("sha"))
    rows = rows.unionByName(text_digests(texts).select("conv_id", F.lit(None).cast(rows.schema["told"].dataType).alias("told"), "sha"))
    rows = rows.unionByName(conversations.select("conv_id").distinct(), allowMissingColumns=True)
    # of each id one row has counts and one has the hash
    found = rows.groupBy("conv_id").agg(F.max("told").alias("told"), F.max("sha").alias("sha"))
    zero = [F.coalesce(F.col(f"told.{c}"), F.lit(0)).cast("long").alias(c) for c in COUNTS]
    empty = hashlib.sha256(b"").hexdigest()
    return found.select("conv_id", *zero, F.coalesce("told.audit", F.lit("")).alias("audit"), F.coalesce("sha", F.lit(empty)).alias("repaired_sha256"))
