"""Repair of conversation structure: the cheapest edits that give user and assistant turns in turn.

A conversation of ordinary length is repaired in one piece, by the task that its turns meet in. A
longer one is sorted over many tasks and cut into pieces; each is aligned between all
phases of the alternation, and the pieces are chained in order. Both give the same repair.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from daystar.llm import turn_alignment as alignment
from daystar.llm.tables import stored

#: A conversation with more turns or characters than these is cut into pieces.
LONG_TURNS = 4096
LONG_CHARS = 1 << 24
#: Turns and characters after which a piece ends.
PIECE_TURNS = 512
PIECE_CHARS = 1 << 22
TRUNCATED = 5
BLANKS = " \t\n\x0b\x0c\r"

COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")
TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def is_illegal(before, after):
    return before + after not in ("su", "ua", "au")


def fault_of(text, seen):
    """The first fault of a turn: blank, duplicate, truncated, or None."""
    bare = text.rstrip(BLANKS)
    if not bare:
        return "blank"
    if seen:
        return "duplicate"
    return None if bare[-1] in ".!?" else "truncated"


def faults_of(turns):
    """The first fault of each of the turns (role, text) of a conversation, in order."""
    seen, faults = set(), []
    for turn in turns:
        faults.append(fault_of(turn[1], turn in seen))
        seen.add(turn)
    return faults


def edit_costs(faults):
    """(required, extra) of the alignment: blank and duplicate turns go, truncated ones cost more."""
    return [f in ("blank", "duplicate") for f in faults], [TRUNCATED * (f == "truncated") for f in faults]


def repair_turns(turns):
    """gaps, blank, duplicate, truncated, illegal, cost, audit and turns of one conversation.

    `turns` are (turn, role, text) in any order.
    """
    ordered = sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
    numbers = {t[0] for t in ordered if t[0] is not None}
    said = [t[1:] for t in ordered]
    initials = [role[:1] for role, _ in said]
    faults = faults_of(said)
    found = alignment.transitions(
        initials, *edit_costs(faults), (alignment.START,), (alignment.START, alignment.ANSWERED)
    )
    cost, audit = min(found.values())
    return (
        max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
        *(faults.count(name) for name in ("blank", "duplicate", "truncated")),
        sum(map(is_illegal, initials, initials[1:])),
        cost,
        audit,
        alignment.applied(audit, said),
    )


def _as_turns(rows):
    return pa.array([[{"role": role, "text": text} for role, text in row] for row in rows], TURNS)


_RESULT = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string,"
    " turns array<struct<role: string, text: string>>"
)


def _short(turns):
    """Conversations repaired whole, from rows (conv_id, present, turn, role, text)."""
    said = F.when(F.col("present"), F.struct("turn", "role", "text"))
    grouped = turns.groupBy("conv_id").agg(F.collect_list(said).alias("turns"))
    kind = grouped.schema["conv_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                ids, lists = batch.slice(at, 256).columns
                found = [
                    repair_turns([(t["turn"], t["role"], t["text"]) for t in own.as_py()]) for own in lists
                ]
                *numbers, audits, kept = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [ids, *(pa.array(n, pa.int64()) for n in numbers), pa.array(audits), _as_turns(kept)],
                    names=["conv_id", *COUNTS, "cost", "audit", "turns"],
                )

    return grouped.mapInArrow(run, f"conv_id {kind}, {_RESULT}").select(
        "conv_id", F.lit(0).cast("long").alias("piece"), F.lit(1).cast("long").alias("pieces"),
        *COUNTS, "cost", "audit", "turns",
    )


def _numbered(turns):
    """Turns in order: `at` counts up over all of them, `piece` is the first `at` of each piece.

    The sort spreads a conversation over tasks; its last column splits equal turns as well.
    """
    ordered = turns.orderBy(
        F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text", F.monotonically_increasing_id()
    ).select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("at"))
    schema = StructType([*ordered.schema.fields, StructField("piece", LongType())])

    def run(batches):
        conversation, piece, rows, chars = None, None, 0, 0
        for batch in batches:
            pieces = []
            ids, texts = batch.column(0), batch.column(3)
            for own, text, at in zip(ids, texts, batch.column(4).to_pylist(), strict=True):
                own = own.as_py()
                if piece is None or own != conversation or rows >= PIECE_TURNS or chars >= PIECE_CHARS:
                    conversation, piece, rows, chars = own, at, 0, 0
                rows += 1
                chars += len(text.as_py())
                pieces.append(piece)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(pieces, pa.int64())], names=schema.names
            )

    return stored(ordered.mapInArrow(run, schema), "long-turns")


def _piece_paths(numbered):
    """Per piece: its edge initials, its counts, and the cheapest edits between all phases."""
    digest = F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256)
    bare = F.regexp_replace("text", r"[\x20\x09-\x0D]+\z", "")
    lean = numbered.select(
        "key", "piece", "at", F.substring("role", 1, 1).alias("initial"), digest.alias("digest"),
        (bare == "").alias("blank"), F.substring(bare, -1, 1).isin(".", "!", "?").alias("whole"),
    )
    first = lean.groupBy("key", "digest").agg(F.min("at").alias("first"))
    # A text said very often is one row of `first`; the adaptive join splits its turns over tasks.
    fault = (
        F.when(F.col("blank"), "blank").when(F.col("at") > F.col("first"), "duplicate").when(~F.col("whole"), "truncated")
    )
    grouped = (
        lean.join(first, ["key", "digest"])
        .select("key", "piece", F.struct("at", "initial", fault.alias("fault")).alias("turn"))
        .groupBy("key", "piece")
        .agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    )
    schema = (
        "key string, piece long, head string, tail string, blank long, duplicate long, truncated long,"
        " illegal long, paths array<struct<entry: int, leave: int, cost: long, audit: string>>"
    )
    of_paths = pa.list_(
        pa.struct([("entry", pa.int32()), ("leave", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
    )

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                key, piece, own = (column[row].as_py() for column in batch.columns)
                initials, faults = [t["initial"] for t in own], [t["fault"] for t in own]
                found = alignment.transitions(initials, *edit_costs(faults))
                paths = [
                    {"entry": entry, "leave": leave, "cost": cost, "audit": audit}
                    for (entry, leave), (cost, audit) in found.items()
                ]
                numbers = [faults.count(name) for name in ("blank", "duplicate", "truncated")]
                numbers.append(sum(map(is_illegal, initials, initials[1:])))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([key]), pa.array([piece], pa.int64()), pa.array([initials[0]]), pa.array([initials[-1]]),
                        *(pa.array([n], pa.int64()) for n in numbers), pa.array([paths], of_paths),
                    ],
                    names=["key", "piece", "head", "tail", "blank", "duplicate", "truncated", "illegal", "paths"],
                )

    return grouped.mapInArrow(run, schema)


def _chained(paths):
    """Per piece its part of the best audit and the phase it is entered in; beside it the counts of all.

    A conversation streams through one task, piece by piece; what stays in memory are the
    audits that are still possible, about a byte per turn, which the result needs as well.
    """
    schema = (
        "key string, piece long, pieces long, entry int, audit string, cost long,"
        " blank long, duplicate long, truncated long, illegal long"
    )
    names = [part.split()[0] for part in schema.split(", ")]

    def done(key, pieces, chain, counts):
        cost, parts = chain.best()
        for at in range(0, len(pieces), 4096):
            own, chosen = pieces[at : at + 4096], parts[at : at + 4096]
            size = len(own)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([key] * size), pa.array(own, pa.int64()), pa.array([len(pieces)] * size, pa.int64()),
                    pa.array([entry for _, entry in chosen], pa.int32()), pa.array([audit for audit, _ in chosen]),
                    *(pa.array([n] * size, pa.int64()) for n in (cost, *counts)),
                ],
                names=names,
            )

    def run(batches):
        key, pieces, chain, counts, tail = None, [], None, None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["key"] != key:
                    if key is not None:
                        yield from done(key, pieces, chain, counts)
                    key, pieces, chain, counts, tail = row["key"], [], alignment.Chain(), [0, 0, 0, 0], None
                chain.add({(p["entry"], p["leave"]): (p["cost"], p["audit"]) for p in row["paths"]})
                pieces.append(row["piece"])
                for i, name in enumerate(COUNTS[1:]):
                    counts[i] += row[name]
                counts[3] += tail is not None and is_illegal(tail, row["head"])
                tail = row["tail"]
        if key is not None:
            yield from done(key, pieces, chain, counts)

    return paths.repartition("key").sortWithinPartitions("key", "piece").mapInArrow(run, schema)


def _long(turns):
    """Long conversations repaired piece by piece, from rows (conv_id, turn, role, text)."""
    # A key without nulls, so that conversations without an id meet in plain joins.
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    numbered = _numbered(turns).withColumn("key", key)
    chained = stored(_chained(stored(_piece_paths(numbered), "piece-paths")), "piece-audits")
    numbers = (
        numbered.where("turn IS NOT NULL")
        .groupBy("key", "turn")
        .agg(F.count("*").alias("n"))
        .groupBy("key")
        .agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps"))
    )
    said = F.sort_array(F.collect_list(F.struct("at", "role", "text")))
    pieces = (
        numbered.groupBy("key", "piece")
        .agg(F.first("conv_id").alias("conv_id"), said.alias("said"))
        .join(chained, ["key", "piece"])
        .join(numbers, "key", "left")
        .select(
            "conv_id", "piece", "pieces", F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps"), *COUNTS[1:],
            "cost", "audit", "entry", "said",
        )
    )
    names = ["conv_id", "piece", "pieces", *COUNTS, "cost", "audit", "turns"]
    kind = pieces.schema["conv_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                *before, entry, said = (column.slice(row, 1) for column in batch.columns)
                own = [(t["role"], t["text"]) for t in said[0].as_py()]
                kept = alignment.applied(before[-1][0].as_py(), own, entry[0].as_py())
                yield pa.RecordBatch.from_arrays([*before, _as_turns([kept])], names=names)

    return pieces.mapInArrow(run, f"conv_id {kind}, piece long, pieces long, {_RESULT}")


def repair(conversations, present=None):
    """Repaired conversations: rows of conv_id, piece, pieces, gaps, blank, duplicate, truncated, illegal, cost, audit, turns.

    `conversations` has conv_id, turn, role and text. Turns count in the order of turn, nulls
    first, ties by role and text. Most conversations are one row; one with more than
    LONG_TURNS turns or LONG_CHARS characters is several, `pieces` in number and in order of
    `piece`, each with its part of `audit` (K keep, R rerole, D delete, I insert) and of the
    repaired `turns` (role, text), and all with the counts and the cost of the whole.

    A null role or text is one space; a null conv_id is a conversation of its own; a null turn
    comes first and counts for no gap; equal rows are duplicates of each other. `present` is a
    condition: rows without it only name their conversation, which then has zeros, an empty audit
    and no turns where none is left. Other columns are not read; no rows give no rows.
    """
    turns = conversations.select(
        "conv_id",
        F.lit(True).alias("present") if present is None else F.coalesce(present, F.lit(False)).alias("present"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )
    long_ones = stored(
        turns.where("present")
        .groupBy("conv_id")
        .agg(F.count("*").alias("n"), F.sum(F.length("text") + F.length("role")).alias("chars"))
        .where((F.col("n") > LONG_TURNS) | (F.col("chars") > LONG_CHARS))
        .select(F.col("conv_id").alias("long_id")),
        "long-conversations",
    )
    if not long_ones.take(1):
        return _short(turns)
    same = F.col("conv_id").eqNullSafe(F.col("long_id"))
    rest = turns.join(long_ones, same, "left_anti")
    cut = turns.where("present").join(long_ones, same, "left_semi").drop("present")
    # Written once: digests and counts of long conversations are read from it more than once.
    return _short(rest).unionByName(stored(_long(cut), "long-repairs"))


def damaged(conversations):
    """`conversations` damaged as op13 asks, by crc32 of conv_id:turn modulo 20; `dropped` marks lost rows.

    0 drops the row, 1 empties its text, 2 takes its `.`, `!` and `?` away, 3 repeats it, 4 makes it the
    user's. Nulls count as one space, in the checksum too.
    """

    def shown(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text, role = shown("text"), shown("role")
    return (
        conversations.select(
            "conv_id",
            "turn",
            F.when(kind == 4, "user").otherwise(role).alias("role"),
            F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
            (kind == 0).alias("dropped"),
            F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("copies"),
        )
        .withColumn("copy", F.explode("copies"))
        .drop("copies", "copy")
    )


def _digests_of_long(pieces):
    """audit and repaired_sha256 of conversations in pieces; each streams through a task in order."""
    kind = pieces.schema["conv_id"]
    schema = StructType(
        [kind, StructField("audit", StringType()), StructField("repaired_sha256", StringType())]
    )

    def run(batches):
        now, first, audit, digest, started = None, True, [], None, False

        def done():
            return pa.RecordBatch.from_arrays(
                [pa.array([now], ids.type), pa.array(["".join(audit)]), pa.array([digest.hexdigest()])],
                names=schema.names,
            )

        for batch in batches:
            ids = batch.column(0)
            for row in range(batch.num_rows):
                own, part, turns = ids[row].as_py(), batch.column(2)[row].as_py(), batch.column(3)[row].as_py()
                if digest is None or own != now:
                    if digest is not None:
                        yield done()
                    now, audit, digest, started = own, [], hashlib.sha256(), False
                audit.append(part)
                for turn in turns:
                    digest.update((("\n" if started else "") + turn["role"] + ":" + turn["text"]).encode())
                    started = True
        if digest is not None:
            yield done()

    return (
        pieces.select("conv_id", "piece", "audit", "turns")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "piece")
        .mapInArrow(run, schema)
    )


def report(repaired):
    """One row per conversation: conv_id, the counts, cost, audit, repaired_sha256 (of `role:text` lines).

    The result needs the audit of a conversation in one row and one digest over its turns in order, so those
    of a long one pass through one task, streamed piece by piece.
    """
    numbers = [*COUNTS, "cost"]
    lines = F.transform("turns", lambda turn: F.concat(turn.role, F.lit(":"), turn.text))
    whole = repaired.where("pieces = 1").select(
        "conv_id", *numbers, "audit", F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256")
    )
    parts = repaired.where("pieces > 1")
    counts = parts.groupBy("conv_id").agg(*(F.first(name).alias(name) for name in numbers))
    digests = _digests_of_long(parts).withColumnRenamed("conv_id", "own")
    joined = counts.join(digests, F.col("conv_id").eqNullSafe(F.col("own"))).drop("own")
    return whole.unionByName(joined.select(*whole.columns))
