"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A sketch has three tables of cells. A paragraph's digest goes into one cell of each: the
cell counts it and adds it, and a check hash of it, by exclusive or. Sketches of one size
subtract cell by cell; what two versions share cancels out, and the differing digests come
back by peeling: a cell with one digest left gives it away, taking that digest out of its
other cells frees more. Where peeling gets stuck the versions are sketched again in larger
tables. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from daystar.llm.tables import stored

#: Cells per table of the fingerprint, and how much larger each retry is.
CELLS = 8
GROWTH = 16
TABLES = 3
#: Peeling looks at one table after the other, this many times in all.
TURNS = 12
#: Cells per table that differences are looked for in at first. Empty cells have no row, so
#: larger tables cost nothing but their name.
FIRST_CELLS = 64
#: Digests that a task sketches and peels, about; each becomes several rows there.
TASK_DIGESTS = 100_000
# Documents of neighbouring ids that are handed to one window, as a power of two.
_BLOCK_BITS = 6
# Row numbers of a sorted partition, in the numbers that `monotonically_increasing_id` gives.
_PARTITION_BITS = 33
#: Paragraphs end at line breaks and, within a line, after every sentence; scripts that set no blank
#: after a sentence end it with marks of their own.
PARAGRAPH_END = r"\n|(?<=[.!?…؟।۔]) +|(?<=[。！？])"
#: A paragraph beyond this many characters is cut at its smaller marks too, in any script.
LONG_PARAGRAPH = 1000
CLAUSE_END = r"(?<=[,;:،؛]) +|(?<=[、，；：])"


def digests(text):
    """The different paragraph digests of a text column, as an array of longs.

    Where a text is cut follows from the characters around, so what an edit leaves alone is cut as before.
    """
    pieces = F.flatten(
        F.transform(
            F.split(text, PARAGRAPH_END),
            lambda p: F.when(F.length(p) > LONG_PARAGRAPH, F.split(p, CLAUSE_END)).otherwise(F.array(p)),
        )
    )
    return F.array_distinct(F.transform(F.filter(pieces, lambda p: p != ""), lambda p: F.xxhash64(p)))


def followers(ids):
    """(id, next) of different longs in `ids` (column id): the next greater one, or null.

    Ids are sorted into ranges taken from the data, and numbered as they are written; the next one has
    the next number. Only the last of a range is followed by the first of a later one: these
    are as many as the sort has partitions, and meet in one window.
    """
    ordered = stored(
        ids.select("id").orderBy("id").select("id", F.monotonically_increasing_id().alias("at")), "ordered-ids"
    )
    after = ordered.select((F.col("at") - 1).alias("at"), F.col("id").alias("next"))
    ranges = ordered.groupBy(F.shiftright("at", _PARTITION_BITS).alias("range")).agg(F.min("id").alias("head"))
    heads = ranges.select("range", F.lead("head").over(Window.partitionBy().orderBy("head")).alias("head"))
    return (
        ordered.join(after, "at", "left")
        .withColumn("range", F.shiftright("at", _PARTITION_BITS))
        .join(heads, "range", "left")
        .select("id", F.coalesce("next", "head").alias("next"))
    )


def with_next(docs):
    """id, text and next_text of every document; the last one's next is the first.

    Rows that repeat an id follow each other in the order of their texts. Neighbours in a block of ids come
    together by one shuffle. The first text of every block, found before anything is shuffled,
    is sent a second time, to the block before it.
    """
    blocked = docs.withColumn("block", F.shiftright("id", _BLOCK_BITS))
    in_block = Window.partitionBy("block").orderBy("id", "text")
    rows = blocked.select(
        "block",
        "id",
        "text",
        F.lead("text").over(in_block).alias("next_text"),
        F.lead("id").over(in_block).isNull().alias("last"),
    )
    heads = stored(
        blocked.groupBy("block").agg(F.min(F.struct("id", "text")).alias("head")).select("block", "head.text"),
        "heads",
    )
    after = followers(heads.select(F.col("block").alias("id")))
    first = heads.agg(F.min("block")).first()[0]
    following = after.select(
        F.col("id").alias("of"), F.coalesce("next", F.lit(first).cast("long")).alias("block")
    )
    borrowed = heads.join(following, "block").select(
        F.col("of").alias("block"), F.col("text").alias("borrowed")
    )
    return rows.join(borrowed, "block", "left").select(
        "id", "text", F.when(F.col("last"), F.col("borrowed")).otherwise(F.col("next_text")).alias("next_text")
    )


def versions(docs):
    """doc, n_chars, edited_sha256 and the digests of the text, its edited form and the next text.

    `id` is a number of the row, since ids of documents may repeat.
    """
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    rows = with_next(docs).withColumn("n_chars", F.length("text"))
    edited = F.concat(
        F.substring("text", F.lit(1), F.col("n_chars") - quarter),
        F.substring("next_text", F.lit(1), quarter),
    )
    return rows.select(
        "id", "n_chars", edited.alias("edited"), digests("text").alias("own"), digests("next_text").alias("after")
    ).select(
        F.monotonically_increasing_id().alias("id"),
        F.col("id").alias("doc"),
        F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "own",
        digests("edited").alias("changed"),
        "after",
    )


def _place(table, digest, cells):
    """Cell of a digest in a table."""
    spread = F.xxhash64(F.lit(7), digest)
    return F.pmod(F.shiftright(spread, 20 * table), F.lit(cells)).cast("int")


def _check(digest):
    return F.xxhash64(F.lit(11), digest)


def _into_cells(rows, cells, *keys):
    """Adds up (keys, sign, digest) into (keys, tab, cell, n, digest, check)."""
    spread = rows.select(
        *keys,
        "sign",
        "digest",
        F.posexplode(F.array(*(_place(t, F.col("digest"), cells) for t in range(TABLES)))).alias("tab", "cell"),
    )
    return spread.groupBy(*keys, "tab", "cell").agg(
        F.sum("sign").alias("n"),
        F.bit_xor("digest").alias("digest"),
        F.bit_xor(_check(F.col("digest"))).alias("check"),
    )


def fingerprints(texts, *keys):
    """keys and fingerprint (base64 of the cells) of rows (keys, digests).

    A cell is its table and place, its count, the digests and the checks; empty cells are
    left out, so equal sets of paragraphs give equal strings and others differ.
    """
    rows = texts.select(*keys, F.lit(1).alias("sign"), F.explode_outer("digests").alias("digest"))
    some = rows.where(F.col("digest").isNotNull())
    cells = _into_cells(some, CELLS, *keys)
    written = F.concat(
        F.lpad(F.hex(F.col("tab") * CELLS + F.col("cell")), 2, "0"),
        F.lpad(F.hex("n"), 8, "0"),
        F.lpad(F.hex("digest"), 16, "0"),
        F.lpad(F.hex("check"), 16, "0"),
    )
    return cells.groupBy(*keys).agg(
        # Written without the line breaks that base64 may set.
        F.translate(
            F.base64(F.unhex(F.array_join(F.array_sort(F.collect_list(written)), ""))), "\r\n", ""
        ).alias("fingerprint")
    )


def _peeled(cells, size, *keys):
    """Cells after peeling, and the digests that were recovered as cells of table -1.

    One table at a time: in it a digest has one cell, so two cells never give away the same
    digest at once. A cell that holds one digest sends it to the recovered ones and takes it
    out of all its cells; all sums are by key, so data that is partitioned by it stays.
    """
    for turn in range(TURNS):
        table = turn % TABLES
        single = (
            (F.col("tab") == table)
            & (F.abs("n") == 1)
            & (_check(F.col("digest")) == F.col("check"))
        )
        itself = F.struct("tab", "cell", "n", "digest", "check")
        out = [
            F.struct(
                F.lit(t).alias("tab"),
                _place(t, F.col("digest"), size).alias("cell"),
                (-F.col("n")).alias("n"),
                F.col("digest").alias("digest"),
                F.col("check").alias("check"),
            )
            for t in range(TABLES)
        ]
        # Recovered digests count by sign only; their cell is the sign.
        found = F.struct(
            F.lit(-1).alias("tab"),
            F.col("n").cast("int").alias("cell"),
            F.lit(1).cast("long").alias("n"),
            F.lit(0).cast("long").alias("digest"),
            F.lit(0).cast("long").alias("check"),
        )
        moves = F.when(single, F.array(itself, *out, found)).otherwise(F.array(itself))
        cells = (
            cells.select(*keys, F.explode(moves).alias("c"))
            .select(*keys, "c.*")
            .groupBy(*keys, "tab", "cell")
            .agg(F.sum("n").alias("n"), F.bit_xor("digest").alias("digest"), F.bit_xor("check").alias("check"))
            .where("n <> 0 or digest <> 0 or check <> 0")
        )
    return cells


def by_row(table):
    """Rows of `table` (id, own, changed, after) dealt by id, so many to a task that it can peel them in memory."""
    total = table.agg(F.sum(F.size("own") + F.size("changed") + F.size("after"))).first()[0] or 0
    return table.repartition(int(total) // TASK_DIGESTS + 1, "id")


def differences(pairs, cells=FIRST_CELLS, by_id=None):
    """id, pair, left and right: how many digests only one of the two sides has.

    `pairs` has id, pair and the arrays `x` and `y`. Sketches of x and y are subtracted and
    peeled; pairs that do not come out empty are sketched again in tables GROWTH times as
    large, until every pair has. Two equal sides leave nothing to peel. `by_id` gives the
    same rows where they are hash-partitioned by id already.
    """
    # One shuffle by id; sketching, subtracting and peeling keep to it.
    sides = pairs.repartition("id") if by_id is None else by_id
    pairs, solved = sides, None
    while True:
        signed = pairs.select(
            "id",
            "pair",
            F.explode(F.concat(_signed("x", 1), _signed("y", -1))).alias("d"),
        ).select("id", "pair", "d.*")
        diff = _into_cells(signed, cells, "id", "pair").where(
            "n <> 0 or digest <> 0 or check <> 0"
        )
        count = lambda sign: F.sum(
            F.when((F.col("tab") == -1) & (F.col("cell") == sign), F.col("n")).otherwise(0)
        )
        result = stored(
            _peeled(diff, cells, "id", "pair")
            .groupBy("id", "pair")
            .agg(
                count(1).alias("left"),
                count(-1).alias("right"),
                F.max(F.col("tab") >= 0).alias("stuck"),
            ),
            "differences",
        )
        done = result.where(~F.col("stuck")).drop("stuck")
        solved = done if solved is None else solved.union(done)
        stuck = result.where("stuck").groupBy("id").agg(F.collect_set("pair").alias("stuck"))
        if stuck.isEmpty():
            return solved
        # By id, as the data lies; the digests are read again from where they are stored.
        left = sides.join(stuck, "id").where(F.array_contains("stuck", F.col("pair")))
        pairs = left.select("id", "pair", "x", "y")
        cells *= GROWTH


def _signed(side, sign):
    return F.transform(
        side, lambda d: F.struct(d.alias("digest"), F.lit(sign).cast("long").alias("sign"))
    )


def compare(docs):
    """doc_id, n_chars, edited_sha256, the two fingerprints and their likenesses.

    Likeness of two sketches: shared digests, twice, to the digests of both sides; 1 where
    neither has any. It follows from the numbers of digests and of recovered differences.
    Null texts count as empty. A null doc_id comes last, as the greatest id (2^63 - 1 is
    read as null); rows that repeat an id follow each other in the order of their texts.
    An empty table gives no rows; a single document is its own next one.
    """
    last = (1 << 63) - 1
    keyed = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(last)).alias("id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    table = stored(versions(keyed), "versions")
    rows = by_row(table)
    sides = rows.select(
        "id",
        F.explode(
            F.array(
                F.struct(F.lit(1).alias("pair"), F.col("own").alias("x"), F.col("changed").alias("y")),
                F.struct(F.lit(2).alias("pair"), F.col("own").alias("x"), F.col("after").alias("y")),
            )
        ).alias("p"),
    ).select("id", "p.*")
    apart = differences(sides, by_id=sides)
    # Pairs without any digest, and equal ones, have no row.
    differing = apart.groupBy("id").agg(
        *(
            F.sum(F.when(F.col("pair") == pair, F.col("left") + F.col("right")).otherwise(0)).alias(f"d{pair}")
            for pair in (1, 2)
        )
    )
    prints = fingerprints(
        rows.select(
            "id",
            F.explode(
                F.array(
                    F.struct(F.lit(0).alias("which"), F.col("own").alias("digests")),
                    F.struct(F.lit(1).alias("which"), F.col("changed").alias("digests")),
                )
            ).alias("v"),
        ).select("id", "v.*"),
        "id",
        "which",
    )
    both = prints.groupBy("id").agg(
        *(
            F.max(F.when(F.col("which") == which, F.col("fingerprint"))).alias(name)
            for which, name in ((0, "fingerprint"), (1, "edited_fingerprint"))
        )
    )

    def likeness(other, differing):
        whole = F.size("own") + F.size(other)
        return F.when(whole == 0, F.lit(1.0)).otherwise(
            1 - F.coalesce(F.col(differing), F.lit(0)) / F.greatest(whole, F.lit(1))
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (
        rows.join(both, "id", "left")
        .join(differing, "id", "left")
        .select(
            F.when(F.col("doc") != last, F.col("doc")).cast(kind).alias("doc_id"),
            "n_chars",
            "edited_sha256",
            F.coalesce("fingerprint", F.lit("")).alias("fingerprint"),
            F.coalesce("edited_fingerprint", F.lit("")).alias("edited_fingerprint"),
            likeness("changed", "d1").alias("near_edited"),
            likeness("after", "d2").alias("near_next"),
        )
    )
