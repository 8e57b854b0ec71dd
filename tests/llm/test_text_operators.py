"""Operators on documents against brute force, on small tables with every awkward case."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from daystar.llm import bpe, fingerprints, licenses, lines, mixing, quality, repeats, secret_samples, secrets, simhash
from daystar.llm.license_texts import KNOWN
from daystar.llm.oracles import ORACLES
from daystar.llm.queries import PATTERN, RANKS

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, kept string, id long"
WORDS = [f"w{i}" for i in range(300)]


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def prose(seed, n):
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) for _ in range(n))


def texts():
    """Copies, shared passages, nulls, empties, blanks, one very long text, repeated lines."""
    shared = prose("shared", 60)
    found = [
        prose(1, 200),
        prose(2, 30) + " " + shared + " " + prose(3, 30),
        shared + "\n" + prose(4, 25),
        None,
        "",
        " \t\n\n ",
        "one",
        "one two",
        prose(1, 200),
        prose(1, 199) + " changed",
        "same line here\nsame line here\nother line there",
        "SAME line, here!\nother line there\nünïcode ß 日本語 😀",
        "tick " * 80,
        prose(5, 6000),
        "a" * 5000,
        "first sentence. And more. Then that.\nlast line",
    ]
    return found + [shared] * 12


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (i, text, None if i % 5 == 0 else "en", None if i % 7 == 0 else f"s{i % 3}", None, 1, "x", -i)
        for i, text in enumerate(texts())
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.limit(0)


def by_id(df):
    return {row.doc_id: row for row in df.collect()}


def test_repeats(docs):
    found = by_id(repeats.report(repeats.deduplicated(docs)))
    seen = set()
    for i, text in enumerate(texts()):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for start in range(len(words) - 19):
            window = tuple(words[start : start + 20])
            if window in seen:
                gone[start : start + 20] = [True] * 20
            seen.add(window)
        kept = b" ".join(word for word, out in zip(words, gone, strict=True) if not out)
        assert tuple(found[i])[1:] == (len(words), sum(gone), sha(kept))


def test_repeats_give_maximal_spans(spark):
    shared = prose("shared", 60)
    df = spark.createDataFrame([(1, shared), (2, "x " + shared + " y")], "doc_id long, text string")
    assert by_id(repeats.deduplicated(df))[2].spans == [[1, 61]]


def test_bpe(docs):
    import tiktoken

    encoding = bpe.load(RANKS, PATTERN)
    assert isinstance(encoding, tiktoken.Encoding)
    for i, row in by_id(bpe.digests(docs, RANKS, PATTERN)).items():
        text = texts()[i] or ""
        ids = encoding.encode_ordinary(text)
        packed = np.array(ids, dtype="<u4").tobytes()
        assert tuple(row)[1:] == (len(ids), sha(packed), sha(text))


def test_bpe_parts_are_cut_where_no_match_is(monkeypatch):
    import regex

    monkeypatch.setattr(bpe, "LONG_BLANK", 3)
    monkeypatch.setattr(bpe, "_BLANKS", regex.compile(r"\p{White_Space}{3,}"))
    encoding, draw = bpe.load(RANKS, PATTERN), random.Random(5)
    pieces = [" ", "a", "b", "\n", ".", "'s", "1", "é", "  ", "\t", "word", "$", "　", "x y", "\x1c"]
    for _ in range(500):
        text = "".join(draw.choice(pieces) for _ in range(draw.randint(0, 60)))
        wanted = np.array(encoding.encode_ordinary(text), dtype="<u4").tobytes()
        assert bpe.encode_text(encoding, text, draw.randint(1, 20)) == wanted


def test_bpe_takes_millions_of_blanks():
    encoding = bpe.load(RANKS, PATTERN)
    text = "x" + " " * 2_000_000 + "y"
    packed = bpe.encode_text(encoding, text)
    assert encoding.decode_bytes(np.frombuffer(packed, "<u4").tolist()).decode() == text


def brute_print(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    n = min(3, len(words))
    grams = [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
    hashes = [xxhash.xxh64_intdigest(gram, 42) for gram in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(n, linked):
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(n)]


def test_simhash(docs):
    prints = [brute_print(text or "") for text in texts()]
    wanted = components_of(len(prints), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 3)
    for i, row in by_id(simhash.near_duplicates(docs)).items():
        assert (row.fingerprint, row.component_id) == (f"{prints[i]:016x}", wanted[i])


def test_simhash_links_equal_brute_force_on_dense_prints(spark):
    draw = random.Random(9)
    base = [draw.getrandbits(64) for _ in range(12)]
    prints = {b ^ sum(1 << draw.randrange(64) for _ in range(draw.randint(0, 3))) & (2**64 - 1) for b in base for _ in range(25)}
    prints = sorted(p - 2**64 if p >= 2**63 else p for p in prints)
    df = spark.createDataFrame([(p,) for p in prints], "print long")
    wanted = components_of(
        len(prints), lambda i, j: ((prints[i] ^ prints[j]) & (2**64 - 1)).bit_count() <= 3
    )
    tied = {r.node: r.component for r in simhash.components(simhash.links(df)).collect()}
    assert [tied.get(p, p) for p in prints] == [prints[w] for w in wanted]


def test_thresholds_always_cover_the_distance():
    costs = np.random.default_rng(1).random((200, 4, 5))
    chosen = simhash.choose_thresholds(costs, 0)
    assert (chosen.sum(axis=1) == 0).all() and chosen.min() >= -1
    counts = np.random.default_rng(2).integers(0, 9, 256).astype(float)
    near = simhash.ball_counts(counts, 1)
    assert near[1][5] == counts[5] + sum(counts[5 ^ (1 << b)] for b in range(8))


def test_keep_first(docs):
    kept = {row.doc_id for row in simhash.keep_first(docs).collect()}
    found = by_id(simhash.near_duplicates(docs))
    assert kept == {row.component_id for row in found.values()}
    assert simhash.keep_first(docs).columns == docs.columns


def normal_lines(text):
    clean = re.sub(r"[^\w\n]+|_+", " ", text.lower())
    return [line.strip() for line in clean.split("\n")]


def test_lines(spark):
    base = prose("line", 40)
    near = base.replace(base.split()[7], "other", 1)
    rows = [
        (1, f"{base}\nshort one"),
        (2, f"intro of two\n{base.upper()}!\n\n--\nshort one"),
        (3, None),
        (4, ""),
        (5, f"{prose('far', 40)}\nshort one\nshort one"),
        (6, near),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {row.doc_id: row.text for row in lines.deduplicated(df).collect()}
    assert kept[1] == rows[0][1] and kept[3] is None and kept[4] == ""
    assert kept[2] == "intro of two\n\n--"
    assert kept[5] == prose("far", 40)
    assert kept[6] == ""


def test_lines_need_edit_similarity(spark):
    """The same words in another order share a SimHash but are not similar."""
    words = prose("order", 30).split()
    df = spark.createDataFrame(
        [(1, " ".join(words)), (2, " ".join(reversed(words))), (3, " ".join(words) + ".")],
        "doc_id long, text string",
    )
    kept = {row.doc_id: row.text for row in lines.deduplicated(df).collect()}
    assert kept[2] == " ".join(reversed(words)) and kept[3] == ""


def test_every_scheme_of_blocks_finds_near_prints(spark):
    draw = random.Random(3)
    base = draw.getrandbits(62)
    rows = [(base,)] + [(base ^ (1 << a) ^ (1 << b),) for a, b in [(0, 20), (1, 61), (15, 45), (22, 23)]]
    df = spark.createDataFrame(rows, "print long").selectExpr("print", "cast(array() as array<bigint>) as ends")
    for _, blocks, agree in lines.SCHEMES:
        parts = lines.with_buckets(df, blocks, agree)
        met = parts.alias("l").join(parts.alias("r"), "bucket").where(F.col("l.print") == base)
        assert met.select("r.print").distinct().count() == len(rows)


def print_of(line):
    hashes = {xxhash.xxh64_intdigest(word, 42) for word in line.split()}
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def lines_that_share_one_block():
    """Near lines with other ends whose prints agree in one of three blocks, but not in two of four."""
    draw = random.Random(5)
    while True:
        words = [f"word{draw.randrange(10**6)}" for _ in range(30)]
        other = ["x" + words[0][1:], *words[1:-1], words[-1][:-1] + "x"]
        differ = print_of(" ".join(words)) ^ print_of(" ".join(other))
        same = [sum(not differ >> a & (1 << b - a) - 1 for a, b in zip(at, at[1:])) for at in ((0, 21, 42, 64), (0, 16, 32, 48, 64))]
        if same[0] and same[1] < 2 and differ.bit_count() <= lines.DISTANCE:
            return " ".join(words), " ".join(other)


def test_lines_meet_alike_in_tables_of_any_size(spark, monkeypatch):
    """The same texts lose the same lines, however many other lines there are said to be."""
    one, two = lines_that_share_one_block()
    df = spark.createDataFrame([(1, one), (2, two)], "doc_id long, text string")
    for counted in (2, 1 << 24, 1 << 34, 1 << 41):
        monkeypatch.setattr(type(df), "count", lambda self, counted=counted: counted)
        kept = {row.doc_id: row.text for row in lines.deduplicated(df).collect()}
        assert kept == {1: one, 2: ""}


def test_line_stage_of_the_pipeline_meets_alike_at_any_size(spark, monkeypatch):
    one, two = lines_that_share_one_block()
    df = spark.createDataFrame([(1, one, 7), (2, two, 7)], "doc_id long, text string, n_chars long")
    monkeypatch.setattr(type(df), "count", lambda self: 1 << 24)
    kept = {row.doc_id: (row.text, row.n_chars) for row in corpus_pipeline.dedup_lines(spark, df, None).collect()}
    assert kept == {1: (one, 7), 2: ("", 0)}


def test_prints_are_majorities_of_different_words(spark):
    """All words of a line up to 63 different ones, and the 63 of the least hashes beyond."""
    rows = [" ".join(f"w{i}" for i in range(n)) for n in (*range(1, 41), 63, 64, 300)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    for row in lines.line_table(df).collect():
        signed = [h - (h >> 63 << 64) for h in {xxhash.xxh64_intdigest(w, 42) for w in rows[row.key].split()}]
        own = [h & (1 << 64) - 1 for h in sorted(signed)[: lines.WORDS]]
        wanted = sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in own) > len(own))
        assert row.print & (1 << 64) - 1 == wanted


def test_prints_have_all_words_of_long_lines(spark):
    """No word of a line is left out, however many it has."""
    rows = [" ".join(f"w{i}" for i in range(n)) for n in (63, 64, 126, 127, 300, 5000)]
    df = spark.createDataFrame([(1, "\n".join(rows)), (2, rows[-1] + " more")], "doc_id long, text string")
    found = {(row.key, row.pos): row for row in lines.line_table(df).collect()}
    assert len(found) == len(rows) + 1
    for pos, line in enumerate(rows):
        row = found[1, pos]
        assert (row.print & (1 << 64) - 1, row.size, row.short) == (print_of(line), len(line), None)
        assert len(row.ends) == 2
    assert found[2, 0].print & (1 << 64) - 1 == print_of(rows[-1] + " more")


def test_words_count_once_in_a_print(spark):
    df = spark.createDataFrame([(1, "one two three"), (2, "three one two two one one")], "doc_id long, text string")
    assert len({row.print for row in lines.line_table(df).collect()}) == 1


def test_plain_edits_are_enough(spark):
    """Never fewer than the distance; few where one stretch of words is left out and others are changed."""
    draw, rows = random.Random(4), []
    for at in range(300):
        one = draw.choices(["", "a", "bc", "déf", "ghij", "klmnopq"], k=draw.randint(1, 14))
        cut = draw.randrange(len(one))
        two = one[:cut] + one[cut + draw.randint(0, 3) :]
        two = [draw.choice(["bc", "x", word]) for word in two] if at % 2 else two
        rows.append((at, " ".join(one), " ".join(two)))
    df = spark.createDataFrame(rows, "id long, text string, text2 string")
    found = {row.id: row.n for row in df.select("id", lines._plain_edits("text", "text2").alias("n")).collect()}
    for at, one, two in rows:
        assert levenshtein(one, two) <= found[at]
        if at % 2 == 0:
            assert found[at] <= 3 * (1 + max(map(len, one.split(" "))))


def test_walked_edits_are_enough(spark):
    """Never fewer than the distance, and few where words are put in, left out and changed at many places."""
    draw, rows = random.Random(6), []
    for at in range(200):
        one = draw.choices(["", "a", "bc", "déf", "ghij", "klmnopq"], k=draw.randint(1, 14))
        two = [word for word in one for _ in range(draw.choice((0, 1, 1, 1, 2)))]
        rows.append((at, " ".join(one), " ".join(draw.choice(["x", word, word]) for word in two)))
    for at in range(200, 220):
        one = [f"w{draw.randrange(10**4)}" for _ in range(300)]
        two = list(one)
        for place in sorted(draw.sample(range(300), 24), reverse=True):
            two[place : place + 1] = draw.choice(([], ["other"], [two[place], "more"]))
        rows.append((at, " ".join(one), " ".join(two)))
    df = spark.createDataFrame(rows, "id long, text string, text2 string")
    df = df.select("id", lines._walked_edits("text", "text2").alias("n"), lines._plain_edits("text", "text2").alias("plain"))
    found = {row.id: row for row in df.collect()}
    for at, one, two in rows[:200]:
        assert levenshtein(one, two) <= found[at].n
    for at, one, two in rows[200:]:
        most = max(len(one), len(two)) // 5
        assert found[at].n <= most < found[at].plain


def test_lines_are_compared_without_their_shared_ends(spark):
    """What two texts share at their ends is taken off once, and the distance stays."""
    draw, rows = random.Random(9), [("", "a"), ("aa", "aaaa"), ("éa b", "éa c b"), ("x" * 3000 + "y" + "x" * 3000, "x" * 6000)]
    for _ in range(200):
        head, one, two, tail = ("".join(draw.choices("abé ", k=draw.randint(0, n))) for n in (9, 5, 5, 9))
        rows.append((head + one + tail, head + two + tail))
    df = spark.createDataFrame(rows, "text1 string, text2 string")
    found = df.select("*", lines._without_shared("text1", "text2").alias("own")).collect()
    for one, two, own in found:
        assert not own.one or not own.two or own.one[0] != own.two[0] and own.one[-1] != own.two[-1]
        assert len(own.one) <= len(one) and len(one) - len(own.one) == len(two) - len(own.two)
        if len(one) < 100:
            assert levenshtein(one, two) == levenshtein(own.one, own.two)


def test_no_pair_of_lines_is_compared_twice(spark, monkeypatch):
    """Lines of the same words in another order meet in every round, but are compared once."""
    words = prose("again", 30).split()
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(reversed(words)))], "doc_id long, text string")
    verified, compared = lines._verified, []

    def noting(pairs, *more):
        compared.extend(frozenset((row.line, row.line2)) for row in pairs.collect())
        return verified(pairs, *more)

    monkeypatch.setattr(lines, "_verified", noting)
    assert all(row.text for row in lines.deduplicated(df).collect())
    assert len(compared) == 1


def test_lines_of_buckets_are_shuffled_once(spark):
    """Both sides of the join that looks for partners read one shuffle."""
    df = spark.createDataFrame([(i, prose(f"once{i}", 20)) for i in range(5)], "doc_id long, text string")
    different = lines.different_lines(lines.line_table(df))
    before = {name: spark.conf.get(name) for name in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        near = lines.with_partner(different, lines.BLOCKS, lines.AGREE, lines.DISTANCE, lines.SIMILARITY)
        plan = near._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert "ReusedExchange" in plan


def test_texts_of_lines_are_those_of_whole_texts(spark):
    text = "\u039f\u0394\u039f\u03a3\n\u03a3 A_b--C\n--\n\u00c9,\u2028x1 \n\n\u0130I\u03a3"
    rows = lines.told_apart(spark.createDataFrame([(1, text)], "doc_id long, text string"))
    wanted = lines.lines_of(rows).selectExpr("key", "tie", "pos", "cast(pos as long) as line")
    whole = rows.select(lines.normalised(F.col("row.text")).alias("n")).first().n.split("\n")
    found = {row.line: row.text for row in lines.line_texts(rows, wanted).collect()}
    assert found == {at: line.strip(" ") for at, line in enumerate(whole) if line.strip(" ")}


def test_verified_pairs_equal_plain_distance(spark):
    draw, rows = random.Random(2), []
    for at in range(1200):
        one = " ".join("".join(draw.choices("abé", k=draw.randint(1, 4))) for _ in range(draw.randint(1, 9)))
        two = one
        for _ in range(draw.randint(0, 7)):
            place = draw.randrange(len(two) + 1)
            two = two[:place] + draw.choice(["", "a", "b", " ", "x"]) + two[place + draw.randint(0, 2) :]
        rows += [(2 * at, one), (2 * at + 1, two)]
    texts_of = spark.createDataFrame(rows, "line long, text string")
    pairs = spark.range(1200).selectExpr("2 * id as line", "2 * id + 1 as line2", "false as settled")
    for share in (0.5, 0.8, 0.9):
        found = {row.line // 2 for row in lines._verified(pairs, texts_of, share).collect()}
        for at in range(1200):
            one, two = rows[2 * at][1], rows[2 * at + 1][1]
            allowed = int(max(len(one), len(two)) * (1 - share) + 1e-9)
            assert (at in found) == (levenshtein(one, two) <= allowed)


def test_normalised_lines(spark):
    text = "A_b--C\n\u00a0É,\u2014x1\n\n\u0661\x1f_\u3000z"
    df = spark.createDataFrame([(text,)], "text string").select(lines.normalised(F.col("text")).alias("n"))
    assert [line.strip() for line in df.first().n.split("\n")] == ["a b c", "é x1", "", "\u0661 z"]


def edited(draw, line, edits):
    """The line with so many of its characters changed, taken out or put in, all within words."""
    letters = list(line)
    for _ in range(edits):
        at = draw.choice([i for i, c in enumerate(letters) if c != " "])
        change = draw.randrange(3)
        if change == 0:
            letters[at] = draw.choice("abcdefgh")
        elif change == 1 and len(letters) > 2:
            del letters[at]
        else:
            letters.insert(at, draw.choice("abcdefgh"))
    return "".join(letters)


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("words", [(3, 12), (13, 30), (31, 100), (101, 160)], ids=str)
def test_recall_of_planted_lines(spark, words):
    """Lines with up to a fifteenth of their words changed lose at least nine of ten copies to brute force."""
    draw = random.Random(words[0])
    syllables = ["ka", "lo", "mi", "ne", "ru", "st", "th", "and", "of", "er"]
    rows, near = [], 0
    for i in range(120):
        line = " ".join("".join(draw.choices(syllables, k=draw.randint(1, 4))) for _ in range(draw.randint(*words)))
        other = edited(draw, line, max(1, len(line.split()) // 15))
        rows += [(2 * i, line), (2 * i + 1, other)]
        near += 1 - levenshtein(line, other) / max(len(line), len(other)) >= 0.8
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {row.doc_id: row.text for row in lines.deduplicated(df).collect()}
    assert near > 60
    assert sum(kept[2 * i + 1] == "" for i in range(120)) >= 0.9 * near
    assert all(kept[2 * i] for i in range(120))


def test_large_groups_of_variants_list_few_pairs(spark, monkeypatch):
    """Lines far from the first ones of their group are tied in later rounds, before pairs are listed."""
    draw, counted = random.Random(8), []
    base = prose("variants", 60).split()
    rows = []
    for i in range(400):
        words = list(base)
        for at in draw.sample(range(3, 57), 5):
            words[at] = f"v{draw.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    verified = lines._verified

    def counting(pairs, *more):
        counted.append(pairs.count())
        return verified(pairs, *more)

    monkeypatch.setattr(lines, "_verified", counting)
    kept = [row.text for row in lines.deduplicated(df).collect() if row.text]
    assert kept == [rows[0][1]]
    # A tenth of all pairs.
    assert sum(counted) <= len(rows) ** 2 // 20, counted


def test_lines_take_near_ones_before_pairs_are_listed(spark, monkeypatch):
    """Families of variants that all meet each other: members are tied by few links, not by all that they have."""
    draw, rows, linked = random.Random(12), [], []
    base = [f"w{draw.randrange(100)}" for _ in range(60)]

    def changed(words, n):
        new = {at: f"v{draw.randrange(100)}x" for at in draw.sample(range(8, 52), n)}
        return [new.get(at, word) for at, word in enumerate(words)]

    for _ in range(8):
        family = changed(base, 14)
        rows += [" ".join(changed(family, 2)) for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    verified = lines._verified

    def noting(pairs, *more):
        found = verified(pairs, *more).localCheckpoint()
        linked.append(found.count())
        return found

    monkeypatch.setattr(lines, "_verified", noting)
    kept = [row.doc_id for row in lines.deduplicated(df).collect() if row.text]
    assert kept[0] == 0 and len(kept) <= 8
    # All pairs of families are 1,520.
    assert sum(linked) <= 3 * len(rows), linked


def test_line_columns(docs):
    found = lines.deduplicated(docs)
    assert found.dtypes == docs.dtypes
    assert found.count() == docs.count()


def test_mix(docs, spark):
    found = mixing.mix(docs)
    rows = by_id(found)
    sizes = {i: len(re.findall(r"[^\x20\x09-\x0D]+", text or "")) for i, text in enumerate(texts())}
    sources = {i: None if i % 7 == 0 else f"s{i % 3}" for i in sizes}
    total = {s: sum(sizes[i] for i in sizes if sources[i] == s) for s in set(sources.values())}
    assert {i: row.size for i, row in rows.items()} == sizes
    order = sorted(s for s in total if s is not None) + [None]
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    targets, closed = {}, set()
    while True:
        free = [s for s in order if s not in closed]
        rest = 1.5 * sum(total.values()) - sum(2 * total[s] for s in closed)
        targets = {s: 2 * total[s] for s in closed} | {
            s: rest * weights[s] / sum(weights[f] for f in free) for s in free
        }
        over = {s for s in free if targets[s] > 2 * total[s]}
        if not over:
            break
        closed |= over
    for i, row in rows.items():
        assert row.target == pytest.approx(targets[sources[i]])
        assert row.source_size == total[sources[i]]
        assert row.taken in (0, sizes[i], 2 * sizes[i])
    # As near to the target as the largest document of the source allows.
    for s in order:
        own = [i for i in sizes if sources[i] == s]
        assert abs(sum(rows[i].taken for i in own) - targets[s]) <= max(sizes[i] for i in own)
    again = by_id(mixing.mix(docs.repartition(5)))
    assert again == rows
    copies = {r.doc_id: r["count"] for r in mixing.mixed(docs).groupBy("doc_id").count().collect()}
    assert copies == {i: row.copies for i, row in rows.items() if row.copies}


def test_mix_of_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a b", "s")] * 50 + [(None, "c", None)], "doc_id long, text string, source string")
    assert mixing.mix(df).count() == 51


def test_fingerprints(docs):
    found, all_texts = by_id(fingerprints.compare(docs)), [t or "" for t in texts()]

    def digests(text):
        return set(paragraphs(text))

    def likeness(x, y):
        return 1 - len(x ^ y) / (len(x) + len(y)) if x or y else 1.0

    for i, text in enumerate(all_texts):
        after = all_texts[(i + 1) % len(all_texts)]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + after[:quarter]
        row = found[i]
        assert (row.n_chars, row.edited_sha256) == (len(text), sha(edited))
        assert row.near_edited == pytest.approx(likeness(digests(text), digests(edited)))
        assert row.near_next == pytest.approx(likeness(digests(text), digests(after)))
        assert row.fingerprint == sketch(text) and row.edited_fingerprint == sketch(edited)


def paragraphs(text):
    """Paragraphs of a text: at line breaks and after sentences, long ones at smaller marks too."""
    pieces = []
    for part in re.split(r"\n|(?<=[.!?…؟।۔]) +|(?<=[。！？])", text):
        pieces += re.split(r"(?<=[,;:،؛]) +|(?<=[、，；：])", part) if len(part) > 1000 else [part]
    return [piece for piece in pieces if piece]


def sketch(text):
    """The fingerprint of a text by hand: three tables of eight cells."""

    def hashed(seed, digest):
        return xxhash.xxh64_intdigest(digest.to_bytes(8, "little"), xxhash.xxh64_intdigest(bytes([seed, 0, 0, 0]), 42))

    cells = {}
    for digest in {xxhash.xxh64_intdigest(piece.encode(), 42) for piece in paragraphs(text)}:
        spread = hashed(7, digest)
        spread -= (spread >> 63) << 64
        for table in range(3):
            cell = cells.setdefault(table * 8 + (spread >> 20 * table) % 8, [0, 0, 0])
            cell[:] = cell[0] + 1, cell[1] ^ digest, cell[2] ^ hashed(11, digest)
    written = sorted(f"{at:02X}{n:08X}{digest:016X}{check:016X}" for at, (n, digest, check) in cells.items())
    return base64.b64encode(bytes.fromhex("".join(written))).decode()


def test_fingerprints_cut_paragraphs_in_any_script(spark):
    """A quarter of these texts is changed; what stays is found again, whatever the sentences begin with."""
    sentences = {
        1: ["это предложение номер %d." % i for i in range(40)],
        2: ["这是第%d句话。" % i for i in range(40)],
        3: ["zum beispiel satz %d!" % i for i in range(40)],
        4: ["7 numbers start line %d?" % i for i in range(40)],
        5: ["no sentence ends here, part %d" % i + "," for i in range(80)],
    }
    rows = [(i, ("" if i == 2 else " ").join(own)) for i, own in sentences.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = by_id(fingerprints.compare(df))
    assert all(found[i].near_edited > 0.5 for i in sentences)


@pytest.mark.parametrize("key", [None, 7])
def test_fingerprints_of_rows_with_one_id(spark, key):
    """Rows that share an id have a row each, follow each other by text, and then the next id's."""
    rows = [(1, "First one. Alpha beta."), (key, "Second. Gamma."), (key, "Third. Delta."), (key, "Third. Delta.")]
    df = spark.createDataFrame([(*row, "x") for row in rows], "doc_id long, text string, own string")
    found = sorted((r.doc_id or 99, r.n_chars, r.edited_sha256) for r in fingerprints.compare(df).collect())
    order = [text for _, text in rows]
    wanted = []
    for at, (doc, text) in enumerate(rows):
        quarter = len(text) // 4
        wanted.append((doc or 99, len(text), sha(text[: len(text) - quarter] + order[(at + 1) % 4][:quarter])))
    assert found == sorted(wanted)


def test_fingerprints_of_few_and_scattered_ids(spark):
    draw = random.Random(6)
    ids = sorted(draw.getrandbits(63) - (1 << 62) for _ in range(300))
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(7)
    found = {r.id: r.next for r in fingerprints.followers(df).collect()}
    assert found == dict(zip(ids, [*ids[1:], None], strict=True))


def test_fingerprints_retry_until_every_pair_is_solved(spark):
    rows = [(1, 1, list(range(400)), list(range(350, 900))), (2, 1, [5], [5]), (3, 2, [], [7])]
    df = spark.createDataFrame(rows, "id long, pair int, x array<long>, y array<long>")
    solved = {r.id: (r.left, r.right) for r in fingerprints.differences(df, cells=4).collect()}
    assert solved == {1: (350, 500), 3: (0, 1)}


def test_followers_cross_groups(spark):
    ids = sorted({0, 1, 5, 1023, 1024, 1 << 21, (1 << 21) + 3, 1 << 40, -7, -(1 << 30)})
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    found = {r.id: r.next for r in fingerprints.followers(df).collect()}
    assert found == dict(zip(ids, [*ids[1:], None], strict=True))


def brute_spans(text):
    found = []
    assign = r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    for kind, pattern, group, least in (
        (0, assign, 2, 6), (1, r"AKIA[A-Z0-9]+", 0, 20), (2, r"[0-9a-f]+", 0, 24),
    ):
        for m in re.finditer(pattern, text, re.ASCII):
            if len(m.group(group)) >= least:
                found.append((m.start(), kind, m.end()))
    return ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in sorted(found))


SECRETS = [
    "x password=hunter22 y", "token: key", "secret: token = abcdefgh", "AKIA" + "A1" * 8, "AKIAAKIA" + "B" * 16,
    "api_key = '0123456789abcdef01234567' é", "PassWD:\"abc.def\"", "paſſword=abcdefgh", None, "", "é" * 9 + "deadbeef" * 4,
    "toKen=abcdef12", "plain words only here", "key ghq7Zk2LmQ9xR7tYvB3nW5cD1eF4gH6jK0 end",
]


def test_secrets(spark):
    draw, parts = random.Random(8), "the in ter na tio or di ry con tain er spe cial ma chine wor ld".split()
    prose_rows = [
        (100 + i, "internationalization_of_ordinarycontainers " + " ".join("".join(draw.choices(parts, k=3)) for _ in range(400)))
        for i in range(60)
    ]
    rows = list(enumerate(SECRETS)) + prose_rows
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = by_id(secrets.report(secrets.scan(df, secrets.train(df))))
    for i, text in rows:
        base = brute_spans(text or "")
        own = [s for s in found[i].spans.split(",") if s and not s.startswith("markov")]
        assert ",".join(own) == base and found[i].base_sha256 == sha(base)
    assert found[13].spans == "markov:4:38"
    assert all(found[i].n_markov == 0 for i, _ in prose_rows)


ORDINARY = """
AbstractSingletonProxyFactoryBean /usr/share/common-licenses/GPL org/apache/spark/sql/execution
node_modules/express/lib utf8_general_ci_unicode x86_64-unknown-linux-gnu SPDX-License-Identifier
__builtin_expect_with 2024-01-15T10-30-00Z getElementsByClassName java/util/concurrent/atomic
CONFIG_NETFILTER_XT_MATCH pthread_mutex_destroy Content-Security-Policy test_should_return_value
""".split()


def test_secrets_of_held_out_samples(spark, nothing):
    """Without documents the labelled sample decides; held-out strings have words it does not have."""
    model = secrets.train(nothing)
    found = {True: [], False: []}
    for text, alphabet in secret_samples.labelled(4000, 20, seed=5, held_out=True):
        found[alphabet is not None].append(bool(secrets.markov_spans(text, model, [])))
    hits, false = sum(found[True]), sum(found[False])
    assert hits >= 0.98 * len(found[True]) and false <= 0.01 * len(found[False])
    assert hits / (hits + false) >= 0.98


def test_ordinary_names_are_no_secrets(spark, nothing):
    model = secrets.train(nothing)
    assert [name for name in ORDINARY if secrets.spans(name, model)] == []
    rows = [(1, " ".join(ORDINARY), "x")] * 2 + [(None, "see ghq7Zk2LmQ9xR7tYvB3nW5cD1eF4gH6jK0", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    result = secrets.report(secrets.scan(df, secrets.train(df))).collect()
    assert sorted((r.doc_id or 0, r.n_markov) for r in result) == [(0, 1), (1, 0), (1, 0)]


def test_spans_next_to_base_spans(nothing):
    model = secrets.train(nothing)
    key = "ghq7Zk2LmQ9xR7tYvB3nW5cD1eF4gH6jK0"
    text = f"password={key} {key} token: x{key} {'0123456789abcdef' * 2} {key}"
    base = secrets.base_spans(text)
    wanted = [
        run.span() for run in re.finditer(r"[A-Za-z0-9+/_=-]{16,}", text)
        if all(end <= run.start() or start >= run.end() for start, end, *_ in base)
    ]
    assert [span[:2] for span in secrets.markov_spans(text, model, base)] == wanted and len(wanted) == 2


def test_many_spans_in_one_text(nothing):
    """A text of 10^5 base spans and as many other runs is merged, not compared pair by pair."""
    model = secrets.train(nothing)
    text = "token=abcdefgh1 internationalization_of_things " * 100_000
    started = time.monotonic()
    assert len(secrets.spans(text, model)) == 100_000
    assert time.monotonic() - started < 30


def test_licenses(spark):
    mit = next(text for name, text in KNOWN if name == "MIT")
    rows = [
        (1, "Copyright (c) 2001 Someone\n\n" + mit.lower().replace("sublicense", "sub-licence").replace(",", "")),
        (2, "Some words.\n  released under the MIT licence\nmore"),
        (3, None), (4, ""), (5, mit + " and more"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = by_id(licenses.scan(df, licenses.known_digests(spark)))
    assert [found[i].license for i in range(1, 6)] == ["MIT", None, None, None, None]
    assert [found[i].n_notices for i in range(1, 6)] == [0, 1, 0, 0, 0]


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, prose(i, 80).replace(" w1", ". W1") if i % 4 else "JUNK!! " * 40) for i in range(400)]
    docs = spark.createDataFrame([*rows, (400, None), (401, ""), (None, "text")], "doc_id long, text string")
    labels = spark.createDataFrame(
        [(i, int(i % 4 > 0), 0) for i in range(400)] + [(5, None, 0), (None, 1, 0)],
        "doc_id long, quality int, toxic int",
    )
    return docs, labels


def test_quality(labelled):
    docs, labels = labelled
    found = quality.classify(docs, labels).collect()
    assert len(found) == 403
    known = [row for row in found if row.doc_id is not None and row.doc_id < 400]
    assert sum(row.predicted == int(row.doc_id % 4 > 0) for row in known) >= 396
    import zlib

    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1) for row in known)
    assert all(0 <= row.score <= 1 for row in found)
    assert {r.doc_id for r in quality.keep_good(docs, labels).collect()} == {
        r.doc_id for r in found if r.predicted
    }


def test_quality_never_reads_held_out_labels(labelled):
    docs, labels = labelled
    wrong = labels.withColumn(
        "quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    first, second = (by_id(quality.classify(docs, own)) for own in (labels, wrong))
    assert all(first[i].score == pytest.approx(second[i].score) for i in first)


def test_quality_without_labels(labelled):
    docs, labels = labelled
    assert {row.score for row in quality.classify(docs, labels.limit(0)).collect()} == {0.5}


def test_empty_tables(spark, nothing):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for result in (
        repeats.report(repeats.deduplicated(nothing)), bpe.digests(nothing, RANKS, PATTERN),
        simhash.near_duplicates(nothing), simhash.keep_first(nothing), lines.deduplicated(nothing),
        lines.report(nothing), mixing.mix(nothing), mixing.mixed(nothing), fingerprints.compare(nothing),
        secrets.report(secrets.scan(nothing, secrets.train(nothing))), quality.classify(nothing, labels),
        licenses.scan(nothing, licenses.known_digests(spark)),
    ):
        assert result.count() == 0


def test_oracles_are_registered():
    from daystar.llm.queries import QUERIES

    assert set(ORACLES) <= set(QUERIES)
    assert [int(name[2:].split("_")[0]) for name in sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == list(range(1, 14))
