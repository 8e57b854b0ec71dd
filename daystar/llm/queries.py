"""Registered queries of the subpackage: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers

from pyspark.sql import functions as F

from daystar.llm import (
    bpe,
    caps,
    conversations,
    fingerprints,
    licenses,
    lines,
    mixing,
    neighbours,
    quality,
    repeats,
    runs,
    secrets,
    simhash,
)
from daystar.llm.tables import table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def op1_mix(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


def op2_repeats(spark, sf_dir):
    return repeats.report(repeats.deduplicated(table(spark, sf_dir, "documents")))


def op3_licenses(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.known_digests(spark))


def op4_caps(spark, sf_dir):
    return caps.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_fingerprints(spark, sf_dir):
    return fingerprints.compare(table(spark, sf_dir, "documents"))


def op6_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_lines(spark, sf_dir):
    return lines.report(table(spark, sf_dir, "documents"))


def op8_bpe(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"), RANKS, PATTERN)


def op9_quality(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_secrets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return secrets.report(secrets.scan(docs, secrets.train(docs)))


def op11_neighbours(spark, sf_dir):
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op12_runs(spark, sf_dir):
    return runs.report(runs.detect(runs.looped(table(spark, sf_dir, "documents"))))


def op13_turns(spark, sf_dir):
    turns = conversations.damaged(table(spark, sf_dir, "conversations"))
    return conversations.report(conversations.repair(turns, present=~F.col("dropped")))


QUERIES = {
    "op1_mix": op1_mix,
    "op2_repeats": op2_repeats,
    "op3_licenses": op3_licenses,
    "op4_caps": op4_caps,
    "op5_fingerprints": op5_fingerprints,
    "op6_simhash": op6_simhash,
    "op7_lines": op7_lines,
    "op8_bpe": op8_bpe,
    "op9_quality": op9_quality,
    "op10_secrets": op10_secrets,
    "op11_neighbours": op11_neighbours,
    "op12_runs": op12_runs,
    "op13_turns": op13_turns,
}
