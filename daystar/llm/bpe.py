"""Byte-level BPE encoding and decoding by a local rank file.

Token ids travel as packed little-endian unsigned 32-bit integers in a binary column:
four bytes per token, no boxing on either side, and a digest of them needs no Python.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from daystar.llm.tables import text_or_empty

# A text longer than this is encoded part by part.
PART_CHARS = 1 << 16
# Runs of blanks beyond this length are taken out of the pattern's hands: its
# look-ahead keeps one state per blank and overflows on millions of them.
LONG_BLANK = 4096
#: Rows whose digests go back to Spark at once.
SLICE_ROWS = 1024

# No match of the usual patterns reaches over a blank between two letters: the letters
# before it end a match, and the blank starts the next one.
_SAFE = regex.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")
_BLANKS = regex.compile(r"\p{White_Space}{%d,}" % LONG_BLANK)


@lru_cache(maxsize=8)
def load(rank_file, pattern):
    """The tiktoken encoding of a rank file; read once in each Python worker."""
    import tiktoken

    with open(rank_file, "rb") as lines:
        ranks = {
            base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token
        }
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def parts(text, size=PART_CHARS):
    """Cut a text into (part, is_one_match) where no match of the pattern is cut.

    A cut lies before a single blank between two letters, or around a long run of
    blanks: such a run is one match, without its last blank when more text follows.
    """
    at = 0
    for run in _BLANKS.finditer(text):
        start, end = run.span()
        if end < len(text):
            end -= 1
        yield from ((part, False) for part in _plain_parts(text, at, start, size))
        yield text[start:end], True
        at = end
    yield from ((part, False) for part in _plain_parts(text, at, len(text), size))


def _plain_parts(text, at, end, size):
    while end - at > size:
        found = _SAFE.search(text, at + size, end)
        if not found:
            break
        yield text[at : found.start()]
        at = found.start()
    if at < end:
        yield text[at:end]


def encode_text(encoding, text, size=PART_CHARS):
    """Packed ids of one text."""
    if len(text) <= min(size, LONG_BLANK):
        return np.array(encoding.encode_ordinary(text), dtype="<u4").tobytes()
    packed = []
    for part, one_match in parts(text, size):
        ids = (
            encoding._encode_single_piece(part) if one_match else encoding.encode_ordinary(part)
        )
        packed.append(np.array(ids, dtype="<u4").tobytes())
    return b"".join(packed)


def encode(docs, rank_file, pattern, text="text", into="ids", keep=("doc_id",)):
    """Columns `keep` and the packed ids of every whole text, special tokens never formed.

    A null text counts as empty and an empty text has no ids (an empty binary). Rows keep
    their number: repeated rows are encoded each. The work is one pass without a shuffle,
    and a task holds one Arrow batch.
    """
    source = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias(into))
    schema = StructType([source.schema[name] for name in keep] + [StructField(into, BinaryType())])

    def run(batches):
        encoding = load(rank_file, pattern)
        for batch in batches:
            column = pa.array(
                (encode_text(encoding, value.as_py()) for value in batch.column(len(keep))),
                pa.binary(),
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], column], names=[*keep, into]
            )

    return source.mapInArrow(run, schema)


def decode(tokens, rank_file, pattern, ids="ids", into="decoded"):
    """Adds the raw bytes of the packed ids; they need not be whole UTF-8. Null stays null."""

    @F.pandas_udf(BinaryType())
    def decoded(column):
        encoding = load(rank_file, pattern)
        return column.map(
            lambda packed: None
            if packed is None
            else encoding.decode_bytes(np.frombuffer(packed, dtype="<u4").tolist())
        )

    return tokens.withColumn(into, decoded(F.col(ids)))


def text_digests(encoding, text, size=PART_CHARS):
    """n_tokens, ids_sha256 and decoded_sha256 of one text, part by part: no list of all its ids."""
    tokens, ids_hash, decoded_hash = 0, hashlib.sha256(), hashlib.sha256()
    pieces = [(text, False)] if len(text) <= min(size, LONG_BLANK) else parts(text, size)
    for part, one_match in pieces:
        ids = encoding._encode_single_piece(part) if one_match else encoding.encode_ordinary(part)
        tokens += len(ids)
        ids_hash.update(np.array(ids, dtype="<u4").tobytes())
        decoded_hash.update(encoding.decode_bytes(ids))
    return tokens, ids_hash.hexdigest(), decoded_hash.hexdigest()


def digests(docs, rank_file, pattern):
    """doc_id, n_tokens, ids_sha256, decoded_sha256 per row of `docs`.

    A null text counts as empty. Repeated rows and null doc_ids keep a row each, and other
    columns are not read. Encoding, decoding and both digests are one Python evaluation, text by
    text: a task has one worker with one table of ranks, and nothing but counts and digests
    goes back. Texts are handed out in slices of a batch, so results never pile up.
    """
    source = docs.select("doc_id", text_or_empty().alias("text"))
    schema = StructType(
        [
            source.schema["doc_id"],
            StructField("n_tokens", LongType()),
            StructField("ids_sha256", StringType()),
            StructField("decoded_sha256", StringType()),
        ]
    )

    def run(batches):
        encoding = load(rank_file, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                ids, texts = batch.slice(at, SLICE_ROWS).columns
                found = [text_digests(encoding, text.as_py()) for text in texts]
                tokens, packed, decoded = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(tokens, pa.int64()), pa.array(packed), pa.array(decoded)],
                    names=schema.names,
                )

    return source.mapInArrow(run, schema)
