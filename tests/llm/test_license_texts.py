"""Whole licences beside the short ones, and licence words on the line of a holder statement."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

from daystar.llm import licenses
from daystar.llm.license_texts import KNOWN

DEBIAN = Path("/usr/share/common-licenses")
MIT = next(text for name, text in KNOWN if name == "MIT")


def scanned(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = licenses.scan(df, licenses.known_digests(spark)).collect()
    return [(r.license, r.notices) for r in sorted(found, key=lambda r: r.doc_id)]


@pytest.mark.skipif(not DEBIAN.is_dir(), reason="no licence files here")
def test_whole_licences_however_wrapped(spark):
    names = {"Apache-2.0": "Apache-2.0", "GPL-3": "GPL-3.0", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    texts = [(DEBIAN / file).read_text(encoding="utf8") for file in names]
    # Paragraphs on one line each; holder statements go on starting lines.
    one_line = [re.sub(r"(?<=[^\n])\n(?!\s*Copyright \()(?=[^\n])", " ", text) for text in texts]
    found = scanned(spark, texts + one_line)
    assert [license for license, _ in found] == [*names.values()] * 2


def test_words_after_a_holder_statement(spark):
    found = scanned(
        spark,
        [
            "Copyright 2020 Foo. Licensed under the MIT License.",
            "Copyright (c) 2020 J. R. Foo, Inc. All rights reserved. " + " ".join(MIT.split()),
            "code\n// (c) 2020 Foo - Licensed under the Apache License, Version 2.0.\ncode",
            "Copyright 2020 Foo. Not for use.",
            "copyright holders may not use this. Licensed under the MIT License.",
        ],
    )
    assert found == [("MIT", "MIT"), ("MIT", "MIT"), (None, "Apache-2.0"), (None, ""), (None, "")]
