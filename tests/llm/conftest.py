"""Documents with everything that can go wrong: NULLs, empty and very long texts, ties, repeated rows."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "der the of and Haus casa élan naïve 東京 x-ray 42 end. THE Of".split()


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + draw.choice(["", "", "s", "\n", "\t"]) for _ in range(words))


@pytest.fixture(scope="session")
def rows():
    found = [(i, prose(i, 3 + i % 90), "en", f"src{i % 4}", i) for i in range(120)]
    found += [(200 + i, prose(7, 60), "de", "src0", 1) for i in range(40)]  # a large group of copies
    found += [(300 + i, prose(8, 80).upper() if i % 2 else prose(8, 80), None, None, None) for i in range(6)]
    found += [(400, None, None, None, None), (401, "", "en", "", 0), (402, " \n\t ", "en", "src1", 3)]
    found += [(None, "no id", "en", "src1", 5), (None, None, None, None, None), (None, "NO ID", "en", "src1", 5)]
    found += [(500, "again and again", "en", "src2", 15)] * 5  # repeated rows
    found += [(501, "same id one", "en", "src2", 1), (501, "same id two", "fr", "src3", 2)]
    found += [(502, prose(9, 30_000), "en", "src3", 9)]  # very long
    found += [(503, "É" * 3000, "fr", "src1", 3000), (504, "é" * 3000, "fr", "src1", 3000)]
    found += [(505, "x\U0001f600y   z w\x0b\x0cq", "en", "zz", 9)]
    return found


@pytest.fixture(scope="session")
def documents(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


#: Names that the operators use for columns of their own.
CLASHING = (
    "id key norm name row size score carried kept keep_id group_size text_sha256 fingerprint component_id copies "
    "source_size target taken nth own prefix left root digest"
).split()


@pytest.fixture(scope="session")
def clashing(documents):
    from pyspark.sql import functions as F

    return documents.withColumns({name: F.lit(f"extra {name}") for name in CLASHING})
