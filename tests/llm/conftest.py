import random

import pytest


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lakeframe.session import local_session

    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    return local_session(cores=4, extra={"spark.sql.shuffle.partitions": "8", "spark.sql.warehouse.dir": warehouse})


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

WORDS = {"en": "the of and to in that it was for on with as his they be at one have this from".split(),
         "de": "der die und ein nicht ich das sie ist zu mit auf für über wäre schön groß".split()}


def prose(rng: random.Random, lang: str, n: int) -> str:
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


def hard_rows(seed: int = 0) -> list[tuple]:
    """Nulls in every column, empty and long texts, ties, exact and near copies, repeated rows."""
    rng = random.Random(seed)
    rows = []
    for i in range(60):
        lang = rng.choice(["en", "de"])
        text = prose(rng, lang, rng.choice([1, 2, 3, 5, 20, 80, 300]))
        rows.append((i, text, lang, "hot" if i % 3 else f"s{i % 4}", len(text)))
    long = prose(rng, "en", 8000)
    rows += [(100, long, "en", "hot", len(long)), (101, long.replace(" ", "\n"), "en", "s1", len(long)), (102, rows[5][1], "en", None, 3),
             (103, rows[5][1] + " ", None, "s2", 3), (104, None, "en", "s1", None), (105, "", None, None, 0), (106, " \t\n", "de", "hot", 3),
             (107, "123 456 !!!", "en", "s1", 11), (108, "Ünïcödé 😀 text 😀 with ẞ and İ", "de", "s2", 29), (None, "no id but text", "en", "s1", 14),
             (None, None, None, None, None), (109, "a" * 5000, None, "s3", 5000), (110, "ab " * 900, "en", "s3", 2700)]
    rows += [rows[7], rows[7], rows[-5]]  # repeated rows
    return rows


@pytest.fixture(scope="session")
def hard(spark):
    """The hard rows, with extra columns whose names clash with those of results and helpers."""
    rows = [(*r, "x", i % 2 == 0, 1.5) for i, r in enumerate(hard_rows())]
    return spark.createDataFrame(rows, SCHEMA + ", component_id string, kept boolean, row double").repartition(3, "n_chars")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
