import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"

#: (doc_id, text, lang, source, n_chars) and names that operators use themselves.
EXTRA = "doc_id long, text string, lang string, source string, n_chars long, size long, shard int, kept boolean, row string, fp long"


def prose(seed: int, n: int) -> str:
    import random

    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijklmnoprstuvw") for _ in range(r.randint(2, 9))) for _ in range(n))


def edge_rows() -> list[tuple]:
    a, long = prose(1, 80), prose(2, 30000)
    texts = [None, "", " \t\n\x0b\f\r ", a, a, a.upper(), a + " tail", long, long, "one", "one two", "é ß 漢字   x", "!!! ###", "123 456",
             "word " * 200, "line here\n" * 60, a + "\n" + prose(3, 40)]
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 == 0 else "s" + str(i % 3), 1, 2, 3, True, "r", 4) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, a, "de", "s1", None, None, None, None, None, None), (None, None, None, None) + (None,) * 6]
    return rows


@pytest.fixture(scope="session")
def spark():
    from wellmart.session import local_session

    s = local_session(4, shuffle_partitions=4, app="llm-tests", extra={"spark.sql.files.maxPartitionBytes": "64k"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").repartition(3)


@pytest.fixture(scope="session")
def rows(docs):
    return {r["doc_id"]: r for r in docs.collect()}


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), EXTRA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], EXTRA)
