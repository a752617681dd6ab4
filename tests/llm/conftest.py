import numpy as np
import pytest

ODD_TEXTS = [None, "", " ", "a", "\n\n", "ünï ☃ 𝕏", "word " * 30_000, "same text here to repeat", "same text here to repeat", "x" * 70_000, "don't  stop\t　now 12345 ..."]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null, empty, very long, tied and repeated texts; a null and a repeated doc_id; columns with clashing names."""
    rows = [(i, t, "en", "s", 0, 1.0, 5, "q") for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "no id", None, None, None, None, None, None), (7, "same text here to repeat", "en", "s", 0, 1.0, 5, "q"), (7, "another text of the same id", "en", "s", 0, 1.0, 5, "q")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, rep int, bucket string")


@pytest.fixture(scope="session")
def no_docs(spark, odd_docs):
    return spark.createDataFrame([], odd_docs.schema)


@pytest.fixture(scope="session")
def odd_labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 0, 0), (3, None, 0), (None, 1, 1), (6, 0, 0), (9, 7, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.99, 0.05], 1), (3, [0.0, 1.0], 1), (4, [1.0, 0.0], 2), (5, None, 1), (6, [], 1), (7, [0.0, 0.0], 1), (8, [nan, 1.0], 1),
        (9, [inf, 1.0], 1), (10, [None, 1.0], 1), (11, [1.0, 0.0], None), (12, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1), (50, [2.0, 0.0], 1), (50, [2.0, 0.0], 1), (100, [-1.0, 0.5], 2),
    ]
    return spark.createDataFrame([(*r, "x", 3) for r in rows], "vec_id long, embedding array<float>, label int, rep string, n long")


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


def unit(x):
    return x / np.linalg.norm(x)
