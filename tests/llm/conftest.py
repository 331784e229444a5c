import pytest

from tidemark.session import ship_package

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def lspark(spark):
    ship_package(spark)
    return spark


@pytest.fixture(scope="session")
def texts(lspark):
    """(doc_id, text) of the smallest documents table, ascending."""
    rows = lspark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    return sorted(tuple(r) for r in rows)


#: Null id, null text, empty and blank texts, repeated rows, one id with two texts, a very
#: long text, and columns whose names the operators use themselves.
AWKWARD = [
    (None, "alpha beta gamma delta epsilon zeta " * 6, "en", "src1", "x"),
    (1, None, None, None, None),
    (2, "", "en", "src2", "y"),
    (3, " \t\n ", "en", "src3", ""),
    (4, "alpha beta gamma delta epsilon zeta " * 6, "en", "src1", "z"),
    (4, "alpha beta gamma delta epsilon zeta " * 6, "en", "src1", "z"),
    (5, "Élan vital. Ça va? 123 <|endoftext|> 中文 🙂", "fr", "src0", None),
    (5, "another text of the same id", "fr", None, None),
    (-7, "w" * 70_000 + " " + "long words and a long text " * 9000, "en", "src5", "w"),
]
AWKWARD_DDL = "doc_id long, text string, lang string, source string, fp string"


@pytest.fixture(scope="session")
def awkward(lspark):
    rows = lspark.createDataFrame(AWKWARD, AWKWARD_DDL)
    # names that clash with those inside the operators
    return rows.selectExpr("*", "'a' AS grp", "1 AS u", "2 AS bucket", "'b' AS word", "'c' AS hashes", "0 AS id", "'d' AS label", "'e' AS key", "'f' AS part")


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)
