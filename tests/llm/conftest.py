import duckdb
import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, row int, place string, size string, m string"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def documents():
    return duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


#: Nulls in any column, empty and very long texts, ties, repeated rows; the extra columns clash with names used inside.
ODD = [
    (1, "alpha beta gamma delta", "en", "b"),
    (1, "alpha beta gamma delta", "en", "b"),
    (2, "alpha beta gamma delta", None, None),
    (3, None, "en", "b"),
    (4, "", None, "a"),
    (None, "alpha beta gamma delta", "de", "a"),
    (None, None, None, None),
    (5, " \n\t ", "de", "c"),
    (6, "übermäßig lang " * 30_000, "de", None),
    (7, "x" * 200_000, "en", "a"),
    (8, "1 2 3 4 5", "en", "a"),
]


@pytest.fixture(scope="session")
def odd_rows():
    return [(*row, None if row[1] is None else len(row[1]), "k", 7, "p", "s", None) for row in ODD]


@pytest.fixture()
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture()
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture()
def folder_of(tmp_path):
    def write(frame, name="documents", parts=3):
        frame.repartition(parts).write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return write
