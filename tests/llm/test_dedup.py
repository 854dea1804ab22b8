import brute
import pytest

from trastienda.llm import exact_dedup
from trastienda.llm.exact_dedup import drop_copies


def found(frame):
    return sorted(((r.doc_id, r.keep_id, r.group_size) for r in frame.collect()), key=str)


def test_odd_rows(spark, odd, odd_rows, folder_of):
    result = exact_dedup.exact_dedup(spark, f"{folder_of(odd)}/documents.parquet").cache()
    assert found(result) == brute.copies([r[:2] for r in odd_rows])
    # one row of each text stays, also of equal rows
    assert result.where("kept").count() == len({r[1] or "" for r in odd_rows})


def test_clashing_digests_are_told_apart_by_their_bytes(spark, documents, odd_rows, folder_of):
    rows = [(d, t) for d, t, _, _ in documents] + [r[:2] for r in odd_rows]
    path = f"{folder_of(spark.createDataFrame(rows, 'doc_id long, text string'))}/documents.parquet"
    weak = exact_dedup.exact_dedup(spark, path, digest=lambda text: exact_dedup.F.substring(exact_dedup.sha256(text), 1, 1))
    assert found(weak) == brute.copies(rows)


def test_state_goes_on_with_later_files_and_counts_none_twice(spark, tmp_path):
    path, state = str(tmp_path / "in"), str(tmp_path / "state")
    spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string").coalesce(1).write.parquet(path)
    assert {(r.n, r.doc_id) for r in exact_dedup.remember(spark, path, state).collect()} == {(1, 1), (1, 2)}
    spark.createDataFrame([(3, "a"), (4, "a"), (5, "c")], "doc_id long, text string").repartition(3).write.mode("append").parquet(path)
    for _ in range(2):
        assert {(r.n, r.doc_id) for r in exact_dedup.remember(spark, path, state, files_per_batch=1).collect()} == {(3, 4), (1, 2), (1, 5)}


def test_large_group(spark, folder_of):
    rows = spark.range(6000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'the same', concat('text ', id)) AS text")
    result = exact_dedup.exact_dedup(spark, f"{folder_of(rows)}/documents.parquet")
    assert result.where("kept").count() == 4001
    assert result.where("group_size = 2000 AND keep_id = 5997").count() == 2000


@pytest.mark.parametrize("frame", ["odd", "nothing"])
def test_stage_keeps_columns(spark, request, frame):
    docs = request.getfixturevalue(frame)
    kept = drop_copies(spark, docs)
    assert kept.columns == docs.columns
    assert kept.count() == docs.selectExpr("coalesce(text, '')").distinct().count()


def test_empty(spark, nothing, folder_of):
    assert exact_dedup.exact_dedup(spark, f"{folder_of(nothing, parts=1)}/documents.parquet").count() == 0
