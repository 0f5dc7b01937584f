from datetime import datetime

import pytest

from corpusloom.operators.references import Reference, orphan_counts, orphan_references

DAY = lambda d: datetime(2024, 1, d)
PARENTS = "documentid long, loaded_at timestamp_ntz, deleted_at timestamp_ntz, id string, at string, key string"
REFS = "id string, doc_id string, ingested_at timestamp_ntz, key string, part int, count int"


def run(spark, refs, parents, rows_per_part=None):
    rows = spark.createDataFrame([(*r, "k", 1, 2) for r in refs], REFS)
    owners = spark.createDataFrame([(*p, "i", "a", "k") for p in parents], PARENTS)
    return orphan_references([Reference("chunks", rows, "doc_id", "ingested_at", "id")], owners, "documentid", "loaded_at", "deleted_at", rows_per_part)


def test_cases(spark):
    parents = [(1, DAY(1), None), (2, DAY(5), None), (3, DAY(1), DAY(4)), (3, DAY(8), None), (None, DAY(1), None), (4, None, None), (3, DAY(1), DAY(4)), (5, DAY(1), DAY(1))]
    refs = [
        ("a", "1", DAY(2)), ("b", " 1.0\n", DAY(2)), ("c", "1E0", DAY(1)), ("d", "2", DAY(4)), ("e", "2", DAY(5)), ("f", "3", DAY(3)), ("g", "3", DAY(4)),
        ("h", "3", DAY(9)), ("i", "4", DAY(9)), ("j", "nan", DAY(9)), ("k", "1.5", DAY(9)), ("l", None, DAY(9)), ("m", " ", DAY(9)), ("n", "77", DAY(9)), ("o", "1", None), ("n", "77", DAY(9)), (None, "78", DAY(9)), ("p", "5", DAY(1)),
    ]
    got = [(r.id, r.reason) for r in run(spark, refs, parents).collect()]
    want = [("d", "not_in_force"), ("g", "not_in_force"), ("i", "absent"), ("j", "not_a_key"), ("k", "not_a_key"), ("n", "absent"), ("n", "absent"), (None, "absent"), ("o", "not_in_force"), ("p", "not_in_force")]
    assert sorted(got, key=str) == sorted(want, key=str)
    counts = orphan_counts(run(spark, refs, parents)).filter("reason = 'absent'").first()
    assert (counts.ref_month, counts.n_rows, counts.n_keys) == ("2024-01", 4, 3)


@pytest.mark.parametrize("rows_per_part", [1000, 60])
def test_hot_keys(spark, rows_per_part):
    parents = [(1, DAY(3), DAY(6)), (2, DAY(1), None)]
    refs = [(f"r{i}", "1", DAY(1 + i % 9)) for i in range(400)] + [(f"s{i}", "9", DAY(2)) for i in range(300)] + [(f"t{i}", str(100 + i), DAY(2)) for i in range(300)]
    got = sorted(r.id for r in run(spark, refs, parents, rows_per_part).collect())
    assert got == sorted([f"r{i}" for i in range(400) if not 3 <= 1 + i % 9 < 6] + [f"s{i}" for i in range(300)] + [f"t{i}" for i in range(300)])


def test_empty(spark):
    assert run(spark, [], [(1, DAY(1), None)]).count() == 0
    assert [r.reason for r in run(spark, [("a", "1", DAY(1))], []).collect()] == ["absent"]
