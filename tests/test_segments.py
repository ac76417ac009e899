import pytest
from pyspark.sql import functions as F

from clientele.operators import segments

# Published cluster means with the scores and names they lead to.
PUBLISHED = [
    (1, 1106, 44.6, 5.0, 1432.0, 0.571, "High-Potential", 2),
    (2, 427, 99.8, 2.0, 1502.0, 0.443, "Standard", 6),
    (3, 1992, 142.7, 1.7, 325.0, 0.308, "Standard", 6),
    (4, 205, 12.6, 2.6, 879.0, 0.511, "New Customers", 4),
    (5, 345, 18.6, 12.0, 4450.0, 0.980, "Champions", 1),
]


@pytest.fixture(scope="module")
def customers(spark):
    rows = [
        (f"{cluster}-{i}", cluster, r, f, m, 1.0, 1.0, 1.0)
        for cluster, n, r, f, m, *_ in PUBLISHED for i in range(n)
    ]
    rows += [("noise", -1, 999.0, 1.0, 1.0, 1.0, 1.0, 1.0)]
    return spark.createDataFrame(
        rows, "CustomerID string, cluster int, Recency double, Frequency double, "
        "Monetary double, Avg_Transaction_Value double, Tenure double, Unique_Products double",
    )


def test_published_scores_and_names(customers):
    named = segments.interpret_clusters(customers).orderBy("cluster").collect()
    for row, (cluster, n, _, _, _, score, name, priority) in zip(named, PUBLISHED):
        assert (row.cluster, row.customers, row.segment_name) == (cluster, n, name)
        assert row.priority == priority
        assert abs(row.value_score - score) < 0.003


def test_reports(customers):
    named = segments.interpret_clusters(customers)
    plan = segments.action_plan(segments.segment_report(named)).collect()
    assert [r.cluster for r in plan] == [5, 1, 4, 2, 3]
    assigned = segments.assign_segments(customers, named)
    assert assigned.where(F.col("segment").isNull()).count() == 1
    summary = segments.segment_summary(assigned).collect()
    assert [(r.segment, r.customers) for r in summary][:2] == [
        ("Standard", 2419), ("High-Potential", 1106),
    ]
    assert abs(summary[0].percentage - 241900 / 4076) < 1e-9
    sample = segments.segment_sample(assigned)
    assert sample.count() == 20
    assert sample.exceptAll(segments.segment_sample(assigned.repartition(5))).isEmpty()


def test_every_rule(spark):
    base = dict(Overall_Recency=100.0, Overall_Frequency=5.0, Overall_Monetary=1000.0)
    cases = [
        (0.71, 500.0, 1.0, 1.0, "Champions"), (0.7, 50.0, 1.0, 2000.0, "High-Potential"),
        (0.5, 50.0, 6.0, 500.0, "Loyal Customers"), (0.5, 50.0, 4.0, 500.0, "New Customers"),
        (0.1, 366.0, 4.0, 500.0, "At Risk"), (0.1, 365.0, 4.0, 500.0, "Standard"),
        (0.5, 100.0, 5.0, 1000.0, "Standard"),
    ]
    rows = [
        dict(case=i, value_score=s, Recency=r, Frequency=f, Monetary=m, **base)
        for i, (s, r, f, m, _) in enumerate(cases)
    ]
    named = segments.segment_rules(spark.createDataFrame(rows)).orderBy("case").collect()
    assert [r.segment_name for r in named] == [c[-1] for c in cases]


def test_stored_tables_can_be_dropped(spark):
    from pathlib import Path

    from clientele.storage import dropping_tables, materialize, shared_folder

    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    kept = materialize(spark.range(3), "kept")
    with dropping_tables(spark):
        assert materialize(spark.range(5), "dropped").count() == 5
        assert len(set(folder.iterdir()) - before) == 2
    assert len(set(folder.iterdir()) - before) == 1
    assert kept.count() == 3
