import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from helpers import rows
from rollcall import sample
from rollcall.operators.refined import refine_rows, with_stored_date
from rollcall.plans import reports


def test_sentinels(star):
    fact, dep, jobs = star(
        [("2021-02-01T00:00:00Z", 1, 1), ("0", 1, 1), ("2021-02-01", 0, 1), ("2021-05-01", 2, 0)]
    )
    assert rows(reports.hires_enriched(fact, dep, jobs), "id", "hire_date", "department", "job") == [
        (1, dt.date(2021, 2, 1), "Sales", "Clerk"),
        (2, None, "Sales", "Clerk"),
        (3, dt.date(2021, 2, 1), None, "Clerk"),
        (4, dt.date(2021, 5, 1), "Law", None),
    ]
    assert rows(reports.hires_by_quarter(fact, dep, jobs, 2021)) == [
        ("Law", None, 0, 1, 0, 0),
        ("Sales", "Clerk", 1, 0, 0, 0),
    ]


def test_dimension_row_zero_takes_the_missing(star):
    fact, dep, jobs = star([("2021-02-01", 0, 1)], departments=[(0, "None")])
    assert rows(reports.hires_by_quarter(fact, dep, jobs, 2021)) == [("None", "Clerk", 1, 0, 0, 0)]


def test_nameless_department_is_left_out(star):
    fact, dep, jobs = star([("2021-02-01", 1, 1)], departments=[(1, None)])
    assert rows(reports.hires_by_quarter(fact, dep, jobs, 2021)) == []
    assert rows(reports.mean_hires(fact, dep, 2021)) == [(None,)]


def test_repeated_dimension_ids_fan_out(star):
    hires = [("2021-02-01", 1, 1)] * 3
    fact, dep, jobs = star(
        hires, departments=[(1, "A"), (1, "B"), (1, "A")], jobs=[(1, "X"), (1, "Y")]
    )
    assert reports.hires_enriched(fact, dep, jobs).count() == 18
    for limits in ({}, {"max_rows": 0}):
        assert rows(reports.hires_by_quarter(fact, dep, jobs, 2021, **limits)) == [
            ("A", "X", 6, 0, 0, 0), ("A", "Y", 6, 0, 0, 0),
            ("B", "X", 3, 0, 0, 0), ("B", "Y", 3, 0, 0, 0),
        ]
        hired = reports.department_hires(fact, dep, 2021, **limits)
        assert rows(hired) == [(1, "A", 6), (1, "B", 3)]


def test_same_name_merges_in_the_matrix_only(star):
    fact, dep, jobs = star(
        [("2021-02-01", 1, 1), ("2021-02-01", 2, 1)], departments=[(1, "A"), (2, "A")]
    )
    assert rows(reports.hires_by_quarter(fact, dep, jobs, 2021)) == [("A", "Clerk", 2, 0, 0, 0)]
    assert rows(reports.department_hires(fact, dep, 2021)) == [(1, "A", 1), (2, "A", 1)]


def test_order_of_the_matrix(star):
    fact, dep, jobs = star([("2021-02-01", d, j) for d in (2, 1) for j in (2, 0, 1)])
    result = [tuple(r)[:2] for r in reports.hires_by_quarter(fact, dep, jobs, 2021).collect()]
    assert result == [("Law", None), ("Law", "Clerk"), ("Law", "Lead"),
                      ("Sales", None), ("Sales", "Clerk"), ("Sales", "Lead")]


def test_equal_to_the_mean_is_not_above(star):
    fact, dep, _ = star([("2021-02-01", d, 1) for d in (1, 2) for _ in range(2)])
    assert rows(reports.mean_hires(fact, dep, 2021)) == [(2.0,)]
    assert rows(reports.departments_above_mean(fact, dep, 2021)) == []


def test_mean_leaves_out_departments_without_hires(star):
    hires = [("2021-02-01", 1, 1)] * 4 + [("2021-02-01", 2, 1)] * 2 + [("2020-02-01", 3, 1)]
    fact, dep, _ = star(hires, departments=[(1, "A"), (2, "B"), (3, "C"), (4, "D")])
    assert rows(reports.mean_hires(fact, dep, 2021)) == [(3.0,)]
    above = reports.departments_above_mean(fact, dep, 2021)
    assert above.columns == ["id", "department", "hired"]
    assert rows(above) == [(1, "A", 4)]


def test_above_mean_is_sorted_by_hires(star):
    sizes = {1: 5, 2: 9, 3: 1, 4: 5, 5: 1}
    fact, dep, _ = star(
        [("2021-02-01", d, 1) for d, n in sizes.items() for _ in range(n)],
        departments=[(d, f"D{d}") for d in sizes],
    )
    result = reports.departments_above_mean(fact, dep, 2021).collect()
    assert [(r.id, r.hired) for r in result] == [(2, 9), (1, 5), (4, 5)]


def test_year_without_hires(star):
    fact, dep, jobs = star([("2020-02-01", 1, 1)])
    assert rows(reports.departments_above_mean(fact, dep, 2021)) == []
    assert rows(reports.hires_by_quarter(fact, dep, jobs, 2021)) == []


REPORTS = [
    lambda f, d, j, mode: reports.hires_enriched(f, d, j, mode),
    lambda f, d, j, mode: reports.hires_by_quarter(f, d, j, 2021, mode),
    lambda f, d, j, mode: reports.departments_above_mean(f, d, 2021, mode),
]


@pytest.mark.parametrize("stored", [False, True])
@pytest.mark.parametrize("report", REPORTS)
def test_bad_date_of_any_year_fails_or_is_null(star, report, stored):
    fact, dep, jobs = star([("2021-02-01", 1, 1), ("1999-02-31", 1, 1)])
    if stored:
        fact = with_stored_date(fact)
    with pytest.raises(PySparkException):
        report(fact, dep, jobs, "raise").collect()
    report(fact, dep, jobs, "null").collect()


@pytest.mark.parametrize("mode", ["raise", "null"])
def test_stored_dates_change_no_result(spark, mode):
    fact, dep, jobs = sample.star(spark, "/root/testdata/sf0.001").values()
    stored = with_stored_date(refine_rows(fact))
    for year in (1995, 1997):
        expected = rows(reports.hires_by_quarter(fact, dep, jobs, year))
        assert expected
        assert rows(reports.hires_by_quarter(fact, dep, jobs, year, mode)) == expected
        assert rows(reports.hires_by_quarter(stored, dep, jobs, year, mode)) == expected
    assert rows(reports.hires_enriched(stored, dep, jobs, mode)) == rows(
        reports.hires_enriched(fact, dep, jobs)
    )


HIRES = st.lists(
    st.tuples(
        st.dates(dt.date(2020, 12, 1), dt.date(2022, 1, 31)).map(str) | st.just("0"),
        st.integers(0, 3),
        st.integers(0, 3),
    ),
    max_size=30,
)


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(hires=HIRES)
def test_reports_agree_with_the_enriched_rows(star, hires):
    fact, dep, jobs = star(hires)
    found = reports.hires_in_year(fact, dep, jobs, 2021).count()
    matrix = reports.hires_by_quarter(fact, dep, jobs, 2021).collect()
    assert sum(r.Q1 + r.Q2 + r.Q3 + r.Q4 for r in matrix) == found
    by_id = reports.hires_by_quarter(fact, dep, jobs, 2021, max_rows=0).collect()
    assert by_id == matrix
    per_department = reports.department_hires(fact, dep, 2021)
    assert rows(per_department) == rows(reports.department_hires(fact, dep, 2021, max_rows=0))
    assert (per_department.agg(F.sum("hired")).first()[0] or 0) == found


def test_large_lookups_with_hot_keys(spark, conf):
    """Counts, too, are split by key when one key holds many of them."""
    conf(spark__sql__autoBroadcastJoinThreshold=-1)
    fact, dep, jobs = sample.star(spark, "/root/testdata/sf0.001").values()
    large = dict(max_rows=0)
    assert rows(reports.hires_by_quarter(fact, dep, jobs, 1997, **large)) == rows(
        reports.hires_by_quarter(fact, dep, jobs, 1997)
    )
    assert rows(reports.departments_above_mean(fact, dep, 1997, max_rows=0)) == rows(
        reports.departments_above_mean(fact, dep, 1997)
    )
