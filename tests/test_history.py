from datetime import datetime

import pytest

from starmart import published
from starmart.operators import staging
from starmart.operators.history import History
from starmart.operators.scd2 import first_snapshot, snapshot
from tests.conftest import as_rows, raw_products

T1, T2, T3 = (datetime(2024, m, 1) for m in (1, 2, 3))
FIRST = [(i, f"p{i}", "c", "d", "1.00", "USD") for i in range(1, 41)] + [(41, "none", "c", None, "5.00", None)]
SECOND = [
    *FIRST[1:38],  # 1, 39 and 40 are missing
    (2, "p2", "c", "d", "1.00", "EUR"),
    (41, "none", "c", "other words", "5.00", "USD"),
    (50, "new", "c", "d", "6.00", "USD"),
]
SECOND.remove(FIRST[1])
THIRD = [(2, "p2", "c", "d", "1.00", "USD"), FIRST[0], (50, "new", "c", "d", "6.00", None)]


@pytest.fixture(scope="module")
def extracts(spark):
    return [staging.stg_products(raw_products(spark, rows)) for rows in (FIRST, SECOND, THIRD)]


@pytest.fixture
def log(spark, tmp_path, extracts):
    return History(spark, str(tmp_path / "log"), extracts[0].schema)


def expected(extracts):
    first = first_snapshot(extracts[0], T1)
    second = snapshot(first, extracts[1], T2)
    return [first, second, snapshot(second, extracts[2], T3)]


def same(found, wanted):
    columns = sorted(wanted.columns)
    return as_rows(found, *columns) == as_rows(wanted, *columns)


def written(spark, log, run):
    """Rows of the two folders of a run."""
    now = published.manifest(spark, log.path)
    names = [n for n in now.folders if n.endswith(f"={run:%Y%m%d%H%M%S}")]
    return {n.split("=")[0]: spark.read.parquet(f"{log.path}/data/{now.folders[n]}/{n}").count() for n in names}


def test_log_equals_the_whole_table(spark, log, extracts):
    wanted = expected(extracts)
    for extract, at, want in zip(extracts, (T1, T2, T3), wanted):
        log.add(extract, at)
        assert same(log.versions(), want)
    for at, want in zip((T1, T2, T3), wanted):
        assert same(log.versions(at), want)
    # a night writes what has changed, not the catalogue
    assert written(spark, log, T1) == {"opened": 41, "closed": 0}
    assert written(spark, log, T2) == {"opened": 3, "closed": 2}
    assert written(spark, log, T3) == {"opened": 2, "closed": 2}
    log.merge_runs(T2)
    log.add(extracts[2], T3)  # repeated on the merged log
    assert same(log.versions(), wanted[2]) and same(log.versions(T2), wanted[1])
    assert sorted(published.manifest(spark, log.path).folders) == sorted(
        f"{n}={t:%Y%m%d%H%M%S}" for n in ("opened", "closed") for t in (T2, T3)
    )


def test_a_run_that_dies_or_is_repeated(spark, log, extracts, monkeypatch):
    wanted = expected(extracts)
    log.add(extracts[0], T1)
    for step in ("written_partitions", "switch"):
        with monkeypatch.context() as patch:
            patch.setattr(published, step, lambda *_a, **_o: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError):
                log.add(extracts[1], T2)
        assert same(log.versions(), wanted[0])
    for _ in range(2):
        log.add(extracts[1], T2)
        assert same(log.versions(), wanted[1])


def test_an_empty_extract_closes_nothing(spark, log, extracts):
    log.add(extracts[0].filter("false"), T1)
    assert log.versions().count() == 0
    log.add(extracts[0], T2)
    log.add(extracts[0].filter("false"), T3)
    assert log.versions().filter("valid_to is null").count() == len(FIRST)
