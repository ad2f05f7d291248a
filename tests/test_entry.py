import math

import pytest

import __spark_entry__ as E
from support import SF_SMALL

FAST_ORACLE = ["trusted_features", "clean_summary", "null_audit", "distinct_counts", "histogram_auto",
               "histogram_by_label", "auc_exact", "roc_curve", "correlation", "profile_long", "density_curve",
               "metrics_report", "split_hash", "minmax_scale", "confusion_matrix", "schema_table"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 98 and len(df.columns) == 28


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 60


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in recs), key=repr)


@pytest.mark.parametrize("name", FAST_ORACLE)
def test_oracle_small(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = duck(SF_SMALL).execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, got) == _rows(ocols, want)
