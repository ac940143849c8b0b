"""Queries against their SQL twins on the smallest tables.

By default the quick groups run; LARKSPUR_ORACLE=all runs every twin.
"""

import os

import oracle
import pytest
from conftest import FOLDER

from larkspur.plans.catalogue import CATALOGUE

QUICK = ("prj_", "flt_", "cln_", "join_", "agg_", "win_", "ord_", "set_", "fn_", "ts_", "str_source", "src_", "sink_wide",
         "app_tfidf", "app_textrank", "app_action", "app_ab", "app_personal_rank", "app_item_knn", "fe_s", "ml_eval")
NAMES = [n for n, q in CATALOGUE.items() if q.sql and (os.environ.get("LARKSPUR_ORACLE") == "all" or n.startswith(QUICK))]


@pytest.mark.parametrize("name", NAMES)
def test_equals_sql(name, spark, duck):
    got = oracle.spark_rows(CATALOGUE[name](spark, FOLDER))
    assert oracle.difference(got, oracle.duck_rows(duck, CATALOGUE[name].sql)) is None


def test_entry_is_registered():
    import __spark_entry__ as entry

    assert entry.FLAGSHIP in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())
