import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_harness import compare, duck  # noqa: E402

import __spark_entry__ as E  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"type_acompte", "non", "oui"}
    assert df.count() >= 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_oracle_pairs_small_scale(spark):
    con = duck(SF)
    qs, oracle = E.queries(), E.oracle_sql()
    bad = []
    for name in sorted(oracle):
        r = compare(spark, con, name, qs[name], oracle[name], SF)
        if r["status"] != "OK":
            bad.append(r)
    assert not bad, bad
