import re

import __spark_entry__ as registry


def test_registry_is_complete():
    queries, oracles = registry.queries(), registry.oracle_sql()
    assert set(oracles) <= set(queries)
    # The operators for training data have tests of their own.
    own = {name for name in queries if re.match(r"op\d+_|pipeline$", name)}
    assert set(queries) - set(oracles) == own - set(oracles)


def test_entry_runs(spark):
    rows = registry.entry(spark).collect()
    assert len(rows) == 400
    assert {r["rank"] for r in rows} == set(range(1, 11))
