"""Every registered query against its own SQL on the smallest tables."""

from pathlib import Path

import pytest

from concordat.plans import audit, registry
from tools.compare_oracles import canonical

QUERIES, ORACLES = registry.QUERIES | audit.QUERIES, registry.ORACLES | audit.ORACLES
FOLDER = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    import duckdb

    db = duckdb.connect()
    for path in FOLDER.glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    ours, theirs = QUERIES[name](spark, str(FOLDER)).toPandas(), db.execute(ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert canonical(ours) == canonical(theirs)
