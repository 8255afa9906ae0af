"""Driver contract: entry runs; every query with an oracle exists."""
import __spark_entry__ as E
from feedloom.plans import catalog


def test_entry_runs(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"source_label", "n_items", "n_links", "n_images", "last_published"}
    assert df.count() > 0


def test_oracles_cover_registered_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60 and set(catalog.queries()) <= set(o)  # every query of the library itself has its SQL
