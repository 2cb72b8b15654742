from lagframe.plans import views as V
from lagframe.session import app_key, ensure_checkpoint_dir

from .conftest import SF


def test_stored_tables_are_materialized_once_under_checkpoint_root(spark):
    root = ensure_checkpoint_dir(spark).replace("file:", "")
    t = V.cases_t(spark, SF)
    files = t.inputFiles()
    assert files and all(root.rstrip("/") in f for f in files)
    # the whole collection group is materialized together, and only once
    for name in ("cases", "weekly", "sat_weekly"):
        assert (app_key(spark), SF, name) in V._STORED
    assert V.cases_t(spark, SF) is t
    # same rows as the computed view
    a = sorted(map(tuple, t.select("region", "year", "week", "cases").collect()))
    b = sorted(map(tuple, V.cases(spark, SF).select("region", "year", "week", "cases").collect()))
    assert a == b
