import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from stackyard.session import build_session, set_default_checkpoint_dir
    s = build_session("local[4]", conf={"spark.sql.shuffle.partitions": "8",
                                        "spark.default.parallelism": "8"})
    # tests own their checkpoint folder; a cluster would name a shared one
    set_default_checkpoint_dir(s, tempfile.mkdtemp(prefix="stackyard-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from stackyard.sources.tables import TABLES
    cons = {}

    def get(sf_dir):
        if sf_dir not in cons:
            con = duckdb.connect()
            for t in TABLES:
                con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
            cons[sf_dir] = con
        return cons[sf_dir]
    return get
