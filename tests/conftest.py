import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from quorate.session import session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = session("local[4]", 4, **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints"))})
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    c.sql("SET timezone = 'UTC'")
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def _plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(_plain, v))
    return v


@pytest.fixture(scope="session")
def same_rows(duck):
    """Whether a DataFrame and a DuckDB query have equal columns and rows, in any order."""

    def check(df, sql):
        found = duck.execute(sql)
        names = [d[0] for d in found.description]
        assert sorted(names) == sorted(df.columns)
        want = sorted((tuple(_plain(r[names.index(c)]) for c in sorted(names)) for r in found.fetchall()), key=repr)
        got = sorted((tuple(_plain(r[c]) for c in sorted(names)) for r in df.collect()), key=repr)
        assert got == want

    return check
