"""Every registered query of the library against its SQL in DuckDB."""

import builtins
import dis
import inspect
import pkgutil
from importlib import import_module

import duckdb
import pytest

import tidewell
from tidewell.catalog import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


def _shown(v):
    return f"{v:.10g}" if isinstance(v, float) else str(v)


def _unknown(code, known):
    names = {i.argval for i in dis.get_instructions(code) if i.opname == "LOAD_GLOBAL"} - set(known) - set(dir(builtins))
    return names.union(*(_unknown(c, known) for c in code.co_consts if hasattr(c, "co_code")))


@pytest.mark.parametrize("module", sorted(m.name for m in pkgutil.walk_packages(tidewell.__path__, "tidewell.") if not m.ispkg))
def test_modules_know_their_names(module):
    """No function uses a global name that its module doesn't have."""
    known = vars(import_module(module))
    functions = [inspect.unwrap(f) for f in known.values() if getattr(f, "__module__", None) == module]
    functions += [f for c in functions if isinstance(c, type) for f in vars(c).values() if getattr(f, "__module__", None) == module]
    codes = [f.__code__ for f in functions if f.__class__.__name__ == "function" and f.__globals__ is known]
    assert not set().union(*(_unknown(c, known) for c in codes))


def test_all_have_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    cols = sorted(df.columns)
    got = sorted(tuple(_shown(r[c]) for c in cols) for r in df.collect())
    rel = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == sorted(tuple(_shown(r[i]) for i in at) for r in rel.fetchall())
