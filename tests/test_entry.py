import builtins
import importlib

import __spark_entry__


def test_registered_queries_and_oracles():
    queries, oracles = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) >= 30


def test_core_does_not_need_the_optional_subpackage(monkeypatch):
    real = importlib.import_module

    def without(name, *more):
        if name.startswith("specweave.llm"):
            raise ModuleNotFoundError(f"No module named {name!r}", name="specweave.llm")
        return real(name, *more)

    monkeypatch.setattr(__spark_entry__, "import_module", without)
    assert "p2_found" in __spark_entry__.queries() and "p1_found" not in __spark_entry__.queries()
    assert builtins is not None


def test_flagship_runs(spark):
    assert __spark_entry__.entry(spark).limit(1).count() == 1
