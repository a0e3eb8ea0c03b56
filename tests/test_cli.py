"""The command-line entry lists every registered query."""

from aloft.__main__ import main
from aloft.plans.tables import ORACLE_SQL, QUERIES


def test_list(capsys):
    main(["list"])
    out = capsys.readouterr().out.splitlines()
    assert len(out) == len(QUERIES)
    assert sum("sql oracle" in line for line in out) == len(ORACLE_SQL)


def test_package_exports():
    import aloft
    from aloft import operators
    assert aloft.FlightAnalytics.__name__ == "FlightAnalytics"
    for name in operators.__all__:
        assert callable(getattr(operators, name))
