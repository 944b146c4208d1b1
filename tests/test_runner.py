"""The command-line runner and the driver entry's schema."""

import __spark_entry__ as E
from relq import __main__ as runner


def test_runner_lists_and_runs(spark, capsys):
    assert runner.main(["--list"]) == 0
    assert "report_status" in capsys.readouterr().out.split()
    assert runner.main(["report_label_totals", "/root/testdata/sf0.001", "--rows", "3"]) == 0
    out = capsys.readouterr().out
    assert out.splitlines()[0].endswith("rows") and "priority_name" in out


def test_runner_sql_is_read_only(spark, capsys):
    assert runner.main(["--sql", "SELECT COUNT(*) AS n FROM orders", "/root/testdata/sf0.001"]) == 0
    assert runner.main(["--sql", "DROP TABLE orders", "/root/testdata/sf0.001"]) == 1
    assert runner.main(["no_such_query"]) == 2


def test_entry_schema_is_stable(spark):
    schema = [(f.name, f.dataType.simpleString()) for f in E.entry(spark).schema]
    assert schema == [("basis_year", "string"), ("n_name", "string"), ("zone", "string"),
                      ("status_name", "string"), ("n_orders", "bigint"), ("total_price", "double")]
