"""The spark-submit entry point."""

import pytest
from pyspark.sql import functions as F

from caseweek import testbed
from caseweek.__main__ import main
from caseweek.session import work_path
from caseweek.sinks import write_staging
from caseweek.schemas import NAME_DIM_SCHEMA
from caseweek.sources import read_dimension, read_facts, write_extract

from conftest import SF


def test_cli_load_update_bootstrap(spark):
    root = work_path(spark, "t-cli")
    for b in ("old", "new"):
        write_extract(testbed.raw_extract(spark, SF, b), f"{root}/{b}")
    wh = f"{root}/wh"
    assert main(["load", "--file", f"{root}/old", "--warehouse", wh, "--as-of", "2017-07-01"]) == 0
    n_old = read_facts(spark, f"{wh}/cases").count()
    assert main(["update", "--file", f"{root}/new", "--warehouse", wh, "--as-of", "2017-07-01"]) == 0
    assert read_facts(spark, f"{wh}/cases").count() >= n_old
    part = testbed.table(spark, SF, "part")
    write_staging(part.select(F.col("p_name").alias("name"), F.col("p_partkey").alias("ID")),
                  f"{root}/products", ",")
    assert main(["bootstrap", "--warehouse", f"{root}/wh2", "--products", f"{root}/products"]) == 0
    assert read_dimension(spark, f"{root}/wh2/product", NAME_DIM_SCHEMA).count() == part.select("p_name").distinct().count()


def test_cli_needs_a_file_for_loads():
    with pytest.raises(SystemExit):
        main(["load", "--warehouse", "/nowhere"])


def test_cli_process_once_with_a_table_name(spark, capsys):
    root = work_path(spark, "t-cli-once")
    write_extract(testbed.raw_extract(spark, SF, "new").coalesce(1), f"{root}/in")
    args = ["process-once", "--inbox", f"{root}/in", "--checkpoint", f"{root}/cp", "--warehouse", f"{root}/wh",
            "--table", "tickets", "--as-of", "2017-07-01"]
    assert main(args) == 0
    n = read_facts(spark, f"{root}/wh/tickets").count()
    assert main(args) == 0
    assert read_facts(spark, f"{root}/wh/tickets").count() == n > 0
    assert main(["update", "--file", f"{root}/in", "--warehouse", f"{root}/wh", "--table", "tickets",
                 "--as-of", "2017-07-01"]) == 0
    out = capsys.readouterr().out
    assert "cases with" in out and "0 refused" in out
