"""Ties that SQL leaves open go by the order of the files."""

import pyarrow as pa
import pyarrow.parquet as pq

from genoflux.plans.queries import ORACLE_SQL, QUERIES

from .oracle import same


def test_first_of_equal_lines_is_the_first_in_the_files(spark, tmp_path):
    """Spark opens the largest file first; the first row of equal ones lies in the small one."""
    folder = tmp_path / "lineitem.parquet"
    folder.mkdir()
    for k, n in enumerate((3, 50, 4000)):
        rows = [(i % 40, 1 + i % 2, 10000 * k + i) for i in range(n)]
        pq.write_table(pa.table(dict(zip(("l_orderkey", "l_partkey", "l_linenumber"), (pa.array([r[j] for r in rows]) for j in (0, 2, 1)), strict=True))), folder / f"part-{k}.parquet")
    same(spark, QUERIES["s01_keep_first_dedupe"], ORACLE_SQL["s01_keep_first_dedupe"], str(tmp_path))
