"""Registered queries of the folder against their SQL: ``python -m tests.llm.check_sql [name ...]``."""

import sys

from agentlake.core import build_session
from agentlake.llm.entries import ORACLE, QUERIES
from agentlake.plans.check import compare, connect

if __name__ == "__main__":
    sf = "/root/testdata/sf0.01"
    spark, con = build_session(master="local[4]", partitions=8), connect(sf)
    for name in sys.argv[1:] or QUERIES:
        print(name, compare(spark, con, sf, name, QUERIES[name], ORACLE.get(name)), flush=True)
