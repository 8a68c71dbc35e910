"""Record shapes of the page log, the change topic and the configuration table.

App log records are open objects and have no schema here (see ``operators.logs``).
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()

COMMON = T.StructType([
    T.StructField("mid", S), T.StructField("is_new", S), T.StructField("uid", S),
    T.StructField("ch", S),
])
PAGE = T.StructType([
    T.StructField("page_id", S), T.StructField("last_page_id", S),
    T.StructField("during_time", L),
])
# a page log record after the split: no err, displays, actions
PAGE_LOG = T.StructType([
    T.StructField("common", COMMON), T.StructField("page", PAGE), T.StructField("ts", L),
])

STR_MAP = T.MapType(S, S)

# a change record of the shop database
CHANGE_LOG = T.StructType([
    T.StructField("database", S), T.StructField("table", S), T.StructField("type", S),
    T.StructField("ts", S), T.StructField("data", STR_MAP), T.StructField("old", STR_MAP),
])

# one row of the table that says which source tables are dimensions
TABLE_CONFIG = T.StructType([
    T.StructField("source_table", S), T.StructField("sink_table", S),
    T.StructField("sink_columns", S), T.StructField("sink_pk", S),
    T.StructField("sink_extend", S),
])

# a change record of the configuration table (Debezium JSON)
CONFIG_CHANGE = T.StructType([
    T.StructField("before", TABLE_CONFIG), T.StructField("after", TABLE_CONFIG),
    T.StructField("op", S), T.StructField("ts_ms", L),
])

BASE_DIC = T.StructType([
    T.StructField("dic_code", S), T.StructField("dic_name", S),
    T.StructField("parent_code", S), T.StructField("create_time", T.TimestampNTZType()),
    T.StructField("operate_time", T.TimestampNTZType()),
])

EMP = T.StructType([
    T.StructField("empno", T.IntegerType()), T.StructField("ename", S),
    T.StructField("deptno", T.IntegerType()), T.StructField("ts", L),
])
DEPT = T.StructType([
    T.StructField("deptno", T.IntegerType()), T.StructField("dname", S),
    T.StructField("ts", L),
])
