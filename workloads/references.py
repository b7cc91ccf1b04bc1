"""Deletions that go through chains of references, and back into the same table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesync.operators.references import SET_NULL, Reference, delete_through
from workloads.registry import query

CHAIN = [
    Reference("orders", "o_custkey", "customer", "c_custkey"),
    Reference("lineitem", "l_orderkey", "orders", "o_orderkey"),
    Reference("lineitem", "l_partkey", "part", "p_partkey", SET_NULL),
]
TREE = [Reference("node", "parent_id", "node", "id")]
LINKS = [*TREE, Reference("line", "l_partkey", "node", "id")]


@query("cascade_chain", """
SELECT l_orderkey, l_linenumber, CASE WHEN p_partkey IS NOT NULL THEN l_partkey END AS l_partkey, l_quantity
FROM {lineitem} LEFT JOIN (SELECT p_partkey FROM {part} WHERE p_partkey % 11 <> 0) ON p_partkey = l_partkey
WHERE l_orderkey IN (
  SELECT o_orderkey FROM {orders_null_fk}
  WHERE o_custkey IS NULL OR o_custkey IN (SELECT c_custkey FROM {kept_customers}))""")
def cascade_chain(i):
    """Customers gone, their orders, and the items of these; items of gone parts stay without them."""
    tables = {
        "customer": i["kept_customers"], "orders": i["orders_null_fk"], "part": i["part"],
        "lineitem": i["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"),
    }
    gone = i["part"].filter("p_partkey % 11 = 0").select("p_partkey")
    return delete_through(tables, CHAIN, {("part", "p_partkey"): gone})["lineitem"]


@query("cascade_self", """
SELECT * FROM (
  WITH RECURSIVE gone AS (
    SELECT id FROM {part_tree} WHERE id % 97 = 0
    UNION
    SELECT t.id FROM {part_tree} t JOIN gone g ON t.parent_id = g.id
  )
  SELECT 'node' AS kind, id AS number, parent_id AS refers_to FROM {part_tree}
  WHERE id NOT IN (SELECT id FROM gone)
  UNION ALL
  SELECT 'line', l_orderkey, l_partkey FROM {lineitem}
  WHERE l_partkey NOT IN (SELECT id FROM gone) AND l_partkey IN (SELECT id FROM {part_tree})
)""")
def cascade_self(i):
    """A tree whose nodes take everything below them with them, and what refers to its nodes."""
    tables = {"node": i["part_tree"], "line": i["lineitem"].select("l_orderkey", "l_partkey")}
    gone = i["part_tree"].filter("id % 97 = 0").select("id")
    left = delete_through(tables, LINKS, {("node", "id"): gone})
    nodes = left["node"].select(F.lit("node").alias("kind"), F.col("id").alias("number"),
                                F.col("parent_id").alias("refers_to"))
    lines = left["line"].select(F.lit("line").alias("kind"), F.col("l_orderkey").alias("number"),
                                F.col("l_partkey").alias("refers_to"))
    return nodes.unionByName(lines)
