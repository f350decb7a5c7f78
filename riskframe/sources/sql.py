"""SQL text of the ``policies`` adapter (DuckDB dialect) for the oracles.

Mirrors ``riskframe.sources.tables.policies`` column for column.
"""

POLICIES_SQL = """
SELECT 'ID' || CAST(o.o_orderkey AS VARCHAR) AS policy_id,
       'C' || CAST(c.c_nationkey AS VARCHAR) AS area_cluster,
       c.c_mktsegment AS segment,
       o.o_totalprice / 100000 AS policy_tenure,
       c.c_acctbal AS age_of_policyholder,
       CAST(year(o.o_orderdate) AS INTEGER) AS age_of_car,
       CAST(coalesce(l.n, 0) AS BIGINT) AS n_lines,
       l.qty, l.price, l.disc,
       CASE WHEN l.qty IS NULL THEN NULL
            ELSE CAST(CAST(l.qty AS BIGINT) AS VARCHAR) || 'Nm@'
                 || CAST(1000 + coalesce(l.n, 0) * 100 AS VARCHAR) || 'rpm' END AS max_torque,
       CAST(coalesce(l.n, 0) AS VARCHAR) || '.5bhp@6000rpm' AS max_power,
       CASE WHEN coalesce(l.n, 0) >= 4 THEN 'Yes' WHEN coalesce(l.n, 0) >= 1 THEN 'No' END AS is_esc,
       CAST(o.o_orderstatus = 'F' AND o.o_orderpriority = '1-URGENT' AS INTEGER) AS is_claim
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN (SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS qty,
                  sum(l_extendedprice) AS price, avg(l_discount) AS disc
           FROM lineitem GROUP BY l_orderkey) l ON o.o_orderkey = l.l_orderkey
"""

TRAIN_PRED = "CAST(substr(policy_id, 3) AS BIGINT) % 5 <> 0"


def with_policies(body: str) -> str:
    """Prefix a query with the ``policies``, ``train_t`` (labelled) and
    ``test_t`` (unlabelled) CTEs."""
    return (f"WITH policies AS ({POLICIES_SQL}),\n"
            f"train_t AS (SELECT * FROM policies WHERE {TRAIN_PRED}),\n"
            f"test_t AS (SELECT * EXCLUDE (is_claim) FROM policies WHERE NOT ({TRAIN_PRED}))\n"
            f"{body}")
