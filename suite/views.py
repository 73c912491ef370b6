"""View queries: input tables, result columns and SQL text."""

VIEWS = {
    "mv_join": (
        ["customer", "orders"],
        {"c_mktsegment": "STRING", "orders": "BIGINT", "total": "DECIMAL(28,2)"},
        """SELECT c.c_mktsegment, count(*) AS orders,
                  CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total
           FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
           GROUP BY c.c_mktsegment""",
    ),
    # Orders are grouped first: the right side of a semi join cannot be split when one key is hot.
    "mv_exists": (
        ["customer", "orders"],
        {"c_custkey": "BIGINT", "c_name": "STRING"},
        """SELECT c_custkey, c_name FROM customer
           WHERE EXISTS (SELECT 1 FROM (SELECT o_custkey, max(o_totalprice) AS top FROM orders GROUP BY o_custkey) t
                         WHERE t.o_custkey = c_custkey AND t.top > 300000)""",
    ),
    "mv_aggregate": (
        ["lineitem"],
        {"l_returnflag": "STRING", "l_linestatus": "STRING", "quantity": "DECIMAL(28,2)", "lines": "BIGINT"},
        """SELECT l_returnflag, l_linestatus,
                  CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS quantity, count(*) AS lines
           FROM lineitem GROUP BY l_returnflag, l_linestatus""",
    ),
    # Grouped before the window: a window partition holds one row per year, however hot its customer.
    "mv_window": (
        ["orders"],
        {"o_custkey": "BIGINT", "year": "INT", "total": "DECIMAL(28,2)", "customer_total": "DECIMAL(28,2)"},
        """SELECT o_custkey, year, CAST(total AS DECIMAL(28,2)) AS total,
                  CAST(sum(total) OVER (PARTITION BY o_custkey) AS DECIMAL(28,2)) AS customer_total
           FROM (SELECT o_custkey, CAST(year(o_orderdate) AS INT) AS year,
                        CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total
                 FROM orders GROUP BY o_custkey, year(o_orderdate)) y""",
    ),
    "mv_union": (
        ["customer", "supplier"],
        {"kind": "STRING", "id": "BIGINT", "nation": "INT"},
        """SELECT 'customer' AS kind, c_custkey AS id, c_nationkey AS nation FROM customer
           UNION ALL SELECT 'supplier', s_suppkey, s_nationkey FROM supplier""",
    ),
    "mv_cte": (
        ["nation", "region", "customer"],
        {"r_name": "STRING", "customers": "BIGINT"},
        """WITH places AS (SELECT n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey),
                counted AS (SELECT * FROM (WITH busy AS (SELECT * FROM customer WHERE c_acctbal > 0)
                                           SELECT c_nationkey, count(*) AS n FROM busy GROUP BY c_nationkey) x)
           SELECT r_name, CAST(sum(n) AS BIGINT) AS customers
           FROM places JOIN counted ON n_nationkey = c_nationkey GROUP BY r_name""",
    ),
    "mv_lambda": (
        ["embeddings"],
        {"vec_id": "BIGINT", "positive": "INT"},
        "SELECT vec_id, size(filter(transform(embedding, x -> x * 2), x -> x > 0)) AS positive FROM embeddings",
    ),
}
