-- One row per order. The expression below has the name of the view it reads, and is not a mart.
WITH src_lineitem AS (
  SELECT l_orderkey, count(*) AS n_lines, sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS amount,
         count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS n_returned
  FROM src_lineitem
  GROUP BY l_orderkey
)
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS state,
       coalesce(n_lines, 0) AS n_lines, coalesce(amount, 0) AS amount, coalesce(n_returned, 0) AS n_returned
FROM src_orders LEFT JOIN src_lineitem ON o_orderkey = l_orderkey
