WITH late AS (SELECT customer_id FROM order_facts WHERE n_lines = 0)
SELECT c_mktsegment AS segment, n_name AS nation, count(*) AS n_customers, sum(n_orders) AS n_orders, sum(amount) AS amount,
       sum(n_with_returns) AS n_with_returns, count(CASE WHEN note LIKE 'open%' THEN 1 END) AS n_open,
       count(CASE WHEN EXISTS (SELECT 1 FROM late WHERE late.customer_id = a.customer_id) THEN 1 END) AS n_late,
       :run_at AS _data_as_of
FROM customer_activity AS a
JOIN src_customer ON customer_id = c_custkey
JOIN src_nation ON c_nationkey = n_nationkey
WHERE amount > (SELECT avg(amount) / 4 FROM customer_activity)
GROUP BY c_mktsegment, n_name
