/* One row per customer with orders.
   FROM segment_report: not read here, as this is a comment. */
SELECT customer_id, count(*) AS n_orders, sum(amount) AS amount,
       count(CASE WHEN n_returned > 0 THEN 1 END) AS n_with_returns,
       max(CASE WHEN state = 'O' THEN 'open; JOIN segment_report' ELSE 'done' END) AS note
FROM gold_order_facts
GROUP BY customer_id
