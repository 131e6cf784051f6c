SELECT o_orderkey, o_custkey, o_totalprice
FROM scan_orders
WHERE o_orderstatus = 'O';
