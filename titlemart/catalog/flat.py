"""SQL steps that rebuild the titles from the flat tables, without arrays."""

FLAT = """
WITH line AS (
  SELECT l_orderkey AS id, l_linenumber, l_quantity, l_extendedprice, l_discount,
         p_size, p_type, s_suppkey, s_name, s_acctbal, n_nationkey, n_name, r_regionkey, r_name
  FROM lineitem
  LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey
  LEFT JOIN nation ON s_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
), measure AS (
  SELECT id, max(l_discount) AS vote_average, count(*) AS vote_count,
         CAST(max(l_linenumber) AS BIGINT) AS runtime,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS budget,
         CAST(sum(CAST(floor(l_extendedprice) AS BIGINT)) AS BIGINT) AS revenue
  FROM line GROUP BY id
), title AS (
  SELECT o_orderkey AS id, 'T' || o_orderkey AS title,
         CASE WHEN o_orderstatus = 'F' THEN 'Released' ELSE o_orderstatus END AS status,
         CAST(o_orderdate AS DATE) AS release_date, o_totalprice AS popularity,
         CASE WHEN o_orderstatus <> 'P' THEN '/' || o_orderkey || '.jpg' END AS image_path,
         o_orderpriority AS overview, o_orderstatus = 'O' AS video,
         c_custkey, c_name, c_nationkey, c_mktsegment,
         vote_average, vote_count, runtime, budget, revenue
  FROM orders
  LEFT JOIN measure ON o_orderkey = id
  LEFT JOIN customer ON o_custkey = c_custkey
), genre AS (
  SELECT DISTINCT id, CAST(nullif(p_size % 7, 0) AS BIGINT) AS genre_id, p_type AS genre FROM line
), company AS (
  SELECT DISTINCT id, s_suppkey AS company_id, s_name AS company, n_name AS origin
  FROM line WHERE s_acctbal >= 3000
), country AS (
  SELECT DISTINCT id, 'N' || n_nationkey AS country_code, n_name AS country FROM line
), language AS (
  SELECT DISTINCT id, CAST(r_regionkey AS VARCHAR) AS language_code, r_name AS language FROM line
)"""
