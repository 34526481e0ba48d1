"""The same domain views as DuckDB SQL, as common table expressions."""

ORD = "l_linenumber, l_extendedprice, l_quantity, l_partkey, l_suppkey"

VERTICES = f"""vertices AS (SELECT l_orderkey AS image, row_number() OVER (PARTITION BY l_orderkey ORDER BY {ORD}) AS k,
 l_extendedprice AS x, l_quantity AS y FROM lineitem)"""

BOXES = f"""boxes AS (SELECT l_orderkey AS image, row_number() OVER (PARTITION BY l_orderkey ORDER BY {ORD}) AS box,
 CASE WHEN l_returnflag = 'A' THEN 1 WHEN l_returnflag = 'N' THEN 2 WHEN l_linestatus = 'F' THEN 0 ELSE 1 END AS class_id,
 l_extendedprice / 110000 AS score, l_quantity AS y1, round(l_discount * 100) AS x1, l_quantity + 10 + l_linenumber AS y2,
 round(l_discount * 100) + 20 + round(l_tax * 100) AS x2, l_partkey AS part FROM lineitem)"""

GT = """gts AS (SELECT image, box AS gt, CASE WHEN part % 11 = 0 THEN -class_id ELSE class_id END AS class_id,
 y1 + 2 + CASE WHEN part % 3 = 0 THEN 500 ELSE 0 END AS y1, x1 + 1 AS x1, y2 + 1 + CASE WHEN part % 3 = 0 THEN 500 ELSE 0 END AS y2, x2 + 3 AS x2 FROM boxes WHERE class_id > 0)"""

PIXELS = """pixels AS (SELECT image, CAST(floor(p / 8.0) AS INT) AS r, CAST(p % 8 AS INT) AS c,
 CAST(least(greatest(floor(CAST(f AS DOUBLE) * 64 + 128), 0), 255) AS INT) AS v
 FROM (SELECT vec_id AS image, unnest(embedding) AS f, unnest(range(len(embedding))) AS p FROM embeddings))"""

CENTROIDS = """cents AS (SELECT user_id AS image, event_id AS idx, CAST(floor(value / 32) AS INT) AS id_i,
 CAST(floor((hour(ts) * 60 + minute(ts)) / 160.0) AS INT) AS id_j, value AS x, CAST(hour(ts) * 60 + minute(ts) AS DOUBLE) AS y FROM events)"""

LAYERS = """layers AS (SELECT CAST(p_partkey % 4 AS INT) AS layer, p_partkey AS fid, CAST((p_partkey * 37) % 480 AS DOUBLE) AS x0,
 CAST((p_partkey * 91) % 1400 AS DOUBLE) AS y0, (p_partkey * 37) % 480 + p_size / 10.0 AS x1,
 (p_partkey * 91) % 1400 + p_size / 5.0 AS y1 FROM part)"""

PREDICTIONS = "preds0 AS (SELECT * FROM boxes WHERE score >= 0.5)"

DIAMONDS = """diamonds AS (SELECT p_partkey AS fid, CAST(p_partkey * 37 % 480 AS DOUBLE) AS cx, CAST(p_partkey * 91 % 1400 AS DOUBLE) AS cy, CAST(p_size % 6 + 1 AS DOUBLE) AS r FROM part)"""

SCENE_PIXELS = """spx AS (SELECT CAST(image AS VARCHAR) AS image_name, p // 16 AS band, p % 16 // 4 AS r, p % 4 AS c, CAST(least(greatest(floor(CAST(f AS DOUBLE) * 256), 0), 65535) AS INT) AS v
 FROM (SELECT vec_id AS image, unnest(embedding) AS f, unnest(range(len(embedding))) AS p FROM embeddings))"""

SCENES = """scenes AS (SELECT o_orderkey AS image, '/data/scenes/' || substr(o_orderpriority, 1, 1) || '/WV0' || (o_orderkey % 3 + 1) || '_'
 || strftime(o_orderdate, '%Y%m%d%H%M%S') || '_' || lpad(CAST(o_orderkey AS VARCHAR), 16, '0') || '_u16rf3413.v2_pansh.tif' AS path,
 CAST(o_orderkey % 1000 + 1 AS INT) AS width, CAST(o_orderkey * 7 % 900 + 1 AS INT) AS height FROM orders)"""
