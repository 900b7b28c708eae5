"""Hierarchies over customers, nations and regions, and over parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from quorate.operators import graph
from quorate.plans.base import query

_TREE = """
tree AS (
  SELECT 'r' || r_regionkey AS id, 'root' AS parent, 'class' AS rank, r_name AS name FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, 'order', n_name FROM nation
  UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, 'family', c_name FROM customer)"""


def _tree(t):
    tag = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    r = t.region.select(tag("r", "r_regionkey").alias("id"), F.lit("root").alias("parent"), F.lit("class").alias("rank"), F.col("r_name").alias("name"))
    n = t.nation.select(tag("n", "n_nationkey").alias("id"), tag("r", "n_regionkey").alias("parent"), F.lit("order").alias("rank"), F.col("n_name").alias("name"))
    c = t.customer.select(tag("c", "c_custkey").alias("id"), tag("n", "c_nationkey").alias("parent"), F.lit("family").alias("rank"), F.col("c_name").alias("name"))
    return r.unionByName(n).unionByName(c)


@query(f"""
WITH RECURSIVE {_TREE}, c(child, ancestor, level) AS (SELECT id, parent, 1 FROM tree UNION ALL SELECT c.child, t.parent, level + 1 FROM c JOIN tree t ON c.ancestor = t.id)
SELECT child, ancestor, CAST(level AS BIGINT) AS level FROM c""")
def closure_geo_tree(t):
    """Every ancestor of every node with its distance."""
    return graph.closure(_tree(t), "id", "parent").select("child", "ancestor", F.col("level").cast("long").alias("level"))


@query(f"""
WITH {_TREE} SELECT a.id, CASE WHEN a.rank = 'family' THEN p.name END AS "order", CASE WHEN a.rank = 'family' THEN g.name WHEN a.rank = 'order' THEN p.name END AS class
FROM tree a LEFT JOIN tree p ON a.parent = p.id LEFT JOIN tree g ON p.parent = g.id""")
def ancestor_at_level(t):
    """The nearest ancestor of each rank, as columns."""
    return graph.ancestor_at_rank(_tree(t), "id", "parent", "rank", "name", ["order", "class"]).select("id", "order", "class")


@query(f"""
WITH RECURSIVE {_TREE}, d(id) AS (SELECT id FROM tree WHERE name IN ('ASIA', 'EUROPE') UNION SELECT t.id FROM tree t JOIN d ON t.parent = d.id) SELECT id AS node FROM d""")
def scope_by_roots(t):
    """Everything below some roots."""
    tree = _tree(t)
    return graph.descendants(tree, "id", "parent", tree.where("name IN ('ASIA', 'EUROPE')"), "id")


@query(f"""
WITH RECURSIVE {_TREE}, v AS (SELECT 'c' || o_custkey AS id, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL),
u(id, o_orderstatus, n) AS (SELECT * FROM v UNION ALL SELECT t.parent, o_orderstatus, n FROM u JOIN tree t ON u.id = t.id)
SELECT id, o_orderstatus, CAST(sum(n) AS BIGINT) AS n FROM u GROUP BY ALL""")
def rollup_revenue_tree(t):
    """Counts rolled up level by level along direct edges."""
    v = t.orders.groupBy(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("id"), "o_orderstatus").agg(F.count("*").alias("n"))
    return graph.rollup(v, _tree(t), "id", "id", "parent", ["o_orderstatus"], ["n"])


@query(f"""
WITH {_TREE}, k AS (SELECT id, parent, id[1] = 'c' AND CAST(id[2:] AS BIGINT) % 211 = 0 AS flag FROM tree),
c AS (SELECT id, parent, flag, CASE WHEN flag THEN 'v' || (CAST(id[2:] AS BIGINT) % 3) END AS votes FROM k),
n AS (SELECT parent AS id, string_agg(DISTINCT votes, ',' ORDER BY votes) AS votes FROM c WHERE flag GROUP BY 1),
r AS (SELECT t.parent AS id, string_agg(DISTINCT x, ',' ORDER BY x) AS votes FROM n JOIN tree t ON n.id = t.id, unnest(string_split(n.votes, ',')) u(x) GROUP BY 1)
SELECT c.id, (c.flag OR n.id IS NOT NULL OR r.id IS NOT NULL) AS flag, coalesce(c.votes, n.votes, r.votes, '') AS votes FROM c LEFT JOIN n ON c.id = n.id LEFT JOIN r ON c.id = r.id""")
def cascade_flags(t):
    """Flags and their provenance promoted upwards to a fixpoint."""
    n = F.expr("try_cast(substring(id, 2) AS bigint)")
    rows = _tree(t).withColumn("flag", F.col("id").startswith("c") & (n % 211 == 0)).withColumn("by", F.when(F.col("flag"), F.array(F.concat(F.lit("v"), (n % 3).cast("string")))).otherwise(F.array().cast("array<string>")))
    return graph.cascade_up(rows, "id", "parent", "flag", "by").select("id", "flag", F.array_join("by", ",").alias("votes"))


@query("""
WITH p AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN split_part(p_name, ' ', 1) ELSE p_name END AS name, p_size > 10 AS ok, CASE WHEN p_size % 2 = 0 THEN 'a' ELSE 'b' END AS g, p_size FROM part),
o AS (SELECT id, g, split_part(name, ' ', 1) AS name FROM p WHERE contains(name, ' ')),
h AS (SELECT id AS t, g, name, p_size FROM p WHERE ok AND NOT contains(name, ' '))
SELECT p.id, b.t AS parent FROM p LEFT JOIN (SELECT o.id, t FROM o JOIN h ON o.g = h.g AND o.name = h.name WHERE o.id <> t QUALIFY row_number() OVER (PARTITION BY o.id ORDER BY p_size DESC, t) = 1) b ON p.id = b.id""")
def orphans_to_first_word(t):
    """Two-word names go to the accepted one-word name they start with."""
    name = F.when(F.expr("p_partkey % 3 = 0"), F.split_part("p_name", F.lit(" "), F.lit(1))).otherwise(F.col("p_name"))
    rows = t.part.select(F.col("p_partkey").alias("id"), name.alias("name"), (F.col("p_size") > 10).alias("ok"), F.when(F.expr("p_size % 2 = 0"), "a").otherwise("b").alias("g"), F.lit(None).cast("long").alias("parent"), "p_size")
    rows = rows.withColumn("rank", F.when(F.contains("name", F.lit(" ")), "species").otherwise("genus"))
    return graph.link_orphans(rows, "id", "parent", "name", "rank", "g", "ok", F.col("p_size")).select("id", "parent")


@query("""
WITH s AS (SELECT s_suppkey AS id, CASE WHEN s_suppkey % 3 > 0 THEN n_regionkey % 4 END AS top, CASE WHEN s_suppkey % 5 > 0 THEN s_nationkey END AS mid, s_suppkey % 17 AS low FROM supplier JOIN nation ON s_nationkey = n_nationkey),
c1 AS (SELECT mid, top, count(*) AS n FROM s WHERE mid IS NOT NULL AND top IS NOT NULL GROUP BY ALL), m1 AS (SELECT mid, top FROM c1 QUALIFY row_number() OVER (PARTITION BY mid ORDER BY n DESC, top) = 1),
s1 AS (SELECT id, coalesce(s.top, m1.top) AS top, s.mid, low FROM s LEFT JOIN m1 ON s.mid = m1.mid),
c2 AS (SELECT low, top, count(*) AS n FROM s1 WHERE top IS NOT NULL GROUP BY ALL), m2 AS (SELECT low, top FROM c2 QUALIFY row_number() OVER (PARTITION BY low ORDER BY n DESC, top) = 1),
c3 AS (SELECT low, mid, count(*) AS n FROM s1 WHERE mid IS NOT NULL GROUP BY ALL), m3 AS (SELECT low, mid FROM c3 QUALIFY row_number() OVER (PARTITION BY low ORDER BY n DESC, mid) = 1)
SELECT id, coalesce(s1.top, m2.top) AS top, coalesce(s1.mid, m3.mid) AS mid, s1.low FROM s1 LEFT JOIN m2 ON s1.low = m2.low LEFT JOIN m3 ON s1.low = m3.low""")
def backfill_mode_region(t):
    """Missing higher ranks filled with the most frequent value, rank by rank."""
    rows = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("id"), F.when(F.expr("s_suppkey % 3 > 0"), F.col("n_regionkey") % 4).alias("top"), F.when(F.expr("s_suppkey % 5 > 0"), F.col("s_nationkey")).alias("mid"), (F.col("s_suppkey") % 17).alias("low"))
    return graph.backfill_mode(rows, ["top", "mid", "low"])


@query("SELECT n_nationkey, nullif(count(c_custkey), 0) AS child_count FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey AND c_acctbal > 5000 GROUP BY 1")
def child_counts(t):
    """Accepted children of each node; null without any."""
    rows = t.nation.select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("id"), F.lit(None).cast("string").alias("parent"), F.lit(True).alias("ok"), "n_nationkey")
    kids = t.customer.select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("id"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("parent"), (F.col("c_acctbal") > 5000).alias("ok"))
    return graph.child_counts(rows.unionByName(kids, allowMissingColumns=True), "id", "parent", "ok").where("n_nationkey IS NOT NULL").select("n_nationkey", "child_count")


@query("""
WITH p AS (SELECT p_partkey AS id, nullif(p_partkey % 400, 0) AS parent, p_name AS name, p_size > 20 AS ok FROM part), b AS (SELECT name, min(id) AS best FROM p WHERE ok GROUP BY name)
SELECT p.id, CASE WHEN o.ok THEN p.parent WHEN b.best <> p.id THEN b.best END AS parent FROM p LEFT JOIN p o ON p.parent = o.id LEFT JOIN b ON b.name = o.name""")
def relink_dangling(t):
    """Parents that are not accepted give way to the accepted row of their name."""
    rows = t.part.select(F.col("p_partkey").alias("id"), F.nullif(F.col("p_partkey") % 400, F.lit(0).cast("long")).alias("parent"), F.col("p_name").alias("name"), (F.col("p_size") > 20).alias("ok"))
    return graph.relink_dangling(rows, "id", "parent", "name", "ok").select("id", "parent")


@query("""SELECT p_partkey AS id, coalesce(CASE WHEN p_size > 25 THEN 'known' END, split_part(p_name, ' ', 1)) AS genus FROM part""")
def genus_fallback(t):
    """The first word of a species name where its genus is not known."""
    return t.part.select(F.col("p_partkey").alias("id"), graph.genus_from_name(F.lit("species"), F.col("p_name"), F.when(F.col("p_size") > 25, "known")).alias("genus"))
