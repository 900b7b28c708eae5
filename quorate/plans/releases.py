"""Differences between two states of orders, and assertions."""

from __future__ import annotations

from pyspark.sql import functions as F

from quorate.operators import lookup, releases
from quorate.plans.base import query

_STATES = """
prev AS (SELECT o_orderkey AS id, o_custkey AS cust, o_totalprice AS price, o_orderstatus AS status, o_orderdate AS day, o_orderstatus <> 'P' AS ok FROM orders WHERE o_orderkey % 10 <> 1),
cur AS (
  SELECT CASE WHEN o_orderkey % 97 = 0 THEN o_orderkey + 1000000 ELSE o_orderkey END AS id, o_custkey AS cust, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS price,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS status, o_orderdate AS day, o_orderstatus <> 'P' AND o_orderkey % 13 <> 0 AS ok FROM orders WHERE o_orderkey % 10 <> 2),
c AS (SELECT * FROM cur WHERE ok), p AS (SELECT * FROM prev WHERE ok),
j AS (
  SELECT coalesce(c.id, p.id) AS id, c.id IS NULL AS gone, p.id IS NULL AS fresh, c.price IS DISTINCT FROM p.price AS dp, c.status IS DISTINCT FROM p.status AS ds,
         coalesce(c.cust, p.cust) AS cust, coalesce(c.price, p.price) AS price, CASE WHEN c.id IS NULL THEN p.status ELSE c.status END AS status, coalesce(c.day, p.day) AS day FROM c FULL JOIN p ON c.id = p.id),
r AS (
  SELECT n.id, d.id AS old_key FROM (SELECT * FROM j WHERE fresh QUALIFY count(*) OVER (PARTITION BY price, status, cust, day) = 1) n
  JOIN (SELECT * FROM j WHERE gone QUALIFY count(*) OVER (PARTITION BY price, status, cust, day) = 1) d
    ON n.price IS NOT DISTINCT FROM d.price AND n.status IS NOT DISTINCT FROM d.status AND n.cust IS NOT DISTINCT FROM d.cust AND n.day IS NOT DISTINCT FROM d.day),
changes AS (
  SELECT id, NULL::BIGINT AS old_key, CASE WHEN fresh THEN 'new' WHEN gone THEN 'deleted' ELSE 'changed' END AS kind,
         CASE WHEN fresh OR gone THEN '' ELSE concat_ws(',', CASE WHEN dp THEN 'price' END, CASE WHEN ds THEN 'status' END) END AS fields
  FROM j WHERE (fresh OR gone OR dp OR ds) AND id NOT IN (SELECT id FROM r) AND id NOT IN (SELECT old_key FROM r)
  UNION ALL SELECT id, old_key, 'changed', 'id' FROM r)"""


def _changes(t):
    o = t.orders
    base = lambda df: df.select("id", F.col("o_custkey").alias("cust"), "price", "status", F.col("o_orderdate").alias("day"), "ok")
    prev = base(o.where("o_orderkey % 10 <> 1").withColumns({"id": F.col("o_orderkey"), "price": F.col("o_totalprice"), "status": F.col("o_orderstatus"), "ok": F.expr("o_orderstatus <> 'P'")}))
    cur = base(
        o.where("o_orderkey % 10 <> 2").withColumns(
            {
                "id": F.expr("CASE WHEN o_orderkey % 97 = 0 THEN o_orderkey + 1000000 ELSE o_orderkey END"),
                "price": F.expr("CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END"),
                "status": F.expr("CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END"),
                "ok": F.expr("o_orderstatus <> 'P' AND o_orderkey % 13 <> 0"),
            }
        )
    )
    return releases.diff(cur, prev, "id", ["price", "status"], scope="ok", context=["cust", "day"])


@query(f"WITH {_STATES} SELECT id, old_key, kind, fields FROM changes")
def diff_orders(t):
    """New, deleted and changed rows, with changed keys found by equal content."""
    return _changes(t).select("id", "old_key", "kind", F.array_join("fields", ",").alias("fields"))


@query(f"WITH {_STATES} SELECT unnest(string_split(fields, ',')) AS field, count(*) AS n FROM changes WHERE fields <> '' GROUP BY 1")
def diff_fields(t):
    """How often each column changed."""
    return releases.field_counts(_changes(t))


@query(f"WITH {_STATES} SELECT id, old_key FROM r")
def rekey_detect(t):
    """Rows whose key changed while their content did not."""
    return _changes(t).where("old_key IS NOT NULL").select("id", "old_key")


@query(f"""
WITH {_STATES} SELECT kind, count(*) AS n, round(count(*) / (SELECT count(*) FROM orders), 6) AS share, count(*) / (SELECT count(*) FROM orders) > 0.1 AS suspicious, count(*) > 5 AS truncated,
  array_to_string(list(id ORDER BY id)[1:5], ',') AS sample FROM changes GROUP BY kind""")
def diff_profile(t):
    """Counts, shares and samples of each kind of change."""
    total = t.orders.agg(F.count("*").alias("total"))
    out = releases.diff_profile(_changes(t).join(F.broadcast(total)), 1, "id", samples=5).join(F.broadcast(total))
    share = F.col("n") / F.col("total")
    return out.select("kind", "n", F.round(share, 6).alias("share"), (share > 0.1).alias("suspicious"), "truncated", F.array_join(F.transform("sample", lambda x: x.cast("string")), ",").alias("sample"))


@query("""
SELECT * FROM (VALUES ('volume', 'passed'), ('positive price', 'passed'), ('known status', 'passed'), ('no urgent orders', 'failed'), ('missing column', 'skipped')) v("check", status)""")
def litmus_suite(t):
    """Assertions with any or no rows expected; a missing column skips a check."""
    checks = [
        releases.Check("volume", lambda d: d.agg(F.count("*").alias("n")).where("n >= 100"), "any"),
        releases.Check("positive price", lambda d: d.where("o_totalprice <= 0")),
        releases.Check("known status", lambda d: d.where("o_orderstatus NOT IN ('F', 'O', 'P')")),
        releases.Check("no urgent orders", lambda d: d.where("o_orderpriority = '1-URGENT'")),
        releases.Check("missing column", lambda d: d.where("no_such_column > 0")),
    ]
    return releases.run_checks(t.orders, checks)


@query("""
SELECT 'discount' AS "check", CAST(sum(CASE WHEN coalesce(l_discount <= 0.08, false) THEN 0 ELSE 1 END) AS BIGINT) AS violations FROM lineitem
UNION ALL SELECT 'quantity', CAST(sum(CASE WHEN coalesce(l_quantity >= 2, false) THEN 0 ELSE 1 END) AS BIGINT) FROM lineitem""")
def invariant_counts(t):
    """Violations of row conditions, counted in one pass."""
    return releases.count_checks(t.lineitem, {"discount": F.col("l_discount") <= 0.08, "quantity": F.col("l_quantity") >= 2})


@query("SELECT l_partkey AS key, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def fan_out_guard(t):
    """Keys of a lookup that would multiply rows."""
    return lookup.ambiguous_keys(t.lineitem, "l_partkey").withColumnRenamed("l_partkey", "key")


@query("""SELECT 'lang' AS "column", 'string' AS type, count(*) - count(lang) AS nulls, min(lang) AS least, max(lang) AS largest FROM documents UNION ALL SELECT 'source', 'string', count(*) - count(source), min(source), max(source) FROM documents""")
def table_profile(t):
    """Nulls and range of each column, in one pass."""
    return releases.profile(t.documents.select("lang", "source")).select("column", "type", F.col("nulls").cast("long").alias("nulls"), "least", "largest")
