"""Votes, linkage, keys and acceptance over the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from quorate.functions import collections as C
from quorate.functions import keys, text
from quorate.operators import clustering, consensus, linking, lookup
from quorate.plans.base import query

_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
_SQL_ORDER = ", ".join(_ORDER)


@query(f"SELECT l_orderkey, list_mode(list(l_returnflag ORDER BY {_SQL_ORDER})) AS flag FROM lineitem GROUP BY l_orderkey")
def vote_order_flag(t):
    """Most frequent return flag of each order; ties go to the line that comes first."""
    return consensus.first_mode_of(t.lineitem, "l_orderkey", "l_returnflag", _ORDER, "flag")


def _authorities(t):
    """Three sources that each name one line of an order: the cheapest, the latest and the largest."""
    first = {"cheapest": F.col("l_extendedprice"), "latest": -F.unix_micros(F.col("l_shipdate").cast("timestamp")), "largest": -F.col("l_quantity")}
    row = F.struct(F.col("l_returnflag").alias("flag"), F.col("l_quantity").alias("quantity"), F.year("l_shipdate").cast("long").alias("year"))
    # a grouped minimum with map-side combining, no sort of an order's lines
    return {k: t.lineitem.groupBy(F.col("l_orderkey").alias("id_raw")).agg(F.min_by(row, F.struct(x, *_ORDER)).alias("x")).select("id_raw", "x.*") for k, x in first.items()}


_AUTHORITIES = "".join(
    f"{name} AS (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY {order}, {_SQL_ORDER}) = 1), "
    for name, order in (("cheapest", "l_extendedprice"), ("latest", "l_shipdate DESC"), ("largest", "l_quantity DESC"))
)
_POOL = "FROM orders o LEFT JOIN cheapest a ON a.l_orderkey = o_orderkey LEFT JOIN latest b ON b.l_orderkey = o_orderkey LEFT JOIN largest c ON c.l_orderkey = o_orderkey"
_LINKS = {"cheapest": "o_orderkey", "latest": "o_orderkey", "largest": "o_orderkey"}


@query(f"WITH {_AUTHORITIES[:-2]} SELECT o_orderkey, list_mode([a.l_returnflag, b.l_returnflag, c.l_returnflag]) AS flag {_POOL}")
def vote_three_sources(t):
    """Priority-ordered majority over three sources; null where no source has a value."""
    return consensus.vote(t.orders, _authorities(t), _LINKS, "flag", "flag").select("o_orderkey", "flag")


@query(
    f"WITH {_AUTHORITIES[:-2]} SELECT o_orderkey, coalesce(list_mode(list_filter([a.l_quantity, b.l_quantity, c.l_quantity], lambda x: x BETWEEN 10 AND 40)), o_totalprice) AS quantity {_POOL}"
)
def vote_with_validity(t):
    """Candidates outside a range do not count; the order's own value is the fallback."""
    return consensus.vote(t.orders, _authorities(t), _LINKS, "quantity", "quantity", fallback="o_totalprice", valid=lambda x: x.between(10, 40)).select("o_orderkey", "quantity")


@query(f"WITH {_AUTHORITIES[:-2]} SELECT o_orderkey, len(list_distinct([year(a.l_shipdate), year(b.l_shipdate), year(c.l_shipdate)])) AS candidates {_POOL} WHERE len(list_distinct([year(a.l_shipdate), year(b.l_shipdate), year(c.l_shipdate)])) > 1")
def ambiguous_votes(t):
    """Orders whose sources name different years."""
    pool = consensus.vote_pool(t.orders, _authorities(t), _LINKS, "year").where(consensus.ambiguous(F.col("pool")))
    return pool.select("o_orderkey", C.list_unique(F.col("pool")).cast("long").alias("candidates"))


@query("""
WITH s1 AS (SELECT 'customer' AS source, c_custkey AS id, c_nationkey AS area, c_mktsegment || '-' || (c_custkey % 97) AS name FROM customer WHERE c_custkey % 3 = 0),
s2 AS (SELECT 'supplier' AS source, s_suppkey AS id, s_nationkey AS area, 'BUILDING-' || (s_suppkey % 97) AS name FROM supplier),
n2 AS (SELECT * FROM s2 WHERE id NOT IN (SELECT id FROM s1) AND name NOT IN (SELECT name FROM s1)),
b2 AS (SELECT * FROM s1 UNION ALL SELECT * FROM n2),
s3 AS (SELECT 'nation' AS source, CAST(n_nationkey + 40 AS BIGINT) AS id, n_regionkey AS area, n_name AS name FROM nation),
n3 AS (SELECT * FROM s3 WHERE id NOT IN (SELECT id FROM b2) AND name NOT IN (SELECT name FROM b2))
SELECT * FROM b2 UNION ALL SELECT * FROM n3""")
def accrete_parties(t):
    """Customers, then suppliers and nations that share neither id nor name with what is there."""
    tag = lambda s, c: F.concat(F.lit(s) if isinstance(s, str) else s, F.lit("-"), (F.col(c) % 97).cast("string"))
    s1 = t.customer.where("c_custkey % 3 = 0").select(F.lit("customer").alias("source"), F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("area"), tag(F.col("c_mktsegment"), "c_custkey").alias("name"))
    s2 = t.supplier.select(F.lit("supplier").alias("source"), F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("area"), tag("BUILDING", "s_suppkey").alias("name"))
    s3 = t.nation.select(F.lit("nation").alias("source"), (F.col("n_nationkey") + 40).cast("long").alias("id"), F.col("n_regionkey").alias("area"), F.col("n_name").alias("name"))
    return linking.accrete(s1, [(s2, ["id", "name"], None), (s3, ["id", "name"], None)])


@query(f"""
SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'O'), f.l_linestatus) AS status, f.l_partkey AS partkey
FROM orders LEFT JOIN (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, {_SQL_ORDER}) = 1) f ON l_orderkey = o_orderkey""")
def fill_ids_ranked(t):
    """Fills missing values from the best of several matching rows."""
    base = t.orders.select("o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("O")).alias("status"), F.lit(None).cast("long").alias("partkey"))
    lines = t.lineitem.withColumnsRenamed({"l_orderkey": "o_orderkey", "l_linestatus": "status"}).withColumn("partkey", F.col("l_partkey"))
    order = [F.col("l_quantity").desc(), *[F.col(c) for c in _ORDER]]
    return lookup.update_from(base, lines, "o_orderkey", ["status", "partkey"], order, fill_only=True)


@query("""
WITH target AS (SELECT p_partkey AS id, p_name AS name, CASE WHEN p_partkey % 4 = 0 THEN p_partkey + 1 END AS ref FROM part WHERE p_partkey % 2 = 0),
free AS (SELECT p_partkey AS r, p_name AS name, p_size FROM part WHERE p_partkey % 2 = 1 AND p_partkey NOT IN (SELECT ref FROM target WHERE ref IS NOT NULL)),
best AS (SELECT id, r FROM target JOIN free USING (name) WHERE ref IS NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY p_size DESC, r) = 1)
SELECT id, name, coalesce(ref, r) AS ref FROM target LEFT JOIN best USING (id)""")
def name_fallback_link(t):
    """Unlinked parts take the most popular part of their name that nothing uses yet."""
    target = t.part.where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.when(F.expr("p_partkey % 4 = 0"), F.col("p_partkey") + 1).alias("ref"))
    reference = t.part.where("p_partkey % 2 = 1").select(F.col("p_partkey").alias("ref"), F.col("p_name").alias("name"), "p_size")
    return linking.link_by_name(target, reference, "name", "p_size", "ref")


@query("""
WITH target AS (SELECT o_orderkey AS id, CASE WHEN o_custkey % 3 <> 0 THEN o_custkey - o_custkey % 2 END AS a, o_custkey - o_custkey % 4 AS b, o_orderpriority AS name FROM orders),
reference AS (SELECT c_custkey AS ref, c_custkey - c_custkey % 2 AS a, CASE WHEN c_custkey % 5 <> 0 THEN c_custkey - c_custkey % 4 END AS b, CASE WHEN c_custkey % 2 = 0 THEN '3-MEDIUM' ELSE '1-URGENT' END AS name, c_acctbal AS pop FROM customer),
first AS (SELECT id, ref FROM target t JOIN reference r USING (a) QUALIFY row_number() OVER (PARTITION BY id ORDER BY CASE WHEN t.name = r.name THEN 0 ELSE 1 END, pop DESC, ref) = 1),
second AS (SELECT id, ref FROM target t JOIN reference r USING (b) WHERE id NOT IN (SELECT id FROM first) QUALIFY row_number() OVER (PARTITION BY id ORDER BY CASE WHEN t.name = r.name THEN 0 ELSE 1 END, pop DESC, ref) = 1)
SELECT id, ref FROM target LEFT JOIN (SELECT * FROM first UNION ALL SELECT * FROM second) USING (id)""")
def link_by_two_keys(t):
    """Links by the first key that finds a row: equal name first, then popularity, then id."""
    target = t.orders.select(F.col("o_orderkey").alias("id"), F.expr("CASE WHEN o_custkey % 3 <> 0 THEN o_custkey - o_custkey % 2 END AS a"), F.expr("o_custkey - o_custkey % 4 AS b"), F.col("o_orderpriority").alias("name"))
    reference = t.customer.select(F.col("c_custkey").alias("ref"), F.expr("c_custkey - c_custkey % 2 AS a"), F.expr("CASE WHEN c_custkey % 5 <> 0 THEN c_custkey - c_custkey % 4 END AS b"), F.expr("CASE WHEN c_custkey % 2 = 0 THEN '3-MEDIUM' ELSE '1-URGENT' END AS name"), F.col("c_acctbal").alias("pop"))
    return linking.link_by_keys(target, reference, ["a", "b"], "name", "pop", "ref").select("id", "ref")


@query("""
WITH target AS (SELECT p_partkey AS id, p_name AS name, CASE WHEN p_partkey % 10 = 0 THEN p_partkey END AS sid FROM part),
source AS (SELECT p_partkey AS sid, p_name AS name, p_retailprice FROM part WHERE p_partkey % 5 = 0 AND p_partkey NOT IN (SELECT sid FROM target WHERE sid IS NOT NULL)),
best AS (SELECT * FROM source QUALIFY row_number() OVER (PARTITION BY name ORDER BY p_retailprice DESC, sid) = 1),
first AS (SELECT * FROM target WHERE sid IS NULL QUALIFY row_number() OVER (PARTITION BY name ORDER BY id) = 1)
SELECT t.id, t.name, coalesce(t.sid, b.sid) AS sid FROM target t LEFT JOIN first f ON t.id = f.id LEFT JOIN best b ON b.name = f.name""")
def one_to_one_names(t):
    """The best free row of each name goes to the first unlinked row of that name."""
    target = t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.when(F.expr("p_partkey % 10 = 0"), F.col("p_partkey")).alias("sid"))
    source = t.part.where("p_partkey % 5 = 0").select(F.col("p_partkey").alias("sid"), F.col("p_name").alias("name"), "p_retailprice")
    return linking.fill_one_to_one(target, source, "name", "sid", [F.col("p_retailprice").desc(), F.col("sid")])


@query("""
SELECT o_orderkey, coalesce(CASE WHEN o_totalprice > 200000 THEN o_orderpriority END, CASE WHEN o_custkey % 7 <> 0 THEN c_mktsegment END) AS a, c_nationkey AS b
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def supplement_links(t):
    """Fills several ids from the linked row with one join."""
    target = t.orders.select("o_orderkey", F.col("o_custkey").alias("ref"), F.when(F.col("o_totalprice") > 200000, F.col("o_orderpriority")).alias("a"), F.lit(None).cast("int").alias("b"))
    reference = t.customer.select(F.col("c_custkey").alias("ref"), F.when(F.expr("c_custkey % 7 <> 0"), F.col("c_mktsegment")).alias("a"), F.col("c_nationkey").alias("b"))
    return linking.supplement_ids(target, reference, "ref", ["a", "b"]).select("o_orderkey", "a", "b")


_UUID = """
WITH k AS (SELECT p_partkey, lower(concat_ws(':', 'plantae', nullif(p_type, 'PROMO'), replace(p_name, ' ', '.'), nullif(p_brand, 'Brand#11'), CAST(1700 + p_size AS VARCHAR))) AS s FROM part),
h AS (SELECT p_partkey, sha1(unhex('fb5218eb4b385c1f9c4eb798e8616f9a') || encode(s)) AS d FROM k)
SELECT p_partkey, d[1:8] || '-' || d[9:12] || '-5' || d[14:16] || '-' || ['8','9','a','b','8','9','a','b','8','9','a','b','8','9','a','b'][strpos('0123456789abcdef', d[17])] || d[18:20] || '-' || d[21:32] AS id FROM h"""


@query(_UUID)
def uuid5_keys(t):
    """Deterministic keys from the parts of a name; null parts are skipped."""
    key = keys.entity_key(F.lit("plantae"), F.nullif(F.col("p_type"), F.lit("PROMO")), F.col("p_name"), F.nullif(F.col("p_brand"), F.lit("Brand#11")), F.lit(1700) + F.col("p_size"))
    return t.part.select("p_partkey", keys.uuid5(key).alias("id"))


@query("""
WITH d AS (SELECT doc_id, md5(text) AS h, lang, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE source END AS source, quality, toxic FROM documents LEFT JOIN labels USING (doc_id))
SELECT h, doc_id, lang, source, max(quality) OVER (PARTITION BY h) AS quality, toxic FROM d
QUALIFY row_number() OVER (PARTITION BY h ORDER BY (source IS NOT NULL)::INT + (quality IS NOT NULL)::INT + (toxic IS NOT NULL)::INT DESC, (source IS NOT NULL)::INT DESC, doc_id) = 1""")
def merge_duplicate_docs(t):
    """One row for each text: the most complete one, then the least id."""
    rows = t.documents.join(t.labels, "doc_id", "left").select("doc_id", F.md5(F.encode("text", "UTF-8")).alias("h"), "lang", F.when(F.expr("doc_id % 3 = 0"), None).otherwise(F.col("source")).alias("source"), "quality", "toxic")
    return consensus.merge_duplicates(rows, "h", ids=["source"], largest=["quality"], tie=["doc_id"])


@query("""
WITH d AS (
  SELECT o_orderkey, CASE WHEN o_custkey % 2 = 0 THEN 'plantae' ELSE 'fungi' END AS kingdom,
         CASE o_orderstatus WHEN 'F' THEN 'accepted' WHEN 'O' THEN 'synonym' END AS wcvp, CASE WHEN o_totalprice > 150000 THEN 'accepted' ELSE 'synonym' END AS col, o_totalprice > 300000 AS popular FROM orders),
v AS (
  SELECT o_orderkey, popular, concat_ws(',', CASE WHEN kingdom = 'plantae' AND wcvp = 'accepted' THEN 'wcvp' END, CASE WHEN col = 'accepted' THEN 'col' END) AS yes,
         concat_ws(',', CASE WHEN kingdom = 'plantae' AND wcvp = 'synonym' THEN 'wcvp' END, CASE WHEN col = 'synonym' THEN 'col' END) AS no FROM d)
SELECT o_orderkey, concat_ws(',', nullif(yes, ''), CASE WHEN no = '' AND popular THEN 'wikidata' END) AS accepted_by, no AS considered_synonym, no <> '' AS synonym, (yes <> '' OR (no = '' AND popular)) AS accepted FROM v""")
def accept_by_status(t):
    """Votes of each kingdom's authorities, any-vote flags and the popularity rule."""
    rows = t.orders.withColumn("kingdom", F.when(F.expr("o_custkey % 2 = 0"), "plantae").otherwise("fungi"))
    votes = {"wcvp": F.when(F.col("o_orderstatus") == "F", "accepted").when(F.col("o_orderstatus") == "O", "synonym"), "col": F.when(F.col("o_totalprice") > 150000, "accepted").otherwise("synonym")}
    out = consensus.decide_acceptance(rows, votes, popular=F.col("o_totalprice") > 300000)
    return out.select("o_orderkey", F.array_join("accepted_by", ",").alias("accepted_by"), F.array_join("considered_synonym", ",").alias("considered_synonym"), "synonym", "accepted")


@query("""
WITH p AS (SELECT p_partkey AS id, p_name AS name, p_size > 5 AS accepted, CASE WHEN p_size % 3 > 0 THEN p_size % 3 END AS syn, nullif(p_size, 20) AS year, p_brand, nullif(p_type, 'ECONOMY') AS kind, p_size > 45 AS flag, p_retailprice AS price FROM part),
a AS (SELECT * FROM p WHERE accepted),
k AS (SELECT kind, name, count(*) AS n FROM a WHERE kind IS NOT NULL GROUP BY ALL),
modes AS (SELECT name, kind FROM k QUALIFY row_number() OVER (PARTITION BY name ORDER BY n DESC, kind) = 1),
m AS (SELECT name, count(*) AS many, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS brands, coalesce(bool_or(flag), false) AS flag, max(price) AS price FROM a GROUP BY name),
r AS (SELECT a.*, row_number() OVER (PARTITION BY name ORDER BY syn ASC NULLS LAST, year ASC NULLS LAST, id) AS n FROM a)
SELECT id, r.name, n = 1 AS accepted, CASE WHEN n = 1 AND many > 1 THEN brands ELSE p_brand END AS brands, CASE WHEN n = 1 AND many > 1 THEN m.flag ELSE r.flag END AS flag,
       CASE WHEN n = 1 AND many > 1 THEN coalesce(r.kind, modes.kind) ELSE r.kind END AS kind, CASE WHEN n = 1 AND many > 1 THEN m.price ELSE r.price END AS price
FROM r JOIN m ON r.name = m.name LEFT JOIN modes ON r.name = modes.name
UNION ALL SELECT id, name, accepted, p_brand, flag, kind, price FROM p WHERE NOT accepted""")
def dedupe_part_names(t):
    """One accepted row for each name, with what the others know; the losers stay."""
    rows = t.part.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), (F.col("p_size") > 5).alias("accepted"), F.nullif(F.col("p_size") % 3, F.lit(0)).alias("syn"), F.nullif(F.col("p_size"), F.lit(20)).alias("year"),
        F.array("p_brand").alias("brands"), F.nullif(F.col("p_type"), F.lit("ECONOMY")).alias("kind"), (F.col("p_size") > 45).alias("flag"), F.col("p_retailprice").alias("price"),
    )
    order = [F.col("syn").asc_nulls_last(), F.col("year").asc_nulls_last(), F.col("id")]
    out = consensus.dedupe_by(rows, "name", order, lists=["brands"], flags=["flag"], fills=["kind"], largest=["price"])
    return out.select("id", "name", "accepted", F.array_join("brands", ",").alias("brands"), "flag", "kind", "price")


@query("""
SELECT l_suppkey, string_agg(DISTINCT lower(n_name), ',' ORDER BY lower(n_name)) AS regions,
       coalesce(string_agg(DISTINCT lower(n_name), ',' ORDER BY lower(n_name)) FILTER (WHERE l_returnflag = 'N'), '') AS native_to
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY l_suppkey""")
def list_union_regions(t):
    """Distinct areas of each supplier, all and those with a flag."""
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    area = F.lower("n_name")
    gather = lambda x: F.array_join(F.array_sort(F.collect_set(x)), ",")
    return rows.groupBy("l_suppkey").agg(gather(area).alias("regions"), gather(F.when(F.col("l_returnflag") == "N", area)).alias("native_to"))


@query("""
WITH p AS (SELECT o_orderkey AS id, o_custkey % 7 = 0 AS flag FROM orders), s AS (SELECT l_orderkey AS id, max(l_returnflag) = 'R' AS flag FROM lineitem GROUP BY 1)
SELECT p.id, CASE WHEN s.id IS NULL THEN p.flag ELSE coalesce(nullif(p.flag, false), s.flag) END AS flag FROM p LEFT JOIN s USING (id)""")
def transfer_flags(t):
    """A true flag stays, else the other source's counts."""
    base = t.orders.select(F.col("o_orderkey").alias("id"), F.expr("o_custkey % 7 = 0").alias("flag"))
    source = t.lineitem.groupBy(F.col("l_orderkey").alias("id")).agg((F.max("l_returnflag") == "R").alias("flag"))
    return consensus.transfer_flags(base, source, "id", ["flag"])


@query("""
WITH s AS (SELECT p_partkey AS id, p_partkey % 300 AS parent_raw, CASE WHEN p_size % 2 = 0 THEN 'a' ELSE 'b' END AS kingdom FROM part),
c AS (SELECT p_partkey AS id, p_name AS name, CASE WHEN p_size % 2 = 0 THEN 'a' ELSE 'b' END AS kingdom FROM part WHERE p_size > 40)
SELECT s.id, coalesce(min(c.id), s.parent_raw) AS parent FROM s LEFT JOIN part r ON r.p_partkey = s.parent_raw LEFT JOIN c ON c.name = r.p_name AND c.kingdom = s.kingdom GROUP BY s.id, s.parent_raw""")
def canonical_parents(t):
    """Each row's parent as the canonical row of its name and kingdom, else the raw one."""
    kingdom = F.when(F.expr("p_size % 2 = 0"), "a").otherwise("b").alias("kingdom")
    sources = t.part.select(F.col("p_partkey").alias("id"), (F.col("p_partkey") % 300).alias("parent_raw"), kingdom)
    records = t.part.select(F.col("p_partkey").alias("id_raw"), F.col("p_name").alias("name"))
    canonical = t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), kingdom, (F.col("p_size") > 40).alias("accepted"))
    return consensus.canonical_parents(sources, records, canonical)


@query("""
WITH h AS (SELECT o_orderkey AS cur, unnest([o_orderkey + 100000, o_orderkey + 200000]) AS old FROM orders WHERE o_orderkey % 5 = 0),
o AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_orderkey + (CASE WHEN l_linenumber % 2 = 0 THEN 100000 ELSE 0 END) AS id FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(m.cur, o.id) AS id FROM o LEFT JOIN (SELECT old, min(cur) AS cur FROM h GROUP BY old) m ON o.id = m.old""")
def redirect_obsolete_ids(t):
    """Former ids, kept in lists, are replaced by the current ones."""
    history = t.orders.where("o_orderkey % 5 = 0").select(F.col("o_orderkey").alias("cur"), F.array(F.col("o_orderkey") + 100000, F.col("o_orderkey") + 200000).alias("old"))
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (F.col("l_orderkey") + F.when(F.expr("l_linenumber % 2 = 0"), 100000).otherwise(0)).alias("id"))
    return lookup.redirect(rows, "id", history, "cur", "old").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "id")


@query("""
WITH s AS (SELECT p_partkey AS k, p_name AS name, p_size > 25 AS ok FROM part WHERE p_partkey % 4 > 0),
x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_partkey IN (SELECT k FROM s) THEN l_partkey END AS id FROM lineitem),
m AS (SELECT a.k, min(b.k) AS best FROM s a JOIN s b ON a.name = b.name AND b.ok WHERE NOT a.ok GROUP BY a.k)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, left(CAST(coalesce(best, id) AS VARCHAR), 14) AS id FROM x LEFT JOIN m ON x.id = m.k""")
def polish_ids(t):
    """Ids the source does not have become null; those of rows not accepted become the accepted one of the name."""
    source = t.part.where("p_partkey % 4 > 0").select(F.col("p_partkey").alias("k"), F.col("p_name").alias("name"), (F.col("p_size") > 25).alias("ok"))
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_partkey").alias("id"))
    out = lookup.prefer_accepted(lookup.keep_known(rows, "id", source, "k"), "id", source, "k", "name", "ok")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.left(F.col("id").cast("string"), F.lit(14)).alias("id"))


@query("""
WITH c AS (SELECT o_orderkey AS id, o_custkey % 11 AS shared, CASE o_orderstatus WHEN 'F' THEN 'accepted' WHEN 'O' THEN 'synonym' ELSE 'x' END AS status FROM orders),
b AS (SELECT o_custkey AS p, count(*) AS n FROM orders GROUP BY 1)
SELECT shared, id, status, coalesce(b.n, 0) AS backlinks FROM c LEFT JOIN b ON c.id = b.p
QUALIFY row_number() OVER (PARTITION BY shared ORDER BY CASE status WHEN 'accepted' THEN 0 WHEN 'synonym' THEN 1 ELSE 2 END, coalesce(b.n, 0) DESC, id) = 1""")
def concept_ranking(t):
    """The concept that keeps a shared id: status, backlinks, support, id."""
    rows = t.orders.select(F.col("o_orderkey").alias("id"), "o_custkey", (F.col("o_custkey") % 11).alias("shared"), F.when(F.col("o_orderstatus") == "F", "accepted").when(F.col("o_orderstatus") == "O", "synonym").otherwise("x").alias("status"))
    counted = linking.backlinks(rows, "o_custkey", "id")
    return lookup.pick_one(counted, ["shared"], linking.concept_order(F.col("status"), F.col("backlinks"), [], F.col("id"))).select("shared", "id", "status", "backlinks")


@query()
def string_clusters(t):
    """First words of turns as spelling variants in each role, reduced and ranked."""
    names = t.conversations.select((F.col("conv_id") % 50).alias("key"), F.when(F.col("role") == "user", "en").otherwise("xx").alias("lang"), F.explode(F.slice(F.split("text", r"\s+"), 1, 4)).alias("name"))
    return clustering.cluster_strings(names, "key", "lang", "name").select("key", F.map_keys("vernacular").alias("langs"), F.size(F.flatten(F.map_values("vernacular"))).cast("long").alias("n"), "common_name")


@query("""
WITH v AS (SELECT user_id, event_type || ':' || event_id AS pair FROM events), s AS (SELECT user_id, string_split(pair, ':')[1] AS k, string_split(pair, ':')[2] AS x FROM v)
SELECT user_id, k, string_agg(x, ',' ORDER BY x) AS xs FROM s GROUP BY ALL""")
def split_pairs(t):
    """Lists of "key:value" regrouped by key."""
    k, x = C.key_values(F.concat("event_type", F.lit(":"), F.col("event_id").cast("string")))
    return t.events.select("user_id", k.alias("k"), x.alias("x")).groupBy("user_id", "k").agg(F.array_join(F.array_sort(F.collect_list("x")), ",").alias("xs"))


@query("""
SELECT p_partkey, CASE WHEN len(string_split(p_name, ' ')) = 1 THEN 'genus' WHEN len(string_split(p_name, ' ')) = 2 THEN 'species' END AS rank FROM part""")
def infer_rank_from_words(t):
    """Rank by the shape of a name."""
    return t.part.select("p_partkey", text.rank_of_name(F.col("p_name")).alias("rank"))


