"""Scans, text clean-up, joins, aggregates, windows and set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quorate.functions import collections as C
from quorate.functions import geo, text, vocabulary
from quorate.operators import history, lookup
from quorate.plans.base import query

# ---- text


@query(r"""
SELECT p_partkey, nullif(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(p_name) || ' var. "X"-y', ' (notho)?(ser|var|subsp|f)(\.?)(\s|$)', ' ', 'g'), '["ʽ]', '''', 'g'), '[^a-z\x20-\x27]', '', 'g'), ' {2,}', ' ', 'g')), '') AS name
FROM part""")
def clean_titles(t):
    """Names without rank tokens, odd characters and double spaces."""
    return t.part.select("p_partkey", text.clean_name(F.concat(F.lower("p_name"), F.lit(' var. "X"-y'))).alias("name"))


@query(r"""
SELECT p_partkey, CASE WHEN contains(lower(p_name), lower(split_part(p_name, ' ', 1))) THEN regexp_replace(trim(replace(lower(p_name || ' b  c'), lower(split_part(p_name, ' ', 1)), '')), '\s+', ' ') ELSE p_name END AS name FROM part""")
def strip_infix(t):
    """Names without a part; only the first run of spaces collapses."""
    return t.part.select("p_partkey", text.strip_infix(F.concat("p_name", F.lit(" b  c")), F.split_part("p_name", F.lit(" "), F.lit(1))).alias("name"))


@query("""
WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN replace(p_name, ' ', ' x ') ELSE p_name END AS n, CASE WHEN p_partkey % 5 = 0 THEN 'nothovar.' ELSE 'species' END AS r FROM part),
m AS (SELECT p_partkey, r, replace(n, ' x ', ' × ') AS n FROM p)
SELECT p_partkey, replace(replace(n, '× ', ''), '×', '') AS name_clean, (contains(n, '×') OR starts_with(r, 'notho')) AS hybrid,
       CASE WHEN contains(n, '×') OR starts_with(r, 'notho') THEN CAST(nullif(strpos(n, '×') - 1, -1) AS BIGINT) END AS hybridpos FROM m""")
def find_hybrids(t):
    """Hybrid marker, its place, and the name without it."""
    rows = t.part.select("p_partkey", F.when(F.expr("p_partkey % 3 = 0"), F.replace("p_name", F.lit(" "), F.lit(" x "))).otherwise(F.col("p_name")).alias("name_clean"), F.when(F.expr("p_partkey % 5 = 0"), "nothovar.").otherwise("species").alias("rank_raw"))
    return text.find_markers(rows).select("p_partkey", "name_clean", "hybrid", F.col("hybridpos").cast("long").alias("hybridpos"))


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'accepted' WHEN 'O' THEN 'synonym' END AS status_clean, o_orderstatus = 'F' AND true AS accepted, o_orderstatus = 'O' AS synonym FROM orders WHERE o_orderstatus IN ('F', 'O')
UNION ALL SELECT o_orderkey, NULL, NULL, NULL FROM orders WHERE o_orderstatus NOT IN ('F', 'O')""")
def status_map(t):
    """Canonical status by a broadcast lookup; unknown spellings stay null, and so do the flags."""
    raw = F.when(F.col("o_orderstatus") == "F", "Provisionally Accepted").when(F.col("o_orderstatus") == "O", "HOMOTYPIC synonym").otherwise("?")
    out = text.map_values(t.orders.withColumn("status_raw", raw), "status_raw", vocabulary.STATUS_SPELLINGS, "status_clean")
    yes, no = text.status_flags(F.col("status_clean"))
    return out.select("o_orderkey", "status_clean", yes.alias("accepted"), no.alias("synonym"))


@query("""
SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'species' WHEN 1 THEN 'variety' WHEN 2 THEN 'form' WHEN 3 THEN 'unranked' END AS rank_clean,
       CAST(CASE p_size % 5 WHEN 0 THEN 19 WHEN 1 THEN 22 WHEN 2 THEN 24 WHEN 3 THEN 29 END AS BIGINT) AS place FROM part""")
def rank_map(t):
    """Canonical rank and its place in the order of ranks."""
    raw = F.element_at(F.array(*[F.lit(x) for x in ("Nothosp.", "[beta].", "f.sp.", "no rank", "nonsense")]), F.col("p_size") % 5 + 1)
    out = text.map_values(t.part.withColumn("rank_raw", raw), "rank_raw", vocabulary.RANK_SPELLINGS, "rank_clean")
    return out.select("p_partkey", "rank_clean", text.rank_order(F.col("rank_clean")).cast("long").alias("place"))


@query(r"""
SELECT page_id, nullif(regexp_extract(url, '^https?://([^/]+)', 1), '') AS host, nullif(regexp_extract(url, '/([a-z]{2})/', 1), '') AS lang, TRY_CAST(nullif(regexp_extract(url, '/(\d+)', 1), '') AS BIGINT) AS number FROM pages""")
def url_ids(t):
    """Host, language and number out of addresses."""
    url = F.col("url")
    return t.pages.select("page_id", text.extract_id(url, "^https?://([^/]+)", "string").alias("host"), text.extract_id(url, "/([a-z]{2})/", "string").alias("lang"), text.extract_id(url, r"/(\d+)").alias("number"))


_AREA = "CASE p_partkey % 6 WHEN 0 THEN n_name WHEN 1 THEN lower(n_name) || ' (south)' WHEN 2 THEN n_name || '; elsewhere' WHEN 3 THEN 'Nowhere, ' || n_name WHEN 4 THEN 'Zz' ELSE 'Atlantis' END"


@query(rf"""
WITH a AS (SELECT DISTINCT {_AREA} AS area_raw FROM part JOIN nation ON n_nationkey = p_partkey % 25),
c AS (
  SELECT area_raw, area_raw AS candidate, 0 AS pass FROM a UNION ALL SELECT area_raw, trim(regexp_replace(area_raw, '\([^)]*\)', '', 'g')), 1 FROM a
  UNION ALL SELECT area_raw, trim(split_part(area_raw, ';', 1)), 2 FROM a WHERE contains(area_raw, ';') UNION ALL SELECT area_raw, trim(unnest(string_split(area_raw, ','))), 3 FROM a
  UNION ALL SELECT area_raw, trim(regexp_extract(area_raw, '([^,]+)$', 1)), 4 FROM a WHERE contains(area_raw, ',')),
m AS (
  SELECT area_raw, 'n' || n_nationkey AS code FROM c JOIN nation ON trim(regexp_replace(lower(n_name), '[^a-z0-9]+', ' ', 'g')) = trim(regexp_replace(lower(candidate), '[^a-z0-9]+', ' ', 'g'))
  QUALIFY row_number() OVER (PARTITION BY area_raw ORDER BY pass, length(candidate) DESC) = 1)
SELECT * FROM m UNION ALL SELECT area_raw, lower(area_raw) FROM a WHERE regexp_matches(area_raw, '^[A-Za-z][A-Za-z]$') AND area_raw NOT IN (SELECT area_raw FROM m)""")
def area_match_cascade(t):
    """Free-text areas to codes by readings from exact to loose."""
    rows = t.part.join(t.nation, F.expr("n_nationkey = p_partkey % 25")).select(F.expr(_AREA).alias("area"))
    return lookup.match_areas(rows, "area", t.nation.select("n_name", F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("code")), "n_name", "code")


@query(r"""
WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'L. (' || (1700 + p_size) || ')' ELSE 'Mill.' END AS author FROM part)
SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'L.' ELSE author END AS author, CAST(nullif(regexp_extract(author, '(\d{4})', 1), '') AS BIGINT) AS year FROM p""")
def split_author_year(t):
    """A trailing year out of the author."""
    a, y = text.split_year(F.when(F.expr("p_partkey % 2 = 0"), F.concat(F.lit("L. ("), (F.col("p_size") + 1700).cast("string"), F.lit(")"))).otherwise(F.lit("Mill.")))
    return t.part.select("p_partkey", a.alias("author"), y.cast("long").alias("year"))


@query(r"""SELECT p_partkey AS id, CASE WHEN p_partkey % 4 = 0 THEN 'words' ELSE 'characters' END AS reason FROM part WHERE p_partkey % 4 = 0 OR p_partkey % 4 = 1""")
def validate_long_names(t):
    """Names with too many words or odd characters."""
    name = F.lower("p_name")
    rows = t.part.select(F.col("p_partkey").alias("id"), F.when(F.expr("p_partkey % 4 = 0"), F.concat(name, F.lit(" three four"))).when(F.expr("p_partkey % 4 = 1"), F.concat(name, F.lit("-1"))).otherwise(name).alias("name_clean"))
    return text.invalid_names(rows).select("id", "reason")


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 > 0 THEN p_brand END AS authority FROM part")
def prefix_authority(t):
    """What follows the name in a longer string."""
    full = F.when(F.expr("p_partkey % 3 > 0"), F.concat("p_name", F.lit(" "), "p_brand")).otherwise(F.concat(F.lit("x "), "p_name"))
    return t.part.select("p_partkey", text.after_prefix(full, F.col("p_name")).alias("authority"))


@query("""
SELECT conv_id, string_agg(DISTINCT CASE role WHEN 'user' THEN 'us' ELSE 'as' END || ':' || lower(trim(split_part(text, ' ', 1))), ',' ORDER BY CASE role WHEN 'user' THEN 'us' ELSE 'as' END || ':' || lower(trim(split_part(text, ' ', 1)))) AS names
FROM conversations WHERE role IN ('user', 'assistant') AND trim(split_part(text, ' ', 1)) <> '' GROUP BY conv_id""")
def tagged_names(t):
    """Names with short language codes, as one list for each id."""
    codes = t.spark.createDataFrame([("user", "us"), ("assistant", "as")], "code string, short string")
    rows = t.conversations.select("conv_id", "role", F.split_part("text", F.lit(" "), F.lit(1)).alias("name"))
    return text.tagged_names(rows, "conv_id", "role", "name", codes, "code", "short").select("conv_id", F.array_join("names", ",").alias("names"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(m.best, l_partkey) AS entity FROM lineitem
LEFT JOIN (SELECT p_partkey + 1 AS s, min(p_partkey) AS best FROM part WHERE p_partkey % 6 = 0 GROUP BY 1) m ON m.s = l_partkey""")
def resolve_synonyms(t):
    """Observations of synonyms counted under the accepted key; the raw key stays."""
    synonyms = t.part.where("p_partkey % 6 = 0").select((F.col("p_partkey") + 1).alias("s"), F.col("p_partkey").alias("a"))
    return lookup.resolve_synonyms(t.lineitem, "l_partkey", synonyms, "s", "a", "entity").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "entity")


# ---- JSON, lists and maps


@query("""
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) IN (1, 3, 5) AS flag FROM events""")
def json_props_flags(t):
    """A typed value and a membership flag out of a JSON column."""
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    return t.events.select("event_id", k.alias("k"), k.isin(1, 3, 5).alias("flag"))


@query(r"""
SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(list_filter(regexp_split_to_array(lower(text), '[^\x21-\x7E\x80-\x{10FFFF}]+'), lambda w: w <> '')) AS word FROM documents) GROUP BY ALL HAVING count(*) >= 50""")
def unnest_words(t):
    """Frequent words of each language, from exploded texts."""
    word = F.explode(F.filter(F.split(F.lower("text"), r"[^\x21-\x7E\x{80}-\x{10FFFF}]+"), lambda w: w != "")).alias("word")
    return t.documents.select("lang", word).groupBy("lang", "word").agg(F.count("*").alias("n")).where("n >= 50")


@query("""SELECT source, string_agg(lang || '=' || n, ',' ORDER BY lang) AS langs FROM (SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL) GROUP BY source""")
def map_lang_counts(t):
    """A map from language to count for each source, read through its entries."""
    counts = t.documents.groupBy("source", "lang").agg(F.count("*").alias("n"))
    m = counts.groupBy("source").agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("m"))
    return m.select("source", F.array_join(F.transform(F.array_sort(F.map_entries("m")), lambda e: F.concat(e.key, F.lit("="), e.value.cast("string"))), ",").alias("langs"))


@query("""
WITH l AS (SELECT o_custkey, list(CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END ORDER BY o_orderkey) AS xs FROM orders GROUP BY 1)
SELECT o_custkey, len(list_distinct(xs)) AS n, list_contains(xs, '1-URGENT') AS urgent, list_any_value(xs) AS first, CAST(len(list_append(nullif(xs, []), 'x')) AS BIGINT) AS longer FROM l""")
def list_helpers(t):
    """List functions that treat nulls as the oracle does."""
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    xs = t.orders.withColumn("x", status).groupBy("o_custkey").agg(C.ordered_list("x", "o_orderkey").alias("xs"))
    c = F.col("xs")
    return xs.select("o_custkey", C.list_unique(c).cast("long").alias("n"), C.list_contains(c, "1-URGENT").alias("urgent"), C.list_any_value(c).alias("first"), F.size(C.list_append(c, F.lit("x"))).cast("long").alias("longer"))


# ---- joins


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 100000)")
def semi_customers_with_orders(t):
    return t.customer.join(t.orders.where("o_totalprice > 100000"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def anti_orders_without_lines(t):
    return t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti").select("o_orderkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_totalprice > 300000)")
def null_aware_anti(t):
    """NOT IN without nulls on the right is an anti join."""
    return t.customer.join(t.orders.where("o_custkey IS NOT NULL AND o_totalprice > 300000"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("SELECT coalesce(a.doc_id, b.doc_id + 7) AS doc_id, a.lang, b.quality FROM documents a FULL JOIN labels b ON a.doc_id = b.doc_id + 7")
def full_outer_label_docs(t):
    """Whole tables; labels moved by seven, so that both sides have rows without a partner."""
    return t.documents.select("doc_id", "lang").join(t.labels.select((F.col("doc_id") + 7).alias("doc_id"), "quality"), "doc_id", "full")


@query("""
SELECT a.k, a.n AS left_n, b.n AS right_n FROM (SELECT nullif(p_size, 7) AS k, count(*) AS n FROM part WHERE p_partkey % 2 = 0 GROUP BY 1) a
JOIN (SELECT nullif(p_size, 7) AS k, count(*) AS n FROM part WHERE p_partkey % 2 = 1 GROUP BY 1) b ON a.k IS NOT DISTINCT FROM b.k""")
def nullsafe_join(t):
    """Null equals null."""
    part = lambda r: t.part.where(f"p_partkey % 2 = {r}").groupBy(F.nullif(F.col("p_size"), F.lit(7)).alias("k")).agg(F.count("*").alias("n"))
    a, b = part(0).alias("a"), part(1).alias("b")
    return a.join(b, F.col("a.k").eqNullSafe(F.col("b.k"))).select(F.col("a.k").alias("k"), F.col("a.n").alias("left_n"), F.col("b.n").alias("right_n"))


@query("SELECT o_orderkey, r_name FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey WHERE o_totalprice > 50000")
def lookup_chain(t):
    """Small tables are broadcast by their size, which the optimizer checks."""
    rows = t.orders.where("o_totalprice > 50000").join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return rows.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select("o_orderkey", "r_name")


_PATH = r"regexp_extract(url, '^https?://[^/]+(/.*)$', 1)"


@query(rf"""
WITH p AS (SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host, {_PATH} AS path FROM pages), q AS (SELECT page_id * 1000 + k AS id, host, path[1:k] AS path FROM p, range(1, 6) r(k))
SELECT p.page_id, q.id AS parent FROM p JOIN q ON p.host = q.host AND starts_with(p.path, q.path) AND length(q.path) < length(p.path)
QUALIFY row_number() OVER (PARTITION BY p.page_id ORDER BY length(q.path) DESC, q.id) = 1""")
def prefix_path_parent(t):
    """The longest path of a host that starts a page's path."""
    p = t.pages.select("page_id", F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"), F.regexp_extract("url", "^https?://[^/]+(/.*)$", 1).alias("path"))
    q = p.withColumn("k", F.explode(F.array(*[F.lit(i) for i in range(1, 6)]))).select((F.col("page_id") * 1000 + F.col("k")).alias("page_id"), "host", F.expr("substring(path, 1, k)").alias("path"))
    return lookup.prefix_parent(p, q, "host", "path", "page_id")


# ---- aggregates


@query("""
SELECT l_returnflag, l_linestatus, CAST(sum(l_linenumber) AS BIGINT) AS s, min(l_quantity) AS low, max(l_quantity) AS high, round(avg(l_quantity), 6) AS mean, count(*) AS n, count(DISTINCT struct_pack(a := l_partkey, b := l_suppkey)) AS pairs,
       count(*) FILTER (WHERE l_discount > 0.05) AS cheap, CAST(sum(CASE WHEN l_tax > 0.04 THEN 1 ELSE 0 END) AS BIGINT) AS taxed FROM lineitem GROUP BY ALL HAVING count(*) > 10""")
def aggregate_sweep(t):
    """Counts, sums, distinct structs, filtered and conditional aggregates with HAVING."""
    return (
        t.lineitem.groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.sum("l_linenumber").alias("s"), F.min("l_quantity").alias("low"), F.max("l_quantity").alias("high"), F.round(F.avg("l_quantity"), 6).alias("mean"), F.count("*").alias("n"),
            F.countDistinct(F.struct("l_partkey", "l_suppkey")).alias("pairs"), F.count_if(F.col("l_discount") > 0.05).alias("cheap"), F.sum(F.when(F.col("l_tax") > 0.04, 1).otherwise(0)).alias("taxed"),
        )
        .where("n > 10")
    )


@query("SELECT c_mktsegment, string_agg(DISTINCT CAST(c_nationkey AS VARCHAR), ', ' ORDER BY CAST(c_nationkey AS VARCHAR)) AS nations FROM customer GROUP BY 1")
def listagg_nations(t):
    return t.customer.groupBy("c_mktsegment").agg(F.array_join(F.array_sort(F.collect_set(F.col("c_nationkey").cast("string"))), ", ").alias("nations"))


@query("""
WITH k AS (SELECT s_nationkey, s_suppkey % 7 AS x, count(*) AS n FROM supplier GROUP BY ALL)
SELECT s_nationkey, x FROM k QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY n DESC, x) = 1""")
def mode_with_ties(t):
    """The most frequent value; of equals the least."""
    return t.supplier.groupBy("s_nationkey").agg(F.mode(F.col("s_suppkey") % 7, True).alias("x"))


@query("SELECT user_id, event_type, arg_min(event_id, struct_pack(a := ts, b := event_id)) AS event_id, min(ts) AS ts FROM events GROUP BY ALL")
def first_event_per_user_type(t):
    """The first event of each user and type, from one aggregation."""
    return history.first_events(t.events, ["user_id", "event_type"], ["ts", "event_id"], ["event_id", "ts"])


@query("SELECT user_id, event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS n FROM events WHERE event_type = (SELECT min(event_type) FROM events) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) <= 2")
def two_earliest_errors(t):
    """The first two events of one type for each user."""
    kind = t.events.agg(F.min("event_type").alias("kind"))
    rows = t.events.join(F.broadcast(kind), F.col("event_type") == F.col("kind"))
    return history.earliest(rows, ["user_id"], [F.col("ts"), F.col("event_id")], 2).select("user_id", "event_id", F.col("n").cast("long").alias("n"))


@query("""
WITH y AS (SELECT o_orderkey, CAST(o_orderkey % 2200 AS BIGINT) AS page, CAST(nullif(o_custkey % 2100, 3) AS BIGINT) AS item, 1700 + CAST(o_orderkey % 250 AS BIGINT) AS lo, 1700 + CAST(o_orderkey % 250 AS BIGINT) + CAST(o_custkey % 120 AS BIGINT) AS hi FROM orders),
c AS (SELECT *, lo + ((page % 100 - lo % 100 + 100) % 100) AS pc, lo + ((item % 100 - lo % 100 + 100) % 100) AS ic FROM y)
SELECT o_orderkey, CASE WHEN page BETWEEN 1600 AND 2025 THEN page WHEN page <= 2025 AND page BETWEEN lo AND hi THEN page WHEN item <= 2025 AND item BETWEEN lo AND hi THEN item
  WHEN pc <= 2025 AND pc BETWEEN lo AND hi AND pc + 100 > hi THEN pc WHEN ic <= 2025 AND ic BETWEEN lo AND hi AND ic + 100 > hi THEN ic WHEN item BETWEEN 1600 AND 2025 THEN item END AS year FROM c""")
def year_ladder(t):
    """A year from page, item and range, by the first rung that holds."""
    lo = F.lit(1700) + F.col("o_orderkey") % 250
    page, item = F.col("o_orderkey") % 2200, F.nullif(F.col("o_custkey") % 2100, F.lit(3).cast("long"))
    return t.orders.select("o_orderkey", history.reconcile_year(page, item, lo, lo + F.col("o_custkey") % 120, F.lit(2025)).cast("long").alias("year"))


@query("""
WITH c AS (SELECT user_id, event_type AS category, event_id AS item, ts, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events),
k AS (SELECT * FROM c WHERE n <= 2), f AS (SELECT user_id, item FROM k WHERE category = (SELECT min(event_type) FROM events) AND n = 1),
r AS (SELECT k.* FROM k LEFT JOIN f ON k.user_id = f.user_id WHERE category <> (SELECT min(event_type) FROM events) AND k.item IS DISTINCT FROM f.item)
SELECT user_id, category, item FROM r QUALIFY row_number() OVER (PARTITION BY user_id, category ORDER BY ts, item) = 1 UNION ALL SELECT user_id, (SELECT min(event_type) FROM events), item FROM f""")
def claimed_first_events(t):
    """One category chooses its item first; the others take their next."""
    rows = history.earliest(t.events, ["user_id", "event_type"], [F.col("ts"), F.col("event_id")], 2)
    kind = t.events.agg(F.min("event_type").alias("kind"))
    rows = rows.join(F.broadcast(kind)).select("user_id", F.col("event_type").alias("category"), F.col("event_id").alias("item"), "ts", "kind")
    return history.claim(rows, "user_id", "item", F.col("category") == F.col("kind"), [F.col("ts"), F.col("item")]).select("user_id", "category", "item")


# ---- sorting, top-k, sets, grouping


@query("SELECT p_partkey, p_brand, p_retailprice, CAST(rn AS BIGINT) AS rn FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rn FROM part) WHERE rn <= 3")
def topk_parts(t):
    w = Window.partitionBy("p_brand").orderBy(F.desc("p_retailprice"), "p_partkey")
    return t.part.withColumn("rn", F.row_number().over(w)).where("rn <= 3").select("p_partkey", "p_brand", "p_retailprice", F.col("rn").cast("long").alias("rn"))


@query("""
(SELECT l_partkey AS k, 'both' AS side FROM lineitem WHERE l_quantity > 45 INTERSECT SELECT l_partkey, 'both' FROM lineitem WHERE l_discount > 0.09)
UNION ALL (SELECT l_partkey, 'first' FROM lineitem WHERE l_quantity > 45 EXCEPT SELECT l_partkey, 'first' FROM lineitem WHERE l_discount > 0.09)""")
def intersect_except_keys(t):
    a, b = (t.lineitem.where(c).select(F.col("l_partkey").alias("k")) for c in ("l_quantity > 45", "l_discount > 0.09"))
    return a.intersect(b).withColumn("side", F.lit("both")).unionByName(a.subtract(b).withColumn("side", F.lit("first")))


@query("SELECT c_custkey AS k, 'c' AS kind FROM customer UNION SELECT s_suppkey, 'c' FROM supplier UNION SELECT o_custkey, 'o' FROM orders")
def union_distinct(t):
    rows = t.customer.select(F.col("c_custkey").alias("k"), F.lit("c").alias("kind")).unionByName(t.supplier.select(F.col("s_suppkey").alias("k"), F.lit("c").alias("kind")))
    return rows.unionByName(t.orders.select(F.col("o_custkey").alias("k"), F.lit("o").alias("kind"))).distinct()


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS q FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), ())")
def grouping_sets_sales(t):
    return t.lineitem.rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("q"))


@query("SELECT p_brand, p_size % 3 AS m, count(*) AS n FROM part GROUP BY CUBE (p_brand, p_size % 3)")
def cube_brand(t):
    return t.part.withColumn("m", F.col("p_size") % 3).cube("p_brand", "m").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, lag(o_totalprice) OVER w AS before, round(sum(o_totalprice) OVER w, 2) AS running, round(sum(o_totalprice) OVER (PARTITION BY o_custkey), 2) AS total, min(o_orderkey) OVER (PARTITION BY o_custkey) AS first FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)")
def lag_prices(t):
    """Lag, running sum, total and minimum over windows that share one exchange."""
    everyone = Window.partitionBy("o_custkey")
    w = everyone.orderBy("o_orderdate", "o_orderkey")
    return t.orders.select("o_orderkey", F.lag("o_totalprice").over(w).alias("before"), F.round(F.sum("o_totalprice").over(w), 2).alias("running"), F.round(F.sum("o_totalprice").over(everyone), 2).alias("total"), F.min("o_orderkey").over(everyone).alias("first"))


@query("SELECT p_name, p_brand, min(p_partkey) AS p_partkey FROM part GROUP BY ALL HAVING count(*) = 1")
def unique_signatures(t):
    """Rows whose signature no other row has."""
    w = Window.partitionBy("p_name", "p_brand")
    return t.part.withColumn("n", F.count("*").over(w)).where("n = 1").select("p_name", "p_brand", "p_partkey")


@query("SELECT event_id, user_id, ts FROM events WHERE event_type <> (SELECT max(event_type) FROM events) AND (ts < TIMESTAMP '2024-01-20' OR ts IS NULL) ORDER BY ts ASC NULLS FIRST, event_id LIMIT 100")
def refresh_queue(t):
    """Rows whose last check is old, oldest first."""
    kind = t.events.agg(F.max("event_type").alias("kind"))
    rows = t.events.join(F.broadcast(kind), F.col("event_type") != F.col("kind"))
    now = F.lit("2024-02-03 00:00:00").cast("timestamp_ntz")
    return lookup.refresh_queue(rows, "event_id", "ts", now, most=100).select("event_id", "user_id", "ts")


# ---- upserts and time windows


@query("""
WITH d AS (SELECT event_id, user_id, ts, value * 2 AS value FROM events WHERE event_id % 3 = 0 UNION ALL SELECT event_id + 1000000, user_id, ts, value FROM events WHERE event_id % 50 = 0 UNION ALL SELECT event_id, user_id, ts - INTERVAL 1 DAY, value FROM events WHERE event_id % 6 = 0),
n AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts DESC, value) = 1)
SELECT event_id, user_id, ts, value FROM events WHERE event_id NOT IN (SELECT event_id FROM n) UNION ALL SELECT * FROM n""")
def upsert_events(t):
    """The newest delta row of each id replaces the existing one."""
    e = t.events.select("event_id", "user_id", "ts", "value")
    delta = e.where("event_id % 3 = 0").withColumn("value", F.col("value") * 2).unionByName(e.where("event_id % 50 = 0").withColumn("event_id", F.col("event_id") + 1000000)).unionByName(e.where("event_id % 6 = 0").withColumn("ts", F.expr("ts - INTERVAL 1 DAY")))
    return lookup.upsert(e, delta, "event_id", [F.col("ts").desc(), F.col("value")])


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def tumbling_counts(t):
    return t.events.groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "event_type", "n")


@query("""
WITH g AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events),
s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g)
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 6 HOUR AS "end", count(*) AS n FROM s GROUP BY user_id, k""")
def session_windows(t):
    """Sessions of each user that end after six hours."""
    return t.events.groupBy(F.session_window("ts", "6 hours"), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


@query("SELECT p_partkey, round(2 * 6371.0088 * asin(sqrt(least(pow(sin(radians(p_size - 10) / 2), 2) + cos(radians(10)) * cos(radians(p_size)) * pow(sin(radians(p_partkey % 180 - 20) / 2), 2), 1.0))), 4) AS km FROM part")
def distances(t):
    km = geo.haversine_km(F.lit(20.0), F.lit(10.0), (F.col("p_partkey") % 180).cast("double"), F.col("p_size").cast("double"))
    return t.part.select("p_partkey", F.round(km, 4).alias("km"))
