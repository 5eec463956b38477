"""Queries for section B (projections, filters, predicates) and the listing report."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import filters as B
from tessera.operators.aggregates import group_stats
from tessera.plans.catalog import register
from tessera.plans.derived import SQL_EVENT_ITEMS, event_items
from tessera.session import table

# The market segments kept by name in the listing report; the rest fold into 'Other'.
KEEP_SEGMENTS = ["AUTOMOBILE", "BUILDING", "MACHINERY"]


def listing_report(spark, sf_dir):
    """Filter orders by price range, attach customers (left join), impute missing customer fields,
    fold rare segments into 'Other', then count / average / maximum per folded segment."""
    orders = B.filter_range(
        table(spark, sf_dir, "orders"), between={"o_totalprice": (1000.0, 400000.0)}, greater={"o_custkey": -1}
    )
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    joined = orders.join(cust, orders.o_custkey == cust.c_custkey, "left")
    filled = B.impute(joined, {"c_mktsegment": "UNKNOWN", "c_acctbal": 0.0})
    folded = filled.withColumn("segment", B.case_in_list("c_mktsegment", KEEP_SEGMENTS))
    return group_stats(folded, "segment", "o_totalprice")


register(
    "listing_report",
    """
    SELECT CASE WHEN coalesce(c_mktsegment, 'UNKNOWN') IN ('AUTOMOBILE','BUILDING','MACHINERY')
                THEN coalesce(c_mktsegment, 'UNKNOWN') ELSE 'Other' END AS segment,
           count(*) AS n, CAST(avg(o_totalprice) AS DECIMAL(12,2)) AS avg_value, max(o_totalprice) AS max_value
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    WHERE o_totalprice BETWEEN 1000 AND 400000 AND o_custkey > -1
    GROUP BY 1
    """,
)(listing_report)


@register(
    "filter_range",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 50000 AND 300000 AND o_custkey > 100",
)
def q_filter_range(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return B.filter_range(o, between={"o_totalprice": (50000.0, 300000.0)}, greater={"o_custkey": 100}).select(
        "o_orderkey", "o_totalprice"
    )


@register(
    "filter_all_not_null",
    """SELECT d.doc_id, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
       WHERE l.quality IS NOT NULL AND l.toxic IS NOT NULL""",
)
def q_filter_all_not_null(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id")
    lab = table(spark, sf_dir, "labels")
    return B.filter_all_not_null(d.join(lab, "doc_id", "left"), ["quality", "toxic"])


@register(
    "case_in_list_other",
    """SELECT p_partkey, CASE WHEN p_brand IN ('Brand#1','Brand#2','Brand#3','Brand#4','Brand#5')
              THEN p_brand ELSE 'Other' END AS brand FROM part""",
)
def q_case_in_list(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    allow = [f"Brand#{i}" for i in range(1, 6)]
    return p.select("p_partkey", B.case_in_list("p_brand", allow).alias("brand"))


@register(
    "impute_constant",
    """SELECT c_custkey, coalesce(n_orders, 0) AS n_orders, coalesce(total, 0.0) AS total,
              coalesce(last_priority, 'none') AS last_priority
       FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total,
                                       max(o_orderpriority) AS last_priority
                                FROM orders GROUP BY o_custkey) o ON c_custkey = o_custkey""",
)
def q_impute_constant(spark, sf_dir):
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.round(F.sum("o_totalprice"), 2).alias("total"),
        F.max("o_orderpriority").alias("last_priority"),
    )
    c = table(spark, sf_dir, "customer").select("c_custkey")
    j = c.join(o, c.c_custkey == o.o_custkey, "left").select("c_custkey", "n_orders", "total", "last_priority")
    return B.impute(j, {"n_orders": 0, "total": 0.0, "last_priority": "none"})


@register(
    "impute_conditional",
    """SELECT p_partkey, CASE WHEN (p_retailprice - 900) > 100 THEN (p_retailprice - 900)
                              WHEN (p_size % 5) IS NULL OR (p_size % 5) = 0 THEN 350.0
                              ELSE 380.0 * (p_size % 5) END AS square_feet
       FROM part""",
)
def q_impute_conditional(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select(
        "p_partkey", B.derive_with_fallback(F.col("p_retailprice") - 900, F.col("p_size") % 5).alias("square_feet")
    )


@register(
    "sql_over_view",
    """SELECT c_mktsegment, count(*) AS n, round(avg(c_acctbal), 4) AS avg_bal
       FROM customer WHERE c_acctbal > 0 GROUP BY c_mktsegment""",
)
def q_sql_over_view(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return B.sql_over_view(
        spark,
        c,
        "customer_view",
        """SELECT c_mktsegment, count(*) AS n, round(avg(c_acctbal), 4) AS avg_bal
           FROM customer_view WHERE c_acctbal > 0 GROUP BY c_mktsegment""",
    )


@register(
    "numeric_coerce_dropna",
    """SELECT page_id, page_num FROM (
         SELECT page_id, TRY_CAST(string_split(url, '/')[-1] AS DOUBLE) AS page_num FROM pages)
       WHERE page_num IS NOT NULL""",
)
def q_coerce(spark, sf_dir):
    pg = table(spark, sf_dir, "pages").select("page_id", F.try_element_at(F.split("url", "/"), F.lit(-1)).alias("page_num"))
    return B.coerce_dropna(pg, ["page_num"])


@register(
    "drop_columns",
    "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem",
)
def q_drop_columns(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    unused = ["l_partkey", "l_suppkey", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    return B.drop_unused(li, unused, label="l_shipdate")


@register(
    "filter_max_length",
    """SELECT a.conv_id, a.turn, len(string_split(a.text, ' ')) AS src_len, len(string_split(b.text, ' ')) AS tgt_len
       FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1
       WHERE len(string_split(a.text, ' ')) <= 60 AND len(string_split(b.text, ' ')) <= 60""",
)
def q_filter_max_length(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    a = c.select("conv_id", "turn", F.split("text", " ").alias("src"))
    b = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.split("text", " ").alias("tgt"))
    pairs = a.join(b, ["conv_id", "turn"])
    return B.filter_max_length(pairs, "src", "tgt", 60).select(
        "conv_id", "turn", F.size("src").alias("src_len"), F.size("tgt").alias("tgt_len")
    )


@register(
    "filter_prefix_suffix",
    """SELECT page_id, url FROM pages
       WHERE (lower(url) LIKE '%.html' OR lower(url) LIKE '%/') AND contains(url, '/en/')""",
)
def q_filter_prefix_suffix(spark, sf_dir):
    pg = table(spark, sf_dir, "pages").select("page_id", "url")
    return B.filter_contains(B.filter_ext(pg, "url", [".HTML", "/"]), "url", "/en/")


@register(
    "filter_tag_membership",
    f"SELECT event_id, user_id FROM {SQL_EVENT_ITEMS} WHERE list_contains(tags, 'high') AND list_contains(tags, 'click')",
)
def q_filter_tag(spark, sf_dir):
    it = event_items(spark, sf_dir)
    return it.filter(B.has_tag("tags", "high") & B.has_tag("tags", "click")).select("event_id", "user_id")


@register(
    "head_or_index_subset",
    """SELECT vec_id, label FROM (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS pos FROM embeddings)
       WHERE pos IN (SELECT pos FROM (SELECT DISTINCT (vec_id * 7) % 100 AS pos FROM embeddings) ORDER BY pos LIMIT 40)""",
)
def q_index_subset(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    positions = emb.select(((F.col("vec_id") * 7) % 100).alias("pos")).distinct()
    return B.index_subset(emb, ["vec_id"], positions, 40)


@register(
    "head_n",
    "SELECT vec_id, label FROM embeddings ORDER BY vec_id LIMIT 100",
)
def q_head(spark, sf_dir):
    return B.head_subset(table(spark, sf_dir, "embeddings").select("vec_id", "label"), ["vec_id"], 100)


@register(
    "train_holdout_tail",
    """SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY doc_id) > count(*) OVER () - 100 THEN 'test' ELSE 'train' END AS split
       FROM documents""",
)
def q_split_tail(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id")
    return B.split_tail(d, ["doc_id"], n_test=100)


@register(
    "train_holdout_fraction",
    """SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY doc_id) - 1 >= floor(count(*) OVER () * 0.75) THEN 'test' ELSE 'train' END AS split
       FROM documents""",
)
def q_split_frac(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id")
    return B.split_tail(d, ["doc_id"], train_frac=0.75)


@register("random_split")
def q_random_split(spark, sf_dir):
    """Stable hash split 70/30 of orders (no oracle: the hash function is Spark's)."""
    return B.hash_split(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", [0.7, 0.3], seed=42)
