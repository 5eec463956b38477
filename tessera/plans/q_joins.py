"""Queries for section C (joins)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import joins as C
from tessera.operators.text import bucket_bounds, vocab_sorted
from tessera.operators.windows import running_sums
from tessera.plans.catalog import register
from tessera.plans.derived import SQL_MODEL_PREDICTIONS, model_predictions, model_votes
from tessera.session import cut_lineage, table


@register(
    "join_positional_zip",
    """SELECT a.pos, a.conv_id AS user_conv, a.turn AS user_turn, b.conv_id AS reply_conv, b.turn AS reply_turn
       FROM (SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS pos, conv_id, turn FROM conversations WHERE role = 'user') a
       JOIN (SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS pos, conv_id, turn FROM conversations WHERE role = 'assistant') b
       ON a.pos = b.pos""",
)
def q_zip(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    u = c.filter(F.col("role") == "user").select(F.col("conv_id").alias("user_conv"), F.col("turn").alias("user_turn"))
    r = c.filter(F.col("role") == "assistant").select(F.col("conv_id").alias("reply_conv"), F.col("turn").alias("reply_turn"))
    return C.zip_rows(u, r, ["user_conv", "user_turn"], ["reply_conv", "reply_turn"], strict=False)


@register(
    "join_parallel_turns",
    """SELECT a.conv_id, a.turn, a.text AS source, b.text AS target FROM conversations a
       JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 WHERE a.role = 'user'""",
)
def q_pair_turns(spark, sf_dir):
    return C.pair_turns(table(spark, sf_dir, "conversations"))


@register(
    "join_lookup_chain",
    """SELECT s_suppkey, n.n_name, r.r_name FROM supplier s
       LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",
)
def q_lookup_chain(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nk"))
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    # nation and region have a fixed size (25 and 5 rows at every scale): broadcast is safe
    out = C.lookup_chain(s, "nk", n, "n_nationkey", "n_regionkey", r, "r_regionkey", "r_name",
                         first_only=True, broadcast_dims=True)
    names = F.broadcast(n.select(F.col("n_nationkey").alias("nk"), "n_name"))
    return out.join(names, "nk", "left").select("s_suppkey", "n_name", "r_name")


# The label table of the default lookup (text -> index); other labels map to -1.
PRIORITY_LABELS = [("1-URGENT", 0), ("2-HIGH", 1), ("3-MEDIUM", 2)]


@register(
    "join_lookup_default",
    """SELECT o_orderkey, coalesce(l.idx, -1) AS label_idx FROM orders
       LEFT JOIN (VALUES ('1-URGENT', 0), ('2-HIGH', 1), ('3-MEDIUM', 2)) l(label, idx) ON o_orderpriority = l.label""",
)
def q_lookup_default(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    labels = F.broadcast(spark.createDataFrame(PRIORITY_LABELS, "label string, idx int"))
    return C.label_index(o, "o_orderpriority", labels, "label", "idx").select("o_orderkey", "label_idx")


_WORDS_SQL = "regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')"


def _words(df):
    return df.select("doc_id", F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), 0).alias("words"))


@register(
    "join_vocab_encode",
    f"""WITH w AS (SELECT doc_id, unnest({_WORDS_SQL}) AS word, unnest(range(len({_WORDS_SQL}))) AS p FROM documents),
            v AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS id FROM (SELECT DISTINCT word FROM w))
       SELECT documents.doc_id, coalesce(list(id ORDER BY p) FILTER (WHERE id IS NOT NULL), []) AS ids
       FROM documents LEFT JOIN (SELECT w.doc_id, id, p FROM w JOIN v USING (word)) e USING (doc_id) GROUP BY documents.doc_id""",
)
def q_vocab_encode(spark, sf_dir):
    d = cut_lineage(_words(table(spark, sf_dir, "documents")))
    vocab = vocab_sorted(d.select(F.explode("words").alias("word")), "word")
    return C.encode_words(d, "doc_id", "words", vocab)


@register(
    "join_unknown_token",
    f"""WITH w AS (SELECT doc_id, unnest({_WORDS_SQL}) AS word, unnest(range(len({_WORDS_SQL}))) AS p FROM documents),
            v AS (SELECT DISTINCT unnest({_WORDS_SQL}) AS word FROM benchmark)
       SELECT d.doc_id, coalesce(string_agg(CASE WHEN w.word IS NULL THEN NULL WHEN v.word IS NULL THEN '*UNK*' ELSE w.word END, ' ' ORDER BY p), '') AS text
       FROM documents d LEFT JOIN w ON d.doc_id = w.doc_id LEFT JOIN v ON w.word = v.word GROUP BY d.doc_id""",
)
def q_unkify(spark, sf_dir):
    d = _words(table(spark, sf_dir, "documents"))
    vocab = _words(table(spark, sf_dir, "benchmark").withColumnRenamed("item_id", "doc_id")).select(
        F.explode("words").alias("word")
    )
    return C.unkify(d, "doc_id", "words", vocab)


@register(
    "join_anti_completed",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)",
)
def q_anti(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    done = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return C.pending(c, done, ["c_custkey"])


def _bucket_values_sql(max_length):
    lo, hi = bucket_bounds(max_length)
    return "(VALUES " + ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(zip(lo, hi))) + ") b(bucket, lo, hi)"


@register(
    "join_range_bucket",
    f"""SELECT doc_id, min(bucket) AS bucket FROM documents LEFT JOIN {_bucket_values_sql(40000)}
        ON n_chars >= lo AND n_chars < hi GROUP BY doc_id""",
)
def q_range_bucket(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    lo, hi = bucket_bounds(40000)
    return C.assign_bucket(d, F.col("n_chars"), list(zip(lo, hi))).select("doc_id", "bucket")


@register(
    "join_asof_forward",
    """WITH c AS (SELECT row_number() OVER w - 1 AS pos, sum(l_quantity) OVER w AS y FROM lineitem
                  WINDOW w AS (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice ROWS UNBOUNDED PRECEDING)),
            g AS (SELECT range * 5000.0 AS x FROM range(0, (SELECT CAST(floor(max(y) / 5000) AS BIGINT) + 2 FROM c)))
       SELECT g.x, (SELECT min(pos) FROM c WHERE c.y >= g.x) AS pos FROM g""",
)
def q_asof(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    curve = running_sums(li, li.columns, {"y": F.col("l_quantity")}, index_name="pos", before={"y": "y_before"})
    total = li.agg(F.sum("l_quantity")).first()[0] or 0
    return C.asof_forward_grid(curve, "y", "y_before", int(total // 5000) + 2, 5000.0)


@register(
    "join_asof_forward_generic",
    """WITH c AS (SELECT row_number() OVER w - 1 AS pos, sum(l_quantity) OVER w AS y FROM lineitem
                  WINDOW w AS (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice ROWS UNBOUNDED PRECEDING)),
            g AS (SELECT DISTINCT o_totalprice * 3 AS x FROM orders)
       SELECT g.x, (SELECT min(pos) FROM c WHERE c.y >= g.x) AS pos FROM g""",
)
def q_asof_generic(spark, sf_dir):
    """The generic form: grid points are data (three times each order price)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    curve = running_sums(li, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"], {"y": F.col("l_quantity")}, index_name="pos")
    grid = table(spark, sf_dir, "orders").select((F.col("o_totalprice") * 3).alias("x")).distinct()
    return C.asof_forward(grid, curve, "x", "y")


# The beta grid crossed with every nation.
BETAS = [0.1, 0.2, 0.4]


@register(
    "join_cross_grid",
    """SELECT n_nationkey, beta, round(exp(-beta * n_nationkey), 6) AS value
       FROM nation, (VALUES (0.1), (0.2), (0.4)) g(beta)""",
)
def q_cross_grid(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select("n_nationkey")
    grid = spark.createDataFrame([(b,) for b in BETAS], "beta double")
    from tessera.operators.windows import cross_grid

    return cross_grid(n, grid).select(
        "n_nationkey", "beta", F.round(F.exp(-F.col("beta") * F.col("n_nationkey")), 6).alias("value")
    )


@register(
    "join_multi_model",
    f"""SELECT a.vec_id, a.pred AS model_0, b.pred AS model_1, c.pred AS model_2
        FROM {SQL_MODEL_PREDICTIONS} a JOIN {SQL_MODEL_PREDICTIONS} b ON a.vec_id = b.vec_id AND b.model = 1
        JOIN {SQL_MODEL_PREDICTIONS} c ON a.vec_id = c.vec_id AND c.model = 2 WHERE a.model = 0""",
)
def q_multi_model(spark, sf_dir):
    p = model_predictions(spark, sf_dir)
    parts = [p.filter(F.col("model") == m).select("vec_id", F.col("pred").alias(f"model_{m}")) for m in range(3)]
    return C.join_answers(parts, "vec_id")


@register(
    "join_baseline_diff",
    "WITH v AS (SELECT vec_id, ["
    + ", ".join(f"count(*) FILTER (WHERE pred = {i})" for i in range(10))
    + f"] AS votes FROM {SQL_MODEL_PREDICTIONS} GROUP BY vec_id), b AS (SELECT vec_id, ["
    + ", ".join(f"count(*) FILTER (WHERE pred = {i} AND model < 3)" for i in range(10))
    + f"""] AS votes FROM {SQL_MODEL_PREDICTIONS} GROUP BY vec_id)
       SELECT v.vec_id, list_transform(list_zip(v.votes, b.votes), lambda t: t[1] - t[2]) AS diff
       FROM v JOIN b ON v.vec_id = b.vec_id""",
)
def q_baseline_diff(spark, sf_dir):
    votes = model_votes(spark, sf_dir)
    p = model_predictions(spark, sf_dir).filter(F.col("model") < 3)
    base = p.groupBy("vec_id").agg(F.array(*[F.count_if(F.col("pred") == i) for i in range(10)]).alias("votes"))
    return C.baseline_diff(votes, base, "vec_id", "votes")

