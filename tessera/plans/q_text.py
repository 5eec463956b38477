"""Queries for the text aggregates (section D), text metrics and the corpus jobs (section J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import text as X
from tessera.plans.catalog import register
from tessera.session import table

WORDS = r"[\p{L}\p{N}]+"
_WORDS_SQL = "regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')"


def lower_words(col="text"):
    return F.regexp_extract_all(F.lower(F.col(col)), F.lit(WORDS), 0)


@register(
    "agg_word_total",
    "SELECT source, sum(len(string_split(text, ' '))) AS n_words FROM documents GROUP BY source",
)
def q_word_total(spark, sf_dir):
    return X.word_total(table(spark, sf_dir, "documents"), "source", "text")


_LINES_SQL = """
    WITH l AS (SELECT source, doc_id, unnest(string_split(text, chr(10))) AS line,
                      unnest(range(len(string_split(text, chr(10))))) AS ln FROM documents),
         s AS (SELECT source, sum(strlen(text) + 1) AS size FROM documents GROUP BY source),
         r AS (SELECT l.source, line, row_number() OVER (PARTITION BY l.source ORDER BY doc_id, ln) - 1 AS r,
                      CAST(floor(size / (2.0 * {limit})) AS BIGINT) AS k FROM l JOIN s USING (source)),
         t AS (SELECT source, r, regexp_replace(line, '^\\s+|\\s+$', '', 'g') AS line FROM r WHERE r % (k + 1) = k),
         u AS (SELECT line, coalesce(sum(length(line)) OVER (PARTITION BY source ORDER BY r
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used FROM t),
         tok AS (SELECT regexp_extract_all(line, '[\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+') AS runs FROM u WHERE {limit} - used >= 0)
    SELECT token, count(*) AS n FROM (
      SELECT unnest(list_filter(runs, lambda t, i: t <> ' ' OR i = 1 OR i = len(runs))) AS token FROM tok)
    GROUP BY token
"""


@register("agg_token_counts_limited", _LINES_SQL.format(limit=20000))
def q_token_counts_limited(spark, sf_dir):
    """The form with a budget of characters a source, spread evenly over its lines."""
    d = table(spark, sf_dir, "documents")
    lines = d.select("source", "doc_id", F.posexplode(F.split("text", "\n")).alias("ln", "line"))
    size = d.groupBy("source").agg(F.sum(F.octet_length("text") + 1).alias("size"))
    return X.token_counts(lines, "source", ["doc_id", "ln"], "line", 20000, size)


@register(
    "agg_token_counts",
    """SELECT token, count(*) AS n FROM (
         SELECT unnest(list_filter(runs, lambda t, i: t <> ' ' OR i = 1 OR i = len(runs))) AS token FROM (
           SELECT regexp_extract_all(regexp_replace(line, '^\\s+|\\s+$', '', 'g'), '[\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+') AS runs FROM (
             SELECT unnest(string_split(text, chr(10))) AS line FROM documents))) GROUP BY token""",
)
def q_token_counts(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select("source", "doc_id", F.posexplode(F.split("text", "\n")).alias("ln", "line"))
    return X.token_counts(lines, "source", ["doc_id", "ln"], "line")


@register(
    "agg_ngram_table",
    """WITH w AS (SELECT conv_id, turn, list_filter(string_split(text, ' '), lambda t: t <> '') AS w FROM conversations),
            g AS (SELECT conv_id, turn, o AS n_order, unnest(list_transform(range(1, greatest(len(w) - o + 2, 1)), lambda i: array_to_string(w[i:i + o - 1], ' '))) AS ngram
                  FROM w, range(1, 5) r(o))
       SELECT conv_id, turn, CAST(n_order AS INTEGER) AS "order", ngram, count(*) AS n FROM g GROUP BY ALL""",
)
def q_ngram_table(spark, sf_dir):
    """Counts of the n-grams of order 1 to 4 of every conversation turn."""
    c = table(spark, sf_dir, "conversations").select(F.struct("conv_id", "turn").alias("k"), F.filter(F.split("text", " "), lambda t: t != "").alias("w"))
    return X.ngram_counts(c, "k", "w", 4).select("k.conv_id", "k.turn", "order", "ngram", "n")


@register(
    "agg_vocab_sorted",
    f"SELECT word, row_number() OVER (ORDER BY word) - 1 AS id FROM (SELECT DISTINCT unnest({_WORDS_SQL}) AS word FROM documents)",
)
def q_vocab(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return X.vocab_sorted(d.select(F.explode(lower_words()).alias("word")))


@register(
    "agg_charset",
    """SELECT c AS char, row_number() OVER (ORDER BY c) - 1 AS idx FROM (
         SELECT DISTINCT unnest(string_split(text, '')) AS c FROM documents) WHERE c <> ''""",
)
def q_charset(spark, sf_dir):
    return X.charset(table(spark, sf_dir, "documents"), "text")


@register(
    "agg_char_rank",
    """SELECT c AS char, n, row_number() OVER (ORDER BY n DESC, c) AS idx FROM (
         SELECT c, count(*) AS n FROM (SELECT unnest(string_split(props, '')) AS c FROM events) WHERE c <> '' GROUP BY c)""",
)
def q_char_rank(spark, sf_dir):
    return X.char_rank(table(spark, sf_dir, "events"), "props")


@register(
    "agg_ngram_counts",
    f"""WITH w AS (SELECT doc_id, {_WORDS_SQL} AS t FROM documents),
            g AS (SELECT doc_id, o AS "order", unnest(list_transform(range(1, len(t) - o + 2), lambda i: array_to_string(t[i:i + o - 1], ' '))) AS ngram
                  FROM w, range(1, 5) r(o) WHERE len(t) >= o),
            c AS (SELECT doc_id, "order", ngram, count(*) AS n FROM g GROUP BY ALL)
       SELECT doc_id, CAST("order" AS INTEGER) AS "order", count(*) AS n_distinct, sum(n) AS n_total, max(n) AS max_count
       FROM c GROUP BY doc_id, "order\"""",
)
def q_ngram_counts(spark, sf_dir):
    """The n-gram count table of the documents, summarised by document and order; rows that share a
    ``doc_id`` are one document, whose n-grams are counted together."""
    d = table(spark, sf_dir, "documents").select("doc_id", lower_words().alias("t"))
    c = X.ngram_counts(d, "doc_id", "t", 4)
    return c.groupBy("doc_id", F.col("order").cast("int").alias("order")).agg(
        F.count(F.lit(1)).alias("n_distinct"), F.sum("n").alias("n_total"), F.max("n").alias("max_count")
    )


# ---------------------------------------------------------------------------- BLEU / ROUGE
def _pairs(spark, sf_dir, tok):
    """Reference = user turn, hypothesis = the following turn, lower-cased (uncased BLEU)."""
    c = table(spark, sf_dir, "conversations")
    a = c.filter(F.col("role") == "user").select("conv_id", "turn", F.lower("text").alias("ref"))
    b = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.lower("text").alias("hyp"))
    p = a.join(b, ["conv_id", "turn"])
    return p.select(F.concat_ws(":", "conv_id", "turn").alias("pair"), tok("ref").alias("ref"), tok("hyp").alias("hyp"))


_PAIRS_SQL = """(SELECT a.conv_id || ':' || a.turn AS pair, {tok_ref} AS ref, {tok_hyp} AS hyp
    FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 WHERE a.role = 'user')"""


def _bleu_tok_sql(x):
    s = f"regexp_replace(lower({x}), '([^\\p{{Nd}}])(\\p{{P}})', '\\1 \\2 ', 'g')"
    s = f"regexp_replace({s}, '(\\p{{P}})([^\\p{{Nd}}])', ' \\1 \\2', 'g')"
    s = f"regexp_replace({s}, '(\\p{{S}})', ' \\1 ', 'g')"
    return f"list_filter(regexp_split_to_array({s}, '\\s+'), lambda t: t <> '')"


_BLEU_PAIRS = _PAIRS_SQL.format(tok_ref=_bleu_tok_sql("a.text"), tok_hyp=_bleu_tok_sql("b.text"))


def _ngram_sql(col):
    return f"""SELECT pair, o AS ord, unnest(list_transform(range(1, len({col}) - o + 2), lambda i: array_to_string({col}[i:i + o - 1], ' '))) AS ngram
               FROM p, range(1, 5) r(o) WHERE len({col}) >= o"""


_BLEU_SQL = f"""
    WITH p AS {_BLEU_PAIRS},
         h AS (SELECT pair, ord, ngram, count(*) AS n_hyp FROM ({_ngram_sql('hyp')}) GROUP BY ALL),
         r AS (SELECT pair, ord, ngram, count(*) AS n_ref FROM ({_ngram_sql('ref')}) GROUP BY ALL),
         m AS (SELECT h.ord, sum(least(coalesce(n_ref, 0), n_hyp)) AS matches, sum(n_hyp) AS possible
               FROM h LEFT JOIN r USING (pair, ord, ngram) GROUP BY h.ord),
         o AS (SELECT g.ord, coalesce(matches, 0) AS matches, coalesce(possible, 0) AS possible
               FROM range(1, 5) g(ord) LEFT JOIN m USING (ord)),
         pr AS (SELECT ord, matches, possible,
                       CASE WHEN possible <= 0 THEN 0.0 WHEN matches > 0 THEN matches / possible
                            ELSE 1.0 / (power(2.0, count(*) FILTER (WHERE matches = 0 AND possible > 0)
                                        OVER (ORDER BY ord ROWS UNBOUNDED PRECEDING)) * possible) END AS prec FROM o),
         lens AS (SELECT sum(len(ref)) AS ref_len, sum(len(hyp)) AS hyp_len FROM p),
         agg AS (SELECT CASE WHEN max(prec) > 0 THEN exp(sum(CASE WHEN prec > 0 THEN ln(prec) ELSE 0 END) / 4) ELSE 0 END AS geo,
                        list(matches ORDER BY ord) AS matches, list(possible ORDER BY ord) AS possible FROM pr)
    SELECT round(geo * CASE WHEN hyp_len / ref_len < 1 THEN exp(1 - 1 / (hyp_len / ref_len)) ELSE 1 END * 100, 6) AS bleu,
           matches, possible, ref_len, hyp_len FROM agg, lens
"""


@register("agg_corpus_bleu", _BLEU_SQL)
def q_bleu(spark, sf_dir):
    p = _pairs(spark, sf_dir, X.bleu_tokenize)
    b = X.bleu(p, "pair", "ref", "hyp", 4)
    return b.select(F.round(F.col("bleu") * 100, 6).alias("bleu"), "matches", "possible", "ref_len", "hyp_len")


def _ws_sql(x):
    return f"list_filter(regexp_split_to_array(lower({x}), '\\s+'), lambda t: t <> '')"


@register(
    "agg_rouge_n",
    f"""WITH p AS {_PAIRS_SQL.format(tok_ref=_ws_sql('a.text'), tok_hyp=_ws_sql('b.text'))},
            s AS (SELECT list_distinct(list_transform(range(1, len(hyp)), lambda i: array_to_string(hyp[i:i + 1], ' '))) AS e,
                         list_distinct(list_transform(range(1, len(ref)), lambda i: array_to_string(ref[i:i + 1], ' '))) AS r FROM p),
            f AS (SELECT len(list_intersect(e, r)) AS ov, len(e) AS ne, len(r) AS nr FROM s),
            g AS (SELECT CASE WHEN ne = 0 THEN 0.0 ELSE ov / ne END AS pp, CASE WHEN nr = 0 THEN 0.0 ELSE ov / nr END AS rr FROM f)
       SELECT round(avg(2.0 * (pp * rr) / (pp + rr + 1e-8)), 6) AS rouge_n FROM g""",
)
def q_rouge_n(spark, sf_dir):
    p = _pairs(spark, sf_dir, X.ws_words)
    return X.rouge_n(p, "hyp", "ref", 2).select(F.round("rouge_n", 6).alias("rouge_n"))


# The table of lengths, a row for each word of the hypothesis: a length is the largest so far of the
# one above it and, where the words agree, the one above to the left plus one.
_LCS_SQL = f"""
    WITH RECURSIVE p AS {_PAIRS_SQL.format(tok_ref=_ws_sql('a.text'), tok_hyp=_ws_sql('b.text'))},
         t(pair, i, lens) AS (
           SELECT pair, 0, list_transform(ref, lambda x: 0) FROM p
           UNION ALL
           SELECT t.pair, t.i + 1, list_transform(range(1, len(ref) + 1), lambda j: list_max(list_transform(range(1, j + 1), lambda k:
                    greatest(lens[k], CASE WHEN ref[k] = hyp[t.i + 1] THEN coalesce(lens[k - 1], 0) + 1 ELSE 0 END))))
           FROM t JOIN p USING (pair) WHERE t.i < len(hyp)),
         l AS (SELECT p.pair, coalesce(lens[len(ref)], 0)::DOUBLE AS lcs, len(ref)::DOUBLE AS m, len(hyp)::DOUBLE AS n FROM t JOIN p USING (pair) WHERE t.i = len(hyp)),
         f AS (SELECT CASE WHEN m > 0 THEN lcs / m END AS r, CASE WHEN n > 0 THEN lcs / n END AS q FROM l),
         b AS (SELECT r, q, q / (r + 1e-12) AS beta FROM f)
    SELECT round(avg((1 + beta * beta) * r * q / (r + beta * beta * q + 1e-12)), 6) AS rouge_l FROM b"""


@register("agg_rouge_l", _LCS_SQL)
def q_rouge_l(spark, sf_dir):
    p = _pairs(spark, sf_dir, X.ws_words)
    return X.rouge_l(p, "hyp", "ref").select(F.round("rouge_l", 6).alias("rouge_l"))


# ---------------------------------------------------------------------------- corpus jobs
@register(
    "txt_length_batches",
    f"""WITH RECURSIVE d AS (SELECT doc_id, len({_WORDS_SQL}) AS n FROM documents),
            m AS (SELECT max(n) AS mx FROM d),
            g(x) AS (SELECT {X.MIN_BOUNDARY}::BIGINT UNION ALL
                     SELECT greatest(x + 1, CAST(floor(x::DOUBLE * {X.BOUNDARY_SCALE}::DOUBLE) AS BIGINT)) FROM g, m WHERE x < mx),
            e AS (SELECT 0 AS lo UNION SELECT x FROM g, m WHERE x < mx),
            o AS (SELECT CAST(row_number() OVER (ORDER BY lo) - 1 AS INTEGER) AS bucket, lo, coalesce(lead(lo) OVER (ORDER BY lo), mx + 1) AS hi FROM e, m),
            b AS (SELECT doc_id, n, bucket, greatest(1, CAST(floor(4096 / hi) AS BIGINT)) AS bs FROM d JOIN o ON n >= lo AND n < hi),
            r AS (SELECT doc_id, n, bucket, CAST(floor((row_number() OVER (PARTITION BY bucket ORDER BY doc_id) - 1) / bs) AS BIGINT) AS batch FROM b)
       SELECT doc_id, bucket, batch, max(n) OVER (PARTITION BY bucket, batch) AS pad_to FROM r""",
)
def q_length_batches(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.size(lower_words()).alias("n"))
    b = X.length_batches(d, "doc_id", F.col("n"), 4096)
    return b.select("doc_id", "bucket", "batch", "pad_to")


@register(
    "txt_log_encode",
    """WITH c AS (SELECT c, row_number() OVER (ORDER BY n DESC, c) AS idx FROM (
                   SELECT c, count(*) AS n FROM (SELECT unnest(string_split(props, '')) AS c FROM events) WHERE c <> '' GROUP BY c)),
            e AS (SELECT event_id, unnest(string_split(props, '')) AS c, unnest(range(length(props))) AS p FROM events),
            ids AS (SELECT event_id, list(idx ORDER BY p) AS ids FROM e JOIN c USING (c) GROUP BY event_id)
       SELECT event_id, list_slice(list_concat(list_transform(range(1024), lambda x: 0), ids), len(ids) + 1, len(ids) + 1024) AS ids FROM ids""",
)
def q_log_encode(spark, sf_dir):
    """Request text to fixed-length character ids: trained character index (falling frequency),
    encode, pad / cut on the left to 1024."""
    from tessera.functions.arrays import pad_left
    from tessera.operators.joins import encode_words

    ev = table(spark, sf_dir, "events")
    idx = X.char_rank(ev, "props").select(F.col("char").alias("word"), F.col("idx").alias("id"))
    chars = ev.select("event_id", F.filter(F.split("props", ""), lambda c: c != "").alias("chars"))
    enc = encode_words(chars, "event_id", "chars", idx)
    return enc.select("event_id", pad_left("ids", 1024).alias("ids"))


# The fields of a request, and those that are pruned from it.
REQUEST = "event_id long, time string, method string, query struct<k:int,user:long>, source struct<ip:string,port:int>, status int"
PRUNED = ["time", "source", "query.user"]

_REQUEST_SQL = """'{"event_id":' || event_id || ',"method":"' || event_type || '","query":{"k":' || CAST(json_extract_string(props, '$.k') AS INTEGER)
                  || '},"status":' || (200 + user_id % 5) || '}'"""


@register(
    "txt_log_encode_pruned",
    f"""WITH q AS (SELECT event_id, {_REQUEST_SQL} AS t FROM events),
            e AS (SELECT event_id, unnest(string_split(t, '')) AS c, unnest(range(length(t))) AS p FROM q),
            c AS (SELECT c, row_number() OVER (ORDER BY count(*) DESC, c) AS idx FROM e WHERE c <> '' GROUP BY c),
            ids AS (SELECT event_id, list(idx ORDER BY p) AS ids FROM e JOIN c USING (c) GROUP BY event_id)
       SELECT event_id, list_slice(list_concat(list_transform(range(96), lambda x: 0), ids), len(ids) + 1, len(ids) + 96) AS ids FROM ids""",
)
def q_log_encode_pruned(spark, sf_dir):
    """Requests of the events as one job: prune fields of the JSON, train the character index on what is
    left, encode, pad and cut on the left to 96."""
    from tessera.functions.arrays import pad_left
    from tessera.functions.scalars import prune_json
    from tessera.operators.joins import encode_words

    ev = table(spark, sf_dir, "events")
    whole = F.to_json(F.struct(
        "event_id", F.col("ts").cast("string").alias("time"), F.col("event_type").alias("method"),
        F.struct(F.get_json_object("props", "$.k").cast("int").alias("k"), F.col("user_id").alias("user")).alias("query"),
        F.struct(F.concat(F.lit("10.0.0."), F.col("user_id") % 250).alias("ip"), (F.col("user_id") % 60000).cast("int").alias("port")).alias("source"),
        (F.lit(200) + F.col("user_id") % 5).cast("int").alias("status"),
    ))
    pruned = ev.select("event_id", prune_json(whole, REQUEST, PRUNED).alias("request"))
    idx = X.char_rank(pruned, "request").select(F.col("char").alias("word"), F.col("idx").alias("id"))
    chars = pruned.select("event_id", F.filter(F.split("request", ""), lambda c: c != "").alias("chars"))
    return encode_words(chars, "event_id", "chars", idx).select("event_id", pad_left("ids", 96).alias("ids"))


@register(
    "txt_repetition_sample",
    """WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(replace(replace(text, chr(10), ' *BREAK* '), '  ', ' ')), '\\s+'), lambda t: t <> '') AS w FROM documents),
            p AS (SELECT doc_id, w, list_position(w, '*break*') AS p FROM w),
            t AS (SELECT doc_id, w[p:] AS tail FROM p WHERE p > 0),
            f AS (SELECT doc_id, tail, list_position(list_transform(tail, lambda x: x <> '*break*'), true) AS fr FROM t)
       SELECT doc_id, replace(array_to_string(CASE WHEN fr > 0 THEN tail[fr:] ELSE [] END, ' '), '*break*', chr(10)) AS sample FROM f""",
)
def q_repetition_sample(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    s = d.select("doc_id", X.trim_sample(F.lower(X.mark_breaks("text"))).alias("sample"))
    return s.filter(F.col("sample").isNotNull())


# ---------------------------------------------------------------------------- subword vocabularies
def _turn_token_counts(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return c.select(F.explode(X.alnum_tokens("text")).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


#: Vocabularies that this application has trained, by their input.
_trained: dict[tuple, object] = {}


def _turn_vocab(spark, sf_dir, min_count=20):
    """The vocabulary of the turns; trained once an application, its table lies in the shared folder."""
    from tessera.operators import subword as SW

    key = (spark.sparkContext.applicationId, sf_dir, min_count)
    if key not in _trained:
        _trained[key] = SW.subword_vocab(_turn_token_counts(spark, sf_dir), min_count)
    return _trained[key]


@register("txt_subword_train")
def q_subword_train(spark, sf_dir):
    """Subword vocabulary learnt from the conversation turns (minimum count 20)."""
    return _turn_vocab(spark, sf_dir)


@register("txt_subword_search")
def q_subword_search(spark, sf_dir):
    """Minimum count searched in 1..1000 for a vocabulary of about 400 subtokens (threshold 50)."""
    from tessera.operators import subword as SW

    return SW.subword_search(_turn_token_counts(spark, sf_dir), 400, 50, 1, 1000)


@register("txt_subword_encode")
def q_subword_encode(spark, sf_dir):
    from tessera.operators import subword as SW

    c = table(spark, sf_dir, "conversations").select(F.concat_ws(":", "conv_id", "turn").alias("key"), "text")
    return SW.subword_encode(c, "key", "text", _turn_vocab(spark, sf_dir), add_eos=True)


@register("txt_subword_decode", "SELECT conv_id || ':' || turn AS key, text AS text_back, true AS same FROM conversations")
def q_subword_decode(spark, sf_dir):
    """Encode then decode every turn; ``same`` tells whether the text came back unchanged."""
    from tessera.operators import subword as SW

    voc = _turn_vocab(spark, sf_dir)
    c = table(spark, sf_dir, "conversations").select(F.concat_ws(":", "conv_id", "turn").alias("key"), "text")
    enc = SW.subword_encode(c, "key", "text", voc)
    dec = SW.subword_decode(enc, "key", "ids", voc, "text_back")
    return dec.join(c, "key").select("key", "text_back", (F.col("text_back") == F.col("text")).alias("same"))


@register("txt_prepare_pairs")
def q_prepare_pairs(spark, sf_dir):
    """Pair each user turn with the reply, encode both with the end id, assign 4 round-robin shards
    and a seeded shuffle key."""
    from tessera.operators import subword as SW
    from tessera.operators.joins import pair_turns
    from tessera.operators.indexing import with_row_index

    voc = _turn_vocab(spark, sf_dir)
    p = pair_turns(table(spark, sf_dir, "conversations")).withColumn("key", F.concat_ws(":", "conv_id", "turn"))
    src = SW.subword_encode(p.select("key", "source"), "key", "source", voc, add_eos=True).withColumnRenamed("ids", "src_ids")
    tgt = SW.subword_encode(p.select("key", "target"), "key", "target", voc, add_eos=True).withColumnRenamed("ids", "tgt_ids")
    j = src.join(tgt, "key")
    sh = with_row_index(j, ["key"], "_i").withColumn("shard", (F.col("_i") % 4).cast("int")).drop("_i")
    return sh.withColumn("shuffle_key", F.xxhash64("key", F.lit(5))).orderBy("shard", "shuffle_key")
