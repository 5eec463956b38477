"""Queries for section I (string, JSON, HTML, math, array and map functions)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import arrays as A
from tessera.functions import html as H
from tessera.functions import scalars as S
from tessera.operators import text as X
from tessera.plans.catalog import register
from tessera.plans.derived import SQL_EVENT_ITEMS, event_items
from tessera.session import table

_ALNUM_SQL = "regexp_extract_all(text, '[\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+')"
_FILTER_RUNS = "list_filter(runs, lambda t, i: t <> ' ' OR i = 1 OR i = len(runs))"


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


@register(
    "str_bleu_tokenize",
    """SELECT doc_id, list_filter(regexp_split_to_array(regexp_replace(regexp_replace(regexp_replace(text,
              '([^\\p{Nd}])(\\p{P})', '\\1 \\2 ', 'g'), '(\\p{P})([^\\p{Nd}])', ' \\1 \\2', 'g'), '(\\p{S})', ' \\1 ', 'g'), '\\s+'),
              lambda t: t <> '') AS tokens FROM documents""",
)
def q_bleu_tok(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", X.bleu_tokenize("text").alias("tokens"))


@register("str_alnum_split", f"SELECT doc_id, {_FILTER_RUNS} AS tokens FROM (SELECT doc_id, {_ALNUM_SQL} AS runs FROM documents)")
def q_alnum(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", X.alnum_tokens("text").alias("tokens"))


@register(
    "str_join_tokens",
    f"""SELECT doc_id, array_to_string(list_transform(t, lambda x, i: CASE WHEN i > 1 AND regexp_matches(t[i - 1], '^[\\p{{L}}\\p{{N}}]')
               AND regexp_matches(x, '^[\\p{{L}}\\p{{N}}]') THEN ' ' || x ELSE x END), '') AS joined
        FROM (SELECT doc_id, {_FILTER_RUNS} AS t FROM (SELECT doc_id, {_ALNUM_SQL} AS runs FROM documents))""",
)
def q_join_tokens(spark, sf_dir):
    d = _docs(spark, sf_dir).select("doc_id", X.alnum_tokens("text").alias("t"))
    return d.select("doc_id", X.join_tokens("t").alias("joined"))


@register(
    "str_escape_token",
    """WITH a AS (SELECT list_distinct(flatten(list(string_split(text, '')))) || string_split('\\_u;0123456789', '') AS alphabet
                  FROM documents),
            t AS (SELECT DISTINCT unnest(list_filter(runs, lambda t, i: t <> ' ' OR i = 1 OR i = len(runs))) AS token
                  FROM (SELECT regexp_extract_all(html, '[\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+') AS runs FROM pages))
       SELECT token, array_to_string(list_transform(string_split(replace(replace(token, '\\', '\\\\'), '_', '\\u'), ''),
                lambda c: CASE WHEN list_contains(alphabet, c) AND c <> chr(10) THEN c ELSE '\\' || unicode(c) || ';' END), '') || '_' AS escaped
       FROM t, a""",
)
def q_escape(spark, sf_dir):
    """Escape the tokens of the web pages against the alphabet of all documents."""
    alphabet = _docs(spark, sf_dir).select(F.explode(F.split("text", "")).alias("c")).agg(
        F.array_union(F.collect_set("c"), F.split(F.lit(X.ESCAPE_CHARS), "")).alias("alphabet")
    )
    toks = table(spark, sf_dir, "pages").select(F.explode(X.alnum_tokens("html")).alias("token")).distinct()
    # the alphabet is one row of distinct characters (bounded by the character set)
    return toks.crossJoin(F.broadcast(alphabet)).select("token", X.escape_token("token", F.col("alphabet")).alias("escaped"))


_CLEAN_WORD_SQL = """CASE WHEN starts_with({w}, '{o}') AND NOT ends_with({w}, '{c}') THEN {w}[2:]
                          WHEN ends_with({w}, '{c}') AND NOT starts_with({w}, '{o}') THEN {w}[:-2] ELSE {w} END"""


@register(
    "str_clean_lyrics",
    "SELECT doc_id, array_to_string(list_transform(list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda t: t <> ''), lambda w: "
    + _CLEAN_WORD_SQL.format(w="(" + _CLEAN_WORD_SQL.format(w="w", o='"', c='"') + ")", o="(", c=")")
    + "), ' ') AS cleaned FROM documents",
)
def q_clean(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", X.clean_text("text").alias("cleaned"))


@register(
    "str_break_markers",
    "SELECT doc_id, replace(replace(text, chr(10), ' *BREAK* '), '  ', ' ') AS marked FROM documents",
)
def q_breaks(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", X.mark_breaks("text").alias("marked"))


@register("str_slug", "SELECT p_partkey, replace(replace(lower(p_name), '/', ' '), ' ', '_') AS slug FROM part")
def q_slug(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", X.slug("p_name").alias("slug"))


@register(
    "str_url_form",
    """SELECT page_id, substring(list_filter(string_split(url_decode(regexp_extract(url, '\\?([^#]*)', 1)), '&'),
              lambda kv: starts_with(kv, 'page='))[1], 6) AS page FROM pages""",
)
def q_url_form(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", S.form_field("url", "page").alias("page"))


@register(
    "str_basename_percent",
    "SELECT page_id, string_split(url, '/')[-1] AS name, printf('%.2f%%', (page_id % 100) / 100.0 * 100.0) AS prob FROM pages",
)
def q_basename(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", S.basename("url").alias("name"), S.percent((F.col("page_id") % 100) / 100.0).alias("prob"))


@register(
    "json_prune_fields",
    """SELECT event_id, to_json({'id': event_id, 'k': CAST(json_extract_string(props, '$.k') AS BIGINT)}) AS pruned FROM events""",
)
def q_prune(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    req = ev.select(
        "event_id",
        F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type"),
                           F.get_json_object("props", "$.k").cast("long").alias("k"))).alias("request"),
    )
    return req.select("event_id", S.prune_json("request", "id bigint, type string, k bigint", ["type"]).alias("pruned"))


@register("json_nested_get", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def q_json_get(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", S.json_get("props", "$.k").alias("k"))


@register(
    "json_response",
    """SELECT vec_id, to_json({'label': label, 'classes': [CAST(label AS BIGINT), CAST((label + 1) % 10 AS BIGINT)]}) AS response FROM embeddings""",
)
def q_response(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        "vec_id",
        F.to_json(F.struct(F.col("label"), F.array(F.col("label").cast("long"), ((F.col("label") + 1) % 10).cast("long")).alias("classes"))).alias("response"),
    )


@register(
    "html_links",
    """SELECT page_id, unnest(list_filter(regexp_extract_all(html, '<a href="([^"]*)"', 1), lambda x: regexp_matches(x, '^/[a-z]'))) AS link FROM pages""",
)
def q_links(spark, sf_dir):
    return H.extract_links(table(spark, sf_dir, "pages").select("page_id", "html"), "html", "^/[a-z]")


@register(
    "html_links_attributes",
    """SELECT page_id, unnest(['/lyrics/p' || page_id || '.html', '/lyrics/q?a=' || page_id || '&b=2', '/lyrics/r' || page_id || '.html']) AS link FROM pages""",
)
def q_links_attributes(spark, sf_dir):
    """Links of class ``song`` that open in a new window and lead to a lyrics page, found among variants
    added to every page: attributes in any order, either quotes or none, look-alikes in other values,
    comments and scripts."""
    n = F.col("page_id").cast("string")
    planted = F.concat(
        F.col("html"),
        F.lit("<A TARGET='_blank' data-x='href=\"/lyrics/no1.html\" >' Class=\"new song\" HREF=/lyrics/p"), n, F.lit(".html>x</A>"),
        F.lit('<a class="song" target="_blank" href="/lyrics/q?a='), n, F.lit('&amp;b=2">y</a>'),
        F.lit("<a\nhref = '/lyrics/r"), n, F.lit(".html'\ttarget=_blank class=song>z</a>"),
        F.lit('<a class="songs" target="_blank" href="/lyrics/no2.html">n</a><a class="song" href="/lyrics/no3.html">n</a>'),
        F.lit('<a class="song" target="_top" href="/lyrics/no4.html">n</a><a class="song" target="_blank" href="/other/no5.html">n</a>'),
        F.lit('<!-- <a class="song" target="_blank" href="/lyrics/no6.html">n</a> --><script>"<a class=song target=_blank href=/lyrics/no7.html>"</script>'),
    )
    pages = table(spark, sf_dir, "pages").select("page_id", planted.alias("html"))
    return H.extract_links(pages, "html", "lyrics/", css_class="song", target="_blank")


_SHOWN_SQL = "regexp_replace(html, '(?s)<!--.*?-->|<script>.*?</script>|<style>.*?</style>', ' ', 'g')"


def _plain_sql(x):
    for ref, char in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        x = f"replace({x}, '&{ref};', '{char}')"
    return x


@register(
    "html_title_text",
    f"""WITH p AS (SELECT page_id, {_SHOWN_SQL} AS h FROM pages),
            b AS (SELECT page_id, trim(regexp_extract(h, '(?s)<title>(.*?)</title>', 1)) AS title,
                         list_filter(list_transform(regexp_split_to_array(regexp_replace(h, '(?s)<head>.*?</head>', ' '), '<[^>]*>'),
                                     lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '') AS pieces FROM p),
            t AS (SELECT page_id, {_plain_sql('title')} AS title, {_plain_sql("array_to_string(pieces, ' ')")} AS text FROM b)
       SELECT page_id, title, text FROM t WHERE length(text) > 10""",
)
def q_page_text(spark, sf_dir):
    return H.page_text(table(spark, sf_dir, "pages").select("page_id", "html"), "html")


# Mean and standard deviation of the two affinities (cat: 0.1, 0.20; dog: 0.3, 0.40).
CAT = (0.1, 0.20)
DOG = (0.3, 0.40)


@register(
    "math_zscore_class",
    f"""WITH a AS (SELECT user_id, coalesce(sum(CASE WHEN list_contains(tags, 'click') THEN weight * user_score END), 0.0) AS a_cat,
                          coalesce(sum(CASE WHEN list_contains(tags, 'purchase') THEN weight * user_score END), 0.0) AS a_dog
                   FROM {SQL_EVENT_ITEMS} GROUP BY user_id),
            z AS (SELECT user_id, (a_cat - 0.1) / 0.2 AS z_cat, (a_dog - 0.3) / 0.4 AS z_dog FROM a)
       SELECT user_id, round(z_cat, 6) AS z_cat, round(z_dog, 6) AS z_dog,
              CASE WHEN abs(z_cat) > abs(z_dog) AND z_cat >= 0 THEN 'cat_lover' WHEN abs(z_cat) > abs(z_dog) THEN 'cat_hater'
                   WHEN z_dog >= 0 THEN 'dog_lover' ELSE 'dog_hater' END AS affinity_class FROM z""",
)
def q_zscore(spark, sf_dir):
    it = event_items(spark, sf_dir)
    a = it.groupBy("user_id").agg(
        F.coalesce(F.sum(F.when(F.array_contains("tags", "click"), F.col("weight") * F.col("user_score"))), F.lit(0.0)).alias("a_cat"),
        F.coalesce(F.sum(F.when(F.array_contains("tags", "purchase"), F.col("weight") * F.col("user_score"))), F.lit(0.0)).alias("a_dog"),
    )
    z_cat, z_dog, cls = S.zscore_class(F.col("a_cat"), F.col("a_dog"), CAT, DOG)
    return a.select("user_id", F.round(z_cat, 6).alias("z_cat"), F.round(z_dog, 6).alias("z_dog"), cls.alias("affinity_class"))


@register(
    "math_minmax_scale",
    """SELECT o_orderkey, round(CASE WHEN mx = mn THEN -1.0 ELSE (o_totalprice - mn) / (mx - mn) * 2.0 - 1.0 END, 6) AS scaled
       FROM orders, (SELECT min(o_totalprice) AS mn, max(o_totalprice) AS mx FROM orders)""",
)
def q_minmax(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return S.minmax(o, "o_totalprice", -1.0, 1.0, "scaled").select("o_orderkey", F.round("scaled", 6).alias("scaled"))


def _rv(c):
    return F.transform(c, lambda x: F.round(x, 6))


@register(
    "math_pixel_scale",
    """SELECT vec_id, list_transform(embedding, lambda x: round(x::DOUBLE / 255.0, 6) + 0.0) AS unit,
              list_transform(embedding, lambda x: round(x::DOUBLE / 127.5 - 1.0, 6) + 0.0) AS signed FROM embeddings""",
)
def q_pixel(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", _rv(A.scale_vec("embedding", "unit")).alias("unit"), _rv(A.scale_vec("embedding", "signed")).alias("signed"))


@register(
    "math_row_whiten",
    """WITH s AS (SELECT vec_id, embedding, list_sum(list_transform(embedding, lambda x: x::DOUBLE)) / len(embedding) AS m, len(embedding) AS n FROM embeddings),
            v AS (SELECT vec_id, embedding, m, greatest(sqrt(list_sum(list_transform(embedding, lambda x: (x::DOUBLE - m) * (x::DOUBLE - m))) / n), 1.0 / sqrt(n)) AS adj FROM s)
       SELECT vec_id, list_transform(embedding, lambda x: round((x::DOUBLE - m) / adj, 6)) AS whitened FROM v""",
)
def q_whiten(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", _rv(A.whiten("embedding")).alias("whitened"))


@register(
    "math_softmax_temperature",
    """WITH e AS (SELECT vec_id, list_transform(embedding, lambda p: exp(ln(abs(p::DOUBLE) + 0.01) / 0.5)) AS e FROM embeddings)
       SELECT vec_id, list_transform(e, lambda x: round(x / list_sum(e), 6)) AS probs FROM e""",
)
def q_softmax(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x: F.abs(x.cast("double")) + 0.01).alias("p"))
    return e.select("vec_id", _rv(A.softmax_t("p", 0.5)).alias("probs"))


@register(
    "math_softmax_draw",
    """WITH e AS (SELECT vec_id, list_transform(embedding, lambda p: exp(ln(abs(p::DOUBLE) + 0.01) / 0.5)) AS e FROM embeddings),
            s AS (SELECT vec_id, list_transform(e, lambda x: x / list_sum(e)) AS p, CAST(('0x' || md5(vec_id || ':11')[1:8]) AS BIGINT) / 4294967296.0 AS u FROM e),
            x AS (SELECT vec_id, p, u, unnest(range(1, len(p) + 1)) AS i FROM s),
            r AS (SELECT vec_id, i, u, sum(p[i]) OVER (PARTITION BY vec_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS c FROM x)
       SELECT vec_id, CAST(coalesce(min(i) FILTER (WHERE c > u), max(i)) - 1 AS INTEGER) AS drawn FROM r GROUP BY vec_id""",
)
def q_softmax_draw(spark, sf_dir):
    """One draw for each row from the tempered distribution, by a uniform value hashed from its id."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x: F.abs(x.cast("double")) + 0.01).alias("p"))
    probs = e.select("vec_id", A.softmax_t("p", 0.5).alias("p"))
    return probs.select("vec_id", A.draw_index("p", A.uniform_md5(F.col("vec_id"), seed=11)).cast("int").alias("drawn"))


@register(
    "math_length_norm",
    """SELECT doc_id, round((-(n_chars / 100.0)) / power((5.0 + len(string_split(text, ' '))) / 6.0, 0.6), 6) AS normed FROM documents""",
)
def q_length_norm(spark, sf_dir):
    d = _docs(spark, sf_dir)
    return d.select("doc_id", F.round(A.length_norm(-(F.col("n_chars") / 100.0), F.size(F.split("text", " ")), 0.6), 6).alias("normed"))


# An example coefficient table for the part score (intercept, numeric and category terms).
PART_INTERCEPT = 12.5
PART_NUMERIC = {"p_size": 0.75, "p_retailprice": 0.01}
PART_CATEGORY = {("p_type", "ECONOMY"): -3.0, ("p_type", "PROMO"): 2.0, ("p_type", "LARGE"): 4.5,
                 ("p_brand", "Brand#1"): 1.25, ("p_brand", "Brand#2"): -0.5}


@register(
    "math_linear_score",
    """SELECT p_partkey, round(12.5 + coalesce(p_size, 0) * 0.75 + coalesce(p_retailprice, 0) * 0.01
              + coalesce(c1.w, 0.0) + coalesce(c2.w, 0.0), 6) AS score FROM part
       LEFT JOIN (VALUES ('ECONOMY', -3.0), ('PROMO', 2.0), ('LARGE', 4.5)) c1(v, w) ON p_type = c1.v
       LEFT JOIN (VALUES ('Brand#1', 1.25), ('Brand#2', -0.5)) c2(v, w) ON p_brand = c2.v""",
)
def q_linear_score(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    s = S.linear_score(p, "p_partkey", PART_NUMERIC, PART_CATEGORY, PART_INTERCEPT)
    return s.select("p_partkey", F.round("score", 6).alias("score"))


@register("math_hash_bucket")
def q_hash_bucket(spark, sf_dir):
    """Category to one of 100 buckets (Spark's hash; no SQL twin)."""
    return table(spark, sf_dir, "customer").select("c_custkey", S.hash_bucket("c_name", 100).alias("bucket"))


@register(
    "math_md5_seed",
    """SELECT p_partkey, CAST((CAST(('0x' || md5(p_name)[1:8]) AS BIGINT) + CAST(('0x' || md5(p_name)[9:16]) AS BIGINT)
              + CAST(('0x' || md5(p_name)[17:24]) AS BIGINT) + CAST(('0x' || md5(p_name)[25:32]) AS BIGINT)) % 4294967295 AS BIGINT) AS seed
       FROM part""",
)
def q_md5(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", S.name_seed("p_name").alias("seed"))


_WLEN_SQL = "list_transform(string_split(text, ' '), lambda w: CAST(length(w) AS BIGINT))"


@register(
    "arr_pad_left",
    f"""SELECT doc_id, list_slice(list_concat(list_transform(range(16), lambda x: CAST(0 AS BIGINT)), l), len(l) + 1, len(l) + 16) AS padded
        FROM (SELECT doc_id, {_WLEN_SQL} AS l FROM documents)""",
)
def q_pad_left(spark, sf_dir):
    d = _docs(spark, sf_dir).select("doc_id", F.transform(F.split("text", " "), lambda w: F.length(w).cast("long")).alias("l"))
    return d.select("doc_id", A.pad_left("l", 16).alias("padded"))


@register(
    "arr_pad_right_same",
    f"""SELECT conv_id, turn, list_concat(a, list_transform(range(greatest(len(a), len(b)) - len(a)), lambda x: CAST(0 AS BIGINT))) AS src,
               list_concat(b, list_transform(range(greatest(len(a), len(b)) - len(b)), lambda x: CAST(0 AS BIGINT))) AS tgt
        FROM (SELECT x.conv_id, x.turn, list_transform(string_split(x.text, ' '), lambda w: CAST(length(w) AS BIGINT)) AS a,
                     list_transform(string_split(y.text, ' '), lambda w: CAST(length(w) AS BIGINT)) AS b
              FROM conversations x JOIN conversations y ON x.conv_id = y.conv_id AND y.turn = x.turn + 1)""",
)
def q_pad_pair(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    wl = lambda col: F.transform(F.split(col, " "), lambda w: F.length(w).cast("long"))
    a = c.select("conv_id", "turn", wl("text").alias("a"))
    b = c.select("conv_id", (F.col("turn") - 1).alias("turn"), wl("text").alias("b"))
    j = a.join(b, ["conv_id", "turn"])
    src, tgt = A.pad_pair("a", "b")
    return j.select("conv_id", "turn", src.alias("src"), tgt.alias("tgt"))


@register(
    "arr_trim_eos",
    f"""SELECT conv_id, turn, CASE WHEN list_position(l, 1) > 0 THEN l[1:list_position(l, 1) - 1] ELSE l END AS trimmed
        FROM (SELECT conv_id, turn, {_WLEN_SQL} AS l FROM conversations)""",
)
def q_trim_eos(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.transform(F.split("text", " "), lambda w: F.length(w).cast("long")).alias("l")
    )
    return c.select("conv_id", "turn", A.trim_eos("l", 1).alias("trimmed"))


@register(
    "arr_one_hot",
    "SELECT vec_id, list_transform(range(10), lambda i: CAST(i = label AS INTEGER)) AS one_hot FROM embeddings",
)
def q_one_hot(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", A.one_hot("label", 10).alias("one_hot"))


@register(
    "arr_bbox_zip",
    """SELECT vec_id, i, round(embedding[i]::DOUBLE, 6) AS ymin, round(embedding[i + 4]::DOUBLE, 6) AS xmin,
              round(embedding[i + 8]::DOUBLE, 6) AS ymax, round(embedding[i + 12]::DOUBLE, 6) AS xmax
       FROM embeddings, range(1, 5) r(i)""",
)
def q_bbox(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    z = e.select(
        "vec_id",
        A.zip_boxes(F.slice("embedding", 1, 4), F.slice("embedding", 5, 4), F.slice("embedding", 9, 4), F.slice("embedding", 13, 4)).alias("boxes"),
    )
    b = z.select("vec_id", F.posexplode("boxes").alias("i", "b"))
    return b.select(
        "vec_id", (F.col("i") + 1).cast("long").alias("i"),
        *[F.round(F.col("b")[k].cast("double"), 6).alias(k) for k in ("ymin", "xmin", "ymax", "xmax")],
    )


@register(
    "map_route_weights",
    """WITH c AS (SELECT user_id, event_type, CAST(floor(count(*) * 100 / sum(count(*)) OVER (PARTITION BY user_id)) AS BIGINT) AS w
                  FROM events GROUP BY user_id, event_type)
       SELECT user_id, event_type AS route, w + CASE WHEN event_type = min(event_type) OVER (PARTITION BY user_id)
              THEN 100 - sum(w) OVER (PARTITION BY user_id) ELSE 0 END AS weight FROM c""",
)
def q_route(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    counts = ev.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    m = counts.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("m"))
    tot = F.aggregate(F.map_values("m"), F.lit(0).cast("long"), lambda a, x: a + x)
    w = m.select("user_id", F.transform_values("m", lambda k, v: (v * 100 / tot).cast("long")).alias("w"))
    r = w.select("user_id", S.route_weights("w").alias("r"))
    return r.select("user_id", F.explode("r").alias("route", "weight"))


@register(
    "map_kv_list",
    """SELECT user_id, event_type AS key, count(*) AS value FROM events GROUP BY user_id, event_type""",
)
def q_kv(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    counts = ev.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    m = counts.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("m"))
    kv = m.select("user_id", S.kv_list("m").alias("kv"))
    return kv.select("user_id", F.inline("kv"))
