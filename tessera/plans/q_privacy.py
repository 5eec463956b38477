"""Queries for section L (privacy-cost tables) over the events votes matrix (one query per user,
five classes), and the bin aggregates of section D that need per-query costs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import aggregates as D
from tessera.operators import privacy as P
from tessera.plans.catalog import register
from tessera.plans.derived import SQL_EVENT_VOTES, event_votes
from tessera.session import table

# Parameters of the example analyses.
NOISE_EPS = 0.1
MOMENTS = [1.0, 2.0, 4.0, 8.0]
LAMBDA = 20.0
ORDERS = [2.0, 3.0, 5.0, 8.0, 16.0, 32.0, 64.0]
DELTA = 1e-5
SIGMA = 40.0


def r6(c):
    return F.round(c, 6)


def _v(spark, sf_dir):
    return event_votes(spark, sf_dir)


_W = "list_position(votes, list_max(votes))"
_TOP = f"votes[{_W}]"
_REST = f"list_filter(votes, lambda x, i: i <> {_W})"


def _q_sql(eps=NOISE_EPS):
    return (
        f"least(list_sum(list_transform({_REST}, lambda x: ({eps} * ({_TOP} - x) + 2.0) / (4.0 * exp({eps} * ({_TOP} - x))))),"
        f" 1.0 - 1.0 / len(votes))"
    )


@register("dp_q_noisy_max", f"SELECT user_id, round({_q_sql()}, 6) AS q FROM {SQL_EVENT_VOTES}")
def q_qnm(spark, sf_dir):
    return _v(spark, sf_dir).select("user_id", r6(P.q_noisy_max("votes", NOISE_EPS)).alias("q"))


@register(
    "dp_q_noisy_max_approx",
    f"""SELECT user_id, round(least((len(votes) - 1) * ({NOISE_EPS} * ({_TOP} - list_max({_REST}))+ 2.0)
               / (4.0 * exp({NOISE_EPS} * ({_TOP} - list_max({_REST})))), 1.0 - 1.0 / len(votes)), 6) AS q FROM {SQL_EVENT_VOTES}""",
)
def q_qnm_approx(spark, sf_dir):
    return _v(spark, sf_dir).select("user_id", r6(P.q_noisy_max_approx("votes", NOISE_EPS)).alias("q"))


def _logmgf_sql(q, E, l):
    t = f"((1 - {q}) * power((1 - {q}) / (1 - exp({E}) * {q}), {l}) + {q} * exp({E} * {l}))"
    return f"least(0.5 * {E} * {E} * {l} * ({l} + 1), CASE WHEN {q} < 0.5 AND {t} > 0 THEN ln({t}) ELSE {E} * {l} END, {E} * {l})"


_MOMENTS_SQL = "(VALUES " + ", ".join(f"({m})" for m in MOMENTS) + ") m(l)"


@register(
    "dp_logmgf",
    f"""SELECT l, round(sum({_logmgf_sql('q', 2 * NOISE_EPS, 'l')}), 6) AS logmgf
        FROM (SELECT {_q_sql()} AS q FROM {SQL_EVENT_VOTES}), {_MOMENTS_SQL} GROUP BY l""",
)
def q_logmgf(spark, sf_dir):
    return P.logmgf(_v(spark, sf_dir), "votes", NOISE_EPS, MOMENTS).select("l", r6("logmgf").alias("logmgf"))


@register(
    "dp_epsilon_moments",
    f"""WITH s AS (SELECT l, sum({_logmgf_sql('q', 2 * NOISE_EPS, 'l')}) AS lm, count(*) AS n
                   FROM (SELECT {_q_sql()} AS q FROM {SQL_EVENT_VOTES}), {_MOMENTS_SQL} GROUP BY l)
        SELECT round(min((lm - ln({DELTA})) / l), 6) AS eps, arg_min(l, (lm - ln({DELTA})) / l) AS best_moment,
               round(min((n * {_logmgf_sql('1.0', 2 * NOISE_EPS, 'l')} - ln({DELTA})) / l), 6) AS eps_data_independent FROM s""",
)
def q_eps_moments(spark, sf_dir):
    e = P.epsilon_moments(_v(spark, sf_dir), "votes", NOISE_EPS, MOMENTS, DELTA)
    return e.select(r6("eps").alias("eps"), "best_moment", r6("eps_data_independent").alias("eps_data_independent"))


def _sens_sql():
    def moved(j):
        return f"list_transform(s, lambda x, i: CASE WHEN i = 1 THEN x - ({j}) WHEN i = 2 THEN x + ({j}) ELSE x END)"

    E = 2 * NOISE_EPS
    val = _logmgf_sql(f"({_q_sql().replace('votes', 'm1')})", E, "8.0")
    val2 = _logmgf_sql(f"({_q_sql().replace('votes', 'm2')})", E, "8.0")
    return f"""WITH v AS (SELECT user_id, list_sort(list_transform(votes, lambda x: x::DOUBLE), 'DESC') AS s FROM {SQL_EVENT_VOTES}),
                    m AS (SELECT user_id, CAST(k AS INTEGER) AS k, s, {moved('k')} AS m1, {moved('k + 1')} AS m2 FROM v, range(0, 4) r(k))
               SELECT user_id, k, round(CASE WHEN s[1] < s[2] + k THEN 0.0 ELSE {val2} - {val} END, 6) AS sens FROM m"""


@register("dp_sensitivity_at_k", _sens_sql())
def q_sens(spark, sf_dir):
    """Sensitivity of the moment bound at distances 0..3 for moment 8 (checked in the tests
    against a direct evaluation)."""
    v = _v(spark, sf_dir)
    ks = v.select("user_id", "votes", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("k"))
    return ks.select("user_id", "k", r6(P.sens_at_k("votes", NOISE_EPS, 8.0, F.col("k").cast("double"))).alias("sens"))


def _smooth_sql(beta=0.2):
    def moved(j):
        return f"list_transform(s, lambda x, i: CASE WHEN i = 1 THEN x - ({j}) WHEN i = 2 THEN x + ({j}) ELSE x END)"

    E = 2 * NOISE_EPS
    val = _logmgf_sql(f"({_q_sql().replace('votes', 'm1')})", E, "8.0")
    val2 = _logmgf_sql(f"({_q_sql().replace('votes', 'm2')})", E, "8.0")
    return f"""WITH v AS (SELECT user_id, list_sort(list_transform(votes, lambda x: x::DOUBLE), 'DESC') AS s FROM {SQL_EVENT_VOTES}),
                    kk AS (SELECT user_id, s, unnest(range(0, CAST(s[1] AS BIGINT) + 1)) AS k FROM v),
                    m AS (SELECT user_id, k, s, {moved('k')} AS m1, {moved('k + 1')} AS m2 FROM kk),
                    e AS (SELECT user_id, k, CASE WHEN s[1] < s[2] + k THEN 0.0 ELSE {val2} - {val} END AS sens FROM m),
                    st AS (SELECT user_id, min(k) FILTER (WHERE k >= 1 AND sens = 0.0) AS stop FROM e GROUP BY user_id)
               SELECT user_id, round(max(exp(-{beta} * k) * sens), 6) AS smooth_sens FROM e JOIN st USING (user_id)
               WHERE stop IS NULL OR k <= stop GROUP BY user_id"""


@register("dp_smooth_sensitivity", _smooth_sql())
def q_smooth(spark, sf_dir):
    return P.smoothed_sens(_v(spark, sf_dir), "user_id", "votes", NOISE_EPS, 8.0, 0.2).select(
        "user_id", r6("smooth_sens").alias("smooth_sens")
    )


def _logq_lap_sql(lmbd=LAMBDA):
    terms = f"list_transform({_REST}, lambda x: ln(2.0 - (x - {_TOP}) / {lmbd}) + ln(0.25) + (x - {_TOP}) / {lmbd})"
    return f"least(list_max({terms}) + ln(list_sum(list_transform({terms}, lambda y: exp(y - list_max({terms}))))), ln(1.0 - 1.0 / len(votes)))"


@register("dp_logq_laplace", f"SELECT user_id, round({_logq_lap_sql()}, 6) AS logq FROM {SQL_EVENT_VOTES}")
def q_logq_lap(spark, sf_dir):
    return _v(spark, sf_dir).select("user_id", r6(P.logq_laplace("votes", LAMBDA)).alias("logq"))


_ORDERS_SQL = "(VALUES " + ", ".join(f"({o})" for o in ORDERS) + ") o(alpha)"


def _log1mexp_sql(x):
    return f"(CASE WHEN {x} < -ln(2.0) THEN ln(1 - exp({x})) ELSE ln(-(exp({x}) - 1)) END)"


def _rdp_pure_sql(logq="logq", E=2.0 / LAMBDA, a="alpha"):
    t1 = f"(ln(1 - exp({logq})) + (ln(1 - exp({logq})) - {_log1mexp_sql(f'({E} + {logq})')}) * ({a} - 1))"
    t2 = f"({logq} + {E} * ({a} - 1))"
    lt = f"(greatest({t1}, {t2}) + ln(1 + exp(least({t1}, {t2}) - greatest({t1}, {t2}))))"
    return (
        f"least(0.5 * {E} * {E} * {a}, CASE WHEN exp({logq}) <= 1.0 / (exp({E}) + 1.0) THEN {lt} / ({a} - 1) "
        f"ELSE 'inf'::DOUBLE END, {E})"
    )


@register(
    "dp_rdp_pure_eps",
    f"""SELECT user_id, alpha AS "order", round({_rdp_pure_sql()}, 6) AS rdp
        FROM (SELECT user_id, {_logq_lap_sql()} AS logq FROM {SQL_EVENT_VOTES}), {_ORDERS_SQL}""",
)
def q_rdp_pure(spark, sf_dir):
    v = _v(spark, sf_dir).select("user_id", P.logq_laplace("votes", LAMBDA).alias("logq"))
    grid = spark.createDataFrame([(o,) for o in ORDERS], "order double")
    return v.crossJoin(F.broadcast(grid)).select(
        "user_id", "order", r6(P.rdp_pure_eps(F.col("logq"), 2.0 / LAMBDA, F.col("order"))).alias("rdp")
    )


@register("dp_logq_gaussian")
def q_logq_gauss(spark, sf_dir):
    """Gaussian noisy-maximum logq (normal tails by pandas UDF)."""
    return _v(spark, sf_dir).select("user_id", r6(P.logq_gaussian("votes", SIGMA)).alias("logq"))


@register("dp_rdp_gaussian")
def q_rdp_gauss(spark, sf_dir):
    v = _v(spark, sf_dir).select("user_id", P.logq_gaussian("votes", SIGMA).alias("logq"))
    grid = spark.createDataFrame([(o,) for o in ORDERS], "order double")
    return v.crossJoin(F.broadcast(grid)).select("user_id", "order", r6(P.rdp_gaussian(F.col("logq"), SIGMA, F.col("order"))).alias("rdp"))


@register("dp_logpr_answered")
def q_logpr(spark, sf_dir):
    return _v(spark, sf_dir).select("user_id", r6(P.logpr_answered("votes", 60.0, 20.0)).alias("logpr"))


@register("dp_rdp_threshold")
def q_rdp_threshold(spark, sf_dir):
    v = _v(spark, sf_dir).select("user_id", P.logpr_answered("votes", 60.0, 20.0).alias("logpr"))
    grid = spark.createDataFrame([(o,) for o in ORDERS], "order double")
    return v.crossJoin(F.broadcast(grid)).select("user_id", "order", r6(P.rdp_threshold(F.col("logpr"), 20.0, F.col("order"))).alias("rdp"))


@register(
    "dp_cumulative_budget",
    f"""WITH r AS (SELECT user_id, alpha, {_rdp_pure_sql()} AS rdp
                   FROM (SELECT user_id, {_logq_lap_sql()} AS logq FROM {SQL_EVENT_VOTES}), {_ORDERS_SQL}),
            c AS (SELECT user_id, alpha, sum(rdp) OVER (PARTITION BY alpha ORDER BY user_id ROWS UNBOUNDED PRECEDING) AS cum,
                         CAST(row_number() OVER (PARTITION BY alpha ORDER BY user_id) AS DOUBLE) AS answered FROM r)
       SELECT user_id, round(min(cum - ln({DELTA}) / (alpha - 1)), 6) AS eps,
              arg_min(alpha, (cum - ln({DELTA}) / (alpha - 1), alpha)) AS best_order, min(answered) AS answered
       FROM c GROUP BY user_id""",
)
def q_cumulative(spark, sf_dir):
    c = P.cumulative_budget(_v(spark, sf_dir), "user_id", "votes", "lnmax", LAMBDA, ORDERS, DELTA)
    return c.select("user_id", r6("eps").alias("eps"), "best_order", "answered")


@register("dp_cumulative_budget_gnmax_conf")
def q_cumulative_conf(spark, sf_dir):
    """Confident Gaussian aggregation: threshold 60 with sigma1 20, answers with sigma 40."""
    c = P.cumulative_budget(_v(spark, sf_dir), "user_id", "votes", "gnmax_conf", SIGMA, ORDERS, DELTA, threshold=60.0, sigma1=20.0)
    return c.select("user_id", r6("eps").alias("eps"), "best_order", r6("answered").alias("answered"))


def _ledger(spark, sf_dir):
    """A training ledger derived from the events: one run per event type with sampling rate = its
    share of events, noise multiplier from its mean value and steps = its distinct users."""
    ev = table(spark, sf_dir, "events")
    total = ev.agg(F.count(F.lit(1)).alias("_t"))
    per = ev.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("_n"), F.avg("value").alias("_v"), F.countDistinct("user_id").alias("steps")
    )
    return per.crossJoin(total).select(
        "event_type", (F.col("_n") / F.col("_t")).alias("q"), (0.5 + F.col("_v") / 50.0).alias("noise"), "steps"
    )


@register("dp_sampled_gaussian_ledger")
def q_ledger(spark, sf_dir):
    return P.rdp_ledger(_ledger(spark, sf_dir), ORDERS + [2.5, 1.5]).select("order", r6("rdp").alias("rdp"))


@register(
    "dp_privacy_spent",
    f"""WITH r AS (SELECT alpha, sum({_rdp_pure_sql()}) AS rdp
                   FROM (SELECT user_id, {_logq_lap_sql()} AS logq FROM {SQL_EVENT_VOTES}), {_ORDERS_SQL} GROUP BY alpha)
       SELECT round(min(rdp - ln({DELTA}) / (alpha - 1)), 6) AS eps, {DELTA} AS delta,
              arg_min(alpha, (rdp - ln({DELTA}) / (alpha - 1), alpha)) AS best_order FROM r""",
)
def q_spent(spark, sf_dir):
    v = _v(spark, sf_dir).select(P.logq_laplace("votes", LAMBDA).alias("logq"))
    grid = spark.createDataFrame([(o,) for o in ORDERS], "order double")
    rdp = v.crossJoin(F.broadcast(grid)).groupBy("order").agg(
        F.sum(P.rdp_pure_eps(F.col("logq"), 2.0 / LAMBDA, F.col("order"))).alias("rdp")
    )
    s = P.privacy_spent(rdp, target_delta=DELTA)
    return s.select(r6("eps").alias("eps"), "delta", "best_order")


# ---------------------------------------------------------------------------- bins with costs
def _binned(spark, sf_dir):
    v = _v(spark, sf_dir)
    tot = F.aggregate("votes", F.lit(0).cast("long"), lambda a, x: a + x)
    return v.select(
        "user_id",
        D.bin_of(F.array_max("votes"), tot, 10).alias("bin"),
        P.logq_laplace("votes", LAMBDA).alias("logq"),
    )


_BIN_SQL = f"CAST(least(floor(list_max(votes) * 10 / list_sum(votes)), 9) AS INTEGER)"


@register(
    "agg_bin_mean_cost",
    f"""SELECT bin, round(avg({_rdp_pure_sql(E=2.0 / LAMBDA, a='8.0')}), 6) AS mean_value, count(*) AS n FROM (
          SELECT {_BIN_SQL} AS bin, {_logq_lap_sql()} AS logq FROM {SQL_EVENT_VOTES}) GROUP BY bin""",
)
def q_bin_cost(spark, sf_dir):
    b = _binned(spark, sf_dir).withColumn("rdp", P.rdp_pure_eps(F.col("logq"), 2.0 / LAMBDA, F.lit(8.0)))
    return D.bin_mean(b, "bin", "rdp").select("bin", r6("mean_value").alias("mean_value"), "n")


@register(
    "agg_bin_expected",
    f"""SELECT bin, round(sum(1 - exp(logq)), 6) AS sum_value, count(*) AS n FROM (
          SELECT {_BIN_SQL} AS bin, {_logq_lap_sql()} AS logq FROM {SQL_EVENT_VOTES}) GROUP BY bin""",
)
def q_bin_expected(spark, sf_dir):
    """Expected number of queries answered with the plurality label per bin: sum of 1 - q."""
    b = _binned(spark, sf_dir).withColumn("p", 1 - F.exp("logq"))
    return D.bin_sum(b, "bin", "p").select("bin", r6("sum_value").alias("sum_value"), "n")



# ---------------------------------------------------------------------------- smooth sensitivity
@register("dp_local_sensitivity")
def q_local_sens(spark, sf_dir):
    """Local sensitivity at each distance for the Gaussian maximum and the threshold check over
    the model votes (6 voting slices, 10 classes)."""
    from tessera.plans.derived import model_votes

    v = model_votes(spark, sf_dir)
    g = P.local_sensitivity_gnmax(v, "vec_id", "votes", 6, 2.0, 5.0).withColumnRenamed("ls", "ls_gnmax")
    t = P.local_sensitivity_threshold(v, "vec_id", "votes", 6, 4.0, 2.0, 5.0).withColumnRenamed("ls", "ls_threshold")
    return g.join(t, ["vec_id", "d"]).select("vec_id", "d", r6("ls_gnmax").alias("ls_gnmax"), r6("ls_threshold").alias("ls_threshold"))


@register("dp_smooth_release")
def q_smooth_release(spark, sf_dir):
    """Best beta of the smooth-sensitivity release over all model-vote queries (order 5)."""
    from tessera.plans.derived import model_votes

    betas = [x / 100.0 / 5.0 for x in range(30, 50)]
    r = P.smooth_release(model_votes(spark, sf_dir), "vec_id", "votes", 6, 4.0, 2.0, 2.0, 5.0, betas)
    return r.select(*[r6(c).alias(c) for c in ["beta", "ss", "sigma_ss", "cost", "rdp_cum"]])
