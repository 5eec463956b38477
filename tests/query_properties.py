"""What holds for the queries without an oracle statement.  Each function gets the session, the folder of
the tables and the rows, and asserts."""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import functions as F

from tessera.session import table

PROPERTIES = {}


def holds(name):
    def deco(fn):
        PROPERTIES[name] = fn
        return fn

    return deco


def count(spark, sf, name):
    return table(spark, sf, name).count()


def mean(values):
    values = list(values)
    return sum(values) / len(values)


@holds("agg_noisy_max_laplace")
def noisy(spark, sf, rows):
    from tessera.plans.derived import event_votes

    votes = {r.user_id: r.votes for r in event_votes(spark, sf).collect()}
    assert {r.user_id for r in rows} == set(votes) and all(0 <= r.label < 5 for r in rows)
    # noise of scale 2 leaves most clear winners
    clear = [r for r in rows if sorted(votes[r.user_id])[-1] - sorted(votes[r.user_id])[-2] >= 6]
    assert mean(votes[r.user_id][r.label] == max(votes[r.user_id]) for r in clear) > 0.8 if clear else True


@holds("random_split")
def split(spark, sf, rows):
    assert len({r.o_orderkey for r in rows}) == len(rows) == count(spark, sf, "orders")
    shares = Counter(r.split for r in rows)
    assert set(shares) == {0, 1} and abs(shares[0] / len(rows) - 0.7) < 0.06


@holds("math_hash_bucket")
def bucket(spark, sf, rows):
    names = {r.c_custkey: r.c_name for r in table(spark, sf, "customer").collect()}
    assert {r.c_custkey for r in rows} == set(names) and all(0 <= r.bucket < 100 for r in rows)
    assert len({(names[r.c_custkey], r.bucket) for r in rows}) == len(set(names.values()))
    assert max(Counter(r.bucket for r in rows).values()) < 0.1 * len(rows)


@holds("st_shuffle_batch_seeded")
def batches(spark, sf, rows):
    n = count(spark, sf, "events")
    assert {r.event_id for r in rows} == {r.event_id for r in table(spark, sf, "events").collect()}
    sizes = Counter(r.batch for r in rows)
    assert sorted(sizes) == list(range(-(-n // 64))) and all(sizes[b] == 64 for b in range(n // 64))
    first = sorted(r.event_id for r in rows if r.batch == 0)
    assert first != sorted(r.event_id for r in rows)[:64]  # shuffled


@holds("txt_subword_train")
def vocabulary(spark, sf, rows):
    names = [r.subtoken for r in sorted(rows, key=lambda r: r.id)]
    assert [r.id for r in sorted(rows, key=lambda r: r.id)] == list(range(len(rows))) and len(set(names)) == len(names)
    text = {c for r in table(spark, sf, "conversations").collect() for c in r.text}
    assert names[:2] == ["<pad>", "<EOS>"] and {c for c in text if c != "_"} - {"\n", "\\", " "} <= {c for x in names for c in x}
    assert any(len(x) > 3 for x in names)


@holds("txt_subword_search")
def searched(spark, sf, rows):
    vocabulary(spark, sf, rows)
    assert abs(len(rows) - 400) <= 200


@holds("txt_subword_encode")
def encoded(spark, sf, rows):
    from tessera.operators import subword as SW
    from tessera.plans.q_text import _turn_vocab

    voc = _turn_vocab(spark, sf)
    top = voc.count()
    assert len(rows) == count(spark, sf, "conversations") and all(r.ids[-1] == 1 and all(0 <= i < top for i in r.ids) for r in rows)
    back = SW.subword_decode(spark.createDataFrame([(r.key, r.ids[:-1]) for r in rows], "key string, ids array<int>"), "key", "ids", voc)
    texts = {f"{r.conv_id}:{r.turn}": r.text for r in table(spark, sf, "conversations").collect()}
    assert {r.key: r.text for r in back.collect()} == texts


@holds("txt_prepare_pairs")
def pairs(spark, sf, rows):
    turns = {(r.conv_id, r.turn): r for r in table(spark, sf, "conversations").collect()}
    want = {f"{c}:{t}" for (c, t), r in turns.items() if r.role == "user" and (c, t + 1) in turns}
    assert {r.key for r in rows} == want and all(r.src_ids[-1] == 1 and r.tgt_ids[-1] == 1 for r in rows)
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1


def tail(x):
    """Upper tail of the normal distribution."""
    return 0.5 * math.erfc(x / math.sqrt(2.0))


def votes_of(spark, sf):
    from tessera.plans.derived import event_votes

    return {r.user_id: r.votes for r in event_votes(spark, sf).collect()}


def logq_of(votes, sigma):
    """Log of the chance that noise of ``sigma`` on each count moves the maximum: a union of the other
    classes, at most that of a choice by chance."""
    top = votes.index(max(votes))
    q = sum(tail((votes[top] - v) / (2 * sigma) * math.sqrt(2.0)) for k, v in enumerate(votes) if k != top)
    return min(math.log(q) if q > 0 else -math.inf, math.log(1 - 1 / len(votes)))


@holds("dp_logq_gaussian")
def logq(spark, sf, rows):
    from tessera.plans.q_privacy import SIGMA

    votes = votes_of(spark, sf)
    assert {r.user_id for r in rows} == set(votes)
    for r in rows:
        assert abs(r.logq - logq_of(votes[r.user_id], SIGMA)) < 2e-5


@holds("dp_rdp_gaussian")
def rdp_gaussian(spark, sf, rows):
    from tessera.plans.q_privacy import ORDERS, SIGMA

    by = {}
    for r in rows:
        by.setdefault(r.user_id, {})[r.order] = r.rdp
        assert -1e-9 <= r.rdp <= r.order / SIGMA**2 + 1e-6  # never above the bound that ignores the data
    assert set(by) == set(votes_of(spark, sf)) and all(set(x) == set(ORDERS) for x in by.values())


@holds("dp_logpr_answered")
def logpr(spark, sf, rows):
    votes = votes_of(spark, sf)
    assert {r.user_id for r in rows} == set(votes)
    for r in rows:
        want = tail((60.0 - max(votes[r.user_id])) / 20.0)
        assert abs(r.logpr - math.log(want)) < 2e-5


@holds("dp_rdp_threshold")
def rdp_threshold(spark, sf, rows):
    assert {r.user_id for r in rows} == set(votes_of(spark, sf))
    assert all(-1e-9 <= r.rdp <= r.order / (2.0 * 20.0**2) + 1e-6 for r in rows)


@holds("dp_cumulative_budget_gnmax_conf")
def budget(spark, sf, rows):
    from tessera.plans.q_privacy import ORDERS

    rows = sorted(rows, key=lambda r: r.user_id)
    assert [r.user_id for r in rows] == sorted(votes_of(spark, sf)) and all(r.best_order in ORDERS for r in rows)
    assert all(a.answered <= b.answered <= a.answered + 1 + 1e-6 and a.eps <= b.eps + 1e-6 for a, b in zip(rows, rows[1:]))


@holds("dp_sampled_gaussian_ledger")
def ledger(spark, sf, rows):
    rows = sorted(rows, key=lambda r: r.order)
    assert all(r.rdp >= 0 for r in rows) and all(a.rdp <= b.rdp for a, b in zip(rows, rows[1:]))


@holds("dp_local_sensitivity")
def sensitivity(spark, sf, rows):
    vectors = count(spark, sf, "embeddings")
    by = {}
    for r in rows:
        by.setdefault(r.vec_id, set()).add(r.d)
        assert r.ls_gnmax >= 0 and r.ls_threshold >= 0
    assert len(by) == vectors and all(d == set(range(len(d))) for d in by.values())


@holds("dp_smooth_release")
def release(spark, sf, rows):
    assert len(rows) >= 1 and all(0.06 - 1e-9 <= r.beta <= 0.1 and r.ss > 0 and r.sigma_ss > 0 for r in rows)


@holds("ml_pca")
def pca(spark, sf, rows):
    data = {r.vec_id: r.embedding for r in table(spark, sf, "embeddings").collect()}
    assert {r.vec_id for r in rows} == set(data) and all(len(r.pca) == 3 for r in rows)
    spread = [mean(r.pca[k] ** 2 for r in rows) - mean(r.pca[k] for r in rows) ** 2 for k in range(3)]
    assert spread == sorted(spread, reverse=True)
    for a, b in ((0, 1), (0, 2), (1, 2)):  # components do not vary together
        both = mean(r.pca[a] * r.pca[b] for r in rows) - mean(r.pca[a] for r in rows) * mean(r.pca[b] for r in rows)
        assert abs(both) < 1e-6 * max(1.0, spread[0])


@holds("ml_census_features")
def census(spark, sf, rows):
    from tessera.plans.q_ml import SEGMENTS

    people = {r.c_custkey: r for r in table(spark, sf, "customer").collect()}
    assert {r.c_custkey for r in rows} == set(people)
    for r in rows:
        p = people[r.c_custkey]
        known = r.features[: len(SEGMENTS) + 1]
        assert known == [float(p.c_mktsegment == s) for s in SEGMENTS] + [float(p.c_mktsegment not in SEGMENTS)]
        assert sum(x != 0 for x in r.features[len(known) : -1]) == 1 and r.features[-1] == p.c_acctbal


@holds("ml_linear_regression_fit")
def linear(spark, sf, rows):
    (r,) = rows
    data = table(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_tax", "l_extendedprice").toPandas().to_numpy(float)
    left = data[:, 3] - r.intercept - data[:, :3] @ r.coefficients
    scale = abs(data[:, 3]).mean()
    assert abs(left.mean()) < 1e-6 * scale and all(abs((left * (data[:, k] - data[:, k].mean())).mean()) < 1e-6 * scale * (1 + data[:, k].std()) for k in range(3))


@holds("ml_elastic_net")
def elastic(spark, sf, rows):
    assert {(r.alpha, r.l1_ratio) for r in rows} == {(a, b) for a in (0.1, 1.0) for b in (0.0, 0.5)}
    # the prices of these tables do not depend on the features: no worse than the mean on rows not seen
    assert all(r.r2 > -0.02 and 0 < r.mae <= r.rmse for r in rows)


@holds("ml_forest_regression")
def forest(spark, sf, rows):
    kept, out = [r for r in rows if not r.held_out], [r for r in rows if r.held_out]
    assert 0.15 < len(out) / len(rows) < 0.35
    usual = mean(r.label for r in kept)
    assert mean((r.label - r.prediction) ** 2 for r in out) < 1.05 * mean((r.label - usual) ** 2 for r in out)
    assert mean((r.label - r.prediction) ** 2 for r in kept) < mean((r.label - usual) ** 2 for r in kept)


@holds("ml_forest_classifier")
def classes(spark, sf, rows):
    assert len(rows) == count(spark, sf, "embeddings") and all(abs(sum(r.probability) - 1) < 1e-9 for r in rows)
    assert all(r.prediction == r.probability.index(max(r.probability)) for r in rows)
    kept, out = [r for r in rows if not r.held_out], [r for r in rows if r.held_out]
    usual = Counter(r.label for r in kept).most_common(1)[0][1] / len(kept)
    assert 0.15 < len(out) / len(rows) < 0.35 and mean(r.label == r.prediction for r in kept) > usual + 0.05


@holds("ml_boosted_trees")
def boosted(spark, sf, rows):
    labels = {r.vec_id: float(r.label) for r in table(spark, sf, "embeddings").collect()}
    usual = Counter(labels.values()).most_common(1)[0][1] / len(labels)
    assert {r.vec_id for r in rows} == set(labels) and mean(r.prediction == labels[r.vec_id] for r in rows) > usual + 0.05


@holds("ml_cross_validate")
def validated(spark, sf, rows):
    assert [r.max_depth for r in sorted(rows)] == [2.0, 4.0] and all(0 < r.accuracy <= 1 for r in rows)


@holds("ml_mlp_grid")
def perceptrons(spark, sf, rows):
    assert [r.hidden for r in sorted(rows)] == [16.0, 32.0] and all(0 < r.accuracy <= 1 for r in rows)


def chosen(spark, sf, rows):
    """Better than a constant, on rows it has not seen."""
    from tessera.plans.derived import letter_shares
    from tessera.plans.ml import held_out

    d = held_out(letter_shares(spark, sf).select("doc_id", "label"), "doc_id").collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in d if r.held_out}
    usual = Counter(r.label for r in d if not r.held_out).most_common(1)[0][0]
    assert mean(r.label == r.prediction for r in rows) >= mean(r.label == usual for r in rows) + 0.2


PROPERTIES["ml_cross_validate_best"] = PROPERTIES["ml_mlp_grid_best"] = chosen


@holds("ml_batch_score")
def scored(spark, sf, rows):
    prices = {r.o_orderkey: r.o_totalprice for r in table(spark, sf, "orders").collect()}
    assert {r.o_orderkey for r in rows} == set(prices)
    assert abs(mean(r.prediction for r in rows) / mean(prices.values()) - 1) < 1e-6  # least squares keeps the mean


@holds("ml_save_load")
def saved(spark, sf, rows):
    import __spark_entry__ as entry

    direct = {r.o_orderkey: r.prediction for r in entry.queries()["ml_batch_score"](spark, sf).collect()}
    assert {r.o_orderkey: round(r.prediction, 6) for r in rows} == {k: round(v, 6) for k, v in direct.items()}
