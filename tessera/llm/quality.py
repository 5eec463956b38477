"""Quality rules under weak supervision, with DataFrame functions only.

Each rule votes to keep (1), to reject (-1) or abstains (0).  No labels are used: expectation-
maximisation over the table of vote patterns estimates, for each rule, how often its votes agree with
the hidden quality, and the posterior probability of good quality replaces all-must-pass filtering.
The table of patterns has at most 3 ** rules rows at any corpus size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import WORD, let, written

SYMBOLS = "#*$%&|<>"
#: Digits and the punctuation of programs and tables.
MARKS = "0123456789#*$%&|<>{}[]()=+/\\^~_@"
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZÄÖÜÀÂÇÉÈÊËÎÏÔÙÛÑÁÍÓÚ"
#: Frequent function words of the languages at hand.
COMMON = "the of and to in is it that for was with the on are this by from la le les de des et est que un une dans pour avec der die das und ist nicht mit von auf für ein eine sich im el los las y en por con para se".split()

FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_common", "n_capitals", "n_bangs", "n_ended", "n_marks", "n_marked")


def _repeat_words(w: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in ``w``: the windows are sorted with
    their positions, so equal ones are neighbours."""
    at = F.sequence(F.lit(0), F.size(w) - 3)
    windows = F.transform(at, lambda i: F.struct(F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("t"), i.alias("i")))

    def count(s: Column) -> Column:
        same = F.filter(s, lambda x, k: F.coalesce(F.get(s, k - 1)["t"] == x["t"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["t"] == x["t"], F.lit(False)))
        return F.size(F.array_distinct(F.flatten(F.transform(same, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

    return F.when(F.size(w) >= 3, let(F.sort_array(windows), count)).otherwise(F.lit(0))


def _of_words(w: Column) -> Column:
    lowered = F.array_distinct(F.transform(w, F.lower))
    return F.struct(
        F.size(w).cast("long").alias("n_words"),
        _repeat_words(w).cast("long").alias("n_repeat_words"),
        F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
        F.size(F.filter(w, lambda x: F.translate(F.right(x, F.lit(1)), SYMBOLS, "") == "")).cast("long").alias("n_marked"),
        F.size(F.array_intersect(lowered, F.array(*[F.lit(x) for x in sorted(set(COMMON))]))).cast("long").alias("n_common"),
    )


def _of_lines(lines: Column) -> Column:
    return F.struct(
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.size(F.filter(lines, lambda x: x.rlike(r'[.!?:"”»…][\x20\x09-\x0D]*$'))).cast("long").alias("n_ended"),
    )


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the FEATURES of its text (null: none) as struct column ``_f``.

    A generator stands between the features and their use, so each is evaluated once a row."""
    t = F.coalesce(F.col(text), F.lit(""))
    without = lambda chars: F.length(F.translate(t, chars, ""))
    words = let(F.regexp_extract_all(t, F.lit(WORD), F.lit(0)), _of_words)
    lines = let(F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD)), _of_lines)
    counts = F.struct(
        words.alias("w"),
        lines.alias("l"),
        without(BLANKS).cast("long").alias("word_chars"),
        (F.length(t) - without(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.length(t) - without(CAPITALS)).cast("long").alias("n_capitals"),
        (F.length(t) - without("!")).cast("long").alias("n_bangs"),
        (F.length(t) - without(MARKS)).cast("long").alias("n_marks"),
    )
    out = docs.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.array(counts)).alias("_g"))
    flat = F.struct(*[F.coalesce(F.col(p).cast("long"), F.lit(0)).alias(p.split(".")[-1]) for p in (
        "_g.w.n_words", "_g.word_chars", "_g.n_symbols", "_g.l.n_dup_lines", "_g.w.n_repeat_words", "_g.l.n_lines",
        "_g.w.n_distinct", "_g.w.n_common", "_g.n_capitals", "_g.n_bangs", "_g.l.n_ended", "_g.n_marks", "_g.w.n_marked",
    )])
    return out.withColumn("_f", flat).drop("_g")


def base_failed(f: str = "_f") -> Column:
    return (F.col(f"{f}.n_words") < 50) | (100 * F.col(f"{f}.n_repeat_words") > 50 * F.col(f"{f}.n_words"))


def rules(f: str = "_f") -> dict[str, Column]:
    """The votes.  Limits are shares of the words, lines or characters."""
    c = {n: F.col(f"{f}.{n}") for n in FEATURES}
    share = lambda a, b: c[a] / F.greatest(c[b], F.lit(1))

    def vote(bad: Column, good: Column | None = None) -> Column:
        v = F.when(bad, -1)
        return (v if good is None else v.when(good, 1)).otherwise(0)

    some, mean = c["n_words"] >= 20, share("word_chars", "n_words")
    return {
        "length": vote(c["n_words"] < 30),
        "symbols": vote(share("n_symbols", "n_words") > 0.25),
        "marks": vote(some & (share("n_marks", "word_chars") > 0.05)),
        "marked_words": vote(some & (share("n_marked", "n_words") > 0.1)),
        "lines": vote((c["n_dup_lines"] >= 2) & (share("n_dup_lines", "n_lines") > 0.3)),
        "repeats": vote(share("n_repeat_words", "n_words") > 0.35),
        "word_length": vote(some & ((mean < 2.5) | (mean > 12))),
        "capitals": vote(some & (share("n_capitals", "word_chars") > 0.35)),
        "bangs": vote(some & (share("n_bangs", "n_words") > 0.3)),
        "variety": vote((c["n_words"] >= 20) & (c["n_words"] <= 2000) & (share("n_distinct", "n_words") < 0.25)),
        "common_words": vote((c["n_words"] >= 50) & (c["n_common"] <= 1), c["n_common"] >= 4),
        "endings": vote((c["n_words"] >= 50) & (c["n_ended"] == 0), (c["n_lines"] >= 1) & (share("n_ended", "n_lines") >= 0.5)),
    }


Model = dict[str, float]


#: Where expectation-maximisation begins: the share of good documents and the rates of each vote.
PRIOR = 0.8
BEGIN = {("good", -1): 0.05, ("good", 0): 0.35, ("good", 1): 0.6, ("bad", -1): 0.5, ("bad", 0): 0.3, ("bad", 1): 0.2}
#: The weight of that beginning against the data, in documents.
BELIEF = 20.0


def key(rule: str, kind: str, vote: int) -> str:
    return f"{rule}|{kind}|{vote}"


def initial(names: list[str]) -> Model:
    return {"prior": PRIOR} | {key(x, kind, v): p for x in names for (kind, v), p in BEGIN.items()}


def weight(model: Model, rule: str, vote: int) -> float:
    """Log-likelihood ratio of a vote; a vote cast never counts against its own meaning."""
    w = math.log(model[key(rule, "good", vote)] / model[key(rule, "bad", vote)])
    return min(w, 0.0) if vote < 0 else max(w, 0.0) if vote > 0 else w


def posterior(votes: dict[str, Column], model: Model) -> Column:
    """Probability of good quality: prior odds times the likelihood ratio of each vote."""
    log = F.lit(math.log(model["prior"] / (1 - model["prior"])))
    for name, v in votes.items():
        log = log + F.when(v == 1, weight(model, name, 1)).when(v == -1, weight(model, name, -1)).otherwise(weight(model, name, 0))
    return 1 / (1 + F.exp(-log))


def fit(votes: DataFrame, rounds: int = 60, tolerance: float = 1e-4) -> Model:
    """Expectation-maximisation over a table of votes, one column a rule.  It estimates how often each
    rule votes 1, -1 or abstains on good and on bad documents, and the share of good ones.  Each round
    is one aggregate over the vote patterns and returns one row."""
    names = votes.columns
    n, p = F.col("n"), F.col("p")
    patterns = written(votes.groupBy(*names).agg(F.count(F.lit(1)).cast("double").alias("n")).coalesce(1), "vote-patterns")
    cols = {x: F.col(x) for x in names}
    model = initial(names)
    for _ in range(rounds):
        sums = [F.sum(n).alias("all"), F.sum(n * p).alias("good")]
        for x in names:
            for v in (-1, 0, 1):
                sums.append(F.sum(F.when(cols[x] == v, n * p).otherwise(0.0)).alias(key(x, "good", v)))
                sums.append(F.sum(F.when(cols[x] == v, n * (1 - p)).otherwise(0.0)).alias(key(x, "bad", v)))
        r = patterns.withColumn("p", posterior(cols, model)).agg(*sums).first()
        if not r["all"]:
            return model
        of = {"good": r["good"], "bad": r["all"] - r["good"]}
        new = {"prior": (r["good"] + BELIEF * PRIOR) / (r["all"] + BELIEF)}
        for x in names:
            for (kind, v), begin in BEGIN.items():
                new[key(x, kind, v)] = (r[key(x, kind, v)] + BELIEF * begin) / (of[kind] + BELIEF)
        moved = max(abs(new[k] - model[k]) for k in new)
        model = new
        if moved < tolerance:
            break
    return model


def judge(featured: DataFrame, model: Model) -> DataFrame:
    """Add base_failed, quality (the posterior) and kept."""
    return featured.withColumn("base_failed", base_failed()).withColumn("quality", posterior(rules(), model)).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= 0.5)
    )


def quality_report(docs: DataFrame) -> DataFrame:
    """One row per document (doc_id, text; other columns are ignored): doc_id, n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, base_failed, quality, kept.  Null and empty texts have no
    words and fail; documents of the same id are judged each on their own; an empty table gives no
    rows."""
    found = written(features(docs.select("doc_id", "text")).drop("text"), "quality-features")
    model = fit(found.select(*[v.alias(k) for k, v in rules().items()]))
    return judge(found, model).select("doc_id", *[f"_f.{x}" for x in FEATURES[:5]], "base_failed", "quality", "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that are kept, all columns as they are."""
    names = {c: c if c == "text" else f"c{k}" for k, c in enumerate(docs.columns)}  # none that is used here
    inner = docs.select(*[F.col(f"`{c}`").alias(x) for c, x in names.items()])
    found = written(features(inner), "quality-documents")  # features once, beside their documents
    model = fit(found.select(*[v.alias(k) for k, v in rules().items()]))
    return judge(found, model).where("kept").select(*[F.col(x).alias(c) for c, x in names.items()])
