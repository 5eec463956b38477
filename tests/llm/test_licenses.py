import random
import re
from collections import Counter

import duckdb

from tessera.llm import licenses as L

SF = "/root/testdata/sf0.01"


def brute(rows, texts):
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    cut = lambda w: [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
    own = {k: set(cut(words(v))) for k, v in texts.items()}
    out = Counter()
    for i, t in rows:
        h = cut(words(t))
        for k, s in own.items():
            at = [p for p, x in enumerate(h) if x in s]
            share = len(s & set(h)) / len(s) if s else 0
            if share >= 0.75:
                out[i, k, len(s), share, at[0], at[-1] + 4] += 1
    return out


def test_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    rel = con.sql(L.oracle())
    df = L.scan(spark.read.parquet(f"{SF}/documents.parquet"))
    got = Counter(tuple(r[c] for c in rel.columns) for r in df.collect())
    assert got == Counter(rel.fetchall()) and len(got) > 10


def test_edited_and_odd_texts(spark):
    r = random.Random(1)
    noise = lambda n: " ".join(f"w{r.randrange(999)}" for _ in range(n))
    rows = [(None, None), (1, ""), (1, ""), (2, "the MIT"), (3, "é ß"), (4, noise(20_000))]
    for k, (name, text) in enumerate(sorted(L.TEMPLATES.items())):
        rows.append((100 + k, f"{noise(r.randrange(90))} {text} {noise(r.randrange(90))}"))
        rows.append((200 + k, text.upper().replace(" ", " * ")))
        words = text.split()
        for edits in (1, 2, 4):
            w = list(words)
            for _ in range(edits):
                w[r.randrange(len(w))] = "changed"
            rows.append((300 + 10 * k + edits, f"{noise(30)} {' '.join(w)} {noise(30)}"))
        rows.append((600 + k, f"{noise(5)} {' '.join(words[: len(words) * 4 // 5])} {noise(5)}"))
    rows += [rows[6], (None, rows[6][1])]
    df = spark.createDataFrame([(*x, "h") for x in rows], "doc_id long, text string, license string")
    got = Counter(tuple(x[c] for c in ("doc_id", "license", "template_shingles", "containment", "first_word", "last_word")) for x in L.scan(df).collect())
    assert got == brute(rows, L.TEMPLATES)
    assert L.scan(df.limit(0)).count() == 0


def test_native_plan(spark):
    plan = L.scan(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
