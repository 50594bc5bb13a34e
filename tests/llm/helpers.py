"""Small tables shared by the operator tests."""

import random

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs(spark, texts, schema=DOC, first=0):
    """Documents with ids from ``first``; a pair (id, text) sets the id."""
    rows = []
    for i, t in enumerate(texts):
        i, t = t if isinstance(t, tuple) else (first + i, t)
        rows.append((i, t, "en", "s", None if t is None else len(t)))
    return spark.createDataFrame(rows, schema)


def clash(df):
    """Extra columns with the names that operators use inside."""
    from pyspark.sql import functions as F
    extra = {c: F.lit(9) for c in ("fp", "key", "k_id", "k_h1", "u", "v", "node", "root", "id", "y", "drop_id", "spans",
                                   "base", "linked", "row", "clean", "pos", "worker", "score", "start")}
    return df.withColumns({c: v for c, v in extra.items() if c not in df.columns})


def prose(n, seed=0, vocab=400):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeiorstu") for _ in range(rng.randint(2, 8))) for _ in range(vocab)]
    return " ".join(rng.choice(words) for _ in range(n))
