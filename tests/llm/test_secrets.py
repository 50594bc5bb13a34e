"""Secret scan against a regular-expression version in Python."""

import hashlib
import random
import re

from sparkwright.llm import secrets
from tests.llm.helpers import clash, docs

A = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
B, C = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")


def slow_base(t):
    t = t or ""
    return sorted([(m.start(), 0, m.end(), "assign") for m in A.finditer(t) if len(m[2]) >= 6]
                  + [(m.start(), 1, m.end(), "access") for m in B.finditer(t) if len(m[0]) >= 20]
                  + [(m.start(), 2, m.end(), "hex") for m in C.finditer(t) if len(m[0]) >= 24])


def slow_linked(t, scope):
    """All pairs of parts, checked one by one."""
    t = t or ""
    weak = []
    for kind, (rank, role, pattern, group, least) in secrets.WEAK.items():
        flags = re.A
        if pattern.startswith("(?i)"):
            pattern, flags = pattern[4:], re.A | re.I
        for m in re.finditer(pattern, t, flags):
            if len(m[group]) >= least:
                weak.append((m.start(), rank, m.end(), kind, role))
    roles = {"assign": "secret", "access": "identifier", "hex": "secret"}
    parts = weak + [(*s, roles[s[3]]) for s in slow_base(t)]
    near = lambda a, b: b[2] >= a[0] - scope and b[0] <= a[2] + scope
    out = []
    for w in weak:
        need = {"identifier", "endpoint"} if w[4] == "secret" else {"secret"}
        if any(p[4] in need and near(w, p) for p in parts):
            out.append(w)
    return sorted(out)


def random_text(seed):
    rng = random.Random(seed)
    bits = ['password=abc123', 'token = "' + "0a" * 20 + '"', "AKIA" + "B7" * 9, "user: bob42", "login=ann@x.org",
            "https://db.example.org/path", "pwd: hunter2hunter2", "é" * 30, "token: token: abcdefgh", "secret=12345",
            "deadbeef" * 3, "auth = Zm9vYmFyQmF6", "q" * 90, "word " * 20, "aZ3" * 13 + "b", "API_KEY='x-y-z-1-2'",
            "\n", "redis://h:1/0", "AKIAAKIA" + "Z" * 20, "passwd\"  :  'longer_value'"]
    return " ".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))


def run(spark, df, scope=200):
    key = lambda s: (s["start"], s["rank"], s["end"], s["kind"])
    return sorted(((r["doc_id"], [key(s) for s in r["base"]], [key(s) for s in r["linked"]])
                   for r in secrets.scan(df, scope=scope).collect()), key=repr)


def test_scan_matches_brute_force(spark):
    texts = [None, "", "x"] + [random_text(s) for s in range(120)] + [(3, random_text(0)), (None, random_text(5))]
    for scope in (200, 30):
        got = run(spark, clash(docs(spark, texts)), scope)
        want = []
        for i, t in enumerate(texts):
            i, t = t if isinstance(t, tuple) else (i, t)
            want.append((i, slow_base(t), [w[:4] for w in slow_linked(t, scope)]))
        assert got == sorted(want, key=repr)
        assert any(w[2] for w in want)


def test_digest_columns(spark, tmp_path):
    docs(spark, ["token=abcdef12 and user=bob", "nothing"]).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in secrets.op3(spark, str(tmp_path)).collect()}
    assert got[0]["base_sha256"] == hashlib.sha256(b"assign:0:14").hexdigest()
    assert got[0]["spans"] == "assign:0:14,identifier:19:27" and got[0]["n_assign"] == 1
    assert got[1]["base_sha256"] == hashlib.sha256(b"").hexdigest() and got[1]["spans"] == ""


def test_redact(spark):
    texts = [None, "", "clean text", 'ü token = "' + "0a" * 20 + '" end', (3, "pwd: hunter2hunter2 user=bob"),
             "pwd: hunter2hunter2 alone"]
    df = clash(docs(spark, texts))
    out = secrets.redact(df)
    assert out.columns == df.columns and out.dtypes == df.dtypes
    rows = sorted(((r["text"], r["n_chars"], r["spans"]) for r in out.collect()), key=repr)
    want = [None, "", "clean text", 'ü [SECRET]" end', "[SECRET] [SECRET]", "pwd: hunter2hunter2 alone"]
    assert rows == sorted(((t, None if t is None else len(t), 9) for t in want), key=repr)
    assert secrets.redact(docs(spark, [])).count() == 0


def test_main_path_is_native(spark):
    df = docs(spark, ["token=abcdef12 user=bob"])
    for out in (secrets.scan(df), secrets.redact(df)):
        plan = out._jdf.queryExecution().toString()
        assert not re.search("Python|Arrow|Pandas", plan)


def test_many_parts_in_one_text(spark):
    text = " ".join(f"user=bob{i} password=abcdef{i} https://h{i}.org/x" for i in range(1500))
    got = secrets.scan(docs(spark, [text])).first()
    assert len(got["base"]) == 1500 and len(got["linked"]) == 3000


def test_running_sums_and_maxima(spark):
    from pyspark.sql import functions as F
    rng = random.Random(4)
    data = [[rng.randint(0, 50) for _ in range(n)] for n in (0, 1, 2, 3, 4, 5, 7, 8, 9, 31, 64, 100, 1000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], "i int, v array<bigint>")
    out = df.select("v", secrets._running(F.col("v"), lambda x, y: x + y).alias("s"),
                    secrets._running(F.col("v"), lambda x, y: F.greatest(x, y)).alias("m")).collect()
    for r in out:
        assert r["s"] == [sum(r["v"][: k + 1]) for k in range(len(r["v"]))]
        assert r["m"] == [max(r["v"][: k + 1]) for k in range(len(r["v"]))]


def test_masked_texts_against_plain(spark):
    """Spans that touch, overlap, hold each other and cross chunk borders."""
    from pyspark.sql import functions as F
    rng = random.Random(8)
    rows = []
    for k in range(60):
        text = "".join(rng.choice("abcé😀 \n") for _ in range(rng.choice([1, 40, 1023, 1024, 1025, 5000])))
        cut = [sorted((rng.randint(0, len(text)), rng.randint(0, len(text)))) for _ in range(rng.randint(1, 12))]
        rows.append((k, text, sorted((a, b) for a, b in cut if a < b) or [(0, 1)]))
    df = spark.createDataFrame(rows, "i int, t string, spans array<struct<start:bigint,end:bigint>>")
    got = {r["i"]: r["x"] for r in df.select("i", secrets._masked(F.col("t"), F.col("spans"), "[X]").alias("x")).collect()}
    for k, text, spans in rows:
        out, at = "", 0
        for a, b in spans:
            if a >= at:
                out += text[at:a] + "[X]"
            at = max(at, b)
        assert got[k] == out + text[at:]


def test_time_is_linear_in_the_matches(spark):
    """Twice the matches take at most 2.5 times as long, in scan and redact."""
    import time
    took = {}
    for n in (40_000, 80_000):
        text = " ".join(f"{i:032x}" for i in range(n))
        df = docs(spark, [text]).cache()
        df.count()
        best = []
        for _ in range(2):
            t = time.perf_counter()
            assert len(secrets.scan(df).first()["base"]) == n
            clean = secrets.redact(df).first()["text"]
            best.append(time.perf_counter() - t)
            assert clean == " ".join([secrets.MASK] * n)
        took[n] = min(best)
    assert took[80_000] < 2.5 * took[40_000]
