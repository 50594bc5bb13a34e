"""Preference formatting against a plain Python version."""

import re

import duckdb

from sparkwright.llm import preferences as P
from tests.llm.helpers import clash

TURN = "pair_id bigint, turn bigint, role string, text string"


def slow(chosen, rejected, chunk=P.CHUNK):
    clean = lambda rows: [(k, -1 if t is None else t, r or "unknown", (x or "").replace("<|", "< |"))
                          for k, t, r, x in rows if k is not None]
    out = {}
    c, r = clean(chosen), clean(rejected)
    for k in {x[0] for x in c + r}:
        mine = [sorted(x[1:] for x in side if x[0] == k) for side in (c, r)]
        turns = sorted({x[0] for side in mine for x in side})
        at = lambda side, t: [x for x in side if x[0] == t]
        fork = next((t for t in turns if at(mine[0], t) != at(mine[1], t)), None)
        for ch in sorted({t // chunk for t in turns}):
            row = {}
            for name, side, ok in (("prompt", 0, lambda t: fork is None or t < fork),
                                   ("chosen", 0, lambda t: fork is not None and t >= fork),
                                   ("rejected", 1, lambda t: fork is not None and t >= fork)):
                text, spans, n = "", [], 0
                for t, role, x in mine[side]:
                    if ok(t) and t // chunk == ch:
                        text += f"{P.OPEN}{role}\n"
                        if role == "assistant":
                            spans.append(f"{len(text)}:{len(text) + len(x) + len(P.CLOSE)}")
                        text += x + P.CLOSE + "\n"
                        n += 1
                row[name] = (text, ",".join(spans), n)
            out[k, ch] = (fork, row["prompt"][2], row["prompt"][0], row["chosen"][0], row["rejected"][0],
                          row["chosen"][1], row["rejected"][1])
    return out


CHOSEN = [(1, 0, "user", "hi"), (1, 1, "assistant", "good"), (1, 2, "user", "é<|im_end|>"), (1, 3, "assistant", "yes"),
          (2, 0, "user", "same"), (2, 1, "assistant", "same"), (3, 0, "user", "only chosen"), (4, None, "system", None),
          (4, 0, None, ""), (5, 0, "user", "a"), (5, 0, "user", "a"), (5, 0, "assistant", "b"), (None, 0, "user", "lost"),
          (6, 0, "user", "gap"), (6, 2, "assistant", "x")] + [(7, i, "assistant", f"t{i}") for i in range(600)]
REJECTED = [(1, 0, "user", "hi"), (1, 1, "assistant", "good"), (1, 2, "user", "é<|im_end|>"), (1, 3, "assistant", "no"),
            (1, 4, "user", "why"), (2, 0, "user", "same"), (2, 1, "assistant", "same"), (8, 0, "assistant", "only rejected"),
            (4, None, "system", None), (5, 0, "user", "a"), (5, 0, "assistant", "b"), (6, 0, "user", "gap"),
            (6, 1, "assistant", "y"), (6, 2, "assistant", "x")] + [(7, i, "assistant", f"t{i}") for i in range(590)]


def test_matches_plain_version(spark):
    c, r = spark.createDataFrame(CHOSEN, TURN).repartition(3), spark.createDataFrame(REJECTED, TURN)
    got = {(x["pair_id"], x["chunk"]): (x["fork"], x["n_prompt"], x["prompt"], x["chosen"], x["rejected"],
                                        x["chosen_mask"], x["rejected_mask"])
           for x in P.format_pairs(clash(c), clash(r)).collect()}
    assert got == slow(CHOSEN, REJECTED)
    assert got[1, 0][0] == 3 and got[2, 0][0] is None and got[7, 2][0] == 590


def test_mask_cuts_out_the_answers(spark):
    c, r = spark.createDataFrame(CHOSEN, TURN), spark.createDataFrame(REJECTED, TURN)
    row = P.format_pairs(c, r).where("pair_id = 1").first()
    a, b = map(int, row["chosen_mask"].split(":"))
    assert row["chosen"][a:b] == "yes" + P.CLOSE


def test_empty_and_native(spark):
    e = spark.createDataFrame([], TURN)
    out = P.format_pairs(e, e)
    assert out.count() == 0
    assert not re.search("Python|Arrow|Pandas", out._jdf.queryExecution().toString())


def test_query_matches_sql_with_odd_rows(spark, tmp_path):
    rows = [(0, 0, "user", "q"), (0, 1, "assistant", "a0"), (1, 0, "user", "q"), (1, 1, "assistant", "a1"),
            (1, 2, "user", "tail"), (2, 0, "user", "no answer"), (3, 0, "assistant", "a3"), (4, 0, "assistant", "alone"),
            (6, 0, "system", None), (6, None, "assistant", "x"), (6, 1, "assistant", "<|y"), (7, 1, "assistant", "<|y"),
            (7, 1, "assistant", "<|y"), (None, 0, "assistant", "z"), (8, 0, None, "n"), (8, 300, "assistant", "far"),
            (9, 0, "assistant", "")]
    path = f"{tmp_path}/conversations.parquet"
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(path)
    got = P.op9(spark, str(tmp_path)).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{path}/*.parquet')")
    want = con.execute(P.OP9_SQL).df()[list(got.columns)]
    key = lambda d: sorted(d.astype(object).where(d.notna(), None).itertuples(index=False, name=None), key=repr)
    assert [tuple(str(x) for x in r) for r in key(got)] == [tuple(str(x) for x in r) for r in key(want)] or \
        sorted(map(str, key(got.astype(str)))) == sorted(map(str, key(want.astype(str))))
