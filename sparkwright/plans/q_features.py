"""Queries for attribute ratio, encoding, scaling, ids and splits
(A11-A17, H1-H5, H9-H11, F10, M14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwright.operators import attribute_ratio as AR
from sparkwright.operators import features as H
from sparkwright.operators import splits as S
from sparkwright.operators.votes import class_weights
from sparkwright.plans.q_profile import feat_once, round_doubles
from sparkwright.plans.q_relational import PRIORITY_GROUP
from sparkwright.plans.registry import query, with_ctes
from sparkwright.sources.tables import FEAT_BINARY, FEAT_NOMINAL, FEAT_NUMERIC, FEAT_SQL, feat, read_table

# Categories of the two nominal feature columns (sorted).
CATEGORIES = {"status": ["F", "O", "P"],
              "segment": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]}
ONE_HOT = [f"{c}_{v}" for c, vs in CATEGORIES.items() for v in vs]

_SEED = 42


def _hash_sql(key: str = "id", seed: int = _SEED) -> str:
    return f"substr(md5(CAST({key} AS VARCHAR) || '|{seed}'), 1, 8)"


def _one_hot_sql() -> str:
    return ", ".join(f"CAST(CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS DOUBLE) AS {c}_{v}"
                     for c, vs in CATEGORIES.items() for v in vs)


FEAT_OHE_SQL = "fo AS (SELECT *, " + _one_hot_sql() + " FROM feat)"


def feat_ohe(spark, sf):
    f = feat(spark, sf)
    out, _ = H.one_hot(f, CATEGORIES, drop_input=False)
    return out


# ------------------------------------------------------------ A11-A17


def _ar_sql(numeric, binary, label, where=""):
    w = f" WHERE {where}" if where else ""
    parts = []
    for i, c in enumerate(numeric):
        parts.append(f"""SELECT '{c}' AS feature, 'numeric' AS kind, {i} AS position,
  round(coalesce(max(k.m / nullif(g.m, 0)), 0.0), 6) AS ratio
FROM (SELECT avg({c}) AS m FROM fo{w} GROUP BY {label}) k, (SELECT avg({c}) AS m FROM fo{w}) g""")
    for j, c in enumerate(binary):
        parts.append(f"""SELECT '{c}' AS feature, 'binary' AS kind, {len(numeric) + j} AS position,
  round(max(coalesce(s / nullif(n - s, 0), 1000.0)), 6) AS ratio
FROM (SELECT sum({c}) AS s, count({c}) AS n FROM fo{w} GROUP BY {label})""")
    return "\nUNION ALL\n".join(parts)


_BIN_ALL = FEAT_BINARY + ONE_HOT


@query("agg_attr_ratio_numeric", with_ctes(FEAT_SQL, FEAT_OHE_SQL, _ar_sql(FEAT_NUMERIC, [], "label_group")))
def agg_attr_ratio_numeric(spark, sf):
    return round_doubles(AR.attribute_ratio(feat_ohe(spark, sf), FEAT_NUMERIC, [], "label_group"))


@query("agg_attr_ratio_binary", with_ctes(FEAT_SQL, FEAT_OHE_SQL, _ar_sql([], _BIN_ALL, "label_group")))
def agg_attr_ratio_binary(spark, sf):
    return round_doubles(AR.attribute_ratio(feat_ohe(spark, sf), [], _BIN_ALL, "label_group"))


_AR_ALL = with_ctes(FEAT_SQL, FEAT_OHE_SQL, f"ar AS ({_ar_sql(FEAT_NUMERIC, _BIN_ALL, 'label_group')})",
                    "SELECT feature, kind, position, ratio, row_number() OVER (ORDER BY ratio DESC, position) AS rank "
                    "FROM ar")


def _ratios(spark, sf):
    return round_doubles(AR.attribute_ratio(feat_ohe(spark, sf), FEAT_NUMERIC, _BIN_ALL, "label_group"))


@query("agg_attr_ratio_rank", _AR_ALL)
def agg_attr_ratio_rank(spark, sf):
    return AR.ranked(_ratios(spark, sf))


@query("agg_attr_ratio_select", with_ctes(
    FEAT_SQL, FEAT_OHE_SQL, f"ar AS ({_ar_sql(FEAT_NUMERIC, _BIN_ALL, 'label_group')})",
    "SELECT feature, kind, position, ratio FROM ar WHERE ratio >= 1.5"))
def agg_attr_ratio_select(spark, sf):
    return AR.select_features(_ratios(spark, sf), 1.5)


@query("agg_attr_ratio_subset", with_ctes(
    FEAT_SQL, FEAT_OHE_SQL,
    _ar_sql(FEAT_NUMERIC, _BIN_ALL, "label_group", "label_group = 'A' OR label_group = 'normal'")))
def agg_attr_ratio_subset(spark, sf):
    sub = feat_ohe(spark, sf).where(F.col("label_group").isin("A", "normal"))
    return round_doubles(AR.attribute_ratio(sub, FEAT_NUMERIC, _BIN_ALL, "label_group"))


# ------------------------------------------------------------ H1-H3


@query("feat_label_binary", with_ctes(FEAT_SQL, """
SELECT id, label_group, CASE WHEN starts_with(label_group, 'normal') THEN label_group ELSE 'attack' END AS labels2
FROM feat"""))
def feat_label_binary(spark, sf):
    f = feat(spark, sf).select("id", "label_group")
    return H.BinaryLabel(inputCol="label_group", outputCol="labels2").transform(f)


@query("feat_label_group", with_ctes(FEAT_SQL, """
SELECT id, raw_label, CASE raw_label WHEN '1-URGENT' THEN 'A' WHEN '2-HIGH' THEN 'B' WHEN '3-MEDIUM' THEN 'C'
                      WHEN '4-NOT SPECIFIED' THEN 'normal' WHEN '5-LOW' THEN 'normal' END AS labels5
FROM feat"""))
def feat_label_group(spark, sf):
    f = feat(spark, sf).select("id", "raw_label")
    return H.GroupLabel(inputCol="raw_label", outputCol="labels5", mapping=PRIORITY_GROUP,
                        unknown="error").transform(f)


@query("feat_string_index", with_ctes(FEAT_SQL, f"""
tr AS (SELECT * FROM feat WHERE {_hash_sql()} < 'cccccccc')""", """
idx AS (SELECT segment, CAST(row_number() OVER (ORDER BY count(*) DESC, segment) - 1 AS DOUBLE) AS segment_index
        FROM tr GROUP BY segment)""", """
SELECT f.id, f.segment, idx.segment_index FROM feat f LEFT JOIN idx ON f.segment = idx.segment"""))
def feat_string_index(spark, sf):
    f = feat(spark, sf).select("id", "segment")
    train = S.random_split(f, "id", [0.8, 0.2], _SEED)[0]
    return H.apply_index(f, H.frequency_index(train, "segment"), "segment", "segment_index")


@query("feat_one_hot", with_ctes(FEAT_SQL, f"""
SELECT id, CAST({_hash_sql()} >= 'cccccccc' AS INTEGER) AS is_test, {_one_hot_sql()} FROM feat"""))
def feat_one_hot(spark, sf):
    f = feat(spark, sf).select("id", *FEAT_NOMINAL)
    train, test = S.random_split(f, "id", [0.8, 0.2], _SEED)
    cats = H.fit_categories(train, FEAT_NOMINAL)
    # Train and test get the same fitted columns.
    both = train.withColumn("is_test", F.lit(0)).unionByName(test.withColumn("is_test", F.lit(1)))
    return H.one_hot(both, cats)[0]


# ------------------------------------------------------------ H4/H5


def _std_sql(with_mean: bool) -> str:
    stats = "st AS (SELECT " + ", ".join(
        f"avg({c}) AS {c}_avg, stddev_samp({c}) AS {c}_std" for c in FEAT_NUMERIC) + \
        f" FROM feat WHERE {_hash_sql()} < 'cccccccc')"
    cols = ", ".join(
        (f"round(coalesce(({c} - {c}_avg) / nullif({c}_std, 0), 0.0), 6) AS {c}" if with_mean
         else f"round(coalesce({c} / nullif({c}_std, 0), 0.0), 6) AS {c}") for c in FEAT_NUMERIC)
    return with_ctes(FEAT_SQL, stats, f"SELECT id, {cols} FROM feat, st")


def _standardized(spark, sf, with_mean):
    f = feat(spark, sf).select("id", *FEAT_NUMERIC)
    train = S.random_split(f, "id", [0.8, 0.2], _SEED)[0]
    stats = H.fit_standardizer(train, FEAT_NUMERIC)
    return round_doubles(H.standardize(f, stats, FEAT_NUMERIC, with_mean=with_mean))


@query("feat_standardize", _std_sql(True))
def feat_standardize(spark, sf):
    return _standardized(spark, sf, True)


@query("feat_scale_only", _std_sql(False))
def feat_scale_only(spark, sf):
    return _standardized(spark, sf, False)


# ------------------------------------------------------------ F10, M14


@query("feat_stable_id", """
SELECT doc_id, sha256(text) AS row_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS copy
FROM documents""")
def feat_stable_id(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id", "text")
    return H.stable_id(d, ["text"], ["doc_id"])


@query("feat_class_weights", with_ctes(FEAT_SQL, """
SELECT id, label2, CAST(CASE label2 WHEN 'attack' THEN 100 WHEN 'normal' THEN 1 END AS DOUBLE) AS weight FROM feat"""))
def feat_class_weights(spark, sf):
    return class_weights(feat(spark, sf).select("id", "label2"), "label2", {"attack": 100, "normal": 1})


# ------------------------------------------------------------ H9-H11


@query("split_random", with_ctes(FEAT_SQL, f"""
SELECT id, CAST({_hash_sql()} < '{S.hex_threshold(0.2)}' AS INTEGER) AS is_test FROM feat"""))
def split_random(spark, sf):
    return S.assign_split(feat(spark, sf).select("id"), "id", 0.2, _SEED)


@query("split_stratified", with_ctes(FEAT_SQL, f"""
h AS (SELECT id, label2, {_hash_sql()} AS h, count(*) OVER (PARTITION BY label2) AS n FROM feat)""", """
SELECT id, label2, CAST(row_number() OVER (PARTITION BY label2 ORDER BY h, id) <= round(n * 0.33) AS INTEGER) AS is_test
FROM h"""))
def split_stratified(spark, sf):
    return S.stratified_split(feat_once(spark, sf, ["id", "label2"]), "id", "label2", 0.33, _SEED)


_SAMPLE_FRACTIONS = {"A": 0.5, "B": 0.25, "C": 0.1, "normal": 0.05}


@query("split_sample_by", with_ctes(FEAT_SQL, f"""
SELECT id, label_group FROM feat
WHERE {_hash_sql()} < CASE label_group """ + " ".join(
    f"WHEN '{k}' THEN '{S.hex_threshold(v)}'" for k, v in _SAMPLE_FRACTIONS.items()) + " END"))
def split_sample_by(spark, sf):
    return S.sample_by(feat(spark, sf).select("id", "label_group"), "id", "label_group", _SAMPLE_FRACTIONS, _SEED)
