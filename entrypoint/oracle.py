"""The same results in plain SQL over the driver's tables, written independently of the library."""

from __future__ import annotations

MODELS = (
    "Linear_Regression",
    "Logistic_Regression",
    "Decision_Tree",
    "Random_Forest",
    "Gradient_Boosting",
    "LightGBM",
    "Extra_Trees",
    "SVM",
)
SETS = ("all", "traditional", "alternative")


def r(expr: str, places: int = 6) -> str:
    return f"round(CAST({expr} AS DOUBLE) + 3.7e-{places + 2}::DOUBLE, {places}) + 0.0::DOUBLE"


def u(key: str, seed: object) -> str:
    return f"(CAST('0x' || substr(md5(({key})::VARCHAR || ':{seed}'), 1, 8) AS UBIGINT) / 4294967296.0::DOUBLE)"


# ---- the loan sources ------------------------------------------------------------------------

TARGET = f"""
per_customer AS (SELECT o_custkey, avg(o_totalprice) AS price, count(*) AS cnt FROM orders GROUP BY o_custkey),
t_base AS (
  SELECT c_custkey, c_acctbal, coalesce(price, 0.0::DOUBLE) AS price, coalesce(cnt, 0)::DOUBLE AS cnt
  FROM customer LEFT JOIN per_customer ON c_custkey = o_custkey),
t_z AS (
  SELECT avg(price) AS mp, stddev_pop(price) AS sp, avg(cnt) AS mc, stddev_pop(cnt) AS sc,
         avg(c_acctbal) AS ma, stddev_pop(c_acctbal) AS sa FROM t_base),
target AS (
  SELECT c_custkey AS SK_ID_CURR,
    CAST({u('c_custkey', 42)} < 1.0::DOUBLE / (1.0::DOUBLE + exp(
      3.0::DOUBLE - (price - mp) / sp + 0.8::DOUBLE * ((cnt - mc) / sc) - 0.8::DOUBLE * ((c_acctbal - ma) / sa))) AS INTEGER) AS TARGET
  FROM t_base, t_z)"""

APPLICATION = f"""
app_in AS (
  SELECT c_custkey AS SK_ID_CURR,
    c_acctbal + 1500.0::DOUBLE AS AMT_INCOME_TOTAL,
    ((c_custkey * 7919) % 90000 + 1000)::DOUBLE AS AMT_CREDIT,
    CASE WHEN c_nationkey <> 3 THEN ((c_custkey * 31) % 4000 + 100)::DOUBLE END AS AMT_ANNUITY,
    CASE WHEN c_nationkey <> 5 THEN ((c_custkey * 7907) % 80000)::DOUBLE END AS AMT_GOODS_PRICE,
    -(7000 + (c_custkey * 37) % 18000) AS DAYS_BIRTH,
    CASE WHEN c_custkey % 11 = 0 THEN 365243 ELSE -((c_custkey * 53) % 9000) END AS DAYS_EMPLOYED,
    CASE WHEN c_custkey % 7 <> 0 THEN (c_acctbal + 1000.0::DOUBLE) / 11000.0::DOUBLE END AS EXT_SOURCE_1,
    CASE WHEN c_custkey % 13 <> 0 THEN {u('c_custkey', 'ext')} END AS EXT_SOURCE_2,
    CASE WHEN c_custkey % 5 >= 2 THEN (c_custkey * 17 % 100) / 100.0::DOUBLE END AS EXT_SOURCE_3,
    n_regionkey + 1 AS REGION_RATING_CLIENT,
    (c_custkey % 2)::INTEGER AS FLAG_PHONE,
    (c_custkey % 4)::INTEGER AS CNT_CHILDREN,
    CASE WHEN c_nationkey <> 7 THEN c_mktsegment END AS NAME_SEGMENT,
    n_name AS ORGANIZATION_NATION,
    CASE WHEN c_custkey % 3 = 0 THEN 'Y' ELSE 'N' END AS FLAG_OWN_CAR
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
app_derived AS (
  SELECT *,
    AMT_CREDIT / nullif(AMT_INCOME_TOTAL + 1, 0) AS CREDIT_INCOME_RATIO,
    AMT_ANNUITY / nullif(AMT_INCOME_TOTAL + 1, 0) AS ANNUITY_INCOME_RATIO,
    AMT_CREDIT / nullif(AMT_GOODS_PRICE + 1, 0) AS CREDIT_GOODS_RATIO,
    -DAYS_BIRTH / 365.25::DOUBLE AS AGE_YEARS,
    greatest(-DAYS_EMPLOYED / 365.25::DOUBLE, 0.0::DOUBLE) AS EMPLOYMENT_YEARS,
    DAYS_EMPLOYED::DOUBLE / nullif(DAYS_BIRTH + 1, 0) AS DAYS_EMPLOYED_PERCENT,
    list_avg([EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3]) AS EXT_SOURCE_MEAN,
    list_stddev_samp([EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3]) AS EXT_SOURCE_STD,
    least(EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3) AS EXT_SOURCE_MIN,
    greatest(EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3) AS EXT_SOURCE_MAX
  FROM app_in)"""

APP_NUMERIC = (
    "AMT_INCOME_TOTAL AMT_CREDIT AMT_ANNUITY AMT_GOODS_PRICE DAYS_BIRTH DAYS_EMPLOYED EXT_SOURCE_1 EXT_SOURCE_2 "
    "EXT_SOURCE_3 REGION_RATING_CLIENT FLAG_PHONE CNT_CHILDREN"
).split()
APP_DERIVED = (
    "CREDIT_INCOME_RATIO ANNUITY_INCOME_RATIO CREDIT_GOODS_RATIO AGE_YEARS EMPLOYMENT_YEARS DAYS_EMPLOYED_PERCENT "
    "EXT_SOURCE_MEAN EXT_SOURCE_STD EXT_SOURCE_MIN EXT_SOURCE_MAX"
).split()
APP_INT = {"DAYS_BIRTH", "DAYS_EMPLOYED", "REGION_RATING_CLIENT", "FLAG_PHONE", "CNT_CHILDREN"}
TEXT = ("NAME_SEGMENT", "ORGANIZATION_NATION", "FLAG_OWN_CAR")

STATUS = """
status AS (
  SELECT l_orderkey AS SK_ID_BUREAU, min(-l_linenumber) AS BB_MONTHS_BALANCE_min, max(-l_linenumber) AS BB_MONTHS_BALANCE_max,
    avg(-l_linenumber) AS BB_MONTHS_BALANCE_mean, count(*) FILTER (l_returnflag = 'N') AS BB_STATUS_good
  FROM lineitem GROUP BY l_orderkey)"""

BUREAU = """
bureau AS (
  SELECT o_custkey AS SK_ID_CURR, o_orderkey AS SK_ID_BUREAU,
    date_diff('day', DATE '2002-01-01', o_orderdate::DATE) AS DAYS_CREDIT, o_totalprice AS AMT_CREDIT_SUM,
    CASE WHEN o_orderstatus <> 'F' THEN o_totalprice * 0.5::DOUBLE END AS AMT_CREDIT_SUM_DEBT
  FROM orders)"""
BUREAU_COLS = ("DAYS_CREDIT", "AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT")
BB_COLS = ("BB_MONTHS_BALANCE_min", "BB_MONTHS_BALANCE_max", "BB_MONTHS_BALANCE_mean", "BB_STATUS_good")
PREV = """
prev AS (
  SELECT o_custkey AS SK_ID_CURR, o_totalprice * 0.25::DOUBLE AS AMT_APPLICATION,
    substr(o_orderpriority, 1, 1)::BIGINT AS CNT_PAYMENT FROM orders)"""
PREV_COLS = ("AMT_APPLICATION", "CNT_PAYMENT")
CARD = """
card AS (
  SELECT user_id AS SK_ID_CURR, value AS AMT_BALANCE, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS SK_DPD_DEF
  FROM events)"""
CARD_COLS = ("AMT_BALANCE", "SK_DPD_DEF")
POS = "pos AS (SELECT user_id AS SK_ID_CURR, hour(ts) AS CNT_INSTALMENT FROM events)"
POS_COLS = ("CNT_INSTALMENT",)
INST = """
inst AS (
  SELECT *, AMT_PAYMENT - AMT_INSTALMENT AS PAYMENT_DIFF,
    AMT_PAYMENT / nullif(AMT_INSTALMENT + 0.0001::DOUBLE, 0) AS PAYMENT_RATIO
  FROM (
    SELECT o_custkey AS SK_ID_CURR, l_linenumber AS NUM_INSTALMENT_NUMBER, l_extendedprice AS AMT_INSTALMENT,
      CASE WHEN l_discount <> 0.1::DOUBLE THEN l_extendedprice * (1.0::DOUBLE - l_discount) END AS AMT_PAYMENT
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey))"""
INST_COLS = ("NUM_INSTALMENT_NUMBER", "AMT_INSTALMENT", "AMT_PAYMENT", "PAYMENT_DIFF", "PAYMENT_RATIO")


def roll(source: str, prefix: str, cols: tuple[str, ...], key: str = "SK_ID_CURR") -> str:
    parts = [
        f"coalesce({fn}({c})::DOUBLE, 0.0::DOUBLE) AS {prefix}_{c}_{s}"
        for c in cols
        for s, fn in (("mean", "avg"), ("max", "max"), ("min", "min"))
    ]
    return f"SELECT {key}, {', '.join(parts)} FROM {source} WHERE {key} IS NOT NULL GROUP BY {key}"


def rolled(prefix: str, cols: tuple[str, ...]) -> list[str]:
    return [f"{prefix}_{c}_{s}" for c in cols for s in ("mean", "max", "min")]


HISTORY = f"""{STATUS}, {BUREAU},
history AS ({roll('(SELECT * FROM bureau LEFT JOIN status USING (SK_ID_BUREAU))', 'BUREAU', BUREAU_COLS + BB_COLS)})"""
HISTORY_PLAIN = f"{BUREAU}, history AS ({roll('bureau', 'BUREAU', BUREAU_COLS)})"

SIDE_COLS = (
    rolled("BUREAU", BUREAU_COLS + BB_COLS)
    + rolled("PREV", PREV_COLS)
    + rolled("CC", CARD_COLS)
    + rolled("POS", POS_COLS)
    + rolled("INST", INST_COLS)
)
MART_NUMERIC = APP_NUMERIC + APP_DERIVED + SIDE_COLS
MART = f"""{TARGET}, {APPLICATION}, {HISTORY}, {PREV}, {CARD}, {POS}, {INST},
prev_r AS ({roll('prev', 'PREV', PREV_COLS)}), card_r AS ({roll('card', 'CC', CARD_COLS)}),
pos_r AS ({roll('pos', 'POS', POS_COLS)}), inst_r AS ({roll('inst', 'INST', INST_COLS)}),
mart AS (
  SELECT * FROM app_derived JOIN target USING (SK_ID_CURR) LEFT JOIN history USING (SK_ID_CURR)
  LEFT JOIN prev_r USING (SK_ID_CURR) LEFT JOIN card_r USING (SK_ID_CURR) LEFT JOIN pos_r USING (SK_ID_CURR)
  LEFT JOIN inst_r USING (SK_ID_CURR))"""


# DAYS_BIRTH and DAYS_EMPLOYED are bigint, the three small codes int
def typed(names: list[str], places: int = 4) -> str:
    out = []
    for c in names:
        if c in ("REGION_RATING_CLIENT", "FLAG_PHONE", "CNT_CHILDREN"):
            out.append(f"{c}::INTEGER AS {c}")
        elif c in APP_INT:
            out.append(f"{c}::BIGINT AS {c}")
        else:
            out.append(f"{r(c, places)} AS {c}")
    return ", ".join(out)


ORACLE: dict[str, str] = {}

ORACLE["monthly_status_rollup"] = f"""WITH {STATUS} SELECT SK_ID_BUREAU, BB_MONTHS_BALANCE_min::BIGINT AS BB_MONTHS_BALANCE_min,
  BB_MONTHS_BALANCE_max::BIGINT AS BB_MONTHS_BALANCE_max, {r('BB_MONTHS_BALANCE_mean')} AS BB_MONTHS_BALANCE_mean, BB_STATUS_good FROM status"""


def _rounded_roll(cte: str, body: str, cols: list[str], places: int) -> str:
    return f"WITH {cte}, res AS ({body}) SELECT SK_ID_CURR, {', '.join(f'{r(c, places)} AS {c}' for c in cols)} FROM res"


ORACLE["credit_history_rollup"] = _rounded_roll(HISTORY, "SELECT * FROM history", rolled("BUREAU", BUREAU_COLS + BB_COLS), 4)
ORACLE["orders_rollup"] = _rounded_roll(PREV, roll("prev", "PREV", PREV_COLS), rolled("PREV", PREV_COLS), 4)
ORACLE["events_rollup"] = _rounded_roll(CARD, roll("card", "CC", CARD_COLS), rolled("CC", CARD_COLS), 6)
ORACLE["payment_features"] = _rounded_roll(INST, roll("inst", "INST", INST_COLS), rolled("INST", INST_COLS), 4)
ORACLE["applicant_mart"] = f"WITH {MART} SELECT SK_ID_CURR, TARGET, {', '.join(TEXT)}, {typed(MART_NUMERIC)} FROM mart"
ORACLE["mart_optional_source"] = f"""WITH {TARGET}, {APPLICATION}, {HISTORY_PLAIN}, {PREV}, {INST},
prev_r AS ({roll('prev', 'PREV', PREV_COLS)}), inst_r AS ({roll('inst', 'INST', INST_COLS)})
SELECT SK_ID_CURR, TARGET, {', '.join(TEXT)},
  {typed(APP_NUMERIC + APP_DERIVED + rolled('BUREAU', BUREAU_COLS) + rolled('PREV', PREV_COLS) + rolled('INST', INST_COLS))}
FROM app_derived JOIN target USING (SK_ID_CURR) LEFT JOIN history USING (SK_ID_CURR) LEFT JOIN prev_r USING (SK_ID_CURR)
LEFT JOIN inst_r USING (SK_ID_CURR)"""

for _name, _cols in (
    ("derived_ratios", APP_DERIVED[:3]),
    ("derived_years", APP_DERIVED[3:6]),
    ("row_score_stats", APP_DERIVED[6:]),
):
    ORACLE[_name] = f"WITH {APPLICATION} SELECT SK_ID_CURR, {', '.join(f'{r(c)} AS {c}' for c in _cols)} FROM app_derived"

ORACLE["clean_nonfinite"] = f"""WITH {APPLICATION}
SELECT SK_ID_CURR,
  {r("CASE WHEN REGION_RATING_CLIENT = 1 THEN 0.0 ELSE AMT_INCOME_TOTAL / (REGION_RATING_CLIENT - 1) END")} AS RATIO_INF,
  {r("CASE WHEN REGION_RATING_CLIENT = 2 THEN 0.0 ELSE AMT_CREDIT END")} AS RATIO_NAN,
  {r("coalesce(AMT_ANNUITY, 0.0)")} AS AMT_ANNUITY, coalesce(NAME_SEGMENT, '0') AS NAME_SEGMENT
FROM app_in"""

# ---- skew and power transform ----------------------------------------------------------------

NAMED_CANDIDATES = {"DAYS_EMPLOYED", "CREDIT_INCOME_RATIO", "ANNUITY_INCOME_RATIO", "CREDIT_GOODS_RATIO"}
CANDIDATES = [c for c in MART_NUMERIC if "AMT_" in c or c in NAMED_CANDIDATES]

ORACLE["skew_profile"] = (
    f"WITH {MART}, skews AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS n, CASE WHEN max(coalesce({c}, 0)) = min(coalesce({c}, 0)) THEN 0.0 "
        f"ELSE skewness(coalesce({c}, 0)::DOUBLE) END AS skew FROM mart"
        for c in CANDIDATES
    )
    + f') SELECT "column", n, {r("skew")} AS skew, CAST(abs(skew) > 0.5 AS INTEGER) AS chosen FROM skews'
)


def yj(x: str, lam: str) -> str:
    return f"""CASE WHEN {x} >= 0 THEN CASE WHEN {lam} = 0 THEN ln(1 + {x}) ELSE (pow({x} + 1.0::DOUBLE, {lam}) - 1) / {lam} END
      ELSE CASE WHEN {lam} = 2 THEN -ln(1 - ({x})) ELSE -(pow(1.0::DOUBLE - ({x}), 2.0::DOUBLE - {lam}) - 1) / (2.0::DOUBLE - {lam}) END END"""


ORACLE["yeo_johnson_grid"] = f"""
WITH cells AS (
  SELECT 'l_extendedprice' AS c, l_extendedprice AS x FROM lineitem
  UNION ALL SELECT 'l_quantity', l_quantity FROM lineitem),
grid AS (SELECT -1.0::DOUBLE + 3.0::DOUBLE * i / 20 AS lam FROM range(21) g(i)),
stats AS (
  SELECT c, lam, count(*) AS n, sum(sign(x) * ln(1 + abs(x))) AS jac, var_pop({yj('x', 'lam')}) AS v
  FROM cells, grid GROUP BY c, lam)
SELECT c AS "column", {r('lam', 4)} AS lambda, {r('-n / 2.0::DOUBLE * ln(v) + (lam - 1) * jac', 2)} AS loglik FROM stats"""

ORACLE["yeo_johnson_apply"] = (
    "WITH e AS (SELECT event_id, value - 20.0::DOUBLE AS v FROM events) SELECT event_id, "
    + ", ".join(
        f"{r(yj('v', f'({lam}::DOUBLE)'))} AS {n}"
        for n, lam in (("half", 0.5), ("zero", 0.0), ("two", 2.0), ("minus", -0.25))
    )
    + " FROM e"
)

# ---- categories and families -----------------------------------------------------------------


def text_counts(cols: tuple[str, ...]) -> str:
    cells = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", coalesce({c}, '0') AS value FROM app_in" for c in cols)
    return f"""{APPLICATION}, counts AS (SELECT "column", value, count(*) AS cnt FROM ({cells}) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY cnt DESC, value) AS rank FROM counts)"""


ORACLE["category_profile"] = f"""WITH {text_counts(TEXT)}
SELECT "column", count(*) AS n_values, sum(cnt)::BIGINT AS n_rows FROM counts GROUP BY "column" """
ORACLE["top5_categories"] = f"""WITH {text_counts(TEXT)}
SELECT "column", value, cnt, rank::INTEGER AS rank FROM ranked WHERE rank <= 5"""
ORACLE["label_encode_binary"] = f"""WITH {APPLICATION},
codes AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS code FROM (SELECT DISTINCT FLAG_OWN_CAR AS value FROM app_in))
SELECT SK_ID_CURR, code::INTEGER AS FLAG_OWN_CAR FROM app_in JOIN codes ON FLAG_OWN_CAR = value"""
ORACLE["one_hot_top5"] = f"""WITH {text_counts(TEXT[:2])},
cells AS (
  SELECT SK_ID_CURR, 'NAME_SEGMENT' AS "column", coalesce(NAME_SEGMENT, '0') AS own FROM app_in
  UNION ALL SELECT SK_ID_CURR, 'ORGANIZATION_NATION', coalesce(ORGANIZATION_NATION, '0') FROM app_in)
SELECT SK_ID_CURR, "column" || '_' || value AS feature, CAST(own = value AS INTEGER) AS flag
FROM cells JOIN ranked USING ("column") WHERE rank <= 5"""

# Name parts that mark a family
ALT_PARTS = ("FLAG_", "EXT_SOURCE", "REGION_", "OBS_", "DEF_", "EMAIL", "PHONE", "MOBIL", "SOCIAL")
TRAD_PARTS = ("AMT_", "DAYS_", "CNT_", "CREDIT", "INCOME", "BUREAU_", "PREV_", "ANNUITY")


def sql_family(name: str) -> str:
    alt = " OR ".join(f"contains(upper({name}), '{p}')" for p in ALT_PARTS)
    trad = " OR ".join(f"contains(upper({name}), '{p}')" for p in TRAD_PARTS)
    return f"CASE WHEN ({alt}) AND NOT ({trad}) THEN 'alternative' ELSE 'traditional' END"


ORACLE["feature_family"] = (
    f"WITH {MART}, means AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS name, {i} AS pos, avg(coalesce({c}, 0)::DOUBLE) AS mean FROM mart" for i, c in enumerate(MART_NUMERIC)
    )
    + f") SELECT name, {sql_family('name')} AS family, pos::INTEGER AS pos, {r('mean', 3)} AS mean FROM means"
)

ALTERNATIVE = [
    "EXT_SOURCE_1",
    "EXT_SOURCE_2",
    "EXT_SOURCE_3",
    "REGION_RATING_CLIENT",
    "FLAG_PHONE",
    "EXT_SOURCE_MEAN",
    "EXT_SOURCE_STD",
    "EXT_SOURCE_MIN",
    "EXT_SOURCE_MAX",
    "CC_SK_DPD_DEF_mean",
    "CC_SK_DPD_DEF_max",
    "CC_SK_DPD_DEF_min",
]
ORACLE["feature_set_columns"] = (
    f"WITH {MART}, filled AS (SELECT SK_ID_CURR, "
    + ", ".join(f"coalesce({c}, 0) AS {c}" for c in ALTERNATIVE)
    + f" FROM mart) SELECT SK_ID_CURR, {typed(ALTERNATIVE, 6)} FROM filled"
)

# ---- split, scale, oversample ----------------------------------------------------------------

# floor of each class share; the rows still missing go to the largest remainders
SPLIT = f"""{TARGET},
sizes AS (SELECT TARGET, count(*) AS k, sum(count(*)) OVER () AS n FROM target GROUP BY TARGET),
shares AS (SELECT TARGET, k, n, (n - ceil(0.2::DOUBLE * n)) AS n_train, (n - ceil(0.2::DOUBLE * n)) * k / n AS share FROM sizes),
quotas AS (
  SELECT TARGET, k, floor(share) + CASE WHEN row_number() OVER (ORDER BY share - floor(share) DESC, TARGET)
    <= n_train - sum(floor(share)) OVER () THEN 1 ELSE 0 END AS quota FROM shares),
split AS (
  SELECT SK_ID_CURR, TARGET, CAST(row_number() OVER (
      PARTITION BY TARGET ORDER BY md5(SK_ID_CURR::VARCHAR || ':42'), SK_ID_CURR) > quota AS INTEGER) AS is_val
  FROM target JOIN quotas USING (TARGET))"""

ORACLE["class_balance"] = f"WITH {TARGET} SELECT TARGET, count(*) AS cnt FROM target GROUP BY TARGET"
ORACLE["stratified_split"] = f"WITH {SPLIT} SELECT SK_ID_CURR, TARGET, is_val FROM split"

SCALED = """
cells AS (SELECT vec_id, unnest(range(64)) AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings),
fit AS (SELECT pos, avg(x) AS m, stddev_pop(x) AS s FROM cells GROUP BY pos),
scaled AS (SELECT vec_id, pos, CASE WHEN s > 0 THEN (x - m) / s ELSE 0 END AS z FROM cells JOIN fit USING (pos))"""
ORACLE["standard_scale"] = f"WITH {SCALED} SELECT vec_id, pos::INTEGER AS pos, {r('z')} AS value FROM scaled"

NEIGHBORS = """
rare AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings WHERE label = 0),
pairs AS (
  SELECT a, b, distance, row_number() OVER (PARTITION BY a ORDER BY distance, b) AS rank
  FROM (SELECT p.id AS a, q.id AS b, list_distance(p.v, q.v) AS distance FROM rare p JOIN rare q ON p.id <> q.id)
  QUALIFY rank <= 5)"""
ORACLE["minority_neighbors"] = f"WITH {NEIGHBORS} SELECT a, b, rank::INTEGER AS rank, {r('distance')} AS distance FROM pairs"

SMOTE = f"""{NEIGHBORS},
sizes AS (SELECT count(*) FILTER (label = 0) AS n_minor, count(*) FILTER (label <> 0) AS n_major FROM embeddings),
draws AS (
  SELECT i, CAST('0x' || substr(md5(i::VARCHAR || ':42:pick'), 1, 15) AS UBIGINT) % (n_minor * 5)::UBIGINT AS pick,
    {u('i', '42:step')} AS u
  FROM sizes, range((SELECT trunc(0.5::DOUBLE * n_major - n_minor)::BIGINT FROM sizes)) g(i)),
numbered AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS j FROM rare),
made AS (
  SELECT i, a, b, u, list_transform(list_zip(p.v, q.v), lambda e: e[1] + u * (e[2] - e[1])) AS v
  FROM draws JOIN numbered ON pick // 5 = j JOIN pairs ON a = numbered.id AND rank = pick % 5 + 1
  JOIN rare p ON p.id = a JOIN rare q ON q.id = b)"""
ORACLE["smote_samples"] = f"""WITH {SMOTE}
SELECT i, a, b, {r('u')} AS u, {r('list_sum(v)')} AS total, {r('v[1]')} AS first FROM made"""
ORACLE["smote_balanced"] = f"""WITH {SMOTE}
SELECT vec_id, CAST(label = 0 AS INTEGER) AS TARGET, {r('list_sum(embedding::DOUBLE[])')} AS total FROM embeddings
UNION ALL SELECT -i - 1, 1, {r('list_sum(v)')} FROM made"""

# ---- fixed scores ----------------------------------------------------------------------------

SIGNALS = f"""{TARGET},
signals AS (
  SELECT SK_ID_CURR, TARGET, {r('price / 500000.0::DOUBLE')} AS trad, {r('(c_acctbal + 1000.0::DOUBLE) / 11000.0::DOUBLE')} AS alt
  FROM t_base JOIN target ON c_custkey = SK_ID_CURR)"""

_signal = {"all": "0.6::DOUBLE * trad + 0.4::DOUBLE * alt", "traditional": "trad", "alternative": "alt"}
SCORES = f"{SIGNALS}, scores AS (" + " UNION ALL ".join(
    f"SELECT SK_ID_CURR, TARGET, trad, alt, '{m}' AS model_name, '{s}' AS feature_set, "
    f"{r(f'{_signal[s]} + {0.05 * i!r}::DOUBLE * ' + u('SK_ID_CURR', m), 2 if i % 2 == 0 else 6)} AS score FROM signals"
    for i, m in enumerate(MODELS, start=1)
    for s in SETS
) + ")"


def sql_auc(source: str, by: str, name: str = "aucs") -> str:
    """Average ranks of the positives."""
    return f"""{name}_rank AS (
  SELECT {by}, TARGET, rank() OVER (PARTITION BY {by} ORDER BY score)
    + (count(*) OVER (PARTITION BY {by}, score) - 1) / 2.0::DOUBLE AS rk FROM {source}),
{name}_sum AS (
  SELECT {by}, count(*) FILTER (TARGET = 1) AS n_pos, count(*) FILTER (TARGET = 0) AS n_neg,
    sum(rk) FILTER (TARGET = 1) AS ranks FROM {name}_rank GROUP BY {by}),
{name} AS (
  SELECT {by}, n_pos, n_neg,
    (ranks - n_pos * (n_pos + 1) / 2.0::DOUBLE) / nullif(n_pos * n_neg, 0)::DOUBLE AS auc FROM {name}_sum)"""


def sql_accept(source: str, by: str, name: str = "acc", target: str = "0.05") -> str:
    part = f"PARTITION BY {by}" if by else ""
    cols = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""{name}_curve AS (
  SELECT {cols}SK_ID_CURR, score, row_number() OVER w AS n, sum(TARGET) OVER w AS bad, count(*) OVER ({part}) AS n_all
  FROM {source} WINDOW w AS ({part} ORDER BY score, SK_ID_CURR ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
{name}_pick AS (
  SELECT {cols}max(n_all) AS n_all, max(n) FILTER (bad::DOUBLE / n <= {target}::DOUBLE) AS best,
    greatest(1, floor(0.1::DOUBLE * max(n_all)))::BIGINT AS few FROM {name}_curve {group}),
{name} AS (
  SELECT {', '.join('p.' + c.strip() for c in by.split(',')) + ', ' if by else ''}p.n_all, c.n AS n_accepted, c.n::DOUBLE / p.n_all AS acceptance_rate,
    CASE WHEN best = p.n_all THEN 1.0::DOUBLE ELSE c.score END AS threshold, c.bad::DOUBLE / c.n AS actual_bad_rate,
    CAST(best IS NULL AS INTEGER) AS is_fallback
  FROM {name}_pick p JOIN {name}_curve c ON c.n = coalesce(best, few){''.join(f' AND p.{k.strip()} = c.{k.strip()}' for k in by.split(',')) if by else ''})"""


EXP = "model_name, feature_set"
ORACLE["auc_exact"] = f"WITH {SCORES}, {sql_auc('scores', EXP)} SELECT {EXP}, n_pos, n_neg, {r('auc', 9)} AS auc FROM aucs"
ORACLE["acceptance_curve"] = f"""WITH {SIGNALS}, one AS (SELECT *, trad AS score FROM signals), {sql_accept('one', '')}
SELECT SK_ID_CURR, n, bad::BIGINT AS bad, {r('bad::DOUBLE / n', 9)} AS bad_rate FROM acc_curve"""

_ACC_OUT = f"""n_all, n_accepted, {r('acceptance_rate', 9)} AS acceptance_rate, {r('threshold', 9)} AS threshold,
  {r('actual_bad_rate', 9)} AS actual_bad_rate, is_fallback FROM acc"""
ORACLE["acceptance_at_bad_rate"] = f"WITH {SCORES}, {sql_accept('scores', EXP)} SELECT {EXP}, {_ACC_OUT}"
ORACLE["acceptance_fallback"] = f"""WITH {SIGNALS},
one AS (SELECT SK_ID_CURR, TARGET,
  {r('0.5::DOUBLE * ' + u('SK_ID_CURR', 'reverse') + ' + 0.5::DOUBLE * (1 - TARGET)')} AS score FROM signals),
{sql_accept('one', '')} SELECT {_ACC_OUT}"""

METRICS = f"""{SCORES}, {sql_auc('scores', EXP)}, {sql_accept('scores', EXP)},
metrics AS (
  SELECT model_name, feature_set, auc AS auc_score, acceptance_rate, threshold, actual_bad_rate,
    CASE feature_set WHEN 'all' THEN 2 ELSE 1 END::INTEGER AS n_features FROM aucs JOIN acc USING (model_name, feature_set))"""
ORACLE["experiment_metrics"] = f"""WITH {METRICS} SELECT {EXP}, {r('auc_score', 9)} AS auc_score,
  {r('acceptance_rate', 9)} AS acceptance_rate, {r('threshold', 9)} AS threshold,
  {r('actual_bad_rate', 9)} AS actual_bad_rate, n_features FROM metrics"""


def sql_thresholds(score: str) -> str:
    return f"""{SIGNALS}, one AS (SELECT TARGET, {score} AS score FROM signals),
ends AS (SELECT min(score) AS lo, max(score) AS hi FROM one),
cuts AS (SELECT k, CASE WHEN k = 99 THEN hi ELSE lo + k * ((hi - lo) / 99) END AS threshold FROM ends, range(100) g(k)),
curve AS (
  SELECT k, threshold, avg(CAST(CAST(score > threshold AS INTEGER) = TARGET AS INTEGER)) AS accuracy
  FROM one, cuts GROUP BY k, threshold)"""


ORACLE["threshold_search"] = f"""WITH {sql_thresholds('0.6::DOUBLE * trad + 0.4::DOUBLE * alt')}
SELECT {r('CASE WHEN accuracy > 0 THEN threshold ELSE 0.5 END', 9)} AS threshold, {r('accuracy', 9)} AS accuracy
FROM curve ORDER BY curve.accuracy DESC, k LIMIT 1"""
ORACLE["threshold_curve"] = f"""WITH {sql_thresholds('alt')}
SELECT k::INTEGER AS k, {r('threshold', 9)} AS threshold, {r('accuracy', 9)} AS accuracy FROM curve"""
ORACLE["percentile_exact"] = f"""SELECT l_returnflag, count(*) AS n, {r('quantile_cont(l_extendedprice, 0.2)', 4)} AS percentile
FROM lineitem GROUP BY l_returnflag"""

# ---- thin files ------------------------------------------------------------------------------

CREDIT_SPACE = (
    "BUREAU_AMT_CREDIT_SUM_mean",
    "BUREAU_DAYS_CREDIT_min",
    "AMT_CREDIT",
    "AMT_INCOME_TOTAL",
    "CREDIT_GOODS_RATIO",
    "CNT_CHILDREN",
)
_space = ", ".join(f"coalesce({c}, 0)::DOUBLE AS {c}" for c in CREDIT_SPACE)
_fit = ", ".join(f"avg({c}) AS m{i}, stddev_pop({c}) AS s{i}" for i, c in enumerate(CREDIT_SPACE))
_z = [f"abs(({c} - m{i}) / s{i})" for i, c in enumerate(CREDIT_SPACE)]
ORACLE["thin_mask_family"] = f"""WITH {SPLIT}, {APPLICATION}, {HISTORY_PLAIN},
space AS (SELECT SK_ID_CURR, is_val, {_space} FROM app_derived JOIN split USING (SK_ID_CURR) LEFT JOIN history USING (SK_ID_CURR)),
fit AS (SELECT {_fit} FROM space WHERE is_val = 0),
sums AS (
  SELECT SK_ID_CURR, {' + '.join(_z[:2])} AS history_sum, {' + '.join([_z[0], *_z[1:5]])} AS amount_sum FROM space, fit WHERE is_val = 1),
rule1 AS (SELECT *, history_sum < 0.1::DOUBLE AS thin FROM sums),
edge AS (SELECT count(*) FILTER (thin) < 0.1::DOUBLE * count(*) AS few, quantile_cont(amount_sum, 0.2) AS cut FROM rule1),
rule2 AS (SELECT SK_ID_CURR, thin OR (few AND amount_sum < cut) AS thin FROM rule1, edge),
small AS (SELECT count(*) FILTER (thin) < 0.1::DOUBLE * count(*) AS few FROM rule2)
SELECT SK_ID_CURR, CAST(thin OR (few AND {u('SK_ID_CURR', 42)} < 0.15::DOUBLE) AS INTEGER) AS is_thin FROM rule2, small"""

for _name, _stat in (("thin_mask_std", "stddev_pop"), ("thin_mask_variance", "var_pop")):
    ORACLE[_name] = f"""WITH {SCALED}, spread AS (SELECT vec_id, {_stat}(z) AS s FROM scaled GROUP BY vec_id),
edge AS (SELECT quantile_cont(s, 0.2) AS cut FROM spread)
SELECT vec_id, CAST(s < cut AS INTEGER) AS is_thin FROM spread, edge"""

ORACLE["thin_mask_floor"] = f"""WITH f AS (SELECT c_custkey AS SK_ID_CURR, c_acctbal < -700 AS thin FROM customer),
small AS (SELECT count(*) FILTER (thin) < 0.1::DOUBLE * count(*) AS few FROM f)
SELECT SK_ID_CURR, CAST(thin OR (few AND {u('SK_ID_CURR', 42)} < 0.15::DOUBLE) AS INTEGER) AS is_thin FROM f, small"""

MASKS = """
edges AS (SELECT quantile_cont(trad, 0.2) AS low_trad, quantile_cont(alt, 0.2) AS low_alt FROM signals),
masks AS (
  SELECT SK_ID_CURR, TARGET, feature_set, CASE feature_set WHEN 'alternative' THEN alt < low_alt ELSE trad < low_trad END AS is_thin
  FROM signals, edges, (VALUES ('all'), ('traditional'), ('alternative')) f(feature_set))"""
ORACLE["thin_file_profile"] = f"""WITH {SIGNALS}, {MASKS}
SELECT feature_set, count(*) FILTER (is_thin) AS n_thin_file, count(*) FILTER (NOT is_thin) AS n_regular,
  {r('avg(is_thin::INTEGER)', 9)} AS share_thin_file, {r('avg(TARGET) FILTER (is_thin)', 9)} AS default_rate_thin_file,
  {r('avg(TARGET) FILTER (NOT is_thin)', 9)} AS default_rate_regular
FROM masks GROUP BY feature_set"""

SLICES = f"""{SCORES}, {MASKS},
flagged AS (SELECT s.* EXCLUDE (trad, alt), is_thin FROM scores s JOIN masks m USING (SK_ID_CURR, feature_set)),
{sql_auc('flagged', EXP + ', is_thin', 's_auc')}, {sql_accept('flagged', EXP + ', is_thin', 's_acc')},
sliced AS (
  SELECT {EXP}, CASE WHEN count(*) FILTER (is_thin) > 0 THEN max(auc) FILTER (is_thin) ELSE 0 END AS auc_thin_file,
    CASE WHEN count(*) FILTER (NOT is_thin) > 0 THEN max(auc) FILTER (NOT is_thin) ELSE 0 END AS auc_regular,
    coalesce(max(acceptance_rate) FILTER (is_thin), 0) AS acceptance_thin_file,
    coalesce(max(acceptance_rate) FILTER (NOT is_thin), 0) AS acceptance_regular
  FROM s_auc JOIN s_acc USING (model_name, feature_set, is_thin) GROUP BY {EXP})"""
ORACLE["thin_file_metrics"] = f"""WITH {SLICES} SELECT {EXP}, {r('auc_thin_file', 9)} AS auc_thin_file, {r('auc_regular', 9)} AS auc_regular,
  {r('auc_thin_file - auc_regular', 9)} AS auc_difference, {r('acceptance_thin_file', 9)} AS acceptance_thin_file,
  {r('acceptance_regular', 9)} AS acceptance_regular FROM sliced"""
_WIDE = """wide AS (
  SELECT model_name, max({v}) FILTER (feature_set = 'all') AS a, max({v}) FILTER (feature_set = 'traditional') AS t,
    max({v}) FILTER (feature_set = 'alternative') AS l, list(feature_set) AS present FROM {src} GROUP BY model_name)"""
ORACLE["thin_family_gain"] = f"""WITH {SLICES}, {_WIDE.format(v='auc_thin_file', src='sliced')}
SELECT model_name, 'alternative_vs_traditional' AS comparison, {r('l - t', 9)} AS gain, 0::INTEGER AS same_rows FROM wide WHERE l - t IS NOT NULL
UNION ALL SELECT model_name, 'all_vs_traditional', {r('a - t', 9)}, 1::INTEGER FROM wide WHERE a - t IS NOT NULL"""

ORACLE["thin_gain_summary"] = f"""WITH {SLICES}, {_WIDE.format(v='auc_thin_file', src='sliced')},
gains AS (
  SELECT model_name, 'alternative_vs_traditional' AS comparison, l - t AS gain FROM wide WHERE l - t IS NOT NULL
  UNION ALL SELECT model_name, 'all_vs_traditional', a - t FROM wide WHERE a - t IS NOT NULL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY comparison ORDER BY gain DESC, model_name) AS place FROM gains)
SELECT comparison, {r('avg(gain)', 9)} AS mean_gain, {r('max(gain)', 9)} AS max_gain,
  max(model_name) FILTER (place = 1) AS best_model FROM ranked GROUP BY comparison"""

# ---- reports ---------------------------------------------------------------------------------

IMPACT = f"""{SCORES}, edges AS (SELECT quantile_cont(trad, 0.2) AS low_trad FROM signals),
thin AS (SELECT s.* FROM scores s, edges WHERE trad < low_trad), {sql_auc('thin', EXP)},
{_WIDE.format(v='auc', src='aucs')},
impact AS (
  SELECT model_name AS model, t AS auc_traditional, l AS auc_alternative,
    CASE WHEN list_contains(present, 'all') THEN a ELSE 0 END AS auc_all, l - t AS improvement,
    (l - t) / nullif(t, 0) * 100 AS improvement_percent
  FROM wide WHERE list_contains(present, 'traditional') AND list_contains(present, 'alternative'))"""
ORACLE["alternative_impact"] = f"WITH {IMPACT} SELECT model, " + ", ".join(
    f"{r(c, 9)} AS {c}" for c in ("auc_traditional", "auc_alternative", "auc_all", "improvement", "improvement_percent")
) + " FROM impact"
ORACLE["impact_summary"] = f"""WITH {IMPACT}, best AS (SELECT model FROM impact ORDER BY improvement DESC NULLS LAST, model LIMIT 1)
SELECT {r('avg(improvement)', 9)} AS mean_improvement, {r('max(improvement)', 9)} AS max_improvement,
  (SELECT model FROM best) AS best_model FROM impact"""
ORACLE["family_difference"] = f"""WITH {METRICS}
SELECT model_name,
  {r("max(auc_score) FILTER (feature_set = 'alternative') - max(auc_score) FILTER (feature_set = 'traditional')", 9)} AS auc_difference,
  {r("max(acceptance_rate) FILTER (feature_set = 'alternative') - max(acceptance_rate) FILTER (feature_set = 'traditional')", 9)} AS acceptance_difference
FROM metrics GROUP BY model_name"""
for _name, _metric in (("metric_pivot", "auc_score"), ("acceptance_pivot", "acceptance_rate")):
    ORACLE[_name] = f"WITH {METRICS} SELECT model_name, " + ", ".join(
        f"""{r(f"avg({_metric}) FILTER (feature_set = '{s}')", 9)} AS "{s}" """ for s in SETS
    ) + " FROM metrics GROUP BY model_name"
ORACLE["avg_by_feature_set"] = f"""WITH {METRICS} SELECT feature_set, {r('avg(auc_score)', 9)} AS auc_score,
  {r('avg(acceptance_rate)', 9)} AS acceptance_rate FROM metrics GROUP BY feature_set"""
_CATEGORY = """CASE WHEN model_name IN ('Linear_Regression', 'Logistic_Regression') THEN 'Linear Model'
  WHEN model_name = 'SVM' THEN 'Others' ELSE 'Tree-based Model' END"""
ORACLE["model_report"] = f"""WITH {SLICES}, {sql_auc('scores', EXP)}, {sql_accept('scores', EXP)}
SELECT {_CATEGORY} AS category, {EXP}, {r('auc', 9)} AS auc_score, {r('acceptance_rate', 9)} AS acceptance_rate,
  {r('threshold', 9)} AS threshold, {r('actual_bad_rate', 9)} AS actual_bad_rate, {r('auc_thin_file', 9)} AS auc_thin_file,
  {r('auc_thin_file - auc_regular', 9)} AS auc_difference, {r('acceptance_thin_file', 9)} AS acceptance_thin_file
FROM aucs JOIN acc USING (model_name, feature_set) JOIN sliced USING (model_name, feature_set)"""
_TOP = "ORDER BY metrics.auc_score DESC, model_name, feature_set LIMIT"
ORACLE["top10_models"] = f"""WITH {METRICS} SELECT {EXP}, {r('auc_score', 9)} AS auc_score,
  {r('acceptance_rate', 9)} AS acceptance_rate FROM metrics {_TOP} 10"""
ORACLE["top5_models"] = f"WITH {METRICS} SELECT {EXP}, {r('auc_score', 9)} AS auc_score FROM metrics {_TOP} 5"
ORACLE["best_configuration"] = f"""WITH {SLICES}, {sql_auc('scores', EXP)}, {sql_accept('scores', EXP)},
o AS (SELECT 'overall' AS scope, {EXP}, auc, acceptance_rate FROM aucs JOIN acc USING (model_name, feature_set)
  ORDER BY auc DESC, model_name, feature_set LIMIT 1),
t AS (SELECT 'thin_file' AS scope, {EXP}, auc_thin_file AS auc, acceptance_thin_file AS acceptance_rate FROM sliced
  ORDER BY auc_thin_file DESC NULLS LAST, model_name, feature_set LIMIT 1)
SELECT scope, {EXP}, {r('auc', 9)} AS auc, {r('acceptance_rate', 9)} AS acceptance_rate FROM (SELECT * FROM o UNION ALL SELECT * FROM t)"""

# ---- prepared sets ---------------------------------------------------------------------------

ORACLE["prepared_roundtrip"] = f"""WITH {SPLIT},
parts AS (SELECT CASE is_val WHEN 1 THEN 'val' ELSE 'train' END AS part, TARGET, count(*) AS cnt FROM split GROUP BY ALL),
major AS (SELECT max(cnt) AS n_major FROM parts WHERE part = 'train'),
final AS (SELECT part, TARGET, CASE WHEN part = 'train' AND TARGET = 1 THEN cnt + trunc(0.5::DOUBLE * n_major - cnt)::BIGINT ELSE cnt END AS cnt FROM parts, major)
SELECT feature_set, part, TARGET, cnt::BIGINT AS cnt FROM final, (VALUES ('all'), ('traditional'), ('alternative')) f(feature_set)"""

ORACLE["prepared_digests"] = f"""SELECT feature_set, part, sum(cnt)::BIGINT AS n, 1::INTEGER AS unchanged
FROM ({ORACLE["prepared_roundtrip"]}) GROUP BY feature_set, part"""

_new_numeric = " UNION ALL ".join(
    f"SELECT SK_ID_CURR, is_val, '{c}' AS feature, coalesce({expr}, 0)::DOUBLE AS x FROM rows"
    for c, expr in (
        (c, {"AMT_CREDIT": yj("AMT_CREDIT", "(0.5::DOUBLE)"), "AMT_INCOME_TOTAL": yj("AMT_INCOME_TOTAL", "(0.25::DOUBLE)")}.get(c, c))
        for c in APP_NUMERIC + APP_DERIVED
    )
)
ORACLE["preprocess_new_rows"] = f"""WITH {SPLIT}, {APPLICATION},
rows AS (SELECT * FROM app_derived JOIN split USING (SK_ID_CURR)),
text AS (
  SELECT SK_ID_CURR, is_val, 'NAME_SEGMENT' AS c, coalesce(NAME_SEGMENT, '0') AS own FROM rows
  UNION ALL SELECT SK_ID_CURR, is_val, 'ORGANIZATION_NATION', coalesce(ORGANIZATION_NATION, '0') FROM rows),
top AS (
  SELECT c, own AS value FROM text WHERE is_val = 0 GROUP BY c, own
  QUALIFY row_number() OVER (PARTITION BY c ORDER BY count(*) DESC, own) <= 5),
cells AS (
  {_new_numeric}
  UNION ALL SELECT SK_ID_CURR, is_val, 'FLAG_OWN_CAR', CASE FLAG_OWN_CAR WHEN 'Y' THEN 1 ELSE 0 END FROM rows
  UNION ALL SELECT SK_ID_CURR, is_val, c || '_' || value, CAST(own = value AS INTEGER) FROM text JOIN top USING (c)),
fit AS (SELECT feature, avg(x) AS m, stddev_pop(x) AS s FROM cells WHERE is_val = 0 GROUP BY feature)
SELECT SK_ID_CURR, feature, {r('CASE WHEN s > 0 THEN (x - m) / s ELSE 0 END')} AS value FROM cells JOIN fit USING (feature) WHERE is_val = 1"""

ORACLE["model_roundtrip"] = f"""WITH {SPLIT}
SELECT count(*) AS n_rows, 0::BIGINT AS n_different FROM split WHERE is_val = 1"""
