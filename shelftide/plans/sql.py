"""The same queries as DuckDB SQL over the same tables."""

from __future__ import annotations

# Fixed values, spelled out here and not taken from the code under test.
LABEL_ORDER = {
    "category": ("Clothing", "Electronics", "Furniture", "Groceries", "Toys"),
    "region": ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"),
    "weather_condition": ("Sunny", "Cloudy", "Rainy", "Snowy"),
    "seasonality": ("Spring", "Summer", "Autumn", "Winter"),
}
DEFAULT_REGIONS = ("East", "North", "South", "West")
LABEL_NAMES = {
    "category": "category_encoded",
    "region": "region_encoded",
    "weather_condition": "weather_encoded",
    "seasonality": "seasonality_encoded",
}
ID_NAMES = {"store_id": "store_id_encoded", "product_id": "product_id_encoded"}
RANGES = {
    "inventory_level": (50, 500),
    "units_sold": (0, 499),
    "units_ordered": (20, 200),
    "demand_forecast": (-9.99, 518.55),
    "price": (10.0, 100.0),
    "discount": (0, 20),
    "competitor_pricing": (5.03, 104.94),
}
RAW_NAMES_OF = {
    "Date": "date",
    "Store ID": "store_id",
    "Product ID": "product_id",
    "Category": "category",
    "Region": "region",
    "Inventory Level": "inventory_level",
    "Units Sold": "units_sold",
    "Units Ordered": "units_ordered",
    "Demand Forecast": "demand_forecast",
    "Price": "price",
    "Discount": "discount",
    "Weather Condition": "weather_condition",
    "Holiday/Promotion": "is_holiday_or_promo",
    "Competitor Pricing": "competitor_pricing",
    "Seasonality": "seasonality",
}
CLEAN_NAMES = (
    "date store_id product_id category region inventory_level units_sold units_ordered demand_forecast "
    "is_forecast_anomaly price discount weather_condition is_holiday_or_promo competitor_pricing seasonality"
).split()
PREDICTION_NAMES = "date store_id product_id category region units_sold demand_forecast predicted_units_sold".split()
# 32 model inputs of the enhanced variant, in training order.
MODEL_INPUTS = (
    "inventory_level units_ordered price discount competitor_pricing effective_price price_to_competitor_ratio "
    "has_discount is_holiday_or_promo day_of_week month week_of_year quarter day_of_month is_weekend "
    "category_encoded region_encoded weather_encoded seasonality_encoded store_id_encoded product_id_encoded "
    "lag_1 lag_7 lag_14 lag_28 rolling_mean_7 rolling_std_7 rolling_mean_14 rolling_std_14 rolling_mean_28 "
    "rolling_std_28 demand_forecast"
).split()
TREE_TEXT = (
    "checkpoint_interval=10,colsample_bytree=0.8,eval_metric=rmse,learning_rate=0.05,max_bins=256,max_depth=6,"
    "min_child_weight=5,n_estimators=300,objective=reg:squarederror,reg_alpha=0.1,reg_lambda=1.0,subsample=0.8,tree_method=hist"
)
NOT_APPLIED = ""
LEAD_DAYS, CYCLE_DAYS, SERVICE_Z = 7, 30, 1.65

PANEL = """
panel AS (
  SELECT date, 'S' || lpad(CAST(n_regionkey + 1 AS VARCHAR), 3, '0') AS store_id,
    'P' || lpad(CAST(product + 1 AS VARCHAR), 4, '0') AS product_id,
    CASE kind WHEN 0 THEN 'Clothing' WHEN 1 THEN 'Electronics' WHEN 2 THEN 'Furniture'
      WHEN 3 THEN 'Groceries' ELSE 'Toys' END AS category,
    r_name AS region,
    CAST(50 + order_keys % 451 AS INTEGER) AS inventory_level,
    CAST(sold AS INTEGER) AS units_sold,
    CAST(ordered AS INTEGER) AS units_ordered,
    round(planned - CAST(3 AS DOUBLE), 2) AS demand_forecast,
    unit_price / CAST(100 AS DOUBLE) AS price,
    CAST(round(top_discount * CAST(100 AS DOUBLE)) AS INTEGER) AS discount,
    CASE (day(date) + n_regionkey) % 4 WHEN 0 THEN 'Sunny' WHEN 1 THEN 'Cloudy'
      WHEN 2 THEN 'Rainy' ELSE 'Snowy' END AS weather_condition,
    CAST(top_discount >= CAST(0.09 AS DOUBLE) AS INTEGER) AS is_holiday_or_promo,
    CASE WHEN first_line = 7 THEN CAST(0 AS DOUBLE) ELSE top_retail / CAST(30 AS DOUBLE) END AS competitor_pricing,
    CASE WHEN month(date) BETWEEN 3 AND 5 THEN 'Spring' WHEN month(date) BETWEEN 6 AND 8 THEN 'Summer'
      WHEN month(date) BETWEEN 9 AND 11 THEN 'Autumn' ELSE 'Winter' END AS seasonality
  FROM (
    SELECT CAST(l_shipdate AS DATE) AS date, n_regionkey, r_name,
      l_partkey % 20 AS product, l_partkey % 5 AS kind,
      sum(l_orderkey) AS order_keys,
      sum(CASE WHEN l_returnflag = 'R' THEN CAST(0 AS DOUBLE) ELSE l_quantity END) AS sold,
      sum(l_quantity) AS ordered,
      sum(l_quantity * (CAST(1 AS DOUBLE) + l_tax - l_discount)) AS planned,
      min(l_extendedprice / l_quantity) AS unit_price,
      max(l_discount) AS top_discount, min(l_linenumber) AS first_line, max(p_retailprice) AS top_retail
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
      JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
      JOIN part ON l_partkey = p_partkey
    GROUP BY ALL)
)"""

CLEANED = PANEL + """,
cleaned AS (
  SELECT date, store_id, product_id, category, region, inventory_level, units_sold, units_ordered,
    demand_forecast, demand_forecast < 0 AS is_forecast_anomaly, price, discount, weather_condition,
    is_holiday_or_promo = 1 AS is_holiday_or_promo, competitor_pricing, seasonality
  FROM panel
)"""

LINES = """
lines AS (
  SELECT CAST(l_shipdate AS DATE) AS date, 'S' || lpad(CAST(n_regionkey + 1 AS VARCHAR), 3, '0') AS store_id,
    'P' || lpad(CAST(l_partkey AS VARCHAR), 12, '0') AS product_id, CAST(l_quantity AS INTEGER) AS units_ordered
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

KEYS = "date, store_id, product_id"
BY_DATE = "PARTITION BY store_id, product_id ORDER BY date"
SIZES = (7, 14, 28)
LAGS = (1, 7, 14, 28)


def label(column: str, values: tuple[str, ...]) -> str:
    cases = " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(values))
    return f"CAST(CASE {column} {cases} END AS INTEGER)"


def rank_label(column: str) -> str:
    return f"CAST(dense_rank() OVER (ORDER BY {column}) - 1 AS INTEGER)"


LABELS = ", ".join(f"{label(c, LABEL_ORDER[c])} AS {out}" for c, out in LABEL_NAMES.items())
IDS = ", ".join(f"{rank_label(c)} AS {out}" for c, out in ID_NAMES.items())
LAG = ", ".join(f"CAST(lag(units_sold, {n}) OVER ({BY_DATE}) AS DOUBLE) AS lag_{n}" for n in LAGS)

AGGREGATES = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}


def rolling(stats: tuple[str, ...], last: str = "CURRENT ROW", extra: int = 0) -> str:
    def one(stat: str, n: int) -> str:
        frame = f"{BY_DATE} ROWS BETWEEN {n - 1 + extra} PRECEDING AND {last}"
        value = f"{AGGREGATES[stat]}(CAST(units_sold AS DOUBLE)) OVER ({frame})"
        if stat in ("mean", "std"):
            value = f"round({value}, 6)"
        return f"{value} AS rolling_{stat}_{n}"

    return ", ".join(one(stat, n) for n in SIZES for stat in stats)


def rolling_days(stats: tuple[str, ...]) -> str:
    return ", ".join(
        f"round({AGGREGATES[stat]}(CAST(units_sold AS DOUBLE)) OVER ({BY_DATE} RANGE BETWEEN "
        f"INTERVAL {n - 1} DAY PRECEDING AND CURRENT ROW), 6) AS rolling_{stat}_{n}d"
        for n in SIZES
        for stat in stats
    )


LAG_DAYS = ", ".join(
    f"max(CAST(units_sold AS DOUBLE)) OVER ({BY_DATE} RANGE BETWEEN INTERVAL {n} DAY PRECEDING "
    f"AND INTERVAL {n} DAY PRECEDING) AS lag_{n}d"
    for n in LAGS
)
CALENDAR = """CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, CAST(month(date) AS INTEGER) AS month,
  CAST(weekofyear(date) AS INTEGER) AS week_of_year, CAST(quarter(date) AS INTEGER) AS quarter,
  CAST(day(date) AS INTEGER) AS day_of_month, isodow(date) >= 6 AS is_weekend"""
PRICES = """price * (CAST(1 AS DOUBLE) - discount / CAST(100 AS DOUBLE)) AS effective_price,
  CASE WHEN competitor_pricing <> 0 THEN price / competitor_pricing END AS price_to_competitor_ratio,
  discount > 0 AS has_discount"""
ONE_HOT = ", ".join(
    f"CAST({c} = '{v}' AS INTEGER) AS {c}_is_{v.lower().replace(' ', '_')}"
    for c, values in LABEL_ORDER.items()
    for v in values[:-1]
)
FEATURES = CLEANED + f""",
features AS (
  SELECT *, {LABELS}, {IDS}, {LAG}, {rolling(("mean", "std"))}, {CALENDAR}, {PRICES} FROM cleaned
)"""

SCORED_BASELINE = CLEANED + """,
scored AS (
  SELECT date, store_id, product_id, category, region, units_sold, demand_forecast,
    greatest(demand_forecast, CAST(0 AS DOUBLE)) AS predicted_units_sold
  FROM cleaned
)"""
SCORED_LAST_WEEK = CLEANED + f""",
scored AS (
  SELECT date, store_id, product_id, category, region, units_sold, demand_forecast,
    CAST(coalesce(lag(units_sold, 7) OVER ({BY_DATE}), 0) AS DOUBLE) AS predicted_units_sold
  FROM cleaned
)"""



def round4(value: str) -> str:
    """The binary value to four places, ties to even: the text of a double is formatted from its exact value."""
    return f"CAST(format('{{:.4f}}', CAST({value} AS DOUBLE)) AS DOUBLE)"


SAFETY = f"demand_std_dev * ({SERVICE_Z!r}::DOUBLE * sqrt(CAST({LEAD_DAYS} AS DOUBLE)))"
TRIGGER = f"(avg_daily_demand * {LEAD_DAYS} + {SAFETY})"
TARGET = f"(avg_daily_demand * {CYCLE_DAYS} + {SAFETY})"
POLICY_COLUMNS = f"""CAST({LEAD_DAYS} AS INTEGER) AS lead_time_days,
  CAST({CYCLE_DAYS} AS INTEGER) AS order_cycle_days,
  CAST({SERVICE_Z} AS DOUBLE) AS service_level_z,
  {round4(SAFETY)} AS safety_stock, {round4(TRIGGER)} AS reorder_point,
  {round4(TARGET)} AS target_stock_level,
  {round4(f"greatest({TARGET} - current_inventory_level, CAST(0 AS DOUBLE))")} AS recommended_order_qty,
  {round4("CASE WHEN avg_daily_demand > 0 THEN current_inventory_level / avg_daily_demand END")} AS days_of_supply,
  current_inventory_level <= {TRIGGER} AS reorder_recommendation"""


def millionths(value: str) -> str:
    return f"CAST(round_even({value} * CAST(1000000 AS DOUBLE), 0) AS HUGEINT)"


def exact_mean(value: str) -> str:
    return f"CAST(sum({millionths(value)}) AS DOUBLE) / CAST(count({value}) * 1000000 AS DOUBLE)"


def demand(source: str) -> str:
    """Mean and deviation from whole sums of millionths, without rounding."""
    return f"""
whole AS (
  SELECT store_id, product_id, arg_min(category, date) AS category, arg_min(region, date) AS region, count(y) AS n,
    sum(y) AS s, sum(y * y) AS squares, sum(y) // count(y) AS q, sum(y) - sum(y) // count(y) * count(y) AS r
  FROM (SELECT *, {millionths('predicted_units_sold')} AS y FROM {source}) GROUP BY store_id, product_id
),
demand AS (
  SELECT store_id, product_id, category, region, CAST(s AS DOUBLE) / CAST(n * 1000000 AS DOUBLE) AS avg_daily_demand,
    CASE WHEN n > 1 THEN sqrt((CAST(squares - q * q * n - 2 * q * r AS DOUBLE) - CAST(r * r AS DOUBLE) / n) / (n - 1))
      / CAST(1000000 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS demand_std_dev
  FROM whole
)"""


DEMAND = "," + demand("scored")
ADVICE = SCORED_BASELINE + DEMAND + f""",
stock AS (
  SELECT store_id, product_id, inventory_level AS current_inventory_level FROM cleaned
  QUALIFY rank() OVER (PARTITION BY store_id, product_id ORDER BY date DESC) = 1
),
advice AS (
  SELECT store_id, product_id, category, region, avg_daily_demand, demand_std_dev, current_inventory_level,
    {POLICY_COLUMNS}
  FROM demand JOIN stock USING (store_id, product_id)
)"""
RECOMMEND = f"WITH {ADVICE} SELECT * FROM advice"


def _measures(side: str, forecast: str) -> str:
    """RMSE, MAE and MAPE over the rows where ``forecast`` is not NULL."""
    error = f"({forecast} - units_sold)"
    percent = f"CAST(100 AS DOUBLE) * avg(CASE WHEN units_sold <> 0 THEN abs({error}) / units_sold END)"
    figures = {"rmse": f"sqrt(avg({error} * {error}))", "mae": f"avg(abs({error}))", "mape": percent}
    return ", ".join(f"{round4(value)} AS {side}_{name}" for name, value in figures.items())


METRICS = SCORED_LAST_WEEK + f""",
marked AS (
  SELECT *, CASE WHEN coalesce(demand_forecast >= 0, FALSE) THEN demand_forecast END AS baseline FROM scored
),
measured AS (
  SELECT CASE WHEN grouping(category) = 1 THEN 'global' ELSE 'category' END AS scope, category,
    count(*) AS total_rows, count(predicted_units_sold) AS model_eval_rows,
    count(baseline) AS baseline_eval_rows, count(*) FILTER (WHERE baseline IS NULL) AS baseline_anomaly_rows,
    count(*) FILTER (WHERE units_sold = 0) AS mape_excluded_rows_model,
    count(*) FILTER (WHERE units_sold = 0 AND baseline IS NOT NULL) AS mape_excluded_rows_baseline,
    {_measures("model", "predicted_units_sold")}, {_measures("baseline", "baseline")}
  FROM marked GROUP BY GROUPING SETS ((), (category))
),
metrics AS (
  SELECT *, {round4('baseline_rmse - model_rmse')} AS rmse_delta, {round4('baseline_mae - model_mae')} AS mae_delta,
    {round4('baseline_mape - model_mape')} AS mape_delta
  FROM measured
)"""

QUALITY = " UNION ALL ".join(
    [
        f"SELECT '{name}' AS column_name, 'not_null' AS check_name, "
        f"count(*) FILTER (WHERE {name} IS NULL) AS violations, count(*) AS total_rows FROM cleaned"
        for name in CLEAN_NAMES
    ]
    + [
        f"SELECT '{c}', 'in_range', count(*) FILTER (WHERE {c} NOT BETWEEN {low!r}::DOUBLE AND {high!r}::DOUBLE), count(*) FROM cleaned"
        for c, (low, high) in RANGES.items()
    ]
)


def _list(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{v}'" for v in values)


DOMAINS = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS violations FROM cleaned "
    f"WHERE {c} NOT IN ({_list(values)}) GROUP BY {c}"
    for c, values in {**LABEL_ORDER, "region": DEFAULT_REGIONS}.items()
)

SUMMARY = ADVICE + f""",
summary AS (
  SELECT 'category_rows' AS subject, category AS measure, CAST(count(*) AS DOUBLE) AS value FROM scored GROUP BY category
  UNION ALL SELECT 'forecast', 'min', min(predicted_units_sold) FROM scored
  UNION ALL SELECT 'forecast', 'max', max(predicted_units_sold) FROM scored
  UNION ALL SELECT 'forecast', 'mean', {exact_mean('predicted_units_sold')} FROM scored
  UNION ALL SELECT 'entities', 'count', count(*) FROM advice
  UNION ALL SELECT 'entities', 'mean_daily_demand', {exact_mean('avg_daily_demand')} FROM advice
  UNION ALL SELECT 'entities', 'mean_demand_std_dev', {exact_mean('demand_std_dev')} FROM advice
  UNION ALL SELECT 'entities', 'reorder_flagged', count(*) FILTER (WHERE reorder_recommendation) FROM advice
  UNION ALL SELECT 'entities', 'reorder_flagged_pct',
    CAST(100 AS DOUBLE) * count(*) FILTER (WHERE reorder_recommendation) / count(*) FROM advice
  UNION ALL SELECT 'entities', 'service_level_pct', CAST(95.05285319663519 AS DOUBLE)
)"""

CUTOFF = "(SELECT max(date) - 90 FROM cleaned)"
PERCENTILE = f"""(SELECT DATE '1970-01-01' + CAST(floor(quantile_cont(date - DATE '1970-01-01', 0.8)) AS INTEGER)
  FROM cleaned)"""


def split_counts(cutoff: str) -> str:
    return f"""WITH {CLEANED}, cut AS (SELECT {cutoff} AS cutoff_date)
      SELECT any_value(cutoff_date) AS cutoff_date, count(*) FILTER (WHERE date <= cutoff_date) AS train_rows,
        count(*) FILTER (WHERE date > cutoff_date) AS holdout_rows
      FROM cleaned, cut"""


RAW_NAMES = ", ".join(f'{clean} AS "{raw}"' for raw, clean in RAW_NAMES_OF.items())
PREDICTIONS = ", ".join(PREDICTION_NAMES)
PROJECTION = ", ".join(dict.fromkeys([*PREDICTION_NAMES[:-1], *MODEL_INPUTS]))

METADATA = f"""WITH {CLEANED}
SELECT max(date) - 90 AS cutoff_date, 'days' AS split_rule, CAST(90 AS INTEGER) AS holdout_days,
  count(*) FILTER (WHERE date <= {CUTOFF}) AS train_row_count, count(*) FILTER (WHERE date > {CUTOFF}) AS val_row_count,
  CAST({len(MODEL_INPUTS)} AS INTEGER) AS feature_count, '{",".join(MODEL_INPUTS)}' AS feature_columns,
  'units_sold' AS target_column, '{TREE_TEXT}' AS model_parameters, '{NOT_APPLIED}' AS parameters_not_applied,
  CAST(42 AS INTEGER) AS random_seed, 'enhanced' AS model_variant, TRUE AS use_baseline_feature
FROM cleaned"""

MANY = """
many AS (
  SELECT date, 'S' || lpad(CAST(n_regionkey + 1 AS VARCHAR), 3, '0') AS store_id,
    'P' || lpad(CAST(l_partkey AS VARCHAR), 12, '0') AS product_id,
    CASE l_partkey % 5 WHEN 0 THEN 'Clothing' WHEN 1 THEN 'Electronics' WHEN 2 THEN 'Furniture'
      WHEN 3 THEN 'Groceries' ELSE 'Toys' END AS category,
    r_name AS region, CAST(50 + order_keys % 451 AS INTEGER) AS inventory_level,
    CAST(sold AS INTEGER) AS units_sold, round(planned - CAST(3 AS DOUBLE), 2) AS demand_forecast
  FROM (
    SELECT CAST(l_shipdate AS DATE) AS date, n_regionkey, r_name, l_partkey, sum(l_orderkey) AS order_keys,
      sum(CASE WHEN l_returnflag = 'R' THEN CAST(0 AS DOUBLE) ELSE l_quantity END) AS sold,
      sum(l_quantity * (CAST(1 AS DOUBLE) + l_tax - l_discount)) AS planned
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
      JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY ALL)
), scored AS (
  SELECT *, greatest(demand_forecast, CAST(0 AS DOUBLE)) AS predicted_units_sold FROM many
)"""
MANY_ADVICE = MANY + DEMAND + f""",
stock AS (
  SELECT store_id, product_id, inventory_level AS current_inventory_level FROM many
  QUALIFY rank() OVER (PARTITION BY store_id, product_id ORDER BY date DESC) = 1
), advice AS (
  SELECT store_id, product_id, category, region, avg_daily_demand, demand_std_dev, current_inventory_level,
    {POLICY_COLUMNS}
  FROM demand JOIN stock USING (store_id, product_id)
)"""


def exact_rolling(n: int) -> str:
    """Mean and deviation from whole sums of 128 bits."""
    w = f"OVER ({BY_DATE} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    count, total = f"count(large) {w}", f"sum(CAST(large AS HUGEINT)) {w}"
    squares = f"sum(CAST(large AS HUGEINT) * large) {w}"
    spread = f"CAST({count} * {squares} - {total} * {total} AS DOUBLE) / ({count} * ({count} - 1))"
    return (
        f"round(CAST({total} AS DOUBLE) / {count}, 3) AS rolling_mean_{n}, "
        f"CASE WHEN {count} > 1 THEN round(sqrt({spread}), 3) END AS rolling_std_{n}"
    )


def null_rank(column: str) -> str:
    return f"CAST(CASE WHEN {column} IS NOT NULL THEN dense_rank() OVER (ORDER BY {column} NULLS LAST) - 1 END AS INTEGER)"


STUMP = f"""WITH {CLEANED}, per AS (
  SELECT discount, count(*) AS n, sum(units_sold) AS s FROM cleaned GROUP BY discount
), cuts AS (
  SELECT c.discount AS cut, sum(n) FILTER (p.discount <= c.discount) AS ln, sum(s) FILTER (p.discount <= c.discount) AS ls,
    sum(n) FILTER (p.discount > c.discount) AS rn, sum(s) FILTER (p.discount > c.discount) AS rs
  FROM per p, (SELECT discount FROM per) c GROUP BY c.discount HAVING count(*) FILTER (p.discount > c.discount) > 0
), best AS (
  SELECT * FROM cuts ORDER BY CAST(ls AS DOUBLE) * ls / ln + CAST(rs AS DOUBLE) * rs / rn DESC, cut LIMIT 1
)
SELECT discount, round(CASE WHEN discount <= cut THEN CAST(ls AS DOUBLE) / ln ELSE CAST(rs AS DOUBLE) / rn END, 6) AS prediction
FROM per, best"""


def _score(gradient: str, rows: str) -> str:
    """Squared gradient, less the first penalty, over rows and the second one."""
    t = f"(sign({gradient}) * greatest(abs({gradient}) - CAST(0.1 AS DOUBLE), CAST(0 AS DOUBLE)))"
    return f"({t} * {t} / ({rows} + CAST(1 AS DOUBLE)))"


def _leaf(gradient: str, rows: str, rate: float) -> str:
    t = f"(sign({gradient}) * greatest(abs({gradient}) - CAST(0.1 AS DOUBLE), CAST(0 AS DOUBLE)))"
    return f"(-{t} / ({rows} + CAST(1 AS DOUBLE))) * CAST({rate!r} AS DOUBLE)"


def boosted(source: str, features: tuple[str, ...], trees: int, depth: int, rate: float, least_rows: int) -> str:
    """Trees over features of few values, step by step: every cut at every value, absent values on either side. The last
    relation is ``grown``, with the forecast in ``forecast``."""
    listed = ", ".join(f"{f}" for f in features)
    values = ", ".join(f"CAST({f} AS DOUBLE)" for f in features)
    steps = [f"""
fit_0 AS MATERIALIZED (
  SELECT *, (SELECT {exact_mean('units_sold')} FROM {source}) AS forecast FROM {source}
), unit AS MATERIALIZED (
  SELECT power(CAST(2 AS DOUBLE), 30 - ceil(log2(greatest(max(units_sold) - max(forecast), max(forecast) - min(units_sold))))) AS scale FROM fit_0
)"""]
    for t in range(trees):
        steps.append(f"""
at_{t}_0 AS MATERIALIZED (
  SELECT *, round_even((forecast - units_sold) * (SELECT scale FROM unit), 0) AS gradient, 0 AS node, TRUE AS live FROM fit_{t}
)""")
        for d in range(depth):
            name = f"{t}_{d}"
            steps.append(f"""
cells_{name} AS MATERIALIZED (
  SELECT node, feature, v, CAST(sum(gradient) AS DOUBLE) AS g, count(*) AS h
  FROM (SELECT node, gradient, unnest(range({len(features)})) AS feature, unnest([{values}]) AS v FROM at_{name} WHERE live)
  GROUP BY node, feature, v
), sides_{name} AS (
  SELECT node, feature, v, sum(g) FILTER (v IS NOT NULL) OVER upto AS lg, sum(h) FILTER (v IS NOT NULL) OVER upto AS lh,
    coalesce(sum(g) FILTER (v IS NULL) OVER whole, 0) AS ng, coalesce(sum(h) FILTER (v IS NULL) OVER whole, 0) AS nh,
    sum(g) OVER whole AS g, sum(h) OVER whole AS h
  FROM cells_{name} WINDOW whole AS (PARTITION BY node, feature), upto AS (PARTITION BY node, feature ORDER BY v NULLS LAST)
), tried_{name} AS (
  SELECT node, feature, v, side, lg + side * ng AS lg, lh + side * nh AS lh, g, h, (SELECT scale FROM unit) AS scale
  FROM sides_{name}, (SELECT unnest([0, 1]) AS side) WHERE v IS NOT NULL
), gained_{name} AS (
  SELECT *, CAST(0.5 AS DOUBLE) * (({_score('lg / scale', 'lh')} + {_score('(g - lg) / scale', '(h - lh)')}) - {_score('g / scale', 'h')}) AS gain
  FROM tried_{name} WHERE lh >= {least_rows} AND h - lh >= {least_rows}
), best_{name} AS MATERIALIZED (
  SELECT * FROM gained_{name} WHERE gain > CAST(1e-6 AS DOUBLE)
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, feature, side, v) = 1
), at_{t}_{d + 1} AS MATERIALIZED (
  SELECT a.* REPLACE (CASE WHEN b.node IS NULL THEN a.node
      ELSE 2 * a.node + CASE WHEN coalesce([{values}][b.feature + 1] <= b.v, b.side = 1) THEN 1 ELSE 2 END END AS node,
    a.live AND b.node IS NOT NULL AS live)
  FROM at_{name} a LEFT JOIN best_{name} b ON a.live AND a.node = b.node
)""")
        steps.append(f"""
worth_{t} AS MATERIALIZED (
  SELECT node, {_leaf('g', 'h', rate)} AS leaf FROM (
    SELECT node, CAST(sum(gradient) AS DOUBLE) / (SELECT scale FROM unit) AS g, count(*) AS h FROM at_{t}_{depth} GROUP BY node)
), fit_{t + 1} AS MATERIALIZED (
  SELECT {KEYS}, units_sold, {listed}, forecast + leaf AS forecast FROM at_{t}_{depth} JOIN worth_{t} USING (node)
)""")
    steps.append(f"\ngrown AS (SELECT * FROM fit_{trees})")
    return ",".join(steps)


# Features of few values; two of them are absent in places.
TREE_ROWS = f"""WITH {FEATURES}, rows AS (
  SELECT {KEYS}, units_sold, discount, month, floor(lag_28 / 25) AS lag_band, floor(price_to_competitor_ratio) AS ratio_band FROM features
)"""
FIT_TREES = f"""{TREE_ROWS},{boosted("rows", ("discount", "month", "lag_band", "ratio_band"), 2, 2, 0.3, 5)}
SELECT {KEYS}, greatest(forecast, CAST(0 AS DOUBLE)) AS predicted_units_sold FROM grown"""
FULL_RUN = f"""WITH {CLEANED}, n AS (
  SELECT count(*) AS n_rows, count(DISTINCT (store_id, product_id)) AS n_entities, count(DISTINCT category) AS n_categories FROM cleaned
)
SELECT unnest(['forecast_csv', 'forecast_parquet', 'inventory_csv', 'inventory_parquet', 'metrics', 'errors', 'stockouts', 'summary']) AS artefact,
  unnest([n_rows, n_rows, n_entities, n_entities, n_categories + 1, n_rows, n_categories + 1, n_categories + 10]) AS row_count FROM n"""

SQL: dict[str, str] = {
    "scan_csv_quarantine": f"""WITH {PANEL} SELECT CASE WHEN discount = 7 THEN 'reject' ELSE 'row' END AS kind,
      CAST(date AS VARCHAR) AS date, store_id, product_id FROM panel""",
    "encode_null_ids": f"""WITH {LINES}, gaps AS (
      SELECT CASE WHEN units_ordered % 7 <> 0 THEN store_id END AS store_id,
        CASE WHEN units_ordered % 3 <> 0 THEN product_id END AS product_id FROM lines),
      coded AS (SELECT *, {null_rank('store_id')} AS store_id_encoded, {null_rank('product_id')} AS product_id_encoded FROM gaps)
      SELECT store_id, product_id, store_id_encoded, product_id_encoded, count(*) AS line_count FROM coded GROUP BY ALL""",
    "rolling_large": f"""WITH {CLEANED}, big AS (
      SELECT *, CAST(CAST(units_sold AS BIGINT) * 7919000 % 2000000000 + 100000000 AS INTEGER) AS large FROM cleaned)
      SELECT {KEYS}, {", ".join(exact_rolling(n) for n in SIZES)} FROM big""",
    "fit_stump": STUMP,
    "fit_trees": FIT_TREES,
    "full_run": FULL_RUN,
    "demand_stats_moving": f"""WITH {SCORED_BASELINE}, moved AS (
      SELECT * REPLACE (category || CAST(month(date) % 3 AS VARCHAR) AS category,
        region || CAST(month(date) % 3 % 2 AS VARCHAR) AS region,
        predicted_units_sold + CAST(100000000 AS DOUBLE) AS predicted_units_sold) FROM scored),{demand("moved")}
      SELECT * FROM demand""",
    "lag_many_series": f"WITH {MANY} SELECT {KEYS}, units_sold, {LAG} FROM many",
    "rolling_many_series": f"WITH {MANY} SELECT {KEYS}, {rolling(('mean', 'std'))} FROM many",
    "demand_stats_many_series": f"WITH {MANY}{DEMAND} SELECT * FROM demand",
    "latest_inventory_many_series": f"""WITH {MANY} SELECT store_id, product_id, inventory_level FROM many
      QUALIFY rank() OVER (PARTITION BY store_id, product_id ORDER BY date DESC) = 1""",
    "recommend_many_series": f"WITH {MANY_ADVICE} SELECT * FROM advice",
    "encode_many_series": f"WITH {MANY} SELECT {KEYS}, {IDS} FROM many",
    "scan_csv": f"WITH {PANEL} SELECT {RAW_NAMES} FROM panel",
    "load_audit": f"""WITH {PANEL} SELECT count(*) AS total_rows, CAST({len(RAW_NAMES_OF)} AS INTEGER) AS column_count,
      '{",".join(RAW_NAMES_OF)}' AS column_names FROM panel""",
    "sink_parquet": f"WITH {CLEANED} SELECT * FROM cleaned",
    "sink_csv": f"WITH {CLEANED} SELECT * FROM cleaned",
    "write_forecast": f"WITH {SCORED_BASELINE} SELECT {PREDICTIONS} FROM scored",
    "write_inventory": RECOMMEND,
    "metrics_json": f"WITH {METRICS} SELECT * FROM metrics",
    "stage_features": f"WITH {FEATURES} SELECT * FROM features",
    "training_metadata": METADATA,
    "clean": f"WITH {CLEANED} SELECT * FROM cleaned",
    "anomaly_count": f"""WITH {CLEANED} SELECT count(*) AS total_rows,
      count(*) FILTER (WHERE is_forecast_anomaly) AS anomaly_rows FROM cleaned""",
    "drop_negative_sales": f"""WITH {CLEANED}, net AS (
      SELECT * REPLACE (2 * units_sold - units_ordered AS units_sold) FROM cleaned)
      SELECT * FROM net WHERE units_sold >= 0""",
    "quality_report": f"WITH {CLEANED} {QUALITY}",
    "domain_violations": f"WITH {CLEANED} {DOMAINS}",
    "duplicate_grain": f"WITH {LINES} SELECT {KEYS}, count(*) AS row_count FROM lines GROUP BY {KEYS} HAVING count(*) > 1",
    "latest_ties": f"""WITH {LINES}, latest AS (
      SELECT store_id, product_id, max(date) AS date FROM lines GROUP BY store_id, product_id)
      SELECT store_id, product_id, count(*) AS row_count FROM lines JOIN latest USING (store_id, product_id, date)
      GROUP BY store_id, product_id HAVING count(*) > 1""",
    "unmatched_entities": f"""WITH {LINES} SELECT store_id, product_id FROM lines GROUP BY store_id, product_id
      HAVING min(date) > (SELECT max(date) - 90 FROM lines)""",
    "encode_fixed": f"WITH {CLEANED} SELECT {KEYS}, {', '.join(LABEL_NAMES)}, {LABELS} FROM cleaned",
    "encode_dynamic": f"WITH {CLEANED} SELECT {KEYS}, {IDS} FROM cleaned",
    "encode_dynamic_ranges": f"""WITH {LINES}, coded AS (SELECT *, {IDS} FROM lines)
      SELECT store_id, product_id, store_id_encoded, product_id_encoded, count(*) AS line_count,
        CAST(sum(units_ordered) AS BIGINT) AS units_ordered FROM coded GROUP BY ALL""",
    "encode": f"WITH {CLEANED} SELECT *, {LABELS}, {IDS} FROM cleaned",
    "one_hot": f"WITH {CLEANED} SELECT {KEYS}, {ONE_HOT} FROM cleaned",
    "lag_features": f"WITH {CLEANED} SELECT {KEYS}, units_sold, {LAG} FROM cleaned",
    "rolling_features": f"WITH {CLEANED} SELECT {KEYS}, {rolling(('mean', 'std'))} FROM cleaned",
    "rolling_past": f"WITH {CLEANED} SELECT {KEYS}, {rolling(('mean', 'std'), '1 PRECEDING', 1)} FROM cleaned",
    "rolling_minmax": f"WITH {CLEANED} SELECT {KEYS}, {rolling(('min', 'max'))} FROM cleaned",
    "rolling_calendar": f"WITH {CLEANED} SELECT {KEYS}, {rolling_days(('mean', 'std', 'min', 'max'))} FROM cleaned",
    "lag_calendar": f"WITH {CLEANED} SELECT {KEYS}, {LAG_DAYS} FROM cleaned",
    "calendar_features": f"WITH {CLEANED} SELECT {KEYS}, {CALENDAR} FROM cleaned",
    "price_features": f"WITH {CLEANED} SELECT {KEYS}, {PRICES} FROM cleaned",
    "all_features": f"WITH {FEATURES} SELECT * FROM features",
    "cutoff_date": f"WITH {CLEANED} SELECT max(date) AS last_date, max(date) - 90 AS cutoff_date FROM cleaned",
    "percentile_split": split_counts(PERCENTILE),
    "time_split": f"WITH {CLEANED} SELECT {KEYS}, units_sold, date > {CUTOFF} AS is_holdout FROM cleaned",
    "split_counts": split_counts(CUTOFF),
    "model_projection": f"WITH {FEATURES} SELECT {PROJECTION} FROM features",
    "clip_prediction": f"WITH {SCORED_BASELINE} SELECT {KEYS}, demand_forecast, predicted_units_sold FROM scored",
    "evaluate": f"WITH {METRICS} SELECT * FROM metrics",
    "evaluate_by_category": f"WITH {METRICS} SELECT * EXCLUDE (scope) FROM metrics WHERE scope = 'category' ORDER BY category",
    "stockout_rate": f"""WITH {SCORED_LAST_WEEK}, counted AS (
      SELECT CASE WHEN grouping(category) = 1 THEN 'global' ELSE 'category' END AS scope, category,
        count(*) AS total_rows, count(predicted_units_sold) AS model_rows,
        count(*) FILTER (WHERE predicted_units_sold < units_sold) AS model_stockouts,
        count(demand_forecast) AS baseline_rows,
        count(*) FILTER (WHERE demand_forecast < units_sold) AS baseline_stockouts
      FROM scored GROUP BY GROUPING SETS ((), (category)))
      SELECT *, round(CAST(100 AS DOUBLE) * model_stockouts / model_rows, 6) AS model_stockout_pct,
        round(CAST(100 AS DOUBLE) * baseline_stockouts / baseline_rows, 6) AS baseline_stockout_pct,
        round(CAST(100 AS DOUBLE) * model_stockouts / model_rows
          - CAST(100 AS DOUBLE) * baseline_stockouts / baseline_rows, 6) AS stockout_pct_difference
      FROM counted""",
    "forecast_errors": f"""WITH {SCORED_LAST_WEEK} SELECT store_id, product_id, category, region,
      date AS forecast_date, predicted_units_sold, units_sold AS actual_units_sold,
      demand_forecast AS dataset_demand_forecast,
      round(abs(predicted_units_sold - units_sold), 6) AS model_absolute_error,
      round(abs(demand_forecast - units_sold), 6) AS baseline_absolute_error FROM scored""",
    "demand_stats": f"WITH {SCORED_BASELINE}{DEMAND} SELECT * FROM demand",
    "latest_inventory": f"""WITH {CLEANED} SELECT store_id, product_id, inventory_level FROM cleaned
      QUALIFY rank() OVER (PARTITION BY store_id, product_id ORDER BY date DESC) = 1""",
    "inventory_policy": f"""WITH {CLEANED}, sums AS (
      SELECT {KEYS}, count(units_sold) OVER w AS n, sum(CAST(units_sold AS HUGEINT)) OVER w AS s,
        sum(CAST(units_sold AS HUGEINT) * units_sold) OVER w AS squares, inventory_level AS current_inventory_level
      FROM cleaned WINDOW w AS ({BY_DATE} ROWS BETWEEN 27 PRECEDING AND CURRENT ROW)),
      recent AS (SELECT {KEYS}, CAST(s AS DOUBLE) / n AS avg_daily_demand, CASE WHEN n > 1
        THEN sqrt(CAST(n * squares - s * s AS DOUBLE) / (n * (n - 1))) ELSE CAST(0 AS DOUBLE) END AS demand_std_dev,
        current_inventory_level FROM sums)
      SELECT *, {POLICY_COLUMNS} FROM recent""",
    "recommend": RECOMMEND,
    "run_summary": f"WITH {SUMMARY} SELECT subject, measure, value FROM summary",
}
