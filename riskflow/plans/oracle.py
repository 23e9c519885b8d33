"""The registered queries as DuckDB SQL over the same tables."""

from __future__ import annotations

LAYERS = """
with raw as (
  select cast(event_id as varchar) as transaction_id, ts as event_time,
    cast(user_id as varchar) as user_id, json_extract_string(props, '$.k') as product_id,
    event_type as subscription_type,
    case when event_id % 103 = 0 then null when event_id % 101 = 0 then -value else value end
      as amount,
    concat('City-', cast(event_id % 5 as varchar)) as location,
    concat('10.0.', cast(user_id % 256 as varchar), '.', cast(event_id % 8 as varchar))
      as ip_address,
    concat('device_', cast(event_id % 97 as varchar)) as device_id,
    case event_id % 3 when 0 then 'PayPal' when 1 then 'Credit Card' else 'Apple Pay' end
      as payment_method,
    concat('4', lpad(cast(event_id as varchar), 15, '0')) as card_number,
    case when event_id % 17 = 0 then null when event_id % 19 = 0 then 'usd' else 'USD' end
      as currency,
    event_id % 2 = 0 as is_new_user,
    case when event_id % 4 = 0 then null else 'REF123' end as referral_code,
    concat('s', cast(event_id as varchar)) as session_id
  from events),
lengths as (
  select * exclude (card_number),
    case when cast(transaction_id as bigint) % 29 = 0 then null
      when cast(transaction_id as bigint) % 23 = 0 then concat(digits, 'x')
      else digits end as card_number
  from (select *, substr(concat(card_number, '987'), 1,
          cast(cast(transaction_id as bigint) % 10 + 10 as integer)) as digits from raw)),
bronze as (
  select transaction_id, event_time, user_id, product_id, subscription_type, amount, location,
    device_id, payment_method, currency, is_new_user, referral_code, session_id,
    sha256(ip_address) as hash_ip, sha256(card_number) as hash_card_number,
    regexp_replace(card_number, '[0-9]{12}([0-9]{4})', '**** **** **** \\1', 'g') as card_number,
    cast(event_time as date) as event_date
  from raw),
users as (
  select cast(c_custkey as varchar) as user_id, n_name as country, c_mktsegment as user_status
  from customer join nation on c_nationkey = n_nationkey where c_mktsegment <> 'FURNITURE'),
products as (
  select cast(p_partkey as varchar) as product_id, p_name as product_name,
    p_type as category, p_retailprice as price from part where p_size <= 40),
plans as (
  select 'purchase' as subscription_type, cast(299.99 as double) as monthly_cost,
    'Low' as churn_risk, 12 as plan_duration
  union all select 'view', cast(29.99 as double), 'Medium', 1
  union all select 'click', cast(14.99 as double), 'High', 3),
ip_base as (
  select concat('10.0.', cast(n // 8 as varchar), '.', cast(n % 8 as varchar)) as ip,
    cast(1 + n % 10 as integer) as risk_score,
    concat('Region-', cast(1 + n % 5 as varchar)) as location
  from (select unnest(range(0, 1024)) as n)),
ip_risk as (
  select sha256(ip) as ip_hash,
    case when risk_score <= 3 then 'low' when risk_score <= 7 then 'medium' else 'high' end
      as risk_level,
    risk_score, location from ip_base),
silver as (
  select b.*, u.country, u.user_status, u.user_id is null as missing_user,
    p.product_name, p.category, p.price, p.product_id is null as missing_product,
    s.monthly_cost, s.churn_risk, s.plan_duration,
    s.subscription_type is null as missing_subscription,
    i.risk_level, cast(i.risk_score as double) as risk_score, i.location as ip_risk_location,
    i.ip_hash is null as missing_ip,
    b.amount / nullif(s.monthly_cost, 0) as usage_cost_ratio
  from bronze b
  left join users u on b.user_id = u.user_id
  left join products p on b.product_id = p.product_id
  left join plans s on b.subscription_type = s.subscription_type
  left join ip_risk i on b.hash_ip = i.ip_hash),
risk as (
  select *, coalesce(risk_level = 'high' and usage_cost_ratio < 0.2, false) as is_high_risk_txn
  from silver),
spend as (
  select user_id, event_date, round(sum(amount), 2) as "Total_spent_per_user"
  from bronze group by user_id, event_date),
usage as (
  select product_id, event_date, round(avg(usage_cost_ratio), 6) as average_usage_cost_ratio
  from silver group by product_id, event_date)
"""

# The same layers from a feed with a hot user and rows without a user.
SKEWED_LAYERS = LAYERS.replace(
    "cast(user_id as varchar) as user_id",
    "case when event_id % 10 = 7 then null when event_id % 3 = 0 then '1' "
    "else cast(user_id as varchar) end as user_id",
    1,
)

RAW_COLUMNS = """transaction_id event_time user_id product_id subscription_type amount location
ip_address device_id payment_method card_number currency is_new_user referral_code
session_id""".split()

SILVER_COLUMNS = """transaction_id event_time user_id product_id subscription_type amount location
device_id payment_method currency is_new_user referral_code session_id hash_ip hash_card_number
card_number event_date country user_status missing_user product_name category price
missing_product monthly_cost churn_risk plan_duration missing_subscription risk_level risk_score
ip_risk_location missing_ip usage_cost_ratio""".split()

# The same layers from a feed with bad cards and nulls in every column.
FLAWS = dict(zip(RAW_COLUMNS, (31, 37, 41, 43, 47, 53, 59, 61, 67, 71, 73, 79, 83, 89, 97)))
FLAWED_LAYERS = LAYERS.replace("with raw as (", "with clean as (", 1).replace(
    "as digits from raw)),",
    "as digits from clean)),\nraw as (select "
    + ", ".join(
        f"case when cast(transaction_id as bigint) % {every} <> 0 then {name} end as {name}"
        for name, every in FLAWS.items()
    )
    + " from lengths),",
    1,
)

RANGE = [("amount", "range_check", "amount <= 0")]
CURRENCY = [("currency", "format_check for currency",
             "not regexp_matches(currency, '^[A-Z]{3}$')")]
CARD = [("card_number", "format_check for card_number",
         "not regexp_matches(card_number, '^[0-9]{12,19}$')")]


def _nulls(columns):
    return [(name, "null_check", f"{name} is null") for name in columns]


def _consistency(high_risk_score):
    return [
        ("usage_cost_ratio", "usage_cost_ratio_invalid",
         "usage_cost_ratio is null or usage_cost_ratio <= 0"),
        ("usage_cost_ratio", "high_risk_low_usage",
         f"usage_cost_ratio < 0.2 and risk_score > {high_risk_score}"),
        ("amount", "amount_without_monthly_cost", "amount is not null and monthly_cost is null"),
        ("amount", "missing_currency_with_amount", "amount > 0 and currency is null"),
    ]


BRONZE_REPORT = _nulls(RAW_COLUMNS) + RANGE + CARD + CURRENCY
SILVER_REPORT = _nulls(SILVER_COLUMNS) + RANGE + CURRENCY + _consistency(80)


def _counts(layer, table, rules):
    return " union all ".join(
        f"""select '{layer}' as layer, cast(0 as bigint) as batch_id, '{column}' as "column",
        '{check}' as "check", cast(count(*) filter (where {violation}) as bigint)
        as violation_count, cast(count(*) as bigint) as total_rows from {table}"""
        for column, check, violation in rules
    )


def _report(layer, table, rules, layers=LAYERS):
    return f"""{layers} select *, round(violation_count * 100.0 / total_rows, 6)
    as violation_percent, case when violation_count > 0 then 'fail' else 'pass' end as status
    from ({_counts(layer, table, rules)})"""


def _select(table, columns="*", rest="", layers=LAYERS):
    return f"{layers} select {columns} from {table} {rest}"


def _profile(name, key):
    return f"""select '{name}' as lookup, cast(count(*) as bigint) as row_count,
    cast((select count(*) from (select {key} from {name} where {key} is not null group by {key}
    having count(*) > 1)) as bigint) as duplicate_keys from {name}"""


def _rows(name, table):
    return f"select '{name}' as table_name, cast(count(*) as bigint) as row_count from {table}"


STRICT_MASK = """transaction_id, case
  when regexp_matches(card_number, '^[0-9]{12,19}$')
    then concat('**** **** **** ', right(card_number, 4))
  when card_number is not null then '****' end as card_number"""

PARITY_MASK = """transaction_id,
  regexp_replace(card_number, '[0-9]{12}([0-9]{4})', '**** **** **** \\1', 'g') as card_number"""

CORRUPT = "cast(transaction_id as bigint) % 50 = 0 or cast(transaction_id as bigint) % 75 = 0"

SCHEMA_DIFF = """select layer, (select cast(count(*) as bigint) from events) as frame_rows,
  "column", expected, actual from (values
    ('raw', 'amount', 'double', 'string'),
    ('raw', 'session_id', 'string', null),
    ('silver', 'plan_duration', 'int', 'bigint'),
    ('silver', 'risk_level', 'string', null)) v(layer, "column", expected, actual)"""

STREAM_DQ = f"""{FLAWED_LAYERS} select layer, "column", "check", violation_count, total_rows from (
  {_counts('bronze', 'raw', BRONZE_REPORT)} union all
  {_counts('silver', 'silver', SILVER_REPORT)})"""

VELOCITY = """
    transaction_id, user_id, event_time,
    case when user_id is not null then count(*) over w end as velocity_count,
    case when user_id is not null then coalesce(round(sum(amount) over w, 4), 0) end as velocity_amount,
    case when user_id is not null then least(100.0::double, count(*) over w * 100.0::double / 5) end
      as velocity_score"""
VELOCITY_WINDOW = """window w as (partition by user_id order by event_time
    range between interval 1 hour preceding and current row)"""

DEVICES = f"""{SKEWED_LAYERS}, timed as (
  select transaction_id, user_id, time_bucket(interval 2 hours, event_time) as event_time,
    case when cast(transaction_id as bigint) % 11 <> 0
      then concat('device_', cast(cast(transaction_id as bigint) // 13 % 4 as varchar)) end as device_id
  from bronze),
lined as (
  select *, last_value(device_id ignore nulls) over (partition by user_id
      order by event_time, transaction_id rows between unbounded preceding and 1 preceding) as previous,
    device_id is not null and row_number() over (partition by user_id, device_id
      order by event_time, transaction_id) = 1 as is_new
  from timed)
select transaction_id, user_id, event_time, device_id,
  case when user_id is not null then previous end as previous_device,
  case when user_id is not null then coalesce(device_id <> previous, false) end as device_changed,
  case when user_id is not null then is_new end as device_is_new
from lined"""  # a condition may follow

# What a watermark of one hour has passed, of the rows with a user.
PASSED = """user_id is not null and event_time <= (select date_trunc('millisecond', max(event_time))
    - interval 1 hour from {table} where user_id is not null)"""

ODD_ADDRESSES = """
  case when event_id % 31 = 0 then null when event_id % 37 = 0 then '10.0.0.256'
    when event_id % 41 = 0 then '2001:db8::1'
    when event_id % 43 = 0 then concat('10.0.', user_id % 256, '.', event_id % 8, chr(10))
    when event_id % 3 = 0 then '10.0.65.3'
    else concat('10.0.', user_id % 256, '.', event_id % 8) end"""

GEO = f"""
with odd as (select cast(event_id as varchar) as transaction_id, {ODD_ADDRESSES} as ip from events),
numbered as (
  select transaction_id, sha256(ip) as hash_ip,
    case when regexp_full_match(ip, '10[.]0[.][0-9]+[.][0-9]+')
        and cast(split_part(ip, '.', 4) as integer) <= 255
      then cast(split_part(ip, '.', 3) as integer) * 256 + cast(split_part(ip, '.', 4) as integer) end as n
  from odd),
ranges as (
  select n_nationkey * 2048 as first, n_nationkey * 2048 + 2047 as last, n_name as geo_country,
    'nation' as geo_region from nation
  union all select c_custkey % 255 * 256 + c_custkey % 4,
    (c_custkey % 255 + c_custkey % 2) * 256 + c_custkey % 4 + c_custkey % 5,
    concat('customer-', c_custkey), c_mktsegment from customer where c_custkey % 3 <> 0
  union all select 64 * 256, 191 * 256 + 255, 'wide', null),
found as (
  select transaction_id, geo_country, geo_region, row_number() over (partition by transaction_id
    order by last - first, first, geo_country, geo_region nulls first) as place
  from numbered join ranges on n between first and last)
select transaction_id, hash_ip, geo_country, geo_region, geo_country is null as missing_geo
from numbered left join (select * from found where place = 1) using (transaction_id)"""

# A feed in which transactions are sent again; those without an id all land.
SENT_AGAIN = f"""{LAYERS}, sent as (
  select *, cast(transaction_id as bigint) as number from bronze),
lined as (
  select * from sent union all select * from sent where number % 3 = 0
  union all select * from sent where number % 5 = 0)"""

RAW_TYPES = dict(event_time="timestamp", amount="double", is_new_user="boolean")
KINDS = dict(amount="number", is_new_user="boolean")


def _drift_rows():
    """Key, kind, declared type, status and which lines have it; nulls are not written."""
    for name in RAW_COLUMNS:
        declared, kind = RAW_TYPES.get(name, "string"), KINDS.get(name, "string")
        if name == "user_id":
            yield name, "integer", declared, "other type", "number % 2 = 1 and user_id is not null"
            yield name, "string", declared, "as declared", "number % 2 = 0 and user_id is not null"
        elif name == "referral_code":
            yield name, kind, declared, "as declared", "number % 2 = 0 and referral_code is not null"
        elif name == "amount":
            whole = "amount is not null and amount = trunc(amount)"
            yield name, "integer", declared, "as declared", f"false and {whole}"
            yield name, "number", declared, "as declared", "amount is not null"
        else:
            yield name, kind, declared, "as declared", f"{name} is not null"
    yield "channel", "string", None, "new", "number % 2 = 1 and number % 5 <> 0"
    yield "visits", "integer", None, "new", "number % 2 = 1 and number % 5 = 0"


def _quoted(text):
    return "null" if text is None else f"'{text}'"


DRIFT = f"""{LAYERS}, numbered as (select *, cast(transaction_id as bigint) as number from raw)
select * from (""" + " union all ".join(
    f"""select '{name}' as "column", '{kind}' as kind, {_quoted(declared)} as declared, '{status}' as status,
    cast(count(*) filter (where {lines}) as bigint) as line_count from numbered"""
    for name, kind, declared, status, lines in _drift_rows()
) + ") where line_count > 0"

MERGED = f"""{LAYERS}, numbered as (select *, cast(transaction_id as bigint) as number from raw)
select transaction_id, user_id, cast(3 as bigint) as row_count,
  case when number % 2 = 1 and number % 5 <> 0 then 1::bigint else 0::bigint end as channels,
  case when number % 2 = 1 and number % 5 <> 0 then concat('app-', number % 7) end as channel,
  case when number % 2 = 1 and number % 5 = 0 then 2::bigint else 0::bigint end as visit_rows,
  case when number % 2 = 1 and number % 5 = 0 then 2.0::double * (number % 3) end as visits
from numbered"""

def _misses(lookup, key, flag):
    return f"""select '{lookup}' as lookup, cast(count(*) as bigint) as row_count,
    cast(count(*) filter (where {flag}) as bigint) as missing_rows,
    cast(count(*) filter (where {flag} and {key} is null) as bigint) as null_keys,
    round(1 - count(*) filter (where {flag}) / count(*)::double, 9) as hit_share,
    cast(count(distinct {key}) filter (where {flag}) as bigint) as exact_missing_keys,
    true as estimate_is_near from silver"""


JOIN_METRICS = SKEWED_LAYERS + " union all ".join([
    _misses("users", "user_id", "missing_user"), _misses("products", "product_id", "missing_product"),
    _misses("plans", "subscription_type", "missing_subscription"), _misses("ip_risk", "hash_ip", "missing_ip"),
])

# A visit begins where no transaction of the user lies less than the gap before.
VISITS = """{timed},
marked as (select user_id, event_time, case when event_time - lag(event_time) over w < interval {gap}
    then 0 else 1 end as begins from {table} where user_id is not null
    window w as (partition by user_id order by event_time)),
islands as (select *, sum(begins) over (partition by user_id order by event_time
    rows between unbounded preceding and current row) as visit from marked),
visits as (select user_id, min(event_time) as visit_start, max(event_time) as visit_end,
    count(*) as transactions from islands group by user_id, visit)"""

CHURN = VISITS.format(timed=SKEWED_LAYERS, gap="30 minutes", table="bronze") + """,
daily as (select user_id, event_date, count(*) as n from bronze where user_id is not null group by all),
placed as (select *, event_date - cast(row_number() over (partition by user_id order by event_date) as integer)
    as island, event_date - min(event_date) over (partition by user_id) as day from daily),
streaks as (select user_id, max(n) as longest from (select user_id, island, count(*) as n from placed group by all)
    group by user_id),
days as (select user_id, min(event_date) as first_day, max(event_date) as last_day, count(*) as active_days,
    case when count(*) > 1 then regr_slope(n, day) end as trend from placed group by user_id),
seen as (select user_id, count(*) as visits, avg(transactions) as mean_visit from visits group by user_id),
today as (select max(event_date) as today from daily)
select user_id, first_day, last_day, cast(active_days as bigint) as active_days, cast(longest as bigint)
  as longest_streak, cast(visits as bigint) as visits, round(mean_visit, 6) as mean_visit,
  round(trend, 6) as trend, cast(today - last_day as integer) as days_away, today - last_day > 14 as is_gone,
  round(active_days / (today - first_day + 1)::double, 6) as retention
from days join streaks using (user_id) join seen using (user_id), today"""

QUANTILES = f"""{SKEWED_LAYERS} select user_id, cast(count(amount) as bigint) as amount_count,
  true as usual_is_near, true as high_is_near
from bronze where user_id is not null group by user_id having count(amount) > 0"""

# A quantile is the first of a user's ordered amounts that has the share of them up to it.
ANOMALIES = f"""{LAYERS}, timed as (
  select transaction_id, user_id, time_bucket(interval 2 hours, event_time) as event_time, event_date, amount,
    risk_score, case when cast(transaction_id as bigint) % 11 <> 0
      then concat('device_', cast(cast(transaction_id as bigint) // 13 % 4 as varchar)) end as device_id
  from silver),
placed as (select user_id, amount, row_number() over (partition by user_id order by amount) as place,
    count(*) over (partition by user_id) as n from silver where amount is not null),
limits as (select user_id, cast(n as bigint) as amount_count,
    min(amount) filter (where place >= 0.5 * n) as usual_amount,
    min(amount) filter (where place >= 0.95 * n) as high_amount from placed group by user_id, n),
signals as (
  select *, count(*) over (partition by user_id, event_time) >= 2 as is_fast,
    device_id <> last_value(device_id ignore nulls) over (partition by user_id
      order by event_time, transaction_id rows between unbounded preceding and 1 preceding) as changed,
    device_id is not null and row_number() over (partition by user_id, device_id
      order by event_time, transaction_id) = 1 as is_new,
    case when amount_count >= 20 then amount > high_amount end as amount_is_high
  from timed left join limits using (user_id)),
classed as (
  select *, case when is_fast and changed then 'velocity_attack' when is_fast then 'card_testing'
    when is_new and changed and amount_is_high then 'account_takeover'
    when risk_score >= 8 and amount_is_high then 'risky_address'
    when amount_is_high then 'unusual_amount' else 'usual' end as anomaly_class from signals)
"""

ALTERED = f"""{LAYERS}, altered as (
  select * replace (case when transaction_id = '900' then amount + 1 else amount end as amount)
  from silver, range(2) copies(c)
  where c < case transaction_id when '500' then 0 when '700' then 2 else 1 end),
per_date as (
  select event_date, count(*) as b, coalesce(sum(round(amount * 10000)), 0) as b_units,
    bool_or(transaction_id in ('500', '700')) as rows_differ, bool_or(transaction_id = '900') as values_differ
  from bronze group by event_date),
altered_dates as (select event_date, count(*) as s, coalesce(sum(round(amount * 10000)), 0) as s_units
  from altered group by event_date)"""

LAYER_CHECK = f"""{ALTERED}
select event_date, 'bronze' as upstream, 'silver' as layer, cast(b as bigint) as rows_upstream,
  cast(s as bigint) as rows, round((s_units - b_units) / 10000, 4) as amount_difference,
  case when s <> b then 'rows differ' when values_differ or s_units <> b_units then 'values differ'
    else 'same' end as status
from per_date join altered_dates using (event_date)
union all select event_date, 'silver', 'risk', cast(s as bigint), cast(s as bigint), 0.0::double, 'same'
from altered_dates"""

DAILY_CHECK = f"""{ALTERED}, sums as (
  select event_date, sum(amount) as spent, count(usage_cost_ratio) as ratios from altered group by event_date),
whole as (select event_date, sum(amount) as spent, count(usage_cost_ratio) as ratios from silver group by event_date)
select event_date, 'spend' as layer, round(a.spent, 2) as expected, round(w.spent, 2) as found,
  case when abs(a.spent - w.spent) < 0.00001 then 'same' else 'differs' end as status
from sums a join whole w using (event_date)
union all select event_date, 'usage', a.ratios::double, w.ratios::double,
  case when a.ratios = w.ratios then 'same' else 'differs' end from sums a join whole w using (event_date)"""

ORACLE = {
    "q_bronze": _select("bronze"),
    "q_pii_copy": _select("raw", "transaction_id, ip_address, card_number"),
    "q_mask_parity": _select("lengths", PARITY_MASK),
    "q_mask_strict": _select("lengths", STRICT_MASK),
    "q_silver": _select("silver"),
    "q_silver_shuffled": _select("silver", layers=SKEWED_LAYERS),
    "q_missing_flags": _select(
        "silver",
        "missing_user, missing_product, missing_subscription, missing_ip, "
        "cast(count(*) as bigint) as row_count",
        "group by all",
    ),
    "q_lookup_check": LAYERS + " union all ".join([
        _profile("users", "user_id"), _profile("products", "product_id"),
        _profile("plans", "subscription_type"), _profile("ip_risk", "ip_hash"),
    ]),
    "q_lookup_csv": _select("products"),
    "q_lookup_scores": _select(
        "ip_risk", "ip_hash, risk_level, risk_score + 0.5::double as risk_score, location",
        "where ip_hash in (select hash_ip from bronze)"),
    "q_event_dates": _select("bronze", "distinct event_date", "order by event_date"),
    "q_date_slice": _select("silver", rest="where event_date = date '2024-01-15'"),
    "q_schema_diff": SCHEMA_DIFF,
    "q_geo": GEO,
    "q_geo_shuffled": GEO,
    "q_velocity": _select("bronze", VELOCITY, VELOCITY_WINDOW, SKEWED_LAYERS),
    "q_device_change": DEVICES,
    "q_join_metrics": JOIN_METRICS,
    "q_visits": VISITS.format(timed=DEVICES.split("lined as")[0].rstrip().rstrip(","), gap="5 hours", table="timed")
        + " select user_id, visit_start, visit_end, cast(transactions as bigint) as transactions from visits",
    "q_churn": CHURN,
    "q_amount_quantiles": QUANTILES,
    "q_anomalies": ANOMALIES + """select transaction_id, amount_count, usual_amount, high_amount, amount_is_high,
        anomaly_class from classed""",
    "q_anomaly_shares": ANOMALIES + """select event_date, anomaly_class, cast(count(*) as bigint) as transactions,
        round(count(*) / sum(count(*)) over (partition by event_date), 9) as share,
        round(coalesce(sum(amount), 0), 2) as amount from classed group by event_date, anomaly_class""",
    "q_user_spend": _select("spend"),
    "q_product_usage": _select("usage"),
    "q_risk_flag": _select("risk", "transaction_id, is_high_risk_txn"),
    "q_risk_alerts": _select("risk", rest="where is_high_risk_txn"),
    "q_dq_nulls": _report("silver", "silver", _nulls(SILVER_COLUMNS)),
    "q_dq_range": _report("bronze", "raw", RANGE),
    "q_dq_format": _report("bronze", "lengths", CARD + CURRENCY),
    "q_dq_format_parity": _report("bronze", "bronze", CARD + CURRENCY),
    "q_dq_custom": _report("silver", "silver", _consistency(80)),
    "q_dq_custom_rescaled": _report("silver", "silver", _consistency(7)),
    "q_dq_bronze": _report("bronze", "raw", BRONZE_REPORT, FLAWED_LAYERS),
    "q_dq_bronze_table": _report("bronze", "raw", BRONZE_REPORT, FLAWED_LAYERS),
    "q_dq_silver": _report("silver", "silver", SILVER_REPORT),
    "q_dq_empty": f"""select 'all' as layer, cast(count(*) as bigint) as total_rows,
        cast({len(BRONZE_REPORT)} as bigint) as report_rows from events""",
    "q_quarantine": _select("raw", "transaction_id", f"where {CORRUPT}"),
    "q_quarantine_rest": _select("bronze", rest=f"where not ({CORRUPT})"),
    "q_stream_bronze": _select("bronze"),
    "q_stream_bytes": _select("bronze"),
    "q_stream_named": """select 'bronze' as query_name, false as active,
        cast(count(*) as bigint) as row_count from events""",
    "q_stream_late": _select("bronze"),
    "q_stream_dedup": f"""{SENT_AGAIN},
        counted as (select number, count(*) as lines from lined group by number)
        select transaction_id, session_id, event_time, amount, hash_ip, true as has_source, lines, lines as files
        from sent join counted using (number) where number % 20 <> 0
        union all select null, session_id, event_time, amount, hash_ip, true, null, null
        from lined where number % 20 = 0""",
    "q_stream_feed_counts": f"""{SENT_AGAIN} select cast(count(*) as bigint) as lines,
        cast(0 as bigint) as corrupt_lines, cast(count(*) filter (where number % 20 <> 0)
        - count(distinct number) filter (where number % 20 <> 0) as bigint) as repeated_lines from lined""",
    "q_stream_geo": GEO,
    "q_stream_drift": DRIFT,
    "q_stream_join_metrics": JOIN_METRICS,
    "q_stream_merged": MERGED,
    "q_stream_velocity": f"""{SKEWED_LAYERS}, measured as (select {VELOCITY} from bronze {VELOCITY_WINDOW})
        select * from measured where {PASSED.format(table="bronze")}""",
    "q_stream_quantiles": QUANTILES,
    "q_stream_lifetime": f"""{SKEWED_LAYERS}, totals as (select user_id, count(*) as n,
        coalesce(sum(round(amount * 10000)), 0) / 10000 as total, min(event_time) as first_time,
        max(event_time) as last_time from bronze where user_id is not null group by user_id)
        select user_id, cast(n as bigint) as transactions, total as total_amount, total / n as mean_amount,
          first_time, last_time, total / (last_time::date - first_time::date + 1) as value_per_day from totals""",
    "q_stream_devices": f"{DEVICES} where {PASSED.format(table='timed')}",
    "q_stream_silver": _select("silver"),
    "q_stream_silver_shuffled": _select("silver", layers=SKEWED_LAYERS),
    "q_stream_alerts": _select("risk", rest="where is_high_risk_txn"),
    "q_stream_compacted": _select("spend"),
    "q_stream_compacted_usage": _select("usage"),
    "q_stream_spend": _select("spend"),
    "q_stream_usage": _select("usage"),
    "q_stream_risk": _select("risk"),
    "q_stream_dq": STREAM_DQ,
    "q_stream_pii": _select("raw", "transaction_id, ip_address, card_number"),
    "q_stream_quarantine": _select("raw", "transaction_id", f"where {CORRUPT}"),
    "q_stream_replay": LAYERS + " union all ".join([
        _rows("bronze", "bronze"), _rows("silver", "silver"), _rows("risk", "silver"),
        _rows("spend", "spend"),
    ]),
    "q_dates_again": _select(
        "risk", rest="where event_date between date '2024-01-15' and date '2024-01-17'"),
    "q_layer_check": LAYER_CHECK,
    "q_daily_check": DAILY_CHECK,
    "q_layout_again": f"""{LAYERS}
        select 'risk' as table_name, transaction_id as key, event_date,
          cast(is_high_risk_txn as integer)::double as value from risk
        union all select 'spend', user_id, event_date, "Total_spent_per_user" from spend
        union all select 'usage', product_id, event_date, average_usage_cost_ratio from usage""",
    "q_clustered": _select("risk"),
    "q_clustered_spend": _select("spend"),
    "q_clustered_usage": _select("usage"),
}
