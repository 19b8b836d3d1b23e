"""The catalog's queries once more, as plain SQL for another engine to check them with.

Written from the definitions (window frames, joins, rank sums), not from the Spark plans.
"""

from __future__ import annotations

RECORDS = """
rec as (
  select case when event_id % 211 = 0 then null
              else concat('T', lpad(cast(event_id - case when event_id % 53 = 0
                   and event_id % 211 <> 1 and event_id > 0 then 1 else 0 end as varchar), 8, '0'))
         end as transaction_id,
         concat('C', lpad(cast(user_id as varchar), 5, '0')) as customer_id,
         concat('M', lpad(cast(event_id % 200 as varchar), 4, '0')) as merchant_id,
         case event_id % 8 when 0 then 'grocery' when 1 then 'electronics' when 2 then 'travel'
              when 3 then 'restaurant' when 4 then 'fuel' when 5 then 'pharmacy'
              when 6 then 'clothing' else 'entertainment' end as merchant_category,
         value as amount,
         case when event_id % 101 = 0 then null when event_id % 97 = 0 then 'USD' else 'AUD' end as currency,
         ts,
         cast(floor(epoch(ts)) as bigint) as sec,
         concat(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '+00:00') as transaction_time,
         event_id % 5 <> 0 as card_present,
         case when event_id % 89 = 0 then null when event_id % 11 = 0 then 'US'
              when event_id % 13 = 0 then 'GB' else 'AU' end as location_country,
         event_id % 50 = 7 as is_fraud,
         cast(user_id % 4 as integer) as partition,
         event_id as offset_no,
         case when dayofmonth(ts) between 11 and 20 then 0 when dayofmonth(ts) <= 10 then 1 else 2 end as arrival
  from events
)"""

RULES = """(coalesce(amount between cast(0.01 as double) and cast(50000 as double), false)
   and coalesce(currency = 'AUD', false) and transaction_id is not null
   and customer_id is not null and merchant_id is not null and ts is not null)"""

VALID = f"{RECORDS}, valid as (select * from rec where {RULES})"

SILVER = f"""{VALID}, silver as (
  select * exclude (rn) from (
    select *, row_number() over (partition by transaction_id order by partition, offset_no) as rn from valid)
  where rn = 1)"""

# Within an arrival batch the first position wins, across batches the last batch.
UPSERTED = f"""{VALID}, silver as (
  select * exclude (rn) from (
    select *, row_number() over (partition by transaction_id order by arrival desc, partition, offset_no) as rn
    from valid)
  where rn = 1)"""

GOLD = """gold as (
  select *,
    count(transaction_id) over h as velocity_1h,
    count(transaction_id) over m as velocity_60s,
    case when coalesce(stddev_samp(amount) over w, 0) = 0 then cast(0 as double)
         else (amount - avg(amount) over w) / stddev_samp(amount) over w end as z,
    extract(hour from ts) between 1 and 5 as is_high_risk_hour,
    location_country <> 'US' as is_high_risk_country,
    merchant_category in ('electronics', 'travel') as is_high_risk_category,
    not card_present as card_not_present
  from silver
  window h as (partition by customer_id order by sec range between 3600 preceding and current row),
         m as (partition by customer_id order by sec range between 60 preceding and current row),
         w as (partition by customer_id order by sec range between 604800 preceding and current row))"""

MART = """mart as (
  select transaction_id, customer_id, is_fraud, amount, round(z, 6) + 0.0 as amount_zscore, velocity_1h,
    cast(coalesce(is_high_risk_hour, false) as integer) as is_high_risk_hour,
    cast(coalesce(is_high_risk_country, false) as integer) as is_high_risk_country,
    cast(coalesce(is_high_risk_category, false) as integer) as is_high_risk_category,
    cast(coalesce(card_not_present, false) as integer) as card_not_present,
    cast(coalesce(cast(is_high_risk_hour as integer), 0) + coalesce(cast(is_high_risk_country as integer), 0)
       + coalesce(cast(is_high_risk_category as integer), 0) + coalesce(cast(card_not_present as integer), 0)
       + case when velocity_1h >= 3 then 2 else 0 end as integer) as fraud_risk_score,
    cast(extract(hour from ts) as integer) as transaction_hour,
    cast(isodow(ts) - 1 as integer) as transaction_dow
  from gold)"""

SCORED = """scored as (
  select transaction_id, customer_id, amount, is_fraud, round(-abs(z), 6) + 0.0 as anomaly_score from gold),
cuts as (
  select quantile_cont(anomaly_score, 0.02) as p2, quantile_cont(anomaly_score, 0.10) as p10,
         quantile_cont(anomaly_score, 0.25) as p25 from scored),
flagged as (
  select scored.*, anomaly_score < (select p2 from cuts) as is_predicted_fraud,
         case when anomaly_score <= (select p10 from cuts) then 'high'
              when anomaly_score <= (select p25 from cuts) then 'medium' else 'low' end as risk_tier
  from scored)"""

FIELDS = """transaction_id, customer_id, merchant_id, merchant_category, amount, currency, transaction_time,
  card_present, location_country, is_fraud"""
POSITION = 'partition, offset_no as "offset"'
GOLD_FIELDS = """velocity_1h, round(z, 6) + 0.0 as amount_zscore, is_high_risk_hour, is_high_risk_country,
  is_high_risk_category, card_not_present"""
REQUIRED = "transaction_id is not null and customer_id is not null and amount is not null"


# Records that break every rule of Silver, and messages that are no JSON.
ROUGH = f"""{RECORDS}, rough as (
  select offset_no, transaction_id, currency,
    case when offset_no % 103 = 0 then 0 when offset_no % 107 = 0 then 50000.01 when offset_no % 109 = 0 then null
         else amount end as amount,
    case when offset_no % 113 <> 0 then customer_id end as customer_id,
    offset_no % 127 <> 0 and merchant_id is not null as has_merchant,
    offset_no % 131 <> 0 and offset_no % 137 <> 0 and ts is not null as has_time
  from rec),
broken as (
  select offset_no, amount, customer_id, list_filter([
      case when not coalesce(amount >= 0.01::double and amount <= 50000, false) then 'amount' end,
      case when not coalesce(currency = 'AUD', false) then 'currency' end,
      case when transaction_id is null then 'transaction_id' end, case when customer_id is null then 'customer_id' end,
      case when not has_merchant then 'merchant_id' end, case when not has_time then 'transaction_time' end],
    lambda r: r is not null) as rules
  from rough)"""

FILE = """least(4, offset_no * 5 // ((select max(event_id) from events) + 1) + case when offset_no % 17 = 5 then 2 else 0 end)"""
# A row is late if it is ten minutes or more older than the latest valid row of the files up to the last but one;
# when the streams are stopped, after the third file, the mark moves up to that file. A transaction is known
# for a file longer.
ARRIVED = f"""filed as (select *, {FILE} as file from valid),
marks as (
  select m.file, date_trunc('millisecond', max(f.ts)) - interval 10 minute as mark
  from (select unnest([2, 3, 4]) as file, unnest([0, 2, 2]) as known) m join filed f on f.file <= m.known group by m.file),
timely as (select filed.*, coalesce(ts <= mark, false) as late from filed left join marks using (file)),
arrived as (
  select t.*, t.late or exists (
    select 1 from timely b where b.transaction_id = t.transaction_id and b.file = t.file - 1 and not b.late) as dropped
  from timely t)"""


def _with(*parts: str) -> str:
    return "with " + ", ".join(parts) + " "


_MART_ROWS = _with(SILVER, GOLD, MART) + "select * from mart"
_CUTS = (
    _with(SILVER, GOLD, SCORED)
    + "select round(p2, 9) + 0.0 as p2, round(p10, 9) + 0.0 as p10, round(p25, 9) + 0.0 as p25 from cuts"
)
_GOLD_ROWS = _with(SILVER, GOLD) + f"select {FIELDS}, {GOLD_FIELDS} from gold"
_UPSERTED_ROWS = _with(UPSERTED) + f'select {FIELDS}, offset_no as "offset" from silver'
_TOTALS = """
  count(*) as n_scored, count(*) filter (where is_predicted_fraud) as n_predicted_fraud,
  round(count(*) filter (where is_predicted_fraud) / cast(count(*) as double), 6) as predicted_fraud_rate,
  count(*) filter (where is_fraud) as n_actual_fraud,
  round(count(*) filter (where is_fraud) / cast(count(*) as double), 6) as actual_fraud_rate"""


#: The model's features in its order; a node picks among them by position.
FEATURE_LIST = """['amount', 'amount_zscore', 'velocity_1h', 'is_high_risk_hour', 'is_high_risk_country',
  'is_high_risk_category', 'card_not_present', 'fraud_risk_score', 'transaction_hour', 'transaction_dow']"""
N_FEATURES = 10


def _number(digest: str, at: int, length: int) -> str:
    return f"cast('0x' || substr({digest}, {at}, {length}) as bigint)"


def _each(expression: str) -> str:
    """A list with the expression for each feature's value, written ``?``."""
    return "[" + ", ".join(expression.replace("?", f"x[{i}]") for i in range(1, N_FEATURES + 1)) + "]"


# Each of 100 trees takes the 256 rows of lowest draw. A node picks one of the features that differ among
# its rows, and a split between that feature's extremes, by its own digest.
FOREST = f"""points as (
  select transaction_id, is_fraud, [amount, amount_zscore, velocity_1h, is_high_risk_hour, is_high_risk_country,
    is_high_risk_category, card_not_present, fraud_risk_score, transaction_hour, transaction_dow] as x,
    md5('42:' || transaction_id) as digest from mart),
shape as (select least(256, count(*)) as size, greatest(1, ceil(log2(greatest(2, least(256, count(*)))))) as height from points),
samples as (
  select * from (
    select tree_id, transaction_id, x, row_number() over (partition by tree_id order by
      ({_number("digest", 1, 12)} + tree_id * {_number("digest", 13, 12)}) % 281474976710597, transaction_id) as rn
    from points, (select unnest(range(100)) as tree_id))
  where rn <= (select size from shape)),
placed as (
  select tree_id, 1 as node_id, 0 as depth, transaction_id, x from samples
  union all
  select tree_id, case when x[f] <= split then 2 * node_id else 2 * node_id + 1 end, depth + 1, transaction_id, x
  from (
    select *, case when low[f] + part * (high[f] - low[f]) >= high[f] then low[f]
                   else low[f] + part * (high[f] - low[f]) end as split
    from (
      select *, differing[1 + {_number("digest", 1, 8)} % len(differing)] as f,
             {_number("digest", 9, 12)} / 281474976710656.0::double as part
      from (
        select *, md5(concat_ws(':', 42, tree_id, node_id)) as digest,
               list_filter(range(1, {N_FEATURES + 1}), lambda i: low[i] < high[i]) as differing
        from (
          select *, {_each("min(?) over g")} as low, {_each("max(?) over g")} as high from placed
          where depth < (select height from shape)
          window g as (partition by tree_id, node_id)))
      where len(differing) > 0)))"""

NODES = f"""held as (
  select tree_id, node_id, any_value(depth) as depth, count(*) as n_rows, {_each("min(?)")} as low, {_each("max(?)")} as high,
    md5(concat_ws(':', 42, tree_id, node_id)) as digest
  from placed group by tree_id, node_id),
picked as (
  select held.*, list_filter(range(1, {N_FEATURES + 1}), lambda i: low[i] < high[i] and depth < height) as differing
  from held, shape),
cut_at as (
  select *, case when len(differing) > 0 then differing[1 + {_number("digest", 1, 8)} % len(differing)] end as f,
    {_number("digest", 9, 12)} / 281474976710656.0::double as part from picked),
nodes as materialized (
  select tree_id, node_id, f, depth, n_rows as size,
    case when low[f] + part * (high[f] - low[f]) >= high[f] then low[f] else low[f] + part * (high[f] - low[f]) end as split
  from cut_at)"""


def _path(n: str) -> str:
    """Expected depth of an unsuccessful search among n points."""
    return f"""case when {n} > 2 then 2 * (ln({n} - 1) + 0.5772156649015329) - 2.0::double * ({n} - 1) / {n}
      when {n} = 2 then 1 else 0 end"""


# Paths are summed in the order of the trees, as sums in another order differ in their last digits.
FOREST_SCORED = f"""walk as (
  select transaction_id, x, tree_id, 1 as node_id from points, (select unnest(range(100)) as tree_id)
  union all
  select transaction_id, x, w.tree_id, case when x[f] <= split then 2 * w.node_id else 2 * w.node_id + 1 end
  from walk w join nodes n on n.tree_id = w.tree_id and n.node_id = w.node_id and f is not null),
paths as (
  select transaction_id, w.tree_id, depth + {_path("size")} as path
  from walk w join nodes n on n.tree_id = w.tree_id and n.node_id = w.node_id and f is null),
scored as materialized (
  select transaction_id, is_fraud, -pow(2.0::double, -total / 100 / (select {_path("size")} from shape)) as anomaly_score
  from (select transaction_id, list_sum(list(path order by tree_id)) as total from paths group by transaction_id)
  join points using (transaction_id)),
cuts as (
  select quantile_cont(anomaly_score, 0.02) as p2, quantile_cont(anomaly_score, 0.10) as p10,
         quantile_cont(anomaly_score, 0.25) as p25 from scored),
flagged as (
  select transaction_id, is_fraud, anomaly_score, anomaly_score < (select p2 from cuts) as is_predicted_fraud,
         case when anomaly_score <= (select p10 from cuts) then 'high'
              when anomaly_score <= (select p25 from cuts) then 'medium' else 'low' end as risk_tier
  from scored)"""

# Mann-Whitney: the sum of the positives' mid-ranks.
AUC = """ranked as (
  select is_fraud, rank() over (order by -anomaly_score)
         + (count(*) over (partition by anomaly_score) - 1) / 2.0 as mid_rank from scored),
sums as (
  select sum(case when is_fraud then mid_rank end) as r, cast(count(*) filter (where is_fraud) as double) as p,
         cast(count(*) filter (where not is_fraud) as double) as n from ranked)"""
CONFUSED = """c as (
  select cast(count(*) filter (where is_fraud and is_predicted_fraud) as double) as tp,
         count(*) filter (where not is_fraud and is_predicted_fraud) as fp,
         count(*) filter (where is_fraud and not is_predicted_fraud) as fn,
         count(*) as n_samples, count(*) filter (where is_fraud) as n_fraud,
         count(*) filter (where not is_fraud) as n_legit
  from flagged)"""
PRECISION = "round(case when tp + fp = 0 then 0 else tp / (tp + fp) end, 6)"
RECALL = "round(case when tp + fn = 0 then 0 else tp / (tp + fn) end, 6)"
F1 = "round(case when 2 * tp + fp + fn = 0 then 0 else 2 * tp / (2 * tp + fp + fn) end, 6)"
ROC_AUC = "round((r - p * (p + 1) / 2) / (p * n), 6)"

_GROWN = "with recursive " + ", ".join((SILVER, GOLD, MART, FOREST, NODES))
_FOREST_SCORES = f"""{_GROWN}, {FOREST_SCORED}
  select transaction_id, round(anomaly_score, 6) + 0.0 as anomaly_score, is_predicted_fraud, risk_tier from flagged"""


def _late(step: int, most_ms: int) -> str:
    return f"cast(offset_no * {step} % {most_ms} as double) / 1000"


ORACLE: dict[str, str] = {
    "txn_records": _with(RECORDS) + f"select {FIELDS}, {POSITION} from rec",
    "bronze_parsed": _with(RECORDS) + f"select {FIELDS}, {POSITION}, cast(0 as bigint) as batch_id from rec",
    "bronze_valid": _with(RECORDS) + f"select {FIELDS}, {POSITION} from rec where {REQUIRED}",
    "bronze_quarantine": _with(RECORDS)
    + f"select {FIELDS}, {POSITION}, true as has_raw_value from rec where not ({REQUIRED})",
    "bronze_batch_metrics": _with(RECORDS)
    + f"""select count(*) as n_rows, count(*) filter (where {REQUIRED}) as n_valid,
          count(*) filter (where not ({REQUIRED})) as n_quarantined,
          round(avg(case when {REQUIRED} then cast(is_fraud as integer) end), 6) as fraud_rate from rec""",
    "silver_valid": _with(VALID) + f'select {FIELDS}, offset_no as "offset" from valid',
    "silver_invalid_reasons": _with(RECORDS)
    + f"""select offset_no as "offset", amount, currency, concat_ws(',',
            case when not coalesce(amount between cast(0.01 as double) and cast(50000 as double), false)
                 then 'amount' end,
            case when not coalesce(currency = 'AUD', false) then 'currency' end,
            case when transaction_id is null then 'transaction_id' end) as failed_rules
          from rec where not {RULES}""",
    "silver_rule_counts": _with(RECORDS)
    + """, broken as (
            select 'amount' as rule from rec
              where not coalesce(amount between cast(0.01 as double) and cast(50000 as double), false)
            union all select 'currency' from rec where not coalesce(currency = 'AUD', false)
            union all select 'transaction_id' from rec where transaction_id is null)
          select rule, count(*) as n_rows from broken group by rule""",
    "quarantine_written": _with(RECORDS)
    + f"""select case when offset_no % 139 <> 0 then transaction_id end as transaction_id,
            case when offset_no % 139 <> 0 then customer_id end as customer_id,
            case when offset_no % 139 <> 0 then amount end as amount, partition, offset_no as "offset",
            transaction_time as kafka_time, case when offset_no % 139 = 0 then concat('{{bad ', offset_no) end as raw_value
          from rec where offset_no % 139 = 0 or not ({REQUIRED})""",
    "silver_rules_broken": _with(ROUGH)
    + "select rule, count(*) as n_rows from (select unnest(rules) as rule from broken) group by rule",
    "silver_rows_broken": _with(ROUGH)
    + """select offset_no as "offset", amount, customer_id, array_to_string(rules, ',') as failed_rules
         from broken where len(rules) > 0""",
    "silver_dedup": _with(SILVER) + f"select {FIELDS}, {POSITION} from silver",
    "silver_upsert": _UPSERTED_ROWS,
    "gold_velocity_1h": _with(SILVER, GOLD) + "select transaction_id, customer_id, velocity_1h from gold",
    "gold_amount_zscore": _with(SILVER, GOLD)
    + "select transaction_id, amount, round(z, 6) + 0.0 as amount_zscore from gold",
    "gold_risk_flags": _with(SILVER, GOLD)
    + """select transaction_id, is_high_risk_hour, is_high_risk_country, is_high_risk_category, card_not_present
         from gold""",
    "gold_rolling_stats": _with(SILVER)
    + """select transaction_id, round(avg(amount) over w, 6) + 0.0 as amount_7d_mean,
                round(stddev_samp(amount) over w, 6) + 0.0 as amount_7d_stddev
         from silver
         window w as (partition by customer_id order by sec range between 604800 preceding and current row)""",
    "gold_features": _GOLD_ROWS,
    "gold_burst_60s": _with(SILVER, GOLD)
    + "select transaction_id, customer_id, velocity_60s, velocity_60s >= 2 as is_burst from gold",
    "gold_incremental": _with(UPSERTED, GOLD) + f"select {FIELDS}, {GOLD_FIELDS} from gold",
    "union_by_name_scan": _with(SILVER)
    + """select transaction_id, customer_id, amount,
                case when dayofmonth(ts) > 15 then location_country end as location_country from silver""",
    "append_schema_merge": _with(RECORDS)
    + """select transaction_id, amount, offset_no as "offset", cast(arrival as bigint) as batch_id,
                case when arrival > 0 then card_present end as card_present from rec""",
    "compaction": _UPSERTED_ROWS,
    "change_log_latest": _with(UPSERTED)
    + """select transaction_id, amount, offset_no as "offset", cast(arrival as bigint) as log_batch_id from silver""",
    "retention_filter": _with(SILVER)
    + """select transaction_id, customer_id, amount, transaction_time from silver
         where ts >= timestamp '2024-01-31 00:00:00' - interval 7 day""",
    # Past seven days are batches 0 to 22; Silver has read 0 to 14, the last of which it may read on in.
    "bronze_retention": _with(RECORDS)
    + f"""select {FIELDS}, offset_no as "offset", cast(dayofmonth(ts) - 1 as bigint) as batch_id from rec
          where dayofmonth(ts) - 1 > 13""",
    # A day's version is the last arrival that has a valid row of it, or another version of one of its keys.
    "compaction_days": _with(VALID)
    + """, firsts as (
            select * exclude (rn) from (
              select *, row_number() over (partition by transaction_id, arrival order by partition, offset_no) as rn from valid)
            where rn = 1),
          dated as (select transaction_id, arrival, cast(floor(sec / 86400.0) as bigint) as day from firsts),
          moved as (
            select day, arrival from dated
            union all select a.day, b.arrival from dated a join dated b
              on a.transaction_id = b.transaction_id and b.arrival > a.arrival),
          latest as (select transaction_id, arg_max(day, arrival) as day from dated group by transaction_id)
          select l.day, count(*) as n_rows, any_value(v.version) as version
          from latest l join (select day, cast(max(arrival) as bigint) as version from moved group by day) v on l.day = v.day
          group by l.day""",
    "mart_table": _with(UPSERTED, GOLD, MART) + "select * from mart",
    "feature_mart": _MART_ROWS,
    "mart_sql_view": _MART_ROWS,
    "mart_fallback": _MART_ROWS,
    "feature_matrix": _with(SILVER, GOLD, MART)
    + "select * exclude (customer_id, is_fraud), cast(is_fraud as integer) as label from mart",
    "label_rate": _with(SILVER) + "select round(avg(cast(is_fraud as integer)), 6) as label_rate from silver",
    "sample_counts": _with(SILVER)
    + """select count(*) as n_samples, count(*) filter (where is_fraud) as n_fraud,
                count(*) filter (where not is_fraud) as n_legit from silver""",
    "score_thresholds": _CUTS,
    "score_thresholds_by_bins": _CUTS,
    "predicted_fraud": _with(SILVER, GOLD, SCORED)
    + "select transaction_id, anomaly_score, is_predicted_fraud from flagged",
    "risk_tiers": _with(SILVER, GOLD, SCORED) + "select transaction_id, anomaly_score, risk_tier from flagged",
    "tier_counts": _with(SILVER, GOLD, SCORED)
    + "select risk_tier, count(*) as n_rows from flagged group by risk_tier",
    "scoring_run_metrics": _with(SILVER, GOLD, SCORED) + f"select {_TOTALS} from flagged",
    "run_metrics_log": _with(SILVER, GOLD, SCORED)
    + f""", totals as (select {_TOTALS} from flagged)
          select 'run-1' as run_id, 'metric' as kind, name, value from (
            select 'n_scored' as name, cast(n_scored as double) as value from totals
            union all select 'n_predicted_fraud', cast(n_predicted_fraud as double) from totals
            union all select 'predicted_fraud_rate', predicted_fraud_rate from totals
            union all select 'n_actual_fraud', cast(n_actual_fraud as double) from totals
            union all select 'actual_fraud_rate', actual_fraud_rate from totals)""",
    "top_risk_sample": _with(SILVER, GOLD, SCORED)
    + """select transaction_id, customer_id, amount, anomaly_score, risk_tier, is_fraud from flagged
         where risk_tier = 'high' order by anomaly_score, transaction_id limit 10""",
    "classification_metrics": _with(SILVER, GOLD, SCORED, CONFUSED)
    + f"select {PRECISION} as precision, {RECALL} as recall, {F1} as f1, n_samples, n_fraud, n_legit from c",
    "confusion_matrix": _with(SILVER, GOLD, SCORED)
    + """select cast(is_fraud as integer) as label, cast(is_predicted_fraud as integer) as predicted,
                count(*) as n_rows from flagged group by 1, 2""",
    "roc_auc": _with(SILVER, GOLD, SCORED, AUC) + f"select {ROC_AUC} as roc_auc from sums",
    "forest_nodes": f"""{_GROWN}
          select cast(tree_id as integer) as tree_id, cast(node_id as integer) as node_id, {FEATURE_LIST}[f] as feature,
            round(split, 6) + 0.0 as split,
            cast(case when f is not null then 2 * node_id end as integer) as "left",
            cast(case when f is not null then 2 * node_id + 1 end as integer) as "right",
            size, cast(depth as integer) as depth, (select size from shape) as sample_size from nodes""",
    "forest_scores": _FOREST_SCORES,
    "train_and_score": _FOREST_SCORES,
    "training_run_log": f"""{_GROWN}, {FOREST_SCORED}, {CONFUSED}, {AUC}, logged as (
            select 'metric' as kind, unnest(['precision', 'recall', 'f1', 'n_samples', 'n_fraud', 'n_legit', 'roc_auc']) as name,
              cast(null as varchar) as value,
              unnest([{PRECISION}, {RECALL}, {F1}, n_samples, n_fraud, n_legit, {ROC_AUC}]) as measure
            from c, sums
            union all
            select 'param', unnest(['model_type', 'contamination', 'n_estimators', 'max_samples', 'random_state', 'n_features',
                'features']),
              unnest(['IsolationForest', '0.02', '100', '256', '42', '10', array_to_string({FEATURE_LIST}, ',')]), null)
          select 'train-1' as run_id, kind, name, value, measure from logged""",
    "forest_tree_sizes": _with(SILVER)
    + """, n as (select least(256, count(*)) as size from silver)
          select cast(t as integer) as tree_id, size, size as sample_size
          from n, (select unnest(range(100)) as t)""",
    "stream_bronze": _with(RECORDS) + f"select {FIELDS}, {POSITION} from rec where {REQUIRED}",
    "stream_silver_gold": _GOLD_ROWS,
    "stream_dedup_watermark": _with(VALID) + "select distinct transaction_id from valid",
    "stream_silver_watermark": _with(VALID, ARRIVED)
    + "select distinct transaction_id from arrived where not late",
    "stream_batch_metrics": _with(VALID, ARRIVED)
    + f""", sent as (select *, {FILE} as file from rec),
          bronze as (
            select file, count(*) as n_rows, count(*) filter (where {REQUIRED}) as n_valid,
              count(*) filter (where not ({REQUIRED})) as n_quarantined,
              round(avg(case when {REQUIRED} then cast(is_fraud as integer) end), 6) as fraud_rate,
              count(*) filter (where {REQUIRED} and not {RULES}) as n_invalid from sent group by file),
          passed as (
            select file, count(distinct transaction_id) filter (where not dropped) as n_passed,
              count(*) filter (where late) as n_late from arrived group by file)
          select 'bronze' as layer, cast(file as integer) as file, n_rows, n_valid, n_quarantined,
            cast(null as bigint) as n_invalid, cast(0 as bigint) as n_late, fraud_rate, true as has_time from bronze
          union all select 'silver', cast(file as integer), n_passed + n_invalid, null, null, n_invalid, n_late, null, true
          from bronze join passed using (file)""",
    "sla_latency": _with(SILVER)
    + f""", stamps as (
            select 'bronze' as layer, cast(5 as double) as target_seconds, {_late(37, 7_000)} as s from silver
            union all select 'silver', 30, {_late(101, 29_000)} from silver
            union all select 'gold', 120, {_late(977, 130_000)} from silver)
          select layer, target_seconds, count(*) as n_rows, quantile_disc(s, 0.5) as p50_seconds,
                 quantile_disc(s, 0.95) as p95_seconds, max(s) as max_seconds,
                 count(*) filter (where s >= target_seconds) as n_late,
                 quantile_disc(s, 0.95) >= target_seconds as breached
          from stamps group by layer, target_seconds""",
}
