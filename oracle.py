"""Plain SQL for the registered queries, written apart from the Spark code.

Only the adapter text, which maps the driver's tables to transactions, is
shared. Window sums run over exact decimals and frames are the literal
seven-day RANGE, not the running differences the Spark plans use.
"""

from __future__ import annotations

from tidewatch.sources import generator as G
from tidewatch.sources.adapters import EVENTS_SQL, ORDERS_SQL, STRUCTURING_SQL

GATE_COLUMNS = ("transaction_id", "customer_id", "amount", "currency", "timestamp")


def accepted(adapter: str) -> str:
    known = " and ".join(f"{c} is not null" for c in GATE_COLUMNS)
    return f"select * from ({adapter}) where {known} and amount > 0"



RISKY = "('CY', 'MT', 'PAN', 'BVI', 'SCH')"
IDENTITY = "transaction_id, customer_id, amount, currency, channel"
RAW = (
    "transaction_id, customer_id, originator_account, beneficiary_account, amount, currency, channel, "
    "originator_country, beneficiary_country, timestamp, is_flagged_source"
)


def r2(x: str) -> str:
    return f"floor(({x}) * 100 + 0.5) / 100"


def r4(x: str) -> str:
    return f"floor(({x}) * 10000 + 0.5) / 10000"


def base(adapter: str, where: str = "") -> str:
    """CTEs txn (adapter) and feat (all features)."""
    return f"""
with txn as ({adapter}),
keyed as (
  select *, epoch_us(timestamp) // 1000000 as s, cast(amount as decimal(38,6)) as d
  from txn {where}
),
win as (
  select *,
    sum(d) over w7 as roll_d,
    count(*) over w7 as rolling_7d_count,
    sum(d) over wc as cum_d,
    count(*) over wc as cumulative_count,
    lag(timestamp) over wl as prev_timestamp
  from keyed
  window
    w7 as (partition by customer_id order by s range between 604800 preceding and current row),
    wc as (partition by customer_id order by s, timestamp, transaction_id
           rows between unbounded preceding and current row),
    wl as (partition by customer_id order by s, timestamp, transaction_id)
),
feat0 as (
  select *,
    cast(roll_d as double) as rolling_7d_amount,
    cast(roll_d as double) / rolling_7d_count as rolling_7d_avg,
    cast(cum_d as double) as cumulative_amount,
    s - epoch_us(prev_timestamp) // 1000000 as gap_s,
    (epoch_us(timestamp) - epoch_us(prev_timestamp)) // 1000000 as gap_e,
    originator_country in {RISKY} as risky_from,
    beneficiary_country in {RISKY} as risky_to
  from win
),
feat as (
  select *,
    case when rolling_7d_avg > 0 then amount / rolling_7d_avg end as ratio,
    cast(timestamp as date) as date,
    cast(extract(hour from timestamp) as integer) as hour,
    cast(extract(dow from timestamp) as integer) + 1 as day_of_week,
    extract(dow from timestamp) in (0, 6) as is_weekend,
    extract(hour from timestamp) < 6 or extract(hour from timestamp) >= 22 as is_offhours,
    coalesce(risky_from, false) or coalesce(risky_to, false) as risky_safe,
    risky_from or risky_to as risky_3vl
  from feat0
)"""


def score(adapter: str, gap: str = "gap_s", risky: str = "risky_safe") -> str:
    """base + CTE scored with flags, score and tier."""
    return (
        base(adapter)
        + f""",
flags as (
  select *,
    {gap} as seconds_since_last_txn,
    ratio as amount_vs_7d_avg_ratio,
    {risky} as involves_high_risk_country,
    amount >= 9000 and amount <= 9999.99 and rolling_7d_count >= 3 as flag_structuring,
    rolling_7d_count >= 5 and rolling_7d_amount >= 20000 as flag_high_velocity,
    {risky} as flag_high_risk_country,
    ratio is not null and ratio >= 3.0 as flag_amount_spike,
    {gap} is not null and {gap} <= 300 as flag_rapid_succession
  from feat
),
points as (
  select *,
    flag_structuring::int + flag_high_velocity::int + flag_high_risk_country::int
      + flag_amount_spike::int + flag_rapid_succession::int as flag_count,
    flag_structuring::int * 30 + flag_high_velocity::int * 25 + flag_high_risk_country::int * 20
      + flag_amount_spike::int * 15 + flag_rapid_succession::int * 10 as risk_score
  from flags
),
scored as (
  select *, case when risk_score >= 50 then 'HIGH' when risk_score >= 25 then 'MEDIUM'
                 when risk_score > 0 then 'LOW' else 'NONE' end as risk_tier
  from points
)"""
    )


FLAGS = (
    "flag_structuring, flag_high_velocity, flag_high_risk_country, flag_amount_spike, flag_rapid_succession"
)
CALENDAR = "date, hour, day_of_week, is_weekend, is_offhours"
HISTORY = (
    "rolling_7d_amount, rolling_7d_count, rolling_7d_avg, cumulative_amount, cumulative_count, "
    "seconds_since_last_txn, amount_vs_7d_avg_ratio"
)
SCORED_COLUMNS = (
    f"{RAW}, {CALENDAR}, involves_high_risk_country, {HISTORY}, {FLAGS}, flag_count, risk_score, risk_tier"
)
ALERT = (
    "transaction_id, customer_id, timestamp, amount, currency, channel, originator_country, "
    "beneficiary_country, risk_score, risk_tier, flag_count, rolling_7d_amount, rolling_7d_count"
)
ROUNDED = (
    f"{r2('rolling_7d_amount')} as rolling_7d_amount, rolling_7d_count, {r2('rolling_7d_avg')} as rolling_7d_avg, "
    f"{r4('amount_vs_7d_avg_ratio')} as amount_vs_7d_avg_ratio, seconds_since_last_txn"
)
FLAGGED_COLUMNS = (
    "transaction_id, customer_id, originator_account, beneficiary_account, amount, currency, channel, "
    f"originator_country, beneficiary_country, timestamp as transaction_timestamp, is_flagged_source, {ROUNDED}, {FLAGS}"
)
PLACES = "originator_country, beneficiary_country"

CONFUSION = """select
    count(*) filter (where label and guess) as tp,
    count(*) filter (where not label and guess) as fp,
    count(*) filter (where not label and not guess) as tn,
    count(*) filter (where label and not guess) as fn
  from (select is_flagged_source as label, risk_score >= 25 as guess from scored)"""

RANKED = """,
per_score as (
  select cast(risk_score as double) as score,
    count(*) filter (where is_flagged_source) as pos,
    count(*) filter (where not is_flagged_source) as neg
  from scored group by risk_score
),
tot as (select sum(pos) as p, sum(neg) as n from per_score),
ranked as (
  select score, pos, neg, p, n,
    coalesce(sum(pos) over (order by score desc rows between unbounded preceding and 1 preceding), 0) as above_p,
    coalesce(sum(neg) over (order by score desc rows between unbounded preceding and 1 preceding), 0) as above_n
  from per_score, tot
)"""


def _oracles() -> dict[str, str]:
    every = EVENTS_SQL
    ev, od, st = accepted(EVENTS_SQL), accepted(ORDERS_SQL), accepted(STRUCTURING_SQL)
    sql: dict[str, str] = {}

    # scans, sinks, staging
    sql["scan_transactions"] = f"with txn as ({every}) select {RAW} from txn"
    sql["scan_scored"] = f"{score(ev)} select {SCORED_COLUMNS} from scored"
    sql["sink_parquet_roundtrip"] = f"{score(ev)} select {ALERT} from scored where risk_score >= 25"
    sql["load_typed_table"] = f"with txn as ({ev}) select {RAW} from txn"
    sql["load_detected_table"] = f"{score(ev)} select {ALERT} from scored where risk_score >= 25"
    sql["stg_transactions"] = (
        f"with txn as ({every}) select transaction_id, customer_id, originator_account, beneficiary_account, "
        f"cast(amount as double) as amount, currency, channel, {PLACES}, "
        "timestamp as transaction_timestamp, is_flagged_source from txn"
    )
    sql["materialised_models"] = (
        f"{score(ev, 'gap_e', 'risky_3vl')} select risk_tier, count(*) as n from scored "
        "where risk_score >= 25 group by risk_tier"
    )

    # scalar features
    sql["calendar_features"] = f"{base(ev)} select transaction_id, timestamp, {CALENDAR} from feat"
    sql["calendar_features_orders"] = f"{base(od)} select transaction_id, timestamp, {CALENDAR} from feat"
    country = "select transaction_id, originator_country, beneficiary_country, {} as involves_high_risk_country from feat"
    sql["high_risk_feature"] = f"{base(ev)} {country.format('risky_safe')}"
    sql["high_risk_feature_3vl"] = f"{base(ev)} {country.format('risky_3vl')}"
    sql["ref_high_risk_countries"] = (
        f"{base(ev)} select transaction_id, originator_country, beneficiary_country, "
        "coalesce(originator_country in ('CY', 'MT', 'SE'), false) "
        "or coalesce(beneficiary_country in ('CY', 'MT', 'SE'), false) as involves_high_risk_country from feat"
    )
    gap = "select transaction_id, customer_id, timestamp, prev_timestamp, {} as seconds_since_last_txn from feat"
    sql["inter_arrival"] = f"{base(ev)} {gap.format('gap_s')}"
    sql["inter_arrival_elapsed"] = f"{base(ev)} {gap.format('gap_e')}"
    sql["txn_features"] = (
        f"{base(ev)} select {RAW}, {CALENDAR}, risky_safe as involves_high_risk_country, rolling_7d_amount, "
        "rolling_7d_count, rolling_7d_avg, cumulative_amount, cumulative_count, gap_s as seconds_since_last_txn, "
        "ratio as amount_vs_7d_avg_ratio from feat"
    )

    # windows
    rolling = "select transaction_id, customer_id, rolling_7d_amount, rolling_7d_count, rolling_7d_avg from feat"
    sql["rolling_7d"] = f"{base(ev)} {rolling}"
    sql["rolling_7d_orders"] = f"{base(od)} {rolling}"
    sql["rolling_7d_split"] = sql["rolling_7d"]
    running = "select transaction_id, customer_id, cumulative_amount, cumulative_count from feat"
    sql["cumulative"] = f"{base(ev)} {running}"
    sql["cumulative_orders"] = f"{base(od)} {running}"
    opened = """
with txn as ({adapter}),
keyed as (select *, epoch_us(timestamp) as us, cast(amount as decimal(38,6)) as d from txn),
win as (
  select transaction_id, customer_id, us, d,
    sum(d) over (partition by customer_id order by us, transaction_id
                 rows between unbounded preceding and current row) as cum_d,
    count(*) over (partition by customer_id order by us, transaction_id
                   rows between unbounded preceding and current row) as cum_n,
    sum(d) over (partition by customer_id order by us
                 range between unbounded preceding and 604800000000 preceding) as old_d,
    count(*) over (partition by customer_id order by us
                   range between unbounded preceding and 604800000000 preceding) as old_n
  from keyed
)
select transaction_id, customer_id,
  cast(cum_d - coalesce(old_d, 0) as double) as rolling_7d_amount,
  cum_n - old_n as rolling_7d_count,
  cast(cum_d - coalesce(old_d, 0) as double) / (cum_n - old_n) as rolling_7d_avg
from win"""
    sql["cumulative_split"] = sql["cumulative"]
    sql["inter_arrival_split"] = sql["inter_arrival"]
    sql["rolling_7d_open_split"] = opened.format(adapter=ev)
    sql["rolling_7d_open"] = opened.format(adapter=ev)
    sql["rolling_7d_open_orders"] = opened.format(adapter=od)

    # typologies
    sql["typology_structuring"] = (
        f"{base(ev)} select {IDENTITY}, {PLACES}, timestamp, rolling_7d_count, "
        f"{r2('rolling_7d_amount')} as rolling_7d_amount, 'structuring' as typology from feat "
        "where amount between 9000 and 9999.99 and rolling_7d_count >= 3"
    )
    sql["typology_structuring_subthreshold"] = (
        f"{base(st, 'where amount between 9000 and 9999.99')} select {IDENTITY}, {PLACES}, timestamp, "
        f"rolling_7d_count as sub_threshold_count_7d, {r2('rolling_7d_amount')} as sub_threshold_volume_7d, "
        "'structuring' as typology from feat where rolling_7d_count >= 3"
    )
    sql["typology_velocity"] = (
        f"{base(ev)} select {IDENTITY}, {PLACES}, timestamp, rolling_7d_count, "
        f"{r2('rolling_7d_amount')} as rolling_7d_amount, {r2('rolling_7d_avg')} as rolling_7d_avg, "
        "'high_velocity_layering' as typology from feat where rolling_7d_count >= 5 and rolling_7d_amount >= 20000"
    )
    sql["typology_high_risk_country"] = (
        f"{base(ev)} select {IDENTITY}, originator_country, risky_from as originator_is_high_risk, "
        "beneficiary_country, risky_to as beneficiary_is_high_risk, timestamp, "
        f"{r2('rolling_7d_amount')} as rolling_7d_amount, rolling_7d_count, "
        "'high_risk_country_routing' as typology from feat where risky_from or risky_to"
    )
    spike = (
        "select {i}, {p}, timestamp, {avg} as rolling_7d_avg, rolling_7d_count, "
        "{ratio} as amount_vs_7d_avg_ratio, 'amount_spike' as typology from feat where {test} >= 3.0"
    )
    sql["typology_amount_spike"] = base(ev) + spike.format(
        i=IDENTITY, p=PLACES, avg=r2("rolling_7d_avg"), ratio=r4("ratio"), test="ratio"
    )
    sql["typology_amount_spike_rounded"] = base(ev) + spike.format(
        i=IDENTITY, p=PLACES, avg=r2("rolling_7d_avg"), ratio=r4("ratio"), test=r4("ratio")
    )
    sql["typology_rapid_succession"] = (
        f"{base(ev)} select {IDENTITY}, {PLACES}, prev_timestamp, timestamp as \"current_timestamp\", "
        f"gap_s as seconds_since_last_txn, {r2('rolling_7d_amount')} as rolling_7d_amount, rolling_7d_count, "
        "'rapid_succession' as typology from feat where gap_s <= 300"
    )
    sql["typology_rapid_succession_elapsed"] = (
        sql["typology_rapid_succession"]
        .replace("gap_s as seconds_since_last_txn", "gap_e as seconds_since_last_txn")
        .replace("where gap_s <= 300", "where gap_e <= 300")
    )
    sql["risk_score_final"] = f"{score(ev)} select {SCORED_COLUMNS} from scored"
    sql["risk_score_final_orders"] = f"{score(od)} select {SCORED_COLUMNS} from scored"
    sql["risk_score_final_structuring"] = f"{score(st)} select {SCORED_COLUMNS} from scored"
    sql["risk_score_final_split"] = sql["risk_score_final"]
    sql["risk_score_final_sql"] = (
        f"{score(ev, 'gap_e', 'risky_3vl')} select {IDENTITY}, {PLACES}, timestamp, is_flagged_source, {ROUNDED}, "
        f"{FLAGS}, flag_count, risk_score, risk_tier from scored"
    )
    sql["int_risk_flagged"] = f"{score(ev, 'gap_e', 'risky_3vl')} select {FLAGGED_COLUMNS} from scored"

    # marts
    mart = (
        f"{score(ev, 'gap_e', 'risky_3vl')} select {FLAGGED_COLUMNS}, flag_count, risk_score, risk_tier"
        "{} from scored where risk_score >= 25"
    )
    sql["mart_aml_alert_queue"] = mart.format("")
    sql["mart_alert_queue_partitioned"] = mart.format(", cast(timestamp as date) as txn_date")
    sql["mart_customer_risk_profile"] = f"""{score(ev, 'gap_e', 'risky_3vl')}
select customer_id, count(*) as total_transactions, cast(sum(d) as double) as total_amount,
  {r2('cast(sum(d) as double) / count(*)')} as avg_amount,
  cast(sum(flag_count) as bigint) as flags_triggered, max(risk_score) as max_risk_score,
  max(timestamp) as latest_transaction_timestamp,
  case when max(risk_score) >= 75 then 'Critical' when max(risk_score) >= 50 then 'High'
       when max(risk_score) >= 25 then 'Medium' else 'Low' end as risk_tier
from scored group by customer_id"""

    # reports
    sql["alert_queue"] = f"{score(ev)} select {ALERT} from scored where risk_score >= 25"
    sql["count_by_currency"] = f'with txn as ({ev}) select currency, count(*) as "count" from txn group by currency'
    sql["count_by_channel"] = f'with txn as ({ev}) select channel, count(*) as "count" from txn group by channel'
    names = {
        "flag_structuring": "Structuring",
        "flag_high_velocity": "High Velocity",
        "flag_high_risk_country": "High-Risk Country",
        "flag_amount_spike": "Amount Spike",
        "flag_rapid_succession": "Rapid Succession",
    }
    sql["flag_totals"] = (
        f"{score(ev)} select "
        + ", ".join(f"count(*) filter (where {f}) as {f}" for f in names)
        + " from scored"
    )
    sql["flag_breakdown"] = f"{score(ev)} " + " union all ".join(
        f"select '{t}' as typology, count(*) filter (where {f}) as flagged from scored" for f, t in names.items()
    )
    sql["tier_distribution"] = f'{score(ev)} select risk_tier, count(*) as "count" from scored group by risk_tier'
    sql["tier_distribution_filled"] = f"""{score(ev)},
tiers as (select * from (values (1, 'HIGH'), (2, 'MEDIUM'), (3, 'LOW'), (4, 'NONE')) as t(position, risk_tier))
select position, t.risk_tier, count(s.transaction_id) as "count"
from tiers t left join scored s on s.risk_tier = t.risk_tier group by position, t.risk_tier"""
    profile = """select customer_id, count(transaction_id) as total_transactions,
  cast(sum(d) as double) as total_volume_eur,
  cast(sum(d) as double) / count(*) as avg_transaction_amount,
  max(amount) as max_transaction_amount,
  cast(sum(risk_score) as bigint) as cumulative_risk_score,
  max(risk_score) as peak_risk_score,
  count(*) filter (where flag_structuring) as structuring_flags,
  count(*) filter (where flag_high_velocity) as velocity_flags,
  count(*) filter (where flag_high_risk_country) as high_risk_country_flags,
  count(distinct beneficiary_country) as distinct_beneficiary_countries,
  count(distinct beneficiary_account) as distinct_beneficiary_accounts,
  case when max(risk_score) >= 50 then 'HIGH' when max(risk_score) >= 25 then 'MEDIUM'
       when max(risk_score) > 0 then 'LOW' else 'NONE' end as customer_risk_tier
from scored group by customer_id"""
    sql["customer_risk_profile"] = f"{score(ev)} {profile}"
    sql["customer_risk_profile_orders"] = f"{score(od)} {profile}"
    sql["top_customers"] = f"{score(ev)} {profile} order by cumulative_risk_score desc, customer_id limit 15"
    sql["alert_rate"] = (
        f"{score(ev)} select count(*) as total, count(*) filter (where risk_score >= 25) as alerts, "
        "case when count(*) > 0 then count(*) filter (where risk_score >= 25) / count(*) else 0 end as alert_rate "
        "from scored"
    )
    sql["rule_confusion"] = f"{score(ev)} {CONFUSION}"
    sql["rule_precision_recall"] = f"""{score(ev)}, c as ({CONFUSION}),
pr as (
  select *, coalesce(tp / nullif(tp + fp, 0), 0) as precision, coalesce(tp / nullif(tp + fn, 0), 0) as recall from c
)
select *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) as f1 from pr"""
    sql["classification_report"] = f"""{score(ev)}, c as ({CONFUSION}),
per as (
  select 'Low Risk' as class, tn as hit, fn as false_hit, fp as missed from c
  union all select 'High Risk', tp, fp, fn from c
),
pr as (
  select class, coalesce(hit / nullif(hit + false_hit, 0), 0) as precision,
    coalesce(hit / nullif(hit + missed, 0), 0) as recall, hit + missed as support
  from per
),
f as (select *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) as f1 from pr),
lo as (select * from f where class = 'Low Risk'),
hi as (select * from f where class = 'High Risk')
select class, precision, recall, f1, support from f
union all
select 'macro avg', (lo.precision + hi.precision) / 2, (lo.recall + hi.recall) / 2, (lo.f1 + hi.f1) / 2,
  lo.support + hi.support from lo, hi
union all
select 'weighted avg',
  (lo.precision * lo.support + hi.precision * hi.support) / (lo.support + hi.support),
  (lo.recall * lo.support + hi.recall * hi.support) / (lo.support + hi.support),
  (lo.f1 * lo.support + hi.f1 * hi.support) / (lo.support + hi.support),
  lo.support + hi.support from lo, hi"""
    sql["monthly_trend"] = f"""{score(od)}
select cast(extract(year from timestamp) as integer) as year, cast(extract(month from timestamp) as integer) as month,
  count(transaction_id) as total_transactions, cast(sum(d) as double) as total_volume_eur,
  count(*) filter (where risk_score >= 25) as alerts_raised,
  count(*) filter (where flag_structuring) as structuring_flags,
  {r2('count(*) filter (where risk_score >= 25) / count(*) * 100')} as alert_rate_pct
from scored group by 1, 2"""
    sql["monthly_trend_top"] = sql["monthly_trend"] + " order by 1, 2 limit 12"
    sql["daily_alerts"] = (
        f'{score(ev)} select date, risk_tier, count(*) as "count" from scored where risk_score >= 25 '
        "group by date, risk_tier"
    )
    sql["score_histogram"] = (
        f'{score(ev)} select risk_score, risk_tier, count(*) as "count" from scored where risk_score > 0 '
        "group by risk_score, risk_tier"
    )
    sql["overview_kpis"] = f"""{score(ev)}
select count(*) as total_transactions, count(*) filter (where risk_score >= 25) as alerts,
  count(*) filter (where risk_tier = 'HIGH') as high_risk, count(distinct customer_id) as unique_customers,
  count(*) filter (where risk_score >= 25) / count(*) as alert_rate,
  count(*) filter (where risk_tier = 'HIGH') / count(*) as high_rate
from scored"""
    sql["high_tier_top10"] = (
        f"{score(ev)} select transaction_id, customer_id, amount, risk_score, risk_tier, flag_structuring, "
        "flag_high_velocity, flag_high_risk_country from scored where risk_tier = 'HIGH' "
        "order by risk_score desc, amount desc, transaction_id limit 10"
    )
    sql["top_flagged"] = f"""{score(ev)}
select transaction_id, customer_id, strftime(timestamp, '%Y-%m-%d %H:%M') as timestamp,
  '€' || format('{{:,.2f}}', amount) as amount, channel, {PLACES}, risk_score, risk_tier, flag_count
from (select * from scored where risk_score >= 25 order by risk_score desc, amount desc, transaction_id limit 20)"""
    sql["top_alerts"] = (
        f"{score(ev)} select {ALERT} from scored where risk_score >= 25 "
        "order by risk_score desc, amount desc, transaction_id limit 20"
    )

    # quality
    nulls = ", ".join(f"count(*) filter (where {c} is null) as {c}" for c in GATE_COLUMNS)
    sql["dq_null_counts"] = f"with txn as ({every}) select {nulls} from txn"
    raw_events = "select event_id, ts, user_id, event_type, value from events"
    sql["dq_invalid_amounts"] = (
        f"with raw as ({raw_events}) select count(*) filter (where value * 50 <= 0) as invalid_amounts from raw"
    )
    sql["dq_duplicates"] = (
        "select count(*) - count(distinct user_id) - max(case when user_id is null then 1 else 0 end) as duplicates "
        "from events"
    )
    gate = ", ".join(f"count(*) filter (where {c} is null) as null_{c}" for c in GATE_COLUMNS)
    sql["dq_gate"] = f"""with txn as ({every}) select {gate},
  count(*) filter (where amount <= 0) as invalid_amounts,
  count(*) - count(distinct transaction_id) as duplicates from txn"""

    # data tests
    def no_nulls(model: str, relation: str, columns: tuple[str, ...]) -> list[str]:
        return [
            f"select 'not_null_{model}_{c}' as test_name, count(*) filter (where {c} is null) as violations from {relation}"
            for c in columns
        ]

    def uniques(model: str, relation: str, column: str) -> str:
        return (
            f"select 'unique_{model}_{column}' as test_name, count(*) as violations from "
            f"(select {column} from {relation} where {column} is not null group by {column} having count(*) > 1)"
        )

    def allowed(model: str, relation: str, column: str, values: str) -> str:
        return (
            f"select 'accepted_values_{model}_{column}' as test_name, count(*) as violations from "
            f"(select distinct {column} from {relation} where {column} not in ({values}))"
        )

    models = (
        score(ev, "gap_e", "risky_3vl")
        + f", everything as ({every}), queue as (select * from scored where risk_score >= 25), "
        + "profile as (select customer_id, max(risk_score) as max_risk_score, "
        + "case when max(risk_score) >= 75 then 'Critical' when max(risk_score) >= 50 then 'High' "
        + "when max(risk_score) >= 25 then 'Medium' else 'Low' end as risk_tier from scored group by customer_id) "
    )
    core = ("transaction_id", "customer_id", "amount")
    sql["test_not_null"] = models + " union all ".join(
        [
            *no_nulls("source", "everything", core),
            *no_nulls("staging", "everything", core),
            *no_nulls("alert_queue", "queue", ("transaction_id", "risk_score")),
            *no_nulls("customer_profile", "profile", ("customer_id", "max_risk_score")),
        ]
    )
    sql["test_unique"] = models + " union all ".join(
        [
            uniques("source", "everything", "transaction_id"),
            uniques("staging", "everything", "transaction_id"),
            uniques("customer_profile", "profile", "customer_id"),
            uniques("raw_customer", "everything", "customer_id"),
        ]
    )
    sql["test_accepted_values"] = models + " union all ".join(
        [
            allowed("alert_queue", "queue", "risk_tier", "'HIGH', 'MEDIUM'"),
            allowed("customer_profile", "profile", "risk_tier", "'Critical', 'High', 'Medium', 'Low'"),
            allowed("raw_channel", "everything", "channel", "'click', 'view'"),
        ]
    )
    sql["test_alert_min_score"] = (
        models + "select 'alert_queue_min_score' as test_name, "
        "count(*) filter (where risk_score < 25) as violations from queue"
    )

    parts = [sql[f"test_{kind}"].removeprefix(models) for kind in ("not_null", "unique", "accepted_values", "alert_min_score")]
    sql["test_all_models"] = models + " union all ".join(parts)

    sql["scan_nested_files"] = f"""with txn as ({ev})
select transaction_id, amount, cast(dense_rank() over (order by currency, channel) as integer) as file_place,
  row_number() over (partition by currency, channel order by transaction_id) - 1 as row_place
from txn"""
    # The width is the least 1, 2 or 5 times a power of ten that needs at most 40 bins.
    sql["amount_histogram"] = f"""{score(ev)},
ends as (select min(rolling_7d_amount) as lo, max(rolling_7d_amount) as hi from scored),
steps as (select lead * pow(10, power) as step from (values (1), (2), (5)) l(lead), range(-2, 12) r(power)),
chosen as (
  select min(step) as step from steps, ends where floor(hi / step) - floor(lo / step) < 40
),
binned as (select floor(rolling_7d_amount / step) as place, step, risk_tier from scored, chosen)
select place * step as low, (place + 1) * step as high, risk_tier, count(*) as "count"
from binned group by place, step, risk_tier"""

    # rank metrics
    sql["auc_gini"] = f"""{score(ev)}{RANKED},
a as (select sum(cast(neg as double) * (2 * above_p + pos)) / (2.0 * max(p) * max(n)) as auc from ranked)
select auc, 2 * auc - 1 as gini from a"""
    sql["ks_statistic"] = f"""{score(ev)}{RANKED}
select max(abs((above_p + pos) / p - (above_n + neg) / n)) as ks from ranked"""
    sql["roc_curve"] = f"""{score(ev)}{RANKED}
select score as threshold, (above_n + neg) / n as fpr, (above_p + pos) / p as tpr from ranked"""
    sql["ml_features"] = f"""{score(ev)}
select transaction_id, rolling_7d_amount, cast(rolling_7d_count as double) as rolling_7d_count, rolling_7d_avg,
  amount_vs_7d_avg_ratio, cast(seconds_since_last_txn as double) as seconds_since_last_txn,
  cast(is_weekend as integer)::double as is_weekend, cast(is_offhours as integer)::double as is_offhours,
  cast(involves_high_risk_country as integer)::double as involves_high_risk_country,
  cumulative_amount, cast(cumulative_count as double) as cumulative_count,
  cast(risk_score >= 25 as integer) as label from scored"""
    sql["ml_label_balance"] = (
        f'{score(ev)} select cast(risk_score >= 25 as integer) as label, count(*) as "count" from scored group by 1'
    )

    split = f"""{score(ev)},
placed as (
  select transaction_id, cast(risk_score >= 25 as integer) as label,
    row_number() over (partition by risk_score >= 25 order by md5(transaction_id || '/split42')) as place,
    count(*) over (partition by risk_score >= 25) as n
  from scored
),
parted as (
  select *, floor(0.2 * n + 0.5) as tested, case when place <= floor(0.2 * n + 0.5) then 'test' else 'train' end as part
  from placed
)"""
    sql["ml_split_counts"] = f"""{split}
select part, label, count(*) as "count" from parted group by 1, 2"""
    # Fold j begins behind rank tested + floor(j (n - tested) / 5).
    sql["ml_fold_counts"] = f"""{split},
folds as (
  select label, (select count(*) from range(1, 5) r(j) where place > tested + floor(j * (n - tested) / 5)) as fold
  from parted where part = 'train'
)
select cast(fold as integer) as fold, label, count(*) as "count" from folds group by 1, 2"""

    sql["ml_scored_rows"] = f"""{split}
select transaction_id, label, true as in_range, true as class_follows from parted where part = 'test'"""
    sql["ml_shap_checks"] = f"""{split}
select transaction_id, true as adds_up, 10 as features from parted where part = 'test'"""
    checks = {
        "ml_metrics_checks": "auc_is_high gini_from_auc f1_from_precision_and_recall cells_add_up",
        "ml_reload_checks": "reloaded_model_is_the_same",
        "ml_importance_checks": "importance_of_every_feature gains_add_up_to_one",
        "ml_explanation_checks": "three_rows_explained_by_every_feature explained_rows_are_the_riskiest",
        "ml_cv_checks": "cross_validated_auc_is_high cross_validated_gini_from_auc",
        "": "attribution_of_every_feature report_covers_test_rows curve_ends_at_one histogram_covers_test_rows",
    }
    for key, names in [*checks.items(), ("ml_checks", " ".join(checks.values()))]:
        if key:
            rows = [f"select '{name}' as check_name, true as ok" for name in names.split()]
            sql[key] = " union all ".join(rows)

    # stream and messages
    sql["decode_events_json"] = (
        "select event_id, cast(json_extract(props, '$.k') as bigint) as k from events "
        "where json_extract(props, '$.k') is not null"
    )
    sql["encode_events_json"] = f"with txn as ({ev}) select customer_id as key, {RAW} from txn"
    sql["stream_source_json"] = f"with txn as ({ev}) select {RAW} from txn"
    sql["stream_scored_append"] = f"{score(ev, 'gap_s', 'risky_3vl')} select {SCORED_COLUMNS} from scored"
    sql["stream_scored_history"] = sql["stream_scored_append"]
    sql["stream_batch_summaries"] = f"""{score(ev, 'gap_s', 'risky_3vl')}
select case when day("timestamp") <= 10 then 0::bigint when day("timestamp") <= 20 then 1 else 2 end as batch_id,
  count(*) as processed, count(*) filter (where risk_score >= 25) as alerts
from scored group by 1"""
    sql["stream_rejects"] = f"""with txn as ({ev}),
kinds as (
  select case cast(substr(transaction_id, 4) as bigint) % 50
    when 1 then 'no readable id' when 2 then 'no customer' when 3 then 'unreadable time' end as reject_reason
  from txn
)
select reject_reason, count(*) as n from kinds where reject_reason is not null group by reject_reason"""
    sql["run_log"] = (
        score(ev) + " select 'run_events' as run_id, count(*) as record_count, "
        "count(*) filter (where risk_score >= 25) as alert_count, 'completed' as status, "
        "'{\"source\": \"events\"}' as details, 86400::bigint as kept_seconds from scored"
    )
    sql.update(_generated())
    return sql


def _draw(name: str) -> str:
    return f"(('0x' || substr(md5(id::varchar || '/{name}/42'), 1, 13))::bigint / 4503599627370496.0)"


def _pick(pool: tuple[str, ...], name: str) -> str:
    values = ", ".join(f"'{v}'" for v in pool)
    return f"([{values}])[1 + floor({_draw(name)} * {len(pool)})::int]"


def _pick_weighted(weights: dict[str, float], name: str) -> str:
    edge, text = 0.0, "case"
    *head, last = weights
    for value in head:
        edge += weights[value]
        text += f" when {_draw(name)} < {edge!r} then '{value}'"
    return f"{text} else '{last}' end"


def _code(prefix: str, number: str, width: int) -> str:
    return f"'{prefix}' || lpad(({number})::varchar, greatest(length(({number})::varchar), {width})::int, '0')"


def _below(n: int, name: str) -> str:
    return f"floor({_draw(name)} * {n})::bigint"


def _generated() -> dict[str, str]:
    """Synthetic rows from the same digests; the pools are the generator's parameters."""
    suspicious = f"{_draw('suspicious')} < {G.SUSPICIOUS_RATE}"
    low, high = G.NEAR_LIMIT
    usual = f"greatest(0.01, {r2(f'-{G.MEAN_AMOUNT} * ln(1 - {_draw("amount")})')})"
    near = r2(f"{low} + ({high} - {low}) * {_draw('amount')}")
    plain = f"""select {_code('TXN', 'id', 8)} as transaction_id,
  {_code('CUST', _below(G.CUSTOMERS, 'customer'), 5)} as customer_id,
  {_code('ACC', _below(G.ACCOUNTS, 'originator'), 6)} as originator_account,
  {_code('ACC', _below(G.ACCOUNTS, 'beneficiary'), 6)} as beneficiary_account,
  case when {suspicious} then {near} else {usual} end as amount,
  {_pick(G.CURRENCIES, 'currency')} as currency, {_pick(G.CHANNELS, 'channel')} as channel,
  {_pick(G.ALL_COUNTRIES, 'from')} as originator_country,
  case when {suspicious} then {_pick(G.ALL_COUNTRIES, 'to')} else {_pick(G.LOW_RISK, 'to')} end as beneficiary_country,
  {{time}} as timestamp, {suspicious} as is_flagged_source
from (select event_id as id, ts from events)"""
    start = f"timestamp '{G.YEAR_START}'"
    # The log-normal variant with the open window: rows of the last seven days up to the row itself.
    normal = f"sqrt(-2 * ln(1 - {_draw('amount/r')})) * cos(2 * pi() * {_draw('amount/a')})"
    floor_, ceiling = G.LOG_BOUNDS
    near_low, near_high = G.LOG_NEAR_LIMIT
    spread = f"least(greatest(exp({G.LOG_MEAN} + {G.LOG_DEVIATION} * {normal}), {floor_}), {ceiling})"
    capped = f"{near_low} + ({near_high} - {near_low}) * {_draw('near amount')}"
    lognormal = f"""select {_code('TXN_', 'id', 6)} as transaction_id,
  {_code('CUST_', _below(G.LOG_CUSTOMERS, 'customer'), 4)} as customer_id,
  {start} + to_microseconds({_below(G.LOG_DAYS * 86_400 * 1_000_000, 'time')}) as timestamp,
  {r2(f"case when {_draw('near')} < {G.LOG_NEAR_LIMIT_RATE} then {capped} else {spread} end")} as amount,
  'EUR' as currency, {_pick_weighted(G.WEIGHTED_CHANNELS, 'channel')} as channel,
  {_pick_weighted(G.WEIGHTED_COUNTRIES, 'from')} as originator_country,
  {_pick_weighted(G.WEIGHTED_COUNTRIES, 'to')} as beneficiary_country
from (select event_id as id from events)"""
    in_window = "range between unbounded preceding and 604800000000 preceding"
    closed = """    sum(d) over w7 as roll_d,
    count(*) over w7 as rolling_7d_count,
"""
    opened = f"""    sum(d) over wc - coalesce(sum(d) over (partition by customer_id order by us {in_window}), 0) as roll_d,
    count(*) over wc - count(*) over (partition by customer_id order by us {in_window}) as rolling_7d_count,
"""
    whole = score(lognormal, "gap_e").replace(closed, opened)
    whole = whole.replace("select *, epoch_us(timestamp) // 1000000 as s,", "select *, epoch_us(timestamp) as us, epoch_us(timestamp) // 1000000 as s,")
    return {
        "gen_transactions_lognormal": f"""{whole}
select transaction_id, customer_id, timestamp, amount, currency, channel, originator_country, beneficiary_country,
  {CALENDAR}, involves_high_risk_country, {HISTORY}, {FLAGS}, flag_count, risk_score, risk_tier from scored""",
        "gen_transactions": plain.format(time=f"{start} + to_seconds({_below(G.YEAR_DAYS * 86_400, 'time')})"),
        "gen_transactions_recent": plain.format(time=f"ts - to_seconds({_below(31, 'time')})"),
    }


ORACLES = _oracles()
