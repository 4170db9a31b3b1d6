"""The same results in plain SQL, for a second engine to check against."""

from __future__ import annotations

from rowan.functions.text import NA_TOKENS
from rowan.operators.metrics import THRESHOLDS

_TOKENS = ", ".join("'" + t + "'" for t in NA_TOKENS)

_LINES = f"""
raw_lines as (
  select l_orderkey, l_linenumber, cast(year(l_shipdate) as varchar) as yr,
    case when l_orderkey % 97 = 0 or (year(l_shipdate) = 1999 and l_orderkey % 23 = 0) then ' '
         when l_orderkey % 89 = 0 then 'n/a' when l_orderkey % 83 = 0 then '12x'
         when l_orderkey % 79 = 0 then '1d'
         else cast(cast(l_extendedprice as decimal(14,2)) as varchar) end as raw_price,
    case when l_partkey % 101 = 0 then 'Z'
         when l_partkey % 103 = 0 or (year(l_shipdate) = 1998 and l_partkey % 29 = 0) then null
         else l_returnflag end as flag,
    case when year(l_shipdate) = 1999 and l_orderkey % 5 = 0 then 'O' else l_linestatus end as status
  from lineitem),
typed as (
  select l_orderkey, l_linenumber, yr,
    case when raw_price in ({_TOKENS}) then null else raw_price end as raw_price,
    case when flag in ({_TOKENS}) then null else flag end as flag, status
  from raw_lines),
lines as (
  select *,
    case when regexp_full_match(trim(raw_price), '[+-]?[0-9]+([.][0-9]*)?')
         then cast(trim(raw_price) as double) end as price,
    coalesce(trim(raw_price) = '', false) as blank
  from typed),
marked as (
  select *, price is null and raw_price is not null and not blank as invalid,
    flag is not null and flag not in ('A', 'N', 'R') as odd_flag,
    status is not null and status not in ('F', 'O') as odd_status
  from lines)"""

_CUSTOMERS = """
history as (
  select o_custkey,
    count(*) filter (where o_orderdate < timestamp '2000-08-01') as earlier,
    count(*) filter (where o_orderdate >= timestamp '2000-08-01') as later,
    cast(sum(cast(o_totalprice as decimal(14,2)))
         filter (where o_orderdate < timestamp '2000-08-01') as double) as spend,
    max(cast(o_orderdate as date)) filter (where o_orderdate < timestamp '2000-08-01') as last_order
  from orders group by 1),
customers as (
  select c_custkey, c_mktsegment as segment, cast(c_nationkey as varchar) as nation,
    c_acctbal as balance, cast(coalesce(earlier, 0) as double) as n_orders, spend,
    cast(date_diff('day', last_order, date '2000-08-01') as double) as days_since,
    case when coalesce(later, 0) > 0 then 'No' else 'Yes' end as lapsed,
    case when coalesce(later, 0) > 0 then 0.0 else 1.0 end::double as label
  from customer left join history on c_custkey = o_custkey)"""

def _scaled(fitted: str = "true") -> str:
    """Features of all customers, fitted on those of a condition."""
    return f"""{_CUSTOMERS},
fitted as (select * from customers where {fitted}),
medians as (
  select median(balance) as b, median(n_orders) as o, median(spend) as s, median(days_since) as d
  from fitted),
imputed as (
  select c_custkey, segment, nation, coalesce(balance, b) as balance,
    coalesce(n_orders, o) as n_orders, coalesce(spend, s) as spend,
    coalesce(days_since, d) as days_since
  from customers, medians),
moments as (
  select avg(balance) as bm, stddev_pop(balance) as bs, avg(n_orders) as om,
    stddev_pop(n_orders) as os, avg(spend) as sm, stddev_pop(spend) as ss,
    avg(days_since) as dm, stddev_pop(days_since) as ds
  from imputed where {fitted}),
scaled as (
  select c_custkey, segment, (balance - bm) / bs as balance, (n_orders - om) / os as n_orders,
    (spend - sm) / ss as spend, (days_since - dm) / ds as days_since
  from imputed, moments),
segments as (
  select segment, row_number() over (order by segment) as place
  from (select distinct segment from fitted)),
matrix as (
  select c_custkey, 0 as slot, balance as value from scaled
  union all select c_custkey, 1, n_orders from scaled
  union all select c_custkey, 2, spend from scaled
  union all select c_custkey, 3, days_since from scaled
  union all
  select c_custkey, cast(3 + place as int),
    case when scaled.segment = segments.segment then 1.0 else 0.0 end
  from scaled, segments)"""


_SCALED = _scaled()

_SPLIT = (
    _CUSTOMERS
    + """,
hashed as (select *, md5('42:' || c_custkey) as h from customers),
placed as (
  select *, row_number() over (partition by label order by h, c_custkey) as r,
    count(*) over (partition by label) as n_class, count(*) over () as n
  from hashed),
shares as (
  select label, max(n_class) as n_class, max(n) as n,
    (max(n) - ceil(0.2 * max(n))) * max(n_class) / max(n) as share
  from placed group by label),
ordered as (
  select *, floor(share) as base, sum(floor(share)) over () as taken,
    row_number() over (order by floor(share) - share, label) as place
  from shares),
kept as (
  select label, n_class - (base + case when place <= (n - ceil(0.2 * n)) - taken then 1 else 0 end)
    as held_out
  from ordered),
split as (
  select c_custkey, placed.label, case when r <= held_out then 'test' else 'train' end as split
  from placed join kept on placed.label = kept.label)"""
)

_INNER = (
    _SPLIT
    + """,
train as (select *, md5('42:inner:' || c_custkey) as h from split where split = 'train'),
train_placed as (
  select *, row_number() over (partition by label order by h, c_custkey) as r,
    count(*) over (partition by label) as n_class, count(*) over () as n
  from train),
train_shares as (
  select label, max(n_class) as n_class, max(n) as n,
    (max(n) - ceil(0.2 * max(n))) * max(n_class) / max(n) as share
  from train_placed group by label),
train_ordered as (
  select *, floor(share) as base, sum(floor(share)) over () as taken,
    row_number() over (order by floor(share) - share, label) as place
  from train_shares),
train_kept as (
  select label, n_class - (base + case when place <= (n - ceil(0.2 * n)) - taken then 1 else 0 end)
    as held_out
  from train_ordered)"""
)

_FOLDS = (
    _CUSTOMERS
    + """,
placed as (
  select c_custkey, label,
    row_number() over (partition by label order by md5('42:fold:' || c_custkey), c_custkey) as r
  from customers),
sizes as (select label, count(*) as n from customers group by label),
starts as (select label, n, coalesce(sum(n) over (order by label
    rows between unbounded preceding and 1 preceding), 0) as s from sizes),
dealt as (
  select label, f,
    cast(floor((s + n - 1 - f) / 5.0) - floor((s - 1 - f) / 5.0) as bigint) as n_fold
  from starts, (select unnest(range(5)) as f)),
ends as (
  select label, f, sum(n_fold) over (partition by label order by f) as last_rank,
    sum(n_fold) over (partition by label order by f) - n_fold as before
  from dealt)"""
)


# Logistic regression: the regularised, class-weighted objective minimised by accelerated gradient steps.
_LOGISTIC_STEPS = 1500
_LOGISTIC = rf"""
measured as (
  select doc_id, lang, source, length(text)::double as n_chars,
    list_filter(string_split_regex(text, '[ \t\n\r]+'), lambda w: w <> '') as ws,
    length(regexp_replace(text, '[A-Za-z0-9 \t\n\r]+', '', 'g'))::double as bare
  from documents),
described as materialized (
  select doc_id, lang, source, n_chars, len(ws)::double as words,
    len(list_distinct(ws)) / len(ws)::double as unique_share, bare / n_chars as punctuation_share
  from measured),
labelled as (
  select described.*, quality::double as label, md5('42:' || doc_id) as h
  from described join labels using (doc_id)),
placed as (
  select *, row_number() over (partition by label order by h, doc_id) as r,
    count(*) over (partition by label) as n_class, count(*) over () as n
  from labelled),
shares as (
  select label, max(n_class) as n_class, max(n) as n,
    (max(n) - ceil(0.2 * max(n))) * max(n_class) / max(n) as share
  from placed group by label),
ordered as (
  select *, floor(share) as base, sum(floor(share)) over () as taken,
    row_number() over (order by floor(share) - share, label) as place
  from shares),
kept as (
  select label, n_class - (base + case when place <= (n - ceil(0.2 * n)) - taken then 1 else 0 end)
    as held_out
  from ordered),
parted as materialized (
  select placed.*, r <= held_out as test from placed join kept on placed.label = kept.label),
train_rows as materialized (
  select doc_id, label, count(*) over () as n,
    count(*) over () / (2.0 * count(*) over (partition by label)) as weight
  from parted where not test),
cells as (
  unpivot (
    select doc_id, doc_id in (select doc_id from train_rows) as fitted, n_chars, words, unique_share,
      punctuation_share from described)
  on n_chars, words, unique_share, punctuation_share into name slot value v),
middles as (select slot, median(v) as m from cells where fitted group by slot),
imputed as (
  select doc_id, fitted, cells.slot, coalesce(v, m) as v from cells join middles on cells.slot = middles.slot),
moments as (
  select slot, avg(v) as m, stddev_pop(v) as s from imputed where fitted group by slot),
seen as (
  select distinct 'lang ' || lang as slot from parted where not test
  union all select distinct 'source ' || source from parted where not test),
x as materialized (
  select doc_id, imputed.slot, (v - m) / s as v from imputed join moments on imputed.slot = moments.slot
  union all select doc_id, slot, 1.0 from described join seen on slot = 'lang ' || lang
  union all select doc_id, slot, 1.0 from described join seen on slot = 'source ' || source
  union all select doc_id, 'intercept', 1.0 from described),
train_x as materialized (
  select x.*, label, weight, n from x join train_rows on x.doc_id = train_rows.doc_id),
speed as (
  select 1 / (0.25 * sum(weight * v * v) / max(n) + 1.0 / max(n)) as step, 1.0 / max(n) as decay, max(n) as n
  from train_x),
search as (
  select 0 as k, slot, 0.0::double as w, 0.0::double as ahead from (select distinct slot from train_x)
  union all
  select k + 1, search.slot, ahead - step * (g + case when search.slot = 'intercept' then 0 else decay * ahead end),
    (ahead - step * (g + case when search.slot = 'intercept' then 0 else decay * ahead end)) * (1 + k / (k + 3.0))
      - w * k / (k + 3.0)
  from search join (
    select slot, sum(weight * (1 / (1 + exp(-z)) - label) * v) / max(n) as g
    from train_x join (
      select doc_id as id, sum(ahead * v) as z from search join train_x on search.slot = train_x.slot group by 1)
      on doc_id = id
    group by slot) as gradient on search.slot = gradient.slot, speed
  where k < {_LOGISTIC_STEPS}),
all_scores as materialized (
  select doc_id, 1 / (1 + exp(-sum(w * v))) as probability
  from x join search on search.slot = x.slot where k = {_LOGISTIC_STEPS} group by doc_id),
scored as (
  select 'logistic_regression' as model, label, probability,
    case when probability > 0.5 then 1 else 0 end as prediction
  from all_scores join parted using (doc_id) where test)"""


def _scored(variants: int = 1) -> str:
    scorers = [("a", 7919, 250), ("b", 6101, 500), ("c", 4603, 500)]
    rows = ", ".join(
        f"('{name}', {t}, {step + 2 * t}, {lift})"
        for name, step, lift in scorers
        for t in range(variants)
    )
    return f"""
base as (
  select model, trial, o_orderkey, cast(o_orderkey % 5 as int) as fold,
    case when o_orderstatus = 'F' then 1 else 0 end as label,
    cast(o_orderkey * step % 1000 + lift * case when o_orderstatus = 'F' then 1 else 0 end as double)
      / (1000.0 + lift)::double as probability
  from orders, (values {rows}) as scorer(model, trial, step, lift)),
scored as (
  select *, case when probability >= 0.5 then 1 else 0 end as prediction from base)"""


def _counts(by: str, source: str = "scored", prediction: str = "prediction") -> str:
    return f"""
  select {by},
    count(*) filter (where label = 1 and {prediction} = 1) as tp,
    count(*) filter (where label = 0 and {prediction} = 1) as fp,
    count(*) filter (where label = 1 and {prediction} = 0) as fn,
    count(*) filter (where label = 0 and {prediction} = 0) as tn
  from {source} group by all"""


_RATES = {
    "accuracy": "(tp + tn)::double / (tp + fp + fn + tn)",
    "precision": "case when tp + fp = 0 then 0 else tp::double / (tp + fp) end",
    "recall": "case when tp + fn = 0 then 0 else tp::double / (tp + fn) end",
    "f1": "case when tp = 0 then 0 else 2 * tp::double / (2 * tp + fp + fn) end",
}


def _rates(digits: int | None = 6, names: tuple[str, ...] = tuple(_RATES)) -> str:
    return ", ".join(
        f"round({_RATES[n]}, {digits}) as {n}" if digits else f"{_RATES[n]} as {n}" for n in names
    )


def _auc(by: str, source: str = "scored") -> str:
    """Mann-Whitney over distinct scores."""
    return f"""
  select {by}, sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg))::double as roc_auc
  from (
    select *, coalesce(sum(neg) over (partition by {by} order by probability
      rows between unbounded preceding and 1 preceding), 0) as below
    from (
      select {by}, probability, count(*) filter (where label = 1) as pos,
        count(*) filter (where label = 0) as neg
      from {source} group by all))
  group by all"""


_GRID = ", ".join(f"({i}, {t}::double)" for i, t in enumerate(THRESHOLDS))
_SWEEP = (
    _scored()
    + f""",
swept as (
  select model, pos, threshold, label,
    case when probability >= threshold then 1 else 0 end as passed
  from scored, (values {_GRID}) as grid(pos, threshold)),
sweep_counts as ({_counts("model, pos, threshold", "swept", "passed")}),
sweep as (select model, pos, threshold, tp, fp, fn, tn, {_rates(None)} from sweep_counts)"""
)

def _fold_metrics(fold: str = "fold") -> str:
    return f"""{_scored()},
folded as (select * replace ({fold} as fold) from scored),
counted as ({_counts("model, fold", "folded")}),
area as ({_auc("model, fold", "folded")}),
measured as (
  select counted.model, counted.fold, {_rates(None)}, roc_auc
  from counted join area
    on counted.model = area.model and counted.fold is not distinct from area.fold)"""


_FOLD_METRICS = _fold_metrics()


def _column_facts(by: str = "") -> str:
    """All per-column facts of the line table as rows."""
    columns = ("l_orderkey", "l_linenumber", "raw_price", "flag", "status")
    prefix, group = (f"{by} as run_id, ", f" group by {by}") if by else ("", "")

    def fact(section: str, column: str | None, metric: str, value: str) -> str:
        shown = f"'{column}'" if column else "cast(null as varchar)"
        return (
            f"select {prefix}'{section}' as section, {shown} as \"column\", '{metric}' as metric, "
            f"cast({value} as double) as value from marked{group}"
        )

    facts = [
        fact("table", None, "row_count", "count(*)"),
        fact("table", None, "column_count", "max(5)"),
    ]
    for c in columns:
        facts.append(fact("missing", c, "count", f"count(*) - count({c})"))
        facts.append(fact("missing", c, "rate", f"(count(*) - count({c})) / count(*)::double"))
    facts.append(fact("numeric", "raw_price", "invalid", "count(*) filter (where invalid)"))
    facts.append(fact("numeric", "raw_price", "missing_after_coercion", "count(*) - count(price)"))
    facts.append(fact("category", "flag", "unexpected", "count(*) filter (where odd_flag)"))
    facts.append(fact("category", "status", "unexpected", "count(*) filter (where odd_status)"))
    return " union all ".join(facts)


_PROFILE = _LINES + f", facts as ({_column_facts()})"
_YEARLY = _LINES + f""",
reports as (
  {_column_facts("yr")}
  union all
  select yr, 'table', null, 'duplicate_keys',
    cast(count(*) - count(distinct coalesce(l_orderkey, -1)) as double)
  from marked group by yr
  union all
  select yr, 'target', status, 'count', cast(count(*) as double) from marked group by yr, status),
pairs as (
  select * from (
    select run_id, lag(run_id) over (order by run_id) as previous_run_id
    from (select distinct run_id from reports))
  where previous_run_id is not null),
row_counts as (
  select run_id, value from reports where section = 'table' and metric = 'row_count'),
row_drift as (
  select p.run_id, p.previous_run_id, 'row_count' as "check", c.value as "current",
    v.value as previous, c.value - v.value as delta,
    case when v.value > 0 then round((c.value - v.value) / v.value, 4) else 0 end as pct_change,
    abs(case when v.value > 0 then round((c.value - v.value) / v.value, 4) else 0 end) > 0.1
      as flagged
  from pairs p join row_counts c on c.run_id = p.run_id
    join row_counts v on v.run_id = p.previous_run_id),
target_rates as (
  select run_id, sum(case when "column" = 'F' then value else 0 end) / sum(value) as rate
  from reports where section = 'target' group by run_id having sum(value) > 0),
target_drift as (
  select p.run_id, p.previous_run_id, 'target_distribution' as "check",
    round(c.rate, 4) as "current", round(v.rate, 4) as previous,
    round(c.rate - v.rate, 4) as delta, abs(c.rate - v.rate) > 0.05 as flagged
  from pairs p join target_rates c on c.run_id = p.run_id
    join target_rates v on v.run_id = p.previous_run_id),
missing_rates as (
  select run_id, "column", round(value, 4) as rate
  from reports where section = 'missing' and metric = 'rate'),
missing_drift as (
  select p.run_id, p.previous_run_id, 'missing_rate' as "check", c."column",
    c.rate as "current", coalesce(v.rate, 0) as previous,
    round(c.rate - coalesce(v.rate, 0), 4) as delta, true as flagged
  from pairs p join missing_rates c on c.run_id = p.run_id
    left join missing_rates v on v.run_id = p.previous_run_id and v."column" = c."column"
  where abs(c.rate - coalesce(v.rate, 0)) > 0.01),
drift as (
  select run_id, previous_run_id, "check", cast(null as varchar) as "column", "current", previous,
    delta, pct_change, flagged from row_drift
  union all
  select run_id, previous_run_id, "check", null, "current", previous, delta, null, flagged
  from target_drift
  union all
  select run_id, previous_run_id, "check", "column", "current", previous, delta, null, flagged
  from missing_drift)"""

ORACLES: dict[str, str] = {
    "na_normalise": f"with {_LINES} select l_orderkey, l_linenumber, raw_price, flag from lines",
    "coerce_numeric": f"""with {_LINES}
select l_orderkey, l_linenumber, price, cast(blank as int) as blank, cast(invalid as int) as invalid
from marked""",
    "encode_label": f"""with {_LINES}
select l_orderkey, l_linenumber,
  cast(case status when 'F' then 1.0 when 'O' then 0.0 end as double) as label
from raw_lines""",
    "gate_violations": f"""with {_LINES}, gated as (
  select * replace (
    case when l_orderkey % 71 <> 0 then status end as status,
    case when l_orderkey % 61 <> 0 then l_orderkey end as l_orderkey)
  from marked),
found as (
  select 2 as step, 0 as position, 'unique_key' as "check", 'l_orderkey' as "column",
    count(*) - count(distinct coalesce(l_orderkey, -1)) as n from gated
  union all select 3, 0, 'target_present', 'status', count(*) - count(status) from gated
  union all select 4, 0, 'clean_number', 'raw_price', count(*) filter (where invalid) from marked
  union all select 5, 0, 'allowed_category', 'flag', count(*) filter (where odd_flag) from marked
  union all
  select 5, 1, 'allowed_category', 'status', count(*) filter (where odd_status) from marked)
select * from found where n > 0""",
    "duplicate_keys": """
select 'l_orderkey' as key, count(*) - count(distinct l_orderkey) as duplicates from lineitem
union all select 'l_partkey', count(*) - count(distinct l_partkey) from lineitem
union all select 'o_orderkey', count(*) - count(distinct o_orderkey) from orders
union all
select 'some_suppkey', count(*) - count(distinct case when l_suppkey % 3 <> 0 then l_suppkey else -1 end)
from lineitem""",
    "table_profile": f"with {_PROFILE} select metric, value from facts where section = 'table'",
    "missing_profile": f"""with {_PROFILE}
select "column", metric, value from facts where section = 'missing'""",
    "coercion_report": f"""with {_PROFILE}
select "column", metric, value from facts where section = 'numeric'""",
    "category_report": f"""with {_LINES}
select 'flag' as "column", flag as value, count(*) as n from marked where odd_flag group by flag
union all
select 'status', status, count(*) from marked where odd_status group by status""",
    "observed_values": f"""with {_LINES}
select 'flag' as "column", flag as value, count(*) as n from marked
where flag is not null group by flag
union all
select 'status', status, count(*) from marked where status is not null group by status""",
    "target_distribution": f"with {_LINES} select flag as value, count(*) as n from lines group by flag",
    "quality_report": f"""with {_YEARLY}
select run_id, section, "column", metric, round(value, 6) as value from reports""",
    "run_latest": f"""with {_YEARLY}
select run_id, "column", metric, round(value, 6) as value from reports
where section = 'missing' and run_id = (select max(run_id) from reports)""",
    "run_pairs": f"with {_YEARLY} select run_id, previous_run_id from pairs",
    "drift_rows": f"with {_YEARLY} select * from row_drift",
    "drift_target": f"with {_YEARLY} select * from target_drift",
    "drift_missing": f"with {_YEARLY} select * from missing_drift",
    "drift_report": f"with {_YEARLY} select * from drift",
    "drift_verdict": f"""with {_YEARLY}
select run_id, bool_or(flagged) as has_drift from drift group by run_id""",
    "class_weights": f"""with {_CUSTOMERS}
select label, count(*) as n,
  round((select count(*) from customers)
    / ((select count(distinct label) from customers) * count(*))::double, 6) as weight
from customers group by label""",
    "positive_weight": f"""with {_CUSTOMERS}
select round(coalesce(sum(1 - label) / nullif(sum(label), 0), 1.0), 6) as pos_weight
from customers""",
    "stratified_split": f"with {_SPLIT} select c_custkey, label, split from split",
    "split_summary": f"""with {_SPLIT}
select split, count(*) as n, round(avg(label), 6) as positive_rate from split group by split""",
    "inner_split": f"""with {_INNER}
select c_custkey, case when r <= held_out then 1 else 0 end as validation
from train_placed join train_kept on train_placed.label = train_kept.label""",
    "stratified_folds": f"""with {_FOLDS}
select c_custkey, placed.label, cast(f as int) as fold
from placed join ends on placed.label = ends.label and r > before and r <= last_rank""",
    "fold_weights": f"""with {_FOLDS},
fitting as (
  select cast(f as int) as fold, dealt.label, cast(n - n_fold as bigint) as n
  from dealt join sizes on dealt.label = sizes.label)
select fold, label, n,
  round(sum(n) over (partition by fold) / (count(*) over (partition by fold) * n)::double, 6) as weight
from fitting""",
    "impute_median": f"""with {_SCALED}
select c_custkey, balance, n_orders, spend, days_since from imputed""",
    "impute_median_text": f"""with {_LINES}
select l_orderkey, l_linenumber, coalesce(price, (select median(price) from lines)) as price
from lines""",
    "impute_mode": f"""with {_LINES}, ranked as (
  select flag, row_number() over (order by count(*) desc, flag) as place
  from lines where flag is not null group by flag)
select l_orderkey, l_linenumber,
  coalesce(flag, (select flag from ranked where place = 1)) as flag
from lines""",
    "column_modes": f"""with {_CUSTOMERS}, cells as (
  select 'segment' as "column", segment as value from customers
  union all select 'nation', nation from customers
  union all select 'lapsed', lapsed from customers),
ranked as (
  select "column", value,
    row_number() over (partition by "column" order by count(*) desc, value) as place
  from cells where value is not null group by "column", value)
select "column", value as mode from ranked where place = 1""",
    "scale": f"""with {_SCALED}
select c_custkey, round(balance, 6) as balance, round(n_orders, 6) as n_orders,
  round(spend, 6) as spend, round(days_since, 6) as days_since
from scaled""",
    "onehot": f"""with {_CUSTOMERS}, seen as (
  select distinct 0 as block, segment as value from customers
  union all select distinct 1, nation from customers),
slots as (
  select block, value, cast(row_number() over (order by block, value) - 1 as int) as slot from seen)
select c_custkey, slot, 1.0::double as value
from customers join slots on block = 0 and value = segment
union all
select c_custkey, slot, 1.0::double from customers join slots on block = 1 and value = nation""",
    "feature_matrix": f"""with {_SCALED}
select c_custkey, slot, round(value, 6) + 0.0 as value from matrix""",
    "fit_apart": f"""with {_scaled("c_custkey % 3 <> 0 and segment <> 'BUILDING'")}
select c_custkey, slot, round(value, 6) + 0.0 as value from matrix""",
    "schema_roles": f"""with {_SCALED}
select c_custkey, slot, round(value, 6) + 0.0 as value from matrix""",
    "score_network_fixed": f"""with {_SCALED},
units as (
  select c_custkey, j, greatest(sum(value * ((7 * slot + 5 * j) % 11 / 10.0 - 0.5)) + 0.1, 0) as h
  from matrix, (values (0), (1), (2)) as unit(j) group by c_custkey, j),
outputs as (
  select c_custkey, sum(h * case j when 0 then 0.7 when 1 then -0.4 else 0.2 end) + 0.1 as z
  from units group by c_custkey)
select c_custkey, round(1 / (1 + exp(-z)), 2) as probability,
  case when z >= 0 then 1 else 0 end as predicted_label
from outputs""",
    "score_linear_fixed": f"""with {_SCALED}, logits as (
  select c_custkey, sum(value * (7 * slot % 11 - 5) / 10) as z from matrix group by c_custkey)
select c_custkey, round(1 / (1 + exp(-z)), 6) as probability,
  case when 1 / (1 + exp(-z)) >= 0.5 then 1 else 0 end as predicted
from logits""",
    "threshold_classes": f"""with {_scored()}
select model, count(*) filter (where probability >= 0.3) as at_least_03,
  count(*) filter (where probability >= 0.5) as at_least_05,
  count(*) filter (where probability > 0.5) as argmax
from scored group by model""",
    "round_report": """
select c_nationkey, round(cast(sum(cast(c_acctbal as decimal(14,2))) as double) / 1e6, 4) as share,
  round_even(c_nationkey / 32.0::double, 4) as tie
from customer group by c_nationkey""",
    "confusion_metrics": f"""with {_scored()}, counted as ({_counts("model")})
select model, tp, fp, fn, tn, {_rates()} from counted""",
    "roc_auc": f"""with {_scored()}, area as ({_auc("model")})
select model, round(roc_auc, 9) as roc_auc from area""",
    "classification_metrics": f"""with {_fold_metrics("nullif(fold, 4)")}
select model, fold, round(accuracy, 6) as accuracy, round(precision, 6) as precision,
  round(recall, 6) as recall, round(f1, 6) as f1, round(roc_auc, 6) as roc_auc
from measured""",
    "threshold_sweep": f"""with {_SWEEP}
select model, threshold, tp, fp, fn, tn, round(precision, 6) as precision,
  round(recall, 6) as recall, round(f1, 6) as f1, round(accuracy, 6) as accuracy
from sweep""",
    "best_threshold": f"""with {_SWEEP}, ranked as (
  select *, row_number() over (partition by model order by round(f1, 4) desc, pos) as place
  from sweep)
select model, threshold, round(f1, 6) as f1 from ranked where place = 1""",
    "default_threshold": f"""with {_SWEEP}, ranked as (
  select *, row_number() over (partition by model order by abs(threshold - 0.5), pos) as place
  from sweep)
select model, threshold, round(precision, 6) as precision, round(recall, 6) as recall,
  round(f1, 6) as f1, round(accuracy, 6) as accuracy
from ranked where place = 1""",
    "cv_summary": f"""with {_FOLD_METRICS}, cells as (
  unpivot measured on accuracy, precision, recall, f1, roc_auc into name metric value value)
select model, metric, round(avg(value), 6) as mean, round(stddev_pop(value), 6) as std
from cells group by model, metric""",
    "model_selection": f"""with {_scored()}, counted as ({_counts("model")}),
measured as (select model, {_rates(None, ("f1",))} from counted)
select model, round(f1, 6) as f1 from measured
order by round(f1, 4) desc, model desc limit 1""",
    "score_logistic": f"""with recursive {_LOGISTIC}
select doc_id, case when probability > 0.5 then 1 else 0 end as predicted_label from all_scores""",
    "train_logistic": f"""with recursive {_LOGISTIC}, counted as ({_counts("model")}), area as ({_auc("model")}),
measured_scores as (
  select counted.model, {_rates(None)}, roc_auc from counted join area on counted.model = area.model),
report as (unpivot measured_scores on accuracy, precision, recall, f1, roc_auc into name metric value value)
select model, 'test' as section, metric, round(value, 4) as value from report""",
    "best_trial": f"""with {_scored(4)}, counted as ({_counts("model, trial, fold")}),
measured as (select model, trial, fold, {_rates(None, ("f1",))} from counted),
trials as (
  select model, trial, avg(f1) as f1_mean, stddev_pop(f1) as f1_std
  from measured group by model, trial),
ranked as (
  select *, row_number() over (partition by model order by f1_mean desc, trial) as place,
    count(*) over (partition by model) as num_trials
  from trials)
select model, trial, round(f1_mean, 6) as f1_mean, round(f1_std, 6) as f1_std, num_trials
from ranked where place = 1""",
}

# The same slots, wherever the categories are kept.
ORACLES["onehot_dictionary"] = ORACLES["onehot"]
ORACLES["fit_apart_dictionary"] = ORACLES["fit_apart"]
