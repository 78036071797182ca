"""DuckDB SQL for the queries of the catalog, composed from named common table expressions."""

from __future__ import annotations

import re

FEATS = ["RECENCY_DAYS", "ORDER_FREQUENCY", "CUSTOMER_AGE_YEARS", "AVG_ORDER_VALUE"]
TRAIN = ["RECENCY_DAYS", "ORDER_FREQUENCY", "AVG_ORDER_VALUE", "TAM"]


def _long(source: str, keys: str, feats: list[str]) -> str:
    return " union all ".join(
        f"select {keys}{', ' if keys else ''}'{f}' as FEATURE, cast({f} as double) as VALUE from {source}"
        for f in feats)


def _dist(z: str, c: str, n: int) -> str:
    return " + ".join(f"({z}{i} - {c}{i}) * ({z}{i} - {c}{i})" for i in range(n))


def _scaled(source: str, scaler: str, feats: list[str]) -> str:
    joins = " ".join(
        f"join {scaler} s{i} on s{i}.SEGMENT_KEY = t.SEGMENT_KEY and s{i}.FEATURE = '{f}'"
        for i, f in enumerate(feats))
    zs = ", ".join(f"(t.{f} - s{i}.CENTER) / s{i}.SCALE as z{i}" for i, f in enumerate(feats))
    return f"select t.CUSTOMER_ID, t.SEGMENT_KEY, {zs} from {source} t {joins}"


def _scaler(source: str, feats: list[str]) -> str:
    return f"""
        select SEGMENT_KEY, FEATURE, quantile_cont(VALUE, 0.5) as CENTER,
               case when quantile_cont(VALUE, 0.75) - quantile_cont(VALUE, 0.25) = 0 then 1.0
                    else quantile_cont(VALUE, 0.75) - quantile_cont(VALUE, 0.25) end as SCALE
        from ({_long(source, 'SEGMENT_KEY', feats)}) group by 1, 2"""


def _customers(orders: str, as_of: str = "2001-08-01") -> str:
    return f"""
        select c.CUSTOMER_ID, MOST_RECENT_INDUSTRY_CODE_DESC, case when TAM is not null then 'TAM'
                 when TIER in ('Tier 0', 'Tier 1', 'Tier 2', 'Tier 3', 'Other') then 'TIER'
                 when AVG_ORDER_VALUE is not null then 'AVG_ANNUAL_SPEND' else 'UNKNOWN' end as TAM_TIER_SOURCE,
               TAM, RECENCY_DAYS, ORDER_FREQUENCY, CUSTOMER_AGE_YEARS, AVG_ORDER_VALUE
        from (select CUSTOMER_ID, min(INDUSTRY_CODE_DESC) as MOST_RECENT_INDUSTRY_CODE_DESC, min(TIER) as TIER,
                     min(TAM) as TAM,
                     cast(date_diff('day', cast(max(ORDER_DATE) as date), date '{as_of}') as double) as RECENCY_DAYS,
                     cast(count(*) as double) as ORDER_FREQUENCY,
                     date_diff('day', cast(min(ORDER_DATE) as date), date '{as_of}') / 365.25e0 as CUSTOMER_AGE_YEARS,
                     round(sum(GSAR), 4) / count(GSAR) as AVG_ORDER_VALUE
              from {orders} group by CUSTOMER_ID) c"""


def _key(industry: str, segment: str) -> str:
    return f"upper(coalesce({industry}, 'NA')) || '::' || coalesce({segment}, 'NA')"


def _seg(*parts: str) -> str:
    return " || '_' || ".join(f"coalesce({p}, 'NA')" for p in parts)


def _bound(base: str, cur: str) -> str:
    a = f"case when abs({base}) < 1e-6 then {base} - greatest(1.0, abs({base}) * FLEX_PCT) " \
        f"else {base} * (1.0 - FLEX_PCT) end"
    b = f"case when abs({base}) < 1e-6 then {base} + greatest(1.0, abs({base}) * FLEX_PCT) " \
        f"else {base} * (1.0 + FLEX_PCT) end"
    return f"case when {base} is null or {cur} is null then 'missing' " \
           f"when {cur} < least({a}, {b}) or {cur} > greatest({a}, {b}) then 'out' else 'in' end"


def _stats(source: str, feats: list[str]) -> str:
    return f"""
        select FEATURE, count(*) as TOTAL_ROWS, quantile_disc(VALUE, 0.01) as P1, quantile_disc(VALUE, 0.99) as P99,
               avg(VALUE) as MEAN, count(*) filter (where VALUE is null) / cast(count(*) as double) as NULL_PCT
        from ({_long(source, '', feats)}) group by 1"""


def _labels(rows: str, centers: str, n: int, tag: str) -> str:
    """First nearest centre of every row; needs columns z0.. and c0.., LABEL in the centres."""
    return f"""
        select {tag}, CUSTOMER_ID, arg_min(LABEL, (D2, LABEL)) as LABEL, min(D2) as D2
        from (select r.CUSTOMER_ID, m.*, {_dist('r.z', 'm.c', n)} as D2
              from {rows} r join {centers} m on r.SEGMENT_KEY = m.SEGMENT_KEY)
        group by {tag}, CUSTOMER_ID"""


_Z4 = ", ".join(f"z{i} as c{i}" for i in range(4))

CTES: dict[str, str] = {
    "orders_input": """
        select o_orderkey as ORDER_ID, o_custkey as CUSTOMER_ID, o_orderdate as ORDER_DATE, o_totalprice as GSAR,
               case when c_custkey % 50 = 49 then null else c_mktsegment end as INDUSTRY_CODE_DESC,
               case when c_custkey % 2 = 0 then 'CHAIN' when c_custkey % 7 = 0 then null else 'SINGLE' end
                 as COMPANY_TYPE_DESC,
               r_name as MSA_REGION, case when c_nationkey % 5 = 4 then null else n_name end as MSA,
               case when c_custkey % 3 = 0 then c_acctbal end as TAM,
               case c_custkey % 9 when 1 then 'Tier 0' when 2 then 'Tier 1' when 4 then 'Tier 3' when 5 then 'Other'
                 when 7 then 'Tier 9' end as TIER
        from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
        join region on n_regionkey = r_regionkey""",
    "yearly": """
        select CUSTOMER_ID, cast(year(ORDER_DATE) as integer) as ORDER_YEAR, round(sum(GSAR), 4) as YEARLY_GSAR
        from orders_input group by 1, 2""",
    "annual": "select CUSTOMER_ID, avg(YEARLY_GSAR) as AVG_ANNUAL_SPEND from yearly group by 1",
    "tiered": """
        select o.*, cast(year(ORDER_DATE) as integer) as ORDER_YEAR, AVG_ANNUAL_SPEND,
               case TIER when 'Tier 0' then 0 when 'Tier 1' then 1 when 'Tier 2' then 2 when 'Tier 3' then 3
                 when 'Other' then 4 end as TIER_NUMERIC
        from orders_input o left join annual using (CUSTOMER_ID)""",
    "sourced": """
        select *, coalesce(TAM, cast(TIER_NUMERIC as double), AVG_ANNUAL_SPEND) as TAM_TIER_OR_AVGSPEND,
               case when TAM is not null then 'TAM' when TIER_NUMERIC is not null then 'TIER'
                 when AVG_ANNUAL_SPEND is not null then 'AVG_ANNUAL_SPEND' else 'UNKNOWN' end as TAM_TIER_SOURCE
        from tiered""",
    "thresholds": """
        select INDUSTRY_CODE_DESC, TAM_TIER_SOURCE, quantile_disc(TAM_TIER_OR_AVGSPEND, 0.25) as value_q1,
               quantile_disc(TAM_TIER_OR_AVGSPEND, 0.5) as value_q2,
               quantile_disc(TAM_TIER_OR_AVGSPEND, 0.75) as value_q3
        from (select distinct INDUSTRY_CODE_DESC, TAM_TIER_SOURCE, CUSTOMER_ID, TAM_TIER_OR_AVGSPEND from sourced
              where TAM_TIER_SOURCE in ('TAM', 'AVG_ANNUAL_SPEND') and TAM_TIER_OR_AVGSPEND is not null)
        group by 1, 2""",
    "binned": """
        select s.*, value_q1, value_q2, value_q3,
               case when s.TAM_TIER_SOURCE = 'TIER' then TIER when TAM_TIER_OR_AVGSPEND is null then 'NA'
                 when TAM_TIER_OR_AVGSPEND <= value_q1 then 'Low'
                 when TAM_TIER_OR_AVGSPEND > value_q1 and TAM_TIER_OR_AVGSPEND <= value_q2 then 'Medium-Low'
                 when TAM_TIER_OR_AVGSPEND > value_q2 and TAM_TIER_OR_AVGSPEND <= value_q3 then 'Medium-High'
                 else 'High' end as TAM_TIER_BIN
        from sourced s left join thresholds t
          on s.INDUSTRY_CODE_DESC = t.INDUSTRY_CODE_DESC and s.TAM_TIER_SOURCE = t.TAM_TIER_SOURCE""",
    "keyed": f"""
        select *,
          {_seg('INDUSTRY_CODE_DESC', 'COMPANY_TYPE_DESC', 'MSA_REGION', 'MSA', 'TAM_TIER_SOURCE', 'TAM_TIER_BIN')}
            as RULE_BASED_SEGMENT,
          {_seg('INDUSTRY_CODE_DESC', 'COMPANY_TYPE_DESC', 'MSA_REGION', 'TAM_TIER_SOURCE', 'TAM_TIER_BIN')}
            as RULE_BASED_SEGMENT_NO_MSA,
          {_seg('INDUSTRY_CODE_DESC', 'COMPANY_TYPE_DESC', 'TAM_TIER_SOURCE', 'TAM_TIER_BIN')}
            as RULE_BASED_SEGMENT_NO_MSA_NO_MSA_REGION
        from binned""",
    "seg1": "select RULE_BASED_SEGMENT, count(distinct CUSTOMER_ID) as COUNT_SEG_1 from keyed group by 1",
    "seg2": "select RULE_BASED_SEGMENT_NO_MSA, count(distinct CUSTOMER_ID) as COUNT_SEG_2 from keyed group by 1",
    "seg3": "select RULE_BASED_SEGMENT_NO_MSA_NO_MSA_REGION, count(distinct CUSTOMER_ID) as COUNT_SEG_3 "
            "from keyed group by 1",
    "assigned": """
        select *, case when COUNT_SEG_1 > 2 then 1 when COUNT_SEG_2 > 2 then 2 else 3 end as SEGMENT_LEVEL,
               case when COUNT_SEG_1 > 2 then RULE_BASED_SEGMENT when COUNT_SEG_2 > 2 then RULE_BASED_SEGMENT_NO_MSA
                 else RULE_BASED_SEGMENT_NO_MSA_NO_MSA_REGION end as SEGMENT
        from keyed left join seg1 using (RULE_BASED_SEGMENT) left join seg2 using (RULE_BASED_SEGMENT_NO_MSA)
        left join seg3 using (RULE_BASED_SEGMENT_NO_MSA_NO_MSA_REGION)""",
    "customers": _customers("orders_input"),
    "train_rows": f"""
        select CUSTOMER_ID, {_key('MOST_RECENT_INDUSTRY_CODE_DESC', 'TAM_TIER_SOURCE')} as SEGMENT_KEY,
               upper(MOST_RECENT_INDUSTRY_CODE_DESC) as INDUSTRY, TAM_TIER_SOURCE as SEGMENT,
               RECENCY_DAYS, ORDER_FREQUENCY, AVG_ORDER_VALUE, TAM, TAM is not null as USABLE
        from customers where upper(MOST_RECENT_INDUSTRY_CODE_DESC) in ('BUILDING', 'AUTOMOBILE', 'MACHINERY')""",
    "train_usable": "select * from train_rows where USABLE",
    "full_rows": f"""
        select *, {_key('MOST_RECENT_INDUSTRY_CODE_DESC', 'TAM_TIER_SOURCE')} as SEGMENT_KEY,
               upper(coalesce(MOST_RECENT_INDUSTRY_CODE_DESC, 'NA')) as INDUSTRY, TAM_TIER_SOURCE as SEGMENT,
               {' and '.join(f'{f} is not null' for f in FEATS)} as USABLE
        from customers""",
    "full_usable": "select * from full_rows where USABLE",
    "full_scaler": _scaler("full_usable", FEATS),
    "order_features": """
        select *, case TIER when 'Tier 0' then 0 when 'Tier 1' then 1 when 'Tier 2' then 2 when 'Tier 3' then 3
                 when 'Other' then 4 end as TIER_NUMERIC, 1.0e0 as FLAT,
               case when CUSTOMER_ID % 997 = 0 then GSAR end as RARE
        from orders_input""",
    "earlier": "select * from order_features where ORDER_DATE < timestamp '1998-05-01'",
    "later": """
        select * replace (GSAR * 2.5 as GSAR, case when CUSTOMER_ID % 2 = 1 then TAM end as TAM)
        from order_features where ORDER_DATE >= timestamp '1998-05-01'""",
    "base_stats": f"""
        select FEATURE, P1 as BASE_P1, P99 as BASE_P99, MEAN as BASE_MEAN, NULL_PCT as BASE_NULL_PCT
        from ({_stats('earlier', ['GSAR', 'TAM', 'TIER_NUMERIC'])})
        union all select 'LIFETIME_VALUE', 0.0, 9.0, 1.0, 0.0""",
    "cur_stats": _stats("later", ["GSAR", "TAM", "TIER_NUMERIC"]),
    "banded": f"""
        select *, {_bound('BASE_P1', 'P1')} as P1_RESULT, {_bound('BASE_P99', 'P99')} as P99_RESULT,
               {_bound('BASE_MEAN', 'MEAN')} as MEAN_RESULT
        from (select b.*, TOTAL_ROWS, P1, P99, MEAN, NULL_PCT, TOTAL_ROWS is not null as PRESENT,
                     case FEATURE when 'TIER_NUMERIC' then 0.2e0 when 'TAM' then 0.4e0 else 0.5e0 end as FLEX_PCT,
                     NULL_PCT - coalesce(BASE_NULL_PCT, 0.0) as NULL_DELTA
              from base_stats b left join cur_stats using (FEATURE))""",
    "checked": """
        select *, case when not PRESENT or NULL_RESULT = 'fail' or P99_SEVERITY > 1.0 then 'fail'
                    when 'out' in (P1_RESULT, P99_RESULT, MEAN_RESULT) or NULL_RESULT = 'warn' then 'warn'
                    else 'ok' end as STATUS
        from (select *, case when NULL_DELTA > 0.3 then 'fail' when NULL_DELTA > 0.1 then 'warn' else 'ok' end
                          as NULL_RESULT,
                     case when P99_RESULT = 'out' then
                        case when abs(BASE_P99) < 1e-6 then abs(P99 - BASE_P99)
                          else abs(P99 - BASE_P99) / (abs(BASE_P99) + 1e-9) end
                        else 0.0e0 end as P99_SEVERITY
              from banded)""",
    "all_rows": f"""
        select *, {_key('MOST_RECENT_INDUSTRY_CODE_DESC', 'TAM_TIER_SOURCE')} as SEGMENT_KEY,
               upper(coalesce(MOST_RECENT_INDUSTRY_CODE_DESC, 'NA')) as INDUSTRY from customers""",
    "sizes": "select SEGMENT_KEY, INDUSTRY, count(*) as CUSTOMER_COUNT from all_rows group by 1, 2",
    "ready_rows": "select * from all_rows where SEGMENT_KEY in (select SEGMENT_KEY from sizes where CUSTOMER_COUNT >= 20)",
    "scaler": _scaler("ready_rows", FEATS),
    "scaled": _scaled("ready_rows", "scaler", FEATS),
    "seeds": f"""
        select SEGMENT_KEY, cast(NO - 1 as integer) as LABEL, {_Z4}
        from (select *, row_number() over (partition by SEGMENT_KEY order by CUSTOMER_ID) as NO from scaled)
        where NO <= 4""",
    "centers": "select s.*, K from seeds s cross join (select unnest([2, 3, 4]) as K) where LABEL < K",
    "labels": _labels("scaled", "centers", 4, "SEGMENT_KEY, K"),
    "silhouettes": f"""
        select SEGMENT_KEY, K, avg(case when n_own <= 1 or greatest(a, b) = 0 then 0.0
                                        else (b - a) / greatest(a, b) end) as SILHOUETTE
        from (select SEGMENT_KEY, K, id, max(n_own) as n_own,
                     max(case when other = own then total / nullif(n - 1, 0) end) as a,
                     min(case when other <> own then total / n end) as b, max(n_own) as n_all
              from (select x.SEGMENT_KEY, lx.K, x.CUSTOMER_ID as id, lx.LABEL as own, ly.LABEL as other,
                           sum(sqrt({_dist('x.z', 'y.z', 4)})) as total, count(*) as n,
                           count(*) filter (where lx.LABEL = ly.LABEL) as n_own
                    from scaled x join scaled y on x.SEGMENT_KEY = y.SEGMENT_KEY
                    join labels lx on lx.CUSTOMER_ID = x.CUSTOMER_ID
                    join labels ly on ly.CUSTOMER_ID = y.CUSTOMER_ID and ly.K = lx.K
                    group by 1, 2, 3, 4, 5)
              group by 1, 2, 3)
        group by 1, 2""",
    "best": """
        select SEGMENT_KEY, K as BEST_K, SILHOUETTE as BEST_SILHOUETTE
        from (select *, row_number() over (partition by SEGMENT_KEY order by SILHOUETTE desc, K) as r
              from silhouettes) where r = 1""",
    "gates": """
        select 'run_' || replace(INDUSTRY, ' ', '_') as run_id, count(*) as segments_total,
               count(BEST_SILHOUETTE) as clustered_segments, avg(BEST_SILHOUETTE) as avg_silhouette
        from sizes left join best using (SEGMENT_KEY) group by 1""",
    "gate_status": """
        select *, case when clustered_segments < 1 then 'fail' when avg_silhouette >= 0.2 then 'ok'
                    when avg_silhouette >= 0.2 * 0.8 then 'warn' else 'fail' end as status from gates""",
    "labels3": "select SEGMENT_KEY, CUSTOMER_ID, LABEL from labels where K = 3",
    "edges": f"""
        select FEATURE, BASE_N, list_sort(list_distinct(q)) as EDGES
        from (select FEATURE, count(VALUE) as BASE_N,
                     quantile_cont(VALUE, [{', '.join(f'cast({i * 0.1!r}e0 as double)' for i in range(10))}, 1e0]) as q
              from ({_long('earlier', '', ['GSAR', 'TAM', 'TIER_NUMERIC', 'FLAT', 'RARE'])})
              where VALUE is not null group by 1)""",
    "sides": f"""
        select *, 0 as cur from ({_long('earlier', '', ['GSAR', 'TAM', 'TIER_NUMERIC', 'FLAT', 'RARE'])})
        union all
        select *, 1 as cur from ({_long('later', '', ['GSAR', 'TAM', 'TIER_NUMERIC', 'FLAT', 'RARE'])})""",
    "hist": """
        select FEATURE, BIN, count(*) filter (where cur = 0) as BASE_COUNT, count(*) filter (where cur = 1) as CUR_COUNT
        from (select FEATURE, cur,
                     cast(case when VALUE = EDGES[-1] then len(EDGES) - 2
                       when VALUE >= EDGES[1] and VALUE < EDGES[-1]
                         then len(list_filter(EDGES, lambda e: e <= VALUE)) - 1 end as integer) as BIN
              from sides join edges using (FEATURE) where VALUE is not null and len(EDGES) >= 3)
        group by 1, 2""",
    "psi": """
        select FEATURE, sum((a - e) * ln(a / e)) as PSI, max(oor) as OUT_OF_RANGE_SHARE
        from (select FEATURE, greatest(least(coalesce(BASE_COUNT, 0) / nullif(nb, 0), 1.0), 1e-8) as e,
                     greatest(least(coalesce(CUR_COUNT, 0) / nullif(nc, 0), 1.0), 1e-8) as a, (nall - nc) / nall as oor
              from (select FEATURE, unnest(range(len(EDGES) - 1)) as BIN from edges where len(EDGES) >= 3)
              left join hist using (FEATURE, BIN)
              join (select FEATURE, cast(sum(BASE_COUNT) filter (where BIN is not null) as double) as nb,
                           cast(sum(CUR_COUNT) filter (where BIN is not null) as double) as nc,
                           cast(sum(CUR_COUNT) as double) as nall from hist group by 1) using (FEATURE))
        group by 1""",
    "psi_report": """
        select FEATURE, PSI, NOTE, OUT_OF_RANGE_SHARE,
               case when PSI >= 0.25 then 'fail' when PSI >= 0.1 then 'warn' else 'ok' end as STATUS
        from (select FEATURE, NOTE, case when NOTE is null then PSI end as PSI,
                     case when NOTE is null then OUT_OF_RANGE_SHARE end as OUT_OF_RANGE_SHARE
              from (select n.FEATURE, PSI, OUT_OF_RANGE_SHARE,
                           case when least(nb, nc) < 50 then 'insufficient_samples'
                             when len(EDGES) < 3 then 'low_variance_baseline' end as NOTE
                    from (select FEATURE, count(VALUE) filter (where cur = 0) as nb,
                                 count(VALUE) filter (where cur = 1) as nc from sides group by 1) n
                    left join edges using (FEATURE) left join psi using (FEATURE)))""",
    "half_rows": f"""
        select 0 as cur, c.*, {_key('MOST_RECENT_INDUSTRY_CODE_DESC', 'TAM_TIER_SOURCE')} as SEGMENT_KEY
        from ({_customers('earlier')}) c union all
        select 1 as cur, c.*, {_key('MOST_RECENT_INDUSTRY_CODE_DESC', 'TAM_TIER_SOURCE')} as SEGMENT_KEY
        from ({_customers('later')}) c""",
    "half_scaled": "select h.cur, h.CUSTOMER_ID, h.SEGMENT_KEY, " + ", ".join(
        f"(h.{f} - s{i}.CENTER) / s{i}.SCALE as z{i}" for i, f in enumerate(FEATS)) + " from half_rows h " + " ".join(
        f"join scaler s{i} on s{i}.SEGMENT_KEY = h.SEGMENT_KEY and s{i}.FEATURE = '{f}'"
        for i, f in enumerate(FEATS)),
    "half_labels": f"""
        select cur, CUSTOMER_ID, arg_min(LABEL, (D2, LABEL)) as LABEL
        from (select r.cur, r.CUSTOMER_ID, m.LABEL, {_dist('r.z', 'm.c', 4)} as D2
              from half_scaled r join centers m on r.SEGMENT_KEY = m.SEGMENT_KEY and m.K = 3) group by 1, 2""",
    "shares": """
        select LABEL, count(*) filter (where cur = 1) / sum(count(*) filter (where cur = 1)) over () as CURRENT_SHARE,
               count(*) filter (where cur = 0) / sum(count(*) filter (where cur = 0)) over () as BASELINE_SHARE
        from (select h.cur, coalesce(l.LABEL, -1) as LABEL
              from half_rows h left join half_labels l on h.cur = l.cur and h.CUSTOMER_ID = l.CUSTOMER_ID)
        group by 1""",
    "kl": """
        select sum(p * ln(p / q)) as KL, string_agg(cast(LABEL as varchar), ',' order by cast(LABEL as varchar)) as LABELS
        from (select LABEL, greatest(least(CURRENT_SHARE, 1.0), 1e-8) as p,
                     greatest(least(BASELINE_SHARE, 1.0), 1e-8) as q from shares)""",
    "kl_report": "select *, case when KL >= 0.1 then 'fail' when KL >= 0.05 then 'warn' else 'ok' end as STATUS from kl",
    "moments": """
        select FEATURE, NULL_PCT is not null as PRESENT, BASE_MEAN, MEAN as CURRENT_MEAN,
               case when BASE_MEAN = 0 then case when MEAN is not null then 0.0 end
                 else abs(MEAN - BASE_MEAN) / (abs(BASE_MEAN) + 1e-9) end as MEAN_DEV,
               NULL_PCT - coalesce(BASE_NULL_PCT, 0.0) as NULL_DELTA
        from base_stats left join cur_stats using (FEATURE)""",
    "background": "select SEGMENT_KEY, " + ", ".join(
        f"avg(z{i}) as m{i}, avg(z{i} * z{i}) as q{i}" for i in range(4)) + " from scaled group by 1",
    "explained": "select * from scaled",
    "hashed": """
        select *, md5(cast(CUSTOMER_ID as varchar)) as h, row_number() over (
                 partition by SEGMENT_KEY order by md5(cast(CUSTOMER_ID as varchar)), CUSTOMER_ID) as r from scaled""",
    "background_quarter": "select SEGMENT_KEY, " + ", ".join(
        f"coalesce(avg({x}) filter (where substring(h, 1, 8) < '40000000'), avg({x})) as {n}{i}"
        for i in range(4) for x, n in ((f"z{i}", "m"), (f"z{i} * z{i}", "q"))) + " from hashed group by 1",
    "background_50": "select SEGMENT_KEY, " + ", ".join(
        f"avg(z{i}) as m{i}, avg(z{i} * z{i}) as q{i}" for i in range(4)) + " from hashed where r <= 50 group by 1",
    "explained_tables": "select * from scaled where SEGMENT_KEY not like 'AUTO%' or CUSTOMER_ID % 2 = 0",
    "background_tables": "select SEGMENT_KEY, " + ", ".join(
        f"avg(z{i}) as m{i}, avg(z{i} * z{i}) as q{i}" for i in range(4)) + " from explained_tables group by 1",
    "explained_20": "select * from hashed where r <= 20",
    "global_rows": "select 'ALL' as SEGMENT_KEY, * from customers",
    "global_scaler": _scaler("(select * from global_rows where TAM is not null)", TRAIN),
    "global_filled": "select CUSTOMER_ID, SEGMENT_KEY, " + ", ".join(
        f"coalesce({f}, (select quantile_cont({f}, 0.5) from customers)) as {f}" for f in TRAIN) + " from global_rows",
    "global_scaled": _scaled("global_filled", "global_scaler", TRAIN),
    "global_centers": f"""
        select SEGMENT_KEY, cast(row_number() over (order by CUSTOMER_ID) - 1 as integer) as LABEL, {_Z4}
        from (select g.* from global_scaled g join customers c using (CUSTOMER_ID) where c.TAM is not null
              order by CUSTOMER_ID limit 3)""",
    "global_labels": _labels("global_scaled", "global_centers", 4, "SEGMENT_KEY"),
}


def _compose(final: str) -> str:
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(CTES[name])

    visit(final)
    parts = [f"{name} as materialized ({sql})" for name, sql in CTES.items() if name in needed]
    return (f"with {', '.join(parts)} " if parts else "") + final


def _r(expr: str, name: str | None = None, digits: int = 6) -> str:
    return f"round({expr}, {digits}) + 0.0 as {name or expr}"


def _score(k: int, head: str, tail: str = "") -> str:
    return f"""
        select r.CUSTOMER_ID, {head}, cast(coalesce(l.LABEL, -1) as integer) as CLUSTER_LABEL{tail}
        from all_rows r left join (select * from labels where K = {k}) l on r.CUSTOMER_ID = l.CUSTOMER_ID"""


_GAIN = "(z{i} - c{i}) * (z{i} - c{i}) - (q{i} - 2 * c{i} * m{i} + c{i} * c{i})"


def _shap(i: int, feature: str, rows: str, background: str, more: str = "", digits: int = 5) -> str:
    return f"""
        select e.SEGMENT_KEY as SEGMENT, l.LABEL as CLUSTER, '{feature}' as FEATURE,
               {_r(f"avg(abs({_GAIN.format(i=i)}))", "SHAP", digits)}{more}
        from {rows} e join labels3 l on e.CUSTOMER_ID = l.CUSTOMER_ID
        join {background} b on b.SEGMENT_KEY = e.SEGMENT_KEY
        join centers c on c.SEGMENT_KEY = e.SEGMENT_KEY and c.K = 3 and c.LABEL = l.LABEL group by 1, 2"""


_ROUNDED_FEATS = ", ".join(_r(f) for f in FEATS)
_LEVELS = ["RULE_BASED_SEGMENT", "RULE_BASED_SEGMENT_NO_MSA", "RULE_BASED_SEGMENT_NO_MSA_NO_MSA_REGION"]
_DQ = ["CUSTOMER_ID", "ORDER_DATE", "GSAR", "INDUSTRY_CODE_DESC", "MSA", "TAM", "TIER"]

FINAL: dict[str, str] = {
    "yearly_spend": f"select CUSTOMER_ID, ORDER_YEAR, {_r('YEARLY_GSAR', digits=4)} from yearly",
    "avg_annual_spend": f"select CUSTOMER_ID, {_r('AVG_ANNUAL_SPEND')} from annual",
    "tier_fallback": f"""
        select CUSTOMER_ID, {_r('TAM')}, TIER, count(*) as ORDER_ROWS, {_r('AVG_ANNUAL_SPEND')},
               cast(TIER_NUMERIC as double) as TIER_NUMERIC, {_r('TAM_TIER_OR_AVGSPEND')}, TAM_TIER_SOURCE from sourced group by all""",
    "null_pct_by_industry": f"""
        select INDUSTRY_CODE_DESC, count(distinct CUSTOMER_ID) as CUSTOMER_COUNT,
               {_r('count(distinct case when TAM_TIER_OR_AVGSPEND is null then CUSTOMER_ID end) * 100'
                   ' / count(distinct CUSTOMER_ID)', 'NULL_PCT', 2)}
        from sourced where INDUSTRY_CODE_DESC is not null group by 1""",
    "spend_thresholds": f"""
        select INDUSTRY_CODE_DESC, TAM_TIER_SOURCE, {_r('value_q1')}, {_r('value_q2')}, {_r('value_q3')}
        from thresholds""",
    "tier_bins": f"""
        select distinct CUSTOMER_ID, INDUSTRY_CODE_DESC, TAM_TIER_SOURCE, {_r('TAM_TIER_OR_AVGSPEND')},
               {_r('value_q1')}, {_r('value_q2')}, {_r('value_q3')}, TAM_TIER_BIN from binned""",
    "segment_keys": f"select distinct CUSTOMER_ID, {', '.join(_LEVELS)} from keyed",
    "segment_counts": " union all ".join(
        f"select '{level}' as LEVEL_NAME, {level} as SEGMENT_KEY, COUNT_SEG_{i} as CUSTOMERS from seg{i}"
        for i, level in enumerate(_LEVELS, 1)),
    "segment_counts_bitmap": " union all ".join(
        f"select '{level}' as LEVEL_NAME, {level} as SEGMENT_KEY, COUNT_SEG_{i} as CUSTOMERS from seg{i}"
        for i, level in enumerate(_LEVELS, 1)),
    "segment_assign": """
        select SEGMENT, SEGMENT_LEVEL, count(distinct CUSTOMER_ID) as CUSTOMERS, count(*) as ORDER_ROWS
        from assigned group by 1, 2""",
    "avg_annual_spend_incremental": f"select CUSTOMER_ID, {_r('AVG_ANNUAL_SPEND')} from annual",
    "prepared_orders": f"""
        select ORDER_ID, CUSTOMER_ID, ORDER_YEAR, {_r('GSAR')}, {_r('AVG_ANNUAL_SPEND')},
               cast(TIER_NUMERIC as double) as TIER_NUMERIC, {_r('TAM_TIER_OR_AVGSPEND')}, TAM_TIER_SOURCE, TAM_TIER_BIN, COUNT_SEG_1, COUNT_SEG_2, COUNT_SEG_3,
               SEGMENT from assigned""",
    "extract_window": f"""
        select ORDER_ID, CUSTOMER_ID, {_r('GSAR')} from orders_input
        where ORDER_DATE >= timestamp '1996-01-01' and ORDER_DATE < timestamp '1998-01-01'""",
    "normalized_scan": f"""
        select c_custkey as C_CUSTKEY, c_name as C_NAME, c_nationkey as C_NATIONKEY, {_r('c_acctbal', 'C_ACCTBAL')},
               c_mktsegment as C_MKTSEGMENT from customer""",
    "sample_scan": f"""
        select ORDER_ID, CUSTOMER_ID, {_r('GSAR')}, TIER from orders_input
        order by md5(cast(ORDER_ID as varchar)), ORDER_ID limit 1000""",
    "dq_check": " union all ".join(
        f"select '{c}' as COLUMN_NAME, true as PRESENT, count(*) as TOTAL_ROWS, "
        + _r(f"count(*) filter (where {c} is null) / cast(count(*) as double)", "NULL_RATE")
        + ", case when count(*) >= 100 then 'ok' else 'fail' end as STATUS from orders_input" for c in _DQ)
        + " union all select 'LIFETIME_VALUE', false, count(*), cast(null as double), 'fail' from orders_input",
    "customer_features": f"""
        select CUSTOMER_ID, MOST_RECENT_INDUSTRY_CODE_DESC, TAM_TIER_SOURCE, {_r('TAM')}, {_ROUNDED_FEATS}
        from customers""",
    "train_input": f"select CUSTOMER_ID, SEGMENT_KEY, {', '.join(_r(f) for f in TRAIN)} from train_usable",
    "train_cap": """
        select CUSTOMER_ID, INDUSTRY, SEGMENT, USABLE
        from (select *, row_number() over (partition by INDUSTRY order by md5(cast(CUSTOMER_ID as varchar)),
                                           CUSTOMER_ID) as r from full_rows) where r <= 50""",
    "baseline_coverage": "select FEATURE, FEATURE <> 'LIFETIME_VALUE' as PRESENT from base_stats",
    "feature_stats": "select FEATURE, TOTAL_ROWS, " + ", ".join(_r(c) for c in ("P1", "P99", "MEAN", "NULL_PCT"))
        + f" from ({_stats('order_features', ['GSAR', 'TAM', 'TIER_NUMERIC', 'FLAT', 'RARE'])})",
    "merged_sketches": "select FEATURE, TOTAL_ROWS, " + ", ".join(_r(c) for c in ("MEAN", "NULL_PCT"))
        + f", true as WITHIN from ({_stats('order_features', ['GSAR', 'TAM', 'TIER_NUMERIC', 'FLAT', 'RARE'])})",
    "baseline_documents": " union all ".join(
        f"select {n} as DOCUMENT, FEATURE, " + ", ".join(_r(c, f"BASE_{c}") for c in ("P1", "P99", "MEAN", "NULL_PCT"))
        + f", '{extra}' as EXTRA, null as PROBLEM from ({_stats('earlier', ['GSAR', 'TAM', 'TIER_NUMERIC'])})"
        for n, extra in ((0, ""), (1, "rank"))) + """
        union all select 2, null, null, null, null, null, null, 'no JSON'
        union all select 3, null, null, null, null, null, null, 'no feature'""",
    "feature_check": "select FEATURE, cast(TOTAL_ROWS as double) as TOTAL_ROWS, PRESENT, P1_RESULT, P99_RESULT, MEAN_RESULT, NULL_RESULT, STATUS, "
        + ", ".join(_r(c) for c in (
            "BASE_P1", "BASE_P99", "BASE_MEAN", "BASE_NULL_PCT", "P1", "P99", "MEAN", "NULL_PCT", "FLEX_PCT",
            "NULL_DELTA", "P99_SEVERITY")) + " from checked",
    "feature_gate": """
        select count(*) filter (where PRESENT) as PRESENT_FEATURES,
               case when count(*) filter (where PRESENT) = 0 or count(*) filter (where STATUS = 'fail') > 0 then 'fail'
                 when count(*) filter (where STATUS = 'warn') > 0 then 'warn' else 'ok' end as STATUS,
               count(*) filter (where STATUS = 'fail') as FAILED, count(*) filter (where STATUS = 'warn') as WARNED
        from checked""",
    "failing_rows": f"""
        select FEATURE, {_r('FEATURE_VALUE')}, ORDER_ID, CUSTOMER_ID, {_r('TAM')},
               cast(TIER_NUMERIC as double) as TIER_NUMERIC
        from (select *, row_number() over (partition by FEATURE order by md5(cast(ORDER_ID as varchar)), ORDER_ID) as r
              from (select c.FEATURE, l.* from checked c join
                      ({' union all '.join(f"select '{f}' as F, cast({f} as double) as FEATURE_VALUE, ORDER_ID, CUSTOMER_ID, TAM, TIER_NUMERIC from later" for f in ('GSAR', 'TAM', 'TIER_NUMERIC'))}) l
                    on l.F = c.FEATURE
                    where STATUS = 'fail' and (FEATURE_VALUE > BASE_P99 * (1 + FLEX_PCT)
                                               or FEATURE_VALUE < BASE_P1 * (1 - FLEX_PCT))))
        where r <= 10""",
    "robust_scaler": f"select SEGMENT_KEY, FEATURE, {_r('CENTER')}, {_r('SCALE')} from full_scaler",
    "scaled_features": "select CUSTOMER_ID, SEGMENT_KEY, " + ", ".join(
        _r(f"z{i}", f"Z_{f}") for i, f in enumerate(FEATS))
        + f" from ({_scaled('full_usable', 'full_scaler', FEATS)})",
    "k_candidates": """
        select SEGMENT_KEY, CUSTOMER_COUNT as USABLE_COUNT,
               cast(unnest(range(2, least(10, greatest(2, CUSTOMER_COUNT // 2)) + 1)) as integer) as K from sizes""",
    "segment_status": """
        select *, case when CUSTOMER_COUNT < 20 then 'SKIPPED_TOO_SMALL'
                    when USABLE_COUNT < 20 then 'SKIPPED_AFTER_DROPOFF' when K_HI < K_LO then 'NO_K_CANDIDATES'
                    else 'READY' end as STATUS
        from (select SEGMENT_KEY, count(*) as CUSTOMER_COUNT, count(TAM) as USABLE_COUNT, 2 as K_LO,
                     cast(least(10, greatest(2, count(TAM) // 2)) as integer) as K_HI from all_rows group by 1)""",
    "model_resolve": " union all ".join(f"""
        select 'run_fixed' as run_id, c.SEGMENT_KEY as segment_key, 3 as best_k, LABEL as CLUSTER, '{f}' as FEATURE,
               {_r('s.CENTER', 'CENTER')}, {_r('s.SCALE', 'SCALE')}, {_r(f'c{i}', 'COORDINATE')}
        from centers c join scaler s on s.SEGMENT_KEY = c.SEGMENT_KEY and s.FEATURE = '{f}' where K = 3"""
        for i, f in enumerate(FEATS)),
    "latest_run": f"""
        select 'run_' || year(ORDER_DATE) as run_id,
               {_key('INDUSTRY_CODE_DESC', 'COMPANY_TYPE_DESC')} as segment_key,
               count(distinct CUSTOMER_ID) as customer_count
        from orders_input where year(ORDER_DATE) = (select max(year(ORDER_DATE)) from orders_input) group by 1, 2""",
    "score_segments": _score(
        4, "TAM_TIER_SOURCE as SEGMENT", ", 'run_fixed' as RUNID, '2001-08-01T00:00:00Z' as SCORED_AT_UTC"),
    "score_by_key": _score(3, "r.SEGMENT_KEY"),
    "score_by_sql": _score(3, "r.SEGMENT_KEY"),
    "score_global": f"""
        select CUSTOMER_ID, {', '.join(_r(f) for f in TRAIN)}, cast(LABEL as bigint) as CLUSTER_LABEL,
               'run_fixed' as RUNID from global_filled join global_labels using (CUSTOMER_ID)""",
    "silhouette": f"select SEGMENT_KEY, K, {_r('SILHOUETTE')} from silhouettes",
    "silhouette_bounds": f"select SEGMENT_KEY, K, {_r('SILHOUETTE')}, true as HOLDS, true as NARROW from silhouettes",
    "kmeans_check": """
        select SEGMENT_KEY, cast(unnest(range(2, least(10, greatest(2, CUSTOMER_COUNT // 2)) + 1)) as integer) as K,
               CUSTOMER_COUNT as ROWS, true as INERTIA_AGREES, true as SETTLED, true as FALLS
        from sizes where CUSTOMER_COUNT >= 20""",
    "silhouette_embeddings": f"""
        select 'ALL' as SEGMENT_KEY, 10 as K, {_r("""avg(case when n_own <= 1 or greatest(a, b) = 0 then 0.0
               else (b - a) / greatest(a, b) end)""", 'SILHOUETTE')}
        from (select id, max(n_own) as n_own, max(case when other = own then total / nullif(n - 1, 0) end) as a,
                     min(case when other <> own then total / n end) as b
              from (select x.vec_id as id, x.label as own, y.label as other, count(*) as n,
                           sum(list_distance(cast(x.embedding as double[]), cast(y.embedding as double[]))) as total,
                           count(*) filter (where x.label = y.label) as n_own
                    from embeddings x cross join embeddings y group by 1, 2, 3)
              group by 1)""",
    "best_k": f"select SEGMENT_KEY, BEST_K, {_r('BEST_SILHOUETTE')} from best",
    "lloyd_step": "select l.SEGMENT_KEY, K, LABEL, count(*) as N, " + _r("sum(D2)", "INERTIA", 5) + ", " + ", ".join(
        _r(f"avg(z{i})", f"C_{f}", 5) for i, f in enumerate(FEATS))
        + " from labels l join scaled s on l.CUSTOMER_ID = s.CUSTOMER_ID group by 1, 2, 3",
    "model_gate": f"""
        select run_id, segments_total, clustered_segments, {_r('avg_silhouette')}, status from gate_status""",
    "accepted_models": f"""
        select run_id, 'segment-clusters-' || run_id as model_name, 'models/run_id=' || run_id as bundle_uri,
               '{{"stage":"test"}}' as labels_json, 'fixed centroids' as description, {_r('avg_silhouette')}
        from gate_status where status = 'ok'""",
    "drift_edges": f"""
        select FEATURE, BASE_N, cast(i as integer) as EDGE_NO, {_r('EDGES[i + 1]', 'EDGE')}
        from (select *, unnest(range(len(EDGES))) as i from edges)""",
    "drift_hist": "select FEATURE, coalesce(BIN, -1) as BIN, BASE_COUNT, CUR_COUNT from hist",
    "drift_psi": f"select FEATURE, {_r('PSI')}, NOTE, {_r('OUT_OF_RANGE_SHARE')}, STATUS from psi_report",
    "cluster_shares": f"""
        select cast(LABEL as integer) as LABEL, {_r('CURRENT_SHARE')}, {_r('BASELINE_SHARE')} from shares""",
    "cluster_share_kl": f"select {_r('KL')}, LABELS, STATUS from kl_report",
    "drift_vs_stats": "select FEATURE, PRESENT, " + ", ".join(
        _r(c) for c in ("BASE_MEAN", "CURRENT_MEAN", "MEAN_DEV", "NULL_DELTA")) + """,
        case when not PRESENT or NULL_DELTA > 0.3 then 'fail' when MEAN_DEV > 0.5 then 'warn' else 'ok' end as STATUS
        from moments""",
    "drift_stats_vs_stats": "select FEATURE, PRESENT, " + ", ".join(
        _r(c) for c in ("BASE_MEAN", "CURRENT_MEAN", "MEAN_DEV", "NULL_DELTA")) + """,
        case when not PRESENT or MEAN_DEV > 0.5 or NULL_DELTA > 0.3 then 'fail'
          when MEAN_DEV > 0.25 or NULL_DELTA > 0.1 then 'warn' else 'ok' end as STATUS from moments""",
    "drift_status": """
        select case when count(*) filter (where STATUS = 'fail') > 0 then 'fail'
                 when count(*) filter (where STATUS = 'warn') > 0 then 'warn' else 'ok' end as STATUS,
               count(*) filter (where STATUS = 'warn') as WARNED, count(*) filter (where STATUS = 'fail') as FAILED
        from (select STATUS from psi_report union all select STATUS from kl_report)""",
    "segment_prefix": """
        select SEGMENT_KEY as segment_key,
               case when CUSTOMER_COUNT >= 20 then 'CLUSTERED' else 'SKIPPED_TOO_SMALL' end as status,
               CUSTOMER_COUNT as customer_count from sizes where lower(SEGMENT_KEY) like 'auto%'""",
    "run_sink": """
        select case when o_orderpriority = '1-URGENT' then 'RUN_A_1' else 'other' end as RUN_ID, count(*) as ROW_COUNT,
               cast(sum(cast(o_totalprice as decimal(38, 2))) as double) as TOTAL
        from orders group by 1""",
    "overwrite_sink": """
        select count(*) as FIRST_ROWS, count(*) filter (where o_custkey % 2 = 0) as SECOND_ROWS,
               cast(2 * count(*) as bigint) as ADDED_ROWS, count(*) filter (where o_custkey % 2 = 0) as REPLACED,
               cast(2 * count(*) as bigint) as GROWN
        from orders""",
    "report_sink": " union all ".join(f"""
        select '{c}' as COLUMN_NAME, {_r(f"count(*) filter (where {c} is null) / cast(count(*) as double)", "NULL_RATE")},
               case when count(*) >= 100 then 'ok' else 'fail' end as STATUS, count(*) as TOTAL_ROWS
        from orders_input""" for c in ("GSAR", "TAM", "TIER")),
    "explanation_records": """
        select SEGMENT_KEY as SEGMENT, LABEL as CLUSTER, 4 as FEATURES, 'run_fixed' as RUNID
        from labels3 group by 1, 2""",
    "inferred_columns": " union all ".join(f"""
        select '{c}' as FEATURE, true as EXPLAINS, count(*) as TOTAL_ROWS,
               {_r(f"count(*) filter (where {c} is null) / cast(count(*) as double)", "NULL_PCT")}
        from customers""" for c in ("CUSTOMER_ID", "TAM", *FEATS)),
    "cluster_shap_sampled": " union all ".join(_shap(i, f, "explained_20", "background_quarter") for i, f in enumerate(FEATS)),
    "cluster_shap_tables": "select * from (" + " union all ".join(
        _shap(i, f, "explained_tables", "background_tables", ", case when e.SEGMENT_KEY like 'AUTO%' then 'auto_shap' end as TARGET")
        + ", 5" for i, f in enumerate(FEATS)) + ") where TARGET is null or FEATURE in ('RECENCY_DAYS', 'ORDER_FREQUENCY')",
    "cluster_shap_kernel": " union all ".join(
        _shap(i, f, "explained", "background_50", ", " + _r(f"avg({_GAIN.format(i=i)})", "MEAN_SHAP", 4), 4) for i, f in enumerate(FEATS)),
    "cluster_shap_margin": "select SEGMENT_KEY as SEGMENT, LABEL as CLUSTER, true as ADDS_UP from labels3 group by 1, 2",
    "cluster_shap": " union all ".join(f"""
        select e.SEGMENT_KEY as SEGMENT, l.LABEL as CLUSTER, '{f}' as FEATURE,
               {_r(f'avg(abs((z{i} - c{i}) * (z{i} - c{i}) - (q{i} - 2 * c{i} * m{i} + c{i} * c{i})))', 'SHAP', 5)},
               'run_fixed' as RUNID, '20010801_000000' as RUNTIMESTAMP
        from explained e join labels3 l on e.CUSTOMER_ID = l.CUSTOMER_ID
        join background b on b.SEGMENT_KEY = e.SEGMENT_KEY
        join centers c on c.SEGMENT_KEY = e.SEGMENT_KEY and c.K = 3 and c.LABEL = l.LABEL group by 1, 2"""
        for i, f in enumerate(FEATS)),
}


def oracle_sql() -> dict[str, str]:
    return {name: " ".join(_compose(sql).split()) for name, sql in FINAL.items()}
