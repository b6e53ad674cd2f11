"""The registered queries as DuckDB SQL, written independently of the operators.

Each statement starts from the test-table views.  ``_CTES`` holds named pieces;
a query names the last piece it needs and gets everything below it as a WITH
list.  Instants are naive UTC timestamps, money is decimal, ratios are exact
half-up divisions on integers.
"""

from __future__ import annotations

import re

from harborline.sources import seeds


def _values(rows) -> str:
    return ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in row) + ")" for row in rows)


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _names(platform: str) -> str:
    return _list(name for p, name, _ in seeds.CAMPAIGNS if p == platform)


def _ratio(top: str, bottom: str, digits: int = 2, times: int = 1) -> str:
    """round(times * top / bottom, digits) on whole cents, NULL when undefined."""
    n = f"cast(({top}) * 100 as hugeint) * {times}"
    d = f"cast(({bottom}) * 100 as hugeint)"
    unit = "0." + "0" * (digits - 1) + "1"
    return (
        f"case when ({bottom}) is null or ({top}) is null or ({bottom}) = 0 then null else "
        f"cast(case when ({n} < 0) != ({d} < 0) then -1 else 1 end "
        f"* cast((2 * abs({n}) * {10 ** digits} + abs({d})) // (2 * abs({d})) as decimal(28,0)) * {unit} "
        f"as decimal(38,{digits})) end"
    )


_NET = "status in ('paid', 'shipped', 'delivered')"
_GROSS = "status in ('paid', 'shipped', 'delivered', 'refunded')"
_D2 = "decimal(38,2)"


def _offset_text(ts: str, east: str) -> str:
    pattern = "'%Y-%m-%d %H:%M:%S'"
    return (
        f"case when {east} then strftime({ts} + interval 7 hour, {pattern}) || '+07:00' "
        f"else strftime({ts}, {pattern}) || '+00:00' end"
    )


def _instant(text: str) -> str:
    return f"timezone('UTC', try_cast({text} as timestamptz))"


_ORDER_VERSION = """
    select 'O-' || k as order_id,
           case when k % 100 = 7 then 'CX' else 'C' end || cust as customer_id,
           {order_ts} as order_ts, {updated_at} as updated_at, {status} as status,
           case when k % 200 = 3 then null when k % 200 = 5 then '-' || price
                when k % 200 = 9 then 'N/A' else price end as total_amount,
           case k % 3 when 0 then 'web' when 1 then 'Shopee ' else 'lazada' end as channel,
           'orders_' || strftime(cast({event} as date) + cast(k % 100 = 11 as int), '%Y-%m-%d') || '.csv'
               as _source_file
    from order_seed where {where}"""

_REFUND_TS = "ts + to_days(cast(1 + k % 7 as int)) + interval 2 hour"
_CHANGED = "ts + to_seconds(k * 31 % 7200)"

# name -> SQL; a piece may use the views and any other piece
_CTES: dict[str, str] = {
    # ------------------------------------------------ landing rows (see bridge)
    "order_seed": """
    select o_orderkey as k, o_custkey as cust, cast(cast(o_totalprice as decimal(14,2)) as varchar) as price,
           o_orderdate + to_seconds(o_orderkey * 7919 % 86400) as ts,
           case o_orderstatus when 'F' then ' Delivered ' when 'O' then 'shipped'
                else case o_orderpriority when '1-URGENT' then 'pending' when '2-HIGH' then 'cancelled'
                     else 'paid' end end as first_status
    from orders""",
    "raw_orders": " union all ".join([
        _ORDER_VERSION.format(
            order_ts=_offset_text("ts", "k % 2 = 0"), updated_at=_offset_text(_CHANGED, "k % 2 = 0"),
            status="first_status", event="ts", where="true"),
        _ORDER_VERSION.format(
            order_ts=_offset_text("ts", "k % 2 = 1"), updated_at=_offset_text(_CHANGED, "k % 2 = 1"),
            status="first_status", event="ts", where="k % 50 = 13"),
        _ORDER_VERSION.format(
            order_ts=_offset_text("ts", "k % 2 = 0"), updated_at=_offset_text(_REFUND_TS, "k % 2 = 0"),
            status="'refunded'", event=_REFUND_TS, where="k % 33 = 4"),
    ]),
    "raw_items": """
    select 'O-' || l_orderkey as order_id, 'P' || l_partkey as product_id,
           cast(cast(l_quantity as int) as varchar) as qty,
           cast(cast(l_extendedprice as decimal(12,2)) as varchar) as unit_price
    from lineitem""",
    "raw_customers": """
    select 'C' || c_custkey as customer_id,
           'customer' || c_custkey || case when c_custkey % 33 != 5 then '@example.com'
               else ['@@gmail..com', '.gmail.com', '@', ' @hotmail.com'][c_custkey % 4 + 1] end as email,
           strftime(date '1994-01-01' + cast(c_custkey % 365 as int), '%Y-%m-%d') as signup_date,
           r_name as region
    from customer, nation, region where c_nationkey = n_nationkey and n_regionkey = r_regionkey""",
    "payments": """
    select order_id, k, k % 1000 as b, total_amount as amount,
           cast(round(total_amount * 0.029, 2) as decimal(14,2)) as fee,
           order_ts + to_seconds(k * 17 % 1800) as created
    from (select *, cast(substr(order_id, 3) as bigint) as k from current_orders)
    where status in ('paid', 'shipped', 'delivered', 'refunded') and total_amount > 0""",
    "raw_gateway": f"""
    select 'T-' || k as txn_id, 'GW-' || order_id as gateway_ref, cast(amount as varchar) as amount,
           'THB' as currency, cast(fee as varchar) as fee, {_offset_text('created', 'false')} as created_at
    from payments""",
    "raw_ledger": f"""
    select entry.id as entry_id, entry.ref as external_ref,
           cast(case when b between 15 and 34 then amount + (1 + k % 5) * 0.01
                     when b between 35 and 44 then amount - fee
                     when b between 116 and 118 then amount - 100
                     else amount end as decimal(14,2))::varchar as amount,
           case when b between 45 and 47 then ' thb' else 'THB' end as currency,
           {_offset_text('created + to_seconds(60 + k * 13 % 3540)', 'true')} as posted_at
    from (
        select *, unnest(list_filter([
            case when b > 14 then {{'id': 'L-' || k, 'ref':
                case when b between 48 and 97 then order_id
                     when b between 113 and 115 then 'GW-' || order_id[:-2]
                     else 'GW-' || order_id end}} end,
            case when b between 98 and 102 then {{'id': 'LD-' || k, 'ref': 'GW-' || order_id}} end,
            case when b between 103 and 112 then {{'id': 'LX-' || k, 'ref': 'GW-X-' || (k * 7919)}} end
        ], lambda x: x is not null)) as entry
        from payments
    )""",
    "event_days": f"""
    select cast(ts as date) - 9496 as day, ['facebook', 'google', 'tiktok'][user_id % 3 + 1] as platform,
           cast(regexp_extract(props, '([0-9]+)', 1) as bigint) % 8 as campaign,
           sum(cast(value as decimal(12,2))) * 100 as spend,
           100 * count(*) filter (event_type = 'view') as views,
           10 * count(*) filter (event_type = 'click') as clicks,
           count(*) filter (event_type = 'purchase') as purchases
    from events group by all""",
    "raw_ads": f"""
    select strftime(day, '%Y-%m-%d') as report_date, platform,
           cast(null as varchar) as campaign_id, cast(null as varchar) as ad_id,
           case platform when 'facebook' then {_names('facebook')} when 'google' then {_names('google')}
                else {_names('tiktok')} end[campaign + 1] as campaign_name,
           case when platform = 'google' then format('{{:,.2f}}', cast(spend as double))
                else cast(cast(spend as decimal(18,2)) as varchar) end as spend,
           case when platform = 'google' then 'THB' else 'USD' end as currency,
           case when platform = 'facebook' and campaign = 5 and day(day) % 9 = 0 then '0'
                else cast(views as varchar) end as impressions,
           cast(clicks as varchar) as clicks,
           case when platform != 'facebook' and campaign = 3 and day(day) % 7 = 0 then 'N/A'
                else cast(purchases as varchar) end as conversions
    from event_days, range(case when platform = 'google' and day(day) % 10 = 0 then 2 else 1 end)""",
    "raw_utm": f"""
    select 'O-' || k as order_id,
           case when k % 4 = 0 then null when k % 97 = 0 then 'bing' else hit[1] end as utm_source,
           case when k % 4 != 0 then case hit[2] when 'facebook' then {_names('facebook')}
                when 'google' then {_names('google')} else {_names('tiktok')} end[(k // 10) % 8 + 1] end as utm_campaign
    from (select o_orderkey as k,
                 [{", ".join(_list(row) for row in seeds.UTM_SOURCES)}][o_orderkey % 10 + 1] as hit from orders)""",
    "source_seed": f"select * from (values {_values(seeds.UTM_SOURCES)}) v(variant, platform)",
    "campaign_seed": f"select * from (values {_values(seeds.CAMPAIGNS)}) v(platform, campaign_name, canonical)",
    "raw_fx": """
    select distinct day, cast(35.5 + (day(day) % 15) * 0.1 as decimal(10,4)) as usd_thb from event_days""",

    # -------------------------------------------------------------- orders
    "typed_orders": f"""
    select order_id, customer_id, order_ts as order_ts_raw, total_amount as total_amount_raw,
           {_instant('order_ts')} as order_ts, {_instant('updated_at')} as updated_at,
           lower(trim(status)) as status, try_cast(total_amount as decimal(14,2)) as total_amount,
           lower(trim(channel)) as channel, _source_file
    from raw_orders""",
    # the largest struct is the newest version, ties broken by content
    "current_orders": """
    select unnest(max({'updated_at': updated_at, 'order_ts_raw': order_ts_raw,
               'total_amount_raw': coalesce(total_amount_raw, ''), 'status': status, 'customer_id': customer_id,
               'channel': channel, '_source_file': _source_file, 'order_ts': order_ts,
               'total_amount': total_amount, 'amount_text': total_amount_raw})), order_id
    from typed_orders group by order_id""",
    "judged": """
    select *, case when order_id is null then 'missing_order_id'
                   when order_ts is null or updated_at is null then 'unparseable_timestamp'
                   when total_amount is null then 'amount_null_or_invalid'
                   when total_amount < 0 then 'amount_negative' else 'ok' end as verdict
    from current_orders""",
    "good": "select *, cast(timezone('Asia/Bangkok', timezone('UTC', order_ts)) as date) as business_date from judged where verdict = 'ok'",
    "bad": "select * from judged where verdict != 'ok'",
    "items": """
    select order_id, product_id, cast(qty as int) as qty, cast(unit_price as decimal(12,2)) as unit_price
    from raw_items where try_cast(qty as int) > 0 and try_cast(unit_price as decimal(12,2)) >= 0
      and order_id is not null
    group by all""",
    "people": """
    select customer_id, email, signup_date::date as signup_date, region,
           coalesce(regexp_full_match(email, '[^@\\s]+@[^@\\s]+\\.[A-Za-z]{2,}'), false) as email_is_valid
    from raw_customers""",
    "goods": """
    select 'P' || p_partkey as product_id, p_name as name, p_type as category,
           cast(p_retailprice as decimal(12,2)) as cost from part""",
    "versions": f"""
    select order_id, status, updated_at as valid_from from typed_orders
    where order_id is not null and updated_at is not null group by all""",
    "history": """
    select a.*, (select min(b.valid_from) from versions b
                 where b.order_id = a.order_id and (b.valid_from, b.status) > (a.valid_from, a.status)) as valid_to
    from versions a""",
    "per_order": "select order_id, count(*) as n_lines, sum(qty * unit_price) as amount from items group by order_id",
    "enriched": """
    select g.*, coalesce(p.customer_id, 'unknown') as known_customer, p.region,
           coalesce(s.n_lines, 0) as n_lines, coalesce(s.amount, 0) as items_amount
    from good g left join people p using (customer_id) left join per_order s using (order_id)""",
    "lines": """
    select g.order_id, business_date, channel, status, category, i.qty * i.unit_price as line_amount
    from items i, good g, goods p where i.order_id = g.order_id and i.product_id = p.product_id""",
    "f_orders": f"""
    select business_date, channel, cast(sum(case when {_NET} then 1 else 0 end) as bigint) as net_orders,
           cast(sum(case when status = 'refunded' then 1 else 0 end) as bigint) as refunded_orders,
           cast(sum(case when {_NET} then total_amount else 0 end) as {_D2}) as net_amount
    from good group by all""",
    "f_sales": f"""
    select business_date, channel, category,
           cast(sum(case when {_GROSS} then line_amount else 0 end) as {_D2}) as gross_amount,
           cast(sum(case when status = 'refunded' then line_amount else 0 end) as {_D2}) as refund_amount,
           cast(sum(case when {_NET} then line_amount else 0 end) as {_D2}) as net_amount
    from lines group by all""",
    "f_refunds": f"""
    select category, paid_orders, refunded_orders,
           {_ratio('refunded_orders', 'paid_orders', times=100)} as refund_rate_pct, refunded_amount
    from (select category, count(distinct order_id) as paid_orders,
                 count(distinct case when status = 'refunded' then order_id end) as refunded_orders,
                 cast(sum(case when status = 'refunded' then line_amount else 0 end) as {_D2}) as refunded_amount
          from lines where {_GROSS} group by category)""",

    # ------------------------------------------------------ reconciliation
    "gw": f"""
    select txn_id as gid, regexp_replace(upper(trim(gateway_ref)), '^GW-', '') as ref,
           cast(amount as decimal(14,2)) as amount, upper(trim(currency)) as currency,
           cast(fee as decimal(14,2)) as fee, cast({_instant('created_at')} as date) as day
    from raw_gateway""",
    "led": f"""
    select *, row_number() over (partition by ref, amount_text order by lid) as seq
    from (select entry_id as lid, regexp_replace(upper(trim(external_ref)), '^GW-', '') as ref,
                 cast(amount as decimal(14,2)) as amount, amount as amount_text,
                 upper(trim(currency)) as currency, cast({_instant('posted_at')} as date) as day
          from raw_ledger)""",
    "first_postings": "select * from led where seq = 1",
    "pairs_a": """
    select gid, lid, 'exact' as kind from
        (select *, row_number() over (partition by ref, amount, day order by gid) as n from gw)
        join (select *, row_number() over (partition by ref, amount, day order by lid) as n from first_postings)
        using (ref, amount, day, n)""",
    "gw_b": "select * from gw anti join pairs_a using (gid)",
    "led_b": "select * from first_postings anti join pairs_a using (lid)",
    "pairs_b": """
    select gid, lid, 'date_boundary' as kind from
        (select *, row_number() over (partition by ref, amount order by day, gid) as n from gw_b)
        join (select *, row_number() over (partition by ref, amount order by day, lid) as n from led_b)
        using (ref, amount, n)""",
    "gw_c": "select * from gw_b anti join pairs_b using (gid)",
    "led_c": "select * from led_b anti join pairs_b using (lid)",
    "pairs_c": """
    select gid, lid, case when abs(g.amount - l.amount - g.fee) < 0.005 then 'fee_timing'
                          when abs(g.amount - l.amount) <= 0.05 then 'rounding' else 'amount_other' end as kind
    from (select *, row_number() over (partition by ref order by amount nulls last, day, gid) as n from gw_c) g
    join (select *, row_number() over (partition by ref order by amount nulls last, day, lid) as n from led_c) l
        using (ref, n)""",
    "gw_d": "select * from gw_c anti join pairs_c using (gid)",
    "led_d": "select * from led_c anti join pairs_c using (lid)",
    "pairs_d": """
    select gid, lid, 'possible_ref_issue' as kind
    from (select *, row_number() over (partition by amount, day order by gid) as n from gw_d) g
    join (select *, row_number() over (partition by amount, day order by lid) as n from led_d) l
        using (amount, day, n)
    where contains(g.ref, l.ref) or contains(l.ref, g.ref) or levenshtein(g.ref, l.ref) <= 4""",
    "pairs": "select * from pairs_a union all select * from pairs_b union all select * from pairs_c union all select * from pairs_d",
    "placed": """
    select gid, lid, kind from pairs
    union all select gid, null, 'missing_in_ledger' from gw anti join pairs using (gid)
    union all select null, lid, case when seq > 1 then 'duplicate_posting' else 'missing_in_gateway' end
              from led anti join pairs using (lid)""",
    "results": f"""
    select gid as txn_id, lid as entry_id, coalesce(g.ref, l.ref) as ref,
           cast(g.amount as {_D2}) as gateway_amount, cast(l.amount as {_D2}) as ledger_amount,
           cast(coalesce(g.amount, 0) - coalesce(l.amount, 0) as {_D2}) as amount_diff,
           coalesce(g.day, l.day) as txn_date, kind as match_type,
           cast(case when kind = 'date_boundary' then 0.95
                     when kind in ('fee_timing', 'rounding', 'amount_other') then 0.80
                     when kind = 'possible_ref_issue' then 0.50 else 1.00 end as {_D2}) as match_confidence
    from placed left join gw g using (gid) left join led l using (lid)""",
    "summary": f"""
    select txn_date, gateway_count, gateway_amount, coalesce(ledger_count, 0) as ledger_count,
           coalesce(ledger_amount, 0)::{_D2} as ledger_amount, matched, fee_timing, rounding, amount_other,
           possible_ref_issue, missing_in_ledger, missing_in_gateway, duplicate_posting,
           {_ratio('matched + fee_timing + rounding + possible_ref_issue', 'gateway_count', times=100)} as match_rate_pct,
           cast(gateway_amount - coalesce(ledger_amount, 0) as {_D2}) as net_difference
    from (select day as txn_date, count(*) as gateway_count, cast(sum(amount) as {_D2}) as gateway_amount
          from gw group by day)
    left join (select day as txn_date, count(*) as ledger_count, cast(sum(amount) as {_D2}) as ledger_amount
               from led group by day) using (txn_date)
    left join bucket_counts using (txn_date)""",
    "bucket_counts": "select txn_date, " + ", ".join(
        f"cast(sum(cast(match_type in ({names}) as int)) as bigint) as {label}" for label, names in [
            ("matched", "'exact', 'date_boundary'"), ("fee_timing", "'fee_timing'"), ("rounding", "'rounding'"),
            ("amount_other", "'amount_other'"), ("possible_ref_issue", "'possible_ref_issue'"),
            ("missing_in_ledger", "'missing_in_ledger'"), ("missing_in_gateway", "'missing_in_gateway'"),
            ("duplicate_posting", "'duplicate_posting'"),
        ]) + " from results group by txn_date",
    "followups": """
    select * from results where match_type not in ('exact', 'date_boundary', 'fee_timing', 'rounding')""",

    # --------------------------------------------------------- advertising
    "ads": f"""
    select *, cast(case when currency = 'THB' then spend_local else round(spend_local * usd_thb, 2) end as {_D2}) as spend_thb
    from (select cast(report_date as date) as report_date, platform, campaign_id, ad_id,
                 trim(campaign_name) as campaign_name,
                 cast(replace(spend, ',', '') as decimal(14,2)) as spend_local, upper(trim(currency)) as currency,
                 try_cast(impressions as bigint) as impressions, try_cast(clicks as bigint) as clicks,
                 try_cast(conversions as bigint) as conversions,
                 conversions is not null and try_cast(conversions as bigint) is null as conversions_missing
          from raw_ads where campaign_name is not null group by all)
    left join raw_fx on day = report_date""",
    "touches": """
    select distinct order_id, utm_source, utm_campaign,
           case when coalesce(trim(utm_source), '') = '' then 'organic' else s.platform end as platform
    from raw_utm left join source_seed s on s.variant = trim(utm_source)""",
    "mapping": """
    select platform, campaign_name,
           coalesce(canonical, regexp_replace(lower(campaign_name), '[^a-z0-9]', '', 'g')) as canonical,
           canonical is null as is_unmapped
    from (select platform, campaign_name from ads
          union select platform, utm_campaign from touches
          where platform in ('facebook', 'google', 'tiktok') and utm_campaign is not null)
    left join campaign_seed using (platform, campaign_name)""",
    "revenue": f"""
    select business_date, t.platform,
           case when t.platform = 'organic' then 'organic' else m.canonical end as campaign_canonical,
           t.order_id, cast(total_amount as {_D2}) as revenue_thb
    from touches t join good g using (order_id)
    left join mapping m on m.platform = t.platform and m.campaign_name = t.utm_campaign
    where {_NET}""",
    "channels": f"""
    select activity_date, platform, coalesce(spend, 0)::{_D2} as spend_thb,
           coalesce(views, 0) as impressions, coalesce(hits, 0) as clicks, coalesce(conv, 0) as platform_conversions,
           coalesce(n, 0) as attributed_orders, coalesce(income, 0)::{_D2} as attributed_revenue_thb,
           {_ratio('income', 'spend')} as roas, {_ratio('spend', 'hits')} as cpc_thb,
           {_ratio('spend', 'n')} as cpa_thb, {_ratio('hits', 'views', times=100)} as ctr_pct
    from (select report_date as activity_date, platform, sum(spend_thb) as spend, sum(impressions)::bigint as views,
                 sum(clicks)::bigint as hits, coalesce(sum(conversions), 0)::bigint as conv from ads group by all)
    full join (select business_date as activity_date, platform, count(*) as n, sum(revenue_thb) as income
               from revenue group by all) using (activity_date, platform)""",
    "campaigns": f"""
    select canonical, coalesce(np, 0) as n_platforms, coalesce(spend, 0)::{_D2} as spend_thb,
           coalesce(views, 0) as impressions, coalesce(hits, 0) as clicks, coalesce(conv, 0) as platform_conversions,
           coalesce(n, 0) as attributed_orders, coalesce(income, 0)::{_D2} as attributed_revenue_thb,
           {_ratio('income', 'spend')} as roas
    from (select canonical, count(distinct platform) as np, sum(spend_thb) as spend, sum(impressions)::bigint as views,
                 sum(clicks)::bigint as hits, coalesce(sum(conversions), 0)::bigint as conv
          from ads join mapping using (platform, campaign_name) group by canonical)
    full join (select campaign_canonical as canonical, count(*) as n, sum(revenue_thb) as income
               from revenue where campaign_canonical is not null group by all) using (canonical)""",
    "volume": """
    select 'orders' as table_name, cast(_source_file[8:17] as date) as file_date, count(*) as rows
    from raw_orders group by all""",
}

_STAMPS = "order_ts, updated_at"


def _check_rows(table: str, source: str, not_null=(), unique=(), accepted=None) -> list[str]:
    def row(check: str, count: str) -> str:
        return f"select '{table}' as table_name, '{check}' as \"check\", cast(({count}) as bigint) as violations"

    rows = [row(f"not_null:{c}", f"select count(*) from {source} where {x} is null") for c, x in not_null]
    rows += [
        row(f"accepted_values:{c}", f"select count(*) from {source} where {c} not in ({v})")
        for c, v in (accepted or {}).items()
    ]
    rows += [
        row(f"unique:{c}", f"select count(*) from (select {x} from {source} where {x} is not null group by all having count(*) > 1)")
        for c, x in unique
    ]
    return rows


def _same(*names: str) -> list[tuple[str, str]]:
    return [(n, n) for n in names]


_LATE = "(platform = 'tiktok' and day(cast(report_date as date)) = 30)"
_ADS_IN = "'facebook', 'google', 'tiktok'"
_SUITE = " union all ".join(
    _check_rows("stg_orders", "good",
                _same("order_id", "order_ts", "updated_at", "total_amount", "status", "channel"), _same("order_id"),
                {"status": "'pending', 'paid', 'shipped', 'delivered', 'cancelled', 'refunded'",
                 "channel": "'web', 'shopee', 'lazada'"})
    + ["select 'rejected_orders', 'not_null:reject_reason', count(*) from bad where verdict is null",
       "select 'rejected_orders', 'accepted_values:reject_reason', count(*) from bad where verdict not in "
       "('missing_order_id', 'unparseable_timestamp', 'amount_null_or_invalid', 'amount_negative')"]
    + _check_rows("stg_order_items", "items", _same("order_id", "qty", "unit_price"))
    + _check_rows("stg_customers", "people", _same("customer_id"), _same("customer_id"))
    + _check_rows("stg_products", "goods", _same("product_id"), _same("product_id"))
    + _check_rows("stg_ad_performance", "ads", _same("report_date", "platform", "spend_thb", "campaign_name"),
                  (), {"platform": _ADS_IN})
    + _check_rows("stg_utm_touches", "touches", _same("order_id"), _same("order_id"))
    + _check_rows("stg_fx_rates", "raw_fx", [("fx_date", "day"), ("usd_thb", "usd_thb")], [("fx_date", "day")])
    + _check_rows("order_status_history", "versions", _same("order_id", "valid_from"))
    + _check_rows("orders_enriched", "enriched",
                  [*_same("order_id", "business_date"), ("customer_id", "known_customer")], _same("order_id"))
    + _check_rows("daily_sales", "f_sales", _same("business_date", "gross_amount", "net_amount"))
    + _check_rows("daily_orders", "f_orders", _same("business_date", "net_orders"))
    + _check_rows("dim_customers", "(select customer_id from people union all select 'unknown')",
                  _same("customer_id"), _same("customer_id"))
    + _check_rows("dim_products", "goods", _same("product_id"), _same("product_id"))
    + _check_rows("refund_analysis", "f_refunds", _same("category"), _same("category"))
    + _check_rows("channel_performance", "channels", _same("activity_date", "platform", "spend_thb"),
                  (), {"platform": _ADS_IN + ", 'organic'"})
    + _check_rows("campaign_performance", "campaigns", _same("canonical"), _same("canonical"))
)

_INJECTED = """
    select unnest(list_filter([case when k % 50 = 13 then 'duplicate' end, case when k % 33 = 4 then 'late_refund' end,
               case when k % 100 = 11 and k % 200 not in (3, 5, 9) and k % 33 != 4 then 'late_arrival' end,
               case when k % 200 in (3, 5, 9) then 'bad_amount' end,
               case when k % 100 = 7 and k % 200 not in (3, 5, 9) then 'orphan_customer' end], lambda x: x is not null)) as c,
           'O-' || k as id from order_seed
    union all select 'invalid_email', 'C' || c_custkey from customer where c_custkey % 33 = 5"""

_CAUGHT = """
    select 'duplicate' as c, order_id as id from current_orders group by order_id having count(*) = 1
    union all select 'late_refund', h.order_id from versions h join versions f using (order_id)
              where h.status = 'refunded' and f.valid_from < h.valid_from
              and not exists (from versions z where z.order_id = h.order_id and z.valid_from > h.valid_from)
    union all select 'late_arrival', order_id from good where cast(_source_file[8:17] as date) = cast(order_ts as date) + 1
    union all select 'bad_amount', order_id from bad where verdict in ('amount_null_or_invalid', 'amount_negative')
    union all select 'orphan_customer', order_id from enriched where known_customer = 'unknown'
    union all select 'invalid_email', customer_id from people where not email_is_valid"""

_PAY_INJECTED = """
    select case when b <= 14 then 'missing_in_ledger' when b <= 34 then 'rounding' when b <= 44 then 'fee_timing'
                when b between 98 and 102 then 'duplicate_posting' else 'missing_in_gateway' end as c,
           case when b between 103 and 112 then 'X-' || (k * 7919) else order_id end as id
    from payments where b <= 44 or b between 98 and 112"""


def _recall(injected: str, caught: str) -> str:
    return (
        f'select i.c as "case", count(*) as injected, count(h.id) as caught '
        f"from (select distinct * from ({injected})) i left join (select distinct * from ({caught})) h "
        f"on h.c = i.c and h.id = i.id group by i.c"
    )


# query name -> final SELECT over the pieces
_FINAL: dict[str, str] = {
    "stg_orders": f"select order_id, customer_id, {_STAMPS}, status, total_amount::{_D2} as total_amount, channel, _source_file from good",
    "rejected_orders": "select order_id, customer_id, order_ts_raw, amount_text as total_amount_raw, status, channel, _source_file, verdict as reject_reason from bad",
    "stg_order_items": f"select order_id, product_id, qty::bigint as qty, unit_price::{_D2} as unit_price from items",
    "stg_customers": "select customer_id, email, email_is_valid, signup_date, region from people",
    "stg_products": f"select product_id, name, category, cost::{_D2} as cost from goods",
    "money_orders": f"select order_id, order_ts, total_amount::{_D2} as total_amount from current_orders where {_GROSS} and total_amount > 0",
    "money_orders_window": f"select order_id, order_ts, total_amount::{_D2} as total_amount from current_orders where {_GROSS} and total_amount > 0 and order_ts >= timestamp '1996-01-01' and order_ts < timestamp '1999-01-01'",
    "order_status_history": "select order_id, status, valid_from, valid_to, valid_to is null as is_current from history",
    "line_totals": f"select order_id, n_lines, amount::{_D2} as items_amount from per_order",
    "orders_enriched": f"select order_id, {_STAMPS}, status, total_amount::{_D2} as total_amount, channel, business_date, known_customer as customer_id, customer_id as source_customer_id, region, n_lines, items_amount::{_D2} as items_amount from enriched",
    "order_lines": f"select order_id, business_date, channel, status, category, line_amount::{_D2} as line_amount from lines",
    "daily_orders": "select * from f_orders",
    "daily_sales": "select * from f_sales",
    "refund_analysis": "select * from f_refunds",
    "dim_customers": "select customer_id, email, email_is_valid, signup_date, region from people union all select 'unknown', null, false, null, null",
    "dim_products": f"select product_id, name, category, cost::{_D2} as cost from goods",
    "weekday_compare": f"""
        select channel, y as yesterday, w as same_day_last_week, {_ratio('y - w', 'w', 1, 100)} as pct_change
        from (select channel, cast(sum(net_amount) filter (business_date = top.d) as {_D2}) as y,
                     cast(sum(net_amount) filter (business_date = top.d - 7) as {_D2}) as w
              from f_sales, (select max(business_date) as d from f_sales) top group by channel)""",
    "top_categories": f"""
        select category, n as net_revenue, r as refunded, {_ratio('r', 'g', times=100)} as refund_pct_of_gross
        from (select category, sum(net_amount)::{_D2} as n, sum(refund_amount)::{_D2} as r, sum(gross_amount)::{_D2} as g
              from f_sales group by category) order by n desc, category limit 10""",
    "days_to_refund": """
        select cast(v.valid_from as date) - cast(f.since as date) as days_to_refund, count(*) as orders
        from versions v join (select order_id, min(valid_from) as since from versions group by order_id) f using (order_id)
        where v.status = 'refunded' group by all""",
    "regional_revenue": f"select coalesce(region, 'unknown') as region, count(*) as orders, sum(total_amount)::{_D2} as revenue from enriched where {_NET} group by all",
    "quarantine_health": "select verdict as reject_reason, count(*) as rows, min(_source_file) as example_file from bad group by verdict",
    "headline": f"""
        select s.*, o.*, {_ratio('refunded_orders', 'net_orders + refunded_orders', times=100)} as refund_rate_pct
        from (select min(business_date) as first_date, max(business_date) as last_date,
                     sum(net_amount)::{_D2} as net_revenue, sum(gross_amount)::{_D2} as gross_revenue,
                     sum(refund_amount)::{_D2} as refunded_revenue from f_sales) s,
             (select sum(net_orders)::bigint as net_orders, sum(refunded_orders)::bigint as refunded_orders from f_orders) o""",
    "daily_trend": f"""
        select business_date, net_orders, net_amount, refund_amount
        from (select business_date, sum(net_amount)::{_D2} as net_amount, sum(refund_amount)::{_D2} as refund_amount
              from f_sales group by all)
        join (select business_date, sum(net_orders)::bigint as net_orders from f_orders group by all) using (business_date)
        order by business_date""",
    "by_category": f"select category, sum(net_amount)::{_D2} as net_amount from f_sales group by all order by 2 desc, 1",
    "by_channel": f"select channel, sum(net_orders)::bigint as net_orders, sum(net_amount)::{_D2} as net_amount from f_orders group by all order by 3 desc, 1",
    "refund_listing": "select * from f_refunds order by refund_rate_pct desc, category",
    "reject_counts": "select verdict as reject_reason, count(*) as rows from bad group by all order by 2 desc, 1",
    "norm_gateway": f"select gid as txn_id, ref, amount::{_D2} as amount, currency, fee::{_D2} as fee, day as txn_date from gw",
    "norm_ledger": f"select lid as entry_id, ref, amount::{_D2} as amount, currency, day as entry_date, seq as posting_seq from led",
    "recon_results": "select * from results",
    "recon_bucket_counts": "select * from bucket_counts",
    "gateway_daily": f"select day as txn_date, count(*) as gateway_count, sum(amount)::{_D2} as gateway_amount from gw group by all",
    "ledger_daily": f"select day as txn_date, count(*) as ledger_count, sum(amount)::{_D2} as ledger_amount from led group by all",
    "recon_summary": "select * from summary order by txn_date",
    "recon_alerts": """
        select txn_date, 'CRITICAL' as severity, 'match_rate' as rule,
               'match rate ' || match_rate_pct || '% below threshold' as detail from summary where match_rate_pct < 97
        union all select txn_date, 'CRITICAL', 'net_difference',
               'net difference ' || net_difference || ' THB exceeds threshold' from summary where abs(net_difference) > 10000
        union all select txn_date, 'WARNING', 'duplicate_posting',
               duplicate_posting || ' duplicate ledger postings' from summary where duplicate_posting > 0""",
    "recon_followups": "select * from followups order by txn_date, match_type, ref",
    "recon_followup_count": "select count(*) as rows from followups",
    "recon_invariants": """
        select 'assigned_twice' as rule, (select count(*) from (select txn_id from results where txn_id is not null group by 1 having count(*) > 1))
             + (select count(*) from (select entry_id from results where entry_id is not null group by 1 having count(*) > 1)) as violations
        union all select 'matchable_left', count(*) from results g join results l using (ref)
        where g.match_type = 'missing_in_ledger' and l.match_type = 'missing_in_gateway'""",
    "stg_fx_rates": "select day as fx_date, usd_thb::decimal(38,4) as usd_thb from raw_fx",
    "stg_ad_performance": f"select report_date, platform, campaign_id, ad_id, campaign_name, spend_local::{_D2} as spend_local, currency, spend_thb, impressions, clicks, conversions, conversions_missing from ads",
    "stg_utm_touches": "select * from touches",
    "campaign_mapping": "select * from mapping",
    "unmapped": "select 'utm_source' as kind, (select count(*) from touches where platform is null) as unmapped union all select 'campaign', (select count(*) from mapping where is_unmapped)",
    "attributed_revenue": "select * from revenue",
    "channel_performance": "select * from channels",
    "campaign_performance": "select * from campaigns",
    "channel_scoreboard": f"""
        select *, {_ratio('attributed_revenue_thb', 'spend_thb')} as roas
        from (select platform, sum(spend_thb)::{_D2} as spend_thb, sum(attributed_orders)::bigint as attributed_orders,
                     sum(attributed_revenue_thb)::{_D2} as attributed_revenue_thb from channels group by platform)
        order by roas desc nulls last, platform""",
    "blended_roas": f"""
        select *, {_ratio('attributed_revenue_thb', 'spend_thb')} as blended_roas
        from (select sum(spend_thb)::{_D2} as spend_thb, sum(attributed_revenue_thb)::{_D2} as attributed_revenue_thb
              from channels where platform in ({_ADS_IN}))""",
    "campaign_scoreboard": "select canonical, n_platforms, spend_thb, attributed_orders, attributed_revenue_thb, roas from campaigns order by roas desc nulls last, canonical",
    "missing_conversions": "select count(*) as rows from ads where conversions_missing",
    "late_file_gaps": f"""
        select report_date, platform from (select distinct report_date from ads where not {_LATE}), (select unnest([{_ADS_IN}]) as platform)
        except select report_date, platform from ads where not {_LATE}""",
    "dq_suite": _SUITE,
    "dq_relationships": """
        select 'orders_enriched' as table_name, 'relationships:customer_id' as "check", count(*) as violations from enriched
        where known_customer not in (select customer_id from people union all select 'unknown')
        union all select 'stg_order_items', 'relationships:product_id', count(*) from items
        where product_id not in (select product_id from goods)""",
    "dq_refund_money": f"""
        select category, coalesce(e, 0)::{_D2} as in_lines, coalesce(a, 0)::{_D2} as in_fact, (coalesce(e, 0) - coalesce(a, 0))::{_D2} as off_by
        from (select category, sum(line_amount) as e from lines where status = 'refunded' group by all)
        full join (select category, refunded_amount as a from f_refunds) using (category)
        where abs(coalesce(e, 0) - coalesce(a, 0)) > 0.01""",
    "dq_restated_refunds": """
        select count(*) as violations
        from (select business_date, sum(amount) as e from good join per_order using (order_id) where status = 'refunded' group by all)
        full join (select business_date, sum(refund_amount) as a from f_sales group by all) using (business_date)
        where abs(coalesce(e, 0) - coalesce(a, 0)) > 0.01""",
    "dq_net_identity": "select count(*) as violations from f_sales where net_amount + refund_amount != gross_amount",
    "dq_money_by_layer": f"select 'mart' as layer, sum(net_amount)::{_D2} as net_amount from f_sales union all select 'staging', sum(amount)::{_D2} from good join per_order using (order_id) where {_NET}",
    "dq_header_totals": "select count(*) as violations from good join per_order using (order_id) where abs(total_amount - amount) > 0.01",
    "dq_order_grain": f"select 'mart' as layer, sum(net_orders)::bigint as net_orders from f_orders union all select 'staging', count(*) from good where {_NET}",
    "dq_order_accounting": """
        select raw_ids, without_id, ok as clean, no as rejected, ok + no - raw_ids - without_id as violations
        from (select count(distinct order_id) as raw_ids, max(cast(order_id is null as bigint)) as without_id from raw_orders),
             (select count(*) as ok from good), (select count(*) as no from bad)""",
    "dq_spend_by_layer": f"select 'staging' as layer, sum(spend_thb)::{_D2} as spend_thb from ads union all select 'mart', sum(spend_thb)::{_D2} from channels",
    "dq_resends": "select platform, delivered, kept, delivered - kept as collapsed from (select platform, count(*) as delivered from raw_ads group by 1) join (select platform, count(*) as kept from ads group by 1) using (platform)",
    "dq_finite_ratios": "select count(*) as violations from channels where not isfinite(cast(coalesce(roas, 0) + coalesce(cpc_thb, 0) + coalesce(cpa_thb, 0) + coalesce(ctr_pct, 0) as double))",
    "dq_attribution": f"""
        select expected, attributed, organic from (select count(*) as expected from touches join good using (order_id) where {_NET}),
             (select count(*) as attributed, count(*) filter (platform = 'organic') as organic from revenue)""",
    "dq_waterfall": "select 'gateway' as side, (select count(*) from raw_gateway) as received, (select count(txn_id) from results) as placed union all select 'ledger', (select count(*) from raw_ledger), (select count(entry_id) from results)",
    "dq_bucket_sums": "select count(*) as violations from summary where matched + fee_timing + rounding + amount_other + possible_ref_issue + missing_in_ledger != gateway_count",
    "freshness": "select table_name, max(file_date) as latest_file_date from volume group by all",
    "daily_volume": "select * from volume",
    "volume_anomaly": """
        select table_name, file_date, rows, cast((2 * s + n) // (2 * n) as bigint) as trailing_avg
        from (select *, cast(sum(rows) over w as bigint) as s, count(rows) over w as n from volume
              window w as (partition by table_name order by file_date rows between 7 preceding and 1 preceding))
        where n > 0 and 2 * abs(rows * n - s) > s""",
    "late_orders": "select cast(_source_file[8:17] as date) - cast(order_ts as date) as days_late, count(*) as orders from good group by all",
    "recall_orders": _recall(_INJECTED, _CAUGHT),
    "recall_payments": _recall(_PAY_INJECTED, "select match_type as c, ref as id from results"),
}


_MONTH_FILE = "_source_file[1:14] || '-01.csv'"
_AD_COLUMNS = "report_date, platform, campaign_id, ad_id, campaign_name, spend, currency, impressions, clicks, conversions"
_FINAL |= {
    "landed_orders": f"""
        select order_id, customer_id, order_ts, updated_at, status, total_amount, channel, {_MONTH_FILE} as delivered_in
        from raw_orders where not (_source_file[8:14] = '1995-03' and cast(order_id[3:] as bigint) % 2 = 1)""",
    "landed_files": f"""
        select {_MONTH_FILE} as file_name, cast(_source_file[8:14] || '-01' as date) as file_date, 'loaded' as state, count(*) as rows
        from raw_orders where not (_source_file[8:14] = '1995-03' and cast(order_id[3:] as bigint) % 2 = 1) group by all
        union all select {_MONTH_FILE}, date '1995-04-01', 'fields', count(*) filter (cast(order_id[3:] as bigint) % 2 = 1)
        from raw_orders where _source_file[8:14] = '1995-04' group by all
        union all select {_MONTH_FILE}, date '1995-05-01', 'columns', 1 from raw_orders where _source_file[8:14] = '1995-05' group by all""",
    "landed_snapshot": """
        select 'P' || p_partkey as product_id, p_name as name, p_type as category,
               cast(cast(p_retailprice as decimal(14,2)) as varchar) as cost from part""",
    "landed_log": f"""
        select {_MONTH_FILE} as file_name, count(*) as rows, case when _source_file[8:11] = '1996' then 2 else 1 end as commit_no
        from raw_orders group by all""",
    "landed_ads": f"select {_AD_COLUMNS} from raw_ads where not {_LATE}",
    "late_backfill": f"select {_AD_COLUMNS} from raw_ads",
    "files_not_delivered": f"""
        select cast(report_date as date) as file_date, platform
        from (select distinct report_date from raw_ads where platform = 'facebook'), (select unnest([{_ADS_IN}]) as platform)
        except select cast(report_date as date), platform from raw_ads where not {_LATE}""",
    "ids_filter": _FINAL["money_orders"] + " and order_id in (select order_id from raw_utm where utm_source = 'bing')",
    **{new: _FINAL[old] for new, old in {
        "restated_daily_sales": "daily_sales", "restated_refunds": "refund_analysis", "restated_orders_enriched": "orders_enriched",
        "merged_status_history": "order_status_history", "rematched_results": "recon_results",
        "streamed_orders": "stg_orders", "streamed_status_history": "order_status_history", "streamed_daily_sales": "daily_sales",
        "hot_recon_results": "recon_results", "hot_status_history": "order_status_history", "hot_order_lines": "order_lines",
        "hot_attributed_revenue": "attributed_revenue", "followup_csv": "recon_followups",
    }.items()},
}


def _needed(sql: str) -> set[str]:
    return set(re.findall(r"[a-z_]+", sql)) & _CTES.keys()


def _statement(final: str) -> str:
    """Prepend the pieces a SELECT uses, each after the pieces it uses itself."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for below in sorted(_needed(_CTES[name]) - {name}):
            visit(below)
        order.append(name)

    for name in sorted(_needed(final)):
        visit(name)
    if not order:
        return final
    return "with " + ",\n".join(f"{n} as materialized ({_CTES[n]})" for n in order) + "\n" + final


# The columns of the tables that have checksums.
_CHECKED = {
    "stg_orders": "_source_file channel customer_id order_id order_ts status total_amount updated_at",
    "rejected_orders": "_source_file channel customer_id order_id order_ts_raw reject_reason status total_amount_raw",
    "order_status_history": "is_current order_id status valid_from valid_to",
    "orders_enriched": "business_date channel customer_id items_amount n_lines order_id order_ts region source_customer_id status "
                       "total_amount updated_at",
    "daily_sales": "business_date category channel gross_amount net_amount refund_amount",
    "refund_analysis": "category paid_orders refund_rate_pct refunded_amount refunded_orders",
    "dim_customers": "customer_id email email_is_valid region signup_date",
    "dim_products": "category cost name product_id",
    "stg_ad_performance": "ad_id campaign_id campaign_name clicks conversions conversions_missing currency impressions platform report_date "
                          "spend_local spend_thb",
    "channel_performance": "activity_date attributed_orders attributed_revenue_thb clicks cpa_thb cpc_thb ctr_pct impressions platform "
                           "platform_conversions roas spend_thb",
    "campaign_performance": "attributed_orders attributed_revenue_thb canonical clicks impressions n_platforms platform_conversions roas spend_thb",
    "recon_results": "amount_diff entry_id gateway_amount ledger_amount match_confidence match_type ref txn_date txn_id",
}


def _checksum(name: str, columns: str) -> str:
    """Row count and fingerprint of a table, from the text of its columns in alphabetical order."""
    values = ", ".join(f"coalesce(cast({c} as varchar), chr(30))" for c in columns.split())
    digest = f"('0x' || left(md5(concat_ws(chr(31), {values})), 15))::bigint"
    return f"select '{name}' as table_name, count(*) as rows, sum({digest})::decimal(38,0) as fingerprint from ({_FINAL[name]})"


_FINAL["table_checksums"] = " union all ".join(_checksum(*item) for item in _CHECKED.items())


def oracle_sql() -> dict[str, str]:
    return {name: _statement(final) for name, final in _FINAL.items()}
