"""DuckDB statements that say the same as the registered queries.

`STEPS` are intermediate results several statements share; they may use the views and each
other. Every statement starts from the driver's tables.
"""

from __future__ import annotations

from checks.queries import AS_OF, HALF
from checks.views import VIEWS, with_views


def cents(*columns: str) -> str:
    """The columns rounded as in `checks.queries.cents`."""
    return ", ".join(f'floor("{c}" * 100 + {HALF}) / 100 as "{c}"' for c in columns)


Y, Q = "cast(year(interval_date) as int) as year", "cast(quarter(interval_date) as int) as quarter"
TODAY = f"date '{AS_OF}'"
DEALS = 'deal_id, deal_name, product_name, instrument, status, buy_sell, strategy, regionid, "group"'
SUMS = (
    "sum(volume_mwh) volume_mwh, sum(cost_amount) total_cost, sum(income_amount) total_income,"
    " sum(earnings) total_earnings, avg(rrp) twp"
)
MEANS = (
    "avg(volume_mwh) volume_mwh, avg(total_cost) total_cost, avg(total_income) total_income,"
    " avg(total_earnings) total_earnings, avg(twp) twp"
)
TERM_KEYS = "deal_id, product_id, instrument, buy_sell, region_number, start_date, end_date"
TERM_VALUES = ("quantity", "price", "strike", "tolling_fee", "floor", "turndown", "lgc_price", "lgc_percentage")
SETTLED = "deal_id, product_id, instrument_id, interval_date, period_id, region_number"
MONEY = cents("volume_mwh", "buy_income", "sell_income")
OUTLOOK = cents("volume_mwh", "total_cost", "total_income", "total_earnings", "twp")
REPORT = cents(
    "Volume (MWh)", "Fixed Earnings", "VW Fixed Rate", "Floating Earnings", "VW Floating Rate",
    "TW Floating Price", "Total Earnings",
)


def term_values(**given: str) -> str:
    return ", ".join(f"cast({given.get(v, 'null')} as double) {v}" for v in TERM_VALUES)


def trading(ts: str) -> str:
    midnight = f"hour({ts}) = 0 and minute({ts}) = 0"
    return (
        f"case when {midnight} then cast({ts} as date) - 1 else cast({ts} as date) end interval_date,"
        f" cast(case when {midnight} then 288 else floor((hour({ts}) * 60 + minute({ts})) / 5) end as int) period_id"
    )


def readings(column: str, view: str, value: str) -> str:
    return f"""
        select duid, cast(year(interval_date) as int) as year, cast(month(interval_date) as int) month_id,
            cast(day(interval_date) as int) day_id, period_id, {value} {column}
        from (select duid, {value}, {trading('settlementdate')} from {view})
        where duid in (select duid from v_units)"""


def settlement(instrument: str) -> str:
    gen = "select product_id as f_product, interval_date, period_id, generation_mwh from v_generation"
    shape = "select product_id as f_product, interval_date, period_id, volume_factor, strike as shape_strike from v_shapes"
    load = "select product_id as f_product, jurisdiction_id, region_number, interval_date, period_id, load_mwh from v_load"
    base = {
        "ppa_energy": (gen, "generation_mwh * quantity", "greatest(rrp, floor) * $v", "price * $v"),
        "asset_toll_energy": (gen, "generation_mwh * quantity", "rrp * $v", "tolling_fee / 288"),
        "flat_energy_swap": (None, "quantity / 12", "$v * rrp", "$v * price"),
        "flat_energy_cap": (None, "quantity / 12", "greatest(rrp - strike, 0) * $v", "$v * price"),
        "profiled_energy_swap": (shape, "quantity / 12 * volume_factor", "rrp * $v", "$v * price"),
        "profiled_energy_cap": (shape, "quantity / 12 * volume_factor", "greatest(rrp - shape_strike, 0) * $v", "$v * price"),
        "generation_lgc": (gen, "generation_mwh * quantity * lgc_percentage", "$v * market", "$v * lgc_price"),
        "retail_lgc": (load, "load_mwh * lgc_percentage", "$v * market", "$v * lgc_price"),
    }
    source, volume, buy, sell = base[instrument]
    own_region = "" if source == load else ", region_number"
    term = f"""(select deal_id, product_id, instrument_id, start_date, end_date, quantity, price, strike, floor,
        tolling_fee, lgc_price, lgc_percentage{own_region} from v_terms where instrument = '{instrument}') t"""
    inside = "interval_date between start_date and end_date"
    if source is None:
        rows = f"{term} join v_spot using (region_number)"
        where = f"where {inside}"
    elif instrument.endswith("lgc"):
        rows = f"""{term} join ({source}) f on f_product = t.product_id
            join (select interval_date, lgc_price market from v_cert_daily) using (interval_date)"""
        where = f"where {inside}"
    else:
        rows = f"""{term} join ({source}) f on f_product = t.product_id
            join v_spot using (interval_date, period_id, region_number)"""
        where = f"where {inside}"
    buy, sell = buy.replace("$v", "volume_mwh"), sell.replace("$v", "volume_mwh")
    return f"""
        select {SETTLED}, volume_mwh, {buy} buy_income, {sell} sell_income
        from (select *, {volume} volume_mwh from {rows} {where})"""


def retail_energy() -> str:
    return f"""
        select {SETTLED}, sum(load_mwh) volume_mwh, sum(load_mwh * rrp) buy_income, sum(load_mwh * rate) sell_income
        from (select deal_id, product_id, instrument_id, start_date, end_date from v_terms
                where instrument = 'retail_energy') t
            join v_load using (product_id) join v_rates using (product_id, jurisdiction_id, interval_date, period_id)
            join v_spot using (interval_date, period_id, region_number)
        where interval_date between start_date and end_date group by all"""


def calibration(rounds: int = 10) -> dict[str, str]:
    """The scaling rounds, unrolled: each keeps a flag that stops later ones once the path agrees.

    `{base}` is replaced by the path they start from.
    """
    steps = {}
    previous = "{base}"
    for k in range(rounds):
        steps[f"q_{{tag}}m{k}"] = f"""
            select g.*, t.energy_boq - neg - mid gap, (t.energy_boq - neg) / nullif(mid, 0) factor
            from (select year(interval_date) y, quarter(interval_date) q, region_number,
                    avg(least(greatest(rrp, 0), 300)) mid, avg(least(rrp, 0)) neg
                from {previous} group by all) g
            join q_energy_target t on t.y = g.y and t.q = g.q and t.region_number = g.region_number"""
        steps[f"q_{{tag}}d{k}"] = (
            f"select coalesce(avg(abs(gap)) < 0.001, true){f' or (select done from q_{{tag}}d{k - 1})' if k else ''} done"
            f" from q_{{tag}}m{k}"
        )
        steps[f"q_{{tag}}p{k}"] = f"""
            select b.model_id, b.sample_id, b.interval_date, b.period_id, b.region_number,
                case when not done and rrp between 0 and 300 and factor is not null
                    then least(rrp * factor, 300) else rrp end rrp
            from {previous} b cross join q_{{tag}}d{k}
            left join q_{{tag}}m{k} m on y = year(interval_date) and q = quarter(interval_date)
                and m.region_number = b.region_number
            where done or m.y is not null"""
        previous = f"q_{{tag}}p{k}"
    return steps


def calibrated(tag: str, base: str) -> dict[str, str]:
    return {n.format(tag=tag): s.format(tag=tag, base=base) for n, s in calibration().items()}


def spiked(path: str) -> str:
    return f"""
        select model_id, sample_id, interval_date, period_id, region_number,
            case when lift > 0 then greatest(level, 300) + lift else level end rrp
        from (select *, case when left_over > 0 then least(headroom, left_over) else 0 end lift
        from (select *, need - (sum(headroom) over (partition by y, q, region_number
                order by price desc, interval_date, period_id rows unbounded preceding) - headroom) left_over
        from (select *, least(20300 - level, 20000) headroom
        from (select *, rrp price, case when wanted < paid then wanted else wanted - paid end need,
                case when wanted < paid and rrp > 300 then 300 else rrp end as level
        from (select p.*, y, q, coalesce(sum(cap_boq) over w, 0) wanted, coalesce(sum(greatest(rrp, 300) - 300) over w, 0) paid
        from {path} p join q_energy_target t on y = year(interval_date) and q = quarter(interval_date)
            and t.region_number = p.region_number
        window w as (partition by y, q, p.region_number))))))"""


def floored(path: str) -> str:
    return f"""
        select model_id, sample_id, interval_date, period_id, region_number, greatest(rrp, -price) rrp
        from {path} join q_curve on year(interval_date) = year(period_start)"""


def outlook(keys: str, source: str, curve: str | None, where: str = "true") -> str:
    label = f", '{curve}' curve" if curve else ""
    return f"select {keys}, {SUMS}{label} from {source} where {where} group by all"


def sample_mean(source: str, curve: str) -> str:
    return f"""
        select {DEALS}, year, quarter, {MEANS}, '{curve}' curve
        from (select sample_id, {DEALS}, year, quarter, {SUMS} from {source} group by all) group by all"""


def at_rank(source: str, rank: int, curve: str) -> str:
    return outlook(
        f"{DEALS}, year, quarter", source, curve,
        f"(sample_id, year, quarter) in (select (sample_id, year, quarter) from q_ranks where earnings_rank = {rank})",
    )


def scenario(source: str, grain: str = "quarter") -> str:
    return f"select scenario curve, {DEALS}, year, {grain}, {SUMS} from {source} group by all"


OUTLOOK_COLUMNS = f"curve, {DEALS}, year, quarter, volume_mwh, total_cost, total_income, total_earnings, twp"


def stacked(*curves: str) -> str:
    return " union all ".join(f"select {OUTLOOK_COLUMNS} from ({c})" for c in curves)


def reported(source: str, label: str, grain: str, from_year: int) -> str:
    return f"""
        select {label} "Curve Name", year "Year", {grain} "{grain.capitalize()}", deal_id "Deal ID",
            deal_name "Deal Name", product_name "Product Name", instrument "Instrument",
            case when status in ('Approved', 'Confirmed') and deal_id <> 7 then 'Contracted' else 'Hypothetical' end "Status",
            buy_sell "Buy/Sell", strategy "Strategy", regionid "Region ID", "group" "Group", volume_mwh "Volume (MWh)",
            fixed "Fixed Earnings", fixed / nullif(volume_mwh, 0) "VW Fixed Rate", floating "Floating Earnings",
            floating / nullif(volume_mwh, 0) "VW Floating Rate", twp "TW Floating Price", total_earnings "Total Earnings"
        from (select *, case when buy_sell = 'Buy' then total_income else -total_cost end floating,
                case when buy_sell = 'Buy' then -total_cost else total_income end fixed
            from {source} where total_earnings is not null and year >= {from_year})"""


def final_report(source: str, grain: str) -> str:
    plain = (
        f'"Curve Name", "Year", "{grain}", "Deal ID", "Deal Name", "Product Name", "Instrument", "Status", "Buy/Sell",'
        ' "Strategy", "Region ID", "Group"'
    )
    return f"select {plain}, {REPORT} from ({source})"


OVERRIDDEN = """case when deal_id = 3 then income_amount - cost_amount * (64.0 / 90.0)::double
    when deal_id = 5 then -(case when rrp > 300 then rrp - 300 else 0 end) * volume_mwh
    when deal_id = 8 and "group" = 'ppa_lgc' then income_amount else earnings end"""

SETTLE_ORDER = (
    "ppa_energy", "asset_toll_energy", "flat_energy_swap", "flat_energy_cap", "profiled_energy_swap",
    "profiled_energy_cap", "generation_lgc", "retail_lgc",
)

FACTORS = """
    select dealid deal_id, type, fromdate from_date, coalesce(lead(fromdate - 1) over (
        partition by dealid, type order by fromdate), date '9999-12-31') to_date, factor from v_factors_raw"""


def offtake(factors: str) -> str:
    return f"""
    select deal_id, product_id, case when tolling_fee is not null then 'asset_toll_energy' else 'ppa_energy' end instrument,
        buy_sell, region_number, start_date, end_date,
        {term_values(quantity='quantity_factor', price='price', tolling_fee='tolling_fee', floor='floor', turndown='turndown')}
    from (
        select u.deal_id, u.product_id, buy_sell, region_number, price * coalesce(r.factor, 1) price,
            quantity_factor, floor, turndown, m.factor / (datediff('day', m.from_date, m.to_date) + 1) tolling_fee,
            min(interval_date) start_date, max(interval_date) end_date
        from q_horizon join v_units u on interval_date between start_date and end_date
            join q_sides using (product_id, deal_id)
            left join {factors} r on r.deal_id = u.deal_id and r.type = 'R' and interval_date between r.from_date and r.to_date
            left join {factors} m on m.deal_id = u.deal_id and m.type = 'M' and interval_date between m.from_date and m.to_date
        group by all)"""


def wholesale(price: str = "price", factors: str = "") -> str:
    return f"""
    select deal_id, product_id, concat(case when shaped then 'profiled' else 'flat' end, '_energy_',
            case instrument_calculation when 'Swap' then 'swap' else 'cap' end) instrument,
        buy_sell, region_number, start_date, end_date,
        {term_values(quantity='quantity', price='price', strike='strike_price')}
    from (
        select product_id, instrument_calculation, deal_id, buy_sell, r.region_number, quantity, {price}, strike_price,
            min(interval_date) start_date, max(interval_date) end_date
        from q_star join v_region r using (regionid)
            join q_horizon on interval_date between product_start_date and product_end_date
            {factors}
        where instrument_calculation in ('Swap', 'Cap') and product_name not like '%ACCU%' and optionality = 'Firm'
        group by all)
    left join (select distinct product_id, volume_factor is not null shaped from v_shapes) using (product_id)"""


STEPS: dict[str, str] = {
    "q_horizon": f"select * from v_dates where interval_date between {TODAY} and {TODAY} + 1460",
    "q_factors": FACTORS,
    "q_star": """
        select d.id deal_id, d.name deal_name, cast(row_number() over (partition by d.id order by l.transferdate,
                l.line, l.productid, l.l_suppkey, l.quantity, l.price) as int) leg_number,
            p.id product_id, p.name product_name, d.buysell buy_sell, cast(d.dealdate as date) deal_date, d.status,
            p.schedule product_schedule, cast(p.startdate as date) product_start_date,
            cast(p.enddate as date) product_end_date, p.term product_term, d.optionality, d.optioncode option_code,
            d.optiontype option_type, d.optionprice option_price, l.quantity, l.price, l.brokerage,
            p.strike strike_price, n.code regionid, substring(n.code, 1, length(n.code) - 1) region, b.name book,
            s.name strategy, e.name trading_entity, c.name counterparty, br.name broker, cl.name clearer,
            ca.name settlement_calendar, i.name instrument, i.calculation instrument_calculation, m.name market,
            cast(l.transferdate as date) transfer_date, cast(l.paymentdate as date) payment_date
        from v_legs l left join v_deals d on l.dealid = d.id left join v_products p on l.productid = p.id
            left join v_books b on d.bookid = b.id left join v_strategies s on d.strategyid = s.id
            left join v_companies c on d.companyid = c.id left join v_companies e on d.tradingentityid = e.id
            left join v_calendars ca on d.calendarid = ca.id left join v_companies br on d.brokerid = br.id
            left join v_companies cl on d.clearerid = cl.id left join v_sim_instruments i on p.instrumentid = i.id
            left join v_markets m on i.marketid = m.id left join v_nodes n on p.nodeid = n.id
        where b.active = 'Y'""",
    "q_retail_rates": """
        select product_id, from_date, least(next_from - 1, enddate) to_date, jurisdiction_id, day_type, period_id, rate
        from (select *, coalesce(lead(from_date) over (partition by product_id, code, day_type, period_id
                order by from_date), date '9999-12-31') next_from
            from v_rate_profiles_raw where code = 'R' and interval_minutes = 5)
        join (select id, enddate from v_products) on id = product_id
        join (select distinct product_id, jurisdiction_id from v_halfhour join v_jurisdiction using (jurisdiction))
            using (product_id)""",
    "q_day_types": """
        select distinct interval_date, jurisdiction_id, period_id, day_of_week, holiday_name is not null public_holiday,
            case when holiday_name is not null or day_of_week = 7 then 'S' when day_of_week = 6 then '6' else 'W' end day_type
        from v_datetimes cross join v_jurisdiction left join v_holidays using (interval_date, jurisdiction)""",
    "q_cert_rates": """
        select product_id, interval_date, lgc_price, lgc_percentage from v_cert_rates_raw
        qualify row_number() over (partition by product_id, interval_date order by lgc_price, lgc_percentage) = 1""",
    "q_sides": "select product_id, deal_id, case when buy then 'Buy' else 'Sell' end buy_sell, price from v_terms",
    "q_c1": offtake("q_factors"),
    "q_c1_month": offtake("q_month_factors"),
    "q_late_factors": "select * replace (fromdate + 150 as fromdate) from v_factors_raw",
    "q_month_factors": f"""
        select * replace (case when type = 'M' and to_date = date '9999-12-31' then last_day(from_date) else to_date end as to_date)
        from ({FACTORS.replace("v_factors_raw", "q_late_factors")})""",
    "q_c2": f"""
        select deal_id, product_id, 'generation_lgc' instrument, buy_sell, region_number, start_date, end_date,
            {term_values(quantity='quantity_factor', lgc_price='lgc_price', lgc_percentage='lgc_percentage')}
        from (
            select deal_id, product_id, buy_sell, region_number, quantity_factor,
                case when product_id = 7 then 0 else coalesce(lgc_price, 0) end lgc_price,
                coalesce(lgc_percentage, 0) lgc_percentage, min(interval_date) start_date, max(interval_date) end_date
            from q_horizon join q_cert_rates using (interval_date) join v_units using (product_id)
                join q_sides using (product_id, deal_id)
            where interval_date between start_date and end_date group by all)""",
    "q_retail_days": """
        select s.*, r.region_number, interval_date
        from q_horizon join q_star s on interval_date between product_start_date and product_end_date
            join v_region r using (regionid)
        where instrument = 'Retail Customer'""",
    "q_c3": f"""
        select deal_id, product_id, 'retail_energy' instrument, buy_sell, region_number,
            min(interval_date) start_date, max(interval_date) end_date, {term_values()}
        from q_retail_days group by deal_id, product_id, buy_sell, region_number""",
    "q_c4": f"""
        select deal_id, product_id, 'retail_lgc' instrument, buy_sell, region_number, start_date, end_date,
            {term_values(lgc_price='lgc_price', lgc_percentage='lgc_percentage')}
        from (
            select deal_id, product_id, buy_sell, region_number, coalesce(lgc_price, 0) lgc_price,
                coalesce(lgc_percentage, 0) lgc_percentage, min(interval_date) start_date, max(interval_date) end_date
            from q_retail_days join q_cert_rates using (product_id, interval_date) group by all)""",
    "q_c5": wholesale(),
    "q_c5_escalated": wholesale(
        "price * coalesce(f_factor, 1) price",
        "left join q_leg_factors on f_deal = deal_id and interval_date between from_date and to_date",
    ),
    "q_leg_factors": """
        select dealid f_deal, fromdate from_date, coalesce(lead(fromdate - 1) over (
            partition by dealid order by fromdate), date '9999-12-31') to_date, factor f_factor from v_leg_factors_raw""",
    "q_c6": f"""
        select deal_id, product_id, 'asset_toll_energy' instrument, buy_sell, region_number, start_date, end_date,
            {term_values(quantity='1', tolling_fee='toll * capacity * 24')} from v_storage""",
    "q_payout": f"""
        select t.*, days_in_quarter from (
            select cast(year(interval_date) as int) as year, cast(quarter(interval_date) as int) as quarter, regionid,
                avg(rrp) qtd_swap_payout, avg(case when rrp > 300 then rrp - 300 else 0 end) qtd_cap_payout,
                count(distinct interval_date) days_qtd
            from (select regionid, rrp, {trading('settlementdate')} from v_trading)
            where interval_date < {TODAY} and year(interval_date) = year({TODAY}) and quarter(interval_date) = quarter({TODAY})
            group by all) t
        join (select year, quarter, count(distinct interval_date) days_in_quarter from v_dates group by all) using (year, quarter)""",
    "q_futures": f"""
        with pivoted as (
            select node, period, period_start, period_end, avg(case when product = 'Swap' then price end) swap,
                avg(case when product = 'Cap' then price end) cap
            from (select * from v_quotes
                where product in ('Swap', 'Cap') and period_end >= {TODAY} and period like 'Q%' and load = 'Flat'
                qualify row_number() over (partition by product, period, node
                    order by consolidate_date desc, period_start, period_end, price) = 1)
            group by all)
        select concat(node, '1') regionid, period, period_start, period_end, swap, cap, swap - cap energy, swap_boq,
            cap_boq, swap_boq - cap_boq energy_boq
        from (select p.*,
                case when qtd_swap_payout is null then swap else
                    (swap - qtd_swap_payout * days_qtd / days_in_quarter) * days_in_quarter / nullif(days_in_quarter - days_qtd, 0) end swap_boq,
                case when qtd_cap_payout is null then cap else
                    (cap - qtd_cap_payout * days_qtd / days_in_quarter) * days_in_quarter / nullif(days_in_quarter - days_qtd, 0) end cap_boq
            from pivoted p left join q_payout t on t.regionid = concat(node, '1') and t.year = year(period_start)
                and t.quarter = quarter(period_start))""",
    "q_curve": f"""
        select period, period_start, period_end, price from v_quotes
        where product = 'LGC' and not period ilike 'spot' and period_end >= {TODAY}
        qualify row_number() over (partition by product, period order by consolidate_date desc, price) = 1""",
    "q_scada": readings("scadavalue", "v_ticks", "value"),
    "q_availability": readings("availability", "v_availability", "availability"),
    "q_capacity": """
        select region_number, cast(year(interval_date) as int) as year, cast(month(interval_date) as int) month_id,
            cast(day(interval_date) as int) day_id, period_id, 'Solar' fuel, solar_avail_cf regional_capacity_factor
        from v_capacity
        union all
        select region_number, cast(year(interval_date) as int), cast(month(interval_date) as int),
            cast(day(interval_date) as int), period_id, 'Wind', wind_avail_cf from v_capacity""",
    "q_unit_loss": """
        select duid, transmissionlossfactor, distributionlossfactor from v_unit_detail
        where duid in (select duid from v_units)
        qualify row_number() over (partition by duid order by end_date desc) = 1""",
    "q_avg_loss": """
        select product_id, jurisdiction, loss_factor from v_avg_loss
        qualify row_number() over (partition by product_id, jurisdiction order by published_datetime desc, loss_factor desc) = 1""",
    "q_index": """
        select distinct model_id, sample_id, interval_date, cast(month(interval_date) as int) month_id,
            cast(day(interval_date) as int) day_id, period_id, gen_reference_year, demand_reference_year
        from v_path join v_samples using (model_id, sample_id)""",
    "q_traces": """
        select product_id, sample_id, interval_date, period_id, greatest(rrp, -price) rrp
        from v_sims join q_curve on year(interval_date) = year(period_start) join v_storage using (region_number)""",
    "q_storage_rows": """
        select 1 model_id, product_id, sample_id, interval_date, period_id,
            case when mwh < 0 then mwh / coalesce(factor, 1) else mwh * coalesce(factor, 1) end generation_mwh
        from (select *, case when rrp < 50 then -10.0::double else 8.0::double end mwh from q_traces)
            join (select product_id, duid from v_storage) using (product_id)
            left join (select duid loss_duid, start_date, end_date, transmissionlossfactor * distributionlossfactor factor
                from v_unit_detail) on loss_duid = duid and interval_date between start_date and end_date""",
    "q_energy_target": """
        select year(period_start) y, quarter(period_start) q, region_number, energy_boq, cap_boq
        from q_futures join v_region using (regionid)""",
    "q_best": f"""
        select sample_id, year, quarter, mse from (
            select sample_id, year, quarter, avg(power(modelled - energy_boq, 2)) mse
            from (
                select sample_id, region_number, {Y}, {Q},
                    avg(case when rrp < -price then -price when rrp > 300 then 300 else rrp end) modelled
                from v_sims join q_curve on interval_date between period_start and period_end
                where interval_date >= {TODAY} group by all) m
            join q_energy_target t on t.y = m.year and t.q = m.quarter and t.region_number = m.region_number
            group by all)
        qualify row_number() over (partition by year, quarter order by mse nulls first, sample_id) = 1""",
    "q_best_path": f"""
        select * from v_sims where interval_date >= {TODAY}
            and (sample_id, year(interval_date), quarter(interval_date)) in (select (sample_id, year, quarter) from q_best)""",
    "q_path_ahead": f"select * from v_path where interval_date >= {TODAY}",
    "q_spiked": spiked("q_path_ahead"),
    "q_best_spiked": spiked("q_best_path"),
    "q_best_floored": floored("q_best_spiked"),
    **calibrated("e", "q_path_ahead"),
    **calibrated("s", "q_best_floored"),
    "q_metered": """
        select product_id, interval_date, period_id,
            case when turndown is not null and rrp < turndown then 0 else generation_mwh end generation_mwh
        from v_generation left join (select product_id, region_number, start_date, end_date, turndown from v_terms
            where turndown is not null) using (product_id) left join v_spot using (interval_date, period_id, region_number)
        where turndown is null or interval_date between start_date and end_date""",
    **{f"q_{name}": settlement(name) for name in SETTLE_ORDER},
    **{
        f"q_metered_{name}": settlement(name).replace("v_generation", "q_metered")
        for name in ("ppa_energy", "asset_toll_energy", "generation_lgc")
    },
    "q_retail_energy": retail_energy(),
    "q_book": " union all ".join(
        f"select * from {n}"
        for n in (
            "q_metered_ppa_energy", "q_metered_asset_toll_energy", "q_metered_generation_lgc", "q_retail_energy",
            "q_retail_lgc", "q_flat_energy_swap", "q_flat_energy_cap", "q_profiled_energy_swap", "q_profiled_energy_cap",
        )
    ),
    "q_oriented": """
        select deal_id, product_id, instrument_id, region_number, buy, interval_date, period_id, volume_mwh,
            case when buy then buy_income else sell_income end income,
            case when buy then sell_income else buy_income end as cost
        from q_book join (select distinct deal_id, product_id, buy from v_terms) using (deal_id, product_id)""",
    "q_outlook": f"""
        select o.*, cast(year(interval_date) as int) as year, cast(quarter(interval_date) as int) as quarter,
            cast(month(interval_date) as int) as month, instrument
        from v_outlook o left join (select distinct product_id, instrument from v_product_instrument) using (product_id)""",
    "q_ranks": f"""
        select *, cast(row_number() over (partition by year, quarter order by earnings, sample_id) as int) earnings_rank
        from (select sample_id, {Q}, {Y}, sum(earnings) earnings from v_outlook
            where status in ('Approved', 'Confirmed') group by all)""",
    "q_clean": f"""
        select * replace ({OVERRIDDEN} as earnings) from q_outlook
        where status in ('Approved', 'Confirmed', 'Pending', 'Hypothetical')
            and interval_date between date '1996-01-01' and date '2000-12-31' and deal_id not in (2, 9)
            and not ("group" = 'BESS' and quarter = 2 and year = 1998)""",
    "q_combined": stacked(
        outlook(f"{DEALS}, year, quarter", "q_outlook", "hindcast"), sample_mean("q_outlook", "model"),
        at_rank("q_outlook", 2, "model_p90"), scenario("q_outlook"),
    ),
    "q_names": """
        select * from (values ('hindcast', 'Hindcast'), ('model', 'Model (Mean)'), ('model_p90', 'Model (P90)'),
            ('Central', 'Scenario Central')) n(curve, curve_name)""",
    "q_flat_quarters": """
        select product_id, deal_id, instrument_id, region_number, buy, cast(year(interval_date) as int) calendar_year,
            cast(quarter(interval_date) as int) calendar_quarter, sum(volume_mwh) volume_mwh, sum(income) income,
            sum(cost) as cost
        from (select deal_id, product_id, instrument_id, region_number, buy, interval_date, volume_mwh,
                case when buy then buy_income else sell_income end income,
                case when buy then sell_income else buy_income end as cost
            from q_flat_energy_swap join (select distinct deal_id, product_id, buy from v_terms) using (deal_id, product_id))
        group by all""",
}


def check(table: str, name: str, required: str, key: str, parents: dict[str, tuple[str, str]]) -> list[str]:
    rows = [
        f"select '{name}' table_name, 'not_null' rule, '{c}' columns, count(*) filter ({c} is null) violations from {table}"
        for c in required.split()
    ]
    rows.append(
        f"select '{name}', 'unique', '{key}', count(*) from (select {key} from {table} group by {key} having count(*) > 1)"
    )
    for label, (columns, parent) in parents.items():
        rows.append(
            f"select '{name}', 'reference', '{columns}->{label}', count(*)"
            f" from {table} anti join (select distinct {columns} from {parent}) using ({columns})"
        )
    return rows


def terms(source: str) -> str:
    return f"select {TERM_KEYS}, {cents(*TERM_VALUES)} from {source}"


STATEMENTS: dict[str, str] = {
    "k1_check_contract": " union all ".join(
        check(
            "v_sims", "scenario_prices", "model_id sample_id interval_date period_id region_number rrp",
            "interval_date,period_id,region_number",
            {"models": ("model_id", "v_models"), "sample_details": ("model_id,sample_id", "v_samples"),
             "regions": ("region_number", "v_region")},
        )
        + check(
            "v_terms", "settlement_terms", "deal_id product_id instrument buy region_number start_date end_date",
            "deal_id,product_id,instrument,region_number,start_date", {"regions": ("region_number", "v_region")},
        )
        + check(
            "v_cert_rates_raw", "certificate_rates", "product_id interval_date lgc_price", "product_id,interval_date",
            {"products": ("product_id", "v_product_instrument")},
        )
    ),
    "k2_instrument_dim": "select deal_id, product_id, instrument_id, instrument from v_terms",
    "k3_read_generation_contracts": """
        select deal_id, product_id, concat('Energy ', duid) as name, duid, fuel, floor, turndown, size_mw, 'Q8' rez,
            regionid, region_number, start_date, end_date, quantity_factor from v_units""",
    "k4_read_storage_contracts": """
        select deal_id, product_id, concat('Storage ', duid) as name, duid, buy_sell, regionid, region_number, start_date,
            end_date, capacity, duration, rte, toll from v_storage""",
    "k5_write_snapshot": f"select product_id, interval_date, period_id, {cents('generation_mwh')} from v_generation",
    "k6_replace_slice": f"""
        select product_id, deal_id, instrument_id, region_number, buy, calendar_year, calendar_quarter,
            {cents('volume_mwh', 'income', 'cost')}, run_date
        from q_flat_quarters cross join (values ({TODAY}), (date '1998-05-21')) r(run_date)""",
    "k6_replace_named_slices": """
        select * from (
            with r as (
                select case when product_id % 5 = 0 then null else concat('a:b/c=', cast(product_id as string), ' %') end product_name,
                    buy, deal_id, quantity from v_terms),
            late as (select * from r where deal_id % 3 = 0 and product_name <> 'a:b/c=4 %'),
            gone as (
                select distinct product_name, buy from late
                union all select * from (values (cast(null as string), true), ('a:b/c=4 %', true)) g(product_name, buy))
            select * from late
            union all
            select * from r where not exists (
                select 1 from gone g where g.product_name is not distinct from r.product_name and g.buy = r.buy))""",
    "k7_write_report_csv": final_report(
        reported("q_combined join q_names using (curve)", "curve_name", "quarter", 1995), "Quarter"
    ),
    "t1_to_trading_interval": f"""
        select duid, {trading('settlementdate')}, value from v_ticks
        union all select regionid, {trading('settlementdate')}, rrp from v_trading""",
    "t2_day_type_calendar": "select * from q_day_types",
    "t3_effective_ranges": """
        select dealid, type, fromdate, factor, coalesce(lead(fromdate - 1) over (
            partition by dealid, type order by fromdate), date '9999-12-31') to_date from v_factors_raw""",
    "t4_compact_ranges": """
        select product_id, fuel, region_number, min(interval_date) start_date, max(interval_date) end_date
        from v_units join v_dates on interval_date between start_date and end_date
        group by product_id, fuel, region_number""",
    "t4_split_ranges": """
        select product_id, lgc_price, min(interval_date) start_date, max(interval_date) end_date
        from (
            select *, sum(starts) over (partition by product_id, lgc_price order by interval_date) island
            from (
                select *, case when lag(interval_date) over (partition by product_id, lgc_price order by interval_date)
                    = interval_date - 1 then 0 else 1 end starts
                from (select distinct product_id, lgc_price, interval_date from v_cert_rates_raw)))
        group by product_id, lgc_price, island""",
    "t5_expand_to_dates": """
        select deal_id, product_id, start_date, end_date, interval_date
        from v_units join v_dates on interval_date between start_date and end_date""",
    "t6_horizon_filter": "select * from q_horizon",
    "d1_trade_star": "select * from q_star",
    "d2_deal_factors": "select * from q_factors",
    "d3_retail_rates": "select * from q_retail_rates",
    "d4_rate_calendar": """
        select product_id, jurisdiction_id, interval_date, period_id, rate
        from q_day_types join q_retail_rates using (jurisdiction_id, period_id, day_type)
        where interval_date between from_date and to_date
            and interval_date between date '1996-01-01' and date '2001-12-31'""",
    "d5_shaped_product_profiles": """
        select * from v_shapes where product_id not in (select id from v_products where schedule in ('Flat', 'Base'))""",
    "d6_certificate_rates": "select * from q_cert_rates",
    "d7_region_lookup": "select regionid, rrp, region_number from v_trading join v_region using (regionid)",
    "d7_jurisdiction_lookup": f"""
        select jurisdiction_id, product_id, interval_date, period_id, {cents('load_mwh')}, jurisdiction, j.region_number
        from v_load l join v_jurisdiction j using (jurisdiction_id)""",
    "c1_ppa_energy_terms": terms("q_c1"),
    "c1_month_end_tolls": terms("q_c1_month"),
    "c2_ppa_certificate_terms": terms("q_c2"),
    "c3_retail_energy_terms": terms("q_c3"),
    "c4_retail_certificate_terms": terms("q_c4"),
    "c5_wholesale_terms": terms("q_c5"),
    "c5_escalated_terms": terms("q_c5_escalated"),
    "c6_storage_terms": terms("q_c6"),
    "c7_settlement_terms": f"""
        select deal_id, product_id, instrument, coalesce(buy_sell = 'Buy', false) buy, region_number, start_date, end_date,
            {cents(*TERM_VALUES)}
        from (select * from q_c1 union all select * from q_c2 union all select * from q_c3 union all select * from q_c4
            union all select * from q_c5 union all select * from q_c6)""",
    "m1_latest_quotes": """
        select * from v_quotes qualify row_number() over (partition by product, period, node
            order by consolidate_date desc, period_start, period_end, price) = 1""",
    "m2_quarter_to_date_payout": f"""
        select year, quarter, regionid, {cents('qtd_swap_payout', 'qtd_cap_payout')}, days_qtd, days_in_quarter from q_payout""",
    "m3_quarterly_futures": f"""
        select regionid, period, period_start, period_end,
            {cents('swap', 'cap', 'energy', 'swap_boq', 'cap_boq', 'energy_boq')} from q_futures""",
    "m4_certificate_curve": "select * from q_curve",
    "m5_certificate_daily": """
        select interval_date, price lgc_price from q_curve join v_dates on interval_date between period_start and period_end""",
    "p1_simulations_for": "select s.* from v_sims s join v_models using (model_id) where model_name = 'base'",
    "p2_resolve_model": """
        select model_id, sample_id, count(*) intervals from v_sims join v_models using (model_id)
        where model_name = 'base' group by all""",
    "p3_sample_details": """
        select model_id, sample_id, demand_reference_year, gen_reference_year, scheduled_avail_reference_year
        from v_samples join v_models using (model_id) where model_name = 'base'""",
    "p4_regional_capacity_long": "select * from q_capacity",
    "p5_unit_actuals": "select * from q_scada",
    "p5_unit_availability": "select * from q_availability",
    "p6_latest_loss_factors": "select * from q_unit_loss",
    "p6_average_loss_factors": "select * from q_avg_loss",
    "p7_generation_profiles": f"""
        select 1 model_id, product_id, year, month_id, day_id, period_id, {cents('generation_mwh')}
        from (
            select product_id, year, month_id, day_id, period_id,
                coalesce(availability, scadavalue, regional_capacity_factor * size_mw) / 12
                    * coalesce(transmissionlossfactor, 1) * coalesce(distributionlossfactor, 1) generation_mwh
            from v_clock cross join v_units
            left join (select duid, year, month_id, day_id, period_id, max(scadavalue) scadavalue from q_scada group by all)
                using (duid, year, month_id, day_id, period_id)
            left join (select duid, year, month_id, day_id, period_id, max(availability) availability from q_availability group by all)
                using (duid, year, month_id, day_id, period_id)
            left join q_capacity using (region_number, year, month_id, day_id, period_id, fuel)
            left join q_unit_loss using (duid)
            where year in (select gen_reference_year + 27 from v_samples))
        where generation_mwh is not null""",
    "p8_load_profiles": f"""
        select model_id, product_id, jurisdiction_id, year, month_id, day_id, period_id,
            floor(quantity * 2 / 1000 * coalesce(loss_factor, 1) / 12 * 1000000 + {HALF}) / 1000000 load_mwh
        from (select distinct model_id, demand_reference_year as year from v_samples)
            join v_datetimes using (year)
            join (select distinct product_id, jurisdiction, interval_date from v_halfhour) i using (interval_date)
            join (select product_id, jurisdiction, interval_date, period_id period_30min, quantity from v_halfhour)
                using (product_id, jurisdiction, interval_date, period_30min)
            left join q_avg_loss using (product_id, jurisdiction)
            join (select jurisdiction, jurisdiction_id from v_jurisdiction) using (jurisdiction)""",
    "p9_sample_index": """
        select model_id, sample_id, interval_date, month_id, day_id, period_id, gen_reference_year from q_index""",
    "p10_scenario_generation": f"""
        select product_id, interval_date, period_id, {cents('generation_mwh')} from (
            select product_id, interval_date, period_id, generation_mwh
            from (select * rename (year as gen_reference_year) from v_gen_profile)
                join q_index using (model_id, gen_reference_year, month_id, day_id, period_id)
            union all
            select product_id, interval_date, period_id, generation_mwh
            from q_storage_rows join q_index using (model_id, sample_id, interval_date, period_id))""",
    "p11_scenario_load": f"""
        select product_id, jurisdiction_id, region_number, interval_date, period_id, {cents('load_mwh')}
        from (select * rename (year as demand_reference_year) from v_load_profile)
            join q_index using (model_id, demand_reference_year, month_id, day_id, period_id)
            join v_jurisdiction using (jurisdiction_id)""",
    "p12_scenario_shapes": """
        select product_id, interval_date, period_id, volume_factor, cast(1 as double) price_factor, strike from v_shapes
        where product_id in (select product_id from v_terms where instrument in ('profiled_energy_swap', 'profiled_energy_cap'))
            and interval_date in (select interval_date from v_path)""",
    "p13_storage_price_traces": f"select product_id, sample_id, interval_date, period_id, {cents('rrp')} from q_traces",
    "p15_storage_profiles": f"""
        select model_id, product_id, sample_id, interval_date, period_id, {cents('generation_mwh')} from q_storage_rows""",
    "a1_best_samples": f"select sample_id, year, quarter, {cents('mse')} from q_best",
    "a2_select_best_path": f"select model_id, sample_id, interval_date, period_id, region_number, {cents('rrp')} from q_best_path",
    "a3_add_cap_spikes": f"select model_id, sample_id, interval_date, period_id, region_number, {cents('rrp')} from q_spiked",
    "a4_apply_certificate_floor": f"""
        select model_id, sample_id, interval_date, period_id, region_number, {cents('rrp')} from ({floored('q_path_ahead')})""",
    "a5_apply_energy_adjustment": f"select model_id, sample_id, interval_date, period_id, region_number, {cents('rrp')} from q_ep9",
    "a6_scenario_prices": f"select model_id, sample_id, interval_date, period_id, region_number, {cents('rrp')} from q_sp9",
    **{
        key: f"select {SETTLED}, {MONEY} from q_{key.split('_', 1)[1]}"
        for key in (
            "e1_ppa_energy", "e2_asset_toll_energy", "e3_retail_energy", "e4_flat_energy_swap", "e5_flat_energy_cap",
            "e6_profiled_energy_swap", "e7_profiled_energy_cap", "e8_generation_lgc", "e9_retail_lgc",
        )
    },
    "e10_apply_turndown": f"select product_id, interval_date, period_id, {cents('generation_mwh')} from q_metered",
    "e11_orient": f"""
        select deal_id, product_id, instrument_id, region_number, buy, interval_date, period_id,
            {cents('volume_mwh', 'income', 'cost')}
        from (select *, case when buy then buy_income else sell_income end income,
                case when buy then sell_income else buy_income end as cost
            from (select * from q_flat_energy_swap union all select * from q_flat_energy_cap)
                join (select distinct deal_id, product_id, buy from v_terms) using (deal_id, product_id))""",
    "e12_settle_book": f"""
        select deal_id, product_id, instrument_id, region_number, buy, interval_date, period_id,
            {cents('volume_mwh', 'income', 'cost')} from q_oriented""",
    "r1_quarterly_earnings": f"""
        select {TODAY} run_date, product_id, deal_id, instrument_id, region_number, buy, calendar_year, calendar_quarter,
            {cents('volume_mwh', 'income', 'cost')}
        from (select product_id, deal_id, instrument_id, region_number, buy, cast(year(interval_date) as int) calendar_year,
                cast(quarter(interval_date) as int) calendar_quarter, sum(volume_mwh) volume_mwh, sum(income) income,
                sum(cost) as cost
            from q_oriented group by all)""",
    "r1_changed_contracts": f"""
        select *, deal_id % 10 = 0 or deal_id % 7 = 0 settled_again from (
        select {TODAY} run_date, product_id, deal_id, instrument_id, region_number, buy, calendar_year, calendar_quarter,
            {cents('volume_mwh', 'income', 'cost')}
        from (select product_id, deal_id, instrument_id, region_number, buy, cast(year(interval_date) as int) calendar_year,
                cast(quarter(interval_date) as int) calendar_quarter, sum(volume_mwh) volume_mwh, sum(income) income,
                sum(cost) as cost
            from q_oriented group by all))""",
    "r2_filter_status": "select * from v_outlook where status in ('Approved', 'Confirmed', 'Pending', 'Hypothetical')",
    "r3_exclude_deals": "select * from v_outlook where deal_id not in (2, 9)",
    "r4_exclude_group_quarter": f"""
        select *, {Y}, {Q} from v_outlook
        where not ("group" = 'BESS' and quarter(interval_date) = 2 and year(interval_date) = 1998)""",
    "r5_override_earnings": f"""
        select * replace (floor(earnings * 100 + {HALF}) / 100 as earnings)
        from (select * replace ({OVERRIDDEN} as earnings) from v_outlook)""",
    "r6_outlook_simple": f"""
        select {DEALS}, year, quarter, {OUTLOOK}, curve from ({outlook(f'{DEALS}, year, quarter', 'q_outlook', 'hindcast')})""",
    "r7_outlook_sample_mean": f"select {DEALS}, year, quarter, {OUTLOOK}, curve from ({sample_mean('q_outlook', 'model')})",
    "r8_outlook_by_scenario": f"select curve, {DEALS}, year, quarter, {OUTLOOK} from ({scenario('q_outlook')})",
    "r8_outlook_by_scenario_month": f"select curve, {DEALS}, year, month, {OUTLOOK} from ({scenario('q_outlook', 'month')})",
    "r9_sample_rank": f"select sample_id, year, quarter, {cents('earnings')}, earnings_rank from q_ranks",
    "r10_outlook_at_rank": f"""
        select {DEALS}, year, quarter, {OUTLOOK}, curve
        from ({at_rank('q_outlook', 54, 'p90')} union all {at_rank('q_outlook', 7, 'p10')})""",
    "r11_product_instrument": """
        select o.*, instrument from v_outlook o
            left join (select distinct product_id, instrument from v_product_instrument) using (product_id)""",
    "r12_clean_and_aggregate": f"select {DEALS}, year, quarter, {OUTLOOK}, curve from (" + stacked(
        outlook(f"{DEALS}, year, quarter", "q_clean", "simple"), sample_mean("q_clean", "mean"),
        at_rank("q_clean", 7, "ranked"), scenario("q_clean"),
    ) + ")",
    "r13_combine_curves": f"select {DEALS}, year, quarter, {OUTLOOK}, curve from q_combined",
    "r14_outlook_report": final_report(
        reported("q_combined join q_names using (curve)", "curve_name", "quarter", 1996), "Quarter"
    ),
    "r15_monthly_report": final_report(
        reported(f"({scenario('q_outlook', 'month')}) where curve = 'Central' and true", "curve", "month", 1996)
        .replace("and true where", "and"), "Month"
    ),
}


def oracle_statements() -> dict[str, str]:
    registry = {**VIEWS, **STEPS}
    return {name: with_views(statement, registry) for name, statement in STATEMENTS.items()}
