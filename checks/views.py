"""Test inputs: every input table of the engine, derived in SQL from the driver's tables.

The same text runs in Spark SQL and in DuckDB, so a registered query and its oracle start
from identical rows. The grid of the derived tables has 4 periods a day, which makes the
sparse source tables meet in joins; `ticks` and `capacity` are on the real 5-minute grid.
No view cuts its source: rows that shall find no match differ by value, so work grows with the
given tables. Ids are grouped by division (`l_suppkey / 4` is a product of four suppliers), so ten
times the source has ten times the products and units; only ids of small lists in a real book
(regions, samples, calendars) are remainders.
"""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from wattledger.functions.plans import fits

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)

AS_OF = "1998-05-20"

SUPPLIERS = 500_000

VIEWS: dict[str, str] = {
    "v_region": """
        select cast(r_regionkey + 1 as int) region_number, concat(r_name, '1') regionid, r_name node
        from region""",
    "v_jurisdiction": """
        select n_nationkey jurisdiction_id, n_name jurisdiction, cast(n_regionkey + 1 as int) region_number
        from nation""",
    "v_dates": """
        select distinct cast(l_shipdate as date) interval_date, cast(year(l_shipdate) as int) as year,
            cast(quarter(l_shipdate) as int) as quarter, cast(month(l_shipdate) as int) month_id,
            cast(day(l_shipdate) as int) day_id, cast(day(l_shipdate) % 7 + 1 as int) day_of_week
        from lineitem""",
    "v_datetimes": """
        select distinct cast(l_shipdate as date) interval_date, cast(year(l_shipdate) as int) as year,
            cast(quarter(l_shipdate) as int) as quarter, cast(month(l_shipdate) as int) month_id,
            cast(day(l_shipdate) as int) day_id, cast(day(l_shipdate) % 7 + 1 as int) day_of_week,
            cast(l_orderkey % 4 + 1 as int) period_id, cast(floor((l_orderkey % 4) / 2) + 1 as int) period_30min
        from lineitem""",
    "v_holidays": """
        select interval_date, jurisdiction, 'Holiday' holiday_name
        from v_dates join v_jurisdiction on day_id = jurisdiction_id + 1""",
    "v_models": "select * from (values (1, 'base'), (2, 'unused')) m(model_id, model_name)",
    "v_sims": """
        select cast(length(o_orderstatus) as int) model_id, cast(o_custkey % 6 as int) sample_id, cast(o_orderdate as date) interval_date,
            cast(o_orderkey % 4 + 1 as int) period_id, cast(n_regionkey + 1 as int) region_number,
            min(o_totalprice) / 500.0 - 50 rrp
        from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
        group by all""",
    "v_samples": """
        select distinct model_id, sample_id, 1995 + sample_id % 3 gen_reference_year,
            1996 + sample_id % 2 demand_reference_year, 1995 scheduled_avail_reference_year
        from v_sims""",
    "v_path": """
        select s.* from v_sims s join (
            select year(interval_date) y, quarter(interval_date) q, max_by(sample_id, rrp) chosen
            from v_sims group by year(interval_date), quarter(interval_date)) c
        on year(interval_date) = y and quarter(interval_date) = q and sample_id = chosen""",
    "v_spot": """
        select interval_date, period_id, region_number, min(rrp) rrp from v_sims group by all""",
    "v_ticks": """
        select concat('U', cast(cast(floor(user_id / 3) as int) as string)) duid, ts settlementdate, value from events""",
    "v_availability": """
        select case when value > 250 then duid else concat('X', duid) end duid, settlementdate, value availability
        from v_ticks""",
    "v_quotes": """
        select case when o_orderkey % 2 = 0 then 'Swap' else 'Cap' end product, r_name node,
            concat('Q', cast(quarter(o_orderdate) as string), '-', cast(year(o_orderdate) as string)) period,
            cast(date_trunc('quarter', o_orderdate) as date) period_start,
            cast(date_trunc('quarter', o_orderdate) + interval '3' month - interval '1' day as date) period_end,
            'Flat' as load, date '1998-01-01' + cast(o_orderkey % 5 as int) consolidate_date,
            min(case when o_orderkey % 2 = 0 then o_totalprice / 2500 else o_totalprice / 25000 end) price
        from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
            join region on n_regionkey = r_regionkey
        group by all
        union all
        select distinct 'LGC', 'ALL', concat('Cal-', cast(year(o_orderdate) as string)),
            make_date(year(o_orderdate), 1, 1), make_date(year(o_orderdate), 12, 31), 'Flat',
            date '1998-01-01' + cast(o_orderkey % 2 as int), cast(20 + year(o_orderdate) % 5 + o_orderkey % 2 as double)
        from orders
        union all
        select distinct 'LGC', 'ALL', 'Spot', date '1998-01-01', date '2001-12-31', 'Flat', date '1998-01-01',
            cast(19 as double)
        from orders""",
    "v_cert_daily": """
        select interval_date, cast(20 + year % 5 + 1 as double) lgc_price from v_dates""",
    "v_instruments": """
        select * from (values (0, 'flat_energy_swap'), (1, 'flat_energy_cap'), (2, 'profiled_energy_swap'),
            (3, 'profiled_energy_cap'), (4, 'ppa_energy'), (5, 'asset_toll_energy'), (6, 'generation_lgc'),
            (7, 'retail_energy'), (8, 'retail_lgc')) i(instrument_id, instrument)""",
    "v_terms": """
        select cast(s_suppkey as int) deal_id, cast(floor(s_suppkey / 4) as int) product_id, instrument, instrument_id,
            (s_suppkey % 2 = 0) buy, cast(n_regionkey + 1 as int) region_number,
            date '1995-01-01' + cast((s_suppkey % 12) * 91 as int) start_date,
            date '1995-01-01' + cast((s_suppkey % 12) * 91 + 700 as int) end_date,
            cast(1 + s_suppkey % 50 as double) quantity, 40 + s_acctbal / 200 price, cast(300 as double) strike,
            cast(1000 + s_suppkey as double) tolling_fee,
            case when s_suppkey % 3 = 0 then cast(0 as double) end floor,
            case when s_suppkey % 5 = 4 then cast(100 as double) end turndown,
            cast(30 as double) lgc_price, cast(0.2 as double) lgc_percentage
        from supplier join nation on s_nationkey = n_nationkey
            join v_instruments on instrument_id = s_suppkey % 9""",
    "v_generation": """
        select cast(floor(l_suppkey / 4) as int) product_id, cast(l_shipdate as date) interval_date,
            cast(l_orderkey % 4 + 1 as int) period_id, sum(l_quantity) / 12 generation_mwh
        from lineitem group by all""",
    "v_gen_profile": """
        select 1 model_id, product_id, cast(year(interval_date) as int) as year,
            cast(month(interval_date) as int) month_id, cast(day(interval_date) as int) day_id, period_id,
            generation_mwh
        from v_generation""",
    "v_load": """
        select cast(floor(l_suppkey / 4) as int) product_id, n_nationkey jurisdiction_id,
            cast(n_regionkey + 1 as int) region_number, cast(l_shipdate as date) interval_date,
            cast(l_orderkey % 4 + 1 as int) period_id, sum(l_quantity) load_mwh
        from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
        group by all""",
    "v_load_profile": """
        select 1 model_id, product_id, jurisdiction_id, cast(year(interval_date) as int) as year,
            cast(month(interval_date) as int) month_id, cast(day(interval_date) as int) day_id, period_id, load_mwh
        from v_load""",
    "v_rates": """
        select product_id, jurisdiction_id, interval_date, period_id,
            cast(80 + product_id % 7 + period_id as double) rate
        from v_load""",
    "v_shapes": """
        select product_id, interval_date, period_id, cast(0.5 + product_id % 3 * 0.25 as double) volume_factor,
            cast(1 as double) price_factor, cast(250 + product_id as double) strike
        from v_generation""",
    "v_halfhour": """
        select cast(floor(l_suppkey / 4) as int) product_id, n_name jurisdiction, cast(l_shipdate as date) interval_date,
            cast(l_orderkey % 2 + 1 as int) period_id, sum(l_quantity) quantity
        from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
        group by all""",
    "v_avg_loss": """
        select distinct product_id, jurisdiction, date '2000-01-01' + period_id published_datetime,
            cast(1.02 + period_id * 0.01 as double) loss_factor
        from (select product_id, period_id,
            case when product_id % 3 = 0 then concat('NOT ', jurisdiction) else jurisdiction end jurisdiction
            from v_halfhour)""",
    "v_units": """
        select cast(s_suppkey as int) deal_id, cast(floor(s_suppkey / 4) as int) product_id,
            concat('U', cast(cast(floor(s_suppkey / 2) + 1 as int) as string)) duid,
            case when s_suppkey % 2 = 0 then 'Solar' else 'Wind' end fuel,
            case when s_suppkey % 3 = 0 then cast(0 as double) end floor,
            case when s_suppkey % 5 = 0 then cast(-48 as double) end turndown, cast(10 + s_suppkey as double) size_mw,
            regionid, v_region.region_number,
            date '1997-01-01' + cast(s_suppkey % 12 * 60 as int) start_date,
            date '1999-12-31' + cast(s_suppkey % 12 * 60 as int) end_date,
            cast(1.0 / (1 + s_suppkey % 4) as double) quantity_factor
        from supplier join nation on s_nationkey = n_nationkey join v_region on region_number = n_regionkey + 1""",
    "v_capacity": """
        select cast(user_id % 5 + 1 as int) region_number, cast(ts as date) interval_date,
            cast(hour(ts) * 12 + floor(minute(ts) / 5) as int) period_id, min(value) / 500 solar_avail_cf,
            max(value) / 500 wind_avail_cf
        from events group by all""",
    "v_clock": """
        select distinct interval_date, cast(year(interval_date) as int) as year,
            cast(month(interval_date) as int) month_id, cast(day(interval_date) as int) day_id, period_id
        from v_capacity""",
    "v_unit_detail": """
        select distinct concat('U', cast(cast(floor(user_id / 3) + 2 as int) as string)) duid,
            date '1995-01-01' + cast(event_id % 3 * 1000 as int) start_date,
            date '1997-09-26' + cast(event_id % 3 * 1000 as int) end_date,
            cast(0.95 + event_id % 3 * 0.01 as double) transmissionlossfactor,
            cast(0.99 as double) distributionlossfactor
        from events""",
    "v_factors_raw": """
        select distinct cast(l_suppkey as int) dealid, 'R' as type,
            date '1996-01-01' + cast(l_linenumber % 3 * 365 as int) fromdate,
            cast(1.0 + l_linenumber % 3 * 0.02 as double) factor
        from lineitem
        union all
        select distinct cast(case when l_suppkey % 2 = 0 then l_suppkey else -l_suppkey end as int), 'M',
            date '1996-01-01' + cast(l_linenumber % 3 * 365 as int), cast(3000 + l_linenumber % 3 * 100 as double)
        from lineitem""",
    "v_rate_profiles_raw": """
        select cast(floor(l_partkey / 100) as int) product_id, 'R' as code, 5 as interval_minutes,
            case l_returnflag when 'A' then 'W' when 'N' then '6' else 'S' end day_type,
            cast(l_orderkey % 4 + 1 as int) period_id,
            date '1995-01-01' + cast(l_partkey % 6 * 400 as int) from_date, min(l_extendedprice / l_quantity) as rate
        from lineitem group by all""",
    "v_cert_rates_raw": """
        select cast(floor(l_suppkey / 4) as int) product_id, cast(l_shipdate as date) interval_date,
            cast(25 + l_linenumber as double) lgc_price, l_discount lgc_percentage
        from lineitem""",
    "v_legs": """
        select l_orderkey dealid, l_partkey productid, l_linenumber line, l_suppkey, l_quantity quantity,
            l_extendedprice / l_quantity price, l_tax brokerage, l_shipdate transferdate, l_shipdate paymentdate
        from lineitem""",
    "v_leg_factors_raw": """
        select distinct dealid, 'R' as type, date '1996-05-30' + cast(line % 3 * 365 as int) fromdate,
            cast(1.0 + line % 3 * 0.02 as double) factor
        from v_legs""",
    "v_deals": """
        select o_orderkey id, concat('D', cast(o_orderkey as string)) name,
            case when o_orderkey % 2 = 0 then 'Buy' else 'Sell' end buysell, o_orderdate dealdate,
            case o_orderstatus when 'F' then 'Confirmed' when 'O' then 'Approved' else 'Pending' end status,
            cast(o_custkey % 5 as int) bookid, cast(o_custkey % 25 as int) strategyid, o_custkey % 10 companyid,
            o_custkey % 7 tradingentityid, cast(o_custkey % 5 as int) calendarid,
            case when o_custkey % 3 = 0 then o_custkey % 9 end brokerid,
            case when o_custkey % 4 = 0 then o_custkey % 8 end clearerid,
            case when o_orderkey % 5 = 0 then 'Option' else 'Firm' end optionality,
            case when o_orderkey % 5 = 0 then 'C' end optioncode,
            case when o_orderkey % 5 = 0 then 'Asian' end optiontype,
            case when o_orderkey % 5 = 0 then o_totalprice / 1000 end optionprice
        from orders""",
    "v_products": """
        select p_partkey id, case when p_size = 7 then concat('ACCU ', p_name) else p_name end name,
            case when p_size % 3 = 0 then 'Flat' else 'Shaped' end schedule,
            date '1996-01-01' + p_size startdate, date '1998-12-31' + p_size enddate, p_type term,
            cast(p_size * 10 as double) strike, p_size % 6 instrumentid, p_size % 5 nodeid
        from part""",
    "v_outlook": """
        select cast(o_custkey % 60 as int) sample_id,
            case when o_orderkey % 2 = 0 then 'Central' else 'Messy' end scenario, cast(l_suppkey as int) deal_id,
            s_name deal_name, cast(floor(l_suppkey / 4) as int) product_id,
            concat('P', cast(cast(floor(l_suppkey / 4) as int) as string)) product_name,
            case substring(o_orderpriority, 1, 1) when '1' then 'Approved' when '2' then 'Confirmed'
                when '3' then 'Pending' when '4' then 'Hypothetical' else 'Rejected' end status,
            case when l_suppkey % 2 = 0 then 'Buy' else 'Sell' end buy_sell,
            concat('S', cast(s_nationkey % 3 as string)) strategy, concat(r_name, '1') regionid,
            case l_returnflag when 'A' then 'BESS' when 'R' then 'ppa_lgc' else 'ppa_energy' end as "group",
            cast(l_shipdate as date) interval_date, l_quantity volume_mwh,
            l_extendedprice * l_discount cost_amount, l_extendedprice * l_tax income_amount,
            l_extendedprice * (l_tax - l_discount) earnings, l_extendedprice / 200 rrp
        from lineitem join orders on l_orderkey = o_orderkey join supplier on l_suppkey = s_suppkey
            join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "v_books": """
        select r_regionkey id, r_name name, case when r_regionkey % 2 = 0 then 'Y' else 'N' end active from region""",
    "v_strategies": "select n_nationkey id, n_name name from nation",
    "v_companies": "select s_suppkey id, s_name name from supplier",
    "v_calendars": "select r_regionkey id, r_name name from region",
    "v_sim_instruments": """
        select * from (values (0, 'Swap A', 'Swap', 0), (1, 'Cap A', 'Cap', 1), (2, 'Retail Customer', 'Retail', 2),
            (3, 'Swap B', 'Swap', 3), (4, 'Cap B', 'Cap', 4), (5, 'Other', 'Other', 0))
            i(id, name, calculation, marketid)""",
    "v_markets": "select r_regionkey id, r_name name from region",
    "v_nodes": "select r_regionkey id, concat(r_name, '1') code from region",
    "v_product_instrument": """
        select cast(p.id as int) product_id, i.name instrument
        from v_products p join v_sim_instruments i on p.instrumentid = i.id""",
    "v_storage": """
        select cast(n_nationkey as int) deal_id, cast(100 + n_nationkey as int) product_id,
            concat('U', cast(n_nationkey % 10 as string)) duid,
            case when n_nationkey % 4 = 3 then 'Sell' else 'Buy' end buy_sell,
            regionid, region_number, date '1995-01-01' start_date, date '2001-12-31' end_date,
            cast(100 + n_nationkey as double) capacity, cast(12 as double) duration, cast(0.81 as double) rte,
            cast(27.5 as double) toll
        from nation join v_region on region_number = n_regionkey + 1""",
    "v_trading": """
        select case cast(o_orderkey % 4 as int) when 0 then o_orderdate when 1 then o_orderdate + interval '6' hour
                when 2 then o_orderdate + interval '12' hour else o_orderdate + interval '18' hour end settlementdate,
            concat(r_name, '1') regionid, o_totalprice / 500.0 - 50 rrp
        from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
            join region on n_regionkey = r_regionkey""",
}

_NAME = re.compile(r"\b[vq]_[a-z0-9_]+\b")


def with_views(statement: str, registry: dict[str, str] = VIEWS) -> str:
    """`statement` behind a WITH list of the named queries it uses, each after those it uses itself."""
    order: list[str] = []

    def visit(sql: str) -> None:
        for name in dict.fromkeys(_NAME.findall(sql)):
            if name in registry and name not in order:
                visit(registry[name])
                order.append(name)

    visit(statement)
    parts = [f"{name} as ({registry[name].strip()})" for name in order]
    return ("with " + ",\n".join(parts) + "\n" if parts else "") + statement.strip()


class Inputs:
    """The views of one data folder as Spark DataFrames: `Inputs(spark, sf_dir).terms`."""

    def __init__(self, spark, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        # One temporary view per table and folder: the footers are read once per session.
        self._tag = re.sub(r"\W", "_", sf_dir)
        for table in BASE_TABLES:
            if not spark.catalog.tableExists(f"{table}{self._tag}"):
                rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
                # A narrow list that most views join: counted, and broadcast if it is not too long.
                if table == "supplier" and fits(rows, SUPPLIERS):
                    rows = F.broadcast(rows)
                rows.createTempView(f"{table}{self._tag}")

    def __getattr__(self, name: str):
        return self.sql(f"select * from v_{name}")

    def sql(self, statement: str):
        text = with_views(statement).replace('"group"', "`group`")
        for table in BASE_TABLES:
            text = re.sub(
                rf"\b(from|join)\s+{table}\b(?!\s*\.)",
                rf"\1 {table}{self._tag} as {table}",
                text,
            )
        return self.spark.sql(text)
