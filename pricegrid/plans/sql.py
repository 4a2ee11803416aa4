"""Building blocks of the SQL texts that check the queries."""

LISTINGS = """
select md5(concat_ws('|',cast(l_orderkey as varchar),cast(l_partkey as varchar),cast(l_suppkey as varchar),
                     cast(l_linenumber as varchar),cast(cast(round(l_extendedprice*100) as bigint) as varchar))) as listing_id,
 p_brand as brand, p_name as model, cast(year(o_orderdate) as bigint) as year, l_extendedprice as price,
 l_quantity*4000.0e0 as km, n_name as state, r_name as region, s_name as city, l_returnflag as fuel_type,
 l_linestatus as transmission, p_size/10.0e0 as engine_size, p_type as color, cast(l_linenumber as bigint) as doors,
 o_orderpriority as condition, cast(year(l_shipdate)-year(o_orderdate) as bigint) as age_years,
 cast(year(l_shipdate) as bigint) as year_of_reference, strftime(l_shipdate, '%Y-%m') as month_of_reference
from lineitem join part on l_partkey=p_partkey join supplier on l_suppkey=s_suppkey
 join nation on s_nationkey=n_nationkey join region on n_regionkey=r_regionkey join orders on l_orderkey=o_orderkey
"""

DIRTY = """
select listing_id, case when h=2 then '  '||lower(brand)||'  ' else brand end as brand,
 case when h=3 then null else model end as model, year,
 case when h=0 then null when h=6 then price*100 else price end as price,
 case when h=1 then null when h=4 then -999.0e0 else km end as km,
 case when h=9 then lower(state) else state end as state, region, city, fuel_type, transmission, engine_size,
 case when h=5 then '' else color end as color, doors, condition,
 case when h=8 then age_years+1 else age_years end as age_years, year_of_reference, month_of_reference
from (select *, unnest(case when h=7 then [1,2] else [1] end) as copy_no
      from (select *, cast('0x'||substr(listing_id,1,4) as int) % 50 as h from l))
"""

WITH_L = f"with l as ({LISTINGS})"
WITH_D = f"with l as ({LISTINGS}), d as ({DIRTY})"

LISTING_COLUMNS = [
    "listing_id", "brand", "model", "year", "price", "km", "state", "region", "city", "fuel_type",
    "transmission", "engine_size", "color", "doors", "condition", "age_years", "year_of_reference",
    "month_of_reference",
]
NUMERIC = ["year", "price", "km", "engine_size", "doors", "age_years", "year_of_reference"]
TEXT = [c for c in LISTING_COLUMNS if c not in NUMERIC]


def union(parts):
    return "\nunion all\n".join(parts)


def metrics_sql(y="y", yhat="yhat"):
    """Metric columns in the order and rounding of the metric operator."""
    e = f"({y}-{yhat})"
    return f"""count(*) as n_samples, round(sqrt(avg({e}*{e})),4) as rmse, round(avg(abs{e}),4) as mae,
 round(avg(case when {y}<>0 then abs({e}/{y}) end),6) as mape,
 round(case when count(*)<2 then null when var_pop({y})>0 then 1-sum({e}*{e})/(count(*)*var_pop({y}))
       when sum({e}*{e})=0 then 1e0 else 0e0 end,6)+0e0 as r2"""


CLEAN_FILTER = """price>0 and km>=0 and age_years>=0 and year<=year_of_reference
 and engine_size>=0.7e0 and engine_size<=7.0e0 and doors in (2,3,4,5)"""


def split_ctes(source, order="listing_id", name="sp"):
    """CTE texts: rows of source with an exact 70/15/15 split by rank."""
    return f"""r_{name} as (select *, row_number() over (order by {order}) as rn, count(*) over () as n from {source}),
 {name} as (select * exclude (rn, n), case when rn<=floor(n*0.7e0) then 'train'
   when rn<=floor(n*0.7e0)+floor(n*0.15e0) then 'val' else 'test' end as split from r_{name})"""


def title_sql(expr):
    """Title case by runs of letters."""
    runs = rf"regexp_extract_all(lower({expr}),'\p{{L}}+|[^\p{{L}}]+')"
    return f"array_to_string(list_transform({runs}, lambda x: upper(x[1])||x[2:]),'')"


def strip_sql(expr):
    return rf"regexp_replace({expr},'^\s+|\s+$','','g')"


def uniform_sql(key, stream, seed=42):
    return (
        f"(cast('0x'||substr(md5({key}||'|{stream}|{seed}'),1,8) as bigint)/4294967296.0e0)"
    )
