"""SQL with the same result as each query of the catalogue, for DuckDB."""

_SALES = """
sales as (
  select o_custkey as customer_id, s_nationkey as store_id, p_name as product_name,
         cast(o_orderdate as date) as sales_date, l_suppkey as sales_person_id,
         cast(p_retailprice as decimal(18,2)) as price, cast(l_quantity as integer) as quantity,
         cast(l_extendedprice as decimal(18,2)) as total_cost,
         l_linenumber, l_returnflag, l_linestatus
  from lineitem
  join orders on l_orderkey = o_orderkey
  join supplier on l_suppkey = s_suppkey
  join part on l_partkey = p_partkey
)"""

_ENRICHED = """
enriched as (
  select s_nationkey as store_id, cast(o_orderdate as date) as sales_date, l_suppkey as sales_person_id,
         cast(l_extendedprice as decimal(18,2)) as total_cost, o_custkey as customer_id,
         split_part(c_name, '#', 1) as first_name, split_part(c_name, '#', 2) as last_name,
         c_mktsegment as address, cast(c_nationkey as varchar) as pincode,
         lpad(cast(c_custkey as varchar), 10, '0') as phone_number,
         n_name as store_address, 'MANAGER_' || n_nationkey as store_manager_name,
         s_nationkey as manager_id, case when s_acctbal < 0 then 'Y' else 'N' end as is_manager,
         date '2019-11-04' as joining_date,
         split_part(s_name, '#', 1) as sales_person_first_name,
         split_part(s_name, '#', 2) as sales_person_last_name,
         'TEAM_' || s_nationkey as sales_person_address,
         cast(s_nationkey as varchar) as sales_person_pincode,
         strftime(o_orderdate, '%Y-%m') as sales_month
  from lineitem
  join orders on l_orderkey = o_orderkey
  join supplier on l_suppkey = s_suppkey
  join customer on o_custkey = c_custkey
  join nation on s_nationkey = n_nationkey
)"""

_AS_ENRICHED = """
select * exclude (sales_month, total_cost, sales_date, joining_date),
       cast(total_cost as double) as total_cost, cast(sales_date as varchar) as sales_date,
       cast(joining_date as varchar) as joining_date
from enriched"""

_ENRICHED_SALES = f"with {_ENRICHED} {_AS_ENRICHED}"

_TOTALS = _ENRICHED + """,
totals as (
  select store_id, sales_person_id,
         sales_person_first_name || ' ' || sales_person_last_name as full_name,
         sales_month, sum(total_cost) as total_sales
  from enriched group by all
),
ranked as (
  select *, rank() over (partition by store_id, sales_month order by total_sales desc) as rnk from totals
)"""

_CUSTOMER_MONTH = f"""
with {_ENRICHED}
select customer_id, first_name || ' ' || last_name as full_name, address, phone_number,
       sales_month as sales_date_month, cast(sum(total_cost) as double) as total_sales
from enriched
group by customer_id, first_name, last_name, address, phone_number, sales_month"""

_INCENTIVE = "cast(round(case when rnk = 1 then total_sales * 0.01 else 0 end, 2) as double) as incentive"

_FOLD = """case when o_custkey % 3 = 0 then 3 when o_custkey % 7 = 1 then null
         when o_custkey % 7 = 2 then -o_custkey else o_custkey end"""

_FOLDED = _ENRICHED.replace("o_custkey as customer_id", f"{_FOLD} as customer_id").replace("on o_custkey = c_custkey", f"on {_FOLD} = c_custkey")

_LEDGER = """
files as (
  select 'drops/' || o_orderkey || '/' || o_custkey || '.csv' as path, o_custkey || '.csv' as file_name,
         o_orderdate as mtime, o_orderkey, o_orderstatus, o_orderpriority
  from orders
),
listed as (
  select 'drops/' || o_orderkey || '/' || case when o_orderpriority = '4-NOT SPECIFIED' then 'late-' else '' end || file_name as path,
         case when o_orderpriority = '4-NOT SPECIFIED' then 'late-' else '' end || file_name as file_name,
         case when o_orderpriority = '1-URGENT' then mtime + interval 1 day else mtime end as mtime
  from files
),
entered as (select * from files where o_orderpriority <> '5-LOW'),
events as (
  select path, file_name, mtime, mtime as created_date, null as updated_date, 'A' as status from entered
  union all
  select path, file_name, mtime, mtime, timestamp '2024-01-15 12:00:00', 'I' from entered where o_orderstatus = 'F'
  union all
  select path, file_name, mtime, timestamp '2024-01-15 12:00:00', timestamp '2024-01-15 12:00:00', 'R'
  from entered where o_orderstatus = 'P'
),
state as (
  select file_name, path as file_location, mtime as file_mtime, min(created_date) as created_date,
         max(updated_date) as updated_date, arg_max(status, coalesce(updated_date, created_date)) as status
  from events group by file_name, path, mtime
)"""

_FORM = "month(sales_date) % 6"

ORACLE = {
    "salesperson_month_mart": f"""
with {_TOTALS}
select store_id, sales_person_id, full_name, sales_month,
       cast(total_sales as double) as total_sales, {_INCENTIVE}
from ranked""",
    "customer_month_mart": _CUSTOMER_MONTH,
    "salesperson_month_total": f"""
with {_TOTALS}
select store_id, sales_person_id, full_name, sales_month, cast(total_sales as double) as total_sales
from totals""",
    "salesperson_rank": f"""
with {_TOTALS}
select store_id, sales_person_id, full_name, sales_month, cast(total_sales as double) as total_sales, rnk
from ranked""",
    "enriched_sales": _ENRICHED_SALES,
    "enriched_sales_shuffled": f"with {_FOLDED} {_AS_ENRICHED}",
    "rows_without_dimension": f"""
with sold as (select {_FOLD} as customer_id from lineitem join orders on l_orderkey = o_orderkey join supplier on l_suppkey = s_suppkey)
select 'customer' as dimension, count(*) as rows_lost from sold
where customer_id is null or customer_id not in (select c_custkey from customer)
union all select 'store', 0 union all select 'sales_team', 0""",
    "salesperson_rank_ties": f"""
with {_ENRICHED.replace("cast(l_extendedprice as decimal(18,2)) as total_cost", "case when s_nationkey <> 3 then cast(l_quantity as integer) end as total_cost")},
totals as (
  select store_id, sales_person_id, sales_person_first_name || ' ' || sales_person_last_name as full_name,
         sales_month, cast(sum(total_cost) as double) as total_sales
  from enriched group by all
)
select *, rank() over (partition by store_id, sales_month order by total_sales desc nulls last) as rnk from totals""",
    "bad_cell_counts": """
select s_nationkey as store_id, count(*) as n_rows, count(*) filter (where l_linenumber % 4 = 2) as bad_cells,
       count(*) filter (where l_linenumber % 4 = 1) as cut_cells, count(*) filter (where l_linenumber % 4 = 3) as ragged_rows
from lineitem join orders on l_orderkey = o_orderkey join supplier on l_suppkey = s_suppkey join part on l_partkey = p_partkey
group by s_nationkey""",
    "rejected_files": f"""
with {_SALES}, months as (select distinct strftime(sales_date, '%Y-%m') as drop_month, month(sales_date) % 6 as form from sales)
select drop_month, case form when 3 then 'total_cost' when 4 then 'customer_id' end as missing, 1 as n_files
from months where form >= 3""",
    "partition_pruning": f"""
with {_ENRICHED}
select store_id, sales_person_id, sales_person_first_name, sales_person_last_name, store_manager_name,
       manager_id, is_manager, sales_person_address, sales_person_pincode,
       cast(sales_date as varchar) as sales_date, cast(total_cost as double) as total_cost, sales_month
from enriched where sales_month in ('1995-03', '1995-04', '1995-05') and store_id between 5 and 12""",
    "customer_wide": f"""
with {_ENRICHED}
select customer_id, first_name, last_name, address, pincode, phone_number,
       cast(sales_date as varchar) as sales_date, cast(total_cost as double) as total_cost
from enriched""",
    "sales_wide": f"""
with {_ENRICHED}
select store_id, sales_person_id, sales_person_first_name, sales_person_last_name, store_manager_name,
       manager_id, is_manager, sales_person_address, sales_person_pincode,
       cast(sales_date as varchar) as sales_date, cast(total_cost as double) as total_cost, sales_month
from enriched""",
    "drift_packed_union": f"""
with {_SALES}, packed as (
  select *, null as additional_column from sales where l_linenumber % 3 = 0
  union all
  select *, concat_ws(', ', l_returnflag, case when l_linestatus <> 'O' then l_linestatus end)
  from sales where l_linenumber % 3 = 1
  union all
  select *, case when l_linestatus <> 'O' then l_linestatus else '' end from sales where l_linenumber % 3 = 2
)
select customer_id, store_id, product_name, cast(sales_date as varchar) as sales_date, sales_person_id,
       cast(price as double) as price, quantity, cast(total_cost as double) as total_cost, additional_column
from packed""",
    "file_inventory": f"""
with {_SALES}
select distinct strftime(sales_date, '%Y-%m') as drop_month, {_FORM} <> 5 as is_csv, 1 as n_files, 1 as n_paths,
       1 as n_dated, true as has_content
from sales""",
    "header_verdicts": f"""
with {_SALES}
select distinct strftime(sales_date, '%Y-%m') as drop_month,
       case {_FORM} when 3 then 'total_cost' when 4 then 'customer_id' else '' end as missing,
       case {_FORM} when 1 then 'l_returnflag,l_linestatus' when 3 then 'l_returnflag'
                    when 4 then 'Customer_ID' else '' end as extra,
       case when {_FORM} in (3, 4) then 'rejected' else 'ok' end as verdict, 1 as n_files
from sales where {_FORM} <> 5""",
    "ledger_state": f"""
with {_LEDGER}
select file_name, file_location, strftime(file_mtime, '%Y-%m-%d %H:%M:%S') as file_mtime,
       strftime(created_date, '%Y-%m-%d %H:%M:%S') as created_date,
       strftime(updated_date, '%Y-%m-%d') as updated_date, status
from state""",
    "ledger_in_flight": f"""
with {_LEDGER}
select distinct file_name from state
where status = 'A' and file_name in (select file_name from listed)""",
    "pending_files": f"""
with {_LEDGER}
select path, file_name from listed
where not exists (select 1 from state where state.status in ('I', 'R')
                  and state.file_location = listed.path and state.file_mtime = listed.mtime)""",
    "partitioned_mart_roundtrip": f"""
with {_ENRICHED}
select sales_month, store_id, count(*) as n_rows, cast(sum(total_cost) as double) as total_sales
from enriched group by sales_month, store_id""",
    "snapshot_roundtrip": f"""
with {_ENRICHED}
select customer_id, first_name, last_name, address, pincode, phone_number,
       cast(sales_date as varchar) as sales_date, cast(total_cost as double) as total_cost
from enriched""",
    "rebuilt_customer_months": _CUSTOMER_MONTH,
    "rebuilt_salesperson_months": f"""
with {_TOTALS}
select store_id, sales_person_id, full_name, sales_month,
       cast(total_sales as double) as total_sales, {_INCENTIVE}
from ranked""",
    "jdbc_roundtrip": f"""
select * replace (sales_date_month || '-01' as sales_date_month) from ({_CUSTOMER_MONTH})""",
    "daily_run": f"""
with {_TOTALS}
select store_id, sales_person_id, full_name, sales_month,
       cast(total_sales as double) as total_sales, {_INCENTIVE}
from ranked""",
}
