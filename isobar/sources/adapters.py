"""Adapters from the given tables to the feeds' data model.

Each is one SELECT that Spark and DuckDB read alike; ``EPOCH(ts)`` stands for
whole seconds since 1970 in either's words.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

#: the fixed "now" of all queries: 2024-01-31 00:00 UTC
NOW = 1706659200
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

ADAPTERS = {
    # readings: D1
    "F1": """
select user_id as station_id,
       case event_type when 'click' then 'OZONE' when 'view' then 'PM2.5'
                       when 'purchase' then 'PM10' else 'OTHER' end as param,
       date_trunc('hour', ts) as hour, cast(floor(value) as int) as aqi
from events
""",
    # stations: site dim for F1
    "F2": """
select distinct user_id as station_id,
       cast(2400 + user_id*37 % 2600 as double)/100 as lat,
       cast(-12500 + user_id*61 % 5900 as double)/100 as lon
from events
""",
    # flashes: D3
    "F3": """
select event_id, case when user_id % 2 = 0 then 'E' else 'W' end as sat,
       cast(15000 + user_id*7919 % 4000 * 10 + event_id % 7 * 4 as double)/1000 as lat,
       cast(-130000 + user_id*104729 % 7000 * 10 + event_id % 5 * 4 as double)/1000 as lon,
       EPOCH(ts) as epoch
from events
""",
    # incidents: D5
    "F4": """
select c_custkey as fire_id, c_name as name,
       case c_mktsegment when 'FURNITURE' then 'RX' when 'BUILDING' then 'CX' else 'WF' end as kind,
       c_custkey % 11 = 0 as is_child,
       case when c_custkey % 17 = 0 then null else cast(c_acctbal as double) end as acres,
       cast(2500 + c_custkey*53 % 2400 as double)/100 as lat,
       cast(-12400 + c_custkey*97 % 5600 as double)/100 as lon
from customer
""",
    # hotspots: D6
    "F5": """
select event_id as spot_id,
       cast(2500 + user_id*53 % 2400 + event_id % 13 as double)/100 as lat,
       cast(-12400 + user_id*97 % 5600 + event_id % 17 as double)/100 as lon,
       value as frp, EPOCH(ts) as epoch,
       case when event_id % 10 = 7 then null when event_id % 10 = 3 then '' else
        case event_type when 'click' then 'low' when 'view' then 'nominal'
                        when 'purchase' then 'high' when 'signup' then '45' else '85' end end as confidence,
       event_id % 5 as sat_code
from events
""",
    # obs: D4, raw units (K, m/s), one QC flag per variable
    "F6": """
select cast(user_id as string) as id,
       case when user_id % 4 = 0 then 'a' when user_id % 4 = 1 then 'r'
            when user_id % 4 = 2 then 'g' else 'c' end as type,
       cast(user_id % 25 as int) as provider_key,
       cast(2400 + user_id*37 % 2600 as double)/100 as lat,
       cast(-12500 + user_id*61 % 5900 as double)/100 as lon,
       EPOCH(ts) as obs, event_id,
       case when event_id % 71 = 0 then 340.0e0 when event_id % 73 = 0 then 200.0e0 else 255 + value/8 end as t_k,
       case when event_id % 79 = 0 then 320.0e0 else 250 + value/8 + event_id % 7 end as td_k,
       value/4 as rh, cast(event_id % 373 - 5 as double) + 0.5e0 as wd,
       case when event_id % 61 = 0 then 100.0e0 else value/10 end as ws,
       case when event_id % 67 = 0 then 120.0e0 when event_id % 5 = 0 then value/12 else value/9 end as wg,
       case when event_id % 89 = 0 then 2000.0e0 else value/50 - 1 end as pr,
       cast(event_id % 30 - 8 as int) as pst1, cast(user_id % 3 as int) as pst3,
       cast(user_id * 37 % 18400 as double) / 2 + 0.5e0 as elev,
       substr('VSCXQBKGZ', cast(event_id % 9 as int) + 1, 1) as t_k_flag,
       substr('VSCXQBKGZ', cast(event_id % 11 % 9 as int) + 1, 1) as td_k_flag,
       case when event_id % 13 > 8 then null else substr('VSCXQBKGZ', cast(event_id % 13 as int) + 1, 1) end as rh_flag,
       substr('VSCXQBKGZ', cast(event_id % 17 % 9 as int) + 1, 1) as wd_flag,
       substr('VSCXQBKGZ', cast(event_id % 19 % 9 as int) + 1, 1) as ws_flag,
       substr('VSCXQBKGZ', cast(event_id % 23 % 9 as int) + 1, 1) as wg_flag,
       substr('VSCXQBKGZ', cast(event_id % 29 % 9 as int) + 1, 1) as pr_flag
from events
""",
    # providers: allow-list dim with a restriction category
    "F7": """
select n_nationkey as provider_key, n_name as provider,
       case when n_regionkey = 0 then 2 when n_regionkey = 1 then 4 else 3 end as category
from nation
""",
    # metars: ids to drop
    "F8": """
select cast(s_suppkey as string) as id from supplier where s_suppkey % 3 = 0
""",
    # cells: D8, sparse 200x200 grid, sentinels at -99
    "F9": """
select l_linenumber as field, l_orderkey % 200 as r, l_partkey % 200 as c,
       max(case when l_quantity < 3 then -99.0e0 else l_quantity * 2 - 20 end) as v
from lineitem group by l_linenumber, l_orderkey % 200, l_partkey % 200
""",
    # column values by native level: D9/D10 (level heights 500,1000,...)
    "F10": """
select l_suppkey as col_id, l_linenumber as lvl, l_linenumber * 500 as height_m,
       max(l_quantity) as v
from lineitem group by l_suppkey, l_linenumber
""",
    # run totals by hour: W5 input (monotone accumulation)
    "F11": """
select l_suppkey as site, cast(l_linenumber - 1 as int) as fh, sum(l_quantity) as total
from lineitem where not (l_suppkey % 3 = 0 and l_linenumber = 1) and not (l_suppkey % 5 = 0 and l_linenumber = 4) group by l_suppkey, l_linenumber
""",
    # listing: D11 frame keys
    "F12": """
select o_orderpriority as product, o_orderdate as run, o_orderkey % 49 as fh, o_orderkey as obj
from orders
""",
    # object sizes: D12
    "F13": """
select n_chars as size,
       concat('v1/', source, '/', lang, '/', cast(doc_id as string), '.json') as path
from documents
""",
    # inventory: D13
    "F14": """
select p_partkey % 20 as file_id, p_partkey as msg,
       sum(p_size) over (partition by p_partkey % 20 order by p_partkey) - p_size as off,
       p_brand as var, p_type as lvl
from part
""",
    # level stamps: A10/J5 input
    "F15": """
select o_orderpriority as level_name, o_orderdate as stamp, min(o_orderkey) as obj
from orders group by o_orderpriority, o_orderdate
""",
    # health samples: D17
    "F16": """
select event_type as code, EPOCH(ts) as t, value as live_age, value / 3 as source_age from events
""",
    # area forecast lines: D2 (text to be split again)
    "F17": """
select concat(cast(c_custkey as string), '|01/', lpad(cast(c_custkey % 28 + 1 as string), 2, '0'),
       '/24|00:00|UTC|', cast(c_custkey % 5 - 1 as string), '|',
       case when c_custkey % 3 = 0 then 'O' else 'F' end, '|Y|', c_name, '|ST|',
       cast(cast(2500 + c_custkey*53 % 2400 as double)/100 as string), '|',
       cast(cast(-12400 + c_custkey*97 % 5600 as double)/100 as string), '|PM2.5|',
       case when c_custkey % 4 = 0 then '' else cast(c_custkey % 320 as string) end,
       '|', case c_custkey % 6 when 0 then 'Moderate' when 1 then ' Good' when 2 then 'usg' when 3 then '' when 4 then 'Unhealthy' else 'Very Unhealthy' end, '|',
       case c_custkey % 5 when 0 then 'No' when 1 then '' when 2 then 'YES' else 'Yes' end, '||src') as line
from customer
""",
    # pixels: D16 (one frame per line number, 96x96)
    "F18": """
select l_linenumber as frame, l_orderkey % 96 as y, l_partkey % 96 as x,
       max(cast(floor(l_quantity * 5) as int)) as r, max(cast(floor(l_tax * 3000) as int)) as g,
       max(cast(floor(l_discount * 2500) as int)) as b
from lineitem group by l_linenumber, l_orderkey % 96, l_partkey % 96
""",
    # vertices: D7 exploded
    "F19": """
select l_orderkey as poly, l_linenumber as seq,
       cast(2400 + l_partkey % 2600 as double)/100 as lat,
       cast(-12500 + l_suppkey*61 % 5900 as double)/100 as lon
from lineitem
""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An adapter's rows in Spark."""
    return query(spark, sf_dir, ADAPTERS[name])


def query(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Spark SQL over the given tables and adapters (``$F1``)."""
    sql = re.sub(r"\$(F\d+)\b", lambda m: f"({ADAPTERS[m[1]]})", sql)
    used = [t for t in TABLES if re.search(rf"\b(from|join)\s+{t}\b", sql)]
    for t in used:
        sql = re.sub(rf"\b(from|join)\s+{t}\b", rf"\1 {{{t}}}", sql)
    sql = re.sub(r"EPOCH\((\w+)\)", r"unix_timestamp(cast(\1 as timestamp))", sql)
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in used})


def duck(sql: str) -> str:
    """The same statement for DuckDB."""
    sql = re.sub(r"\$(F\d+)\b", lambda m: f"({ADAPTERS[m[1]]})", sql)
    return re.sub(r"EPOCH\((\w+)\)", r"cast(floor(epoch(\1)) as bigint)", sql)
