"""Column helpers and small relational building blocks over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hrflow.functions import (
    band,
    business_days,
    day_diff,
    hours_between,
    iso_timestamp,
    rank_in,
    round_away,
    safe_ratio,
    surrogate_key,
    surrogate_key_if,
    trailing,
)
from hrflow.operators.calendar import period_start, split_by_period
from hrflow.plans.reports import last_loaded, month_start_only
from workload.checks import key, key_if
from workload.registry import query
from workload.views import table


@query(
    "fn_keys",
    f"""select o_orderkey, {key("o_custkey", "cast(o_orderdate as date)", "nullif(o_orderstatus, 'P')")} as composite,
               {key("nullif(o_orderstatus, 'P')")} as never_null, {key_if("nullif(o_orderstatus, 'P')")} as null_kept
        from orders""",
)
def _keys(t, spark, sf):
    """Surrogate keys over numbers, dates and nulls."""
    status = F.nullif("o_orderstatus", F.lit("P"))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        surrogate_key("o_custkey", F.to_date("o_orderdate"), status).alias("composite"),
        surrogate_key(status).alias("never_null"),
        surrogate_key_if(status).alias("null_kept"),
    )


_GRAINS = ("week", "month", "quarter", "year")


@query(
    "fn_dates",
    f"""select o.o_orderkey, l.last_ship, cast(date_diff('day', o.o_orderdate, l.last_ship) as integer) as day_diff,
               epoch_us(l.last_ship - (o.o_orderdate + interval 90 minute)) / 3600000000.0 as hours,
               {", ".join(f"cast(date_trunc('{g}', l.last_ship) as date) as {g}" for g in _GRAINS)},
               (select count(*) from generate_series(1, greatest(date_diff('day', o.o_orderdate, l.last_ship), 0)) g(i)
                where dayofweek(cast(o.o_orderdate as date) + cast(g.i as integer)) not in (0, 6))
               - (select count(*) from generate_series(1, greatest(date_diff('day', l.last_ship, o.o_orderdate), 0)) g(i)
                where dayofweek(cast(l.last_ship as date) + cast(g.i as integer)) not in (0, 6)) as business_days
        from orders o join (select l_orderkey, max(l_shipdate) as last_ship from lineitem group by 1) l
             on l.l_orderkey = o.o_orderkey""",
)
def _dates(t, spark, sf):
    """Calendar arithmetic between the order and its last shipment."""
    ships = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_shipdate").alias("last_ship")
    )
    o, s = F.col("o_orderdate"), F.col("last_ship")
    return table(spark, sf, "orders").join(ships, "o_orderkey").select(
        "o_orderkey",
        "last_ship",
        day_diff(o, s).alias("day_diff"),
        hours_between(o + F.expr("interval 90 minutes"), s).alias("hours"),
        *[period_start(s, g).alias(g) for g in _GRAINS],
        business_days(o, s).cast("bigint").alias("business_days"),
    )


@query(
    "fn_iso_timestamp",
    """select event_id, date_trunc('second', ts) as zulu, date_trunc('second', ts) - interval 2 hour as with_offset,
              cast(null as timestamp) as broken from events""",
)
def _iso(t, spark, sf):
    """ISO texts with ``Z`` and with an offset, and text that is no timestamp."""
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return table(spark, sf, "events").select(
        "event_id",
        iso_timestamp(F.concat(text, F.lit("Z"))).alias("zulu"),
        iso_timestamp(F.concat(text, F.lit("+02:00"))).alias("with_offset"),
        iso_timestamp(F.concat(F.lit("on "), text)).alias("broken"),
    )


@query(
    "fn_rounding",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
              round(l_extendedprice / nullif(l_quantity, 0), 2) as unit_price,
              round((l_discount - 0.05) * l_extendedprice, 1) as signed,
              round(l_tax / nullif(l_discount, 0), 3) as tax_per_discount
       from lineitem""",
)
def _rounding(t, spark, sf):
    """Guarded ratios and rounding, negative values included."""
    c = F.col
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
        safe_ratio(c("l_extendedprice"), c("l_quantity"), 2).alias("unit_price"),
        round_away((c("l_discount") - 0.05) * c("l_extendedprice"), 1).alias("signed"),
        safe_ratio(c("l_tax"), c("l_discount"), 3).alias("tax_per_discount"),
    )


_SEGMENTS = ("MACHINERY", "BUILDING", "FURNITURE")


@query(
    "fn_band_rank",
    """select case when c_acctbal < 0 then 'debt' when c_acctbal < 1000 then 'low' when c_acctbal < 5000 then 'mid'
                   else 'high' end as band,
              case c_mktsegment when 'MACHINERY' then 1 when 'BUILDING' then 2 when 'FURNITURE' then 3 end as position,
              count(*) as n from customer group by all""",
)
def _band_rank(t, spark, sf):
    """Bands of a balance and the place of a segment in a fixed order."""
    return (
        table(spark, sf, "customer")
        .groupBy(
            band(F.col("c_acctbal"), (0, 1000, 5000), ("debt", "low", "mid", "high")).alias("band"),
            rank_in(F.col("c_mktsegment"), _SEGMENTS).cast("int").alias("position"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "trailing_windows",
    """with l as (select max(o_orderdate) as d from orders where o_orderstatus = 'F')
       select o_orderkey, cast(o_orderdate as date) >= cast(l.d as date) - 13 as in_days
       from orders, l where cast(o_orderdate as date) between cast(l.d as date) - interval 12 month and cast(l.d as date)""",
)
def _trailing(t, spark, sf):
    """Orders of the 12 months and the 14 days that end with the last finished order."""
    o = table(spark, sf, "orders").withColumn("day", F.to_date("o_orderdate"))
    anchor = last_loaded(o, "day", F.col("o_orderstatus") == "F")
    return o.where(trailing("day", anchor, 12, "month")).select(
        "o_orderkey", (F.col("day") >= F.date_sub(anchor, 13)).alias("in_days")
    )


@query(
    "month_start_sample",
    """select cast(o_orderdate as date) as day, count(*) as n from orders where day(o_orderdate) = 1 group by 1""",
)
def _month_start(t, spark, sf):
    """Orders on the first of a month."""
    days = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return month_start_only(days, "day")


@query(
    "period_split",
    """with i as (select o_orderkey, cast(min(o_orderdate) as date) as a, cast(max(l_shipdate) as date) as b
                  from orders join lineitem on l_orderkey = o_orderkey group by 1)
       select o_orderkey, cast(date_trunc('month', d) as date) as period_start, count(*) as days,
              cast(min(d) as date) as from_date, cast(max(d) as date) as to_date
       from (select o_orderkey, unnest(generate_series(a, b, interval 1 day)) as d from i where a <= b) group by 1, 2""",
)
def _split(t, spark, sf):
    """Open time of orders, cut at month borders."""
    ships = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.to_date(F.max("l_shipdate")).alias("to_date")
    )
    orders = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("from_date"))
    return split_by_period(orders.join(ships, "o_orderkey"), "month").withColumn("days", F.col("days").cast("bigint"))


@query(
    "activity_spine",
    """select distinct cast(o_orderdate as date) as day, o_orderkey as id from orders
       union select cast(l_shipdate as date), l_orderkey from lineitem
       union select cast(ts as date), user_id from events""",
)
def _spine(t, spark, sf):
    """Distinct day and id of any activity in three tables."""
    parts = [("orders", "o_orderdate", "o_orderkey"), ("lineitem", "l_shipdate", "l_orderkey"), ("events", "ts", "user_id")]
    frames = [table(spark, sf, n).select(F.to_date(d).alias("day"), F.col(i).alias("id")) for n, d, i in parts]
    return frames[0].unionByName(frames[1]).unionByName(frames[2]).distinct()
