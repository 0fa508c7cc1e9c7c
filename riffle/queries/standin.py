"""The supplied tables in the roles of the song data: rows, members, songs, codes.

Every derived column is plain SQL understood by both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riffle.queries.registry import table
from riffle.session import dealt, spread_small

ID = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]

ROW_COLS = {
    **{c: c for c in ID},
    "l_linestatus": "l_linestatus",
    "msno": "o_custkey",
    "song_id": "l_partkey",
    "source_system_tab": "o_orderstatus",
    "source_screen_name": "o_orderpriority",
    "source_type": "case when l_discount < 0.05 then 'full' else 'deal' end",
    "target": "case when l_returnflag = 'R' then 1 else 0 end",
}
SONG_COLS = {
    "song_id": "p_partkey",
    "song_length": "case when p_size <= 45 then p_size * 10000 end",
    "genre_ids": "case when p_size < 25 then concat(p_type, '|', p_brand) when p_size < 48 then p_type end",
    "artist_name": (
        "case when p_size > 44 then null when p_size > 30 then replace(p_name, ' ', ' feat ') "
        "when p_size > 15 then replace(p_name, ' ', '&') when p_size > 8 then replace(p_name, ' ', '/') "
        "else split_part(p_name, ' ', 1) end"
    ),
    "composer": (
        "case when p_type = 'PROMO' then null when p_size > 20 then concat(split_part(p_name, ' ', 2), '|', p_brand) "
        "else split_part(p_name, ' ', 1) end"
    ),
    "lyricist": (
        "case when p_type = 'LARGE' then null when p_size > 10 then concat(split_part(p_name, ' ', 1), ';', p_type, chr(92), p_brand) "
        "else split_part(p_name, ' ', 1) end"
    ),
    "language": (
        "case p_type when 'ECONOMY' then '17.0' when 'STANDARD' then '45.0' when 'MEDIUM' then '3.0' "
        "when 'LARGE' then '0' else '31.0' end"
    ),
}
CODE_COLS = {
    "song_id": "p_partkey",
    "name": "p_name",
    "isrc": (
        "case when p_type <> 'SMALL' then concat(chr(cast(65 + p_partkey % 26 as int)), chr(cast(65 + p_size % 26 as int)), 'ABC', "
        "lpad(cast(p_partkey % 100 as varchar(2)), 2, '0'), lpad(cast(p_partkey as varchar(12)), 12, '0')) end"
    ),
}


def _select(cols: dict[str, str]) -> list[str]:
    return [f"{e} as {a}" for a, e in cols.items()]


def fact_rows(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    lines = dealt(spread_small(table(spark, sf, "lineitem")), "l_orderkey").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.selectExpr(*_select(ROW_COLS))


def split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Train: finished lines.  Test: open lines."""
    return rows.filter("l_linestatus = 'F'"), rows.filter("l_linestatus = 'O'")


def members(spark: SparkSession, sf: str) -> DataFrame:
    span = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.to_date(F.min("o_orderdate")).alias("registration_init_time"),
        F.to_date(F.max("o_orderdate")).alias("expiration_date"),
    )
    return (
        table(spark, sf, "customer")
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(span, F.col("c_custkey") == F.col("o_custkey"), "left")
        .selectExpr(
            "c_custkey as msno", "c_nationkey as city", "cast(floor(c_acctbal / 100) as int) as bd",
            "c_mktsegment as gender", "n_regionkey as registered_via", "registration_init_time", "expiration_date",
        )
    )


def songs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").selectExpr(*_select(SONG_COLS))


def codes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").selectExpr(*_select(CODE_COLS))


SQL = f"""
facts as (select {', '.join(_select(ROW_COLS))} from lineitem join orders on l_orderkey = o_orderkey),
members as (
  select c_custkey as msno, c_nationkey as city, cast(floor(c_acctbal / 100) as int) as bd,
         c_mktsegment as gender, n_regionkey as registered_via,
         cast(lo as date) as registration_init_time, cast(hi as date) as expiration_date
  from customer join nation on c_nationkey = n_nationkey
  left join (select o_custkey, min(o_orderdate) as lo, max(o_orderdate) as hi from orders group by o_custkey) s
    on s.o_custkey = c_custkey),
songs as (select {', '.join(_select(SONG_COLS))} from part),
codes as (select {', '.join(_select(CODE_COLS))} from part),
member_cols as (
  select msno, city, bd, gender, registered_via,
         cast(date_diff('day', registration_init_time, expiration_date) as int) as membership_days,
         cast(year(registration_init_time) as int) as registration_year,
         cast(month(registration_init_time) as int) as registration_month,
         cast(day(registration_init_time) as int) as registration_day,
         cast(year(expiration_date) as int) as expiration_year,
         cast(month(expiration_date) as int) as expiration_month,
         cast(day(expiration_date) as int) as expiration_day
  from members),
code_cols as (
  select song_id, substr(isrc, 1, 2) as song_area,
         case when cast(substr(isrc, 6, 2) as int) > 17 then 1900 else 2000 end + cast(substr(isrc, 6, 2) as int) as song_year
  from codes),
wide as (
  select f.*, s.song_length, s.genre_ids, s.artist_name, s.composer, s.lyricist, s.language,
         m.city, m.bd, m.gender, m.registered_via, m.membership_days, m.registration_year, m.registration_month,
         m.registration_day, m.expiration_year, m.expiration_month, m.expiration_day, c.song_year, c.song_area
  from facts f left join songs s on f.song_id = s.song_id left join member_cols m on f.msno = m.msno
  left join code_cols c on f.song_id = c.song_id)
"""


def wide_rows(spark: SparkSession, sf: str, rows: DataFrame | None = None) -> DataFrame:
    from riffle.plans.songs import joined_facts

    return joined_facts(
        fact_rows(spark, sf) if rows is None else rows, members(spark, sf), songs(spark, sf), codes(spark, sf)
    )
