"""Query registry: one Spark query per operator of SURVEY §2 and its DuckDB oracle.

Every query reads the test tables under ``sf_dir`` (through the bar views of
``sources.fixtures``) and returns flat columns: text, bigint and doubles
rounded with ``functions.numeric.rnd`` (4 places, 2 in snapshots).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.functions.numeric import rnd
from tickframe.operators.indicators import INDICATOR_COLUMNS, indicators
from tickframe.operators.levels import SNAPSHOT_COLUMNS, snapshot
from tickframe.operators import rank
from tickframe.plans import oracle_sql as O
from tickframe.sources import dims
from tickframe.operators.clean import EXPORT_COLUMNS
from tickframe.plans import market, report
from tickframe.sources import fixtures
from tickframe.sources.fixtures import bars, time_text

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

PRICES = ["open", "high", "low", "close", "volume"]


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# ------------------------------------------------------------------ S1 bar views
def _bars_query(view: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        b = bars(spark, sf_dir, view)
        return b.select("symbol", time_text().alias("time"), *[rnd(c, 4).alias(c) for c in PRICES])
    return q


for _v in ("brand", "supp", "flag", "hour", "user"):
    register(f"bars_{_v}", O.with_recursive(
        O.bars_cte(_v),
        "select symbol, cast(time as varchar) as time, "
        + ", ".join(f"{O.r(c)} as {c}" for c in PRICES) + " from bars"))(_bars_query(_v))


# ------------------------------------------------- W1-W11, R1-R7 indicator columns
def _indicator_query(view: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        ind = indicators(bars(spark, sf_dir, view), wanted=["symbol", "time", "rn", *INDICATOR_COLUMNS])
        return ind.select("symbol", time_text().alias("time"), "rn",
                          *[rnd(c, 4).alias(c) for c in INDICATOR_COLUMNS])
    return q


for _v in ("brand", "supp", "flag", "hour", "user"):
    register(f"indicators_{_v}", O.with_recursive(
        O.indicator_ctes(_v),
        "select symbol, cast(time as varchar) as time, rn, "
        + ", ".join(f"{O.r(c)} as {c}" for c in INDICATOR_COLUMNS) + " from ind"))(
        _indicator_query(_v))


# ------------------------------------------------------------ L1-L4 snapshot
def _snapshot_sql(view: str) -> str:
    return O.with_recursive(snapshot_ctes(O.indicator_ctes(view)), "select symbol, "
                            + snapshot_cols() + " from last")


def snapshot_cols() -> str:
    lv = {
        "pivot": "pv",
        "r1": "2 * pv - low", "r2": "pv + high - low", "r3": "high + 2 * (pv - low)",
        "s1": "2 * pv - high", "s2": "pv - high + low", "s3": "low - 2 * (high - pv)",
        "fibo_236": "hi52 - 0.236 * (hi52 - lo52)", "fibo_382": "hi52 - 0.382 * (hi52 - lo52)",
        "fibo_500": "hi52 - 0.5 * (hi52 - lo52)", "fibo_618": "hi52 - 0.618 * (hi52 - lo52)",
        "fibo_786": "hi52 - 0.786 * (hi52 - lo52)", "hi52": "hi52", "lo52": "lo52",
        "change": "close - pc",
        "change_pct": "case when pc = 0 then 0.0 else (close - pc) / nullif(pc, 0) * 100.0 end",
        "volume": None, "date": None,
    }
    cols = []
    for c in SNAPSHOT_COLUMNS:
        if c == "date":
            cols.append("substr(cast(time as varchar), 1, 10) as date")
        elif c == "volume":
            cols.append("cast(trunc(volume) as bigint) as volume")
        else:
            cols.append(f"{O.r(lv.get(c) or c, 2)} as {c}")
    return ", ".join(cols)


def snapshot_ctes(ind_ctes: str) -> str:
    return ind_ctes + """,
yr as (select symbol, max(high) as hi52, min(low) as lo52 from ind
       where rn > n_bars - 252 group by symbol),
last as (select ind.*, coalesce(prev_close, close) as pc, (high + low + close) / 3.0 as pv,
                yr.hi52, yr.lo52
         from ind join yr using (symbol) where rn = n_bars)"""


def _snapshot_query(view: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return snapshot(indicators(bars(spark, sf_dir, view)))
    return q


for _v in ("brand", "flag", "hour", "user"):
    register(f"snapshot_{_v}", _snapshot_sql(_v))(_snapshot_query(_v))


# ------------------------------------------------------ T6 movers, T7 sectors
def _movers_sql(view: str, universe_cte: str, where: str = "") -> str:
    ctes = f"""{O.bars_cte(view)},
{universe_cte},
{O.last_two_cte()},
res as (select u."index", u.ord, u.symbol, l2.close,
               {O.r(O.PCT.replace('close', 'l2.close').replace('prev_l2.close', 'l2.prev_close'), 2)} as change_pct
        from u join l2 using (symbol) where l2.n_last = 2{where}),
rk as (select *, row_number() over (partition by "index" order by change_pct desc, ord asc) as up,
              row_number() over (partition by "index" order by change_pct asc, ord desc) as dn
       from res)"""
    body = f"""select "index", 'gainer' as side, up as rank, symbol, {O.r('close')} as close, change_pct
from rk where up <= 3
union all
select "index", 'loser' as side, dn as rank, symbol, {O.r('close')} as close, change_pct
from rk where dn <= 3"""
    return O.with_recursive(ctes, body)


@register("top_movers_brand", _movers_sql("brand", O.UNIVERSE_CTE))
def top_movers_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    stock = rank.scale_fixed(bars(spark, sf_dir, "brand"))
    m = rank.top_movers(dims.dim_universe(spark), stock)
    return m.withColumn("close", rnd("close", 4))


_SUPP_UNIVERSE = """u as (select 'IX_SUPP' as "index", cast(s_suppkey as varchar) as symbol,
                 cast(s_suppkey as integer) as ord from supplier)"""


@register("top_movers_supp", _movers_sql("supp", _SUPP_UNIVERSE))
def top_movers_supp(spark: SparkSession, sf_dir: str) -> DataFrame:
    stock = rank.scale_fixed(bars(spark, sf_dir, "supp"))
    m = rank.top_movers(dims.dim_supplier_universe(spark, sf_dir), stock)
    return m.withColumn("close", rnd("close", 4))


@register("top_movers_supp_capped", _movers_sql("supp", _SUPP_UNIVERSE, f" and u.ord <= {dims.MOVER_CAP}"))
def top_movers_supp_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cap, passed explicitly."""
    stock = rank.scale_fixed(bars(spark, sf_dir, "supp"))
    m = rank.top_movers(dims.dim_supplier_universe(spark, sf_dir), stock, cap=dims.MOVER_CAP)
    return m.withColumn("close", rnd("close", 4))


def _sectors_sql(view: str) -> str:
    ctes = f"""{O.bars_cte(view)},
{O.UNIVERSE_CTE},
{O.SECTOR_CTE},
{O.last_two_cte()},
mem as (select distinct u."index", sec.sector, sec.sector_ord, sec.symbol
        from u join sec using (symbol)),
pc as (select symbol, {O.PCT} as pct from l2 where n_last = 2),
agg as (select "index", sector, sector_ord, {O.r('avg(pct)', 2)} as change_pct
        from mem join pc using (symbol) group by 1, 2, 3),
rk as (select *, row_number() over (partition by "index" order by change_pct desc, sector_ord asc) as all_rank,
              row_number() over (partition by "index" order by change_pct asc, sector_ord desc) as lag
       from agg)"""
    body = """select "index", sector, change_pct, all_rank,
       case when all_rank <= 3 then all_rank end as lead_rank,
       case when lag <= 3 then lag end as lag_rank
from rk"""
    return O.with_recursive(ctes, body)


@register("sector_performance_brand", _sectors_sql("brand"))
def sector_performance_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    stock = rank.scale_fixed(bars(spark, sf_dir, "brand"))
    members = rank.sector_members(dims.dim_index(spark), dims.dim_universe(spark), dims.dim_sector(spark))
    return rank.sector_performance(members, stock)


# =========================================================== market document
def _stock_ctes(view: str = "brand") -> str:
    """Stock-side CTEs for the document: ``mv`` (movers) and ``sp`` (sectors)."""
    l2 = O.last_two_cte("sbars").replace("l2 as (", "sl2 as (", 1)
    pct = O.PCT
    return f"""sbars as ({O.BARS_SQL[view]}),
{O.UNIVERSE_CTE},
{O.SECTOR_CTE},
{l2},
mres as (select u."index", u.ord, u.symbol, sl2.close,
                {O.r(pct.replace('prev_close', 'sl2.prev_close').replace('(close', '(sl2.close'), 2)} as change_pct
         from u join sl2 using (symbol) where sl2.n_last = 2),
mrk as (select *, row_number() over (partition by "index" order by change_pct desc, ord asc) as up,
               row_number() over (partition by "index" order by change_pct asc, ord desc) as dn
        from mres),
mv as (select "index", 'gainer' as side, up as rank, symbol, close, change_pct from mrk where up <= 3
       union all
       select "index", 'loser' as side, dn as rank, symbol, close, change_pct from mrk where dn <= 3),
mem as (select distinct u."index", sec.sector, sec.sector_ord, sec.symbol from u join sec using (symbol)),
spc as (select symbol, {pct} as pct from sl2 where n_last = 2),
sagg as (select "index", sector, sector_ord, {O.r('avg(pct)', 2)} as change_pct
         from mem join spc using (symbol) group by 1, 2, 3),
srk as (select *, row_number() over (partition by "index" order by change_pct desc, sector_ord asc) as all_rank,
               row_number() over (partition by "index" order by change_pct asc, sector_ord desc) as lag
        from sagg),
sp as (select "index", sector, change_pct, all_rank,
              case when all_rank <= 3 then all_rank end as lead_rank,
              case when lag <= 3 then lag end as lag_rank from srk)"""


def _market_snapshot_ctes() -> str:
    return snapshot_ctes(O.market_ctes()) + """,
msnap as (select ix."index", """ + snapshot_cols() + """ from last join ix on ix.ticker = last.symbol)"""


_EXPORT = [c for c in EXPORT_COLUMNS if c != "time"]


def _market_export_ctes() -> str:
    cols = ", ".join(f"ind.{c}" for c in _EXPORT)
    return O.market_ctes() + f""",
mexp as (select ix."index", ind.rn, substr(cast(ind.time as varchar), 1, 10) as time, {cols},
                 row_number() over (partition by ix."index" order by ind.rn) as pos
          from ind join ix on ix.ticker = ind.symbol where ind.rn > ind.n_bars - 365)"""


def _market(spark: SparkSession, sf_dir: str, settings: market.MarketSettings = market.MarketSettings(), more=()) -> market.MarketTables:
    """The market tables of the test brands; nothing runs until one of them is read."""
    indexes = dims.values(spark, [*dims.INDEX_ROWS, *more], "index, ticker, ord")
    return market.market_tables(bars(spark, sf_dir, "flag"), rank.scale_fixed(bars(spark, sf_dir, "brand")), indexes,
                                dims.dim_universe(spark), dims.dim_sector(spark), settings)


def _round_doubles(df: DataFrame, d: int = 4) -> DataFrame:
    return df.select(*[rnd(f.name, d).alias(f.name) if f.dataType.typeName() == "double"
                       else F.col(f.name) for f in df.schema.fields])


@register("market_snapshot", O.with_recursive(_market_snapshot_ctes(), "select * from msnap"))
def market_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1, S4, P8, P7, L4 on the three index series, keyed by index code."""
    return _market(spark, sf_dir).snapshot.drop("symbol")


@register("market_export", O.with_recursive(
    _market_export_ctes(),
    "select \"index\", rn, time, " + ", ".join(f"{O.r(c)} as {c}" for c in _EXPORT) + " from mexp"))
def market_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 365-bar export rows per index."""
    return _round_doubles(_market(spark, sf_dir).ohlcv.drop("symbol", "pos"))


def _hero_sql() -> str:
    up = "coalesce(change_pct, 0) >= 0"
    sign = f"case when {up} then '+' else '' end"
    body = f"""select "index", case when {up} then 'up' else 'down' end as tone,
       {O.fmt_num('close')} as price,
       {sign} || {O.fixed('change')} || ' (' || {sign} || {O.fixed('change_pct')} || '%)' as change,
       coalesce(date, '') as date, {O.fmt_int('volume')} as volume,
       {O.fmt_num('high')} as high, {O.fmt_num('low')} as low
from msnap"""
    return O.with_recursive(_market_snapshot_ctes(), body)


@register("report_hero", _hero_sql())
def report_hero_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.report_hero(_market(spark, sf_dir).snapshot)


def _indicators_report_sql() -> str:
    INDICATOR_ROWS = report.INDICATOR_ROWS
    parts = []
    for pos, grp, label, field, d, st in INDICATOR_ROWS:
        if st == "rsi":
            status = ("case when coalesce(rsi14, 0) > 70 then 'overbought' "
                      "when coalesce(rsi14, 0) < 30 then 'oversold' else 'neutral' end")
        elif st == "macd":
            status = "case when coalesce(macd_hist, 0) > 0 then 'positive' else 'negative' end"
        else:
            status = "cast(null as varchar)"
        parts.append(f"""select "index", cast({pos} as bigint) as pos, '{grp}' as grp, '{label}' as label,
       {O.fmt_num(field, d)} as value, {status} as status from msnap""")
    return O.with_recursive(_market_snapshot_ctes(), "\nunion all\n".join(parts))


@register("report_indicators", _indicators_report_sql())
def report_indicators_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.report_indicators(_market(spark, sf_dir).snapshot)


def _levels_report_sql() -> str:
    LEVEL_ROWS = report.LEVEL_ROWS
    parts = []
    for pos, label, source, field in LEVEL_ROWS:
        val = "cast(null as double)" if source == "analysis" else O.q(field)
        parts.append(f"""select "index", cast({pos} as bigint) as pos, '{label}' as level,
       {O.r(val, 2)} as value, {O.fmt_num(val)} as text from msnap""")
    return O.with_recursive(_market_snapshot_ctes(), "\nunion all\n".join(parts))


@register("report_levels", _levels_report_sql())
def report_levels_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.report_levels(_market(spark, sf_dir).snapshot)


def _movers_report_sql() -> str:
    ctes = O.market_ctes() + ",\n" + _stock_ctes() + """,
items as (
  select "index", 'leading' as list, lead_rank as rank, sector as name, 'pos' as tone, change_pct
  from sp where lead_rank is not null
  union all
  select "index", 'lagging', lag_rank, sector, 'neg', change_pct from sp where lag_rank is not null
  union all
  select "index", 'gainers', rank, symbol, 'pos', change_pct from mv where side = 'gainer'
  union all
  select "index", 'losers', rank, symbol, 'neg', change_pct from mv where side = 'loser'),
ok as (select ix."index" from ix where ix.ticker in (select symbol from ind)),
lists as (select * from (values ('leading'), ('lagging'), ('gainers'), ('losers')) t(list))"""
    body = f"""select i."index", i.list, cast(i.rank as bigint) as rank, i.name, i.tone,
       {O.fixed('i.change_pct', 2, True)} || '%' as change
from items i join ok using ("index")
union all
select ok."index", lists.list, cast(0 as bigint), 'no data', cast(null as varchar), cast(null as varchar)
from ok, lists
where not exists (select 1 from items i where i."index" = ok."index" and i.list = lists.list)"""
    return O.with_recursive(ctes, body)


@register("report_movers", _movers_report_sql())
def report_movers_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _market(spark, sf_dir)
    return report.report_movers(m.movers, m.sectors, m.reported(m.indexes.select("index")))


@register("report_index_order", O.with_recursive(
    O.market_ctes() + ",\nok as (select distinct symbol from ind)",
    """select ix."index", ix.ord, ix.ord = (select min(ord) from ix) as active,
       ix.ticker in (select symbol from ok) as has_data from ix"""))
def report_index_order_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tabs in order with the document's status."""
    m = _market(spark, sf_dir)
    has = m.reported(m.indexes.select("index")).withColumn("has_data", F.lit(True))
    return market.index_order(m.indexes).join(has, "index", "left").fillna(False, ["has_data"])


def _chart_sql(kind: str) -> str:
    ctes = _market_export_ctes()
    if kind == "candles":
        body = ("select \"index\", pos, time, " + ", ".join(f"{O.r(c)} as {c}" for c in
                ("open", "high", "low", "close")) + " from mexp where close is not null and close <> 0")
    elif kind == "volume":
        body = (f"select \"index\", pos, time, {O.r('volume')} as value, "
                "case when close >= open then 'up' else 'down' end as color "
                "from mexp where volume is not null and volume <> 0")
    else:
        CHART_LINES = report.CHART_LINES
        body = "\nunion all\n".join(
            f"select \"index\", pos, time, '{c}' as line, {O.r(c)} as value from mexp "
            f"where {c} is not null and {c} <> 0" for c in CHART_LINES)
    return O.with_recursive(ctes, body)


@register("chart_candles", _chart_sql("candles"))
def chart_candles_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_doubles(report.chart_candles(_market(spark, sf_dir).ohlcv))


@register("chart_volume", _chart_sql("volume"))
def chart_volume_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_doubles(report.chart_volume(_market(spark, sf_dir).ohlcv))


@register("chart_lines", _chart_sql("lines"))
def chart_lines_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_doubles(report.chart_lines(_market(spark, sf_dir).ohlcv))


@register("series_json", O.with_recursive(
    _market_export_ctes(),
    "select \"index\", pos, count(*) over (partition by \"index\") as points, time, "
    + ", ".join(f"{O.r(c)} as {c}" for c in _EXPORT) + " from mexp"))
def series_json_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON arrays, parsed again and compared point by point."""
    ohlcv = _market(spark, sf_dir).ohlcv
    point = ", ".join(f"{c} {'string' if c == 'time' else 'double'}" for c in EXPORT_COLUMNS)
    j = report.series_json(ohlcv).select("index", "points", F.posexplode(F.from_json("json", f"array<struct<{point.replace(' ', ':').replace(',:', ',')}>>")).alias("p", "o"))
    return _round_doubles(j.select("index", (F.col("p") + 1).cast("long").alias("pos"), "points", "o.*"))


def _prompt_sql() -> str:
    ctes = _market_snapshot_ctes() + ",\n" + _stock_ctes() + """,
lst as (select ix."index",
          (select string_agg(sector || ' (' || """ + O.fixed('change_pct', 1, True) + """ || '%)', ', ' order by lead_rank)
           from sp where sp."index" = ix."index" and lead_rank is not null) as leading,
          (select string_agg(sector || ' (' || """ + O.fixed('change_pct', 1, True) + """ || '%)', ', ' order by lag_rank)
           from sp where sp."index" = ix."index" and lag_rank is not null) as lagging,
          (select string_agg(symbol || ' (' || """ + O.fixed('change_pct', 1, True) + """ || '%)', ', ' order by rank)
           from mv where mv."index" = ix."index" and side = 'gainer') as gainers,
          (select string_agg(symbol || ' (' || """ + O.fixed('change_pct', 1, True) + """ || '%)', ', ' order by rank)
           from mv where mv."index" = ix."index" and side = 'loser') as losers
        from ix)"""
    lines = ["'Index ' || s.\"index\" || ', bar of ' || coalesce(date, 'today')"]
    for group, label, field, digits, sign in report.PROMPT_FIELDS:
        value = O.fmt_int(field) if digits is None else O.na(field, digits, sign)
        lines.append(f"'[{group}] {label} = ' || {value}")
    for (label, _, _), column in zip(report.PROMPT_LISTS, ("leading", "lagging", "gainers", "losers")):
        lines.append(f"'[market] {label} = ' || coalesce(nullif(l.{column}, ''), 'N/A')")
    lines += ["'" + rule.replace("'", "''") + "'" for rule in report.prompt_rules()]
    body = ("select s.\"index\", concat_ws(chr(10), " + ",\n  ".join(lines)
            + ") as prompt from msnap s join lst l using (\"index\")")
    return O.with_recursive(ctes, body)


@register("prompt_text", _prompt_sql())
def prompt_text_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8 with F6 / F7: one prompt per index."""
    m = _market(spark, sf_dir)
    return report.build_prompt(m.snapshot, m.movers, m.sectors)


# ================================================================ answers
def _answers_sql() -> str:
    ws = O.strip_ws
    ctes = f"""a as (select conv_id, turn, text from conversations where role = 'assistant'),
s0 as (select conv_id, turn, {ws('text')} as s from a),
t as (select *, case when instr(s, chr(10)) > 0 then substr(s, instr(s, chr(10)) + 1) else '' end as tail
      from s0),
f as (select *, case when starts_with(s, '```')
                     then {ws("case when contains(tail, '```') then regexp_extract(tail, '^(.*)```', 1, 's') else tail end")}
                     else s end as body from t),
p as (select *, coalesce(starts_with(body, '{{') and json_valid(body), false) as ok
      from f)"""
    body = """select conv_id, turn, ok as parsed, case when not ok then 'JSON parse error' end as error,
       case when not ok then case when body = '' then s else body end end as raw
from p"""
    return O.with_recursive(ctes, body)


@register("answers_conversations", _answers_sql())
def answers_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F9 / F10 over every assistant turn (whole texts, also those that don't parse)."""
    from tickframe.functions.text import parse_analysis
    from tickframe.sources.fixtures import read_table
    conv = read_table(spark, sf_dir, "conversations").filter(F.col("role") == "assistant")
    p = conv.select("conv_id", "turn", parse_analysis("text").alias("p"))
    return p.select("conv_id", "turn", F.col("p.analysis").isNotNull().alias("parsed"),
                    F.col("p.error").alias("error"), F.col("p.raw").alias("raw"))


# ================================================================ ingestion
@register("candles_index_flag", O.with_recursive(
    O.bars_cte("flag") + """,
last400 as (select *, row_number() over (partition by symbol order by time desc) as rd from bars)""",
    "select symbol, cast(time as varchar) as time, "
    + ", ".join(f"{O.r(c)} as {c}" for c in PRICES) + " from last400 where rd <= 400"))
def candles_index_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index candle documents (three shapes) back to bars."""
    from tickframe.sources import candles
    docs = candles.render_documents(bars(spark, sf_dir, "flag"), "index")
    b = candles.read_index_bars(docs, candles.INDEX_HISTORY)
    return b.select("symbol", time_text().alias("time"), *[rnd(c, 4).alias(c) for c in PRICES])


@register("candles_stock_supp", O.with_recursive(
    O.bars_cte("supp") + """,
last10 as (select *, row_number() over (partition by symbol order by time desc) as rd from bars)""",
    "select symbol, cast(time as varchar) as time, "
    + ", ".join(f"{O.r(c)} as {c}" for c in PRICES) + " from last10 where rd <= 10"))
def candles_stock_supp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock envelopes (epoch or date text, prices in thousands)."""
    from tickframe.sources import candles
    docs = candles.render_documents(bars(spark, sf_dir, "supp"), "stock", price_div=1000.0)
    b = candles.read_stock_bars(docs, candles.STOCK_HISTORY)
    return b.select("symbol", time_text().alias("time"), *[rnd(c, 4).alias(c) for c in PRICES])


def _all_bars_sql(view: str) -> str:
    return O.with_recursive(O.bars_cte(view), "select symbol, cast(time as varchar) as time, " + ", ".join(f"{O.r(c)} as {c}" for c in PRICES) + " from bars")


@register("candles_index_flag_all", _all_bars_sql("flag"))
def candles_index_flag_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 / S3 / P1-P5 without a count: every bar of the index candle documents."""
    from tickframe.sources import candles
    b = candles.read_index_bars(candles.render_documents(bars(spark, sf_dir, "flag"), "index"))
    return b.select("symbol", time_text().alias("time"), *[rnd(c, 4).alias(c) for c in PRICES])


@register("candles_stock_supp_all", _all_bars_sql("supp"))
def candles_stock_supp_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 / S3 / P3-P6 without a count: every bar of the stock envelopes."""
    from tickframe.sources import candles
    b = candles.read_stock_bars(candles.render_documents(bars(spark, sf_dir, "supp"), "stock", price_div=1000.0))
    return b.select("symbol", time_text().alias("time"), *[rnd(c, 4).alias(c) for c in PRICES])


@register("tail_brand", O.with_recursive(
    O.bars_cte("brand") + """,
t as (select *, row_number() over (partition by symbol order by time desc) as rd from bars)""",
    f"select symbol, cast(time as varchar) as time, rd as rn_desc, {O.r('close')} as close from t where rd <= 1200"))
def tail_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 / W13 for a tail too long to sort in one task: cut out of the series' profile."""
    t = rank.last_n_bars(bars(spark, sf_dir, "brand"), 1200)
    return t.select("symbol", time_text().alias("time"), F.col("rn_desc").cast("long").alias("rn_desc"), rnd("close", 4).alias("close"))


@register("rescaled_user", O.with_recursive(
    O.bars_cte("user") + """,
mx as (select symbol, max(open) as m_open, max(high) as m_high, max(low) as m_low, max(close) as m_close
       from bars group by symbol)""",
    "select symbol, cast(time as varchar) as time, "
    + ", ".join(f"{O.r(f'case when m_{c} < 100 then {c} * 1000.0 else {c} end')} as {c}"
                for c in ("open", "high", "low", "close"))
    + f", {O.r('volume')} as volume from bars join mx using (symbol)"))
def rescaled_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per series and column, prices whose maximum is below 100 are x1000."""
    from tickframe.operators.clean import scale_if_small
    b = scale_if_small(bars(spark, sf_dir, "user"))
    return b.select("symbol", time_text().alias("time"), *[rnd(c, 4).alias(c) for c in PRICES])


@register("history_guard_user", O.with_recursive(
    O.bars_cte("user"),
    """select symbol, cast(null as varchar) as time, 'not enough data: only ' || n || ' rows' as error
from (select symbol, count(*) as n from bars group by symbol) where n < 50"""))
def history_guard_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short series become error rows."""
    from tickframe.operators.clean import require_history
    return require_history(bars(spark, sf_dir, "user"))[1]


@register("history_guard_brand", O.with_recursive(
    O.bars_cte("brand") + ",\ncnt as (select symbol, count(*) as n from bars group by symbol)",
    """select symbol, cast(time as varchar) as time, {o} as open, {c} as close
from bars join cnt using (symbol) where n >= 50""".format(o=O.r("open"), c=O.r("close"))))
def history_guard_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P8 good side: series with enough history pass unchanged."""
    from tickframe.operators.clean import require_history
    good = require_history(bars(spark, sf_dir, "brand"))[0]
    return good.select("symbol", time_text().alias("time"), rnd("open", 4).alias("open"),
                       rnd("close", 4).alias("close"))


@register("missing_sector_symbols", O.with_recursive(
    O.bars_cte("brand") + ",\n" + O.SECTOR_CTE,
    """select symbol, cast(null as varchar) as time, 'no data for ' || symbol as error
from (select distinct symbol from sec) where symbol not in (select symbol from bars)"""))
def missing_sector_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested tickers without bars (anti join)."""
    from tickframe.operators.clean import require_nonempty
    return require_nonempty(dims.dim_sector(spark), bars(spark, sf_dir, "brand"))


@register("export_brand", O.with_recursive(
    O.indicator_ctes("brand"),
    "select symbol, rn, substr(cast(time as varchar), 1, 10) as time, "
    + ", ".join(f"{O.r(c)} as {c}" for c in _EXPORT) + " from ind where rn > n_bars - 365"))
def export_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P12 / W13 / P13 on the 25 brand series."""
    from tickframe.operators.clean import export_columns
    return _round_doubles(export_columns(indicators(bars(spark, sf_dir, "brand")), 365))


# ================================================================ faults and errors
_DIRTY = """dirty0 as (select symbol, time, case when day(time) <> 17 then open end as open,
  case when day(time) = 14 then 'inf'::double else high end as high, low,
  case when day(time) = 13 then 'nan'::double else close end as close,
  case when day(time) = 18 then 0.0 else volume end as volume from bars),
dirty as (select * from dirty0 union all select * from dirty0 where day(time) = 19),
fault as (select *, case when open is null or not isfinite(high) or not isfinite(close) then 'missing price'
  when count(*) over (partition by symbol, time) > 1 then 'duplicate time' end as error from dirty)"""


@register("rejected_supp", O.with_recursive(
    O.bars_cte("supp") + ",\n" + _DIRTY, "select symbol, cast(time as varchar) as time, error from fault where error is not null"))
def rejected_supp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NaN, infinite and null prices and repeated bars become error rows."""
    from tickframe.operators.clean import validate_bars
    return validate_bars(fixtures.dirty(bars(spark, sf_dir, "supp")))[1]


@register("indicators_dirty_flag", O.with_recursive(
    O.indicator_ctes_from(O.bars_cte("flag", "bars0") + ",\n" + _DIRTY.replace("from bars)", "from bars0)")
                          + ",\nbars as (select symbol, time, open, high, low, close, volume from fault where error is null)"),
    "select symbol, cast(time as varchar) as time, rn, " + ", ".join(f"{O.r(c)} as {c}" for c in INDICATOR_COLUMNS) + " from ind"))
def indicators_dirty_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faulty bars don't reach the indicators."""
    from tickframe.operators.clean import validate_bars
    good, _ = validate_bars(fixtures.dirty(bars(spark, sf_dir, "flag")))
    return indicators(good).select("symbol", time_text().alias("time"), "rn", *[rnd(c, 4).alias(c) for c in INDICATOR_COLUMNS])


@register("top_movers_dirty", _movers_sql("supp", _SUPP_UNIVERSE).replace(
    O.bars_cte("supp"), O.bars_cte("supp", "bars0") + ",\n" + _DIRTY.replace("from bars)", "from bars0)")
    + ",\nbars as (select symbol, time, open, high, low, close, volume from fault where error is null)"))
def top_movers_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T6 on checked stock bars: a fault in the newest bar doesn't rank a symbol."""
    from tickframe.operators.clean import validate_bars
    good, _ = validate_bars(fixtures.dirty(bars(spark, sf_dir, "supp")))
    m = rank.top_movers(dims.dim_supplier_universe(spark, sf_dir), rank.scale_fixed(good))
    return m.withColumn("close", rnd("close", 4))


@register("epoch_events", """select event_id, cast(case event_id % 5
    when 0 then cast(ts as date) when 1 then cast(ts as date) end as varchar) as day from events""")
def epoch_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds and date text are read; milliseconds, NaN and huge numbers are null and fail nothing."""
    from tickframe.operators.clean import epoch_or_date
    e = fixtures.read_table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"))
    seconds = F.datediff(F.col("ts").cast("date"), F.lit("1970-01-01")).cast("long") * 86400 + 3600
    text = (F.when(F.col("event_id") % 5 == 0, seconds.cast("string")).when(F.col("event_id") % 5 == 1, F.col("ts").cast("date").cast("string"))
            .when(F.col("event_id") % 5 == 2, (seconds * 1000).cast("string")).when(F.col("event_id") % 5 == 3, "NaN").otherwise("1e20"))
    return e.select("event_id", epoch_or_date(text).cast("string").alias("day"))


_MIN_BARS = 2000
_ABSENT = ("IX_NONE", "Z", 4)
_ERRORS = f"""raw as ({O.BARS_SQL['flag']}),
ix as (select * from (values ('IX_ALL', 'A', 1), ('IX_TOP', 'N', 2), ('IX_WIDE', 'R', 3), ('IX_NONE', 'Z', 4)) t("index", ticker, ord)),
err as (select "index", ord, case when n is null then 'no data for ' || ticker else 'not enough data: only ' || n || ' rows' end as error
  from ix left join (select symbol, count(*) as n from raw group by 1) c on c.symbol = ix.ticker where coalesce(n, 0) < {_MIN_BARS})"""


@register("errors_market", O.with_recursive(_ERRORS, 'select "index", error from err'))
def errors_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indexes with too few bars or none."""
    return _market(spark, sf_dir, market.MarketSettings(min_bars=_MIN_BARS), [_ABSENT]).errors


@register("report_errors", O.with_recursive(_ERRORS, 'select "index", ord, error from err'))
def report_errors_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The error card of failed indexes."""
    m = _market(spark, sf_dir, market.MarketSettings(min_bars=_MIN_BARS), [_ABSENT])
    return report.report_errors(m.indexes, m.errors)


_DOCUMENT_SQL = O.with_recursive(
    _market_snapshot_ctes() + ",\n" + _stock_ctes() + ",\nsize as (select \"index\", least(max(rn), 365) as n from ind join ix on ix.ticker = ind.symbol group by 1)",
    f"""select s."index", {O.r('s.close', 2)} as close, s.date, n as bars,
  (select count(*) from mv where mv."index" = s."index") as movers, (select count(*) from sp where sp."index" = s."index") as sectors,
  (select count(*) from u where u."index" = s."index") as symbols, cast(null as varchar) as error
from msnap s join size using ("index")""")


def _document_row(d: DataFrame) -> DataFrame:
    count = lambda c: F.size(c).cast("long")
    return d.select("index", rnd("snapshot.close", 2).alias("close"), "snapshot.date", count("ohlcv").alias("bars"),
                    (count("movers.top_gainers") + count("movers.top_losers")).alias("movers"), count("sectors.all").alias("sectors"),
                    count("symbols").alias("symbols"), "error")


@register("market_document", _DOCUMENT_SQL)
def market_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document's records as JSON, read back with the document's schema."""
    from pyspark.sql import types as T
    doc = _market(spark, sf_dir).document()
    fields = [f for f in doc.schema.fields if f.name not in ("ord", "generated")]
    entry = market.document_json(doc).select(F.from_json(F.concat(F.lit("{"), "entry", F.lit("}")), T.MapType(T.StringType(), T.StructType(fields))).alias("m"))
    return _document_row(entry.select(F.explode("m").alias("code", "d")).select("d.*"))


@register("document_roundtrip", _DOCUMENT_SQL)
def document_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document written by index, one index of it written again by a later run, and all of it read back."""
    import uuid
    from tickframe.session import checkpoint_dir
    doc = _market(spark, sf_dir).document()
    path = f"{checkpoint_dir(spark)}/document-{uuid.uuid4().hex}"
    market.write_document(doc, path)
    first = market.read_document(spark, path, doc.schema, ["IX_ALL"])
    market.write_document(first.withColumn("generated", F.current_timestamp()), f"{path}-again")
    market.write_document(market.read_document(spark, f"{path}-again", doc.schema), path)
    return _document_row(market.read_document(spark, path, doc.schema))


for _days in report.VIEW_DAYS:
    def _view(spark: SparkSession, sf_dir: str, days: int = _days) -> DataFrame:
        return _round_doubles(report.view_range(_market(spark, sf_dir).ohlcv, days).select("index", "pos", "time", "close"))
    register(f"view_{_days}", O.with_recursive(
        _market_export_ctes(), f"""select "index", pos, time, {O.r('close')} as close from
        (select *, max(pos) over (partition by "index") as n from mexp) where pos > n - {_days}"""))(_view)


# ================================================================ the analysis half
_ANSWERS = """d as (select *, cast(doc_id as varchar) as "index", doc_id % 6 as kind, doc_id % 7 = 0 as failed,
    doc_id % 6 in (0, 1, 5) and doc_id % 7 <> 0 as ok,
    case doc_id % 4 when 0 then 'Tăng' when 1 then 'Giảm' when 2 then 'Đi ngang' else source end as trend,
    case doc_id % 5 when 0 then 'Tích cực' when 1 then 'Tiêu cực' when 2 then 'Trung lập' when 4 then lang end as sentiment
  from documents)"""


def _analysed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.analyses(*fixtures.answered_indexes(spark, sf_dir), fixtures.rendered_answers(spark, sf_dir))


def _answered(name: str, body: str):
    return register(name, f"with {_ANSWERS}\n{body}")


@_answered("analyses", """select "index", case when ok then text end as summary,
  case when failed then 'no data' when not ok then 'JSON parse error' end as error, not ok and not failed as has_raw from d""")
def analyses_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every branch of the answers rendered from the documents."""
    return _analysed(spark, sf_dir).select("index", F.col("analysis.summary").alias("summary"), "error", F.col("raw").isNotNull().alias("has_raw"))


@register("analyses_latest", f"""with {_ANSWERS},
last as (select *, doc_id % 100 as code, row_number() over (partition by doc_id % 100 order by doc_id desc) as rd from documents),
r as (select doc_id, code, text, doc_id % 6 in (0, 1, 5) as ok from last where rd = 1)
select cast(code as varchar) as "index", case when ok then text end as summary, case when not ok then 'JSON parse error' end as error, not ok as has_raw from r""")
def analyses_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J5 where analyses are run again: of several answers for an index the latest counts."""
    runs = fixtures.rendered_answers(spark, sf_dir).select(
        (F.col("index").cast("long") % 100).cast("string").alias("index"), F.col("index").cast("long").alias("run"), "raw")
    none = runs.select("index", F.lit("no data").alias("error")).filter(F.lit(False))
    a = report.analyses(runs.select("index").distinct(), none, runs, order="run")
    return a.select("index", F.col("analysis.summary").alias("summary"), "error", F.col("raw").isNotNull().alias("has_raw"))


@_answered("report_summary", """select "index",
  case coalesce(sentiment, 'Trung lập') when 'Tích cực' then 'pos' when 'Tiêu cực' then 'neg' else 'flat' end as tone,
  case coalesce(sentiment, 'Trung lập') when 'Tích cực' then '↑' when 'Tiêu cực' then '↓' when 'Trung lập' then '→' else '—' end
    || ' ' || coalesce(sentiment, 'Trung lập') as sentiment,
  text as description, case when doc_id % 2 = 0 then lang end as recommendation from d where ok and text <> ''""")
def report_summary_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F18, F14, J6."""
    return report.report_summary(_analysed(spark, sf_dir))


@_answered("report_timeframes", """, s as (select *, unnest([1, 2]) as k from d where ok)
select "index", cast(1 as bigint) as pos, 'short' as frame,
  case trend when 'Tăng' then 'bull' when 'Giảm' then 'bear' else 'neutral' end as tone,
  case when doc_id % 3 = 0 then trend else trend || ' · ' || lang end as badge, source as comment,
  cast(k as bigint) as signal_pos, case when k = 1 then lang else source end as signal from s
union all select "index", 3, 'long', 'neutral', 'flat', '', null, null from d where ok""")
def report_timeframes_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F21, F13, J6."""
    return report.report_timeframes(_analysed(spark, sf_dir))


@_answered("report_scenarios", """select "index", cast(1 as bigint) as pos, 'Bull ' || source as name, 'bull' as tone,
  cast(doc_id % 100 as double) as probability, lang as target, '' as condition, '' as description from d where ok
union all select "index", 2, 'Kịch bản GIẢM', 'bear', 0.0, '', '', '' from d where ok""")
def report_scenarios_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a probability may be written as a number, as text or with a percent sign."""
    return report.report_scenarios(_analysed(spark, sf_dir))


@_answered("report_levels_comment", """select "index", 'near ' || doc_id as comment from d where ok and kind <> 5""")
def report_levels_comment_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F20's comment; a part of another type than expected is missing, and the answer stays."""
    return report.report_levels_comment(_analysed(spark, sf_dir))


def _levels_analysis_sql() -> str:
    key = {"immediate_support": "cast(doc_id as double)", "strong_resistance": "doc_id * 1.5"}
    parts = []
    for pos, label, source, field in report.LEVEL_ROWS:
        val = f"case when ok then {key[field]} end" if field in key else "cast(null as double)" if source == "analysis" else O.q(field)
        parts.append(f"""select symbol as "index", cast({pos} as bigint) as pos, '{label}' as level, {O.r(val, 2)} as value, {O.fmt_num(val)} as text from both_""")
    ctes = snapshot_ctes(O.indicator_ctes("supp")) + ",\nsnap as (select symbol, " + snapshot_cols() + " from last),\n" + _ANSWERS \
        + """,\nboth_ as (select snap.*, d.doc_id, d.ok from snap left join d on d."index" = snap.symbol)"""
    return O.with_recursive(ctes, "\nunion all\n".join(parts))


@register("report_levels_analysis", _levels_analysis_sql())
def report_levels_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F20 with key levels: supplier snapshots with the answers of the documents of the same number."""
    snap = snapshot(indicators(bars(spark, sf_dir, "supp"))).withColumnRenamed("symbol", "index")
    return report.report_levels(snap, _analysed(spark, sf_dir))


@register("changes_supp", O.with_recursive(
    O.bars_cte("supp") + ",\n" + O.last_two_cte(), f"""select symbol, case when pct > 0 then 'pos' when pct < 0 then 'neg' when pct = 0 then 'flat' end as tone,
  case when pct is null then '—' else case when pct > 0 then '+' else '' end || {O.fixed('pct')} || '%' end as text
  from (select symbol, {O.PCT} as pct from l2)"""))
def changes_supp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """signed percent texts of the newest changes (none for a single bar)."""
    from tickframe.functions.text import fmt_chg
    l2 = rank.last_two(rank.scale_fixed(bars(spark, sf_dir, "supp")))
    c = fmt_chg(rank.pct_change(F.col("close"), F.col("prev_close")))
    return l2.select("symbol", c["tone"].alias("tone"), c["text"].alias("text"))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
