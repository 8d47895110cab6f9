"""Independent DuckDB statements for the correctness gate.

The SQL is written from the operator definitions, not from the Spark plan:
finite frames are plain ``ROWS`` windows with a ``count = p`` guard and the
recursive indicators are a recursive CTE that steps one bar at a time, the
way the definition reads.  Doubles are rounded on both sides; ``+ 0.0``
turns DuckDB's ``-0.0`` into ``0.0``.
"""

from __future__ import annotations

_PRICE = "l_extendedprice / l_quantity"
_LKEY = "l_orderkey::hugeint * 100000000000000000000 + l_linenumber::hugeint * 10000000000000000000 + l_partkey"


def r(expr: str, d: int = 4) -> str:
    """Two-step half-up rounding through DECIMAL, the twin of ``functions.numeric.rnd``."""
    return f"cast(round(cast({expr} as decimal(38, 10)), {d}) as double)"


def _ohlcv(symbol: str, time: str, price: str, key: str, volume: str, src: str) -> str:
    return (f"select {symbol} as symbol, {time} as time, "
            f"arg_min({price}, {key}) as open, max({price}) as high, min({price}) as low, "
            f"arg_max({price}, {key}) as close, cast({volume} as double) as volume "
            f"from {src} group by 1, 2")


BARS_SQL = {
    "brand": _ohlcv("p_brand", "cast(l_shipdate as date)", _PRICE, _LKEY, "sum(l_quantity)",
                    "lineitem join part on l_partkey = p_partkey"),
    "supp": _ohlcv("cast(l_suppkey as varchar)", "cast(l_shipdate as date)", _PRICE, _LKEY,
                   "sum(l_quantity)", "lineitem"),
    "flag": _ohlcv("l_returnflag", "cast(l_shipdate as date)", _PRICE, _LKEY, "sum(l_quantity)",
                   "lineitem"),
    "hour": _ohlcv("event_type", "date_trunc('hour', ts)", "value", "event_id", "count(*)",
                   "events"),
    "user": _ohlcv("cast(user_id as varchar)", "cast(ts as date)", "value", "event_id",
                   "count(*)", "events"),
}


def bars_cte(view: str, name: str = "bars") -> str:
    return f"{name} as ({BARS_SQL[view]})"


def _frame(fn: str, x: str, p: int) -> str:
    w = f"(partition by symbol order by rn rows between {p - 1} preceding and current row)"
    return f"case when count({x}) over {w} = {p} then {fn}({x}) over {w} end"


def indicator_ctes(view: str) -> str:
    """CTEs ``bars``, ``o`` (row numbers, lag), ``f`` (frames), ``rc`` (recursion), ``ind``."""
    return indicator_ctes_from(bars_cte(view))


def indicator_ctes_from(bars_ctes: str) -> str:
    """The indicator CTEs on top of CTE text that defines ``bars``."""
    mas = ", ".join(f"{_frame('avg', 'close', p)} as ma{p}" for p in (5, 10, 20, 50, 100, 200))
    w14 = "(partition by symbol order by rn rows between 13 preceding and current row)"
    return f"""{bars_ctes},
o as (select *, row_number() over (partition by symbol order by time) as rn,
             count(*) over (partition by symbol) as n_bars,
             lag(close) over (partition by symbol order by time) as prev_close
      from bars),
f0 as (select *, {mas},
         {_frame('avg', 'volume', 20)} as vol_ma20,
         {_frame('stddev_samp', 'close', 20)} as sd20,
         {_frame('min', 'low', 14)} as lo14,
         {_frame('max', 'high', 14)} as hi14,
         greatest(high - low, abs(high - prev_close), abs(low - prev_close)) as tr,
         case when prev_close is not null then greatest(close - prev_close, 0) end as gain,
         case when prev_close is not null then greatest(prev_close - close, 0) end as loss
       from o),
f as (select *, 100.0 * (close - lo14) / nullif(hi14 - lo14, 0) as stoch_k,
        case when rn = 14 then avg(tr) over {w14} end as tr_seed,
        case when rn = 15 then avg(gain) over {w14} end as gain_seed,
        case when rn = 15 then avg(loss) over {w14} end as loss_seed
      from f0),
rc as (
  select symbol, rn, close as ema12, close as ema26, 0.0::double as sig,
         null::double as atr, null::double as ag, null::double as al
  from f where rn = 1
  union all
  select f.symbol, f.rn,
         f.close * 2.0 / 13.0 + rc.ema12 * 11.0 / 13.0,
         f.close * 2.0 / 27.0 + rc.ema26 * 25.0 / 27.0,
         ((f.close * 2.0 / 13.0 + rc.ema12 * 11.0 / 13.0)
          - (f.close * 2.0 / 27.0 + rc.ema26 * 25.0 / 27.0)) * 0.2 + rc.sig * 0.8,
         case when f.rn = 14 then f.tr_seed when f.rn > 14 then (rc.atr * 13.0 + f.tr) / 14.0 end,
         case when f.rn = 15 then f.gain_seed when f.rn > 15 then (rc.ag * 13.0 + f.gain) / 14.0 end,
         case when f.rn = 15 then f.loss_seed when f.rn > 15 then (rc.al * 13.0 + f.loss) / 14.0 end
  from rc join f on f.symbol = rc.symbol and f.rn = rc.rn + 1
),
ind as (
  select f.symbol, f.time, f.rn, f.n_bars, f.open, f.high, f.low, f.close, f.volume, f.prev_close,
         ma5, ma10, ma20, ma50, ma100, ma200, vol_ma20,
         rc.atr as atr14,
         ma20 as bb_mid, ma20 + 2 * sd20 as bb_upper, ma20 - 2 * sd20 as bb_lower,
         100.0 - 100.0 / (1.0 + rc.ag / nullif(rc.al, 0)) as rsi14,
         rc.ema12 - rc.ema26 as macd, rc.sig as macd_signal, (rc.ema12 - rc.ema26) - rc.sig as macd_hist,
         stoch_k,
         case when count(stoch_k) over (partition by f.symbol order by f.rn
                                        rows between 2 preceding and current row) = 3
              then avg(stoch_k) over (partition by f.symbol order by f.rn
                                      rows between 2 preceding and current row) end as stoch_d
  from f join rc on f.symbol = rc.symbol and f.rn = rc.rn
)"""


# Names of the indicator columns.
INDICATORS = ["ma5", "ma10", "ma20", "ma50", "ma100", "ma200", "vol_ma20", "atr14",
              "bb_mid", "bb_upper", "bb_lower", "rsi14", "macd", "macd_signal", "macd_hist",
              "stoch_k", "stoch_d"]


def with_recursive(ctes: str, body: str) -> str:
    return f"with recursive {ctes}\n{body}"


# ---------------------------------------------------------------- dimensions
UNIVERSE_CTE = """u0 as (
  select 'IX_ALL' as "index", 'Brand#' || i as symbol, cast(i as integer) as ord from range(1, 16) t(i)
  union all select 'IX_TOP', 'Brand#' || i, cast(i as integer) from range(1, 16) t(i)
  union all select 'IX_WIDE', 'Brand#' || i, cast(i as integer) from range(1, 26) t(i)
  union all select 'IX_WIDE', 'Brand#7', 26),
u as (select "index", symbol, min(ord) as ord from u0 group by 1, 2)"""

SECTOR_CTE = """sec as (
  select 'Sector ' || (i % 8) as sector, cast(i % 8 as integer) as sector_ord, 'Brand#' || i as symbol
  from range(1, 26) t(i) where i % 8 < 7
  union all select 'Sector 6', 6, 'Brand#99')"""

INDEX_CTE = """ix as (select * from (values ('IX_ALL', 'A', 1), ('IX_TOP', 'N', 2), ('IX_WIDE', 'R', 3))
       t("index", ticker, ord))"""


def last_two_cte(src: str = "bars", scale: str = "1000.0") -> str:
    return f"""l2 as (
  select symbol, max(time) as time, arg_max(close, time) as close,
         case when count(*) = 2 then arg_min(close, time) end as prev_close, count(*) as n_last
  from (select symbol, time, close * {scale} as close,
               row_number() over (partition by symbol order by time desc) as rd from {src})
  where rd <= 2 group by symbol)"""


PCT = "case when prev_close = 0 then 0.0 else (close - prev_close) / nullif(prev_close, 0) * 100.0 end"


# -------------------------------------------------------------- formatting
def na(x: str, d: int = 2, sign: bool = False) -> str:
    """Twin of ``text.fmt_or_na``."""
    x = q(x)
    return f"case when {x} is null then 'N/A' else printf('%{'+' if sign else ''}.{d}f', {r(x, d)}) end"


def q(x: str) -> str:
    """Quote a bare column name that is a DuckDB keyword."""
    return f'"{x}"' if x in ("pivot",) else x


def fixed(x: str, d: int = 2, sign: bool = False) -> str:
    """Twin of ``text.fixed`` (null stays null)."""
    x = q(x)
    return f"printf('%{'+' if sign else ''}.{d}f', {r(x, d)})"


def fmt_num(x: str, d: int = 2) -> str:
    """Twin of ``text.fmt_num``."""
    x = q(x)
    return f"coalesce(format('{{:,.{d}f}}', {r(x, d)}), '—')"


def fmt_int(x: str) -> str:
    return f"coalesce(format('{{:,}}', cast({x} as bigint)), 'N/A')"


WS = r"'^[ \t\n\r\f\x0B]+|[ \t\n\r\f\x0B]+$'"


def strip_ws(x: str) -> str:
    return f"regexp_replace({x}, {WS}, '', 'g')"


# ------------------------------------------------------------ market ctes
def market_ctes(min_bars: int = 50) -> str:
    """Index series (flag bars of the three tickers), guard, rescale, indicators."""
    scaled = ", ".join(
        f"case when m_{c} < 100 then r.{c} * 1000.0 else r.{c} end as {c}"
        for c in ("open", "high", "low", "close"))
    src = f"""raw as ({BARS_SQL['flag']}),
{INDEX_CTE},
recent as (select * from raw where symbol in (select ticker from ix)),
cnt as (select symbol, count(*) as n from recent group by symbol),
mx as (select symbol, max(open) as m_open, max(high) as m_high, max(low) as m_low,
              max(close) as m_close from recent group by symbol),
bars as (select r.symbol, r.time, {scaled}, r.volume
         from recent r join mx using (symbol) join cnt using (symbol) where cnt.n >= {min_bars})"""
    return indicator_ctes_from(src)
