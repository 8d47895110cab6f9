"""End-to-end batch: bars in, document + prompts + report tables out.

The reference runs three scripts in sequence with a JSON file as the only
hand-over (fetch -> analyse -> build page).  Here one Spark application writes
every stage's result as a table under ``out_dir`` (a shared path on a
cluster):

    market/<table>/  flat parquet tables: snapshot, ohlcv, movers, sectors
    errors/          index, error: indexes that failed
    rejected/        kind, symbol, time, error: bars that took no part
    document/        one JSON object per index (S7)
    prompts/         index, prompt (F8), the input of the external model call
    analysis/        index, analysis, error, raw (F9, F10, J5), when answers are given
    report/<card>/   parquet tables of every report card (F17-F24, P16-P18)

Usage::

    python -m tickframe.plans.job --index-bars PATH --stock-bars PATH --indexes PATH --universe PATH
        --sectors PATH --out DIR [--answers PATH] [--history N] [--min-bars N] [--export-bars N]
        [--mover-cap N] [--stock-scale X] [--no-rescale]

Bar inputs are parquet tables with the canonical bar columns; ``indexes`` has
``index, ticker, ord``, ``universe`` has ``index, symbol, ord``, ``sectors`` has
``sector, sector_ord, symbol``; answers are a table ``index, raw``.  Tables are
read as JSON if their path ends in ``.json``, else as parquet.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from tickframe.operators import clean, rank
from tickframe.plans import market, report
from tickframe.session import get_spark


def run(spark: SparkSession, index_bars: DataFrame, stock_bars: DataFrame, indexes: DataFrame, universe: DataFrame,
        sectors: DataFrame, out_dir: str, answers: DataFrame | None = None, stock_scale: float | None = rank.STOCK_SCALE,
        settings: market.MarketSettings = market.MarketSettings()) -> dict:
    """Run the whole job; returns the output paths by name."""
    stock = rank.scale_fixed(stock_bars, stock_scale) if stock_scale else stock_bars
    m = market.market_tables(index_bars, stock, indexes, universe, sectors, settings)
    out: dict[str, str] = {}

    def save(name: str, df: DataFrame) -> DataFrame:
        out[name] = f"{out_dir}/{name}"
        df.write.mode("overwrite").parquet(out[name])
        return spark.read.schema(df.schema).parquet(out[name])

    # the flat tables feed every later one: each is written once and read back
    for name in ("errors", "rejected"):
        setattr(m, name, save(name, getattr(m, name)))
    for name in ("snapshot", "ohlcv", "movers", "sectors"):
        setattr(m, name, save(f"market/{name}", getattr(m, name)))
    out["document"] = f"{out_dir}/document"
    market.write_document(m.document(), out["document"])
    snap, ohlcv = m.reported(m.snapshot), m.reported(m.ohlcv)
    reported = m.reported(indexes.select("index"))
    save("prompts", report.build_prompt(snap, m.movers, m.sectors))
    analysed = None
    cards = {
        "hero": report.report_hero(snap), "movers": report.report_movers(m.movers, m.sectors, reported),
        "indicators": report.report_indicators(snap), "errors": report.report_errors(indexes, m.errors),
        "chart_candles": report.chart_candles(ohlcv), "chart_volume": report.chart_volume(ohlcv),
        "chart_lines": report.chart_lines(ohlcv), "series": report.series_json(ohlcv), "index_order": market.index_order(indexes),
        **{f"view_{days}": report.view_range(ohlcv, days) for days in report.VIEW_DAYS},
    }
    if answers is not None:
        analysed = save("analysis", report.analyses(indexes, m.errors, answers))
        cards |= {"summary": report.report_summary(analysed), "timeframes": report.report_timeframes(analysed),
                  "scenarios": report.report_scenarios(analysed), "levels_comment": report.report_levels_comment(analysed)}
    cards["levels"] = report.report_levels(snap, analysed)
    for name, df in cards.items():
        save(f"report/{name}", df)
    return out


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    for name in ("--index-bars", "--stock-bars", "--indexes", "--universe", "--sectors", "--out"):
        p.add_argument(name, required=True)
    p.add_argument("--answers")
    p.add_argument("--history", type=int)
    p.add_argument("--min-bars", type=int, default=50)
    p.add_argument("--export-bars", type=int, default=365)
    p.add_argument("--mover-cap", type=int)
    p.add_argument("--stock-scale", type=float, default=rank.STOCK_SCALE)
    p.add_argument("--no-rescale", action="store_true")
    a = p.parse_args(argv)
    spark = get_spark()

    def table(path: str) -> DataFrame:
        return spark.read.json(path) if path.endswith(".json") else spark.read.parquet(path)

    settings = market.MarketSettings(history=a.history, min_bars=a.min_bars, export_bars=a.export_bars, mover_cap=a.mover_cap,
                                     small_price=None if a.no_rescale else clean.SMALL_PRICE)
    paths = run(spark, table(a.index_bars), table(a.stock_bars), table(a.indexes), table(a.universe), table(a.sectors), a.out,
                table(a.answers) if a.answers else None, a.stock_scale, settings)
    for k, v in paths.items():
        print(k, v)


if __name__ == "__main__":
    main()
