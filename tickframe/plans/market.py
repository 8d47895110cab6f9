"""The market job (the reference's fetch stage) as one Spark plan.

Per index code: index bars -> checks -> 50-bar guard -> per-column rescale ->
indicators -> snapshot and 365-bar export; movers and sector rankings of its
universe.  The results are flat tables; ``document`` nests them into one row per
index with the same shape as the reference's JSON document, plus an error
column (P14: a failing index becomes ``{index, error}`` and never stops the
others).

All indexes run in the same plan: the reference's loop over indexes (and its
184 sequential downloads) becomes one scan and a few shuffles.  Nothing is
computed before a table is read, so a caller pays for the tables it reads.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe.operators import clean, profile, rank
from tickframe.operators.indicators import indicators
from tickframe.operators.levels import snapshot


@dataclass(frozen=True)
class MarketSettings:
    """What a caller may set; ``None`` switches a cut or rule off."""
    history: int | None = None         # newest bars per index that take part (S4)
    min_bars: int = 50                 # fewer bars make an index fail (P8)
    export_bars: int = 365             # rows per index in the chart export (P12)
    small_price: float | None = clean.SMALL_PRICE   # rescale rule (P7)
    mover_cap: int | None = None       # symbols of a universe that are ranked (P11)
    top: int = rank.TOP_K


@dataclass
class MarketTables:
    indexes: DataFrame      # index, ticker, ord
    universe: DataFrame     # index, symbol, ord
    ind: DataFrame          # index bars + indicators
    snapshot: DataFrame     # one row per index (L4), rounded
    ohlcv: DataFrame        # export rows per index (P12), ``pos`` from 1
    movers: DataFrame       # flat T6 rows
    sectors: DataFrame      # flat T7 rows
    errors: DataFrame       # index, error: indexes that failed
    rejected: DataFrame     # kind (index / stock), symbol, time, error: bars that take no part

    def document(self) -> DataFrame:
        return document(self)

    def reported(self, flat: DataFrame) -> DataFrame:
        """The rows of a flat table whose index did not fail."""
        return flat.join(self.errors.select("index"), "index", "left_anti")


def index_series(index_bars: DataFrame, indexes: DataFrame,
                 settings: MarketSettings = MarketSettings()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """S1 + S4 + P9 + P14 + P8 + P7 for the index series.

    Returns ``(bars, index errors, rejected rows)``; the bars are numbered (``rn``, ``n_bars``), as guard,
    rescaling and numbering share one profile.  Index errors (no data,
    too little history) fail that index only; rejected rows (missing price,
    duplicate time) are dropped and reported without failing it.
    """
    tick = indexes.select("index", F.col("ticker").alias("symbol"))
    wanted = index_bars.join(tick.select("symbol").distinct(), "symbol", "left_semi")
    good, rejected = clean.validate_bars(wanted)
    if settings.history is not None:
        good = rank.last_n_bars(good, settings.history).drop("rn_desc")
    enough, short = profile.checked_series(good, settings.min_bars, settings.small_price)
    missing = clean.require_nonempty(tick, good)
    errors = short.unionByName(missing).join(tick, "symbol").select("index", "error")
    return enough, errors, rejected


def market_tables(index_bars: DataFrame, stock_bars: DataFrame, indexes: DataFrame, universe: DataFrame,
                  sectors: DataFrame, settings: MarketSettings = MarketSettings()) -> MarketTables:
    """All tables of the job for the given ``indexes`` (index, ticker, ord), ``universe`` (index,
    symbol, ord) and ``sectors`` (sector, sector_ord, symbol)."""
    tick = indexes.select("index", F.col("ticker").alias("symbol"))
    series, errors, bad_index = index_series(index_bars, indexes, settings)
    ind = indicators(series).join(tick, "symbol")
    snap = snapshot(ind, keys=("index", "symbol"))
    n = settings.export_bars
    pos = F.col("rn") - F.greatest(F.col("n_bars") - F.lit(n), F.lit(0))
    ohlcv = clean.export_columns(ind.withColumn("pos", pos), n)

    members = rank.sector_members(indexes, universe, sectors)
    capped = rank.cap_universe(universe, settings.mover_cap)
    wanted = capped.select("symbol").union(members.select("symbol")).distinct()
    good, bad_stock = clean.validate_bars(stock_bars.join(wanted, "symbol", "left_semi"))
    # one plan shared by movers and sectors: identical subtrees, one reused exchange
    last2 = rank.last_two(good)
    movers = rank.top_movers(capped, good, settings.top, last2=last2)
    performance = rank.sector_performance(members, good, settings.top, last2=last2)
    rejected = bad_index.select(F.lit("index").alias("kind"), "*").union(bad_stock.select(F.lit("stock"), "*"))
    return MarketTables(indexes, universe, ind, snap, ohlcv, movers, performance, errors, rejected)


def document(m: MarketTables) -> DataFrame:
    """The index codes, in order, left-joined with every per-index part (S7's rows).

    The nested lists are the export rows, the top movers, the sectors and the
    universe of one index; an index's universe is a configuration list.
    """
    s = m.snapshot.select("index", F.struct(*[c for c in m.snapshot.columns if c not in ("index", "symbol")]).alias("snapshot"))
    export_cols = [c for c in m.ohlcv.columns if c not in ("index", "symbol", "rn", "pos")]
    o = m.ohlcv.groupBy("index").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", *export_cols))), lambda x: x.dropFields("pos")).alias("ohlcv"))
    lists = rank.collect_top_lists(m.movers, m.sectors).select(
        "index", F.struct("top_gainers", "top_losers").alias("movers"), F.struct("leading", "lagging", "all").alias("sectors"))
    syms = m.universe.groupBy("index").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("ord", "symbol"))), lambda x: x["symbol"]).alias("symbols"))
    err = m.errors.groupBy("index").agg(F.concat_ws("; ", F.array_sort(F.collect_list("error"))).alias("error"))
    d = m.indexes.select("index", "ord")
    for part in (s, o, lists, syms, err):
        d = d.join(part, "index", "left")
    sound = F.col("error").isNull()
    return d.select("index", "ord", *[F.when(sound, F.col(c)).alias(c) for c in ("snapshot", "ohlcv", "movers", "sectors", "symbols")],
                    F.current_timestamp().alias("generated"), "error")


def write_document(doc: DataFrame, path: str) -> None:
    """One JSON object per index, UTF-8, in a folder of its own (``index=<code>``).

    Only the folders of the indexes in ``doc`` are replaced: documents of other indexes stay, and a run
    that fails before its commit leaves all of them.
    """
    doc.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("index").json(path)


def read_document(spark: SparkSession, path: str, schema, indexes: list[str] | None = None) -> DataFrame:
    """Read a written document back with its schema (no inference), all of it or the given ``indexes``.

    The index is the folder, so others are not read.  A line that is no such document becomes a row
    with the ``error`` "damaged document".  A missing document is not an error: the result is empty,
    like the reference, which reports the missing file and stops.
    """
    names = [f.name for f in schema.fields]
    corrupt = T.StructField("_damaged", T.StringType())
    try:
        found = spark.read.schema(T.StructType([*schema.fields, corrupt])).option("columnNameOfCorruptRecord", "_damaged").json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    if indexes is not None:
        found = found.filter(F.col("index").isin(indexes))
    damaged = F.col("_damaged").isNotNull()
    return found.select(*[F.col(c) if c == "index" else F.when(damaged, F.lit("damaged document")).otherwise(F.col(c)).alias(c) if c == "error"
                          else F.when(~damaged, F.col(c)).alias(c) for c in names])


def generated_text(ts: str = "generated"):
    """the run time as ``yyyy-MM-dd HH:mm`` (ISO text cut to 16, ``T`` -> space)."""
    return F.date_format(F.col(ts), "yyyy-MM-dd HH:mm")


def document_json(doc: DataFrame) -> DataFrame:
    """The reference's record per code: ``index, entry`` where entry is ``"code":{...}`` as JSON text.

    One row per index; a file of all of them is ``{`` + the entries + ``}``.
    """
    rec = F.to_json(F.struct(*[c for c in doc.columns if c not in ("ord", "generated")]))
    key = F.regexp_replace(F.to_json(F.array("index")), r"^\[|\]$", "")   # JSON-escaped
    return doc.select("index", F.concat(key, F.lit(":"), rec).alias("entry"), generated_text().alias("generated_at"))


def index_order(indexes: DataFrame) -> DataFrame:
    """tabs in fixed order, the first one active."""
    first = indexes.agg(F.min("ord")).scalar()
    return indexes.select("index", "ord", (F.col("ord") == first).alias("active"))
